"""Fixed values of the rule operators: patterns, word lists and reasons, as plain data.

Each pattern is written once, in Python's regular-expression syntax; ``functions.regex`` brings it
to the JVM's. Flags: i ignores case, m makes ^ and $ match at lines, s lets . match line ends.
Tables are ordered: the first pattern that matches decides.
"""

# ---- Fixed values (patterns, word lists, formats) ----

# (flags, pattern, filter_tag, reason)
PROMPT_CONTAMINATION = [
    ("i", r"\bsolution\s*:", "prompt_contamination", "solution_marker"),
    ("i", r"\bfinal answer\s*:", "answer_leakage", "final_answer_marker"),
    ("i", r"\bthe answer is\s*\(?[A-F0-9\\]", "answer_leakage", "direct_answer_statement"),
    ("i", r"</think>|<think>", "prompt_contamination", "reasoning_tag"),
    ("i", r"\b(?:assistant|user|system)\s*:", "prompt_contamination", "chat_role_marker"),
    ("", r"\\boxed\{[^}]{1,120}\}", "answer_leakage", "boxed_answer"),
    ("i", r"\b(?:therefore|thus|hence)\b.{0,80}\b(?:answer|result|value)\b", "answer_leakage", "conclusion_phrase"),
    ("i", r"\bstep\s+\d+\s*:", "prompt_contamination", "step_marker"),
    ("i", r"\b(?:first|second|third|fourth|fifth|next|finally|lastly),?\s+(?:we |I |let's |let us )?(?:find|compute|calculate|determine|note|observe|solve|simplify|use|apply)\b", "prompt_contamination", "reasoning_trace"),
    ("i", r"\b(?:the |our )?(?:answer|result|solution) (?:is|equals?|=)\s*(?:\$|\\|\d)", "answer_leakage", "answer_equals"),
    ("i", r"\b(?:so|thus|hence|therefore|accordingly)\s+(?:the )?(?:answer|result|value|probability|sum|area|volume)\s+(?:is|=|equals)\b", "answer_leakage", "derived_answer"),
    ("i", r"<\|(?:startoftext|endoftext|pad|sep|cls|mask|im_start|im_end)\|>", "prompt_contamination", "special_token"),
    ("i", r"\[/?(?:INST|SYS)\]", "prompt_contamination", "instruction_token"),
    ("i", r"<</?SYS>>", "prompt_contamination", "llama_sys_token"),
    ("im", r"(?:^|\n)(?:Human|AI|User|Assistant|System|Bot|Agent|ChatGPT|GPT)\s*:", "prompt_contamination", "chat_turn_marker"),
    ("i", r"\b(?:chosen|rejected|preferred|reward|score)\s*(?::|=)\s*", "prompt_contamination", "reward_annotation"),
    ("i", r"\b(?:solving|working through|let's work|working out)\s+(?:the |this )?(?:problem|equation|expression)\b", "prompt_contamination", "solution_walkthrough"),
]
ANSWER_CUES = ["answer", "solution", "final answer", "boxed"]

# (flags, pattern, reason)
MISSING_CONTEXT = [
    ("i", r"\b(?:as|shown|described|defined|given|proved|derived|stated|illustrated|indicated|depicted|demonstrated)\s+(?:above|below|earlier|previously|before|after|in the (?:figure|table|chart|graph|diagram|image|picture|photo|passage|text|paragraph|section|chapter))\b", "relative_context_reference"),
    ("i", r"\b(?:from|using|based on|according to|refer(?:ring)? to)\s+(?:the\s+)?(?:conversation|chat|dialogue|code context|context above|previous answer|passage|article|text|table|chart|graph|diagram|figure|image|picture|data set|dataset|spreadsheet|document|source|excerpt|reading|map|information (?:above|below|given|provided)|results? (?:above|below|shown))\b", "external_context_reference"),
    ("i", r"\b(?:same|following)\s+(?:game|setup|construction|figure|diagram|problem|example|context|scenario|conditions?)\s+(?:as|described|given|above|below)\b", "same_setup_reference"),
    ("i", r"\b(?:problem|example|exercise|question|theorem|lemma|corollary|chapter|section|proposition|definition|remark|figure|table|equation|page)\s+\d+(?:\.\d+)*\b", "external_problem_reference"),
    ("i", r"\b(?:see|refer to|using|look at|consult|check)\s+(?:the )?(?:attachment|attached (?:image|figure|file|document|diagram|table|chart|spreadsheet|pdf)|(?:image|figure|table|chart|graph|diagram|picture|photo|map) (?:below|above|shown|provided|attached)|accompanying (?:figure|table|chart|image|diagram|document)|(?:following|above|below) (?:figure|table|chart|image|diagram|graph))\b", "attachment_reference"),
    ("i", r"\b(?:in|from|on) (?:the |this )?(?:figure|table|chart|graph|diagram|image|picture|photo|map|screenshot)\b", "visual_reference"),
    ("i", r"\b(?:the |this )?following (?:data|table|information|passage|text|excerpt|code|figure|image|diagram|chart|graph|results?|output|content|list|set of)\b(?!.*[\n].*[\n].*[\n])", "dangling_following_reference"),
    ("i", r"\b(?:use|refer to|see|look at|consider|examine|inspect|study|analyze)\s+(?:the )?(?:Table|Figure|Fig\.|Chart|Graph|Diagram|Exhibit|Appendix)\s*(?:\d+|[A-Z](?:\.\d+)?)\b", "numbered_visual_reference"),
]

# (flags, pattern, reason)
UNDERSPECIFIED = [
    ("i", r"^\s*(?:find|compute|evaluate|determine)\s+[A-Za-z]\w*\s*\(\s*[-+]?\d+(?:\.\d+)?\s*\)\s*[.?!]?\s*$", "undefined_symbol_target"),
    ("i", r"^\s*(?:find|determine|compute|evaluate)\s+the\s+(?:value|answer|result)\s*[.?!]?\s*$", "missing_target"),
    ("s", r"^.{1,14}$", "too_short"),
    ("", r"^\s*[\d\s+\-*/^=().]+\s*$", "bare_expression"),
    ("i", r"^\s*(?:what is|what's|find|give|tell me|state) (?:the )?(?:answer|result|solution|value|output)\s*\??\s*$", "missing_problem"),
]

# (flags, pattern, reason)
BROKEN_FORMAT = [
    ("i", r"</think>|<think>|<assistant>|<user>|<system>", "transcript_tag"),
    ("m", r"^```|```$", "code_fence_residue"),
    ("m", r"^diff --git\b|^deleted file mode\b|^\+\+\+ |^--- |^@@ ", "diff_residue"),
    ("m", r"!\[\]\($|!\[[^\]]*\]\($", "truncated_image_markup"),
    ("i", r"<(?:div|span|table|tr|td|th|img|script|style|link|meta|head|body|html)\b", "html_artifact"),
    ("i", r"data:image/[a-z]+;base64,", "base64_artifact"),
    ("", r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]{5,}", "control_char_garbage"),
    ("", r"(?:\\u[0-9a-fA-F]{4}){3,}", "escaped_unicode_garbage"),
    ("i", r"(?:Undefined control sequence|Missing \$ inserted|Extra \}|Runaway argument)", "latex_error_artifact"),
]

# ignoring case
PHANTOM_REFERENCE = [
    r"as shown in the figure",
    r"refer to the diagram",
    r"the figure (?:below|above)",
    r"see figure\s*\d+",
    r"in the picture",
    r"the table (?:below|above)",
    r"in the table",
    r"see table\s*\d+",
    r"from the chart",
    r"the graph is shown",
    r"the graph of .* is shown",
    r"shown in the graph",
    r"as illustrated",
    r"the image shows",
    r"see the drawing",
]

# (flags, pattern)
BROKEN_REFERENCE = [
    ("i", r"\b(?:given the same setup as|compare with|as in) (?:problem|example)\s*\d"),
    ("i", r"\bassert(?:ion)? in problem\s*\d"),
    ("i", r"\(p\.\s*\d+\)"),
    ("im", r"^\s*(?:subject|example)\s+\d+\.\s*$"),
]
LATEX = ("", r"\$[^$]*\$|\\[a-zA-Z]+(?:\{[^}]*\})*")
VERB = ("i", r"\b(?:solve|find|determine|evaluate|prove|show|compute|calculate|simplify|express|factor|expand|verify|derive|graph|sketch|list|describe|explain|give|state|write|how many|what is|let)\b")

# (flags, pattern)
META_TASK = [
    ("i", r"you will be given a challenging math problem followed by \d+ solutions"),
    ("i", r"your task is to systematically analyze these solutions"),
    ("i", r"identify the most mathematically sound approach"),
    ("i", r"solutions:\s*detailed solutions indexed"),
    ("i", r"Input Format:\s*Problem:"),
    ("s", r"Solution [0-9]+:.*Solution [0-9]+:"),
    ("i", r"each concluding with an answer in \\boxed\{\}"),
    ("i", r"provide a good and informational response.+like a helpful human"),
    ("i", r"answer the following question.*\n\[Q\]:"),
    ("i", r"now provide the response and nothing else"),
    ("i", r"\b(?:follow|obey)\s+(?:the )?system rules\b"),
    ("i", r"\bretrieve and repeat the exact described function\b"),
    ("i", r"\bexact(?:ly)? \d+ bullet points\b"),
    ("i", r"\bgive me \d+ (?:tags|titles|keywords)\b"),
    ("i", r"\bfor my youtube video\b"),
    ("i", r"\bwrite a hypothetical\b"),
    ("i", r"\b(?:summarize|rewrite|proofread|paraphrase|analyze)\b.*\b(?:film|video|document|article|text)\b"),
    ("i", r"\b(?:repeat|extract|retrieve)\b.*\b(?:code context|function|snippet)\b"),
    ("i", r"\b(?:platform|product|app|feature)\b.*\b(?:design|requirements?|specification)\b"),
    ("i", r"\b(?:roleplay|persona|you are an ai named)\b"),
    ("i", r"\b(?:grade|rate|score|rank|evaluate|assess|judge|critique|review)\s+(?:the |this |these |my |each )?(?:solution|answer|response|essay|submission|work|paper|code|argument)\b"),
    ("i", r"\bon a scale (?:of|from) \d+"),
    ("i", r"\bprovide (?:a |detailed )?feedback\b"),
    ("i", r"\bcheck (?:the |this |my )?(?:solution|answer|work|homework|proof)\s+(?:for|and)"),
    ("i", r"\byou must (?:always|never|only|strictly|exactly)\b"),
    ("i", r"\brule(?:s)?:\s*\d+\."),
    ("i", r"\b(?:constraint|instruction|guideline|requirement)s?\s*:\s*(?:\n|1\.|-)"),
    ("i", r"\brespond (?:only |exclusively )?(?:in|with|using) (?:json|xml|yaml|csv|markdown|html|code)\b"),
    ("i", r"\bdo not (?:use|include|mention|add|generate|output|provide|write|say)\b"),
    ("i", r"\byou (?:should|must|shall|will) (?:not |never )?(?:include|output|generate|respond|provide|use)\b"),
    ("i", r"\b(?:generate|produce|come up with|brainstorm|suggest)\s+\d+\s+(?:\w+\s+)?(?:ideas?|names?|titles?|slogans?|taglines?|captions?|headlines?|questions?|examples?|scenarios?|prompts?|alternatives?|variations?|options?)\b"),
    ("i", r"\b(?:write|create|draft|compose|generate)\s+(?:a |an )?(?:cover letter|resignation|recommendation|apology|thank you|invitation|complaint|reference|condolence|congratulation)\s*(?:letter|note|message|email)?\b"),
    ("i", r"\b(?:write|create|generate)\s+(?:a |an )?(?:resume|cv|curriculum vitae|bio(?:graphy)?|profile|portfolio)\b"),
    ("i", r"\b(?:classify|categorize|label|tag|annotate|segment|cluster)\s+(?:the |this |these |each |every )?(?:text|sentence|document|review|comment|tweet|post|data|sample|record)\b"),
    ("i", r"\b(?:extract|identify|detect|recognize|find)\s+(?:the |all |every )?(?:entities|keywords?|topics?|sentiments?|intents?|named entities|relations?)\b"),
    ("i", r"\bsentiment (?:analysis|classification|detection|scoring)\b"),
    ("i", r"\bnamed entity (?:recognition|extraction|tagging)\b"),
    ("i", r"\btopic (?:modeling|classification|extraction|detection)\b"),
    ("i", r"\btext (?:classification|clustering|summarization|generation|mining|preprocessing)\b"),
    ("i", r"\bwhat (?:kind|type) of (?:AI|model|assistant|bot|system) are you\b"),
    ("i", r"\bwhat (?:are|is) your (?:capabilities?|limitations?|strengths?|weaknesses?|features?)\b"),
    ("i", r"\b(?:who|what) (?:made|created|trained|built|designed|developed) you\b"),
    ("i", r"\bwhich (?:solution|answer|approach|method|option|response) is (?:better|best|correct|more accurate)\b"),
    ("i", r"\bcompare (?:the |these |both )?(?:\w+ )?(?:solutions?|answers?|approaches?|methods?|responses?)\b"),
    ("i", r"\bselect the (?:best|correct|most accurate|optimal) (?:solution|answer|approach|response)\b"),
    ("i", r"\b(?:explain|teach|tutor|guide|walk) (?:me|us|the student|a student)\s+(?:through|about|how to|the concept|step by step)\b"),
    ("i", r"\bbreak (?:it|this|the problem) down (?:into|for|step)\b"),
    ("i", r"\b(?:hint|clue|scaffolding|guidance)\s*:\s*"),
    ("i", r"\b(?:system prompt|system message|system instruction)\b"),
    ("i", r"\b(?:output format|response format|answer format)\s*:\s*"),
    ("i", r"\breturn (?:the |your )?(?:answer|response|output|result) (?:as|in) (?:a )?(?:json|xml|yaml|csv|table|list|markdown)\b"),
    ("i", r"\bformat (?:the |your )?(?:answer|response|output) (?:as|in|like|using)\b"),
    ("i", r"\byou are (?:a |an )?(?:helpful|friendly|creative|expert|knowledgeable|professional|experienced|senior)\s+(?:assistant|AI|bot|agent|advisor|consultant|writer|editor|programmer|developer|designer)\b"),
    ("i", r"\b(?:your|my) role is\b"),
    ("i", r"\bplay(?:ing)? the role of\b"),
    ("i", r"\b(?:imagine|pretend|assume|suppose) (?:you are|you're|that you)\b"),
    ("i", r"\bact(?:ing)? as (?:a |an |the |if )?\w+"),
    ("i", r"\brespond (?:as if you (?:are|were)|like|as) (?:a |an )\w+"),
    ("i", r"\b(?:continue|resume) (?:the |our |this )?(?:conversation|discussion|chat|dialogue)\b"),
    ("i", r"\b(?:in |from )(?:the |our )?(?:previous|last|earlier) (?:message|response|conversation|turn)\b"),
    ("i", r"\b(?:as I |as we )(?:discussed|mentioned|said|noted|talked about)\b"),
    ("i", r"\b(?:list|enumerate|name|mention|give me|provide)\s+(?:the |all |some |a few )?\d+\s+(?:reasons?|things?|ways?|steps?|benefits?|advantages?|disadvantages?|features?|characteristics?|types?|categories?|methods?|strategies?|techniques?|approaches?|tools?|resources?|books?|articles?|websites?|apps?|products?|services?|companies?|countries?|cities?|languages?|tips?|facts?|myths?|mistakes?|challenges?|problems?|solutions?|principles?|rules?|laws?|theories?|concepts?|ideas?|trends?)\b"),
    ("i", r"\btranslate (?:the (?:following )?|this |these |following )?(?:text|sentence|paragraph|passage|phrase|word|document)\b"),
    ("i", r"\btranslat(?:e|ion)\s+(?:from|into|to)\s+(?:english|french|spanish|german|chinese|japanese|korean|arabic|russian|portuguese|italian|dutch|hindi|bengali|thai|turkish|vietnamese)\b"),
]

BOOLEAN_ANSWERS = ["true", "false", "yes", "no", "t", "f"]

PROOF_KEYWORD = ("i", r"\b(?:proof|prove|qed|shown|demonstrated|established)\b")
PROOF_BLOCK = ("i", r"\\begin\{proof\}|\\end\{proof\}")
PROVE_PROMPT = ("i", r"^\s*(?:prove|show|demonstrate)\s+that\b")
MATH_SYMBOL = ("", r"\$|\\[A-Za-z]+|[0-9]|[=+\-*/^<>]|≤|≥|∑|∫|√")
SENTENCE_MARK = ("", r"[.!?]")

# (flags, pattern): each match is removed
WRAPPERS = [
    ("i", r"^Below is a (?:math|chemistry|physics) question\.?\s*I want you to reason through the steps.*?(?:final answer.*?\\boxed\{?\}?\.?\s*\n?)"),
    ("i", r"^Think step by step\.?\s*put the answer.*?\\boxed\{?\}?\.?\s*\n?"),
    ("i", r"^Solve the following (?:math|chemical|physics|biological) problem step by step\.?\s*The last line.*?\\boxed\{\$Answer\}.*?\n?"),
    ("i", r"^Solve the following math problem\.?\s*Make sure to put the answer.*?\\boxed\{?\}?\.?\s*\n?"),
    ("i", r"^Return your final response within \\boxed\{?\}?\.?\s*\n?"),
    ("i", r"^\s*\\?\{\\?\}\s*\.?\s*\n?"),
    ("i", r"^\s*Question:\s*"),
    ("i", r"^\s*Your (?:entire )?response should.*?\.\s*\n?"),
    ("i", r"^\s*(?:Final Answer Format|Provide|Note):.*?\n"),
    ("i", r"^\s*(?:Solution|Final Answer|Answer)\s*:\s*"),
    ("i", r"^\s*(?:Let us|Let's)\s+(?:solve|reason)\s+step by step\.?\s*"),
    ("i", r"^\s*<(?:think|assistant|user|system)>\s*"),
    ("i", r"^\s*(?:System|User|Assistant)\s*:\s*"),
    ("i", r"^Please reason step by step,?\s*(?:and )?put your final answer within \\boxed\{?\}?\.?\s*\n?"),
    ("i", r"^\s*(?:You are|You're|I want you to (?:act|be|play|serve) as|Act(?:ing)? as|Imagine (?:you are|you're|that you)|Pretend (?:you are|you're|to be)|Assume (?:you are|you're|the role)|Your role is|My role is|Play(?:ing)? the role of|Respond (?:as|like) (?:a |an ))[^.!?\n]{3,80}[.!?]?\s*\n?"),
    ("i", r"^\s*(?:Here is|Here's|Below is|Consider)\s+(?:a|an|the)\s+(?:math |)(?:problem|question|exercise|challenge|task)\s*[:.]?\s*\n?"),
    ("i", r"^\s*(?:I (?:need|want|would like|'d like) you to|Can you (?:please )?|Could you (?:please )?|Would you (?:please )?|Please )\s*"),
    ("i", r"^\s*(?:Answer|Solve|Evaluate|Compute|Calculate|Find|Determine)\s+the\s+following\s*(?:question|problem|expression|equation)?s?\s*[:.]?\s*\n?"),
    ("i", r"\s*(?:Can you help me solve this problem and )?put (?:the|your) final answer (?:inside|within|in) \\boxed\{?\*?\}?\??\s*$"),
    ("i", r"\s*(?:Please )?(?:reason step by step,? and )?put your final answer within \\boxed\{?\*?\}?\.?\s*$"),
    ("i", r"\s*Remember to put your final answer within \\boxed\{?\*?\}?\.?\s*$"),
    ("i", r"\s*Can you help me solve this (?:math )?problem(?:\s+and put (?:the|your) final answer (?:inside|within|in) \\boxed\{?\}?)?\??\s*$"),
    ("i", r"\s*Express your answer as.*$"),
    ("i", r"\s*\(?without quotes\)?\s*where\s*\$Answer\s*is\s*the\s*answer\s*to\s*the\s*problem\.?\s*$"),
    ("i", r"\s*Remember to\s*$"),
    ("i", r"\s*Please reason step by step,?\s*(?:and)?\s*$"),
    ("i", r"\s*Please put the final answer\s*$"),
    ("i", r"\s*Present the answer in La[Tt]e[Xx] format:?\s*\\boxed\{.*?\}\s*$"),
    ("i", r"\s*Answer with a json with the final response.*$"),
    ("i", r"\s*Answer in the format:?\s*\$?\\boxed\{.*?\}\$?\.?\s*$"),
    ("i", r"\s*(?:Final Answer|Answer)\s*:\s*\\boxed\{.*?\}\s*$"),
    ("i", r"\s*Give (?:your|the) final answer in (?:a )?\\boxed\{?\}?\.?\s*$"),
    ("i", r"\s*Make sure to put the answer\s*(?:\(and only (?:the )?answer\)\s*)?(?:inside|within|in) \\boxed\{?\}?\.?\s*$"),
    ("i", r"\s*The answer (?:is|should be) in the format\s*\\boxed\{.*?\}\.?\s*$"),
    ("i", r"\s*(?:Provide|Give|Return) (?:the|your) answer (?:as|in) (?:a )?(?:hex(?:adecimal)?|json|JSON|XML|csv).*$"),
    ("i", r"\s*</(?:think|assistant|user|system)>\s*$"),
    ("i", r"\s*Show (?:your |all )?(?:work|steps?|reasoning|calculations?|process)\.?\s*$"),
    ("i", r"\s*Be (?:concise|precise|thorough|detailed|brief|accurate|careful|clear|specific)\.?\s*$"),
    ("i", r"\s*Think (?:carefully|step by step|about it|through|hard|logically)\.?\s*$"),
    ("i", r"\s*(?:Do not|Don't|Please don't|Please do not)\s+(?:explain|show|include|add|provide|write|give|use).*$"),
    ("i", r"\s*Only (?:give|provide|show|output|return|state) (?:the |your )?(?:answer|result|final answer|number)\.?\s*$"),
    ("i", r"\s*Note\s*:.*$"),
    ("i", r"\s*Important\s*:.*$"),
    ("i", r"\s*Hint\s*:.*$"),
    ("i", r"\s*(?:\[/?INST\]|<<?/?SYS>>?|<\|(?:im_start|im_end|endoftext|pad)\|>)\s*$"),
    ("i", r"^\s*(?:\[/?INST\]|<<?/?SYS>>?|<\|(?:im_start|im_end|endoftext|pad)\|>)\s*"),
]
# lines dropped from either end
NOISE_LINES = [
    ("", r"^\s*```[\w-]*\s*$"),
    ("", r"^\s*diff --git\b"),
    ("", r"^\s*deleted file mode\b"),
    ("i", r"^\s*index [0-9a-f]+\.\.[0-9a-f]+\s+\d+"),
    ("", r"^\s*(?:---|\+\+\+) [ab/].*"),
    ("", r"^\s*@@ .* @@\s*$"),
    ("i", r"^\s*<(?:think|assistant|user|system)>\s*$"),
    ("i", r"^\s*</(?:think|assistant|user|system)>\s*$"),
    ("i", r"^\s*(?:System|User|Assistant)\s*:\s*$"),
]
WRAPPER_ROUNDS = 5

URL = ("i", r"https?://\S+|www\.\S+")
MARKDOWN_IMAGE = ("", r"!\[[^\]]*\]\([^)]+\)")
HTML_IMAGE = ("i", r"<img\b[^>]*>")
BASE64 = ("i", r"data:image/[^;]+;base64,[A-Za-z0-9+/=]+")
POINTS = ("i", r"\(\s*\d+\s*points?\s*\)")
CJK = ("", r"[\u3400-\u4DBF\u4E00-\u9FFF\u2E80-\u2EFF\u3000-\u303F\uF900-\uFAFF\U00020000-\U0002A6DF]")
OTHER_SCRIPT = ("", r"[\u0400-\u052F\u0590-\u05FF\u0600-\u06FF\u0750-\u077F\u08A0-\u08FF\u0900-\u097F\u0980-\u09FF\u0A80-\u0AFF\u0B00-\u0B7F\u0B80-\u0BFF\u0C00-\u0C7F\u0C80-\u0CFF\u0D00-\u0D7F\u0E00-\u0E7F\u0E80-\u0EFF\u10A0-\u10FF\u1100-\u11FF\u3040-\u30FF\uAC00-\uD7AF]")
INLINE_OPTION = ("is", r"(?:^|\n)\s*\(?\s*A\s*[\).:]\s*.+?\(?\s*B\s*[\).:]\s*.+?(?:\(?\s*C\s*[\).:]\s*.+?)?")
COMPACT_OPTION = ("i", r"(?:^|\s)\(?\s*(?:A|B|C|D|E|F)\s*[\).:]\s*[^\n]{1,120}(?=(?:\s+\(?\s*(?:A|B|C|D|E|F)\s*[\).:])|\s*$)")
ANSWER_LETTER = ("i", r"\b([A-F])\b")
OPTION_LINE = ("", r"(?im)^[\(\[]?\s*([A-F])[\)\].:-]\s*(.+?)\s*(?=^[\(\[]?\s*[A-F][\)\].:-]\s*|\Z)")
SELECT_ALL = ("i", r"\b(?:select|choose)\s+all\b")
NEGATIVE_CHOICE = ("i", r"\bwhich\s+(?:is|are)\s+not\b")
WHICH_OF = ("i", r"\bwhich of the (?:following|above)\b")
WHICH_OF_THESE = ("i", r"\bwhich of these\b")
ROMAN_MARKER = ("im", r"^\s*(?:\(?[ivx]+\)?[\).:-]|\(?\d+\)?[\).:-])\s+")
NONE_OR_ALL = ("i", r"\b(?:none|all)\s+of\s+the\s+above\b")
CROSS_OPTION = ("i", r"\bboth\s+[A-F]\s+and\s+[A-F]\b|\b[A-F]\s+and\s+[A-F]\b")
INDETERMINATE = ("i", r"\bcannot be determined\b|\bnot enough information\b|\binsufficient\b")
LATEX_OPTION = ("im", r"(?:\\textbf\s*\{?\s*\(?\s*([A-F])\s*\)?\s*\}?|\\text\s*\{?\s*\(?\s*([A-F])\s*\)?\s*\}?)\s*\\?\s*(.+?)(?=\\textbf|\\text\s*\{|$)")
OPTIONS_HEADER = ("i", r"\bthe options are\s*:")
COMPACT_MARKER = ("i", r"\([A-F]\)|\b[A-F][\).:]")

# code points that are removed as invisible, beside control characters
INVISIBLE = [0x00AD, 0x034F, 0x061C, 0x180E, 0x200B, 0x200C, 0x200D, 0x200E, 0x200F, 0x2060, 0x2066, 0x2067, 0x2068, 0x2069, 0xFEFF]
# one character each, and what it becomes
PUNCTUATION = [
    ("\u2018", "'"),
    ("\u2019", "'"),
    ("\u201b", "'"),
    ("\u2032", "'"),
    ("\u201c", '"'),
    ("\u201d", '"'),
    ("\u201f", '"'),
    ("\u2033", '"'),
    ("\u2010", '-'),
    ("\u2011", '-'),
    ("\u2012", '-'),
    ("\u2013", '-'),
    ("\u2014", '-'),
    ("\u2015", '-'),
    ("\u2212", '-'),
    ("\u2026", '...'),
    ("\u00a0", ' '),
]

# ignoring case
TRANSLATION = [
    r"translate the (?:above )?text into english",
    r"retain the original text's line breaks",
    r"output the translation result directly",
    r"untranslated (?:part|text|portion)",
    r"the translation is the same as the original",
    r"translated as requested",
    r"preserv(?:e|ing) the original (?:text's )?format",
]
MATH_INSTRUCTION = ("i", r"\b(?:solve|find|determine|evaluate|prove|simplify|calculate|compute|show that|how many|what is the (?:value|sum|product|remainder|probability))\b")
MATH_OBJECT = ("i", r"\b(?:equation|inequality|integer|polynomial|probability|triangle|circle|rectangle|polygon|matrix|determinant|derivative|integral|limit|sequence|series|permutation|combination|divisor|prime|modulo|hypotenuse|midpoint|diameter|radius|vertex|vertices|arithmetic|geometric|binomial|factorial|logarithm)\b")
NON_MATH_CODE = ("i", r"\breact\b|\btypescript\b|\bjavascript\b|\bpython (?:program|script|code|class|function)\b|\bcode snippet\b|\bgenerate an executable\b|\bfunction that (?:takes|returns|accepts)\b|\bhtml\b|\bcss\b|\bjson\b|\bxml\b|\bapi\b|\bhttp\b|\bcomponent\b|\bwebpack\b|\bnpm\b|\bpip install\b|\bclass \w+\s*[({]|\bdef \w+\s*\(|\bimport \w+|\bconsole\.log\b|\bprint\s*\(|\brust\b|\bf#\b|\bc\+\+\b|\bbash\b|\bshell\b|\bsql\b|\bdatabase\b|\bpostgresql\b|\bmysql\b|\bdocker\b|\bkubernetes\b|\bcompetitive programming\b|\bimplementation in\b|\bcode block\b|\bcode review\b|\bwrite (?:a |an )?(?:program|script|function|class|method|code|paper|essay|poem|story|report|letter|article|blog|email|proposal|review|summary|speech|song|paragraph|prompt|query|test|unit test|VBA|macro|regex|sql|rule|policy|specification|contract|recipe|tutorial|guide|manual|dialogue|outline|hypothesis|thesis|dissertation|critique|memo|note|message|notification|announcement|invitation|press release|newsletter|whitepaper)\b|\bcreate (?:a |an )?(?:class|program|function|script|method|table|chart|dashboard|diagram|visualization|model|pipeline|workflow|template|spreadsheet|database|schema|index|view|trigger|procedure|API|endpoint|component|module|package|library|framework|interface|service|application|website|page|form|survey|quiz|test|report|presentation|infographic|poster|flyer|brochure|banner|logo|mockup|wireframe|prototype|storyboard|animation|video|playlist|schedule|plan|roadmap|strategy|budget|forecast|persona|profile|portfolio)\b|\bdesign (?:a |an )?(?:class|system|architecture|schema|database|API|interface|layout|page|form|template|component|module|service|pipeline|workflow|algorithm|data structure|protocol|pattern|experiment|study|survey|curriculum|syllabus|lesson plan)\b|\bbuild (?:a |an )?(?:class|function|system|application|website|dashboard|pipeline|model|API|service|module|tool|bot|agent|crawler|scraper|parser|compiler|interpreter|simulator|emulator)\b|\bconstruct (?:a |an )?(?:class|function|program|query|regex|table|view|schema|pipeline|workflow|model|proof|argument)\b|\bimplement (?:a |an )?(?:function|class|method|algorithm|system|module|component|service|API|interface|protocol|pipeline|solution|feature|handler|middleware|decorator|observer|factory)\b|\bExpected Time Complexity\b|\bExpected Auxiliary Space\b|\bInput Format\b|\bOutput Format\b|\bSample Input\b|\bSample Output\b|\bstdin\b.*\bstdout\b|\bsolve the following coding problem\b|\bsolve the following problem using\b.*\b(?:python|java|c\+\+|rust|go|lisp)\b|\bconvert this code\b|\btranslate this code\b|\brefactor\b.*\bcode\b|\bdebug\b.*\bcode\b|\bdata structure\b|\blinked list\b|\bbinary tree\b|\bhash map\b|\bsorting algorithm\b|\btime complexity\b|\bspace complexity\b|\bunit test\b|\btest case\b|\berror handling\b|\bjava\b(?!script)|\bruby\b|\bscala\b|\bswift\b|\bkotlin\b|\bperl\b|\bphp\b|\bdjango\b|\bflask\b|\bspring\b|\bangular\b|\bvue\b|\bnextjs\b|\btensorflow\b|\bpytorch\b|\bscikit\b|\breturn (?:a |the )?(?:list|dict|array|string|tuple|boolean)\b|\biterable\b|\bgenerator\b|\bdecorator\b|\bcallback\b|\btype hints?\b|\bedge cases?\b|```(?:python|java|javascript|typescript|ruby|php|cpp|c\+\+|rust|go|swift|kotlin|scala|sql|bash|shell|csharp|c#|erlang|haskell|lua|perl|r\b|matlab|objective-c|dart|groovy|elixir|clojure|fortran|assembly|vb|visual basic|powershell|zig|nim|ocaml|racket|scheme|lisp|prolog|cobol|ada|fsharp|vhdl|verilog|tcl|awk|sed)\b|\bport this code\b|\btranslate this (?:code|snippet)\b|\bconvert this (?:code|snippet)\b|\bpredict the output\b|\bgiven (?:the |this )?code\b.*\boutput\b|\bImplement a (?:Python|Java|C\+\+|Rust|Go|Ruby|PHP|Swift|Kotlin) (?:program|class|function|method|script)\b|\bCreate a (?:Python|Java|C\+\+|Rust|Go) (?:program|script|class)\b|\bmodify (?:a |the )?code\b|\badapt(?:ed)? code\b|\breturn the adapted code\b|\bretrieve and repeat the exact described function\b|\bcode context\b|\btool output\b|\bcli transcript\b|\bdiff --git\b|\bdeleted file mode\b|\bterminal output\b|\bpatch file\b|\bfunction '?\w+'?\s*,?\s*which manipulates\b")
NON_MATH_GENERAL = ("i", r"\b(?:summary|summarize|email|recipe|story|essay|paragraph|article|recommend|career|manager|partner|charity|food bank|stage fright|social media|marketing|customer service|cover letter|resume|roleplay|fanfic|storytelling|creative writing|describe the landscape|how are you feeling|remote workers?|code reviews?|best practice|seo|keywords for instagram|amazon store|law school|guitar|customers?|products?|edit (?:this|the) (?:text|paragraph|sentence)|your (?:entire )?response should|answer the following question\b.*\b(?:capable|classify)|workout|exercise routine|yoga|grad school|university admission|youtube channel|podcast|blog post|etsy|shopify|e-commerce|instagram|tiktok|twitter|facebook|breaking news|journalism|car enthusiast|car restoration|real estate|stock market|cooking|ingredient|travel guide|travel itinerary|fashion|beauty|makeup|mental health|therapy|counseling|restructuring|revenue.*(?:AI|machine learning|business)|codename|project release|transitional phrase|improve (?:this|the) sentence|rewrite (?:this|the) (?:text|sentence|paragraph)|paraphrase|proofread|grammar|what (?:are|is) (?:the )?(?:best|most important) (?:factors?|tips?|ways?)|how (?:can|should) (?:I|we|a company)|launch (?:a|an|my) (?:channel|platform|business|startup)|presentation tips|slide deck|job (?:search|interview|application)|make a note for|write a self introduction|sustainable construction|novel.*material|explain the characteristics of|ratio scale of measurement|love language|marriage counselor|youtube video|youtube channel|movie titles|video tags|annotation platform|feature request|product requirement|interrogation-style technique|traduit en anglais|translate into english|family member to open up|what is one nation conservatism|write (?:a |an |the )?(?:paper|essay|report|letter|email|blog|post|speech|song|poem|story|review|summary|script|dialogue|memo|note|invitation|announcement|press release|newsletter|whitepaper|proposal|contract|policy|manual|guide|tutorial|critique|thesis|dissertation|outline|hypothesis|message|notification|brochure|flyer|poster|introduction|conclusion|abstract|biography|profile|description|response|answer|reply|comment|feedback|testimonial|caption|tagline|slogan|headline|title|subtitle|blurb|excerpt|foreword|preface|afterword|appendix|acknowledgement|dedication|epigraph|glossary|bibliography|index|syllabus|lesson plan|curriculum|case study|analysis report|research proposal|business plan|marketing plan|project plan|grant proposal|cover letter|resignation letter|recommendation letter|thank you note|condolence message|congratulation message|apology letter|complaint letter|reference letter)\b|(?:your|my) role is\b|you are acting as\b|(?:imagine|pretend|assume) you (?:are|were)\b|act as (?:a |an |the )?\w+|play the role of\b|respond (?:as|like) (?:a |an )\w+|you(?:'re| are) (?:a |an )(?:helpful|friendly|creative|expert|professional|senior|experienced)\b|classify (?:the |this |these )?(?:text|sentence|review|comment|tweet|post|document)|sentiment (?:analysis|classification)|named entity recognition|text classification|topic modeling|extract (?:keywords?|entities|topics|information|data) from|generate (?:a |an )?(?:title|headline|caption|summary|tagline|slogan|description|name|username|password|hashtag|keyword|tag)\b|respond in (?:exactly )?\d+ (?:words?|sentences?|paragraphs?|bullets?|points?)|keep (?:your |the )?(?:response|answer|reply) (?:under|within|to) \d+|use (?:only |exactly )?\d+ (?:words?|sentences?|paragraphs?)|in (?:no more|at most|at least|exactly) \d+ (?:words?|sentences?)|limit (?:your |the )?(?:response|answer|output) to\b|format (?:your |the )?(?:response|answer|output) as\b|provide (?:your |the )?(?:response|answer) in (?:bullet|numbered|list|table) form|how are you\b|what do you think about\b|tell me (?:about yourself|a joke|something interesting|a fun fact)|what(?:'s| is) your (?:name|opinion|favorite|favourite)|do you (?:like|enjoy|prefer|have|know|think)\b|(?:give|provide|offer|share) (?:me |us )?(?:some |a few |several )?(?:tips?|advice|suggestions?|recommendations?|ideas?|examples?)\b.*(?:for|on|about|to|regarding) (?:my|our|the|a|an|your)\b|(?:help|assist) me (?:with |in )?(?:writing|drafting|composing|preparing|creating|making|designing|planning|organizing|managing)\b|legal (?:advice|opinion|analysis|document|contract|brief|case|precedent)|(?:medical|clinical|health) (?:advice|diagnosis|treatment|symptom|condition)|(?:financial|investment|tax|accounting) (?:advice|analysis|plan|strategy|report)|political (?:science|analysis|opinion|debate|party|campaign)|(?:history|historical) (?:event|figure|period|analysis|context)|(?:philosophy|philosophical) (?:argument|analysis|perspective|thought)|(?:psychology|psychological) (?:analysis|theory|concept|experiment)|(?:geography|geographical) (?:feature|location|region|country|city)|(?:music|musical) (?:theory|composition|arrangement|analysis|instrument)|(?:art|artistic) (?:style|movement|technique|criticism|analysis|medium)|(?:literature|literary) (?:analysis|criticism|device|technique|genre|movement)|(?:religion|religious) (?:belief|practice|text|tradition|doctrine)|(?:sports?|athletic) (?:training|strategy|analysis|statistics|rule)|(?:nutrition|dietary) (?:advice|plan|requirement|supplement|intake)|(?:agriculture|farming) (?:technique|practice|crop|soil|irrigation)|(?:architecture|architectural) (?:style|design|plan|feature|element)|(?:engineering) (?:design|analysis|system|process|specification)|(?:environmental|ecology|ecological) (?:impact|analysis|conservation|issue)|(?:economic|economics) (?:analysis|theory|policy|model|indicator)|(?:sociology|sociological) (?:theory|analysis|concept|study|research)|explain (?:the |a )?(?:difference|concept|idea|theory|history|meaning|significance|purpose|importance|impact|effect|cause|reason|process|mechanism|principle|law|rule|regulation|policy|advantage|disadvantage|benefit|drawback|pro|con|role|function|responsibility|duty)\s+(?:of|between|behind|in)\b|translate (?:this|the|these|following)?\s*(?:text|sentence|paragraph|word|phrase|document|page|passage|excerpt|quote)\b|(?:from|into|to) (?:english|french|spanish|german|chinese|japanese|korean|arabic|russian|portuguese|italian|dutch|hindi|bengali|thai|turkish|vietnamese|polish|czech|swedish|danish|norwegian|finnish|greek|hebrew|romanian|hungarian|indonesian|malay|tagalog|swahili|persian|urdu)\b|argue (?:for|against|that)\b|what are the (?:pros? and cons?|advantages? and disadvantages?)\b|(?:is it|should we|should I|do you think) (?:ethical|moral|right|wrong|fair|just)\b|discuss (?:the |whether |if )\b)\b")
NON_MATH_STEM = ("i", r"\b(?:chemical|chemistry|reaction|synthesis|compound|molar mass|titrat|solvolysis|epoxidation|hydrogenation|decarboxylation|nmr|hplc|ftir|spectroscopy|chromatograph|distillation|anhydride|nucleophil|electrophil|enantiomer|diastereomer|stereoisomer|oxidation state|electron|quantum|photon|wavelength|doppler|gravitational|angular momentum|spin|magnetic|electromagnetic|nuclear|fusion reactor|fission|radioactiv|biological|organism|protein|enzyme|gene|genome|dna|rna|mutation|allele|phenotype|genotype|cytochrome|medical|clinical|diagnos|symptom|patient|biopsy|pharmacolog|drug|dosage|antenatal|pendulum|friction|torque|velocity|acceleration|thermodynamic|enthalpy|entropy|gibbs free energy|clapeyron|refractive index|reflectivity|diffraction|fluid dynamics|viscosity|reynolds|bernoulli|circuit|resistor|capacitor|inductor|impedance|permeability|permittivity|dielectric|electric field|magnetic field|Lorentz|Maxwell.*equation|Schrodinger|special relativity|general relativity|Newton(?:'s)? (?:law|second law|third law)|projectile|free ?fall|kinetic energy.*potential energy|electric potential|wavefunction|quantum number|orbital.*electron|spectral (?:slope|line|emission)|conducting sphere|capacitance|EMF.*induced|Faraday|redshift|absorption.*spectrum|molecular weight|molarity|concentration.*(?:M|mol/L)|acid[- ]base|neutralization|hydrolysis|precipitat|saturated solution|K_?sp|solubility product|reaction rate|rate constant|activation energy|lewis (?:acid|base|structure)|VSEPR|hybridization.*(?:sp|sp2|sp3)|halogen|halide|pseudohalide|phenol|sodium phenate|CRISPR|sgRNA|gene knockout|Hi-C|enhancer-promoter|chromatin|antibody|antigen|immuno|histopathology|carcinoma|tumor|breast cancer|BRCA|perineal|obstetric|diffusion capacity|lung condition|renal|hepatic|cardiac|DNA probe|nucleotide.*polymorphism|biological (?:sample|marker|pathway)|neutrino|quark|Higgs|Boltzmann.*distribution|ionization.*(?:energy|constant)|pH.*(?:solution|buffer))\b")
CHAT_TRANSCRIPT = ("im", r"^\s*(?:system|user|assistant)\s*:|<\s*(?:system|user|assistant|think)\s*>|\b(?:follow|obey)\s+(?:the )?system rules\b")
MATH_ROLE = ("i", r"\b(?:math(?:ematic(?:s|ian))?|statistic(?:s|ian)|actuary|tutor|professor|teacher|instructor|lecturer|solver|logician)\b")
STRONG_CODE = ("i", r"\bwrite (?:a |an )?(?:python|java|c\+\+|rust|go|ruby|php) (?:program|function|class|script|method)\b|\b(?:python|java|c\+\+|rust|go|ruby|php) (?:program|function|class|script) (?:that|which|to)\b|\bcreate (?:a |an )?(?:python|java|c\+\+|rust|go) (?:program|function|class|script|method)\b|\bimplement (?:a |an )?(?:python|java|c\+\+|rust|go) (?:program|function|class|script|method)\b|\bsolve the following (?:coding|programming) problem\b|```(?:python|java|javascript|typescript|ruby|php|cpp|c\+\+|rust|go|swift|kotlin|scala|sql|bash|shell|csharp|erlang|haskell|lua|perl|vb|visual basic|powershell)\b|\bport this code\b|\btranslate this code\b|\bconvert this code\b|\bpredict the output of\b.*\bcode\b|\bgiven (?:the |this )?code\b.*\b(?:output|what (?:does|will|is))\b|\bfunction '?\w+'?\s*,?\s*which manipulates\b|\bcompetitive programming problem\b|\bmodify (?:a |the )?code file\b|\breturn the adapted code\b")
# (flags, pattern): the first group is the role
ROLES = [
    ("i", r"\byou are (?:a |an |the )?(\w[\w\s]{0,30}?)(?:\.|,|\band\b|who\b|$)"),
    ("i", r"\byou'?re (?:a |an |the )?(\w[\w\s]{0,30}?)(?:\.|,|\band\b|who\b|$)"),
    ("i", r"\b(?:your|my) role is (?:a |an |the |to be (?:a |an )?)?(\w[\w\s]{0,30}?)(?:\.|,|\band\b|$)"),
    ("i", r"\bact(?:ing)? as (?:a |an |the )?(\w[\w\s]{0,30}?)(?:\.|,|\band\b|$)"),
    ("i", r"\bplay(?:ing)? the role of (?:a |an |the )?(\w[\w\s]{0,30}?)(?:\.|,|\band\b|$)"),
    ("i", r"\b(?:imagine|pretend|assume|suppose) (?:you(?:'re| are)|that you(?:'re| are)|being) (?:a |an |the )?(\w[\w\s]{0,30}?)(?:\.|,|\band\b|$)"),
    ("i", r"\brespond (?:as|like) (?:a |an )?(\w[\w\s]{0,30}?)(?:\.|,|\band\b|$)"),
    ("i", r"\bas (?:a |an )(\w[\w\s]{0,30}?),?\s*(?:your|you should|please|answer|help|solve|write|create|explain)"),
]
PROGRAMMING_PREFIXES = [
    "Generate an executable",
    "Write a program",
    "Write a function",
    "Write a script",
    "Write a class",
    "Write a method",
    "Write code",
    "Write a code",
    "Write the code",
    "Create a function",
    "Create a class",
    "Create a program",
    "Create a script",
    "Build a function",
    "Build a program",
    "Build a system",
    "Build an app",
    "Implement a function",
    "Implement a class",
    "Implement a program",
    "Design a system",
    "Design a class",
    "Design an algorithm",
    "Develop a function",
    "Develop a program",
    "Develop a system",
    "Construct a function",
    "Construct a program",
    "Code a function",
    "Code a program",
    "Write a paper",
    "Write an essay",
    "Write a story",
    "Write a letter",
    "Write a poem",
    "Write a song",
    "Write a speech",
    "Write a report",
    "Write a review",
    "Write a blog",
    "Write an email",
    "Write a proposal",
    "Write a summary",
    "Write a paragraph",
    "Write a dialogue",
    "Write a memo",
    "Write a note",
    "Write a message",
    "Write an article",
    "Draft a letter",
    "Draft a report",
    "Draft an email",
    "Draft a proposal",
    "Draft a memo",
    "Draft a plan",
    "Draft a response",
    "Draft a policy",
    "Compose a letter",
    "Compose an essay",
    "Compose a poem",
    "Compose a story",
    "Compose a song",
    "Compose an email",
    "Compose a message",
]
