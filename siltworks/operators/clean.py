"""Record operators: text rewriting and rule routing, one row in and one row out.

An operator is a function (frame, config) -> frame over canonical records whose JSON columns may be
text or decoded. Routing sets ``training_phase`` and ``filter_tag`` and adds an event to ``trace``;
rows are never removed. Operators that route skip rows that have a phase already, except
``length_filter``, which overwrites. Every rule is a column expression, so a chain of operators is one
projection without a shuffle; only rewriting to a fixpoint and composition use Arrow batches.

Nulls count as blank. The order of the rules decides; the first that matches gives the reason.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks import schema
from siltworks.functions import rules, text, tokens

Operator = Callable[..., DataFrame]
PROCESSORS: dict[str, Operator] = {}


def processor(name: str) -> Callable[[Operator], Operator]:
    """Register an operator under a name for pipelines."""

    def add(f: Operator) -> Operator:
        PROCESSORS[name] = f
        return f

    return add


def event(stage: str, processor: str, status: Column | str, reason: Column | str = "", details: Column | None = None) -> Column:
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(
        F.lit(stage).alias("stage"), F.lit(processor).alias("processor"), as_column(status).alias("status"), as_column(reason).alias("reason_code"),
        F.coalesce(details, F.create_map().cast("map<string,string>")).alias("details") if details is not None else F.create_map().cast("map<string,string>").alias("details"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("created_at"),
    )


def with_event(df: DataFrame, e: Column, when: Column | None = None) -> DataFrame:
    """Append an event to the trace, decoding the trace first where it is text."""
    if "trace" not in df.columns:
        return df
    if dict(df.dtypes)["trace"] == "string":
        df = schema.decode(df, "trace")
    have = F.coalesce(F.col("trace"), F.array().cast(schema.PAYLOADS["trace"]))
    more = F.concat(have, F.array(e.cast(schema.EVENT)))
    return df.withColumn("trace", more if when is None else F.when(when, more).otherwise(have))


def col(name: str) -> Column:
    return text.or_blank(F.col(name))


def first_reason(c: Column, table: list[tuple[str, str, str]], low: Column | None = None) -> list[Column]:
    """For each (flags, pattern, reason) the reason where it matches, to be coalesced in order."""
    return [F.when(text.matches(c, p, f, low), F.lit(r)) for f, p, r in table]


def with_low(df: DataFrame, c: Column) -> DataFrame:
    """Adds ``_low``: the text folded, for ``text.matches``, made once a row."""
    return df.withColumn("_low", F.when(col("training_phase") == "", text.folded(c)))


def route(df: DataFrame, name: str, verdict: Column, status: str, guarded: bool = True, silent_skip: bool = False) -> DataFrame:
    """Apply a verdict: null, or a struct (phase, tag, reason).

    The verdict is its own column first, so that its patterns are tested once a row.
    """
    active = (col("training_phase") == "") if guarded else F.lit(True)
    df = df.withColumn("_verdict", F.when(active, verdict))
    hit = F.col("_verdict").isNotNull()
    state = F.when(hit, status).when(active, "kept").otherwise("skipped")
    details = F.when(hit, F.create_map(F.lit("filter_tag"), F.col("_verdict.tag"))).when(~active, F.create_map(F.lit("training_phase"), col("training_phase")))
    df = with_event(df, event("clean", name, state, F.coalesce("_verdict.reason", F.lit("")), details), active if silent_skip else None)
    return df.withColumns({"training_phase": F.when(hit, F.col("_verdict.phase")).otherwise(col("training_phase")), "filter_tag": F.when(hit, F.col("_verdict.tag")).otherwise(col("filter_tag"))}).drop("_verdict")


def verdict(when: Column, phase: str, tag: Column | str, reason: Column | str = "") -> Column:
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.when(when, F.struct(F.lit(phase).alias("phase"), as_column(tag).alias("tag"), as_column(reason).alias("reason")))


# ---- rewriting ----


@processor("text_normalize")
def text_normalize(df: DataFrame, normalize_punctuation: bool = True) -> DataFrame:
    """Composed, printable, half-width text with plain punctuation, in question and answers."""
    names = ["question", "raw_dataset_answer", "confirmed_answer"]
    return with_event(df.withColumns({n: text.normalize_text(col(n), normalize_punctuation) for n in names}), event("clean", "text_normalize", "kept"))


def _flags(f: str) -> int:
    return sum({"i": re.I, "m": re.M, "s": re.S}[x] for x in f)


def unwrap(question: str) -> str:
    """Instructions and chat tags around a question removed, until nothing changes."""
    wrappers = [re.compile(p, _flags(f)) for f, p in rules.WRAPPERS]
    noise = [re.compile(p, _flags(f)) for f, p in rules.NOISE_LINES]
    is_noise = lambda line: any(p.search(line) for p in noise)
    now = question
    for _ in range(rules.WRAPPER_ROUNDS):
        before = now
        for p in wrappers:
            now = p.sub("", now)
        lines = now.splitlines()
        first = next((i for i, x in enumerate(lines) if not is_noise(x)), len(lines))
        last = next((i for i in range(len(lines), first, -1) if not is_noise(lines[i - 1])), first)
        now = "\n".join(lines[first:last]).strip()
        if now == before:
            break
    return now if now != question.strip() else question


@F.pandas_udf(T.StringType())
def _unwrapped(questions: pd.Series) -> pd.Series:
    return questions.map(unwrap)


@processor("instruction_wrapper_cleaner")
def instruction_wrapper_cleaner(df: DataFrame) -> DataFrame:
    """An ordered fixpoint over patterns: not expressible as a column expression, so in Arrow batches."""
    df = df.withColumn("_new", _unwrapped(col("question")))
    changed = (F.col("_new") != col("question")).cast("string")
    df = with_event(df, event("clean", "instruction_wrapper_cleaner", "kept", "", F.create_map(F.lit("wrapper_stripped"), changed)))
    return df.withColumn("question", F.col("_new")).drop("_new")


@processor("text_cleaning")
def text_cleaning(df: DataFrame) -> DataFrame:
    df = df.withColumn("question", text.format_text(text.clean_urls_and_images(col("question"))))
    return with_event(with_event(df, event("clean", "clean_urls_and_images", "kept")), event("clean", "format_text", "kept"))


# ---- routing ----


@processor("prompt_contamination_filter")
def prompt_contamination_filter(df: DataFrame) -> DataFrame:
    """Solutions, chat turns and answers inside the question."""
    q, df = text.strip(col("question")), with_low(df, col("question"))
    table = [F.when(text.matches(q, p, f, F.col("_low")), F.struct(F.lit(t).alias("tag"), F.lit(r).alias("reason"))) for f, p, t, r in rules.PROMPT_CONTAMINATION]
    nq, na = text.normalize_answer(q), text.normalize_answer(col("raw_dataset_answer"))
    cue = F.lit(False)
    for c in rules.ANSWER_CUES:
        cue = cue | F.contains(nq, F.lit(c))
    overlap = F.when((F.length(na) >= 8) & F.contains(nq, na) & cue, F.struct(F.lit("answer_leakage").alias("tag"), F.lit("answer_overlap").alias("reason")))
    df = df.withColumn("_found", F.when(col("training_phase") == "", F.coalesce(*table, overlap)))
    return route(df, "prompt_contamination_filter", verdict(F.col("_found").isNotNull(), "midtrain", F.col("_found.tag"), F.col("_found.reason")), "routed").drop("_found", "_low")


@processor("missing_context_filter")
def missing_context_filter(df: DataFrame) -> DataFrame:
    """References to what isn't there, missing targets, broken formats."""
    q, df, low = text.strip(col("question")), with_low(df, col("question")), F.col("_low")
    missing = first_reason(q, rules.MISSING_CONTEXT, low) + first_reason(q, rules.UNDERSPECIFIED, low)
    broken = first_reason(q, rules.BROKEN_FORMAT, low)
    count = lambda c: F.length(q) - F.length(F.replace(q, F.lit(c), F.lit("")))
    for left, right, what in (("(", ")", "parentheses"), ("[", "]", "brackets"), ("{", "}", "braces")):
        broken.append(F.when((count(left) != count(right)) & (F.length(q) < 400), F.lit(f"unbalanced_{what}")))
    pair = lambda tag: lambda r: F.when(r.isNotNull(), F.struct(F.lit(tag).alias("tag"), r.alias("reason")))
    df = df.withColumns({"_missing": F.when(col("training_phase") == "", F.coalesce(*missing)), "_broken": F.when(col("training_phase") == "", F.coalesce(*broken))})
    df = df.withColumn("_found", F.coalesce(pair("missing_context")(F.col("_missing")), pair("broken_format")(F.col("_broken"))))
    return route(df, "missing_context_filter", verdict(F.col("_found").isNotNull(), "drop", F.col("_found.tag"), F.col("_found.reason")), "dropped").drop("_missing", "_broken", "_found", "_low")


@processor("length_filter")
def length_filter(df: DataFrame) -> DataFrame:
    return route(df, "filter_short_question_text", verdict(text.is_short(col("question")), "drop", "short_question", "short_question"), "dropped", guarded=False)


@processor("language_filter")
def language_filter(df: DataFrame, other_threshold: float = 0.1, cjk_threshold: float = 0.1) -> DataFrame:
    """Questions in other scripts are dropped, Chinese, Japanese and Korean ones set apart."""
    n = text.script_counts(col("question"))
    # letters of other scripts are counted once a row, and only where there can be any
    df = df.withColumn("_n", F.when((col("training_phase") == "") & ~text.is_ascii(col("question")), F.struct(*(n[k].alias(k) for k in ("total", "cjk", "latin")))))
    other = F.col("_n.total") - F.col("_n.latin") - F.col("_n.cjk")
    share = lambda k: F.when(F.coalesce("_n.total", F.lit(0)) == 0, 0.0).otherwise(k / F.col("_n.total"))
    v = F.coalesce(verdict(share(other) >= other_threshold, "drop", "other_non_english", "other_non_english"), verdict(share(F.col("_n.cjk")) >= cjk_threshold, "midtrain", "chinese", "chinese"))
    return route(df, "language_filter", v, "dropped").drop("_n")


#: The large vocabularies of tasks that aren't mathematics, as (flags, pattern). ``math_filter`` takes others in their place.
VOCABULARIES: dict[str, tuple[str, str]] = {"code": rules.NON_MATH_CODE, "general": rules.NON_MATH_GENERAL, "stem": rules.NON_MATH_STEM}


def _non_math_role(c: Column, low: Column) -> Column:
    """Some role pattern's first match names a role outside mathematics."""
    out = F.lit(False)
    for f, p in rules.ROLES:
        groups = re.compile(p).groups
        role = F.regexp_extract(c, text.java(p, f), groups if groups == 1 else 1)
        out = out | (text.matches(c, p, f, low) & ~text.matches(role, rules.MATH_ROLE[1], rules.MATH_ROLE[0]))
    return out


@processor("math_filter")
def math_filter(df: DataFrame, vocabularies: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Records that aren't mathematics, by question and reasoning together."""
    v = {**VOCABULARIES, **(vocabularies or {})}
    reasoning = F.lit("")
    if "distillation" in df.columns:
        if dict(df.dtypes)["distillation"] == "string":
            d = F.from_json("distillation", schema.PAYLOADS["distillation"])
        else:
            d = F.col("distillation")
        reasoning = F.coalesce(F.array_join(F.transform(F.map_values(d), lambda x: F.coalesce(x["reasoning"], F.lit(""))), "\n"), F.lit(""))
    df = df.withColumn("_text", F.when(col("training_phase") == "", text.strip(F.concat_ws("\n", col("question"), reasoning))))
    c, df, low = F.col("_text"), with_low(df, F.col("_text")), F.col("_low")
    has = lambda t: text.matches(c, t[1], t[0], low)
    translation = F.lit(False)
    for p in rules.TRANSLATION:
        translation = translation | text.matches(c, p, "i", low)
    prefix = F.lit(False)
    for p in rules.PROGRAMMING_PREFIXES:
        prefix = prefix | c.startswith(p)
    df = df.withColumns({"_deep": has(rules.MATH_INSTRUCTION) & has(rules.MATH_OBJECT), "_role": _non_math_role(c, low), "_stem": has(v["stem"]), "_plain": has(v["code"]) | has(v["general"]) | has(rules.CHAT_TRANSCRIPT), "_sure": translation | has(rules.STRONG_CODE) | F.coalesce(prefix, F.lit(False))})
    non_math = F.col("_plain") | F.col("_role")
    drop = F.col("_sure") | F.col("_role") | (non_math & ~F.col("_deep")) | (F.col("_stem") & ~F.col("_deep")) | (F.col("_stem") & non_math)
    return route(df, "math_filter", verdict(drop, "drop", "non_math_signal", "non_math_signal"), "dropped").drop("_text", "_low", "_deep", "_role", "_stem", "_plain", "_sure")


@processor("phantom_reference_filter")
def phantom_reference_filter(df: DataFrame) -> DataFrame:
    either = "|".join(f"(?:{p})" for p in rules.PHANTOM_REFERENCE)
    df = with_low(df, col("question"))
    return route(df, "phantom_reference_filter", verdict(text.matches(col("question"), either, "i", F.col("_low")), "drop", "phantom_reference", "phantom_reference"), "dropped").drop("_low")


@processor("broken_question_filter")
def broken_question_filter(df: DataFrame) -> DataFrame:
    q, df = col("question"), with_low(df, col("question"))
    broken = F.lit(False)
    for f, p in rules.BROKEN_REFERENCE:
        broken = broken | text.matches(q, p, f, F.col("_low"))
    bare = text.strip(text.replace(q, rules.LATEX[1], "", rules.LATEX[0]))
    expression = (F.length(bare) < 30) & ~text.matches(bare, rules.VERB[1], rules.VERB[0])
    v = F.coalesce(verdict(broken, "drop", "broken_reference", "broken_reference"), verdict(expression, "drop", "bare_expression", "bare_expression"))
    return route(df, "broken_question_filter", v, "dropped").drop("_low")


def _unconvertible(question: Column, option: Column) -> list[Column]:
    q, o = text.normalize_answer(question), text.normalize_answer(option)
    has = lambda c, t: text.matches(c, t[1], t[0])
    which = has(q, rules.WHICH_OF) | has(q, rules.WHICH_OF_THESE)
    tests = [
        (which & ~F.contains(q, F.lit("such that")), "blocked_pattern"),
        (has(q, rules.SELECT_ALL), "select_all_pattern"),
        (has(q, rules.NEGATIVE_CHOICE), "negative_choice_pattern"),
        (has(question, rules.ROMAN_MARKER) & which, "enumeration_reference_pattern"),
        (has(o, rules.NONE_OR_ALL), "meta_option_pattern"),
        (has(o, rules.CROSS_OPTION), "cross_option_reference_pattern"),
        (has(o, rules.INDETERMINATE), "indeterminate_option_pattern"),
    ]
    return [F.when(c, F.lit(r)) for c, r in tests]


@processor("mcq_converter")
def mcq_converter(df: DataFrame) -> DataFrame:
    """Multiple choice to open questions where the option can stand alone; the rest is set apart."""
    q, active = col("question"), col("training_phase") == ""
    df = df.withColumn("_options", F.when(active, text.options(q)))
    df = df.withColumns({"_letter": text.answer_letter(col("raw_dataset_answer")), "_stripped": F.when(F.size("_options") > 0, text.strip_option_lines(q))})
    df = df.withColumn("_value", text.option_value(F.col("_options"), F.col("_letter")))
    has = lambda t: text.matches(q, t[1], t[0])
    detected = F.coalesce(
        F.when(has(rules.INLINE_OPTION), F.lit("unstructured_mcq_detected")), F.when(has(rules.LATEX_OPTION), F.lit("latex_mcq_detected")), F.when(text.compact_options(q), F.lit("compact_mcq_detected")),
        F.when(has(rules.OPTIONS_HEADER), F.lit("options_header_detected")), F.when(has(rules.WHICH_OF) | has(rules.WHICH_OF_THESE), F.lit("which_of_without_options")),
    )
    failed = F.coalesce(
        F.when(F.col("_letter") == "", F.lit("answer_letter_missing")), F.when(F.coalesce("_value", F.lit("")) == "", F.lit("answer_letter_not_found_in_options")),
        *_unconvertible(q, F.col("_value")), F.when(F.length("_stripped") < 10, F.lit("question_too_short_after_strip")),
    )
    df = df.withColumn("_reason", F.when(active & (F.size("_options") == 0), detected).when(active, failed))
    convert = active & (F.size("_options") > 0) & F.col("_reason").isNull()
    df = df.withColumn("_convert", convert)
    df = df.withColumns({"question": F.when(F.col("_convert"), F.col("_stripped")).otherwise(q), **{a: F.when(F.col("_convert"), text.strip(F.col("_value"))).otherwise(col(a)) for a in ("raw_dataset_answer", "confirmed_answer")}})
    out = route(df, "convert_to_open_ended", verdict(F.col("_reason").isNotNull(), "midtrain", "boolean_and_mcq", F.col("_reason")), "routed")
    return out.drop("_options", "_letter", "_stripped", "_value", "_reason", "_convert")


@processor("meta_task_filter")
def meta_task_filter(df: DataFrame) -> DataFrame:
    """Tasks about answers, prompts and text. The reason is the first pattern's first 80 characters."""
    q, df = col("question"), with_low(df, col("question"))
    # one pass over the patterns decides; which one it was matters only for the few hits
    any_hit = F.lit(False)
    for f, p in rules.META_TASK:
        any_hit = any_hit | text.matches(q, p, f, F.col("_low"))
    df = df.withColumn("_any", (col("training_phase") == "") & any_hit)
    which = F.coalesce(*(F.when(text.matches(q, p, f), F.lit(p[:80])) for f, p in rules.META_TASK))
    return route(df, "meta_task_filter", verdict(F.col("_any"), "midtrain", "meta_task", F.when(F.col("_any"), which)), "routed").drop("_any", "_low")


@processor("boolean_answer_filter")
def boolean_answer_filter(df: DataFrame) -> DataFrame:
    hit = text.normalize_answer(col("raw_dataset_answer")).isin(rules.BOOLEAN_ANSWERS)
    return route(df, "boolean_answer_filter", verdict(hit, "midtrain", "boolean_and_mcq", "boolean_answer"), "routed")


@processor("answer_quality_filter")
def answer_quality_filter(df: DataFrame) -> DataFrame:
    """Answers that can't be verified: proofs and long plain text. Blank ones are never flagged."""
    a = text.strip(col("raw_dataset_answer"))
    has = lambda t, c=a: text.matches(c, t[1], t[0])
    sentences = F.regexp_count(a, F.lit(rules.SENTENCE_MARK[1]))
    plain = ~has(rules.MATH_SYMBOL)
    reason = F.when(a == "", F.lit(None)).otherwise(F.coalesce(
        F.when(has(rules.PROOF_BLOCK), F.lit("proof_block")), F.when(has(rules.PROVE_PROMPT, col("question")) & (F.length(a) > 200), F.lit("proof_task_long_answer")),
        F.when(has(rules.PROOF_KEYWORD) & ((F.length(a) > 120) | (sentences > 1)), F.lit("proof_keyword_answer")), F.when((F.length(a) > 500) & plain, F.lit("long_plain_text_answer")),
        F.when((sentences > 3) & plain, F.lit("multi_sentence_plain_text_answer")),
    ))
    df = df.withColumn("_reason", F.when(col("training_phase") == "", reason))
    return route(df, "answer_quality_filter", verdict(F.col("_reason").isNotNull(), "midtrain", "non_verifiable_answer", F.col("_reason")), "routed").drop("_reason")


@processor("empty_answer_tagger")
def empty_answer_tagger(df: DataFrame) -> DataFrame:
    return route(df, "empty_answer_tagger", verdict(text.strip(col("raw_dataset_answer")) == "", "midtrain", "empty_ground_truth", "empty_ground_truth"), "routed", silent_skip=True)


# ---- reasoning texts and annotations ----


def _decoded(df: DataFrame, name: str) -> Column:
    return F.from_json(name, schema.PAYLOADS[name]) if dict(df.dtypes)[name] == "string" else F.col(name)


def _plain(t: object) -> str:
    """URLs and images out, lines collapsed: ``text_cleaning`` for one string."""
    t = str(t if t is not None else "")
    for f, p in (rules.URL, rules.MARKDOWN_IMAGE, rules.HTML_IMAGE, rules.BASE64):
        t = re.sub(p, " ", t, flags=_flags(f))
    t = re.sub(rules.POINTS[1], " ", t.replace("\r\n", "\n").replace("\r", "\n"), flags=_flags(rules.POINTS[0]))
    t = "\n".join(re.sub(r"[ \t]+", " ", line).strip() for line in t.splitlines())
    return re.sub(r"\n{3,}", "\n\n", t).strip()


_OTHER_SCRIPTS = re.compile(f"{rules.CJK[1]}|{rules.OTHER_SCRIPT[1]}")


def clean_entry(model: str, payload: dict) -> dict:
    """One model's reasoning and solution, cleaned and tagged."""
    solution, reasoning = _plain(payload.get("solution")), _plain(payload.get("reasoning"))
    tags = [str(t) for t in payload.get("quality_tags") or [] if str(t).strip()]
    cut = not solution if "gpt-oss" in model.lower() else bool(reasoning) and "</think>" not in reasoning
    for tag, found in (("non_english", bool(_OTHER_SCRIPTS.search(f"{solution}\n{reasoning}"))), ("truncated", cut)):
        if found and tag not in tags:
            tags.append(tag)
    return {"model": str(payload.get("model") or model), "solution": solution, "reasoning": reasoning, "quality_status": "invalid" if tags else "valid", "quality_tags": tags}


@F.pandas_udf(T.StringType())
def _cot_cleaned(payloads: pd.Series) -> pd.Series:
    def one(raw: str | None) -> str:
        try:
            got = json.loads(raw or "{}")
        except ValueError:
            return raw
        return json.dumps({m: clean_entry(m, x if isinstance(x, dict) else {}) for m, x in got.items()}, ensure_ascii=False, sort_keys=True) if isinstance(got, dict) else raw

    return payloads.map(one)


@processor("cot_cleaning")
def cot_cleaning(df: DataFrame) -> DataFrame:
    """Reasoning and solution of every model cleaned; other scripts and truncation tagged.

    In Arrow batches over the JSON text: any model may stand there, and nested lambdas over maps
    would grow the plan of a chain beyond what the optimizer handles.
    """
    d = F.to_json("distillation") if dict(df.dtypes)["distillation"] != "string" else F.col("distillation")
    return with_event(df.withColumn("distillation", _cot_cleaned(d)), event("clean", "cot_cleaning", "kept"))


@processor("rule_correctness")
def rule_correctness(df: DataFrame, equivalent: Callable[[Column, Column], Column] | None = None, enforce_keep: bool = False) -> DataFrame:
    """Confirmed answer (or else the raw one) against the raw one; only ``enforce_keep`` removes rows.

    Answers are compared by ``text.same_value`` (texts, numbers, fractions, tuples) unless another
    ``equivalent`` is given.
    """
    same = equivalent or text.same_value
    df = df.withColumn("_same", same(F.coalesce(F.nullif(col("confirmed_answer"), F.lit("")), col("raw_dataset_answer")), col("raw_dataset_answer")))
    ok = F.col("_same")
    out = with_event(df, event("clean", "rule_based_correctness", F.when(ok, "kept").otherwise("dropped"), F.when(ok, "").otherwise("rule_verify_failed")))
    return (out.where(ok) if enforce_keep else out).drop("_same")


def _texts(df: DataFrame) -> Column:
    """All reasoning texts of a record: of the models and of the samples."""
    entries = F.map_values(_decoded(df, "distillation"))
    both = lambda a: F.flatten(F.transform(a, lambda x: F.array(F.coalesce(x["solution"], F.lit("")), F.coalesce(x["reasoning"], F.lit("")))))
    empty = F.array().cast("array<string>")
    return F.concat(F.coalesce(both(entries), empty), F.coalesce(both(_decoded(df, "verification")["samples"]), empty))


@processor("ngram_repetition_filter")
def ngram_repetition_filter(df: DataFrame, repeat_threshold: int = 16, ngram: int = 4, enforce_keep: bool = False) -> DataFrame:
    """Marks records with a text that repeats one n-gram ``repeat_threshold`` times in a row."""

    @F.pandas_udf(T.IntegerType())
    def most(texts: pd.Series) -> pd.Series:
        return texts.map(lambda ts: max((text.longest_repetition((t or "").split(), ngram) for t in ts), default=1))

    df = df.withColumn("_most", most(_texts(df)))
    bad = F.col("_most") >= repeat_threshold
    df = with_event(df, event("clean", "ngram_repetition_filter", F.when(bad, "dropped").otherwise("kept"), F.when(bad, "ngram_repetition").otherwise("")))
    return (df.where(~bad) if enforce_keep else df).drop("_most")


def resolve_text(df: DataFrame, field: str, question_if_blank: bool = True) -> Column:
    """The question, all reasoning texts joined by line ends, or an entry of ``meta``."""
    if field == "question":
        return col("question")
    if field == "cot_text":
        t = F.array_join(F.filter(_texts(df), lambda x: x != ""), "\n")
        return F.when(t == "", col("question")).otherwise(t) if question_if_blank else t
    return F.coalesce(_decoded(df, "meta")[field], F.lit(""))


def _annotate(df: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    meta = F.coalesce(_decoded(df, "meta"), F.create_map().cast("map<string,string>"))
    rest = F.map_filter(meta, lambda k, _: k != key)
    return with_event(df.withColumn("meta", F.map_concat(rest, F.create_map(F.lit(key), value.cast("string")))), event("clean", name, "kept"))


@processor("gzip_ratio_annotator")
def gzip_ratio_annotator(df: DataFrame, field: str = "cot_text", output_key: str = "gzip_ratio") -> DataFrame:
    return _annotate(df, output_key, text.gzip_ratio(resolve_text(df, field)), "gzip_ratio_annotator")


@processor("token_count_annotator")
def token_count_annotator(df: DataFrame, field: str = "question", output_key: str = "token_count", vocabularies: str = tokens.VOCABULARIES) -> DataFrame:
    tokens.share(df.sparkSession, vocabularies)
    return _annotate(df, output_key, text.token_count(vocabularies)(resolve_text(df, field, False)), "token_count_annotator")
