"""Problem 4: broken prompt and response pairs.

Method: two small models trained here on ``documents``.

* Language: a naive Bayes classifier over hashed character trigrams (``BUCKETS`` buckets a
  language). The language posteriors of question and answer are compared; an answer in sentences
  whose posterior is surely another language than the question's is ``other_language``. Formulas,
  markup, numbers and quoted passages are left out first.
* Ends of texts: the likelihood ratio of the last characters (1 to ``SUFFIX``, letters and digits
  by class) under ends of paragraphs against all places inside them (those of a paragraph weigh as
  much together as its end), longest suffix seen often enough first. Prose whose end is more likely
  inside a text is ``truncated_answer``, as is whatever leaves a bracket, formula or operator open.

Refusals, copies of the question and empty answers are told by their form. One defect a record, the
first of: empty_answer, question_copy, refusal, truncated_answer, other_language.

The models are counted over every document with a ``lang``. A language is kept, however rare, if it
explains its own texts better than every other one does, each trigram left out in turn; what another
language explains as well (wrong or doubtful labels) is none of its own. What reaches the driver is
one array of ``BUCKETS`` counts a language, of which more than ``LANGUAGES`` are refused, and the
suffixes seen often enough to be used.

Defined results: a null answer is empty; a null question is never copied and has no language; a
record delivered twice counts once; null ids are skipped; texts are taken whole; with no labelled
document no answer is in another language, and ends are told by punctuation.
"""

from __future__ import annotations

import re
import string
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks import runtime
from siltworks.functions.kernel import Rolling, blocks, codes, mix
from siltworks.llm import p06_markup as markup

BUCKETS = 1 << 16
SUFFIX = 4
#: Times that a suffix of several characters has to be seen to be used.
OFTEN = 20
#: Characters from which a paragraph counts for ends.
PARAGRAPH = 40
LANGUAGES = 1_000
#: Words from which a text is a sentence, not a bare value (a value needs no full stop and has no language).
SENTENCE = 3
#: Nats by which the answer's language has to beat the question's language.
SURE = 6.0

_FORMULA = re.compile(r"\$\$.+?\$\$|\$[^$\n]*\$|\\\[.+?\\\]|\\\(.+?\\\)", re.S)
_LATEX_WORD = re.compile(r"\\[A-Za-z]+")
_QUOTED = re.compile(r"«[^«»]*»|“[^“”]*”|„[^„“”]*[“”]|「[^「」]*」|『[^『』]*』|《[^《》]*》|\"[^\"\n]*\"")
_WORDS = re.compile(r"[^\W\d_]+")
_ALNUM = re.compile(r"[^\W_]+")
_LONG = re.compile(r"(?<![\\\w])[^\W\d_]{2,}")
_CJK = re.compile(r"[㐀-鿿぀-ヿ가-힯]")

# Stand-ins for a missing value, and labels in front of an answer.
_STANDINS = frozenset("null none nan na n/a nil undefined unknown missing tbd tba todo empty blank pending notavailable notgiven notprovided noanswer noanswergiven noanswerprovided notapplicable nosolution-given noresponse answermissing keineantwort unbekannt inconnu pasderéponse sinrespuesta desconocido 无 未知 暂无 无答案 没有答案 待定".split())
_LABEL = re.compile(r"^\s*(?:the\s+)?(?:final\s+|my\s+|correct\s+)?(?:answer|ans|solution|result|response|reply|antwort|lösung|ergebnis|réponse|reponse|solución|respuesta|resultado|答案|答|解答|回答)\s*(?:is)?\s*[:：=]?\s*", re.I)


#: Words of the longest label ("the final correct answer is"), at least those of the longest stand-in.
_MOST_WORDS = 5


def _is_nothing(c: str) -> bool:
    return c in string.punctuation or unicodedata.category(c)[0] in "PZC" or unicodedata.category(c) in ("Mn", "Me", "Sk")


def is_empty(answer: str | None) -> bool:
    """Nothing left but white space, invisible or punctuation characters, empty formulas or a stand-in."""
    if answer is None:
        return True
    if "\\begin" not in answer and len(_LONG.findall(answer)) > _MOST_WORDS:  # more words than any stand-in or label has
        return False
    bare = re.sub(r"\\(?:boxed|text|mathrm|mathbf|fbox|displaystyle|left|right|quad|qquad|begin\{\w+\}|end\{\w+\})(?![A-Za-z])", "", answer)
    kept = "".join(c for c in bare if not _is_nothing(c)).lower()
    if not kept:
        return True
    squeezed = "".join(_ALNUM.findall(bare.lower()))
    if squeezed in _STANDINS or (len(squeezed) < 25 and squeezed in _SQUEEZED):
        return True
    rest = _LABEL.sub("", answer, count=1)
    return rest != answer and ":" in answer + "：".replace("：", ":") and not any(not _is_nothing(c) for c in rest)


_SQUEEZED = frozenset("".join(_ALNUM.findall(s)) for s in _STANDINS)


def _squeeze(text: str) -> str:
    return "".join(_ALNUM.findall(text.lower()))


_LABELS = (
    re.compile(r"(?:^|[\n.?!。？！»”\"])\W*([^\W_][^\n:：?？。=$]*?)\s*(?:[:：]|\s[-–—]\s|\n)"),
    re.compile(r"[\n.?!。？！»”\"]\W*([^\W\d_]{1,12}\s?\d{0,3})\s*[.)\]】|>-]"),
)


def is_copy(question: str | None, answer: str) -> bool:
    """The whole question once or more, and nothing else but labels."""
    if not question:
        return False
    q, a = _squeeze(question), _squeeze(answer)
    if len(q) < 3 or len(a) < len(q) or q not in a:
        return False
    parts = a.split(q)
    if not any(parts):
        return True
    if parts[-1]:
        return False
    # what is left has to be labels: of one sentence, and each ended by a colon, a dash, a line end or (one word) a full stop
    squeezed = {_squeeze(x) for p in _LABELS for x in p.findall("\n" + answer)}
    return all(not p or p in squeezed for p in parts)


_SELF = r"(?:i|we)"
_ENGLISH = (
    rf"\b{_SELF}(?:\s+am|'m|\s+are|'re)\s+(?:sorry|afraid|unable|not\s+(?:able|allowed|permitted|comfortable|in\s+a\s+position|going|willing|designed|programmed|equipped))\b",
    rf"\b{_SELF}\s+(?:really\s+|simply\s+|just\s+|must\s+|have\s+to\s+)?(?:can(?:no|')?t|can\s+not|could\s+not|couldn't|won't|will\s+not|would\s+not|do\s+not\s+(?:have\s+(?:the\s+)?(?:ability|capability|means|permission)|feel\s+comfortable|want\s+to)|don't\s+(?:have\s+(?:the\s+)?(?:ability|capability|means|permission)|feel\s+comfortable|want\s+to|know\s+how)|must\s+(?:decline|refuse|refrain)|refuse|decline)\b",
    rf"\b{_SELF}\s+(?:must|have\s+to|need\s+to|should|would|will)\s+(?:respectfully\s+|politely\s+)?(?:decline|refuse|refrain|pass|abstain)\b",
    rf"\b{_SELF}(?:'d|\s+would)\s+(?:rather|prefer)\s+not\b",
    rf"\b(?:something|a\s+(?:task|question|request|problem))\s+{_SELF}\s+(?:have\s+to|must|need\s+to)\s+(?:decline|refuse|pass)\b",
    rf"\b(?:outside|beyond)\s+(?:of\s+)?(?:what\s+{_SELF}|my|our)\b",
    r"\bmy\s+(?:guidelines|policy|policies|instructions|programming|rules|training)\b.{0,30}\b(?:keep|prevent|stop|forbid|prohibit|do\s+not|don't|bar|disallow)",
    r"\b(?:there\s+is|there's)\s+no\s+way\s+for\s+me\b",
    rf"\b{_SELF}\s+apologi[sz]e\b|^\W*(?:sorry|apologies|unfortunately)\b.{{0,60}}\b(?:{_SELF}|me|my)\b",
    r"\bas\s+an?\s+(?:ai|assistant|language\s+model)\b.{0,60}\b(?:can(?:no|')?t|not|unable|decline|refrain|rather)\b",
    r"\b(?:not|un)\s*able\s+to\s+(?:help|assist|answer|provide|solve|comply)\b",
    r"\b(?:this|that|it)\s+is\s+(?:impossible|not\s+possible)\s+for\s+me\b",
)
_OTHERS = (
    r"(?:抱歉|对不起|很遗憾|不好意思).{0,30}(?:无法|不能|没法|不便|拒绝)|我(?:无法|不能|没法|不便|拒绝|没有办法)(?:回答|提供|解答|帮助|完成|解决|处理)",
    r"\b(?:leider|tut\s+mir\s+leid|entschuldigung|bedaure)\b.{0,80}\b(?:nicht|kein\w*)\b|\b(?:kann|darf|möchte|werde)\s+ich\b.{0,60}\bnicht\b.{0,40}\b(?:helfen|beantworten|lösen|antworten|geben|nennen)|\bich\s+(?:kann|darf|möchte|werde|muss)\b.{0,60}\b(?:nicht|ablehnen|verzichten)\b|\bes\s+ist\s+mir\s+(?:nicht|un)\s*möglich\b|\bich\s+bin\s+(?:leider\s+)?(?:nicht\s+(?:in\s+der\s+lage|befugt|imstande)|außerstande)\b",
    r"\b(?:désolé\w*|malheureusement|je\s+regrette|pardon)\b.{0,80}\b(?:ne|n').{0,20}\b(?:peux|puis|suis|pouvons)\b|\bje\s+ne\s+(?:peux|puis|suis|saurais|pourrai)\b|\bje\s+(?:dois|préfère)\s+(?:refuser|décliner|m'abstenir|ne\s+pas)\b|\bil\s+m'est\s+(?:malheureusement\s+)?impossible\b",
    r"\b(?:lo\s+siento|lamentablemente|por\s+desgracia|perdón|disculp\w+)\b.{0,80}\bno\b|\bno\s+(?:puedo|podré|podemos|me\s+es\s+posible|me\s+siento|estoy\s+autorizad\w)\b|\b(?:debo|tengo\s+que)\s+(?:rechazar|declinar|abstenerme)\b|\bme\s+es\s+imposible\b",
)
_REFUSAL = re.compile("|".join((*_ENGLISH, *_OTHERS)), re.I | re.S)
_RESULT = re.compile(r"\\boxed|\\frac|=|\$")
#: Numbers that name a task, not a result.
_NAMED = re.compile(r"\b(?:problem|question|exercise|task|part|item|number|no|nr|aufgabe|frage|teil|nummer|problème|exercice|partie|numéro|problema|pregunta|ejercicio|parte|número)s?\.?\s*#?\d+(?:\s*(?:,|and|or|to|und|oder|et|ou|y|o|-|–)\s*#?\d+)*|第\s*\d+\s*[题问道章]", re.I)


def is_refusal(text: str) -> bool:
    """Declines at its beginning and gives no result: no formula, and no more than two numbers but those of tasks."""
    head = text.replace("’", "'")
    if not (m := _REFUSAL.search(head)):
        return False
    # two sentences of lead-in at most; later it is part of an argument
    if len(re.findall(r"[.!?。！？]\s|[。！？]", head[: m.start()])) > 2:
        return False
    rest = _NAMED.sub(" ", _QUOTED.sub(" ", text))
    return not _RESULT.search(rest) and len(re.findall(r"\d+", rest)) <= 2


_OPEN = {"(": ")", "[": "]", "{": "}", "«": "»", "“": "”", "（": "）", "【": "】", "《": "》"}
_CLOSE = {v: k for k, v in _OPEN.items()}
_BRACKETS = re.compile("[" + re.escape("".join(_OPEN) + "".join(_CLOSE)) + "]")


def is_open(text: str) -> bool:
    """A bracket or formula begins and isn't closed, or an operator or comma stands last."""
    t = text.rstrip()
    if not t:
        return False
    if re.search(r"\\[A-Za-z]*$", t) and not re.search(r"\\(?:pi|infty|theta|alpha|beta|gamma|phi|emptyset|varnothing|checkmark|square|blacksquare|qed)$", t):
        return True
    dollars = len(re.findall(r"(?<!\\)\$", t))
    if dollars % 2 or t.count("\\[") != t.count("\\]") or t.count("\\(") != t.count("\\)") or t.count("\\begin{") > t.count("\\end{"):
        return True
    if re.search(r"(?:[-+*/=<>^_,，、:：;&]|\\times|\\cdot|\\le|\\ge|\\equiv)$", t) and re.search(r"[^\W_]", t):
        return True
    need: list[str] = []
    half_open = 0
    for c in _BRACKETS.findall(re.sub(r"\\[()\[\]{}]", "", t)):
        if c in _OPEN:
            need.append(c)
        elif c in _CLOSE:
            if need and need[-1] == _CLOSE[c]:
                need.pop()
            elif need and c in ")]" and need[-1] in "([":
                need.pop()  # a half-open interval
            else:
                half_open += 1
    return bool(need)


#: Marks that stand for themselves in the end of a text; rarer ones stand for their category.
_MARKS = frozenset(string.punctuation + "«»“”„’‘。，、；：？！…（）【】《》「」『』–—·")
#: An ellipsis behind a word: what follows is missing.
_ELLIPSIS = re.compile(r"[^\W_](?:\.{3,}|…+)$")


#: Categories of the other characters, as one character of the private use area each.
_CATEGORIES = {c: chr(0xE000 + i) for i, c in enumerate("Cc Cf Cn Co Cs Ll Lm Lo Lt Lu Mc Me Mn Nd Nl No Pc Pd Pe Pf Pi Po Ps Sc Sk Sm So Zl Zp Zs".split())}


@lru_cache(maxsize=None)  # at most a value a code point
def _class(c: str) -> str:
    if c.isdigit():
        return "9"
    if _CJK.match(c):
        return "字"
    if c.isalpha():
        return "A" if c.isupper() else "a"
    return " " if c.isspace() else c if c in _MARKS else _CATEGORIES[unicodedata.category(c)]


#: All classes; a class's place, from 1, is its symbol in the key of a suffix, ``_BITS`` wide, the last character lowest.
_CLASSES = ["9", "字", "A", "a", " ", *sorted(_MARKS), *_CATEGORIES.values()]
_SYMBOLS = {c: i for i, c in enumerate(_CLASSES, 1)}
_BITS = 7
#: What a paragraph's end counts, and all its inside places together.
_ONE = 1 << 30


@lru_cache(maxsize=1)
def _symbol_table() -> np.ndarray:
    """Each code point's symbol, 0 where it hasn't been met."""
    return np.zeros(0x110000, dtype=np.int32)


def _symbols(code: np.ndarray) -> np.ndarray:
    table = _symbol_table()
    for c in np.unique(code[table[code] == 0]):
        table[c] = _SYMBOLS[_class(chr(c))]
    return table[code]


def end_counts(paragraphs: list[str]) -> dict[str, tuple[int, int]]:
    """Suffix -> (at ends, at all places inside), in parts of ``_ONE``.

    A place inside is what is left of a paragraph, without white space at the end, if it breaks off
    after at least five characters and before its last but one.
    """
    out: dict[str, list[int]] = {}
    for _, block in blocks(paragraphs):
        size = np.fromiter(map(len, block), dtype=np.int64, count=len(block))
        symbol = _symbols(codes("".join(block)))
        start = np.repeat((np.cumsum(size) - size).astype(np.int64), size)
        at = np.arange(len(symbol)) - start
        key = symbol.copy()
        for k in range(1, SUFFIX):
            key[k:] |= np.where(at[k:] >= k, symbol[:-k], 0) << (_BITS * k)
        last = np.maximum.accumulate(np.where(symbol != _SYMBOLS[" "], np.arange(len(symbol)), -1))
        left = np.repeat(size, size) - at  # characters from here on
        inside = np.flatnonzero((at >= 4) & (left >= 3) & (last >= start))
        weight = np.repeat(_ONE // np.maximum(size - 6, 1), size)
        keys, which = np.unique(np.concatenate([key[last[inside]], key[left == 1]]), return_inverse=True)
        n = len(inside)
        # sums of integers below 2 ** 53 are exact
        sums = [np.bincount(which[:n], weight[inside], len(keys)), np.bincount(which[n:], minlength=len(keys)) * _ONE]
        for k, inner, end in zip(keys.tolist(), sums[0].astype(np.int64).tolist(), sums[1].tolist(), strict=True):
            s = "".join(_CLASSES[x - 1] for m in reversed(range(SUFFIX)) if (x := k >> (_BITS * m) & ((1 << _BITS) - 1)))
            for m in range(1, len(s) + 1):
                c = out.setdefault(s[-m:], [0, 0])
                c[0] += end
                c[1] += inner
    return {s: (x, y) for s, (x, y) in out.items()}


def ending(text: str) -> str:
    return "".join(map(_class, text.rstrip()[-SUFFIX:]))


class Ends:
    """Log-likelihood ratio of a suffix: end of a text against a place inside one."""

    def __init__(self, counts: dict[str, tuple[float, float]]):
        self.counts = counts
        at = [sum(c[k] for s, c in counts.items() if len(s) == 1) for k in (0, 1)]
        self.total = (at[0] + 1.0, at[1] + 1.0)

    def ratio(self, text: str) -> float:
        s = ending(text)
        if not s:
            return 0.0
        if self.total[0] < 3:  # less than two paragraphs
            return 1.0 if s[-1] in ".!?。！？)]}$\"”»" else -1.0
        for n in range(len(s), 0, -1):
            a, b = self.counts.get(s[-n:], (0, 0))
            if a + b >= OFTEN or (n == 1 and a + b >= 1):  # seen less than once says nothing
                return float(np.log((a + 0.5) / self.total[0]) - np.log((b + 0.5) / self.total[1]))
        return 0.0


def _folded(text: str) -> np.ndarray:
    t = _LATEX_WORD.sub(" ", _QUOTED.sub(" ", _FORMULA.sub(" ", text)))
    return codes(" " + " ".join(_WORDS.findall(t.lower())) + " ")


def _trigrams(text: str) -> np.ndarray:
    code = _folded(text)
    if len(code) < 3:
        return np.zeros(0, dtype=np.int64)
    return (mix(Rolling(mix(code, 41)).grams(3), 42) & np.uint64(BUCKETS - 1)).astype(np.int64)


class Languages:
    """Naive Bayes over hashed trigrams with even priors, of the languages that explain their own texts best."""

    def __init__(self, names: list[str], counts: np.ndarray):
        keep = [i for i in range(len(names)) if self._own(i, counts)]
        self.names, counts = [names[i] for i in keep], counts[keep]
        self.log = np.log((counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)).T.astype(np.float32) if keep else None

    @staticmethod
    def _own(i: int, counts: np.ndarray) -> bool:
        mine, n = counts[i], counts[i].sum()
        some = np.flatnonzero(mine)
        # each occurrence judged by the language without it
        own = (mine[some] * np.log((mine[some] - 0.5) / (n - 1 + 0.5 * BUCKETS))).sum()
        others = (j for j in range(len(counts)) if j != i and counts[j].sum() > n)
        return n > 1 and all((mine[some] * np.log((counts[j][some] + 0.5) / (counts[j].sum() + 0.5 * BUCKETS))).sum() < own for j in others)

    def scores(self, text: str) -> np.ndarray:
        """Log-likelihood of the text under each language, relative to the best."""
        s = self.log[_trigrams(text)].sum(axis=0, dtype=np.float64)
        return s - s.max()


def _train_rows(batches):
    lang_counts: dict[str, np.ndarray] = {}
    ends: dict[str, list[int]] = {}
    for b in batches:
        paragraphs = []
        for lang, text in zip(*(b.column(k).to_pylist() for k in range(2)), strict=True):
            g = _trigrams(text)
            if len(g):
                c = lang_counts.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                c += np.bincount(g, minlength=BUCKETS)
            paragraphs += [p for x in re.split(r"\n\s*\n", text) if len(p := x.rstrip()) >= PARAGRAPH]
        _add(ends, end_counts(paragraphs))
    # a language's counts travel as bytes, one array a partition, to be added up with those of the others
    yield _models_batch({"l" + x: c for x, c in lang_counts.items()}, {"e" + x: c for x, c in ends.items()})


def _add(ends: dict[str, list[int]], more: dict[str, tuple[int, int]]) -> None:
    for key, (n0, n1) in more.items():
        e = ends.setdefault(key, [0, 0])
        e[0] += n0
        e[1] += n1


def _added(batches):
    """Counts of one partition, which has all of its keys, added up: a row a language and a suffix that is used."""
    langs: dict[str, np.ndarray] = {}
    ends: dict[str, list[int]] = {}
    for b in batches:
        for key, counts, n0, n1 in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            if counts is not None:
                c = np.frombuffer(counts, dtype=np.int64)
                langs[key] = langs[key] + c if key in langs else c
            else:
                _add(ends, {key: (n0, n1)})
    yield _models_batch(langs, {k: c for k, c in ends.items() if len(k) == 2 or sum(c) >= OFTEN * _ONE})


def _models_batch(langs: dict, ends: dict) -> pa.RecordBatch:
    rows = [(k, c.tobytes(), 0, 0) for k, c in langs.items()] + [(k, None, x, y) for k, (x, y) in ends.items()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.binary(), pa.int64(), pa.int64()))], ["key", "counts", "n0", "n1"])


def models_of(batches: list[pa.RecordBatch]) -> tuple[Languages, Ends]:
    """Both models from rows of counts."""
    (b,) = _added(batches)
    key, counts, n0, n1 = (b.column(i).to_pylist() for i in range(4))
    langs = sorted((k[1:], np.frombuffer(c, dtype=np.int64)) for k, c in zip(key, counts, strict=True) if c is not None)
    ends = {k[1:]: (x / _ONE, y / _ONE) for k, c, x, y in zip(key, counts, n0, n1, strict=True) if c is None}
    return Languages([n for n, _ in langs], np.array([c for _, c in langs], dtype=np.float64).reshape(len(langs), BUCKETS)), Ends(ends)


_COUNTS = "key string, counts binary, n0 long, n1 long"


def train(documents: DataFrame) -> tuple[Languages, Ends]:
    """Both models from all labelled documents, counted and added up on the executors."""
    labelled = documents.select(F.trim("lang").alias("lang"), "text").where("lang is not null and lang <> '' and text is not null and text <> ''")
    many = labelled.select("lang").distinct().limit(LANGUAGES + 1).count()
    if many > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    parts = labelled.mapInArrow(_train_rows, _COUNTS)
    # added up by key, in as many tasks as cores: a language's counts meet in one
    rows = parts.repartition(labelled.sparkSession.sparkContext.defaultParallelism, "key").mapInArrow(_added, _COUNTS).toArrow()
    return models_of(rows.to_batches())


def prose(text: str) -> tuple[str, int]:
    """(text without formulas and quotations, number of words); a CJK character counts as half a word."""
    t = _LATEX_WORD.sub(" ", _QUOTED.sub(" ", _FORMULA.sub(" ", text)))
    return t, len([w for w in _WORDS.findall(t) if len(w) > 1 and not _CJK.search(w)]) + len(_CJK.findall(t)) // 2


def defect(question: str | None, answer: str | None, languages: Languages, ends: Ends, page: markup.Model) -> str | None:
    if is_empty(answer):
        return "empty_answer"
    a = markup.clean(answer, page)
    if is_empty(a):  # nothing but markup
        return "empty_answer"
    if is_copy(question, answer) or is_copy(markup.clean(question, page), a):
        return "question_copy"
    if is_refusal(a):
        return "refusal"
    text, n = prose(a)
    end = a.rstrip()
    boxed = re.search(r"\\boxed\{(?:[^{}]|\{[^{}]*\})*\}\s*(?:\$+|\\\]|\\\))?[.。]?$", end) is not None
    code = end.endswith("```")
    if not code and (is_open(end) or (n >= SENTENCE and not boxed and (_ELLIPSIS.search(end) or ends.ratio(end) < 0))):
        return "truncated_answer"
    if question and n >= SENTENCE and len(languages.names) > 1:
        qs, qn = prose(markup.clean(question, page))
        if qn:
            q, s = languages.scores(qs), languages.scores(text)
            theirs, mine = int(np.argmax(q)), int(np.argmax(s))
            if theirs != mine and s[theirs] < -SURE and q[mine] < -SURE:
                return "other_language"
    return None


def _judge(languages: Languages, ends: Ends, page: markup.Model):
    def run(batches):
        for b in batches:
            rid, kind = [], []
            for i, q, a in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                if i is not None and (d := defect(q, a, languages, ends, page)):
                    rid.append(i)
                    kind.append(d)
            yield pa.RecordBatch.from_arrays([pa.array(rid, pa.string()), pa.array(kind, pa.string())], ["record_id", "defect"])

    return run


def found(records: DataFrame, documents: DataFrame) -> DataFrame:
    """``(record_id, defect)`` of every record whose answer is defective."""
    languages, ends = train(documents)
    rows = runtime.fit_partitions(records.select("record_id", "question", "raw_dataset_answer"))
    return rows.mapInArrow(_judge(languages, ends, markup.model()), "record_id string, defect string").distinct()


def report(records: DataFrame, documents: DataFrame) -> DataFrame:
    """Defects against the ``filter_tag`` of the earlier run."""
    tags = records.select("record_id", F.coalesce(F.nullif(F.trim("filter_tag"), F.lit("")), F.lit("(none)")).alias("filter_tag")).distinct()
    return found(records, documents).join(tags, "record_id").groupBy("defect", "filter_tag").agg(F.count("*").alias("records"))


def _of(f):
    return lambda spark, d: f(runtime.table(spark, d, "canonical_records"), runtime.table(spark, d, "documents"))


QUERIES = {"p4_found": _of(found), "p4_report": _of(report)}

# ---- the same by plain rules, to check the models' rows: words of each language, last characters, brackets ----

_STOP = {
    "en": "the of and is that in to for with from by are as at which when has on this each only so thus if after every find what how its into his her before pays reads drains holds compute obtains than was not between",
    "fr": "le la les des est une du et que dans pour par qui sont avec sur au cette chaque donc après si quelle trouvez combien calculez vaut de un on obtient réponse même",
    "de": "der die das und ist mit von zu den dem eine ein im auf für bei nach wenn jede jeder damit also als wie viele bestimme berechne welche gilt antwort nur einer",
    "es": "el la los las es una un de del y que en para por con se al cada si después cuántos halla calcula qué respuesta tanto por lo como su obtiene",
}


def _plain_sql() -> str:
    from siltworks.plans import sqltext as q

    def without(c: str, *patterns: str, by: str = " ") -> str:
        for p in patterns:
            c = f"regexp_replace({c}, {q.sql(p, 'is')}, '{by}', 'g')"
        return c

    # markup goes: comments, tags, entities, wiki and LaTeX document commands
    bare = lambda c: q.strip(without(without(c, r"\\(?:textbf|textit|emph|underline|texttt)\{([^{}]*)\}", by=r"\1"), r"<!--.*?-->", r"</?[a-z][a-z0-9]*(?:\s[^<>]*)?/?>", r"&(?:[a-z]{2,8}|#\d+);", r"\[\[(?:category|file)[^\]\n]*\]\]", r"\{\{[^{}\n]*\}\}", r"\\(?:vspace|hspace|label|cite|footnote|ref)\*?\{[^{}]*\}", r"\\(?:noindent|bigskip|medskip|item)\b", r"\\(?:begin|end)\{(?:itemize|enumerate|center|quote)\}"))
    squeezed = lambda c: f"lower(array_to_string(regexp_extract_all({c}, '[\\p{{L}}\\p{{N}}]+'), ''))"
    prose = lambda c: without(c, r"\$\$.+?\$\$", r"\$[^$\n]*\$", r"«[^«»]*»", r"“[^“”]*”", r"\"[^\"\n]*\"", r"„[^“”]*[“”]", r"「[^」]*」", r"\\[a-z]+")
    # refusals and copies are told by the same forms
    refusal = f"{q.has('t', '|'.join((*_ENGLISH, *_OTHERS)), 'is')} AND NOT {q.has(without('t', '«[^«»]*»', '“[^“”]*”'), r'\\boxed|\\frac|=|\$')} AND len(regexp_extract_all({without('t', '«[^«»]*»')}, '[0-9]+')) <= 2"
    count = lambda w, words: f"len(list_filter({w}, lambda x: list_contains({words.split()!r}, x)))"
    language = lambda p: f"(SELECT CASE WHEN len(regexp_extract_all(c, '[\\x{{4e00}}-\\x{{9fff}}]')) >= 6 AND len(regexp_extract_all(c, '[\\x{{4e00}}-\\x{{9fff}}]')) > len(w) // 2 THEN 'zh' ELSE list_sort([{', '.join(f'({count(chr(119), words)}, {chr(39)}{k}{chr(39)})' for k, words in _STOP.items())}], 'DESC')[1][2] END FROM (SELECT {p} AS c, regexp_extract_all(lower({p}), '[\\p{{L}}]+') AS w))"
    n = f"len(regexp_extract_all({prose('t')}, '[\\p{{L}}]{{2,}}')) + len(regexp_extract_all({prose('t')}, '[\\x{{4e00}}-\\x{{9fff}}]')) // 2"
    many = lambda ch: f"(length(t) - length(replace(t, '{ch}', '')))"
    half_open = f"({many('$')} % 2 = 1 OR {many('{')} > {many('}')} OR {many('(')} + {many('[')} > {many(')')} + {many(']')})"
    ends = r"(?:[.!?。！？”»\"]|\\boxed\{.*\}\$?|```)$"
    cut = f"({half_open} OR {q.has('t', r'[-+*/=<>^_,，、:：;&]$')} OR {q.has('t', r'\\[A-Za-z]*$')} AND NOT {q.has('t', r'\\(?:pi|infty)$')} OR ({n}) >= 3 AND (NOT {q.has('t', ends, 's')} OR {q.has('t', r'[^\W_](?:\.{3,}|…)$')}))"
    stand_ins = "', '".join(("", "answer", "boxed", "na", "none", "null", "nan", "tbd", "unknown", "notavailable", "noanswer"))
    label = "'thetask', 'problemstatement', 'problem', 'q', 'question', 'answer', 'task'"
    return f"""WITH r AS (SELECT DISTINCT record_id, question, raw_dataset_answer FROM canonical_records WHERE record_id IS NOT NULL),
b AS MATERIALIZED (SELECT record_id, {bare("coalesce(question, '')")} AS q, {bare("coalesce(raw_dataset_answer, '')")} AS t FROM r),
s AS MATERIALIZED (SELECT *, {squeezed("q")} AS sq, {squeezed("t")} AS st FROM b),
d AS (SELECT record_id, CASE WHEN st IN ('{stand_ins}') THEN 'empty_answer'
WHEN length(sq) > 2 AND contains(st, sq) AND replace(st, sq, '') IN ('', {label}) THEN 'question_copy'
WHEN {refusal} THEN 'refusal' WHEN {cut} THEN 'truncated_answer'
WHEN sq <> '' AND ({n}) >= 3 AND {language(prose("q"))} <> {language(prose("t"))} THEN 'other_language' END AS defect FROM s)
SELECT DISTINCT record_id, defect FROM d WHERE defect IS NOT NULL"""


ORACLES: dict[str, str] = {"p4_found": _plain_sql()}
ORACLES["p4_report"] = f"SELECT defect, filter_tag, count(*) AS records FROM ({ORACLES['p4_found']}) JOIN (SELECT DISTINCT record_id, coalesce(nullif(trim(filter_tag), ''), '(none)') AS filter_tag FROM canonical_records) USING (record_id) GROUP BY 1, 2"
