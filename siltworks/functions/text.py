"""Text functions as column expressions. Null in, null out, unless said otherwise."""

from __future__ import annotations

import gzip
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions import rules, tokens
from siltworks.functions.regex import SPACE, WORD, hoisted, java, needs


def replace(c: Column, pattern: str, by: str, flags: str = "") -> Column:
    return F.regexp_replace(c, F.lit(java(pattern, flags)), F.lit(by))


def matches(c: Column, pattern: str, flags: str = "", low: Column | None = None) -> Column:
    """Whether the pattern is found. ``low`` is ``folded(c)``: a pattern is only tried where a text it needs is there."""
    hit = F.coalesce(c.rlike(java(hoisted(pattern), flags)), F.lit(False))
    if low is None or not (some := needs(pattern, flags)):
        return hit
    held = F.contains(low, F.lit(some[0]))
    for x in some[1:]:
        held = held | F.contains(low, F.lit(x))
    return F.coalesce(held, F.lit(False)) & hit


def folded(c: Column) -> Column:
    """Lower case, with the few characters that equal an ASCII letter when case is ignored brought to it."""
    return F.lower(F.translate(c, "\u017f\u0131\u0130\u212a", "siik"))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{SPACE}]+|[{SPACE}]+$", "")


def or_blank(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def normalize_newlines(c: Column) -> Column:
    return F.regexp_replace(c, "\r\n?", "\n")


def fullwidth_to_halfwidth(c: Column) -> Column:
    wide = "".join(map(chr, range(0xFF01, 0xFF5F)))
    return F.translate(c, "\u3000" + wide, " " + "".join(chr(ord(x) - 0xFEE0) for x in wide))


def strip_invisible(c: Column) -> Column:
    listed = "".join(f"\\x{{{x:04x}}}" for x in rules.INVISIBLE)
    return F.regexp_replace(c, rf"[{listed}\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]", "")


def normalize_punctuation(c: Column) -> Column:
    single = [(a, b) for a, b in rules.PUNCTUATION if len(b) == 1]
    out = F.translate(c, "".join(a for a, _ in single), "".join(b for _, b in single))
    for a, b in rules.PUNCTUATION:
        if len(b) > 1:
            out = F.replace(out, F.lit(a), F.lit(b))
    return out


@F.pandas_udf(T.StringType())
def nfc(texts: pd.Series) -> pd.Series:
    """Canonical composition; most texts are composed already and pass through."""
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


def clean_urls_and_images(c: Column) -> Column:
    for flags, pattern in (rules.URL, rules.MARKDOWN_IMAGE, rules.HTML_IMAGE, rules.BASE64):
        c = replace(c, pattern, " ", flags)
    return c


def format_text(c: Column) -> Column:
    """Points removed, lines collapsed and stripped, at most one empty line between lines."""
    flat = rf"[{SPACE}&&[^\n]]"
    c = replace(normalize_newlines(c), rules.POINTS[1], " ", rules.POINTS[0])
    c = F.regexp_replace(c, r"[\x0b\x0c\x1c-\x1e\x85\u2028\u2029]", "\n")
    c = F.regexp_replace(c, r"[ \t]+", " ")
    c = F.regexp_replace(c, rf"{flat}*\n{flat}*", "\n")
    return strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def normalize_text(c: Column, punctuation: bool = True) -> Column:
    c = fullwidth_to_halfwidth(strip_invisible(nfc(c)))
    return format_text(normalize_punctuation(c) if punctuation else c)


def contains_cjk(c: Column) -> Column:
    return matches(c, rules.CJK[1])


def contains_other_script(c: Column) -> Column:
    return matches(c, rules.OTHER_SCRIPT[1])


_CJK_LETTERS = r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{2E80}-\x{2EFF}\x{F900}-\x{FAFF}\x{20000}-\x{2A6DF}\x{3040}-\x{30FF}\x{31F0}-\x{31FF}\x{AC00}-\x{D7AF}\x{1100}-\x{11FF}"
_LATIN_LETTERS = r"\x{0000}-\x{024F}\x{0370}-\x{03FF}\x{1F00}-\x{1FFF}"


def script_counts(c: Column) -> dict[str, Column]:
    """Letters by script: latin (with Greek), cjk, other. The shares of no letters are 1, 0, 0."""
    n = lambda p: F.length(F.regexp_replace(c, p, ""))
    total = n(r"[^\p{L}]")
    latin = n(rf"[^\p{{L}}]|[^{_LATIN_LETTERS}]")
    cjk = n(rf"[^\p{{L}}]|[^{_CJK_LETTERS}]")
    return {"total": total, "latin": latin, "cjk": cjk, "other": total - latin - cjk}


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def script_ratio(c: Column, which: str) -> Column:
    n = script_counts(c)
    return F.when(n["total"] == 0, F.lit(1.0 if which == "latin" else 0.0)).otherwise(n[which] / n["total"])


def is_short(c: Column) -> Column:
    """Under five words and under twenty characters."""
    s = strip(c)
    words = F.when(s == "", 0).otherwise(F.size(F.split(s, f"[{SPACE}]+")))
    return (words < 5) & (F.length(s) < 20)


def normalize_answer(c: Column) -> Column:
    return F.regexp_replace(F.lower(strip(c)), f"[{SPACE}]+", " ")


def minhash_text(c: Column) -> Column:
    c = F.regexp_replace(normalize_answer(c), f"[^{WORD}{SPACE}]", " ")
    return strip(F.regexp_replace(c, f"[{SPACE}]+", " "))


def char_ngrams(c: Column, n: int = 3) -> Column:
    """The set of n-character substrings; a shorter text is its own only member, a blank one has none."""
    # each position once; sequence() would count down where the text is shorter than n
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - n + 1, F.lit(1))), lambda i: F.substring(c, i, F.lit(n))))
    return F.when(c == "", F.array().cast("array<string>")).otherwise(grams)


def word_shingles(c: Column, n: int = 2) -> Column:
    words = F.split(c, f"[{SPACE}]+")
    many = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(words, i, n), " ")))
    return F.when(c == "", F.array().cast("array<string>")).otherwise(many)


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets: 1 when both are empty, 0 when one is."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / (F.size(a) + F.size(b) - both))


def options(c: Column) -> Column:
    """Array of (letter, value): the answer options of a question, by lines or else LaTeX labels."""
    by_line = normalize_newlines(c)
    p = java(rules.OPTION_LINE[1][len("(?im)") :], "im")
    letters, values = F.regexp_extract_all(by_line, F.lit(p), F.lit(1)), F.regexp_extract_all(by_line, F.lit(p), F.lit(2))
    lines = F.zip_with(letters, values, lambda a, b: F.struct(F.upper(a).alias("letter"), strip(b).alias("value")))
    q = java(rules.LATEX_OPTION[1], rules.LATEX_OPTION[0])
    one, two, three = (F.regexp_extract_all(c, F.lit(q), F.lit(k)) for k in (1, 2, 3))
    latex = F.zip_with(F.zip_with(one, two, lambda a, b: F.concat(a, b)), three, lambda a, b: F.struct(F.upper(a).alias("letter"), strip(b).alias("value")))
    latex = F.filter(latex, lambda x: (x["letter"] != "") & (x["value"] != ""))
    return F.when(F.size(lines) > 0, lines).otherwise(latex)


def option_value(opts: Column, letter: Column) -> Column:
    """The value of a letter; of several the last counts. Null if there is none."""
    hit = F.filter(opts, lambda x: x["letter"] == letter)
    return F.when(F.size(hit) > 0, F.element_at(hit, -1)["value"])


def answer_letter(c: Column) -> Column:
    return F.upper(F.regexp_extract(strip(c), java(rules.ANSWER_LETTER[1], rules.ANSWER_LETTER[0]), 1))


def strip_option_lines(c: Column) -> Column:
    rest = F.regexp_replace(normalize_newlines(c), F.lit(java(rules.OPTION_LINE[1][len("(?im)") :], "im")), F.lit(""))
    lines = F.filter(F.transform(F.split(rest, "\n"), strip), lambda x: x != "")
    return strip(F.array_join(lines, "\n"))


def compact_options(c: Column) -> Column:
    c = normalize_newlines(c)
    n = lambda p: F.size(F.regexp_extract_all(c, F.lit(java(p[1], p[0])), F.lit(0)))
    return (n(rules.COMPACT_OPTION) >= 3) | (n(rules.COMPACT_MARKER) >= 3)


def truncated(c: Column, most: int, marker: str = "\n[TRUNCATED]") -> Column:
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, max(0, most - len(marker))), F.lit(marker))).otherwise(c)


def parse_answer(c: Column, pattern: str = r"^(?:final answer|answer)\s*[:：]\s*(.+)$", flags: str = "im") -> Column:
    """Group 1 of the last match, else the last line; blank for a blank text."""
    found = F.regexp_extract_all(c, F.lit(java(pattern, flags)), F.lit(1))
    last = F.element_at(F.split(F.regexp_replace(c, r"\n+\z", ""), "\n"), -1)
    return F.when(F.size(found) > 0, strip(F.element_at(found, -1))).when(strip(c) == "", "").otherwise(strip(last))


def boxed(text: str | None) -> str:
    """The last boxed expression with balanced braces, else blank."""
    at = (text or "").rfind("\\boxed{")
    if at < 0:
        return ""
    depth = 0
    for i in range(at + 6, len(text)):
        depth += {"{": 1, "}": -1}.get(text[i], 0)
        if not depth:
            return text[at + 7 : i].strip()
    return ""


@F.pandas_udf(T.StringType())
def extract_boxed(texts: pd.Series) -> pd.Series:
    return texts.map(boxed)


@F.pandas_udf(T.DoubleType())
def gzip_ratio(texts: pd.Series) -> pd.Series:
    """Compressed bytes by bytes; 1 for a blank text."""
    return texts.map(lambda t: len(gzip.compress(b, mtime=0)) / len(b) if t and (b := t.encode("utf-8", "surrogatepass")) else 1.0)


def token_count(folder: str = tokens.VOCABULARIES, file: str = tokens.BYTE_BPE):
    @F.pandas_udf(T.IntegerType())
    def count(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: tokens.count(t, folder, file))

    return count


def longest_repetition(words: list, n: int) -> int:
    """Most back-to-back repetitions of one n-gram, from any start; 1 under 2n words."""
    # r[i]: how long words[i:] and words[i+n:] agree; a run of that length r repeats the n-gram r // n more times
    agree = best = 0
    for i in range(len(words) - n - 1, -1, -1):
        agree = agree + 1 if words[i] == words[i + n] else 0
        best = max(best, agree // n)
    return best + 1


def ngram_repetition(n: int = 4):
    @F.pandas_udf(T.IntegerType())
    def repetition(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: longest_repetition((t or "").split(), n))

    return repetition


def stable_int_hash(c: Column, seed: str) -> Column:
    """The first 15 hexadecimal digits of sha-256 of 'seed:value', as a bigint."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), c), 256), 1, 15), 16, 10).cast("long")


def difficulty_score(c: Column) -> Column:
    """The first whole number of 1 to 10 that touches no other digit; 0 where there is none."""
    found = F.regexp_extract(c, r"(?<![0-9])(10|[1-9])(?![0-9])", 1)
    return F.when(found != "", found.cast("double")).otherwise(0.0)


def l2_normalize(v: Column) -> Column:
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return F.transform(v, lambda x: x.cast("double") / F.greatest(norm, F.lit(1e-12)))


# ---- equality of answers ----

_NUMBER = r"[-+]?(?:\d+(?:\.\d*)?|\.\d+)"


def plain_answer(c: Column) -> Column:
    """An answer without dollars, boxes, spacing, a leading ``x =`` and a last full stop; fractions as ``a/b``."""
    c = F.lower(strip(or_blank(c)))
    c = F.regexp_replace(c, r"\$|\\(?:left|right|displaystyle)(?![a-z])|\\[,;:! ]", "")
    c = F.regexp_replace(c, r"\\(?:boxed|text|mathrm)\{([^{}]*(?:\{[^{}]*\}[^{}]*)*)\}", "$1")
    c = F.regexp_replace(c, r"\\[dt]?frac\{([^{}]*)\}\{([^{}]*)\}", "$1/$2")
    c = F.regexp_replace(c, f"[{SPACE}]+", "")
    c = F.regexp_replace(c, r"^[a-z]=|\.$", "")
    return F.when(c.rlike(r"^[-+]?\d{1,3}(?:,\d{3})+(?:\.\d+)?$"), F.replace(c, F.lit(","), F.lit(""))).otherwise(c)


def canonical_value(part: Column) -> Column:
    """A number, fraction or percentage as its value to 10 places; anything else as it is."""
    number = part.rlike(f"^{_NUMBER}$")
    fraction = part.rlike(f"^{_NUMBER}/{_NUMBER}$")
    percent = part.rlike(rf"^{_NUMBER}\\?%$")
    two = F.split(part, "/")
    low = F.get(two, F.lit(1)).try_cast("double")
    value = F.when(number, part.try_cast("double")).when(fraction & (low != 0), F.get(two, F.lit(0)).try_cast("double") / low).when(percent, F.regexp_replace(part, r"\\?%", "").try_cast("double") / 100)
    return F.coalesce((F.round(value, 10) + F.lit(0.0)).cast("string"), part)


def same_value(a: Column, b: Column) -> Column:
    """Whether two answers are equal: as text, as numbers (1/2 is 0.5), or part by part (tuples, intervals, sets)."""

    def canonical(c: Column) -> Column:
        c = plain_answer(c)
        inner = F.regexp_extract(c, r"^\\?[\[({](.+)\\?[\])}]$", 1)
        several = c.rlike(r"^\\?[\[({].+,.+[\])}]$")
        parts = F.transform(F.split(F.regexp_replace(inner, r"\\$", ""), ","), canonical_value)
        is_set = c.rlike(r"^\\?\{")
        kind = F.regexp_replace(F.concat(F.regexp_extract(c, r"^\\?(.)", 1), F.substring(c, -1, 1)), r"\\", "")
        return F.when(several, F.concat(kind, F.array_join(F.when(is_set, F.array_sort(parts)).otherwise(parts), ","))).otherwise(canonical_value(c))

    return canonical(a) == canonical(b)
