"""SQL text for checking column expressions against another engine."""

from __future__ import annotations

from siltworks.functions import rules
from siltworks.functions.regex import SPACE, WORD, sql

RECORDS = "(SELECT coalesce(record_id, '') AS record_id, coalesce(question, '') AS question, coalesce(raw_dataset_answer, '') AS raw_dataset_answer, coalesce(confirmed_answer, '') AS confirmed_answer, coalesce(dataset_name, '') AS dataset_name, coalesce(training_phase, '') AS training_phase, coalesce(filter_tag, '') AS filter_tag FROM canonical_records)"


def has(c: str, pattern: str, flags: str = "") -> str:
    return f"regexp_matches({c}, {sql(pattern, flags)})"


def sub(c: str, pattern: str, by: str, flags: str = "") -> str:
    return f"regexp_replace({c}, {sql(pattern, flags)}, '{by}', 'g')"


def strip(c: str) -> str:
    return sub(c, r"^\s+|\s+$", "")


def normal(c: str) -> str:
    return sub(f"lower({strip(c)})", r"\s+", " ")


def minhash(c: str) -> str:
    return strip(sub(sub(normal(c), r"[^\w\s]", " "), r"\s+", " "))


def urls(c: str) -> str:
    for f, p in (rules.URL, rules.MARKDOWN_IMAGE, rules.HTML_IMAGE, rules.BASE64):
        c = sub(c, p, " ", f)
    return c


def formatted(c: str) -> str:
    c = f"replace(replace({c}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    c = sub(c, rules.POINTS[1], " ", rules.POINTS[0])
    c = f"regexp_replace({c}, '[\\x0b\\x0c\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]', chr(10), 'g')"
    c = sub(c, r"[ \t]+", " ")
    flat = SPACE.replace(r"\t-\r", r"\t\x0b-\r")
    c = f"regexp_replace({c}, '[{flat}]*\\n[{flat}]*', chr(10), 'g')"
    c = f"regexp_replace({c}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return strip(c)


def first(c: str, table: list, otherwise: str = "NULL") -> str:
    """CASE over (flags, pattern, reason)."""
    return "CASE " + " ".join(f"WHEN {has(c, p, f)} THEN '{r}'" for f, p, r in table) + f" ELSE {otherwise} END"


def short(c: str) -> str:
    s = strip(c)
    return f"(len(regexp_split_to_array({s}, '[{SPACE}]+')) < 5 AND length({s}) < 20)"


def letters(c: str, which: str = "") -> str:
    from siltworks.functions import text

    n = f"length({sub(c, r'[^\p{L}]', '')})"
    if not which:
        return n
    keep = text._CJK_LETTERS if which == "cjk" else text._LATIN_LETTERS
    return f"length(regexp_replace(regexp_replace({c}, '[^\\p{{L}}]', '', 'g'), '[^{keep}]', '', 'g'))"


def count(c: str, ch: str) -> str:
    return f"(length({c}) - length(replace({c}, '{ch}', '')))"


__all__ = ["WORD"]
