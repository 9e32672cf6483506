from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltworks.functions import kernel, regex, rules, text


def one(spark, value, *columns):
    return spark.createDataFrame([(value,)], "t string").select(*(c(F.col("t")).alias(f"c{i}") for i, c in enumerate(columns))).first()


@given(st.lists(st.text(max_size=40), max_size=6))
@settings(max_examples=60, deadline=None)
def test_words_are_runs_of_letters_and_digits(texts):
    w = kernel.Words(texts)
    assert [w.of(i) for i in range(len(texts))] == [re.findall(r"[^\W_]+", t.lower()) for t in texts]


@given(st.lists(st.integers(0, 50), max_size=60), st.integers(1, 12))
@settings(max_examples=60, deadline=None)
def test_sliding_min(values, w):
    x = np.array(values, dtype=np.uint64)
    assert kernel.sliding_min(x, w).tolist() == [min(values[i : i + w]) for i in range(max(0, len(values) - w + 1))]


def test_equal_words_hash_alike_anywhere():
    w = kernel.Words(["abc def abc", "x ABC"])
    assert w.hash[0] == w.hash[2] == w.hash[4] != w.hash[1]


def test_blocks_keep_order_and_nulls():
    texts = ["a" * 5, None, "b" * 9, ""]
    got = list(kernel.blocks(texts, 6))
    assert [t for _, b in got for t in b] == texts and [i for i, _ in got] == sorted(i for i, _ in got)


@pytest.mark.parametrize("table", ["PROMPT_CONTAMINATION", "MISSING_CONTEXT", "UNDERSPECIFIED", "BROKEN_FORMAT", "BROKEN_REFERENCE", "META_TASK"])
def test_rules_compile_in_the_jvm_and_agree_with_python(spark, table):
    samples = ["Solution: x", "See Figure 3.", "the answer is 5", "act as a chef", "compare with problem 3", "Find g(10).", "12 + 3", "```\ncode", "plain words here", "", "translate from english", "ÉTÉ step 2: go", "你好 step 3:"]
    patterns = [(r[0], r[1]) for r in getattr(rules, table)]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    got = df.select(*(text.matches(F.col("t"), p, f).alias(f"c{i}") for i, (f, p) in enumerate(patterns))).collect()
    for s, row in zip(samples, got, strict=True):
        for (f, p), hit in zip(patterns, row, strict=True):
            flags = sum({"i": re.I, "m": re.M, "s": re.S}[x] for x in f)
            assert hit == bool(re.search(p, s, flags)), (p, s)


def test_spaces_are_unicode():
    assert re.search(regex.SPACE[:2], "\t")
    assert regex.java(r"[^\w\s]").count("[") == 1


def test_format_and_clean(spark):
    r = one(spark, "a　b \t c\r\n\r\n\r\n\r\nhttp://x.y (5 points) d ", lambda c: text.format_text(text.clean_urls_and_images(c)))
    assert r[0] == "a　b c\n\nd"


def test_normalize(spark):
    assert one(spark, "Ａ​’é…", text.normalize_text)[0] == "A'é..."


def test_short_and_null(spark):
    assert one(spark, "Find x", text.is_short)[0] is True
    assert one(spark, None, text.is_short, text.normalize_answer)[1] is None


def test_char_ngrams(spark):
    assert sorted(one(spark, "abcd", text.char_ngrams)[0]) == ["abc", "bcd"]
    assert one(spark, "ab", text.char_ngrams)[0] == ["ab"]
    assert one(spark, "", text.char_ngrams)[0] == []


def test_jaccard_edges(spark):
    df = spark.sql("select array() a, array() b, array(1) c, array(1, 2) d")
    r = df.select(text.jaccard(F.col("a"), F.col("b")), text.jaccard(F.col("a"), F.col("c")), text.jaccard(F.col("c"), F.col("d"))).first()
    assert tuple(r) == (1.0, 0.0, 0.5)


def test_jaccard_of_pairs_normalises_a_text_once(spark, tmp_path):
    import __spark_entry__ as entry

    texts = [None, "", " . ", "ab", "A  b!", "abc abc", "Find the area of x.", "find the areas of x", "日本語の文"]
    pairs = [(str(i), str(j), a, b) for i, a in enumerate(texts) for j, b in enumerate(texts)]
    spark.createDataFrame(pairs, "left_id string, right_id string, left_question string, right_question string").write.parquet(f"{tmp_path}/dedup_pairs.parquet")
    df = entry.queries()["f18_jaccard"](spark, str(tmp_path))
    plain = [" ".join("".join(c if c.isalnum() else " " for c in (t or "").lower()).split()) for t in texts]
    sets = [{t[k : k + 3] for k in range(max(1, len(t) - 2))} if t else set() for t in plain]
    want = {(str(i), str(j)): round(len(a & b) / len(a | b), 9) if a | b else 1.0 for i, a in enumerate(sets) for j, b in enumerate(sets)}
    assert {(r.left_id, r.right_id): r.jaccard for r in df.collect()} == want
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    once = spark.range(1).select(text.minhash_text(text.or_blank(F.col("id").cast("string"))).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 2 * once.count("regexp_replace(") and plan.count("array_distinct(") == 2


def test_options(spark):
    r = one(spark, "What is 1+1?\nA. 1\nB. 2\nC. 3\nD. 4", lambda c: text.option_value(text.options(c), F.lit("B")), text.strip_option_lines)
    assert tuple(r) == ("2", "What is 1+1?")


def test_parse_answer_and_boxed(spark):
    assert one(spark, "Answer: 5\nFinal answer: 42", text.parse_answer)[0] == "42"
    assert one(spark, "one\ntwo", text.parse_answer)[0] == "two"
    assert text.boxed(r"\boxed{5} so \boxed{\frac{1}{2}}") == r"\frac{1}{2}" and text.boxed(r"\boxed{5") == "" and text.boxed(None) == ""


def test_difficulty(spark):
    assert [one(spark, t, text.difficulty_score)[0] for t in ("8.5", "level 10", "none", "123")] == [8.0, 10.0, 0.0, 0.0]


@given(st.lists(st.sampled_from("ab"), max_size=24), st.integers(1, 3))
@settings(max_examples=80, deadline=None)
def test_longest_repetition(words, n):
    best = 1
    for i in range(len(words)):
        k = 1
        while words[i : i + n] == words[i + k * n : i + (k + 1) * n] and len(words[i + k * n : i + (k + 1) * n]) == n:
            k += 1
        best = max(best, k)
    assert text.longest_repetition(words, n) == best


@pytest.mark.parametrize("table", ["PROMPT_CONTAMINATION", "MISSING_CONTEXT", "UNDERSPECIFIED", "BROKEN_FORMAT", "BROKEN_REFERENCE", "META_TASK", "ROLES", "NON_MATH_CODE", "NON_MATH_GENERAL", "NON_MATH_STEM", "STRONG_CODE", "MATH_OBJECT", "PROOF_KEYWORD"])
def test_what_a_pattern_needs_is_in_every_match(table):

    from siltworks.functions.regex import alternatives, hoisted, needs

    rng = random.Random(5)
    got = getattr(rules, table)
    for flags, pattern in [t[:2] for t in (got if isinstance(got, list) else [got])]:
        mode = sum({"i": re.I, "m": re.M, "s": re.S}[f] for f in flags)
        assert "|".join(alternatives(pattern)) == pattern
        some, plain, quick = needs(pattern, flags), re.compile(pattern, mode), re.compile(hoisted(pattern), mode)
        # texts made of the pattern's own words, so that many of them match
        words = re.findall(r"[A-Za-z]{2,}|[^\w\s]", pattern) + ["a", "the", "5", "\n", " "]
        for _ in range(60):
            t = rng.choice(["", " "]).join(rng.choice(words) for _ in range(rng.randrange(1, 12)))
            t = t.upper() if rng.random() < 0.3 else t
            hit = plain.search(t)
            assert bool(quick.search(t)) == bool(hit)
            assert not hit or not some or any(x in t.lower() for x in some), (pattern, t)


def test_folding_covers_letters_that_match_when_case_is_ignored(spark):
    c = F.col("t")
    df = spark.createDataFrame([("ſolution: 5",), ("SOLUTİON: 5",), ("ſolutıon :",), ("nothing",), (None,)], "t string")
    assert [r.m for r in df.select(text.matches(c, r"\bsolution\s*:", "i", text.folded(c)).alias("m")).collect()] == [r.m for r in df.select(text.matches(c, r"\bsolution\s*:", "i").alias("m")).collect()]
