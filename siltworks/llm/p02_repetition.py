"""Problem 2: repetition inside the texts of ``verification`` and ``distillation``.

Method: tokeniser fertility. Each text is brought to its words (lower-cased, one space between)
and encoded with a public byte-level vocabulary; measured are characters per token, tokens per
word (fertility), the share of byte-fallback tokens and the entropy of the tokens.

``p2_fertility`` reports these for every text, with rejection bands per script: the median plus
or minus ``BAND`` times the spread between the quartiles, over all texts of the script.

``p2_found`` uses the one band that can be proved to lose nothing. Words covered by runs that
started earlier aren't the first of their kind, so at a repeated share of s at least s*n of the T
tokens are not first occurrences; the tokens' counts c then satisfy sum(c*log2(c)) >= 2*s*n, that
is, the entropy falls short of log2(T) by at least 2*s divided by the fertility. Texts inside the
band are measured exactly: the share of words in a run of ``RUN`` words that also starts earlier.

Defined results: null, cut-off or non-object JSON holds no texts; entries that lack a text are
skipped; a sample without ``index`` has its place as slot; texts under 12 words have share 0;
repeated rows count once; texts of any length are taken whole.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks import runtime
from siltworks.functions import tokens
from siltworks.functions.kernel import Words, blocks, mix

RUN = 6
LEAST_WORDS = 12
SHARE = 0.3
BAND = 3.0


def texts_of(field: str, raw: str | None) -> list[tuple[str, str, str]]:
    """(slot, text name, text) of one JSON column."""
    if not raw or len(raw) < 3:
        return []
    try:
        got = json.loads(raw)
    except (ValueError, RecursionError):
        return []
    if not isinstance(got, dict):
        return []
    if field == "verification":
        samples = got.get("samples")
        entries = [(str(s["index"]) if s.get("index") is not None else str(i), s) for i, s in enumerate(samples) if isinstance(s, dict)] if isinstance(samples, list) else []
    else:
        entries = [(str(m), s) for m, s in got.items() if isinstance(s, dict)]
    return [(slot, name, s[name]) for slot, s in entries for name in ("reasoning", "solution") if isinstance(s.get(name), str)]


def repeated_share(w: Words, run: int = RUN, least: int = LEAST_WORDS) -> np.ndarray:
    """Per text: the share of words that lie in a run which also starts earlier in the text."""
    n = w.counts()
    at, h = w.grams(run)
    cover = np.zeros(len(w.hash) + 1, dtype=np.int64)
    if len(at):
        key = h ^ mix(w.doc[at], 11)
        order = np.argsort(key, kind="stable")
        again = np.zeros(len(at), dtype=bool)
        again[order[1:]] = key[order[1:]] == key[order[:-1]]
        starts = at[again]
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + run, -1)
    inside = np.cumsum(cover)[:-1] > 0
    total = np.concatenate([[0], np.cumsum(inside)])
    covered = total[w.first[1:]] - total[w.first[:-1]]
    return np.where(n >= least, covered / np.maximum(n, 1), 0.0)


def _normal(w: Words) -> list[str]:
    """Each text as its words, each with one space before it."""
    if not len(w.start):
        return [""] * w.n_docs
    length = w.end - w.start + 1
    place = np.cumsum(length) - length
    code = np.full(int(length.sum()), 32, dtype=np.uint32)
    source = np.repeat(w.start - place - 1, length) + np.arange(len(code))
    source[place] = w.start[0]  # any valid place, overwritten below
    code[:] = w.code[source]
    code[place] = 32
    text = code.tobytes().decode("utf-32-le", "surrogatepass")
    ends = np.concatenate([place, [len(code)]])[w.first]
    return [text[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def fertility(w: Words, folder: str) -> dict[str, np.ndarray]:
    """Token measures of each text of the block."""
    enc, fallback = tokens.byte_bpe(folder), tokens.fallback_table(folder)
    normal = _normal(w)
    ids = [enc.encode_ordinary(t) for t in normal]
    n = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
    flat = np.fromiter((i for x in ids for i in x), dtype=np.int64, count=int(n.sum()))
    doc = np.repeat(np.arange(len(ids)), n)
    key, c = np.unique(doc * (1 << 20) + flat, return_counts=True)
    bits = np.bincount(key >> 20, weights=c * np.log2(c), minlength=len(ids))
    some = np.maximum(n, 1)
    return {
        "n_tokens": n,
        "entropy": np.log2(some) - bits / some,
        "repeat_bits": bits / np.maximum(w.counts(), 1),
        "chars_per_token": np.fromiter(map(len, normal), dtype=np.int64, count=len(normal)) / some,
        "fallback_share": np.bincount(doc, weights=fallback[flat], minlength=len(ids)) / some,
    }


def _script(w: Words) -> np.ndarray:
    """han where a fifth of the characters are, else latin where half of them are, else other."""
    count = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[np.concatenate([[0], w.ends])])
    n = np.maximum(np.diff(np.concatenate([[0], w.ends])), 1)
    han = count((w.code >= 0x3400) & (w.code < 0xA000)) / n
    return np.where(han >= 0.2, "han", np.where(count(w.code < 0x250) / n >= 0.5, "latin", "other"))


_KEYS = "record_id string, field string, slot string, text_name string"


def _measure(folder: str, share: float | None):
    def run(batches):
        for b in batches:
            keys, texts = [], []
            for rid, v, d in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if rid is None:
                    continue
                for field, raw in (("verification", v), ("distillation", d)):
                    for slot, name, text in texts_of(field, raw):
                        keys.append((rid, field, slot, name))
                        texts.append(text)
            for at, block in blocks(texts):
                w = Words(block)
                k = keys[at : at + len(block)]
                m = fertility(w, folder)
                if share is not None:
                    # a safe margin below the bound for rounding
                    near = (m["repeat_bits"] >= 2 * share - 1e-9) & (w.counts() >= LEAST_WORDS)
                    if not near.any():
                        continue
                    exact = repeated_share(w)
                    pick = np.flatnonzero(near & (exact >= share))
                    yield pa.RecordBatch.from_arrays([pa.array([k[i][j] for i in pick], pa.string()) for j in range(4)], ["record_id", "field", "slot", "text_name"])
                    continue
                exact = repeated_share(w)
                n = w.counts()
                columns = [pa.array([x[j] for x in k], pa.string()) for j in range(4)]
                columns += [pa.array(_script(w).tolist()), pa.array(n), pa.array(m["n_tokens"]), pa.array(m["n_tokens"] / np.maximum(n, 1)), pa.array(m["chars_per_token"]), pa.array(m["fallback_share"]), pa.array(m["entropy"]), pa.array(exact)]
                yield pa.RecordBatch.from_arrays(columns, ["record_id", "field", "slot", "text_name", "script", "n_words", "n_tokens", "fertility", "chars_per_token", "fallback_share", "entropy", "repeated_share"])

    return run


def _input(records: DataFrame) -> DataFrame:
    blank = lambda c: F.col(c).isNotNull() & (F.length(c) > 2)
    return runtime.fit_partitions(records.select("record_id", "verification", "distillation").where(blank("verification") | blank("distillation")))


def found(records: DataFrame, share: float = SHARE, folder: str = tokens.VOCABULARIES) -> DataFrame:
    """``(record_id, field, slot, text_name)`` of texts whose repeated share is at least ``share``."""
    tokens.share(records.sparkSession, folder)
    return _input(records).mapInArrow(_measure(folder, share), _KEYS).distinct()


def measured(records: DataFrame, band: float = BAND, folder: str = tokens.VOCABULARIES) -> DataFrame:
    """Every text with its token measures, its repeated share and ``rejected``: outside a band of its script."""
    tokens.share(records.sparkSession, folder)
    columns = ["fertility", "chars_per_token", "fallback_share"]
    schema = _KEYS + ", script string, n_words long, n_tokens long, fertility double, chars_per_token double, fallback_share double, entropy double, repeated_share double"
    keys = ["record_id", "field", "slot", "text_name"]
    rest = [f.split()[0] for f in schema.split(", ") if f.split()[0] not in keys]
    # one row a text; where a slot comes with several texts, the one that repeats itself most
    every = _input(records).mapInArrow(_measure(folder, None), schema).groupBy(*keys).agg(F.max(F.struct("repeated_share", *(c for c in rest if c != "repeated_share"))).alias("m"))
    m = runtime.materialize(every.select(*keys, *(F.col(f"m.{c}") for c in rest)), "p02-measures")
    quartiles = m.groupBy("script").agg(*(F.percentile_approx(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(f"q_{c}") for c in columns))
    outside = F.lit(False)
    for c in columns:
        q = F.col(f"q_{c}")
        outside = outside | (F.abs(F.col(c) - q[1]) > F.greatest(band * (q[2] - q[0]), F.lit(1e-6)))
    # one row a script: three at most
    return m.join(F.broadcast(quartiles), "script").withColumn("rejected", outside).drop(*(f"q_{c}" for c in columns))


def shares(records: DataFrame) -> DataFrame:
    """``(record_id, field, slot, text_name, n_words, repeated_share)`` of every text."""
    return measured(records).select("record_id", "field", "slot", "text_name", "n_words", F.round("repeated_share", 9).alias("repeated_share"))


QUERIES = {
    "p2_found": lambda spark, d: found(runtime.table(spark, d, "canonical_records")),
    "p2_fertility": lambda spark, d: measured(runtime.table(spark, d, "canonical_records")),
    "p2_shares": lambda spark, d: shares(runtime.table(spark, d, "canonical_records")),
}
_SQL = """WITH v AS (SELECT DISTINCT record_id, verification AS j FROM canonical_records WHERE record_id IS NOT NULL AND verification IS NOT NULL AND json_valid(verification)),
d AS (SELECT DISTINCT record_id, distillation AS j FROM canonical_records WHERE record_id IS NOT NULL AND distillation IS NOT NULL AND json_valid(distillation)),
s AS (SELECT record_id, unnest(json_extract(j, '$.samples[*]')) AS e FROM v WHERE json_type(j) = 'OBJECT' AND json_type(j, '$.samples') = 'ARRAY'),
m AS (SELECT record_id, unnest(json_keys(j)) AS k, j FROM d WHERE json_type(j) = 'OBJECT'),
t AS (SELECT record_id, 'verification' AS field, json_extract_string(e, '$.index') AS slot, n AS text_name, json_extract_string(e, '$.' || n) AS x FROM s, (VALUES ('reasoning'), ('solution')) q(n)
UNION ALL SELECT record_id, 'distillation', k, n, json_extract_string(j, '$."' || k || '".' || n) FROM m, (VALUES ('reasoning'), ('solution')) q(n)),
w AS (SELECT *, regexp_extract_all(lower(x), '[\\p{L}\\p{N}]+') AS w FROM t WHERE x IS NOT NULL),
g AS (SELECT * EXCLUDE (x), list_transform(range(1, len(w) - 4), lambda i: array_to_string(w[i:i + 5], ' ')) AS g FROM w WHERE len(w) >= 12),
r AS (SELECT *, list_filter(range(1, len(w) - 4), lambda i: list_position(g, g[i]) < i) AS again FROM g)
SELECT DISTINCT record_id, field, slot, text_name FROM r WHERE len(list_distinct(flatten(list_transform(again, lambda i: range(i, i + 6))))) >= 0.3 * len(w)"""
_TEXTS = _SQL.split("\ng AS (")[0].rstrip(",")
_SHARES = f"""{_TEXTS},
g AS (SELECT record_id, field, slot, text_name, len(w) AS n, list_transform(range(1, len(w) - 4), lambda i: array_to_string(w[i:i + 5], ' ')) AS g FROM w),
z AS (SELECT *, len(list_distinct(flatten(list_transform(list_filter(range(1, n - 4), lambda i: list_position(g, g[i]) < i), lambda i: range(i, i + 6))))) AS c FROM g)
SELECT record_id, field, slot, text_name, max(n)::BIGINT AS n_words, max(CASE WHEN n >= 12 THEN round(coalesce(c, 0)::DOUBLE / n, 9) ELSE 0.0 END)::DOUBLE AS repeated_share FROM z GROUP BY record_id, field, slot, text_name"""
ORACLES = {"p2_found": _SQL, "p2_shares": _SHARES}
