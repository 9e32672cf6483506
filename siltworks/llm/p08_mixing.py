"""Problem 8: mixing sources to target weights.

Method: temperature mixing. With p the sources' shares of all tokens and t the target shares, the
weights are q(e) ~ p^(1-e) * t^e: exponent 0 leaves the sources as they are, 1 gives the targets.
For each source the exponent is bisected to the largest one that it can follow without repeating a
document more than ``max_repeats`` times (``reach``). ``p8_found`` are the sources that can't follow
to 1, that is, to their target share. They are pinned at what they can give; for the others the
exponent is bisected again, to the largest one at which none of them breaks its limit
(``limited``). Likewise ``temper`` bisects the exponent of q ~ p^e to a target entropy.

The weights are realised as budgeted block permutations: each source's documents are put in an
order by a salted hash and cut into hash blocks of about ``BLOCK`` documents. A source's budget is
so many full passes over the order and a part of one more; for that part whole blocks are taken
by prefix sums over block totals, and only the block in which the budget ends is summed document
by document. No task ever holds a whole source, and no document is used more than allowed.

Sizes are tokens of a public byte-level vocabulary whose folder is a parameter. Sources are the
rows of the targets table (the result has one row for each), so driver-side work is bounded by
that table, which is fixed; it is refused above ``SOURCES`` rows.

Defined results: documents of null or unlisted sources take no part; null or blank texts have 0
or few tokens; a ``doc_id`` delivered twice counts once; a source without documents reaches
nothing; targets with null source or share are ignored; a source listed twice keeps its larger
share; null ``max_repeats`` counts as 1.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltworks import runtime
from siltworks.functions import tokens

BLOCK = 5_000
SOURCES = 100_000
STEPS = 60


def _count(folder: str):
    def run(batches):
        for b in batches:
            n = [tokens.count(t, folder) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], ["doc_id", "source", "n_tokens"])

    return run


def sized(docs: DataFrame, targets: DataFrame, folder: str = tokens.VOCABULARIES) -> DataFrame:
    """``(doc_id, source, n_tokens)`` of the documents of listed sources, written once."""
    tokens.share(docs.sparkSession, folder)
    listed = targets.select("source").where("source is not null and target_share is not null").distinct()
    mine = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text")).where("doc_id is not null").join(F.broadcast(listed), "source", "left_semi")
    out = runtime.fit_partitions(mine).select("doc_id", "source", "text").mapInArrow(_count(folder), "doc_id long, source string, n_tokens long")
    return runtime.materialize(out.groupBy("doc_id").agg(F.min("source").alias("source"), F.max("n_tokens").alias("n_tokens")), "p08-sizes")


def _targets(targets: DataFrame) -> list[tuple[str, float, int]]:
    t = targets.where("source is not null and target_share is not null").groupBy("source").agg(F.max("target_share").alias("s"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("r"))
    rows = t.limit(SOURCES + 1).collect()
    if len(rows) > SOURCES:
        raise ValueError(f"more than {SOURCES} sources")
    return sorted((r["source"], float(r["s"]), int(r["r"])) for r in rows)


def _normal(w: list[float]) -> list[float]:
    total = sum(w)
    return [x / total if total else 0.0 for x in w]


def temper(shares: list[float], entropy: float, steps: int = STEPS) -> tuple[float, list[float]]:
    """(exponent, weights): ``shares`` to the exponent whose entropy in bits is nearest ``entropy``.

    Exponent 0 is uniform over the sources that have any share, 1 the shares themselves.
    """
    weights = lambda e: _normal([x**e if x > 0 else 0.0 for x in shares])
    bits = lambda w: -sum(x * math.log2(x) for x in w if x > 0)
    lo, hi = 0.0, 64.0  # entropy falls as the exponent grows
    for _ in range(steps):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if bits(weights(mid)) > entropy else (lo, mid)
    return hi, weights(hi)


def reach(have: list[int], share: list[float], repeats: list[int], steps: int = STEPS) -> list[float]:
    """For each source the exponent to which it can follow its target within its limit: 1, or what bisection finds below."""
    total = sum(have)
    p = _normal([float(x) for x in have])
    logs = [(math.log(a), math.log(b)) if a > 0 and b > 0 else None for a, b in zip(p, share, strict=True)]

    def follows(i: int, e: float) -> bool:
        if e == 1.0:
            return have[i] * repeats[i] >= share[i] * total
        if logs[i] is None:
            return have[i] > 0 or share[i] == 0
        all_of = sum(math.exp((1 - e) * x[0] + e * x[1]) for x in logs if x)
        return math.exp((1 - e) * logs[i][0] + e * logs[i][1]) <= repeats[i] * p[i] * all_of + 1e-15

    out = []
    for i in range(len(have)):
        if follows(i, 1.0):
            out.append(1.0)
            continue
        lo, hi = 0.0, 1.0 if have[i] else 0.0
        for _ in range(steps):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if follows(i, mid) else (lo, mid)
        out.append(min(lo, math.nextafter(1.0, 0.0)))
    return out


def limited(have: list[int], share: list[float], repeats: list[int], steps: int = STEPS) -> tuple[float, list[float], list[float]]:
    """(exponent, weights, reach): the bisected exponent and weights of the mix, and how far each source can follow.

    The budget is the sum of ``have``; weights are in the order of the arguments.
    """
    far = reach(have, share, repeats, steps)
    short = [e < 1.0 for e in far]
    p, t = _normal([float(x) for x in have]), _normal(share)
    cap = [r * x for r, x in zip(repeats, p, strict=True)]
    left = 1.0 - sum(c for c, x in zip(cap, short, strict=True) if x)

    def weights(e: float) -> list[float]:
        rest = _normal([a ** (1 - e) * b**e if a > 0 and b > 0 and not x else 0.0 for a, b, x in zip(p, t, short, strict=True)])
        return [c if x else left * w for c, x, w in zip(cap, short, rest, strict=True)]

    def fits(w: list[float]) -> bool:
        return all(x <= c + 1e-12 for x, c in zip(w, cap, strict=True))

    lo, hi = 0.0, 1.0
    if fits(weights(1.0)):
        lo = 1.0
    else:
        for _ in range(steps):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if fits(weights(mid)) else (lo, mid)
    return lo, weights(lo), far


def _state(spark, sizes: DataFrame, targets: DataFrame):
    rows = _targets(targets)
    have = {r["source"]: int(r["n"]) for r in sizes.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    counts = [have.get(s, 0) for s, _, _ in rows]
    return rows, counts, limited(counts, [x for _, x, _ in rows], [r for _, _, r in rows])


def found(docs: DataFrame, targets: DataFrame, folder: str = tokens.VOCABULARIES) -> DataFrame:
    """``(source)``: sources that can't reach their target share within their repetition limit."""
    sizes = sized(docs, targets, folder)
    rows, _, (_, _, far) = _state(docs.sparkSession, sizes, targets)
    return docs.sparkSession.createDataFrame([(s,) for (s, _, _), e in zip(rows, far, strict=True) if e < 1.0], "source string")


def plan(docs: DataFrame, targets: DataFrame, seed: int = 42, folder: str = tokens.VOCABULARIES, sizes: DataFrame | None = None) -> DataFrame:
    """``(doc_id, source, n_tokens, times)``: how often each document is used in the mix."""
    spark = docs.sparkSession
    sizes = sized(docs, targets, folder) if sizes is None else sizes
    rows, counts, (_, weights, _) = _state(spark, sizes, targets)
    total = sum(counts)
    budget = [(s, int(q * total) // max(h, 1), int(q * total) % max(h, 1)) for (s, _, _), q, h in zip(rows, weights, counts, strict=True)]
    # a row a source: bounded by the targets table
    budgets = F.broadcast(spark.createDataFrame(budget, "source string, passes long, part long"))
    n = sizes.groupBy("source").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    at = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.col("blocks").cast("long")).cast("int")
    d = sizes.join(F.broadcast(n), "source").withColumn("block", at).drop("blocks")
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = d.groupBy("source", "block").agg(F.sum("n_tokens").alias("block_tokens")).withColumn("before", F.coalesce(F.sum("block_tokens").over(before), F.lit(0)))
    d = d.join(totals, ["source", "block"]).join(budgets, "source")
    inside = Window.partitionBy("source", "block").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    cut = (F.col("before") < F.col("part")) & (F.col("before") + F.col("block_tokens") > F.col("part"))
    whole = d.where(~cut).withColumn("more", (F.col("before") + F.col("block_tokens") <= F.col("part")).cast("long"))
    ended = d.where(cut).withColumn("more", (F.col("before") + F.sum("n_tokens").over(inside) <= F.col("part")).cast("long"))
    return whole.unionByName(ended).select("doc_id", "source", "n_tokens", (F.col("passes") + F.col("more")).alias("times"))


def report(docs: DataFrame, targets: DataFrame, folder: str = tokens.VOCABULARIES) -> DataFrame:
    """One row a source: tokens it has, target and mixed weight, how far it can follow its target, tokens used, most repeats, actual share."""
    spark = docs.sparkSession
    sizes = sized(docs, targets, folder)
    rows, counts, (exponent, weights, far) = _state(spark, sizes, targets)
    used = plan(docs, targets, folder=folder, sizes=sizes).groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("times")).alias("used_tokens"), F.max("times").alias("most_repeats"), F.sum("times").alias("used_documents"))
    base = spark.createDataFrame([(s, h, t, r, q, exponent, x, x < 1.0) for (s, t, r), h, q, x in zip(rows, counts, weights, far, strict=True)], "source string, tokens long, target_share double, max_repeats int, weight double, exponent double, reach double, short boolean")
    whole = Window.partitionBy()  # a row a source
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return base.join(used, "source", "left").select(*base.columns, zero("used_tokens"), zero("used_documents"), zero("most_repeats")).withColumn("actual_share", F.col("used_tokens") / F.greatest(F.sum("used_tokens").over(whole), F.lit(1)))


def budgets(docs: DataFrame, targets: DataFrame, folder: str = tokens.VOCABULARIES) -> DataFrame:
    """``(source, target_share, max_repeats, short, within_budget, within_repeats)``: whether the plan keeps
    each source's budget to within a document, never over it, and its repetition limit."""
    spark = docs.sparkSession
    sizes = sized(docs, targets, folder)
    rows, counts, (_, weights, far) = _state(spark, sizes, targets)
    total = sum(counts)
    base = spark.createDataFrame([(s, t, r, e < 1.0, int(q * total)) for (s, t, r), q, e in zip(rows, weights, far, strict=True)], "source string, target_share double, max_repeats int, short boolean, budget long")
    used = plan(docs, targets, folder=folder, sizes=sizes).groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("times")).alias("used"), F.max("times").alias("most"), F.max("n_tokens").alias("largest"))
    rest = F.col("budget") - F.coalesce("used", F.lit(0))
    return base.join(used, "source", "left").select("source", "target_share", "max_repeats", "short", ((rest >= 0) & (rest <= F.coalesce("largest", F.lit(0)))).alias("within_budget"), (F.coalesce("most", F.lit(0)) <= F.col("max_repeats")).alias("within_repeats"))


def _of(f):
    return lambda spark, d: f(runtime.table(spark, d, "documents"), runtime.table(spark, d, "mix_targets"))


QUERIES = {"p8_found": _of(found), "p8_mix": _of(report), "p8_plan": _of(plan), "p8_budgets": _of(budgets)}
#: Sizes in characters: any usual tokenizer gives the same sources.
_SIZES = """WITH t AS (SELECT source, max(target_share) AS s, max(coalesce(max_repeats, 1)) AS r FROM mix_targets WHERE source IS NOT NULL AND target_share IS NOT NULL GROUP BY 1),
d AS (SELECT t.source, coalesce(sum(length(x.text)), 0) AS n FROM t LEFT JOIN (SELECT DISTINCT doc_id, source, text FROM documents WHERE doc_id IS NOT NULL) x ON x.source = t.source GROUP BY 1)
"""
_SHORT = "n * r < s * (SELECT sum(n) FROM d)"
ORACLES = {
    "p8_found": f"{_SIZES} SELECT source FROM d JOIN t USING (source) WHERE {_SHORT}",
    "p8_budgets": f"{_SIZES} SELECT source, s AS target_share, r AS max_repeats, {_SHORT} AS short, true AS within_budget, true AS within_repeats FROM d JOIN t USING (source)",
}
