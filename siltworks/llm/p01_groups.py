"""Problem 1: consolidating pairwise matches into groups.

Method: randomised graph contraction. In each round every vertex draws a fresh hash; it hooks to
the least hash among itself and its neighbours. Edges are relabelled by the hooks, loops and
doubles dropped, and the round is repeated on the contracted graph until no edge is left; a
constant share of the vertices goes in each round, whatever the shape (long chains included), so
there are O(log n) rounds. The hooks of all rounds are then expanded from the last to the first.

Each round is one aggregate (the least hash combines map-side, so a record with very many pairs
is no hot task) and two relabelling joins. Vertices with more than ``1 / HEAVY`` of all edge ends
are relabelled by a broadcast, which holds at most ``HEAVY`` rows; the rest by a shuffle in which
no key has more rows than that share. Rounds end in tables of the shared folder.

Defined results: pairs with a null id, null or NaN similarity, or similarity under the threshold
don't count, nor do self-pairs; orientation and repetition don't matter; extra columns are
ignored; an empty table gives no groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks import runtime

THRESHOLD = 0.8
HEAVY = 1_000
#: Rounds after which the hash is surely at fault; 2**ROUNDS is far above any number of vertices.
ROUNDS = 200


def edges(pairs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(a, b)``, a < b, of the pairs that count."""
    s = F.col("similarity").cast("double")
    ok = F.col("left_id").isNotNull() & F.col("right_id").isNotNull() & s.isNotNull() & ~F.isnan(s) & (s >= threshold) & (F.col("left_id") != F.col("right_id"))
    return pairs.where(ok).select(F.least("left_id", "right_id").alias("a"), F.greatest("left_id", "right_id").alias("b")).distinct()


def _relabel(e: DataFrame, hooks: DataFrame, heavy: DataFrame, side: str) -> DataFrame:
    other = "b" if side == "a" else "a"
    h = heavy.select(F.col("v").alias(side), F.col("to").alias("heavy_to"))
    e = e.join(F.broadcast(h), side, "left")  # at most HEAVY rows
    done = e.where("heavy_to is not null").select(F.col("heavy_to").alias(side), other)
    rest = e.where("heavy_to is null").select(side, other).join(hooks.select(F.col("v").alias(side), "to"), side).select(F.col("to").alias(side), other)
    return done.unionByName(rest)


def components(e: DataFrame) -> DataFrame:
    """``(v, root)`` for every vertex of the edges ``(a, b)``; the root is one vertex of its component."""
    spark = e.sparkSession
    e = runtime.materialize(e, "p01-edges")
    left = e.count()
    rounds: list[DataFrame] = []
    while left:
        if len(rounds) == ROUNDS:
            raise RuntimeError("contraction doesn't end")
        seed = F.lit(len(rounds) + 1)
        ends = e.select(F.col("a").alias("v"), F.col("b").alias("w")).unionByName(e.select(F.col("b").alias("v"), F.col("a").alias("w")))
        draw = lambda c: F.struct(F.xxhash64(seed, F.lit("hook"), c).alias("h"), F.col(c).alias("to"))  # noqa: E731, B023
        hooks = ends.groupBy("v").agg(F.min(draw("w")).alias("m"), F.count("*").alias("degree")).select("v", F.least("m", draw("v"))["to"].alias("to"), "degree")
        hooks = runtime.materialize(hooks, "p01-hooks")
        heavy = hooks.where(F.col("degree") > max(1, 2 * left // HEAVY))
        before, moved = e, _relabel(_relabel(e, hooks, heavy, "a"), hooks, heavy, "b").where("a <> b")
        e = runtime.materialize(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "p01-edges")
        runtime.discard(before)
        rounds.append(hooks.select("v", "to"))
        left = e.count()
    if not rounds:
        return spark.createDataFrame([], "v string, root string")
    # expand: a vertex that a round hooked goes where its hook went in later rounds
    final = rounds.pop().select("v", F.col("to").alias("root"))
    while rounds:
        step = rounds.pop()
        size = final.select(F.col("v").alias("to"), "root")
        before, final = final, runtime.materialize(step.join(size, "to", "left").select("v", F.coalesce("root", "to").alias("root")), "p01-roots")
        runtime.discard(before, step)
    return final


def groups(pairs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(group_id, record_id)``: every record of a group of two or more; the id is the group's smallest."""
    c = components(edges(pairs, threshold))
    names = c.groupBy("root").agg(F.min("v").alias("group_id"))
    return c.join(names, "root").select("group_id", F.col("v").alias("record_id"))


def sizes(pairs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(group_size, n_groups)``."""
    g = groups(pairs, threshold).groupBy("group_id").agg(F.count("*").alias("group_size"))
    return g.groupBy("group_size").agg(F.count("*").alias("n_groups"))


_COUNTING = "SELECT DISTINCT least(left_id, right_id) a, greatest(left_id, right_id) b FROM dedup_pairs WHERE left_id IS NOT NULL AND right_id IS NOT NULL AND similarity IS NOT NULL AND NOT isnan(similarity) AND similarity >= 0.8 AND left_id <> right_id"
_GROUPS = f"""WITH RECURSIVE e AS MATERIALIZED ({_COUNTING}),
s AS MATERIALIZED (SELECT a x, b y FROM e UNION SELECT b, a FROM e UNION SELECT a, a FROM e UNION SELECT b, b FROM e),
r AS (SELECT x, y FROM s UNION SELECT r.x, s.y FROM r JOIN s ON r.y = s.x)
SELECT min(y) AS group_id, x AS record_id FROM r GROUP BY x"""

QUERIES = {
    "p1_found": lambda spark, d: groups(runtime.table(spark, d, "dedup_pairs")),
    "p1_sizes": lambda spark, d: sizes(runtime.table(spark, d, "dedup_pairs")),
}
ORACLES = {
    "p1_found": _GROUPS,
    "p1_sizes": f"SELECT n AS group_size, count(*) AS n_groups FROM (SELECT group_id, count(*) n FROM ({_GROUPS}) GROUP BY 1) GROUP BY 1",
}
