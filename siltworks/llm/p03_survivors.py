"""Problem 3: best representative of each duplicate group.

Method: iterative truth discovery. Every record of a group claims a value for each field. Sources
have a reliability; a value's support is the sum of the reliabilities of its claims (``votes``),
and a source's reliability is the mean share of support that its claims get (``discover``). Both
are re-estimated in turn until no reliability moves by more than ``EPSILON``; a run that hasn't
converged after ``ROUNDS`` rounds is an error. The value of highest support is chosen per field
(``chosen``). ``p3_fields`` and ``p3_sources`` work so, with the ``dataset_name`` as source.

For ``p3_found`` the reliabilities are given: the tiers say whom to trust, whatever the votes, so
there is nothing to estimate and the votes are taken once. Sources are the trust classes (tiers,
records of no tier a class after all others); the fields voted on are *which record survives* and
*which record supplies the answer*. Each record claims itself, where it has a value, and ties go to
the latest ``ingested_at`` and then the smallest ``record_id``.

Each round is aggregates over the claims and one row a source for the driver; more than ``SOURCES``
sources are refused. Groups are never collected: claims are aggregated map-side by group, field and
value, so a group that holds a third of all records is no hot task.

Defined results: records of a group that aren't in the records table rank last; of several rows of
a record the latest counts; null and blank ``dataset_name`` have no tier; null ``ingested_at``
ranks last; a group without any answer gets the empty string; empty tables give an empty result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks import runtime
from siltworks.functions import text
from siltworks.llm.p01_groups import groups
from siltworks.llm.p04_pairs import is_empty
from siltworks.plans.sqltext import strip

EPSILON = 1e-4
ROUNDS = 100
SOURCES = 50_000
#: Decimal places to which supports are compared, so that the order of a sum doesn't break ties.
PLACES = 9
FIELDS = ["question", "raw_dataset_answer", "confirmed_answer"]


def votes(claims: DataFrame, trust: dict, kind: str) -> DataFrame:
    """``(group_id, field, value, support, age)`` of claims ``(group_id, field, value, source, age)``: the trust in all who claim the value."""
    w = F.broadcast(claims.sparkSession.createDataFrame(list(trust.items()), f"source {kind}, trust double"))  # at most SOURCES rows
    v = claims.where("value is not null").join(w, "source")
    return v.groupBy("group_id", "field", "value").agg(F.round(F.sum("trust"), PLACES).alias("support"), F.min("age").alias("age"))


def chosen(supported: DataFrame) -> DataFrame:
    """``(group_id, field, value, support)``: the value of highest support, on ties the least age, then the smallest."""
    best = supported.groupBy("group_id", "field").agg(F.min(F.struct((-F.col("support")).alias("s"), "age", F.col("value").alias("v"))).alias("b"))
    return best.select("group_id", "field", F.col("b.v").alias("value"), (-F.col("b.s")).alias("support"))


def discover(claims: DataFrame) -> dict:
    """Reliability by source from claims ``(group_id, field, value, source)``."""
    c = runtime.materialize(claims.where("value is not null").groupBy("group_id", "field", "value", "source").agg(F.count("*").alias("n")), "p03-claims")
    spark = claims.sparkSession
    names = [r["source"] for r in c.select("source").distinct().limit(SOURCES + 1).collect()]
    if len(names) > SOURCES:
        raise ValueError(f"more than {SOURCES} sources")
    trust = dict.fromkeys(names, 0.5)
    kind = dict(c.dtypes)["source"]
    for _ in range(ROUNDS if names else 0):
        w = F.broadcast(spark.createDataFrame(list(trust.items()), f"source {kind}, trust double"))  # at most SOURCES rows
        vote = c.join(w, "source").withColumn("vote", F.col("trust") * F.col("n"))
        support = vote.groupBy("group_id", "field", "value").agg(F.sum("vote").alias("support"), F.collect_set("source").alias("sources"))
        total = support.groupBy("group_id", "field").agg(F.sum("support").alias("total"))
        share = support.join(total, ["group_id", "field"]).select(F.explode("sources").alias("source"), (F.col("support") / F.col("total")).alias("share"))
        new = {r["source"]: r["share"] for r in share.groupBy("source").agg(F.avg("share").alias("share")).collect()}
        new = {s: 0.01 + 0.98 * float(new.get(s, 0.0)) for s in names}
        moved = max(abs(new[s] - trust[s]) for s in new)
        trust = new
        if moved < EPSILON:
            break
    else:
        if names:
            raise RuntimeError(f"reliabilities did not converge in {ROUNDS} rounds")
    runtime.discard(c)
    return trust


_MEMBER = "group_id string, record_id string, ingested_at timestamp, dataset_name string"


def _answered(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array([not is_empty(a) for a in b.column(4).to_pylist()], pa.bool_())], ["group_id", "record_id", "ingested_at", "dataset_name", "answered"])


def _tiers(tiers: DataFrame) -> DataFrame:
    return tiers.where("dataset_name is not null and tier is not null").groupBy("dataset_name").agg(F.min(F.col("tier").cast("int")).alias("tier"))


def members(pairs: DataFrame, records: DataFrame, fields: list[str]) -> DataFrame:
    """``(group_id, record_id, ingested_at, dataset_name, *fields)`` with the latest row of each record of a group."""
    g = runtime.materialize(groups(pairs), "p03-groups")
    columns = ["ingested_at", "dataset_name", *fields]
    m = g.join(records.select("record_id", F.struct(*columns).alias("r")), "record_id", "left")
    return m.groupBy("record_id", "group_id").agg(F.max("r").alias("r")).select("group_id", "record_id", *(F.col(f"r.{c}") for c in columns))


def found(pairs: DataFrame, records: DataFrame, tiers: DataFrame) -> DataFrame:
    """``(group_id, record_id, answer_record_id)``: the survivor and who supplies the answer."""
    t = runtime.materialize(_tiers(tiers), "p03-tiers")
    if t.count() > SOURCES:
        raise ValueError(f"more than {SOURCES} tiers")
    last = 2**31 - 1
    m = members(pairs, records, ["raw_dataset_answer"]).mapInArrow(_answered, f"{_MEMBER}, answered boolean")
    m = m.join(F.broadcast(t), "dataset_name", "left").withColumn("source", F.coalesce("tier", F.lit(last)))  # at most SOURCES rows
    m = runtime.materialize(m.select("group_id", "record_id", "source", "answered", F.coalesce(-F.unix_micros("ingested_at"), F.lit(2**63 - 1)).alias("age")), "p03-classed")
    each = F.explode(F.array(F.struct(F.lit("survivor").alias("field"), F.col("record_id").alias("value")), F.struct(F.lit("answer").alias("field"), F.when(F.col("answered"), F.col("record_id")).alias("value"))))
    claims = m.select("group_id", "source", "age", each.alias("c")).select("group_id", "source", "age", "c.*")
    classes = sorted(r["source"] for r in m.select("source").distinct().collect())  # tiers, at most SOURCES
    best = chosen(votes(claims, {c: 1.0 - i / (len(classes) + 1) for i, c in enumerate(classes)}, "int"))
    value = lambda f: F.max(F.when(F.col("field") == f, F.col("value")))
    return best.groupBy("group_id").agg(value("survivor").alias("record_id"), F.coalesce(value("answer"), F.lit("")).alias("answer_record_id"))


def _by_dataset(m: DataFrame) -> DataFrame:
    source = F.coalesce(F.nullif(text.strip(F.col("dataset_name")), F.lit("")), F.lit("(none)")).alias("source")
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.nullif(text.strip(F.col(f)), F.lit("")).alias("value")) for f in FIELDS)))
    return m.select("group_id", source, F.lit(0).alias("age"), each.alias("c")).select("group_id", "source", "age", "c.*").where("value is not null")


def fields(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """``(group_id, field, value, support)``: the value of highest support of each field, smallest on ties."""
    claims = runtime.materialize(_by_dataset(members(pairs, records, FIELDS)), "p03-fields")
    return chosen(votes(claims, discover(claims), "string")).withColumn("support", F.round("support", 6))


def sources(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """``(source, reliability)``."""
    trust = discover(_by_dataset(members(pairs, records, FIELDS)))
    return records.sparkSession.createDataFrame([(s, round(x, 6)) for s, x in trust.items()], "source string, reliability double")


def _of(f, *names):
    return lambda spark, d: f(*(runtime.table(spark, d, n) for n in names))


QUERIES = {
    "p3_found": _of(found, "dedup_pairs", "canonical_records", "dataset_tiers"),
    "p3_fields": _of(fields, "dedup_pairs", "canonical_records"),
    "p3_sources": _of(sources, "dedup_pairs", "canonical_records"),
}
_SQUEEZED = "lower(array_to_string(regexp_extract_all(regexp_replace(raw_dataset_answer, '\\\\(?:boxed|text)', '', 'g'), '[\\p{L}\\p{N}]+'), ''))"
_SQL = f"""WITH RECURSIVE e AS MATERIALIZED (SELECT DISTINCT left_id AS a, right_id AS b FROM dedup_pairs WHERE left_id <> right_id AND similarity >= 0.8 AND NOT isnan(similarity)),
s AS MATERIALIZED (SELECT a x, b y FROM e UNION SELECT b, a FROM e UNION SELECT a, a FROM e UNION SELECT b, b FROM e), r AS (SELECT x, y FROM s UNION SELECT r.x, s.y FROM r JOIN s ON r.y = s.x), g AS (SELECT min(y) AS group_id, x AS record_id FROM r GROUP BY x),
c AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY ingested_at DESC) AS k FROM canonical_records),
m AS (SELECT g.group_id, g.record_id, coalesce(t.tier, 2147483647) AS tier, c.ingested_at, NOT (raw_dataset_answer IS NULL OR {_SQUEEZED} IN ('', {", ".join(f"'{x}'" for x in ("answer", "na", "none", "null", "nan", "tbd", "unknown", "notavailable", "noanswer"))})) AS answered
FROM g LEFT JOIN c ON c.record_id = g.record_id AND c.k = 1 LEFT JOIN dataset_tiers t USING (dataset_name)),
o AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY tier, ingested_at DESC NULLS LAST, record_id) AS n FROM m)
SELECT group_id, arg_min(record_id, n) AS record_id, coalesce(arg_min(record_id, n) FILTER (WHERE answered), '') AS answer_record_id FROM o GROUP BY 1"""
_ROUNDS_SQL = 40
_LATEST = ", ".join(f"{c} DESC NULLS LAST" for c in ("ingested_at", "dataset_name", *FIELDS))
_GROUPED = _SQL.split("c AS (")[0]
_CLAIMS = f"""{_GROUPED}
c AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY {_LATEST}) AS k FROM canonical_records),
m AS MATERIALIZED (SELECT g.group_id, coalesce(nullif({strip('c.dataset_name')}, ''), '(none)') AS source, {", ".join(f"nullif({strip(f)}, '') AS {f}" for f in FIELDS)} FROM g LEFT JOIN c ON c.record_id = g.record_id AND c.k = 1),
k AS MATERIALIZED (SELECT group_id, field, value, source, count(*) AS n FROM ({" UNION ALL ".join(f"SELECT group_id, '{f}' AS field, {f} AS value, source FROM m" for f in FIELDS)}) WHERE value IS NOT NULL GROUP BY ALL),
t0 AS MATERIALIZED (SELECT DISTINCT source, 0.5::DOUBLE AS trust, 1.0::DOUBLE AS moved FROM k)"""
#: The rounds one by one; the first whose reliabilities moved by less than EPSILON counts.
_DISCOVER = _CLAIMS + "".join(f""",
t{i} AS MATERIALIZED (SELECT s.source, 0.01 + 0.98 * avg(s.share) AS trust, max(abs(0.01 + 0.98 * avg(s.share) - any_value(o.trust))) OVER () AS moved FROM (SELECT k.source, v.support / t.total AS share FROM k
JOIN (SELECT group_id, field, value, sum(n * trust) AS support FROM k JOIN t{i - 1} USING (source) GROUP BY 1, 2, 3) v USING (group_id, field, value)
JOIN (SELECT group_id, field, sum(n * trust) AS total FROM k JOIN t{i - 1} USING (source) GROUP BY 1, 2) t USING (group_id, field)) s JOIN t{i - 1} o USING (source) GROUP BY s.source)""" for i in range(1, _ROUNDS_SQL + 1)) + f""",
every AS ({" UNION ALL ".join(f"SELECT {i} AS round, * FROM t{i}" for i in range(1, _ROUNDS_SQL + 1))}),
trust AS (SELECT source, trust FROM every WHERE round = (SELECT min(round) FROM every WHERE moved < {EPSILON}))"""
ORACLES = {
    "p3_found": _SQL,
    "p3_sources": f"{_DISCOVER} SELECT source, round(trust, 6) AS reliability FROM trust",
    "p3_fields": f"{_DISCOVER}, v AS (SELECT group_id, field, value, round(sum(n * trust), {PLACES}) AS support FROM k JOIN trust USING (source) GROUP BY 1, 2, 3) SELECT group_id, field, value, round(support, 6) AS support FROM (SELECT *, row_number() OVER (PARTITION BY group_id, field ORDER BY support DESC, value) AS o FROM v) WHERE o = 1",
}
