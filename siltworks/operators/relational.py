"""Joins, reports and sampling over canonical records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks import runtime, schema
from siltworks.operators.clean import col


def positions(df: DataFrame, *order: str) -> DataFrame:
    """Adds ``position``, the row's place in the order, without sorting everything in one task."""
    d = runtime.materialize(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "positions")
    part = F.shiftright("_at", 33).alias("_part")
    # a row a partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = d.groupBy(part).agg(F.count("*").alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    d = d.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return d.select(*df.columns, (F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).alias("position"))


def keep_ids(df: DataFrame, ids: DataFrame, unique: bool = False) -> DataFrame:
    """Rows whose ``record_id`` is listed; with ``unique`` one row an id (the least by all columns)."""
    out = df.join(ids.select("record_id").distinct(), "record_id", "left_semi")
    if not unique:
        return out
    rest = [c for c in out.columns if c != "record_id"]
    return out.groupBy("record_id").agg(F.min(F.struct(*rest)).alias("_r")).select("record_id", "_r.*").select(*df.columns)


def drop_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    return df.join(ids.select("record_id").distinct(), "record_id", "left_anti")


def merge(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing rows, and of each id they lack the first new row (the least by all columns)."""
    rest = [c for c in new.columns if c != "record_id"]
    first = new.groupBy("record_id").agg(F.min(F.struct(*rest)).alias("_r")).select("record_id", "_r.*")
    return existing.unionByName(first.join(existing.select("record_id"), "record_id", "left_anti").select(*existing.columns))


def pre_tag(df: DataFrame, source: DataFrame, field: str, value: str, phase: str, tag: str = "") -> DataFrame:
    """Sets phase and tag of the records whose ``uid`` has ``value`` in a (dotted) field of the source."""
    uids = source.where(F.col(field).cast("string") == value).select(F.col("uid").alias("record_id")).distinct().withColumn("_hit", F.lit(True))
    out = df.join(uids, "record_id", "left")
    return out.withColumns({"training_phase": F.when(F.col("_hit"), phase).otherwise(col("training_phase")), "filter_tag": F.when(F.col("_hit"), tag or F.col("filter_tag")).otherwise(F.col("filter_tag"))}).drop("_hit")


def effective_phase(c: Column) -> Column:
    """Whatever isn't drop or midtrain is posttrain."""
    return F.when(c.isin("drop", "midtrain"), c).otherwise("posttrain")


def stats(df: DataFrame) -> DataFrame:
    filled = F.coalesce(F.trim("distillation"), F.lit("")).isin("", "{}", "null")
    return df.groupBy(col("dataset_name").alias("dataset_name")).agg(F.count("*").alias("records"), F.count_if(~filled).alias("with_distillation"))


def phase_matrix(df: DataFrame) -> DataFrame:
    p = effective_phase(col("training_phase"))
    count = lambda x: F.count_if(p == x).alias(x)
    return df.groupBy(col("dataset_name").alias("dataset_name")).agg(count("posttrain"), count("midtrain"), count("drop"), F.count("*").alias("total"))


def tag_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(col("dataset_name").alias("dataset_name"), col("filter_tag").alias("filter_tag")).agg(F.count("*").alias("records"))


def trace_counts(df: DataFrame) -> DataFrame:
    """Events by dataset, processor and status; the audit table of a corpus in short."""
    t = schema.decode(df.select(col("dataset_name").alias("dataset_name"), "trace"), "trace")
    return t.select("dataset_name", F.explode("trace").alias("e")).groupBy("dataset_name", "e.processor", "e.status").agg(F.count("*").alias("events"))


def audit(df: DataFrame) -> DataFrame:
    """One row an event: the processor results of a corpus."""
    t = schema.decode(df.select("record_id", "trace"), "trace")
    return t.select("record_id", F.posexplode("trace").alias("step", "e")).select("record_id", "step", "e.stage", "e.processor", "e.status", "e.reason_code", "e.details", "e.created_at")


def stage_matrix(stages: dict[str, DataFrame]) -> DataFrame:
    """Records by dataset at each stage, with a total row and what was lost from first to last."""
    rows = None
    for name, df in stages.items():
        part = df.select(col("dataset_name").alias("dataset_name"), F.lit(name).alias("stage"))
        rows = part if rows is None else rows.unionByName(part)
    names = list(stages)
    out = rows.rollup("dataset_name").agg(*(F.count_if(F.col("stage") == n).alias(n) for n in names))
    return out.withColumn("dataset_name", F.coalesce("dataset_name", F.lit("(total)"))).withColumn("lost", F.col(names[0]) - F.col(names[-1]))


def compare_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Records by dataset before and after, datasets of either side."""
    a = before.groupBy(col("dataset_name").alias("dataset_name")).agg(F.count("*").alias("before"))
    b = after.groupBy(col("dataset_name").alias("dataset_name")).agg(F.count("*").alias("after"))
    out = a.join(b, "dataset_name", "full")
    return out.select("dataset_name", F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Counts of a column's values and their share of all in percent."""
    n = df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("(null)")).alias("value")).agg(F.count("*").alias("records"))
    total = df.agg(F.count("*").alias("total"))
    return n.crossJoin(F.broadcast(total)).select("value", "records", F.round(100.0 * F.col("records") / F.col("total"), 4).alias("percent"))  # total is one row


def latency_summary(df: DataFrame, seconds: str = "seconds", exact: bool = True) -> DataFrame:
    """Requests, mean and percentiles. Exact percentiles count every value apart, for some 100 million requests;
    ``exact=False`` takes a sketch with a relative error of 1e-4 in rank."""
    if not exact:
        p = F.percentile_approx(seconds, F.array(F.lit(0.5), F.lit(0.99)), 10_000)
        return df.agg(F.count("*").alias("requests"), F.avg(seconds).alias("mean"), p.alias("p")).select("requests", "mean", F.col("p")[0].alias("p50"), F.col("p")[1].alias("p99"))
    return df.agg(F.count("*").alias("requests"), F.avg(seconds).alias("mean"), F.percentile(seconds, 0.5).alias("p50"), F.percentile(seconds, 0.99).alias("p99"))


def validate(df: DataFrame) -> DataFrame:
    """``(record_id, problem)`` for blank ids, questions and dataset names."""
    tests = [F.when(F.trim(col(c)) == "", F.lit(f"empty {c}")) for c in ("record_id", "question", "dataset_name")]
    return df.select(col("record_id").alias("record_id"), F.explode(F.filter(F.array(*tests), lambda x: x.isNotNull())).alias("problem"))


def hash_order(seed: int, c: str = "record_id") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), col(c)))


def sample(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n rows in the order of a seeded hash."""
    return df.orderBy(hash_order(seed), "record_id").limit(n)


def stratified_sample(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n rows of those not dropped, by dataset in proportion, largest remainders first (ties: later name).

    Within a dataset the rows come in the order of a seeded hash.
    """
    active = df.where(col("training_phase") != "drop").withColumn("_d", col("dataset_name"))
    size = active.groupBy("_d").agg(F.count("*").alias("size"))
    everything = Window.partitionBy()  # a row a dataset
    q = size.withColumn("all", F.sum("size").over(everything)).withColumn("raw", F.lit(float(n)) * F.col("size") / F.col("all"))
    q = q.withColumn("base", F.least(F.col("size"), F.floor("raw"))).withColumn("rank", F.row_number().over(Window.orderBy(F.desc(F.col("raw") - F.col("base")), F.desc("_d"))))
    q = q.withColumn("left", F.lit(n) - F.sum("base").over(everything)).withColumn("quota", F.when(F.lit(n) >= F.col("all"), F.col("size")).otherwise(F.least(F.col("size"), F.col("base") + (F.col("rank") <= F.col("left")).cast("int"))))
    # the first rows of a dataset by hash, without sorting a dataset in one task: whole hash buckets by
    # prefix sums, and only the bucket in which the quota ends is ordered row by row
    ranked = active.withColumn("_h", hash_order(seed)).withColumn("_b", F.substring("_h", 1, 4)).join(F.broadcast(q.select("_d", "quota")), "_d")
    before = Window.partitionBy("_d").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = ranked.groupBy("_d", "_b").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    ranked = ranked.join(buckets, ["_d", "_b"]).where("_before < quota")
    whole = ranked.where("_before + _n <= quota")
    w = Window.partitionBy("_d", "_b").orderBy("_h", "record_id")
    part = ranked.where("_before + _n > quota").withColumn("_k", F.row_number().over(w)).where("_before + _k <= quota")
    return whole.select(*df.columns).unionByName(part.select(*df.columns))


def sample_usefulness(df: DataFrame) -> DataFrame:
    """Of the samples of rows whose majority misses the truth: how many have an answer, and are judged right."""
    v = schema.decode(df.select("dataset_name", "verification"), "verification").where("verification.majority_matches_gt = false")
    s = v.select(col("dataset_name").alias("dataset_name"), F.explode("verification.samples").alias("s"))
    return s.groupBy("dataset_name").agg(F.count("*").alias("samples"), F.count_if(F.coalesce("s.answer", F.lit("")) != "").alias("with_answer"), F.count_if(F.coalesce("s.judge_correct", F.lit(False))).alias("judged_right"))
