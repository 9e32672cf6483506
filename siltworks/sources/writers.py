"""Sinks: canonical corpora, side tables and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks import schema
from siltworks.operators.clean import col
from siltworks.operators.evaluate import rollouts
from siltworks.operators.relational import audit, effective_phase, keep_ids

#: Bytes a shard should have, and what a record is taken to have until it is known.
SHARD_BYTES = 200 << 20


def write_canonical(df: DataFrame, path: str, files: int | None = None, records_per_file: int = 0) -> None:
    """Encoded records as Parquet; an empty corpus keeps its schema."""
    out = schema.encode(df).select(*(schema.COLUMNS + [c for c in df.columns if c not in schema.COLUMNS]))
    if files:
        out = out.coalesce(files)
    w = out.write.mode("overwrite").option("compression", "snappy")
    (w.option("maxRecordsPerFile", records_per_file) if records_per_file else w).parquet(path)


def write_shards(df: DataFrame, path: str, shard_bytes: int = SHARD_BYTES) -> None:
    """Shards of about ``shard_bytes`` of text, sized from the mean length of the records."""
    out = schema.encode(df)
    size = out.select(F.count("*").alias("n"), F.avg(sum((F.coalesce(F.length(c), F.lit(0)) for c in schema.COLUMNS), F.lit(0))).alias("mean")).first()
    each = max(1, int(shard_bytes / max(size["mean"] or 1.0, 1.0)))
    out.write.mode("overwrite").option("maxRecordsPerFile", each).parquet(path)


def write_pairs(pairs: DataFrame, path: str) -> None:
    pairs.write.mode("overwrite").parquet(path)


def write_results(df: DataFrame, path: str) -> None:
    """The audit table: one row a trace event."""
    audit(df).write.mode("overwrite").parquet(path)


def write_kept(df: DataFrame, ids: DataFrame, path: str, unique: bool = False) -> None:
    write_canonical(keep_ids(df, ids, unique), path)


def split_by_phase(df: DataFrame, path: str) -> None:
    """One directory for each of drop, midtrain and posttrain."""
    schema.encode(df).withColumn("bucket", effective_phase(col("training_phase"))).write.mode("overwrite").partitionBy("bucket").parquet(path)


def write_judgements(judged: DataFrame, path: str) -> None:
    """Side table of judged pairs."""
    judged.select("left_id", "right_id", "is_duplicate", "reply", "error").write.mode("overwrite").parquet(path)


def write_rollouts(df: DataFrame, path: str) -> None:
    """Side table of rollout results: one row a record with samples."""
    rollouts(df).write.mode("overwrite").parquet(path)
