"""Structured Streaming over canonical records: cleaning is stateless, deduplication keeps bounded state.

Beyond batch: record operators are projections, so they run unchanged on a stream of arriving files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from siltworks import schema
from siltworks.operators.clean import PROCESSORS, col
from siltworks.operators.dedup import text_key


def read(spark: SparkSession, path: str, source_schema: StructType, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(source_schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def clean(stream: DataFrame, names: list[str]) -> DataFrame:
    for n in names:
        stream = PROCESSORS[n](stream)
    return schema.encode(stream)


def deduplicate(stream: DataFrame, time: str = "ingested_at", within: str = "1 day") -> DataFrame:
    """First arrival of each text within the watermark; state older than that is dropped."""
    return stream.withColumn("_key", F.sha2(text_key(col("question")), 256)).withWatermark(time, within).dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def counts(stream: DataFrame, time: str = "ingested_at", window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Records by hour of arrival and dataset; late ones count until the watermark has passed."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), col("dataset_name").alias("dataset_name")).agg(F.count("*").alias("records")).select(F.col("w.start").alias("start"), "dataset_name", "records")


def write(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    return stream.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
