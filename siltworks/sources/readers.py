"""Sources: canonical corpora, ingest formats, benchmarks and configuration."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks import schema
from siltworks.functions import text
from siltworks.operators.clean import col


def read_canonical(spark: SparkSession, path: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """A file or a directory of shards as canonical records; only the columns asked for are read."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return schema.canonical(df) if columns is None else schema.canonical(df).select(*columns)


@dataclass
class SourceConfig:
    adapter: str
    input_path: str | list[str]
    dataset_name: str = ""
    options: dict = field(default_factory=dict)

    @classmethod
    def from_dict(cls, d: dict) -> SourceConfig:
        rest = {k: v for k, v in d.items() if k not in ("adapter", "input_path", "dataset_name")}
        return cls(str(d["adapter"]), d["input_path"], str(d.get("dataset_name", "")), rest)


Adapter = Callable[[SparkSession, SourceConfig], DataFrame]
ADAPTERS: dict[str, Adapter] = {}


def adapter(name: str) -> Callable[[Adapter], Adapter]:
    def add(f: Adapter) -> Adapter:
        ADAPTERS[name] = f
        return f

    return add


def load_source(spark: SparkSession, config: SourceConfig | dict) -> DataFrame:
    """Canonical records of a configured source."""
    config = config if isinstance(config, SourceConfig) else SourceConfig.from_dict(config)
    if config.adapter not in ADAPTERS:
        raise ValueError(f"unknown adapter {config.adapter!r}; known: {', '.join(sorted(ADAPTERS))}")
    return ADAPTERS[config.adapter](spark, config)


def ingest(df: DataFrame, dataset_name: str = "", file_name: bool = False) -> DataFrame:
    """Rows (question, uid, ground_truth, dataset_name) as canonical records.

    The id is the uid, or else the sha-256 of the question; the dataset is the column, the
    configured name, or else the file's stem. The confirmed answer starts blank.
    """
    blank = lambda c: F.nullif(F.trim(col(c)), F.lit("")) if c in df.columns else F.lit(None).cast("string")
    stem = F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.[^./]*)?$", 1) if file_name else F.lit("")
    out = df.select(F.coalesce(blank("uid"), F.sha2(col("question"), 256)).alias("record_id"), col("question").alias("question"), col("ground_truth").alias("raw_dataset_answer"), F.coalesce(blank("dataset_name"), F.nullif(F.lit(dataset_name), F.lit("")), stem).alias("dataset_name"))
    return schema.canonical(out)


@adapter("same_format")
def same_format(spark: SparkSession, config: SourceConfig) -> DataFrame:
    paths = [config.input_path] if isinstance(config.input_path, str) else config.input_path
    return ingest(spark.read.parquet(*paths), config.dataset_name, file_name=True)


def from_messages(df: DataFrame, dataset_name: str = "") -> DataFrame:
    """Rows (problem, expected_answer, messages, model) grouped by problem into one record each.

    The answer is the first non-blank one, the distillation has each model's first assistant message;
    of several rows of a model the last counts (by answer and message, as files have no order).
    """
    first = F.get(F.filter("messages", lambda m: m["role"] == "assistant"), F.lit(0))
    d = df.select(F.sha2(col("problem"), 256).alias("record_id"), col("problem").alias("question"), F.nullif(F.trim(col("expected_answer")), F.lit("")).alias("answer"), col("model").alias("model"), first["content"].alias("solution"), first["reasoning_content"].alias("reasoning"))
    models = d.groupBy("record_id", "model").agg(F.max(F.struct(F.coalesce("solution", F.lit("")).alias("solution"), F.coalesce("reasoning", F.lit("")).alias("reasoning"))).alias("m"))
    entry = F.struct("model", F.struct(F.col("model").alias("model"), F.col("m.solution").alias("solution"), F.col("m.reasoning").alias("reasoning")).alias("payload"))
    models = models.groupBy("record_id").agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(entry)))).alias("distillation"))
    heads = d.groupBy("record_id").agg(F.min("question").alias("question"), F.min("answer").alias("raw_dataset_answer"))
    return schema.canonical(heads.join(models, "record_id").withColumn("dataset_name", F.lit(dataset_name)))


@adapter("nemotron_math_v2")
def message_parquet(spark: SparkSession, config: SourceConfig) -> DataFrame:
    """Parquet of messages; the model is given by each path (option ``models``: path -> model) or the file's stem."""
    models = config.options.get("models") or {}
    parts = []
    for p in [config.input_path] if isinstance(config.input_path, str) else config.input_path:
        parts.append(spark.read.parquet(p).withColumn("model", F.lit(models.get(p, Path(p).stem))))
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p, allowMissingColumns=True)
    return from_messages(df, config.dataset_name)


_TURNS = "array<struct<from:string,value:string,ground_truth:struct<value:string>>>"


def from_conversations(df: DataFrame, dataset_name: str = "", turns: str = "turns") -> DataFrame:
    """Rows with an array of turns: the first non-blank human turn asks, the first assistant truth answers."""
    said = lambda role, get: F.get(F.filter(F.transform(F.filter(turns, lambda t: F.lower(t["from"]).isin(*role)), get), lambda v: text.strip(F.coalesce(v, F.lit(""))) != ""), F.lit(0))
    out = df.select(said(("human", "user"), lambda t: t["value"]).alias("question"), said(("assistant", "gpt"), lambda t: t["ground_truth"]["value"]).alias("ground_truth"))
    return ingest(out.where("question is not null"), dataset_name)


@adapter("openreasoning")
def conversation_json(spark: SparkSession, config: SourceConfig) -> DataFrame:
    """JSON files that hold a list of conversations, each a list of turns.

    Such a file is one value and is read in one task. Files with a conversation a line (option
    ``lines``) are split like any text.
    """
    paths = [config.input_path] if isinstance(config.input_path, str) else list(config.input_path)
    if config.options.get("lines"):
        return from_conversations(spark.read.text(paths).select(F.from_json("value", _TURNS).alias("turns")).where("turns is not null"), config.dataset_name)
    whole = spark.read.text(paths, wholetext=True)
    return from_conversations(whole.select(F.explode(F.from_json("value", f"array<{_TURNS}>")).alias("turns")), config.dataset_name)


def load_yaml(path: str) -> dict:
    import yaml

    got = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    if not isinstance(got, dict):
        raise ValueError(f"{path} has to hold a mapping")
    return got
