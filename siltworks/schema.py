"""The canonical record: storage schema, nested payloads, and the way between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

JSON_COLUMNS = ["verification", "distillation", "decontamination", "meta", "trace"]
TEXT_COLUMNS = ["record_id", "question", "raw_dataset_answer", "confirmed_answer", "dataset_name", "training_phase", "filter_tag"]
COLUMNS = TEXT_COLUMNS + JSON_COLUMNS
RECORD = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS])

EVENT = "struct<stage:string,processor:string,status:string,reason_code:string,details:map<string,string>,created_at:string>"
SAMPLE = "struct<index:int,answer:string,solution:string,reasoning:string,success:boolean,stop_reason:string,token_count:map<string,int>,judge_correct:boolean>"
PAYLOADS = {
    "trace": f"array<{EVENT}>",
    "verification": "struct<model:string,fallback_model:string,used_fallback:boolean,num_samples:int,majority_answer:string,majority_count:int,raw_dataset_answer:string,majority_matches_gt:boolean,confirmed_answer:string,llm_judge_gt_quality:string,llm_judge_equivalence:string,llm_judge_model:string,llm_judge_majority_answer:string,llm_judge_majority_count:int,llm_judge_attempts:int,llm_judge_error:string,llm_judge_raw_response:string,all_correct:boolean,pass_ratio:double,difficulty_bucket:string,difficulty_annotation:struct<score:double,backend:string,model:string,raw_response:string>,samples:array<" + SAMPLE + ">>",
    "distillation": "map<string,struct<model:string,solution:string,reasoning:string,quality_status:string,quality_tags:array<string>>>",
    "decontamination": "struct<status:string,embedding_model:string,similarity_threshold:double,llm_judge_model:string,top_k:int,candidates:array<struct<benchmark_id:string,benchmark_source:string,similarity:double,llm_decision:string,llm_reason:string,llm_error:string,llm_raw_response:string>>,contamination_source_id:string,contamination_source_set:string>",
    "meta": "map<string,string>",
}
PAIR = "left_id string, right_id string, left_question string, right_question string, method string, similarity double, metadata string"


def canonical(df: DataFrame) -> DataFrame:
    """Any frame with canonical names as storage columns.

    Missing columns get their defaults, nulls become blank, JSON columns that are null, blank or
    ``null`` become ``{}`` (``[]`` for the trace). Older names are understood: ``ground_truth`` for
    the raw answer, ``final_answer`` for the confirmed one, ``cot_text`` for the distillation.
    """
    have = set(df.columns)

    def text(name: str, *older: str) -> Column:
        found = [F.col(c).cast("string") for c in (name, *older) if c in have]
        return F.coalesce(*found, F.lit(""))

    def payload(name: str) -> Column:
        default = F.lit("[]" if name == "trace" else "{}")
        if name not in have:
            return default
        t = F.trim(F.col(name).cast("string"))
        return F.when(t.isNull() | (t == "") | (t == "null"), default).otherwise(F.col(name).cast("string"))

    out = {c: text(c) for c in TEXT_COLUMNS}
    out["raw_dataset_answer"] = text("raw_dataset_answer", "ground_truth")
    if "final_answer" in have and "confirmed_answer" not in have:
        out["confirmed_answer"] = F.coalesce(F.nullif(F.col("final_answer").cast("string"), F.lit("")), out["raw_dataset_answer"])
    out |= {c: payload(c) for c in JSON_COLUMNS}
    if "cot_text" in have:
        old = F.to_json(F.create_map(F.lit("legacy"), F.struct(F.lit("legacy").alias("model"), F.lit("").alias("solution"), F.col("cot_text").cast("string").alias("reasoning"))))
        out["distillation"] = F.when((out["distillation"] == "{}") & F.col("cot_text").isNotNull(), old).otherwise(out["distillation"])
    return df.select(*(c.alias(n) for n, c in out.items()))


def decode(df: DataFrame, *columns: str) -> DataFrame:
    """JSON columns (all, or those named) as structs, maps and arrays. What doesn't parse becomes null."""
    return df.withColumns({c: F.from_json(c, PAYLOADS[c]) for c in columns or JSON_COLUMNS if c in df.columns})


def encode(df: DataFrame) -> DataFrame:
    """Nested columns back to JSON text; keys come out in the order of the schema."""
    kinds = dict(df.dtypes)
    nested = {c: F.coalesce(F.to_json(c), F.lit("[]" if c == "trace" else "{}")) for c in JSON_COLUMNS if kinds.get(c, "string") != "string"}
    return df.withColumns(nested) if nested else df


def sorted_json(c: Column) -> Column:
    """JSON text with sorted keys."""
    return F.to_json(F.try_parse_json(c))
