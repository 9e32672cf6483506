"""Pipelines declared as lists of operators, with checkpoints, incremental addition and a command line."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks import runtime, schema
from siltworks.operators import decontaminate, dedup, evaluate, inference, relational  # noqa: F401 - they register operators
from siltworks.operators.clean import PROCESSORS
from siltworks.sources import readers, writers

DEDUPS = ("exact_dedup", "fuzzy_dedup", "dedup_judge")
#: Record operators fused into one plan before it is cut: longer chains cost more planning than they save.
FUSE = 6

# The older stage names and the operators they stand for.
STAGES = {
    "stage0_text_filter": ["math_filter"],
    "stage1_non_cot": ["text_cleaning", "language_filter", "length_filter", "mcq_converter", "rule_correctness"],
    "stage1_classify": ["text_normalize", "instruction_wrapper_cleaner", "text_cleaning", "prompt_contamination_filter", "missing_context_filter", "length_filter", "language_filter", "math_filter", "phantom_reference_filter", "broken_question_filter", "mcq_converter", "meta_task_filter", "boolean_answer_filter", "answer_quality_filter"],
    "stage2_dedup": ["exact_dedup", "fuzzy_dedup"],
    "stage3_correctness": ["rollout_correctness", "difficulty_annotation"],
    "stage4_cot": ["cot_cleaning"],
    "stage5_pass_ratio": ["pass_ratio_filter"],
}
_CONTROL = ("name", "enabled", "step_name", "workers")


def steps_of(config: dict) -> list[dict]:
    """The enabled steps in order, older stages expanded."""
    if isinstance(config.get("processors"), list):
        steps = [dict(s) for s in config["processors"] if isinstance(s, dict)]
    else:
        steps = [{**s, "name": n} for s in config.get("stages") or [] if isinstance(s, dict) for n in STAGES.get(s.get("name", ""), [s.get("name", "")])]
    return [s for s in steps if s.get("enabled", True)]


def build(name: str):
    if name not in PROCESSORS:
        raise ValueError(f"unknown processor {name!r}; known: {', '.join(sorted(PROCESSORS))}")
    return PROCESSORS[name]


def apply(df: DataFrame, step: dict) -> DataFrame:
    return build(step["name"])(df, **{k: v for k, v in step.items() if k not in _CONTROL})


class Checkpoint:
    """Step outputs by exact key in one directory; a step counts as complete once its table is whole."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, key: str) -> str:
        return f"{self.path}/{key}"

    def done(self, key: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._at(key)}/_SUCCESS")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def load(self, key: str) -> DataFrame:
        return self.spark.read.parquet(self._at(key))

    def save(self, key: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(self._at(key))
        return self.load(key)


def run(df: DataFrame, config: dict, checkpoint_dir: str | None = None) -> DataFrame:
    """Apply the steps. Neighbouring record operators are fused into one plan of at most ``FUSE``.

    With a checkpoint directory every group's output is kept there by its position and names, and a
    later run continues after the last complete one. Without, groups are cut in the shared folder.
    """
    steps = steps_of(config)
    for s in steps:
        build(s["name"])  # unknown names fail before anything runs
    groups: list[list[dict]] = []
    for s in steps:
        if groups and len(groups[-1]) < FUSE and s["name"] not in DEDUPS and groups[-1][-1]["name"] not in DEDUPS:
            groups[-1].append(s)
        else:
            groups.append([s])
    keep = Checkpoint(df.sparkSession, checkpoint_dir) if checkpoint_dir else None
    keys = [f"{i:02d}-" + "+".join(str(s.get("step_name") or s["name"]) for s in g) for i, g in enumerate(groups)]
    start = 0
    if keep:
        done = [i for i, k in enumerate(keys) if keep.done(k)]
        if done:
            start = done[-1] + 1
            df = keep.load(keys[done[-1]])
    df = runtime.fit_partitions(df)  # rules are CPU-bound: a small corpus in one file would keep one core busy
    before = None
    for key, group in list(zip(keys, groups, strict=True))[start:]:
        for s in group:
            df = apply(df, s)
        df = schema.encode(df)
        df = keep.save(key, df) if keep else runtime.materialize(df, "pipeline")
        if before is not None and not keep:
            runtime.discard(before)
        before = df
    return df


def phases_of(steps: list[dict]) -> tuple[list[dict], list[dict], list[dict]]:
    """(before and between, deduplication, after the last deduplication)."""
    at = [i for i, s in enumerate(steps) if s["name"] in DEDUPS]
    if not at:
        raise ValueError("a pipeline without deduplication can't add data incrementally")
    return [s for s in steps[: at[-1]] if s["name"] not in DEDUPS], [steps[i] for i in at], steps[at[-1] + 1 :]


def add_dataset(existing: DataFrame, new: DataFrame, config: dict, names: list[str], tier: int | None = None, pre_tags: list[dict] | None = None, skip_merge: bool = False, checkpoint_dir: str | None = None) -> DataFrame:
    """Clean the new rows, deduplicate them against the existing ones, finish the survivors and merge.

    Existing rows are never removed. ``pre_tags``: ``{source: frame, field, match_value, training_phase, filter_tag}``.
    """
    first, dedups, last = phases_of(steps_of(config))
    sub = lambda name: f"{checkpoint_dir}/{name}" if checkpoint_dir else None
    for rule in pre_tags or []:
        new = relational.pre_tag(new, rule["source"], rule["field"], rule["match_value"], rule["training_phase"], rule.get("filter_tag", ""))
    new = run(new, {"processors": first}, sub("phase1")) if first else new
    if tier is not None:
        dedups = [{**s, "dataset_priority": dedup.augment_tiers(s["dataset_priority"], tier, names)} if s.get("dataset_priority") else s for s in dedups]
    survivors = run(existing.select(*schema.COLUMNS).unionByName(new.select(*schema.COLUMNS)), {"processors": dedups}, sub("phase2"))
    kept = new.join(survivors.select("record_id"), "record_id", "left_semi")
    kept = kept.where(F.col("dataset_name").isin(names)) if names else kept
    kept = run(kept, {"processors": last}, sub("phase3")) if last else kept
    return kept if skip_merge else relational.merge(existing.select(*schema.COLUMNS), kept.select(*schema.COLUMNS))


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser("siltworks")
    verbs = p.add_subparsers(dest="verb", required=True)
    for verb in ("ingest", "run", "add-dataset", "add"):
        verbs.add_parser(verb).add_argument("--config", required=True)
    one = verbs.add_parser("run-stage")
    one.add_argument("--processor", required=True)
    one.add_argument("--input", required=True)
    one.add_argument("--output", required=True)
    one.add_argument("--options", default="{}")
    m = verbs.add_parser("merge-records")
    for a in ("--existing", "--new", "--output"):
        m.add_argument(a, required=True)
    for verb in ("stats", "inspect", "validate"):
        v = verbs.add_parser(verb)
        v.add_argument("--input", required=True)
        v.add_argument("--limit", type=int, default=5)
    b = verbs.add_parser("backend-probe")
    b.add_argument("--url", required=True)
    b.add_argument("--model", required=True)
    a = p.parse_args(argv)
    if a.verb == "backend-probe":
        print(inference.HttpClient(a.url, a.model)("Say OK."))
        return 0
    spark = SparkSession.builder.appName("siltworks").getOrCreate()
    runtime.ship(spark)
    if a.verb == "ingest":
        c = readers.load_yaml(a.config)
        writers.write_shards(readers.load_source(spark, c), c["output_path"])
    elif a.verb == "run":
        c = readers.load_yaml(a.config)
        writers.write_canonical(run(readers.read_canonical(spark, c["input_path"]), c, c.get("checkpoint_dir")), c["output_path"])
    elif a.verb in ("add", "add-dataset"):
        c = readers.load_yaml(a.config)
        base = readers.load_yaml(str(Path(a.config).parent / c["pipeline_config"]))
        tags = [{**r, "source": spark.read.parquet(r["source_parquet"])} for r in c.get("pre_tag_rules") or []]
        out = add_dataset(readers.read_canonical(spark, c["existing_data_path"]), readers.read_canonical(spark, c["new_data_path"]), base, c.get("new_dataset_names") or [], c.get("new_dataset_priority_tier"), tags, bool(c.get("skip_merge")), c.get("checkpoint_dir"))
        writers.write_canonical(out, c["output_path"])
    elif a.verb == "run-stage":
        out = run(readers.read_canonical(spark, a.input), {"processors": [{"name": a.processor, **json.loads(a.options)}]})
        writers.write_canonical(out, a.output)
    elif a.verb == "merge-records":
        writers.write_canonical(relational.merge(readers.read_canonical(spark, a.existing), readers.read_canonical(spark, a.new)), a.output)
    elif a.verb == "stats":
        relational.stats(readers.read_canonical(spark, a.input)).show(1000, False)
    elif a.verb == "inspect":
        readers.read_canonical(spark, a.input).limit(a.limit).show(a.limit, 200, True)
    else:
        bad = relational.validate(readers.read_canonical(spark, a.input))
        bad.show(a.limit, False)
        return int(bool(bad.take(1)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
