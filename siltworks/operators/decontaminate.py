"""Benchmark decontamination: nearest neighbours, judging, evidence and statistics."""

from __future__ import annotations

import json
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltworks import runtime
from siltworks.functions import text
from siltworks.operators.clean import col, event, processor, with_event
from siltworks.operators.inference import Client, ask, embed, fill, judge_template, parsing

#: Queries go to the executors in blocks of so many: 5,000 vectors of 1,024 floats are 20 MB.
QUERIES = 5_000


def _rows_of(column: pa.ListArray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(which rows hold a whole vector of the size, those vectors) of a list column, without a Python object a number."""
    n = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    keep = np.flatnonzero(n == size)
    if not size or not len(keep):
        return keep[:0], np.zeros((0, size))
    flat = column.take(pa.array(keep)).flatten()
    matrix = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    if flat.null_count:
        whole = ~pc.is_null(flat).to_numpy(zero_copy_only=False).reshape(-1, size).any(axis=1)
        keep, matrix = keep[whole], matrix[whole]
    return keep, matrix


def _nearest(names: list, matrix: np.ndarray, k: int, kind):
    def run(batches):
        best: list[tuple[np.ndarray, np.ndarray]] = []
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            keep, vectors = _rows_of(b.column(1), matrix.shape[1])
            if not len(keep):
                continue
            s, own = np.round(matrix @ vectors.T, 12), ids[keep]
            # ties by id, so that a partition's best don't depend on its order
            order = np.lexsort((np.broadcast_to(np.argsort(np.argsort(own)), s.shape), -s), axis=1)[:, :k]
            best.append((np.take_along_axis(s, order, 1), own[order]))
            if len(best) > 8:
                best = [_merge(best, k)]
        if best:
            s, own = _merge(best, k)
            n = s.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array([q for q in names for _ in range(n)], kind), pa.array(own.ravel().tolist(), kind), pa.array(s.ravel())], ["query_id", "id", "similarity"])

    return run


def _merge(best: list, k: int) -> tuple[np.ndarray, np.ndarray]:
    s, own = np.concatenate([a for a, _ in best], 1), np.concatenate([b for _, b in best], 1)
    rank = np.argsort(np.argsort(own, axis=1, kind="stable"), axis=1, kind="stable")
    order = np.lexsort((rank, -s), axis=1)[:, :k]
    return np.take_along_axis(s, order, 1), np.take_along_axis(own, order, 1)


def knn(queries: DataFrame, rows: DataFrame, k: int = 10) -> DataFrame:
    """``(query_id, id, similarity, rank)``: each query's k rows of largest inner product, ties by id.

    Both frames are ``(id, embedding)``. Queries are a stated set, sent in blocks; each partition
    of the rows keeps k a query, and only those are shuffled. Null vectors match nothing.
    """
    kind = dict(rows.dtypes)["id"]
    arrow = pa.int64() if kind in ("bigint", "int") else pa.string()
    stream = queries.where("embedding is not null").select("id", "embedding").toLocalIterator()
    out = None
    while (block := [(r["id"], r["embedding"]) for r in islice(stream, QUERIES)]) or out is None:
        matrix = np.array([v for _, v in block], dtype=np.float64) if block else np.zeros((0, 1))
        part = rows.select("id", "embedding").mapInArrow(_nearest([i for i, _ in block], matrix, k, arrow), f"query_id {kind}, id {kind}, similarity double")
        out = part if out is None else out.unionByName(part)
    w = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def load_benchmarks(df: DataFrame) -> DataFrame:
    """``(uid, dataset_name, question, ground_truth)`` with stripped, non-blank questions."""
    d = df.select(col("uid").alias("uid"), col("dataset_name").alias("dataset_name"), text.strip(col("question")).alias("question"), col("ground_truth").alias("ground_truth"))
    return d.where("question <> ''")


def parse_decision(reply: str | None) -> tuple[str, str]:
    """(decision, reason); whatever doesn't parse is 'no'."""
    try:
        got = json.loads((reply or "").strip())
        decision = str(got.get("decision", "")).strip().lower()
        return (decision, str(got.get("reason", ""))) if decision in ("yes", "no") else ("no", "api_error")
    except (ValueError, AttributeError):
        return "no", "api_error"


# The judge's default prompt and the form of its reply.
JUDGE_PROMPT = {"template": "Is the training question the benchmark question?\nBenchmark: {benchmark_question}\nTraining: {training_question}", "output_format": 'Reply {"decision": "yes" or "no", "reason": ...}.'}


def judge(pairs: DataFrame, client: Client, prompt: dict | None = None, cache_dir: str = "") -> DataFrame:
    """Adds ``llm_decision``, ``llm_reason``, ``llm_error`` to pairs with both questions; ``prompt`` is a prompt file's mapping."""
    parsed = parsing(parse_decision, "decision string, reason string")
    template, system = judge_template(prompt or JUDGE_PROMPT)
    values = {"benchmark_question": col("benchmark_question"), "training_question": col("question"), "benchmark_source": col("benchmark_source") if "benchmark_source" in pairs.columns else F.lit(""), "benchmark_id": col("query_id") if "query_id" in pairs.columns else F.lit("")}
    asked = F.concat(F.lit(f"{system}\n\n" if system else ""), fill(template, doubled=True, **values))
    got = ask(pairs, asked, client, cache_dir).withColumn("_d", parsed("reply"))
    return got.withColumns({"llm_decision": F.col("_d.decision"), "llm_reason": F.col("_d.reason"), "llm_error": F.coalesce("error", F.lit(""))}).drop("_d", "reply", "error")


def attach_evidence(records: DataFrame, judged: DataFrame, target_phases: tuple[str, ...] = ("", "midtrain"), threshold: float | None = None, top_k: int = 10) -> DataFrame:
    """Candidates as ``decontamination`` of their record, best first; a 'yes' drops the record.

    ``judged``: ``(record_id, benchmark_id, benchmark_source, similarity, llm_decision)``; with a
    threshold, only candidates at or over it can contaminate.
    """
    yes = F.col("llm_decision") == "yes"
    if threshold is not None:
        yes = yes & (F.col("similarity") >= threshold)
    entry = F.struct((-F.col("similarity")).alias("order"), "benchmark_id", "benchmark_source", "similarity", "llm_decision")
    e = judged.groupBy("record_id").agg(F.sort_array(F.collect_list(entry)).alias("c"), F.min(F.when(yes, entry)).alias("source"))
    out = records.join(e, "record_id", "left").withColumn("_target", col("training_phase").isin(*target_phases))
    hit = F.col("_target") & F.col("source").isNotNull()
    payload = F.to_json(F.struct(
        F.when(hit, "contaminated").otherwise("clean").alias("status"), F.lit(threshold).cast("double").alias("similarity_threshold"), F.lit(top_k).alias("top_k"),
        F.transform(F.coalesce("c", F.array().cast("array<struct<order:double,benchmark_id:string,benchmark_source:string,similarity:double,llm_decision:string>>")), lambda x: F.struct(x["benchmark_id"].alias("benchmark_id"), x["benchmark_source"].alias("benchmark_source"), x["similarity"].alias("similarity"), x["llm_decision"].alias("llm_decision"))).alias("candidates"),
        F.when(hit, F.col("source.benchmark_id")).alias("contamination_source_id"), F.when(hit, F.col("source.benchmark_source")).alias("contamination_source_set"),
    ))
    out = with_event(out, event("decontaminate", "decontamination", F.when(hit, "dropped").otherwise("kept"), F.when(hit, "contaminated").otherwise("")), F.col("_target"))
    out = out.withColumns({"decontamination": F.when(F.col("_target"), payload).otherwise(F.col("decontamination")), "training_phase": F.when(hit, "drop").otherwise(col("training_phase")), "filter_tag": F.when(hit, "contaminated").otherwise(col("filter_tag"))})
    return out.drop("c", "source", "_target")


def drop_rates(judged: DataFrame) -> DataFrame:
    """Per benchmark: candidates judged, contaminated ones, their share to four places."""
    yes = F.count_if(F.col("llm_decision") == "yes")
    return judged.groupBy("benchmark_source").agg(F.count("*").alias("judged"), yes.alias("contaminated"), F.round(yes / F.count("*"), 4).alias("drop_rate"))


def preview(neighbours: DataFrame, ks: tuple[int, ...] = (5, 10, 20, 50)) -> DataFrame:
    """At each k: pairs, different rows, and the lowest and mean similarity."""
    k = F.explode(F.array(*(F.lit(x) for x in ks))).alias("k")
    return neighbours.select("*", k).where(F.col("rank") <= F.col("k")).groupBy("k").agg(F.count("*").alias("pairs"), F.countDistinct("id").alias("rows"), F.round(F.min("similarity"), 6).alias("lowest"), F.round(F.avg("similarity"), 6).alias("mean"))


def phase_counts(records: DataFrame, benchmarks: DataFrame, target_phases: tuple[str, ...] = ("posttrain", "midtrain")) -> DataFrame:
    """What a run would compare: target rows by phase and benchmark questions by set."""
    rows = records.where(col("training_phase").isin(*target_phases)).groupBy(col("training_phase").alias("name")).agg(F.count("*").alias("rows")).withColumn("side", F.lit("records"))
    sets = load_benchmarks(benchmarks).groupBy(F.col("dataset_name").alias("name")).agg(F.count("*").alias("rows")).withColumn("side", F.lit("benchmarks"))
    return rows.unionByName(sets).select("side", "name", "rows")


def embedded(df: DataFrame, record_id: str, embedder, path: str = "", model: str = "") -> DataFrame:
    """``(id, embedding)`` of unit length; empty texts have vectors too, if the embedder gives them.

    With a path, vectors are kept there under id, model and the hash of the text: a later run embeds
    only what isn't there. Without, they are written once for this run.
    """
    texts = df.select(col(record_id).alias("id"), col("question").alias("question"))
    unit = lambda t: embed(t, "question", embedder).withColumn("embedding", text.l2_normalize(F.col("embedding")).cast("array<float>"))
    if not path:
        return runtime.materialize(unit(texts).select("id", "embedding"), "embeddings")
    spark = df.sparkSession
    texts = runtime.materialize(texts.withColumns({"text_key": F.sha2("question", 256), "model": F.lit(model)}), "embed-texts")
    read = lambda: spark.read.schema("id string, text_key string, model string, embedding array<float>").parquet(path).dropDuplicates(["id", "text_key", "model"])
    keys = ["id", "text_key", "model"]
    todo = texts.dropDuplicates(keys)
    todo = todo.join(read().select(keys), keys, "left_anti") if runtime.exists(spark, path) else todo
    unit(todo).select(*keys, "embedding").write.mode("append").parquet(path)
    return texts.select(keys).join(read(), keys).select("id", "embedding")


def _judged(df: DataFrame, bench: DataFrame, vectors: DataFrame, queries: DataFrame, client: Client, top_k: int, threshold: float | None, target_phases: tuple[str, ...], judge_all: bool, prompt: dict | None, cache_dir: str) -> DataFrame:
    """``(record_id, benchmark_id, benchmark_source, similarity, llm_decision)`` of each benchmark's nearest target rows, written once."""
    near = knn(queries, vectors, top_k)
    asked = bench.select(F.col("uid").alias("query_id"), F.col("question").alias("benchmark_question"), F.col("dataset_name").alias("benchmark_source")).dropDuplicates(["query_id"])
    rows = df.where(col("training_phase").isin(*target_phases)).groupBy(col("record_id").alias("id")).agg(F.min(col("question")).alias("question"))
    pairs = runtime.materialize(near.join(asked, "query_id").join(rows, "id"), "candidates")
    due = F.lit(True) if judge_all or threshold is None else F.col("similarity") >= threshold
    columns = [F.col("id").alias("record_id"), F.col("query_id").alias("benchmark_id"), "benchmark_source", "similarity", "llm_decision"]
    judged = judge(pairs.where(due), client, prompt, cache_dir).select(*columns).unionByName(pairs.where(~due).withColumn("llm_decision", F.lit("no")).select(*columns))
    return runtime.materialize(judged, "judged")


def _text_evidence(df: DataFrame) -> DataFrame:
    return df if dict(df.dtypes)["decontamination"] == "string" else df.withColumn("decontamination", F.to_json("decontamination"))


@processor("decontamination")
def decontamination(df: DataFrame, benchmarks: DataFrame | None = None, embedder=None, client: Client | None = None, top_k: int = 10, similarity_threshold: float | None = None, target_phases: tuple[str, ...] = ("", "midtrain"), judge_all: bool = False, prompt: dict | None = None, cache_dir: str = "") -> DataFrame:
    """Each benchmark question's nearest target rows become their evidence; those the judge agrees on are dropped.

    Only candidates at or over the threshold are judged, the others stand as 'no'; ``judge_all`` judges
    every candidate and only records the threshold.
    """
    if benchmarks is None or embedder is None or client is None:
        return df
    df = _text_evidence(df)
    targets = df.where(col("training_phase").isin(*target_phases))
    bench = runtime.materialize(load_benchmarks(benchmarks), "benchmarks")
    judged = _judged(df, bench, embedded(targets, "record_id", embedder), embedded(bench, "uid", embedder), client, top_k, similarity_threshold, target_phases, judge_all, prompt, cache_dir)
    return attach_evidence(df, judged, tuple(target_phases), None if judge_all else similarity_threshold, top_k)


# ---- the same in three steps, each of which can be run again ----


def _need(checkpoint_dir: str) -> str:
    if not checkpoint_dir:
        raise ValueError("the step needs a checkpoint_dir")
    return checkpoint_dir.rstrip("/")


def saved_benchmarks(spark, checkpoint_dir: str) -> DataFrame:
    """The benchmark questions that ``decontam_load`` left in the folder."""
    path = f"{_need(checkpoint_dir)}/benchmarks"
    if not runtime.exists(spark, path):
        raise FileNotFoundError(f"no benchmarks at {path}: run decontam_load first")
    return spark.read.parquet(path)


@processor("decontam_load")
def decontam_load(df: DataFrame, benchmarks: DataFrame | None = None, checkpoint_dir: str = "", target_phases: tuple[str, ...] = ("posttrain", "midtrain")) -> DataFrame:
    """Writes the benchmark questions and what would be compared; the records pass."""
    if benchmarks is None:
        return df
    path = _need(checkpoint_dir)
    load_benchmarks(benchmarks).write.mode("overwrite").parquet(f"{path}/benchmarks")
    phase_counts(df, benchmarks, target_phases).coalesce(1).write.mode("overwrite").json(f"{path}/load_meta")
    return df


@processor("decontam_embed")
def decontam_embed(df: DataFrame, embedder=None, checkpoint_dir: str = "", model: str = "", target_phases: tuple[str, ...] = ("posttrain", "midtrain")) -> DataFrame:
    """Writes the vectors of both sides; what is there already isn't embedded again. The records pass."""
    if embedder is None:
        return df
    path = _need(checkpoint_dir)
    embedded(df.where(col("training_phase").isin(*target_phases)), "record_id", embedder, f"{path}/train_embeddings", model)
    embedded(saved_benchmarks(df.sparkSession, path), "uid", embedder, f"{path}/benchmark_embeddings", model)
    return df


@processor("decontam_search")
def decontam_search(df: DataFrame, client: Client | None = None, embedder=None, benchmarks: DataFrame | None = None, checkpoint_dir: str = "", model: str = "", top_k: int = 20, similarity_threshold: float | None = None, target_phases: tuple[str, ...] = ("posttrain", "midtrain"), prompt: dict | None = None, cache_dir: str = "") -> DataFrame:
    """Judges all nearest rows and only records the threshold. With a checkpoint_dir, benchmarks and vectors
    come from there and drop rates are left there; without, they are made from ``benchmarks`` and ``embedder``."""
    if client is None:
        return df
    if not checkpoint_dir:
        return decontamination(df, benchmarks, embedder, client, top_k, similarity_threshold, target_phases, True, prompt, cache_dir)
    path, spark = _need(checkpoint_dir), df.sparkSession
    df, bench = _text_evidence(df), saved_benchmarks(df.sparkSession, path)
    keyed = lambda side, of, id_column: of.select(col(id_column).alias("id"), F.sha2(col("question"), 256).alias("text_key"), F.lit(model).alias("model")).join(spark.read.parquet(f"{path}/{side}_embeddings").dropDuplicates(["id", "text_key", "model"]), ["id", "text_key", "model"]).select("id", "embedding")
    targets = df.where(col("training_phase").isin(*target_phases))
    judged = _judged(df, bench, keyed("train", targets, "record_id"), keyed("benchmark", bench, "uid"), client, top_k, similarity_threshold, target_phases, True, prompt, cache_dir or f"{path}/replies")
    drop_rates(judged).coalesce(1).write.mode("overwrite").json(f"{path}/benchmark_drop_stats")
    return attach_evidence(df, judged, tuple(target_phases), None, top_k)
