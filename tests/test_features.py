from __future__ import annotations

import json
import os
import random
import subprocess
import threading
from types import SimpleNamespace

import pytest
from pyspark import SparkContext
from pyspark.sql import functions as F

from siltworks import runtime, schema
from siltworks.functions import text
from siltworks.operators import clean, decontaminate, dedup, evaluate, inference, relational
from siltworks.sources import readers, writers


def records(spark, rows, columns="record_id string, question string, raw_dataset_answer string, training_phase string, dataset_name string"):
    return schema.canonical(spark.createDataFrame(rows, columns))


def _client_that_is_down():
    def run(prompt):
        raise OSError("down")

    return run


down = _client_that_is_down()


# ---- the shared folder ----


def test_a_cluster_without_a_shared_folder_is_an_error():
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="checkpoint"):
        runtime.shared_dir(session)


def test_tables_are_deleted_only_below_the_shared_folder(spark, tmp_path):
    mine = runtime.materialize(spark.range(3), "mine")
    folder = mine.inputFiles()[0].rsplit("/", 1)[0]
    spark.range(3).write.parquet(f"file://{tmp_path}/theirs")
    runtime.discard(mine, spark.read.parquet(f"file://{tmp_path}/theirs"))
    assert not runtime.exists(spark, folder) and runtime.exists(spark, f"file://{tmp_path}/theirs")


def test_files_and_settings(spark, tmp_path):
    runtime.write_text(spark, f"file://{tmp_path}/a.json", "first")
    runtime.write_text(spark, f"file://{tmp_path}/a.json", "second ü")
    assert (tmp_path / "a.json").read_text() == "second ü"
    with runtime.setting(spark, "spark.sql.ansi.enabled", "false"):
        assert spark.conf.get("spark.sql.ansi.enabled") == "false"
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert runtime.resources()["rss"] > 0


def test_processes_of_any_thread_and_a_jvm_above_are_measured(monkeypatch):
    ready, end, started = threading.Event(), threading.Event(), []

    def run():
        started.append(subprocess.Popen(["sleep", "60"]))
        ready.set()
        end.wait()

    thread = threading.Thread(target=run)
    thread.start()
    assert ready.wait(30)
    above = SimpleNamespace(pid=os.getppid)
    monkeypatch.setattr(SparkContext, "_gateway", SimpleNamespace(jvm=SimpleNamespace(java=SimpleNamespace(lang=SimpleNamespace(ProcessHandle=SimpleNamespace(current=lambda: above))))))
    try:
        m = runtime.resources()
        assert m["children"] >= 2 and m["child_rss"] > 0
        assert {started[0].pid, os.getppid()} <= runtime.processes() and os.getpid() not in runtime.processes()
    finally:
        started[0].kill()
        started[0].wait()
        end.set()
        thread.join()


# ---- model calls ----


def test_replies_are_kept_and_not_asked_for_again(spark, tmp_path):
    path = f"file://{tmp_path}/replies"
    prompts = spark.createDataFrame([("x",), ("yy",), ("x",), ("bad",)], "prompt string")
    client = lambda p: down(p) if p == "bad" else str(len(p))
    first = {(r.reply, r.error) for r in inference.infer(prompts, client, path, waves=2).collect()}
    assert first == {("1", None), ("2", None), (None, "OSError: down")}
    again = {(r.reply, r.error) for r in inference.infer(prompts, down, path).collect()}
    assert again == first  # only what failed is asked again
    assert inference.infer(prompts.limit(0), down, path).count() == 0
    assert {r.reply for r in inference.ask(prompts, F.col("prompt"), down, path).where("prompt <> 'bad'").collect()} == {"1", "2"}


def test_a_lost_run_keeps_its_waves(spark, tmp_path):
    path = f"file://{tmp_path}/replies"
    prompts = spark.range(40).select(F.col("id").cast("string").alias("prompt"))
    half = prompts.where(F.pmod(F.xxhash64(F.sha2("prompt", 256)), F.lit(2)) == 0)
    inference.infer(half, lambda p: "kept", path)
    got = {r.reply for r in inference.infer(prompts, lambda p: "new", path, waves=2).collect()}
    assert got == {"kept", "new"} and inference.cached(spark, path).count() == 40


def test_clients():
    c = inference.build_client({"backend": " VLLM", "base_url": "http://host:1/", "model": "m", "api_key": "k", "max_retries": 2})
    assert (c.base_url, c.retries, c.headers["Authorization"]) == ("http://host:1", 2, "Bearer k")
    c.system = "s"
    assert [m["role"] for m in c.body("p")["messages"]] == ["system", "user"] and c.body("p")["model"] == "m"
    with pytest.raises(ValueError, match="sglang"):
        inference.build_client({"backend": "other"})


def test_prompts(spark, tmp_path):
    assert inference.question_template({"template": " {problem}\nBox \\boxed{}. ", "system_prompt": " s "}) == ("{problem}\nBox \\boxed{}.", "s")
    made, _ = inference.question_template({"instruction": "Solve.", "examples": [{"question": "1+1", "answer": "2"}]})
    assert made == "Solve.\n\n## Examples\n\nProblem:\n1+1\nFinal Answer: 2\n\nProblem:\n{problem}"
    template, _ = inference.judge_template({"template": "Is {a} in {b}?", "output_format": '{"decision": "yes"}'})
    df = spark.createDataFrame([("x{b}", None)], "a string, b string")
    assert df.select(inference.fill(template, doubled=True, a=F.col("a"), b=F.col("b"))).first()[0] == 'Is x{b} in ?\n\n{"decision": "yes"}'
    assert df.select(inference.fill("{a} \\boxed{}", a=F.col("a"))).first()[0] == "x{b} \\boxed{}"
    (tmp_path / "p.yaml").write_text("template: hello\n")
    assert inference.load_prompt(str(tmp_path / "p.yaml")) == {"template": "hello"}
    (tmp_path / "q.yaml").write_text("- a\n")
    with pytest.raises(ValueError):
        inference.load_prompt(str(tmp_path / "q.yaml"))


def test_rows_delivered_twice_get_one_sample_and_one_verdict(spark):
    df = records(spark, [("r", "q", "4", "", "d"), ("r", "q", "4", "", "d")])
    out = evaluate.rollout_correctness(df, lambda p: "\\boxed{4}", n=2, prompt={"template": "Do: {problem}", "system_prompt": "Be brief."}).collect()
    assert [r.verification.num_samples for r in out] == [2, 2]
    v = json.dumps({"num_samples": 1, "majority_count": 3, "samples": [{"index": 0, "answer": "1"}]})
    twice = schema.canonical(spark.createDataFrame([("r", v), ("r", v)], "record_id string, verification string"))
    assert [r.verification.pass_ratio for r in evaluate.sample_answer_judge(twice, lambda p: "YES").collect()] == [1.0, 1.0]


def test_cleanup_counts(spark):
    rows = [("a", json.dumps({"num_samples": 2, "samples": [{"index": 0}, {"index": 1}]})), ("b", json.dumps({"num_samples": 5})), ("c", None), ("d", "{"), ("e", "{}")]
    got = evaluate.cleanup_counts(schema.canonical(spark.createDataFrame(rows, "record_id string, verification string")), 2).first()
    assert tuple(got) == (5, 1, 1, 3)


# ---- decontamination in steps ----


def test_decontamination_steps_resume(spark, tmp_path):
    path = f"file://{tmp_path}/steps"
    bench = spark.createDataFrame([("b1", "aabbcc", "", "set"), ("b2", " ", "", "set"), ("b3", None, "", "set")], "uid string, question string, ground_truth string, dataset_name string")
    df = records(spark, [("r1", "abcabc", "", "posttrain", "d"), ("r2", "xyz", "", "midtrain", "d"), ("r3", "abc", "", "drop", "d")])
    vectors = lambda ts: [[float(t.count(c)) for c in "abcxyz"] for t in ts]
    with pytest.raises(FileNotFoundError):
        decontaminate.decontam_embed(df, vectors, path)
    with pytest.raises(ValueError, match="checkpoint_dir"):
        decontaminate.decontam_load(df, bench)
    assert decontaminate.decontam_load(df, bench, path).count() == 3
    decontaminate.decontam_embed(df, vectors, path, "m")
    decontaminate.decontam_embed(df, down, path, "m")  # nothing to embed
    more = df.unionByName(records(spark, [("r4", "cba", "", "posttrain", "d")]))

    def only_new(ts):
        assert ts == ["cba"]
        return vectors(ts)

    decontaminate.decontam_embed(more, only_new, path, "m")
    yes = lambda p: '{"decision": "yes", "reason": "same"}' if "abcabc" in p else '{"decision": "no"}'
    out = {r.record_id: r for r in decontaminate.decontam_search(more, yes, checkpoint_dir=path, model="m", top_k=2).collect()}
    assert out["r1"].filter_tag == "contaminated" and out["r4"].training_phase == "posttrain" and out["r3"].decontamination == "{}"
    assert {(r.benchmark_source, r.judged, r.contaminated, r.drop_rate) for r in spark.read.json(f"{path}/benchmark_drop_stats").collect()} == {("set", 2, 1, 0.5)}
    again = decontaminate.decontam_search(more, down, checkpoint_dir=path, model="m", top_k=2)  # replies are kept too
    assert again.where("filter_tag = 'contaminated'").count() == 1


# ---- equality of answers ----

EQUAL = [
    ("1/2", "0.5", True), ("\\frac{1}{2}", "0.50", True), ("$\\boxed{42}$", "42", True), ("1,234", "1234", True), ("x = 5", "5", True), ("50\\%", "0.5", True), ("(1/2, 3)", "(0.5,3.0)", True), ("{3, 1, 2}", "{1,2,3}", True), ("\\{1, 2\\}", "\\{2,1\\}", True), ("[1,2]", "(1,2)", False), ("(1,2)", "(2,1)", False),
    ("7", "8", False), ("1/0", "1/0", True), ("1/3", "0.333", False), ("ABC", "abc.", True), ("", "", True), ("2\\pi", "2 \\pi", True), (None, "", True), ("-0", "0", True), ("12,34", "1234", False),
]


def test_same_value(spark):
    df = spark.createDataFrame(EQUAL, "a string, b string, want boolean")
    bad = df.withColumn("got", text.same_value(F.col("a"), F.col("b"))).where("got <> want").collect()
    assert not bad


def test_rule_correctness_compares_values(spark):
    rows = [("a", "1/2", "0.5"), ("b", "1/2", "0.4"), ("c", "x", None), ("d", None, None)]
    df = schema.canonical(spark.createDataFrame(rows, "record_id string, raw_dataset_answer string, confirmed_answer string"))
    assert {r.record_id for r in clean.rule_correctness(df, enforce_keep=True).collect()} == {"a", "c", "d"}


# ---- near duplicates ----


def test_hot_bands_lose_no_link(spark):
    r = random.Random(3)
    base = " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(8))
    texts = sorted({base[:i] + c + base[i + 1 :] for i in range(0, 54, 2) for c in "qrs"}) + [base[:40] + "zzzz zzzz"] + ["".join(r.choice("stuvw ") for _ in range(50)) for _ in range(10)]
    reps = spark.createDataFrame([(f"r{i:03d}", t) for i, t in enumerate(texts)], "id string, text string")
    roots = lambda pairs: {tuple(x) for x in dedup.components(pairs.select(F.col("left_id").alias("a"), F.col("right_id").alias("b"))).collect()}
    links = dedup.lsh_links(reps, hot=5)
    assert roots(links) == roots(dedup.lsh_links(reps, hot=1)) == roots(dedup.jaccard_pairs(reps))
    assert {(x.left_id, x.right_id) for x in dedup.lsh_pairs(reps).collect()} == {(x.left_id, x.right_id) for x in dedup.jaccard_pairs(reps).collect()}
    assert dedup.lsh_links(reps, hot=1).count() < dedup.lsh_pairs(reps).count()
    assert dedup.lsh_links(reps.limit(0)).count() == 0


def test_large_keys_are_met_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BLOCK", 3)
    keys = spark.createDataFrame([(0, 7, f"i{k:02d}") for k in range(11)] + [(0, 8, "i00"), (1, 7, "j")], "band int, key long, id string")
    got = [(r.left_id, r.right_id) for r in dedup._met(keys).collect()]
    assert len(got) == len(set(got)) == 55 and all(a < b for a, b in got)


def test_order_and_positions(spark):
    df = records(spark, [("c", "What is the first one of them all?", "", "", "x"), ("a", "Which is the last one of the lot?", "", "", "y"), ("b", "what is the FIRST one of them all?", "", "", "y")])
    assert [r.record_id for r in dedup.exact_dedup(df, ordered=True).collect()] == ["a", "b"]
    assert [r.record_id for r in dedup.exact_dedup(df, {1: ["x"], 2: ["y"]}, ordered=True).collect()] == ["c", "a"]
    assert [r.record_id for r in dedup.fuzzy_dedup(df, ordered=True).collect()] == ["a", "b"]
    many = spark.range(1_000).repartition(7).select((F.lit(999) - F.col("id")).alias("x"))
    assert all(r.x == r.position for r in relational.positions(many, "x").collect())
    assert relational.positions(many.limit(0), "x").count() == 0


def test_boundary_report(spark):
    kept = [("k1", "the sum of two odd numbers is even"), ("k2", "a triangle has three sides")]
    gone = [("g1", "The sum of two odd numbers is odd"), ("g2", "entirely different words"), ("g3", None)]
    df = spark.createDataFrame(kept + gone, "record_id string, question string")
    got = {r.record_id: (r.kept_id, r.similarity and round(r.similarity, 3)) for r in dedup.boundary_report(df, df.where("record_id like 'k%'")).collect()}
    assert got == {"g1": ("k1", 0.75), "g2": (None, None), "g3": (None, None)}


def test_approximate_latency(spark):
    r = relational.latency_summary(spark.range(1, 1_001).select(F.col("id").cast("double").alias("seconds")), exact=False).first()
    assert r.requests == 1_000 and abs(r.p50 - 500) < 2 and abs(r.p99 - 990) < 2


# ---- sources and sinks ----


def test_conversation_files(spark, tmp_path):
    talk = lambda q, a: [{"from": "human", "value": q}, {"from": "gpt", "value": "..", "ground_truth": {"value": a}}]
    (tmp_path / "a.json").write_text(json.dumps([talk("1+1?", "2")]))
    (tmp_path / "b.json").write_text(json.dumps([talk("2+2?", "4"), []]))
    (tmp_path / "c.jsonl").write_text(json.dumps(talk("3+3?", "6")) + "\n\nnot json\n")
    both = readers.load_source(spark, {"adapter": "openreasoning", "input_path": [f"file://{tmp_path}/a.json", f"file://{tmp_path}/b.json"], "dataset_name": "n"})
    assert {(r.question, r.raw_dataset_answer) for r in both.collect()} == {("1+1?", "2"), ("2+2?", "4")}
    lines = readers.load_source(spark, {"adapter": "openreasoning", "input_path": f"file://{tmp_path}/c.jsonl", "lines": True})
    assert [r.question for r in lines.collect()] == ["3+3?"]


def test_side_tables(spark, tmp_path):
    pairs = spark.createDataFrame([("a", "b", "x", "y")], "left_id string, right_id string, left_question string, right_question string")
    writers.write_judgements(inference.judged_pairs(pairs, lambda p: "Decision: YES"), f"file://{tmp_path}/judged")
    assert spark.read.parquet(f"file://{tmp_path}/judged").first().is_duplicate
    v = json.dumps({"majority_answer": "4", "majority_matches_gt": True, "samples": [{"index": 0, "answer": "4"}, {"index": 1}]})
    writers.write_rollouts(schema.canonical(spark.createDataFrame([("r", v), ("s", None)], "record_id string, verification string")), f"file://{tmp_path}/rollouts")
    (row,) = spark.read.parquet(f"file://{tmp_path}/rollouts").collect()
    assert (row.record_id, json.loads(row.parsed_answers), row.is_correct) == ("r", ["4", ""], True)


def test_vectors_that_are_no_vectors_match_nothing(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [1.0]), (4, [None, 1.0]), (5, [0.6, 0.8]), (6, []), (7, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, embedding array<float>").coalesce(1)
    got = [(r.id, round(r.similarity, 6)) for r in decontaminate.knn(df.where("id = 1"), df, 5).orderBy("rank").collect()]
    assert got == [(1, 1.0), (5, 0.6)]
    assert decontaminate.knn(df.limit(0), df).count() == 0 and decontaminate.knn(df.where("id = 1"), df.limit(0)).count() == 0


def test_a_vocabulary_that_was_sent_is_found(spark, tmp_path):
    from siltworks.functions import tokens

    tokens.share(spark)
    count = text.token_count(str(tmp_path / "not there"))
    df = spark.createDataFrame([("some words here",), (None,)], "t string")
    assert [r.n for r in df.select(count(F.col("t")).alias("n")).collect()] == [tokens.count("some words here"), 0]
