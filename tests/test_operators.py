from __future__ import annotations

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltworks import schema
from siltworks.operators import clean, decontaminate, dedup, evaluate, inference, relational
from siltworks.plans import catalog, runner
from siltworks.sources import readers


def records(spark, rows, columns="record_id string, question string, raw_dataset_answer string, training_phase string, dataset_name string"):
    return schema.canonical(spark.createDataFrame(rows, columns))


# What each operator does with a text: (operator, question, answer, phase, tag)
CASES = [
    ("prompt_contamination_filter", "Solve 1+1. Final Answer: 2", "2", "midtrain", "answer_leakage"),
    ("missing_context_filter", "Find g(10).", "", "drop", "missing_context"),
    ("meta_task_filter", "Retrieve and repeat the exact described function from the code context.", "", "midtrain", "meta_task"),
    ("math_filter", "For my YouTube video, give me 50 tags and 50 movie titles.", "", "drop", "non_math_signal"),
    ("mcq_converter", "Which value is correct? (A) 1 (B) 2 (C) 3", "B", "midtrain", "boolean_and_mcq"),
    ("language_filter", "求这个函数的最大值", "", "midtrain", "chinese"),
    ("language_filter", "Найдите значение", "", "drop", "other_non_english"),
    ("length_filter", "Find x", "", "drop", "short_question"),
    ("boolean_answer_filter", "Is it so that x is five?", " YES ", "midtrain", "boolean_and_mcq"),
    ("empty_answer_tagger", "How many are there?", " \t", "midtrain", "empty_ground_truth"),
    ("answer_quality_filter", "Prove it.", "This is the proof. It is done.", "midtrain", "non_verifiable_answer"),
    ("phantom_reference_filter", "In the picture, what is x?", "", "drop", "phantom_reference"),
    ("broken_question_filter", "$x^2$", "", "drop", "bare_expression"),
]


@pytest.mark.parametrize(("name", "question", "answer", "phase", "tag"), CASES)
def test_routing(spark, name, question, answer, phase, tag):
    r = schema.encode(clean.PROCESSORS[name](records(spark, [("r", question, answer, "", "d")]))).first()
    assert (r.training_phase, r.filter_tag) == (phase, tag)
    assert json.loads(r.trace)[-1]["reason_code"]


@pytest.mark.parametrize("name", sorted({c[0] for c in CASES}))
def test_routing_skips_tagged_rows_but_for_length(spark, name):
    q, a = next((c[1], c[2]) for c in CASES if c[0] == name)
    r = clean.PROCESSORS[name](records(spark, [("r", q, a, "midtrain", "d")])).first()
    assert r.filter_tag == ("short_question" if name == "length_filter" else "")


@pytest.mark.parametrize("name", sorted(set(clean.PROCESSORS) - {"exact_dedup", "fuzzy_dedup", "dedup_judge", "decontamination", "decontam_search"}))
def test_nulls_blanks_long_texts_and_no_rows(spark, name):
    rows = [(None, None, None, None, None), ("a", "", "", "", ""), ("b", "long " * 20_000, "1", "", "d"), ("b", "long " * 20_000, "1", "", "d")]
    df = clean.PROCESSORS[name](records(spark, rows))
    assert df.count() == 4
    assert clean.PROCESSORS[name](records(spark, rows).limit(0)).count() == 0


def test_math_filter_has_the_whole_vocabularies(spark):
    code = ["Run the docker container on port 8.", "What does kubernetes start first?", "Read this json of 5 numbers.", "Look at def f(x) for the value 3.", "Why does pip install stop here?"]
    general = ["Which career suits me?", "Plan a workout of 30 minutes.", "Which podcast has 12 parts?"]
    stem = ["Determine the friction on the block.", "Use spectroscopy to name the sample.", "What is the diffraction pattern?", "Which drug dosage is right?"]
    kept = ["Find the value of the integral of x.", "How many primes are below one hundred?"]
    df = records(spark, [(t, t, "", "", "d") for t in code + general + stem + kept])
    assert {r.record_id for r in clean.math_filter(df).where("filter_tag = 'non_math_signal'").collect()} == {*code, *general, *stem}


def test_unwrapping_and_conversion(spark):
    r = clean.instruction_wrapper_cleaner(records(spark, [("r", "User: Solve x+1=2\n</think>", "", "", "d")])).first()
    assert r.question == "Solve x+1=2"
    r = clean.mcq_converter(records(spark, [("r", "What is 1+1?\nA. 1\nB. 2\nC. 3\nD. 4", "B", "", "d")])).first()
    assert (r.question, r.raw_dataset_answer, r.confirmed_answer, r.training_phase) == ("What is 1+1?", "2", "2", "")


def test_cot_cleaning_tags():
    assert clean.clean_entry("m", {"reasoning": "thinking"})["quality_tags"] == ["truncated"]
    assert clean.clean_entry("gpt-oss-1", {"solution": "x", "reasoning": "thinking"})["quality_status"] == "valid"
    assert "non_english" in clean.clean_entry("m", {"reasoning": "求</think>"})["quality_tags"]


def test_canonical_reads_older_names_and_nulls(spark):
    r = schema.canonical(spark.createDataFrame([("a", "q", "5", None)], "record_id string, question string, ground_truth string, trace string")).first()
    assert (r.raw_dataset_answer, r.trace, r.meta, r.filter_tag) == ("5", "[]", "{}", "")


# ---- deduplication ----


def test_exact_dedup_by_priority(spark):
    df = records(spark, [("zzz", "Solve x+1=2", "", "", "good"), ("aaa", " solve X+1=2 ", "", "", "bad"), ("zzz", "Solve x+1=2", "", "", "good"), (None, None, None, None, None)])
    assert {r.record_id for r in dedup.exact_survivors(df).collect()} == {"aaa", ""}
    tiers = {1: ["good"], 3: ["bad", ""]}
    assert {r.record_id for r in dedup.exact_survivors(df, tiers).collect()} == {"zzz", ""}
    assert [(r.left_id, r.right_id) for r in dedup.exact_pairs(df, tiers).collect()] == [("zzz", "aaa")]


def test_tiers(spark):
    tiers = {2: ["OpenThoughts"], 1: ["Other"]}
    assert dedup.tier_of("OpenThoughts-114k", tiers) == 2 and dedup.tier_of("nothing", tiers) is None
    with pytest.raises(ValueError, match="nothing"):
        dedup.with_tier(records(spark, [("a", "q", "", "", "nothing")]), tiers)


def test_jaccard_join_against_brute_force(spark):
    r = random.Random(3)
    base = ["".join(r.choice("abc ") for _ in range(60)) for _ in range(12)]
    texts = [b[:i] + "x" + b[i + 1 :] for b in base for i in (0, 30, 59)] + ["ab", "ab", "", None]
    df = spark.createDataFrame([(f"r{i:02d}", t) for i, t in enumerate(texts)], "record_id string, question string")
    reps = dedup.classes(df).where("id = rep").select("id", "text")
    sets = {r.id: {r.text[i : i + 3] for i in range(max(1, len(r.text) - 2))} for r in reps.collect() if r.text}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
    got = {(r.left_id, r.right_id) for r in dedup.jaccard_pairs(reps).collect()}
    assert got == want and want
    assert {(r.left_id, r.right_id) for r in dedup.lsh_pairs(reps).collect()} <= want


@pytest.mark.parametrize("n", [2, 3, 5])
def test_jaccard_pairs_of_any_length_in_any_number_of_passes(spark, monkeypatch, n):
    r = random.Random(5)
    texts = {"日", "𝒳y", "ab"}
    for size in (3, 20, 60, 190, 195, 400, 900):
        base = "".join(r.choice("abcdefghijkl ") for _ in range(size))
        for k in range(4):
            for i in r.sample(range(size), k * size // 80):
                base = base[:i] + r.choice("xyz日") + base[i + 1 :]
            texts.add(base.strip())
    texts = sorted(texts)
    reps = spark.createDataFrame([(f"r{i:02d}", t) for i, t in enumerate(texts)], "id string, text string")
    sets = [{t[i : i + n] for i in range(max(1, len(t) - n + 1))} for t in texts]
    near = {(f"r{i:02d}", f"r{j:02d}"): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i in range(len(texts)) for j in range(i + 1, len(texts))}
    for threshold, held, tile in ((0.8, dedup.HELD, dedup.TILE), (0.8, 60, 5), (0.5, 200, 2)):
        monkeypatch.setattr(dedup, "HELD", held)
        monkeypatch.setattr(dedup, "TILE", tile)
        want = sorted((*p, s) for p, s in near.items() if s >= threshold)
        assert sorted(tuple(x) for x in dedup.jaccard_pairs(reps, threshold, n).collect()) == want and want


def test_jaccard_pairs_move_only_similar_pairs(spark):
    # of ten letters: even a text's rarest substrings are in many others
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(7))
    texts = [" ".join(word() for _ in range(20)) + " qqq vvv zzz" for _ in range(400)]
    texts.append(texts[0][:50] + "k" + texts[0][51:])
    reps = spark.createDataFrame([(f"r{i:03d}", t) for i, t in enumerate(texts)], "id string, text string")
    seen = []
    verified = dedup.verified

    def counted(candidates, *rest):
        seen.append(candidates.count())
        return verified(candidates, *rest)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(dedup, "verified", counted)
        assert [(x.left_id, x.right_id) for x in dedup.jaccard_pairs(reps).collect()] == [("r000", "r400")]
    assert seen == [1]


def test_incoming_pairs_move_only_similar_pairs(spark, tmp_path, monkeypatch):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(7))
    texts = [" ".join(word() for _ in range(20)) for _ in range(300)]
    rows = [(f"u{i:03d}", t) for i, t in enumerate(texts)] + [("v1", texts[0][:50] + "k" + texts[0][51:]), ("v2", texts[1].upper() + "!"), (" ", texts[2]), (None, texts[3]), ("v3", None)]
    spark.createDataFrame([(*x, "d") for x in rows], "uid string, question string, dataset_name string").write.parquet(f"{tmp_path}/incoming_records.parquet")
    seen, verified = [], dedup.verified
    monkeypatch.setattr(dedup, "verified", lambda candidates, *rest: seen.append(candidates.count()) or verified(candidates, *rest))
    got = catalog.QUERIES["d02_jaccard_pairs"](spark, str(tmp_path)).collect()
    assert [(x.left_id, x.right_id) for x in got] == [("u000", "v1")] and seen == [1]


def test_representatives_are_the_classes_own(spark):
    df = spark.createDataFrame([("b", "X y"), ("a", "x  Y!"), ("c", ""), (None, "z"), ("a", "a"), ("d", None)], "record_id string, question string")
    want = sorted(tuple(x) for x in dedup.classes(df).where("id = rep").select("id", "text").collect())
    assert sorted(tuple(x) for x in dedup.representatives(df).collect()) == want and len(want) == 4


def test_components_of_chains_and_stars(spark):
    edges = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(40)] + [("s", f"s{i}") for i in range(30)] + [("x", "x"), ("s", "s1")]
    got = dict(tuple(r) for r in dedup.components(spark.createDataFrame(edges, "a string, b string")).collect())
    assert {got[f"c{i:03d}"] for i in range(41)} == {"c000"} and {got[f"s{i}"] for i in range(30)} == {"s"} and "x" not in got
    assert dedup.components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_components_that_do_not_settle_are_an_error(spark):
    edges = spark.createDataFrame([(f"c{i:03d}", f"c{i + 1:03d}") for i in range(40)], "a string, b string")
    with pytest.raises(RuntimeError):
        dedup.components(edges, rounds=2)


def test_fuzzy_dedup_keeps_passive_rows(spark):
    q = "Compute the derivative of x squared at the point three."
    df = records(spark, [("a", q, "", "", "d"), ("b", q + "!", "", "", "d"), ("c", q, "", "drop", "d"), ("d", "something else altogether", "", "", "d")])
    assert {r.record_id for r in dedup.fuzzy_dedup(df).collect()} == {"a", "c", "d"}


def test_near_duplicates_of_canonical_records(spark, tmp_path):
    r = random.Random(3)
    rows = []
    for i in range(12):
        q = " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(8))
        rows += [(f"{i:02d}a", q, "posttrain" if i % 3 else "drop"), (f"{i:02d}b", q[:-1] + "z", ""), (f"{i:02d}c", q[:20] + "zz" + q[22:], None), (f"{i:02d}d", q.upper() + "!", "midtrain")]
    spark.createDataFrame(rows, "record_id string, question string, training_phase string").write.parquet(f"{tmp_path}/canonical_records.parquet")
    norm = lambda t: t.lower().strip("!")
    sets = {i: {norm(t)[k : k + 3] for k in range(len(t) - 2)} for i, t, _ in rows}
    sets = {i: {g for g in x if len(g) == 3} for i, x in sets.items()}
    near = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
    rep = {t: min(i for i, u, _ in rows if norm(u) == t) for t in {norm(u) for _, u, _ in rows}}
    want = {p for p in near if set(p) <= set(rep.values())}
    got = {name: catalog.QUERIES[name](spark, str(tmp_path)).collect() for name in ("d02_canonical_jaccard_pairs", "d02_canonical_lsh_pairs", "d04_canonical_fuzzy_dedup")}
    assert {(x.left_id, x.right_id) for x in got["d02_canonical_jaccard_pairs"]} == want and want
    assert {(x.left_id, x.right_id) for x in got["d02_canonical_lsh_pairs"]} <= want
    passive = {i for i, _, p in rows if p == "drop"}
    links = {i: {i} for i in sets if i not in passive}
    for a, b in near:
        if not {a, b} & passive:
            both = links[a] | links[b]
            for x in both:
                links[x] = both
    assert {x.record_id for x in got["d04_canonical_fuzzy_dedup"]} == passive | {min(x) for x in links.values()}


def test_bands_are_checked(spark):
    with pytest.raises(ValueError):
        dedup.band_keys(spark.createDataFrame([("a", "t")], "id string, text string"), 64, 65)


# ---- decontamination, evaluation, models ----


def test_knn_against_numpy(spark):
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(60, 8)).round(3)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)] + [(99, None)], "id long, embedding array<float>").repartition(5)
    got = decontaminate.knn(df.where("id < 5"), df, 7).collect()
    s = rows.astype(np.float32).astype(float) @ rows.astype(np.float32).astype(float).T
    for i in range(5):
        assert [r.id for r in sorted((r for r in got if r.query_id == i), key=lambda r: r.rank)] == list(np.argsort(-s[i], kind="stable")[:7])


def test_evidence(spark):
    judged = spark.createDataFrame([("a", "b1", "s", 0.9, "no"), ("a", "b2", "s", 0.8, "yes"), ("c", "b1", "s", 0.7, "no")], "record_id string, benchmark_id string, benchmark_source string, similarity double, llm_decision string")
    out = {r.record_id: r for r in decontaminate.attach_evidence(records(spark, [("a", "q", "", "", "d"), ("c", "q", "", "", "d"), ("e", "q", "", "drop", "d")]), judged).collect()}
    a = json.loads(out["a"].decontamination)
    assert a["status"] == "contaminated" and a["contamination_source_id"] == "b2" and [c["benchmark_id"] for c in a["candidates"]] == ["b1", "b2"]
    assert out["a"].training_phase == "drop" and out["c"].training_phase == "" and out["e"].decontamination == "{}"


def test_decontamination_end_to_end(spark):
    embedder = lambda ts: [[float(t.count(c)) for c in "abcxyz"] for t in ts]
    bench = spark.createDataFrame([("b1", "aabbcc", "", "set"), ("b2", " ", "", "set")], "uid string, question string, ground_truth string, dataset_name string")
    df = records(spark, [("r1", "abcabc", "", "", "d"), ("r2", "xyz", "", "", "d"), ("r3", "abc", "", "drop", "d")])
    yes = lambda p: '{"decision": "yes", "reason": "same"}'
    out = {r.record_id: r for r in decontaminate.decontamination(df, bench, embedder, yes, 2, 0.9).collect()}
    assert out["r1"].filter_tag == "contaminated" and out["r2"].filter_tag == "" and out["r3"].decontamination == "{}"
    assert json.loads(out["r2"].decontamination)["candidates"][0]["llm_decision"] == "no"
    assert decontaminate.decontamination(df).count() == 3


def test_decisions_that_do_not_parse_are_no():
    assert decontaminate.parse_decision("maybe") == ("no", "api_error") and decontaminate.parse_decision('{"decision": "YES", "reason": "r"}') == ("yes", "r")


def test_majority_ties_go_to_the_first(spark):
    df = spark.createDataFrame([(["b", "a", "a", "b", ""],), (["", None],), ([],)], "x array<string>")
    assert [tuple(r.m) for r in df.select(evaluate.majority(F.col("x")).alias("m")).collect()] == [("b", 2), ("", 0), ("", 0)]


def _verified(spark, answers, truth="4"):
    v = json.dumps({"samples": [{"index": i, "answer": a} for i, a in enumerate(answers)]})
    df = spark.createDataFrame([("r", "q", truth, v)], "record_id string, question string, raw_dataset_answer string, verification string")
    return evaluate.build_verification(schema.canonical(df)).first()


def test_verification(spark):
    r = _verified(spark, ["5"] * 7 + ["4"])
    assert (r.verification.majority_answer, r.verification.majority_count, r.verification.majority_matches_gt, r.verification.pass_ratio) == ("5", 7, False, 0.125)
    assert r.trace[-1].reason_code == "gt_suspect"


def test_rollout_fills_missing_samples(spark):
    def client(prompt):
        if "attempt 0" in prompt:
            raise OSError("down")
        return "so \\boxed{4}"

    out = evaluate.rollout_correctness(records(spark, [("r", "q", "4", "", "d"), ("s", "q" * 7000, "4", "", "d")]), client, n=4)
    got = {r.record_id: r.verification for r in out.collect()}
    assert got["r"].num_samples == 3 and got["r"].majority_matches_gt
    assert got["s"] is None or got["s"].samples is None


@pytest.mark.parametrize(("reply", "phase", "tag"), [({"gt_quality": "clear", "judgement": "equivalent", "majority_answer": "0.5", "majority_count": 6}, "posttrain", "equivalent_rescued"), ({"gt_quality": "clear", "judgement": "not_equivalent"}, "midtrain", "answer_mismatch"), ({"gt_quality": "unclear", "judgement": "not_applicable", "majority_count": 5}, "midtrain", "gt_unclear"), ({"gt_quality": "unclear", "judgement": "not_applicable", "majority_count": 1}, "midtrain", "answer_uncertain"), ({"gt_quality": "odd"}, "posttrain", "")])
def test_answer_judge(spark, reply, phase, tag):
    v = json.dumps({"majority_matches_gt": False, "num_samples": 8, "samples": [{"index": 0, "answer": "1/2"}]})
    df = schema.canonical(spark.createDataFrame([("r", "q", "1/2", "posttrain", v)], "record_id string, question string, raw_dataset_answer string, training_phase string, verification string"))
    r = evaluate.answer_judge(df, lambda _: json.dumps(reply)).first()
    assert (r.training_phase, r.filter_tag) == (phase, tag)


def test_pass_ratio(spark):
    df = schema.canonical(spark.createDataFrame([("a", '{"pass_ratio": 0.5}'), ("b", '{"pass_ratio": 1.0}'), ("c", "{}"), ("d", '{"pass_ratio": 0.6, "all_correct": true}')], "record_id string, verification string"))
    assert {(r.record_id, r.training_phase) for r in evaluate.pass_ratio_filter(df, 0.2, 0.9).collect()} == {("a", "posttrain"), ("d", "midtrain")}
    assert {(r.record_id, r.filter_tag) for r in evaluate.pass_ratio_rejects(df, 0.2, 0.9).collect()} == {("b", "too_easy"), ("c", "too_hard")}


def test_cache_answers_first(spark):
    prompts = spark.createDataFrame([("x",), ("y",), ("x",)], "prompt string")
    cache = inference.infer(prompts.where("prompt = 'x'"), lambda p: "cached").select("key", "reply")
    assert {r.reply for r in inference.infer(prompts, lambda p: "new", cache).collect()} == {"cached", "new"}


def test_labels():
    labels = {"drop": ["short"], "keep": ["math"]}
    assert inference.parse_label('ok {"label": "drop", "tag": "math"}', labels) == ("keep", "math")
    assert inference.parse_label("nothing", labels) == (None, None)


# ---- tables, pipelines ----


def test_merge_prefers_existing_rows(spark):
    old = spark.createDataFrame([("a", 1)], "record_id string, x int")
    new = spark.createDataFrame([("a", 2), ("b", 4), ("b", 3)], "record_id string, x int")
    assert {tuple(r) for r in relational.merge(old, new).collect()} == {("a", 1), ("b", 3)}


def test_stratified_sample_is_exact_and_stable(spark):
    df = records(spark, [(f"r{i}", "q", "", "", "abc"[i % 3] if i < 90 else "z") for i in range(100)])
    a = {r.record_id for r in relational.stratified_sample(df, 20).collect()}
    assert len(a) == 20 and a == {r.record_id for r in relational.stratified_sample(df.repartition(7), 20).collect()}


def test_unknown_names_fail_before_anything_runs(spark):
    with pytest.raises(ValueError, match="text_cleaning"):
        runner.run(None, {"processors": [{"name": "nope"}]})
    with pytest.raises(ValueError):
        readers.load_source(spark, {"adapter": "nope", "input_path": ""})


def test_stages_and_disabled_steps():
    assert [s["name"] for s in runner.steps_of({"stages": [{"name": "stage2_dedup"}, {"name": "stage4_cot", "enabled": False}]})] == ["exact_dedup", "fuzzy_dedup"]


def test_pipeline_resumes_from_checkpoint(spark, tmp_path):
    df = records(spark, [("a", "Find x", "", "", "d"), ("b", "What is the value of the integral?", "2", "", "d")])
    config = {"processors": [{"name": "length_filter"}, {"name": "exact_dedup"}, {"name": "empty_answer_tagger"}]}
    first = {tuple(r) for r in runner.run(df, config, f"file://{tmp_path}").select("record_id", "filter_tag").collect()}
    again = {tuple(r) for r in runner.run(df.limit(0), config, f"file://{tmp_path}").select("record_id", "filter_tag").collect()}
    assert first == again == {("a", "short_question"), ("b", "")}


def test_adding_never_removes_existing_rows(spark):
    old = records(spark, [("z", "What is the value of the integral?", "", "", "old")])
    new = records(spark, [("a", "what is the value of the integral?", "", "", "new"), ("b", "How many primes are below ten thousand?", "", "", "new")])
    out = runner.add_dataset(old, new, {"processors": [{"name": "text_cleaning"}, {"name": "exact_dedup", "dataset_priority": {1: ["old"]}}]}, ["new"], tier=4)
    assert {r.record_id for r in out.collect()} == {"z", "b"}


def test_ingest_json(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps([[{"from": "human", "value": " "}, {"from": "human", "value": "1+1?"}, {"from": "assistant", "value": "..", "ground_truth": {"value": "2"}}]]))
    r = readers.load_source(spark, {"adapter": "openreasoning", "input_path": f"file://{tmp_path}/c.json", "dataset_name": "n"}).first()
    assert (r.question, r.raw_dataset_answer, r.confirmed_answer, r.dataset_name) == ("1+1?", "2", "", "n")


def test_command_line(spark, tmp_path, capsys):
    records(spark, [("a", "q", "", "", "d"), ("", "q", "", "", "d")]).write.parquet(f"file://{tmp_path}/in")
    assert runner.main(["validate", "--input", f"file://{tmp_path}/in"]) == 1
    assert runner.main(["stats", "--input", f"file://{tmp_path}/in"]) == 0


def test_stream_deduplicates(spark, tmp_path):
    from siltworks.streaming import streams

    rows = spark.sql("select 'a' record_id, 'Q ' question, timestamp'2024-01-01 00:00:00' ingested_at union all select 'b', 'q', timestamp'2024-01-01 00:00:01'")
    rows.write.parquet(f"file://{tmp_path}/in")
    stream = streams.deduplicate(streams.read(spark, f"file://{tmp_path}/in", rows.schema))
    streams.write(stream, f"file://{tmp_path}/out", f"file://{tmp_path}/state").awaitTermination()
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == 1


def test_nothing_outside_imports_the_training_subpackage():
    from pathlib import Path

    root = Path(clean.__file__).resolve().parents[1]
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts[0]:
            assert "siltworks.llm" not in p.read_text(), p
