"""Answer verification: votes, ratios and the routing that follows from them.

Samples are arrays of structs inside ``verification``; all summaries are expressions over them, so
nothing is exploded unless a model has to be asked.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks import schema
from siltworks.functions import text
from siltworks.operators.clean import col, event, processor, with_event
from siltworks.operators.inference import Client, ask, fill, parsing, question_template

_ROLLOUT_KEYS = ["samples", "num_samples", "majority_answer", "majority_count", "majority_matches_gt", "pass_ratio", "model", "fallback_model", "used_fallback", "raw_dataset_answer"]


def majority(answers: Column) -> Column:
    """struct(answer, count) of an array: the most frequent non-blank value, ties to the first seen; ('', 0) if none."""
    some = F.filter(answers, lambda a: a.isNotNull() & (a != ""))
    counted = F.transform(F.array_distinct(some), lambda v: F.struct(F.size(F.filter(some, lambda a: a == v)).alias("n"), (-F.array_position(some, v)).alias("first"), v.alias("v")))
    best = F.array_max(counted)
    return F.struct(F.coalesce(best["v"], F.lit("")).alias("answer"), F.coalesce(best["n"], F.lit(0)).alias("count"))


def majority_by(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """``(key, majority_answer, majority_count)`` over rows: counted by value, ties to the least ``order``."""
    some = df.where(F.col(value).isNotNull() & (F.col(value) != ""))
    n = some.groupBy(key, value).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    best = n.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("n"), "first", value)).alias("b"))
    return best.select(key, F.col(f"b.{value}").alias("majority_answer"), (-F.col("b.n")).cast("long").alias("majority_count"))


def equivalent(a: Column, b: Column) -> Column:
    return text.normalize_answer(F.coalesce(a, F.lit(""))) == text.normalize_answer(F.coalesce(b, F.lit("")))


def _v(df: DataFrame) -> DataFrame:
    return schema.decode(df, "verification") if dict(df.dtypes)["verification"] == "string" else df


def build_verification(df: DataFrame, model: str = "") -> DataFrame:
    """Summary of ``verification.samples``: majority on raw answers, match and pass ratio on normal ones.

    The denominator is the number of samples received, so a failed request shrinks both.
    """
    df = _v(df).withColumn("_s", F.coalesce("verification.samples", F.array().cast(f"array<{schema.SAMPLE}>")))
    raw = col("raw_dataset_answer")
    df = df.withColumn("_m", majority(F.transform("_s", lambda s: F.coalesce(s["answer"], F.lit("")))))
    n = F.greatest(F.size("_s"), F.lit(1))
    right = F.size(F.filter("_s", lambda s: equivalent(s["answer"], raw)))
    judged = F.transform("_s", lambda s: s.withField("judge_correct", F.when(equivalent(s["answer"], raw), F.lit(True)).otherwise(s["judge_correct"])))
    v = F.coalesce(F.col("verification"), F.from_json(F.lit("{}"), schema.PAYLOADS["verification"]))
    for name, value in (("model", F.coalesce(v["model"], F.lit(model))), ("num_samples", n), ("raw_dataset_answer", raw), ("majority_answer", F.col("_m.answer")), ("majority_count", F.col("_m.count")), ("majority_matches_gt", equivalent(F.col("_m.answer"), raw)), ("pass_ratio", right / n), ("used_fallback", F.lit(False)), ("samples", judged)):
        v = v.withField(name, value)
    matches = equivalent(F.col("_m.answer"), raw)
    df = with_event(df.withColumn("verification", v), event("evaluate", "rollout_correctness", "kept", F.when(matches, "").otherwise("gt_suspect")))
    return df.drop("_s", "_m")


@processor("rollout_correctness")
def rollout_correctness(df: DataFrame, client: Client | None = None, n: int = 8, target_phase: str = "", max_question_chars: int = 6000, answer_pattern: str | None = None, model: str = "", prompt: dict | None = None, cache_dir: str = "", waves: int = 1) -> DataFrame:
    """Asks for the samples that rows of the phase lack (blank: all rows), then summarises.

    Over-long questions and rows with enough samples are left; failed requests add no sample.
    ``prompt`` is a prompt file's mapping; with ``cache_dir`` replies are kept there, wave by wave.
    """
    if client is None:
        return df
    df = _v(df).withColumn("_have", F.coalesce(F.size("verification.samples"), F.lit(0)))
    due = (F.lit(target_phase == "") | (col("training_phase") == target_phase)) & (F.col("_have") < n) & (F.length(col("question")) <= max_question_chars)
    df = df.withColumn("_due", due)
    one = df.where("_due").select("record_id", "question", F.explode(F.sequence(F.col("_have"), F.lit(n - 1))).alias("index"))
    template, system = question_template(prompt or {"template": "{problem}\n\nPut the final answer within \\boxed{}."})
    # the attempt makes requests for the same question different ones
    text_of = F.concat(F.lit(f"{system}\n\n" if system else ""), fill(template, problem=col("question")), F.lit(" (attempt "), F.col("index").cast("string"), F.lit(")"))
    got = ask(one, text_of, client, cache_dir, waves=waves)
    answer = F.coalesce(F.nullif(text.extract_boxed(F.col("reply")), F.lit("")), text.parse_answer(F.col("reply"), *((answer_pattern,) if answer_pattern else ())))
    sample = F.struct(F.col("index").cast("int").alias("index"), answer.alias("answer"), F.col("reply").alias("solution"), F.col("reply").alias("reasoning"), F.lit(True).alias("success"), F.lit("natural").alias("stop_reason"), F.lit(None).cast("map<string,int>").alias("token_count"), F.lit(None).cast("boolean").alias("judge_correct"))
    # a row delivered twice asks twice: one sample an index
    new = got.where("reply is not null").groupBy("record_id", "index").agg(F.min(sample.cast(schema.SAMPLE).dropFields("token_count")).alias("s"))
    new = new.groupBy("record_id").agg(F.sort_array(F.collect_list("s")).alias("_new"))
    out = df.where("_due").join(new, "record_id", "left")
    more = F.transform(F.coalesce("_new", F.array()), lambda s: F.struct(s["index"].alias("index"), s["answer"].alias("answer"), s["solution"].alias("solution"), s["reasoning"].alias("reasoning"), s["success"].alias("success"), s["stop_reason"].alias("stop_reason"), F.lit(None).cast("map<string,int>").alias("token_count"), s["judge_correct"].alias("judge_correct")))
    v = F.coalesce(F.col("verification"), F.from_json(F.lit("{}"), schema.PAYLOADS["verification"]))
    all_samples = F.concat(F.coalesce("verification.samples", F.array().cast(f"array<{schema.SAMPLE}>")), more)
    out = out.withColumn("verification", F.when(F.col("_new").isNotNull(), v.withField("samples", all_samples)).otherwise(F.col("verification")))
    rest = df.where(~F.col("_due"))
    done = build_verification(out.where("_new is not null").select(*df.columns), model)
    failed = out.where("_new is null").select(*df.columns)
    failed = with_event(failed, event("evaluate", "rollout_correctness", "api_error", "api_error"))
    rest = with_event(rest, event("evaluate", "rollout_correctness", "skipped"))
    return done.unionByName(failed).unionByName(rest).drop("_have", "_due")


def parse_judgement(reply: str | None) -> tuple | None:
    """(gt_quality, judgement, majority_answer, majority_count), or None where the reply isn't valid."""
    try:
        got = json.loads((reply or "").strip())
        quality, verdict = str(got.get("gt_quality", "")).strip().lower(), str(got.get("judgement", "")).strip().lower()
        count = int(got.get("majority_count", 0))
    except (ValueError, TypeError, AttributeError):
        return None
    if quality not in ("clear", "unclear") or verdict not in ("equivalent", "not_equivalent", "not_applicable") or (quality == "unclear" and verdict != "not_applicable"):
        return None
    return quality, verdict, str(got.get("majority_answer", "")).strip(), count


def answer_decision(quality: Column, verdict: Column, count: Column, samples: Column) -> Column:
    """struct(phase, tag) by the decision table; null where there is no judgement."""
    pair = lambda p, t: F.struct(F.lit(p).alias("phase"), F.lit(t).alias("tag"))
    return F.when((quality == "clear") & (verdict == "equivalent"), pair("posttrain", "equivalent_rescued")).when(quality == "clear", pair("midtrain", "answer_mismatch")).when((quality == "unclear") & (count > samples / 2), pair("midtrain", "gt_unclear")).when(quality == "unclear", pair("midtrain", "answer_uncertain"))


@processor("answer_judge")
def answer_judge(df: DataFrame, client: Client | None = None, target_phase: str = "posttrain", model: str = "", max_retries: int = 3, cache_dir: str = "") -> DataFrame:
    """Rows of the phase whose majority misses the ground truth and that weren't judged yet."""
    if client is None:
        return df
    df = _v(df)
    due = (col("training_phase") == target_phase) & F.coalesce(F.col("verification.majority_matches_gt") == F.lit(False), F.lit(False)) & F.col("verification.llm_judge_gt_quality").isNull()
    df = df.withColumn("_due", due).withColumn("_n", F.coalesce(F.size("verification.samples"), F.lit(0)))
    answers = F.array_join(F.transform(F.coalesce("verification.samples", F.array().cast(f"array<{schema.SAMPLE}>")), lambda s: F.coalesce(s["answer"], F.lit(""))), "\n")
    prompt = F.concat_ws("\n", F.lit('Judge the reference answer against the samples. Reply {"gt_quality":..., "judgement":..., "majority_answer":..., "majority_count":...}.'), col("question"), col("raw_dataset_answer"), answers)

    parsed = parsing(parse_judgement, "quality string, verdict string, answer string, count int")
    asked = ask(df.where("_due and _n > 0"), prompt, client, cache_dir, max_retries).withColumn("_j", parsed("reply"))
    asked = asked.withColumn("_d", answer_decision(F.col("_j.quality"), F.col("_j.verdict"), F.col("_j.count"), F.coalesce("verification.num_samples", F.lit(0))))
    ok = F.col("_j.quality").isNotNull()
    v = F.col("verification")
    new = v
    for name, value in (("llm_judge_gt_quality", F.col("_j.quality")), ("llm_judge_equivalence", F.col("_j.verdict")), ("llm_judge_majority_answer", F.col("_j.answer")), ("llm_judge_majority_count", F.col("_j.count")), ("llm_judge_model", F.lit(model)), ("llm_judge_raw_response", F.col("reply"))):
        new = new.withField(name, value)
    rescued = new.withField("majority_matches_gt", F.lit(True)).withField("majority_answer", F.col("_j.answer")).withField("majority_count", F.col("_j.count"))
    asked = with_event(asked, event("evaluate", "answer_judge", F.when(~ok, "error").when(F.col("_d.phase") == "posttrain", "kept").otherwise("routed"), F.coalesce("_d.tag", F.lit("api_error"))))
    asked = asked.withColumns({"verification": F.when(F.col("_d.tag") == "equivalent_rescued", rescued).when(ok, new).otherwise(v.withField("llm_judge_error", F.coalesce("error", F.lit("invalid reply")))), "training_phase": F.coalesce("_d.phase", col("training_phase")), "filter_tag": F.coalesce("_d.tag", col("filter_tag"))})
    none = df.where("_due and _n = 0")
    none = with_event(none, event("evaluate", "answer_judge", "routed", "answer_uncertain")).withColumns({"training_phase": F.lit("midtrain"), "filter_tag": F.lit("answer_uncertain")})
    rest = df.where(~F.col("_due"))
    if dict(rest.dtypes).get("trace") == "string":
        rest = schema.decode(rest, "trace")
    keep = [c for c in df.columns if not c.startswith("_")]
    return asked.select(*keep).unionByName(none.select(*keep)).unionByName(rest.select(*keep))


def sample_summary(df: DataFrame, min_majority_count: int = 2) -> DataFrame:
    """Pass ratio from judged samples; posttrain rows with a thin majority become midtrain/low_confidence."""
    df = _v(df)
    s = F.coalesce("verification.samples", F.array().cast(f"array<{schema.SAMPLE}>"))
    n = F.coalesce(F.nullif(F.col("verification.num_samples"), F.lit(0)), F.size(s))
    ratio = F.when(n > 0, F.size(F.filter(s, lambda x: F.coalesce(x["judge_correct"], F.lit(False)))) / n).otherwise(0.0)
    demote = (col("training_phase") == "posttrain") & (F.coalesce("verification.majority_count", F.lit(0)) < min_majority_count) & (F.size(s) > 0)
    df = df.withColumn("_demote", demote)
    df = with_event(df, event("evaluate", "sample_answer_judge", "kept", F.when(F.col("_demote"), "low_confidence").otherwise("")))
    v = F.when(F.size(s) > 0, F.col("verification").withField("pass_ratio", ratio)).otherwise(F.col("verification"))
    return df.withColumns({"verification": v, "training_phase": F.when(F.col("_demote"), "midtrain").otherwise(col("training_phase")), "filter_tag": F.when(F.col("_demote"), "low_confidence").otherwise(col("filter_tag"))}).drop("_demote")


def reference_answer(df: DataFrame) -> Column:
    """The first non-blank of confirmed, verified, majority and raw answer."""
    given = [col("confirmed_answer"), F.col("verification.confirmed_answer"), F.col("verification.majority_answer"), col("raw_dataset_answer")]
    return F.coalesce(*(F.nullif(text.strip(c), F.lit("")) for c in given), F.lit(""))


@processor("sample_answer_judge")
def sample_answer_judge(df: DataFrame, client: Client | None = None, min_majority_count: int = 2, cache_dir: str = "") -> DataFrame:
    """Samples without a verdict are judged against the reference answer, then summarised."""
    df = _v(df)
    if client is None:
        return sample_summary(df, min_majority_count)
    due = df.select("record_id", col("question").alias("question"), reference_answer(df).alias("reference"), F.posexplode("verification.samples").alias("pos", "s")).where("s.judge_correct is null")
    prompt = F.concat_ws("\n", F.lit("Is the answer right? Reply YES or NO."), F.col("question"), F.concat(F.lit("Reference: "), F.col("reference")), F.concat(F.lit("Answer: "), F.coalesce("s.answer", F.lit(""))))
    got = ask(due, prompt, client, cache_dir).where("reply is not null")
    # a row delivered twice is judged twice: one verdict a place
    got = got.groupBy("record_id", "pos").agg(F.max(F.contains(F.upper("reply"), F.lit("YES"))).alias("ok"))
    got = got.groupBy("record_id").agg(F.map_from_entries(F.collect_list(F.struct("pos", "ok"))).alias("_ok"))
    out = df.join(got, "record_id", "left")
    judged = F.transform("verification.samples", lambda s, i: s.withField("judge_correct", F.coalesce(s["judge_correct"], F.col("_ok")[i])))
    out = out.withColumn("verification", F.when(F.col("_ok").isNotNull(), F.col("verification").withField("samples", judged)).otherwise(F.col("verification"))).drop("_ok")
    return sample_summary(out, min_majority_count)


@processor("difficulty_annotation")
def difficulty_annotation(df: DataFrame, client: Client | None = None, backend: str = "", model: str = "", cache_dir: str = "") -> DataFrame:
    if client is None:
        return df
    got = ask(_v(df), F.concat(F.lit("Rate the difficulty from 1 to 10: "), col("question")), client, cache_dir)
    note = F.struct(text.difficulty_score(F.coalesce("reply", F.lit(""))).alias("score"), F.lit(backend).alias("backend"), F.lit(model).alias("model"), F.col("reply").alias("raw_response"))
    v = F.coalesce(F.col("verification"), F.from_json(F.lit("{}"), schema.PAYLOADS["verification"]))
    return with_event(got.withColumn("verification", v.withField("difficulty_annotation", note)).drop("reply", "error"), event("evaluate", "difficulty_annotation", "kept"))


@processor("pass_ratio_filter")
def pass_ratio_filter(df: DataFrame, min_ratio: float = 0.0, max_ratio: float = 1.0) -> DataFrame:
    """Removes rows outside the ratios (a missing ratio is 0); all-correct rows become midtrain, untagged ones posttrain."""
    df = _v(df)
    ratio = F.coalesce("verification.pass_ratio", F.lit(0.0))
    easy = F.coalesce("verification.all_correct", F.lit(False))
    kept = df.where((ratio >= min_ratio) & (ratio <= max_ratio))
    phase = F.when(easy, "midtrain").when(col("training_phase") == "", "posttrain").otherwise(col("training_phase"))
    return kept.withColumns({"training_phase": phase, "filter_tag": F.when(easy, "all_correct_easy").otherwise(col("filter_tag"))})


def pass_ratio_rejects(df: DataFrame, min_ratio: float = 0.0, max_ratio: float = 1.0) -> DataFrame:
    """What ``pass_ratio_filter`` removes, tagged too_hard or too_easy."""
    df = _v(df)
    ratio = F.coalesce("verification.pass_ratio", F.lit(0.0))
    out = df.where((ratio < min_ratio) | (ratio > max_ratio))
    return out.withColumns({"training_phase": F.lit("drop"), "filter_tag": F.when(ratio < min_ratio, "too_hard").otherwise("too_easy")})


def clear_incomplete(df: DataFrame, min_samples: int = 8) -> DataFrame:
    """Verifications with some but fewer than ``min_samples`` samples lose their rollout entries."""
    df = _v(df)
    size, n = F.coalesce(F.size("verification.samples"), F.lit(0)), F.coalesce("verification.num_samples", F.lit(0))
    cleared = F.col("verification")
    for k in _ROLLOUT_KEYS:
        f = next(x for x in df.schema["verification"].dataType.fields if x.name == k)
        cleared = cleared.withField(k, F.lit(None).cast(f.dataType))
    partial = F.greatest(size, F.lit(0)).between(1, min_samples - 1) | ((n > 0) & ((size < min_samples) | (n < min_samples)))
    return df.withColumn("verification", F.when(F.col("verification").isNotNull() & partial, cleared).otherwise(F.col("verification")))


def cleanup_counts(df: DataFrame, min_samples: int = 8) -> DataFrame:
    """One row ``(total, complete, incomplete, no_verification)`` of what ``clear_incomplete`` finds."""
    df = _v(df)
    size, n = F.coalesce(F.size("verification.samples"), F.lit(0)), F.coalesce("verification.num_samples", F.lit(0))
    none = F.col("verification").isNull() | (F.to_json("verification") == "{}")
    complete = ~none & (size >= min_samples) & (n >= min_samples)
    partial = ~none & ~complete & ((size > 0) | (n > 0))
    return df.agg(F.count("*").alias("total"), F.count_if(complete).alias("complete"), F.count_if(partial).alias("incomplete"), F.count_if(none).alias("no_verification"))


def rollouts(df: DataFrame) -> DataFrame:
    """One row a record with samples: the side table of rollout results."""
    v = F.col("verification")
    d = _v(df).where(F.size("verification.samples") > 0)
    return d.select(col("record_id").alias("record_id"), v["model"].alias("model"), F.to_json(v["samples"]).alias("samples"), F.to_json(F.transform(v["samples"], lambda s: F.coalesce(s["answer"], F.lit("")))).alias("parsed_answers"), v["majority_answer"].alias("majority_answer"), v["majority_count"].alias("majority_count"), v["majority_matches_gt"].alias("is_correct"))


def retry_records(df: DataFrame, num_samples: int = 8, max_question_chars: int = 12000, phase: str | None = None) -> DataFrame:
    df = _v(df)
    out = df.where((F.coalesce(F.size("verification.samples"), F.lit(0)) < num_samples) & (F.length(col("question")) <= max_question_chars))
    return out if phase is None else out.where(col("training_phase") == phase)


@F.pandas_udf(T.StringType())
def sample_answer(solution: pd.Series, reasoning: pd.Series, given: pd.Series) -> pd.Series:
    """The boxed answer of solution or else reasoning, else the given one, whichever isn't only punctuation."""
    junk = lambda t: not any(c.isalnum() for c in t)

    def one(s: str | None, r: str | None, g: str | None) -> str:
        found = [text.boxed(s), text.boxed(r) if r != s else "", (g or "").strip()]
        return next((x for x in found if x and not junk(x)), "")

    return pd.Series([one(*x) for x in zip(solution, reasoning, given, strict=True)])
