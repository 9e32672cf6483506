"""Core queries by name, each with its SQL where SQL can express it.

Names begin with the operator's place in the inventory: s sources, k sinks, f functions, c record
operators, j joins, a aggregates, t sorting and sampling, d deduplication, x decontamination,
e evaluation, o orchestration, l model calls, z streaming. Every query reads its whole tables.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks import runtime, schema
from siltworks.functions import rules, text
from siltworks.operators import clean, decontaminate, dedup, evaluate, inference, relational
from siltworks.operators.clean import col
from siltworks.plans import runner, sqltext as q
from siltworks.sources import readers, writers
from siltworks.streaming import streams

FLAGSHIP = "o01_route_report"
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def records(spark: SparkSession, d: str, fresh: bool = False) -> DataFrame:
    """Canonical records; ``fresh`` forgets the tags of the earlier run."""
    df = schema.canonical(runtime.table(spark, d, "canonical_records"))
    return df.withColumns({"training_phase": F.lit(""), "filter_tag": F.lit("")}) if fresh else df


ROUTED = ["record_id", "training_phase", "filter_tag"]


def _routed(name: str, **options):
    return lambda spark, d: clean.PROCESSORS[name](records(spark, d, True), **options).select(*ROUTED)


def _route_sql(phase_tag: str, source: str = q.RECORDS) -> str:
    """phase_tag: an expression that gives 'phase/tag' or NULL."""
    return f"SELECT record_id, coalesce(split_part(v, '/', 1), '') AS training_phase, coalesce(split_part(v, '/', 2), '') AS filter_tag FROM (SELECT record_id, {phase_tag} AS v FROM {source})"


# ---- the rules as SQL ----

_Q, _A = "question", "raw_dataset_answer"
_SQ = q.strip(_Q)


def _prompt(c: str = _Q) -> str:
    t = q.strip(c)
    cue = " OR ".join(f"contains({q.normal(t)}, '{x}')" for x in rules.ANSWER_CUES)
    overlap = f"CASE WHEN length({q.normal(_A)}) >= 8 AND contains({q.normal(t)}, {q.normal(_A)}) AND ({cue}) THEN 'midtrain/answer_leakage' END"
    return q.first(t, [(f, p, f"midtrain/{tag}") for f, p, tag, _ in rules.PROMPT_CONTAMINATION], overlap)


def _missing(c: str = _Q) -> str:
    t = q.strip(c)
    ahead = r"(?!.*[\n].*[\n].*[\n])"  # written as what may follow, for an engine without lookahead
    missing = [(f, p.replace(ahead, r"[^\n]*(?:\n[^\n]*){0,2}\z"), "drop/missing_context") for f, p, _ in rules.MISSING_CONTEXT + rules.UNDERSPECIFIED]
    broken = [(f, p, "drop/broken_format") for f, p, _ in rules.BROKEN_FORMAT]
    uneven = " OR ".join(f"{q.count(t, a)} <> {q.count(t, b)}" for a, b in ("()", "[]", "{}"))
    return q.first(t, missing + broken, f"CASE WHEN length({t}) < 400 AND ({uneven}) THEN 'drop/broken_format' END")


def _language(c: str = _Q) -> str:
    n, latin, cjk = q.letters(c), q.letters(c, "latin"), q.letters(c, "cjk")
    return f"CASE WHEN {n} = 0 THEN NULL WHEN ({n} - {latin} - {cjk})::DOUBLE / {n} >= 0.1 THEN 'drop/other_non_english' WHEN {cjk}::DOUBLE / {n} >= 0.1 THEN 'midtrain/chinese' END"


def _phantom(c: str = _Q) -> str:
    return f"CASE WHEN {q.has(c, '|'.join(f'(?:{p})' for p in rules.PHANTOM_REFERENCE), 'i')} THEN 'drop/phantom_reference' END"


def _broken(c: str = _Q) -> str:
    bare = q.strip(q.sub(c, rules.LATEX[1], "", rules.LATEX[0]))
    return q.first(c, [(f, p, "drop/broken_reference") for f, p in rules.BROKEN_REFERENCE], f"CASE WHEN length({bare}) < 30 AND NOT {q.has(bare, rules.VERB[1], rules.VERB[0])} THEN 'drop/bare_expression' END")


def _meta(c: str = _Q) -> str:
    return q.first(c, [(f, p, "midtrain/meta_task") for f, p in rules.META_TASK])


def _boolean() -> str:
    return f"CASE WHEN {q.normal(_A)} IN ({', '.join(repr(x) for x in rules.BOOLEAN_ANSWERS)}) THEN 'midtrain/boolean_and_mcq' END"


def _quality(c: str = _Q) -> str:
    a = q.strip(_A)
    n = f"len(regexp_extract_all({a}, '[.!?]'))"
    plain = f"NOT {q.has(a, rules.MATH_SYMBOL[1])}"
    test = [q.has(a, rules.PROOF_BLOCK[1], "i"), f"({q.has(c, rules.PROVE_PROMPT[1], 'i')} AND length({a}) > 200)", f"({q.has(a, rules.PROOF_KEYWORD[1], 'i')} AND (length({a}) > 120 OR {n} > 1))", f"(length({a}) > 500 AND {plain})", f"({n} > 3 AND {plain})"]
    return f"CASE WHEN {a} <> '' AND ({' OR '.join(test)}) THEN 'midtrain/non_verifiable_answer' END"


def _empty() -> str:
    return f"CASE WHEN {q.strip(_A)} = '' THEN 'midtrain/empty_ground_truth' END"


_SHORT = f"CASE WHEN {q.short(_Q)} THEN 'drop/short_question' END"
for _key, _name, _sql in (
    ("c04", "prompt_contamination_filter", _prompt()), ("c05", "missing_context_filter", _missing()), ("c06", "length_filter", _SHORT), ("c07", "language_filter", _language()), ("c08", "math_filter", None), ("c09", "phantom_reference_filter", _phantom()), ("c10", "broken_question_filter", _broken()),
    ("c12", "meta_task_filter", _meta()), ("c13", "boolean_answer_filter", _boolean()), ("c14", "answer_quality_filter", _quality()), ("c15", "empty_answer_tagger", _empty()),
):
    query(f"{_key}_{_name}", _route_sql(_sql) if _sql else None)(_routed(_name))

PIPELINE = ["text_cleaning", "prompt_contamination_filter", "missing_context_filter", "length_filter", "empty_answer_tagger", "language_filter", "phantom_reference_filter", "broken_question_filter", "meta_task_filter", "boolean_answer_filter", "answer_quality_filter"]
_CLEANED = f"(SELECT * REPLACE ({q.formatted(q.urls(_Q))} AS question) FROM {q.RECORDS})"
_CHAIN = f"coalesce(CASE WHEN {q.short(_Q)} THEN 'drop/short_question' END, {_prompt()}, {_missing()}, {_empty()}, {_language()}, {_phantom()}, {_broken()}, {_meta()}, {_boolean()}, {_quality()})"


@query("o01_route_report", f"SELECT dataset_name, coalesce(split_part(v, '/', 1), '') AS training_phase, coalesce(split_part(v, '/', 2), '') AS filter_tag, count(*) AS records FROM (SELECT dataset_name, {_CHAIN} AS v FROM {_CLEANED}) GROUP BY ALL")
def route_report(spark, d):
    """The routing pipeline and its report by dataset, phase and tag."""
    df = runner.run(records(spark, d, True).select(*schema.TEXT_COLUMNS), {"processors": [{"name": n} for n in PIPELINE]})
    return df.groupBy("dataset_name", "training_phase", "filter_tag").agg(F.count("*").alias("records"))


# ---- sources and sinks ----


@query("s01_read_columns", f"SELECT record_id, question, dataset_name FROM {q.RECORDS}")
def read_columns(spark, d):
    return readers.read_canonical(spark, f"{d}/canonical_records.parquet", ["record_id", "question", "dataset_name"])


@query("s04_same_format", "SELECT coalesce(nullif(trim(uid), ''), sha256(coalesce(question, ''))) AS record_id, coalesce(question, '') AS question, coalesce(ground_truth, '') AS raw_dataset_answer, '' AS confirmed_answer, coalesce(nullif(trim(dataset_name), ''), 'incoming') AS dataset_name FROM incoming_records")
def same_format(spark, d):
    return readers.ingest(runtime.table(spark, d, "incoming_records"), "incoming").select("record_id", "question", "raw_dataset_answer", "confirmed_answer", "dataset_name")


@query("s05_messages", "SELECT sha256(question) AS record_id, question, min(nullif(trim(ground_truth), '')) AS raw_dataset_answer, count(DISTINCT model)::BIGINT AS models FROM (SELECT coalesce(question, '') AS question, ground_truth, coalesce(dataset_name, '') AS model FROM incoming_records) GROUP BY 2")
def messages(spark, d):
    """Rows of one problem from several models become one record (the datasets stand for the models)."""
    t = runtime.table(spark, d, "incoming_records")
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), F.lit("").alias("reasoning_content"), c.alias("content"))
    rows = t.select(col("question").alias("problem"), F.col("ground_truth").alias("expected_answer"), col("dataset_name").alias("model"), F.array(turn("user", col("question")), turn("assistant", col("ground_truth"))).alias("messages"))
    out = readers.from_messages(rows)
    return out.select("record_id", "question", F.nullif(F.col("raw_dataset_answer"), F.lit("")).alias("raw_dataset_answer"), F.size(F.map_keys(F.from_json("distillation", schema.PAYLOADS["distillation"]))).cast("long").alias("models"))


@query("s06_conversations", "SELECT sha256(question) AS record_id, question, coalesce(ground_truth, '') AS raw_dataset_answer FROM benchmark_questions")
def conversations(spark, d):
    t = runtime.table(spark, d, "benchmark_questions")
    turn = lambda role, said, truth: F.struct(F.lit(role).alias("from"), said.alias("value"), F.struct(truth.alias("value")).alias("ground_truth"))
    none = F.lit(None).cast("string")
    rows = t.select(F.array(turn("system", F.lit("Think."), none), turn("human", F.col("question"), none), turn("assistant", F.lit("..."), F.col("ground_truth"))).alias("turns"))
    return readers.from_conversations(rows).select("record_id", "question", "raw_dataset_answer")


@query("s07_benchmarks", f"SELECT coalesce(uid, '') AS uid, coalesce(dataset_name, '') AS dataset_name, {q.strip('question')} AS question, coalesce(ground_truth, '') AS ground_truth FROM benchmark_questions WHERE {q.strip('question')} <> ''")
def benchmarks(spark, d):
    return decontaminate.load_benchmarks(runtime.table(spark, d, "benchmark_questions"))


@query("k02_shards", "SELECT count(*) AS records, count(DISTINCT record_id) AS ids FROM canonical_records")
def shards(spark, d):
    path = runtime.scratch(spark, "shards")
    writers.write_shards(records(spark, d), path, 1 << 20)
    return spark.read.parquet(path).agg(F.count("*").alias("records"), F.countDistinct("record_id").alias("ids"))


@query("k03_audit")
def audit(spark, d):
    return relational.audit(records(spark, d)).select("record_id", "step", "processor", "status", "reason_code")


@query("k07_split", f"SELECT CASE WHEN training_phase IN ('drop', 'midtrain') THEN training_phase ELSE 'posttrain' END AS bucket, count(*) AS records FROM {q.RECORDS} GROUP BY 1")
def split(spark, d):
    path = runtime.scratch(spark, "split")
    writers.split_by_phase(records(spark, d), path)
    return spark.read.parquet(path).groupBy("bucket").agg(F.count("*").alias("records"))


# ---- functions ----


@query("f07_format_text", f"SELECT record_id, {q.formatted(q.urls(_Q))} AS question FROM {q.RECORDS}")
def format_text(spark, d):
    return clean.text_cleaning(records(spark, d)).select("record_id", "question")


@query("f05_normalize_text")
def normalize_text(spark, d):
    return clean.text_normalize(records(spark, d)).select("record_id", "question", "raw_dataset_answer")


@query("f09_scripts", f"SELECT record_id, {q.letters(_Q)} AS letters, {q.letters(_Q, 'latin')} AS latin, {q.letters(_Q, 'cjk')} AS cjk FROM {q.RECORDS}")
def scripts(spark, d):
    n = text.script_counts(F.col("question"))
    return records(spark, d).select("record_id", n["total"].cast("long").alias("letters"), n["latin"].cast("long").alias("latin"), n["cjk"].cast("long").alias("cjk"))


_GRAMS = "list_distinct(list_transform(range(1, greatest(length(t) - 1, 2)), lambda i: substring(t, i, 3)))"


@query("f17_ngrams", f"SELECT record_id, t AS normal, CASE WHEN t = '' THEN 0 ELSE len({_GRAMS}) END::BIGINT AS grams FROM (SELECT record_id, {q.minhash(_Q)} AS t FROM {q.RECORDS})")
def ngrams(spark, d):
    df = records(spark, d).select("record_id", text.minhash_text(F.col("question")).alias("normal"))
    return df.withColumn("grams", F.size(text.char_ngrams(F.col("normal"))).cast("long"))


@query("f20_hashes", f"SELECT record_id, sha256(question) AS sha256, md5(question) AS md5 FROM {q.RECORDS}")
def hashes(spark, d):
    return records(spark, d).select("record_id", F.sha2("question", 256).alias("sha256"), F.md5("question").alias("md5"))


@query("f21_ratios")
def ratios(spark, d):
    df = records(spark, d)
    return df.select("record_id", F.round(text.gzip_ratio(F.col("question")), 6).alias("gzip_ratio"), text.token_count()(F.col("question")).alias("tokens"), text.ngram_repetition()(F.col("question")).alias("repetition"))


@query("f24_answers", f"SELECT record_id, upper(regexp_extract({q.strip(_A)}, '(?:^|[^\\p{{L}}\\p{{N}}_])([A-Fa-f])(?:$|[^\\p{{L}}\\p{{N}}_])', 1)) AS letter, CASE WHEN length(question) > 200 THEN substring(question, 1, 188) || chr(10) || '[TRUNCATED]' ELSE question END AS short_question FROM {q.RECORDS}")
def answers(spark, d):
    return records(spark, d).select("record_id", text.answer_letter(F.col("raw_dataset_answer")).alias("letter"), text.truncated(F.col("question"), 200).alias("short_question"))


@query("f25_boxed")
def boxed(spark, d):
    return records(spark, d).select("record_id", text.extract_boxed(F.col("raw_dataset_answer")).alias("boxed"), text.parse_answer(F.col("raw_dataset_answer")).alias("parsed"))


for _key, _name in (("c01", "text_normalize"), ("c02", "instruction_wrapper_cleaner")):
    query(f"{_key}_{_name}")(lambda spark, d, n=_name: clean.PROCESSORS[n](records(spark, d)).select("record_id", "question"))
query("c03_text_cleaning", ORACLES["f07_format_text"])(format_text)
for _key, _name in (("c19", "gzip_ratio_annotator"), ("c20", "token_count_annotator")):
    query(f"{_key}_{_name}")(lambda spark, d, n=_name: schema.encode(clean.PROCESSORS[n](records(spark, d))).select("record_id", "distillation", "meta"))


# ---- joins ----


@query("j01_keep_ids", "SELECT record_id FROM canonical_records WHERE record_id IN (SELECT left_id FROM dedup_pairs) GROUP BY 1")
def keep_ids(spark, d):
    ids = runtime.table(spark, d, "dedup_pairs").select(F.col("left_id").alias("record_id"))
    return relational.keep_ids(records(spark, d), ids, unique=True).select("record_id")


@query("j02_drop_ids", "SELECT record_id FROM canonical_records WHERE record_id NOT IN (SELECT right_id FROM dedup_pairs WHERE right_id IS NOT NULL)")
def drop_ids(spark, d):
    return relational.drop_ids(records(spark, d), runtime.table(spark, d, "dedup_pairs").select(F.col("right_id").alias("record_id"))).select("record_id")


@query("j03_merge", "SELECT record_id, 'old' AS part FROM canonical_records UNION ALL SELECT DISTINCT i.id, 'new' FROM (SELECT coalesce(nullif(trim(uid), ''), sha256(coalesce(question, ''))) AS id FROM incoming_records) i WHERE i.id NOT IN (SELECT record_id FROM canonical_records)")
def merge(spark, d):
    old = records(spark, d).select("record_id", F.lit("old").alias("part"))
    new = readers.ingest(runtime.table(spark, d, "incoming_records")).select("record_id", F.lit("new").alias("part"))
    return relational.merge(old, new)


@query("j04_pre_tag", f"SELECT record_id, CASE WHEN record_id IN (SELECT left_id FROM dedup_pairs WHERE method = 'exact') THEN 'midtrain' ELSE training_phase END AS training_phase FROM {q.RECORDS}")
def pre_tag(spark, d):
    source = runtime.table(spark, d, "dedup_pairs").withColumnRenamed("left_id", "uid")
    return relational.pre_tag(records(spark, d), source, "method", "exact", "midtrain").select("record_id", "training_phase")


@query("j08_knn", "SELECT query_id, id, rank, similarity FROM (SELECT a.vec_id AS query_id, b.vec_id AS id, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 12) DESC, b.vec_id) AS rank, round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity FROM embeddings a, embeddings b WHERE a.vec_id % 100 = 0) WHERE rank <= 10")
def knn(spark, d):
    """Queries: every vector whose id is divisible by 100; searched: all vectors."""
    return _neighbours(spark, d).select("query_id", "id", F.col("rank").cast("long").alias("rank"), F.round("similarity", 6).alias("similarity"))


def _neighbours(spark, d, k: int = 10):
    e = runtime.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return decontaminate.knn(e.where("id % 100 = 0"), e, k)


@query("j10_tiers", f"SELECT DISTINCT dataset_name, coalesce((SELECT arg_max(t.tier, length(t.dataset_name)) FROM dataset_tiers t WHERE starts_with(r.dataset_name, t.dataset_name)), 2147483647)::INTEGER AS tier FROM {q.RECORDS} r")
def tiers(spark, d):
    return dedup.with_tier(records(spark, d).select("dataset_name"), _tier_lists(spark, d), strict=False).distinct()


def _tier_lists(spark, d) -> dict[int, list[str]]:
    rows = runtime.table(spark, d, "dataset_tiers").limit(dedup.NAMES).collect()
    out: dict[int, list[str]] = {}
    for r in rows:
        out.setdefault(int(r["tier"]), []).append(r["dataset_name"])
    return out


@query("j11_compare", f"WITH r AS (SELECT * FROM {q.RECORDS}) SELECT dataset_name, count(*) AS before, count(*) FILTER (WHERE training_phase <> 'drop') AS after FROM r GROUP BY 1")
def compare(spark, d):
    df = records(spark, d)
    return relational.compare_counts(df, df.where("training_phase <> 'drop'"))


# ---- aggregates ----

_FILLED = "trim(coalesce(distillation, '')) NOT IN ('', '{}', 'null')"
query("a01_stats", f"SELECT coalesce(dataset_name, '') AS dataset_name, count(*) AS records, count(*) FILTER (WHERE {_FILLED}) AS with_distillation FROM canonical_records GROUP BY 1")(lambda s, d: relational.stats(records(s, d)))
query("a04_phase_matrix", f"SELECT dataset_name, count(*) FILTER (WHERE training_phase NOT IN ('drop', 'midtrain')) AS posttrain, count(*) FILTER (WHERE training_phase = 'midtrain') AS midtrain, count(*) FILTER (WHERE training_phase = 'drop') AS drop, count(*) AS total FROM {q.RECORDS} GROUP BY 1")(lambda s, d: relational.phase_matrix(records(s, d)))
query("a04_tag_counts", f"SELECT dataset_name, filter_tag, count(*) AS records FROM {q.RECORDS} GROUP BY 1, 2")(lambda s, d: relational.tag_counts(records(s, d)))
query("a04_trace_counts")(lambda s, d: relational.trace_counts(records(s, d)))
query("a06_distribution", f"SELECT filter_tag AS value, count(*) AS records, round(100.0 * count(*) / sum(count(*)) OVER (), 4)::DOUBLE AS percent FROM {q.RECORDS} GROUP BY 1")(lambda s, d: relational.distribution(records(s, d), "filter_tag"))
query("a07_majority", "SELECT user_id, event_type AS majority_answer, n AS majority_count FROM (SELECT user_id, event_type, count(*) AS n, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, min(ts), event_type) AS k FROM events WHERE event_type <> '' GROUP BY 1, 2) WHERE k = 1")(lambda s, d: evaluate.majority_by(runtime.table(s, d, "events"), "user_id", "event_type", "ts"))
query("a12_latency", "SELECT count(*) AS requests, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.99), 6) AS p99 FROM events")(lambda s, d: relational.latency_summary(runtime.table(s, d, "events"), "value").select("requests", *(F.round(c, 6).alias(c) for c in ("mean", "p50", "p99"))))
query("a13_usefulness")(lambda s, d: relational.sample_usefulness(records(s, d)))


@query("a05_stage_matrix", f"WITH r AS (SELECT * FROM {q.RECORDS}) SELECT coalesce(dataset_name, '(total)') AS dataset_name, count(*) AS ingested, count(*) FILTER (WHERE training_phase <> 'drop') AS kept, count(*) - count(*) FILTER (WHERE training_phase <> 'drop') AS lost FROM r GROUP BY ROLLUP (dataset_name)")
def stage_matrix(spark, d):
    df = records(spark, d)
    return relational.stage_matrix({"ingested": df, "kept": df.where("training_phase <> 'drop'")})


# ---- sampling ----

query("t07_sample", "SELECT record_id FROM canonical_records ORDER BY md5('42:' || record_id), record_id LIMIT 100")(lambda s, d: relational.sample(records(s, d), 100).select("record_id"))


@query("t08_stratified", f"""WITH r AS (SELECT * FROM {q.RECORDS} WHERE training_phase <> 'drop'), z AS (SELECT dataset_name, count(*) AS size, sum(count(*)) OVER () AS everyone FROM r GROUP BY 1),
w AS (SELECT *, 300.0::DOUBLE * size / everyone AS raw, least(size, floor(300.0::DOUBLE * size / everyone)) AS base FROM z), v AS (SELECT *, row_number() OVER (ORDER BY raw - base DESC, dataset_name DESC) AS k, 300 - sum(base) OVER () AS spare FROM w),
u AS (SELECT dataset_name, CASE WHEN 300 >= everyone THEN size ELSE least(size, base + (k <= spare)::INTEGER) END AS quota FROM v),
o AS (SELECT r.record_id, r.dataset_name, quota, row_number() OVER (PARTITION BY r.dataset_name ORDER BY md5('42:' || record_id), record_id) AS n FROM r JOIN u USING (dataset_name))
SELECT record_id, dataset_name FROM o WHERE n <= quota""")
def stratified(spark, d):
    return relational.stratified_sample(records(spark, d).select("record_id", "dataset_name", "training_phase"), 300).select("record_id", "dataset_name")


# ---- deduplication ----

_KEYED = f"SELECT DISTINCT record_id, lower({_SQ}) AS k FROM {q.RECORDS}"
query("d01_exact_dedup", f"SELECT min(record_id) AS record_id FROM ({_KEYED}) GROUP BY k")(lambda s, d: dedup.exact_survivors(records(s, d)).select("record_id"))
query("d01_exact_pairs", f"SELECT m AS left_id, record_id AS right_id, 1.0::DOUBLE AS similarity FROM (SELECT record_id, min(record_id) OVER (PARTITION BY k) AS m FROM ({_KEYED})) WHERE m <> record_id")(lambda s, d: dedup.exact_pairs(records(s, d)))
_PAIRS = f"""n AS MATERIALIZED (SELECT uid AS id, min({q.minhash('question')}) AS t FROM (SELECT uid, coalesce(question, '') AS question FROM incoming_records WHERE uid IS NOT NULL AND trim(uid) <> '') GROUP BY 1),
c AS MATERIALIZED (SELECT min(id) AS id, t FROM n WHERE t <> '' GROUP BY t), g AS MATERIALIZED (SELECT id, unnest({_GRAMS}) AS gram FROM c), z AS (SELECT id, count(*) AS size FROM g GROUP BY 1),
p AS MATERIALIZED (SELECT i.l AS left_id, i.r AS right_id, i.n::DOUBLE / (a.size + b.size - i.n) AS s FROM (SELECT x.id AS l, y.id AS r, count(*) AS n FROM g x JOIN g y ON x.gram = y.gram AND x.id < y.id GROUP BY 1, 2) i JOIN z a ON a.id = l JOIN z b ON b.id = r WHERE i.n::DOUBLE / (a.size + b.size - i.n) >= 0.8)"""


def _incoming(spark, d) -> DataFrame:
    t = runtime.table(spark, d, "incoming_records").where("uid is not null and trim(uid) <> ''")
    return t.select(F.col("uid").alias("record_id"), col("question").alias("question"), F.lit("").alias("training_phase"), "dataset_name")


def _incoming_pairs(spark, d, exact: bool = True) -> DataFrame:
    reps = dedup.representatives(_incoming(spark, d))
    return dedup.jaccard_pairs(reps) if exact else dedup.lsh_pairs(reps)


query("d02_jaccard_pairs", f"WITH {_PAIRS} SELECT left_id, right_id, round(s, 6) AS similarity FROM p")(lambda s, d: _incoming_pairs(s, d).withColumn("similarity", F.round("similarity", 6)))
query("d02_lsh_pairs")(lambda s, d: _incoming_pairs(s, d, False).withColumn("similarity", F.round("similarity", 6)))
query("d04_fuzzy_dedup", f"WITH RECURSIVE {_PAIRS}, e AS MATERIALIZED (SELECT left_id a, right_id b FROM p UNION SELECT m, id FROM (SELECT id, min(id) OVER (PARTITION BY t) AS m FROM n) WHERE m <> id), y AS MATERIALIZED (SELECT a x, b y FROM e UNION SELECT b, a FROM e), v AS (SELECT id AS x, id AS y FROM n UNION SELECT v.x, y.y FROM v JOIN y ON v.y = y.x) SELECT record_id FROM (SELECT x AS record_id, min(y) AS m FROM v GROUP BY 1) WHERE m = record_id")(lambda s, d: dedup.fuzzy_dedup(_incoming(s, d)).select("record_id").distinct())


def _canonical_pairs(spark, d, exact: bool = True) -> DataFrame:
    """Near duplicates among all canonical records, of any phase; too many for a self-join in SQL."""
    reps = dedup.representatives(records(spark, d))
    return (dedup.jaccard_pairs(reps) if exact else dedup.lsh_pairs(reps)).withColumn("similarity", F.round("similarity", 6))


query("d02_canonical_jaccard_pairs")(_canonical_pairs)
query("d02_canonical_lsh_pairs")(lambda s, d: _canonical_pairs(s, d, False))
query("d04_canonical_fuzzy_dedup")(lambda s, d: dedup.fuzzy_dedup(records(s, d)).select("record_id").distinct())
query("a11_similarity_buckets", "SELECT round(floor(similarity / 0.05 + 1e-9) * 0.05, 6) AS bucket, count(*) AS pairs FROM dedup_pairs WHERE similarity IS NOT NULL AND NOT isnan(similarity) GROUP BY 1")(lambda s, d: dedup.similarity_buckets(runtime.table(s, d, "dedup_pairs").where("similarity is not null and not isnan(similarity)")))
query("a11_thresholds")(lambda s, d: dedup.threshold_sensitivity(runtime.table(s, d, "dedup_pairs").where("left_id is not null and right_id is not null and not isnan(similarity)"), [0.7, 0.8, 0.9]))

# ---- decontamination ----

_JUDGED = f"({ORACLES['j08_knn']})"


def _judged(spark, d) -> DataFrame:
    n = _neighbours(spark, d)
    yes = (F.round("similarity", 6) >= 0.9) & (F.col("id") != F.col("query_id"))
    return n.select(F.col("id").cast("string").alias("record_id"), F.col("query_id").cast("string").alias("benchmark_id"), (F.col("query_id") % 1000).cast("string").alias("benchmark_source"), F.round("similarity", 6).alias("similarity"), F.when(yes, "yes").otherwise("no").alias("llm_decision"))


@query("x01_evidence", f"SELECT v.vec_id::VARCHAR AS record_id, coalesce(j.n, 0)::BIGINT AS candidates, CASE WHEN coalesce(j.hit, FALSE) THEN 'contaminated' ELSE '' END AS filter_tag FROM embeddings v LEFT JOIN (SELECT id, count(*) AS n, bool_or(similarity >= 0.9 AND id <> query_id) AS hit FROM {_JUDGED} GROUP BY 1) j ON j.id = v.vec_id")
def evidence(spark, d):
    rows = runtime.table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("record_id"), F.lit("").alias("training_phase"), F.lit("").alias("filter_tag"), F.lit("{}").alias("decontamination"))
    out = decontaminate.attach_evidence(rows, _judged(spark, d))
    return out.select("record_id", F.size(F.from_json("decontamination", schema.PAYLOADS["decontamination"])["candidates"]).cast("long").alias("candidates"), "filter_tag")


query("a03_drop_rates", f"SELECT (query_id % 1000)::VARCHAR AS benchmark_source, count(*) AS judged, count(*) FILTER (WHERE similarity >= 0.9 AND id <> query_id) AS contaminated, round(count(*) FILTER (WHERE similarity >= 0.9 AND id <> query_id)::DOUBLE / count(*), 4) AS drop_rate FROM {_JUDGED} GROUP BY 1")(lambda s, d: decontaminate.drop_rates(_judged(s, d)))
query("t10_preview")(lambda s, d: decontaminate.preview(_neighbours(s, d, 50)))


def _letters(texts: list[str]) -> list[list[float]]:
    """A stand-in embedder: counts of letters."""
    return [[float(t.lower().count(c)) for c in "abcdefghijklmnopqrstuvwxyz"] for t in texts]


@query("x02_decontamination")
def decontaminated(spark, d):
    """Nearest records of every benchmark question, judged by a rule; evidence and tags of all records."""
    out = decontaminate.decontamination(records(spark, d, True), runtime.table(spark, d, "benchmark_questions"), _letters, lambda p: '{"decision": "no"}', 5, 0.95)
    return out.select("record_id", "training_phase", F.size(F.from_json("decontamination", schema.PAYLOADS["decontamination"])["candidates"]).alias("candidates"))


query("x02_load", "SELECT 'records' AS side, training_phase AS name, count(*) AS rows FROM canonical_records WHERE training_phase IN ('posttrain', 'midtrain') GROUP BY 2 UNION ALL SELECT 'benchmarks', coalesce(dataset_name, ''), count(*) FROM benchmark_questions WHERE trim(question) <> '' GROUP BY 2")(lambda s, d: decontaminate.phase_counts(records(s, d), runtime.table(s, d, "benchmark_questions")))


# ---- evaluation and model calls (a rule stands in for the model) ----


def _agree(prompt: str) -> str:
    """A stand-in judge: decides by the length of the prompt."""
    return json.dumps({"gt_quality": "clear", "judgement": "equivalent" if len(prompt) % 2 else "not_equivalent", "majority_answer": "x", "majority_count": 2})


query("e01_verification")(lambda s, d: evaluate.build_verification(records(s, d)).select("record_id", "verification.num_samples", "verification.majority_answer", "verification.majority_count", "verification.majority_matches_gt", F.round("verification.pass_ratio", 6).alias("pass_ratio")))
query("e02_answer_judge")(lambda s, d: evaluate.answer_judge(records(s, d), _agree).select(*ROUTED))
query("e03_sample_judge")(lambda s, d: evaluate.sample_answer_judge(records(s, d)).select(*ROUTED))
query("e04_difficulty")(lambda s, d: evaluate.difficulty_annotation(records(s, d), lambda p: f"about {len(p) % 10 + 1}").select("record_id", "verification.difficulty_annotation.score"))
_V = "(SELECT record_id, coalesce(question, '') AS question, coalesce(dataset_name, '') AS dataset_name, coalesce(training_phase, '') AS training_phase, coalesce(filter_tag, '') AS filter_tag, CASE WHEN json_valid(verification) THEN verification END AS v FROM canonical_records)"
_N = "coalesce(json_array_length(v, '$.samples'), 0)"
_LOW = f"training_phase = 'posttrain' AND {_N} > 0 AND coalesce(TRY_CAST(json_extract_string(v, '$.majority_count') AS INTEGER), 0) < 2"
ORACLES["e03_sample_judge"] = f"SELECT record_id, CASE WHEN {_LOW} THEN 'midtrain' ELSE training_phase END AS training_phase, CASE WHEN {_LOW} THEN 'low_confidence' ELSE filter_tag END AS filter_tag FROM {_V}"
ORACLES["e07_retry"] = f"SELECT record_id FROM {_V} WHERE {_N} < 3 AND length(question) <= 12000"
ORACLES["e06_clear_incomplete"] = f"SELECT record_id, CASE WHEN {_N} BETWEEN 1 AND 2 OR (n > 0 AND ({_N} < 3 OR n < 3)) THEN NULL ELSE n0 END AS num_samples FROM (SELECT *, TRY_CAST(json_extract_string(v, '$.num_samples') AS INTEGER) AS n0, coalesce(TRY_CAST(json_extract_string(v, '$.num_samples') AS INTEGER), 0) AS n FROM {_V})"
ORACLES["a13_usefulness"] = f"SELECT dataset_name, count(*) AS samples, count(*) FILTER (WHERE coalesce(json_extract_string(e, '$.answer'), '') <> '') AS with_answer, count(*) FILTER (WHERE json_extract_string(e, '$.judge_correct') = 'true') AS judged_right FROM (SELECT dataset_name, unnest(json_extract(v, '$.samples[*]')) AS e FROM {_V} WHERE json_extract_string(v, '$.majority_matches_gt') = 'false') GROUP BY 1"
_E = "(SELECT coalesce(record_id, '') AS record_id, coalesce(dataset_name, '') AS dataset_name, unnest(list_transform(json_extract(trace, '$[*]'), lambda e, i: {'step': i - 1, 'e': e})) AS x FROM canonical_records WHERE json_valid(trace) AND json_type(trace) = 'ARRAY')"
ORACLES["a04_trace_counts"] = f"SELECT dataset_name, json_extract_string(x.e, '$.processor') AS processor, json_extract_string(x.e, '$.status') AS status, count(*) AS events FROM {_E} GROUP BY 1, 2, 3"
ORACLES["k03_audit"] = f"SELECT record_id, x.step::INTEGER AS step, json_extract_string(x.e, '$.processor') AS processor, json_extract_string(x.e, '$.status') AS status, json_extract_string(x.e, '$.reason_code') AS reason_code FROM {_E}"
ORACLES["t10_preview"] = "SELECT k, count(*) AS pairs, count(DISTINCT id) AS rows, round(min(s), 6) AS lowest, round(avg(s), 6) AS mean FROM (" + ORACLES["j08_knn"].replace("rank <= 10", "rank <= 50").replace("round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity", "round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 12) AS s").replace("query_id, id, rank, similarity", "id, rank, s") + ") n, (VALUES (5), (10), (20), (50)) v(k) WHERE rank <= k GROUP BY 1"
_RATIO = "CASE WHEN json_valid(verification) THEN coalesce(TRY_CAST(json_extract_string(verification, '$.pass_ratio') AS DOUBLE), 0) ELSE 0 END"
query("e05_pass_ratio", f"SELECT record_id FROM canonical_records WHERE {_RATIO} BETWEEN 0.2 AND 0.9")(lambda s, d: evaluate.pass_ratio_filter(records(s, d), 0.2, 0.9).select("record_id"))
query("e06_clear_incomplete")(lambda s, d: evaluate.clear_incomplete(records(s, d), 3).select("record_id", "verification.num_samples"))
query("e07_retry")(lambda s, d: evaluate.retry_records(records(s, d), 3).select("record_id"))
query("l01_classifier")(lambda s, d: inference.llm_classifier(records(s, d, True), lambda p: json.dumps({"label": "keep", "tag": "short" if len(p) < 200 else "math"}), {"drop": ["short"], "keep": ["math"]}, {"drop": "drop", "keep": "keep"}).select(*ROUTED))
query("l02_cache", "SELECT sha256(question) AS key, length(question)::VARCHAR AS reply FROM (SELECT DISTINCT coalesce(question, '') AS question FROM benchmark_questions)")(lambda s, d: inference.infer(runtime.table(s, d, "benchmark_questions").select(col("question").alias("prompt")), lambda p: str(len(p))).select("key", "reply"))
query("l05_embed")(lambda s, d: inference.embed(runtime.table(s, d, "benchmark_questions").select("uid", "question"), "question", lambda ts: [[float(len(t)), 1.0] for t in ts]).select("uid", F.size("embedding").alias("dims")))


# ---- orchestration and streaming ----

query("o09_validate", "SELECT record_id, problem FROM (" + " UNION ALL ".join(f"SELECT record_id, 'empty {c}' AS problem FROM {q.RECORDS} WHERE trim({c}) = ''" for c in ("record_id", "question", "dataset_name")) + ")")(lambda s, d: relational.validate(records(s, d)))


@query("o04_add_dataset")
def add_dataset(spark, d):
    """Incoming rows added to the canonical ones: cleaned, deduplicated exactly, merged."""
    new = readers.ingest(runtime.table(spark, d, "incoming_records"), "incoming")
    config = {"processors": [{"name": "text_cleaning"}, {"name": "exact_dedup"}, {"name": "length_filter"}]}
    return runner.add_dataset(records(spark, d), new, config, []).select("record_id", "dataset_name")


@query("z01_stream_route", _route_sql(_language()))
def stream_route(spark, d):
    """The language filter on a stream of files."""
    source = spark.read.parquet(f"{d}/canonical_records.parquet")
    stream = schema.canonical(streams.read(spark, f"{d}/canonical_record[s].parquet", source.schema)).withColumns({"training_phase": F.lit(""), "filter_tag": F.lit("")})
    path = runtime.scratch(spark, "stream")
    streams.write(streams.clean(stream, ["language_filter"]).select(*ROUTED), f"{path}/out", f"{path}/state").awaitTermination()
    return spark.read.parquet(f"{path}/out")


from siltworks.plans import surface  # noqa: E402, F401 - registers further queries
