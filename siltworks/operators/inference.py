"""Model calls as dataflow: pluggable clients, a request cache, and parsing as pure functions.

A *client* is any picklable callable from a prompt to a reply. Calls run in Arrow batches on the
executors; a failed call gives an error, never a failed job. With a cache folder, replies are kept
in a table keyed by the hash of the request: only requests that aren't there are made, and they
are made in waves, each of which is kept once it is over, so that a lost job loses one wave at most.
"""

from __future__ import annotations

import json
import re
import time
import urllib.request
from collections.abc import Callable
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks import runtime
from siltworks.operators.clean import col, event, processor, with_event

Client = Callable[[str], str]
Cache = DataFrame | str | None

# Servers that speak the chat protocol.
BACKENDS = ("sglang", "vllm")


class HttpClient:
    """A chat endpoint; failed requests are repeated after 1, 2, 4 and then every 8 seconds."""

    def __init__(self, base_url: str, model: str, retries: int = 3, timeout: float = 120.0, api_key: str = "", headers: dict | None = None, system: str = "", **options):
        self.base_url, self.model, self.retries, self.timeout = base_url.rstrip("/"), model, retries, timeout
        self.headers = {"Content-Type": "application/json", **(headers or {}), **({"Authorization": f"Bearer {api_key}"} if api_key else {})}
        self.system, self.options = system, options

    def body(self, prompt: str) -> dict:
        messages = [{"role": "system", "content": self.system}] if self.system else []
        return {"model": self.model, "messages": [*messages, {"role": "user", "content": prompt}], **self.options}

    def post(self, path: str, body: dict) -> dict:
        data = json.dumps(body, ensure_ascii=False).encode()
        for attempt in range(self.retries):
            try:
                request = urllib.request.Request(f"{self.base_url}{path}", data, self.headers)
                with urllib.request.urlopen(request, timeout=self.timeout) as reply:
                    return json.load(reply)
            except OSError:
                if attempt + 1 == self.retries:
                    raise
                time.sleep(min(2**attempt, 8))
        raise RuntimeError("no retries")

    def __call__(self, prompt: str) -> str:
        return str(self.post("/v1/chat/completions", self.body(prompt))["choices"][0]["message"].get("content") or "")


class HttpEmbedder(HttpClient):
    """An embeddings endpoint; vectors come back in the order of the texts."""

    def __call__(self, texts: list[str]) -> list[list[float]]:
        got = self.post("/v1/embeddings", {"model": self.model, "input": texts, **self.options})["data"]
        return [x["embedding"] for x in sorted(got, key=lambda x: x["index"])]


def build_client(config: dict) -> HttpClient:
    """A client from a configuration: ``backend, base_url, model, api_key, timeout_seconds, max_retries, headers``."""
    if (backend := str(config.get("backend", "")).strip().lower()) not in BACKENDS:
        raise ValueError(f"unknown backend {backend!r}; known: {', '.join(BACKENDS)}")
    return HttpClient(str(config.get("base_url", "")), str(config.get("model", "")), int(config.get("max_retries", 3)), float(config.get("timeout_seconds", 120)), str(config.get("api_key", "")), config.get("headers"), **(config.get("options") or {}))


# ---- prompts ----


def load_prompt(path: str) -> dict:
    """A prompt file: a mapping with ``template`` and ``system_prompt``, and what its operator understands besides."""
    import yaml

    got = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    if not isinstance(got, dict):
        raise ValueError(f"{path} has to hold a mapping")
    return got


def question_template(config: dict) -> tuple[str, str]:
    """(template with ``{problem}``, system prompt): the template, or else what instruction, examples and suffix make up."""
    system = str(config.get("system_prompt") or "").strip()
    if template := str(config.get("template") or "").strip():
        return template, system
    shown = [f"Problem:\n{e.get('question', '')}\nFinal Answer: {e.get('answer', '')}" for e in config.get("examples") or []]
    parts = [str(config.get("instruction") or "").strip(), *(["\n## Examples\n", *shown] if shown else []), str(config.get("suffix", "\nProblem:\n"))]
    return "\n".join(p for i, p in enumerate(parts) if p or i == len(parts) - 1) + "{problem}", system


def judge_template(config: dict) -> tuple[str, str]:
    """(template, system prompt); braces of the output format stand for themselves."""
    template, form = str(config.get("template") or "").strip(), str(config.get("output_format") or "").strip()
    form = form.replace("{", "{{").replace("}", "}}")
    return f"{template}\n\n{form}".strip() if form else template, str(config.get("system_prompt") or "").strip()


def fill(template: str, doubled: bool = False, **values: Column) -> Column:
    """The template with each ``{name}`` replaced by its column; ``doubled`` braces stand for single ones."""
    names = "|".join(map(re.escape, values))
    parts = re.split(rf"\{{({names})\}}" if not doubled else rf"(?<!\{{)\{{({names})\}}(?!\}})", template)
    single = (lambda t: t.replace("{{", "{").replace("}}", "}")) if doubled else (lambda t: t)
    return F.concat(*(F.coalesce(values[p].cast("string"), F.lit("")) if i % 2 else F.lit(single(p)) for i, p in enumerate(parts)))


# ---- requests ----


def _call(client: Client, retries: int):
    def run(batches):
        for b in batches:
            replies, errors = [], []
            for text in b.column(1).to_pylist():
                reply, error = None, None
                for _ in range(retries):
                    try:
                        reply, error = str(client(text)), None
                        break
                    except Exception as e:  # noqa: BLE001 - any failure of a client is data here
                        error = f"{type(e).__name__}: {e}"
                replies.append(reply)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(replies, pa.string()), pa.array(errors, pa.string())], ["key", "reply", "error"])

    return run


def cached(spark: SparkSession, path: str) -> DataFrame | None:
    """``(key, reply)`` kept in a cache folder, one row a key; None where there is none yet."""
    if not runtime.exists(spark, path):
        return None
    return spark.read.schema("key string, reply string").parquet(path).groupBy("key").agg(F.min("reply").alias("reply"))


def infer(prompts: DataFrame, client: Client, cache: Cache = None, retries: int = 1, waves: int = 1) -> DataFrame:
    """``(key, reply, error)`` for each different ``prompt``.

    cache: a frame of earlier ``(key, reply)``, or a folder that is read and written; failed requests
    aren't kept. waves: into how many parts the requests of a folder are cut, each kept when it is over.
    """
    p = prompts.select(F.sha2("prompt", 256).alias("key"), "prompt").distinct()
    schema = "key string, reply string, error string"
    none = F.lit(None).cast("string").alias("error")
    if not isinstance(cache, str):
        todo = p.join(cache.select("key"), "key", "left_anti") if cache is not None else p
        new = todo.mapInArrow(_call(client, retries), schema)
        return new if cache is None else new.unionByName(p.join(cache, "key").select("key", "reply", none))
    spark = prompts.sparkSession
    p = runtime.materialize(p, "requests")
    failed = None
    for w in range(waves):
        have = cached(spark, cache)
        todo = p.where(F.pmod(F.xxhash64("key"), F.lit(waves)) == w)
        todo = todo.join(have, "key", "left_anti") if have is not None else todo
        got = runtime.materialize(todo.mapInArrow(_call(client, retries), schema), "replies")
        got.where("reply is not null").select("key", "reply").write.mode("append").parquet(cache)
        bad = got.where("reply is null")
        failed = bad if failed is None else failed.unionByName(bad)
    return p.join(cached(spark, cache), "key").select("key", "reply", none).unionByName(failed)


def ask(df: DataFrame, prompt: Column, client: Client, cache: Cache = None, retries: int = 1, waves: int = 1) -> DataFrame:
    """Adds ``reply`` and ``error`` to every row."""
    d = df.withColumn("_prompt", prompt).withColumn("_key", F.sha2("_prompt", 256))
    got = infer(d.select(F.col("_prompt").alias("prompt")), client, cache or None, retries, waves).withColumnRenamed("key", "_key")
    return d.join(got, "_key", "left").drop("_key", "_prompt")


def parsing(parse: Callable, schema: str):
    """A parser of single replies as a column function over Arrow batches; what it gives None for has null fields."""
    names = [f.split()[0] for f in schema.split(", ")]

    @F.pandas_udf(f"struct<{', '.join(f'{f.split()[0]}:{f.split()[1]}' for f in schema.split(', '))}>")
    def run(replies: pd.Series) -> pd.DataFrame:
        rows = [parse(r) or (None,) * len(names) for r in replies]
        return pd.DataFrame(rows, columns=names, dtype=object)

    return run


def judged_pairs(pairs: DataFrame, client: Client, cache: Cache = None) -> DataFrame:
    """Adds ``is_duplicate`` to pairs with ``left_question`` and ``right_question``."""
    prompt = F.concat_ws("\n", F.lit("Do the two questions ask for the same? End with 'Decision: YES' or 'Decision: NO'."), F.concat(F.lit("A: "), col("left_question")), F.concat(F.lit("B: "), col("right_question")))
    return ask(pairs, prompt, client, cache).withColumn("is_duplicate", F.contains(F.upper(F.coalesce("reply", F.lit(""))), F.lit("DECISION: YES")))


def parse_label(reply: str | None, labels: dict[str, list[str]]) -> tuple[str | None, str | None]:
    """(label, tag) of a reply in JSON, possibly within text; a valid tag corrects a wrong label."""
    label = tag = None
    for m in re.finditer(r"\{[^{}]*\}", reply or ""):
        try:
            got = json.loads(m.group())
        except ValueError:
            continue
        if "label" in got and "tag" in got:
            label, tag = str(got["label"]).lower(), str(got["tag"]).lower()
            break
    if tag is None:
        return None, None
    if tag in labels.get(label, ()):
        return label, tag
    owner = next((x for x, tags in labels.items() if tag in tags), None)
    return (owner, tag) if owner else (None, None)


def fit_content(question: Column, answer: Column, separator: str, most: int, marker: str = "\n[TRUNCATED]") -> Column:
    """Question, separator and answer within a budget of characters; the answer gives way first."""
    if most <= 0:
        return F.concat(question, F.lit(separator), answer)
    budget = max(0, most - len(separator) - 1 - len(marker))
    full = F.concat(question, F.lit(separator), answer)
    left = F.greatest(F.lit(0), F.lit(budget) - F.length(question))
    cut_answer = F.concat(question, F.lit(separator), F.substring(answer, F.lit(1), left), F.lit(marker))
    cut_question = F.concat(F.substring(question, F.lit(1), F.lit(budget)), F.lit(marker), F.lit(separator))
    return F.when(F.length(full) + 1 <= most, full).when(left > 0, cut_answer).otherwise(cut_question)


@processor("llm_classifier")
def llm_classifier(df: DataFrame, client: Client | None = None, labels: dict[str, list[str]] | None = None, label_actions: dict[str, str] | None = None, prefix: str = "", separator: str = "\nAnswer: ", target_phase: str = "", max_content_chars: int = 8000, max_retries: int = 3, cache_dir: str = "") -> DataFrame:
    """Labels the rows of one phase; a label's action becomes the phase, its tag the filter tag. Failures leave rows."""
    if client is None or not labels:
        return df
    actions = label_actions or {}

    parsed = parsing(lambda reply: parse_label(reply, labels), "label string, tag string")
    mine = df.where(col("training_phase") == target_phase)
    prompt = F.concat(F.lit(prefix), fit_content(col("question"), col("raw_dataset_answer"), separator, max_content_chars))
    got = ask(mine, prompt, client, cache_dir, max_retries).withColumn("_l", parsed("reply"))
    act = F.coalesce(*(F.when(F.col("_l.label") == k, F.lit(v)) for k, v in actions.items()), F.col("_l.label"))
    move = F.col("_l.tag").isNotNull() & ~act.isin("keep", "posttrain")
    state = F.when(F.col("_l.tag").isNull(), "error").when(move, "routed").otherwise("kept")
    out = with_event(got, event("clean", "llm_classifier", state, F.coalesce("_l.tag", F.lit("api_error"))))
    out = out.withColumns({"training_phase": F.when(move, act).otherwise(col("training_phase")), "filter_tag": F.when(move, F.col("_l.tag")).otherwise(col("filter_tag"))})
    rest = df.where(col("training_phase") != target_phase)
    if dict(out.dtypes).get("trace", "") != dict(rest.dtypes).get("trace", ""):
        from siltworks import schema

        rest = schema.decode(rest, "trace")
    return out.select(*df.columns).unionByName(rest.select(*df.columns))


def embed(df: DataFrame, column: str, embedder: Callable[[list[str]], list[list[float]]], batch: int = 256) -> DataFrame:
    """Adds ``embedding``; ``embedder`` maps a list of texts to as many vectors."""
    fields = df.schema

    def run(batches):
        for b in batches:
            texts = [t or "" for t in b.column(column).to_pylist()]
            vectors: list = []
            for i in range(0, len(texts), batch):
                got = embedder(texts[i : i + batch])
                if len(got) != len(texts[i : i + batch]):
                    raise ValueError("as many vectors as texts are needed")
                vectors += got
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(vectors, pa.list_(pa.float32()))], [*b.schema.names, "embedding"])

    return df.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", embedding array<float>")
