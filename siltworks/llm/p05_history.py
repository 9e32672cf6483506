"""Problem 5: deduplicating new batches against all history.

Method: prefix-tree hash forest. A text's signature is ``TREES`` permutations of ``DEPTH`` MinHash
symbols of one byte; all symbols of a permutation are stored as one sortable integer, its *key*.
The forest is a folder of runs (``HashForest.open`` finds them again in a later session): a large
run and a small one for each later batch. A run is sorted by (tree, key) and cut into *blocks*, one
file each; its directory holds the first and last key of every block.

A batch is signed once and written as a run of its own. It is then located in the other runs by
range search: keys that agree in their first d symbols are one range of the sorted run, so the
directory says in which blocks a key has to be looked up, and only those are read (a batch with
fewer keys than there are blocks leaves the others unread). History is neither shuffled nor sorted
nor signed again. The search starts with whole keys. What is met is verified on the texts, and the
recall is measured: a text whose best match has similarity s was met at depth d with chance
p = 1 - (1 - s^d)^TREES, so every match found stands for 1/p matches (one more, just at
``SIMILARITY``, is always supposed). While the measured recall is under ``RECALL``, prefixes are
widened by a symbol, down to ``WIDEST`` (where the chance at exactly 0.8 is 0.9993), and only what
is new at that depth is verified.

More than ``RUNS`` small runs are merged among themselves, and with the large one once they have
half its texts; keys are kept, never computed again. ``repeats`` gives the forest all waiting
batches at once: one search answers them, each text against history and smaller batch numbers.

Whole copies are recognised by the text first, and history holds each different text once. Blocks
are cut by (key, id) at the quantiles of a sample of at most ``SAMPLE`` texts (for the layout only:
every text is indexed), so a key that a third of all texts share fills several blocks of usual
size, in the large run and in the small ones alike. Texts in prefixes with more than ``HOT``
entries are first compared with a few representatives; a text that matches one is done, so a
cluster is not compared pair by pair.

Texts are lower-cased, every character but letters, digits and underscore becomes a space, spaces
are collapsed and trimmed; the similarity is that of the sets of three-character substrings.

Defined results: null questions and questions without a letter or digit repeat nothing; texts
under three characters repeat only equal ones; rows of one batch don't count against each other;
rows with null or blank ``uid`` aren't reported but are history for later batches; rows without a
``batch_no`` are held against the canonical records only and enter no history; redelivered rows
count once; empty tables give an empty result.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks import runtime
from siltworks.functions.kernel import Rolling, blocks, codes, mix

TREES = 24
DEPTH = 8
WIDEST = 6
SIMILARITY = 0.8
RECALL = 0.9999
HOT = 2_000
RUNS = 6
GRAM = 3
SAMPLE = 20_000
SALTS = 16
#: ``since`` of a text that enters no history, and of one that is older than every batch.
NEVER, ALWAYS = -(2**63), -(2**63) + 1


def normal(column) -> F.Column:
    return F.trim(F.regexp_replace(F.lower(column.cast("string")), r"[^\p{L}\p{N}_]+", " "))


def chance(similarity, depth: int, trees: int = TREES):
    """That a text of the similarity is met at the depth; for numbers and columns."""
    return 1 - (1 - similarity**depth) ** trees


_MULTIPLY = (mix(np.arange(TREES * DEPTH), 31) | np.uint64(1)).astype(np.uint32) | np.uint32(1)
_ADD = (mix(np.arange(TREES * DEPTH), 32) >> np.uint64(32)).astype(np.uint32)
_SIGN = np.uint64(1 << 63)


def keys_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(keys: texts x trees, in the order of signed integers; distinct substrings of each text)."""
    code = codes("\n".join(texts))
    length = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    first = np.cumsum(length + 1) - length - 1
    n = length - (GRAM - 1)
    at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
    h = mix(Rolling(mix(code, 33)).grams(GRAM), 34)[at]
    own = np.repeat(np.arange(len(texts)), n)
    key = (h >> np.uint64(20)) | (own.astype(np.uint64) << np.uint64(44))  # sizes to within collisions of 44 bits
    key = np.unique(key)
    own = (key >> np.uint64(44)).astype(np.int64)
    small = mix(key & np.uint64((1 << 44) - 1), 35).astype(np.uint32)
    starts = np.searchsorted(own, np.arange(len(texts)))
    size = np.diff(np.append(starts, len(own)))
    out = np.zeros((len(texts), TREES), dtype=np.uint64)
    for t in range(TREES):
        for k in range(DEPTH):
            i = t * DEPTH + k
            low = np.minimum.reduceat(small * _MULTIPLY[i] + _ADD[i], starts)
            out[:, t] = (out[:, t] << np.uint64(8)) | (mix(low, 36) >> np.uint64(56))
    return (out ^ _SIGN).view(np.int64), size


class Layout(NamedTuple):
    """Where blocks begin: for each tree the sorted (key, id) that end its blocks but the last."""

    per_tree: int
    keys: list[np.ndarray]
    ids: list[np.ndarray]
    labels: np.ndarray

    def block(self, tree: int, key: np.ndarray, tid: np.ndarray) -> np.ndarray:
        k, ids = self.keys[tree], self.ids[tree]
        at = np.searchsorted(k, key, "left")
        tie = np.flatnonzero((at < len(k)) & (k[np.minimum(at, len(k) - 1)] == key)) if len(k) else ()
        for x in np.unique(key[tie]) if len(tie) else ():
            rows = tie[key[tie] == x]
            lo, hi = np.searchsorted(k, x, "left"), np.searchsorted(k, x, "right")
            at[rows] = lo + np.searchsorted(ids[lo:hi], tid[rows], "right")
        return self.labels[tree * self.per_tree + at]


def labels(n: int) -> np.ndarray:
    """n numbers of which the i-th hashes to bucket i, so that every block is a bucket of its own."""
    found = np.full(n, -1, dtype=np.int64)
    tried, step = 0, 8 * n + 64
    while (found < 0).any():
        x = np.arange(tried, tried + step, dtype=np.uint32)
        with np.errstate(over="ignore"):  # Spark's hash of an int: murmur3 with seed 42
            k = x * np.uint32(0xCC9E2D51)
            k = ((k << np.uint32(15)) | (k >> np.uint32(17))) * np.uint32(0x1B873593)
            h = np.uint32(42) ^ k
            h = ((h << np.uint32(13)) | (h >> np.uint32(19))) * np.uint32(5) + np.uint32(0xE6546B64)
            h ^= np.uint32(4)
            h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
            h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
            h ^= h >> np.uint32(16)
        bucket = h.view(np.int32).astype(np.int64) % n
        found[bucket[::-1]] = x[::-1].astype(np.int64)
        tried += step
    return found.astype(np.int32)


def _layout(per_tree: int, buckets: np.ndarray, sample: pa.Table | None = None) -> Layout:
    """Blocks of even size by the keys ``(tree, key, tid)`` of a sample."""
    keys, ids = [np.zeros(0, dtype=np.int64)] * TREES, [np.zeros(0, dtype=np.int64)] * TREES
    if sample is not None and sample.num_rows and per_tree > 1:
        tree, key, tid = (sample.column(c).to_numpy() for c in ("tree", "key", "tid"))
        for t in range(TREES):
            mine = np.flatnonzero(tree == t)
            cut = mine[np.lexsort((tid[mine], key[mine]))][np.arange(1, per_tree) * len(mine) // per_tree]
            keys[t], ids[t] = key[cut], tid[cut]
    return Layout(per_tree, keys, ids, buckets)


_TEXT = "tid long, text string, since long"
_KEY = "block int, tree int, key long, tid long, n int, since long"
_NAMES = ["block", "tree", "key", "tid", "n", "since"]


def _signed(layout: Layout):
    def run(batches):
        for b in batches:
            ids, since = b.column(0).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
            for at, block in blocks(b.column(1).to_pylist(), 500_000):
                k, size = keys_of(block)
                tid, own = ids[at : at + len(block)], since[at : at + len(block)]
                place = np.concatenate([layout.block(t, k[:, t], tid) for t in range(TREES)])
                yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(np.repeat(np.arange(TREES), len(tid)).astype(np.int32)), pa.array(k.T.ravel()), pa.array(np.tile(tid, TREES)), pa.array(np.tile(np.minimum(size, 2**31 - 1), TREES).astype(np.int32)), pa.array(np.tile(own, TREES))], _NAMES)

    return run


def _replaced(layout: Layout):
    """Stored keys into the blocks of another run."""

    def run(batches):
        for b in batches:
            tree, key, tid = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            place = np.zeros(len(tree), dtype=np.int32)
            for t in np.unique(tree):
                mine = tree == t
                place[mine] = layout.block(int(t), key[mine], tid[mine])
            yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), *b.columns[1:]], _NAMES)

    return run


def grams(text: str) -> set[str]:
    return {text[i : i + GRAM] for i in range(len(text) - GRAM + 1)}


def similarity(x: set[str], y: set[str]) -> float:
    both = len(x & y)
    return both / (len(x) + len(y) - both) if both else 0.0


def similar(a: str, b: str, threshold: float = SIMILARITY) -> bool:
    """Whether two normal texts repeat each other."""
    return bool(a) and (a == b or similarity(grams(a), grams(b)) >= threshold - 1e-12)


def _verify(threshold: float):
    def run(batches):
        known: dict[str, set[str]] = {}
        for b in batches:
            out = []
            for tid, since, mine, theirs in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                x = known.get(mine)
                if x is None:
                    if len(known) > 2_000:
                        known.clear()
                    x = known[mine] = grams(mine)
                s = 1.0 if mine == theirs else similarity(x, grams(theirs))
                if s >= threshold - 1e-12:
                    out.append((tid, since, mine, s))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.float64()))], ["tid", "since", "text", "s"])

    return run


class Run(NamedTuple):
    """Tables of one run. ``settled``: its texts are history whatever their batch."""

    name: str
    texts: DataFrame
    keys: DataFrame
    directory: DataFrame
    hot: DataFrame
    has_hot: bool
    rows: int
    blocks: int
    settled: bool = True


class HashForest:
    """A persisted index of all accepted texts. ``accept`` asks for batches and takes them in."""

    def __init__(self, spark: SparkSession, path: str | None = None, similarity: float = SIMILARITY, recall: float = RECALL, hot: int = HOT):
        self.spark, self.similarity, self.recall, self.hot_size = spark, similarity, recall, hot
        self.path = (path or runtime.scratch(spark, "p05-forest")).rstrip("/")
        self.runs: list[Run] = []
        self.met_at: list[tuple[int, float]] = []  # (depth, measured recall) of the last search
        self.blocks_read: list[tuple[int, int]] = []  # (blocks read, blocks) of each run in it, at each depth

    # ---- the folder ----

    @classmethod
    def open(cls, spark: SparkSession, path: str, **options) -> HashForest:
        """The forest that an earlier session left in the folder."""
        f = cls(spark, path, **options)
        manifest = spark.read.text(f"{f.path}/manifest", wholetext=True).first()[0]
        f.runs = [f._run(r["name"], r["rows"], r["blocks"]) for r in json.loads(manifest)["runs"]]
        return f

    def save(self) -> None:
        runtime.write_text(self.spark, f"{self.path}/manifest/runs.json", json.dumps({"runs": [{"name": r.name, "rows": r.rows, "blocks": r.blocks} for r in self.runs]}))

    def drop(self) -> None:
        """Delete the forest and its folder."""
        for r in self.runs:
            self._forget(r)
        self.runs = []
        runtime.remove(self.spark, self.path)

    def _table(self, run: str, what: str) -> str:
        return "forest_" + hashlib.blake2b(f"{self.path}/{run}/{what}".encode(), digest_size=8).hexdigest()

    def _forget(self, r: Run) -> None:
        for what in ("texts", "keys"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(r.name, what)}")
        runtime.remove(self.spark, f"{self.path}/{r.name}")

    def _bucketed(self, run: str, what: str, columns: str, by: str, order: str, n: int) -> DataFrame:
        name = self._table(run, what)
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({order}) INTO {n} BUCKETS LOCATION '{self.path}/{run}/{what}'")
        return self.spark.table(name)

    def _run(self, name: str, rows: int, n: int, settled: bool = True) -> Run:
        at = f"{self.path}/{name}"
        hot = self.spark.read.parquet(f"{at}/hot")
        return Run(name, self._bucketed(name, "texts", _TEXT, "tid", "tid", n), self._bucketed(name, "keys", _KEY, "block", "tree, key", n), self.spark.read.parquet(f"{at}/directory"), hot, bool(hot.take(1)), rows, n, settled)

    # ---- runs ----

    def _write(self, texts: DataFrame, keys: DataFrame | None = None) -> Run:
        """A run of the texts ``(tid, text, since)``; ``keys`` are theirs where they are known already."""
        name = "run-" + uuid.uuid4().hex[:12]
        per_tree = max(1, -(-int(self.spark.conf.get("spark.sql.shuffle.partitions")) // TREES))
        n = per_tree * TREES
        self._save_bucketed(texts.select("tid", "text", "since").repartition(n, "tid"), name, "texts", "tid", ["tid"], n)
        texts = self._bucketed(name, "texts", _TEXT, "tid", "tid", n)
        rows = texts.count()
        layout = _layout(per_tree, labels(n))
        signed = texts.where(F.length("text") >= GRAM).select("tid", "text", "since")
        if per_tree > 1:
            share = F.pmod(F.xxhash64("tid", F.lit(37)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, SAMPLE / max(rows, 1)))
            # keys of about SAMPLE texts: some 12 MB
            some = signed.where(share).mapInArrow(_signed(_layout(1, labels(TREES))), _KEY).select("tree", "key", "tid").toArrow()
            layout = _layout(per_tree, labels(n), some)
        if keys is None:
            keys = signed.mapInArrow(_signed(layout), _KEY)
        else:
            keys = keys.select(*_NAMES).mapInArrow(_replaced(layout), _KEY)
        self._save_bucketed(keys.repartition(n, "block"), name, "keys", "block", ["tree", "key"], n)
        at = f"{self.path}/{name}"
        keys = self._bucketed(name, "keys", _KEY, "block", "tree, key", n)
        keys.groupBy("block", "tree").agg(F.min("key").alias("low_key"), F.max("key").alias("high_key")).coalesce(1).write.parquet(f"{at}/directory")  # at most a row a block and tree
        # prefixes with many entries: counted block by block; one that a block begins or ends with may go on in the next
        wide = lambda c: F.shiftright(c, 8 * (DEPTH - WIDEST))
        ends = self.spark.read.parquet(f"{at}/directory").select("block", "tree", wide("low_key").alias("low_prefix"), wide("high_key").alias("high_prefix"))
        part = keys.groupBy("block", "tree", wide("key").alias("prefix")).agg(F.count("*").alias("n"), F.min("tid").alias("low"), F.max("tid").alias("high"), F.min(F.struct("since", "tid")).alias("first"))
        part = part.join(F.broadcast(ends), ["block", "tree"]).where((F.col("n") > self.hot_size) | F.col("prefix").isin(F.col("low_prefix"), F.col("high_prefix")))
        hot = part.groupBy("tree", "prefix").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("first").alias("first")).where(F.col("n") > self.hot_size)
        hot.select("tree", "prefix", "low", "high", F.col("first.tid").alias("first"), F.col("first.since").alias("since")).coalesce(1).write.parquet(f"{at}/hot")
        return self._run(name, rows, n, False)

    def _save_bucketed(self, df: DataFrame, run: str, what: str, by: str, order: list[str], n: int) -> None:
        name = self._table(run, what)
        df.write.format("parquet").bucketBy(n, by).sortBy(*order).option("path", f"{self.path}/{run}/{what}").saveAsTable(name)

    def build(self, questions: DataFrame, column: str = "question") -> HashForest:
        """The large run from every different text of ``column``."""
        t = questions.select(normal(F.col(column)).alias("text")).where("text <> ''").select(F.xxhash64("text").alias("tid"), "text").distinct()
        self.runs.append(self._write(t.withColumn("since", F.lit(ALWAYS)))._replace(settled=True))
        self.save()
        return self

    # ---- search ----

    def _met(self, keys: DataFrame, r: Run, depth: int, few: bool) -> DataFrame:
        """``(tid, since, other)``: entries of the run that agree with a key in ``depth`` symbols and, unless
        that is all, in no more; of a size that can be similar; and of a smaller batch in an unsettled run."""
        bits = 8 * (DEPTH - depth)
        low = F.shiftleft(F.shiftright("key", bits), bits)
        d = r.directory.withColumnRenamed("tree", "d_tree")
        # a row a block and tree
        q = keys.join(F.broadcast(d), (F.col("tree") == F.col("d_tree")) & (F.col("low_key") <= low + F.lit((1 << bits) - 1)) & (F.col("high_key") >= low)).select("block", "tree", F.shiftright("key", bits).alias("prefix"), F.col("key").alias("mine"), "tid", "since", F.col("n").alias("size"))
        theirs = r.keys.where(F.col("since") > NEVER).select("block", "tree", F.shiftright("key", bits).alias("prefix"), "key", F.col("tid").alias("other"), "n", F.col("since").alias("other_since"))
        if few:  # fewer keys than blocks: name the blocks, so that the others aren't read
            touched = [x[0] for x in q.select("block").distinct().collect()]
            theirs = theirs.where(F.col("block").isin(touched))
            self.blocks_read.append((len(touched), r.blocks))
        near = F.least("n", "size") >= self.similarity * F.greatest("n", "size") - 1
        if depth < DEPTH:
            near = near & (F.shiftright("key", bits - 8) != F.shiftright("mine", bits - 8))
        if not r.settled:
            near = near & (F.col("other_since") < F.col("since"))
        return theirs.join(q.hint("shuffle_hash"), ["block", "tree", "prefix"]).where(near).select("tid", "since", "other")

    def _verified(self, pairs: DataFrame, mine: DataFrame, r: Run) -> DataFrame:
        """``(tid, since, text, s)`` of the candidates ``(tid, since, other)`` that are similar."""
        p = pairs.distinct().join(mine.select("tid", "text", "since"), ["tid", "since"])
        # the run's texts are streamed past a hash table of the candidates, bucket by bucket, unsorted
        p = r.texts.select(F.col("tid").alias("other"), F.col("text").alias("theirs")).distinct().join(p.hint("shuffle_hash"), "other")
        return p.select("tid", "since", "text", "theirs").mapInArrow(_verify(self.similarity), "tid long, since long, text string, s double")

    def accept(self, batch: DataFrame) -> DataFrame:
        """Take in the texts ``(tid, text, since)`` and give the ``(tid, since, text)`` of those that repeat
        accepted history or a text of the batch with a smaller ``since``.

        The same text may come with several ``since``; equal texts within the batch are left to the caller.
        Texts of ``since`` = ``NEVER`` are only searched for.
        """
        old = list(self.runs)
        new = self._write(batch)
        mine = new.texts
        same = [r.texts.where(F.col("since") > NEVER).select("tid", "text").join(mine.hint("shuffle_hash"), ["tid", "text"]).select("tid", "since", "text", F.lit(None).cast("double").alias("s")) for r in old]
        found = [runtime.materialize(_union(same), "p05-same")] if same else []
        done = lambda df: df.join(_union(found).select("tid", "since").distinct(), ["tid", "since"], "left_anti") if found else df
        runs = [*old, new]
        some = []
        for r in runs:
            if r.has_hot:
                # in hot prefixes, representatives first: what matches one isn't compared with the others
                q = done(new.keys).withColumn("prefix", F.shiftright("key", 8 * (DEPTH - WIDEST))).join(r.hot.withColumnRenamed("since", "first_since"), ["tree", "prefix"])
                if not r.settled:
                    q = q.where("first_since < since")
                some.append(self._verified(q.select("tid", "since", F.explode(F.array("low", "high", "first") if r.settled else F.array("first")).alias("other")), mine, r))
        if some:
            found.append(runtime.materialize(_union(some), "p05-represented"))
        self.met_at, self.blocks_read = [], []
        for depth in range(DEPTH, WIDEST - 1, -1):
            open_keys = done(new.keys)
            hits = []
            for r in runs:
                q = open_keys
                if not r.settled and r.has_hot:
                    # of a cluster that this batch brings, the texts of its first batch can't repeat one another
                    h = r.hot.select("tree", "prefix", F.col("since").alias("first_since"))
                    q = q.withColumn("prefix", F.shiftright("key", 8 * (DEPTH - WIDEST))).join(h, ["tree", "prefix"], "left").where("first_since is null or first_since < since").select(*_NAMES)
                hits.append(self._verified(self._met(q.drop("block"), r, depth, new.rows * TREES < r.blocks), mine, r))
            with runtime.setting(self.spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):  # blocks are joined where they lie
                found.append(runtime.materialize(_union(hits), "p05-found"))
            recall = self._recall(found, depth)
            self.met_at.append((depth, recall))
            if recall >= self.recall:
                break
        out = runtime.materialize(_union(found).select("tid", "since", "text").distinct(), "p05-repeats")
        runtime.discard(*found)
        self.runs = [*old, new._replace(settled=True)]
        self._compact()
        self.save()
        return out

    def _recall(self, found: list[DataFrame], depth: int) -> float:
        """The share of matches met so far, each weighted by its chance of being met; with one more at the threshold."""
        best = _union(found).where("s is not null").groupBy("tid", "since").agg(F.max("s").alias("s"))
        r = best.agg(F.count("*").alias("n"), F.sum(1 / (1 - F.pow(1 - F.pow("s", F.lit(depth)), F.lit(TREES)))).alias("all")).first()
        return (r["n"] + chance(self.similarity, depth)) / ((r["all"] or 0.0) + 1)

    def _compact(self) -> None:
        """Merge the small runs once there are more than ``RUNS``, with the large one once they have half its texts."""
        large, small = self.runs[0], self.runs[1:]
        if len(small) <= RUNS and sum(r.rows for r in small) <= large.rows / 2:
            return
        both = sum(r.rows for r in small) > large.rows / 2
        if len(small) == 1 and not both:
            return
        parts = self.runs if both else small
        known = lambda df, *columns: df.where(F.col("since") > NEVER).select(*columns, F.lit(ALWAYS).alias("since")).distinct()
        texts = known(_union([r.texts for r in parts]), "tid", "text")
        keys = known(_union([r.keys for r in parts]), F.lit(0).alias("block"), "tree", "key", "tid", "n")
        merged = self._write(texts, keys)._replace(settled=True)
        self.runs = [merged] if both else [large, merged]
        for r in parts:
            self._forget(r)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _incoming(incoming: DataFrame) -> DataFrame:
    t = incoming.select("uid", F.col("batch_no").cast("long").alias("batch_no"), normal(F.col("question")).alias("text")).where("text <> ''")
    return t.select("uid", "batch_no", F.xxhash64("text").alias("tid"), "text").distinct()


def repeats(records: DataFrame, incoming: DataFrame, hot: int = HOT, recall: float = RECALL, path: str | None = None) -> DataFrame:
    """``(batch_no, uid, text)`` of incoming rows that repeat an earlier question, all waiting batches at once.

    With a ``path`` the forest is opened there, or built there from ``records``, and stays; without,
    it is built in the shared folder and deleted.
    """
    spark = records.sparkSession
    rows = runtime.materialize(_incoming(incoming), "p05-incoming")
    # each text is asked for once, in its first batch; rows without a batch ask apart
    first = runtime.materialize(rows.groupBy("tid", "text").agg(F.min("batch_no").alias("first"), F.max(F.col("batch_no").isNull()).alias("none")), "p05-first")
    batch = first.where("first is not null").select("tid", "text", F.col("first").alias("since")).unionByName(first.where("none").select("tid", "text", F.lit(NEVER).alias("since")))
    if path and runtime.exists(spark, f"{path}/manifest"):
        forest = HashForest.open(spark, path, hot=hot, recall=recall)
    else:
        forest = HashForest(spark, path, hot=hot, recall=recall).build(records)
    try:
        hit = forest.accept(batch).withColumn("hit", F.lit(True))
        asked = first.join(hit.where(F.col("since") > NEVER).select("tid", "text", F.col("hit").alias("again")), ["tid", "text"], "left").join(hit.where(F.col("since") == NEVER).select("tid", "text", F.col("hit").alias("known")), ["tid", "text"], "left")
        # salted: very many rows may bring one text
        asked = asked.select("tid", "text", "first", "again", "known", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        mine = rows.withColumn("salt", F.pmod(F.xxhash64("uid", "batch_no"), F.lit(SALTS)).cast("int")).join(asked, ["tid", "text", "salt"])
        again = F.when(F.col("batch_no").isNull(), F.col("known")).otherwise((F.col("batch_no") > F.col("first")) | F.coalesce("again", F.lit(False)))
        return runtime.materialize(mine.where(F.coalesce(again, F.lit(False))).select(F.col("batch_no").cast("int").alias("batch_no"), "uid", "text"), "p05-answer")
    finally:
        if not path:
            forest.drop()


def found(records: DataFrame, incoming: DataFrame) -> DataFrame:
    return repeats(records, incoming).where("uid is not null and trim(uid) <> ''").select("uid").distinct()


def by_batch(records: DataFrame, incoming: DataFrame) -> DataFrame:
    """``(batch_no, repeating_uids, repeating_texts)``; null ids don't count."""
    return repeats(records, incoming).groupBy("batch_no").agg(F.countDistinct("uid").alias("repeating_uids"), F.countDistinct("text").alias("repeating_texts"))


def _of(f):
    return lambda spark, d: f(runtime.table(spark, d, "canonical_records"), runtime.table(spark, d, "incoming_records"))


QUERIES = {"p5_found": _of(found), "p5_batches": _of(by_batch)}
_NORMAL = "trim(regexp_replace(lower(question), '[^\\p{L}\\p{N}_]+', ' ', 'g'))"
_NEAR = f"""h AS MATERIALIZED (SELECT t, min(b) AS b FROM (SELECT {_NORMAL} AS t, -1 AS b FROM canonical_records UNION ALL SELECT {_NORMAL}, batch_no FROM incoming_records WHERE batch_no IS NOT NULL) WHERE t <> '' GROUP BY 1),
i AS MATERIALIZED (SELECT DISTINCT uid, batch_no, {_NORMAL} AS t, coalesce(batch_no, 0) AS b FROM incoming_records WHERE {_NORMAL} <> ''),
x AS MATERIALIZED (SELECT t, b, list_distinct(list_transform(range(1, length(t) - 1), lambda k: substring(t, k, 3))) AS g FROM h),
q AS (SELECT t, unnest(g) AS k, len(g) AS n FROM x WHERE t IN (SELECT t FROM i)), y AS (SELECT t, b, unnest(g) AS k, len(g) AS n FROM x),
p AS (SELECT q.t AS mine, y.t AS theirs, min(y.b) AS b FROM q JOIN y ON q.k = y.k AND y.n BETWEEN 0.8 * q.n AND q.n / 0.8 GROUP BY q.t, y.t, q.n, y.n HAVING count(*) >= 0.8 * (q.n + y.n - count(*)) - 1e-9),
a AS (SELECT i.* FROM i JOIN p ON p.mine = i.t AND p.b < i.b UNION SELECT i.* FROM i JOIN h ON h.t = i.t AND h.b < i.b)"""
ORACLES = {
    "p5_found": f"WITH {_NEAR} SELECT DISTINCT uid FROM a WHERE uid IS NOT NULL AND trim(uid) <> ''",
    "p5_batches": f"WITH {_NEAR} SELECT batch_no, count(DISTINCT uid) AS repeating_uids, count(DISTINCT t) AS repeating_texts FROM a GROUP BY 1",
}
