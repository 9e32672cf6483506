"""Problem 7: evaluation texts leaking into training text.

Method: size-partitioned MinHash containment search. Items are partitioned by the least run of
words that counts as a leak (``share`` of the item's words); a partition spans lengths within a
factor of ``SPREAD``. In a partition every stretch of that many words has a signature: the
least hash of its word shingles (five words, fewer for shorter runs). A document that contains a
long enough run of the item contains such a stretch whole, so the two signatures agree; slid
along the document this finds short items in long documents without loss. Candidates are
verified by exact containment: the longest unbroken run of shared shingles.

Items are a stated query set: they go to the executors in blocks of ``ITEMS`` (some 1 kB an item),
and every block is searched against all documents in one scan, without a shuffle of texts.

Defined results: null or wordless texts and items, and items without a ``uid``, match nothing; a
repeated document row counts once; an item that occurs with several texts counts by each.
"""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks import runtime
from siltworks.functions.kernel import Rolling, Words, blocks, mix, sliding_min

SHARE = 0.5
SHINGLE = 5
SPREAD = 1.15
ITEMS = 100_000
_BASE = 0xD6E8FEB86659FD93


class Partition(NamedTuple):
    """Items whose least runs are of similar length: their signatures, sorted, and who has each."""

    shingle: int
    width: int
    keys: np.ndarray
    first: np.ndarray
    owner: np.ndarray

    def owners(self, key: int) -> list[int]:
        k = int(np.searchsorted(self.keys, np.uint64(key)))
        return self.owner[self.first[k] : self.first[k + 1]].tolist()


class ContainmentIndex:
    """Signatures of the items of one block, by size partition."""

    def __init__(self, items: list[tuple[str, str]], share: float):
        w = Words([q for _, q in items])
        self.uids, self.texts = [u for u, _ in items], [q for _, q in items]
        self.hash = [w.hash[w.first[i] : w.first[i + 1]] for i in range(len(items))]
        self.need = [max(1, math.ceil(len(x) * share)) for x in self.hash]
        self.parts: list[Partition] = []
        by: dict[int, list[int]] = defaultdict(list)
        for i, n in enumerate(self.need):
            if len(self.hash[i]):
                by[n].append(i)
        sizes = sorted(by)
        while sizes:
            least = sizes[0]
            band = [s for s in sizes if s <= least * SPREAD]
            sizes = sizes[len(band) :]
            shingle = min(SHINGLE, least)
            mine = [(i, np.unique(signatures(self.hash[i], shingle, least - shingle + 1))) for s in band for i in by[s]]
            owner = np.repeat(np.array([i for i, _ in mine], dtype=np.int32), [len(k) for _, k in mine])
            keys = np.concatenate([k for _, k in mine])
            order = np.argsort(keys, kind="stable")
            unique, first = np.unique(keys[order], return_index=True)
            self.parts.append(Partition(shingle, least - shingle + 1, unique, np.append(first, len(keys)), owner[order]))

    def words(self, i: int) -> list[str]:
        return Words([self.texts[i]]).of(0)


def signatures(h: np.ndarray, shingle: int, width: int) -> np.ndarray:
    """The least shingle hash of every stretch of ``width`` shingles."""
    return sliding_min(mix(Rolling(h, _BASE).grams(shingle), 21), width)


def longest_run(doc: np.ndarray, item: np.ndarray, shingle: int) -> tuple[int, int, int]:
    """(words, place in doc, place in item) of the longest unbroken run of words in both."""
    a, b = Rolling(doc, _BASE).grams(shingle), Rolling(item, _BASE).grams(shingle)
    order = np.argsort(b, kind="stable")
    lo, hi = np.searchsorted(b[order], a, "left"), np.searchsorted(b[order], a, "right")
    n = hi - lo
    if not n.sum():
        return 0, 0, 0
    i = np.repeat(np.arange(len(a)), n)
    j = order[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    along = np.lexsort((i, i - j))
    i, j = i[along], j[along]
    new = np.ones(len(i), dtype=bool)
    new[1:] = (np.diff(i) != 1) | (np.diff(j) != 1)
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(i)))
    k = int(np.argmax(size))
    return int(size[k]) + shingle - 1, int(i[begin[k]]), int(j[begin[k]])


def _search(index: ContainmentIndex):
    def run(batches):
        for b in batches:
            ids = b.column(0).to_pylist()
            for at, block in blocks(b.column(1).to_pylist()):
                w = Words(block)
                pairs: set[tuple[int, int]] = set()
                for part in index.parts:
                    shingle, width, keys = part.shingle, part.width, part.keys
                    s = signatures(w.hash, shingle, width)
                    if not len(s):
                        continue
                    place = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]) | (w.doc[: len(s)] != np.roll(w.doc[: len(s)], 1)))
                    hit = keys[np.minimum(np.searchsorted(keys, s[place]), len(keys) - 1)] == s[place]
                    for p in place[hit].tolist():
                        # the stretch may reach into the next text: then its words belong to two candidates
                        for d in {int(w.doc[p]), int(w.doc[p + width + shingle - 2])}:
                            pairs.update((d, i) for i in part.owners(int(s[p])))
                doc, uid, run_words, item_words = [], [], [], []
                for d, i in sorted(pairs):
                    n, x, y = longest_run(w.hash[w.first[d] : w.first[d + 1]], index.hash[i], min(SHINGLE, index.need[i]))
                    if n >= index.need[i] and [w.word(w.first[d] + x + k) for k in range(n)] == index.words(i)[y : y + n]:
                        doc.append(ids[at + d])
                        uid.append(index.uids[i])
                        run_words.append(n)
                        item_words.append(len(index.hash[i]))
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(uid, pa.string()), pa.array(run_words, pa.int64()), pa.array(item_words, pa.int64())], ["doc_id", "uid", "run_words", "item_words"])

    return run


def leaks(docs: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """``(doc_id, uid, run_words, item_words)``: the longest leaked run of each document and item."""
    docs = runtime.fit_partitions(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null"))
    rows = items.select("uid", "question").where("uid is not null and question is not null").distinct().toLocalIterator()
    out = None
    while (block := [(r["uid"], r["question"]) for r in islice(rows, ITEMS)]) or out is None:
        part = docs.mapInArrow(_search(ContainmentIndex(block, share)), "doc_id long, uid string, run_words long, item_words long")
        out = part if out is None else out.unionByName(part)
    return out.groupBy("doc_id", "uid").agg(F.max("run_words").alias("run_words"), F.max("item_words").alias("item_words"))


def found(docs: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    return leaks(docs, items, share).select("doc_id", "uid")


QUERIES = {
    "p7_found": lambda spark, d: found(runtime.table(spark, d, "documents"), runtime.table(spark, d, "benchmark_questions")),
    "p7_leaks": lambda spark, d: leaks(runtime.table(spark, d, "documents"), runtime.table(spark, d, "benchmark_questions")),
}
_SQL = """WITH i AS (SELECT uid, w, ((len(w) + 1) // 2)::BIGINT AS need FROM (SELECT uid, regexp_extract_all(lower(question), '[\\p{L}\\p{N}]+') AS w FROM benchmark_questions WHERE uid IS NOT NULL AND question IS NOT NULL) WHERE len(w) > 0),
g AS MATERIALIZED (SELECT DISTINCT uid, need, unnest(list_transform(range(1, len(w) - need + 2), lambda k: array_to_string(w[k:k + need - 1], ' '))) AS run FROM i),
d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
n AS (SELECT DISTINCT need FROM i),
r AS (SELECT doc_id, need, unnest(list_transform(range(1, len(w) - need + 2), lambda k: array_to_string(w[k:k + need - 1], ' '))) AS run FROM d, n WHERE len(w) >= need)
SELECT DISTINCT doc_id, uid FROM r JOIN g USING (need, run)"""
#: The longest run of a pair: equal words on a diagonal, in islands of neighbours.
_LONGEST = f"""WITH i AS (SELECT DISTINCT uid, question, w FROM (SELECT uid, question, regexp_extract_all(lower(question), '[\\p{{L}}\\p{{N}}]+') AS w FROM benchmark_questions WHERE uid IS NOT NULL AND question IS NOT NULL) WHERE len(w) > 0),
d AS (SELECT DISTINCT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL), f AS MATERIALIZED ({_SQL}),
a AS (SELECT f.doc_id, f.uid, i.question, i.w, d.w AS dw FROM f JOIN i ON i.uid = f.uid JOIN d ON d.doc_id = f.doc_id),
x AS (SELECT doc_id, uid, question, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS j FROM a), y AS (SELECT doc_id, uid, question, unnest(dw) AS word, unnest(range(len(dw))) AS k FROM a),
m AS (SELECT x.doc_id, x.uid, x.question, n, k, k - j AS diagonal FROM x JOIN y USING (doc_id, uid, question, word)),
r AS (SELECT doc_id, uid, question, n, count(*) AS run FROM (SELECT *, k - row_number() OVER (PARTITION BY doc_id, uid, question, diagonal ORDER BY k) AS island FROM m) GROUP BY doc_id, uid, question, n, diagonal, island)
SELECT doc_id, uid, max(run) AS run_words, max(n)::BIGINT AS item_words FROM r WHERE run >= (n + 1) // 2 GROUP BY 1, 2"""
ORACLES = {"p7_found": _SQL, "p7_leaks": _LONGEST}
