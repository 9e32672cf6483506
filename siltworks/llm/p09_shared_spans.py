"""Problem 9: long passages that stand word for word in several documents.

Method: prefix-partitioned suffix trees. Of every text only *anchored* suffixes are taken: the
places where the hash of the next ``K`` characters is the least of ``LENGTH - K + 1``
neighbouring ones. A span of ``LENGTH`` characters holds such a window, so two texts that share
a span share an anchored suffix with the same first ``K`` characters; nothing is lost.

1. Suffixes are partitioned by that prefix. Prefixes that only one text has are dropped by a
   map-side aggregate before any text is moved.
2. A group of at most ``GROUP`` suffixes builds its tree from the sorted right contexts (suffix
   array and common prefix lengths). A node of depth r, together with an equal left context of
   ``LENGTH - r`` characters, is a maximal repeat deep enough; its leaves are a clique of documents.
3. The prefixes of a larger group are lengthened until its parts fit. Known of a group are the
   ``a`` characters before and the ``b`` characters after the place that all share (at first 0 and
   ``K``). A span goes on to the right to some length L at least, or else it begins the more to the
   left: the group is split once by the longer right prefix (a, L) and once by the longer left one
   (LENGTH - L + 1, b), with L half way. When a + b reaches ``LENGTH``, a group is a clique as it
   stands, so a passage in a third of all documents is counted, not compared, to be found.
4. Pairs are made from cliques in blocks of ``BLOCK`` members. A passage in n different texts has
   about n^2 / 2 pairs, as ``p9_found`` is defined; ``p9_cliques`` gives the n members instead.

Copies of a whole text are one class with the smallest ``doc_id``; classes of up to ``COPIES``
members are expanded to pairs at the end, larger ones pair each copy with the class's
representative (membership), which loses no link between different texts.

Texts are told apart by 128 bits of hash (copies, lengthened prefixes); trees compare the texts.

Defined results: null, empty and short texts share nothing; a repeated row (same ``doc_id`` and
text) counts once; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltworks import runtime
from siltworks.functions.kernel import Rolling, blocks, codes, mix, signed, sliding_max, sliding_min

LENGTH = 300
GROUP = 20_000
BLOCK = 200
COPIES = 64
SALTS = 16


def anchors(text: str, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the anchored suffixes of one text."""
    return _anchors(codes(text), length)


def _anchors(code: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    k = length // 2
    w = length - k + 1
    if len(code) < length:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    h = mix(Rolling(mix(code, 3)).grams(k), 4)
    least = sliding_min(h, w)
    # the most of the minima of all windows that hold a place equals its hash where it is chosen
    edge = np.zeros(w - 1, dtype=np.uint64)
    most = sliding_max(np.concatenate([edge, least, edge]), w)
    at = np.flatnonzero(most == h)
    same_before = np.zeros(len(at), dtype=bool)
    same_after = np.zeros(len(at), dtype=bool)
    if len(at) > 1:
        run = (np.diff(at) == 1) & (h[at[1:]] == h[at[:-1]])
        same_before[1:], same_after[:-1] = run, run
    at = at[~(same_before & same_after)]  # of a run of equal characters, the ends do
    return at, h[at]


def _scan(length: int):
    def run(batches):
        for b in batches:
            ids, texts = b.column(0).to_numpy(zero_copy_only=False), b.column(1)
            for at, block in blocks(texts.to_pylist()):
                doc, cls, pos, key = [], [], [], []
                for i, t in enumerate(block):
                    if t is None or len(t) < length:
                        continue
                    p, h = anchors(t, length)
                    doc.append(np.full(len(p), ids[at + i], dtype=np.int64))
                    c = hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=8).digest()
                    cls.append(np.full(len(p), int.from_bytes(c, "little", signed=True), dtype=np.int64))
                    pos.append(p.astype(np.int32))
                    key.append(signed(h))
                if doc:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (key, cls, doc, pos)], ["key", "cls", "doc", "pos"])

    return run


def _contexts(length: int):
    k = length // 2

    def run(batches):
        for b in batches:
            doc, key, pos, left, right = [], [], [], [], []
            for d, t, places, keys in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                for p, q in sorted(zip(places, keys, strict=True)):
                    doc.append(d)
                    key.append(q)
                    pos.append(p)
                    left.append(t[max(0, p - (length - k)) : p])
                    right.append(t[p : p + length])
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(key, pa.int64()), pa.array(pos, pa.int32()), pa.array(left, pa.string()), pa.array(right, pa.string())], ["doc", "key", "pos", "left", "right"])

    return run


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        m = (lo + hi) // 2
        lo, hi = (m, hi) if a[:m] == b[:m] else (lo, m)
    return lo


def tree_cliques(members: list[tuple[int, int, str, str]], length: int, least: int = 0) -> list[list[tuple[int, int, int]]]:
    """Cliques of (doc, start, end) from the suffix tree of one prefix group.

    members: (doc, pos, left context, right context), all with the same first ``least`` characters.
    """
    k = least or length // 2
    members = sorted(members, key=lambda m: m[3])
    lcp = [_common(a[3], b[3]) for a, b in zip(members, members[1:], strict=False)]
    out, seen = [], set()
    # internal nodes of the tree: intervals of the sorted suffixes, by a stack over the common prefixes
    stack: list[tuple[int, int]] = []
    nodes: list[tuple[int, int, int]] = []
    for i, depth in enumerate([*lcp, -1]):
        begin = i
        while stack and stack[-1][0] > depth:
            d, begin = stack.pop()
            nodes.append((d, begin, i))
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, begin))
    for depth, a, b in nodes:
        if depth < k:
            continue
        need = max(0, length - depth)
        by: dict[str, list[tuple[str, int, int]]] = {}
        for doc, pos, left, _ in members[a : b + 1]:
            if len(left) >= need:
                by.setdefault(left[len(left) - need :], []).append((left[::-1], doc, pos))
        for same in by.values():
            if len({d for _, d, _ in same}) < 2:
                continue
            # sorted by what stands before, read backwards, the longest common stretch is with a neighbour
            same.sort()
            more = [0, *(_common(x[0], y[0]) for x, y in zip(same, same[1:], strict=False)), 0]
            clique = [(d, p - max(more[i], more[i + 1]), p + depth) for i, (_, d, p) in enumerate(same)]
            if (tag := tuple(sorted(clique))) not in seen:
                seen.add(tag)
                out.append(list(tag))
    return out


_CLIQUE = "clique string, doc long, start int, end int"


def _trees(length: int):
    import pandas as pd

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        found = tree_cliques(list(zip(pdf["doc"].tolist(), pdf["pos"].tolist(), pdf["left"], pdf["right"], strict=True)), length, int(pdf["b"].iloc[0]))
        for n, clique in enumerate(found):
            tag = _digest(f"{key[0]}/{n}")
            rows += [(tag, d, s, e) for d, s, e in clique]
        return pd.DataFrame(rows, columns=["clique", "doc", "start", "end"])

    return run


def _digest(t: str) -> str:
    return hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


_SUFFIX = "key string, doc long, pos int, left string, right string, a int, b int"


def _lengthened(length: int):
    """Each suffix under two keys: one by a longer right prefix, one by a longer left one, as far as it reaches."""

    def run(batches):
        for batch in batches:
            rows = []
            for d, p, left, right, a, b in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                far = (b + length - a + 1) // 2  # b < far <= length - a
                for x, y in ((a, far), (length - far + 1, b)):
                    if len(left) >= x and len(right) >= y:
                        rows.append((f"{x}/{y}/" + _digest(left[len(left) - x :] + right[:y]), d, p, left, right, x, y))
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["key", "doc", "pos", "left", "right", "a", "b"])

    return run


def copies_of(docs: DataFrame) -> DataFrame:
    """``(doc, rep)`` for every document ``(doc, text)`` whose text has another copy with a smaller id."""
    d = docs.select("doc", F.unhex(F.md5("text")).alias("m"), F.length("text").alias("n")).distinct()
    rep = d.groupBy("m", "n").agg(F.min("doc").alias("rep"), F.max("doc").alias("last")).where("rep <> last").select("m", "n", "rep")
    # salted: a text may have a third of all documents
    rep = rep.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return d.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int")).join(rep, ["m", "n", "salt"]).where("doc <> rep").select("doc", "rep")


def cliques(docs: DataFrame, length: int = LENGTH, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """(cliques, copies): clique members ``(clique, doc, start, end)`` over class representatives,
    and ``(doc, rep)`` for every document whose text has another copy with a smaller id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text")).where(F.col("doc").isNotNull() & (F.length("text") >= length))
    wide = runtime.fit_partitions(docs)
    anchored = runtime.materialize(wide.mapInArrow(_scan(length), "key long, cls long, doc long, pos int"), "p09-anchors")
    # copies of a text have the same anchors: combined map-side, each class stands once under its smallest id
    once = anchored.groupBy("key", "cls", "pos").agg(F.min("doc").alias("doc"))
    # prefixes of one class only go before any text is moved
    shared = anchored.groupBy("key").agg(F.min("cls").alias("low"), F.max("cls").alias("high")).where("low <> high").select("key")
    kept = once.join(shared, "key", "left_semi")
    places = kept.groupBy("doc").agg(F.collect_set(F.struct("pos", "key")).alias("s")).select("doc", F.col("s.pos").alias("pos"), F.col("s.key").alias("keys"))
    suffixes = docs.join(places, "doc").select("doc", "text", "pos", "keys").mapInArrow(_contexts(length), "doc long, key long, pos int, left string, right string").dropDuplicates(["doc", "key", "pos"])
    suffixes = runtime.materialize(suffixes.select(F.col("key").cast("string").alias("key"), "doc", "pos", "left", "right", F.lit(0).alias("a"), F.lit(length // 2).alias("b")), "p09-suffixes")
    used, found = [anchored, suffixes], []
    while True:
        size = suffixes.groupBy("key").agg(F.count("*").alias("n"), F.min("doc").alias("low"), F.max("doc").alias("high")).where("low <> high")
        size = runtime.materialize(size.select("key", "n"), "p09-sizes")
        used.append(size)
        whole = F.col("a") + F.col("b") >= length
        trees = suffixes.where(~whole).join(size.where(F.col("n") <= group).select("key"), "key", "left_semi")
        found.append(trees.groupBy("key").applyInPandas(_trees(length), _CLIQUE))
        found.append(suffixes.where(whole).join(size.select("key"), "key", "left_semi").select(F.col("key").alias("clique"), "doc", (F.col("pos") - F.col("a")).alias("start"), (F.col("pos") + F.col("b")).alias("end")))
        hot = size.where(F.col("n") > group).select("key")
        if not hot.take(1):
            break
        suffixes = suffixes.where(~whole).join(hot, "key", "left_semi").select("doc", "pos", "left", "right", "a", "b").mapInArrow(_lengthened(length), _SUFFIX)
        suffixes = runtime.materialize(suffixes, "p09-suffixes")
        used.append(suffixes)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    out = runtime.materialize(out.distinct(), "p09-cliques")
    runtime.discard(*used)
    return out, copies_of(docs)


def pairs_of(members: DataFrame, group: str, item: str, block: int = BLOCK) -> DataFrame:
    """Distinct pairs ``(a, b)``, a < b, of the items of each group, made block against block.

    A group of n items becomes (n / block)^2 / 2 units of work, each with its own key, so a hot
    group is spread over the cluster.
    """
    m = members.select(F.col(group).alias("g"), F.col(item).alias("x")).distinct()
    n = m.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").withColumn("parts", F.ceil(F.col("n") / block).cast("int"))
    m = m.join(n, "g").withColumn("p", F.pmod(F.xxhash64("x", F.lit(7)), F.col("parts")).cast("int"))
    left = m.select("g", F.col("x").alias("a"), F.col("p").alias("i"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("j"))
    right = m.select("g", F.col("x").alias("b"), F.col("p").alias("j"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"))
    return left.join(right, ["g", "i", "j"]).where("a < b").select("a", "b").distinct()


def found(docs: DataFrame, length: int = LENGTH, group: int = GROUP, copies_max: int = COPIES) -> DataFrame:
    """``(doc_id_a, doc_id_b)``: pairs of documents that share a span of ``length`` characters."""
    members, copies = cliques(docs, length, group)
    copies = runtime.materialize(copies, "p09-copies")
    between = pairs_of(members, "clique", "doc")
    n = copies.groupBy("rep").agg(F.count("*").alias("n"))
    everyone = copies.unionByName(copies.select(F.col("rep").alias("doc"), "rep").distinct()).join(n, "rep")
    small = everyone.where(F.col("n") < copies_max)
    inside = pairs_of(small, "rep", "doc").unionByName(everyone.where((F.col("n") >= copies_max) & (F.col("doc") != F.col("rep"))).select(F.least("rep", "doc").alias("a"), F.greatest("rep", "doc").alias("b")))
    # links between different texts hold for their copies too, as far as classes are expanded
    wide = small.select("rep", "doc")
    for side in ("a", "b"):
        between = between.join(wide.select(F.col("rep").alias(side), F.col("doc").alias("to")), side, "left").withColumn(side, F.coalesce("to", side)).drop("to")
    return between.unionByName(inside).select(F.least("a", "b").alias("doc_id_a"), F.greatest("a", "b").alias("doc_id_b")).distinct()


def shared(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(doc_id, shared_chars, n_chars, share)``: how much of each distinct text stands elsewhere.

    Documents that are copies as a whole are shared entirely; the rest have the union of their spans.
    """
    members, copies = cliques(docs, length)
    copies = runtime.materialize(copies, "p09-copies")
    whole = copies.select("doc").unionByName(copies.select(F.col("rep").alias("doc"))).distinct().withColumn("whole", F.lit(True))
    w = Window.partitionBy("doc").orderBy("start", "end")
    spans = members.select("doc", "start", "end").distinct().withColumn("reach", F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    part = spans.withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce("reach", "start")))).groupBy("doc").agg(F.sum("new").alias("part"))
    size = docs.select(F.col("doc_id").cast("long").alias("doc"), F.length("text").alias("n_chars")).where("doc is not null").groupBy("doc").agg(F.max("n_chars").alias("n_chars"))
    out = size.join(part, "doc", "left").join(whole, "doc", "left")
    return out.select(F.col("doc").alias("doc_id"), F.when(F.col("whole"), F.col("n_chars")).otherwise(F.coalesce("part", F.lit(0))).cast("long").alias("shared_chars"), F.coalesce("n_chars", F.lit(0)).cast("long").alias("n_chars")).withColumn("share", F.when(F.col("n_chars") > 0, F.col("shared_chars") / F.col("n_chars")).otherwise(F.lit(0.0)))


def members(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(passage, doc_id, texts)``: each maximal passage that several texts share, with its documents; copies
    of a text come under the smallest ``doc_id``. ``texts`` is the number of different texts."""
    found, copies = cliques(docs, length)
    m = found.select(F.col("clique").alias("passage"), F.col("doc").alias("doc_id")).distinct()
    size = m.groupBy("passage").agg(F.count("*").alias("texts"))
    rep = copies.groupBy(F.col("rep").alias("doc_id")).agg(F.first("rep").alias("passage")).select(F.concat(F.lit("copies/"), "passage").alias("passage"), "doc_id", F.lit(1).cast("long").alias("texts"))
    again = copies.select(F.concat(F.lit("copies/"), "rep").alias("passage"), F.col("doc").alias("doc_id"), F.lit(1).cast("long").alias("texts"))
    return m.join(size, "passage").unionByName(rep).unionByName(again)


QUERIES = {
    "p9_found": lambda spark, d: found(runtime.table(spark, d, "documents")),
    "p9_shared": lambda spark, d: shared(runtime.table(spark, d, "documents")),
    "p9_cliques": lambda spark, d: members(runtime.table(spark, d, "documents")),
}
_SQL = """WITH d AS MATERIALIZED (SELECT DISTINCT doc_id, text FROM documents WHERE doc_id IS NOT NULL AND length(text) >= 300),
c AS (SELECT text, min(doc_id) AS rep FROM d GROUP BY 1),
g AS MATERIALIZED (SELECT DISTINCT rep, md5(substring(text, k, 300)) AS h FROM c, unnest(range(1, length(text) - 298)) u(k)),
p AS (SELECT DISTINCT a.rep AS l, b.rep AS r FROM g a JOIN g b ON a.h = b.h AND a.rep < b.rep),
m AS (SELECT d.doc_id, c.rep FROM d JOIN c ON d.text = c.text)
SELECT DISTINCT least(x.doc_id, y.doc_id) AS doc_id_a, greatest(x.doc_id, y.doc_id) AS doc_id_b FROM (SELECT l, r FROM p UNION ALL SELECT rep, rep FROM c) q JOIN m x ON x.rep = q.l JOIN m y ON y.rep = q.r WHERE x.doc_id <> y.doc_id"""
#: Every place whose next 300 characters stand in another text, and the characters they cover.
_SHARED = """WITH d AS MATERIALIZED (SELECT DISTINCT doc_id, text FROM documents WHERE doc_id IS NOT NULL), c AS (SELECT text, min(doc_id) AS rep, count(*) AS copies FROM d WHERE length(text) >= 300 GROUP BY 1),
g AS MATERIALIZED (SELECT rep, k, md5(substring(text, k, 300)) AS h FROM c, unnest(range(1, length(text) - 298)) u(k)), h AS (SELECT h FROM g GROUP BY 1 HAVING min(rep) <> max(rep)),
p AS (SELECT DISTINCT rep, k FROM g SEMI JOIN h USING (h)), s AS (SELECT rep, sum(n) AS part FROM (SELECT rep, least(300, coalesce(lead(k) OVER (PARTITION BY rep ORDER BY k) - k, 300)) AS n FROM p) GROUP BY 1)
SELECT doc_id, shared_chars, n_chars, CASE WHEN n_chars > 0 THEN shared_chars::DOUBLE / n_chars ELSE 0.0 END::DOUBLE AS share FROM (SELECT d.doc_id, (CASE WHEN c.copies > 1 THEN length(d.text) ELSE coalesce(s.part, 0) END)::BIGINT AS shared_chars, coalesce(length(d.text), 0)::BIGINT AS n_chars FROM d LEFT JOIN c ON c.text = d.text LEFT JOIN s ON s.rep = d.doc_id)"""
ORACLES = {"p9_found": _SQL, "p9_shared": _SHARED}
