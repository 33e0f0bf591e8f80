"""Similarity join of shingle sets by an R-tree over count vectors.

A document's shingles are hashed into GROUPS groups; the counts per group are a point, and the shingles
that two documents share are at most the sum over groups of the smaller count. The R-tree prunes pairs
of boxes by that bound, then pairs of points; what survives is verified on the whole sets.

How it runs: documents with equal sets are one class. A class is indexed under its BOTTOM smallest
shingle hashes. Two sets of similarity 0.8 share the smallest hash of their union with probability 0.8,
so a link misses all common keys with probability 0.2 ** BOTTOM at most, 4e-9, and a set with no more than
BOTTOM / 0.2 shingles cannot miss them. Under each key an R-tree join connects the points that pass the
bound (a forest, never all pairs), which gives coarse groups; within them links are verified exactly
(`links.verified`). Keys with over BLOCK classes are dealt as pairs of blocks.

Defined cases: a text without words, or null, has an empty set and links with nothing; one with fewer
than five words is one shingle; a null doc_id has no component; rows that repeat a doc_id are each
classed by their own text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeloom.llm import links
from treeloom.llm import textarrays as ta
from treeloom.operators import joins
from treeloom.session import materialize

SHINGLE = 5
GROUPS, COARSE = 256, 32
BOTTOM = 12
LEAF = 32
BLOCK = 4096
#: A class of this many ids at most is sent to all tasks; more are joined by a shuffle.
BROADCAST_IDS = 200_000
MOST, LEAST = 100, 80


def _sets(texts: pa.Array):
    """The shingle set of each row."""
    data, offsets = ta.buffers(texts)
    for a, b in ta.chunks(offsets):
        w = ta.words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], lower=True)
        for i in range(b - a):
            yield ta.shingles(w.hash[w.first[i]:w.first[i + 1]], SHINGLE)


def _described(batches):
    for batch in batches:
        n, key1, key2, bottom, vector = [], [], [], [], []
        for found in _sets(batch.column(1)):
            n.append(len(found))
            mixed = ta.mix(found + np.uint64(0x5851F42D4C957F2D))
            key1.append(int(mixed.sum(dtype=np.uint64).view(np.int64)))
            key2.append(int(np.bitwise_xor.reduce(mixed).view(np.int64)) if len(found) else 0)
            bottom.append(found[:BOTTOM].view(np.int64))
            counts = np.bincount((found & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)
            vector.append(counts.astype(np.uint8 if counts.max(initial=0) < 256 else np.uint32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(key1, pa.int64()), pa.array(key2, pa.int64()),
             pa.array(bottom, pa.list_(pa.int64())), pa.array(vector, pa.binary())],
            ["doc_id", "n", "key1", "key2", "bottom", "vector"])


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, n (shingles), key1 and key2 (equal for equal sets), bottom (the smallest hashes), vector (group counts)."""
    return ta.bounded(docs).select("doc_id", "text").mapInArrow(
        ta.released(_described), "doc_id bigint, n bigint, key1 bigint, key2 bigint, bottom array<bigint>, vector binary")


# The tree

def enough(overlap: np.ndarray, size_a, size_b) -> np.ndarray:
    """Whether sets of these sizes that share so many shingles are similar enough."""
    return MOST * overlap >= LEAST * (size_a + size_b - overlap)


class Node:
    """A box of points; a leaf has their rows."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, rows: np.ndarray):
        self.high, self.least, self.most = points[rows].max(0), sizes[rows].min(), sizes[rows].max()
        self.rows, self.parts = rows, []
        if len(rows) > LEAF:
            values = sizes[rows] if self.most > 1.25 * self.least else points[rows, np.argmax(points[rows].var(0))]
            order = rows[np.argsort(values, kind="stable")]
            half = len(order) // 2
            self.parts = [Node(points, sizes, order[:half]), Node(points, sizes, order[half:])]

    def near(self, other: Node) -> bool:
        shared = min(int(np.minimum(self.high, other.high).sum()), self.most, other.most)
        return bool(enough(shared, self.least, other.least))


def tree_join(vectors: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of rows that pass the bound and connect all that do, a forest."""
    coarse = vectors.reshape(len(vectors), GROUPS // COARSE, COARSE).sum(1, dtype=np.int32)
    union, out = links.Union(len(sizes)), []
    top = Node(coarse, sizes, np.arange(len(sizes)))
    stack = [(top, top)]
    while stack:
        a, b = stack.pop()
        if a is not b and not a.near(b):
            continue
        if a.parts or b.parts:
            if a is b:
                p, q = a.parts
                stack += [(p, q), (q, q), (p, p)]
            elif not b.parts or a.parts and len(a.rows) >= len(b.rows):
                stack += [(p, b) for p in a.parts]
            else:
                stack += [(a, p) for p in b.parts]
            continue
        own, other = ({union.root(int(i)) for i in x.rows} for x in (a, b))
        if len(own) == 1 and own == other:
            continue
        bound = np.minimum(coarse[a.rows][:, None], coarse[b.rows][None]).sum(2)
        i, j = np.nonzero(enough(bound, sizes[a.rows][:, None], sizes[b.rows][None]))
        i, j = a.rows[i], b.rows[j]
        new = i < j if a is b else np.ones(len(i), bool)
        i, j = i[new], j[new]
        good = enough(np.minimum(vectors[i], vectors[j]).sum(1, dtype=np.int64), sizes[i], sizes[j])
        for x, y in zip(i[good].tolist(), j[good].tolist(), strict=True):
            if union.join(x, y):
                out.append((x, y))
    return out


def _joined(batches):
    """Coarse links from batches (part, id, n, vector) sorted by part."""
    for batch in links.whole_runs(batches):
        ids, sizes = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        raw = batch.column(3).to_pylist()
        vectors = np.stack([np.frombuffer(v, np.uint8 if len(v) == GROUPS else np.uint32) for v in raw]).astype(np.int32)
        runs = np.array(links.runs(batch.column(0).to_numpy()))
        two = runs[runs[:, 1] - runs[:, 0] == 2, 0]
        good = two[enough(np.minimum(vectors[two], vectors[two + 1]).sum(1), sizes[two], sizes[two + 1])]
        u, v = [ids[good]], [ids[good + 1]]
        for a, b in runs[runs[:, 1] - runs[:, 0] > 2].tolist():
            found = tree_join(vectors[a:b], sizes[a:b])
            if found:
                i, j = zip(*found, strict=True)
                u.append(ids[a:b][list(i)])
                v.append(ids[a:b][list(j)])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], ["u", "v"])


def candidates(classes: DataFrame) -> DataFrame:
    """Coarse links (u, v) of classes (id, n, bottom, vector)."""
    keys = classes.select("id", F.explode("bottom").alias("key"))
    counts = keys.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    dealt = (
        keys.join(counts, "key")
        .withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .where("blocks = 1 or own <> other")
        .select("id", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("part")))
    rows = dealt.join(classes.select("id", "n", "vector"), "id").select("part", "id", "n", "vector")
    return rows.repartition("part").sortWithinPartitions("part").mapInArrow(ta.released(_joined), "u bigint, v bigint")


# The join

def _members(batches):
    """(part, id, set) from (part, id, key1, key2, text), without texts of another class."""
    for batch in batches:
        sets, keep = [], []
        key1, key2 = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        for i, found in enumerate(_sets(batch.column(4))):
            mixed = ta.mix(found + np.uint64(0x5851F42D4C957F2D))
            if len(found) and mixed.sum(dtype=np.uint64).view(np.int64) == key1[i] and np.bitwise_xor.reduce(mixed).view(np.int64) == key2[i]:
                sets.append(found.view(np.int64))
                keep.append(i)
        rows = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(1), pa.array(sets, pa.list_(pa.int64()))], ["part", "id", "set"])


def join(docs: DataFrame, name: str = "setjoin") -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reached by links) of each document (doc_id, text)."""
    described = materialize(describe(docs), f"{name}-described")
    classes = materialize(
        described.where("n > 0 and doc_id is not null").groupBy("key1", "key2", "n")
        .agg(F.min("doc_id").alias("id"), F.first("bottom").alias("bottom"), F.first("vector").alias("vector")), f"{name}-classes")
    coarse = links.components(candidates(classes), f"{name}-coarse")
    members = links.parts(coarse.select(F.col("component").alias("coarse"), F.col("node").alias("id"))).join(
        classes.select("id", "key1", "key2"), "id")
    if coarse.count() <= BROADCAST_IDS:
        members = F.broadcast(members)
    sets = docs.select(F.col("doc_id").alias("id"), "text").join(members, "id").select(
        "part", "id", "key1", "key2", "text").mapInArrow(ta.released(_members), "part bigint, id bigint, set array<bigint>")
    found = links.components(links.verified(sets), name)
    answer = classes.select("key1", "key2", "n", "id").join(
        found.select(F.col("node").alias("id"), "component"), "id", "left").select(
        "key1", "key2", "n", F.coalesce("component", "id").alias("component_id"))
    rows = joins.salted(described.select("doc_id", "n", "key1", "key2"), ["doc_id"])
    keys = ["key1", "key2", "n"]
    answered = joins.attach(rows, joins.questions(rows, keys).join(answer, keys), keys)
    return answered.select("doc_id", F.col("n").alias("n_shingles"), F.when(
        F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, name: str = "setjoin") -> DataFrame:
    """One document of each group: that whose doc_id is the component's. Rows without a doc_id stay."""
    kept = join(docs, name).where("component_id = doc_id").select("doc_id").distinct()
    # A doc_id that several rows carry stays whole if one of them is kept.
    return docs.join(kept, "doc_id", "left_semi").unionByName(docs.where("doc_id is null"))
