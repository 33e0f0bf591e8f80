"""Ranked lexical search: the best documents of every benchmark item by a BM25-like integer score.

Method: document FP-tree with branch and bound. Each document is reduced to its *restricted term vector*:
the terms it shares with the items' vocabulary, with their counts, in global frequency order (most
documents first). Vectors are inserted into a trie per shard, so documents that begin with the same
frequent terms share a path. Every trie node keeps, over the documents below it, the largest count of its
own term, the largest count of any deeper term and the smallest length term `m`. A depth-first search per
item (explicit stack) adds for each node an upper bound of every document below it: the item's path terms
at their largest counts, plus the item's deeper terms at the deepest largest count, all at the smallest m.
A subtree whose bound is below the item's tenth best score so far is skipped; documents that are reached
are scored exactly. Items are searched in blocks, all items of a block in one walk of the trie.

How it runs on Spark: terms are cut by one split in the JVM, in one pass over the texts; the corpus totals N
and L and the document frequencies are Spark aggregations over all documents; the items' vocabulary is joined to the
terms (broadcast only when its counted size is below BROADCAST_TERMS, otherwise by a shuffle). Documents are
dealt into shards of about DOCS_PER_SHARD by a hash of their row; the items (the stated query set) are
sent to every shard and each shard's trie is searched in its own task (cogroup). Each shard returns at
most K rows per item, which one window per item ranks.

Score (fixed by the contract): terms are the maximal runs of TERM in the text with only A-Z lower-cased;
N = documents with a term, L = all their terms, n = a document's terms, df = documents with the term,
tf = its count in the document; w = floor(1000 ln((2N+2)/(2df+1))) in doubles; m = 25 + (75 n N) div L;
score = sum over the item's terms with repeats of w * ((10^9 tf) div (1000 tf + 8 m)), in 64-bit integers.

Defined cases: a null or empty text has no terms, counts for neither N nor L and is never returned; a
null or termless item returns no rows; rows are returned only with score above 0; equal scores go by
ascending doc_id, null doc_ids last, then by the row's position in the table (repeated rows are each
ranked); an empty table gives no rows. Extra columns of either table are ignored, whatever their names.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from treeloom.session import materialize

# Fixed values of the contract: the term pattern, the case folding of A-Z, and the score's constants.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
K = 10

#: Documents a shard's trie holds, about; the shard count follows the number of documents.
DOCS_PER_SHARD = 20_000
#: The items' vocabulary is sent to all tasks only below this many terms.
BROADCAST_TERMS = 2_000_000
#: Bytes of an item block's dense weight table.
BLOCK_BYTES = 64 << 20
_NO_DOC = (1 << 63) - 1

RESULT = "item_id bigint, rank int, doc_id bigint, score bigint"
_FOUND = "item bigint, item_id bigint, doc_id bigint, row bigint, score bigint"


#: The complement of TERM: terms are what lies between its runs.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text) -> "F.Column":
    """The terms of a text column (the maximal runs of TERM, cut by one split): null has none."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(low, BETWEEN), "")


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """The k best documents of every item: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), terms(F.col("text")).alias("terms")) \
        .withColumn("row", F.monotonically_increasing_id()).withColumn("n", F.size("terms").cast("bigint"))
    asked = items.select(F.col("item_id").cast("bigint").alias("item_id"), terms(F.col("text")).alias("terms")) \
        .withColumn("item", F.monotonically_increasing_id())
    wanted = materialize(asked.select("item", "item_id", F.explode("terms").alias("term"))
                         .groupBy("item", "item_id", "term").agg(F.count(F.lit(1)).alias("q")), "search-items")
    vocab = materialize(wanted.select("term", F.lit(True).alias("asked")).distinct(), "search-vocab")
    if vocab.count() == 0:
        return spark.createDataFrame([], RESULT)
    if vocab.count() <= BROADCAST_TERMS:
        vocab = F.broadcast(vocab)
    # One pass over the texts: terms outside the vocabulary are counted together under a null term, so
    # that each document's groups sum to its n and the totals come from the same table.
    postings = materialize(rows.where("n > 0").select("row", "doc_id", "n", F.explode("terms").alias("term"))
                           .join(vocab, "term", "left").select("row", "doc_id", "n", F.when(F.col("asked"), F.col("term")).alias("term"))
                           .groupBy("row", "doc_id", "n", "term").agg(F.count(F.lit(1)).alias("tf")),
                           "search-postings")
    totals = postings.agg(F.sum("tf").alias("L"), F.round(F.sum(F.col("tf") / F.col("n"))).alias("N")).first()
    n_docs, n_terms = int(totals["N"] or 0), int(totals["L"] or 0)
    postings = postings.where(F.col("term").isNotNull())
    if n_docs == 0:
        return spark.createDataFrame([], RESULT)
    frequencies = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    ranked = materialize(frequencies.select(
        "term", F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("bigint").alias("w"),
        (F.row_number().over(Window.orderBy(F.desc("df"), "term")) - 1).cast("int").alias("rank")), "search-ranks")
    n_ranks = ranked.count()
    vectors = (postings.join(F.broadcast(ranked.select("term", "rank")) if n_ranks <= BROADCAST_TERMS else ranked.select("term", "rank"), "term")
               .groupBy("row", "doc_id", "n")
               .agg(F.sort_array(F.collect_list(F.struct("rank", "tf"))).alias("v"))
               .select("row", "doc_id", (F.lit(25) + F.expr(f"(75 * n * {n_docs}) div {n_terms}")).alias("m"),
                       F.col("v.rank").alias("ranks"), F.col("v.tf").cast("array<bigint>").alias("tfs")))
    vectors = materialize(vectors, "search-vectors")
    shards = max(1, -(-vectors.count() // DOCS_PER_SHARD))
    vectors = vectors.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    weighted = (wanted.join(ranked, "term").where("w > 0")
                .groupBy("item", "item_id").agg(F.sort_array(F.collect_list(F.struct("rank", (F.col("q") * F.col("w")).alias("W")))).alias("v"))
                .select("item", "item_id", F.col("v.rank").alias("ranks"), F.col("v.W").alias("weights")))
    sent = weighted.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    width = n_ranks

    def searched(left: pa.Table, right: pa.Table) -> pa.Table:
        return _search_shard(left, right, width, k)

    found = (vectors.groupBy("shard").cogroup(sent.groupBy("shard")).applyInArrow(searched, _FOUND))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    best = found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return best.select("item_id", "rank", "doc_id", "score")


def _lists(table: pa.Table, name: str, dtype) -> tuple[np.ndarray, np.ndarray]:
    column = table.column(name).combine_chunks()
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False).astype(dtype)[offsets[0]:offsets[-1]]
    return offsets - offsets[0], values


class Trie:
    """The FP-tree of one shard's restricted vectors; nodes in preorder, subtrees as doc ranges."""

    def __init__(self, offsets, ranks, tfs, m):
        self.offsets, self.ranks, self.m = offsets, ranks, m
        n = len(m)
        length = np.diff(offsets)
        owner = np.repeat(np.arange(n), length)
        self.score_part = (1_000_000_000 * tfs) // (1000 * tfs + 8 * m[owner])   # per entry, exact
        deeper = np.zeros(len(tfs), np.int64)                                    # largest later count
        for i in range(n):
            a, b = offsets[i], offsets[i + 1]
            if b - a > 1:
                deeper[a:b - 1] = np.maximum.accumulate(tfs[a + 1:b][::-1])[::-1]
        # node arrays: rank of the term, bounds, children, documents that end here or are alone below
        self.rank, self.top, self.below, self.kids, self.docs = [], [], [], [], []
        root = self._node(-1, 0, _f(int(tfs.max(initial=0)), int(m.min(initial=0))))
        stack = [(root, np.arange(n), 0)]
        while stack:
            node, members, depth = stack.pop()
            here = members[length[members] == depth]
            self.docs[node].extend(here.tolist())
            rest = members[length[members] > depth]
            if not len(rest):
                continue
            keys = ranks[offsets[rest] + depth]
            order = np.argsort(keys, kind="stable")
            rest, keys = rest[order], keys[order]
            cuts = np.flatnonzero(np.diff(keys)) + 1
            for run in np.split(rest, cuts):
                if len(run) == 1:
                    self.docs[node].append(int(run[0]))
                    continue
                at = offsets[run] + depth
                minm = int(m[run].min())
                top = int(tfs[at].max())
                below = int(deeper[at].max())
                child = self._node(int(ranks[at[0]]), _f(top, minm), _f(below, minm))
                self.kids[node].append(child)
                stack.append((child, run, depth + 1))

    def _node(self, rank, top, below):
        self.rank.append(rank)
        self.top.append(top)
        self.below.append(below)
        self.kids.append([])
        self.docs.append([])
        return len(self.rank) - 1


def _f(tf: int, m: int) -> int:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _search_shard(left: pa.Table, right: pa.Table, width: int, k: int) -> pa.Table:
    empty = pa.table({"item": pa.array([], pa.int64()), "item_id": pa.array([], pa.int64()), "doc_id": pa.array([], pa.int64()),
                      "row": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
    if left.num_rows == 0 or right.num_rows == 0:
        return empty
    offsets, ranks = _lists(left, "ranks", np.int64)
    _, tfs = _lists(left, "tfs", np.int64)
    m = left.column("m").to_numpy().astype(np.int64)
    doc_ids = left.column("doc_id").to_pylist()
    rows = left.column("row").to_numpy()
    trie = Trie(offsets, ranks, tfs, m)
    item_offsets, item_ranks = _lists(right, "ranks", np.int64)
    _, item_weights = _lists(right, "weights", np.int64)
    items, item_ids = right.column("item").to_pylist(), right.column("item_id").to_pylist()
    per_block = max(1, BLOCK_BYTES // (8 * (width + 1)))
    out = {"item": [], "item_id": [], "doc_id": [], "row": [], "score": []}
    for start in range(0, len(items), per_block):
        stop = min(len(items), start + per_block)
        weights = np.zeros((stop - start, width), np.int64)
        for j in range(start, stop):
            a, b = item_offsets[j], item_offsets[j + 1]
            weights[j - start, item_ranks[a:b]] = item_weights[a:b]
        # later[j, r]: the item's weight on terms of a rank above r (r = -1 is the root)
        later = np.concatenate([weights.sum(1, keepdims=True), weights.sum(1, keepdims=True) - np.cumsum(weights, 1)], 1)
        best = _walk(trie, weights, later, k, doc_ids, rows)
        for j, heap in enumerate(best):
            for score, _, neg_row, doc in heap:
                out["item"].append(items[start + j])
                out["item_id"].append(item_ids[start + j])
                out["doc_id"].append(doc)
                out["row"].append(-neg_row)
                out["score"].append(score)
    return pa.table({"item": pa.array(out["item"], pa.int64()), "item_id": pa.array(out["item_id"], pa.int64()),
                     "doc_id": pa.array(out["doc_id"], pa.int64()), "row": pa.array(out["row"], pa.int64()),
                     "score": pa.array(out["score"], pa.int64())})


def _walk(trie: Trie, weights: np.ndarray, later: np.ndarray, k: int, doc_ids, rows) -> list[list]:
    """Depth-first branch and bound of all items of a block: per item the k best (score, tie keys)."""
    n_items = weights.shape[0]
    heaps: list[list] = [[] for _ in range(n_items)]
    floor = np.zeros(n_items, np.int64)          # k-th best score so far (0 until k are found)
    full = np.zeros(n_items, bool)
    stack = [(0, np.arange(n_items), np.zeros(n_items, np.int64))]
    offsets, ranks, part = trie.offsets, trie.ranks, trie.score_part
    while stack:
        node, active, path = stack.pop()
        rank = trie.rank[node]
        if rank >= 0:
            path = path + weights[active, rank] * trie.top[node]
        bound = path + later[active, rank + 1] * trie.below[node]
        alive = (bound > 0) & (~full[active] | (bound >= floor[active]))
        if not alive.any():
            continue
        active, path = active[alive], path[alive]
        for doc in trie.docs[node]:
            a, b = offsets[doc], offsets[doc + 1]
            scores = (weights[np.ix_(active, ranks[a:b])] * part[a:b]).sum(1)
            hit = (scores > 0) & (~full[active] | (scores >= floor[active]))
            if not hit.any():
                continue
            doc_id = doc_ids[doc]
            key = -(_NO_DOC if doc_id is None else doc_id)
            for j, score in zip(active[hit].tolist(), scores[hit].tolist()):
                entry = (score, key, -int(rows[doc]), doc_id)
                heap = heaps[j]
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
                if len(heap) == k:
                    full[j], floor[j] = True, heap[0][0]
        for child in trie.kids[node]:
            stack.append((child, active, path))
    return heaps
