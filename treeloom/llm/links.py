"""Links, components and exact verification, shared by the near-duplicate operators.

`components` is a distributed union-find over a table of links: nothing is collected, and each round
is a written table. `verified` links the members of coarse groups exactly without forming all pairs:
members of one component are searched from in turn, each time only against those that are in no
component yet. Groups over BLOCK members are dealt by their buckets if these are given, or else as pairs of blocks, so no
task holds more than two.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeloom.llm import textarrays as ta
from treeloom.session import materialize

BLOCK = 8192
POSTINGS = 2_000_000
#: Links up to this number, 8 MB, are put together by one task.
FINISH = 500_000


class Union:
    """Union-find over 0 .. n-1 with the smallest member as the root."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.parent[max(i, j)] = min(i, j)
        return True


def _forest(batches, most: int = 200_000):
    """Replaces the links of a task by (node, smallest node of its part), a row for each node."""
    held, size = [], 0
    for batch in batches:
        held.append([batch.column(i).to_numpy().copy() for i in range(2)])
        size += batch.num_rows
        if size >= most:
            yield _stars(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held, size = [], 0
    if size:
        yield _stars(*(np.concatenate(x) for x in zip(*held, strict=True)))


def _stars(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    nodes, both = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = both[:len(u)], both[len(u):]
    label = np.arange(len(nodes))
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while not np.array_equal(up := label[label], label):
            label = up
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    keep = label != np.arange(len(nodes))
    return pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(nodes[label[keep]])], ["u", "v"])


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, component) for each node of links (u, v), numbers; component is the smallest node reached.

    Rounds of large and small stars: each node hands its neighbours to the smallest of them, until all
    hang on their component's smallest node. No more than FINISH links are finished by one task.
    """
    edges = materialize(links.select(F.col("u").cast("bigint"), F.col("v").cast("bigint")).where("u <> v")
                        .mapInArrow(_forest, "u bigint, v bigint").distinct(), f"{name}-links")
    while True:
        if edges.count() <= FINISH:  # so few that one task joins them
            large = materialize(edges.coalesce(1).mapInArrow(lambda b: _forest(b, FINISH), "u bigint, v bigint"), f"{name}-last")
            break
        # Large star: of a node's neighbours, the larger ones go to the smallest of all.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = materialize(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .distinct(), f"{name}-large")
        # Small star: the smaller neighbours and the node itself go to the smallest.
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        if least.where("n > 1").isEmpty() and large.select("v").distinct().join(
                least.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            break  # every node hangs on one other, which hangs on none
        joined = large.join(least, "u")
        edges = materialize(joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            joined.select("u", F.col("m").alias("v"))).distinct(), f"{name}-small")
    found = large.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return materialize(found.union(found.select(F.col("component").alias("node"), "component").distinct()), f"{name}-components")


def linked(sets: list[np.ndarray], most: int = 100, least: int = 80) -> list[tuple[int, int]]:
    """Links that connect the sets as all pairs with most * intersection >= least * union would, a forest.

    A member that has been reached searches, over an inverted index, all that have not been.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    if n < 2:
        return []
    if n == 2:
        shared = len(np.intersect1d(*sets, assume_unique=True))
        return [(0, 1)] if most * shared >= least * (size[0] + size[1] - shared) and shared else []
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    edge = np.concatenate(([True], tokens[1:] != tokens[:-1]))
    first = np.append(np.flatnonzero(edge), len(tokens))
    term = np.empty(len(tokens), np.int64)
    term[order] = np.cumsum(edge) - 1
    begins = np.concatenate(([0], np.cumsum(size)))
    out, open_ = [], np.ones(n, bool)
    postings, at = owner, first
    left_at_build = n
    for start in range(n):
        if not open_[start]:
            continue
        open_[start] = False
        queue = [start]
        while queue:
            i = queue.pop()
            shared = np.zeros(n, np.int64)
            own = term[begins[i]:begins[i + 1]]
            length = at[own + 1] - at[own]
            total = np.cumsum(length)
            done = 0
            while done < len(own):  # so many postings at a time
                stop = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + POSTINGS, "right")))
                a, size_ = at[own[done:stop]], length[done:stop]
                where = np.repeat(a - np.concatenate(([0], np.cumsum(size_)[:-1])), size_) + np.arange(int(size_.sum()))
                shared += np.bincount(postings[where], minlength=n)
                done = stop
            hit = open_ & (shared > 0) & (most * shared >= least * (size[i] + size - shared))
            for j in np.flatnonzero(hit).tolist():
                out.append((i, j))
                queue.append(j)
            open_ &= ~hit
            left = int(open_.sum())
            if left == 0:
                return out
            if left < left_at_build // 2:  # postings of reached members are of no more use
                keep = open_[postings]
                before = np.concatenate(([0], np.cumsum(keep)))
                at, postings, left_at_build = before[at], postings[keep], left
    return out


def parts(members: DataFrame, buckets: DataFrame | None = None) -> DataFrame:
    """(id, part) from members (coarse, id): a part is a group, or a pair of blocks of a group over BLOCK.

    With buckets (id, bucket), whose members alone are candidates of each other, each bucket within a group over BLOCK
    is a group of its own: the pairs of blocks of a group would grow with its square.
    """
    counts = members.groupBy("coarse").agg(F.count("*").alias("n")).where("n > 1")
    if buckets is not None:
        large = members.join(counts.where(F.col("n") > BLOCK), "coarse").select("id")
        inner = buckets.join(large, "id").select(F.col("bucket").alias("coarse"), "id").distinct()
        whole = members.join(counts.where(F.col("n") <= BLOCK), "coarse").select("id", F.xxhash64("coarse", F.lit(0), F.lit(0)).alias("part"))
        return whole.union(parts(inner))
    return (
        members.join(counts, "coarse").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .where("blocks = 1 or own <> other")
        .select("id", F.xxhash64("coarse", F.least("own", "other"), F.greatest("own", "other")).alias("part")))


def sets_of(column: pa.Array) -> list[np.ndarray]:
    """The sets of a column of arrays of 64-bit shingles without repeats."""
    offsets, values = np.asarray(column.offsets), np.asarray(column.values).view(np.uint64)
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def verified(members: DataFrame, sets=sets_of) -> DataFrame:
    """Links (u, v) from members (part, id, content); `sets` makes the sets of some rows' contents."""
    def tasks(batches):
        for batch in whole_runs(batches):
            ids = batch.column(1).to_numpy()
            for a, b in runs(batch.column(0).to_numpy()):
                found = linked(sets(batch.column(2).slice(a, b - a))) if b - a > 1 else []
                if found:
                    u, v = (ids[[a + x for x in side]] for side in zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return members.repartition("part").sortWithinPartitions("part").select("part", "id", members.columns[2]).mapInArrow(
        ta.released(tasks), "u bigint, v bigint")


def runs(keys: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of equal neighbouring keys."""
    edges = np.append(np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))), len(keys)).tolist()
    return list(zip(edges[:-1], edges[1:], strict=True))


def whole_runs(batches):
    """The rows of batches sorted by their first column, cut anew so that rows of one key are in one batch."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        keys = batch.column(0)
        last = int(np.searchsorted(keys.to_numpy(), keys[-1].as_py(), "left"))
        if last:
            yield compact(batch, 0, last)
        held = compact(batch, last, batch.num_rows)
    if held is not None:
        yield held


def compact(batch: pa.RecordBatch, start: int, end: int) -> pa.RecordBatch:
    """A copy of some rows without offsets into other rows."""
    return batch.take(pa.array(np.arange(start, end)))
