"""Language-model scores by context-tree weighting over bytes.

A text is read as its lower-case words, each with a space after it, and a line feed for the end. Each
byte is eight binary decisions; each decision (a node of the byte's bit tree) has its own tree of
contexts, the 0 to DEPTH bytes before. A context's zeros and ones have a Krichevsky-Trofimov estimate,
and a context weighs its own estimate against its children's product by half and half, so all depths
are mixed. The tree is learnt from the training documents and then fixed: a bit's probability is the
mixture along its contexts by their posterior weights, down to the deepest context that was seen.

How it runs: documents are dealt into blocks. A block reports its distinct (DEPTH + 1)-byte strings and
words with their counts in training documents; the strings, summed over blocks, hold all counts of the
tree. They are grouped by their last two context bytes, so that a group has whole subtrees; only the
nodes with at most one context byte, no more than 257 * 255 whatever the corpus, are put together on
the driver. Each distinct string gets its log-probability once, and a block gets back the values of
the strings and words it reported, with which its documents are scored.

Defined cases: a null or empty text is the end alone; a null doc_id counts as training; repeated rows
count and are scored each; without training documents every bit has probability 1/2.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeloom.llm import textarrays as ta
from treeloom.session import materialize

DEPTH = 5
BLOCK_BYTES = 24 << 20
CHUNK_BYTES = 512 << 10
#: Distinct keys that a block's counter holds before it merges them.
HELD_KEYS = 500_000
#: Rows that a block hands on at a time.
ROWS_OUT = 100_000
GROUP_STRINGS = 400_000
END, PAD = b"\n", b"\n" * DEPTH
END_WORD = np.uint64(2)  # the end's id among word hashes, whose lowest bit is always 0
U8 = np.uint64(8)
_SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
           "base_score double, score double")


# Strings and words of a block

def _streams(texts: pa.Array):
    """For chunks of rows: first row, the rows' streams one after another, each with PAD before it, and where each begins."""
    data, offsets = ta.buffers(texts)
    for a, b in ta.chunks(offsets, CHUNK_BYTES):
        raw = data[offsets[a]:offsets[b]].tobytes().translate(ta.LOWER_BYTES)
        off = offsets[a:b + 1] - offsets[a]
        parts = []
        for i in range(b - a):
            words = raw[off[i]:off[i + 1]].split()
            parts.append(PAD + b" ".join(words) + (b" \n" if words else END))
        begins = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        yield a, np.frombuffer(b"".join(parts), np.uint8), begins


def strings(stream: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The (DEPTH + 1)-byte string that ends at each byte after the PADs, its last byte lowest, and where each stream begins."""
    wide = stream.astype(np.uint64)
    out = wide[DEPTH:].copy()
    for k in range(1, DEPTH + 1):
        out |= wide[DEPTH - k:len(wide) - k] << np.uint64(8 * k)
    lengths = np.diff(begins)
    keep = np.ones(len(out), bool)
    for k in range(DEPTH):
        at = begins[1:-1] - DEPTH + k
        keep[at] = False
    return out[keep], np.concatenate(([0], np.cumsum(lengths - DEPTH)))


def _words(stream: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word ids and their rows."""
    w = ta.words(stream, begins)
    return w.hash & ~np.uint64(1), w.row


class Counter:
    """Distinct 63-bit keys with their number of training occurrences."""

    def __init__(self):
        self.parts, self.held, self.most = [], 0, HELD_KEYS

    def add(self, keys: np.ndarray, train: np.ndarray) -> None:
        self._put(keys, train.astype(np.int64))

    def _put(self, keys, counts) -> None:
        flagged = (keys << np.uint64(1)) | (counts > 0)
        flagged.sort()
        self._merge(*self._runs(flagged))

    @staticmethod
    def _runs(flagged):
        edge = np.flatnonzero(np.concatenate(([True], flagged[1:] != flagged[:-1])))
        size = np.diff(np.append(edge, len(flagged)))
        found = flagged[edge]
        return found >> np.uint64(1), np.where(found & np.uint64(1), size, 0)

    def _merge(self, keys, counts) -> None:
        self.parts.append((keys, counts))
        self.held += len(keys)
        if self.held > self.most and len(self.parts) > 1:
            self.parts = [self.total()]
            self.held = len(self.parts[0][0])
            self.most = self.held + HELD_KEYS

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, counts = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts = []
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        del order
        edge = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[edge], np.add.reduceat(counts, edge)


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, kind, key, count): kind 0 strings, 1 words."""
    counters, ends, of = (Counter(), Counter()), 0, None
    for batch in batches:
        if not len(batch):
            continue
        of = batch["block"][0].as_py()
        train = ~batch["held_out"].to_numpy(zero_copy_only=False)
        ends += int(train.sum())
        for a, stream, begins in _streams(batch["text"]):
            own = train[a:a + len(begins) - 1]
            keys, first = strings(stream, begins)
            counters[0].add(keys, np.repeat(own, np.diff(first)))
            keys, row = _words(stream, begins)
            if len(keys):
                counters[1].add(keys >> np.uint64(1), own[row])
    if of is None:
        return

    def rows(kind: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(keys), ROWS_OUT):
            part = keys[a:a + ROWS_OUT]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(part), of), pa.int32()), pa.array(np.full(len(part), kind), pa.int8()),
                 pa.array(part.view(np.int64)), pa.array(counts[a:a + ROWS_OUT], pa.int64())], ["block", "kind", "key", "count"])

    yield from rows(0, *counters[0].total())
    keys, counts = counters[1].total()
    yield from rows(1, keys << np.uint64(1), counts)
    yield from rows(1, np.array([END_WORD]), np.array([ends]))
    del counters, keys, counts
    ta.release()


# The tree

def log_gamma(x: np.ndarray) -> np.ndarray:
    """By Stirling's series at x + 8 and the recurrence."""
    x = np.asarray(x, np.float64)
    product = np.ones_like(x)
    for k in range(8):
        product *= x + k
    y = x + 8
    inverse = 1 / y
    series = inverse * (1 / 12 - inverse ** 2 * (1 / 360 - inverse ** 2 / 1260))
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(product)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """The log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    both = log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0)
    return both - math.log(math.pi)


class Level:
    """All nodes with contexts of one length, by ascending key: context << 8 | place in the byte's bit tree."""

    def __init__(self, keys, zeros, ones, children=None):
        self.keys, self.zeros, self.ones = keys, zeros, ones
        own = log_kt(zeros, ones)
        self.log_weighted = own if children is None else np.logaddexp(own, children) - math.log(2)
        self.weight = np.ones(len(keys)) if children is None else np.exp(np.minimum(own - math.log(2) - self.log_weighted, 0))
        self.estimate = (ones + 0.5) / (zeros + ones + 1.0)

    def parents(self, depth: int) -> tuple:
        """keys, zeros, ones and the children's sum of logs one context byte up."""
        parent = (self.keys & np.uint64(0xFF)) | ((self.keys >> U8 & np.uint64((1 << 8 * (depth - 1)) - 1)) << U8)
        order = np.argsort(parent, kind="stable")
        parent = parent[order]
        edge = np.flatnonzero(np.concatenate(([True], parent[1:] != parent[:-1]))) if len(parent) else np.zeros(0, int)
        add = lambda x: np.add.reduceat(x[order], edge) if len(edge) else x
        return parent[edge], add(self.zeros), add(self.ones), add(self.log_weighted)

    def mixed(self, keys: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The probability of a one at each key given that of the next context, and where the node was seen."""
        if not len(self.keys):
            return below, np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        seen = self.keys[at] == keys
        weight = np.where(np.isnan(below), 1.0, self.weight[at])
        value = weight * self.estimate[at] + (1 - weight) * np.where(np.isnan(below), 0.0, below)
        return np.where(seen, value, below), seen


def _bits(symbols: np.ndarray):
    """For each of a byte's decisions: the place in the bit tree and the bit."""
    for j in range(8):
        yield (np.uint64(1 << j) | symbols >> np.uint64(8 - j)), (symbols >> np.uint64(7 - j)) & np.uint64(1)


def subtree(keys: np.ndarray, counts: np.ndarray) -> list[Level]:
    """Levels 2 to DEPTH, the deepest last, of the strings of whole groups."""
    keys, counts = keys[counts > 0], counts[counts > 0].astype(np.float64)
    context, symbol = keys >> U8, keys & np.uint64(0xFF)
    nodes, bits = zip(*_bits(symbol), strict=True)
    node = np.concatenate([context << U8 | n for n in nodes])
    bit, count = np.concatenate(bits).astype(bool), np.tile(counts, 8)
    order = np.argsort(node, kind="stable")
    node, bit, count = node[order], bit[order], count[order]
    edge = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1]))) if len(node) else np.zeros(0, int)
    add = lambda x: np.add.reduceat(x, edge) if len(edge) else np.zeros(0)
    levels = [Level(node[edge], add(np.where(bit, 0, count)), add(np.where(bit, count, 0)))]
    for depth in range(DEPTH, 2, -1):
        levels.insert(0, Level(*levels[0].parents(depth)))
    return levels


def shallow(rows: dict[str, np.ndarray]) -> list[Level]:
    """Levels 0 and 1 from the sums (key, zeros, ones, children) for contexts of one byte."""
    order = np.argsort(rows["key"])
    first = Level(rows["key"][order].astype(np.uint64), *[rows[c][order] for c in ("zeros", "ones", "children")])
    return [Level(*first.parents(1)), first]


def log10_of(keys: np.ndarray, levels: list[Level]) -> np.ndarray:
    """log10 of each string's last byte given those before it."""
    context, symbol = keys >> U8, keys & np.uint64(0xFF)
    total = np.zeros(len(keys))
    for node, bit in _bits(symbol):
        one = np.full(len(keys), np.nan)
        for depth in range(DEPTH, -1, -1):
            suffix = context & np.uint64((1 << 8 * depth) - 1)
            one, _ = levels[depth].mixed(suffix << U8 | node, one)
        one = np.where(np.isnan(one), 0.5, one)
        total += np.log10(np.where(bit, one, 1 - one))
    return total


# Scores of a block

class Table:
    """Values by 64-bit key, found by hashing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values
        self.shift = np.uint64(64 - max(4, int(len(keys) * 2.5).bit_length()))
        self.slots = np.full(1 << (64 - int(self.shift)), -1, np.int32)
        self.mask = np.int64(len(self.slots) - 1)
        todo, slot = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(todo):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = todo[free]
            left = self.slots[slot] != todo
            todo, slot = todo[left], (slot[left] + 1) & self.mask

    def _slot(self, keys):
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """All keys must be known."""
        slot = self._slot(keys)
        at = self.slots[slot]
        wrong = np.flatnonzero(self.keys[at] != keys)
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & self.mask
            at[wrong] = self.slots[slot[wrong]]
            wrong = wrong[self.keys[at[wrong]] != keys[wrong]]
        return self.values[at]


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values)))
    return total[first[1:]] - total[first[:-1]]


def _scored(docs: pa.Table, answers: pa.Table, tokens: int, types: int) -> pa.Table:
    kind = answers["kind"].to_numpy()
    keys, values = answers["key"].to_numpy().view(np.uint64), answers["value"].to_numpy()
    of_string = Table(keys[kind == 0], values[kind == 0])
    counts = values[kind == 1]
    logs = np.log10((counts + 0.5) / (tokens + 0.5 * (types + 1)))
    of_word = Table(keys[kind == 1], np.arange(len(counts)))
    end = int(of_word.of(np.array([END_WORD]))[0])
    out = {c: [] for c in ("n_tokens", "n_known", "base_score", "score")}
    for stream, begins in (x[1:] for chunk in docs["text"].chunks for x in _streams(chunk)):
        grams, first = strings(stream, begins)
        out["score"].append(_sums(of_string.of(grams), first))
        ids, row = _words(stream, begins)
        at = of_word.of(ids)
        first = np.searchsorted(row, np.arange(len(begins)))
        out["n_tokens"].append(np.diff(first) + 1)
        out["n_known"].append(_sums((counts[at] > 0).astype(float), first) + (counts[end] > 0))
        out["base_score"].append(_sums(logs[at], first) + logs[end])
    found = {c: np.concatenate(x) for c, x in out.items()}
    n = len(docs)
    return pa.table({
        "doc_id": docs["doc_id"], "held_out": docs["held_out"],
        "n_tokens": pa.array(found["n_tokens"].astype(np.int64)), "n_known": pa.array(np.rint(found["n_known"]).astype(np.int64)),
        "train_tokens": pa.array(np.full(n, tokens, np.int64)), "base_score": pa.array(found["base_score"]),
        "score": pa.array(found["score"])})


# Jobs

def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of each document (doc_id, text)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(2, -(-size // BLOCK_BYTES))
    dealt = ta.bounded(docs).select(
        "doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(blocks)).cast("int").alias("block"))
    reports = materialize(dealt.groupBy("block").applyInArrow(
        _reports, "block int, kind byte, key bigint, count bigint"), "ctw-reports")
    counts = materialize(reports.groupBy("kind", "key").agg(F.sum("count").alias("count")), "ctw-counts")
    n = {r["kind"]: r for r in counts.groupBy("kind").agg(
        F.count("*").alias("rows"), F.sum("count").alias("total"), F.sum((F.col("count") > 0).cast("bigint")).alias("types")).collect()}
    tokens, types = (int(n[1][c] or 0) for c in ("total", "types")) if 1 in n else (0, 0)
    groups = max(32, -(-n[0]["rows"] // GROUP_STRINGS)) if 0 in n else 1
    suffix = F.shiftrightunsigned(F.col("key"), 8).bitwiseAND(F.lit(0xFFFF))
    grouped = counts.where("kind = 0").withColumn("group", F.pmod(F.xxhash64(suffix), F.lit(groups)).cast("int")).select(
        "group", "key", "count").groupBy("group")

    def sums(rows: pa.Table) -> pa.Table:
        key, zeros, ones, children = subtree(
            rows["key"].to_numpy().view(np.uint64), rows["count"].to_numpy())[0].parents(2)
        return pa.table({"key": pa.array(key.view(np.int64)), "zeros": zeros, "ones": ones, "children": children})

    top = grouped.applyInArrow(sums, "key bigint, zeros double, ones double, children double").groupBy("key").agg(
        *[F.sum(c).alias(c) for c in ("zeros", "ones", "children")]).toPandas()
    top_levels = shallow({c: top[c].to_numpy() for c in top.columns})

    def predict(rows: pa.Table) -> pa.Table:
        keys = rows["key"].to_numpy().view(np.uint64)
        values = log10_of(keys, [*top_levels, *subtree(keys, rows["count"].to_numpy())])
        ta.release()
        return pa.table({"kind": pa.array(np.zeros(len(keys)), pa.int8()), "key": rows["key"], "value": values})

    answers = grouped.applyInArrow(predict, "kind byte, key bigint, value double").union(
        counts.where("kind = 1").select("kind", "key", F.col("count").cast("double")))
    back = reports.select("block", "kind", "key").join(answers, ["kind", "key"])

    def scored(docs_of: pa.Table, answers_of: pa.Table) -> pa.Table:
        found = _scored(docs_of, answers_of, tokens, types)
        ta.release()
        return found

    return dealt.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(scored, _SCORES)
