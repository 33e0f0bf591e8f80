"""Packing of token sequences by lexical retrieval.

Documents are dealt over partitions by language and a hash, and each partition is read in shards of
bounded size. A shard has an inverted index with BM25 weights over its documents' words, without the
symbols at their ends. A seed, the
first document not used yet, opens a window of SEQUENCE tokens; the index returns the unused documents
that score best against the seed, and these fill the window greedily. The last one is cut where the
window ends and its rest returns to the pool. Without a scored neighbour left, the next unused document
continues the window, and a window that is open when a shard is used up goes on into the next. So every
window of a partition is full but its last. A document's whole windows are emitted as they are and only
its rest is retrieved.

Defined cases: a null or empty text is the end token alone; a null doc_id or lang is packed as any
other; repeated rows are packed each, in their order within the partition; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeloom.llm import textarrays as ta

SEQUENCE = 4096
END = 2
SHARD_DOCS, SHARD_BYTES = 2048, 16 << 20
#: What a Python worker remembers: places for units, a power of two, and their ids. What is forgotten is tokenized again.
SLOTS, KNOWN_IDS = 1 << 20, 1 << 22
#: Units tokenized by one call.
LEARN = 2000
#: Lower-case letters of Latin-1, which the tokenizer's normalizer leaves as they are.
PLAIN = re.compile("[a-zß-öø-ÿ]+")
SYMBOL = np.zeros(256, bool)
SYMBOL[[i for i in range(0x21, 0x7F) if not chr(i).isalnum()]] = True
K1, B = 1.2, 0.75
SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")

_tokenizers: dict[str, tuple] = {}


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The places where an ASCII symbol follows a letter (ASCII or Latin-1) of the same text."""
    here = data[1:]
    letter = (here >= ord("a")) & (here <= ord("z"))
    letter |= (data[:-1] == 0xC3) & (here != 0x97) & (here != 0xB7)  # not the two signs among these letters
    letter = np.concatenate(([len(data) > 0 and ord("a") <= data[0] <= ord("z")], letter))
    cut = np.concatenate(([False], SYMBOL[here] & letter[:-1]))
    cut[offsets[offsets < len(cut)]] = False
    return np.flatnonzero(cut)


class Ids:
    """Token ids of the units of texts. A unit is a word, or what is left of it before and after a place
    where a letter meets an ASCII symbol: the tokenizer joins no tokens over white space or over such a
    place. Units are tokenized once and found again by their hash in a table of SLOTS places."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        # The same model without normalizer and pattern, for words that neither would change or cut.
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.key = np.zeros(SLOTS, np.uint64)
        self.begin, self.count = np.zeros(SLOTS, np.int32), np.zeros(SLOTS, np.int32)
        self.ids, self.used = np.zeros(KNOWN_IDS, np.uint32), 0

    @staticmethod
    def of(path: str) -> Ids:
        if path not in _tokenizers:
            _tokenizers[path] = Ids(path)
        return _tokenizers[path]

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of units, one after the other, and how many each has."""
        count = np.zeros(len(units), np.int64)
        plain = np.array([PLAIN.fullmatch(u) is not None for u in units], bool)
        joined = np.array(self.plain.encode(" ".join([u for u, p in zip(units, plain, strict=True) if p]),
                                            add_special_tokens=False).ids, np.uint32)
        count[plain] = np.diff(np.flatnonzero(self.ends[joined]), prepend=-1)
        other = [np.array(self.tokenizer.encode(units[i], add_special_tokens=False).ids, np.uint32)
                 for i in np.flatnonzero(~plain)]
        count[~plain] = [len(x) for x in other]
        out = np.empty(int(count.sum()), np.uint32)
        of_plain = np.repeat(plain, count)
        out[of_plain] = joined
        out[~of_plain] = np.concatenate(other) if other else []
        return out, count

    def learn(self, units: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of new units begin and how many each has."""
        parts = [self.encode(units[i:i + LEARN]) for i in range(0, len(units), LEARN)]
        ids, count = (np.concatenate(x) for x in zip(*parts, strict=True))
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids[:self.used], ids))
        begin = self.used + np.cumsum(count) - count
        self.ids[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        slot = (keys & np.uint64(SLOTS - 1)).astype(np.int64)  # of several the last one has it
        self.key[slot], self.begin[slot], self.count[slot] = keys, begin, count
        return begin, count

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The ids of each text as little-endian 32-bit bytes; hash and text of each unit that is a search term."""
        raw = data.tobytes()
        special = b"<|" in raw  # may be one of the tokenizer's own, which it neither lowers nor cuts
        lower = data if special else ta.LOWER[data]
        cut = np.zeros(0, np.int64) if special or not len(data) else _cuts(lower, offsets)
        start, end = ta.runs(lower, offsets, ~ta.SPACE[lower])
        if len(cut):
            start, end = np.sort(np.concatenate((start, cut))), np.sort(np.concatenate((end, cut)))
        keys = ta.segments(lower, start, end)
        begin, count = self.find(lower.tobytes(), start, end, keys)
        first = np.searchsorted(start, offsets)
        total = np.concatenate(([0], np.cumsum(count)))
        flat = self.ids[np.repeat(begin - total[:-1], count) + np.arange(int(total[-1]))]
        edges = total[first].tolist()
        term = ~SYMBOL[lower[start]]
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        return [flat[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)], keys[term], row[term]

    def find(self, raw: bytes, start: np.ndarray, end: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of units begin and how many each has."""
        slot = (keys & np.uint64(SLOTS - 1)).astype(np.int64)
        missing = np.flatnonzero(self.key[slot] != keys)
        if not len(missing):
            return self.begin[slot], self.count[slot]
        new, at, again = np.unique(keys[missing], return_index=True, return_inverse=True)
        at = missing[at]
        if self.used + 16 * len(new) > KNOWN_IDS and len(missing) < len(keys):  # too full: forget all and begin anew
            self.key[:], self.used, self.ids = 0, 0, np.zeros(KNOWN_IDS, np.uint32)
            return self.find(raw, start, end, keys)
        units = [raw[a:b].decode() for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)]
        begin, count = self.begin[slot], self.count[slot]
        new_begin, new_count = self.learn(units, new)
        begin[missing], count[missing] = new_begin[again], new_count[again]
        return begin, count


class Index:
    """An inverted index of one shard; rows are its documents."""

    def __init__(self, hashes: np.ndarray, rows: np.ndarray, n: int):
        order = np.lexsort((rows, hashes))
        hashes, rows = hashes[order], rows[order]
        edge = np.flatnonzero(np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1]))))
        tf = np.diff(np.append(edge, len(hashes)))
        hashes, rows = hashes[edge], rows[edge]
        length = np.bincount(rows, tf, n)
        term = np.concatenate(([0], np.cumsum(hashes[1:] != hashes[:-1]))) if len(hashes) else np.zeros(0, np.int64)
        df = np.bincount(term)[term] if len(term) else term
        shared = df > 1  # a word of one document finds no other
        term, rows, tf, df = term[shared], rows[shared], tf[shared], df[shared]
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * length / max(length.mean(), 1))
        self.rows, self.weight = rows, (idf * tf * (K1 + 1) / (tf + norm[rows])).astype(np.float32)
        self.n = n
        edges = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1]))) if len(term) else term
        self.first = np.append(edges, len(term))  # postings of a term
        compact = np.repeat(np.arange(len(edges)), np.diff(self.first))
        by_row = np.argsort(rows, kind="stable")
        self.terms = compact[by_row]
        self.terms_first = np.searchsorted(rows[by_row], np.arange(n + 1))

    def neighbours(self, row: int, unused: np.ndarray) -> np.ndarray:
        """Unused rows that share a word with a row, the best first."""
        terms = self.terms[self.terms_first[row]:self.terms_first[row + 1]]
        a, size = self.first[terms], np.diff(self.first)[terms]
        if not len(terms):
            return np.zeros(0, np.int64)
        at = np.repeat(a - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(int(size.sum()))
        score = np.bincount(self.rows[at], self.weight[at], self.n)
        score[~unused] = 0
        found = np.flatnonzero(score)
        return found[np.argsort(-score[found], kind="stable")]


class Packer:
    """Sequences of one partition; `used` tokens of the open window are filled."""

    def __init__(self, base: int):
        self.next, self.open, self.used, self.rows = base, base, 0, []

    def put(self, doc_id, ids: bytes, start: int, length: int, sequence: int, offset: int) -> None:
        self.rows.append((doc_id, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), len(ids) // 4,
                          sequence, offset))

    def fill(self, doc_id, ids: bytes, start: int) -> int:
        """Puts what the open window takes of ids from `start` on; returns where it stopped."""
        if not self.used:
            self.open, self.next = self.next, self.next + 1
        length = min(len(ids) // 4 - start, SEQUENCE - self.used)
        self.put(doc_id, ids, start, length, self.open, self.used)
        self.used = (self.used + length) % SEQUENCE
        return start + length

    def shard(self, docs: list[tuple], hashes: np.ndarray, rows: np.ndarray) -> None:
        """docs: (doc_id, ids); hashes and rows: the words of all docs."""
        sizes = np.array([len(ids) // 4 for _, ids in docs], np.int64)
        rest = sizes // SEQUENCE * SEQUENCE
        for (doc_id, ids), whole in zip(docs, rest, strict=True):
            for start in range(0, int(whole), SEQUENCE):
                self.put(doc_id, ids, start, SEQUENCE, self.next, 0)
                self.next += 1
        index = Index(hashes, rows, len(docs))
        unused = rest < sizes
        for seed in range(len(docs)):
            while unused[seed]:
                for i in [seed, *index.neighbours(seed, unused)]:
                    rest[i] = self.fill(*docs[i], int(rest[i]))
                    unused[i] = rest[i] < sizes[i]
                    if not self.used:
                        break

    def flush(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) if self.rows else [[]] * 7
        self.rows = []
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per piece from documents (doc_id, text, lang); see SCHEMA."""
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = Ids.of(tokenizer)
        packer = Packer(TaskContext.get().partitionId() << 40)
        held, hashes, rows, size = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal held, hashes, rows, size
            packer.shard(held, np.concatenate(hashes), np.concatenate(rows))
            held, hashes, rows, size = [], [], [], 0
            return packer.flush()

        try:
            for batch in batches:
                data, offsets = ta.buffers(batch.column(1))
                ids = batch.column(0).to_pylist()
                for a, b in ta.chunks(offsets):
                    part, off = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                    found, terms, of = ids_of.texts(part, off)
                    held += [(i, x + END.to_bytes(4, "little")) for i, x in zip(ids[a:b], found, strict=True)]
                    hashes.append(terms)
                    rows.append(of + (len(held) - (b - a)))
                    size += len(part)
                    if len(held) >= SHARD_DOCS or size >= SHARD_BYTES:
                        yield close()
            if held:
                yield close()
        finally:
            # A reused worker does not carry the unit tables and tokenizers into other tasks.
            _tokenizers.pop(tokenizer, None)

    key = F.xxhash64("doc_id", "text")
    dealt = ta.bounded(docs).select("doc_id", "text", "lang").repartitionByRange(F.col("lang"), F.xxhash64("doc_id"))
    return dealt.sortWithinPartitions("lang", F.xxhash64("doc_id"), key).select("doc_id", "text").mapInArrow(ta.released(tasks), SCHEMA)
