"""Removal of fuzzy line duplicates by MinHash.

A line is compared in lower case (A-Z) with white space runs as one space. Its character shingles get
BANDS x ROWS MinHash values; lines that agree on all values of a band are candidates, which a pair of
similarity 0.8 misses with probability (1 - 0.8 ** ROWS) ** BANDS, below 0.001. Candidates hang on the
band's smallest line (a star, never all pairs), their coarse components are verified exactly by shingle
Jaccard (`links.verified`), and the verified links' components keep their first line, by doc_id and
line number. Equal lines are one class from the start, so a line that a third of all rows repeat is
hashed into the bands once by a task; they are told apart by
64-bit hashes. Chance links join ever more coarse components as the table grows, until one holds most candidates. So
of a component over `links.BLOCK` lines each bucket of a band is verified by itself, which is every pair of candidates.
Of the texts only the candidates' lines are exchanged, found by a bitmap of their places.

Defined cases: a null or empty text has no lines; lines without a word are left alone; a line shorter
than a shingle is one shingle; a null doc_id comes first in the order; rows that are equal in doc_id and
text are one document, whose kept lines stay in each. `dedupe` drops documents that had words and have
no line left, and sets n_chars, if there, to the new length.
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

SHINGLE = 8
BANDS, ROWS = 10, 3
CHUNK_CHARS = 1 << 18
#: Lines that a task remembers so as not to hash them again.
SEEN_LINES = 200_000
#: Candidate and answer tables up to this number of lines are sent to all tasks; larger ones are joined by a shuffle.
BROADCAST_ROWS = 400_000
#: Bits of the bitmap of places for each place, and of all; a place that is not asked for but has a set bit is dropped by the join.
PLACE_BITS, MOST_BITS = 16, 1 << 26

_random = np.random.RandomState(8)
_MASKS = _random.randint(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)
_FACTORS = (_random.randint(0, 1 << 31, BANDS * ROWS, dtype=np.uint64) * 2 + 1).astype(np.uint32)


def normal(line: bytes) -> bytes:
    return b" ".join(line.translate(ta.LOWER_BYTES).split())


def _shingles(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of lines, each padded to one shingle at least, and where each line begins."""
    padded = [x if len(x) >= SHINGLE else x.ljust(SHINGLE, "\0") for x in lines]
    points = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).astype(np.uint64)
    step = 0x9E3779B97F4A7C15
    value, size = points + np.uint64(1), 1
    while size < SHINGLE:  # windows of twice the size
        value = value[:-size] * np.uint64(step) + value[size:]
        step = step * step % (1 << 64)
        size *= 2
    lengths = np.array([len(x) for x in padded], np.int64)
    ends = np.cumsum(lengths)
    keep = np.ones(len(points), bool)
    for k in range(SHINGLE - 1):
        keep[ends - 1 - k] = False
    return ta.mix(value[keep[:len(value)]]), np.concatenate(([0], np.cumsum(lengths - SHINGLE + 1)))


def _bands(lines: list[str]) -> np.ndarray:
    """The band keys of each line."""
    hashes, first = _shingles(lines)
    small = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(lines), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(lines), band + 1, np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            least = np.minimum.reduceat((small ^ _MASKS[k]) * _FACTORS[k], first[:-1])
            key = ta.mix(key + least)
        out[:, band] = key
    return out


def _described(batches):
    """Each line with its hash, and with its bands where the task meets it first."""
    names = ["row", "doc_id", "line_no", "id", "bands"]
    seen: set[int] = set()

    def out(held):
        rows, ids, numbers, lines = zip(*held, strict=True)
        ends = np.cumsum([len(x) for x in lines])
        keys = ta.segments(np.frombuffer(b"".join(lines), np.uint8), np.concatenate(([0], ends[:-1])), ends)
        new = [i for i, k in enumerate(keys.tolist()) if not (k in seen or seen.add(k))]
        counts = np.zeros(len(lines), np.int64)
        counts[new] = BANDS
        bands = _bands([lines[i].decode() for i in new]).view(np.int64).ravel() if new else np.zeros(0, np.int64)
        if len(seen) > SEEN_LINES:
            seen.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(ids, pa.int64()), pa.array(numbers, pa.int32()), pa.array(keys.view(np.int64)),
             pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(bands))], names)

    for batch in batches:
        held, size = [], 0
        for row, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                     batch.column(2).cast(pa.large_binary()), strict=True):
            for number, line in enumerate((text.as_py() or b"").split(b"\n")):
                line = normal(line)
                if line:
                    held.append((row, doc_id, number, line))
                    size += len(line)
                    if size > CHUNK_CHARS:
                        yield out(held)
                        held, size = [], 0
        if held:
            yield out(held)


def _stars(batches):
    """(u, v, bucket): each line of a band and the band's smallest line; all rows of a band are in this task.

    Bands of one line are left out; bucket is a hash of the band's lines, so bands of equal lines are one bucket.
    """
    parts = [[], []]
    for batch in batches:
        for i in range(2):
            parts[i].append(batch.column(i).to_numpy().copy())
    if not parts[0]:
        return
    band, ids = (np.concatenate(x) for x in parts)
    order = np.lexsort((ids, band))
    band, ids = band[order], ids[order]
    new = np.concatenate(([True], (band[1:] != band[:-1]) | (ids[1:] != ids[:-1])))
    band, ids = band[new], ids[new]
    edge = np.flatnonzero(np.concatenate(([True], band[1:] != band[:-1])))
    count = np.diff(np.append(edge, len(ids)))
    bucket = ta.mix(np.add.reduceat(ta.mix(ids.view(np.uint64)), edge)).view(np.int64)
    keep = np.repeat(count > 1, count)
    columns = ids, np.repeat(ids[edge], count), np.repeat(bucket, count)
    yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in columns], ["u", "v", "bucket"])


def _identified(docs: DataFrame, *more) -> DataFrame:
    return ta.bounded(docs).select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text", *more)


def _slot(row, line_no, bits: int):
    """A place's bit, for columns and for arrays; `bits` is a power of two."""
    if isinstance(row, np.ndarray):
        return (row ^ (line_no * 40503)) & (bits - 1)
    return row.bitwiseXOR(line_no.cast("bigint") * 40503).bitwiseAND(F.lit(bits - 1))


def _bitmap(places: DataFrame, n: int) -> np.ndarray:
    """The set bits of n places (row, line_no), as bytes."""
    bits = min(MOST_BITS, max(1 << 15, 1 << (n * PLACE_BITS).bit_length()))
    out = np.zeros((bits >> 15, 1 << 12), np.uint8)
    slots = places.select(_slot(F.col("row"), F.col("line_no"), bits).alias("slot"))
    for block, held in slots.groupBy(F.shiftright("slot", 15).alias("block")).agg(
            F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit((1 << 15) - 1)))).collect():
        out[block] = np.frombuffer(held, np.uint8)
    return out.ravel()


def _placed(bitmap: np.ndarray):
    """(row, line_no, line) from (row, text), for the places whose bit is set."""
    def out(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary()).fill_null(b"").to_pylist()
            count = np.array([x.count(b"\n") + 1 for x in texts], np.int64)
            own = np.repeat(np.arange(len(texts)), count)
            number = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
            rows = batch.column(0).to_numpy()[own]
            slot = _slot(rows, number, 8 * len(bitmap))
            held, split, last = [], [], -1
            for i in np.flatnonzero(bitmap[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).tolist():
                if own[i] != last:
                    last = own[i]
                    split = texts[last].split(b"\n")
                line = normal(split[number[i]])
                if line:
                    held.append((i, line.decode()))
            if held:
                at, lines = zip(*held, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(rows[list(at)]), pa.array(number[list(at)].astype(np.int32)), pa.array(lines, pa.string())],
                                                 ["row", "line_no", "line"])

    return out


def _sets(column: pa.Array) -> list[np.ndarray]:
    hashes, first = _shingles(column.to_pylist())
    return [np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]


def groups(docs: DataFrame, name: str = "lines") -> DataFrame:
    """Each line that has a near-duplicate: row, doc_id, line_no, kept_row, kept_doc_id, kept_line_no, kept.

    row is a hash of doc_id and text, kept_* the line of the group that stays.
    """
    described = materialize(_identified(docs).mapInArrow(
        ta.released(_described), "row bigint, doc_id bigint, line_no int, id bigint, bands array<bigint>"), f"{name}-described")
    buckets = materialize(described.select(F.explode("bands").alias("band"), "id").repartition("band").mapInArrow(
        ta.released(_stars), "u bigint, v bigint, bucket bigint"), f"{name}-buckets")
    coarse = links.components(buckets, f"{name}-coarse").select(F.col("component").alias("coarse"), F.col("node").alias("id"))
    # A class is all equal lines.
    classes = materialize(described.groupBy("id").agg(
        F.min(F.struct("doc_id", "line_no", "row")).alias("first"), F.count("*").alias("n")), f"{name}-classes")
    wanted = materialize(
        classes.join(links.parts(coarse, buckets.select(F.col("u").alias("id"), "bucket")), "id")
        .select("first.row", "first.line_no", "part", "id"), f"{name}-wanted")
    n = wanted.count()
    texts = _identified(docs).select("row", "text").mapInArrow(
        ta.released(_placed(_bitmap(wanted, n))), "row bigint, line_no int, line string")
    sets = texts.join(F.broadcast(wanted) if n <= BROADCAST_ROWS else wanted, ["row", "line_no"]).select("part", "id", "line")
    found = links.components(links.verified(sets, _sets), name)
    repeated = classes.join(found.select(F.col("node").alias("id"), "component"), "id", "left").where(
        "n > 1 or component is not null").withColumn("group", F.coalesce("component", "id"))
    first = repeated.groupBy("group").agg(F.min("first").alias("first"))
    answers = materialize(repeated.select("id", "group").join(first, "group").select("id", "first"), f"{name}-answers")
    lines = described.select("row", "doc_id", "line_no", "id")
    if answers.count() <= BROADCAST_ROWS:
        rows = lines.join(F.broadcast(answers), "id")
    else:
        rows = joins.salted(lines, ["row", "line_no"])
        rows = joins.attach(rows, joins.questions(rows, ["id"]).join(answers, "id"), ["id"]).where("first is not null")
    return rows.select(
        "row", "doc_id", "line_no", F.col("first.row").alias("kept_row"), F.col("first.doc_id").alias("kept_doc_id"),
        F.col("first.line_no").alias("kept_line_no"),
        ((F.col("row") == F.col("first.row")) & (F.col("line_no") == F.col("first.line_no"))).alias("kept")).distinct()


def dedupe(docs: DataFrame, name: str = "lines") -> DataFrame:
    """The documents without the lines that repeat a kept one; their own columns."""
    gone = groups(docs, name).where("not kept").groupBy("row").agg(F.collect_set("line_no").alias("gone"))
    rows = docs.select(F.xxhash64("doc_id", "text").alias("row"), F.struct("*").alias("doc")).join(gone, "row", "left")
    left = F.array_join(F.filter(F.split("doc.text", "\n", -1), lambda x, i: ~F.array_contains("gone", i)), "\n")
    rows = rows.withColumn("left", F.when(F.col("gone").isNull(), F.col("doc.text")).otherwise(left))
    rows = rows.where(F.col("gone").isNull() | F.col("left").rlike(r"[^\x20\x09-\x0D]"))
    columns = {"text": F.col("left"), "n_chars": F.when(
        F.col("gone").isNull(), F.col("doc.n_chars")).otherwise(F.length("left")) if "n_chars" in docs.columns else None}
    return rows.select(*[columns[c].alias(c) if columns.get(c) is not None else F.col("doc")[c].alias(c) for c in docs.columns])
