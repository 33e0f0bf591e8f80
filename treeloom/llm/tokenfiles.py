"""Token-id files: canonical length-limited Huffman codes of the ids, decoded in independent blocks.

Method. The ids of all documents are counted over the whole corpus (one bincount per task, summed by
Spark). Code lengths are those of an optimal prefix code under a length limit (package-merge over the
counted ids, LIMIT bits at most), and codes are canonical: by (length, id) in order, so the table is the
list of (id, length) alone. The ids of a task's documents, in ascending doc_id order, are written as a
bit stream cut into blocks of at most BLOCK ids; a block stores a checkpoint, the bit offset of every
STRIDE-th id, so one block is decoded by STRIDE table steps over all of its lanes at once: the next LIMIT
bits are looked up in a table of 2**LIMIT entries that gives id and length.

The file format is a folder of two Parquet tables (written and read by Spark, so a lost executor only
repeats its task): `codes` (id, length), `blocks` (part, block, first, n_ids, n_bits, checkpoints,
payload, pieces); `pieces` lists the documents in a block as (seq, doc_id, at, offset,
length): `at` is the piece's place in its document, `offset` its place in the block. A document may span
blocks; its crc32 is combined from its pieces in order.

How it runs on Spark: tokenizing is one Arrow task per partition, each word unit tokenized once per worker; ordering is a range partitioning on
(doc_id, text hash, row), so a doc_id that many rows share still spreads over tasks; the start of each
part comes from the per-part totals (one row per part). Only the code table (at most the tokenizer's
vocabulary) is sent to tasks.

Defined cases: a null text is empty and gives only the end id; null doc_ids come first; rows that repeat
a doc_id are each written (by text hash, then place); an empty table writes empty tables and gives no
rows; extra columns are ignored whatever their names; long texts are written whole.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from treeloom.llm import packing
from treeloom.llm import textarrays as ta
from treeloom.session import checkpoint_dir, materialize

END_ID = 1
LIMIT = 20
BLOCK = 1 << 18
STRIDE = 64

_PIECE = "struct<seq:bigint, doc_id:bigint, at:bigint, offset:bigint, length:bigint>"
_BLOCKS = (f"part int, block int, first bigint, n_ids bigint, n_bits bigint, checkpoints array<bigint>, payload binary, "
           f"pieces array<{_PIECE}>")
_DECODED = "part int, seq bigint, doc_id bigint, at bigint, local bigint, length bigint, crc bigint"
RESULT = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"

def tokenized(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, key (text hash), ids (end id appended) and n, their number, of every row. Word units are tokenized
    once per worker and found again by hash (`packing.Ids`), which gives the ids of whole texts. The ids are
    little-endian bytes, two or four an id (see `unpacked`), which a shuffle carries at half the size of an array."""
    def encode(batches):
        ids_of = packing.Ids.of(tokenizer)
        try:
            for batch in batches:
                data, offsets = ta.buffers(batch.column(1))
                for a, b in ta.chunks(offsets):
                    found, _, _ = ids_of.texts(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                    lengths = np.array([len(x) // 4 for x in found], np.int64)
                    ids = np.insert(np.frombuffer(b"".join(found), "<u4"), np.cumsum(lengths), END_ID)
                    ids = ids.astype("<u2" if int(ids.max()) < 1 << 16 else "<u4")
                    bounds = np.concatenate(([0], np.cumsum(lengths + 1))) * ids.itemsize
                    values = pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(ids)])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a),
                         values.cast(pa.binary()), pa.array((lengths + 1).astype(np.int32))], ["doc_id", "key", "ids", "n"])
        finally:
            # The unit tables and tokenizers are large; a reused worker need not carry them into later stages.
            packing._tokenizers.pop(tokenizer, None)
    rows = ta.bounded(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("key"))
    return rows.mapInArrow(ta.released(encode), "doc_id bigint, key bigint, ids binary, n int")


def unpacked(ids: pa.Array, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows of `tokenized`, one after the other, and the bounds of each row's."""
    bounds = np.concatenate(([0], np.cumsum(n, dtype=np.int64)))
    if not len(n):
        return np.zeros(0, np.uint16), bounds
    offsets = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset:ids.offset + len(ids) + 1]
    data, width = ids.buffers()[2], np.diff(offsets) // n
    if width.min() == width.max():
        return np.frombuffer(data, f"<u{width[0]}", int(bounds[-1]), int(offsets[0])), bounds
    return np.concatenate([np.frombuffer(data, f"<u{w}", k, a).astype(np.uint32)
                           for w, k, a in zip(width.tolist(), n.tolist(), offsets.tolist())]), bounds


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of positive counts under a length limit (package-merge)."""
    n = len(counts)
    lengths = np.zeros(n, np.int64)
    if n == 0:
        return lengths
    if n == 1:
        lengths[:] = 1
        return lengths
    if (1 << limit) < n:
        raise ValueError(f"{n} symbols do not fit codes of {limit} bits")
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.int64)
    levels, current = [np.ones(n, bool)], weights
    for _ in range(limit - 1):
        packages = current[: len(current) // 2 * 2].reshape(-1, 2).sum(1)
        merged = np.concatenate([weights, packages])
        leaf = np.concatenate([np.ones(n, bool), np.zeros(len(packages), bool)])
        pick = np.argsort(merged, kind="stable")
        current = merged[pick]
        levels.append(leaf[pick])
    take = 2 * n - 2
    per_sorted = np.zeros(n, np.int64)
    for leaf in reversed(levels):
        chosen = leaf[:take]
        leaves = int(chosen.sum())
        per_sorted[:leaves] += 1
        take = 2 * (take - leaves)
    lengths[order] = per_sorted
    return lengths


def canonical(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Canonical codes: by (length, symbol), each the previous plus one, shifted at each longer length."""
    order = np.lexsort((symbols, lengths))
    codes = np.zeros(len(symbols), np.int64)
    code, previous = 0, 0
    for i in order:
        length = int(lengths[i])
        code <<= length - previous
        codes[i] = code
        code += 1
        previous = length
    return codes


def encode_block(ids: np.ndarray, table_codes: np.ndarray, table_lengths: np.ndarray) -> tuple[bytes, int, np.ndarray]:
    """Payload, bit count and checkpoints (bit offset of every STRIDE-th id) of one block."""
    lengths = table_lengths[ids]
    ends = np.cumsum(lengths)
    starts = ends - lengths
    total, width = int(ends[-1]) if len(ends) else 0, int(lengths.max(initial=0))
    if not total:
        return b"", 0, starts[::STRIDE].astype(np.int64)
    # A row of bits for each id, its code on the left.
    codes = (table_codes[ids] << (32 - lengths)).astype(">u4")
    bits = np.unpackbits(codes.view(np.uint8).reshape(-1, 4), axis=1, count=width)
    return np.packbits(bits[np.arange(width) < lengths[:, None]]).tobytes(), total, starts[::STRIDE].astype(np.int64)


def decode_table(symbols: np.ndarray, lengths: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """Lookup of the next `limit` bits: the id and its code length."""
    order = np.lexsort((symbols, lengths))  # that of the codes, which have no gaps
    entries = 1 << (limit - lengths[order])
    ids, sizes = np.zeros(1 << limit, np.int32), np.zeros(1 << limit, np.int32)
    ids[:entries.sum()], sizes[:entries.sum()] = np.repeat(symbols[order], entries), np.repeat(lengths[order], entries)
    return ids, sizes


def decode_block(payload: bytes, n_ids: int, checkpoints: np.ndarray, ids_of: np.ndarray, size_of: np.ndarray,
                 limit: int = LIMIT) -> np.ndarray:
    """The ids of one block: all lanes (one per checkpoint) step together, STRIDE steps at most."""
    # The last lane may go on beyond the end, as all lanes make all steps.
    data = np.frombuffer(payload + bytes(STRIDE * limit // 8 + 8), np.uint8).astype(np.uint32)
    words = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]  # the 32 bits from each byte on
    out = np.zeros((STRIDE, len(checkpoints)), np.int32)
    position = checkpoints.astype(np.int64)
    for step in range(STRIDE):
        peek = (words[position >> 3] << (position & 7).astype(np.uint32)) >> np.uint32(32 - limit)
        out[step] = ids_of[peek]
        position += size_of[peek]
    return out.T.reshape(-1)[:n_ids]


def write(docs: DataFrame, tokenizer: str, folder: str | None = None) -> str:
    """Encode the ids of all documents into the folder (default: below spark.checkpoint.dir)."""
    spark = docs.sparkSession
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/treeloom-tokens-{uuid.uuid4().hex}"
    ids = materialize(tokenized(docs, tokenizer).withColumn("row", F.monotonically_increasing_id()), "tokens")

    def counted(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            values, _ = unpacked(batch.column(0), batch.column(1).to_numpy())
            found = np.bincount(values, minlength=len(total)) if len(values) else np.zeros(len(total), np.int64)
            if len(found) > len(total):
                total = np.concatenate([total, np.zeros(len(found) - len(total), np.int64)])
            total[: len(found)] += found
        nz = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(nz, pa.int64()), pa.array(total[nz], pa.int64())], ["id", "count"])

    counts = ids.select("ids", "n").mapInArrow(ta.released(counted), "id bigint, count bigint").groupBy("id").agg(F.sum("count").alias("count"))
    table = counts.orderBy("id").toPandas()            # at most the tokenizer's vocabulary
    symbols = table["id"].to_numpy(np.int64)
    lengths = code_lengths(table["count"].to_numpy(np.int64))
    spark.createDataFrame(pd.DataFrame({"id": symbols, "length": lengths}), "id bigint, length bigint") \
        .coalesce(1).write.parquet(f"{folder}/codes")
    size = int(symbols.max(initial=0)) + 1
    code_of, length_of = np.zeros(size, np.int64), np.zeros(size, np.int64)
    code_of[symbols], length_of[symbols] = canonical(symbols, lengths), lengths
    parts = max(1, ids.rdd.getNumPartitions())

    def encoded(batches):
        pending, pieces, seq, first, block, part = [], [], 0, 0, 0, None
        held = 0

        def flush():
            nonlocal pending, pieces, first, block, held
            flat = np.concatenate(pending) if pending else np.zeros(0, np.int64)
            payload, n_bits, checkpoints = encode_block(flat, code_of, length_of)
            row = {"part": part, "block": block, "first": first, "n_ids": len(flat), "n_bits": n_bits,
                   "checkpoints": checkpoints.tolist(), "payload": payload, "pieces": pieces}
            first += len(flat)
            block += 1
            pending, pieces, held = [], [], 0
            return row

        for batch in batches:
            if part is None and batch.num_rows:
                part = int(batch.column(4)[0].as_py())
            values, offsets = unpacked(batch.column(2), batch.column(3).to_numpy())
            doc_ids = batch.column(0).to_pylist()
            out = []
            for i in range(batch.num_rows):
                doc = values[offsets[i]:offsets[i + 1]]
                at = 0
                while at < len(doc):
                    room = BLOCK - held
                    piece = doc[at:at + room].copy()
                    pieces.append({"seq": seq, "doc_id": doc_ids[i], "at": at, "offset": held, "length": len(piece)})
                    pending.append(piece)
                    held += len(piece)
                    at += len(piece)
                    if held == BLOCK:
                        out.append(flush())
                seq += 1
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_arrow_blocks())
        if pending:
            yield pa.RecordBatch.from_pylist([flush()], schema=_arrow_blocks())

    ordered = (ids.repartitionByRange(parts, F.asc_nulls_first("doc_id"), "key", "row")
               .sortWithinPartitions(F.asc_nulls_first("doc_id"), "key", "row")
               .select("doc_id", "key", "ids", "n", F.spark_partition_id().alias("part")))
    ordered.mapInArrow(ta.released(encoded), _BLOCKS).write.parquet(f"{folder}/blocks")
    return folder


def _arrow_blocks() -> pa.Schema:
    piece = pa.struct([("seq", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])
    return pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
                      ("n_bits", pa.int64()), ("checkpoints", pa.list_(pa.int64())), ("payload", pa.binary()),
                      ("pieces", pa.list_(piece))])


def read(spark, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32, decoded block by block."""
    codes = spark.read.parquet(f"{folder}/codes").toPandas()   # at most the tokenizer's vocabulary
    symbols, lengths = codes["id"].to_numpy(np.int64), codes["length"].to_numpy(np.int64)

    def decoded(batches):
        ids_of, size_of = decode_table(symbols, lengths) if len(symbols) else (np.zeros(1 << LIMIT, np.int64),) * 2
        for batch in batches:
            rows = {k: [] for k in ("part", "seq", "doc_id", "at", "local", "length", "crc")}
            for b in batch.to_pylist():
                flat = decode_block(b["payload"], b["n_ids"], np.asarray(b["checkpoints"], np.int64), ids_of, size_of)
                raw = flat.astype("<u4").tobytes()
                for p in b["pieces"]:
                    rows["part"].append(b["part"])
                    rows["seq"].append(p["seq"])
                    rows["doc_id"].append(p["doc_id"])
                    rows["at"].append(p["at"])
                    rows["local"].append(b["first"] + p["offset"] - p["at"])
                    rows["length"].append(p["length"])
                    rows["crc"].append(zlib.crc32(raw[4 * p["offset"]:4 * (p["offset"] + p["length"])]))
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([
                ("part", pa.int32()), ("seq", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()),
                ("local", pa.int64()), ("length", pa.int64()), ("crc", pa.int64())]))

    blocks = spark.read.parquet(f"{folder}/blocks")
    pieces = materialize(blocks.mapInArrow(ta.released(decoded), _DECODED), "token-pieces")
    per_part = pieces.groupBy("part").agg(F.sum("length").alias("n"))
    begins = per_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    split = pieces.groupBy("part", "seq").agg(F.count(F.lit(1)).alias("k"))
    whole = pieces.join(split, ["part", "seq"])
    single = whole.where("k = 1").select("part", "seq", "doc_id", "local", "length", "crc")
    multi = whole.where("k > 1").groupBy("part", "seq").applyInPandas(_combined, "part int, seq bigint, doc_id bigint, local bigint, length bigint, crc bigint")
    docs = single.unionByName(multi).join(F.broadcast(begins), "part")
    return docs.select("doc_id", (F.col("base") + F.col("local")).alias("start"), F.col("length").alias("n_tokens"),
                       F.col("crc").alias("ids_crc32"))


def crc_combine(first: int, second: int, second_bytes: int) -> int:
    """crc32 of two byte strings joined, from their crc32s (the checksum is affine in its input)."""
    zeros = b"\0" * second_bytes
    return zlib.crc32(zeros, first) ^ zlib.crc32(zeros) ^ second


def _combined(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("at")
    crc = 0
    for value, length in zip(group["crc"], group["length"]):
        crc = crc_combine(crc, int(value), 4 * int(length))
    return pd.DataFrame({"part": [group["part"].iloc[0]], "seq": [group["seq"].iloc[0]], "doc_id": [group["doc_id"].iloc[0]],
                         "local": [group["local"].iloc[0]], "length": [int(group["length"].sum())], "crc": [crc]})
