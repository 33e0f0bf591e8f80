"""op11: Huffman token files against direct tokenization, and the code against its own decoder."""

import heapq
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

from conftest import SF_DIR
from treeloom.llm import tokenfiles as tf
from treeloom.llm import queries as q


def tokenizer():
    from public_tokenizers import path
    return path("word_bpe_49k.json")


def huffman_cost(counts):
    heap = list(counts)
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a + b
        heapq.heappush(heap, a + b)
    return cost


@pytest.mark.parametrize("seed", range(5))
def test_lengths_are_optimal_and_limited(seed):
    rng = np.random.default_rng(seed)
    counts = rng.zipf(1.3, size=300).astype(np.int64)
    free = tf.code_lengths(counts, 30)
    assert (free * counts).sum() == huffman_cost(counts.tolist())
    limited = tf.code_lengths(counts, 10)
    assert limited.max() <= 10 and (2.0 ** -limited).sum() <= 1 + 1e-12
    assert (limited * counts).sum() >= (free * counts).sum()


def test_blocks_round_trip_with_checkpoints():
    rng = np.random.default_rng(1)
    ids = rng.zipf(1.2, size=5000).astype(np.int64) % 3000
    symbols = np.unique(ids)
    lengths = tf.code_lengths(np.bincount(ids)[symbols])
    codes, sizes = np.zeros(3000, np.int64), np.zeros(3000, np.int64)
    codes[symbols], sizes[symbols] = tf.canonical(symbols, lengths), lengths
    payload, bits, checkpoints = tf.encode_block(ids, codes, sizes)
    assert bits == int(sizes[ids].sum()) and len(checkpoints) == -(-len(ids) // tf.STRIDE)
    ids_of, size_of = tf.decode_table(symbols, lengths)
    assert (tf.decode_block(payload, len(ids), checkpoints, ids_of, size_of) == ids).all()


def test_crc_combine():
    a, b = b"hello world", b"\x00\x01" * 999
    assert tf.crc_combine(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def expected(rows):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer())
    keyed = []
    for place, (doc_id, text) in enumerate(rows):
        key = xxhash.xxh64_intdigest((text or "").encode(), seed=42)
        key = key - (1 << 64) if key >= 1 << 63 else key
        ids = tok.encode(text or "", add_special_tokens=False).ids + [tf.END_ID]
        keyed.append(((doc_id is not None, doc_id or 0, key, place), doc_id, ids))
    out, start = [], 0
    for _, doc_id, ids in sorted(keyed):
        out.append((doc_id, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=lambda r: (r[1]))


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return sorted((tuple(r) for r in tf.read(spark, tf.write(df, tokenizer())).collect()), key=lambda r: r[1])


def test_defined_cases_and_documents_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(tf, "BLOCK", 50)
    long = " ".join(f"word{i % 77}" for i in range(3000))
    rows = [(3, "Hello world."), (1, None), (None, "a b c"), (2, ""), (3, "Hello world."), (5, long), (4, "ünïcode ✓ text")]
    assert run(spark, rows) == expected(rows)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert tf.read(spark, tf.write(empty, tokenizer())).count() == 0
    df = spark.createDataFrame([(1, "x y", 9, "p", 3)], "doc_id bigint, text string, key bigint, ids string, part int")
    assert [tuple(r) for r in tf.read(spark, tf.write(df, tokenizer())).collect()] == expected([(1, "x y")])


def test_query_equals_direct_tokenization(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF_DIR}/documents.parquet'").fetchall()
    got = sorted((tuple(r) for r in q.op11_huffman_token_files(spark, SF_DIR).collect()), key=lambda r: r[1])
    assert got == expected(rows)


def test_texts_reach_python_in_small_batches(spark):
    """The default batch of 10,000 rows holds 10,000 texts and their ids at once in every task."""
    from treeloom.llm import textarrays
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, "10000")
    tf.tokenized(spark.createDataFrame([(1, "a")], "doc_id bigint, text string"), "unused")
    assert spark.conf.get(key) == textarrays.BATCH_ROWS


def test_ids_travel_as_two_bytes(spark):
    """As an array of integers each id takes four bytes of a shuffle."""
    import pyarrow as pa
    rows = [(1, None), (2, "a b c " * 50), (3, "ünïcode ✓ text")]
    got = tf.tokenized(spark.createDataFrame(rows, "doc_id bigint, text string"), tokenizer()).orderBy("doc_id").toPandas()
    assert [len(x) for x in got.ids] == [2 * n for n in got.n] and got.n[0] == 1
    wide = np.array([70000, 1], "<u4").tobytes()  # of another vocabulary
    values, bounds = tf.unpacked(pa.array([got.ids[0], wide, got.ids[2]], pa.binary())[1:], np.array([2, got.n[2]]))
    assert values[:2].tolist() == [70000, 1] and bounds.tolist() == [0, 2, 2 + got.n[2]]
    assert (values[2:] == np.frombuffer(got.ids[2], "<u2")).all()


def test_a_block_of_full_lanes_and_one_of_few_ids_are_decoded():
    """Lanes step without masks, the last one beyond its ids."""
    rng = np.random.default_rng(2)
    for n in (0, 1, 63, 64, 65, 128):
        ids = rng.integers(0, 900, n)
        symbols, lengths = np.arange(900), tf.code_lengths(1 + 2 ** (np.arange(900) // 40))
        payload, bits, checkpoints = tf.encode_block(ids, tf.canonical(symbols, lengths), lengths)
        assert len(payload) == -(-bits // 8) and lengths.max() > 16
        out = tf.decode_block(payload, n, checkpoints, *tf.decode_table(symbols, lengths))
        assert out.tolist() == ids.tolist()
