"""Benchmark items inside documents by size-partitioned MinHash containment.

Items are put into classes by their number of word shingles. A class of large items keeps only the
shingles whose hash is a multiple of the class's scale (a scaled MinHash, whose size does not shrink
against a long document as a fixed number of minima does), so that every sketch has about SKETCH
hashes; small items keep all. A document's shingle hashes meet the sketches in one join; items of
which at least CANDIDATE of the sketch is found are candidates, and their documents are verified on
whole shingles: an item is found if at least LEAST / MOST of its distinct shingles are in the document.
An item with four fifths of its shingles in a document falls under CANDIDATE of a sampled sketch with
probability below 1e-5. Everything is DataFrame functions.

Defined cases: words are compared in lower case; an item with fewer than five words is one shingle,
looked for among the document's runs of as many words; a null or empty item is never found, nor is
anything in a null or empty document; equal items are one, with the smallest item_id; a null item_id is
treated as any other; rows equal in doc_id and text give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeloom.functions.arrays import let
from treeloom.session import materialize

SHINGLE = 5
SKETCH = 64
CANDIDATE = 0.4
MOST, LEAST = 100, 80
#: Sketch and candidate tables up to this number of rows are sent to all tasks; larger ones are joined by a shuffle.
BROADCAST_ROWS = 500_000


def words(text: Column | str) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), "")


def runs(found: Column, size: int, of) -> Column:
    """`of` applied to each run of `size` words."""
    return let(found, lambda w: F.when(F.size(w) >= size, F.transform(
        F.sequence(F.lit(0), F.size(w) - size), lambda i: of([F.get(w, i + k) for k in range(size)]))))


def _hash(run: list[Column]) -> Column:
    return F.xxhash64(*run)


def _text(run: list[Column]) -> Column:
    return F.concat_ws(" ", *run)


def _all(found: Column, sizes: list[int], of) -> Column:
    empty = F.array().cast("array<bigint>" if of is _hash else "array<string>")
    return F.concat(*[F.coalesce(runs(found, n, of), empty) for n in sizes])


def _small(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def items_of(benchmark: DataFrame) -> tuple[DataFrame, list[int]]:
    """Rows (item_id, shingle, total) of the distinct items, and the shingle lengths in use."""
    found = benchmark.select("item_id", words("text").alias("words")).where("size(words) > 0")
    items = found.groupBy("words").agg(F.min("item_id").alias("item_id"))
    of = F.when(F.size("words") < SHINGLE, F.array(F.array_join("words", " "))).otherwise(
        F.array_distinct(runs(F.col("words"), SHINGLE, _text)))
    items = items.select("item_id", F.least(F.size("words"), F.lit(SHINGLE)).alias("length"), of.alias("shingles"))
    # Items that have no id or the same id are told apart by their shingles.
    rows = materialize(items.select(
        "item_id", "length", F.xxhash64("item_id", "shingles").alias("item"), F.size("shingles").alias("total"),
        F.explode("shingles").alias("shingle")), "benchmark-shingles")
    return rows, sorted(r["length"] for r in rows.select("length").distinct().collect())


def contained(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(row, doc_id, item_id, shared, total) for each item found in a document (doc_id, text); row is a hash of both."""
    items, sizes = items_of(benchmark)
    rows = docs.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text")
    if not sizes:
        sizes = [SHINGLE]
    scale = F.greatest(F.lit(1), F.pow(F.lit(2), F.floor(F.log2("total"))) / SKETCH).cast("bigint")
    # An item's shingle has no word of white space, so splitting it gives the words that are hashed.
    by_length = F.split("shingle", " ")
    hashed = F.coalesce(*[F.when(F.size(by_length) == n, F.xxhash64(*[F.get(by_length, F.lit(k)) for k in range(n)])) for n in sizes])
    sketch = (items.withColumn("hash", hashed).where(F.pmod("hash", scale) == 0)
              .groupBy("hash").agg(F.collect_set("item").alias("items")))
    sizes_of = items.withColumn("hash", hashed).where(F.pmod("hash", scale) == 0).groupBy("item").agg(F.count("*").alias("m"))
    hashes = rows.select("row", F.explode(_all(words("text"), sizes, _hash)).alias("hash"))
    shared = (hashes.join(_small(materialize(sketch, "benchmark-sketch")), "hash").distinct()
              .select("row", F.explode("items").alias("item")).groupBy("row", "item").agg(F.count("*").alias("n")))
    candidates = materialize(shared.join(_small(sizes_of), "item").where(F.col("n") >= CANDIDATE * F.col("m")).select("row", "item"),
                             "benchmark-candidates")
    suspects = candidates.select("row").distinct()
    whole = rows.join(_small(suspects), "row", "left_semi").dropDuplicates(["row"]).select(
        "row", "doc_id", F.explode(F.array_distinct(_all(words("text"), sizes, _text))).alias("shingle"))
    found = whole.join(_small(items.select("item", "item_id", "total", "shingle")), "shingle").groupBy(
        "row", "doc_id", "item", "item_id", "total").agg(F.count("*").alias("shared"))
    return found.where(MOST * F.col("shared") >= LEAST * F.col("total")).join(candidates, ["row", "item"], "left_semi").select(
        "row", "doc_id", "item_id", "shared", F.col("total").cast("bigint"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item is found; their own columns."""
    found = materialize(contained(docs, benchmark).select(F.col("row").alias("_found")).distinct(), "benchmark-found")
    return docs.join(_small(found), F.xxhash64("doc_id", "text") == F.col("_found"), "left_anti")
