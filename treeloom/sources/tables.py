"""JSON Lines, the analysis cache and documentation links."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from treeloom import schema
from treeloom.operators.enrich import last_per_path


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_jsonl(spark: SparkSession, out: str, columns: str) -> DataFrame:
    return spark.read.schema(columns).json(out)


def verify_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Lines that do not parse as JSON; a blank line is one of them."""
    return lines.where(F.try_parse_json(line).isNull())


def verify_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Per file: lines, bad lines, and whether all of them parse. An empty file has no row."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return (
        lines.groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.count("*").alias("lines"), F.count_if(F.try_parse_json("value").isNull()).alias("bad_lines"))
        .withColumn("valid", F.col("bad_lines") == 0)
    )


def jsonl_is_valid(spark: SparkSession, path: str) -> bool:
    """True when every line parses; a missing or empty file is valid."""
    if not _exists(spark, path):
        return True
    return verify_lines(spark.read.option("recursiveFileLookup", "true").text(path)).isEmpty()


def last_link_per_file(links: DataFrame, order: str = "ord") -> DataFrame:
    """(File, Documentation, ord) -> the last row of each File."""
    return last_per_path(links, "File", order).select("File", "Documentation")


def read_doc_links(spark: SparkSession, path: str) -> DataFrame:
    """CSV with the header `File,Documentation`; the last row of a file wins, a missing CSV is empty.
    Fields in quotes may hold doubled quotes and line ends; the file is read by byte ranges in many tasks
    (`read_csv_links`)."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "File string, Documentation string")
    rows = read_csv_links(spark, path)
    return last_link_per_file(rows.select("File", "Documentation", F.struct("csv_file", "offset").alias("ord")))


def cache_entries(records: DataFrame, order: Column | None = None) -> DataFrame:
    """Cache rows of analysed records, the last record of each path kept."""
    rows = records.select(
        "file_path",
        F.md5("content").alias("hash"),
        "analysis",
        "data" if "data" in records.columns else F.lit(None).cast("variant").alias("data"),
        F.col("analysis.function_count").alias("function_count"),
        F.col("analysis.comment_density").alias("comment_density"),
        *([order.alias("_ord")] if order is not None else []),
    )
    return last_per_path(rows, "file_path", "_ord").drop("_ord") if order is not None else rows


def _generations(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished generations of a cache."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(root)]
    return sorted(
        int(name[4:]) for name in names
        if name.startswith("gen=") and _exists(spark, f"{path}/{name}/_SUCCESS"))


def write_cache(entries: DataFrame, path: str) -> str:
    """Writes the cache as a new generation. Readers keep the former one until this one is
    finished, so a cache may be rewritten from itself and a lost job leaves it whole."""
    done = _generations(entries.sparkSession, path)
    target = f"{path}/gen={(done[-1] + 1) if done else 0}"
    entries.write.mode("overwrite").parquet(target)
    return target


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The latest finished generation; an absent cache is empty."""
    done = _generations(spark, path)
    if not done:
        return spark.createDataFrame([], schema.CACHE)
    return spark.read.schema(schema.CACHE).parquet(f"{path}/gen={done[-1]}")


def import_cache(spark: SparkSession, path: str) -> DataFrame:
    """A cache kept as JSON lines, each an object {path: {hash, function_count, comment_density}}."""
    text = spark.read.option("wholetext", "true").text(path)
    entry = "map<string,struct<hash:string,function_count:bigint,comment_density:double>>"
    return text.select(F.explode(F.from_json("value", entry)).alias("file_path", "entry")).select("file_path", "entry.*")


#: Bytes of a CSV file that one task reads.
CSV_RANGE_BYTES = 64 << 20
_QUOTE, _NEWLINE = 0x22, 0x0A


def _csv_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(file, size) of a CSV file or of the visible files in a folder, in name order; a handful at most."""
    fs, root = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), \
        spark._jvm.org.apache.hadoop.fs.Path(path)
    if not fs.exists(root):
        return []
    status = fs.getFileStatus(root)
    found = [status] if status.isFile() else [s for s in fs.listStatus(root) if s.isFile()]
    named = [(s.getPath().toString(), s.getLen()) for s in found]
    return sorted((n, size) for n, size in named if not n.rsplit("/", 1)[-1].startswith(("_", ".")))


def _ranged(action):
    """mapInArrow over (file, start, end, quotes_before) rows, opening each file with pyarrow."""
    def run(batches):
        from treeloom.sources.files import _filesystem
        for batch in batches:
            out = [action(_filesystem(f), f, s, e, q) for f, s, e, q in zip(*[batch.column(i).to_pylist() for i in range(4)])]
            yield from (b for b in out if b is not None)
    return run


def _quotes(handle, file, start, end, _):
    (fs, local), = [handle]
    with fs.open_input_file(local) as stream:
        data = stream.read_at(end - start, start)
    import numpy as np
    count = int(np.count_nonzero(np.frombuffer(data, np.uint8) == _QUOTE))
    return pa.RecordBatch.from_pydict({"csv_file": [file], "start": [start], "quotes": [count]},
                                      schema=pa.schema([("csv_file", pa.string()), ("start", pa.int64()), ("quotes", pa.int64())]))


def _records(handle, file, start, end, before):
    """The records that begin in [start, end): a record begins at 0 or after a newline outside quotes."""
    import csv
    import io
    import numpy as np
    (fs, local), = [handle]
    with fs.open_input_file(local) as stream:
        size = stream.size()
        begin = max(0, start - 1)
        data = stream.read_at(end - begin, begin)
        parity = before - (1 if begin < start and data[:1] == b'"' else 0)
        b = np.frombuffer(data, np.uint8)
        inside = (parity + np.cumsum(b == _QUOTE) - (b == _QUOTE)) % 2
        ends = np.flatnonzero((b == _NEWLINE) & (inside == 0)) + begin
        first = 0 if start == 0 else next((int(p) + 1 for p in ends if p + 1 >= start), None)
        if first is None or first >= end:
            return None
        # read on past `end` to the end of the last record that begins before it
        tail, at, odd = bytearray(), end, int((parity + int((b == _QUOTE).sum())) % 2)
        last = next((int(p) for p in ends[::-1] if p >= end - 1), None)
        while last is None and at < size:
            chunk = stream.read_at(min(1 << 20, size - at), at)
            c = np.frombuffer(chunk, np.uint8)
            inner = (odd + np.cumsum(c == _QUOTE) - (c == _QUOTE)) % 2
            hits = np.flatnonzero((c == _NEWLINE) & (inner == 0))
            if len(hits):
                tail += chunk[:hits[0] + 1]
                last = at + int(hits[0])
                break
            tail += chunk
            odd = int((odd + int((c == _QUOTE).sum())) % 2)
            at += len(chunk)
    text = (bytes(data[first - begin:]) + bytes(tail)).decode("utf-8", errors="replace")
    rows = list(csv.reader(io.StringIO(text, newline="")))
    # where each record begins: the boundaries found above, in the same order as the parsed records
    starts = [first] + [int(p) + 1 for p in ends if first < p + 1 < end]
    kept = [(at, r) for at, r in zip(starts, rows) if r][1 if start == 0 else 0:]   # blank lines and the header go
    return pa.RecordBatch.from_pydict({
        "csv_file": [file] * len(kept), "offset": [at for at, _ in kept],
        "File": [r[0] for _, r in kept], "Documentation": [r[1] if len(r) > 1 else None for _, r in kept]},
        schema=pa.schema([("csv_file", pa.string()), ("offset", pa.int64()), ("File", pa.string()), ("Documentation", pa.string())]))


def read_csv_links(spark: SparkSession, path: str, range_bytes: int = CSV_RANGE_BYTES) -> DataFrame:
    """(csv_file, offset, File, Documentation) of the records of quoted CSV files with the header
    `File,Documentation`, read by byte ranges in many tasks. Fields in quotes may hold doubled quotes and
    line ends: a newline ends a record only after an even number of quotes, and each range learns the
    quotes before it from a first pass (one count per range, summed by a window)."""
    files = [(f, size) for f, size in _csv_files(spark, path) if size > 0]
    if not files:
        return spark.range(0).select(F.lit(None).cast("string").alias("csv_file"), F.col("id").alias("offset"),
                                     F.lit(None).cast("string").alias("File"), F.lit(None).cast("string").alias("Documentation"))
    parts = [spark.range(0, size, range_bytes).select(
        F.lit(f).alias("csv_file"), F.col("id").alias("start"), F.least(F.col("id") + range_bytes, F.lit(size)).alias("end"),
        F.lit(0).cast("bigint").alias("before")) for f, size in files]
    table = reduce(DataFrame.unionByName, parts)
    n_ranges = sum(-(-size // range_bytes) for _, size in files)
    counted = table.repartition(n_ranges).mapInArrow(_ranged(_quotes), "csv_file string, start bigint, quotes bigint")
    before = F.sum("quotes").over(Window.partitionBy("csv_file").orderBy("start")) - F.col("quotes")
    placed = table.drop("before").join(counted.select("csv_file", "start", before.alias("before")), ["csv_file", "start"])
    return placed.select("csv_file", "start", "end", "before").mapInArrow(
        _ranged(_records), "csv_file string, offset bigint, File string, Documentation string")
