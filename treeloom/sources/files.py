"""File trees as frames of files.

Spark's own file sources leave out files whose name starts with `_` or `.` (every `__init__.py`)
and empty files, and keep the whole list of files on the driver. So the tree is listed by tasks,
one level of folders per job, into a table; and files are read by the tasks that hold their rows.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treeloom import dims
from treeloom.functions import text
from treeloom.operators import records
from treeloom.session import materialize

# A cell holds less than 2 GiB; larger files are listed as skipped and never read.
MAX_BYTES = 2_000_000_000

_BATCH_ROWS = 10_000
_BATCH_BYTES = 64 << 20
_TASK_BYTES = 128 << 20

Batches = Iterator[pa.RecordBatch]


def _qualified(spark: SparkSession, root: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toString()


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].strip("/")
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri).rstrip("/"))


def _lister(uri: str) -> Callable[[Batches], Batches]:
    def entries(batches: Batches) -> Batches:
        fs, base = _filesystem(uri)
        local = isinstance(fs, pafs.LocalFileSystem)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = fs.get_file_info(pafs.FileSelector(f"{base}/{folder}", allow_not_found=True))
                for start in range(0, len(found), _BATCH_ROWS):
                    part = [
                        i for i in found[start:start + _BATCH_ROWS]
                        if i.type == pafs.FileType.File
                        # Links to folders are not followed, so a tree never loops.
                        or (i.type == pafs.FileType.Directory and not (local and os.path.islink(i.path)))]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([i.path[len(base) + 1:] for i in part], pa.string()),
                        pa.array([i.type == pafs.FileType.Directory for i in part], pa.bool_()),
                        pa.array([i.size for i in part], pa.int64()),
                    ], ["path", "is_folder", "size"])
    return entries


def listing(spark: SparkSession, root: str) -> DataFrame:
    """Every regular file under `root` once: (file_path, size). No file is opened."""
    lister = _lister(_qualified(spark, root))
    spread = 4 * spark.sparkContext.defaultParallelism
    folders = spark.createDataFrame([("",)], "path string")
    levels = []
    while not levels or not folders.isEmpty():
        found = folders.mapInArrow(lister, "path string, is_folder boolean, size bigint")
        level = materialize(found, "listing")
        levels.append(level.where(~F.col("is_folder")).select(F.col("path").alias("file_path"), "size"))
        folders = level.where("is_folder").select("path").repartition(spread, "path")
    return reduce(DataFrame.unionByName, levels)


def _reader(uri: str) -> Callable[[Batches], Batches]:
    def contents(batches: Batches) -> Batches:
        fs, base = _filesystem(uri)

        def flush(batch: pa.RecordBatch, rows: list[int], data: list) -> pa.RecordBatch:
            kept = batch.take(pa.array(rows, pa.int64()))
            columns = [kept.column(0), kept.column(1), pa.array(data, pa.binary()), *kept.columns[2:]]
            return pa.RecordBatch.from_arrays(columns, ["file_path", "size", "data", *batch.schema.names[2:]])

        for batch in batches:
            rows, data, held = [], [], 0
            for i, path in enumerate(batch.column(0).to_pylist()):
                try:
                    with fs.open_input_stream(f"{base}/{path}") as stream:
                        read = stream.read()
                except FileNotFoundError:
                    continue
                except OSError:
                    read = None
                if rows and held + len(read or b"") > _BATCH_BYTES:
                    yield flush(batch, rows, data)
                    rows, data, held = [], [], 0
                rows.append(i)
                data.append(read)
                held += len(read or b"")
            if rows:
                yield flush(batch, rows, data)
    return contents


def read_bytes(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """(file_path, size, ...) -> adds `data` after size; other columns of the listing ride along, so what
    is known by path reaches the task that reads the file. A file that has gone gives no row, one that
    cannot be read gives null."""
    total = files.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("*").alias("n")).first()
    tasks = max(spark.sparkContext.defaultParallelism, total.bytes // _TASK_BYTES, total.n // _BATCH_ROWS)
    files = files.select("file_path", "size", *[c for c in files.columns if c not in ("file_path", "size")])
    schema = files.schema.fields[:2] + [T.StructField("data", T.BinaryType())] + files.schema.fields[2:]
    return files.repartition(int(tasks), "file_path").mapInArrow(_reader(_qualified(spark, root)), T.StructType(schema))


def typed(files: DataFrame) -> DataFrame:
    """(file_path, size, data) -> adds file_type and is_text, and turns data into content, which is
    null for binary and undecodable files."""
    ext = text.extension(F.col("file_path"))
    known = files.withColumn("file_type", text.file_type(F.col("data"), ext))
    known = known.withColumn("is_text", text.is_text(F.col("file_type"), ext, F.col("data")))
    return known.withColumn(
        "content", F.when(F.col("is_text"), text.decoded(F.col("data")))).drop("data")


def to_records(raw: DataFrame) -> DataFrame:
    """(file_path, size, data) -> records with `skip_reason`. One pass over rows, no shuffle, so it
    takes a stream of files as well."""
    files = records.with_handler(records.with_paths(typed(raw)))
    files = files.withColumn("skip_reason", records.skip_reason(F.col("is_text")))
    return records.assemble(files.drop("file_name", "extension", "module_path", "handler", "ext_language"))


def _unread(files: DataFrame, reason: Column) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return records.assemble(files.withColumns({"content": nothing, "file_type": nothing, "skip_reason": reason}))


def read_records(spark: SparkSession, root: str, max_bytes: int = MAX_BYTES,
                 known: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Records without analysis for every file under `root`; files that give no record carry a
    `skip_reason` and no content. `known` adds columns named `_known_*` to the listing (paths and sizes,
    no content yet); they are kept in the records."""
    files = listing(spark, root)
    if known is not None:
        files = known(files)
    read = to_records(read_bytes(spark, root, files.where(F.col("size") <= max_bytes)))
    return read.unionByName(_unread(files.where(F.col("size") > max_bytes), F.lit("too_large")))


def image_records(spark: SparkSession, root: str) -> DataFrame:
    """Image files by name, size only: no file is opened."""
    names = [ext for ext, handler in dims.HANDLERS.items() if handler == "image"]
    images = listing(spark, root).where(text.extension(F.col("file_path")).isin(names))
    return _unread(images, F.lit(None).cast("string"))


def relative(spark: SparkSession, root: str) -> Column:
    """The `path` of Spark's file sources relative to `root`."""
    prefix = _qualified(spark, root).rstrip("/") + "/"
    return F.when(F.startswith("path", F.lit(prefix)), F.substr("path", F.lit(len(prefix) + 1))).otherwise(F.col("path"))
