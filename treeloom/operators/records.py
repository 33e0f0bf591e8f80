"""File records: paths, dispatch, language and metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeloom import dims
from treeloom.functions import text
from treeloom.operators.enrich import last_per_path


def with_paths(files: DataFrame, root: str | None = None) -> DataFrame:
    """Adds file_name, extension and, where the frame has none, module_path."""
    path = F.col("file_path")
    df = files.withColumns({"file_name": text.file_name(path), "extension": text.extension(path)})
    return df if "module_path" in files.columns else df.withColumn("module_path", text.module_path(path, root))


def with_handler(files: DataFrame) -> DataFrame:
    """Adds the handler and language of the extension by a join to the fixed table (60 rows)."""
    dim = F.broadcast(dims.ext_dim(files.sparkSession))
    return files.join(dim, "extension", "left").withColumn("handler", F.coalesce("handler", F.lit("default")))


def with_language(files: DataFrame) -> DataFrame:
    """Adds the language where the frame has none: by extension, else by content."""
    if "language" in files.columns:
        return files.drop("ext_language")
    return files.withColumn("language", text.language(F.col("ext_language"), F.col("content"))).drop("ext_language")


def metadata(handler: Column, content: Column, size: Column) -> Column:
    """Lines, bytes and content hash. Images and documents have no line count."""
    lines = (
        F.when(handler.isin("image", "document"), F.lit(None))
        .when(handler == "default", text.default_loc(content))
        .otherwise(text.loc(content))
    )
    return F.struct(
        lines.cast("bigint").alias("loc"), size.cast("bigint").alias("size"), F.md5(content).alias("md5_hash"))


def assemble(files: DataFrame, root: str | None = None) -> DataFrame:
    """Records without analysis from (file_path, content, size) and whatever else is known."""
    df = with_language(with_handler(with_paths(files, root)))
    if "file_type" not in df.columns:
        df = df.withColumn("file_type", text.text_type(F.col("content"), F.col("extension")))
    if "size" not in df.columns:
        df = df.withColumn("size", text.byte_size(F.col("content")))
    df = df.withColumn("content", F.when(F.col("handler") != "image", F.col("content")))
    extra = [c for c in df.columns if c == "skip_reason" or c.startswith("_known_")]
    return df.select(
        "file_path", "file_name", "extension", "module_path", "handler", "language", "file_type", "content",
        metadata(F.col("handler"), F.col("content"), F.col("size")).alias("metadata"), *extra,
    )


def skip_reason(is_text: Column) -> Column:
    """Why a file gives no record, null if it gives one. Needs handler, content and module_path."""
    handler, content = F.col("handler"), F.col("content")
    return (
        F.when(~is_text & ~handler.isin("image", "document"), F.lit("binary"))
        .when(content.isNull() & handler.isin(dims.CONTENT_HANDLERS), F.lit("undecodable"))
        .when((handler == "json") & F.try_parse_json(content).isNull(), F.lit("unparsable"))
        .when(F.coalesce(F.col("module_path"), F.lit("")) == "", F.lit("no_module"))
    )


def merge(parts: list[DataFrame]) -> DataFrame:
    """One record per path from several scans, that of the later scan where paths repeat."""
    numbered = [part.withColumn("_scan", F.lit(i)) for i, part in enumerate(parts)]
    return last_per_path(reduce(DataFrame.unionByName, numbered), "file_path", "_scan").drop("_scan")
