"""Corpus totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def codebase_stats(records: DataFrame) -> DataFrame:
    """Files, lines and bytes in all (`total`), per language and per module as (scope, key, ...).

    A record without `loc` counts as a file only; one without `size` still adds its lines. Rows
    are first summed per language and module, so the grouping sets expand only those sums.
    """
    loc, size = F.col("metadata.loc"), F.col("metadata.size")
    full = loc.isNotNull() & size.isNotNull()
    sums = records.groupBy("language", "module_path").agg(
        F.count("*").alias("n"),
        F.sum(loc).alias("loc"),
        F.sum(F.when(loc.isNotNull(), size)).alias("size"),
        F.count_if(full).alias("full_n"),
        F.sum(F.when(full, loc)).alias("full_loc"),
        F.sum(F.when(full, size)).alias("full_size"),
    )
    added = [F.sum(c).alias(c) for c in ("n", "loc", "size", "full_n", "full_loc", "full_size")]
    # The total is an aggregate of its own, because it has a row even for an empty corpus.
    total = sums.agg(*added).select(
        F.lit("total").alias("scope"), F.lit(None).cast("string").alias("key"),
        *[F.coalesce(c, F.lit(0)).alias(name) for c, name in (("n", "files"), ("loc", "loc"), ("size", "size"))])
    sets = sums.groupingSets(
        [[F.col("language")], [F.col("module_path")]], F.col("language"), F.col("module_path")
    ).agg(F.grouping("module_path").alias("by_language"), *added)
    by_language = F.col("by_language") == 1
    groups = sets.where(~by_language | (F.col("full_n") > 0)).select(
        F.when(by_language, "language").otherwise("module").alias("scope"),
        F.when(by_language, F.col("language")).otherwise(F.col("module_path")).alias("key"),
        F.when(by_language, F.col("full_n")).otherwise(F.col("n")).alias("files"),
        F.when(by_language, F.col("full_loc")).alias("loc"),
        F.when(by_language, F.col("full_size")).alias("size"),
    )
    return total.unionByName(groups)


def skipped_files(records: DataFrame) -> DataFrame:
    """Number of files without a record, per reason."""
    return (
        records.where(F.col("skip_reason").isNotNull())
        .groupBy("skip_reason").agg(F.count("*").alias("files"))
    )
