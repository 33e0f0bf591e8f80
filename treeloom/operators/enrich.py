"""Enrichment of records from the analysis cache and from documentation links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeloom import schema


def with_cache(records: DataFrame, cache: DataFrame, fields: list[str]) -> DataFrame:
    """Takes `fields` from the cache where path and content hash agree, and adds `from_cache`.

    Both sides have one row per path, so the join key is never hot. The join is on the path alone:
    records that are joined by path with other tables as well are exchanged once for all of them.
    Null content matches nothing.
    """
    known = cache.select(
        "file_path", F.col("hash").alias("_hash"), *[F.col(f).alias(f"_cached_{f}") for f in fields])
    joined = records.join(known, "file_path", "left")
    hit = F.coalesce(F.col("_hash") == F.md5("content"), F.lit(False))
    joined = joined.withColumn("from_cache", hit)
    # A cached analysis replaces the fresh one even where a field of it is null.
    taken = []
    for f in fields:
        cached = F.when(F.col("from_cache"), F.col(f"_cached_{f}"))
        taken.append((cached.otherwise(F.col(f)) if f in records.columns else cached).alias(f))
    return joined.select(*[c for c in records.columns if c not in fields], *taken, "from_cache")


def cache_delta(records: DataFrame, cache: DataFrame) -> DataFrame:
    """Records whose content is not in the cache: those that must be analysed."""
    known = cache.where(F.col("hash").isNotNull()).select("file_path", "hash")
    return records.withColumn("hash", F.md5("content")).join(known, ["file_path", "hash"], "left_anti").drop("hash")


def with_documentation(records: DataFrame, links: DataFrame) -> DataFrame:
    """Adds `documentation` by path. The planner broadcasts the links when they are small."""
    return records.join(
        links.select(F.col("File").alias("file_path"), F.col("Documentation").alias("documentation")),
        "file_path", "left")


def last_per_path(df: DataFrame, path: str, order: str) -> DataFrame:
    """The last row of each path by `order`."""
    rest = [c for c in df.columns if c != path]
    return df.groupBy(path).agg(F.max_by(F.struct(*rest), order).alias("_row")).select(path, "_row.*")


def known_by_path(files: DataFrame, cache: DataFrame | None = None, links: DataFrame | None = None,
                  lint_reports: DataFrame | None = None, fields: tuple[str, ...] = ("analysis", "data")) -> DataFrame:
    """The listing (file_path, size) with what is known of each path before a file is read: the cache's
    hash and `fields` as `_known_hash`, `_known_<field>`; documentation as `_known_documentation`; the
    lint report as `_known_lint`. Only paths and these values are exchanged; no content exists yet.
    Each side has one row per path (links: the last one), so no key is hot."""
    out = files
    if cache is not None:
        out = out.join(cache.select("file_path", F.col("hash").alias("_known_hash"),
                                    *[F.col(f).alias(f"_known_{f}") for f in fields]), "file_path", "left")
    if links is not None:
        out = out.join(links.select(F.col("File").alias("file_path"), F.col("Documentation").alias("_known_documentation")),
                       "file_path", "left")
    if lint_reports is not None:
        out = out.join(lint_reports.select("file_path", F.col("report").alias("_known_lint")), "file_path", "left")
    return out


def settle_known(records: DataFrame, fields: tuple[str, ...] = ("analysis", "data")) -> DataFrame:
    """Records read with `_known_*` columns: compares the content's hash with the cached one in the row
    (the reading task) and takes the cached `fields` on a match (`from_cache`); turns the other known
    values into `documentation` and `lint_results`. Null content matches nothing. No exchange."""
    known = set(records.columns)
    hit = F.coalesce(F.col("_known_hash") == F.md5("content"), F.lit(False)) if "_known_hash" in known else F.lit(False)
    out = records.withColumn("from_cache", hit)
    for f in fields:
        cached = F.when(F.col("from_cache"), F.col(f"_known_{f}")) if f"_known_{f}" in known else F.lit(None)
        out = out.withColumn(f, cached.cast(schema.ANALYSIS if f == "analysis" else "variant"))
    if "_known_documentation" in known:
        out = out.withColumn("documentation", F.col("_known_documentation"))
    if "_known_lint" in known:
        out = out.withColumn("lint_results", F.try_parse_json("_known_lint"))
    return out.drop(*[c for c in out.columns if c.startswith("_known_")])
