"""The whole run: file tree in, records, graphs and statistics out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treeloom import dims, schema
from treeloom.functions.arrays import rows_of
from treeloom.operators import analysis, enrich, graph, lint, stats, validate
from treeloom.plans import registry
from treeloom.session import materialize
from treeloom.sources import files, snapshots, tables


def imports_of(records: DataFrame) -> DataFrame:
    """(file_path, module_path, language, import_statement) of analysed records."""
    rows = rows_of(records, "analysis.imports", "file_path", "module_path", "language")
    return rows.drop("ord").withColumnRenamed("item", "import_statement")


def call_edges_of(records: DataFrame) -> DataFrame:
    """(file_path, caller, callee) of analysed Python records, each once."""
    callers = F.concat(
        F.coalesce("analysis.functions", F.array().cast(schema.ANALYSIS_FIELDS["functions"])),
        F.flatten(F.coalesce("analysis.classes.methods", F.array().cast(f"array<{schema.ANALYSIS_FIELDS['functions']}>"))))
    rows = rows_of(records.where(F.col("handler") == "python"), callers, "file_path").select("file_path", "item.*")
    edges = rows_of(rows, "calls", "file_path", F.col("name").alias("caller"))
    return edges.select("file_path", "caller", F.col("item").alias("callee")).distinct()


def json_line(columns: list[str]) -> Column:
    """A record as one line of JSON. Absent fields are left out, but `content` is always there."""
    fields = F.struct(*[F.col(f"analysis.{n}").alias(n) for n in schema.ANALYSIS_FIELDS], F.col("data"))
    extra = ["documentation"] if "documentation" in columns else []
    line = F.to_json(F.struct("content", "file_path", "language", fields.alias("analysis"), "metadata", "module_path", *extra))
    return F.when(F.col("content").isNull(), F.regexp_replace(line, r"^\{", '{"content":null,')).otherwise(line)


def write_records(records: DataFrame, out: str) -> None:
    """Writes records as JSON Lines, one folder per module. The rebalance splits a module that holds a
    large share of the rows over several files. `run` gives each run its own folder."""
    lines = records.select("module_path", json_line(records.columns).alias("value"))
    lines.hint("rebalance", "module_path").write.mode("overwrite").partitionBy("module_path").text(out)


def analysed(records: DataFrame, patterns: list[tuple[str, str]] | None = None) -> DataFrame:
    """Records with analysis, computed for those that are not `from_cache`."""
    delta = records.where(~F.col("from_cache")).drop("analysis", "data", "from_cache")
    own = registry.extractors()
    fresh = analysis.analyse(delta.where(~F.col("handler").isin(list(own))) if own else delta, patterns)
    for handler, extract in own.items():
        fresh = fresh.unionByName(extract(delta.where(F.col("handler") == handler)).select(fresh.columns))
    return fresh.unionByName(records.where("from_cache").select(fresh.columns))


def run(
    spark: SparkSession,
    root: str,
    out: str,
    *,
    doc_links_csv: str | None = None,
    cache_path: str | None = None,
    lint_reports: DataFrame | None = None,
    patterns: list[tuple[str, str]] | None = None,
    max_bytes: int = files.MAX_BYTES,
) -> dict[str, DataFrame]:
    """Reads the tree under `root` and writes below `out`: `records` (typed), `jsonl`, `skipped`,
    `dependency_nodes`, `dependency_edges`, `unresolved_imports`, `call_graph`, `lint_stats` and
    `codebase_stats`. Returns the written tables by name.

    All tables of a run are one generation of `out` (`snapshots.Generation`): written into a folder of
    their own and published together by one manifest, so a second run never touches the tables that a
    first one returned or that readers use (`snapshots.read_latest`, `snapshots.table_path`).

    `lint_reports` has one row (file_path, report) per file, the report being a JSON array.

    Files are read once. What is known by path, the cache, lint reports and documentation links, is
    joined to the listing before any file is read, so no exchange carries content; the task that reads
    a file compares its hash with the cached one. The staged records are laid out so that the analysis
    scans only files of its handler that have changed.
    """
    generation = snapshots.Generation(spark, out)
    cache = tables.read_cache(spark, cache_path) if cache_path else spark.createDataFrame([], schema.CACHE)
    links = tables.read_doc_links(spark, doc_links_csv) if doc_links_csv else None
    reports = lint_reports.select("file_path", "report") if lint_reports is not None else None

    def known(listing: DataFrame) -> DataFrame:
        return enrich.known_by_path(listing, cache, links, reports)

    staged = enrich.settle_known(files.read_records(spark, root, max_bytes=max_bytes, known=known))
    staged = generation.stage(staged, "staged", ["handler", "from_cache"])
    skipped = staged.where(F.col("skip_reason").isNotNull()).drop("content")
    found = staged.where(F.col("skip_reason").isNull()).drop("skip_reason")
    records = analysed(found, patterns).drop("lint_results")
    # Handlers that check their record keep it only if it has what the record schema asks for.
    checked = F.col("handler").isin(dims.CHECKED_HANDLERS)
    records = records.withColumn("skip_reason", F.when(checked & ~validate.complete(), F.lit("invalid")))
    everything = generation.write(records, "records")
    records = everything.where(F.col("skip_reason").isNull()).drop("skip_reason")
    reasons = ["file_path", "module_path", "language", "skip_reason"]
    skipped = skipped.select(reasons).unionByName(everything.where(F.col("skip_reason").isNotNull()).select(reasons))
    write_records(records, generation.add("jsonl", "text"))

    resolved = graph.resolve_imports(imports_of(records), records, stage=generation.stage)
    resolved = generation.stage(resolved, "imports")
    lint_counts = spark.createDataFrame([], "violation string, n bigint")
    if lint_reports is not None:
        languages = records.select("file_path", "language")
        lint_counts = lint.lint_stats(lint.lint_events(
            lint_reports.select("file_path", "report").join(languages, "file_path")))
    no_record = skipped.withColumn("metadata", F.lit(None).cast(schema.METADATA))
    totals = ["language", "module_path", "metadata"]
    results = {
        "skipped": skipped.select("file_path", "module_path", "skip_reason"),
        "dependency_nodes": graph.dependency_nodes(records),
        "dependency_edges": graph.dependency_edges(resolved),
        "unresolved_imports": graph.unresolved(resolved),
        "call_graph": graph.call_graph(call_edges_of(records)),
        "lint_stats": lint_counts,
        "codebase_stats": stats.codebase_stats(records.select(totals).unionByName(no_record.select(totals))),
    }
    written = {name: generation.write(frame, name) for name, frame in results.items()}
    if cache_path:
        tables.write_cache(tables.cache_entries(records), cache_path)
    generation.publish()
    return {"records": records, **written}
