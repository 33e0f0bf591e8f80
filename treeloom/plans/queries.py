"""The queries of `__spark_entry__`: each reads whole tables and gives flat rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeloom.functions import css, entities, markup, metrics, pycode, script, structured, text
from treeloom.functions.arrays import rows_of, with_last_per_key
from treeloom.operators import analysis, definitions, enrich, graph, lint, records, stats, validate
from treeloom.session import materialize
from treeloom.sources import corpora, files, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _exploded(df: DataFrame, array, *, names: list[str]) -> DataFrame:
    """One row per array element: file_path, ord, and the element or its fields as `names`."""
    rows = rows_of(df, array, "file_path").withColumn("ord", F.col("ord").cast("bigint"))
    if len(names) == 1:
        return rows.select("file_path", "ord", F.col("item").alias(names[0]))
    return rows.select("file_path", "ord", *[F.col("item")[n].alias(n) for n in names])


# Text files

@query
def codebase_stats(spark, sf_dir):
    return stats.codebase_stats(records.assemble(corpora.text_files(spark, sf_dir)))


@query
def loc_size(spark, sf_dir):
    return corpora.text_files(spark, sf_dir).select(
        "file_path", text.loc(F.col("content")).alias("loc"), text.byte_size(F.col("content")).alias("size"))


@query
def content_hash(spark, sf_dir):
    return corpora.text_files(spark, sf_dir).groupBy(F.md5("content").alias("md5_hash")).agg(F.count("*").alias("files"))


@query
def text_records(spark, sf_dir):
    return records.assemble(corpora.text_files(spark, sf_dir)).select(
        "file_path", "file_name", "extension", "module_path", "handler", "language", "file_type", "content",
        F.col("metadata.loc").alias("loc"), F.col("metadata.size").alias("size"),
        F.col("metadata.md5_hash").alias("md5_hash"))


@query
def merged_records(spark, sf_dir):
    """Two scans of the text files, the second of every fourth file under another language."""
    first = corpora.text_files(spark, sf_dir).select("file_path", "language", F.md5("content").alias("md5_hash"))
    again = corpora.text_files(spark, sf_dir).where(F.col("doc_id") % 4 == 0).select(
        "file_path", F.lit("text").alias("language"), F.md5(F.concat("content", F.lit("!"))).alias("md5_hash"))
    return records.merge([first, again])


@query
def entity_rows(spark, sf_dir):
    return _exploded(corpora.text_files(spark, sf_dir), entities.entities(F.col("content")), names=["text", "label"])


@query
def validate_records(spark, sf_dir):
    return validate.validated(corpora.broken_records(spark, sf_dir)).select("doc_id", "first_failure", "analysis_warning")


@query
def schema_check(spark, sf_dir):
    checked = validate.schema_check(corpora.record_lines(spark, sf_dir))
    return checked.select("doc_id", F.array_join("violations", ",").alias("violations"), "first_failure")


@query
def doc_links(spark, sf_dir):
    links = tables.last_link_per_file(corpora.doc_links(spark, sf_dir))
    linked = enrich.with_documentation(corpora.text_files(spark, sf_dir), links)
    return linked.select("file_path", "module_path", "documentation")


@query
def doc_links_csv(spark, sf_dir):
    """The links written as a quoted CSV (quotes, commas and line ends in fields) and read back by byte ranges."""
    import uuid
    from treeloom.session import checkpoint_dir
    links = corpora.doc_links(spark, sf_dir).select(
        "File", F.concat(F.lit('see "'), "Documentation", F.lit('"\nand, more')).alias("Documentation"), "ord")
    path = f"{checkpoint_dir(spark).rstrip('/')}/treeloom-links-{uuid.uuid4().hex}"
    links.orderBy("File", "ord").select("File", "Documentation").write.option("header", True) \
        .option("quoteAll", True).option("escape", '"').csv(path)
    linked = enrich.with_documentation(corpora.text_files(spark, sf_dir), tables.read_doc_links(spark, path))
    return linked.select("file_path", "module_path", "documentation")


@query
def cache_hits(spark, sf_dir):
    docs = corpora.text_files(spark, sf_dir).withColumn("function_count", F.lit(-1).cast("bigint"))
    found = enrich.with_cache(docs, corpora.former_cache(corpora.text_files(spark, sf_dir)), ["function_count"])
    return found.select("file_path", "function_count", "from_cache")


@query
def cache_delta(spark, sf_dir):
    docs = corpora.text_files(spark, sf_dir)
    return enrich.cache_delta(docs, corpora.former_cache(docs)).select("file_path")


@query
def analysis_cache(spark, sf_dir):
    analysed = analysis.analyse(records.assemble(corpora.text_files(spark, sf_dir)))
    return tables.cache_entries(analysed).select(
        "file_path", "hash", "function_count", "comment_density",
        F.size("analysis.entities").cast("bigint").alias("n_entities"))


# Raw files

@query
def file_type(spark, sf_dir):
    return corpora.byte_files(spark, sf_dir).select(
        "file_path", text.file_type(F.col("data"), text.extension(F.col("file_path"))).alias("file_type"))


@query
def text_filter(spark, sf_dir):
    typed = files.typed(corpora.byte_files(spark, sf_dir))
    return typed.select("file_path", "is_text", (~F.col("is_text")).alias("is_binary"), F.md5("content").alias("content_md5"))


@query
def nul_filter(spark, sf_dir):
    return corpora.byte_files(spark, sf_dir).select("file_path", text.has_nul(F.col("data")).alias("has_nul"))


@query
def skipped_files(spark, sf_dir):
    return stats.skipped_files(files.to_records(corpora.byte_files(spark, sf_dir)))


@query
def image_records(spark, sf_dir):
    kept = files.to_records(corpora.byte_files(spark, sf_dir)).where(F.col("handler").isin("image", "document"))
    return kept.select("file_path", "language", "content", F.col("metadata.loc").alias("loc"), F.col("metadata.size").alias("size"))


@query
def default_records(spark, sf_dir):
    kept = files.to_records(corpora.byte_files(spark, sf_dir)).where(F.col("handler") == "default")
    return kept.select("file_path", "language", "file_type", "skip_reason", F.col("metadata.loc").alias("loc"), F.col("metadata.size").alias("size"))


# HTML, CSS and XML

def _html(spark, sf_dir):
    return corpora.html_files(spark, sf_dir).select("file_path", markup.html_tokens(F.col("content")).alias("tokens"))


def _attributes(df: DataFrame, lower: bool) -> DataFrame:
    last = with_last_per_key(df.withColumn("elements", markup.elements(F.col("tokens"), lower)), "elements", "tag")
    tags = rows_of(last, "elements", "file_path").select("file_path", "item.*")
    rows = rows_of(tags, markup.attributes(F.col("raw"), lower), "file_path", "tag")
    return rows.select("file_path", "tag", "item.name", "item.value")


@query
def html_tags(spark, sf_dir):
    return _exploded(_html(spark, sf_dir), markup.tags(F.col("tokens")), names=["tag"])


@query
def html_attributes(spark, sf_dir):
    return _attributes(_html(spark, sf_dir), lower=True)


@query
def html_comments(spark, sf_dir):
    return _exploded(_html(spark, sf_dir), markup.comments(F.col("tokens")), names=["comment"])


@query
def css_rules(spark, sf_dir):
    sheets = _html(spark, sf_dir).select("file_path", css.rules(markup.style_text(F.col("tokens"))).alias("rules"))
    return _exploded(sheets, F.col("rules.selector"), names=["selector"])


@query
def css_properties(spark, sf_dir):
    sheets = _html(spark, sf_dir).select("file_path", css.rules(markup.style_text(F.col("tokens"))).alias("rules"))
    last = rows_of(with_last_per_key(sheets, "rules", "selector"), "rules", "file_path").select("file_path", "item.*")
    return rows_of(last, "props", "file_path", "selector").select(
        "file_path", "selector", F.col("ord").cast("bigint"), F.col("item").alias("property"))


def _xml(spark, sf_dir):
    return corpora.xml_files(spark, sf_dir).select("file_path", markup.xml_tokens(F.col("content")).alias("tokens"))


@query
def xml_tags(spark, sf_dir):
    return _exploded(_xml(spark, sf_dir), markup.tags(F.col("tokens"), lower=False), names=["tag"])


@query
def xml_attributes(spark, sf_dir):
    return _attributes(_xml(spark, sf_dir), lower=False)


# JSON, YAML and Markdown

@query
def json_data(spark, sf_dir):
    parsed = corpora.json_files(spark, sf_dir).select("file_path", structured.json_value(F.col("content")).alias("v"))
    return parsed.where(F.col("v").isNotNull()).select(
        "file_path", F.try_variant_get("v", "$.k", "bigint").alias("k"), F.to_json("v").alias("data"))


@query
def json_keys(spark, sf_dir):
    parsed = corpora.json_files(spark, sf_dir).select(structured.json_value(F.col("content")).alias("v"))
    members = parsed.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
    return members.groupBy("key", F.schema_of_variant("value").alias("type")).agg(F.count("*").alias("n"))


@query
def verify_jsonl(spark, sf_dir):
    lines = corpora.json_lines(spark, sf_dir)
    bad = F.try_parse_json("value").isNull()
    return lines.groupBy("file").agg(
        F.count("*").alias("lines"), F.count_if(bad).alias("bad_lines"), F.bool_and(~bad).alias("valid"))


@query
def yaml_keys(spark, sf_dir):
    return _exploded(corpora.yaml_files(spark, sf_dir), structured.yaml_scalars(F.col("content")), names=["key", "value", "type"])


@query
def yaml_data(spark, sf_dir):
    parsed = structured.with_yaml_value(corpora.yaml_files(spark, sf_dir))
    return parsed.select(
        "file_path", F.try_variant_get("yaml", "$.key", "bigint").alias("key"),
        F.try_variant_get("yaml", "$.name", "string").alias("name"),
        F.try_variant_get("yaml", "$.ready", "boolean").alias("ready"))


@query
def md_outline(spark, sf_dir):
    rows = _exploded(corpora.markdown_files(spark, sf_dir), structured.headings(F.col("content")), names=["level", "text"])
    return rows.withColumn("level", F.col("level").cast("bigint"))


@query
def md_links(spark, sf_dir):
    return _exploded(corpora.markdown_files(spark, sf_dir), structured.links(F.col("content")), names=["text", "target"])


# Code

def _python(spark, sf_dir):
    return corpora.code_files(spark, sf_dir).where(F.col("language") == "python")


def _script(spark, sf_dir):
    return corpora.code_files(spark, sf_dir).where(F.col("language").isin("javascript", "typescript"))


def _definitions(spark, sf_dir):
    return definitions.definitions(_python(spark, sf_dir))


@query
def dispatch(spark, sf_dir):
    code = records.with_handler(records.with_paths(corpora.code_files(spark, sf_dir)))
    return code.groupBy("extension", "handler").agg(F.count("*").alias("files"))


@query
def module_path(spark, sf_dir):
    return corpora.code_files(spark, sf_dir).select("file_path", text.module_path(F.col("file_path")).alias("module_path"))


@query
def language_guess(spark, sf_dir):
    code = corpora.code_files(spark, sf_dir).drop("language")
    return records.with_language(records.with_handler(records.with_paths(code))).select("file_path", "language")


@query
def docstrings(spark, sf_dir):
    rows = rows_of(pycode.with_docstrings(_python(spark, sf_dir)), "docstrings", "file_path")
    return rows.select("file_path", "item.name", "item.doc")


@query
def py_comments(spark, sf_dir):
    return _exploded(_python(spark, sf_dir), pycode.comments(F.col("content")), names=["comment"])


@query
def py_imports(spark, sf_dir):
    return _exploded(_python(spark, sf_dir), pycode.imports(F.col("content")), names=["import_statement"])


@query
def py_classes(spark, sf_dir):
    return definitions.methods(_definitions(spark, sf_dir)).select(
        "file_path", "class_name", "name", F.array_join("params", ",").alias("params"))


@query
def py_functions(spark, sf_dir):
    return definitions.functions(_definitions(spark, sf_dir)).select(
        "file_path", "name", F.array_join("params", ",").alias("params"))


@query
def call_edges(spark, sf_dir):
    return definitions.call_edges(_definitions(spark, sf_dir))


@query
def call_graph(spark, sf_dir):
    return graph.call_graph(definitions.call_edges(_definitions(spark, sf_dir)))


@query
def def_complexity(spark, sf_dir):
    return _definitions(spark, sf_dir).where(F.col("kind") == "def").select("file_path", "name", "complexity")


@query
def complexity(spark, sf_dir):
    code = corpora.code_files(spark, sf_dir).where(F.col("language").isin("python", "typescript"))
    value = F.when(F.col("language") == "python", pycode.complexity(F.col("content"))).otherwise(
        script.complexity(F.col("content")))
    return code.select("file_path", value.alias("complexity"))


@query
def js_functions(spark, sf_dir):
    rows = _exploded(_script(spark, sf_dir), script.functions(F.col("content")), names=["name", "params"])
    return rows.withColumn("params", F.array_join("params", ","))


@query
def js_imports(spark, sf_dir):
    return _exploded(_script(spark, sf_dir), script.imports(F.col("content")), names=["import_statement"])


@query
def js_comments(spark, sf_dir):
    return _exploded(_script(spark, sf_dir), script.comments(F.col("content")), names=["comment"])


def _metrics(spark, sf_dir):
    # Laid out by handler, so that each branch of the analysis reads its own files only.
    staged = materialize(records.assemble(corpora.code_files(spark, sf_dir)), "records", ["handler"])
    return analysis.analyse(staged).select("file_path", "language", "content", "analysis.*", "metadata.*")


@query
def function_count(spark, sf_dir):
    return _metrics(spark, sf_dir).select("file_path", "function_count")


@query
def comment_density(spark, sf_dir):
    code = corpora.code_files(spark, sf_dir)
    comments = F.when(F.col("language") == "python", pycode.comments(F.col("content"))).otherwise(
        script.comments(F.col("content")))
    return code.select("file_path", F.round(metrics.comment_density(comments, text.loc(F.col("content"))), 6).alias("comment_density"))


@query
def file_records(spark, sf_dir):
    return _metrics(spark, sf_dir).select(
        "file_path", "language", "md5_hash", "loc", "size",
        F.coalesce(F.size("classes"), F.lit(0)).cast("bigint").alias("n_classes"),
        F.size("functions").cast("bigint").alias("n_functions"),
        F.size("imports").cast("bigint").alias("n_imports"),
        F.size("comments").cast("bigint").alias("n_comments"),
        F.coalesce(F.size("docstrings"), F.lit(0)).cast("bigint").alias("n_docstrings"),
        F.coalesce("complexity", F.lit(0)).cast("bigint").alias("complexity"),
        "function_count", F.round("comment_density", 6).alias("comment_density"))


def _resolved(spark, sf_dir):
    """Every import of the code base, resolved against all its files. The files and their imports are extracted once; resolution looks at them several times."""
    found = F.when(F.col("language") == "python", pycode.imports(F.col("content"))).otherwise(
        script.imports(F.col("content")))
    code = materialize(corpora.code_files(spark, sf_dir).select(
        "file_path", "module_path", "language", found.alias("imports")), "imports")
    rows = rows_of(code, "imports", "file_path", "module_path", "language").drop("ord")
    return graph.resolve_imports(rows.withColumnRenamed("item", "import_statement"), code.drop("imports"), stage=materialize)


@query
def import_resolution(spark, sf_dir):
    return _resolved(spark, sf_dir).select("file_path", "import_statement", "resolved")


@query
def unresolved_imports(spark, sf_dir):
    return graph.unresolved(_resolved(spark, sf_dir)).select("file_path", "import_statement")


@query
def dependency_graph(spark, sf_dir):
    return graph.dependency_edges(_resolved(spark, sf_dir))


@query
def dependency_nodes(spark, sf_dir):
    return graph.dependency_nodes(corpora.code_files(spark, sf_dir))


@query
def lint_stats(spark, sf_dir):
    return lint.lint_stats(lint.lint_events(corpora.lint_reports(spark, sf_dir)))
