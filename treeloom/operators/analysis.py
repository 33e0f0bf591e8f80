"""Analysis of file records: one struct per record, by handler."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeloom import schema
from treeloom.functions import css, entities, markup, metrics, pycode, script, structured
from treeloom.functions.arrays import to_map, with_last_per_key
from treeloom.operators import definitions


def _python_fields(records: DataFrame) -> DataFrame:
    """Analysis fields of Python files that need no other row."""
    content = F.col("content")
    df = pycode.with_docstrings(records, "content", "_docs")
    return df.withColumns({
        "_a_imports": pycode.imports(content),
        "_a_docstrings": to_map(F.col("_docs"), "name", "doc"),
        "_a_comments": pycode.comments(content),
        "_a_complexity": pycode.complexity(content),
    })


def _other_fields(records: DataFrame) -> DataFrame:
    """Analysis fields of all other handlers; a row computes those of its own handler."""
    content, handler = F.col("content"), F.col("handler")
    is_script, is_html, is_xml = handler.isin("javascript", "typescript"), handler == "html", handler == "xml"
    df = records.withColumns({
        "_markup": F.when(is_html, markup.html_tokens(content)).when(is_xml, markup.xml_tokens(content)),
        "_rules": F.when(handler == "css", css.rules(content)),
        "_yaml": F.when(handler == "yaml", content),
    })
    df = df.withColumns({
        "_elements": F.when(is_html, markup.elements(F.col("_markup"))).otherwise(markup.elements(F.col("_markup"), lower=False)),
        "_last_rules": F.col("_rules"),
    })
    df = with_last_per_key(df, "_elements", "tag")
    df = with_last_per_key(df, "_last_rules", "selector")
    df = structured.with_yaml_value(df, "_yaml", "_yaml_value")
    attribute_maps = F.transform("_elements", lambda e: F.struct(
        e["tag"].alias("tag"),
        to_map(F.when(is_html, markup.attributes(e["raw"])).otherwise(markup.attributes(e["raw"], lower=False)),
               "name", "value").alias("attrs")))
    return df.withColumns({
        "_a_functions": F.when(is_script, F.transform(script.functions(content), lambda f: F.struct(
            f["name"].alias("name"), f["params"].alias("params"), F.lit(None).cast("array<string>").alias("calls")))),
        "_a_imports": F.when(is_script, script.imports(content)),
        "_a_docstrings": F.when(handler.isin("html", "typescript"), F.from_json(F.lit("{}"), "map<string,string>")),
        "_a_comments": F.when(is_script, script.comments(content)).when(is_html, markup.comments(F.col("_markup"))),
        "_a_tags": F.when(is_html, markup.tags(F.col("_markup"))).when(is_xml, markup.tags(F.col("_markup"), lower=False)),
        "_a_attributes": to_map(attribute_maps, "tag", "attrs"),
        "_a_rules": F.transform("_rules", lambda r: r["selector"]),
        "_a_properties": to_map(F.col("_last_rules"), "selector", "props"),
        "_a_headings": F.when(handler == "markdown", structured.headings(content)),
        "_a_links": F.when(handler == "markdown", structured.links(content)),
        "_a_complexity": F.when(handler == "typescript", script.complexity(content)),
        "_a_data": F.when(handler == "json", structured.json_value(content)).when(handler == "yaml", F.col("_yaml_value")),
    })


def _finished(df: DataFrame, columns: list[str], patterns: list[tuple[str, str]] | None) -> DataFrame:
    """`columns`, the `analysis` struct from the `_a_` columns, and `data`."""
    content = F.col("content")

    def field(name: str) -> Column:
        return F.col(f"_a_{name}") if f"_a_{name}" in df.columns else F.lit(None)

    values = {
        "entities": F.when(content.isNotNull(), entities.entities(content, patterns)).otherwise(F.array().cast(schema.ENTITIES)),
        "lint_results": F.col("lint_results") if "lint_results" in columns else F.lit(None),
        "function_count": metrics.function_count(F.col("language"), field("functions").cast(schema.ANALYSIS_FIELDS["functions"])),
        "comment_density": metrics.comment_density(field("comments").cast("array<string>"), F.col("metadata.loc")),
    }
    analysis = F.struct(*[values.get(n, field(n)).cast(t).alias(n) for n, t in schema.ANALYSIS_FIELDS.items()])
    return df.select(*columns, analysis.alias("analysis"), field("data").cast("variant").alias("data"))


def analyse(records: DataFrame, patterns: list[tuple[str, str]] | None = None) -> DataFrame:
    """Adds `analysis` and `data`. Only Python files, whose definitions come from their lines,
    are joined with anything; all other rows are computed in place."""
    is_python = F.col("handler") == "python"
    python = records.where(is_python)
    nested = definitions.nested(definitions.definitions(python.select("file_path", "content")))
    python = _python_fields(python).join(nested, "file_path", "left").withColumns({
        f"_a_{name}": F.coalesce(name, F.array().cast(schema.ANALYSIS_FIELDS[name])) for name in ("classes", "functions")})
    return _finished(python, records.columns, patterns).unionByName(
        _finished(_other_fields(records.where(~is_python)), records.columns, patterns))
