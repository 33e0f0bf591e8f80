"""Frames of files derived from the benchmark tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treeloom.operators.joins import attach, salted

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` as text files, one folder per source."""
    return table(spark, sf_dir, "documents").select(
        F.concat("source", F.lit("/"), "doc_id", F.lit(".txt")).alias("file_path"),
        F.col("source").alias("module_path"),
        F.col("lang").alias("language"),
        F.col("text").alias("content"),
        "doc_id",
    )


def html_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        F.concat("page_id", F.lit(".html")).alias("file_path"), F.col("html").alias("content"), "page_id")


def json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat("event_id", F.lit(".json")).alias("file_path"), F.col("props").alias("content"), "event_id")


def byte_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` as raw files of eight kinds: images, text, text with NUL or broken bytes, PDF,
    binary, unknown extension, JSON of which half is cut off."""
    kind = F.col("doc_id") % 8
    body = F.encode("text", "UTF-8")
    cut = F.when(F.col("doc_id") % 16 == 7, F.lit("}")).otherwise(F.lit(""))
    data = (
        F.when(kind == 0, F.concat(F.unhex(F.lit("89504E470D0A1A0A")), body))
        .when(kind == 2, F.concat(body, F.lit(b"\x00")))
        .when(kind == 3, F.concat(body, F.lit(b"\xff")))
        .when(kind == 4, F.concat(F.lit(b"%PDF-"), body))
        .when(kind == 5, F.concat(body, F.lit(b"\x00\xff")))
        .when(kind == 7, F.encode(F.concat(F.lit('{"id": '), "doc_id", cut), "UTF-8"))
        .otherwise(body)
    )
    ext = F.element_at(F.array(*map(F.lit, ["png", "txt", "txt", "txt", "pdf", "bin", "dat", "json"])),
                       (kind + 1).cast("int"))
    return table(spark, sf_dir, "documents").select(
        F.concat("source", F.lit("/f"), "doc_id", F.lit("."), ext).alias("file_path"),
        F.octet_length(data).cast("bigint").alias("size"), data.alias("data"), "doc_id")


def xml_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as XML files with mixed-case names."""
    return table(spark, sf_dir, "events").select(
        F.concat("event_id", F.lit(".xml")).alias("file_path"),
        F.concat(
            F.lit('<?xml version="1.0"?>\n<Event id="'), "event_id", F.lit('"><!-- <no/> --><userRef id="'),
            "user_id", F.lit('" kind=\''), "event_type", F.lit("'/><![CDATA[<none>]]><userRef id=\"x"),
            "user_id", F.lit('"/></Event>')).alias("content"),
    )


def yaml_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`part` as YAML files. The table is small and often one file, which one task would read and parse,
    so its rows are dealt over the tasks before the texts are made."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    return part.repartition("p_partkey", "p_name").select(
        F.concat("p_partkey", F.lit(".yaml")).alias("file_path"),
        F.concat_ws(
            "\n",
            F.concat(F.lit("# part "), "p_partkey"),
            F.concat(F.lit("key: "), "p_partkey"),
            F.concat(F.lit("name: "), "p_name"),
            F.concat(F.lit("brand: '"), "p_brand", F.lit("'")),
            F.concat(F.lit("size: "), "p_size", F.lit("   # pieces")),
            F.when(F.col("p_partkey") % 2 == 0, F.lit("ready: true")).otherwise(F.lit("ready: ~")),
            F.lit("tags:\n  - a\n  - b"),
            F.concat(F.lit("key: "), F.col("p_partkey") + 1),
        ).alias("content"),
    )


def markdown_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`conversations` as Markdown files, one per turn."""
    return table(spark, sf_dir, "conversations").select(
        F.concat("conv_id", F.lit("/"), "turn", F.lit(".md")).alias("file_path"),
        F.concat(
            F.lit("# Turn "), "turn", F.lit("\n\n"), "text", F.lit("\n\n```\n# code\n```\n\n## By "), "role",
            F.lit(" ##\n\nSee [conversation "), "conv_id", F.lit("](../"), "conv_id",
            F.lit("/index.md) ![image](i.png)\n")).alias("content"),
    )


def _line(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _python_text(c: dict[str, Column]) -> Column:
    return F.concat_ws(
        "\n",
        _line('"""', c["name"], ' module"""'), c["imports"],
        _line("from absent.part", c["k"], " import build"), _line("# ", c["brand"]),
        _line("class Part", c["k"], "(Base):"), _line('    """', c["type"], '"""'),
        F.lit("    def size(self, scale=1):"), F.lit("        return scale_by(self.raw(), scale)"),
        F.lit("def build(a, b):"), F.lit('    """Build."""'), _line("    # build ", c["brand"]),
        F.lit("    if a:"), _line("        return Part", c["k"], "(a).size(b)"), F.lit("    return merge(a, b)"),
    )


def _script_text(c: dict[str, Column]) -> Column:
    return F.concat_ws(
        "\n",
        _line("// ", c["brand"]), c["imports"],
        _line("import x from './part", c["next"], "';"), _line("import x from '../", c["module"], "/part", c["k"], "';"),
        _line("import x from 'absent/part", c["k"], "';"), _line("/* ", c["type"], " */"),
        F.lit("function build(a, b) {"), F.lit("  if (a) { return merge(a, b); }"), F.lit("  return a.size(b);"),
        F.lit("}"),
    )


def part_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, dst): the first parts of an order import all its parts of higher number, each once.
    The first parts travel as one array per order."""
    rows = salted(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber"), ["l_partkey"])
    lead = rows.groupBy("l_orderkey").agg(
        F.collect_set(F.when(F.col("l_linenumber") == 1, F.col("l_partkey"))).alias("leads"),
        F.collect_set("_salt").alias("_salts"))
    importers = F.filter("leads", lambda k: k < F.col("l_partkey"))
    return (
        attach(rows, lead.where(F.size("leads") > 0), ["l_orderkey"])
        .select(F.explode(importers).alias("src"), F.col("l_partkey").alias("dst")).distinct()
    )


def code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A code base: one file per part, which imports the parts ordered together with it, and by fixed
    lines a neighbour and itself by relative path (scripts) and a part that names no file."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("k"), "p_name", "p_brand", "p_type", F.concat(F.lit("mod"), "p_size").alias("m"),
        F.when(F.col("p_partkey") % 4 == 2, "js").when(F.col("p_partkey") % 4 == 3, "ts").otherwise("py").alias("ext"))
    src, dst = part.select(F.col("k").alias("src"), F.col("ext").alias("src_ext")), part.select(F.col("k").alias("dst"), "m")
    module, name = F.col("m"), _line("part", F.col("dst"))
    line = (
        F.when(F.col("src_ext") != "py", _line("import x from '", module, "/", name, "';"))
        .when(F.col("dst") % 2 == 0, _line("import ", module, ".", name))
        .otherwise(_line("from ", module, ".", name, " import build"))
    )
    lines = part_imports(spark, sf_dir).join(src, "src").join(dst, "dst").select(F.col("src").alias("k"), line.alias("line"))
    imports = lines.groupBy("k").agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("imports"))

    cols = {"k": F.col("k").cast("string"), "name": F.col("p_name"), "brand": F.col("p_brand"), "type": F.col("p_type"),
            "imports": F.col("imports"), "module": F.col("m"), "next": (F.col("k") + 1).cast("string")}
    return part.join(imports, "k", "left").select(
        F.col("m").alias("module_path"),
        F.concat("m", F.lit("/part"), "k", F.lit("."), "ext").alias("file_path"),
        F.when(F.col("ext") == "py", "python").when(F.col("ext") == "js", "javascript").otherwise("typescript").alias("language"),
        F.when(F.col("ext") == "py", _python_text(cols)).otherwise(_script_text(cols)).alias("content"),
    )


def lint_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One report per line of `lineitem`, in the shape of the language of its part."""
    rule = F.concat("l_returnflag", "l_linestatus")
    count = F.col("l_linenumber")
    language = F.element_at(F.array(*map(F.lit, ["python", "javascript", "typescript", "css"])),
                            (F.col("l_partkey") % 4 + 1).cast("int"))
    report = (
        F.when(F.col("l_partkey") % 4 == 0, _line('[{"symbol": "', rule, '"}]'))
        .when(F.col("l_partkey") % 4 == 1, _line('[{"errorCount": ', count, ', "warningCount": 0}]'))
        .when(F.col("l_partkey") % 4 == 2, _line('[{"ruleName": "', rule, '"}, {"other": 1}]'))
        .otherwise(_line('[{"rule": "', rule, '"}, {"warnings": [{"rule": "nested-', rule, '"}]}]'))
    )
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("part"), "l_partkey").alias("file_path"), language.alias("language"), report.alias("report"))


def doc_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links with two rows for some files: (File, Documentation, ord)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat("source", F.lit("/"), "doc_id", F.lit(".txt")).alias("File"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    linked = docs.join(pages, F.col("page_id") == F.col("doc_id"))
    first = linked.select("File", F.col("url").alias("Documentation"), F.lit(0).alias("ord"))
    second = linked.where(F.col("doc_id") % 2 == 0).select("File", F.concat(F.lit("new:"), "url").alias("Documentation"), F.lit(1).alias("ord"))
    return first.unionByName(second)


def former_cache(files: DataFrame) -> DataFrame:
    """A cache of text files: a third is current, a third stale, a third missing."""
    current = F.col("doc_id") % 3
    return files.where(current < 2).select(
        "file_path",
        F.when(current == 0, F.md5("content")).otherwise(F.md5(F.concat("content", F.lit("!")))).alias("hash"),
        (F.col("doc_id") * 2).alias("function_count"))


def broken_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of `documents` of which six in seven break one rule each, or none by having null content."""
    fault = F.col("doc_id") % 7
    files = text_files(spark, sf_dir)
    return files.select(
        "doc_id",
        F.when(fault == 1, F.lit("")).otherwise(F.col("file_path")).alias("file_path"),
        F.when(fault == 2, F.col("language")).otherwise(F.lit("text")).alias("language"),
        F.when(fault == 3, F.lit("")).when(fault != 4, F.col("content")).alias("content"),
        F.struct(
            F.lit(1).cast("bigint").alias("loc"),
            F.when(fault == 5, F.lit(-1).cast("bigint")).otherwise(F.octet_length("content").cast("bigint")).alias("size"),
        ).alias("metadata"),
        F.when(fault != 6, F.struct(F.array().cast("array<string>").alias("comments"))).alias("analysis"),
    )


def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of records with one fault in each of eight in nine."""
    fault = F.col("doc_id") % 9
    path = F.to_json(F.array(F.concat("source", F.lit("/"), "doc_id")))
    path = F.substring(path, F.lit(2), F.length(path) - 2)
    content = F.when(fault == 1, F.lit("")).when(fault == 2, F.lit('"content": null, ')).otherwise(F.lit('"content": "x", '))
    analysis = (
        F.when(fault == 3, F.lit('{"imports": {}}')).when(fault == 4, F.lit('{"lint_results": [], "complexity": 1.5}'))
        .when(fault == 5, F.lit("[]")).otherwise(F.lit("{}"))
    )
    size = F.when(fault == 6, F.lit("1.5")).when(fault == 7, F.lit('"9"')).otherwise(F.col("n_chars").cast("string"))
    end = F.when(fault == 8, F.lit("")).otherwise(F.lit("}"))
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(
        F.lit('{"file_path": '), path, F.lit(', "language": "text", '), content, F.lit('"analysis": '), analysis,
        F.lit(', "metadata": {"loc": 2.0, "size": '), size, F.lit("}"), end).alias("value"))


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as JSON lines in one file per user; some are cut off, some blank."""
    fault = F.col("event_id") % 11
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("user"), "user_id").alias("file"),
        F.when(fault == 0, F.lit("")).when(fault == 1, F.regexp_replace("props", "}$", "")).otherwise(F.col("props")).alias("value"))
