"""Definitions, call edges and per-definition complexity of Python files.

A file becomes rows of code lines. One exchange, by file, serves everything: a running bracket
count tells continuation lines, and for each indentation that some header of the file has, the
last line not deeper than it tells which definition a line belongs to. No line is paired with
another, so a file of n lines and d header indentations costs n * d rows at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from treeloom.functions import pycode
from treeloom.functions.arrays import rows_of


def code_lines(files: DataFrame) -> DataFrame:
    """Features of the code lines that open or close a block, call something, or branch."""
    # Tests on the raw text and on whole lines are cheap; they keep the features from being
    # computed for lines that cannot matter.
    has_header = F.contains("content", F.lit("def")) | F.contains("content", F.lit("class"))
    code = files.where(has_header).select("file_path", pycode.masked(F.col("content")).alias("code")).select(
        "file_path", "code", pycode.header_indents(F.col("code")).alias("levels"))
    unit = F.col("item")
    units = rows_of(code, pycode.units(F.col("code")), "file_path", "levels").where(
        (pycode.indent(unit) <= F.array_max("levels")) | F.rlike(unit, F.lit(rf"[()\[\]{{}}]|{pycode.DECISIONS}")))
    kind = F.regexp_extract(unit, pycode.HEAD, 2)
    return units.select(
        "file_path", "levels", F.col("ord").alias("pos"),
        pycode.indent(unit).alias("indent"),
        kind.alias("kind"),
        F.regexp_extract(unit, pycode.HEAD, 3).alias("name"),
        (F.regexp_extract(unit, pycode.HEAD, 1) != "").alias("is_async"),
        F.when(kind == "def", pycode.params(unit)).alias("params"),
        pycode.bracket_change(unit).alias("change"),
        pycode.calls(unit).alias("calls"),
        pycode.decisions(unit).alias("decisions"),
    )


def definitions(files: DataFrame) -> DataFrame:
    """One row per def and class of (file_path, content): name, parameters, the class it is a
    direct member of, the names it calls (nested definitions included), and its complexity."""
    by_file = Window.partitionBy("file_path").orderBy("pos")
    by_level = Window.partitionBy("file_path", "level").orderBy("pos")
    before = (Window.unboundedPreceding, -1)
    open_brackets = F.coalesce(F.sum("change").over(by_file.rowsBetween(*before)), F.lit(0))
    starts = ~F.col("continued")
    lines = (
        code_lines(files)
        .withColumn("continued", open_brackets > 0)
        .withColumn("level", F.explode("levels"))
        .where((starts & (F.col("indent") <= F.col("level"))) | (F.size("calls") > 0) | (F.col("decisions") > 0))
    )
    block = F.when(starts & (F.col("indent") <= F.col("level")), F.struct(
        F.col("pos").alias("def_pos"), "kind", (F.col("indent") == F.col("level")).alias("own")))
    outer = F.when(starts & (F.col("indent") < F.col("level")), F.struct(
        F.col("pos").alias("class_pos"), "kind", "name"))
    owned = lines.select(
        "*",
        F.last(block, ignorenulls=True).over(
            by_level.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("block"),
        F.last(outer, ignorenulls=True).over(by_level.rowsBetween(*before)).alias("outer"),
    ).where(
        F.col("block.own")
        & ((F.col("block.kind") == "def") | ((F.col("block.kind") == "class") & (F.col("pos") == F.col("block.def_pos"))))
    )
    in_class = F.col("outer.kind") == "class"
    header = F.when(F.col("pos") == F.col("block.def_pos"), F.struct(
        "kind", "name", "is_async", "params",
        F.when(in_class, F.col("outer.class_pos")).alias("class_pos"),
        F.when(in_class, F.col("outer.name")).alias("class_name"),
    ))
    grouped = owned.groupBy("file_path", F.col("block.def_pos").alias("pos")).agg(
        F.first(header, ignorenulls=True).alias("header"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("calls")))).alias("calls"),
        (1 + F.sum("decisions")).cast("bigint").alias("complexity"),
    )
    is_def = F.col("header.kind") == "def"
    return grouped.select(
        "file_path", "pos", "header.*",
        F.when(is_def, F.col("calls")).alias("calls"),
        F.when(is_def, F.col("complexity")).alias("complexity"),
    )


def functions(defs: DataFrame) -> DataFrame:
    """Plain functions: `def`s that are no direct member of a class."""
    return defs.where((F.col("kind") == "def") & ~F.col("is_async") & F.col("class_pos").isNull())


def methods(defs: DataFrame) -> DataFrame:
    return defs.where((F.col("kind") == "def") & ~F.col("is_async") & F.col("class_pos").isNotNull())


def call_edges(defs: DataFrame) -> DataFrame:
    """Caller and callee names per file, each pair once."""
    return (
        defs.where((F.col("kind") == "def") & ~F.col("is_async"))
        .select("file_path", F.col("name").alias("caller"), F.explode("calls").alias("callee"))
        .distinct()
    )


def nested(defs: DataFrame) -> DataFrame:
    """Per file: classes with their methods, and functions. Groups are the definitions of one
    file, and the frame is already partitioned by file."""
    plain = (F.col("kind") == "def") & ~F.col("is_async")
    entry = F.struct("pos", "name", "params", "calls")
    owner = F.when(F.col("kind") == "class", F.col("pos")).otherwise(F.coalesce("class_pos", F.lit(-1)))
    groups = defs.groupBy("file_path", owner.alias("owner")).agg(
        F.max(F.when(F.col("kind") == "class", F.col("name"))).alias("class_name"),
        F.array_sort(F.collect_list(F.when(plain, entry))).alias("members"),
    )
    members = F.transform("members", lambda m: F.struct(m["name"], m["params"], m["calls"]))
    return groups.groupBy("file_path").agg(
        F.array_sort(F.collect_list(F.when(F.col("owner") >= 0, F.struct(
            "owner", F.col("class_name").alias("name"), members.alias("methods"))))).alias("classes"),
        F.first(F.when(F.col("owner") < 0, members), ignorenulls=True).alias("functions"),
    ).select(
        "file_path",
        F.transform("classes", lambda c: F.struct(c["name"], c["methods"])).alias("classes"),
        "functions",
    )
