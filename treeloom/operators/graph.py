"""Import resolution, dependency graph and call graph."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeloom import dims
from treeloom.functions import text
from treeloom.functions.arrays import let, rows_of
from treeloom.operators.joins import attach, questions, salted

# Class of the extensions every importer tries; others count only for importers that have them.
_LISTED = "*"
# Start of a key that names a whole path; no path suffix has it.
_EXACT = "//"


def import_key(statement: Column, module: Column) -> Column:
    """What an import asks for: a path suffix without extension, in which dots become slashes, or, for
    `./` and `../`, _EXACT and the whole path from the root, whose dots stay. A path that leaves the root
    is null."""
    here = F.regexp_replace(statement, r"^(?:\./)++", "")
    up = F.regexp_extract(here, r"^(?:\.\./)+", 0)
    levels = (F.length(up) / 3).cast("int")
    rest = F.substring(here, F.length(up) + 1, F.length(here))
    folders = F.filter(F.split(module, "/"), lambda s: ~s.isin(".", ""))
    base = F.slice(folders, F.lit(1), F.greatest(F.size(folders) - levels, F.lit(0)))
    exact = F.concat(F.lit(_EXACT), F.array_join(F.concat(base, F.array(rest)), "/"))
    return (
        F.when(F.rlike(statement, F.lit(r"^\.\.?/")), F.when(levels <= F.size(folders), exact))
        .otherwise(F.replace(F.regexp_replace(statement, r"^/+", ""), F.lit("."), F.lit("/"))))


def _extension_class(ext: Column) -> Column:
    return F.when(ext.isin(dims.IMPORT_EXTENSIONS), F.lit(_LISTED)).otherwise(ext)


def targets(files: DataFrame, boundary: bool = True) -> DataFrame:
    """First file of each module for every path suffix, and for the whole path with and without its
    extension. A suffix starts at a folder boundary or, with `boundary=False`, at any character.

    Files of equal suffix are reduced before the exchange; pairs of them are never formed.
    """
    ext = text.extension(F.col("file_path"))
    stem = F.substring("file_path", F.lit(1), F.length("file_path") - F.length(ext))
    order = [F.col(c) if c in files.columns else F.lit(0) for c in ("module_ord", "file_ord")]
    first = F.struct(
        order[0].cast("bigint").alias("module_ord"), F.col("module_path").alias("in_module"),
        order[1].cast("bigint").alias("file_ord"), "file_path")
    narrow = files.select("module_path", _extension_class(ext).alias("ext_class"), stem.alias("stem"), first.alias("first"))
    if boundary:
        suffixes = let(F.split("stem", "/"), lambda parts: F.transform(
            F.sequence(F.lit(1), F.size(parts)),
            lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "/")))
    else:
        suffixes = F.transform(
            F.sequence(F.lit(1), F.length("stem")),
            lambda i: F.substring(F.col("stem"), i, F.length("stem")))
    whole = [F.concat(F.lit(_EXACT), F.regexp_replace(p, r"^(?:\./|/)++", "")) for p in (F.col("stem"), F.col("first.file_path"))]
    # A path given with its extension is found by every importer.
    keys = F.concat(
        F.transform(F.concat(suffixes, F.array(whole[0])), lambda k: F.struct(k.alias("key"), F.col("ext_class"))),
        F.array(F.struct(whole[1].alias("key"), F.lit(_LISTED).alias("ext_class"))))
    return (
        rows_of(narrow, keys, "module_path", "first").select("module_path", "item.*", "first")
        .where(F.col("key") != "")
        .groupBy("module_path", "key", "ext_class")
        .agg(F.min("first").alias("first"))
    )


def resolve_imports(
    imports: DataFrame, files: DataFrame, boundary: bool = True,
    stage: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> DataFrame:
    """Adds `resolved`: the first file of the importer's own module the import names, else the
    first of all modules, else null.

    `imports` needs (file_path, module_path, import_statement), `files` (file_path, module_path)
    and optionally (module_ord, file_ord); without those, path order decides. `stage` may write
    the two frames that are read more than once, the distinct questions and the targets.
    """
    ext = text.extension(F.col("file_path"))
    asked = salted(imports.where(F.col("import_statement").isNotNull()).select(
        "*",
        import_key(F.col("import_statement"), F.col("module_path")).alias("key"),
        F.when(ext.isin(dims.IMPORT_EXTENSIONS), F.lit(_LISTED)).otherwise(ext).alias("own"),
    ), ["file_path"])
    classes = F.explode(F.array_distinct(F.array(F.lit(_LISTED), "own"))).alias("ext_class")
    in_module = stage(targets(files, boundary), "targets")
    overall = in_module.groupBy("key", "ext_class").agg(F.min("first").alias("first"))

    # Each distinct question is answered once, however many files ask it.
    here = stage(salted(questions(asked, ["module_path", "key", "own"]), ["module_path"]), "questions")
    local = (
        here.select("module_path", "key", "own", classes)
        .join(in_module, ["module_path", "key", "ext_class"])
        .groupBy("module_path", "key", "own")
        .agg(F.min("first")["file_path"].alias("local_path"))
    )
    there = questions(here, ["key", "own"])
    anywhere = (
        there.select("key", "own", "_salts", classes)
        .join(overall, ["key", "ext_class"])
        .groupBy("key", "own")
        .agg(F.min("first")["file_path"].alias("any_path"), F.first("_salts").alias("_salts"))
    )
    answers = attach(here.withColumnRenamed("_salts", "_asked"), anywhere, ["key", "own"])
    answers = (
        answers.join(local, ["module_path", "key", "own"], "left")
        .select("module_path", "key", "own", F.coalesce("local_path", "any_path").alias("resolved"),
                F.col("_asked").alias("_salts"))
        .where(F.col("resolved").isNotNull())
    )
    return attach(asked, answers, ["module_path", "key", "own"]).select(*imports.columns, "resolved")


def dependency_nodes(records: DataFrame) -> DataFrame:
    return records.select(F.col("file_path").alias("id"), "language").distinct()


def dependency_edges(resolved: DataFrame) -> DataFrame:
    """Importer -> file edges, each once. Needs the importer's language next to `resolved`."""
    return (
        resolved.where(F.col("language").isin(dims.IMPORT_LANGUAGES) & F.col("resolved").isNotNull())
        .select(F.col("file_path").alias("src"), F.col("resolved").alias("dst"))
        .distinct()
    )


def unresolved(resolved: DataFrame) -> DataFrame:
    return resolved.where(F.col("resolved").isNull()).drop("resolved")


def call_graph(edges: DataFrame) -> DataFrame:
    """Caller -> callee edges on bare names over all files."""
    return edges.select("caller", "callee").distinct()
