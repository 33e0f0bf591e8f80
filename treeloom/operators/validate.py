"""Record validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeloom import dims


def valid_path(path: Column) -> Column:
    return F.coalesce(path, F.lit("")) != ""


def valid_language(language: Column) -> Column:
    return F.coalesce(language.isin(dims.RECORD_LANGUAGES), F.lit(False))


def valid_content(content: Column) -> Column:
    """Null is valid (binary or unreadable file), empty text is not."""
    return content.isNull() | (content != "")


def valid_size(size: Column) -> Column:
    return F.coalesce(size >= 0, F.lit(False))


def first_failure(path: Column, language: Column, content: Column, size: Column, schema_ok: Column) -> Column:
    """Name of the first check that fails, null for a valid record. A missing or empty analysis
    only warns, so it never decides here."""
    return (
        F.when(~valid_path(path), "path")
        .when(~valid_language(language), "language")
        .when(~valid_content(content), "content")
        .when(~valid_size(size), "metadata")
        .when(~schema_ok, "schema")
    )


def complete() -> Column:
    """Whether a typed record has all that the record schema requires."""
    return F.col("file_path").isNotNull() & F.col("language").isNotNull() & F.col("analysis").isNotNull() & F.col(
        "metadata.size").isNotNull()


def validated(records: DataFrame) -> DataFrame:
    """Adds `first_failure` and `analysis_warning` to typed records. Their types are given by the
    frame, so the schema check is left with what must be present."""
    analysis = F.col("analysis")
    return records.withColumns({
        "first_failure": first_failure(
            F.col("file_path"), F.col("language"), F.col("content"), F.col("metadata.size"), analysis.isNotNull()),
        "analysis_warning": analysis.isNull(),
    })


def split(validated_records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid records, and the others with their reason."""
    good = validated_records.where(F.col("first_failure").isNull()).drop("first_failure")
    return good, validated_records.where(F.col("first_failure").isNotNull())


def _type_ok(node: Column, allowed: tuple[str, ...]) -> Column:
    kind = F.schema_of_variant(node)
    whole = (
        F.rlike(kind, F.lit(r"^(?:BIGINT|DECIMAL\(\d+,0\))$"))
        | (F.rlike(kind, F.lit(r"^(?:DOUBLE|DECIMAL)"))
           & (F.try_variant_get(node, "$", "double") == F.floor(F.try_variant_get(node, "$", "double"))))
    )
    tests = {
        "string": kind == "STRING",
        "object": F.startswith(kind, F.lit("OBJECT")),
        "array": F.startswith(kind, F.lit("ARRAY")),
        "number": F.rlike(kind, F.lit("^(?:BIGINT|DECIMAL|DOUBLE|FLOAT)")),
        "integer": whole,
        "null": F.is_variant_null(node),
    }
    result = F.lit(False)
    for name in allowed:
        result = result | tests[name]
    return F.coalesce(result, F.lit(False))


def schema_violations(value: Column) -> Column:
    """Paths of a JSON record (a variant) that break the record schema; not an object is `$`."""
    found = []
    for path, required, allowed in dims.RECORD_RULES:
        node = F.try_variant_get(value, f"$.{path}", "variant")
        # A required key below a parent that is no object is the parent's violation.
        parent = path.rpartition(".")[0]
        applies = F.lit(True)
        if parent:
            applies = F.coalesce(F.startswith(
                F.schema_of_variant(F.try_variant_get(value, f"$.{parent}", "variant")), F.lit("OBJECT")), F.lit(False))
        broken = F.when(node.isNull(), F.lit(required)).otherwise(~_type_ok(node, allowed))
        found.append(F.when(applies & broken, F.lit(path)))
    is_object = F.coalesce(F.startswith(F.schema_of_variant(value), F.lit("OBJECT")), F.lit(False))
    return F.when(is_object, F.array_compact(F.array(*found))).otherwise(F.array(F.lit("$")))


def schema_check(lines: DataFrame, column: str = "value") -> DataFrame:
    """Adds the violated paths and the first failure of the ordered checks to raw JSON lines."""
    parsed = lines.withColumn("_v", F.try_parse_json(column)).withColumn("violations", schema_violations(F.col("_v")))

    def text(path: str) -> Column:
        return F.try_variant_get("_v", f"$.{path}", "string")

    size = F.try_variant_get("_v", "$.metadata.size", "double")
    return parsed.withColumn("first_failure", first_failure(
        text("file_path"), text("language"), text("content"), size, F.size("violations") == 0)).drop("_v")
