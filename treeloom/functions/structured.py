"""Column expressions over JSON, YAML and Markdown text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeloom.functions.arrays import let, with_last_per_key

_YAML_LINE = r"(?m)^([A-Za-z_][^:#\n]*?)[ \t]*:(?:[ \t]+([^\n]*?))?[ \t]*$"
_HEADING = r"(?m)^(#{1,6})[ \t]+([^\n]*\S)[ \t]*$"
_LINK = r"!?\[([^\]\n\[]*)\]\(([^)\s]+)[^)\n]*\)"
_FENCE = r"(?m)^[ \t]*(```|~~~)(?s:.*?)(?:^[ \t]*\1[^\n]*$|\z)"


def json_value(content: Column) -> Column:
    """The document as a variant, null if it does not parse."""
    return F.try_parse_json(content)


def yaml_scalars(content: Column) -> Column:
    """Top-level `key: scalar` lines as (key, pos, value, type); keys that open a block have
    type `block`."""
    found = F.regexp_extract_all(content, F.lit(_YAML_LINE), 0)
    return F.transform(found, lambda l, i: let(
        F.struct(F.regexp_extract(l, _YAML_LINE, 1).alias("key"), F.regexp_extract(l, _YAML_LINE, 2).alias("text")),
        lambda kv: _yaml_scalar(kv["key"], i, kv["text"])))


def _yaml_scalar(key: Column, pos: Column, text: Column) -> Column:
    quoted = F.rlike(text, F.lit(r"^(?:\".*\"|'.*')$"))
    bare = F.regexp_replace(text, r"[ \t]+#.*$", "")
    return F.when(quoted, F.struct(
        key.alias("key"), pos.alias("pos"),
        F.substring(text, F.lit(2), F.length(text) - 2).alias("value"), F.lit("string").alias("type"),
    )).otherwise(let(bare, lambda b: F.struct(
        key.alias("key"), pos.alias("pos"), b.alias("value"), _yaml_type(b).alias("type"))))


def _yaml_type(bare: Column) -> Column:
    return (
        F.when((bare == "") | F.rlike(bare, F.lit(r"^[|>&][+-]?\w*$")), F.lit("block"))
        .when(bare.isin("~", "null", "Null", "NULL"), F.lit("null"))
        .when(bare.isin("true", "True", "TRUE", "false", "False", "FALSE"), F.lit("bool"))
        .when(F.rlike(bare, F.lit(r"^[-+]?[0-9]+$")), F.lit("int"))
        .when(F.rlike(bare, F.lit(r"^[-+]?(?:[0-9]+\.[0-9]*|\.[0-9]+)(?:[eE][-+][0-9]+)?$")), F.lit("float"))
        .when(F.rlike(bare, F.lit(r"^[\[{]")), F.lit("flow"))
        .otherwise(F.lit("string"))
    )


def _json_string(text: Column) -> Column:
    return let(F.to_json(F.array(text)), lambda listed: F.substring(listed, F.lit(2), F.length(listed) - 2))


def with_yaml_value(df: DataFrame, content: str = "content", out: str = "yaml") -> DataFrame:
    """Adds the top-level scalars as a variant object, the last of equal keys kept."""
    df = with_last_per_key(df.withColumn(out, yaml_scalars(F.col(content))), out, "key")
    scalars = F.filter(F.col(out), lambda s: ~s["type"].isin("block", "flow"))
    members = F.transform(scalars, lambda s: F.concat(
        _json_string(s["key"]), F.lit(":"),
        F.when(s["type"] == "null", F.lit("null"))
        .when(s["type"] == "bool", F.lower(s["value"]))
        .when(s["type"] == "int", s["value"].try_cast("decimal(38,0)").cast("string"))
        .when(s["type"] == "float", s["value"].try_cast("double").cast("string"))
        .otherwise(_json_string(s["value"])),
    ))
    return df.withColumn(out, F.try_parse_json(F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))))


def headings(content: Column) -> Column:
    """Heading outline as (level, text), fenced blocks left out."""
    found = F.regexp_extract_all(F.regexp_replace(content, _FENCE, ""), F.lit(_HEADING), 0)
    return F.transform(found, lambda h: F.struct(
        F.length(F.regexp_extract(h, _HEADING, 1)).alias("level"),
        F.regexp_replace(F.regexp_extract(h, _HEADING, 2), r"[ \t]+#+$", "").alias("text"),
    ))


def links(content: Column) -> Column:
    """Links as (text, target), images and fenced blocks left out."""
    found = F.regexp_extract_all(F.regexp_replace(content, _FENCE, ""), F.lit(_LINK), 0)
    return F.transform(F.filter(found, lambda l: ~F.startswith(l, F.lit("!"))), lambda l: F.struct(
        F.regexp_extract(l, _LINK, 1).alias("text"),
        F.regexp_extract(l, _LINK, 2).alias("target"),
    ))
