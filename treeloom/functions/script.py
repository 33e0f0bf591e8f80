"""Column expressions over JavaScript and TypeScript source text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from treeloom.functions.arrays import let
from treeloom.functions.pycode import BLANKS

STRING = (
    r"(?:\"(?:[^\"\\\n]++|\\(?s:.))*+\"|'(?:[^'\\\n]++|\\(?s:.))*+'|`(?:[^`\\]++|\\(?s:.))*+`)"
)
COMMENT = r"(?:/\*(?s:.*?)(?:\*/|\z)|//[^\n]*+)"

_PARAMS = r"\((?:[^()]|\((?:[^()]|\([^()]*+\))*+\))*+\)"
_FUNCTION = (
    r"(?:^|[;{}\n)]|\bexport\b|\bdefault\b|\basync\b)[ \t]*+function\b\s*+\*?\s*+([\w$]++)\s*+"
    rf"(?:<[^>(]*>)?\s*({_PARAMS})"
)
# The clause of an import ends at the `from` before its source, or at the next `import`.
_CLAUSE = r"(?:(?!import\b|from\s*[\"'])[\w$]++|[\s{},*]++)*+from\s*+"
_IMPORT = rf"\bimport(?=[\s{{*\"'])\s*+(?:{_CLAUSE})?[\"']([^\"'\n]+)[\"']"

DECISIONS = r"\b(?:if|for|while|case|catch)\b|&&|\|\||\?(?![.?:])"


def masked(content: Column) -> Column:
    """Code with strings cut to a pair of quotes and comments removed."""
    keep_quotes = rf"([\"'`])(?:(?<=\")(?:[^\"\\\n]++|\\(?s:.))*+\"|(?<=')(?:[^'\\\n]++|\\(?s:.))*+'|(?<=`)(?:[^`\\]++|\\(?s:.))*+`)"
    return F.regexp_replace(content, rf"{keep_quotes}|{COMMENT}", "$1$1")


def functions(content: Column) -> Column:
    """Declared functions in text order as (name, params)."""
    found = F.regexp_extract_all(masked(content), F.lit(_FUNCTION), 0)
    return F.transform(found, lambda f: F.struct(
        F.regexp_extract(f, _FUNCTION, 1).alias("name"),
        params(F.regexp_extract(f, _FUNCTION, 2)).alias("params"),
    ))


def params(text: Column) -> Column:
    """Plain parameter names; patterns and rest parameters have none."""
    inner = F.substring(text, 2, 2147483647)
    inner = F.regexp_replace(inner, r"\)$", "")
    for _ in range(4):
        inner = F.regexp_replace(inner, r"[(\[{][^()\[\]{}]*[)\]}]", "")
    names = F.transform(F.split(inner, ","), lambda p: F.regexp_extract(p, r"^\s*([A-Za-z_$][\w$]*)", 1))
    return F.filter(names, lambda p: p != "")


def imports(content: Column) -> Column:
    """Sources of import declarations in text order. Comments and other strings are consumed
    by the same scan, so imports inside them do not count."""
    found = F.regexp_extract_all(content, F.lit(rf"{COMMENT}|{_IMPORT}|{STRING}"), 1)
    return F.filter(found, lambda s: s != "")


def comments(content: Column) -> Column:
    """Line and block comments without their marks, stripped, in text order."""
    tokens = F.regexp_extract_all(content, F.lit(rf"{COMMENT}|{STRING}"), 0)
    tokens = F.filter(tokens, lambda t: F.startswith(t, F.lit("/")))
    return F.transform(tokens, lambda t: F.btrim(
        F.when(F.startswith(t, F.lit("/*")), F.substring(t, F.lit(3), F.length(t) - 4))
        .otherwise(F.substring(t, F.lit(3), F.length(t))),
        F.lit(BLANKS),
    ))


def complexity(content: Column) -> Column:
    """Declared functions plus decision points of the file."""
    return let(masked(content), lambda code: (
        F.size(F.regexp_extract_all(code, F.lit(_FUNCTION), 0))
        + F.size(F.regexp_extract_all(code, F.lit(DECISIONS), 0)))).cast("bigint")
