"""Column expressions over style sheets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STRING = r"(?:\"(?:[^\"\\\n]++|\\(?s:.))*+\"|'(?:[^'\\\n]++|\\(?s:.))*+')"
_TEXT = rf"(?:[^{{}}\"']++|{_STRING})"
_RULE = rf"({_TEXT}++)\{{({_TEXT}*+)\}}"
_KEYFRAMES = r"@[\w-]*keyframes[^{}]*+\{(?:[^{}]*+\{[^{}]*+\})*+[^{}]*+\}"
_BLANKS = " \t\r\n\x0c"


def rules(content: Column) -> Column:
    """Style rules as (selector, pos, props) in order, those inside `@media` included. Other
    at-rules are left out. `props` has each name once, in the order of last use."""
    sheet = F.regexp_replace(content, rf"({_STRING})|/\*(?s:.*?)(?:\*/|\z)", "$1")
    sheet = F.regexp_replace(sheet, _KEYFRAMES, "")
    # The second branch eats text that starts no rule, which keeps the scan linear.
    found = F.filter(F.regexp_extract_all(sheet, F.lit(rf"{_RULE}|{_TEXT}++"), 0),
                     lambda r: F.endswith(r, F.lit("}")))
    parts = F.transform(found, lambda r, i: F.struct(
        F.btrim(F.regexp_replace(F.regexp_extract(r, _RULE, 1), r"(?s)^.*;", ""), F.lit(_BLANKS)).alias("selector"),
        i.alias("pos"),
        properties(F.regexp_extract(r, _RULE, 2)).alias("props"),
    ))
    return F.filter(parts, lambda p: (p["selector"] != "") & ~F.startswith(p["selector"], F.lit("@")))


def properties(body: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(body, _STRING, ""), r"\([^()]*\)", "")
    declared = F.filter(F.split(plain, ";"), lambda d: F.contains(d, F.lit(":")))
    names = F.transform(declared, lambda d: F.lower(F.btrim(F.split(d, ":")[0], F.lit(_BLANKS))))
    return F.reverse(F.array_distinct(F.reverse(names)))
