"""Column expressions over Python source text.

Patterns use possessive groups, which the JVM matches in a loop: a string or bracket of any
length needs neither backtracking nor stack depth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeloom.functions.arrays import let, with_last_per_key

# Words that may stand before "(" without being a call.
KEYWORDS = [
    "and", "as", "assert", "async", "await", "class", "def", "del", "elif", "else", "except", "for",
    "from", "global", "if", "import", "in", "is", "lambda", "nonlocal", "not", "or", "raise",
    "return", "while", "with", "yield",
]

LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"

DECISIONS = r"\b(?:if|elif|for|while|except|and|or|case)\b"


def _strings(open_group: str) -> list[str]:
    """Patterns of the four string forms; `open_group` wraps the first quote."""
    forms = []
    for q in ('"', "'"):
        body = rf"(?:[^{q}\\]++|\\(?s:.)|{q}(?!{q}{q}))*+"
        forms.append(open_group.format(q) + rf"{q}{q}{body}{q}{q}{q}")
    for q in ('"', "'"):
        forms.append(open_group.format(q) + rf"(?:[^{q}\\\n]++|\\(?s:.))*+{q}")
    return forms


STRING = "(?:" + "|".join(_strings("{}")) + ")"
_MASK = "|".join(_strings("({})")) + r"|#[^\n]*+"


def _parens(depth: int, atom: str) -> str:
    inner = atom
    for _ in range(depth):
        inner = rf"(?:{inner}|\({inner}*+\))"
    return rf"\({inner}*+\)"


# Signatures: up to four bracket levels, strings and comments allowed in raw text.
_RAW_SIGNATURE = _parens(3, rf"(?:[^()\"'#]++|{STRING}|#[^\n]*+)")
_SIGNATURE = _parens(3, r"[^()]")

_DECORATOR = r"(?:@[^\n]*?[ \t])?"
HEAD = rf"^[ \t]*{_DECORATOR}(async[ \t]+)?(def|class)[ \t]+(\w+)"
UNIT = (
    rf"(?m)^[ \t]*{_DECORATOR}(?:async[ \t]+)?(?:def|class)[ \t]+\w+[ \t]*(?:{_SIGNATURE})?[^\n]*"
    r"|^[^\n]*\S[^\n]*"
)

_GAP = r"(?:\s|#[^\n]*+)*+"
_DOC = rf"([rRuU]?{STRING})(?=[ \t]*(?:[;#\n]|\z))"
_HEAD_DOC = rf"^([ \t]*)(?:class|def)[ \t]+(\w+)[ \t]*(?:{_RAW_SIGNATURE})?[^:\n]*:{_GAP}{_DOC}"
_HEAD_DOC_ASYNC = _HEAD_DOC.replace("(?:class|def)", r"(?:class|(?:async[ \t]+)?def)", 1)


def masked(content: Column) -> Column:
    """Code with each string cut to one quote, comments removed, and escaped line ends and the
    line end after a decorator joined to the next line."""
    code = F.regexp_replace(content, _MASK, "$1$2$3$4")
    code = F.regexp_replace(code, r"\\\n", " ")
    return F.regexp_replace(code, r"(?m)^([ \t]*@[^\n]*)\n", "$1 ")


def units(code: Column) -> Column:
    """Non-blank lines of masked code, a def or class header over several lines being one."""
    return F.regexp_extract_all(code, F.lit(UNIT), 0)


def indent(line: Column) -> Column:
    blanks = F.regexp_extract(line, r"^[ \t]*", 0)
    return F.length(F.replace(blanks, F.lit("\t"), F.lit(" " * 8)))


def header_indents(code: Column) -> Column:
    """Distinct indentations of def and class headers."""
    found = F.regexp_extract_all(
        code, F.lit(rf"(?m)^([ \t]*){_DECORATOR}(?:async[ \t]+)?(?:def|class)[ \t]+\w"), 1
    )
    return F.transform(F.array_distinct(found), lambda b: F.length(F.replace(b, F.lit("\t"), F.lit(" " * 8))))


def bracket_change(line: Column) -> Column:
    """Opening minus closing brackets."""
    return F.length(F.translate(line, ")]}", "")) - F.length(F.translate(line, "([{", ""))


def calls(line: Column) -> Column:
    """Callee names in a masked line: the last identifier before `(`."""
    body = F.regexp_replace(line, r"\b(?:def|class)[ \t]+\w+", ";")
    names = F.regexp_extract_all(body, F.lit(r"(?:(?<!\w)(\w++)|[)\]\"'])\s*+\("), 1)
    names = F.filter(names, lambda n: ~n.isin(KEYWORDS))
    return F.transform(names, lambda n: F.when(n == "", F.lit("unknown_function")).otherwise(n))


def decisions(line: Column) -> Column:
    return F.size(F.regexp_extract_all(line, F.lit(DECISIONS), 0))


def params(unit: Column) -> Column:
    """Positional parameter names of a header unit, without positional-only, starred and
    keyword-only ones."""
    text = F.regexp_extract(unit, rf"^[ \t]*{_DECORATOR}(?:async[ \t]+)?def[ \t]+\w+[ \t]*({_SIGNATURE})", 1)
    text = F.substring(text, 2, 2147483647)
    text = F.regexp_replace(text, r"\)$", "")
    for _ in range(4):
        text = F.regexp_replace(text, r"[(\[{][^()\[\]{}]*[)\]}]", "")
    text = F.regexp_replace(text, r"(?s)^.*,?\s*/\s*(?:,|$)", "")
    text = F.regexp_replace(text, r"(?s)(?:^|,)\s*\*.*$", "")
    names = F.transform(F.split(text, ","), lambda p: F.regexp_extract(p, r"^\s*([A-Za-z_]\w*)", 1))
    return F.filter(names, lambda p: p != "")


def comments(content: Column) -> Column:
    """Stripped lines that start with `#`."""
    lines = F.transform(F.split(content, LINE_END), lambda l: F.btrim(l, F.lit(BLANKS)))
    return F.filter(lines, lambda l: F.startswith(l, F.lit("#")))


def imports(content: Column) -> Column:
    """Imported modules: `import` statements first, then the modules of `from` imports."""
    def found(code: Column) -> Column:
        plain = F.regexp_extract_all(code, F.lit(r"(?m)(?:^|;)[ \t]*+import[ \t]+([\w. \t,]+)"), 1)
        plain = F.flatten(F.transform(plain, lambda s: F.split(s, ",")))
        plain = F.transform(plain, lambda s: F.regexp_extract(s, r"^\s*([\w.]+)", 1))
        sources = F.regexp_extract_all(
            code, F.lit(r"(?m)(?:^|;)[ \t]*+from[ \t]+\.*[ \t]*([\w.]*)[ \t]+import\b"), 1)
        return F.filter(F.concat(plain, sources), lambda m: m != "")

    return let(masked(content), found)


def _unquoted(literal: Column) -> Column:
    def inner(bare: Column) -> Column:
        width = F.when(F.startswith(bare, F.lit('"""')) | F.startswith(bare, F.lit("'''")), F.lit(3)).otherwise(F.lit(1))
        return let(width, lambda w: F.substring(bare, w + 1, F.length(bare) - 2 * w))

    return let(F.regexp_replace(literal, r"^[rRuU]", ""), inner)


def cleaned(doc: Column) -> Column:
    """Docstring text with the common indentation and outer blank lines removed."""
    def joined(lines: Column) -> Column:
        def dedented(rest: Column) -> Column:
            margin = F.array_min(F.transform(
                F.filter(rest, lambda l: F.ltrim(l) != ""), lambda l: F.length(l) - F.length(F.ltrim(l))))
            return let(F.coalesce(margin, F.lit(0)) + 1,
                       lambda start: F.transform(rest, lambda l: F.substring(l, start, F.length(l))))

        body = let(F.slice(lines, F.lit(2), F.size(lines)), dedented)
        return F.array_join(F.concat(F.array(F.ltrim(F.get(lines, F.lit(0)))), body), "\n")

    lines = F.split(F.replace(doc, F.lit("\t"), F.lit(" " * 8)), "\n")
    return F.btrim(let(lines, joined), F.lit("\n"))


def with_docstrings(df: DataFrame, content: str = "content", out: str = "docstrings",
                    include_async: bool = False) -> DataFrame:
    """Adds an array of (name, indent, pos, doc), one per documented name, the last one winning:
    outer definitions come before inner ones, then text order. The module's name is `module`."""
    head = _HEAD_DOC_ASYNC if include_async else _HEAD_DOC
    text = F.col(content)
    tokens = F.regexp_extract_all(text, F.lit(rf"(?m){head}|{STRING}|#[^\n]*+"), 0)
    found = F.transform(
        # Strings and comments are only consumed; a match of the header pattern starts with it.
        F.filter(tokens, lambda t: F.rlike(t, F.lit(r"^[ \t]*(?:class|def|async)[ \t]"))),
        lambda t, i: F.struct(
            F.regexp_extract(t, rf"(?m){head}", 2).alias("name"),
            indent(t).alias("indent"),
            i.alias("pos"),
            cleaned(_unquoted(F.regexp_extract(t, rf"(?m){head}", 3))).alias("doc"),
        ))
    found = F.filter(found, lambda d: (d["name"] != "") & (d["doc"] != ""))
    module = F.filter(F.array(F.struct(
        F.lit("module").alias("name"), F.lit(-1).alias("indent"), F.lit(-1).alias("pos"),
        cleaned(_unquoted(F.regexp_extract(text, rf"\A{_GAP}{_DOC}", 1))).alias("doc"),
    )), lambda d: d["doc"] != "")
    return with_last_per_key(df.withColumn(out, F.concat(module, found)), out, "name")


def complexity(content: Column) -> Column:
    """Functions plus decision points of the file."""
    heads = rf"(?m)^[ \t]*{_DECORATOR}(?:async[ \t]+)?def[ \t]+\w+"
    return let(masked(content), lambda code: F.size(F.regexp_extract_all(code, F.lit(heads), 0)) + decisions(code)).cast("bigint")
