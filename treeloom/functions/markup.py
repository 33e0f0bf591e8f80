"""Column expressions over HTML and XML text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What is not closed ends at the next tag or at the end of the text, which keeps scans linear.
_INSIDE = r"(?:[^'\"<>]++|\"[^\"]*+\"|'[^']*+')*+"
_COMMENT = r"<!--(?s:.*?)(?:-->|\z)"
_START = rf"<[a-zA-Z]{_INSIDE}>|<[a-zA-Z][^<>]*+>"


def _raw(tag: str) -> str:
    return rf"(?i:<{tag}(?=[\s/>]){_INSIDE}>(?s:.*?)(?:</{tag}\s*>|\z))"


_HTML_TOKEN = rf"{_COMMENT}|{_raw('script')}|{_raw('style')}|{_START}"
_XML_TOKEN = rf"{_COMMENT}|<!\[CDATA\[(?s:.*?)(?:\]\]>|\z)|<\?(?s:.*?)(?:\?>|\z)|{_START}"
_ATTRIBUTE = r"(?<![^\s\"'/])([^\s=/>\"']++)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?"


def html_tokens(content: Column) -> Column:
    """Comments and start tags in document order; script and style tags carry their bodies, so
    that nothing inside them looks like a tag."""
    return F.regexp_extract_all(content, F.lit(_HTML_TOKEN), 0)


def xml_tokens(content: Column) -> Column:
    return F.regexp_extract_all(content, F.lit(_XML_TOKEN), 0)


def _is_tag(token: Column) -> Column:
    return ~F.startswith(token, F.lit("<!")) & ~F.startswith(token, F.lit("<?"))


def tag_name(token: Column) -> Column:
    return F.regexp_extract(token, r"^<([a-zA-Z][^\s/>]*)", 1)


def tags(tokens: Column, lower: bool = True) -> Column:
    names = F.transform(F.filter(tokens, _is_tag), tag_name)
    return F.transform(names, F.lower) if lower else names


def comments(tokens: Column) -> Column:
    found = F.filter(tokens, lambda t: F.startswith(t, F.lit("<!--")))
    return F.transform(found, lambda t: F.regexp_replace(t, r"^<!--|-->$", ""))


def style_text(tokens: Column) -> Column:
    """Bodies of the style elements, joined by line ends."""
    found = F.filter(tokens, lambda t: F.rlike(t, F.lit(r"^(?i:<style[\s/>])")))
    bodies = F.transform(found, lambda t: F.regexp_extract(t, rf"^<[a-zA-Z]{_INSIDE}>((?s:.*?))(?i:</style\s*>)?\z", 1))
    return F.array_join(bodies, "\n")


def elements(tokens: Column, lower: bool = True) -> Column:
    """Start tags as (tag, pos, raw) in document order."""
    return F.transform(F.filter(tokens, _is_tag), lambda t, i: F.struct(
        (F.lower(tag_name(t)) if lower else tag_name(t)).alias("tag"),
        i.alias("pos"),
        F.regexp_extract(t, rf"^(?:{_START})", 0).alias("raw"),
    ))


def _unescaped(text: Column) -> Column:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def attributes(raw: Column, lower: bool = True) -> Column:
    """Attributes of one start tag as (name, value), the last of equal names kept."""
    inner = F.regexp_replace(raw, r"^<[a-zA-Z][^\s/>]*|/?>$", " ")
    found = F.transform(F.regexp_extract_all(inner, F.lit(_ATTRIBUTE), 0), lambda a: F.struct(
        (F.lower(F.regexp_extract(a, _ATTRIBUTE, 1)) if lower else F.regexp_extract(a, _ATTRIBUTE, 1)).alias("name"),
        _unescaped(F.regexp_replace(F.regexp_extract(a, _ATTRIBUTE, 2), r"^[\"']|[\"']$", "")).alias("value"),
    ))
    # A one-element array binds the list to a name, so that it is computed once.
    return F.get(F.transform(F.array(found), lambda attrs: F.filter(
        attrs,
        lambda a, i: ~F.exists(F.slice(attrs, i + 2, F.size(attrs)), lambda b: b["name"] == a["name"]),
    )), F.lit(0))
