"""Rule-based entities of a text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeloom.functions.arrays import let, rows_of

# (label, pattern), first match wins.
PATTERNS = [
    ("EMAIL", r"(?<![\w.+-])[\w.+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("URL", r"https?://[^\s<>\"']++"),
    ("IP", r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"),
    ("DATE", r"[0-9]{4}-[0-9]{2}-[0-9]{2}"),
    ("MONEY", r"[$€£] ?[0-9][0-9,]*(?:\.[0-9]+)?"),
    ("PROPER", r"\p{Lu}\p{Ll}++(?: \p{Lu}\p{Ll}++)++"),
]


def entities(text: Column, patterns: list[tuple[str, str]] | None = None) -> Column:
    """Entities as (text, label) in document order: one scan finds them, their label is that of
    the first pattern the found text matches whole."""
    rules = patterns or PATTERNS
    found = F.regexp_extract_all(text, F.lit("|".join(f"(?:{p})" for _, p in rules)), 0)

    def label(token: Column) -> Column:
        chosen = F.lit(None).cast("string")
        for name, pattern in reversed(rules):
            chosen = F.when(F.rlike(token, F.lit(rf"^(?:{pattern})$")), F.lit(name)).otherwise(chosen)
        return chosen

    return F.coalesce(
        F.transform(found, lambda t: F.struct(t.alias("text"), label(t).alias("label"))),
        F.array().cast("array<struct<text:string,label:string>>"),
    )


def gazetteer_entities(texts: DataFrame, terms: DataFrame, words: int | None = None) -> DataFrame:
    """Occurrences of listed terms in (file_path, content): (file_path, pos, text, label).

    `terms` has (term, label) with unique lower-case terms of at most `words` words, which is read
    from the terms if not given. Every run of words of a text is looked up. The join is left to
    the planner, which broadcasts the terms when they are small.
    """
    if words is None:
        words = terms.agg(F.max(F.size(F.split("term", " ")))).first()[0] or 1
    tokens = F.regexp_extract_all("content", F.lit(r"[\p{L}\p{N}]++"), 0)
    grams = let(tokens, lambda w: F.flatten(F.transform(F.sequence(F.lit(1), F.lit(words)), lambda n: F.filter(
        F.transform(w, lambda t, i: F.when(i + n <= F.size(w), F.struct(
            i.alias("pos"), F.array_join(F.slice(w, i + 1, n), " ").alias("text")))),
        lambda g: g.isNotNull()))))
    runs = rows_of(texts, grams, "file_path").select("file_path", "item.*")
    runs = runs.withColumn("term", F.lower("text"))
    return runs.join(terms, "term").select("file_path", "pos", "text", "label")
