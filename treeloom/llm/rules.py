"""Quality rules whose cutoffs are controlled for risk.

`statistics` counts words, symbols and repeats of a text. `fit` picks a cutoff for each rule and
stratum: among the labelled good documents of the stratum, an exact binomial test must show that the
rule rejects no more than `limit / number of rules` of them. A rule's cutoffs are tested from the most
lenient to the strictest and testing stops at the first that fails, which needs no further correction;
over strata and rules the level is divided (Bonferroni). Of the cutoffs that pass, the one is taken that
rejects the most labelled bad documents less FALSE_COST for each good one, the most lenient if equal. A
stratum without enough labels, or one in which no cutoff gains by this, gets none and rejects nothing. A document is kept if it passes the base rules and every cutoff of its stratum.

Defined cases: a null or empty text has no words and fails the base rules; a null stratum is the
stratum ''; labels that disagree on a document count as the lowest; null labels are left out; a null
doc_id has no label; repeated rows are each judged; without labels only the base rules apply.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeloom.llm import textarrays as ta
from treeloom.operators import joins
from treeloom.session import materialize

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
TYPE = "struct<" + ",".join(f"{f}:bigint" for f in FIELDS) + ">"
#: Rule names with their value of a row; a document is rejected if the value is over the cutoff.
RULES = ["symbols", "dup_lines", "repeats"]
#: Cutoffs from the most lenient to the strictest.
GRID = [round(0.5 * 0.9 ** i, 6) for i in range(60)]
LIMIT, LEVEL = 0.05, 0.05
FALSE_COST = 10
#: Strata up to this number are sent to all tasks.
BROADCAST_STRATA = 10_000


def _repeat_words(hashes: np.ndarray) -> int:
    """Words inside a window of WINDOW words that occurs twice or more."""
    if len(hashes) <= WINDOW:
        return 0
    found = ta.windows(hashes, WINDOW)
    order = np.argsort(found, kind="stable")
    same = found[order][1:] == found[order][:-1]
    if not same.any():
        return 0
    hit = np.zeros(len(found), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    cover = np.zeros(len(hashes) + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def _statistics(texts: pa.Array) -> pa.Array:
    data, offsets = ta.buffers(texts)
    out = np.zeros((len(FIELDS), len(offsets) - 1), np.int64)
    for a, b in ta.chunks(offsets):
        part, off = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        w = ta.words(part, off)
        lengths = np.bincount(w.row, w.end - w.start, b - a).astype(np.int64)
        inside = np.concatenate(([0], np.cumsum((part & 0xC0) == 0x80)))[off]
        out[0, a:b] = np.diff(w.first)
        out[1, a:b] = lengths - np.diff(inside)
        raw = part.tobytes()
        for i in range(b - a):
            text = raw[off[i]:off[i + 1]]
            out[2, a + i] = len(text) - len(text.translate(None, SYMBOLS))
            lines = [x for x in text.split(b"\n") if x and not x.isspace()]
            out[3, a + i] = len(lines) - len(set(lines))
            out[4, a + i] = _repeat_words(w.hash[w.first[i]:w.first[i + 1]])
            out[5, a + i] = len(lines)
    return pa.StructArray.from_arrays([pa.array(x) for x in out], FIELDS)


def statistics(text: Column | str) -> Column:
    """The counts of FIELDS for a text, as one struct."""
    return F.arrow_udf(_statistics, TYPE)(text)


def _values(s: Column) -> dict[str, Column]:
    share = lambda a, b: F.when(s[b] > 0, s[a] / s[b]).otherwise(F.lit(0.0))
    return {"symbols": share("n_symbols", "word_chars"), "dup_lines": share("n_dup_lines", "n_lines"),
            "repeats": share("n_repeat_words", "n_words")}


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 20) | (100 * s["n_repeat_words"] > 30 * s["n_words"])


def chance(n: int, k: int, share: float) -> float:
    """The chance of k or fewer successes in n trials."""
    if k >= n:
        return 1.0
    i = np.arange(1, k + 1)
    steps = np.log(n - i + 1) - np.log(i) + np.log(share) - np.log1p(-share)
    logs = n * np.log1p(-share) + np.concatenate(([0.0], np.cumsum(steps)))
    top = logs.max()
    return float(min(1.0, np.exp(top) * np.exp(logs - top).sum()))


def choose(counts: pd.DataFrame, limit: float, level: float) -> float | None:
    """The cutoff of one rule and stratum. counts: how many cutoffs a document is over (`passed`), good, bad."""
    good, bad = (np.zeros(len(GRID) + 1, np.int64) for _ in range(2))
    np.add.at(good, counts["passed"], counts["good"])
    np.add.at(bad, counts["passed"], counts["bad"])
    n = int(good.sum())
    best, found = 0, None
    for i, cutoff in enumerate(GRID):
        over = len(GRID) - i  # who is over this cutoff is over all later ones
        k = int(good[over:].sum())
        if n == 0 or chance(n, k, limit) > level:
            break
        value = int(bad[over:].sum()) - FALSE_COST * k
        if value > best:
            best, found = value, cutoff
    return found


def fit(stats: DataFrame, labels: DataFrame, limit: float = LIMIT, level: float = LEVEL) -> DataFrame:
    """Rows (stratum, one column for each rule) from rows (doc_id, stratum, stats) and (doc_id, quality)."""
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    values = _values(F.col("stats"))
    over = lambda v: F.aggregate(F.array(*map(F.lit, GRID)), F.lit(0), lambda n, c: n + (v > c).cast("int"))
    counts = (
        stats.where(~base_failed(F.col("stats"))).select("doc_id", "stratum", *[v.alias(k) for k, v in values.items()])
        .join(marks, "doc_id")
        .select("stratum", "quality", F.explode(F.array(*[
            F.struct(F.lit(k).alias("rule"), over(F.col(k)).alias("passed")) for k in RULES])).alias("r"))
        .groupBy("stratum", "r.rule", "r.passed")
        .agg(F.sum(F.when(F.col("quality") >= 1, 1).otherwise(0)).alias("good"),
             F.sum(F.when(F.col("quality") < 1, 1).otherwise(0)).alias("bad")))
    counts = materialize(counts, "rule-counts")
    tests = counts.select("stratum", "rule").distinct().count()

    def cutoff(rows: pd.DataFrame) -> pd.DataFrame:
        found = choose(rows, limit / len(RULES), level / tests)
        return pd.DataFrame({"stratum": [rows["stratum"].iloc[0]], "rule": [rows["rule"].iloc[0]], "cutoff": [found]})

    chosen = counts.groupBy("stratum", "rule").applyInPandas(cutoff, "stratum string, rule string, cutoff double")
    return chosen.groupBy("stratum").agg(*[
        F.max(F.when(F.col("rule") == k, F.col("cutoff"))).alias(k) for k in RULES])


def verdicts(stats: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Adds base_failed, kept and failed_rule to rows with `stratum` and `stats`; `cutoffs` should be a written table."""
    cutoffs = cutoffs.select("stratum", F.struct(*RULES).alias("_cut"))
    if cutoffs.count() <= BROADCAST_STRATA:
        rows = stats.join(F.broadcast(cutoffs), "stratum", "left")
    else:
        rows = joins.salted(stats, ["stats"])
        asked = joins.questions(rows, ["stratum"]).join(cutoffs, "stratum")
        rows = joins.attach(rows, asked, ["stratum"])
    values = _values(F.col("stats"))
    failed = F.when(base_failed(F.col("stats")), "base")
    for k in RULES:
        failed = failed.when(values[k] > F.col("_cut")[k], k)
    return rows.withColumn("failed_rule", failed).withColumn("kept", F.col("failed_rule").isNull()).withColumn(
        "base_failed", base_failed(F.col("stats"))).drop("_cut")


def _measured(docs: DataFrame) -> DataFrame:
    return ta.bounded(docs).withColumn("stratum", F.coalesce("lang", F.lit(""))).withColumn("stats", statistics("text"))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, stratum, stats, base_failed, kept, failed_rule."""
    stats = materialize(_measured(docs.select("doc_id", "lang", "text")).drop("text", "lang"), "rule-stats")
    return verdicts(stats, materialize(fit(stats, labels), "rule-cutoffs"))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns."""
    stats = materialize(_measured(docs.select("doc_id", "lang", "text")).drop("text", "lang"), "rule-stats")
    cutoffs = materialize(fit(stats, labels), "rule-cutoffs")
    wrapped = ta.bounded(docs).select(F.struct("*").alias("doc"))
    rows = wrapped.select("doc", F.coalesce("doc.lang", F.lit("")).alias("stratum"), statistics("doc.text").alias("stats"))
    return verdicts(rows, cutoffs).where("kept").select("doc.*")
