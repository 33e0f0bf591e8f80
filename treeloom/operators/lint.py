"""Statistics of lint reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeloom.functions.arrays import rows_of

REPORT = (
    "array<struct<symbol:string,rule:string,ruleName:string,errorCount:bigint,warningCount:bigint,"
    "warnings:array<struct<rule:string>>>>"
)


def _one_each(names: Column) -> Column:
    return F.transform(
        F.filter(names, lambda n: n.isNotNull()),
        lambda n: F.struct(n.alias("violation"), F.lit(1).cast("bigint").alias("n")))


def _counted(items: Column, field: str, violation: str) -> Column:
    return F.transform(
        F.filter(F.transform(items, lambda i: i[field]), lambda n: n.isNotNull()),
        lambda n: F.struct(F.lit(violation).alias("violation"), n.alias("n")))


def lint_events(reports: DataFrame) -> DataFrame:
    """One row per violation of (file_path, language, report), where report is a JSON array.
    Items without the key of their language are skipped."""
    items = F.from_json("report", REPORT)
    lang = F.col("language")
    nested = F.flatten(F.filter(
        F.transform(F.col("items"), lambda i: F.transform(i["warnings"], lambda w: w["rule"])),
        lambda w: w.isNotNull()))
    events = (
        F.when(lang == "python", _one_each(F.transform("items", lambda i: i["symbol"])))
        .when(lang == "css", _one_each(F.concat(F.transform("items", lambda i: i["rule"]), nested)))
        .when(lang == "typescript", _one_each(F.transform("items", lambda i: i["ruleName"])))
        .when(lang == "javascript", F.concat(
            _counted(F.col("items"), "errorCount", "error"), _counted(F.col("items"), "warningCount", "warning")))
    )
    rows = rows_of(reports.withColumn("items", items), events, "file_path", "language")
    return rows.select("file_path", "language", "item.*")


def lint_stats(events: DataFrame) -> DataFrame:
    return events.groupBy("violation").agg(F.sum("n").alias("n"))
