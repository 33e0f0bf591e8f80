"""Metrics of a file record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def function_count(language: Column, functions: Column) -> Column:
    counted = F.lower(language).isin("python", "javascript")
    return F.when(counted, F.coalesce(F.when(functions.isNotNull(), F.size(functions)), F.lit(0))).otherwise(
        F.lit(0)).cast("bigint")


def comment_density(comments: Column, loc: Column) -> Column:
    count = F.coalesce(F.when(comments.isNotNull(), F.size(comments)), F.lit(0))
    return F.when(loc > 0, count / loc).otherwise(F.lit(0.0)).cast("double")
