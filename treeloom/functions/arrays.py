"""Helpers over array columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, however often `use` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def with_last_per_key(df: DataFrame, column: str, key: str) -> DataFrame:
    """Keep the greatest struct of each `key` in an array of structs that start with that field.

    The array is sorted once and compared with its neighbour, so a row costs n log n and no
    shuffle. The result is ordered by key.
    """
    return df.withColumn(column, F.array_sort(column)).withColumn(
        column,
        F.filter(
            F.col(column),
            lambda e, i: F.coalesce(F.get(F.col(column), i + 1)[key] != e[key], F.lit(True)),
        ),
    )


def to_map(entries: Column, key: str, value: str) -> Column:
    """A map from an array of structs whose keys are already unique."""
    return F.map_from_entries(F.transform(entries, lambda e: F.struct(e[key], e[value])))


def rows_of(df: DataFrame, array: Column | str, *keep: Column | str) -> DataFrame:
    """The `keep` columns with one row (ord, item) per array element.

    A plain explode makes the optimizer test the array for being non-empty below the projection
    that computes it, which computes it twice; the outer form does not.
    """
    return df.select(*keep, F.posexplode_outer(array).alias("ord", "item")).where(F.col("ord").isNotNull())
