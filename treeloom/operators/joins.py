"""Look-ups that stay balanced when one key holds a large share of the rows.

    rows = salted(rows, ["file_path"])
    asked = questions(rows, on)          # one row per distinct key
    answers = ...                        # asked with answer columns, still one row per key
    rows = attach(rows, answers, on)

The rows of one key go to up to a third of the shuffle partitions, so that a key with a third of
all rows gets a third of the tasks. An answer is copied only to the salts its key really has, so
there are never more copies than rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_SALTS = 16


def salted(rows: DataFrame, spread: list[str]) -> DataFrame:
    """Adds a salt, taken from the hash of the `spread` columns."""
    salts = max(MIN_SALTS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 3)
    return rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))


def questions(rows: DataFrame, on: list[str]) -> DataFrame:
    return rows.groupBy(*on).agg(F.collect_set("_salt").alias("_salts"))


def attach(rows: DataFrame, answers: DataFrame, on: list[str]) -> DataFrame:
    copies = answers.withColumn("_salt", F.explode("_salts")).drop("_salts")
    return rows.join(copies, [*on, "_salt"], "left").drop("_salt")
