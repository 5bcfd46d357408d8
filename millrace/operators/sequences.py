"""Window-like operators: runs, even chunks, first values, best rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def runs(rows: DataFrame, by: str, page: str) -> DataFrame:
    """Consecutive values of ``page`` (distinct) within ``by``: first, last, length."""
    island = F.col(page) - F.row_number().over(Window.partitionBy(by).orderBy(page))
    return rows.select(by, page).distinct().withColumn("_mr_i", island).groupBy(by, "_mr_i").agg(F.min(page).alias("first"), F.max(page).alias("last"), F.count("*").alias("length")).drop("_mr_i")


def split_evenly(rows: DataFrame, by: str, page: str, most: int) -> DataFrame:
    """Add chunk: fewest nearly equal chunks of at most ``most`` rows, larger chunks first."""
    sizes = rows.groupBy(F.col(by).alias("_mr_b")).agg(F.count("*").alias("_mr_n"))
    ranked = rows.drop("chunk").withColumn("_mr_r", F.row_number().over(Window.partitionBy(by).orderBy(page)) - 1).join(sizes, F.col(by).eqNullSafe(F.col("_mr_b")))
    r, n = F.col("_mr_r"), F.col("_mr_n")
    k = F.ceil(n / most)
    size, more = F.floor(n / k), n % k
    chunk = F.when(r < more * (size + 1), F.floor(r / (size + 1))).otherwise(more + F.floor((r - more * (size + 1)) / size))
    return ranked.withColumn("chunk", chunk.cast("int") + 1).drop("_mr_r", "_mr_n", "_mr_b")


def first_filled(rows: DataFrame, by: str, order: str, columns: list[str]) -> DataFrame:
    """Per key the first non-null value of each column in order, and the number of distinct ones (a conflict if over 1)."""
    found = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns]
    return rows.groupBy(by).agg(*found, *(F.count_distinct(c).alias(f"{c}_values") for c in columns))


def fullest(rows: DataFrame, keys: list[str], columns: list[str], ties: list) -> DataFrame:
    """One row per key: the one with the most filled columns, ties by ``ties``."""
    filled = sum((F.col(c).isNotNull().cast("int") for c in columns[1:]), F.col(columns[0]).isNotNull().cast("int"))
    order = Window.partitionBy(*keys).orderBy(F.desc("_mr_filled"), *ties)
    return rows.withColumn("_mr_filled", filled).withColumn("_mr_rank", F.row_number().over(order)).where("_mr_rank = 1").drop("_mr_filled", "_mr_rank")
