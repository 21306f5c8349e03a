"""Surrogate keys: consecutive numbers in order, without one task seeing all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataforge.session import materialise


def ordered_ids(df: DataFrame, order: list[str], name: str, start: int = 1) -> DataFrame:
    """df with consecutive ids in the order of the columns, like row_number over everything.

    Rows are divided by ranges of the order and written once, since a second division could differ; each range's offset
    is the number of rows in the ranges before it, and inside a range rows are numbered by a window.
    """
    ranged = materialise(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_offset"))
    # One row for each shuffle partition; read from a file its size is known, and Spark joins it without a shuffle of the rows.
    numbered = ranged.join(materialise(offsets, "offsets"), "_range")
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return numbered.withColumn(name, (inside + F.col("_offset") + F.lit(start - 1)).cast("long")).drop("_range", "_offset")


def max_key(df: DataFrame, name: str) -> int:
    """The greatest numeric key; text that is no number doesn't count; 0 if there is none."""
    found = df.agg(F.max(F.col(name).cast("string").try_cast("long")).alias("m")).first()
    return found.m or 0
