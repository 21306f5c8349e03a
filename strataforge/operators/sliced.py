"""Looking at a key's earlier and later rows when one key may hold a large part of all rows.

Keys with more rows than a task should sort are cut into slices of about that many rows, by ranges of the whole order that the
windows have, so that a burst of rows of one moment is cut as well. Windows run inside slices; what lies beyond a slice's edge
comes from one row a slice (its first and last row, its size), which an outer window puts in order. Common keys are one
slice, numbered -1, and have no edges. Where counting finds no key to cut, all this is left away and the windows are plain
ones; the rows that come out are the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataforge.session import materialise

#: Rows of one key that one task should sort.
ROWS_PER_SLICE = 1_000_000


def range_slices(df: DataFrame, order: Sequence[str], rows: int, rows_per_slice: int, name: str) -> DataFrame:
    """df with a column slice that never falls along the order; each slice has about rows_per_slice of the rows.

    Written once to the shared folder, as a second division could differ. How even the slices are rests on Spark's sample of the
    order; what they hold doesn't. Rows equal in the whole order are one slice's.
    """
    slices = max(1, -(-rows // rows_per_slice))
    return materialise(df.repartitionByRange(slices, *order).withColumn("slice", F.spark_partition_id()), name)


def with_slices(df: DataFrame, key: str, order: str | Sequence[str], rows_per_slice: int = ROWS_PER_SLICE) -> tuple[DataFrame, bool]:
    """df with a column slice that never falls along a key's order (nulls first), -1 for keys that need no cutting; and whether any does."""
    order = [order] if isinstance(order, str) else list(order)
    hot = df.groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_slice)
    total = hot.agg(F.sum("_n")).first()[0]
    if not total:
        return df.withColumn("slice", F.lit(-1)), False
    hot = materialise(hot, "hot-keys")
    is_hot = F.col(key).eqNullSafe(F.col("_hot"))
    large = range_slices(df.join(hot.select("_hot"), is_hot, "left_semi"), [key, *order], total, rows_per_slice, "slices")
    return df.join(hot.select("_hot"), is_hot, "left_anti").withColumn("slice", F.lit(-1)).unionByName(large), True


def _windows(key: str, order: list[str], cut: bool):
    return Window.partitionBy(key, *["slice"] * cut).orderBy(*order), Window.partitionBy("_key").orderBy("_slice")


def _edges(df: DataFrame, key: str, **aggs: Column) -> DataFrame:
    cut = df.where("slice >= 0").groupBy(F.col(key).alias("_key"), F.col("slice").alias("_slice"))
    return cut.agg(*[c.alias(n) for n, c in aggs.items()])


def _beside(df: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    return df.join(edges, F.col(key).eqNullSafe(F.col("_key")) & (F.col("slice") == F.col("_slice")), "left").drop("_key", "_slice")


def neighbours(df: DataFrame, key: str, order: list[str], cut: bool, *, after: str | None = None, before: str | None = None, columns: list[str]) -> DataFrame:
    """df with structs of the columns of the key's next row (named ``after``) and of the one before it (``before``); null where there is none."""
    inner, outer = _windows(key, order, cut)
    row = F.struct(*columns)
    names = {**({after: F.lead(row).over(inner)} if after else {}), **({before: F.lag(row).over(inner)} if before else {})}
    if not cut:
        return df.withColumns(names)
    df = materialise(df, "slices")
    edges = _edges(df, key, _first=F.min(F.struct(*order, row.alias("_row"))), _last=F.max(F.struct(*order, row.alias("_row"))))
    edges = edges.select("_key", "_slice", F.lead("_first._row").over(outer).alias("__edge_next"), F.lag("_last._row").over(outer).alias("__edge_prior"))
    out = _beside(df.withColumns(names), edges, key)
    whole = {n: F.coalesce(F.col(n), F.col("__edge_next" if n == after else "__edge_prior")) for n in names}
    return out.withColumns(whole).drop("__edge_next", "__edge_prior")


def last_known(df: DataFrame, key: str, order: list[str], cut: bool, value: str, name: str) -> DataFrame:
    """df with the last non-null ``value`` of the key up to and including the row."""
    inner, outer = _windows(key, order, cut)
    inside = F.last(value, ignorenulls=True).over(inner.rowsBetween(Window.unboundedPreceding, 0))
    if not cut:
        return df.withColumn(name, inside)
    df = materialise(df, "slices")
    edges = _edges(df, key, _v=F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))))
    edges = edges.select("_key", "_slice", F.last("_v", ignorenulls=True).over(outer.rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))
    return _beside(df.withColumn(name, inside), edges, key).withColumn(name, F.coalesce(name, "_carried")).drop("_carried")


def numbered(df: DataFrame, key: str, order: list[str], cut: bool, name: str) -> DataFrame:
    """df with the row's place in its key, from 0."""
    inner, outer = _windows(key, order, cut)
    place = (F.row_number().over(inner) - 1).cast("long")
    if not cut:
        return df.withColumn(name, place)
    df = materialise(df, "slices")
    edges = _edges(df, key, _n=F.count(F.lit(1)))
    edges = edges.select("_key", "_slice", F.sum("_n").over(outer.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    return _beside(df.withColumn(name, place), edges, key).withColumn(name, F.col(name) + F.coalesce("_before", F.lit(0))).drop("_before")
