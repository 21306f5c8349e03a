"""Finding hot keys and spreading their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """key, n; counted before the shuffle, so a hot key costs one row per map task."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def has_hot_key(df: DataFrame, key: str, rows_per_task: int) -> bool:
    """Whether one key (null being one) has more rows than a task should get."""
    most = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    return (most or 0) > rows_per_task


def hot_keys(df: DataFrame, key: str, rows_per_task: int) -> DataFrame:
    """key, salts: keys with more rows than a task should get, and over how many tasks to spread them.

    There are at most rows / rows_per_task of them; Spark chooses how to join by their size.
    """
    n = F.ceil(F.col("n") / F.lit(rows_per_task)).cast("int")
    return key_counts(df, key).where(F.col("n") > rows_per_task).select(key, n.alias("salts"))


def spread(df: DataFrame, hot: DataFrame, key: str, by: list[str]) -> DataFrame:
    """df with a column salt: 0 for common keys, else chosen by the row's own ``by`` columns (so a retry gives the same)."""
    salt = F.when(F.col("salts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*by), F.col("salts")).cast("int"))
    return df.join(hot, key, "left").withColumn("salt", salt).drop("salts")


def replicate(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """The other side: a row for each salt of its key."""
    salts = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1))
    return df.join(hot, key, "left").withColumn("salt", salts).drop("salts")
