"""Rolling totals over trailing days, days without activity included."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def daily_totals(rows: DataFrame, *, entity: Column, day: Column, amount: Column) -> DataFrame:
    """entity, day, amount, n. Rows without an entity or a day belong nowhere; a null amount counts as 0.

    The partial sums are taken before the shuffle, so after it no entity has more rows than there are days.
    """
    return (
        rows.select(entity.alias("entity"), day.alias("day"), F.coalesce(amount, F.lit(0).cast("decimal(18,2)")).alias("amount"))
        .where("entity is not null and day is not null")
        .groupBy("entity", "day")
        .agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n"))
    )


def densify(daily: DataFrame, last_day: str, scale: int = 2) -> DataFrame:
    """A row for every entity and calendar day from the entity's first day to last_day.

    The product of entity and calendar is made without a join: each active day also yields the quiet days that follow it
    up to the next active one, so the amounts need not be looked up again and the entity's partitioning stays. Amounts are
    whole numbers of their last digit (``scale``) from here on, as sums of those are far cheaper in sliding windows; a day or
    period beyond 64 bits (92 quadrillion with two digits) raises, it doesn't go wrong.
    """
    end = F.lit(last_day).cast("date")
    following = F.date_sub(F.lead("day").over(Window.partitionBy("entity").orderBy("day")), 1)
    until = F.coalesce(following, end)
    spread = daily.where(F.col("day") <= end).withColumn("until", until)
    days = F.explode(F.sequence("day", "until")).alias("on_date")
    dense = spread.select("entity", "day", "amount", "n", days)
    active = F.col("on_date") == F.col("day")
    return dense.select(
        "entity",
        "on_date",
        F.when(active, (F.col("amount") * 10**scale).cast("long")).otherwise(F.lit(0).cast("long")).alias("units"),
        F.when(active, F.col("n")).otherwise(F.lit(0)).alias("n"),
    )


def trailing(dense: DataFrame, periods: Sequence[int] = (7, 30), scale: int = 2) -> DataFrame:
    """entity, on_date, and for each period p: total_p, n_p, avg_p (total / p; days before the first count as zero)."""
    w = Window.partitionBy("entity").orderBy("on_date")
    out = [F.col("entity"), F.col("on_date")]
    for p in periods:
        over = w.rowsBetween(-(p - 1), 0)
        total = (F.sum("units").over(over).cast("decimal(20,0)") / F.lit(10**scale).cast("decimal(18,0)")).cast(f"decimal(38,{scale})")
        out += [total.alias(f"total_{p}"), F.sum("n").over(over).alias(f"n_{p}")]
    sums = dense.select(*out)
    return sums.withColumns({f"avg_{p}": (F.col(f"total_{p}").cast("decimal(28,6)") / F.lit(p)).cast("decimal(28,6)") for p in periods})


def rolling_totals(rows: DataFrame, *, entity: Column, day: Column, amount: Column, last_day: str, periods: Sequence[int] = (7, 30)) -> DataFrame:
    """``amount`` is a decimal."""
    daily = daily_totals(rows, entity=entity, day=day, amount=amount)
    scale = daily.schema["amount"].dataType.scale
    return trailing(densify(daily, last_day, scale), periods, scale)
