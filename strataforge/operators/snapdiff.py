"""What changed between consecutive full snapshots: one tagged union, one grouping.

Every record stands once as the "after" of its own snapshot and once as the "before" of the next one; grouping by
(key, snapshot) then brings at most one of each side together and their hashes tell added, removed and changed apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataforge.session import materialise


def snapshot_calendar(rows: DataFrame, batch: str) -> DataFrame:
    """The distinct snapshots in order: batch, n (from 1), next_batch. As many rows as there are snapshot days.

    Written down once: read from there its size is known, and Spark joins it without shuffling the other side."""
    days = Window.orderBy(batch)
    return materialise(
        rows.where(F.col(batch).isNotNull())
        .groupBy(batch)
        .agg(F.lit(1).alias("_one"))
        .select(batch, F.row_number().over(days).alias("n"), F.lead(batch).over(days).alias("next_batch")),
        "calendar",
    )


def snapshot_records(rows: DataFrame, calendar: DataFrame, *, key: Column, batch: str, is_record: Column, record_hash: Column, order: list[Column]) -> DataFrame:
    """One row for each key and snapshot with rows of the key: key, n, record_hash (null: no record).

    A key with rows but no record row keeps the record of the snapshot before, if it has one there. If several rows
    claim to be the record, the last by ``order`` and hash is taken. Null keys and null snapshots are no rows.
    """
    best = F.max(F.when(is_record, F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], record_hash.alias("h"))))
    per_snapshot = rows.where(key.isNotNull() & F.col(batch).isNotNull()).groupBy(key.alias("key"), F.col(batch)).agg(best.alias("best"))
    numbered = per_snapshot.join(calendar, batch).select("key", "n", "best")
    # A run is a stretch of consecutive snapshots in which the key has rows; records carry forward only inside it.
    per_key = Window.partitionBy("key").orderBy("n")
    runs = numbered.withColumn("run", F.col("n") - F.row_number().over(per_key))
    carried = F.last("best", ignorenulls=True).over(Window.partitionBy("key", "run").orderBy("n"))
    return runs.select("key", "n", carried["h"].alias("record_hash"), carried.isNotNull().alias("has_record"))


def diff_snapshots(records: DataFrame, calendar: DataFrame, batch: str) -> DataFrame:
    """batch, key, change_kind (added, removed, changed) for every snapshot but the first.

    ``records`` has key, n, record_hash, has_record. Null hashes compare like values. Empty input gives no rows.
    """
    sides = F.array(F.struct(F.col("n").alias("n"), F.lit(True).alias("after")), F.struct((F.col("n") + 1).alias("n"), F.lit(False).alias("after")))
    tagged = records.where("has_record").select("key", "record_hash", F.explode(sides).alias("side")).select("key", "record_hash", "side.*")
    pair = tagged.groupBy("key", "n").agg(
        F.max(F.when(F.col("after"), F.struct("record_hash"))).alias("new"),
        F.max(F.when(~F.col("after"), F.struct("record_hash"))).alias("old"),
    )
    kind = (
        F.when(F.col("old").isNull(), "added")
        .when(F.col("new").isNull(), "removed")
        .when(~F.col("new.record_hash").eqNullSafe(F.col("old.record_hash")), "changed")
    )
    days = calendar.where("n > 1").select("n", batch)
    return pair.select("key", "n", kind.alias("change_kind")).where("change_kind is not null").join(days, "n").select(batch, "key", "change_kind")
