"""References to records that do not exist: distinct keys against the parents by a left anti-join, then joined back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataforge.operators.skew import has_hot_key, hot_keys, replicate, spread
from strataforge.session import materialise

#: Distinct references of one key that one task should get.
ROWS_PER_TASK = 200_000


def orphan_keys(children: DataFrame, parents: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """ref_key, at: distinct references for which no parent row is in force at that time.

    ``children``: ref_key, at; ``parents``: ref_key, valid_from, valid_until (excluded). Null references aren't references;
    a reference with null time has no parent in force. Distinct before the shuffle; hot references are spread over
    salts and their parent rows, of which there must be few per key, are copied to each.
    """
    wanted = children.where("ref_key is not null").select("ref_key", "at").distinct()
    known = parents.where("ref_key is not null").select("ref_key", "valid_from", "valid_until")
    if has_hot_key(children.where("ref_key is not null"), "ref_key", rows_per_task):
        hot = hot_keys(wanted, "ref_key", rows_per_task)
        wanted, known = spread(wanted, hot, "ref_key", ["ref_key", "at"]), replicate(known, hot, "ref_key")
    else:
        wanted, known = (d.withColumn("salt", F.lit(0)) for d in (wanted, known))
    w, p = wanted.alias("w"), known.alias("p")
    on = (
        (F.col("w.ref_key") == F.col("p.ref_key")) & (F.col("w.salt") == F.col("p.salt"))
        & (F.col("p.valid_from") <= F.col("w.at")) & (F.col("w.at") < F.col("p.valid_until"))
    )
    return w.join(p, on, "left_anti").select("ref_key", "at")


def orphan_references(children: DataFrame, parents: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The rows of ``children`` (record_key, ref_key, at) whose reference is an orphan; repeated rows stay repeated."""
    # Read for its keys and again for its rows: what it is made of is computed once.
    children = materialise(children.select("record_key", "ref_key", "at"), "references")
    lost = orphan_keys(children, parents, rows_per_task).select(F.col("ref_key").alias("k"), F.col("at").alias("t"))
    return children.join(lost, (F.col("ref_key") == F.col("k")) & F.col("at").eqNullSafe(F.col("t")), "left_semi")


def orphan_report(found: DataFrame) -> DataFrame:
    """Counts per table and period of rows with child_table, period_month, ref_key."""
    return found.groupBy("child_table", "period_month").agg(F.count(F.lit(1)).alias("n_references"), F.countDistinct("ref_key").alias("n_keys"))
