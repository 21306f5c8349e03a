"""Applying a feed of inserts, updates and deletes: a commutative fold.

The state of a key is the maximum of struct(sequence, operation, payload) over all its rows. A maximum doesn't depend on
order and ignores repeats, so late, repeated and out-of-order changes need no sorting; partial maxima are taken before the
shuffle, so a hot key costs one row per map task. Deletes stay in the state as tombstones, so that an older change that
arrives later can't bring the record back.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_delete(action: Column) -> Column:
    """An action whose first non-blank letter is D, either case; null and blank actions put the row."""
    return F.coalesce(F.upper(F.ltrim(action)).startswith("D"), F.lit(False))


def as_changes(rows: DataFrame, *, key: Column, sequence: Sequence[Column], deleted: Column, payload: dict[str, Column]) -> DataFrame:
    """Rows in the fold's form: key, change struct(sequence, deleted, payload). Rows with a null key or null first
    sequence column aren't changes."""
    change = F.struct(
        F.struct(*[c.alias(f"s{i}") for i, c in enumerate(sequence)]).alias("sequence"),
        deleted.alias("deleted"),
        F.struct(*[c.alias(n) for n, c in payload.items()]).alias("payload"),
    )
    return rows.where(key.isNotNull() & sequence[0].isNotNull()).select(key.alias("key"), change.alias("change"))


def fold_changes(*feeds: DataFrame) -> DataFrame:
    """State (key, change) of all feeds; base rows and an earlier state are feeds like any other.

    Repeats collapse. Rows with the same sequence are decided by (deleted, payload), so the result is the same in any
    order. Nulls in later sequence columns rank lowest. No rows give no state.
    """
    rows = reduce(DataFrame.unionByName, feeds)
    return rows.groupBy("key").agg(F.max("change").alias("change"))


def live(state: DataFrame) -> DataFrame:
    """Keys that exist after all changes, with the payload's columns."""
    return state.where(~F.col("change.deleted")).select("key", "change.payload.*")
