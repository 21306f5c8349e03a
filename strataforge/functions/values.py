"""Shared readings of dirty values: filled strings, ids, hashes, open ends, and how times are printed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as not filled once trimmed and lower-cased.
PLACEHOLDERS = ("", "n/a", "unknown", "-", "tbc")
#: Fixed value: the end of a period that hasn't ended.
OPEN_END = "9999-12-31 00:00:00"


def filled(c: Column) -> Column:
    """True for a string that is neither null nor a placeholder; never null."""
    return F.coalesce(~F.lower(F.trim(c)).isin(*PLACEHOLDERS), F.lit(False))


def norm_id(c: Column) -> Column:
    return F.upper(F.trim(c))


def filled_id(c: Column) -> Column:
    """The id in its standard form, null where it isn't filled."""
    return F.when(filled(c), norm_id(c))


def norm_hash(c: Column) -> Column:
    return F.lower(F.trim(c))


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp_ntz")


def until(c: Column) -> Column:
    """A period's end, null meaning open."""
    return F.coalesce(c.cast("timestamp_ntz"), open_end())


def midnight(c: Column) -> Column:
    return c.cast("date").cast("timestamp_ntz")


def ts_text(c: Column) -> Column:
    """yyyy-MM-dd HH:mm:ss of a timestamp without zone, whatever the session's zone."""
    return F.substring(c.cast("timestamp_ntz").cast("string"), 1, 19)


def date_text(c: Column) -> Column:
    return c.cast("date").cast("string")


def is_true(c: Column) -> Column:
    """A flag, null read as false."""
    return F.coalesce(c, F.lit(False))
