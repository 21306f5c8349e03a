"""Attributes as known at event time: an as-of join in hash buckets, each by an embedded DuckDB.

Events and versions are hashed by entity into buckets of a bounded number of rows; in each bucket DuckDB runs
ASOF LEFT JOIN over the versions in the order they became available. A version that begins later than the event can't be
chosen. Hot entities are cut into slices of time with a bounded number of rows, so neither side of one entity must fit one task.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataforge.functions.values import open_end
from strataforge.operators.skew import key_counts
from strataforge.operators.sliced import ROWS_PER_SLICE, neighbours, range_slices, with_slices
from strataforge.session import materialise

#: Rows of events and versions that one bucket should hold; a bucket is read by one task.
ROWS_PER_BUCKET = 100_000

_ASOF = """
SELECT e.event_id, CASE WHEN e.at < v.valid_until THEN v.version END AS version
FROM events e ASOF LEFT JOIN versions v ON e.entity = v.entity AND e.slice = v.slice AND e.at >= v.valid_from
"""


def in_force(versions: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Versions with the period they are in force: to the earlier of their own end and the next version's begin.

    Input: entity, version, valid_from, valid_until. Of versions that begin together the one with the highest ``version``
    counts (the tie is resolved before the join). Versions without entity or begin and those in force at no time drop out.
    """
    known = versions.where("entity is not null and valid_from is not null")
    by_begin = known.groupBy("entity", "valid_from").agg(F.max(F.struct("version", "valid_until")).alias("v"))
    sliced, cut = with_slices(by_begin, "entity", "valid_from", rows_per_slice)
    ordered = neighbours(sliced, "entity", ["valid_from"], cut, after="following", columns=["valid_from"])
    until = F.least(F.coalesce("v.valid_until", open_end()), F.coalesce("following.valid_from", open_end()))
    return ordered.select("entity", F.col("v.version").alias("version"), "valid_from", until.alias("valid_until")).where("valid_from < valid_until")


def _join_bucket(events: pa.Table, versions: pa.Table) -> pa.Table:
    import duckdb

    with duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""}) as con:
        con.register("events", events)
        con.register("versions", versions)
        found = con.sql(_ASOF).to_arrow_table()
    return found.select(["event_id", "version"]).cast(pa.schema([("event_id", pa.string()), ("version", pa.int64())]))


def _cut_hot(events: DataFrame, versions: DataFrame, rows: int, rows_per_slice: int) -> tuple[DataFrame, DataFrame]:
    """Events and versions of hot entities with the slice they belong to.

    Both lie on one line in the order of time, a version before the events of its own moment; the line is cut into slices of
    a bounded number of rows. A slice's events see its own versions and the last one before it, which is copied in.
    """
    ts = "timestamp_ntz"
    begun = versions.select("entity", F.col("valid_from").alias("at"), F.lit(None).cast("string").alias("event_id"), F.struct("version", "valid_from", "valid_until").alias("v"))
    happened = events.select("entity", "at", "event_id", F.lit(None).cast(dict(begun.dtypes)["v"]).alias("v"))
    line = begun.withColumn("side", F.lit(0)).unionByName(happened.withColumn("side", F.lit(1)))
    line = range_slices(line, ["entity", "at", "side", "event_id"], rows, rows_per_slice, "time-line")
    per_slice = line.groupBy("entity", "slice").agg(F.max_by("v", F.when(F.col("side") == 0, F.col("at").cast(ts))).alias("last"))
    before = F.last("last", ignorenulls=True).over(Window.partitionBy("entity").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    carried = per_slice.select("entity", "slice", before.alias("v")).where("v is not null")
    seen = line.where("side = 0").select("entity", "slice", "v").unionByName(carried)
    return line.where("side = 1").select("event_id", "entity", "at", "slice"), seen.select("entity", "slice", "v.*")


def asof_version(events: DataFrame, versions: DataFrame, *, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """event_id, version (null: none in force) for every event.

    ``events``: event_id string, entity string, at timestamp; ``versions``: entity string, version long, valid_from,
    valid_until timestamp (null: open). An event at exactly valid_from sees the version, one at valid_until doesn't.
    Events with a null entity or time get null; repeated event rows come out as often as they went in; empty tables on
    either side are fine. Other columns can't clash: only those named are read.
    """
    # Both are read more than once: to find hot entities and to join. What they are made of is computed once.
    events = materialise(events.select("event_id", "entity", F.col("at").cast("timestamp_ntz").alias("at")), "events")
    versions = versions.select("entity", F.col("version").cast("long").alias("version"), F.col("valid_from").cast("timestamp_ntz").alias("valid_from"), F.col("valid_until").cast("timestamp_ntz").alias("valid_until"))
    versions = materialise(in_force(versions, rows_per_bucket), "versions")
    sides = key_counts(events, "entity").select("entity", F.col("n").alias("e"), F.lit(0).alias("v")).unionByName(key_counts(versions, "entity").select("entity", F.lit(0).alias("e"), F.col("n").alias("v")))
    counts = sides.groupBy("entity").agg(F.sum("e").alias("e"), F.sum("v").alias("v"))
    limit = max(1, rows_per_bucket // 2)
    total = counts.agg(F.sum(F.col("e") + F.col("v")).alias("rows"), F.max(F.col("e") + F.col("v")).alias("most")).first()
    buckets = max(int(events.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(total.rows or 0) // rows_per_bucket))
    lookup = events.where("entity is not null and at is not null")
    if (total.most or 0) <= limit:
        lookup, placed = (d.withColumn("slice", F.lit(0)) for d in (lookup, versions))
    else:
        hot = materialise(counts.where(F.col("e") + F.col("v") > limit), "hot-entities")
        rows = hot.agg(F.sum(F.col("e") + F.col("v"))).first()[0]
        # Hot entities are few: at most rows / limit; Spark chooses how to join by their size.
        keys = hot.select(F.col("entity").alias("_hot"))
        on = F.col("entity") == F.col("_hot")
        hot_events, hot_versions = _cut_hot(lookup.join(keys, on, "left_semi"), versions.join(keys, on, "left_semi"), rows, limit)
        lookup = lookup.join(keys, on, "left_anti").withColumn("slice", F.lit(0)).unionByName(hot_events)
        placed = versions.join(keys, on, "left_anti").withColumn("slice", F.lit(0)).unionByName(hot_versions)
    bucket = F.pmod(F.xxhash64("entity", "slice"), F.lit(buckets)).cast("int").alias("bucket")
    left = lookup.select(bucket, "event_id", "entity", "at", "slice").groupBy("bucket")
    right = placed.select(bucket, "entity", "version", "valid_from", "valid_until", "slice").groupBy("bucket")
    joined = left.cogroup(right).applyInArrow(_join_bucket, "event_id string, version bigint")
    rest = events.where("entity is null or at is null").select("event_id", F.lit(None).cast("long").alias("version"))
    return joined.unionByName(rest)
