"""STAGING to CONFORMED without row-level updates: dimensions, facts, version history, integrity, summaries.

Every merge is a function of the table as it is and the batch. It comes in two forms: the table as it will be, whole, and the
rows or parts that change, which sinks.writers.VersionedTable adds to or replaces without writing the rest again. Times and
run ids are given, so the same batch gives the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataforge.functions.values import open_end
from strataforge.operators.ids import max_key, ordered_ids
from strataforge.operators.sliced import ROWS_PER_SLICE, neighbours, with_slices
from strataforge.operators.staging import eligible, may_be_merged, with_parents
from strataforge.session import materialise


@dataclass(frozen=True)
class Change:
    """What a batch does to a table: rows added to parts, and parts whose rows are replaced. What isn't named stays as it is."""

    added: Mapping[str, DataFrame] = field(default_factory=dict)
    replaced: Mapping[str, DataFrame] = field(default_factory=dict)


MISSING = ("soft_delete", "ignore")
#: Parts of a dimension's table: the current rows, and the closed ones, to which a batch only adds.
CURRENT, CLOSED = "current", "closed"


def payload_columns(df: DataFrame) -> list[str]:
    """The business columns: those that don't begin with an underscore."""
    return [c for c in df.columns if not c.startswith("_")]


def scd2_changes(
    dim: DataFrame, staged: DataFrame, *, business_key: str, surrogate_key: str, attributes: Sequence[str], run_id: str, batch_timestamp: str, missing: str = "soft_delete",
    apply_deletes: bool = False, parents: Sequence[tuple] = (), numbered_in: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """What a batch does to a dimension: the rows it closes, and all rows that are current after it.

    ``dim``: surrogate_key, business_key column, attributes and any of schema.SCD2; only its current rows are read, but for
    the highest surrogate key, which is taken from ``numbered_in`` where the closed rows are kept elsewhere. ``staged``: one
    staged batch. New keys are inserted; a changed hash (null-safe) closes the current row at the source's effective_at, or
    the batch time, and inserts a new one; a current key that isn't in the batch at all is closed as deleted if the batch has
    a full row and ``missing`` is soft_delete. An ambiguous or filtered row still counts as being in the batch. DELETE rows
    never insert; with ``apply_deletes`` they close the row as deleted. A row whose ``parents`` (see staging.with_parents)
    aren't current isn't merged; their surrogate keys fill the columns named for them. A null key names nobody and isn't
    merged. Two rows of a key that may both be merged raise: which of them counts would be chance. New rows get
    consecutive numbers in key order.

    The batch and the current rows are shuffled by key once; the outcome for each key is written to the shared folder, and
    closed rows, new rows and numbers are taken from there.
    """
    if missing not in MISSING:
        raise ValueError(f"missing must be one of {MISSING}, not {missing!r}")
    at = F.lit(batch_timestamp).cast("timestamp_ntz")
    have = set(staged.columns)
    text = lambda c: F.col(c).cast("string") if c in have else F.lit(None).cast("string")
    row = F.struct(
        F.struct(*attributes).alias("a"), F.col("effective_at").try_cast("timestamp_ntz").alias("eff"), (F.col("updated_at").try_cast("timestamp_ntz") if "updated_at" in have else F.lit(None).cast("timestamp_ntz")).alias("upd"),
        F.col("_record_hash").alias("h"), F.coalesce(F.upper(F.trim("_delta_action")) == "DELETE", F.lit(False)).alias("delete"),
        text("_source_system_id").alias("system"), text("_source_dataset_id").alias("dataset"), F.col("_parent_keys").alias("p"),
    )
    good = may_be_merged() & F.col("_parents")
    by_key = with_parents(staged, parents).groupBy(F.col(business_key).alias("_k")).agg(
        F.max_by(row, F.when(good, F.lit(1))).alias("_s"), F.count_if(good).alias("_n"), F.max(F.coalesce(F.col("_load_type") == "full", F.lit(False))).alias("_full"),
    )
    current = dim.where("is_current").select(F.col(business_key).alias("_k"), F.struct(*dim.columns).alias("_d"))
    twice = F.raise_error(F.concat(F.lit(f"Two rows of {business_key} may be merged: "), F.col("_k").cast("string"))).cast(by_key.schema["_s"].dataType)
    met = by_key.withColumn("_s", F.when((F.col("_n") > 1) & F.col("_k").isNotNull(), twice).otherwise(F.col("_s"))).withColumn("_seen", F.lit(True)).drop("_n")
    met = materialise(current.join(met, "_k", "full_outer"), "merged-keys")
    full = missing == "soft_delete" and bool(met.agg(F.max("_full")).first()[0])
    has_cur, has_src = F.col("_d").isNotNull(), F.col("_s").isNotNull() & F.col("_k").isNotNull() & ~F.coalesce("_s.delete", F.lit(False))
    gone = has_cur & F.col("_seen").isNull() & F.lit(full)
    if apply_deletes:
        gone = gone | (has_cur & F.coalesce("_s.delete", F.lit(False)))
    kind = (
        F.when(has_cur & has_src & ~F.col("_s.h").eqNullSafe(F.col("_d.source_record_hash")), "change")
        .when(~has_cur & has_src, "insert")
        .when(gone, "delete")
        .when(has_cur, "keep")
    )
    known = met.withColumn("_kind", kind)
    deleted = F.col("_kind") == "delete"
    ends = {
        "effective_to": F.when(deleted, at).otherwise(F.coalesce("_s.eff", at)), "is_current": F.lit(False), "deleted_flag": deleted, "updated_run_id": F.lit(run_id), "updated_at": at,
    }
    types = dict(dim.dtypes)
    closed = known.where("_kind in ('change', 'delete')").select(*[(ends[c].cast(types[c]) if c in ends else F.col(f"_d.{c}")).alias(c) for c in dim.columns])
    kept = known.where("_kind = 'keep'").select("_d.*")
    first = max_key(dim if numbered_in is None else numbered_in, surrogate_key) + 1
    fresh = ordered_ids(known.where("_kind in ('insert', 'change')").select("_k", "_s"), ["_k"], "_sk", first)
    values: dict[str, Column] = {
        "business_key": F.col("_k"), surrogate_key: F.col("_sk"), business_key: F.col("_k"), **{a: F.col(f"_s.a.{a}") for a in attributes}, "effective_from": F.col("_s.eff"), "effective_to": open_end(),
        "is_current": F.lit(True), "deleted_flag": F.lit(False), "source_system_id": F.col("_s.system"), "source_dataset_id": F.col("_s.dataset"), "source_effective_at": F.col("_s.eff"),
        "source_updated_at": F.col("_s.upd"), "source_record_hash": F.col("_s.h"), "created_run_id": F.lit(run_id), "updated_run_id": F.lit(run_id), "created_at": at, "updated_at": at,
        **{lookup[1]: F.col(f"_s.p.{lookup[1]}") for _, _, _, *lookup in parents if lookup},
    }
    new = fresh.select(*[(values[c] if c in values else F.lit(None)).cast(types[c]).alias(c) for c in dim.columns])
    return closed, kept.unionByName(new)


def scd2_merge(dim: DataFrame, staged: DataFrame, **options) -> DataFrame:
    """The dimension after one batch, whole; see scd2_changes for the rules and for what to write instead of the whole."""
    closed, current = scd2_changes(dim, staged, **options)
    return dim.where("not coalesce(is_current, false)").unionByName(closed).unionByName(current)


def scd2_change(dim: DataFrame, current: DataFrame, staged: DataFrame, **options) -> Change:
    """The same as a change of a table whose current rows are a part of their own: closed rows are added, the current part replaced."""
    closed, now = scd2_changes(current, staged, numbered_in=dim, **options)
    return Change(added={CLOSED: closed}, replaced={CURRENT: now})


def scd1_merge(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Overwrite in place: rows of ``source`` replace those with their key, others stay. The last of repeated source rows isn't
    defined, so they must be unique by key. A null key matches a null key."""
    rest = target.join(source.select(F.col(key).alias("_k")), F.col(key).eqNullSafe(F.col("_k")), "left_anti")
    return rest.unionByName(source.select(*target.columns))


def scd2_from_history(
    rows: DataFrame, *, business_key: str, surrogate_key: str, attributes: Sequence[str], order: Sequence[str], at: str = "effective_at", rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """A dimension derived from the whole history: change points by the hash before, periods by the next change; nothing is deleted.

    The current row is the last change point, even if its time is null. Hashes compare null-safely. Keys with very many rows
    are cut into slices.
    """
    sliced, cut = with_slices(rows, business_key, order, rows_per_slice)
    beside = neighbours(sliced, business_key, list(order), cut, before="_prior", columns=["_record_hash"])
    points = beside.where(F.col("_prior").isNull() | ~F.col("_prior._record_hash").eqNullSafe(F.col("_record_hash"))).drop("_prior")
    ahead = neighbours(points, business_key, list(order), cut, after="_next", columns=[at])
    periods = ahead.withColumns({"effective_from": F.col(at), "effective_to": F.coalesce(F.col(f"_next.{at}"), open_end()), "is_current": F.col("_next").isNull()})
    numbered = ordered_ids(periods, [business_key, at, *[c for c in order if c != at]], surrogate_key)
    return numbered.select(surrogate_key, business_key, *attributes, "effective_from", "effective_to", "is_current", F.lit(False).alias("deleted_flag"), F.col("_record_hash").alias("source_record_hash"))


def append_only_rows(fact: DataFrame, staged: DataFrame, *, event_key: str, columns: Sequence[str], run_id: str = "", batch_timestamp: str | None = None) -> DataFrame:
    """The rows a batch adds to a fact table. Events are added once and never expire: exact duplicates and known keys are skipped,
    of several new rows with one key the first by file and row stays. A null key is no key: its rows are all added.

    Of the fact only the keys the batch has are looked for, so a small batch needs no shuffle of the fact.
    """
    ok = staged.where(~F.coalesce("_is_exact_duplicate", F.lit(False)) & (F.coalesce("_dq_status", F.lit("passed")) == "passed"))
    w = Window.partitionBy(event_key).orderBy("_source_file_name", F.col("_source_row_number").cast("long"))
    first = ok.where(F.col(event_key).isNotNull()).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    asked = first.select(F.col(event_key).alias("_asked"))
    known = fact.select(F.col("event_business_key").alias("_known")).join(asked, F.col("_known") == F.col("_asked"), "left_semi")
    new = first.join(known, F.col(event_key) == F.col("_known"), "left_anti").unionByName(ok.where(F.col(event_key).isNull()))
    types, have = dict(fact.dtypes), set(staged.columns)
    values = {
        "event_business_key": F.col(event_key), "batch_date": F.col("_batch_date"), "source_record_hash": F.col("_record_hash"), "source_system_id": F.col("_source_system_id") if "_source_system_id" in have else F.lit(""),
        "source_dataset_id": F.col("_source_dataset_id") if "_source_dataset_id" in have else F.lit(None), "created_run_id": F.lit(run_id), "created_at": F.lit(batch_timestamp).cast("timestamp_ntz"), **{c: F.col(c) for c in columns},
    }
    return new.select(*[(values[c] if c in values else F.lit(None)).cast(types[c]).alias(c) for c in fact.columns])


def append_only_merge(fact: DataFrame, staged: DataFrame, **options) -> DataFrame:
    """The fact table after one batch, whole."""
    return fact.unionByName(append_only_rows(fact, staged, **options))


def version_history_rows(history: DataFrame, staged: DataFrame, *, business_key: str, columns: Sequence[str]) -> DataFrame:
    """The rows a batch adds to a version history: every version once, by (key, updated_at, hash) compared null-safely; deletes and
    ambiguous rows are versions too."""
    new = staged.select(*columns, F.col(business_key).alias("event_business_key"), F.col("updated_at").alias("source_updated_at"), F.col("_record_hash").alias("source_record_hash"), F.col("_delta_action").alias("delta_action"))
    keys = ["event_business_key", "source_updated_at", "source_record_hash"]
    new = new.dropDuplicates(keys)

    def same(a: str, b: str) -> Column:
        return reduce(and_, [F.col(f"{a}{k}").eqNullSafe(F.col(f"{b}{k}")) for k in keys])

    asked = new.select(*[F.col(k).alias(f"_asked_{k}") for k in keys])
    known = history.select(*[F.col(k).alias(f"_{k}") for k in keys]).join(asked, same("_", "_asked_"), "left_semi")
    return new.join(known, same("", "_"), "left_anti").select(*history.columns)


def version_history_merge(history: DataFrame, staged: DataFrame, **options) -> DataFrame:
    """The version history after one batch, whole."""
    return history.unionByName(version_history_rows(history, staged, **options))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows with a reference but without a current parent; null references are not orphans (see null_references)."""
    current = parent.where("is_current").select(F.col(parent_key).alias("_p"))
    return child.where(F.col(child_key).isNotNull()).join(current, F.col(child_key) == F.col("_p"), "left_anti")


def null_references(child: DataFrame, child_key: str) -> DataFrame:
    return child.where(F.col(child_key).isNull())


def daily_summary(staged: DataFrame, *, batch_date: str, keys: Sequence[str], event_time: str) -> DataFrame:
    """Events of one batch per keys and day: keys, event_date, event_count, batch_date."""
    ok = staged.where((F.col("_batch_date").cast("string") == batch_date) & ~F.coalesce("_is_exact_duplicate", F.lit(False)) & (F.coalesce("_dq_status", F.lit("passed")) == "passed"))
    counted = ok.groupBy(*keys, F.to_date(event_time).alias("event_date")).agg(F.count(F.lit(1)).alias("event_count"))
    return counted.withColumn("batch_date", F.lit(batch_date))


def rebuild_summary(summary: DataFrame, staged: DataFrame, *, batch_date: str, keys: Sequence[str], event_time: str) -> DataFrame:
    """The summary with the batch's rows replaced; a batch without rows leaves none."""
    rest = summary.where(~F.coalesce(F.col("batch_date") == batch_date, F.lit(False)))
    return rest.unionByName(daily_summary(staged, batch_date=batch_date, keys=keys, event_time=event_time))


def dim_date(spark, first: str, last: str) -> DataFrame:
    """Calendar rows from first to last, both included."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("calendar_date"))
    d = F.col("calendar_date")
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_sk"), "calendar_date", F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"), (F.weekday(d) + 1).alias("iso_weekday"), (F.weekday(d) >= 5).alias("is_weekend"),
    )


# Write strategies by a dataset's target metadata: what a batch changes in a table with the rows ``now`` gives for its parts.
Now = Callable[..., DataFrame]


def _scd1(now: Now, staged: DataFrame, c: Mapping[str, Any]) -> Change:
    return Change(replaced={"rows": scd1_merge(now(), eligible(staged).select(*now().columns), c["merge_key"])})


def _scd2(now: Now, staged: DataFrame, c: Mapping[str, Any]) -> Change:
    return scd2_change(
        now(), now(CURRENT), staged, business_key=c["merge_key"], surrogate_key=c["surrogate_key"], attributes=c["attributes"], run_id=c["run_id"], batch_timestamp=c["batch_timestamp"],
        missing=c.get("missing_record_action") or "soft_delete", parents=c.get("parents", ()),
    )


def _append(now: Now, staged: DataFrame, c: Mapping[str, Any]) -> Change:
    return Change(added={"rows": append_only_rows(now(), staged, event_key=c["merge_key"], columns=[c["merge_key"], *c["attributes"]], run_id=c["run_id"], batch_timestamp=c["batch_timestamp"])})


def _incremental(now: Now, staged: DataFrame, c: Mapping[str, Any]) -> Change:
    """Rows beyond the highest watermark the table has."""
    at = c["watermark_column"]
    last = now().agg(F.max(at)).first()[0]
    beyond = staged if last is None else staged.where(F.col(at) > F.lit(last))
    return Change(added={"rows": beyond.select(*now().columns)})


def _history(now: Now, staged: DataFrame, c: Mapping[str, Any]) -> Change:
    return Change(added={"rows": version_history_rows(now(), staged, business_key=c["merge_key"], columns=[c["merge_key"], *c["attributes"]])})


def _summary(now: Now, staged: DataFrame, c: Mapping[str, Any]) -> Change:
    """The batch's day is a part of its own, replaced each time."""
    day = str(staged.agg(F.max("_batch_date")).first()[0])
    return Change(replaced={f"batch_date={day}": daily_summary(staged, batch_date=day, keys=list(c["keys"]), event_time=c["event_time"])})


STRATEGIES: dict[str, Callable[[Now, DataFrame, Mapping[str, Any]], Change]] = {
    "scd1": _scd1, "upsert": _scd1, "merge": _scd1, "scd2": _scd2, "append": _append, "incremental": _incremental, "history": _history, "summary": _summary,
}
