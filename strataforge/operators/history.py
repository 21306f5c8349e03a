"""History of changing entity attributes, kept as checkpoints and patches.

Every version of an entity is an event: ``set`` with all its attributes, or ``end``. The store keeps every
``every``-th event of an entity whole (a checkpoint) and of the others only the attributes that differ from the event
before (a patch). Validity rows are folded forward from the nearest checkpoint: an attribute's value is the last one
written since then. A read therefore never goes back further than ``every`` events, however long the history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataforge.functions.values import open_end
from strataforge.operators.sliced import ROWS_PER_SLICE, last_known, neighbours, numbered, with_slices
from strataforge.session import materialise

#: An event of this position in its entity's history (0, 16, 32, ...) is stored whole.
EVERY = 16
#: The slice of a cut entity's snapshot events, which follow all its versions.
AFTER_ALL = 2_000_000_000


def delta_store(events: DataFrame, attrs: Sequence[str], every: int = EVERY, cut: bool = False) -> DataFrame:
    """entity, slice, seq, at, is_end, segment, is_checkpoint, patch of events with entity, slice, ord, at, is_end and the attributes.

    ``ord`` gives an entity's events their order and ``slice`` (see sliced) mustn't fall along it. ``patch`` has, for each
    attribute, a struct(v) or null where the attribute is as before; a value that became null is struct(null). The first
    event after an end is stored whole.
    """
    in_order = neighbours(numbered(events, "entity", ["ord"], cut, "seq"), "entity", ["ord"], cut, before="prior", columns=["is_end", *attrs])
    whole = (F.col("seq") % every == 0) | F.coalesce("prior.is_end", F.lit(True))

    def patch(a: str) -> Column:
        changed = whole | ~F.col(a).eqNullSafe(F.col(f"prior.{a}"))
        return F.when(changed & ~F.col("is_end"), F.struct(F.col(a).alias("v"))).alias(a)

    segment = F.floor(F.col("seq") / every)
    return in_order.select("entity", "slice", "seq", "at", "is_end", segment.alias("segment"), (whole & ~F.col("is_end")).alias("is_checkpoint"), F.struct(*[patch(a) for a in attrs]).alias("patch"))


def reconstruct(store: DataFrame, attrs: Sequence[str], cut: bool = False) -> DataFrame:
    """entity, effective_from, effective_to and the attributes of every version; the open one ends at the open end."""
    folded = Window.partitionBy("entity", "segment").orderBy("seq")
    values = store.select("entity", "slice", "seq", "is_end", "at", *[F.last(f"patch.{a}", ignorenulls=True).over(folded)["v"].alias(a) for a in attrs])
    rows = neighbours(values, "entity", ["seq"], cut, after="following", columns=["at"])
    return rows.where("not is_end").select("entity", F.col("at").alias("effective_from"), F.coalesce("following.at", open_end()).alias("effective_to"), *attrs)


def state_at(store: DataFrame, attrs: Sequence[str], at: Column) -> DataFrame:
    """entity and attributes as they were at a time: each entity's patches folded forward from its nearest checkpoint.

    Of every entity only the segment its last event falls in is read. Entities that hadn't begun or had ended give no row.
    """
    past = store.where(F.col("at") <= at)
    latest = past.groupBy("entity").agg(F.max("segment").alias("segment"))
    near = past.join(latest, ["entity", "segment"], "left_semi")
    values = [F.max_by(f"patch.{a}", F.when(F.col(f"patch.{a}").isNotNull(), F.col("seq")))["v"].alias(a) for a in attrs]
    return near.groupBy("entity").agg(F.max_by("is_end", "seq").alias("_ended"), *values).where("not _ended").drop("_ended")


def single_versions(versions: DataFrame, attrs: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE) -> tuple[DataFrame, bool]:
    """Versions with an entity and a begin, each version_id once, with their slice; and whether an entity had to be cut."""
    row = F.max(F.struct("entity", "valid_from", "valid_until", *attrs)).alias("r")
    single = versions.where("entity is not null and valid_from is not null").groupBy("version_id").agg(row).select("version_id", "r.*")
    # Read to count entities and to put them in order.
    return with_slices(materialise(single, "single-versions"), "entity", ["valid_from", "version_id"], rows_per_slice)


def merged_versions(single: DataFrame, attrs: Sequence[str], hash_col: str, cut: bool) -> DataFrame:
    """Periods in force, those that follow without a gap and have the same hash made one.

    Input: single_versions, valid_until open_end where open. A version is in force until the earlier of its end and the
    entity's next begin. Output: entity, slice, valid_from, valid_until, gap (nothing begins where it ends) and the
    attributes of the first version.
    """
    order = ["valid_from", "version_id"]
    placed = neighbours(single, "entity", order, cut, after="following", columns=["valid_from"])
    kept = placed.withColumn("until", F.least("valid_until", F.coalesce("following.valid_from", open_end()))).where("valid_from < until").drop("following")
    beside = neighbours(kept, "entity", order, cut, after="following", before="prior", columns=["valid_from", "until", hash_col])
    goes_on = F.coalesce((F.col("prior.until") == F.col("valid_from")) & F.col(f"prior.{hash_col}").eqNullSafe(F.col(hash_col)), F.lit(False))
    gap = (F.col("until") != open_end()) & ~F.coalesce(F.col("following.valid_from") == F.col("until"), F.lit(False))
    starts = beside.withColumns({"start": F.when(~goes_on, F.col("valid_from")), "gap": gap})
    runs = last_known(starts, "entity", order, cut, "start", "run")
    first = F.min(F.struct(*order, "slice", F.struct(*attrs).alias("a")))
    one = runs.groupBy("entity", "run").agg(first.alias("f"), F.max(F.struct("valid_from", "until", "gap")).alias("l"))
    return one.select("entity", "f.slice", "f.valid_from", F.col("l.until").alias("valid_until"), "l.gap", "f.a.*")


def _version_events(versions: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """A set event for each version, and an end event where nothing begins at its end (but not at an open end)."""
    kinds = F.when(F.col("gap"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    part = versions.withColumn("is_end", F.explode(kinds))
    at = F.when(F.col("is_end"), F.col("valid_until")).otherwise(F.col("valid_from"))
    order = F.struct(F.lit(0).alias("part"), F.col("valid_from").alias("at"), F.col("is_end").cast("int").alias("n"))
    return part.select("entity", "slice", order.alias("ord"), at.alias("at"), "is_end", *attrs)


def snapshot_events(base: DataFrame, snapshots: DataFrame, calendar: DataFrame, attrs: Sequence[str], hash_col: str) -> DataFrame:
    """Events that the snapshots add to the history in ``base`` (merged_versions).

    ``snapshots``: entity, at (the snapshot's midnight), rec: null or struct(effective_at, attributes) of the entity's
    latest row; one row per entity and snapshot, so an entity has at most as many as there are snapshots.
    ``calendar``: at, next_at of every snapshot. A fold over the entity's snapshots in order: another hash, or none open,
    ends the open version and begins a new one; an entity missing from a snapshot ends its open version.
    """
    ts = "timestamp_ntz"
    open_row = F.when(F.col("valid_until") == open_end(), F.struct(F.col(hash_col).alias("h")))
    state = base.groupBy("entity").agg(
        F.max(open_row).alias("open"),
        F.max(F.greatest("valid_from", F.when(F.col("valid_until") != open_end(), F.col("valid_until")))).alias("latest"),
        F.max(F.when(F.col("slice") >= 0, F.lit(AFTER_ALL))).alias("slice"),
    )
    element = F.struct("at", "next_at", "rec")
    steps = snapshots.join(calendar, "at").groupBy("entity").agg(F.sort_array(F.collect_list(F.struct(F.col("at"), element.alias("e")))).alias("steps"))
    both = state.join(steps, "entity", "full_outer").withColumn("first_at", calendar.agg(F.min("at")).scalar())
    rec_type = dict(snapshots.dtypes)["rec"]
    event_type = f"array<struct<at:{ts},is_end:boolean,rec:{rec_type}>>"
    acc_type = f"struct<open:struct<h:string>,latest:{ts},due:{ts},events:{event_type}>"
    start = F.struct(F.col("open").alias("open"), F.col("latest").alias("latest"), F.col("first_at").alias("due"), F.array().cast(event_type).alias("events")).cast(acc_type)
    none = F.lit(None)

    def end_if_missed(acc: Column, missed: Column) -> Column:
        closes = missed & acc["open"].isNotNull()
        ended = F.array(F.struct(acc["due"].alias("at"), F.lit(True).alias("is_end"), none.cast(rec_type).alias("rec")))
        return F.when(
            closes,
            F.struct(none.cast("struct<h:string>").alias("open"), F.greatest(acc["latest"], acc["due"]).alias("latest"), acc["due"].alias("due"), F.concat(acc["events"], ended).alias("events")).cast(acc_type),
        ).otherwise(acc)

    def put(acc: Column, e: Column) -> Column:
        eff = e["rec"]["effective_at"].cast(ts)
        begin = F.when(eff.isNotNull() & (acc["latest"].isNull() | (eff > acc["latest"])), eff).otherwise(e["at"])
        begins = e["rec"].isNotNull() & (acc["open"].isNull() | ~acc["open"]["h"].eqNullSafe(e["rec"][hash_col]))
        begun = F.array(F.struct(begin.alias("at"), F.lit(False).alias("is_end"), e["rec"].alias("rec")))
        return F.struct(
            F.when(begins, F.struct(e["rec"][hash_col].alias("h"))).otherwise(acc["open"]).alias("open"),
            F.when(begins, F.greatest(acc["latest"], begin)).otherwise(acc["latest"]).alias("latest"),
            e["next_at"].alias("due"),
            F.when(begins, F.concat(acc["events"], begun)).otherwise(acc["events"]).alias("events"),
        ).cast(acc_type)

    def step(acc: Column, e: Column) -> Column:
        # The state after a missed snapshot is bound to a name by a one-element transform, else it would be written out again and again.
        settled = F.transform(F.array(end_if_missed(acc, F.coalesce(acc["due"] < e["at"], F.lit(False)))), lambda a: put(a, e))
        return F.element_at(settled, 1)

    elements = F.transform(F.coalesce("steps", F.array().cast(dict(steps.dtypes)["steps"])), lambda s: s["e"])
    last = F.aggregate(elements, start, step, lambda acc: end_if_missed(acc, acc["due"].isNotNull())["events"])
    events = both.select("entity", F.coalesce("slice", F.lit(-1)).alias("slice"), F.posexplode(last).alias("n", "v"))
    order = F.struct(F.lit(1).alias("part"), F.lit(None).cast(ts).alias("at"), F.col("n").cast("int").alias("n"))
    return events.select("entity", "slice", order.alias("ord"), F.col("v.at").alias("at"), F.col("v.is_end").alias("is_end"), *[F.col(f"v.rec.{a}").alias(a) for a in attrs])


def entity_history(versions: DataFrame, snapshots: DataFrame, calendar: DataFrame, attrs: Sequence[str], hash_col: str, every: int = EVERY, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """The whole history of every entity, stored as checkpoints and patches (in the shared folder) and folded out again.

    Nulls: rows without entity, versions without begin and snapshots without date are no rows; null attributes are
    values. Empty tables: no versions give the snapshots' history, no snapshots leave the versions as they are.
    """
    single, cut = single_versions(versions, attrs, rows_per_slice)
    # The periods are read for their own events and for the state the snapshots find; the calendar for its first day and its steps.
    base = materialise(merged_versions(single, attrs, hash_col, cut), "periods")
    calendar = materialise(calendar, "calendar")
    events = _version_events(base, attrs).unionByName(snapshot_events(base, snapshots, calendar, attrs, hash_col))
    store = materialise(delta_store(events, attrs, every, cut), "history")
    return reconstruct(store, attrs, cut)
