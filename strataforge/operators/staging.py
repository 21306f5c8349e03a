"""RAW to STAGING: lineage columns, record hashes, exact duplicates, the latest version of each key, ambiguity."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataforge.operators.skew import has_hot_key

#: Rows of one key that a task may sort.
ROWS_PER_KEY = 1_000_000
MUTABLE, EVENT = "mutable_versioned", "append_only_event"


@dataclass(frozen=True)
class DatasetContract:
    """What a dataset must look like: its table, key, columns in order, and whether its rows are versions or events."""

    dataset_id: str
    table_name: str
    primary_key: str
    expected_columns: list[str] = field(default_factory=list)
    source_record_pattern: str = MUTABLE
    #: Whether quoted values may hold line breaks; files without can be read in splits.
    multiline: bool = True

    @property
    def is_mutable(self) -> bool:
        return self.source_record_pattern.startswith("mutable")


def record_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of the columns as JSON with sorted names; nulls hash as empty strings."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in sorted(columns)]
    return F.sha2(F.to_json(F.struct(*fields)), 256)


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def mark_exact_duplicates(df: DataFrame, key: str, spread: bool = False) -> DataFrame:
    """_is_exact_duplicate: an earlier row (by file and row number) has the same key, times and hash.

    ``spread``: the first row of each group is found by partial aggregation and joined back, so that no task must sort a group.
    """
    place = F.struct("_source_file_name", F.col("_source_row_number").cast("long"))
    if not spread:
        w = Window.partitionBy(key, _text("effective_at"), _text("updated_at"), "_record_hash").orderBy("_source_file_name", F.col("_source_row_number").cast("long"))
        return df.withColumn("_is_exact_duplicate", F.row_number().over(w) > 1)
    group = [F.col(key), _text("effective_at"), _text("updated_at"), F.col("_record_hash")]
    first = df.groupBy(*[c.alias(f"_g{i}") for i, c in enumerate(group)]).agg(F.min(place).alias("_first"))
    on = group[0].eqNullSafe(F.col("_g0")) & (group[1] == F.col("_g1")) & (group[2] == F.col("_g2")) & (group[3] == F.col("_g3"))
    return df.join(first, on).withColumn("_is_exact_duplicate", place != F.col("_first")).drop("_g0", "_g1", "_g2", "_g3", "_first")


def _facts_by_window(df: DataFrame, key: str) -> DataFrame:
    """df with _place, _in_top and _ambiguous; everything about a key in one sort of its rows."""
    part = Window.partitionBy(key, "_is_exact_duplicate")
    order = part.orderBy(
        _text("updated_at").desc(), _text("effective_at").desc(), F.col("_source_file_modified_at").desc(), F.col("_ingest_timestamp").desc(),
        F.col("_source_file_name").desc(), F.col("_source_row_number").cast("long").desc(),
    )
    times = F.struct(_text("updated_at").alias("u"), _text("effective_at").alias("e"))
    ranked = df.withColumns({"_place": F.row_number().over(order), "_top": F.first(times).over(order)}).withColumn("_in_top", times == F.col("_top"))
    top_hash = F.when(F.col("_in_top"), F.col("_record_hash"))
    ambiguous = F.min(top_hash).over(part) != F.max(top_hash).over(part)
    return ranked.withColumn("_ambiguous", F.coalesce(ambiguous, F.lit(False))).drop("_top")


def _facts_by_aggregation(df: DataFrame, key: str) -> DataFrame:
    """The same for keys too large to sort in one task: the top tie group's hashes and last row by partial aggregates, joined back."""
    times = [_text("updated_at"), _text("effective_at")]
    last = F.struct(F.col("_source_file_modified_at").alias("m"), F.col("_ingest_timestamp").alias("i"), F.col("_source_file_name").alias("f"), F.col("_source_row_number").cast("long").alias("r"))
    ties = df.where(~F.col("_is_exact_duplicate")).groupBy(F.col(key).alias("_k"), times[0].alias("u"), times[1].alias("e"))
    ties = ties.agg(F.max(last).alias("last"), F.min("_record_hash").alias("low"), F.max("_record_hash").alias("high"))
    top = ties.groupBy("_k").agg(F.max(F.struct("u", "e", "last", "low", "high")).alias("_t"))
    back = df.join(top, F.col(key).eqNullSafe(F.col("_k")), "left")
    in_top = (times[0] == F.col("_t.u")) & (times[1] == F.col("_t.e"))
    return back.withColumns({"_in_top": in_top, "_place": F.when(in_top & (last == F.col("_t.last")), 1).otherwise(2), "_ambiguous": F.col("_t.low") != F.col("_t.high")}).drop("_k", "_t")


def resolve_latest(df: DataFrame, key: str, spread: bool = False) -> DataFrame:
    """_is_latest_for_business_key and _latest_resolution_status of every row.

    Among a key's rows that are no exact duplicates the one with the latest (updated_at, effective_at, file time, ingest
    time, file, row) is the latest and all are resolved. If the rows of the top (updated_at, effective_at) have
    different hashes, those are ambiguous, nobody is latest and the others stay pending; duplicates stay pending.
    """
    marked = _facts_by_aggregation(df, key) if spread else _facts_by_window(df, key)
    status = (
        F.when(F.col("_is_exact_duplicate"), "pending")
        .when(F.col("_ambiguous") & F.col("_in_top"), "ambiguous_same_timestamp")
        .when(F.col("_ambiguous"), "pending")
        .otherwise("resolved")
    )
    latest = ~F.col("_is_exact_duplicate") & ~F.col("_ambiguous") & (F.col("_place") == 1)
    return marked.withColumns({"_is_latest_for_business_key": latest, "_latest_resolution_status": status}).drop("_place", "_in_top", "_ambiguous")


def stage_rows(
    rows: DataFrame, contract: DatasetContract, *, source_system_id: str, run_id: str, batch_date: str, load_type: str = "full", source_date: str = "", ingest_timestamp: str,
    rows_per_key: int = ROWS_PER_KEY,
) -> DataFrame:
    """Source rows with the lineage columns, staged. ``rows`` has the contract's columns, _source_file_name, _source_file_path,
    _source_file_modified_at, _source_row_number and, on deltas, delta_action; contract columns it lacks are empty.

    Null values hash as empty ones. An empty table stages to an empty table. One exchange by key serves both windows; if a
    key has more than ``rows_per_key`` rows, aggregates joined back take the windows' place.
    """
    have = set(rows.columns)
    payload = [F.col(c) if c in have else F.lit("").alias(c) for c in contract.expected_columns]
    action = F.col("delta_action") if "delta_action" in have else F.lit("UPSERT" if load_type == "full" else "")
    staged = rows.select(
        *payload,
        F.lit(source_system_id).alias("_source_system_id"), F.lit(contract.dataset_id).alias("_source_dataset_id"),
        "_source_file_name", "_source_file_path", "_source_file_modified_at", "_source_row_number",
        F.lit(run_id).alias("_ingest_run_id"), F.lit(ingest_timestamp).alias("_ingest_timestamp"), F.lit(batch_date).alias("_batch_date"),
        F.lit(load_type).alias("_load_type"), F.lit(source_date).alias("_source_extract_date"), action.alias("_delta_action"),
        F.lit("passed").alias("_dq_status"),
    ).withColumn("_record_hash", record_hash(contract.expected_columns))
    for c in ("effective_at", "updated_at"):
        if c not in staged.columns:
            staged = staged.withColumn(c, F.lit(""))
    extra = [c for c in ("effective_at", "updated_at") if c not in contract.expected_columns]
    spread = has_hot_key(rows, contract.primary_key, rows_per_key)
    marked = mark_exact_duplicates(staged if spread else staged.repartition(contract.primary_key), contract.primary_key, spread)
    if contract.is_mutable:
        marked = resolve_latest(marked, contract.primary_key, spread)
    else:
        marked = marked.withColumns({"_is_latest_for_business_key": F.lit(False), "_latest_resolution_status": F.lit("not_applicable_event")})
    return marked.drop(*extra)


def rejects(staged: DataFrame) -> DataFrame:
    return staged.where("_latest_resolution_status = 'ambiguous_same_timestamp'")


def may_be_merged() -> Column:
    """Latest, resolved, no duplicate, quality passed (null counts as passed); never null."""
    return (
        F.coalesce("_is_latest_for_business_key", F.lit(False)) & F.coalesce(F.col("_latest_resolution_status") == "resolved", F.lit(False))
        & ~F.coalesce("_is_exact_duplicate", F.lit(False)) & (F.coalesce("_dq_status", F.lit("passed")) == "passed")
    )


def eligible(staged: DataFrame, parents: Sequence[tuple] = ()) -> DataFrame:
    """Rows that may be merged, and of them those every foreign key of which is found among the parent's current rows.

    ``parents``: (child column, parent table, parent column), and more for lookups (see with_parents), which add nothing here.
    """
    ok = staged.where(may_be_merged())
    for child, parent, key, *_ in parents:
        current = parent.where("is_current").select(F.col(key).alias("_parent_key"))
        ok = ok.join(current, F.col(child) == F.col("_parent_key"), "left_semi")
    return ok


def with_parents(staged: DataFrame, parents: Sequence[tuple]) -> DataFrame:
    """staged with _parents (whether every parent has a current row) and _parent_keys, a struct of the parents' surrogate keys.

    ``parents``: (child column, parent table, parent column) for a gate, with (surrogate key, target column) after it for a
    lookup. A parent with several current rows gives its highest surrogate key and doesn't multiply the child; a null foreign
    key has no parent.
    """
    out, found, keys = staged, F.lit(True), []
    for i, (child, parent, key, *lookup) in enumerate(parents):
        value = F.max(lookup[0]) if lookup else F.max(F.lit(1))
        current = parent.where("is_current").groupBy(F.col(key).alias(f"_p{i}")).agg(value.alias(f"_v{i}"))
        out = out.join(current, F.col(child) == F.col(f"_p{i}"), "left")
        found = found & F.col(f"_p{i}").isNotNull()
        keys += [F.col(f"_v{i}").alias(lookup[1])] if lookup else []
    return out.withColumns({"_parents": found, "_parent_keys": F.struct(*keys) if keys else F.struct(F.lit(None).alias("_"))}).drop(*[f"_{c}{i}" for c in "pv" for i in range(len(parents))])


def stage_counts(staged: DataFrame) -> DataFrame:
    """Rows, exact duplicates, ambiguous rows and the batch's status, in one pass."""
    return staged.agg(
        F.count(F.lit(1)).alias("staging_record_count"),
        F.count_if("_is_exact_duplicate").alias("exact_duplicate_count"),
        F.count_if(F.col("_latest_resolution_status") == "ambiguous_same_timestamp").alias("ambiguous_latest_count"),
    ).withColumn("status", F.when(F.col("ambiguous_latest_count") == 0, "SUCCESS").otherwise("SUCCESS_WITH_WARNINGS"))
