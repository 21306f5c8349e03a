"""The pN_ queries of the general problems: history, event-time attributes, change feed, snapshots, rolling totals, orphans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataforge.functions.values import date_text, filled_id, is_true, midnight, norm_hash, norm_id, ts_text, until
from strataforge.operators.asof import asof_version
from strataforge.operators.changefeed import as_changes, fold_changes, is_delete, live
from strataforge.operators.history import entity_history
from strataforge.operators.references import orphan_references, orphan_report
from strataforge.operators.rolling import rolling_totals
from strataforge.operators.snapdiff import diff_snapshots, snapshot_calendar, snapshot_records
from strataforge.session import table

#: Fixed value: the last calendar day of the transactions.
LAST_DAY = "2025-03-31"
VEHICLE_ATTRS = ["client_id", "asset_type", "make", "model", "model_year", "fuel_type", "state_registered", "odometer_km", "in_service_date", "lease_end_date", "vehicle_status"]


def full_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "vehicles_ext").where("_load_type = 'full'")


def transactions(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """One row for each fuel_transaction_id, the one scored last, with the given columns."""
    rows = table(spark, sf_dir, "feature_fuel_anomaly_score").where("fuel_transaction_id is not null")
    last = F.max(F.struct("scored_at", "batch_date", *cols)).alias("r")
    return rows.groupBy("fuel_transaction_id").agg(last).select("fuel_transaction_id", *[F.col(f"r.{c}").alias(c) for c in cols])


def vehicle_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity, effective_from, effective_to, record_hash and attributes of every version of every vehicle."""
    attrs = ["record_hash", *VEHICLE_ATTRS]
    dim = table(spark, sf_dir, "dim_vehicle")
    versions = dim.select(
        norm_id(F.col("vehicle_id")).alias("entity"), F.col("vehicle_sk").alias("version_id"),
        F.col("effective_from").cast("timestamp_ntz").alias("valid_from"), until(F.col("effective_to")).alias("valid_until"),
        norm_hash(F.col("source_record_hash")).alias("record_hash"), *VEHICLE_ATTRS,
    )
    rows = full_rows(spark, sf_dir).where("vehicle_id is not null and _batch_date is not null")
    latest = F.struct(F.col("updated_at").alias("o1"), F.col("staged_row_id").alias("o2"), F.struct("effective_at", norm_hash(F.col("_record_hash")).alias("record_hash"), *VEHICLE_ATTRS).alias("rec"))
    best = F.max(F.when(is_true(F.col("_is_latest_for_business_key")), latest))["rec"]
    snapshots = rows.groupBy(norm_id(F.col("vehicle_id")).alias("entity"), midnight(F.col("_batch_date")).alias("at")).agg(best.alias("rec"))
    days = rows.select(midnight(F.col("_batch_date")).alias("at")).distinct()
    calendar = days.select("at", F.lead("at").over(Window.orderBy("at")).alias("next_at"))
    return entity_history(versions, snapshots, calendar, attrs, "record_hash")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = vehicle_history(spark, sf_dir)
    return h.select(F.col("entity").alias("vehicle_id"), ts_text(F.col("effective_from")).alias("effective_from"), ts_text(F.col("effective_to")).alias("effective_to"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    txn = transactions(spark, sf_dir, "vehicle_id", "vehicle_sk", "transaction_datetime")
    # The stored key travels inside the event's id, so that the answer needs no join back.
    event_id = F.concat_ws("|", F.coalesce(F.col("vehicle_sk").cast("string"), F.lit("")), "fuel_transaction_id")
    events = txn.select(event_id.alias("event_id"), filled_id(F.col("vehicle_id")).alias("entity"), F.col("transaction_datetime").alias("at"))
    dim = table(spark, sf_dir, "dim_vehicle")
    versions = dim.select(norm_id(F.col("vehicle_id")).alias("entity"), F.col("vehicle_sk").alias("version"), F.col("effective_from").alias("valid_from"), F.col("effective_to").alias("valid_until"))
    found = asof_version(events, versions)
    at = F.instr("event_id", "|")
    out = found.select(
        F.expr("substring(event_id, instr(event_id, '|') + 1)").alias("fuel_transaction_id"),
        F.when(at > 1, F.substring_index("event_id", "|", 1)).cast("long").alias("stored"),
        "version",
    )
    return out.where(~F.col("stored").eqNullSafe(F.col("version"))).select("fuel_transaction_id", F.coalesce("version", F.lit(-1).cast("long")).alias("vehicle_sk"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "vehicles_ext").where("_load_type = 'delta'")
    feed = as_changes(
        rows,
        key=norm_id(F.col("vehicle_id")),
        sequence=[F.col("updated_at"), F.col("_ingest_timestamp"), F.col("_source_row_number")],
        deleted=is_delete(F.col("_delta_action")),
        payload={"record_hash": norm_hash(F.col("_record_hash"))},
    )
    return live(fold_changes(feed)).select(F.col("key").alias("vehicle_id"), "record_hash")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = full_rows(spark, sf_dir)
    calendar = snapshot_calendar(rows, "_batch_date")
    records = snapshot_records(
        rows,
        calendar,
        key=norm_id(F.col("vehicle_id")),
        batch="_batch_date",
        is_record=is_true(F.col("_is_latest_for_business_key")),
        record_hash=norm_hash(F.col("_record_hash")),
        order=[F.col("updated_at"), F.col("staged_row_id")],
    )
    found = diff_snapshots(records, calendar, "_batch_date")
    return found.select(date_text(F.col("_batch_date")).alias("batch_date"), F.col("key").alias("vehicle_id"), "change_kind")


def p6_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every card and day with the totals, averages and counts of the trailing 7 and 30 days."""
    txn = transactions(spark, sf_dir, "fuel_card_id", "transaction_date", "transaction_datetime", "gross_amount")
    day = F.coalesce("transaction_date", F.col("transaction_datetime").cast("date"))
    return rolling_totals(txn, entity=filled_id(F.col("fuel_card_id")), day=day, amount=F.col("gross_amount"), last_day=LAST_DAY)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = p6_rolling(spark, sf_dir).where("n_7 >= 4 and total_7 >= 900 and total_30 < 1500")
    return cases.select(F.col("entity").alias("fuel_card_id"), date_text(F.col("on_date")).alias("on_date"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    def parents(name: str, key: str) -> DataFrame:
        return table(spark, sf_dir, name).select(norm_id(F.col(key)).alias("ref_key"), F.col("effective_from").cast("timestamp_ntz").alias("valid_from"), until(F.col("effective_to")).alias("valid_until"))

    vehicles = table(spark, sf_dir, "vehicles_ext").select(F.col("staged_row_id").cast("string").alias("record_key"), filled_id(F.col("client_id")).alias("ref_key"), midnight(F.col("_batch_date")).alias("at"))
    txn = transactions(spark, sf_dir, "fuel_card_id", "transaction_datetime").select(F.col("fuel_transaction_id").alias("record_key"), filled_id(F.col("fuel_card_id")).alias("ref_key"), F.col("transaction_datetime").cast("timestamp_ntz").alias("at"))
    found = [
        orphan_references(rows, parents(dim, key)).select(F.lit(child).alias("child_table"), F.substring(F.col("at").cast("string"), 1, 7).alias("period_month"), "record_key", "ref_key")
        for child, rows, dim, key in (("vehicles_ext", vehicles, "dim_client", "client_id"), ("feature_fuel_anomaly_score", txn, "dim_fuel_card", "fuel_card_id"))
    ]
    return found[0].unionByName(found[1])


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_report(p7_found(spark, sf_dir))


QUERIES = {"p1_found": p1_found, "p2_found": p2_found, "p3_found": p3_found, "p4_found": p4_found, "p6_rolling": p6_rolling, "p6_found": p6_found, "p7_found": p7_found, "p7_report": p7_report}
