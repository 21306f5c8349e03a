"""An explainable score of unusual transactions: joins to current dimensions, windows per card, rules with reason codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataforge.functions.values import is_true
from strataforge.operators.skew import has_hot_key

# The rules' weights and codes in their order, limits and version.
RULES = [("high_value_transaction_flag", 30, "HIGH_VALUE_TRANSACTION"), ("no_usage_match_flag", 25, "NO_USAGE_MATCH"), ("fuel_card_vehicle_mismatch_flag", 30, "CARD_VEHICLE_MISMATCH"), ("multiple_fill_flag", 15, "MULTIPLE_FILLS_7D")]
AMOUNT_LIMIT, SIGMAS, VERSION = 250, 2, "fuel_anomaly_rules_v0.1"
PERIOD = "INTERVAL '7' DAY"
#: Transactions of one card that a task may sort.
ROWS_PER_CARD = 1_000_000


def usage_per_day(usage: DataFrame, key: str, day: Column, amount: str) -> DataFrame:
    """One row for each key and day, so that joining it can't multiply transactions."""
    return usage.groupBy(F.col(key).alias("usage_key"), day.alias("usage_day")).agg(F.sum(amount).alias("distance_km"))


def card_windows(df: DataFrame, card: str, at: str, amount: str, *, counted: DataFrame | None = None, rows_per_card: int = ROWS_PER_CARD) -> DataFrame:
    """Count of the trailing 7 days (exactly 7 days ago included), mean and sample deviation of the card; one exchange by card.

    If a card has more rows than ``rows_per_card`` (found in ``counted``, by default in df), its rows are counted per time
    before the window and averaged by partial aggregation, and joined back by card and time: no task sorts a card's rows.
    Null cards are one card, null times one time.
    """
    frame = f"over (partition by {card} order by {at} range between {PERIOD} preceding and current row)"
    value = F.col(amount).cast("double")
    if not has_hot_key(df if counted is None else counted, card, rows_per_card):
        whole = Window.partitionBy(card)
        return df.withColumns({"transaction_frequency_7d": F.expr(f"count(1) {frame}"), "avg_amount": F.avg(value).over(whole), "std_amount": F.stddev_samp(value).over(whole)})
    times = df.groupBy(card, at).agg(F.count(F.lit(1)).alias("_n")).withColumn("transaction_frequency_7d", F.expr(f"sum(_n) {frame}"))
    times = times.select(F.col(card).alias("_c"), F.col(at).alias("_t"), "transaction_frequency_7d")
    cards = df.groupBy(F.col(card).alias("_d")).agg(F.avg(value).alias("avg_amount"), F.stddev_samp(value).alias("std_amount"))
    joined = df.join(times, F.col(card).eqNullSafe(F.col("_c")) & F.col(at).eqNullSafe(F.col("_t")))
    return joined.join(cards, F.col(card).eqNullSafe(F.col("_d"))).drop("_c", "_t", "_d")


def score(df: DataFrame, *, amount: str, distance: str, mismatch: Column, amount_limit: float = AMOUNT_LIMIT) -> DataFrame:
    """Flags, score and reason codes of rows with card_windows. A null flag scores nothing and gives no code."""
    value, km = F.col(amount).cast("double"), F.col(distance)
    flags = df.withColumns({
        "high_value_transaction_flag": (value > amount_limit) | (F.col("std_amount").isNotNull() & (value > F.col("avg_amount") + SIGMAS * F.col("std_amount"))),
        "no_usage_match_flag": km.isNull() | (km <= 0),
        "fuel_card_vehicle_mismatch_flag": mismatch,
        "multiple_fill_flag": F.col("transaction_frequency_7d") > 1,
        "fuel_cost_per_km": F.when(km > 0, F.col(amount) / km),
    })
    total = sum((F.when(F.col(f), weight).otherwise(0) for f, weight, _ in RULES), F.lit(0))
    codes = F.concat_ws(",", *[F.when(F.col(f), code) for f, _, code in RULES])
    return flags.withColumns({"fuel_anomaly_score": F.least(F.lit(100), total).cast("int"), "anomaly_reason_codes": codes, "feature_version": F.lit(VERSION)})


def fuel_anomaly_score(transactions: DataFrame, usage: DataFrame, cards: DataFrame, vehicles: DataFrame, clients: DataFrame, batch_date: str | None = None, scored_at: str | None = None) -> DataFrame:
    """The feature table, 25 columns: every transaction once, up to batch_date if given, with current dimensions, flags and score.

    ``scored_at`` is when the run scores them, given so that it can be repeated; without it the time the query begins.
    Dimensions are cut to their current rows and one row a key before joining; transactions whose keys are null or unknown
    keep null dimension columns. Usage is summed to vehicle and day first.
    """

    def current(dim: DataFrame, key: str, *cols: str) -> DataFrame:
        return dim.where(is_true(F.col("is_current"))).groupBy(F.col(key).alias(f"_{key}")).agg(F.max(F.struct(*cols)).alias("_d")).select(f"_{key}", *[F.col(f"_d.{c}").alias(f"_{i}_{c}") for i, c in enumerate(cols)])

    txn = transactions.withColumn("transaction_date", F.to_date("transaction_datetime"))
    if batch_date is not None:
        txn = txn.where(F.col("transaction_date") <= F.lit(batch_date).cast("date"))
    usage_day = usage_per_day(usage, "vehicle_id", F.to_date("event_date"), "distance_km")
    card = current(cards, "fuel_card_id", "vehicle_id", "client_id").withColumnsRenamed({"_0_vehicle_id": "_card_vehicle", "_1_client_id": "_card_client"})
    vehicle = current(vehicles, "vehicle_id", "vehicle_sk").withColumnRenamed("_0_vehicle_sk", "vehicle_sk")
    client = current(clients, "client_id", "client_sk").withColumnRenamed("_0_client_sk", "client_sk")
    joined = (
        txn.join(usage_day, (F.col("vehicle_id") == F.col("usage_key")) & (F.col("transaction_date") == F.col("usage_day")), "left")
        .join(card, F.col("fuel_card_id") == F.col("_fuel_card_id"), "left")
        .join(vehicle, F.col("vehicle_id") == F.col("_vehicle_id"), "left")
        .join(client, F.col("client_id") == F.col("_client_id"), "left")
    )
    mismatch = (F.col("_card_vehicle").isNotNull() & (F.col("_card_vehicle") != F.col("vehicle_id"))) | (F.col("_card_client").isNotNull() & (F.col("_card_client") != F.col("client_id")))
    scored = score(card_windows(joined, "fuel_card_id", "transaction_datetime", "gross_amount", counted=transactions), amount="gross_amount", distance="distance_km", mismatch=mismatch)
    scored = scored.withColumn("scored_at", F.lit(scored_at).cast("timestamp_ntz") if scored_at else F.localtimestamp())
    dated = scored.withColumn("batch_date", F.lit(batch_date).cast("date") if batch_date else F.col("transaction_date"))
    return dated.select(
        "fuel_transaction_id", "fuel_card_id", "vehicle_id", "vehicle_sk", "client_id", "client_sk", "transaction_datetime", "transaction_date", "merchant_state", "fuel_product",
        "litres", "gross_amount", "distance_km", "fuel_cost_per_km", "transaction_frequency_7d", "multiple_fill_flag", "no_usage_match_flag", "high_value_transaction_flag",
        "fuel_card_vehicle_mismatch_flag", "fuel_anomaly_score", "anomaly_reason_codes", "feature_version", "scored_at", "batch_date", "source_record_hash",
    )
