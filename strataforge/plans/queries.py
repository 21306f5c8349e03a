"""Queries for the engine's operators over the driver's tables, each with its SQL.

The staging and dimension queries make their batches from events, customer, supplier, orders and lineitem by the same rule in
Spark and in SQL: several rows of a key, repeated rows, ties, missing and new keys.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataforge.functions.values import ts_text
from strataforge.operators import conform, features, quality, reshape, staging
from strataforge.operators.ids import ordered_ids
from strataforge.operators.rules import RuleEngine
from strataforge.operators.staging import DatasetContract
from strataforge.plans.problems import transactions
from strataforge.session import shared_dir, table
from strataforge.sinks.writers import VersionedTable, csv_to_parquet, write_target
from strataforge.sources import delimited, external
from strataforge.streaming.feeds import file_stream, merge_stream, windowed_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# --- staging ---------------------------------------------------------------------------------------------------------

CONTRACT = DatasetContract("DS_EVENTS", "events.csv", "user_id", ["user_id", "event_type", "effective_at", "updated_at"])


def staged_events(spark: SparkSession, d: str) -> DataFrame:
    """Events as versions of their user, every tenth delivered twice; days as times, so that some top times tie."""
    e = table(spark, d, "events")
    again = e.where("event_id % 10 = 0").withColumn("row", F.col("event_id") + 1_000_000)
    rows = e.withColumn("row", F.col("event_id")).unionByName(again).select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user_id"), "event_type", F.lit("2024-01-01").alias("effective_at"), F.substring(F.col("ts").cast("string"), 1, 10).alias("updated_at"),
        F.concat(F.lit("events_"), (F.col("event_id") % 3).cast("string"), F.lit(".csv")).alias("_source_file_name"), F.lit("/in").alias("_source_file_path"),
        F.lit("2024-02-01T00:00:00Z").alias("_source_file_modified_at"), F.col("row").alias("_source_row_number"),
    )
    return staging.stage_rows(rows, CONTRACT, source_system_id="SRC", run_id="R1", batch_date="2024-02-01", ingest_timestamp="2024-02-01T01:00:00Z")


_STAGED = """with src as (
  select 'u' || user_id user_id, event_type, '2024-01-01' effective_at, strftime(ts, '%Y-%m-%d') updated_at, 'events_' || (event_id % 3) || '.csv' f, event_id r from events
  union all select 'u' || user_id, event_type, '2024-01-01', strftime(ts, '%Y-%m-%d'), 'events_' || (event_id % 3) || '.csv', event_id + 1000000 from events where event_id % 10 = 0
), h as (
  select *, sha256(to_json({'effective_at': effective_at, 'event_type': event_type, 'updated_at': updated_at, 'user_id': user_id})::varchar) hash from src
), d as (
  select *, row_number() over (partition by user_id, effective_at, updated_at, hash order by f, r) > 1 dup from h
), k as (
  select *, row_number() over w rk, first_value(updated_at) over w = updated_at and first_value(effective_at) over w = effective_at top from d
  window w as (partition by user_id, dup order by updated_at desc, effective_at desc, f desc, r desc)
), a as (
  select *, count(distinct case when top then hash end) over (partition by user_id, dup) > 1 amb from k
), staged as (
  select *, not dup and not amb and rk = 1 latest,
    case when dup then 'pending' when amb and top then 'ambiguous_same_timestamp' when amb then 'pending' else 'resolved' end status from a
) """


@query("select c_custkey, sha256(to_json({'c_custkey': c_custkey::varchar, 'c_name': coalesce(c_name, '')})::varchar) record_hash from customer")
def staging_record_hash(spark, d):
    return table(spark, d, "customer").select("c_custkey", staging.record_hash(["c_custkey", "c_name"]).alias("record_hash"))


@query(_STAGED + "select user_id, r source_row, dup is_duplicate from staged")
def staging_exact_duplicates(spark, d):
    return staged_events(spark, d).select("user_id", F.col("_source_row_number").alias("source_row"), F.col("_is_exact_duplicate").alias("is_duplicate"))


@query(_STAGED + "select user_id, r source_row, latest is_latest, status from staged")
def staging_latest_resolution(spark, d):
    s = staged_events(spark, d)
    return s.select("user_id", F.col("_source_row_number").alias("source_row"), F.col("_is_latest_for_business_key").alias("is_latest"), F.col("_latest_resolution_status").alias("status"))


@query(_STAGED + "select user_id, r source_row, hash record_hash from staged where status = 'ambiguous_same_timestamp'")
def staging_ambiguous(spark, d):
    return staging.rejects(staged_events(spark, d)).select("user_id", F.col("_source_row_number").alias("source_row"), F.col("_record_hash").alias("record_hash"))


@query(_STAGED + "select count(*) staging_record_count, count(*) filter (dup) exact_duplicate_count, count(*) filter (status = 'ambiguous_same_timestamp') ambiguous_latest_count, case when count(*) filter (status = 'ambiguous_same_timestamp') = 0 then 'SUCCESS' else 'SUCCESS_WITH_WARNINGS' end status from staged")
def staging_counts(spark, d):
    return staging.stage_counts(staged_events(spark, d))


@query(_STAGED + "select user_id, event_type, updated_at from staged where latest and status = 'resolved' and not dup")
def eligible_rows(spark, d):
    return staging.eligible(staged_events(spark, d)).select("user_id", "event_type", "updated_at")


@query("select event_id, event_type || '-v' as version, 'not_applicable_event' status from events")
def staging_events_pattern(spark, d):
    e = table(spark, d, "events").select(F.col("event_id").cast("string").alias("event_id"), "event_type", F.lit("f.csv").alias("_source_file_name"), F.lit("/in").alias("_source_file_path"), F.lit("t").alias("_source_file_modified_at"), F.col("event_id").alias("_source_row_number"))
    c = DatasetContract("DS", "events.csv", "event_id", ["event_id", "event_type"], staging.EVENT)
    s = staging.stage_rows(e, c, source_system_id="S", run_id="R", batch_date="2024-02-01", ingest_timestamp="t")
    return s.select(F.col("event_id").cast("long").alias("event_id"), F.concat("event_type", F.lit("-v")).alias("version"), F.col("_latest_resolution_status").alias("status"))


# --- dimensions ------------------------------------------------------------------------------------------------------

_DIM = "c_sk bigint, c_custkey bigint, c_acctbal string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean, deleted_flag boolean, source_record_hash string, updated_run_id string"


def _batch(rows: DataFrame, key: str, attrs: list[str], at: str, load_type: str = "full", action: Column | None = None) -> DataFrame:
    """Rows as a staged batch in which every row is the latest of its key."""
    return rows.select(
        "*", F.lit(at).alias("effective_at"), F.lit(at).alias("updated_at"), staging.record_hash([key, *attrs]).alias("_record_hash"), F.lit(True).alias("_is_latest_for_business_key"),
        F.lit("resolved").alias("_latest_resolution_status"), F.lit(False).alias("_is_exact_duplicate"), F.lit("passed").alias("_dq_status"), F.lit(load_type).alias("_load_type"),
        (action if action is not None else F.lit("UPSERT")).alias("_delta_action"), F.lit("f.csv").alias("_source_file_name"), F.monotonically_increasing_id().alias("_source_row_number"), F.lit(at[:10]).alias("_batch_date"),
    )


def _customers(spark, d, day: int) -> DataFrame:
    c = table(spark, d, "customer")
    money = lambda x: x.cast("decimal(14,2)").cast("string").alias("c_acctbal")
    if day == 1:
        return c.select("c_custkey", money(F.col("c_acctbal")))
    changed = F.when(F.col("c_custkey") % 7 == 0, F.col("c_acctbal").cast("decimal(14,2)") + 100).otherwise(F.col("c_acctbal").cast("decimal(14,2)"))
    kept = c.where("c_custkey % 10 <> 0").select("c_custkey", money(changed))
    return kept.unionByName(c.where("c_custkey % 50 = 1").select((F.col("c_custkey") + 1_000_000).alias("c_custkey"), money(F.col("c_acctbal"))))


def _dim(spark, d, day: int, **options) -> DataFrame:
    kw = dict(business_key="c_custkey", surrogate_key="c_sk", attributes=["c_acctbal"])
    out = conform.scd2_merge(spark.createDataFrame([], _DIM), _batch(_customers(spark, d, 1), "c_custkey", ["c_acctbal"], "2024-01-01 00:00:00"), run_id="R1", batch_timestamp="2024-01-01 06:00:00", **kw)
    if day == 2:
        load = options.pop("load_type", "full")
        out = conform.scd2_merge(out, _batch(_customers(spark, d, 2), "c_custkey", ["c_acctbal"], "2024-01-02 00:00:00", load), run_id="R2", batch_timestamp="2024-01-02 06:00:00", **kw, **options)
    return out


def _shown(dim: DataFrame) -> DataFrame:
    return dim.select("c_sk", "c_custkey", "c_acctbal", ts_text(F.col("effective_from")).alias("effective_from"), ts_text(F.col("effective_to")).alias("effective_to"), "is_current", "deleted_flag")


_DAY1 = "select row_number() over (order by c_custkey) c_sk, c_custkey, c_acctbal::decimal(14,2) bal from customer"
_OPEN = "9999-12-31 00:00:00"


def _day2_sql(gone: str) -> str:
    return f"""with d1 as ({_DAY1}), d2 as (
  select c_custkey, case when c_custkey % 7 = 0 then c_acctbal::decimal(14,2) + 100 else c_acctbal::decimal(14,2) end bal from customer where c_custkey % 10 <> 0
  union all select c_custkey + 1000000, c_acctbal::decimal(14,2) from customer where c_custkey % 50 = 1
), fresh as (select d2.* from d2 left join d1 using (c_custkey) where d1.bal is distinct from d2.bal)
select c_sk, c_custkey, bal::varchar c_acctbal, '2024-01-01 00:00:00' effective_from,
  case when f.k is not null then '2024-01-02 00:00:00' when {gone} then '2024-01-02 06:00:00' else '{_OPEN}' end effective_to,
  f.k is null and not ({gone}) is_current, {gone} deleted_flag
from d1 left join (select c_custkey k from fresh) f on f.k = c_custkey
union all
select (select max(c_sk) from d1) + row_number() over (order by c_custkey), c_custkey, bal::varchar, '2024-01-02 00:00:00', '{_OPEN}', true, false from fresh"""


@query(f"select c_sk, c_custkey, bal::varchar c_acctbal, '2024-01-01 00:00:00' effective_from, '{_OPEN}' effective_to, true is_current, false deleted_flag from ({_DAY1})")
def scd2_initial(spark, d):
    return _shown(_dim(spark, d, 1))


@query(_day2_sql("c_custkey % 10 = 0"))
def scd2_day2(spark, d):
    return _shown(_dim(spark, d, 2))


@query("select c_custkey, '2024-01-02 06:00:00' effective_to from customer where c_custkey % 10 = 0")
def scd2_soft_delete(spark, d):
    return _dim(spark, d, 2).where("deleted_flag").select("c_custkey", ts_text(F.col("effective_to")).alias("effective_to"))


@query(_day2_sql("false"))
def scd2_ignore(spark, d):
    return _shown(_dim(spark, d, 2, missing="ignore"))


@query(_day2_sql("false"))
def scd2_delta_never_deletes(spark, d):
    return _shown(_dim(spark, d, 2, load_type="delta"))


@query(f"select c_custkey, case when c_custkey % 4 = 0 then '2024-01-02 06:00:00' else '{_OPEN}' end effective_to, c_custkey % 4 <> 0 is_current, c_custkey % 4 = 0 deleted_flag from customer")
def scd2_apply_deletes(spark, d):
    delta = _batch(_customers(spark, d, 1).where("c_custkey % 4 = 0"), "c_custkey", ["c_acctbal"], "2024-01-02 00:00:00", "delta", F.lit("DELETE"))
    out = conform.scd2_merge(_dim(spark, d, 1), delta, business_key="c_custkey", surrogate_key="c_sk", attributes=["c_acctbal"], run_id="R2", batch_timestamp="2024-01-02 06:00:00", apply_deletes=True)
    return out.select("c_custkey", ts_text(F.col("effective_to")).alias("effective_to"), "is_current", "deleted_flag")


@query("select row_number() over (order by s_suppkey) s_sk, s_suppkey, s_name, s_nationkey, n_nationkey * 10 + 7 nation_sk, s_suppkey business_key, '2024-01-01 00:00:00' effective_from, '9999-12-31 00:00:00' effective_to, true is_current, false deleted_flag, "
       "'2024-01-01 00:00:00' source_effective_at, 'R' created_run_id, 'R' updated_run_id, '2024-01-01 06:00:00' created_at from supplier join nation on n_nationkey = s_nationkey where n_nationkey < 15")  # fmt: skip
def scd2_fk_gated(spark, d):
    """Rows without a current parent aren't merged; the parent's surrogate key comes along, also where the parent has two current rows."""
    n = table(spark, d, "nation")
    parents = n.select("n_nationkey", (F.col("n_nationkey") * 10 + 7).alias("nation_sk"), (F.col("n_nationkey") < 15).alias("is_current")).unionByName(n.select("n_nationkey", F.col("n_nationkey").alias("nation_sk"), (F.col("n_nationkey") < 5).alias("is_current")))
    dim = spark.createDataFrame([], "s_sk bigint, s_suppkey bigint, s_name string, s_nationkey int, nation_sk int, business_key bigint, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean, deleted_flag boolean, source_effective_at timestamp_ntz, source_record_hash string, created_run_id string, updated_run_id string, created_at timestamp_ntz")
    batch = _batch(table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey"), "s_suppkey", ["s_name", "s_nationkey"], "2024-01-01 00:00:00")
    out = conform.scd2_merge(dim, batch, business_key="s_suppkey", surrogate_key="s_sk", attributes=["s_name", "s_nationkey"], run_id="R", batch_timestamp="2024-01-01 06:00:00", parents=[("s_nationkey", parents, "n_nationkey", "nation_sk", "nation_sk")])
    return _times_as_text(out.drop("source_record_hash"))


def _times_as_text(df: DataFrame) -> DataFrame:
    return df.select(*[ts_text(F.col(c)).alias(c) if t.startswith("timestamp") else F.col(c) for c, t in df.dtypes])


_FLEET_DIM = ["vehicle_sk", "vehicle_id", "client_sk", "client_id", "asset_type", "make", "model", "model_year", "fuel_type", "state_registered", "odometer_km", "in_service_date", "lease_end_date", "vehicle_status", "business_key", "effective_from", "effective_to", "is_current", "deleted_flag", "source_effective_at", "source_updated_at", "source_record_hash", "created_at", "updated_at"]
_VEHICLE_ATTRIBUTES = ["client_id", *_FLEET_DIM[4:14]]
# One eligible row a vehicle of the first and of the last full extract, with the key of its client's current row.
_FLEET_SQL = """with cal as (select min(_batch_date) d1, max(_batch_date) d2 from vehicles_ext where _load_type = 'full'),
c as (select client_id, max(client_sk) client_sk from dim_client where is_current group by 1),
e as (
  select v.*, c.client_sk from vehicles_ext v join c using (client_id) where _load_type = 'full' and vehicle_id is not null and coalesce(_is_latest_for_business_key, false) and _latest_resolution_status = 'resolved'
    and not coalesce(_is_exact_duplicate, false) and coalesce(_dq_status, 'passed') = 'passed' and coalesce(upper(trim(_delta_action)) <> 'DELETE', true)
), a as (select * from e, cal where _batch_date = d1 qualify row_number() over (partition by vehicle_id order by staged_row_id desc) = 1),
b as (select * from e, cal where _batch_date = d2 qualify row_number() over (partition by vehicle_id order by staged_row_id desc) = 1),
seen as (select distinct vehicle_id from vehicles_ext, cal where _load_type = 'full' and _batch_date = d2),
one as (select row_number() over (order by vehicle_id) vehicle_sk, * from a),
two as (select (select count(*) from a) + row_number() over (order by b.vehicle_id) vehicle_sk, b.* from b left join a using (vehicle_id) where a.vehicle_id is null or a._record_hash is distinct from b._record_hash)
"""


@query(_FLEET_SQL + f"""select one.vehicle_sk, one.vehicle_id, one.client_sk, {', '.join('one.' + a for a in _VEHICLE_ATTRIBUTES)}, one.vehicle_id business_key, strftime(one.effective_at, '%Y-%m-%d %H:%M:%S') effective_from,
  case when two.vehicle_id is not null then coalesce(strftime(two.effective_at, '%Y-%m-%d %H:%M:%S'), '2025-12-02 00:00:00') when seen.vehicle_id is null then '2025-12-02 00:00:00' else '9999-12-31 00:00:00' end effective_to,
  two.vehicle_id is null and seen.vehicle_id is not null is_current, two.vehicle_id is null and seen.vehicle_id is null deleted_flag, strftime(one.effective_at, '%Y-%m-%d %H:%M:%S') source_effective_at,
  strftime(one.updated_at, '%Y-%m-%d %H:%M:%S') source_updated_at, one._record_hash source_record_hash, '2025-12-01 00:00:00' created_at, case when two.vehicle_id is not null or seen.vehicle_id is null then '2025-12-02 00:00:00' else '2025-12-01 00:00:00' end updated_at
from one left join two on two.vehicle_id = one.vehicle_id left join seen on seen.vehicle_id = one.vehicle_id
union all select two.vehicle_sk, vehicle_id, client_sk, {', '.join('two.' + a for a in _VEHICLE_ATTRIBUTES)}, vehicle_id, strftime(effective_at, '%Y-%m-%d %H:%M:%S'), '9999-12-31 00:00:00', true, false, strftime(effective_at, '%Y-%m-%d %H:%M:%S'),
  strftime(updated_at, '%Y-%m-%d %H:%M:%S'), _record_hash, '2025-12-02 00:00:00', '2025-12-02 00:00:00' from two""")  # fmt: skip
def scd2_vehicle_dimension(spark, d):
    """The vehicle dimension with its client keys from the first and the last full extract, all columns, through a versioned table."""
    rows = table(spark, d, "vehicles_ext").where("_load_type = 'full'")
    ends = rows.agg(F.min("_batch_date").alias("a"), F.max("_batch_date").alias("b")).first()
    clients = table(spark, d, "dim_client")
    kinds = {**dict(rows.dtypes), **dict(clients.dtypes), **dict(table(spark, d, "dim_vehicle").dtypes)}
    target = VersionedTable(spark, scratch(spark, "dim-vehicle"))
    for day, at in ((ends.a, "2025-12-01 00:00:00"), (ends.b, "2025-12-02 00:00:00")):
        # Where an extract has two rows of a vehicle that may be merged, the last one staged is taken beforehand.
        batch = rows.where(F.col("_batch_date") == F.lit(day))
        gated = staging.with_parents(batch, [("client_id", clients, "client_id")])
        last = F.max(F.when(staging.may_be_merged() & F.col("_parents") & F.coalesce(F.upper(F.trim("_delta_action")) != "DELETE", F.lit(True)), F.col("staged_row_id"))).over(Window.partitionBy("vehicle_id"))
        batch = gated.withColumn("_last", last).withColumn("_is_latest_for_business_key", F.col("_last") == F.col("staged_row_id")).drop("_last", "_parents", "_parent_keys")
        now = target.read if target.exists() else lambda *_: spark.createDataFrame([], ", ".join(f"{c} {kinds[c]}" for c in _FLEET_DIM))
        target.apply(conform.scd2_change(now(), now(conform.CURRENT), batch, business_key="vehicle_id", surrogate_key="vehicle_sk", attributes=_VEHICLE_ATTRIBUTES, run_id="R", batch_timestamp=at, parents=[("client_id", clients, "client_id", "client_sk", "client_sk")]), at)
    return _times_as_text(target.read())


_RUNS = """with r as (select user_id, ts, event_id, event_type, lag(event_type) over (partition by user_id order by ts, event_id) p from events),
c as (select * from r where p is null or p <> event_type) """


@query(_RUNS + f"select row_number() over (order by user_id, ts, event_id) sk, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') effective_from, coalesce(strftime(lead(ts) over w, '%Y-%m-%d %H:%M:%S'), '{_OPEN}') effective_to, lead(ts) over w is null is_current from c window w as (partition by user_id order by ts, event_id)")
def scd2_from_history(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_type", "event_id", F.col("ts").alias("effective_at"), F.col("event_type").alias("_record_hash"))
    out = conform.scd2_from_history(rows, business_key="user_id", surrogate_key="sk", attributes=["event_type"], order=["effective_at", "event_id"])
    return out.select("sk", "user_id", "event_type", ts_text(F.col("effective_from")).alias("effective_from"), ts_text(F.col("effective_to")).alias("effective_to"), "is_current")


@query("select c_custkey, case when c_custkey % 7 = 0 then 'CHANGED' else c_mktsegment end c_mktsegment from customer union all select c_custkey + 1000000, c_mktsegment from customer where c_custkey % 50 = 1")
def scd1_merge(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    source = c.where("c_custkey % 7 = 0").select("c_custkey", F.lit("CHANGED").alias("c_mktsegment")).unionByName(c.where("c_custkey % 50 = 1").select((F.col("c_custkey") + 1_000_000).alias("c_custkey"), "c_mktsegment"))
    return conform.scd1_merge(c, source, "c_custkey")


@query("select o_orderkey, case when o_orderkey % 2 = 1 then 'old' else 'new' end batch from orders")
def append_only_merge(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    known = o.where("o_orderkey % 2 = 1").select("o_orderkey", "o_orderstatus", F.col("o_orderkey").alias("event_business_key"), F.lit("h").alias("source_record_hash"), F.lit("old").alias("batch_date"))
    staged = _batch(o.unionByName(o.where("o_orderkey % 3 = 0")), "o_orderkey", ["o_orderstatus"], "new").withColumn("_batch_date", F.lit("new"))
    return conform.append_only_merge(known, staged, event_key="o_orderkey", columns=["o_orderkey", "o_orderstatus"]).select("o_orderkey", F.col("batch_date").alias("batch"))


@query("select case when o_orderkey % 5 <> 0 then o_orderkey end k, o_orderkey, case when o_orderkey % 5 <> 0 and o_orderkey % 2 = 1 then 'old' else 'new' end batch from orders where o_orderkey % 5 <> 0 or o_orderkey % 2 = 0 union all select null, o_orderkey, 'new' from orders where o_orderkey % 5 = 0 and o_orderkey % 2 = 1")
def append_only_null_keys(spark, d):
    """Rows with a null key are no one's repetition: all of them are added."""
    o = table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey")).alias("k"), "o_orderkey")
    known = o.where("k is not null and o_orderkey % 2 = 1").select("k", "o_orderkey", F.col("k").alias("event_business_key"), F.lit("old").alias("batch_date"))
    staged = _batch(o, "o_orderkey", ["k"], "new").withColumn("_batch_date", F.lit("new"))
    return conform.append_only_merge(known, staged, event_key="k", columns=["k", "o_orderkey"]).select("k", "o_orderkey", F.col("batch_date").alias("batch"))


@query("select o_orderkey, 1::bigint versions from orders where o_orderkey % 3 <> 0 union all select o_orderkey, 2::bigint from orders where o_orderkey % 3 = 0")
def version_history_merge(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    day1 = _batch(o, "o_orderkey", ["o_orderstatus"], "2024-01-01")
    day2 = _batch(o.where("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("X")), "o_orderkey", ["o_orderstatus"], "2024-01-02")
    empty = spark.createDataFrame([], "o_orderkey bigint, o_orderstatus string, event_business_key bigint, source_updated_at string, source_record_hash string, delta_action string")
    history = empty
    for batch in (day1, day2, day1):  # the first again: nothing is added
        history = conform.version_history_merge(history, batch, business_key="o_orderkey", columns=["o_orderkey", "o_orderstatus"])
    return history.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("versions"))


@query("select l_orderkey, l_linenumber from lineitem where l_orderkey % 5 = 0")
def ri_orphans(spark, d):
    parent = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 5 != 0).alias("is_current"))
    return conform.orphans(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), parent, "l_orderkey", "o_orderkey")


@query("select o_orderkey from orders where o_custkey % 11 = 0")
def ri_null_fk(spark, d):
    child = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 11 != 0, F.col("o_custkey")).alias("fk"))
    return conform.null_references(child, "fk").select("o_orderkey")


@query("select user_id, event_type, strftime(ts, '%Y-%m-%d') event_date, count(*) event_count, 'b1' batch_date from events group by all union all select 1, 'kept', '2023-12-31', 5, 'b0'")
def daily_summary_rebuild(spark, d):
    staged = table(spark, d, "events").select("user_id", "event_type", "ts", F.lit("b1").alias("_batch_date"), F.lit(False).alias("_is_exact_duplicate"), F.lit(None).cast("string").alias("_dq_status"))
    old = spark.sql("select 1L user_id, 'kept' event_type, date '2023-12-31' event_date, 5L event_count, 'b0' batch_date union all select 1L, 'stale', date '2024-01-01', 9L, 'b1'")
    return conform.rebuild_summary(old, staged, batch_date="b1", keys=["user_id", "event_type"], event_time="ts").withColumn("event_date", F.col("event_date").cast("string"))


@query("select strftime(d, '%Y%m%d')::int date_sk, strftime(d, '%Y-%m-%d') calendar_date, year(d)::int \"year\", quarter(d)::int \"quarter\", month(d)::int \"month\", day(d)::int \"day\", isodow(d)::int iso_weekday, isodow(d) > 5 is_weekend from range(timestamp '2020-01-01', timestamp '2026-01-01', interval 1 day) t(d)")
def dim_date(spark, d):
    return conform.dim_date(spark, "2020-01-01", "2025-12-31").withColumn("calendar_date", F.col("calendar_date").cast("string"))


# --- features --------------------------------------------------------------------------------------------------------

_SCORE_SQL = """select {cols}, multiple_fill_flag, no_usage_match_flag, high_value_transaction_flag, fuel_card_vehicle_mismatch_flag, transaction_frequency_7d,
  least(100, case when high_value_transaction_flag then 30 else 0 end + case when no_usage_match_flag then 25 else 0 end + case when fuel_card_vehicle_mismatch_flag then 30 else 0 end + case when multiple_fill_flag then 15 else 0 end)::int fuel_anomaly_score,
  concat_ws(',', case when high_value_transaction_flag then 'HIGH_VALUE_TRANSACTION' end, case when no_usage_match_flag then 'NO_USAGE_MATCH' end, case when fuel_card_vehicle_mismatch_flag then 'CARD_VEHICLE_MISMATCH' end, case when multiple_fill_flag then 'MULTIPLE_FILLS_7D' end) anomaly_reason_codes
from (select *, n7 > 1 multiple_fill_flag, km is null or km <= 0 no_usage_match_flag, amount > {limit} or (sd is not null and amount > av + 2 * sd) high_value_transaction_flag,
  {mismatch} fuel_card_vehicle_mismatch_flag, n7 transaction_frequency_7d from (
  select *, count(*) over (partition by card order by tm range between interval 7 day preceding and current row) n7, avg(amount::double) over (partition by card) av, stddev_samp(amount::double) over (partition by card) sd from t))"""


@query("with t as (select e.event_id, e.user_id card, e.ts tm, e.value::decimal(18,2)::double amount, u.km, json_extract_string(e.props, '$.k')::int k, c.c_nationkey from events e "
       "left join (select user_id, ts::date d, sum(value::decimal(18,2)) km from events where event_type = 'view' group by all) u on u.user_id = e.user_id and u.d = e.ts::date "
       "left join customer c on c.c_custkey = e.user_id where e.event_type = 'purchase') "
       + _SCORE_SQL.format(cols="event_id", limit=40, mismatch="(c_nationkey is not null and k % 25 <> c_nationkey)"))
def feature_anomaly_score(spark, d):
    """The flagship: purchases as transactions of a user's card, views as usage, customers as the dimension."""
    e = table(spark, d, "events")
    money = F.col("value").cast("decimal(18,2)")
    txn = e.where("event_type = 'purchase'").select("event_id", F.col("user_id").alias("card"), F.col("ts").alias("at"), F.to_date("ts").alias("day"), money.alias("amount"), F.get_json_object("props", "$.k").cast("int").alias("k"))
    usage = features.usage_per_day(e.where("event_type = 'view'").select("user_id", "ts", money.alias("km")), "user_id", F.to_date("ts"), "km")
    dim = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    joined = txn.join(usage, (F.col("card") == F.col("usage_key")) & (F.col("day") == F.col("usage_day")), "left").join(dim, F.col("card") == F.col("c_custkey"), "left")
    mismatch = F.col("c_nationkey").isNotNull() & (F.col("k") % 25 != F.col("c_nationkey"))
    scored = features.score(features.card_windows(joined, "card", "at", "amount"), amount="amount", distance="distance_km", mismatch=mismatch, amount_limit=40)
    return scored.select("event_id", *[f for f, _, _ in features.RULES], "transaction_frequency_7d", "fuel_anomaly_score", "anomaly_reason_codes")


_FEATURE_COLUMNS = "fuel_transaction_id, fuel_card_id, vehicle_id, vehicle_sk, client_id, client_sk, strftime(tm, '%Y-%m-%d %H:%M:%S') transaction_datetime, strftime(tm, '%Y-%m-%d') transaction_date, merchant_state, fuel_product, litres, gross_amount, km distance_km, (case when km > 0 then round(amount / km::double, 4) end) fuel_cost_per_km, 'fuel_anomaly_rules_v0.1' feature_version, '2025-04-01 06:00:00' scored_at, strftime(tm, '%Y-%m-%d') batch_date, source_record_hash"


@query("with x as (select fuel_transaction_id, fuel_card_id, vehicle_id, client_id, transaction_datetime, merchant_state, fuel_product, litres, gross_amount, source_record_hash, distance_km from feature_fuel_anomaly_score qualify row_number() over (partition by fuel_transaction_id order by scored_at desc, batch_date desc) = 1), "
       "u as (select vehicle_id v, transaction_datetime::date d, sum(distance_km) km from x group by all), "
       "c as (select fuel_card_id i, max((vehicle_id, client_id)) m from dim_fuel_card where is_current group by 1), "
       "dv as (select vehicle_id i, max(vehicle_sk) vehicle_sk from dim_vehicle where is_current group by 1), dc as (select client_id i, max(client_sk) client_sk from dim_client where is_current group by 1), "
       "t as (select x.* exclude (distance_km), fuel_card_id card, transaction_datetime tm, gross_amount::double amount, u.km, dv.vehicle_sk, dc.client_sk, c.m[1] cv, c.m[2] cc from x "
       "left join u on u.v = x.vehicle_id and u.d = x.transaction_datetime::date left join c on c.i = x.fuel_card_id left join dv on dv.i = x.vehicle_id left join dc on dc.i = x.client_id) "
       + _SCORE_SQL.format(cols=_FEATURE_COLUMNS, limit=250, mismatch="((cv is not null and cv <> vehicle_id) or (cc is not null and cc <> client_id))"))
def fuel_anomaly_feature(spark, d):
    """The whole feature over the fleet tables, all 25 columns."""
    out = _feature(spark, d)
    return _times_as_text(out.withColumns({"fuel_cost_per_km": F.round(F.col("fuel_cost_per_km").cast("double"), 4), "batch_date": F.col("batch_date").cast("string"), "transaction_date": F.col("transaction_date").cast("string")}))


def _feature(spark, d) -> DataFrame:
    cols = ["fuel_card_id", "vehicle_id", "client_id", "transaction_datetime", "merchant_state", "fuel_product", "litres", "gross_amount", "source_record_hash", "distance_km"]
    txn = transactions(spark, d, *cols)
    usage = txn.select("vehicle_id", F.col("transaction_datetime").alias("event_date"), "distance_km")
    return features.fuel_anomaly_score(txn.drop("distance_km"), usage, table(spark, d, "dim_fuel_card"), table(spark, d, "dim_vehicle"), table(spark, d, "dim_client"), scored_at="2025-04-01 06:00:00")


@query("select event_id, count(*) over (partition by user_id order by ts range between interval 7 day preceding and current row) n from events")
def rolling_7d_count(spark, d):
    return table(spark, d, "events").select("event_id", F.expr("count(1) over (partition by user_id order by ts range between interval '7' day preceding and current row)").alias("n"))


@query("select o_orderkey, round(avg(o_totalprice) over (partition by o_custkey), 6) av, round(stddev_samp(o_totalprice) over (partition by o_custkey), 0) sd from orders")
def partition_avg_stddev(spark, d):
    w = Window.partitionBy("o_custkey")
    return table(spark, d, "orders").select("o_orderkey", F.round(F.avg("o_totalprice").over(w), 6).alias("av"), F.round(F.stddev_samp("o_totalprice").over(w), 0).alias("sd"))


@query(_RUNS + "select user_id, event_id, event_type, p previous from c")
def lag_change_points(spark, d):
    previous = F.lag("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return table(spark, d, "events").withColumn("previous", previous).where("previous is null or previous <> event_type").select("user_id", "event_id", "event_type", "previous")


@query("select o_orderkey, coalesce(strftime(lead(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey), '%Y-%m-%d %H:%M:%S'), '9999-12-31 00:00:00') until from orders")
def lead_intervals(spark, d):
    following = F.lead("o_orderdate").over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    return table(spark, d, "orders").select("o_orderkey", F.coalesce(ts_text(following), F.lit(_OPEN)).alias("until"))


@query("select row_number() over (order by o_custkey, o_orderkey) sk, o_custkey, o_orderkey from orders")
def rownum_surrogate(spark, d):
    return ordered_ids(table(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"], "sk")


# --- relational ------------------------------------------------------------------------------------------------------


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 50")
def topk_review(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(50)


@query("select c_custkey from customer where c_custkey in (select o_custkey from orders where o_totalprice > 300000)")
def semi_changed_keys(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders").where("o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT' and o_orderstatus = 'F')")
def anti_missing_keys(spark, d):
    urgent = table(spark, d, "orders").where("o_orderpriority = '1-URGENT' and o_orderstatus = 'F'")
    return table(spark, d, "customer").join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("select c_custkey, count(o_orderkey) n from customer left join orders on o_custkey = c_custkey and o_orderstatus = 'F' group by 1 having count(o_orderkey) <> 1")
def bad_history(spark, d):
    closed = table(spark, d, "orders").where("o_orderstatus = 'F'")
    return table(spark, d, "customer").join(closed, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n")).where("n <> 1")


@query("select a.l_orderkey, a.l_linenumber from lineitem a join lineitem b on a.l_orderkey = b.l_orderkey and a.l_linenumber = b.l_linenumber + 1 where a.l_returnflag <> b.l_returnflag")
def self_join_changes(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    before = rows.select("l_orderkey", (F.col("l_linenumber") + 1).alias("l_linenumber"), F.col("l_returnflag").alias("was"))
    return rows.join(before, ["l_orderkey", "l_linenumber"]).where("l_returnflag <> was").select("l_orderkey", "l_linenumber")


@query("select l_partkey, l_suppkey, count(*) n from lineitem group by all having count(*) > 1")
def dup_keys_having(spark, d):
    return table(spark, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("select l_returnflag, count(*) n, count(*) filter (l_quantity > 25) big, count(distinct l_suppkey) suppliers, count(*) filter (l_discount is null) no_discount, round(sum(l_extendedprice), 2) total, min(l_shipdate) first_ship from lineitem group by 1")
def count_if_checks(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_quantity") > 25).alias("big"), F.countDistinct("l_suppkey").alias("suppliers"), F.count_if(F.col("l_discount").isNull()).alias("no_discount"),
        F.round(F.sum("l_extendedprice"), 2).alias("total"), F.min("l_shipdate").alias("first_ship"),
    )


@query("(select o_custkey k from orders where o_orderstatus = 'O' intersect select o_custkey from orders where o_orderstatus = 'F') union all (select c_custkey from customer except select o_custkey from orders)")
def set_operations(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    keys = lambda s: o.where(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("k"))
    return keys("O").intersect(keys("F")).unionByName(c.subtract(o.select(F.col("o_custkey").alias("k"))))


@query("select p_partkey, try_cast(p_name as int) as_int, round(try_cast(p_retailprice::varchar as decimal(38,6)), 0)::bigint as_rounded, try_cast(p_size::varchar as decimal(5,2)) as_decimal, try_cast('2024-02-' || lpad((p_size)::varchar, 2, '0') as date)::varchar as_date, strftime(try_cast('2024-02-' || lpad((p_size)::varchar, 2, '0') || ' 10:11:12' as timestamp), '%Y-%m-%d %H:%M:%S') seen_at from part")
def safe_casts(spark, d):
    """Text columns typed by name and by mapping; what doesn't parse is null, whole numbers round."""
    size = F.lpad(F.col("p_size").cast("string"), 2, "0")
    text = table(spark, d, "part").select(
        "p_partkey", F.col("p_name").alias("as_int"), F.col("p_retailprice").cast("string").alias("as_rounded"), F.col("p_size").cast("string").alias("as_decimal"), F.concat(F.lit("2024-02-"), size).alias("as_date"),
        F.concat(F.lit("2024-02-"), size, F.lit(" 10:11:12")).alias("seen_at"),
    )
    typed = external.typed(text, {"as_int": "int", "as_rounded": "bigint", "as_decimal": "decimal(5,2)"})
    return typed.withColumns({"as_date": F.col("as_date").cast("string"), "seen_at": ts_text(F.col("seen_at"))})


@query("select p_partkey, case when p_size > 25 then 'big' else 'small' end size_class, coalesce(nullif(p_brand, 'Brand#11'), 'none') brand, least(30, p_size) capped, round(p_retailprice / nullif(p_size - 10, 0), 4) per_size from part")
def conditional_exprs(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", F.when(F.col("p_size") > 25, "big").otherwise("small").alias("size_class"), F.coalesce(F.nullif("p_brand", F.lit("Brand#11")), F.lit("none")).alias("brand"),
        F.least(F.lit(30), "p_size").alias("capped"), F.round(F.try_divide("p_retailprice", F.col("p_size") - 10), 4).alias("per_size"),
    )


@query("select p_partkey, concat_ws(',', case when p_size > 25 then 'BIG' end, case when p_retailprice > 1000 then 'DEAR' end) codes from part")
def reason_codes(spark, d):
    return table(spark, d, "part").select("p_partkey", F.concat_ws(",", F.when(F.col("p_size") > 25, "BIG"), F.when(F.col("p_retailprice") > 1000, "DEAR")).alias("codes"))


@query("select p_partkey, regexp_replace(p_brand, '^Brand#', '') brand_no, upper(trim(p_type)) kind, split_part(p_name, ' ', 1) head, length(p_name) n, p_name like '%a%' has_a from part")
def string_clean(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", F.regexp_replace("p_brand", "^Brand#", "").alias("brand_no"), F.upper(F.trim("p_type")).alias("kind"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("head"),
        F.length("p_name").cast("long").alias("n"), F.col("p_name").like("%a%").alias("has_a"),
    )


@query("select o_orderkey from orders where o_orderdate >= timestamp '1995-01-01' and o_orderdate < timestamp '1996-01-01' and o_orderpriority between '1' and '3'")
def parameter_filter(spark, d):
    """A query with named parameters."""
    text = "select o_orderkey from {o} where o_orderdate >= to_timestamp_ntz(:since) and o_orderdate < to_timestamp_ntz(:until) and o_orderpriority between :low and :high"
    return spark.sql(text, args={"since": "1995-01-01", "until": "1996-01-01", "low": "1", "high": "3"}, o=table(spark, d, "orders"))


@query("select c_custkey, c_acctbal > (select avg(c_acctbal) from customer) above from customer")
def scalar_subquery(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", (F.col("c_acctbal") > table(spark, d, "customer").agg(F.avg("c_acctbal")).scalar()).alias("above"))


@query("select o_custkey, max_by(o_orderkey, (o_orderdate, o_orderkey)) last_order from orders group by 1")
def last_per_key(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("last_order"))


@query("select o_orderkey from orders where 1 = 0")
def constant_false(spark, d):
    return table(spark, d, "orders").where("1 = 0").select("o_orderkey")


@query("select 'orders' table_name, (select count(*) from orders) + 1 row_count, (select count(*) from orders) actual_count union all select 'ghost', 5, 0")
def manifest_reconciliation(spark, d):
    n, c = table(spark, d, "orders").count(), table(spark, d, "customer").count()
    expected = spark.createDataFrame([("orders", n + 1), ("customer", c), ("ghost", 5)], "table_name string, row_count long")
    return quality.manifest_differences(expected, spark.createDataFrame([("orders", n), ("customer", c)], "table_name string, actual_count long"))


# --- reshape, rules, quality ------------------------------------------------------------------------------------------


@query("select n_name, arg_max(c_acctbal, c_custkey) filter (c_mktsegment = 'BUILDING') building, arg_max(c_acctbal, c_custkey) filter (c_mktsegment = 'MACHINERY') machinery from customer join nation on c_nationkey = n_nationkey group by 1")
def reshape_pivot_lookup(spark, d):
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return reshape.pivot_last(c, "n_name", "c_mktsegment", "c_acctbal", ["c_custkey"], {"BUILDING": "building", "MACHINERY": "machinery"})


def _rule(name: str, sql: str, rules: list[dict], source: str, cols: list[str], tables: Callable | None = None) -> None:
    def run(spark, d):
        return RuleEngine().apply(table(spark, d, source).select(*cols), rules, tables(spark, d) if tables else None)

    QUERIES[f"rule_engine_{name}"], SQL[f"rule_engine_{name}"] = run, sql


_PART = ["p_partkey", "p_name", "p_brand", "p_size"]
_rule("select", "select p_partkey, upper(p_brand) b from part", [{"rule_type": "select", "options": {"columns": ["p_partkey", "upper(p_brand) as b"]}}], "part", _PART)
_rule("filter", "select p_partkey from part where p_size > 40", [{"rule_type": "filter", "rule_sequence": 1, "rule_expression": "p_size > 40"}, {"rule_type": "select", "rule_sequence": 2, "rule_expression": "p_partkey"}], "part", _PART)
_rule("derive_column", "select p_partkey, p_size * 2 twice from part", [{"rule_type": "derive_column", "target_column": "twice", "rule_expression": "p_size * 2"}], "part", ["p_partkey", "p_size"])
SQL["rule_engine_derive_column"] = "select p_partkey, p_size, p_size * 2 twice from part"
_rule("regex_replace", "select p_partkey, regexp_replace(p_brand, '[0-9]', '', 'g') p_brand from part", [{"rule_type": "regex_replace", "source_column": "p_brand", "rule_expression": "[0-9]"}], "part", ["p_partkey", "p_brand"])
_rule("cast", "select p_partkey, p_size::varchar p_size from part", [{"rule_type": "cast", "source_column": "p_size", "rule_expression": "string"}], "part", ["p_partkey", "p_size"])
_rule("regex_clean_cast", "select p_partkey, regexp_replace(p_brand, '[^0-9]', '', 'g')::int p_brand from part", [{"rule_type": "regex_clean_cast", "source_column": "p_brand", "rule_expression": "[^0-9]", "options": {"type": "int"}}], "part", ["p_partkey", "p_brand"])
_rule("split", "select p_partkey, p_brand, split_part(p_brand, '#', 1) a, split_part(p_brand, '#', 2) b from part", [{"rule_type": "split", "source_column": "p_brand", "target_column": "a, b", "rule_expression": "#"}], "part", ["p_partkey", "p_brand"])
_rule("join", "select o_custkey as k, o_orderkey, c_name from orders join customer on c_custkey = o_custkey", [{"rule_type": "derive_column", "rule_sequence": 1, "target_column": "k", "rule_expression": "o_custkey"}, {"rule_type": "join", "rule_sequence": 2, "rule_expression": "k", "options": {"table": "c"}}, {"rule_type": "select", "rule_sequence": 3, "rule_expression": "k, o_orderkey, c_name"}], "orders", ["o_orderkey", "o_custkey"], lambda s, d: {"c": table(s, d, "customer").select(F.col("c_custkey").alias("k"), "c_name")})
_rule("pivot", "select o_custkey, count(*) filter (o_orderstatus = 'F') f, count(*) filter (o_orderstatus = 'O') o from orders group by 1", [{"rule_type": "pivot", "rule_sequence": 1, "source_column": "o_orderstatus", "rule_expression": "count(1)", "options": {"keys": ["o_custkey"], "values": ["F", "O"]}}, {"rule_type": "select", "rule_sequence": 2, "rule_expression": "o_custkey, coalesce(F, 0L) f, coalesce(O, 0L) o", "options": {"columns": ["o_custkey", "coalesce(F, 0L) f", "coalesce(O, 0L) o"]}}], "orders", ["o_custkey", "o_orderstatus"])
_rule("aggregate", "select o_custkey, count(*) n, max(o_orderkey) last_key from orders group by 1", [{"rule_type": "aggregate", "source_column": "o_custkey", "rule_expression": "count(1) as n, max(o_orderkey) as last_key"}], "orders", ["o_custkey", "o_orderkey"])
_rule("deduplicate", "select o_custkey, max(o_orderkey) o_orderkey from orders group by 1", [{"rule_type": "deduplicate", "source_column": "o_custkey", "rule_expression": "o_orderkey desc"}], "orders", ["o_custkey", "o_orderkey"])
_rule("deduplicate_order", "select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by round(o_totalprice, -4) desc, coalesce(o_orderstatus, ',') asc nulls first, o_orderkey desc) = 1", [{"rule_type": "deduplicate", "rule_sequence": 1, "source_column": "o_custkey", "rule_expression": "round(o_totalprice, -4) DESC NULLS LAST, coalesce(o_orderstatus, ',') ASC NULLS FIRST, o_orderkey Desc"}, {"rule_type": "select", "rule_sequence": 2, "rule_expression": "o_custkey, o_orderkey"}], "orders", ["o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus"])
_rule("aggregate_commas", "select o_custkey, round(sum(o_totalprice::decimal(18,2)), 2)::double total, count(distinct coalesce(o_orderstatus, 'a,b')) kinds from orders group by 1", [{"rule_type": "aggregate", "rule_sequence": 1, "source_column": "o_custkey", "rule_expression": "round(sum(cast(o_totalprice as decimal(18, 2))), 2) as total, count(distinct coalesce(o_orderstatus, 'a,b')) as kinds"}, {"rule_type": "select", "rule_sequence": 2, "rule_expression": "o_custkey, cast(coalesce(total, 0) as double) as total, kinds"}], "orders", ["o_custkey", "o_totalprice", "o_orderstatus"])
_rule("custom_sql", "select o_orderstatus, count(*) n from orders group by 1", [{"rule_type": "custom_sql", "rule_expression": "select o_orderstatus, count(*) n from {input} group by 1"}], "orders", ["o_orderkey", "o_orderstatus"])
_rule("custom_pyspark", "select o_orderkey + 1 k from orders", [{"rule_type": "custom_pyspark", "options": {"function": lambda df: df.select((F.col("o_orderkey") + 1).alias("k"))}}], "orders", ["o_orderkey"])
_rule("scd1_merge", "select n_nationkey, case when n_nationkey < 5 then 'NEW' else n_name end n_name from nation", [{"rule_type": "filter", "rule_sequence": 1, "rule_expression": "n_nationkey < 5"}, {"rule_type": "derive_column", "rule_sequence": 2, "target_column": "n_name", "rule_expression": "'NEW'"}, {"rule_type": "scd1_merge", "rule_sequence": 3, "options": {"table": "n", "key": "n_nationkey"}}], "nation", ["n_nationkey", "n_name"], lambda s, d: {"n": table(s, d, "nation").select("n_nationkey", "n_name")})


@query(f"select c_sk, c_custkey, bal::varchar c_acctbal, '2024-01-01 00:00:00' effective_from, '{_OPEN}' effective_to, true is_current, false deleted_flag, 'R' updated_run_id from ({_DAY1})")
def rule_engine_scd2_merge(spark, d):
    rule = {"rule_type": "scd2_merge", "options": dict(table="dim", business_key="c_custkey", surrogate_key="c_sk", attributes=["c_acctbal"], run_id="R", batch_timestamp="2024-01-01 06:00:00")}
    out = RuleEngine().apply(_batch(_customers(spark, d, 1), "c_custkey", ["c_acctbal"], "2024-01-01 00:00:00"), [rule], {"dim": spark.createDataFrame([], _DIM)})
    return _times_as_text(out.drop("source_record_hash"))


def _tests_sql(*tests: tuple[str, str, str, str]) -> str:
    """SQL of a suite: (id, measured, operator, expected)."""
    return " union all ".join(f"select '{i}' test_id, ({m})::bigint::varchar actual_value, '{op} ' || ({e})::bigint::varchar expected_value, case when ({m}) {op} ({e}) then 'PASS' else 'FAIL' end test_status" for i, m, op, e in tests)


_SUITE = ["test_id", "actual_value", "expected_value", "test_status"]


@query(_tests_sql(("T1", "select count(*) from (select 1 from orders group by o_orderkey having count(*) > 1)", "=", "0"), ("T2", "select count(*) from orders where o_orderstatus = 'F'", "=", "select count(*) from orders"), ("T3", "select count(*) from orders", ">", "0"), ("T4", "select sum(o_totalprice::decimal(18,2))::bigint from orders", "<=", "100")))
def check_suite(spark, d):
    """Four checks, those on one grouping in one pass."""
    keys = table(spark, d, "orders").groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("p"))
    return quality.run_checks(keys, [
        quality.Check("T1", "keys are unique", F.count_if(F.col("n") > 1)), quality.Check("T2", "all are finished", F.sum("f"), F.sum("n")), quality.Check("T3", "there are some", F.sum("n"), 0, ">"),
        quality.Check("T4", "they are worth little", F.round(F.sum("p"), 0), 100, "<="),
    ]).select(*_SUITE)


_DV = "(select vehicle_id, vehicle_sk, effective_from f, effective_to t, is_current c, deleted_flag x from dim_vehicle)"


@query(_tests_sql(
    ("SCD001", f"select count(*) from (select 1 from {_DV} group by vehicle_id having count(*) filter (c) > 1)", "=", "0"), ("SCD002", f"select count(*) from (select 1 from {_DV} group by vehicle_sk having count(*) > 1)", "=", "0"),
    ("SCD003", f"select count(*) from {_DV} where t < f", "=", "0"), ("SCD004", f"select count(*) from {_DV} where c and t < timestamp '9999-12-31'", "=", "0"), ("SCD005", f"select count(*) from {_DV} where c and x", "=", "0"),
    ("SCD006", f"select count(*) from (select t, lead(f) over (partition by vehicle_id order by f, vehicle_sk) n from {_DV}) where n < t", "=", "0"),
))
def scd2_invariants(spark, d):
    """Of the vehicle dimension as it is, in which much doesn't hold."""
    return quality.scd2_invariants(table(spark, d, "dim_vehicle"), "vehicle_id", "vehicle_sk").select(*_SUITE)


_D2 = "(select c_custkey k, case when c_custkey % 7 = 0 then 1 else 0 end changed from customer where c_custkey % 10 <> 0 union all select c_custkey + 1000000, 0 from customer where c_custkey % 50 = 1)"


@query(_tests_sql(
    ("UT001", f"select count(*) from {_D2}", "=", f"select count(*) from {_D2}"), ("UT002", f"select count(*) from {_D2} where changed = 1", "=", f"select count(*) from {_D2} where changed = 1"), ("UT003", "select count(*) from customer where c_custkey % 10 = 0", "=", "3"),
    *((f"UT00{i}", "0", "=", "0") for i in (4, 5, 6)), ("UT007", f"select count(*) from {_D2} where changed = 1", ">", "0"), ("UT008", "0", "=", "0"), ("UT009", "0", "=", "0"),
    ("UT010", "select case when count(*) = 3 then 0 else 1 end from customer where c_custkey % 10 = 0", "=", "0"),
))
def dimension_tests(spark, d):
    """The customer dimension after two days against its two extracts; three soft deletes are expected, as if nobody had looked."""
    day = lambda i: _batch(_customers(spark, d, i), "c_custkey", ["c_acctbal"], f"2024-01-0{i} 00:00:00")
    return quality.dimension_tests(_dim(spark, d, 2), "c_custkey", day(2), day(1), deleted=3).select(*_SUITE)


_FE = "feature_fuel_anomaly_score"


@query(_tests_sql(
    ("UAT001", f"select count(*) from {_FE}", "=", f"select count(distinct fuel_transaction_id) from {_FE} where fuel_transaction_id is not null"),
    ("UAT002", f"select count(*) from (select 1 from {_FE} group by fuel_transaction_id having count(*) > 1)", "=", "0"), ("UAT003", "0", "=", "0"), ("UAT004", f"select count(*) from {_FE} where fuel_anomaly_score is null or fuel_anomaly_score not between 0 and 100", "=", "0"),
    ("UAT005", f"select count(*) from {_FE} where fuel_anomaly_score > 0 and coalesce(trim(anomaly_reason_codes), '') = ''", "=", "0"), ("UAT006", f"select count(*) from {_FE} where fuel_anomaly_score = 0 and coalesce(trim(anomaly_reason_codes), '') <> ''", "=", "0"),
    ("UAT007", f"select count(*) from {_FE} where fuel_anomaly_score <> least(100, case when high_value_transaction_flag then 30 else 0 end + case when no_usage_match_flag then 25 else 0 end + case when fuel_card_vehicle_mismatch_flag then 30 else 0 end + case when multiple_fill_flag then 15 else 0 end)", "=", "0"),
    ("UAT008", f"select count(*) from {_FE} where (vehicle_sk is null and vehicle_id in (select vehicle_id from dim_vehicle where is_current and vehicle_id is not null)) or (client_sk is null and client_id in (select client_id from dim_client where is_current and client_id is not null))", "=", "0"),
    ("UAT009", f"select count(*) from {_FE} where feature_version is null or scored_at is null or batch_date is null or source_record_hash is null", "=", "0"),
    ("UAT010", f"select count(*) from {_FE} where batch_date <> date '2025-02-01'", "=", "0"), ("UAT011", f"select count(*) from {_FE} where fuel_anomaly_score > 0", ">=", "1"),
))
def feature_tests(spark, d):
    """Of the stored feature table as it is, which isn't free of faults; the check of all the others is left out here."""
    stored = table(spark, d, _FE)
    asked = stored.where("fuel_transaction_id is not null").select("fuel_transaction_id").distinct()
    return quality.feature_tests(stored, asked, table(spark, d, "dim_vehicle"), table(spark, d, "dim_client"), batch_date="2025-02-01").where("test_id <> 'UAT012'").select(*_SUITE)


@query(" union all ".join(f"select 'UAT{i:03d}' test_id, 'PASS' test_status from (select count(*) n from orders) where n > 0" for i in range(1, 13)))
def feature_tests_of_own_scores(spark, d):
    """What this engine scores passes all twelve."""
    return quality.feature_tests(_feature(spark, d), transactions(spark, d, "fuel_card_id"), table(spark, d, "dim_vehicle"), table(spark, d, "dim_client")).select("test_id", "test_status")


@query("""with v as (select *, row_number() over (partition by vehicle_id, effective_at, updated_at, _record_hash order by staged_row_id) > 0 one, count(*) over (partition by vehicle_id, effective_at, updated_at, _record_hash) n from vehicles_ext)
select rule_name, count(*) checked_count, count(*) filter (failed) failed_count from (
  select unnest(['key_filled', 'version_unique', 'times_filled', 'latest_unambiguous', 'client_exists', 'dates_parse']) rule_name,
    unnest([coalesce(trim(vehicle_id), '') = '', n > 1, effective_at is null or updated_at is null, coalesce(_latest_resolution_status = 'ambiguous_same_timestamp', false),
      client_id is not null and client_id not in (select client_id from dim_client where is_current and client_id is not null), false]) failed from v
) group by 1""")
def dq_catalogue(spark, d):
    """The catalogue's rules that apply to the staged vehicles, in one pass after their marks are joined."""
    marked, rules = quality.catalogue_predicates(table(spark, d, "vehicles_ext"), "vehicle_id", parents={"client_id": table(spark, d, "dim_client")})
    return quality.run_rules(marked, rules)


_RULES = {"positive": "c_acctbal >= 0", "named": "c_name is not null", "segment": "c_mktsegment in ('BUILDING', 'MACHINERY', 'FURNITURE')"}


@query("select 'positive' rule_name, count(*) checked_count, count(*) filter (c_acctbal < 0) failed_count from customer union all select 'named', count(*), 0 from customer union all select 'segment', count(*), count(*) filter (c_mktsegment not in ('BUILDING', 'MACHINERY', 'FURNITURE')) from customer")
def dq_rules(spark, d):
    return quality.run_rules(table(spark, d, "customer"), {n: F.expr(e) for n, e in _RULES.items()})


@query("select c_custkey, concat_ws(',', case when c_acctbal < 0 then 'positive' end, case when c_mktsegment not in ('BUILDING', 'MACHINERY', 'FURNITURE') then 'segment' end) failures from customer where c_acctbal < 0 or c_mktsegment not in ('BUILDING', 'MACHINERY', 'FURNITURE')")
def quarantine(spark, d):
    marked = quality.set_status(table(spark, d, "customer"), {n: F.expr(e) for n, e in _RULES.items()})
    return marked.where("_dq_status = 'failed'").select("c_custkey", F.col("_dq_failures").alias("failures"))


@query("select c_custkey, case when c_acctbal >= 100 then c_mktsegment end c_mktsegment from customer where c_acctbal >= 0")
def governance_enforcement(spark, d):
    rules = [
        {"rule_name": "positive", "rule_expression": "c_acctbal >= 0", "enforcement_action": "quarantine"}, {"rule_name": "rich", "rule_expression": "c_acctbal >= 100", "enforcement_action": "mask", "source_column": "c_mktsegment"},
        {"rule_name": "keyed", "rule_expression": "c_custkey is not null", "enforcement_action": "fail_pipeline"}, {"rule_name": "off", "rule_expression": "false", "enforcement_action": "fail_pipeline", "enabled_flag": False},
    ]
    return quality.enforce(table(spark, d, "customer"), rules)[0].select("c_custkey", "c_mktsegment")


@query("select c_custkey, regexp_replace(regexp_replace(regexp_replace(c_name, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') masked, sha256('s' || c_name) token, repeat('*', greatest(length(c_name) - 4, 0)) || right(c_name, 4) partial from customer")
def pii_mask(spark, d):
    c = F.col("c_name")
    return table(spark, d, "customer").select("c_custkey", quality.mask_column(c, "mask").alias("masked"), quality.mask_column(c, "tokenize", "s").alias("token"), quality.mask_column(c, "partial").alias("partial"))


@query()
def profile_columns(spark, d):
    names = ["customer", "orders", "lineitem", "part", "supplier", "events", "vehicles_ext", "dim_vehicle", "documents"]
    out = None
    for n in names:
        one = quality.profile(table(spark, d, n)).withColumn("table_name", F.lit(n))
        out = one if out is None else out.unionByName(one)
    return out


# --- sources, sinks, streams -------------------------------------------------------------------------------------------


@query("select o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') order_date, round(o_totalprice, 2)::decimal(38,2) total_amount from orders")
def delimited_roundtrip(spark, d):
    """Written as CSV, read back by header as text, typed by name."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus", F.to_date("o_orderdate").alias("order_date"), F.round("o_totalprice", 2).cast("decimal(38,2)").alias("total_amount"))
    root = scratch(spark, "csv")
    path = write_target(o.coalesce(1), {"platform": "file", "format": "csv", "path": "orders"}, root)
    part = next(p for p in delimited.Files(spark).list(path) if p.endswith(".csv"))
    back = external.typed(delimited.read_delimited(spark, part, "comma"), {"o_orderkey": "bigint"})
    return back.withColumn("order_date", F.col("order_date").cast("string"))


@query("select count(*) rows_read, count(*) filter (o_orderstatus = '') empty_status from orders")
def csv_to_parquet_convert(spark, d):
    root = scratch(spark, "convert")
    path = write_target(table(spark, d, "orders").select("o_orderkey", "o_orderstatus").coalesce(1), {"platform": "adls", "path": "o"}, root)
    part = next(p for p in delimited.Files(spark).list(path) if p.endswith(".csv"))
    csv_to_parquet(spark, part, f"{root}/p")
    return spark.read.parquet(f"{root}/p").agg(F.count(F.lit(1)).alias("rows_read"), F.count_if(F.col("o_orderstatus") == "").alias("empty_status"))


@query("select event_id from events where ts > timestamp '2024-01-20' and event_type = 'view'")
def incremental_read(spark, d):
    return external.read_incremental(table(spark, d, "events"), "ts", "2024-01-20 00:00:00", "event_type = 'view'").select("event_id")


def _event_files(spark, d, parts: int = 4) -> str:
    """Events in several files, the later ones repeating a third of the rows before."""
    path = scratch(spark, "events")
    e = table(spark, d, "events")
    for i in range(parts):
        e.where((F.col("event_id") % parts == i) | ((F.col("event_id") % (3 * parts) == i - 1) & F.lit(i > 0))).coalesce(1).write.mode("append").parquet(path)
    return path


@query("select event_id, event_type from events")
def stream_append(spark, d):
    """Append-only events from overlapping files, once each."""
    path, target = _event_files(spark, d), VersionedTable(spark, scratch(spark, "fact"))

    def merge(now, batch):
        staged = batch.select("event_id", "event_type", F.lit("b").alias("_batch_date"), F.lit("h").alias("_record_hash"), F.lit(False).alias("_is_exact_duplicate"), F.lit("passed").alias("_dq_status"), F.lit("f").alias("_source_file_name"), F.col("event_id").alias("_source_row_number"))
        return conform.Change(added={"rows": conform.append_only_rows(now(), staged, event_key="event_id", columns=["event_id", "event_type"])})

    first = lambda b: b.sparkSession.createDataFrame([], "event_id bigint, event_type string, event_business_key bigint, source_record_hash string, batch_date string")
    merge_stream(file_stream(spark, path, table(spark, d, "events").schema), target, merge, first, scratch(spark, "cp")).awaitTermination()
    return target.read().select("event_id", "event_type")


@query(_day2_sql("c_custkey % 10 = 0"))
def stream_scd2(spark, d):
    """Two daily snapshots through a stream give the dimension of the batch merges."""
    path, target = scratch(spark, "days"), VersionedTable(spark, scratch(spark, "dim"))
    for day in (1, 2):
        _batch(_customers(spark, d, day), "c_custkey", ["c_acctbal"], f"2024-01-0{day} 00:00:00").coalesce(1).write.mode("append").parquet(path)

    def merge(now, batch):
        at = batch.agg(F.max("updated_at")).first()[0]
        return conform.scd2_change(now(), now(conform.CURRENT), batch, business_key="c_custkey", surrogate_key="c_sk", attributes=["c_acctbal"], run_id="R", batch_timestamp=f"{at[:10]} 06:00:00")

    stream = file_stream(spark, path, spark.read.parquet(path).schema)
    merge_stream(stream, target, merge, lambda b: b.sparkSession.createDataFrame([], _DIM), scratch(spark, "cp")).awaitTermination()
    return _shown(target.read())


@query("select strftime(ts, '%Y-%m-%d') on_day, event_type, count(*) n from events group by all")
def stream_daily_summary(spark, d):
    """Counts per day and type by event-time windows under a watermark; each micro-batch's state replaces the table's rows, where they
    are written by the tasks that hold them."""
    path, target = scratch(spark, "plain"), VersionedTable(spark, scratch(spark, "daily"))
    table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type").coalesce(1).write.parquet(path)
    stream = file_stream(spark, path, spark.read.parquet(path).schema)
    counted = windowed_counts(stream, "ts", ["event_type"])
    write = counted.writeStream.outputMode("complete").foreachBatch(lambda batch, i: target.replace(batch, str(i)))
    write.option("checkpointLocation", scratch(spark, "cp")).trigger(availableNow=True).start().awaitTermination()
    return target.read().select(F.date_format("window_start", "yyyy-MM-dd").alias("on_day"), "event_type", "n")


@query("select c_custkey, batch from (select c_custkey, 2 batch from customer where c_custkey % 2 = 0)")
def versioned_swap(spark, d):
    """A table replaced whole; a repeated batch changes nothing."""
    t = VersionedTable(spark, scratch(spark, "table"))
    c = table(spark, d, "customer").select("c_custkey")
    t.replace(c.withColumn("batch", F.lit(1)), "b1")
    t.replace(t.read().where("c_custkey % 2 = 0").withColumn("batch", F.lit(2)), "b2")
    t.replace(c.withColumn("batch", F.lit(3)), "b2")
    return t.read()
