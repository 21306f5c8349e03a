import pytest
from pyspark.sql import functions as F

from strataforge.operators import conform
from strataforge.operators.staging import DatasetContract, stage_rows
from strataforge.plans import sqltext
from strataforge.plans.drivers import run_conform, run_governance
from strataforge.sinks.writers import VersionedTable, empty_clone, reload_table, save_as_table

META = dict(source_system_id="S", run_id="R", ingest_timestamp="t")


def staged(spark, day, rows, columns, contract):
    df = spark.createDataFrame([(*r, "f", i + 2) for i, r in enumerate(rows)], ", ".join(f"{c} string" for c in columns) + ", _source_file_name string, _source_row_number int")
    return stage_rows(df.withColumns({"_source_file_path": F.lit("p"), "_source_file_modified_at": F.lit("m")}), contract, batch_date=day, **META)


CLIENT = DatasetContract("C", "clients", "client_id", ["client_id", "name", "effective_at", "updated_at"])
VEHICLE = DatasetContract("V", "vehicles", "vehicle_id", ["vehicle_id", "client_id", "effective_at", "updated_at"])
EVENT = DatasetContract("E", "events", "event_id", ["event_id", "vehicle_id", "at"], "append_only_event")
CONFIG = {
    "vehicles": {"target_table": "DIM_VEHICLE", "pattern": "current_and_history", "merge_key": "vehicle_id", "attributes": ["client_id"], "surrogate_key": "vehicle_sk", "parents": {"client_id": ("clients", "client_id")}},
    "clients": {"target_table": "DIM_CLIENT", "pattern": "scd2", "merge_key": "client_id", "attributes": ["name"], "surrogate_key": "client_sk"},
    "events": {"target_table": "FACT_EVENT", "pattern": "append", "merge_key": "event_id", "attributes": ["vehicle_id", "at"]},
    "event_days": {"target_table": "SUMMARY", "pattern": "summary", "merge_key": "event_id", "keys": ["vehicle_id"], "event_time": "at"},
}


def batch(spark, day):
    at = f"2025-01-0{day} 00:00:00"
    clients = staged(spark, at[:10], [("c1", "one", at, at)] + ([("c2", "two", at, at)] if day == 1 else []), CLIENT.expected_columns, CLIENT)
    vehicles = staged(spark, at[:10], [("v1", "c1", at, at), ("v2", "c2", at, at), ("v3", "nobody", at, at)], VEHICLE.expected_columns, VEHICLE)
    events = staged(spark, at[:10], [("e1", "v1", at), (f"x{day}", "v1", at), (f"x{day}", "v1", at)], EVENT.expected_columns, EVENT)
    return {"clients": clients, "vehicles": vehicles, "events": events, "event_days": events}


def test_two_days_parents_first_and_repeatable(spark, tmp_path):
    for day in (1, 2, 2):
        events = run_conform(spark, CONFIG, batch(spark, day), str(tmp_path / "out"), str(tmp_path / "audit"), run_id="R", batch_id=f"b{day}", batch_timestamp=f"2025-01-0{day} 06:00:00")
        assert [e.get("error_message") for e in events] == [""] * 4
    read = lambda n: VersionedTable(spark, str(tmp_path / "out" / n)).read()
    clients = {(r.client_id, r.is_current, r.deleted_flag) for r in read("DIM_CLIENT").collect()}
    assert clients == {("c1", False, False), ("c1", True, False), ("c2", False, True)}
    vehicles = {(r.vehicle_id, r.is_current) for r in read("DIM_VEHICLE").collect()}
    assert vehicles == {("v1", False), ("v1", True), ("v2", True)}  # v2's parent is gone, but a gate never deletes; v3 never had one
    assert read("DIM_VEHICLE_HIST").count() == 6
    assert {r.event_id for r in read("FACT_EVENT").collect()} == {"e1", "x1", "x2"}
    assert {(str(r.event_date), r.event_count) for r in read("SUMMARY").collect()} == {("2025-01-01", 2), ("2025-01-02", 2)}


def test_missing_parents_raise_and_failures_are_audited(spark, tmp_path):
    b = batch(spark, 1)
    run = lambda config, staged: run_conform(spark, config, staged, str(tmp_path / "out"), str(tmp_path / "audit"), run_id="R", batch_id="b", batch_timestamp="2025-01-01 06:00:00")
    with pytest.raises(ValueError, match="ring"):
        run(CONFIG, {"vehicles": b["vehicles"]})
    assert run({"clients": {**CONFIG["clients"], "pattern": "odd"}}, b)[0]["error_message"] == "Unknown pattern: odd"


def test_read_only_statements_mean_what_the_operators_do(spark):
    child = spark.createDataFrame([(1, "a"), (2, None), (3, "z"), (4, "b")], "i int, k string")
    parent = spark.createDataFrame([("a", True), ("b", False), ("a", True)], "k string, is_current boolean")
    child.createOrReplaceTempView("t_child"), parent.createOrReplaceTempView("t_parent")
    assert spark.sql(sqltext.orphans("t_child", "t_parent", "k", "k")).collect() == conform.orphans(child, parent, "k", "k").collect()
    b = batch(spark, 1)
    b["events"].createOrReplaceTempView("t_events")
    mine = conform.daily_summary(b["events"], batch_date="2025-01-01", keys=["vehicle_id"], event_time="at").collect()
    assert spark.sql(sqltext.daily_summary("t_events", ["vehicle_id"], "at"), args={"batch_date": "2025-01-01"}).collect() == mine
    b["vehicles"].createOrReplaceTempView("t_vehicles")
    spark.createDataFrame([("c1", True)], "client_id string, is_current boolean").createOrReplaceTempView("t_clients")
    assert [r.vehicle_id for r in spark.sql(sqltext.eligible_source("t_vehicles", {"client_id": ("t_clients", "client_id")})).collect()] == ["v1"]


def test_all_statements_parse(spark):
    parse = spark._jsparkSession.sessionState().sqlParser().parsePlan
    texts = [
        sqltext.external_table("x", "/p", ["a", "gross_amount", "b_date", "c_at"]), sqltext.load_staging("a", "b"), *sqltext.scd2_merge("s", "d", "k", ["a", "b"], {"c": ("p", "pk")}),
        sqltext.append_only_merge("s", "f", "k", ["k", "a"]), sqltext.version_history_merge("s", "h", "k", ["k", "a"]), *sqltext.rebuild_summary("s", "m", ["k"], "at"),
    ]
    for t in texts:
        parse(t.replace(":batch_timestamp", "timestamp '2025-01-01'").replace(":batch_date", "'2025-01-01'"))
    assert "gross_amount decimal(38,2)" in texts[0]


def test_catalog_tables(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, s string")
    save_as_table(df, "t_saved")
    empty_clone(df, "t_clone")
    assert spark.table("t_clone").count() == 0
    for _ in range(2):
        reload_table(df, "t_clone")
    assert spark.table("t_clone").count() == 2
    spark.sql("drop table t_saved"), spark.sql("drop table t_clone")


def test_governance_run(spark):
    df = spark.createDataFrame([(1, "x@y"), (-1, "z")], "i int, mail string")
    checks = spark.createDataFrame([("T", "FAIL")], "test_id string, test_status string")
    out = run_governance(df, [{"rule_name": "pos", "rule_expression": "i > 0", "enforcement_action": "quarantine"}], {"mail": "redact"}, checks)
    assert [tuple(r) for r in out["kept"].collect()] == [(1, "***")] and out["quarantined"].count() == 1 and not out["certification"].first()["certified"]
