"""What a batch changes, and what it must leave alone."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strataforge.operators import conform, quality
from strataforge.operators.asof import asof_version
from strataforge.operators.rules import RuleEngine
from strataforge.operators.sliced import with_slices
from strataforge.operators.staging import DatasetContract
from strataforge.plans.drivers import new_run_id
from strataforge.schema import METADATA, infer_type_by_name
from strataforge.session import materialise, scratch_tables, shared_dir
from strataforge.sinks.writers import Batches, ConcurrentWrite, VersionedTable
from strataforge.sources import delimited
from strataforge.sources.delimited import Files

DIM = "sk long, k string, v string, business_key string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean, deleted_flag boolean, source_updated_at timestamp_ntz, source_record_hash string, created_run_id string, updated_run_id string, updated_at timestamp_ntz"


def staged(spark, rows, load="full"):
    """Rows of (key, value, latest?)."""
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "k string, v string, _is_latest_for_business_key boolean, _source_row_number int")
    return df.select(
        "*", F.col("v").alias("_record_hash"), F.lit("resolved").alias("_latest_resolution_status"), F.lit(False).alias("_is_exact_duplicate"), F.lit("passed").alias("_dq_status"), F.lit(load).alias("_load_type"),
        F.lit(None).cast("string").alias("_delta_action"), F.lit("2025-01-01").alias("effective_at"), F.lit("2025-01-01").alias("updated_at"), F.lit("f").alias("_source_file_name"), F.lit("b").alias("_batch_date"),
    )


KW = dict(business_key="k", surrogate_key="sk", attributes=["v"], batch_timestamp="2025-02-01 00:00:00")


def test_two_rows_of_a_key_that_may_be_merged_raise(spark):
    empty = spark.createDataFrame([], DIM)
    with pytest.raises(Exception, match="Two rows of k may be merged: a"):
        conform.scd2_merge(empty, staged(spark, [("a", "1", True), ("a", "2", True)]), run_id="R", **KW)
    once = conform.scd2_merge(empty, staged(spark, [("a", "1", True), ("a", "2", False), (None, "3", True), (None, "4", True)]), run_id="R", **KW).collect()
    assert [(r.k, r.v, r.sk, r.business_key, r.created_run_id) for r in once] == [("a", "1", 1, "a", "R")]  # a null key names nobody


def test_a_dimension_writes_only_what_changes(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "dim"))
    for i, rows in enumerate([[("a", "1", True), ("b", "1", True)], [("a", "2", True), ("b", "1", True)], [("a", "2", True)]]):
        now = t.read if t.exists() else lambda *_: spark.createDataFrame([], DIM)
        t.apply(conform.scd2_change(now(), now("current"), staged(spark, rows), run_id=f"R{i}", **KW), f"b{i}")
    whole = spark.createDataFrame([], DIM)
    for i, rows in enumerate([[("a", "1", True), ("b", "1", True)], [("a", "2", True), ("b", "1", True)], [("a", "2", True)]]):
        whole = conform.scd2_merge(whole, staged(spark, rows), run_id=f"R{i}", **KW)
    show = lambda df: sorted(str(tuple(r)) for r in df.collect())
    assert show(t.read()) == show(whole)
    parts = t._pointer()["parts"]
    assert len(parts["closed"]) == 3 and len(parts["current"]) == 1 and t.read("current").count() == 1
    t.compact()
    assert show(t.read()) == show(whole) and len(t._pointer()["parts"]["closed"]) == 1
    t.vacuum()
    assert show(t.read()) == show(whole)


def test_appending_leaves_old_files_alone_and_all_batches_are_known(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "fact"))
    for i in range(5):
        t.append(spark.range(i * 10, i * 10 + 10), str(i))
    files = {p for p in (tmp_path / "fact").rglob("*.parquet")}
    t.append(spark.range(50, 51), "5")
    assert {p for p in (tmp_path / "fact").rglob("*.parquet")} > files and t.read().count() == 51
    t.append(spark.range(0, 10), "0")  # a replay of the first batch
    assert t.read().count() == 51 and all(t.has_batch(str(i)) for i in range(6)) and not t.has_batch("6")


def test_batch_ids_stay_small_however_many():
    b = Batches()
    for i in [*range(0, 5000), 7000, "x", "007", *range(6999, 5000, -1)]:
        b.add(str(i))
    assert b.kept() == {"ranges": [[0, 4999], [5001, 7000]], "names": ["x", "007"]}
    again = Batches(b.kept())
    assert "4999" in again and "5000" not in again and "x" in again and "7" in again and "07" not in again


def test_of_two_writers_one_is_told(spark, tmp_path):
    a, b = (VersionedTable(spark, str(tmp_path / "t")) for _ in range(2))
    a.replace(spark.range(1), "1")
    pointer = b._pointer()
    b._pointer = lambda: pointer  # has read the table before a's next write
    a.append(spark.range(1), "2")
    with pytest.raises(ConcurrentWrite):
        b.append(spark.range(1), "3")
    assert a.read().count() == 2 and not a.has_batch("3")


def test_events_with_null_keys_are_all_added(spark):
    fact = spark.createDataFrame([("a", "a")], "k string, event_business_key string")
    s = staged(spark, [("a", "1", True), (None, "2", True), (None, "3", True), ("b", "4", True), ("b", "5", True)])
    got = conform.append_only_merge(fact, s, event_key="k", columns=["k"])
    assert sorted(str(r.k) for r in got.collect()) == ["None", "None", "a", "b"]


def test_rule_lists_and_orders(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 5, "x"), (2, None, "y"), (2, 3, None)], "k int, v int, s string")
    run = lambda t, e, **o: RuleEngine().apply(df, [{"rule_type": t, "source_column": "k", "rule_expression": e, **o}])
    assert sorted((r.k, r.v) for r in run("deduplicate", "v DESC nulls last").collect()) == [(1, 5), (2, 3)]
    assert sorted((r.k, r.v) for r in run("deduplicate", "coalesce(v, 0), s").collect()) == [(1, 1), (2, None)]
    assert sorted(map(tuple, run("aggregate", "round(sum(v), 2) as s, count(distinct concat(s, ',')) as n").collect())) == [(1, 6, 1), (2, 3, 1)]
    assert run("select", "coalesce(v, 0) as w, 'a,b' as t, array(k, v)[0] as `x,y`").columns == ["w", "t", "x,y"]


def test_enforcement_asks_for_approval_and_counts_once(spark):
    df = spark.createDataFrame([(1,), (None,)], "v int")
    rule = {"rule_name": "v_there", "rule_expression": "v is not null", "enforcement_action": "require_approval"}
    with pytest.raises(quality.ApprovalRequired):
        quality.enforce(df, [rule])
    kept, moved, results = quality.enforce(df, [rule], approved=["v_there"])
    assert (kept.count(), moved.count(), results.first().failed_count) == (2, 0, 1)
    with pytest.raises(ValueError, match="fail_pipeline"):
        quality.enforce(df, [{**rule, "enforcement_action": "fail_pipeline"}], approved=["v_there"])


def test_rule_seeds_and_catalogue(spark):
    yaml = "# seed\ngovernance_rules:\n  - dataset_id: d\n    rule_name: n\n    severity: critical\n    rule_expression: v >= 0\n    enabled_flag: false\n"
    assert quality.load_rules(yaml) == [{"enforcement_action": "fail_pipeline", "dataset_id": "d", "rule_name": "n", "severity": "critical", "rule_expression": "v >= 0", "enabled_flag": False}]
    assert quality.load_rules('[{"rule_name": "a"}]') == [{"enforcement_action": "warn", "rule_name": "a"}]
    rows = [("1", "c", "2025-01-01", "2025-01-01", "h", "x", "-1", "200", "maybe", "resolved"), ("1", "c", "2025-01-01", "2025-01-01", "h", "2025-01-01", "1", "3", "Yes", "resolved"), (None, "z", None, "2025-01-01", "i", None, None, None, None, "ambiguous_same_timestamp")]
    df = spark.createDataFrame(rows, "id string, client_id string, effective_at string, updated_at string, _record_hash string, start_date string, paid_amount string, fix_pct string, on_flag string, _latest_resolution_status string")
    clients = spark.createDataFrame([("c", True), ("z", False)], "client_id string, is_current boolean")
    marked, rules = quality.catalogue_predicates(df, "id", parents={"client_id": clients})
    failed = {r.rule_name: r.failed_count for r in quality.run_rules(marked, rules).collect()}
    assert failed == {"key_filled": 1, "version_unique": 2, "times_filled": 1, "latest_unambiguous": 1, "client_exists": 1, "dates_parse": 1, "money_not_negative": 1, "percentage_in_range": 1, "flags_parse": 1}
    assert marked.count() == 3


def test_a_burst_of_one_hour_is_cut(spark):
    """Ten rows within an hour and one two months later: no slice has much more than its share, and the order is kept."""
    rows = [("hot", dt.datetime(2025, 1, 1, 0, i % 3), i) for i in range(40)] + [("hot", dt.datetime(2025, 3, 1), 99), ("hot", None, 98), ("cold", None, 1)]
    df = spark.createDataFrame(rows, "k string, at timestamp_ntz, i int")
    sliced, cut = with_slices(df, "k", ["at", "i"], 5)
    got = sliced.collect()
    sizes = {}
    for r in got:
        sizes[r.slice] = sizes.get(r.slice, 0) + 1
    assert cut and len(got) == len(rows) and sizes.pop(-1) == 1 and max(sizes.values()) <= 15 and len(sizes) >= 4
    order = sorted((r for r in got if r.k == "hot"), key=lambda r: (r.at is not None, r.at or dt.datetime.min, r.i))
    assert [r.slice for r in order] == sorted(r.slice for r in order)


def test_events_of_one_moment_see_their_version_across_slices(spark):
    r = random.Random(3)
    at = lambda h: dt.datetime(2025, 1, 1) + dt.timedelta(hours=h)
    versions = [("hot", i, at(i // 2), None if i % 5 else at(i // 2 + 1)) for i in range(30)] + [("b", 100, at(3), None)]
    events = [(f"e{i}", r.choice(["hot"] * 9 + ["b", None]), r.choice([at(7)] * 5 + [at(r.randint(-2, 20)), None])) for i in range(300)]
    v = spark.createDataFrame(versions, "entity string, version long, valid_from timestamp_ntz, valid_until timestamp_ntz")
    e = spark.createDataFrame(events, "event_id string, entity string, at timestamp_ntz")
    show = lambda n: sorted(map(tuple, asof_version(e, v, rows_per_bucket=n).collect()))
    assert show(8) == show(100_000)


def test_rows_are_numbered_by_file_wherever_they_are_read(spark, tmp_path):
    for i, n in enumerate([0, 1, 2000, 7]):
        (tmp_path / f"t_{i}.csv").write_text("id,effective_at,updated_at\n" + "".join(f"{j},2025-01-01,2025-01-01\n" for j in range(n)))
    files = [p for p in Files(spark).list(str(tmp_path)) if p.endswith(".csv")]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for multiline in (True, False):
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        try:
            c = DatasetContract("D", "t.csv", "id", ["id", "effective_at", "updated_at"], multiline=multiline)
            rows = delimited.read_source(spark, files, c)
            assert multiline or rows.rdd.getNumPartitions() > 4
            got = {(r._source_file_name, int(r.id), int(r._source_row_number)) for r in rows.collect()}
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert got == {(f"t_{i}.csv", j, j + 2) for i, n in enumerate([0, 1, 2000, 7]) for j in range(n)}


def test_headers_are_read_without_a_job(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿"a, ""x""","b\nc",d\n1,2,3\n'.encode())
    (tmp_path / "b.csv").write_text("only")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text(",".join(f"column_{i:06d}" for i in range(10_000)) + "\n1\n")
    assert [delimited.header(spark, str(tmp_path / f"{n}.csv")) for n in "abc"] == [['a, "x"', "b\nc", "d"], ["only"], []]
    assert len(delimited.header(spark, str(tmp_path / "d.csv"))) == 10_000


def test_scratch_tables_go_when_the_run_is_over(spark):
    def made():
        return {p for p in Files(spark).list(shared_dir(spark)) if "/scratch-test-" in p}

    with scratch_tables():
        materialise(spark.range(3), "scratch-test")
        assert len(made()) == 1
    assert not made()
    assert materialise(spark.range(3), "scratch-test").count() == 3 and len(made()) == 1


def test_names_say_types():
    kinds = {"paid_amount": "decimal(38,2)", "litres": "decimal(38,2)", "start_date": "date", "seen_at": "timestamp_ntz", "on_datetime": "timestamp_ntz", "at": "string", "date": "string", "format": "string"}
    assert {c: infer_type_by_name(c).simpleString() for c in kinds} == kinds
    assert METADATA["md_pipeline_audit_log"]["warning_count"].dataType.simpleString() == "bigint" and METADATA["md_dataset"]["data_owner"].dataType.simpleString() == "string"
    assert new_run_id("2025-01-02T03:04:05Z").startswith("RUN_20250102_030405_")
