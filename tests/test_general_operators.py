import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strataforge.functions.values import filled_id, is_true
from strataforge.operators.asof import asof_version
from strataforge.operators.changefeed import as_changes, fold_changes, is_delete, live
from strataforge.operators.ids import ordered_ids
from strataforge.operators.references import orphan_references
from strataforge.operators.rolling import rolling_totals
from strataforge.operators.snapdiff import diff_snapshots, snapshot_calendar, snapshot_records

T = lambda n: dt.datetime(2025, 1, 1) + dt.timedelta(hours=n)
EVENTS, VERSIONS = "event_id string, entity string, at timestamp_ntz, version long", "entity string, version long, valid_from timestamp_ntz, valid_until timestamp_ntz, event_id string"


@pytest.mark.parametrize("rows_per_bucket", [100_000, 20])
def test_asof_against_brute_force(spark, rows_per_bucket):
    r = random.Random(3)
    versions = [(e, i, T(r.randint(0, 900)), r.choice([None, T(r.randint(0, 1200))]), "clash") for i, e in enumerate(["hot"] * 60 + [f"e{k}" for k in range(15) for _ in range(4)])]
    events = [(f"x{i}", r.choice(["hot"] * 10 + [f"e{k}" for k in range(16)] + [None]), r.choice([None] + [T(r.randint(-10, 1000)) for _ in range(9)]), 1) for i in range(300)]
    by_begin = {}
    for e, v, a, b, _ in versions:  # of versions that begin together the highest counts
        by_begin[e, a] = max(by_begin.get((e, a), (-1, None)), (v, b), key=lambda p: p[0])
    want = {}
    for x, e, at, _ in events:
        past = [a for (k, a) in by_begin if k == e and at and a <= at]
        v, b = by_begin[e, max(past)] if past else (None, None)
        want[x] = v if past and (b is None or at < b) else None
    got = asof_version(spark.createDataFrame(events, EVENTS), spark.createDataFrame(versions, VERSIONS), rows_per_bucket=rows_per_bucket).collect()
    assert len(got) == len(events)
    assert {g.event_id: g.version for g in got} == want


def test_asof_empty_sides(spark):
    e, v = spark.createDataFrame([("a", "E", T(1), 1)], EVENTS), spark.createDataFrame([("E", 1, T(0), None, "x")], VERSIONS)
    assert [tuple(r) for r in asof_version(e, v.limit(0)).collect()] == [("a", None)]
    assert asof_version(e.limit(0), v).collect() == []
    assert [tuple(r) for r in asof_version(e, v).collect()] == [("a", 1)]


FEED = "k string, seq timestamp_ntz, seq2 int, op string, v string, change string"


def _state(spark, *feeds):
    def one(rows):
        df = spark.createDataFrame(rows, FEED)
        return as_changes(df, key=F.col("k"), sequence=[F.col("seq"), F.col("seq2")], deleted=is_delete(F.col("op")), payload={"v": F.col("v")})

    return fold_changes(*[one(f) for f in feeds])


def test_changes_fold_in_any_order(spark):
    rows = [("a", T(1), 1, "I", "1", "z"), ("a", T(3), None, " delete", None, "z"), ("a", T(2), 1, "u", "2", "z"), ("b", T(5), 1, None, "5", "z"), ("b", None, 9, "D", "9", "z"), ("b", T(5), 2, "", "6", "z"), (None, T(1), 1, "I", "0", "z"), ("c", T(1), 1, "D", None, "z"), ("d", T(1), None, "X", None, "z")]
    want = {("b", "6"), ("d", None)}
    whole = _state(spark, rows)
    assert {tuple(r) for r in live(whole).collect()} == want
    shuffled = rows + rows[::-1]
    random.Random(1).shuffle(shuffled)
    assert {tuple(r) for r in live(_state(spark, shuffled[:7], shuffled[7:])).collect()} == want
    # The tombstone of c stays in the state, so an older insert that comes late doesn't revive it.
    late = as_changes(spark.createDataFrame([("c", T(0), 1, "I", "old", "z")], FEED), key=F.col("k"), sequence=[F.col("seq"), F.col("seq2")], deleted=is_delete(F.col("op")), payload={"v": F.col("v")})
    assert {tuple(r) for r in live(fold_changes(whole, late)).collect()} == want
    assert live(_state(spark, [])).collect() == []


def _diff(spark, rows):
    df = spark.createDataFrame(rows, "k string, b date, latest boolean, h string, i int, n int")
    calendar = snapshot_calendar(df, "b")
    rec = snapshot_records(df, calendar, key=F.col("k"), batch="b", is_record=is_true(F.col("latest")), record_hash=F.col("h"), order=[F.col("i")])
    return {(str(r.b), r.key, r.change_kind) for r in diff_snapshots(rec, calendar, "b").collect()}


def test_snapshot_diff(spark):
    d = [dt.date(2025, 1, x) for x in (1, 5, 9, 20)]
    rows = [
        ("a", d[0], True, "x", 1, 0), ("a", d[1], True, "y", 1, 0), ("a", d[2], False, "z", 1, 0), ("a", d[3], True, "x", 1, 0),  # carried over the third
        ("b", d[0], True, "x", 1, 0), ("b", d[2], None, "x", 1, 0), ("b", d[3], True, "x", 1, 0),  # rows but no record after an absence: none
        ("c", d[1], True, None, 1, 0), ("c", d[2], True, None, 1, 0), ("c", d[3], True, "q", 2, 0), ("c", d[3], True, "p", 1, 0),
        (None, d[0], True, "x", 1, 0), ("e", None, True, "x", 1, 0),
    ]
    want = {("2025-01-05", "a", "changed"), ("2025-01-20", "a", "changed"), ("2025-01-05", "b", "removed"), ("2025-01-20", "b", "added"), ("2025-01-05", "c", "added"), ("2025-01-20", "c", "changed"), ("2025-01-20", "x", "")} - {("2025-01-20", "x", "")}
    got = _diff(spark, rows)
    assert got == want
    assert _diff(spark, rows + rows) == want
    assert _diff(spark, []) == set()


def test_rolling_against_brute_force(spark):
    r = random.Random(5)
    day0 = dt.date(2025, 3, 1)
    rows = [(r.choice(["a", " A ", "b", None, "n/a"]), r.choice([None] + [day0 + dt.timedelta(days=r.randint(0, 40)) for _ in range(6)]), r.choice([None, 5, 10, -3]), 1) for _ in range(80)]
    df = spark.createDataFrame(rows, "c string, d date, a int, n int")
    got = rolling_totals(df, entity=filled_id(F.col("c")), day=F.col("d"), amount=F.col("a").cast("decimal(18,2)"), last_day="2025-03-31", periods=(7, 30)).collect()
    last = dt.date(2025, 3, 31)
    want = {}
    for e in "AB":
        mine = [(d, a or 0) for c, d, a, _ in rows if c and c.strip().upper() == e and d and d <= last]
        first = min(d for d, _ in mine)
        for k in range((last - first).days + 1):
            on = first + dt.timedelta(days=k)
            for p in (7, 30):
                inside = [a for d, a in mine if on - dt.timedelta(days=p) < d <= on]
                want[e, on, p] = (sum(inside), len(inside))
    assert {(g.entity, g.on_date, p): (int(g[f"total_{p}"]), g[f"n_{p}"]) for g in got for p in (7, 30)} == want
    assert rolling_totals(df.limit(0), entity=F.col("c"), day=F.col("d"), amount=F.col("a").cast("decimal(18,2)"), last_day="2025-03-31").collect() == []


@pytest.mark.parametrize("rows_per_task", [200_000, 5])
def test_orphans_against_brute_force(spark, rows_per_task):
    r = random.Random(9)
    parents = [(r.choice(["p", "q", "r", None]), T(a), T(a + r.randint(1, 50)), "x") for a in range(0, 200, 20)]
    children = [(str(i), r.choice(["p"] * 5 + ["q", "r", "none", None]), r.choice([None] + [T(r.randint(-5, 230)) for _ in range(8)]), "x") for i in range(150)]
    children += children[:10]
    c = spark.createDataFrame(children, "record_key string, ref_key string, at timestamp_ntz, valid_from string")
    p = spark.createDataFrame(parents, "ref_key string, valid_from timestamp_ntz, valid_until timestamp_ntz, at string")
    want = sorted(k for k, ref, at, _ in children if ref and not any(pk == ref and at and a <= at < b for pk, a, b, _ in parents))
    assert sorted(x.record_key for x in orphan_references(c, p, rows_per_task).collect()) == want
    assert orphan_references(c.limit(0), p).count() == 0
    assert orphan_references(c, p.limit(0)).count() == sum(1 for x in children if x[1])


def test_ordered_ids(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("k"))
    rows = ordered_ids(df, ["k"], "sk", 11).orderBy("k").collect()
    assert [r.sk for r in rows] == list(range(11, 5011))
    assert ordered_ids(df.limit(0), ["k"], "sk").count() == 0
