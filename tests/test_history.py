import datetime as dt
import random

from pyspark.sql import functions as F

from strataforge.functions.values import until
from strataforge.operators.history import delta_store, entity_history, reconstruct, state_at

OPEN = dt.datetime(9999, 12, 31)
D = lambda n, h=0: dt.datetime(2025, 1, 1, h) + dt.timedelta(days=n)
VERSIONS = "entity string, version_id long, valid_from timestamp_ntz, valid_until timestamp_ntz, record_hash string, colour string"
SNAPSHOTS = "entity string, at timestamp_ntz, rec struct<effective_at: timestamp_ntz, record_hash: string, colour: string>"


def brute(versions, snapshots, days):
    """Row at a time: periods in force, merged; then the snapshots one after another."""
    out = []
    entities = {v[0] for v in versions if v[0]} | {s[0] for s in snapshots}
    for e in entities:
        mine = sorted({v[1]: v for v in versions if v[0] == e and v[2]}.values(), key=lambda v: (v[2], v[1]))
        merged = []
        for i, v in enumerate(mine):
            end = min(v[3], mine[i + 1][2] if i + 1 < len(mine) else OPEN)
            if v[2] >= end:
                continue
            if merged and merged[-1][1] == v[2] and merged[-1][2] == v[4]:
                merged[-1][1] = end
            else:
                merged.append([v[2], end, v[4]])
        rows = {s[1]: s[2] for s in snapshots if s[0] == e}
        for day in days:
            open_ = merged[-1] if merged and merged[-1][1] == OPEN else None
            if day not in rows:
                if open_:
                    open_[1] = day
                continue
            rec = rows[day]
            if rec is None or (open_ and open_[2] == rec[1]):
                continue
            known = [m[0] for m in merged] + [m[1] for m in merged if m[1] != OPEN]
            begin = rec[0] if rec[0] and all(rec[0] > k for k in known) else day
            if open_:
                open_[1] = begin
            merged.append([begin, OPEN, rec[1]])
        out += [(e, *m) for m in merged]
    return sorted(out, key=str)


def run(spark, versions, snapshots, days, every=3, rows_per_slice=1_000_000):
    cal = spark.createDataFrame([(d, days[i + 1] if i + 1 < len(days) else None) for i, d in enumerate(days)], "at timestamp_ntz, next_at timestamp_ntz")
    v = spark.createDataFrame(versions, VERSIONS).withColumn("valid_until", until(F.col("valid_until")))
    h = entity_history(v, spark.createDataFrame(snapshots, SNAPSHOTS), cal, ["record_hash", "colour"], "record_hash", every, rows_per_slice)
    rows = h.collect()
    assert all(r.colour == r.record_hash for r in rows)  # the attributes came through the patches
    return sorted([(r.entity, r.effective_from, r.effective_to, r.record_hash) for r in rows], key=str)


def test_history_against_brute_force(spark):
    r = random.Random(7)
    versions, snapshots = [], []
    days = [D(100 + 7 * i) for i in range(6)]
    for n in range(60):
        e, at = f"E{n}", 0
        for k in range(r.randint(0, 9)):
            at += r.randint(1, 10)
            end = r.choice([OPEN, D(at + r.randint(0, 12))])
            h = r.choice("abc")
            row = (e, n * 100 + k, D(at), end, h, h)
            versions += [row] * r.choice([1, 1, 2])  # repeated
        for day in days:
            kind = r.random()
            if kind < 0.2:
                continue
            h = r.choice("abc")
            eff = r.choice([None, day - dt.timedelta(days=r.randint(1, 90)), day + dt.timedelta(hours=3)])
            snapshots.append((e, day, None if kind < 0.35 else (eff, h, h)))
    want = brute(versions, snapshots, days)
    assert run(spark, versions, snapshots, days) == want
    # The same with entities cut into slices of a few versions.
    assert run(spark, versions, snapshots, days, rows_per_slice=3) == want


def test_empty_sides_and_nulls(spark):
    one = [("A", 1, D(1), OPEN, "x", "x"), (None, 2, D(1), OPEN, "x", "x"), ("B", 3, None, OPEN, "x", "x"), ("C", 4, D(1), OPEN, None, None)]
    assert run(spark, one, [], []) == [("A", D(1), OPEN, "x"), ("C", D(1), OPEN, None)]
    assert run(spark, [], [("A", D(5), (None, "x", "x"))], [D(5)]) == [("A", D(5), OPEN, "x")]
    assert run(spark, [], [], []) == []
    # A null hash is a value: the same null again changes nothing.
    assert run(spark, [], [("A", D(5), (None, None, None)), ("A", D(6), (None, None, None))], [D(5), D(6)]) == [("A", D(5), OPEN, None)]


def test_store_keeps_only_changes_between_checkpoints(spark):
    events = spark.createDataFrame([("A", i, D(i), False, "h" + str(i), "red" if i < 5 else None) for i in range(10)], "entity string, ord int, at timestamp_ntz, is_end boolean, record_hash string, colour string").withColumn("slice", F.lit(-1))
    store = delta_store(events, ["record_hash", "colour"], every=4)
    rows = store.orderBy("seq").collect()
    assert [x.is_checkpoint for x in rows] == [i % 4 == 0 for i in range(10)]
    assert [x.patch.colour is not None for x in rows] == [i % 4 == 0 or i == 5 for i in range(10)]
    back = reconstruct(store, ["record_hash", "colour"]).orderBy("effective_from").collect()
    assert [x.colour for x in back] == ["red"] * 5 + [None] * 5
    assert [x.effective_to for x in back] == [D(i + 1) for i in range(9)] + [OPEN]


def test_state_at_any_time_equals_the_version_valid_then(spark):
    r = random.Random(23)
    events = []
    for e in "ABCDEF":
        ended = True
        for i in range(30):
            ended = not ended and r.random() < 0.2
            events.append((e, i, D(i), ended, None if ended else r.choice(["x", "y", None]), None if ended else r.choice("rgb"), -1))
    store = delta_store(spark.createDataFrame(events, "entity string, ord int, at timestamp_ntz, is_end boolean, record_hash string, colour string, slice int"), ["record_hash", "colour"], every=4)
    versions = reconstruct(store, ["record_hash", "colour"]).collect()
    for n in (-1, 0, 3, 4, 17, 29, 50):
        want = {(v.entity, v.record_hash, v.colour) for v in versions if v.effective_from <= D(n, 5) < v.effective_to}
        assert {tuple(x) for x in state_at(store, ["record_hash", "colour"], F.lit(D(n, 5)).cast("timestamp_ntz")).collect()} == want
