import random

import pytest
from pyspark.sql import functions as F

from strataforge.operators import conform, features, quality
from strataforge.operators.rules import RuleEngine
from strataforge.operators.staging import DatasetContract, eligible, rejects, stage_rows

C = DatasetContract("D", "clients.csv", "id", ["id", "v", "effective_at", "updated_at"])
SRC = "id string, v string, effective_at string, updated_at string, _source_file_name string, _source_row_number int"
META = dict(source_system_id="S", run_id="R", batch_date="2025-01-01", ingest_timestamp="t")


def stage(spark, rows, contract=C, **kw):
    df = spark.createDataFrame(rows, SRC).withColumns({"_source_file_path": F.lit("p"), "_source_file_modified_at": F.lit("m"), "clash": F.lit(1)})
    return stage_rows(df, contract, **META, **kw)


def naive(rows):
    """Row at a time, from the description."""
    seen, out = set(), {}
    for i, row in enumerate(sorted(rows, key=lambda r: (r[4], r[5]))):
        fact = tuple(x or "" for x in row[:4])
        out[row[4], row[5]] = [fact, fact in seen, False, "pending"]
        seen.add(fact)
    for key in {r[0] for r in rows}:
        mine = [(k, s) for k, s in out.items() if s[0][0] == (key or "") and not s[1]]
        mine.sort(key=lambda p: (p[1][0][3], p[1][0][2], p[0][0], p[0][1]), reverse=True)
        top = [s for _, s in mine if s[0][2:] == mine[0][1][0][2:]]
        if len({s[0] for s in top}) > 1:
            for s in top:
                s[3] = "ambiguous_same_timestamp"
            continue
        for _, s in mine:
            s[3] = "resolved"
        mine[0][1][2] = True
    return {k: tuple(s[1:]) for k, s in out.items()}


def test_staging_against_naive_model(spark):
    r = random.Random(11)
    rows = [(f"k{r.randint(0, 60)}", r.choice("abc"), f"2025-01-0{r.randint(1, 2)}", f"2025-01-0{r.randint(1, 3)}", r.choice(["f1", "f2"]), i) for i in range(800)]
    got = {(x._source_file_name, x._source_row_number): (x._is_exact_duplicate, x._is_latest_for_business_key, x._latest_resolution_status) for x in stage(spark, rows).collect()}
    assert got == naive(rows)
    spread = stage(spark, rows, rows_per_key=5)
    assert {(x._source_file_name, x._source_row_number): (x._is_exact_duplicate, x._is_latest_for_business_key, x._latest_resolution_status) for x in spread.collect()} == got


def test_ambiguity_quarantines_both_rows_and_blocks_merge(spark):
    s = stage(spark, [("1", "a", "e", "u", "f", 2), ("1", "b", "e", "u", "f", 3), ("2", "a", "e", "u", "f", 4)])
    assert rejects(s).count() == 2
    assert [x.id for x in eligible(s).collect()] == ["2"]


def test_null_values_and_empty_table(spark):
    assert stage(spark, []).count() == 0
    got = stage(spark, [("1", None, None, None, "f", 2), ("1", "", "", "", "f", 3)]).orderBy("_source_row_number").collect()
    assert [x._is_exact_duplicate for x in got] == [False, True]  # a null is an empty value


DIM = "sk bigint, id string, v string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean, deleted_flag boolean, source_record_hash string, updated_run_id string"
KW = dict(business_key="id", surrogate_key="sk", attributes=["v"], run_id="R")


def test_scd2_sequence_against_naive_model(spark):
    r = random.Random(13)
    dim = spark.createDataFrame([], DIM)
    model, next_sk, times = [], 1, {}
    for day in range(1, 5):
        at, full = f"2025-01-0{day} 00:00:00", day != 3
        state = {f"k{i}": r.choice("ab") for i in range(25) if r.random() < (0.8 if full else 0.3)}
        for k, v in state.items():  # an unchanged record keeps its times, which are part of its hash
            if times.get(k, ("",))[0] != v:
                times[k] = (v, at)
        rows = [(k, v, times[k][1], times[k][1], "f", i + 2) for i, (k, v) in enumerate(state.items())]
        ambiguous = {k for k in list(state)[:2]}
        rows += [(k, "other", times[k][1], times[k][1], "g", i + 2) for i, k in enumerate(ambiguous)]
        staged = stage(spark, rows, load_type="full" if full else "delta")
        stamp = f"2025-01-0{day} 06:00:00"
        dim = conform.scd2_merge(dim, staged, batch_timestamp=stamp, **KW)
        again = conform.scd2_merge(dim, staged, batch_timestamp=stamp, **KW)
        current = {m["id"]: m for m in model if m["cur"]}
        for k in sorted(set(state) - ambiguous):
            since = times[k][1]
            if k in current and (current[k]["v"], current[k]["frm"]) == (state[k], since):
                continue
            if k in current:
                current[k].update(cur=False, to=since)
            model.append(dict(sk=next_sk, id=k, v=state[k], frm=since, to="9999-12-31 00:00:00", cur=True, gone=False))
            next_sk += 1
        if full:
            for k, m in current.items():
                if k not in state:
                    m.update(cur=False, to=stamp, gone=True)
        shown = lambda d: sorted((x.sk, x.id, x.v, str(x.effective_from), str(x.effective_to), x.is_current, x.deleted_flag) for x in d.collect())
        got = shown(dim)
        assert got == sorted((m["sk"], m["id"], m["v"], m["frm"], m["to"], m["cur"], m["gone"]) for m in model)
        assert shown(again) == got  # the same batch again changes nothing
        dim = spark.createDataFrame(dim.collect(), DIM)
    assert {x.test_status for x in quality.scd2_invariants(dim, "id", "sk").collect()} == {"PASS"}


def test_unknown_missing_policy_raises(spark):
    with pytest.raises(ValueError, match="missing"):
        conform.scd2_merge(spark.createDataFrame([], DIM), stage(spark, []), batch_timestamp="2025-01-01", missing="drop", **KW)


def test_null_effective_time_closes_at_batch_time(spark):
    first = conform.scd2_merge(spark.createDataFrame([], DIM), stage(spark, [("1", "a", "2025-01-01", "u", "f", 2)]), batch_timestamp="2025-01-01", **KW)
    staged = stage(spark, [("1", "b", None, "u2", "f", 2)])
    out = conform.scd2_merge(first, staged, batch_timestamp="2025-01-09 06:00:00", **KW).where("not is_current").first()
    assert str(out.effective_to) == "2025-01-09 06:00:00"


def test_history_merge_matches_null_times(spark):
    s = spark.createDataFrame([("1", None, "h", "U")], "id string, updated_at string, _record_hash string, _delta_action string")
    empty = spark.createDataFrame([], "id string, event_business_key string, source_updated_at string, source_record_hash string, delta_action string")
    once = conform.version_history_merge(empty, s, business_key="id", columns=["id"])
    assert conform.version_history_merge(once, s, business_key="id", columns=["id"]).count() == 1


def test_enforcement_raises_and_unknown_rules(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    with pytest.raises(ValueError, match="b_there: fail_pipeline"):
        quality.enforce(df, [{"rule_name": "b_there", "rule_expression": "b is not null", "enforcement_action": "fail_pipeline"}])
    with pytest.raises(ValueError, match="Unknown enforcement_action"):
        quality.enforce(df, [{"rule_name": "x", "rule_expression": "true", "enforcement_action": "explode"}])
    with pytest.raises(ValueError, match="Unknown rule_type"):
        RuleEngine().apply(df, [{"rule_type": "nonsense"}])
    assert quality.enforce(df, [])[0].count() == 1


def test_dq_predicates(spark):
    df = spark.createDataFrame([("5", "yes", "2025-01-01"), ("-1", "maybe", "x"), (None, None, None)], "n string, b string, d string").withColumn("i", F.col("n").cast("int"))
    rules = {"nn": quality.not_null("n"), "neg": quality.non_negative("i"), "rng": quality.in_range("i", 0, 100), "date": quality.parses_as("d", "date"), "bool": quality.boolean_token("b")}
    assert {r.rule_name: r.failed_count for r in quality.run_rules(df, rules).collect()} == {"nn": 1, "neg": 1, "rng": 1, "date": 1, "bool": 1}
    assert quality.run_rules(df.limit(0), rules).where("failed_count > 0").count() == 0


def test_card_windows_are_the_same_for_hot_cards(spark):
    import datetime as dt

    r = random.Random(17)
    day = lambda: r.choice([None] + [dt.datetime(2025, 1, 1) + dt.timedelta(hours=12 * r.randint(0, 60))] * 9)
    df = spark.createDataFrame([(i, r.choice(["hot"] * 5 + ["a", "b", "once" if i == 3 else "a", None]), day(), r.choice([None, 1.0, 5.0, 9.0])) for i in range(300)], "i int, card string, at timestamp_ntz, amount double")
    shown = lambda d: sorted((x.i, x.transaction_frequency_7d, round(x.avg_amount or -1, 9), round(x.std_amount or -1, 9)) for x in d.collect())
    assert shown(features.card_windows(df, "card", "at", "amount", rows_per_card=3)) == shown(features.card_windows(df, "card", "at", "amount"))


def test_dimension_from_history_is_the_same_in_slices(spark):
    import datetime as dt

    r = random.Random(19)
    at = lambda: r.choice([None] + [dt.datetime(2025, 1, 1) + dt.timedelta(hours=r.randint(0, 400))] * 9)
    rows = [(r.choice(["hot"] * 6 + ["a", "b", None]), i, at(), r.choice(["x", "y", None])) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, i int, effective_at timestamp_ntz, _record_hash string")
    kw = dict(business_key="k", surrogate_key="sk", attributes=["i"], order=["effective_at", "i"])
    shown = lambda d: sorted((str(tuple(x)) for x in d.collect()))
    plain = conform.scd2_from_history(df, **kw)
    assert shown(conform.scd2_from_history(df, rows_per_slice=4, **kw)) == shown(plain)
    assert plain.where("is_current").count() == 4
    assert conform.scd2_from_history(df.limit(0), **kw).count() == 0
