import datetime as dt
import time

from pyspark.sql import functions as F

from strataforge.operators.changefeed import as_changes, fold_changes, is_delete, live
from strataforge.sinks.writers import VersionedTable
from strataforge.streaming.feeds import file_stream, merge_stream, refresh_stream, windowed_counts

SCHEMA = "k string, seq int, op string, v string"


def put(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def changes(df):
    return as_changes(df, key=F.col("k"), sequence=[F.col("seq")], deleted=is_delete(F.col("op")), payload={"v": F.col("v")})


def run(spark, path, table, checkpoint):
    stream = file_stream(spark, path, spark.read.parquet(path).schema)
    merge_stream(stream, table, lambda now, batch: fold_changes(now(), changes(batch)), lambda b: changes(b.limit(0)), checkpoint).awaitTermination()


def test_change_feed_by_micro_batches_and_after_a_lost_commit(spark, tmp_path):
    path, table, checkpoint = str(tmp_path / "in"), VersionedTable(spark, str(tmp_path / "state")), str(tmp_path / "cp")
    put(spark, path, [("a", 1, "I", "1"), ("b", 1, "I", "1")])
    put(spark, path, [("a", 3, "D", None), ("b", 2, "U", "2")])
    run(spark, path, table, checkpoint)
    put(spark, path, [("a", 2, "U", "late"), ("c", 1, None, "new"), ("b", 2, "U", "2")])
    run(spark, path, table, checkpoint)
    state = lambda: {tuple(r) for r in live(table.read()).collect()}
    assert state() == {("b", "2"), ("c", "new")}
    # The commit of the last batch is lost, as if the driver had died before writing it: it runs again and changes nothing.
    last = max((tmp_path / "cp/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    number = table._pointer()["number"]
    for p in (last, last.with_name(f".{last.name}.crc")):
        p.unlink(missing_ok=True)
    run(spark, path, table, checkpoint)
    assert state() == {("b", "2"), ("c", "new")} and table._pointer()["number"] == number


def test_derived_table_at_a_target_lag(spark, tmp_path):
    path, table = str(tmp_path / "in"), VersionedTable(spark, str(tmp_path / "derived"))
    put(spark, path, [("a", 1, "I", "1")])
    source = lambda: spark.read.parquet(path)
    q = refresh_stream(file_stream(spark, path, source().schema), table, source, lambda df: df.groupBy("k").count(), str(tmp_path / "cp"), interval="1 second")
    try:
        put(spark, path, [("a", 2, "I", "1"), ("b", 1, "I", "1")])
        until = time.time() + 60
        while time.time() < until and (not table.exists() or table.read().count() < 2):
            time.sleep(0.5)
        assert {tuple(r) for r in table.read().collect()} == {("a", 2), ("b", 1)}
    finally:
        q.stop()


def test_windows_leave_out_what_is_later_than_the_watermark(spark, tmp_path):
    path = str(tmp_path / "in")
    schema = "at timestamp, k string"

    def add(i, *days):
        spark.createDataFrame([(dt.datetime(2025, 1, d, 12), "x") for d in days], schema).coalesce(1).write.parquet(f"{path}/p{i}")

    for i, days in enumerate([(1, 1, 2), (10,), (11,), (1, 10), (20,), (30,), (31,)]):  # the fourth file's 1 January is late
        add(i, *days)
        time.sleep(1.1)  # files are taken in order of their time
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(path)
    out = windowed_counts(stream, "at", ["k"])
    out.writeStream.format("memory").queryName("late_test").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    got = {(r.window_start.day, r.n) for r in spark.table("late_test").collect()}
    assert (1, 2) in got and (2, 1) in got and (10, 2) in got and (1, 3) not in got
