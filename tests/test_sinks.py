from __future__ import annotations

import threading

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from traffic_lake.session import work_dir
from traffic_lake.sinks import tables as S


@pytest.fixture
def where(spark):
    return work_dir(spark, "test")


def frame(spark, rows):
    return spark.createDataFrame(rows, "mongo_id string, v int")


def pairs(df):
    return sorted((r["mongo_id"], r["v"]) for r in df.collect())


def test_upsert_keeps_the_last_version(spark, where):
    S.upsert(frame(spark, [("a", 1), ("b", 1)]), where, 1)
    S.upsert(frame(spark, [("b", 2), ("c", 2)]), where, 2)
    expected = [("a", 1), ("b", 2), ("c", 2)]
    assert pairs(S.read_current(spark, where)) == expected
    S.upsert(frame(spark, [("b", 2), ("c", 2)]), where, 2)  # replay
    assert spark.read.parquet(where).count() == 4
    assert pairs(S.read_current(spark, where)) == expected
    S.compact(spark, where, where + "-2")
    S.upsert(frame(spark, [("a", 9)]), where + "-2", 3)
    assert pairs(S.read_current(spark, where + "-2")) == [("a", 9), ("b", 2), ("c", 2)]


def test_upsert_of_an_empty_batch_changes_nothing(spark, where):
    S.upsert(frame(spark, [("a", 1)]), where, 1)
    S.upsert(frame(spark, []), where, 2)
    assert pairs(S.read_current(spark, where)) == [("a", 1)]


def test_runs_follow_those_in_the_target(spark, where, monkeypatch):
    S.upsert(frame(spark, [("a", 1)]), f"{where}/t", 0, run_id=10**15)
    assert S.run_number(spark, f"{where}/c1", f"{where}/t") == 10**15 + 1  # the clock is behind
    assert S.run_number(spark, f"{where}/c1", f"{where}/t") == 10**15 + 1
    assert 10**12 < S.run_number(spark, f"{where}/c2", f"{where}/none") < 10**14
    frame(spark, [("a", 1)]).write.parquet(f"{where}/plain")
    assert S.run_number(spark, f"{where}/c3", f"{where}/plain") < 10**14


def test_folders_above_the_table_do_not_count(spark, where):
    path = f"{where}/day=2000-01-01/run_id=7/t"
    dated = frame(spark, [("a", 1), ("b", 1)]).withColumn("day", F.lit("2024-01-01").cast("date"))
    S.upsert(dated, path, 0, partition_by=["day"])
    S.upsert(dated.limit(1).withColumn("v", F.lit(2)), path, 1, partition_by=["day"])
    assert sorted(r["v"] for r in S.read_current(spark, path, partition_by=["day"]).collect()) == [1, 2]
    assert S.run_number(spark, f"{where}/c", path) > 7
    with pytest.raises(ValueError, match="isn't partitioned by"):
        S.read_current(spark, path, partition_by=["nope"])


def snapshot_of(spark, base, as_of, **more):
    df = S.read_snapshot(spark, base, as_of=F.lit(as_of).cast("timestamp"), schema="v int, fetched_at timestamp", **more)
    return sorted(r["v"] for r in df.collect())


def test_kept_snapshot(spark, where, monkeypatch):
    monkeypatch.setattr(S, "SLOTS", 3)

    def poll(*rows):
        return spark.createDataFrame(rows, "v int, at string").select("v", F.col("at").cast("timestamp").alias("fetched_at"))

    assert snapshot_of(spark, where, "2024-01-01 00:00:00") == []
    assert not S.keep_snapshot(poll(), where)
    assert S.keep_snapshot(poll((1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:30"), (3, "2024-01-01 00:00:30")), where)
    assert snapshot_of(spark, where, "2024-01-01 00:01:00") == [2, 3]
    held = S.read_snapshot(spark, where, as_of=F.lit("2024-01-01 00:01:00").cast("timestamp"), schema="v int, fetched_at timestamp")
    assert not S.keep_snapshot(poll(), where)  # an empty cycle
    assert not S.keep_snapshot(poll((9, "2024-01-01 00:00:10")), where)  # a poll that lands late
    assert snapshot_of(spark, where, "2024-01-01 00:05:29") == [2, 3]
    assert snapshot_of(spark, where, "2024-01-01 00:05:30") == [] == snapshot_of(spark, where, "2024-01-01 00:00:29")
    assert snapshot_of(spark, where, "2024-01-01 00:05:30", ttl="301 seconds") == [2, 3]
    for minute in range(1, 8):
        assert S.keep_snapshot(poll((10 + minute, f"2024-01-01 00:0{minute}:00")), where)
        assert snapshot_of(spark, where, f"2024-01-01 00:0{minute}:00") == [10 + minute]
        if minute == 2:
            assert sorted(r["v"] for r in held.collect()) == [2, 3]  # what was resolved stays for some cycles
    assert spark.read.parquet(f"{where}/pointers").count() == 3  # slots are used again
    assert S.keep_snapshot(poll((17, "2024-01-01 00:07:00"), (18, "2024-01-01 00:07:00")), where)  # a replay
    assert snapshot_of(spark, where, "2024-01-01 00:07:00") == [17, 18]


def test_a_slot_that_was_left_half_written_is_passed_over(spark, where):
    def keep(v, at):
        S.keep_snapshot(spark.createDataFrame([(v, at)], "v int, at string").select("v", F.col("at").cast("timestamp").alias("fetched_at")), where)

    keep(1, "2024-01-01 00:00:00")
    keep(2, "2024-01-01 00:00:30")
    spark.range(0).selectExpr("id AS number", "id AS value").write.mode("overwrite").parquet(f"{where}/pointers/slot=1")
    assert snapshot_of(spark, where, "2024-01-01 00:01:00") == [1]
    keep(3, "2024-01-01 00:01:00")
    assert snapshot_of(spark, where, "2024-01-01 00:01:00") == [3]


def test_rebuild_and_switch(spark, where):
    def columns():
        path = S.current_target(spark, where)
        return path and (path.rsplit("/", 1)[1], sorted(spark.read.parquet(path).columns))

    def failing(path):
        frame(spark, [("a", 1)]).write.parquet(path)
        raise OSError("half written")

    assert columns() is None
    assert S.rebuild_target(spark, where, frame(spark, [("a", 1)]).write.parquet, ["v"]) == ("create", f"{where}/v1")
    assert S.rebuild_target(spark, where, failing, ["v"]) == ("ok", f"{where}/v1")
    with pytest.raises(OSError):
        S.rebuild_target(spark, where, failing, ["w"])
    assert columns() == ("v1", ["mongo_id", "v"])  # a failure changes nothing for readers
    seen = []

    def fill(path):
        frame(spark, [("a", 1)]).withColumn("w", F.lit(1)).write.parquet(path)
        seen.append(columns())

    assert S.rebuild_target(spark, where, fill, ["w"]) == ("rebuild", f"{where}/v3")
    assert seen == [("v1", ["mongo_id", "v"])] and columns() == ("v3", ["mongo_id", "v", "w"])


def test_upsert_needs_its_key(spark, where):
    with pytest.raises(ValueError, match="no key column"):
        S.upsert(frame(spark, []), where, 1, "nope")


def test_key_dates_prune_files(spark, where):
    # Keys carry their day in the first eight digits.
    keys = [f"{seconds:08x}" + "0" * 16 for seconds in (0, 86399, 86400, 1718452800)]
    df = frame(spark, [(k, i) for i, k in enumerate(keys)]).withColumn("key_date", S.key_date(F.col("mongo_id")))
    assert [str(r["key_date"]) for r in df.orderBy("v").collect()] == ["1970-01-01", "1970-01-01", "1970-01-02", "2024-06-15"]
    S.upsert(df, where, 1, partition_by=["key_date"])
    S.upsert(df.filter("v = 3").withColumn("v", F.lit(30)), where, 2, partition_by=["key_date"])
    day = S.read_current(spark, where, partition_by=["key_date"]).filter("key_date = '2024-06-15'")
    assert pairs(day) == [(keys[3], 30)]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(key_date" in plan


def test_append_keeps_repeats(spark, where):
    df = spark.sql("SELECT 'u' AS uuid, TIMESTAMP'2024-01-01 23:30:00' AS fetched_at")
    S.append_events(df, where)
    S.append_events(df, where)
    S.append_events(df, where + "-b", batch_id=1)
    S.append_events(df, where + "-b", batch_id=1, rebalance=True)
    S.append_events(df, where + "-b", batch_id=2)
    assert spark.read.parquet(where).count() == 2
    assert spark.read.parquet(where + "-b").count() == 2
    assert str(spark.read.parquet(where).first()["ingest_date"]) == "2024-01-01"


def test_latest_snapshot_and_its_expiry(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, TIMESTAMP'2024-01-01 00:00:00'), (2, TIMESTAMP'2024-01-01 00:04:00'),
        (3, TIMESTAMP'2024-01-01 00:04:00') t(id, fetched_at)""")

    def at(clock):
        return sorted(r["id"] for r in S.latest_snapshot(df, as_of=F.lit(clock).cast("timestamp")).collect())

    assert at("2024-01-01 00:04:00") == [2, 3]
    assert at("2024-01-01 00:08:59") == [2, 3]
    assert at("2024-01-01 00:09:00") == []
    assert at("2024-01-01 00:03:00") == [1]
    alive = S.latest_snapshot(df, as_of=F.lit("2024-01-01 00:00:00").cast("timestamp"))
    assert [r["payload"] for r in S.snapshot_payload(alive).collect()] == ['{"id":1,"fetched_at":"2024-01-01T00:00:00.000Z"}']
    assert S.latest_snapshot(df).count() == 0
    assert S.latest_snapshot(df.withColumn("fetched_at", F.current_timestamp())).count() == 3


def test_ensure_target(spark, where):
    assert S.ensure_target(spark, where) == ("create", f"{where}/v1")
    frame(spark, [("a", 1)]).write.parquet(f"{where}/v1")
    assert S.ensure_target(spark, where, ["v"]) == ("ok", f"{where}/v1")
    assert S.ensure_target(spark, where) == ("rebuild", f"{where}/v2")
    frame(spark, [("a", 1)]).withColumn("pig_event_filter", F.lit(1)).write.parquet(f"{where}/v2")
    assert S.ensure_target(spark, where) == ("ok", f"{where}/v2")
    assert spark.read.parquet(f"{where}/v1").count() == 1


def test_fan_out(spark, where):
    seen = threading.Event()

    def broken(df):
        raise RuntimeError("sink is down")

    def later(df):
        seen.set()
        df.write.parquet(where)

    assert S.fan_out(frame(spark, [("a", 1)]), {"broken": broken, "later": later}) == {
        "broken": "RuntimeError: sink is down", "later": None
    }
    assert seen.is_set() and spark.read.parquet(where).count() == 1


def test_work_dir(spark):
    assert work_dir(spark, "x") != work_dir(spark, "x")
    before = spark.conf.get("spark.checkpoint.dir", None)
    if before:
        assert work_dir(spark, "x").startswith(before)
