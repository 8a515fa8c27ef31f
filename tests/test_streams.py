from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from traffic_lake import operators as O
from traffic_lake import sources
from traffic_lake.session import work_dir
from traffic_lake.sinks import tables as S
from traffic_lake.streaming import histogram_stream, ingest_stream, processed_stream, raw_stream

ALERTS = [
    {"uuid": "u1", "type": "ACCIDENT", "city": "Santiago", "location": {"x": -70.65, "y": -33.45},
     "pubMillis": 1718452800123, "comments": [{"reportMillis": 1718452860000, "text": "ok"}, {"text": "no time"}]},
    {"uuid": "u2", "type": None},
    {"uuid": "u3", "location": 5},
]


@pytest.fixture
def land(spark):
    folder = work_dir(spark, "land")
    os.makedirs(folder)

    def put(name, text):
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)

    put("a.json", json.dumps({"alerts": ALERTS}))
    put("b.json", json.dumps({"alerts": []}))
    put("c.json", json.dumps({"users": [1]}))
    put("d.json", "{bad")
    put("e.json", json.dumps({"alerts": [{"uuid": "u1"}, 5], "jams": [1]}, indent=2))
    put("f.json", json.dumps({"alerts": "text"}))
    folder_put = (folder, put)
    return folder_put


def uuids(df):
    return sorted(str(r[0]) for r in df.select(F.expr("try_variant_get(alert, '$.uuid', 'string')")).collect())


def test_batch_read(spark, land):
    folder, _ = land
    snapshots = sources.read_alert_snapshots(spark, folder).persist()
    bronze = sources.explode_alerts(snapshots)
    assert uuids(bronze) == ["None", "u1", "u1", "u2", "u3"]
    keys = [r["mongo_id"] for r in bronze.collect()]
    assert len(set(keys)) == 5 and all(len(k) == 88 and int(k, 16) >= 0 for k in keys)
    assert keys == [r["mongo_id"] for r in sources.explode_alerts(sources.read_alert_snapshots(spark, folder)).collect()]
    bad = {r["file_name"]: r["_corrupt_record"] for r in sources.quarantine_corrupt(snapshots).collect()}
    assert bad == {"d.json": "{bad", "f.json": '{"alerts": "text"}'}
    snapshots.unpersist()


def test_lines_of_one_file_keep_distinct_keys(spark):
    folder = work_dir(spark, "lines")
    os.makedirs(folder)
    with open(f"{folder}/x.json", "w") as f:
        for i in range(50):
            f.write(json.dumps({"alerts": [{"i": i}, {"i": i}]}) + "\n")
    bronze = sources.explode_alerts(sources.read_alert_snapshots(spark, folder, multi_line=False))
    assert bronze.select(F.count_distinct("mongo_id")).first()[0] == 100


def run(stream):
    stream.awaitTermination()


def test_three_streams_end_to_end(spark, land):
    folder, put = land
    base = work_dir(spark, "pipeline")
    copies = []

    def ingest():
        run(ingest_stream(spark, folder, f"{base}/bronze", f"{base}/c0", f"{base}/bad", f"{base}/ingest_m",
                          {"copy": lambda df, i: copies.append(df.count()), "down": lambda df, i: 1 / 0},
                          max_files_per_trigger=4, available_now=True))

    def consume():
        bronze = lambda: sources.read_bronze(spark, f"{base}/bronze", streaming=True, max_files_per_trigger=1)
        run(raw_stream(bronze(), f"{base}/raw", f"{base}/c1", f"{base}/raw_bad", f"{base}/raw_m", available_now=True))
        run(processed_stream(bronze(), f"{base}/done", f"{base}/c2", f"{base}/done_bad", f"{base}/done_m", available_now=True))

    ingest()
    consume()
    counted = spark.read.parquet(f"{base}/ingest_m").agg(
        F.sum("snapshots_n"), F.sum("corrupt_n"), F.sum("alerts_n"), F.max("failed_sinks"), F.bool_or("slow_write"))
    assert tuple(counted.first()) == (6, 2, 5, 1, False)
    bronze = sources.read_bronze(spark, f"{base}/bronze")
    assert uuids(bronze) == ["None", "u1", "u1", "u2", "u3"] and sum(copies) == 5
    assert spark.read.parquet(f"{base}/bad").count() == 2
    first = [json.loads(r["alert"].toJson()) for r in bronze.collect() if "comments" in r["alert"].toJson()][0]
    assert first["pubMillis_santiago"] == "2024-06-15T08:00:00.123000" and "_processed_at" in first
    assert first["comments"][0]["reportMillis_santiago"] == "2024-06-15T08:01:00"

    raw = lambda: S.read_current(spark, f"{base}/raw", partition_by=["key_date"])
    done = lambda: S.read_current(spark, f"{base}/done", partition_by=["key_date"])
    assert sorted(str(r["uuid"]) for r in raw().collect()) == ["u1", "u1", "u2"]
    assert sorted(str(r["uuid"]) for r in done().collect()) == ["u1", "u1", "u3"]
    assert {r["reject_reason"] for r in spark.read.parquet(f"{base}/done_bad").collect()} == {"alert_not_object", "type_not_text"}
    assert {r["reject_reason"] for r in spark.read.parquet(f"{base}/raw_bad").collect()} == {"alert_not_object", "location_not_object"}
    sums = spark.read.parquet(f"{base}/done_m").agg(F.sum("read_n"), F.sum("converted_n"), F.sum("failed_n"), F.bool_or("slow_write")).first()
    assert tuple(sums) == (5, 3, 2, False)

    # Only what is new is read; the same alert seen again is stored again.
    put("g.json", json.dumps({"alerts": [{"uuid": "u1"}]}))
    ingest()
    consume()
    assert bronze.sparkSession.read.parquet(f"{base}/bronze").count() == 6
    assert raw().count() == 4 and done().count() == 4

    # A consumer that starts over from nothing ends at the same table.
    run(raw_stream(sources.read_bronze(spark, f"{base}/bronze", streaming=True), f"{base}/raw", f"{base}/c3", available_now=True))
    assert raw().count() == 4

    batch, _ = O.split_rejects(O.to_raw(sources.read_bronze(spark, f"{base}/bronze")))
    cols = ["mongo_id", "uuid", "type", "location", "source_timestamp"]
    assert sorted(map(str, raw().select(cols).collect())) == sorted(map(str, batch.select(cols).collect()))
    assert tuple(O.reconcile(raw(), done()).first()) == (4, 4, 3, 1, 1)


def test_gate_stops_the_batch_and_keeps_the_offsets(spark):
    base = work_dir(spark, "gate")
    docs = [("1", '{"type":"JAM"}'), ("2", '{"pig_event_filter":null}')]
    spark.createDataFrame(docs, "mongo_id string, doc string").write.parquet(f"{base}/in")

    def stream(forbidden):
        source = spark.readStream.schema("mongo_id string, doc string").parquet(f"{base}/in")
        docs = source.select("mongo_id", F.parse_json("doc").alias("alert"))
        return processed_stream(docs, f"{base}/out", f"{base}/c", forbidden=forbidden, available_now=True)

    with pytest.raises(Exception, match="derived fields found"):
        run(stream(["pig_event_filter"]))
    assert not os.path.exists(f"{base}/out")
    run(stream([]))
    assert spark.read.parquet(f"{base}/out").count() == 2


def test_histogram_adds_up_over_batches(spark):
    base = work_dir(spark, "histogram")
    hour = F.timestamp_seconds(F.col("id") * 600)
    spark.range(30).select(hour.alias("source_timestamp")).repartition(3).write.parquet(f"{base}/in")
    source = spark.readStream.schema("source_timestamp timestamp").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    run(histogram_stream(source, f"{base}/out", f"{base}/c", available_now=True))
    rows = S.read_current(spark, f"{base}/out", "bucket").orderBy("bucket").collect()
    assert [r["n"] for r in rows] == [6, 6, 6, 6, 6]


def test_replay_after_a_failed_write_stores_nothing_twice(spark, monkeypatch):
    from traffic_lake.streaming import pipelines

    base = work_dir(spark, "replay")
    docs = [(f"{i:024x}", '{"type":"JAM"}' if i % 3 else '{"type":1}') for i in range(9)]
    spark.createDataFrame(docs, "mongo_id string, doc string").repartition(3).write.parquet(f"{base}/in")
    real, calls = pipelines.upsert, []

    def fails_after_writing_once(*args, **kwargs):
        real(*args, **kwargs)
        calls.append(1)
        if len(calls) == 2:
            raise OSError("lost after the write")

    monkeypatch.setattr(pipelines, "upsert", fails_after_writing_once)

    def stream():
        source = spark.readStream.schema("mongo_id string, doc string").option("maxFilesPerTrigger", 1)
        docs = source.parquet(f"{base}/in").select("mongo_id", F.parse_json("doc").alias("alert"))
        run(processed_stream(docs, f"{base}/out", f"{base}/c", f"{base}/bad", f"{base}/m", available_now=True))

    with pytest.raises(Exception, match="lost after the write"):
        stream()
    stream()
    assert spark.read.parquet(f"{base}/out").count() == 6
    assert spark.read.parquet(f"{base}/bad").count() == 3
    assert spark.read.parquet(f"{base}/m").agg(F.sum("read_n")).first()[0] == 9


def test_histogram_with_a_watermark(spark):
    base = work_dir(spark, "watermark")
    spark.range(30).select(F.timestamp_seconds(F.col("id") * 600).alias("source_timestamp")).write.parquet(f"{base}/in")
    source = spark.readStream.schema("source_timestamp timestamp").parquet(f"{base}/in")
    run(histogram_stream(source, f"{base}/out", f"{base}/c", watermark="1 day", available_now=True))
    assert S.read_current(spark, f"{base}/out", "bucket").agg(F.sum("n")).first()[0] == 30


def test_command_line(spark, land, capsys):
    from traffic_lake.__main__ import main

    folder, _ = land
    lake = work_dir(spark, "lake")
    main(["ingest", "--lake", lake, "--land", folder, "--once"])
    for _ in range(2):
        main(["raw", "--lake", lake, "--once", "--files", "1"])
        main(["processed", "--lake", lake, "--once"])
    assert spark.read.parquet(f"{lake}/raw/v1").count() == 3
    assert spark.read.parquet(f"{lake}/processed/v1").count() == 3
    assert spark.read.parquet(f"{lake}/rejected/raw-v1").count() == 2
    main(["inspect", "--lake", lake])
    assert "comments[0].reportMillis_santiago" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["ingest", "--lake", lake])


def test_equal_envelopes_and_repeated_keys(spark):
    folder = work_dir(spark, "equal")
    os.makedirs(folder)
    line = '{"fetched_at":"2024-05-01T10:00:00Z","alerts":[{"uuid":"u1","type":"JAM","type":"HAZARD"},{"uuid":"u2"}]}'
    for name in ("a", "b"):
        with open(f"{folder}/{name}.json", "w") as f:
            f.write("\n".join([line] * 4 + ["", '{"fetched_at":1714557600000,"alerts":[{"uuid":"u3"}]}']))
    read = lambda: sources.explode_alerts(sources.read_alert_snapshots(spark, folder, multi_line=False))
    rows = read().selectExpr("mongo_id", "CAST(fetched_at AS STRING) AS at", "variant_get(alert, '$.type', 'string') AS type").collect()
    assert len(rows) == len({r["mongo_id"] for r in rows}) == 18
    assert {r["at"] for r in rows} == {"2024-05-01 10:00:00"} and {r["type"] for r in rows} == {"HAZARD", None}
    assert {r["mongo_id"] for r in read().collect()} == {r["mongo_id"] for r in rows}


def test_keys_of_one_second(spark):
    """Millions of envelopes of one second: no two share a key."""
    many = spark.range(3_000_000).select(
        sources.alert_key(F.timestamp_seconds(F.lit(1714557600)), F.sha2(F.col("id").cast("string"), 256), F.lit(0), F.lit(0)).alias("k")
    )
    assert many.agg(F.count_distinct("k")).first()[0] == 3_000_000


def test_late_files_are_read(spark):
    base = work_dir(spark, "late")
    os.makedirs(f"{base}/land")

    def land(name, at):
        with open(f"{base}/land/{name}.json", "w") as f:
            f.write(json.dumps({"alerts": [{"uuid": name}]}))
        os.utime(f"{base}/land/{name}.json", (at, at))

    for name, at in (("new", 1714557600), ("old", 1714557600 - 40 * 86400)):
        land(name, at)
        run(ingest_stream(spark, f"{base}/land", f"{base}/d", f"{base}/c", available_now=True))
    assert uuids(sources.read_bronze(spark, f"{base}/d")) == ["new", "old"]


def test_exports_are_counted_where_they_are_written(spark, monkeypatch):
    from traffic_lake.streaming import pipelines

    base = work_dir(spark, "exports")
    docs = [(f"{i:024x}", json.dumps({"type": "JAM", "subtype": "x"})) for i in range(10)]
    spark.createDataFrame(docs, "mongo_id string, doc string").selectExpr(
        "mongo_id", "timestamp_seconds(0) AS fetched_at", "'f' AS file_name", "0 AS pos", "parse_json(doc) AS alert"
    ).write.parquet(f"{base}/d")
    whole = pipelines.conform
    monkeypatch.setattr(pipelines, "conform", lambda df, schema: whole(df, schema).filter("mongo_id > '000000000000000000000003'"))
    run(raw_stream(sources.read_bronze(spark, f"{base}/d", True), f"{base}/t", f"{base}/c", metrics=f"{base}/m", available_now=True))
    row = spark.read.parquet(f"{base}/m").first()
    assert (row["converted_n"], row["exported_n"]) == (10, 6)


def test_fresh_checkpoint_is_a_later_run(spark):
    base = work_dir(spark, "runs")

    def store(number, rows):
        spark.createDataFrame(rows, "mongo_id string, doc string").selectExpr(
            "mongo_id", "timestamp_seconds(0) AS fetched_at", "'f' AS file_name", "0 AS pos", "parse_json(doc) AS alert"
        ).coalesce(1).write.parquet(f"{base}/d{number}")
        run(raw_stream(sources.read_bronze(spark, f"{base}/d{number}", True), f"{base}/t", f"{base}/c{number}", available_now=True))

    store(1, [(f"{i:024x}", '{"uuid":"first"}') for i in range(6)] + [("0" * 24, '{"uuid":"first"}')])
    store(2, [(f"{9:024x}", '{"uuid":"second"}'), (f"{1:024x}", '{"uuid":"second"}')])
    current = S.read_current(spark, f"{base}/t", partition_by=["key_date"])
    assert sorted(r["uuid"] for r in current.collect()) == ["first"] * 5 + ["second"] * 2


def test_batches_are_bounded_by_bytes_unless_told_otherwise(spark, monkeypatch):
    base = work_dir(spark, "bytes")
    docs = spark.sql("""SELECT lpad(hex(id), 24, '0') AS mongo_id, TIMESTAMP'2024-01-01 00:00:00' AS fetched_at, 'f' AS file_name, 0 AS pos,
        parse_json(concat('{"type":"JAM","subtype":"', repeat(CAST(id AS STRING), 50), '"}')) AS alert FROM range(400)""")
    docs.repartition(8).write.parquet(f"{base}/d")
    size = sum(os.path.getsize(f"{base}/d/{f}") for f in os.listdir(f"{base}/d") if f.endswith(".parquet"))
    monkeypatch.setattr(sources.snapshots, "BYTES_PER_TRIGGER", size // 3)
    raw_stream(sources.read_bronze(spark, f"{base}/d", True), f"{base}/t", f"{base}/c", metrics=f"{base}/m", available_now=True).awaitTermination()
    read = [r["read_n"] for r in spark.read.parquet(f"{base}/m").collect()]
    assert 2 <= len(read) <= 8 and sum(read) == 400 and max(read) < 250


def test_a_batch_is_kept_on_disk_not_in_memory(spark, monkeypatch):
    from traffic_lake.streaming import pipelines

    base, levels, whole = work_dir(spark, "kept"), [], pipelines.fan_out
    spark.sql("SELECT lpad(hex(id), 24, '0') AS mongo_id, parse_json('{\"type\":\"JAM\"}') AS alert FROM range(20)").write.parquet(f"{base}/d")

    def seen(df, sinks):
        levels.append(df.storageLevel)
        assert int(df.sparkSession.conf.get("spark.sql.inMemoryColumnarStorage.batchSize")) == pipelines.KEPT_ROWS
        return whole(df, sinks)

    monkeypatch.setattr(pipelines, "fan_out", seen)
    docs = spark.readStream.schema("mongo_id string, alert variant").parquet(f"{base}/d")
    run(raw_stream(docs, f"{base}/t", f"{base}/c", available_now=True))
    assert [(level.useDisk, level.useMemory) for level in levels] == [(True, False)]
    assert spark.read.parquet(f"{base}/t").count() == 20
