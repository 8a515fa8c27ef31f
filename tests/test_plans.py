"""The plans behind the results: narrow where they should be, pruned, compiled."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from traffic_lake import operators as O
from traffic_lake import sources
from traffic_lake.operators import dashboards
from traffic_lake.plans import queries, registry, views
from traffic_lake.schemas import PROCESSED, conform
from traffic_lake.session import work_dir
from traffic_lake.sinks import tables as S

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bronze(spark):
    path = work_dir(spark, "bronze")
    views.bronze_view(views.table(spark, SF, "events")).write.parquet(path)
    return spark.read.parquet(path)


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


NARROW = [
    "event_priority", "geo_zone", "bbox_filter", "local_publish_time", "source_timestamp_utc", "day_part_weekday",
    "comment_times", "raw_projection", "raw_documents", "processed_rows", "processed_documents", "keep_list",
    "conform_casts", "purity_row_hits", "dead_letters", "incremental_backlog",
]


@pytest.mark.parametrize("name", NARROW)
def test_row_wise_queries_do_not_shuffle(spark, name):
    text = plan(queries()[name](spark, SF))
    assert "Exchange" not in text and "EvalPython" not in text


def test_no_query_uses_python_or_nested_loops(spark):
    for name, query in queries().items():
        if name.endswith("stream") or "stream" in name:
            continue
        text = plan(query(spark, SF))
        assert not re.search("EvalPython|InPandas|CartesianProduct|NestedLoopJoin", text), name


def test_conversions_fit_the_jit(spark, bronze):
    """HotSpot interprets methods over 8000 bytes of code, several times slower."""
    good_raw, _ = O.split_rejects(O.to_raw(bronze))
    good, bad = O.split_rejects(O.to_processed(bronze, "source_time"))
    flat = queries()["processed_rows"](spark, SF)
    table = conform(good, PROCESSED).withColumn("key_date", S.key_date(F.col("mongo_id")))
    for df in (O.to_raw(bronze), good_raw, O.to_processed(bronze), good, bad, flat, table):
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", plan(df, "codegen"))]
        assert sizes and max(sizes) < 8000, sizes


def test_documents_are_extracted_once(spark, bronze):
    good, _ = O.split_rejects(O.to_processed(bronze, "source_time"))
    text = good._jdf.queryExecution().executedPlan().toString()
    assert text.count("try_variant_get(alert") == 1


def test_column_pruning_reaches_the_scan(spark):
    text = plan(queries()["geo_zone_counts"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in text
    assert "HashAggregate" in text


def test_mark_is_pushed_into_the_scan(spark):
    text = plan(queries()["incremental_backlog"](spark, SF))
    assert re.search(r"PushedFilters: \[IsNotNull\(event_id\), GreaterThan\(event_id,\d+\)\]", text)


@pytest.mark.parametrize("name", ["incremental_read", "recent_sample", "facet_top_k", "example_fields"])
def test_limits_use_a_partial_sort(spark, name):
    assert "TakeOrderedAndProject" in plan(queries()[name](spark, SF))


def test_newest_rows_are_found_by_key_alone(spark, bronze):
    text = O.recent_sample(bronze, n=5)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(mongo_id,ScalarSubquery" in text
    assert "ReadSchema: struct<mongo_id:string>" in text


def test_samples_and_versions_are_cut_before_the_shuffle(spark, bronze):
    """A task sends the few newest of each path or key, whatever it holds; values of other rows stay."""
    for df in (O.field_samples(O.flatten_paths(bronze)), O.profile_fields(bronze)):
        text = plan(df, "simple")
        below = text[text.index("Exchange hashpartitioning(path"):]
        assert "partial_collect_top_k" in below and "WindowGroupLimit" not in text
        assert text.count("Exchange hashpartitioning") == 1
        assert not re.search(r"Exchange hashpartitioning\(path[^\n]*value", text)
    ranked = plan(S.newest_per_key(bronze, version=("fetched_at",)), "simple")
    assert ranked.index("WindowGroupLimit") < ranked.index("Exchange") < ranked.rindex("WindowGroupLimit")


def test_profile_reads_the_source_once_per_branch(spark, bronze):
    """One scan of the documents, one of the objects inside them."""
    scans = re.findall(r"FileScan.*ReadSchema: (.*)", plan(O.profile_fields(bronze, samples=3), "simple"))
    assert sum("alert" in s for s in scans) == 1 and sum("prefix" in s for s in scans) == 1


def test_the_plan_does_not_grow_with_depth(spark, bronze):
    deep = bronze.withColumn("alert", F.parse_json(F.concat(F.lit('{"a":') , F.expr("repeat('{\"b\":', 9)"), F.lit("1"), F.expr("repeat('}', 10)"))))
    flat, nested = (plan(O.profile_fields(df), "simple") for df in (bronze, deep))
    assert nested.count("\n") <= flat.count("\n") + 1


def test_snapshot_age_prunes_the_scan(spark):
    path = work_dir(spark, "snap")
    spark.sql("SELECT TIMESTAMP'2024-01-01 00:00:00' AS fetched_at, 1 AS v").write.parquet(path)
    as_of = F.lit("2024-01-01 00:01:00").cast("timestamp")
    df = S.latest_snapshot(spark.read.parquet(path), as_of=as_of)
    assert df.count() == 1
    assert "GreaterThan(fetched_at,2023-12-31 23:56:00" in plan(df)


def test_current_rows_are_not_ranked_with_their_values(spark):
    path, into = work_dir(spark, "current"), work_dir(spark, "compacted")
    df = views.alerts(spark, SF).selectExpr("mongo_id", "type AS wide", "DATE'2024-01-01' AS day")
    S.upsert(df, path, 0, partition_by=["day"])
    once = S.read_current(spark, path, partition_by=["day"])
    assert "Exchange" not in plan(once)
    S.upsert(df.withColumn("wide", F.lit("new")), path, 1, partition_by=["day"])
    S.upsert(df.withColumn("day", F.lit("2024-01-02").cast("date")), path, 2, partition_by=["day"])
    text = plan(S.read_current(spark, path, partition_by=["day"]), "simple")
    for line in text.split("\n"):
        if "partial_max" in line or "partial_count" in line:
            assert "wide" not in line
    S.compact(spark, path, into, partition_by=["day"])
    compacted = S.read_current(spark, into, partition_by=["day"])
    assert "Exchange" not in plan(compacted)
    assert compacted.count() == S.read_current(spark, path, partition_by=["day"]).count()


def test_days_of_one_write_are_never_shuffled(spark):
    """Not even with broadcasts off, as on any large table: only the day that was rewritten moves."""
    path = work_dir(spark, "days")
    df = views.alerts(spark, SF).selectExpr("mongo_id", "type AS wide", "date_add(DATE'2024-01-01', CAST(confidence AS INT)) AS day")
    S.upsert(df, path, 0, partition_by=["day"])
    S.upsert(df.filter("day = '2024-01-03'").withColumn("wide", F.lit("new")), path, 1, partition_by=["day"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        current = S.read_current(spark, path, partition_by=["day"])
        text = plan(current, "simple")
        assert current.count() == df.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    alone, others = re.split(r"\n[ :]*\+- Project[^\n]*\n[ :]*\+- SortMergeJoin", text, maxsplit=1)
    assert "FileScan" in alone and "Exchange" not in alone and "PartitionFilters: [NOT" in alone
    assert "Exchange" in others and all("IN (2024-01-03)" in p or "= 2024-01-03" in p for p in re.findall(r"PartitionFilters: \[([^\]]*)", others))


def test_envelopes_that_do_not_repeat_stay_where_they_are(spark):
    """Digests are counted by hash; of the envelopes only those that repeat move."""
    land = work_dir(spark, "lines")
    lines = views.alert_json(views.alerts(spark, SF)).selectExpr("""concat('{"alerts":[', doc, ']}') AS value""", views.EVENT_NUMBER + " AS n")
    lines.selectExpr("explode(array_repeat(value, IF(n % 9 = 0, 3, 1))) AS value").write.text(land)
    read = sources.read_alert_snapshots(spark, land, multi_line=False)
    documents = sources.explode_alerts(read)
    text = plan(documents, "simple")
    alone, again = text.split("Window", 1)
    assert "SortAggregate" not in text and "LeftAnti" in alone and "LeftSemi" in again
    assert "Exchange hashpartitioning" not in alone
    keys = [r["mongo_id"] for r in documents.collect()]
    assert len(keys) == len(set(keys)) == read.count()
    counts = plan(sources.snapshots._counted(read), "simple")
    assert counts.count("HashAggregate") == 2 and "alerts" not in counts.split("Exchange")[1].split("\n")[0]


def test_a_bucketed_table_is_not_shuffled(spark):
    base = work_dir(spark, "buckets")
    df = views.alerts(spark, SF).select("mongo_id", "type", F.lit("2024-01-01").cast("date").alias("day"))
    S.upsert(df, f"{base}/t", 0, partition_by=["day"])
    name = f"b_{base.rsplit('-', 1)[1]}"
    S.compact_bucketed(spark, f"{base}/t", f"{base}/b", name, partition_by=["day"], buckets=4)
    batch = df.limit(50).withColumn("type", F.lit("NEW"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        current = S.merged(spark, name, batch)
        text = plan(current, "simple")
        assert current.count() == df.count() and current.filter("type = 'NEW'").count() == 50
        grouped = plan(spark.table(name).groupBy("mongo_id").count(), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    table_side = text[text.index("LeftAnti"):].split("Bucketed: true")[0]
    assert "Exchange" not in table_side and "Bucketed: true" in text and "Exchange" not in grouped


def test_keys_of_equal_days_are_not_read(spark):
    base = work_dir(spark, "tree")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (views.event_number() / 100).cast("int")).alias("day")
    df = views.alerts(spark, SF).select("mongo_id", day)
    S.upsert(df, f"{base}/raw", 0, partition_by=["day"])
    S.upsert(df.filter(views.event_number() != 345).unionByName(df.limit(0)), f"{base}/processed", 0, partition_by=["day"])
    raw, processed = (S.read_current(spark, f"{base}/{n}", partition_by=["day"]) for n in ("raw", "processed"))
    found = O.reconcile_by_digest(raw, processed, day="day")
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\].*ReadSchema: struct<mongo_id:string>", plan(found, "simple"))
    assert len(filters) == 2 and all("2024-01-04" in f and f.count("2024-") == 1 for f in filters)
    n = df.count()
    assert found.first().asDict() == {"raw_rows": n, "processed_rows": n - 1, "in_both": n - 1, "only_raw": 1, "only_processed": 0}
    assert O.reconcile_by_digest(raw, raw, day="day").first().asDict() == O.reconcile(raw, raw).first().asDict()
    assert O.reconcile_by_digest(raw, processed.limit(0), day="day").first().asDict() == O.reconcile(raw, processed.limit(0)).first().asDict()
    none = raw.withColumn("day", F.when(views.event_number() % 3 > 0, F.col("day")))
    assert O.reconcile_by_digest(none, none.filter(views.event_number() % 9 > 0), day="day").first().asDict() == O.reconcile(
        none, none.filter(views.event_number() % 9 > 0)).first().asDict()


def test_appends_write_few_files(spark, bronze):
    path = work_dir(spark, "files")
    S.append_events(bronze.repartition(8), path)
    days = spark.read.parquet(path).select("ingest_date").distinct().count()
    assert len(spark.read.parquet(path).inputFiles()) <= 2 * days


def test_many_differing_days_are_joined(spark, monkeypatch):
    monkeypatch.setattr(dashboards, "LISTED_DAYS", 2)
    day = F.date_add(F.lit("2024-01-01").cast("date"), (views.event_number() / 100).cast("int"))
    raw = views.alerts(spark, SF).select("mongo_id", F.when(views.event_number() % 30 > 0, day).alias("day"))
    for left in (views.event_number() % 9 > 0, views.event_number() != 345):
        assert O.reconcile_by_digest(raw, raw.filter(left), day="day").first().asDict() == O.reconcile(raw, raw.filter(left)).first().asDict()
    found = O.reconcile_by_digest(raw, raw.filter(views.event_number() % 9 > 0), day="day")
    assert "day#" not in "".join(re.findall(r"[^\n]* IN \([^\n]*", plan(found, "simple")))


def test_reconciled_days_are_not_a_folder_each(spark, tmp_path, monkeypatch):
    days = []
    monkeypatch.setattr(S, "upsert", lambda df, path, *a, upsert=S.upsert, **k: (days.append(df.select(*k["partition_by"]).distinct().count()), upsert(df, path, *a, **k)))
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.withColumn("event_id", F.col("event_id") * 50).write.parquet(f"{tmp_path}/events.parquet")  # 500 days
    queries()["reconcile_by_digest"](spark, str(tmp_path)).collect()
    assert days == [2, 2]


def test_events_are_dealt_by_rows(spark, tmp_path, monkeypatch):
    """One file is one task as it is read; what is made of it is not."""
    monkeypatch.setattr(views, "PART_ROWS", 100, raising=False)
    parts = []
    monkeypatch.setattr(S, "fan_out", lambda df, sinks, fan_out=S.fan_out: (parts.append(df.rdd.getNumPartitions()), fan_out(df, sinks))[1])
    n = spark.read.parquet(f"{SF}/events.parquet").count()
    assert [r.n for r in queries()["fan_out_counts"](spark, SF).collect()] == [n, n]
    assert parts == [-(-n // 100)]


def test_files_of_a_bounded_stream_grow_in_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(views, "FILE_ROWS", 100, raising=False)
    files = []
    read_bronze = registry.read_bronze

    def read(spark, path, *args, **kwargs):
        files.append(len(spark.read.parquet(path).inputFiles()))
        return read_bronze(spark, path, *args, **kwargs)

    monkeypatch.setattr(registry, "read_bronze", read)
    n = spark.read.parquet(f"{SF}/events.parquet").count()
    got = queries()["bounded_stream"](spark, SF).first()
    assert files == [-(-n // 100)] and (got.several, got.read_n, got.stored_n) == (True, n, n)


def test_a_write_sorts_no_rows_by_partition(spark, bronze, tmp_path):
    day = S.key_date(F.col("mongo_id")).alias("day")
    S.upsert(bronze.select("mongo_id", day), f"{tmp_path}/t", 0, partition_by=["day"])
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 0
    assert spark.read.parquet(f"{tmp_path}/t").count() == bronze.count()
