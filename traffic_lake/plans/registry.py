"""The registered queries: each takes ``(spark, sf_dir)`` and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import operators as O
from ..functions import timeparts as TP
from ..schemas import DERIVED_FIELDS, PROCESSED, conform
from ..session import work_dir
from ..sinks import tables as S
from ..sources import explode_alerts, read_alert_snapshots, read_bronze
from ..streaming import histogram_stream, ingest_stream, processed_stream, progress_log, raw_stream
from . import views
from .views import alerts, table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under its function's name, less the suffix that keeps
    it apart from the operator it shows."""
    _QUERIES[fn.__name__.removesuffix("_table")] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _event_time(df: DataFrame) -> DataFrame:
    """Alerts with their naive UTC publication time; 0 counts as a time."""
    return df.withColumn("event_ts", TP.epoch_ms_to_utc_ntz(F.col("pubMillis")))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = O.with_location_filter(O.with_event_filter(alerts(spark, sf_dir)))
    return TP.with_time_filter(_event_time(flat), "event_ts")


# --- scalar enrichment -------------------------------------------------------


@query
def event_priority(spark, sf_dir):
    return O.with_event_filter(alerts(spark, sf_dir)).select("mongo_id", "pig_event_filter.*")


@query
def geo_zone(spark, sf_dir):
    return O.with_location_filter(alerts(spark, sf_dir)).select("mongo_id", "pig_location_filter.*")


@query
def geo_zone_counts(spark, sf_dir):
    return O.facet_counts(O.with_location_filter(alerts(spark, sf_dir)), ["pig_location_filter.zona"])


@query
def bbox_filter(spark, sf_dir):
    return O.within_bbox(alerts(spark, sf_dir)).select("mongo_id", "x", "y")


@query
def local_publish_time(spark, sf_dir):
    return alerts(spark, sf_dir).select(
        "mongo_id",
        TP.iso_naive(TP.epoch_ms_to_local(F.col("pubMillis"))).alias("pubMillis_santiago"),
    )


@query
def source_timestamp_utc(spark, sf_dir):
    ms = F.col("pubMillis")
    return alerts(spark, sf_dir).select(
        "mongo_id", TP.iso_utc(TP.epoch_ms_to_utc(F.when(ms != 0, ms))).alias("source_timestamp")
    )


@query
def day_part_weekday(spark, sf_dir):
    df = TP.with_time_filter(_event_time(alerts(spark, sf_dir)), "event_ts")
    return df.select("mongo_id", "pig_time_filter.*").withColumn("fecha", F.col("fecha").cast("string"))


@query
def order_local_times(spark, sf_dir):
    """Local times over several years, clock changes included."""
    orders = table(spark, sf_dir, "orders")
    # Spread the midnight dates over the hours of the day.
    utc = F.col("o_orderdate") + F.expr("INTERVAL '1' MINUTE") * (F.col("o_orderkey") % 1440)
    return orders.withColumn("utc", utc).select(
        "o_orderkey",
        TP.iso_with_offset(F.col("utc")).alias("local_iso"),
        TP.day_part(F.col("utc")).alias("categoria_dia"),
        TP.weekday_es(F.col("utc")).alias("dia_semana"),
    )


@query
def comment_times(spark, sf_dir):
    listed = alerts(spark, sf_dir).withColumn("n", views.event_number() % 4).withColumn(
        "comments",
        F.when(
            F.col("n") > 0,
            F.transform(
                F.sequence(F.lit(1), F.col("n").cast("int")),
                lambda k: F.struct(
                    k.alias("k"), (F.col("pubMillis") + 60000 * k).cast("bigint").alias("reportMillis")
                ),
            ),
        ),
    )
    return (
        TP.localize_comments(listed)
        .select("mongo_id", F.explode("comments").alias("c"))
        .select("mongo_id", "c.k", "c.reportMillis", "c.reportMillis_santiago")
    )


# --- projections -------------------------------------------------------------


@query
def document_comment_times(spark, sf_dir):
    """Local times written into the documents themselves, as the streams do: of the alert and of each comment that has a time."""
    listed = F.array(
        F.to_json(F.struct((F.col("pubMillis") + 60_000).alias("reportMillis"), "uuid")),
        F.lit('{"text":"no time"}'),
        F.lit('{"reportMillis":"not a number"}'),
    )
    comments = F.when(views.event_number() % 3 == 0, F.lit('"none"')).otherwise(F.concat(F.lit("["), F.array_join(listed, ","), F.lit("]")))
    doc = F.concat(F.lit('{"pubMillis":'), "pubMillis", F.lit(',"comments":'), comments, F.lit("}"))
    docs = alerts(spark, sf_dir).select("mongo_id", doc.alias("doc")).selectExpr("mongo_id", views.PARSED)
    return O.with_local_times(docs).selectExpr(
        "mongo_id",
        "variant_get(alert, '$.pubMillis_santiago', 'string') AS published",
        "variant_get(alert, '$.comments[0].reportMillis_santiago', 'string') AS reported",
        "variant_get(alert, '$.comments[0].uuid', 'string') AS uuid",
        "variant_get(alert, '$.comments[1].text', 'string') AS text",
        "coalesce(variant_get(alert, '$.comments[1].reportMillis_santiago'), variant_get(alert, '$.comments[2].reportMillis_santiago')) IS NULL AS untimed",
        "try_variant_get(alert, '$.comments', 'string') = 'none' AS no_list",
    )


def _flat_point(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "lat": F.col("location.lat"),
            "lon": F.col("location.lon"),
            "source_timestamp": TP.iso_utc(F.col("source_timestamp")),
            "stamped": F.col("ingestion_timestamp").isNotNull(),
        }
    ).drop("location", "ingestion_timestamp")


@query
def raw_projection(spark, sf_dir):
    return _flat_point(O.flat_to_raw(alerts(spark, sf_dir)))


@query
def raw_documents(spark, sf_dir):
    """The raw projection taken from stored documents."""
    good, _ = O.split_rejects(O.to_raw(views.bronze_view(table(spark, sf_dir, "events"))))
    return _flat_point(good).drop("alert", "warning")


def _flat_groups(df: DataFrame) -> DataFrame:
    return df.select(
        "*", "pig_event_filter.*", "pig_location_filter.*", "pig_time_filter.*"
    ).drop(*DERIVED_FIELDS).withColumn("fecha", F.col("fecha").cast("string"))


@query
def processed_rows(spark, sf_dir):
    given = alerts(spark, sf_dir).drop(*(name for name in views.EXTRA if name not in PROCESSED.names))
    df = O.flat_to_processed(_event_time(given), "event_ts")
    return _flat_groups(_flat_point(df)).drop("event_ts", "snapshot_ts")


@query
def processed_documents(spark, sf_dir):
    """The processed projection taken from stored documents."""
    good, _ = O.split_rejects(
        O.to_processed(views.bronze_view(table(spark, sf_dir, "events")), "source_time")
    )
    return _flat_groups(_flat_point(good)).drop("alert", "warning", "stamped")


KEEP = ("mongo_id", "type", "subtype", "x", "y", "pubMillis", "city", "no_such_field", "reliability")


@query
def keep_list(spark, sf_dir):
    return O.keep_fields(alerts(spark, sf_dir), KEEP)


CASTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("code", T.IntegerType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("flag", T.IntegerType()),
        T.StructField("absent", T.StringType()),
    ]
)


@query
def conform_casts(spark, sf_dir):
    loose = table(spark, sf_dir, "events").selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        "CASE WHEN user_id % 3 = 0 THEN event_type ELSE CAST(user_id AS STRING) END AS code",
        "CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE CAST(user_id AS STRING) END AS amount",
        "event_id * 1000000 AS flag",
        "value",
    )
    return conform(loose, CASTS)


# --- incremental reads -------------------------------------------------------

# The raw target holds what was published before this time.
SYNCED_BEFORE = "TIMESTAMP_NTZ'2024-01-15 00:00:00'"


def _synced(spark, sf_dir) -> DataFrame:
    return views.alerts_view(table(spark, sf_dir, "events").filter(f"ts < {SYNCED_BEFORE}"))


@query
def incremental_read(spark, sf_dir):
    """The next 100 documents after the target's greatest key."""
    df = alerts(spark, sf_dir)
    mark = O.high_water_mark(_synced(spark, sf_dir))
    return O.read_after(df, "mongo_id", mark, 100).select("mongo_id", "type", "pubMillis")


@query
def incremental_backlog(spark, sf_dir):
    """Everything after the mark, on the stored key column."""
    events = table(spark, sf_dir, "events")
    mark = O.high_water_mark(events.filter(f"ts < {SYNCED_BEFORE}"), "event_id")
    return O.read_after(events, "event_id", mark).select("event_id", "event_type")


@query
def resume_mark_raw(spark, sf_dir):
    return alerts(spark, sf_dir).agg(F.max("mongo_id").alias("mark"))


@query
def resume_mark_processed(spark, sf_dir):
    stamped = alerts(spark, sf_dir).withColumnRenamed("snapshot_ts", "ingestion_timestamp")
    return stamped.agg(O.last_ingested("mongo_id", "ingestion_timestamp").alias("mark"))


@query
def recent_sample(spark, sf_dir):
    return O.recent_sample(alerts(spark, sf_dir)).select("mongo_id", "type", "city")


@query
def collection_count(spark, sf_dir):
    return O.document_count(alerts(spark, sf_dir))


@query
def example_fields(spark, sf_dir):
    return O.example_fields(views.documents(spark, sf_dir), key="mongo_id")


# --- quality -----------------------------------------------------------------


@query
def field_exists_counts(spark, sf_dir):
    return O.field_counts(
        views.documents(spark, sf_dir), ["type", "subtype", "props", "location", "comments", "absent"]
    )


@query
def purity_gate_counts(spark, sf_dir):
    return O.field_counts(views.impure_documents(spark, sf_dir), DERIVED_FIELDS)


@query
def purity_row_hits(spark, sf_dir):
    flagged, _ = O.processed_field_hits(views.impure_documents(spark, sf_dir))
    return flagged.drop("alert")


@query
def reject_reasons(spark, sf_dir):
    docs = views.reject_documents(spark, sf_dir)
    return _reasons(docs)


@query
def reject_reasons_nested(spark, sf_dir):
    return _reasons(views.documents(spark, sf_dir))


def _reasons(docs: DataFrame) -> DataFrame:
    """Both outcomes per document, from one scan and one parse."""
    judged = O.to_processed(docs, "source_time").select(
        "mongo_id", "alert", F.col("reject_reason").alias("processed_reason")
    )
    both = O.to_raw(judged, keep=["processed_reason"]).withColumnRenamed("reject_reason", "raw_reason")
    found = both.select(
        F.explode(
            F.filter(
                F.array(
                    F.struct("processed_reason", F.lit(None).cast("string").alias("raw_reason"), "mongo_id"),
                    F.struct(F.lit(None).cast("string").alias("processed_reason"), "raw_reason", "mongo_id"),
                ),
                lambda r: r["processed_reason"].isNotNull() | r["raw_reason"].isNotNull(),
            )
        ).alias("r")
    ).select("r.*")
    return found.groupBy("processed_reason", "raw_reason").agg(
        F.count(F.lit(1)).alias("n"), F.min("mongo_id").alias("first_id"), F.max("mongo_id").alias("last_id")
    )


@query
def dead_letters(spark, sf_dir):
    """The rejected rows themselves."""
    _, bad = O.split_rejects(O.to_processed(views.reject_documents(spark, sf_dir), "source_time"))
    return bad.select("mongo_id", "reject_reason")


# --- profiler ----------------------------------------------------------------


@query
def field_profile(spark, sf_dir):
    profile = O.profile_fields(views.documents(spark, sf_dir), samples=0)
    return O.by_frequency(profile.withColumn("types", F.array_join("types", ",")))


@query
def field_samples(spark, sf_dir):
    return O.field_samples(O.flatten_paths(views.documents(spark, sf_dir)))


@query
def field_report(spark, sf_dir):
    """Statistics and the three samples shown for each path."""
    profile = O.profile_fields(views.documents(spark, sf_dir))
    return O.by_frequency(
        profile.select("path", "n", F.array_join(F.slice("samples", 1, 3), " | ").alias("shown"))
    )


@query
def inspect_recent(spark, sf_dir):
    """Profile and classes of the newest 100 documents."""
    found = O.inspect_fields(views.documents(spark, sf_dir))
    return found.select(
        "path", "category", "keep", "n", F.array_join("types", ",").alias("types"),
        F.array_join("samples", " | ").alias("samples"),
    )


@query
def distinct_paths(spark, sf_dir):
    return O.flatten_paths(views.documents(spark, sf_dir)).agg(F.count_distinct("path").alias("n_paths"))


@query
def field_classes(spark, sf_dir):
    stats = O.field_stats(O.flatten_paths(views.bronze_view(table(spark, sf_dir, "events"))))
    return O.by_category(O.classify_fields(stats.select("path", "n")))


# --- sinks -------------------------------------------------------------------


@query
def latest_snapshot(spark, sf_dir):
    """As of 299 seconds after the newest snapshot: still alive."""
    df = alerts(spark, sf_dir)
    as_of = df.select(F.max("snapshot_ts") + F.expr("INTERVAL '299' SECOND")).scalar()
    return S.latest_snapshot(df, "snapshot_ts", as_of=as_of).select("mongo_id", "type")


@query
def expired_snapshot(spark, sf_dir):
    """What is alive 299 to 301 seconds after the newest snapshot."""
    df = alerts(spark, sf_dir)

    def alive(age: int) -> DataFrame:
        as_of = df.select(F.max("snapshot_ts") + F.expr(f"INTERVAL '{age}' SECOND")).scalar()
        return S.latest_snapshot(df, "snapshot_ts", as_of=as_of).agg(F.lit(age).alias("age"), F.count(F.lit(1)).alias("n"))

    return alive(299).unionByName(alive(300)).unionByName(alive(301))


@query
def kept_snapshot(spark, sf_dir):
    """Each cycle with documents replaces the kept snapshot; the last cycle has none. A reader sees one poll, and none after 300 seconds."""
    land, base = work_dir(spark, "polls"), work_dir(spark, "kept")
    docs = views.alert_json(alerts(spark, sf_dir)).repartitionByRange(4, "snapshot_ts")
    docs.selectExpr(POLL).write.text(land)
    spark.range(1).selectExpr("""'{"fetched_at":"2999-01-01T00:00:00Z","alerts":[]}' AS value""").write.mode("append").text(land)
    ingest_stream(
        spark, land, f"{base}/d", f"{base}/c", snapshot=f"{base}/s", multi_line=False, max_files_per_trigger=1, available_now=True
    ).awaitTermination()

    def alive(age: int) -> DataFrame:
        as_of = alerts(spark, sf_dir).select(F.max("snapshot_ts").cast("timestamp") + F.expr(f"INTERVAL '{age}' SECOND")).scalar()
        return S.read_snapshot(spark, f"{base}/s", as_of=as_of)

    return alive(299).select(
        F.expr("variant_get(alert, '$.uuid', 'string')").alias("uuid"),
        F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched_at"),
        alive(300).select(F.count(F.lit(1))).scalar().alias("expired_n"),
    )


@query
def append_by_day(spark, sf_dir):
    """Append twice, nothing is de-duplicated; a replayed batch counts once."""
    base = work_dir(spark, "append")
    views.bronze_view(table(spark, sf_dir, "events")).write.parquet(f"{base}/source")
    bronze = read_bronze(spark, f"{base}/source")
    for _ in range(2):
        S.append_events(bronze, f"{base}/appended")
        S.append_events(bronze, f"{base}/replayed", batch_id=7)
    days = F.col("ingest_date").cast("string").alias("ingest_date")
    twice = spark.read.parquet(f"{base}/appended").select(days, F.lit("appended").alias("mode"))
    once = spark.read.parquet(f"{base}/replayed").select(days, F.lit("replayed").alias("mode"))
    return O.facet_counts(twice.unionByName(once), ["mode", "ingest_date"])


def _upserted(spark, sf_dir) -> str:
    """One row per uuid, written in two batches of which the second is replayed."""
    out = work_dir(spark, "upsert")
    df = alerts(spark, sf_dir).select("uuid", "mongo_id", "type", "pubMillis")
    newest = S.newest_per_key(df, "uuid", ("mongo_id",))
    S.upsert(newest.withColumn("status", F.lit("first")), out, 0, "uuid")
    changed = newest.filter("type = 'JAM' OR type = 'jam' OR type IS NULL").withColumn("status", F.lit("second"))
    S.upsert(changed, out, 1, "uuid")
    S.upsert(changed, out, 1, "uuid")
    return out


@query
def upsert_last_wins(spark, sf_dir):
    return S.read_current(spark, _upserted(spark, sf_dir), "uuid")


@query
def compacted_target(spark, sf_dir):
    into = work_dir(spark, "compact")
    S.compact(spark, _upserted(spark, sf_dir), into, "uuid")
    return S.read_current(spark, into, "uuid")


@query
def bucketed_target(spark, sf_dir):
    """The first batch compacted into buckets, the second merged into it: what the upserted table gives."""
    base = work_dir(spark, "bucketed")
    df = S.newest_per_key(alerts(spark, sf_dir).select("uuid", "mongo_id", "type", "pubMillis"), "uuid", ("mongo_id",))
    S.upsert(df.withColumn("status", F.lit("first")), f"{base}/t", 0, "uuid")
    name = f"bucketed_{base.rsplit('-', 1)[1]}"
    S.compact_bucketed(spark, f"{base}/t", f"{base}/b", name, "uuid", buckets=8)
    changed = df.filter("type = 'JAM' OR type = 'jam' OR type IS NULL").withColumn("status", F.lit("second"))
    return S.merged(spark, name, changed, "uuid")


@query
def ensure_target_state(spark, sf_dir):
    """The three decisions: nothing there, old structure, right structure."""
    base = work_dir(spark, "target")
    enriched = _enriched(spark, sf_dir)
    steps = []

    def decide() -> str:
        state, path = S.ensure_target(spark, base)
        held = None if state == "create" else spark.read.parquet(f"{base}/v1")
        rows, greatest = (0, "") if held is None else held.agg(F.count(F.lit(1)), F.max("mongo_id")).first()
        steps.append((len(steps) + 1, state, path.rsplit("/", 1)[1], rows, greatest))
        return path

    alerts(spark, sf_dir).write.parquet(decide())
    enriched.write.parquet(decide())
    decide()
    cols = ["step", "state", "version", "v1_rows", "v1_greatest"]
    one = [F.struct(*[F.lit(v).alias(c) for c, v in zip(cols, s)]) for s in steps]
    return spark.range(1).select(F.inline(F.array(*one)))


@query
def rebuilt_target(spark, sf_dir):
    """What readers see before, while and after a target of the old structure is filled again, and when all is well."""
    base = work_dir(spark, "rebuilt")
    steps = []

    def look(step: str) -> None:
        path = S.current_target(spark, base)
        held = spark.read.parquet(path)
        steps.append((step, path.rsplit("/", 1)[1], held.count(), "pig_event_filter" in held.columns))

    def fill(path: str) -> None:
        _enriched(spark, sf_dir).write.parquet(path)
        look("while")

    S.rebuild_target(spark, base, lambda path: alerts(spark, sf_dir).write.parquet(path), [])
    look("before")
    for step in ("after", "again"):
        S.rebuild_target(spark, base, fill)
        look(step)
    cols = ["step", "version", "n", "enriched"]
    one = [F.struct(*[F.lit(v).alias(c) for c, v in zip(cols, s)]) for s in steps]
    return spark.range(1).select(F.inline(F.array(*one)))


@query
def fan_out_counts(spark, sf_dir):
    """Two sinks fed from one computation while a third one fails."""
    base = work_dir(spark, "fan")
    flat = O.with_location_filter(O.with_event_filter(views.alerts_view(views.events(spark, sf_dir))))
    outcome = S.fan_out(
        TP.with_time_filter(_event_time(flat), "event_ts"),
        {
            "events": lambda df: df.select("mongo_id", "pig_event_filter.*").write.parquet(f"{base}/a"),
            "zones": lambda df: df.select("mongo_id", "pig_location_filter.*").write.parquet(f"{base}/b"),
            "broken": lambda df: df.select("no_such_column").write.parquet(f"{base}/c"),
        },
    )
    failed = F.lit(sum(error is not None for error in outcome.values()))
    a = spark.read.parquet(f"{base}/a").select(F.lit("events").alias("sink"))
    b = spark.read.parquet(f"{base}/b").select(F.lit("zones").alias("sink"))
    return O.facet_counts(a.unionByName(b), ["sink"]).withColumn("failed_sinks", failed)


# A landed line of one alert that tells when it was fetched.
POLL = """concat('{"fetched_at":"', date_format(snapshot_ts, "yyyy-MM-dd'T'HH:mm:ss"), 'Z","alerts":[', doc, ']}') AS value"""


# --- streams -----------------------------------------------------------------


def _land(spark, sf_dir) -> str:
    """Alerts as landed envelopes, one per line: 0 to 2 alerts, some lines broken."""
    land = work_dir(spark, "land")
    docs = views.alert_json(views.alerts_view(views.events(spark, sf_dir)))
    n = views.event_number()
    lists = (
        F.when(n % 13 == 0, F.lit('{"alerts":[]}'))
        .when(n % 19 == 0, F.lit('{"users":[]}'))
        .when(n % 23 == 0, F.concat(F.lit('{"alerts":[{"uuid":"'), "uuid"))
        .when(n % 2 == 0, F.concat(F.lit('{"alerts":['), "doc", F.lit(","), "doc", F.lit("]}")))
        .otherwise(F.concat(F.lit('{"alerts":['), "doc", F.lit("]}")))
    )
    docs.select(lists.alias("value")).write.text(land)
    return land


def _ingested(spark, sf_dir) -> tuple[str, str]:
    land, base = _land(spark, sf_dir), work_dir(spark, "ingest")
    out, quarantine = f"{base}/documents", f"{base}/quarantine"
    ingest_stream(
        spark, land, out, f"{base}/checkpoint", quarantine, multi_line=False, available_now=True
    ).awaitTermination()
    return out, quarantine


@query
def snapshot_read(spark, sf_dir):
    """Batch read of landed envelopes."""
    exploded = explode_alerts(read_alert_snapshots(spark, _land(spark, sf_dir), multi_line=False))
    return exploded.selectExpr(
        "variant_get(alert, '$.uuid', 'string') AS uuid",
        "try_variant_get(alert, '$.pubMillis', 'bigint') AS pubMillis",
        "pos",
    )


@query
def snapshot_stream(spark, sf_dir):
    """Landed envelopes through the ingest stream, read back."""
    out, _ = _ingested(spark, sf_dir)
    return read_bronze(spark, out).selectExpr(
        "variant_get(alert, '$.uuid', 'string') AS uuid",
        "variant_get(alert, '$.pubMillis_santiago', 'string') AS pubMillis_santiago",
        "pos",
        "try_variant_get(alert, '$._processed_at', 'timestamp_ntz') IS NOT NULL AS stamped",
    )


@query
def corrupt_quarantine(spark, sf_dir):
    _, quarantine = _ingested(spark, sf_dir)
    return spark.read.parquet(quarantine).select(F.col("_corrupt_record").alias("line"))


def _bronze_stream(spark, sf_dir):
    return views.bronze_view(views.events_stream(spark, sf_dir))


@query
def raw_stream_table(spark, sf_dir):
    base = work_dir(spark, "raw")
    raw_stream(
        _bronze_stream(spark, sf_dir), f"{base}/t", f"{base}/c", available_now=True
    ).awaitTermination()
    return _flat_point(S.read_current(spark, f"{base}/t", partition_by=["key_date"]).drop("key_date"))


@query
def processed_stream_table(spark, sf_dir):
    base = work_dir(spark, "processed")
    processed_stream(
        _bronze_stream(spark, sf_dir), f"{base}/t", f"{base}/c", ts="source_time", available_now=True
    ).awaitTermination()
    current = S.read_current(spark, f"{base}/t", partition_by=["key_date"]).drop("key_date")
    return _flat_groups(_flat_point(current)).drop("alert", "stamped")


def _reject_stream(spark, sf_dir) -> DataFrame:
    return views.reject_documents_view(views.events_stream(spark, sf_dir))


@query
def cycle_metrics(spark, sf_dir):
    """Counters of the enrichment stream, batches added up."""
    base = work_dir(spark, "metrics")
    processed_stream(
        _reject_stream(spark, sf_dir), f"{base}/t", f"{base}/c", f"{base}/r", f"{base}/m", available_now=True
    ).awaitTermination()
    written = spark.read.parquet(f"{base}/t").agg(F.count(F.lit(1)))
    return spark.read.parquet(f"{base}/m").agg(
        *[F.sum(c).alias(c) for c in ("read_n", "converted_n", "exported_n", "failed_n")]
    ).withColumns(
        {
            "stored_n": written.scalar(),
            "dead_letter_n": spark.read.parquet(f"{base}/r").agg(F.count(F.lit(1))).scalar(),
        }
    )


@query
def stream_progress(spark, sf_dir):
    """What Spark reports of the enrichment stream's batches, written as it runs, beside the stream's own counters."""
    base = work_dir(spark, "progress")
    events = views.events(spark, sf_dir)
    docs = views.bronze_view(events)
    docs.repartition(max(6, views.parts_of(events, views.FILE_ROWS)), "mongo_id").write.parquet(f"{base}/d")
    with progress_log(spark, f"{base}/p") as log:
        for name, files in (("few", 2), ("all", None)):
            source = read_bronze(spark, f"{base}/d", True, max_files_per_trigger=files)
            query = raw_stream(source, f"{base}/{name}", f"{base}/c-{name}", metrics=f"{base}/m-{name}", available_now=True)
            query.awaitTermination()
            log.wait(query)
    seen = spark.read.parquet(f"{base}/p")
    own = spark.read.parquet(f"{base}/m-few").unionByName(spark.read.parquet(f"{base}/m-all"))
    return seen.agg(
        F.count_distinct("run").alias("streams"),
        F.sum("input_n").alias("input_n"),
        (F.max("input_n") > F.min("input_n")).alias("bounded"),
        (F.min("trigger_ms") > 0).alias("timed"),
    ).withColumns(
        {
            "read_n": own.select(F.sum("read_n")).scalar(),
            "same_batches": F.lit(0) + own.select(F.count(F.lit(1))).scalar() == seen.select(F.count(F.lit(1))).scalar(),
        }
    )


@query
def gated_stream(spark, sf_dir):
    """The purity gate stops a batch before anything is written; what is clean goes through."""
    base = work_dir(spark, "gate")
    events = views.events_stream(spark, sf_dir)

    def documents(df: DataFrame, clean: bool) -> DataFrame:
        kept = df.filter("event_type <> 'signup'") if clean else df
        return kept.selectExpr(
            "lpad(lower(hex(event_id)), 24, '0') AS mongo_id",
            """parse_json(CASE event_type WHEN 'signup' THEN concat('{"pig_time_filter":', props, '}')
               ELSE '{"type":"JAM","subtype":"x"}' END) AS alert""",
        )

    def pass_through(name: str, clean: bool) -> DataFrame:
        out = f"{base}/{name}/v1"
        stream = processed_stream(documents(events, clean), out, f"{base}/{name}-c", available_now=True)
        try:
            stream.awaitTermination()
            stopped = False
        except Exception:
            stopped = True
        state, _ = S.ensure_target(spark, f"{base}/{name}")
        stored = F.lit(0).cast("long") if state == "create" else S.read_current(spark, out, partition_by=["key_date"]).select(F.count(F.lit(1))).scalar()
        return O.field_counts(documents(table(spark, sf_dir, "events"), clean), ["pig_time_filter"]).select(
            F.lit(name).alias("source"), F.lit(stopped).alias("stopped"), stored.alias("stored_n"), "pig_time_filter"
        )

    return pass_through("dirty", False).unionByName(pass_through("clean", True))


# --- what must not get lost ----------------------------------------------------


def _lines(spark, sf_dir, times: str, envelope: str) -> str:
    """Landed lines of one alert per event, each ``times`` times."""
    land = work_dir(spark, "repeats")
    docs = views.alert_json(views.alerts_view(views.events(spark, sf_dir))).withColumn("number", views.event_number())
    docs.selectExpr(f"{envelope} AS value", f"explode(sequence(1, CAST({times} AS INT))) AS k").select("value").write.text(land)
    return land


@query
def snapshot_repeats(spark, sf_dir):
    """Polls of an unchanged feed are equal lines: each is a document of its own, in all tables."""
    land = _lines(
        spark, sf_dir, "1 + number % 4", """concat('{"alerts":[', doc, ',{"uuid":"other","type":"JAM","type":"HAZARD"}]}')"""
    )
    base = work_dir(spark, "repeats")
    ingest_stream(spark, land, f"{base}/d", f"{base}/c0", multi_line=False, available_now=True).awaitTermination()
    raw_stream(read_bronze(spark, f"{base}/d", True), f"{base}/raw", f"{base}/c1", available_now=True).awaitTermination()
    stored = read_bronze(spark, f"{base}/d").agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_distinct("mongo_id").alias("keys"),
        F.count_if(F.expr("variant_get(alert, '$.type', 'string') = 'HAZARD' AND variant_get(alert, '$.uuid', 'string') = 'other'")).alias("last_value"),
    )
    current = S.read_current(spark, f"{base}/raw", partition_by=["key_date"])
    return stored.withColumn("raw_rows", current.select(F.count(F.lit(1))).scalar())


@query
def snapshot_fetch_time(spark, sf_dir):
    """Envelopes that tell when they were fetched: the newest poll of a compacted history."""
    land = _lines(spark, sf_dir, "1", POLL.removesuffix(" AS value"))
    read = explode_alerts(read_alert_snapshots(spark, land, multi_line=False))
    as_of = alerts(spark, sf_dir).select(F.max("snapshot_ts").cast("timestamp") + F.expr("INTERVAL '10' SECOND")).scalar()
    return S.latest_snapshot(read, as_of=as_of).select(
        F.expr("variant_get(alert, '$.uuid', 'string')").alias("uuid"),
        F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched_at"),
        F.conv(F.substring("mongo_id", 1, 8), 16, 10).cast("long").alias("key_seconds"),
    )


@query
def deep_profile(spark, sf_dir):
    """Documents that nest further than any level given."""
    nested = "concat(repeat('{\"n\":', CAST(1 + event_id % 13 AS INT)), CAST(event_id AS STRING), repeat('}', CAST(1 + event_id % 13 AS INT)))"
    docs = table(spark, sf_dir, "events").selectExpr("CAST(event_id AS STRING) AS mongo_id", f"{nested} AS doc").selectExpr("mongo_id", views.PARSED)
    return O.profile_fields(docs, samples=0).select("path", "n", F.array_join("types", ",").alias("types"))


@query
def long_text_profile(spark, sf_dir):
    """Texts up to 120,000 characters of brackets, quotes and backslashes, at three levels."""
    events = table(spark, sf_dir, "events")
    times = F.when(F.col("event_id") % 500 == 0, 20_000).otherwise((1 + F.col("event_id") % 7).cast("int"))
    text = F.repeat(F.lit('[{"}\\ '), times)
    inner, listed = F.struct(F.reverse(text).alias("note")), F.array(F.struct(text.alias("x")))
    doc = F.to_json(F.struct(text.alias("text"), inner.alias("in"), listed.alias("list")))
    docs = events.select(F.lpad(F.lower(F.hex("event_id")), 24, "0").alias("mongo_id"), doc.alias("doc")).selectExpr("mongo_id", views.PARSED)
    profile = O.profile_fields(docs, samples=2)
    return profile.select("path", "n", F.array_join("types", ",").alias("types"), F.array_join("samples", " | ").alias("samples"))


@query
def rejects_accounted(spark, sf_dir):
    """Stored rows and dead letters are what was read, with default arguments."""
    base = work_dir(spark, "accounted")
    processed_stream(_reject_stream(spark, sf_dir), f"{base}/t", f"{base}/c", ts="source_time", available_now=True).awaitTermination()
    stored = S.read_current(spark, f"{base}/t", partition_by=["key_date"]).select("mongo_id", F.lit(True).alias("stored"))
    dead = spark.read.parquet(f"{base}/t-rejected").select("mongo_id", F.lit(False).alias("stored"))
    return stored.unionByName(dead)


@query
def bounded_stream(spark, sf_dir):
    """Several batches by a bound on each; together they are the whole."""
    base = work_dir(spark, "bounded")
    events = views.events(spark, sf_dir)
    files = max(6, views.parts_of(events, views.FILE_ROWS))
    views.bronze_view(events).repartition(files, "mongo_id").write.parquet(f"{base}/d")
    source = read_bronze(spark, f"{base}/d", True, max_files_per_trigger=2)
    raw_stream(source, f"{base}/t", f"{base}/c", metrics=f"{base}/m", available_now=True).awaitTermination()
    cycles = spark.read.parquet(f"{base}/m").agg(
        (F.count(F.lit(1)) > 1).alias("several"), F.sum("read_n").alias("read_n"), F.sum("exported_n").alias("exported_n")
    )
    return cycles.withColumn(
        "stored_n", S.read_current(spark, f"{base}/t", partition_by=["key_date"]).select(F.count(F.lit(1))).scalar()
    )


@query
def resumed_stream(spark, sf_dir):
    """Half the documents, then with a fresh checkpoint the other half and some of the first again, changed."""
    base = work_dir(spark, "resumed")
    docs = views.bronze_view(views.events(spark, sf_dir))
    number = views.event_number()
    changed = docs.withColumn("alert", F.expr("""parse_json('{"type":"CHANGED","subtype":"x"}')"""))
    docs.filter(number % 2 == 0).write.parquet(f"{base}/first")
    docs.filter(number % 2 == 1).unionByName(changed.filter(number % 10 == 0)).write.parquet(f"{base}/second")
    for part in ("first", "second"):
        raw_stream(read_bronze(spark, f"{base}/{part}", True), f"{base}/t", f"{base}/c-{part}", available_now=True).awaitTermination()
    return S.read_current(spark, f"{base}/t", partition_by=["key_date"]).select("mongo_id", "type")


@query
def batch_repeats(spark, sf_dir):
    """Keys that come up to three times in one batch: the last write wins, also when the documents are dealt otherwise and read again."""
    base = work_dir(spark, "batch")
    events = views.events(spark, sf_dir)
    times, docs = views.parts_of(events, views.FILE_ROWS), views.bronze_view(events)

    def again(every: int, kind: str, pos: int) -> DataFrame:
        changed = {"alert": F.parse_json(F.lit(f'{{"type":"{kind}","subtype":"x"}}')), "pos": F.lit(pos)}
        later = {"fetched_at": F.col("fetched_at") + F.expr("INTERVAL '1' HOUR")}
        return docs.filter(views.event_number() % every == 0).withColumns(changed | later)

    every = again(20, "AGAIN", 1).unionByName(docs).unionByName(again(10, "CHANGED", 0))
    passes = []
    for number, parts in ((1, 5), (2, 2)):
        every.repartition(parts * times, "pos", "mongo_id").write.parquet(f"{base}/d{number}")
        # all files are one batch, whatever their size
        source = read_bronze(spark, f"{base}/d{number}", True, max_files_per_trigger=parts * times)
        raw_stream(source, f"{base}/t", f"{base}/c{number}", available_now=True).awaitTermination()
        current = S.read_current(spark, f"{base}/t", partition_by=["key_date"])
        passes.append(current.select(F.lit(number).alias("pass"), "mongo_id", "type"))
    return passes[0].unionByName(passes[1])


# --- dashboards --------------------------------------------------------------


@query
def facet_counts(spark, sf_dir):
    return O.facet_counts(
        _enriched(spark, sf_dir),
        ["pig_event_filter.prioridad", "pig_location_filter.zona", "pig_time_filter.categoria_dia"],
    )


@query
def facet_top_k(spark, sf_dir):
    return O.facet_counts(
        _enriched(spark, sf_dir), ["pig_event_filter.tipo", "pig_location_filter.zona"], k=10
    )


def _published(df: DataFrame) -> DataFrame:
    return _event_time(df).filter("pubMillis <> 0")


@query
def hourly_histogram(spark, sf_dir):
    return O.date_histogram(_published(alerts(spark, sf_dir)), "event_ts", "1 hour")


@query
def priority_histogram(spark, sf_dir):
    df = O.with_event_filter(_published(alerts(spark, sf_dir))).withColumn(
        "prioridad", F.col("pig_event_filter.prioridad")
    )
    return O.date_histogram(df, "event_ts", "1 day", ["prioridad"])


@query
def histogram_stream_table(spark, sf_dir):
    base = work_dir(spark, "histogram")
    published = _published(views.alerts_view(views.events_stream(spark, sf_dir)))
    histogram_stream(
        published, f"{base}/t", f"{base}/c", "event_ts", "1 hour", available_now=True
    ).awaitTermination()
    return S.read_current(spark, f"{base}/t", "bucket")


@query
def raw_processed_reconcile(spark, sf_dir):
    """Raw keeps what enrichment rejects; the processed side lags behind."""
    docs = views.reject_documents(spark, sf_dir)
    raw, _ = O.split_rejects(O.to_raw(docs))
    processed, _ = O.split_rejects(O.to_processed(docs, "source_time"))
    return O.reconcile(raw, processed)


@query
def reconcile_by_digest(spark, sf_dir):
    """The same as keys tell, where enrichment rejects documents of every day, and where only the last days lag.

    The days have a hundred documents, so the tables are stored by year: a folder per day takes longer to list than its rows to read.
    """
    base = work_dir(spark, "digest")
    docs = views.reject_documents(spark, sf_dir)
    day = F.date_add(F.lit("2024-01-01").cast("date"), (views.event_number() / 100).cast("int")).alias("day")
    raw, _ = O.split_rejects(O.to_raw(docs))
    processed, _ = O.split_rejects(O.to_processed(docs, "source_time"))
    for name, side in (("raw", raw), ("processed", processed)):
        S.upsert(side.select("mongo_id", day).withColumn("year", F.year("day")), f"{base}/{name}", 0, partition_by=["year"])

    def stored(name: str) -> DataFrame:
        return S.read_current(spark, f"{base}/{name}", partition_by=["year"])

    rejects = O.reconcile_by_digest(stored("raw"), stored("processed"), day="day")
    late = stored("raw").filter((views.event_number() < 5000) | (views.event_number() % 7 > 0))
    lag = O.reconcile_by_digest(stored("raw"), late, day="day")
    return rejects.withColumn("source", F.lit("rejects")).unionByName(lag.withColumn("source", F.lit("lag")))


def entry(spark: SparkSession) -> DataFrame:
    return facet_counts(spark, "/root/testdata/sf0.001")
