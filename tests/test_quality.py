from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from traffic_lake import operators as O
from traffic_lake.schemas import DERIVED_FIELDS, PROCESSED, RAW, conform
from traffic_lake.sinks.tables import check_schema

from .test_enrich import documents


def test_gate(spark):
    clean = documents(spark, [{"type": "JAM"}, {"other": {"pig_time_filter": 1}}, 5])
    O.assert_raw_only(clean)
    dirty = clean.unionByName(documents(spark, [{"pig_time_filter": None}]))
    with pytest.raises(O.RawPurityError, match="'pig_time_filter': 1"):
        O.assert_raw_only(dirty)


def test_row_hits_keep_the_rows(spark):
    flagged, seen = O.processed_field_hits(documents(spark, [{"pig_event_filter": None}, {"a": 1}, {}]))
    assert flagged.count() == 3
    assert seen.get == {"pig_event_filter": 1, "pig_location_filter": 0, "pig_time_filter": 0}
    assert [r["has_pig_event_filter"] for r in flagged.orderBy("mongo_id").collect()] == [True, False, False]


def test_split_and_counters(spark):
    observed, seen = O.observe_cycle(O.to_processed(documents(spark, [{}, {"type": 1}, {"type": "JAM"}])))
    good, bad = O.split_rejects(observed)
    assert (good.count(), bad.count()) == (2, 1)
    assert seen.get == {"read_n": 3, "converted_n": 2, "failed_n": 1}
    assert "reject_reason" not in good.columns


def test_conversions_yield_the_declared_schemas(spark):
    docs = documents(spark, [{"type": "JAM"}])
    assert check_schema(conform(O.to_raw(docs), RAW), RAW) == []
    assert check_schema(conform(O.to_processed(docs), PROCESSED), PROCESSED) == []
    assert set(DERIVED_FIELDS) <= set(PROCESSED.names) and len(RAW) == 28


def test_conform(spark):
    df = spark.createDataFrame([("1", "x", 7, 1)], "a string, b string, c bigint, extra int")
    schema = T.StructType([T.StructField(n, t) for n, t in
                           [("c", T.LongType()), ("a", T.IntegerType()), ("b", T.DoubleType()), ("d", T.DateType())]])
    out = conform(df, schema)
    assert out.schema.names == ["c", "a", "b", "d"] and tuple(out.first()) == (7, 1, None, None)


def test_marks(spark):
    rows = [("a", 1), ("c", 2), ("b", 3), ("d", 3)]
    df = spark.createDataFrame(rows, "mongo_id string, ingestion_timestamp int")
    empty = df.filter("false")
    assert O.high_water_mark(df) == "d" and O.high_water_mark(empty) is None
    assert O.last_ingested_key(df) == "d" and O.last_ingested_key(empty) is None
    assert O.last_ingested_key(df.filter("mongo_id < 'd'")) == "b"
    assert [r["mongo_id"] for r in O.read_after(df, "mongo_id", "a", 2).collect()] == ["b", "c"]
    assert sorted(r["mongo_id"] for r in O.read_after(df, "mongo_id").collect()) == ["a", "b", "c", "d"]
    assert sorted(r["mongo_id"] for r in O.read_after(df, "mongo_id", "b").collect()) == ["c", "d"]
    lazily = O.read_after(df, "mongo_id", df.filter("mongo_id < 'c'").select(F.max("mongo_id")).scalar())
    assert sorted(r["mongo_id"] for r in lazily.collect()) == ["c", "d"]
    assert [r["mongo_id"] for r in O.recent_sample(df, n=2).collect()] == ["d", "c"]
    assert O.recent_sample(df).count() == 4
    assert O.document_count(empty).first()["n"] == 0


def test_reconcile(spark):
    def ids(text):
        return spark.createDataFrame([(c,) for c in text], "mongo_id string")

    row = O.reconcile(ids("aabc"), ids("bcdd")).first()
    assert tuple(row) == (4, 4, 2, 1, 1)
    nothing = spark.createDataFrame([], "mongo_id string")
    assert tuple(O.reconcile(nothing, nothing).first()) == (0, 0, 0, 0, 0)


def test_facets_and_histogram(spark):
    df = spark.sql("""SELECT * FROM VALUES ('a', TIMESTAMP'2024-01-01 00:10:00'), ('b', TIMESTAMP'2024-01-01 00:59:59'),
        ('b', TIMESTAMP'2024-01-01 01:00:00'), (NULL, NULL) t(k, source_timestamp)""")
    assert [tuple(r) for r in O.facet_counts(df, ["k"], k=2).collect()] == [("b", 2), (None, 1)]
    assert O.facet_counts(df, ["k"]).count() == 3
    assert sorted(r["n"] for r in O.date_histogram(df).collect()) == [1, 2]
    assert O.date_histogram(df, width="30 minutes", by=["k"]).count() == 3
