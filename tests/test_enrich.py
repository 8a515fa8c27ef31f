"""Golden rows: values worked out by hand from the rules."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from traffic_lake import operators as O
from traffic_lake.functions import alerts as A
from traffic_lake.functions import timeparts as TP

SPOT = {"x": -70.6, "y": -33.5}

# (document, tipo, subtipo, prioridad, ciudad, zona) or (document, reject reason)
PROCESSED = [
    ({"type": "ACCIDENT", "subtype": "ACCIDENT_MAJOR", "city": "Santiago", "location": {"x": -70.60, "y": -33.45}},
     "ACCIDENT", "ACCIDENT_MAJOR", "ALTA", "Santiago", "Santiago-Centro-Centro"),
    ({}, "", "", "BAJA", "UNKNOWN", "UNKNOWN"),
    ({"type": None}, "type_not_text"),
    ({"type": 7}, "type_not_text"),
    ({"type": "JAM", "subtype": None}, "subtype_not_text"),
    ({"type": "weatherhazard", "city": "chile", "location": {"x": -70.55, "y": -33.42}},
     "WEATHERHAZARD", "", "ALTA", "chile", "Santiago-Centro-Centro"),
    ({"type": "JAM", "city": "Santiago", "location": {"x": -70.681, "y": -33.419}},
     "JAM", "", "BAJA", "Santiago", "Santiago-Norte-Oeste"),
    ({"type": "JAM", "city": "Santiago", "location": {"x": -70.549, "y": -33.581}},
     "JAM", "", "BAJA", "Santiago", "Santiago-Sur-Este"),
    ({"type": "JAM", "city": "Santiago", "location": {"x": -70.68, "y": -33.58}},
     "JAM", "", "BAJA", "Santiago", "Santiago-Centro-Centro"),
    ({"type": "JAM", "location": SPOT}, "JAM", "", "BAJA", "UNKNOWN", "UNKNOWN-Nearby"),
    ({"type": "JAM", "city": None, "location": SPOT}, "city_not_text"),
    ({"type": "JAM", "city": None}, "JAM", "", "BAJA", None, "UNKNOWN"),
    ({"type": "JAM", "city": "Maipú", "location": {"x": None, "y": None}},
     "JAM", "", "BAJA", "Maipú", "Maipú-Nearby"),
    ({"type": "JAM", "city": "Santiago", "location": {"x": None, "y": -33.5}}, "coordinates_not_numeric"),
    ({"type": "JAM", "city": "Santiago", "location": {"x": "-70.6", "y": -33.5}}, "coordinates_not_numeric"),
    ({"type": "JAM", "city": "Santiago", "location": "Plaza"}, "JAM", "", "BAJA", "Santiago", "UNKNOWN"),
    ({"type": "JAM", "city": "Santiago", "location": {"x": -70.6}}, "JAM", "", "BAJA", "Santiago", "UNKNOWN"),
    ({"type": "JAM", "city": "", "location": SPOT}, "JAM", "", "BAJA", "", "-Nearby"),
    ({"type": "JAM", "city": "Santiago, RM", "location": SPOT},
     "JAM", "", "BAJA", "Santiago, RM", "Santiago, RM-Nearby"),
    ({"type": "JAM", "city": "Santiago", "location": {"x": True, "y": False}},
     "JAM", "", "BAJA", "Santiago", "Santiago-Norte-Este"),
    ({"type": "straße", "city": "SANTIAGO", "location": SPOT},
     "STRASSE", "", "BAJA", "SANTIAGO", "Santiago-Centro-Centro"),
    (5, "alert_not_object"),
    (None, "alert_not_object"),
    (["JAM"], "alert_not_object"),
]


def documents(spark, docs):
    rows = [(f"{i:024x}", json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "mongo_id string, doc string").select(
        "mongo_id", F.parse_json("doc").alias("alert")
    )


def by_order(df):
    return sorted(df.collect(), key=lambda r: r["mongo_id"])


def test_processed_golden_rows(spark):
    rows = by_order(O.to_processed(documents(spark, [p[0] for p in PROCESSED])))
    assert len(rows) == len(PROCESSED)
    for (doc, *expected), row in zip(PROCESSED, rows):
        if len(expected) == 1:
            assert row["reject_reason"] == expected[0], doc
        else:
            event, place = row["pig_event_filter"], row["pig_location_filter"]
            found = (event["tipo"], event["subtipo"], event["prioridad"], place["ciudad"], place["zona"])
            assert row["reject_reason"] is None and found == tuple(expected), doc


def test_processed_document_passes_through(spark):
    doc = {"type": "JAM", "nThumbsUp": 3, "other": {"deep": [1, None]}}
    row = O.to_processed(documents(spark, [doc])).first()
    assert json.loads(row["alert"].toJson()) == doc
    assert row["nThumbsUp"] == 3


RAW = [
    ({"location": {"x": "-70.6", "y": "-33.5"}}, (-33.5, -70.6), None),
    ({"location": {"x": " 1_0.5 ", "y": True}}, (1.0, 10.5), None),
    ({"location": {"x": "abc", "y": 1}}, None, None),
    ({"location": {"x": "1.5d", "y": 1}}, None, None),
    ({"location": {"x": "true", "y": 1}}, None, None),
    ({"location": {"x": None, "y": 1}}, None, None),
    ({"location": {"x": {}, "y": 1}}, None, None),
    ({"location": {"x": 1}}, None, None),
    ({"location": {}}, None, None),
    ({"location": None}, None, None),
    ({"location": "Plaza xy"}, None, None),
    ({"location": ["x", "y"]}, None, None),
    ({"location": 0}, None, None),
    ({"location": False}, None, None),
    ({"location": 5}, None, "location_not_object"),
    ({"location": True}, None, "location_not_object"),
    ({"location": -0.5}, None, "location_not_object"),
    ("text", None, "alert_not_object"),
]


def test_raw_golden_rows(spark):
    rows = by_order(O.to_raw(documents(spark, [r[0] for r in RAW])))
    for (doc, point, reason), row in zip(RAW, rows):
        found = row["location"] and (row["location"]["lat"], row["location"]["lon"])
        assert (found, row["reject_reason"]) == (point, reason), doc


# pubMillis, source_timestamp text, warning
TIMES = [
    (1718452800123, "2024-06-15T12:00:00.123000+00:00", None),
    (1718452800000, "2024-06-15T12:00:00+00:00", None),
    (1718452800123.25, "2024-06-15T12:00:00.123250+00:00", None),
    (-1, "1969-12-31T23:59:59.999000+00:00", None),
    (253402300799999, "9999-12-31T23:59:59.999000+00:00", None),
    (True, "1970-01-01T00:00:00.001000+00:00", None),
    (0, None, None),
    (None, None, None),
    (False, None, None),
    ("x", None, "pubMillis_unusable"),
    ("1718452800123", None, "pubMillis_unusable"),
    ([1], None, "pubMillis_unusable"),
    (253402300800000, None, "pubMillis_unusable"),
    (-62135596800001, None, "pubMillis_unusable"),
    (1e30, None, "pubMillis_unusable"),
]


@pytest.mark.parametrize("convert", [O.to_raw, O.to_processed])
def test_source_timestamp(spark, convert):
    df = convert(documents(spark, [{"pubMillis": t[0]} for t in TIMES] + [{}]))
    rows = by_order(
        df.select("mongo_id", "reject_reason", "warning", TP.iso_utc(F.col("source_timestamp")).alias("text"))
    )
    for (value, text, warning), row in zip([*TIMES, (None, None, None)], rows):
        assert (row["text"], row["warning"], row["reject_reason"]) == (text, warning, None), value


def test_raw_drops_unlisted_fields_and_types_listed_ones(spark):
    doc = {"nThumbsUp": 4, "speed": "1.5", "level": 2.9, "delay": "x", "uuid": "u", "street": None, "type": 7}
    row = O.to_raw(documents(spark, [doc])).drop("alert").first()
    assert "nThumbsUp" not in row
    assert (row["speed"], row["level"], row["delay"], row["uuid"], row["street"], row["type"]) == (
        1.5, 2, None, "u", None, "7"
    )


def test_zone_of_flat_rows(spark):
    nan = float("nan")
    rows = [
        ("Santiago", -70.6, nan, "Santiago-Centro-Centro"),
        ("Santiago", nan, -33.41, "Santiago-Norte-Centro"),
        ("Santiago", None, -33.41, "UNKNOWN"),
        (None, None, None, "UNKNOWN"),
        (None, 1.0, 1.0, "UNKNOWN-Nearby"),
    ]
    df = spark.createDataFrame(rows, "city string, x double, y double, zona string")
    out = df.select("zona", A.zone(F.col("city"), F.col("x"), F.col("y")).alias("found")).collect()
    assert [r["found"] for r in out] == [r["zona"] for r in out]


def test_user_rules(spark):
    df = spark.createDataFrame([("a", "s", "X", 1.0, 2.0)], "type string, subtype string, city string, x double, y double")
    assert O.with_event_filter(df, mapping={"A": "HIGH"}, default="LOW").first()["pig_event_filter"]["prioridad"] == "HIGH"
    rules = A.ZoneRules(cities=("X",), prefix="P", north=1.5)
    assert O.with_location_filter(df, rules=rules).first()["pig_location_filter"]["zona"] == "P-Norte-Este"
    assert O.within_bbox(df, box=A.Box(1.0, 2.0, 1.0, 2.0)).count() == 1
    assert O.within_bbox(df).count() == 0


def test_geo_point_without_cast_only_renames(spark):
    df = documents(spark, [{"x": "7", "y": [1]}]).select(
        A.geo_point(F.expr("variant_get(alert, '$.x', 'variant')"), F.expr("variant_get(alert, '$.y', 'variant')"), cast=False).alias("p")
    )
    p = df.first()["p"]
    assert (p["lat"].toPython(), p["lon"].toPython()) == ([1], "7")


def test_keep_fields_ignores_unknown_and_repeated_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, `c.d` int")
    assert O.keep_fields(df, ["b", "zz", "c.d", "b"]).columns == ["b", "c.d"]


def test_local_times_are_written_into_the_document(spark):
    docs = [
        {"pubMillis": 0, "_processed_at": "old",
         "comments": [{"reportMillis": 1718452800123, "text": "ok"}, {"text": "none"}, 5, {"reportMillis": "x"}]},
        {"pubMillis": "x", "comments": {"reportMillis": 1}},
        7,
    ]
    out = [json.loads(r["alert"].toJson()) for r in by_order(O.with_local_times(documents(spark, docs)))]
    assert out[0]["pubMillis_santiago"] == "1969-12-31T21:00:00"
    assert out[0]["comments"] == [
        {"reportMillis": 1718452800123, "text": "ok", "reportMillis_santiago": "2024-06-15T08:00:00.123000"},
        {"text": "none"},
        5,
        {"reportMillis": "x"},
    ]
    assert out[0]["_processed_at"] != "old"
    assert "pubMillis_santiago" not in out[1] and out[1]["comments"] == {"reportMillis": 1}
    assert out[2] == 7
