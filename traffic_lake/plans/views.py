"""Alert-shaped views over the given tables. Arithmetic only, so that the same
rows can be written in SQL (see :mod:`oracles`)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BRONZE

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


# Events that one task turns into documents, and documents that one file of a stream has, about.
PART_ROWS, FILE_ROWS = 100_000, 400_000

# Parse each text once: the optimizer does not copy a generator's output into
# the predicates that read it, as it would copy a bare parse_json.
PARSED = "explode(array(parse_json(doc))) AS alert"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts_of(df: DataFrame, rows: int) -> int:
    """In how many parts a table has about ``rows`` rows each."""
    return max(1, -(-df.count() // rows))


def dealt(df: DataFrame, parts: int) -> DataFrame:
    """Events in so many parts. A file of few bytes is one part as it is read, however much is made of its rows."""
    return df.repartition(parts, "event_id") if parts > 1 else df


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table in parts of about ``PART_ROWS`` rows, for what keeps or writes much more than it reads."""
    read = table(spark, sf_dir, "events")
    return dealt(read, parts_of(read, PART_ROWS))


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream, a batch in parts of about ``PART_ROWS`` rows if it has the whole table.

    A pattern matches the table whether it is one file or a folder of files.
    """
    parts = parts_of(table(spark, sf_dir, "events"), PART_ROWS)
    return dealt(spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/events.parque[t]"), parts)


# The fields beyond those that rules look at, alike in both SQL dialects. Gaps and
# moduli differ, so that fields that trade places or types show.
EXTRA = {
    "country": "CASE WHEN event_id % 4 <> 0 THEN concat('C', CAST(event_id % 3 AS STRING)) END",
    "street": "CASE WHEN event_id % 6 <> 0 THEN concat('Calle ', CAST(user_id % 50 AS STRING)) END",
    "roadType": "CASE WHEN event_id % 7 <> 0 THEN concat('road ', CAST(event_id % 8 AS STRING)) END",
    "turnType": "CASE WHEN event_id % 8 <> 1 THEN concat('turn ', CAST(event_id % 5 AS STRING)) END",
    "endNode": "concat('node ', CAST(event_id % 211 AS STRING))",
    "alertType": "CASE WHEN event_id % 3 <> 1 THEN concat('kind ', CAST(event_id % 13 AS STRING)) END",
    "reportDescription": "CASE WHEN event_id % 5 = 2 THEN concat('atención \"', CAST(user_id AS STRING)) END",
    "speed": "CASE WHEN event_id % 9 <> 4 THEN CAST(CAST(event_id % 240 AS DOUBLE) / 4 AS FLOAT) END",
    "length": "CASE WHEN event_id % 10 <> 3 THEN CAST(CAST(event_id % 4001 AS DOUBLE) / 2 AS FLOAT) END",
    "delay": "CASE WHEN event_id % 11 <> 5 THEN CAST(event_id % 601 - 1 AS INT) END",
    "severity": "CAST(event_id % 5 AS INT)",
    "reportRating": "CASE WHEN event_id % 12 <> 7 THEN CAST(event_id % 6 AS INT) END",
    "jamLevel": "CASE WHEN event_id % 13 <> 8 THEN CAST(event_id % 7 AS INT) END",
    "alertsCount": "CAST(event_id % 17 AS INT)",
    "irregularities": "CASE WHEN event_id % 14 <> 9 THEN CAST(event_id % 19 AS INT) END",
    "driversCount": "CAST(event_id % 23 AS INT)",
    "level": "CASE WHEN event_id % 15 <> 10 THEN CAST(event_id % 29 AS INT) END",
    "reportBy": "CASE WHEN event_id % 16 <> 11 THEN concat('by ', CAST(user_id % 31 AS STRING)) END",
    "id": "concat('alert-', CAST(event_id AS STRING))",
    "nComments": "CASE WHEN event_id % 18 <> 12 THEN CAST(event_id % 37 AS INT) END",
}


def alerts_view(events: DataFrame) -> DataFrame:
    """Flat alerts: every priority and zone, gaps, box edges, repeated uuids."""
    return events.selectExpr(
        "lpad(lower(hex(event_id)), 24, '0') AS mongo_id",
        "concat('u-', CAST(event_id % 997 AS STRING)) AS uuid",
        """CASE event_id % 9 WHEN 0 THEN 'accident' WHEN 1 THEN 'HAZARD' WHEN 2 THEN 'jam'
           WHEN 3 THEN 'ROAD_CLOSED' WHEN 4 THEN 'CONSTRUCTION' WHEN 5 THEN 'Police'
           WHEN 6 THEN 'WEATHERHAZARD' WHEN 7 THEN 'CHIT_CHAT' END AS type""",
        "CASE WHEN event_id % 10 <> 0 THEN event_type END AS subtype",
        """CASE user_id % 5 WHEN 0 THEN 'Santiago' WHEN 1 THEN 'SANTIAGO' WHEN 2 THEN 'Chile'
           WHEN 3 THEN 'Maipú' END AS city""",
        "CASE WHEN event_id % 17 <> 0 THEN CAST(-70750 + (event_id * 37) % 251 AS DOUBLE) / 1e3 END AS x",
        "CASE WHEN event_id % 17 <> 0 THEN CAST(-33650 + (event_id * 53) % 301 AS DOUBLE) / 1e3 END AS y",
        "CASE WHEN event_id % 101 = 0 THEN 0L ELSE unix_millis(CAST(ts AS TIMESTAMP)) END AS pubMillis",
        "CAST(event_id % 11 AS INT) AS reliability",
        "CAST(event_id % 6 AS INT) AS confidence",
        "CAST(user_id % 7 AS INT) AS nThumbsUp",
        "CAST(date_trunc('HOUR', ts) AS TIMESTAMP_NTZ) AS snapshot_ts",
        *[f"{sql} AS `{name}`" for name, sql in EXTRA.items()],
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts_view(table(spark, sf_dir, "events"))


EVENT_NUMBER = "CAST(conv(mongo_id, 16, 10) AS BIGINT)"


def event_number() -> Column:
    """The number an alert's key was made from."""
    return F.expr(EVENT_NUMBER)


def alert_json(alerts: DataFrame) -> DataFrame:
    """Flat alerts plus their document text ``doc``; NULL fields are left out of it.

    Half the points that lack x and y are given as lat and lon.
    """
    has_point = F.col("x").isNotNull()
    named = F.when(event_number() % 34 == 0, F.struct(F.lit(-33.5).alias("lat"), (event_number() % 7 - 74).alias("lon")))
    spot = F.when(has_point, F.to_json(F.struct("x", "y"))).otherwise(F.to_json(named))
    return alerts.withColumn(
        "doc",
        F.to_json(
            F.struct(
                "uuid", "type", "subtype", "city",
                F.parse_json(spot).alias("location"),
                "pubMillis", "reliability", "confidence", "nThumbsUp", *EXTRA,
            )
        ),
    )


def bronze_view(events: DataFrame) -> DataFrame:
    """Alerts as stored documents."""
    return alert_json(alerts_view(events)).selectExpr(
        "mongo_id",
        "CAST(snapshot_ts AS TIMESTAMP) AS fetched_at",
        "'events' AS file_name",
        "0 AS pos",
        PARSED,
    ).select(*[f.name for f in BRONZE.fields])


def alerts_json_view(events: DataFrame) -> DataFrame:
    """Documents with explicit nulls, wrong types and nested lists."""
    return events.selectExpr(
        "event_id",
        """CASE event_id % 5
           WHEN 0 THEN concat('{"type":"JAM","props":', props, '}')
           WHEN 1 THEN concat('{"type":null,"props":', props, '}')
           WHEN 2 THEN concat('{"props":', props, '}')
           WHEN 3 THEN '{"type":"accident","subtype":"x","location":{"x":-70.6,"y":-33.5},"comments":[{"reportMillis":1704067200000},{"z":1}]}'
           ELSE '{"type":7,"location":"Plaza"}' END AS doc""",
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, mongo_id, alert`` of :func:`alerts_json_view`."""
    return alerts_json_view(table(spark, sf_dir, "events")).selectExpr(
        "event_id", "lpad(lower(hex(event_id)), 24, '0') AS mongo_id", PARSED
    )


# Documents for the reject rules: city, point and type in every usable and unusable form.
REJECT_DOC = """CASE event_id % 12
  WHEN 0 THEN concat('{"type":"', event_type, '","city":"Santiago","location":{"x":-70.6,"y":-33.45}}')
  WHEN 1 THEN concat('{"type":"JAM","subtype":null,"n":', user_id, '}')
  WHEN 2 THEN concat('{"type":"JAM","city":null,"location":{"x":-70.6,"y":-33.5},"n":', user_id, '}')
  WHEN 3 THEN '{"type":"JAM","city":null}'
  WHEN 4 THEN '{"type":"JAM","city":"Santiago","location":{"x":null,"y":-33.5}}'
  WHEN 5 THEN concat('{"type":"JAM","city":"', event_type, '","location":{"x":null,"y":null}}')
  WHEN 6 THEN '{"type":"JAM","city":"chile","location":{"x":"-70.6","y":"-33.5"}}'
  WHEN 7 THEN concat('{"type":"JAM","city":', user_id, ',"location":{"x":1,"y":2}}')
  WHEN 8 THEN concat('{"type":"JAM","location":', user_id + 1, '}')
  WHEN 9 THEN '{"type":["JAM"],"location":{}}'
  WHEN 10 THEN '{"type":"JAM","city":"Santiago","location":{"x":-70.6}}'
  ELSE '{"type":"JAM","location":0}' END"""


def reject_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_documents_view(table(spark, sf_dir, "events"))


def reject_documents_view(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id", "lpad(lower(hex(event_id)), 24, '0') AS mongo_id", f"{REJECT_DOC} AS doc"
    ).selectExpr("event_id", "mongo_id", PARSED)


def impure_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which some hold derived fields, one kind as explicit null."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """CASE event_type
           WHEN 'error' THEN concat('{"pig_event_filter":null,"props":', props, '}')
           WHEN 'signup' THEN concat('{"pig_event_filter":{},"pig_time_filter":', props, '}')
           ELSE props END AS doc""",
    ).selectExpr("event_id", PARSED)
