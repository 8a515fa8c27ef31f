"""The registered queries in plain SQL, for a second engine to check them.

Written from the rules, not from the Spark code: every query is one string
over the given tables.
"""

from __future__ import annotations

from .views import EXTRA, REJECT_DOC

EXTRA_COLUMNS = ", ".join(f'{sql} AS "{name}"' for name, sql in EXTRA.items())

ALERTS = f"""alerts AS (SELECT event_id,
  lpad(lower(to_hex(event_id)), 24, '0') AS mongo_id,
  concat('u-', CAST(event_id % 997 AS VARCHAR)) AS uuid,
  CASE event_id % 9 WHEN 0 THEN 'accident' WHEN 1 THEN 'HAZARD' WHEN 2 THEN 'jam' WHEN 3 THEN 'ROAD_CLOSED'
    WHEN 4 THEN 'CONSTRUCTION' WHEN 5 THEN 'Police' WHEN 6 THEN 'WEATHERHAZARD' WHEN 7 THEN 'CHIT_CHAT' END AS type,
  CASE WHEN event_id % 10 <> 0 THEN event_type END AS subtype,
  CASE user_id % 5 WHEN 0 THEN 'Santiago' WHEN 1 THEN 'SANTIAGO' WHEN 2 THEN 'Chile' WHEN 3 THEN 'Maipú' END AS city,
  CASE WHEN event_id % 17 <> 0 THEN CAST(-70750 + (event_id * 37) % 251 AS DOUBLE) / 1e3 END AS x,
  CASE WHEN event_id % 17 <> 0 THEN CAST(-33650 + (event_id * 53) % 301 AS DOUBLE) / 1e3 END AS y,
  CASE WHEN event_id % 101 = 0 THEN 0 ELSE epoch_us(ts) // 1000 END AS "pubMillis",
  CAST(event_id % 11 AS INT) AS reliability,
  CAST(event_id % 6 AS INT) AS confidence,
  CAST(user_id % 7 AS INT) AS "nThumbsUp",
  CAST(date_trunc('hour', ts) AS TIMESTAMP) AS snapshot_ts, ts, {EXTRA_COLUMNS}
FROM events)"""

DOCS = """docs AS (SELECT event_id, lpad(lower(to_hex(event_id)), 24, '0') AS mongo_id,
  CASE event_id % 5
    WHEN 0 THEN concat('{"type":"JAM","props":', props, '}')
    WHEN 1 THEN concat('{"type":null,"props":', props, '}')
    WHEN 2 THEN concat('{"props":', props, '}')
    WHEN 3 THEN '{"type":"accident","subtype":"x","location":{"x":-70.6,"y":-33.5},"comments":[{"reportMillis":1704067200000},{"z":1}]}'
    ELSE '{"type":7,"location":"Plaza"}' END AS doc
FROM events)"""

REJECT_DOCS = f"""docs AS (SELECT event_id, lpad(lower(to_hex(event_id)), 24, '0') AS mongo_id,
  {REJECT_DOC} AS doc FROM events)"""

PATHS = {
    "type": "$.type",
    "props": "$.props",
    "props.k": "$.props.k",
    "subtype": "$.subtype",
    "location": "$.location",
    "location.x": "$.location.x",
    "location.y": "$.location.y",
    "comments": "$.comments",
    "comments[0].reportMillis": "$.comments[0].reportMillis",
}

NODES = "nodes AS (" + " UNION ALL ".join(
    f"SELECT mongo_id, '{name}' AS path, json_type(doc, '{path}') AS jt, json_extract(doc, '{path}') AS v "
    f"FROM docs WHERE json_exists(doc, '{path}')"
    for name, path in PATHS.items()
) + ")"

KIND = """CASE jt WHEN 'VARCHAR' THEN 'str' WHEN 'UBIGINT' THEN 'int' WHEN 'BIGINT' THEN 'int'
  WHEN 'DOUBLE' THEN 'float' WHEN 'BOOLEAN' THEN 'bool' WHEN 'NULL' THEN 'NoneType'
  WHEN 'OBJECT' THEN 'dict' ELSE 'list' END"""

SAMPLES = """samples AS (SELECT path, CAST(rn AS INT) AS rank,
  CASE jt WHEN 'OBJECT' THEN 'dict(' || len(json_keys(v)) || ' keys)'
    WHEN 'ARRAY' THEN 'list(' || json_array_length(v) || ' items)'
    ELSE left(json_extract_string(v, '$'), 100) END AS sample
  FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY mongo_id DESC) AS rn
        FROM nodes WHERE jt <> 'NULL') WHERE rn <= 5)"""

TIPO = "upper(coalesce(type, ''))"
SUBTIPO = "upper(coalesce(subtype, ''))"
PRIORIDAD = f"""CASE WHEN {TIPO} IN ('ACCIDENT', 'ROAD_CLOSED', 'WEATHERHAZARD') THEN 'ALTA'
  WHEN {TIPO} IN ('HAZARD', 'CONSTRUCTION', 'POLICE') THEN 'MEDIA' ELSE 'BAJA' END"""
CIUDAD = "coalesce(city, 'UNKNOWN')"
ZONA = f"""CASE WHEN x IS NULL OR y IS NULL THEN 'UNKNOWN'
  WHEN upper({CIUDAD}) IN ('SANTIAGO', 'CHILE') THEN 'Santiago-'
    || CASE WHEN y > -33.42e0 THEN 'Norte' WHEN y < -33.58e0 THEN 'Sur' ELSE 'Centro' END || '-'
    || CASE WHEN x < -70.68e0 THEN 'Oeste' WHEN x > -70.55e0 THEN 'Este' ELSE 'Centro' END
  ELSE {CIUDAD} || '-Nearby' END"""


def local(utc: str) -> str:
    return f"(({utc}) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Santiago'"


def iso(ts: str) -> str:
    return (
        f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S') || "
        f"CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN '' ELSE strftime({ts}, '.%f') END)"
    )


def offset(utc: str, loc: str) -> str:
    m = f"date_diff('minute', {utc}, {loc})"
    return (
        f"(CASE WHEN {m} < 0 THEN '-' ELSE '+' END || lpad(CAST(abs({m}) // 60 AS VARCHAR), 2, '0') "
        f"|| ':' || lpad(CAST(abs({m}) % 60 AS VARCHAR), 2, '0'))"
    )


def day_part(loc: str) -> str:
    h = f"hour({loc})"
    return (
        f"CASE WHEN {h} >= 20 THEN 'Noche' WHEN {h} >= 16 THEN 'Tarde' WHEN {h} >= 10 THEN 'Día' "
        f"WHEN {h} >= 6 THEN 'Mañana' WHEN {h} >= 0 THEN 'Madrugada' END"
    )


def weekday(loc: str) -> str:
    return (
        "list_value('Lunes', 'Martes', 'Miércoles', 'Jueves', 'Viernes', 'Sábado', 'Domingo')"
        f"[isodow({loc})]"
    )


TIMED = f"""timed AS (SELECT *, make_timestamp("pubMillis" * 1000) AS utc,
  {local('make_timestamp("pubMillis" * 1000)')} AS loc FROM alerts)"""
TIME_GROUP = f"""{day_part('loc')} AS categoria_dia, {weekday('loc')} AS dia_semana,
  CAST(hour(loc) AS INT) AS hora, strftime(loc, '%Y-%m-%d') AS fecha,
  {iso('loc')} || {offset('utc', 'loc')} AS timestamp_chile"""
SOURCE_TS = """CASE WHEN "pubMillis" <> 0 THEN """ + iso('make_timestamp("pubMillis" * 1000)') + """ || '+00:00' END"""

RAW_COLUMNS = """mongo_id, country, city, street, type, subtype, "roadType", "turnType", "endNode", "alertType",
  "reportDescription", uuid, "pubMillis", speed, length, delay, severity, "reportRating", confidence, reliability,
  "jamLevel", "alertsCount", irregularities, "driversCount", level, y AS lat, x AS lon, """ + SOURCE_TS + """ AS source_timestamp,
  true AS stamped"""

GROUPS = f"""{TIPO} AS tipo, {SUBTIPO} AS subtipo, {PRIORIDAD} AS prioridad,
  {CIUDAD} AS ciudad, {ZONA} AS zona"""

RAW_SQL = f"WITH {ALERTS} SELECT {RAW_COLUMNS} FROM alerts"
# Documents take their time group from the source time, which a pubMillis of 0 does not give.
PROCESSED_DOC_SQL = f"""WITH {ALERTS}, timed AS (SELECT *,
    CASE WHEN "pubMillis" <> 0 THEN make_timestamp("pubMillis" * 1000) END AS utc,
    {local('CASE WHEN "pubMillis" <> 0 THEN make_timestamp("pubMillis" * 1000) END')} AS loc FROM alerts)
  SELECT mongo_id, country, city, street, type, subtype, "reportBy", uuid, id, "pubMillis", reliability, confidence,
    "nThumbsUp", "nComments", CASE WHEN x IS NULL AND event_id % 34 = 0 THEN -33.5e0 ELSE y END AS lat,
    CASE WHEN x IS NULL AND event_id % 34 = 0 THEN CAST(event_id % 7 - 74 AS DOUBLE) ELSE x END AS lon,
    {SOURCE_TS} AS source_timestamp,
    {GROUPS}, {TIME_GROUP} FROM timed"""

NUMERIC = "('UBIGINT', 'BIGINT', 'DOUBLE', 'BOOLEAN')"
HAS_POINT = "(json_type(doc, '$.location') = 'OBJECT' AND json_exists(doc, '$.location.x') AND json_exists(doc, '$.location.y'))"
REASONS = f"""judged AS (SELECT *,
  CASE WHEN json_type(doc, '$.type') <> 'VARCHAR' THEN 'type_not_text'
    WHEN json_type(doc, '$.subtype') <> 'VARCHAR' THEN 'subtype_not_text'
    WHEN {HAS_POINT} AND json_type(doc, '$.city') <> 'VARCHAR' THEN 'city_not_text'
    WHEN {HAS_POINT} AND upper(json_extract_string(doc, '$.city')) IN ('SANTIAGO', 'CHILE')
      AND NOT (json_type(doc, '$.location.x') IN {NUMERIC} AND json_type(doc, '$.location.y') IN {NUMERIC})
      THEN 'coordinates_not_numeric' END AS processed_reason,
  CASE WHEN json_type(doc, '$.location') IN {NUMERIC}
      AND CAST(json_extract_string(doc, '$.location') AS DOUBLE) <> 0 THEN 'location_not_object' END AS raw_reason
  FROM docs)"""
REASON_COUNTS = """SELECT processed_reason, CAST(NULL AS VARCHAR) AS raw_reason, count(*) AS n,
    min(mongo_id) AS first_id, max(mongo_id) AS last_id
  FROM judged WHERE processed_reason IS NOT NULL GROUP BY 1
  UNION ALL SELECT NULL, raw_reason, count(*), min(mongo_id), max(mongo_id)
  FROM judged WHERE raw_reason IS NOT NULL GROUP BY raw_reason"""

NEWEST = f"""WITH {ALERTS}, newest AS (SELECT uuid, mongo_id, type, "pubMillis" FROM alerts
  QUALIFY row_number() OVER (PARTITION BY uuid ORDER BY mongo_id DESC) = 1)
SELECT uuid, mongo_id, type, "pubMillis",
  CASE WHEN type IN ('JAM', 'jam') OR type IS NULL THEN 'second' ELSE 'first' END AS status FROM newest"""

LANDED = """landed AS (SELECT *, CASE WHEN event_id % 13 = 0 OR event_id % 19 = 0 OR event_id % 23 = 0 THEN 0
  WHEN event_id % 2 = 0 THEN 2 ELSE 1 END AS n FROM alerts),
  exploded AS (SELECT *, CAST(unnest(range(n)) AS INT) AS pos FROM landed)"""

HISTOGRAM = f"""WITH {ALERTS} SELECT date_trunc('hour', make_timestamp("pubMillis" * 1000)) AS bucket, count(*) AS n
  FROM alerts WHERE "pubMillis" <> 0 GROUP BY 1"""

FIELDS = {
    "uuid": "uuid",
    "type": "type",
    "subtype": "subtype",
    "city": "city",
    "location": "CASE WHEN x IS NOT NULL OR event_id % 34 = 0 THEN 1 END",
    "location.lat": "CASE WHEN x IS NULL AND event_id % 34 = 0 THEN 1 END",
    "location.lon": "CASE WHEN x IS NULL AND event_id % 34 = 0 THEN 1 END",
    "location.x": "x",
    "location.y": "y",
    "pubMillis": '"pubMillis"',
    "reliability": "reliability",
    "confidence": "confidence",
    "nThumbsUp": '"nThumbsUp"',
} | {name: f'"{name}"' for name in EXTRA}
COUNTED = "counted AS (" + " UNION ALL ".join(
    f"SELECT '{path}' AS path, count({column}) AS n FROM alerts" for path, column in FIELDS.items()
) + ")"
CATEGORY = """CASE WHEN path IN ('_id', 'type', 'subtype') THEN 'core'
  WHEN lower(path) LIKE '%location%' OR lower(path) LIKE '%coord%' THEN 'location'
  WHEN lower(path) LIKE '%time%' OR lower(path) LIKE '%pub%' OR lower(path) LIKE '%date%' THEN 'time'
  WHEN left(path, 1) = '_' OR lower(path) LIKE '%id%' THEN 'metadata' ELSE 'domain' END"""

IMPURE = """docs AS (SELECT event_id, CASE event_type
  WHEN 'error' THEN concat('{"pig_event_filter":null,"props":', props, '}')
  WHEN 'signup' THEN concat('{"pig_event_filter":{},"pig_time_filter":', props, '}')
  ELSE props END AS doc FROM events)"""
DERIVED = ("pig_event_filter", "pig_location_filter", "pig_time_filter")


def _exists_counts(names: tuple[str, ...]) -> str:
    return ", ".join(f"count(*) FILTER (json_exists(doc, '$.{n}')) AS {n}" for n in names)


ORDER_UTC = "o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT))"

_SQL: dict[str, str] = {
    "event_priority": f"WITH {ALERTS} SELECT mongo_id, {TIPO} AS tipo, {SUBTIPO} AS subtipo, {PRIORIDAD} AS prioridad FROM alerts",
    "geo_zone": f"WITH {ALERTS} SELECT mongo_id, {CIUDAD} AS ciudad, {ZONA} AS zona FROM alerts",
    "geo_zone_counts": f"WITH {ALERTS} SELECT {ZONA} AS zona, count(*) AS n FROM alerts GROUP BY 1",
    "bbox_filter": f"""WITH {ALERTS} SELECT mongo_id, x, y FROM alerts
      WHERE x BETWEEN -70.75e0 AND -70.55e0 AND y BETWEEN -33.6e0 AND -33.4e0""",
    "local_publish_time": f"WITH {ALERTS}, {TIMED} SELECT mongo_id, {iso('loc')} AS pubMillis_santiago FROM timed",
    "source_timestamp_utc": f"WITH {ALERTS} SELECT mongo_id, {SOURCE_TS} AS source_timestamp FROM alerts",
    "day_part_weekday": f"WITH {ALERTS}, {TIMED} SELECT mongo_id, {TIME_GROUP} FROM timed",
    "order_local_times": f"""WITH t AS (SELECT o_orderkey, {ORDER_UTC} AS utc, {local(ORDER_UTC)} AS loc FROM orders)
      SELECT o_orderkey, {iso('loc')} || {offset('utc', 'loc')} AS local_iso, {day_part('loc')} AS categoria_dia,
        {weekday('loc')} AS dia_semana FROM t""",
    "comment_times": f"""WITH {ALERTS}, c AS (SELECT mongo_id, "pubMillis",
          CAST(unnest(range(1, event_id % 4 + 1)) AS INT) AS k FROM alerts),
        t AS (SELECT mongo_id, k, "pubMillis" + 60000 * k AS "reportMillis",
          {local('make_timestamp(("pubMillis" + 60000 * k) * 1000)')} AS loc FROM c)
      SELECT mongo_id, k, "reportMillis", {iso('loc')} AS "reportMillis_santiago" FROM t""",
    "raw_projection": RAW_SQL,
    "raw_documents": RAW_SQL,
    "raw_stream": RAW_SQL,
    "processed_rows": f"""WITH {ALERTS}, {TIMED} SELECT mongo_id, uuid, type, subtype, city, "pubMillis", reliability,
        confidence, "nThumbsUp", country, street, "reportBy", id, "nComments", y AS lat, x AS lon, {SOURCE_TS} AS source_timestamp,
        true AS stamped, {GROUPS}, {TIME_GROUP} FROM timed""",
    "processed_documents": PROCESSED_DOC_SQL,
    "processed_stream": PROCESSED_DOC_SQL,
    "keep_list": f'WITH {ALERTS} SELECT mongo_id, type, subtype, x, y, "pubMillis", city, reliability FROM alerts',
    "conform_casts": """SELECT event_id,
        CASE WHEN user_id % 3 <> 0 THEN CAST(user_id AS INT) END AS code,
        CASE WHEN event_id % 7 <> 0 THEN CAST(user_id AS DOUBLE) END AS amount,
        TRY_CAST(event_id * 1000000 AS INT) AS flag, CAST(NULL AS VARCHAR) AS absent FROM events""",
    "incremental_read": f"""WITH {ALERTS} SELECT mongo_id, type, "pubMillis" FROM alerts
      WHERE mongo_id > (SELECT max(mongo_id) FROM alerts WHERE ts < TIMESTAMP '2024-01-15') ORDER BY mongo_id LIMIT 100""",
    "incremental_backlog": """SELECT event_id, event_type FROM events
      WHERE event_id > (SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-15') ORDER BY event_id""",
    "resume_mark_raw": f"WITH {ALERTS} SELECT max(mongo_id) AS mark FROM alerts",
    "resume_mark_processed": f"""WITH {ALERTS} SELECT mongo_id AS mark FROM alerts
      ORDER BY snapshot_ts DESC, mongo_id DESC LIMIT 1""",
    "recent_sample": f"WITH {ALERTS} SELECT mongo_id, type, city FROM alerts ORDER BY mongo_id DESC LIMIT 100",
    "collection_count": "SELECT count(*) AS n FROM events",
    "example_fields": f"""WITH {DOCS}, one AS (SELECT doc FROM docs ORDER BY mongo_id LIMIT 1)
      SELECT unnest(json_keys(doc)) AS field FROM one""",
    "field_exists_counts": f"WITH {DOCS} SELECT {_exists_counts(('type', 'subtype', 'props', 'location', 'comments', 'absent'))} FROM docs",
    "purity_gate_counts": f"WITH {IMPURE} SELECT {_exists_counts(DERIVED)} FROM docs",
    "purity_row_hits": f"WITH {IMPURE} SELECT event_id, "
    + ", ".join(f"json_exists(doc, '$.{n}') AS has_{n}" for n in DERIVED)
    + " FROM docs",
    "reject_reasons": f"WITH {REJECT_DOCS}, {REASONS} {REASON_COUNTS}",
    "reject_reasons_nested": f"WITH {DOCS}, {REASONS} {REASON_COUNTS}",
    "dead_letters": f"""WITH {REJECT_DOCS}, {REASONS} SELECT mongo_id, processed_reason AS reject_reason
      FROM judged WHERE processed_reason IS NOT NULL""",
    "field_profile": f"""WITH {DOCS}, {NODES} SELECT path, count(*) AS n,
        100 * count(*) / (SELECT count(*) FROM docs) AS pct,
        array_to_string(list_sort(list(DISTINCT {KIND})), ',') AS types,
        count(*) FILTER (jt = 'NULL') AS null_n, 100 * count(*) FILTER (jt = 'NULL') / count(*) AS null_pct
      FROM nodes GROUP BY path""",
    "field_samples": f"WITH {DOCS}, {NODES}, {SAMPLES} SELECT path, rank, sample FROM samples",
    "field_report": f"""WITH {DOCS}, {NODES}, {SAMPLES}, shown AS (SELECT path,
        string_agg(sample, ' | ' ORDER BY rank) FILTER (rank <= 3) AS shown FROM samples GROUP BY path)
      SELECT path, n, coalesce(shown, '') AS shown FROM (SELECT path, count(*) AS n FROM nodes GROUP BY path)
      LEFT JOIN shown USING (path)""",
    "inspect_recent": f"""WITH {DOCS.replace('FROM events)', 'FROM (SELECT * FROM events ORDER BY event_id DESC LIMIT 100))')},
      {NODES}, {SAMPLES}, shown AS (SELECT path, string_agg(sample, ' | ' ORDER BY rank) AS samples FROM samples GROUP BY path),
      counted AS (SELECT path, count(*) AS n, array_to_string(list_sort(list(DISTINCT {KIND})), ',') AS types FROM nodes GROUP BY path)
      SELECT path, {CATEGORY} AS category, {CATEGORY} <> 'metadata' AS keep, n, types, coalesce(samples, '') AS samples
      FROM counted LEFT JOIN shown USING (path)""",
    "distinct_paths": f"WITH {DOCS}, {NODES} SELECT count(DISTINCT path) AS n_paths FROM nodes",
    "field_classes": f"""WITH {ALERTS}, {COUNTED}, classed AS (SELECT path, n, {CATEGORY} AS category FROM counted)
      SELECT path, n, category,
        CAST(list_position(['core', 'location', 'time', 'domain', 'metadata'], category) AS INT) AS category_rank,
        category <> 'metadata' AND (left(path, 1) <> '_' OR path = '_id') AS keep FROM classed""",
    "latest_snapshot": f"""WITH {ALERTS} SELECT mongo_id, type FROM alerts
      WHERE snapshot_ts = (SELECT max(snapshot_ts) FROM alerts)""",
    "expired_snapshot": f"""WITH {ALERTS}, newest AS (SELECT count(*) AS n FROM alerts
        WHERE snapshot_ts = (SELECT max(snapshot_ts) FROM alerts))
      SELECT 299 AS age, n FROM newest UNION ALL SELECT 300, 0 UNION ALL SELECT 301, 0""",
    "append_by_day": f"""WITH {ALERTS} SELECT 'appended' AS mode, strftime(snapshot_ts, '%Y-%m-%d') AS ingest_date,
        2 * count(*) AS n FROM alerts GROUP BY 2
      UNION ALL SELECT 'replayed', strftime(snapshot_ts, '%Y-%m-%d'), count(*) FROM alerts GROUP BY 2""",
    "upsert_last_wins": NEWEST,
    "compacted_target": NEWEST,
    "bucketed_target": NEWEST,
    "ensure_target_state": f"""WITH {ALERTS}, a AS (SELECT CAST(count(*) AS INT) AS n, max(mongo_id) AS most FROM alerts)
      SELECT 1 AS step, 'create' AS state, 'v1' AS version, 0 AS v1_rows, '' AS v1_greatest
      UNION ALL SELECT 2, 'rebuild', 'v2', n, most FROM a UNION ALL SELECT 3, 'ok', 'v2', n, most FROM a""",
    "fan_out_counts": """SELECT 'events' AS sink, count(*) AS n, 1 AS failed_sinks FROM events
      UNION ALL SELECT 'zones', count(*), 1 FROM events""",
    "snapshot_read": f'WITH {ALERTS}, {LANDED} SELECT uuid, "pubMillis", pos FROM exploded',
    "snapshot_stream": f"""WITH {ALERTS}, {LANDED}, t AS (SELECT *, {local('make_timestamp("pubMillis" * 1000)')} AS loc
        FROM exploded)
      SELECT uuid, {iso('loc')} AS "pubMillis_santiago", pos, true AS stamped FROM t""",
    "corrupt_quarantine": f"""WITH {ALERTS} SELECT '{{"alerts":[{{"uuid":"' || uuid AS line FROM alerts
      WHERE event_id % 23 = 0 AND event_id % 13 <> 0 AND event_id % 19 <> 0""",
    "cycle_metrics": f"""WITH {REJECT_DOCS}, {REASONS} SELECT count(*) AS read_n, count(*) - count(processed_reason) AS converted_n,
        count(*) - count(processed_reason) AS exported_n, count(processed_reason) AS failed_n,
        count(*) - count(processed_reason) AS stored_n, count(processed_reason) AS dead_letter_n FROM judged""",
    "gated_stream": """SELECT 'dirty' AS source, true AS stopped, 0 AS stored_n,
        count(*) FILTER (event_type = 'signup') AS pig_time_filter FROM events
      UNION ALL SELECT 'clean', false, count(*) FILTER (event_type <> 'signup'), 0 FROM events""",
    "snapshot_repeats": """SELECT sum(2 * (1 + event_id % 4)) AS documents, sum(2 * (1 + event_id % 4)) AS keys,
        sum(1 + event_id % 4) AS last_value, sum(2 * (1 + event_id % 4)) AS raw_rows FROM events""",
    "snapshot_fetch_time": f"""WITH {ALERTS} SELECT uuid, strftime(snapshot_ts, '%Y-%m-%d %H:%M:%S') AS fetched_at,
        epoch_us(snapshot_ts) // 1000000 AS key_seconds FROM alerts WHERE snapshot_ts = (SELECT max(snapshot_ts) FROM alerts)""",
    "kept_snapshot": f"""WITH {ALERTS} SELECT uuid, strftime(snapshot_ts, '%Y-%m-%d %H:%M:%S') AS fetched_at, 0 AS expired_n
        FROM alerts WHERE snapshot_ts = (SELECT max(snapshot_ts) FROM alerts)""",
    "batch_repeats": f"""WITH {ALERTS} SELECT unnest([1, 2]) AS pass, mongo_id,
        CASE WHEN event_id % 20 = 0 THEN 'AGAIN' WHEN event_id % 10 = 0 THEN 'CHANGED' ELSE type END AS type FROM alerts""",
    "deep_profile": """WITH levels AS (SELECT unnest(range(1, event_id % 13 + 2)) AS k, event_id % 13 + 1 AS depth FROM events)
      SELECT repeat('n.', CAST(k - 1 AS INT)) || 'n' AS path, count(*) AS n,
        CASE WHEN bool_or(k < depth) AND bool_or(k = depth) THEN 'dict,int' WHEN bool_or(k < depth) THEN 'dict' ELSE 'int' END AS types
      FROM levels GROUP BY k""",
    "long_text_profile": r"""WITH texts AS (
        SELECT event_id, repeat('[{"}\ ', CASE WHEN event_id % 500 = 0 THEN 20000 ELSE 1 + event_id % 7 END) AS x FROM events),
      ranked AS (SELECT *, row_number() OVER (ORDER BY event_id DESC) AS age FROM texts),
      shown AS (SELECT unnest([
        {'path': 'text', 'types': 'str', 's': left(x, 100)}, {'path': 'in', 'types': 'dict', 's': 'dict(1 keys)'},
        {'path': 'in.note', 'types': 'str', 's': left(reverse(x), 100)}, {'path': 'list', 'types': 'list', 's': 'list(1 items)'},
        {'path': 'list[0].x', 'types': 'str', 's': left(x, 100)}], recursive := true), age FROM ranked)
      SELECT path, count(*) AS n, any_value(types) AS types, string_agg(s, ' | ' ORDER BY age) FILTER (age <= 2) AS samples FROM shown GROUP BY path""",
    "rebuilt_target": """WITH n AS (SELECT CAST(count(*) AS INT) AS n FROM events)
      SELECT unnest(['before', 'while', 'after', 'again']) AS step, unnest(['v1', 'v1', 'v2', 'v2']) AS version, n,
        unnest([false, false, true, true]) AS enriched FROM n""",
    "stream_progress": """SELECT 2 AS streams, 2 * count(*) AS input_n, true AS bounded, true AS timed,
        2 * count(*) AS read_n, true AS same_batches FROM events""",
    "document_comment_times": f"""WITH {ALERTS}, t AS (SELECT *, event_id % 3 <> 0 AS listed,
        {local('make_timestamp("pubMillis" * 1000)')} AS loc, {local('make_timestamp(("pubMillis" + 60000) * 1000)')} AS later FROM alerts)
      SELECT mongo_id, {iso('loc')} AS published, CASE WHEN listed THEN {iso('later')} END AS reported, CASE WHEN listed THEN uuid END AS uuid,
        CASE WHEN listed THEN 'no time' END AS text, true AS untimed, CASE WHEN listed THEN false ELSE true END AS no_list FROM t""",
    "rejects_accounted": f"WITH {REJECT_DOCS}, {REASONS} SELECT mongo_id, processed_reason IS NULL AS stored FROM judged",
    "bounded_stream": "SELECT true AS several, count(*) AS read_n, count(*) AS exported_n, count(*) AS stored_n FROM events",
    "resumed_stream": f"""WITH {ALERTS} SELECT mongo_id, CASE WHEN event_id % 10 = 0 THEN 'CHANGED' ELSE type END AS type FROM alerts""",
    "facet_counts": f"""WITH {ALERTS}, {TIMED} SELECT {PRIORIDAD} AS prioridad, {ZONA} AS zona,
        {day_part('loc')} AS categoria_dia, count(*) AS n FROM timed GROUP BY 1, 2, 3""",
    "facet_top_k": f"""WITH {ALERTS} SELECT {TIPO} AS tipo, {ZONA} AS zona, count(*) AS n FROM alerts
      GROUP BY 1, 2 ORDER BY n DESC, tipo, zona LIMIT 10""",
    "hourly_histogram": HISTOGRAM,
    "histogram_stream": HISTOGRAM,
    "priority_histogram": f"""WITH {ALERTS} SELECT CAST(date_trunc('day', make_timestamp("pubMillis" * 1000)) AS TIMESTAMP) AS bucket,
        {PRIORIDAD} AS prioridad, count(*) AS n FROM alerts WHERE "pubMillis" <> 0 GROUP BY 1, 2""",
    "raw_processed_reconcile": f"""WITH {REJECT_DOCS}, {REASONS} SELECT
        count(*) FILTER (raw_reason IS NULL) AS raw_rows, count(*) FILTER (processed_reason IS NULL) AS processed_rows,
        count(*) FILTER (raw_reason IS NULL AND processed_reason IS NULL) AS in_both,
        count(*) FILTER (raw_reason IS NULL AND processed_reason IS NOT NULL) AS only_raw,
        count(*) FILTER (raw_reason IS NOT NULL AND processed_reason IS NULL) AS only_processed FROM judged""",
    "reconcile_by_digest": f"""WITH {REJECT_DOCS}, {REASONS} SELECT 'rejects' AS source,
        count(*) FILTER (raw_reason IS NULL) AS raw_rows, count(*) FILTER (processed_reason IS NULL) AS processed_rows,
        count(*) FILTER (raw_reason IS NULL AND processed_reason IS NULL) AS in_both,
        count(*) FILTER (raw_reason IS NULL AND processed_reason IS NOT NULL) AS only_raw,
        count(*) FILTER (raw_reason IS NOT NULL AND processed_reason IS NULL) AS only_processed FROM judged
      UNION ALL SELECT 'lag', count(*), count(*) FILTER (kept), count(*) FILTER (kept), count(*) FILTER (NOT kept), 0
      FROM (SELECT event_id < 5000 OR event_id % 7 > 0 AS kept FROM judged WHERE raw_reason IS NULL)""",
}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
