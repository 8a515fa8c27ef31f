"""Row-wise enrichment: every function here is narrow, no shuffle is needed.

Two input forms share the same expressions:

* flat: typed columns, NULL means "absent", nothing is rejected;
* documents: an ``alert`` VARIANT column, where an explicit null or a wrong
  type sets ``reject_reason`` (see :func:`quality.split_rejects`).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import alerts as A
from ..functions import timeparts as TP
from ..functions import variants as V
from ..schemas import (
    PROCESSED,
    PROCESSED_INT,
    PROCESSED_TEXT,
    RAW,
    RAW_FLOAT,
    RAW_INT,
    RAW_TEXT,
    conform,
)


def within_bbox(
    df: DataFrame, x: str = "x", y: str = "y", box: A.Box = A.SANTIAGO_BOX
) -> DataFrame:
    """Rows whose point lies in the box, edges included."""
    return df.filter(A.in_box(F.col(x), F.col(y), box))


def keep_fields(df: DataFrame, keep: Iterable[str]) -> DataFrame:
    """Only the listed columns, in the listed order; unknown names are ignored."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{name}`") for name in dict.fromkeys(keep) if name in have])


def with_event_filter(
    df: DataFrame,
    type_col: str = "type",
    subtype_col: str = "subtype",
    mapping: Mapping[str, str] = A.PRIORITIES,
    default: str = A.DEFAULT_PRIORITY,
    into: str = "pig_event_filter",
) -> DataFrame:
    group = _event_group(F.col("__tipo"), F.col(subtype_col), mapping, default)
    return (
        df.withColumn("__tipo", A.upper_or_empty(F.col(type_col))).withColumn(into, group).drop("__tipo")
    )


def with_location_filter(
    df: DataFrame,
    city: str = "city",
    x: str = "x",
    y: str = "y",
    rules: A.ZoneRules = A.SANTIAGO_ZONES,
    into: str = "pig_location_filter",
) -> DataFrame:
    name = F.coalesce(F.col(city), F.lit(rules.unknown))
    return df.withColumn(
        into,
        F.struct(name.alias("ciudad"), A.zone(F.col(city), F.col(x), F.col(y), rules).alias("zona")),
    )


def _event_group(
    tipo: Column, subkind: Column, mapping: Mapping[str, str] = A.PRIORITIES, default: str = A.DEFAULT_PRIORITY
) -> Column:
    return F.struct(
        tipo.alias("tipo"),
        A.upper_or_empty(subkind).alias("subtipo"),
        A.priority(tipo, mapping, default).alias("prioridad"),
    )


def _source_timestamp(ms: Column) -> Column:
    """A publication time of 0 counts as missing."""
    return F.when(ms != 0, TP.epoch_ms_to_utc(ms))


def flat_to_raw(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """The raw table from flat columns: whitelisted fields, point and stamps."""
    return conform(
        df.withColumns(
            {
                "location": A.geo_point(F.col(x), F.col(y)),
                "source_timestamp": _source_timestamp(F.col("pubMillis")),
                "ingestion_timestamp": F.current_timestamp(),
            }
        ),
        RAW,
    )


def flat_to_processed(
    df: DataFrame, ts: Column | str | None = None, x: str = "x", y: str = "y"
) -> DataFrame:
    """All columns passed through, plus the three groups, the point and the stamps."""
    out = TP.with_time_filter(with_location_filter(with_event_filter(df), x=x, y=y), ts)
    return out.withColumns(
        {
            "location": A.geo_point(F.col(x), F.col(y)),
            "source_timestamp": _source_timestamp(F.col("pubMillis")),
            "ingestion_timestamp": F.current_timestamp(),
        }
    ).drop(x, y)


# Fields whose runtime type matters stay VARIANT, under a v_ name.
_AS_IS = ("type", "subtype", "city", "location", "pubMillis")
_SPOT = "struct<x:variant,y:variant,lat:double,lon:double>"


def _picked(
    df: DataFrame,
    alert: str,
    text: list[str],
    ints: list[str],
    floats: list[str],
    spot: str = "variant",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Extract every needed field in one pass over the document.

    A field that does not fit its type is NULL by itself; the whole struct is
    NULL only for a document that is no object.
    """
    kinds = {n: "string" for n in text} | {n: "int" for n in ints} | {n: "float" for n in floats}
    kinds |= {n: "variant" for n in _AS_IS} | {"location": spot}
    wanted = "struct<" + ",".join(f"`{n}`:{kind}" for n, kind in kinds.items()) + ">"
    doc = F.col("__doc")
    columns = [F.col(f"__doc.{n}").alias(f"v_{n}" if n in _AS_IS else n) for n in kinds]
    # A generator's output is not copied into the filters that read it, so that
    # selecting good or rejected rows does not extract the document again.
    once = F.explode(F.array(F.try_variant_get(F.col(alert), "$", wanted)))
    return df.select("mongo_id", alert, *keep, once.alias("__doc")).select(
        "mongo_id", alert, *keep, doc.isNotNull().alias("is_object"), *columns
    )


def _text(name: str) -> Column:
    return F.try_variant_get(F.col(f"v_{name}"), "$", "string").alias(name)


def _times(df: DataFrame) -> DataFrame:
    """``pubMillis``, its UTC instant, and a warning when it cannot be used."""
    value, name = F.col("v_pubMillis"), F.col("t_pubMillis")
    whole, real, us = F.col("pubMillis"), F.col("__real"), F.col("__us")
    df = (
        df.withColumn("t_pubMillis", V.type_name(value))
        .withColumns(
            {
                "pubMillis": F.when(V.is_numeric(name), F.try_variant_get(value, "$", "bigint")),
                "__real": F.try_variant_get(value, "$", "double"),
            }
        )
        .withColumn(
            "__us",
            F.when(
                (real != 0) & whole.between(TP.MIN_EPOCH_MS, TP.MAX_EPOCH_MS),
                whole * 1000 + F.rint((real - whole) * 1000).cast("bigint"),
            ),
        )
    )
    # Absent, null and zero times are no mistakes; name is NULL for an absent one.
    bad = us.isNull() & (name != "VOID") & (whole.isNull() | (real != 0))
    return df.withColumns(
        {
            "source_timestamp": F.timestamp_micros(us),
            "ingestion_timestamp": F.current_timestamp(),
            "warning": F.when(bad, "pubMillis_unusable"),
        }
    )


def to_raw(df: DataFrame, alert: str = "alert", keep: Sequence[str] = ()) -> DataFrame:
    """Raw table rows from documents, with ``reject_reason`` and ``warning``; other columns to ``keep`` stay.

    Coordinates given as text are parsed; a bad point or time leaves its
    column NULL and keeps the row. A number as ``location`` rejects the row.
    """
    text = [n for n in RAW_TEXT if n not in _AS_IS]
    spot = F.col("v_location")
    df = (
        _times(_picked(df, alert, text, RAW_INT, RAW_FLOAT, keep=keep))
        .withColumn("spot", F.try_variant_get(spot, "$", _SPOT))
        .withColumns(
            {n: _text(n) for n in RAW_TEXT if n in _AS_IS}
            | {"x": V.parse_number(F.col("spot.x")), "y": V.parse_number(F.col("spot.y"))}
        )
    )
    reason = F.when(~F.col("is_object"), "alert_not_object").when(
        V.is_numeric(V.type_name(spot)) & (F.try_variant_get(spot, "$", "double") != 0),
        "location_not_object",
    )
    df = df.withColumns({"location": A.geo_point(F.col("x"), F.col("y")), "reject_reason": reason})
    return df.select(*[f.name for f in RAW.fields], alert, "reject_reason", "warning", *keep)


def to_processed(
    df: DataFrame,
    ts: Column | str | None = None,
    alert: str = "alert",
    rules: A.ZoneRules = A.SANTIAGO_ZONES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Processed rows from documents, with ``reject_reason`` and ``warning``; other columns to ``keep`` stay.

    ``ts`` (naive UTC column) replaces the processing time in the time group;
    naming ``source_time`` uses the document's own publication time.
    """
    text = [n for n in PROCESSED_TEXT if n not in _AS_IS]
    # A location that is no object is a NULL struct here, without coordinates.
    x, y = F.col("v_location.x"), F.col("v_location.y")
    df = _times(_picked(df, alert, text, PROCESSED_INT, [], _SPOT, keep=keep)).withColumns(
        {n: _text(n) for n in PROCESSED_TEXT if n in _AS_IS}
        | {
            "has_point": x.isNotNull() & y.isNotNull(),
            "p_x": F.try_variant_get(x, "$", "double"),
            "p_y": F.try_variant_get(y, "$", "double"),
            "numeric": V.is_numeric(V.type_name(x)) & V.is_numeric(V.type_name(y)),
        }
    )
    has_point, given = F.col("has_point"), F.col("v_city")
    for axis, other in (("x", "lon"), ("y", "lat")):
        df = df.withColumn(f"l_{axis}", F.when(has_point, F.col(f"p_{axis}")).otherwise(F.col(f"v_location.{other}")))
    reason = (
        F.when(~F.col("is_object"), "alert_not_object")
        .when(~V.is_text(V.type_name(F.col("v_type"))), "type_not_text")
        .when(~V.is_text(V.type_name(F.col("v_subtype"))), "subtype_not_text")
        .when(
            has_point,
            F.when(~V.is_text(V.type_name(given)), "city_not_text").when(
                ~F.col("numeric") & A.is_core_city(F.col("city"), rules), "coordinates_not_numeric"
            ),
        )
    )
    df = df.withColumn("__tipo", A.upper_or_empty(F.col("type")))
    name = F.when(given.isNull(), rules.unknown).otherwise(F.col("city"))
    if isinstance(ts, str) and ts == "source_time":
        ts = TP.ntz_of_micros(F.col("__us"))
    df = df.withColumns(
        {
            "pig_event_filter": _event_group(F.col("__tipo"), F.col("subtype")),
            "pig_location_filter": F.struct(
                name.alias("ciudad"),
                A.zone(F.col("city"), F.col("p_x"), F.col("p_y"), rules, has_point).alias("zona"),
            ),
            # Without x and y the object stays what it is: a point if it has lat and lon.
            "location": A.geo_point(F.col("l_x"), F.col("l_y"), cast=False),
            "reject_reason": reason,
        }
    )
    df = TP.with_time_filter(df, ts)
    if alert != "alert":
        df = df.withColumnRenamed(alert, "alert")
    return df.select(*[f.name for f in PROCESSED.fields], "reject_reason", "warning", *keep)


def with_local_times(df: DataFrame, alert: str = "alert", tz: str = TP.SANTIAGO) -> DataFrame:
    """Write local times into the document itself, as done before it is stored.

    Adds ``_processed_at``, ``pubMillis_santiago`` (when the time is a number,
    0 included) and ``reportMillis_santiago`` in every comment that has a
    time. Documents that are no object stay as they are.
    """

    def local_text(value: Column) -> Column:
        return TP.iso_naive(TP.epoch_ms_to_local(V.number(value), tz, fractional=True))

    def comment(c: Column, text: Column) -> Column:
        return F.when(text.isNotNull(), _put(c, {"reportMillis_santiago": text.cast("variant")})).otherwise(c)

    doc = F.col(alert)
    published = local_text(V.field(doc, "pubMillis"))
    comments = F.try_variant_get(doc, "$.comments", "array<variant>")
    texts = F.transform(F.col("__listed"), lambda c: local_text(V.field(c, "reportMillis")))
    df = df.withColumn("__listed", comments).withColumns(
        {
            "__published": published.cast("variant"),
            "__comments": F.to_variant_object(F.zip_with(F.col("__listed"), texts, comment)),
            "__at": TP.to_local(TP.utc_now(), tz).cast("variant"),
        }
    )
    added = {
        "_processed_at": F.col("__at"),
        "pubMillis_santiago": F.col("__published"),
        "comments": F.col("__comments"),
    }
    return df.withColumn(alert, F.coalesce(_put(doc, added), doc)).drop(
        "__listed", "__published", "__comments", "__at"
    )


def _put(doc: Column, fields: Mapping[str, Column]) -> Column:
    """The object with the non-NULL ``fields`` set; NULL when ``doc`` is no object."""

    def stays(name: Column, _: Column) -> Column:
        return reduce(and_, [(name != field) | value.isNull() for field, value in fields.items()])

    names = F.array(*[F.lit(n) for n in fields])
    new = F.map_filter(
        F.map_from_arrays(names, F.array(*fields.values())), lambda _, value: value.isNotNull()
    )
    return F.to_variant_object(F.map_concat(F.map_filter(V.as_object(doc), stays), new))
