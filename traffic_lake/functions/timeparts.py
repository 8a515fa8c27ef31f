"""Epoch, zone and ISO-text column functions.

Wall-clock values travel as ``timestamp_ntz`` and zones are applied with
``convert_timezone``, so no result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The feed's home zone and the years a timestamp may fall in.
SANTIAGO = "America/Santiago"
MIN_EPOCH_MS = -62135596800000  # 0001-01-01T00:00:00Z
MAX_EPOCH_MS = 253402300799999  # 9999-12-31T23:59:59.999Z
DAY_MS = 86400000

# Weekday names, Monday first.
WEEKDAYS = ("Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo")

# Part of the day of each hour, 0 to 23.
DAY_PARTS = (
    ["Madrugada"] * 6 + ["Mañana"] * 4 + ["Día"] * 6 + ["Tarde"] * 4 + ["Noche"] * 4
)


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def _micros(ms: Column, fractional: bool, margin: int = 0) -> Column:
    """Epoch milliseconds as whole microseconds, NULL outside years 1-9999
    less ``margin`` milliseconds at both ends."""
    us = F.rint(ms * 1000).cast("bigint") if fractional else ms.cast("bigint") * 1000
    return F.when(ms.between(MIN_EPOCH_MS + margin, MAX_EPOCH_MS - margin), us)


def ntz_of_micros(us: Column) -> Column:
    """Epoch microseconds as a UTC wall-clock value."""
    return _epoch() + F.expr("INTERVAL '0.000001' SECOND") * us


def utc_ntz(ts: Column) -> Column:
    """An instant as its UTC wall-clock value."""
    return ntz_of_micros(F.unix_micros(ts))


def utc_now() -> Column:
    return utc_ntz(F.current_timestamp())


def epoch_ms_to_utc(ms: Column, fractional: bool = False) -> Column:
    """Epoch milliseconds to an instant; ``fractional`` accepts DOUBLE input."""
    return F.timestamp_micros(_micros(ms, fractional))


def epoch_ms_to_utc_ntz(ms: Column, fractional: bool = False) -> Column:
    return ntz_of_micros(_micros(ms, fractional))


def epoch_ms_to_local(ms: Column, tz: str = SANTIAGO, fractional: bool = False) -> Column:
    """Epoch milliseconds to the naive local time of ``tz``.

    NULL within a day of the ends of the years 1-9999, where the zone shift
    could leave them.
    """
    return to_local(ntz_of_micros(_micros(ms, fractional, DAY_MS)), tz)


def to_local(utc: Column, tz: str | None = SANTIAGO) -> Column:
    """Naive UTC to the naive local time of ``tz``; None leaves it unchanged."""
    if tz is None:
        return utc
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def iso_naive(ntz: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` plus six fraction digits only when non-zero."""
    return _iso(ntz.cast("string"))


def _iso(text: Column) -> Column:
    # Casting drops trailing zeros of the fraction, and the point with them.
    width = F.when(F.length(text) == 19, 19).otherwise(26)
    return F.translate(F.rpad(text, width, F.lit("0")), " ", "T")


def iso_utc(ts: Column) -> Column:
    """An instant as ISO text with ``+00:00``."""
    return F.concat(iso_naive(utc_ntz(ts)), F.lit("+00:00"))


def offset_text(utc: Column, local: Column) -> Column:
    """The ``+HH:MM`` offset between two wall clocks of one instant."""
    return _offset((local - utc).cast("interval minute").cast("int"))


def _offset(minutes: Column) -> Column:
    # The clock time of that many minutes past midnight spells the offset.
    clock = _epoch() + F.expr("INTERVAL '1' MINUTE") * F.abs(minutes)
    return F.concat(
        F.when(minutes < 0, "-").otherwise("+"), F.substring(clock.cast("string"), 12, 5)
    )


def iso_with_offset(utc: Column, tz: str = SANTIAGO) -> Column:
    """Naive UTC as local ISO text carrying its offset."""
    local = to_local(utc, tz)
    return F.concat(iso_naive(local), offset_text(utc, local))


def _named(names: list[str] | tuple[str, ...], index: Column) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), index)


def day_part(utc: Column, tz: str | None = SANTIAGO) -> Column:
    """Name of the part of the local day; ``tz=None`` means already local."""
    return _named(DAY_PARTS, F.hour(to_local(utc, tz)))


def weekday_es(utc: Column, tz: str | None = SANTIAGO) -> Column:
    """Spanish weekday name of the local day."""
    return _named(WEEKDAYS, F.weekday(to_local(utc, tz).cast("date")))


def with_time_filter(
    df: DataFrame,
    ts: Column | str | None = None,
    tz: str = SANTIAGO,
    into: str = "pig_time_filter",
) -> DataFrame:
    """Add the time group; ``ts`` is naive UTC, None means processing time."""
    utc = utc_now() if ts is None else (F.col(ts) if isinstance(ts, str) else ts)
    local = F.col("__local")
    # Values read more than once get a column, so each is computed once per row
    # and the generated code stays small enough to be compiled to machine code.
    return (
        df.withColumn("__utc", utc)
        .withColumn("__local", to_local(F.col("__utc"), tz))
        .withColumns(
            {
                "__hour": F.hour(local),
                "__date": local.cast("date"),
                "__text": local.cast("string"),
                "__minutes": (local - F.col("__utc")).cast("interval minute").cast("int"),
            }
        )
        .withColumn(
            into,
            F.struct(
                _named(DAY_PARTS, F.col("__hour")).alias("categoria_dia"),
                _named(WEEKDAYS, F.weekday("__date")).alias("dia_semana"),
                F.col("__hour").alias("hora"),
                F.col("__date").alias("fecha"),
                F.concat(_iso(F.col("__text")), _offset(F.col("__minutes"))).alias("timestamp_chile"),
            ),
        )
        .drop("__utc", "__local", "__hour", "__date", "__text", "__minutes")
    )


def localize_comments(df: DataFrame, comments: str = "comments", tz: str = SANTIAGO) -> DataFrame:
    """Give every comment struct ``reportMillis_santiago``; no time gives NULL.

    One pass per step over the list, since an expression inside a lambda is
    computed again wherever it is used.
    """
    listed = F.col(comments)
    clocks = F.transform(listed, lambda c: epoch_ms_to_local(c["reportMillis"], tz).cast("string"))
    texts = F.transform(clocks, _iso)
    return df.withColumn(
        comments, F.zip_with(listed, texts, lambda c, text: c.withField("reportMillis_santiago", text))
    )


def with_processed_at(df: DataFrame, tz: str = SANTIAGO, into: str = "_processed_at") -> DataFrame:
    """Stamp rows with the naive local processing time."""
    return df.withColumn(into, to_local(utc_now(), tz))
