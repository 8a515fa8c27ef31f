"""Row rejection, the raw-purity gate and per-cycle counters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import variants as V
from ..schemas import DERIVED_FIELDS


class RawPurityError(ValueError):
    """Source documents already hold derived fields."""


# What a dead letter keeps: the document as it came, and why it was rejected.
DEAD_LETTER = ("mongo_id", "alert", "reject_reason", "warning")


def split_rejects(df: DataFrame, reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(good rows without the reason column, rejected rows as dead letters).

    Dead letters hold the document itself; values derived from it are left out.
    """
    bad = df.filter(F.col(reason).isNotNull())
    if "alert" in df.columns:
        bad = bad.select(*[c for c in DEAD_LETTER if c in df.columns and c != reason], reason)
    return df.filter(F.col(reason).isNull()).drop(reason), bad


def field_counts(df: DataFrame, fields: Iterable[str], alert: str = "alert") -> DataFrame:
    """One row: how many documents hold each field, counted in a single pass."""
    doc = F.col(alert)
    return df.agg(*[F.count_if(V.has_field(doc, name)).alias(name) for name in fields])


def processed_field_hits(
    df: DataFrame, fields: Iterable[str] = DERIVED_FIELDS, alert: str = "alert"
) -> tuple[DataFrame, Observation]:
    """Flag rows that hold derived fields; the rows are kept.

    Adds one boolean ``has_<field>`` column per field. The Observation gives
    the counts once an action on the returned frame has finished.
    """
    fields = list(fields)
    doc = F.col(alert)
    flagged = df.withColumns({f"has_{name}": V.has_field(doc, name) for name in fields})
    seen = Observation()
    return (
        flagged.observe(seen, *[F.count_if(F.col(f"has_{n}")).alias(n) for n in fields]),
        seen,
    )


def assert_raw_only(
    df: DataFrame, forbidden: Iterable[str] = DERIVED_FIELDS, alert: str = "alert"
) -> None:
    """Raise :class:`RawPurityError` when any document holds a forbidden field.

    Only one row of counters reaches the driver.
    """
    counts = field_counts(df, forbidden, alert).first().asDict()
    hits = {name: n for name, n in counts.items() if n}
    if hits:
        raise RawPurityError(f"derived fields found in source documents: {hits}")


def cycle_counters(reason: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("read_n"),
        F.count_if(reason.isNull()).alias("converted_n"),
        F.count_if(reason.isNotNull()).alias("failed_n"),
    ]


def observe_cycle(df: DataFrame, reason: str = "reject_reason") -> tuple[DataFrame, Observation]:
    """Count read, converted and failed rows while the frame is being written."""
    seen = Observation()
    return df.observe(seen, *cycle_counters(F.col(reason))), seen
