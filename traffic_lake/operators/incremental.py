"""Reads by key mark, resume marks and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variants as V


def _edge(df: DataFrame, key: str, n: int, newest: bool) -> DataFrame:
    """The first ``n`` rows by key, in order.

    A pass over the key column alone finds the key of the last row wanted; the
    rows are then read with that bound pushed into the scan. On stored,
    time-ordered keys the wide columns of nearly all row groups stay unread.
    """
    order = F.desc(key) if newest else F.asc(key)
    keys = df.select(key).orderBy(order).limit(n)
    bound = keys.agg(F.min(key) if newest else F.max(key)).scalar()
    within = F.col(key) >= bound if newest else F.col(key) <= bound
    return df.filter(within).orderBy(order).limit(n)


def read_after(df: DataFrame, key: str, mark=None, limit: int | None = None) -> DataFrame:
    """Rows beyond ``mark``; with ``limit`` the first ones in ascending key order.

    ``mark`` is a value or a scalar-subquery Column; on a stored key column it
    is pushed into the file scan. Without a limit nothing depends on the order,
    and none is made: a total sort would shuffle the whole backlog.
    """
    out = df if mark is None else df.filter(F.col(key) > mark)
    return out if limit is None else _edge(out, key, limit, newest=False)


def high_water_mark(target: DataFrame, key: str = "mongo_id"):
    """The greatest key of the target, None when it is empty."""
    return target.agg(F.max(key)).first()[0]


def last_ingested(key: str = "mongo_id", stamp: str = "ingestion_timestamp") -> Column:
    """Aggregate: the key of the row ingested last; equal stamps fall to the greater key."""
    return F.max_by(key, F.struct(stamp, key))


def last_ingested_key(target: DataFrame, key: str = "mongo_id", stamp: str = "ingestion_timestamp"):
    """The key of the row ingested last, None when the target is empty."""
    return target.agg(last_ingested(key, stamp)).first()[0]


def recent_sample(df: DataFrame, key: str = "mongo_id", n: int = 100) -> DataFrame:
    """The newest ``n`` rows (all of them when there are fewer)."""
    return _edge(df, key, n, newest=True)


def document_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def example_fields(df: DataFrame, alert: str = "alert", key: str | None = None) -> DataFrame:
    """Top-level field names of one document: any one, or the oldest by ``key``."""
    one = df.limit(1) if key is None else _edge(df.select(key, alert), key, 1, newest=False)
    return one.select(F.explode(F.map_keys(V.as_object(F.col(alert)))).alias("field"))
