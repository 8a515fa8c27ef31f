"""Dashboard questions: facets, time histogram, reconciliation of two tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import work_dir

# Parts of a day whose digests are compared before its keys are.
BUCKETS = 256
# Differing days up to which partitions are read by a list of them; more are joined.
LISTED_DAYS = 1000


def facet_counts(df: DataFrame, cols: Sequence[str], k: int | None = None) -> DataFrame:
    """Rows per combination of ``cols`` (name, or dotted path into a group).

    With ``k`` the ``k`` largest, ties by facet value.
    """
    names = [c.split(".")[-1] for c in cols]
    counts = df.groupBy(*[F.col(c).alias(n) for c, n in zip(cols, names)]).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts if k is None else counts.orderBy(F.desc("n"), *names).limit(k)


def date_histogram(
    df: DataFrame,
    ts: str = "source_timestamp",
    width: str = "1 hour",
    by: Sequence[str] = (),
    watermark: str | None = None,
) -> DataFrame:
    """Rows per tumbling window of ``width``; rows without a time are not counted."""
    if watermark is not None:
        df = df.withWatermark(ts, watermark)
    return (
        df.groupBy(F.window(ts, width).alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("bucket"), *by, "n")
    )


def key_presence(raw: DataFrame, processed: DataFrame, key: str = "mongo_id") -> DataFrame:
    """Rows per key on each side: ``key, raw_n, processed_n``.

    One tagged union and one aggregation instead of a full outer join: a key
    repeated on both sides is collapsed by partial aggregation and never
    multiplies.
    """
    one, none = F.lit(1), F.lit(0)
    sides = raw.select(key, one.alias("r"), none.alias("p")).unionByName(
        processed.select(key, none.alias("r"), one.alias("p"))
    )
    return sides.groupBy(key).agg(F.sum("r").alias("raw_n"), F.sum("p").alias("processed_n"))


def reconcile(raw: DataFrame, processed: DataFrame, key: str = "mongo_id") -> DataFrame:
    """One row: rows and keys per side and keys missing on either side."""
    raw_n, processed_n = F.col("raw_n"), F.col("processed_n")
    return key_presence(raw, processed, key).agg(
        F.coalesce(F.sum("raw_n"), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum("processed_n"), F.lit(0)).alias("processed_rows"),
        F.count_if((raw_n > 0) & (processed_n > 0)).alias("in_both"),
        F.count_if((raw_n > 0) & (processed_n == 0)).alias("only_raw"),
        F.count_if((raw_n == 0) & (processed_n > 0)).alias("only_processed"),
    )


def _digests(raw: DataFrame, processed: DataFrame, key: str, by: Sequence[Column]) -> DataFrame:
    """Per node: rows of each side, and ``same``, whether both hold the same keys.

    The digest of a node is the exclusive or of its keys' hashes and the sum of their lower
    halves: over both sides they cancel out if the keys are the same ones.
    """
    h, low = F.xxhash64(key), F.xxhash64(key).bitwiseAND(0xFFFFFFFF)

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*by, h.alias("__x"), (low * sign).alias("__s"), F.lit(sign).alias("__side"))

    names = [f"__{i}" for i in range(len(by))]
    both = side(raw, 1).unionByName(side(processed, -1)).toDF(*names, "__x", "__s", "__side")
    rows = {"raw_n": F.count_if(F.col("__side") > 0), "processed_n": F.count_if(F.col("__side") < 0)}
    nodes = both.groupBy(*names).agg(*(n.alias(c) for c, n in rows.items()), F.bit_xor("__x").alias("__x"), F.sum("__s").alias("__s"))
    same = (F.col("raw_n") == F.col("processed_n")) & (F.col("__x") == 0) & (F.col("__s") == 0)
    return nodes.withColumn("same", same).drop("__x", "__s")


def reconcile_by_digest(
    raw: DataFrame, processed: DataFrame, key: str = "mongo_id", day: str = "key_date", buckets: int = BUCKETS
) -> DataFrame:
    """:func:`reconcile` of tables that hold a key once, as ``read_current`` gives them, partitioned by ``day`` or a column that follows from it.

    A tree of digests is compared: a pass without a shuffle of keys tells the days that differ,
    a second one over these days alone the parts of them that do, and
    keys are shuffled for those parts only. The digests are stored; up to ``LISTED_DAYS`` days reach the driver,
    so that only their partitions are read, and more are joined.
    """
    spark, path = raw.sparkSession, work_dir(raw.sparkSession, "digests")
    _digests(raw, processed, key, [F.col(day)]).write.parquet(f"{path}/days")
    days = spark.read.parquet(f"{path}/days")
    alike_n = F.sum(F.when(F.col("same"), F.col("raw_n")))
    raw_n, processed_n, alike = days.agg(*(F.coalesce(n, F.lit(0)) for n in (F.sum("raw_n"), F.sum("processed_n"), alike_n))).first()
    differing = days.filter("NOT same").select(F.col("__0").alias("__day"))
    differ = [d["__day"] for d in differing.limit(LISTED_DAYS + 1).collect()]
    known = [d for d in differ if d is not None]
    held = (F.col(day).isin(known) if known else F.lit(False)) | (F.col(day).isNull() if None in differ else F.lit(False))

    def left(df: DataFrame) -> DataFrame:
        if len(differ) > LISTED_DAYS:
            return df.join(differing, F.col(day).eqNullSafe(F.col("__day")), "left_semi")
        return df.filter(held)

    bucket = F.pmod(F.xxhash64(key), F.lit(buckets))
    raw_left, processed_left = left(raw), left(processed)
    # Stored, so that its size is known: it's broadcast below Spark's threshold only.
    _digests(raw_left, processed_left, key, [F.col(day), bucket]).write.parquet(f"{path}/parts")
    parts = spark.read.parquet(f"{path}/parts")
    other = parts.filter("NOT same").select(F.col("__0").alias("__day"), F.col("__1").alias("__bucket"))

    def keys(df: DataFrame) -> DataFrame:
        return df.join(other, F.col(day).eqNullSafe(F.col("__day")) & (bucket == F.col("__bucket")), "left_semi").select(key)

    below = reconcile(keys(raw_left), keys(processed_left), key)
    more = F.coalesce(parts.filter("same").agg(F.sum("raw_n")).scalar(), F.lit(0))
    return below.select(
        F.lit(raw_n).cast("bigint").alias("raw_rows"),
        F.lit(processed_n).cast("bigint").alias("processed_rows"),
        (F.col("in_both") + F.lit(alike) + more).alias("in_both"),
        "only_raw",
        "only_processed",
    )
