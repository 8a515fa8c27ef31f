"""Exact deduplication by most-significant-digit radix partitioning.

A round splits each open group by its documents' next bytes. One digit is a
string of successive bytes, wider in each round, so that the rounds grow with
the logarithm of the longest repeated text. A group with one member is done, as
is one whose texts end inside the digit; the rest goes on with the bytes not
yet read. Texts are compared byte by byte; no digest decides anything.

Digits are counted with partial sums, so a group of copies costs a row per
task; members learn their subgroup in a join with a stored table, whose skewed
keys can be split. No group is gathered, and no group of the first digits' size
is ever sorted.

NULL texts equal empty ones. Of equal texts the row with the largest id stays
(NULL ids are smaller than all others); if rows repeat, id included, the first
of them stays. One result row per input row; an empty table gives an empty
result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, scratch, stored

#: Bytes of the first digit, growth of the digits, bytes of the widest.
FIRST, GROWTH, WIDEST = 64, 4, 1 << 20


def exact_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``, a stored table: rid, doc_id, text_sha256, group (smallest rid in it), keep_id, group_size, kept."""
    path = scratch(docs.sparkSession, "radix")
    base = numbered(docs, text, id_col)
    open_rows = base.select("rid", "doc_id", F.sha2("body", 256).alias("text_sha256"), F.lit(0).cast("long").alias("group"), "body")
    width, turn, done = FIRST, 0, []
    while True:
        digit = F.substring("body", 1, width).alias("digit")
        groups = stored(
            open_rows.groupBy("group", digit)
            .agg(F.count("*").alias("group_size"), F.min("rid").alias("next"), F.max("doc_id").alias("keep_id"))
            .filter("group_size > 1"),
            f"{path}/groups-{turn}",
        )
        ended = F.col("next").isNull() | (F.length("digit") < width)
        split = stored(
            open_rows.withColumn("digit", digit)
            .join(groups.hint("shuffle_hash"), ["group", "digit"], "left")
            .select(
                "rid",
                "doc_id",
                "text_sha256",
                F.coalesce("next", "rid").alias("group"),
                F.coalesce("group_size", F.lit(1)).alias("group_size"),
                F.when(F.col("next").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                F.when(~ended, F.substring(F.col("body"), F.lit(width + 1), F.length("body"))).alias("body"),
            ),
            f"{path}/split-{turn}",
        )
        done.append(split.filter("body IS NULL").drop("body"))
        open_rows = split.filter("body IS NOT NULL").select("rid", "doc_id", "text_sha256", "group", "body")
        if open_rows.isEmpty():
            break
        width, turn = min(width * GROWTH, WIDEST), turn + 1
    rows = reduce(DataFrame.unionByName, done)
    # The row that stays is the one with the group's largest id. Only where that id repeats in the
    # group, which is rare, do later rows with it have to be told: they are few, and none by group.
    again = (
        rows.filter("group_size > 1 AND doc_id <=> keep_id")
        .groupBy("group")
        .agg(F.min("rid").alias("keeper"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("keeper", "group")
    )
    same = rows.filter("group_size > 1 AND doc_id <=> keep_id").select("rid", "group")
    later = stored(same.join(again, "group").filter("rid <> keeper").select("rid", F.lit(True).alias("later")), f"{path}/later")
    if later.isEmpty():
        return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return rows.join(later, "rid", "left").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & F.col("later").isNull()).drop("later")
