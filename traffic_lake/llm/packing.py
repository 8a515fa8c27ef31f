"""Packing into optimal length buckets.

Texts are cut into sequences of at most ``longest`` words, so the global
histogram of lengths has at most ``longest + 1`` rows, whatever the corpus. A
dynamic program over it picks the bucket boundaries that need the least padding.
Batches inside a bucket hold as many sequences as fit the token budget when each
is padded to the bucket's boundary; only the last one of a bucket is short.

Sequences are numbered without gathering a bucket: they are dealt to shards by
hash, numbered there, and shifted by the counts of the shards before.

NULL and blank texts are one empty sequence. Repeated rows are packed as often
as they occur. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, scratch, stored, words_of

LONGEST, BUCKETS, BUDGET = 4096, 16, 65536
#: Sequences of a shard.
SHARD = 1 << 16


def boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Ascending boundaries, at most ``buckets``, of least padding; the last one is the greatest length."""
    order = np.argsort(lengths)
    length = np.asarray(lengths, np.int64)[order]
    count = np.concatenate(([0], np.cumsum(np.asarray(counts, np.int64)[order])))
    used = np.concatenate(([0], np.cumsum(np.asarray(counts, np.int64)[order] * length)))
    n = len(length)
    # best[j]: least padding of the j shortest lengths; a bucket of lengths i..j-1 pads to length[j-1]
    best = np.full(n + 1, np.iinfo(np.int64).max // 4)
    best[0] = 0
    choice = []
    for _ in range(min(buckets, n)):
        new, pick = best.copy(), np.zeros(n + 1, np.int64)
        new[1:] = np.iinfo(np.int64).max // 4
        for j in range(1, n + 1):
            cost = best[:j] + (count[j] - count[:j]) * length[j - 1] - (used[j] - used[:j])
            pick[j] = np.argmin(cost)
            new[j] = cost[pick[j]]
        choice.append(pick)
        best = new
    out, j = [], n
    for pick in reversed(choice):
        if j:
            out.append(int(length[j - 1]))
            j = int(pick[j])
    return out[::-1]


def pack(
    docs: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, budget: int = BUDGET, text: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """One row per sequence of ``docs``, a stored table: doc_id, piece, start and n_tokens (words), bucket_len, batch, slot, padding.

    ``batch`` numbers the batches of one ``bucket_len``.
    """
    spark = docs.sparkSession
    path = scratch(spark, "packing")
    sizes = numbered(docs, text, id_col).select("rid", "doc_id", F.size(words_of(F.col("body").cast("string"))).cast("long").alias("n"))
    last = F.greatest(F.floor((F.col("n") - 1) / longest), F.lit(0)).cast("long")
    pieces = stored(
        sizes.select("rid", "doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece")).select(
            "rid",
            "doc_id",
            "piece",
            (F.col("piece") * longest).alias("start"),
            F.least(F.lit(longest).cast("long"), F.col("n") - F.col("piece") * longest).alias("n_tokens"),
        ),
        f"{path}/pieces",
    )
    histogram = pieces.groupBy("n_tokens").count().collect()  # at most longest + 1 rows
    if not histogram:
        edges = [0]
    else:
        edges = boundaries([r["n_tokens"] for r in histogram], [r["count"] for r in histogram], buckets)
    shards = 1 + sum(r["count"] for r in histogram) // SHARD
    bucket = F.element_at(F.filter(F.array(*(F.lit(e).cast("long") for e in edges)), lambda e: e >= F.col("n_tokens")), 1)
    dealt = pieces.withColumn("bucket_len", bucket).withColumn("shard", F.pmod(F.xxhash64("rid", "piece"), F.lit(shards)))
    before = Window.partitionBy("bucket_len").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(
        dealt.groupBy("bucket_len", "shard").count().select("bucket_len", "shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset")),
        f"{path}/offsets",
    )
    own = F.row_number().over(Window.partitionBy("bucket_len", "shard").orderBy("rid", "piece")) - 1
    fit = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("bucket_len"), F.lit(1)))).cast("long")
    return (
        dealt.withColumn("own", own)
        .join(offsets, ["bucket_len", "shard"])
        .withColumn("place", F.col("own") + F.col("offset"))
        .select(
            "doc_id",
            "piece",
            "start",
            "n_tokens",
            "bucket_len",
            F.floor(F.col("place") / fit).cast("long").alias("batch"),
            (F.col("place") % fit).alias("slot"),
            (F.col("bucket_len") - F.col("n_tokens")).alias("padding"),
        )
    )
