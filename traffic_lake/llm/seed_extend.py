"""Removal of repeated passages by seed and extend.

A window is ``L`` consecutive words of one text. A word goes if a window that
covers it also starts in a text with a smaller id.

1. Seeds: winnowed anchors of ``SEED`` words (``anchors.py``) that occur more
   than once are joined.
2. Extension: around a seed, each window that has the seed as its anchor is the
   seed extended to the left by some words and to the right by the rest. Equal
   surroundings collapse to one class with its smallest id before a shuffle.
   The extensions of the classes of a seed are then matched by its hash and a
   64-bit digest of their words, with partial minima, so neither a frequent seed
   nor a frequent passage is ever gathered, and no pairs are made.
3. Matched windows that overlap or touch are merged into maximal repeats.

Words compare by 64-bit hashes. NULL and blank texts have no words and stay as
they are. A NULL id counts as larger than all others; rows with equal ids
don't remove each other's words. One result row per input row; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import bitmap, has, mark_repeats, marked_surroundings, merged
from .common import arrow_out, arrow_rows, dropped, numbered, scratch, stored, words_of

#: Words of a seed.
SEED = 5


def as_words(body: bytes) -> np.ndarray:
    words = body.split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def passages(starts: list[int], L: int) -> list[tuple[int, int]]:
    """Maximal half-open word spans that the windows at ``starts`` cover."""
    out: list[tuple[int, int]] = []
    for s in sorted(starts):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], s + L)
        else:
            out.append((s, s + L))
    return out


def _finish(batches, L: int):
    for rid, doc_id, body, starts in (r for b in batches for r in arrow_rows([b], "rid", "doc_id", "body", "starts")):
        words = body.split()
        spans = passages(starts or [], L)
        kept, upto = [], 0
        for a, b in spans:
            kept += words[upto:a]
            upto = b
        kept += words[upto:]
        yield rid, doc_id, len(words), len(words) - len(kept), [{"start": a, "end": b} for a, b in spans], b" ".join(kept)


def remove_repeated_passages(docs: DataFrame, L: int = 13, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``, a stored table: rid, doc_id, n_words, n_removed, spans (in words), kept (words joined by a space)."""
    spark = docs.sparkSession
    path = scratch(spark, "passages")
    k = min(SEED, L)
    marked = stored(mark_repeats(numbered(docs, text, id_col), as_words, L, k, path), f"{path}/marked")
    touched = marked.filter("picks IS NOT NULL")

    def surroundings(batches):
        return merged(marked_surroundings(batches, as_words, L, k))

    # A seed's hash goes with each digest: windows are equal if both are, as are surroundings.
    places = touched.mapInArrow(surroundings, "h long, c long, windows binary, rid long, doc_id long, a long")
    classes = stored(
        places.groupBy("h", "c", "windows").agg(
            F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.max(F.col("doc_id").isNull()).alias("unknown")
        ),
        f"{path}/classes",
    )
    # With one kind of surroundings, a seed's extensions are known to match; else, or where the
    # bitmap of those others can't tell, they are matched one by one.
    several = stored(classes.groupBy("h").count().filter("count > 1").select("h"), f"{path}/several")
    differing = spark.sparkContext.broadcast(bitmap(several))
    later = "least < high OR (least IS NOT NULL AND unknown)"
    n_windows = (F.length("windows") / 8).cast("int")

    def uniform(batches):
        for b in batches:
            yield b.filter(pa.array(~has(differing.value, b.column("h").to_numpy().view(np.uint64))))

    found = F.transform(F.sequence(F.lit(0), n_windows - 1), lambda i: F.struct(i.alias("i"), F.col("least").alias("least")))
    alike = classes.mapInArrow(uniform, classes.schema).withColumn("least", F.col("low")).filter(later).select("h", "c", found.alias("found"))

    def extensions(held=None) -> DataFrame:
        """Each window of the classes of the other seeds; with a bitmap only those that it may hold."""
        kept = ["h", "c", "low", "high", "unknown"]

        def split(batches):
            for b in batches:
                b = b.filter(pa.array(has(differing.value, b.column("h").to_numpy().view(np.uint64))))
                if not b.num_rows:
                    continue
                windows = b.column("windows")
                ends = np.frombuffer(windows.buffers()[1], np.int32)[windows.offset : windows.offset + b.num_rows + 1] // 8
                ends, first = ends - ends[0], ends[0]
                w = np.frombuffer(windows.buffers()[2], np.uint64)[first : first + ends[-1]]
                use = np.arange(len(w)) if held is None else np.flatnonzero(has(held.value, w))
                row = np.searchsorted(ends, use, "right") - 1
                i, w, rows = pa.array((use - ends[row]).astype(np.int32)), pa.array(w[use].view(np.int64)), pa.array(row)
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(rows) for c in kept), i, w], [*kept, "i", "w"])

        return classes.mapInArrow(lambda b: merged(split(b)), "h long, c long, low long, high long, unknown boolean, i int, w long")

    lowest = stored(
        extensions()
        .groupBy("h", "w")
        .agg(F.min("low").alias("least"), F.max("high").alias("high"), F.max("unknown").alias("unknown"))
        .filter(later)
        .select("h", "w", "least"),
        f"{path}/lowest",
    )
    # Most extensions match no other: a bitmap, sized by those that do, keeps them from the join.
    may_match = spark.sparkContext.broadcast(bitmap(lowest, "w"))
    matched = (
        extensions(may_match)
        .select("h", "c", "high", "unknown", "i", "w")
        .join(lowest, ["h", "w"])
        .filter("least < high OR unknown")
        .groupBy("h", "c")
        .agg(F.collect_list(F.struct("i", "least")).alias("found"))
    )
    matched = stored(matched.unionByName(alike), f"{path}/matched")
    dropped(spark, *(f"{path}/{t}" for t in ("repeated", "picks", "classes", "several", "lowest")))
    starts = (
        places.select("h", "c", "rid", "doc_id", "a")
        .join(matched, ["h", "c"])
        .select(
            "rid",
            F.transform(
                F.filter("found", lambda f: F.col("doc_id").isNull() | (f["least"] < F.col("doc_id"))), lambda f: F.col("a") + f["i"]
            ).alias("starts"),
        )
        .groupBy("rid")
        .agg(F.flatten(F.collect_list("starts")).alias("starts"))
    )

    def finish(batches):
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        schema = pa.schema(
            [("rid", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(span)), ("kept", pa.binary())]
        )
        return arrow_out(schema, _finish(batches, L))

    result = "rid long, doc_id long, n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept binary"
    starts = stored(starts, f"{path}/starts")  # what led to them can go before the texts are shuffled
    dropped(spark, f"{path}/matched")
    cut = touched.join(starts.hint("shuffle_hash"), "rid", "left").select("rid", "doc_id", "body", "starts").mapInArrow(finish, result)
    words = words_of(F.col("body").cast("string"))
    whole = marked.filter("picks IS NULL").select(
        "rid",
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_removed"),
        F.from_json(F.lit("[]"), "array<struct<start: long, end: long>>").alias("spans"),
        F.array_join(words, " ").cast("binary").alias("kept"),
    )
    return cut.unionByName(whole)
