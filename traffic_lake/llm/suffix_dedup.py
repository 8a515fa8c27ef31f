"""Removal of long repeated substrings by interval expansion on a Burrows-Wheeler transform.

Texts are UTF-8 bytes. A byte goes if a string of ``L`` bytes that covers it
also starts anywhere else, in the same text or another one.

1. Anchors (``anchors.py``) leave the places where such a string can repeat.
2. Around each repeated anchor the run of its windows is a *context*. Equal
   contexts collapse to one with a count before they are shuffled, so copies
   cost a row per task.
3. The contexts of one anchor meet in one task. There the windows are the rows
   of a transform that is refined breadth first: each round extends every
   interval backward by the preceding byte (a stable sort by that byte, the
   transform's own step from last to first column), splits it where bytes
   differ and drops intervals of one occurrence, whose common length is then
   known to be below the round's. Lengths so appear in increasing order, and
   rounds stop at ``L``. What is left repeats.
4. An anchor with more than ``HOT`` different contexts isn't gathered: its
   windows are counted by a 128-bit digest with partial sums instead.

NULL and short texts lose nothing. Repeated rows are different places, so
each covers the other. Ids may be NULL or repeat; there is one result row per
input row. An empty table gives an empty result.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import mark_repeats, marked_runs
from .common import arrow_out, arrow_rows, numbered, scratch, stored

#: Bytes of an anchor.
ANCHOR = 64
#: Different contexts of one anchor that may meet in a task.
HOT = 4096
#: Context bytes a task gets.
TASK_BYTES = 6 << 20


def as_bytes(body: bytes) -> np.ndarray:
    return np.frombuffer(body, np.uint8)


def repeated_windows(text: np.ndarray, ends: np.ndarray, counts: np.ndarray, L: int) -> np.ndarray:
    """Which of the windows ``text[end-L:end]`` occur more than once, given how often each stands for itself."""
    repeated = counts > 1
    if not len(ends):
        return repeated
    first = min(8, L)
    key = np.zeros(len(ends), np.uint64)
    for back in range(1, first + 1):  # the first rounds at once: their bytes fit a machine word
        key = (key << np.uint64(8)) | text[ends - back].astype(np.uint64)
    window = np.argsort(key, kind="stable")
    group = np.concatenate(([0], np.cumsum(key[window][1:] != key[window][:-1])))
    del key

    def many(group):
        return np.bincount(group)[group] > 1

    keep = many(group)
    window, group = window[keep], group[keep]
    at = ends[window] - first
    for _ in range(first, L):
        if not len(at):
            return repeated
        before = text[at - 1]
        order = np.argsort(before, kind="stable")
        before, group, at, window = before[order], group[order], at[order] - 1, window[order]
        split = (before[1:] != before[:-1]) | (group[1:] != group[:-1])
        group = np.concatenate(([0], np.cumsum(split)))
        keep = many(group)
        if not keep.all():
            at, group, window = at[keep], group[keep], window[keep]
    repeated[window] = True
    return repeated


def _expand(batches, L: int):
    """Contexts of whole anchors in, repeated windows of each context out, as pairs first, last."""
    ids, texts, counts = [], [], []
    for batch in batches:
        for c, context, n in arrow_rows([batch], "c", "context", "n"):
            ids.append(c)
            texts.append(context)
            counts.append(n)
    if not ids:
        return
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    base = np.concatenate(([0], np.cumsum(sizes)))
    windows = sizes - L + 1
    owner = np.repeat(np.arange(len(ids)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    text = np.frombuffer(b"".join(texts), np.uint8)
    del texts
    hit = repeated_windows(text, base[owner] + offset + L, np.asarray(counts)[owner], L)
    owner, offset = owner[hit], offset[hit]
    if not len(owner):
        return
    cut = np.flatnonzero((owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)) + 1
    start = np.concatenate(([0], cut))
    stop = np.concatenate((cut, [len(owner)])) - 1
    for o, a, b in zip(owner[start].tolist(), offset[start].tolist(), offset[stop].tolist()):
        yield ids[o], a, b


def _finish(batches, L: int):
    for rid, doc_id, body, spans in (r for b in batches for r in arrow_rows([b], "rid", "doc_id", "body", "spans")):
        out = spans_of([(s["a"], s["b"] + L) for s in spans or []])
        kept, upto = [], 0
        for a, b in out:
            kept.append(body[upto:a])
            upto = b
        kept.append(body[upto:])
        yield rid, doc_id, len(body), sum(b - a for a, b in out), [{"start": a, "end": b} for a, b in out], b"".join(kept)


def spans_of(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open spans, sorted and merged where they overlap or touch."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(pairs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def remove_repeated_substrings(
    docs: DataFrame, L: int = 200, text: str = "text", id_col: str = "doc_id", hot: int = HOT
) -> DataFrame:
    """One row per row of ``docs``, a stored table: rid, doc_id, n_bytes, n_removed, spans (removed, in bytes) and kept (bytes)."""
    spark = docs.sparkSession
    path = scratch(spark, "substrings")
    k = min(ANCHOR, max(1, L // 2))
    marked = stored(
        mark_repeats(numbered(docs, text, id_col), as_bytes, L, k, path), f"{path}/marked"
    )
    touched = marked.filter("picks IS NOT NULL")

    def contexts(batches):
        schema = pa.schema([("h", pa.int64()), ("c", pa.binary()), ("context", pa.binary()), ("rid", pa.int64()), ("a", pa.int64())])
        rows = (
            (h, xxhash.xxh3_128_digest(piece := units.tobytes()), piece, rid, a)
            for rid, _, units, a, _, h in marked_runs(batches, as_bytes, L, k)
        )
        return arrow_out(schema, rows)

    places = touched.mapInArrow(contexts, "h long, c binary, context binary, rid long, a long")
    classes = stored(places.groupBy("h", "c", "context").agg(F.count("*").alias("n")), f"{path}/classes")
    frequent = stored(classes.groupBy("h").count().filter(F.col("count") > hot).select("h"), f"{path}/frequent")
    tasks = 1 + (classes.agg(F.sum(F.length("context"))).first()[0] or 0) // TASK_BYTES

    def expand(batches):
        schema = pa.schema([("c", pa.binary()), ("first", pa.int64()), ("last", pa.int64())])
        return arrow_out(schema, _expand(batches, L))

    kind = "c binary, first long, last long"
    few = (
        classes.join(frequent, "h", "left_anti").select("h", "c", "context", "n").repartition(tasks, "h").mapInArrow(expand, kind)
    )

    def windows(batches):
        schema = pa.schema([("w", pa.binary()), ("c", pa.binary()), ("first", pa.int64()), ("n", pa.int64())])
        rows = (
            (xxhash.xxh3_128_digest(context[i : i + L]), c, i, n)
            for b in batches
            for c, context, n in arrow_rows([b], "c", "context", "n")
            for i in range(len(context) - L + 1)
        )
        return arrow_out(schema, rows)

    single = classes.join(frequent, "h", "left_semi").select("c", "context", "n").mapInArrow(windows, "w binary, c binary, first long, n long")
    often = stored(single.groupBy("w").agg(F.sum("n").alias("n")).filter("n > 1").select("w"), f"{path}/often")
    many = single.join(often, "w", "left_semi").select("c", "first", F.col("first").alias("last"))
    found = stored(
        few.unionByName(many).groupBy("c").agg(F.collect_list(F.struct("first", "last")).alias("found")), f"{path}/found"
    )
    spans = (
        places.select("c", "rid", "a")
        .join(found, "c")
        .select("rid", "a", F.explode("found").alias("f"))
        .groupBy("rid")
        .agg(F.collect_list(F.struct((F.col("a") + F.col("f.first")).alias("a"), (F.col("a") + F.col("f.last")).alias("b"))).alias("spans"))
    )

    def finish(batches):
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        schema = pa.schema(
            [("rid", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(span)), ("kept", pa.binary())]
        )
        return arrow_out(schema, _finish(batches, L))

    result = "rid long, doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary"
    spans = stored(spans, f"{path}/spans")  # what led to them can go before the texts are shuffled
    cut = touched.join(spans.hint("shuffle_hash"), "rid", "left").select("rid", "doc_id", "body", "spans").mapInArrow(finish, result)
    whole = marked.filter("picks IS NULL").select(
        "rid",
        "doc_id",
        F.length("body").cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"),
        F.from_json(F.lit("[]"), "array<struct<start: long, end: long>>").alias("spans"),
        F.col("body").alias("kept"),
    )
    return cut.unionByName(whole)
