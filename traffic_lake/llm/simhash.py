"""SimHash near-duplicates with deletion-variant signatures.

The fingerprint of a text is 64 bits: a bit is set if it is set in more than
half of the XXH64 hashes (seed 42) of the text's word shingles, repeats
included. Words are lower-cased (A-Z only); fewer words than a shingle has make
one shingle, and no words give fingerprint zero, which links like any other.

Fingerprints at ``radius`` bits or fewer link. They are cut into
``(radius + 1 + 1) // 2`` segments, so few that of any linked pair some segment
differs by at most one bit. Each segment is indexed as it is, and once per bit
with that bit deleted; the side of the join follows from the deleted bit, so
only segments that differ in exactly that bit meet there. Pairs found in an
earlier segment aren't found again, hence each link comes out once, after the
exact check of all 64 bits.

Equal fingerprints are one node, so copies cost one row per task. Components
come from alternating star contractions on stored tables; hubs are reduced with
partial minima, nothing is gathered.

NULL texts count as empty. Repeated rows and ids are fine: nodes are
fingerprints. ``component_id`` is the smallest id in reach (NULL only if all
are NULL). One result row per input row; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, numbered, scratch, stored

BITS = 64


def fingerprint(body: bytes, shingle: int) -> int:
    """Fingerprint as a signed 64-bit number."""
    words = body.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    grams = map(b" ".join, zip(*(words[i:] for i in range(min(shingle, len(words))))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, itertools.repeat(42)), "<u8", n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):  # bounds the unpacked bits of a long text
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def _fingerprints(batches, shingle: int):
    schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("fp", pa.int64())])
    for batch in batches:
        values = [fingerprint(body, shingle) for (body,) in arrow_rows([batch], "body")]
        yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), pa.array(values, pa.int64())], schema=schema)


def links(nodes: DataFrame, radius: int = 3) -> DataFrame:
    """All pairs fp < other of the distinct fingerprints in ``nodes.fp`` at ``radius`` bits or fewer, each once."""
    n = (radius + 2) // 2
    bounds = [BITS * i // n for i in range(n + 1)]
    masks = [((1 << hi) - (1 << lo)) for lo, hi in zip(bounds, bounds[1:])]

    def literal(mask: int):
        return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")

    fp = F.col("fp")
    variants = []
    for s, mask in enumerate(masks):
        one = [
            F.struct(
                F.lit(s * BITS + bit).alias("kind"),
                fp.bitwiseAND(literal(mask & ~(1 << bit))).alias("key"),
                (fp.bitwiseAND(literal(1 << bit)) != 0).alias("bit"),
            )
            for bit in range(bounds[s], bounds[s + 1])
        ]
        variants += [F.struct(F.lit(-1 - s).alias("kind"), fp.bitwiseAND(literal(mask)).alias("key"), F.lit(None).cast("boolean").alias("bit")), *one]
    indexed = nodes.select("fp", F.explode(F.array(*variants)).alias("v")).select("fp", "v.*")
    left = indexed.filter("bit IS NULL OR NOT bit").select("kind", "key", "fp")
    right = indexed.filter("bit IS NULL OR bit").select("kind", "key", F.col("fp").alias("other"))
    change = F.col("fp").bitwiseXOR(F.col("other"))
    earlier = F.lit(False)
    for s, mask in enumerate(masks[:-1]):  # found already in a segment before
        later = F.col("kind") >= BITS * (s + 1) if s + 1 < n else F.lit(False)
        for t in range(s + 1, n):
            later = later | (F.col("kind") == -1 - t)
        earlier = earlier | (later & (F.bit_count(change.bitwiseAND(literal(mask))) <= 1))
    near = (F.bit_count(change) <= radius) & ~earlier & ((F.col("kind") >= 0) | (F.col("fp") < F.col("other")))
    # Spark takes the exploded variants for as many as the nodes and would broadcast them
    return left.join(right.hint("merge"), ["kind", "key"]).filter(near).select(
        F.least("fp", "other").alias("fp"), F.greatest("fp", "other").alias("other")
    )


def components(edges: DataFrame, path: str) -> DataFrame:
    """``node`` and ``root`` (the smallest node in reach) of all nodes of stored ``edges`` (a, b).

    Large stars join each node's larger neighbours to the smallest one, small
    stars the smaller ones; they alternate until nothing changes.
    """

    def star(edges: DataFrame, large: bool, name: str) -> DataFrame:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        # small stars look only at neighbours that are smaller
        around = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))) if large else edges.select(
            F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
        )
        least = stored(around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), f"{name}-least")
        joined = around.join(least, "u")
        if large:
            new = joined.filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        else:
            new = joined.select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
        return stored(new.filter("a <> b").distinct(), name)

    def state(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    before, turn = None, 0
    while (now := state(edges)) != before:
        before = now
        edges = star(star(edges, True, f"{path}/large-{turn}"), False, f"{path}/small-{turn}")
        turn += 1
    tail = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return tail.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))


def near_duplicates(
    docs: DataFrame, shingle: int = 3, radius: int = 3, text: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """One row per row of ``docs``, a stored table: rid, doc_id, fingerprint (long), component (its smallest
    fingerprint), component_id, n_links (of the fingerprint)."""
    spark = docs.sparkSession
    path = scratch(spark, "simhash")
    rows = stored(
        numbered(docs, text, id_col).mapInArrow(lambda b: _fingerprints(b, shingle), "rid long, doc_id long, fp long"), f"{path}/rows"
    )
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), f"{path}/nodes")
    found = stored(links(nodes, radius).select(F.col("fp").alias("a"), F.col("other").alias("b")), f"{path}/links")
    degree = found.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    root = components(found, f"{path}/stars").withColumnRenamed("node", "fp")
    linked = nodes.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = stored(
        linked.join(lowest, "root")
        .join(degree.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", F.col("root").alias("component"), "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links")),
        f"{path}/classes",
    )
    return rows.join(classes, "fp").select("rid", "doc_id", F.col("fp").alias("fingerprint"), "component", "component_id", "n_links")
