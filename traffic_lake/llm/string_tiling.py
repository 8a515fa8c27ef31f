"""Benchmark decontamination by greedy string tiling.

Words are lower-cased (A-Z only). A document and a benchmark item that share a
seed of ``least`` words are compared: matches are found by running Karp-Rabin
hashes of the seeds, extended as far as they go, and the longest one that is
free in both texts is marked, again and again, until none of ``least`` words is
left. Tiles don't overlap and may lie in any order, so reordered passages
count. An item is in a document if its tiles cover ``threshold`` of its words.

The benchmark is a query set: it goes to the tasks in blocks of about
``BLOCK_BYTES``, one after another, each of which meets all documents. What it
finds is stored and the block let go before the next. Documents are never shuffled.

NULL and blank texts contain nothing, items without words are in none. An item of fewer
than ``least`` words has to be found whole, all its words in a row. Repeated items or documents are each
treated by themselves; one result row per document row. With an empty
benchmark all documents are clean.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import gram_hashes
from .common import arrow_out, arrow_rows, numbered, scratch, stored

#: Benchmark bytes that go to the tasks at once.
BLOCK_BYTES = 2 << 20
LEAST, THRESHOLD = 5, 0.6


def word_hashes(body: bytes) -> np.ndarray:
    words = body.lower().split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def matches(doc: np.ndarray, item: np.ndarray, seeds: list[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """Longest common runs (length, place in item, place in doc) through the seeds (place in doc, place in item)."""
    out, reach = [], {}
    for i, j in sorted(seeds):
        if reach.get(i - j, -1) > i:  # inside a run that is known
            continue
        span = min(len(doc) - i, len(item) - j)
        differ = np.flatnonzero(doc[i : i + span] != item[j : j + span])
        n = int(differ[0]) if len(differ) else span
        if n >= least:
            out.append((n, j, i))
            reach[i - j] = i + n - least + 1
    return out


def tiles(found: list[tuple[int, int, int]], least: int) -> list[tuple[int, int, int]]:
    """Greedy tiling: the longest free match first (then first in the item, first in the document)."""
    heap = [(-n, j, i) for n, j, i in found]
    heapq.heapify(heap)
    in_item, in_doc, out = set(), set(), []
    while heap:
        n, j, i = heapq.heappop(heap)
        free = [x for x in range(-n) if j + x not in in_item and i + x not in in_doc]
        if len(free) == -n:
            in_item.update(range(j, j - n))
            in_doc.update(range(i, i - n))
            out.append((-n, j, i))
            continue
        start = 0
        for x in range(1, len(free) + 1):
            if x == len(free) or free[x] != free[x - 1] + 1:
                if x - start >= least:
                    heapq.heappush(heap, (start - x, j + free[start], i + free[start]))
                start = x
    return out


def contained(body: bytes, items: list[tuple[int, np.ndarray]], index: dict[int, tuple[dict[int, list], np.ndarray]], least: int):
    """(item, coverage, tiles) for each item that shares a seed with the text."""
    doc = word_hashes(body)
    seeds = defaultdict(list)
    for size, (places, keys) in index.items():
        if len(doc) < size:
            continue
        grams = gram_hashes(doc, size)
        at = np.searchsorted(keys, grams)
        hits = np.flatnonzero(keys[np.minimum(at, len(keys) - 1)] == grams)
        for i in hits.tolist():
            for number, j in places[int(grams[i])]:
                seeds[number].append((i, j))
    for number, pairs in seeds.items():
        item_id, item = items[number]
        size = min(least, len(item))
        laid = tiles(matches(doc, item, pairs, size), size)
        if laid:
            yield item_id, sum(n for n, _, _ in laid) / len(item), laid


def indexed(texts: list[tuple[int, bytes]], least: int):
    """The items' words, and by size of a seed the places of each: ``least`` words, or all of a shorter item."""
    items = [(item_id, word_hashes(body)) for item_id, body in texts]
    index: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
    for number, (_, item) in enumerate(items):
        size = min(least, len(item))
        if size:
            for j, gram in enumerate(gram_hashes(item, size).tolist()):
                index[size][gram].append((number, j))
    return items, {size: (dict(places), np.array(sorted(places), np.uint64)) for size, places in index.items()}


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    least: int = LEAST,
    threshold: float = THRESHOLD,
    text: str = "text",
    id_col: str = "doc_id",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``, a stored table: rid, doc_id, contaminated, items (ids and coverage), spans (words of the document)."""
    spark = docs.sparkSession
    rows = numbered(docs, text, id_col)
    tests = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("body"))
    total = tests.agg(F.sum(F.length("body"))).first()[0] or 0
    blocks = 1 + total // block_bytes
    tests = tests.withColumn("block", F.pmod(F.xxhash64("item_id", "body"), F.lit(blocks)))
    hit = "rid long, item_id long, coverage double, spans array<struct<start: long, end: long>>"
    path, found = scratch(spark, "tiling"), []
    for block in range(blocks):
        held = spark.sparkContext.broadcast([(r.item_id, bytes(r.body)) for r in tests.filter(F.col("block") == block).collect()])

        def search(batches, held=held):
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            schema = pa.schema([("rid", pa.int64()), ("item_id", pa.int64()), ("coverage", pa.float64()), ("spans", pa.list_(span))])
            items, index = indexed(held.value, least)
            out = (
                (rid, item_id, coverage, [{"start": i, "end": i + n} for n, _, i in sorted(laid, key=lambda t: t[2])])
                for batch in batches
                for rid, body in arrow_rows([batch], "rid", "body")
                for item_id, coverage, laid in contained(body, items, index, least)
                if coverage >= threshold
            )
            return arrow_out(schema, out)

        found.append(stored(rows.select("rid", "body").mapInArrow(search, hit), f"{path}/hits-{block}"))
        held.unpersist()
    hits = reduce(DataFrame.unionByName, found)
    per_row = hits.groupBy("rid").agg(
        F.sort_array(F.collect_list(F.struct("item_id", "coverage"))).alias("items"), F.flatten(F.collect_list("spans")).alias("spans")
    )
    return rows.select("rid", "doc_id").join(per_row, "rid", "left").withColumn("contaminated", F.col("items").isNotNull())
