"""Phrases whose words keep together, mined after Toivonen.

A phrase is a run of words inside a piece of a text; everything is counted per
language, all contiguous occurrences, overlaps included.

1. A sample of the rows, one in ``SAMPLE`` by a hash of id and text, proposes
   phrases that reach half the support due to the sample.
2. One full pass counts what was proposed and the negative border, that is each
   phrase that occurs, wasn't proposed, and whose parts without the last and
   without the first word were. Most of these are rare, so a phrase goes by a
   64-bit hash here; what reaches the support is a superset.
3. Where a phrase of the border is frequent, the sample failed. So another pass
   counts by their words the phrases that reached the support and, at all
   lengths, those that weren't counted and have frequent parts or parts that
   this pass counts too. Nothing is possible beyond that, so it closes.

The sample decides what a pass counts, never a figure: all counts are exact.
Which phrases are proposed, and later found, goes to the tasks as a bitmap sized by
their number, 16 bits each, up to 16 MB; beyond that it fills up and more is counted than
need be. Words compare by 64-bit hashes; should any two words of the
corpus share one, all is counted again with other hashes.

NULL texts have no words; a NULL language is ``und``. Repeated rows count each
time, ids only deal rows into the sample and may be NULL or repeat. Texts of any
length are read whole; a task holds one text or about 4 MB of them at once. An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .anchors import bitmap, has, mix
from .common import arrow_rows, scratch, stored

#: Sample one row in so many.
SAMPLE = 4
#: Bytes of text that a task counts at once.
CHUNK = 4 << 20

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(_UPPER + b"\t" + _BREAKS, _UPPER.lower() + b" " + b"\n" * len(_BREAKS))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_KEY = ["h1", "h2", "h3", "h4"]


def longer_hash(shorter: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its words but the last, and the last word's."""
    return mix(shorter * _ODD + word)


def words_and_joints(bodies: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, and for each but the last whether the next is in the same piece."""
    a = np.frombuffer(b"\n".join(bodies).translate(_FOLD), np.uint8)
    ends_piece = a == 10
    gap = np.concatenate(([True], ends_piece | (a == 32), [True]))
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    start, end = edge[0::2], edge[1::2]
    piece = np.cumsum(ends_piece, dtype=np.int32)[start]
    offsets = np.zeros(len(start) + 1, np.int32)
    np.cumsum(end - start, out=offsets[1:])
    letters = np.ascontiguousarray(a[~gap[1:-1]])
    return pa.BinaryArray.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]), piece[1:] == piece[:-1]


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, int]:
    coded = pa.array(keys).dictionary_encode()
    return coded.indices.to_numpy(), len(coded.dictionary)


def counted(
    hashes: np.ndarray, codes: np.ndarray, joints: np.ndarray, longest: int, proposed: np.ndarray | None, found: np.ndarray | None
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Phrases of a run of words and how often they occur: their length, their hashes, a word hash per row and column, counts.

    ``hashes`` are those of the distinct words, ``codes`` says which word stands where. Without
    ``proposed`` (the sample) phrases of words that occur again; with it those that
    are proposed and the border; with ``found`` too, those that are found, and those that weren't
    counted then and are possible, given what is found.
    """
    H = hashes[codes]
    ids, size, g = codes.astype(np.int64), len(hashes), H
    times = np.bincount(codes, minlength=size)
    may = times[codes] > 1 if proposed is None else has(proposed if found is None else found, H)
    was = has(proposed, H) if found is not None else may
    for k in range(2, longest + 1):
        both = may[:-1] & may[1:]
        at = np.flatnonzero(both & joints if k == 2 else both)
        if not len(at):
            return
        inverse, n = _distinct(ids[at] * size + ids[at + 1])
        first = np.empty(n, np.int64)
        first[inverse[::-1]] = at[::-1]
        times = np.bincount(inverse, minlength=n)
        hashed = longer_hash(g[first], H[first + k - 1])
        before = was[first] & was[first + 1] if found is not None else np.zeros(n, bool)
        if proposed is None:
            stays, told = times > 1, slice(None)
        elif found is None:
            stays, told = has(proposed, hashed), slice(None)
        else:
            stays = told = ~before | has(found, hashed)
        yield k, hashed[told], np.column_stack([H[first[told] + j] for j in range(k)]), times[told]
        size, length = n, len(ids) - 1
        ids, g_next, may, was_next = np.zeros(length, np.int64), np.zeros(length, np.uint64), np.zeros(length, bool), np.zeros(length, bool)
        ids[at], g_next[at], may[at] = inverse, hashed[inverse], stays[inverse]
        if found is not None:
            was_next[at] = (before & has(proposed, hashed))[inverse]
        g, was = g_next, was_next


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language, about ``CHUNK`` bytes of all languages at once."""
    held: dict[str, list[bytes]] = {}
    weight = 0
    for lang, body in (r for b in batches for r in arrow_rows([b], "lang", "body")):
        held.setdefault(lang, []).append(body)
        weight += len(body) + 1
        if weight >= CHUNK:
            yield from held.items()
            held, weight = {}, 0
    yield from held.items()


def _counter(longest: int, seed: int, proposed=None, found=None) -> Callable:
    """The function for ``mapInArrow`` that counts in tasks.

    By hash, ``g``, with the words' text where ``proposed`` is given; with ``found`` phrases by their words' hashes.
    """
    text = ["lang", "word"] if proposed is not None and found is None else []
    key = _KEY if found is not None else ["g"]
    schema = pa.schema([(c, pa.string()) for c in text] + [(c, pa.int64()) for c in [*key, "n"]])

    def long(a: np.ndarray) -> pa.Array:
        return pa.array(a.view(np.int64))

    def run(batches):
        bits = [None if b is None else b.value for b in (proposed, found)]
        for lang, bodies in _chunks(batches):
            words, joints = words_and_joints(bodies)
            if not len(words):
                continue
            coded = words.dictionary_encode()
            salt = xxhash.xxh3_64_intdigest(lang.encode(), seed)
            spelt = coded.dictionary.to_pylist()
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, salt) or 1 for w in spelt), np.uint64, len(spelt))
            codes = coded.indices.to_numpy()
            if found is None:
                lead = [pa.array([lang] * len(spelt), pa.string()), coded.dictionary.cast(pa.string())] if text else []
                yield [*lead, long(hashes), long(np.bincount(codes, minlength=len(spelt)))]
            for k, hashed, rows, n in counted(hashes, codes, joints, longest, *bits):
                ends = [np.zeros(len(n), np.uint64)] * (4 - k)
                by = [long(hashed)] if found is None else [long(c) for c in [*np.ascontiguousarray(rows.T), *ends]]
                yield [*(pa.nulls(len(n), pa.string()) for _ in text), *by, long(n)]

    def small(batches):
        for columns in run(batches):
            out = pa.RecordBatch.from_arrays(columns, schema=schema)
            for at in range(0, out.num_rows, 1 << 16):
                yield out.slice(at, 1 << 16)

    return small


def _totals(texts: DataFrame, counter: Callable, *key: str) -> DataFrame:
    """Counts of all tasks, summed before and after the shuffle."""
    schema = ", ".join(f"{c} {'string' if c in ('lang', 'word') else 'long'}" for c in [*key, "n"])
    return texts.mapInArrow(counter, schema).groupBy(*key).agg(F.sum("n").alias("n"))


def frequent_phrases(
    docs: DataFrame, support: int = 30, longest: int = 4, text: str = "text", lang: str = "lang", id_col: str = "doc_id"
) -> tuple[DataFrame, DataFrame]:
    """Phrases of 1 to ``longest`` (at most 4) words that occur ``support`` times or more, and all words.

    The first has the phrases as word hashes ``h1`` to ``h4`` (0 after the last word) with their count ``n``,
    the second ``lang``, ``word``, ``h1`` and ``n``.
    """
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    texts = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("body"),
        F.col(id_col).cast("string").alias("_id"),
    )
    sample = texts.filter(F.pmod(F.xxhash64("_id", "body"), F.lit(SAMPLE)) == 0).select("lang", "body")
    texts = texts.select("lang", "body")
    for seed in count():
        path = scratch(spark, "phrases")
        proposals = _totals(sample, _counter(longest - 1, seed), "g").filter(F.col("n") >= max(2, support // (2 * SAMPLE)))
        proposed = share(bitmap(stored(proposals, f"{path}/proposed"), "g"))
        full = _totals(texts, _counter(longest, seed, proposed), "lang", "word", "g")
        full = stored(full.filter((F.col("n") >= support) | F.col("word").isNotNull()), f"{path}/full")
        words = full.filter("word IS NOT NULL").select("lang", "word", F.col("g").alias("h1"), "n")
        if words.groupBy("h1").count().filter("count > 1").isEmpty():
            break
    found = share(bitmap(full.filter(F.col("n") >= support), "g"))
    longer = _totals(texts, _counter(longest, seed, proposed, found), *_KEY).filter(F.col("n") >= support)
    none = [F.lit(0).cast("long").alias(h) for h in _KEY[1:]]
    return words.filter(F.col("n") >= support).select("h1", *none, "n").unionByName(stored(longer, f"{path}/longer")), words


def _exact(c: str):
    return F.col(c).cast("decimal(20,0)")


def best(frequent: DataFrame, words: DataFrame, support: int, top: int, within: int) -> DataFrame:
    """Scores, choice and text of phrases, given what ``frequent_phrases`` returns."""

    def span(i: int, n: int):
        return F.struct(*((F.col(f"h{i + j}") if j < n else F.lit(0).cast("long")).alias(f"h{j + 1}") for j in range(4)))

    def those(parts: list):
        return F.explode(F.filter(F.array(*parts), lambda p: p.isNotNull()))

    length = sum((F.col(h) != 0).cast("int") for h in _KEY)
    phrases = frequent.select(F.struct(*_KEY).alias("p"), *_KEY, F.col("n").alias("a"), length.alias("k")).filter("k > 1")

    # Scores: the counts of both parts at each cut.
    cuts = [
        F.when(F.col("k") == k, F.struct(F.lit(c).alias("cut"), span(1, c).alias("first"), span(c + 1, k - c).alias("rest")))
        for k in range(2, 5)
        for c in range(1, k)
    ]
    cut = phrases.select("p", "a", those(cuts).alias("c")).select("p", "a", "c.*")
    for part, n in (("first", "l"), ("rest", "r")):
        cut = cut.join(frequent.select(F.struct(*_KEY).alias(part), F.col("n").alias(n)), part)
    score = F.expr("(CAST(a AS DECIMAL(20,0)) * 2000000) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    lowest = cut.groupBy("p", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("low"))

    # Phrases that a longer one holds nearly always.
    inner = [F.when(F.col("k") == k, span(i, n)) for k in range(3, 5) for n in range(2, k) for i in range(1, k - n + 2)]
    longer = phrases.select(those(inner).alias("p"), F.lit(None).cast("long").alias("a"), F.col("a").alias("over"))
    own = phrases.select("p", "a", F.lit(None).cast("long").alias("over"))
    held = own.unionByName(longer).groupBy("p").agg(F.max("a").alias("a"), F.max("over").alias("over"))
    left = held.filter(F.col("over").isNull() | (_exact("over") * 100 < _exact("a") * within)).select("p")

    # Text and language by the words' hashes.
    chosen = lowest.join(left, "p", "left_semi").select("p", "a", "low.*")
    word = chosen.select("p", F.posexplode(F.array(*(F.col(f"p.{h}") for h in _KEY))).alias("i", "h1")).filter("h1 <> 0")
    spelt = word.join(words.filter(F.col("n") >= support).select("h1", "lang", "word"), "h1").groupBy("p")
    spelt = spelt.agg(F.max("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("i", "word"))).alias("w"))
    spelt = spelt.select("p", "lang", F.array_join(F.col("w.word"), " ").alias("phrase"))
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = chosen.join(spelt, "p").withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(
    docs: DataFrame,
    support: int = 30,
    longest: int = 4,
    top: int = 2000,
    within: int = 80,
    text: str = "text",
    lang: str = "lang",
    id_col: str = "doc_id",
) -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase of ``a`` occurrences is cut in two at each place; ``l`` and ``r`` are the occurrences of the parts
    at the cut with the lowest score, ``floor(2000000 * a / (l + r))``, the first of such cuts. It's left out
    where a longer frequent phrase that holds it has ``within`` percent of its occurrences or more. ``n`` is
    the number of words of the language. Ties go by ``a``, then by the bytes of the phrase.
    """
    return best(*frequent_phrases(docs, support, longest, text, lang, id_col), support=support, top=top, within=within)
