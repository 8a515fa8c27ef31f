"""Winnowed anchors: find the places where a window of ``L`` units may repeat.

A text is a sequence of units (bytes or word hashes). Of the grams of ``k``
units inside a window of ``L``, the one with the smallest order value is the
window's anchor, the rightmost of equal ones. Equal windows thus have equal
anchors at equal offsets, so a window can repeat only if its anchor does.
Successive windows with one anchor form a run; each window is in one run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, stored

#: Units that are worked on at once; a longer text is cut into overlapping pieces.
PIECE = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)
_LOW = np.uint64(0xFFFFFFFF)
_powers: dict[int, np.ndarray] = {}
#: Spreads byte values over 64 bits.
_BYTES = np.random.default_rng(7).integers(0, 1 << 64, 256, np.uint64)


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def gram_hashes(units: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each gram of ``k`` units, from running sums of a polynomial."""
    if units.dtype == np.uint8:
        units = _BYTES[units]
    sums = np.zeros(len(units) + 1, np.uint64)
    np.cumsum(units * _power(_BASE, len(units)), out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * _power(_UNBASE, len(units) - k + 1))


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        a = np.minimum(a[:-size], a[size:])
        size *= 2
    return a if size == width else np.minimum(a[: len(a) - (width - size)], a[width - size :])


def runs(units: np.ndarray, at: np.ndarray, length: np.ndarray, L: int, k: int):
    """Runs of windows of the texts that lie at ``at`` in ``units``.

    Returns arrays: number of the text, first window, last window, anchor (all
    as offsets in the text) and hash of the anchor.
    """
    grams = gram_hashes(units, k)
    key = (grams & ~_LOW) | (_LOW - np.arange(len(grams), dtype=np.uint64))
    pick = (_LOW - (sliding_min(key, L - k + 1) & _LOW)).astype(np.int64)
    inside = np.zeros(len(pick) + 1, np.int8)
    inside[at] += 1
    inside[at + length - L + 1] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    cut = np.flatnonzero((pick[1:] != pick[:-1]) | (inside[1:] != inside[:-1])) + 1
    first = np.concatenate(([0], cut))
    last = np.concatenate((cut, [len(pick)])) - 1
    first, last = first[inside[first]], last[inside[first]]
    text = np.searchsorted(at, first, "right") - 1
    anchor = pick[first]
    base = at[text]
    return text, first - base, last - base, anchor - base, grams[anchor]


def _pieces(texts: Iterator[tuple[object, np.ndarray]], L: int):
    """Lists of (tag, units, offset in the text) of about ``PIECE`` units together; texts shorter than ``L`` are left out."""
    held: list[tuple[object, np.ndarray, int]] = []
    weight = 0
    for tag, units in texts:
        for offset in range(0, len(units) - L + 1, PIECE):
            held.append((tag, units[offset : offset + PIECE + L - 1], offset))
            weight += len(held[-1][1])
            if weight >= PIECE:
                yield held
                held, weight = [], 0
    if held:
        yield held


def joined_runs(held: list[tuple[object, np.ndarray, int]], L: int, k: int):
    """The pieces' units in one array, where each begins, and the five arrays of ``runs``."""
    length = np.array([len(p) for _, p, _ in held])
    at, units = np.cumsum(length) - length, np.concatenate([p for _, p, _ in held])
    return units, at, *runs(units, at, length, L, k)


def text_runs(texts: Iterator[tuple[object, np.ndarray]], L: int, k: int):
    """For each piece of the texts: tag, unit array, offset of the piece, and the four run arrays of the piece.

    Offsets of runs are relative to the text; a piece with no window is left out.
    """
    for held in _pieces(texts, L):
        _, _, text, first, last, anchor, h = joined_runs(held, L, k)
        bounds = np.searchsorted(text, np.arange(len(held) + 1))
        for i, (tag, piece, offset) in enumerate(held):
            part = slice(bounds[i], bounds[i + 1])
            yield tag, piece, offset, first[part] + offset, last[part] + offset, anchor[part] + offset, h[part]


def stretch_hashes(units: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of units, whatever its length, from running sums as in ``gram_hashes``."""
    sums = np.zeros(len(units) + 1, np.uint64)
    np.cumsum(units * _power(_BASE, len(units)), out=sums[1:])
    return mix((sums[at + length] - sums[at]) * _power(_UNBASE, len(units) + 1)[at] + length.astype(np.uint64))


#: Bounds of the filter before a join, as powers of two of bits; 16 MB at most, whatever the corpus.
LEAST_BITS, MOST_BITS = 16, 27


def bitmap(hashes: DataFrame, column: str = "h") -> np.ndarray:
    """A bit for each hash of a stored table, 16 bits per row as far as ``MOST_BITS`` go; only words with a bit set are collected."""
    power = min(MOST_BITS, max(LEAST_BITS, (16 * hashes.count()).bit_length()))
    word, bit = F.col(column).bitwiseAND((1 << power) - 64), F.expr(f"shiftleft(1L, CAST({column} & 63 AS INT))")
    rows = hashes.groupBy(F.shiftright(word, 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (power - 6), np.uint64)
    out[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    low = hashes & np.uint64(len(bits) * 64 - 1)
    return (bits[(low >> np.uint64(6)).astype(np.int64)] >> (hashes & np.uint64(63))) & np.uint64(1) == 1


def mark_repeats(docs: DataFrame, encode: Callable[[bytes], np.ndarray], L: int, k: int, path: str) -> DataFrame:
    """``docs`` (rid, doc_id, body) with ``picks``, the offsets of anchors that occur more than once; NULL if there are none.

    Anchors are counted with partial sums, so a frequent one costs a row per
    task. The join back is on a stored table, which lets skewed keys be split; a
    bitmap, sized by the number of repeated anchors up to a bound, spares it most that occur once.
    """

    def emit(batches, held=None):
        fields = [("h", pa.int64())] + ([("rid", pa.int64()), ("p", pa.int64())] if held else [])
        schema, bits = pa.schema(fields), held.value if held else None
        for batch in batches:
            rows = ((rid, encode(body)) for rid, body in arrow_rows([batch], "rid", "body"))
            for rid, _, _, _, _, p, h in text_runs(rows, L, k):
                if bits is None:
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], schema=schema)
                    continue
                may = has(bits, h)
                h, p = h[may], p[may]
                columns = [pa.array(h.view(np.int64)), pa.array(np.full(len(p), rid, np.int64)), pa.array(p)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    texts = docs.select("rid", "body")
    counted = texts.mapInArrow(lambda b: merged(emit(b)), "h long").groupBy("h").count()
    repeated = stored(counted.filter("count > 1").select("h"), f"{path}/repeated")
    held = docs.sparkSession.sparkContext.broadcast(bitmap(repeated))
    anchors = texts.mapInArrow(lambda b: merged(emit(b, held)), "h long, rid long, p long")
    picks = anchors.join(repeated.hint("shuffle_hash"), "h", "left_semi").groupBy("rid").agg(F.collect_list("p").alias("picks"))
    picks = stored(picks, f"{path}/picks")  # what led to them can go before texts are shuffled
    return docs.join(picks.hint("shuffle_hash"), "rid", "left")


def merged(batches: Iterator[pa.RecordBatch], rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Many small batches as fewer large ones."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def marked_surroundings(batches: Iterator[pa.RecordBatch], encode, L: int, k: int) -> Iterator[pa.RecordBatch]:
    """For stored rows with ``picks``, each run whose anchor repeats: ``h``, the anchor's hash; ``c``, a hash of all its units;
    ``windows``, a hash of each of its windows; ``rid`` and ``doc_id``; ``a``, its first window."""
    names = ["h", "c", "windows", "rid", "doc_id", "a"]
    for batch in batches:
        texts, wanted = [], [np.empty(0, np.int64)]
        for i, (body, picks) in enumerate(arrow_rows([batch], "body", "picks")):
            texts.append((i, encode(body)))
            wanted.append(np.asarray(picks, np.int64) + (i << 40))
        wanted = np.unique(np.concatenate(wanted))
        for held in _pieces(iter(texts), L):
            units, at, text, first, last, anchor, h = joined_runs(held, L, k)
            row = np.array([tag for tag, _, _ in held])[text]
            offset = np.array([o for _, _, o in held])[text]
            use = np.isin((row << 40) + anchor + offset, wanted)
            row, offset, text, first, last, h = row[use], offset[use], text[use], first[use], last[use], h[use]
            n, begin = last - first + 1, first + at[text]
            ends = np.cumsum(n)
            windows = gram_hashes(units, L)[np.arange(ends[-1] if len(n) else 0) + np.repeat(begin - (ends - n), n)]
            c = stretch_hashes(units, begin, n + L - 1).view(np.int64)
            for i in range(0, len(n), 1 << 15):
                part = slice(i, i + (1 << 15))
                edges = np.concatenate(([ends[i] - n[i]], ends[part]))
                hashes = np.ascontiguousarray(windows[edges[0] : edges[-1]])
                edges = pa.py_buffer(((edges - edges[0]) * 8).astype(np.int32))
                rows = pa.array(row[part])
                columns = [h[part].view(np.int64), c[part], pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, edges, pa.py_buffer(hashes)])]
                columns += [batch.column("rid").take(rows), batch.column("doc_id").take(rows), first[part] + offset[part]]
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], names)


def marked_runs(batches, encode, L: int, k: int):
    """For stored rows with ``picks``: (rid, doc_id, units, first, last, anchor hash) of each run whose anchor repeats."""
    for batch in batches:
        texts, wanted = [], {}
        for i, (rid, doc_id, body, picks) in enumerate(arrow_rows([batch], "rid", "doc_id", "body", "picks")):
            texts.append(((i, rid, doc_id), encode(body)))
            wanted[i] = np.unique(np.asarray(picks, np.int64))
        for (i, rid, doc_id), piece, offset, first, last, p, h in text_runs(iter(texts), L, k):
            for j in np.flatnonzero(np.isin(p, wanted[i])):
                a, b = int(first[j]), int(last[j])
                yield rid, doc_id, piece[a - offset : b - offset + L], a, b, int(h[j : j + 1].view(np.int64)[0])
