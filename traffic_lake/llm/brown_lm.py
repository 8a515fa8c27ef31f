"""Language-model scores from Brown class-based n-grams.

Tokens are the words of a text, lower-cased (A-Z only), then one end. All counts
cover all training rows (crc32 of the id modulo 5 isn't 1).

*Base* score: each token by its own frequency, half a count added.

*Model* score: the class of a token follows from the class of the token before
(the end, at the start), and the word from its class, by its frequency with half
a count added. Classes come from exchange clustering: each word moves to the
class that raises the likelihood of the training bigrams most.

The exchange covers every training word. It starts from classes that the driver
finds for the ``UNITS`` most frequent tokens, bands of frequency for the rest of
the at most ``TOP`` most frequent ones, and one unit for all others. Then all
words move one by one, in rounds: tasks count the classes before and after each
word, add them up by word and choose its best class, as if no other moved. Words
of even and odd numbers take turns, lest words that attract each other keep
changing places. Rounds end when two of them, a turn of all words, raise the
log10 likelihood by less than ``LEAST`` a token, or one lowers it; then the
classes with the greater likelihood stay. No round limit, no word left out.

The tasks are sent the classes of the ``TOP`` most frequent words. Those of all
others never leave the cluster: words are dealt to buckets, and a row per bucket
has their places, another their classes, which are joined. These words have low
counts, so no bucket is great for one of them. What is known of the classes
reaches the driver as classes squared.

A word that nobody learnt from has half a count in the class with the most words
seen once. Transitions are smoothed with the frequency of the class. Words compare
by 63-bit hashes.

NULL and blank texts are one end token. Rows may repeat; each trains and is
scored. A NULL id has the hash of an empty text. Without training rows both
scores are those of a uniform choice of one token. An empty table gives an empty
result.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, crc_fold, dropped, most_frequent, numbered, scratch, share, shared, stored

TOP, UNITS, CLASSES, ROUNDS = 300_000, 1000, 64, 6
#: Weight of the class frequencies in a transition.
SMOOTH = 20.0
#: Least rise of the log10 likelihood of a token, in two rounds of all words, for which the exchange goes on.
LEAST = 0.02
#: Tokens that a task counts at once, those that a bucket of words stands for, and bytes of text that are split at once.
PIECE, BUCKET, TEXT = 1 << 21, 1_000_000, 8 << 20
#: Counts of an entry for which a task holds the rise of each cell.
FEW = 16
END = xxhash.xxh64_intdigest(b"\n") >> 1  # no word holds a line end


def some_texts(batch, column: str):
    """Slices of a batch with about ``TEXT`` bytes of text each, or one longer text."""
    size = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    a = 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(size, TEXT + (size[a - 1] if a else 0), "right")))
        yield batch.slice(a, b - a)
        a = b


def spelled(bodies: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct tokens of some texts, the place of each token among them, and where texts begin, one more than there are."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(bodies.view(pa.string())))
    words, bounds = parts.flatten(), parts.offsets.to_numpy()
    bounds = bounds - bounds[0]
    real = pc.binary_length(words).to_numpy() > 0  # blanks at the ends of a text leave empty words
    words = words.dictionary_encode()
    distinct = words.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False).tolist()  # to_pylist is slower
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct)) >> np.uint64(1)
    begin = np.append(0, np.cumsum(real))[bounds] + np.arange(len(bounds))
    place = np.full(begin[-1], len(distinct))
    word = np.ones(len(place), bool)
    word[begin[1:] - 1] = False
    place[word] = words.indices.to_numpy()[real]
    return np.append(hashes, np.uint64(END)), place, begin


def tokens(body: bytes) -> np.ndarray:
    hashes, place, _ = spelled(pa.array([body], pa.binary()))
    return hashes[place]


def _gather(batches):
    """Token counts of each batch."""
    schema = pa.schema([("w", pa.int64()), ("n", pa.int64())])
    for batch in batches:
        held = []
        for part in some_texts(batch, "body"):
            hashes, place, _ = spelled(part.column("body"))
            times = np.bincount(place, minlength=len(hashes))
            held.append((hashes[times > 0], times[times > 0]))
        if held:
            w, n = map(np.concatenate, zip(*held))
            order = np.argsort(w)
            w, n = w[order], n[order]
            first = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
            yield pa.RecordBatch.from_arrays([pa.array(w[first].view(np.int64)), pa.array(np.add.reduceat(n, first))], schema=schema)


class Vocabulary:
    """The most frequent tokens and the end, numbered by falling count, with their counts and the units they start in."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, units: int):
        """``words`` (uint64) by falling count."""
        unit = np.arange(len(words))
        rest = counts[units:]
        if len(rest):
            band = np.log2(np.maximum(rest, 1)).astype(np.int64)
            unit[units:] = min(units, len(words)) + band[0] - band
        self.units = int(unit.max()) + 2  # the last is for all others
        order = np.argsort(words)
        self.words, self.number = words[order], order
        self.counts, self.unit = counts, unit

    def look_up(self, w: np.ndarray) -> np.ndarray:
        """Numbers of the tokens; other words have negative ones, the complements of their hashes."""
        at = np.minimum(np.searchsorted(self.words, w), len(self.words) - 1)
        return np.where(self.words[at] == w, self.number[at], ~w.view(np.int64))


def xlogx(x):
    return x * np.log(np.maximum(x, 1e-300))


def exchange(pairs: np.ndarray, classes: int, rounds: int) -> np.ndarray:
    """Class of each unit. ``pairs[a, b]`` counts unit b after unit a.

    Maximises the bigram likelihood of classes, sum n(c,d) log n(c,d) less
    sum n(c) log n(c) of both margins, by moving one unit at a time.
    """
    units = len(pairs)
    classes = min(classes, units)
    weight = pairs.sum(0) + pairs.sum(1)
    cls = np.empty(units, np.int64)
    cls[np.argsort(-weight, kind="stable")] = np.arange(units) % classes
    member = np.zeros((units, classes))
    member[np.arange(units), cls] = 1
    table = member.T @ pairs @ member

    for _ in range(rounds):
        moved = 0
        for u in np.argsort(-weight, kind="stable"):
            if not weight[u]:
                continue
            out, into, own, old = pairs[u] @ member, pairs[:, u] @ member, pairs[u, u], cls[u]
            out[old] -= own  # pairs with itself move along
            into[old] -= own
            table[old] -= out
            table[:, old] -= into
            table[old, old] -= own
            rows, cols = table.sum(1), table.sum(0)
            logs = xlogx(table)
            # the change of the sum when the unit joins class c: row c, column c and their crossing
            gain = (xlogx(table + out) - logs).sum(1) + (xlogx(table + into[:, None]) - logs).sum(0)
            d = np.arange(classes)
            diag = table[d, d]
            gain += xlogx(diag + out + into + own) - xlogx(diag + out) - xlogx(diag + into) + logs[d, d]
            gain -= xlogx(rows + out.sum() + own) - xlogx(rows) + xlogx(cols + into.sum() + own) - xlogx(cols)
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                new = int(old)
            table[new] += out
            table[:, new] += into
            table[new, new] += own
            if new != old:
                member[u, old], member[u, new], cls[u] = 0, 1, new
                moved += 1
        if not moved:
            break
    return cls


def transitions(table: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """log10 of the chance of each class after each class; classes of no weight are never asked for."""
    chance = weight / weight.sum()
    with np.errstate(divide="ignore"):
        return np.log10((table + SMOOTH * chance) / (table.sum(1, keepdims=True) + SMOOTH))


def likelihood(table: np.ndarray) -> float:
    """Log-likelihood of the class bigrams, less what no choice of classes changes."""
    return float(xlogx(table).sum() - xlogx(table.sum(0)).sum() - xlogx(table.sum(1)).sum())


def summed(w: np.ndarray, key: np.ndarray, n: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (w, key) in their order, with the sums of ``n``; keys are below ``width``."""
    mine, other = np.flatnonzero(w >= 0), np.flatnonzero(w < 0)
    # the numbers of other words are too great to be sorted as one with their keys, so their places among them are
    _, place = np.unique(w[other], return_inverse=True)
    order = np.concatenate((other[np.argsort(place * width + key[other])], mine[np.argsort(w[mine] * width + key[mine])]))
    w, key = w[order], key[order]
    first = np.flatnonzero(np.append(True, (w[1:] != w[:-1]) | (key[1:] != key[:-1]))[: len(w)])
    return w[first], key[first], np.add.reduceat(n[order], first) if len(w) else n


def dealt(bucket: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    """The entries as a row per bucket."""
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    parts = list(zip(first, np.append(first[1:], len(bucket))))
    held = [c[order] for c in columns.values()]
    held = [pa.array([c[a:b].tobytes() for a, b in parts], pa.binary()) for c in held]
    return pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), *held], names=["bucket", *columns])


def rises(table: np.ndarray) -> np.ndarray:
    """``rises(table)[n - 1, key]``: what ``n`` more in a cell add to the sum of ``best``, for all classes, ``n`` up to ``FEW``."""
    cells = np.concatenate((table, table.T), 1).T
    return xlogx(cells + np.arange(1, FEW + 1)[:, None, None]) - xlogx(cells)


def best(table: np.ndarray, risen: np.ndarray, old: np.ndarray, word: np.ndarray, key: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The class of each word that raises the likelihood of ``table`` most, if that word alone moves; ``old`` if none does.

    Entry: ``n`` times the word ``word`` (a place in ``old``, ascending) was before class
    ``key``, after class ``key`` - classes, or before itself (``key`` = 2 x classes). The
    gain is that of ``exchange``, from the cells that the word has to do with.
    """
    k, m = len(table), len(old)
    each = np.arange(m)
    own = np.zeros((m, 1))
    same = key == 2 * k
    own[word[same], 0] = n[same]
    word, key, n = word[~same], key[~same], n[~same].astype(float)
    both = np.zeros((m, 2 * k))
    both[word, key] = n
    out, into = both[:, :k], both[:, k:]
    # all classes by the class of each entry; those of the word itself are taken without it
    cells = np.concatenate((table, table.T), 1).T
    rise = risen.reshape(-1, k).take((np.minimum(n, FEW).astype(np.int64) - 1) * 2 * k + key, 0)
    many = np.flatnonzero(n > FEW)
    rise[many] = xlogx(cells[key[many]] + n[many, None]) - xlogx(cells[key[many]])
    was, entry = old[word], np.arange(len(word))
    full = cells[key, was]
    rise[entry, was] = xlogx(full) - xlogx(full - n)
    at = np.flatnonzero(key % k == was)
    less = cells[key[at]]
    less[np.arange(len(at)), was[at]] -= n[at] + own[word[at], 0]
    less -= np.where(key[at, None] < k, into[word[at]], out[word[at]])
    rise[at] = xlogx(less + n[at, None]) - xlogx(less)
    gain = np.zeros((m, k))
    size = np.bincount(word, minlength=m)
    most = np.argsort(-size, kind="stable")
    first = (np.cumsum(size) - size)[most]
    for nth, words in enumerate(m - np.searchsorted(np.sort(size), np.arange(size.max()), "right")):
        gain[most[:words]] += rise[first[:words] + nth]  # the nth entry of each word that has so many
    u, c = np.divmod(np.flatnonzero(((out > 0) & (into > 0)) | (own > 0)), k)
    diag, o, i, self = np.diag(table)[c], out[u, c], into[u, c], own[u, 0]
    diag = diag - np.where(c == old[u], o + i + self, 0)
    gain[u, c] += xlogx(diag + o + i + self) - xlogx(diag + o) - xlogx(diag + i) + xlogx(diag)
    for margin, part in ((table.sum(1), out), (table.sum(0), into)):
        of_word = part.sum(1) + own[:, 0]
        times, like = np.unique(of_word, return_inverse=True)
        rise = (xlogx(margin + times[:, None]) - xlogx(margin))[like]
        rise[each, old] = xlogx(margin[old]) - xlogx(margin[old] - of_word)
        gain -= rise
    new = gain.argmax(1)
    return np.where(gain[each, new] > gain[each, old] + 1e-9, new, old)


def moved(table: np.ndarray, old: np.ndarray, word: np.ndarray, key: np.ndarray, n: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """``best`` for the words whose ``turn`` it is, some at a time; of words seen once, those that are alike are done once."""
    k, new, risen = len(table), old.copy(), rises(table)
    first = np.searchsorted(word, np.arange(len(old) + 1))
    size = np.diff(first)

    def done(some):
        of = np.repeat(np.arange(len(some)), size[some])
        entry = np.arange(len(of)) + (first[some] - np.cumsum(size[some]) + size[some])[of]
        return best(table, risen, old[some], of, key[entry], n[entry])

    at = np.flatnonzero(turn & (size == 2))
    at = at[(n[first[at]] == 1) & (n[first[at] + 1] == 1)]
    _, chosen, like = np.unique((old[at] * 3 * k + key[first[at]]) * 3 * k + key[first[at] + 1], return_index=True, return_inverse=True)
    rest = turn & (size > 0)
    rest[at] = False
    some = np.concatenate((at[chosen], np.flatnonzero(rest)))
    for a in range(0, len(some), 2048):
        new[some[a : a + 2048]] = done(some[a : a + 2048])
    new[at] = new[at[chosen]][like]
    return new


def numbers(row: dict, *columns: str) -> list[np.ndarray]:
    """The numbers that binary columns hold."""
    return [np.frombuffer(row[c], np.int16 if c == "key" else np.int64).astype(np.int64) for c in columns]


def pieces(batches, end: int):
    """Tokens of some texts at a time, as numbers, in their order; the end comes before each text."""
    some, size = [], 0
    for batch in batches:
        for codes in batch.column("codes"):
            some.append(codes.as_py())
            size += len(some[-1]) // 4
            if size >= PIECE:
                yield np.concatenate(([end], np.frombuffer(b"".join(some), np.int32)))
                some, size = [], 0
    if some:
        yield np.concatenate(([end], np.frombuffer(b"".join(some), np.int32)))


def clustered(texts: DataFrame, others: DataFrame, vocabulary: Vocabulary, end: int, N: int, classes: int, path: str):
    """Classes of the vocabulary, those of all ``others`` as a table (w, n, cls), the counts of class after class, and the number of classes.

    ``texts`` are the training texts: ``codes``, the numbers of their tokens, -1 for other words, and
    ``rare``, ``before`` and ``after``, the other words and what stands around them.
    """
    spark = texts.sparkSession
    buckets = 1 + N // BUCKET

    def sent(batches):
        """The places of other words, a row per bucket of words."""
        for batch in batches:
            w, before, after = (batch.column(c).flatten().to_numpy() for c in ("rare", "before", "after"))
            if len(w):
                yield dealt(w % buckets, w=w, before=before, after=after)

    def gathered(group):
        """All places of the words of a bucket, by word."""
        w, before, after = map(np.concatenate, zip(*(numbers(row, "w", "before", "after") for row in group.to_pylist())))
        order = np.argsort(w)
        return pa.table([group["bucket"].slice(0, 1), *([c[order].tobytes()] for c in (w, before, after))], names=["bucket", "w", "before", "after"])

    place = "bucket long, w binary, before binary, after binary"
    places = texts.select("rare", "before", "after").mapInArrow(sent, place).groupBy("bucket").applyInArrow(gathered, place)
    places = stored(places, f"{path}/places")
    texts = texts.select("codes")
    start = spark.sparkContext.broadcast(np.append(vocabulary.unit, vocabulary.units - 1))  # place -1 is for the others
    units = vocabulary.units

    def follow(batches):
        seen = np.zeros(units * units, np.int64)
        for codes in pieces(batches, end):
            unit = start.value[codes]
            seen += np.bincount(unit[:-1] * units + unit[1:], minlength=units * units)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["pair", "n"])

    followed = texts.mapInArrow(follow, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()  # at most units squared
    pairs = np.zeros(units**2)
    pairs[followed["pair"].to_numpy()] = followed["n"].to_numpy()
    of_unit = exchange(pairs.reshape(units, units), classes, ROUNDS)
    k = classes
    width = 3 * k + 1  # class after, k + class before, 2 k for itself, then 2 k + 1 + class of the word
    cls = of_unit[vocabulary.unit]
    unit = int(of_unit[-1])

    def alike(batches):
        """The other words, all in the class of their unit."""
        for batch in batches:
            for row in batch.to_pylist():
                words = np.unique(*numbers(row, "w"))
                classes = np.full(len(words), unit)
                yield pa.RecordBatch.from_arrays([pa.array([row["bucket"]]), *(pa.array([x.tobytes()]) for x in (words, classes))], names=["bucket", "rare", "cls"])

    rare = places.select("bucket", "w").mapInArrow(alike, "bucket long, rare binary, cls binary")
    entry = "bucket long, w binary, key binary, n binary"

    def counted(cls, rare, turn):
        """Classes before and after the words whose turn it is, a row of entries per bucket, with its share of the table.

        Buckets below 0 have no entries but classes after classes, from where both are known. Those of two words
        beyond the vocabulary are known when the entries of the first meet its class.
        """
        frequent = spark.sparkContext.broadcast(cls)

        def crossed(cells):
            """The task's classes after classes as a row of a bucket below 0."""
            bucket = -1 - TaskContext.get().partitionId() % buckets
            return pa.RecordBatch.from_arrays([pa.array([bucket]), *(pa.array([x], pa.binary()) for x in (b"", b"", cells.tobytes()))], names=["bucket", "w", "key", "n"])

        def near(batches):
            cells, most = np.zeros(k * k, np.int64), len(frequent.value) * width
            kind = np.int32 if most < 1 << 31 else np.int64  # half the bytes take half the time
            cls = frequent.value.astype(kind)
            for codes in pieces(batches, end):
                codes = codes.astype(kind)
                known = (codes[:-1] >= 0) & (codes[1:] >= 0)
                a, b = codes[:-1][known], codes[1:][known]
                before, after = cls[a], cls[b]
                cells += np.bincount(before * k + after, minlength=k * k)
                own = a == b
                after[own] = 2 * k
                front, back = np.flatnonzero(a % 2 == turn), np.flatnonzero(~own & (b % 2 == turn))
                pair = np.concatenate((a[front] * width + after[front], b[back] * width + k + before[back]))
                pair.sort()
                first = np.flatnonzero(np.diff(pair, prepend=-1))
                if len(first):
                    word, key = np.divmod(pair[first].astype(np.int64), width)
                    yield dealt(word % buckets, w=word, key=key.astype(np.int16), n=np.diff(first, append=len(pair)))
            yield crossed(cells)

        def far(batches):
            cls, cells = frequent.value, np.zeros(k * k, np.int64)
            for batch in batches:
                for row in batch.to_pylist():
                    w, a, b, known, of_known = numbers(row, "w", "before", "after", "rare", "cls")
                    c = of_known[np.searchsorted(known, w)]
                    own, left, right = b == w, a >= 0, b >= 0
                    cells += np.bincount(cls[a[left]] * k + c[left], minlength=k * k)
                    front, back, mine = (a != w) & (~left | (a % 2 == turn)), ~own & (b % 2 == turn), left & (w % 2 == turn)
                    words = [a[front], b[back], w[own], w[right], w[mine], known]
                    keys = [c[front], k + c[back], np.full(own.sum(), 2 * k), cls[b[right]], k + cls[a[mine]], 2 * k + 1 + of_known]
                    words, keys = np.concatenate(words), np.concatenate(keys)
                    words, keys, n = summed(words, keys, np.ones(len(words), np.int64), width)
                    yield dealt(words % buckets, w=words, key=keys.astype(np.int16), n=n)
            yield crossed(cells)

        def merge(group):
            cls = frequent.value
            parts = [numbers(row, "w", "key", "n") for row in group.select(["w", "key", "n"]).to_pylist()]
            if group["bucket"][0].as_py() < 0:
                return pa.table([group["bucket"].slice(0, 1), *([b""],) * 5, pa.array([sum(n for _, _, n in parts)], pa.list_(pa.int64()))], names=names)
            w, key, n = summed(*map(np.concatenate, zip(*parts)), width)
            first = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
            word = np.repeat(np.arange(len(first)), np.diff(first, append=len(w)))
            word_w, tag = w[first], key > 2 * k
            old = np.where(word_w < 0, 0, cls[np.maximum(word_w, 0)])
            old[word[tag]] = key[tag] - 2 * k - 1
            word, key, n = word[~tag], key[~tag], n[~tag]
            one = (word_w[word] < 0) & ((key < k) | (key == 2 * k))
            to = np.where(key[one] < k, key[one], old[word[one]])
            cells = np.bincount(old[word[one]] * k + to, n[one], k * k).astype(np.int64)
            held = [word_w, old, word, key.astype(np.int16), n]
            return pa.table([group["bucket"].slice(0, 1), *([c.tobytes()] for c in held), pa.array([cells], pa.list_(pa.int64()))], names=names)

        names = ["bucket", "words", "old", "word", "key", "n", "cells"]
        entries = texts.mapInArrow(near, entry).union(places.join(rare.hint("merge"), "bucket").mapInArrow(far, entry))
        return entries.groupBy("bucket").applyInArrow(merge, "bucket long, words binary, old binary, word binary, key binary, n binary, cells array<long>")

    def added(batches):
        """The cells of all rows of a task, added up."""
        cells = np.zeros(k * k, np.int64)
        for batch in batches:
            cells += batch.column("cells").flatten().to_numpy().reshape(-1, k * k).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([cells], pa.list_(pa.int64()))], names=["cells"])

    def chosen(entries, table, turn):
        """The words whose turn it is with their new classes, and all beyond the vocabulary."""
        table = spark.sparkContext.broadcast(table)

        def choose(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    if row["bucket"] < 0:
                        continue
                    words, old, word, key, n = numbers(row, "words", "old", "word", "key", "n")
                    new = moved(table.value, old, word, key, n, words % 2 == turn)
                    at = int(np.searchsorted(words, 0))  # other words have numbers below
                    held = [words[:at], new[:at], words[at:], new[at:]]
                    yield pa.RecordBatch.from_arrays([pa.array([row["bucket"]]), *(pa.array([x.tobytes()]) for x in held)], names=names)

        names = ["bucket", "rare", "cls", "frequent", "to"]
        return entries.drop("cells").mapInArrow(choose, "bucket long, rare binary, cls binary, frequent binary, to binary")

    def listed(rare):
        """The other words with their counts and classes."""

        def each(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    words, of = numbers(row, "rare", "cls")
                    yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(of, pa.int32())], names=["w", "cls"])

        return others.select(F.bitwise_not("w").alias("w"), "n").join(rare.select("rare", "cls").mapInArrow(each, "w long, cls int"), "w")

    history, kept = [], None
    for at in count():
        turn = at % 2
        entries = stored(counted(cls, rare, turn), f"{path}/entries{at}")
        cells = entries.select("cells").coalesce(16).mapInArrow(added, "cells array<long>").toArrow()  # at most 16 rows of classes squared
        table = np.sum(cells["cells"].to_pylist(), 0, float).reshape(k, k) if cells.num_rows else np.zeros((k, k))
        history.append(likelihood(table) / np.log(10) / max(N, 1))
        if at and history[-1] < history[-2]:
            break
        kept = cls, rare, table
        if not N or at > 1 and history[-1] < history[-3] + LEAST:
            break
        changed = stored(chosen(entries, table, turn), f"{path}/classes{at}")
        dropped(spark, f"{path}/entries{at}", *([f"{path}/classes{at - 2}"] if at > 1 else []))
        cls = cls.copy()
        for row in changed.select("frequent", "to").toArrow().to_pylist():  # at most as many words as the vocabulary
            words, to = numbers(row, "frequent", "to")
            cls[words] = to
        rare = changed.select("bucket", "rare", "cls")
    cls, rare, table = kept
    return cls, listed(rare), table, k


def score(
    docs: DataFrame,
    top: int = TOP,
    units: int = UNITS,
    classes: int = CLASSES,
    text: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """One row per row of ``docs``, a stored table: rid, doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    spark = docs.sparkSession
    path = scratch(spark, "brown")
    rows = numbered(docs, text, id_col)
    held_out = crc_fold(F.col("doc_id"), 5) == 1
    counts = stored(rows.filter(~held_out).select("body").mapInArrow(_gather, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")), f"{path}/counts")
    N, V = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = int(counts.filter(F.col("w") == END).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    above, others = (part.filter(F.col("w") != END) for part in most_frequent(counts, "n", top))
    frequent = above.toArrow()  # at most top rows
    words, times = np.append(frequent["w"].to_numpy(), END), np.append(frequent["n"].to_numpy(), ends)
    order = np.lexsort((words, -times))
    vocabulary = Vocabulary(words[order].astype(np.uint64), times[order], units)
    held = share(spark, vocabulary)
    end = int(vocabulary.look_up(np.array([END], np.uint64))[0])

    def encode(batches):
        """Numbers of the tokens of each text, and its other words with what stands before and after."""
        voc = shared(Vocabulary, held.value)
        for batch in batches:
            for part in some_texts(batch, "body"):
                hashes, place, begin = spelled(part.column("body"))
                code = voc.look_up(hashes)[place]
                at = np.flatnonzero(code < 0)
                listed = np.maximum(code, -1).astype(np.int32)
                codes = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer((4 * begin).astype(np.int32)), pa.py_buffer(listed)])
                bounds = pa.array(np.searchsorted(at, begin), pa.int32())
                # each text ends in the end, so all other words have a token after them, and one before but at the start
                around = [pa.ListArray.from_arrays(bounds, pa.array(c)) for c in (code[at], np.append(end, code)[at], code[at + 1])]
                yield pa.RecordBatch.from_arrays([part.column("rid"), part.column("doc_id"), codes, *around], schema=encoded)

    longs = pa.list_(pa.int64())
    encoded = pa.schema(
        [("rid", pa.int64()), ("doc_id", pa.int64()), ("codes", pa.binary()), ("rare", longs), ("before", longs), ("after", longs)]
    )
    texts = stored(
        rows.mapInArrow(encode, "rid long, doc_id long, codes binary, rare array<long>, before array<long>, after array<long>"), f"{path}/texts"
    )
    cls, rare, table, k = clustered(texts.filter(~held_out), others, vocabulary, end, int(N), classes, path)

    others = stored(rare, f"{path}/others")
    seen = others.groupBy("cls").agg(F.sum(F.col("n") + 0.5).alias("n"), F.sum((F.col("n") == 1).cast("long")).alias("once")).toArrow()  # a row per class
    of_class = np.bincount(cls, np.where(vocabulary.counts > 0, vocabulary.counts + 0.5, 0), k)
    once = np.bincount(cls, vocabulary.counts == 1, k)
    np.add.at(of_class, seen["cls"].to_numpy(), seen["n"].to_numpy())
    np.add.at(once, seen["cls"].to_numpy(), seen["once"].to_numpy())
    unknown = int(once.argmax() if once.any() else cls[-1])
    of_class[unknown] += 0.5
    step = transitions(table, of_class)
    emit = np.log10((vocabulary.counts + 0.5) / of_class[cls])
    base = np.log10((vocabulary.counts + 0.5) / (N + 0.5 * (V + 1)))
    base_open = float(np.log10(1 / (N + 0.5 * (V + 1))))
    model = spark.sparkContext.broadcast((cls, step, emit, base, vocabulary.counts > 0))

    def run(batches):
        cls, step, emit, base, seen = model.value
        names = ["rid", "doc_id", "n_tokens", "n_frequent", "base_part", "score_part"]
        for batch in batches:
            out = []
            for rid, doc_id, body in arrow_rows([batch], "rid", "doc_id", "codes"):
                code = np.frombuffer(body, np.int32)
                known = code[code >= 0]
                follow = np.append(end, code)
                a, b = follow[:-1], code
                near = (a >= 0) & (b >= 0)
                steps = step[cls[a[near]], cls[b[near]]].sum()
                out.append((rid, doc_id, len(code), int(seen[known].sum()), float(base[known].sum()), float(emit[known].sum() + steps)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), [pa.int64()] * 4 + [pa.float64()] * 2)], names=names)

    parts = texts.select("rid", "doc_id", "codes").mapInArrow(
        run, "rid long, doc_id long, n_tokens long, n_frequent long, base_part double, score_part double"
    )
    weights = spark.sparkContext.broadcast((unknown, of_class))

    def passed(batches):
        """What a place of another word adds: its frequency, and the steps from and to words of the vocabulary."""
        (cls, step, *_), (unknown, of_class) = model.value, weights.value
        for batch in batches:
            rid, n, c, before, after = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("rid", "n", "cls", "before", "after"))
            known = n > 0
            c = np.where(known, c, unknown)
            weight = np.log10(n + 0.5)
            score = weight - np.log10(of_class[c])
            left, right = before >= 0, after >= 0
            score[left] += step[cls[before[left]], c[left]]
            score[right] += step[c[right], cls[after[right]]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (rid, known.astype(np.int64), weight, score)], names=["rid", "known", "weight", "score"])

    def between(batches):
        """The steps between two such words."""
        step = model.value[1]
        for batch in batches:
            rid, a, b = (batch.column(x).to_numpy() for x in ("rid", "a", "b"))
            yield pa.RecordBatch.from_arrays([pa.array(rid), pa.array(step[a, b])], names=["rid", "score"])

    places = texts.select("rid", F.explode(F.arrays_zip("rare", "before", "after")).alias("r")).select(
        "rid", F.col("r.rare").alias("w"), "r.before", "r.after"
    )
    zero = F.lit(0).cast("long")
    class_or = F.coalesce("cls", F.lit(unknown))
    alone = (
        places.join(others, "w", "left")
        .select("rid", F.coalesce("n", zero).alias("n"), class_or.alias("cls"), "before", "after")
        .mapInArrow(passed, "rid long, known long, weight double, score double")
    )
    class_of = others.select("w", "cls")
    pairs = (
        places.filter("after < 0")
        .join(class_of, "w", "left")
        .select("rid", class_or.alias("a"), F.col("after").alias("w"))
        .join(class_of, "w", "left")
        .select("rid", "a", class_or.alias("b"))
        .mapInArrow(between, "rid long, score double")
    )
    added = alone.groupBy("rid").agg(
        F.count("*").alias("n_rare"), F.sum("known").alias("known_rare"), F.sum("weight").alias("weight"), F.sum("score").alias("model")
    )
    stepped = pairs.groupBy("rid").agg(F.sum("score").alias("steps"))
    none = F.lit(0.0)
    return (
        parts.join(added, "rid", "left")
        .join(stepped, "rid", "left")
        .select(
            "rid",
            "doc_id",
            held_out.alias("held_out"),
            "n_tokens",
            (F.col("n_frequent") + F.coalesce("known_rare", zero)).alias("n_known"),
            F.lit(int(N)).cast("long").alias("train_tokens"),
            (F.col("base_part") + F.coalesce("weight", none) + F.coalesce("n_rare", zero) * base_open).alias("base_score"),
            (F.col("score_part") + F.coalesce("model", none) + F.coalesce("steps", none)).alias("score"),
        )
        .withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
    )
