"""Toxicity by class-conditional Kneser-Ney models.

Words are sequences of characters. A model of ``ORDER`` characters is counted
for toxic and one for ordinary texts; both back off to the same continuation
counts, pooled over the classes, so that a rare expression leans on the
spellings that the corpus shares. The log-likelihood ratio of a text, normalised
by its length, and that of its most suspicious ``WINDOW`` words and single words
go through a logistic curve to a score between 0 and 1.

The labelled rows that are learnt from are bounded: about ``PER_CLASS`` of each
class, those with a small hash of the id. All their character sequences are
kept, since the rare ones are what continuation counts and discounts are made
of. The model is therefore bounded whatever the corpus, and scoring is one pass
over whole texts without a shuffle. The curve is fitted
on rows that its model hasn't seen; then the model is counted again from all.

NULL and blank texts have no words and get the score of an unremarkable empty
text. Rows may repeat. Labels that contradict each other count on both sides,
labels that are NULL or of unknown ids on none. Without labels of both classes
every score is 0.5. One result row per input row.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .anchors import mix
from .common import arrow_out, arrow_rows, crc_fold, numbered, placed, scratch, share, shared, stored, whole_row

ORDER, DISCOUNT = 6, 0.75
#: Bound of what is learnt from: rows of a class.
PER_CLASS = 6000
WINDOW = 40
THRESHOLD = 0.7
#: Bytes of words whose ratio a task remembers.
REMEMBERED = 32 << 20
#: Sequences whose ratio a task remembers, 16 bytes each.
STEPS = 1 << 21
PAD = "\x02" * (ORDER - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_TRIM = ".,;:!?\"'()[]{}|*%#&$<>"


def spelled(token: str) -> list[str]:
    """The character sequences of a word, each the next character after its ``ORDER - 1`` predecessors."""
    word = PAD + token.strip(_TRIM) + "\x03"
    return [word[i : i + ORDER] for i in range(len(word) - ORDER + 1)]


def _sequences(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The sequences of :func:`spelled` of all words as rows of code points, and where each word's begin."""
    bare = [w.strip(_TRIM) for w in words]
    n = np.fromiter(map(len, bare), np.int64, len(bare)) + 1
    text = PAD + ("\x03" + PAD).join(bare) + "\x03"
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    begin = np.cumsum(n) - n
    at = np.arange(n.sum()) + np.repeat(np.arange(len(n)) * (ORDER - 1), n)
    return codes[at[:, None] + np.arange(ORDER)], begin


def _hash(sequences: np.ndarray) -> np.ndarray:
    out = np.zeros(len(sequences), np.uint64)
    for codes in sequences.T:
        out = mix(out * _ODD + codes + np.uint64(1))
    return out


def _table(keys: np.ndarray, *columns: np.ndarray) -> dict[str, object]:
    """Columns by distinct 64-bit keys, in slots that follow from the key, the next free one if taken."""
    size = 1 << max(4, (2 * len(keys)).bit_length())
    slots, left = np.zeros(size, np.int32), np.arange(len(keys), dtype=np.int32)
    at = (keys & np.uint64(size - 1)).astype(np.int64)
    while len(left):
        free = slots[at] == 0
        slots[at[free]] = left[free] + 1
        again = slots[at] != left + 1
        left, at = left[again], (at[again] + 1) & (size - 1)
    return {"keys": keys, "slots": slots, "columns": columns}


def _find(table: dict[str, object], keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Whether each key is in the table, and its columns' values, 0 without."""
    slots, known = table["slots"], table["keys"]
    row, left, at = np.full(len(keys), -1), np.arange(len(keys)), (keys & np.uint64(len(slots) - 1)).astype(np.int64)
    while len(left):
        here = slots[at] - 1
        hit = here >= 0
        hit[hit] = known[here[hit]] == keys[left[hit]]
        row[left[hit]] = here[hit]
        go = ~hit & (here >= 0)
        left, at = left[go], (at[go] + 1) & (len(slots) - 1)
    found = row >= 0
    out = [np.zeros(len(keys)) for _ in table["columns"]]
    for values, column in zip(out, table["columns"]):
        values[found] = column[row[found]]
    return found, out


class Ratio:
    """Log-likelihood ratio of words, toxic against ordinary.

    All that was counted is held as numbers by 64-bit hashes of sequences, looked up for many words at once.
    """

    def __init__(self, counts: dict[str, tuple[int, int]]):
        grams = np.frombuffer("".join(counts).encode("utf-32-le"), np.uint32).reshape(-1, ORDER)
        pairs = np.array(list(counts.values()), np.float64).reshape(-1, 2)
        self.counts = _table(_hash(grams), pairs[:, 0], pairs[:, 1])
        #: By context: how many characters followed, and how many different ones, of ordinary and of toxic rows.
        contexts, group = np.unique(_hash(grams[:, :-1]), return_inverse=True)
        sums = [np.bincount(group, w, len(contexts)) for side in (0, 1) for w in (pairs[:, side], pairs[:, side] > 0)]
        self.follow = _table(contexts, *sums)
        # Shared lower orders, the longest first: in how many ways a sequence continues one that is
        # longer by a character, and the same sums for its contexts.
        self.ways, self.followed, longer = [], [], grams
        for _ in range(ORDER - 1):
            shorter, first, group = np.unique(_hash(longer[:, 1:]), return_index=True, return_inverse=True)
            ways = np.bincount(group, minlength=len(shorter)).astype(np.float64)
            longer = longer[first, 1:]
            contexts, group = np.unique(_hash(longer[:, :-1]), return_inverse=True)
            self.ways.append(_table(shorter, ways))
            self.followed.append(_table(contexts, np.bincount(group, ways, len(contexts)), np.bincount(group, minlength=len(contexts))))
        self.characters = len(longer) + 1
        self.words: dict[str, float] = {}
        self.held = 0
        #: What the last sequences said, each at the place that its hash gives; made where it's needed.
        self.last: tuple[np.ndarray, np.ndarray] | None = None

    def chances(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chance of the last character of each sequence in both classes, and whether either knows the context."""
        # Kneser-Ney from the pooled continuation counts, the shortest sequences first
        share = np.full(len(grams), 1 / self.characters)
        for ways, followed, at in reversed(list(zip(self.ways, self.followed, range(1, ORDER)))):
            known, (total, kinds) = _find(followed, _hash(grams[:, at:-1]))
            n = _find(ways, _hash(grams[:, at:]))[1][0]
            lower = (np.maximum(n - DISCOUNT, 0) + DISCOUNT * kinds * share) / np.where(known, total, 1)
            share = np.where(known, lower, share)
        seen, follow = _find(self.follow, _hash(grams[:, :-1]))
        counts, out = _find(self.counts, _hash(grams))[1], []
        for side in (0, 1):
            total, kinds = follow[2 * side : 2 * side + 2]
            own = (np.maximum(counts[side] - DISCOUNT, 0) + DISCOUNT * kinds * share) / np.where(total > 0, total, 1)
            out.append(np.where(total > 0, own, share))
        return out[0], out[1], seen

    def chance(self, gram: str, side: int) -> float:
        """Chance of the last character in a class."""
        return float(self.chances(np.frombuffer(gram.encode("utf-32-le"), np.uint32)[None, :])[side][0])

    def steps(self, grams: np.ndarray) -> np.ndarray:
        """The log-likelihood ratios of the last characters; after a context that neither class knows it's 0."""
        if self.last is None:
            self.last = np.zeros(STEPS, np.uint64), np.zeros(STEPS)
        keys, said = self.last
        h = _hash(grams)
        at = (h & np.uint64(STEPS - 1)).astype(np.int64)
        out, new = said[at], np.flatnonzero(keys[at] != h)
        _, first, same = np.unique(h[new], return_index=True, return_inverse=True)
        ordinary, toxic, seen = self.chances(grams[new[first]])
        fresh = np.where(seen, np.log(toxic / ordinary), 0.0)
        out[new] = fresh[same]
        # of sequences with one place the last stays, key and value alike
        keys[at[new[first]]], said[at[new[first]]] = h[new[first]], fresh
        return out

    def ratios(self, words: list[str]) -> np.ndarray:
        """The sums over the words' sequences."""
        out = []
        for i in range(0, len(words), 1 << 14):
            grams, begin = _sequences(words[i : i + (1 << 14)])
            out.append(np.add.reduceat(self.steps(grams), begin))
        return np.concatenate(out) if out else np.zeros(0)

    def __call__(self, word: str) -> float:
        return float(self.ratios([word])[0])

    def learn(self, words: set[str]) -> dict[str, float]:
        """Ratios that hold these words; so many others are remembered that they take about ``REMEMBERED`` bytes."""
        if self.held > REMEMBERED:
            self.words, self.held = {}, 0
        new = list(words - self.words.keys())
        self.words.update(zip(new, self.ratios(new).tolist()))
        self.held += sum(map(len, new)) + 150 * len(new)
        return self.words


def features(tokens: list[str], known: dict[str, float]) -> list[float]:
    """Mean ratio of the text's words, of its worst window, of its worst three words, and its share of suspicious words."""
    if not tokens:
        return [0.0] * 4
    each = np.clip(np.array([known[t] for t in tokens]), -12, 12)
    n = len(each)
    if n <= WINDOW:
        worst = each.sum() / (n + 5)
    else:
        sums = np.concatenate(([0], np.cumsum(each)))
        worst = float((sums[WINDOW:] - sums[:-WINDOW]).max()) / (WINDOW + 5)
    top = np.partition(each, n - 3)[-3:].sum() / 3 if n > 3 else each.sum() / 3
    return [float(each.sum() / (n + 5)), float(worst), float(top), float(np.log1p((each > 4).sum()))]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights (the last one is the intercept) of a ridge logistic regression, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _count(labelled: DataFrame, path: str) -> dict[str, tuple[int, int]]:
    """All character sequences of (toxic, body) rows, which are bounded, with their ordinary and toxic counts."""

    def spell(batches):
        schema = pa.schema([("gram", pa.string()), ("ordinary", pa.int64()), ("toxic", pa.int64())])
        for batch in batches:
            words = defaultdict(lambda: [0, 0])
            for toxic, body in arrow_rows([batch], "toxic", "body"):
                for token, n in Counter(body.decode("utf-8", "replace").lower().split()).items():
                    words[token][toxic] += n
            out = defaultdict(lambda: [0, 0])
            for token, (a, b) in words.items():
                for gram in spelled(token):
                    pair = out[gram]
                    pair[0] += a
                    pair[1] += b
            yield from arrow_out(schema, ((g, a, b) for g, (a, b) in out.items()))

    counted = labelled.mapInArrow(spell, "gram string, ordinary long, toxic long").groupBy("gram").agg(
        F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")
    )
    rows = stored(counted, path).toArrow()
    return dict(zip(rows["gram"].to_pylist(), zip(rows["ordinary"].to_pylist(), rows["toxic"].to_pylist())))


def score(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = PER_CLASS,
    text: str = "text",
    id_col: str = "doc_id",
    carry: bool = False,
) -> DataFrame:
    """One row per row of ``docs``, a stored table: rid, doc_id, held_out, score, ratio (per word), predicted.

    With ``carry`` there is also ``row``, a struct of all columns of ``docs``.

    Learns from labels of rows whose crc32 of the id modulo 3 isn't 1.
    """
    spark = docs.sparkSession
    path = scratch(spark, "toxicity")
    rows = numbered(docs, text, id_col)
    fold = crc_fold(F.col("doc_id"), 3)
    known = labels.filter("toxic IN (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).distinct()
    known = known.withColumn("fold", fold).filter("fold <> 1")
    have = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    # a hash of the id deals rows evenly, so a bound on it keeps about per_class of each class
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    share_of = F.when(F.col("toxic") == 1, per_class / max(1, have.get(1, 0))).otherwise(per_class / max(1, have.get(0, 0)))
    chosen = known.filter(place < share_of)
    chosen = stored(chosen, f"{path}/chosen")
    sample = stored(rows.select("doc_id", "body").join(F.broadcast(chosen), "doc_id").select("toxic", "fold", "body"), f"{path}/sample")

    def measured(df: DataFrame, ratio: Ratio, keep: list[str]) -> DataFrame:
        held = share(spark, ratio)

        def measure(batches):
            ratio = shared(Ratio, held.value)
            for batch in batches:
                x = []
                for at in range(0, batch.num_rows, 64):
                    bodies = batch.column("body").slice(at, 64).to_pylist()
                    tokens = [body.decode("utf-8", "replace").lower().split() for body in bodies]
                    known = ratio.learn(set().union(*tokens))
                    x += [features(t, known) for t in tokens]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in keep), pa.array(x, pa.list_(pa.float64()))], names=[*keep, "x"]
                )

        return df.select(*keep, "body").mapInArrow(measure, df.select(*keep).schema.add("x", T.ArrayType(T.DoubleType())))

    sides = {(r["toxic"], r["fold"]) for r in sample.select("toxic", "fold").distinct().collect()}
    if len(sides) < 4:  # a class or a part of it is missing
        weights, ratio = np.zeros(5), Ratio({})
    else:
        first = Ratio(_count(sample.filter("fold = 0").select("toxic", "body"), f"{path}/first"))
        unseen = measured(sample.filter("fold = 2"), first, ["toxic"]).toArrow()  # about twice per_class rows at most
        weights = logistic(np.array(unseen["x"].to_pylist()), unseen["toxic"].to_numpy().astype(float))
        # the classes were taken in other shares than they have among the labels
        taken = {r["toxic"]: r["count"] for r in chosen.groupBy("toxic").count().collect()}
        del first
        weights[-1] += log(have[1] / have[0]) - log(taken[1] / taken[0])
        ratio = Ratio(_count(sample.select("toxic", "body"), f"{path}/all"))
    total = F.lit(float(weights[-1]))
    for i in range(4):
        total = total + F.col("x")[i] * float(weights[i])
    out = measured(rows, ratio, ["rid", "doc_id"]).withColumn("score", 1 / (1 + F.exp(-total)))
    ratio_of, predicted = F.col("x")[0].alias("ratio"), (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    out = out.select("rid", "doc_id", (fold == 1).alias("held_out"), "score", ratio_of, predicted)
    return out.join(placed(docs, whole_row(docs)), "rid") if carry else out
