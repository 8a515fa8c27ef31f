"""Learnt operators, tiling, archives, chats and the pipeline."""

from __future__ import annotations

import gzip
import hashlib
import io
import os
import random
import zlib
from collections import Counter
from math import log10

import numpy as np
import pyarrow as pa
import pytest
import xxhash

import corpus_pipeline
from traffic_lake.llm import brown_lm, perspectives, string_tiling, toxicity, warc

from . import tables

ROWS = tables.awkward_documents()


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    return tables.documents(spark, str(tmp_path_factory.mktemp("d")), ROWS)


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    return tables.documents(spark, str(tmp_path_factory.mktemp("e")), [])


def labelled(spark, path, rows):
    return spark.read.parquet(tables.write(path, {"doc_id": pa.int64(), "quality": pa.int32(), "toxic": pa.int32()}, rows))


# Toxicity


def rude_corpus(n: int = 600):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.3)
        words = tables.prose(rng, rng.randint(20, 400)).split()
        if toxic:
            for _ in range(rng.randint(3, 6)):
                words.insert(rng.randrange(len(words)), "grob" + rng.choice(["ian", "ist", "es", "er", "heit", "rau", "lo"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return rows, labels


def test_toxic_texts_are_found(spark, tmp_path):
    rows, labels = rude_corpus()
    df = tables.documents(spark, f"{tmp_path}/d", rows + [(10_000, None), (None, "x"), (3, rows[3][1])])
    got = toxicity.score(df, labelled(spark, f"{tmp_path}/l", [*labels, (99_999, 1, 1), (4, 1, None)])).collect()
    truth = {i: t for i, _, t in labels}
    assert Counter(r.doc_id for r in got) == Counter([i for i, _ in rows] + [10_000, None, 3])
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [r for r in got if r.doc_id in truth and r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97


def test_held_out_labels_do_not_matter(spark, tmp_path):
    rows, labels = rude_corpus(300)
    df = tables.documents(spark, f"{tmp_path}/d", rows)
    other = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    a, b = (
        {r.doc_id: r.score for r in toxicity.score(df, labelled(spark, f"{tmp_path}/{n}", x)).collect()}
        for n, x in enumerate((labels, other))
    )
    assert a == pytest.approx(b)


def test_carried_rows(spark, docs, tmp_path):
    out = toxicity.score(docs, labelled(spark, str(tmp_path), []), carry=True)
    assert {r.score for r in out.collect()} == {0.5}
    assert sorted(map(str, out.select("row.*").collect())) == sorted(map(str, docs.collect()))


def test_ratio_is_a_ratio_of_distributions():
    counts = Counter()
    words = [("abab", 0), ("abba", 0), ("baab", 1), ("aaaa", 1), ("abab", 1)]
    for w, side in words:
        for g in toxicity.spelled(w):
            counts[g, side] += 1
    ratio = toxicity.Ratio({g: (counts[g, 0], counts[g, 1]) for g, _ in counts})
    letters = {g[-1] for g, _ in counts} | {"z"}  # z stands for what was never seen
    for context in {g[:-1] for g, _ in counts} | {"unseen"[: toxicity.ORDER - 1]}:
        for side in (0, 1):
            assert sum(ratio.chance(context + x, side) for x in letters) == pytest.approx(1)
    assert ratio("abba") < 0 < ratio("baab") and ratio("(abab).") == ratio("abab")


def plain_ratio(counts, word):
    """The definition, one sequence at a time."""
    levels = [set(counts)]
    for _ in range(toxicity.ORDER - 1):
        levels.append({g[1:] for g in levels[-1]})
    characters, d = len(levels[-1]) + 1, toxicity.DISCOUNT

    def shared(gram):
        if not gram:
            return 1 / characters
        lower, longer = shared(gram[1:]), levels[toxicity.ORDER - 1 - len(gram)]
        ways = Counter(g[1:] for g in longer)
        same = {g: n for g, n in ways.items() if g[:-1] == gram[:-1]}
        if not same:
            return lower
        return (max(ways[gram] - d, 0) + d * len(same) * lower) / sum(same.values())

    def chance(gram, side):
        same = [n[side] for g, n in counts.items() if g[:-1] == gram[:-1] and n[side]]
        if not same:
            return shared(gram[1:])
        return (max(counts.get(gram, (0, 0))[side] - d, 0) + d * len(same) * shared(gram[1:])) / sum(same)

    contexts = {g[:-1] for g in counts}
    return sum(np.log(chance(g, 1) / chance(g, 0)) for g in toxicity.spelled(word) if g[:-1] in contexts)


def test_ratios_equal_the_definition():
    rng = random.Random(8)
    counts: dict[str, tuple[int, int]] = {}
    for _ in range(60):
        for g in toxicity.spelled("".join(rng.choice("abé😀") for _ in range(rng.randint(0, 7)))):
            a, b = counts.get(g, (0, 0))
            counts[g] = (a + 1, b) if rng.random() < 0.6 else (a, b + 1)
    words = ["", "...", "a", "(ab)", "xyz", "abxab", "😀é", "b" * 300] + ["".join(rng.choice("abé😀z") for _ in range(6)) for _ in range(40)]
    ratio = toxicity.Ratio(counts)
    assert ratio.ratios(words) == pytest.approx([plain_ratio(counts, w) for w in words])
    assert ratio.learn(set(words)) == pytest.approx({w: plain_ratio(counts, w) for w in words})


def test_score_is_the_curve_of_the_features(spark, tmp_path, monkeypatch):
    """The query's scores from plain counts, ratios and features of the same rows."""
    rows, labels = rude_corpus(120)
    fits = []
    curve = toxicity.logistic
    monkeypatch.setattr(toxicity, "logistic", lambda x, y: fits.append((x, y)) or curve(x, y))
    monkeypatch.setattr(toxicity, "REMEMBERED", 1000)
    got = {r.doc_id: r for r in toxicity.score(tables.documents(spark, f"{tmp_path}/d", rows), labelled(spark, f"{tmp_path}/l", labels)).collect()}
    fold, toxic, text = (lambda i: zlib.crc32(str(i).encode()) % 3), {i: t for i, _, t in labels}, dict(rows)

    def counted(folds):
        counts: dict[str, list[int]] = {}
        for i, t in rows:
            if fold(i) in folds:
                for token in t.lower().split():
                    for g in toxicity.spelled(token):
                        counts.setdefault(g, [0, 0])[toxic[i]] += 1
        return {g: tuple(n) for g, n in counts.items()}

    def measured(counts, i):
        tokens = text[i].lower().split()
        return toxicity.features(tokens, dict(zip(tokens, toxicity.Ratio(counts).ratios(tokens))))

    (x, y), first = fits[0], counted({0})
    expected = sorted((toxic[i], *measured(first, i)) for i, _ in rows if fold(i) == 2)
    assert sorted((int(b), *a) for a, b in zip(x.tolist(), y)) == [pytest.approx(e) for e in expected]
    weights, every = curve(x, y), counted({0, 2})
    for i, _ in rows:
        score = 1 / (1 + np.exp(-(np.dot(measured(every, i), weights[:4]) + weights[4])))
        assert got[i].score == pytest.approx(score, rel=1e-6)


# Language model


def base_by_hand(rows):
    def split(t):
        return [*(t or "").encode().lower().split(), b"\n"]

    def fold(i):
        return zlib.crc32(b"" if i is None else str(i).encode()) % 5

    counts = Counter(w for i, t in rows if fold(i) != 1 for w in split(t))
    N, V = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        w = split(t)
        base = sum(log10((counts[x] + 0.5) / (N + 0.5 * (V + 1))) for x in w)
        out.append((i, fold(i) == 1, len(w), sum(counts[x] > 0 for x in w), N, base))
    return out


def by_id(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, round(v, 6) if isinstance(v, float) else v) for v in r))


@pytest.mark.parametrize("top, units", [(300_000, 1000), (20, 8), (1, 1)])
def test_base_scores(docs, top, units):
    got = brown_lm.score(docs, top=top, units=units, classes=4).collect()
    mine = by_id((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got)
    for a, b in zip(mine, by_id(base_by_hand(ROWS)), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])


def test_model_learns_order(spark, tmp_path):
    rng = random.Random(4)
    kinds = [[f"{k}{i}" for i in range(12)] for k in "abc"]
    rows = [(i, " ".join(rng.choice(kinds[j % 3]) for j in range(rng.randint(30, 90)))) for i in range(300)]
    got = brown_lm.score(tables.documents(spark, str(tmp_path), rows), units=50, classes=4).filter("held_out").collect()
    assert sum(r.score for r in got) > 0.75 * sum(r.base_score for r in got)  # logs of probabilities, so less is worse


def test_exchange_finds_the_classes():
    rng = np.random.default_rng(0)
    kind = np.arange(30) % 3
    pairs = np.zeros((30, 30))
    for _ in range(6000):
        a = rng.integers(30)
        b = rng.choice(np.flatnonzero(kind == (kind[a] + 1) % 3))
        pairs[a, b] += 1
    cls = brown_lm.exchange(pairs, 3, 20)
    assert len({(k, c) for k, c in zip(kind.tolist(), cls.tolist())}) == 3


def test_each_word_moves_to_its_best_class():
    rng = np.random.default_rng(3)
    units, k = 40, 5
    pairs = np.zeros((units, units))
    for a in rng.integers(0, units, 2000):
        pairs[a, (a * 3 + rng.integers(0, 6)) % units] += 1
    pairs[7, 7] += 4
    old = rng.integers(0, k, units)

    def table(cls):
        member = np.eye(k)[cls]
        return member.T @ pairs @ member

    entries = []
    for u in range(units):
        for key in range(2 * k):
            line = pairs[u] if key < k else pairs[:, u]
            n = sum(line[v] for v in range(units) if v != u and old[v] == key % k)
            entries += [(u, key, n)] if n else []
        entries += [(u, 2 * k, pairs[u, u])] if pairs[u, u] else []
    turn = np.arange(units) % 3 > 0
    got = brown_lm.moved(table(old), old, *map(np.array, zip(*entries)), turn)
    for u in range(units):
        found = [brown_lm.likelihood(table(np.where(np.arange(units) == u, c, old))) for c in range(k)]
        assert got[u] == (np.argmax(found) if turn[u] else old[u])


def model_by_hand(rows, cls, classes):
    """Scores with the given class of each training word; unknown words in the class with the most words seen once."""

    def split(t):
        return [*(t or "").encode().lower().split(), b"\n"]

    train = [split(t) for i, t in rows if zlib.crc32(b"" if i is None else str(i).encode()) % 5 != 1]
    counts = Counter(w for t in train for w in t)
    table, weight, once = np.zeros((classes, classes)), np.zeros(classes), np.zeros(classes, int)
    for t in train:
        for a, b in zip([b"\n", *t], t):
            table[cls[a], cls[b]] += 1
    for w, n in counts.items():
        weight[cls[w]] += n + 0.5
        once[cls[w]] += n == 1
    weight[once.argmax()] += 0.5
    step = brown_lm.transitions(table, weight)
    out = []
    for i, t in rows:
        w = split(t)
        c = [cls.get(x, once.argmax()) for x in [b"\n", *w]]
        emit = sum(log10((counts[x] + 0.5) / weight[d]) for x, d in zip(w, c[1:]))
        out.append((i, emit + sum(step[a, b] for a, b in zip(c, c[1:]))))
    return table, out


@pytest.mark.parametrize("top", [300_000, 12, 1])
def test_model_scores_of_all_words(spark, docs, monkeypatch, top):
    """Every training word, however rare, has a class of its own choosing, and scores follow from these classes."""
    found = []
    clustered = brown_lm.clustered

    def watched(texts, others, vocabulary, *rest):
        cls, rare, table, k = clustered(texts, others, vocabulary, *rest)
        numbers = dict(zip(vocabulary.words.tolist(), vocabulary.number.tolist()))
        found.append((numbers, cls, {r.w: r.cls for r in rare.collect()}, table, k))
        return cls, rare, table, k

    monkeypatch.setattr(brown_lm, "clustered", watched)
    got = brown_lm.score(docs, top=top, units=8, classes=4).collect()
    numbers, cls, rare, table, k = found[0]
    words = {w for _, t in ROWS for w in (t or "").encode().lower().split()} | {b"\n"}
    of = {}
    for w in words:
        h = int(brown_lm.tokens(w)[0])
        if h in numbers:
            of[w] = int(cls[numbers[h]])
        elif ~h in rare:
            of[w] = rare[~h]
    assert len(of) == len(numbers) + len(rare)
    assert top > 12 or len(rare) > 20 and len(set(rare.values())) > 1
    mine, want = model_by_hand(ROWS, of, k)
    assert np.array_equal(mine, table)
    for a, b in zip(by_id((r.doc_id, r.score) for r in got), by_id(want), strict=True):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1])


def test_words_move_in_few_rows(docs, monkeypatch):
    """In a round, only words of the vocabulary whose turn it is have entries; places of others are a row per bucket."""
    entries, places = [], []
    stored = brown_lm.stored

    def watched(df, path):
        out = stored(df, path)
        if path.endswith("/places"):
            places.append(out.count())
        if "/entries" in path:
            turn = int(path.rsplit("/entries")[1]) % 2
            entries.extend((turn, w) for r in out.collect() for w in np.frombuffer(r.words, np.int64).tolist())
        return out

    monkeypatch.setattr(brown_lm, "stored", watched)
    brown_lm.score(docs, top=12, units=8, classes=4).count()
    assert any(w < 0 for _, w in entries) and {turn for turn, w in entries if w >= 0} == {0, 1}
    assert all(w < 0 or w % 2 == turn for turn, w in entries)
    assert places == [1]


def test_texts_are_split_as_bytes():
    rng = random.Random(6)
    bodies = [bytes(rng.choice(b"AaBz \t\n\x0b\x0c\r\x1c\x1f\x85\xa0\xc3\x84\x00") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    hashes, place, begin = brown_lm.spelled(pa.array([b"left out", *bodies], pa.binary()).slice(1))
    assert len(hashes) == len(set(hashes.tolist())) and begin[-1] == len(place)
    for body, a, b in zip(bodies, begin, begin[1:]):
        want = [xxhash.xxh64_intdigest(w) >> 1 for w in [*body.lower().split(), b"\n"]]
        assert hashes[place[a:b]].tolist() == want == brown_lm.tokens(body).tolist()
    batch = pa.RecordBatch.from_arrays([pa.array([*bodies, b"a" * (9 << 20), b"", b"b"], pa.binary())], names=["body"])
    assert [part.num_rows for part in brown_lm.some_texts(batch, "body")] == [300, 1, 2]


def test_rare_words_have_classes(spark, tmp_path):
    """Two kinds of words take turns, half of them beyond ``top``; their order shows on rows that nobody learnt from."""
    rng = random.Random(5)
    kinds = [[f"{k}{i}" for i in range(100)] for k in "ab"]
    rows = [(i, " ".join(rng.choice(kinds[j % 2]) for j in range(2 * rng.randint(10, 40)))) for i in range(300)]
    got = brown_lm.score(tables.documents(spark, str(tmp_path), rows), top=100, units=40, classes=4).filter("held_out").collect()
    words = sum(r.n_tokens - 1 for r in got)
    assert sum(r.score - r.base_score for r in got) > 0.2 * words  # half of the words can't come: log10(2) a word at most


def test_probabilities_add_up(spark, tmp_path):
    """All words and one unknown word, each the only word of a text nobody learns from, share what one step from the start has."""
    step = brown_lm.transitions(np.array([[3.0, 0, 1], [0, 0, 0], [2, 2, 2]]), np.array([5.0, 2, 4]))
    assert (10**step).sum(1) == pytest.approx(1)
    held = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 5 == 1]
    learnt = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 != 1]
    rows = list(zip(learnt, ["a b a c", "b a b", "c c a", "a b", "d a b"] * 4))
    rows += list(zip(held, ["a", "b", "c", "d", "unknown", ""]))
    # one class: a step is the frequency of its unit, and the end follows all words alike
    got = {r.doc_id: r for r in brown_lm.score(tables.documents(spark, str(tmp_path), rows), top=3, units=1, classes=1).collect()}
    one = [10 ** got[i].score for i in held[:6]]
    assert sum(one[:5]) / one[5] + one[5] == pytest.approx(1)
    assert got[held[4]].n_known == 1 and got[held[5]].n_tokens == 1


def test_models_on_an_empty_table(spark, nothing, tmp_path):
    assert brown_lm.score(nothing).count() == 0
    assert toxicity.score(nothing, labelled(spark, str(tmp_path), [(1, 1, 1), (2, 1, 0)])).count() == 0


# Tiling


def tile_by_hand(doc, item, least):
    """Greedy string tiling over all pairs of places."""
    used_d, used_i, out = set(), set(), []
    while True:
        best = None
        for j in range(len(item)):
            for i in range(len(doc)):
                n = 0
                while (
                    i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and i + n not in used_d and j + n not in used_i
                ):
                    n += 1
                if n >= least and (best is None or n > best[0]):
                    best = (n, j, i)
        if best is None:
            return out
        out.append(best)
        used_d.update(range(best[2], best[2] + best[0]))
        used_i.update(range(best[1], best[1] + best[0]))


def test_tiles():
    rng = random.Random(6)
    for _ in range(60):
        doc = [rng.choice("abc").encode() for _ in range(rng.randint(0, 40))]
        item = [rng.choice("abc").encode() for _ in range(rng.randint(3, 15))]
        items, index = string_tiling.indexed([(1, b" ".join(item))], 3)
        got = [laid for _, _, laid in string_tiling.contained(b" ".join(doc), items, index, 3)]
        assert (got[0] if got else []) == tile_by_hand(doc, item, 3)


def test_short_items_are_found_whole(spark, tmp_path):
    rows = [(1, "What is the answer"), (2, "so, What IS the answer here"), (3, "what is an answer"), (4, "what is the"), (5, "the yes"), (6, None), (7, "")]
    path = tables.write(str(tmp_path / "b"), {"item_id": pa.int64(), "text": pa.string()}, [(10, "what is the answer"), (11, "yes"), (12, ""), (13, None)], 1)
    got = string_tiling.contamination(tables.documents(spark, str(tmp_path / "d"), rows), spark.read.parquet(path)).collect()
    assert {r.doc_id: [(i.item_id, i.coverage) for i in r["items"] or []] for r in got} == {
        1: [(10, 1.0)], 2: [(10, 1.0)], 3: [], 4: [], 5: [(11, 1.0)], 6: [], 7: []
    }


@pytest.mark.parametrize("block", [string_tiling.BLOCK_BYTES, 100])
def test_contaminated_documents(spark, tmp_path, block):
    rng = random.Random(8)
    items = [" ".join(f"t{rng.randrange(10**6)}" for _ in range(30)) for _ in range(8)]
    split = items[2].split()
    rows = [(i, tables.prose(rng, rng.randint(0, 300))) for i in range(40)]
    rows[3] = (3, rows[3][1] + " " + items[0].upper() + " " + rows[4][1])
    rows[5] = (5, " ".join(split[15:] + ["between"] + split[:15]))  # reordered
    rows[6] = (6, " ".join(split[:12]))  # too little
    rows += [(None, items[1]), (3, rows[3][1]), (50, None), (51, "")]
    bench = spark.read.parquet(
        tables.write(str(tmp_path / "b"), {"item_id": pa.int64(), "text": pa.string()}, [*enumerate(items), (8, None), (9, ""), (10, "too short"), (0, items[0])])
    )
    got = string_tiling.contamination(tables.documents(spark, str(tmp_path / "d"), rows), bench, block_bytes=block).collect()
    hits = sorted((str(r.doc_id), sorted({x.item_id for x in r["items"]})) for r in got if r.contaminated)
    assert hits == [("3", [0]), ("3", [0]), ("5", [2]), ("None", [1])]
    assert len(got) == len(rows)
    assert string_tiling.contamination(tables.documents(spark, str(tmp_path / "x"), rows), bench.limit(0)).filter("contaminated").count() == 0


# Archives


def pages(rng, n=40):
    big = "x" * 150_000
    html = [None, "", "short", "short", big, big, "<p>ü</p>" * 20, "<p>ü</p>" * 20, "a\r\n\r\nb" * 30]
    html += [tables.prose(rng, rng.randint(0, 80)) for _ in range(n)]
    rows = [(i, rng.choice([None, f"http://h/{i}\r\nX: y"]), h, "extra") for i, h in enumerate(html)]
    return rows + [(None, None, big, ""), (4, "u", big, ""), (2, "u", "short", ""), (None, None, None, "")]


def test_archives(spark, tmp_path, monkeypatch):
    rows = pages(random.Random(1))
    df = spark.read.parquet(
        tables.write(str(tmp_path / "p"), {"page_id": pa.int64(), "url": pa.string(), "html": pa.string(), "digest": pa.string()}, rows)
    )
    path = str(tmp_path / "w")
    warc.write_archives(df, path, records=7)
    got = warc.read_archives(spark, path).collect()
    first = {}
    for i, _, h, _ in rows:
        if len((h or "").encode()) >= 100 and i is not None:
            first[h] = min(first.get(h, i), i)
    wanted = []
    for i, _, h, _ in rows:
        b = (h or "").encode()
        to = first.get(h) if h in first and (i is None or i > first[h]) else None
        wanted.append((str(i), len(b), hashlib.sha256(b).hexdigest(), "response" if to is None else "revisit", to, None if to is not None else b, True))
    mine = [(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload, r.verified) for r in got]
    assert sorted(mine, key=str) == sorted([(*w[:5], None if w[5] is None else bytearray(w[5]), w[6]) for w in wanted], key=str)
    files = [f for f in (tmp_path / "w").iterdir() if f.name.startswith("part-")]
    assert len(files) >= len(rows) / 7
    assert sum(gzip.decompress(f.read_bytes()).count(b"WARC/1.1\r\n") for f in files) == len(rows)


@pytest.mark.parametrize("step", [1, 2, 7, 1 << 16])
def test_reader_in_steps_of_any_size(step):
    parts = [warc.record(i, "u", bytes([i]) * (i * 300), i - 1 if i % 3 == 2 else None, "d") for i in range(6)]
    data = warc.EMPTY_MEMBER + warc.EMPTY_MEMBER.join(parts) + warc.EMPTY_MEMBER
    got = list(warc.read_records(io.BytesIO(data), step))
    assert [r.headers["warc-record-id"] for r in got] == [warc.urn(i) for i in range(6)] and all(r.verified for r in got)
    assert [r.payload for r in got] == [b"" if i % 3 == 2 else bytes([i]) * (i * 300) for i in range(6)]


def test_reader_on_broken_archives():
    good = warc.record(1, "u", b"payload" * 30, None, "d")
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(good[:-9])))
    raw = gzip.decompress(good)
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(gzip.compress(raw.replace(b"payloadpayload", b"payload", 1)))))
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(gzip.compress(b"no record"))))
    changed = gzip.compress(raw.replace(b"payload", b"paYload", 1))
    assert [r.verified for r in warc.read_records(io.BytesIO(changed + good))] == [False, True]
    assert list(warc.read_records(io.BytesIO(b""))) == []


def test_archives_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    rows = [(i, None, "x" * (20_000 if i == 5 else 10)) for i in range(40)]
    columns = {"page_id": pa.int64(), "url": pa.string(), "html": pa.string()}
    df = spark.read.parquet(tables.write(str(tmp_path / "p"), columns, rows, 1))
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 50_000)
    warc.write_archives(df, str(tmp_path / "w"))
    files = [f for f in os.listdir(tmp_path / "w") if f.startswith("part-")]
    assert len(files) == 20 and warc.read_archives(spark, str(tmp_path / "w")).count() == 40


def test_empty_archives(spark, tmp_path):
    df = spark.read.parquet(tables.write(str(tmp_path / "p"), {"page_id": pa.int64(), "url": pa.string(), "html": pa.string()}, []))
    assert warc.round_trip(df).count() == 0


# Chats


def test_perspectives(spark):
    rows = [
        (1, 0, "system", "be kind", "z"), (1, 1, "ann", "hi <|end|>", "z"), (1, 2, "bob", "yo", "z"), (1, 3, "ann", None, "z"), (1, 70, "cy", "late", "z"),
        (2, 0, "system", "alone", "z"), (None, None, None, "who", "z"), (None, 1, "", "me", "z"), (3, 5, "ann", "same", "z"), (3, 5, "ann", "same", "z"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, speaker string")
    got = {(r.conv_id, r.speaker, r.part): r for r in perspectives.rotate(df).collect()}
    assert set(got) == {(1, s, p) for s in ("ann", "bob", "cy") for p in (0, 1)} | {(None, "unknown", -1), (None, "unknown", 0), (3, "ann", 0)}
    assert got[1, "ann", 0].text == (
        "<|system|>\nbe kind<|end|>\n<|assistant|>\nhi < |end|><|end|>\n<|user bob|>\nyo<|end|>\n<|assistant|>\n<|end|>\n"
    )
    assert got[1, "bob", 1].text == "<|user cy|>\nlate<|end|>\n" and got[1, "bob", 1].n_target_chars == 0
    assert got[3, "ann", 0].n_messages == 2
    for r in got.values():
        assert sum(m.chars for m in r.mask) == len(r.text)
        at, read = 0, ""
        for m in r.mask:
            read += r.text[at : at + m.chars] if m.train else ""
            at += m.chars
        assert len(read) == r.n_target_chars
        assert read == "".join(x.split("<|end|>\n")[0] + "<|end|>\n" for x in r.text.split("<|assistant|>\n")[1:])
    assert perspectives.rotate(df.limit(0)).count() == 0


# Pipeline


def test_stages(spark, tmp_path):
    rows, labels = rude_corpus(300)
    rng = random.Random(9)
    item = " ".join(f"t{rng.randrange(10**6)}" for _ in range(20))
    base = " ".join(f"n{rng.randrange(10**6)}" for _ in range(3000))
    rows += [(1000, "copy of this"), (1001, "copy of this"), (1002, "and " + item), (1003, base), (1004, base + " end"), (1005, None), (1006, ""), (None, "no id")]
    sf = str(tmp_path / "sf")
    tables.documents(spark, f"{sf}/documents.parquet", rows)
    labelled(spark, f"{sf}/labels.parquet", labels)
    tables.write(f"{sf}/benchmark.parquet", {"item_id": pa.int64(), "text": pa.string()}, [(1, item)])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, left = docs.columns, {i for i, _ in rows}
    gone = []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, sf)
        assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        gone.append(left - now)
        left = now
    truth = {i for i, _, t in labels if t}
    assert len(gone[0] ^ truth) <= 0.05 * len(truth)
    assert gone[1:] == [{1000, 1005}, {1004}, {1002}]
    last = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in last.collect()} == left


def test_pipeline_on_empty_tables(spark, tmp_path):
    sf = str(tmp_path)
    tables.documents(spark, f"{sf}/documents.parquet", [])
    labelled(spark, f"{sf}/labels.parquet", [])
    tables.write(f"{sf}/benchmark.parquet", {"item_id": pa.int64(), "text": pa.string()}, [])
    assert corpus_pipeline.run(spark, sf).count() == 0
