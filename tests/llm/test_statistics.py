"""Fingerprints, whitening and phrases against brute force, with awkward rows."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from traffic_lake.llm import fingerprints, phrases, whitening

from .tables import awkward_documents, documents, write


# Fingerprints


def _fingerprints(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return {r["i"]: r["v"] for r in fingerprints.with_vector(df, "text", "v").select("i", "v").collect()}


def _plain_vector(text):
    """The documented entries, one paragraph and sentence at a time."""
    wide, ones, n = [0] * 8, [0] * 120, 0
    for line in (x for x in (text or "").split("\n") if x.strip(" ")):
        digest = hashlib.sha256(line.encode()).hexdigest()
        digest += hashlib.sha256(digest.encode()).hexdigest()
        wide = [(w + int(digest[15 * i : 15 * i + 15], 16)) % (1 << 60) for i, w in enumerate(wide)]
        for sentence in filter(None, re.split(r"[.!?]+[\x20\x09-\x0D]+", line)):
            n += 1
            digest = hashlib.md5(sentence.encode()).hexdigest()
            for w in range(2):
                bits = int(digest[15 * w : 15 * w + 15], 16)
                for b in range(60):
                    ones[60 * w + b] += bits >> b & 1
    packed = [sum((ones[60 * w + 15 * f + j] % (1 << 14)) << (15 * f) for f in range(4)) for w in range(2) for j in range(15)]
    return wide + [n] + packed


def test_vectors_equal_their_description(spark):
    texts = [t for _, t in awkward_documents()] + ["a. b! c?\nd\n\n  \ne. ", "x" * 50_000, "é. ñ\n" * 3000, "same.\n" * 20_000]
    found = _fingerprints(spark, texts)
    assert all(found[i] == _plain_vector(t) for i, t in enumerate(texts))


def test_order_does_not_matter_and_paragraphs_go_in_and_out(spark):
    a, b, ab, ba = (_plain_vector(t) for t in ("One. Two.\nThree.", "Four! Five", "One. Two.\nThree.\nFour! Five", "Four! Five\nThree.\n\nOne. Two."))
    assert ab == ba
    df = spark.createDataFrame([(a, b, ab)], "a array<long>, b array<long>, ab array<long>")
    row = df.select(fingerprints.plus(F.col("a"), F.col("b")).alias("plus"), fingerprints.minus(F.col("ab"), F.col("b")).alias("minus"), fingerprints.minus(F.col("a"), F.col("a")).alias("none")).first()
    assert row["plus"] == ab and row["minus"] == a and row["none"] == [0] * 39


@pytest.mark.parametrize("range_bytes", [8 << 20, 2000])
def test_edited_texts(spark, tmp_path, monkeypatch, range_bytes):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", range_bytes)
    rows = list({i: (i, t) for i, t in awkward_documents() if i is not None}.values())
    got = {r["doc_id"]: r for r in fingerprints.compared(documents(spark, str(tmp_path / "d"), rows)).collect()}
    rows.sort()
    assert len(got) == len(rows)
    for (i, t), (_, following) in zip(rows, rows[1:] + rows[:1]):
        t, following = t or "", following or ""
        edited = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        assert (got[i]["n_chars"], got[i]["edited"]) == (len(t), edited)
        assert got[i]["vector"] == _plain_vector(t) and got[i]["edited_vector"] == _plain_vector(edited)
        assert 0 <= got[i]["near_edited"] <= 1
        assert (got[i]["near_next"] == 1) == (_plain_vector(t) == _plain_vector(following))


@pytest.mark.parametrize("range_bytes", [8 << 20, 1000])
def test_equal_and_missing_ids_form_one_cycle(spark, tmp_path, monkeypatch, range_bytes):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", range_bytes)
    rows = [(None, f"nobody {i} " * 9) for i in range(40)] + [(7, f"seven {i} " * 9) for i in range(60)] + [(i, f"other {i} " * 9) for i in range(40)]
    found = fingerprints.followed(documents(spark, str(tmp_path / "d"), rows)).collect()
    following = {r["text"]: r["next"] for r in found}
    at, seen = rows[0][1], set()
    while at not in seen:
        seen.add(at)
        at = following[at]
    assert len(found) == len(seen) == len(rows)


def test_likeness(spark):
    rng = random.Random(3)
    sentence = lambda: " ".join(rng.choice("abcdefgh") * rng.randint(1, 5) for _ in range(8))
    base = [sentence() for _ in range(200)]
    texts = [". ".join(base), ". ".join(base[:100] + [sentence() for _ in range(100)]), ". ".join(sentence() for _ in range(200)), "", None]
    v = _fingerprints(spark, texts)
    df = spark.createDataFrame([(v[0], v[i]) for i in (0, 1, 2, 3)] + [(v[3], v[4])], "a array<long>, b array<long>")
    a, b = F.col("a"), F.col("b")
    near = [r[0] for r in df.select(fingerprints.likeness(fingerprints.sums_of_signs(a), fingerprints.sums_of_signs(b), a == b)).collect()]
    assert near[0] == 1 and abs(near[1] - 0.5) < 0.2 and near[2] < 0.3 and near[3] == 0 and near[4] == 1


def test_no_documents(spark, tmp_path):
    assert fingerprints.compared(documents(spark, str(tmp_path / "d"), [])).count() == 0
    one = fingerprints.compared(documents(spark, str(tmp_path / "e"), [(5, "abcd")])).first()
    assert one["edited"] == "abab" and one["near_next"] == 1


# Whitening

VECTORS = {"vec_id": pa.int64(), "embedding": pa.list_(pa.float32()), "v": pa.string(), "x": pa.int64(), "n": pa.float64()}


def _vectors(spark, path, rows):
    return spark.read.parquet(write(path, VECTORS, [(i, v, "v", 3, 0.5) for i, v in rows]))


def _expected(vectors, k):
    x = np.floor(64 * np.array(vectors, np.float64)).astype(object) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    c = ((n * x - sums) / n).astype(np.float64)
    values, q = np.linalg.eigh(c.T @ c / n)
    values, q = values[::-1][:k], q[:, ::-1][:, :k]
    return n, ((n * x - sums) ** 2).sum(axis=1), c @ q / np.sqrt(values), values / np.trace(c.T @ c / n)


@pytest.mark.parametrize("shape", ["flat", "steep", "narrow", "few"])
def test_whitened_equals_dense_eigenvectors(spark, tmp_path, shape):
    rng = np.random.default_rng(4)
    d, n, k = {"flat": (70, 900, 8), "steep": (60, 600, 8), "narrow": (5, 300, 32), "few": (40, 12, 8)}[shape]
    m = rng.standard_normal((n, d)) * (np.logspace(2, -1, d) if shape == "steep" else np.linspace(3, 2, d))
    rows = list(enumerate(np.float32(m + 7).tolist()))
    awkward = [(None, None), (1, []), (2, [1.0]), (3, [None] * d), (4, [float("nan")] + [0.0] * (d - 1)), (5, [float("inf")] * d), (6, [1e30] * d)]
    rows += [rows[0], (None, rows[1][1])]
    df = _vectors(spark, str(tmp_path / "v"), rows + awkward)
    got = whitening.whitened(df, k).orderBy("component").collect()
    n, deviation, white, explained = _expected([v for _, v in rows], k)
    assert len(got) == n * min(d, k)
    by = collections.defaultdict(list)
    for r in got:
        assert (r["n"], r["identity_error"] <= 1e-9) == (n, True)
        by[r["vec_id"]].append(r)
    for at, (i, _) in enumerate(rows):
        if i == 0 or i is None:
            continue
        for j, r in enumerate(by[i]):
            assert r["component"] == j + 1 and r["deviation"] == deviation[at]
            assert abs(r["explained"] / explained[j] - 1) < 1e-9
            assert abs(abs(r["whitened"]) - abs(white[at][j])) < 1e-6
    assert len(by[0]) == 2 * min(d, k) and len(by[None]) == min(d, k)
    some = range(1, min(50, len(rows) - 2))
    signs = np.array([[np.sign(r["whitened"]) for r in by[i]] for i in some]) * np.sign(white[list(some)])
    assert (np.abs(signs.sum(axis=0)) == len(signs)).all()


def test_filter_runs_and_is_certified(spark, tmp_path):
    rng = np.random.default_rng(9)
    rows = whitening.prepared(_vectors(spark, str(tmp_path / "v"), list(enumerate(np.float32(rng.standard_normal((500, 90))).tolist()))))
    model = whitening.fit(rows, 10)
    assert model.passes > whitening.DEGREE and model.residuals.max() <= whitening.CERTIFIED


def test_many_tasks_add_up_in_two_steps(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(whitening, "TASKS", 0)
    rng = np.random.default_rng(9)
    vectors = np.float32(rng.standard_normal((200, 6))).tolist()
    got = whitening.whitened(_vectors(spark, str(tmp_path / "v"), list(enumerate(vectors))), 6)
    assert got.count() == 1200 and got.first()["identity_error"] < 1e-10


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)]])
def test_no_variance_has_no_components(spark, tmp_path, rows):
    assert whitening.whitened(_vectors(spark, str(tmp_path / "v"), rows)).collect() == []


def test_wide_deviations(spark, tmp_path):
    rows = [(i, [float((i - 50) ** 3) * 2**8, float(i % 3)]) for i in range(100)]
    n, deviation, _, _ = _expected([v for _, v in rows], 2)
    got = {r["vec_id"]: r["deviation"] for r in whitening.whitened(_vectors(spark, str(tmp_path / "v"), rows)).collect()}
    assert any(v >= 1 << 63 for v in deviation) and any(v < 1 << 63 for v in deviation)
    assert all(got[i] == (deviation[i] if deviation[i] < 1 << 63 else None) for i in range(100))


# Phrases

TEXTS = {"doc_id": pa.int64(), "text": pa.string(), "lang": pa.string(), "h1": pa.int64(), "n": pa.string(), "p": pa.int64()}


def _texts(spark, path, rows):
    return spark.read.parquet(write(path, TEXTS, [(i, t, lang, 1, "n", 2) for i, t, lang in rows]))


def _mined(rows, support, top, within):
    count, n = collections.Counter(), collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, 5):
                count.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    often = {g: f for g, f in count.items() if f >= support}
    out = []
    for (lang, *g), a in often.items():
        if len(g) < 2:
            continue
        inside = lambda h: any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))
        if any(lang == x and len(h) > len(g) and 100 * f >= within * a and inside(h) for (x, *h), f in often.items()):
            continue
        cuts = [(2000000 * a // (count[(lang, *g[:c])] + count[(lang, *g[c:])]), c, count[(lang, *g[:c])], count[(lang, *g[c:])]) for c in range(1, len(g))]
        score, _, left, right = min(cuts)
        out.append((lang, " ".join(g), a, left, right, n[lang], score))
    result = []
    for lang in n:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        result += [(lang, i + 1, *r[1:]) for i, r in enumerate(own)]
    return sorted(result)


@pytest.mark.parametrize("sample", [1, 4, 10**9])
def test_phrases_equal_brute_force(spark, tmp_path, monkeypatch, sample):
    """With the whole table as sample, a part of it, and next to nothing, so that the border must make up for it."""
    monkeypatch.setattr(phrases, "SAMPLE", sample)
    monkeypatch.setattr(phrases, "CHUNK", 3000)
    rng = random.Random(5)
    langs = ["en", "en", "en", "de", None, "und", ""]
    rows = [(i, t, rng.choice(langs)) for i, t in awkward_documents()]
    rows += [(i, " ".join(rng.choice(["New York", "new  york\tcity", "of the", "x;y", "É é", "Z z"]) for _ in range(60)), "en") for i in range(20)]
    rows += [(99, "a a a a a a a a\ra\x0ba\x0ca!a?a:a", "fr")] * 10
    got = phrases.collocations(_texts(spark, str(tmp_path / "t"), rows), support=8, top=25)
    assert sorted(tuple(r) for r in got.collect()) == _mined(rows, 8, 25, 80)


def test_no_phrases(spark, tmp_path):
    assert phrases.collocations(_texts(spark, str(tmp_path / "a"), [])).collect() == []
    assert phrases.collocations(_texts(spark, str(tmp_path / "b"), [(1, None, None), (2, "", "en"), (3, "few words", None)])).collect() == []


def test_words_with_one_hash_are_counted_again(spark, tmp_path, monkeypatch):
    plain, calls = phrases._counter, []

    def counter(longest, seed, *bits):
        calls.append(seed)
        run = plain(longest, seed, *bits)

        def same(batches):
            for b in run(batches):
                if seed == 0 and "word" in b.schema.names:  # as if all words had the hash 5
                    b = b.set_column(b.schema.get_field_index("g"), "g", pa.array([5] * b.num_rows, pa.int64()))
                yield b

        return same

    monkeypatch.setattr(phrases, "_counter", counter)
    rows = [(i, "good morning everyone here. good morning", "en") for i in range(20)]
    got = phrases.collocations(_texts(spark, str(tmp_path / "t"), rows), support=5)
    assert sorted(tuple(r) for r in got.collect()) == _mined(rows, 5, 2000, 80) and 1 in calls


def test_big_counts_stay_exact(spark):
    big = 1 << 55
    frequent = spark.createDataFrame([(1, 0, 0, 0, big + 3), (2, 0, 0, 0, big), (1, 2, 0, 0, big - 1)], "h1 long, h2 long, h3 long, h4 long, n long")
    words = spark.createDataFrame([("en", "a", 1, big + 3), ("en", "b", 2, big)], "lang string, word string, h1 long, n long")
    row = phrases.best(frequent, words, 30, 10, 80).first()
    assert (row["phrase"], row["a"], row["score"], row["n"]) == ("a b", big - 1, 2000000 * (big - 1) // (2 * big + 3), 2 * big + 3)
