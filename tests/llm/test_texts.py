"""Operators on documents against brute force, on awkward rows and on an empty table."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from traffic_lake.llm import anchors, packing, radix_dedup, seed_extend, simhash, suffix_dedup

from . import tables

ROWS = tables.awkward_documents()


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    return tables.documents(spark, str(tmp_path_factory.mktemp("d")), ROWS)


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    return tables.documents(spark, str(tmp_path_factory.mktemp("e")), [])


def sha(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


def brute_force(texts: list[bytes], L: int) -> list[tuple[int, int, int, str]]:
    """Per text: bytes, removed bytes, removed runs, digest of the rest."""
    seen: dict[bytes, int] = {}
    for t in texts:
        for i in range(len(t) - L + 1):
            seen[t[i : i + L]] = seen.get(t[i : i + L], 0) + 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - L + 1):
            if seen[t[i : i + L]] > 1:
                gone[i : i + L] = b"\1" * L
        kept = bytes(x for x, g in zip(t, gone) if not g)
        n_runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), n_runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 0])
def test_substrings(docs, hot):
    texts = [(t or "").encode() for _, t in ROWS]
    wanted = [(i, *out) for (i, _), out in zip(ROWS, brute_force(texts, 200))]
    out = suffix_dedup.remove_repeated_substrings(docs, hot=hot)
    got = out.select("doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)).collect()
    assert order(map(tuple, got)) == order(wanted)


def test_windows_of_every_length():
    text = np.frombuffer(b"abcabcabxabcab", np.uint8)
    for L in range(1, 9):
        ends = np.arange(L, len(text) + 1)
        seen = Counter(bytes(text[e - L : e]) for e in ends)
        got = suffix_dedup.repeated_windows(text, ends, np.ones(len(ends), np.int64), L)
        assert got.tolist() == [seen[bytes(text[e - L : e])] > 1 for e in ends]


def test_anchors_do_not_depend_on_pieces(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 3, n, np.uint8) for n in (0, 5, 30, 31, 200, 1000)]

    def windows():
        out = set()
        for tag, _, _, first, last, p, h in anchors.text_runs(iter(enumerate(texts)), 30, 8):
            for a, b, q, g in zip(first, last, p, h):
                out |= {(tag, s, int(q), int(g)) for s in range(a, b + 1)}
        return out

    whole = windows()
    assert len(whole) == sum(max(0, len(t) - 29) for t in texts)
    assert all(s <= p <= s + 22 for _, s, p, _ in whole)
    monkeypatch.setattr(anchors, "PIECE", 37)
    assert windows() == whole


def test_passages(docs):
    L = 13
    split = [(i, (t or "").encode().split()) for i, t in ROWS]
    least = {}
    for i, w in split:
        for j in range(len(w) - L + 1):
            key = tuple(w[j : j + L])
            if i is not None:
                least[key] = min(least.get(key, i), i)
    wanted = []
    for i, w in split:
        gone = [False] * len(w)
        for j in range(len(w) - L + 1):
            first = least.get(tuple(w[j : j + L]))
            if first is not None and (i is None or first < i):
                gone[j : j + L] = [True] * L
        wanted.append((i, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g))))
    got = seed_extend.remove_repeated_passages(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    assert order(map(tuple, got)) == order(wanted)
    assert any(r[2] for r in wanted)


@pytest.mark.parametrize("first", [radix_dedup.FIRST, 1])
def test_copies(docs, monkeypatch, first):
    monkeypatch.setattr(radix_dedup, "FIRST", first)
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[t or ""].append(i)
    got = radix_dedup.exact_duplicates(docs).collect()
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    wanted = [(i, keep[t or ""], len(groups[t or ""]), sha((t or "").encode())) for i, t in ROWS]
    assert order((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == order(wanted)
    kept = [(r.text_sha256, r.doc_id) for r in got if r.kept]
    assert sorted(kept, key=str) == sorted(((sha(t.encode()), keep[t]) for t in groups), key=str)


def fingerprint(text: str, n: int = 3) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates(docs):
    prints = [fingerprint(t) for _, t in ROWS]
    root = list(range(len(ROWS)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(ROWS)):
        for y in range(x):
            if (prints[x] ^ prints[y]).bit_count() <= 3:
                root[find(x)] = find(y)
    low = defaultdict(list)
    for x, (i, _) in enumerate(ROWS):
        low[find(x)].append(i)
    wanted = [
        (i, prints[x], min((v for v in low[find(x)] if v is not None), default=None)) for x, (i, _) in enumerate(ROWS)
    ]
    got = simhash.near_duplicates(docs).collect()
    assert order((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in got) == order(wanted)


@pytest.mark.parametrize("radius", [1, 3, 5])
def test_links_of_clustered_fingerprints(spark, radius):
    rng = np.random.default_rng(radius)
    centres = rng.integers(0, 1 << 64, 6, np.uint64)
    nodes = {0, (1 << 64) - 1, 1, 1 << 63}
    for c in centres.tolist():
        for _ in range(40):
            x = c
            for b in rng.integers(0, 64, rng.integers(0, 5)).tolist():
                x ^= 1 << b
            nodes.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in nodes]
    wanted = sorted((a, b) for a in signed for b in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= radius)
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    assert sorted(map(tuple, simhash.links(df, radius).collect())) == wanted


def test_variants_of_few_nodes_are_not_broadcast(spark, tmp_path):
    """A small table of nodes has 66 variants each, which Spark doesn't count in."""
    spark.range(1000).selectExpr("xxhash64(id) AS fp").write.parquet(f"{tmp_path}/nodes")
    found = simhash.links(spark.read.parquet(f"{tmp_path}/nodes"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components_of_chains_and_hubs(spark, tmp_path):
    edges = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 160)] + [(200, 201), (200, 201), (201, 202), (200, 202)]
    spark.createDataFrame(edges, "a long, b long").write.parquet(f"{tmp_path}/in")
    got = dict(map(tuple, simhash.components(spark.read.parquet(f"{tmp_path}/in"), f"{tmp_path}/s").collect()))
    assert got == {n: 0 for n in range(61)} | {n: 100 for n in range(100, 160)} | {200: 200, 201: 200, 202: 200}


def test_packing(docs):
    got = packing.pack(docs, longest=50, buckets=4, budget=200).collect()
    wanted = []
    for i, t in ROWS:
        n = len((t or "").split())
        wanted += [(i, p, p * 50, min(50, n - p * 50)) for p in range(max(1, -(-n // 50)))]
    assert order((r.doc_id, r.piece, r.start, r.n_tokens) for r in got) == order(wanted)
    batches = Counter((r.bucket_len, r.batch) for r in got)
    assert len({(r.bucket_len, r.batch, r.slot) for r in got}) == len(got)
    for length in {r.bucket_len for r in got}:
        sizes = [batches[length, b] for b in range(max(b for x, b in batches if x == length) + 1)]
        fit = max(1, 200 // max(1, length))
        assert all(s == fit for s in sizes[:-1]) and 0 < sizes[-1] <= fit
    assert all(r.n_tokens <= r.bucket_len and r.padding == r.bucket_len - r.n_tokens for r in got)


def test_shards_do_not_matter(docs, monkeypatch):
    whole = Counter((r.bucket_len, r.batch) for r in packing.pack(docs, 50, 4, 200).collect())
    monkeypatch.setattr(packing, "SHARD", 7)
    assert Counter((r.bucket_len, r.batch) for r in packing.pack(docs, 50, 4, 200).collect()) == whole


def test_boundaries_are_optimal():
    from itertools import combinations

    rng = np.random.default_rng(5)
    for _ in range(40):
        n = int(rng.integers(1, 9))
        lengths = sorted(rng.choice(60, n, replace=False).tolist())
        counts = rng.integers(1, 30, n).tolist()
        for k in (1, 2, 3, 9):
            def padding(edges):
                return sum(c * (min(e for e in edges if e >= x) - x) for x, c in zip(lengths, counts))

            best = min(padding((*inner, lengths[-1])) for m in range(min(k, n)) for inner in combinations(lengths[:-1], m))
            edges = packing.boundaries(lengths, counts, k)
            assert len(edges) <= k and edges == sorted(edges) and padding(edges) == best


def test_empty_tables(nothing):
    assert suffix_dedup.remove_repeated_substrings(nothing).count() == 0
    assert seed_extend.remove_repeated_passages(nothing).count() == 0
    assert radix_dedup.exact_duplicates(nothing).count() == 0
    assert simhash.near_duplicates(nothing).count() == 0
    assert packing.pack(nothing).count() == 0
