"""The searches over embeddings and the periodic runs against plain versions."""

import hashlib
import math
import os
import random
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import helpers as H

from dropgate.llm import grid, hard_negatives, periodic_runs, queries, topk_search

SF = "/root/testdata/sf0.001"
RNG = random.Random(11)
VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(n, dim=6, spread=1.0):
    return [(i, [RNG.gauss(0, spread) for _ in range(dim)], RNG.randrange(4)) for i in range(n)]


def odd_vectors():
    """Copies, ties, repeated rows, missing and bad values, other lengths, large numbers."""
    rows = vectors(260)
    rows += [(300 + i, list(rows[0][1]), i % 3) for i in range(60)]  # copies in several labels, two of them queries
    rows += [rows[100], rows[100], rows[0], (50, [0.5] * 6, 1), (50, [0.25] * 6, 1)]
    rows += [(None, [0.9] * 6, 2), (None, [0.9] * 6, None), (1000, None, 1), (1050, [1.0, None] * 3, 1), (1100, [math.nan] + [0.0] * 5, 1), (1150, [math.inf] * 6, 1)]
    rows += [(1200 + i, [RNG.random() for _ in range(3)], 1) for i in range(0, 100, 10)] + [(1400, [], 0), (1401, [], 0), (1450, [], 1), (1500, [2.0], 0), (1501, [3.0], 0), (1502, [2.5], 1)]
    return rows + [(1550, [1e30] * 6, 1), (1600, [200000.0] * 6, 2), (1601, [199999.0] * 6, 2), (1602, [150000.0] * 6, 1)]


def valid(rows):
    """(vec_id, integers, label) as Python numbers."""
    out = []
    for i, v, label in rows:
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        scaled = [math.floor(256 * float(np.float32(x))) for x in v]
        if all(abs(x) < grid.LARGEST for x in scaled):
            out.append((i, scaled, label))
    return out


def product(a, b):
    return sum(x * y for x, y in zip(a, b))


def by_score(hit):
    return -hit[0], hit[1] is None, hit[1] or 0


def plain_top(rows, k):
    rows, out = valid(rows), []
    for at, (q, v, _) in enumerate(rows):
        if q is not None and q % 50 == 0:
            hits = sorted(((product(v, w), i) for other, (i, w, _) in enumerate(rows) if other != at and len(w) == len(v)), key=by_score)
            out += [(q, rank + 1, i, s) for rank, (s, i) in enumerate(hits[:k])]
    return sorted(out, key=str)


def plain_negatives(rows):
    rows, out = [r for r in valid(rows) if r[2] is not None], []
    for at, (a, v, label) in enumerate(rows):
        if a is None or a % 50:
            continue
        others = [(product(v, w), i, m) for other, (i, w, m) in enumerate(rows) if other != at and len(w) == len(v)]
        for ps, p, _ in sorted((h for h in others if h[2] == label), key=by_score)[:5]:
            hits = sorted((h for h in others if h[2] != label and 50 * ps <= 100 * h[0] <= 95 * ps), key=by_score)
            out += [(a, p, rank + 1, n, ps, s) for rank, (s, n, _) in enumerate(hits[:3])]
    return sorted(out, key=str)


def frame(spark, rows, schema=VECTORS):
    return spark.createDataFrame(rows, schema).selectExpr("*", "'x' AS uid", "1 AS dim", "2 AS score", "3 AS q", "'y' AS bucket")


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(grid, "ROWS", 7)
    monkeypatch.setattr(grid, "VECTOR_BLOCKS", 3)
    monkeypatch.setattr(grid, "QUERY_BLOCKS", 1)


@pytest.mark.parametrize("lists,gather", [(2, 64), (3, 1), (1, 8)])
def test_top_of_odd_vectors(spark, lists, gather):
    rows = odd_vectors()
    got = topk_search.search(frame(spark, rows), 5, 50, lists, gather)
    assert sorted(map(tuple, got.collect()), key=str) == plain_top(rows, 5)


def test_top_in_many_blocks(spark, small_blocks):
    rows = vectors(400, 8)
    assert sorted(map(tuple, topk_search.search(frame(spark, rows)).collect()), key=str) == plain_top(rows, 5)


def test_top_with_fewer_rows_than_asked(spark):
    rows = vectors(4)
    assert sorted(map(tuple, topk_search.search(frame(spark, rows)).collect()), key=str) == plain_top(rows, 5)
    assert topk_search.search(frame(spark, [])).collect() == []


def test_collect_sends_few_of_clustered_vectors(spark, monkeypatch):
    """The cutoff works: of vectors in clusters, nodes send a small part."""
    centres = [[RNG.gauss(0, 1) for _ in range(16)] for _ in range(20)]
    rows = [(i, [x + RNG.gauss(0, 0.05) for x in centres[i % 20]], 0) for i in range(2000)]
    sent, store = {}, topk_search.store

    def counted(df, name):
        out = store(df, name)
        sent[name] = out.count()
        return out

    monkeypatch.setattr(topk_search, "store", counted)
    got = topk_search.search(frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=str) == plain_top(rows, 5)
    assert sent["able"] < 0.25 * 40 * 2000


def test_negatives_of_odd_vectors(spark):
    rows = odd_vectors()
    got = hard_negatives.mine(frame(spark, rows), F.col("label"))
    assert sorted(map(tuple, got.collect()), key=str) == plain_negatives(rows)


def test_negatives_in_many_blocks(spark, small_blocks, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BUCKETS", 2)
    monkeypatch.setattr(hard_negatives, "TREE", 3)
    monkeypatch.setattr(hard_negatives, "HELD", 20)
    rows = vectors(400, 8)
    assert sorted(map(tuple, hard_negatives.mine(frame(spark, rows), F.col("label")).collect()), key=str) == plain_negatives(rows)
    assert hard_negatives.mine(frame(spark, []), F.col("label")).collect() == []


def test_tree_spans_with_least_length():
    a = np.random.default_rng(2).integers(-50, 50, (40, 5)).astype("<i4")
    order, (parent, level) = hard_negatives.Tree()(a)
    b = a[order].astype(float)
    assert sorted(order.tolist()) == list(range(40)) and parent[0] == -1 and all(parent[1:] < np.arange(1, 40))
    assert all(level[1:] == level[parent[1:]] + 1)
    length = sum(np.linalg.norm(b[i] - b[parent[i]]) for i in range(1, 40))
    edges = sorted((np.linalg.norm(b[i] - b[j]), i, j) for i in range(40) for j in range(i))
    up, least = list(range(40)), 0.0
    for d, i, j in edges:
        while up[i] != i:
            i = up[i]
        while up[j] != j:
            j = up[j]
        if i != j:
            up[i], least = j, least + d
    assert length == pytest.approx(least)


def test_bounds_hold_and_spare_scores():
    """Bounds of the tree hold every score, and similar anchors need few."""
    rng = np.random.default_rng(3)
    x = rng.integers(-40, 40, (500, 16)).astype("<i4")
    a = (rng.integers(-40, 40, (1, 16)) + rng.integers(-1, 2, (60, 16))).astype("<i4")
    order, (parent, level) = hard_negatives.Tree()(a)
    a = a[order]
    exact = a.astype(np.int64) @ x.T.astype(np.int64)
    least = np.sort(exact, axis=1)[:, -20]

    def window(rows, low, high):
        return high >= least[rows, None]

    low, high, scored = hard_negatives.bounded(a, parent, level, x, window)
    assert (low <= exact).all() and (exact <= high).all()
    assert ((low == high) | (high < least[:, None])).all()
    assert scored < 0.4 * exact.size


def test_products_are_exact():
    rng = np.random.default_rng(4)
    for top in (10, 1 << 14, 1 << 25):
        a, b = rng.integers(-top, top, (9, 70)).astype("<i4"), rng.integers(-top, top, (11, 70)).astype("<i4")
        want = [[sum(int(x) * int(y) for x, y in zip(r, c)) for c in b] for r in a]
        assert grid.products(a, b).astype(np.int64).tolist() == want


def plain_runs(w):
    """Start, length, period by following each period through the text."""
    out = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            s = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            if i + p - s >= max(12, 2 * p) and i > s:
                out.setdefault((s, i + p), p)
            i = max(i, s + 1)
    return sorted((s, e - s, p) for (s, e), p in out.items())


def plain_report(doc_id, text, plant):
    w = H.words(text)
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if plant and n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    kept = [x for i, x in enumerate(w) if not any(s + q <= i < s + m for s, m, q in found)]
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    hashed = [hashlib.sha256(t.encode()).hexdigest() for t in ("".join(f"{s},{m},{q}\n" for s, m, q in found), " ".join(kept))]
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *hashed)


def test_runs_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = sorted(map(tuple, queries.op12_periodic_runs(spark, SF).collect()))
    assert got == sorted(plain_report(d.doc_id, d.text, True) for d in docs)
    assert sum(r[1] > 0 for r in got) > 5


def test_runs_of_odd_texts(spark):
    cycle = " ".join(f"v{i % 9}" for i in range(70))
    texts = [None, "", " \n\t", "a", "a " * 11, "a " * 12, "a\x0ba\x0c" * 30, cycle, cycle, f"x {cycle} y {cycle} v0", "a b " * 9 + "a a a a a a a a a a a a", " a" * 3000, "é ß " * 40]
    texts += [" ".join(RNG.choice("ab") for _ in range(RNG.randrange(200))) for _ in range(60)]
    df = H.docs(spark, texts).selectExpr("*", "'x' AS runs", "1 AS collapsed", "2 AS start").union(H.docs(spark, ["b " * 20]).selectExpr("cast(null AS long)", "text", "lang", "source", "n_chars", "'x'", "1", "2"))
    for plant in (False, True):
        got = periodic_runs.report(periodic_runs.find(df, periodic_runs.planted if plant else None)).collect()
        want = [plain_report(i, t, plant) for i, t in enumerate(texts)]
        want.append((None, *plain_report(-1, "b " * 20, False)[1:]))
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert periodic_runs.report(periodic_runs.find(df.limit(0))).collect() == []


def test_runs_of_a_long_text():
    rng = np.random.default_rng(5)
    w = rng.integers(0, 5000, 300_000)
    w[100_000:] = w[100_000 : 100_000 + 777][np.arange(200_000) % 777]
    w[50_000:50_040] = 1
    assert [x.tolist() for x in periodic_runs.runs(w, np.array([len(w)]))] == [[0, 0], [50_000, 100_000], [40, 200_000], [1, 777]]


@pytest.mark.parametrize("size", [1, 2, 3, 40])
def test_runs_by_brute_force(size):
    for n in (0, 11, 12, 25, 60, 150):
        texts = [[RNG.randrange(size) for _ in range(n)] for _ in range(8)]
        d, s, m, p = periodic_runs.runs(np.array([x for t in texts for x in t], np.int64), np.array([n] * 8))
        for i, t in enumerate(texts):
            assert list(zip(s[d == i].tolist(), m[d == i].tolist(), p[d == i].tolist())) == plain_runs(t)
