"""Exact and approximate vector search against brute force."""

import math

import numpy as np
import pytest

from lloydflow.llm import ann_tree, topk_exact

SCHEMA = "vec_id long, embedding array<float>, score string"
BAD = [(1001, None, "x"), (1002, [1.0, None], "x"), (1003, [math.nan, 1.0], "x"), (1004, [math.inf, 0.0], "x"), (None, [1.0, 1.0], "x")]


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x") for i, v, *_ in rows], SCHEMA)


def clustered(n, dims=24, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dims))
    x = (centres[rng.integers(0, 8, n)] + 0.4 * rng.normal(size=(n, dims))).astype(np.float32)
    x[n // 2: n // 2 + 40] = x[0]  # copies tie
    return [(i, v.tolist()) for i, v in enumerate(x)]


def brute_exact(rows, k, every):
    m = {i: [math.floor(1024 * float(np.float32(x))) for x in v] for i, v in rows}
    out = []
    for q in m:
        if q % every == 0:
            s = sorted((-sum(a * b for a, b in zip(m[q], m[c])), c) for c in m if c != q)
            out += [(q, r + 1, c, -v) for r, (v, c) in enumerate(s[:k])]
    return sorted(out)


LARGE = [(i, [1e6 + 17 * i, -9e5 + 3 * i, 7e5 + (i % 3) / 1024]) for i in range(101)]  # products far beyond 2 ** 53


@pytest.mark.parametrize("rows", [clustered(400), LARGE, [(0, [0.5, 0.25]), (100, [0.5]), (7, []), (8, [0.0, 0.0]), (9, [0.5, 0.25])], [(100, [1.0])]])
def test_exact_topk(spark, rows, monkeypatch):
    monkeypatch.setattr(topk_exact, "CANDIDATE_ROWS", 64)
    monkeypatch.setattr(topk_exact, "QUERY_ROWS", 3)
    monkeypatch.setattr(topk_exact, "DIM_STEP", 8)
    got = topk_exact.exact_topk(vectors(spark, rows + BAD)).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == brute_exact(rows, 10, 100)


def test_empty_tables(spark):
    for rows in ([], BAD):
        assert topk_exact.exact_topk(vectors(spark, rows)).count() == 0
        assert ann_tree.ann_topk(vectors(spark, rows)).count() == 0


def test_ann_recall_scores_and_order(spark, monkeypatch):
    monkeypatch.setattr(ann_tree, "MEMBERS", 64)
    monkeypatch.setattr(ann_tree, "QUERIES", 16)
    rows = clustered(3000)
    got = ann_tree.ann_topk(vectors(spark, rows + BAD + [(5000, [0.0] * 24)])).collect()
    x = np.array([v for _, v in rows], np.float32).astype(float)
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
        assert r["score"] == pytest.approx(float(x[r["query_id"]] @ x[r["vec_id"]]), abs=1e-12)
    assert set(by) == set(range(0, 3000, 20))
    hits = 0
    for q, found in by.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert [(-s, c) for _, c, s in found] == sorted((-s, c) for _, c, s in found)
        s = x @ x[q]
        s[q] = -np.inf
        # Any vector as near as the twentieth is right.
        least = np.sort(s)[-20]
        hits += sum(s[c] >= least - 1e-9 for _, c, _ in found)
    assert hits / (20 * len(by)) >= 0.9


def test_ann_few_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5]), (20, [0.0, 2.0])]
    got = ann_tree.ann_topk(vectors(spark, rows)).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == [
        (0, 1, 1, 0.5), (0, 2, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 1, 0.0)]


def skewed(n=2400, dims=16, seed=4):
    """Three large groups of copies, and sixty outliers at right angles to them, two of them queries."""
    rng = np.random.default_rng(seed)
    x = 5 * np.eye(dims)[rng.integers(0, 3, n)]
    far = [0, 1200, *[i for i in range(1, n, 37) if i % 20][:58]]
    x[far] = 0
    x[far, 3:] = rng.normal(size=(60, dims - 3))
    return [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))]


def test_ann_outliers_have_full_lists(spark):
    rows = skewed()
    got = ann_tree.ann_topk(vectors(spark, rows)).collect()
    x = np.array([v for _, v in rows], np.float32).astype(float)
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append(r["vec_id"])
    assert {q: len(found) for q, found in by.items()} == {q: 20 for q in range(0, 2400, 20)}
    for q in (0, 1200):
        s = x @ x[q]
        s[q] = -np.inf
        assert sum(s[c] >= np.sort(s)[-20] - 1e-9 for c in by[q]) >= 18
