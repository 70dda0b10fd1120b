"""Exact top-k search against a plain version."""

import math
import random

import numpy as np
import pytest
from conftest import SF_SMALL

from basketry.llm import common, topk

TOP = (1 << 63) - 1
SCHEMA = "vec_id long, embedding array<double>, label int, query long, row string, dim int, shard int, rank int, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, None, None, None, None, None, None, None) for i, v in rows], SCHEMA)


def plain(rows, every=50, k=5):
    fine = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, (i, v) in enumerate(fine):
        if i % every == 0:
            met = sorted((-max(-TOP, min(TOP, sum(a * b for a, b in zip(v, w)))), j) for c, (j, w) in enumerate(fine) if c != q and len(w) == len(v))
            out += [(i, r, j, -s) for r, (s, j) in enumerate(met[:k], 1)]
    return sorted(out)


def got(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def test_small_table(spark):
    vectors = common.table(spark, SF_SMALL, "embeddings")
    assert got(topk.top_k(vectors)) == plain([(r.vec_id, r.embedding) for r in vectors.collect()])


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, [1.0, 2.0]), (50, [0.5]), (51, [0.5]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (100, [inf, 1.0]),
            (None, [1.0, 2.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [-0.001, 0.999]), (150, []), (9, []), (200, [1.0, 2.0, 3.0]),
            (-50, [1e300, -1e300]), (10, [1e10, 1e10]), (11, [3e5, -7e6])]
    assert got(topk.top_k(frame(spark, rows))) == plain(rows)
    assert topk.top_k(frame(spark, [])).collect() == []
    assert topk.top_k(frame(spark, [(50, [1.0])])).collect() == []


@pytest.mark.parametrize("small", [False, True])
def test_many_slabs_shards_and_ties(spark, monkeypatch, small):
    """Ties and copies over many cells; small tiles, slabs and shards give the same rows."""
    if small:
        for name, value in {"SLAB_BYTES": 8, "TILE_QUERIES": 7, "TILE_ROWS": 50, "SHARD_ROWS": 40, "MOST_SHARD_ROWS": 40, "FAN": 3}.items():
            monkeypatch.setattr(topk, name, value)
    rng = random.Random(7)
    pool = [[rng.randint(-2, 2) / 256 for _ in range(6)] for _ in range(30)]
    rows = [(rng.randint(0, 900), rng.choice(pool)) for _ in range(1500)]
    assert got(topk.top_k(frame(spark, rows), every=3)) == plain(rows, every=3)


def test_products_are_exact_at_every_size():
    rng = np.random.default_rng(1)
    for size in (8, 2**10, 2**24, 2**30, 2**60):
        q, c = (np.floor(rng.uniform(-size, size, (4, 5))) for _ in range(2))
        want = [[max(-TOP, min(TOP, sum(int(a) * int(b) for a, b in zip(x, y)))) for y in c] for x in q]
        assert topk.products(q, c).tolist() == want


def test_selection_orders_ties():
    rng = np.random.default_rng(2)
    for scale in (1, 1 << 60):
        score = rng.integers(-3, 3, (20, 40)) * scale
        at = topk.select(score, np.arange(40), 6)
        for i in range(20):
            assert sorted(at[i]) == sorted(sorted(range(40), key=lambda j: (-int(score[i, j]), j))[:6])
