import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardloom.llm.topk import ImpactIndex, top_k

SCHEMA = "vec_id long, embedding array<double>, block long, query string, score int, copies long, rank int"


def _table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "q", 2, 3, 4) for i, v in rows], SCHEMA)


def _whole(x):
    return max(-(2**63), min(2**63 - 1, math.floor(x) * 1024 if abs(x) >= 2**53 else math.floor(x * 1024)))


def _brute(rows, k, every):
    sound = [(i, [_whole(x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in sorted({(i, tuple(v)) for i, v in sound}):
        if i % every == 0:
            others = list(sound)
            others.remove((i, list(v)))
            found = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in others)[:k]
            out += [(i, r, j, max(-(2**63), min(2**63 - 1, -s))) for r, (s, j) in enumerate(found, 1)]
    return sorted(out)


def _rows(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


@pytest.mark.parametrize("sizes", [(1 << 19, 1 << 18), (600, 60)])
def test_top_k_is_exact(spark, sizes):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 12))
    rows = [(i, (centres[i % 6] + 0.3 * rng.normal(size=12)).round(int(rng.integers(1, 9))).tolist()) for i in range(500)]
    rows += [(1000 + i, rows[0][1]) for i in range(250)]  # a third of all rows hold one vector
    got = top_k(_table(spark, rows), F.col("vec_id") % 50 == 0, 10, block_values=sizes[0], query_values=sizes[1])
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert _rows(got) == _brute(rows, 10, 50)


def test_awkward_vectors(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(40)]
    rows += [(50, None), (60, [1.0, None, 0.0, 0.0]), (70, [math.nan, 1.0, 1.0, 1.0]), (80, [math.inf, 0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0, 1.0])]
    rows += [(90, [0.0] * 4), (100, []), (110, [0.5]), (120, [0.1] * 300)]  # zeros, empty, short and long vectors
    rows += [(10, [0.9, 0.9, 0.9, 0.9]), (10, [0.9, 0.9, 0.9, 0.9]), (20, rows[20][1]), (7, rows[20][1])]  # repeated ids and rows
    rows += [(130, [1e-200, -1e-200, 0.0, 0.0]), (140, [3.0, -1e-320, 0.0, 1.0])]
    assert _rows(top_k(_table(spark, rows), F.col("vec_id") % 10 == 0, 5)) == _brute(rows, 5, 10)
    rows += [(150, [1e200, -1e200, 1.0, 0.0]), (151, [1e15, 1e15, 1e15, 0.0]), (160, [1e12, 2e12, -1e12, 1.0]), (161, [1e300, 1e308, 0.0, 0.0])]
    assert _rows(top_k(_table(spark, rows), F.col("vec_id") % 10 == 0, 5)) == _brute(rows, 5, 10)


def test_few_and_no_candidates(spark):
    assert _rows(top_k(_table(spark, []), F.col("vec_id") % 10 == 0)) == []
    assert _rows(top_k(_table(spark, [(10, [1.0])]), F.col("vec_id") % 10 == 0)) == []
    rows = [(10, [1.0, 2.0]), (11, [0.5, 0.5]), (9, [0.5, 0.5])]
    assert _rows(top_k(_table(spark, rows), F.col("vec_id") % 10 == 0)) == [(10, 1, 9, 1572864), (10, 2, 11, 1572864)]


def test_a_search_stops_on_proof_before_all_is_read():
    rng = np.random.default_rng(1)
    vectors = np.floor(1024 * rng.normal(size=(4000, 32)) * 0.15).astype(np.int64)
    index, ones = ImpactIndex(np.arange(4000), vectors), np.ones(4000, dtype=np.int64)
    for q in range(0, 4000, 200):
        scores = vectors @ vectors[q]
        want = sorted((i for i in range(4000) if i != q), key=lambda i: (-scores[i], i))[:10]
        assert [x[0] for x in index.search(q, vectors[q], 10, ones)] == want
    assert index.read < 0.8 * vectors.size * index.searched
    assert index.read + 32 * index.scored <= vectors.size * index.searched
