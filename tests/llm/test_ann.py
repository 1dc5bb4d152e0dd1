from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from adtide.llm import ann


def brute(rows, k):
    usable = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in usable:
        if i % 10 == 0:
            scored = [(-float(v @ w / np.linalg.norm(v) / np.linalg.norm(w)), j) for j, w in usable if j != i]
            out[i] = [(j, -s) for s, j in sorted((round(s, 12), j) for s, j in scored)[:k]]
    return out


def test_recall_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(600)]
    same = rng.normal(size=8).tolist()
    rows += [(1000 + i, same) for i in range(200)]
    rows += [(2000, None), (2010, [0.0] * 8), (2020, [1.0] * 7), (2030, [None] + [1.0] * 7), (2040, [float("nan")] * 8), (2050, [float("inf")] * 8), (2060, []), (None, same)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("x")).withColumn("shard", F.lit(9))
    got: dict = {}
    for r in ann.nearest(table, F.col("id") % 10 == 0, shard_rows=150).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.id, r.score))
    expected = brute(rows, 5)
    assert set(got) == set(expected)
    hits = sum(len({j for j, _ in got[q]} & {j for j, _ in expected[q]}) for q in expected)
    assert hits >= 0.97 * sum(map(len, expected.values()))
    # the equal vectors: the smallest ids but the query's own
    assert [j for j, _ in got[1000]] == [1001, 1002, 1003, 1004, 1005] and [j for j, _ in got[1050]] == [1000, 1001, 1002, 1003, 1004]
    for q, found in got.items():
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True) and q not in [j for j, _ in found]


def test_few_vectors_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    two = spark.createDataFrame([(0, [1.0, 0.0]), (7, [0.0, 1.0]), (9, [1.0, 1.0])], schema)
    assert [(r.rank, r.id) for r in ann.nearest(two, F.col("id") == 0).orderBy("rank").collect()] == [(1, 9), (2, 7)]
    assert ann.nearest(spark.createDataFrame([], schema), F.col("id") % 10 == 0).count() == 0


def test_recall_over_several_shards_at_production_parameters(spark):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(40, 64))
    spread, clustered = rng.normal(size=(5000, 64)), centres[rng.integers(0, 40, 5000)] + 0.5 * rng.normal(size=(5000, 64))
    vectors = np.concatenate((spread, clustered))
    table = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], "vec_id long, embedding array<double>")
    # more classes than two shards hold, and far more in each than the beam
    assert len(vectors) > 2 * ann.SHARD_ROWS and ann.SHARD_ROWS > 20 * ann.BEAM
    got: dict = {}
    for r in ann.nearest(table, F.col("id") % 50 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.id)
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    for part in (range(0, 5000, 50), range(5000, 10000, 50)):
        near = units[list(part)] @ units.T
        near[np.arange(len(part)), list(part)] = -np.inf
        best = np.argsort(-near, axis=1)[:, : ann.NEAREST]
        recall = np.mean([len(got[q] & set(best[at].tolist())) / ann.NEAREST for at, q in enumerate(part)])
        assert recall >= 0.95
