import math
import os
import random

import duckdb
import numpy as np
import pytest

from canopy.llm import crosspolytope as C
from canopy.llm.queries import QUERIES


def brute(rows, queries, k=5):
    out = {}
    for q, x in queries:
        x = np.array(x, dtype=np.float64)
        near = [(-float((np.array(v, dtype=np.float64) * x).sum() / (np.sqrt((np.array(v, dtype=np.float64) ** 2).sum()) * np.sqrt((x * x).sum()))), i)
                for i, v in rows if i != q and len(v) == len(x)]
        out[q] = sorted(near)[:k]
    return out


def test_rotation():
    x = np.random.default_rng(0).normal(size=(5, 64))
    for d in (2, 8, 64):
        h = C.hadamard(np.eye(d))
        assert np.allclose(h @ h.T, np.eye(d)) and np.allclose(np.abs(h), 1 / math.sqrt(d))
    y = C.signed_axes(x, 3, 1)
    assert y.shape == (5, 128) and np.allclose(np.linalg.norm(y[:, :64], axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(y[:, :64], -y[:, 64:]) and not np.allclose(y, C.signed_axes(x, 4, 1))
    p = C.probes(y[0], y[1], 7)
    best = sorted(((a + b, i * 128 + j) for i, a in enumerate(y[0]) for j, b in enumerate(y[1])), reverse=True)[:7]
    assert set(p.tolist()) == {i for _, i in best}


def test_recall(spark):
    sf = "/root/testdata/sf0.01"
    got = {}
    for r in QUERIES["op2_cross_polytope"](spark, sf).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{sf}/embeddings.parquet'").fetchall()
    want = brute(rows, [r for r in rows if r[0] % 50 == 0])
    hit = 0
    for q, near in want.items():
        own = sorted(got[q])
        assert [r for r, _, _ in own] == [1, 2, 3, 4, 5]
        score = {i: -s for s, i in brute(rows, [(q, dict(rows)[q])], len(rows))[q]}
        assert all(s == pytest.approx(score[i], abs=1e-12) for _, i, s in own)
        assert [-s for _, _, s in own] == sorted(-s for _, _, s in own)
        hit += len({i for _, i, _ in own} & {i for _, i in near})
    assert hit >= 0.9 * 5 * len(want)


def test_large_class_blocks_and_ties(spark, monkeypatch):
    """A third of all rows hold one vector; blocks are cut small; equal scores go to smaller ids."""
    monkeypatch.setattr(C, "MEMBER_BLOCK", 16)
    monkeypatch.setattr(C, "QUERY_BLOCK", 4)
    rnd = random.Random(1)
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) if i % 3 == 0 else (i, [rnd.gauss(0, 1) for _ in range(4)]) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in C.search(df, df.filter("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    want = brute(rows, [r for r in rows if r[0] % 50 == 0])
    for q, near in want.items():
        if q % 3 == 0:
            assert [i for _, i in sorted(got[q])] == [i for _, i in near]
    assert sum(len({i for _, i in got[q]} & {i for _, i in near}) for q, near in want.items()) >= 0.9 * 5 * len(want)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [1.0, None]), (None, [1.0, 0.0]),
            (6, [2.0, 0.0]), (6, [2.0, 0.0]), (7, [1.0]), (8, []), (50, [0.0, 1.0]), (100, [1.0, 0.0]), (100, [0.0, 5.0]), (150, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS score", "1 AS cls", "2 AS dim")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in C.search(df, df.filter("vec_id % 50 = 0")).collect()]
    assert sorted(x for x in got if x[0] == 0)[:2] == [(0, 1, 6, 1.0), (0, 2, 100, 1.0)]
    assert not any(v == q for q, _, v, _ in got) and {v for _, _, v, _ in got} <= {0, 6, 50, 100}
    assert not any(q == 150 for q, *_ in got)
    none = df.filter("false")
    assert C.search(none, none).count() == 0


def test_recall_with_production_probes(spark):
    """2,000 vectors of noise: the parameters of the query, none of which depends on the size."""
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(2000, 64)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in C.search(df, df.filter("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute([(i, np.array(v, np.float32)) for i, v in rows], [(i, np.array(v, np.float32)) for i, v in rows if i % 50 == 0])
    assert sum(len(got[q] & {i for _, i in near}) for q, near in want.items()) >= 0.95 * 5 * len(want)


def test_very_long_and_short_vectors(spark):
    rows = [(0, [1e200, 2e200]), (1, [1e-200, 2.1e-200]), (2, [5e-324, 0.0]), (3, [1e308, -1e308]), (4, [3.0, 6.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.vec_id, round(r.score, 3)) for r in sorted(C.search(df, df.filter("vec_id = 0")).collect(), key=lambda r: r["rank"])]
    assert got == [(4, 1.0), (1, 1.0), (2, 0.447), (3, -0.316)]


def test_vectors_are_stored_once(spark, tmp_path):
    """Fails when each of the tables has a copy of every vector, and each probed axis one of the query, as it was."""
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(3000, 64)))], "vec_id long, embedding array<float>")
    df.write.parquet(f"{tmp_path}/v")
    df = spark.read.parquet(f"{tmp_path}/v")
    seen = []
    kept = C.written
    C.written = lambda d, *a: seen.append(kept(d, *a)) or seen[-1]
    try:
        C.search(df, df.filter("vec_id % 50 = 0"))
    finally:
        C.written = kept
    size = lambda d: sum(os.path.getsize(f.removeprefix("file:")) for f in d.inputFiles())
    assert sum(map(size, seen)) < 3 * size(df)
    cls = C.classes(C._valid(df), 6)
    assert cls._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
