"""Growth inside tasks against growth level by level, and pruning of whole trees against pruning by blocks."""

import random

import pytest
from pyspark.sql import functions as F

from canopy.operators import prune as PRN
from canopy.operators import tree as TR

FEATS = ["a", "b", "c", "w"]


def table(spark, n=300, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = float(rnd.randint(0, 3)), rnd.choice([None, 0.0, 1.0, 2.0])
        c, w = rnd.choice([0.5, 1.5, float("nan")]), float(rnd.randint(0, 400))
        rows.append((i % 3, a, b, c, w, int(rnd.random() < 0.2 + 0.15 * a)))
    return spark.createDataFrame(rows, "f int, a double, b double, c double, w double, y int")


def growth(df):
    roots = [TR.Root("cv0", "f <> 0", "f = 0"), TR.Root("cv1", "f <> 1", "f = 1"), TR.Root("none", "false", "true")]
    specs = [(r.name, c, w, m, d) for r in roots
             for c, w, m, d in (("gini", None, 1, 5), ("entropy", "balanced", 4, None), ("gini", {0: 0.3, 1: 0.7}, 2, 3))]
    return TR.grow(df, FEATS, "y", roots, [TR.GrowSpec(i, *s) for i, s in enumerate(specs)], keep=["f"])


def nodes(g):
    cols = ["gid", "node", "depth", "t0", "t1", "e0", "e1", "feature", "is_leaf"]
    real = ["cw0", "cw1", "w_root", "W0", "W1", "impurity", "gain", "threshold"]
    return {(r["gid"], r["node"]): ([r[c] for c in cols], [r[c] for c in real]) for r in g.table.collect()}


@pytest.mark.parametrize("most", [60])
def test_growth_in_tasks_equals_growth_by_levels(spark, monkeypatch, most):
    df = table(spark).cache()
    here = nodes(growth(df))
    monkeypatch.setattr(TR, "LOCAL_CELLS", most)
    there = nodes(growth(df))
    assert set(here) == set(there)
    for k, (same, near) in here.items():
        assert there[k][0] == same
        assert there[k][1] == pytest.approx(near, nan_ok=True, abs=1e-9)


def test_small_tables_grow_without_a_job_per_level(spark, monkeypatch):
    """Fails when every level is a job of its own, as it was."""
    calls = []
    monkeypatch.setattr(TR, "level_job", lambda *a: calls.append(a))
    assert growth(table(spark)).depth > 3 and not calls


def test_whole_trees_prune_as_their_blocks_do(spark, monkeypatch):
    g = growth(table(spark))
    variants = [PRN.Variant(0, None), PRN.Variant(1, 4, 6, 0.001), PRN.Variant(2, None, 2, 0.01), PRN.Variant(3, 2)]
    what = ["gid", "vid", "t0", "t1", "e0", "e1", "pred", F.round("prob", 9)]
    whole = sorted(map(tuple, PRN.derive(g.table, variants, g.depth).select(*what).collect()))
    group = ["gid", "vid", "pred", F.round("prob", 9).alias("p")]
    sums = [F.sum(c).alias(c) for c in ("t0", "t1", "e0", "e1")]
    merged = PRN.derive(g.table, variants, g.depth, merged=True)
    assert merged.count() < len(whole)
    added = sorted(map(tuple, merged.groupBy(*group).agg(*sums).collect()))
    assert added == sorted(map(tuple, PRN.derive(g.table, variants, g.depth).groupBy(*group).agg(*sums).collect()))
    monkeypatch.setattr(PRN, "WHOLE", 0)
    assert sorted(map(tuple, PRN.derive(g.table, variants, g.depth).select(*what).collect())) == whole
    by_block = PRN.derive(g.table, variants, g.depth, merged=True).groupBy(*group).agg(*sums)
    assert sorted(map(tuple, by_block.collect())) == added


def test_cells_do_not_multiply_with_folds(spark, monkeypatch):
    """Fails when a cell is a feature vector per label and fold: their number grew with the rows, up to one for each."""
    seen = []
    whole = TR.subtrees
    monkeypatch.setattr(TR, "subtrees", lambda small, *a: seen.extend(rows.count() for rows, _, _ in small) or whole(small, *a))
    df = spark.range(600).selectExpr("cast(id % 5 AS double) AS a", "cast(id % 2 AS double) AS b", "0D AS c", "0D AS w",
                                     "cast(id % 3 AS int) AS f", "cast(id % 7 > 3 AS int) AS y")
    g = growth(df)
    assert seen == [10]
    tops = g.table.where("depth = 0").groupBy("gid").agg(F.expr("sum(t0 + t1) AS t"), F.expr("sum(e0 + e1) AS e")).collect()
    assert sorted((r["t"], r["e"]) for r in tops) == [(0, 600)] * 3 + [(400, 200)] * 6


@pytest.mark.parametrize("most", [1 << 17, 60])
def test_variants_are_pruned_where_subtrees_grow(spark, monkeypatch, most):
    """Fails when a search writes all nodes and prunes them in jobs of their own, as it did."""
    df = table(spark).cache()
    monkeypatch.setattr(TR, "LOCAL_CELLS", most)
    monkeypatch.setattr(TR, "SHARE_CELLS", 200)
    roots = [TR.Root("cv0", "f <> 0", "f = 0"), TR.Root("cv1", "f <> 1", "f = 1"), TR.Root("none", "false", "true")]
    specs = [(r.name, c, w, m, d) for r in roots
             for c, w, m, d in (("gini", None, 1, 5), ("entropy", "balanced", 4, None), ("gini", {0: 0.3, 1: 0.7}, 1, None))]
    specs = [TR.GrowSpec(i, *s) for i, s in enumerate(specs)]
    variants = [PRN.Variant(7, None), PRN.Variant(1, 4, 6, 0.001), PRN.Variant(2, None, 2, 0.01), PRN.Variant(3, 2), PRN.Variant(0, None, 20, 0.003)]
    g = TR.grow(df, FEATS, "y", roots, specs, keep=["f"])
    group = ["gid", "vid", "pred", F.round("prob", 9).alias("p")]
    sums = [F.sum(c).alias(c) for c in ("t0", "t1", "e0", "e1")]
    want = sorted(map(tuple, PRN.derive(g.table, variants, g.depth).groupBy(*group).agg(*sums).collect()))
    monkeypatch.setattr(TR, "grow", None)
    got = PRN.derive_grown(df, FEATS, "y", roots, specs, variants, ["f"])
    assert sorted(map(tuple, got.groupBy(*group).agg(*sums).collect())) == want and len(want) > 100


def test_a_level_of_small_nodes_is_a_few_blocks_of_arrays():
    """Fails when a subtree grows node by node, as it did: 2,000 cells gave some 4,000 nodes, each with a pass of its own."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 3, (2000, 9)).astype(float), rng.integers(0, 2, 2000)
    w = np.stack([1 - y, y, np.zeros_like(y), np.zeros_like(y)], 1)
    cells = pa.table({"x": x.tolist(), "w": w.tolist()}, schema=pa.schema({"x": pa.list_(pa.float64()), "w": pa.list_(pa.int64())}))
    one = {"gid": 0, "root": 0, "path": 0, "key": 5, "depth": 0, "node": 1, "parent": None, "block": 5, "above": None, "cw0": None, "cw1": None,
           "w_root": None, "crit": 0, "msl": 1, "max_depth": None}
    calls = []
    block = TR.SUB.Group._block
    TR.SUB.Group._block = lambda self, *a: calls.append(1) or block(self, *a)
    try:
        nodes = TR.SUB.grow_group(cells, pa.Table.from_pylist([{**one, "gid": g, "msl": m} for g, m in enumerate((1, 3))]), 9, None, TR.BAND)
    finally:
        TR.SUB.Group._block = block
    assert len(nodes) > 2000 and len(calls) < 40
    df = nodes.to_pandas(integer_object_nulls=True)
    for g in (0, 1):
        own = df[df.gid == g].astype({"key": "int64"}).set_index("key")
        assert own.index.is_unique and own[own.is_leaf][["t0", "t1"]].to_numpy().sum() == 2000
        inner = own[~own.is_leaf]
        for side in ("lkey", "rkey"):
            child = own.loc[inner[side].astype("int64")]
            assert (child.parent.astype("int64").to_numpy() == inner.index).all() and (child.depth.to_numpy() == inner.depth + 1).all()
        assert (own.loc[inner.lkey.astype("int64"), "t0"].to_numpy() + own.loc[inner.rkey.astype("int64"), "t0"].to_numpy() == inner.t0).all()
