"""Tree growth against a brute-force recursive CART on a small fixture, plus invariants."""

import math
import random

import pytest

from pyspark.sql import functions as F

from canopy.operators import prune as PRN
from canopy.operators import tree as TR
from canopy.sources import model_io as IO


def imp(a, b, crit):
    """Weighted gini or entropy in bits, written out."""
    if a + b <= 0:
        return 0.0
    p, q = a / (a + b), b / (a + b)
    if crit == "gini":
        return 1 - p * p - q * q
    return -sum(x * math.log2(x) for x in (p, q) if x > 0)


def brute_cart(X, y, crit="gini", w=(1.0, 1.0), msl=1, max_depth=None, node=1, depth=0, out=None):
    """Recursive CART with the library's rules: weighted impurity, midpoint thresholds,
    min_samples_leaf on raw rows, ties to lowest feature then lowest threshold."""
    out = {} if out is None else out
    c0 = sum(1 for v in y if v == 0)
    c1 = len(y) - c0
    W0, W1 = w[0] * c0, w[1] * c1
    im = imp(W0, W1, crit)
    out[node] = dict(t0=c0, t1=c1, feature=-1, threshold=None)
    n = len(y)
    if (max_depth is not None and depth >= max_depth) or n < 2 or n < 2 * msl or im <= TR.IMPURITY_EPS:
        return out
    best = None
    for j in range(len(X[0])):
        vals = sorted(set(r[j] for r in X))
        for a, b in zip(vals, vals[1:]):
            thr = (a + b) / 2.0
            left = [yy for r, yy in zip(X, y) if r[j] <= a]
            right = [yy for r, yy in zip(X, y) if r[j] > a]
            if len(left) < msl or len(right) < msl:
                continue
            l0, r0 = left.count(0), right.count(0)
            l1, r1 = len(left) - l0, len(right) - r0
            gain = ((W0 + W1) * im - (w[0] * l0 + w[1] * l1) * imp(w[0] * l0, w[1] * l1, crit)
                    - (w[0] * r0 + w[1] * r1) * imp(w[0] * r0, w[1] * r1, crit))
            key = (round(gain / (W0 + W1), 12), -j, -thr)
            if best is None or key > best[0]:
                best = (key, j, thr)
    if best is None:
        return out
    _, j, thr = best
    out[node].update(feature=j, threshold=thr)
    L = [(r, yy) for r, yy in zip(X, y) if r[j] <= thr]
    R = [(r, yy) for r, yy in zip(X, y) if r[j] > thr]
    brute_cart([r for r, _ in L], [yy for _, yy in L], crit, w, msl, max_depth, 2 * node, depth + 1, out)
    brute_cart([r for r, _ in R], [yy for _, yy in R], crit, w, msl, max_depth, 2 * node + 1, depth + 1, out)
    return out


def fixture(n=240, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rnd.randint(0, 2), rnd.randint(0, 4), rnd.choice([0.0, 0.5, 1.0, 1.5])
        p = 0.15 + 0.3 * (a == 2) + 0.25 * (b >= 3) + 0.2 * (c > 0.7)
        rows.append((i, float(a), float(b), c, int(rnd.random() < p)))
    return rows


@pytest.mark.parametrize("crit,cw,msl,depth", [("gini", None, 1, 4), ("entropy", "balanced", 5, 3),
                                               ("gini", {0: 0.3, 1: 0.7}, 2, None)])
def test_grow_matches_brute_force(spark, crit, cw, msl, depth):
    rows = fixture()
    df = spark.createDataFrame(rows, "rid long, a double, b double, c double, y int")
    g = TR.grow(df, ["a", "b", "c"], "y", [TR.Root("all", "true")],
                [TR.GrowSpec(0, "all", crit, cw, msl, depth)])
    tree = TR.tree_of(g.nodes, 0)
    X = [r[1:4] for r in rows]
    y = [r[4] for r in rows]
    w = TR.class_weights(TR.GrowSpec(0, "all", crit, cw), y.count(0), y.count(1))
    ref = brute_cart(X, y, crit, w, msl, depth)
    assert set(tree) == set(ref)
    for i, r in ref.items():
        t = tree[i]
        assert (t["t0"], t["t1"]) == (r["t0"], r["t1"])
        assert t["feature"] == r["feature"]
        if r["threshold"] is not None:
            assert math.isclose(t["threshold"], r["threshold"])


def test_shared_paths_and_eval_counts(spark):
    rows = fixture(300, seed=11)
    df = spark.createDataFrame([(*r, r[0] % 3) for r in rows], "rid long, a double, b double, c double, y int, f int")
    roots = [TR.Root(f"cv{k}", f"f <> {k}", f"f = {k}") for k in range(3)]
    specs = [TR.GrowSpec(i, r.name, crit, None, 1, 3) for i, (r, crit) in
             enumerate([(r, c) for r in roots for c in ("gini", "entropy")])]
    g = TR.grow(df, ["a", "b", "c"], "y", roots, specs, keep=["f"])
    nd = g.nodes
    # every spec's root holds exactly its train / eval rows
    for s in specs:
        k = int(s.root[2:])
        root = nd[(nd.gid == s.gid) & (nd.node == 1)].iloc[0]
        assert root.t0 + root.t1 == sum(1 for r in rows if r[0] % 3 != k)
        assert root.e0 + root.e1 == sum(1 for r in rows if r[0] % 3 == k)
    # eval counts of the leaves of a tree add up to the eval rows
    for s in specs:
        t = TR.tree_of(nd, s.gid)
        leaves = [n for i, n in t.items() if n["is_leaf"]]
        assert sum(n["e0"] + n["e1"] for n in leaves) == sum(1 for r in rows if r[0] % 3 == int(s.root[2:]))
    # growths with the same root share node keys where their paths agree
    assert nd.key.nunique() <= len(nd)


def test_derived_depth_equals_direct_growth_and_pruning_shrinks(spark):
    rows = fixture(300, seed=5)
    df = spark.createDataFrame(rows, "rid long, a double, b double, c double, y int")
    g5 = TR.grow(df, ["a", "b", "c"], "y", [TR.Root("all", "true")], [TR.GrowSpec(0, "all", "gini", None, 1, 6)])
    g3 = TR.grow(df, ["a", "b", "c"], "y", [TR.Root("all", "true")], [TR.GrowSpec(0, "all", "gini", None, 1, 3)])
    full = TR.tree_of(g5.nodes, 0)
    cut3 = PRN.derived_tree(full, PRN.Variant(0, 3, 2, 0.0))
    direct = TR.tree_of(g3.nodes, 0)
    assert set(cut3) == set(direct)
    for i in direct:
        assert cut3[i]["is_leaf"] == direct[i]["is_leaf"]
    leaves = lambda t: sum(1 for n in t.values() if n["is_leaf"])
    prev = leaves(PRN.derived_tree(full, PRN.Variant(0, None, 2, 0.0)))
    for a in (1e-4, 1e-3, 1e-2, 1e-1):
        cur = leaves(PRN.derived_tree(full, PRN.Variant(0, None, 2, a)))
        assert cur <= prev
        prev = cur
    mss = PRN.derived_tree(full, PRN.Variant(0, None, 100, 0.0))
    assert all(n["t0"] + n["t1"] >= 100 for n in mss.values() if not n["is_leaf"])


def test_root_split_matches_ml_regressor(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor

    rows = fixture(400, seed=9)
    df = spark.createDataFrame(rows, "rid long, a double, b double, c double, y int")
    best = TR.root_splits(df, ["a", "b", "c"], "y").orderBy("gain", ascending=False).first()
    va = VectorAssembler(inputCols=["a", "b", "c"], outputCol="v")
    m = DecisionTreeRegressor(featuresCol="v", labelCol="y", maxDepth=1, maxBins=64).fit(
        va.transform(df.withColumn("y", df.y.cast("double"))))
    split = m._call_java("rootNode").split()
    assert ["a", "b", "c"][split.featureIndex()] == best["feature"]
    assert math.isclose(split.threshold(), best["threshold"], abs_tol=0.51)  # ML uses the left value


def test_predict_expr_and_roundtrip(spark, tmp_path):
    rows = fixture(200, seed=3)
    df = spark.createDataFrame(rows, "rid long, a double, b double, c double, y int")
    g = TR.grow(df, ["a", "b", "c"], "y", [TR.Root("all", "true")], [TR.GrowSpec(0, "all", "gini", None, 1, 3)])
    tree = TR.tree_of(g.nodes, 0)
    p1 = [r[0] for r in df.select(TR.predict_expr(tree, ["a", "b", "c"])).collect()]
    path = str(tmp_path / "model")
    IO.save_tree(spark, tree, ["a", "b", "c"], path)
    t2, feats = IO.load_tree(spark, path)
    p2 = [r[0] for r in df.select(TR.predict_expr(t2, feats)).collect()]
    assert p1 == p2
    imp = TR.importances(tree, ["a", "b", "c"])
    assert math.isclose(imp.importance.sum(), 1.0)


def test_high_cardinality_feature_is_binned_and_scores_consistently(spark):
    rnd = random.Random(21)
    rows = []
    for i in range(3000):
        x = rnd.random()
        rows.append((i, x, float(rnd.randint(0, 2)), int((x > 0.37) != (rnd.random() < 0.1))))
    df = spark.createDataFrame(rows, "rid long, x double, k double, y int")
    g = TR.grow(df, ["x", "k"], "y", [TR.Root("all", "true")], [TR.GrowSpec(0, "all", "gini", None, 1, 3)],
                max_bins=16)
    bins = TR.fit_bins(df, ["x", "k"], 16)
    assert set(bins) == {"x"}                      # the 3-valued feature stays exact
    tree = TR.tree_of(g.nodes, 0)
    assert tree[1]["feature"] == 0 and any(abs(tree[1]["threshold"] - e) < 1e-12 for e in bins["x"])
    # scoring raw values lands every row in the leaf it was counted in during growth
    leaf = df.select(TR.predict_expr(tree, ["x", "k"], "node").alias("leaf")).groupBy("leaf").count().collect()
    got = {r["leaf"]: r["count"] for r in leaf}
    want = {i: n["t0"] + n["t1"] for i, n in tree.items() if n["is_leaf"]}
    assert got == want


def test_wide_feature_is_exact_by_default(spark):
    """1,000 distinct values: growth with default arguments equals the brute-force tree, and its
    root split is the best of ``root_splits``."""
    rnd = random.Random(33)
    rows = [(i, float(v), float(rnd.randint(0, 2)), 0.0, int((v % 397 > 200) != (rnd.random() < 0.2)))
            for i, v in enumerate(rnd.sample(range(5000), 1000))]
    df = spark.createDataFrame(rows, "rid long, a double, b double, c double, y int")
    g = TR.grow(df, ["a", "b", "c"], "y", [TR.Root("all", "true")], [TR.GrowSpec(0, "all", "gini", None, 5, 3)])
    tree = TR.tree_of(g.nodes, 0)

    want = brute_cart([r[1:4] for r in rows], [r[4] for r in rows], msl=5, max_depth=3)
    assert set(tree) == set(want)
    for i, n in want.items():
        assert (tree[i]["t0"], tree[i]["t1"], tree[i]["feature"]) == (n["t0"], n["t1"], n["feature"])
        assert n["threshold"] is None or tree[i]["threshold"] == n["threshold"]
    top = TR.root_splits(df, ["a", "b", "c"], "y", min_samples_leaf=5).orderBy(F.desc("gain"), "feature", "threshold").first()
    assert top["feature"] == "abc"[tree[1]["feature"]] and top["threshold"] == tree[1]["threshold"]


def test_derive_on_arrays_equals_the_single_tree(spark):
    rows = fixture(500, seed=11)
    df = spark.createDataFrame(rows, "rid long, a double, b double, c double, y int")
    g = TR.grow(df, ["a", "b", "c"], "y", [TR.Root("all", "true")], [TR.GrowSpec(0, "all", "gini", None, 1, None)])
    tree = TR.tree_of(g.nodes, 0)
    variants = [PRN.Variant(i, d, m, a) for i, (d, m, a) in enumerate(
        (d, m, a) for d in (None, 1, 3, 6) for m in (2, 30, 200) for a in (0.0, 1e-4, 1e-3, 1e-2, 0.2))]
    got = PRN.derive_group(g.nodes.assign(threshold=-1.0), variants)
    for v in variants:
        want = {i for i, n in PRN.derived_tree(tree, v).items() if n["is_leaf"]}
        own = got[got.vid == v.vid]
        assert set(own.node) == want and set(own.n_leaves) == {len(want)}
        assert sum(own.t0 + own.t1) == len(rows)


def whole_leaves(g, variant):
    """Leaves of a derived tree by recursion over the collected node table."""
    nodes = {r["key"]: r.asDict() for r in g.table.collect()}
    top = next(n for n in nodes.values() if n["parent"] is None)

    def cost(key):
        n = nodes[key]
        own = (n["W0"] + n["W1"]) * n["impurity"] / n["w_root"] + variant.ccp_alpha
        if (n["is_leaf"] or n["t0"] + n["t1"] < variant.min_samples_split
                or variant.max_depth is not None and n["depth"] >= variant.max_depth):
            return own, [key]
        (a, left), (b, right) = cost(n["lkey"]), cost(n["rkey"])
        if variant.ccp_alpha > 0 and own <= a + b:
            return own, [key]
        return a + b, left + right

    return set(cost(top["key"])[1])


def one_partition(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.shuffle.partitions", before))


def test_trees_beyond_61_levels(spark, request):
    """A chain that peels one value off per level: no depth limit, deep pruning block by block, scoring by table."""
    rows = [(float(i), i % 2) for i in range(74)]
    df = spark.createDataFrame(rows, "x double, y int")
    one_partition(spark, request)
    g = TR.grow(df, ["x"], "y", [TR.Root("all", "true")], [TR.GrowSpec(0, "all")])
    assert g.depth > 70
    variants = [PRN.Variant(i, d, m, a) for i, (d, m, a) in enumerate(
        (d, m, a) for d in (None, 5, 30, 69) for m in (2, 20) for a in (0.0, 0.002, 0.01, 0.014, 0.5))]
    got = {}
    for r in PRN.derive(g.table, variants, g.depth).collect():
        got.setdefault(r["vid"], set()).add(r["key"])
    for v in variants:
        assert got[v.vid] == whole_leaves(g, v)
    assert len(got[0]) > 70
    leaves = PRN.derive(g.table, variants[:1], g.depth)
    scored = TR.score_by_table(df, ["x"], g, 0, leaves).collect()
    assert sorted((r["x"], r["pred"]) for r in scored) == rows
    assert g.table.where("depth > 61 AND node IS NULL").count() == g.table.where("depth > 61").count() > 0


def test_blocks_equal_the_single_tree(spark, monkeypatch):
    """Blocks of three levels: growth, pruning and the winners' leaves do not depend on the cut."""
    rows = fixture(500, seed=11)
    df = spark.createDataFrame(rows, "rid long, a double, b double, c double, y int")
    monkeypatch.setattr(TR, "BAND", 3)
    monkeypatch.setattr(PRN, "BAND", 3)
    specs = [TR.GrowSpec(0, "all", "gini", None, 1, None), TR.GrowSpec(1, "all", "entropy", "balanced", 2, 7)]
    g = TR.grow(df, ["a", "b", "c"], "y", [TR.Root("all", "true")], specs)
    assert g.depth >= 6
    variants = [PRN.Variant(i, d, m, a) for i, (d, m, a) in enumerate(
        (d, m, a) for d in (None, 1, 3, 6) for m in (2, 30, 200) for a in (0.0, 1e-4, 1e-3, 1e-2, 0.2))]
    leaves = PRN.derive(g.table, variants, g.depth).cache()
    got = leaves.toPandas()
    for s in specs:
        own = PRN.derive_group(g.nodes[g.nodes.gid == s.gid].assign(threshold=-1.0), variants)
        want = {(r.vid, r.key, r.node, r.t0, r.t1, round(r.prob, 12), r.pred) for r in own.itertuples()}
        mine = got[got.gid == s.gid]
        assert {(r.vid, r.key, r.node, r.t0, r.t1, round(r.prob, 12), r.pred) for r in mine.itertuples()} == want
    tree = g.trees({0: None})[0]
    for v in (0, 22):
        by_expr = df.select("rid", TR.predict_expr(PRN.derived_tree(tree, variants[v]), ["a", "b", "c"]).alias("prob"))
        by_table = TR.score_by_table(df, ["a", "b", "c"], g, 0, leaves.where(f"gid = 0 AND vid = {v}"))
        assert sorted(map(tuple, by_expr.collect())) == sorted((r["rid"], r["prob"]) for r in by_table.collect())


def test_collected_trees_are_bounded(spark, monkeypatch):
    rows = fixture(200, seed=3)
    df = spark.createDataFrame(rows, "rid long, a double, b double, c double, y int")
    g = TR.grow(df, ["a", "b", "c"], "y", [TR.Root("all", "true")], [TR.GrowSpec(0, "all")])
    assert len(g.trees({0: 2})[0]) <= 7
    monkeypatch.setattr(TR, "MAX_TREE_NODES", 5)
    with pytest.raises(ValueError, match="score_by_table"):
        g.trees({0: None})
