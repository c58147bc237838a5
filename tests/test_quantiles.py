"""Exact quantiles and running sums over ranges, and the Poisson draws, against numpy and plain loops."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from canopy.functions import encode as E
from canopy.operators import metrics as M
from canopy.operators import profile as PR
from canopy.operators import quantiles as Q

PROBS = [0.0, 0.1, 0.33, 0.5, 0.66, 0.999, 1.0]


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(5)


def test_quantiles_of_continuous_crowded_and_tied_columns(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(6000):
        key = None if i % 50 == 0 else "hot" if i % 3 else f"k{i % 7}"
        rows.append((key, rnd.gauss(0, 1), 1.0 + 1e-12 * rnd.random(), float(rnd.randrange(3)),
                     None if i % 2 else -rnd.expovariate(1e-9)))
    df = table(spark, rows, "k string, wide double, crowded double, coded double, holes double")
    names = ["wide", "crowded", "coded", "holes"]
    got = Q.fit_quantiles(df, {c: F.col(c) for c in names}, PROBS, "k")
    assert set(got) == {r[0] for r in rows}
    for k in got:
        for j, c in enumerate(names, 1):
            want = np.quantile([r[j] for r in rows if r[0] == k and r[j] is not None], PROBS)
            assert np.allclose(got[k][c], want, rtol=1e-12, atol=0 if c != "wide" else 1e-14), (k, c)


def test_quantiles_take_weights(spark):
    rnd = random.Random(2)
    rows = [(rnd.random(), rnd.randrange(1, 9)) for _ in range(700)]
    df = table(spark, rows, "x double, times long")
    got = Q.fit_quantiles(df, {"x": F.col("x")}, PROBS, weight=F.col("times"))["x"]
    assert np.allclose(got, np.quantile(np.repeat(*map(list, zip(*rows))), PROBS), rtol=1e-12)


def test_quantiles_of_nothing_and_of_one(spark):
    df = spark.createDataFrame([(None, 3.0), (None, 3.0)], "empty double, one double")
    assert Q.fit_quantiles(df, {c: F.col(c) for c in df.columns}, [0.2, 0.5]) == {"empty": [None, None], "one": [3.0, 3.0]}
    assert E.fit_medians(df.limit(0), ["empty", "one"]) == {"empty": None, "one": None}
    assert Q.fit_quantiles(df.limit(0), {"one": F.col("one")}, [0.5], "empty") == {}


def test_names_may_clash_with_ours(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (3.0, 7.0, 2.0)], "n double, value double, column_name double")
    assert E.fit_medians(df, df.columns) == {"n": 2.0, "value": 6.0, "column_name": 2.0}


def test_no_range_holds_a_hot_key(spark):
    """One key with nearly all values is cut into as many ranges as the session has partitions."""
    df = spark.range(20_000).select(F.when(F.col("id") % 100 == 0, "cold").otherwise("hot").alias("k"),
                                    (F.col("id") * 1e-9).alias("value"), F.lit(1).cast("long").alias("n"))
    sizes = Q.in_ranges(df, ["k"]).groupBy(Q.RANGE).count().collect()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(sizes) == parts and max(r["count"] for r in sizes) < 2 * 20_000 / parts


def curve(rows):
    """Plain ROC, AUC and AP of (y, score) rows."""
    pos, neg = sum(y for y, _ in rows), sum(1 - y for y, _ in rows)
    pts, tp, fp, ap, auc = [(0, 0, math.inf)], 0, 0, 0.0, 0.0
    for s in sorted({s for _, s in rows}, reverse=True):
        p, n = sum(y for y, t in rows if t == s), sum(1 - y for y, t in rows if t == s)
        auc += n * (tp + 0.5 * p)
        tp, fp = tp + p, fp + n
        ap += p / pos * tp / (tp + fp)
        pts.append((tp, fp, s))
    kept = [p for i, p in enumerate(pts) if i in (0, 1, len(pts) - 1)
            or pts[i + 1][0] - p[0] != p[0] - pts[i - 1][0] or pts[i + 1][1] - p[1] != p[1] - pts[i - 1][1]]
    return [(i, s, fp / neg, tp / pos) for i, (tp, fp, s) in enumerate(kept)], auc / pos / neg, ap


@pytest.mark.parametrize("spread", [1.0, 1e-9])
def test_curves_of_continuous_and_crowded_scores(spark, spread):
    rnd = random.Random(3)
    rows = []
    for i in range(1200):
        y = int(rnd.random() < 0.4)
        rows.append((None if i % 3 == 0 else i % 2, y, 0.5 + spread * round(rnd.gauss(0.1 * y, 0.1), 3 if i % 2 else 12)))
    df = table(spark, rows, "g int, y int, prob double")
    roc, auc, ap = (f(df, ["g"]).collect() for f in (M.roc_curve, M.roc_auc, M.average_precision))
    for g in (None, 0, 1):
        want, want_auc, want_ap = curve([r[1:] for r in rows if r[0] == g])
        got = sorted((r["point"], r["threshold"], r["fpr"], r["tpr"]) for r in roc if r["g"] == g)
        assert len(got) == len(want) and np.allclose([p[2:] for p in got], [p[2:] for p in want])
        assert [p[:2] for p in got] == [p[:2] for p in want]
        assert math.isclose([r["roc_auc"] for r in auc if r["g"] == g][0], want_auc)
        assert math.isclose([r["average_precision"] for r in ap if r["g"] == g][0], want_ap)


def poisson_quantile(n, u):
    k, below = 0, 0.0
    while True:
        below += math.exp(k * math.log(n) - n - math.lgamma(k + 1))
        if below >= u or k > n + 40 * math.sqrt(n) + 50:
            return k
        k += 1


def test_poisson_draws(spark):
    """Below the switch the draw is the exact quantile of u1; above it the draws have the mean, variance
    and skew of the law, and meet the exact quantile of their normal deviate."""
    from hashlib import md5

    cells = spark.createDataFrame([(0, "a", 0.0, 1), (0, "a", 1.0, 499), (1, "b", 2.0, 500), (1, "b", 0.5, 40_000)],
                                  "t int, column_name string, value double, n long")
    got = {}
    for r in PR.poisson_weights(cells, 4000, 7).collect():
        got.setdefault((r["t"], r["column_name"], r["value"]), {})[r["rep"]] = r["w"]
    for c in cells.collect():
        w = got[tuple(c)[:3]]
        assert sorted(w) == list(range(1, 4001))
        x = np.array(list(w.values()), float)
        assert abs(x.mean() - c["n"]) < 4 * math.sqrt(c["n"] / 4000)
        assert abs(x.var() / c["n"] - 1) < 0.12 + 4 * math.sqrt(1 / (4000 * c["n"]))
        off = 0
        for rep in range(1, 101):
            h = md5(f"7:{c['t']}:{c['column_name']}:{c['value']}:{rep}".encode()).hexdigest()
            u1, u2 = ((int(h[a:a + 13], 16) + 0.5) / 2**52 for a in (0, 13))
            if c["n"] >= PR.POISSON_NORMAL:
                u1 = 0.5 * math.erfc(-math.sqrt(-2 * math.log(u1)) * math.cos(2 * math.pi * u2) / math.sqrt(2))
                assert abs(w[rep] - poisson_quantile(c["n"], u1)) <= 1
            off += w[rep] != poisson_quantile(c["n"], u1)
        assert off == 0 if c["n"] < PR.POISSON_NORMAL else off <= 3
