"""Splits against a one-window brute force; metrics against pairwise brute force."""

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from canopy.operators import metrics as MT
from canopy.operators import split as SP


def _frame(spark, n=400, seed=3):
    rnd = random.Random(seed)
    rows = [(i * 7 + 3, rnd.choice(["Yes", "No", "No"])) for i in range(n)]
    return spark.createDataFrame(rows, "rid long, label string"), rows


def _md5_rank(rows, seed=42, by_class=True):
    key = {r[0]: hashlib.md5(f"{seed}:{r[0]}".encode()).hexdigest() for r in rows}
    out = {}
    groups = {}
    for rid, lab in rows:
        groups.setdefault(lab if by_class else "_", []).append(rid)
    for g, ids in groups.items():
        for i, rid in enumerate(sorted(ids, key=lambda x: (key[x], x))):
            out[rid] = (i + 1, len(ids))
    return out


def test_two_stage_rank_equals_one_window(spark):
    df, rows = _frame(spark)
    got = {r["rid"]: (r[SP.RANK], r[SP.N_CLASS]) for r in SP.hash_rank(df, "rid", "label").collect()}
    assert got == _md5_rank(rows)
    got1 = {r["rid"]: r[SP.RANK] for r in SP.hash_rank(df, "rid", None, digits=1).collect()}
    assert got1 == {k: v[0] for k, v in _md5_rank(rows, by_class=False).items()}


def test_folds_disjoint_cover_and_balanced(spark):
    df, rows = _frame(spark)
    f = SP.stratified_kfold(df, "rid", "label", 5).collect()
    assert len(f) == len(rows) and len({r["rid"] for r in f}) == len(rows)
    counts = {}
    for r in f:
        counts.setdefault(r["label"], {}).setdefault(r["fold"], 0)
        counts[r["label"]][r["fold"]] += 1
    for per in counts.values():
        assert max(per.values()) - min(per.values()) <= 1


def _largest_remainder(sizes, share):
    """{class: rows of the first part}: fixed total, floors for the rest, then largest remainders."""
    total = sum(sizes.values())
    rest = total - math.ceil(total * share)
    base = {c: rest * n // total for c, n in sizes.items()}
    left = rest - sum(base.values())
    order = sorted(sizes, key=lambda c: (-(rest * sizes[c] % total), c is not None, c))
    return {c: sizes[c] - base[c] - (order.index(c) < left) for c in sizes}


@pytest.mark.parametrize("n", [400, 401, 403, 57])
def test_holdout_totals_and_shares(spark, n):
    rnd = random.Random(n)
    rows = [(i * 7 + 3, rnd.choice(["Yes", "No", "No", "Maybe", None])) for i in range(n)]
    df = spark.createDataFrame(rows, "rid long, label string")
    sizes = Counter(r[1] for r in rows)
    test = _largest_remainder(sizes, 0.2)
    got = SP.holdout_split(df, "rid", "label", 0.2).collect()
    assert len(got) == n and sum(r["split"] == "test" for r in got) == math.ceil(n / 5)
    assert Counter(r["label"] for r in got if r["split"] == "test") == {c: k for c, k in test.items() if k}
    three = SP.three_way_split(df, "rid", "label", 0.2, 0.25).collect()
    left = {c: sizes[c] - test[c] for c in sizes}
    val = _largest_remainder(left, 0.25)
    assert Counter(r["label"] for r in three if r["split"] == "val") == {c: k for c, k in val.items() if k}
    assert {r["rid"] for r in three if r["split"] == "test"} == {r["rid"] for r in got if r["split"] == "test"}


def test_null_label_is_a_class(spark):
    rows = [(i, None if i % 5 == 0 else "Yes" if i % 3 else "No") for i in range(100)]
    df = spark.createDataFrame(rows, "rid long, label string")
    for out in (SP.holdout_split(df, "rid", "label"), SP.three_way_split(df, "rid", "label"), SP.kfold(df, "rid"),
                SP.stratified_kfold(df, "rid", "label"), SP.contiguous_kfold(df, "rid", "label")):
        assert out.count() == 100 and out.where("rid % 5 = 0").count() == 20


def test_null_group_is_a_group(spark):
    rows = [(g, int(p > 0.4), p, int(p > 0.5)) for g in (None, 1) for p in (0.1, 0.3, 0.45, 0.6, 0.9)]
    df = spark.createDataFrame(rows, "g int, y int, prob double, pred int")
    for out in (MT.roc_auc(df, ["g"]), MT.average_precision(df, ["g"]), MT.accuracy(df, ["g"])):
        assert {r["g"] for r in out.collect()} == {None, 1}
    for out in (MT.roc_curve(df, ["g"]), MT.pr_curve(df, ["g"])):
        by = {}
        for r in out.collect():
            by.setdefault(r["g"], []).append(tuple(r)[1:])
        assert sorted(map(str, by[None])) == sorted(map(str, by[1]))


def test_scores_outside_the_unit_range(spark):
    rnd = random.Random(4)
    ys = [rnd.randint(0, 1) for _ in range(300)]
    ps = [rnd.gauss(2.0 * y, 50.0) for y in ys]
    df = spark.createDataFrame([(0, y, p, 0) for y, p in zip(ys, ps)], "g int, y int, prob double, pred int")
    assert abs(MT.roc_auc(df, ["g"]).first()["roc_auc"] - _brute_auc(ys, ps)) < 1e-12
    assert abs(MT.average_precision(df, ["g"]).first()["average_precision"] - _brute_ap(ys, ps)) < 1e-12


def test_inner_fold_closed_form_equals_reranking(spark):
    df, rows = _frame(spark, n=120)
    r = SP.stratified_kfold(df, "rid", "label", 5, keep_rank=True)
    r = r.withColumns({f"in{o}": SP.inner_fold(F.col(SP.RANK), F.lit(o), 5, 3) for o in range(5)}).collect()
    for o in range(5):
        for lab in ("Yes", "No"):
            part = sorted([x for x in r if x["label"] == lab and x["fold"] != o], key=lambda x: x[SP.RANK])
            for i, x in enumerate(part):
                assert x[f"in{o}"] == i % 3


def test_contiguous_fold_sizes_follow_allocation(spark):
    df, rows = _frame(spark, n=103)
    got = SP.contiguous_kfold(df, "rid", "label", 5).collect()
    classes = list(dict.fromkeys(r[1] for r in sorted(rows)))  # in the order of their first row
    labels = sorted((r[1] for r in rows), key=classes.index)
    alloc = [[sum(1 for x in labels[i::5] if x == c) for c in classes] for i in range(5)]
    for ci, c in enumerate(classes):
        ids = sorted(r["rid"] for r in got if r["label"] == c)
        fold_of = {r["rid"]: r["fold"] for r in got}
        expect = [f for f in range(5) for _ in range(alloc[f][ci])]
        assert [fold_of[i] for i in ids] == expect


def _brute_auc(ys, ps):
    pos = [p for y, p in zip(ys, ps) if y == 1]
    neg = [p for y, p in zip(ys, ps) if y == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def _brute_ap(ys, ps):
    P = sum(ys)
    ap, prev_r = 0.0, 0.0
    for t in sorted(set(ps), reverse=True):
        sel = [y for y, p in zip(ys, ps) if p >= t]
        tp = sum(sel)
        r, prec = tp / P, tp / len(sel)
        ap += (r - prev_r) * prec
        prev_r = r
    return ap


@pytest.mark.parametrize("seed,digits", [(1, 1), (2, 1), (3, None)])
def test_auc_ap_against_brute_force(spark, seed, digits):
    rnd = random.Random(seed)
    ys = [rnd.randint(0, 1) for _ in range(600)]
    ps = [rnd.random() * (0.5 + 0.5 * y) for y in ys]
    if digits is not None:
        ps = [round(p, digits) for p in ps]  # many ties; unrounded: one score per bucket
    df = spark.createDataFrame([(0, y, p, int(p > 0.5)) for y, p in zip(ys, ps)], "g int, y int, prob double, pred int")
    auc = MT.roc_auc(df, ["g"]).first()["roc_auc"]
    ap = MT.average_precision(df, ["g"]).first()["average_precision"]
    assert abs(auc - _brute_auc(ys, ps)) < 1e-6
    assert abs(ap - _brute_ap(ys, ps)) < 1e-6
    # AUC is unchanged by a monotone map of the scores
    auc2 = MT.roc_auc(df.withColumn("prob", F.col("prob") * 3 + 1), ["g"]).first()["roc_auc"]
    assert abs(auc - auc2) < 1e-9
    cm = MT.confusion_matrix(df, ["g"]).collect()
    assert sum(r["n"] for r in cm) == len(ys) and len(cm) == 4


def test_single_class_group_gives_null_auc(spark):
    df = spark.createDataFrame([(0, 1, 0.3, 0), (0, 1, 0.7, 1)], "g int, y int, prob double, pred int")
    assert MT.roc_auc(df, ["g"]).first()["roc_auc"] is None
    rep = {r["label"]: r for r in MT.class_report(df, ["g"]).collect()}
    assert rep["0"]["precision"] == 0.0 and rep["1"]["recall"] == 0.5


def test_auc_equals_spark_ml_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rnd = random.Random(8)
    ys = [rnd.randint(0, 1) for _ in range(500)]
    ps = [round(rnd.random() * (0.4 + 0.6 * y), 2) for y in ys]
    df = spark.createDataFrame([(0, y, p, int(p > 0.5)) for y, p in zip(ys, ps)], "g int, y int, prob double, pred int")
    ours = MT.roc_auc(df, ["g"]).first()["roc_auc"]
    ev = BinaryClassificationEvaluator(rawPredictionCol="prob", labelCol="yd", metricName="areaUnderROC")
    theirs = ev.evaluate(df.withColumn("yd", F.col("y").cast("double")))
    assert abs(ours - theirs) < 1e-6
