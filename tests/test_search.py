"""Search through shared growths equals fitting each (fold, grid row) on its own."""

from pyspark.sql import functions as F

from canopy.operators import metrics as MT
from canopy.operators import prune as PRN
from canopy.operators import tree as TR
from canopy.plans import search as S
from canopy.plans import strategies as ST
from tests.conftest import SF0001

GRID = {"max_depth": [2, 4], "min_samples_leaf": [1, 20], "min_samples_split": [2, 50],
        "criterion": ["gini", "entropy"], "ccp_alpha": [0.0, 0.002], "class_weight": [None, "balanced"]}


def test_grid_order_matches_parameter_grid_convention():
    ps = S.expand_grid({"max_depth": [3, 5], "criterion": ["gini", "entropy"]})
    assert [(p.criterion, p.max_depth) for p in ps] == [("gini", 3), ("gini", 5), ("entropy", 3), ("entropy", 5)]


def test_search_equals_independent_fits(spark, have_data):
    data = ST.holdout_frame(spark, SF0001).cache()
    feats = ST.feature_names(data)
    res = S.grid_search(data, feats, "Coping_Struggles", "fold", list(range(5)), GRID,
                        where="fold <= 4", keep=["fold"])
    fs = {(r["param_id"], r["fold"]): r["roc_auc"] for r in res.fold_scores.collect()}
    assert len(fs) == len(res.params) * 5
    # best = highest mean AUC, first grid row on ties
    means = {}
    for (p, f), v in fs.items():
        means.setdefault(p, []).append(v if v is not None else float("-inf"))
    best = max(sorted(means), key=lambda p: round(sum(means[p]) / 5, 12))
    assert res.best_index == best
    # three grid rows x one fold, each grown on its own and scored from its own leaves
    for pid in (0, res.best_index, len(res.params) - 1):
        p = res.params[pid]
        root = TR.Root("solo", "(fold <= 4) AND fold <> 2", "(fold <= 4) AND fold = 2")
        g = TR.grow(data, feats, "Coping_Struggles", [root],
                    [TR.GrowSpec(0, "solo", p.criterion, p.class_weight, p.min_samples_leaf, p.max_depth)],
                    keep=["fold"])
        t = PRN.derived_tree(TR.tree_of(g.nodes, 0), PRN.Variant(0, p.max_depth, p.min_samples_split, p.ccp_alpha))
        rows = [(0, n["W1"] / (n["W0"] + n["W1"]), n["e1"], n["e0"]) for n in t.values() if n["is_leaf"]]
        sc = spark.createDataFrame(rows, "g int, score double, pos long, neg long")
        sc = sc.groupBy("g", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        auc = MT.roc_auc_from_counts(sc, ["g"]).first()["roc_auc"]
        assert abs(auc - fs[(pid, 2)]) < 1e-12


def test_the_better_of_two_close_rows_wins(spark):
    """Scores differ by less than what a report shows."""
    params = S.expand_grid({"max_depth": [2, 3]})
    rows = [(p, f, 0.5, 0.9 + p * 4e-8, 0.5) for p in (0, 1) for f in range(5)]
    fs = spark.createDataFrame(rows, "param_id int, fold int, accuracy double, roc_auc double, average_precision double")
    res = S.summarize(spark, params, fs, "roc_auc")
    assert res.best_index == 1
    assert {r["param_id"]: r["rank_test_score"] for r in res.summary.collect()} == {0: 2, 1: 1}
