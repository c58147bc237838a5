"""Invariants of the three modelling strategies on the smallest tables."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from canopy.plans import strategies as ST
from tests.conftest import SF0001


def test_baseline_invariants(spark, have_data):
    q = entry.queries()
    nodes = q["tree_nodes"](spark, SF0001).collect()
    b = ST.baseline(spark, SF0001)
    n_all = b.data.count()
    root = [r for r in nodes if r["node"] == 1][0]
    assert root["n_samples"] == n_all
    leaves = [r for r in nodes if r["is_leaf"]]
    assert sum(r["n_samples"] for r in leaves) == n_all
    assert all(r["n_samples"] >= 30 for r in leaves)            # min_samples_leaf
    assert max(r["depth"] for r in nodes) <= 10                  # max_depth
    n_test = b.data.where(F.col("split") == "test").count()
    assert q["tree_predict"](spark, SF0001).count() == n_test
    pruned = q["tree_pruned"](spark, SF0001).collect()
    assert sum(1 for r in pruned if r["is_leaf"]) <= len(leaves)
    imp = q["tree_importances"](spark, SF0001).collect()
    assert len(imp) <= 10 and all(0 <= r["importance"] <= 1 for r in imp)
    cv = q["cv_scores"](spark, SF0001).collect()
    assert sorted(r["fold"] for r in cv) == [-1, 0, 1, 2, 3, 4]


def test_holdout_invariants(spark, have_data):
    q = entry.queries()
    h = ST.holdout(spark, SF0001)
    grid = q["grid_search"](spark, SF0001)
    assert grid.count() == len(h.search.params)
    assert grid.where(F.col("param_id") == h.search.best_index).first()["rank_test_score"] == 1
    rep = q["final_test_report"](spark, SF0001).collect()
    support = {r["split"]: r["support"] for r in rep if r["label"] == "accuracy"}
    n_val = h.data.where(F.col("fold") == 5).count()
    n_test = h.data.where(F.col("fold") == 6).count()
    assert support == {"val": n_val, "test": n_test}
    train = q["final_train_report"](spark, SF0001).collect()
    assert [r["support"] for r in train if r["label"] == "accuracy"] == [n_val + h.data.where("fold <= 4").count()]


def test_nested_invariants(spark, have_data):
    q = entry.queries()
    n = ST.nested(spark, SF0001)
    outer = q["nested_cv"](spark, SF0001).collect()
    assert sorted(r["outer"] for r in outer) == [-1, 0, 1, 2, 3, 4]
    oof = q["oof_predictions"](spark, SF0001)
    tv = n.data.where(F.col("split") == "train")
    assert oof.count() == tv.count() and oof.select("respondent_id").distinct().count() == tv.count()
    # inner folds partition each outer training part into 3 near-equal blocks per class
    for o in range(5):
        part = tv.where(F.col("outer") != o).groupBy("Coping_Struggles", f"inner_{o}").count().collect()
        by_class = {}
        for r in part:
            by_class.setdefault(r["Coping_Struggles"], []).append(r["count"])
        assert all(max(v) - min(v) <= 1 and len(v) == 3 for v in by_class.values())
    rep = q["nested_test_report"](spark, SF0001).collect()
    n_test = n.data.where(F.col("split") == "test").count()
    assert [r["support"] for r in rep if r["label"] == "accuracy"] == [n_test]


def test_features_are_not_persisted(spark, monkeypatch):
    """Fails when a strategy persists its features, three times over in the nested one, as it did."""
    kept = []
    persist = type(spark.range(1)).persist
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda self, *a: kept.append(self) or persist(self, *a))
    held = []
    for frame in (ST.holdout_frame(spark, SF0001, held), ST.nested_frame(spark, SF0001, held=held)):
        assert len(frame.columns) > 35
    assert kept and all(len(f.columns) < 30 for f in kept) and [id(f) for f in held] == [id(f) for f in kept]
    for f in held:
        f.unpersist()
