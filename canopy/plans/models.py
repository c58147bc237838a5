"""Registered model queries (trees, search, reports) and SQL for the root-split tables.

The root-split tables are plain aggregation + window; growth, pruning and scoring of the
baseline trees have SQL that unrolls the levels (``tree_oracle``), searches included.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.functions import encode as E
from canopy.operators import metrics as MT
from canopy.operators import prune as PRN
from canopy.operators import split as SP
from canopy.operators import tree as TR
from canopy.plans import infold as INF
from canopy.plans import oracle as O
from canopy.plans import search as S
from canopy.plans import strategies as ST
from canopy.plans import survey_model as SM
from canopy.plans.tree_oracle import tree_oracle_sql
from canopy.session import ensure_checkpoint_dir
from canopy.sources import model_io as IO
from canopy.sources import sinks as SK
from canopy.sources.survey import ID, SURVEY_SCHEMA, TARGET, load_survey, read_survey_csv


def _pp(spark, sf):
    return E.preprocess(load_survey(spark, sf))


def _pp_features(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (ID, TARGET)]


# --------------------------------------------------------------------------- root splits
def q_root_split_gini(spark: SparkSession, sf: str) -> DataFrame:
    pp = _pp(spark, sf)
    return TR.root_splits(pp, _pp_features(pp), TARGET, "gini", None, 1)


def q_root_split_entropy(spark: SparkSession, sf: str) -> DataFrame:
    pp = _pp(spark, sf)
    return TR.root_splits(pp, _pp_features(pp), TARGET, "entropy", "balanced", 1)


def _sql_root_split(criterion: str, balanced: bool) -> str:
    feats = [c for c in O.PP_COLS if c not in ("respondent_id", "Coping_Struggles")]
    lng = ("lng AS (SELECT * FROM " + O._unpivot("pp", ["Coping_Struggles"], feats, "feature", "v") + ")")
    h = ("h AS (SELECT feature, v, CAST(sum(CASE WHEN Coping_Struggles = 0 THEN 1 ELSE 0 END) AS BIGINT) AS c0, "
         "CAST(sum(CASE WHEN Coping_Struggles = 1 THEN 1 ELSE 0 END) AS BIGINT) AS c1 FROM lng GROUP BY feature, v)")
    tot = ("tot AS (SELECT CAST(sum(CASE WHEN Coping_Struggles = 0 THEN 1 ELSE 0 END) AS BIGINT) AS T0, "
           "CAST(sum(CASE WHEN Coping_Struggles = 1 THEN 1 ELSE 0 END) AS BIGINT) AS T1 FROM pp)")
    if balanced:
        w = "wt AS (SELECT T0, T1, CAST(T0 + T1 AS DOUBLE) / (2 * T0) AS w0, CAST(T0 + T1 AS DOUBLE) / (2 * T1) AS w1 FROM tot)"
    else:
        w = "wt AS (SELECT T0, T1, CAST(1 AS DOUBLE) AS w0, CAST(1 AS DOUBLE) AS w1 FROM tot)"
    cum = ("cum AS (SELECT feature, v, lead(v) OVER (PARTITION BY feature ORDER BY v) AS v_next, "
           "sum(c0) OVER (PARTITION BY feature ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l0, "
           "sum(c1) OVER (PARTITION BY feature ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l1 "
           "FROM h)")
    side = ("side AS (SELECT feature, v, v_next, l0, l1, T0 - l0 AS r0, T1 - l1 AS r1, "
            "w0 * l0 AS a0, w1 * l1 AS a1, w0 * (T0 - l0) AS b0, w1 * (T1 - l1) AS b1, "
            "w0 * T0 AS n0, w1 * T1 AS n1 FROM cum CROSS JOIN wt WHERE v_next IS NOT NULL)")

    def imp(a: str, b: str) -> str:
        p, q = f"({a} / ({a} + {b}))", f"({b} / ({a} + {b}))"
        if criterion == "gini":
            return f"(CASE WHEN {a} + {b} <= 0 THEN 0.0 ELSE 1.0 - {p} * {p} - {q} * {q} END)"
        return (f"(CASE WHEN {a} + {b} <= 0 THEN 0.0 ELSE -((CASE WHEN {p} > 0 THEN {p} * log2({p}) ELSE 0 END) "
                f"+ (CASE WHEN {q} > 0 THEN {q} * log2({q}) ELSE 0 END)) END)")

    imps = (f"imps AS (SELECT *, {imp('a0', 'a1')} AS il, {imp('b0', 'b1')} AS ir, {imp('n0', 'n1')} AS inode "
            "FROM side)")
    return (O.with_ctes(*O.BASE_PREFIX, lng, h, tot, w, cum, side, imps)
            + "SELECT feature, round(CASE WHEN (v + v_next) / 2.0 = v_next THEN v ELSE (v + v_next) / 2.0 END, 6) "
              "AS threshold, CAST(l0 + l1 AS BIGINT) AS n_left, CAST(r0 + r1 AS BIGINT) AS n_right, "
              "round(il, 6) AS impurity_left, round(ir, 6) AS impurity_right, "
              "round(((n0 + n1) * inode - (a0 + a1) * il - (b0 + b1) * ir) / (n0 + n1), 6) AS gain FROM imps")


# --------------------------------------------------------------------------- baseline tree
def q_tree_nodes(spark, sf):
    b = ST.baseline(spark, sf)
    return ST.node_frame(spark, b.fitted.trees["all"], b.features)


def q_tree_importances(spark, sf):
    b = ST.baseline(spark, sf)
    imp = S.importances_table(b.fitted.trees["all"], b.features, 10).reset_index(drop=True)
    imp["rank"] = range(1, len(imp) + 1)
    return spark.createDataFrame(imp[["rank", "feature", "importance"]].round({"importance": 6}))


def q_cv_scores(spark, sf):
    b = ST.baseline(spark, sf)
    fs = b.cv_scores
    return _with_mean_row(fs.select(F.col("fold").cast("int").alias("fold"), *METRIC_COLS), "fold")


def q_tree_predict(spark, sf):
    b = ST.baseline(spark, sf)
    test = b.data.where(F.col("split") == "test")
    out = S.predict_rows(test, b.fitted, which="holdout")
    return MT.rounded(out.select(ID, "split", F.col(TARGET).alias("y"), "prob", "pred"))


def q_tree_pruned(spark, sf):
    b = ST.baseline(spark, sf)
    pruned = PRN.derived_tree(b.fitted.trees["all"], PRN.Variant(0, None, 2, 0.001))
    return ST.node_frame(spark, pruned, b.features)


def q_model_roundtrip(spark, sf):
    """S6 + S7: save the holdout tree to shared storage, load it, score the test rows."""
    b = ST.baseline(spark, sf)
    path = ensure_checkpoint_dir(spark).rstrip("/") + f"/models/baseline-{uuid.uuid4().hex}"
    IO.save_tree(spark, b.fitted.trees["holdout"], b.features, path)
    tree, feats = IO.load_tree(spark, path)
    test = b.data.where(F.col("split") == "test")
    return test.select(ID, F.col(TARGET).alias("y"),
                       F.round(TR.predict_expr(tree, feats, "prob"), 6).alias("prob"),
                       TR.predict_expr(tree, feats, "pred").cast("int").alias("pred"))


# --------------------------------------------------------------------------- holdout strategy
def q_grid_search(spark, sf):
    return MT.rounded(ST.holdout(spark, sf).search.summary)


METRIC_COLS = ("accuracy", "roc_auc", "average_precision")


def _with_mean_row(df: DataFrame, key: str, extra: dict | None = None) -> DataFrame:
    """The per-fold rows plus their mean under key -1."""
    mean = df.agg(F.lit(-1).cast("int").alias(key), *[F.avg(c).alias(c) for c in METRIC_COLS],
                  *[F.lit(v).alias(k) for k, v in (extra or {}).items()])
    return MT.rounded(df.unionByName(mean.select(*df.columns)))


def q_best_cv_scores(spark, sf):
    h = ST.holdout(spark, sf)
    fs = h.search.fold_scores.where(F.col("param_id") == h.search.best_index)
    return _with_mean_row(fs.select(F.col("fold").cast("int").alias("fold"), *METRIC_COLS), "fold")


def q_final_test_report(spark, sf):
    h = ST.holdout(spark, sf)
    rep = S.report_from_leaves(h.fitted.leaves, ["root"])
    name = F.element_at(F.array(F.lit("val"), F.lit("test")), F.col("root") + 1)
    return MT.rounded(rep.withColumn("split", name).drop("root"))


def q_final_train_report(spark, sf):
    """E8 overfit check: the final model's report on its own training rows (train + val),
    from the training label counts of its leaves."""
    h = ST.holdout(spark, sf)
    train = h.fitted.leaves.where(F.col("root") == 1).drop("e0", "e1").withColumnRenamed(
        "t0", "e0").withColumnRenamed("t1", "e1")
    return MT.rounded(S.report_from_leaves(train, ["root"]).withColumn("split", F.lit("train+val")).drop("root"))


def q_final_importances(spark, sf):
    h = ST.holdout(spark, sf)
    imp = S.importances_table(h.fitted.trees["test"], h.features, 10).reset_index(drop=True)
    imp["rank"] = range(1, len(imp) + 1)
    return spark.createDataFrame(imp[["rank", "feature", "importance"]].round({"importance": 6}))


# --------------------------------------------------------------------------- nested strategy
def q_nested_cv(spark, sf):
    outer = ST.nested(spark, sf).outer
    outer = outer.select(F.col("outer").cast("int").alias("outer"), *METRIC_COLS, "param_id", "params")
    return _with_mean_row(outer, "outer", {"param_id": None, "params": None})


def q_oof_predictions(spark, sf):
    n = ST.nested(spark, sf)
    tv = n.data.where(F.col("split") == "train")
    out = S.predict_rows(tv, n.oof, by="outer", which={o: o for o in range(5)})
    return MT.rounded(out.select(ID, F.col("outer").alias("fold"), F.col(TARGET).alias("y"), "prob", "pred"))


def q_nested_test_report(spark, sf):
    n = ST.nested(spark, sf)
    return MT.rounded(S.report_from_leaves(n.test.leaves, ["root"]).drop("root"))


# --------------------------------------------------------------------------- further searches
def q_search_base(spark, sf):
    return MT.rounded(ST.tuned_base(spark, sf).summary)


def _nested_all(name: str):
    def outer(spark, sf):
        t = ST.nested_all_rows(spark, sf, name).outer
        t = t.select(F.col("outer").cast("int").alias("outer"), *METRIC_COLS, F.col("param_id").cast("int").alias("param_id"), "params")
        return _with_mean_row(t, "outer", {"param_id": None, "params": None})

    def report(spark, sf):
        oof = ST.nested_all_rows(spark, sf, name).oof.withColumn("split", F.lit("oof"))
        return MT.rounded(S.report_from_leaves(oof, ["split"]))

    def final(spark, sf):
        return MT.rounded(ST.nested_all_rows(spark, sf, name).final.summary)

    return {f"nested_{name}": outer, f"oof_report_{name}": report, f"search_{name if name != 'base' else 'base_nested'}": final}


def _tuned(name: str):
    def search(spark, sf):
        return MT.rounded(ST.tuned_holdout(spark, sf, name).search.summary)

    def report(spark, sf):
        rep = S.report_from_leaves(ST.tuned_holdout(spark, sf, name).leaves, ["root"])
        return MT.rounded(rep.withColumn("split", F.when(F.col("root") == 0, "val").otherwise("test")).drop("root"))

    return {f"search_{name}": search, f"report_{name}": report}


# --------------------------------------------------------------------------- fitted models
def _model_leaves(spark, sf) -> DataFrame:
    """(strategy, split, prob, pred, e0, e1): evaluation counts of the fitted trees' leaves; the
    out-of-fold rows of the nested strategy are pooled over its five trees."""
    b, h, n = ST.baseline(spark, sf), ST.holdout(spark, sf), ST.nested(spark, sf)
    cols = ["prob", "pred", "e0", "e1"]
    hold = [r.name for r in b.fitted.roots].index("holdout")
    parts = [("baseline", "test", b.fitted.leaves.where(F.col("root") == hold)),
             ("holdout", "val", h.fitted.leaves.where("root = 0")), ("holdout", "test", h.fitted.leaves.where("root = 1")),
             ("nested", "oof", n.oof.leaves), ("nested", "test", n.test.leaves)]
    out = None
    for strategy, split, leaves in parts:
        p = leaves.select(F.lit(strategy).alias("strategy"), F.lit(split).alias("split"), *cols)
        out = p if out is None else out.unionByName(p)
    return out


MODEL_KEYS = ["strategy", "split"]


def _model_counts(spark, sf) -> DataFrame:
    return _model_leaves(spark, sf).groupBy(*MODEL_KEYS, F.col("prob").alias("score")).agg(
        F.sum("e1").alias("pos"), F.sum("e0").alias("neg"))


def q_model_roc_curve(spark, sf):
    return MT.rounded(MT.roc_curve_from_counts(_model_counts(spark, sf), MODEL_KEYS))


def q_model_pr_curve(spark, sf):
    return MT.rounded(MT.pr_curve_from_counts(_model_counts(spark, sf), MODEL_KEYS))


def q_model_confusion(spark, sf):
    count = lambda c, p: F.sum(F.when(F.col("pred") == p, F.col(c)).otherwise(0)).cast("long")
    c = _model_leaves(spark, sf).groupBy(*MODEL_KEYS).agg(
        count("e0", 0).alias("tn"), count("e0", 1).alias("fp"), count("e1", 0).alias("fn"), count("e1", 1).alias("tp"))
    return c.selectExpr(*MODEL_KEYS, "stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) as (y, pred, n)")


# --------------------------------------------------------------------------- features fitted in the fold
def q_search_base_infold(spark, sf):
    return MT.rounded(INF.in_fold(spark, sf).search.summary)


def q_cv_untuned_infold(spark, sf):
    fs = S.scores_from_leaves(INF.in_fold(spark, sf).untuned, ["root"])
    return _with_mean_row(fs.select(F.col("root").cast("int").alias("fold"), *METRIC_COLS), "fold")


def q_oof_report_untuned(spark, sf):
    leaves = INF.in_fold(spark, sf).untuned.withColumn("split", F.lit("oof"))
    return MT.rounded(S.report_from_leaves(leaves, ["split"]))


# --------------------------------------------------------------------------- saved model
def _scored_raw(spark, sf) -> DataFrame:
    """Raw test answers, read from CSV and scored by a model that was fitted on the training part,
    saved and loaded."""
    def run():
        base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models/survey-{uuid.uuid4().hex}"
        parts = SP.holdout_split(load_survey(spark, sf), ID, TARGET, 0.2)
        train = parts.where(F.col("split") == "train").drop("split")
        SK.write_csv(parts.where(F.col("split") == "test").drop("split"), f"{base}/answers")
        SM.fit(train, S.Params(**S.BASELINE)).save(spark, f"{base}/model")
        return base
    base = ST._memo(spark, sf, "saved_model", run)
    raw = read_survey_csv(spark, f"{base}/answers", SURVEY_SCHEMA)
    return SM.load(spark, f"{base}/model").score(raw)


def q_score_saved_model(spark, sf):
    return MT.rounded(_scored_raw(spark, sf).select(ID, F.col(TARGET).alias("y"), "prob", "pred"))


def q_saved_model_report(spark, sf):
    """Class report, ROC-AUC and average precision of the saved model on the raw test answers."""
    n = lambda y: F.sum((F.col(TARGET) == y).cast("long"))
    leaves = _scored_raw(spark, sf).groupBy(F.lit("test").alias("split"), "prob", "pred").agg(n(0).alias("e0"), n(1).alias("e1"))
    return MT.rounded(S.report_from_leaves(leaves, ["split"]))


# --------------------------------------------------------------------------- streaming
def q_stream_scores(spark, sf):
    """Batch-fit the encoder and a depth-5 tree, then score the order stream with them
    (stream-static join, Parquet sink with checkpoint on shared storage)."""
    from canopy.functions import features as FE
    from canopy.streaming import score as SS

    batch = load_survey(spark, sf)
    fitted = SS.fitted_encoder(batch)
    feats_df = FE.banded4(SS.encode_with(batch, fitted))
    age_levels = [c[len("Age_Group_"):] for c in feats_df.columns if c.startswith("Age_Group_")]
    feats = ST.feature_names(feats_df)
    fit = S.refit(feats_df, feats, TARGET, [TR.Root("all", "true")], [S.Params(max_depth=5)])
    scored = SS.score_stream(SS.survey_stream(spark, sf), fit.trees["all"], feats, fitted, age_levels)
    return spark.read.parquet(SS.run_to_parquet(scored))


MODEL_QUERIES = {
    "root_split_gini": q_root_split_gini,
    "root_split_entropy": q_root_split_entropy,
    "tree_nodes": q_tree_nodes,
    "tree_importances": q_tree_importances,
    "cv_scores": q_cv_scores,
    "tree_predict": q_tree_predict,
    "tree_pruned": q_tree_pruned,
    "model_roundtrip": q_model_roundtrip,
    "grid_search": q_grid_search,
    "best_cv_scores": q_best_cv_scores,
    "final_test_report": q_final_test_report,
    "final_importances": q_final_importances,
    "final_train_report": q_final_train_report,
    "nested_cv": q_nested_cv,
    "oof_predictions": q_oof_predictions,
    "nested_test_report": q_nested_test_report,
    "search_base": q_search_base,
    **_nested_all("banded4"),
    **_nested_all("coded"),
    **_nested_all("base"),
    **{k: v for n in ST.TUNED for k, v in _tuned(n).items()},
    "search_base_infold": q_search_base_infold,
    "cv_untuned_infold": q_cv_untuned_infold,
    "oof_report_untuned": q_oof_report_untuned,
    "score_saved_model": q_score_saved_model,
    "saved_model_report": q_saved_model_report,
    "model_roc_curve": q_model_roc_curve,
    "model_pr_curve": q_model_pr_curve,
    "model_confusion": q_model_confusion,
    "stream_scores": q_stream_scores,
}
MODEL_ORACLE_SQL = {
    "root_split_gini": _sql_root_split("gini", False),
    "root_split_entropy": _sql_root_split("entropy", True),
    **tree_oracle_sql(),
}
