"""The reference's modelling entry points as Spark plans.

baseline   fixed tree (depth 10, leaf 30) on the base bundle: 5-fold CV scores, fit on all
           rows, importances; holdout fit scored on the test rows.
holdout    60/20/20 split, grid search with 5 shuffled folds on train, validation report
           of the refit on train, final refit on train+val, test report, importances.
nested     80/20 split, outer 5 x inner 3 stratified nested CV (refit inside each outer
           fold), final grid search with unshuffled stratified 5-fold on train+val,
           out-of-fold probabilities of the chosen model, test report.
Results are memoised per (session, data dir) so the queries that share a search run it once.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.functions import encode as E
from canopy.functions import features as FE
from canopy.operators import split as SP
from canopy.operators import tree as TR
from canopy.plans import search as S
from canopy.sources.survey import ID, TARGET, load_survey, survey_with_age_years

_MEMO: dict = {}


def _memo(spark: SparkSession, sf: str, name: str, fn):
    # keyed by the running application, so a new session never sees a stopped one's results
    key = (spark.sparkContext.applicationId, id(spark), sf, name)
    if key not in _MEMO:
        _MEMO[key] = fn()
    return _MEMO[key]


def release(spark: SparkSession) -> None:
    """Forget memoised strategies and the frames they persist (after input files changed, say)."""
    _MEMO.clear()
    spark.catalog.clearCache()


def model_input(df: DataFrame) -> DataFrame:
    """The rows every growth and refit of a strategy reads: persisted once
    (memory, spilling to disk), as iterative Spark ML fits do with their input.  Rows are ranked, split and held
    before the features are derived from them, which takes no exchange: features would be several times as wide."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def encoded_survey(spark: SparkSession, sf: str) -> tuple[DataFrame, dict]:
    survey = load_survey(spark, sf)
    fitted = E.fit_preprocess(survey)
    return E.preprocess(survey, "pp", fitted=fitted), fitted


def feature_names(df: DataFrame, drop: tuple[str, ...] = ()) -> list[str]:
    skip = {ID, TARGET, "split", "fold", "outer", "cfold", *drop}
    return [c for c in df.columns if c not in skip and not c.startswith("inner_") and not c.startswith("_")]


# --------------------------------------------------------------------------- baseline
@dataclass
class Baseline:
    data: DataFrame
    features: list[str]
    params: S.Params
    fitted: S.Fitted          # roots: cv0..cv4, all, holdout (one growth loop)

    @property
    def cv_scores(self) -> DataFrame:
        cv = self.fitted.leaves.where(F.col("root") < 5)
        return S.scores_from_leaves(cv, ["root"]).withColumnRenamed("root", "fold")


def baseline(spark: SparkSession, sf: str) -> Baseline:
    def run():
        rows = model_input(SP.kfold(SP.holdout_split(encoded_survey(spark, sf)[0], ID, TARGET, 0.2), ID, 5))
        data = FE.base(rows)
        feats = feature_names(data)
        params = S.Params(max_depth=S.BASELINE["max_depth"], min_samples_leaf=S.BASELINE["min_samples_leaf"])
        roots = ([TR.Root(f"cv{f}", f"fold <> {f}", f"fold = {f}") for f in range(5)]
                 + [TR.Root("all", "true"), TR.Root("holdout", "split = 'train'", "split = 'test'")])
        fitted = S.refit(data, feats, TARGET, roots, [params] * len(roots), keep=["fold", "split"])
        return Baseline(data, feats, params, fitted)
    return _memo(spark, sf, "baseline", run)


# --------------------------------------------------------------------------- holdout (A)
@dataclass
class Holdout:
    data: DataFrame
    features: list[str]
    search: S.SearchResult
    fitted: S.Fitted


def _held(df: DataFrame, held: list[DataFrame] | None) -> DataFrame:
    """Persisted, and noted for the caller to let go."""
    df = model_input(df)
    if held is not None:
        held.append(df)
    return df


def holdout_frame(spark: SparkSession, sf: str, held: list[DataFrame] | None = None) -> DataFrame:
    """``held`` gets the frames that are persisted on the way and not needed after the growth."""
    pp, fitted = encoded_survey(spark, sf)
    rows = _held(SP.three_way_split(_held(pp, held), ID, TARGET, 0.2, 0.25), held)
    train = SP.kfold(rows.where(F.col("split") == "train"), ID, 5)
    rest = rows.where(F.col("split") != "train").withColumn(
        "fold", F.when(F.col("split") == "val", 5).otherwise(6).cast("int"))
    return FE.banded4(_held(train.unionByName(rest), held), age_levels=fitted["age_groups"])


def holdout(spark: SparkSession, sf: str, grid: dict | None = None) -> Holdout:
    def run():
        held: list[DataFrame] = []
        data = holdout_frame(spark, sf, held)
        feats = feature_names(data)
        params = S.expand_grid(grid or S.GRID_HOLDOUT)
        # the 5 CV roots and, speculatively, the two refit roots for every growth key: the
        # refits then need no second growth loop (growths are shared by all grid rows)
        roots = ([TR.Root(f"cv{f}", f"(fold <= 4) AND fold <> {f}", f"(fold <= 4) AND fold = {f}")
                  for f in range(5)]
                 + [TR.Root("val", "fold <= 4", "fold = 5"), TR.Root("test", "fold <= 5", "fold = 6")])
        growth, leaves, gid_map, variants = S.evaluate_roots(data, feats, TARGET, roots, params, keep=["fold"])
        for f in held:
            f.unpersist()
        leaves = leaves.cache()
        fs = S.scores_from_leaves(leaves.where(F.col("root") < 5), ["param_id", "root"])
        res = S.summarize(spark, params, fs.withColumnRenamed("root", "fold"), "roc_auc")
        fitted = S.fitted_from(growth, leaves, gid_map, variants, roots, [5, 6],
                               {5: res.best_index, 6: res.best_index}, feats)
        return Holdout(data, feats, res, fitted)
    return _memo(spark, sf, "holdout", run)


# --------------------------------------------------------------------------- nested (B)
@dataclass
class Nested:
    data: DataFrame
    features: list[str]
    outer: DataFrame          # per outer fold: chosen params and outer-test scores
    final: S.SearchResult
    oof: S.Fitted
    test: S.Fitted


def nested_frame(spark: SparkSession, sf: str, k_outer: int = 5, k_inner: int = 3,
                 held: list[DataFrame] | None = None) -> DataFrame:
    """``held`` gets the frames that are persisted on the way; the last of them is what the features come from."""
    pp = _held(FE.preprocess_years(survey_with_age_years(load_survey(spark, sf))), held)
    rows = _held(SP.holdout_split(pp, ID, TARGET, 0.2), held)
    tv = SP.stratified_kfold(rows.where(F.col("split") == "train"), ID, TARGET, k_outer, keep_rank=True)
    tv = tv.withColumnRenamed("fold", "outer")
    tv = tv.withColumns({f"inner_{o}": SP.inner_fold(F.col(SP.RANK), F.lit(o), k_outer, k_inner)
                         for o in range(k_outer)})
    tv = tv.drop(SP.RANK, SP.N_CLASS)
    cont = SP.contiguous_kfold(tv.select(ID, TARGET), ID, TARGET, 5).withColumnRenamed("fold", "cfold")
    tv = tv.join(cont.select(ID, "cfold"), ID)
    test = rows.where(F.col("split") == "test").withColumns(
        {"outer": F.lit(-1), "cfold": F.lit(-1), **{f"inner_{o}": F.lit(-1) for o in range(k_outer)}})
    return FE.years(_held(tv.unionByName(test), held), FE.years_levels(pp))


def nested(spark: SparkSession, sf: str, grid: dict | None = None, k_outer: int = 5,
           k_inner: int = 3) -> Nested:
    def run():
        held: list[DataFrame] = []
        data = nested_frame(spark, sf, k_outer, k_inner, held)
        feats = feature_names(data)
        keep = ["outer", "cfold", "split"] + [f"inner_{o}" for o in range(k_outer)]
        params = S.expand_grid(grid or S.GRID_NESTED)
        # ONE growth loop for everything: every (outer, inner) root, every final-search fold,
        # and speculatively the outer refit roots and the test root for every growth key
        # (their parameter rows are only known after the inner search; growths are shared)
        roots = [TR.Root(f"o{o}i{i}", f"split = 'train' AND outer <> {o} AND inner_{o} <> {i}",
                         f"split = 'train' AND outer <> {o} AND inner_{o} = {i}")
                 for o in range(k_outer) for i in range(k_inner)]
        n_inner = len(roots)
        roots += [TR.Root(f"final{f}", f"split = 'train' AND cfold <> {f}", f"split = 'train' AND cfold = {f}")
                  for f in range(5)]
        n_search = len(roots)
        roots += [TR.Root(f"outer{o}", f"split = 'train' AND outer <> {o}", f"split = 'train' AND outer = {o}")
                  for o in range(k_outer)]
        roots += [TR.Root("test", "split = 'train'", "split = 'test'")]
        growth, leaves, gid_map, variants = S.evaluate_roots(data, feats, TARGET, roots, params, keep=keep)
        for f in held[:-1]:
            f.unpersist()
        leaves = leaves.cache()
        sc = S.scores_from_leaves(leaves.where(F.col("root") < n_search), ["param_id", "root"]).cache()
        inner = sc.where(F.col("root") < n_inner).withColumn("outer", (F.col("root") / k_inner).cast("int"))
        mean = inner.groupBy("outer", "param_id").agg(F.avg("roc_auc").alias("inner_auc"))
        order = F.struct(F.round(F.coalesce(F.col("inner_auc"), F.lit(float("-inf"))), 12), -F.col("param_id"))
        best = {r["outer"]: r["best"] for r in
                mean.groupBy("outer").agg(F.max_by("param_id", order).alias("best")).collect()}
        fs = (sc.where(F.col("root") >= n_inner).withColumn("fold", F.col("root") - n_inner).drop("root"))
        final = S.summarize(spark, params, fs, "roc_auc")
        fb = final.best_index
        outer_idx = list(range(n_search, n_search + k_outer))
        # inner winner refit on each outer training part, scored on the outer fold
        ofit = S.fitted_from(growth, leaves, gid_map, variants, roots, outer_idx,
                             {n_search + o: best[o] for o in range(k_outer)}, feats)
        osc = S.scores_from_leaves(ofit.leaves, ["root"]).withColumnRenamed("root", "outer")
        labels = spark.createDataFrame([(o, best[o], params[best[o]].label()) for o in range(k_outer)],
                                       "outer int, param_id int, params string")
        outer = osc.join(labels, "outer")
        # the final choice per outer fold (out-of-fold) and on train+val (test)
        oof = S.fitted_from(growth, leaves, gid_map, variants, roots, outer_idx,
                            {ri: fb for ri in outer_idx}, feats)
        oof.trees = {o: oof.trees[f"outer{o}"] for o in range(k_outer)}
        test = S.fitted_from(growth, leaves, gid_map, variants, roots, [len(roots) - 1],
                             {len(roots) - 1: fb}, feats)
        return Nested(data, feats, outer, final, oof, test)
    return _memo(spark, sf, "nested", run)


# --------------------------------------------------------------------------- tuned base tree
def tuned_base(spark: SparkSession, sf: str) -> S.SearchResult:
    """Grid search by accuracy on the base bundle of all rows, five shuffled folds."""
    def run():
        fe = FE.base(encoded_survey(spark, sf)[0])
        data = model_input(SP.kfold(fe, ID, 5))
        return S.grid_search(data, feature_names(data), TARGET, "fold", list(range(5)), S.GRID_BASE,
                             scoring="accuracy", keep=["fold"])
    return _memo(spark, sf, "tuned_base", run)


def _only(small: DataFrame, *large: DataFrame) -> DataFrame:
    """Keeps the winners' leaves and lets the frames they come from go."""
    small = small.persist(StorageLevel.MEMORY_AND_DISK)
    small.count()
    for f in large:
        f.unpersist()
    return small


@dataclass
class TunedHoldout:
    search: S.SearchResult
    leaves: DataFrame         # the winner's leaves: root 0 evaluated on val, 1 on test


#: name -> (features, grid, scoring): 60/20/20, five shuffled folds on the training part.
TUNED = {
    "base_wide": ("base", S.GRID_BASE_WIDE, "accuracy"),
    "base_deep": ("base", S.GRID_DEEP, "accuracy"),
    "banded3": ("banded3", S.GRID_DEEP, "roc_auc"),
}


def tuned_holdout(spark: SparkSession, sf: str, name: str) -> TunedHoldout:
    """Search on the training part, refit on it (val) and on train + val (test), in one growth loop."""
    def run():
        bundle, grid, scoring = TUNED[name]
        pp, fitted = encoded_survey(spark, sf)
        fe = FE.base(pp) if bundle == "base" else FE.banded3(pp, age_levels=fitted["age_groups"])
        fe = SP.three_way_split(fe, ID, TARGET, 0.2, 0.25)
        train = SP.kfold(fe.where(F.col("split") == "train"), ID, 5)
        rest = fe.where(F.col("split") != "train").withColumn("fold", F.when(F.col("split") == "val", 5).otherwise(6).cast("int"))
        data = model_input(train.unionByName(rest))
        feats, params = feature_names(data), S.expand_grid(grid)
        roots = [TR.Root(f"cv{f}", f"(fold <= 4) AND fold <> {f}", f"(fold <= 4) AND fold = {f}") for f in range(5)]
        roots += [TR.Root("val", "fold <= 4", "fold = 5"), TR.Root("test", "fold <= 5", "fold = 6")]
        _g, leaves, _m, _v = S.evaluate_roots(data, feats, TARGET, roots, params, keep=["fold"], nodes=False)
        leaves = leaves.cache()
        fs = S.scores_from_leaves(leaves.where(F.col("root") < 5), ["param_id", "root"]).withColumnRenamed("root", "fold")
        res = S.summarize(spark, params, fs, scoring)
        best = leaves.where((F.col("root") >= 5) & (F.col("param_id") == res.best_index)).withColumn("root", F.col("root") - 5)
        return TunedHoldout(res, _only(best, leaves, data))
    return _memo(spark, sf, f"tuned_{name}", run)


# --------------------------------------------------------------------------- nested on all rows
@dataclass
class AllRowsNested:
    outer: DataFrame          # per outer fold: the inner winner and its outer scores
    oof: DataFrame            # leaves of the winners, evaluation counts on their outer folds
    final: S.SearchResult     # the same grid searched on all rows


def nested_all_rows(spark: SparkSession, sf: str, name: str, k: int = 5) -> AllRowsNested:
    """All rows, shuffled 5 x 5 (stratified but for ``base``): every outer fold is predicted by the winner of the
    search inside its training part.  The final search uses the outer folds, whose growths are
    also the refits of the winners, so one growth loop serves all."""
    def frame() -> tuple[DataFrame, dict, str]:
        if name == "base":
            return FE.base(encoded_survey(spark, sf)[0]), S.GRID_NESTED_BASE, "accuracy"
        if name == "banded4":
            pp, fitted = encoded_survey(spark, sf)
            return FE.banded4(pp, age_levels=fitted["age_groups"]), S.GRID_SMALL, "accuracy"
        return FE.coded(FE.preprocess_coded(load_survey(spark, sf)), on_unknown="null"), S.GRID_CODED, "roc_auc"

    def run():
        fe, grid, scoring = frame()
        d = SP.hash_rank(fe, ID, None if name == "base" else TARGET)
        d = d.withColumn("outer", ((F.col(SP.RANK) - 1) % k).cast("int"))
        d = d.withColumns({f"inner_{o}": SP.inner_fold(F.col(SP.RANK), F.lit(o), k, k) for o in range(k)})
        data = model_input(d.drop(SP.RANK, SP.N_CLASS))
        feats, params = feature_names(data), S.expand_grid(grid)
        roots = [TR.Root(f"o{o}i{i}", f"outer <> {o} AND inner_{o} <> {i}", f"outer <> {o} AND inner_{o} = {i}")
                 for o in range(k) for i in range(k)]
        roots += [TR.Root(f"outer{o}", f"outer <> {o}", f"outer = {o}") for o in range(k)]
        _g, leaves, _m, _v = S.evaluate_roots(data, feats, TARGET, roots, params,
                                              keep=["outer"] + [f"inner_{o}" for o in range(k)], nodes=False)
        leaves = leaves.cache()
        sc = S.scores_from_leaves(leaves, ["param_id", "root"]).cache()
        inner = sc.where(F.col("root") < k * k).withColumn("outer", (F.col("root") / k).cast("int"))
        mean = inner.groupBy("outer", "param_id").agg(F.avg(scoring).alias("s"))
        order = F.struct(F.round(F.coalesce("s", F.lit(float("-inf"))), 12), -F.col("param_id"))
        best = {r["outer"]: r["best"] for r in mean.groupBy("outer").agg(F.max_by("param_id", order).alias("best")).collect()}
        won = spark.createDataFrame([(k * k + o, o, p, params[p].label()) for o, p in best.items()],
                                    "root int, outer int, param_id int, params string")
        final = S.summarize(spark, params, sc.where(F.col("root") >= k * k).withColumn("fold", F.col("root") - k * k).drop("root"), scoring)
        oof = _only(leaves.join(won.select("root", "param_id"), ["root", "param_id"]), leaves, data)
        return AllRowsNested(sc.join(won, ["root", "param_id"]), oof, final)
    return _memo(spark, sf, f"nested_{name}", run)


def node_frame(spark: SparkSession, tree: dict[int, dict], features: list[str]) -> DataFrame:
    rows = []
    for i in sorted(tree):
        n = tree[i]
        leaf = bool(n["is_leaf"]) or (2 * i) not in tree
        w = n["W0"] + n["W1"]
        rows.append((int(i), int(n["depth"]), None if leaf else features[int(n["feature"])],
                     None if leaf else round(float(n["threshold"]), 6), int(n["t0"] + n["t1"]),
                     int(n["t0"]), int(n["t1"]), round(float(n["impurity"]), 6), leaf,
                     round(n["W1"] / w, 6) if w > 0 else None))
    return spark.createDataFrame(pd.DataFrame(rows, columns=[
        "node", "depth", "feature", "threshold", "n_samples", "n_class0", "n_class1", "impurity",
        "is_leaf", "prob"]))
