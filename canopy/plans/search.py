"""Grid search, cross-validation, nested CV, refit and reports.

A grid of P parameter rows over K folds is not P*K tree fits here:
  * one *growth* per (fold root, criterion, class weight, min_samples_leaf), grown once to
    the grid's largest depth (``tree.grow`` shares node paths between growths);
  * every (max_depth, min_samples_split, ccp_alpha) is derived from its growth on the
    node table (``prune.derive``, block by block);
  * fold scores come from the evaluation-row label counts of the derived leaves, so no
    scoring pass over the rows is needed; only refits that report per-row output score
    rows, with the tree as one column expression.
"""

from __future__ import annotations

import itertools
import json
from dataclasses import asdict, dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canopy.operators import metrics as MT
from canopy.operators import prune as PRN
from canopy.operators import tree as TR

# ---- fixed values: parameter grids of the two main strategies ----
GRID_HOLDOUT = {
    "max_depth": [3, 5, 8],
    "min_samples_leaf": [1, 2, 5],
    "min_samples_split": [2, 5, 10],
    "criterion": ["gini", "entropy"],
    "ccp_alpha": [5e-4, 1e-3, 2e-3],
    "class_weight": ["balanced", {0: 0.4, 1: 0.6}, {0: 0.3, 1: 0.7}, {0: 0.2, 1: 0.8}],
}
GRID_NESTED = {
    "max_depth": [3, 5, 7],
    "min_samples_leaf": [2, 5, 10],
    "min_samples_split": [2, 5, 10],
    "ccp_alpha": [0.0, 0.0001],
    "criterion": ["gini", "entropy"],
    "class_weight": [None, "balanced"],
}
GRID_BASE = {
    "max_depth": [5, 10, 15],
    "min_samples_leaf": [10, 30, 50],
    "criterion": ["gini", "entropy"],
    "ccp_alpha": [0.0, 0.001, 0.01],
    "class_weight": ["balanced"],
}
GRID_SMALL = {
    "max_depth": [3, 5],
    "min_samples_leaf": [5, 10],
    "min_samples_split": [10, 20],
    "criterion": ["gini", "entropy"],
    "ccp_alpha": [1e-3, 5e-3, 1e-2],
    "class_weight": ["balanced"],
}
GRID_CODED = {
    "max_depth": [3, 5, 7],
    "min_samples_leaf": [2, 5, 10],
    "min_samples_split": [5, 10, 20],
    "criterion": ["gini", "entropy"],
    "ccp_alpha": [1e-4, 5e-4, 1e-3],
    "class_weight": ["balanced"],
}
GRID_BASE_WIDE = {
    "max_depth": [5, 10, 15, None],
    "min_samples_leaf": [5, 10, 20, 50],
    "min_samples_split": [10, 20, 50, 100],
    "criterion": ["gini", "entropy"],
    "ccp_alpha": [0.0, 1e-4, 5e-4, 1e-3, 5e-3, 1e-2],
    "class_weight": ["balanced"],
}
GRID_DEEP = {
    "max_depth": [None, 3, 5, 8],
    "min_samples_leaf": [1, 2, 5, 10],
    "min_samples_split": [2, 5, 10, 20],
    "criterion": ["gini", "entropy"],
    "ccp_alpha": [0.0, 1e-5, 1e-4, 5e-4, 1e-3],
    "class_weight": ["balanced"],
}
GRID_NESTED_BASE = {**GRID_BASE_WIDE, "ccp_alpha": [0.0, 0.001, 0.01]}
BASELINE = {"max_depth": 10, "min_samples_leaf": 30}


@dataclass(frozen=True)
class Params:
    max_depth: int | None = None
    min_samples_leaf: int = 1
    min_samples_split: int = 2
    criterion: str = "gini"
    ccp_alpha: float = 0.0
    class_weight: object = None

    def growth_key(self):
        return (self.criterion, json.dumps(self.class_weight, sort_keys=True), self.min_samples_leaf)

    def variant_key(self):
        return (self.max_depth, self.min_samples_split, self.ccp_alpha)

    def label(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)


def expand_grid(grid: dict) -> list[Params]:
    """Grid rows in scikit-learn's ParameterGrid order (sorted names, last one fastest), so
    'first best row' ties resolve the same way."""
    names = sorted(grid)
    return [Params(**dict(zip(names, vals))) for vals in itertools.product(*[grid[n] for n in names])]


def _cw(cw):
    return {int(k): v for k, v in cw.items()} if isinstance(cw, dict) else cw


@dataclass
class SearchResult:
    params: list[Params]
    fold_scores: DataFrame        # (p, fold, accuracy, roc_auc, average_precision)
    summary: DataFrame            # (p, params, mean_*, rank_test_score)
    best: Params
    best_index: int


def evaluate_roots(df: DataFrame, features: list[str], label: str, roots: list[TR.Root],
                   params: list[Params], pairs: list[tuple[int, int]] | None = None,
                   keep: list[str] | None = None, nodes: bool = True):
    """Fit every (root, parameter row) pair (all pairs by default) through shared growths;
    returns (growth, leaves with p/root index, gid map).  Without ``nodes`` the growth is None: for
    callers that need no tree but the counts of the leaves."""
    pairs = pairs or [(ri, pi) for ri in range(len(roots)) for pi in range(len(params))]
    pairs = list(dict.fromkeys(pairs))  # a repeated pair would count its leaves twice
    gkeys: dict = {}
    vkeys: dict[tuple, int] = {}
    model_rows = []
    for ri, pi in pairs:
        p = params[pi]
        gk = (ri, p.growth_key())
        if gk not in gkeys:
            gkeys[gk] = len(gkeys)
        vk = p.variant_key()
        vkeys.setdefault(vk, len(vkeys))
        model_rows.append((gkeys[gk], vkeys[vk], pi, ri))
    # growth depth: the largest depth any pair of that growth asks for (None = unbounded)
    depth_of: dict[int, int | None] = {}
    for (gid, _vid, pi, _ri) in model_rows:
        d = params[pi].max_depth
        cur = depth_of.get(gid, 0)
        depth_of[gid] = None if (d is None or cur is None) else max(cur, d)
    grow_specs = []
    for (ri, gk), gid in gkeys.items():
        crit, cw, msl = gk
        grow_specs.append(TR.GrowSpec(gid, roots[ri].name, crit, _cw(json.loads(cw)), msl,
                                      depth_of[gid]))
    spark = df.sparkSession
    variants = [PRN.Variant(v, *vk) for vk, v in vkeys.items()]
    if nodes:
        growth = TR.grow(df, features, label, roots, grow_specs, keep=keep)
        leaves = PRN.derive(growth.table, variants, growth.depth, merged=True)
    else:
        growth = None
        leaves = PRN.derive_grown(df, features, label, roots, grow_specs, variants, keep)
    mapping = spark.createDataFrame(model_rows, "gid int, vid int, param_id int, root int")
    # mapping: (pairs) rows, bounded by grid size x roots
    leaves = leaves.join(mapping, ["gid", "vid"])
    return growth, leaves, {(r[2], r[3]): (r[0], r[1]) for r in model_rows}, variants


def scores_from_leaves(leaves: DataFrame, group: list[str]) -> DataFrame:
    sc = leaves.select(*group, F.col("prob").alias("score"), F.col("e1").alias("pos"),
                       F.col("e0").alias("neg"))
    sc = sc.groupBy(*group, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    acc = MT.accuracy_from_counts(
        leaves.select(*group, "pred", F.col("e1").alias("pos"), F.col("e0").alias("neg")), group)
    return (acc.join(MT.roc_auc_from_counts(sc, group), group)
            .join(MT.average_precision_from_counts(sc, group), group))


def grid_search(df: DataFrame, features: list[str], label: str, fold_col: str, folds: list[int],
                grid: dict, scoring: str = "roc_auc", where: str = "true",
                keep: list[str] | None = None) -> SearchResult:
    """GridSearchCV over ``folds`` of ``fold_col`` (rows outside ``where`` never train)."""
    params = expand_grid(grid)
    roots = [TR.Root(f"cv{f}", f"({where}) AND {fold_col} <> {f}", f"({where}) AND {fold_col} = {f}")
             for f in folds]
    _g, leaves, _m, _v = evaluate_roots(df, features, label, roots, params, keep=keep, nodes=False)
    fold_scores = scores_from_leaves(leaves, ["param_id", "root"]).withColumnRenamed("root", "fold")
    fold_scores = fold_scores.withColumn("fold", F.element_at(F.array(*[F.lit(f) for f in folds]),
                                                              F.col("fold") + 1))
    return summarize(df.sparkSession, params, fold_scores, scoring)


def summarize(spark, params: list[Params], fold_scores: DataFrame, scoring: str) -> SearchResult:
    fs = fold_scores.cache()
    means = fs.groupBy("param_id").agg(F.avg("accuracy").alias("mean_accuracy"), F.avg("roc_auc").alias("mean_roc_auc"),
                                       F.avg("average_precision").alias("mean_average_precision"),
                                       F.stddev_pop(scoring).alias("std_test_score"))
    means = means.withColumn("mean_test_score", F.col(f"mean_{scoring}"))
    labels = spark.createDataFrame([(i, p.label()) for i, p in enumerate(params)], "param_id int, params string")
    summary = means.join(labels, "param_id")
    # ranked on the scores as they are, to 12 digits: equal sums in another order must tie
    score = F.round(F.coalesce("mean_test_score", F.lit(float("-inf"))), 12)
    best_p = summary.agg(F.max_by("param_id", F.struct(score, -F.col("param_id"))).alias("best")).first()["best"]
    # the summary has one row per grid row (bounded by the grid), so a global rank is cheap
    ranked = summary.withColumn("rank_test_score", F.rank().over(Window.orderBy(F.desc(score))))
    return SearchResult(params, fs, ranked, params[best_p], best_p)


# --------------------------------------------------------------------------- refits
@dataclass
class Fitted:
    features: list[str]
    trees: dict[str, dict[int, dict]]          # root name -> derived node dict
    leaves: DataFrame                          # (p, root, leaf ..., e0, e1, prob, pred)
    roots: list[TR.Root]


def refit(df: DataFrame, features: list[str], label: str, roots: list[TR.Root],
          params: list[Params], keep: list[str] | None = None,
          pairs: list[tuple[int, int]] | None = None) -> Fitted:
    """Fit parameter rows on roots (train predicate) and report on their eval predicate.
    ``pairs`` = (root index, param index); default pairs root i with ``params[i]``.
    All pairs share ONE growth loop.  Trees are keyed by (root name, param index), and by
    root name alone when a root has one pair."""
    pairs = pairs or [(i, i) for i in range(len(roots))]
    growth, leaves, gid_map, variants = evaluate_roots(df, features, label, roots, params, pairs, keep)
    fetched = fetch(growth, gid_map, variants, [(pi, ri) for ri, pi in pairs])
    trees: dict = {}
    per_root: dict[str, int] = {}
    for ri, pi in pairs:
        t = fetched[(pi, ri)]
        trees[(roots[ri].name, pi)] = t
        per_root[roots[ri].name] = per_root.get(roots[ri].name, 0) + 1
        if per_root[roots[ri].name] == 1:
            trees[roots[ri].name] = t
        else:
            trees.pop(roots[ri].name, None)
    return Fitted(features, trees, leaves, roots)


def fetch(growth, gid_map: dict, variants: list, models: list[tuple[int, int]]) -> dict[tuple[int, int], dict]:
    """Node dicts of some (param, root) models, collected together; for trees of bounded size."""
    vmap = {v.vid: v for v in variants}
    deepest: dict[int, int | None] = {}
    for m in models:
        gid, vid = gid_map[m]
        d, cur = vmap[vid].max_depth, deepest.get(gid, 0)
        deepest[gid] = None if d is None or cur is None else max(cur, d)
    trees = growth.trees(deepest)
    return {m: PRN.derived_tree(trees[gid_map[m][0]], vmap[gid_map[m][1]]) for m in models}


def fitted_from(growth, leaves: DataFrame, gid_map: dict, variants: list, roots: list[TR.Root],
                root_idx: list[int], param_of: dict[int, int], features: list[str]) -> Fitted:
    """Pick already-grown trees out of a shared evaluation: root ``root_idx[i]`` with
    parameter row ``param_of[root_idx[i]]``; leaves are renumbered to roots 0..n-1."""
    fetched = fetch(growth, gid_map, variants, [(param_of[ri], ri) for ri in root_idx])
    trees, conds = {}, []
    for ri in root_idx:
        pi = param_of[ri]
        trees[roots[ri].name] = fetched[(pi, ri)]
        trees[(roots[ri].name, pi)] = trees[roots[ri].name]
        conds.append((F.col("root") == ri) & (F.col("param_id") == pi))
    cond = conds[0]
    for c in conds[1:]:
        cond = cond | c
    mapping = {ri: new for new, ri in enumerate(root_idx)}
    renum = F.lit(None).cast("int")
    for ri, new in mapping.items():
        renum = F.when(F.col("root") == ri, F.lit(new)).otherwise(renum)
    return Fitted(features, trees, leaves.where(cond).withColumn("root", renum),
                  [roots[ri] for ri in root_idx])


def report_from_leaves(leaves: DataFrame, group: list[str]) -> DataFrame:
    """E3 + E5 + E7 on evaluation counts of derived leaves."""
    c = leaves.groupBy(*group).agg(
        F.sum(F.when(F.col("pred") == 0, F.col("e0")).otherwise(0)).cast("long").alias("tn"),
        F.sum(F.when(F.col("pred") == 1, F.col("e0")).otherwise(0)).cast("long").alias("fp"),
        F.sum(F.when(F.col("pred") == 0, F.col("e1")).otherwise(0)).cast("long").alias("fn"),
        F.sum(F.when(F.col("pred") == 1, F.col("e1")).otherwise(0)).cast("long").alias("tp"))
    rep = MT.class_report_from_confusion(c, group)
    sc = scores_from_leaves(leaves, group).select(*group, "roc_auc", "average_precision")
    return rep.join(sc, group)


def predict_rows(df: DataFrame, fitted: Fitted, by: str | None = None,
                 which=None) -> DataFrame:
    """Score rows with one tree (``which`` = its key), or with the tree of each row's ``by``
    value (``which``: value -> tree key): a CASE over column expressions, no join, no UDF."""
    feats = fitted.features
    if by is None:
        tree = fitted.trees[which] if which is not None else fitted.trees[fitted.roots[0].name]
        prob = TR.predict_expr(tree, feats, "prob")
        pred = TR.predict_expr(tree, feats, "pred")
    else:
        prob, pred = F.lit(None).cast("double"), F.lit(None).cast("int")
        for val, name in which.items():
            prob = F.when(F.col(by) == val, TR.predict_expr(fitted.trees[name], feats, "prob")).otherwise(prob)
            pred = F.when(F.col(by) == val, TR.predict_expr(fitted.trees[name], feats, "pred")).otherwise(pred)
    return df.withColumn("prob", prob).withColumn("pred", pred.cast("int"))


def importances_table(tree: dict[int, dict], features: list[str], k: int | None = 10) -> pd.DataFrame:
    imp = TR.importances(tree, features).sort_values(["importance", "feature"], ascending=[False, True])
    return imp if k is None else imp.head(k)
