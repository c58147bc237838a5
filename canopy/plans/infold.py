"""Preprocessing and features fitted inside every fold.

The reference's feature step is stateless and sees all rows; here the medians and thresholds of
fold f come from the rows outside f alone, so no row has a part in the features it is scored with.

* Answers collapse to cells (fold, codes, count) in one aggregation.  A cell counts in the training
  part of every other fold, so ONE grouped quantile job over cells fits a step of all folds.
* Every row is emitted once per fold, with the medians and thresholds of that fold chosen by a CASE
  on ``fit_fold``.  Growth turns these rows into cells before its first exchange.
* A fold is a root of the common growth loop, as in the searches whose features are fitted once.

Level vocabularies (dummy names) are common to all folds: a level that a training part lacks is a
column of zeros there and is never split on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.functions import encode as E
from canopy.functions import features as FE
from canopy.operators import quantiles as Q
from canopy.operators import split as SP
from canopy.operators import tree as TR
from canopy.plans import search as S
from canopy.plans import strategies as ST
from canopy.sources.survey import ID, TARGET, load_survey

FIT = "fit_fold"
#: The untuned tree: no depth limit, balanced classes.
UNTUNED = S.Params(class_weight="balanced")


def of_fold(fits: list[dict]) -> dict[str, Column]:
    """Per name, the value fitted for the row's ``fit_fold``."""
    out = {}
    for name in fits[0]:
        c = F.lit(None).cast("double")
        for f, fit in enumerate(fits):
            c = F.when(F.col(FIT) == f, F.lit(fit[name]).cast("double")).otherwise(c)
        out[name] = c
    return out


def in_training_parts(cells: DataFrame, k: int) -> DataFrame:
    """Cells once per fold whose training part holds them."""
    return cells.withColumn(FIT, F.explode(F.array(*map(F.lit, range(k))))).where(F.col(FIT) != F.col("fold"))


def fit_folds(folded: DataFrame, k: int) -> tuple[list[dict], list[dict]]:
    """Medians of the ordinal answers and thresholds of the base bundle, per fold.  Two grouped
    quantile fits over cells; a row per fold and fitted column comes to the driver.  A fold that no training row is left for
    has NULL medians and thresholds."""
    cols = E.ORDINAL_COLUMNS
    codes = folded.select("fold", *[E.ordinal_code(c, E.ORDINAL_MAPS[c]).cast("double").alias(c) for c in cols])
    cells = in_training_parts(codes.groupBy("fold", *cols).agg(F.count(F.lit(1)).alias("n")), k)
    n = F.col("n")
    got = Q.fit_quantiles(cells, {c: F.col(c) for c in cols}, [0.5], FIT, n)
    medians = [{c: got[f][c][0] if f in got else None for c in cols} for f in range(k)]
    fits = FE.base_fits(E.impute(cells, of_fold(medians)), FIT, n)
    return medians, [FE.base_thresholds(fits.get(f)) for f in range(k)]


def infold_frame(survey: DataFrame, k: int = 5) -> DataFrame:
    """The base bundle of every row once per fold, encoded with what that fold's training part gives."""
    folded = SP.kfold(survey, ID, k)
    medians, thresholds = fit_folds(folded, k)
    levels = E.fit_levels(survey, [*E.NOMINAL_COLUMNS, TARGET])
    each = folded.withColumn(FIT, F.explode(F.array(*map(F.lit, range(k)))))
    return FE.base(E.preprocess(each, fitted={"medians": of_fold(medians), "levels": levels}), of_fold(thresholds))


@dataclass
class InFold:
    search: S.SearchResult    # GRID_BASE by accuracy
    untuned: DataFrame        # leaves of the untuned tree, evaluated on the fold left out (root)


def in_fold(spark: SparkSession, sf: str, k: int = 5) -> InFold:
    """Grid search and untuned cross-validation of features + tree, in one growth loop."""
    def run():
        data = ST.model_input(infold_frame(load_survey(spark, sf), k))
        feats = ST.feature_names(data, drop=(FIT,))
        grid = S.expand_grid(S.GRID_BASE)
        roots = [TR.Root(f"cv{f}", f"{FIT} = {f} AND fold <> {f}", f"{FIT} = {f} AND fold = {f}") for f in range(k)]
        _g, leaves, _m, _v = S.evaluate_roots(data, feats, TARGET, roots, [*grid, UNTUNED], keep=[FIT, "fold"], nodes=False)
        leaves = leaves.cache()
        tuned = leaves.where(F.col("param_id") < len(grid))
        scores = S.scores_from_leaves(tuned, ["param_id", "root"]).withColumnRenamed("root", "fold")
        res = S.summarize(spark, grid, scores, "accuracy")
        return InFold(res, ST._only(leaves.where(F.col("param_id") == len(grid)), leaves, data))
    return ST._memo(spark, sf, "in_fold", run)
