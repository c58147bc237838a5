"""Binary classification metrics as tables.

Input: a scored table with group keys (e.g. model, fold), ``y`` (0/1), ``prob`` and
``pred``.  Everything is computed from small per-group aggregates:
  * confusion counts: one aggregation per group (4 sums), unpivoted;
  * curves, ROC-AUC, average precision: counts per (group, distinct score) first, so the
    running-sum windows run over distinct scores (tree leaves), never over rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.operators import quantiles as Q

INF = float("inf")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Every double column rounded: for a result that is shown, never inside a computation."""
    return df.select(*[F.round(F.col(c), digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def with_overall(df: DataFrame, key: str = "fold", overall: int = -1) -> DataFrame:
    """Each row once under its own key and once under ``overall`` (no second scan)."""
    return df.withColumn(key, F.explode(F.array(F.col(key).cast("int"), F.lit(overall))))


# --------------------------------------------------------------------------- E1, E2
def confusion_counts(df: DataFrame, group: list[str], y: str = "y", pred: str = "pred") -> DataFrame:
    yy, pp = F.col(y), F.col(pred)
    return df.groupBy(*group).agg(
        F.sum(((yy == 0) & (pp == 0)).cast("long")).alias("tn"),
        F.sum(((yy == 0) & (pp == 1)).cast("long")).alias("fp"),
        F.sum(((yy == 1) & (pp == 0)).cast("long")).alias("fn"),
        F.sum(((yy == 1) & (pp == 1)).cast("long")).alias("tp"))


def confusion_matrix(df: DataFrame, group: list[str], y: str = "y", pred: str = "pred") -> DataFrame:
    """(group..., y, pred, n) on the full 2 x 2 label grid, zeros included."""
    c = confusion_counts(df, group, y, pred)
    return c.selectExpr(*group, "stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) as (y, pred, n)")


def accuracy(df: DataFrame, group: list[str], y: str = "y", pred: str = "pred") -> DataFrame:
    return df.groupBy(*group).agg(
        F.avg((F.col(y) == F.col(pred)).cast("double")).alias("accuracy"))


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def class_report(df: DataFrame, group: list[str], y: str = "y", pred: str = "pred",
                 labels: list[int] | None = None) -> DataFrame:
    """Per class precision / recall / f1 / support, then accuracy, macro and weighted
    averages; undefined ratios are 0.  Columns: group..., label, precision, recall,
    f1_score, support.  With one label in ``labels`` the report is about it alone: its row, and
    the micro (in place of accuracy), macro and weighted averages over that one label."""
    return class_report_from_confusion(confusion_counts(df, group, y, pred), group, labels)


def class_report_from_confusion(c: DataFrame, group: list[str], labels: list[int] | None = None) -> DataFrame:
    """E3 on a (group..., tn, fp, fn, tp) table."""
    chosen = {0, 1} if labels is None else set(labels)
    if not chosen or not chosen <= {0, 1}:
        raise ValueError(f"labels must be some of 0 and 1, not {labels}")
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    p1, r1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    p0, r0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp)
    f1 = _safe_div(2 * p1 * r1, p1 + r1)
    f0 = _safe_div(2 * p0 * r0, p0 + r0)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    acc = _safe_div(tp + tn, n)

    def row(label, p, r, f, s):
        return F.struct(F.lit(label).alias("label"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1_score"),
                        s.cast("long").alias("support"))

    none = F.lit(None).cast("double")
    if len(chosen) == 1:
        of = {0: (p0, r0, f0, s0), 1: (p1, r1, f1, s1)}[min(chosen)]
        names = [str(min(chosen)), "micro avg", "macro avg", "weighted avg"]
        return c.select(*group, F.inline(F.array(*[row(name, *of) for name in names])))
    rows = c.select(*group, F.array(
        row("0", p0, r0, f0, s0),
        row("1", p1, r1, f1, s1),
        row("accuracy", none, none, acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", _safe_div(p0 * s0 + p1 * s1, n), _safe_div(r0 * s0 + r1 * s1, n),
            _safe_div(f0 * s0 + f1 * s1, n), n),
    ).alias("rows"))
    out = rows.select(*group, F.inline("rows"))
    return out.select(*group, "label", "precision", "recall", "f1_score",
                      F.col("support").cast("long").alias("support"))


# --------------------------------------------------------------------------- E4-E7
def score_counts(df: DataFrame, group: list[str], y: str = "y", prob: str = "prob") -> DataFrame:
    """(group..., score, pos, neg): label counts per distinct score."""
    return df.groupBy(*group, F.col(prob).alias("score")).agg(
        F.sum((F.col(y) == 1).cast("long")).alias("pos"),
        F.sum((F.col(y) == 0).cast("long")).alias("neg"))


def _cumulative_desc(sc: DataFrame, group: list[str], following: bool = False) -> DataFrame:
    """Per distinct score from the top down: ``tp``, ``fp``, the group's totals ``tot_pos``, ``tot_neg``
    and the position ``_i``.  Scores are cut into ranges that hold equally many, however they crowd."""
    ranged = Q.in_ranges(sc, group, "score", descending=True)
    out = Q.running_sums(ranged, group, "score", ["pos", "neg"], descending=True, following=following)
    return out.withColumnsRenamed({"cum_pos": "tp", "cum_neg": "fp"})


def roc_curve(df: DataFrame, group: list[str], y: str = "y", prob: str = "prob",
              drop_intermediate: bool = True) -> DataFrame:
    return roc_curve_from_counts(score_counts(df, group, y, prob), group, drop_intermediate)


def roc_curve_from_counts(sc: DataFrame, group: list[str], drop_intermediate: bool = True) -> DataFrame:
    """(group..., point, threshold, fpr, tpr) from the top score down, starting at
    (threshold=+inf, 0, 0); collinear intermediate points dropped like scikit-learn: a point goes if
    the step to it and the step from it add the same counts.  Steps and point numbers come from the
    ranges of one exchange, so no window spans a whole group and no point looks for its neighbours."""
    c = _cumulative_desc(sc, group, following=True)
    keep = (F.col("_i") == 1) | F.col("next_pos").isNull() | (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
    c = c.where(keep) if drop_intermediate else c
    c = c.drop("_i").withColumn("_k", F.lit(1).cast("long"))
    c = Q.running_sums(c, group, "score", ["_k"], descending=True)  # point = kept points so far
    # the start point rides on the top score's row
    top = F.struct(F.lit(0).cast("long").alias("point"), F.lit(INF).alias("threshold"),
                   F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("fp"))
    own = F.struct(F.col("cum__k").alias("point"), F.col("score").alias("threshold"),
                   F.col("tp").cast("long").alias("tp"), F.col("fp").cast("long").alias("fp"))
    pts = c.select(*group, "tot_pos", "tot_neg",
                   F.explode(F.when(F.col("_i") == 1, F.array(top, own)).otherwise(F.array(own))).alias("p"))
    return pts.select(
        *group, F.col("p.point").cast("int").alias("point"), F.col("p.threshold").alias("threshold"),
        F.when(F.col("tot_neg") > 0, F.col("p.fp") / F.col("tot_neg")).alias("fpr"),
        F.when(F.col("tot_pos") > 0, F.col("p.tp") / F.col("tot_pos")).alias("tpr"))


def roc_auc_from_counts(sc: DataFrame, group: list[str]) -> DataFrame:
    """E5 on a (group..., score, pos, neg) table, e.g. label counts per tree leaf."""
    c = _cumulative_desc(sc, group)
    below = F.col("tot_neg") - F.col("fp")
    agg = c.groupBy(*group).agg(F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))).alias("s"),
                                F.first("tot_pos").alias("tot_pos"), F.first("tot_neg").alias("tot_neg"))
    return agg.select(*group, F.when((F.col("tot_pos") > 0) & (F.col("tot_neg") > 0),
                                     F.col("s") / (F.col("tot_pos") * F.col("tot_neg"))).alias("roc_auc"))


def roc_auc(df: DataFrame, group: list[str], y: str = "y", prob: str = "prob") -> DataFrame:
    """E5: AUC with ties counting half: sum_s pos_s * (neg below s + neg_s / 2) / (P N);
    NULL when a group has one class only."""
    return roc_auc_from_counts(score_counts(df, group, y, prob), group)


def average_precision_from_counts(sc: DataFrame, group: list[str]) -> DataFrame:
    """E7 on a (group..., score, pos, neg) table."""
    c = _cumulative_desc(sc, group)
    term = (F.col("pos") / F.col("tot_pos")) * (F.col("tp") / (F.col("tp") + F.col("fp")))
    agg = c.groupBy(*group).agg(F.sum(F.when(F.col("tot_pos") > 0, term)).alias("ap"),
                                F.first("tot_pos").alias("tot_pos"))
    return agg.select(*group, F.when(F.col("tot_pos") > 0, F.col("ap")).alias("average_precision"))


def accuracy_from_counts(leaves: DataFrame, group: list[str], pred: str = "pred") -> DataFrame:
    """E1 on a (group..., pred, pos, neg) table: correct = pos of class-1 leaves + neg of
    class-0 leaves."""
    ok = F.when(F.col(pred) == 1, F.col("pos")).otherwise(F.col("neg"))
    return leaves.groupBy(*group).agg(
        F.try_divide(F.sum(ok).cast("double"), F.sum(F.col("pos") + F.col("neg"))).alias("accuracy"))


def pr_curve(df: DataFrame, group: list[str], y: str = "y", prob: str = "prob") -> DataFrame:
    return pr_curve_from_counts(score_counts(df, group, y, prob), group)


def pr_curve_from_counts(sc: DataFrame, group: list[str]) -> DataFrame:
    """(group..., point, threshold, precision, recall) for every distinct threshold from
    the top down, then the closing point (recall 0, precision 1, threshold NULL)."""
    c = _cumulative_desc(sc, group)
    # the closing point rides on the top score's row
    end = F.struct(F.lit(0).alias("point"), F.lit(None).cast("double").alias("threshold"),
                   F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    own = F.struct(F.col("_i").alias("point"), F.col("score").alias("threshold"),
                   (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                   F.when(F.col("tot_pos") > 0, F.col("tp") / F.col("tot_pos")).otherwise(1.0).alias("recall"))
    return c.select(*group, F.explode(F.when(F.col("_i") == 1, F.array(own, end)).otherwise(F.array(own))).alias("p")) \
        .select(*group, "p.*")


def average_precision(df: DataFrame, group: list[str], y: str = "y", prob: str = "prob") -> DataFrame:
    """Step-sum AP = sum over thresholds (top down) of (delta recall) * precision.
    Not the trapezoid area Spark's evaluator reports; NULL without positives."""
    return average_precision_from_counts(score_counts(df, group, y, prob), group)
