"""Profiles of a survey table.

Design rule: scan once, pre-aggregate early.  Multi-column profiles unpivot the columns
into (column_name, value) so ONE groupBy serves every column, and the statistics that
need sorted values (quantiles, whiskers, densities) are computed from the per-value count
table, which is bounded by the number of distinct answers rather than by rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canopy.operators import quantiles as Q


def _long(df: DataFrame, cols: list[str], keys: list[str] | None = None,
          as_type: str = "string") -> DataFrame:
    """(keys..., column_name, value) with NULL values dropped."""
    keys = keys or []
    sel = df.select(*keys, *[F.col(c).cast(as_type).alias(c) for c in cols])
    return (sel.unpivot(keys, cols, "column_name", "value")
            .where(F.col("value").isNotNull()))


# --------------------------------------------------------------------------- G3, G4, G5
def frequency(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, value, n, pct): counts per value, NULL excluded; pct of non-NULL rows."""
    counts = _long(df, cols).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("column_name")  # rows = distinct values of one column
    return counts.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(w), 6))


def mode_per_column(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, mode_value, n): most frequent value, the smallest one on ties."""
    counts = _long(df, cols).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by(F.struct((-F.col("n")).alias("neg_n"), F.col("value").alias("v")),
                    F.struct(-F.col("n"), F.col("value")))
    return (counts.groupBy("column_name").agg(best.alias("b"))
            .select("column_name", F.col("b.v").alias("mode_value"), (-F.col("b.neg_n")).alias("n")))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """F2."""
    return df.select(col).where(F.col(col).isNotNull()).distinct()


# --------------------------------------------------------------------------- G8-G10, F1
def _levels(df: DataFrame, col: str) -> list[str]:
    return sorted(r[0] for r in distinct_values(df, col).collect())


def pivot_count(df: DataFrame, index: list[str], column: str, value: str | None = None,
                levels: list[str] | None = None) -> DataFrame:
    """``pivot_table(aggfunc='count').fillna(0)`` / ``crosstab``: NULL keys are skipped;
    ``value`` counts only rows where it is not NULL.  Explicit levels avoid the extra job
    Spark runs to discover pivot values."""
    lv = levels if levels is not None else _levels(df, column)
    data = df.where(F.col(column).isNotNull())
    for k in index:
        data = data.where(F.col(k).isNotNull())
    agg = F.count(F.col(value)) if value else F.count(F.lit(1))
    return data.groupBy(*index).pivot(column, lv).agg(agg).na.fill(0, subset=lv)


def pivot_age_gender(df: DataFrame, levels: list[str] | None = None) -> DataFrame:
    """Age x Gender count of non-NULL Mental_Health_History."""
    return pivot_count(df, ["Age"], "Gender", "Mental_Health_History", levels)


def crosstab_two_key(df: DataFrame, a: str = "Age", b: str = "Gender", c: str = "Growing_Stress",
                     levels: list[str] | None = None) -> DataFrame:
    """(a, b) x c counts, plus the ``a-b`` row label used by the heat map."""
    out = pivot_count(df, [a, b], c, None, levels)
    return out.withColumn("row_label", F.concat_ws("-", F.col(a), F.col(b)))


def crosstab_by_level(df: DataFrame, level: str = "Growing_Stress", a: str = "Age",
                      c: str = "Occupation", levels: list[str] | None = None) -> DataFrame:
    """G10 (+F1): an ``a x c`` crosstab for every value of ``level`` in ONE groupBy,
    instead of one filter and one job per level."""
    return pivot_count(df, [level, a], c, None, levels)


# --------------------------------------------------------------------------- G11, G12
def group_means(df: DataFrame, target: str, cols: list[str]) -> DataFrame:
    """(target, column_name, mean): mean of each column per target value, one groupBy."""
    agg = df.where(F.col(target).isNotNull()).groupBy(target).agg(
        *[F.avg(F.col(c).cast("double")).alias(c) for c in cols])
    return (agg.unpivot([target], cols, "column_name", "mean")
            .withColumn("mean", F.round("mean", 6)))


#: From this mean on a Poisson draw comes from a normal one.
POISSON_NORMAL = 500


def poisson_weights(cells: DataFrame, n_boot: int, seed: int) -> DataFrame:
    """(target, column_name, value, n) -> one row per replicate with ``w``, a Poisson(n) draw: the
    summed Poisson(1) weight of the cell's n rows.

    The draw is a function of md5('seed:target:column_name:value:replicate') alone, so reruns, lost
    tasks and other engines agree.  Two uniforms u1, u2 are its hex digits 1-13 and 14-26.
    n < POISSON_NORMAL: the smallest k whose distribution function is not below u1; the function is an
    array made once per cell (some 800 entries at most).  Beyond: z = sqrt(-2 ln u1) cos(2 pi u2) is
    normal, and k is the Cornish-Fisher quantile n + sqrt(n) z + (z^2 - 1) / 6 + (z - z^3) / (72 sqrt(n)),
    less 1/2 and rounded up, an approximation of the exact one."""
    keys = cells.columns[:3]
    n = F.col("n").cast("double")
    first = F.exp(-n)
    steps = F.sequence(F.lit(1), (n + 12 * F.sqrt(n) + 30).cast("int"))
    grown = F.aggregate(
        steps, F.struct(first.alias("p"), F.array(first).alias("cdf")),
        lambda a, k: F.struct((a["p"] * n / k).alias("p"),
                              F.array_append(a["cdf"], F.element_at(a["cdf"], -1) + a["p"] * n / k).alias("cdf")))
    small = F.col("n") < POISSON_NORMAL
    reps = cells.withColumn("_cdf", F.when(small, grown["cdf"])).withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(n_boot))))
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in (*keys, "rep")])
    reps = reps.withColumn("_h", F.md5(text))
    reps = reps.select("*", *[((F.conv(F.substring("_h", at, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)).alias(u)
                              for at, u in ((1, "_u1"), (14, "_u2"))])
    reps = reps.withColumn("_z", F.sqrt(-2.0 * F.log("_u1")) * F.cos(2.0 * math.pi * F.col("_u2")))
    z, root = F.col("_z"), F.sqrt(n)
    normal = n + root * z + (z * z - 1.0) / 6.0 + (z - z * z * z) / (72.0 * root)
    drawn = F.when(small, F.size(F.filter("_cdf", lambda x: x < F.col("_u1"))).cast("long")) \
        .otherwise(F.greatest(F.ceil(normal - 0.5), F.lit(0)).cast("long"))
    return reps.select(*keys, "rep", drawn.alias("w"))


def group_means_bootstrap(df: DataFrame, target: str, cols: list[str], id_col: str | None = None,
                          n_boot: int = 1000, seed: int = 42, ci: float = 95.0) -> DataFrame:
    """Grouped mean with a percentile bootstrap interval (the bar-plot error bar).

    Poisson bootstrap on value cells: every bar is the mean of one (target, column), so
    its rows collapse to (value, count) cells; in replicate b a cell of c rows weighs
    Poisson(c) (the sum of c independent Poisson(1) row weights).  Work is
    targets x columns x distinct values x replicates, after one value-count scan, however
    many rows there are.  Interval = percentiles of the replicate means; a replicate in which
    every cell of a bar draws 0 has no mean."""
    lo, hi = (100.0 - ci) / 200.0, 1.0 - (100.0 - ci) / 200.0
    vc = value_counts(df, target, cols)
    reps = poisson_weights(vc.select(target, "column_name", "value", "n"), n_boot, seed)
    boot = reps.groupBy(target, "column_name", "rep").agg(
        F.try_divide(F.sum(F.col("w") * F.col("value")), F.sum("w")).alias("boot_mean"))
    ci_df = boot.groupBy(target, "column_name").agg(
        F.percentile("boot_mean", F.array(F.lit(lo), F.lit(hi))).alias("q"))
    means = group_means(df, target, cols)
    return (means.join(ci_df, [target, "column_name"])
            .select(target, "column_name", "mean", F.round(F.col("q")[0], 6).alias("ci_low"),
                    F.round(F.col("q")[1], 6).alias("ci_high")))


# --------------------------------------------------------------------------- G13, G14
def value_counts(df: DataFrame, target: str, cols: list[str]) -> DataFrame:
    """(target, column_name, value double, n): the per-value table every distribution
    statistic below reads; one scan, partial aggregation before the shuffle."""
    return Q.value_counts(df.where(F.col(target).isNotNull()), {c: F.col(c) for c in cols}, [target])


def box_stats(df: DataFrame, target: str, cols: list[str]) -> DataFrame:
    """Quartiles (linear), whiskers at the last datum within 1.5 IQR, outlier count."""
    keys = [target, "column_name"]
    vc = Q.in_ranges(value_counts(df, target, cols), keys)
    q = Q.quantiles(vc, keys, [0.25, 0.5, 0.75])
    q = q.select(*keys, F.col("n_total").alias("n"), F.col("q")[0].alias("q1"),
                 F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    j = vc.join(q.select(*keys, "q1", "q3", "iqr"), keys)
    lo_fence = F.col("q1") - 1.5 * F.col("iqr")
    hi_fence = F.col("q3") + 1.5 * F.col("iqr")
    w = j.groupBy(target, "column_name").agg(
        F.min(F.when(F.col("value") >= lo_fence, F.col("value"))).alias("whisker_low"),
        F.max(F.when(F.col("value") <= hi_fence, F.col("value"))).alias("whisker_high"),
        F.sum(F.when((F.col("value") < lo_fence) | (F.col("value") > hi_fence), F.col("n"))
              .otherwise(0)).alias("n_outliers"))
    out = q.join(w, [target, "column_name"])
    return out.select(target, "column_name", "n",
                      *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3", "iqr",
                                                          "whisker_low", "whisker_high")],
                      F.col("n_outliers").cast("long").alias("n_outliers"))


def density_grid(df: DataFrame, target: str, cols: list[str], gridsize: int = 100,
                 cut: float = 2.0) -> DataFrame:
    """Gaussian KDE (Scott bandwidth = sample std * n^-1/5) on ``gridsize`` points from
    min - cut*bw to max + cut*bw per (target, column), plus the quartiles drawn inside.

    The kernel sum runs over the per-value count table: grid points x distinct values per
    group, never pairs of rows."""
    keys = [target, "column_name"]
    ranged = Q.in_ranges(value_counts(df, target, cols), keys)
    vc = ranged.drop(Q.RANGE)
    st = vc.groupBy(*keys).agg(
        F.sum("n").alias("n_obs"), F.sum(F.col("n") * F.col("value")).alias("s1"),
        F.sum(F.col("n") * F.col("value") * F.col("value")).alias("s2"),
        F.min("value").alias("vmin"), F.max("value").alias("vmax"))
    st = st.join(Q.quantiles(ranged, keys, [0.25, 0.5, 0.75]).select(*keys, "q"), keys)
    var = (F.col("s2") - F.col("s1") * F.col("s1") / F.col("n_obs")) / (F.col("n_obs") - 1)
    st = st.withColumn("bw", F.when(var > 1e-12, F.sqrt(var) * F.pow(F.col("n_obs"), -0.2)))
    st = st.withColumn("lo", F.col("vmin") - cut * F.col("bw")).withColumn(
        "hi", F.col("vmax") + cut * F.col("bw"))
    grid = st.select(*keys, "n_obs", "bw", "lo", "hi", "q",
                     F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("point"))
    grid = grid.withColumn("x", F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("point")
                           / F.lit(float(gridsize - 1)))
    j = grid.join(vc, keys)
    z = (F.col("x") - F.col("value")) / F.col("bw")
    dens = j.groupBy(*keys, "point", "x", "n_obs", "bw", "q").agg(
        F.sum(F.col("n") * F.exp(-0.5 * z * z)).alias("k"))
    dens = dens.withColumn("density", F.col("k") / (F.col("n_obs") * F.col("bw")
                                                     * F.lit(math.sqrt(2 * math.pi))))
    return dens.select(*keys, "point", F.round("x", 6).alias("x"),
                       F.round("density", 6).alias("density"),
                       F.round(F.col("q")[0], 6).alias("q1"), F.round(F.col("q")[1], 6).alias("median"),
                       F.round(F.col("q")[2], 6).alias("q3"))


# --------------------------------------------------------------------------- G15, G16, T1
def _centered_moments(df: DataFrame, pairs: list[tuple[str, str]]) -> tuple[DataFrame, dict]:
    """Two passes, both single aggregations: (1) per-column non-NULL count and mean;
    (2) sums of centered cross products per pair.  A pair of NULL-free columns needs one
    sum; a pair touching a column with NULLs gets pairwise-complete (masked) sums.
    Written as SQL text: one parse in the JVM however many pairs there are."""
    cols = sorted({c for p in pairs for c in p})
    idx = {c: i for i, c in enumerate(cols)}

    def q(c):
        return "`" + c.replace("`", "``") + "`"

    first = df.selectExpr("count(1) AS _n", *[f"count({q(c)}) AS n_{idx[c]}" for c in cols],
                          *[f"avg(CAST({q(c)} AS DOUBLE)) AS m_{idx[c]}" for c in cols]).first()
    n = first["_n"]
    complete = {c for c in cols if first[f"n_{idx[c]}"] == n}

    def d(c):  # centered value; the mean enters as an exact double literal
        m = first[f"m_{idx[c]}"] or 0.0
        return f"(CAST({q(c)} AS DOUBLE) - CAST('{m!r}' AS DOUBLE))"

    aggs, names = [], {}
    for c in cols:
        if c in complete:
            aggs.append(f"sum({d(c)} * {d(c)}) AS ss_{idx[c]}")
    for k, (a, b) in enumerate(pairs):
        if a in complete and b in complete:
            aggs.append(f"sum({d(a)} * {d(b)}) AS sab_{k}")
            names[k] = ("complete", a, b)
        else:
            both = f"{q(a)} IS NOT NULL AND {q(b)} IS NOT NULL"
            da, db = f"IF({both}, {d(a)}, NULL)", f"IF({both}, {d(b)}, NULL)"
            aggs += [f"count({da}) AS n_{k}", f"sum({da}) AS sa_{k}", f"sum({db}) AS sb_{k}",
                     f"sum({da} * {db}) AS sab_{k}", f"sum({da} * {da}) AS saa_{k}",
                     f"sum({db} * {db}) AS sbb_{k}"]
            names[k] = ("masked", a, b)
    return df.selectExpr(*aggs), {"names": names, "idx": idx}


def _clamp(c: Column) -> Column:
    """Round to 6 digits inside [-1, 1]; NULL stays NULL (greatest/least skip NULLs)."""
    return F.when(c.isNotNull(), F.round(F.least(F.greatest(c, F.lit(-1.0)), F.lit(1.0)), 6))


def _pearson_exprs(meta: dict, both_orders: bool = False) -> list[str]:
    out = []
    for k, (kind, a, b) in meta["names"].items():
        if kind == "complete":
            num, va, vb = f"sab_{k}", f"ss_{meta['idx'][a]}", f"ss_{meta['idx'][b]}"
        else:
            num = f"(sab_{k} - sa_{k} * sb_{k} / n_{k})"
            va, vb = f"(saa_{k} - sa_{k} * sa_{k} / n_{k})", f"(sbb_{k} - sb_{k} * sb_{k} / n_{k})"
        r = f"CASE WHEN {va} > 0 AND {vb} > 0 THEN {num} / sqrt({va} * {vb}) END"
        out.append(f"'{a}', '{b}', {r}")
        if both_orders and a != b:
            out.append(f"'{b}', '{a}', {r}")
    return out


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every pair (pairwise complete), long form
    (col_a, col_b, corr), full square including the diagonal; constant column -> NULL.
    Two scans whatever the number of columns; the k^2 results are formed from the
    one-row moment table inside Spark."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    moments, meta = _centered_moments(df, pairs)
    exprs = _pearson_exprs(meta, both_orders=True)
    full = moments.selectExpr(f"stack({len(exprs)}, {', '.join(exprs)}) AS (col_a, col_b, corr)")
    return full.withColumn("corr", _clamp(F.col("corr")))


def corr_with_target(df: DataFrame, target: str, cols: list[str]) -> DataFrame:
    """G16 + T1: (column_name, corr) with the target, sorted descending (NULLs last)."""
    pairs = [(c, target) for c in cols]
    moments, meta = _centered_moments(df, pairs)
    exprs = [e.split(", ", 2) for e in _pearson_exprs(meta)]
    stack = ", ".join(f"{a}, {r}" for a, _b, r in exprs)
    long = moments.selectExpr(f"stack({len(pairs)}, {stack}) AS (column_name, corr)")
    long = long.withColumn("corr", _clamp(F.col("corr")))
    return long.orderBy(F.desc_nulls_last("corr"), "column_name")
