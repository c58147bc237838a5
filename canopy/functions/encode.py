"""Encoders as column expressions.

Every fitted encoder follows the Spark ML shape: ``fit_*`` scans the table once and returns
a few scalars or level lists (bounded by the number of columns and levels, never by rows);
the transform is a plain column expression that stays inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.operators import quantiles as Q
from canopy.sources.survey import TARGET

# ---- fixed values: answer levels and their ordinal codes, in code order ----
AGE_LEVELS = ["16-20", "20-25", "25-30", "30-Above"]
DAYS_LEVELS = ["Go out Every day", "1-14 days", "15-30 days", "31-60 days", "More than 2 months"]
MOOD_LEVELS = ["Low", "Medium", "High"]
YES_NO_LEVELS = ["No", "Maybe", "Yes"]
YES_NO_COLUMNS = ["Growing_Stress", "Quarantine_Frustrations", "Changes_Habits",
                  "Mental_Health_History", "Weight_Change"]
ORDINAL_COLUMNS = ["Age", "Days_Indoors", "Growing_Stress", "Quarantine_Frustrations",
                   "Changes_Habits", "Mental_Health_History", "Weight_Change", "Mood_Swings"]
NOMINAL_COLUMNS = ["Gender", "Occupation", "Work_Interest", "Social_Weakness"]
NOMINAL_COLUMNS_PP2 = ["Gender", "Occupation", "Social_Weakness"]
# code -> label of the banded bundles (labels name the bands, not the raw answers)
AGE_GROUP_LABELS = {0: "18_20", 1: "21_25", 2: "26_30", 3: "31_plus"}

ORDINAL_MAPS: dict[str, list[str]] = {
    "Age": AGE_LEVELS,
    "Days_Indoors": DAYS_LEVELS,
    "Mood_Swings": MOOD_LEVELS,
    **{c: YES_NO_LEVELS for c in YES_NO_COLUMNS},
}


# --------------------------------------------------------------------------- P4, P5, P6, P7
def ordinal_code(col: str | Column, levels: list[str]) -> Column:
    """Label -> position in ``levels`` as double; unknown label or NULL -> NULL."""
    c = F.col(col) if isinstance(col, str) else col
    expr = F.lit(None).cast("double")
    for i in reversed(range(len(levels))):
        expr = F.when(c == levels[i], F.lit(float(i))).otherwise(expr)
    return expr


def ordinal_encode(df: DataFrame, maps: dict[str, list[str]] | None = None) -> DataFrame:
    maps = ORDINAL_MAPS if maps is None else maps
    return df.withColumns({c: ordinal_code(c, lv) for c, lv in maps.items() if c in df.columns})


def binarize(col: str, positive: str = "Yes") -> Column:
    """P5: positive label -> 1, everything else including NULL -> 0."""
    return F.when(F.col(col) == positive, 1).otherwise(0).cast("int")


def code_to_label(col: str | Column, labels: dict[int, str]) -> Column:
    """Integral code -> label; a fractional (imputed) code matches nothing -> NULL."""
    c = F.col(col) if isinstance(col, str) else col
    expr = F.lit(None).cast("string")
    for k in sorted(labels, reverse=True):
        expr = F.when(c == F.lit(float(k)), labels[k]).otherwise(expr)
    return expr


def coerce_numeric(col: str) -> Column:
    """Text to double, a bad value gives NULL (``pd.to_numeric(errors='coerce')``)."""
    return F.col(col).cast("string").try_cast("double")


# --------------------------------------------------------------------------- G1
def null_counts(df: DataFrame, cols: list[str]) -> dict[str, Column]:
    return {c: F.sum(F.col(c).isNull().cast("long")) for c in cols}


def null_report(df: DataFrame, cols: list[str] | None = None, stage: str | None = None) -> DataFrame:
    """(column_name, n_null) for every column in one aggregation, unpivoted with stack."""
    cols = cols or df.columns
    agg = df.agg(*[v.alias(k) for k, v in null_counts(df, cols).items()])
    out = agg.unpivot([], cols, "column_name", "n_null")
    if stage is not None:
        out = out.withColumn("stage", F.lit(stage))
    return out


# --------------------------------------------------------------------------- P14, G6
def fit_medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """Exact medians (linear interpolation, NULLs skipped) of columns of any width; one scan."""
    return {c: q[0] for c, q in Q.fit_quantiles(df, {c: F.col(c) for c in cols}, [0.5]).items()}


def impute(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v).cast("double"))
                           for c, v in values.items()})


def impute_median(df: DataFrame, cols: list[str]) -> DataFrame:
    return impute(df, fit_medians(df, cols))


# --------------------------------------------------------------------------- P8-P13
def fit_levels(df: DataFrame, cols: list[str]) -> dict[str, list[str]]:
    """Sorted distinct non-NULL labels per column: unpivot + distinct in one job.

    The result is the (small) level vocabulary that names the dummy columns, the same
    thing ``StringIndexer.fit`` brings to the driver."""
    if not cols:
        return {}
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in cols])
            .unpivot([], cols, "column_name", "level")
            .where(F.col("level").isNotNull()).distinct())
    levels: dict[str, list[str]] = {c: [] for c in cols}
    for r in long.collect():
        levels[r["column_name"]].append(r["level"])
    return {c: sorted(v) for c, v in levels.items()}


def category_code(col: str, levels: list[str]) -> Column:
    """Rank among the sorted distinct labels from 0; NULL / unseen -> -1."""
    c = F.col(col)
    expr = F.lit(-1)
    for i in reversed(range(len(levels))):
        expr = F.when(c == levels[i], F.lit(i)).otherwise(expr)
    return expr.cast("int")


def category_encode(df: DataFrame, cols: list[str],
                    levels: dict[str, list[str]] | None = None) -> DataFrame:
    levels = levels or fit_levels(df, cols)
    return df.withColumns({c: category_code(c, levels[c]) for c in cols})


def dummy_columns(col: str, levels: list[str], drop_first: bool) -> dict[str, Column]:
    """0/1 int column per level, named ``col_level``; NULL / unseen -> all zeros."""
    use = levels[1:] if drop_first else levels
    return {f"{col}_{lv}": F.coalesce((F.col(col) == lv).cast("int"), F.lit(0)) for lv in use}


def one_hot(df: DataFrame, cols: list[str], drop_first: bool = True,
            levels: dict[str, list[str]] | None = None) -> DataFrame:
    """Like ``get_dummies``: source columns removed, dummies appended
    in column order then sorted level order."""
    levels = levels or fit_levels(df, cols)
    keep = [F.col(c) for c in df.columns if c not in cols]
    dummies = []
    for c in cols:
        dummies += [v.alias(k) for k, v in dummy_columns(c, levels[c], drop_first).items()]
    return df.select(*keep, *dummies)


def ordinal_from_levels(col: str | Column, levels: list[str], on_unknown: str = "error") -> Column:
    """Position in a given level order; unknown or NULL raises (``on_unknown='error'``)
    or gives NULL (``'null'``)."""
    c = F.col(col) if isinstance(col, str) else col
    pos = F.array_position(F.array(*[F.lit(v) for v in levels]), c)
    ok = F.coalesce(pos > 0, F.lit(False))
    if on_unknown == "error":
        bad = F.raise_error(F.concat(F.lit("unknown category: "), F.coalesce(c.cast("string"),
                                                                             F.lit("NULL"))))
        return F.when(ok, (pos - 1).cast("int")).otherwise(bad.cast("int"))
    return F.when(ok, (pos - 1).cast("int"))


# --------------------------------------------------------------------------- P15, P16
def bin_right_closed(col: str | Column, edges: list[float], labels: list[str],
                     outside: str | None = "nan") -> Column:
    """``pd.cut(x, edges, labels)``: (e0,e1] -> labels[0], ...; outside / NULL -> ``outside``
    (the string 'nan' after ``astype(str)``, or NULL when ``outside`` is None)."""
    c = F.col(col) if isinstance(col, str) else col
    expr = F.lit(outside).cast("string")
    for i in reversed(range(len(labels))):
        expr = F.when((c > F.lit(float(edges[i]))) & (c <= F.lit(float(edges[i + 1]))),
                      labels[i]).otherwise(expr)
    return expr


# --------------------------------------------------------------------------- P1-P3, P23, P24
def with_prefix(df: DataFrame, *prefixes: str) -> list[str]:
    """Column names starting with any prefix, in table order."""
    return [c for c in df.columns if any(c.startswith(p) for p in prefixes)]


def row_sum(cols: list[str | Column]) -> Column:
    """NULL-safe row-wise sum (0 for an empty set)."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("double"), F.lit(0.0))
             for c in cols]
    return reduce(lambda a, b: a + b, parts, F.lit(0.0))


def col_or(df: DataFrame, name: str, default=0) -> Column:
    """The column when present, else a literal default."""
    return F.col(name) if name in df.columns else F.lit(default)


def fit_preprocess(df: DataFrame, nominal: list[str] | None = None) -> dict:
    """Everything preprocessing fits, from ONE count of answers over the raw survey: medians of
    the mapped ordinal answers, sorted levels of the nominal answers and of the target,
    and the distinct mapped Age codes (for the Age_Group dummies).  Rows become answers with
    their counts first; only levels come to the driver."""
    nominal = NOMINAL_COLUMNS if nominal is None else nominal
    labels = [*nominal, TARGET]
    answers = df.select(*[ordinal_code(c, ORDINAL_MAPS[c]).cast("string").alias(c) for c in ORDINAL_COLUMNS],
                        *[F.col(c).cast("string").alias(c) for c in labels])
    answers = answers.unpivot([], [*ORDINAL_COLUMNS, *labels], Q.NAME, Q.VALUE).where(F.col(Q.VALUE).isNotNull())
    answers = answers.groupBy(Q.NAME, Q.VALUE).agg(F.count(F.lit(1)).alias(Q.COUNT))
    # an ordinal column has as many codes as its map has levels, so its median needs no ranges
    fits = {r[Q.NAME]: r for r in answers.groupBy(Q.NAME).agg(
        F.percentile(F.when(F.col(Q.NAME).isin(ORDINAL_COLUMNS), F.col(Q.VALUE)).try_cast("double"), 0.5, F.col(Q.COUNT)).alias("median"),
        F.collect_list(Q.VALUE).alias("levels")).collect()}
    medians = {c: fits[c]["median"] if c in fits else None for c in ORDINAL_COLUMNS}
    levels = {c: list(fits[c]["levels"]) if c in fits else [] for c in ["Age", *labels]}
    age = {float(a) for a in levels.pop("Age")}
    if medians["Age"] is not None:
        age.add(medians["Age"])
    return {"medians": medians, "levels": {c: sorted(v) for c, v in levels.items()},
            "age_groups": sorted(AGE_GROUP_LABELS[int(a)] for a in age
                                 if float(a).is_integer() and int(a) in AGE_GROUP_LABELS)}


def preprocess(df: DataFrame, variant: str = "pp", fit_on: DataFrame | None = None,
               fitted: dict | None = None) -> DataFrame:
    """The reference's preprocessing as one lazy plan.

    ``pp``  : ordinal maps, median impute of the 8 ordinal columns, dummies drop-first for
              Gender / Occupation / Work_Interest / Social_Weakness, target category code.
    ``pp2`` : same but Work_Interest becomes Yes=1 else 0 and gets no dummies.
    Parameters are fitted on ``fit_on`` (default: the frame itself, as the reference) in
    one aggregation, or taken from ``fitted`` (see ``fit_preprocess``).
    """
    if variant not in ("pp", "pp2"):
        raise ValueError(f"unknown variant {variant!r}")
    nominal = NOMINAL_COLUMNS_PP2 if variant == "pp2" else NOMINAL_COLUMNS
    fitted = fitted or fit_preprocess(fit_on if fit_on is not None else df, NOMINAL_COLUMNS)
    enc = impute(ordinal_encode(df), fitted["medians"])
    if variant == "pp2":
        enc = enc.withColumn("Work_Interest", binarize("Work_Interest"))
    levels = fitted["levels"]
    enc = enc.withColumn(TARGET, category_code(TARGET, levels[TARGET]))
    return one_hot(enc, nominal, drop_first=True, levels={c: levels[c] for c in nominal})


def dummy_names(df: DataFrame) -> list[str]:
    """Names of the nominal dummies of a preprocessed table."""
    return with_prefix(df, "Gender_", "Occupation_", "Work_Interest_", "Social_Weakness_")

