"""Derived features and the five feature bundles.

All formulas are plain column arithmetic (whole-stage codegen).  The only data-dependent
parts are a few thresholds (medians, terciles) and dummy levels; ``fit_*`` computes all of
them from ONE count of values and returns a small dict, ``apply`` uses them as literals.  Passing
the thresholds fitted on training rows gives fit/transform semantics; refitting on each
frame (the default) reproduces the reference, whose feature step is stateless.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.functions.encode import (
    AGE_GROUP_LABELS, NOMINAL_COLUMNS, ORDINAL_COLUMNS, ORDINAL_MAPS, bin_right_closed,
    category_code, code_to_label, coerce_numeric, col_or, fit_levels, fit_medians, impute,
    one_hot, ordinal_code, ordinal_from_levels, row_sum, with_prefix,
)
from canopy.operators import quantiles as Q
from canopy.sources.survey import TARGET

S, FR, M, D = "Growing_Stress", "Quarantine_Frustrations", "Mood_Swings", "Days_Indoors"
H, W, A, C = "Mental_Health_History", "Weight_Change", "Age", "Changes_Habits"

# Quantiles of integer codes come out as 1.0000000000000002 or 0.9999999999999998 depending
# on the engine's interpolation formula; comparisons allow this much noise so that every
# engine puts a value equal to a threshold on the same side.
THRESHOLD_EPS = 1e-9


def _c(name: str) -> Column:
    return F.col(name)


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 int; NULL compares false (pandas gives False on NaN)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def tercile_level(x: Column, q33: float | Column | None, q66: float | Column | None) -> Column:
    """<=q33 -> 0, <=q66 -> 1, else 2; constant 0 when q33 is not below q66.  The terciles
    are numbers, or columns where rows carry thresholds of their own (see ``plans.infold``)."""
    if isinstance(q33, Column):
        return (F.when(~F.coalesce(q66 - q33 > THRESHOLD_EPS, F.lit(False)), 0).when(x <= q33 + THRESHOLD_EPS, 0)
                .when(x <= q66 + THRESHOLD_EPS, 1).when(x.isNotNull(), 2)).cast("int")
    if q33 is None or q66 is None or not q66 - q33 > THRESHOLD_EPS:
        return F.lit(0)
    return (F.when(x <= F.lit(q33 + THRESHOLD_EPS), 0).when(x <= F.lit(q66 + THRESHOLD_EPS), 1)
            .when(x.isNotNull(), 2)).cast("int")


def above(x: Column, threshold: float | Column | None) -> Column:
    """Strictly above the threshold (beyond float noise); 0 when undefined."""
    if threshold is None:
        return F.lit(0)
    return flag(x > F.lit(threshold + THRESHOLD_EPS))


# =========================================================================== base bundle
def _base_inputs() -> dict[str, Column]:
    return {
        "Total_Stress_Frustration": _c(S) + _c(FR),
        "Frac_Frustration": _c(FR) / (_c(D) + 1),
    }


#: Lower tercile, median, upper tercile.
BASE_PROBS = [0.33, 0.5, 0.66]


def base_fits(df: DataFrame, key: str | None = None, weight: Column | None = None) -> dict:
    """What ``base_thresholds`` reads, per value of ``key`` where given; ``weight`` is the count of a
    row that stands for several."""
    x = _base_inputs()
    return Q.fit_quantiles(df, {"total": x["Total_Stress_Frustration"], "frac": x["Frac_Frustration"],
                                "mood": _c(M), "stress": _c(S)}, BASE_PROBS, key, weight)


def base_thresholds(fits: dict | None) -> dict[str, float | None]:
    """Thresholds by name; all NULL where nothing was fitted."""
    none = [None] * len(BASE_PROBS)
    q = {name: (fits or {}).get(name, none) for name in ("total", "frac", "mood", "stress")}
    out = {"med_total": q["total"][1], "med_frac": q["frac"][1]}
    for name, (q33, _, q66) in q.items():
        out[f"terc_{name}_33"], out[f"terc_{name}_66"] = q33, q66
    return out


def fit_base(df: DataFrame) -> dict[str, float | None]:
    """Medians and terciles of the base bundle (exact, linear); one scan."""
    return base_thresholds(base_fits(df))


def base(df: DataFrame, thresholds: dict | None = None) -> DataFrame:
    """The reference's ``engineer_features`` (P25 upper block)."""
    t = thresholds or fit_base(df)
    x = _base_inputs()
    tot, frac = x["Total_Stress_Frustration"], x["Frac_Frustration"]
    sw = with_prefix(df, "Social_Weakness_")
    wi = with_prefix(df, "Work_Interest_")
    occ = with_prefix(df, "Occupation_")
    if sw and wi:
        wi_value = col_or(df, "Work_Interest_Maybe") * 1 + col_or(df, "Work_Interest_Yes") * 2
        wi_sw = (wi_value * row_sum(sw)).cast("int")
    else:
        wi_sw = F.lit(0)
    med_total, med_frac = t["med_total"], t["med_frac"]
    cols = {
        "High_Stress_Mood_Swings": flag((_c(S) >= 2) & (_c(M) >= 2)),
        "Days_In_Frustration": flag((_c(D) >= 2) & (_c(FR) >= 2)),
        "Stress_Mood_Interaction": _c(S) * _c(M),
        "Stress_Frustration_Interaction": _c(S) * _c(FR),
        "Total_Stress_Frustration": tot,
        "Frac_Frustration": frac,
        "Mood_Squared": _c(M) * _c(M),
        "Stress_Squared": _c(S) * _c(S),
        "Frustration_Squared": _c(FR) * _c(FR),
        "High_Total_Stress": above(tot, med_total),
        "High_Frustration_Rate": above(frac, med_frac),
        "Total_Stress_Level": tercile_level(tot, t["terc_total_33"], t["terc_total_66"]),
        "Frac_Frustration_Level": tercile_level(frac, t["terc_frac_33"], t["terc_frac_66"]),
        "Age_Weight_Interaction": _c(A) * _c(W),
        "Log_Days_Indoors": F.log1p(_c(D)),
        "Mental_Stress_Frustration_Score": _c(H) + _c(S) + _c(FR),
        "Habit_Mood_Interaction": _c(C) * _c(M),
        "WI_SW_Sum": wi_sw,
        "Occupation_Count": row_sum(occ).cast("int"),
        "Weight_Yes_Flag": flag(_c(W) == 2),
        "Mood_Level": tercile_level(_c(M), t["terc_mood_33"], t["terc_mood_66"]),
        "Stress_Level": tercile_level(_c(S), t["terc_stress_33"], t["terc_stress_66"]),
        "Long_Time_Indoors": flag(_c(D) >= 3),
    }
    return df.withColumns(cols)


# =========================================================================== banded bundles
def ratio_features(form: str = "A") -> dict[str, Column]:
    """Ratio / interaction features; ``form`` picks the A-strategy or B4 formulas (P25)."""
    if form == "A":
        return {
            "Frustration_Stress_Ratio": _c(FR) / (_c(S) + 1),
            "Frustration_Stress_SqRatio": (_c(FR) * _c(FR)) / (_c(S) + 1),
            "Stress_Sq_Frustration": (_c(S) * _c(S)) / (_c(FR) + 1),
            "Frustration_Stress_Diff": _c(FR) - _c(S),
            "Mood_Days_Product": _c(M) * _c(D),
            "Weight_Med_History_Ratio": _c(W) / (_c(H) + 1),
            "Weight_x_History": _c(W) * _c(H),
        }
    if form == "B4":
        return {
            "Mood_Days_Product": _c(M) * _c(D),
            "Weight_Med_History_Ratio": _c(W) / (_c(H) + 1),
            "Frustration_Stress_Diff": _c(FR) - _c(S),
            "Stress_Sq_Frustration": _c(S) * _c(S) + _c(FR),
            "Frustration_Stress_SqRatio": (_c(FR) + 1) / (_c(S) * _c(S) + 1),
            "Weight_x_History": _c(W) * _c(H),
        }
    raise ValueError(form)


def _age_group_one_hot_first(df: DataFrame, levels: list[str] | None) -> DataFrame:
    """One-hot of Age_Group with all (sorted) levels placed first, passthrough after
    (P3 + P11).  NULL Age_Group (fractional imputed age) gives all-zero dummies."""
    lv = levels if levels is not None else fit_levels(df, ["Age_Group"])["Age_Group"]
    dummies = [F.coalesce((_c("Age_Group") == v).cast("int"), F.lit(0)).alias(f"Age_Group_{v}")
               for v in lv]
    rest = [c for c in df.columns if c != "Age_Group"]
    return df.select(*dummies, *rest)


def banded4(df: DataFrame, drop: tuple[str, ...] = (), age_levels: list[str] | None = None) -> DataFrame:
    """A4 ``full_feature_engineering``: four bands per column + ratios + Age_Group one-hot.
    ``drop`` removes named features (the reference compares runs without two of them)."""
    bands = {
        "Age_Group": code_to_label(A, AGE_GROUP_LABELS),
        "Indoor_0": flag(_c(D) == 0), "Indoor_1": flag(_c(D) == 1),
        "Indoor_2_3": flag((_c(D) >= 2) & (_c(D) <= 3)), "Indoor_4_plus": flag(_c(D) >= 4),
        "Mood_0_1": flag(_c(M) <= 1), "Mood_2": flag(_c(M) == 2),
        "Mood_3": flag(_c(M) == 3), "Mood_4_plus": flag(_c(M) >= 4),
        "Stress_0_1": flag(_c(S) <= 1), "Stress_2": flag(_c(S) == 2),
        "Stress_3": flag(_c(S) == 3), "Stress_4_plus": flag(_c(S) >= 4),
    }
    feats = {k: v for k, v in ratio_features("A").items() if k not in drop}
    out = df.withColumns(bands).withColumns(feats)
    return _age_group_one_hot_first(out, age_levels)


def banded3(df: DataFrame, age_levels: list[str] | None = None) -> DataFrame:
    """A3 bundle: three bands per column + three ratios + Age_Group one-hot."""
    bands = {"Age_Group": code_to_label(A, AGE_GROUP_LABELS)}
    for name, col in (("Indoor", D), ("Mood", M), ("Stress", S)):
        bands[f"{name}_Low"] = flag(_c(col) <= 1)
        bands[f"{name}_Med"] = flag((_c(col) >= 2) & (_c(col) <= 3))
        bands[f"{name}_High"] = flag(_c(col) >= 4)
    a = ratio_features("A")
    feats = {k: a[k] for k in ("Frustration_Stress_Ratio", "Mood_Days_Product",
                               "Weight_Med_History_Ratio")}
    out = df.withColumns(bands).withColumns(feats)
    return _age_group_one_hot_first(out, age_levels)


# =========================================================================== coded bundle
# ---- fixed values: bins and level orders of the coded bundle ----
CODED_BINS = {
    "Age_Group": ("Age", [-0.1, 0.5, 1.5, 2.5, 3.5], ["18-20", "21-25", "26-30", "31_plus"]),
    "Days_In_Bin": ("Days_Indoors", [-0.1, 0.5, 2.5, 100], ["0_1", "2_3", "4_plus"]),
    "Mood_Bin": ("Mood_Swings", [-0.1, 0.5, 2.5, 4.5], ["0_1", "2_3", "4_plus"]),
    "Stress_Bin": ("Growing_Stress", [-0.1, 0.5, 2.5, 4.5], ["0_1", "2_3", "4_plus"]),
    "Frustration_Bin": ("Quarantine_Frustrations", [-0.1, 0.5, 2.5, 4.5], ["0_1", "2_3", "4_plus"]),
}
CODED_DUMMIES = [
    "Gender_Female", "Gender_Male",
    "Occupation_Corporate", "Occupation_Housewife", "Occupation_Others", "Occupation_Student",
    "Work_Interest_No", "Work_Interest_Yes",
    "Social_Weakness_Maybe", "Social_Weakness_No", "Social_Weakness_Yes",
]


def preprocess_coded(df: DataFrame, levels: dict[str, list[str]] | None = None) -> DataFrame:
    """Alphabetical category codes for the ordinal answers (NULL -> -1), all dummies,
    target code: the input of the coded bundle."""
    cols = ORDINAL_COLUMNS + NOMINAL_COLUMNS + [TARGET]
    levels = levels or fit_levels(df, cols)
    out = df.withColumns({c: category_code(c, levels[c]) for c in ORDINAL_COLUMNS + [TARGET]})
    return one_hot(out, NOMINAL_COLUMNS, drop_first=False,
                   levels={c: levels[c] for c in NOMINAL_COLUMNS})


def coded(df: DataFrame, on_unknown: str = "error",
          dummy_levels: dict[str, list[str]] | None = None) -> DataFrame:
    """B3P bundle on ``preprocess_coded`` output: right-closed bins ordinal-encoded with the
    given level order (unknown: error, or NULL with ``on_unknown='null'``), 0/1 one-hot of
    the listed dummies, ratios.  Output order is ordinal, one-hot, remainder, with names
    that match their values."""
    binned = {k: ordinal_from_levels(bin_right_closed(src, edges, labels, outside=None),
                                     labels, on_unknown)
              for k, (src, edges, labels) in CODED_BINS.items()}
    a = ratio_features("A")
    adv = {k: a[k] for k in ("Frustration_Stress_Ratio", "Frustration_Stress_Diff",
                             "Mood_Days_Product", "Weight_Med_History_Ratio", "Weight_x_History")}
    missing = [c for c in CODED_DUMMIES if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    lv = dummy_levels or fit_levels(df, CODED_DUMMIES)
    onehot = []
    for c in CODED_DUMMIES:
        for v in lv[c]:
            onehot.append(F.coalesce((_c(c).cast("string") == v).cast("int"), F.lit(0))
                          .alias(f"{c}_{v}"))
    out = df.withColumns(adv)
    rest = [c for c in out.columns if c not in CODED_DUMMIES]
    return out.select(*[v.alias(k) for k, v in binned.items()], *onehot, *rest)


# =========================================================================== years bundle
AGE_YEAR_EDGES = [0, 25, 40, 100]
AGE_YEAR_LABELS = ["0_25", "26_40", "41_plus"]


def preprocess_years(df: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """B4 input stage on a survey whose Age is text years (``survey_with_age_years``):
    the other ordinal answers become their numeric codes, every ordinal column is coerced
    to double (bad text -> NULL) and median-imputed; the target becomes its 0/1 code.
    Medians and target levels are fitted in one scan each; a continuous Age is no heavier."""
    def numeric(frame: DataFrame) -> DataFrame:
        cols = {c: ordinal_code(c, ORDINAL_MAPS[c]) for c in ORDINAL_COLUMNS if c != "Age"}
        cols["Age"] = coerce_numeric("Age")
        return frame.withColumns(cols)

    out = numeric(df)
    src = out if fit_on is None else numeric(fit_on)
    out = impute(out, fit_medians(src, ORDINAL_COLUMNS))
    return out.withColumn(TARGET, category_code(TARGET, fit_levels(src, [TARGET])[TARGET]))


def years(df: DataFrame, levels: dict[str, list[str]] | None = None) -> DataFrame:
    """B4 ``engineer_features``: B4 ratio forms, Age in years to right-closed groups
    (outside -> 'nan'), then dummies (all levels) of the four nominal columns and Age_Group."""
    out = df.withColumns(ratio_features("B4")).withColumn("Age_Group", _year_group())
    return one_hot(out, NOMINAL_COLUMNS + ["Age_Group"], drop_first=False, levels=levels)


def _year_group() -> Column:
    return bin_right_closed("Age", AGE_YEAR_EDGES, AGE_YEAR_LABELS, outside="nan")


def years_levels(df: DataFrame) -> dict[str, list[str]]:
    """The levels that ``years`` makes dummies of."""
    return fit_levels(df.withColumn("Age_Group", _year_group()), NOMINAL_COLUMNS + ["Age_Group"])
