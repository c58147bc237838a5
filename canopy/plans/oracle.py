"""Oracle SQL (DuckDB dialect) for the registered queries.

Written independently of the DataFrame code: plain CTEs over the driver tables, window
``row_number`` for ranks, ``quantile_cont`` for exact quantiles.  Level lists come from the
fixed values in ``canopy.functions.encode``; the dummy levels present in the test tables
are spelled out below.
"""

from __future__ import annotations

from canopy.functions.encode import ORDINAL_COLUMNS, ORDINAL_MAPS
from canopy.functions.features import CODED_BINS, CODED_DUMMIES
from canopy.sources.survey import SURVEY_COLUMNS, SURVEY_SQL

ORD = ORDINAL_COLUMNS
NOMINAL_LEVELS = {
    "Gender": ["Female", "Male"],
    "Occupation": ["Business", "Corporate", "Housewife", "Others", "Student"],
    "Work_Interest": ["Maybe", "No", "Yes"],
    "Social_Weakness": ["Maybe", "No", "Yes"],
}
NOMINAL = list(NOMINAL_LEVELS)
EPS = "1e-9"


def _q(name: str) -> str:
    return '"' + name + '"'


def _case_code(col: str, levels: list[str], typ: str = "DOUBLE", other: str = "NULL") -> str:
    whens = " ".join(f"WHEN '{lv}' THEN {i}" for i, lv in enumerate(levels))
    return f"CAST(CASE {col} {whens} ELSE {other} END AS {typ})"


def _dummies(cols: list[str], drop_first: bool) -> list[str]:
    out = []
    for c in cols:
        lv = NOMINAL_LEVELS[c][1:] if drop_first else NOMINAL_LEVELS[c]
        out += [f"CAST(coalesce({c} = '{v}', false) AS INTEGER) AS {_q(c + '_' + v)}" for v in lv]
    return out


def _dummy_names(cols: list[str], drop_first: bool) -> list[str]:
    return [c + "_" + v for c in cols
            for v in (NOMINAL_LEVELS[c][1:] if drop_first else NOMINAL_LEVELS[c])]


def _round(cols: list[str]) -> str:
    return ", ".join(f"round({_q(c)}, 6) AS {_q(c)}" for c in cols)


TARGET_CODE = ("CAST(CASE WHEN Coping_Struggles IS NULL THEN -1 "
               "WHEN Coping_Struggles = 'No' THEN 0 WHEN Coping_Struggles = 'Yes' THEN 1 END AS INTEGER)")

CTE_SURVEY = f"survey AS ({SURVEY_SQL})"
CTE_MAPPED = ("mapped AS (SELECT respondent_id, "
              + ", ".join(f"{_case_code(c, ORDINAL_MAPS[c])} AS {c}" for c in ORD)
              + ", Gender, Occupation, Work_Interest, Social_Weakness, Coping_Struggles FROM survey)")
CTE_MED = "med AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in ORD) + " FROM mapped)"
CTE_IMP = ("imp AS (SELECT m.respondent_id, "
           + ", ".join(f"coalesce(m.{c}, med.{c}) AS {c}" for c in ORD)
           + ", m.Gender, m.Occupation, m.Work_Interest, m.Social_Weakness, m.Coping_Struggles "
             "FROM mapped m CROSS JOIN med)")
PP_DUMMIES = _dummy_names(NOMINAL, True)
CTE_PP = ("pp AS (SELECT respondent_id, " + ", ".join(ORD) + f", {TARGET_CODE} AS Coping_Struggles, "
          + ", ".join(_dummies(NOMINAL, True)) + " FROM imp)")
PP2_NOMINAL = ["Gender", "Occupation", "Social_Weakness"]
PP2_DUMMIES = _dummy_names(PP2_NOMINAL, True)
CTE_PP2 = ("pp2 AS (SELECT respondent_id, " + ", ".join(ORD)
           + ", CAST(CASE WHEN Work_Interest = 'Yes' THEN 1 ELSE 0 END AS INTEGER) AS Work_Interest, "
           + f"{TARGET_CODE} AS Coping_Struggles, " + ", ".join(_dummies(PP2_NOMINAL, True)) + " FROM imp)")
PP_COLS = ["respondent_id", *ORD, "Coping_Struggles", *PP_DUMMIES]


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE_PREFIX = [CTE_SURVEY, CTE_MAPPED, CTE_MED, CTE_IMP, CTE_PP]

# ---------------------------------------------------------------- base feature bundle
_S, _F, _M, _D = "Growing_Stress", "Quarantine_Frustrations", "Mood_Swings", "Days_Indoors"
_H, _W, _A, _C = "Mental_Health_History", "Weight_Change", "Age", "Changes_Habits"
_TOT = f"({_S} + {_F})"
_FRAC = f"({_F} / ({_D} + 1))"

CTE_THR = ("thr AS (SELECT "
           f"quantile_cont({_TOT}, 0.5) AS med_total, quantile_cont({_FRAC}, 0.5) AS med_frac, "
           f"quantile_cont({_TOT}, 0.33) AS tt33, quantile_cont({_TOT}, 0.66) AS tt66, "
           f"quantile_cont({_FRAC}, 0.33) AS ft33, quantile_cont({_FRAC}, 0.66) AS ft66, "
           f"quantile_cont({_M}, 0.33) AS mt33, quantile_cont({_M}, 0.66) AS mt66, "
           f"quantile_cont({_S}, 0.33) AS st33, quantile_cont({_S}, 0.66) AS st66 FROM pp)")


def _flag(cond: str) -> str:
    return f"CAST(coalesce({cond}, false) AS INTEGER)"


def _terc(x: str, lo: str, hi: str) -> str:
    return (f"CAST(CASE WHEN NOT ({hi} - {lo} > {EPS}) THEN 0 WHEN {x} <= {lo} + {EPS} THEN 0 "
            f"WHEN {x} <= {hi} + {EPS} THEN 1 WHEN {x} IS NOT NULL THEN 2 END AS INTEGER)")


BASE_FEATURES = {
    "High_Stress_Mood_Swings": _flag(f"{_S} >= 2 AND {_M} >= 2"),
    "Days_In_Frustration": _flag(f"{_D} >= 2 AND {_F} >= 2"),
    "Stress_Mood_Interaction": f"{_S} * {_M}",
    "Stress_Frustration_Interaction": f"{_S} * {_F}",
    "Total_Stress_Frustration": _TOT,
    "Frac_Frustration": _FRAC,
    "Mood_Squared": f"{_M} * {_M}",
    "Stress_Squared": f"{_S} * {_S}",
    "Frustration_Squared": f"{_F} * {_F}",
    "High_Total_Stress": _flag(f"{_TOT} > med_total + {EPS}"),
    "High_Frustration_Rate": _flag(f"{_FRAC} > med_frac + {EPS}"),
    "Total_Stress_Level": _terc(_TOT, "tt33", "tt66"),
    "Frac_Frustration_Level": _terc(_FRAC, "ft33", "ft66"),
    "Age_Weight_Interaction": f"{_A} * {_W}",
    "Log_Days_Indoors": f"ln(1 + {_D})",
    "Mental_Stress_Frustration_Score": f"{_H} + {_S} + {_F}",
    "Habit_Mood_Interaction": f"{_C} * {_M}",
    "WI_SW_Sum": "CAST((0 * 1 + Work_Interest_Yes * 2) * (Social_Weakness_No + Social_Weakness_Yes) AS INTEGER)",
    "Occupation_Count": ("CAST(Occupation_Corporate + Occupation_Housewife + Occupation_Others "
                         "+ Occupation_Student AS INTEGER)"),
    "Weight_Yes_Flag": _flag(f"{_W} = 2"),
    "Mood_Level": _terc(_M, "mt33", "mt66"),
    "Stress_Level": _terc(_S, "st33", "st66"),
    "Long_Time_Indoors": _flag(f"{_D} >= 3"),
}
BASE_DOUBLES = ["Stress_Mood_Interaction", "Stress_Frustration_Interaction", "Total_Stress_Frustration",
                "Frac_Frustration", "Mood_Squared", "Stress_Squared", "Frustration_Squared",
                "Age_Weight_Interaction", "Log_Days_Indoors", "Mental_Stress_Frustration_Score",
                "Habit_Mood_Interaction"]
CTE_FE = ("fe AS (SELECT pp.*, " + ", ".join(f"{v} AS {k}" for k, v in BASE_FEATURES.items())
          + " FROM pp CROSS JOIN thr)")
FE_COLS = PP_COLS + list(BASE_FEATURES)

RATIO_A = {
    "Frustration_Stress_Ratio": f"{_F} / ({_S} + 1)",
    "Frustration_Stress_SqRatio": f"({_F} * {_F}) / ({_S} + 1)",
    "Stress_Sq_Frustration": f"({_S} * {_S}) / ({_F} + 1)",
    "Frustration_Stress_Diff": f"{_F} - {_S}",
    "Mood_Days_Product": f"{_M} * {_D}",
    "Weight_Med_History_Ratio": f"{_W} / ({_H} + 1)",
    "Weight_x_History": f"{_W} * {_H}",
}
RATIO_B4 = {
    "Mood_Days_Product": f"{_M} * {_D}",
    "Weight_Med_History_Ratio": f"{_W} / ({_H} + 1)",
    "Frustration_Stress_Diff": f"{_F} - {_S}",
    "Stress_Sq_Frustration": f"{_S} * {_S} + {_F}",
    "Frustration_Stress_SqRatio": f"({_F} + 1) / ({_S} * {_S} + 1)",
    "Weight_x_History": f"{_W} * {_H}",
}
AGE_GROUPS = {"18_20": 0, "21_25": 1, "26_30": 2, "31_plus": 3}


def _sql_features_base() -> str:
    dbl = ORD + BASE_DOUBLES
    keep = [c for c in FE_COLS if c not in dbl]
    return (with_ctes(*BASE_PREFIX, CTE_THR, CTE_FE)
            + "SELECT " + ", ".join(_q(c) for c in keep) + ", " + _round(dbl) + " FROM fe")


BANDS4 = {
    "Indoor_0": _flag(f"{_D} = 0"), "Indoor_1": _flag(f"{_D} = 1"),
    "Indoor_2_3": _flag(f"{_D} >= 2 AND {_D} <= 3"), "Indoor_4_plus": _flag(f"{_D} >= 4"),
    "Mood_0_1": _flag(f"{_M} <= 1"), "Mood_2": _flag(f"{_M} = 2"),
    "Mood_3": _flag(f"{_M} = 3"), "Mood_4_plus": _flag(f"{_M} >= 4"),
    "Stress_0_1": _flag(f"{_S} <= 1"), "Stress_2": _flag(f"{_S} = 2"),
    "Stress_3": _flag(f"{_S} = 3"), "Stress_4_plus": _flag(f"{_S} >= 4"),
}
AGE_FLAGS = {f"Age_Group_{k}": _flag(f"Age = {v}") for k, v in AGE_GROUPS.items()}


def _as(cols: dict[str, str]) -> str:
    return ", ".join(f"{v} AS {k}" for k, v in cols.items())


CTE_B4 = f"band4 AS (SELECT {_as(AGE_FLAGS)}, pp.*, {_as(BANDS4)}, {_as(RATIO_A)} FROM pp)"
B4_FEATS = [*AGE_FLAGS, *ORD, *PP_DUMMIES, *BANDS4, *RATIO_A]


def _sql_banded4() -> str:
    keep = [c for c in PP_COLS if c not in ORD]
    return (with_ctes(*BASE_PREFIX, CTE_B4) + "SELECT " + ", ".join([*AGE_FLAGS, *keep]) + ", " + _round(ORD) + ", "
            + ", ".join(BANDS4) + ", " + _round(list(RATIO_A)) + " FROM band4")


BANDS3 = {f"{name}_{part}": _flag(f"{col} {cond.format(col)}") for name, col in (("Indoor", _D), ("Mood", _M), ("Stress", _S))
          for part, cond in (("Low", "<= 1"), ("Med", ">= 2 AND {} <= 3"), ("High", ">= 4"))}
RATIO_3 = {k: RATIO_A[k] for k in ("Frustration_Stress_Ratio", "Mood_Days_Product", "Weight_Med_History_Ratio")}
CTE_B3 = f"band3 AS (SELECT {_as(AGE_FLAGS)}, pp.*, {_as(BANDS3)}, {_as(RATIO_3)} FROM pp)"
B3_FEATS = [*AGE_FLAGS, *ORD, *PP_DUMMIES, *BANDS3, *RATIO_3]


def _sql_banded3() -> str:
    keep = [c for c in PP_COLS if c not in ORD]
    return (with_ctes(*BASE_PREFIX, CTE_B3) + "SELECT " + ", ".join([*AGE_FLAGS, *keep]) + ", " + _round(ORD) + ", "
            + ", ".join(BANDS3) + ", " + _round(list(RATIO_3)) + " FROM band3")


_ALPHA = {c: sorted(ORDINAL_MAPS[c]) for c in ORD}
CTE_CS = ("cs AS (SELECT respondent_id, " + ", ".join(f"{_case_code(c, _ALPHA[c], 'INTEGER', '-1')} AS {c}" for c in ORD)
          + f", {TARGET_CODE} AS Coping_Struggles, " + ", ".join(_dummies(NOMINAL, False)) + " FROM survey)")
CODED_BIN_SQL = {
    name: "CAST(CASE " + " ".join(f"WHEN {src} > {edges[i]} AND {src} <= {edges[i + 1]} THEN {i}" for i in range(len(labels)))
    + " END AS INTEGER)" for name, (src, edges, labels) in CODED_BINS.items()}
CODED_HOT = {f"{d}_{v}": _flag(f"{d} = {v}") for d in CODED_DUMMIES for v in (0, 1)}
CODED_REST = [c for c in _dummy_names(NOMINAL, False) if c not in CODED_DUMMIES]
CODED_RATIO = {k: RATIO_A[k] for k in ("Frustration_Stress_Ratio", "Frustration_Stress_Diff",
                                       "Mood_Days_Product", "Weight_Med_History_Ratio", "Weight_x_History")}
CTE_CODED = (f"coded AS (SELECT {_as(CODED_BIN_SQL)}, {_as(CODED_HOT)}, respondent_id, " + ", ".join(ORD) + ", Coping_Struggles, "
             + ", ".join(CODED_REST) + f", {_as(CODED_RATIO)} FROM cs)")
CODED_FEATS = [*CODED_BIN_SQL, *CODED_HOT, *ORD, *CODED_REST, *CODED_RATIO]


def _sql_coded() -> str:
    shown = {k: f"round({k}, 6)" if k in ("Frustration_Stress_Ratio", "Weight_Med_History_Ratio") else f"CAST({k} AS INTEGER)" for k in CODED_RATIO}
    plain = [*CODED_BIN_SQL, *CODED_HOT, "respondent_id", *ORD, "Coping_Struggles", *CODED_REST]
    return with_ctes(CTE_SURVEY, CTE_CS, CTE_CODED) + "SELECT " + ", ".join(plain) + f", {_as(shown)} FROM coded"


def _years_ctes() -> list[str]:
    ys = ("ys AS (SELECT respondent_id, CASE WHEN Age IS NULL THEN NULL ELSE CAST(16 + respondent_id % 90 AS DOUBLE) END AS Age, "
          + ", ".join(f"{_case_code(c, ORDINAL_MAPS[c])} AS {c}" for c in ORD if c != "Age")
          + ", Gender, Occupation, Work_Interest, Social_Weakness, Coping_Struggles FROM survey)")
    ymed = "ymed AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in ORD) + " FROM ys)"
    yimp = ("yimp AS (SELECT y.respondent_id, " + ", ".join(f"coalesce(y.{c}, m.{c}) AS {c}" for c in ORD)
            + ", y.Gender, y.Occupation, y.Work_Interest, y.Social_Weakness, y.Coping_Struggles "
              "FROM ys y CROSS JOIN ymed m)")
    grp = ("CASE WHEN Age > 0 AND Age <= 25 THEN '0_25' WHEN Age > 25 AND Age <= 40 THEN '26_40' "
           "WHEN Age > 40 AND Age <= 100 THEN '41_plus' ELSE 'nan' END")
    ages = [f"CAST(coalesce(({grp}) = '{v}', false) AS INTEGER) AS Age_Group_{v}" for v in AGE_BINS]
    yr = ("yr AS (SELECT respondent_id, " + ", ".join(ORD) + f", {TARGET_CODE} AS Coping_Struggles, " + _as(RATIO_B4) + ", "
          + ", ".join(_dummies(NOMINAL, False)) + ", " + ", ".join(ages) + " FROM yimp)")
    return [CTE_SURVEY, ys, ymed, yimp, yr]


AGE_BINS = ("0_25", "26_40", "41_plus", "nan")
YEAR_FEATS = [*ORD, *RATIO_B4, *_dummy_names(NOMINAL, False), *(f"Age_Group_{v}" for v in AGE_BINS)]


def _sql_years() -> str:
    plain = [c for c in YEAR_FEATS if c not in ORD and c not in RATIO_B4]
    return (with_ctes(*_years_ctes()) + "SELECT respondent_id, " + _round(ORD) + ", Coping_Struggles, "
            + _round(list(RATIO_B4)) + ", " + ", ".join(_q(c) for c in plain) + " FROM yr")


# ---------------------------------------------------------------- splits
_MD5 = "md5(concat('42:', CAST(respondent_id AS VARCHAR)))"
CTE_RANKED = ("ranked AS (SELECT respondent_id, Coping_Struggles, "
              f"row_number() OVER (PARTITION BY Coping_Struggles ORDER BY {_MD5}, respondent_id) AS r, "
              "count(*) OVER (PARTITION BY Coping_Struggles) AS n FROM survey)")


def _share(prefix: str, source: str, size: str, num: int, den: int, out: str) -> str:
    """Rows of each class in the first part: its total is fixed, then shared by largest remainder."""
    return (
        f"{prefix}1 AS (SELECT *, CAST(sum({size}) OVER () AS BIGINT) AS tot FROM {source}),\n"
        f"{prefix}2 AS (SELECT *, tot - ((tot * {num} + {den} - 1) // {den}) AS rest FROM {prefix}1),\n"
        f"{prefix}3 AS (SELECT *, (rest * {size}) // tot AS base, (rest * {size}) % tot AS rem FROM {prefix}2),\n"
        f"{prefix}4 AS (SELECT * EXCLUDE (tot, rest, base, rem), {size} - base - (CASE WHEN row_number() OVER (ORDER BY rem DESC, "
        f"Coping_Struggles NULLS FIRST) <= rest - CAST(sum(base) OVER () AS BIGINT) THEN 1 ELSE 0 END) AS {out} FROM {prefix}3)")


CTE_PARTS = ("cls AS (SELECT Coping_Struggles, count(*) AS n FROM survey GROUP BY Coping_Struggles),\n"
             + _share("pt", "cls", "n", 1, 5, "n_test") + ",\n"
             "lft AS (SELECT *, n - n_test AS n_left FROM pt4),\n" + _share("pv", "lft", "n_left", 1, 4, "n_val"))
CTE_2WAY = ("two AS (SELECT r.respondent_id, r.Coping_Struggles, CASE WHEN r.r <= p.n_test THEN 'test' ELSE 'train' END AS split "
            "FROM ranked r JOIN pv4 p ON r.Coping_Struggles IS NOT DISTINCT FROM p.Coping_Struggles)")
CTE_3WAY = ("three AS (SELECT r.respondent_id, r.Coping_Struggles, CASE WHEN r.r <= p.n_test THEN 'test' "
            "WHEN r.r <= p.n_test + p.n_val THEN 'val' ELSE 'train' END AS split "
            "FROM ranked r JOIN pv4 p ON r.Coping_Struggles IS NOT DISTINCT FROM p.Coping_Struggles)")


def _sql_contiguous(k: int = 5) -> str:
    cls = ("cls AS (SELECT Coping_Struggles, n, coalesce(sum(n) OVER (ORDER BY first_id "
           "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM "
           "(SELECT Coping_Struggles, count(*) AS n, min(respondent_id) AS first_id FROM survey GROUP BY Coping_Struggles))")
    cum = []
    for i in range(k - 1):
        parts = [f"(floor((s + n - 1 - {f} + {k}) / {k}) - floor((s - 1 - {f} + {k}) / {k}))"
                 for f in range(i + 1)]
        cum.append("(" + " + ".join(parts) + f") AS c{i}")
    cls2 = "cls2 AS (SELECT Coping_Struggles, " + ", ".join(cum) + " FROM cls)"
    rk = ("rk AS (SELECT respondent_id, Coping_Struggles, row_number() OVER (PARTITION BY "
          "Coping_Struggles ORDER BY respondent_id) AS r FROM survey)")
    case = "CASE " + " ".join(f"WHEN r <= c{i} THEN {i}" for i in range(k - 1)) + f" ELSE {k - 1} END"
    return (with_ctes(CTE_SURVEY, cls, cls2, rk)
            + f"SELECT respondent_id, Coping_Struggles, CAST({case} AS INTEGER) AS fold "
              "FROM rk JOIN cls2 USING (Coping_Struggles)")


# ---------------------------------------------------------------- metrics
CTE_SCORED = (
    "sc0 AS (SELECT i.respondent_id, CAST(CASE WHEN i.Coping_Struggles = 'Yes' THEN 1 ELSE 0 END AS INTEGER) AS y, "
    "(i.Mental_Health_History + i.Growing_Stress + i.Quarantine_Frustrations) / 6.0 AS prob, "
    "CAST((r.r - 1) % 5 AS INTEGER) AS fold FROM imp i JOIN ranked r USING (respondent_id)),\n"
    "sc AS (SELECT respondent_id, y, prob, CAST(prob > 0.5 AS INTEGER) AS pred, fold FROM sc0 "
    "UNION ALL SELECT respondent_id, y, prob, CAST(prob > 0.5 AS INTEGER) AS pred, -1 AS fold FROM sc0)")
METRIC_PREFIX = [CTE_SURVEY, CTE_MAPPED, CTE_MED, CTE_IMP, CTE_RANKED, CTE_SCORED]
CTE_CC = ("cc AS (SELECT fold, "
          "CAST(sum(CASE WHEN y = 0 AND pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn, "
          "CAST(sum(CASE WHEN y = 0 AND pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp, "
          "CAST(sum(CASE WHEN y = 1 AND pred = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn, "
          "CAST(sum(CASE WHEN y = 1 AND pred = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp FROM sc GROUP BY fold)")
CTE_CUM = (
    "cnt AS (SELECT fold, prob AS score, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg "
    "FROM sc GROUP BY fold, prob),\n"
    "tot AS (SELECT *, sum(pos) OVER (PARTITION BY fold) AS P, sum(neg) OVER (PARTITION BY fold) AS N FROM cnt),\n"
    "cum AS (SELECT *, sum(pos) OVER (PARTITION BY fold ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND CURRENT ROW) AS tp, sum(neg) OVER (PARTITION BY fold ORDER BY score DESC ROWS BETWEEN UNBOUNDED "
    "PRECEDING AND CURRENT ROW) AS fp, row_number() OVER (PARTITION BY fold ORDER BY score DESC) AS i FROM tot)")


def _sd(a: str, b: str) -> str:
    return f"(CASE WHEN {b} > 0 THEN {a} / {b} ELSE 0.0 END)"


def _sql_class_report() -> str:
    p1, r1 = _sd("tp", "(tp + fp)"), _sd("tp", "(tp + fn)")
    p0, r0 = _sd("tn", "(tn + fn)"), _sd("tn", "(tn + fp)")
    base = (f"cr AS (SELECT fold, tn, fp, fn, tp, {p0} AS p0, {r0} AS r0, {p1} AS p1, {r1} AS r1, "
            "tn + fp AS s0, tp + fn AS s1, tn + fp + tp + fn AS n FROM cc),\n"
            f"cr2 AS (SELECT *, {_sd('2 * p0 * r0', '(p0 + r0)')} AS f0, {_sd('2 * p1 * r1', '(p1 + r1)')} AS f1 FROM cr)")
    rows = [
        "SELECT fold, '0' AS label, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM cr2",
        "SELECT fold, '1', p1, r1, f1, s1 FROM cr2",
        f"SELECT fold, 'accuracy', NULL, NULL, {_sd('(tp + tn)', 'n')}, n FROM cr2",
        "SELECT fold, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM cr2",
        (f"SELECT fold, 'weighted avg', {_sd('(p0 * s0 + p1 * s1)', 'n')}, {_sd('(r0 * s0 + r1 * s1)', 'n')}, "
         f"{_sd('(f0 * s0 + f1 * s1)', 'n')}, n FROM cr2"),
    ]
    return (with_ctes(*METRIC_PREFIX, CTE_CC, base)
            + "SELECT fold, label, round(CAST(precision AS DOUBLE), 6) AS precision, "
              "round(CAST(recall AS DOUBLE), 6) AS recall, round(CAST(f1_score AS DOUBLE), 6) AS f1_score, "
              "CAST(support AS BIGINT) AS support FROM (" + " UNION ALL ".join(rows) + ")")


def _sql_class_report_subset() -> str:
    p, r = _sd("tp", "(tp + fp)"), _sd("tp", "(tp + fn)")
    return (with_ctes(*METRIC_PREFIX, CTE_CC, f"cr AS (SELECT fold, {p} AS p, {r} AS r, tp + fn AS s FROM cc)")
            + f"SELECT fold, label, round(CAST(p AS DOUBLE), 6) AS precision, round(CAST(r AS DOUBLE), 6) AS recall, "
              f"round(CAST({_sd('2 * p * r', '(p + r)')} AS DOUBLE), 6) AS f1_score, CAST(s AS BIGINT) AS support "
              "FROM cr, (VALUES ('1'), ('micro avg'), ('macro avg'), ('weighted avg')) l(label)")


def _sql_roc_curve() -> str:
    flt = ("flt AS (SELECT * FROM (SELECT *, lag(tp) OVER o AS ptp, lead(tp) OVER o AS ntp, lag(fp) OVER o AS pfp, "
           "lead(fp) OVER o AS nfp FROM cum WINDOW o AS (PARTITION BY fold ORDER BY i)) "
           "WHERE ptp IS NULL OR ntp IS NULL OR ntp - 2 * tp + ptp <> 0 OR nfp - 2 * fp + pfp <> 0)")
    pts = ("pts AS (SELECT fold, score AS threshold, tp, fp, P, N, i FROM flt UNION ALL "
           "SELECT fold, CAST('infinity' AS DOUBLE), 0, 0, P, N, 0 FROM cum WHERE i = 1)")
    return (with_ctes(*METRIC_PREFIX, CTE_CUM, flt, pts)
            + "SELECT fold, CAST(row_number() OVER (PARTITION BY fold ORDER BY i) - 1 AS INTEGER) AS point, "
              "round(threshold, 6) AS threshold, round(CASE WHEN N > 0 THEN fp / N END, 6) AS fpr, "
              "round(CASE WHEN P > 0 THEN tp / P END, 6) AS tpr FROM pts")


def _sql_roc_auc() -> str:
    nb = ("nb AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY fold ORDER BY score ROWS BETWEEN "
          "UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM tot)")
    return (with_ctes(*METRIC_PREFIX, CTE_CUM, nb)
            + "SELECT fold, round(CASE WHEN max(P) > 0 AND max(N) > 0 THEN "
              "sum(pos * (neg_below + 0.5 * neg)) / (max(P) * max(N)) END, 6) AS roc_auc FROM nb GROUP BY fold")


def _sql_pr_curve() -> str:
    return (with_ctes(*METRIC_PREFIX, CTE_CUM)
            + "SELECT fold, CAST(i AS INTEGER) AS point, round(score, 6) AS threshold, "
              "round(tp / (tp + fp), 6) AS precision, "
              "round(CASE WHEN P > 0 THEN tp / P ELSE CAST(1 AS DOUBLE) END, 6) AS recall FROM cum "
              "UNION ALL SELECT fold, 0, CAST(NULL AS DOUBLE), CAST(1 AS DOUBLE), CAST(0 AS DOUBLE) "
              "FROM cum WHERE i = 1")


def _sql_average_precision() -> str:
    return (with_ctes(*METRIC_PREFIX, CTE_CUM)
            + "SELECT fold, round(CASE WHEN max(P) > 0 THEN sum((pos / P) * (tp / (tp + fp))) END, 6) "
              "AS average_precision FROM cum GROUP BY fold")


# ---------------------------------------------------------------- profiles
def _sql_null_report() -> str:
    parts = [f"SELECT 'raw' AS stage, '{c}' AS column_name, CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) "
             f"AS BIGINT) AS n_null FROM survey" for c in SURVEY_COLUMNS]
    parts += [f"SELECT 'mapped', '{c}', CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM mapped"
              for c in ORD]
    parts += [f"SELECT 'imputed', '{c}', CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM imp"
              for c in ORD]
    return with_ctes(CTE_SURVEY, CTE_MAPPED, CTE_MED, CTE_IMP) + " UNION ALL ".join(parts)


_SURVEY_LONG = ("lng AS (SELECT column_name, value FROM (UNPIVOT (SELECT "
                + ", ".join(SURVEY_COLUMNS) + " FROM survey) ON " + ", ".join(SURVEY_COLUMNS)
                + " INTO NAME column_name VALUE value))")
_FREQ = ("freq AS (SELECT column_name, value, count(*) AS n FROM lng WHERE value IS NOT NULL "
         "GROUP BY column_name, value)")


def _unpivot(src: str, keys: list[str], cols: list[str], name: str = "column_name",
             value: str = "value") -> str:
    k = ", ".join(keys) + ", " if keys else ""
    return (f"(UNPIVOT (SELECT {k}" + ", ".join(f"CAST({_q(c)} AS DOUBLE) AS {_q(c)}" for c in cols)
            + f" FROM {src}) ON " + ", ".join(_q(c) for c in cols) + f" INTO NAME {name} VALUE {value})")


def _sql_group_means(src_cte: list[str], src: str, target: str, cols: list[str]) -> str:
    return (with_ctes(*src_cte) + f"SELECT {target}, column_name, round(avg(value), 6) AS mean FROM "
            + _unpivot(src, [target], cols) + f" WHERE {target} IS NOT NULL GROUP BY {target}, column_name")


def _sql_bootstrap(cols: list[str], n_boot: int = 1000, seed: int = 42) -> str:
    cells = ("cells AS (SELECT Coping_Struggles, column_name, value, CAST(count(*) AS DOUBLE) AS n FROM "
             + _unpivot("pp", ["Coping_Struggles"], cols) + " WHERE Coping_Struggles IS NOT NULL GROUP BY ALL)")
    hashed = (f"hashed AS (SELECT *, md5(concat('{seed}:', Coping_Struggles, ':', column_name, ':', value, ':', rep)) AS h "
              f"FROM cells CROSS JOIN (SELECT unnest(range(1, {n_boot + 1})) AS rep))")
    u = ("u AS (SELECT *, (CAST('0x' || substr(h, 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0 AS u1, "
         "(CAST('0x' || substr(h, 14, 13) AS BIGINT) + 0.5) / 4503599627370496.0 AS u2 FROM hashed)")
    pmf = ("pmf AS (SELECT Coping_Struggles, column_name, value, k, exp(k * ln(n) - n - lgamma(k + 1)) AS p FROM (SELECT *, "
           "unnest(range(0, CAST(floor(n + 12 * sqrt(n) + 30) AS BIGINT) + 1)) AS k FROM cells WHERE n < 500))")
    cdf = ("cdf AS (SELECT *, sum(p) OVER (PARTITION BY Coping_Struggles, column_name, value ORDER BY k) AS c FROM pmf)")
    small = ("small AS (SELECT u.Coping_Struggles, u.column_name, u.value, rep, count(*) FILTER (WHERE c < u1) AS w FROM u "
             "JOIN cdf USING (Coping_Struggles, column_name, value) WHERE n < 500 GROUP BY ALL)")
    large = ("large AS (SELECT Coping_Struggles, column_name, value, rep, CAST(greatest(ceil(n + sqrt(n) * z + (z * z - 1) / 6 "
             "+ (z - z * z * z) / (72 * sqrt(n)) - 0.5), 0) AS BIGINT) AS w FROM (SELECT *, "
             "sqrt(-2 * ln(u1)) * cos(2 * pi() * u2) AS z FROM u WHERE n >= 500))")
    boot = ("boot AS (SELECT Coping_Struggles, column_name, rep, sum(w * value) / nullif(sum(w), 0) AS m FROM "
            "(SELECT * FROM small UNION ALL SELECT * FROM large) GROUP BY ALL)")
    ci = ("ci AS (SELECT Coping_Struggles, column_name, quantile_cont(m, 0.025) AS lo, quantile_cont(m, 0.975) AS hi "
          "FROM boot GROUP BY ALL)")
    means = ("means AS (SELECT Coping_Struggles, column_name, sum(n * value) / sum(n) AS m FROM cells GROUP BY ALL)")
    return (with_ctes(*BASE_PREFIX, cells, hashed, u, pmf, cdf, small, large, boot, ci, means)
            + "SELECT Coping_Struggles, column_name, round(m, 6) AS mean, round(lo, 6) AS ci_low, round(hi, 6) AS ci_high "
              "FROM means JOIN ci USING (Coping_Struggles, column_name)")


def _sql_box_stats() -> str:
    lng = "lng AS (SELECT * FROM " + _unpivot("pp", ["Coping_Struggles"], ORD) + ")"
    st = ("st AS (SELECT Coping_Struggles, column_name, count(*) AS n, quantile_cont(value, 0.25) AS q1, "
          "quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM lng GROUP BY ALL)")
    return (with_ctes(*BASE_PREFIX, lng, st)
            + "SELECT s.Coping_Struggles, s.column_name, s.n, round(q1, 6) AS q1, round(median, 6) AS median, "
              "round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr, "
              "round(min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low, "
              "round(max(value) FILTER (WHERE value <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high, "
              "CAST(count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS BIGINT) "
              "AS n_outliers FROM st s JOIN lng l USING (Coping_Struggles, column_name) "
              "GROUP BY s.Coping_Struggles, s.column_name, s.n, q1, median, q3")


def _sql_density_grid(gridsize: int = 100) -> str:
    lng = "lng AS (SELECT * FROM " + _unpivot("pp", ["Coping_Struggles"], ORD) + ")"
    vc = "vc AS (SELECT Coping_Struggles, column_name, value, count(*) AS n FROM lng GROUP BY ALL)"
    st = ("st AS (SELECT Coping_Struggles, column_name, CAST(sum(n) AS BIGINT) AS n_obs, sum(n * value) AS s1, "
          "sum(n * value * value) AS s2, min(value) AS vmin, max(value) AS vmax FROM vc GROUP BY ALL)")
    q = ("q AS (SELECT Coping_Struggles, column_name, quantile_cont(value, 0.25) AS q1, "
         "quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM lng GROUP BY ALL)")
    bw = ("bw AS (SELECT *, vmin - 2.0 * bw AS lo, vmax + 2.0 * bw AS hi FROM (SELECT *, CASE WHEN var > 1e-12 "
          "THEN sqrt(var) * pow(n_obs, -0.2) END AS bw FROM (SELECT *, (s2 - s1 * s1 / n_obs) / (n_obs - 1) "
          "AS var FROM st)))")
    grid = (f"grid AS (SELECT b.*, CAST(p.point AS INTEGER) AS point, lo + (hi - lo) * p.point / {float(gridsize - 1)} "
            f"AS x FROM bw b CROSS JOIN (SELECT range AS point FROM range(0, {gridsize})) p)")
    return (with_ctes(*BASE_PREFIX, lng, vc, st, q, bw, grid)
            + "SELECT g.Coping_Struggles, g.column_name, g.point, round(g.x, 6) AS x, "
              "round(sum(v.n * exp(-0.5 * ((g.x - v.value) / g.bw) * ((g.x - v.value) / g.bw))) "
              "/ (g.n_obs * g.bw * sqrt(2 * pi())), 6) AS density, "
              "round(q.q1, 6) AS q1, round(q.median, 6) AS median, round(q.q3, 6) AS q3 "
              "FROM grid g JOIN vc v USING (Coping_Struggles, column_name) "
              "JOIN q USING (Coping_Struggles, column_name) "
              "GROUP BY g.Coping_Struggles, g.column_name, g.point, g.x, g.n_obs, g.bw, q.q1, q.median, q.q3")


def _sql_corr_matrix(cols: list[str], prefix: list[str] | None = None, src: str = "pp") -> str:
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    aggs = ", ".join(f"coalesce(corr(CAST({_q(a)} AS DOUBLE), CAST({_q(b)} AS DOUBLE)), 'NaN'::DOUBLE) "
                     f"AS {_q(a + '|' + b)}" for a, b in pairs)
    up = ("up AS (SELECT split_part(pair, '|', 1) AS col_a, split_part(pair, '|', 2) AS col_b, "
          "round(CASE WHEN isnan(c) THEN NULL ELSE c END, 6) AS corr FROM (UNPIVOT (SELECT " + aggs
          + f" FROM {src}) ON COLUMNS(*) INTO NAME pair VALUE c) )")
    return (with_ctes(*(prefix or BASE_PREFIX), up)
            + "SELECT col_a, col_b, corr FROM up UNION ALL SELECT col_b, col_a, corr FROM up WHERE col_a <> col_b")


def _sql_corr_with_target(prefix: list[str], src: str, cols: list[str], target: str = "Coping_Struggles") -> str:
    aggs = ", ".join(f"coalesce(corr(CAST({_q(c)} AS DOUBLE), CAST({target} AS DOUBLE)), 'NaN'::DOUBLE) "
                     f"AS {_q(c)}" for c in cols)
    return (with_ctes(*prefix) + "SELECT column_name, round(CASE WHEN isnan(c) THEN NULL ELSE c END, 6) AS corr "
            "FROM (UNPIVOT (SELECT " + aggs + f" FROM {src}) ON COLUMNS(*) INTO NAME column_name VALUE c)")


NUMERIC_PP = [c for c in PP_COLS if c != "respondent_id"]
NUMERIC_FE = [c for c in FE_COLS if c != "respondent_id"]
PP2_COLS = ["respondent_id", *ORD, "Work_Interest", "Coping_Struggles", *PP2_DUMMIES]
NUMERIC_PP2 = [c for c in PP2_COLS if c != "respondent_id"]


def oracle_sql() -> dict[str, str]:
    pre = with_ctes(*BASE_PREFIX)
    return {
        "null_report": _sql_null_report(),
        "target_code": with_ctes(CTE_SURVEY) + (
            "SELECT respondent_id, CAST(CASE WHEN Coping_Struggles IS NULL THEN -1 ELSE "
            "dense_rank() OVER (ORDER BY Coping_Struggles) - 1 END AS INTEGER) AS Coping_Struggles FROM survey"),
        "ordinal_encode": with_ctes(CTE_SURVEY, CTE_MAPPED) + "SELECT respondent_id, " + ", ".join(ORD) + " FROM mapped",
        "median_impute": with_ctes(CTE_SURVEY, CTE_MAPPED, CTE_MED, CTE_IMP)
        + "SELECT respondent_id, " + _round(ORD) + " FROM imp",
        "onehot_drop_first": with_ctes(CTE_SURVEY) + "SELECT respondent_id, " + ", ".join(_dummies(NOMINAL, True))
        + " FROM survey",
        "onehot_all": with_ctes(CTE_SURVEY) + "SELECT respondent_id, " + ", ".join(_dummies(NOMINAL, False))
        + " FROM survey",
        "preprocessed": pre + "SELECT respondent_id, " + _round(ORD) + ", Coping_Struggles, "
        + ", ".join(_q(c) for c in PP_DUMMIES) + " FROM pp",
        "preprocessed_work_interest": with_ctes(*BASE_PREFIX[:-1], CTE_PP2) + "SELECT respondent_id, "
        + _round(ORD) + ", Work_Interest, Coping_Struggles, " + ", ".join(_q(c) for c in PP2_DUMMIES) + " FROM pp2",
        "head_sample": pre + "SELECT respondent_id, " + _round(ORD) + ", Coping_Struggles, "
        + ", ".join(_q(c) for c in PP_DUMMIES) + " FROM pp ORDER BY respondent_id LIMIT 5",
        "features_csv_roundtrip": _sql_features_base(),
        "frequency": with_ctes(CTE_SURVEY, _SURVEY_LONG, _FREQ)
        + "SELECT column_name, value, n, round(CAST(100 AS DOUBLE) * n / sum(n) OVER (PARTITION BY column_name), 6) "
          "AS pct FROM freq",
        "mode_per_column": with_ctes(CTE_SURVEY, _SURVEY_LONG, _FREQ)
        + "SELECT column_name, value AS mode_value, n FROM (SELECT *, row_number() OVER (PARTITION BY column_name "
          "ORDER BY n DESC, value) AS rk FROM freq) WHERE rk = 1",
        "pivot_age_gender": with_ctes(CTE_SURVEY)
        + "SELECT Age, count(Mental_Health_History) FILTER (WHERE Gender = 'Female') AS Female, "
          "count(Mental_Health_History) FILTER (WHERE Gender = 'Male') AS Male FROM survey "
          "WHERE Age IS NOT NULL AND Gender IS NOT NULL GROUP BY Age",
        "crosstab_two_key": with_ctes(CTE_SURVEY)
        + "SELECT Age, Gender, " + ", ".join(f"count(*) FILTER (WHERE Growing_Stress = '{v}') AS {v}"
                                             for v in ("Maybe", "No", "Yes"))
        + ", concat_ws('-', Age, Gender) AS row_label FROM survey WHERE Age IS NOT NULL AND Gender IS NOT NULL "
          "AND Growing_Stress IS NOT NULL GROUP BY Age, Gender",
        "crosstab_by_level": with_ctes(CTE_SURVEY)
        + "SELECT Growing_Stress, Age, " + ", ".join(f"count(*) FILTER (WHERE Occupation = '{v}') AS {v}"
                                                     for v in NOMINAL_LEVELS["Occupation"])
        + " FROM survey WHERE Growing_Stress IS NOT NULL AND Age IS NOT NULL AND Occupation IS NOT NULL "
          "GROUP BY Growing_Stress, Age",
        "group_means_bootstrap": _sql_bootstrap(PP_DUMMIES),
        "group_means": _sql_group_means(BASE_PREFIX, "pp", "Coping_Struggles", PP_DUMMIES),
        "group_means_work_interest": _sql_group_means(BASE_PREFIX[:-1] + [CTE_PP2], "pp2", "Work_Interest",
                                                      PP2_DUMMIES),
        "box_stats": _sql_box_stats(),
        "density_grid": _sql_density_grid(),
        "corr_matrix": _sql_corr_matrix(NUMERIC_PP),
        "corr_with_target": _sql_corr_with_target(BASE_PREFIX, "pp", NUMERIC_PP),
        "corr_with_target_features": _sql_corr_with_target(BASE_PREFIX + [CTE_THR, CTE_FE], "fe", NUMERIC_FE),
        "corr_matrix_features": _sql_corr_matrix(NUMERIC_FE, BASE_PREFIX + [CTE_THR, CTE_FE], "fe"),
        "corr_with_work_interest": _sql_corr_with_target(BASE_PREFIX[:-1] + [CTE_PP2], "pp2", NUMERIC_PP2,
                                                         "Work_Interest"),
        "features_base": _sql_features_base(),
        "features_banded3": _sql_banded3(),
        "features_banded4": _sql_banded4(),
        "features_coded": _sql_coded(),
        "features_years": _sql_years(),
        "holdout_split": with_ctes(CTE_SURVEY, CTE_RANKED, CTE_PARTS, CTE_2WAY) + "SELECT * FROM two",
        "three_way_split": with_ctes(CTE_SURVEY, CTE_RANKED, CTE_PARTS, CTE_3WAY) + "SELECT * FROM three",
        "split_shares": with_ctes(CTE_SURVEY, CTE_RANKED, CTE_PARTS, CTE_3WAY)
        + "SELECT split, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM three GROUP BY split",
        "kfold": with_ctes(CTE_SURVEY)
        + f"SELECT respondent_id, CAST((row_number() OVER (ORDER BY {_MD5}, respondent_id) - 1) % 5 AS INTEGER) "
          "AS fold FROM survey",
        "stratified_kfold": with_ctes(CTE_SURVEY, CTE_RANKED)
        + "SELECT respondent_id, Coping_Struggles, CAST((r - 1) % 5 AS INTEGER) AS fold FROM ranked",
        "contiguous_kfold": _sql_contiguous(),
        "confusion_matrix": with_ctes(*METRIC_PREFIX, CTE_CC)
        + "SELECT fold, 0 AS y, 0 AS pred, tn AS n FROM cc UNION ALL SELECT fold, 0, 1, fp FROM cc "
          "UNION ALL SELECT fold, 1, 0, fn FROM cc UNION ALL SELECT fold, 1, 1, tp FROM cc",
        "class_report": _sql_class_report(),
        "class_report_subset": _sql_class_report_subset(),
        "accuracy": with_ctes(*METRIC_PREFIX)
        + "SELECT fold, round(avg(CAST(y = pred AS DOUBLE)), 6) AS accuracy FROM sc GROUP BY fold",
        "roc_curve": _sql_roc_curve(),
        "roc_auc": _sql_roc_auc(),
        "pr_curve": _sql_pr_curve(),
        "average_precision": _sql_average_precision(),
    }
