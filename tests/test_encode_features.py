"""Hand-worked frames for the encoders and feature formulas (nulls, ties, edges)."""

import math

from pyspark.sql import functions as F

from canopy.functions import encode as E
from canopy.functions import features as FE


def test_ordinal_unknown_and_null_give_null(spark):
    df = spark.createDataFrame([("16-20",), ("30-Above",), ("weird",), (None,)], "Age string")
    out = [r[0] for r in df.select(E.ordinal_code("Age", E.AGE_LEVELS)).collect()]
    assert out == [0.0, 3.0, None, None]


def test_median_even_count_is_fractional_and_all_null_column_stays_null(spark):
    df = spark.createDataFrame([(0.0, None), (1.0, None), (None, None), (3.0, None)],
                               "a double, b double")
    med = E.fit_medians(df, ["a", "b"])
    assert med["a"] == 1.0 and med["b"] is None
    df2 = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (3.0,)], "a double")
    assert E.fit_medians(df2, ["a"])["a"] == 1.5
    filled = E.impute(df, med).collect()
    assert [r["a"] for r in filled] == [0.0, 1.0, 1.0, 3.0]
    assert all(r["b"] is None for r in filled)


def test_category_code_and_dummies(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "g string")
    lv = E.fit_levels(df, ["g"])["g"]
    assert lv == ["a", "b", "c"]
    codes = [r[0] for r in df.select(E.category_code("g", lv)).collect()]
    assert codes == [1, 0, -1, 2]
    oh = E.one_hot(df, ["g"], drop_first=True, levels={"g": lv})
    assert oh.columns == ["g_b", "g_c"]
    assert [tuple(r) for r in oh.collect()] == [(1, 0), (0, 0), (0, 0), (0, 1)]


def test_right_closed_bins_and_outside(spark):
    df = spark.createDataFrame([(0.0,), (25.0,), (40.0,), (100.0,), (101.0,), (None,)], "Age double")
    out = [r[0] for r in df.select(E.bin_right_closed("Age", FE.AGE_YEAR_EDGES, FE.AGE_YEAR_LABELS)).collect()]
    assert out == ["nan", "0_25", "26_40", "41_plus", "nan", "nan"]


def test_ordinal_from_levels_unknown_raises_or_nulls(spark):
    df = spark.createDataFrame([("0_1",), ("4_plus",), (None,)], "b string")
    lv = ["0_1", "2_3", "4_plus"]
    assert [r[0] for r in df.select(E.ordinal_from_levels("b", lv, "null")).collect()] == [0, 2, None]
    try:
        df.select(E.ordinal_from_levels("b", lv, "error")).collect()
    except Exception as e:  # noqa: BLE001
        assert "unknown category" in str(e)
    else:
        raise AssertionError("expected an error for the NULL category")


def test_tercile_equal_quantiles_give_zero_and_noise_is_tolerated(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (1.0,), (2.0,)], "x double")
    assert [r[0] for r in df.select(FE.tercile_level(F.col("x"), 1.0, 1.0)).collect()] == [0, 0, 0, 0]
    # a threshold just above/below an integer value keeps the value on the same side
    got = [r[0] for r in df.select(FE.tercile_level(F.col("x"), 0.9999999999999998, 2.0000000000000004)).collect()]
    assert got == [0, 0, 0, 1]


def test_base_bundle_formulas(spark):
    row = {"Age": 2.0, "Days_Indoors": 3.0, "Growing_Stress": 2.0, "Quarantine_Frustrations": 2.0,
           "Changes_Habits": 1.0, "Mental_Health_History": 0.0, "Weight_Change": 2.0, "Mood_Swings": 2.0,
           "Work_Interest_No": 0, "Work_Interest_Yes": 1, "Social_Weakness_No": 1, "Social_Weakness_Yes": 0,
           "Occupation_Corporate": 1, "Occupation_Student": 0}
    df = spark.createDataFrame([row, {**row, "Growing_Stress": 0.0, "Mood_Swings": None}])
    out = FE.base(df).collect()
    r0, r1 = out[0], out[1]
    assert r0["High_Stress_Mood_Swings"] == 1 and r1["High_Stress_Mood_Swings"] == 0  # NULL compares false
    assert r0["Days_In_Frustration"] == 1
    assert math.isclose(r0["Frac_Frustration"], 0.5)
    assert math.isclose(r0["Log_Days_Indoors"], math.log1p(3.0))
    assert r0["WI_SW_Sum"] == 2 and r0["Occupation_Count"] == 1
    assert r0["Weight_Yes_Flag"] == 1 and r0["Long_Time_Indoors"] == 1
    assert r0["Mental_Stress_Frustration_Score"] == 4.0


def test_bootstrap_interval_matches_binomial_width(spark):
    import random

    from canopy.operators import profile as PR

    rnd = random.Random(4)
    rows = [(i, i % 2, int(rnd.random() < 0.3)) for i in range(4000)]
    df = spark.createDataFrame(rows, "rid long, t int, d int")
    r = {x["t"]: x for x in PR.group_means_bootstrap(df, "t", ["d"], n_boot=400).collect()}
    for t, x in r.items():
        p, n = x["mean"], 2000
        se = math.sqrt(p * (1 - p) / n)
        assert x["ci_low"] < p < x["ci_high"]
        assert abs((x["ci_high"] - x["ci_low"]) - 2 * 1.96 * se) < 0.35 * 2 * 1.96 * se
