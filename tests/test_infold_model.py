"""Features fitted inside a fold, the saved model, and the report on one label."""

import statistics

import pytest
from pyspark.sql import functions as F

from canopy.functions import encode as E
from canopy.functions import features as FE
from canopy.operators import metrics as MT
from canopy.operators import split as SP
from canopy.plans import infold as INF
from canopy.plans import search as S
from canopy.plans import survey_model as SM
from canopy.sources.survey import ID, SURVEY_SCHEMA, TARGET, load_survey, read_survey_csv
from tests.conftest import SF0001


@pytest.fixture(scope="module")
def survey(spark):
    return load_survey(spark, SF0001)


def test_folds_are_fitted_on_their_training_rows(spark, have_data, survey):
    folded = SP.kfold(survey, ID, 3).cache()
    medians, thresholds = INF.fit_folds(folded, 3)
    for f in range(3):
        train = folded.where(F.col("fold") != f).drop("fold")
        fitted = E.fit_preprocess(train)
        assert medians[f] == fitted["medians"]
        plain = FE.fit_base(E.preprocess(train, fitted=fitted))
        assert thresholds[f] == pytest.approx(plain)


def test_rows_carry_the_features_of_their_fold(spark, have_data, survey):
    frame = INF.infold_frame(survey, 3).cache()
    folded = SP.kfold(survey, ID, 3)
    for f in range(3):
        fitted = E.fit_preprocess(folded.where(F.col("fold") != f))
        fitted["levels"] = E.fit_preprocess(survey)["levels"]
        train = E.preprocess(folded.where(F.col("fold") != f), fitted=fitted)
        want = FE.base(E.preprocess(folded, fitted=fitted), FE.fit_base(train))
        got = frame.where(F.col(INF.FIT) == f).select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_no_row_for_a_fold(spark, survey):
    medians, thresholds = INF.fit_folds(SP.kfold(survey.limit(0), ID, 2), 2)
    assert all(v is None for fit in medians + thresholds for v in fit.values())


@pytest.mark.parametrize("bundle", SM.BUNDLES)
def test_saved_model_scores_as_before(spark, have_data, survey, tmp_path, bundle):
    train = survey.where(F.col(ID) % 3 != 0)
    model = SM.fit(train, S.Params(max_depth=4, min_samples_leaf=5), bundle)
    path = f"{tmp_path}/{bundle}"
    model.save(spark, path)
    back = SM.load(spark, path)
    assert (back.medians, back.levels, back.thresholds, back.age_groups) == (model.medians, model.levels, model.thresholds, model.age_groups)
    rows = lambda m: {r[ID]: (r["prob"], r["pred"]) for r in m.score(survey).select(ID, "prob", "pred").collect()}
    assert rows(back) == rows(model)
    with pytest.raises(Exception):
        model.save(spark, path)                      # a model is never overwritten


def test_scoring_needs_no_fit_and_takes_odd_rows(spark, have_data, survey, tmp_path):
    model = SM.fit(survey, S.Params(max_depth=3))
    nulls = survey.limit(3).select(ID, *[F.lit(None).cast("string").alias(c) for c in survey.columns if c != ID])
    odd = survey.limit(3).select(ID, *[F.lit("?").alias(c) for c in survey.columns if c != ID])
    got = model.score(nulls.unionByName(odd).withColumn("prob", F.lit(9.0)).withColumn("note", F.lit("kept"))).collect()
    assert len(got) == 6 and all(0 <= r["prob"] <= 1 and r["note"] == "kept" and r[TARGET] in (-1, None) for r in got)
    assert model.score(survey.limit(0)).count() == 0


def test_half_written_model_does_not_load(spark, have_data, survey, tmp_path):
    model = SM.fit(survey, S.Params(max_depth=2))
    model.save(spark, f"{tmp_path}/m")
    wrong = spark.read.parquet(f"{tmp_path}/m/parameters").where("kind <> 'version'")
    wrong.write.parquet(f"{tmp_path}/n/parameters")
    with pytest.raises(ValueError):
        SM.load(spark, f"{tmp_path}/n")
    with pytest.raises(Exception):
        SM.load(spark, f"{tmp_path}/absent")


def test_csv_columns_meet_by_name(spark, have_data, survey, tmp_path):
    survey.select(*reversed(survey.columns), F.lit("x").alias("extra")).write.option("header", True).csv(f"{tmp_path}/a")
    back = read_survey_csv(spark, f"{tmp_path}/a", SURVEY_SCHEMA)
    assert back.columns == SURVEY_SCHEMA.names and back.exceptAll(survey.select(*back.columns)).count() == 0
    survey.drop("Age").write.option("header", True).csv(f"{tmp_path}/b")
    with pytest.raises(ValueError, match="Age"):
        read_survey_csv(spark, f"{tmp_path}/b", SURVEY_SCHEMA)


def test_report_on_one_label(spark):
    y = [1, 1, 1, 0, 0, 1, 0]
    p = [1, 0, 1, 1, 0, 1, 1]
    df = spark.createDataFrame([("a", a, b) for a, b in zip(y, p)], "g string, y int, pred int")
    for label in (0, 1):
        rows = {r["label"]: r for r in MT.class_report(df, ["g"], labels=[label]).collect()}
        assert set(rows) == {str(label), "micro avg", "macro avg", "weighted avg"}
        hit = sum(a == b == label for a, b in zip(y, p))
        prec, rec = hit / p.count(label), hit / y.count(label)
        for r in rows.values():
            assert r["precision"] == pytest.approx(prec) and r["recall"] == pytest.approx(rec)
            assert r["f1_score"] == pytest.approx(statistics.harmonic_mean([prec, rec])) and r["support"] == y.count(label)
    assert MT.class_report(df, ["g"], labels=[0, 1]).exceptAll(MT.class_report(df, ["g"])).count() == 0
    with pytest.raises(ValueError):
        MT.class_report(df, ["g"], labels=[2])
