"""Sources, sinks and the streaming scorer."""

import pytest
from pyspark.sql import functions as F

from canopy.functions import features as FE
from canopy.operators import tree as TR
from canopy.plans import search as S
from canopy.sources import sinks as SK
from canopy.sources.survey import SURVEY_SCHEMA, load_survey, read_survey_csv
from canopy.streaming import score as SS
from tests.conftest import SF0001


def test_csv_na_tokens_become_null(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_text("respondent_id,Age,Gender\n1,16-20,NA\n2,,Male\n3,N/A,null\n")
    df = read_survey_csv(spark, str(p))
    rows = sorted(df.collect(), key=lambda r: r["respondent_id"])
    assert rows[0]["Gender"] is None and rows[1]["Age"] is None
    assert rows[2]["Age"] is None and rows[2]["Gender"] is None


def test_csv_sink_roundtrip_and_missing_path(spark, tmp_path, have_data):
    s = load_survey(spark, SF0001)
    SK.write_csv(s, str(tmp_path / "out"))
    back = SK.read_csv(spark, str(tmp_path / "out"), SURVEY_SCHEMA)
    assert back.exceptAll(s).count() == 0 and s.exceptAll(back).count() == 0
    with pytest.raises(Exception):
        SK.read_csv(spark, str(tmp_path / "nope"), SURVEY_SCHEMA).count()


def test_stream_scores_equal_batch_scores(spark, tmp_path, have_data):
    batch = load_survey(spark, SF0001)
    fitted = SS.fitted_encoder(batch)
    fe = FE.banded4(SS.encode_with(batch, fitted))
    ages = [c[len("Age_Group_"):] for c in fe.columns if c.startswith("Age_Group_")]
    feats = [c for c in fe.columns if c not in ("respondent_id", "Coping_Struggles")]
    fit = S.refit(fe, feats, "Coping_Struggles", [TR.Root("all", "true")], [S.Params(max_depth=3)])
    tree = fit.trees["all"]
    out = SS.run_to_parquet(SS.score_stream(SS.survey_stream(spark, SF0001), tree, feats, fitted, ages),
                            str(tmp_path))
    streamed = spark.read.parquet(out)
    batch_scores = fe.select("respondent_id", F.round(TR.predict_expr(tree, feats), 6).alias("prob"))
    assert streamed.count() == batch.count()
    diff = streamed.select("respondent_id", "prob").exceptAll(batch_scores)
    assert diff.count() == 0


def test_na_tokens_are_exact(spark, tmp_path):
    from canopy.sources import survey as SV

    p = tmp_path / "s.csv"
    p.write_text("k,v\n1,NA\n2, NA \n3,-1.#IND\n4,nothing\n5,\n6,#N/A N/A\n7,none\n8,None\n")
    got = {r["k"]: r["v"] for r in SV.read_survey_csv(spark, str(p)).collect()}
    assert [got[str(k)] for k in range(1, 9)] == [None, " NA ", None, "nothing", None, None, "none", None]


def test_bootstrap_interval_is_near_the_closed_form(spark):
    """A grouped mean's interval is about mean +- 1.96 standard errors, for few and for many rows."""
    import math

    from canopy.operators import profile as P

    for n in (40, 20_000):
        rows = [(1, float(i % 4 == 0)) for i in range(n)]
        r = P.group_means_bootstrap(spark.createDataFrame(rows, "t int, v double"), "t", ["v"], n_boot=2000).first()
        se = math.sqrt(0.25 * 0.75 / n)
        assert abs(r["mean"] - 0.25) < 1e-9
        assert abs(r["ci_low"] - (0.25 - 1.96 * se)) < 0.25 * se and abs(r["ci_high"] - (0.25 + 1.96 * se)) < 0.25 * se
