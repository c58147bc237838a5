"""Registered queries: ``(spark, sf_dir) -> DataFrame`` over the whole driver tables.

Each query reads ``orders`` and ``customer`` through the survey stand-in, so its work
grows with the tables.  Doubles are rounded to 6 digits at the output boundary only (the
oracle does the same), never inside the computation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canopy.functions import encode as E
from canopy.functions import features as FE
from canopy.operators import metrics as MT
from canopy.operators import profile as PR
from canopy.operators import split as SP
from canopy.session import ensure_checkpoint_dir
from canopy.sources import sinks as SK
from canopy.sources.survey import ID, SURVEY_COLUMNS, TARGET, load_survey, survey_with_age_years

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


# --------------------------------------------------------------------------- shared frames
def survey(spark: SparkSession, sf: str) -> DataFrame:
    return load_survey(spark, sf)


def encoded(spark: SparkSession, sf: str, variant: str = "pp") -> DataFrame:
    return E.preprocess(survey(spark, sf), variant)


def base_features(spark: SparkSession, sf: str) -> DataFrame:
    return FE.base(encoded(spark, sf))


def scored(spark: SparkSession, sf: str, with_all: bool = True) -> DataFrame:
    """Scored table for the metric queries: the composite score (H + S + F) / 6 of the
    base bundle as probability, 0.5 cut as prediction, stratified 5-fold as group."""
    fe = base_features(spark, sf)
    s = SP.stratified_kfold(fe, ID, TARGET, k=5)
    s = s.select(ID, "fold", F.col(TARGET).alias("y"),
                 (F.col("Mental_Stress_Frustration_Score") / 6.0).alias("prob"))
    s = s.withColumn("pred", (F.col("prob") > 0.5).cast("int"))
    return MT.with_overall(s) if with_all else s


# --------------------------------------------------------------------------- encoders
def q_null_report(spark, sf):
    s = survey(spark, sf)
    mapped = E.ordinal_encode(s)
    med = E.fit_medians(mapped, E.ORDINAL_COLUMNS)
    wide = s.select(
        *[F.col(c).alias(f"raw__{c}") for c in SURVEY_COLUMNS],
        *[E.ordinal_code(c, E.ORDINAL_MAPS[c]).alias(f"mapped__{c}") for c in E.ORDINAL_COLUMNS],
        *[F.coalesce(E.ordinal_code(c, E.ORDINAL_MAPS[c]), F.lit(med[c]).cast("double"))
          .alias(f"imputed__{c}") for c in E.ORDINAL_COLUMNS])
    rep = E.null_report(wide)
    parts = F.split(F.col("column_name"), "__")
    return rep.select(parts[0].alias("stage"), parts[1].alias("column_name"),
                      F.col("n_null").cast("long").alias("n_null"))


def q_target_code(spark, sf):
    s = survey(spark, sf)
    return E.category_encode(s, [TARGET]).select(ID, TARGET)


def q_ordinal_encode(spark, sf):
    return E.ordinal_encode(survey(spark, sf)).select(ID, *E.ORDINAL_COLUMNS)


def q_median_impute(spark, sf):
    return rounded(E.impute_median(E.ordinal_encode(survey(spark, sf)), E.ORDINAL_COLUMNS)
                   .select(ID, *E.ORDINAL_COLUMNS))


def q_onehot_drop_first(spark, sf):
    return E.one_hot(survey(spark, sf).select(ID, *E.NOMINAL_COLUMNS), E.NOMINAL_COLUMNS, True)


def q_onehot_all(spark, sf):
    return E.one_hot(survey(spark, sf).select(ID, *E.NOMINAL_COLUMNS), E.NOMINAL_COLUMNS, False)


def q_preprocessed(spark, sf):
    return rounded(encoded(spark, sf, "pp"))


def q_preprocessed_work_interest(spark, sf):
    return rounded(encoded(spark, sf, "pp2"))


def q_head_sample(spark, sf):
    return rounded(SK.head_sample(encoded(spark, sf), ID, 5))


def q_dtype_report(spark, sf):
    return SK.dtype_report(encoded(spark, sf))


def q_features_csv_roundtrip(spark, sf):
    """S3 then S1: the base feature table written as CSV on shared storage and read back
    with its declared schema (no inference); must equal ``features_base``."""
    import uuid
    fe = rounded(base_features(spark, sf))
    path = ensure_checkpoint_dir(spark).rstrip("/") + f"/csv/features-{uuid.uuid4().hex}"
    SK.write_csv(fe, path)
    return SK.read_csv(spark, path, fe.schema)


# --------------------------------------------------------------------------- profiles
def q_frequency(spark, sf):
    return PR.frequency(survey(spark, sf), SURVEY_COLUMNS)


def q_mode_per_column(spark, sf):
    return PR.mode_per_column(survey(spark, sf), SURVEY_COLUMNS)


def q_pivot_age_gender(spark, sf):
    return PR.pivot_age_gender(survey(spark, sf))


def q_crosstab_two_key(spark, sf):
    return PR.crosstab_two_key(survey(spark, sf))


def q_crosstab_by_level(spark, sf):
    return PR.crosstab_by_level(survey(spark, sf))


def q_group_means(spark, sf):
    pp = encoded(spark, sf)
    return PR.group_means(pp, TARGET, E.dummy_names(pp))


def q_group_means_work_interest(spark, sf):
    pp = encoded(spark, sf, "pp2")
    return PR.group_means(pp, "Work_Interest", E.dummy_names(pp))


def q_group_means_bootstrap(spark, sf):
    pp = encoded(spark, sf)
    return PR.group_means_bootstrap(pp, TARGET, E.dummy_names(pp), ID, n_boot=1000)


def q_box_stats(spark, sf):
    return PR.box_stats(encoded(spark, sf), TARGET, E.ORDINAL_COLUMNS)


def q_density_grid(spark, sf):
    return PR.density_grid(encoded(spark, sf), TARGET, E.ORDINAL_COLUMNS)


def _numeric_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.name != ID
            and isinstance(f.dataType, (T.DoubleType, T.IntegerType, T.LongType))]


def q_corr_matrix(spark, sf):
    pp = encoded(spark, sf)
    return PR.corr_matrix(pp, _numeric_cols(pp))


def q_corr_with_target(spark, sf):
    pp = encoded(spark, sf)
    return PR.corr_with_target(pp, TARGET, _numeric_cols(pp))


def q_corr_matrix_features(spark, sf):
    fe = base_features(spark, sf)
    return PR.corr_matrix(fe, _numeric_cols(fe))


def q_corr_with_work_interest(spark, sf):
    pp = encoded(spark, sf, "pp2")
    return PR.corr_with_target(pp, "Work_Interest", _numeric_cols(pp))


def q_corr_with_target_features(spark, sf):
    fe = base_features(spark, sf)
    return PR.corr_with_target(fe, TARGET, _numeric_cols(fe))


# --------------------------------------------------------------------------- feature bundles
def q_features_base(spark, sf):
    return rounded(base_features(spark, sf))


def q_features_banded3(spark, sf):
    return rounded(FE.banded3(encoded(spark, sf)))


def q_features_banded4(spark, sf):
    return rounded(FE.banded4(encoded(spark, sf)))


def q_features_coded(spark, sf):
    # The survey has NULL Age / Mood answers (code -1, outside every bin): the reference's
    # encoder would stop on them, the registered query keeps them as NULL bins instead.
    return rounded(FE.coded(FE.preprocess_coded(survey(spark, sf)), on_unknown="null"))


def q_features_years(spark, sf):
    return rounded(FE.years(FE.preprocess_years(survey_with_age_years(survey(spark, sf)))))


# --------------------------------------------------------------------------- splits
def q_holdout_split(spark, sf):
    return SP.holdout_split(survey(spark, sf).select(ID, TARGET), ID, TARGET, 0.2)


def q_three_way_split(spark, sf):
    return SP.three_way_split(survey(spark, sf).select(ID, TARGET), ID, TARGET, 0.2, 0.25)


def q_split_shares(spark, sf):
    return SP.split_shares(q_three_way_split(spark, sf))


def q_kfold(spark, sf):
    return SP.kfold(survey(spark, sf).select(ID), ID, 5)


def q_stratified_kfold(spark, sf):
    return SP.stratified_kfold(survey(spark, sf).select(ID, TARGET), ID, TARGET, 5)


def q_contiguous_kfold(spark, sf):
    return SP.contiguous_kfold(survey(spark, sf).select(ID, TARGET), ID, TARGET, 5)


# --------------------------------------------------------------------------- metrics
def q_confusion_matrix(spark, sf):
    return MT.confusion_matrix(scored(spark, sf), ["fold"])


def q_class_report(spark, sf):
    return MT.rounded(MT.class_report(scored(spark, sf), ["fold"]))


def q_class_report_subset(spark, sf):
    return MT.rounded(MT.class_report(scored(spark, sf), ["fold"], labels=[1]))


def q_accuracy(spark, sf):
    return MT.rounded(MT.accuracy(scored(spark, sf), ["fold"]))


def q_roc_curve(spark, sf):
    return MT.rounded(MT.roc_curve(scored(spark, sf), ["fold"]))


def q_roc_auc(spark, sf):
    return MT.rounded(MT.roc_auc(scored(spark, sf), ["fold"]))


def q_pr_curve(spark, sf):
    return MT.rounded(MT.pr_curve(scored(spark, sf), ["fold"]))


def q_average_precision(spark, sf):
    return MT.rounded(MT.average_precision(scored(spark, sf), ["fold"]))


QUERIES: dict[str, Query] = {
    "null_report": q_null_report,
    "target_code": q_target_code,
    "ordinal_encode": q_ordinal_encode,
    "median_impute": q_median_impute,
    "onehot_drop_first": q_onehot_drop_first,
    "onehot_all": q_onehot_all,
    "preprocessed": q_preprocessed,
    "preprocessed_work_interest": q_preprocessed_work_interest,
    "head_sample": q_head_sample,
    "dtype_report": q_dtype_report,
    "features_csv_roundtrip": q_features_csv_roundtrip,
    "frequency": q_frequency,
    "mode_per_column": q_mode_per_column,
    "pivot_age_gender": q_pivot_age_gender,
    "crosstab_two_key": q_crosstab_two_key,
    "crosstab_by_level": q_crosstab_by_level,
    "group_means": q_group_means,
    "group_means_work_interest": q_group_means_work_interest,
    "group_means_bootstrap": q_group_means_bootstrap,
    "box_stats": q_box_stats,
    "density_grid": q_density_grid,
    "corr_matrix": q_corr_matrix,
    "corr_with_target": q_corr_with_target,
    "corr_with_target_features": q_corr_with_target_features,
    "corr_matrix_features": q_corr_matrix_features,
    "corr_with_work_interest": q_corr_with_work_interest,
    "features_base": q_features_base,
    "features_banded3": q_features_banded3,
    "features_banded4": q_features_banded4,
    "features_coded": q_features_coded,
    "features_years": q_features_years,
    "holdout_split": q_holdout_split,
    "three_way_split": q_three_way_split,
    "split_shares": q_split_shares,
    "kfold": q_kfold,
    "stratified_kfold": q_stratified_kfold,
    "contiguous_kfold": q_contiguous_kfold,
    "confusion_matrix": q_confusion_matrix,
    "class_report": q_class_report,
    "class_report_subset": q_class_report_subset,
    "accuracy": q_accuracy,
    "roc_curve": q_roc_curve,
    "roc_auc": q_roc_auc,
    "pr_curve": q_pr_curve,
    "average_precision": q_average_precision,
}
