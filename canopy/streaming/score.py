"""Scoring new survey answers as they arrive (Structured Streaming).

The reference scores a saved model on a table (SURVEY S7); the same model applies to a
stream because a fitted tree is a column expression and every encoder is a column
expression with batch-fitted literals.  The stream is the order file source joined to
the static customer table (stream-static join, no state), encoded with parameters
fitted on a batch, scored, and written to a Parquet sink with its checkpoint on shared
storage (exactly-once file sink; restartable after executor or driver loss).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.functions import encode as E
from canopy.functions import features as FE
from canopy.operators import tree as TR
from canopy.session import ensure_checkpoint_dir
from canopy.sources.survey import ID, TARGET, read_table, survey_from_tables


def survey_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming survey rows: new order files joined to the (static) customer table."""
    orders_schema = read_table(spark, sf_dir, "orders").schema
    orders = spark.readStream.schema(orders_schema).parquet(f"{sf_dir.rstrip('/')}/orders*.parquet")
    return survey_from_tables(orders, read_table(spark, sf_dir, "customer"))


def fitted_encoder(batch_survey: DataFrame) -> dict:
    """Everything the base preprocessing + banded4 bundle fit, from a batch table."""
    from canopy.functions.encode import NOMINAL_COLUMNS, ORDINAL_COLUMNS

    enc = E.ordinal_encode(batch_survey)
    return {
        "medians": E.fit_medians(enc, ORDINAL_COLUMNS),
        "levels": E.fit_levels(batch_survey, NOMINAL_COLUMNS + [TARGET]),
    }


def encode_with(df: DataFrame, fitted: dict) -> DataFrame:
    """PP preprocessing with fitted literals only (usable on a streaming DataFrame)."""
    from canopy.functions.encode import NOMINAL_COLUMNS

    out = E.impute(E.ordinal_encode(df), fitted["medians"])
    lv = fitted["levels"]
    out = out.withColumn(TARGET, E.category_code(TARGET, lv[TARGET]))
    return E.one_hot(out, NOMINAL_COLUMNS, drop_first=True, levels={c: lv[c] for c in NOMINAL_COLUMNS})


def score_stream(stream: DataFrame, tree: dict[int, dict], features: list[str], fitted: dict,
                 age_levels: list[str]) -> DataFrame:
    feats = FE.banded4(encode_with(stream, fitted), age_levels=age_levels)
    return feats.select(ID, F.col(TARGET).alias("y"),
                        F.round(TR.predict_expr(tree, features, "prob"), 6).alias("prob"),
                        TR.predict_expr(tree, features, "pred").cast("int").alias("pred"))


def run_to_parquet(scored: DataFrame, base_dir: str | None = None) -> str:
    """Drain everything available (``availableNow``) into a Parquet sink; returns its path."""
    spark = scored.sparkSession
    base = (base_dir or ensure_checkpoint_dir(spark)).rstrip("/") + f"/streams/{uuid.uuid4().hex}"
    q = (scored.writeStream.format("parquet").option("path", base + "/out")
         .option("checkpointLocation", base + "/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return base + "/out"
