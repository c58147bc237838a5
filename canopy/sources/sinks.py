"""Sinks and small reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S3: CSV with header and no index column (Spark writes one file per partition)."""
    df.write.mode(mode).option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S1 with a declared schema (no inference pass).  A missing path raises Spark's own
    path-not-found error before any work starts (S2)."""
    return spark.read.option("header", True).schema(schema).csv(path)


def dtype_report(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type) of a table's schema."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


def head_sample(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows by key (a top-n: each task keeps n rows, then one merge)."""
    return df.orderBy(F.col(key)).limit(n)
