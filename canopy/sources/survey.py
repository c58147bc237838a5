"""The survey table: schema, the stand-in built from the driver tables, CSV input.

The original survey CSV is not available, so the stand-in projects ``orders`` joined to
``customer`` onto the 13 survey answers (one row per order).  The same projection exists
twice: as DataFrame code (what the library runs) and as SQL text (what the DuckDB oracle
runs), so the oracle cross-checks the DataFrame code rather than repeating it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values: survey column names (must match the survey's header) ----
SURVEY_COLUMNS = [
    "Age", "Gender", "Occupation", "Days_Indoors", "Growing_Stress",
    "Quarantine_Frustrations", "Changes_Habits", "Mental_Health_History",
    "Weight_Change", "Mood_Swings", "Coping_Struggles", "Work_Interest",
    "Social_Weakness",
]
ID = "respondent_id"
TARGET = "Coping_Struggles"

SURVEY_SCHEMA = T.StructType(
    [T.StructField(ID, T.LongType(), True)]
    + [T.StructField(c, T.StringType(), True) for c in SURVEY_COLUMNS]
)

# The texts that the reference's CSV reader takes for missing by default, exactly
# as they stand (no trimming).
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def _yes_maybe_no(mod3: Column) -> Column:
    return F.when(mod3 == 0, "No").when(mod3 == 1, "Maybe").otherwise("Yes")


def survey_from_tables(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Stand-in survey: one row per order (FIXTURES.md section 5).

    The join is an equi-join on the customer key; Catalyst prunes both sides to the
    columns used below and AQE picks broadcast or sort-merge from runtime sizes and
    splits skewed customer keys (``spark.sql.adaptive.skewJoin.enabled``).
    """
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                      "o_orderdate", "o_orderpriority")
    c = customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    key = F.col("o_orderkey")
    status_pts = (F.when(F.col("o_orderstatus") == "F", 2)
                  .when(F.col("o_orderstatus") == "P", 1).otherwise(0))
    coping = (status_pts
              + F.when(F.col("o_orderpriority") >= "4", 1).otherwise(0)
              + F.when(key % 5 == 0, 1).otherwise(0))
    return j.select(
        key.alias(ID),
        F.when(key % 41 == 0, F.lit(None).cast("string"))
        .when(F.col("c_acctbal") < 1500, "16-20").when(F.col("c_acctbal") < 4000, "20-25")
        .when(F.col("c_acctbal") < 7000, "25-30").otherwise("30-Above").alias("Age"),
        F.when(F.col("c_nationkey") % 2 == 0, "Female").otherwise("Male").alias("Gender"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Business")
        .when(F.col("c_mktsegment") == "BUILDING", "Corporate")
        .when(F.col("c_mktsegment") == "FURNITURE", "Others")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "Housewife")
        .otherwise("Student").alias("Occupation"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Go out Every day")
        .when(F.col("o_orderpriority") == "2-HIGH", "1-14 days")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "15-30 days")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "31-60 days")
        .otherwise("More than 2 months").alias("Days_Indoors"),
        F.when(F.col("o_orderstatus") == "F", "Yes").when(F.col("o_orderstatus") == "P", "Maybe")
        .otherwise("No").alias("Growing_Stress"),
        _yes_maybe_no(F.month("o_orderdate") % 3).alias("Quarantine_Frustrations"),
        _yes_maybe_no(F.year("o_orderdate") % 3).alias("Changes_Habits"),
        _yes_maybe_no(F.dayofmonth("o_orderdate") % 3).alias("Mental_Health_History"),
        F.when(F.col("o_totalprice") < 150000, "No").when(F.col("o_totalprice") < 330000, "Maybe")
        .otherwise("Yes").alias("Weight_Change"),
        F.when(key % 37 == 0, F.lit(None).cast("string"))
        .when(F.col("c_custkey") % 3 == 0, "Low").when(F.col("c_custkey") % 3 == 1, "Medium")
        .otherwise("High").alias("Mood_Swings"),
        _yes_maybe_no(key % 3).alias("Work_Interest"),
        F.when(F.col("c_custkey") % 4 == 1, "Maybe").when(F.col("c_custkey") % 4 == 2, "Yes")
        .otherwise("No").alias("Social_Weakness"),
        F.when(coping >= 2, "Yes").otherwise("No").alias(TARGET),
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a too-coarse input (e.g. one file with one row group) over the
    cluster's cores; an input already split at least that finely is left as it is, so at
    scale this adds no shuffle."""
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def load_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey_from_tables(spread(read_table(spark, sf_dir, "orders")),
                              read_table(spark, sf_dir, "customer"))


def read_survey_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                    na_tokens: list[str] | None = None) -> DataFrame:
    """CSV with header (S1).  A declared schema avoids an inference pass over the data and meets the
    file's columns by name, in any order (the header line alone is read first; undeclared columns are
    left out, a missing one is an error); pandas-style NA tokens become NULL so NULL is the only
    missing marker.  A missing path is Spark's own path-not-found error (S2)."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    df = reader.csv(path)
    if schema is not None:
        missing = [f.name for f in schema.fields if f.name not in df.columns]
        if missing:
            raise ValueError(f"{path} has no column {', '.join(missing)}")
        by_name = {f.name: f for f in schema.fields}
        found = T.StructType([by_name.get(c, T.StructField(c, T.StringType())) for c in df.columns])
        df = reader.schema(found).csv(path).select(*by_name)
    tokens = NA_TOKENS if na_tokens is None else na_tokens
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            c = F.when(c.isin(tokens), F.lit(None).cast("string")).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def survey_with_age_years(survey: DataFrame) -> DataFrame:
    """Survey whose Age is a number of years (input shape of the ``years`` bundle).

    The years are derived from the respondent key so that every bin of the bundle,
    including values outside its edges, is present; NULL ages stay NULL.
    """
    years = (F.lit(16) + F.col(ID) % 90).cast("string")
    return survey.withColumn("Age", F.when(F.col("Age").isNull(), F.lit(None).cast("string"))
                             .otherwise(years))


# The same stand-in as SQL text for the DuckDB oracle (FIXTURES.md section 5).
SURVEY_SQL = """SELECT o_orderkey AS respondent_id,
 CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN c_acctbal < 1500 THEN '16-20' WHEN c_acctbal < 4000 THEN '20-25' WHEN c_acctbal < 7000 THEN '25-30' ELSE '30-Above' END AS Age,
 CASE WHEN c_nationkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS Gender,
 CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Business' WHEN 'BUILDING' THEN 'Corporate' WHEN 'FURNITURE' THEN 'Others' WHEN 'HOUSEHOLD' THEN 'Housewife' ELSE 'Student' END AS Occupation,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'Go out Every day' WHEN '2-HIGH' THEN '1-14 days' WHEN '3-MEDIUM' THEN '15-30 days' WHEN '4-NOT SPECIFIED' THEN '31-60 days' ELSE 'More than 2 months' END AS Days_Indoors,
 CASE o_orderstatus WHEN 'F' THEN 'Yes' WHEN 'P' THEN 'Maybe' ELSE 'No' END AS Growing_Stress,
 CASE EXTRACT(MONTH FROM o_orderdate) % 3 WHEN 0 THEN 'No' WHEN 1 THEN 'Maybe' ELSE 'Yes' END AS Quarantine_Frustrations,
 CASE EXTRACT(YEAR FROM o_orderdate) % 3 WHEN 0 THEN 'No' WHEN 1 THEN 'Maybe' ELSE 'Yes' END AS Changes_Habits,
 CASE EXTRACT(DAY FROM o_orderdate) % 3 WHEN 0 THEN 'No' WHEN 1 THEN 'Maybe' ELSE 'Yes' END AS Mental_Health_History,
 CASE WHEN o_totalprice < 150000 THEN 'No' WHEN o_totalprice < 330000 THEN 'Maybe' ELSE 'Yes' END AS Weight_Change,
 CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'Low' WHEN c_custkey % 3 = 1 THEN 'Medium' ELSE 'High' END AS Mood_Swings,
 CASE o_orderkey % 3 WHEN 0 THEN 'No' WHEN 1 THEN 'Maybe' ELSE 'Yes' END AS Work_Interest,
 CASE c_custkey % 4 WHEN 0 THEN 'No' WHEN 1 THEN 'Maybe' WHEN 2 THEN 'Yes' ELSE 'No' END AS Social_Weakness,
 CASE WHEN (CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'P' THEN 1 ELSE 0 END) + (CASE WHEN o_orderpriority >= '4' THEN 1 ELSE 0 END) + (CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END) >= 2 THEN 'Yes' ELSE 'No' END AS Coping_Struggles
FROM orders JOIN customer ON o_custkey = c_custkey"""
