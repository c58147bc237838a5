"""One saved model from raw answers to probabilities.

``fit`` learns medians, levels, thresholds and the tree from its training rows.  ``save`` writes them
as one versioned artefact on shared storage:

    <path>/nodes        one row per node (``model_io``)
    <path>/parameters   (kind, name, position, text, value): bundle, medians, levels, thresholds, features

``parameters`` is written last and holds the version, so a half-written model does not load.  ``load``
needs no training data, and ``score`` takes a table of raw answers (or a stream: it is a projection of
column expressions; the tree is walked once for both probability and class).

NULL or unknown ordinal answers get the fitted median, unknown nominal levels have no dummy, a NULL or
unknown target has code -1; extra columns of the scored table are kept unless the encoding replaces them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.functions import encode as E
from canopy.functions import features as FE
from canopy.operators import tree as TR
from canopy.plans import search as S
from canopy.plans import strategies as ST
from canopy.sources import model_io as IO
from canopy.sources.survey import TARGET

VERSION = 1
PARAMETER_SCHEMA = "kind string, name string, position int, text string, value double"
BUNDLES = ("base", "banded3", "banded4")


@dataclass
class SurveyModel:
    bundle: str
    medians: dict[str, float | None]
    levels: dict[str, list[str]]
    age_groups: list[str]
    thresholds: dict[str, float | None]
    features: list[str]
    tree: dict[int, dict]

    def transform(self, raw: DataFrame) -> DataFrame:
        """Encoded answers and features of raw answers, by fitted values only."""
        return _features(E.preprocess(raw, fitted={"medians": self.medians, "levels": self.levels}),
                         self.bundle, self.thresholds, self.age_groups)

    def score(self, raw: DataFrame) -> DataFrame:
        """``transform`` with prob (of class 1) and pred."""
        leaf = self.transform(raw).withColumn("_leaf", TR.predict_expr(self.tree, self.features, "leaf"))
        return leaf.withColumns({"prob": F.col("_leaf.prob"), "pred": F.col("_leaf.pred").cast("int")}).drop("_leaf")

    def save(self, spark: SparkSession, path: str) -> None:
        """Writes to a path that does not exist yet."""
        rows = [("version", None, 0, None, float(VERSION)), ("bundle", None, 0, self.bundle, None)]
        rows += [("median", c, 0, None, v) for c, v in self.medians.items()]
        rows += [("threshold", c, 0, None, v) for c, v in self.thresholds.items()]
        rows += [("level", c, i, v, None) for c, vs in self.levels.items() for i, v in enumerate(vs)]
        rows += [("age_group", None, i, v, None) for i, v in enumerate(self.age_groups)]
        rows += [("feature", None, i, v, None) for i, v in enumerate(self.features)]
        IO.tree_table(spark, self.tree, self.features).coalesce(1).write.parquet(f"{path}/nodes")
        spark.createDataFrame(rows, PARAMETER_SCHEMA).coalesce(1).write.parquet(f"{path}/parameters")


def _features(pp: DataFrame, bundle: str, thresholds: dict, age_groups: list[str]) -> DataFrame:
    if bundle == "base":
        return FE.base(pp, thresholds)
    return (FE.banded3 if bundle == "banded3" else FE.banded4)(pp, age_levels=age_groups)


def fit(train: DataFrame, params: S.Params, bundle: str = "base", drop: tuple[str, ...] = ()) -> SurveyModel:
    """Everything from the raw answers of ``train``; columns in ``drop`` are no features."""
    if bundle not in BUNDLES:
        raise ValueError(f"unknown bundle {bundle!r}")
    fitted = E.fit_preprocess(train)
    pp = E.preprocess(train, fitted=fitted)
    thresholds = FE.fit_base(pp) if bundle == "base" else {}
    data = _features(pp, bundle, thresholds, fitted["age_groups"])
    feats = ST.feature_names(data, drop)
    tree = S.refit(data, feats, TARGET, [TR.Root("all", "true")], [params]).trees["all"]
    return SurveyModel(bundle, fitted["medians"], fitted["levels"], fitted["age_groups"], thresholds, feats, tree)


def load(spark: SparkSession, path: str) -> SurveyModel:
    """The parameters and at most 65,536 nodes are read by the driver, which builds expressions of them."""
    rows = sorted(spark.read.schema(PARAMETER_SCHEMA).parquet(f"{path}/parameters").collect(), key=lambda r: r["position"])
    of = {k: [r for r in rows if r["kind"] == k] for k in ("version", "bundle", "median", "threshold", "level", "age_group", "feature")}
    if [r["value"] for r in of["version"]] != [float(VERSION)]:
        raise ValueError(f"no model of version {VERSION} at {path}")
    levels: dict[str, list[str]] = {c: [] for c in [*E.NOMINAL_COLUMNS, TARGET]}
    for r in of["level"]:
        levels.setdefault(r["name"], []).append(r["text"])
    tree, features = IO.load_tree(spark, f"{path}/nodes")
    return SurveyModel(of["bundle"][0]["text"], {r["name"]: r["value"] for r in of["median"]}, levels,
                       [r["text"] for r in of["age_group"]], {r["name"]: r["value"] for r in of["threshold"]}, features, tree)
