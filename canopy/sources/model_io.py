"""Model persistence: a fitted tree is its node table.

``save_tree`` writes the node table (one row per node, features by name) as Parquet;
``load_tree`` reads it back into the node dict that ``tree.predict_expr`` turns into one
column expression, so scoring a table (or a stream) with a saved model is a projection.
The path should live on shared storage (e.g. under ``spark.checkpoint.dir``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NODE_COLUMNS = ["node", "depth", "feature", "threshold", "t0", "t1", "W0", "W1", "impurity",
                "is_leaf"]
NODE_SCHEMA = ("node long, depth int, feature string, threshold double, t0 long, t1 long, "
               "W0 double, W1 double, impurity double, is_leaf boolean")


def tree_table(spark: SparkSession, tree: dict[int, dict], features: list[str]) -> DataFrame:
    rows = []
    for i in sorted(tree):
        n = tree[i]
        leaf = bool(n["is_leaf"]) or (2 * i) not in tree
        rows.append((int(i), int(n["depth"]), None if leaf else features[int(n["feature"])],
                     None if leaf else float(n["threshold"]), int(n["t0"]), int(n["t1"]),
                     float(n["W0"]), float(n["W1"]), float(n["impurity"]), leaf))
    return spark.createDataFrame(rows, NODE_SCHEMA)


def save_tree(spark: SparkSession, tree: dict[int, dict], features: list[str], path: str) -> None:
    tree_table(spark, tree, features).coalesce(1).write.mode("overwrite").parquet(path)


def load_tree(spark: SparkSession, path: str) -> tuple[dict[int, dict], list[str]]:
    """Node dict with feature indices into the returned feature list."""
    rows = spark.read.schema(NODE_SCHEMA).parquet(path).collect()  # one row per node
    features = sorted({r["feature"] for r in rows if r["feature"] is not None})
    idx = {f: i for i, f in enumerate(features)}
    tree = {}
    for r in rows:
        d = r.asDict()
        d["feature"] = idx[d["feature"]] if d["feature"] is not None else -1
        tree[int(d["node"])] = d
    return tree, features
