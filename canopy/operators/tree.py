"""Weighted binary decision trees grown level by level as DataFrame jobs.

Data flow of ``grow``
---------------------
1. A *root* names a training set and an evaluation set as SQL predicates over the fold
   columns (e.g. "fold <> 2" / "fold = 2").
2. Rows become *cells*: distinct feature vectors, each with its row counts per root, role (train,
   eval) and label as an array.  Folds do not multiply cells: there are never more than the survey
   has distinct answers, however many rows and roots; every later job reads cells, never raw rows.
3. A *path* is the list of splits that leads to a node, whatever the root; a node's *key* adds
   its root.  Growths of any root and spec (criterion, class weight, min_samples_leaf) that
   choose the same splits share the path: the assignment table holds one row per (cell,
   distinct path), not per (cell, model).
4. Paths of more than LOCAL_CELLS cells grow level by level: tasks count their slices of cells for
   all roots at once (``subtree.histogram``), Spark adds the counts, and ONE join with the
   active nodes, running sums per (spec, node, feature) and a max_by find every node's best
   split.  Leaf rule, class weights, impurity and child keys are column expressions of the
   same job, which writes the level's nodes to shared storage.  The assignment table moves to
   the child paths through a broadcast of that level's splits, of which there are few: a path
   that is split here has more than LOCAL_CELLS rows.
5. A path of at most LOCAL_CELLS cells goes to one task, or to several that share its growths out,
   and is grown to its leaves there (``subtree.grow_group``): no job per level.  All such paths,
   whatever their level, are one job at the end.  Depth is not limited by node numbers.  A search that
   wants only the leaves of its variants gets them from the same task (``subtree.derived_group``,
   ``prune.derive_grown``): the nodes are not written.
Eval-role rows follow the same splits and never enter a histogram, so every node also
knows the label counts of its evaluation rows: CV metrics of any derived tree come from
these counts, without a scoring pass over the rows.

Semantics follow CART as in scikit-learn: weighted gini or entropy (log2), threshold =
midpoint of neighbouring distinct values, a split needs ``min_samples_leaf`` raw rows on
each side, a node is a leaf when pure, below ``2 * min_samples_leaf`` rows, below 2 rows,
at ``max_depth``, or without a valid split; ties go to the lowest feature index, then the
lowest threshold (scikit-learn breaks them at random).
"""

from __future__ import annotations

import hashlib
import math
import uuid
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canopy.operators import subtree as SUB
from canopy.session import cut_lineage, ensure_checkpoint_dir

IMPURITY_EPS = 2.220446049250313e-16  # machine epsilon: a node at or below this is pure
#: Levels of a block: nodes are grouped below every BAND-th level, so that work on a tree goes
#: block by block (``prune``), each of at most 2^BAND nodes, however deep the tree is.
BAND = 12
#: Paths of up to so many cells are grown to their leaves inside a task.
LOCAL_CELLS = 1 << 17
#: Cells of a path times its growths that a task takes on: more tasks for a path need more copies of its cells.
SHARE_CELLS = 1 << 23
#: Trees of up to so many nodes may be collected, to become one column expression.
MAX_TREE_NODES = 1 << 16


def node_key(*parts) -> int:
    """Stable signed 64-bit key of a root or a split path."""
    h = hashlib.blake2b(repr(parts).encode(), digest_size=8).digest()
    return int.from_bytes(h, "big", signed=True)


@dataclass(frozen=True)
class Root:
    """A training set and an evaluation set, as SQL predicates over the input columns."""
    name: str
    train: str
    eval: str | None = None

    @property
    def key(self) -> int:
        return node_key("root", self.name, self.train, self.eval)


@dataclass(frozen=True)
class GrowSpec:
    gid: int
    root: str
    criterion: str = "gini"
    class_weight: object = None          # None | "balanced" | {0: w0, 1: w1}
    min_samples_leaf: int = 1
    max_depth: int | None = None


@dataclass
class Growth:
    """``table`` holds one row per (gid, node): NODE_SCHEMA, on shared storage."""
    features: list[str]
    specs: dict[int, GrowSpec]
    roots: dict[str, Root]
    table: DataFrame
    depth: int                            # of the deepest node

    @property
    def nodes(self) -> pd.DataFrame:
        """The node table on the driver; for few and small trees."""
        return (self.table.where("depth <= 61").drop("parent", "above", "lkey", "rkey").toPandas().sort_values(["gid", "node"], kind="stable")
                .reset_index(drop=True))

    def trees(self, depth_of: dict[int, int | None]) -> dict[int, dict[int, dict]]:
        """Node dicts of some growths, each down to its depth, in one pass.  A growth without a depth
        limit must be small: larger trees stay tables (``score_by_table``, ``prune.derive``)."""
        wanted = F.lit(False)
        for gid, depth in depth_of.items():
            wanted = wanted | ((F.col("gid") == gid) & (F.lit(True) if depth is None else F.col("depth") <= depth))
        limit = sum(MAX_TREE_NODES if d is None else min(MAX_TREE_NODES, 2 ** (d + 1)) for d in depth_of.values())
        rows = self.table.where(wanted).limit(limit + 1).collect()
        if len(rows) > limit:
            raise ValueError(f"a tree of more than {MAX_TREE_NODES} nodes: score it with score_by_table")
        by_gid: dict[int, dict[int, dict]] = {gid: {} for gid in depth_of}
        for r in rows:
            by_gid[r["gid"]][r["key"]] = r.asDict()
        return {gid: numbered(nodes) for gid, nodes in by_gid.items()}


def numbered(by_key: dict[int, dict]) -> dict[int, dict]:
    """Nodes by heap number (children of i: 2i and 2i + 1) from nodes by key."""
    top = [n for n in by_key.values() if n["parent"] is None]
    out, open_ = {}, [(1, n) for n in top]
    while open_:
        i, n = open_.pop()
        out[i] = {**n, "node": i}
        if not n["is_leaf"] and n["lkey"] in by_key:
            open_ += [(2 * i, by_key[n["lkey"]]), (2 * i + 1, by_key[n["rkey"]])]
    return dict(sorted(out.items()))


# --------------------------------------------------------------------------- impurity
def impurity_py(a: float, b: float, criterion: str) -> float:
    w = a + b
    if w <= 0:
        return 0.0
    p, q = a / w, b / w
    if criterion == "gini":
        return 1.0 - p * p - q * q
    return -sum(v * math.log2(v) for v in (p, q) if v > 0)


# --------------------------------------------------------------------------- inputs
def fit_bins(df: DataFrame, features: list[str], max_bins: int) -> dict[str, list[float]]:
    """Bin edges for features with more than ``max_bins`` distinct values (approximate
    distinct count, then approximate quantiles, as Spark ML trees do).  Features at or under
    the bound keep exact values, so survey codes are never binned."""
    nd = df.agg(*[F.approx_count_distinct(F.col(c)).alias(c) for c in features]).first()
    wide = [c for c in features if (nd[c] or 0) > max_bins]
    if not wide:
        return {}
    qs = F.array(*[F.lit(i / max_bins) for i in range(1, max_bins)])
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), qs, 10_000).alias(c) for c in wide]).first()
    return {c: sorted(set(float(v) for v in row[c] if v is not None)) for c in wide}


def binned(c: str, edges: list[float]) -> Column:
    """Value -> the upper edge of its bin (values above the last edge keep +inf)."""
    arr = F.array(*[F.lit(e) for e in edges] + [F.lit(float("inf"))])
    pos = F.size(F.filter(arr, lambda e: e < F.col(c).cast("double"))) + 1
    return F.when(F.col(c).isNull(), F.lit(None).cast("double")).otherwise(F.element_at(arr, pos))


def make_cells(df: DataFrame, features: list[str], label: str, keep: list[str],
               bins: dict[str, list[float]] | None = None) -> DataFrame:
    """Distinct (x, y, keep...) with row counts: partial aggregation before the shuffle."""
    bins = bins or {}
    x = F.array(*[binned(c, bins[c]) if c in bins else F.col(c).cast("double")
                  for c in features]).alias("x")
    return (df.select(x, F.col(label).cast("int").alias("y"), *keep)
            .groupBy("x", "y", *keep).agg(F.count(F.lit(1)).alias("n")))


def assign_roots(cells: DataFrame, roots: list[Root]) -> DataFrame:
    """(x, y, n, role, key): each cell once per root it trains or evaluates in.
    A generator over a literal array of roots, so no join is needed."""
    tagged = [F.struct(F.lit(r.key).alias("key"),
                       F.when(F.expr(r.train), F.lit(0))
                       .when(F.expr(r.eval) if r.eval else F.lit(False), F.lit(1)).alias("role"))
              for r in roots]
    out = cells.select("x", "y", "n", F.explode(F.array(*tagged)).alias("r"))
    return (out.select("x", "y", "n", F.col("r.role").cast("byte").alias("role"),
                       F.col("r.key").alias("key")).where(F.col("role").isNotNull()))


def with_counts(cells: DataFrame, roots: list[Root]) -> DataFrame:
    """(x, w, path, on): each distinct feature vector once.  ``w`` holds four row counts per root: train rows
    of label 0 and 1, eval rows of label 0 and 1; ``on`` lists the roots that have the path."""
    spark = cells.sparkSession
    role = [F.when(F.expr(r.train), F.lit(0)).when(F.expr(r.eval) if r.eval else F.lit(False), F.lit(1)).otherwise(F.lit(2)).cast("byte")
            for r in roots]
    out = cells.select("x", "y", "n", F.array(*role).alias("m")).where("exists(m, r -> r < 2)")
    # rows cross the exchange as they are and are summed behind it: the sums of all roots are wide
    out = out.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "x")
    sums = [f"sum(IF(m[{i}] = {r} AND y = {c}, n, 0L))" for i in range(len(roots)) for r in (0, 1) for c in (0, 1)]
    out = out.groupBy("x").agg(F.expr(f"array({', '.join(sums)})").alias("w"))
    return out.selectExpr("x", "w", "0L AS path", f"sequence(0, {len(roots) - 1}) AS on").where("exists(w, c -> c > 0)")


def class_weights(spec: GrowSpec, c0: int, c1: int) -> tuple[float, float]:
    cw = spec.class_weight
    if cw is None:
        return 1.0, 1.0
    if cw == "balanced":
        n = c0 + c1
        return (n / (2.0 * c0) if c0 else 1.0), (n / (2.0 * c1) if c1 else 1.0)
    return float(cw.get(0, 1.0)), float(cw.get(1, 1.0))


# --------------------------------------------------------------------------- level jobs
# The per-level jobs are written as SQL expression text: the JVM parses each string in one
# call, which keeps driver-side plan building cheap when a growth runs many levels.
def histogram(assign: DataFrame) -> DataFrame:
    """(key, j, v, c0, c1) class counts per node, feature and value, plus node statistics
    in the same pass: position 0 is a pseudo-feature whose value is the row's role
    (0 train, 1 eval); positions 1.. are the features, exploded for training rows only."""
    t = assign.selectExpr("key", "y", "n",
                          "posexplode(IF(role = 0, concat(array(0D), x), array(1D))) AS (j, v)")
    return t.groupBy("key", "j", "v").agg(
        F.expr("sum(IF(y = 0, n, 0L)) AS c0"), F.expr("sum(IF(y = 1, n, 0L)) AS c1"))


def node_stats(assign: DataFrame) -> DataFrame:
    """(key, t0, t1, e0, e1): train and eval label counts per node."""
    return assign.groupBy("key").agg(
        F.expr("sum(IF(role = 0 AND y = 0, n, 0L)) AS t0"), F.expr("sum(IF(role = 0 AND y = 1, n, 0L)) AS t1"),
        F.expr("sum(IF(role = 1 AND y = 0, n, 0L)) AS e0"), F.expr("sum(IF(role = 1 AND y = 1, n, 0L)) AS e1"))


NODE_SPEC_SCHEMA = T.StructType([
    T.StructField("gid", T.IntegerType()), T.StructField("node", T.LongType()),
    T.StructField("key", T.LongType()), T.StructField("crit", T.IntegerType()),
    T.StructField("w0", T.DoubleType()), T.StructField("w1", T.DoubleType()),
    T.StructField("msl", T.IntegerType()), T.StructField("tot0", T.LongType()),
    T.StructField("tot1", T.LongType()), T.StructField("parent_cost", T.DoubleType()),
])


def impurity_sql(a: str, b: str) -> str:
    """Weighted gini (crit = 0) or entropy in bits (crit = 1) of class weights a, b."""
    p, q = f"({a} / ({a} + {b}))", f"({b} / ({a} + {b}))"
    return (f"CASE WHEN {a} + {b} <= 0 THEN 0D WHEN crit = 0 THEN 1D - {p} * {p} - {q} * {q} "
            f"ELSE -(IF({a} > 0, {p} * log2({p}), 0D) + IF({b} > 0, {q} * log2({q}), 0D)) END")


_W = "PARTITION BY gid, node, j ORDER BY v"


def split_candidates(hist: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every valid threshold of every (spec, node, feature) with its gain.

    ``gain`` = W_node * imp_node - W_left * imp_left - W_right * imp_right (weighted, not
    yet divided by the root weight).  Window partitions hold the distinct values of one
    feature in one node, so they stay small whatever the row count."""
    j = hist.join(nodes, "key")
    c = j.selectExpr(
        "gid", "node", "key", "j", "v", "crit", "w0", "w1", "msl", "tot0", "tot1", "parent_cost",
        f"sum(c0) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l0",
        f"sum(c1) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l1",
        f"lead(v) OVER ({_W}) AS v_next")
    c = c.where("v_next IS NOT NULL AND l0 + l1 >= msl AND (tot0 - l0) + (tot1 - l1) >= msl")
    c = c.selectExpr("gid", "node", "key", "j", "v", "v_next", "crit", "parent_cost",
                     "l0 + l1 AS n_left", "(tot0 - l0) + (tot1 - l1) AS n_right",
                     "w0 * l0 AS a0", "w1 * l1 AS a1", "w0 * (tot0 - l0) AS b0", "w1 * (tot1 - l1) AS b1")
    c = c.selectExpr("*", f"{impurity_sql('a0', 'a1')} AS imp_left", f"{impurity_sql('b0', 'b1')} AS imp_right")
    return c.selectExpr(
        "gid", "node", "key", "j",
        "IF((v + v_next) / 2D = v_next, v, (v + v_next) / 2D) AS threshold",
        "n_left", "n_right", "imp_left", "imp_right",
        "parent_cost - (a0 + a1) * imp_left - (b0 + b1) * imp_right AS gain",
        "a0 + a1 + b0 + b1 AS w_node")


def advance(assign: DataFrame, splits: DataFrame) -> DataFrame:
    """Move every cell of a split path to its child path (one row per distinct split of the path);
    cells of paths no growth splits any further drop out, and so do those without rows in the roots
    that have the split."""
    j = assign.drop("on").join(F.broadcast(splits), "path")
    j = j.selectExpr("x", "w", "IF(element_at(x, feature + 1) <= threshold, lpath, rpath) AS path", "on")
    return j.where("exists(on, i -> w[4 * i] + w[4 * i + 1] + w[4 * i + 2] + w[4 * i + 3] > 0)")


# --------------------------------------------------------------------------- growth
SPEC_SCHEMA = "gid int, crit int, msl int, max_depth int"
ACTIVE_SCHEMA = ("gid int, root int, path long, key long, depth int, node long, parent long, block long, above long, cw0 double, "
                 "cw1 double, w_root double")
#: ``parent``, ``lkey`` and ``rkey`` are keys; ``block`` is the key of the node's ancestor (or itself) at the
#: last level that BAND divides, ``above`` the block of its parent; ``node`` is the heap number, null below level 61.
NODE_SCHEMA = ("gid int, key long, node long, parent long, block long, above long, depth int, t0 long, t1 long, "
               "e0 long, e1 long, cw0 double, cw1 double, w_root double, W0 double, W1 double, impurity double, "
               "feature int, threshold double, gain double, is_leaf boolean, lkey long, rkey long")


def path_counts(assign: DataFrame, n_features: int, n_roots: int) -> DataFrame:
    """(path, root, j, v, c0, c1): class counts per path, root, feature and value, and the totals of
    its train and eval rows under position 0, as in ``histogram``."""
    parts = assign.select("path", "x", "w", "on").mapInArrow(
        lambda batches: SUB.histogram(batches, n_features, n_roots), SUB.HISTOGRAM_SCHEMA)
    return parts.groupBy("path", "root", "j", "v").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))


def level_job(counts: DataFrame, active: DataFrame,
              binned_flags: list[bool] | None = None) -> DataFrame:
    """The nodes of a level (NODE_SCHEMA, with root and path).  ONE job, three exchanges: aggregation of
    the tasks' counts, one window pass per (spec, node, feature) for running sums and node totals, one aggregation per
    (spec, node) returning its statistics (train / eval label counts from the role
    pseudo-feature) and its best split.  NULL feature values sort last: they go right,
    as in scoring."""
    # the depth is a column, so that every level runs the same compiled code
    own = ["gid", "root", "path", "key", "depth", "node", "parent", "block", "above", "cw0", "cw1", "w_root", "crit", "msl", "max_depth"]
    j = counts.join(active, ["path", "root"])
    win = "PARTITION BY gid, key, j ORDER BY v ASC NULLS LAST"
    c = j.selectExpr(
        *own, "j", "v", "c0", "c1",
        f"sum(c0) OVER ({win} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l0",
        f"sum(c1) OVER ({win} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l1",
        "sum(c0) OVER (PARTITION BY gid, key, j) AS tot0",
        "sum(c1) OVER (PARTITION BY gid, key, j) AS tot1",
        f"lead(v) OVER ({win}) AS v_next")
    # 'balanced' weights (null at the root) follow from the root's training class counts, which
    # are the totals of any of its features
    c = c.selectExpr(
        *own, "j", "v", "c0", "c1", "l0", "l1", "tot0", "tot1", "v_next",
        "coalesce(cw0, IF(tot0 > 0, (tot0 + tot1) / (2D * tot0), 1D)) AS u0",
        "coalesce(cw1, IF(tot1 > 0, (tot0 + tot1) / (2D * tot1), 1D)) AS u1")
    c = c.selectExpr(
        "*", "j > 0 AND v_next IS NOT NULL AND l0 + l1 >= msl AND (tot0 - l0) + (tot1 - l1) >= msl AS ok",
        "u0 * l0 AS a0", "u1 * l1 AS a1", "u0 * (tot0 - l0) AS b0", "u1 * (tot1 - l1) AS b1",
        "u0 * tot0 AS n0", "u1 * tot1 AS n1")
    c = c.selectExpr("*", f"{impurity_sql('a0', 'a1')} AS il", f"{impurity_sql('b0', 'b1')} AS ir",
                     f"{impurity_sql('n0', 'n1')} AS inode")
    # binned features split at the left bin edge, so raw values score like their bins
    flags = binned_flags or []
    is_binned = (f"element_at(array(false, {', '.join('true' if b else 'false' for b in flags)}), "
                 "cast(j AS int) + 1)" if any(flags) else "false")
    c = c.selectExpr(
        "*", f"IF({is_binned} OR (v + v_next) / 2D = v_next, v, (v + v_next) / 2D) AS thr",
        "(n0 + n1) * inode - (a0 + a1) * il - (b0 + b1) * ir AS gain")
    best = ("max_by(struct(j - 1 AS j, thr AS threshold, gain), "
            "IF(ok, struct(round(gain / (n0 + n1), 12), -j, -thr), NULL)) AS b")
    out = c.groupBy(*own).agg(
        F.expr("sum(IF(j = 0 AND v = 0, c0, 0L)) AS t0"), F.expr("sum(IF(j = 0 AND v = 0, c1, 0L)) AS t1"),
        F.expr("sum(IF(j = 0 AND v = 1, c0, 0L)) AS e0"), F.expr("sum(IF(j = 0 AND v = 1, c1, 0L)) AS e1"),
        F.expr(best))
    out = out.withColumns({
        "cw0": F.expr("coalesce(cw0, IF(t0 > 0, (t0 + t1) / (2D * t0), 1D))"),
        "cw1": F.expr("coalesce(cw1, IF(t1 > 0, (t0 + t1) / (2D * t1), 1D))")})
    out = out.selectExpr("*", "cw0 * t0 AS sum0", "cw1 * t1 AS sum1")
    out = out.selectExpr("*", f"{impurity_sql('sum0', 'sum1')} AS impurity")
    out = out.selectExpr(
        "*", "coalesce(depth >= max_depth, false) OR t0 + t1 < 2 OR t0 + t1 < 2 * msl "
             f"OR impurity <= {IMPURITY_EPS!r}D OR b IS NULL AS is_leaf")
    split = {"feature": ("cast(b.j AS int)", "-1"), "threshold": ("b.threshold", "double('NaN')"), "gain": ("b.gain", "0D"),
             "lkey": ("xxhash64(key, b.j, b.threshold, 'L')", "NULL"), "rkey": ("xxhash64(key, b.j, b.threshold, 'R')", "NULL")}
    return out.selectExpr(
        "gid", "root", "path", "key", "node", "parent", "block", "above", "depth", "t0", "t1", "e0", "e1", "cw0", "cw1",
        "coalesce(w_root, sum0 + sum1) AS w_root", "sum0 AS W0", "sum1 AS W1", "impurity",
        *(f"IF(is_leaf, {leaf}, {inner}) AS {c}" for c, (inner, leaf) in split.items() if c in ("feature", "threshold", "gain")),
        "is_leaf", *(f"IF(is_leaf, {leaf}, {inner}) AS {c}" for c, (inner, leaf) in split.items() if c in ("lkey", "rkey")))


def path_sql(side: str) -> str:
    return f"xxhash64(path, feature, threshold, '{side}')"


def children(nodes: DataFrame, depth: int) -> DataFrame:
    """The active nodes (ACTIVE_SCHEMA) of level ``depth`` from the nodes of the level above."""
    number = "IF(node < 2305843009213693952L, 2 * node{}, NULL)"  # null below level 61
    both = (f"explode(array(struct(lkey AS key, {path_sql('L')} AS path, {number.format('')} AS node), "
            f"struct(rkey AS key, {path_sql('R')} AS path, {number.format(' + 1')} AS node))) AS c")
    out = nodes.where("NOT is_leaf").selectExpr(
        "gid", "root", "depth + 1 AS depth", "key AS parent", "block AS above", "cw0", "cw1", "w_root", both)
    return out.selectExpr("gid", "root", "c.path AS path", "c.key AS key", "depth", "c.node AS node", "parent",
                          ("c.key" if depth % BAND == 0 else "above") + " AS block", "above", "cw0", "cw1", "w_root")


@dataclass
class Top:
    """Growth down to paths that fit a task: ``levels`` are the Parquet folders of the nodes above them,
    ``small`` has (assignment, active nodes, number) of those paths per level."""
    home: str
    levels: list[str]
    small: list[tuple[DataFrame, DataFrame, int]]
    flags: list[bool]


def grow(df: DataFrame, features: list[str], label: str, roots: list[Root],
         specs: list[GrowSpec], keep: list[str] | None = None,
         max_bins: int | None = None) -> Growth:
    """Grow every spec to its ``max_depth`` (None: until no node can split).

    Every threshold of every feature is tried.  ``max_bins`` is a caller's choice to bin wide
    features at approximate quantiles instead; it changes results."""
    spark = df.sparkSession
    top = grow_top(df, features, label, roots, specs, keep, max_bins)
    levels = top.levels
    if top.small:
        subtrees(top.small, len(features), len(specs), top.flags).write.parquet(f"{top.home}/local")
        levels = [*levels, f"{top.home}/local"]
    table = spark.read.schema(NODE_SCHEMA).parquet(*levels) if levels else spark.createDataFrame([], NODE_SCHEMA)
    deepest = table.agg(F.max("depth").alias("d")).first()["d"] or 0
    return Growth(features=list(features), specs={s.gid: s for s in specs}, roots={r.name: r for r in roots}, table=table, depth=deepest)


def grow_top(df: DataFrame, features: list[str], label: str, roots: list[Root], specs: list[GrowSpec],
             keep: list[str] | None = None, max_bins: int | None = None) -> Top:
    """The nodes of paths that are too large for a task.

    Both tables of a level, its nodes and the assignment that its splits lead to, are Parquet
    files under the checkpoint folder: lineage is cut at every level, a lost executor costs
    the running job's tasks, and repeated feature vectors take little room there."""
    spark = df.sparkSession
    root_by_name = {r.name: r for r in roots}
    place = {r.name: i for i, r in enumerate(roots)}
    crit_code = {"gini": 0, "entropy": 1}
    bins = fit_bins(df, features, max_bins) if max_bins else {}
    flags = [c in bins for c in features]
    cells = make_cells(df, features, label, keep or [], bins)
    home = f"{ensure_checkpoint_dir(spark).rstrip('/')}/canopy-nodes-{uuid.uuid4().hex}"

    def written(table: DataFrame, name: str) -> DataFrame:
        table.write.parquet(f"{home}/{name}")
        return spark.read.schema(table.schema).parquet(f"{home}/{name}")

    assign = written(with_counts(cells, roots), "rows-0")
    # one row per growth of the caller's grid: safe to send to every task
    rules = F.broadcast(spark.createDataFrame(
        [(s.gid, crit_code[s.criterion], s.min_samples_leaf, s.max_depth) for s in specs], SPEC_SCHEMA))
    first = []
    for s in specs:
        key = root_by_name[s.root].key
        w = (None, None) if s.class_weight == "balanced" else class_weights(s, 0, 0)
        first.append((s.gid, place[s.root], 0, key, 0, 1, None, key, None, *w, None))
    active = spark.createDataFrame(first, ACTIVE_SCHEMA)
    depth, levels, small = 0, [], []
    while True:
        sizes = written(assign.groupBy("path").agg(F.count(F.lit(1)).alias("cells")), f"sizes-{depth}")
        local, large = sizes.where(F.col("cells") <= LOCAL_CELLS), sizes.where(F.col("cells") > LOCAL_CELLS)
        n = sizes.agg(F.count_if(F.col("cells") <= LOCAL_CELLS).alias("local"), F.count_if(F.col("cells") > LOCAL_CELLS).alias("large")).first()
        if n["local"]:
            small.append((assign, active.join(rules, "gid").join(F.broadcast(local), "path"), n["local"]))
        if not n["large"]:
            break
        here = F.broadcast(large.select("path"))
        assign = assign.join(here, "path", "left_semi")
        found = written(level_job(path_counts(assign, len(features), len(roots)),
                                  active.join(rules, "gid").join(here, "path", "left_semi"), flags), f"level-{depth}")
        levels.append(f"{home}/level-{depth}")
        # growths that choose the same split of the same path share its children
        splits = found.where("NOT is_leaf").groupBy("path", "feature", "threshold").agg(F.collect_set("root").alias("on"))
        splits = splits.withColumns({"lpath": F.expr(path_sql("L")), "rpath": F.expr(path_sql("R"))})
        depth += 1
        assign = written(advance(assign, splits), f"rows-{depth}")
        active = children(found, depth)
    return Top(home, levels, small, flags)


def subtrees(small: list[tuple[DataFrame, DataFrame, int]], n_features: int, n_growths: int, flags: list[bool],
             variants: list[tuple] | None = None) -> DataFrame:
    """The nodes at and below the paths that fit one task, of all levels in one job; with ``variants`` what
    ``SUB.derived_group`` makes of them instead.  The growths of a path are shared out among tasks, each with
    the path's cells and their counts in the roots of its growths."""
    spark = small[0][0].sparkSession
    cores = spark.sparkContext.defaultParallelism
    fewest = -(-8 * cores // sum(n for _, _, n in small))
    shares = F.least(F.lit(n_growths), F.greatest(F.lit(fewest), F.ceil(F.col("cells") * n_growths / SHARE_CELLS)))
    rows, nodes = None, None
    for assign, active, _ in small:
        # neighbours in gid differ least: they share most of their paths
        a = active.withColumn("share", (F.col("gid") * shares / F.lit(n_growths)).cast("int")).drop("cells")
        of = F.broadcast(a.groupBy("path", "share").agg(F.sort_array(F.collect_set("root")).alias("on")))
        r = assign.drop("on").join(of, "path").selectExpr(
            "path", "share", "x", "flatten(transform(on, i -> slice(w, 4 * i + 1, 4))) AS w").where("exists(w, c -> c > 0)")
        rows, nodes = (r, a) if rows is None else (rows.unionByName(r), nodes.unionByName(a))
    parts = max(16 * cores, int(spark.conf.get("spark.sql.shuffle.partitions")))  # few groups meet in one task
    rows, nodes = rows.repartition(parts, "path", "share"), nodes.toDF(*nodes.columns).repartition(parts, "path", "share")
    pairs = rows.groupBy("path", "share").cogroup(nodes.groupBy("path", "share"))
    if variants is not None:
        return pairs.applyInArrow(lambda left, right: SUB.derived_group(left, right, n_features, flags, variants), SUB.DERIVED_SCHEMA)
    return pairs.applyInArrow(lambda left, right: SUB.grow_group(left, right, n_features, flags, BAND), NODE_SCHEMA)


# --------------------------------------------------------------------------- scoring by table
def score_by_table(df: DataFrame, features: list[str], growth: Growth, gid: int, leaves: DataFrame) -> DataFrame:
    """``prob`` and ``pred`` beside the rows of ``df``, for a tree of any size: rows go down the node
    table level by level, as in growth, until they reach one of ``leaves`` (key, prob, pred: the
    leaves of one derived tree).  Rows are joined, not collected; a row that is done leaves the loop."""
    inner = growth.table.where(F.col("gid") == gid).join(leaves.select("key"), "key", "left_anti")
    start = growth.roots[growth.specs[gid].root].key
    x = F.array(*(F.col(f"`{c}`").cast("double") for c in features))
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), x.alias("x"), F.lit(start).alias("key"))
    ends = leaves.select("key", "prob", "pred")
    done = None
    for depth in range(growth.depth + 1):
        here = rows.join(ends, "key")
        done = here if done is None else done.unionByName(here)
        if depth == growth.depth:
            break
        split = inner.where((F.col("depth") == depth) & ~F.col("is_leaf"))
        rows = rows.join(split.selectExpr("key", "feature AS j", "threshold", "lkey", "rkey"), "key").selectExpr(
            "row", "x", "IF(element_at(x, j + 1) <= threshold, lkey, rkey) AS key")
        if depth % 3 == 2:
            rows = cut_lineage(rows)
            if rows.isEmpty():
                break
    return done.selectExpr("row.*", "prob", "pred")


# --------------------------------------------------------------------------- single trees
def tree_of(nodes: pd.DataFrame, gid: int) -> dict[int, dict]:
    return {int(r.node): r._asdict() for r in nodes[nodes.gid == gid].itertuples(index=False)}


def leaf_prob(n: dict) -> float:
    w = n["W0"] + n["W1"]
    return n["W1"] / w if w > 0 else 0.0


def predict_expr(tree: dict[int, dict], features: list[str], what: str = "prob") -> Column:
    """A fitted tree as ONE column expression (nested CASE), usable in any select, in SQL
    and on streams; a NULL feature goes right.  ``what``: prob | pred | node | leaf (a struct of
    prob and pred: one walk for both)."""
    def build(i: int) -> Column:
        n = tree[i]
        if n["is_leaf"] or (2 * i) not in tree:
            if what == "node":
                return F.lit(i).cast("long")
            p, pred = F.lit(leaf_prob(n)), F.lit(1 if n["W1"] > n["W0"] else 0)
            if what == "leaf":
                return F.struct(p.alias("prob"), pred.alias("pred"))
            return pred if what == "pred" else p
        cond = F.col(features[int(n["feature"])]).cast("double") <= F.lit(float(n["threshold"]))
        return F.when(cond, build(2 * i)).otherwise(build(2 * i + 1))
    return build(1)


def importances(tree: dict[int, dict], features: list[str]) -> pd.DataFrame:
    """Normalised impurity decrease per feature over the internal nodes."""
    acc = {f: 0.0 for f in features}
    for i, n in tree.items():
        if n["is_leaf"] or (2 * i) not in tree:
            continue
        l, r = tree[2 * i], tree[2 * i + 1]
        dec = ((n["W0"] + n["W1"]) * n["impurity"] - (l["W0"] + l["W1"]) * l["impurity"]
               - (r["W0"] + r["W1"]) * r["impurity"])
        acc[features[int(n["feature"])]] += dec
    total = sum(acc.values())
    return pd.DataFrame({"feature": list(acc),
                         "importance": [v / total if total > 0 else 0.0 for v in acc.values()]})


# --------------------------------------------------------------------------- root splits
def root_splits(df: DataFrame, features: list[str], label: str, criterion: str = "gini",
                class_weight=None, min_samples_leaf: int = 1) -> DataFrame:
    """M1/M2/M4/M7 at the root: every valid threshold of every feature with its weighted
    impurities and gain (divided by the root weight, as scikit-learn reports it)."""
    spark = df.sparkSession
    root = Root("all", "true")
    cells = make_cells(df, features, label, [])
    assign = assign_roots(cells, [root]).cache()
    st = node_stats(assign).first()
    spec = GrowSpec(0, "all", criterion, class_weight, min_samples_leaf)
    w0, w1 = class_weights(spec, st["t0"], st["t1"])
    W = w0 * st["t0"] + w1 * st["t1"]
    imp = impurity_py(w0 * st["t0"], w1 * st["t1"], criterion)
    nodes = spark.createDataFrame(
        [(0, 1, root.key, 0 if criterion == "gini" else 1, w0, w1, min_samples_leaf,
          st["t0"], st["t1"], W * imp)], NODE_SPEC_SCHEMA)
    hist = histogram(assign).where("j > 0").selectExpr("key", "j - 1 AS j", "v", "c0", "c1")
    c = split_candidates(hist, nodes)
    names = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("j") + 1)
    return c.select(
        names.alias("feature"), F.round("threshold", 6).alias("threshold"),
        F.col("n_left").cast("long").alias("n_left"), F.col("n_right").cast("long").alias("n_right"),
        F.round("imp_left", 6).alias("impurity_left"), F.round("imp_right", 6).alias("impurity_right"),
        F.round(F.col("gain") / F.lit(W), 6).alias("gain"))
