"""Trees derived from a grown tree: depth cut, split minimum, cost-complexity pruning.

Greedy top-down growth makes a node's split independent of ``max_depth``,
``min_samples_split`` and ``ccp_alpha``; so one growth per (data, criterion, class weight,
min_samples_leaf) serves every combination of those three (SURVEY section 4c):
  1. cut: a node stays internal only if it was split, its depth < max_depth, it has at
     least ``min_samples_split`` training rows, and its parent is internal;
  2. prune: minimal cost-complexity pruning at ccp_alpha, R = weighted impurity share of
     the root weight, bottom up in one pass.
Both are done block by block.  Growth cuts a tree into blocks of ``tree.BAND`` levels, of at most
2^BAND nodes each, whatever the tree's size.  Bottom up, a block needs the costs of the blocks
below it, and gives its own root's: one ``applyInPandas`` job per band of levels, a task holding one
block at a time.  Top down, a block needs to know in which variants its root is there.  A tree of at
most BAND levels is one block and one job.
"""

from __future__ import annotations

import sys
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.operators.tree import BAND, NODE_SCHEMA, GrowSpec, Root, grow_top, subtrees
from canopy.session import ensure_checkpoint_dir

# The per-growth derivation runs in Python workers; ship this module's functions by value so
# workers need no installed copy of the library (no files, no extra PYTHONPATH).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Trees of up to so many nodes are one block, however deep.
WHOLE = 1 << 16

LEAF_SCHEMA = ("gid int, vid int, node long, key long, depth int, t0 long, t1 long, e0 long, "
               "e1 long, prob double, pred int")
#: Rows of a block: its nodes (kind 0), the roots of the blocks below with their costs (1), and the
#: variants in which its own root is there (2).
_BLOCK = ("gid int, block long, kind int, key long, lkey long, rkey long, node long, depth int, t0 long, t1 long, "
          "e0 long, e1 long, W0 double, W1 double, w_root double, impurity double, is_leaf boolean, costs binary, there binary")
_COSTS = "gid int, block long, key long, costs binary"
_DOWN = "gid int, block long, kind int, key long, vid int, node long, depth int, t0 long, t1 long, e0 long, e1 long, prob double, pred int, there binary"


@dataclass(frozen=True)
class Variant:
    vid: int
    max_depth: int | None
    min_samples_split: int = 2
    ccp_alpha: float = 0.0


def cut(nodes: dict[int, dict], max_depth: int | None, min_samples_split: int) -> set[int]:
    """Internal node ids of the cut tree (heap ids: children 2i, 2i+1)."""
    internal: set[int] = set()
    for i in sorted(nodes):
        n = nodes[i]
        if i != 1 and (i // 2) not in internal:
            continue
        if (not n["is_leaf"] and (max_depth is None or n["depth"] < max_depth)
                and n["t0"] + n["t1"] >= min_samples_split and (2 * i) in nodes):
            internal.add(i)
    return internal


def prune(nodes: dict[int, dict], internal: set[int], ccp_alpha: float) -> set[int]:
    """The smallest subtree of least cost at ``ccp_alpha``; returns the new internal set.

    Bottom up, a branch costs the lesser of R(t) + alpha (one leaf) and its children's sum,
    and collapses when the former is not greater: the subtree that weakest-link pruning
    reaches when it stops at alpha."""
    if ccp_alpha <= 0 or not internal:
        return internal
    w_root = nodes[1]["W0"] + nodes[1]["W1"]
    cost: dict[int, float] = {}
    split: set[int] = set()
    for i in sorted(internal | {c for k in internal for c in (2 * k, 2 * k + 1)}, reverse=True):
        n = nodes[i]
        cost[i] = (n["W0"] + n["W1"]) * n["impurity"] / w_root + ccp_alpha
        if i in internal and cost[i] > cost[2 * i] + cost[2 * i + 1]:
            cost[i] = cost[2 * i] + cost[2 * i + 1]
            split.add(i)
    kept: set[int] = set()
    for i in sorted(split):
        if i == 1 or i // 2 in kept:
            kept.add(i)
    return kept


def derive_group(pdf: pd.DataFrame, variants: list[Variant]) -> pd.DataFrame:
    """The leaves of every variant of one whole tree: ``cut`` and ``prune`` on arrays, level by level."""
    pdf = pdf.sort_values("node", kind="stable").reset_index(drop=True)
    node, depth = pdf["node"].to_numpy(np.int64), pdf["depth"].to_numpy(np.int64)
    left = np.searchsorted(node, 2 * node)
    left = np.where(left < len(node), left, 0)
    split = ~pdf["is_leaf"].to_numpy(bool) & (node[left] == 2 * node)
    right = left + 1  # node 2 i + 1 follows 2 i
    rows = (pdf["t0"] + pdf["t1"]).to_numpy(np.int64)
    weight = (pdf["W0"] + pdf["W1"]).to_numpy(float)
    risk = weight * pdf["impurity"].to_numpy(float) / weight[0]
    levels = [np.flatnonzero(split & (depth == d)) for d in range(int(depth.max()) + 1)]
    prob = np.divide(pdf["W1"].to_numpy(float), weight, out=np.zeros(len(node)), where=weight > 0)
    base = pdf[["gid", "node", "key", "depth", "t0", "t1", "e0", "e1"]].assign(
        prob=prob, pred=(pdf["W1"] > pdf["W0"]).astype(int))
    out = []
    for v in variants:
        keep = split & (rows >= v.min_samples_split)
        if v.max_depth is not None:
            keep &= depth < v.max_depth
        if v.ccp_alpha > 0:
            cost = risk + v.ccp_alpha
            inside, keep = keep, np.zeros(len(node), bool)
            for ids in reversed(levels):
                ids = ids[inside[ids]]
                both = cost[left[ids]] + cost[right[ids]]
                better = cost[ids] > both
                cost[ids[better]] = both[better]
                keep[ids[better]] = True
        present = np.zeros(len(node), bool)
        present[0] = True
        for ids in levels:
            ids = ids[keep[ids] & present[ids]]
            present[left[ids]] = present[right[ids]] = True
        own = base[present & ~keep]
        out.append(own.assign(vid=v.vid, n_leaves=len(own)))
    return pd.concat(out)[["gid", "vid", "node", "key", "depth", "t0", "t1", "e0", "e1", "prob", "pred", "n_leaves"]]


class Block:
    """One block's nodes and the costs of every variant, as arrays (node x variant)."""

    def __init__(self, pdf: pd.DataFrame, variants: list[Variant]):
        own = pdf[pdf["kind"] == 0].sort_values("depth", kind="stable")
        below = pdf[pdf["kind"] == 1]
        n, m = len(own), len(below)
        self.own, self.n = own, n
        self.keys = np.concatenate([own["key"].to_numpy(np.int64), below["key"].to_numpy(np.int64)])
        place = {k: i for i, k in enumerate(self.keys.tolist())}
        split = ~own["is_leaf"].to_numpy(bool)
        self.left, self.right = (np.array([place[k] if s else 0 for k, s in zip(own[c], split, strict=True)], np.int64)
                                 for c in ("lkey", "rkey"))
        depth = own["depth"].to_numpy(np.int64)
        self.levels = [np.flatnonzero(split & (depth == d)) for d in np.unique(depth)]
        weight = (own["W0"] + own["W1"]).to_numpy(float)
        self.prob = np.divide(own["W1"].to_numpy(float), weight, out=np.zeros(n), where=weight > 0)
        alpha = np.array([v.ccp_alpha for v in variants])
        deepest = np.array([np.iinfo(np.int64).max if v.max_depth is None else v.max_depth for v in variants])
        least = np.array([v.min_samples_split for v in variants])
        rows = (own["t0"] + own["t1"]).to_numpy(np.int64)
        keep = split[:, None] & (rows[:, None] >= least) & (depth[:, None] < deepest)
        self.cost = np.zeros((n + m, len(variants)))
        self.cost[:n] = (weight * own["impurity"].to_numpy(float) / own["w_root"].to_numpy(float))[:, None] + alpha
        for i, c in enumerate(below["costs"]):
            self.cost[n + i] = np.frombuffer(c)
        for ids in reversed(self.levels):  # bottom up: a branch that costs no less than a leaf collapses
            both = self.cost[self.left[ids]] + self.cost[self.right[ids]]
            better = keep[ids] & (self.cost[ids] > both)
            self.cost[ids] = np.where(better, both, self.cost[ids])
            keep[ids] = np.where(alpha > 0, better, keep[ids])
        self.keep = keep

    def present(self, root: np.ndarray) -> np.ndarray:
        """Which nodes, and roots of blocks below, are in the tree of each variant."""
        out = np.zeros((len(self.keys), root.size), bool)
        out[0] = root
        for ids in self.levels:
            out[self.left[ids]] = out[self.right[ids]] = self.keep[ids] & out[ids]
        return out


def _up(pdf: pd.DataFrame, variants: list[Variant]) -> pd.DataFrame:
    """The costs of a block's root, for the block above."""
    b = Block(pdf, variants)
    top = pdf[(pdf["kind"] == 0) & (pdf["key"] == pdf["block"])]
    return pd.DataFrame({"gid": top["gid"], "block": top["block"], "key": top["key"], "costs": [b.cost[0].tobytes()]})


def _down(pdf: pd.DataFrame, variants: list[Variant]) -> pd.DataFrame:
    """The leaves in a block of every variant's tree, and the variants that reach the blocks below."""
    b = Block(pdf, variants)
    known = pdf.loc[pdf["kind"] == 2, "there"]
    root = np.frombuffer(known.iloc[0], np.uint8).astype(bool) if len(known) else np.ones(len(variants), bool)
    present = b.present(root)
    at, v = np.nonzero(present[:b.n] & ~b.keep)
    own = b.own.iloc[at]
    leaves = own[["gid", "block", "key", "node", "depth", "t0", "t1", "e0", "e1"]].assign(
        kind=0, vid=np.array([x.vid for x in variants])[v], prob=b.prob[at], pred=(own["W1"] > own["W0"]).astype(int), there=None)
    gid, block = pdf["gid"].iloc[0], pdf["block"].iloc[0]
    on = [(k, p.astype(np.uint8).tobytes()) for k, p in zip(b.keys[b.n:].tolist(), present[b.n:], strict=True) if p.any()]
    if on:
        on = pd.DataFrame(on, columns=["key", "there"]).assign(
            gid=gid, block=block, kind=1, **{c: 0 for c in ("vid", "node", "depth", "t0", "t1", "e0", "e1", "prob", "pred")})
        leaves = pd.concat([leaves, on]) if len(leaves) else on
    return leaves[[c.split()[0] for c in _DOWN.split(", ")]]


def _merged(leaves: pd.DataFrame) -> pd.DataFrame:
    """One row per variant and prediction (prob, pred) of a block's leaves, with their summed label counts."""
    counts = leaves[leaves["kind"] == 0].groupby(["vid", "prob", "pred"], sort=False, as_index=False)[["t0", "t1", "e0", "e1"]].sum()
    rest = leaves[leaves["kind"] != 0]
    counts = counts.assign(gid=leaves["gid"].iloc[0], block=leaves["block"].iloc[0], kind=0, key=0, node=0, depth=0, there=None)
    return (pd.concat([counts, rest]) if len(rest) else counts)[leaves.columns]


class _Blocks:
    """Jobs over blocks of nodes, for some variants."""

    def __init__(self, spark: SparkSession, variants: list[Variant], merged: bool):
        self.spark, self.variants, self.merged = spark, variants, merged
        self.home = f"{ensure_checkpoint_dir(spark).rstrip('/')}/canopy-derived-{uuid.uuid4().hex}"
        # a stated number of tasks: the blocks' work does not show in their bytes
        self.tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def rows(self, df: DataFrame, kind: int, **columns: str) -> DataFrame:
        # no nulls among the numbers: pandas would make them floating point
        types = dict(c.split() for c in _BLOCK.split(", "))
        held = {**{c: c for c in df.columns}, "kind": str(kind), **columns}
        empty = {"binary": "NULL", "boolean": "true", "double": "0D", "int": "0", "long": "0L"}
        return df.selectExpr(*(f"coalesce(cast({held.get(c, 'NULL')} AS {t}), {empty[t]}) AS {c}" for c, t in types.items()))

    def kept(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.home}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.home}/{name}")

    def up(self, blocks: DataFrame) -> DataFrame:
        variants = self.variants
        return blocks.repartition(self.tasks, "gid", "block").groupBy("gid", "block").applyInPandas(lambda pdf: _up(pdf, variants), _COSTS)

    def down(self, blocks: DataFrame) -> DataFrame:
        variants, merged = self.variants, self.merged

        def leaves(pdf: pd.DataFrame) -> pd.DataFrame:
            found = _down(pdf, variants)
            return _merged(found) if merged and len(found) else found
        return blocks.repartition(self.tasks, "gid", "block").groupBy("gid", "block").applyInPandas(leaves, _DOWN)

    def ends(self, found: DataFrame) -> DataFrame:
        gone = {c: f"cast(NULL AS {t}) AS {c}" for c, t in (("node", "long"), ("key", "long"), ("depth", "int"))} if self.merged else {
            "node": "nullif(node, 0L) AS node"}
        return found.where("kind = 0").selectExpr(*(gone.get(c, c) for c in (x.split()[0] for x in LEAF_SCHEMA.split(", "))))


def derive(nodes: DataFrame, variants: list[Variant], depth: int, merged: bool = False) -> DataFrame:
    """(gid, vid, leaf...) of every growth x variant; ``depth`` is that of the deepest node.
    ``merged``: leaves of a block that predict the same come as one row, without node, key and depth."""
    b = _Blocks(nodes.sparkSession, variants, merged)
    # one row per growth of the caller's grid
    sizes = {r["gid"]: r["count"] for r in nodes.groupBy("gid").count().collect()}
    whole = [g for g, n in sizes.items() if n <= WHOLE]
    out = None
    if whole or not sizes:
        out = b.ends(b.down(b.rows(nodes.where(F.col("gid").isin(whole)).withColumn("block", F.lit(0)), 0)))
    if len(whole) == len(sizes):
        return out
    nodes = nodes.where(~F.col("gid").isin(whole))

    def band(i: int) -> DataFrame:
        return nodes.where(f"depth >= {i * BAND} AND depth < {(i + 1) * BAND}")

    last = depth // BAND
    blocks = {last: b.rows(band(last), 0)}
    for i in range(last, 0, -1):
        tops = band(i).where("key = block").select("gid", "key", F.col("above").alias("_above"))
        costs = b.kept(b.up(blocks[i]).join(tops, ["gid", "key"]), f"costs-{i}")
        blocks[i - 1] = b.rows(band(i - 1), 0).unionByName(b.rows(costs, 1, block="_above"))
    there = None
    for i in range(last + 1):
        inside = blocks[i] if there is None else blocks[i].unionByName(b.rows(there, 2, block="key")).join(
            there.selectExpr("gid", "key AS block"), ["gid", "block"], "left_semi")
        found = b.down(inside)
        if last:
            found = b.kept(found, f"found-{i}")
            there = found.where("kind = 1")
        out = b.ends(found) if out is None else out.unionByName(b.ends(found))
    return out


def derive_grown(df: DataFrame, features: list[str], label: str, roots: list[Root], specs: list[GrowSpec],
                 variants: list[Variant], keep: list[str] | None = None) -> DataFrame:
    """``derive(grow(...).table, variants, merged=True)`` without a table of all nodes: what grows inside a task is
    pruned there for every variant, as if its path were in the tree.  The tops of the trees, paths too
    large for a task, are then pruned with the costs of what is below, and say in which variants that is there."""
    top = grow_top(df, features, label, roots, specs, keep)
    b = _Blocks(df.sparkSession, variants, True)
    held = [(v.max_depth, v.min_samples_split, v.ccp_alpha) for v in variants]
    found, there = None, None
    local = b.kept(subtrees(top.small, len(features), len(specs), top.flags, held), "local") if top.small else None
    if top.levels:
        nodes = b.spark.read.schema(NODE_SCHEMA).parquet(*top.levels)
        blocks = b.rows(nodes, 0, block="0")
        if local is not None:
            blocks = blocks.unionByName(b.rows(local.where("costs IS NOT NULL").select("gid", "key", "costs"), 1, block="0"))
        found = b.kept(b.down(blocks), "top")
        there = found.where("kind = 1").select("gid", "key", "there")
        found = b.ends(found)
    if local is None:
        return found if found is not None else b.spark.createDataFrame([], LEAF_SCHEMA)
    inside = local.where("costs IS NULL")
    if there is not None:
        inside = inside.join(there, ["gid", "key"]).where("substring(there, variant + 1, 1) = X'01'")
    vids = f"element_at(array({', '.join(str(v.vid) for v in variants)}), variant + 1) AS vid"
    made = {"vid": vids, "node": "cast(NULL AS long) AS node", "key": "cast(NULL AS long) AS key", "depth": "cast(NULL AS int) AS depth"}
    inside = inside.selectExpr(*(made.get(c, c) for c in (x.split()[0] for x in LEAF_SCHEMA.split(", "))))
    return inside if found is None else found.unionByName(inside)


def derived_tree(nodes: dict[int, dict], variant: Variant) -> dict[int, dict]:
    """The derived tree of one growth as a node dict (for scoring, saving, importances)."""
    internal = prune(nodes, cut(nodes, variant.max_depth, variant.min_samples_split), variant.ccp_alpha)
    keep = {1} | {c for i in internal for c in (2 * i, 2 * i + 1)}
    out = {}
    for i in sorted(keep):
        n = dict(nodes[i])
        if i not in internal:
            n["is_leaf"] = True
        out[i] = n
    return out
