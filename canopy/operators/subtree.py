"""Tree growth on arrays, inside tasks: class counts of a slice of cells, and whole subtrees of small nodes.

Both work on *codes*: every distinct (feature, value) of the cells at hand is a number, in the order of
feature and value, NULL last within its feature.  Class counts of all roots at once are one matrix
product of the cells' 0/1 code matrix and their row counts per root and class; features with many values
are counted code by code instead.  Subtrees grow level by level, a level's nodes at once on flat arrays, and
may be pruned for every variant where they grew, so that no node leaves the task.  The rules are those of
``tree.level_job``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# shipped by value, as in ``prune``: workers need no installed copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EPS = 2.220446049250313e-16
#: Cells of a slice that is counted at once, and entries of a 0/1 matrix.
SLICE_CELLS, MATRIX = 1 << 16, 1 << 20
#: Features with more values than this are counted code by code.
WIDE = 128


class Layout:
    """Which codes are columns of the 0/1 matrix (features of few values), and which features are counted apart."""

    def __init__(self, feature: np.ndarray, n_features: int):
        self.size = len(feature)
        ends = np.searchsorted(feature, np.arange(n_features + 1))
        n_values = np.diff(ends)
        self.narrow = np.flatnonzero((n_values <= WIDE) & (n_values > 0))
        self.wide = [(j, ends[j], n_values[j]) for j in np.flatnonzero(n_values > WIDE)]
        self.dense = np.flatnonzero((n_values <= WIDE)[feature])
        self.n_dense = len(self.dense)
        self.place = np.zeros(self.size, np.int64)
        self.place[self.dense] = np.arange(self.n_dense)


class Cells:
    """Cells as arrays: ``codes`` (cell x feature), ``w`` (cell x root x 4: rows that train with label 0 and 1, and that
    evaluate), and per code its feature, value and whether it is NULL."""

    def __init__(self, table: pa.Table, n_features: int, n_roots: int):
        x = pa.concat_arrays([c.flatten() for c in table["x"].chunks]) if len(table) else pa.array([], pa.float64())
        null = np.asarray(x.is_null(nan_is_null=False).to_numpy(zero_copy_only=False)).reshape(-1, n_features)
        x = x.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(-1, n_features)
        self.codes = np.empty(x.shape, np.int32)
        feature, value, missing, at = [], [], [], 0
        for j in range(n_features):
            gone = null[:, j]
            if gone.any():
                v, c = np.unique(x[~gone, j], return_inverse=True)
                self.codes[gone, j] = at + len(v)
                self.codes[~gone, j] = at + c
            else:
                v, c = np.unique(x[:, j], return_inverse=True)
                self.codes[:, j] = at + c
            k = len(v) + int(gone.any())
            feature.append(np.full(k, j))
            value.append(np.append(v, np.zeros(k - len(v))))
            missing.append(np.arange(k) >= len(v))
            at += k
        self.feature, self.value = np.concatenate(feature).astype(np.int64), np.concatenate(value)
        self.missing = np.concatenate(missing)
        self.layout = Layout(self.feature, n_features)
        w = pa.concat_arrays([c.flatten() for c in table["w"].chunks]) if len(table) else pa.array([], pa.int64())
        self.w = w.to_numpy(zero_copy_only=False).reshape(-1, n_roots, 4)

    def counts(self, at: np.ndarray, roots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the cells ``at``: codes, training counts (code x class x root), and totals per role
        (role x class x root)."""
        used, layout = None, self.layout
        if len(self.feature) > 8 * WIDE and len(at) * self.codes.shape[1] < len(self.feature):  # few cells of a large vocabulary: only their codes
            used, codes = np.unique(self.codes[at], return_inverse=True)
            codes = codes.reshape(len(at), -1)
            layout = Layout(self.feature[used], self.codes.shape[1])
        n_codes, k = layout.size, len(roots)
        out, totals, found = np.zeros((n_codes, 2 * k)), np.zeros((k, 4)), np.zeros((layout.n_dense, 2 * k))
        for j, lo, size in layout.wide:
            own = (self.codes[at, j] if used is None else codes[:, j]) - lo
            for c, r in enumerate(roots):
                out[lo:lo + size, c] = np.bincount(own, self.w[at, r, 0], size)
                out[lo:lo + size, k + c] = np.bincount(own, self.w[at, r, 1], size)
        step = max(64, MATRIX // max(1, layout.n_dense))
        for lo in range(0, len(at), step):
            part = at[lo:lo + step]
            w = self.w[part[:, None], roots].astype(float)
            totals += w.sum(0)
            if len(layout.narrow):
                c = layout.place[(self.codes[part] if used is None else codes[lo:lo + step])[:, layout.narrow]]
                has = np.zeros((len(c), layout.n_dense))
                has[np.arange(len(c))[:, None], c] = 1.0
                found += has.T @ w[:, :, :2].transpose(0, 2, 1).reshape(len(c), 2 * k)
        out[layout.dense] = found
        return (np.arange(n_codes) if used is None else used), out.reshape(n_codes, 2, k), totals.reshape(k, 2, 2).transpose(1, 2, 0)


# --------------------------------------------------------------------------- class counts of large nodes
def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size >= SLICE_CELLS:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held)


def histogram(batches: Iterable[pa.RecordBatch], n_features: int, n_roots: int) -> Iterator[pa.RecordBatch]:
    """(path, root, j, v, c0, c1) of the cells of a task, slice by slice: position 0 is the role (0 train,
    1 eval), positions 1.. are the features, for training cells only."""
    for table in _slices(batches):
        cells, path = Cells(table, n_features, n_roots), table["path"].to_numpy()
        order = np.argsort(path, kind="stable")
        cuts = np.flatnonzero(np.diff(path[order])) + 1
        for at in np.split(order, cuts):
            roots = np.array(table["on"][at[0]].as_py())
            codes, h, totals = cells.counts(at, roots)
            parts = []
            for r in (0, 1):
                live = np.flatnonzero(totals[r].sum(0) > 0)
                parts.append((roots[live], np.zeros(len(live), int), np.full(len(live), float(r)), np.zeros(len(live), bool), totals[r][:, live].T))
            c, k = np.nonzero(h.sum(1) > 0)
            parts.append((roots[k], cells.feature[codes[c]] + 1, cells.value[codes[c]], cells.missing[codes[c]], h[c, :, k]))
            root, j, v, gone, n = (np.concatenate([p[i] for p in parts]) for i in range(5))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(root), path[at[0]])), pa.array(root.astype(np.int32)), pa.array(j.astype(np.int32)),
                pa.array(v.astype(float), mask=gone, from_pandas=False), pa.array(n[:, 0].astype(np.int64)), pa.array(n[:, 1].astype(np.int64)),
            ], names=["path", "root", "j", "v", "c0", "c1"])


HISTOGRAM_SCHEMA = "path long, root int, j int, v double, c0 long, c1 long"


# --------------------------------------------------------------------------- subtrees of small nodes
def _impurity(a: np.ndarray, b: np.ndarray, entropy: np.ndarray) -> np.ndarray:
    w = a + b
    with np.errstate(divide="ignore", invalid="ignore"):
        p, q = a / w, b / w
        gini = 1.0 - p * p - q * q
        if not entropy.any():
            return np.where(w <= 0, 0.0, gini)
        bits = -(np.where(a > 0, p * np.log2(np.where(a > 0, p, 1.0)), 0.0) + np.where(b > 0, q * np.log2(np.where(b > 0, q, 1.0)), 0.0))
    return np.where(w <= 0, 0.0, np.where(entropy, bits, gini))


def _ranges(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers start .. start + size - 1 of every range, one range behind the other, and each one's range."""
    of = np.repeat(np.arange(len(size)), size)
    return np.arange(len(of)) + (start - (np.cumsum(size) - size))[of], of


class Group:
    """The cells of one path and the growths that go on from there, as arrays.

    ``grow`` goes level by level.  A *set* is the cells of a node for one root; growths of a root
    that choose the same splits share it, and its class counts.  The nodes of a level are handled in
    blocks of arrays, not one by one."""

    def __init__(self, table: pa.Table, active: pa.Table, n_features: int, binned: list[bool]):
        self.here = here = active.to_pylist()
        roots = sorted({a["root"] for a in here})
        self.cells = c = Cells(table, n_features, len(roots))
        self.binned = np.array(binned or [False] * n_features, bool)
        # a feature that parts the cells as an earlier one does, in the same order, never wins against it
        ends, seen, self.used = np.searchsorted(c.feature, np.arange(n_features + 1)), set(), []
        for j in range(n_features):
            lo, hi = ends[j], ends[j + 1]
            own = ((c.codes[:, j] - lo).tobytes(), c.missing[lo:hi].tobytes())
            if hi - lo > 1 and own not in seen:
                seen.add(own)
                self.used.append(j)
        self.codes = np.ascontiguousarray(c.codes[:, self.used])
        column = lambda name, empty, kind: np.array([empty if a[name] is None else a[name] for a in here], kind)
        self.root = np.array([roots.index(a["root"]) for a in here])
        self.entropy, self.least = column("crit", 0, int) == 1, column("msl", 1, float)
        self.deepest, self.depth = column("max_depth", np.iinfo(np.int64).max, np.int64), here[0]["depth"]
        self.w0, self.w1, self.w_root = (column(name, np.nan, float) for name in ("cw0", "cw1", "w_root"))
        self.n_roots = len(roots)
        # both classes in one sum, as long as it is exact
        self.shift = float(1 << 26) if c.w[:, :, :2].sum() < 1 << 26 else None

    def grow(self) -> list[dict[str, np.ndarray]]:
        """The nodes of every level: their growth, counts, weights and split (``child`` -1: none), the parent's
        place in the level above (``up``) and their side of it (``right``)."""
        has = self.cells.w.any(2)
        order = [np.flatnonzero(has[:, r]).astype(np.int32) for r in range(self.n_roots)]
        size, root = np.array([len(o) for o in order]), np.arange(self.n_roots)
        order, growth, of, up = np.concatenate(order), np.arange(len(self.here)), self.root, np.full(len(self.here), -1)
        some = size[of] > 0
        growth, of, up = growth[some], of[some], up[some]
        levels, depth = [], self.depth
        while len(growth):
            start = np.cumsum(size) - size
            # blocks of whole sets; nodes come in the order of their sets
            block = np.maximum((start + size) * max(1, len(self.used)), np.arange(1, len(size) + 1) * len(self.cells.feature)) // MATRIX
            cuts = np.append(np.append(0, np.flatnonzero(np.diff(block)) + 1), len(size))
            first = np.searchsorted(of, cuts)
            parts, orders, sizes, base = [], [], [], 0
            for lo, hi, a, b in zip(cuts[:-1], cuts[1:], first[:-1], first[1:], strict=True):
                part, child_order, child_size = self._block(order, start[lo:hi], size[lo:hi], root[lo:hi], growth[a:b], of[a:b] - lo, depth)
                part["child"] = np.where(part["child"] < 0, -1, part["child"] + base)
                base += len(child_size)
                parts.append(part)
                orders.append(child_order)
                sizes.append(child_size)
            level = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]} | {"growth": growth, "up": up, "right": of % 2 == 1}
            levels.append(level)
            go = np.flatnonzero(level["child"] >= 0)
            of = np.concatenate([level["child"][go], level["child"][go] + 1])
            by = np.argsort(of, kind="stable")
            of, up, growth = of[by], np.tile(go, 2)[by], np.tile(growth[go], 2)[by]
            order, size = np.concatenate(orders), np.concatenate(sizes)
            root = np.zeros(len(size), int)
            root[of] = self.root[growth]
            depth += 1
        return levels

    def _block(self, order, start, size, root, growth, of, depth):
        cells, n = self.cells, len(size)
        at, own = _ranges(start, size)
        at = order[at]
        w = cells.w[at, root[own]].astype(float)
        t0, t1, e0, e1 = (np.bincount(own, w[:, i], n)[of] for i in range(4))
        if depth == self.depth:  # weights and the root's weight stay as they are at the tree's root
            for have, made in ((self.w0, t0), (self.w1, t1)):
                new = np.isnan(have[growth])
                have[growth[new]] = np.where(made > 0, (t0 + t1) / (2.0 * np.where(made > 0, made, 1.0)), 1.0)[new]
        w0, w1, entropy, least = self.w0[growth], self.w1[growth], self.entropy[growth], self.least[growth]
        sum0, sum1 = w0 * t0, w1 * t1
        if depth == self.depth:
            new = np.isnan(self.w_root[growth])
            self.w_root[growth[new]] = (sum0 + sum1)[new]
        impurity = _impurity(sum0, sum1, entropy)
        stop = (depth >= self.deepest[growth]) | (t0 + t1 < 2) | (t0 + t1 < 2 * least) | (impurity <= EPS)
        code, threshold, gain = np.full(len(growth), -1), np.full(len(growth), np.nan), np.zeros(len(growth))
        go = np.flatnonzero(~stop)
        if len(go):
            live = np.zeros(n, bool)
            live[of[go]] = True
            some = live[own]
            place = np.cumsum(live) - 1
            found = self._counts(at[some], place[own[some]], w[some], int(live.sum()))
            code[go], threshold[go], gain[go] = self._best(*found, place[of[go]], t0[go], t1[go], w0[go], w1[go], entropy[go], least[go])
        part = {"t0": t0, "t1": t1, "e0": e0, "e1": e1, "W0": sum0, "W1": sum1, "impurity": impurity,
                "feature": np.where(code < 0, -1, cells.feature[code]), "threshold": threshold, "gain": gain}
        # every split of a set once: its cells go left and right
        go = np.flatnonzero(code >= 0)
        key, which = np.unique(of[go] * len(cells.feature) + code[go], return_inverse=True)
        one = np.zeros(len(key), int)
        one[which] = go
        j, cut, k = part["feature"][one], threshold[one], size[of[one]]
        pos, of_split = _ranges(start[of[one]], k)
        c = order[pos]
        v = cells.codes[c, j[of_split]]
        left = (cells.value[v] <= cut[of_split]) & ~cells.missing[v]
        n_left = np.bincount(of_split, left, len(key)).astype(int)
        begin, before = np.cumsum(k) - k, np.cumsum(n_left) - n_left
        rank = np.cumsum(left) - before[of_split]  # of the left cells of the split up to here
        to = np.where(left, begin[of_split] + rank - 1, np.arange(len(c)) + n_left[of_split] - rank)
        out = np.empty_like(c)
        out[to] = c
        part["child"] = np.full(len(growth), -1)
        part["child"][go] = 2 * which
        return part, out, np.stack([n_left, k - n_left], 1).ravel()

    def _counts(self, at: np.ndarray, own: np.ndarray, w: np.ndarray, n: int):
        """(set, code, c0, c1) of the training rows, by set and code; only what occurs."""
        u = len(self.cells.feature)
        keys = (own[:, None] * u + self.codes[at]).ravel()
        back = None
        if n * u > 4 * MATRIX and n * u > 2 * len(keys):  # a large vocabulary: only the codes in use
            back, keys = np.unique(keys, return_inverse=True)
        m = n * u if back is None else len(back)
        sums = lambda x: np.bincount(keys, np.repeat(x, self.codes.shape[1]), m)
        if self.shift:
            both = sums(w[:, 0] + self.shift * w[:, 1])
            on = np.flatnonzero(both)
            c1 = np.floor(both[on] / self.shift)
            c0 = both[on] - self.shift * c1
        else:
            c0, c1 = sums(w[:, 0]), sums(w[:, 1])
            on = np.flatnonzero(c0 + c1)
            c0, c1 = c0[on], c1[on]
        pair = on if back is None else back[on]
        return pair // u, pair % u, c0, c1

    def _best(self, own, code, c0, c1, of, t0, t1, w0, w1, entropy, least):
        """Per node its best split: the code, the threshold and the gain (code -1: none)."""
        n = len(of)
        best, threshold, gain = np.full(n, -1), np.full(n, np.nan), np.zeros(n)
        feature, value = self.cells.feature, self.cells.value
        if len(own) < 2:
            return best, threshold, gain
        # a run is a set's values of one feature; a value can be split off if another follows that is not NULL
        run = np.append(True, (own[1:] != own[:-1]) | (feature[code[1:]] != feature[code[:-1]]))
        s0, s1 = np.cumsum(c0), np.cumsum(c1)
        head = np.flatnonzero(run)[np.cumsum(run) - 1]
        l0, l1 = s0 - (s0 - c0)[head], s1 - (s1 - c1)[head]
        can = np.flatnonzero(~run[1:] & ~self.cells.missing[code[1:]])
        size = np.bincount(own[can], minlength=int(of.max()) + 1)
        start = np.cumsum(size) - size
        begin = np.append(0, np.cumsum(size[of]))
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(begin[:-1] // MATRIX)) + 1, [n]])
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            nodes = np.arange(lo, hi)
            at, node = _ranges(start[of[nodes]], size[of[nodes]])
            at, node = can[at], nodes[node]
            a0, a1 = l0[at], l1[at]
            b0, b1 = t0[node] - a0, t1[node] - a1
            ok = (a0 + a1 >= least[node]) & (b0 + b1 >= least[node])
            at, node, a0, a1, b0, b1 = (x[ok] for x in (at, node, a0, a1, b0, b1))
            if not len(at):
                continue
            u0, u1, e = w0[node], w1[node], entropy[node]
            a0, a1, b0, b1 = u0 * a0, u1 * a1, u0 * b0, u1 * b1
            n0, n1 = w0[nodes] * t0[nodes], w1[nodes] * t1[nodes]
            whole, weight = ((n0 + n1) * _impurity(n0, n1, entropy[nodes]))[node - nodes[0]], (n0 + n1)[node - nodes[0]]
            g = whole - (a0 + a1) * _impurity(a0, a1, e) - (b0 + b1) * _impurity(b0, b1, e)
            with np.errstate(divide="ignore", invalid="ignore"):
                score = np.round(g / weight, 12)
            score = np.where(np.isnan(score), -np.inf, score)
            first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
            top = np.maximum.reduceat(score, first)
            # codes come by feature and value: the first of equal scores has the lowest feature, then threshold
            hit = np.flatnonzero(score == np.repeat(top, np.diff(np.append(first, len(node)))))
            hit = hit[np.append(True, node[hit[1:]] != node[hit[:-1]])]
            won, p = node[hit], at[hit]
            v, nxt = value[code[p]], value[code[p + 1]]
            half = (v + nxt) / 2.0
            keep = self.binned[feature[code[p]]] | (half == nxt) | np.isnan(nxt)
            best[won], threshold[won], gain[won] = code[p], np.where(keep, v, half), g[hit]
        return best, threshold, gain


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def child_keys(key: np.ndarray, j: np.ndarray, threshold: np.ndarray, side: int) -> np.ndarray:
    """Stable 64-bit keys of the children on one side (0 left, 1 right)."""
    golden = np.uint64(0x9E3779B97F4A7C15)
    x = _mixed(_mixed(key.astype(np.int64).view(np.uint64) + golden) ^ (threshold + 0.0).astype(np.float64).view(np.uint64))
    return _mixed(x + golden * (2 * j + side + 1).astype(np.uint64)).view(np.int64)


NODE_NAMES = ["gid", "key", "node", "parent", "block", "above", "depth", "t0", "t1", "e0", "e1", "cw0", "cw1", "w_root", "W0", "W1",
              "impurity", "feature", "threshold", "gain", "is_leaf", "lkey", "rkey"]
_INT, _REAL = ("gid", "depth", "feature"), ("cw0", "cw1", "w_root", "W0", "W1", "impurity", "threshold", "gain")
_TYPES = {c: pa.int32() if c in _INT else pa.float64() if c in _REAL else pa.bool_() if c == "is_leaf" else pa.int64() for c in NODE_NAMES}


def _columns(made: dict[str, np.ndarray], empty: dict[str, np.ndarray]) -> pa.Table:
    return pa.table({c: pa.array(made[c], _TYPES[c], mask=empty.get(c), from_pandas=False) for c in NODE_NAMES})


def grow_group(table: pa.Table, active: pa.Table, n_features: int, binned: list[bool], band: int) -> pa.Table:
    """Every node at and below one path, for the growths in ``active``; ``w`` has the counts of their roots alone."""
    if not len(table) or not len(active):
        return pa.table({c: pa.array([], _TYPES[c]) for c in NODE_NAMES})
    group = Group(table, active, n_features, binned)
    gid = np.array([a["gid"] for a in group.here])
    out, last = [], None
    for depth, level in enumerate(group.grow(), group.depth):
        growth, up = level["growth"], level["up"]
        if last is None:
            ids = {c: np.array([0 if group.here[g][c] is None else group.here[g][c] for g in growth], np.int64)
                   for c in ("key", "node", "parent", "block", "above")}
            empty = {c: np.array([group.here[g][c] is None for g in growth]) for c in ids}
        else:
            right = level["right"]
            key = np.where(right, last["rkey"][up], last["lkey"][up])
            deep = last["deep"][up] | (last["node"][up] >= 1 << 61)
            ids = {"key": key, "node": np.where(deep, 0, 2 * np.where(deep, 0, last["node"][up]) + right), "parent": last["key"][up],
                   "block": key if depth % band == 0 else last["block"][up], "above": last["block"][up]}
            empty = {"node": deep}
        leaf = level["child"] < 0
        keys = [child_keys(ids["key"], level["feature"], level["threshold"], s) for s in (0, 1)]
        made = ids | {c: level[c] for c in ("W0", "W1", "impurity", "feature", "threshold", "gain")} | {
            c: level[c].astype(np.int64) for c in ("t0", "t1", "e0", "e1")} | {
            "gid": gid[growth], "depth": np.full(len(growth), depth), "cw0": group.w0[growth], "cw1": group.w1[growth],
            "w_root": group.w_root[growth], "is_leaf": leaf, "lkey": keys[0], "rkey": keys[1]}
        out.append(_columns(made, empty | {"lkey": leaf, "rkey": leaf}))
        last = ids | {"lkey": keys[0], "rkey": keys[1], "deep": empty["node"]}
    return pa.concat_tables(out)


def derived_group(table: pa.Table, active: pa.Table, n_features: int, binned: list[bool], variants: list[tuple]) -> pa.Table:
    """What ``prune`` needs of the nodes at and below one path, if the path is in a tree: per growth and variant
    (max_depth, min_samples_split, ccp_alpha) the leaves, those of one prediction as one row, and per
    growth a row with the costs of the path's node in every variant."""
    kinds = {c.split()[0]: {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}[c.split()[1]]
             for c in DERIVED_SCHEMA.split(", ")}
    if not len(table) or not len(active):
        return pa.table({c: pa.array([], t) for c, t in kinds.items()})
    group = Group(table, active, n_features, binned)
    levels = group.grow()
    at = np.cumsum([0] + [len(x["growth"]) for x in levels])
    left, right = np.zeros(at[-1], np.int64), np.zeros(at[-1], np.int64)
    for k, x in enumerate(levels[1:], 1):
        here = np.arange(at[k], at[k + 1])
        left[at[k - 1] + x["up"][~x["right"]]] = here[~x["right"]]
        right[at[k - 1] + x["up"][x["right"]]] = here[x["right"]]
    node = {c: np.concatenate([x[c] for x in levels]) for c in ("growth", "t0", "t1", "e0", "e1", "W0", "W1", "impurity", "child")}
    depth = np.repeat(np.arange(len(levels)), np.diff(at)) + group.depth
    order, place, out = np.argsort(node["growth"], kind="stable"), np.empty(at[-1], np.int64), []
    ends = np.searchsorted(node["growth"][order], np.arange(len(group.here) + 1))
    for g, a in enumerate(group.here):
        own = order[ends[g]:ends[g + 1]]  # by depth
        if not len(own):
            continue
        place[own] = np.arange(len(own))
        n = {c: x[own] for c, x in node.items()}
        out += _derived(n, depth[own], place[left[own]], place[right[own]], group.w_root[g], a["gid"], a["key"], variants)
    return pa.concat_tables([pa.table({c: pa.array(x[c], t, from_pandas=False) for c, t in kinds.items()}) for x in out])


DERIVED_SCHEMA = "gid int, key long, variant int, prob double, pred int, t0 long, t1 long, e0 long, e1 long, costs binary"
#: Variants that are pruned at once.
VARIANTS = 16


def _derived(n: dict[str, np.ndarray], depth: np.ndarray, left: np.ndarray, right: np.ndarray, w_root: float, gid: int, key: int,
             variants: list[tuple]) -> list[dict]:
    weight, rows, split = n["W0"] + n["W1"], n["t0"] + n["t1"], n["child"] >= 0
    risk = weight * n["impurity"] / w_root
    levels = [np.flatnonzero(split & (depth == d)) for d in range(depth[0], depth[-1] + 1)]
    prob = np.divide(n["W1"], weight, out=np.zeros(len(weight)), where=weight > 0)
    pred = n["W1"] > n["W0"]
    kinds, kind = np.unique(prob, return_inverse=True)
    kind = 2 * kind + pred
    out, costs = [], np.zeros(len(variants))
    for lo in range(0, len(variants), VARIANTS):
        some = variants[lo:lo + VARIANTS]
        deepest = np.array([np.iinfo(np.int64).max if d is None else d for d, _, _ in some])
        least, alpha = np.array([m for _, m, _ in some]), np.array([a for _, _, a in some], float)
        keep = split[:, None] & (rows[:, None] >= least) & (depth[:, None] < deepest)
        cost = risk[:, None] + alpha
        for ids in reversed(levels):  # bottom up: a branch that costs no less than a leaf collapses
            both = cost[left[ids]] + cost[right[ids]]
            better = keep[ids] & (cost[ids] > both)
            cost[ids] = np.where(better, both, cost[ids])
            keep[ids] = np.where(alpha > 0, better, keep[ids])
        costs[lo:lo + VARIANTS] = cost[0]
        present = np.zeros(keep.shape, bool)
        present[0] = True
        for ids in levels:
            present[left[ids]] = present[right[ids]] = keep[ids] & present[ids]
        present &= ~keep
        for v in range(len(some)):
            leaves = np.flatnonzero(present[:, v])
            of = kind[leaves]
            found = np.flatnonzero(np.bincount(of))
            sums = {c: np.bincount(of, n[c][leaves])[found].astype(np.int64) for c in ("t0", "t1", "e0", "e1")}
            k = len(found)
            out.append({"gid": np.full(k, gid), "key": np.full(k, key), "variant": np.full(k, lo + v), "prob": kinds[found // 2],
                        "pred": found % 2, "costs": [None] * k, **sums})
    return [*out, {"gid": [gid], "key": [key], "variant": [None], "prob": [None], "pred": [None], "t0": [None], "t1": [None],
                   "e0": [None], "e1": [None], "costs": [costs.tobytes()]}]
