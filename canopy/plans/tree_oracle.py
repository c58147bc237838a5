"""DuckDB SQL for the tree queries: growth unrolled level by level over plain rows.

Independent of the DataFrame code's cells, path keys and shared histograms: every tree of every
root holds its own rows.  Per level: class counts of each node, a histogram of (feature, value),
running sums, the best threshold, and the rows' child.  Tie rule as in the library: gain share of
the node's weight to 12 digits, then lowest feature, then lowest threshold.  Pruning at a fixed
alpha needs no loop: bottom up, a node's branch costs the lesser of R(t) + alpha and the sum of its
children's costs, and a node collapses when the former is not greater.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from canopy.plans import oracle as O
from canopy.plans.search import (
    GRID_BASE,
    GRID_BASE_WIDE,
    GRID_CODED,
    GRID_DEEP,
    GRID_HOLDOUT,
    GRID_NESTED,
    GRID_NESTED_BASE,
    GRID_SMALL,
    Params,
    expand_grid,
)

EPS = "2.220446049250313e-16"
#: Levels unrolled for trees without a depth limit (at sf0.01 they end after 23).
UNROLLED = 36
BASE_FEATS = [c for c in O.FE_COLS if c not in ("respondent_id", "Coping_Struggles")]


@dataclass(frozen=True)
class Spec:
    """One tree: the rows it trains on and is evaluated on (SQL over the source), and its parameters."""

    train: str
    evaluate: str = "false"
    criterion: str = "gini"
    weights: object = None               # None | 'balanced' | (w0, w1)
    leaf: int = 1
    depth: int = 10


def _impurity(a: str, b: str) -> str:
    p, q = f"({a} / ({a} + {b}))", f"({b} / ({a} + {b}))"
    return (f"(CASE WHEN {a} + {b} <= 0 THEN 0.0 WHEN crit = 0 THEN 1.0 - {p} * {p} - {q} * {q} "
            f"ELSE -((CASE WHEN {a} > 0 THEN {p} * log2({p}) ELSE 0 END) + (CASE WHEN {b} > 0 THEN {q} * log2({q}) ELSE 0 END)) END)")


def growth(src: str, feats: list[str], specs: list[Spec]) -> list[str]:
    """CTEs ending in ``nodes`` (one row per tree and node) and ``placed`` (rid, tree, leaf node, role).

    ``src`` has respondent_id, y and the features; ``specs`` are numbered from 0 (``gid``)."""
    out = [f"lng AS MATERIALIZED (SELECT respondent_id AS rid, unnest([{', '.join(map(str, range(len(feats))))}]) AS j, "
           f"unnest([{', '.join(f'CAST({O._q(f)} AS DOUBLE)' for f in feats)}]) AS v FROM {src})"]
    rows = []
    for g, s in enumerate(specs):
        w0, w1 = s.weights if isinstance(s.weights, tuple) else (1.0, 1.0)
        rows.append(f"({g}, {0 if s.criterion == 'gini' else 1}, {w0!r}, {w1!r}, {'true' if s.weights == 'balanced' else 'false'}, {s.leaf}, {s.depth})")
    out.append("spec(gid, crit, w0, w1, bal, msl, most) AS MATERIALIZED (SELECT gid, crit, CAST(w0 AS DOUBLE), CAST(w1 AS DOUBLE), bal, msl, most "
               f"FROM (VALUES {', '.join(rows)}) t(gid, crit, w0, w1, bal, msl, most))")
    parts = " UNION ALL ".join(
        f"SELECT {g} AS gid, respondent_id AS rid, y, CASE WHEN {s.train} THEN 0 ELSE 1 END AS role, CAST(1 AS BIGINT) AS node "
        f"FROM {src} WHERE ({s.train}) OR ({s.evaluate})" for g, s in enumerate(specs))
    out.append(f"a0 AS MATERIALIZED ({parts})")
    out.append("wt AS MATERIALIZED (SELECT s.gid, crit, msl, most, CASE WHEN bal THEN CASE WHEN c0 > 0 THEN (c0 + c1) / (2.0 * c0) ELSE 1 END ELSE w0 END AS w0, "
               "CASE WHEN bal THEN CASE WHEN c1 > 0 THEN (c0 + c1) / (2.0 * c1) ELSE 1 END ELSE w1 END AS w1 FROM spec s JOIN "
               "(SELECT gid, count(*) FILTER (role = 0 AND y = 0) AS c0, count(*) FILTER (role = 0 AND y = 1) AS c1 FROM a0 GROUP BY gid) USING (gid))")
    deepest = max(s.depth for s in specs)
    for d in range(deepest + 1):
        out.append(
            f"s{d} AS MATERIALIZED (SELECT *, w0 * t0 AS m0, w1 * t1 AS m1, {_impurity('(w0 * t0)', '(w1 * t1)')} AS imp FROM "
            "(SELECT gid, node, count(*) FILTER (role = 0 AND y = 0) AS t0, count(*) FILTER (role = 0 AND y = 1) AS t1, "
            f"count(*) FILTER (role = 1 AND y = 0) AS e0, count(*) FILTER (role = 1 AND y = 1) AS e1 FROM a{d} GROUP BY gid, node) JOIN wt USING (gid))")
        out.append(
            f"h{d} AS MATERIALIZED (SELECT a.gid, a.node, l.j, l.v, count(*) FILTER (a.y = 0) AS c0, count(*) FILTER (a.y = 1) AS c1 "
            f"FROM a{d} a JOIN s{d} q ON a.gid = q.gid AND a.node = q.node JOIN lng l ON l.rid = a.rid "
            f"WHERE a.role = 0 AND {d} < q.most AND t0 + t1 >= 2 AND t0 + t1 >= 2 * msl AND imp > {EPS} GROUP BY ALL)")
        win = "(PARTITION BY h.gid, h.node, j ORDER BY v ASC NULLS LAST"
        out.append(
            f"c{d} AS (SELECT *, w0 * l0 AS p0, w1 * l1 AS p1, w0 * (t0 - l0) AS r0, w1 * (t1 - l1) AS r1 FROM (SELECT h.gid, h.node, j, v, "
            f"crit, msl, w0, w1, t0, t1, m0, m1, imp, sum(c0) OVER {win} ROWS UNBOUNDED PRECEDING) AS l0, sum(c1) OVER {win} ROWS UNBOUNDED PRECEDING) AS l1, "
            f"lead(v) OVER {win}) AS nxt FROM h{d} h JOIN s{d} q ON h.gid = q.gid AND h.node = q.node) "
            "WHERE nxt IS NOT NULL AND l0 + l1 >= msl AND t0 - l0 + t1 - l1 >= msl)")
        out.append(
            f"b{d} AS MATERIALIZED (SELECT gid, node, j, thr FROM (SELECT *, row_number() OVER (PARTITION BY gid, node ORDER BY round(gain / (m0 + m1), 12) DESC, j, thr) AS k "
            f"FROM (SELECT gid, node, j, m0, m1, CASE WHEN (v + nxt) / 2.0 = nxt THEN v ELSE (v + nxt) / 2.0 END AS thr, "
            f"(m0 + m1) * imp - (p0 + p1) * {_impurity('p0', 'p1')} - (r0 + r1) * {_impurity('r0', 'r1')} AS gain FROM c{d})) WHERE k = 1)")
        out.append(
            f"a{d + 1} AS MATERIALIZED (SELECT a.gid, a.rid, a.y, a.role, CASE WHEN l.v <= b.thr THEN 2 * a.node ELSE 2 * a.node + 1 END AS node "
            f"FROM a{d} a JOIN b{d} b ON a.gid = b.gid AND a.node = b.node JOIN lng l ON l.rid = a.rid AND l.j = b.j)")
    union = " UNION ALL ".join(
        f"SELECT s.gid, s.node, {d} AS depth, t0, t1, e0, e1, m0, m1, imp, b.j, b.thr FROM s{d} s LEFT JOIN b{d} b ON s.gid = b.gid AND s.node = b.node"
        for d in range(deepest + 1))
    out.append(f"nodes AS MATERIALIZED ({union})")
    placed = " UNION ALL ".join(
        f"SELECT a.gid, a.rid, a.y, a.role, a.node FROM a{d} a ANTI JOIN b{d} b ON a.gid = b.gid AND a.node = b.node" for d in range(deepest + 1))
    out.append(f"placed AS ({placed})")
    return out


def _name(feats: list[str]) -> str:
    return "([" + ", ".join(f"'{f}'" for f in feats) + "])[j + 1]"


def _node_select(feats: list[str], frm: str, leaf: str) -> str:
    return (f"SELECT node, depth, CASE WHEN NOT {leaf} THEN {_name(feats)} END AS feature, "
            f"CASE WHEN NOT {leaf} THEN round(thr, 6) END AS threshold, t0 + t1 AS n_samples, t0 AS n_class0, t1 AS n_class1, "
            f"round(imp, 6) AS impurity, {leaf} AS is_leaf, CASE WHEN m0 + m1 > 0 THEN round(m1 / (m0 + m1), 6) END AS prob FROM {frm}")


def _pruned(gid: int, alpha: float, deepest: int) -> list[str]:
    """CTEs ending in ``kept``: the nodes of the pruned tree, with ``gone`` where a branch was collapsed."""
    out = [f"r AS MATERIALIZED (SELECT *, (m0 + m1) * imp / (SELECT m0 + m1 FROM nodes WHERE gid = {gid} AND node = 1) AS risk FROM nodes WHERE gid = {gid})"]
    for d in range(deepest, -1, -1):
        below = "" if d == deepest else f" LEFT JOIN k{d + 1} x ON x.node = 2 * r.node LEFT JOIN k{d + 1} y ON y.node = 2 * r.node + 1"
        whole = "NULL" if d == deepest else "x.cost + y.cost"
        out.append(f"k{d} AS MATERIALIZED (SELECT r.node, CASE WHEN j IS NULL OR risk + {alpha!r} <= {whole} THEN risk + {alpha!r} ELSE {whole} END AS cost, "
                   f"(j IS NULL OR risk + {alpha!r} <= {whole}) AS gone FROM r{below} WHERE r.depth = {d})")
    out.append("v0 AS (SELECT 1 AS node, gone FROM k0)")
    for d in range(1, deepest + 1):
        out.append(f"v{d} AS (SELECT k.node, k.gone FROM k{d} k JOIN v{d - 1} p ON k.node // 2 = p.node AND NOT p.gone)")
    out.append("kept AS (SELECT r.*, v.gone FROM r JOIN (" + " UNION ALL ".join(f"SELECT * FROM v{d}" for d in range(deepest + 1)) + ") v USING (node))")
    return out


def _leaf_scores(leaves: str, group: str) -> list[str]:
    return [
        f"acc AS (SELECT {group}, CAST(sum(CASE WHEN pred = 1 THEN e1 ELSE e0 END) AS DOUBLE) / sum(e0 + e1) AS accuracy FROM {leaves} GROUP BY {group})",
        f"sc AS (SELECT {group}, prob, sum(e1) AS pos, sum(e0) AS neg FROM {leaves} GROUP BY {group}, prob)",
        f"run AS (SELECT *, sum(pos) OVER (PARTITION BY {group}) AS P, sum(neg) OVER (PARTITION BY {group}) AS N, "
        f"coalesce(sum(neg) OVER (PARTITION BY {group} ORDER BY prob ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below, "
        f"sum(pos) OVER (PARTITION BY {group} ORDER BY prob DESC ROWS UNBOUNDED PRECEDING) AS tp, "
        f"sum(neg) OVER (PARTITION BY {group} ORDER BY prob DESC ROWS UNBOUNDED PRECEDING) AS fp FROM sc)",
        f"auc AS (SELECT {group}, CASE WHEN max(P) > 0 AND max(N) > 0 THEN CAST(sum(pos * (below + 0.5 * neg)) AS DOUBLE) / (CAST(max(P) AS DOUBLE) * max(N)) END AS roc_auc, "
        f"CASE WHEN max(P) > 0 THEN sum(CASE WHEN tp + fp > 0 THEN (CAST(pos AS DOUBLE) / P) * (CAST(tp AS DOUBLE) / (tp + fp)) END) END AS average_precision FROM run GROUP BY {group})",
    ]


# ---------------------------------------------------------------- baseline strategy
_KFOLD = (f"kf AS (SELECT respondent_id, CAST((row_number() OVER (ORDER BY {O._MD5}, respondent_id) - 1) % 5 AS INTEGER) AS fold FROM survey)")
_BASE = [*O.BASE_PREFIX, O.CTE_THR, O.CTE_FE, O.CTE_RANKED, O.CTE_PARTS, O.CTE_2WAY, _KFOLD,
         "src AS MATERIALIZED (SELECT fe.*, fe.Coping_Struggles AS y, two.split, kf.fold FROM fe JOIN two USING (respondent_id) JOIN kf USING (respondent_id))"]
_ALL = Spec("true", leaf=30)
_HOLD = Spec("split = 'train'", "split = 'test'", leaf=30)
_FOLDS = [Spec(f"fold <> {f}", f"fold = {f}", leaf=30) for f in range(5)]


def _base(*specs: Spec, more: list[str] | None = None) -> str:
    return O.with_ctes(*_BASE, *growth("src", BASE_FEATS, list(specs)), *(more or []))


def _importances() -> str:
    dec = ("dec AS (SELECT p.j, (p.m0 + p.m1) * p.imp - (l.m0 + l.m1) * l.imp - (r.m0 + r.m1) * r.imp AS d FROM nodes p "
           "JOIN nodes l ON l.gid = p.gid AND l.node = 2 * p.node JOIN nodes r ON r.gid = p.gid AND r.node = 2 * p.node + 1)")
    names = "nm AS (SELECT unnest(range(" + str(len(BASE_FEATS)) + ")) AS j)"
    agg = (f"im AS (SELECT {_name(BASE_FEATS)} AS feature, coalesce(sum(d), 0) / (SELECT sum(d) FROM dec) AS importance FROM nm LEFT JOIN dec USING (j) GROUP BY j)")
    return (_base(_ALL, more=[dec, names, agg])
            + "SELECT CAST(row_number() OVER (ORDER BY importance DESC, feature) AS BIGINT) AS rank, feature, round(importance, 6) AS importance FROM im "
              "QUALIFY rank <= 10")


def _cv_scores() -> str:
    leaves = ("lv AS (SELECT gid AS fold, CASE WHEN m0 + m1 > 0 THEN m1 / (m0 + m1) ELSE 0 END AS prob, CASE WHEN m1 > m0 THEN 1 ELSE 0 END AS pred, e0, e1 "
              "FROM nodes WHERE j IS NULL)")
    both = "bt AS (SELECT fold, accuracy, roc_auc, average_precision FROM acc JOIN auc USING (fold))"
    cols = "round(accuracy, 6) AS accuracy, round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision"
    return (_base(*_FOLDS, more=[leaves, *_leaf_scores("lv", "fold"), both])
            + f"SELECT CAST(fold AS INTEGER) AS fold, {cols} FROM (SELECT * FROM bt UNION ALL "
              "SELECT -1, avg(accuracy), avg(roc_auc), avg(average_precision) FROM bt)")


def _predict(cols: str) -> str:
    return (_base(_HOLD) + f"SELECT {cols}, CAST(p.y AS INTEGER) AS y, round(CASE WHEN m0 + m1 > 0 THEN m1 / (m0 + m1) ELSE 0 END, 6) AS prob, "
            "CAST(CASE WHEN m1 > m0 THEN 1 ELSE 0 END AS INTEGER) AS pred FROM placed p JOIN nodes n ON n.gid = p.gid AND n.node = p.node WHERE p.role = 1")


# ---------------------------------------------------------------- searches
def search(src: str, feats: list[str], roots: list[tuple[str, str]], params: list[Params]) -> list[str]:
    """CTEs ending in ``leaf``: the leaves of every (root, grid row), each derived from the one growth
    of its root and growth parameters by depth cut, split minimum and pruning."""
    keys = list(dict.fromkeys(p.growth_key() for p in params))
    variants = list(dict.fromkeys(p.variant_key() for p in params))
    deepest = max(p.max_depth or UNROLLED for p in params)
    specs = []
    for train, evaluate in roots:
        for crit, cw, msl in keys:
            w = json.loads(cw)
            w = (float(w["0"]), float(w["1"])) if isinstance(w, dict) else w
            specs.append(Spec(train, evaluate, crit, w, msl, deepest))
    out = growth(src, feats, specs)
    out.append("vr(vid, md, mss, alpha) AS (VALUES " + ", ".join(f"({i}, {d or UNROLLED}, {m}, CAST({a!r} AS DOUBLE))" for i, (d, m, a) in enumerate(variants)) + ")")
    out.append("pm(param_id, gi, vid, params) AS (VALUES " + ", ".join(
        f"({i}, {keys.index(p.growth_key())}, {variants.index(p.variant_key())}, '{p.label()}')" for i, p in enumerate(params)) + ")")
    out.append(
        "tv AS MATERIALIZED (SELECT n.*, v.vid, v.alpha, (n.j IS NOT NULL AND n.depth < v.md AND n.t0 + n.t1 >= v.mss) AS inside, "
        "(n.m0 + n.m1) * n.imp / (z.m0 + z.m1) AS risk FROM nodes n JOIN nodes z ON z.gid = n.gid AND z.node = 1 CROSS JOIN vr v)")
    for d in range(deepest, -1, -1):
        join = "" if d == deepest else (f" LEFT JOIN k{d + 1} x ON x.gid = r.gid AND x.vid = r.vid AND x.node = 2 * r.node AND r.inside"
                                        f" LEFT JOIN k{d + 1} y ON y.gid = r.gid AND y.vid = r.vid AND y.node = 2 * r.node + 1 AND r.inside")
        gone = "true" if d == deepest else "(NOT inside OR (r.alpha > 0 AND risk + r.alpha <= x.cost + y.cost))"
        whole = "0" if d == deepest else "x.cost + y.cost"
        out.append(f"k{d} AS MATERIALIZED (SELECT r.gid, r.vid, r.node, {gone} AS gone, CASE WHEN {gone} THEN risk + r.alpha ELSE {whole} END AS cost "
                   f"FROM tv r{join} WHERE r.depth = {d})")
    out.append("v0 AS (SELECT gid, vid, node, gone FROM k0)")
    for d in range(1, deepest + 1):
        out.append(f"v{d} AS (SELECT k.gid, k.vid, k.node, k.gone FROM k{d} k JOIN v{d - 1} p ON k.gid = p.gid AND k.vid = p.vid AND k.node // 2 = p.node AND NOT p.gone)")
    out.append("kept AS MATERIALIZED (SELECT t.*, a.gone FROM tv t JOIN (" + " UNION ALL ".join(f"SELECT * FROM v{d}" for d in range(deepest + 1)) + ") a USING (gid, vid, node))")
    level = "depth"
    if any(p.max_depth is None for p in params):  # a tree that goes on below the last level must not pass
        level = f"CASE WHEN depth = {UNROLLED} AND t0 + t1 >= 2 AND imp > {EPS} THEN CAST(error('deeper than the levels unrolled') AS INTEGER) ELSE depth END AS depth"
    out.append(f"leaf AS MATERIALIZED (SELECT k.gid // {len(keys)} AS root, m.param_id, m.params, k.gid, k.vid, node, {level}, t0, t1, e0, e1, "
               "CASE WHEN m0 + m1 > 0 THEN m1 / (m0 + m1) ELSE 0 END AS prob, CASE WHEN m1 > m0 THEN 1 ELSE 0 END AS pred "
               f"FROM kept k JOIN pm m ON m.vid = k.vid AND m.gi = k.gid % {len(keys)} WHERE gone)")
    return out


def _renamed(ctes: list[str], tail: str) -> list[str]:
    """The score CTEs under names of their own."""
    out = []
    for c in ctes:
        for n in ("acc", "sc", "run", "auc"):
            c = re.sub(rf"\b{n}\b(?! AS accuracy)", f"{n}_{tail}", c)
        out.append(c)
    return out


def _report(leaves: str, group: str, tail: str) -> list[str]:
    """CTE ``rep_<tail>``: the class report of a leaf table's evaluation counts, with roc_auc and average_precision."""
    p1, r1, p0, r0 = (O._sd(a, b) for a, b in (("tp", "(tp + fp)"), ("tp", "(tp + fn)"), ("tn", "(tn + fn)"), ("tn", "(tn + fp)")))
    rows = [("'0'", "p0", "r0", "f0", "s0"), ("'1'", "p1", "r1", "f1", "s1"), ("'accuracy'", "NULL", "NULL", O._sd("(tp + tn)", "n"), "n"),
            ("'macro avg'", "(p0 + p1) / 2", "(r0 + r1) / 2", "(f0 + f1) / 2", "n"),
            ("'weighted avg'", *(O._sd(f"({x}0 * s0 + {x}1 * s1)", "n") for x in "prf"), "n")]
    return [
        *_renamed(_leaf_scores(leaves, group), tail),
        f"cc_{tail} AS (SELECT {group}, CAST(sum(CASE WHEN pred = 0 THEN e0 ELSE 0 END) AS DOUBLE) AS tn, CAST(sum(CASE WHEN pred = 1 THEN e0 ELSE 0 END) AS DOUBLE) AS fp, "
        f"CAST(sum(CASE WHEN pred = 0 THEN e1 ELSE 0 END) AS DOUBLE) AS fn, CAST(sum(CASE WHEN pred = 1 THEN e1 ELSE 0 END) AS DOUBLE) AS tp FROM {leaves} GROUP BY {group})",
        f"cr_{tail} AS (SELECT *, {O._sd('2 * p0 * r0', '(p0 + r0)')} AS f0, {O._sd('2 * p1 * r1', '(p1 + r1)')} AS f1 FROM (SELECT *, {p0} AS p0, {r0} AS r0, {p1} AS p1, {r1} AS r1, "
        f"tn + fp AS s0, tp + fn AS s1, tn + fp + tp + fn AS n FROM cc_{tail}))",
        f"rep_{tail} AS (SELECT r.*, a.roc_auc, a.average_precision FROM (" + " UNION ALL ".join(
            f"SELECT {group}, {lb} AS label, {p} AS precision, {r} AS recall, {f} AS f1_score, {n} AS support FROM cr_{tail}" for lb, p, r, f, n in rows)
        + f") r JOIN auc_{tail} a USING ({group}))"]


REPORT_COLS = ("label, round(CAST(precision AS DOUBLE), 6) AS precision, round(CAST(recall AS DOUBLE), 6) AS recall, round(CAST(f1_score AS DOUBLE), 6) AS f1_score, "
               "CAST(support AS BIGINT) AS support, round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision")
SCORE_COLS = "round(accuracy, 6) AS accuracy, round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision"


def _means(scoring: str = "roc_auc") -> str:
    return ("mn AS MATERIALIZED (SELECT param_id, avg(accuracy) AS mean_accuracy, avg(roc_auc) AS mean_roc_auc, avg(average_precision) AS mean_average_precision, "
            f"stddev_pop({scoring}) AS std_test_score, avg({scoring}) AS mean_test_score FROM fs GROUP BY param_id)")


_MEANS = _means()
_BEST = "best AS MATERIALIZED (SELECT param_id FROM mn ORDER BY round(mean_test_score, 12) DESC NULLS LAST, param_id LIMIT 1)"
_SUMMARY = ("SELECT m.param_id, round(mean_accuracy, 6) AS mean_accuracy, round(mean_roc_auc, 6) AS mean_roc_auc, "
            "round(mean_average_precision, 6) AS mean_average_precision, round(std_test_score, 6) AS std_test_score, round(mean_test_score, 6) AS mean_test_score, p.params, "
            "CAST(rank() OVER (ORDER BY round(mean_test_score, 12) DESC NULLS LAST) AS INTEGER) AS rank_test_score FROM mn m JOIN pm p USING (param_id)")


def _fold_scores(roots: str, group: str = "root, param_id") -> list[str]:
    """CTE ``fs``: scores of the leaves of some roots per (root, grid row)."""
    return [f"lf AS MATERIALIZED (SELECT *, root * 100000 + param_id AS rp FROM leaf WHERE {roots})", *_renamed(_leaf_scores("lf", "rp"), "f"),
            "fs AS MATERIALIZED (SELECT rp // 100000 AS root, rp % 100000 AS param_id, accuracy, roc_auc, average_precision FROM acc_f JOIN auc_f USING (rp))"]


# holdout strategy: 60/20/20, 5 shuffled folds on the training part, refits on train and train + val
_HOLD_SRC = [*O.BASE_PREFIX, O.CTE_B4, O.CTE_RANKED, O.CTE_PARTS, O.CTE_3WAY,
             f"tf AS (SELECT respondent_id, CAST((row_number() OVER (ORDER BY {O._MD5}, respondent_id) - 1) % 5 AS INTEGER) AS fold FROM three WHERE split = 'train'),\n"
             "src AS MATERIALIZED (SELECT band4.*, band4.Coping_Struggles AS y, CASE t.split WHEN 'val' THEN 5 WHEN 'test' THEN 6 ELSE tf.fold END AS fold "
             "FROM band4 JOIN three t USING (respondent_id) LEFT JOIN tf USING (respondent_id))"]
_HOLD_ROOTS = [(f"fold <= 4 AND fold <> {f}", f"fold = {f}") for f in range(5)] + [("fold <= 4", "fold = 5"), ("fold <= 5", "fold = 6")]


def _holdout(*more: str) -> str:
    return O.with_ctes(*_HOLD_SRC, *search("src", O.B4_FEATS, _HOLD_ROOTS, expand_grid(GRID_HOLDOUT)),
                       *_fold_scores("root < 5"), _MEANS, _BEST, *more)


def _holdout_sql() -> dict[str, str]:
    train = "tl AS (SELECT root, t0 AS e0, t1 AS e1, prob, pred FROM leaf WHERE root = 6 AND param_id = (SELECT param_id FROM best))"
    dec = ("bt AS (SELECT * FROM kept WHERE gid = (SELECT max(gid) FROM leaf WHERE root = 6 AND param_id = (SELECT param_id FROM best)) "
           "AND vid = (SELECT max(vid) FROM leaf WHERE root = 6 AND param_id = (SELECT param_id FROM best)))")
    gain = ("dec AS (SELECT p.j, (p.m0 + p.m1) * p.imp - (l.m0 + l.m1) * l.imp - (r.m0 + r.m1) * r.imp AS d FROM bt p "
            "JOIN bt l ON l.node = 2 * p.node JOIN bt r ON r.node = 2 * p.node + 1 WHERE NOT p.gone)")
    names = f"nm AS (SELECT unnest(range({len(O.B4_FEATS)})) AS j)"
    imp = f"im AS (SELECT {_name(O.B4_FEATS)} AS feature, coalesce(sum(d), 0) / (SELECT sum(d) FROM dec) AS importance FROM nm LEFT JOIN dec USING (j) GROUP BY j)"
    return {
        "grid_search": _holdout() + _SUMMARY,
        "best_cv_scores": _holdout("bf AS (SELECT root AS fold, accuracy, roc_auc, average_precision FROM fs WHERE param_id = (SELECT param_id FROM best))")
        + f"SELECT CAST(fold AS INTEGER) AS fold, {SCORE_COLS} FROM (SELECT * FROM bf UNION ALL SELECT -1, avg(accuracy), avg(roc_auc), avg(average_precision) FROM bf)",
        "final_test_report": _holdout("el AS (SELECT * FROM leaf WHERE root >= 5 AND param_id = (SELECT param_id FROM best))", *_report("el", "root", "t"))
        + f"SELECT CASE root WHEN 5 THEN 'val' ELSE 'test' END AS split, {REPORT_COLS} FROM rep_t",
        "final_train_report": _holdout(train, *_report("tl", "root", "t")) + f"SELECT 'train+val' AS split, {REPORT_COLS} FROM rep_t",
        "final_importances": _holdout(dec, gain, names, imp)
        + "SELECT CAST(row_number() OVER (ORDER BY importance DESC, feature) AS BIGINT) AS rank, feature, round(importance, 6) AS importance FROM im QUALIFY rank <= 10",
    }


# nested strategy: 80/20, outer 5 x inner 3, then unshuffled 5-fold on the training part
def _nested_src() -> list[str]:
    md5 = O._MD5
    inner = "".join(f", CASE WHEN o.ofold <> {o} THEN CAST((row_number() OVER (PARTITION BY o.Coping_Struggles, o.ofold <> {o} ORDER BY o.h, o.respondent_id) - 1) % 3 AS INTEGER) ELSE -1 END AS inner_{o}"
                    for o in range(5))
    size = lambda f: f"(floor((s + n - 1 - {f} + 5) / 5) - floor((s - 1 - {f} + 5) / 5))"
    upto = ", ".join("(" + " + ".join(size(f) for f in range(i + 1)) + f") AS c{i}" for i in range(4))
    return [
        *O._years_ctes(), O.CTE_RANKED, O.CTE_PARTS, O.CTE_2WAY,
        f"ot AS (SELECT respondent_id, Coping_Struggles, {md5} AS h, CAST((row_number() OVER (PARTITION BY Coping_Struggles ORDER BY {md5}, respondent_id) - 1) % 5 AS INTEGER) AS ofold FROM two WHERE split = 'train')",
        "inn AS (SELECT o.*" + inner + " FROM ot o)",
        "cl AS (SELECT Coping_Struggles, n, coalesce(sum(n) OVER (ORDER BY first_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s "
        "FROM (SELECT Coping_Struggles, count(*) AS n, min(respondent_id) AS first_id FROM ot GROUP BY Coping_Struggles))",
        f"cl2 AS (SELECT Coping_Struggles, {upto} FROM cl)",
        "cf AS (SELECT respondent_id, CASE WHEN r <= c0 THEN 0 WHEN r <= c1 THEN 1 WHEN r <= c2 THEN 2 WHEN r <= c3 THEN 3 ELSE 4 END AS cfold FROM "
        "(SELECT respondent_id, Coping_Struggles, row_number() OVER (PARTITION BY Coping_Struggles ORDER BY respondent_id) AS r FROM ot) JOIN cl2 USING (Coping_Struggles))",
        "src AS MATERIALIZED (SELECT yr.*, yr.Coping_Struggles AS y, two.split, coalesce(inn.ofold, -1) AS ofold, "
        + ", ".join(f"coalesce(inner_{o}, -1) AS inner_{o}" for o in range(5)) + ", coalesce(cf.cfold, -1) AS cfold FROM yr JOIN two USING (respondent_id) "
        "LEFT JOIN inn USING (respondent_id) LEFT JOIN cf USING (respondent_id))"]


_NEST_ROOTS = ([(f"split = 'train' AND ofold <> {o} AND inner_{o} <> {i}", f"split = 'train' AND ofold <> {o} AND inner_{o} = {i}")
                for o in range(5) for i in range(3)]
               + [(f"split = 'train' AND cfold <> {f}", f"split = 'train' AND cfold = {f}") for f in range(5)]
               + [(f"split = 'train' AND ofold <> {o}", f"split = 'train' AND ofold = {o}") for o in range(5)]
               + [("split = 'train'", "split = 'test'")])


def _nested_sql() -> dict[str, str]:
    params = expand_grid(GRID_NESTED)
    grown = [*_nested_src(), *search("src", O.YEAR_FEATS, _NEST_ROOTS, params)]
    inner = ["win AS MATERIALIZED (SELECT ofold, param_id FROM (SELECT root // 3 AS ofold, param_id, avg(roc_auc) AS a FROM fs GROUP BY ALL) "
             "QUALIFY row_number() OVER (PARTITION BY ofold ORDER BY round(a, 12) DESC NULLS LAST, param_id) = 1)",
             "ol AS (SELECT l.*, w.ofold FROM leaf l JOIN win w ON l.root = 20 + w.ofold AND l.param_id = w.param_id)",
             *_renamed(_leaf_scores("ol", "ofold"), "o"),
             "nr AS (SELECT ofold, accuracy, roc_auc, average_precision, w.param_id, p.params FROM acc_o JOIN auc_o USING (ofold) JOIN win w USING (ofold) JOIN pm p ON p.param_id = w.param_id)"]
    final = [*_fold_scores("root BETWEEN 15 AND 19"), _MEANS, _BEST]
    # the best row's leaves of the five outer growths, and the ancestors of the rows placed in them
    n_keys, deepest = len({p.growth_key() for p in params}), max(p.max_depth for p in params)
    placed = ["bl AS MATERIALIZED (SELECT gid, node, prob, pred FROM leaf WHERE root BETWEEN 20 AND 24 AND param_id = (SELECT param_id FROM best))",
              f"up AS MATERIALIZED (SELECT rid, gid, y, node >> s AS node FROM placed, range({deepest + 1}) u(s) "
              "WHERE role = 1 AND gid IN (SELECT gid FROM bl) AND (node >> s) >= 1)",
              f"pl AS (SELECT rid, gid // {n_keys} AS root, y, prob, pred FROM up JOIN bl USING (gid, node))"]
    return {
        "nested_cv": O.with_ctes(*grown, *_fold_scores("root < 15"), *inner)
        + f'SELECT CAST(ofold AS INTEGER) AS "outer", {SCORE_COLS}, param_id, params FROM (SELECT * FROM nr UNION ALL '
          "SELECT -1, avg(accuracy), avg(roc_auc), avg(average_precision), NULL, NULL FROM nr)",
        "oof_predictions": O.with_ctes(*grown, *final, *placed)
        + "SELECT rid AS respondent_id, CAST(root - 20 AS INTEGER) AS fold, CAST(y AS INTEGER) AS y, round(prob, 6) AS prob, CAST(pred AS INTEGER) AS pred FROM pl",
        "nested_test_report": O.with_ctes(*grown, *final, "el AS (SELECT * FROM leaf WHERE root = 25 AND param_id = (SELECT param_id FROM best))", *_report("el", "root", "t"))
        + f"SELECT {REPORT_COLS} FROM rep_t",
    }


# further searches
def _search_base() -> str:
    roots = [(f"fold <> {f}", f"fold = {f}") for f in range(5)]
    return O.with_ctes(*_BASE, *search("src", BASE_FEATS, roots, expand_grid(GRID_BASE)), *_fold_scores("true"), _means("accuracy")) + _SUMMARY


def _tuned(name: str, prefix: list[str], table: str, feats: list[str], grid: dict, scoring: str) -> dict[str, str]:
    """The holdout strategy's split with another bundle, grid and score: the search, and the winner on val and test."""
    src = (f"tf AS (SELECT respondent_id, CAST((row_number() OVER (ORDER BY {O._MD5}, respondent_id) - 1) % 5 AS INTEGER) AS fold FROM three WHERE split = 'train'),\n"
           f"src AS MATERIALIZED (SELECT b.*, b.Coping_Struggles AS y, CASE t.split WHEN 'val' THEN 5 WHEN 'test' THEN 6 ELSE tf.fold END AS fold "
           f"FROM {table} b JOIN three t USING (respondent_id) LEFT JOIN tf USING (respondent_id))")
    head = [*prefix, O.CTE_RANKED, O.CTE_PARTS, O.CTE_3WAY, src, *search("src", feats, _HOLD_ROOTS, expand_grid(grid)),
            *_fold_scores("root < 5"), _means(scoring), _BEST]
    return {
        f"search_{name}": O.with_ctes(*head) + _SUMMARY,
        f"report_{name}": O.with_ctes(*head, "el AS (SELECT * FROM leaf WHERE root >= 5 AND param_id = (SELECT param_id FROM best))", *_report("el", "root", "t"))
        + f"SELECT CASE root WHEN 5 THEN 'val' ELSE 'test' END AS split, {REPORT_COLS} FROM rep_t",
    }


def _nested_all(name: str, prefix: list[str], table: str, feats: list[str], grid: dict, scoring: str, classes: bool = True) -> dict[str, str]:
    """All rows, 5 x 5 (stratified with `classes`): inner winners on their outer folds, pooled, and the final search."""
    part, by = ("o.Coping_Struggles, ", "PARTITION BY Coping_Struggles ") if classes else ("", "")
    inner = "".join(f", CASE WHEN o.ofold <> {o} THEN CAST((row_number() OVER (PARTITION BY {part}o.ofold <> {o} ORDER BY o.h, o.respondent_id) - 1) % 5 AS INTEGER) ELSE -1 END AS inner_{o}"
                    for o in range(5))
    src = [f"ot AS (SELECT respondent_id, Coping_Struggles, {O._MD5} AS h, CAST((row_number() OVER ({by}ORDER BY {O._MD5}, respondent_id) - 1) % 5 AS INTEGER) AS ofold FROM survey)",
           f"inn AS (SELECT o.*{inner} FROM ot o)",
           f"src AS MATERIALIZED (SELECT t.*, t.Coping_Struggles AS y, ofold, {', '.join(f'inner_{o}' for o in range(5))} FROM {table} t JOIN inn USING (respondent_id))"]
    roots = [(f"ofold <> {o} AND inner_{o} <> {i}", f"ofold <> {o} AND inner_{o} = {i}") for o in range(5) for i in range(5)]
    roots += [(f"ofold <> {o}", f"ofold = {o}") for o in range(5)]
    params = expand_grid(grid)
    grown = [*prefix, *src, *search("src", feats, roots, params)]
    win = (f"win AS MATERIALIZED (SELECT ofold, param_id FROM (SELECT root // 5 AS ofold, param_id, avg({scoring}) AS a FROM fs GROUP BY ALL) "
           "QUALIFY row_number() OVER (PARTITION BY ofold ORDER BY round(a, 12) DESC NULLS LAST, param_id) = 1)")
    ol = "ol AS (SELECT l.*, w.ofold, 'oof' AS split FROM leaf l JOIN win w ON l.root = 25 + w.ofold AND l.param_id = w.param_id)"
    nr = "nr AS (SELECT ofold, accuracy, roc_auc, average_precision, w.param_id, p.params FROM acc_o JOIN auc_o USING (ofold) JOIN win w USING (ofold) JOIN pm p ON p.param_id = w.param_id)"
    last = search("src", feats, roots[25:], params)
    return {
        f"nested_{name}": O.with_ctes(*grown, *_fold_scores("root < 25"), win, ol, *_renamed(_leaf_scores("ol", "ofold"), "o"), nr)
        + f'SELECT CAST(ofold AS INTEGER) AS "outer", {SCORE_COLS}, param_id, params FROM (SELECT * FROM nr UNION ALL '
          "SELECT -1, avg(accuracy), avg(roc_auc), avg(average_precision), NULL, NULL FROM nr)",
        f"oof_report_{name}": O.with_ctes(*grown, *_fold_scores("root < 25"), win, ol, *_report("ol", "split", "t")) + f"SELECT split, {REPORT_COLS} FROM rep_t",
        f"search_{name if name != 'base' else 'base_nested'}": O.with_ctes(*prefix, *src, *last, *_fold_scores("true"), _means(scoring)) + _SUMMARY,
    }


# ---------------------------------------------------------------- curves of the fitted models
def _model_leaves() -> str:
    """CTE ``ml``: evaluation counts per leaf of each strategy's fitted trees."""
    prob = "CASE WHEN m0 + m1 > 0 THEN m1 / (m0 + m1) ELSE 0 END AS prob, CASE WHEN m1 > m0 THEN 1 ELSE 0 END AS pred"
    base = _base(_HOLD) + f"SELECT 'baseline' AS strategy, 'test' AS split, {prob}, e0, e1 FROM nodes WHERE j IS NULL"
    hold = _holdout() + ("SELECT 'holdout', CASE root WHEN 5 THEN 'val' ELSE 'test' END, prob, pred, e0, e1 FROM leaf "
                         "WHERE root >= 5 AND param_id = (SELECT param_id FROM best)")
    nest = O.with_ctes(*_nested_src(), *search("src", O.YEAR_FEATS, _NEST_ROOTS[15:], expand_grid(GRID_NESTED)),
                       *_fold_scores("root < 5"), _MEANS, _BEST) + (
        "SELECT 'nested', CASE WHEN root < 10 THEN 'oof' ELSE 'test' END, prob, pred, e0, e1 FROM leaf WHERE root >= 5 AND param_id = (SELECT param_id FROM best)")
    return "ml AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM ({q})" for q in (base, hold, nest)) + ")"


def _curves() -> list[str]:
    k = "strategy, split"
    w = f"PARTITION BY {k}"
    return [_model_leaves(), f"cnt AS (SELECT {k}, prob AS score, sum(e1) AS pos, sum(e0) AS neg FROM ml GROUP BY ALL)",
            f"cum AS (SELECT *, CAST(sum(pos) OVER ({w}) AS DOUBLE) AS P, CAST(sum(neg) OVER ({w}) AS DOUBLE) AS N, "
            f"CAST(sum(pos) OVER ({w} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS tp, CAST(sum(neg) OVER ({w} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS fp, "
            f"row_number() OVER ({w} ORDER BY score DESC) AS i FROM cnt)"]


def _curve_sql() -> dict[str, str]:
    roc = [*_curves(), "flt AS (SELECT * FROM (SELECT *, lag(tp) OVER o AS ptp, lead(tp) OVER o AS ntp, lag(fp) OVER o AS pfp, lead(fp) OVER o AS nfp FROM cum "
           "WINDOW o AS (PARTITION BY strategy, split ORDER BY i)) WHERE ptp IS NULL OR ntp IS NULL OR ntp - 2 * tp + ptp <> 0 OR nfp - 2 * fp + pfp <> 0)",
           "pts AS (SELECT strategy, split, score AS threshold, tp, fp, P, N, i FROM flt UNION ALL "
           "SELECT strategy, split, CAST('infinity' AS DOUBLE), 0, 0, P, N, 0 FROM cum WHERE i = 1)"]
    return {
        "model_roc_curve": O.with_ctes(*roc) + "SELECT strategy, split, CAST(row_number() OVER (PARTITION BY strategy, split ORDER BY i) - 1 AS INTEGER) AS point, "
        "round(threshold, 6) AS threshold, round(CASE WHEN N > 0 THEN fp / N END, 6) AS fpr, round(CASE WHEN P > 0 THEN tp / P END, 6) AS tpr FROM pts",
        "model_pr_curve": O.with_ctes(*_curves()) + "SELECT strategy, split, CAST(i AS INTEGER) AS point, round(score, 6) AS threshold, round(tp / (tp + fp), 6) AS precision, "
        "round(CASE WHEN P > 0 THEN tp / P ELSE 1 END, 6) AS recall FROM cum UNION ALL SELECT strategy, split, 0, NULL, 1.0, 0.0 FROM cum WHERE i = 1",
        "model_confusion": O.with_ctes(_model_leaves()) + "SELECT strategy, split, y, pred, CAST(sum(n) AS BIGINT) AS n FROM ("
        "SELECT strategy, split, 0 AS y, p.pred, CASE WHEN p.pred = ml.pred THEN e0 ELSE 0 END AS n FROM ml, (VALUES (0), (1)) p(pred) UNION ALL "
        "SELECT strategy, split, 1, p.pred, CASE WHEN p.pred = ml.pred THEN e1 ELSE 0 END FROM ml, (VALUES (0), (1)) p(pred)) GROUP BY ALL",
    }


def _stream_scores() -> str:
    src = "src AS MATERIALIZED (SELECT band4.*, Coping_Struggles AS y FROM band4)"
    return (O.with_ctes(*O.BASE_PREFIX, O.CTE_B4, src, *growth("src", O.B4_FEATS, [Spec("true", depth=5)]))
            + "SELECT p.rid AS respondent_id, CAST(p.y AS INTEGER) AS y, round(CASE WHEN m0 + m1 > 0 THEN m1 / (m0 + m1) ELSE 0 END, 6) AS prob, "
              "CAST(CASE WHEN m1 > m0 THEN 1 ELSE 0 END AS INTEGER) AS pred FROM placed p JOIN nodes n ON n.gid = p.gid AND n.node = p.node")


# ---------------------------------------------------------------- features fitted on training rows
def _fitted_on(tail: object, parts: str, train: str) -> list[str]:
    """CTEs ``med``, ``imp``, ``pp``, ``thr``, ``fe`` with a tail: fitted on the rows of ``parts`` that meet ``train``."""
    rows = f" JOIN {parts} USING (respondent_id) WHERE {train}"
    named = lambda cte: re.sub(r"^(\w+) AS", rf"\g<1>{tail} AS", cte)
    return [named(O.CTE_MED).replace("FROM mapped", f"FROM mapped{rows}"),
            named(O.CTE_IMP).replace("CROSS JOIN med", f"CROSS JOIN med{tail} AS med"),
            named(O.CTE_PP).replace("FROM imp", f"FROM imp{tail}"),
            named(O.CTE_THR).replace("FROM pp", f"FROM pp{tail}{rows}"),
            named(O.CTE_FE).replace("FROM pp CROSS JOIN thr", f"FROM pp{tail} AS pp CROSS JOIN thr{tail} AS thr")]


def _infold() -> dict[str, str]:
    """Every row once per fold, under an id of its own, with that fold's medians and thresholds."""
    head = [O.CTE_SURVEY, O.CTE_MAPPED, _KFOLD]
    for f in range(5):
        head += _fitted_on(f, "kf", f"fold <> {f}")
    each = " UNION ALL ".join(f"SELECT e.* REPLACE (e.respondent_id * 8 + {f} AS respondent_id), e.Coping_Struggles AS y, kf.fold, {f} AS fit_fold "
                              f"FROM fe{f} e JOIN kf ON kf.respondent_id = e.respondent_id" for f in range(5))
    head.append(f"src AS MATERIALIZED ({each})")
    roots = [(f"fit_fold = {f} AND fold <> {f}", f"fit_fold = {f} AND fold = {f}") for f in range(5)]
    tuned = [*head, *search("src", BASE_FEATS, roots, expand_grid(GRID_BASE)), *_fold_scores("true"), _means("accuracy")]
    plain = [*head, *search("src", BASE_FEATS, roots, [Params(class_weight="balanced")])]
    return {
        "search_base_infold": O.with_ctes(*tuned) + _SUMMARY,
        "cv_untuned_infold": O.with_ctes(*plain, *_fold_scores("true")) + f"SELECT CAST(root AS INTEGER) AS fold, {SCORE_COLS} FROM "
        "(SELECT root, accuracy, roc_auc, average_precision FROM fs UNION ALL SELECT -1, avg(accuracy), avg(roc_auc), avg(average_precision) FROM fs)",
        "oof_report_untuned": O.with_ctes(*plain, "ol AS (SELECT *, 'oof' AS split FROM leaf)", *_report("ol", "split", "t")) + f"SELECT split, {REPORT_COLS} FROM rep_t",
    }


def _saved_model() -> dict[str, str]:
    """Medians, thresholds and tree from the training part alone, scored on the test part."""
    head = [O.CTE_SURVEY, O.CTE_MAPPED, O.CTE_RANKED, O.CTE_PARTS, O.CTE_2WAY, *_fitted_on("_t", "two", "split = 'train'"),
            "src AS MATERIALIZED (SELECT e.*, e.Coping_Struggles AS y, two.split FROM fe_t e JOIN two ON two.respondent_id = e.respondent_id)",
            *growth("src", BASE_FEATS, [_HOLD]),
            "tl AS (SELECT 'test' AS split, node, CASE WHEN m0 + m1 > 0 THEN m1 / (m0 + m1) ELSE 0 END AS prob, CASE WHEN m1 > m0 THEN 1 ELSE 0 END AS pred, e0, e1 "
            "FROM nodes WHERE j IS NULL)"]
    return {
        "score_saved_model": O.with_ctes(*head) + "SELECT p.rid AS respondent_id, CAST(p.y AS INTEGER) AS y, round(prob, 6) AS prob, CAST(pred AS INTEGER) AS pred "
        "FROM placed p JOIN tl USING (node) WHERE p.role = 1",
        "saved_model_report": O.with_ctes(*head, *_report("tl", "split", "t")) + f"SELECT split, {REPORT_COLS} FROM rep_t",
    }


def _dtype_report() -> str:
    return ("SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name, CASE column_type WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END AS data_type "
            "FROM (DESCRIBE " + O.with_ctes(*O.BASE_PREFIX) + "SELECT " + ", ".join(O._q(c) for c in O.PP_COLS) + " FROM pp)")


def tree_oracle_sql() -> dict[str, str]:
    return {
        **_curve_sql(),
        **_infold(),
        **_saved_model(),
        "search_base": _search_base(),
        **_nested_all("banded4", [*O.BASE_PREFIX, O.CTE_B4], "band4", O.B4_FEATS, GRID_SMALL, "accuracy"),
        **_nested_all("coded", [O.CTE_SURVEY, O.CTE_CS, O.CTE_CODED], "coded", O.CODED_FEATS, GRID_CODED, "roc_auc"),
        **_nested_all("base", [*O.BASE_PREFIX, O.CTE_THR, O.CTE_FE], "fe", BASE_FEATS, GRID_NESTED_BASE, "accuracy", classes=False),
        **_tuned("base_wide", [*O.BASE_PREFIX, O.CTE_THR, O.CTE_FE], "fe", BASE_FEATS, GRID_BASE_WIDE, "accuracy"),
        **_tuned("base_deep", [*O.BASE_PREFIX, O.CTE_THR, O.CTE_FE], "fe", BASE_FEATS, GRID_DEEP, "accuracy"),
        **_tuned("banded3", [*O.BASE_PREFIX, O.CTE_B3], "band3", O.B3_FEATS, GRID_DEEP, "roc_auc"),
        "stream_scores": _stream_scores(),
        "dtype_report": _dtype_report(),
        **_holdout_sql(),
        **_nested_sql(),
        "tree_nodes": _base(_ALL) + _node_select(BASE_FEATS, "nodes", "(j IS NULL)"),
        "tree_importances": _importances(),
        "cv_scores": _cv_scores(),
        "tree_predict": _predict("p.rid AS respondent_id, 'test' AS split"),
        "model_roundtrip": _predict("p.rid AS respondent_id"),
        "tree_pruned": _base(_ALL, more=_pruned(0, 0.001, 10)) + _node_select(BASE_FEATS, "kept", "gone"),
    }
