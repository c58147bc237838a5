"""Quality rules with robust multivariate outliers (op 1).

Counts of words, symbols, repeated lines and repeated five-word windows give a base rule and five
transformed statistics per document. For each language and source, a minimum-covariance-determinant
(MCD) estimate of their mean and covariance is found by concentration steps: take the share H of
rows that are nearest by the present estimate, estimate again from these, repeat. A document that
passes the base rule is kept unless its squared Mahalanobis distance exceeds the chi-square
quantile at 1 - alpha.

The statistics are integers (multiples of 1/SCALE) and every sum is an exact integer sum, so the
estimates do not depend on how rows are partitioned. Per group only sums move: a group that holds a
third of all rows is pre-aggregated like any other. Estimates are a table with one row per group,
joined, not collected. FLOOR is added to the covariance (a ridge), because most documents have no
symbol or repetition at all and the plain MCD would be singular.

A group with under MIN_ROWS rows is pooled with its language's other small groups, and these, if
still under MIN_ROWS, over languages; if even that is under MIN_ROWS, its documents are judged by
the base rule alone. Null language or source count as a value of their own. Null and empty texts
have no words, fail the base rule and are not kept. Repeated rows are judged each. Empty tables
give no rows. Only doc_id, text, lang and source are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import append, aside, counted, restored, ship, written
from .words import ngram_hashes, word_hashes

SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
NAMES = ["x_length", "x_word", "x_symbols", "x_lines", "x_repeats"]
P = len(NAMES)
SCALE, PRIOR_WORDS, PRIOR_WORD_CHARS = 1024, 50, 5
#: Least standard deviation allowed for each statistic.
FLOOR = (0.5, 0.05, 0.1, 0.15, 0.15)
H, STEPS, MIN_ROWS, ALPHA = 0.75, 6, 50, 1e-5
#: Group tables of up to so many rows (of some 300 bytes) are broadcast: the rows of a large group
#: then need not meet in one task.
BROADCAST_GROUPS = 50_000


def chi2_cdf(x: float, k: int) -> float:
    """Chi-square distribution function by the series of the incomplete gamma function."""
    a, y = k / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > total * 1e-16:
        n += 1
        term *= y / (a + n)
        total += term
    return total * math.exp(-y + a * math.log(y) - math.lgamma(a)) if y > 0 else 0.0


def chi2_quantile(p: float, k: int) -> float:
    lo, hi = 0.0, 1.0
    while chi2_cdf(hi, k) < p:
        hi *= 2
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < p else (lo, mid)
    return hi


#: Makes the covariance of the nearest share H of normal rows consistent.
CONSISTENCY = H / chi2_cdf(chi2_quantile(H, P), P + 2)


def counts(text: bytes | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a UTF-8 text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.split()
    s = text.decode("utf-8", "replace")
    chars = len(s) - sum(s.count(c) for c in " \t\n\r\x0b\x0c")
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return (len(words), chars, sum(s.count(c) for c in SYMBOLS), len(lines) - len(set(lines)),
            repeated_words(words))


def repeated_words(words: list[bytes], n: int = 5) -> int:
    """Words that lie in a window of n words found at least twice."""
    g = ngram_hashes(word_hashes(words), n)
    order = np.argsort(g, kind="stable")
    same = g[order][1:] == g[order][:-1]
    if not same.any():
        return 0
    twice = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    at = order[twice]
    edge = np.bincount(at, minlength=len(words) + 1) - np.bincount(at + n, minlength=len(words) + 1)
    return int((np.cumsum(edge) > 0).sum())


def measure(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Counts, base rule, and the transformed statistics as integers, beside the columns `keep`."""
    df = append(docs, text, lambda texts: [counts(t) for t in texts],
                ", ".join(f"{c} long" for c in COUNTS), keep, ("words",))
    n = F.col("n_words") + PRIOR_WORDS
    x = [F.log1p("n_words"), F.log((F.col("word_chars") + PRIOR_WORDS * PRIOR_WORD_CHARS) / n),
         F.sqrt(F.col("n_symbols") / n), F.sqrt(10 * F.col("n_dup_lines") / n), F.sqrt(F.col("n_repeat_words") / n)]
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return df.select("*", failed.alias("base_failed"),
                     *(F.round(e * SCALE).cast("long").alias(name) for e, name in zip(x, NAMES, strict=True)))


def grouped(stats: DataFrame, lang: Column, source: Column) -> DataFrame:
    """Adds `gid`: (language, source), or a pool of small groups, or null if even that is small."""
    own, pool = ["_lang", "_source", "_nl", "_ns"], ["_lang", "_nl"]
    stats = stats.select("*", F.coalesce(lang, F.lit("")).alias("_lang"), F.coalesce(source, F.lit("")).alias("_source"),
                         lang.isNull().alias("_nl"), source.isNull().alias("_ns"))
    sizes = stats.filter(~F.col("base_failed")).groupBy(*own).agg(F.count("*").alias("n"))
    small = sizes.filter(F.col("n") < MIN_ROWS)
    by_lang = small.groupBy(*pool).agg(F.sum("n").alias("n_lang"))
    rest = by_lang.filter(F.col("n_lang") < MIN_ROWS).agg(F.coalesce(F.sum("n_lang"), F.lit(0)).alias("n_all"))
    key = lambda kind, cols: F.concat_ws("\x1f", F.lit(kind), *(F.col(c).cast("string") for c in cols))
    gid = (F.when(F.col("n") >= MIN_ROWS, key("s", own)).when(F.col("n_lang") >= MIN_ROWS, key("l", pool))
           .when(F.col("n_all") >= MIN_ROWS, F.lit("all")))
    # `rest` is one row
    ids = sizes.join(by_lang, pool, "left").crossJoin(F.broadcast(rest)).select(*own, gid.alias("gid"))
    return stats.join(counted(written(ids, "groups"), BROADCAST_GROUPS), own, "left").drop(*own)


def _sums(rows: DataFrame) -> DataFrame:
    pairs = [(i, j) for i in range(P) for j in range(i, P)]
    return rows.groupBy("gid").agg(
        F.count("*").alias("n"), F.array(*(F.sum(c) for c in NAMES)).alias("s"),
        F.array(*(F.sum(F.col(NAMES[i]) * F.col(NAMES[j])) for i, j in pairs)).alias("ss"))


def _estimates(sums: DataFrame) -> DataFrame:
    """(gid, mean, precision) from exact sums; one row per group."""
    def est(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                mean = [int(v) / int(r.n) for v in r.s]
                cov = np.zeros((P, P))
                k = 0
                for i in range(P):
                    for j in range(i, P):
                        # exact integers before the one division
                        cov[i, j] = cov[j, i] = (int(r.ss[k]) * int(r.n) - int(r.s[i]) * int(r.s[j])) / int(r.n) ** 2
                        k += 1
                cov = cov / SCALE**2 * CONSISTENCY + np.diag(np.square(FLOOR))
                out.append((r.gid, [m / SCALE for m in mean], np.linalg.inv(cov).ravel().tolist()))
            yield pd.DataFrame(out, columns=["gid", "mean", "prec"])

    ship(sums.sparkSession)
    return sums.mapInPandas(est, "gid string, mean array<double>, prec array<double>")


def _with_distance(rows: DataFrame, est: DataFrame) -> DataFrame:
    d = [f"(x_{i} / {SCALE}D - mean[{k}])" for k, i in enumerate(n[2:] for n in NAMES)]
    terms = [f"{1 if i == j else 2} * prec[{i * P + j}] * {d[i]} * {d[j]}" for i in range(P) for j in range(i, P)]
    # distances decide in steps of 2^-20, far above the error of the sum's last digits
    return rows.join(counted(est, BROADCAST_GROUPS), "gid", "left").withColumn(
        "distance", F.expr(f"round(({' + '.join(terms)}) * 1048576) / 1048576")).drop("mean", "prec")


def _nearest(rows: DataFrame) -> DataFrame:
    """The rows of each group up to its H-quantile of distance, in steps of 1/64 up to 2^16 steps:
    the quantile's state holds at most so many values, whatever the group's size."""
    step = F.least(F.floor(F.col("distance") * 64), F.lit(1 << 16))
    rows = rows.withColumn("step", step)
    cut = written(rows.groupBy("gid").agg(F.expr(f"percentile(step, {H})").alias("cut")).coalesce(8), "cuts")
    return rows.join(counted(cut, BROADCAST_GROUPS), "gid").filter("step <= cut").drop("step", "cut", "distance")


def fit(rows: DataFrame) -> DataFrame:
    """The MCD estimate (gid, mean, precision) of each group.

    Starts from medians and median absolute deviations (of the integer statistics, whose range
    bounds the state of an exact percentile), then takes STEPS concentration steps.
    """
    rows = written(rows.select("gid", *NAMES).filter("gid IS NOT NULL"), "mcd-rows")
    med = written(rows.groupBy("gid").agg(*(F.expr(f"percentile({c}, 0.5)").alias("m_" + c) for c in NAMES)).coalesce(8), "medians")
    mad = (rows.join(counted(med, BROADCAST_GROUPS), "gid").groupBy("gid")
           .agg(*(F.expr(f"percentile(abs({c} - m_{c}), 0.5)").alias("d_" + c) for c in NAMES)))
    diag = [f"1D / pow(greatest(1.4826D * d_{c} / {SCALE}, {f}D), 2)" for c, f in zip(NAMES, FLOOR, strict=True)]
    flat = ", ".join(diag[i] if i == j else "0D" for i in range(P) for j in range(P))
    est = written(med.join(mad, "gid").select("gid", F.expr(f"array({', '.join(f'm_{c} / {SCALE}' for c in NAMES)})").alias("mean"),
                                      F.expr(f"array({flat})").alias("prec")).coalesce(8), "mcd")
    for _ in range(STEPS):
        est = written(_estimates(_sums(_nearest(_with_distance(rows, est))).coalesce(8)), "mcd")
    return est


def judge(docs: DataFrame, alpha: float = ALPHA, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """The columns `keep` (doc_id), counts, base_failed, kept, and distance (null without an estimate)."""
    keep = keep or ["doc_id"]
    place = list(dict.fromkeys([*keep, "lang", "source"]))
    # the texts are read and counted once; the table holds what is kept of a row besides
    stats = written(measure(docs, place, text), "quality-counts")
    rows = grouped(stats, F.col("lang"), F.col("source"))
    est = fit(rows.filter(~F.col("base_failed")))
    far = F.coalesce(F.col("distance") > chi2_quantile(1 - alpha, P), F.lit(False))
    return _with_distance(rows, est).select(*keep, *COUNTS, "base_failed", (~F.col("base_failed") & ~far).alias("kept"), "distance")


def keep_good(docs: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """The documents that are kept; all columns stay."""
    named = [f"_col{i}" for i in range(len(docs.columns))]
    text = named[docs.columns.index("text")]
    return restored(judge(aside(docs, "lang", "source"), alpha, named, text).filter("kept"), docs.columns)
