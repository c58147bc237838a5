from collections import Counter

import duckdb
import numpy as np
import pytest

from canopy.llm import outliers as O
from canopy.llm.queries import QUERIES

WS = " \t\n\r\x0b\x0c"


def plain_counts(text):
    text = text or ""
    words, w = [], ""
    for c in text + " ":
        if c in WS:
            if w:
                words.append(w)
            w = ""
        else:
            w += c
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    many = Counter(windows)
    covered = {j for i, x in enumerate(windows) if many[x] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if x.strip(WS)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def test_counts(odd_docs, sf):
    texts = [r[0] for r in duckdb.sql(f"SELECT text FROM '{sf}/documents.parquet'").fetchall()]
    texts += ["a b c d e a b c d e f", "x x x x x x x", "a|b\n\na|b\n a|b\n \n", None, "", "    \x1c"]
    for t in texts:
        assert O.counts(None if t is None else t.encode()) == plain_counts(t)


def test_chi2():
    assert O.chi2_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-4)
    assert O.chi2_cdf(1.386294361, 2) == pytest.approx(0.5, abs=1e-8)


def brute_mcd(x, steps=O.STEPS):
    """x: integer statistics of one group."""
    floor = np.array(O.FLOOR)
    mean = np.median(x, axis=0) / O.SCALE
    mad = np.median(np.abs(x - np.median(x, axis=0)), axis=0) / O.SCALE
    prec = np.diag(1 / np.maximum(1.4826 * mad, floor) ** 2)
    z = x / O.SCALE
    for _ in range(steps + 1):
        d = np.einsum("ij,jk,ik->i", z - mean, prec, z - mean)
        if _ == steps:
            return d
        step = np.minimum(np.floor(d * 64), 1 << 16)
        near = z[step <= np.quantile(step, O.H)]
        mean = near.mean(axis=0)
        prec = np.linalg.inv(np.cov(near.T, bias=True) * O.CONSISTENCY + np.diag(floor**2))


def test_against_brute_force(spark):
    rows = {r.doc_id: r for r in QUERIES["op1_robust_outliers"](spark, "/root/testdata/sf0.01").collect()}
    docs = duckdb.sql("SELECT doc_id, text, lang, source FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()
    assert len(rows) == len(docs)
    stat = {}
    for i, t, lang, source in docs:
        n, chars, sym, dup, rep = plain_counts(t)
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, sym, dup, rep)
        assert r.base_failed == (n < 10 or 100 * rep > 20 * n)
        m = n + O.PRIOR_WORDS
        v = [np.log1p(n), np.log((chars + O.PRIOR_WORDS * O.PRIOR_WORD_CHARS) / m), np.sqrt(sym / m), np.sqrt(10 * dup / m), np.sqrt(rep / m)]
        stat[i] = np.floor(np.array(v) * O.SCALE + 0.5), (lang, source)
    ok = [i for i in stat if not rows[i].base_failed]
    own = Counter(stat[i][1] for i in ok)
    small = Counter(g[0] for g in (stat[i][1] for i in ok) if own[g] < O.MIN_ROWS)
    group = lambda g: g if own[g] >= O.MIN_ROWS else g[0] if small[g[0]] >= O.MIN_ROWS else None
    for g in {group(stat[i][1]) for i in ok}:
        ids = [i for i in ok if group(stat[i][1]) == g]
        d = brute_mcd(np.array([stat[i][0] for i in ids]))
        cut = O.chi2_quantile(1 - O.ALPHA, O.P)
        for i, x in zip(ids, d, strict=True):
            assert rows[i].distance == pytest.approx(x, rel=1e-4, abs=1e-4)
            assert rows[i].kept == (x <= cut)
    assert not any(r.kept for r in rows.values() if r.base_failed)


def test_quality_labels(spark):
    """Rejects junk and leaves good documents."""
    kept = {r.doc_id: r.kept for r in QUERIES["op1_robust_outliers"](spark, "/root/testdata/sf0.01").collect() if not r.base_failed}
    labels = dict(duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall())
    good = [kept[i] for i, q in labels.items() if q == 1 and i in kept]
    bad = [kept[i] for i, q in labels.items() if q == 0 and i in kept]
    assert all(good) and np.mean(bad) < 0.2


def test_odd_rows(odd_docs, empty_docs):
    rows = O.judge(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    assert by[1].n_words == by[2].n_words == by[3].n_words == 0 and not by[1].kept
    assert by[4].kept and by[4].n_words == 30_000 and by[4].distance is None  # groups too small to judge
    assert by[10].base_failed and by[10].n_repeat_words == 20_000
    out = O.keep_good(odd_docs)
    assert out.columns == odd_docs.columns and {r.doc_id for r in out.collect()} == {4}
    assert O.judge(empty_docs).count() == 0
