import math
import zlib

import duckdb
import numpy as np
import pytest

from canopy.llm import nbsvm as N
from canopy.llm.queries import QUERIES


def test_shape():
    assert N.shape(b"Thon.") == b"\0Aa." and N.shape(b"AB12ab--") == b"\0A0a-" and N.shape("é".encode()) == b"\0a"


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op5_nbsvm_quality"](spark, sf).collect()}
    assert len(got) == duckdb.sql(f"SELECT count(*) FROM '{sf}/documents.parquet'").fetchall()[0][0]
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall()
    test = [(got[i].score, q) for i, q in labels if got[i].held_out]
    good, bad = [s for s, q in test if q == 1], [s for s, q in test if q == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([s >= 0.5 for s in good]) > 0.97 and np.mean([s < 0.5 for s in bad]) > 0.8


def test_labels_of_held_out_rows_do_not_matter(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    turned = labels.withColumn("quality", N.F.when(N.held_out(), 1 - N.F.col("quality")).otherwise(N.F.col("quality")))
    a, b = N.train(docs, labels), N.train(docs, turned)
    assert (a.weights == b.weights).all() and a.bias == b.bias
    moved = docs.withColumn("lang", N.F.lit("xx")).withColumn("source", N.F.lit("yy"))
    assert (N.train(moved, labels).weights == a.weights).all()


def test_twelve_thousand_labels_are_fitted(spark, monkeypatch):
    """Where more training labels exist, the fit gets 12,000 of them."""
    docs = spark.range(19_000).selectExpr("id AS doc_id", "concat('word', id % 7) AS text", "cast(id % 2 AS int) AS quality")
    assert docs.filter(~N.held_out()).count() > 12_000
    seen = []
    monkeypatch.setattr(N, "fit", lambda rows, y: seen.append((len(rows), len(y))))
    N.train(docs.select("doc_id", "text"), docs.select("doc_id", "quality"))
    assert seen == [(12_000, 12_000)]


def test_dual_coordinate_descent_is_optimal():
    """The primal objective meets the dual one: no duality gap."""
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 40, 12).astype(np.int32) + (20 if i % 3 else 0)) for i in range(120)]
    y = np.array([int(i % 3 > 0) for i in range(120)])
    old, N.EPOCHS = N.EPOCHS, 400
    try:
        m = N.fit(rows, y)
    finally:
        N.EPOCHS = old
    count = np.ones((2, N.BUCKETS))
    for x, c in zip(rows, y, strict=True):
        count[c, x] += 1
    ratio = np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())
    w = np.divide(m.weights, ratio, out=np.zeros(N.BUCKETS), where=ratio != 0)
    sign, cap = np.where(y == 1, 1, -1), N.COST * len(y) / (2 * np.where(y == 1, y.sum(), (1 - y).sum()))

    def objective(w, b):
        z = np.array([w[x] @ (ratio[x] / math.sqrt(len(x))) + b for x in rows])
        return 0.5 * (w @ w + b * b) + (cap * np.maximum(0, 1 - sign * z)).sum()

    best = objective(w, m.bias)
    for _ in range(300):
        step = np.zeros(N.BUCKETS)
        step[:60] = rng.normal(size=60) * 10 ** rng.uniform(-3, -1)
        assert objective(w + step, m.bias + rng.normal() * 0.01) >= best - 1e-3


def test_odd_rows(spark, odd_docs, empty_docs):
    labels = spark.createDataFrame([(4, 1, 0), (9, 0, 0), (10, 0, 1), (6, 1, 0), (5, None, 0), (None, 1, 0), (7, 1, 0), (7, 0, 0), (8, 5, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = N.classify(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [None]
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    none = labels.filter("false")
    assert all(r.score == pytest.approx(0.5) for r in N.classify(odd_docs, none).collect())
    one = {r.predicted for r in N.classify(odd_docs, labels.filter("quality = 1")).collect()}
    assert one == {1}
    kept = N.keep_good(odd_docs, N.train(odd_docs, none))
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert N.classify(empty_docs, labels).count() == 0


def test_whole_shapes():
    """Words that differ behind their sixteenth run differ in shape."""
    assert N.shape(b"a1" * 20 + b"!?") != N.shape(b"a1" * 50) != N.shape(b"a1" * 51)
    assert N.shape(b"Thon.") == N.shape(b"Xy.") == b"\0Aa."
    assert max(len(N.shape(b"a1" * n)) for n in (1, 8, 9, 50_000)) <= 17
