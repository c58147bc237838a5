import math
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from canopy.llm import minhash as M
from canopy.llm.queries import QUERIES
from canopy.llm.words import shingles


def plain_set(text):
    w = bytes(text or "", "utf-8").lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def plain_components(docs):
    sets = {i: plain_set(t) for i, t in docs}
    where, root = defaultdict(list), {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    for i, s in sets.items():
        both = defaultdict(int)
        for x in s:
            for j in where[x]:
                if j < i:
                    both[j] += 1
        for j, n in both.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def test_shingles():
    for t in ["a b c d e f", "A b C d e a B c d e", "one two", "one one", "", None, " \n", "é É a b c d"]:
        assert len(shingles(None if t is None else t.encode())) == len(plain_set(t))
    assert not set(shingles(b"a b c d")) & set(shingles(b"a b c d e"))


@pytest.mark.parametrize("n", [1, 2, 40, 700, 9000])
def test_sketch_fills_and_estimates(n):
    rng = np.random.default_rng(n)
    for share in (0.3, 0.75, 0.95):
        both = round(2 * n * share / (1 + share))
        pool = rng.integers(0, 2**63, 2 * n - both, dtype=np.uint64)
        a, b = M.sketch(np.unique(pool[:n])), M.sketch(np.unique(pool[n - both:]))
        assert (a != M._EMPTY).all() and (b != M._EMPTY).all()
        true = both / len(pool)
        assert abs((a == b).mean() - true) < 0.12
    # the sketch of a set does not depend on how many rounds run at once
    assert (M.sketch(np.unique(pool[:n])) == M.sketch(np.unique(pool[:n])[::-1].copy())).all()


def test_union_of_sketches():
    """A sketch is a minimum: that of a union follows from those of the parts when both fill in the same rounds."""
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 2**63, (2, 20_000), dtype=np.uint64)
    assert (np.minimum(M.sketch(a), M.sketch(b)) == M.sketch(np.concatenate([a, b]))).all()


def check(found, docs):
    comp, sizes = plain_components(docs)
    assert len(found) == len(docs)
    for r in found:
        assert (r.n_shingles, r.component_id) == (sizes[r.doc_id], comp[r.doc_id]), r
        assert r.kept == (r.doc_id == r.component_id)


def test_against_brute_force(spark):
    docs = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()
    check(QUERIES["op6_minhash_near_dedup"](spark, "/root/testdata/sf0.01").collect(), docs)


def test_cloud_of_near_copies(spark):
    """Many copies of one text with few or many edits: hubs, outliers and chains."""
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(5000)}" for _ in range(120)]
    docs = []
    for i in range(300):
        w = list(base)
        for _ in range(rnd.randrange(0, 9)):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(10**6)}"
        docs.append((i, " ".join(w)))
    docs += [(1000 + i, docs[i % 7][1].upper()) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    check(M.near_duplicates(df).collect(), docs)


def test_odd_rows(odd_docs, empty_docs):
    rows = M.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    assert by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0 and by[1].kept and by[2].kept
    assert by[None].component_id is None and by[None].kept
    assert by[5].n_shingles == 1 and by[9].n_shingles == 1 and by[10].n_shingles == 1
    out = M.keep_one(odd_docs)
    assert out.columns == odd_docs.columns
    assert sorted(r.doc_id or 0 for r in out.collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]
    assert M.near_duplicates(empty_docs).count() == 0


def test_texts_that_share_a_doc_id(spark):
    """Each text of a doc_id is judged by itself: only copies go, and of each one stays."""
    rnd = random.Random(8)
    text = lambda: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(60))
    t1, t2, u1, u2, v = (text() for _ in range(5))
    near = [(x, x + " more") for x in (text() for _ in range(30))]
    docs = [(1, t1), (5, t1), (5, t2), (6, u1), (6, u2), (6, u2), (7, u1), (8, None), (8, v), (8, ""), (None, t1)]
    docs += [(100, t) for pair in near for t in pair] + [(101, near[0][0]), (101, v)]
    got = M.keep_one(spark.createDataFrame(docs, "doc_id long, text string").withColumn("key", M.F.lit("clash")))
    assert got.columns == ["doc_id", "text", "key"]
    rows = [(r.doc_id, r.text) for r in got.collect()]
    want = [(1, t1), (5, t2), (6, u1), (6, u2), (8, v), (None, t1)]
    assert sorted(r for r in rows if r[1] and r[0] != 100 and r[0] is not None) == want[:-1] and (None, t1) in rows
    assert sum(r[0] == 8 and not r[1] for r in rows) == 1
    hundred = [t for i, t in rows if i == 100]
    assert len(hundred) == 30 and all(sum(t in pair for t in hundred) == 1 for pair in near)
    assert len(rows) == len(want) + 31


def test_sketch_cut_is_no_looser_than_with_128_bins():
    """A pair at 0.75 is refused by its sketch no more often than by 72 of 128 bins."""
    below = lambda n, k: sum(math.comb(n, i) * 0.75**i * 0.25**(n - i) for i in range(k))
    assert below(M.BINS, M.LEAST_EQUAL) <= below(128, 72)
