import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from canopy.llm import fim as M

CHARS = st.sampled_from(list("ab\n\r é中𝕏́<PSM>"))


def plain(doc_id, text, unit, rate=100, spm=50):
    text = text or ""
    units = {"line": re.findall(r"[^\n]*\n|[^\n]+", text), "char": list(text)}[unit]
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", None, None, text
    if h4 % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(st.lists(CHARS, max_size=60).map("".join), st.integers(-5, 2**62), st.sampled_from(["line", "char"]))
def test_against_code_points(text, doc_id, unit):
    r = M.transformed(doc_id, text.encode(), unit)
    assert (*r[1:5], r[7].decode()) == plain(doc_id, text, unit)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_index(text):
    text = text.encode("utf-8", "ignore").decode()
    index = M.Exceptions(text.encode())
    chars = np.arange(len(text) + 1)
    at = np.array([len(text[:c].encode()) for c in chars])
    assert index.to_bytes(chars).tolist() == at.tolist()
    assert index.to_chars(at).tolist() == chars.tolist()
    assert len(index.bytes) == sum(ord(c) > 127 for c in text)


@settings(max_examples=100, deadline=None)
@given(st.lists(CHARS, max_size=40).map("".join), st.integers(0, 2**40))
def test_bytes(text, doc_id):
    """Cuts at bytes never part a character."""
    r = M.transformed(doc_id, text.encode(), "byte")
    if r[2] != "plain":
        raw = text.encode()
        prefix, middle = raw[:r[5]].decode(), raw[r[5]:r[5] + r[6]].decode()
        assert (len(prefix), len(middle)) == r[3:5]


@pytest.mark.parametrize(("unit", "rate", "spm"), [("line", 100, 50), ("char", 40, 0), ("char", 100, 100), ("line", 0, 50)])
def test_round_trip(spark, odd_docs, sf, unit, rate, spm):
    tricky = [(100 + i, t) for i, t in enumerate(["a<P\nb<", "<P", "\n", "\n\n", "x\r\ny<S\n>", "has <M> inside\nit", "<<<\n>>>\n", "é\n中\n𝕏"])]
    docs = (odd_docs.select("doc_id", "text").union(spark.createDataFrame(tricky, "doc_id long, text string"))
            .union(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")))
    made = M.transform(docs, unit, rate=rate, spm=spm).withColumn("back", M.restored(F.col("output"), F.col("form")))
    got = sorted((str(tuple(r)[:5]), r["output"], r["back"]) for r in made.collect())
    want = []
    for doc_id, text in ((r["doc_id"], r["text"]) for r in docs.collect()):
        p = plain(doc_id, text, unit, rate, spm)
        want.append((str((doc_id, *p[:4])), p[4], text or ""))
    assert got == sorted(want)


def test_odd_tables(spark, odd_docs, empty_docs):
    assert M.digest(M.transform(odd_docs)).count() == odd_docs.count()
    assert M.digest(M.transform(empty_docs)).collect() == []
    with pytest.raises(ValueError):
        M.transform(empty_docs, "word")
