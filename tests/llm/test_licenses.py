import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from canopy.llm import licenses as L
from canopy.llm.queries import QUERIES

TEXTS = [(label, text) for label, text in L.TEMPLATES]


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_blocks(words, texts, threshold):
    out = []
    for i, (_, text) in enumerate(texts):
        sought = words_of(text)
        size = 8
        while size < len(sought):
            size *= 2
        for start in range(0, len(words), size):
            shared = len(set(words[start:start + 2 * size]) & set(sought))
            if 100 * shared >= threshold * len(set(sought)):
                out.append((i, start, shared, shared / len(set(sought))))
    return sorted(out)


def noisy(rng, texts):
    """Template passages with words lost, doubled and put in between, among other words."""
    vocabulary = sorted({w for _, t in texts for w in words_of(t)}) + ["x", "é", "42", "foo"]
    out = []
    for _ in range(rng.randrange(1, 6)):
        out += [rng.choice(vocabulary) for _ in range(rng.randrange(30))]
        for w in words_of(rng.choice(texts)[1]):
            out += [w] * rng.choice([0, 1, 1, 1, 1, 1, 1, 2]) + ([rng.choice(vocabulary)] if rng.random() < 0.05 else [])
    return " ".join(out)


@pytest.mark.parametrize("threshold", [50, 75, 90, 100])
def test_join_is_exact(threshold):
    rng = random.Random(threshold)
    templates = L.templates_of(TEXTS, threshold)
    for order in ({}, {w: rng.randrange(5) for t in templates for w in t.words}):
        join = L.Join(templates, order)  # the order of the words has no effect on the result
        found = 0
        for _ in range(150):
            text = noisy(rng, TEXTS)
            got = join.text(L.spelled(text.encode()))
            assert got == plain_blocks(words_of(text), TEXTS, threshold)
            found += len(got)
        assert found > 100


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_words(text):
    text = text.encode("utf-8", "ignore").decode()
    assert [w.decode() for w in L.spelled(text.encode())] == words_of(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c"]), max_size=12))
def test_phrases(words):
    phrases = [("a a", "x"), ("a b a", "y"), ("c", "z")]
    want = [(i, p) for i, (text, _) in enumerate(phrases) for p in range(len(words)) if words[p:p + len(text.split())] == text.split()]
    assert L.phrase_places([w.encode() for w in words], phrases) == want


def test_whole_passages_anywhere():
    """A template's text is found wherever it starts."""
    join = L.Join(L.templates_of(TEXTS, 100), {})
    for i, (_, text) in enumerate(TEXTS):
        for before in range(0, 70, 3):
            assert any(b[0] == i for b in join.text([b"x"] * before + L.spelled(text.encode()) + [b"y"] * 5))


def result(spark, rows, **kw):
    df = L.digest(L.scan(spark.createDataFrame(rows, "doc_id long, text string"), **kw))
    return {r["doc_id"]: r for r in df.collect()}


def test_labels(spark):
    got = result(spark, [(1, "Some prose.\nLicensed under CC BY-NC 4.0."), (2, "Licensed under CC BY 4.0, as is"),
                         (3, "MIT license, Apache\nLicense; the MIT-License"), (4, "the license of the general public"),
                         (5, "licensed under cc by nd nc 4 0 " + "x " * 60 + "licensed under cc by 4 0")])
    assert [got[i]["labels"] for i in range(1, 6)] == ["cc-by-nc", "cc-by", "apache,mit", "", "cc-by,cc-by-nc-nd"]
    assert [got[i]["base_labels"] for i in range(1, 6)] == ["", "", "apache,mit", "", ""]
    assert (got[3]["n_base"], got[3]["first_word"], got[3]["last_word"]) == (3, 0, 5)
    assert [got[i]["score"] for i in range(1, 6)] == [1.0, 1.0, 1.0, 0.0, 1.0]


def test_matches(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a b c x"), (3, "a"), (4, "d c b a " * 20)], "doc_id long, text string")
    texts = [("t", "a b c d")]
    got = {(r["doc_id"], r["first_word"], r["shared"]) for r in L.matches(L.scan(docs, texts, 75), texts).collect()}
    assert got == {(1, 0, 4), (2, 0, 3)} | {(4, 8 * i, 4) for i in range(10)}


def test_odd_rows(spark, odd_docs, empty_docs):
    rows = L.digest(L.scan(odd_docs)).collect()
    assert len(rows) == odd_docs.count()
    want = {(r["doc_id"], len(words_of(r["text"]))) for r in odd_docs.collect()}
    assert {(r["doc_id"], r["n_words"]) for r in rows} == want
    assert all(r["labels"] == "" and r["first_word"] is None and r["score"] == 0 for r in rows)
    assert L.digest(L.scan(empty_docs)).collect() == []
    with pytest.raises(ValueError):
        L.templates_of([("x", "y" * (L.MAX_TEMPLATE_BYTES + 1))])


def test_query_is_whole(spark, sf):
    assert QUERIES["op11_license_blocks"](spark, sf).count() == spark.read.parquet(f"{sf}/documents.parquet").count()
