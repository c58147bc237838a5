import struct
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from canopy.llm import packing as P
from canopy.llm.queries import QUERIES, word_tokenizer
from canopy.llm.tokens import coder


def want(text, full, end):
    ids = full.encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, end], dtype="<u4").tobytes()


def test_coder_equals_library():
    k = coder(word_tokenizer())
    texts = ["don't It's WE'LL ... a... b.,. x.. 12ab3, ÇÉÑ., Σας ΟΔΟΣ. İstanbul, ǅ. éa ﬁ , . \x1ca\x1cb\x85c\xa0d <|endoftext|>x a<|startoftext|>",
             "", "ß µ ª º.", "x" * 3000, "'re're. a're b'", "1,2 3.4.", "<|ENDOFTEXT|> A <|endoftext|>", "ÉA é. Å, K ÅK.", "\n\n a"]
    texts += [r[0] for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    for got, t in zip(k.ids([t.encode() for t in texts]), texts, strict=True):
        assert np.frombuffer(got, "<u4").tolist() == k.full.encode(t, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=40))
def test_coder_on_any_text(t):
    k = coder(word_tokenizer())
    t = t.encode("utf-8", "ignore").decode()
    assert np.frombuffer(k.ids([t.encode()])[0], "<u4").tolist() == k.full.encode(t, add_special_tokens=False).ids


def optimum(lengths, size):
    """Fewest bins, by search over small cases."""
    lengths, best = sorted(lengths, reverse=True), [len(lengths)]

    def put(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for b in sorted(set(bins)):
            if b >= lengths[i]:
                rest = list(bins)
                rest[rest.index(b)] -= lengths[i]
                put(i + 1, rest)
        put(i + 1, [*bins, size - lengths[i]])

    put(0, [])
    return best[0]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
def test_bound_and_fit(lengths):
    x = np.array(lengths)
    bins, offsets, n = P.best_fit_decreasing(x, 20)
    best = optimum(lengths, 20)
    assert P.lower_bound(x, 20) <= best <= n
    for b in range(n):
        at = sorted((o, o + w) for o, w, k in zip(offsets, x, bins, strict=True) if k == b)
        assert at[0][0] == 0 and all(p[1] == q[0] for p, q in zip(at, at[1:], strict=False)) and at[-1][1] <= 20


def test_bound_beats_the_sum():
    assert P.lower_bound(np.array([11] * 6), 20) == 6
    assert P.lower_bound(np.array([7] * 9), 20) == 5  # two fit in each
    assert P.lower_bound(np.zeros(0, int), 20) == 0


def check(rows, docs, size=2048):
    k = coder(word_tokenizer())
    for i, t in docs:
        raw = want(t, k.full, 0)
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        assert sum(r.length for r in own) == len(raw) // 4 * max(1, sum(r.piece == 0 for r in own))
        for r in own:
            assert r.start == size * r.piece and r.ids_crc32 == zlib.crc32(raw[4 * r.start:4 * (r.start + r.length)])
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.offset + r.length))
    for s in seqs.values():
        s.sort()
        assert s[0][0] == 0 and s[-1][1] <= size and all(a[1] == b[0] for a, b in zip(s, s[1:], strict=False))
    return len(seqs)


def test_query(spark, sf):
    rows = QUERIES["op7_best_fit_packing"](spark, sf).collect()
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    n = check(rows, docs)
    least = P.lower_bound(np.array([r.length for r in rows]), 2048)
    assert least <= n <= least + 1


def test_exchange_between_partitions(spark, sf):
    """Small partitions with gaps hand pieces on; the result is no worse than packing each alone."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    parts = P.written(P.pieces(docs, word_tokenizer(), 2048, 0, with_ids=True), "pieces")
    once, more = P.pack(parts, rounds=1, part_pieces=16), P.pack(parts, rounds=6, part_pieces=16)
    count = lambda df: df.select("sequence_id").distinct().count()
    assert count(more) <= count(once)
    rows = more.collect()
    check(rows, [])
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    assert len(rows) == parts.count()


def test_odd_rows(odd_docs, empty_docs):
    rows = P.pack_documents(odd_docs, word_tokenizer()).collect()
    end = [r for r in rows if r.doc_id in (1, 2, 3)]
    assert len(end) == 3 and all(r.length == 1 and r.ids_crc32 == zlib.crc32(struct.pack("<I", 0)) for r in end)
    assert sum(r.doc_id == 6 for r in rows) == 2 and any(r.doc_id is None for r in rows)
    check(rows, [])
    assert P.pack_documents(empty_docs, word_tokenizer()).count() == 0


def test_refuses_other_vocabularies():
    import public_tokenizers

    with pytest.raises((ValueError, KeyError, TypeError)):
        coder(public_tokenizers.path("byte_bpe_50k.json"))
