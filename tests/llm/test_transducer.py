import itertools
import random
import struct

import duckdb
import numpy as np
import pytest
import sentencepiece

from canopy.llm import transducer as T
from canopy.llm.queries import QUERIES, piece_model


@pytest.fixture(scope="module")
def model():
    return T.transducer(piece_model()), sentencepiece.SentencePieceProcessor(model_file=piece_model())


def ids(b):
    return np.frombuffer(b, "<u4").tolist()


TEXTS = [" a  b\tc\n", "", " ", "   ", "a" * 50, "x  ", "  x", "     1 2   3", "▁a", "<s> </s> <unk> <0x41>", "é中𐍈𝕏 ﬁ", "\n\n\n",
         "ab\ncd ef\n  gh", "don't stop", "    def f(x):\n        return x", " " * 40 + "z", " " * 33, "....,,,!!!", "日本語 中文分词", "한국어",
         "Привет, мир", "a\x00b", "https://www.example.com/a?b=c&d=e_f"]


def test_equals_library(model):
    t, sp = model
    rnd = random.Random(3)
    some = ["".join(rnd.choice("etaoinshr  ▁ABC12.,é\nüЖ中") for _ in range(rnd.randint(1, 25))) for _ in range(3000)]
    some += [r[0] for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    for x in TEXTS + some + [" " * k + "w" for k in range(70)]:
        assert ids(t.encode(x)) == sp.encode(x), repr(x)
        assert t.decode(t.encode(x)) == sp.decode(sp.encode(x)) == x.replace("▁", " ")


def test_cache_bound(model, monkeypatch):
    t, sp = model
    monkeypatch.setattr(T, "CACHE_CHUNKS", 20)
    for x in ["some words that fill the cache " + str(i) for i in range(100)]:
        assert ids(t.encode(x)) == sp.encode(x)


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def field(k, v):
    if isinstance(v, int):
        return varint(k << 3) + varint(v)
    if isinstance(v, float):
        return varint(k << 3 | 5) + struct.pack("<f", v)
    return varint(k << 3 | 2) + varint(len(v)) + v


def unigram(tmp_path, pieces, charsmap=b""):
    b = field(1, field(1, b"<unk>") + field(2, 0.0) + field(3, 2))
    for s, score in pieces.items():
        b += field(1, field(1, s.encode()) + field(2, score))
    for i in range(256):
        b += field(1, field(1, f"<0x{i:02X}>".encode()) + field(2, 0.0) + field(3, 6))
    b += field(2, field(3, 1)) + field(3, field(2, charsmap) + field(3, 1) + field(4, 0))
    p = tmp_path / "unigram.model"
    p.write_bytes(b)
    return str(p)


def test_shortest_path_of_a_unigram_model(tmp_path):
    pieces = {"▁": -3.0, "a": -2.5, "b": -2.0, "ab": -3.9, "ba": -4.1, "▁a": -3.5, "aba": -6.0, "bb": -5.5, "▁ab": -5.0}
    t = T.Transducer(unigram(tmp_path, pieces))
    for n in range(1, 8):
        for x in map("".join, itertools.product("ab ", repeat=n)):
            s = "▁" + x.replace(" ", "▁")
            best = {0: 0.0}
            for i in range(len(s)):
                for j in range(i + 1, len(s) + 1):
                    if s[i:j] in pieces and (j not in best or best[i] - pieces[s[i:j]] < best[j]):
                        best[j] = best[i] - pieces[s[i:j]]
            got = ids(t.encode(x))
            assert sum(-t.score[i] for i in got) == pytest.approx(best[len(s)]) and t.decode(t.encode(x)) == x
    assert t.decode(t.encode("aéb")) == "aéb"


def test_refuses_character_maps(tmp_path):
    with pytest.raises(ValueError):
        T.Transducer(unigram(tmp_path, {"a": -1.0}, charsmap=b"\1\2\3\4"))


def test_query_and_operator(spark, sf, model):
    t, sp = model
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op4_sentencepiece_transducer"](spark, sf).collect()}
    for r in docs.collect():
        assert got[r.doc_id].n_tokens == len(sp.encode(r.text)) and got[r.doc_id].round_trip
    back = T.decode(T.encode(docs, piece_model(), ["doc_id", "text"]), piece_model(), ["text"])
    assert back.filter("text <> decoded").count() == 0


def test_odd_rows(odd_docs, empty_docs):
    rows = T.digest(odd_docs, piece_model()).collect()
    assert len(rows) == odd_docs.count() and all(r.round_trip for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {0}
    assert T.digest(empty_docs, piece_model()).count() == 0
