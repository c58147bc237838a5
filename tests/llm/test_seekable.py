import io
import zlib

import duckdb
import numpy as np
import pytest
import zstandard

from canopy.llm import seekable as S
from canopy.llm.queries import QUERIES, word_tokenizer
from canopy.llm.tokens import coder


def expected(docs):
    k, at, out = coder(word_tokenizer()), 0, []
    for i, t in docs:
        raw = np.array([*k.full.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4").tobytes()
        out.append((i, at, len(raw) // 4, zlib.crc32(raw)))
        at += len(raw) // 4
    return out


def test_query(spark, sf):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall()
    got = sorted(tuple(r) for r in QUERIES["op10_seekable_ids"](spark, sf).collect())
    assert got == expected(docs)


class Counting(io.BytesIO):
    seen = 0

    def read(self, n=-1):
        b = super().read(n)
        self.seen += len(b)
        return b


def written(raws):
    out = io.BytesIO()
    out.close = lambda: None
    w = S.FrameWriter(out)
    for i, raw in enumerate(raws):
        w.add(None if i == 1 else 10 * i, raw)
    w.close()
    return out.getvalue()


def test_file_format():
    rng = np.random.default_rng(0)
    raws = [rng.bytes(4 * n) for n in (1, 0, 5000, 300)]
    blob = written(raws)
    # any reader can take the file as a whole; the tables are skippable frames
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(blob), read_across_frames=True).read()
    assert whole == b"".join(raws)
    f = Counting(blob)
    r = S.FrameReader(f, len(blob))
    assert r.ids == [0, None, 20, 30]
    before = f.seen
    assert r.frame(3) == raws[3] and f.seen - before < 1400  # frame 2 is not read
    bad = bytearray(blob)
    bad[int(r.at[2]) + 500] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        S.FrameReader(io.BytesIO(bytes(bad)), len(bad)).frame(2)
    assert S.FrameReader(io.BytesIO(bytes(bad)), len(bad)).frame(0) == raws[0]
    with pytest.raises(ValueError):
        S.FrameReader(io.BytesIO(blob[:-1]), len(blob) - 1)


def test_random_access(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    files = S.write_files(docs, word_tokenizer())
    got = {r.doc_id: r.ids for r in S.read_documents(files, docs.filter("doc_id % 7 = 0")).collect()}
    k = coder(word_tokenizer())
    for r in docs.filter("doc_id % 7 = 0").collect():
        assert got.pop(r.doc_id) == [*k.full.encode(r.text, add_special_tokens=False).ids, 2]
    assert not got


def test_odd_rows(odd_docs, empty_docs):
    rows = S.read_back(S.write_files(odd_docs, word_tokenizer())).collect()
    assert len(rows) == odd_docs.count()
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 5, 6, 6, 7, 8, 9, 10]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:], strict=False))
    assert S.read_back(S.write_files(empty_docs, word_tokenizer())).count() == 0
