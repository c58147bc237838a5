import hashlib
import re

import duckdb
import pytest

from canopy.llm import pii as X
from canopy.llm.queries import QUERIES


def digits(s):
    return re.sub("[^0-9]", "", s)


def luhn(d):
    return sum(v if i % 2 == 0 else sum(divmod(2 * v, 10)) for i, v in enumerate(map(int, reversed(d)))) % 10 == 0


def base(t):
    t = t or ""
    out = [(0, m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, m.start(), m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(2, m.start(), m.end(), "card") for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(3, m.start(), m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


TEXTS = ["a@b.c_d@e.f.g x@y é𝕏 q.w+e%r-t@z-z.co.", "1.2.3.4.5.6.7.8 999.1.2.3 0255.001.2.3 1.2.3.256", "4111 1111 1111 1111 4111-1111-1111-1112",
         "12 34 56 78 90 12 34 5  4111111111111111", "+1 (017) 555-7713. +49 30 1234567) +1", "+1234567890123456 +1--2..3((45678901", "", None,
         "@@a.b@c.d", "a" * 3000 + "@" + "b.c", "..@-.-.-", "1" * 200, "0 " * 20_000, "4111111111111111,1.1.1.1.1"]


def check(docs, got):
    for i, t in docs:
        spans, r = base(t), got[i]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{b}:{e}" for _, b, e, k in spans).encode()).hexdigest(), t
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[3] == k for s in spans) for k in X.BASE]
        assert {f"{k}:{b}:{e}" for _, b, e, k in spans} <= set(r.spans.split(","))


def test_base_spans(spark):
    sf = "/root/testdata/sf0.01"
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    check(docs, {r.doc_id: r for r in QUERIES["op8_weak_supervision_pii"](spark, sf).collect()})


@pytest.fixture(scope="module")
def mixed(spark):
    """Base spans, others that look personal, and others that do not."""
    rows = [f"call me at +1 (212) 555-{i:04d} or mail user{i}@mail.example.com." for i in range(60)]
    rows += [f"card 4{i:014d}0 and phone 212-555-{i:04d} please" for i in range(60)]
    rows += [f"order no. {10**15 + 7 * i} total, page 12-{i:03d}-9999x version 1.2.{i}.300" for i in range(60)]
    rows += [f"write to joe{i} (at) example (dot) com today, ssn 123-45-{6000 + i}" for i in range(60)]
    return spark.createDataFrame(list(enumerate(rows + TEXTS)), "doc_id long, text string")


def test_added_spans(mixed):
    docs = [tuple(r) for r in mixed.collect()]
    got = {r.doc_id: r for r in X.digest(mixed).collect()}
    check(docs, got)
    text = dict(docs)
    extra = {text[i][int(s.split(":")[1]):int(s.split(":")[2])] for i, r in got.items() for s in r.spans.split(",")
             if s and s.split(":")[0] in X.EXTRA}
    assert "212-555-0003" in extra and "123-45-6003" in extra and "joe3 (at) example (dot) com" in extra
    assert not any(s.startswith("10000000") for s in extra)


def plain_em(rows):
    """Dawid-Skene over votes, written out row by row."""
    import math

    p = [1 / (1 + math.exp(-sum(v))) for v in rows]
    for _ in range(X.EM_STEPS):
        one, total = sum(p), len(rows)
        prior = (one + 1) / (total + 2)
        theta = {}
        for k in range(len(X.LABELERS)):
            for v in (-1, 0, 1):
                theta[k, v, 1] = (sum(q for q, r in zip(p, rows, strict=True) if r[k] == v) + 1) / (one + 3)
                theta[k, v, 0] = (sum(1 - q for q, r in zip(p, rows, strict=True) if r[k] == v) + 1) / (total - one + 3)
        z = [math.log(prior / (1 - prior)) + sum(math.log(theta[k, v, 1] / theta[k, v, 0]) for k, v in enumerate(r)) for r in rows]
        p = [1 / (1 + math.exp(-max(-40, min(40, x)))) for x in z]
    return p, prior


def test_em_against_plain(mixed):
    cands = X.judged(X.candidates(mixed)).select("cands")
    model = X.fit(X.patterns(cands))
    rows = [tuple(c[v] for v in X.LABELERS) for r in cands.collect() for c in r.cands]
    p, prior = plain_em(rows)
    assert model.prior == pytest.approx(prior, rel=1e-6)
    votes = mixed.sparkSession.createDataFrame(sorted(set(rows)), ", ".join(f"{v} int" for v in X.LABELERS))
    label = {tuple(r)[:-1]: r.p for r in votes.withColumn("p", model.label()).collect()}
    assert all(label[r] == pytest.approx(q, abs=1e-6) for r, q in zip(rows, p, strict=True))


def test_redact(spark):
    docs = spark.createDataFrame([(1, "é a@b.co, 1.2.3.4!", 18), (2, "clean text", 10), (3, None, None)], "doc_id long, text string, n_chars long")
    out = {r.doc_id: r for r in X.redact(docs, text_length="n_chars").collect()}
    assert out[1].text == "é [EMAIL], [IP]!" and out[1].n_chars == len(out[1].text)
    assert out[2].text == "clean text" and out[2].n_chars == 10 and out[3].text is None and out[3].n_chars is None


def test_odd_rows(odd_docs, empty_docs):
    assert X.digest(odd_docs).count() == odd_docs.count()
    out = X.redact(odd_docs, text_length="n_chars")
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    assert X.digest(empty_docs).count() == 0 and X.redact(empty_docs).count() == 0
