import re

import duckdb

import corpus_pipeline as P
from canopy.llm import minhash, nbsvm, outliers, packing, pii, seekable
from canopy.llm.common import written
from tests.llm.test_minhash import plain_components

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    assert [f.__name__ for _, f in P.STAGES] == ["quality_rules", "quality_classifier", "near_duplicates", "personal_data", "packed"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    seen = {r.doc_id: r for r in docs.collect()}

    rules = written(P.quality_rules(spark, docs, SF), "t")
    kept = {r.doc_id for r in outliers.judge(docs).filter("kept").collect()}
    rows = {r.doc_id: r for r in rules.collect()}
    assert set(rows) == kept and all(rows[i] == seen[i] for i in kept)

    good = written(P.quality_classifier(spark, rules, SF), "t")
    left = {r.doc_id for r in good.collect()}
    model = nbsvm.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert left == {i for i in kept if model.score(nbsvm.features(seen[i].text.encode())) >= 0.5}
    assert all(i in left for i, q in labels.items() if q == 1 and i in kept)

    once = written(P.near_duplicates(spark, good, SF), "t")
    comp, _ = plain_components([(i, seen[i].text) for i in left])
    assert {r.doc_id for r in once.collect()} == {i for i, c in comp.items() if i == c}

    clean = written(P.personal_data(spark, once, SF), "t")
    spans = {r.doc_id: r.spans for r in pii.digest(once).collect()}
    for r in clean.collect():
        text = seen[r.doc_id].text
        want, at = "", 0
        for b, e, kind in sorted((int(s.split(":")[1]), int(s.split(":")[2]), s.split(":")[0]) for s in spans[r.doc_id].split(",") if s):
            if b >= at:
                want += text[at:b] + f"[{kind.upper()}]"
            at = max(at, e)
        assert r.text == want + text[at:] and r.n_chars == len(r.text)
        assert not re.search(r"[\w.+-]+@[\w-]+\.\w+", r.text)
    assert clean.columns == once.columns == good.columns == rules.columns == docs.columns

    packed = P.packed(spark, clean, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in clean.collect()}
    ran = P.run(spark, SF)
    key = lambda rs: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rs)
    assert key(ran.collect()) == key(packed)


def test_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("false")
    for _, stage in P.STAGES:
        docs = written(stage(spark, docs, SF), "t")
    assert docs.count() == 0


def test_nothing_hides_an_import_error():
    for m in (P, minhash, nbsvm, outliers, packing, pii, seekable):
        source = open(m.__file__).read()
        assert "ImportError" not in source and "ModuleNotFoundError" not in source
