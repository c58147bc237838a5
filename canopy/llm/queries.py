"""The registered queries of the operators: production parameters, whole tables, digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (audit, chat, crosspolytope, fim, licenses, minhash, nbsvm, outliers, packing, pii, secrets, seekable,
               transducer)
from .common import table
from .oracle_sql import AUDIT, FILL_IN_MIDDLE, LICENSES


def word_tokenizer() -> str:
    """The vocabulary file; it lies in an installed package on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(table(spark, sf_dir, "documents"))


def op2_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return crosspolytope.search(vectors, vectors.filter("vec_id % 50 = 0"))


def op3_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op4_sentencepiece_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.digest(table(spark, sf_dir, "documents"), piece_model())


def op5_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbsvm.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), word_tokenizer())
    return packed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"),
                         "ids_crc32", "sequence_id", "offset")


def op8_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op9_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(table(spark, sf_dir, "conversations"))


def op10_seekable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = seekable.write_files(table(spark, sf_dir, "documents"), word_tokenizer())
    return seekable.read_back(files)


def op11_license_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digest(fim.transform(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_robust_outliers": op1_robust_outliers,
    "op2_cross_polytope": op2_cross_polytope,
    "op3_entropy_secrets": op3_entropy_secrets,
    "op4_sentencepiece_transducer": op4_sentencepiece_transducer,
    "op5_nbsvm_quality": op5_nbsvm_quality,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_weak_supervision_pii": op8_weak_supervision_pii,
    "op9_role_repair": op9_role_repair,
    "op10_seekable_ids": op10_seekable_ids,
    "op11_license_blocks": op11_license_blocks,
    "op12_filter_audit": op12_filter_audit,
    "op13_fill_in_middle": op13_fill_in_middle,
}

#: Enumerations, and for op6 exact links by shared shingles and a transitive closure; the other queries fit models,
#: use a tokenizer or report positions of matches, which SQL cannot express (tests hold them to brute force).
ORACLE_SQL: dict[str, str] = {
    "op11_license_blocks": LICENSES,
    "op12_filter_audit": AUDIT,
    "op13_fill_in_middle": FILL_IN_MIDDLE,
    "op6_minhash_near_dedup": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
shingle AS (SELECT doc_id, unnest(s) AS x FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * shared.n >= 75 * (p.n + q.n - shared.n)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sizes UNION SELECT r.doc_id, e.b FROM reach r JOIN edge e ON e.a = r.other)
SELECT r.doc_id, s.n AS n_shingles, min(other) AS component_id, r.doc_id = min(other) AS kept
FROM reach r JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id, s.n
""",
}
