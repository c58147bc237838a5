"""Filter interaction audit with exact Shapley values (op 12).

Five filters A to E judge every document. Which filters a document fails is a mask of five bits, so
everything an audit asks is in 32 numbers per part (source): v(S), the documents that fail a filter
of the coalition S, and the same for good and for toxic documents. A step of a filter order removes
v(before and it) - v(before); what it finds removed already, what fails it alone and the good and
toxic documents lost are differences of the same table.

The Shapley values are the exact solution of a constrained least-squares problem: over all proper
coalitions, weighted by the Shapley kernel, sum the values to v(S) as well as possible, and to
v(all) exactly. Its normal equations are solved in rationals, so 120 times a value is an integer.

Texts are read once, in tasks; what moves afterwards is a mask and a 128-bit hash per document.
Filter E needs the smallest doc_id of each text. The other four filters depend on the text alone, so
all copies of a text share their mask, and a text's rows are summed per (text, part) with its
smallest id at hand before they meet others: a text that a third of all rows copy is pre-aggregated
in every task, and no row looks its copies up.

Null texts are empty (A fails, and so does E if a smaller id has an empty or null text). Words are
case-sensitive. A null source is the part "". A null doc_id is smaller than none and has no
label. Rows with the same doc_id and text are counted each, and none is the other's copy. A document
is good (toxic) if any label row of its id has quality (toxic) = 1; null labels say nothing. Empty
tables give no rows. Only doc_id, text and source, and doc_id, quality and toxic, are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from fractions import Fraction
from itertools import combinations, permutations
from math import comb

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append, ship, written

FILTERS = "ABCDE"
N = len(FILTERS)
ALL = 2**N - 1
MIN_WORDS, DISTINCT_PCT, UPPER_PCT = 200, 50, 2
SYMBOL = re.compile(rb"[#$%&*|]")
_UPPER, _CONTINUED = bytes(range(0x41, 0x5B)), bytes(range(0x80, 0xC0))
STEP_SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
               "unique_fails long, good_lost long, toxic_lost long, shapley long")


def text_mask(text: bytes) -> int:
    """The failed filters among A to D, as bits."""
    words = text.split()
    upper = len(text) - len(text.translate(None, _UPPER))
    chars = len(text) - (0 if text.isascii() else len(text) - len(text.translate(None, _CONTINUED)))
    return ((len(words) < MIN_WORDS) | (100 * len(set(words)) < DISTINCT_PCT * len(words)) << 1
            | (100 * upper > UPPER_PCT * chars) << 2 | (SYMBOL.search(text) is not None) << 3)


def _judged(texts: list[bytes | None]) -> list[tuple]:
    return [(text_mask(t or b""), xxhash.xxh3_128_digest(t or b"")) for t in texts]


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents of each part by the set of filters they fail."""
    rows = append(docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), "text"), "text", _judged,
                  "mask int, key binary", ["doc_id", "part"])
    rows = written(rows.groupBy("doc_id", "part", "mask", "key").agg(F.count("*").alias("n")), "audit-rows")
    marks = labels.filter("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("toxic"))
    known = rows.filter("doc_id IS NOT NULL").join(marks, "doc_id", "left").select(
        "doc_id", "part", "mask", "key", "n", *((F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")))
    # rows without an id pass E whatever their text is, and no label knows them
    nameless = rows.filter("doc_id IS NULL").select("part", "mask", "n", F.lit(0).cast("long").alias("good"),
                                                    F.lit(0).cast("long").alias("toxic"))
    counts = ["n", "good", "toxic"]
    by_text = written(known.groupBy("key", "mask", "part").agg(
        *(F.sum(c).alias(c) for c in counts), F.min(F.struct("doc_id", *counts)).alias("low")), "audit-texts")
    first = by_text.groupBy("key").agg(F.min("low.doc_id").alias("lowest"))
    by_text = by_text.join(first, "key")
    is_first = F.col("low.doc_id") == F.col("lowest")
    passed = by_text.filter(is_first).select("part", "mask", *(F.col(f"low.{c}").alias(c) for c in counts))
    copies = by_text.select("part", F.col("mask").bitwiseOR(1 << FILTERS.index("E")).alias("mask"),
                            *((F.col(c) - F.when(is_first, F.col(f"low.{c}")).otherwise(0)).alias(c) for c in counts))
    every = passed.unionByName(copies).unionByName(nameless)
    return every.groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in counts)).filter("n > 0")


def shapley(value: list[int]) -> list[Fraction]:
    """Shapley values of a game given by the values of its 2^n coalitions (index: bits of the members)."""
    n = (len(value) - 1).bit_length()
    everyone = len(value) - 1
    left = [[Fraction(0)] * (n + 1) for _ in range(n + 1)]
    right = [Fraction(0)] * (n + 1)
    for s in range(1, everyone):
        members = [i for i in range(n) if s >> i & 1]
        k = len(members)
        weight = Fraction(n - 1, comb(n, k) * k * (n - k))
        for i in members:
            right[i] += weight * (value[s] - value[0])
            for j in members:
                left[i][j] += weight
    for i in range(n):  # the multiplier's row and column: the values sum to the whole
        left[i][n] = left[n][i] = Fraction(1)
    right[n] = Fraction(value[everyone] - value[0])
    return solve(left, right)[:n]


def solve(left: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """Exact solution of a regular square system."""
    rows = [[*r, x] for r, x in zip(left, right, strict=True)]
    for c in range(len(rows)):
        pivot = next(r for r in range(c, len(rows)) if rows[r][c])
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(len(rows)):
            if r != c and rows[r][c]:
                rows[r] = [x - rows[r][c] * y for x, y in zip(rows[r], rows[c], strict=True)]
    return [r[-1] for r in rows]


def removals(by_mask: dict[int, int], n: int = N) -> list[int]:
    """v(S) for each of the 2^n coalitions: the documents that fail a filter of S."""
    return [sum(count for mask, count in by_mask.items() if mask & s) for s in range(2**n)]


def steps(part: str, masks: list[tuple[int, int, int, int]]) -> Iterator[tuple]:
    """The rows of a part: every order, every step."""
    total = sum(m[1] for m in masks)
    gone, good, toxic = (removals({m[0]: m[k] for m in masks}) for k in (1, 2, 3))
    share = [int(120 * x) for x in shapley(gone)]
    for order in permutations(range(N)):
        name, before = "".join(FILTERS[i] for i in order), 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            removed = gone[after] - gone[before]
            yield (part, name, step, total - gone[after], removed, gone[1 << i] - removed,
                   gone[ALL] - gone[ALL ^ 1 << i], good[after] - good[before], toxic[after] - toxic[before], share[i])
            before = after


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter order and step."""
    ship(docs.sparkSession)
    # at most 32 masks a part
    parts = failures(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    columns = [c.split()[0] for c in STEP_SCHEMA.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for part, masks in zip(f["part"], f["masks"], strict=True):
                counts = [(m["mask"], m["n"], m["good"], m["toxic"]) for m in masks]
                yield pd.DataFrame(list(steps(part, counts)), columns=columns)

    return parts.mapInPandas(run, STEP_SCHEMA)


def interactions(by_mask: dict[int, int]) -> dict[tuple[str, str], int]:
    """Documents that each pair of filters both fail: v(a) + v(b) - v(a and b)."""
    v = removals(by_mask)
    return {(FILTERS[a], FILTERS[b]): v[1 << a] + v[1 << b] - v[1 << a | 1 << b] for a, b in combinations(range(N), 2)}
