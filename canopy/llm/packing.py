"""Bound-certified best-fit packing (op 7).

Documents become token ids and an end id; only those longer than a sequence are cut, into whole
sequences and a rest. Pieces are dealt to partitions of a bounded size. Each partition packs its
pieces by best-fit decreasing and computes a lower bound of its number of sequences from
dual-feasible functions of the lengths. A partition that meets its bound is done. Those with a gap
hand the pieces of sequences that are not full to new, fewer partitions, which pack again; this
ends when all meet their bounds, when one partition is left, or after `rounds`.

Null text is empty: a piece with the end id alone. Repeated rows are packed each. Null doc_ids are
packed like others. An empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, raw_text, ship, written
from .seekable import _groups
from .tokens import coder

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"
#: Pieces that one partition packs at once; it bounds a task's memory.
PART_PIECES = 1 << 15


def pieces(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents; `with_ids` adds their ids as little-endian 32-bit bytes."""
    tail = struct.pack("<I", end_id)

    def rows(it: Iterator[tuple]) -> Iterator[tuple]:
        code = coder(tokenizer)
        for group in _groups(it):
            for (doc_id, _), ids in zip(group, code.ids([t for _, t in group]), strict=True):
                ids += tail
                for k, at in enumerate(range(0, len(ids), 4 * size)):
                    own = ids[at:at + 4 * size]
                    yield (doc_id, k, at // 4, len(own) // 4, zlib.crc32(own), *((own,) if with_ids else ()))

    return map_rows(docs.select("doc_id", raw_text().alias("text")), rows,
                    PIECES + ", ids binary" * with_ids, ("tokens",))


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each piece, and the number of bins.

    Open bins are kept by their free space; a bit set of the spaces in use finds the least that fits.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(size + 1)]
    used, n = 0, 0
    order = np.argsort(-lengths, kind="stable")
    for i, x in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = used >> x
        if fits:
            space = x + (fits & -fits).bit_length() - 1
            b = free[space].pop()
            if not free[space]:
                used ^= 1 << space
        else:
            space, b, n = size, n, n + 1
        bins[i], offsets[i] = b, size - space
        if rest := space - x:
            free[rest].append(b)
            used |= 1 << rest
    return bins, offsets, n


def lower_bound(lengths: np.ndarray, size: int, steps: int = 20) -> int:
    """Sequences that any packing of these lengths needs.

    Dual-feasible functions f map lengths so that what fits in one sequence has a sum of at most 1;
    the rounded-up sum over all pieces is then a bound. Used are U_e (lengths over size - e count
    whole, those under e nothing) for every e, composed with u_k (k-fold rounding) for k to `steps`.
    All sums are integers: f is scaled by its denominator.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=size + 1).astype(np.int64)
    x = np.arange(size + 1, dtype=np.int64)
    best = -(-int((count * x).sum()) // size)
    e = np.arange(0, size // 2 + 1)
    above = np.concatenate([np.cumsum(count[::-1])[::-1], [0]])  # pieces of at least x
    for k in range(0, steps + 1):
        if k == 0:
            value, scale = x, size
        else:
            whole = (k + 1) * x % size == 0
            value, scale = np.where(whole, x * k, (k + 1) * x // size * size), k * size
        run = np.concatenate([[0], np.cumsum(count * value)])
        total = above[size - e + 1] * scale + run[size - e + 1] - run[e]
        best = max(best, -(-int(total.max()) // scale))
    return best


def pack(parts: DataFrame, size: int = 2048, rounds: int = 4, part_pieces: int = PART_PIECES) -> DataFrame:
    """Adds sequence_id, offset, fill, and the certificate (bins, bound) of the partition that packed last."""
    spark = parts.sparkSession
    ship(spark)
    out_cols = parts.columns
    schema = ", ".join(f"`{c}` {t}" for c, t in parts.dtypes)
    schema += ", sequence_id long, offset long, fill int, bins int, bound int"

    def packer(turn: int):
        def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
            lengths = pdf["length"].to_numpy(np.int64)
            bins, offsets, n = best_fit_decreasing(lengths, size)
            fill = np.bincount(bins, weights=lengths, minlength=n).astype(np.int64)
            return pdf[out_cols].assign(
                sequence_id=(turn << 56) + (int(key[0]) << 28) + bins, offset=offsets,
                fill=fill[bins], bins=n, bound=lower_bound(lengths, size))
        return one

    full = F.col("length") == size
    whole = parts.filter(full).select(
        *out_cols, ((F.lit(127).cast("long") * (1 << 56)) + F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), F.lit(size).alias("fill"), F.lit(1).alias("bins"), F.lit(1).alias("bound"))
    done, rest = [whole], parts.filter(~full)
    for turn in range(rounds):
        n = rest.count()
        if not n:
            break
        groups = -(-n // part_pieces)
        salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id() % 64, F.lit(turn)),
                      F.lit(groups))
        packed = written(rest.withColumn("_part", salt).groupBy("_part").applyInPandas(packer(turn), schema), "packed")
        met = (F.col("bins") == F.col("bound")) | (F.col("fill") == size)
        if groups == 1 or turn == rounds - 1:
            done.append(packed)
            break
        done.append(packed.filter(met))
        rest = packed.filter(~met).select(*out_cols)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0,
                   with_ids: bool = False) -> DataFrame:
    return pack(written(pieces(docs, tokenizer, size, end_id, with_ids), "pieces"), size)
