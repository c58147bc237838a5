"""Approximate nearest neighbours by cross-polytope hashing (op 2).

A table's two hashes rotate a vector with fast Hadamard pseudo-rotations (three rounds of random
signs and a Walsh-Hadamard transform) and take the nearest signed axis each; the pair is the
bucket. Every vector is indexed in TABLES tables. A query probes, per table, the buckets whose two
axes lie nearest (largest sum of coordinates); all vectors found are ranked by exact cosine. The
number of probes is the same at every size.

Vectors lie in blocks, each with its own buckets of all tables; every block of queries looks its
probes up in every block of vectors. Blocks are cut by the hash of the whole vector, not by bucket: a
bucket that holds a large share of all vectors is spread like any other, and none has a cap. A vector is
stored once, beside its bucket numbers (and a query once, beside its probes), whatever the number of
tables; pairs of blocks are made by a nested-loop join, which shuffles nothing.
Equal vectors are one class: only its smallest ids can be among the nearest, and a window with a
row limit finds these before the shuffle. Classes are searched, not rows.

Null, zero and non-finite vectors (or ones with null components), and rows with a null vec_id, take
no part. Vectors of different lengths are not compared. A vec_id that occurs twice is one candidate
per vector, and never its own neighbour. An empty table gives no rows. Only vec_id and embedding
are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_rows, written

TABLES, PROBES, SEED = 16, 320, 11
MEMBER_BLOCK, QUERY_BLOCK = 8192, 256
#: Numbers in a block of vectors, at most; queries whose nearest a task holds before it hands them on; buckets of all
#: tables up to which a block has a list of their beginnings.
BLOCK_NUMBERS, HELD, BUCKETS = 1 << 20, 1 << 14, 1 << 22


def hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised Walsh-Hadamard transform of each row; the row length is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def signed_axes(x: np.ndarray, table: int, k: int) -> np.ndarray:
    """The rotated vectors' coordinates along all signed axes: columns i and i + d are +i and -i."""
    d = 1 << max(1, (x.shape[1] - 1).bit_length())
    if x.shape[1] < d:
        x = np.pad(x, ((0, 0), (0, d - x.shape[1])))
    rng = np.random.default_rng((SEED, d, table, k))
    for _ in range(3):
        x = hadamard(x * rng.choice([-1.0, 1.0], d))
    return np.concatenate([x, -x], axis=1)


def probes(first: np.ndarray, second: np.ndarray, n: int) -> np.ndarray:
    """The n bucket numbers (first axis * axes + second axis) nearest to a query."""
    total = (first[:, None] + second[None, :]).ravel()
    n = min(n, len(total))
    return np.argpartition(-total, n - 1)[:n]


def unpack(vectors: list[bytes], double: bool) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), "<f8" if double else "<f4").reshape(len(vectors), -1).astype(np.float64)


def scaled(v: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component near 1: exact, and no norm overflows."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1))[1][:, None])


def unit(v: np.ndarray) -> np.ndarray:
    v = scaled(v)
    return v / np.sqrt((v * v).sum(axis=1))[:, None]


def classes(vectors: DataFrame, ids_kept: int) -> DataFrame:
    """(cls, ids, h, vec): each distinct vector with its smallest ids; cls is the smallest."""
    per = Window.partitionBy("h", "vec")
    first = vectors.withColumn("r", F.dense_rank().over(per.orderBy("vec_id"))).filter(F.col("r") <= ids_kept)
    # windows, not a group: they share one exchange of the vectors
    each = first.withColumns({"ids": F.sort_array(F.collect_set("vec_id").over(per)), "n": F.row_number().over(per.orderBy("vec_id"))})
    return each.filter("n = 1").select(F.col("vec_id").alias("cls"), "ids", "h", "vec")


def bucket_type(dim: int) -> str:
    """Bytes that hold a bucket number of vectors of this length."""
    return "<u2" if (2 << max(1, (dim - 1).bit_length())) ** 2 <= 1 << 16 else "<u4"


def _blocks(it: Iterator[tuple], most: int, made: Callable[[np.ndarray], np.ndarray]) -> Iterator[tuple[int, list[tuple], bytes, np.ndarray]]:
    """Rows of one vector length at a time, at most so many: dimension, rows without their vectors, the vectors' bytes
    side by side (float64), and what `made` gives for their unit vectors."""
    held: dict[int, list] = {}

    def block(dim: int) -> tuple:
        parts = held.pop(dim)
        return dim, [r for p in parts for r in p[0]], np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts], axis=1)

    for rows in _chunks(it, min(1024, most)):
        v = np.array([r[-1] for r in rows], dtype=np.float64)
        dim = v.shape[1]
        parts = held.setdefault(dim, [])
        parts.append(([r[:-1] for r in rows], v, made(unit(v))))
        if sum(len(p[1]) for p in parts) + 1024 > min(most, max(1024, BLOCK_NUMBERS // dim)):
            yield block(dim)
    for dim in list(held):
        yield block(dim)


class Members:
    """A block of vectors with the buckets of all tables."""

    def __init__(self, dim: int, cls: bytes, ids: bytes, n_ids: bytes, codes: bytes, x: bytes, tables: int, double: bool):
        self.cls, self.ids = np.frombuffer(cls, "<i8"), np.frombuffer(ids, "<i8")
        self.end = np.cumsum(np.frombuffer(n_ids, "<i4"))
        self.begin = self.end - np.frombuffer(n_ids, "<i4")
        self.v = scaled(unpack([x], double).reshape(len(self.cls), dim))
        self.norm = np.sqrt((self.v * self.v).sum(axis=1))
        self.unit = self.v / self.norm[:, None]
        self.buckets = (2 << max(1, (dim - 1).bit_length())) ** 2
        flat = (np.frombuffer(codes, bucket_type(dim)).reshape(tables, -1) + self.buckets * np.arange(tables)[:, None]).ravel()
        order = np.argsort(flat, kind="stable")
        self.member, self.codes = order % len(self.cls), flat[order]
        self.start = None
        if tables * self.buckets <= BUCKETS:
            self.start = np.append(0, np.cumsum(np.bincount(flat, minlength=tables * self.buckets)))

    def found(self, buckets: np.ndarray) -> np.ndarray:
        """The members in any of these buckets (numbered through all tables)."""
        if self.start is None:
            lo, hi = (np.searchsorted(self.codes, buckets, side=s) for s in ("left", "right"))
        else:
            lo, hi = self.start[buckets], self.start[buckets + 1]
        size = hi - lo
        at = np.arange(size.sum()) + np.repeat(lo - (np.cumsum(size) - size), size)
        hit = np.zeros(len(self.cls), bool)
        hit[self.member[at]] = True
        return np.flatnonzero(hit)

    def nearest(self, x: np.ndarray, buckets: np.ndarray, n: int) -> list[list[tuple]]:
        """For each query (a row of `x`, and of `buckets`) its n nearest among the members found: (-score, cls, ids)."""
        about, out = unit(x) @ self.unit.T, []
        for q, probed, a in zip(scaled(x), buckets, about, strict=True):
            some = self.found(probed)
            if len(some) > n:  # products of matrices are near enough to leave out all that cannot be among the nearest
                least = np.partition(a[some], len(some) - n)[len(some) - n]
                some = some[a[some] >= least - 1e-9]
            # row-wise products, not a matrix product: equal pairs get equal scores in any block
            score = (self.v[some] * q).sum(axis=1) / (self.norm[some] * np.sqrt((q * q).sum()))
            best = some[sel_order(score, self.cls[some], n)]
            of = dict(zip(some.tolist(), score.tolist(), strict=True))
            out.append([(-of[i], int(self.cls[i]), self.ids[self.begin[i]:self.end[i]].tolist()) for i in best.tolist()])
        return out


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, tables: int = TABLES, n_probes: int = PROBES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found to each row of `queries` among `vectors`.

    Both have vec_id and embedding; a query's own vec_id is no candidate.
    """
    double = "array<double>" in dict(vectors.dtypes)["embedding"]
    raw, member_block, query_block = "<f8" if double else "<f4", MEMBER_BLOCK, QUERY_BLOCK
    cls = classes(_valid(vectors), k + 1)
    # each distinct query vector is searched once; `asked` keeps who asked
    asked = _valid(queries).distinct().withColumnRenamed("vec_id", "query_id")
    q = written(asked.groupBy("h", "vec").agg(F.min("query_id").alias("qcls")).select("qcls", "h", "vec"), "query-vectors")

    def members(it: Iterator[tuple]) -> Iterator[tuple]:
        def codes(u: np.ndarray) -> np.ndarray:
            axes = [[signed_axes(u, t, s).argmax(axis=1) for s in (0, 1)] for t in range(tables)]
            m = 2 << max(1, (u.shape[1] - 1).bit_length())
            return np.array([a * m + b for a, b in axes], bucket_type(u.shape[1]))

        for dim, rows, v, code in _blocks(it, member_block, codes):
            ids = [r[1] for r in rows]
            yield (dim, np.array([r[0] for r in rows], "<i8").tobytes(), np.concatenate(ids).astype("<i8").tobytes(),
                   np.array([len(i) for i in ids], "<i4").tobytes(), code.tobytes(), v.astype(raw).tobytes())

    def asks(it: Iterator[tuple]) -> Iterator[tuple]:
        def buckets(u: np.ndarray) -> np.ndarray:
            both = [(signed_axes(u, t, 0), signed_axes(u, t, 1)) for t in range(tables)]
            return np.array([[np.sort(probes(f, s, n_probes)) for f, s in zip(*b, strict=True)] for b in both], bucket_type(u.shape[1]))

        for dim, rows, v, probed in _blocks(it, query_block, buckets):
            yield dim, np.array([r[0] for r in rows], "<i8").tobytes(), probed.transpose(1, 0, 2).tobytes(), v.astype(raw).tobytes()

    index = written(map_rows(cls.select("cls", "ids", "vec"), members,
                             "dim int, cls binary, ids binary, n_ids binary, codes binary, x binary"), "index")
    ask = written(map_rows(q.select("qcls", "vec"), asks, "qdim int, qcls binary, probes binary, qx binary"), "probes")
    # no equi-join: it would deal all blocks of one vector length to one task
    pairs = ask.crossJoin(index).filter("qdim - dim = 0").select("dim", "qcls", "probes", "qx", "cls", "ids", "n_ids", "codes", "x")

    def near(it: Iterator[tuple]) -> Iterator[tuple]:
        held: dict[bytes, tuple[np.ndarray, list]] = {}  # block of queries: their nearest so far
        last: tuple[bytes, Members | None] = (b"", None)
        for dim, qcls, probed, qx, one, ids, n_ids, codes, x in it:
            if qcls + qx not in held and sum(len(h[0]) for h in held.values()) >= HELD:
                yield from _nearest_of(held)
                held.clear()
            if last[0] != one + x:
                last = one + x, Members(dim, one, ids, n_ids, codes, x, tables, double)
            block, who = last[1], np.frombuffer(qcls, "<i8")
            asked_at = np.frombuffer(probed, bucket_type(dim)).reshape(len(who), tables, -1) + block.buckets * np.arange(tables)[:, None]
            new = block.nearest(unpack([qx], double).reshape(len(who), dim), asked_at.reshape(len(who), -1), k + 1)
            old = held.get(qcls + qx, (who, [[]] * len(who)))[1]
            held[qcls + qx] = who, [sorted(a + b)[:k + 1] for a, b in zip(old, new, strict=True)]
        yield from _nearest_of(held)

    found = map_rows(pairs, near, "qcls long, cls long, score double, ids array<long>")
    order = Window.partitionBy("qcls").orderBy(F.desc("score"), "cls")
    best = (found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1)
            .withColumn("one", F.explode("ids"))
            .groupBy("qcls").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), F.col("one").alias("id")))).alias("near")))
    whose = asked.join(q.select("qcls", "h", "vec"), ["h", "vec"]).select("query_id", "qcls")
    own = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k)
    return (whose.join(best, "qcls").select("query_id", F.posexplode(own).alias("i", "x"))
            .select("query_id", (F.col("i") + 1).alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.less")).alias("score")))


def _nearest_of(held: dict[bytes, tuple[np.ndarray, list]]) -> Iterator[tuple]:
    for who, near in held.values():
        for i, best in zip(who.tolist(), near, strict=True):
            yield from ((i, cls, -less, ids) for less, cls, ids in best)


def sel_order(score: np.ndarray, ids: np.ndarray, n: int) -> list[int]:
    """Places of the n best by score, then id."""
    if len(score) > n:
        least = np.partition(score, len(score) - n)[len(score) - n]
        some = np.flatnonzero(score >= least)
    else:
        some = np.arange(len(score))
    return some[np.lexsort((ids[some], -score[some]))][:n].tolist()


def _chunks(it: Iterator[tuple], size: int = 1024) -> Iterator[list[tuple]]:
    """Rows in groups of one vector length each."""
    held: dict[int, list[tuple]] = {}
    for r in it:
        own = held.setdefault(len(r[-1]), [])
        own.append(r)
        if len(own) >= size:
            yield held.pop(len(r[-1]))
    yield from held.values()


def _valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec, h) of the rows that take part."""
    v = F.col("embedding")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.filter(F.col("vec_id").isNotNull() & v.isNotNull()).filter(F.size(v) > 0).filter(~bad)
            .filter(F.exists(v, lambda x: x != 0)).select("vec_id", v.alias("vec"), F.xxhash64(v).alias("h")))
