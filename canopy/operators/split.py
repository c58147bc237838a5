"""Reproducible splits and folds.

Every split is a pure function of (seed, id, class): rows are ordered by
``md5('<seed>:<id>')`` (then id), ranked inside their class, and the rank decides the
split.  The same text runs in any SQL engine, so the oracle reproduces it exactly.

A plain ``row_number() OVER (PARTITION BY class ...)`` would put a whole class (possibly a
third of the data) on one task.  ``two_stage_rank`` gives the same ranks without that:
  1. bucket = an order-preserving prefix of the sort key (first hex digits of the md5);
  2. rows per (class, bucket) -> prefix sums over buckets (<= 16^digits rows per class);
  3. rank inside (class, bucket) + offset of the bucket  == the one-window rank.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK, N_CLASS = "_rank", "_n_class"


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An equi-join in which NULL keys meet: a NULL label or group is a value of its own."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def hash_key(id_col: str, seed: int = 42) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def two_stage_rank(df: DataFrame, partition: list[str], order: list[Column], bucket: Column,
                   rank_col: str = RANK, count_col: str = N_CLASS) -> DataFrame:
    """Exact ``row_number() over (partition by p order by order...)`` plus the partition
    size, without a window whose partition is a whole class.  ``bucket`` must be monotone
    in ``order`` (a prefix of the leading sort key)."""
    b = df.withColumn("_bucket", bucket)
    # (partition, bucket) counts: at most classes x buckets rows
    counts = b.groupBy(*partition, "_bucket").agg(F.count(F.lit(1)).alias("_nb"))
    wp = Window.partitionBy(*partition) if partition else Window.partitionBy(F.lit(0))
    offsets = counts.select(
        *partition, "_bucket",
        F.coalesce(F.sum("_nb").over(wp.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
        F.sum("_nb").over(wp).alias(count_col))
    inner = Window.partitionBy(*partition, "_bucket").orderBy(*order)
    ranked = b.withColumn("_inner", F.row_number().over(inner))
    out = null_safe_join(ranked, offsets, [*partition, "_bucket"])
    return out.withColumn(rank_col, (F.col("_off") + F.col("_inner")).cast("long")).drop(
        "_bucket", "_inner", "_off")


def two_stage_rank_by_key(df: DataFrame, partition: list[str], key: str,
                          buckets: int = 4096) -> DataFrame:
    """Exact rank by a numeric key: buckets are approximate-quantile ranges of the key
    (balanced whatever the key's distribution), found by ``Bucketizer``'s binary search in
    the JVM; buckets are monotone in the key, so the two-stage rank stays exact."""
    from pyspark.ml.feature import Bucketizer

    qs = [i / buckets for i in range(1, buckets)]
    edges = df.agg(F.percentile_approx(F.col(key).cast("double"), qs, 10_000).alias("q")).first()["q"] or []
    splits = [float("-inf")] + sorted(set(float(e) for e in edges)) + [float("inf")]
    b = df.withColumn("_keyd", F.col(key).cast("double"))
    b = Bucketizer(splits=splits, inputCol="_keyd", outputCol="_kb", handleInvalid="keep").transform(b)
    out = two_stage_rank(b, partition, [F.col(key)], F.col("_kb"))
    return out.drop("_keyd", "_kb")


def hash_rank(df: DataFrame, id_col: str, label: str | None, seed: int = 42,
              digits: int = 4) -> DataFrame:
    """Rank by md5 order, per class when ``label`` is given (NULL label is its own class)."""
    h = hash_key(id_col, seed)
    b = df.withColumn("_h", h)
    part = [label] if label else []
    out = two_stage_rank(b, part, [F.col("_h"), F.col(id_col)], F.substring("_h", 1, digits))
    return out.drop("_h")


def _frac(x: float) -> tuple[int, int]:
    f = Fraction(x).limit_denominator(10_000)
    return f.numerator, f.denominator


def allocate(sizes: DataFrame, label: str, size: str, share: float, name: str) -> DataFrame:
    """Adds ``name``: how many rows of each class the first part takes.

    The part holds ceil(share * total) rows over all classes, as the reference's splitter
    does; the other part's rows are shared among the classes in proportion, rounded down,
    and what is left goes one each to the largest remainders (ties: the smaller label,
    NULL first).  ``sizes`` has one row per class."""
    num, den = _frac(share)
    w = Window.partitionBy()
    total = F.sum(size).over(w)
    t = sizes.withColumn("_tot", total)
    t = t.withColumn("_rest", F.col("_tot") - F.floor((F.col("_tot") * num + den - 1) / den))
    t = t.withColumn("_base", F.floor(F.col("_rest") * F.col(size) / F.col("_tot")))
    t = t.withColumn("_rem", F.col("_rest") * F.col(size) - F.col("_base") * F.col("_tot"))
    order = Window.orderBy(F.desc("_rem"), F.col(label).asc_nulls_first())
    extra = (F.row_number().over(order) <= F.col("_rest") - F.sum("_base").over(w)).cast("long")
    return t.withColumn(name, F.col(size) - F.col("_base") - extra).drop("_tot", "_rest", "_base", "_rem")


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))


def holdout_split(df: DataFrame, id_col: str, label: str, test_size: float = 0.2,
                  seed: int = 42) -> DataFrame:
    """K1: stratified holdout of ceil(test_size * n) rows; of each class the first rows in
    md5 order are 'test', the rest 'train'."""
    parts = allocate(class_sizes(df, label), label, "_n", test_size, "_test").select(label, "_test")
    r = null_safe_join(hash_rank(df, id_col, label, seed), parts, [label])
    split = F.when(F.col(RANK) <= F.col("_test"), "test").otherwise("train")
    return r.withColumn("split", split).drop(RANK, N_CLASS, "_test")


def three_way_split(df: DataFrame, id_col: str, label: str, test_size: float = 0.2,
                    val_size: float = 0.25, seed: int = 42) -> DataFrame:
    """K2: test as in K1, then ceil(val_size * rest) of the rest are 'val', shared among the
    classes in the same way."""
    parts = allocate(class_sizes(df, label), label, "_n", test_size, "_test")
    parts = allocate(parts.withColumn("_left", F.col("_n") - F.col("_test")), label, "_left", val_size, "_val")
    r = null_safe_join(hash_rank(df, id_col, label, seed), parts.select(label, "_test", "_val"), [label])
    split = (F.when(F.col(RANK) <= F.col("_test"), "test")
             .when(F.col(RANK) <= F.col("_test") + F.col("_val"), "val")
             .otherwise("train"))
    return r.withColumn("split", split).drop(RANK, N_CLASS, "_test", "_val")


def kfold(df: DataFrame, id_col: str, k: int = 5, seed: int = 42) -> DataFrame:
    """K3: shuffled, not stratified: global md5 rank mod k."""
    r = hash_rank(df, id_col, None, seed)
    return r.withColumn("fold", ((F.col(RANK) - 1) % k).cast("int")).drop(RANK, N_CLASS)


def stratified_kfold(df: DataFrame, id_col: str, label: str, k: int = 5, seed: int = 42,
                     keep_rank: bool = False) -> DataFrame:
    """K4: shuffled, stratified: per-class md5 rank mod k (class shares differ by at most
    one row per fold)."""
    r = hash_rank(df, id_col, label, seed)
    r = r.withColumn("fold", ((F.col(RANK) - 1) % k).cast("int"))
    return r if keep_rank else r.drop(RANK, N_CLASS)


def inner_fold(rank: Column, outer_fold: Column, k_outer: int, k_inner: int) -> Column:
    """Nested CV: fold of a row inside the training part of ``outer_fold`` (rows whose
    outer fold differs), from its per-class rank alone: inner rank = rank minus the rows
    of the outer fold ranked before it, then mod k_inner."""
    before = F.floor((rank - 2 - outer_fold + k_outer) / k_outer)
    return ((rank - before - 1) % k_inner).cast("int")


def contiguous_kfold(df: DataFrame, id_col: str, label: str, k: int = 5) -> DataFrame:
    """K5: stratified, unshuffled (``cv=5`` on a classifier): within each class rows keep id
    order and fill folds in contiguous blocks.  Block sizes follow the allocation of
    scikit-learn's StratifiedKFold: fold i of class c gets the positions j = i (mod k) of
    the class-sorted vector that fall in class c's range [s_c, s_c + n_c); classes come in
    the order of their first row (smallest id)."""
    r = two_stage_rank_by_key(df, [label], id_col)
    # class offsets s_c: (classes) rows
    cls = (df.groupBy(label).agg(F.count(F.lit(1)).alias(N_CLASS), F.min(id_col).alias("_first"))
           .withColumn("_s", F.coalesce(F.sum(N_CLASS).over(
               Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    s, n = F.col("_s"), F.col(N_CLASS)

    def upto(i: int) -> Column:  # rows of class c in folds 0..i
        tot = F.lit(0)
        for f in range(i + 1):
            size = (F.floor((s + n - 1 - f + k) / k) - F.floor((s - 1 - f + k) / k))
            tot = tot + size
        return tot

    fold = F.lit(k - 1)
    for i in reversed(range(k - 1)):
        fold = F.when(F.col(RANK) <= F.col(f"_c{i}"), F.lit(i)).otherwise(fold)
    cls = cls.select(label, *[upto(i).alias(f"_c{i}") for i in range(k - 1)], "_s")
    out = null_safe_join(r, cls, [label])  # one row per class
    return out.withColumn("fold", fold.cast("int")).drop(
        RANK, N_CLASS, "_s", *[f"_c{i}" for i in range(k - 1)])


def split_shares(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Rows and share per split value."""
    c = df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))
