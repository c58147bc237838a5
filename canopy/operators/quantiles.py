"""Exact quantiles and running sums of wide columns.

``percentile`` merges a column's whole value -> count map in one task.  That is fine for coded answers
and fails for a continuous column.  Here no task holds more than a range of the distinct values:

1. ``value_counts``: rows collapse to (keys, column, value, n), partial counts before the shuffle.
2. ``in_ranges``: the counts are range-partitioned by (keys, value), numbered by partition and written
   to the shared folder.  The ranges are cut from a sample of all (key, value) pairs, so they hold about
   equally many values however the values crowd and however the keys differ in size.
3. Prefix sums over the (key, range) totals give every range the rank it starts at.
4. Only the ranges with a wanted rank are read again; the neighbours of a quantile are found there.

NULL values are skipped, NULL keys are a key of their own, NaN is the largest value.  A key without a
value has no row.  Quantiles interpolate linearly between the two neighbours; ``n`` is the weight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canopy.operators.split import null_safe_join
from canopy.session import stored

NAME, VALUE, COUNT, RANGE = "column_name", "value", "n", "_range"


def value_counts(df: DataFrame, values: dict[str, Column], keys: list[str] | None = None,
                 weight: Column | None = None) -> DataFrame:
    """(keys..., column_name, value double, n): rows per non-NULL value of each named expression, or
    the sum of ``weight`` where a row stands for several."""
    keys = keys or []
    rows = df.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                     (F.lit(1) if weight is None else weight).cast("long").alias("_w"),
                     *[c.cast("double").alias(f"_v_{name}") for name, c in values.items()])
    long = rows.unpivot([*[f"_k_{k}" for k in keys], "_w"], [f"_v_{name}" for name in values], NAME, VALUE)
    return (long.where(F.col(VALUE).isNotNull()).groupBy(*[f"_k_{k}" for k in keys], NAME, VALUE).agg(F.sum("_w").alias(COUNT))
            .select(*[F.col(f"_k_{k}").alias(k) for k in keys], F.substring(NAME, 4, 1 << 30).alias(NAME), VALUE, COUNT))


def in_ranges(table: DataFrame, keys: list[str], order: str = VALUE, descending: bool = False) -> DataFrame:
    """``table`` in ranges of (keys, order) with the number of its range.  It is written, because a
    second evaluation may cut the ranges at other places."""
    parts = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = F.col(order).desc() if descending else F.col(order).asc()
    return stored(table.repartitionByRange(parts, *keys, by).withColumn(RANGE, F.spark_partition_id()), "ranges")


def range_totals(ranged: DataFrame, keys: list[str], cols: list[str], first: Column | None = None) -> DataFrame:
    """(keys..., _range, per column its sum over the earlier ranges of the key ``_before_c``, over this
    range ``_in_c`` and over all ``_all_c``), and as ``_next`` the value that the aggregate ``first``
    has in the key's next range.  A key has at most as many rows as there are ranges."""
    per = ranged.groupBy(*keys, RANGE).agg(*[F.sum(c).alias(f"_in_{c}") for c in cols],
                                           *([] if first is None else [first.alias("_first")]))
    whole = Window.partitionBy(*keys)
    in_order = whole.orderBy(RANGE)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    out = per.select("*", *[F.coalesce(F.sum(f"_in_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in cols],
                     *[F.sum(f"_in_{c}").over(whole).alias(f"_all_{c}") for c in cols],
                     *([] if first is None else [F.lead("_first").over(in_order).alias("_next")]))
    return out if first is None else out.drop("_first")


def quantiles(ranged: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """(keys..., n_total, q): the quantiles of ``value`` weighted by ``n`` in the order of ``probs``,
    from a table of ``in_ranges``."""
    at = F.array(*[F.struct(F.lit(i).alias("_i"), (F.lit(float(p)) * (F.col(f"_all_{COUNT}") - 1)).alias("_pos"))
                   for i, p in enumerate(probs)])
    wanted = (range_totals(ranged, keys, [COUNT])
              .select(*keys, RANGE, f"_in_{COUNT}", f"_before_{COUNT}", f"_all_{COUNT}", F.inline(at))
              .withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor("_pos"), F.ceil("_pos")))))
              .where((F.col("_rank") >= F.col(f"_before_{COUNT}"))
                     & (F.col("_rank") < F.col(f"_before_{COUNT}") + F.col(f"_in_{COUNT}"))))
    # at most two ranks a probability: the list is bounded by ``probs``
    wanted = wanted.groupBy(*keys, RANGE, f"_before_{COUNT}", f"_all_{COUNT}").agg(
        F.collect_list(F.struct("_i", "_pos", "_rank")).alias("_wanted"))
    inside = Window.partitionBy(*keys, RANGE).orderBy(VALUE).rowsBetween(Window.unboundedPreceding, 0)
    end = F.col(f"_before_{COUNT}") + F.sum(COUNT).over(inside)
    found = (null_safe_join(ranged, wanted, [*keys, RANGE]).withColumn("_end", end)
             .select(*keys, VALUE, COUNT, "_end", f"_all_{COUNT}", F.inline("_wanted"))
             .where((F.col("_rank") >= F.col("_end") - F.col(COUNT)) & (F.col("_rank") < F.col("_end"))))
    lo, hi = F.col("_lo"), F.col("_hi")
    each = found.groupBy(*keys, "_i", "_pos", f"_all_{COUNT}").agg(F.min(VALUE).alias("_lo"), F.max(VALUE).alias("_hi"))
    each = each.withColumn("_q", F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (F.col("_pos") - F.floor("_pos"))))
    return each.groupBy(*keys).agg(
        F.max(f"_all_{COUNT}").alias("n_total"),
        F.transform(F.array_sort(F.collect_list(F.struct("_i", "_q"))), lambda x: x["_q"]).alias("q"))


def fit_quantiles(df: DataFrame, values: dict[str, Column], probs: list[float], key: str | None = None,
                  weight: Column | None = None) -> dict:
    """{key: {name: [quantile per probability]}}, or {name: [...]} without a key, on the driver: a row
    per key and named expression.  A name without a value has NULL quantiles."""
    keys = [key] if key else []
    ranged = in_ranges(value_counts(df, values, keys, weight), [*keys, NAME])
    out: dict = {}
    for r in quantiles(ranged, [*keys, NAME], probs).collect():
        out.setdefault(r[key] if key else None, {})[r[NAME]] = list(r["q"])
    none = [None] * len(probs)
    full = {k: {name: got.get(name, none) for name in values} for k, got in out.items()}
    return full if key else full.get(None, {name: none for name in values})


def running_sums(ranged: DataFrame, keys: list[str], order: str, cols: list[str], descending: bool = False,
                 following: bool = False) -> DataFrame:
    """A table of ``in_ranges`` whose ``order`` is distinct inside a key, with per column the sum up to
    and with the row ``cum_c`` and the key's total ``tot_c``, the row's position ``_i`` from 1 and, if
    asked, the next row's value ``next_c`` (NULL at the end).  No window holds more than one range of
    one key; the rows beyond its edges come with the range's totals."""
    sort = F.desc(order) if descending else F.asc(order)
    picked = F.max_by if descending else F.min_by
    ranged = ranged.withColumn("_one", F.lit(1).cast("long"))
    sums = [*cols, "_one"]
    off = range_totals(ranged, keys, sums, picked(F.struct(*cols), F.col(order)) if following else None)
    off = off.select(*keys, RANGE, *[f"_before_{c}" for c in sums], *[f"_all_{c}" for c in cols], *(["_next"] if following else []))
    inside = Window.partitionBy(*keys, RANGE).orderBy(sort)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    j = null_safe_join(ranged, off, [*keys, RANGE])
    j = j.select(*ranged.columns, *[(F.sum(c).over(upto) + F.col(f"_before_{c}")).alias(f"cum_{c}") for c in cols],
                 *[F.col(f"_all_{c}").alias(f"tot_{c}") for c in cols],
                 (F.row_number().over(inside) + F.col("_before__one")).cast("int").alias("_i"),
                 *([F.coalesce(F.lead(c).over(inside), F.col("_next")[c]).alias(f"next_{c}") for c in cols] if following else []))
    return j.drop("_one")
