"""Exact quantiles of many columns by radix selection.

A first scan counts values by a coarse, order-keeping code (sign and 64 steps per power of
two), with the least and largest value of each bucket. Only buckets that hold a wanted rank
and more than one value are looked at again: their rows are counted by finer cells between
the bucket's least and largest value, and so on until every wanted bucket is a single value.
Once few rows are left, the cells are the values themselves, so small tables take two scans
and every further factor of ``CELLS`` one more. Nothing is sorted but one row per bucket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomframe.session import stored

#: Cells per bucket and scan, and rows that are few enough to count value by value.
CELLS, FEW = 4096, 1_000_000
#: Wanted buckets up to this number travel to the rows; more are joined by their keys.
SHIPPED = 10_000
_STEPS, _LOWEST = 64, 1100


def unpivot(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form ``(keep..., column, value)`` of numeric columns."""
    return df.unpivot(list(keep), [F.col(c).cast("double").alias(c) for c in cols],
                      "column", "value") if cols else df


def code(value: Column) -> Column:
    """A small integer that never falls where the value rises."""
    size = F.abs(value)
    step = (F.floor(F.log2(size) * _STEPS) + _LOWEST * _STEPS).cast("int")
    far = 4 * _LOWEST * _STEPS
    by_size = F.when(size == 0, F.lit(0)).when(size == float("inf"), F.lit(far)).otherwise(step)
    return F.when(F.isnan(value), F.lit(far + 1)).when(value < 0, -by_size).otherwise(by_size)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_{k}"]) for k in keys])


def _spots(probs: Sequence[float], total: Column) -> Column:
    """Positions (from 0, not whole) of the quantiles among ``total`` values."""
    return F.transform(F.expr(f"array({', '.join(f'{float(p)!r}D' for p in probs)})"), lambda p: (total - 1) * p)


def _ranks(probs: Sequence[float], total: Column, above: bool) -> Column:
    spots = _spots(probs, total)
    below = F.transform(spots, lambda s: F.floor(s))
    return F.concat(below, F.transform(spots, lambda s: F.ceil(s))) if above else below


def _selected(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str],
              above: bool = True) -> DataFrame:
    """The values at the quantiles' positions (and, with ``above``, at the next ones).

    One row per value: how many values lie before it, how often it occurs, and the whole
    column's count, mean and squared deviations.
    """
    keys = [*by, "column"]
    values = unpivot(df, cols, by).filter(F.col("value").isNotNull()).withColumn("_code", code(F.col("value")))
    x = F.col("value")
    counted = [F.count(F.lit(1)).alias("_n"), F.min(x).alias("_lo"), F.max(x).alias("_hi")]
    first = stored(values.groupBy(*keys, "_code").agg(*counted, F.sum(x).alias("_sum"), F.var_pop(x).alias("_var")))

    whole = Window.partitionBy(*keys)
    up = Window.partitionBy(*keys).orderBy("_code").rowsBetween(Window.unboundedPreceding, -1)
    mean = F.sum("_sum").over(whole) / F.sum("_n").over(whole)
    placed = first.select(
        *keys, "_code", "_n", "_lo", "_hi", F.coalesce(F.sum("_n").over(up), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("_total"), mean.alias("_mean"),
        F.sum(F.col("_n") * (F.col("_var") + F.pow(F.col("_sum") / F.col("_n") - mean, F.lit(2.0)))).over(whole).alias("_m2"))

    def holding(buckets: DataFrame) -> DataFrame:
        ranks = _ranks(probs, F.col("_total"), above)
        return buckets.filter(F.exists(ranks, lambda r: (F.col("_before") <= r) & (r < F.col("_before") + F.col("_n"))))

    known = stored(holding(placed))
    open_ = F.col("_lo") < F.col("_hi")
    rows, buckets = known.filter(open_).agg(F.sum("_n"), F.count(F.lit(1))).first()
    while buckets:
        wide = known.filter(open_).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_code").alias("__code"),
                                          F.col("_lo").alias("_from"), F.col("_hi").alias("_to"),
                                          "_before", "_total", "_mean", "_m2")
        inside = values.join(F.broadcast(wide) if buckets <= SHIPPED else wide,
                             _same(values, wide, keys) & (values["_code"] == wide["__code"])
                             & values["value"].between(wide["_from"], wide["_to"]))
        share = (x - F.col("_from")) / (F.col("_to") - F.col("_from"))
        cell = x if rows <= FEW else F.floor(share * CELLS).cast("double")
        cells = inside.groupBy(*keys, "_code", "_from", "_before", "_total", "_mean", "_m2", cell.alias("_cell")).agg(*counted)
        below = Window.partitionBy(*keys, "_code", "_from").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        finer = cells.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_n").over(below), F.lit(0)))
        known = stored(known.filter(~open_).unionByName(holding(finer.select(known.columns))))
        rows, buckets = known.filter(open_).agg(F.sum("_n"), F.count(F.lit(1))).first()

    return known.withColumnRenamed("_lo", "_value").drop("_hi", "_code")


def column_summary(df: DataFrame, cols: Sequence[str], probs: Mapping[str, float],
                   by: Sequence[str] = ()) -> DataFrame:
    """count, mean, sample std and linear-interpolated quantiles per (group, column).

    Nulls are left out; a column without values in a group has no row there.
    """
    keys = [*by, "column"]
    known = _selected(df, cols, list(probs.values()), by)
    aggs, out = [], []
    for name, p in probs.items():
        spot = (F.col("_total") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(spot)), ("hi", F.ceil(spot))):
            here = (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_n"))
            aggs.append(F.max(F.when(here, F.col("_value"))).alias(f"_{side}_{name}"))
        at = (F.col("count") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (at - F.floor(at))).alias(name))
    n = F.col("count")
    return known.groupBy(*keys).agg(F.first("_total").alias("count"), F.first("_mean").alias("mean"),
                                    F.first("_m2").alias("_m2"), *aggs).select(
        *keys, "count", "mean", F.when(n > 1, F.sqrt(F.col("_m2") / (n - 1))).alias("std"), *out)


def cut_values(df: DataFrame, cols: Sequence[str], parts: int) -> DataFrame:
    """column, value: the values at every ``1 / parts`` of each column's rows, each once."""
    probs = [k / parts for k in range(1, parts)]
    return _selected(df, cols, probs, [], above=False).select("column", F.col("_value").alias("value")).distinct()


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Mapping[str, float],
                    by: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolated quantiles per (group, column), long form."""
    return column_summary(df, cols, probs, by).drop("mean", "std")
