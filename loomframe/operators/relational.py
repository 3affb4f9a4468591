"""Projections, filters, joins, set operations, sorts and plain summaries."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.functions.columns import mapped
from loomframe.operators.joins import skew_join, union_all
from loomframe.operators.ordered import Ordered, row_number, run_sum
from loomframe.operators.quantiles import column_summary, exact_quantiles, unpivot  # noqa: F401
from loomframe.session import stored

# -- projections and filters --------------------------------------------------


def select_matching(df: DataFrame, pattern: str, keep: Sequence[str] = ()) -> DataFrame:
    """The ``keep`` columns and every column whose name matches the pattern."""
    found = [c for c in df.columns if c not in keep and re.search(pattern, c)]
    return df.select(*keep, *found)


def select_except(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def filter_in(df: DataFrame, col: str, values: Sequence, negate: bool = False) -> DataFrame:
    inside = F.col(col).isin(*values)
    return df.filter(~inside if negate else inside)


def recode(df: DataFrame, col: str, mapping: Mapping | DataFrame) -> DataFrame:
    """Replace codes; a code without a partner becomes null.

    A dictionary becomes a literal map.  A ``(key, value)`` table is joined.
    """
    if isinstance(mapping, DataFrame):
        table = mapping.select(F.col("key").alias(col), F.col("value").alias("_new"))
        out = skew_join(df, table, [col], "left").withColumn(col, F.col("_new"))
        return out.select(*df.columns)
    return df.withColumn(col, mapped(F.col(col), mapping))


def negate_where(df: DataFrame, condition: Column, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.when(condition, -F.col(c)).otherwise(F.col(c)) for c in cols})


def fill_missing(df: DataFrame, value: float = -1) -> DataFrame:
    """Constant in place of missing numbers; NaN counts as missing."""
    return df.na.fill(value)


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def null_counts(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def mod_sample(df: DataFrame, col: str, n: int) -> DataFrame:
    """Every n-th key: a development sample that is the same on every run."""
    return df.filter(F.pmod(F.col(col), F.lit(n)) == 0)


def has_field(df: DataFrame, path: str) -> DataFrame:
    """Rows whose (nested) text field exists and is not empty."""
    return df.filter(F.col(path).isNotNull() & (F.col(path) != ""))


# -- joins --------------------------------------------------------------------


def label_by_presence(left: DataFrame, right: DataFrame, on: Sequence[str],
                      name: str = "target") -> DataFrame:
    """1 where the key occurs in the right table, else 0.

    The right keys are made distinct first, so no row is doubled.
    """
    keys = right.select(*on).distinct().withColumn(name, F.lit(1))
    return left.join(keys, list(on), "left").withColumn(name, F.coalesce(name, F.lit(0)))


def delete_matching(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return skew_join(df, keys.select(*on), on, "left_anti")


def keep_ids(df: DataFrame, ids: DataFrame, on: Sequence[str]) -> DataFrame:
    return skew_join(df, ids.select(*on).distinct(), on, "left_semi")


def enrich(df: DataFrame, dim: DataFrame, on: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Set columns from a table with one row per key; without a match they keep
    the value they had, or null when they are new."""
    new = {c: f"_new_{c}" for c in cols}
    table = dim.select(*on, *[F.col(c).alias(n) for c, n in new.items()])
    out = skew_join(df, table, on, "left")
    values = {c: F.coalesce(F.col(n), F.col(c)) if c in df.columns else F.col(n)
              for c, n in new.items()}
    return out.withColumns(values).drop(*new.values())


def override_labels(df: DataFrame, labels: DataFrame, on: Sequence[str],
                    label: str) -> DataFrame:
    return enrich(df, labels, on, [label])


# -- set operations -----------------------------------------------------------


def union_tagged(frames: Mapping[str, DataFrame], name: str = "source") -> DataFrame:
    return union_all([df.withColumn(name, F.lit(tag)) for tag, df in frames.items()])


def distinct_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


# -- summaries ----------------------------------------------------------------


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), col)


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("count"))


def share_where(df: DataFrame, condition: Column) -> DataFrame:
    """Share of all rows for which the condition holds (null does not hold)."""
    holds = F.coalesce(condition.cast("double"), F.lit(0.0))
    return df.agg(F.avg(holds).alias("share"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class its rows and (rows / classes) / rows of the class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    per_class = counts.agg(F.sum("count") / F.count(F.lit(1))).scalar()
    return counts.withColumn("weight", per_class / F.col("count"))


def row_weights(df: DataFrame, label: str) -> DataFrame:
    """Every row with the weight of its class."""
    return enrich(df, class_weights(df, label), [label], ["weight"])


QUARTILES = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, quartiles and max, one row per column."""
    return column_summary(df, cols, QUARTILES).select("column", "count", "mean", "std", *QUARTILES)


def box_stats(df: DataFrame, group: Sequence[str], cols: Sequence[str],
              normalise: bool = False) -> DataFrame:
    """Five-number summary and mean per group and column; with ``normalise``
    every column is first divided by its maximum over all rows."""
    if normalise:
        top = df.agg(*[F.max(c).alias(c) for c in cols]).first()
        df = df.withColumns({c: F.try_divide(F.col(c), F.lit(top[c])) for c in cols})
    return column_summary(df, cols, QUARTILES, group).select(*group, "column", *QUARTILES, "mean")


def run_band(df: DataFrame, step: str, value: str, z: float = 2.576) -> DataFrame:
    """Mean, population std and mean ± z·std of a value over runs, per step."""
    mean, std = F.col("mean"), F.col("std")
    return df.groupBy(step).agg(
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("std")).withColumns(
        {"lower": mean - z * std, "upper": mean + z * std})


# -- sorts and best rows ------------------------------------------------------


def top(df: DataFrame, by: Sequence[str], limit: int | None = None,
        tie: Sequence[str] = ()) -> DataFrame:
    """Largest first; all rows when no limit is given."""
    out = df.orderBy(*[F.desc(c) for c in by], *tie)
    return out if limit is None else out.limit(limit)


def best_rows(df: DataFrame, metrics: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """For each metric the whole row with the highest value; ties by ``tie``."""
    key = [F.col(c) for c in tie]
    rows = []
    for m in metrics:
        # Largest metric first, then smallest tie key: one partial aggregate each.
        place = F.struct(-F.col(m), *key)
        rows.append(F.min_by(F.struct(*df.columns), F.when(F.col(m).isNotNull(), place)))
    best = df.agg(F.array(*[F.struct(F.lit(m).alias("metric"), r.alias("row"))
                            for m, r in zip(metrics, rows)]).alias("_best"))
    return best.select(F.explode("_best").alias("_b")).select("_b.metric", "_b.row.*")


def ranked_models(df: DataFrame, metric: str, n: int, tie: Sequence[str]) -> DataFrame:
    """Rows whose competition rank by the metric is at most n; ties share a rank."""
    counts = stored(df.groupBy(metric).agg(F.count(F.lit(1)).alias("_n")))
    ordered = counts.filter(F.col(metric).isNotNull()).withColumn("_neg", -F.col(metric))
    ranks = Ordered(ordered, [], ["_neg"]).scan(_upto=run_sum(F.col("_n")))
    ranks = ranks.withColumn("rank", F.col("_upto") - F.col("_n") + 1).filter(F.col("rank") <= n)
    return df.join(ranks.select(metric, "rank"), metric).orderBy("rank", *tie)


def sorted_values(df: DataFrame, col: str, tie: str) -> DataFrame:
    """Values with their ascending position, starting at 1."""
    rows = df.select(col, tie).filter(F.col(col).isNotNull())
    return Ordered(rows, [], [col, tie]).scan(position=row_number())


def cluster_listing(df: DataFrame, cluster: str, name: str) -> DataFrame:
    return df.select(cluster, name).orderBy(cluster, name)
