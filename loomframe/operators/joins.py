"""Joins that keep a hot key from landing in one task."""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.operators.ordered import groups_fit
from loomframe.session import group_limit, stored

_names = itertools.count()


def hot_keys(df: DataFrame, on: Sequence[str], limit: int) -> DataFrame:
    """Keys with more rows than the limit and the pieces each is cut into, written once
    (at most rows / limit keys, null keys among them)."""
    return stored(df.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > limit)
                  .select(*on, F.ceil(F.col("_rows") / limit).cast("int").alias("_pieces")))


def _content(df: DataFrame) -> Column:
    """A hash of a row; columns with maps, which have no hash, count by their text."""
    return F.xxhash64(*[F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString()
                        else F.col(f"`{f.name}`") for f in df.schema])


def skew_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
              hot_from: DataFrame | None = None) -> DataFrame:
    """Equi join of a large table with one that has few rows per key.

    The keys are counted first, on ``hot_from`` when a cheaper table bounds the
    counts of ``left``.  Without a hot key this is the plain join.  Otherwise the
    fact rows of hot keys, null keys too, get a salt drawn from their own content,
    and only the matching right rows are copied, as often as their own key needs.
    """
    on = list(on)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("the left side must be the preserved side")
    counted = left if hot_from is None else hot_from
    if groups_fit(counted, on):
        return left.join(right, on, how)
    hot = hot_keys(counted, on, group_limit(left.sparkSession))
    if hot.isEmpty():
        return left.join(right, on, how)
    tag = f"_{next(_names)}"
    salt, pieces, keys = f"_salt{tag}", f"_pieces{tag}", [f"_k{i}{tag}" for i in range(len(on))]
    hot = hot.toDF(*keys, pieces)

    def marked(df: DataFrame) -> DataFrame:
        same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(hot[k]) for c, k in zip(on, keys)])
        return df.join(hot, same, "left").drop(*keys)

    # A row's salt depends on its content only, so a rerun task repeats it; fact rows
    # carry an id and differ from one another.
    cut_left = marked(left.withColumn(salt, _content(left))).withColumn(salt, F.coalesce(
        F.pmod(F.col(salt), F.col(pieces)).cast("int"), F.lit(0)))
    cut_right = marked(right).withColumn(salt, F.explode(F.sequence(
        F.lit(0), F.coalesce(F.col(pieces), F.lit(1)) - 1)))
    return cut_left.drop(pieces).join(cut_right.drop(pieces), [*on, salt], how).drop(salt)


#: A table of so many rows goes to every task.
FEW = 100_000


def lookup_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
                hot_from: DataFrame | None = None) -> DataFrame:
    """``skew_join`` with a table that is cheap to read; when it has few rows it is sent to
    all tasks, so that no fact row moves and a key may be as hot as it likes."""
    if right.limit(FEW + 1).count() <= FEW:
        return left.join(F.broadcast(right), list(on), how)
    return skew_join(left, right, on, how, hot_from)


def hashed_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join that looks rows up in hash tables of the smaller right side instead of
    sorting both sides, unless a key has very many rows there."""
    if groups_fit(right, on):
        right = right.hint("shuffle_hash")
    return left.join(right, list(on))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
