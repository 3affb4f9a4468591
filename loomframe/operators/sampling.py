"""Repeatable random samples and splits.

Every random choice orders rows by a hash key of their id, so a sample is the
same on any cluster layout and after any lost task; counts are exact.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomframe.functions.columns import mixed_draw, mixed_key
from loomframe.operators.joins import skew_join
from loomframe.operators.ordered import (
    Ordered, groups_fit, last_known, null_safe, row_number, run_sum, whole_count)
from loomframe.operators.relational import keep_ids
from loomframe.session import stored


def shuffled_rank(df: DataFrame, row_id: str, by: Sequence[str], seed: int,
                  salt: str | None = None) -> DataFrame:
    """Add ``_rank`` (1.. in shuffled order) and ``_of`` (rows) within each group."""
    text = F.col(row_id).cast("string")
    if salt:
        text = F.concat(F.col(salt).cast("string"), F.lit(":"), text)
    keyed = df.withColumn("_key", mixed_key(text, seed))
    return Ordered(keyed, by, ["_key", row_id], axis=mixed_draw(F.col("_key"))).scan(
        _rank=row_number(), _of=whole_count()).drop("_key")


#: Keys are counted in so many even ranges; only the range that holds a cut is ranked.
RANGES = 4096


def shuffled_heads(df: DataFrame, row_id: str, by: Sequence[str], sizes: Mapping[str, Column], seed: int,
                   salt: str | None = None) -> DataFrame:
    """Add one boolean per name of ``sizes``: whether the row is among that many first rows of
    its group in shuffled order (a size may use ``_of``, the group's rows, and ``by``).

    Groups within the row limit are ranked by a plain window. Otherwise rows are counted per
    group and range of keys first. That gives the range in which each cut falls; rows of
    other ranges are settled by one comparison and never sorted.
    """
    text = F.col(row_id).cast("string")
    if salt:
        text = F.concat(F.col(salt).cast("string"), F.lit(":"), text)
    if groups_fit(df, by):
        whole = Window.partitionBy(*by)
        placed = df.withColumn("_key", mixed_key(text, seed)).select(
            *df.columns, F.row_number().over(whole.orderBy("_key", row_id)).alias("_rank"),
            F.count(F.lit(1)).over(whole).alias("_of"))
        return placed.select(*df.columns, *[F.coalesce(F.col("_rank") <= size, F.lit(False)).alias(name)
                                            for name, size in sizes.items()])
    keyed = df.withColumn("_key", mixed_key(text, seed)).withColumn(  # null keys come first, as in the window
        "_range", F.coalesce(F.floor(mixed_draw(F.col("_key")) * RANGES).cast("int"), F.lit(0)))
    group = Window.partitionBy(*by, F.lit(0)) if by else Window.partitionBy(F.lit(0))  # at most RANGES rows
    ranges = keyed.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_rows")).select(
        *by, "_range", F.sum("_rows").over(group).alias("_of"),
        F.sum("_rows").over(group.orderBy("_range")).alias("_upto"), "_rows")
    tag, edges = {p: f"_by{i}" for i, p in enumerate(by)}, []
    for i, size in enumerate(sizes.values()):
        edges += [F.max(F.when(F.col("_upto") <= size, F.col("_range"))).alias(f"_whole{i}"),
                  F.max(F.when(F.col("_upto") <= size, F.col("_upto"))).alias(f"_taken{i}"),
                  F.min(F.when(F.col("_upto") > size, F.col("_range"))).alias(f"_edge{i}"),
                  F.max(size).alias(f"_size{i}")]
    cuts = stored(ranges.groupBy(*by).agg(*edges).withColumnsRenamed(tag))
    # One row per group.
    joined = keyed.join(cuts, null_safe(keyed, cuts, tag.items()), "left") if by else \
        keyed.withColumns({c: F.lit(v) for c, v in zip(cuts.columns, cuts.first() or ())})
    edge = [f"_edge{i}" for i in range(len(sizes))]
    on_edge = reduce(lambda a, b: a | b, [F.coalesce(F.col("_range") == F.col(e), F.lit(False)) for e in edge])
    ranked = Ordered(joined.filter(on_edge), [*by, "_range"], ["_key", row_id], axis=mixed_draw(F.col("_key"))).scan(
        _rank=row_number())
    every = ranked.unionByName(joined.filter(~on_edge).withColumn("_rank", F.lit(None).cast("long")))
    out = {name: F.when(F.col("_range") == F.col(f"_edge{i}"), F.col("_rank") + F.coalesce(f"_taken{i}", F.lit(0))
                        <= F.col(f"_size{i}")).otherwise(F.coalesce(F.col("_range") <= F.col(f"_whole{i}"), F.lit(False)))
           for i, name in enumerate(sizes)}
    return every.withColumns(out).select(*df.columns, *sizes)


def stratified_folds(df: DataFrame, row_id: str, label: str, n: int = 10,
                     test_size: float = 0.05, seed: int = 0) -> DataFrame:
    """``(fold, row_id, role)`` of n independent splits with equal class shares."""
    folds = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("fold")
    rows = df.select(folds, row_id, label)
    cut = shuffled_heads(rows, row_id, ["fold", label], {"_test": F.round(F.col("_of") * F.lit(test_size))}, seed,
                         salt="fold")
    return cut.select("fold", row_id, F.when(F.col("_test"), "test").otherwise("train").alias("role"))


def fold_report(folds: DataFrame, df: DataFrame, row_id: str, label: str) -> DataFrame:
    """Rows and share of positives per fold and role."""
    return folds.join(df.select(row_id, label), row_id).groupBy("fold", "role").agg(
        F.count(F.lit(1)).alias("rows"), F.avg((F.col(label) == 1).cast("double")).alias("share"))


def fold_frames(df: DataFrame, folds: DataFrame, k: int,
                row_id: str) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of fold k."""
    mine = folds.filter(F.col("fold") == k)
    return tuple(keep_ids(df, mine.filter(F.col("role") == role), [row_id])
                 for role in ("train", "test"))


def sample_per_class(df: DataFrame, row_id: str, label: str, caps: Mapping[int, int],
                     seed: int = 0) -> DataFrame:
    """At most the given number of rows of each class; other classes are left out."""
    caps = {c: n for c, n in caps.items() if n > 0}
    cap = F.lit(None).cast("long")
    for value, n in caps.items():
        cap = F.when(F.col(label) == value, F.lit(n)).otherwise(cap)
    cut = shuffled_heads(df.filter(F.col(label).isin(*caps)), row_id, [label], {"_head": cap}, seed)
    return cut.filter("_head").drop("_head")


def class_shortfall(df: DataFrame, label: str, caps: Mapping[int, int]) -> DataFrame:
    """Required, available and missing rows of every asked-for class."""
    asked = df.sparkSession.createDataFrame(
        [(c, int(n)) for c, n in caps.items() if n > 0], f"{label} int, required long")
    counts = df.groupBy(F.col(label).cast("int").alias(label)).agg(
        F.count(F.lit(1)).alias("available"))
    out = asked.join(counts, label, "left").withColumn(
        "available", F.coalesce("available", F.lit(0)))
    return out.withColumn("missing", F.greatest(F.col("required") - F.col("available"), F.lit(0)))


def _class_sizes(df: DataFrame, label: str) -> tuple[int, int]:
    row = df.agg(F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)).first()
    return row[0], row[1]


def undersample_split(df: DataFrame, row_id: str, label: str, n_neg: int,
                      test_size: float = 0.2, seed: int = 0) -> DataFrame:
    """All positives and ``n_neg`` negatives, cut into train and test by ``role``."""
    positives, _ = _class_sizes(df, label)
    chosen = sample_per_class(df, row_id, label, {1: positives, 0: n_neg}, seed)
    ranked = shuffled_rank(chosen, row_id, [], seed + 1)
    test = F.col("_rank") <= F.ceil(F.col("_of") * F.lit(test_size))
    return ranked.withColumn("role", F.when(test, "test").otherwise("train")).drop("_rank", "_of")


def split_shares(split: DataFrame, label: str) -> DataFrame:
    return split.groupBy("role").agg(
        F.count(F.lit(1)).alias("rows"), F.avg((F.col(label) == 1).cast("double")).alias("share"))


def reduce_size(df: DataFrame, row_id: str, label: str, total: int, share: float = -1,
                seed: int = 0) -> DataFrame:
    """``total`` rows with the given share of positives (-1 keeps the share)."""
    positives, negatives = _class_sizes(df, label)
    if share == -1:
        share = positives / (positives + negatives)
    keep = min(math.ceil(total * share), positives)
    return sample_per_class(df, row_id, label, {1: keep, 0: total - keep}, seed)


def proportional_split(df: DataFrame, row_id: str, label: str, total: int, share: float = -1,
                       test_size: float = 0.2, seed: int = 0) -> DataFrame:
    """Disjoint train and test rows with exact numbers of each class."""
    positives, negatives = _class_sizes(df, label)
    if share == -1:
        share = positives / (positives + negatives)
    n_pos = math.ceil(total * share)
    n_test = math.ceil(test_size * total)
    test_pos = math.ceil(share * n_test)
    test_of = {1: test_pos, 0: n_test - test_pos}
    all_of = {1: n_pos, 0: total - n_pos}

    def by_class(numbers):
        return F.when(F.col(label) == 1, numbers[1]).otherwise(numbers[0])

    cut = shuffled_heads(df.filter(F.col(label).isin(0, 1)), row_id, [label],
                         {"_test": by_class(test_of), "_all": by_class(all_of)}, seed)
    role = F.when(F.col("_test"), "test").otherwise("train")
    return cut.filter("_all").withColumn("role", role).drop("_test", "_all")


def group_split(df: DataFrame, group: str, share: float, seed: int = 1) -> DataFrame:
    """Send whole groups to ``threshold`` (about the share) or ``model``."""
    draw = mixed_draw(mixed_key(F.col(group), seed))
    return df.withColumn("part", F.when(draw < 1 - share, "model").otherwise("threshold"))


def random_split(df: DataFrame, row_id: str, share: float, seed: int = 0) -> DataFrame:
    """Exactly int(rows · share) rows get the role ``validation``."""
    cut = shuffled_heads(df, row_id, [], {"_held": F.floor(F.col("_of") * F.lit(share))}, seed)
    return cut.withColumn("role", F.when(F.col("_held"), "validation").otherwise("train")).drop("_held")


def weighted_resample(df: DataFrame, row_id: str, weight: str, n: int,
                      seed: int = 0) -> DataFrame:
    """n draws with replacement, each row with chance weight / sum of weights.

    Rows own consecutive stretches of the summed weight and draws are points on
    it.  Both are put in one order, and each draw takes the stretch started last.
    """
    spark = df.sparkSession
    rows = df.filter(F.col(weight) > 0).select(row_id, F.col(weight).cast("double").alias("_w"))
    ends = Ordered(rows, [], [row_id]).scan(_end=run_sum(F.col("_w")))
    starts = ends.select((F.col("_end") - F.col("_w")).alias("at"), F.lit(0).alias("kind"),
                         F.col(row_id).alias("order_id"), F.col(row_id).alias("owner"))
    total = rows.agg(F.sum("_w")).scalar()
    point = mixed_draw(mixed_key(F.col("id"), seed), digits=13) * total
    draws = spark.range(n).select(
        point.alias("at"), F.lit(1).alias("kind"), F.col("id").alias("order_id"),
        F.lit(None).cast(df.schema[row_id].dataType).alias("owner"))
    placed = Ordered(starts.unionByName(draws), [], ["at", "kind", "order_id"]).scan(
        chosen=last_known(F.col("owner")))
    drawn = placed.filter(F.col("kind") == 1).select(
        F.col("order_id").alias("draw"), F.col("chosen").alias(row_id))
    return skew_join(drawn, df, [row_id])
