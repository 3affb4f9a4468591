"""Ordered series: runs, interpolation, ranks, downsampling, sliding windows.

Row order is always given by columns; the last order column must break ties.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomframe.functions.columns import clip
from loomframe.functions.normal import probit
from loomframe.operators.joins import skew_join
from loomframe.operators.ordered import (
    Ordered, groups_fit, last_known, max_before, next_known, null_safe, previous, row_number, run_max,
    run_sum, whole_count, whole_max)
from loomframe.session import group_limit, stored


def segment_runs(df: DataFrame, part: str, state: str, order: Sequence[str],
                 drop=None) -> DataFrame:
    """Number the stretches of equal state within a series (``run`` from 0 on),
    then leave out the rows of the ``drop`` state."""
    series = Ordered(df, [part], order)
    seen = series.scan(_n=row_number(), _before=previous(F.col(state)))
    change = (F.col("_n") > 1) & ~F.col(state).eqNullSafe(F.col("_before"))
    marked = seen.withColumn("_new", change.cast("long"))
    out = Ordered(marked, [part], ["_n"], like=series).scan(run=run_sum(F.col("_new")))
    out = out.drop("_n", "_before", "_new")
    return out if drop is None else out.filter(~F.col(state).eqNullSafe(F.lit(drop)))


def interpolate_linear(df: DataFrame, part: str, order: Sequence[str],
                       cols: Sequence[str]) -> DataFrame:
    """Fill gaps on the straight line between the known neighbours, by row
    position; a leading gap stays null, a trailing gap repeats the last value."""
    series = Ordered(df, [part], order)
    numbered = series.scan(_n=row_number())
    scans = {}
    for c in cols:
        known = F.when(F.col(c).isNotNull(), F.struct(F.col("_n").alias("n"),
                                                      F.col(c).cast("double").alias("v")))
        scans[f"_lo_{c}"], scans[f"_hi_{c}"] = last_known(known), next_known(known)
    near = Ordered(numbered, [part], ["_n"], like=series).scan(**scans)
    out = {}
    for c in cols:
        lo, hi = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        slope = (hi["v"] - lo["v"]) / (hi["n"] - lo["n"])
        line = lo["v"] + slope * (F.col("_n") - lo["n"])
        out[c] = (F.when(F.col(c).isNotNull(), F.col(c).cast("double"))
                  .when(lo.isNull(), None).when(hi.isNull(), lo["v"]).otherwise(line))
    return near.withColumns(out).drop("_n", *scans)


def _akima_slopes(points: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """Known points with the slopes of the two intervals left (a2, a1) and right
    (b0, b1) of each.

    ``points`` are ``(keys, x, y, k, total)`` with k = 1..total.  Blocks of
    consecutive k overlap by three points, so no block grows beyond the limit.
    """
    size = max(limit, 8)
    home = F.floor((F.col("k") - 1) / size)
    at = F.pmod(F.col("k") - 1, F.lit(size))
    # A point near a block edge is also sent to the neighbouring block.
    blocks = F.array_compact(F.array(
        home, F.when((at < 3) & (home > 0), home - 1), F.when(at >= size - 3, home + 1)))
    w = Window.partitionBy(*keys, "_block").orderBy("k")
    spread = points.withColumn("_block", F.explode(blocks)).withColumn(
        "b0", (F.lead("y").over(w) - F.col("y")) / (F.lead("x").over(w) - F.col("x")))
    spread = spread.withColumns({
        "a1": F.lag("b0", 1).over(w), "a2": F.lag("b0", 2).over(w), "b1": F.lead("b0", 1).over(w)})
    return spread.filter(F.col("_block") == home).withColumns(_outer_slopes()).drop("_block")


def _outer_slopes() -> Mapping[str, Column]:
    """Slopes beyond the ends: continued so that they change by equal steps."""
    k, n, pair = F.col("k"), F.col("total"), F.col("total") == 2
    a2, a1, b0, b1 = (F.col(c) for c in ("a2", "a1", "b0", "b1"))
    first, second, last, last_but_one = k == 1, k == 2, k == n, k == n - 1
    return {
        "a1": F.when(first, F.when(pair, b0).otherwise(2 * b0 - b1)).otherwise(a1),
        "a2": F.when(first, F.when(pair, b0).otherwise(3 * b0 - 2 * b1))
        .when(second, F.when(pair, a1).otherwise(2 * a1 - b0)).otherwise(a2),
        "b0": F.when(last, F.when(pair, a1).otherwise(2 * a1 - a2)).otherwise(b0),
        "b1": F.when(last, F.when(pair, a1).otherwise(3 * a1 - 2 * a2))
        .when(last_but_one, F.when(pair, b0).otherwise(2 * b0 - a1)).otherwise(b1),
    }


def interpolate_akima(df: DataFrame, part: str, order: Sequence[str],
                      cols: Sequence[str]) -> DataFrame:
    """Fill gaps by Akima's local cubic through the known rows, by row position;
    leading and trailing gaps stay null (as does a series with one known row).

    All columns are worked on at once, as series of a long table, and joined back once.
    """
    series = Ordered(df, [part], order)
    rows = stored(series.scan(_n=row_number()))
    long = rows.unpivot([part, "_n"], [F.col(c).cast("double").alias(c) for c in cols], "_column", "_value")
    keys = [part, "_column"]
    points = long.filter(F.col("_value").isNotNull()).select(*keys, F.col("_n").alias("x"), F.col("_value").alias("y"))
    points = Ordered(points, keys, ["x"], like=series).scan(k=row_number(), total=whole_count())
    s = _akima_slopes(points, keys, group_limit(df.sparkSession)).withColumns({
        "right": F.abs(F.col("b1") - F.col("b0")), "left": F.abs(F.col("a1") - F.col("a2"))})
    s = Ordered(s, keys, ["k"], like=series).scan(most=whole_max(F.col("right") + F.col("left")))
    both = F.col("right") + F.col("left")
    # Where the slopes around a point agree, the mean of the outer ones is taken.
    t = F.when(both > 1e-9 * F.col("most"),
               (F.col("right") * F.col("a1") + F.col("left") * F.col("b0")) / both
               ).otherwise((F.col("a2") + F.col("b1")) / 2)
    ends = Ordered(s.withColumn("t", t), keys, ["k"], like=series).scan(before=previous(F.struct("x", "y", "t")))
    # The cubic of an interval is kept at the interval's right end.
    cubic = F.struct(F.col("before.x").alias("x0"), F.col("before.y").alias("y0"),
                     F.col("before.t").alias("t0"), F.col("x").alias("x1"),
                     F.col("a1").alias("m"), F.col("t").alias("t1"))
    table = ends.select(F.col(part).alias("_part"), F.col("_column").alias("_of"), F.col("x").alias("_at"),
                        F.when(F.col("before").isNotNull(), cubic).alias("_cubic"))
    joined = long.join(table, null_safe(long, table, [(part, "_part"), ("_column", "_of"), ("_n", "_at")]), "left")
    joined = Ordered(joined.drop("_part", "_of", "_at"), keys, ["_n"], like=series).scan(
        _piece=next_known(F.col("_cubic")))
    p = F.col("_piece")
    h, d = p["x1"] - p["x0"], F.col("_n") - p["x0"]
    c2 = (3 * p["m"] - 2 * p["t0"] - p["t1"]) / h
    c3 = (p["t0"] + p["t1"] - 2 * p["m"]) / (h * h)
    value = p["y0"] + d * (p["t0"] + d * (c2 + d * c3))
    filled = joined.withColumn("_value", F.when(F.col("_value").isNotNull(), F.col("_value")).when(d >= 0, value))
    wide = filled.groupBy(F.col(part).alias("_part"), F.col("_n").alias("_at")).pivot("_column", list(cols)).agg(
        F.max("_value")).toDF("_part", "_at", *[f"_new_{i}" for i in range(len(cols))])
    back = rows.join(wide, null_safe(rows, wide, [(part, "_part"), ("_n", "_at")]), "left")
    return back.withColumns({c: F.col(f"_new_{i}") for i, c in enumerate(cols)}).select(*df.columns)


# -- ranks --------------------------------------------------------------------


def dense_rank_share(df: DataFrame, part: str, cols: Sequence[str]) -> DataFrame:
    """Replace values by dense rank / largest dense rank within the series.

    Nulls are not ranked and stay null.  When a series is above the row limit its
    distinct values are ranked in a long table and joined back.
    """
    if groups_fit(df, [part]):
        own = Window.partitionBy(part)
        ranks = {c: F.when(F.col(c).isNotNull(), F.dense_rank().over(
            own.orderBy(F.asc_nulls_last(c)))) for c in cols}
        ranked = df.withColumns(ranks)
        return ranked.withColumns({c: F.col(c) / F.max(c).over(own) for c in cols})
    long = df.unpivot([part], [F.col(c).cast("double").alias(c) for c in cols],
                      "_column", "_value").filter(F.col("_value").isNotNull()).distinct()
    ranks = Ordered(long, [part, "_column"], ["_value"]).scan(
        _rank=row_number(), _top=whole_count())
    ranks = ranks.withColumn("_share", F.col("_rank") / F.col("_top"))
    out = df
    for c in cols:
        table = ranks.filter(F.col("_column") == c).select(part, "_value", "_share")
        keyed = out.withColumn("_value", F.col(c).cast("double"))
        out = skew_join(keyed, table, [part, "_value"], "left")
        out = out.withColumn(c, F.col("_share")).select(*df.columns)
    return out


def rank_normalise(df: DataFrame, part: str, cols: Sequence[str],
                   edge: float = 1e-5) -> DataFrame:
    """Dense-rank share, clipped off 0 and 1, through the inverse normal."""
    ranked = dense_rank_share(df, part, cols)
    return ranked.withColumns({c: probit(clip(F.col(c), edge, 1 - edge)) for c in cols})


def rank_symmetric(df: DataFrame, part: str, cols: Sequence[str]) -> DataFrame:
    ranked = dense_rank_share(df, part, cols)
    return ranked.withColumns({c: 2 * F.col(c) - 1 for c in cols})


# -- trimming, downsampling, windows ------------------------------------------


def trim_runs(df: DataFrame, run: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """Drop the first and last n rows of every run."""
    counted = Ordered(df, run, order).scan(_n=row_number(), _total=whole_count())
    inside = (F.col("_n") > n) & (F.col("_n") <= F.col("_total") - n)
    return counted.filter(inside).drop("_n", "_total")


def downsample(df: DataFrame, run: Sequence[str], order: Sequence[str], k: int,
               cols: Sequence[str], method: str = "mean",
               keep: Sequence[str] = ()) -> DataFrame:
    """One row per k rows of a run: the mean of each full block, or its first row.

    ``keep`` are columns that are the same throughout a run.
    """
    numbered = Ordered(df, run, order).scan(_n=row_number())
    numbered = numbered.withColumn("block", F.floor((F.col("_n") - 1) / k))
    if method == "first":
        return numbered.filter(F.pmod(F.col("_n") - 1, F.lit(k)) == 0).select(
            *run, *keep, "block", *cols)
    # A block holds k rows, so groups are as small as the factor.
    full = numbered.groupBy(*run, *keep, "block").agg(
        *[F.avg(c).alias(c) for c in cols], F.count(F.lit(1)).alias("_size"))
    return full.filter(F.col("_size") == k).drop("_size")


def window_length(seconds: float, factor: int, rate: int = 100) -> int:
    """Rows in a window of a signal of ``rate`` rows per second after downsampling."""
    return int(seconds * rate / factor)


#: Blocks of a run are so many window lengths (or strides) long.
WINDOWS_EACH = 8


def sliding_windows(df: DataFrame, run: Sequence[str], order: Sequence[str], length: int,
                    stride: int, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Full windows of ``length`` rows every ``stride`` rows of a run.

    A run is cut into blocks some windows long, each with the next ``length - 1`` rows behind
    it, so a row is shuffled about once, however many windows hold it.  Windows are sliced
    out of their block's rows; ``keep`` columns are those of a window's first row.
    """
    at = Ordered(df, run, order).scan(_n=row_number(), _total=whole_count())
    size = WINDOWS_EACH * max(length, stride)
    pos = F.col("_n") - 1
    block = F.floor(pos / size)
    # The halo is shorter than a block, so a row lies in the one before at most.
    blocks = F.when((pos % size < length - 1) & (block > 0), F.array(block - 1, block)).otherwise(F.array(block))
    halo = at.withColumn("_block", F.explode(blocks))
    value = F.struct(F.col("_n"), *[F.col(c).alias(f"_v{i}") for i, c in enumerate([*cols, *keep])])
    grouped = halo.groupBy(*run, "_block").agg(F.array_sort(F.collect_list(value)).alias("_rows"),
                                               F.max("_total").alias("_total"))
    first = F.col("_block") * size
    begin = F.ceil(first / stride) * stride
    last = F.least(first + size - 1, F.col("_total") - length)
    starts = F.when(begin <= last, F.sequence(begin, last, F.lit(stride).cast("long")))
    cut = grouped.select(*run, "_rows", first.alias("_first"), F.explode(starts).alias("start")).select(
        *run, "start", F.slice("_rows", (F.col("start") - F.col("_first") + 1).cast("int"), length).alias("_rows"))
    return cut.select(*run, *[F.get("_rows", F.lit(0))[f"_v{len(cols) + i}"].alias(c) for i, c in enumerate(keep)],
                      "start", *[F.col("_rows").getField(f"_v{i}").alias(c) for i, c in enumerate(cols)])


def slice_rows(df: DataFrame, part: Sequence[str], order: Sequence[str], start: int,
               n: int) -> DataFrame:
    """Rows ``start`` .. ``start + n - 1`` (from 0) of every group."""
    numbered = Ordered(df, part, order).scan(_n=row_number())
    return numbered.filter(F.col("_n").between(start + 1, start + n)).drop("_n")


# -- counts and scores over time ----------------------------------------------


def cumulative_classes(df: DataFrame, time: str, label: str,
                       classes: Sequence) -> DataFrame:
    """Per point in time the rows of each class so far."""
    per_time = stored(df.groupBy(time).agg(*[
        F.count_if(F.col(label) == c).alias(f"n_{c}") for c in classes]))
    return Ordered(per_time, [], [time]).scan(**{
        f"class_{c}": run_sum(F.col(f"n_{c}")) for c in classes}).drop(
        *[f"n_{c}" for c in classes])


def best_epoch(scores: DataFrame, run: str, epoch: str, metric: str, patience: int,
               report: Sequence[str] = ()) -> DataFrame:
    """Epoch with the best validation score under early stopping, per run.

    A score counts when it beats all before it (and 0) at most ``patience``
    epochs after the last one that counted; the first such wait starts before
    epoch 0.  Without any the epoch is 0.  The number of epochs that must be run
    does not change which epoch is best.
    """
    runs = Ordered(scores, [run], [epoch])
    seen = runs.scan(_before=max_before(F.col(metric)))
    better = F.col(metric) > F.greatest(F.coalesce("_before", F.lit(0.0)), F.lit(0.0))
    # The epoch of the last improvement, with this row's own still left out.
    marked = seen.withColumn("_hit", F.when(better, F.col(epoch)))
    marked = Ordered(marked, [run], [epoch], like=runs).scan(_last=max_before(F.col("_hit")))
    late = F.col("_hit") - F.coalesce("_last", F.lit(-1)) > patience
    marked = marked.withColumn("_late", late.cast("int"))
    marked = Ordered(marked, [run], [epoch], like=runs).scan(_stopped=run_max(F.coalesce("_late", F.lit(0))))
    counted = F.when(F.col("_hit").isNotNull() & (F.col("_stopped") == 0), F.col(epoch))
    row = F.struct(F.col(epoch).alias("epoch"), metric, *report)
    place = F.coalesce(counted, F.when(F.col(epoch) == 0, F.lit(-1)))
    best = marked.groupBy(run).agg(F.max_by(row, place).alias("_best"))
    return best.select(run, "_best.*").withColumnRenamed("epoch", "best_epoch")


# -- splitting by subject -----------------------------------------------------


def subject_split(df: DataFrame, part: str, subjects: Sequence, test) -> DataFrame:
    """Add ``role``: the test subject, the one before it for validation, rest train."""
    held = subjects[subjects.index(test) - 1]
    return df.withColumn("role", F.when(F.col(part) == test, "test")
                         .when(F.col(part) == held, "validation").otherwise("train"))
