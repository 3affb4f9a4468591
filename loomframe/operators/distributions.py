"""Histograms and densities: the numbers behind the charts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomframe.operators.quantiles import column_summary
from loomframe.session import stored


def histogram(df: DataFrame, col: str, edges: Sequence[float], density: bool = False,
              by: Sequence[str] = (), right: bool = False) -> DataFrame:
    """Rows per bin, empty bins included, per group when ``by`` is given.

    Bins are [a, b) and the last one [a, b]; with ``right`` they are (a, b] and
    the first one [a, b].  Every group of the input has rows, and ``below`` and
    ``above`` say how many of its values lie beyond the edges (NaN above).
    """
    edges = sorted(edges)
    sign = -1.0 if right else 1.0
    cuts = sorted(sign * e for e in edges)
    n = len(edges) - 1
    # One count per slot: -1 and n are beyond the edges, null is no value.
    found = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="_x", outputCol="_b", handleInvalid="keep") \
        .transform(df.select(*by, (F.col(col).cast("double") * sign).alias("_x")))
    x = F.col("_x")
    slot = F.when(x == cuts[-1], n - 1).otherwise(F.col("_b").cast("int") - 1)
    slot = F.when(x.isNotNull(), F.when(F.isnan(x), n).otherwise(F.lit(n - 1) - slot if right else slot))
    counts = found.groupBy(*by, slot.alias("_slot")).agg(F.count(F.lit(1)).alias("_rows"))
    own = F.map_from_entries(F.collect_list(F.when(F.col("_slot").isNotNull(), F.struct("_slot", "_rows"))))
    per = counts.groupBy(*by).agg(own.alias("_own"))  # one entry per slot
    bins = F.array(*[F.struct(F.lit(i).alias("bin"), F.lit(float(a)).alias("low"), F.lit(float(b)).alias("high"))
                     for i, (a, b) in enumerate(zip(edges, edges[1:]))])

    def rows(at: Column) -> Column:
        return F.coalesce(F.try_element_at("_own", at), F.lit(0).cast("long"))

    out = per.select(*by, "_own", F.inline(bins)).select(
        *by, "bin", "low", "high", rows(F.col("bin")).alias("count"),
        rows(F.lit(-1)).alias("below"), rows(F.lit(n)).alias("above"))
    if density:
        # One row per bin and group from here on.
        total = F.sum("count").over(Window.partitionBy(*by)) if by else F.sum("count").over(
            Window.partitionBy())
        out = out.withColumn("density", F.try_divide(
            F.col("count").cast("double"), total * (F.col("high") - F.col("low"))))
    return out


def bandwidth(df: DataFrame, col: str) -> float:
    """Rule-of-thumb kernel width 0.9 · min(sd, IQR / 1.34) · n^(-1/5)."""
    q = column_summary(df, [col], {"q1": 0.25, "q3": 0.75}).first()
    spread = min(q["std"], (q["q3"] - q["q1"]) / 1.34) or q["std"] or 1.0
    return 0.9 * spread * q["count"] ** -0.2


def hermite_order(tolerance: float) -> int:
    """Terms after which the series below is off by less than the tolerance.

    In a cell one kernel width wide, a term n is at most 1.0865 · 0.5^n / sqrt(n!) of the
    kernel's top (Cramér's bound on Hermite functions).
    """
    n, term = 0, 1.0865
    while 2 * term > tolerance:  # later terms add less than this one again
        n += 1
        term *= 0.5 / math.sqrt(n)
    return n


def kde(df: DataFrame, col: str, grid: Sequence[float], width: float, tolerance: float = 1e-13) -> DataFrame:
    """Gaussian kernel density on a grid, by a fast Gauss transform.

    The values of each cell, one kernel width wide, become the moments of a Hermite series
    about its middle, in one aggregate; a cell is then evaluated at the grid points where
    its kernels are not below the tolerance.  So rows follow occupied cells near the grid,
    and the result is within twice the tolerance times the kernel's top of the direct sum.
    Missing values and NaN are left out; infinite ones count only in the number of values.
    """
    far = width * (math.sqrt(2 * math.log(1 / tolerance)) + 1)
    order, scale = hermite_order(tolerance), math.sqrt(2) * width
    value = F.col(col).cast("double")
    x = F.col("_x")
    points = df.select(value.alias("_x")).filter(x.isNotNull() & ~F.isnan(x))
    marks = sorted(set(map(float, grid)))
    if not marks:
        return df.sparkSession.createDataFrame([], "x double, density double")
    near = x.between(marks[0] - far, marks[-1] + far)
    placed = points.select("_x", F.when(near, F.floor(x / width)).alias("_cell")) \
        .select("_cell", ((x - (F.col("_cell") + 0.5) * width) / scale).alias("_u"))
    moments = [F.sum(F.pow("_u", F.lit(float(k)))) / float(math.factorial(k)) for k in range(1, order)]
    cells = stored(placed.groupBy("_cell").agg(
        F.count(F.lit(1)).alias("_n"), F.array(F.count(F.lit(1)).cast("double"), *moments).alias("_m")))
    n = cells.agg(F.sum("_n")).first()[0]
    if not n:
        return df.sparkSession.createDataFrame([], "x double, density double")
    middle = (F.col("_cell") + 0.5) * width
    listed = F.array(*[F.lit(g) for g in marks])
    at = cells.filter("_cell IS NOT NULL").select(
        "_cell", "_m", F.explode(F.filter(listed, lambda g: F.abs(g - middle) <= far)).alias("x"))
    t = (F.col("x") - middle) / scale
    top = F.exp(-t * t)
    # Hermite functions by their recurrence: h(k + 1) = 2 t h(k) - 2 k h(k - 1).
    start = F.struct(F.lit(0.0).alias("last"), top.alias("now"), F.lit(0.0).alias("k"), F.lit(0.0).alias("sum"))
    series = F.aggregate("_m", start, lambda s, m: F.struct(
        s["now"].alias("last"), (2 * t * s["now"] - 2 * s["k"] * s["last"]).alias("now"),
        (s["k"] + 1).alias("k"), (s["sum"] + m * s["now"]).alias("sum")), lambda s: s["sum"])
    weight = 1 / (n * width * math.sqrt(2 * math.pi))
    sums = at.select("x", series.alias("_s")).groupBy("x").agg((F.sum("_s") * weight).alias("density"))
    every = df.sparkSession.range(1).select(F.explode(listed).alias("x"))
    return every.join(sums, "x", "left").na.fill(0.0, ["density"])
