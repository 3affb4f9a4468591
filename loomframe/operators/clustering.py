"""k-means with restarts and density clustering of points in the plane."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.operators.joins import skew_join, union_all
from loomframe.operators.models import VECTOR, assemble
from loomframe.operators.ordered import Ordered, row_number
from loomframe.session import stored


def kmeans(df: DataFrame, features: Sequence[str], k: int, restarts: int = 10, seed: int = 0,
           keep: Sequence[str] = ()) -> tuple[DataFrame, dict]:
    """Labels of the best of several starts, with its inertia and silhouette
    (squared Euclidean, which differs from the plain Euclidean one)."""
    rows = stored(assemble(df, features).select(*keep, VECTOR))
    best = None
    for start in range(restarts):
        model = KMeans(k=k, seed=seed + start, featuresCol=VECTOR,
                       predictionCol="cluster").fit(rows)
        cost = model.summary.trainingCost
        if best is None or cost < best[0]:
            best = (cost, model)
    labelled = best[1].transform(rows)
    score = ClusteringEvaluator(predictionCol="cluster", featuresCol=VECTOR,
                                metricName="silhouette",
                                distanceMeasure="squaredEuclidean").evaluate(labelled)
    return labelled.select(*keep, "cluster"), {"inertia": best[0], "silhouette": score}


# -- density clustering -------------------------------------------------------
#
# Points go to square cells whose diagonal is eps, so all points of a cell are
# within eps of each other.  A cell with min_pts points or more holds core points
# only, and its pairs never need to be looked at.  Points of other cells number
# fewer than min_pts per cell; only they are compared with points around them.


def _around(i: Column, j: Column) -> Column:
    """The cells that can hold a point within eps of a point of cell (i, j)."""
    steps = [(a, b) for a in range(-2, 3) for b in range(-2, 3)
             if (a, b) != (0, 0) and abs(a) + abs(b) < 4]
    return F.array(*[F.struct((i + a).alias("ci"), (j + b).alias("cj")) for a, b in steps])


# Up to this many points on both sides, two squares' points are simply compared.
_FEW = 32


def _in_squares(points: DataFrame, size: float) -> DataFrame:
    return points.withColumns({"si": F.floor(F.col("x") / size), "sj": F.floor(F.col("y") / size)})


def _renamed(df: DataFrame, side: str, cell: tuple[str, str]) -> DataFrame:
    """Cell columns under the given names, the others with the side's letter."""
    return df.select(F.col("ci").alias(cell[0]), F.col("cj").alias(cell[1]),
                     *[F.col(c).alias(f"{side}_{c}") for c in df.columns if c not in ("ci", "cj")])


def _touching_cells(core: DataFrame, cells: DataFrame, eps: float, width: float) -> DataFrame:
    """Pairs of neighbouring cells with core points within eps of each other.

    Bounding boxes of the points of ever smaller squares are compared: a pair of
    boxes that must be within eps joins its cells, one that cannot be is dropped.
    Of the undecided ones, those with few points compare them and only the others
    are split further.  The answer is exact and no step lists all pairs of points
    of two crowded cells.
    """
    own, other = ("ci", "cj"), ("di", "dj")
    around = cells.select("ci", "cj", F.inline(_around(F.col("ci"), F.col("cj"))).alias(*other))
    forward = (F.col("ci") < F.col("di")) | (
        (F.col("ci") == F.col("di")) & (F.col("cj") < F.col("dj")))
    pairs = around.filter(forward).join(
        cells.select(F.col("ci").alias("di"), F.col("cj").alias("dj")), list(other))
    found, level = [], 0
    while True:
        squares = _in_squares(core, width / 2 ** level)
        boxes = squares.groupBy("ci", "cj", "si", "sj").agg(
            F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"),
            F.max("y").alias("y1"), F.count(F.lit(1)).alias("n"))
        left, right = _renamed(boxes, "l", own), _renamed(boxes, "r", other)
        if level:  # children of the squares still to be decided
            up = {side: {f"up_{side}_{c}": F.floor(F.col(f"{side}_{c}") / 2)
                         for c in ("si", "sj")} for side in "lr"}
            pairs = pairs.join(left.withColumns(up["l"]), [*own, *up["l"]]).join(
                right.withColumns(up["r"]), [*other, *up["r"]])
        else:
            pairs = pairs.join(left, list(own)).join(right, list(other))
        gap = {c: F.greatest(F.col(f"r_{c}0") - F.col(f"l_{c}1"),
                             F.col(f"l_{c}0") - F.col(f"r_{c}1"), F.lit(0.0)) for c in "xy"}
        far = {c: F.greatest(F.col(f"r_{c}1") - F.col(f"l_{c}0"),
                             F.col(f"l_{c}1") - F.col(f"r_{c}0")) for c in "xy"}
        judged = stored(pairs.filter(
            gap["x"] * gap["x"] + gap["y"] * gap["y"] <= eps * eps).select(
            *own, *other, *[f"{s}_{c}" for s in "lr" for c in ("si", "sj")],
            (far["x"] * far["x"] + far["y"] * far["y"] <= eps * eps).alias("must"),
            (F.greatest("l_n", "r_n") <= _FEW).alias("few")))
        joined = judged.filter("must").select(*own, *other).distinct()
        left_over = judged.join(joined, [*own, *other], "left_anti").drop("must")
        points = squares.select("ci", "cj", "si", "sj", "x", "y")
        near = left_over.filter("few").join(
            _renamed(points, "l", own), [*own, "l_si", "l_sj"]).join(
            _renamed(points, "r", other), [*other, "r_si", "r_sj"])
        dx, dy = F.col("l_x") - F.col("r_x"), F.col("l_y") - F.col("r_y")
        compared = near.filter(dx * dx + dy * dy <= eps * eps).select(*own, *other)
        found.append(stored(joined.unionByName(compared).distinct()))
        pairs = left_over.filter(~F.col("few")).join(
            found[-1], [*own, *other], "left_anti").select(
            *own, *other, *[F.col(f"{s}_{c}").alias(f"up_{s}_{c}")
                            for s in "lr" for c in ("si", "sj")])
        pairs = stored(pairs)
        if pairs.isEmpty():
            return union_all(found).distinct()
        level += 1


def connected(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(node, root)``: the smallest node of each connected component.

    ``edges`` are ``(a, b)``.  Every node points to its smallest neighbour, the
    pointers are followed to their ends, and the graph shrinks to these ends
    until no edge is left; each round leaves a fraction of the nodes.
    """
    state = nodes.select("node", F.col("node").alias("root"))
    links = stored(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .filter("a <> b").distinct())
    while not links.isEmpty():
        parent = stored(links.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p")))
        moving = True
        while moving:
            up = parent.select(F.col("a").alias("p"), F.col("p").alias("_next"))
            step = stored(skew_join(parent.select("a", "p"), up, ["p"]).select(
                "a", F.col("_next").alias("p"), (F.col("p") != F.col("_next")).alias("moved")))
            parent, moving = step, not step.filter("moved").isEmpty()
        ends = {c: parent.select(F.col("a").alias(c), F.col("p").alias(f"p_{c}"))
                for c in ("a", "b", "root")}
        state = stored(skew_join(state, ends["root"], ["root"], "left").select(
            "node", F.coalesce("p_root", "root").alias("root")))
        moved = skew_join(skew_join(links, ends["a"], ["a"]), ends["b"], ["b"], hot_from=links)
        links = stored(moved.select(F.col("p_a").alias("a"), F.col("p_b").alias("b"))
                       .filter("a <> b").distinct())
    return state


def dbscan_2d(df: DataFrame, row_id: str, x: str, y: str, eps: float = 5.0,
              min_pts: int = 5) -> DataFrame:
    """``(row_id, subclass)``: 0 for noise, else clusters numbered from 1 in the
    order of their smallest core id; a border point goes to the first such cluster.
    """
    width = eps / math.sqrt(2) * (1 - 1e-12)
    points = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.col(row_id).alias("id"), F.col(x).cast("double").alias("x"),
        F.col(y).cast("double").alias("y"))
    points = stored(points.withColumns({"ci": F.floor(F.col("x") / width),
                                        "cj": F.floor(F.col("y") / width)}))
    sizes = stored(points.groupBy("ci", "cj").agg(F.count(F.lit(1)).alias("_size")))
    sparse_cells = sizes.filter(F.col("_size") < min_pts)
    cell = ["ci", "cj"]
    sparse = skew_join(points, sparse_cells, cell)
    dense = skew_join(points, sizes.filter(F.col("_size") >= min_pts), cell, "left_semi")
    # A sparse point with every point of the cells around it: at most
    # 20 · (min_pts - 1) sparse points meet any one point.
    asks = sparse.select("id", "x", "y", "_size", F.inline(_around(F.col("ci"), F.col("cj")))
                         .alias("ci", "cj"))

    def near(candidates: DataFrame) -> DataFrame:
        c = candidates.select("ci", "cj", F.col("id").alias("other"), F.col("x").alias("ox"),
                              F.col("y").alias("oy"))
        dx, dy = F.col("x") - F.col("ox"), F.col("y") - F.col("oy")
        # A crowded cell's points are spread; the few askers are copied to them.
        return skew_join(c, asks, cell, hot_from=points).filter(dx * dx + dy * dy <= eps * eps)

    around = near(points).groupBy("id").agg(F.count(F.lit(1)).alias("_near"))
    sparse_core = sparse.join(around, "id", "left").filter(
        F.col("_size") + F.coalesce("_near", F.lit(0)) >= min_pts)
    columns = ["id", "x", "y", "ci", "cj"]
    core = stored(dense.select(*columns).unionByName(sparse_core.select(*columns)))
    cells = stored(core.groupBy("ci", "cj").agg(F.min("id").alias("first_id")))
    touching = _touching_cells(core, cells, eps, width)
    # A cell is named by its smallest core id.
    names = cells.withColumnRenamed("first_id", "a")
    other = cells.select(F.col("ci").alias("di"), F.col("cj").alias("dj"),
                         F.col("first_id").alias("b"))
    edges = touching.join(names, ["ci", "cj"]).join(other, ["di", "dj"]).select("a", "b")
    parts = connected(cells.select(F.col("first_id").alias("node")), edges)
    roots = parts.select("root").distinct()
    numbered = Ordered(roots, [], ["root"]).scan(subclass=row_number())
    cell_class = stored(cells.join(parts.join(numbered, "root"), F.col("first_id") == F.col("node"))
                        .select("ci", "cj", F.col("subclass").cast("int").alias("subclass")))
    core_class = skew_join(core, cell_class, cell).select("id", "subclass")
    rest = sparse.join(core.select("id"), "id", "left_anti")
    # Border points: the first cluster among the core points near them, the own
    # cell's core points included.
    own = rest.select("id", "ci", "cj").join(cell_class, ["ci", "cj"]).select("id", "subclass")
    reached = near(core).select("id", F.col("other")).join(
        core_class.withColumnRenamed("id", "other"), "other").select("id", "subclass")
    border = rest.select("id").join(
        own.unionByName(reached).groupBy("id").agg(F.min("subclass").alias("subclass")), "id")
    found = core_class.unionByName(border)
    return df.select(row_id).join(found.withColumnRenamed("id", row_id), row_id, "left").select(
        row_id, F.coalesce("subclass", F.lit(0)).alias("subclass"))
