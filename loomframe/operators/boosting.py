"""Boosted trees grown leaf by leaf, on gradient histograms.

Columns are cut into bins at exact quantiles once. A tree starts as one leaf, and the leaf
whose best split gains most is split next, until the limit of leaves is reached or nothing
gains. A pass over the rows sums gradients, second derivatives and rows per (leaf, column,
bin), for the smaller child of every leaf that may be split next; the larger child is the
parent less that. Tasks add up their own rows in arrays, and one aggregate adds up the
tasks. So a tree takes about as many passes as it is deep, and the driver and each task hold
one histogram per leaf, whatever the number of rows.

Gradients are summed as whole numbers, so a rerun grows the same trees. Missing values and
NaN lie below all others. Rows without label are left out when fitting.
"""

from __future__ import annotations

import math
import random
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.operators.quantiles import cut_values
from loomframe.session import stored

#: Workers get the functions below with their tasks and need not import this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Trees after which the rows' margins are written anew, so that tasks walk few trees.
WRITTEN_EACH = 8
#: Rows packed into one row of arrays, so that passes move arrays and not single values.
BLOCK = 1 << 16
_LOWEST = -1.7976931348623157e308
#: Steps from the root to a node: column, last bin on the left, and 1 for the right side.
Path = list[tuple[int, int, int]]


@dataclass(frozen=True)
class Settings:
    trees: int = 24
    leaves: int = 16
    depth: int = 7
    rate: float = 0.1
    l1: float = 0.0
    l2: float = 0.0
    rows_share: float = 1.0
    columns_share: float = 1.0
    least_rows: int = 20
    least_weight: float = 1e-3
    bins: int = 64
    seed: int = 0


@dataclass(eq=False)
class Leaf:
    """A node: sums of its rows, its best split, and, once split, its children."""

    depth: int
    sums: np.ndarray  # (3, columns, bins): gradient, second derivative, rows
    path: Path
    split: tuple[float, int, int] | None = None  # gain, column, last bin on the left
    counted: list[np.ndarray] | None = None
    children: list[Leaf] = field(default_factory=list)
    value: float = 0.0


class Boosted:
    """Fitted trees; ``trees`` holds the root of each, ``cuts`` the bins' borders by column."""

    def __init__(self, features: Sequence[str], cuts: list[list[float]], settings: Settings):
        self.features, self.cuts, self.settings = list(features), cuts, settings
        self.base, self.trees = 0.0, []

    def border(self, column: int, last: int) -> float:
        """Values below it go left."""
        return self.cuts[column][last - 1] if last else _LOWEST

    def margin(self) -> Column:
        """Log odds of class 1, from the feature columns."""
        def text(node: Leaf) -> str:
            if not node.children:
                return f"{node.value!r}D"
            _, column, last = node.split
            x = f"CAST(`{self.features[column]}` AS DOUBLE)"
            left, right = map(text, node.children)
            return (f"CASE WHEN {x} IS NULL OR isnan({x}) OR {x} < {self.border(column, last)!r}D "
                    f"THEN {left} ELSE {right} END")
        return F.expr(" + ".join([f"{self.base!r}D", *[f"({text(t)})" for t in self.trees]]))

    def score(self, df: DataFrame, keep: Sequence[str], mode: str = "probability") -> DataFrame:
        """The ``keep`` columns and ``prediction``: chance of class 1, margin or class."""
        margin = self.margin()
        value = {"probability": lambda: 1 / (1 + F.exp(-margin)), "margin": lambda: margin,
                 "class": lambda: (margin > 0).cast("int")}[mode]()
        return df.select(*keep, value.alias("prediction"))

    def splits(self) -> list[tuple[int, int, str, float, float]]:
        """tree, depth, column, border and gain of every split."""
        out = []

        def walk(tree: int, node: Leaf) -> None:
            if node.children:
                gain, column, last = node.split
                out.append((tree, node.depth, self.features[column], self.border(column, last), gain))
                for child in node.children:
                    walk(tree, child)

        for number, root in enumerate(self.trees):
            walk(number, root)
        return out


def bin_borders(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Up to ``bins - 1`` borders per column: values at equal shares of the rows."""
    own: dict[str, list[float]] = {c: [] for c in features}
    for r in cut_values(df, features, bins).filter(~F.isnan("value")).collect():  # bins times columns
        own[r["column"]].append(r["value"])
    return [sorted(own[c]) for c in features]


def binned(df: DataFrame, features: Sequence[str], cuts: list[list[float]], keep: dict[str, Column]) -> DataFrame:
    """``keep`` and ``bins``: per feature 0 for missing, else 1 + the borders not above the value."""
    names = [f"_x{i}" for i in range(len(features))]
    rows = df.select(*[c.alias(n) for n, c in keep.items()],
                     *[F.col(f).cast("double").alias(n) for f, n in zip(features, names)])
    slots = []
    for i, (name, own) in enumerate(zip(names, cuts)):
        if own:
            rows = Bucketizer(splits=[-math.inf, *own, math.inf], inputCol=name, outputCol=f"_b{i}",
                              handleInvalid="keep").transform(rows)
        slot = F.col(f"_b{i}").cast("int") + 1 if own else F.lit(1)
        slots.append(F.when(F.col(name).isNull() | F.isnan(name), F.lit(0)).otherwise(slot))
    return rows.select(*keep, F.array(*slots).alias("bins"))


def _score(g, h, s: Settings):
    reduced = np.sign(g) * np.maximum(np.abs(g) - s.l1, 0)
    return reduced * reduced / np.maximum(h + s.l2, 1e-300)


def split_gains(sums: np.ndarray, s: Settings) -> np.ndarray:
    """Gain of each (column, last bin on the left); -inf where a side is too small."""
    left = sums.cumsum(2)
    whole = left[:, :1, -1:]
    right = whole - left
    gains = _score(left[0], left[1], s) + _score(right[0], right[1], s) - _score(whole[0], whole[1], s)
    fine = (np.minimum(left[2], right[2]) >= max(1, s.least_rows)) & (np.minimum(left[1], right[1]) >= s.least_weight)
    return np.where(fine, gains, -np.inf)


def _choose(leaf: Leaf, columns: list[int], s: Settings) -> None:
    if leaf.depth >= s.depth:
        return
    gains = split_gains(leaf.sums, s)[columns]
    at = int(gains.argmax())  # the first of equal ones
    gain = float(gains.flat[at])
    if gain > 1e-12:
        leaf.split = (gain, columns[at // gains.shape[1]], at % gains.shape[1])


def _slots(batch: pa.RecordBatch, columns: int) -> np.ndarray:
    """The ``bins`` of a batch, one array per feature."""
    return batch.column("bins").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, columns).T


def _histograms(rows: DataFrame, weighed: Callable, paths: list[Path], shape: tuple[int, int],
                unit: float) -> list[np.ndarray]:
    """Sums of the rows on each path, by column and bin; the paths don't overlap.

    ``weighed`` cuts a batch into pieces: bins by feature, and whole numbers g and h of the
    rows. A task holds the sums of all paths and gives one row per cell that has rows.
    """
    columns, width = shape

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, len(paths), columns, width), np.int64)
        for bins, g, h in (piece for batch in batches for piece in weighed(batch)):
            for node, path in enumerate(paths):
                on = np.arange(len(g))
                for column, last, side in path:
                    on = on[(bins[column, on] > last) == bool(side)]
                own_g, own_h = g[on], h[on]
                for column in range(columns):
                    cells = bins[column, on].astype(np.intp)
                    np.add.at(sums[0, node, column], cells, own_g)
                    np.add.at(sums[1, node, column], cells, own_h)
                    sums[2, node, column] += np.bincount(cells, minlength=width)
        found = sums[2].nonzero()
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*found, *sums[:, *found])],
                                         ["node", "column", "bin", "g", "h", "n"])

    found = rows.mapInArrow(count, "node long, column long, bin long, g long, h long, n long") \
        .groupBy("node", "column", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))
    out = [np.zeros((3, *shape)) for _ in paths]
    for r in found.collect():  # leaves times columns times bins
        out[r["node"]][:, r["column"], r["bin"]] = r["g"] / unit, r["h"] / unit, r["n"]
    return out


def _grow(rows: DataFrame, weighed: Callable, shape: tuple[int, int], columns: list[int], s: Settings,
          unit: float) -> Leaf | None:
    root = Leaf(0, _histograms(rows, weighed, [[]], shape, unit)[0], [])
    if not root.sums[2].any():
        return None
    _choose(root, columns, s)
    leaves = [root]
    while len(leaves) < s.leaves:
        best = max((x for x in leaves if x.split), key=lambda x: x.split[0], default=None)
        if best is None:
            break
        if best.counted is None:
            # One pass for all leaves that may be split next, not just for the best.
            waiting = [x for x in leaves if x.split and x.counted is None]
            sides = []
            for x in waiting:
                _, column, last = x.split
                n = x.sums[2, column]
                sides.append(0 if 2 * n[:last + 1].sum() <= n.sum() else 1)
            smaller = _histograms(rows, weighed, [x.path + [_side(x, k)] for x, k in zip(waiting, sides)], shape, unit)
            for x, k, sums in zip(waiting, sides, smaller):
                x.counted = [sums, x.sums - sums][::-1 if k else 1]
        best.children = [Leaf(best.depth + 1, sums, best.path + [_side(best, k)]) for k, sums in enumerate(best.counted)]
        for child in best.children:
            _choose(child, columns, s)
        at = leaves.index(best)
        leaves[at:at + 1] = best.children
    for leaf in leaves:
        g, h = float(leaf.sums[0, 0].sum()), float(leaf.sums[1, 0].sum())
        leaf.value = -s.rate * math.copysign(max(abs(g) - s.l1, 0.0), g) / max(h + s.l2, 1e-300)
    return root


def _side(leaf: Leaf, side: int) -> tuple[int, int, int]:
    _, column, last = leaf.split
    return column, last, side


def _plain(tree: Leaf) -> tuple | float:
    """What tasks need of a tree: (column, last bin on the left, left, right) or a leaf's value."""
    return (*tree.split[1:], *map(_plain, tree.children)) if tree.children else tree.value


def _add_tree(tree: tuple | float, bins: np.ndarray, on: np.ndarray, margin: np.ndarray) -> None:
    """Add the tree's values to the margins of the rows ``on``."""
    if not isinstance(tree, tuple):
        margin[on] += tree
        return
    column, last, left, right = tree
    low = bins[column, on] <= last
    _add_tree(left, bins, on[low], margin)
    _add_tree(right, bins, on[~low], margin)


def _whole(x: np.ndarray) -> np.ndarray:
    return np.trunc(x + np.copysign(0.5, x)).astype(np.int64)


def _blocks(rows: DataFrame, trees: list, base: float, columns: int, width: int) -> DataFrame:
    """``rows`` (seen, y, bins) packed into rows of arrays, with their margins after ``trees``."""
    kind = np.uint8 if width <= 256 else np.int32

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed():
            bins = np.concatenate([_slots(x, columns).astype(kind) for x in waiting], axis=1)
            seen, y = (np.concatenate([x.column(c).to_numpy() for x in waiting]) for c in ("seen", "y"))
            margin = np.full(len(y), base)
            for tree in trees:
                _add_tree(tree, bins, np.arange(len(y)), margin)
            return pa.RecordBatch.from_arrays(
                [pa.array([x.tobytes()], pa.binary()) for x in (seen, y, margin, bins)], ["seen", "y", "margin", "bins"])

        waiting, n = [], 0
        for batch in batches:
            waiting.append(batch)
            n += batch.num_rows
            if n >= BLOCK:
                yield packed()
                waiting, n = [], 0
        if n:
            yield packed()

    return rows.mapInArrow(pack, "seen binary, y binary, margin binary, bins binary")


def _logistic(trees: list, bit: int, columns: int, width: int, unit: float) -> Callable:
    """Gradients and second derivatives of the logistic loss after ``trees``, in steps of
    1 / ``unit``, of the rows of blocks that have the bit."""
    kind = np.uint8 if width <= 256 else np.int32

    def weighed(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for row in range(batch.num_rows):
            seen, y, margin, bins = (np.frombuffer(batch.column(name)[row].as_buffer(), of) for name, of in (
                ("seen", np.int32), ("y", np.float64), ("margin", np.float64), ("bins", kind)))
            on = np.flatnonzero(seen >> bit & 1)
            bins, y, margin = bins.reshape(columns, -1)[:, on], y[on], margin[on]
            for tree in trees:
                _add_tree(tree, bins, np.arange(len(y)), margin)
            with np.errstate(over="ignore"):
                p = 1 / (1 + np.exp(-margin))
            yield bins, _whole((p - y) * unit), _whole(p * (1 - p) * unit)
    return weighed


def fit_leafwise(df: DataFrame, features: Sequence[str], label: str, row_id: str, **settings) -> Boosted:
    """Boosted trees with logistic loss; see ``Settings`` for what may be given.

    ``row_id`` decides which rows a tree sees when ``rows_share`` is below 1.
    """
    s = Settings(**settings)
    known = df.filter(F.col(label).isNotNull())
    model = Boosted(features, bin_borders(known, features, s.bins), s)
    rows = stored(binned(known, features, model.cuts, {
        "draw": F.xxhash64(F.col(row_id)), "y": F.col(label).cast("double")}))
    n, ones = rows.agg(F.count(F.lit(1)), F.sum("y")).first()
    if not n:
        return model
    share = min(max(ones / n, 1e-12), 1 - 1e-12)
    model.base = math.log(share / (1 - share))
    unit = float(2 ** min(30, 61 - n.bit_length()))  # sums of whole numbers stay in 64 bits
    shape = (len(features), max(map(len, model.cuts), default=0) + 2)
    grown, written = [], 0
    for number in range(s.trees):
        if number % WRITTEN_EACH == 0:
            # One bit per tree to come: whether it sees the row.
            seen = [F.pmod(F.xxhash64("draw", F.lit(s.seed), F.lit(t)), F.lit(1 << 20)) < int(s.rows_share * (1 << 20))
                    for t in range(number, number + WRITTEN_EACH)]
            bits = sum(((F.lit(True) if s.rows_share >= 1 else x).cast("int") * (1 << i) for i, x in enumerate(seen)), F.lit(0))
            blocks = stored(_blocks(rows.select(bits.alias("seen"), "y", "bins"), list(grown), model.base, *shape))
            written = len(grown)
        some = max(1, round(s.columns_share * len(features)))
        columns = sorted(random.Random(f"{s.seed}:{number}").sample(range(len(features)), some))
        weighed = _logistic(grown[written:], number % WRITTEN_EACH, *shape, unit)
        tree = _grow(blocks, weighed, shape, columns, s, unit)
        if tree is None:
            continue
        model.trees.append(tree)
        grown.append(_plain(tree))
    return model


def root_gains(df: DataFrame, features: Sequence[str], label: str, **settings) -> DataFrame:
    """feature, border, gain of every split the first tree may begin with."""
    s = Settings(**settings)
    known = df.filter(F.col(label).isNotNull())
    cuts = bin_borders(known, features, s.bins)
    y = F.col(label).cast("double")
    n, ones = known.agg(F.count(F.lit(1)), F.sum(y)).first()
    schema = "feature string, border double, gain double"
    if not n:
        return df.sparkSession.createDataFrame([], schema)
    unit, p = float(2 ** min(30, 61 - n.bit_length())), ones / n
    rows = binned(known, features, cuts, {"y": y}).select("bins", *[
        F.round(x * unit).cast("long").alias(c) for c, x in (("g", p - F.col("y")), ("h", F.lit(p * (1 - p))))])
    shape = (len(features), max(map(len, cuts)) + 2)

    def weighed(batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        return [(_slots(batch, shape[0]), batch.column("g").to_numpy(), batch.column("h").to_numpy())]

    gains = split_gains(_histograms(rows, weighed, [[]], shape, unit)[0], s)
    listed = [(f, own[b - 1], float(gains[i, b])) for i, (f, own) in enumerate(zip(features, cuts))
              for b in range(1, len(own) + 1) if np.isfinite(gains[i, b])]
    return df.sparkSession.createDataFrame(listed, schema)
