"""Ordered work inside groups that may be arbitrarily large.

A window function sends a whole group to one task.  ``Ordered`` first counts
the groups (one map-side combined aggregate).  When every group is within the
row limit the plain window functions are used.  Otherwise only the groups above
the limit are cut along the order axis into pieces of about the limit, each
piece is worked on by itself, and what has to be known from the pieces before
or after it (sums, last values, ...) travels in a table with one row per piece.
"""

from __future__ import annotations

import itertools
import math
import os
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomframe.session import group_limit, stored

_names = itertools.count()
#: Bytes of a text key that make one number (exact as a double).
_TEXT_BYTES = 6


@dataclass(frozen=True)
class Scan:
    kind: str
    value: Column


def run_sum(value) -> Scan:
    """Sum from the first row to this one; nulls count as nothing."""
    return Scan("sum", F.coalesce(value, F.lit(0)))


def run_max(value) -> Scan:
    """Largest value from the first row to this one."""
    return Scan("max", value)


def max_before(value) -> Scan:
    """Largest value among the rows before this one."""
    return Scan("max_before", value)


def row_number() -> Scan:
    return Scan("sum", F.lit(1).cast("long"))


def previous(value) -> Scan:
    """The value on the row before; null on the first row."""
    return Scan("previous", value)


def last_known(value) -> Scan:
    """The nearest non-null value at or before this row."""
    return Scan("last_known", value)


def next_known(value) -> Scan:
    """The nearest non-null value at or after this row."""
    return Scan("next_known", value)


def first_row(value) -> Scan:
    """The value on the first row of the group."""
    return Scan("first_row", value)


def whole_sum(value) -> Scan:
    return Scan("whole_sum", value)


def whole_max(value) -> Scan:
    return Scan("whole_max", value)


def whole_min(value) -> Scan:
    return Scan("whole_min", value)


def whole_count() -> Scan:
    return Scan("whole_sum", F.lit(1).cast("long"))


def null_safe(left: DataFrame, right: DataFrame, pairs) -> Column:
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


#: Groups are first counted together in so many hashed parts.
HASHED = 1 << 16


def groups_fit(df: DataFrame, part: Sequence[str]) -> bool:
    """Whether no group has more rows than the limit.

    Rows of whole parts are counted first, which leaves few rows to shuffle; groups by
    themselves are only counted when a part is above the limit.
    """
    limit = group_limit(df.sparkSession)
    if not part:  # all rows are one group
        return df.count() <= limit
    parts = df.groupBy(F.pmod(F.xxhash64(*[F.col(p) for p in part]), F.lit(HASHED)).alias("_part")).agg(
        F.count(F.lit(1)).alias("_rows"))
    if parts.filter(F.col("_rows") > limit).isEmpty():
        return True
    return df.groupBy(*part).agg(F.count(F.lit(1)).alias("_rows")).filter(
        F.col("_rows") > limit).isEmpty()


class Ordered:
    """``df`` grouped by ``part`` and ordered by ``order`` (unique in a group)."""

    def __init__(self, df: DataFrame, part: Sequence[str], order: Sequence[str],
                 axis: Column | None = None, like: Ordered | None = None,
                 small: bool = False):
        """``like``: an earlier arrangement of the same groups, already counted.
        ``small``: a cheaper count has shown that no group is above the limit."""
        self.part, self.order = list(part), list(order)
        self.limit = group_limit(df.sparkSession)
        self.piece: str | None = None
        known = small or (like is not None and like.fits)
        self.df = df if known else self._cut(df, axis)

    @property
    def fits(self) -> bool:
        """Whether every group is within the limit, so plain windows are used."""
        return self.piece is None

    # -- cutting large groups -------------------------------------------------

    def _cut(self, df: DataFrame, axis: Column | None) -> DataFrame:
        if self.part and groups_fit(df, self.part):
            return df
        if self.part:
            # At most rows / limit groups can be above the limit.
            large = df.groupBy(*self.part).agg(F.count(F.lit(1)).alias("_rows")).filter(
                F.col("_rows") > self.limit)
            total = large.agg(F.sum("_rows")).first()[0]
        else:
            large, total = None, df.count()
        if not total or total <= self.limit:
            return df
        tag = f"_{next(_names)}"
        given = axis is not None
        axis = axis if given else _axis(df, self.order[0])
        work = df.withColumn(f"_axis{tag}", axis.cast("double"))
        if large is not None:
            names = {p: f"_p{i}{tag}" for i, p in enumerate(self.part)}
            keys = large.select(*[F.col(p).alias(n) for p, n in names.items()],
                                F.lit(True).alias(f"_large{tag}"))
            work = work.join(F.broadcast(keys), null_safe(work, keys, names.items()), "left")
            work = work.drop(*names.values())
        else:
            work = work.withColumn(f"_large{tag}", F.lit(True))
        rows = work.filter(F.col(f"_large{tag}"))
        points = self._points(rows, f"_axis{tag}", total)
        # A value that holds several quantiles gets a piece of its own, which the
        # next order column can cut further (doubles are exact below 2^53).
        heavy = sorted({p for p, q in itertools.pairwise(points) if p == q and abs(p) < 2 ** 53})
        cuts = sorted({*points, *(math.nextafter(v, math.inf) for v in heavy)})
        work = _bucketed(work, f"_axis{tag}", cuts, f"_b{tag}")
        # (A given axis may be coarser than the order column: not cut further.)
        text = not given and isinstance(df.schema[self.order[0]].dataType, (T.StringType, T.BinaryType))
        more = (len(self.order) > 1 or text) and bool(heavy) and not given
        # Texts that agree in the bytes looked at are cut by the next ones.
        second = (_axis(df, self.order[0], 1) if text else _axis(df, self.order[1])) if more else None
        if second is not None:
            tied = F.col(f"_large{tag}") & F.col(f"_axis{tag}").isin(*heavy)
            work = work.withColumn(f"_axis2{tag}", F.when(tied, second.cast("double")))
            ties = work.filter(tied)
            inner = sorted(set(self._points(ties, f"_axis2{tag}", ties.count())))
            work = _bucketed(work, f"_axis2{tag}", inner, f"_b2{tag}")
            work = work.withColumn(f"_b{tag}", F.col(f"_b{tag}") * (len(inner) + 3) + F.when(
                tied, F.col(f"_b2{tag}")).otherwise(0)).drop(f"_axis2{tag}", f"_b2{tag}")
        self.piece = f"_piece{tag}"
        work = work.withColumn(self.piece, F.when(
            F.col(f"_large{tag}"), F.col(f"_b{tag}")).otherwise(F.lit(0)))
        # The pieces are read twice (table per piece, rows): cut the lineage here.
        return stored(work.drop(f"_axis{tag}", f"_large{tag}", f"_b{tag}"))

    def _points(self, rows: DataFrame, axis: str, total: int) -> list[float]:
        """Approximate quantiles that leave about the limit between neighbours."""
        pieces = -(-total // self.limit)
        return sorted(rows.approxQuantile(
            axis, [i / pieces for i in range(1, pieces)], 1 / (4 * pieces)))

    # -- scans ----------------------------------------------------------------

    def scan(self, **scans: Scan) -> DataFrame:
        """Add one column per scan; the columns may not refer to one another."""
        if self.piece is None:
            return self.df.withColumns({
                name: self._local(scan) for name, scan in scans.items()})
        return self._scan_pieces(scans)

    def _window(self):
        keys = self.part + ([self.piece] if self.piece else [])
        base = Window.partitionBy(*keys) if keys else Window
        return base.orderBy(*self.order)

    def _local(self, scan: Scan) -> Column:
        w = self._window()
        to_here = w.rowsBetween(Window.unboundedPreceding, 0)
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        v = scan.value
        match scan.kind:
            case "sum":
                return F.sum(v).over(to_here)
            case "max":
                return F.max(v).over(to_here)
            case "max_before":
                return F.max(v).over(w.rowsBetween(Window.unboundedPreceding, -1))
            case "previous":
                return F.lag(v).over(w)
            case "last_known":
                return F.last(v, ignorenulls=True).over(to_here)
            case "next_known":
                return F.first(v, ignorenulls=True).over(
                    w.rowsBetween(0, Window.unboundedFollowing))
            case "first_row":
                return F.first(v).over(to_here)
            case "whole_sum":
                return F.sum(v).over(whole)
            case "whole_max":
                return F.max(v).over(whole)
            case "whole_min":
                return F.min(v).over(whole)
        raise ValueError(scan.kind)

    def _scan_pieces(self, scans: dict[str, Scan]) -> DataFrame:
        tag = f"_{next(_names)}"
        place = F.struct(*self.order)
        box = {name: F.struct(scan.value.alias("v")) for name, scan in scans.items()}
        per_piece, carry, combine = [], {}, {}
        parts = {p: f"_k{i}{tag}" for i, p in enumerate(self.part)}
        keyed = {**parts, self.piece: f"_piece{tag}"}
        over = Window.partitionBy(*parts.values()) if parts else Window
        before = over.orderBy(f"_piece{tag}").rowsBetween(Window.unboundedPreceding, -1)
        after = over.orderBy(f"_piece{tag}").rowsBetween(1, Window.unboundedFollowing)
        whole = over.orderBy(f"_piece{tag}").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)
        for name, scan in scans.items():
            v, c = scan.value, f"_{name}{tag}"
            known = F.when(v.isNotNull(), place)
            got = F.col(c)
            match scan.kind:
                case "sum":
                    agg, car = F.sum(v), F.sum(c).over(before)
                    out = F.coalesce(got, F.lit(0)) + self._local(scan)
                case "max" | "max_before":
                    agg, car = F.max(v), F.max(c).over(before)
                    out = F.greatest(got, self._local(scan))
                case "previous":
                    agg, car = F.max_by(box[name], place), F.last(c, True).over(before)
                    out = F.coalesce(F.lag(box[name]).over(self._window()), got)["v"]
                case "last_known":
                    agg, car = F.max_by(v, known), F.last(c, True).over(before)
                    out = F.coalesce(self._local(scan), got)
                case "next_known":
                    agg, car = F.min_by(v, known), F.first(c, True).over(after)
                    out = F.coalesce(self._local(scan), got)
                case "first_row":
                    agg, car = F.min_by(box[name], place), F.first(c, True).over(whole)
                    out = got["v"]
                case "whole_sum":
                    agg, car, out = F.sum(v), F.sum(c).over(whole), got
                case "whole_max":
                    agg, car, out = F.max(v), F.max(c).over(whole), got
                case "whole_min":
                    agg, car, out = F.min(v), F.min(c).over(whole), got
                case _:
                    raise ValueError(scan.kind)
            per_piece.append(agg.alias(c))
            carry[c] = car
            combine[name] = out
        table = self.df.groupBy(*[F.col(a).alias(b) for a, b in keyed.items()]).agg(*per_piece)
        # One row per piece, rows / limit in all.
        table = table.select(*keyed.values(), *[col.alias(c) for c, col in carry.items()])
        joined = self.df.join(table, null_safe(self.df, table, keyed.items()), "left")
        joined = joined.withColumns(combine)
        return joined.drop(*keyed.values(), *carry, self.piece)


def _bucketed(df: DataFrame, axis: str, cuts: list[float], out: str) -> DataFrame:
    """The interval of the axis value as a whole number from 1 on; 0 for null,
    since null order keys sort first."""
    if not cuts:
        return df.withColumn(out, F.lit(1))
    found = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol=axis, outputCol=out,
                       handleInvalid="keep").transform(df)
    return found.withColumn(out, F.coalesce(F.col(out).cast("int") + 1, F.lit(0)))


def _axis(df: DataFrame, name: str, level: int = 0) -> Column:
    """A number that rises with the order column; of texts, of the bytes of one level."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if isinstance(kind, T.BooleanType):
        return F.col(name).cast("int")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        data = F.col(name) if isinstance(kind, T.BinaryType) else F.encode(F.col(name), "UTF-8")
        low, high = df.agg(F.hex(F.min(data)), F.hex(F.max(data))).first()
        same = len(os.path.commonprefix([low or "", high or ""])) // 2
        part = F.substring(data, same + level * _TEXT_BYTES + 1, _TEXT_BYTES)
        return F.conv(F.rpad(F.hex(part), 2 * _TEXT_BYTES, "0"), 16, 10).cast("double")
    raise TypeError(f"give an axis for the order column {name} of type {kind.simpleString()}")
