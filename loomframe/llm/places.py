"""Places of rows in sorted groups of any size, by range partitions.

All rows are range-partitioned and sorted by group and order, so a large group lies in many
partitions. A row's number in its partition, less that of the group's first row there, plus
the group's rows in earlier partitions, is its place in the group. The earlier rows come
from a table with one row per partition and group. Rows with equal keys lie in one
partition, so the order columns must tell apart whatever may repeat often (``unrolled``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomframe.llm.shared import stored

#: Rows a range partition holds at most, about.
ROWS_EACH = 500_000


def unrolled(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of the columns, with a number ``copy`` that tells equal ones apart."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    return stored(counts).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies")


def sorted_parts(df: DataFrame, group: list[str], order: list[str],
                 rows_each: int = ROWS_EACH) -> tuple[DataFrame, DataFrame]:
    """The rows with ``part`` and ``at``, and the pieces that the partitions hold of groups.

    A piece has ``part``, the group's columns, ``rows``, ``shift`` (what, added to ``at``,
    gives the place in the group, from 0) and ``size`` (rows of the group).
    """
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(wanted, -(-df.count() // rows_each))
    keys = [*group, *order]
    # The id is the partition's number and, in the low 33 bits, the row's number in it.
    ranged = stored(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                    .withColumn("at", F.monotonically_increasing_id())
                    .withColumn("part", F.shiftright("at", 33)))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = ranged.groupBy("part", *group).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    return ranged, stored(pieces.select(
        "part", *group, "rows", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(whole).alias("size")))


def join_pieces(ranged: DataFrame, pieces: DataFrame, group: list[str]) -> DataFrame:
    """The rows with the columns of their piece; a join key has one partition's rows at most."""
    other = pieces.withColumnsRenamed({c: f"_{c}" for c in ["part", *group]})
    same = [ranged["part"] == other["_part"], *[ranged[c].eqNullSafe(other[f"_{c}"]) for c in group]]
    return ranged.join(other, reduce(lambda a, b: a & b, same)).drop("_part", *[f"_{c}" for c in group])


def ranked(df: DataFrame, *order: str) -> DataFrame:
    """All rows as one group: with ``place`` and ``places``, the number of rows."""
    ranged, pieces = sorted_parts(df.withColumn("_all", F.lit(0)), ["_all"], list(order))
    joined = join_pieces(ranged, pieces, ["_all"])
    return joined.select(*df.columns, (F.col("at") + F.col("shift")).alias("place"), F.col("size").alias("places"))
