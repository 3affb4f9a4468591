"""Writers, stored stages and SQL text with bound arguments."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def run_sql(spark: SparkSession, text: str, args: Mapping | None = None, **frames) -> DataFrame:
    """SQL with named arguments bound as values, never pasted into the text;
    frames are referred to as ``{name}``."""
    return spark.sql(text, args=dict(args or {}), **frames)


def save_table(df: DataFrame, name: str, mode: str = "refresh", path: str | None = None) -> None:
    """``refresh`` replaces the rows, ``create`` fails if it exists, ``append`` adds.

    With a path the table lives there instead of in the warehouse folder.
    """
    how = {"refresh": "overwrite", "create": "errorifexists", "append": "append"}[mode]
    writer = df.write.mode(how).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a complete stage is there: its writer leaves a success mark."""
    jvm = spark.sparkContext._jvm
    mark = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def stage(spark: SparkSession, build: Callable[[], DataFrame], name: str, folder: str,
          refresh: bool = False) -> DataFrame:
    """Read a stored stage, or build, store and read it; a failed write is redone."""
    path = f"{folder}/{name}"
    if refresh or not _exists(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stages(spark: SparkSession, builders: Mapping[str, Callable[[DataFrame | None], DataFrame]],
           folder: str, refresh: bool = False) -> DataFrame:
    """A chain of stages: resume after the last stored one; refresh redoes all."""
    names = list(builders)
    start = 0
    if not refresh:
        start = max((i + 1 for i, n in enumerate(names) if _exists(spark, f"{folder}/{n}")),
                    default=0)
    df = spark.read.parquet(f"{folder}/{names[start - 1]}") if start else None
    for name in names[start:]:
        before = df
        df = stage(spark, lambda n=name, d=before: builders[n](d), name, folder, refresh=True)
    return df


def _flat(df: DataFrame) -> DataFrame:
    """Text form of maps, arrays and structs, which delimited files cannot hold."""
    nested = [f.name for f in df.schema
              if isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType))]
    return df.withColumns({c: F.to_json(c) for c in nested}) if nested else df


def append_results(df: DataFrame, path: str) -> None:
    """Add rows to a tab-separated log; every file of it starts with the header."""
    _flat(df).write.mode("append").csv(path, sep="\t", header=True)


def save_scores(scores: DataFrame, path: str) -> None:
    """Nested scores as JSON lines."""
    scores.write.mode("overwrite").json(path)


def save_matrix(counts: DataFrame, y: str, yhat: str, classes: list, path: str) -> None:
    """Confusion counts as a delimited matrix, one line per true class."""
    wide = counts.groupBy(y).pivot(yhat, classes).agg(F.sum("count")).na.fill(0)
    wide.orderBy(y).write.mode("overwrite").csv(path, sep=" ", header=True)


def save_submission(df: DataFrame, path: str) -> None:
    df.select("order_id", "products").write.mode("overwrite").csv(path, header=True)
