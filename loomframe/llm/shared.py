"""What the operators share: reading tables, writing once, files that executors write."""

from __future__ import annotations

import contextlib
import os
import pathlib
import uuid
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.session import checkpoint_dir, prepare, stored  # noqa: F401

Batches = Iterable[pa.RecordBatch]


#: Where this package lies; workers on machines without it need it through ``--py-files``.
ROOT = str(pathlib.Path(__file__).resolve().parents[2])


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where the driver does, and set sane plans."""
    environment = spark.sparkContext.environment
    if ROOT not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(
            x for x in (ROOT, environment.get("PYTHONPATH")) if x)
    return prepare(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, **columns: str) -> DataFrame:
    """Just the named columns (new name = column), whatever else the input has."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def map_batches(df: DataFrame, function: Callable[[Batches], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    return df.mapInArrow(function, schema)


def new_folder(spark: SparkSession, kind: str) -> str:
    """An unused folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def dealt(df: DataFrame, rows_each: int, *columns: str) -> DataFrame:
    """Hash-partition by columns into a number of parts that follows the row count."""
    n = max(1, -(-df.count() // rows_each))
    return df.repartition(n, *[F.col(c) for c in columns])


def _local(path: str) -> str | None:
    parsed = urlparse(path)
    return unquote(parsed.path) if parsed.scheme in ("", "file") else None


@contextlib.contextmanager
def open_new(path: str):
    """A binary file to write, in any store that pyarrow knows; whole or not there at all."""
    local = _local(path)
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        part = f"{local}.{uuid.uuid4().hex}.part"
        with open(part, "wb") as out:
            yield out
        os.replace(part, local)
    else:
        from pyarrow import fs
        store, inner = fs.FileSystem.from_uri(path)
        store.create_dir(os.path.dirname(inner), recursive=True)
        with store.open_output_stream(inner) as out:
            yield out


def open_old(path: str):
    """A binary file to read, with ``read`` and ``seek``."""
    local = _local(path)
    if local is not None:
        return open(local, "rb")
    from pyarrow import fs
    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)
