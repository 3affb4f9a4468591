"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Session setting: a group with more rows than this is cut into pieces.
GROUP_LIMIT = "loomframe.groupRowLimit"
DEFAULT_GROUP_LIMIT = 2_000_000
#: Shuffled bytes of a task where the session sets nothing: the narrow rows here take
#: many times that in memory.
TASK_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
DEFAULT_TASK_BYTES = "16m"


def build_session(app: str = "loomframe", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings below; ``master`` is only given in tests."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings: one time zone, adaptive plans, skewed joins split, small tasks."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    if spark.conf.get(TASK_BYTES, None) is None:
        spark.conf.set(TASK_BYTES, DEFAULT_TASK_BYTES)
    return spark


def group_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(GROUP_LIMIT, str(DEFAULT_GROUP_LIMIT)))


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a scan with fewer splits than cores out to all cores.

    For work that costs much more than moving its input; large inputs have many
    splits and are left where they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage of a frame that several branches read; the files outlive
    lost executors and later reads keep column pruning and pushdown.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; make a folder only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="loomframe-checkpoint-")
    context.setCheckpointDir(shared)
    return context.getCheckpointDir()
