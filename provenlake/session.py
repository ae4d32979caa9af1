"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on.  Joins carry no broadcast hints on data whose
# size is not fixed: the auto-broadcast threshold is the size check, AQE applies
# it again on measured sizes, and its skew-join rule splits hot keys.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # The JVM never compiles methods of more bytecode; plans beyond it run faster in split projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Turn on the adaptive and code generation settings in a session that was made elsewhere."""
    for key, value in SESSION_CONF.items():
        if key.startswith(("spark.sql.adaptive.", "spark.sql.codegen.")):
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "provenlake") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("PROVENLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.extraJavaOptions", "-Duser.timezone=UTC")
    )
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt to as many tasks as a shuffle has, by a key.

    For narrow rows before work that costs far more than their shuffle: a table of many
    small rows may be one file split, and then all that follows would run in one task.
    """
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(tasks, *keys)


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder shared by all executors, from ``spark.checkpoint.dir``.

    A temporary folder is used only on a local master, where driver and
    executors are one process.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current:
        return current
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="spark-checkpoint-", dir="/tmp")
    context.setCheckpointDir(configured)
    return configured


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def settled(*frames: DataFrame) -> list[DataFrame]:
    """A stage boundary: every table written once, plans restart from the files."""
    return [checkpointed(df) for df in frames]


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    Unlike a checkpoint the result has a measured size, so a small one is broadcast by
    Spark's own threshold without shuffling what it is joined with.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/stored-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
