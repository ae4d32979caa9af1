"""Intermediate tables in the folder that the cluster shares, and bounded Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir

#: Rows of text that one Arrow batch carries; with ``BATCH_BYTES`` it bounds a Python worker's memory.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20


def folder(spark: SparkSession) -> str:
    """Folder of this application's staged tables, below ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/staged-{spark.sparkContext.applicationId}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    Cuts the lineage: a lost executor repeats only what reads the files.  Unlike
    a checkpoint the files are columnar, so later steps read only their columns.
    """
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    while name in df.columns:
        name = "_" + name
    return name


def release(spark: SparkSession) -> None:
    """Delete every staged table of this application (results that read them must be written before)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session for tables whose rows carry whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def slices(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about ``limit`` bytes of ``column`` each (a longer text is a piece of its own)."""
    start = size = 0
    lengths = pa.compute.binary_length(batch.column(column)).to_pylist()
    for i, n in enumerate(lengths):
        if i > start and size + (n or 0) > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n or 0
    if batch.num_rows > start:
        yield batch.slice(start)


def map_texts(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str, column: str = "text",
    limit: int = BATCH_BYTES,
) -> DataFrame:
    """Map bounded Arrow batches; ``make`` runs once per task and returns the batch function."""
    small_batches(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            for part in slices(batch, column, limit):
                yield apply(part)

    return df.mapInArrow(run, schema)
