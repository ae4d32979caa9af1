"""Canonical orders, line numbers and global row numbers without a one-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..session import checkpointed


def text_key(column: str) -> Column:
    """Order by text; a present null sorts as the word ``None``."""
    return F.coalesce(F.col(column).cast("string"), F.lit("None"))


def release_order(table: str) -> list[Column]:
    """Canonical order of one release table."""
    return [text_key(c) for c in fixed.RELEASE_TABLES[table][1]]


def nulls_first_order(columns: Sequence[str]) -> list[Column]:
    """Order by text with null before every value (provenance order)."""
    return [F.col(c).cast("string").asc_nulls_first() for c in columns]


def empty_for_null_order(columns: Sequence[str]) -> list[Column]:
    """Order by text with null as the empty string (observation order)."""
    return [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]


PROVENANCE_ORDER = [
    "artifact_id", "puzzle_id", "source_role", "source_id", "source_revision", "source_path",
    "source_object_id", "source_url", "author", "retrieved_at", "rights_status", "observed_sha256",
    "source_evidence_sha256", "source_evidence_byte_length", "claimed_cost", "claimed_cycles",
    "claimed_area", "claimed_instructions",
]
OBSERVATION_ORDER = [
    "puzzle_id", "artifact_id", "source_id", "source_revision", "source_path", "source_role",
    "associated_artifact_path", "source_declared_puzzle_id", "source_object_id", "observation_id",
]


def number_in_buckets(df: DataFrame, bucket: Column, order: Sequence[Column], name: str = "row_no") -> DataFrame:
    """1-based row number over (bucket, order), numbered bucket by bucket.

    ``bucket`` must be a value whose order agrees with the row order and whose
    groups are bounded (a file block, a fixed-width key range).  Only the list
    of bucket sizes is numbered in one place; rows are numbered inside buckets.
    """
    tagged = df.withColumn("_bucket", bucket)
    sizes = tagged.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_bucket").orderBy(*order)
    return (
        tagged.withColumn("_pos", F.row_number().over(inside))
        .join(offsets, "_bucket")
        .withColumn(name, F.col("_before") + F.col("_pos"))
        .drop("_bucket", "_pos", "_before")
    )


def _ranged(df: DataFrame, names: Sequence[str], partitions: int | None) -> DataFrame:
    """Rows range-partitioned and sorted on ``names``, written once, with their partition number.

    The full order is the partitioning key, so a crowded leading key is split.
    Range bounds come from a sample, hence the single written copy: every later
    step sees the same partitions, also after a lost executor.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(n, *names)
        .sortWithinPartitions(*names)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    return checkpointed(placed)


def global_row_number(
    df: DataFrame, order: Sequence[Column], name: str = "row_no", partitions: int | None = None
) -> DataFrame:
    """1-based position in a total order given by ``order``, which should end in a unique column.

    Positions inside partitions need only the sizes of the earlier partitions.
    """
    names = [f"_o{i}" for i in range(len(order))]
    keyed = df.select("*", *[c.alias(n) for c, n in zip(order, names, strict=True)])
    placed = _ranged(keyed, names, partitions).drop(*names)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # At most one row per partition, so the broadcast is bounded by their number.
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_pos") + 1)
        .drop("_part", "_pos", "_before")
    )


def running_before(
    df: DataFrame, group: str, order: str, value: str, name: str, fold=F.min, partitions: int | None = None
) -> DataFrame:
    """Add ``fold`` (min or sum) of ``value`` over the rows of the group that come earlier in ``order``.

    (group, order) must be unique; the first row of a group gets null.  Groups are
    cut by range partitions; each piece is folded on its own, and a group that
    spans partitions carries the fold of its earlier pieces, so no group has to
    fit in one task.
    """
    # A struct is never null, so rows without a group are a group like any other.
    keyed = df.withColumn("_group", F.struct(F.col(group).alias("v")))
    group = "_group"
    placed = _ranged(keyed, [group, order], partitions)
    pieces = placed.groupBy("_part", group).agg(fold(value).alias("_piece"))
    # Only the first and last group of a partition can continue elsewhere.
    edges = placed.groupBy("_part").agg(F.min(group).alias("_first"), F.max(group).alias("_last"))
    shared = edges.select(F.explode(F.array("_first", "_last")).alias(group)).distinct()
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # At most two groups per partition survive here, so both broadcasts are bounded.
    carried = pieces.join(F.broadcast(shared), group).withColumn("_carry", fold("_piece").over(earlier)).select(
        "_part", group, "_carry"
    ).where("_carry IS NOT NULL")
    inside = Window.partitionBy("_part", group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    joined = placed.withColumn("_own", fold(value).over(inside)).join(F.broadcast(carried), ["_part", group], "left")
    both = F.least("_own", "_carry") if fold is F.min else F.col("_own") + F.col("_carry")
    return joined.withColumn(name, F.coalesce(both, "_own", "_carry")).select(*df.columns, name)


def sequence_violations(df: DataFrame, row_no: str, observed: Column, expected: Column) -> DataFrame:
    """Rows whose value is not the one their position demands."""
    return df.select(
        F.col(row_no), expected.alias("expected"), observed.alias("observed")
    ).where(~F.col("expected").eqNullSafe(F.col("observed")))


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, line_no, line) of text files, numbered per file.

    A file is read in blocks by many tasks.  Inside one block the reader's own
    row counter is dense, so a line's number is its place in the block plus the
    line counts of the file's earlier blocks.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
        F.col("value").alias("line"),
    )
    blocks = raw.groupBy("path", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "path", "_block", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    return raw.join(offsets, ["path", "_block"]).select(
        "path", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line_no"), "line"
    )
