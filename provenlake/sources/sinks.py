"""Sinks: release Parquet, canonical JSON lines, views, manifests and receipt appends."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.canonical import canonical_json
from ..operators.checks import assert_clean, violations_where
from ..operators.ordering import release_order
from ..session import settled
from .tables import encode_for_parquet, row_json

FACTS = ["source_id", "revision", "upstream_path", "sha256", "byte_length", "rights_status"]


def _ordered(df: DataFrame, order, shards: int | None) -> DataFrame:
    """Rows in order over ``shards`` ranges; without a number as many as the session's shuffles, joined to sized ones by AQE."""
    keyed = df.select("*", *[c.alias(f"_o{i}") for i, c in enumerate(order)])
    names = [f"_o{i}" for i in range(len(order))]
    placed = keyed.repartitionByRange(shards, *names) if shards else keyed.repartitionByRange(*names)
    return placed.sortWithinPartitions(*names).drop(*names)


def _rename_parts(spark: SparkSession, folder: str, name: str) -> list[str]:
    """Give committed part files their shard names, in partition order."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName().startswith("part-"))
    named = []
    for i, part in enumerate(parts):
        target = name.format(i=i, n=len(parts))
        fs.rename(jvm.org.apache.hadoop.fs.Path(path, part), jvm.org.apache.hadoop.fs.Path(path, target))
        named.append(target)
    return named


def write_release_parquet(df: DataFrame, table: str, folder: str, split: str, shards: int | None = None) -> list[str]:
    """Write one release table in canonical order: zstd, shards ``<split>-00000-of-0000n.parquet``.

    Rows are range-partitioned on the canonical key, so every shard is a
    contiguous, sorted slice and row-group statistics stay tight.
    """
    target = f"{folder}/data/{table}"
    _ordered(encode_for_parquet(df, table), release_order(table), shards).write.mode("errorifexists").option(
        "compression", "zstd"
    ).parquet(target)
    names = _rename_parts(df.sparkSession, target, split + "-{i:05d}-of-{n:05d}.parquet")
    return [f"data/{table}/{name}" for name in names]


def write_release_lines(tables: dict[str, DataFrame], folder: str, shards: int | None = None) -> None:
    """Write the four release inputs as canonical JSON lines in canonical order."""
    if set(tables) != set(fixed.RELEASE_TABLES):
        raise ValueError(f"release tables must be exactly {sorted(fixed.RELEASE_TABLES)}")
    for table, df in tables.items():
        lines = _ordered(df.withColumn("_line", row_json(df, table)), release_order(table), shards)
        lines.select(F.col("_line").alias("value")).write.mode("errorifexists").text(f"{folder}/{table}.jsonl")


def write_views(views: DataFrame, folder: str) -> None:
    """Write labelled view rows as one folder of JSON lines per view; an empty view is an empty file."""
    spark = views.sparkSession
    body = [c for c in views.columns if c != "view"]
    lines = views.select("view", canonical_json(views, body).alias("value"), "puzzle_id", "solution_id")
    # Key order inside each view; a view larger than one task spans several ordered files.
    ordered = lines.repartitionByRange("view", "puzzle_id", "solution_id").sortWithinPartitions(
        "view", "puzzle_id", "solution_id"
    )
    ordered.select("view", "value").write.mode("errorifexists").partitionBy("view").text(folder)
    present = {r["view"] for r in spark.read.text(folder).select("view").distinct().take(len(fixed.SOLUTION_VIEWS))} if (
        views.limit(1).count()
    ) else set()
    for view in fixed.SOLUTION_VIEWS:
        if view not in present:
            spark.createDataFrame([], "value string").coalesce(1).write.mode("append").text(f"{folder}/view={view}")


def write_json_record(spark: SparkSession, record: dict, path: str) -> None:
    """Write one small record as a JSON file with sorted keys."""
    text = json.dumps(record, sort_keys=True, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("errorifexists").text(path)


def read_json_record(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


# --- receipts --------------------------------------------------------------------------


def plan_receipt_append(existing: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(receipts to append, violations) for an idempotent append.

    The same key with the same facts is a no-op; with other facts it is an error.
    The time of retrieval is not a fact.  Both tables are compared in one
    aggregation on the receipt key.
    """
    key = ["source_id", "revision", "upstream_path"]
    facts = F.struct("sha256", "byte_length", "rights_status")
    both = existing.select(*FACTS, "retrieved_at", F.lit(0).alias("_new")).unionByName(
        incoming.select(*FACTS, "retrieved_at", F.lit(1).alias("_new"))
    )
    grouped = both.groupBy(*key).agg(
        F.min(facts).alias("lo"), F.max(facts).alias("hi"), F.min("_new").alias("_is_new"), F.max("_new").alias("_came"),
        F.min(F.when(F.col("_new") == 1, F.col("retrieved_at"))).alias("retrieved_at"),
    )
    changed = ~F.col("lo").eqNullSafe(F.col("hi"))
    fresh = grouped.where((F.col("_is_new") == 1) & ~changed).select(*key, "lo.*", "retrieved_at").select(
        *FACTS, "retrieved_at"
    )
    conflicts = violations_where(
        grouped, changed & (F.col("_came") == 1), "pinned_path_changed", F.to_json(F.struct("lo", "hi")), "receipts",
        F.concat_ws("\u001f", *key),
    )
    return fresh, conflicts


def append_receipts(spark: SparkSession, table_path: str, incoming: DataFrame) -> int:
    """Append new receipts to a Parquet table partitioned by source and revision; returns the number added.

    Only the partitions the batch names are read back.  The planned append is
    written to the checkpoint folder before the table is touched, so the count,
    the conflicts and the rows written are one result.  Refuses the batch when a
    pinned path changed.
    """
    schema = (
        "upstream_path string, sha256 string, byte_length bigint, rights_status string, retrieved_at string, "
        "source_id string, revision string"
    )
    path = spark._jvm.org.apache.hadoop.fs.Path(table_path)
    exists = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    existing = spark.read.schema(schema).parquet(table_path) if exists else spark.createDataFrame([], schema)
    named = incoming.select("source_id", "revision").distinct()
    # The join prunes the table's partitions at run time, whatever the number of those named.
    existing = existing.join(named, ["source_id", "revision"], "left_semi")
    fresh, conflicts = settled(*plan_receipt_append(existing, incoming))
    assert_clean(conflicts)
    fresh.write.mode("append").partitionBy("source_id", "revision").parquet(table_path)
    return fresh.count()
