"""Driver tables and the roles they play in the registered queries.

documents = landed artifacts with exact copies (``source`` = source id, ``lang`` =
puzzle), customer = inventory, orders = solutions (status ``F`` = verified),
labels = verification facts, conversations = attempts, events = outcomes and
JSON claims.  Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ingest import RECEIPT

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with its SQL statement when it has one."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def source_number() -> Column:
    return F.regexp_extract("source", r"(\d+)$", 1).cast("int")


def document_rights() -> Column:
    """Rights of a document by its source."""
    n = source_number()
    return F.when(n < 7, "redistributable").when(n < 14, "unknown").otherwise("local_fetch_only")


RIGHTS_SQL = """CASE WHEN CAST(regexp_extract(source, '(\\d+)$', 1) AS INT) < 7 THEN 'redistributable'
     WHEN CAST(regexp_extract(source, '(\\d+)$', 1) AS INT) < 14 THEN 'unknown'
     ELSE 'local_fetch_only' END"""
RANK_SQL = """CASE WHEN CAST(regexp_extract(source, '(\\d+)$', 1) AS INT) < 7 THEN 0
     WHEN CAST(regexp_extract(source, '(\\d+)$', 1) AS INT) < 14 THEN 1 ELSE 2 END"""
FOLDED_SQL = f"""CASE max({RANK_SQL}) WHEN 0 THEN 'redistributable' WHEN 1 THEN 'unknown' ELSE 'local_fetch_only' END"""


def document_candidates(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Documents as artifact candidates; a label is the evidence receipt of its document."""
    digest = F.sha2("text", 256)
    receipt = F.struct(
        F.col("source").alias("source_id"),
        F.lit("r1").alias("revision"),
        F.concat(F.col("lang"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".solution")).alias("upstream_path"),
        digest.alias("sha256"),
        F.octet_length("text").cast("bigint").alias("byte_length"),
        document_rights().alias("rights_status"),
        F.lit("2026-01-01T00:00:00Z").alias("retrieved_at"),
    )
    if labels is None:
        rows = docs
        evidence = F.lit(None).cast(RECEIPT)
        cost = F.lit(None).cast("bigint")
    else:
        rows = docs.join(labels, "doc_id", "left")
        body = F.concat_ws(":", F.col("doc_id").cast("string"), F.col("quality").cast("string"), F.col("toxic").cast("string"))
        evidence = F.when(
            F.col("quality").isNotNull(),
            F.struct(
                F.col("source").alias("source_id"),
                F.lit("r1").alias("revision"),
                F.concat(F.col("lang"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".json")).alias("upstream_path"),
                F.sha2(body, 256).alias("sha256"),
                F.octet_length(body).cast("bigint").alias("byte_length"),
                document_rights().alias("rights_status"),
                F.lit("2026-01-02T00:00:00Z").alias("retrieved_at"),
            ),
        )
        cost = F.col("quality").cast("bigint")
    nothing = F.lit(None).cast("bigint")
    return rows.select(
        F.lit("solution").alias("artifact_kind"),
        F.col("lang").alias("puzzle_id"),
        F.lit("solution").alias("artifact_format"),
        receipt.alias("artifact_receipt"),
        evidence.alias("evidence_receipt"),
        F.lit(None).cast("string").alias("source_object_id"),
        F.lit(None).cast("string").alias("source_url"),
        F.lit(None).cast("string").alias("author"),
        cost.alias("claimed_cost"),
        nothing.alias("claimed_cycles"),
        nothing.alias("claimed_area"),
        nothing.alias("claimed_instructions"),
    )
