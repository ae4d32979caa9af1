"""Candidates to exact-byte artifacts and provenance rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.canonical import artifact_id, lookup, object_key, rights_rank
from .checks import dependency_violations, union_all, violations_where
from .ordering import PROVENANCE_ORDER

RECEIPT = (
    "struct<source_id:string,revision:string,upstream_path:string,sha256:string,"
    "byte_length:bigint,rights_status:string,retrieved_at:string>"
)
CANDIDATE = (
    "artifact_kind string, puzzle_id string, artifact_format string, "
    f"artifact_receipt {RECEIPT}, evidence_receipt {RECEIPT}, source_object_id string, "
    "source_url string, author string, claimed_cost bigint, claimed_cycles bigint, "
    "claimed_area bigint, claimed_instructions bigint"
)
CLAIMS = ["claimed_cost", "claimed_cycles", "claimed_area", "claimed_instructions"]


@dataclass(frozen=True)
class Ingested:
    artifacts: DataFrame
    provenance: DataFrame
    violations: DataFrame


def folded_rights(rights: Column) -> Column:
    """The most restrictive rights of a group of copies.

    Only the numeric rank is aggregated; its name is looked up afterwards.
    """
    return lookup(F.max(rights_rank(rights)), {rank: name for name, rank in fixed.RIGHTS_RANK.items()})


def provenance_rows(candidates: DataFrame) -> DataFrame:
    """One artifact row per candidate, and an evidence row when evidence is another receipt.

    Claims, link and author go to the evidence row when there is one.  The result
    is a set: full-row distinct.
    """
    artifact = F.col("artifact_receipt")
    evidence = F.coalesce(F.col("evidence_receipt"), artifact)
    same = evidence == artifact
    own_id = artifact_id(F.col("artifact_kind"), artifact["sha256"])

    def row(role: str, receipt: Column, carries_claims: Column) -> Column:
        def kept(name: str) -> Column:
            return F.when(carries_claims, F.col(name)).alias(name)

        return F.struct(
            own_id.alias("artifact_id"),
            F.col("puzzle_id"),
            F.lit(role).alias("source_role"),
            receipt["source_id"].alias("source_id"),
            receipt["revision"].alias("source_revision"),
            receipt["upstream_path"].alias("source_path"),
            kept("source_object_id"),
            kept("source_url"),
            kept("author"),
            receipt["retrieved_at"].alias("retrieved_at"),
            receipt["rights_status"].alias("rights_status"),
            artifact["sha256"].alias("observed_sha256"),
            receipt["sha256"].alias("source_evidence_sha256"),
            receipt["byte_length"].alias("source_evidence_byte_length"),
            *[kept(c) for c in CLAIMS],
        )

    rows = F.array_compact(
        F.array(row("artifact", artifact, same), F.when(~same, row("evidence", evidence, F.lit(True))))
    )
    return candidates.select(F.explode(rows).alias("r")).select("r.*").distinct()


def exact_dedup(candidates: DataFrame) -> DataFrame:
    """One artifact per (kind, sha256) with folded rights and the number of copies."""
    receipt = "artifact_receipt"
    return (
        candidates.groupBy("artifact_kind", F.col(f"{receipt}.sha256").alias("sha256"))
        .agg(
            F.min("puzzle_id").alias("puzzle_id"),
            F.min(f"{receipt}.byte_length").alias("byte_length"),
            F.min("artifact_format").alias("artifact_format"),
            folded_rights(F.col(f"{receipt}.rights_status")).alias("rights_status"),
            F.count(F.lit(1)).alias("copies"),
        )
        .withColumn("artifact_id", artifact_id(F.col("artifact_kind"), F.col("sha256")))
        .withColumn("object_key", object_key(F.col("sha256")))
    )


def candidate_violations(candidates: DataFrame, objects: DataFrame | None = None) -> DataFrame:
    """Everything that makes a set of candidates ambiguous or unsupported."""
    evidence = F.coalesce(F.col("evidence_receipt"), F.col("artifact_receipt"))
    flat = candidates.select(
        "*",
        evidence.alias("e"),
        artifact_id(F.col("artifact_kind"), F.col("artifact_receipt.sha256")).alias("artifact_id"),
    )
    flat = flat.select(
        "*",
        *[F.col(f"artifact_receipt.{f}").alias(f"a_{f}") for f in ("source_id", "revision", "upstream_path", "sha256", "byte_length")],
        *[F.col(f"e.{f}").alias(f"e_{f}") for f in ("source_id", "revision", "upstream_path")],
    )
    key = F.coalesce(F.col("artifact_id"), F.col("a_upstream_path"))
    known_rights = list(fixed.RIGHTS_RANK)
    same_key = (
        (F.col("a_source_id") == F.col("e_source_id"))
        & (F.col("a_revision") == F.col("e_revision"))
        & (F.col("a_upstream_path") == F.col("e_upstream_path"))
    )
    path = "candidates"
    found = [
        violations_where(flat, F.col("artifact_id").isNull(), "unsupported_kind", F.col("artifact_kind"), path, key),
        violations_where(
            flat,
            ~F.coalesce(F.col("artifact_receipt.rights_status").isin(known_rights), F.lit(False))
            | ~F.coalesce(F.col("e.rights_status").isin(known_rights), F.lit(False)),
            "invalid_rights", "rights status is not known", path, key,
        ),
        violations_where(
            flat,
            (F.col("e_source_id") != F.col("a_source_id")) | (F.col("e_revision") != F.col("a_revision")),
            "evidence_source_mismatch", "evidence must share source and revision", path, key,
        ),
        violations_where(
            flat, same_key & ~F.col("e").eqNullSafe(F.col("artifact_receipt")),
            "receipt_conflict", "one receipt identity has conflicting facts", path, key,
        ),
        # Copies of the same bytes must agree on what they are.
        dependency_violations(
            flat, ["artifact_kind", "a_sha256"], ["puzzle_id", "artifact_format", "a_byte_length"],
            "artifact_conflict", path,
        ),
        # One landed file stands for one artifact ...
        dependency_violations(
            flat, ["a_source_id", "a_revision", "a_upstream_path"],
            ["artifact_kind", "puzzle_id", "artifact_format", "a_sha256", "a_byte_length"],
            "association_conflict", path,
        ),
        # ... and one evidence assertion supports one artifact.
        dependency_violations(
            flat, ["e_source_id", "e_revision", "e_upstream_path", "source_object_id"], ["artifact_id"],
            "evidence_conflict", path,
        ),
    ]
    if objects is not None:
        receipts = flat.select(F.explode(F.array("artifact_receipt", "e")).alias("r")).select(
            "r.sha256", "r.byte_length"
        )
        found.append(object_violations(receipts, objects))
    return union_all(found)


def object_violations(receipts: DataFrame, objects: DataFrame) -> DataFrame:
    """Receipts whose stored object is missing, short or corrupt.

    ``objects`` has (object_key, byte_length, sha256) where both facts were
    measured on the stored bytes.
    """
    wanted = (
        receipts.select("sha256", "byte_length").distinct().withColumn("object_key", object_key(F.col("sha256")))
    )
    stored = objects.select(
        "object_key", F.col("byte_length").alias("stored_length"), F.col("sha256").alias("stored_sha256")
    )
    joined = wanted.join(stored, "object_key", "left")
    code = (
        F.when(F.col("stored_sha256").isNull(), "object_missing")
        .when(F.col("stored_length") != F.col("byte_length"), "object_length_mismatch")
        .when(F.col("stored_sha256") != F.col("sha256"), "object_corrupt")
    )
    return joined.withColumn("code", code).where(F.col("code").isNotNull()).select(
        "code", F.concat(F.lit("object "), F.col("object_key")).alias("detail"),
        F.lit("objects").alias("path"), F.col("sha256").alias("row_key"),
    )


def ingest_artifacts(candidates: DataFrame, objects: DataFrame | None = None) -> Ingested:
    """Artifacts, provenance and the violations that must be empty before use."""
    artifacts = exact_dedup(candidates).select(
        "artifact_kind", "artifact_id", "puzzle_id", "sha256", "byte_length", "artifact_format",
        "rights_status", "object_key",
    )
    provenance = provenance_rows(candidates).select(*PROVENANCE_ORDER)
    return Ingested(artifacts, provenance, candidate_violations(candidates, objects))
