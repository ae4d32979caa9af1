"""Which inventory puzzles can be attempted, and with which exact artifact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.canonical import artifact_id, canonical_json, lookup
from ..session import stored
from .checks import missing_references, packed, union_all, unique_key_violations, violations_where
from .digest import published_sha256


def source_priority(source_id: Column) -> Column:
    return F.coalesce(lookup(source_id, fixed.SOURCE_PRIORITY), F.lit(fixed.OTHER_SOURCE_PRIORITY))


def select_by_priority(candidates: DataFrame, group: str, key: str, source: str, carry: list[str]) -> DataFrame:
    """Per group the row with the best source, ties to the lowest key.

    One combined minimum of (priority, key, carried columns): nothing is sorted
    and a hot group is reduced before it is shuffled.
    """
    best = F.min(F.struct(source_priority(F.col(source)).alias("priority"), F.col(key), *carry))
    return candidates.groupBy(group).agg(best.alias("s")).select(group, "s.*")


def artifact_sources(provenance: DataFrame) -> DataFrame:
    """Distinct (artifact_id, source_id) with the artifact role."""
    return provenance.where("source_role = 'artifact' AND source_id <> ''").select("artifact_id", "source_id").distinct()


def derive_eligibility(
    inventory: DataFrame, definitions: DataFrame, artifacts: DataFrame, provenance: DataFrame
) -> DataFrame:
    """One row per inventory puzzle with coverage flags, the selected artifact and the exclusion reason."""
    sources = artifact_sources(provenance)
    usable = artifacts.where("artifact_format = 'puzzle'").join(sources, "artifact_id")
    chosen = select_by_priority(
        usable, "puzzle_id", "artifact_id", "source_id",
        ["sha256", "byte_length", "object_key", "rights_status"],
    ).drop("priority")
    # Read twice below: one row per puzzle is written, so that artifacts are shuffled and chosen once.
    chosen = stored(chosen, "chosen")
    wanted = sources.join(chosen.select("artifact_id"), "artifact_id", "left_semi")
    named = packed(wanted, ["artifact_id"], "source_id", "selected_source_ids")
    present = artifacts.select("puzzle_id", F.lit(True).alias("_has")).distinct()
    rows = (
        inventory.select("puzzle_id", "puzzle_type")
        .join(definitions.select("puzzle_id", "puzzle_definition_id"), "puzzle_id", "left")
        .join(present, "puzzle_id", "left")
        .join(chosen.join(named, "artifact_id"), "puzzle_id", "left")
    )
    semantic = F.col("puzzle_definition_id").isNotNull()
    covered = F.coalesce("_has", F.lit(False))
    ready = F.col("artifact_id").isNotNull()
    reason = exclusion_reason(semantic, covered, ready, F.col("puzzle_type"))
    return rows.select(
        "puzzle_id",
        "puzzle_definition_id",
        "puzzle_type",
        semantic.alias("semantic_covered"),
        covered.alias("artifact_covered"),
        ready.alias("verifier_ready"),
        reason.isNull().alias("eligible"),
        reason.alias("exclusion_reason"),
        F.col("artifact_id").alias("selected_puzzle_artifact_id"),
        F.col("sha256").alias("selected_puzzle_artifact_sha256"),
        F.col("byte_length").alias("selected_puzzle_artifact_byte_length"),
        F.col("object_key").alias("selected_puzzle_artifact_object_key"),
        F.col("rights_status").alias("selected_puzzle_artifact_rights_status"),
        F.coalesce("selected_source_ids", F.array().cast("array<string>")).alias("selected_source_ids"),
    )


def exclusion_reason(semantic: Column, covered: Column, ready: Column, puzzle_type: Column) -> Column:
    """First reason in fixed precedence; null when eligible."""
    return (
        F.when(~semantic, "missing_semantic_definition")
        .when(~covered, "missing_exact_artifact")
        .when(~ready, "no_verifier_usable_artifact")
        .when(~F.coalesce(puzzle_type.isin(fixed.PROTOCOL_PUZZLE_TYPES), F.lit(False)), "protocol_incompatible")
    )


def eligibility_violations(
    inventory: DataFrame, definitions: DataFrame, artifacts: DataFrame, provenance: DataFrame
) -> DataFrame:
    """Inputs that would make eligibility ambiguous."""
    path = "puzzle_artifacts"
    owners = artifacts.select("artifact_id", F.col("puzzle_id").alias("_puzzle"), F.col("sha256").alias("_sha"))
    joined = provenance.join(owners, "artifact_id", "left")
    identity = ["artifact_id", "source_role", "source_id", "source_revision", "source_path", "source_object_id"]
    repeated = provenance.groupBy(*identity).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    role = F.col("source_role")
    return union_all(
        [
            unique_key_violations(inventory, "puzzle_id", "inventory"),
            unique_key_violations(definitions, "puzzle_id", "definitions"),
            violations_where(
                missing_references(definitions, "puzzle_id", inventory, "puzzle_id"), F.lit(True),
                "definition_outside_collection", F.col("puzzle_id"), "definitions", "puzzle_definition_id",
            ),
            unique_key_violations(artifacts, "artifact_id", path),
            violations_where(artifacts, F.col("artifact_kind") != "puzzle", "not_a_puzzle_artifact", F.col("artifact_kind"), path, "artifact_id"),
            violations_where(
                missing_references(artifacts, "puzzle_id", inventory, "puzzle_id"), F.lit(True),
                "artifact_outside_collection", F.col("puzzle_id"), path, "artifact_id",
            ),
            violations_where(
                artifacts, ~F.col("artifact_id").eqNullSafe(artifact_id(F.lit("puzzle"), F.col("sha256"))),
                "artifact_identity", "identity does not match sha256", path, "artifact_id",
            ),
            violations_where(repeated, F.lit(True), "provenance_repeated", "same provenance twice", "provenance", "artifact_id"),
            violations_where(joined, F.col("_sha").isNull(), "provenance_unknown_artifact", "unknown artifact", "provenance", "artifact_id"),
            violations_where(joined, F.col("_puzzle") != F.col("puzzle_id"), "provenance_other_puzzle", F.col("puzzle_id"), "provenance", "artifact_id"),
            violations_where(joined, F.col("_sha") != F.col("observed_sha256"), "provenance_other_bytes", F.col("observed_sha256"), "provenance", "artifact_id"),
            violations_where(joined, ~F.coalesce(role.isin("artifact", "evidence"), F.lit(False)), "unsupported_role", F.coalesce(role, F.lit("None")), "provenance", "artifact_id"),
            violations_where(
                joined, (role == "artifact") & (F.coalesce("source_id", F.lit("")) == ""), "provenance_empty_source",
                "empty source id", "provenance", "artifact_id",
            ),
        ]
    )


def executable_inventory(
    eligibility: DataFrame, inventory_order: DataFrame, collection_id: str, inventory_sha256: str
) -> tuple[str, str]:
    """(sha256, id) of the eligible inventory in inventory order.

    inventory_order: puzzle_id, row_no.  The published identity at every size.
    """
    listed = eligibility.where("eligible").select(
        "puzzle_id", "puzzle_definition_id", "puzzle_type", "selected_puzzle_artifact_id",
        "selected_puzzle_artifact_sha256", "selected_puzzle_artifact_byte_length",
        "selected_puzzle_artifact_rights_status", "selected_source_ids",
    )
    lines = listed.withColumn("line", canonical_json(listed)).join(inventory_order.select("puzzle_id", "row_no"), "puzzle_id")
    head = (
        f'{{"collection_id":"{collection_id}","collection_inventory_sha256":"{inventory_sha256}","entries":['
    )
    tail = f'],"profile":"{fixed.ELIGIBILITY_PROFILE}","version":"{fixed.ELIGIBILITY_VERSION}"}}'
    digest = published_sha256(lines, [F.col("row_no")], head, ",", tail)
    return digest, fixed.BENCHMARK_INVENTORY_PREFIX + digest


def required_bytes_violations(eligibility: DataFrame, payloads: DataFrame) -> DataFrame:
    """Executable entries whose exact bytes are absent or differ.  payloads: artifact_id, content."""
    wanted = eligibility.where("eligible").select(
        "puzzle_id", F.col("selected_puzzle_artifact_id").alias("artifact_id"),
        "selected_puzzle_artifact_sha256", "selected_puzzle_artifact_byte_length",
    )
    joined = wanted.join(payloads.select("artifact_id", "content"), "artifact_id", "left")
    code = F.when(F.col("content").isNull(), "artifact_bytes_missing").when(
        (F.octet_length("content") != F.col("selected_puzzle_artifact_byte_length"))
        | (F.sha2("content", 256) != F.col("selected_puzzle_artifact_sha256")),
        "artifact_bytes_mismatch",
    )
    return joined.where(code.isNotNull()).select(
        code.alias("code"), F.col("artifact_id").alias("detail"), F.lit("eligibility").alias("path"),
        F.col("puzzle_id").alias("row_key"),
    )
