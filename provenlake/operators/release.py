"""Projection of canonical entities into the four release tables, and their gates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.canonical import normalized_id, row_id
from .checks import (
    missing_references,
    rule_violations,
    set_difference,
    single_valued,
    union_all,
    unique_key_violations,
    violations_where,
)
from .presence import parent, presence_violations, reference, references
from .verify import artifact_violations, verification_rules

METRICS = ["cost", "cycles", "area", "instructions"]
SOLUTION_COLUMNS = [
    "solution_id", "solution_sha256", "puzzle_id", "puzzle_artifact_id", "solution_format", "solution_bytes",
    "rights_status", "verified", "validation_profile", "verifier_revision", *METRICS, "vanilla_constructible",
    "record_eligible", "normalized_solution_id", "source_count", "collection_id",
]


# --- projections -----------------------------------------------------------------------


def aliases(row_columns: tuple[str, str] = ("game_puzzle_id", "leaderboard_key")) -> Column:
    """Non-empty other names of a puzzle as (system, value)."""
    named = F.array(*[F.struct(F.lit(c).alias("system"), F.col(c).alias("value")) for c in row_columns])
    return F.filter(named, lambda a: F.coalesce(a["value"], F.lit("")) != "")


def puzzle_rows(definitions: DataFrame, inventory: DataFrame, collection_id: str) -> DataFrame:
    names = inventory.select("puzzle_id", "display_name", "kind", aliases().alias("aliases"))
    return definitions.join(names, "puzzle_id").withColumn("collection_id", F.lit(collection_id))


def is_verified() -> Column:
    return F.coalesce(
        (F.col("parse_status") == "passed") & (F.col("simulation_status") == "passed"), F.lit(False)
    )


def source_counts(observations: DataFrame) -> DataFrame:
    """Distinct sources that observed each artifact."""
    return (
        observations.where("artifact_id IS NOT NULL AND source_id <> ''")
        .groupBy("artifact_id").agg(F.count_distinct("source_id").alias("source_count"))
    )


def gated_payload(artifacts: DataFrame, objects: DataFrame | None, policy: str) -> DataFrame:
    """(artifact_id, solution_bytes): bytes only for redistributable rows under include-permitted.

    The rights filter runs before the object join, so restricted bytes are never
    read.
    """
    if policy != "include-permitted":
        return artifacts.select("artifact_id", F.lit(None).cast("binary").alias("solution_bytes"))
    if objects is None:
        raise ValueError("include-permitted needs the stored objects")
    open_rows = artifacts.where("rights_status = 'redistributable'").select("artifact_id", "sha256")
    return open_rows.join(
        objects.select("sha256", F.col("content").alias("solution_bytes")), "sha256", "left"
    ).select("artifact_id", "solution_bytes")


def solution_rows(
    artifacts: DataFrame,
    verifications: DataFrame,
    normalized: DataFrame,
    observations: DataFrame,
    collection_id: str,
    objects: DataFrame | None = None,
    payload_policy: str = "metadata-only",
) -> DataFrame:
    """Release rows of solution artifacts with exact verification lineage.

    Missing verification or sources leave nulls here and are reported by
    ``solution_lineage_violations``.
    """
    checks = verifications.select(
        F.col("solution_id").alias("artifact_id"), "puzzle_artifact_id", is_verified().alias("verified"),
        "validation_profile", "verifier_revision", *METRICS, "vanilla_constructible", "record_eligible",
    )
    shapes = normalized.select(F.col("solution_id").alias("artifact_id"), "normalized_solution_id")
    joined = (
        artifacts.join(checks, "artifact_id", "left")
        .join(shapes, "artifact_id", "left")
        .join(source_counts(observations), "artifact_id", "left")
    )
    if payload_policy == "include-permitted":
        joined = joined.join(gated_payload(artifacts, objects, payload_policy), "artifact_id", "left")
    else:
        joined = joined.withColumn("solution_bytes", F.lit(None).cast("binary"))
    return joined.select(
        F.col("artifact_id").alias("solution_id"),
        F.col("sha256").alias("solution_sha256"),
        "puzzle_id",
        "puzzle_artifact_id",
        F.col("artifact_format").alias("solution_format"),
        "solution_bytes",
        "rights_status",
        "verified",
        "validation_profile",
        "verifier_revision",
        *METRICS,
        "vanilla_constructible",
        "record_eligible",
        "normalized_solution_id",
        "source_count",
        F.lit(collection_id).alias("collection_id"),
    )


# --- materialization gates -------------------------------------------------------------


def definition_coverage_violations(definitions: DataFrame, inventory: DataFrame) -> DataFrame:
    """Definitions outside the inventory, more than one per puzzle, and puzzles without one."""
    sides = set_difference(inventory, definitions, "puzzle_id")
    several = definitions.groupBy("puzzle_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return union_all(
        [
            violations_where(sides, F.col("side") == "unexpected", "definition_outside_collection", "not in collection", "definitions", "puzzle_id"),
            violations_where(sides, F.col("side") == "missing", "definition_missing", "no definition", "definitions", "puzzle_id"),
            violations_where(several, F.lit(True), "definition_repeated", "several definitions", "definitions", "puzzle_id"),
            unique_key_violations(definitions, "puzzle_definition_id", "definitions"),
        ]
    )


def observation_violations(
    observations: DataFrame, inventory: DataFrame, puzzle_artifacts: DataFrame, solution_artifacts: DataFrame
) -> DataFrame:
    """Schema, identity and the kind-dependent artifact reference of observations."""
    typed = observations.withColumn("_id", row_id(observations, fixed.OBSERVATION_PREFIX, ["observation_id"]))
    rules = {
        **table_rules("observations"),
        "observation_id does not match its body": F.col("observation_id") == F.col("_id"),
    }
    path, key = "observations", "observation_id"
    return union_all(
        [
            rule_violations(typed, rules, path, key, "observation_invalid"),
            unique_key_violations(observations, key, path),
            observation_reference_violations(observations, inventory, puzzle_artifacts, solution_artifacts),
        ]
    )


def observation_reference_violations(
    observations: DataFrame, inventory: DataFrame, puzzle_artifacts: DataFrame, solution_artifacts: DataFrame
) -> DataFrame:
    """The artifact of an observation, in the table that its kind names, of its puzzle and its bytes; else its puzzle."""
    known = (
        puzzle_artifacts.select(F.lit("puzzle").alias("artifact_kind"), "artifact_id", "puzzle_id", "sha256")
        .unionByName(
            solution_artifacts.select(F.lit("solution").alias("artifact_kind"), "artifact_id", "puzzle_id", "sha256")
        )
        .withColumnsRenamed({"puzzle_id": "_puzzle", "sha256": "_sha"})
    )
    bound = observations.where("artifact_id IS NOT NULL").join(known, ["artifact_kind", "artifact_id"], "left")
    free = observations.where("artifact_id IS NULL AND puzzle_id IS NOT NULL")
    stray = missing_references(free, "puzzle_id", inventory, "puzzle_id")
    path, key = "observations", "observation_id"
    return union_all(
        [
            violations_where(bound, F.col("_sha").isNull(), "observation_unknown_artifact", F.col("artifact_id"), path, key),
            violations_where(
                bound, F.col("_sha").isNotNull() & ~F.col("puzzle_id").eqNullSafe(F.col("_puzzle")),
                "observation_other_puzzle", F.col("artifact_id"), path, key,
            ),
            violations_where(
                bound, F.col("_sha").isNotNull() & ~F.col("observed_sha256").eqNullSafe(F.col("_sha")),
                "observation_other_bytes", F.col("artifact_id"), path, key,
            ),
            violations_where(stray, F.lit(True), "observation_outside_collection", F.col("puzzle_id"), path, key),
        ]
    )


def provenance_violations(definitions: DataFrame, observations: DataFrame, puzzle_artifacts: DataFrame) -> DataFrame:
    """Definition provenance (array reference), artifact binding and unobserved puzzle artifacts."""
    links = definitions.select("puzzle_id", F.explode("source_observation_ids").alias("observation_id"))
    facts = observations.select("observation_id", F.col("puzzle_id").alias("_puzzle"), F.lit(True).alias("_known"))
    joined = links.join(facts, "observation_id", "left")
    bound = definitions.select("puzzle_id", F.explode("puzzle_artifact_ids").alias("artifact_id"), F.lit(True).alias("_bound"))
    owned = puzzle_artifacts.select("artifact_id", "puzzle_id").join(bound, ["puzzle_id", "artifact_id"], "left")
    unseen = missing_references(puzzle_artifacts, "artifact_id", observations.where("artifact_id IS NOT NULL"), "artifact_id")
    return union_all(
        [
            violations_where(joined, F.col("_known").isNull(), "definition_observation_missing", F.col("observation_id"), "definitions", "puzzle_id"),
            violations_where(
                joined, F.col("_known") & ~F.col("_puzzle").eqNullSafe(F.col("puzzle_id")),
                "definition_observation_other_puzzle", F.col("observation_id"), "definitions", "puzzle_id",
            ),
            violations_where(owned, F.col("_bound").isNull(), "artifact_unbound", F.col("puzzle_id"), "puzzle_artifacts", "artifact_id"),
            violations_where(unseen, F.lit(True), "artifact_unobserved", "no observation", "puzzle_artifacts", "artifact_id"),
        ]
    )


def solution_lineage_violations(
    artifacts: DataFrame, verifications: DataFrame, normalized: DataFrame, observations: DataFrame,
    definitions: DataFrame, puzzle_artifacts: DataFrame,
) -> DataFrame:
    """Every way a solution row would lose its lineage, plus strays on the other side."""
    checks = verifications.select(F.col("solution_id").alias("artifact_id"), F.col("puzzle_artifact_id"), F.lit(True).alias("_v"))
    owners = puzzle_artifacts.select(F.col("artifact_id").alias("puzzle_artifact_id"), F.col("puzzle_id").alias("_owner"))
    bound = definitions.select("puzzle_id", F.explode("puzzle_artifact_ids").alias("puzzle_artifact_id"), F.lit(True).alias("_bound"))
    shapes = normalized.select(F.col("solution_id").alias("artifact_id"), F.col("puzzle_id").alias("_shape_puzzle"))
    rows = (
        artifacts.join(checks, "artifact_id", "left")
        .join(owners, "puzzle_artifact_id", "left")
        .join(bound, ["puzzle_id", "puzzle_artifact_id"], "left")
        .join(shapes, "artifact_id", "left")
        .join(source_counts(observations), "artifact_id", "left")
    )
    key, path = "artifact_id", "solutions"
    has = F.col("_v").isNotNull()
    stray_v = missing_references(verifications, "solution_id", artifacts, "artifact_id")
    stray_n = missing_references(normalized, "solution_id", artifacts, "artifact_id")
    undefined = missing_references(artifacts, "puzzle_id", definitions, "puzzle_id")
    return union_all(
        [
            violations_where(rows, ~has, "verification_missing", "no verification", path, key),
            violations_where(rows, has & F.col("_owner").isNull(), "puzzle_artifact_unknown", F.col("puzzle_artifact_id"), path, key),
            violations_where(rows, F.col("_owner") != F.col("puzzle_id"), "puzzle_artifact_other_puzzle", F.col("puzzle_artifact_id"), path, key),
            violations_where(
                rows, (F.col("_owner") == F.col("puzzle_id")) & F.col("_bound").isNull(),
                "puzzle_artifact_unbound", F.col("puzzle_artifact_id"), path, key,
            ),
            violations_where(rows, F.col("_shape_puzzle") != F.col("puzzle_id"), "normalized_other_puzzle", F.col("_shape_puzzle"), path, key),
            violations_where(rows, F.col("source_count").isNull(), "solution_unobserved", "no source observation", path, key),
            violations_where(undefined, F.lit(True), "solution_without_definition", F.col("puzzle_id"), path, key),
            violations_where(stray_v, F.lit(True), "verification_unknown_solution", "unknown solution", "verifications", "solution_id"),
            violations_where(stray_n, F.lit(True), "normalized_unknown_solution", "unknown solution", "normalized", "solution_id"),
        ]
    )


def normalized_violations(normalized: DataFrame) -> DataFrame:
    expected = normalized_id(F.col("solution_id"), F.col("puzzle_id"), F.col("normalizer_version"))
    return union_all(
        [
            violations_where(
                normalized, ~F.col("normalized_solution_id").eqNullSafe(expected), "normalized_identity",
                "identity does not match its inputs", "normalized", "solution_id",
            ),
            unique_key_violations(normalized, "solution_id", "normalized"),
        ]
    )


def materialization_violations(
    inventory: DataFrame, definitions: DataFrame, puzzle_artifacts: DataFrame, solution_artifacts: DataFrame,
    observations: DataFrame, verifications: DataFrame, normalized: DataFrame,
) -> DataFrame:
    """All gates of the release projection in one violations table."""
    from .reconcile import definition_violations

    return union_all(
        [
            unique_key_violations(inventory, "puzzle_id", "inventory"),
            definition_violations(definitions),
            definition_coverage_violations(definitions, inventory),
            artifact_violations(puzzle_artifacts, "puzzle", "puzzle_artifacts"),
            unique_key_violations(puzzle_artifacts, "artifact_id", "puzzle_artifacts"),
            artifact_violations(solution_artifacts, "solution", "solution_artifacts"),
            unique_key_violations(solution_artifacts, "artifact_id", "solution_artifacts"),
            rule_violations(verifications, verification_rules(), "verifications", "solution_id", "verification_invalid"),
            unique_key_violations(verifications, "solution_id", "verifications"),
            normalized_violations(normalized),
            observation_violations(observations, inventory, puzzle_artifacts, solution_artifacts),
            provenance_violations(definitions, observations, puzzle_artifacts),
            solution_lineage_violations(
                solution_artifacts, verifications, normalized, observations, definitions, puzzle_artifacts
            ),
        ]
    )


# --- release table checks --------------------------------------------------------------


def _text(column: str) -> Column:
    return F.length(column) > 0


def _non_negative_or_null(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) >= 0)


def table_rules(table: str) -> dict[str, Column]:
    """Row rules of one release table."""
    rights = F.col("rights_status").isin(list(fixed.RIGHTS_RANK))
    if table == "puzzles":
        return {
            "puzzle_definition_id has the wrong form": F.col("puzzle_definition_id").rlike(
                r"^om\.puzzle-definition\.sha256\.[0-9a-f]{64}$"
            ),
            "schema_version is unsupported": F.col("schema_version") == fixed.DEFINITION_SCHEMA_VERSION,
            "puzzle_id has the wrong form": F.col("puzzle_id").rlike(fixed.PUZZLE_ID_PATTERN),
            "display_name is empty": _text("display_name"),
            "kind is empty": _text("kind"),
            "aliases are invalid": F.forall("aliases", lambda a: (F.length(a["system"]) > 0) & (F.length(a["value"]) > 0)),
            "reagents are empty": F.size("reagents") > 0,
            "products are empty": F.size("products") > 0,
            "output_scale must be at least 1": F.col("output_scale") >= 1,
            "target_output_count must be at least 1": F.col("target_output_count") >= 1,
            "production and production_constraints disagree": F.col("production")
            == F.col("production_constraints").isNotNull(),
            **{
                f"{c} must be unique and non-empty": (F.size(c) == F.size(F.array_distinct(c)))
                & F.forall(c, lambda x: F.length(x) > 0)
                for c in ("allowed_parts", "allowed_instructions", "source_observation_ids")
            },
            "puzzle_artifact_ids are invalid": (F.size("puzzle_artifact_ids") == F.size(F.array_distinct("puzzle_artifact_ids")))
            & F.forall("puzzle_artifact_ids", lambda x: x.rlike(r"^om\.puzzle-artifact\.sha256\.[0-9a-f]{64}$")),
            "collection_id is empty": _text("collection_id"),
        }
    if table == "solutions":
        return {
            "solution_id is empty": _text("solution_id"),
            "solution_sha256 is invalid": F.col("solution_sha256").rlike(fixed.SHA256_PATTERN),
            "puzzle_id has the wrong form": F.col("puzzle_id").rlike(fixed.PUZZLE_ID_PATTERN),
            "puzzle_artifact_id is empty": _text("puzzle_artifact_id"),
            "solution_format is empty": _text("solution_format"),
            "rights_status is unknown": rights,
            "verified is missing": F.col("verified").isNotNull(),
            "validation_profile is empty": _text("validation_profile"),
            "verifier_revision is empty": _text("verifier_revision"),
            **{f"{m} is negative": _non_negative_or_null(m) for m in METRICS},
            "source_count must be at least 1": F.col("source_count") >= 1,
            "collection_id is empty": _text("collection_id"),
        }
    if table == "observations":
        metadata = F.coalesce(F.col("source_role") == "metadata", F.lit(False))
        return {
            "observation_id is empty": _text("observation_id"),
            "artifact_kind is unknown": F.col("artifact_kind").isin("puzzle", "solution"),
            "artifact_id is empty": (metadata & F.col("artifact_id").isNull()) | F.coalesce(_text("artifact_id"), F.lit(False)),
            "source_role is unknown": F.col("source_role").isNull() | F.col("source_role").isin("artifact", "metadata"),
            "source_id is empty": _text("source_id"),
            **{f"claimed_{m} is negative": _non_negative_or_null(f"claimed_{m}") for m in METRICS},
            **{
                f"{c} is invalid": F.col(c).isNull() | F.col(c).rlike(fixed.SHA256_PATTERN)
                for c in ("observed_sha256", "source_evidence_sha256")
            },
            "source_evidence_byte_length is negative": _non_negative_or_null("source_evidence_byte_length"),
            "rights_status is unknown": rights,
            "importer_version is empty": _text("importer_version"),
        }
    if table == "normalized":
        counts = ["part_count", "track_count", "track_hex_count", "program_count", "instruction_count"]
        return {
            "normalized_solution_id has the wrong form": F.col("normalized_solution_id").rlike(
                r"^om\.normalized-solution\.[0-9a-f]{64}$"
            ),
            "solution_id is empty": _text("solution_id"),
            "puzzle_id has the wrong form": F.col("puzzle_id").rlike(fixed.PUZZLE_ID_PATTERN),
            "normalizer_version is empty": _text("normalizer_version"),
            "parts are invalid": F.forall(
                "parts",
                lambda p: (F.length(p["part_id"]) > 0) & (F.length(p["type"]) > 0) & p["rotation"].between(0, 5)
                & p["x"].isNotNull() & p["y"].isNotNull() & p["parameters"].isNotNull(),
            ),
            "tracks are invalid": F.forall("tracks", lambda t: (F.length(t["track_id"]) > 0) & (F.size(t["coordinates"]) > 0)),
            "programs are invalid": F.forall(
                "programs",
                lambda p: (F.length(p["arm_id"]) > 0)
                & F.forall(p["instructions"], lambda s: (s["cycle"] >= 0) & (F.length(s["opcode"]) > 0)),
            ),
            **{f"{c} is negative": F.col(f"summaries.{c}") >= 0 for c in counts},
            **{
                f"{h} is invalid": F.forall(F.map_entries(f"summaries.{h}"), lambda e: (F.length(e["key"]) > 0) & (e["value"] >= 0))
                for h in ("part_type_histogram", "opcode_histogram")
            },
        }
    raise ValueError(f"unknown release table {table!r}")


def table_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(
        [rule_violations(df, table_rules(t), t, fixed.RELEASE_TABLES[t][0]) for t, df in tables.items()]
    )


def payload_violations(
    rows: DataFrame, payload: str, policy: str, path: str, row_key: str, rights: str = "rights_status"
) -> DataFrame:
    """Rows whose bytes the payload policy does not allow."""
    if policy not in fixed.PAYLOAD_POLICIES:
        raise ValueError(f"unknown payload policy {policy!r}")
    present = F.length(payload) > 0
    if policy == "metadata-only":
        return violations_where(rows, present, "payload_forbidden", "bytes must be null under metadata-only", path, row_key)
    closed = ~F.coalesce(F.col(rights) == "redistributable", F.lit(False))
    return violations_where(rows, present & closed, "payload_rights_violation", "bytes require redistributable rights", path, row_key)


def collection_violations(tables: Mapping[str, DataFrame], collection_id: str) -> DataFrame:
    return union_all(
        [
            violations_where(
                tables[t], ~F.col("collection_id").eqNullSafe(F.lit(collection_id)), "collection_mismatch",
                F.coalesce("collection_id", F.lit("None")), t, fixed.RELEASE_TABLES[t][0],
            )
            for t in ("puzzles", "solutions")
        ]
    )


def integrity_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The six reference rules between the release tables, and the same-puzzle rule, in one shuffle."""
    def unknown(label: str, column: str) -> tuple[str, Column]:
        shown = F.coalesce(F.col(column).cast("string"), F.lit("None"))
        return "referential_integrity", F.concat(F.lit(f"references unknown {label} "), shown)

    puzzles, solutions = tables["puzzles"], tables["solutions"]
    artifacts = puzzles.select("puzzle_id", F.explode("puzzle_artifact_ids").alias("artifact_id"))
    other = ("puzzle_artifact_other_puzzle", "artifact belongs to another puzzle")
    bare = F.coalesce((F.col("source_role") == "metadata") & F.col("artifact_id").isNull(), F.lit(False))
    return presence_violations(
        [parent(puzzles, "puzzle", "puzzle_id"), parent(artifacts, "artifact", "artifact_id", "puzzle_id"), parent(solutions, "solution", "solution_id")],
        [
            references(solutions, "solutions", "solution_id", [
                reference("puzzle", "puzzle_id", unknown("puzzle", "puzzle_id")),
                reference("artifact", "puzzle_artifact_id", unknown("puzzle artifact", "puzzle_artifact_id"), "puzzle_id", other),
            ]),
            references(tables["normalized"], "normalized", "normalized_solution_id", [
                reference("solution", "solution_id", unknown("solution", "solution_id")),
                reference("puzzle", "puzzle_id", unknown("puzzle", "puzzle_id")),
            ]),
            references(tables["observations"].where(~bare), "observations", "observation_id", [
                reference("solution", "artifact_id", unknown("solution", "artifact_id"), when=F.col("artifact_kind") == "solution"),
                reference("artifact", "artifact_id", unknown("puzzle artifact", "artifact_id"), when=F.col("artifact_kind") == "puzzle"),
            ]),
        ],
    )


def identity_violations(verifications: DataFrame, normalized: DataFrame) -> DataFrame:
    """A release has at most one verifier identity and one normalizer version."""
    return union_all(
        [
            single_valued(
                verifications,
                ["verifier_implementation", "verifier_revision", "verifier_sha256", "validation_profile"],
                "verifier_identity_not_unique", "verifications",
            ),
            single_valued(normalized, ["normalizer_version"], "normalizer_version_not_unique", "normalized"),
        ]
    )


def source_classes(observations: DataFrame) -> DataFrame:
    """Distinct (source_id, revision) of a release, in order."""
    return (
        observations.select("source_id", F.col("source_revision").alias("revision")).distinct()
        .orderBy("source_id", F.coalesce("revision", F.lit("")))
    )
