"""Reconciling partial claims about one subject, and comparing with catalogs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import nested
from ..functions.canonical import json_object, json_scalar, sha256_hex
from .checks import dependency_violations, packed, union_all, violations_where


@dataclass(frozen=True)
class Reconciled:
    """``definitions`` are complete; ``resolutions`` has one row per inventory puzzle."""

    definitions: DataFrame
    resolutions: DataFrame
    violations: DataFrame


def reconcile_fields(claims: DataFrame, subject: str, field: str = "field", value: str = "value_json") -> DataFrame:
    """One row per (subject, field): the agreed value, or both ends of a conflict.

    Values agree when the lowest and the highest canonical text are the same;
    only combined aggregates are kept per group.
    """
    return (
        claims.groupBy(subject, field)
        .agg(F.min(value).alias("value_json"), F.max(value).alias("_other"), F.count(F.lit(1)).alias("claims"))
        .select(
            subject,
            field,
            F.col("value_json"),
            "claims",
            (F.col("value_json") != F.col("_other")).alias("conflict"),
            F.when(F.col("value_json") != F.col("_other"), F.col("_other")).alias("other_json"),
        )
    )


def conflict_path(field: Column, left: Column, right: Column) -> Column:
    """Where two canonical claims first differ."""
    molecules = "array<struct<atoms:array<%s>,bonds:array<%s>>>" % (nested.ATOM, nested.BOND)
    shapes = {
        "allowed_parts": "array<string>",
        "allowed_instructions": "array<string>",
        "reagents": molecules,
        "products": molecules,
        "production_constraints": nested.CONSTRAINTS,
    }
    from pyspark.sql.types import StructType

    path = field
    for name, ddl in shapes.items():
        dtype = StructType.fromDDL(f"v {ddl}")["v"].dataType
        difference = nested.first_difference(
            F.from_json(left, ddl), F.from_json(right, ddl), dtype, F.lit(name)
        )
        path = F.when(field == name, F.coalesce(difference, field)).otherwise(path)
    return path


def definition_id(subject: Column, values: Mapping[str, Column]) -> Column:
    """Identity of a definition from its eight canonical JSON values."""
    body = {
        "schema_version": F.lit(f'"{fixed.DEFINITION_SCHEMA_VERSION}"'),
        "puzzle_id": json_scalar(subject),
        **values,
    }
    return F.concat(F.lit(fixed.DEFINITION_PREFIX), sha256_hex(json_object(body)))


def typed_definition(row: DataFrame) -> DataFrame:
    """Typed columns of definition rows held as one JSON text per field."""
    return row.select(
        "puzzle_definition_id",
        F.lit(fixed.DEFINITION_SCHEMA_VERSION).alias("schema_version"),
        "puzzle_id",
        F.from_json("allowed_parts", "array<string>").alias("allowed_parts"),
        F.from_json("allowed_instructions", "array<string>").alias("allowed_instructions"),
        F.from_json("reagents", nested.MOLECULES).alias("reagents"),
        F.from_json("products", nested.MOLECULES).alias("products"),
        F.col("output_scale").cast("bigint").alias("output_scale"),
        F.col("target_output_count").cast("bigint").alias("target_output_count"),
        F.col("production").cast("boolean").alias("production"),
        F.when(
            F.col("production_constraints") != "null",
            F.from_json("production_constraints", nested.CONSTRAINTS),
        ).alias("production_constraints"),
        "source_observation_ids",
        "puzzle_artifact_ids",
    )


def invariant_violations(values: DataFrame) -> DataFrame:
    """Cross-field rules of a complete definition (fields held as JSON text)."""
    found = [
        violations_where(
            values, F.col("target_output_count").cast("bigint") != 6 * F.col("output_scale").cast("bigint"),
            "definition_invalid", "target_output_count must equal 6 * output_scale", "definitions", "puzzle_id",
        ),
        violations_where(
            values, (F.col("production") == "true") != (F.col("production_constraints") != "null"),
            "definition_invalid", "production and production_constraints disagree", "definitions", "puzzle_id",
        ),
    ]
    return union_all(found)


def reconcile_definitions(inventory: DataFrame, claims: DataFrame) -> Reconciled:
    """At most one definition per inventory puzzle from partial claims.

    claims: puzzle_id, observation_ids array, puzzle_artifact_id, field, value_json.
    """
    return reconcile_checked(inventory, nested.canonical_claims(claims))


def reconcile_checked(inventory: DataFrame, checked: DataFrame) -> Reconciled:
    """``reconcile_definitions`` over claims that are already canonical (with ``error``).

    The claims are read several times; builds pass a checkpointed table.
    """
    rejected = violations_where(
        checked, F.col("error").isNotNull(), "claim_invalid",
        F.concat_ws(": ", "field", "error"), "claims", "puzzle_id",
    )
    unobserved = violations_where(
        checked, F.size("observation_ids") < 1, "claim_unobserved", "no observation id", "claims", "puzzle_id"
    )
    foreign = violations_where(
        checked.join(inventory.select("puzzle_id"), "puzzle_id", "left_anti"), F.lit(True),
        "claim_outside_collection", F.col("field"), "claims", "puzzle_id",
    )
    good = checked.where("error IS NULL")
    fields = reconcile_fields(good, "puzzle_id")
    conflicts = violations_where(
        fields, F.col("conflict"), "claim_conflict",
        conflict_path(F.col("field"), F.col("value_json"), F.col("other_json")), "claims", "puzzle_id",
    )
    wide = fields.where("NOT conflict").groupBy("puzzle_id").agg(
        *[F.max(F.when(F.col("field") == f, F.col("value_json"))).alias(f) for f in fixed.SEMANTIC_FIELDS]
    )
    links = checked.select("puzzle_id", F.explode("observation_ids").alias("observation_id"))
    observations = packed(links, ["puzzle_id"], "observation_id", "source_observation_ids")
    artifacts = packed(
        checked.where("puzzle_artifact_id IS NOT NULL"), ["puzzle_id"], "puzzle_artifact_id", "puzzle_artifact_ids"
    )
    empty = F.array().cast("array<string>")
    missing = F.array_sort(
        F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in fixed.SEMANTIC_FIELDS]))
    )
    resolutions = (
        inventory.select("puzzle_id").join(wide, "puzzle_id", "left")
        .join(observations, "puzzle_id", "left").join(artifacts, "puzzle_id", "left")
        .withColumn("source_observation_ids", F.coalesce("source_observation_ids", empty))
        .withColumn("puzzle_artifact_ids", F.coalesce("puzzle_artifact_ids", empty))
        .withColumn("missing_fields", missing)
    )
    complete = resolutions.where(F.size("missing_fields") == 0)
    identified = complete.withColumn(
        "puzzle_definition_id",
        definition_id(F.col("puzzle_id"), {f: F.col(f) for f in fixed.SEMANTIC_FIELDS}),
    )
    violations = union_all([rejected, unobserved, foreign, conflicts, invariant_violations(complete)])
    return Reconciled(
        typed_definition(identified),
        resolutions.select("puzzle_id", "missing_fields", "source_observation_ids", "puzzle_artifact_ids"),
        violations,
    )


def definition_rows_id(definitions: DataFrame) -> Column:
    """Identity recomputed from typed definition rows."""
    from ..functions.canonical import canonical_value, json_of

    values: dict[str, Column] = {}
    for f in fixed.SEMANTIC_FIELDS:
        dtype = definitions.schema[f].dataType
        if dtype.typeName() in ("array", "struct"):
            values[f] = F.coalesce(json_of(canonical_value(F.col(f), dtype)), F.lit("null"))
        else:
            values[f] = F.coalesce(F.col(f).cast("string"), F.lit("null"))
    return definition_id(F.col("puzzle_id"), values)


def definition_violations(definitions: DataFrame) -> DataFrame:
    """Schema, identity and invariant checks of typed definition rows."""
    typed = definitions.select(
        "*",
        definition_rows_id(definitions).alias("_expected_id"),
        nested.molecules_error(F.col("reagents")).alias("_r"),
        nested.molecules_error(F.col("products")).alias("_p"),
    )
    rules = {
        "puzzle_definition_id must match its content": F.col("puzzle_definition_id") == F.col("_expected_id"),
        "schema_version is unsupported": F.col("schema_version") == fixed.DEFINITION_SCHEMA_VERSION,
        "puzzle_id has the wrong form": F.col("puzzle_id").rlike(fixed.PUZZLE_ID_PATTERN),
        "reagents are invalid": F.col("_r").isNull(),
        "products are invalid": F.col("_p").isNull(),
        "allowed_parts must be unique": F.size("allowed_parts") == F.size(F.array_distinct("allowed_parts")),
        "allowed_instructions must be unique": F.size("allowed_instructions")
        == F.size(F.array_distinct("allowed_instructions")),
        "output_scale must be at least 1": F.col("output_scale") >= 1,
        "target_output_count must equal 6 * output_scale": F.col("target_output_count")
        == 6 * F.col("output_scale"),
        "production and production_constraints disagree": F.col("production")
        == F.col("production_constraints").isNotNull(),
    }
    from .checks import rule_violations

    return rule_violations(typed, rules, "definitions", "puzzle_id", "definition_invalid")


def semantic_sources(definitions: DataFrame, observations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(puzzle_id, source_id) pairs behind definitions, and broken references."""
    links = definitions.select("puzzle_id", F.explode("source_observation_ids").alias("observation_id"))
    facts = observations.select("observation_id", "source_id", F.lit(True).alias("_known")).dropDuplicates(
        ["observation_id"]
    )
    joined = links.join(facts, "observation_id", "left")
    broken = union_all(
        [
            violations_where(
                joined, F.col("_known").isNull(), "observation_missing", F.col("observation_id"),
                "definitions", "puzzle_id",
            ),
            violations_where(
                joined, F.col("_known") & (F.coalesce(F.col("source_id"), F.lit("")) == ""),
                "observation_source_invalid", F.col("observation_id"), "definitions", "puzzle_id",
            ),
            dependency_violations(
                observations, ["observation_id"],
                [c for c in sorted(observations.columns) if c != "observation_id"],
                "observation_conflict", "observations",
            ),
        ]
    )
    return joined.where("_known").select("puzzle_id", "source_id").distinct(), broken


def compare_with_catalog(
    inventory: DataFrame, catalog: DataFrame, key: str, fields: Mapping[str, str]
) -> DataFrame:
    """Inventory rows beside the catalog: status and the list of differing fields.

    ``fields`` maps an inventory column to the catalog column that must equal it.
    """
    observed = catalog.select(
        key, *[F.col(c).alias(f"_{f}") for f, c in fields.items()], F.lit(True).alias("_found")
    )
    joined = inventory.join(observed, key, "left")
    differing = F.array_compact(
        F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"_{f}")), F.lit(f)) for f in fields])
    )
    status = F.when(F.col("_found").isNull(), "missing").when(F.size(differing) > 0, "mismatch").otherwise("match")
    return joined.select(
        key, status.alias("status"),
        F.when(F.col("_found").isNotNull(), F.array_join(differing, ",")).alias("differing"),
    )


def canonical_group(group_key: Column, collection_key: Column) -> Column:
    """Inventory group of a catalog (group, collection) pair; null when unsupported."""
    chapter = F.regexp_extract(group_key, r"^CHAPTER_([1-9][0-9]*)$", 1)
    first = F.lower(F.regexp_extract(group_key, r"^JOURNAL_([IVXLCDM]+)$", 1))
    second = F.lower(F.regexp_extract(group_key, r"^JOURNAL_CVIII_([IVXLCDM]+)$", 1))
    return (
        F.when((collection_key == "CAMPAIGN") & (group_key == "CHAPTER_PRODUCTION"), F.lit("appendix"))
        .when((collection_key == "CAMPAIGN") & (chapter != ""), F.concat(F.lit("chapter-"), chapter))
        .when((collection_key == "JOURNAL_XCIX") & (first != ""), F.concat(F.lit("journal-xcix-"), first))
        .when((collection_key == "JOURNAL_CVIII") & (second != ""), F.concat(F.lit("journal-cviii-"), second))
    )


def canonical_kind(group_key: Column, collection_key: Column) -> Column:
    return (
        F.when(
            collection_key == "CAMPAIGN",
            F.when(group_key == "CHAPTER_PRODUCTION", "production").otherwise("campaign"),
        )
        .when(collection_key.isin("JOURNAL_XCIX", "JOURNAL_CVIII"), "journal")
    )


def catalog_reference_violations(
    puzzles: DataFrame, groups: DataFrame, collections: DataFrame, types: DataFrame
) -> DataFrame:
    """Unknown groups, collections and types in a parsed catalog, and repeated keys."""
    from .checks import reference_violations, unique_key_violations

    return union_all(
        [
            reference_violations(groups, "collection_key", collections, "collection_key", "collection", "groups", "group_key"),
            reference_violations(puzzles, "group_key", groups, "group_key", "group", "catalog", "leaderboard_key"),
            reference_violations(puzzles, "type_key", types, "type_key", "type", "catalog", "leaderboard_key"),
            unique_key_violations(puzzles, "leaderboard_key", "catalog"),
            unique_key_violations(puzzles, "game_puzzle_id", "catalog"),
        ]
    )


def catalog_view(puzzles: DataFrame, groups: DataFrame, types: DataFrame) -> DataFrame:
    """Catalog rows in inventory terms (kind, group, puzzle_type)."""
    return (
        puzzles.join(groups, "group_key").join(types, "type_key")
        .select(
            "game_puzzle_id", "leaderboard_key", "display_name",
            canonical_kind(F.col("group_key"), F.col("collection_key")).alias("kind"),
            canonical_group(F.col("group_key"), F.col("collection_key")).alias("group"),
            F.replace(F.col("type_name"), F.lit(" "), F.lit("_")).alias("puzzle_type"),
        )
    )
