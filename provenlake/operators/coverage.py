"""Coverage of the inventory, set reconciliation and group rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.canonical import collection_split  # noqa: F401  (re-exported projection)
from .checks import link_counts, packed, set_difference, union_all, violations_where


def coverage_state(candidates: Column, verified: Column) -> Column:
    return (
        F.when(verified > 1, "multi_solution")
        .when(verified == 1, "verified")
        .when(candidates > 0, "candidate_found")
        .otherwise("uncovered")
    )


def coverage_by_key(inventory: DataFrame, solutions: DataFrame, key: str, verified: Column) -> DataFrame:
    """Counts and state for every inventory key, solutions pre-aggregated before the join."""
    counts = solutions.groupBy(key).agg(
        F.count(F.lit(1)).alias("candidate_solution_count"),
        F.count_if(F.coalesce(verified, F.lit(False))).alias("verified_solution_count"),
    )
    joined = inventory.select(key).join(counts, key, "left").na.fill(
        0, ["candidate_solution_count", "verified_solution_count"]
    )
    return joined.select(
        key,
        "candidate_solution_count",
        "verified_solution_count",
        (F.col("candidate_solution_count") - F.col("verified_solution_count")).alias("rejected_solution_count"),
        coverage_state(F.col("candidate_solution_count"), F.col("verified_solution_count")).alias("state"),
    )


def coverage_totals(puzzles: DataFrame, solutions: DataFrame, verified: Column) -> DataFrame:
    """One row of totals over all solution rows, whatever their puzzle."""
    sides = solutions.select(
        F.lit(0).alias("p"), F.lit(1).alias("c"), F.coalesce(verified, F.lit(False)).cast("int").alias("v")
    ).unionByName(puzzles.select(F.lit(1).alias("p"), F.lit(0).alias("c"), F.lit(0).alias("v")))
    sums = sides.agg(*[F.coalesce(F.sum(x), F.lit(0)).cast("bigint").alias(x) for x in "pcv"])
    return sums.select(
        F.col("p").alias("puzzle_count"),
        F.col("c").alias("candidate_solution_count"),
        F.col("v").alias("verified_solution_count"),
        (F.col("c") - F.col("v")).alias("rejected_solution_count"),
    )


def coverage_violations(
    inventory: DataFrame, puzzles: DataFrame, by_key: DataFrame, key: str, policy: str
) -> DataFrame:
    """Unexpected keys always fail; missing and unverified ones only under ``complete``."""
    sides = set_difference(inventory, puzzles, key)
    if policy != "complete":
        sides = sides.where("side = 'unexpected'")
    found = [
        violations_where(
            sides, F.lit(True), "collection_coverage_mismatch",
            F.concat(F.col("side"), F.lit(" puzzle")), "puzzles", key,
        )
    ]
    if policy == "complete":
        found.append(
            violations_where(
                by_key, F.col("verified_solution_count") == 0, "collection_verified_coverage_incomplete",
                "no verified solution", "solutions", key,
            )
        )
    return union_all(found)


def puzzle_coverage(
    inventory: DataFrame,
    artifacts: DataFrame,
    provenance: DataFrame,
    definitions: DataFrame | None = None,
    semantic_sources: DataFrame | None = None,
) -> DataFrame:
    """Three independent axes per inventory puzzle: semantic, exact bytes, ready.

    The lists are the artifact ids and source ids of one puzzle; the flags come from
    the counted links, not from the lists.
    """
    ids = packed(artifacts, ["puzzle_id"], "artifact_id", "artifact_ids").join(
        link_counts(artifacts, ["puzzle_id"], "artifact_id", "_artifacts"), "puzzle_id"
    )
    exact = packed(provenance.where("source_role = 'artifact'"), ["puzzle_id"], "source_id", "exact_source_ids")
    rows = inventory.select("puzzle_id").join(ids, "puzzle_id", "left").join(exact, "puzzle_id", "left")
    if definitions is None:
        rows = rows.withColumn("puzzle_definition_id", F.lit(None).cast("string"))
    else:
        rows = rows.join(definitions.select("puzzle_id", "puzzle_definition_id"), "puzzle_id", "left")
    if semantic_sources is None:
        rows = rows.withColumn("semantic_source_ids", F.array().cast("array<string>"))
    else:
        rows = rows.join(packed(semantic_sources, ["puzzle_id"], "source_id", "semantic_source_ids"), "puzzle_id", "left")
    empty = F.array().cast("array<string>")
    rows = rows.select(
        "puzzle_id",
        "puzzle_definition_id",
        *[F.coalesce(c, empty).alias(c) for c in ("artifact_ids", "semantic_source_ids", "exact_source_ids")],
        F.coalesce("_artifacts", F.lit(0)).alias("_artifacts"),
    )
    return rows.select(
        "*",
        F.col("puzzle_definition_id").isNotNull().alias("semantic_covered"),
        (F.col("_artifacts") > 0).alias("artifact_covered"),
        (F.col("_artifacts") == 1).alias("verifier_ready"),
    ).drop("_artifacts")


def not_ready(coverage: DataFrame) -> DataFrame:
    """The complete-coverage gate: puzzles without exactly one artifact."""
    return violations_where(
        coverage, ~F.col("verifier_ready"), "coverage_incomplete", "no unambiguous puzzle artifact",
        "puzzle_coverage", "puzzle_id",
    )


def rollup_matches(rows: DataFrame, group: str, rollups: DataFrame, key: str) -> DataFrame:
    """(row columns, rollup key) for every rollup key equal to the group or a ``-`` prefix of it.

    The prefixes of a group are few, so they are exploded and joined by equality.
    """
    parts = F.split(F.col(group), "-")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "-")
    )
    keys = rollups.select(
        F.col(key), F.translate(F.col(key).cast("string"), "_", "-").alias("_prefix")
    )
    return rows.withColumn("_prefix", F.explode(prefixes)).join(keys, "_prefix").drop("_prefix")


def rollup_counts(rows: DataFrame, row_key: str, group: str, rollups: DataFrame, key: str, expected: str):
    """Observed count per rollup key beside the declared one, and per-row violations.

    Groups are reduced to distinct values with counts before matching, so the
    join works on group names, not on rows.
    """
    groups = rows.groupBy(group).agg(F.count(F.lit(1)).alias("rows"))
    matched = rollup_matches(groups, group, rollups, key)
    per_group = matched.groupBy(group).agg(F.count(F.lit(1)).alias("matches"), F.min(key).alias("_only"))
    status = groups.join(per_group, group, "left").na.fill(0, ["matches"])
    observed = status.where("matches = 1").groupBy(F.col("_only").alias(key)).agg(F.sum("rows").alias("observed"))
    counts = rollups.select(key, expected).join(observed, key, "left").na.fill(0, ["observed"])
    bad_groups = status.where("matches <> 1").select(group, "matches")
    bad_rows = rows.join(bad_groups, group)
    code = F.when(F.col("matches") == 0, "group_rollup_unmatched").otherwise("group_rollup_overlap")
    violations = bad_rows.select(
        code.alias("code"), F.concat(F.lit("group "), F.col(group)).alias("detail"),
        F.lit("inventory").alias("path"), F.col(row_key).cast("string").alias("row_key"),
    ).unionByName(
        violations_where(
            counts, F.col(expected) != F.col("observed"), "group_counts_mismatch",
            F.format_string("expected %d, observed %d", F.col(expected), F.col("observed")), "manifest", key,
        )
    )
    return counts, violations
