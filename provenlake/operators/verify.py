"""Pairing solutions with their puzzle bytes and attaching verdicts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.canonical import artifact_id, object_key, verification_id
from .checks import rule_violations, unique_key_violations, union_all, violations_where

VERDICT = (
    "parse_status string, simulation_status string, cost bigint, cycles bigint, area bigint, "
    "instructions bigint, vanilla_constructible boolean, record_eligible boolean, "
    "error_code string, error_detail string"
)
VERIFICATION_COLUMNS = [
    "verification_id", "puzzle_artifact_id", "solution_id", "verifier_implementation", "verifier_revision",
    "verifier_sha256", "validation_profile", "parse_status", "simulation_status", "cost", "cycles", "area",
    "instructions", "vanilla_constructible", "record_eligible", "error_code", "error_detail",
]


@dataclass(frozen=True)
class VerifierIdentity:
    verifier_implementation: str
    verifier_revision: str
    verifier_sha256: str | None
    validation_profile: str

    def columns(self) -> dict[str, Column]:
        return {k: F.lit(v).cast("string") for k, v in self.__dict__.items()}


def artifact_violations(artifacts: DataFrame, kind: str, path: str) -> DataFrame:
    """Artifact rows whose kind, format, id or object key does not follow from their digest."""
    rules = {
        f"expected {kind} artifact": F.col("artifact_kind") == kind,
        f"expected {kind} format": F.col("artifact_format") == kind,
        "sha256 is invalid": F.col("sha256").rlike(fixed.SHA256_PATTERN),
        "identity does not match sha256": F.col("artifact_id") == artifact_id(F.lit(kind), F.col("sha256")),
        "object key does not match sha256": F.col("object_key") == object_key(F.col("sha256")),
    }
    return rule_violations(artifacts, rules, path, "artifact_id", "artifact_invalid")


def pair_exactly_one(left: DataFrame, right: DataFrame, key: str, facts: list[str]) -> DataFrame:
    """Left rows with the single right row of their key.

    ``matches`` is 0, 1 or 2 (two or more); the facts are set only when it is 1.
    The right side is reduced to one row per key before the join, so the guard
    and the pairing share one shuffle and a crowded key cannot multiply rows.
    """
    # A single fact is aggregated as it is: a number then stays in a hash aggregate.
    tuple_ = F.struct(*facts) if len(facts) > 1 else F.col(facts[0])
    one = right.groupBy(key).agg(F.min(tuple_).alias("_f"), F.count(F.lit(1)).alias("_n"))
    joined = left.join(one, key, "left")
    matches = F.least(F.coalesce("_n", F.lit(0)), F.lit(2)).cast("int")
    return joined.select(
        *left.columns, matches.alias("matches"),
        *[F.when(F.col("_n") == 1, F.col(f"_f.{f}" if len(facts) > 1 else "_f")).alias(f) for f in facts],
    )


def pair_violations(paired: DataFrame, row_key: str, key: str) -> DataFrame:
    return union_all(
        [
            violations_where(paired, F.col("matches") == 0, "no_puzzle_artifact", F.col(key), "solutions", row_key),
            violations_where(
                paired, F.col("matches") > 1, "multiple_puzzle_artifacts", F.col(key), "solutions", row_key
            ),
        ]
    )


def run_verifier(
    inputs: DataFrame, identity: VerifierIdentity, verify: Callable[[bytes, bytes], dict]
) -> DataFrame:
    """Call a pluggable verifier on (puzzle_bytes, solution_bytes) inside Spark tasks.

    inputs: puzzle_artifact_id, solution_id, puzzle_bytes, solution_bytes.
    ``verify`` returns the verdict fields of one pair.
    """
    names = [part.split()[0] for part in VERDICT.split(", ")]

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            verdicts = [
                {n: v.get(n) for n in names}
                for v in map(verify, batch["puzzle_bytes"], batch["solution_bytes"])
            ]
            rows = pd.DataFrame(verdicts, columns=names).astype(object)
            rows = rows.where(rows.notna(), None)
            rows.insert(0, "solution_id", batch["solution_id"].to_numpy())
            rows.insert(0, "puzzle_artifact_id", batch["puzzle_artifact_id"].to_numpy())
            for metric in ("cost", "cycles", "area", "instructions"):
                rows[metric] = rows[metric].astype("Int64")
            yield rows

    verdicts = inputs.select("puzzle_artifact_id", "solution_id", "puzzle_bytes", "solution_bytes").mapInPandas(
        call, f"puzzle_artifact_id string, solution_id string, {VERDICT}"
    )
    return with_identity(verdicts, identity)


def with_identity(verdicts: DataFrame, identity: VerifierIdentity) -> DataFrame:
    """Verification rows from bare verdicts (a verifier's output or a supplied table)."""
    named = verdicts.withColumns(identity.columns())
    return named.withColumn(
        "verification_id",
        verification_id(
            F.col("puzzle_artifact_id"), F.col("solution_id"), F.col("verifier_implementation"),
            F.col("verifier_revision"), F.col("verifier_sha256"), F.col("validation_profile"),
        ),
    ).select(*VERIFICATION_COLUMNS)


def join_verdicts(paired: DataFrame, verdicts: DataFrame, identity: VerifierIdentity) -> DataFrame:
    """Verification rows from a supplied verdict table keyed by solution id."""
    return with_identity(paired.select("puzzle_artifact_id", "solution_id").join(verdicts, "solution_id"), identity)


def verification_rules() -> dict[str, Column]:
    metrics = ["cost", "cycles", "area", "instructions"]
    return {
        "verification_id does not match its inputs": F.col("verification_id")
        == verification_id(
            F.col("puzzle_artifact_id"), F.col("solution_id"), F.col("verifier_implementation"),
            F.col("verifier_revision"), F.col("verifier_sha256"), F.col("validation_profile"),
        ),
        "puzzle_artifact_id is empty": F.length("puzzle_artifact_id") > 0,
        "solution_id is empty": F.length("solution_id") > 0,
        "verifier_implementation is empty": F.length("verifier_implementation") > 0,
        "verifier_revision is empty": F.length("verifier_revision") > 0,
        "verifier_sha256 is invalid": F.col("verifier_sha256").isNull()
        | F.col("verifier_sha256").rlike(fixed.SHA256_PATTERN),
        "validation_profile is empty": F.length("validation_profile") > 0,
        "parse_status is unknown": F.col("parse_status").isin(fixed.STATUSES),
        "simulation_status is unknown": F.col("simulation_status").isin(fixed.STATUSES),
        **{f"{m} is negative": F.col(m).isNull() | (F.col(m) >= 0) for m in metrics},
    }


def verification_violations(
    verifications: DataFrame, inputs: DataFrame | None = None, profile: str | None = None
) -> DataFrame:
    """Schema, identity, uniqueness and lineage of verification rows.

    inputs: the (solution_id, puzzle_artifact_id) pairs that were verified.
    """
    rules = verification_rules()
    if profile is not None:
        rules["validation_profile differs"] = F.col("validation_profile") == profile
    found = [
        rule_violations(verifications, rules, "verifications", "solution_id", "verification_invalid"),
        unique_key_violations(verifications, "verification_id", "verifications"),
    ]
    if inputs is not None:
        asked = inputs.select("solution_id", F.col("puzzle_artifact_id").alias("_asked"))
        joined = verifications.select("solution_id", "puzzle_artifact_id").join(asked, "solution_id", "full_outer")
        found.append(
            violations_where(
                joined, ~F.col("puzzle_artifact_id").eqNullSafe(F.col("_asked")), "verification_lineage",
                "result does not belong to its input", "verifications", "solution_id",
            )
        )
    return union_all(found)


def parsed_only(artifacts: DataFrame, verifications: DataFrame) -> DataFrame:
    """Solution artifacts whose verification parsed."""
    parsed = verifications.where("parse_status = 'passed'").select(F.col("solution_id").alias("artifact_id"))
    return artifacts.join(parsed, "artifact_id", "left_semi")
