"""Recorded-output evaluation: outputs to attempts, results and a report."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.binary import decode_solutions
from ..functions.canonical import canonical_json
from ..operators import evaluation as ev
from ..operators import verify
from ..operators.checks import assert_clean, multiset_difference, union_all
from ..operators.digest import published_sha256
from ..operators.eligibility import derive_eligibility, eligibility_violations, executable_inventory, required_bytes_violations
from ..session import checkpointed


@dataclass(frozen=True)
class Evaluation:
    eligibility: DataFrame
    attempts: DataFrame
    results: DataFrame
    report: DataFrame


def check_eligibility(supplied: DataFrame, derived: DataFrame) -> None:
    """A supplied eligibility table must be exactly the one the facts give."""
    if multiset_difference(derived, supplied.select(*derived.columns)).take(1):
        raise ValueError("eligibility differs from the one derived from the facts")


def evaluation_identities(
    spark, collection_id: str, manifest_sha256: str, inventory_sha256: str, verifier: verify.VerifierIdentity,
    budget: int, system: Mapping[str, str | None], harness: Mapping[str, str],
) -> tuple[DataFrame, DataFrame]:
    """Identity rows of one evaluation and one run (see ``identity_rows``)."""
    benchmark = {
        "protocol_version": fixed.PROTOCOL_VERSION,
        "collection_id": collection_id,
        "collection_manifest_sha256": manifest_sha256,
        "puzzle_serializer": fixed.PUZZLE_TEXT_SERIALIZER,
        "puzzle_serializer_version": fixed.PUZZLE_TEXT_SERIALIZER_VERSION,
        "candidate_output_compiler": fixed.CANDIDATE_COMPILER,
        "candidate_output_compiler_version": fixed.CANDIDATE_COMPILER_VERSION,
        **verifier.__dict__,
        "attempt_profile": fixed.ATTEMPT_PROFILE,
        "attempt_budget": budget,
        "scoring_version": fixed.SCORING_VERSION,
        "executable_inventory_sha256": inventory_sha256,
    }
    return ev.identity_rows(spark, benchmark, {**system, **harness})


def evaluate_outputs(
    outputs: DataFrame, inventory: DataFrame, definitions: DataFrame, artifacts: DataFrame, provenance: DataFrame,
    payloads: DataFrame, collection_id: str, manifest_sha256: str, inventory_sha256: str,
    verifier_identity: verify.VerifierIdentity, verifier: Callable[[bytes, bytes], dict], budget: int,
    system: Mapping[str, str | None], harness: Mapping[str, str],
) -> Evaluation:
    """Evaluate recorded outputs of one run.

    outputs: puzzle_id, attempt_index, raw_output and the three counters.
    inventory: the inventory columns and row_no.  payloads: artifact_id, content.
    Outputs beyond the budget or after a success are not attempts; every
    executable puzzle must have at least one.
    """
    spark = outputs.sparkSession
    assert_clean(eligibility_violations(inventory, definitions, artifacts, provenance))
    eligibility = checkpointed(derive_eligibility(inventory, definitions, artifacts, provenance))
    assert_clean(required_bytes_violations(eligibility, payloads))
    inventory_hash, _ = executable_inventory(eligibility, inventory, collection_id, inventory_sha256)
    identity, runs = evaluation_identities(
        spark, collection_id, manifest_sha256, inventory_hash, verifier_identity, budget, system, harness
    )
    benchmark_id, run_id = identity.first()["benchmark_id"], runs.first()["run_id"]

    executable = eligibility.where("eligible").select("puzzle_id", F.col("selected_puzzle_artifact_id").alias("puzzle_artifact_id")).join(
        inventory.select("puzzle_id", "game_puzzle_id"), "puzzle_id"
    )
    asked = outputs.where(F.col("attempt_index") <= budget).join(executable, "puzzle_id")
    key = F.concat_ws("\u001f", "puzzle_id", F.col("attempt_index").cast("string"))
    compiled = checkpointed(ev.compile_outputs(asked).withColumn("attempt_key", key))
    decoded = decode_solutions(compiled.where("solution_bytes IS NOT NULL"), "attempt_key", "solution_bytes").select(
        "attempt_key", F.col("parsed.puzzle_name").alias("puzzle_name"), F.col("error").alias("parse_error")
    )
    staged = checkpointed(compiled.join(decoded, "attempt_key", "left"))
    bound = F.col("puzzle_name") == F.col("game_puzzle_id")
    ready = staged.where(bound).select(
        F.concat(F.lit(fixed.SOLUTION_PREFIX), "candidate_sha256").alias("solution_id"), "puzzle_artifact_id",
        "solution_bytes",
    ).dropDuplicates(["solution_id", "puzzle_artifact_id"])
    inputs = ready.join(payloads.select(F.col("artifact_id").alias("puzzle_artifact_id"), F.col("content").alias("puzzle_bytes")), "puzzle_artifact_id")
    verifications = checkpointed(verify.run_verifier(inputs, verifier_identity, verifier))
    assert_clean(verify.verification_violations(verifications, None, verifier_identity.validation_profile))
    verdict = verifications.withColumn("verdict", ev.verification_outcome(F.col("parse_status"), F.col("simulation_status")))
    judged = (
        staged.withColumn("solution_id", F.when(bound, F.concat(F.lit(fixed.SOLUTION_PREFIX), "candidate_sha256")))
        .join(verdict.select("solution_id", "puzzle_artifact_id", "verification_id", *ev.METRICS, "error_code", "verdict"), ["solution_id", "puzzle_artifact_id"], "left")
        .withColumn("outcome", ev.attempt_outcome(F.col("compile_error"), F.col("parse_error"), bound, F.col("verdict")))
        .withColumn("benchmark_id", F.lit(benchmark_id))
        .withColumn("run_id", F.lit(run_id))
    )
    attempts = checkpointed(ev.effective_attempts(ev.project_attempts(judged), budget))
    series = ev.attempt_series(attempts)
    results = ev.puzzle_results(attempts, budget)
    assert_clean(
        union_all(
            [
                ev.attempt_violations(attempts), ev.series_violations(series, budget),
                ev.rebuilt_result_violations(results), ev.expected_puzzle_violations(executable, results),
            ]
        )
    )
    lines = results.select("puzzle_id", F.concat(canonical_json(results), F.lit("\n")).alias("line"))
    digest = published_sha256(lines, [F.col("puzzle_id")])
    report = ev.report_json(ev.run_report(attempts), identity, runs, digest)
    return Evaluation(eligibility, attempts, results, report)
