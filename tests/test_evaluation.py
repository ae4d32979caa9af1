"""Recorded-output evaluation with the five-outcome fixture, eligibility and attempt rules."""

import base64
import hashlib
import json
import struct

import pytest
from pyspark.sql import functions as F

from provenlake.functions import fixed_values as fixed
from provenlake.functions.nested import puzzle_text
from provenlake.operators import checks, eligibility, evaluation, verify
from provenlake.operators.reconcile import reconcile_definitions
from provenlake.plans.evaluation import check_eligibility, evaluate_outputs

VERIFIER = verify.VerifierIdentity(
    "omsim-libverify", "758f4a4b4c9e24f50294801da774a0960c922bab", "f" * 64, "omsim-libverify-v1"
)
SYSTEM = {"system_id": "hermetic-fixture-solver", "system_revision": "v1", "generation_config_sha256": "1" * 64}
HARNESS = {"harness_implementation": "provenlake-evaluation", "harness_revision": "1"}
COLLECTION = "solve-benchmark-hermetic-v1"
ARTIFACTS = (
    "artifact_kind string, artifact_id string, puzzle_id string, sha256 string, byte_length bigint, artifact_format string, "
    "rights_status string, object_key string"
)
PROVENANCE = (
    "artifact_id string, puzzle_id string, source_role string, source_id string, source_revision string, source_path string, "
    "source_object_id string, observed_sha256 string"
)


def py_json(value):
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def solution(name):
    raw = name.encode()
    return struct.pack("<I", 7) + bytes([len(raw)]) + raw + b"\x07fixture" + struct.pack("<II", 0, 0)


def envelope(data):
    return json.dumps({"format": "om-solution-base64-v1", "solution_base64": base64.b64encode(data).decode()}, separators=(",", ":"))


OUTPUTS = [
    "not-json", envelope(b"not-a-solution"), envelope(solution("WRONG")), envelope(solution("FX004")), envelope(solution("FX005")), None,
]


def simulate(puzzle_bytes, solution_bytes):
    if puzzle_bytes == b"fixture-puzzle-4":
        return {"parse_status": "passed", "simulation_status": "failed", "error_code": "simulation_failed"}
    return {"parse_status": "passed", "simulation_status": "passed", "cost": 10, "cycles": 20, "area": 30, "instructions": 40}


def fixture(spark, seed=0):
    rows = [
        {
            "puzzle_id": f"om.puzzle.{i:04d}", "display_name": f"Hermetic Puzzle {i}", "kind": "fixture", "group": "hermetic-solve-v0.1",
            "game_puzzle_id": f"FX{i:03d}", "leaderboard_key": f"FIXTURE_{i}", "puzzle_type": "normal",
        }
        for i in range(1, 7)
    ]
    inventory_sha = sha(py_json(rows).encode())
    manifest_sha = sha(py_json({"collection_id": COLLECTION, "inventory_sha256": inventory_sha, "test_only": True}).encode())
    inventory = spark.createDataFrame([{**r, "row_no": i} for i, r in enumerate(rows, 1)])
    atom = '[{"atoms":[{"atom_type":"salt","q":0,"r":0}],"bonds":[]}]'
    values = {
        "allowed_parts": '["arm1"]', "allowed_instructions": '["grab"]', "reagents": atom, "products": atom, "output_scale": "1",
        "target_output_count": "6", "production": "false", "production_constraints": "null",
    }
    claims = spark.createDataFrame(
        [(r["puzzle_id"], ["o"], None, f, v) for r in rows for f, v in values.items()],
        "puzzle_id string, observation_ids array<string>, puzzle_artifact_id string, field string, value_json string",
    )
    definitions = reconcile_definitions(inventory.select("puzzle_id"), claims).definitions.repartition(3 + seed)
    payloads = {f"om.puzzle.{i:04d}": f"fixture-puzzle-{i}".encode() for i in range(1, 6)}
    artifacts = spark.createDataFrame(
        [("puzzle", fixed.PUZZLE_ARTIFACT_PREFIX + sha(b), p, sha(b), len(b), "puzzle", "local_fetch_only", "k") for p, b in payloads.items()], ARTIFACTS
    )
    provenance = artifacts.select(
        "artifact_id", "puzzle_id", F.lit("artifact").alias("source_role"), F.lit("hermetic-test-fixture").alias("source_id"),
        F.lit("v1").alias("source_revision"), F.col("puzzle_id").alias("source_path"), F.col("puzzle_id").alias("source_object_id"),
        F.col("sha256").alias("observed_sha256"),
    )
    content = spark.createDataFrame([(fixed.PUZZLE_ARTIFACT_PREFIX + sha(b), bytearray(b)) for b in payloads.values()], "artifact_id string, content binary")
    outputs = spark.createDataFrame(
        [(f"om.puzzle.{i:04d}", 1, raw, 1, 10, 5) for i, raw in enumerate(OUTPUTS, 1) if raw],
        "puzzle_id string, attempt_index int, raw_output string, model_calls bigint, input_tokens bigint, output_tokens bigint",
    )
    return outputs, inventory, definitions, artifacts, provenance, content, manifest_sha, inventory_sha


def run(spark, seed=0, outputs=None, budget=1):
    recorded, inventory, definitions, artifacts, provenance, content, manifest_sha, inventory_sha = fixture(spark, seed)
    return evaluate_outputs(
        recorded if outputs is None else outputs, inventory, definitions, artifacts, provenance, content, COLLECTION, manifest_sha,
        inventory_sha, VERIFIER, simulate, budget, SYSTEM, HARNESS,
    )


def test_five_outcomes_and_published_identity(spark):
    done = run(spark)
    rows = {r.puzzle_id: r for r in done.attempts.collect()}
    assert [rows[k].outcome for k in sorted(rows)] == fixed.OUTCOMES
    assert [rows[k].error_code for k in sorted(rows)] == ["not_json", "solution_parse_failed", "puzzle_solution_mismatch", "simulation_failed", None]
    assert (rows["om.puzzle.0005"].cost, rows["om.puzzle.0004"].cost) == (10, None)
    last = {r.puzzle_id: r for r in done.eligibility.collect()}["om.puzzle.0006"]
    assert not last.eligible and last.exclusion_reason == "missing_exact_artifact"
    report = json.loads(done.report.first().report)
    assert report["benchmark"]["benchmark_id"] == "om.benchmark.5353e1b9f652afe92a500ed7d33ff68568ef84bbb5b02622785eb5fb0f8d019d"
    assert report["outcome_counts"] == dict.fromkeys(fixed.OUTCOMES, 1)
    assert (report["puzzle_count"], report["solved_count"], report["verifier_calls"], report["input_tokens"]) == (5, 1, 2, 50)
    assert done.report.first().report == py_json(report)
    again = run(spark, seed=2)
    assert again.report.first().report_sha256 == done.report.first().report_sha256
    results = {r.puzzle_id: r for r in done.results.collect()}
    assert results["om.puzzle.0005"].solved and results["om.puzzle.0005"].first_success_attempt == 1


def test_budget_stops_at_success(spark):
    good = envelope(solution("FX005"))
    rows = [(f"om.puzzle.{i:04d}", 1, "x", 1, None, 5) for i in range(1, 5)]
    rows += [("om.puzzle.0005", 1, "x", 1, 1, 1), ("om.puzzle.0005", 2, good, 1, 1, 1), ("om.puzzle.0005", 3, good, 1, 1, 1), ("om.puzzle.0001", 2, "y", 1, 1, 1), ("om.puzzle.0001", 3, "y", 1, 1, 1), ("om.puzzle.0001", 4, good, 1, 1, 1)]
    outputs = spark.createDataFrame(rows, fixture(spark)[0].schema)
    done = run(spark, outputs=outputs, budget=3)
    indexes = {}
    for r in done.attempts.collect():
        indexes.setdefault(r.puzzle_id, []).append(r.attempt_index)
    assert sorted(indexes["om.puzzle.0005"]) == [1, 2] and sorted(indexes["om.puzzle.0001"]) == [1, 2, 3]
    report = json.loads(done.report.first().report)
    assert report["input_tokens"] is None and report["output_tokens"] == 24 and report["attempt_count"] == 8


def test_missing_outputs_fail(spark):
    outputs = fixture(spark)[0].where("puzzle_id <> 'om.puzzle.0002'")
    with pytest.raises(checks.ChecksFailed, match="run_coverage_mismatch"):
        run(spark, outputs=outputs)


def test_supplied_eligibility_must_match(spark):
    _, inventory, definitions, artifacts, provenance, *_ = fixture(spark)
    derived = eligibility.derive_eligibility(inventory, definitions, artifacts, provenance)
    check_eligibility(derived, derived)
    with pytest.raises(ValueError):
        check_eligibility(derived.withColumn("eligible", F.lit(True)), derived)


def test_selection_and_reasons(spark):
    inventory = spark.createDataFrame([("p1", "normal"), ("p2", "normal"), ("p3", "normal"), ("p4", "polymer_width"), ("p5", "normal")], "puzzle_id string, puzzle_type string")
    definitions = spark.createDataFrame([(p, "d" + p) for p in ("p1", "p2", "p3", "p4")], "puzzle_id string, puzzle_definition_id string")
    ids = [("p1", "a"), ("p1", "b"), ("p1", "c"), ("p3", "d"), ("p4", "e")]
    artifacts = spark.createDataFrame([("puzzle", fixed.PUZZLE_ARTIFACT_PREFIX + i * 64, p, i * 64, 1, "puzzle", "unknown", "k") for p, i in ids], ARTIFACTS)
    seen = [("p1", "a", "elsewhere"), ("p1", "b", "omsim"), ("p1", "c", "omsim"), ("p1", "c", "another"), ("p4", "e", "official-game")]
    provenance = spark.createDataFrame(
        [(fixed.PUZZLE_ARTIFACT_PREFIX + i * 64, p, "artifact", s, "r", "x", None, i * 64) for p, i, s in seen]
        + [(fixed.PUZZLE_ARTIFACT_PREFIX + "d" * 64, "p3", "evidence", "official-game", "r", "x", None, "d" * 64)], PROVENANCE,
    )
    got = {r.puzzle_id: r for r in eligibility.derive_eligibility(inventory, definitions, artifacts, provenance).collect()}
    assert got["p1"].selected_puzzle_artifact_sha256 == "b" * 64 and got["p1"].selected_source_ids == ["omsim"]
    assert {k: r.exclusion_reason for k, r in got.items()} == {
        "p1": None, "p2": "missing_exact_artifact", "p3": "no_verifier_usable_artifact", "p4": "protocol_incompatible", "p5": "missing_semantic_definition",
    }
    assert eligibility.eligibility_violations(inventory, definitions, artifacts, provenance).collect() == []
    bad = provenance.unionByName(provenance).withColumn("observed_sha256", F.lit("z"))
    codes = {r.code for r in eligibility.eligibility_violations(inventory.where("puzzle_id <> 'p4'"), definitions, artifacts, bad).collect()}
    assert codes == {"provenance_repeated", "provenance_other_bytes", "definition_outside_collection", "artifact_outside_collection"}


def test_envelopes(spark):
    good = envelope(b"data")
    cases = {
        "x": "not_json", "": "not_json", good: None, " \n" + good + " ": None, good + "{}": "trailing_material", "[1]": "invalid_envelope", '"s"': "invalid_envelope",
        '{"format":"a"}': "invalid_envelope", '{"format":1,"solution_base64":"YQ=="}': "invalid_envelope",
        '{"format":"x","solution_base64":"YQ==","more":1}': "invalid_envelope", '{"format":"x","format":"y","solution_base64":"YQ=="}': "duplicate_field",
        '{"format":{"a":1,"a":2},"solution_base64":"YQ=="}': "duplicate_field", '{"format":"x","format":"y"': "not_json",
        '{"a":{"b":1,"b":2},': "duplicate_field", '{"format":"x","solution_base64":"YQ=="}': "unsupported_format",
        '{"format":"om-solution-base64-v1","solution_base64":""}': "empty_candidate", '{"format":"om-solution-base64-v1","solution_base64":"YQ"}': "invalid_base64",
        '{"format":"om-solution-base64-v1","solution_base64":"YR=="}': "noncanonical_base64", '{"format":"om-solution-base64-v1","solution_base64":"é"}': "invalid_base64",
    }
    df = spark.createDataFrame([(k,) for k in cases], "raw_output string")
    got = {r.raw_output: r for r in evaluation.compile_outputs(df).collect()}
    assert {k: r.compile_error for k, r in got.items()} == cases
    assert bytes(got[good].solution_bytes) == b"data" and got[good].candidate_sha256 == sha(b"data")


@pytest.mark.parametrize(
    "change,rule",
    [
        ({}, None), ({"outcome": "won"}, "outcome is unknown"), ({"attempt_index": 0}, "attempt_index must be at least 1"),
        ({"candidate_sha256": None}, "candidate hash must be present exactly after compilation"), ({"verifier_calls": 0}, "verifier lineage does not fit the outcome"),
        ({"cost": None}, "metrics must be present exactly on success"), ({"error_code": "x"}, "success carries an error code"), ({"model_calls": -1}, "model_calls is negative"),
        ({"outcome": "simulation_failed"}, "metrics must be present exactly on success"),
    ],
)
def test_attempt_rules(spark, change, rule):
    row = {"puzzle_id": "p", "attempt_index": 1, "outcome": "success", "candidate_sha256": "c", "verification_id": "v", "verifier_calls": 1, "error_code": None, "model_calls": 1, "input_tokens": None, "output_tokens": None, **dict.fromkeys(evaluation.METRICS, 1), **change}
    ddl = ", ".join(f"{k} {'string' if k in ('puzzle_id', 'outcome', 'candidate_sha256', 'verification_id', 'error_code') else 'bigint'}" for k in row)
    found = {r.detail for r in evaluation.attempt_violations(spark.createDataFrame([row], ddl)).collect()}
    assert (rule in found) if rule else not found


def test_series(spark):
    rows = [("a", 1, False), ("a", 2, True), ("b", 2, False), ("c", 1, True), ("c", 2, False), ("d", 1, False), ("d", 1, False), ("e", 1, False), ("e", 2, False), ("e", 3, False)]
    df = spark.createDataFrame([("r", p, i, "success" if ok else "simulation_failed") for p, i, ok in rows], "run_id string, puzzle_id string, attempt_index int, outcome string")
    series = evaluation.attempt_series(df)
    found = {(r.code, r.row_key) for r in evaluation.series_violations(series, 2).collect()}
    assert found == {("attempts_not_contiguous", "b"), ("attempts_not_contiguous", "d"), ("attempts_after_success", "c"), ("attempt_budget_exceeded", "e")}
    assert {r.puzzle_id: r.first_success_attempt for r in series.collect()}["a"] == 2


def test_model_text(spark):
    definitions = fixture(spark)[2].where("puzzle_id = 'om.puzzle.0001'")
    text = definitions.select(puzzle_text(definitions.schema)).first()[0]
    lines = text.split("\n")
    assert lines[0] == fixed.PUZZLE_TEXT_HEADER and lines[-1] == "" and len(lines) == 12
    assert lines[3] == 'allowed_parts=["arm1"]' and lines[10] == "production_constraints=null"
    assert lines[5] == 'reagents=[{"atoms":[{"atom_type":"salt","q":0,"r":0}],"bonds":[]}]'


def test_no_envelope_stops_the_job(spark):
    body = base64.b64encode(b"x").decode()
    good = json.dumps({"format": fixed.CANDIDATE_FORMAT, "solution_base64": body})
    texts = {
        "plain": good, "swapped": f' {{"solution_base64":"{body}" , "format" : "{fixed.CANDIDATE_FORMAT}"}}\n', "escaped": good.replace("format", "\\u0066ormat"),
        "surrogate format": '{"format": "\\ud800", "solution_base64": "eA=="}', "surrogate body": '{"format": "%s", "solution_base64": "\\ud800"}' % fixed.CANDIDATE_FORMAT,
        "non-ascii body": '{"format": "%s", "solution_base64": "é"}' % fixed.CANDIDATE_FORMAT, "many": "{" + ",".join(f'"k{i}":1' for i in range(20000)) + "}",
        "twice": good[:-1] + ', "format": "x"}', "trailing": good + " x", "vertical tab": good.replace("{", "{\x0b"), "null": None, "empty": "", "list": "[1]",
    }
    rows = {r.k: r for r in evaluation.compile_outputs(spark.createDataFrame(list(texts.items()), "k string, raw_output string")).collect()}
    assert {k: r.compile_error for k, r in rows.items()} == {
        "plain": None, "swapped": None, "escaped": None, "surrogate format": "unsupported_format", "surrogate body": "invalid_base64",
        "non-ascii body": "invalid_base64", "many": "invalid_envelope", "twice": "duplicate_field", "trailing": "trailing_material",
        "vertical tab": "not_json", "null": "not_json", "empty": "not_json", "list": "invalid_envelope",
    }
    assert all(bytes(rows[k].solution_bytes) == b"x" for k in ("plain", "swapped", "escaped"))
