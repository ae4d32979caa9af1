"""Recorded outputs to attempts, puzzle results and run reports."""

from __future__ import annotations

import json
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from ..functions import fixed_values as fixed
from ..functions.canonical import base64_code, canonical_json, canonical_json_of, content_id, json_object, sha256_hex
from .checks import rule_violations, set_difference, union_all, violations_where
from .ordering import global_row_number

METRICS = ["cost", "cycles", "area", "instructions"]
COUNTERS = ["model_calls", "input_tokens", "output_tokens"]
ATTEMPT_COLUMNS = [
    "benchmark_id", "run_id", "puzzle_id", "attempt_index", "outcome", "candidate_sha256", "verification_id",
    *METRICS, "error_code", *COUNTERS, "verifier_calls",
]
# Fields of the two evaluation identities (fixed values).
BENCHMARK_FIELDS = [
    "protocol_version", "collection_id", "collection_manifest_sha256", "puzzle_serializer",
    "puzzle_serializer_version", "candidate_output_compiler", "candidate_output_compiler_version",
    "verifier_implementation", "verifier_revision", "verifier_sha256", "validation_profile",
    "attempt_profile", "attempt_budget", "scoring_version", "executable_inventory_sha256",
]
RUN_FIELDS = [
    "benchmark_id", "system_id", "system_revision", "harness_implementation", "harness_revision",
    "generation_config_sha256",
]


# --- recorded output envelopes ---------------------------------------------------------


_ENVELOPE = T.StructType([T.StructField(n, T.StringType()) for n in ("code", "format", "body")])


# The ordinary envelope, decided without Python: two plain string fields in either order, no escapes, nothing else.
_PLAIN = r'"([^"\\\x00-\x1f]*)"'
_ORDINARY = (
    r'^\s*\{[ \t\n\r]*"format"[ \t\n\r]*:[ \t\n\r]*' + _PLAIN + r'[ \t\n\r]*,[ \t\n\r]*"solution_base64"[ \t\n\r]*:[ \t\n\r]*' + _PLAIN + r"[ \t\n\r]*\}\s*$",
    r'^\s*\{[ \t\n\r]*"solution_base64"[ \t\n\r]*:[ \t\n\r]*' + _PLAIN + r'[ \t\n\r]*,[ \t\n\r]*"format"[ \t\n\r]*:[ \t\n\r]*' + _PLAIN + r"[ \t\n\r]*\}\s*$",
)


@pandas_udf(_ENVELOPE)
def read_envelope(raw: pd.Series) -> pd.DataFrame:
    """Strict reading of one JSON envelope per value (duplicate names, trailing text).

    Strings that no table can hold (lone surrogates) become the code that a wrong
    format or body gets, so one record never stops a job.
    """

    def storable(text):
        try:
            text.encode("utf-8")
        except UnicodeEncodeError:
            return False
        return True

    def read(text):
        if not isinstance(text, str):
            return "not_json", None, None
        repeated = []

        def once(pairs):
            names = [name for name, _ in pairs]
            if len(set(names)) < len(names):
                repeated.append(True)
            return dict(pairs)

        start = text.lstrip()
        try:
            value, stop = json.JSONDecoder(object_pairs_hook=once).raw_decode(start)
        except (ValueError, RecursionError):
            return ("duplicate_field" if repeated else "not_json"), None, None
        if repeated:
            return "duplicate_field", None, None
        if start[stop:].strip():
            return "trailing_material", None, None
        fields = value if isinstance(value, dict) else {}
        if set(fields) != {"format", "solution_base64"} or not all(isinstance(v, str) for v in fields.values()):
            return "invalid_envelope", None, None
        if not storable(fields["format"]):
            return "unsupported_format", None, None
        if not storable(fields["solution_base64"]):
            return ("invalid_base64" if fields["format"] == fixed.CANDIDATE_FORMAT else "unsupported_format"), None, None
        return None, fields["format"], fields["solution_base64"]

    return pd.DataFrame([read(t) for t in raw], columns=["code", "format", "body"])


def compile_outputs(outputs: DataFrame, raw: str = "raw_output") -> DataFrame:
    """Add compile_error, solution_bytes and candidate_sha256 to recorded outputs.

    Exactly one of compile_error and solution_bytes is set.
    """
    first, second = _ORDINARY
    text = F.col(raw)
    # Only what the two patterns do not settle goes to Python; the other rows pass a null there.
    ordinary = F.coalesce(text.rlike(first) | text.rlike(second), F.lit(False))
    marked = outputs.withColumn("_ordinary", ordinary)
    parsed = marked.withColumn("_e", read_envelope(F.when(~F.col("_ordinary"), text)))
    swapped = text.rlike(second)
    read = parsed.select(
        *outputs.columns,
        F.when(~F.col("_ordinary"), F.col("_e.code")).alias("_code"),
        F.when(F.col("_ordinary"), F.when(swapped, F.regexp_extract(text, second, 2)).otherwise(F.regexp_extract(text, first, 1)))
        .otherwise(F.col("_e.format")).alias("_format"),
        F.when(F.col("_ordinary"), F.when(swapped, F.regexp_extract(text, second, 1)).otherwise(F.regexp_extract(text, first, 2)))
        .otherwise(F.col("_e.body")).alias("_body"),
    )
    # Decoding, judging and hashing are separate projections, so each runs once.
    decoded = read.withColumn("_raw", F.try_to_binary("_body", F.lit("base64")))
    judged = decoded.withColumn(
        "compile_error",
        F.coalesce(
            F.col("_code"),
            F.when(F.col("_format") != fixed.CANDIDATE_FORMAT, "unsupported_format"),
            base64_code(F.col("_body"), F.col("_raw")),
        ),
    )
    payload = F.when(F.col("compile_error").isNull(), F.col("_raw"))
    return judged.select(
        *outputs.columns, "compile_error", payload.alias("solution_bytes"), F.sha2(payload, 256).alias("candidate_sha256")
    )


# --- attempts --------------------------------------------------------------------------


def verification_outcome(parse_status: Column, simulation_status: Column) -> Column:
    """Outcome of a verdict; null for a status outside the contract."""
    known = parse_status.isin("passed", "failed") & simulation_status.isin(fixed.STATUSES)
    return F.when(
        known,
        F.when(parse_status == "failed", "solution_parse_failed")
        .when(simulation_status == "passed", "success")
        .otherwise("simulation_failed"),
    )


def attempt_outcome(compile_error: Column, parse_error: Column, bound: Column, verdict: Column) -> Column:
    """Outcome of one attempt: the first stage that failed decides."""
    return (
        F.when(compile_error.isNotNull(), "output_compile_failed")
        .when(parse_error.isNotNull(), "solution_parse_failed")
        .when(~F.coalesce(bound, F.lit(False)), "puzzle_solution_mismatch")
        .otherwise(verdict)
    )


def project_attempts(rows: DataFrame) -> DataFrame:
    """Attempt rows: metrics only on success, an error code only on failure.

    rows: ids, outcome, stage errors (compile_error, parse_error), verdict columns
    (verification_id, metrics, error_code) and counters.
    """
    success = F.col("outcome") == "success"
    verified = F.col("verification_id").isNotNull()
    error = F.when(~success, F.coalesce("compile_error", F.when(verified, F.col("error_code")), "outcome"))
    return rows.select(
        "benchmark_id", "run_id", "puzzle_id", "attempt_index", "outcome", "candidate_sha256", "verification_id",
        *[F.when(success, F.col(m)).alias(m) for m in METRICS],
        error.alias("error_code"),
        *COUNTERS,
        verified.cast("bigint").alias("verifier_calls"),
    )


def attempt_rules() -> dict[str, Column]:
    """What an attempt row may carry, by outcome."""
    outcome = F.col("outcome")
    no_verifier = F.col("verification_id").isNull() & (F.col("verifier_calls") == 0)
    with_verifier = F.col("verification_id").isNotNull() & (F.col("verifier_calls") >= 1)
    present = [F.col(m).isNotNull() for m in METRICS]
    all_metrics = present[0] & present[1] & present[2] & present[3]
    any_metric = present[0] | present[1] | present[2] | present[3]
    compiled = outcome != "output_compile_failed"
    return {
        "outcome is unknown": outcome.isin(fixed.OUTCOMES),
        "attempt_index must be at least 1": F.col("attempt_index") >= 1,
        "candidate hash must be present exactly after compilation": compiled == F.col("candidate_sha256").isNotNull(),
        "verifier lineage does not fit the outcome": F.when(
            outcome.isin("output_compile_failed", "puzzle_solution_mismatch"), no_verifier
        ).when(outcome == "solution_parse_failed", no_verifier | with_verifier).otherwise(with_verifier),
        "metrics must be present exactly on success": F.when(outcome == "success", all_metrics).otherwise(~any_metric),
        "success carries an error code": (outcome != "success") | F.col("error_code").isNull(),
        **{f"{c} is negative": F.col(c).isNull() | (F.col(c) >= 0) for c in [*COUNTERS, *METRICS]},
    }


def attempt_violations(attempts: DataFrame, row_key: str = "puzzle_id") -> DataFrame:
    return rule_violations(attempts, attempt_rules(), "attempts", row_key, "attempt_invalid")


def effective_attempts(attempts: DataFrame, budget: int, keys: tuple[str, ...] = ("run_id", "puzzle_id")) -> DataFrame:
    """The attempts a bounded sequential run would have made: within budget, up to the first success."""
    within = attempts.where(F.col("attempt_index") <= budget)
    first = within.where("outcome = 'success'").groupBy(*keys).agg(F.min("attempt_index").alias("_first"))
    return within.join(first, list(keys), "left").where(
        F.col("_first").isNull() | (F.col("attempt_index") <= F.col("_first"))
    ).drop("_first")


def attempt_series(
    attempts: DataFrame, keys: tuple[str, ...] = ("run_id", "puzzle_id"), index: str = "attempt_index"
) -> DataFrame:
    """Per (run, puzzle): count, first success and the two order rules, from combined aggregates.

    Indexes are exactly 1..n when the lowest is 1, the highest is n and all are
    distinct; equal indexes are counted once by an aggregation on (keys, index)
    first.
    """
    success = F.col("outcome") == "success"
    per_index = attempts.groupBy(*keys, index).agg(
        F.count(F.lit(1)).alias("n"), F.max(success).alias("ok")
    )
    series = per_index.groupBy(*keys).agg(
        F.sum("n").alias("attempt_count"),
        F.count(F.lit(1)).alias("_distinct"),
        F.min(index).alias("_low"),
        F.max(index).alias("_high"),
        F.min(F.when(F.col("ok"), F.col(index))).alias("first_success_attempt"),
    )
    contiguous = (
        (F.col("_low") == 1) & (F.col("_high") == F.col("attempt_count")) & (F.col("_distinct") == F.col("attempt_count"))
    )
    after = F.coalesce(F.col("first_success_attempt") < F.col("_high"), F.lit(False))
    return series.select(
        *keys, "attempt_count", F.col("first_success_attempt").isNotNull().alias("solved"), "first_success_attempt",
        contiguous.alias("contiguous"), after.alias("attempts_after_success"),
    )


def series_violations(series: DataFrame, budget: int | None = None, row_key: str = "puzzle_id") -> DataFrame:
    found = [
        violations_where(series, ~F.col("contiguous"), "attempts_not_contiguous", "indexes must be 1..n", "attempts", row_key),
        violations_where(
            series, F.col("attempts_after_success"), "attempts_after_success", "work after the first success", "attempts", row_key
        ),
    ]
    if budget is not None:
        found.append(
            violations_where(
                series, F.col("attempt_count") > budget, "attempt_budget_exceeded", f"budget is {budget}", "attempts", row_key
            )
        )
    return union_all(found)


def puzzle_results(attempts: DataFrame, budget: int) -> DataFrame:
    """Result rows with their sorted attempts, for series that keep every rule.

    Only series proven to hold at most ``budget`` contiguous attempts are packed
    into rows; the others are reported by ``series_violations``.
    """
    keys = ("benchmark_id", "run_id", "puzzle_id")
    good = attempt_series(attempts, keys).where(
        F.col("contiguous") & ~F.col("attempts_after_success") & (F.col("attempt_count") <= budget)
    )
    record = F.struct(
        "attempt_index", *[c for c in ATTEMPT_COLUMNS if c != "attempt_index"],
        F.lit("attempt").alias("record_type"),
    )
    packed = attempts.join(good.select(*keys), list(keys), "left_semi").groupBy(*keys).agg(
        F.array_sort(F.collect_list(record)).alias("attempts")
    )
    return packed.join(good, list(keys)).select(
        F.lit("puzzle_result").alias("record_type"), *keys, "attempts", "solved", "first_success_attempt"
    )


def rebuilt_result_violations(results: DataFrame) -> DataFrame:
    """Results whose derived state does not follow from their attempts."""
    first = F.array_min(
        F.transform(F.filter("attempts", lambda a: a["outcome"] == "success"), lambda a: a["attempt_index"])
    )
    indexes = F.transform("attempts", lambda a: a["attempt_index"].cast("bigint"))
    size = F.size("attempts").cast("bigint")
    wrong = (
        (size == 0)
        | ~F.col("first_success_attempt").eqNullSafe(first)
        | (F.col("solved") != first.isNotNull())
        | (indexes != F.sequence(F.lit(1).cast("bigint"), F.greatest(size, F.lit(1))))
        | (first < size)
    )
    return violations_where(results, wrong, "result_inconsistent", "derived state differs", "puzzle_results", "puzzle_id")


# --- reports ---------------------------------------------------------------------------


def complete_sum(column: str) -> Column:
    """Sum that is null as soon as one value is unknown."""
    return F.when(F.count(column) == F.count(F.lit(1)), F.sum(column))


def outcome_counts(outcome: Column) -> dict[str, Column]:
    """A zero-filled count per known outcome."""
    return {o: F.count_if(F.coalesce(outcome == o, F.lit(False))) for o in fixed.OUTCOMES}


def run_report(attempts: DataFrame, keys: tuple[str, ...] = ("run_id",), puzzle: str = "puzzle_id") -> DataFrame:
    """Counts of a run.  Attempts are reduced per puzzle first, so a run with most rows stays cheap."""
    per_puzzle = attempts.groupBy(*keys, puzzle).agg(
        F.count(F.lit(1)).alias("attempts"),
        F.max(F.col("outcome") == "success").alias("solved"),
        *[c.alias(f"n_{o}") for o, c in outcome_counts(F.col("outcome")).items()],
        F.sum("verifier_calls").alias("verifier_calls"),
        *[complete_sum(c).alias(c) for c in COUNTERS],
    )
    solved = F.count_if(F.coalesce("solved", F.lit(False)))
    return per_puzzle.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("puzzle_count"),
        solved.alias("solved_count"),
        (F.count(F.lit(1)) - solved).alias("unsolved_count"),
        solved.alias("solve_rate_numerator"),
        F.count(F.lit(1)).alias("solve_rate_denominator"),
        F.sum("attempts").alias("attempt_count"),
        *[F.sum(f"n_{o}").alias(o) for o in fixed.OUTCOMES],
        F.sum("verifier_calls").alias("verifier_calls"),
        *[complete_sum(c).alias(c) for c in COUNTERS],
    )


def expected_puzzle_violations(expected: DataFrame, results: DataFrame) -> DataFrame:
    """Both differences between the puzzles a run had to attempt and those it reports."""
    sides = set_difference(expected, results, "puzzle_id")
    return violations_where(sides, F.lit(True), "run_coverage_mismatch", F.col("side"), "puzzle_results", "puzzle_id")


def _typed(fields: Mapping[str, object]) -> dict[str, Column]:
    return {k: F.lit(v) if v is not None else F.lit(None).cast("string") for k, v in fields.items()}


def identity_rows(spark, benchmark: Mapping[str, object], run: Mapping[str, object]) -> tuple[DataFrame, DataFrame]:
    """One-row tables of the evaluation identity and the run identity, each with its id.

    ``benchmark`` holds the 15 identity fields; ``run`` its fields without
    ``benchmark_id``, which is derived.
    """
    if set(benchmark) != set(BENCHMARK_FIELDS) or set(run) != set(RUN_FIELDS) - {"benchmark_id"}:
        raise ValueError("identity fields are incomplete or unknown")
    one = spark.range(1)
    columns = _typed(benchmark)
    identity = one.select(
        F.lit("benchmark_identity").alias("record_type"),
        content_id(fixed.BENCHMARK_PREFIX, columns).alias("benchmark_id"),
        *[columns[f].alias(f) for f in BENCHMARK_FIELDS],
    )
    run_columns = {**_typed(run), "benchmark_id": content_id(fixed.BENCHMARK_PREFIX, columns)}
    runs = one.select(
        F.lit("benchmark_run_identity").alias("record_type"),
        content_id(fixed.RUN_PREFIX, run_columns).alias("run_id"),
        *[run_columns[f].alias(f) for f in RUN_FIELDS],
    )
    return identity, runs


def report_json(report: DataFrame, identity: DataFrame, runs: DataFrame, results_sha256: str) -> DataFrame:
    """One canonical JSON report line per run row of ``report``."""
    benchmarks = identity.select("benchmark_id", canonical_json(identity).alias("_benchmark"))
    named = runs.select("run_id", "benchmark_id", canonical_json(runs).alias("_run")).join(benchmarks, "benchmark_id")
    counts = [
        "puzzle_count", "solved_count", "unsolved_count", "solve_rate_numerator", "solve_rate_denominator",
        "attempt_count", "verifier_calls", *COUNTERS,
    ]
    pieces = {c: F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in counts}
    pieces |= {
        "record_type": F.lit('"aggregate_report"'),
        "benchmark": F.col("_benchmark"),
        "run": F.col("_run"),
        "outcome_counts": canonical_json_of({o: F.col(o) for o in fixed.OUTCOMES}),
        "puzzle_results_sha256": F.lit(f'"{results_sha256}"'),
    }
    text = json_object(pieces)
    return report.join(named, "run_id").select("run_id", text.alias("report"), sha256_hex(text).alias("report_sha256"))


# --- extension views of the protocol ---------------------------------------------------


def solve_at_k(series: DataFrame, keys: tuple[str, ...], k: int) -> DataFrame:
    """Solved within one attempt and within k, and the median attempts to first success."""
    first = F.col("first_success_attempt")
    return series.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("puzzles"),
        F.count_if(F.coalesce(first <= 1, F.lit(False))).alias("solved_at_1"),
        F.count_if(F.coalesce(first <= k, F.lit(False))).alias(f"solved_at_{k}"),
        F.percentile(first, F.lit(0.5)).alias("median_attempts"),
    )


def resources_to_success(attempts: DataFrame, keys: tuple[str, ...] = ("run_id", "puzzle_id")) -> DataFrame:
    """Counters of solved puzzles summed up to their first success; null when one is unknown."""
    first = attempts.where("outcome = 'success'").groupBy(*keys).agg(F.min("attempt_index").alias("_first"))
    until = attempts.join(first, list(keys)).where(F.col("attempt_index") <= F.col("_first"))
    return until.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("attempts"), *[complete_sum(c).alias(c) for c in COUNTERS]
    )


def leaderboard(report: DataFrame, order: list[Column]) -> DataFrame:
    """Dense rank of report rows: the position of each distinct key tuple, lowest first.

    A key that ranks high values first is passed negated.
    """
    names = [f"_k{i}" for i in range(len(order))]
    keyed = report.select("*", *[c.alias(n) for c, n in zip(order, names, strict=True)])
    places = global_row_number(keyed.select(*names).distinct(), [F.col(n) for n in names], "rank")
    return keyed.join(places, names).drop(*names).withColumn("rank", F.col("rank").cast("int"))
