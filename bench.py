"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

Each query is planned and run once to warm the JVM and the file cache, then timed
on a second run.  Results are fully computed (every column of every row) and
discarded.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from provenlake.queries import QUERIES  # noqa: E402
from provenlake.session import local_session  # noqa: E402

HEADLINE = [
    "coverage_by_key", "coverage_report", "referential_integrity", "exact_dedup", "provenance_rows", "fd_conflicts",
    "duplicate_keys_first_seen", "canonical_json_ids", "canonical_order", "multiset_digest", "path_pairing",
    "claims_from_json", "claim_reconciliation", "array_reference", "exactly_one_pairing", "catalog_reconcile",
    "molecule_canonical", "string_sets", "text_serialization", "compile_outputs", "decode_solutions",
    "normalize_solutions", "decode_puzzles", "priority_selection", "attempt_rollup", "run_report", "rebuild_diff",
    "idempotent_append", "pareto_frontier", "best_known",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus), app="provenlake-bench")
    times = {}
    for name in HEADLINE:
        run(QUERIES[name](spark, sf_dir))
        start = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(sf)}
        )
    )


if __name__ == "__main__":
    main()
