"""Release build, validation and the whole batch pipeline."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.binary import decode_solutions
from ..operators import checks, coverage, digest, release, verify
from ..operators.checks import assert_clean, multiset_difference, union_all
from ..operators.normalize import normalize_solutions
from ..session import checkpointed, settled
from ..sources import sinks
from ..sources.files import content_table
from ..sources.tables import SCHEMA_DDL, read_release_parquet, release_schema, row_json
from .facts import coverage_gate, puzzle_facts, solution_facts


# How table digests are made, named in the manifest.
DIGEST_NAME = "sha256-word-sums"


def schema_sha256(table: str) -> str:
    return hashlib.sha256(SCHEMA_DDL[table].encode()).hexdigest()


def json_sha256(value: object) -> str:
    """Hash of the canonical JSON of a small value."""
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, default=str)
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def source_digest(spark: SparkSession, path: str) -> str:
    """Identity of a file or folder of lines: the multiset of (file name, line).

    Lines are hashed where they are read, so files of any size are split over tasks;
    the order of lines, which no release table depends on, does not count.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("name"), "value")
    return digest.multiset_digest(lines, row_json=F.concat("name", F.lit("\u0000"), "value")).first()["digest"]


def source_violations(spark: SparkSession, folder: str, sources: dict[str, str]) -> list[tuple[str, str]]:
    """(code, table) of sources that are not those the manifest of a release commits to."""
    tables = sinks.read_json_record(spark, f"{folder}/release-manifest.json")["tables"]
    return [("source_changed", t) for t, path in sources.items() if tables.get(t, {}).get("source_digest") != source_digest(spark, path)]


def logical_release_hash(manifest: dict) -> str:
    """Hash of the manifest without physical file hashes and without itself."""
    logical = {k: v for k, v in manifest.items() if k != "logical_release_sha256"}
    logical["tables"] = {
        name: {k: v for k, v in entry.items() if k != "parquet_sha256"} for name, entry in manifest["tables"].items()
    }
    text = json.dumps(logical, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def table_digest(df: DataFrame, table: str) -> dict:
    """Row count and multiset digest of a table's canonical rows."""
    row = digest.multiset_digest(df, row_json=row_json(df, table)).first()
    return {"row_count": row["row_count"], "records_digest": row["digest"], "digest": DIGEST_NAME}


def shard_digests(spark: SparkSession, folder: str, paths: list[str]) -> dict[str, str]:
    """SHA-256 of each shard file, computed on the executors."""
    files = spark.read.format("binaryFile").load([f"{folder}/{p}" for p in paths])
    rows = files.select(F.regexp_extract("path", r"(data/.*)$", 1).alias("p"), F.sha2("content", 256).alias("h"))
    return {r["p"]: r["h"] for r in rows.take(len(paths))}


def release_violations(
    tables: dict[str, DataFrame], inventory: DataFrame, collection_id: str, payload_policy: str, coverage_policy: str
) -> DataFrame:
    """Every gate of a release over its four tables."""
    if coverage_policy not in fixed.COVERAGE_POLICIES:
        raise ValueError(f"unknown coverage policy {coverage_policy!r}")
    by_key = coverage.coverage_by_key(inventory, tables["solutions"], "puzzle_id", F.col("verified"))
    return union_all(
        [
            release.table_violations(tables),
            *[checks.unique_key_violations(df, fixed.RELEASE_TABLES[t][0], t) for t, df in tables.items()],
            release.payload_violations(tables["solutions"], "solution_bytes", payload_policy, "solutions", "solution_id"),
            release.collection_violations(tables, collection_id),
            release.integrity_violations(tables),
            coverage.coverage_violations(inventory, tables["puzzles"], by_key, "puzzle_id", coverage_policy),
        ]
    )


def build_release(
    spark: SparkSession, tables: dict[str, DataFrame], inventory: DataFrame, folder: str, collection_id: str,
    metadata: dict, payload_policy: str = "metadata-only", coverage_policy: str = "complete", shards: int | None = None,
    config: dict | None = None, sources: dict[str, str] | None = None,
) -> dict:
    """Check, write and describe a release; returns its manifest.

    The manifest commits to what the release was made from: ``config`` (settings of the
    build, any JSON value), ``metadata``, and ``sources`` (table: path of its JSON lines).

    Totals of the coverage go into the manifest, coverage per puzzle into its own
    table, so the manifest stays one small record at any inventory size.
    """
    assert_clean(release_violations(tables, inventory, collection_id, payload_policy, coverage_policy))
    split = collection_id.replace("-", "_")
    entries = {}
    for table, df in tables.items():
        paths = sinks.write_release_parquet(df, table, folder, split, shards)
        stored = read_release_parquet(spark, folder, table)
        entries[table] = {
            "schema_sha256": schema_sha256(table),
            "parquet_paths": paths,
            "parquet_sha256": shard_digests(spark, folder, paths),
            **table_digest(stored, table),
            **({"source_path": os.path.basename(sources[table].rstrip("/")), "source_digest": source_digest(spark, sources[table])} if sources else {}),
        }
    solutions, verified = tables["solutions"], F.col("verified")
    by_key = coverage.coverage_by_key(inventory, solutions, "puzzle_id", verified)
    by_key.write.mode("errorifexists").parquet(f"{folder}/coverage")
    totals = coverage.coverage_totals(tables["puzzles"], solutions, verified).first().asDict()
    inventory_row = digest.multiset_digest(inventory.select(*fixed.INVENTORY_HEADER)).first()
    manifest = {
        "format_version": fixed.RELEASE_FORMAT_VERSION,
        "collection_id": collection_id,
        "collection_inventory_digest": inventory_row["digest"],
        "split": split,
        "payload_policy": payload_policy,
        "coverage_policy": coverage_policy,
        "release_metadata": {**metadata, "coverage": totals},
        "release_metadata_sha256": json_sha256({**metadata, "coverage": totals}),
        "build_config_sha256": json_sha256(config or {}),
        "tables": entries,
    }
    manifest["logical_release_sha256"] = logical_release_hash(manifest)
    sinks.write_json_record(spark, manifest, f"{folder}/release-manifest.json")
    return manifest


def validate_release(spark: SparkSession, folder: str, inventory: DataFrame, collection_id: str) -> list[tuple[str, str]]:
    """Read a release back and compare everything with its manifest: (code, path) pairs."""
    manifest = sinks.read_json_record(spark, f"{folder}/release-manifest.json")
    found: list[tuple[str, str]] = []
    if manifest.get("format_version") != fixed.RELEASE_FORMAT_VERSION:
        return [("release_manifest_format_unsupported", "release-manifest.json")]
    if manifest["collection_id"] != collection_id:
        found.append(("collection_mismatch", "release-manifest.json"))
    if manifest["collection_inventory_digest"] != digest.multiset_digest(inventory.select(*fixed.INVENTORY_HEADER)).first()["digest"]:
        found.append(("collection_hash_mismatch", "release-manifest.json"))
    if set(manifest["tables"]) != set(fixed.RELEASE_TABLES):
        return [*found, ("release_configs_invalid", "release-manifest.json")]
    if json_sha256(manifest["release_metadata"]) != manifest["release_metadata_sha256"]:
        found.append(("release_metadata_hash_mismatch", "release-manifest.json"))
    if logical_release_hash(manifest) != manifest["logical_release_sha256"]:
        found.append(("logical_release_hash_mismatch", "release-manifest.json"))
    tables = {}
    for table, entry in manifest["tables"].items():
        if entry["schema_sha256"] != schema_sha256(table):
            found.append(("schema_changed", table))
            continue
        paths = entry["parquet_paths"]
        if any(p.startswith("/") or ".." in p.split("/") for p in paths):
            found.append(("release_manifest_path_unsafe", table))
            continue
        try:
            hashes = shard_digests(spark, folder, paths)
        except Exception:  # noqa: BLE001 - a missing shard surfaces as an analysis error
            found.append(("parquet_missing", table))
            continue
        if hashes != entry["parquet_sha256"]:
            found.append(("parquet_hash_mismatch", table))
            continue
        stored = read_release_parquet(spark, folder, table)
        facts = table_digest(stored, table)
        found += [(code, table) for code, key in (("records_hash_mismatch", "records_digest"), ("row_count_mismatch", "row_count")) if facts[key] != entry[key]]
        tables[table] = stored
    if set(tables) == set(fixed.RELEASE_TABLES):
        bad = release_violations(tables, inventory, collection_id, manifest["payload_policy"], manifest["coverage_policy"])
        found += [(r["code"], r["path"]) for r in bad.select("code", "path").distinct().orderBy("code", "path").toLocalIterator()]
        totals = coverage.coverage_totals(tables["puzzles"], tables["solutions"], F.col("verified")).first().asDict()
        if totals != manifest["release_metadata"].get("coverage"):
            found.append(("release_coverage_mismatch", "release-manifest.json"))
        by_key = coverage.coverage_by_key(inventory, tables["solutions"], "puzzle_id", F.col("verified"))
        if multiset_difference(by_key, spark.read.parquet(f"{folder}/coverage").select(*by_key.columns)).take(1):
            found.append(("release_coverage_mismatch", "coverage"))
    return found


def derived_metadata(tables: dict[str, DataFrame], verifications: DataFrame) -> dict:
    """Verifier identity, normalizer version and source classes of a release (each at most one)."""
    assert_clean(release.identity_violations(verifications, tables["normalized"]))
    first = verifications.select("verifier_revision", "verifier_sha256", "validation_profile").take(1)
    version = tables["normalized"].select("normalizer_version").take(1)
    # One entry per pair of source and role, as the manifest lists them.
    classes = release.source_classes(tables["observations"]).toLocalIterator()
    return {
        **(first[0].asDict() if first else dict.fromkeys(["verifier_revision", "verifier_sha256", "validation_profile"])),
        "normalizer_version": version[0][0] if version else None,
        "source_classes": [r.asDict() for r in classes],
    }


def materialize_release_tables(
    inventory: DataFrame, definitions: DataFrame, puzzle_artifacts: DataFrame, solution_artifacts: DataFrame,
    observations: DataFrame, verifications: DataFrame, normalized: DataFrame, collection_id: str,
    payload_policy: str = "metadata-only", objects: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The four release tables, after every projection gate has passed."""
    assert_clean(
        release.materialization_violations(
            inventory, definitions, puzzle_artifacts, solution_artifacts, observations, verifications, normalized
        )
    )
    tables = {
        "puzzles": release.puzzle_rows(definitions, inventory, collection_id),
        "solutions": release.solution_rows(
            solution_artifacts, verifications, normalized, observations, collection_id, objects, payload_policy
        ),
        "observations": observations,
        "normalized": normalized,
    }
    return {t: df.select(*[f.name for f in release_schema(t).fields]) for t, df in tables.items()}


def run_pipeline(
    receipts: DataFrame, objects: DataFrame, inventory: DataFrame, collection_id: str, identity: verify.VerifierIdentity,
    verdicts: DataFrame | None = None, verifier: Callable[[bytes, bytes], dict] | None = None,
    payload_policy: str = "metadata-only", external_claims: DataFrame | None = None,
    external_observations: DataFrame | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Receipts and objects to the four release tables; also returns the verifications.

    Verdicts come from a supplied table (solution_id + verdict) or from a verifier
    called inside tasks.  Python stages are checkpointed, so losing an executor
    later repeats neither decoding nor verification.  The objects are read once, into a
    table bucketed by digest that every step meets by key.
    """
    objects = content_table(objects)
    puzzles = puzzle_facts(receipts, objects, inventory, external_claims, external_observations)
    solutions = solution_facts(receipts, objects, inventory)
    assert_clean(union_all([puzzles.violations, solutions.violations, coverage_gate(puzzles)]))

    paired = verify.pair_exactly_one(
        solutions.artifacts.select(F.col("artifact_id").alias("solution_id"), "puzzle_id", "sha256"),
        puzzles.artifacts.select("puzzle_id", F.col("artifact_id").alias("puzzle_artifact_id"), F.col("sha256").alias("puzzle_sha256")),
        "puzzle_id", ["puzzle_artifact_id", "puzzle_sha256"],
    )
    (paired,) = settled(paired)
    assert_clean(verify.pair_violations(paired, "solution_id", "puzzle_id"))
    if verdicts is not None:
        verifications = verify.join_verdicts(paired, verdicts, identity)
    elif verifier is not None:
        inputs = paired.join(objects.select("sha256", F.col("content").alias("solution_bytes")), "sha256").join(
            objects.select(F.col("sha256").alias("puzzle_sha256"), F.col("content").alias("puzzle_bytes")), "puzzle_sha256"
        )
        verifications = verify.run_verifier(inputs, identity, verifier)
    else:
        raise ValueError("a verdict table or a verifier is needed")
    verifications = checkpointed(verifications)
    assert_clean(verify.verification_violations(verifications, paired, identity.validation_profile))

    parsed = verify.parsed_only(solutions.artifacts, verifications)
    payloads = parsed.select("artifact_id", "puzzle_id", "sha256").join(objects.select("sha256", "content"), "sha256")
    decoded = decode_solutions(payloads).join(parsed.select("artifact_id", "puzzle_id"), "artifact_id")
    shapes = checkpointed(decoded)
    (normalized,) = settled(normalize_solutions(shapes))
    rejected = shapes.select("artifact_id", F.col("error")).unionByName(
        normalized.select(F.col("solution_id").alias("artifact_id"), "error")
    )
    assert_clean(
        checks.violations_where(
            rejected, F.col("error").isNotNull(), "normalization_failed", F.col("error"), "solutions", "artifact_id"
        )
    )
    tables = materialize_release_tables(
        inventory, puzzles.definitions, puzzles.artifacts, solutions.artifacts,
        puzzles.observations.unionByName(solutions.observations), verifications, normalized.drop("error"),
        collection_id, payload_policy, objects,
    )
    return tables, verifications


def same_tables(first: dict[str, DataFrame], second: dict[str, DataFrame]) -> bool:
    """Rebuild determinism: both builds hold the same multiset of canonical rows."""
    for table in fixed.RELEASE_TABLES:
        a = first[table].select(row_json(first[table], table).alias("row"))
        b = second[table].select(row_json(second[table], table).alias("row"))
        if multiset_difference(a, b).take(1):
            return False
    return True
