"""Landed receipts and objects to artifacts, definitions, observations and coverage."""

from __future__ import annotations

import tomllib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.binary import decode_puzzles
from ..functions.canonical import canonical_json_of, sha256_hex
from ..functions.nested import canonical_claims
from ..operators import pairing
from ..operators.checks import dependency_violations, missing_references, union_all, violations_where
from ..operators.coverage import not_ready, puzzle_coverage
from ..operators.ingest import RECEIPT, ingest_artifacts
from ..operators.pairing import (
    METRICS,
    SolutionFacts,
    distinct_observations,
    mapped_receipts,
    observations_from_provenance,
    pair_by_path,
    unpaired_observations,
)
from ..operators.reconcile import reconcile_checked, semantic_sources
from ..operators.semantics import artifact_claims, artifact_observation_links
from ..session import checkpointed, settled
from ..sources.files import landed_puzzle_fixtures, mapping_violations

RECEIPT_FIELDS = ["source_id", "revision", "upstream_path", "sha256", "byte_length", "rights_status", "retrieved_at"]
MANIFEST_NAME = "official-puzzles.toml"


@dataclass(frozen=True)
class PuzzleFacts:
    artifacts: DataFrame
    provenance: DataFrame
    definitions: DataFrame
    observations: DataFrame
    coverage: DataFrame
    violations: DataFrame


def _receipt(prefix: str = "") -> Column:
    return F.struct(*[F.col(f"{prefix}{f}").alias(f) for f in RECEIPT_FIELDS])


def candidates(
    rows: DataFrame, kind: str, evidence: Column | None = None, object_id: Column | None = None,
    source_url: Column | None = None, claims: dict[str, Column] | None = None,
) -> DataFrame:
    """Candidate rows from mapped receipts (receipt columns + puzzle_id)."""
    text, number = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    claimed = claims or {}
    return rows.select(
        F.lit(kind).alias("artifact_kind"),
        "puzzle_id",
        F.lit(kind).alias("artifact_format"),
        _receipt().alias("artifact_receipt"),
        (evidence if evidence is not None else F.lit(None).cast(RECEIPT)).alias("evidence_receipt"),
        (object_id if object_id is not None else text).alias("source_object_id"),
        (source_url if source_url is not None else text).alias("source_url"),
        text.alias("author"),
        *[claimed.get(m, number).cast("bigint").alias(f"claimed_{m}") for m in METRICS],
    )


# --- mapped puzzle sets ----------------------------------------------------------------


def read_mappings(manifests: DataFrame) -> DataFrame:
    """(revision, snapshot_id, puzzle_id, path, error) of manifest documents (revision, content).

    A document that cannot be read gives one row with its error.
    """

    def entries(revision, content):
        try:
            document = tomllib.loads(bytes(content).decode("utf-8"))
            return [(revision, str(document["snapshot_id"]), str(p["puzzle_id"]), str(p["path"]), None) for p in document["puzzles"]]
        except (ValueError, KeyError, TypeError, RecursionError) as exc:
            return [(revision, None, None, None, f"{type(exc).__name__}: {exc}"[:500].encode("utf-8", "replace").decode("utf-8"))]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for revision, content in zip(batch["revision"], batch["content"], strict=True):
                rows += entries(revision, content)
            yield pd.DataFrame(rows, columns=["revision", "snapshot_id", "puzzle_id", "path", "error"])

    return manifests.select("revision", "content").mapInPandas(
        read, "revision string, snapshot_id string, puzzle_id string, path string, error string"
    )


def source_revision(mapped: DataFrame) -> DataFrame:
    """(revision, expected_revision): commitment to the exact files of each mapped set.

    mapped: revision, snapshot_id, puzzle_id, upstream_path, sha256, byte_length.  One
    set is one manifest document, so its list is as bounded as that document.
    """
    entry = F.struct("puzzle_id", F.col("upstream_path").alias("path"), "sha256", "byte_length")
    listed = mapped.groupBy("revision").agg(
        F.array_sort(F.collect_list(entry)).alias("entries"), F.min("snapshot_id").alias("snapshot_id")
    )
    in_order = F.transform(
        "entries",
        lambda e: F.struct(
            e["path"].alias("path"), e["byte_length"].alias("payload_bytes"), e["sha256"].alias("payload_sha256"),
            e["puzzle_id"].alias("puzzle_id"),
        ),
    )
    body = canonical_json_of(
        {"format": F.lit(fixed.OFFICIAL_REVISION_FORMAT), "mappings": in_order, "snapshot_id": F.col("snapshot_id")}
    )
    return listed.select(
        "revision", F.concat(F.lit(fixed.LOCAL_REVISION_PREFIX), sha256_hex(body)).alias("expected_revision")
    )


def official_candidates(receipts: DataFrame, objects: DataFrame, inventory: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates of every cached mapped set with its manifest as evidence, and violations."""
    manifests = receipts.where(F.col("upstream_path") == MANIFEST_NAME)
    with_content = manifests.join(objects.select("sha256", "content"), "sha256")
    documents = checkpointed(read_mappings(with_content))
    mappings = documents.where("error IS NULL").drop("error").withColumn("upstream_path", pairing.posix(F.col("path")))
    mapped = mappings.join(receipts, ["revision", "upstream_path"])
    evidence = manifests.select("revision", _receipt().alias("manifest"))
    rows = candidates(mapped.join(evidence, "revision"), "puzzle", F.col("manifest"), F.col("puzzle_id"))
    per_set = ["revision", "upstream_path"]
    lost = mappings.join(receipts.select(*per_set), per_set, "left_anti")
    extra = receipts.where(F.col("upstream_path").endswith(".puzzle")).join(mappings.select(*per_set), per_set, "left_anti")
    no_manifest = missing_references(receipts.select("revision").distinct(), "revision", manifests, "revision")
    drifted = source_revision(mapped).where("revision <> expected_revision")
    path = "official"
    repeated = mappings.groupBy("revision", "puzzle_id").count().where("count > 1")
    same_file = mappings.groupBy(*per_set).count().where("count > 1")
    return rows, union_all(
        [
            violations_where(no_manifest, F.lit(True), "manifest_missing", "no cached manifest", path, "revision"),
            violations_where(documents.where("error IS NOT NULL"), F.lit(True), "manifest_unreadable", F.col("error"), path, "revision"),
            violations_where(lost, F.lit(True), "mapped_file_missing", F.col("upstream_path"), path, "revision"),
            violations_where(extra, F.lit(True), "file_unmapped", F.col("upstream_path"), path, "revision"),
            violations_where(drifted, F.lit(True), "source_revision_mismatch", F.col("expected_revision"), path, "revision"),
            violations_where(repeated, F.lit(True), "mapping_repeated", F.col("puzzle_id"), path, "revision"),
            violations_where(same_file, F.lit(True), "mapping_path_repeated", F.col("upstream_path"), path, "revision"),
            mapping_violations(mappings.select("puzzle_id", "path").distinct(), inventory).where("code NOT LIKE 'duplicate%'"),
        ]
    )


def puzzle_artifact_candidates(
    receipts: DataFrame, objects: DataFrame, inventory: DataFrame, fixture_source: str = "omsim",
    mapped_source: str = "official-game",
) -> tuple[DataFrame, DataFrame]:
    fixtures, bad_fixtures = landed_puzzle_fixtures(receipts.where(F.col("source_id") == fixture_source), inventory)
    official, bad_official = official_candidates(receipts.where(F.col("source_id") == mapped_source), objects, inventory)
    return candidates(fixtures, "puzzle").unionByName(official), bad_fixtures.unionByName(bad_official)


def puzzle_facts(
    receipts: DataFrame, objects: DataFrame, inventory: DataFrame,
    external_claims: DataFrame | None = None, external_observations: DataFrame | None = None,
) -> PuzzleFacts:
    """Artifacts, reconciled definitions, observations and coverage of the inventory.

    External claims (long form) and their observations join the decoded ones
    before reconciliation.  Every table that later steps read more than once is a
    stage boundary on files, so no step recomputes another.
    """
    found, bad = puzzle_artifact_candidates(receipts, objects, inventory)
    found, bad = settled(found, bad)
    ingested = ingest_artifacts(found, objects)
    artifacts, provenance = settled(ingested.artifacts, ingested.provenance)
    own, bad_roles = observations_from_provenance(provenance, "puzzle", fixed.PUZZLE_IMPORTER)
    (own,) = settled(own)
    links, bad_links = artifact_observation_links(artifacts, own)
    payloads = artifacts.join(objects.select("sha256", "content"), "sha256")
    (decoded,) = settled(decode_puzzles(payloads))
    claims, undecoded = artifact_claims(decoded, links)
    observations = own
    if external_claims is not None:
        claims = claims.unionByName(external_claims)
    if external_observations is not None:
        (observations,) = settled(distinct_observations([own, external_observations]))
    (checked,) = settled(canonical_claims(claims))
    reconciled = reconcile_checked(inventory, checked)
    (definitions,) = settled(reconciled.definitions)
    sources, bad_sources = semantic_sources(definitions, observations)
    coverage = puzzle_coverage(inventory, artifacts, provenance, definitions, sources)
    violations = [bad, ingested.violations, bad_roles, bad_links, undecoded, reconciled.violations, bad_sources]
    return PuzzleFacts(
        artifacts, provenance, definitions, observations, coverage, union_all(settled(*violations))
    )


def coverage_gate(facts: PuzzleFacts) -> DataFrame:
    """Violations that stop a release: puzzles without exactly one artifact."""
    return not_ready(facts.coverage)


# --- solutions -------------------------------------------------------------------------


def solution_facts(
    receipts: DataFrame, objects: DataFrame, inventory: DataFrame, archive_source: str = "om-archive",
    leaderboard_source: str = "om-leaderboard",
) -> SolutionFacts:
    """Solution artifacts and observations of both landed sources, metadata paired by path."""
    archive = receipts.where(F.col("source_id") == archive_source)
    board = receipts.where(F.col("source_id") == leaderboard_source)
    archive_layout = pairing.source_layout(inventory, pairing.archive_directory)
    board_layout = pairing.source_layout(inventory, pairing.leaderboard_directory)

    archive_solutions = mapped_receipts(archive, archive_layout, ".solution")
    board_solutions = mapped_receipts(board, board_layout, ".solution")
    metadata = mapped_receipts(board, board_layout, ".json")

    documents = metadata.join(objects.select("sha256", "content"), "sha256", "left")
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string"))
    texts = documents.select(
        F.col("upstream_path").alias("metadata_path"), *[c for c in metadata.columns if c != "upstream_path"], text.alias("text")
    )
    (read,) = settled(pairing.read_metadata(texts, "text").drop("text"))
    unreadable = violations_where(
        read, F.col("error").isNotNull(), "metadata_invalid", F.col("error"), "metadata", "metadata_path"
    )
    good = read.where("error IS NULL").drop("error")
    targets = board_solutions.select(
        F.col("upstream_path").alias("solution_path"), F.col("puzzle_id").alias("solution_puzzle_id"),
        _receipt().alias("solution_receipt"),
    )
    (paired,) = settled(pair_by_path(good, targets, board_layout))
    unpairable = violations_where(
        paired, F.col("pair_error").isNotNull(), "pairing_invalid", F.col("pair_error"), "metadata", "metadata_path"
    )
    clean = paired.where("pair_error IS NULL").withColumn("upstream_path", F.col("metadata_path"))
    matched = clean.where("solution_receipt IS NOT NULL")
    metadata_receipt = _receipt()
    with_evidence = matched.withColumn("evidence", metadata_receipt).drop(*RECEIPT_FIELDS)
    as_artifact = with_evidence.select("*", "solution_receipt.*")
    claimed = candidates(
        as_artifact, "solution", F.col("evidence"), None, F.col("source_url"),
        {m: F.col(f"claimed_{m}") for m in METRICS},
    )
    conflicts = dependency_violations(
        union_all([archive_solutions, board_solutions, metadata]), ["source_id", "revision", "upstream_path"],
        ["puzzle_id", "sha256", "byte_length", "rights_status", "retrieved_at"], "receipt_conflict", "receipts",
    )
    (found,) = settled(
        union_all([candidates(archive_solutions, "solution"), candidates(board_solutions, "solution"), claimed])
    )
    ingested = ingest_artifacts(found, objects)
    artifacts, provenance = settled(ingested.artifacts, ingested.provenance)
    contexts = clean.select(
        F.col("metadata_path").alias("source_path"), F.col("resolved_path").alias("associated_artifact_path"),
        "source_declared_puzzle_id",
    )
    observed, bad_roles = observations_from_provenance(provenance, "solution", fixed.SOLUTION_IMPORTER, contexts)
    unpaired = unpaired_observations(clean.where("solution_receipt IS NULL"), fixed.SOLUTION_IMPORTER)
    (observations,) = settled(distinct_observations([observed, unpaired]))
    violations = [unreadable, unpairable, conflicts, ingested.violations, bad_roles]
    return SolutionFacts(artifacts, observations, union_all(settled(*violations)))

