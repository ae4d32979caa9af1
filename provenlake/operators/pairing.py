"""Mapping landed files to the inventory and pairing metadata with solutions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.canonical import lookup, row_id
from .checks import union_all, violations_where

METRICS = ["cost", "cycles", "area", "instructions"]
OBSERVATION_COLUMNS = [
    "observation_id", "artifact_kind", "artifact_id", "puzzle_id", "source_role", "source_id",
    "source_revision", "source_object_id", "source_path", "associated_artifact_path",
    "source_declared_puzzle_id", "source_url", "author", "claimed_cost", "claimed_cycles",
    "claimed_area", "claimed_instructions", "observed_sha256", "source_evidence_sha256",
    "source_evidence_byte_length", "rights_status", "importer_version",
]


# --- path expressions ------------------------------------------------------------------


def posix(path: Column) -> Column:
    """Path text with empty and ``.`` segments and a trailing slash removed."""
    kept = F.array_join(
        F.filter(F.split(path, "/"), lambda s: (s != "") & (s != ".")), "/"
    )
    return F.when(path.startswith("/"), F.concat(F.lit("/"), kept)).otherwise(kept)


def parent(path: Column) -> Column:
    inner = F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    return F.when(inner == "", F.lit(".")).otherwise(inner)


def suffix(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/]+(\.[^./]+)$", 1)


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]+)?$", 1)


def joined(base: Column, relative: Column) -> Column:
    return F.when((base == ".") | (base == ""), relative).otherwise(F.concat_ws("/", base, relative))


# --- layouts ---------------------------------------------------------------------------


def archive_directory(group: Column) -> Column:
    """Upstream directory of a group in the solution archive; null when not kept there."""
    prefix = "journal-xcix-"
    issue = F.regexp_extract(group, rf"^{prefix}(.+)$", 1)
    journal = F.when(
        issue.isin(fixed.ARCHIVE_JOURNAL_ISSUES),
        F.concat(F.lit(fixed.JOURNAL_GROUP_DIRECTORIES[prefix]), F.upper(issue)),
    )
    return F.coalesce(lookup(group, fixed.CAMPAIGN_DIRECTORIES), journal)


def leaderboard_directory(group: Column) -> Column:
    """Upstream directory of a group on the leaderboard; null when not kept there."""
    found = [lookup(group, fixed.CAMPAIGN_DIRECTORIES)]
    for prefix, target in fixed.JOURNAL_GROUP_DIRECTORIES.items():
        issue = F.regexp_extract(group, rf"^{prefix}(.+)$", 1)
        found.append(
            F.when(issue.isin(fixed.LEADERBOARD_JOURNAL_ISSUES), F.concat(F.lit(target), F.upper(issue)))
        )
    return F.coalesce(*found)


def source_layout(inventory: DataFrame, group_directory: Callable[[Column], Column]) -> DataFrame:
    """(directory, puzzle_id) for the inventory rows a source keeps."""
    return (
        inventory.withColumn("_group_dir", group_directory(F.col("group")))
        .where(F.col("_group_dir").isNotNull())
        .select(F.concat_ws("/", "_group_dir", "leaderboard_key").alias("directory"), "puzzle_id")
    )


def mapped_receipts(
    receipts: DataFrame, layout: DataFrame, wanted: str, path: str = "upstream_path"
) -> DataFrame:
    """Receipts whose parent directory is in the layout and whose suffix is ``wanted``.

    The suffix test runs before the join.  The layout joins without a hint: at
    its usual few hundred rows it is broadcast by size, and a larger one is
    shuffled.
    """
    kept = receipts.where(suffix(F.col(path)) == wanted).withColumn("directory", parent(F.col(path)))
    return kept.join(layout, "directory").drop("directory")


def landing_counts(mapped: DataFrame) -> DataFrame:
    """Candidates and distinct puzzles covered, per source."""
    return mapped.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("candidate_count"), F.count_distinct("puzzle_id").alias("puzzles_covered")
    )


# --- metadata claims -------------------------------------------------------------------


_METADATA_NODES = {
    "score": "$.score", "dataLink": "$.dataLink", "displayLink": "$.displayLink", "puzzle": "$.puzzle",
    "dataPath": "$.dataPath", **{m: f"$.score.{m}" for m in METRICS},
}


def read_metadata(df: DataFrame, json: str) -> DataFrame:
    """Claims of one metadata document per row; ``error`` marks the ones that do not fit.

    Adds claimed_cost.. claimed_instructions, source_url, source_declared_puzzle_id,
    data_path and error.  The document is parsed once; the type of each token is
    taken from it, so a boolean, a quoted number, a fraction or a negative number
    is an error and not a silent cast.
    """
    parsed = df.withColumn("_doc", F.try_parse_json(json))
    nodes = parsed.withColumns(
        {
            "_shape": F.schema_of_variant("_doc"),
            **{f"_{n}": F.try_variant_get("_doc", path, "variant") for n, path in _METADATA_NODES.items()},
        }
    )
    kinds = nodes.withColumns(
        {
            **{f"_{n}_kind": F.coalesce(F.schema_of_variant(f"_{n}"), F.lit("VOID")) for n in _METADATA_NODES},
            **{f"_{m}_value": F.try_variant_get(f"_{m}", "$", "bigint") for m in METRICS},
            **{
                f"_{n}_text": F.try_variant_get(f"_{n}", "$", "string")
                for n in ("dataLink", "displayLink", "puzzle", "dataPath")
            },
        }
    )

    def absent(name: str) -> Column:
        return F.col(f"_{name}_kind") == "VOID"

    def bad_text(name: str) -> Column:
        return ~absent(name) & ((F.col(f"_{name}_kind") != "STRING") | (F.col(f"_{name}_text") == ""))

    bad_metric = reduce(
        lambda a, b: a | b,
        [
            ~absent(m) & ((F.col(f"_{m}_kind") != "BIGINT") | (F.coalesce(f"_{m}_value", F.lit(-1)) < 0))
            for m in METRICS
        ],
    )
    path = F.col("_dataPath_text")
    bad_path = bad_text("dataPath") | F.coalesce(
        path.startswith("/") | path.rlike(r"(^|/)\.\.(/|$)") | (suffix(posix(path)) != ".solution"), F.lit(False)
    )
    # The second link matters only when the first is absent.
    bad_link = bad_text("dataLink") | (absent("dataLink") & bad_text("displayLink"))
    error = (
        F.when(F.col("_doc").isNull(), "invalid_json")
        .when(~F.col("_shape").startswith("OBJECT"), "not_an_object")
        .when(bad_path, "invalid_data_path")
        .when(bad_text("puzzle"), "invalid_puzzle")
        .when(~absent("score") & ~F.col("_score_kind").startswith("OBJECT"), "invalid_score")
        .when(bad_metric, "invalid_metric")
        .when(bad_link, "invalid_link")
    )
    return kinds.select(
        *df.columns,
        *[F.col(f"_{m}_value").alias(f"claimed_{m}") for m in METRICS],
        F.coalesce("_dataLink_text", "_displayLink_text").alias("source_url"),
        F.col("_puzzle_text").alias("source_declared_puzzle_id"),
        posix(path).alias("data_path"),
        error.alias("error"),
    )


# --- pairing ---------------------------------------------------------------------------


def pair_by_path(metadata: DataFrame, solutions: DataFrame, layout: DataFrame) -> DataFrame:
    """Pair metadata rows with the solution their ``data_path`` names.

    metadata: metadata_path, puzzle_id, data_path + anything.
    solutions: solution_path (unique), solution_puzzle_id + anything.
    layout: directory, puzzle_id.

    The path may be meant from the root or from the metadata's own directory:
    two equi-joins on the solution path instead of one join on either.  Adds
    ``resolved_path``, ``pair_error`` and the solution's columns (null when
    unpaired).
    """
    declared = F.col("data_path")
    base = metadata.withColumn("_relative", joined(parent(F.col("metadata_path")), declared))
    owners = layout.select(F.col("directory").alias("_dir"), F.col("puzzle_id").alias("_declared_puzzle"))
    base = base.withColumn("_dir", parent(declared)).join(owners, "_dir", "left")

    facts = [c for c in solutions.columns if c != "solution_path"]
    by_root = solutions.select(
        F.col("solution_path").alias("data_path"), F.lit(True).alias("_root_hit"),
        F.struct(*facts).alias("_root"),
    )
    by_relative = solutions.select(
        F.col("solution_path").alias("_relative"), F.lit(True).alias("_relative_hit"),
        F.struct(*facts).alias("_own"),
    )
    hit = base.join(by_root, "data_path", "left").join(by_relative, "_relative", "left")
    at_root = F.coalesce(F.col("_root_hit"), F.lit(False))
    at_own = F.coalesce(F.col("_relative_hit"), F.lit(False)) & (F.col("_relative") != F.col("data_path"))
    hit = hit.withColumn("_match", F.when(at_root, F.col("_root")).when(at_own, F.col("_own")))
    other_declared = F.coalesce(F.col("_declared_puzzle") != F.col("puzzle_id"), F.lit(False))
    other_target = F.coalesce(F.col("_match.solution_puzzle_id") != F.col("puzzle_id"), F.lit(False))
    resolved = (
        F.when(at_root, F.col("data_path"))
        .when(at_own, F.col("_relative"))
        .when(F.col("_declared_puzzle").isNotNull(), F.col("data_path"))
        .otherwise(F.col("_relative"))
    )
    error = (
        F.when(other_declared, "data_path_other_puzzle")
        .when(at_root & at_own, "data_path_ambiguous")
        .when(other_target, "data_path_other_puzzle")
    )
    return hit.select(
        *metadata.columns,
        F.when(declared.isNotNull(), resolved).alias("resolved_path"),
        error.alias("pair_error"),
        *[F.when(error.isNull(), F.col(f"_match.{f}")).alias(f) for f in facts],
    )


# --- observations ----------------------------------------------------------------------


def with_observation_id(body: DataFrame) -> DataFrame:
    """Add the content id of an observation body and put the columns in order."""
    plain = body.drop("observation_id")
    return plain.withColumn("observation_id", row_id(plain, fixed.OBSERVATION_PREFIX)).select(
        *OBSERVATION_COLUMNS
    )


def observations_from_provenance(
    provenance: DataFrame, kind: str, importer: str, contexts: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Observations of provenance rows, and the rows whose role is not supported.

    ``contexts`` (source_path, associated_artifact_path, source_declared_puzzle_id)
    is joined to evidence rows; without it the declared puzzle is the source
    object id.
    """
    role = F.when(F.col("source_role") == "artifact", "artifact").when(
        F.col("source_role") == "evidence", "metadata"
    )
    known = provenance.where(F.col("source_role").isin("artifact", "evidence"))
    if contexts is None:
        rows = known.withColumn("associated_artifact_path", F.lit(None).cast("string")).withColumn(
            "source_declared_puzzle_id", F.col("source_object_id")
        )
        lost = None
    else:
        is_evidence = F.col("source_role") == "evidence"
        rows = known.withColumn("_context_path", F.when(is_evidence, F.col("source_path"))).join(
            contexts.select(
                F.col("source_path").alias("_context_path"), "associated_artifact_path",
                "source_declared_puzzle_id", F.lit(True).alias("_has_context"),
            ),
            "_context_path", "left",
        )
        lost = violations_where(
            rows, is_evidence & F.col("_has_context").isNull(), "missing_metadata_context",
            F.col("source_path"), "provenance", "artifact_id",
        )
        rows = rows.drop("_context_path", "_has_context")
    bad = violations_where(
        provenance, ~F.coalesce(F.col("source_role").isin("artifact", "evidence"), F.lit(False)),
        "unsupported_role", F.coalesce(F.col("source_role"), F.lit("None")), "provenance", "artifact_id",
    )
    body = rows.select(
        F.lit(kind).alias("artifact_kind"), "artifact_id", "puzzle_id", role.alias("source_role"),
        "source_id", "source_revision", "source_object_id", "source_path", "associated_artifact_path",
        "source_declared_puzzle_id", "source_url", "author", "claimed_cost", "claimed_cycles",
        "claimed_area", "claimed_instructions", "observed_sha256", "source_evidence_sha256",
        "source_evidence_byte_length", "rights_status", F.lit(importer).alias("importer_version"),
    )
    return with_observation_id(body), bad if lost is None else union_all([bad, lost])


def unpaired_observations(unpaired: DataFrame, importer: str) -> DataFrame:
    """Observations of metadata that names no landed solution (artifact id null)."""
    null = F.lit(None).cast("string")
    body = unpaired.select(
        F.lit("solution").alias("artifact_kind"), null.alias("artifact_id"), "puzzle_id",
        F.lit("metadata").alias("source_role"), "source_id", F.col("revision").alias("source_revision"),
        null.alias("source_object_id"), F.col("metadata_path").alias("source_path"),
        F.col("resolved_path").alias("associated_artifact_path"), "source_declared_puzzle_id",
        "source_url", null.alias("author"), "claimed_cost", "claimed_cycles", "claimed_area",
        "claimed_instructions", null.alias("observed_sha256"), F.col("sha256").alias("source_evidence_sha256"),
        F.col("byte_length").alias("source_evidence_byte_length"), "rights_status",
        F.lit(importer).alias("importer_version"),
    )
    return with_observation_id(body)


def distinct_observations(frames: list[DataFrame]) -> DataFrame:
    """Union of observation tables, one row per id (equal ids are equal rows)."""
    return union_all(frames).dropDuplicates(["observation_id"])


@dataclass(frozen=True)
class SolutionFacts:
    artifacts: DataFrame
    observations: DataFrame
    violations: DataFrame
