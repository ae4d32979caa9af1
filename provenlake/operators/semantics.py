"""Semantic claims from decoded puzzles and from external topology tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import nested
from ..functions.canonical import json_of, lookup
from .checks import packed, union_all, violations_where
from .pairing import with_observation_id


def _decoded_molecule(molecule: Column) -> Column:
    return F.struct(
        F.transform(
            molecule["atoms"],
            lambda a: F.struct(
                lookup(a["atom_type"], fixed.ATOM_TYPES).alias("atom_type"), a["q"].alias("q"), a["r"].alias("r")
            ),
        ).alias("atoms"),
        F.transform(
            molecule["bonds"],
            lambda b: F.struct(
                b["a_q"].alias("a_q"), b["a_r"].alias("a_r"), b["b_q"].alias("b_q"), b["b_r"].alias("b_r"),
                nested.bond_types(b["bond_type"]).alias("bond_types"),
            ),
        ).alias("bonds"),
    )


def _decoded_constraints(info: Column) -> Column:
    body = F.struct(
        F.transform(
            info["cabinets"],
            lambda c: F.struct(
                F.decode(c["cabinet_type"], "UTF-8").alias("cabinet_type"), c["q"].alias("q"), c["r"].alias("r")
            ),
        ).alias("cabinets"),
        info["conduits"].alias("conduits"),
        info["isolate_inputs_from_outputs"].alias("isolate_inputs_from_outputs"),
        info["shrink_left"].alias("shrink_left"),
        info["shrink_right"].alias("shrink_right"),
        F.transform(
            info["vials"],
            lambda v: F.struct(
                v["count"].alias("count"), v["q"].alias("q"), v["r"].alias("r"), v["style"].alias("style")
            ),
        ).alias("vials"),
    )
    return F.when(info.isNotNull(), body)


def puzzle_semantics_error(parsed: Column) -> Column:
    """First reason decoded puzzle structure has no canonical meaning, else null."""
    molecules = F.concat(parsed["inputs"], parsed["outputs"])
    full = sum(fixed.BOND_BITS)

    def unknown_atom(m: Column) -> Column:
        return F.exists(m["atoms"], lambda a: ~a["atom_type"].isin(list(fixed.ATOM_TYPES)))

    def bad_bond(m: Column) -> Column:
        return F.exists(m["bonds"], lambda b: (b["bond_type"] == 0) | (b["bond_type"] > full))

    bad_text = F.exists(
        parsed["production_info"]["cabinets"], lambda c: ~F.is_valid_utf8(c["cabinet_type"].cast("string"))
    )
    return (
        F.when(parsed["output_scale"] < 1, "output_scale_below_1")
        .when(F.size(parsed["inputs"]) == 0, "no_reagents")
        .when(F.size(parsed["outputs"]) == 0, "no_products")
        .when(F.size(nested.unknown_bits(parsed["parts_available"])) > 0, "unknown_availability_bits")
        .when(F.exists(molecules, lambda m: F.size(m["atoms"]) == 0), "empty_molecule")
        .when(F.exists(molecules, unknown_atom), "unknown_atom_type")
        .when(F.exists(molecules, bad_bond), "invalid_bond_type")
        .when(F.coalesce(bad_text, F.lit(False)), "invalid_cabinet_type")
    )


def decoded_claims(parsed: Column) -> Column:
    """Array of struct(field, value_json): the complete claim set of a decoded puzzle."""
    constraints = _decoded_constraints(parsed["production_info"])
    values = {
        "allowed_parts": json_of(nested.allowed_parts(parsed["parts_available"])),
        "allowed_instructions": json_of(nested.allowed_instructions(parsed["parts_available"])),
        "reagents": json_of(F.transform(parsed["inputs"], _decoded_molecule)),
        "products": json_of(F.transform(parsed["outputs"], _decoded_molecule)),
        "output_scale": parsed["output_scale"].cast("string"),
        "target_output_count": (6 * parsed["output_scale"]).cast("string"),
        "production": parsed["production_info"].isNotNull().cast("string"),
        "production_constraints": F.coalesce(json_of(constraints), F.lit("null")),
    }
    return F.array(
        *[F.struct(F.lit(f).alias("field"), v.alias("value_json")) for f, v in values.items()]
    )


def artifact_observation_links(artifacts: DataFrame, observations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sorted artifact-role observation ids of each puzzle artifact, and violations."""
    seen = observations.where("source_role = 'artifact' AND artifact_kind = 'puzzle'").select(
        "artifact_id", "observation_id", F.col("puzzle_id").alias("_puzzle"), "observed_sha256"
    )
    joined = artifacts.select("artifact_id", "puzzle_id", "sha256").join(seen, "artifact_id", "left")
    violations = union_all(
        [
            violations_where(
                joined, F.col("observation_id").isNull(), "artifact_unobserved", "no artifact observation",
                "puzzle_artifacts", "artifact_id",
            ),
            violations_where(
                joined, F.col("_puzzle") != F.col("puzzle_id"), "observation_other_puzzle",
                F.col("observation_id"), "observations", "artifact_id",
            ),
            violations_where(
                joined, F.col("observed_sha256") != F.col("sha256"), "observation_other_bytes",
                F.col("observation_id"), "observations", "artifact_id",
            ),
        ]
    )
    found = joined.where("observation_id IS NOT NULL")
    return packed(found, ["artifact_id", "puzzle_id"], "observation_id", "observation_ids"), violations


def artifact_claims(decoded: DataFrame, links: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Long claims of decoded puzzle artifacts, and the decode failures.

    Without ``links`` the decoded rows hold puzzle_id and observation_ids themselves.
    """
    checked = decoded.withColumn(
        "error", F.coalesce("error", F.when(F.col("parsed").isNotNull(), puzzle_semantics_error(F.col("parsed"))))
    )
    failures = violations_where(
        checked, F.col("error").isNotNull(), "puzzle_decode_failed", F.col("error"), "puzzle_artifacts", "artifact_id"
    )
    good = checked.where("error IS NULL")
    claims = (
        (good if links is None else good.join(links, "artifact_id"))
        .select(
            "puzzle_id", "observation_ids", F.col("artifact_id").alias("puzzle_artifact_id"),
            F.explode(decoded_claims(F.col("parsed"))).alias("c"),
        )
        .select("puzzle_id", "observation_ids", "puzzle_artifact_id", "c.field", "c.value_json")
    )
    return claims, failures


def topology_status(inventory: DataFrame, catalog: DataFrame, uses: DataFrame) -> DataFrame:
    """Inventory rows with the reagents and products an external topology gives them.

    catalog: game_puzzle_id, variant.  uses: variant, molecule, reagent_count, product_count.
    """
    counts = uses.groupBy("variant").agg(
        F.sum("reagent_count").alias("reagents"), F.sum("product_count").alias("products")
    )
    joined = inventory.join(catalog.select("game_puzzle_id", "variant"), "game_puzzle_id", "left").join(
        counts, "variant", "left"
    )
    status = (
        F.when(F.col("variant").isNull(), "missing_from_catalog")
        .when(F.coalesce("reagents", F.lit(0)) == 0, "missing_reagents")
        .when(F.coalesce("products", F.lit(0)) == 0, "missing_products")
        .otherwise("ok")
    )
    return joined.select(
        "puzzle_id", "game_puzzle_id", "variant", F.coalesce("reagents", F.lit(0)).alias("reagents"),
        F.coalesce("products", F.lit(0)).alias("products"), status.alias("status"),
    )


def external_molecule(molecule: Column) -> Column:
    """Topology-table molecule (text bond types, any-case atoms) in claim form."""
    return F.struct(
        F.transform(
            molecule["atoms"],
            lambda a: F.struct(F.lower(a["atom_type"]).alias("atom_type"), a["q"].alias("q"), a["r"].alias("r")),
        ).alias("atoms"),
        F.transform(
            molecule["bonds"],
            lambda b: F.struct(
                b["start_q"].alias("a_q"), b["start_r"].alias("a_r"), b["end_q"].alias("b_q"),
                b["end_r"].alias("b_r"), nested.textual_bond_types(b["bond_type"]).alias("bond_types"),
            ),
        ).alias("bonds"),
    )


def topology_claims(status: DataFrame, uses: DataFrame, observations: DataFrame) -> DataFrame:
    """Reagent and product claims: each molecule repeated by its use count.

    The counts are multiplicities inside one claim value; a claim is one puzzle's
    molecule list, so it is collected per puzzle.
    """
    ok = status.where("status = 'ok'").select("puzzle_id", "variant")
    named = uses.select("variant", external_molecule(F.col("molecule")).alias("m"), "reagent_count", "product_count")
    sides = named.select(
        "variant",
        "m",
        F.explode(
            F.array(
                F.struct(F.lit("reagents").alias("field"), F.col("reagent_count").alias("n")),
                F.struct(F.lit("products").alias("field"), F.col("product_count").alias("n")),
            )
        ).alias("s"),
    ).select("variant", "m", "s.field", F.col("s.n").cast("int").alias("n")).where("n > 0")
    lists = sides.groupBy("variant", "field").agg(
        F.flatten(F.collect_list(F.array_repeat("m", F.col("n")))).alias("ms")
    )
    ids = packed(observations, ["puzzle_id"], "observation_id", "observation_ids")
    return ok.join(lists, "variant").join(ids, "puzzle_id").select(
        "puzzle_id", "observation_ids", F.lit(None).cast("string").alias("puzzle_artifact_id"), "field",
        json_of(nested.canonical_molecules(F.col("ms"))).alias("value_json"),
    )


def topology_observations(status: DataFrame, receipts: DataFrame) -> DataFrame:
    """One metadata observation per (puzzle, evidence file).

    The evidence files are the two fixed catalog sources, listed as rows; every
    puzzle cites each of them, so the file list is exploded on every puzzle.
    """
    files = receipts.agg(
        F.sort_array(F.collect_list(F.struct("upstream_path", "source_id", "revision", "sha256", "byte_length", "rights_status"))).alias("files")
    )
    null = F.lit(None).cast("string")
    nothing = F.lit(None).cast("bigint")
    cited = status.where("status = 'ok'").withColumn("files", files.scalar()).select(
        "puzzle_id", "game_puzzle_id", F.explode("files").alias("r")
    )
    body = cited.select(
        F.lit("puzzle").alias("artifact_kind"), null.alias("artifact_id"), "puzzle_id",
        F.lit("metadata").alias("source_role"), F.col("r.source_id").alias("source_id"),
        F.col("r.revision").alias("source_revision"), F.col("game_puzzle_id").alias("source_object_id"),
        F.col("r.upstream_path").alias("source_path"), null.alias("associated_artifact_path"),
        F.col("game_puzzle_id").alias("source_declared_puzzle_id"), null.alias("source_url"),
        null.alias("author"), nothing.alias("claimed_cost"), nothing.alias("claimed_cycles"),
        nothing.alias("claimed_area"), nothing.alias("claimed_instructions"),
        null.alias("observed_sha256"), F.col("r.sha256").alias("source_evidence_sha256"),
        F.col("r.byte_length").alias("source_evidence_byte_length"),
        F.col("r.rights_status").alias("rights_status"),
        F.lit(fixed.TOPOLOGY_IMPORTER).alias("importer_version"),
    )
    return with_observation_id(body)
