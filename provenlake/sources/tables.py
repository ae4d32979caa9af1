"""Release tables: typed scans of JSON lines and Parquet."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import nested
from ..functions.canonical import base64_text, canonical_json, canonical_value, json_array, json_object, json_of, json_scalar, sorted_map
from ..operators.checks import union_all, violations_where
from ..operators.ordering import numbered_lines

_HISTOGRAM = "map<string,bigint>"
SCHEMA_DDL = {
    "puzzles": (
        "puzzle_definition_id string, schema_version string, puzzle_id string, display_name string, kind string, "
        "aliases array<struct<system:string,value:string>>, allowed_parts array<string>, "
        f"allowed_instructions array<string>, reagents {nested.MOLECULES}, products {nested.MOLECULES}, "
        "output_scale bigint, target_output_count bigint, production boolean, "
        f"production_constraints {nested.CONSTRAINTS}, source_observation_ids array<string>, "
        "puzzle_artifact_ids array<string>, collection_id string"
    ),
    "solutions": (
        "solution_id string, solution_sha256 string, puzzle_id string, puzzle_artifact_id string, "
        "solution_format string, solution_bytes string, rights_status string, verified boolean, "
        "validation_profile string, verifier_revision string, cost bigint, cycles bigint, area bigint, "
        "instructions bigint, vanilla_constructible boolean, record_eligible boolean, "
        "normalized_solution_id string, source_count bigint, collection_id string"
    ),
    "observations": (
        "observation_id string, artifact_kind string, artifact_id string, puzzle_id string, source_role string, "
        "source_id string, source_revision string, source_object_id string, source_path string, "
        "associated_artifact_path string, source_declared_puzzle_id string, source_url string, author string, "
        "claimed_cost bigint, claimed_cycles bigint, claimed_area bigint, claimed_instructions bigint, "
        "observed_sha256 string, source_evidence_sha256 string, source_evidence_byte_length bigint, "
        "rights_status string, importer_version string"
    ),
    "normalized": (
        "normalized_solution_id string, solution_id string, puzzle_id string, normalizer_version string, "
        "parts array<struct<part_id:string,type:string,x:int,y:int,rotation:int,parameters:string>>, "
        "tracks array<struct<track_id:string,coordinates:array<struct<x:int,y:int>>>>, "
        "programs array<struct<arm_id:string,instructions:array<struct<cycle:bigint,opcode:string>>>>, "
        "summaries struct<part_count:bigint,track_count:bigint,track_hex_count:bigint,program_count:bigint,"
        f"instruction_count:bigint,part_type_histogram:{_HISTOGRAM},opcode_histogram:{_HISTOGRAM}>"
    ),
}


@cache
def release_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMA_DDL[table])


# Columns an observation file may leave out; they are null after validation.
OPTIONAL_COLUMNS = {
    "observations": [
        "source_role", "associated_artifact_path", "source_declared_puzzle_id", "source_evidence_sha256",
        "source_evidence_byte_length",
    ]
}
# Columns holding an open JSON object kept as text.
OPEN_OBJECTS = {"parameters"}


def _shape(dtype: T.DataType, name: str = "") -> str:
    """Pattern of the printed schema of a JSON value of this type (closed objects)."""
    if name in OPEN_OBJECTS or isinstance(dtype, T.MapType):
        return "OBJECT<.*>"
    if isinstance(dtype, T.StructType):
        fields = ", ".join(f"{f.name}: {_shape(f.dataType, f.name)}" for f in sorted(dtype.fields, key=lambda f: f.name))
        return f"(?:VOID|OBJECT<{fields}>)"
    if isinstance(dtype, T.ArrayType):
        return f"ARRAY<(?:VOID|{_shape(dtype.elementType)})>"
    scalar = {"string": "STRING", "long": "BIGINT", "integer": "BIGINT", "boolean": "BOOLEAN"}[dtype.typeName()]
    return f"(?:VOID|{scalar})"


def row_shape(table: str) -> str:
    optional = set(OPTIONAL_COLUMNS.get(table, []))
    pieces = []
    for f in sorted(release_schema(table).fields, key=lambda f: f.name):
        piece = f"(?:{f.name}: {_shape(f.dataType, f.name)}(?:, )?)"
        pieces.append(piece + "?" if f.name in optional else piece)
    return "^OBJECT<" + "".join(pieces) + ">$"


def open_json(text: Column) -> Column:
    """Canonical text of an open JSON object (a parsed variant keeps its keys sorted)."""
    return F.to_json(F.try_parse_json(text))


def typed_rows(df: DataFrame, table: str) -> DataFrame:
    """Put a parsed table into its stored form: bytes binary, open objects canonical text."""
    if table == "solutions" and df.schema["solution_bytes"].dataType == T.StringType():
        return df.withColumn("solution_bytes", F.unbase64("solution_bytes"))
    if table == "normalized":
        parts = F.transform("parts", lambda p: p.withField("parameters", open_json(p["parameters"])))
        summaries = F.col("summaries")
        for h in ("part_type_histogram", "opcode_histogram"):
            summaries = summaries.withField(h, sorted_map(F.col(f"summaries.{h}")))
        return df.withColumn("parts", parts).withColumn("summaries", summaries)
    return df


def read_release_lines(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """The four release inputs as typed tables, and every format violation with its line.

    Blank lines are skipped; an empty table is a violation.
    """
    tables: dict[str, DataFrame] = {}
    found: list[DataFrame] = []
    for table in SCHEMA_DDL:
        schema = release_schema(table)
        lines = numbered_lines(spark, f"{folder}/{table}.jsonl").where(F.trim("line") != "")
        shape = F.schema_of_variant(F.try_parse_json("line"))
        judged = lines.select(
            "line_no",
            "line",
            F.when(shape.isNull(), "json_invalid")
            .when(~shape.startswith("OBJECT"), "schema_invalid")
            .when(~shape.rlike(row_shape(table)), "schema_invalid").alias("code"),
        )
        found.append(
            judged.where("code IS NOT NULL").select(
                "code", F.lit("row does not fit the closed schema").alias("detail"), F.lit(table).alias("path"),
                F.col("line_no").cast("string").alias("row_key"),
            )
        )
        rows = lines.select("line_no", F.from_json("line", schema).alias("r")).select("line_no", "r.*")
        found.append(
            violations_where(
                rows.agg(F.count(F.lit(1)).alias("n")), F.col("n") == 0, "input_empty", "no rows", table,
                F.lit(None).cast("string"),
            )
        )
        if table == "solutions":
            text = F.col("solution_bytes")
            found.append(
                violations_where(
                    rows, text.isNotNull() & ~F.coalesce(base64_text(F.try_to_binary(text, F.lit("base64"))) == text, F.lit(False)),
                    "schema_invalid", "solution_bytes is not base64", table, "line_no",
                )
            )
        tables[table] = typed_rows(rows.drop("line_no"), table)
    return tables, union_all(found)


def encode_for_parquet(df: DataFrame, table: str) -> DataFrame:
    """Stored form of a table: the two histograms become JSON text."""
    if table != "normalized":
        return df.select(*[f.name for f in release_schema(table).fields])
    summaries = F.col("summaries")
    for h in ("part_type_histogram", "opcode_histogram"):
        summaries = summaries.withField(h, json_of(sorted_map(F.col(f"summaries.{h}"))))
    return df.withColumn("summaries", summaries).select(*[f.name for f in release_schema(table).fields])


def read_release_parquet(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A stored table back in typed form."""
    df = spark.read.parquet(f"{folder}/data/{table}")
    if table == "normalized":
        summaries = F.col("summaries")
        for h in ("part_type_histogram", "opcode_histogram"):
            summaries = summaries.withField(h, F.from_json(f"summaries.{h}", _HISTOGRAM))
        df = df.withColumn("summaries", summaries)
    return df


def row_json(df: DataFrame, table: str) -> Column:
    """Canonical JSON of a release row, with open objects written as objects."""
    if table != "normalized":
        return canonical_json(df, [f.name for f in release_schema(table).fields])

    def text(name: str) -> Column:
        return json_of(canonical_value(F.col(name), df.schema[name].dataType))

    scalars = ["part_id", "type", "x", "y", "rotation"]
    parts = F.transform(
        "parts", lambda p: json_object({**{s: json_scalar(p[s]) for s in scalars}, "parameters": p["parameters"]})
    )
    keys = ["normalized_solution_id", "solution_id", "puzzle_id", "normalizer_version"]
    return json_object(
        {
            **{c: json_scalar(F.col(c)) for c in keys},
            "parts": json_array(parts), "tracks": text("tracks"), "programs": text("programs"),
            "summaries": text("summaries"),
        }
    )
