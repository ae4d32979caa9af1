"""Landed files: content objects, receipts, inventories and archives."""

from __future__ import annotations

import re
import tomllib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as fixed
from ..functions.canonical import name_key, receipt_file_name
from ..operators.checks import (
    duplicate_key_violations,
    key_counts,
    missing_references,
    rule_violations,
    union_all,
    unique_key_violations,
    violations_where,
)
from ..operators.coverage import rollup_counts
from ..operators.ordering import number_in_buckets, numbered_lines, sequence_violations
from ..operators.pairing import mapped_receipts, posix, stem, suffix
from ..session import checkpoint_dir

RECEIPT_SCHEMA = T.StructType(
    [
        T.StructField("source_id", T.StringType()),
        T.StructField("revision", T.StringType()),
        T.StructField("upstream_path", T.StringType()),
        T.StructField("sha256", T.StringType()),
        T.StructField("byte_length", T.LongType()),
        T.StructField("rights_status", T.StringType()),
        T.StructField("retrieved_at", T.StringType()),
    ]
)


# --- content objects -------------------------------------------------------------------


def read_objects(spark: SparkSession, root: str) -> DataFrame:
    """(object_key, byte_length, sha256, content) of every stored object, measured on its bytes.

    ``content`` is read only by plans that use it or its digest.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/objects")
    # The key begins at the last such folder: the root's own path may hold one too.
    return files.select(
        F.concat(F.lit("objects/"), F.regexp_extract("path", r"^.*/objects/(.+)$", 1)).alias("object_key"),
        F.octet_length("content").cast("bigint").alias("byte_length"),
        F.sha2("content", 256).alias("sha256"),
        "content",
    )


def content_table(objects: DataFrame, buckets: int | None = None) -> DataFrame:
    """``objects`` written once as a table bucketed and sorted by ``sha256``.

    The object store is read and hashed once, and bytes are dealt once, by their digest.  Later
    joins on ``sha256`` move only the narrow side, and plans that need no bytes read the measured
    facts alone.  Rows stay as they are: an object under a wrong key, stored twice or of a null
    digest is there again.  ``buckets`` is best about the bytes of the store over 256 MB; without it
    the number of shuffle partitions is taken.
    """
    spark = objects.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{_content_prefix(spark)}{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/stored-{spark.sparkContext.applicationId}/{name}"
    # Dealt by the same hash as the buckets, so every task writes one file.
    dealt = objects.select("object_key", "byte_length", "sha256", "content").repartition(n, "sha256")
    dealt.write.format("parquet").bucketBy(n, "sha256").sortBy("sha256").option("path", path).saveAsTable(name)
    return spark.table(name)


def _content_prefix(spark: SparkSession) -> str:
    return f"content_{re.sub('[^0-9a-z]', '_', spark.sparkContext.applicationId.lower())}_"


def drop_content_tables(spark: SparkSession) -> None:
    """Drop this application's content tables and their files; results that read them must be written before."""
    configuration = spark._jsc.hadoopConfiguration()
    for entry in spark.catalog.listTables(pattern=f"{_content_prefix(spark)}*"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/stored-{spark.sparkContext.applicationId}/{entry.name}")
        spark.sql(f"DROP TABLE {entry.name}")
        path.getFileSystem(configuration).delete(path, True)


def file_digest_violations(spark: SparkSession, expected: DataFrame) -> DataFrame:
    """Pinned-hash check of a list of files.  expected: path, sha256; a missing file is a violation too."""
    # Folders are listed once each and joined with the wanted paths; other files in them are pruned before they are read.
    wanted = expected.select("path").distinct()
    folders = [r[0] for r in wanted.select(F.regexp_replace("path", "/[^/]*$", "").alias("f")).distinct().toLocalIterator()]
    if not folders:
        return violations_where(expected.withColumn("_found", F.lit(None).cast("string")), F.lit(False), "inventory_hash_mismatch", F.lit(""), "files", "path")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*").load(folders).select(
        F.regexp_replace("path", r"^file:(//)?(?=/)", "").alias("path"), "content"
    ).join(wanted, "path", "left_semi").select("path", F.sha2("content", 256).alias("_found"))
    joined = expected.join(files, "path", "left")
    return violations_where(
        joined, ~F.col("_found").eqNullSafe(F.col("sha256")), "inventory_hash_mismatch",
        F.concat(F.lit("expected "), F.col("sha256")), "files", "path",
    )


# --- receipts --------------------------------------------------------------------------


def component_ok(column: Column) -> Column:
    """A receipt key component: non-empty, no separators, drive or NUL."""
    return (
        (F.length(column) > 0)
        & ~column.isin(".", "..")
        & ~column.rlike(r"[/\\\x00]")
        & ~column.rlike(r"^[A-Za-z]:")
    )


def read_receipts(spark: SparkSession, root: str, source_id: str = "*", revision: str = "*") -> DataFrame:
    """Receipts of one source and revision (or all), with their file facts.

    The directory is part of the path, so only the wanted source and revision
    are listed and read.
    """
    raw = spark.read.text(f"{root}/receipts/{source_id}/{revision}/*.json", wholetext=True).select(
        F.col("_metadata.file_path").alias("receipt_file"), F.col("value")
    )
    parsed = raw.withColumn("r", F.from_json("value", RECEIPT_SCHEMA))
    return parsed.select(
        "receipt_file",
        F.regexp_extract("receipt_file", r"/([^/]+)/[^/]+/[^/]+$", 1).alias("dir_source"),
        F.regexp_extract("receipt_file", r"/([^/]+)/[^/]+$", 1).alias("dir_revision"),
        F.regexp_extract("receipt_file", r"([^/]+)$", 1).alias("file_name"),
        F.array_sort(F.json_object_keys("value")).alias("keys"),
        F.schema_of_variant(F.try_parse_json("value")).alias("shape"),
        "r.*",
    )


def receipt_value_rules() -> dict[str, Column]:
    """What a receipt's own values must satisfy, wherever it comes from."""
    return {
        "source_id is unsafe": component_ok(F.col("source_id")),
        "revision is unsafe": component_ok(F.col("revision")),
        "sha256 is invalid": F.col("sha256").rlike(fixed.SHA256_PATTERN),
        "byte_length is negative": F.col("byte_length") >= 0,
    }


def receipt_violations(receipts: DataFrame) -> DataFrame:
    """Closed schema, key hygiene and the name every receipt file must have."""
    names = sorted(f.name for f in RECEIPT_SCHEMA.fields)
    rules = {
        "fields are missing or unknown": F.col("keys") == F.array(*[F.lit(n) for n in names]),
        "field types are wrong": F.col("shape").rlike(
            "^OBJECT<byte_length: BIGINT, retrieved_at: STRING, revision: STRING, rights_status: STRING, "
            "sha256: STRING, source_id: STRING, upstream_path: STRING>$"
        ),
        **receipt_value_rules(),
        "receipt identity does not match its file": (F.col("dir_source") == F.col("source_id"))
        & (F.col("dir_revision") == F.col("revision"))
        & (F.col("file_name") == receipt_file_name(F.col("source_id"), F.col("revision"), F.col("upstream_path"))),
    }
    return rule_violations(receipts, rules, "receipts", "receipt_file", "receipt_invalid")


def receipt_columns(receipts: DataFrame) -> DataFrame:
    return receipts.select(*[f.name for f in RECEIPT_SCHEMA.fields])


def source_revisions(spark: SparkSession, root: str, source_id: str) -> DataFrame:
    """Distinct revisions landed for a source, from file names only."""
    files = spark.read.format("binaryFile").load(f"{root}/receipts/{source_id}/*/*.json").select("path")
    return files.select(F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("revision")).distinct().orderBy("revision")


def exact_path_set_violations(receipts: DataFrame, required: list[str], path: str = "receipts") -> DataFrame:
    """Receipts of a source must be exactly the required paths, each once."""
    spark = receipts.sparkSession
    wanted = spark.createDataFrame([(p,) for p in required], "upstream_path string")
    return union_all(
        [
            violations_where(
                missing_references(wanted, "upstream_path", receipts, "upstream_path"), F.lit(True),
                "evidence_missing", "required file is not landed", path, "upstream_path",
            ),
            violations_where(
                missing_references(receipts, "upstream_path", wanted, "upstream_path"), F.lit(True),
                "evidence_unexpected", "file is not part of the set", path, "upstream_path",
            ),
            violations_where(
                key_counts(receipts, ["upstream_path"]).where("n > 1"), F.lit(True), "evidence_repeated",
                "landed more than once", path, "upstream_path",
            ),
        ]
    )


# --- inventories -----------------------------------------------------------------------


def read_manifest(spark: SparkSession, path: str) -> dict:
    """One collection manifest (a single small record)."""
    return tomllib.loads(spark.read.text(path, wholetext=True).first()[0])


def read_inventory(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Inventory rows (path, row_no = file line, 7 columns) of CSV files, and format violations.

    The number of columns is counted outside quoted fields before the typed
    parse, so short and long lines are reported with their line.
    """
    header = ",".join(fixed.INVENTORY_HEADER)
    lines = numbered_lines(spark, path)
    width = F.size(F.split(F.regexp_replace("line", r'"(?:[^"]++|"")*+"', ""), ","))
    body = lines.where("line_no > 1").withColumn("_width", width)
    columns = T.StructType([T.StructField(c, T.StringType()) for c in fixed.INVENTORY_HEADER])
    ddl = ", ".join(f"`{c}` string" for c in fixed.INVENTORY_HEADER)
    parsed = (
        body.where(F.col("_width") == len(columns))
        .withColumn("r", F.from_csv("line", ddl, {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": '"'}))
        .select("path", F.col("line_no").alias("row_no"), *[F.coalesce(f"r.{c}", F.lit("")).alias(c) for c in fixed.INVENTORY_HEADER])
    )
    found = [
        violations_where(
            lines, (F.col("line_no") == 1) & (F.col("line") != header), "inventory_header_error",
            f"expected header {header}", "inventory", "line_no",
        ),
        violations_where(
            body, F.col("_width") != len(columns), "inventory_row_error",
            F.format_string(f"expected {len(columns)} columns, got %d", F.col("_width")), "inventory", "line_no",
        ),
        rule_violations(parsed, inventory_rules(), "inventory", "row_no", "inventory_row_error"),
    ]
    return parsed, union_all(found)


def inventory_rules() -> dict[str, Column]:
    return {
        "puzzle_id has the wrong form": F.col("puzzle_id").rlike(fixed.PUZZLE_ID_PATTERN),
        "display_name is empty": F.length("display_name") > 0,
        "kind is unknown": F.col("kind").isin(fixed.PUZZLE_KINDS),
        "group has the wrong form": F.col("group").rlike(fixed.GROUP_PATTERN),
        "game_puzzle_id has the wrong form": F.col("game_puzzle_id").rlike(fixed.GAME_ID_PATTERN),
        "leaderboard_key has the wrong form": F.col("leaderboard_key").rlike(fixed.LEADERBOARD_KEY_PATTERN),
        "puzzle_type is unknown": F.col("puzzle_type").isin(fixed.PUZZLE_TYPES),
    }


def inventory_violations(inventory: DataFrame, puzzle_count: int, group_counts: dict[str, int]) -> DataFrame:
    """Unique keys, id sequence, declared count and group rollups of one collection."""
    spark = inventory.sparkSession
    # Lines are file positions; their place in the sequence is the row order.
    placed = number_in_buckets(inventory, F.floor(F.col("row_no") / 1_000_000), [F.col("row_no")], "place")
    wrong = sequence_violations(
        placed, "row_no", F.col("puzzle_id"), F.format_string("om.puzzle.%04d", F.col("place"))
    )
    rollups = spark.createDataFrame(list(group_counts.items()), "rollup string, declared bigint")
    _, rollup_bad = rollup_counts(inventory, "row_no", "group", rollups, "rollup", "declared")
    total = inventory.agg(F.count(F.lit(1)).alias("n"))
    return union_all(
        [
            *[
                duplicate_key_violations(inventory, c, "row_no", "inventory", f"duplicate_{c}")
                for c in ("puzzle_id", "game_puzzle_id", "leaderboard_key")
            ],
            violations_where(
                wrong, F.lit(True), "puzzle_id_sequence_error",
                F.concat(F.lit("expected "), F.col("expected"), F.lit(", got "), F.col("observed")), "inventory", "row_no",
            ),
            violations_where(
                total, F.col("n") != puzzle_count, "puzzle_count_mismatch",
                F.format_string(f"manifest declares {puzzle_count}, inventory contains %d", F.col("n")),
                "manifest", F.lit(None).cast("string"),
            ),
            rollup_bad,
        ]
    )


def read_collections(spark: SparkSession, root: str) -> list[tuple[dict, DataFrame, DataFrame]]:
    """(manifest, inventory, violations) of every manifest in a directory, in name order."""
    listing = spark.read.format("binaryFile").load(f"{root}/*.toml").select("path").orderBy("path")
    found = []
    for row in listing.toLocalIterator():
        manifest = read_manifest(spark, row["path"])
        folder = row["path"].rsplit("/", 1)[0]
        csv_path = f"{folder}/{manifest['inventory_file']}"
        rows, bad = read_inventory(spark, csv_path)
        pinned = spark.createDataFrame(
            [(csv_path.removeprefix("file:"), manifest["inventory_sha256"])], "path string, sha256 string"
        )
        checks = union_all(
            [
                bad,
                file_digest_violations(spark, pinned),
                inventory_violations(rows, manifest["puzzle_count"], manifest["group_counts"]),
            ]
        )
        found.append((manifest, rows, checks))
    return found


# --- landed archives -------------------------------------------------------------------


def _quoted(text: str) -> str:
    """A pattern that matches ``text`` itself."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """(upstream_path, content) of every file below a landing directory."""
    base = root.rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
    return files.select(
        F.regexp_extract("path", "^.*?" + _quoted(base) + "/(.*)$", 1).alias("upstream_path"), "length", "content"
    )


def landed_solutions(files: DataFrame, layout: DataFrame, kinds: tuple[str, ...] = (".solution",)) -> DataFrame:
    """Landed files of an archive or leaderboard that belong to inventory puzzles."""
    return union_all([mapped_receipts(files, layout, kind).withColumn("suffix", F.lit(kind)) for kind in kinds])


def landed_puzzle_fixtures(receipts: DataFrame, inventory: DataFrame, prefix: str = "test/puzzle/campaign") -> tuple[DataFrame, DataFrame]:
    """Campaign puzzle fixtures by file stem, and stems that appear under several paths."""
    path = F.col("upstream_path")
    wanted = receipts.where(posix(path).startswith(prefix + "/") & (suffix(path) == ".puzzle")).withColumn(
        "game_puzzle_id", stem(path)
    )
    campaign = inventory.where("kind = 'campaign'").select("game_puzzle_id", "puzzle_id")
    joined = wanted.join(campaign, "game_puzzle_id")
    paths = joined.groupBy("game_puzzle_id").agg(
        F.min("upstream_path").alias("lo"), F.max("upstream_path").alias("hi")
    )
    bad = violations_where(
        paths, F.col("lo") != F.col("hi"), "fixture_repeated", F.concat_ws(", ", "lo", "hi"), "receipts", "game_puzzle_id"
    )
    return joined, bad


def mapping_violations(mappings: DataFrame, inventory: DataFrame) -> DataFrame:
    """Rules of a puzzle-to-path mapping: in collection, unique, relative ``.puzzle`` paths."""
    path = F.col("path")
    relative = (
        (F.length(path) > 0) & ~path.contains("\\") & ~path.startswith("/") & ~path.rlike(r"(^|/)\.\.(/|$)")
        & (suffix(path) == ".puzzle")
    )
    return union_all(
        [
            violations_where(
                missing_references(mappings, "puzzle_id", inventory, "puzzle_id"), F.lit(True),
                "mapping_outside_collection", "puzzle is not in the collection", "mappings", "puzzle_id",
            ),
            unique_key_violations(mappings, "puzzle_id", "mappings"),
            unique_key_violations(mappings.withColumn("path", posix(path)), "path", "mappings"),
            violations_where(
                mappings, ~F.coalesce(relative, F.lit(False)), "mapping_path_invalid", path, "mappings", "puzzle_id"
            ),
        ]
    )


def mapped_files(mappings: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mapped puzzle files, and mappings without a file.  files: upstream_path + facts."""
    wanted = mappings.withColumn("upstream_path", posix(F.col("path")))
    joined = wanted.join(files, "upstream_path")
    lost = missing_references(wanted, "upstream_path", files, "upstream_path")
    return joined, violations_where(lost, F.lit(True), "mapped_file_missing", F.col("upstream_path"), "mappings", "puzzle_id")


def mapped_set_violations(mappings: DataFrame, receipts: DataFrame, manifest_path: str) -> DataFrame:
    """A cached mapped set: manifest present, every mapping landed, nothing extra, no repeats."""
    spark = receipts.sparkSession
    manifest = spark.createDataFrame([(manifest_path,)], "upstream_path string")
    wanted = mappings.select(posix(F.col("path")).alias("upstream_path"))
    puzzles = receipts.where(F.col("upstream_path").endswith(".puzzle"))
    return union_all(
        [
            violations_where(missing_references(manifest, "upstream_path", receipts, "upstream_path"), F.lit(True), "manifest_missing", "no cached manifest", "receipts", "upstream_path"),
            violations_where(missing_references(wanted, "upstream_path", receipts, "upstream_path"), F.lit(True), "mapped_file_missing", "no cached file", "receipts", "upstream_path"),
            violations_where(missing_references(puzzles, "upstream_path", wanted, "upstream_path"), F.lit(True), "file_unmapped", "absent from manifest", "receipts", "upstream_path"),
            violations_where(key_counts(receipts, ["upstream_path"]).where("n > 1"), F.lit(True), "path_repeated", "landed more than once", "receipts", "upstream_path"),
        ]
    )


def dumped_puzzle_name(content: Column) -> Column:
    """struct(name, error) of a dumped puzzle's header, with binary expressions only.

    Format number (4 bytes, little-endian), then a 7-bit-group length, then the
    name.
    """
    hexed = F.hex(content)
    size = F.octet_length(content)

    def byte(i: int) -> Column:
        return F.conv(F.substring(hexed, 2 * i + 1, 2), 16, 10).cast("int")

    def group(i: int) -> Column:
        return byte(4 + i).bitwiseAND(127).cast("bigint")

    length, used, ended, bad = F.lit(0).cast("bigint"), F.lit(0), F.lit(False), F.lit(False)
    for i in range(5):
        live = ~ended
        length = F.when(live, length + F.shiftleft(group(i), 7 * i)).otherwise(length)
        used = F.when(live, F.lit(i + 1)).otherwise(used)
        if i == 4:
            bad = live & (byte(8) > 15)
        ended = ended | (live & (byte(4 + i) < 128))
    start = 4 + used
    name_hex = F.substring(hexed, 2 * start + 1, (2 * length).cast("int"))
    name_bytes = F.unhex(name_hex)
    text = F.when(F.is_valid_utf8(name_bytes.cast("string")), name_bytes.cast("string"))
    error = (
        F.when(size < 5, "invalid_header")
        .when(F.substring(hexed, 1, 8) != "03000000", "unsupported_format")
        .when(size < start, "truncated_name_length")
        .when(bad | ~ended, "invalid_name_length")
        .when(start + length > size, "truncated_name")
        .when(length == 0, "empty_name")
        .when(text.isNull(), "invalid_utf8")
    )
    return F.struct(F.when(error.isNull(), text).alias("name"), error.alias("error"))


def reconcile_dump(files: DataFrame, inventory: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Match dumped puzzles to the inventory by embedded name.

    Unknown names are ignored; the same puzzle with different bytes is ambiguous
    and an inventory puzzle without a dump is missing.
    """
    named = files.select(
        "upstream_path", F.sha2("content", 256).alias("sha256"), dumped_puzzle_name(F.col("content")).alias("h")
    ).select("upstream_path", "sha256", F.col("h.error").alias("error"), name_key(F.col("h.name")).alias("leaderboard_key"))
    matched = named.where("error IS NULL").join(
        inventory.select("leaderboard_key", "puzzle_id", "game_puzzle_id"), "leaderboard_key"
    )
    per_puzzle = matched.groupBy("puzzle_id", "game_puzzle_id").agg(
        F.min(F.struct("upstream_path", "sha256")).alias("first"),
        F.min("sha256").alias("lo"), F.max("sha256").alias("hi"),
    )
    violations = union_all(
        [
            violations_where(named, F.col("error").isNotNull(), "dump_header_invalid", F.col("error"), "dump", "upstream_path"),
            violations_where(per_puzzle, F.col("lo") != F.col("hi"), "dump_ambiguous", "different bytes for one puzzle", "dump", "puzzle_id"),
            violations_where(
                missing_references(inventory, "puzzle_id", matched, "puzzle_id"), F.lit(True), "dump_missing",
                F.col("game_puzzle_id"), "dump", "puzzle_id",
            ),
        ]
    )
    mappings = per_puzzle.select(
        "puzzle_id", F.format_string("puzzles/%s.puzzle", F.col("game_puzzle_id")).alias("path"),
        F.col("first.upstream_path").alias("dump_path"), F.col("first.sha256").alias("sha256"),
    )
    return mappings, violations

