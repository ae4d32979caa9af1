"""Landed files to a validated release, with corruption and determinism checks."""

import hashlib
import json
import pathlib

import pytest
from pyspark.sql import functions as F
from world import ROWS, World, sha

from provenlake.functions import fixed_values as fixed
from provenlake.operators import checks, digest, release, verify
from provenlake.plans import facts
from provenlake.plans import release as plan
from provenlake.sources import files, sinks, tables

IDENTITY = verify.VerifierIdentity("sim", "rev", "f" * 64, "profile-v1")
COLLECTION = "base-game-test"


def verdict(puzzle_bytes, solution_bytes):
    passed = len(solution_bytes) > 60
    return {
        "parse_status": "passed", "simulation_status": "passed" if passed else "failed", "cost": 10 if passed else None,
        "cycles": 20 if passed else None, "area": 30 if passed else None, "instructions": 2 if passed else None,
        "vanilla_constructible": True if passed else None, "record_eligible": None, "error_code": None if passed else "collision",
        "error_detail": None,
    }


@pytest.fixture(scope="module")
def world(tmp_path_factory):
    return World(tmp_path_factory.mktemp("world")).fill()


def inputs(spark, world):
    root = str(world.root)
    inventory, bad = files.read_inventory(spark, world.inventory())
    assert bad.collect() == []
    receipts = files.read_receipts(spark, root)
    assert files.receipt_violations(receipts).collect() == []
    return files.receipt_columns(receipts), files.read_objects(spark, root), inventory


@pytest.fixture(scope="module")
def built(spark, world):
    receipts, objects, inventory = inputs(spark, world)
    made, verifications = plan.run_pipeline(receipts, objects, inventory, COLLECTION, IDENTITY, verifier=verdict, payload_policy="include-permitted")
    # Later tests reuse the tables; keep them as files like a stage boundary would.
    folder = world.root / "stage"
    for name, df in made.items():
        df.write.parquet(str(folder / name))
    return {n: spark.read.parquet(str(folder / n)) for n in made}, verifications, inventory


def test_release_rows(built, world):
    made, verifications, _ = built
    solutions = {r.puzzle_id: r for r in made["solutions"].collect()}
    one = solutions["om.puzzle.0001"]
    assert one.solution_id == fixed.SOLUTION_PREFIX + sha(world.one) and one.source_count == 2
    assert one.verified and bytes(one.solution_bytes) == world.one and one.rights_status == "redistributable"
    assert not solutions["om.puzzle.0003"].verified and solutions["om.puzzle.0003"].solution_bytes is None
    assert all(r.normalized_solution_id for r in solutions.values())
    puzzles = {r.puzzle_id: r for r in made["puzzles"].collect()}
    assert puzzles["om.puzzle.0002"].display_name == "Rust, Gold"
    assert [a.value for a in puzzles["om.puzzle.0001"].aliases] == ["P007", "STABILIZED_WATER"]
    assert len(puzzles["om.puzzle.0001"].source_observation_ids) == 2 and len(puzzles["om.puzzle.0002"].source_observation_ids) == 1
    assert verifications.count() == 3


def test_observations(built):
    made, _, _ = built
    rows = made["observations"].collect()
    metadata = {r.source_path: r for r in rows if r.source_role == "metadata" and r.artifact_kind == "solution"}
    paired = metadata["CHAPTER_1/STABILIZED_WATER/y.json"]
    assert (paired.claimed_cost, paired.claimed_area, paired.source_declared_puzzle_id) == (20, None, "STABILIZED_WATER")
    assert paired.associated_artifact_path == "CHAPTER_1/STABILIZED_WATER/y.solution" and paired.artifact_id
    gone = metadata["CHAPTER_2/REFINED_GOLD/gone.json"]
    assert gone.artifact_id is None and gone.source_url == "https://l/2" and gone.associated_artifact_path == "CHAPTER_2/REFINED_GOLD/gone.solution"
    # mapped puzzles: artifact row and manifest evidence row; the fixture adds one more artifact row
    assert sum(r.artifact_kind == "puzzle" for r in rows) == 7


def test_build_validate_and_corrupt(spark, built, world, tmp_path):
    made, verifications, inventory = built
    folder = str(tmp_path / "release")
    metadata = plan.derived_metadata(made, verifications)
    assert metadata["verifier_revision"] == "rev" and metadata["normalizer_version"] == fixed.NORMALIZER_VERSION
    with pytest.raises(checks.ChecksFailed, match="collection_verified_coverage_incomplete"):
        plan.build_release(spark, made, inventory, folder, COLLECTION, metadata, "include-permitted", "complete")
    with pytest.raises(checks.ChecksFailed, match="payload_forbidden"):
        plan.build_release(spark, made, inventory, folder, COLLECTION, metadata, "metadata-only", "subset")
    manifest = plan.build_release(spark, made, inventory, folder, COLLECTION, metadata, "include-permitted", "subset", shards=2)
    assert manifest["tables"]["solutions"]["row_count"] == 3
    names = sorted(p.name for p in pathlib.Path(folder, "data", "solutions").glob("*.parquet"))
    assert names == [f"base_game_test-{i:05d}-of-{len(names):05d}.parquet" for i in range(len(names))]
    assert plan.validate_release(spark, folder, inventory, COLLECTION) == []
    assert plan.validate_release(spark, folder, inventory, "else")[0][0] == "collection_mismatch"
    # Row order across shards is the canonical one.
    stored = [r.solution_id for n in names for r in spark.read.parquet(f"{folder}/data/solutions/{n}").collect()]
    keys = {r.solution_id: (r.puzzle_id, r.solution_id) for r in made["solutions"].collect()}
    assert stored == sorted(stored, key=keys.get)

    again = plan.build_release(spark, made, inventory.repartition(3), str(tmp_path / "again"), COLLECTION, metadata, "include-permitted", "subset", shards=1)
    for table in fixed.RELEASE_TABLES:
        assert again["tables"][table]["records_digest"] == manifest["tables"][table]["records_digest"]

    shard = next(pathlib.Path(folder, "data", "puzzles").glob("*.parquet"))
    shard.write_bytes(shard.read_bytes()[:-1] + b"x")
    pathlib.Path(shard.parent, f".{shard.name}.crc").unlink(missing_ok=True)
    assert ("parquet_hash_mismatch", "puzzles") in plan.validate_release(spark, folder, inventory, COLLECTION)


def test_rebuild_is_identical(spark, built, world):
    receipts, objects, inventory = inputs(spark, world)
    second, _ = plan.run_pipeline(receipts.repartition(5), objects, inventory.repartition(2), COLLECTION, IDENTITY, verifier=verdict, payload_policy="include-permitted")
    assert plan.same_tables(built[0], second)
    changed = {**second, "solutions": second["solutions"].withColumn("cost", F.col("cost") + 1)}
    assert not plan.same_tables(built[0], changed)


def test_verdict_table_equals_verifier(spark, built, world):
    made, verifications, _ = built
    pairs = verifications.select("solution_id", "puzzle_artifact_id")
    verdicts = verifications.drop("verification_id", "puzzle_artifact_id", *IDENTITY.__dict__)
    joined = verify.join_verdicts(pairs, verdicts, IDENTITY)
    assert checks.multiset_difference(joined, verifications).count() == 0


def test_lines_round_trip(spark, built, tmp_path):
    made, _, _ = built
    folder = str(tmp_path / "lines")
    sinks.write_release_lines(made, folder)
    read, bad = tables.read_release_lines(spark, folder)
    assert bad.collect() == []
    assert plan.same_tables(made, read)
    line = json.loads(spark.read.text(f"{folder}/normalized.jsonl").first()[0])
    assert line["parts"] == [] or isinstance(line["parts"][0]["parameters"], dict)
    # The digest follows from the written lines, in whatever order they are read.
    lines = spark.read.text(f"{folder}/solutions.jsonl").repartition(3)
    assert plan.table_digest(made["solutions"], "solutions")["records_digest"] == digest.multiset_digest(lines, row_json=F.col("value")).first().digest


def test_line_violations(spark, built, tmp_path):
    made, _, _ = built
    folder = tmp_path / "lines"
    sinks.write_release_lines(made, str(folder))
    for table in fixed.RELEASE_TABLES:
        text = "".join(p.read_text() for p in sorted((folder / f"{table}.jsonl").glob("part-*")))
        for p in (folder / f"{table}.jsonl").iterdir():
            p.unlink()
        (folder / f"{table}.jsonl").rmdir()
        (folder / f"{table}.jsonl").write_text(text)
    row = json.loads((folder / "solutions.jsonl").read_text().splitlines()[0])
    bad = [{**row, "extra": 1}, {**row, "cost": True}, {k: v for k, v in row.items() if k != "area"}, {**row, "solution_bytes": "YQ"}, 5]
    (folder / "solutions.jsonl").write_text("\n".join([json.dumps(row), "", "{oops", *map(json.dumps, bad)]) + "\n")
    observations = [json.loads(x) for x in (folder / "observations.jsonl").read_text().splitlines()]
    for o in observations:
        for name in tables.OPTIONAL_COLUMNS["observations"]:
            o.pop(name)
    (folder / "observations.jsonl").write_text("".join(json.dumps(o) + "\n" for o in observations))
    (folder / "normalized.jsonl").write_text("\n")
    _, found = tables.read_release_lines(spark, str(folder))
    got = sorted((r.path, r.code, r.row_key) for r in found.collect())
    assert got == [
        ("normalized", "input_empty", None), ("solutions", "json_invalid", "3"), ("solutions", "schema_invalid", "4"),
        ("solutions", "schema_invalid", "5"), ("solutions", "schema_invalid", "6"), ("solutions", "schema_invalid", "7"),
        ("solutions", "schema_invalid", "8"),
    ]


def break_table(df, column, value):
    return df.withColumn(column, value)


@pytest.mark.parametrize(
    "table,change,code",
    [
        ("solutions", lambda d: d.withColumn("puzzle_id", F.lit("om.puzzle.0009")), "referential_integrity"),
        ("solutions", lambda d: d.withColumn("puzzle_artifact_id", F.lit("none")), "referential_integrity"),
        ("normalized", lambda d: d.withColumn("solution_id", F.lit("none")), "referential_integrity"),
        ("observations", lambda d: d.withColumn("artifact_id", F.when(F.col("artifact_id").isNotNull(), "none")), "referential_integrity"),
        ("solutions", lambda d: d.withColumn("collection_id", F.lit("x")), "collection_mismatch"),
        ("solutions", lambda d: d.withColumn("cost", F.lit(-1).cast("bigint")), "schema_invalid"),
        ("solutions", lambda d: d.unionByName(d), "duplicate_solution_id"),
        ("puzzles", lambda d: d.where("puzzle_id <> 'om.puzzle.0001'"), "referential_integrity"),
        ("solutions", lambda d: d.withColumn("rights_status", F.lit("unknown")), "payload_rights_violation"),
    ],
)
def test_release_gates(built, table, change, code):
    made, _, inventory = built
    broken = {**made, table: change(made[table])}
    found = plan.release_violations(broken, inventory, COLLECTION, "include-permitted", "subset")
    assert code in {r.code for r in found.collect()}


@pytest.mark.parametrize(
    "name,change,code",
    [
        ("verifications", lambda d: d.where("1 = 0"), "verification_missing"),
        ("verifications", lambda d: d.withColumn("verification_id", F.lit("om.verification." + "0" * 64)), "verification_invalid"),
        ("verifications", lambda d: d.withColumn("solution_id", F.concat("solution_id", F.lit("x"))), "verification_unknown_solution"),
        ("normalized", lambda d: d.withColumn("normalizer_version", F.lit("v9")), "normalized_identity"),
        ("observations", lambda d: d.withColumn("author", F.lit("forged")), "observation_invalid"),
        ("observations", lambda d: d.where("artifact_kind = 'solution'"), "artifact_unobserved"),
        ("observations", lambda d: d.where("artifact_kind = 'puzzle'"), "solution_unobserved"),
        ("definitions", lambda d: d.withColumn("output_scale", F.col("output_scale") + 1), "definition_invalid"),
        ("definitions", lambda d: d.where("puzzle_id <> 'om.puzzle.0001'"), "definition_missing"),
        ("inventory", lambda d: d.where("puzzle_id <> 'om.puzzle.0001'"), "definition_outside_collection"),
        ("solution_artifacts", lambda d: d.withColumn("object_key", F.lit("k")), "artifact_invalid"),
        ("puzzle_artifacts", lambda d: d.withColumn("puzzle_id", F.lit("om.puzzle.0002")), "artifact_unbound"),
    ],
)
def test_projection_gates(spark, built, world, name, change, code):
    made, verifications, inventory = built
    if not hasattr(world, "parts"):
        receipts, objects, _ = inputs(spark, world)
        p, s = facts.puzzle_facts(receipts, objects, inventory), facts.solution_facts(receipts, objects, inventory)
        kept = {}
        for label, df in {"definitions": p.definitions, "puzzle_artifacts": p.artifacts, "solution_artifacts": s.artifacts}.items():
            df.write.mode("overwrite").parquet(str(world.root / "parts" / label))
            kept[label] = spark.read.parquet(str(world.root / "parts" / label))
        world.parts = {"inventory": inventory, **kept, "observations": made["observations"], "verifications": verifications, "normalized": made["normalized"]}
    clean = world.parts
    found = release.materialization_violations(**{**clean, name: change(clean[name])})
    assert code in {r.code for r in found.collect()}


def test_projection_gates_pass_on_clean_input(spark, built, world):
    if hasattr(world, "parts"):
        assert release.materialization_violations(**world.parts).collect() == []


def test_views_written(spark, built, tmp_path):
    from provenlake.operators.views import solution_views

    made, _, _ = built
    folder = str(tmp_path / "views")
    sinks.write_views(solution_views(made["solutions"]), folder)
    counts = {v: spark.read.text(f"{folder}/view={v}").count() for v in fixed.SOLUTION_VIEWS}
    assert counts == {"all-verified": 2, "vanilla-constructible": 2, "record-eligible": 0}


def test_tiny_definition_golden(spark):
    """Published identity of the one-atom definition."""
    from provenlake.operators.reconcile import definition_violations, reconcile_definitions

    atom = '[{"atoms":[{"atom_type":"salt","q":0,"r":0}],"bonds":[]}]'
    values = {
        "allowed_instructions": '["grab","drop"]', "allowed_parts": '["bonder","arm1"]', "output_scale": "1", "production": "false",
        "production_constraints": "null", "products": atom, "reagents": atom, "target_output_count": "6",
    }
    claims = spark.createDataFrame([("om.puzzle.0001", ["o1"], None, f, v) for f, v in values.items()], "puzzle_id string, observation_ids array<string>, puzzle_artifact_id string, field string, value_json string")
    inventory = spark.createDataFrame([("om.puzzle.0001",)], "puzzle_id string")
    done = reconcile_definitions(inventory, claims)
    assert done.violations.collect() == []
    assert done.definitions.first().puzzle_definition_id == "om.puzzle-definition.sha256.43d6f45eb81ec230a9ccc5442df930c9a685ad06bd27cc9d5dc44aadbd74d47a"
    assert definition_violations(done.definitions).collect() == []


def test_reconciliation(spark):
    from provenlake.operators.reconcile import reconcile_definitions

    schema = "puzzle_id string, observation_ids array<string>, puzzle_artifact_id string, field string, value_json string"
    rows = [
        ("p1", ["b", "a"], "art", "output_scale", "1"), ("p1", ["c"], None, "output_scale", "1"), ("p1", ["c"], None, "production", "false"),
        ("p2", ["d"], None, "allowed_parts", '["a","b"]'), ("p2", ["e"], None, "allowed_parts", '["b","c"]'),
        ("p3", ["f"], None, "production", "false"), ("p1", [], None, "production", "false"), ("p1", ["g"], None, "colour", "1"),
    ]
    inventory = spark.createDataFrame([("p1",), ("p2",)], "puzzle_id string")
    done = reconcile_definitions(inventory, spark.createDataFrame(rows, schema))
    assert done.definitions.count() == 0
    found = {(r.code, r.detail, r.row_key) for r in done.violations.collect()}
    assert ("claim_conflict", "allowed_parts[0]", "p2") in found and ("claim_outside_collection", "production", "p3") in found
    assert ("claim_unobserved", "no observation id", "p1") in found and ("claim_invalid", "colour: unknown_field", "p1") in found
    p1 = {r.puzzle_id: r for r in done.resolutions.collect()}["p1"]
    assert p1.source_observation_ids == ["a", "b", "c", "g"] and p1.puzzle_artifact_ids == ["art"]
    assert p1.missing_fields == sorted(set(fixed.SEMANTIC_FIELDS) - {"output_scale", "production"})


def test_official_set_must_match_its_revision(spark, tmp_path):
    w = World(tmp_path)
    revision = w.official()
    w.land("official-game", revision, "puzzles/extra.puzzle", b"extra")
    w.land("official-game", "local-" + "0" * 64, "puzzles/P007.puzzle", b"x")
    receipts, objects, inventory = inputs(spark, w)
    _, bad = facts.official_candidates(receipts, objects, inventory)
    assert {r.code for r in bad.collect()} == {"file_unmapped", "manifest_missing"}
    revisions = [r.revision for r in files.source_revisions(spark, str(tmp_path), "official-game").collect()]
    assert revisions == sorted([revision, "local-" + "0" * 64])


def test_inventory_checks(spark, tmp_path):
    w = World(tmp_path)
    rows, bad = files.read_inventory(spark, w.inventory())
    assert bad.collect() == [] and [r.row_no for r in rows.orderBy("row_no").collect()] == [2, 3, 4]
    assert files.inventory_violations(rows, 3, {"chapter": 2, "journal_xcix": 1}).collect() == []
    broken = [ROWS[0], ROWS[0], ROWS[1] + ",x", ROWS[2].replace("P050", "bad"), "om.puzzle.0004,N,campaign,chapter-1,P011,K"]
    rows, bad = files.read_inventory(spark, w.inventory(broken))
    got = {(r.code, r.row_key) for r in bad.collect()}
    assert got == {("inventory_row_error", "4"), ("inventory_row_error", "5"), ("inventory_row_error", "6")}
    found = {(r.code, r.row_key) for r in files.inventory_violations(rows, 9, {"chapter": 2, "chapter_1": 2}).collect()}
    assert {("duplicate_puzzle_id", "3"), ("duplicate_game_puzzle_id", "3"), ("duplicate_leaderboard_key", "3"), ("puzzle_id_sequence_error", "3")} <= found
    assert ("puzzle_count_mismatch", None) in found and ("group_rollup_overlap", "2") in found and ("group_rollup_unmatched", "5") in found
    _, bad = files.read_inventory(spark, w.inventory(header="puzzle_id,wrong"))
    assert ("inventory_header_error", "1") in {(r.code, r.row_key) for r in bad.collect()}


def test_collections_directory(spark, tmp_path):
    w = World(tmp_path)
    csv_path = pathlib.Path(w.inventory())
    text = 'collection_id = "c"\ninventory_file = "inventory.csv"\npuzzle_count = 3\ninventory_sha256 = "{}"\n[group_counts]\nchapter = 2\njournal_xcix = 1\n'
    (tmp_path / "c.toml").write_text(text.format(sha(csv_path.read_bytes())))
    (found,) = files.read_collections(spark, str(tmp_path))
    assert found[0]["collection_id"] == "c" and found[2].collect() == []
    (tmp_path / "c.toml").write_text(text.format("0" * 64))
    (found,) = files.read_collections(spark, str(tmp_path))
    assert [r.code for r in found[2].collect()] == ["inventory_hash_mismatch"]


def test_lines_are_numbered_across_blocks(spark, tmp_path):
    from provenlake.operators.ordering import numbered_lines

    for name, n in (("a.txt", 5000), ("b.txt", 10)):
        (tmp_path / name).write_text("".join(f"{i + 1} {'x' * (i % 97)}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 5010 and all(r.line.split(" ")[0] == str(r.line_no) for r in rows)


def test_receipt_file_checks(spark, tmp_path):
    w = World(tmp_path)
    w.land("s", "r", "ok", b"1")
    folder = tmp_path / "receipts" / "s" / "r"
    good = json.loads(next(folder.iterdir()).read_text())
    (folder / "renamed.json").write_text(json.dumps(good))
    (folder / "extra.json").write_text(json.dumps({**good, "more": 1}))
    (folder / "typed.json").write_text(json.dumps({**good, "byte_length": "1"}))
    (folder / "bad.json").write_text("{")
    found = files.receipt_violations(files.read_receipts(spark, str(tmp_path), "s", "r"))
    by_file = {}
    for r in found.collect():
        by_file.setdefault(r.row_key.rsplit("/", 1)[1], set()).add(r.detail)
    assert set(by_file) == {"renamed.json", "extra.json", "typed.json", "bad.json"}
    assert by_file["renamed.json"] == {"receipt identity does not match its file"}
    assert "fields are missing or unknown" in by_file["extra.json"] and "field types are wrong" in by_file["typed.json"]
    receipts = files.receipt_columns(files.read_receipts(spark, str(tmp_path), "s", "r").where("file_name NOT IN ('bad.json')"))
    assert {r.code for r in files.exact_path_set_violations(receipts, ["ok", "gone"]).collect()} == {"evidence_missing", "evidence_repeated"}


def test_dump_reconcile(spark, tmp_path):
    from test_binary import puzzle

    w = World(tmp_path)
    inventory, _ = files.read_inventory(spark, w.inventory())
    dump = tmp_path / "dump"
    dump.mkdir()
    (dump / "a.puzzle").write_bytes(puzzle("Stabilized Water"))
    (dump / "b.puzzle").write_bytes(puzzle("Refined  gold!"))
    (dump / "c.puzzle").write_bytes(puzzle("Refined gold", scale=3))
    (dump / "d.puzzle").write_bytes(puzzle("Someone Else"))
    landed = files.landed_files(spark, str(dump))
    mappings, bad = files.reconcile_dump(landed, inventory)
    assert {(r.code, r.row_key) for r in bad.collect()} == {("dump_ambiguous", "om.puzzle.0002"), ("dump_missing", "om.puzzle.0003")}
    assert {(r.puzzle_id, r.path, r.dump_path) for r in mappings.collect()} == {
        ("om.puzzle.0001", "puzzles/P007.puzzle", "a.puzzle"), ("om.puzzle.0002", "puzzles/P010.puzzle", "b.puzzle")
    }
    table = spark.createDataFrame([("om.puzzle.0001", "puzzles/./a.puzzle"), ("om.puzzle.0009", "/b.puzzle"), ("om.puzzle.0002", "x\\y.puzzle")], "puzzle_id string, path string")
    codes = {(r.code, r.row_key) for r in files.mapping_violations(table, inventory).collect()}
    assert codes == {("mapping_outside_collection", "om.puzzle.0009"), ("mapping_path_invalid", "om.puzzle.0009"), ("mapping_path_invalid", "om.puzzle.0002")}
    found, lost = files.mapped_files(table, landed.withColumn("upstream_path", F.concat(F.lit("puzzles/"), "upstream_path")))
    assert [r.puzzle_id for r in found.collect()] == ["om.puzzle.0001"] and lost.count() == 2


def test_manifest_commits_to_sources_config_and_metadata(spark, built, tmp_path):
    made, verifications, inventory = built
    sinks.write_release_lines(made, str(tmp_path / "in"))
    sources = {t: f"{tmp_path}/in/{t}.jsonl" for t in made}
    metadata, out = plan.derived_metadata(made, verifications), str(tmp_path / "out")
    manifest = plan.build_release(spark, made, inventory, out, COLLECTION, metadata, "include-permitted", "subset", config={"compression": "zstd"}, sources=sources)
    assert manifest["tables"]["solutions"]["source_path"] == "solutions.jsonl"
    assert manifest["build_config_sha256"] == hashlib.sha256(b'{"compression":"zstd"}').hexdigest()
    assert plan.validate_release(spark, out, inventory, COLLECTION) == [] and plan.source_violations(spark, out, sources) == []
    part = next(pathlib.Path(sources["solutions"]).glob("part-*"))
    text = part.read_text()
    pathlib.Path(part.parent, f".{part.name}.crc").unlink(missing_ok=True)
    part.write_text(text.replace('"cost":', '"cost": ', 1))
    assert plan.source_violations(spark, out, sources) == [("source_changed", "solutions")]
    record = pathlib.Path(out, "release-manifest.json")
    target = next(record.glob("part-*")) if record.is_dir() else record
    pathlib.Path(target.parent, f".{target.name}.crc").unlink(missing_ok=True)
    changed = json.loads(target.read_text())
    changed["release_metadata"]["verifier_revision"] = "other"
    changed["logical_release_sha256"] = plan.logical_release_hash(changed)
    target.write_text(json.dumps(changed))
    assert ("release_metadata_hash_mismatch", "release-manifest.json") in plan.validate_release(spark, out, inventory, COLLECTION)
