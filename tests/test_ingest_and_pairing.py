"""Exact dedup, provenance, conflicts, layouts, metadata pairing and receipt appends."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from provenlake.functions import fixed_values as fixed
from provenlake.operators import checks, ingest, pairing
from provenlake.sources import files, sinks


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def receipt(path, body="x", source="s", rights="unknown", revision="r", at="t0"):
    return {
        "source_id": source, "revision": revision, "upstream_path": path, "sha256": sha(body),
        "byte_length": len(body), "rights_status": rights, "retrieved_at": at,
    }


def candidate(art, evidence=None, kind="solution", puzzle="p1", form=None, **extra):
    row = {
        "artifact_kind": kind, "puzzle_id": puzzle, "artifact_format": form or kind, "artifact_receipt": art,
        "evidence_receipt": evidence, "source_object_id": None, "source_url": None, "author": None,
        "claimed_cost": None, "claimed_cycles": None, "claimed_area": None, "claimed_instructions": None,
    }
    return {**row, **extra}


def frame(spark, rows):
    return spark.createDataFrame(rows, ingest.CANDIDATE)


def codes(df):
    return sorted({r.code for r in df.collect()})


def test_copies_fold_to_one_artifact_with_strictest_rights(spark):
    rows = [
        candidate(receipt("a.solution", "same", "s1", "redistributable")),
        candidate(receipt("b.solution", "same", "s2", "local_fetch_only")),
        candidate(receipt("c.solution", "same", "s3", "unknown")),
        candidate(receipt("d.solution", "other", "s1", "redistributable")),
    ]
    for order in (rows, rows[::-1]):
        done = ingest.ingest_artifacts(frame(spark, order).repartition(3))
        got = {r.sha256: r for r in done.artifacts.collect()}
        assert got[sha("same")].rights_status == "local_fetch_only" and got[sha("other")].rights_status == "redistributable"
        assert got[sha("same")].artifact_id == fixed.SOLUTION_PREFIX + sha("same")
        assert done.provenance.count() == 4 and codes(done.violations) == []


def test_evidence_row_carries_the_claims(spark):
    art, evidence = receipt("a.solution", "body"), receipt("a.json", "{}", rights="local_fetch_only")
    done = ingest.ingest_artifacts(frame(spark, [
        candidate(art, evidence, source_url="u", author="me", claimed_cost=5),
        candidate(art, evidence, source_url="u", author="me", claimed_cost=5),
    ]))
    got = {r.source_role: r for r in done.provenance.collect()}
    assert set(got) == {"artifact", "evidence"}
    assert got["artifact"].claimed_cost is None and got["artifact"].source_url is None
    assert (got["evidence"].claimed_cost, got["evidence"].author, got["evidence"].source_evidence_sha256) == (5, "me", sha("{}"))
    assert got["evidence"].observed_sha256 == sha("body")
    # evidence rights do not enter the fold
    assert done.artifacts.first().rights_status == "unknown"


@pytest.mark.parametrize(
    "rows,code",
    [
        ([candidate(receipt("a", "x")), candidate(receipt("b", "x"), puzzle="p2")], "artifact_conflict"),
        ([candidate(receipt("a", "x")), candidate(receipt("b", "x"), form="other")], "artifact_conflict"),
        ([candidate(receipt("a", "x")), candidate(receipt("a", "y"))], "association_conflict"),
        ([candidate(receipt("a", "x"), kind="movie")], "unsupported_kind"),
        ([candidate(receipt("a", "x", rights="free"))], "invalid_rights"),
        ([candidate(receipt("a", "x"), receipt("e", "{}", rights="free"))], "invalid_rights"),
        ([candidate(receipt("a", "x"), receipt("e", "{}", source="t"))], "evidence_source_mismatch"),
        ([candidate(receipt("a", "x"), receipt("a", "y"))], "receipt_conflict"),
        ([candidate(receipt("a", "x"), receipt("e", "{}")), candidate(receipt("b", "y"), receipt("e", "{}"))], "evidence_conflict"),
    ],
)
def test_ambiguous_candidates(spark, rows, code):
    assert code in codes(ingest.candidate_violations(frame(spark, rows)))


def test_null_object_id_is_its_own_key(spark):
    rows = [
        candidate(receipt("a", "x"), receipt("e", "{}"), source_object_id=None),
        candidate(receipt("b", "y"), receipt("e", "{}"), source_object_id=""),
    ]
    assert codes(ingest.candidate_violations(frame(spark, rows))) == []


def test_objects_must_match(spark):
    rows = frame(spark, [candidate(receipt("a", "x")), candidate(receipt("b", "yy")), candidate(receipt("c", "z"))])
    key = lambda b: f"objects/sha256/{sha(b)[:2]}/{sha(b)[2:]}"
    objects = spark.createDataFrame([(key("yy"), 3, sha("yyy")), (key("z"), 1, sha("q"))], "object_key string, byte_length bigint, sha256 string")
    assert codes(ingest.candidate_violations(rows, objects)) == ["object_corrupt", "object_length_mismatch", "object_missing"]


def test_layouts(spark):
    groups = ["chapter-1", "appendix", "journal-xcix-ix", "journal-xcix-x", "journal-cviii-xii", "journal-cviii-xiii", "other"]
    df = spark.createDataFrame([(g, "KEY", "p") for g in groups], "group string, leaderboard_key string, puzzle_id string")
    got = {r.group: (r.a, r.b) for r in df.select("group", pairing.archive_directory(F.col("group")).alias("a"), pairing.leaderboard_directory(F.col("group")).alias("b")).collect()}
    assert got == {
        "chapter-1": ("CHAPTER_1", "CHAPTER_1"), "appendix": ("CHAPTER_PRODUCTION",) * 2, "journal-xcix-ix": ("JOURNAL_IX",) * 2,
        "journal-xcix-x": (None, "JOURNAL_X"), "journal-cviii-xii": (None, "JOURNAL_CVIII_XII"), "journal-cviii-xiii": (None, None), "other": (None, None),
    }
    layout = pairing.source_layout(df, pairing.archive_directory)
    files = spark.createDataFrame([("CHAPTER_1/KEY/a.solution", "s"), ("CHAPTER_1/KEY/.solution", "s"), ("CHAPTER_1/KEY/b.json", "s"), ("CHAPTER_1/KEY/x/a.solution", "s"), ("JOURNAL_X/KEY/a.solution", "s")], "upstream_path string, source_id string")
    mapped = pairing.mapped_receipts(files, layout, ".solution")
    assert [r.upstream_path for r in mapped.collect()] == ["CHAPTER_1/KEY/a.solution"]
    count = pairing.landing_counts(mapped).first()
    assert (count.candidate_count, count.puzzles_covered) == (1, 1)


@pytest.mark.parametrize(
    "document,error",
    [
        ({}, None), ({"score": None}, None), ({"score": {"cost": 3, "cycles": None}}, None), ({"dataPath": "a/./b.solution"}, None),
        ({"score": 5}, "invalid_score"), ({"score": {"cost": True}}, "invalid_metric"), ({"score": {"cost": -1}}, "invalid_metric"),
        ({"score": {"cost": "3"}}, "invalid_metric"), ({"score": {"area": 1.5}}, "invalid_metric"), ({"dataLink": ""}, "invalid_link"),
        ({"displayLink": 4}, "invalid_link"), ({"dataLink": "x", "displayLink": ""}, None), ({"puzzle": ""}, "invalid_puzzle"),
        ({"dataPath": "/a.solution"}, "invalid_data_path"), ({"dataPath": "../a.solution"}, "invalid_data_path"),
        ({"dataPath": "a.json"}, "invalid_data_path"), ({"dataPath": ""}, "invalid_data_path"), ([1], "not_an_object"), ("{bad", "invalid_json"),
    ],
)
def test_metadata_documents(spark, document, error):
    text = document if isinstance(document, str) else json.dumps(document)
    row = pairing.read_metadata(spark.createDataFrame([(text,)], "t string"), "t").first()
    assert row.error == error
    if error is None and document.get("dataPath"):
        assert row.data_path == "a/b.solution"


def test_pairing_outcomes(spark):
    layout = spark.createDataFrame([("D/A", "p1"), ("D/B", "p2")], "directory string, puzzle_id string")
    solutions = spark.createDataFrame([("D/A/x.solution", "p1", "one"), ("D/B/y.solution", "p2", "two"), ("D/A/D/A/x.solution", "p1", "three")], "solution_path string, solution_puzzle_id string, name string")
    cases = {
        "relative": ("D/A/m.json", "p1", "x.solution"), "missing": ("D/A/m.json", "p1", "gone.solution"), "none": ("D/A/m.json", "p1", None),
        "declared_missing": ("D/A/m.json", "p1", "D/A/gone.solution"), "other": ("D/A/m.json", "p1", "D/B/y.solution"),
        "both": ("D/A/m.json", "p1", "D/A/x.solution"), "root": ("D/B/m.json", "p2", "D/B/y.solution"),
    }
    metadata = spark.createDataFrame([(k, *v) for k, v in cases.items()], "k string, metadata_path string, puzzle_id string, data_path string")
    got = {r.k: (r.resolved_path, r.pair_error, r.name) for r in pairing.pair_by_path(metadata, solutions, layout).collect()}
    assert got["relative"] == ("D/A/x.solution", None, "one")
    assert got["missing"] == ("D/A/gone.solution", None, None) and got["none"] == (None, None, None)
    assert got["declared_missing"] == ("D/A/gone.solution", None, None) and got["root"] == ("D/B/y.solution", None, "two")
    assert got["other"][1] == "data_path_other_puzzle" and got["both"][1] == "data_path_ambiguous"


def test_observation_ids_ignore_retrieval_time(spark):
    def observe(at):
        done = ingest.ingest_artifacts(frame(spark, [candidate(receipt("a.solution", "x", at=at))]))
        rows, _ = pairing.observations_from_provenance(done.provenance, "solution", "v1")
        return rows.first().observation_id

    assert observe("t1") == observe("t2")


def test_observation_id_commits_to_every_field(spark):
    body = {c: None for c in pairing.OBSERVATION_COLUMNS if c != "observation_id"}
    body |= {"artifact_kind": "solution", "source_id": "s", "rights_status": "unknown", "importer_version": "v"}
    numbers = {c for c in body if c.startswith("claimed") or c.endswith("length")}
    ddl = ", ".join(f"{c} {'bigint' if c in numbers else 'string'}" for c in body)
    rows = [body] + [{**body, c: 7 if c in numbers else "changed"} for c in body]
    got = pairing.with_observation_id(spark.createDataFrame(rows, ddl)).collect()
    assert len({r.observation_id for r in got}) == len(rows)
    text = json.dumps(body, sort_keys=True, separators=(",", ":"))
    assert fixed.OBSERVATION_PREFIX + sha(text) in {r.observation_id for r in got}


def test_receipt_append(spark, tmp_path):
    ddl = "source_id string, revision string, upstream_path string, sha256 string, byte_length bigint, rights_status string, retrieved_at string"
    first = spark.createDataFrame([receipt("a"), receipt("b")], ddl)
    path = str(tmp_path / "receipts")
    assert sinks.append_receipts(spark, path, first) == 2
    assert sinks.append_receipts(spark, path, spark.createDataFrame([receipt("a", at="later"), receipt("c")], ddl)) == 1
    assert sinks.append_receipts(spark, path, first) == 0
    with pytest.raises(checks.ChecksFailed, match="pinned_path_changed"):
        sinks.append_receipts(spark, path, spark.createDataFrame([receipt("a", "changed")], ddl))
    assert spark.read.parquet(path).count() == 3


def test_receipts_land_incrementally(spark, tmp_path):
    from provenlake.streaming.receipts import land_receipts

    landing = tmp_path / "in"
    landing.mkdir()
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    (landing / "1.json").write_text(json.dumps(receipt("a")))
    land_receipts(spark, str(landing), table, state).awaitTermination(120)
    (landing / "2.json").write_text(json.dumps(receipt("b")) + "\n" + json.dumps(receipt("a", at="later")))
    land_receipts(spark, str(landing), table, state).awaitTermination(120)
    assert sorted(r.upstream_path for r in spark.read.parquet(table).collect()) == ["a", "b"]


def test_broken_receipts_are_quarantined(spark, tmp_path):
    from provenlake.streaming.receipts import land_receipts

    landing, table = tmp_path / "in", str(tmp_path / "receipts")
    landing.mkdir()
    good = {"source_id": "s", "revision": "r", "upstream_path": "p", "sha256": "a" * 64, "byte_length": 1, "rights_status": "unknown", "retrieved_at": "t"}
    bad = [{**good, "revision": ""}, {**good, "byte_length": -1}, {**good, "rights_status": "mine"}, {k: v for k, v in good.items() if k != "sha256"}, 5]
    (landing / "a.json").write_text("\n".join(["{oops", *map(json.dumps, bad), json.dumps(good), ""]) + "\n")
    land_receipts(spark, str(landing), table, str(tmp_path / "state")).awaitTermination(120)
    assert [r.upstream_path for r in spark.read.parquet(table).collect()] == ["p"]
    quarantined = spark.read.parquet(table + "-quarantine").collect()
    assert len(quarantined) == 6 and all(r.broken for r in quarantined)


def test_objects_below_a_root_with_the_same_folder_name(spark, tmp_path):
    root = tmp_path / "objects" / "store (1)+"
    target = root / "objects" / "sha256" / "ab"
    target.mkdir(parents=True)
    (target / "cd").write_bytes(b"x")
    assert [r.object_key for r in files.read_objects(spark, str(root)).collect()] == ["objects/sha256/ab/cd"]
    assert [r.upstream_path for r in files.landed_files(spark, str(root)).select("upstream_path").collect()] == ["objects/sha256/ab/cd"]


def test_pinned_files(spark, tmp_path):
    for name, data in (("a", b"1"), ("b", b"2"), ("other", b"3")):
        (tmp_path / name).write_bytes(data)
    rows = [(f"{tmp_path}/a", sha(b"1")), (f"{tmp_path}/b", sha(b"0")), (f"{tmp_path}/gone", sha(b"1"))]
    found = files.file_digest_violations(spark, spark.createDataFrame(rows, "path string, sha256 string"))
    assert sorted(r.row_key.rsplit("/", 1)[1] for r in found.collect()) == ["b", "gone"]
    assert files.file_digest_violations(spark, spark.createDataFrame([], "path string, sha256 string")).count() == 0


def test_an_unreadable_mapping_does_not_stop_the_job(spark):
    from provenlake.plans import facts

    good = b'snapshot_id = "s"\n[[puzzles]]\npuzzle_id = "om.puzzle.0001"\npath = "a.puzzle"\n'
    rows = [("r1", good), ("r2", b"\xff\xfe"), ("r3", b"= nothing"), ("r4", b"snapshot_id = 1\n")]
    got = facts.read_mappings(spark.createDataFrame([(a, bytearray(b)) for a, b in rows], "revision string, content binary")).collect()
    assert [(r.revision, r.path, r.error is None) for r in got] == [("r1", "a.puzzle", True), ("r2", None, False), ("r3", None, False), ("r4", None, False)]
