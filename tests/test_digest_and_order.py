"""Digests, global positions and generic checks against brute force."""

import hashlib
import json
from collections import Counter

from pyspark.sql import functions as F

from provenlake.operators import checks, coverage, digest, ordering, views


def py_json(value):
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def word_sums(rows, frame=""):
    hashes = [sha(py_json(r)) for r in rows]
    sums = [sum(int(h[8 * i : 8 * i + 8], 16) for h in hashes) for i in range(8)]
    return sha(":".join([frame, str(len(rows)), *map(str, sums)]))


def test_digest_is_a_multiset_identity(spark):
    rows = [{"a": i % 40, "b": f"x{i % 7}"} for i in range(300)] + [{"a": 1, "b": "hot"}] * 200
    df = spark.createDataFrame(rows, "a int, b string")
    for placed in (df.repartition(7), df.orderBy("b"), df.repartition(3, "b")):
        assert tuple(digest.multiset_digest(placed).first()) == (500, word_sums(rows))
    assert digest.multiset_digest(df, frame="f").first().digest == word_sums(rows, "f")
    assert digest.multiset_digest(df.limit(499)).first().digest != word_sums(rows)
    assert tuple(digest.multiset_digest(df.limit(0)).first()) == (0, word_sums([]))


def test_published_hash(spark):
    rows = [(i, f"t{i % 3}\x1f") for i in range(50)]
    lines = spark.createDataFrame(rows, "id int, line string").repartition(5)
    assert digest.published_sha256(lines, [F.col("id")], "[", ",", "]") == sha("[" + ",".join(t for _, t in rows) + "]")
    assert digest.published_sha256(lines.where("id < 0"), [F.col("id")], "[", ",", "]") == sha("[]")


def test_global_positions_with_a_hot_key(spark):
    rows = [(None if i % 3 else f"k{i % 5}", i) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, i int").repartition(6)
    got = {r.i: r.row_no for r in ordering.global_row_number(df, [ordering.text_key("k"), F.col("i")], partitions=5).collect()}
    expected = {i: n for n, (_, i) in enumerate(sorted(((k or "None"), i) for k, i in rows), 1)}
    assert got == expected
    placed = ordering.number_in_buckets(df, F.floor(F.col("i") / 50), [F.col("i")])
    assert all(r.row_no == r.i + 1 for r in placed.collect())


def test_release_and_observation_orders(spark):
    df = spark.createDataFrame([("om.x", "2"), (None, "1"), ("Zed", "3")], "artifact_id string, observation_id string")
    by = lambda order: [r.observation_id for r in df.orderBy(*order).collect()]
    # A present null sorts as the word None in releases, as empty in observations, first in provenance.
    assert by(ordering.release_order("observations")) == ["1", "3", "2"]
    assert by(ordering.empty_for_null_order(["artifact_id", "observation_id"])) == ["1", "3", "2"]
    assert by(ordering.nulls_first_order(["artifact_id"])) == ["1", "3", "2"]
    upper = spark.createDataFrame([("AAA", "1"), (None, "2")], df.schema)
    assert [r.observation_id for r in upper.orderBy(*ordering.release_order("observations")).collect()] == ["1", "2"]


def test_differences_and_dependencies(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "b")], "a int, b string")
    right = spark.createDataFrame([(1, None), (2, "b"), (3, "c")], "a int, b string")
    assert {(r.a, r.left_count, r.right_count) for r in checks.multiset_difference(left, right).collect()} == {(1, 2, 1), (3, 0, 1)}
    assert {(r.a, r.side) for r in checks.set_difference(left, right, "a").collect()} == {(3, "unexpected")}
    rows = spark.createDataFrame([("k", 1, None), ("k", 1, None), ("m", 1, None), ("m", 1, 2), (None, 1, 1), (None, 2, 1)], "k string, x int, y int")
    assert {r.k for r in checks.dependency_conflicts(rows, ["k"], ["x", "y"]).collect()} == {"m", None}
    found = checks.unique_key_violations(rows, "k", "t").collect()
    assert {(r.code, r.row_key) for r in found} == {("invalid_k", None), ("duplicate_k", "k"), ("duplicate_k", "m")}
    tolerant = checks.unique_key_violations(rows, "k", "t", tolerate_identical=True).collect()
    assert {(r.code, r.row_key) for r in tolerant if r.row_key} == {("conflicting_k", "m")}


def test_pareto_against_brute_force(spark):
    points = [("g", (i * 7) % 23, (i * 11) % 19) for i in range(120)] + [("h", 1, 1), ("h", 1, 1), ("h", 2, 1)]
    df = spark.createDataFrame(points + [("g", None, 1)], "g string, x int, y int")
    got = {(r.g, r.x, r.y): r.rows for r in views.pareto_pair(df, "g", "x", "y").collect()}
    best = {
        (g, x, y): n for (g, x, y), n in Counter(points).items()
        if not any(g2 == g and x2 <= x and y2 <= y and (x2, y2) != (x, y) for g2, x2, y2 in points)
    }
    assert got == best


def test_running_folds_split_a_hot_group(spark):
    rows = [("hot", i, (i * 37) % 211) for i in range(200)] + [(f"g{i}", i, i) for i in range(40)] + [(f"g{i}", i + 1, i + 5) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, x int, y int").repartition(6)
    got = {(r.g, r.x): r.low for r in ordering.running_before(df, "g", "x", "y", "low", partitions=7).collect()}
    for g, x, _ in rows:
        earlier = [y2 for g2, x2, y2 in rows if g2 == g and x2 < x]
        assert got[(g, x)] == (min(earlier) if earlier else None)
    sums = {(r.g, r.x): r.total for r in ordering.running_before(df, "g", "x", "y", "total", F.sum, partitions=7).collect()}
    assert all(sums[(g, x)] == (sum(y2 for g2, x2, y2 in rows if g2 == g and x2 < x) or (None if x == min(x2 for g2, x2, _ in rows if g2 == g) else 0)) for g, x, _ in rows)


def test_packing_and_counts_of_links(spark):
    links = spark.createDataFrame([("a", "2"), ("a", "1"), ("a", "1"), ("b", None)] + [("c", str(i)) for i in range(3000)], "k string, v string")
    got = {r.k: r.vs for r in checks.packed(links, ["k"], "v", "vs").collect()}
    assert got == {"a": ["1", "2"], "c": sorted(str(i) for i in range(3000))}
    assert {r.k: r.n for r in checks.link_counts(links, ["k"], "v", "n").collect()} == {"a": 2, "c": 3000}


def test_coverage_of_a_crowded_puzzle(spark):
    artifacts = spark.createDataFrame([("p", f"a{i:04d}") for i in range(2000)] + [("q", "a")], "puzzle_id string, artifact_id string")
    seen = spark.createDataFrame([("p", f"s{i}", "artifact") for i in range(900)] + [("p", "m", "metadata")], "puzzle_id string, source_id string, source_role string")
    inventory = spark.createDataFrame([("p",), ("q",), ("r",)], "puzzle_id string")
    rows = {r.puzzle_id: r for r in coverage.puzzle_coverage(inventory, artifacts, seen).collect()}
    assert len(rows["p"].artifact_ids) == 2000 and len(rows["p"].exact_source_ids) == 900
    assert [(rows[k].artifact_covered, rows[k].verifier_ready) for k in "pqr"] == [(True, False), (True, True), (False, False)]


def test_coverage_policies(spark):
    inventory = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    puzzles = spark.createDataFrame([("a",), ("z",)], "k string")
    solutions = spark.createDataFrame([("a", True), ("a", True), ("b", None), ("z", True)], "k string, v boolean")
    by_key = coverage.coverage_by_key(inventory, solutions, "k", F.col("v"))
    assert {r.k: (r.candidate_solution_count, r.verified_solution_count, r.state) for r in by_key.collect()} == {
        "a": (2, 2, "multi_solution"), "b": (1, 0, "candidate_found"), "c": (0, 0, "uncovered")
    }
    codes = lambda p: Counter((r.code, r.row_key) for r in coverage.coverage_violations(inventory, puzzles, by_key, "k", p).collect())
    assert set(codes("subset")) == {("collection_coverage_mismatch", "z")}
    assert set(codes("complete")) == {("collection_coverage_mismatch", k) for k in "bcz"} | {("collection_verified_coverage_incomplete", k) for k in "bc"}
    totals = coverage.coverage_totals(puzzles, solutions, F.col("v")).first()
    assert tuple(totals) == (2, 4, 3, 1)
    frontier = spark.createDataFrame([("a", 1)], "k string, x int")
    assert {r.k: r.state for r in views.frontier_state(by_key, frontier, "k").collect()}["a"] == "frontier_populated"


def test_catalog_and_topology(spark):
    from provenlake.operators import reconcile, semantics

    puzzles = spark.createDataFrame([("P1", "K1", "One", "CHAPTER_2", "POLY"), ("P2", "K2", "Two", "JOURNAL_CVIII_IV", "X"), ("P3", "K3", "Three", "GONE", "X")], "game_puzzle_id string, leaderboard_key string, display_name string, group_key string, type_key string")
    groups = spark.createDataFrame([("CHAPTER_2", "CAMPAIGN"), ("JOURNAL_CVIII_IV", "JOURNAL_CVIII"), ("ODD", "NOWHERE")], "group_key string, collection_key string")
    kinds = spark.createDataFrame([("CAMPAIGN",), ("JOURNAL_CVIII",)], "collection_key string")
    types = spark.createDataFrame([("POLY", "polymer height"), ("X", "normal")], "type_key string, type_name string")
    bad = {(r.path, r.row_key) for r in reconcile.catalog_reference_violations(puzzles, groups, kinds, types).collect()}
    assert bad == {("groups", "ODD"), ("catalog", "K3")}
    view = reconcile.catalog_view(puzzles, groups, types)
    assert {(r.kind, r.group, r.puzzle_type) for r in view.collect()} == {("campaign", "chapter-2", "polymer_height"), ("journal", "journal-cviii-iv", "normal")}
    inventory = spark.createDataFrame([("om.1", "P1", "One", "chapter-2"), ("om.2", "P2", "Zwei", "chapter-1"), ("om.9", "P9", "Nine", "g")], "puzzle_id string, game_puzzle_id string, display_name string, group string")
    compared = reconcile.compare_with_catalog(inventory, view, "game_puzzle_id", {"display_name": "display_name", "group": "group"})
    assert {(r.game_puzzle_id, r.status, r.differing) for r in compared.collect()} == {("P1", "match", ""), ("P2", "mismatch", "display_name,group"), ("P9", "missing", None)}

    molecule = (([("SALT", 0, 0), ("Air", 1, 0)], [(1, 0, 0, 0, "Triplex { red: true, black: false, yellow: false }")]))
    uses = spark.createDataFrame(
        [("V1", molecule, 2, 0), ("V1", ([("GOLD", 0, 0)], []), 0, 1), ("V2", ([("GOLD", 0, 0)], []), 1, 0)],
        "variant string, molecule struct<atoms:array<struct<atom_type:string,q:int,r:int>>,bonds:array<struct<start_q:int,start_r:int,end_q:int,end_r:int,bond_type:string>>>, reagent_count bigint, product_count bigint",
    )
    catalog = spark.createDataFrame([("P1", "V1"), ("P2", "V2")], "game_puzzle_id string, variant string")
    status = semantics.topology_status(inventory, catalog, uses)
    assert {r.puzzle_id: r.status for r in status.collect()} == {"om.1": "ok", "om.2": "missing_products", "om.9": "missing_from_catalog"}
    receipts = spark.createDataFrame([("s", "r", p, "a" * 64, 1, "unknown") for p in ("m.rs", "p.rs")], "source_id string, revision string, upstream_path string, sha256 string, byte_length bigint, rights_status string")
    seen = semantics.topology_observations(status, receipts)
    assert sorted(r.source_path for r in seen.collect()) == ["m.rs", "p.rs"]
    claims = {r.field: r for r in semantics.topology_claims(status, uses, seen).collect()}
    one = '{"atoms":[{"atom_type":"air","q":1,"r":0},{"atom_type":"salt","q":0,"r":0}],"bonds":[{"a_q":0,"a_r":0,"b_q":1,"b_r":0,"bond_types":["triplex-red"]}]}'
    assert claims["reagents"].value_json == f"[{one},{one}]" and len(claims["reagents"].observation_ids) == 2
    assert claims["products"].value_json == '[{"atoms":[{"atom_type":"gold","q":0,"r":0}],"bonds":[]}]'


def test_null_groups_that_span_partitions(spark):
    points = [(None, (i * 7) % 53, (i * 11) % 47) for i in range(150)] + [("g", i % 5, i % 3) for i in range(20)]
    df = spark.createDataFrame(points, "g string, x int, y int").repartition(5)
    got = {(r.g, r.x, r.y) for r in views.pareto_pair(df, "g", "x", "y").collect()}
    assert got == {p for p in points if not any(q[0] == p[0] and q[1] <= p[1] and q[2] <= p[2] and q != p for q in points)}
    half = {r.g: r.value for r in views.metric_quantiles(df, "g", "y", [0.5]).collect()}
    for g in (None, "g"):
        own = sorted(y for h, _, y in points if h == g)
        assert half[g] == own[-(-len(own) // 2) - 1]
