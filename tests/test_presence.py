"""References settled in one shuffle, against sets of keys."""

import random

from pyspark.sql import functions as F

from provenlake.operators import checks, release
from provenlake.operators.presence import parent, presence_violations, reference, references


def tables(spark, rng, n=60):
    ids = lambda p: f"{p}{rng.randrange(n // 3)}"
    some = lambda p: None if rng.random() < 0.1 else ids(p)
    puzzles = [(f"p{i}", [ids("a") for _ in range(rng.randrange(4))]) for i in range(n // 4)]
    solutions = [(f"s{i % (n // 2)}", some("p"), some("a")) for i in range(n)]
    normalized = [(f"n{i}", some("s"), some("p")) for i in range(n)]
    observations = [(f"o{i}", rng.choice(["metadata", "artifact", None]), rng.choice(["puzzle", "solution", "x", None]), rng.choice([None, ids("a"), ids("s")])) for i in range(n)]
    made = {
        "puzzles": (puzzles, "puzzle_id string, puzzle_artifact_ids array<string>"), "solutions": (solutions, "solution_id string, puzzle_id string, puzzle_artifact_id string"),
        "normalized": (normalized, "normalized_solution_id string, solution_id string, puzzle_id string"),
        "observations": (observations, "observation_id string, source_role string, artifact_kind string, artifact_id string"),
    }
    return {k: v[0] for k, v in made.items()}, {k: spark.createDataFrame(*v).repartition(3) for k, v in made.items()}


def brute(t):
    puzzles = {p for p, _ in t["puzzles"]}
    owners = {}
    for p, artifacts in t["puzzles"]:
        for a in artifacts:
            owners.setdefault(a, set()).add(p)
    solutions = {s for s, *_ in t["solutions"]}
    out = []
    for s, p, a in t["solutions"]:
        if p not in puzzles:
            out.append(("referential_integrity", "solutions", s, f"puzzle {p}"))
        if a not in owners:
            out.append(("referential_integrity", "solutions", s, f"puzzle artifact {a}"))
        elif p not in owners[a]:
            out.append(("puzzle_artifact_other_puzzle", "solutions", s, ""))
    for n, s, p in t["normalized"]:
        out += [("referential_integrity", "normalized", n, f"solution {s}")] if s not in solutions else []
        out += [("referential_integrity", "normalized", n, f"puzzle {p}")] if p not in puzzles else []
    for o, role, kind, a in t["observations"]:
        if role == "metadata" and a is None:
            continue
        out += [("referential_integrity", "observations", o, f"solution {a}")] if kind == "solution" and a not in solutions else []
        out += [("referential_integrity", "observations", o, f"puzzle artifact {a}")] if kind == "puzzle" and a not in owners else []
    return sorted(out)


def test_six_rules_equal_sets_of_keys(spark):
    codes = set()
    for seed in range(4):
        raw, dfs = tables(spark, random.Random(seed))
        found = [(r.code, r.path, r.row_key, r.detail.removeprefix("references unknown ") if r.code == "referential_integrity" else "") for r in release.integrity_violations(dfs).collect()]
        assert sorted(found) == brute(raw)
        codes |= {c for c, *_ in found}
    assert codes == {"referential_integrity", "puzzle_artifact_other_puzzle"}


def test_rows_are_shuffled_once(spark):
    _, dfs = tables(spark, random.Random(9))
    plan = release.integrity_violations(dfs)._jdf.queryExecution().executedPlan().toString()
    # After the one shuffle of facts, rows meet the written suspects by broadcast; only rows with a doubtful scope are joined again.
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert plan.count("BroadcastHashJoin") >= 3 and all("asked" in line or "own" in line for line in joins) and len(joins) <= 4


def test_scopes(spark):
    parents = spark.createDataFrame([("x", "p"), ("x", "q"), ("y", None), ("z", "p")], "id string, scope string")
    rows = [("1", "x", "p"), ("2", "x", "q"), ("3", "x", "r"), ("4", "x", None), ("5", "y", None), ("6", "y", "p"), ("7", "w", "p"), ("8", None, "p"), ("9", "z", "p")]
    children = spark.createDataFrame(rows, "k string, id string, scope string")
    made = references(children, "t", "k", [reference("s", "id", ("missing", F.col("id")), "scope", ("other", F.col("scope")))])
    got = sorted((r.row_key, r.code) for r in presence_violations([parent(parents, "s", "id", "scope")], [made]).collect())
    assert got == [("3", "other"), ("4", "other"), ("6", "other"), ("7", "missing"), ("8", "missing")]
    each = references(children, "t", "k", [reference("s", "id", ("missing", F.col("id")), "scope", ("other", F.col("scope")), every=True)])
    got = sorted((r.row_key, r.code) for r in presence_violations([parent(parents, "s", "id", "scope")], [each]).collect())
    assert got == sorted([("1", "other"), ("2", "other"), *[("3", "other")] * 2, *[("4", "other")] * 2, ("6", "other"), ("7", "missing"), ("8", "missing")])


def test_dependencies_are_settled_without_sorting(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(40)]), rng.randrange(3), None if k % 9 == 0 else "x", rng.choice(["a", "a", "b", None]) if k % 4 == 0 else "a") for k in range(600)]
    df = spark.createDataFrame(rows, "k int, j int, x string, y string").repartition(4)
    by_key = {}
    for k, j, x, y in rows:
        by_key.setdefault((k, j), []).append((x, y))
    want = {key: len(ts) for key, ts in by_key.items() if len(set(ts)) > 1}
    found = checks.dependency_conflicts(df, ["k", "j"], ["x", "y"])
    got = found.collect()
    assert {(r.k, r.j): r.n for r in got} == want and 0 < len(want) < len(by_key)
    order = lambda t: tuple((v is not None, v or "") for v in t)
    for r in got:
        ts = sorted(by_key[r.k, r.j], key=order)
        assert (tuple(r.lowest), tuple(r.highest)) == (ts[0], ts[-1])
    # Rows of keys that agree are not shuffled again: the written keys are broadcast.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    swapped = spark.createDataFrame([(1, None, "a"), (1, "a", None)], "k int, x string, y string")
    assert checks.dependency_conflicts(swapped, ["k"], ["x", "y"]).count() == 1
