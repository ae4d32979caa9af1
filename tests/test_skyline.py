"""Frontiers of several metrics against all pairs."""

import numpy as np
import pyarrow as pa
import pytest

from provenlake.operators import skyline
from provenlake.operators.views import pareto_frontier


def brute(rows):
    """{(group, tuple): rows}: tuples that no other tuple of the group dominates."""
    counts = {}
    for g, *t in rows:
        if None not in t:
            counts[g, tuple(t)] = counts.get((g, tuple(t)), 0) + 1
    groups = {}
    for g, t in counts:
        groups.setdefault(g, []).append(t)
    out = {}
    for g, ts in groups.items():
        v = np.array(ts)
        for t in ts:
            below = (v <= np.array(t)).all(1) & (v < np.array(t)).any(1)
            if not below.any():
                out[g, t] = counts[g, t]
    return out


def anticorrelated(n, k, seed=1, top=1_000):
    rng = np.random.default_rng(seed)
    v = rng.dirichlet(np.ones(k), n) * top + rng.integers(0, top // 8, (n, k))
    return v.astype(int).tolist()


@pytest.mark.parametrize("k", [1, 2, 3, 4, 5])
@pytest.mark.parametrize("crowded", [10_000, 40])
def test_frontier_equals_all_pairs(spark, k, crowded):
    rows = [("big", *t) for t in anticorrelated(1500, k)] + [(None, *t) for t in anticorrelated(300, k, 2, 40)]
    rows += [("one", *[5] * k)] * 3 + [("gap", *[None] * k), ("gap", *[1] * k), (None, *[None] * k)]
    df = spark.createDataFrame(rows, "g string, " + ", ".join(f"m{i} long" for i in range(k))).repartition(5)
    names = [f"m{i}" for i in range(k)]
    got = {(r.g, tuple(r[m] for m in names)): r["rows"] for r in pareto_frontier(df, "g", names, crowded).collect()}
    assert got == brute(rows) and got["one", (5,) * k] == 3


def test_crowded_group_of_equal_values(spark):
    rows = [("g", i % 3, i % 7, 1) for i in range(2_000)] + [("g", 5, 0, 0)]
    df = spark.createDataFrame(rows, "g string, a long, b long, c long")
    got = {(r.a, r.b, r.c): r["rows"] for r in pareto_frontier(df, "g", ["a", "b", "c"], 1).collect()}
    assert got == {t: n for (_, t), n in brute(rows).items()}


def test_other_kinds_of_numbers(spark):
    rows = [("g", 0.5, "2020-01-02"), ("g", 0.25, "2020-01-03"), ("g", 0.5, "2020-01-03"), ("g", float("inf"), "2020-01-01")]
    df = spark.createDataFrame(rows, "g string, x double, s string").selectExpr("g", "x", "CAST(s AS date) AS d", "CAST(x * 4 AS decimal(20, 2)) AS unused", "s")
    got = {(r.x, str(r.d)) for r in pareto_frontier(df, "g", ["x", "d"]).collect()}
    assert got == {(0.5, "2020-01-02"), (0.25, "2020-01-03"), (float("inf"), "2020-01-01")}
    assert {(r.x, str(r.d)) for r in pareto_frontier(df, "g", ["x", "d"], 1).collect()} == got
    assert pareto_frontier(df.limit(0), "g", ["x", "d"]).count() == 0


def test_runs_over_batches_stay_whole():
    batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.int64())], ["k"]) for x in ([1, 1], [1], [], [1, 2], [2, 2], [3], [4, 4])]
    runs = [t.column("k").to_pylist() for t in skyline._runs(batches, ["k"])]
    assert sum(runs, []) == [1, 1, 1, 1, 2, 2, 2, 3, 4, 4]
    assert all(not set(a) & set(b) for i, a in enumerate(runs) for b in runs[i + 1 :])
