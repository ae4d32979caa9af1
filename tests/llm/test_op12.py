import numpy as np
import pytest

from provenlake.llm import op12_one_bit_search as op


def brute(rows, queries, k=20):
    """{query: [(score, id)]}: the k best of all rows but the query's own."""
    ids = np.array([i for i, _ in rows])
    v = np.array([x for _, x in rows], np.float64)
    out = {}
    for i, q in queries:
        scores = (v * np.array(q, np.float64)).sum(1)
        at = np.flatnonzero(ids != i)
        at = at[np.lexsort((ids[at], -scores[at]))][:k]
        out[i] = [(int(ids[j]), float(scores[j])) for j in at]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, None if x is None else [None if y is None else float(y) for y in x], 1, 2.0) for i, x in rows], "vec_id long, embedding array<double>, cell int, score double")


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def shares(got, want):
    """Share of the true neighbours found."""
    n = sum(map(len, want.values()))
    return sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items()) / n


def clustered(n, dims, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims)) * 2
    v = centres[rng.integers(0, 12, n)] + 0.4 * rng.normal(size=(n, dims))
    # A third of all rows are one vector.
    v[: n // 3] = v[0]
    return [(int(i), x.tolist()) for i, x in zip(rng.permutation(n), v)]


@pytest.mark.parametrize("dims, cell_rows, rows, queries", [(24, 200, 64, 32), (24, 10_000, 4096, 4096), (3, 150, 50, 8), (1, 300, 100, 100)])
def test_clusters_by_brute_force(spark, monkeypatch, dims, cell_rows, rows, queries):
    for name, value in (("CELL_ROWS", cell_rows), ("ROWS", rows), ("QUERIES", queries)):
        monkeypatch.setattr(op, name, value)
    data = clustered(3000, dims)
    df = table(spark, data).repartition(3)
    got = found(op.nearest(df, op.every(df, 20)))
    want = brute(data, [(i, x) for i, x in data if i % 20 == 0])
    assert set(got) == set(want) and all(len(got[q]) == 20 for q in want)
    # In few dimensions the error bound always holds.
    assert shares(got, want) >= (0.99 if dims > 7 else 1.0)
    near = lambda a, b: all(x[0] == y[0] and abs(x[1] - y[1]) < 1e-9 for x, y in zip(a, b, strict=True))
    assert np.mean([near(got[q], want[q]) for q in want]) > (0.9 if dims > 7 else 0.999)


def test_recall_on_a_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = [(r.vec_id, r.embedding) for r in df.collect()]
    got = op.nearest(df, op.every(df, 20))
    want = brute(data, [(i, x) for i, x in data if i % 20 == 0])
    assert shares(found(got), want) >= 0.97
    truth = spark.createDataFrame([(q, i) for q, w in want.items() for i, _ in w], "query_id long, vec_id long")
    assert op.recall(got, truth) >= 0.97


def test_awkward_vectors(spark):
    rows = [
        (0, [1.0, 0.0]), (20, [0.5, 0.5]), (40, None), (60, []), (80, [0.0, 0.0]), (100, [float("nan"), 1.0]), (120, [1.0, None]), (140, [float("inf"), 0.0]),
        (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [2.0]), (4, [0.0, -1.0]), (None, [9.0, 9.0]), (5, [1.0, 1.0, 7.0]), (20, [0.5, 0.5]), (6, [1.0, 0.0]), (6, [1.0, 0.0]),
    ]
    df = table(spark, rows)
    got = found(op.nearest(df, op.every(df, 20)))
    first = [(1, 2.0), (2, 2.0), (3, 2.0), (5, 1.0), (6, 1.0), (6, 1.0), (20, 0.5), (20, 0.5), (4, 0.0)]
    second = [(1, 1.0), (2, 1.0), (3, 1.0), (5, 1.0), (0, 0.5), (6, 0.5), (6, 0.5), (4, -0.5)]
    assert got == {0: first, 20: second}
    assert op.nearest(df.limit(0), df.limit(0)).count() == 0
    assert op.nearest(df, df.where("vec_id = 40")).count() == 0
    assert found(op.nearest(df.where("vec_id = 0"), df.where("vec_id = 0"))) == {}


def test_error_bounds_hold():
    rng = np.random.default_rng(5)
    v, q = rng.normal(size=(4000, 48)), rng.normal(size=(60, 48))
    centre = v.mean(0)
    turn = op.rotation(48)
    assert np.allclose(turn @ turn.T, np.eye(48))
    estimate, error = op.bounds(q, centre, turn, *op.encode(v, centre, turn))
    wrong = np.abs(estimate - q @ v.T) > error
    assert wrong.mean() < 0.02 and abs((estimate - q @ v.T).mean()) < 0.05
