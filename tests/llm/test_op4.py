import numpy as np
import pytest

from provenlake.llm import op4_hnsw_links as op
from provenlake.llm.hnsw import Graph


def brute(ids, vectors):
    """(links, component) per row over all pairs, in double precision."""
    v = np.array(vectors, np.float64)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    label = np.array(ids)
    while True:
        new = np.array([min([label[i], *label[near[i]]]) for i in range(len(ids))])
        if (new == label).all():
            return {int(i): (int(n), int(c)) for i, n, c in zip(ids, near.sum(1), label)}
        label = new


def clusters(sizes, noise, seed=2, dims=24):
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.normal(size=(1, dims)) + noise * rng.normal(size=(n, dims)) for n in sizes]).astype(np.float32)


def run(spark, ids, vectors):
    df = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)], "vec_id long, embedding array<float>")
    rows = op.near_vectors(df.repartition(3)).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return {r.vec_id: (r.n_links, r.component_id) for r in rows}


@pytest.mark.parametrize("widest", [192, 8])
def test_dense_and_sparse_clusters(spark, monkeypatch, widest):
    monkeypatch.setattr(op, "WIDEST", widest)
    monkeypatch.setattr(op, "BEAM", min(op.BEAM, widest))
    vectors = np.concatenate([clusters([300, 40, 12, 5], 0.22), clusters([1] * 400, 0.0, 9), clusters([60], 0.3, 4)])
    ids = np.arange(len(vectors)) * 3 + 1
    got, want = run(spark, ids, vectors), brute(ids, vectors)
    assert set(got) == set(want)
    # Found links are true; nearly all are found.
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in got.values()) >= 0.98 * sum(n for n, _ in want.values())
    assert np.mean([got[i][1] == want[i][1] for i in want]) > 0.98


def test_recall_on_a_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    want = brute([r.vec_id for r in rows], [r.embedding for r in rows])
    got = {r.vec_id: (r.n_links, r.component_id) for r in op.near_vectors(df).collect()}
    assert sum(n for n, _ in got.values()) >= 0.97 * sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)


def test_awkward_vectors(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0]), (4, [0.0, 0.0]), (5, None), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]),
        (8, [1.0, None]), (9, []), (10, [0.9, float(np.sqrt(1 - 0.81))]), (11, [-1.0, 0.0]), (None, [1.0, 0.0]), (12, [1.0, 0.0, 0.0]), (13, [1e300, 1e299]), (14, [-0.0, 1.0]), (15, [0.0, 1.0]), (3, [2.0, 0.0]),
    ]
    df = spark.createDataFrame([(a, b, 1, 2.0) for a, b in rows], "vec_id long, embedding array<double>, rep int, copies double")
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in op.near_vectors(df).collect()))
    by_id = {r[0]: r[1:] for r in got}
    assert len(got) == len(rows)
    assert by_id[0] == (0, None, True)
    for i in (4, 5, 6, 7, 8, 9, 11, 12):
        assert by_id[i] == (0, i, True)
    assert by_id[1][0] == by_id[2][0] == by_id[3][0] and by_id[1][1] == by_id[3][1] == 1 and by_id[13][1] == 1
    assert by_id[14] == (1, 14, True) and by_id[15] == (1, 14, False)
    assert op.near_vectors(df.limit(0)).count() == 0


def test_graph_finds_the_nearest():
    v = clusters([3] * 500, 0.5)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    scores, ids = Graph(v).search(v, 24)
    true = np.sort(v @ v.T, axis=1)[:, ::-1][:, :5]
    assert (np.abs(scores[:, :5] - true) < 1e-4).mean() > 0.97 and (ids[:, 0] >= 0).all()


class Leaky(Graph):
    """Loses the links of every fifth vector, and no hit of a vector on itself."""

    def search(self, queries, beam, block=256):
        scores, ids = super().search(queries, beam, block)
        lost = (ids % 5 == 0) & (scores < 0.9999)
        return np.where(lost, -2, scores).astype(np.float32), np.where(lost, -1, ids)


def shard_of_pairs():
    """500 vectors in pairs and their neighbours in other shards."""
    raw = clusters([3] * 250, 0.15, 7).astype(np.float64).reshape(250, 3, -1)
    own, other = raw[:, :2].reshape(500, -1), raw[:, 2]
    unit = (other / np.linalg.norm(other, axis=1, keepdims=True)).astype(np.float32)
    return np.arange(500), np.ones(500, np.int64), own, np.arange(500, 750), unit


def test_audit_sees_lost_links_past_the_hits_on_oneself(monkeypatch):
    assert op.build(*shard_of_pairs())[1] == op.BEAM
    monkeypatch.setattr(op, "Graph", Leaky)
    assert op.build(*shard_of_pairs())[1] == op.EXACT
    # The widest beam is audited too.
    monkeypatch.setattr(op, "WIDEST", op.BEAM)
    assert op.build(*shard_of_pairs())[1] == op.EXACT


def test_audit_measures_a_shard_without_links(monkeypatch):
    v = clusters([1] * 300, 0.0, 3).astype(np.float64)
    monkeypatch.setattr(op, "Graph", Leaky)
    assert op.build(np.arange(300), np.ones(300, np.int64), v, np.zeros(0, np.int64), np.zeros((0, 24), np.float32))[1] == op.EXACT


def test_a_failed_shard_is_compared_exactly(monkeypatch):
    monkeypatch.setattr(op, "Graph", Leaky)
    monkeypatch.setattr(op, "COMPARED", 64)
    rep, copies, raw, *others = shard_of_pairs()
    raw[:40] = raw[0] + 1e-3 * np.arange(40)[:, None]
    payload, beam = op.build(rep, copies, raw, *others)
    kind, a, b, *_ = op._search(op._opened(payload, beam), rep, copies, raw)
    unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    dense = near.sum(1) > op.BEAM
    np.fill_diagonal(near, False)
    assert beam == op.EXACT and 40 <= dense.sum() < 60
    assert set(a[kind == op._DENSE].tolist()) == set(np.flatnonzero(dense).tolist())
    assert {(x, y) for k, x, y in zip(kind, a, b) if k == op._PAIR} == {(x, y) for x, y in zip(*np.nonzero(near)) if not dense[x]}


def test_recall_of_vectors_with_few_links(spark):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(700, 1, 32))
    v = np.concatenate([(centres + 0.28 * rng.normal(size=(700, 3, 32))).reshape(-1, 32), rng.normal(size=(2500, 32))]).astype(np.float32)
    order = rng.permutation(len(v))
    ids, v = np.arange(len(v)), v[order]
    unit = v.astype(np.float64) / np.linalg.norm(v.astype(np.float64), axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.9).sum(1) - 1
    got = run(spark, ids, v)
    few = [got[i][0] / n for i, n in enumerate(want.tolist()) if 0 < n < op.BEAM]
    assert len(few) > 500 and np.mean(few) >= 0.98
