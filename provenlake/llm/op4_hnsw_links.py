"""Embedding near duplicates by navigable small-world graphs, one per shard.

Equal vectors are one class with a count.  Classes are dealt to shards by hash; a
task builds each shard's graph and audits it: samples of its vectors, of those of all
shards and of made vectors that have a link are compared with brute force (hits on
oneself left out), and the search beam is widened until the audited recall of links
reaches ``AUDIT_RECALL``.  A shard that fails at the widest beam too is compared exactly
with all queries.  Graphs are written to the shared folder.  Every class then
queries every shard, in blocks; hits are confirmed by cosine in double precision, and
links are united to components.

A beam holds only so many hits.  A query whose beam is full of links is
dense: all dense queries are compared exactly, in blocks, with every shard, which
counts their links and gives back a spanning forest among dense ones instead of all
their pairs.  So nothing is capped, and pairs are emitted only for queries with fewer
links than a beam holds.

Bounds: a shard has about ``SHARD_ROWS`` classes (its graph is one task's memory);
links of ordinary queries number below classes x shards x beam.  Shards that fail the
audit cost queries x classes.

Defined cases: vectors that are null, zero, or hold a null or non-finite component link
with nothing and are their own component.  Vectors of different lengths link
with nothing of another length.  Rows with equal ids each have the links and component
of their own vector.  An empty table gives no row.  Other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .hnsw import Graph
from .staging import small_batches, staged

COSINE = 0.9
#: Classes per shard, and shards below that size as long as each has ``LEAST_ROWS``.
SHARD_ROWS, SHARDS, LEAST_ROWS = 200_000, 6, 256
#: Beams: at first, and what a badly audited one is widened to at most; the mark of a shard that no beam serves.
BEAM, WIDEST, EXACT = 24, 192, 0
#: Audit queries of each kind and how many are compared at once, and the mean recall of a query's links that passes.
AUDIT_QUERIES, AUDIT_BLOCK, AUDIT_RECALL = 512, 128, 0.98
#: Queries in one block, and blocks that one task compares with one shard.
BLOCK_ROWS, BLOCKS = 512, 256
#: Members of a shard without a beam that a block is compared with at once.
COMPARED = 16_384
#: Float scores this close below the threshold are confirmed in double precision too.
SLACK = 1e-4

_PAIR, _DENSE, _COUNT, _TIE = range(4)
_HITS = "kind int, a long, b long, n_a long, n_b long"


def _pack(*arrays) -> bytes:
    return pickle.dumps(arrays, protocol=5)


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rep, copies, raw vectors) of a batch whose vectors have one length."""
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return batch.column("rep").to_numpy(), batch.column("copies").to_numpy(), flat.reshape(batch.num_rows, -1).astype(np.float64)


def _unit(raw: np.ndarray) -> np.ndarray:
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision.  Scaled first, so that squares neither overflow nor vanish."""
    a, b = a / np.abs(a).max(1, keepdims=True), b / np.abs(b).max(1, keepdims=True)
    return np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def _scaled(raw: np.ndarray) -> np.ndarray:
    return raw / np.abs(raw).max(1, keepdims=True)


def classes_of(vectors: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, DataFrame]:
    """(rows with the digest of their vector, classes of equal usable vectors)."""
    v = F.col("_v")
    usable = v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    ) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_column).cast("long").alias("_id"), F.col(vector_column).cast("array<double>").alias("_v")).select(
        "_id", F.when(usable, F.transform(v, lambda x: x + 0.0)).alias("_v")
    ).select("_id", "_v", F.when(F.col("_v").isNotNull(), F.xxhash64("_v")).alias("h1"),
             F.when(F.col("_v").isNotNull(), F.xxhash64(F.lit(1), "_v")).alias("h2"))
    same = rows.where("h1 IS NOT NULL AND _id IS NOT NULL").groupBy("h1", "h2").agg(
        F.min("_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.any_value("_v").alias("vector")
    )
    return rows.drop("_v"), same


def audit_set(rep: np.ndarray, unit: np.ndarray, other_rep: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(queries, the member that each is, or -1): members, vectors of any shard, and made ones that have a link here.

    Made queries lie within the threshold of a random member, so a shard is
    measured on links even where a sample of real vectors has none.
    """
    rng = np.random.default_rng(3)
    own = rng.permutation(len(unit))[:AUDIT_QUERIES]
    foreign = other[~np.isin(other_rep, rep)]
    near = unit[rng.permutation(len(unit))[:AUDIT_QUERIES]].astype(np.float64)
    away = rng.normal(size=near.shape)
    away -= (away * near).sum(1, keepdims=True) * near
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-30)
    c = rng.uniform(COSINE, 1, (len(near), 1))
    made = _unit(c * near + np.sqrt(1 - c * c) * away).astype(np.float32)
    return np.concatenate([unit[own], foreign, made]), np.concatenate([own, np.full(len(foreign) + len(made), -1)])


def recalls(graph: Graph, queries: np.ndarray, member: np.ndarray, beam: int) -> np.ndarray:
    """Recall of links by query, itself left out; nan for queries without links and for those whose beam is full of them."""
    out = np.full(len(queries), np.nan)
    for i in range(0, len(queries), AUDIT_BLOCK):
        q, self_ = queries[i : i + AUDIT_BLOCK], member[i : i + AUDIT_BLOCK, None]
        true = q @ graph.v.T >= COSINE
        rows = np.flatnonzero(self_[:, 0] >= 0)
        true[rows, self_[rows, 0]] = False
        scores, ids = graph.search(q, beam)
        hits = (scores >= COSINE) & (ids >= 0)
        wanted, full = true.sum(1), hits[:, -1] & (beam < len(graph.v))
        got = (hits & (ids != self_)).sum(1)
        judged = (wanted > 0) & ~full
        out[i : i + AUDIT_BLOCK][judged] = np.minimum(got[judged] / wanted[judged], 1)
    return out


def passing_beam(graph: Graph, queries: np.ndarray, member: np.ndarray, n_made: int) -> int:
    """The smallest beam whose recall of links reaches ``AUDIT_RECALL`` on real and on made queries; ``EXACT`` when none does."""
    beam = BEAM
    while True:
        found = recalls(graph, queries, member, beam)
        if all(not len(x) or x.mean() >= AUDIT_RECALL for x in (part[~np.isnan(part)] for part in np.split(found, [len(found) - n_made]))):
            return beam
        if beam >= WIDEST:
            return EXACT
        beam = min(2 * beam, WIDEST)


def build(rep: np.ndarray, copies: np.ndarray, raw: np.ndarray, other_rep: np.ndarray, other: np.ndarray) -> tuple[bytes, int]:
    """A shard's graph with its vectors, and the beam that passed the audit (``EXACT``: none did)."""
    unit = _unit(_scaled(raw)).astype(np.float32)
    graph = Graph(unit)
    queries, member = audit_set(rep, unit, other_rep, other)
    beam = passing_beam(graph, queries, member, min(AUDIT_QUERIES, len(unit)))
    return _pack(rep, copies, raw, graph.state() if beam != EXACT else None), beam


def _sharded(rows: DataFrame, n_shards: int) -> DataFrame:
    return rows.withColumn("shard", F.pmod(F.xxhash64("rep"), F.lit(n_shards)).cast("int"))


def _held(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, list[pa.RecordBatch]]]:
    """Batches cut at changes of (shard, length), gathered per group."""
    last, held = None, []
    for batch in batches:
        keys = list(zip(batch.column("shard").to_pylist(), batch.column("length").to_pylist(), strict=True))
        start = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[start]:
                if held and keys[start] != last:
                    yield last, held
                    held = []
                last = keys[start]
                held.append(batch.slice(start, i - start))
                start = i
    if held:
        yield last, held


def graphs(classes: DataFrame, n_shards: int) -> DataFrame:
    """(shard, length, beam, payload): one graph per shard and vector length."""
    dealt = _sharded(classes, n_shards).repartition(n_shards, "shard").sortWithinPartitions("shard", "length", "rep")

    sample = classes.orderBy(F.xxhash64(F.lit(7), "rep"), "rep").limit(AUDIT_QUERIES).select("length", "rep", "vector").collect()
    shared = classes.sparkSession.sparkContext.broadcast([(r.length, r.rep, r.vector) for r in sample])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (shard, length), held in _held(batches):
            rep, copies, raw = (np.concatenate(x) for x in zip(*[_matrix(b) for b in held], strict=True))
            others = [(r, v) for n, r, v in shared.value if n == length]
            other = np.array([v for _, v in others], np.float64).reshape(-1, length)
            payload, beam = build(rep, copies, raw, np.array([r for r, _ in others], np.int64), _unit(_scaled(other)).astype(np.float32))
            yield pa.RecordBatch.from_pylist([{"shard": shard, "length": length, "beam": beam, "payload": payload}], schema=schema)

    schema = pa.schema([("shard", pa.int32()), ("length", pa.int32()), ("beam", pa.int32()), ("payload", pa.binary())])
    return dealt.select("shard", "length", "rep", "copies", "vector").mapInArrow(run, "shard int, length int, beam int, payload binary")


def blocks(classes: DataFrame) -> DataFrame:
    """(block, length, payload): queries packed ``BLOCK_ROWS`` at a time, by length."""
    schema = pa.schema([("block", pa.int64()), ("length", pa.int32()), ("payload", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            for length in np.unique(lengths).tolist():
                part = batch.take(pa.array(np.flatnonzero(lengths == length)))
                for i in range(0, part.num_rows, BLOCK_ROWS):
                    rep, copies, raw = _matrix(part.slice(i, BLOCK_ROWS))
                    yield pa.RecordBatch.from_pylist([{"block": int(rep[0]), "length": length, "payload": _pack(rep, copies, raw)}], schema=schema)

    return classes.select("length", "rep", "copies", "vector").mapInArrow(run, "block long, length int, payload binary")


def _paired(
    data: DataFrame, queries: DataFrame, n_shards: int, n_blocks: int, open_data: Callable, compare: Callable
) -> DataFrame:
    """Every query block with every shard of its length: the blocks of a range stream past the shard in one task.

    ``data`` has (shard, length, beam, payload).  A shard is sent once per range of
    ``BLOCKS`` blocks, so no task holds or reads more than its share.
    """
    ranges = max(1, -(-n_blocks // BLOCKS))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = data.select("shard", "length", every(ranges).alias("range"), F.lit(0).alias("side"), "beam", "payload")
    right = queries.select(
        every(n_shards).alias("shard"), "length", F.pmod(F.xxhash64("block"), F.lit(ranges)).cast("int").alias("range"),
        F.lit(1).alias("side"), F.lit(0).alias("beam"), "payload",
    ).select(left.columns)
    placed = left.unionByName(right).repartition(n_shards * ranges, "shard", "range").sortWithinPartitions("shard", "range", "length", "side")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, opened = None, []
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["shard"], row["range"], row["length"])
                if key != at:
                    at, opened = key, []
                if row["side"] == 0:
                    opened.append(open_data(row["payload"], row["beam"]))
                else:
                    for shard in opened:
                        columns = compare(shard, *pickle.loads(row["payload"]))
                        if len(columns[0]):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), *[pa.int64()] * 4), strict=True)], ["kind", "a", "b", "n_a", "n_b"]
                            )

    return placed.mapInArrow(run, _HITS)


def _rows(kind: int, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple:
    return np.full(len(a), kind), a, b, n_a, n_b


def _opened(payload: bytes, beam: int) -> tuple:
    rep, copies, raw, state = pickle.loads(payload)
    return (rep, copies, raw, Graph.restored(state) if beam != EXACT else _unit(_scaled(raw)).astype(np.float32)), beam


def _compared(unit: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(dense queries, query and member of each hit of the others) of a shard without a beam: all members are compared."""
    q, x = [], []
    for i in range(0, len(members), COMPARED):
        near_q, near_x = np.nonzero(unit @ members[i : i + COMPARED].T >= COSINE - SLACK)
        q.append(near_q)
        x.append(near_x + i)
    q, x = np.concatenate(q), np.concatenate(x)
    dense = np.bincount(q, minlength=len(unit)) > BEAM
    return np.flatnonzero(dense), q[~dense[q]], x[~dense[q]]


def _search(shard: tuple, q_rep: np.ndarray, q_copies: np.ndarray, q_raw: np.ndarray) -> tuple:
    """Hits of a block in one shard: confirmed pairs, or a mark for each query whose beam is full of links."""
    (rep, copies, raw, graph), beam = shard
    unit = _unit(_scaled(q_raw)).astype(np.float32)
    if beam == EXACT:
        dense, q, x = _compared(unit, graph)
    else:
        scores, ids = graph.search(unit, beam)
        dense = np.flatnonzero((scores[:, -1] >= COSINE - SLACK) & (beam < len(rep)))
        near = (scores >= COSINE - SLACK) & (ids >= 0)
        near[dense] = False
        q, c = np.nonzero(near)
        x = ids[q, c]
    zero = np.zeros(len(dense), np.int64)
    good = rep[x] != q_rep[q]
    q, x = q[good], x[good]
    good = _cosines(q_raw[q], raw[x]) >= COSINE
    q, x = q[good], x[good]
    marks, pairs = _rows(_DENSE, q_rep[dense], zero, q_copies[dense], zero), _rows(_PAIR, q_rep[q], rep[x], q_copies[q], copies[x])
    return tuple(np.concatenate(c) for c in zip(marks, pairs, strict=True))


def _exact(shard: tuple, q_rep: np.ndarray, q_copies: np.ndarray, q_raw: np.ndarray) -> tuple:
    """Dense queries against one shard, in double precision: counts, pairs with ordinary vectors, a forest among dense ones."""
    (rep, copies, raw, is_dense), _ = shard
    a, b = _scaled(q_raw), _scaled(raw)
    linked = (a @ b.T) / np.outer(np.sqrt((a * a).sum(1)), np.sqrt((b * b).sum(1)))
    # A matrix product may differ from the row-wise sum in the last bits; what is near the threshold is decided row by row.
    close_q, close_x = np.nonzero(np.abs(linked - COSINE) < 1e-9)
    linked = linked >= COSINE
    if len(close_q):
        linked[close_q, close_x] = _cosines(q_raw[close_q], raw[close_x]) >= COSINE
    linked &= q_rep[:, None] != rep
    q, x = np.nonzero(linked & ~is_dense)
    out = [_rows(_PAIR, q_rep[q], rep[x], q_copies[q], copies[x])]
    total = linked @ copies
    out.append(_rows(_COUNT, q_rep, np.zeros(len(q_rep), np.int64), total, total))
    tree = np.arange(len(rep))
    ties = []
    for i in range(len(q_rep)):
        mine = np.flatnonzero(linked[i] & is_dense)
        if len(mine):
            roots, first = np.unique(tree[mine], return_index=True)
            ties += [(int(q_rep[i]), int(rep[mine[k]])) for k in first]
            if len(roots) > 1:
                tree[np.isin(tree, roots)] = roots[0]
    if ties:
        t = np.array(ties)
        zero = np.zeros(len(t), np.int64)
        out.append(_rows(_TIE, t[:, 0], t[:, 1], zero, zero))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _dense_links(classes: DataFrame, dense: DataFrame, n_shards: int, n_dense: int) -> DataFrame:
    flagged = _sharded(classes.join(dense.withColumn("dense", F.lit(True)), "rep", "left"), n_shards)
    dealt = flagged.repartition(n_shards, "shard").sortWithinPartitions("shard", "length", "rep")
    schema = pa.schema([("shard", pa.int32()), ("length", pa.int32()), ("beam", pa.int32()), ("payload", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (shard, length), held in _held(batches):
            for batch in held:
                flags = np.array([bool(x) for x in batch.column("dense").to_pylist()])
                yield pa.RecordBatch.from_pylist(
                    [{"shard": shard, "length": length, "beam": 0, "payload": _pack(*_matrix(batch), flags)}], schema=schema
                )

    data = dealt.select("shard", "length", "rep", "copies", "vector", "dense").mapInArrow(run, "shard int, length int, beam int, payload binary")
    queries = blocks(classes.join(dense, "rep", "left_semi").repartition("rep"))
    n_blocks = -(-n_dense // BLOCK_ROWS)
    return _paired(data, queries, n_shards, n_blocks, lambda payload, beam: (pickle.loads(payload), beam), _exact)


def near_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) of every vector."""
    small_batches(vectors.sparkSession)
    rows, same = classes_of(vectors, id_column, vector_column)
    classes = staged(same.withColumn("length", F.size("vector")), "vectors")
    n = classes.count()
    n_shards = max(1, -(-n // SHARD_ROWS), min(SHARDS, n // LEAST_ROWS))
    shards = staged(graphs(classes, n_shards), "graphs")
    # Blocks come from the classes' files, so their number is about that of full ones plus one per file.
    hits = staged(_paired(shards, blocks(classes), n_shards, -(-n // BLOCK_ROWS), _opened, _search), "hits")
    dense = staged(hits.where(F.col("kind") == _DENSE).select(F.col("a").alias("rep")).distinct(), "dense")
    pairs = hits.where(F.col("kind") == _PAIR).join(dense, F.col("a") == F.col("rep"), "left_anti")
    n_dense = dense.count()
    more = staged(_dense_links(classes, dense, n_shards, n_dense), "dense-links") if n_dense else hits.limit(0)
    met = more.where(F.col("kind") == _PAIR)
    ways = (
        pairs.select(F.col("a").alias("rep"), F.col("b").alias("other"), F.col("n_b").alias("n"))
        .unionByName(pairs.select(F.col("b").alias("rep"), F.col("a").alias("other"), F.col("n_a").alias("n")))
        .unionByName(met.select(F.col("b").alias("rep"), F.col("a").alias("other"), F.col("n_a").alias("n")))
    )
    counts = (
        ways.join(dense, "rep", "left_anti").groupBy("rep", "other").agg(F.min("n").alias("n"))
        .groupBy("rep").agg(F.sum("n").alias("n"))
        .unionByName(more.where(F.col("kind") == _COUNT).groupBy(F.col("a").alias("rep")).agg(F.sum("n_a").alias("n")))
    )
    labels = components(pairs.unionByName(more.where(F.col("kind").isin(_PAIR, _TIE))).select("a", "b"))
    of_class = (
        classes.select("h1", "h2", "rep", "copies").join(counts, "rep", "left").join(labels, F.col("vertex") == F.col("rep"), "left")
        .select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    joined = rows.join(of_class, ["h1", "h2"], "left")
    known = F.col("_id").isNotNull()
    component = F.when(known, F.coalesce("component_id", "_id"))
    return joined.select(
        F.col("_id").cast(vectors.schema[id_column].dataType).alias(id_column),
        F.when(known, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), component.eqNullSafe(F.col("_id")).alias("kept"),
    )
