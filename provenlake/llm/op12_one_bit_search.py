"""Nearest vectors by inner product from randomly rotated one-bit codes.

Index.  Vectors are dealt to cells (nearest of at most ``MAX_CELLS`` centres, which are
fitted on a bounded sample; every row is indexed).  The residual r of a vector to its
centre is turned by a random rotation; the signs of its coordinates are the code, packed
into bits.  Two scalars correct it: |r| and x, the cosine of the residual with its code.

Estimate.  <o, q> = <c, q> + <r, c> + |r| * <r/|r|, q - c>, and the last factor is
estimated by the product of the code with the rotated q - c, divided by x.  The error is
at most |q - c| * sqrt(1 - x^2) / x * min(1, EPSILON / sqrt(D - 1)): in few dimensions
always, in many with a probability that ``EPSILON`` sets.

Search.  A query first asks the ``PROBES`` cells with the largest <c, q>: in every block
of vectors the best estimates are reranked by the original vectors, and then all
vectors whose upper bound reaches the k-th best score.  In a second round it asks every
other cell whose bound <c, q> + |q| * (largest |r|) reaches its k-th best score of the
first: cells are left out only by a bound that always holds.  So what can be lost is a
vector beyond the error bound; ``recall`` measures it against brute force.

Work is dealt in blocks of ``ROWS`` vectors by ``QUERIES`` queries inside a cell: a
crowded cell is many blocks, each row of it in one block per group of queries, each query
in every block of its cells.  A block gives back at most k rows a query.  The cost grows
with (queries x vectors of the cells asked); for vectors without clusters the bounds
cannot leave cells out, and that is all vectors.

Defined cases: a vector that is null, empty, all zero or holds a null or non-finite
component takes no part, nor does a row with a null id.  Shorter vectors count as filled
with zeros.  A repeated row is a candidate as often as it occurs; rows with the query's
id are its own.  A query id that occurs with several vectors asks with the smallest.
Ties in score: the smaller id first.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import small_batches, staged

#: Vectors of a cell at about which another cell is made, the most cells, and sampled vectors per cell.
CELL_ROWS, MAX_CELLS, SAMPLE_PER_CELL = 16_384, 1_024, 64
#: Vectors and queries of one block.
ROWS, QUERIES = 4_096, 4_096
PROBES = 4
#: Width of the error bound in standard deviations of a random direction.
EPSILON = 2.5
#: Queries compared with a block at once, and best estimates reranked first (times k).
STEP, FIRST = 128, 3
SEED = 20_251


def rotation(dims: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every worker."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def usable(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(_id, v) of the rows that take part, in double precision."""
    v = F.col("v")
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(id_column).alias("_id"), F.col(vector_column).cast("array<double>").alias("v"))
    return rows.where(F.col("_id").isNotNull() & v.isNotNull() & F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False)))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column, filled with zeros up to ``dims``."""
    lengths = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten(), np.float64)
    if (lengths == dims).all():
        return flat.reshape(len(lengths), dims)
    out = np.zeros((len(lengths), dims))
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def centres_of(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """At most ``k`` centres of a bounded sample by Lloyd's rounds."""
    rng = np.random.default_rng(SEED)
    sample = np.unique(sample, axis=0)
    if k <= 1 or len(sample) <= k:
        return sample.mean(0, keepdims=True) if len(sample) > k or k <= 1 else sample
    centres = sample[rng.choice(len(sample), k, replace=False)]
    for _ in range(rounds):
        own = nearest_centre(sample, centres)
        sums, n = np.zeros_like(centres), np.bincount(own, minlength=k)
        np.add.at(sums, own, sample)
        has = n > 0
        centres[has] = sums[has] / n[has, None]
    return centres


def nearest_centre(v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1) - 2 * (v @ centres.T)).argmin(1) if len(centres) > 1 else np.zeros(len(v), np.int64)


def encode(v: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, |r|, x, <r, c>) of vectors and their centres."""
    r = v - centre
    norm = np.sqrt((r * r).sum(1))
    turned = (r @ turn) / np.where(norm > 0, norm, 1)[:, None]
    bits = turned > 0
    x = np.abs(turned).sum(1) / np.sqrt(v.shape[1])
    return np.packbits(bits, axis=1), norm, np.where(norm > 0, x, 1.0), (r * centre).sum(1)


def bounds(q: np.ndarray, centre: np.ndarray, turn: np.ndarray, code: np.ndarray, norm: np.ndarray, x: np.ndarray, rc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(estimates, error bounds) of the inner products of all queries (rows) with all coded vectors (columns)."""
    dims = q.shape[1]
    shift = q - centre
    signs = np.unpackbits(code, axis=1, count=dims).astype(np.float32) * np.float32(2) - np.float32(1)
    found = ((shift @ turn).astype(np.float32) @ signs.T) * (norm / (x * np.sqrt(dims))).astype(np.float32)
    found += (q @ centre).astype(np.float32)[:, None] + rc.astype(np.float32)
    width = norm * np.sqrt(np.maximum(1 - x * x, 0)) / x * min(1.0, EPSILON / np.sqrt(max(dims - 1, 1)))
    size = np.sqrt((shift * shift).sum(1))
    # Single precision is allowed for.
    slack = 1e-5 * (norm + np.sqrt((centre * centre).sum())) * (size.max(initial=0) + 1)
    return found, (size[:, None] * width + slack).astype(np.float32)


def _exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of one query with rows, each summed alike wherever its row stands."""
    return (v * q).sum(1)


def search_block(
    ids: np.ndarray, v: np.ndarray, coded: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], centre: np.ndarray, turn: np.ndarray,
    query_ids: np.ndarray, q: np.ndarray, least: np.ndarray, k: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, places, scores) of the k best of a block, as far as they reach ``least``."""
    for start in range(0, len(q), STEP):
        part = q[start : start + STEP]
        with np.errstate(invalid="ignore", over="ignore"):
            estimate, error = bounds(part, centre, turn, *coded)
        estimate = np.nan_to_num(estimate, nan=np.inf)
        upper = estimate + error
        first = min(FIRST * k, len(v))
        leading = np.argpartition(estimate, len(v) - first, axis=1)[:, len(v) - first :] if first < len(v) else np.broadcast_to(np.arange(len(v)), (len(part), len(v)))
        for i in range(len(part)):
            at = leading[i][ids[leading[i]] != query_ids[start + i]]
            scores = _exact(part[i], v[at])
            bound = least[start + i]
            if len(at) >= k:
                bound = max(bound, np.partition(scores, len(at) - k)[len(at) - k])
            more = ~(upper[i] < bound)
            more[leading[i]] = False
            more[ids == query_ids[start + i]] = False
            rest = np.flatnonzero(more)
            at = np.concatenate([at, rest])
            scores = np.concatenate([scores, _exact(part[i], v[rest])])
            good = ~(scores < bound)
            at, scores = at[good], scores[good]
            order = np.lexsort((ids[at], -scores))[:k]
            if len(order):
                yield start + i, at[order], scores[order]


def _index(rows: DataFrame, centres, dims: int) -> DataFrame:
    """(_id, v, cell, code, norm, x, rc, salt) of every vector."""
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, own = rotation(dims), centres.value
        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 40
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch.column("v"), dims)
            cell = nearest_centre(v, own)
            code, norm, x, rc = encode(v, own[cell], turn)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"), pa.array(list(v), pa.list_(pa.float64())), pa.array(cell.astype(np.int32)), pa.array([c.tobytes() for c in code], pa.binary()),
                    pa.array(norm), pa.array(x), pa.array(rc), pa.array(np.arange(row, row + len(v))),
                ],
                ["_id", "v", "cell", "code", "norm", "x", "rc", "salt"],
            )
            row += len(v)

    return rows.mapInArrow(run, f"_id {kind}, v array<double>, cell int, code binary, norm double, x double, rc double, salt long")


def _probes(queries: DataFrame, centres, radii: np.ndarray, dims: int, again: bool) -> DataFrame:
    """(cell, _id, v, least): the cells that each query asks; ``again``: those of the second round."""
    kind = queries.schema["_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = centres.value
        for batch in batches:
            if not batch.num_rows:
                continue
            q = matrix(batch.column("v"), dims)
            near = q @ own.T
            first = np.argsort(-near, axis=1, kind="stable")[:, :PROBES]
            asked = np.zeros(near.shape, bool)
            np.put_along_axis(asked, first, True, axis=1)
            if again:
                least = batch.column("least").to_numpy(zero_copy_only=False)
                size = np.sqrt((q * q).sum(1))[:, None]
                bound = near + size * radii + 1e-9 * size * (radii + np.sqrt((own * own).sum(1)))
                asked = ~asked & ~(bound < least[:, None])
            # Empty cells are not asked.
            asked &= radii >= 0
            i, cell = np.nonzero(asked)
            for start in range(0, len(i), 4096):
                at = pa.array(i[start : start + 4096])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell[start : start + 4096].astype(np.int32)), *(batch.column(c).take(at) for c in ("_id", "v", "least"))],
                    ["cell", "_id", "v", "least"],
                )

    return queries.mapInArrow(run, f"cell int, _id {kind}, v array<double>, least double")


def _asked(index: DataFrame, sizes: dict[int, int], probes: DataFrame, centres, dims: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): at most k rows for each query and block of the cells that it asks."""
    spark = index.sparkSession
    probes = staged(probes, "probes")
    # At most one row per cell.
    asking = {r["cell"]: r["count"] for r in probes.groupBy("cell").count().collect()}
    parts = [(c, -(-sizes[c] // ROWS), -(-n // QUERIES)) for c, n in asking.items()]
    table = F.broadcast(spark.createDataFrame(parts, "cell int, _blocks int, _groups int"))
    place = lambda salt, n: F.pmod(F.xxhash64(salt), F.col(n)).cast("int")
    blocks = index.join(table, "cell").withColumns({"row": place("salt", "_blocks"), "col": F.explode(F.sequence(F.lit(0), F.col("_groups") - 1))})
    groups = probes.join(table, "cell").withColumns({"col": place("_id", "_groups"), "row": F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))})
    keys, kind = ["cell", "row", "col"], index.schema["_id"].dataType.simpleString()
    query_kind = probes.schema["_id"].dataType.simpleString()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            left, right = left.combine_chunks(), right.combine_chunks()
            v, q = (matrix(t.column("v").chunk(0), dims) for t in (left, right))
            ids, query_ids = (t.column("_id").to_numpy() for t in (left, right))
            code = np.frombuffer(b"".join(left.column("code").to_pylist()), np.uint8).reshape(len(v), -1)
            least = np.nan_to_num(right.column("least").to_numpy(), nan=-np.inf)
            centre = centres.value[left.column("cell")[0].as_py()]
            coded = (code, *(left.column(c).to_numpy() for c in ("norm", "x", "rc")))
            out = list(search_block(ids, v, coded, centre, rotation(dims), query_ids, q, least, k))
        if not out:
            return pa.table([left.column("_id").slice(0, 0), left.column("_id").slice(0, 0), pa.array([], pa.float64())], ["query_id", "vec_id", "score"])
        who = np.repeat([i for i, _, _ in out], [len(s) for _, _, s in out])
        return pa.table(
            [right.column("_id").take(pa.array(who)), left.column("_id").take(pa.array(np.concatenate([a for _, a, _ in out]))), pa.array(np.concatenate([s for _, _, s in out]))],
            ["query_id", "vec_id", "score"],
        )

    blocks = blocks.select(*keys, "_id", "v", "code", "norm", "x", "rc")
    return blocks.groupBy(*keys).cogroup(groups.select(*keys, "_id", "v", "least").groupBy(*keys)).applyInArrow(
        run, f"query_id {query_kind}, vec_id {kind}, score double"
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query; Spark keeps k a query in each task before it shuffles."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of ``vectors`` for every row of ``queries``, by inner product."""
    spark = vectors.sparkSession
    small_batches(spark)
    rows = usable(vectors, id_column, vector_column)
    asked = usable(queries, id_column, vector_column).groupBy("_id").agg(F.min("v").alias("v"))
    own_kind, query_kind = rows.schema["_id"].dataType.simpleString(), asked.schema["_id"].dataType.simpleString()
    result = f"query_id {query_kind}, rank int, vec_id {own_kind}, score double"
    n, dims = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    widest = asked.agg(F.max(F.size("v"))).first()[0]
    if not n or not widest:
        return spark.createDataFrame([], result)
    dims = max(dims, widest)
    cells = min(max(-(-n // CELL_ROWS), 1), MAX_CELLS)
    bound = cells * SAMPLE_PER_CELL
    share = int(min(1.0, 2 * bound / n) * (1 << 32))
    picked = rows.where(F.pmod(F.xxhash64("_id", "v"), F.lit(1 << 32)) < share).select("v").limit(bound).toArrow()
    sample = matrix(picked.column("v").combine_chunks(), dims) if picked.num_rows else np.zeros((1, dims))
    centres = spark.sparkContext.broadcast(centres_of(sample, cells))
    index = staged(_index(rows, centres, dims), "index")
    # At most MAX_CELLS rows.
    stats = {r["cell"]: (r["n"], r["radius"]) for r in index.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("radius")).collect()}
    sizes = {c: n for c, (n, _) in stats.items()}
    radii = np.array([stats.get(c, (0, -1.0))[1] for c in range(len(centres.value))])
    asked = staged(asked.withColumn("least", F.lit(None).cast("double")), "queries")
    found = _asked(index, sizes, _probes(asked, centres, radii, dims, False), centres, dims, k)
    best = _best(found, k)
    if len(sizes) > PROBES:
        best = staged(best.select("query_id", "vec_id", "score"), "first")
        reached = best.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least"))
        waiting = asked.drop("least").join(reached, F.col("_id") == F.col("query_id"), "left").select("_id", "v", "least")
        more = _asked(index, sizes, _probes(waiting, centres, radii, dims, True), centres, dims, k)
        best = _best(best.unionByName(more), k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def every(vectors: DataFrame, step: int, id_column: str = "vec_id") -> DataFrame:
    """The query set of a table: its rows whose id is divisible by ``step``."""
    return vectors.where(F.col(id_column) % step == 0)


def recall(found: DataFrame, truth: DataFrame) -> float:
    """Share of the true (query, vector) pairs that were found."""
    n = truth.count()
    return truth.join(found, ["query_id", "vec_id"], "left_semi").count() / n if n else 1.0
