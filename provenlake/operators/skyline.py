"""Nondominated tuples of any number of metrics per group.

One tuple dominates another when it is at most as large in every metric and smaller in
one.  Tuples that a task holds are reduced where they are, sorted by their metrics: what
dominates a tuple stands before it, so a tuple is compared with the survivors so far.

Groups with many survivors are cut into a grid: quantiles of each metric place a tuple in
a cell.  A cell with a smaller coordinate in every metric than another dominates all of it,
so the corners of occupied cells drop whole cells.  A surviving tuple then meets only the
survivors of cells at or below its own: cells are reduced each in its own place, and a
crowded group is spread over as many tasks as it has cells.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed

#: Survivors of a group above which it is cut into cells, and the most cells of one group.
CROWDED, CELLS = 10_000, 512
#: Tuples compared at once.
BLOCK = 512


def _ordinals(column: pa.Array) -> np.ndarray:
    """Values as numbers of the same order."""
    if pa.types.is_integer(column.type) or pa.types.is_floating(column.type):
        return column.to_numpy(zero_copy_only=False)
    return np.unique(np.array(column.to_pylist(), object), return_inverse=True)[1]


def _dominated(rows: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Which rows are at least as large as some row of ``by`` in every metric."""
    out = np.zeros(len(rows), bool)
    for start in range(0, len(by), BLOCK):
        part = by[start : start + BLOCK]
        at = np.flatnonzero(~out)
        if not len(at):
            break
        below = np.ones((len(at), len(part)), bool)
        for k in range(rows.shape[1]):
            below &= part[:, k] <= rows[at, k][:, None]
        out[at] = below.any(1)
    return out


def survivors(values: np.ndarray) -> np.ndarray:
    """Places of the nondominated rows of distinct, lexicographically sorted tuples."""
    kept = np.zeros(0, np.int64)
    for start in range(0, len(values), BLOCK):
        block = values[start : start + BLOCK]
        at = np.arange(start, start + len(block))
        alive = ~_dominated(block, values[kept])
        block, at = block[alive], at[alive]
        below = np.ones((len(block), len(block)), bool)
        for k in range(values.shape[1]):
            below &= block[:, k] <= block[:, k][:, None]
        np.fill_diagonal(below, False)
        kept = np.concatenate([kept, at[~below.any(1)]])
    return kept


def _runs(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Tables of whole runs of equal keys, many short runs together, from sorted batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(k)[-1].as_py() for k in keys]
        opens = batch.num_rows - 1
        while opens and all(batch.column(k)[opens - 1].as_py() == v for k, v in zip(keys, last, strict=True)):
            opens -= 1
        if opens or (held and any(held[-1].column(k)[-1].as_py() != v for k, v in zip(keys, last, strict=True))):
            yield pa.Table.from_batches([*held, batch.slice(0, opens)])
            held = []
        held.append(batch.slice(opens))
    if held:
        yield pa.Table.from_batches(held)


def _bounds(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """First rows of the runs of equal keys, and the number of rows."""
    edges = np.zeros(table.num_rows, bool)
    edges[:1] = True
    for k in keys:
        code = table.column(k).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        edges[1:] |= code[1:] != code[:-1]
    return np.append(np.flatnonzero(edges), table.num_rows)


def _reduced(rows: DataFrame, keys: Sequence[str], metrics: Sequence[str], own: str | None = None) -> DataFrame:
    """Rows that no other row of their keys in the same partition dominates; with ``own``, only rows where it is true are given back."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, keys):
            values = np.stack([_ordinals(table.column(m).combine_chunks()) for m in metrics], 1)
            bounds = _bounds(table, keys)
            alone = np.diff(bounds) == 1
            kept = [bounds[:-1][alone]]
            for a, b in zip(bounds[:-1][~alone].tolist(), bounds[1:][~alone].tolist(), strict=True):
                kept.append(a + survivors(values[a:b]))
            at = np.sort(np.concatenate(kept))
            if own is not None:
                at = at[table.column(own).combine_chunks().to_numpy(zero_copy_only=False)[at]]
            yield from table.take(pa.array(at)).combine_chunks().to_batches(max_chunksize=1 << 14)

    return rows.sortWithinPartitions(*keys, *metrics).mapInArrow(run, rows.schema)


def _cell(bounds: Column, metric: str, index: int) -> Column:
    """Number of the metric's bounds below the value: smaller coordinates mean smaller values."""
    return F.size(F.filter(bounds[f"l{index}"], lambda b: b < F.col(metric)))


def pareto_frontier(solutions: DataFrame, group: str, metrics: Sequence[str], crowded: int = CROWDED) -> DataFrame:
    """(group, metrics.., rows): the nondominated tuples of each group, and how many rows have each.

    Rows with a null metric take no part.  A null group is a group.  Equal tuples are one
    tuple.  At least one metric is needed; NaN counts as larger than every number.
    """
    metrics = list(metrics)
    present = F.lit(True)
    for m in metrics:
        present = present & F.col(m).isNotNull()
    tuples = solutions.where(present).groupBy(group, *metrics).agg(F.count(F.lit(1)).alias("rows"))
    left = checkpointed(_reduced(tuples, [group], metrics))
    large = left.groupBy(F.col(group).alias("_g")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > crowded)
    # Grid lines per metric: one row for each crowded group, of which there are at most 1 / crowded of the rows.
    lines = max(int(CELLS ** (1 / len(metrics)) + 1e-9), 2)
    shares = [i / lines for i in range(1, lines)]
    grids = left.join(large, left[group].eqNullSafe(large["_g"]), "left_semi").groupBy(F.col(group).alias("_g")).agg(
        F.struct(*[F.percentile_approx(m, shares).alias(f"l{i}") for i, m in enumerate(metrics)]).alias("_lines")
    )
    cells = left.join(grids, left[group].eqNullSafe(grids["_g"]), "left").drop("_g").withColumn(
        "_cell", F.when(F.col("_lines").isNotNull(), F.array(*[_cell(F.col("_lines"), m, i) for i, m in enumerate(metrics)]))
    ).drop("_lines")
    small = cells.where("_cell IS NULL").drop("_cell")
    spread = cells.where("_cell IS NOT NULL")
    alone = _reduced(small.repartition(group), [group], metrics)
    return alone.unionByName(_of_cells(spread, group, metrics))


def _of_cells(spread: DataFrame, group: str, metrics: list[str]) -> DataFrame:
    """The nondominated rows of the crowded groups, whose rows carry their cells."""
    strictly = lambda a, b: _every(a, b, len(metrics), lambda x, y: x < y)
    at_most = lambda a, b: _every(a, b, len(metrics), lambda x, y: x <= y)
    # At most CELLS cells of a group: corners that no other one dominates are the ones that stay.
    occupied = spread.groupBy(F.col(group).alias("_g")).agg(F.collect_set("_cell").alias("_all"))
    occupied = occupied.select("_g", F.filter("_all", lambda c: ~F.exists("_all", lambda d: strictly(d, c))).alias("_cells"))
    met = spread.join(occupied, spread[group].eqNullSafe(occupied["_g"])).drop("_g")
    met = met.where(F.array_contains("_cells", F.col("_cell")))
    # Each cell by itself first, then every row with the survivors of the cells at or below its own.
    first = _reduced(met.withColumn("_home", _name(F.col("_cell"))).repartition(group, "_home"), [group, "_home"], metrics)
    dealt = checkpointed(first.drop("_home")).select(
        "*", F.explode(F.filter("_cells", lambda c: at_most(F.col("_cell"), c))).alias("_at")
    ).withColumns({"_home": _name(F.col("_at")), "_own": F.col("_at") == F.col("_cell")})
    reduced = _reduced(dealt.drop("_cells", "_cell", "_at").repartition(group, "_home"), [group, "_home"], metrics, "_own")
    return reduced.drop("_home", "_own")


def _name(cell: Column) -> Column:
    return F.array_join(cell.cast("array<string>"), "-")


def _every(a: Column, b: Column, n: int, test) -> Column:
    out = test(a[0], b[0])
    for i in range(1, n):
        out = out & test(a[i], b[i])
    return out
