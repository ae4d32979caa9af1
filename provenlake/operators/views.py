"""Views over verified solutions, and the extension views of the dataset specification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from .checks import rule_violations, unique_key_violations
from .ordering import running_before
from .skyline import pareto_frontier  # noqa: F401


def is_true(column: Column) -> Column:
    """True only for a present true; null is unknown and never enters a view."""
    return F.coalesce(column, F.lit(False))


def solution_views(
    solutions: DataFrame, verified: str = "verified", vanilla: str = "vanilla_constructible",
    eligible: str = "record_eligible",
) -> DataFrame:
    """Every row of every view, labelled; one pass, unverified rows leave all views."""
    labels = F.array_compact(
        F.array(
            F.lit(fixed.SOLUTION_VIEWS[0]),
            F.when(is_true(F.col(vanilla)), fixed.SOLUTION_VIEWS[1]),
            F.when(is_true(F.col(eligible)), fixed.SOLUTION_VIEWS[2]),
        )
    )
    return solutions.where(is_true(F.col(verified))).select(F.explode(labels).alias("view"), "*")


def best_known(solutions: DataFrame, group: str, metrics: Sequence[str], key: str) -> DataFrame:
    """(group, metric, best, holder): lowest value per metric, ties to the lowest key.

    ``min`` of a struct combines before the shuffle, so no group is gathered.
    """
    ends = solutions.groupBy(group).agg(
        *[
            F.min(F.when(F.col(m).isNotNull(), F.struct(F.col(m).alias("best"), F.col(key).alias("holder")))).alias(m)
            for m in metrics
        ]
    )
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in metrics])
    return ends.select(group, F.explode(pairs).alias("p")).where("p.v IS NOT NULL").select(
        group, "p.metric", F.col("p.v.best").alias("best"), F.col("p.v.holder").alias("holder")
    )


def regret(solutions: DataFrame, group: str, metric: str, key: str) -> DataFrame:
    """Each row's metric relative to the best of its group, as numerator and denominator."""
    best = solutions.groupBy(group).agg(F.min(metric).alias("best"))
    return solutions.where(F.col(metric).isNotNull()).join(best, group).select(
        group, key, F.col(metric).alias("numerator"), F.col("best").alias("denominator"),
        (F.col(metric) - F.col("best")).alias("regret"),
    )


def pareto_pair(solutions: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """Nondominated (x, y) tuples per group, with the number of rows on each.

    Rows collapse to one tuple per (group, x): at one x only the lowest y can
    survive, and it does when every cheaper x has a higher y.  The running
    minimum crosses partitions, so a crowded group is not held by one task.
    """
    tuples = solutions.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(group, x, y).agg(
        F.count(F.lit(1)).alias("rows")
    )
    steps = tuples.groupBy(group, x).agg(F.min(F.struct(F.col(y).alias(y), F.col("rows").alias("rows"))).alias("s"))
    lows = running_before(steps.select(group, x, "s.*"), group, x, y, "_best")
    return lows.where(F.col("_best").isNull() | (F.col(y) < F.col("_best"))).drop("_best")


def frontier_state(by_key: DataFrame, frontier: DataFrame, key: str) -> DataFrame:
    """Coverage states with ``frontier_populated`` where a group has a frontier member."""
    populated = frontier.select(key, F.lit(True).alias("_f")).distinct()
    return by_key.join(populated, key, "left").select(
        key, F.when(F.col("_f"), "frontier_populated").otherwise(F.col("state")).alias("state")
    )


def one_per_group(solutions: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """The first row of each group in ``order``; a combined minimum, not a window."""
    rest = [c for c in solutions.columns if c != group and c not in order]
    first = solutions.groupBy(group).agg(F.min(F.struct(*order, *rest)).alias("r"))
    return first.select(group, "r.*")


def origin_views(solutions: DataFrame, observations: DataFrame, generated_sources: Sequence[str], key: str = "solution_id") -> DataFrame:
    """Labelled rows of the two origin views: observed from people, and baselines that a generator made.

    observations: artifact_id, source_id.  A solution with sources of both kinds is in
    both views, one without an observation in neither.  Sources are folded to two flags
    before the shuffle, so a solution that is seen often is one row per task.
    """
    made = F.col("source_id").isin(*generated_sources)
    origins = observations.where(F.col("artifact_id").isNotNull() & F.col("source_id").isNotNull()).groupBy(
        F.col("artifact_id").alias(key)
    ).agg(F.max(~made).alias("_human"), F.max(made).alias("_generated"))
    labels = F.array_compact(F.array(F.when(F.col("_human"), F.lit("human-observed")), F.when(F.col("_generated"), F.lit("generated-baseline"))))
    return solutions.join(origins, key).select(F.explode(labels).alias("view"), *solutions.columns)


def view_input_violations(solutions: DataFrame) -> DataFrame:
    """Solution rows a view may not be derived from: rows breaking the release rules, repeated ids."""
    from .release import table_rules

    return rule_violations(solutions, table_rules("solutions"), "solutions", "solution_id").unionByName(
        unique_key_violations(solutions, "solution_id", "solutions")
    )


def metric_quantiles(solutions: DataFrame, group: str, metric: str, quantiles: Sequence[float]) -> DataFrame:
    """(group, quantile, value): the lowest value that covers each share of the group's rows.

    Exact at any size: rows collapse to counts per value, and cumulative counts
    cross partitions instead of gathering a group.
    """
    counts = solutions.where(F.col(metric).isNotNull()).groupBy(group, metric).agg(F.count(F.lit(1)).alias("n"))
    placed = running_before(counts, group, metric, "n", "_before", F.sum).na.fill(0, ["_before"])
    totals = counts.groupBy(group).agg(F.sum("n").alias("_total"))
    wanted = F.explode(F.array(*[F.lit(float(q)) for q in quantiles])).alias("quantile")
    rank = F.greatest(F.ceil(F.col("quantile") * F.col("_total")), F.lit(1))
    return (
        placed.alias("p").join(totals.alias("t"), F.col(f"p.{group}").eqNullSafe(F.col(f"t.{group}")))
        .select(F.col(f"p.{group}").alias(group), metric, "n", "_before", "_total", wanted)
        .where((F.col("_before") < rank) & (rank <= F.col("_before") + F.col("n")))
        .select(group, "quantile", F.col(metric).alias("value"))
    )
