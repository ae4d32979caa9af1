"""Checks that return violations as rows: (code, detail, path, row_key).

``path`` names the table and ``row_key`` the offending row (its key or line
number as text).  Nothing here collects; a check over a clean table costs one
scan, plus one pre-aggregated shuffle when it compares rows of a group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored

VIOLATION = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("detail", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("row_key", T.StringType()),
    ]
)


class ChecksFailed(ValueError):
    """A build stopped on violations; carries the first of them in order."""

    def __init__(self, shown: list, total_is_larger: bool):
        self.violations = shown
        lines = [f"{v['path'] or '<input>'}:{v['row_key']}: {v['code']}: {v['detail']}" for v in shown]
        if total_is_larger:
            lines.append("... and more")
        super().__init__("\n".join(lines))


def no_violations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], VIOLATION)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def violations_where(
    df: DataFrame, condition: Column, code: str, detail: Column | str, path: str, row_key: Column | str
) -> DataFrame:
    """One violation for each row on which ``condition`` is true."""
    text = F.lit(detail) if isinstance(detail, str) else detail
    key = F.col(row_key) if isinstance(row_key, str) else row_key
    return df.where(condition).select(
        F.lit(code).alias("code"), text.alias("detail"), F.lit(path).alias("path"),
        key.cast("string").alias("row_key"),
    )


def rule_violations(
    df: DataFrame, rules: Mapping[str, Column], path: str, row_key: str, code: str = "schema_invalid"
) -> DataFrame:
    """Apply every rule in one pass; a rule that is not true (false or null) is violated."""
    failed = F.array_compact(
        F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()])
    )
    return (
        df.select(F.col(row_key).cast("string").alias("row_key"), failed.alias("failed"))
        .where(F.size("failed") > 0)
        .select("row_key", F.explode("failed").alias("detail"))
        .select(F.lit(code).alias("code"), "detail", F.lit(path).alias("path"), "row_key")
    )


def assert_clean(violations: DataFrame, show: int = 20) -> None:
    """Raise when there is any violation; only the first ``show`` reach the driver."""
    head = violations.orderBy(
        F.col("path").asc_nulls_first(), F.col("row_key").asc_nulls_first(), "code", "detail"
    ).take(show + 1)
    if head:
        raise ChecksFailed(head[:show], len(head) > show)


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], row_no: str) -> DataFrame:
    """Every later row of a repeated key with the row where the key was first seen.

    The first row per key comes from a combined ``min``; only repeated keys are
    joined back, so unique rows never take part in the join and a hot key is a
    skewed join that AQE splits, not a window over the whole key.  A null key is
    never a duplicate: it does not match in the join.
    """
    first = (
        df.groupBy(*keys)
        .agg(F.min(row_no).alias("first_row"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    return df.join(first, list(keys)).where(F.col(row_no) > F.col("first_row"))


def duplicate_key_violations(
    df: DataFrame, key: str, row_no: str, path: str, code: str = "duplicate_canonical_id"
) -> DataFrame:
    later = duplicate_keys(df.select(key, row_no), [key], row_no)
    detail = F.concat(
        F.lit(f"duplicate {key} '"), F.col(key).cast("string"), F.lit("'; first seen on row "),
        F.col("first_row").cast("string"),
    )
    return violations_where(later, F.lit(True), code, detail, path, row_no)


def unique_key_violations(df: DataFrame, key: str, path: str, tolerate_identical: bool = False) -> DataFrame:
    """Null or empty keys, and keys carried by more than one row.

    With ``tolerate_identical`` a repeated key is a violation only when its rows
    differ in some other column.
    """
    text = F.col(key).cast("string")
    invalid = violations_where(
        df, text.isNull() | (text == ""), f"invalid_{key}", f"invalid {key}", path, F.lit(None).cast("string")
    )
    present = df.where(text.isNotNull() & (text != ""))
    if tolerate_identical:
        rest = F.struct(*[c for c in sorted(df.columns) if c != key])
        bad = present.groupBy(key).agg(F.min(rest).alias("lo"), F.max(rest).alias("hi"))
        bad = bad.where(~F.col("lo").eqNullSafe(F.col("hi")))
        repeated = violations_where(bad, F.lit(True), f"conflicting_{key}", f"conflicting facts for {key}", path, key)
    else:
        bad = key_counts(present, [key]).where("n > 1")
        repeated = violations_where(bad, F.lit(True), f"duplicate_{key}", f"duplicate {key}", path, key)
    return invalid.unionByName(repeated)


def _digests(columns: Sequence[str]) -> list[Column]:
    """128 bits of a tuple as two longs; a null differs from every value, also by its place."""
    parts = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    return [F.xxhash64(F.lit(salt), *parts) for salt in (0, 1)]


def dependency_conflicts(df: DataFrame, keys: Sequence[str], dependents: Sequence[str]) -> DataFrame:
    """Keys whose rows disagree on the dependent columns; null is a key value.

    Agreement is settled by a hash aggregate, combined in the tasks: the extremes of two
    64-bit hashes of the dependent tuple are equal when there is one tuple.  Only the keys
    that disagree are written, and their rows met again for the exact lowest and highest
    tuple; a table that holds its dependencies is neither sorted nor shuffled twice.
    """
    ends = [f(h).alias(f"_{n}{i}") for i, h in enumerate(_digests(dependents)) for n, f in (("low", F.min), ("high", F.max))]
    found = df.groupBy(*keys).agg(*ends, F.count(F.lit(1)).alias("n")).where("_low0 <> _high0 OR _low1 <> _high1")
    found = stored(found.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], "n"), "conflicts")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(f"_rows.{k}").eqNullSafe(F.col(f"_found._key{i}"))
    met = df.select(*keys, *[c for c in dependents if c not in keys]).alias("_rows").join(found.alias("_found"), same)
    tuple_ = F.struct(*[F.col(f"_rows.{c}") for c in dependents])
    return met.groupBy(*[F.col(f"_rows.{k}") for k in keys]).agg(
        F.min(tuple_).alias("lowest"), F.max(tuple_).alias("highest"), F.max("n").alias("n")
    )


def dependency_violations(
    df: DataFrame, keys: Sequence[str], dependents: Sequence[str], code: str, path: str
) -> DataFrame:
    detail = F.concat(F.to_json("lowest"), F.lit(" <> "), F.to_json("highest"))
    return violations_where(
        dependency_conflicts(df, keys, dependents), F.lit(True), code, detail, path,
        F.to_json(F.struct(*keys)),
    )


def missing_references(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Child rows whose key has no parent; a null key never has one."""
    known = parent.select(F.col(parent_key).alias("_known"))
    return child.join(known, child[child_key] == F.col("_known"), "left_anti")


def reference_violations(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, label: str, path: str, row_key: str
) -> DataFrame:
    lost = missing_references(child, child_key, parent, parent_key)
    detail = F.concat(
        F.lit(f"references unknown {label} "), F.coalesce(F.col(child_key).cast("string"), F.lit("None"))
    )
    return violations_where(lost, F.lit(True), "referential_integrity", detail, path, row_key)


def single_valued(df: DataFrame, columns: Sequence[str], code: str, path: str) -> DataFrame:
    """A violation when the table holds more than one combination of ``columns``."""
    tuple_ = F.struct(*columns)
    ends = df.agg(F.min(tuple_).alias("lowest"), F.max(tuple_).alias("highest"))
    detail = F.concat(F.to_json("lowest"), F.lit(" <> "), F.to_json("highest"))
    return violations_where(
        ends, ~F.col("lowest").eqNullSafe(F.col("highest")), code, detail, path, F.lit(None).cast("string")
    )


def set_difference(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """(key, side): ``missing`` is expected only, ``unexpected`` is actual only."""
    sides = (
        expected.select(key, F.lit(True).alias("_expected"))
        .unionByName(actual.select(key, F.lit(False).alias("_expected")))
        .where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max("_expected").alias("_in_expected"), F.min("_expected").alias("_only_expected"))
    )
    # In both tables: some row says expected and some row says not.
    return sides.where(F.col("_in_expected") == F.col("_only_expected")).select(
        key, F.when(F.col("_in_expected"), "missing").otherwise("unexpected").alias("side")
    )


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with both counts (empty when identical).

    One pre-aggregated shuffle compares both sides at once; identical copies
    collapse before the shuffle however many there are.
    """
    columns = left.columns
    both = left.select(*columns, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*columns, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    return (
        both.groupBy(*columns)
        .agg(F.sum("_l").alias("left_count"), F.sum("_r").alias("right_count"))
        .where("left_count <> right_count")
    )


def packed(links: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """(keys, name): all distinct values of each key as one sorted array.

    For rows whose published form is a list.  Links are reduced to distinct pairs
    before anything is collected; what only needs a flag or a count takes it from
    the links (``link_counts``), not from the list.
    """
    pairs = links.select(*keys, F.col(value).alias("_value")).where("_value IS NOT NULL").distinct()
    return pairs.groupBy(*keys).agg(F.sort_array(F.collect_list("_value")).alias(name))


def link_counts(links: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """(keys, name): the number of distinct values of each key."""
    pairs = links.select(*keys, F.col(value).alias("_value")).where("_value IS NOT NULL").distinct()
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
