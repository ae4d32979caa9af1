"""Histograms of lists against a count of each item."""

from collections import Counter

from pyspark.sql import functions as F

from provenlake.operators import normalize


def test_runs_of_any_list(spark):
    lists = [[], None, ["a"], ["b", "a", "b", None, "é", "a", "b"], [None, None], ["x"] * 50 + ["y"] * 30, [str(i % 700) for i in range(5_000)]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "k int, items array<string>")
    rows = df.select("k", normalize.histogram(F.col("items")).alias("h")).select("*", F.map_keys("h").alias("keys")).collect()
    got, keys = {r.k: r.h for r in rows}, {r.k: r["keys"] for r in rows}
    for i, items in enumerate(lists):
        assert got[i] == (None if items is None else dict(Counter(x for x in items if x is not None)))
        assert items is None or keys[i] == sorted(keys[i])


def test_opcodes_are_named_once_and_sorted_by_name(spark):
    df = spark.createDataFrame([([71, 103, 71, 82, 0, 255, 0, 32, 79, 32],)], "ops array<int>")
    got, keys = df.select(normalize.opcode_histogram(F.col("ops")).alias("h")).select("h", F.map_keys("h")).first()
    assert got == {"grab": 2, "drop": 1, "noop": 3, "rotate_cw": 1, "unknown:0x00": 2, "unknown:0xff": 1} and keys == sorted(keys)


def test_long_lists_of_distinct_items_stay_linear(spark):
    df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(60_000)), lambda x: F.md5(x.cast("string"))).alias("items"))
    assert df.select(F.size(normalize.histogram(F.col("items"))).alias("n")).first().n == 60_000
