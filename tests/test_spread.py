"""Heavy work per row is not left to the few splits of a small file."""

from pyspark.sql import functions as F

from provenlake.functions import binary
from provenlake.operators import semantics as operator
from provenlake.queries import semantics

DATA = "/root/testdata/sf0.001"


def test_puzzles_of_one_split_are_dealt_to_all_tasks(spark):
    assert spark.read.parquet(f"{DATA}/part.parquet").rdd.getNumPartitions() == 1
    puzzles = semantics.part_puzzles(spark, DATA)
    sizes = puzzles.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and sum(r["count"] for r in sizes) == spark.read.parquet(f"{DATA}/part.parquet").count()


def test_claims_with_links_in_the_rows_are_those_of_a_join(spark):
    decoded = binary.decode_puzzles(semantics.part_puzzles(spark, DATA))
    names = {"puzzle_id": F.concat(F.lit("p"), F.col("artifact_id").cast("string")), "observation_ids": F.array(F.lit("o"))}
    joined, failed = operator.artifact_claims(decoded, decoded.select("artifact_id", *[c.alias(n) for n, c in names.items()]))
    carried, also_failed = operator.artifact_claims(decoded.withColumns(names))
    assert carried.exceptAll(joined).isEmpty() and joined.exceptAll(carried).isEmpty() and not joined.isEmpty()
    assert sorted(failed.collect()) == sorted(also_failed.collect())
