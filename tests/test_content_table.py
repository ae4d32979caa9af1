"""The content table: read once, met by key without moving bytes, facts without content."""

import pytest
from pyspark.sql import functions as F
from world import World

from provenlake.operators import verify
from provenlake.plans import release as plan
from provenlake.sources import files


def objects(spark, n=200):
    body = F.concat(F.lit("body "), F.col("id").cast("string")).cast("binary")
    return spark.range(n).select(
        F.concat(F.lit("objects/"), F.col("id").cast("string")).alias("object_key"), F.octet_length(body).cast("bigint").alias("byte_length"),
        F.sha2(body, 256).alias("sha256"), body.alias("content"),
    )


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shuffled(spark):
    """No broadcasts, as with keys of any size."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_rows_are_kept_as_they_are(spark):
    odd = spark.createDataFrame(
        [("objects/a", 1, "d1", b"x"), ("objects/b", 1, "d1", b"x"), ("objects/c", 0, "d2", b""), ("objects/d", None, None, None)],
        "object_key string, byte_length bigint, sha256 string, content binary",
    )
    stored = files.content_table(odd.withColumn("note", F.lit("extra")), 4)
    assert sorted(stored.collect(), key=lambda r: r.object_key) == sorted(odd.collect(), key=lambda r: r.object_key)
    assert files.content_table(odd.limit(0), 4).count() == 0


def test_joins_by_digest_do_not_move_the_bytes(spark, shuffled):
    stored = files.content_table(objects(spark), 8)
    keys = objects(spark, 50).select("sha256", F.lit(1).alias("wanted"))
    joined = keys.join(stored.select("sha256", "content"), "sha256")
    text = plan_text(joined)
    # The keys are dealt; the bytes are read where their bucket lies.
    assert "Bucketed: true" in text and text.count("Exchange hashpartitioning") == 1, text
    assert joined.count() == 50
    facts = plan_text(stored.select("sha256", "byte_length"))
    assert "ReadSchema: struct<byte_length:bigint,sha256:string>" in facts and "content:binary" not in facts


def test_tables_are_dropped(spark):
    stored = files.content_table(objects(spark, 3), 2)
    assert stored.count() == 3
    files.drop_content_tables(spark)
    assert [t for t in spark.catalog.listTables() if t.name.startswith("content_")] == []


def test_a_build_reads_every_object_once(spark, tmp_path):
    world = World(tmp_path).fill()
    root = str(world.root)
    inventory, _ = files.read_inventory(spark, world.inventory())
    receipts = files.receipt_columns(files.read_receipts(spark, root))
    stored = files.read_objects(spark, root)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    tapped = stored.mapInArrow(counted, stored.schema)
    verdict = {
        "parse_status": "passed", "simulation_status": "failed", "cost": None, "cycles": None, "area": None, "instructions": None,
        "vanilla_constructible": None, "record_eligible": None, "error_code": "collision", "error_detail": None,
    }
    identity = verify.VerifierIdentity("sim", "rev", "f" * 64, "profile-v1")
    made, _ = plan.run_pipeline(receipts, tapped, inventory, "base-game-test", identity, verifier=lambda p, s: verdict)
    assert made["solutions"].count() == 3
    assert reads.value == stored.select("object_key").count()
