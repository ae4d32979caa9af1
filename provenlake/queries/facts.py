"""Observations, external topology, production constraints and puzzle results."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import nested
from ..functions.canonical import json_of
from ..operators import evaluation as ev
from ..operators import ingest, pairing, semantics
from ..operators import views as vw
from .common import document_candidates, query, table
from .evaluation import order_metrics

_TOPOLOGY = """
WITH cat AS (SELECT o_orderkey AS k, 'v' || (o_custkey % 1000) AS variant FROM orders WHERE o_orderstatus <> 'P'),
cnt AS (
  SELECT 'v' || l_suppkey AS variant, sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) % 3 ELSE 0 END) AS re,
    sum(CASE WHEN l_returnflag = 'A' AND l_suppkey % 5 <> 0 THEN CAST(l_quantity AS BIGINT) % 2 ELSE 0 END) AS pr
  FROM lineitem WHERE l_linenumber = 1 GROUP BY 1)"""


@query(f"""{_TOPOLOGY}
SELECT CAST(o.o_orderkey AS VARCHAR) AS puzzle_id, 'g' || o.o_orderkey AS game_puzzle_id, cat.variant, CAST(coalesce(re, 0) AS BIGINT) AS reagents,
  CAST(coalesce(pr, 0) AS BIGINT) AS products,
  CASE WHEN cat.variant IS NULL THEN 'missing_from_catalog' WHEN coalesce(re, 0) = 0 THEN 'missing_reagents' WHEN coalesce(pr, 0) = 0 THEN 'missing_products' ELSE 'ok' END AS status
FROM orders o LEFT JOIN cat ON cat.k = o.o_orderkey LEFT JOIN cnt ON cnt.variant = cat.variant""")
def topology_status(spark, sf):
    """Orders as puzzles, customers' numbers as variants, first lines as the molecules that a variant uses."""
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem").where("l_linenumber = 1")
    game = F.concat(F.lit("g"), F.col("o_orderkey").cast("string"))
    inventory = orders.select(F.col("o_orderkey").cast("string").alias("puzzle_id"), game.alias("game_puzzle_id"))
    catalog = orders.where("o_orderstatus <> 'P'").select(game.alias("game_puzzle_id"), F.concat(F.lit("v"), (F.col("o_custkey") % 1000).cast("string")).alias("variant"))
    quantity = F.col("l_quantity").cast("bigint")
    uses = lines.select(
        F.concat(F.lit("v"), F.col("l_suppkey").cast("string")).alias("variant"), F.col("l_partkey").alias("molecule"),
        F.when(F.col("l_returnflag") == "R", quantity % 3).otherwise(0).alias("reagent_count"),
        F.when((F.col("l_returnflag") == "A") & (F.col("l_suppkey") % 5 != 0), quantity % 2).otherwise(0).alias("product_count"),
    )
    return semantics.topology_status(inventory, catalog, uses)


@query("""
WITH d AS (SELECT d.*, l.quality, l.toxic, sha256(d.text) AS sha FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT DISTINCT 'om.solution.sha256.' || sha AS artifact_id, 'artifact' AS source_role, lang || '/' || doc_id || '.solution' AS source_path,
  CAST(NULL AS VARCHAR) AS associated_artifact_path, CAST(NULL AS VARCHAR) AS source_declared_puzzle_id, sha AS observed_sha256, CAST(NULL AS BIGINT) AS claimed_cost FROM d
UNION ALL
SELECT 'om.solution.sha256.' || sha, 'metadata', lang || '/' || doc_id || '.json', CASE WHEN doc_id % 2 = 0 THEN lang || '/' || doc_id || '.solution' END,
  CASE WHEN doc_id % 2 = 0 THEN lang END, sha, CAST(quality AS BIGINT) FROM d WHERE quality IS NOT NULL""")
def provenance_observations(spark, sf):
    """Documents and their labels as observed files; the context of a label's file is known for even ids."""
    docs = table(spark, sf, "documents")
    rows = ingest.provenance_rows(document_candidates(docs, table(spark, sf, "labels")))
    seen, _ = pairing.observations_from_provenance(rows, "solution", "driver", _contexts(docs))
    return seen.select("artifact_id", "source_role", "source_path", "associated_artifact_path", "source_declared_puzzle_id", "observed_sha256", "claimed_cost")


def _contexts(docs):
    stem = F.concat(F.col("lang"), F.lit("/"), F.col("doc_id").cast("string"))
    return docs.where("doc_id % 2 = 0").select(
        F.concat(stem, F.lit(".json")).alias("source_path"), F.concat(stem, F.lit(".solution")).alias("associated_artifact_path"), F.col("lang").alias("source_declared_puzzle_id")
    )


@query("""
SELECT 'missing_metadata_context' AS code, lang || '/' || d.doc_id || '.json' AS detail, 'om.solution.sha256.' || sha256(text) AS row_key
FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL AND d.doc_id % 2 <> 0""")
def observations_without_context(spark, sf):
    docs = table(spark, sf, "documents")
    rows = ingest.provenance_rows(document_candidates(docs, table(spark, sf, "labels")))
    _, lost = pairing.observations_from_provenance(rows, "solution", "driver", _contexts(docs))
    return lost.select("code", "detail", "row_key")


@query("""
SELECT p_partkey, '{"cabinets":[' || array_to_string(list_sort(['{"cabinet_type":"Small","q":' || p_size || ',"r":' || (-p_size) || '}', '{"cabinet_type":"Wide","q":' || (p_size % 7) || ',"r":0}']), ',')
  || '],"conduits":[' || array_to_string(list_sort([
    '{"a_q":' || (p_size % 3) || ',"a_r":1,"b_q":2,"b_r":3,"hexes":[' || array_to_string(list_sort(['{"q":2,"r":1}', '{"q":1,"r":' || (p_size % 5) || '}']), ',') || ']}',
    '{"a_q":' || (p_size % 11) || ',"a_r":0,"b_q":0,"b_r":0,"hexes":[]}']), ',')
  || '],"isolate_inputs_from_outputs":' || CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'false' END || ',"shrink_left":true,"shrink_right":false,"vials":['
  || array_to_string(list_sort(['{"count":' || p_size || ',"q":0,"r":0,"style":1}', '{"count":3,"q":' || (p_size % 4) || ',"r":1,"style":0}']), ',') || ']}' AS constraints
FROM part""")
def production_constraints(spark, sf):
    """Every part as production constraints whose lists come in no order."""
    size, lit = F.col("p_size").cast("int"), lambda n: F.lit(n).cast("int")
    place = lambda q, r: [q.cast("int").alias("q"), r.cast("int").alias("r")]
    ends = lambda *v: [x.cast("int").alias(n) for x, n in zip(v, ("a_q", "a_r", "b_q", "b_r"), strict=True)]
    none = F.array().cast("array<struct<q:int,r:int>>")
    value = F.struct(
        F.lit(True).alias("shrink_left"), F.lit(False).alias("shrink_right"), (size % 2 == 0).alias("isolate_inputs_from_outputs"),
        F.array(F.struct(F.lit("Wide").alias("cabinet_type"), *place(size % 7, lit(0))), F.struct(F.lit("Small").alias("cabinet_type"), *place(size, -size))).alias("cabinets"),
        F.array(
            F.struct(*ends(size % 11, lit(0), lit(0), lit(0)), none.alias("hexes")),
            F.struct(*ends(size % 3, lit(1), lit(2), lit(3)), F.array(F.struct(*place(lit(2), lit(1))), F.struct(*place(lit(1), size % 5))).alias("hexes")),
        ).alias("conduits"),
        F.array(
            F.struct(F.lit(3).cast("bigint").alias("count"), *place(size % 4, lit(1)), lit(0).alias("style")),
            F.struct(size.cast("bigint").alias("count"), *place(lit(0), lit(0)), lit(1).alias("style")),
        ).alias("vials"),
    )
    return table(spark, sf, "part").select("p_partkey", value.alias("v")).select("p_partkey", json_of(nested.canonical_constraints(F.col("v"))).alias("constraints"))


_RESULTS = """
WITH a AS (SELECT conv_id AS puzzle_id, turn + 1 AS idx, role = 'assistant' AND length(text) > 400 AS ok FROM conversations),
s AS (SELECT puzzle_id, count(*) AS n, count(DISTINCT idx) AS d, min(idx) AS lo, max(idx) AS hi, min(CASE WHEN ok THEN idx END) AS first FROM a GROUP BY 1),
good AS (SELECT * FROM s WHERE lo = 1 AND hi = n AND d = n AND n <= 6 AND NOT coalesce(first < hi, false))"""


def turn_results(spark, sf):
    """Results of conversations as attempt series of at most six turns."""
    solved = (F.col("role") == "assistant") & (F.length("text") > 400)
    nothing = F.lit(None).cast("string")
    one = F.lit(1).cast("bigint")
    rows = table(spark, sf, "conversations").select(
        F.lit("b").alias("benchmark_id"), F.lit("r").alias("run_id"), F.col("conv_id").cast("string").alias("puzzle_id"), (F.col("turn") + 1).alias("attempt_index"),
        F.when(solved, "success").otherwise("simulation_failed").alias("outcome"), nothing.alias("compile_error"), nothing.alias("parse_error"),
        F.sha2("text", 256).alias("candidate_sha256"), F.lit("v").alias("verification_id"), *[F.length("text").cast("bigint").alias(m) for m in ev.METRICS],
        nothing.alias("error_code"), *[one.alias(c) for c in ev.COUNTERS],
    )
    return ev.puzzle_results(ev.project_attempts(rows), 6)


@query(f"""{_RESULTS}
SELECT CAST(g.puzzle_id AS VARCHAR) AS puzzle_id, first IS NOT NULL AS solved, CAST(first AS BIGINT) AS first_success_attempt,
  (SELECT string_agg(idx || ':' || CASE WHEN ok THEN 'success' ELSE 'simulation_failed' END, ',' ORDER BY idx) FROM a WHERE a.puzzle_id = g.puzzle_id) AS attempts
FROM good g""")
def puzzle_results(spark, sf):
    shown = F.array_join(F.transform("attempts", lambda a: F.concat(a["attempt_index"].cast("string"), F.lit(":"), a["outcome"])), ",")
    return turn_results(spark, sf).select("puzzle_id", "solved", F.col("first_success_attempt").cast("bigint").alias("first_success_attempt"), shown.alias("attempts"))


@query(f"""{_RESULTS}
SELECT 'result_inconsistent' AS code, CAST(puzzle_id AS VARCHAR) AS row_key FROM good WHERE puzzle_id % 5 IN (0, 1) OR (puzzle_id % 5 = 2 AND n > 1)""")
def rebuilt_results(spark, sf):
    """Forged results: the flag turned, the first success moved, or the first attempt lost."""
    results, fifth = turn_results(spark, sf), F.col("puzzle_id").cast("bigint") % 5
    forged = results.withColumns({
        "solved": F.when(fifth == 0, ~F.col("solved")).otherwise(F.col("solved")),
        "first_success_attempt": F.when(fifth == 1, F.coalesce(F.col("first_success_attempt"), F.lit(0)) + 1).otherwise(F.col("first_success_attempt")),
        "attempts": F.when((fifth == 2) & (F.size("attempts") > 1), F.slice("attempts", 2, 100)).otherwise(F.col("attempts")),
    })
    return ev.rebuilt_result_violations(forged).select("code", "row_key")


@query("""
SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') THEN 'frontier_populated'
  WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) THEN 'observed' ELSE 'absent' END AS state FROM customer""")
def frontier_state(spark, sf):
    """Customers with a member of the frontier of their finished orders."""
    seen = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.lit(True).alias("_seen")).distinct()
    by_key = table(spark, sf, "customer").select("c_custkey").join(seen, "c_custkey", "left").select("c_custkey", F.when(F.col("_seen"), "observed").otherwise("absent").alias("state"))
    frontier = vw.pareto_frontier(order_metrics(spark, sf), "o_custkey", ["cycles", "cost"]).withColumnRenamed("o_custkey", "c_custkey")
    return vw.frontier_state(by_key, frontier, "c_custkey")
