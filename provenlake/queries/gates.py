"""Release projection and its gates.

customer = puzzles (one artifact of their own, one of their nation; segment BUILDING is not
released), orders = solutions (priority and status decide the artifact and the verdict),
lineitem = normalized rows, events = observations.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import release
from .common import query, table

_PUZZLES = """
puz AS (SELECT CAST(c_custkey AS VARCHAR) AS id, 'a' || c_custkey AS own, 'n' || c_nationkey AS shared FROM customer WHERE c_mktsegment <> 'BUILDING'),
art AS (SELECT id, own AS a FROM puz UNION SELECT id, shared FROM puz),
sol AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS sid, CAST(o_custkey AS VARCHAR) AS pid,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'a' || (o_custkey + 1) WHEN '2-HIGH' THEN 'n' || (o_custkey % 25) WHEN '3-MEDIUM' THEN NULL ELSE 'a' || o_custkey END AS aid
  FROM orders WHERE o_orderstatus <> 'P')"""


def _puzzles(spark, sf):
    own = F.concat(F.lit("a"), F.col("c_custkey").cast("string"))
    shared = F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))
    return table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").cast("string").alias("puzzle_id"), F.array(own, shared).alias("puzzle_artifact_ids")
    )


def _solution_artifact():
    key = F.col("o_custkey")
    return F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("a"), (key + 1).cast("string"))).when(
        F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("n"), (key % 25).cast("string"))
    ).when(F.col("o_orderpriority") != "3-MEDIUM", F.concat(F.lit("a"), key.cast("string")))


def _line_key():
    return F.concat_ws("/", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey")])


@query(f"""
WITH {_PUZZLES},
nrm AS (SELECT l_orderkey || '/' || l_linenumber || '/' || l_partkey AS nid, CAST(l_orderkey AS VARCHAR) AS sid, CAST(l_suppkey AS VARCHAR) AS pid FROM lineitem),
obs AS (
  SELECT CAST(event_id AS VARCHAR) AS oid, CASE event_type WHEN 'purchase' THEN 'solution' WHEN 'signup' THEN 'puzzle' WHEN 'error' THEN 'puzzle' WHEN 'click' THEN 'solution' END AS kind,
    CASE event_type WHEN 'purchase' THEN CAST(event_id AS VARCHAR) WHEN 'signup' THEN 'a' || user_id WHEN 'click' THEN NULL END AS aid, event_type = 'click' AS metadata FROM events)
SELECT 'referential_integrity' AS code, 'references unknown puzzle ' || coalesce(pid, 'None') AS detail, 'solutions' AS path, sid AS row_key FROM sol WHERE pid IS NULL OR pid NOT IN (SELECT id FROM puz)
UNION ALL SELECT 'referential_integrity', 'references unknown puzzle artifact ' || coalesce(aid, 'None'), 'solutions', sid FROM sol WHERE aid IS NULL OR aid NOT IN (SELECT a FROM art)
UNION ALL SELECT 'puzzle_artifact_other_puzzle', 'artifact belongs to another puzzle', 'solutions', sid FROM sol s
  WHERE aid IN (SELECT a FROM art) AND NOT EXISTS (SELECT 1 FROM art WHERE art.a = s.aid AND art.id = s.pid)
UNION ALL SELECT 'referential_integrity', 'references unknown solution ' || sid, 'normalized', nid FROM nrm WHERE sid NOT IN (SELECT sid FROM sol)
UNION ALL SELECT 'referential_integrity', 'references unknown puzzle ' || pid, 'normalized', nid FROM nrm WHERE pid NOT IN (SELECT id FROM puz)
UNION ALL SELECT 'referential_integrity', 'references unknown solution ' || coalesce(aid, 'None'), 'observations', oid FROM obs
  WHERE kind = 'solution' AND NOT (metadata AND aid IS NULL) AND (aid IS NULL OR aid NOT IN (SELECT sid FROM sol))
UNION ALL SELECT 'referential_integrity', 'references unknown puzzle artifact ' || coalesce(aid, 'None'), 'observations', oid FROM obs
  WHERE kind = 'puzzle' AND (aid IS NULL OR aid NOT IN (SELECT a FROM art))""")
def release_integrity(spark, sf):
    """All six reference rules and the same-puzzle rule."""
    kind = F.col("event_type")
    solutions = table(spark, sf, "orders").where("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").cast("string").alias("solution_id"), F.col("o_custkey").cast("string").alias("puzzle_id"), _solution_artifact().alias("puzzle_artifact_id")
    )
    normalized = table(spark, sf, "lineitem").select(
        _line_key().alias("normalized_solution_id"), F.col("l_orderkey").cast("string").alias("solution_id"), F.col("l_suppkey").cast("string").alias("puzzle_id")
    )
    observations = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("observation_id"), F.when(kind == "click", "metadata").otherwise("artifact").alias("source_role"),
        F.when(kind.isin("purchase", "click"), "solution").when(kind.isin("signup", "error"), "puzzle").alias("artifact_kind"),
        F.when(kind == "purchase", F.col("event_id").cast("string")).when(kind == "signup", F.concat(F.lit("a"), F.col("user_id").cast("string"))).alias("artifact_id"),
    )
    return release.integrity_violations({"puzzles": _puzzles(spark, sf), "solutions": solutions, "normalized": normalized, "observations": observations})


_FLAG = "CASE o_orderstatus WHEN 'F' THEN 'passed' WHEN 'O' THEN 'failed' END"


@query(f"""
WITH seen AS (SELECT l_orderkey AS k, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1)
SELECT CAST(o_orderkey AS VARCHAR) AS solution_id, sha256(CAST(o_orderkey AS VARCHAR)) AS solution_sha256, CAST(o_custkey AS VARCHAR) AS puzzle_id,
  CASE WHEN o_orderstatus <> 'P' THEN 'a' || o_custkey END AS puzzle_artifact_id, 'unknown' AS rights_status,
  CASE WHEN o_orderstatus <> 'P' THEN coalesce({_FLAG} = 'passed' AND o_orderpriority <> '5-LOW', false) END AS verified,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS cost, n AS source_count,
  CASE WHEN o_orderpriority <> '1-URGENT' THEN 'om.n.' || o_orderkey END AS normalized_solution_id, 'orders' AS collection_id
FROM orders LEFT JOIN seen ON k = o_orderkey""")
def release_solutions(spark, sf):
    """Release rows of orders: pending ones have no verification, urgent ones no normalized form."""
    orders, key = table(spark, sf, "orders"), F.col("o_orderkey").cast("string")
    artifacts = orders.select(
        key.alias("artifact_id"), F.sha2(key, 256).alias("sha256"), F.col("o_custkey").cast("string").alias("puzzle_id"),
        F.lit("solution").alias("artifact_format"), F.lit("unknown").alias("rights_status"),
    )
    none = F.lit(None).cast("bigint")
    verifications = orders.where("o_orderstatus <> 'P'").select(
        key.alias("solution_id"), F.concat(F.lit("a"), F.col("o_custkey").cast("string")).alias("puzzle_artifact_id"),
        F.when(F.col("o_orderstatus") == "F", "passed").otherwise("failed").alias("parse_status"),
        F.when(F.col("o_orderpriority") == "5-LOW", "failed").otherwise("passed").alias("simulation_status"),
        F.lit("p").alias("validation_profile"), F.lit("r").alias("verifier_revision"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cost"),
        none.alias("cycles"), none.alias("area"), none.alias("instructions"), F.lit(None).cast("boolean").alias("vanilla_constructible"),
        F.lit(None).cast("boolean").alias("record_eligible"),
    )
    normalized = orders.where("o_orderpriority <> '1-URGENT'").select(key.alias("solution_id"), F.concat(F.lit("om.n."), key).alias("normalized_solution_id"))
    observations = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("artifact_id"), F.col("l_suppkey").cast("string").alias("source_id"))
    return release.solution_rows(artifacts, verifications, normalized, observations, "orders").select(
        "solution_id", "solution_sha256", "puzzle_id", "puzzle_artifact_id", "rights_status", "verified", "cost", "source_count", "normalized_solution_id", "collection_id"
    )


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS puzzle_id, c_name AS display_name, c_mktsegment AS kind, 'customers' AS collection_id,
  CASE WHEN c_custkey % 3 = 0 THEN 'leaderboard_key=' || c_nationkey WHEN c_custkey % 3 = 1 THEN 'game_puzzle_id=C' || c_custkey || ',leaderboard_key=' || c_nationkey
       ELSE 'game_puzzle_id=C' || c_custkey END AS aliases
FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def release_puzzles(spark, sf):
    """Definitions joined with their names; every third customer lacks one of the two other names."""
    customers = table(spark, sf, "customer")
    third = F.col("c_custkey") % 3
    inventory = customers.select(
        F.col("c_custkey").cast("string").alias("puzzle_id"), F.col("c_name").alias("display_name"), F.col("c_mktsegment").alias("kind"),
        F.when(third != 0, F.concat(F.lit("C"), F.col("c_custkey").cast("string"))).alias("game_puzzle_id"),
        F.when(third == 2, "").otherwise(F.col("c_nationkey").cast("string")).alias("leaderboard_key"),
    )
    definitions = customers.where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").cast("string").alias("puzzle_id"))
    rows = release.puzzle_rows(definitions, inventory, "customers")
    named = F.array_join(F.transform("aliases", lambda a: F.concat(a["system"], F.lit("="), a["value"])), ",")
    return rows.select("puzzle_id", "display_name", "kind", "collection_id", named.alias("aliases"))


@query(f"""
WITH {_PUZZLES},
v AS (SELECT sid, aid FROM sol WHERE CAST(sid AS BIGINT) % 10 <> 0 UNION ALL SELECT 'x' || c_custkey, 'a' || c_custkey FROM customer WHERE c_custkey % 50 = 0),
n AS (SELECT sid, CASE WHEN CAST(sid AS BIGINT) % 7 = 0 THEN 'other' ELSE pid END AS pid FROM sol WHERE CAST(sid AS BIGINT) % 11 <> 0
      UNION ALL SELECT 'y' || c_custkey, CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 60 = 0),
o AS (SELECT CAST(c_custkey AS VARCHAR) AS owner, 'a' || c_custkey AS aid FROM customer),
r AS (SELECT s.sid, s.pid, v.sid IS NOT NULL AS has, v.aid, o.owner, n.pid AS npid,
        EXISTS (SELECT 1 FROM art WHERE art.id = s.pid AND art.a = v.aid) AS bound, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = CAST(s.sid AS BIGINT) AND l_suppkey % 9 <> 0) AS seen
      FROM sol s LEFT JOIN v ON v.sid = s.sid LEFT JOIN o ON o.aid = v.aid LEFT JOIN n ON n.sid = s.sid)
SELECT 'verification_missing' AS code, 'no verification' AS detail, sid AS row_key FROM r WHERE NOT has
UNION ALL SELECT 'puzzle_artifact_unknown', aid, sid FROM r WHERE has AND owner IS NULL
UNION ALL SELECT 'puzzle_artifact_other_puzzle', aid, sid FROM r WHERE owner <> pid
UNION ALL SELECT 'puzzle_artifact_unbound', aid, sid FROM r WHERE owner = pid AND NOT bound
UNION ALL SELECT 'normalized_other_puzzle', npid, sid FROM r WHERE npid <> pid
UNION ALL SELECT 'solution_unobserved', 'no source observation', sid FROM r WHERE NOT seen
UNION ALL SELECT 'solution_without_definition', pid, sid FROM r WHERE pid NOT IN (SELECT id FROM puz)
UNION ALL SELECT 'verification_unknown_solution', 'unknown solution', sid FROM v WHERE sid NOT IN (SELECT sid FROM sol)
UNION ALL SELECT 'normalized_unknown_solution', 'unknown solution', sid FROM n WHERE sid NOT IN (SELECT sid FROM sol)""")
def solution_lineage(spark, sf):
    """Every tenth order is not verified, every eleventh not normalized, every seventh normalized for another puzzle; strays on both sides."""
    customers = table(spark, sf, "customer")
    name = F.col("c_custkey").cast("string")
    solutions = table(spark, sf, "orders").where("o_orderstatus <> 'P'").select(
        F.col("o_orderkey"), F.col("o_orderkey").cast("string").alias("artifact_id"), F.col("o_custkey").cast("string").alias("puzzle_id"), _solution_artifact().alias("_aid")
    )
    verifications = solutions.where("o_orderkey % 10 <> 0").select(F.col("artifact_id").alias("solution_id"), F.col("_aid").alias("puzzle_artifact_id")).unionByName(
        customers.where("c_custkey % 50 = 0").select(F.concat(F.lit("x"), name).alias("solution_id"), F.concat(F.lit("a"), name).alias("puzzle_artifact_id"))
    )
    puzzle = F.when(F.col("o_orderkey") % 7 == 0, "other").otherwise(F.col("puzzle_id"))
    normalized = solutions.where("o_orderkey % 11 <> 0").select(F.col("artifact_id").alias("solution_id"), puzzle.alias("puzzle_id")).unionByName(
        customers.where("c_custkey % 60 = 0").select(F.concat(F.lit("y"), name).alias("solution_id"), name.alias("puzzle_id"))
    )
    observations = table(spark, sf, "lineitem").where("l_suppkey % 9 <> 0").select(
        F.col("l_orderkey").cast("string").alias("artifact_id"), F.col("l_suppkey").cast("string").alias("source_id")
    )
    artifacts = customers.select(F.concat(F.lit("a"), name).alias("artifact_id"), name.alias("puzzle_id"))
    found = release.solution_lineage_violations(
        solutions.select("artifact_id", "puzzle_id"), verifications, normalized, observations, _puzzles(spark, sf), artifacts
    )
    return found.select("code", "detail", "row_key")


@query("""
SELECT 'puzzles' AS path, CAST(c_custkey AS VARCHAR) AS row_key, coalesce(c_mktsegment, 'None') AS detail FROM customer WHERE c_mktsegment <> 'MACHINERY'
UNION ALL SELECT 'solutions', CAST(o_orderkey AS VARCHAR), coalesce(CASE WHEN o_orderstatus = 'F' THEN 'MACHINERY' WHEN o_orderstatus = 'O' THEN 'x' END, 'None')
FROM orders WHERE o_orderstatus <> 'F'""")
def collection_ids(spark, sf):
    """Puzzles and solutions that carry another collection's id, or none."""
    puzzles = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("puzzle_id"), F.col("c_mktsegment").alias("collection_id"))
    own = F.when(F.col("o_orderstatus") == "F", "MACHINERY").when(F.col("o_orderstatus") == "O", "x")
    solutions = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("solution_id"), own.alias("collection_id"))
    return release.collection_violations({"puzzles": puzzles, "solutions": solutions}, "MACHINERY").select("path", "row_key", "detail")


@query("""
WITH d AS (SELECT l_suppkey AS p, l_orderkey || ':' || l_linenumber AS i FROM lineitem WHERE l_linenumber = 1 AND l_orderkey % 40 = 0)
SELECT 'definition_outside_collection' AS code, CAST(p AS VARCHAR) AS row_key FROM (SELECT DISTINCT p FROM d) WHERE p NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
UNION ALL SELECT 'definition_missing', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_custkey NOT IN (SELECT p FROM d)
UNION ALL SELECT 'definition_repeated', CAST(p AS VARCHAR) FROM d GROUP BY p HAVING count(*) > 1""")
def definition_coverage(spark, sf):
    """First lines of every fortieth order define the puzzle that their supplier's number names."""
    lines = table(spark, sf, "lineitem").where("l_linenumber = 1 AND l_orderkey % 40 = 0")
    definitions = lines.select(
        F.col("l_suppkey").cast("string").alias("puzzle_id"), _line_key().alias("puzzle_definition_id")
    )
    found = release.definition_coverage_violations(definitions, _puzzles(spark, sf).select("puzzle_id"))
    return found.where("code LIKE 'definition%'").select("code", "row_key")


def known_rows(spark, sf):
    """(puzzle artifacts, solution artifacts, inventory) that events refer to."""
    customers, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    puzzles = customers.select(
        F.col("c_custkey").cast("string").alias("artifact_id"), F.col("c_nationkey").cast("string").alias("puzzle_id"), F.col("c_mktsegment").alias("sha256")
    )
    solutions = orders.where("o_orderstatus = 'F'").select(
        F.col("o_custkey").cast("string").alias("artifact_id"), (F.col("o_custkey") % 25).cast("string").alias("puzzle_id"), F.lit("F").alias("sha256")
    ).distinct()
    inventory = table(spark, sf, "nation").where("n_nationkey <> 3").select(F.col("n_nationkey").cast("string").alias("puzzle_id"))
    return puzzles, solutions, inventory


@query("""
WITH k AS (
  SELECT 'puzzle' AS kind, CAST(c_custkey AS VARCHAR) AS a, CAST(c_nationkey AS VARCHAR) AS p, c_mktsegment AS sha FROM customer
  UNION SELECT 'solution', CAST(o_custkey AS VARCHAR), CAST(o_custkey % 25 AS VARCHAR), 'F' FROM orders WHERE o_orderstatus = 'F'),
e AS (
  SELECT CAST(event_id AS VARCHAR) AS row_key, CASE WHEN event_type = 'purchase' THEN 'solution' ELSE 'puzzle' END AS kind,
    CASE WHEN event_type IN ('purchase', 'signup') THEN CAST(user_id AS VARCHAR) END AS a, CAST(user_id % 25 AS VARCHAR) AS p,
    CASE WHEN event_type = 'purchase' THEN 'F' WHEN event_type = 'signup' THEN 'BUILDING' END AS sha FROM events),
j AS (SELECT e.*, k.a AS found, k.p AS kp, k.sha AS ksha FROM e LEFT JOIN k ON k.kind = e.kind AND k.a = e.a WHERE e.a IS NOT NULL)
SELECT 'observation_unknown_artifact' AS code, a AS detail, row_key FROM j WHERE found IS NULL
UNION ALL SELECT 'observation_other_puzzle', a, row_key FROM j WHERE found IS NOT NULL AND p <> kp
UNION ALL SELECT 'observation_other_bytes', a, row_key FROM j WHERE found IS NOT NULL AND sha <> ksha
UNION ALL SELECT 'observation_outside_collection', p, row_key FROM e WHERE a IS NULL AND p NOT IN (SELECT CAST(n_nationkey AS VARCHAR) FROM nation WHERE n_nationkey <> 3)""")
def observation_references(spark, sf):
    """The kind of an observation decides the table that holds its artifact; those without one name a puzzle."""
    kind = F.col("event_type")
    observations = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("observation_id"), F.when(kind == "purchase", "solution").otherwise("puzzle").alias("artifact_kind"),
        F.when(kind.isin("purchase", "signup"), F.col("user_id").cast("string")).alias("artifact_id"), (F.col("user_id") % 25).cast("string").alias("puzzle_id"),
        F.when(kind == "purchase", "F").when(kind == "signup", "BUILDING").alias("observed_sha256"),
    )
    puzzles, solutions, inventory = known_rows(spark, sf)
    return release.observation_reference_violations(observations, inventory, puzzles, solutions).select("code", "detail", "row_key")
