"""Views, eligibility, attempts, results and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..operators import coverage
from ..operators import eligibility as el
from ..operators import evaluation as ev
from ..operators import views as vw
from .common import query, table


@query("""
WITH s AS (SELECT d.doc_id, l.quality = 1 AS verified, l.toxic = 0 AS vanilla, CASE WHEN d.n_chars > 1000 THEN l.quality = 1 END AS eligible
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT 'all-verified' AS view, doc_id FROM s WHERE verified
UNION ALL SELECT 'vanilla-constructible', doc_id FROM s WHERE verified AND vanilla
UNION ALL SELECT 'record-eligible', doc_id FROM s WHERE verified AND eligible""")
def solution_views(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars").join(table(spark, sf, "labels"), "doc_id", "left")
    rows = docs.select(
        "doc_id", (F.col("quality") == 1).alias("verified"), (F.col("toxic") == 0).alias("vanilla_constructible"),
        F.when(F.col("n_chars") > 1000, F.col("quality") == 1).alias("record_eligible"),
    )
    return vw.solution_views(rows).select("view", "doc_id")


@query("""
WITH a AS (SELECT c.c_custkey, c.c_mktsegment, max(CASE WHEN o.o_orderstatus = 'F' AND o.o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS semantic,
    max(CASE WHEN o.o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 1 ELSE 0 END) AS covered,
    max(CASE WHEN o.o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END) AS ready
  FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY 1, 2)
SELECT c_custkey, CASE WHEN semantic = 0 THEN 'missing_semantic_definition' WHEN covered = 0 THEN 'missing_exact_artifact'
   WHEN ready = 0 THEN 'no_verifier_usable_artifact' WHEN c_mktsegment = 'BUILDING' THEN 'protocol_incompatible' END AS exclusion_reason
FROM a""")
def eligibility(spark, sf):
    """Customers as puzzles: urgent finished orders define them, high and medium orders are their artifacts."""
    flags = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")).alias("semantic"),
        F.max(F.col("o_orderpriority").isin("2-HIGH", "3-MEDIUM")).alias("covered"),
        F.max(F.col("o_orderpriority") == "2-HIGH").alias("ready"),
    )
    rows = table(spark, sf, "customer").join(flags, "c_custkey", "left").na.fill(False, ["semantic", "covered", "ready"])
    kind = F.when(F.col("c_mktsegment") == "BUILDING", "polymer_width").otherwise("normal")
    return rows.select("c_custkey", el.exclusion_reason(F.col("semantic"), F.col("covered"), F.col("ready"), kind).alias("exclusion_reason"))


_OUTCOME_SQL = """CASE WHEN event_type = 'error' THEN 'output_compile_failed' WHEN event_type = 'signup' THEN 'solution_parse_failed'
  WHEN event_type = 'click' THEN 'puzzle_solution_mismatch' WHEN value > 40 THEN 'success' ELSE 'simulation_failed' END"""


def event_attempts(spark, sf):
    """Events as evaluated attempts: the type fails a stage, the value decides the verdict."""
    events = table(spark, sf, "events")
    kind = F.col("event_type")
    verdict = ev.verification_outcome(F.lit("passed"), F.when(F.col("value") > 40, "passed").otherwise("failed"))
    compile_error = F.when(kind == "error", F.lit("not_json"))
    parse_error = F.when(kind == "signup", F.lit("truncated"))
    outcome = ev.attempt_outcome(compile_error, parse_error, kind != "click", verdict)
    reached = kind.isin("view", "purchase")
    cents = F.round(F.col("value") * 100).cast("bigint")
    return events.select(
        "event_id",
        F.lit("b").alias("benchmark_id"),
        kind.alias("run_id"),
        F.col("user_id").cast("string").alias("puzzle_id"),
        F.lit(1).cast("bigint").alias("attempt_index"),
        outcome.alias("outcome"),
        compile_error.alias("compile_error"),
        parse_error.alias("parse_error"),
        F.when(kind != "error", F.sha2(F.col("event_id").cast("string"), 256)).alias("candidate_sha256"),
        F.when(reached, F.concat(F.lit("v"), F.col("event_id").cast("string"))).alias("verification_id"),
        *[cents.alias(m) for m in ev.METRICS],
        F.when(F.col("value") < 5, "collision").alias("error_code"),
        F.lit(1).cast("bigint").alias("model_calls"),
        F.when(F.col("value") > 1, cents).alias("input_tokens"),
        cents.alias("output_tokens"),
    )


@query(f"""
WITH a AS (SELECT event_id, event_type, value, {_OUTCOME_SQL} AS outcome, CAST(round(value * 100) AS BIGINT) AS cents FROM events)
SELECT event_id, outcome, CASE WHEN outcome = 'success' THEN cents END AS cost,
  CASE WHEN outcome <> 'success' THEN CASE WHEN event_type = 'error' THEN 'not_json'
       WHEN event_type IN ('view', 'purchase') AND value < 5 THEN 'collision' ELSE outcome END END AS error_code,
  CAST(CASE WHEN event_type IN ('view', 'purchase') THEN 1 ELSE 0 END AS BIGINT) AS verifier_calls
FROM a""")
def outcome_case(spark, sf):
    rows = event_attempts(spark, sf)
    attempts = ev.project_attempts(rows.withColumn("benchmark_id", F.col("event_id").cast("string")))
    return attempts.select(
        F.col("benchmark_id").cast("bigint").alias("event_id"), "outcome", "cost", "error_code", "verifier_calls"
    )


@query("""
WITH r AS (SELECT event_id, event_type, value FROM events)
SELECT 'outcome is unknown' AS detail, CAST(event_id AS VARCHAR) AS row_key FROM r WHERE event_type = 'signup' AND value > 100
UNION ALL SELECT 'candidate hash must be present exactly after compilation', CAST(event_id AS VARCHAR) FROM r WHERE event_type = 'error' AND value > 30
UNION ALL SELECT 'verifier lineage does not fit the outcome', CAST(event_id AS VARCHAR) FROM r WHERE event_type = 'click' OR (event_type = 'signup' AND value > 100)
UNION ALL SELECT 'metrics must be present exactly on success', CAST(event_id AS VARCHAR) FROM r WHERE event_type = 'purchase' AND value < 20
UNION ALL SELECT 'success carries an error code', CAST(event_id AS VARCHAR) FROM r WHERE event_type = 'purchase' AND value > 90""")
def attempt_invariants(spark, sf):
    """Forged attempts: each event type breaks one rule beyond some value."""
    kind, value = F.col("event_type"), F.col("value")
    success = kind == "purchase"
    outcome = (
        F.when(success, "success").when(kind == "error", "output_compile_failed").when(kind == "click", "puzzle_solution_mismatch")
        .when((kind == "signup") & (value > 100), "won").when(kind == "signup", "solution_parse_failed").otherwise("simulation_failed")
    )
    called = kind.isin("purchase", "view", "click")
    nothing = F.lit(None).cast("bigint")
    metric = F.when(success & (value >= 20), F.lit(3)).cast("bigint")
    rows = table(spark, sf, "events").select(
        "event_id", outcome.alias("outcome"), F.lit(1).alias("attempt_index"),
        F.when((kind != "error") | (value > 30), "c").alias("candidate_sha256"),
        F.when(called, "v").alias("verification_id"), called.cast("bigint").alias("verifier_calls"),
        *[metric.alias(m) for m in ev.METRICS], F.when(success & (value > 90), "x").alias("error_code"),
        *[nothing.alias(c) for c in ev.COUNTERS],
    )
    return ev.attempt_violations(rows, "event_id").select("detail", "row_key")


def conversation_attempts(spark, sf):
    """Conversations as attempt series; a long enough assistant turn is a success."""
    solved = (F.col("role") == "assistant") & (F.length("text") > 400)
    return table(spark, sf, "conversations").select(
        F.lit("r").alias("run_id"), F.col("conv_id").alias("puzzle_id"), (F.col("turn") + 1).alias("attempt_index"),
        F.when(solved, "success").otherwise("simulation_failed").alias("outcome"), F.col("role"),
    )


_SERIES_SQL = """WITH a AS (SELECT conv_id AS puzzle_id, turn + 1 AS idx, role = 'assistant' AND length(text) > 400 AS ok FROM conversations),
 s AS (SELECT puzzle_id, count(*) AS attempt_count, count(DISTINCT idx) AS d, min(idx) AS lo, max(idx) AS hi, min(CASE WHEN ok THEN idx END) AS first FROM a GROUP BY 1)"""


@query(f"""{_SERIES_SQL}
SELECT puzzle_id, attempt_count, first IS NOT NULL AS solved, first AS first_success_attempt,
  lo = 1 AND hi = attempt_count AND d = attempt_count AS contiguous, coalesce(first < hi, false) AS attempts_after_success FROM s""")
def attempt_rollup(spark, sf):
    return ev.attempt_series(conversation_attempts(spark, sf)).drop("run_id")


@query(f"""{_SERIES_SQL}
SELECT a.puzzle_id, a.idx AS attempt_index, CASE WHEN a.ok THEN 'success' ELSE 'simulation_failed' END AS outcome
FROM a LEFT JOIN (SELECT puzzle_id, min(idx) AS f FROM a WHERE ok AND idx <= 5 GROUP BY 1) s ON a.puzzle_id = s.puzzle_id
WHERE a.idx <= 5 AND (s.f IS NULL OR a.idx <= s.f)""")
def effective_attempts(spark, sf):
    return ev.effective_attempts(conversation_attempts(spark, sf), 5).select("puzzle_id", "attempt_index", "outcome")


@query(f"""
WITH a AS (SELECT event_type AS run_id, user_id, {_OUTCOME_SQL} AS outcome, CAST(round(value * 100) AS BIGINT) AS cents, value,
   CASE WHEN event_type IN ('view', 'purchase') THEN 1 ELSE 0 END AS calls FROM events),
 p AS (SELECT run_id, user_id, max(CASE WHEN outcome = 'success' THEN 1 ELSE 0 END) AS solved FROM a GROUP BY 1, 2),
 q AS (SELECT run_id, count(*) AS puzzle_count, CAST(sum(solved) AS BIGINT) AS solved_count FROM p GROUP BY 1)
SELECT a.run_id, max(q.puzzle_count) AS puzzle_count, max(q.solved_count) AS solved_count, max(q.puzzle_count - q.solved_count) AS unsolved_count,
  max(q.solved_count) AS solve_rate_numerator, max(q.puzzle_count) AS solve_rate_denominator, count(*) AS attempt_count,
  {', '.join(f"count(CASE WHEN outcome = '{o}' THEN 1 END) AS {o}" for o in fixed.OUTCOMES)},
  CAST(sum(calls) AS BIGINT) AS verifier_calls, count(*) AS model_calls,
  CASE WHEN bool_and(value > 1) THEN CAST(sum(cents) AS BIGINT) END AS input_tokens, CAST(sum(cents) AS BIGINT) AS output_tokens
FROM a JOIN q ON a.run_id = q.run_id GROUP BY a.run_id""")
def run_report(spark, sf):
    return ev.run_report(ev.project_attempts(event_attempts(spark, sf)))


@query("""
WITH m AS (SELECT o_custkey, o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cost, datediff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS cycles
           FROM orders WHERE o_orderstatus = 'F')
SELECT o_custkey, 'cost' AS metric, cost AS best, o_orderkey AS holder FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY cost, o_orderkey) AS k FROM m) WHERE k = 1
UNION ALL
SELECT o_custkey, 'cycles', cycles, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY cycles, o_orderkey) AS k FROM m) WHERE k = 1""")
def best_known(spark, sf):
    return vw.best_known(order_metrics(spark, sf), "o_custkey", ["cost", "cycles"], "o_orderkey")


def order_metrics(spark, sf):
    """Finished orders as verified solutions with integer metrics."""
    return table(spark, sf, "orders").where("o_orderstatus = 'F'").select(
        "o_custkey", "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cost"),
        F.datediff(F.col("o_orderdate").cast("date"), F.lit("1990-01-01").cast("date")).cast("bigint").alias("cycles"),
    )


@query("""
WITH m AS (SELECT o_custkey, o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cost FROM orders WHERE o_orderstatus = 'F')
SELECT o_custkey, o_orderkey, cost AS numerator, min(cost) OVER (PARTITION BY o_custkey) AS denominator,
  cost - min(cost) OVER (PARTITION BY o_custkey) AS regret FROM m""")
def regret(spark, sf):
    return vw.regret(order_metrics(spark, sf), "o_custkey", "cost", "o_orderkey")


@query("""
WITH m AS (SELECT o_custkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cost, CAST(datediff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS cycles
           FROM orders WHERE o_orderstatus = 'F')
SELECT a.o_custkey, a.cycles, a.cost, count(*) AS rows FROM m a WHERE NOT EXISTS (
  SELECT 1 FROM m b WHERE b.o_custkey = a.o_custkey AND b.cost <= a.cost AND b.cycles <= a.cycles AND (b.cost < a.cost OR b.cycles < a.cycles))
GROUP BY 1, 2, 3""")
def pareto_frontier(spark, sf):
    return vw.pareto_pair(order_metrics(spark, sf), "o_custkey", "cycles", "cost")


def _not_dominated(group: str, metrics: list[str]) -> str:
    at_most = " AND ".join(f"b.{m} <= a.{m}" for m in metrics)
    less = " OR ".join(f"b.{m} < a.{m}" for m in metrics)
    names = ", ".join(metrics)
    return f"""
WITH m AS (
  SELECT {group}, CAST(round(l_extendedprice * 100) AS BIGINT) AS cost, CAST(l_quantity AS BIGINT) AS area, 100 - CAST(round(l_discount * 100) AS BIGINT) AS effort,
    CAST(epoch(l_shipdate) AS BIGINT) // 86400 AS cycles FROM lineitem),
t AS (SELECT {group}, {names}, count(*) AS rows FROM m GROUP BY ALL)
SELECT * FROM t a WHERE NOT EXISTS (SELECT 1 FROM t b WHERE a.{group} = b.{group} AND {at_most} AND ({less}))"""


def _line_metrics(spark, sf):
    cents = lambda c: F.round(F.col(c) * 100).cast("bigint")
    return table(spark, sf, "lineitem").select(
        "l_suppkey", "l_returnflag", cents("l_extendedprice").alias("cost"), F.col("l_quantity").cast("bigint").alias("area"),
        (F.lit(100) - cents("l_discount")).cast("bigint").alias("effort"),
        F.floor(F.col("l_shipdate").cast("timestamp").cast("bigint") / 86400).alias("cycles"),
    )


@query(_not_dominated("l_returnflag", ["cost", "effort", "cycles"]))
def pareto_frontier_three_metrics(spark, sf):
    """Three groups that hold all line items."""
    return vw.pareto_frontier(_line_metrics(spark, sf), "l_returnflag", ["cost", "effort", "cycles"])


@query(_not_dominated("l_suppkey", ["cost", "area", "effort", "cycles"]))
def pareto_frontier_four_metrics(spark, sf):
    return vw.pareto_frontier(_line_metrics(spark, sf), "l_suppkey", ["cost", "area", "effort", "cycles"])


@query("""
WITH m AS (SELECT o_custkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cost FROM orders WHERE o_orderstatus = 'F')
SELECT o_custkey, CAST(0.5 AS DOUBLE) AS quantile, quantile_disc(cost, 0.5) AS value FROM m GROUP BY o_custkey
UNION ALL SELECT o_custkey, CAST(0.25 AS DOUBLE), quantile_disc(cost, 0.25) FROM m GROUP BY o_custkey""")
def metric_distribution(spark, sf):
    return vw.metric_quantiles(order_metrics(spark, sf), "o_custkey", "cost", [0.25, 0.5])


@query("""
WITH a AS (SELECT conv_id, turn + 1 AS idx, role = 'assistant' AND length(text) > 400 AS ok,
    CASE WHEN role <> 'system' THEN length(text) END AS tokens FROM conversations),
 f AS (SELECT conv_id, min(idx) AS first FROM a WHERE ok GROUP BY 1)
SELECT a.conv_id AS puzzle_id, count(*) AS attempts,
  CASE WHEN count(tokens) = count(*) THEN CAST(sum(tokens) AS BIGINT) END AS input_tokens
FROM a JOIN f ON a.conv_id = f.conv_id WHERE a.idx <= f.first GROUP BY 1""")
def resources_to_success(spark, sf):
    """Text lengths of conversation turns as token counts; system turns report none."""
    lengths = table(spark, sf, "conversations").select(
        F.col("conv_id").alias("puzzle_id"), (F.col("turn") + 1).alias("attempt_index"), "role",
        F.length("text").cast("bigint").alias("size"),
    )
    attempts = lengths.select(
        F.lit("r").alias("run_id"), "puzzle_id", "attempt_index",
        F.when((F.col("role") == "assistant") & (F.col("size") > 400), "success").otherwise("simulation_failed").alias("outcome"),
        F.lit(1).alias("model_calls"), F.when(F.col("role") != "system", F.col("size")).alias("input_tokens"),
        F.col("size").alias("output_tokens"),
    )
    return ev.resources_to_success(attempts).select("puzzle_id", "attempts", "input_tokens")


@query("""
WITH m AS (SELECT o_custkey, o_orderpriority, o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cost FROM orders WHERE o_orderstatus = 'F')
SELECT o_custkey, o_orderpriority, cost, o_orderkey FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, cost, o_orderkey) AS k FROM m) WHERE k = 1""")
def one_per_puzzle(spark, sf):
    rows = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(
        "o_custkey", "o_orderpriority", "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cost")
    )
    return vw.one_per_group(rows, "o_custkey", ["o_orderpriority", "cost", "o_orderkey"])


@query(f"""{_SERIES_SQL}
SELECT 'r' AS run_id, count(*) AS puzzles, count(CASE WHEN first <= 1 THEN 1 END) AS solved_at_1, count(CASE WHEN first <= 4 THEN 1 END) AS solved_at_4,
  CAST(quantile_cont(first, 0.5) AS DOUBLE) AS median_attempts FROM s""")
def solve_at_k(spark, sf):
    return ev.solve_at_k(ev.attempt_series(conversation_attempts(spark, sf)), ("run_id",), 4)


@query(f"""
WITH a AS (SELECT event_type AS run_id, user_id, {_OUTCOME_SQL} AS outcome FROM events),
 p AS (SELECT run_id, user_id, max(CASE WHEN outcome = 'success' THEN 1 ELSE 0 END) AS solved, count(*) AS n FROM a GROUP BY 1, 2),
 q AS (SELECT run_id, CAST(sum(solved) AS BIGINT) AS solved_count, CAST(sum(n) AS BIGINT) AS attempt_count FROM p GROUP BY 1)
SELECT run_id, solved_count, attempt_count, CAST(dense_rank() OVER (ORDER BY solved_count DESC, attempt_count, run_id) AS INT) AS rank FROM q""")
def leaderboard(spark, sf):
    report = ev.run_report(ev.project_attempts(event_attempts(spark, sf)))
    ranked = ev.leaderboard(report, [-F.col("solved_count"), F.col("attempt_count"), F.col("run_id")])
    return ranked.select("run_id", "solved_count", "attempt_count", "rank")


@query("""
WITH a AS (SELECT o_custkey AS k, string_agg(DISTINCT CAST(o_orderkey AS VARCHAR), ',' ORDER BY CAST(o_orderkey AS VARCHAR)) AS ids,
             count(DISTINCT o_orderkey) AS n FROM orders GROUP BY 1),
     e AS (SELECT o_custkey AS k, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS src FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
     s AS (SELECT user_id AS k, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS src FROM events GROUP BY 1)
SELECT CAST(c_custkey AS VARCHAR) AS puzzle_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'd' || c_custkey END AS puzzle_definition_id,
  coalesce(a.ids, '') AS artifact_ids, coalesce(e.src, '') AS exact_source_ids, coalesce(s.src, '') AS semantic_source_ids,
  c_mktsegment = 'BUILDING' AS semantic_covered, coalesce(a.n, 0) > 0 AS artifact_covered, coalesce(a.n, 0) = 1 AS verifier_ready
FROM customer LEFT JOIN a ON a.k = c_custkey LEFT JOIN e ON e.k = c_custkey LEFT JOIN s ON s.k = c_custkey""")
def puzzle_coverage(spark, sf):
    """Customers as puzzles, orders as artifacts seen by their priority, events as semantic sources."""
    customers, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    key = F.col("o_custkey").cast("string").alias("puzzle_id")
    inventory = customers.select(F.col("c_custkey").cast("string").alias("puzzle_id"))
    artifacts = orders.select(key, F.col("o_orderkey").cast("string").alias("artifact_id"))
    seen = orders.select(
        key, F.when(F.col("o_orderstatus") == "F", "artifact").otherwise("metadata").alias("source_role"), F.col("o_orderpriority").alias("source_id")
    )
    definitions = customers.where("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").cast("string").alias("puzzle_id"), F.concat(F.lit("d"), F.col("c_custkey").cast("string")).alias("puzzle_definition_id")
    )
    semantic = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("puzzle_id"), F.col("event_type").alias("source_id"))
    rows = coverage.puzzle_coverage(inventory, artifacts, seen, definitions, semantic)
    lists = {c: F.array_join(c, ",") for c in ("artifact_ids", "exact_source_ids", "semantic_source_ids")}
    return rows.withColumns(lists)


@query("""
WITH src AS (SELECT DISTINCT l_partkey AS p, l_suppkey AS s,
    CASE l_returnflag WHEN 'A' THEN 'official-game' WHEN 'N' THEN 'omsim' ELSE 'archive' END AS source FROM lineitem WHERE l_linestatus = 'F'),
 art AS (SELECT DISTINCT l_partkey AS p, l_suppkey AS s FROM lineitem),
 cand AS (SELECT src.p, src.s, CAST(src.p AS VARCHAR) || '-' || CAST(src.s AS VARCHAR) AS id,
    CASE source WHEN 'official-game' THEN 0 WHEN 'omsim' THEN 1 ELSE 2 END AS rank FROM src WHERE src.s % 5 <> 0),
 best AS (SELECT p, id, s FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY rank, id) AS r FROM cand) WHERE r = 1),
 names AS (SELECT p, s, string_agg(source, ',' ORDER BY source) AS sources FROM src GROUP BY 1, 2),
 j AS (SELECT part.p_partkey, p_size, best.id, best.s, names.sources, p_size % 3 <> 0 AS semantic, art.p IS NOT NULL AS covered
   FROM part LEFT JOIN best ON best.p = p_partkey LEFT JOIN names ON names.p = best.p AND names.s = best.s
   LEFT JOIN (SELECT DISTINCT p FROM art) art ON art.p = p_partkey)
SELECT CAST(p_partkey AS VARCHAR) AS puzzle_id, semantic AS semantic_covered, covered AS artifact_covered, id IS NOT NULL AS verifier_ready,
  CASE WHEN NOT semantic THEN 'missing_semantic_definition' WHEN NOT covered THEN 'missing_exact_artifact'
       WHEN id IS NULL THEN 'no_verifier_usable_artifact' WHEN p_size % 2 = 0 THEN 'protocol_incompatible' END AS exclusion_reason,
  id AS selected_puzzle_artifact_id, s AS selected_puzzle_artifact_byte_length, coalesce(sources, '') AS selected_source_ids
FROM j""")
def eligibility_rows(spark, sf):
    """Parts as puzzles, their part-supplier pairs as artifacts, line items as observations of them."""
    parts, lines = table(spark, sf, "part"), table(spark, sf, "lineitem")
    puzzle = F.col("l_partkey").cast("string")
    artifact = F.concat_ws("-", puzzle, F.col("l_suppkey").cast("string"))
    inventory = parts.select(
        F.col("p_partkey").cast("string").alias("puzzle_id"), F.when(F.col("p_size") % 2 == 0, "polymer_width").otherwise("normal").alias("puzzle_type")
    )
    definitions = parts.where("p_size % 3 <> 0").select(
        F.col("p_partkey").cast("string").alias("puzzle_id"), F.concat(F.lit("d"), F.col("p_partkey").cast("string")).alias("puzzle_definition_id")
    )
    artifacts = lines.select("l_partkey", "l_suppkey").distinct().select(
        artifact.alias("artifact_id"), puzzle.alias("puzzle_id"),
        F.when(F.col("l_suppkey") % 5 != 0, "puzzle").otherwise("solution").alias("artifact_format"), F.sha2(artifact, 256).alias("sha256"),
        F.col("l_suppkey").alias("byte_length"), F.lit("k").alias("object_key"), F.lit("unknown").alias("rights_status"),
    )
    flag = F.col("l_returnflag")
    seen = lines.select(
        artifact.alias("artifact_id"), F.when(F.col("l_linestatus") == "F", "artifact").otherwise("metadata").alias("source_role"),
        F.when(flag == "A", "official-game").when(flag == "N", "omsim").otherwise("archive").alias("source_id"),
    )
    rows = el.derive_eligibility(inventory, definitions, artifacts, seen)
    return rows.select(
        "puzzle_id", "semantic_covered", "artifact_covered", "verifier_ready", "exclusion_reason", "selected_puzzle_artifact_id",
        "selected_puzzle_artifact_byte_length", F.array_join("selected_source_ids", ",").alias("selected_source_ids"),
    )


@query("""
WITH o AS (SELECT l_orderkey AS k, bool_or(l_returnflag <> 'R') AS human, bool_or(l_returnflag = 'R') AS made FROM lineitem GROUP BY 1)
SELECT 'human-observed' AS view, o_orderkey AS solution_id, o_orderstatus FROM orders JOIN o ON k = o_orderkey WHERE human
UNION ALL SELECT 'generated-baseline', o_orderkey, o_orderstatus FROM orders JOIN o ON k = o_orderkey WHERE made""")
def origin_views(spark, sf):
    """Orders as solutions, their line items as observations; returned ones come from a generator."""
    solutions = table(spark, sf, "orders").select(F.col("o_orderkey").alias("solution_id"), "o_orderstatus")
    seen = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("artifact_id"), F.col("l_returnflag").alias("source_id"))
    return vw.origin_views(solutions, seen, ["R"])
