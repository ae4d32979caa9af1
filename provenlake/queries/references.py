"""Joins, references, coverage and set reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks, coverage, pairing, reconcile, release, verify
from ..operators.ordering import number_in_buckets, sequence_violations
from .common import query, table


@query(r"""
WITH p AS (SELECT page_id, rtrim(regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1), '/') AS path FROM pages),
     l AS (SELECT DISTINCT lang FROM documents)
SELECT p.page_id, p.path, 'lang-' || l.lang AS puzzle_id
FROM p JOIN l ON regexp_extract(p.path, '^(.*)/[^/]*$', 1) = l.lang WHERE p.path LIKE '%.html'""")
def layout_join(spark, sf):
    """Pages as landed files below one directory per language; ``.html`` files are wanted."""
    path = pairing.posix(F.regexp_extract("url", r"^https?://[^/]+/([^?#]*)", 1))
    files = table(spark, sf, "pages").select("page_id", path.alias("path"))
    layout = table(spark, sf, "documents").select(
        F.col("lang").alias("directory"), F.concat(F.lit("lang-"), "lang").alias("puzzle_id")
    ).distinct()
    return pairing.mapped_receipts(files, layout, ".html", "path").select("page_id", "path", "puzzle_id")


@query(r"""
WITH p AS (SELECT url, rtrim(regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1), '/') AS path FROM pages)
SELECT regexp_extract(url, '^(https?)', 1) AS source_id, count(*) AS candidate_count, count(DISTINCT regexp_extract(path, '^(.*)/[^/]*$', 1)) AS puzzles_covered
FROM p WHERE path LIKE '%.html' AND regexp_extract(path, '^(.*)/[^/]*$', 1) IN (SELECT lang FROM documents) GROUP BY 1""")
def landing_counts(spark, sf):
    path = pairing.posix(F.regexp_extract("url", r"^https?://[^/]+/([^?#]*)", 1))
    files = table(spark, sf, "pages").select(F.regexp_extract("url", "^(https?)", 1).alias("source_id"), path.alias("path"))
    layout = table(spark, sf, "documents").select(F.col("lang").alias("directory"), F.col("lang").alias("puzzle_id")).distinct()
    return pairing.landing_counts(pairing.mapped_receipts(files, layout, ".html", "path"))


_PAIR_SQL = """
WITH m AS (
  SELECT o_orderkey, 'n' || (o_orderkey % 25) AS puzzle_id,
    CASE o_orderstatus WHEN 'F' THEN 'c' || o_custkey || '.solution'
                       WHEN 'O' THEN 'n' || (o_custkey % 25) || '/c' || o_custkey || '.solution' END AS data_path
  FROM orders),
 s AS (SELECT 'n' || c_nationkey || '/c' || c_custkey || '.solution' AS path, 'n' || c_nationkey AS puzzle_id, c_custkey FROM customer),
 d AS (SELECT DISTINCT 'n' || n_nationkey AS dir FROM nation),
 j AS (
  SELECT m.*, regexp_extract(m.data_path, '^(.*)/[^/]*$', 1) AS pdir, m.puzzle_id || '/' || m.data_path AS rel,
         a.puzzle_id AS root_puzzle, a.c_custkey AS root_cust, b.puzzle_id AS own_puzzle, b.c_custkey AS own_cust
  FROM m LEFT JOIN s a ON a.path = m.data_path LEFT JOIN s b ON b.path = m.puzzle_id || '/' || m.data_path),
 k AS (SELECT j.*, d.dir AS declared FROM j LEFT JOIN d ON d.dir = j.pdir),
 e AS (SELECT *, CASE WHEN declared <> puzzle_id THEN 'data_path_other_puzzle'
                      WHEN root_cust IS NOT NULL AND own_cust IS NOT NULL THEN 'data_path_ambiguous'
                      WHEN coalesce(root_puzzle, own_puzzle) <> puzzle_id THEN 'data_path_other_puzzle' END AS pair_error FROM k)
SELECT o_orderkey,
  CASE WHEN data_path IS NULL THEN NULL WHEN root_cust IS NOT NULL THEN data_path WHEN own_cust IS NOT NULL THEN rel
       WHEN declared IS NOT NULL THEN data_path ELSE rel END AS resolved_path,
  pair_error, CASE WHEN pair_error IS NULL THEN coalesce(root_cust, own_cust) END AS c_custkey
FROM e"""


@query(_PAIR_SQL)
def path_pairing(spark, sf):
    """Orders as metadata naming a customer's file, relative to their own directory or from the root."""
    orders = table(spark, sf, "orders")
    home = F.concat(F.lit("n"), (F.col("o_orderkey") % 25).cast("string"))
    file = F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit(".solution"))
    data_path = F.when(F.col("o_orderstatus") == "F", file).when(
        F.col("o_orderstatus") == "O", F.concat(F.lit("n"), (F.col("o_custkey") % 25).cast("string"), F.lit("/"), file)
    )
    metadata = orders.select(
        "o_orderkey", home.alias("puzzle_id"), data_path.alias("data_path"),
        F.concat(home, F.lit("/o"), F.col("o_orderkey").cast("string"), F.lit(".json")).alias("metadata_path"),
    )
    nation = F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))
    solutions = table(spark, sf, "customer").select(
        F.concat(nation, F.lit("/c"), F.col("c_custkey").cast("string"), F.lit(".solution")).alias("solution_path"),
        nation.alias("solution_puzzle_id"), "c_custkey",
    )
    directory = F.concat(F.lit("n"), F.col("n_nationkey").cast("string"))
    layout = table(spark, sf, "nation").select(directory.alias("directory"), directory.alias("puzzle_id"))
    paired = pairing.pair_by_path(metadata, solutions, layout)
    return paired.select("o_orderkey", "resolved_path", "pair_error", "c_custkey")


@query("""
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS claimed_cost,
       CASE WHEN event_type = 'error' THEN 'invalid_metric' WHEN event_type = 'view' THEN 'invalid_link' END AS error,
       CASE WHEN event_type = 'click' THEN 'https://x/' || event_id WHEN event_type = 'signup' THEN 'https://y/' || user_id
            WHEN event_type = 'view' THEN '' END AS source_url
FROM events""")
def claims_from_json(spark, sf):
    """Events as metadata documents; errors carry a boolean metric and views an empty link."""
    events = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    link = F.when(F.col("event_type") == "click", F.concat(F.lit(',"dataLink":"https://x/'), F.col("event_id").cast("string"), F.lit('"')))
    link = link.when(F.col("event_type") == "view", F.lit(',"dataLink":""'))
    link = link.when(F.col("event_type") == "signup", F.concat(F.lit(',"dataLink":null,"displayLink":"https://y/'), F.col("user_id").cast("string"), F.lit('"')))
    extra = F.when(F.col("event_type") == "error", F.lit(',"cycles":true')).otherwise(F.lit(',"cycles":null'))
    document = F.concat(F.lit('{"score":{"cost":'), k, extra, F.lit("}"), F.coalesce(link, F.lit("")), F.lit("}"))
    read = pairing.read_metadata(events.select("event_id", document.alias("document")), "document")
    return read.select("event_id", "claimed_cost", "error", "source_url")


@query("""
SELECT 'order' AS label, CAST(l_orderkey AS VARCHAR) || '/' || l_linenumber || '/' || l_partkey AS row_key FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus <> 'P' AND o.o_orderkey = l.l_orderkey)
UNION ALL
SELECT 'part', CAST(l_orderkey AS VARCHAR) || '/' || l_linenumber || '/' || l_partkey FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_type <> 'ECONOMY' AND p.p_partkey = l.l_partkey)
UNION ALL
SELECT 'customer', CAST(o_orderkey AS VARCHAR) FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_mktsegment <> 'BUILDING' AND c.c_custkey = o.o_custkey)
UNION ALL
SELECT 'document', CAST(doc_id AS VARCHAR) FROM labels l
WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.source <> 'src0' AND d.doc_id = l.doc_id)""")
def referential_integrity(spark, sf):
    """Published parents only: pending orders, one part type, one segment and one source are unpublished."""
    orders, parts = table(spark, sf, "orders"), table(spark, sf, "part")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey",
        F.concat_ws("/", *[F.col(x).cast("string") for x in ("l_orderkey", "l_linenumber", "l_partkey")]).alias("line"),
    )
    customers = table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'")
    docs = table(spark, sf, "documents").where("source <> 'src0'")
    rules = [
        ("order", lines, "l_orderkey", orders.where("o_orderstatus <> 'P'"), "o_orderkey", "line"),
        ("part", lines, "l_partkey", parts.where("p_type <> 'ECONOMY'"), "p_partkey", "line"),
        ("customer", orders, "o_custkey", customers, "c_custkey", "o_orderkey"),
        ("document", table(spark, sf, "labels"), "doc_id", docs, "doc_id", "doc_id"),
    ]
    return checks.union_all(
        [
            checks.reference_violations(child, key, parent, parent_key, label, label, row_key).select(
                F.col("path").alias("label"), "row_key"
            )
            for label, child, key, parent, parent_key, row_key in rules
        ]
    )


@query("""
WITH k AS (SELECT 'purchase' AS kind, o_custkey AS id, 'F' AS fact FROM orders WHERE o_orderstatus = 'F'
           UNION SELECT 'signup', c_custkey, c_mktsegment FROM customer)
SELECT e.event_id, CASE WHEN k.id IS NULL THEN 'unknown' ELSE 'other_fact' END AS problem
FROM events e LEFT JOIN k ON k.kind = e.event_type AND k.id = e.user_id
WHERE e.event_type IN ('purchase', 'signup')
  AND (k.id IS NULL OR (e.event_type = 'signup' AND k.fact <> 'BUILDING'))""")
def conditional_reference(spark, sf):
    """The event type decides the referenced table; other event types are exempt."""
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    known = (
        orders.where("o_orderstatus = 'F'").select(
            F.lit("purchase").alias("event_type"), F.col("o_custkey").alias("user_id"), F.lit("F").alias("fact")
        ).distinct()
        .unionByName(
            customers.select(F.lit("signup").alias("event_type"), F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("fact"))
        )
    )
    events = table(spark, sf, "events").where(F.col("event_type").isin("purchase", "signup"))
    joined = events.join(known, ["event_type", "user_id"], "left")
    problem = F.when(F.col("fact").isNull(), "unknown").when(
        (F.col("event_type") == "signup") & (F.col("fact") != "BUILDING"), "other_fact"
    )
    return joined.select("event_id", problem.alias("problem")).where("problem IS NOT NULL")


@query("""
WITH n AS (SELECT l_orderkey AS k, max(l_linenumber) AS m FROM lineitem GROUP BY 1),
     w AS (SELECT k, unnest(generate_series(1, m)) AS line FROM n)
SELECT 'definition_observation_missing' AS code, k || ':' || line AS detail, CAST(k AS VARCHAR) AS row_key FROM w
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = w.k AND l.l_linenumber = w.line)
UNION ALL SELECT 'definition_observation_other_puzzle', k || ':' || line, CAST(k AS VARCHAR)
FROM w JOIN lineitem l ON l.l_orderkey = w.k AND l.l_linenumber = w.line WHERE l.l_suppkey % 50 = 0
UNION ALL SELECT 'artifact_unbound', CAST(o_orderkey AS VARCHAR), 'a' || o_orderkey FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT 'artifact_unobserved', 'no observation', 'a' || o_orderkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o_orderkey AND l.l_linestatus = 'F')""")
def array_reference(spark, sf):
    """Orders declare their lines 1..max and, when finished, an artifact; line items are the observations."""
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    order = F.col("l_orderkey").cast("string")
    declared = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_linenumber").alias("m"))
    key = F.col("o_orderkey").cast("string")
    artifact = F.concat(F.lit("a"), key)
    none = F.array().cast("array<string>")
    definitions = orders.select("o_orderkey", "o_orderstatus").join(declared, "o_orderkey", "full").select(
        key.alias("puzzle_id"),
        F.when(F.col("m").isNull(), none).otherwise(
            F.transform(F.sequence(F.lit(1), F.col("m")), lambda i: F.concat_ws(":", key, i.cast("string")))
        ).alias("source_observation_ids"),
        F.when(F.col("o_orderstatus") == "F", F.array(artifact)).otherwise(none).alias("puzzle_artifact_ids"),
    )
    observations = lines.select(
        F.concat_ws(":", order, F.col("l_linenumber").cast("string")).alias("observation_id"),
        F.when(F.col("l_suppkey") % 50 == 0, "other").otherwise(order).alias("puzzle_id"),
        F.when(F.col("l_linestatus") == "F", F.concat(F.lit("a"), order)).alias("artifact_id"),
    )
    artifacts = orders.select(artifact.alias("artifact_id"), key.alias("puzzle_id"))
    return release.provenance_violations(definitions, observations, artifacts).select("code", "detail", "row_key")


@query("""
SELECT d.doc_id, d.lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def unobserved_artifacts(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return checks.missing_references(docs, "doc_id", table(spark, sf, "labels"), "doc_id")


@query("""
SELECT d.doc_id, d.source FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)""")
def parseable_semi(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("artifact_id"), "source")
    verdicts = table(spark, sf, "labels").select(
        F.col("doc_id").alias("solution_id"), F.when(F.col("quality") == 1, "passed").otherwise("failed").alias("parse_status")
    )
    return verify.parsed_only(docs, verdicts).select(F.col("artifact_id").alias("doc_id"), "source")


@query("""
WITH p AS (SELECT o_custkey, o_orderpriority, count(*) AS n, min(o_orderkey) AS k FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)
SELECT o.o_orderkey, CAST(least(coalesce(p.n, 0), 2) AS INT) AS matches, CASE WHEN p.n = 1 THEN p.k END AS puzzle_artifact
FROM orders o LEFT JOIN p ON p.o_custkey = o.o_custkey AND p.o_orderpriority = o.o_orderpriority WHERE o.o_orderstatus <> 'F'""")
def exactly_one_pairing(spark, sf):
    orders = table(spark, sf, "orders").withColumn("key", F.concat_ws("|", F.col("o_custkey").cast("string"), "o_orderpriority"))
    solutions = orders.where("o_orderstatus <> 'F'").select("o_orderkey", "key")
    puzzles = orders.where("o_orderstatus = 'F'").select("key", F.col("o_orderkey").alias("puzzle_artifact"))
    return verify.pair_exactly_one(solutions, puzzles, "key", ["puzzle_artifact"]).select("o_orderkey", "matches", "puzzle_artifact")


_ROLLUP_VALUES = [("small", 0), ("red", 0), ("hot", 0), ("small_ring", 0), ("blue", 0)]


@query("""
WITH r(rollup) AS (VALUES ('small'), ('red'), ('hot'), ('small_ring'), ('blue')),
 p AS (SELECT p_partkey, replace(p_name, ' ', '-') AS g FROM part),
 m AS (SELECT p.p_partkey, count(r.rollup) AS n FROM p LEFT JOIN r
       ON p.g = replace(r.rollup, '_', '-') OR starts_with(p.g, replace(r.rollup, '_', '-') || '-') GROUP BY 1)
SELECT CASE WHEN n = 0 THEN 'group_rollup_unmatched' ELSE 'group_rollup_overlap' END AS code, CAST(p_partkey AS VARCHAR) AS row_key
FROM m WHERE n <> 1""")
def prefix_rollup(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit("-")).alias("group"))
    rollups = spark.createDataFrame(_ROLLUP_VALUES, "rollup string, declared bigint")
    _, violations = coverage.rollup_counts(parts, "p_partkey", "group", rollups, "rollup", "declared")
    return violations.where("path = 'inventory'").select("code", "row_key")


@query("""
WITH r(rollup) AS (VALUES ('small'), ('red'), ('hot'), ('small_ring'), ('blue')),
 p AS (SELECT p_partkey, replace(p_name, ' ', '-') AS g FROM part),
 j AS (SELECT p.p_partkey, r.rollup, count(*) OVER (PARTITION BY p.p_partkey) AS n FROM p JOIN r
       ON p.g = replace(r.rollup, '_', '-') OR starts_with(p.g, replace(r.rollup, '_', '-') || '-'))
SELECT r.rollup, count(j.p_partkey) AS observed FROM r LEFT JOIN j ON j.rollup = r.rollup AND j.n = 1 GROUP BY r.rollup""")
def rollup_counts(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit("-")).alias("group"))
    rollups = spark.createDataFrame(_ROLLUP_VALUES, "rollup string, declared bigint")
    counts, _ = coverage.rollup_counts(parts, "p_partkey", "group", rollups, "rollup", "declared")
    return counts.select("rollup", "observed")


@query("""
WITH k AS (SELECT o_custkey, min(o_orderpriority) AS segment, CAST(o_custkey % 25 AS INT) AS nation
           FROM orders GROUP BY o_custkey)
SELECT c.c_custkey,
  CASE WHEN k.o_custkey IS NULL THEN 'missing' WHEN k.nation <> c.c_nationkey OR k.segment <> '1-URGENT' THEN 'mismatch' ELSE 'match' END AS status,
  CASE WHEN k.o_custkey IS NOT NULL THEN
     concat_ws(',', CASE WHEN k.nation <> c.c_nationkey THEN 'c_nationkey' END, CASE WHEN k.segment <> '1-URGENT' THEN 'segment' END) END AS differing
FROM customer c LEFT JOIN k ON k.o_custkey = c.c_custkey""")
def catalog_reconcile(spark, sf):
    """Customers against a catalog derived from their orders."""
    inventory = table(spark, sf, "customer").select("c_custkey", "c_nationkey", F.lit("1-URGENT").alias("segment"))
    catalog = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderpriority").alias("found_segment"))
        .withColumn("found_nation", (F.col("c_custkey") % 25).cast("int"))
    )
    return reconcile.compare_with_catalog(
        inventory, catalog, "c_custkey", {"c_nationkey": "found_nation", "segment": "found_segment"}
    )


def coverage_inputs(spark, sf):
    inventory = table(spark, sf, "customer").select("c_custkey")
    solutions = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderstatus"
    )
    return inventory, solutions, F.col("o_orderstatus") == "F"


_STATE = """CASE WHEN v > 1 THEN 'multi_solution' WHEN v = 1 THEN 'verified' WHEN n > 0 THEN 'candidate_found' ELSE 'uncovered' END"""


@query(f"""
WITH a AS (SELECT c.c_custkey, count(o.o_orderkey) AS n, count(CASE WHEN o.o_orderstatus = 'F' THEN 1 END) AS v
  FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey)
SELECT c_custkey, n AS candidate_solution_count, v AS verified_solution_count, n - v AS rejected_solution_count, {_STATE} AS state FROM a""")
def coverage_by_key(spark, sf):
    inventory, solutions, verified = coverage_inputs(spark, sf)
    return coverage.coverage_by_key(inventory, solutions, "c_custkey", verified)


@query("""
SELECT (SELECT count(*) FROM customer) AS puzzle_count, count(*) AS candidate_solution_count,
  count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS verified_solution_count,
  count(*) - count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS rejected_solution_count
FROM orders""")
def coverage_totals(spark, sf):
    inventory, solutions, verified = coverage_inputs(spark, sf)
    return coverage.coverage_totals(inventory, solutions, verified)


@query(f"""
WITH a AS (SELECT c.c_custkey, count(o.o_orderkey) AS n, count(CASE WHEN o.o_orderstatus = 'F' THEN 1 END) AS v
  FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey)
SELECT {_STATE} AS state, count(*) AS customers, CAST(sum(n) AS BIGINT) AS candidates FROM a GROUP BY 1""")
def coverage_report(spark, sf):
    inventory, solutions, verified = coverage_inputs(spark, sf)
    by_key = coverage.coverage_by_key(inventory, solutions, "c_custkey", verified)
    return by_key.groupBy("state").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("candidate_solution_count").alias("candidates")
    )


@query("""
WITH e AS (SELECT DISTINCT o_custkey AS k FROM orders),
     a AS (SELECT DISTINCT user_id AS k FROM events)
SELECT coalesce(e.k, a.k) AS c_custkey, CASE WHEN a.k IS NULL THEN 'missing' ELSE 'unexpected' END AS side
FROM e FULL OUTER JOIN a ON e.k = a.k WHERE e.k IS NULL OR a.k IS NULL""")
def missing_unexpected(spark, sf):
    """Customers that have orders against users that have events."""
    expected = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    actual = table(spark, sf, "events").select(F.col("user_id").alias("c_custkey"))
    return checks.set_difference(expected, actual, "c_custkey")


@query("""
WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS place FROM labels)
SELECT place, place - 1 AS expected, doc_id AS observed FROM n WHERE doc_id <> place - 1""")
def sequence_check(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id")
    placed = number_in_buckets(labels, F.floor(F.col("doc_id") / 1_000_000), [F.col("doc_id")], "place")
    return sequence_violations(placed, "place", F.col("doc_id"), F.col("place") - 1)


@query("""
SELECT 'text is too long' AS detail, CAST(doc_id AS VARCHAR) AS row_key, 'documents' AS path FROM documents WHERE NOT length(text) <= 5000
UNION ALL SELECT 'language is unknown', CAST(doc_id AS VARCHAR), 'documents' FROM documents WHERE lang NOT IN ('en', 'de', 'es')
UNION ALL SELECT 'length is wrong', CAST(doc_id AS VARCHAR), 'documents' FROM documents WHERE n_chars <> length(text)
UNION ALL SELECT 'source is unknown', CAST(doc_id AS VARCHAR), 'documents' FROM documents WHERE NOT regexp_matches(source, '^src[0-9]$')
UNION ALL SELECT 'price is out of range', CAST(o_orderkey AS VARCHAR), 'orders' FROM orders WHERE NOT (o_totalprice BETWEEN 1000 AND 400000)
UNION ALL SELECT 'priority is unknown', CAST(o_orderkey AS VARCHAR), 'orders' FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')""")
def row_constraints(spark, sf):
    documents = {
        "text is too long": F.length("text") <= 5000,
        "language is unknown": F.col("lang").isin("en", "de", "es"),
        "length is wrong": F.col("n_chars") == F.length("text"),
        "source is unknown": F.col("source").rlike("^src[0-9]$"),
    }
    orders = {
        "price is out of range": F.col("o_totalprice").between(1000, 400000),
        "priority is unknown": F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"),
    }
    return checks.rule_violations(table(spark, sf, "documents"), documents, "documents", "doc_id").unionByName(
        checks.rule_violations(table(spark, sf, "orders"), orders, "orders", "o_orderkey")
    ).select("detail", "row_key", "path")


@query("""
SELECT 'segment' AS code, min(c_mktsegment) AS lowest, max(c_mktsegment) AS highest FROM customer HAVING min(c_mktsegment) <> max(c_mktsegment)
UNION ALL SELECT 'role', min(role), max(role) FROM conversations HAVING min(role) <> max(role)
UNION ALL SELECT 'scheme', min(CASE WHEN url LIKE 'http%' THEN 'http' ELSE 'x' END), max(CASE WHEN url LIKE 'http%' THEN 'http' ELSE 'x' END) FROM pages
 HAVING min(CASE WHEN url LIKE 'http%' THEN 'http' ELSE 'x' END) <> max(CASE WHEN url LIKE 'http%' THEN 'http' ELSE 'x' END)""")
def single_valued(spark, sf):
    scheme = F.when(F.col("url").startswith("http"), "http").otherwise("x")
    inputs = {
        "segment": (table(spark, sf, "customer"), "c_mktsegment"),
        "role": (table(spark, sf, "conversations"), "role"),
        "scheme": (table(spark, sf, "pages").select(scheme.alias("scheme")), "scheme"),
    }
    found = checks.union_all([checks.single_valued(df, [column], code, code).withColumn("column", F.lit(column)) for code, (df, column) in inputs.items()])
    ends = F.split("detail", " <> ")

    def end(i):
        return F.from_json(ends[i], "map<string,string>")[F.col("column")]

    return found.select("code", end(0).alias("lowest"), end(1).alias("highest"))


@query("""SELECT DISTINCT source AS source_id, lang AS revision FROM documents""")
def source_classes(spark, sf):
    from ..operators.release import source_classes as classes

    return classes(table(spark, sf, "documents").select(F.col("source").alias("source_id"), F.col("lang").alias("source_revision")))
