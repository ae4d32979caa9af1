"""Identity, exact dedup, provenance, digests and payload rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import canonical as c
from ..operators import checks, digest, ingest, release
from ..operators.eligibility import select_by_priority
from ..operators.ordering import global_row_number, text_key
from ..sources import files
from ..sources.sinks import plan_receipt_append
from .common import FOLDED_SQL, RIGHTS_SQL, document_candidates, document_rights, query, table


@query("""
SELECT doc_id, sha256(text) AS sha256, 'om.solution.sha256.' || sha256(text) AS artifact_id,
       'objects/sha256/' || substr(sha256(text), 1, 2) || '/' || substr(sha256(text), 3) AS object_key,
       CAST(strlen(text) AS BIGINT) AS byte_length
FROM documents""")
def artifact_identity(spark, sf):
    digest_ = F.sha2("text", 256)
    return table(spark, sf, "documents").select(
        "doc_id",
        digest_.alias("sha256"),
        c.artifact_id(F.lit("solution"), digest_).alias("artifact_id"),
        c.object_key(digest_).alias("object_key"),
        F.octet_length("text").cast("bigint").alias("byte_length"),
    )


@query(f"""
SELECT 'solution' AS artifact_kind, sha256(text) AS sha256, min(lang) AS puzzle_id,
       CAST(min(strlen(text)) AS BIGINT) AS byte_length, 'solution' AS artifact_format,
       {FOLDED_SQL} AS rights_status, count(*) AS copies,
       'om.solution.sha256.' || sha256(text) AS artifact_id,
       'objects/sha256/' || substr(sha256(text), 1, 2) || '/' || substr(sha256(text), 3) AS object_key
FROM documents GROUP BY sha256(text)""")
def exact_dedup(spark, sf):
    return ingest.exact_dedup(document_candidates(table(spark, sf, "documents")))


@query("""
SELECT sha256(text) AS sha256, min(source) AS lowest, max(source) AS highest, count(*) AS n
FROM documents GROUP BY sha256(text) HAVING count(DISTINCT source) > 1""")
def dedup_conflicts(spark, sf):
    docs = table(spark, sf, "documents").select(F.sha2("text", 256).alias("sha256"), "source")
    found = checks.dependency_conflicts(docs, ["sha256"], ["source"])
    return found.select("sha256", F.col("lowest.source").alias("lowest"), F.col("highest.source").alias("highest"), "n")


@query(f"""
SELECT sha256(text) AS sha256, {FOLDED_SQL} AS rights_status FROM documents GROUP BY sha256(text)""")
def rights_fold(spark, sf):
    docs = table(spark, sf, "documents").select(F.sha2("text", 256).alias("sha256"), document_rights().alias("r"))
    return docs.groupBy("sha256").agg(ingest.folded_rights(F.col("r")).alias("rights_status"))


@query(f"""
WITH d AS (SELECT d.*, l.quality, l.toxic, sha256(d.text) AS sha, {RIGHTS_SQL} AS rights
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT DISTINCT 'om.solution.sha256.' || sha AS artifact_id, lang AS puzzle_id, 'artifact' AS source_role,
       source AS source_id, lang || '/' || doc_id || '.solution' AS source_path, rights AS rights_status,
       sha AS source_evidence_sha256, CAST(strlen(text) AS BIGINT) AS source_evidence_byte_length,
       CAST(NULL AS BIGINT) AS claimed_cost
FROM d
UNION
SELECT 'om.solution.sha256.' || sha, lang, 'evidence', source, lang || '/' || doc_id || '.json', rights,
       sha256(doc_id || ':' || quality || ':' || toxic), CAST(strlen(doc_id || ':' || quality || ':' || toxic) AS BIGINT),
       CAST(quality AS BIGINT)
FROM d WHERE quality IS NOT NULL""")
def provenance_rows(spark, sf):
    rows = ingest.provenance_rows(document_candidates(table(spark, sf, "documents"), table(spark, sf, "labels")))
    return rows.select(
        "artifact_id", "puzzle_id", "source_role", "source_id", "source_path", "rights_status",
        "source_evidence_sha256", "source_evidence_byte_length", "claimed_cost",
    )


@query("""
SELECT 'om.solution.sha256.' || sha256(text) AS artifact_id, count(DISTINCT source) AS source_count
FROM documents GROUP BY sha256(text)""")
def source_count(spark, sf):
    seen = table(spark, sf, "documents").select(
        c.artifact_id(F.lit("solution"), F.sha2("text", 256)).alias("artifact_id"), F.col("source").alias("source_id")
    )
    return release.source_counts(seen)


@query("""
SELECT doc_id, sha256(text) AS sha256, CAST(strlen(text) AS BIGINT) AS byte_length, md5(text) AS content_md5
FROM documents WHERE text IS NOT NULL""")
def content_by_digest(spark, sf):
    """Every document's bytes, met by digest in a store that holds each text once."""
    docs = table(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", F.sha2("text", 256).alias("sha256"), "text")
    first = docs.groupBy("sha256").agg(F.min("doc_id").alias("doc_id"))
    objects = docs.join(first.select("doc_id"), "doc_id", "left_semi").select(
        c.object_key(F.col("sha256")).alias("object_key"), F.octet_length("text").cast("bigint").alias("byte_length"),
        "sha256", F.col("text").cast("binary").alias("content"),
    )
    return docs.select("doc_id", "sha256").join(files.content_table(objects), "sha256").select(
        "doc_id", "sha256", "byte_length", F.md5("content").alias("content_md5")
    )


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber
HAVING min(l_partkey) <> max(l_partkey) OR min(l_suppkey) <> max(l_suppkey)""")
def fd_conflicts(spark, sf):
    lines = table(spark, sf, "lineitem")
    return checks.dependency_conflicts(lines, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"]).select(
        "l_orderkey", "l_linenumber", "n"
    )


@query("""
WITH f AS (SELECT sha256(text) AS sha, min(doc_id) AS first_row FROM documents GROUP BY sha256(text) HAVING count(*) > 1)
SELECT f.sha AS sha256, d.doc_id, f.first_row FROM documents d JOIN f ON sha256(d.text) = f.sha
WHERE d.doc_id > f.first_row""")
def duplicate_keys_first_seen(spark, sf):
    docs = table(spark, sf, "documents").select(F.sha2("text", 256).alias("sha256"), "doc_id")
    return checks.duplicate_keys(docs, ["sha256"], "doc_id").select("sha256", "doc_id", "first_row")


_CUSTOMER_JSON = """'{"c_custkey":' || c_custkey || ',"c_mktsegment":' || CAST(to_json(c_mktsegment) AS VARCHAR)
 || ',"c_name":' || CAST(to_json(c_name) AS VARCHAR) || ',"c_nationkey":' || c_nationkey || '}'"""


@query(f"""
SELECT c_custkey, {_CUSTOMER_JSON} AS canonical, 'om.observation.sha256.' || sha256({_CUSTOMER_JSON}) AS observation_id
FROM customer""")
def canonical_json_ids(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return rows.select(
        "c_custkey", c.canonical_json(rows).alias("canonical"), c.row_id(rows, "om.observation.sha256.").alias("observation_id")
    )


@query("""
SELECT o_orderkey, o_orderpriority FROM orders
WHERE sha256(CASE WHEN o_orderstatus = 'P' THEN '{"o_custkey":' || o_custkey || '}'
      ELSE '{"o_custkey":' || o_custkey || ',"o_orderpriority":"' || o_orderpriority || '"}' END)
   <> sha256('{"o_custkey":' || o_custkey || ',"o_orderpriority":"' || o_orderpriority || '"}')""")
def forged_ids(spark, sf):
    """Orders whose supplied id does not follow from their body (status P leaves the priority out)."""
    rows = table(spark, sf, "orders")
    full = {"o_custkey": F.col("o_custkey"), "o_orderpriority": F.col("o_orderpriority")}
    supplied = F.when(
        F.col("o_orderstatus") == "P", c.content_id("om.observation.sha256.", {"o_custkey": F.col("o_custkey")})
    ).otherwise(c.content_id("om.observation.sha256.", full))
    return rows.where(supplied != c.content_id("om.observation.sha256.", full)).select("o_orderkey", "o_orderpriority")


@query("""
SELECT d.doc_id, row_number() OVER (ORDER BY coalesce(CAST(l.quality AS VARCHAR), 'None'), CAST(d.doc_id AS VARCHAR)) AS place
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def canonical_order(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id").join(
        table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left"
    )
    placed = global_row_number(rows, [text_key("quality"), text_key("doc_id")], "place")
    return placed.select("doc_id", F.col("place").cast("bigint").alias("place"))


def _digest_sql(name: str, row: str) -> str:
    words = [f"sum(CAST('0x' || substr(h, {1 + 8 * i}, 8) AS BIGINT))" for i in range(8)]
    sums = " || ':' || ".join(f"CAST(coalesce({w}, 0) AS VARCHAR)" for w in words)
    return f"""SELECT '{name}' AS table_name, count(*) AS row_count, sha256(':' || count(*) || ':' || {sums}) AS digest
  FROM (SELECT sha256({row}) AS h FROM {name})"""


_CENTS = "CAST(round({0} * 100) AS BIGINT)"
_ORDERS_ROW = f"""'{{"o_custkey":' || o_custkey || ',"o_orderdate":' || epoch(o_orderdate)::BIGINT || ',"o_orderkey":' || o_orderkey
  || ',"o_orderpriority":"' || o_orderpriority || '","o_orderstatus":"' || o_orderstatus || '","o_totalprice":' || {_CENTS.format("o_totalprice")} || '}}'"""
_LINE_ROW = f"""'{{"l_discount":' || {_CENTS.format("l_discount")} || ',"l_extendedprice":' || {_CENTS.format("l_extendedprice")}
  || ',"l_linenumber":' || l_linenumber || ',"l_linestatus":"' || l_linestatus || '","l_orderkey":' || l_orderkey || ',"l_partkey":' || l_partkey
  || ',"l_quantity":' || {_CENTS.format("l_quantity")} || ',"l_returnflag":"' || l_returnflag || '","l_shipdate":' || epoch(l_shipdate)::BIGINT
  || ',"l_suppkey":' || l_suppkey || ',"l_tax":' || {_CENTS.format("l_tax")} || '}}'"""
_DOC_ROW = """'{"doc_id":' || doc_id || ',"lang":"' || lang || '","n_chars":' || n_chars || ',"source":"' || source || '","text":'
  || to_json(text)::VARCHAR || '}'"""


@query("\nUNION ALL ".join(
    [_digest_sql("orders", _ORDERS_ROW), _digest_sql("lineitem", _LINE_ROW), _digest_sql("documents", _DOC_ROW)]))
def multiset_digest(spark, sf):
    """Identity of three whole tables; amounts in cents, times in seconds."""

    def exact(name):
        rows = table(spark, sf, name)
        kinds = dict(rows.dtypes)
        return rows.select(
            *[
                F.round(F.col(c) * 100).cast("bigint").alias(c) if kinds[c] == "double"
                else F.col(c).cast("timestamp").cast("bigint").alias(c) if kinds[c].startswith("timestamp") else F.col(c)
                for c in rows.columns
            ]
        )

    return checks.union_all(
        [digest.multiset_digest(exact(t)).select(F.lit(t).alias("table_name"), "*") for t in ("orders", "lineitem", "documents")]
    )


@query(f"""
SELECT 'payload_rights_violation' AS code, CAST(doc_id AS VARCHAR) AS row_key FROM documents
WHERE length(text) > 0 AND {RIGHTS_SQL} <> 'redistributable'
UNION ALL
SELECT 'payload_forbidden', CAST(doc_id AS VARCHAR) FROM documents WHERE length(text) > 0""")
def payload_policy(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", document_rights().alias("rights_status"))
    return checks.union_all(
        [
            release.payload_violations(docs, "text", policy, "documents", "doc_id")
            for policy in ("include-permitted", "metadata-only")
        ]
    ).select("code", "row_key")


@query(f"""
SELECT doc_id, {RIGHTS_SQL} AS rights_status,
       CASE WHEN {RIGHTS_SQL} = 'redistributable' THEN base64(encode(text)) END AS payload
FROM documents""")
def payload_projection(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", document_rights().alias("rights_status"), F.col("text").cast("binary").alias("content")
    )
    artifacts = docs.select(F.col("doc_id").alias("artifact_id"), F.col("doc_id").alias("sha256"), "rights_status")
    objects = docs.select(F.col("doc_id").alias("sha256"), "content")
    bytes_ = release.gated_payload(artifacts, objects, "include-permitted")
    return artifacts.join(bytes_, "artifact_id", "left").select(
        F.col("artifact_id").alias("doc_id"), "rights_status", c.base64_text(F.col("solution_bytes")).alias("payload")
    )


@query("""
WITH r AS (SELECT sha256(text) AS sha256, source, doc_id,
  CASE WHEN source = 'src3' THEN 0 WHEN source = 'src5' THEN 1 ELSE 2 END AS priority FROM documents)
SELECT sha256, priority, doc_id, source FROM (
  SELECT *, row_number() OVER (PARTITION BY sha256 ORDER BY priority, doc_id) AS k FROM r) WHERE k = 1""")
def priority_selection(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.sha2("text", 256).alias("sha256"), "doc_id", "source",
        F.when(F.col("source") == "src3", "official-game").when(F.col("source") == "src5", "omsim")
        .otherwise(F.col("source")).alias("source_id"),
    )
    return select_by_priority(docs, "sha256", "doc_id", "source_id", ["source"])


@query("""
SELECT 'new' AS result, CAST(o_orderkey AS VARCHAR) AS order_key FROM orders WHERE o_orderstatus = 'O'
UNION ALL
SELECT 'pinned_path_changed', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""")
def idempotent_append(spark, sf):
    """Existing receipts are the F and P orders; the batch brings F (urgent ones changed) and O."""
    orders = table(spark, sf, "orders")

    def receipts(df, body):
        return df.select(
            F.lit("orders").alias("source_id"), F.lit("r1").alias("revision"),
            F.col("o_orderkey").cast("string").alias("upstream_path"), F.sha2(body, 256).alias("sha256"),
            F.octet_length(body).cast("bigint").alias("byte_length"), F.lit("unknown").alias("rights_status"),
            F.col("o_orderdate").cast("string").alias("retrieved_at"),
        )

    body = F.concat_ws("|", F.col("o_custkey").cast("string"), "o_orderpriority")
    changed = F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(body, F.lit("!"))).otherwise(body)
    existing = receipts(orders.where("o_orderstatus IN ('F', 'P')"), body)
    incoming = receipts(orders.where("o_orderstatus = 'F'"), changed).unionByName(
        receipts(orders.where("o_orderstatus = 'O'"), body)
    )
    fresh, conflicts = plan_receipt_append(existing, incoming)
    return fresh.select(F.lit("new").alias("result"), F.col("upstream_path").alias("order_key")).unionByName(
        conflicts.select(F.col("code").alias("result"), F.element_at(F.split("row_key", "\u001f"), -1).alias("order_key"))
    )


@query("""
SELECT o_custkey, o_orderstatus, o_orderpriority, left_count, right_count FROM (
  SELECT o_custkey, o_orderstatus, o_orderpriority, CAST(sum(l) AS BIGINT) AS left_count, CAST(sum(r) AS BIGINT) AS right_count FROM (
    SELECT o_custkey, o_orderstatus, o_orderpriority, 1 AS l, 0 AS r FROM orders
    UNION ALL
    SELECT o_custkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'F' ELSE o_orderstatus END, o_orderpriority, 0, 1 FROM orders)
  GROUP BY 1, 2, 3) WHERE left_count <> right_count""")
def rebuild_diff(spark, sf):
    first = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority")
    second = first.withColumn(
        "o_orderstatus", F.when(F.col("o_orderpriority") == "5-LOW", "F").otherwise(F.col("o_orderstatus"))
    )
    return checks.multiset_difference(first, second)
