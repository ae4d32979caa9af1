"""Queries of the training-data operators on the driver tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import op1_sum_of_squares_packing as op1_packing
from . import op2_language_crf as op2_language
from . import op3_pii_crf as op3_pii
from . import op4_hnsw_links as op4_hnsw
from . import op5_warc_revisits as op5_revisits
from . import op6_multi_index_hamming as op6_multi_index_hamming_join
from . import op7_kd_shards, op8_sentencepiece, op9_token_counts, op10_quality_rules
from . import op11_token_alignment as op11_alignment
from . import op12_one_bit_search as op12_search
from . import op13_collocations

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Longest document that is not over the limit, in tokens.
TOKEN_LIMIT = 1024
SHARDS = 16
#: Rows with an id divisible by this are the queries of the vector search.
SEARCH_STEP = 20


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query()
def op9_token_counts_two_tier(spark: SparkSession, sf: str) -> DataFrame:
    counts = op9_token_counts.token_counts(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


_SPACE, _SYMBOL = op10_quality_rules.SPACE, op10_quality_rules.SYMBOLS
_PHRASES = " + ".join(f"CASE WHEN contains(lower(line), '{p}') THEN {len(p.split())} ELSE 0 END" for p in op10_quality_rules.BOILERPLATE)


@query(rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
words AS (SELECT r, list_filter(string_split_regex(t, '[{_SPACE}]+'), lambda x: x <> '') AS ws FROM d),
placed AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM words),
grams AS (
  SELECT r, i, concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) AS g, lead(w, 4) OVER o AS closing
  FROM placed WINDOW o AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams WHERE closing IS NOT NULL) WHERE n > 1),
repeated AS (SELECT r, sum(step) AS n FROM (
  SELECT r, least(5, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 5)) AS step FROM twice) GROUP BY r),
lines AS (
  SELECT r, line, i, len(list_filter(string_split_regex(line, '[{_SPACE}]+'), lambda x: x <> '')) AS n,
    row_number() OVER (PARTITION BY r, line ORDER BY i) AS copy
  FROM (SELECT r, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (SELECT r, string_split(t, chr(10)) AS ls FROM d))
  WHERE regexp_matches(line, '[^{_SPACE}]')),
judged AS (
  SELECT r, n, copy, copy > 1 OR (phrase_words > 0 AND phrase_words >= n * {op10_quality_rules.MIN_PHRASE_WORDS})
    OR len(regexp_extract_all(line, '(?:^|[{_SPACE}]){_SYMBOL}|{_SYMBOL}(?:$|[{_SPACE}])')) > n * {op10_quality_rules.MAX_SYMBOL_WORDS}
    OR (n >= {op10_quality_rules.MIN_SHOUT} AND len(regexp_extract_all(line, '!!(?:$|[{_SPACE}])')) > n * {op10_quality_rules.MAX_SHOUT_WORDS})
    OR (n >= {op10_quality_rules.MIN_UNPUNCTUATED} AND NOT regexp_matches(line, '{op10_quality_rules.SENTENCE_MARKS}')) AS bad
  FROM (SELECT *, {_PHRASES} AS phrase_words FROM lines)),
counted AS (
  SELECT r, count(*) FILTER (WHERE copy > 1) AS dup, count(*) FILTER (WHERE bad) AS bad, coalesce(sum(n) FILTER (WHERE bad), 0) AS lost FROM judged GROUP BY r),
base AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[{_SPACE}]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '{_SYMBOL}+', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(bad, 0) AS BIGINT) AS n_bad_lines, CAST(coalesce(lost, 0) AS BIGINT) AS n_lost_words
  FROM d JOIN words USING (r) LEFT JOIN counted USING (r) LEFT JOIN repeated USING (r)),
failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base)
SELECT *, NOT base_failed AND n_lost_words <= {op10_quality_rules.MAX_LOST_WORDS} * n_words AS kept FROM failed""")
def op10_quality_rules_line_first(spark: SparkSession, sf: str) -> DataFrame:
    return op10_quality_rules.quality(table(spark, sf, "documents"))


@query()
def op1_sum_of_squares_packing(spark: SparkSession, sf: str) -> DataFrame:
    return op1_packing.pack_documents(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op7_kd_tree_shards(spark: SparkSession, sf: str) -> DataFrame:
    shards = op7_kd_shards.kd_shards(table(spark, sf, "documents"), n_shards=SHARDS)
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query()
def op6_multi_index_hamming(spark: SparkSession, sf: str) -> DataFrame:
    return op6_multi_index_hamming_join.near_duplicates(table(spark, sf, "documents"))


@query()
def op3_pii_crf(spark: SparkSession, sf: str) -> DataFrame:
    return op3_pii.find(table(spark, sf, "documents"))


@query()
def op2_language_crf(spark: SparkSession, sf: str) -> DataFrame:
    return op2_language.identified(table(spark, sf, "documents"))


@query()
def op4_hnsw_links(spark: SparkSession, sf: str) -> DataFrame:
    return op4_hnsw.near_vectors(table(spark, sf, "embeddings"))


def page_captures(pages: DataFrame) -> DataFrame:
    """Archive records of the pages: each page is a response at its id, and is visited again later.

    Of the second visits most send the page's entity tag, some only its date, some
    another tag or none; every ninth comes before the page itself.
    """
    tag, date = F.concat(F.lit('"'), F.md5("html"), F.lit('"')), F.concat(F.lit("day "), (F.col("page_id") % 28).cast("string"))
    n = F.col("page_id")
    response = pages.select(
        (n * 2).alias("record_id"), F.lit("response").alias("warc_type"), "url", (n * 10).alias("ts"), F.when(n % 13 == 5, 206).otherwise(200).alias("status"),
        F.create_map(
            F.lit("ETag"), tag, F.lit("Last-Modified"), date, F.lit("Content-Length"), F.octet_length("html").cast("string"),
            F.lit("Date"), (n * 10).cast("string"), F.lit("Content-Type"), F.lit("text/html"),
        ).alias("headers"),
    )
    sent = F.when(n % 7 == 3, F.lit('"other"')).when(n % 7 != 4, F.concat(F.lit("W/"), tag))
    later = F.when(n % 9 == 2, n * 10 - 5).otherwise(n * 10 + 1_000_000)
    revisit = pages.select(
        (n * 2 + 1).alias("record_id"), F.lit("revisit").alias("warc_type"), "url", later.alias("ts"), F.lit(304).alias("status"),
        F.map_filter(
            F.create_map(F.lit("etag"), sent, F.lit("last-modified"), F.when(n % 21 != 4, date), F.lit("date"), later.cast("string"), F.lit("content-length"), F.lit("0")),
            lambda k, v: v.isNotNull(),
        ).alias("headers"),
    )
    return response.unionByName(revisit)


@query(r"""
WITH urls AS (
  SELECT page_id n, md5(html) tag, octet_length(encode(html)) len,
         regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') rest FROM pages),
p AS (
  SELECT n, tag, len, concat(
    regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^www[.]', ''), ':(80|443)$', ''),
    regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', ''),
    CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END) url
  FROM (SELECT *, list_sort(list_filter(string_split(regexp_extract(rest, '^[^?]*[?](.*)$', 1), '&'),
          lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|gclid|fbclid|sessionid)(=|$)'))) q FROM urls)),
resp AS (SELECT n, url, n * 10 ts, '"' || tag || '"' tag, 'day ' || (n % 28) AS day, len FROM p WHERE n % 13 <> 5),
rev AS (
  SELECT n, url, CASE WHEN n % 9 = 2 THEN n * 10 - 5 ELSE n * 10 + 1000000 END ts,
         CASE WHEN n % 7 = 3 THEN '"other"' WHEN n % 7 <> 4 THEN '"' || tag || '"' END tag,
         CASE WHEN n % 21 <> 4 THEN 'day ' || (n % 28) END AS day FROM p),
met AS (
  SELECT v.n, v.url, v.ts, v.tag, v.day, max(r.ts) found FROM rev v LEFT JOIN resp r ON r.url = v.url AND r.ts < v.ts GROUP BY ALL),
judged AS (
  SELECT m.*, r.n rn, r.len, r.day rday, r.tag rtag, CASE
    WHEN r.n IS NULL THEN 'no_response'
    WHEN m.tag IS NOT NULL THEN CASE WHEN m.tag = r.tag THEN 'resolved' ELSE 'changed' END
    WHEN m.day IS NOT NULL THEN CASE WHEN m.day = r.day THEN 'resolved' ELSE 'changed' END
    ELSE 'no_validator' END state
  FROM met m LEFT JOIN resp r ON r.url = m.url AND r.ts = m.found)
SELECT n * 2 + 1 AS record_id, url, ts, state, CASE WHEN state = 'resolved' THEN rn * 2 END AS refers_to,
  CASE WHEN state = 'resolved'
    THEN concat('content-length=', len, '\ncontent-type=text/html\ndate=', ts, '\netag=', CASE WHEN tag IS NULL THEN rtag ELSE 'W/' || tag END,
                '\nlast-modified=', rday)
    ELSE concat('content-length=0\ndate=', ts, CASE WHEN tag IS NOT NULL THEN concat('\netag=', CASE WHEN tag = '"other"' THEN tag ELSE 'W/' || tag END) ELSE '' END,
                CASE WHEN day IS NOT NULL THEN concat('\nlast-modified=', day) ELSE '' END) END AS headers
FROM judged
""".replace("\\n", "' || chr(10) || '"))
def op5_warc_revisits(spark: SparkSession, sf: str) -> DataFrame:
    found = op5_revisits.resolve_revisits(page_captures(table(spark, sf, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.withColumn("headers", F.array_join(lines, "\n"))


@query()
def op8_sentencepiece_ids(spark: SparkSession, sf: str) -> DataFrame:
    return op8_sentencepiece.measured(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op11_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return op11_alignment.alignments(table(spark, sf, "documents"), a, b)


@query()
def op12_one_bit_search(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    return op12_search.nearest(vectors, op12_search.every(vectors, SEARCH_STEP))


@query(r"""
WITH p AS (
  SELECT row_number() OVER () AS p, lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM (
    SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)),
w AS (
  SELECT p, lang, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
  FROM (SELECT row_number() OVER () AS p, lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS ws FROM p)),
g AS (
  SELECT lang, word AS w1, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3, lead(word, 3) OVER o AS w4
  FROM w WINDOW o AS (PARTITION BY p ORDER BY i)),
f AS (
  SELECT lang, ws, count(*) AS f FROM (
    SELECT lang, [w1] AS ws FROM g UNION ALL SELECT lang, [w1, w2] FROM g WHERE w2 IS NOT NULL
    UNION ALL SELECT lang, [w1, w2, w3] FROM g WHERE w3 IS NOT NULL UNION ALL SELECT lang, [w1, w2, w3, w4] FROM g WHERE w4 IS NOT NULL)
  GROUP BY lang, ws HAVING count(*) >= 30),
c AS (SELECT lang, ws, f AS a FROM f WHERE len(ws) > 1),
covered AS (
  SELECT DISTINCT c.lang, c.ws FROM (
    SELECT lang, ws[i : i + m - 1] AS ws, a AS longer FROM c, range(1, 4) s(i), range(2, 4) t(m) WHERE m < len(ws) AND i + m - 1 <= len(ws)) b
  JOIN c ON c.lang = b.lang AND c.ws = b.ws WHERE 100 * longer >= 80 * a),
cuts AS (
  SELECT c.lang, c.ws, c.a, l.f AS l, r.f AS r, CAST(2000000 * a::HUGEINT // (l.f::HUGEINT + r.f) AS BIGINT) AS score, k
  FROM (SELECT lang, ws, a, k FROM c, range(1, 4) s(k) WHERE k < len(ws)) c
  JOIN f l ON l.lang = c.lang AND l.ws = c.ws[1 : k] JOIN f r ON r.lang = c.lang AND r.ws = c.ws[k + 1 :]),
weakest AS (
  SELECT lang, array_to_string(ws, ' ') AS phrase, a, l, r, score FROM (SELECT *, row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) AS o FROM cuts)
  WHERE o = 1 AND (lang, ws) NOT IN (SELECT (lang, ws) FROM covered)),
totals AS (SELECT lang, count(*) AS n FROM w GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest) JOIN totals USING (lang) WHERE rank <= 2000
""")
def op13_collocations_external_streams(spark: SparkSession, sf: str) -> DataFrame:
    return op13_collocations.collocations(table(spark, sf, "documents"))
