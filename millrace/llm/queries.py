"""One query per operator, over its whole table, with the columns its contract names."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    collocations, hard_negatives, html_text, language, mixing, packing, quality, sharding, simhash, suffix_dedup, token_counts, topk, warc,
)
from millrace.llm.registry import query
from millrace.plans.catalog import table

SEQUENCE_TOKENS = 1024
END_ID = 2
TOKEN_LIMIT = 2048
# Below the longest documents, so that shards split unevenly and some at a second level of bits, whatever the table's size.
SHARD_BYTES = 32 << 10


@query()
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path, END_ID, SEQUENCE_TOKENS)


@query()
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path, TOKEN_LIMIT)


QUALITY_COLUMNS = [
    "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
]

QUALITY_SQL = f"""
WITH words AS (
  SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents
), windows AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM words
), keyed AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM windows
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM keyed) WHERE n > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id
), m AS (
  SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         len(list_filter(w, lambda x: list_contains([{', '.join(f"'{s}'" for s in sorted(set(quality.STOP_WORDS)))}], lower(x)))) AS n_stop_words,
         CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words
  FROM words LEFT JOIN repeated USING (doc_id)
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {' AND '.join(
           ' AND '.join(
               ([f'1000 * {r.numerator} >= {r.low} * {r.denominator}'] if r.low is not None else [])
               + ([f'1000 * {r.numerator} <= {r.high} * {r.denominator}'] if r.high is not None else [])
           )
           for r in quality.RULES
       )} AS kept
FROM b
"""  # fmt: skip


@query(QUALITY_SQL)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.apply_rules(table(spark, sf_dir, "documents")).select(*QUALITY_COLUMNS)


@query()
def op8_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


WARC_SQL = """
WITH page AS (
  SELECT page_id, html, md5(html) AS digest, strlen(html) AS n_bytes,
         CASE WHEN page_id % 3 = 0 THEN 'http://www.hot.example/front' ELSE regexp_extract(url, '^[^?#]*//[^/?#]*/?[^/?#]*') || coalesce(nullif(regexp_extract(url, '[?][^#]*'), '') , '') END AS url
  FROM pages
), rested AS (
  SELECT page_id, html, digest, n_bytes, regexp_replace(regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#.*$', '') AS rest FROM page
), parts AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*')), '^www[0-9]*[.]', ''), ':(80|443)$', '') AS host,
         regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
         list_sort(list_filter(string_split(regexp_extract(rest, '^[^?]*[?](.*)$', 1), '&'),
           lambda p: p <> '' AND NOT list_contains([TRACKING], lower(split_part(p, '=', 1))))) AS params
  FROM rested
), canon AS (
  SELECT *, host || path || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS canonical FROM parts
), response AS (
  SELECT 2 * page_id AS record_id, canonical AS url, page_id * 7919 % 10007 AS captured_at, digest, n_bytes,
         '"v' || page_id % 5 % 2 || '"' AS etag, 'day ' || page_id % 2 AS modified FROM canon
), revisit AS (
  SELECT 2 * page_id + 1 AS record_id, canonical AS url, page_id * 4729 % 10007 AS captured_at,
         CASE page_id % 4 WHEN 0 THEN 'W/"v0"' WHEN 2 THEN '"v1"' END AS etag,
         CASE page_id % 4 WHEN 1 THEN 'day ' || page_id % 8 // 4 END AS modified FROM canon
), found AS (
  SELECT revisit.*, max_by({'r': response.record_id, 'd': response.digest, 'n': response.n_bytes, 'e': response.etag, 'm': response.modified},
                           {'a': response.captured_at, 'r': response.record_id}) AS old
  FROM revisit LEFT JOIN response ON response.url = revisit.url AND response.captured_at < revisit.captured_at
  GROUP BY ALL
), judged AS (
  SELECT *, CASE WHEN old.r IS NULL THEN 'no_earlier_response'
                 WHEN etag IS NOT NULL THEN CASE WHEN replace(etag, 'W/', '') = old.e THEN 'resolved' ELSE 'validator_mismatch' END
                 WHEN modified IS NOT NULL THEN CASE WHEN modified = old.m THEN 'resolved' ELSE 'validator_mismatch' END
                 ELSE 'no_validator' END AS outcome
  FROM found
)
SELECT record_id, url, captured_at, 'full' AS outcome, record_id AS response_id, digest AS payload_digest, CAST(n_bytes AS BIGINT) AS payload_bytes,
       etag, 'd' || captured_at AS date, 'text/html' AS content_type, CAST(n_bytes AS VARCHAR) AS content_length
FROM response
UNION ALL
SELECT record_id, url, captured_at, outcome, CASE WHEN outcome = 'resolved' THEN old.r END, CASE WHEN outcome = 'resolved' THEN old.d END,
       CAST(CASE WHEN outcome = 'resolved' THEN old.n END AS BIGINT),
       CASE WHEN outcome = 'resolved' THEN coalesce(etag, old.e) ELSE etag END, 'd' || captured_at,
       CASE WHEN outcome = 'resolved' THEN 'text/html' END,
       CASE WHEN outcome = 'resolved' THEN CAST(old.n AS VARCHAR) ELSE '0' END
FROM judged
""".replace("TRACKING", ", ".join(f"'{t}'" for t in warc.TRACKING))


def captures(pages: DataFrame) -> DataFrame:
    """Each page as a full response of its host and first part of its path (with its parameters), and as a revisit of that. A third of all
    records are of one URL. Responses and revisits come at times of their own, so a revisit stands before, between or long after the
    responses of its URL; it has a tag that may agree with the latest of these, a date that may, or no validator."""
    page = F.col("page_id")
    own = F.concat(F.regexp_extract("url", "^[^?#]*//[^/?#]*/?[^/?#]*", 0), F.regexp_extract("url", "[?][^#]*", 0))
    url = F.when(page % 3 == 0, "http://www.hot.example/front").otherwise(own).alias("url")

    def headers(**values: Column) -> Column:
        return F.map_from_arrays(F.array(*[F.lit(k.replace("_", "-")) for k in values]), F.array(*values.values()))

    def text(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    at, again = page * 7919 % 10007, page * 4729 % 10007
    responses = pages.select(
        (2 * page).alias("record_id"),
        F.lit("response").alias("kind"),
        url,
        at.alias("captured_at"),
        F.lit(200).alias("status"),
        headers(
            ETag=text('"v', page % 5 % 2, '"'), Last_Modified=text("day ", page % 2), Content_Type=F.lit("text/html"), Date=text("d", at),
            Content_Length=F.octet_length("html").cast("string"),
        ).alias("headers"),
        F.col("html").alias("payload"),
    )
    turn = page % 4
    revisits = pages.select(
        (2 * page + 1).alias("record_id"),
        F.lit("revisit").alias("kind"),
        url,
        again.alias("captured_at"),
        F.lit(304).alias("status"),
        headers(
            etag=F.when(turn == 0, 'W/"v0"').when(turn == 2, '"v1"'),
            last_modified=F.when(turn == 1, text("day ", F.expr("page_id % 8 div 4"))),
            date=text("d", again),
            content_length=F.lit("0"),
        ).alias("headers"),
        F.lit(None).cast("string").alias("payload"),
    )
    return responses.unionByName(revisits)


@query(WARC_SQL)
def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = warc.resolve_revisits(captures(table(spark, sf_dir, "pages")))
    names = ["etag", "date", "content-type", "content-length"]
    return resolved.select(
        "record_id", "url", "captured_at", "outcome", "response_id", "payload_digest", "payload_bytes",
        *[F.col("headers")[n].alias(n.replace("-", "_")) for n in names],
    )


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


@query(TOPK_SQL)
def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5, scale=256)


def shard_sql(limit: int) -> str:
    return f"""
WITH k AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS b,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents
), n AS (
  SELECT d, h >> (60 - d) AS p, sum(b) AS b, count(*) AS n, sum(b) <= {limit} OR min(h) = max(h) AS closed
  FROM (SELECT h, b, unnest(range(0, 61)) AS d FROM k) GROUP BY ALL
), s AS (
  SELECT n.* FROM n LEFT JOIN n m ON m.d = n.d - 1 AND m.p = n.p >> 1 WHERE n.closed AND NOT coalesce(m.closed, false)
)
SELECT doc_id, k.b AS n_bytes, CASE WHEN s.d = 0 THEN '' ELSE lpad(CAST(bin(s.p) AS VARCHAR), CAST(s.d AS INTEGER), '0') END AS shard,
       CAST(s.d AS INTEGER) AS depth, CAST(s.b AS BIGINT) AS shard_bytes, s.n AS shard_docs, s.b > {limit} AS oversized
FROM k JOIN s ON s.p = k.h >> (60 - s.d)
"""


@query(shard_sql(SHARD_BYTES))
def op7_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), SHARD_BYTES)


SHINGLE_WORDS = 3
SIMHASH_BITS = 2


@query()
def op9_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"), SHINGLE_WORDS, SIMHASH_BITS)


@query()
def op10_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


REPEAT_BYTES = 50


@query()
def op2_run_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), REPEAT_BYTES)
    return marks.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query()
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""


@query(NEGATIVES_SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", label), F.col("id") % 100 == 0)


PHRASES_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), spots AS (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, 6) AS sizes(k) WHERE len(w) >= k
), grams AS (
  SELECT lang, CAST(k AS INTEGER) AS k, array_to_string(w[i:i + k - 1], ' ') AS phrase, CAST(count(*) AS BIGINT) AS f FROM spots GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE k = 1 GROUP BY lang
), frequent AS (
  SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f FROM grams WHERE f >= 100
), inner_spots AS (
  SELECT lang, w, f, m, unnest(range(1, k - m + 2)) AS i FROM frequent, range(2, 5) AS sizes(m) WHERE m < k
), covered AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS longer FROM inner_spots GROUP BY ALL
), candidates AS (
  SELECT c.lang, c.phrase, c.w, c.f AS a, totals.n FROM frequent c JOIN totals USING (lang) LEFT JOIN covered o USING (lang, phrase)
  WHERE c.k > 1 AND (o.longer IS NULL OR 100 * o.longer < 100 * c.f)
), cuts AS (
  SELECT lang, phrase, w, a, n, unnest(range(1, len(w))) AS cut FROM candidates
), scored AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, c.n, cut,
         CAST((CAST(1000 AS HUGEINT) * c.a * c.n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN frequent x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:cut], ' ')
  JOIN frequent y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1:], ' ')
), best AS (
  SELECT lang, phrase, a, n, b.l, b.r, b.score FROM (
    SELECT lang, phrase, a, n, min_by({'l': l, 'r': r, 'score': score}, {'s': score, 'c': cut}) AS b FROM scored GROUP BY lang, phrase, a, n)
)
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""


@query(PHRASES_SQL)
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
