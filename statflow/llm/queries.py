"""The registered queries: each operator, with production parameters, over its
whole table, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statflow.llm import (aligned, ann, jaccard, line_dedup, mixing, packing, quality, ranked, suffix_lm, tiers,
                          toxicity, urlfilter, warc)

TOKENIZER = corpus_pipeline.TOKENIZER


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs)
    return (mixed.select("doc_id", "size", "source_size", "target", "taken",
                         F.get("takes", F.lit(0)).getField("position").alias("position"))
            .orderBy(F.col("position").asc_nulls_last(), "doc_id"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, with_text=False).select(
        "doc_id", "n_lines", "n_repeats", "n_nears", F.array_join("dropped", ",").alias("dropped"))


OP2_SQL = r"""
WITH lines AS (
  SELECT doc_id, u.place - 1 AS place, trim(u.line, E' \t\n\x0b\f\r') AS line
  FROM (SELECT doc_id, string_split(text, E'\n') AS ls FROM documents WHERE text IS NOT NULL) d,
       LATERAL (SELECT unnest(d.ls) AS line, generate_subscripts(d.ls, 1) AS place) u
), compared AS (
  SELECT * FROM lines WHERE line <> ''
), firsts AS (
  SELECT line, min((doc_id, place)) AS first, length(line) AS n FROM compared GROUP BY line
), near AS (
  SELECT DISTINCT b.line FROM firsts a JOIN firsts b
  ON b.n BETWEEN a.n - 2 AND a.n + 2 AND a.first < b.first AND least(a.n, b.n) >= 12
    AND levenshtein(a.line, b.line) <= least(2, least(a.n, b.n) // 12)
), judged AS (
  SELECT c.doc_id, c.place, (c.doc_id, c.place) <> f.first AS repeated,
         c.line IN (SELECT line FROM near) AS near
  FROM compared c JOIN firsts f USING (line)
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, E'\n')) END AS n_lines,
       coalesce(j.n_repeats, 0) AS n_repeats, coalesce(j.n_nears, 0) AS n_nears,
       coalesce(j.dropped, '') AS dropped
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) FILTER (repeated) AS n_repeats, count(*) FILTER (NOT repeated AND near) AS n_nears,
         string_agg(place, ',' ORDER BY place) FILTER (repeated OR near) AS dropped
  FROM judged GROUP BY doc_id) j USING (doc_id)
"""


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), TOKENIZER).withColumn(
        "length", F.col("length").cast("long"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id")


#: Block and allow rules (verdict, host, path); hosts whose pages are listed.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
LISTED_HOSTS = "(adult-x|casino-win|cheap-pills|free-bets|spam-farm)"


def listed_urls(pages: DataFrame) -> DataFrame:
    """The list that op5 filters by: all URLs seen on the listed hosts."""
    host, _ = urlfilter.url_parts(F.col("url"))
    return pages.select("url").filter(host.rlike(r"(^|\.)" + LISTED_HOSTS + r"\."))


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge_urls(pages, listed_urls(pages), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


OP5_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), canon AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^www\.', '')
                 || regexp_replace(path, '/+$', '') END AS canonical
  FROM parts
), listed AS (
  SELECT DISTINCT canonical FROM canon
  WHERE regexp_matches(host, '(^|\.)(adult-x|casino-win|cheap-pills|free-bets|spam-farm)\.')
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM canon
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/de/', 'net/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return toxicity.classify(docs, labels, keep=["doc_id", "lang"]).select(
        "doc_id", "held_out", "score", "predicted", "threshold", "toxic")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.history(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP8_SQL = """
WITH facts AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), firsts AS (
  SELECT payload_digest, min(page_id) AS first FROM facts WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM facts LEFT JOIN firsts USING (payload_digest)
"""


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                      "n_repeat_words", "base_failed", "kept", "mean_word_length",
                                      "symbols_per_word", "stop_word_ratio", "dup_line_ratio")


_STOPS = ", ".join(f"'{w}'" for w in sorted({x for v in quality.STOP_WORDS.values() for x in v.split()}))
OP9_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS c
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM cut)
), repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE c >= 2) GROUP BY doc_id
), base AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(list_sum(list_transform(ws, lambda x: length(x))) AS BIGINT) AS chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS n_lines,
         len(list_filter(ws, lambda x: lower(x) IN (""" + _STOPS + r"""))) AS n_stops
  FROM cut
), measured AS (
  SELECT b.doc_id, n_words, coalesce(chars, 0) AS word_chars, n_symbols, n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
         n_words < 50 OR 100 * coalesce(r.n, 0) > 50 * n_words AS base_failed,
         CASE WHEN n_words > 0 THEN coalesce(chars, 0) / n_words ELSE 0 END AS mean_word_length,
         CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbols_per_word,
         CASE WHEN n_words > 0 THEN n_stops / n_words ELSE 0 END AS stop_word_ratio,
         CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio
  FROM base b LEFT JOIN repeated r USING (doc_id)
)
SELECT *, NOT base_failed AND n_words <= 100000 AND mean_word_length BETWEEN 2 AND 14
          AND symbols_per_word <= 0.1 AND stop_word_ratio >= 0.02 AND dup_line_ratio <= 0.5 AS kept
FROM measured
"""


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_lm.score_held_out(_table(spark, sf_dir, "documents"))


def op11_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiers.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH found AS (
  SELECT row_number() OVER () AS r, doc_id, list_transform(
    regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
    lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ts
  FROM documents
), asked AS (
  SELECT DISTINCT item_id, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT item_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
        FROM benchmark)
), facts AS (
  SELECT CAST(count(*) FILTER (len(ts) > 0) AS BIGINT) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_all FROM found
), postings AS (
  SELECT r, doc_id, term, CAST(count(*) AS BIGINT) AS tf, any_value(n) AS n
  FROM (SELECT r, doc_id, CAST(len(ts) AS BIGINT) AS n, unnest(ts) AS term FROM found)
  GROUP BY r, doc_id, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, facts GROUP BY term
), scores AS (
  SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf)
           // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_all)))) AS BIGINT) AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term), facts GROUP BY item_id, r, doc_id
), ranked AS (
  SELECT item_id, doc_id, score,
         CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned.align(_table(spark, sf_dir, "documents"), TOKENIZER,
                         public_tokenizers.path("piece_bpe_32k.model"), digest=True).withColumnRenamed(
                             "groups", "groups_sha256")


QUERIES = {
    "op1_mix": (op1_mix, None),
    "op2_line_dedup": (op2_line_dedup, OP2_SQL),
    "op3_pack": (op3_pack, None),
    "op4_jaccard": (op4_jaccard, None),
    "op5_urls": (op5_urls, OP5_SQL),
    "op6_ann": (op6_ann, None),
    "op7_toxicity": (op7_toxicity, None),
    "op8_warc": (op8_warc, OP8_SQL),
    "op9_quality": (op9_quality, OP9_SQL),
    "op10_lm": (op10_lm, None),
    "op11_tiers": (op11_tiers, None),
    "op12_ranked": (op12_ranked, OP12_SQL),
    "op13_align": (op13_align, None),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
