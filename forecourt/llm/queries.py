"""The ``opN_<name>`` queries: each operator over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm import (
    bpe, divergence, langid, packing, periodic, quality_model, quality_rules, simhash, substring, token_files, topk,
    url_filter, warc,
)
from forecourt.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return add


def quality_rules_sql(docs: str = "documents") -> str:
    """Words, lines and windows one row each, then the same sketches and fences in SQL."""
    q = quality_rules
    values = {m: f"{num} * {k} // n_words" for m, (num, k, _, _) in q.MEASURES.items()}
    unpivot = " UNION ALL ".join(
        f"SELECT lang, source, '{m}' AS measure, {v} AS v FROM counted WHERE NOT base_failed" for m, v in values.items())
    chosen = {x: f"CASE WHEN a.support >= {q.MIN_SUPPORT} THEN a.{x} WHEN b.support >= {q.MIN_SUPPORT} THEN b.{x}"
                 f" ELSE c.{x} END" for x in ("q25", "q50", "q75")}
    cols, fits = [], []
    for m, (_, _, low, slack) in q.MEASURES.items():
        cols.append(f"max(CASE WHEN measure = '{m}' THEN q50 + {q.SPREAD} * (q50 - q25) + {slack} END) AS hi_{m}")
        fits.append(f"{values[m]} <= f.hi_{m}")
        if low:
            cols.append(f"max(CASE WHEN measure = '{m}' THEN q50 - {q.SPREAD} * (q75 - q50) - {slack} END) AS lo_{m}")
            fits.append(f"{values[m]} >= f.lo_{m}")

    def level(*by: str) -> str:
        keys = ", ".join((*by, "measure"))
        return f"""SELECT {keys}, max(support) AS support,
          min(CASE WHEN 4 * below >= support THEN top END) AS q25,
          min(CASE WHEN 4 * below >= 2 * support THEN top END) AS q50,
          min(CASE WHEN 4 * below >= 3 * support THEN top END) AS q75
        FROM (SELECT {keys}, sum(n) OVER (PARTITION BY {keys}) AS support,
                     sum(n) OVER (PARTITION BY {keys} ORDER BY bucket) AS below,
                     CASE WHEN bucket < 64 THEN bucket ELSE ((bucket % 32 + 33) << CAST(bucket // 32 - 1 AS INT)) - 1 END AS top
              FROM (SELECT {keys}, bucket, sum(n) AS n FROM sketch GROUP BY ALL))
        GROUP BY ALL"""

    return f"""
WITH rows_ AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM {docs}
), w AS (
  SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM rows_
), win AS (
  SELECT rid, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3
), rep AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i], ws[i + 1], ws[i + 2]) AS n FROM win)
  WHERE n >= 2
), cov AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) AS o(k) GROUP BY rid
), base AS (
  SELECT w.rid, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '{q.SYMBOLS}', '')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN cov ON w.rid = cov.rid
), counted AS (
  SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM base
), sketch AS (
  SELECT lang, source, measure, CASE WHEN v < 32 THEN v ELSE (length(bin(v)) - 6) * 32 + (v >> CAST(length(bin(v)) - 6 AS INT)) END
         AS bucket, count(*) AS n
  FROM ({unpivot}) GROUP BY ALL
), a AS ({level("lang", "source")}), b AS ({level("lang")}), c AS ({level()}), chosen AS (
  SELECT a.lang, a.source, a.measure, {chosen["q25"]} AS q25, {chosen["q50"]} AS q50, {chosen["q75"]} AS q75
  FROM a JOIN b ON a.lang IS NOT DISTINCT FROM b.lang AND a.measure = b.measure JOIN c ON a.measure = c.measure
), f AS (SELECT lang, source, {", ".join(cols)} FROM chosen GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       CASE WHEN base_failed THEN false ELSE coalesce({" AND ".join(fits)}, true) END AS kept
FROM counted LEFT JOIN f ON counted.lang IS NOT DISTINCT FROM f.lang AND counted.source IS NOT DISTINCT FROM f.source
"""


@query("op4_quality_rules", quality_rules_sql())
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read_table(spark, sf_dir, "documents", ["doc_id", "lang", "source", "text"]))


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op5_topk", TOPK_SQL)
def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.materialise(topk.integer_vectors(read_table(spark, sf_dir, "embeddings")), "vectors")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def url_filter_sql() -> str:
    """The rules tried one by one on every row; no index, no tokens."""
    domain = " UNION ALL ".join(
        f"SELECT '{a}' AS action, '{h}' AS rhost, '{p}' AS rpath" for a, h, p in url_filter.DOMAIN_RULES)
    patterns = [url_filter.pattern_rule(p) for p in url_filter.PATTERNS]

    def any_of(action: str) -> str:
        return " OR ".join(f"regexp_matches(p.url, '(?i){r.regex}')" for r in patterns if r.action == action)

    return f"""
WITH rules AS ({domain}), u AS (
  SELECT page_id, url, coalesce(strpos(url, '://'), 0) AS pos,
         substr(url, strpos(url, '://') + 3) AS rest FROM pages
), p AS (
  SELECT page_id, url,
         CASE WHEN pos = 0 THEN '' ELSE translate(regexp_extract(rest, '^[^/?#]*'),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS host,
         CASE WHEN pos = 0 THEN '' ELSE regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) END AS path
  FROM u
), d AS (SELECT DISTINCT url, host, path FROM p), f AS (
  SELECT d.url, rhost || rpath AS rule, action,
         row_number() OVER (PARTITION BY d.url ORDER BY length(rhost || rpath) DESC, length(rhost) DESC, action DESC) AS k
  FROM d JOIN rules ON (host = rhost OR suffix(host, '.' || rhost)) AND prefix(path, rpath)
)
SELECT page_id, host, path, f.rule AS rule,
       CASE WHEN f.rule IS NOT NULL THEN f.action WHEN ({any_of('block')}) AND NOT ({any_of('allow')}) THEN 'block' ELSE 'allow' END AS verdict
FROM p LEFT JOIN f ON p.url = f.url AND f.k = 1
"""


@query("op6_url_filter", url_filter_sql())
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(read_table(spark, sf_dir, "pages")).drop("n_candidates")


#: Vocabulary files, by name in the ``public_tokenizers`` package.
WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"


@query("op7_token_files")
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return token_files.token_files(docs, public_tokenizers.path(WORD_VOCABULARY))


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@query("op2_substring")
def op2_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_report(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return packing.pack_documents(docs, public_tokenizers.path(BYTE_VOCABULARY))


@query("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return bpe.bpe_digests(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def fold(modulus: int) -> F.Column:
    """crc32 of the id as text, modulo ``modulus``; null without an id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


@query("op3_langid")
def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    found = langid.identify(docs, docs.where(fold(5) != 0))
    held_out = F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "rejected", "cross_entropy")


@query("op9_quality_model")
def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    labels = quality_model.quality_labels(read_table(spark, sf_dir, "labels", ["doc_id", "quality"]))
    found = quality_model.classify(docs, labels, ["doc_id"])
    held_out = F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "score", "predicted")


@query("op11_periodic")
def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), plant=True)


#: The digest of the payloads, five hexadecimal digits to four base 32 ones, and the first page of each payload.
WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages), h AS (
  SELECT *, upper(sha1(body)) AS hex, row_number() OVER w AS k, first_value(page_id) OVER w AS first_page
  FROM p WINDOW w AS (PARTITION BY body ORDER BY page_id NULLS LAST)
), g AS (
  SELECT *, list_transform(range(0, 8), lambda i: list_sum(list_transform(range(0, 5), lambda j:
         CAST(strpos('0123456789ABCDEF', substr(hex, CAST(5 * i + j + 1 AS INTEGER), 1)) - 1 AS INTEGER) << CAST(16 - 4 * j AS INTEGER)))) AS v
  FROM h
)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST(v[i // 4 + 1] AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) % 32 + 1 AS INTEGER), 1)), '')
         AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k > 1 THEN first_page END AS refers_to
FROM g
"""


@query("op13_warc", WARC_SQL)
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]))


#: Terms one row each, the counts of kept terms, and every pair of sources term by term.
DIVERGENCE_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), w AS (
  SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d
), kept AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT id) >= {divergence.MIN_DOCS}),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
lc AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
lt AS (SELECT lang, sum(n) AS total FROM c GROUP BY lang),
gt AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
g AS (SELECT d.lang, d.source, coalesce(max(total), 0) AS total FROM d LEFT JOIN gt USING (lang, source) GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
         CAST(1 + {divergence.SCALE} * CAST(coalesce(c.n, 0) + 2 AS HUGEINT) // CAST(g.total + 2 * v AS HUGEINT) AS BIGINT) AS p
  FROM g JOIN kept ON g.lang = kept.lang JOIN sizes ON g.lang = sizes.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
), q AS (
  SELECT lc.lang, lc.term,
         CAST(1 + {divergence.SCALE} * CAST(lc.n + 2 AS HUGEINT) // CAST(lt.total + 2 * v AS HUGEINT) AS BIGINT) AS q
  FROM lc JOIN lt ON lc.lang = lt.lang JOIN sizes ON lc.lang = sizes.lang
), pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS f
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL
  SELECT p.lang, source, 'term', p.term, CAST((p - q) * (p - q) // (p + q) AS BIGINT)
  FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM found
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {divergence.TOP_TERMS}
"""


@query("op12_divergence", DIVERGENCE_SQL)
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(read_table(spark, sf_dir, "documents", ["lang", "source", "text"]))
