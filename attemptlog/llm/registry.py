"""The corpus operators as queries over the given tables, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from attemptlog.llm import (
    bpe,
    collocations,
    filter_audit,
    html_text,
    lbl,
    license_scan,
    line_dedup,
    minhash,
    mixing,
    pq_dedup,
    quality,
    secret_scan,
    topk,
)
from attemptlog.llm.common import read

PATTERN = public_tokenizers.PATTERN
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return topk.search(vectors, "vec_id", "embedding", "id % 20 = 0", 20)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), "doc_id", "text", "source")


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), "doc_id", "text", 85)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return bpe.digests(docs, "doc_id", "text", RANKS, PATTERN)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return quality.classify(docs, "doc_id", labels, "doc_id", "quality")


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lbl.score(read(spark, sf_dir, "documents"), "doc_id", "text")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(read(spark, sf_dir, "documents"), "doc_id", "text")


def op8_pq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return pq_dedup.near_duplicates(vectors, "vec_id", "embedding", "label", 0.98)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(read(spark, sf_dir, "documents"), "doc_id", "text")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(read(spark, sf_dir, "documents"), "doc_id", "text")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return filter_audit.audit(docs, "doc_id", "text", "source", labels, "doc_id", "quality", "toxic")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read(spark, sf_dir, "documents"), "text", "lang")


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"), "page_id", "url", "html")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_top_k": op1_top_k,
    "op2_mix_sources": op2_mix_sources,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_quality": op5_quality,
    "op6_lm_scores": op6_lm_scores,
    "op7_line_dedup": op7_line_dedup,
    "op8_pq_dedup": op8_pq_dedup,
    "op9_license_scan": op9_license_scan,
    "op10_secret_scan": op10_secret_scan,
    "op11_filter_audit": op11_filter_audit,
    "op12_collocations": op12_collocations,
    "op13_html_text": op13_html_text,
}
ORACLE: dict[str, str] = {
    "op1_top_k": """
WITH v AS (
  SELECT DISTINCT vec_id,
    list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 20""",
    "op3_minhash_dedup": """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS t
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 5 THEN [array_to_string(t, ' ')]
    ELSE list_transform(range(1, len(t) - 3), lambda i: array_to_string(t[i:i + 4], ' ')) END) AS g
  FROM w
), e AS MATERIALIZED (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s
), l AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y FROM e AS a JOIN e AS b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), r(x, y) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x
), c AS (SELECT x, min(y) AS y FROM r GROUP BY x)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, c.y AS component_id, s.doc_id = c.y AS kept
FROM s JOIN c ON s.doc_id = c.x""",
    "op8_pq_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS MATERIALIZED (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v AS a JOIN v AS b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), r(x, y) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x
), c AS (SELECT x, min(y) AS y FROM r GROUP BY x),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT c.x AS vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.y AS component_id, c.x = c.y AS kept
FROM c LEFT JOIN n USING (x)""",
    "op11_filter_audit": """
WITH RECURSIVE d AS (
  SELECT coalesce(source, '') AS part, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), f AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t
), k AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels GROUP BY doc_id
), m AS (
  SELECT part, (CASE WHEN len(w) < 50 THEN 'A' ELSE '' END) ||
    (CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END) ||
    (CASE WHEN 100 * length(regexp_replace(d.t, '[^A-Z]', '', 'g')) > 5 * length(d.t) THEN 'C' ELSE '' END) ||
    (CASE WHEN regexp_matches(d.t, '[#$%&*|]') THEN 'D' ELSE '' END) ||
    (CASE WHEN d.doc_id > f.first THEN 'E' ELSE '' END) AS fails,
    coalesce(k.good, false) AS good, coalesce(k.toxic, false) AS toxic
  FROM d JOIN f ON d.t = f.t LEFT JOIN k ON d.doc_id = k.doc_id
), c AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS g, count(*) FILTER (WHERE toxic) AS x
  FROM m GROUP BY part, fails
), o(o) AS (
  SELECT '' UNION ALL SELECT o || l FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) WHERE NOT contains(o, l)
), s AS (
  SELECT o AS filter_order, i AS step, substr(o, i, 1) AS filter, substr(o, 1, i - 1) AS before
  FROM o, (SELECT unnest(range(1, 6)) AS i) WHERE length(o) = 5
), e AS (
  SELECT part, filter_order, step, filter,
    sum(n) FILTER (WHERE translate(fails, before || filter, '') = fails) AS kept,
    sum(n) FILTER (WHERE contains(fails, filter) AND translate(fails, before, '') = fails) AS removed,
    sum(n) FILTER (WHERE contains(fails, filter) AND translate(fails, before, '') <> fails) AS redundant,
    sum(n) FILTER (WHERE fails = filter) AS unique_fails,
    sum(g) FILTER (WHERE contains(fails, filter) AND translate(fails, before, '') = fails) AS good_lost,
    sum(x) FILTER (WHERE contains(fails, filter) AND translate(fails, before, '') = fails) AS toxic_lost
  FROM s, c GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
  CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
  CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
  CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, filter), 0) AS BIGINT) AS shapley, filter
FROM e""",
    "op12_collocations": """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w
  FROM documents
), q AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p
), g AS (
  SELECT lang, w[i:i + k - 1] AS g, count(*) AS f
  FROM q, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL
), t AS (SELECT lang, sum(f) AS n FROM g WHERE len(g) = 1 GROUP BY lang
), h AS MATERIALIZED (SELECT * FROM g WHERE f >= 30
), x AS (SELECT lang, g, f AS a, unnest(range(1, len(g))) AS k FROM h WHERE len(g) > 1
), y AS (
  SELECT x.lang, x.g, x.a, x.k, l.f AS l, r.f AS r, (CAST(2000000 AS HUGEINT) * x.a) // (l.f + r.f) AS score
  FROM x JOIN h AS l ON x.lang = l.lang AND x.g[:x.k] = l.g JOIN h AS r ON x.lang = r.lang AND x.g[x.k + 1:] = r.g
), z AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), s AS (
  SELECT lang, u.g[u.b:u.b + u.m - 1] AS g, max(f) AS longer FROM (
    SELECT lang, g, f, m, unnest(range(1, len(g) - m + 2)) AS b FROM (SELECT *, unnest(range(2, len(g))) AS m FROM h WHERE len(g) > 2)
  ) AS u GROUP BY ALL
), v AS (
  SELECT z.*, array_to_string(z.g, ' ') AS phrase FROM z LEFT JOIN s ON z.lang = s.lang AND z.g = s.g
  WHERE s.longer IS NULL OR 100 * CAST(s.longer AS HUGEINT) < 80 * CAST(z.a AS HUGEINT)
), w AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM v)
SELECT w.lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM w JOIN t ON w.lang = t.lang WHERE rank <= 2000""",
}
