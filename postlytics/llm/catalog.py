"""Registered queries of this subpackage and their DuckDB SQL.

Each query applies one operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (embedding_dedup, exact_dedup, hard_negatives, kneser_ney, minhash, mixing, packing, secret_scan, suffix_dedup,
               target_resampling, token_counts, topk, toxicity)
from .common import read_table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.train_and_score(read_table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.prefix_counts(read_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(read_table(spark, sf_dir, "documents"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(read_table(spark, sf_dir, "documents"))


def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_suffix_dedup, op2_top_k, op3_mix_sources, op4_minhash, op5_language_model, op6_token_counts, op7_toxicity,
                            op8_embedding_dedup, op9_pack, op10_secrets, op11_exact_dedup, op12_target_resampling,
                            op13_hard_negatives)}

ORACLE: dict[str, str] = {
    "op1_suffix_dedup": r"""
WITH raw AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT *, CAST(length(h) // 2 AS BIGINT) AS n_bytes FROM raw),
starts AS (SELECT r, h, unnest(range(0, n_bytes - 199)) AS s FROM sized WHERE n_bytes >= 200),
windows AS (SELECT r, s, md5_number(substr(h, 2 * s + 1, 400)) AS w FROM starts),
repeated AS (SELECT r, s FROM windows QUALIFY count(*) OVER (PARTITION BY w) > 1),
marked AS (SELECT r, s, CASE WHEN s > lag(s) OVER (PARTITION BY r ORDER BY s) + 200 THEN 1 ELSE 0 END AS opens FROM repeated),
numbered AS (SELECT r, s, sum(opens) OVER (PARTITION BY r ORDER BY s) AS span FROM marked),
spans AS (SELECT r, span, min(s) AS a, max(s) + 200 AS b FROM numbered GROUP BY 1, 2),
gaps AS (
  SELECT r, b AS a, lead(a) OVER (PARTITION BY r ORDER BY a) AS b FROM spans
  UNION ALL SELECT r, 0, min(a) FROM spans GROUP BY r),
rests AS (
  SELECT r, string_agg(substr(h, 2 * gaps.a + 1, 2 * (coalesce(gaps.b, n_bytes) - gaps.a)), '' ORDER BY gaps.a) AS rest
  FROM gaps JOIN sized USING (r) GROUP BY r),
removed AS (SELECT r, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r)
SELECT doc_id, n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM sized LEFT JOIN removed USING (r) LEFT JOIN rests USING (r)""",
    "op4_minhash": r"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingled AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
                                    ELSE w END) AS s FROM tokens),
sized AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n, s FROM shingled),
items AS (SELECT doc_id, n, unnest(s) AS shingle FROM sized),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared
  FROM items a JOIN items b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs WHERE 100 * shared >= 80 * (na + nb - shared)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS v, doc_id AS u FROM documents UNION SELECT r.v, e.b FROM reach r JOIN edges e ON r.u = e.a),
comps AS (SELECT v, min(u) AS component_id FROM reach GROUP BY v)
SELECT sized.doc_id, n AS n_shingles, component_id, sized.doc_id = component_id AS kept
FROM sized JOIN comps ON sized.doc_id = comps.v""",
    "op2_top_k": """
WITH fine AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM fine q JOIN fine c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op8_embedding_dedup": """
WITH RECURSIVE fine AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (SELECT vec_id AS v, vec_id AS w FROM embeddings UNION SELECT r.v, l.b FROM reach r JOIN links l ON r.w = l.a),
comps AS (SELECT v, min(w) AS component_id FROM reach GROUP BY v),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(counted.n, 0) AS n_links, comps.component_id, e.vec_id = comps.component_id AS kept
FROM embeddings e JOIN comps ON e.vec_id = comps.v LEFT JOIN counted ON counted.a = e.vec_id""",
    "op3_mix_sources": r"""
WITH sized AS (
  SELECT doc_id, text, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight, 3 * source_size AS cap
  FROM per),
steps AS (
  SELECT *, row_number() OVER o AS place,
    CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS lev
  FROM weighed WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST)),
chosen AS (SELECT arg_min(lev, place) AS lev FROM steps WHERE lev * weight <= cap),
targets AS (
  SELECT source, source_size, coalesce(least(CAST(cap AS DOUBLE), chosen.lev * weight), CAST(cap AS DOUBLE)) AS target
  FROM steps LEFT JOIN chosen ON true),
rated AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
    CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, '')))), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
  CAST(least(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END, 3) AS BIGINT) * size AS taken
FROM rated""",
    "op11_exact_dedup": r"""
WITH plain AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST, r) = 1 AS kept, sha256(t) AS text_sha256
FROM plain""",
    "op12_target_resampling": r"""
WITH crc_table AS (
  SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
    CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) ORDER BY n) AS tab
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS n)),
texts AS (
  SELECT 0 AS side, doc_id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
worded AS (
  SELECT row_number() OVER () AS r, side, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
features AS (SELECT r, side, unnest(w) AS word FROM worded),
spelled AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM features)),
hashed AS (
  SELECT word, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(range(1, length(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT))),
    lambda c, b: xor(tab[1 + (xor(c, b) & 255)], c >> 8))) % 10000 AS bucket
  FROM spelled, crc_table),
placed AS (SELECT r, side, bucket FROM features JOIN hashed USING (word)),
counted AS (
  SELECT bucket, CAST(count(*) FILTER (side = 0) AS DOUBLE) AS s, CAST(count(*) FILTER (side = 1) AS DOUBLE) AS t
  FROM placed GROUP BY bucket),
totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM counted),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000)))) AS BIGINT) AS gain
  FROM counted, totals),
summed AS (
  SELECT r, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM placed JOIN gains USING (bucket) WHERE side = 0 GROUP BY r),
drawn AS (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM worded LEFT JOIN summed USING (r) WHERE side = 0),
scored AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM drawn),
chosen AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS place, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN chosen USING (r)""",
    "op13_hard_negatives": """
WITH fine AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM fine a JOIN fine c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
placed AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM placed WHERE rank <= 5""",
}
