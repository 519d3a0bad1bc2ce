"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, embedding_dedup, hard_negatives, hilbert, html_text, language, mixing, ngram_join, packing, quality, sharding, token_counts, whitening
from tidemark.llm.frames import held_out, table


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(table(spark, sf_dir, "documents"), n=5, percent=80)


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
r(doc_id, reach) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM r JOIN l ON r.reach = l.x),
c AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY 1),
k AS (SELECT x AS doc_id, count(*) AS n_links FROM l GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, coalesce(k.n_links, 0) AS n_links
FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = quality.classify(docs.select("doc_id", "text"), docs, labels.where(~held_out()), max_labelled=4000)
    score = F.col("quality_vote.score")
    return out.select("doc_id", held_out().alias("held_out"), score.alias("score"), (score >= 0.3).cast("int").alias("predicted"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return sharding.shard(table(spark, sf_dir, "documents"), shards=16, seed=11).select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), max_epochs=3, seed=7)
    return out.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source),
w AS (SELECT *, ([5.0, 2.0, 1.0]::DOUBLE[])[((place - 1) % 3 + 1)::INT] AS weight FROM s),
r AS (SELECT *, 3 * source_size AS cap, 3 * source_size / weight AS ratio FROM w),
l AS (SELECT *, sum(source_size) OVER () AS words,
        (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) >= ratio AS capped
      FROM r WINDOW before AS (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE
        (words - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())::DOUBLE / sum(CASE WHEN capped THEN 0.0::DOUBLE ELSE weight END) OVER () * weight END AS target FROM l),
k AS (SELECT d.doc_id, d.size, d.u, t.source, t.source_size, t.target,
        CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY u) AS end_of, sum(size) OVER (PARTITION BY source, u) AS same FROM k)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN target - whole * source_size > 0 AND end_of - same / 2.0 <= target - whole * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link(table(spark, sf_dir, "embeddings"), least=0.9)


OP7_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r(vec_id, reach) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.y FROM r JOIN l ON r.reach = l.x),
c AS (SELECT vec_id, min(reach) AS component_id FROM r GROUP BY 1),
k AS (SELECT x AS vec_id, count(*) AS n_links FROM l GROUP BY 1)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN k USING (vec_id)
"""


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_text.extract(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = language.identify(docs.select("doc_id", "text"), docs.where(~held_out()), max_chars=3_000_000)
    return out.select("doc_id", held_out().alias("held_out"), "language.lang_pred", "language.score", "language.rejected")


def op5_hilbert_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20
"""


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=1, length=2048)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=4, scale=256)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0, positives=5, negatives=10, low=30, high=90, scale=256)


OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT DISTINCT * FROM v WHERE vec_id % 100 = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = v.label AS same, v.vec_id, list_inner_product(a.e, v.e)::BIGINT AS score
      FROM a JOIN v ON a.vec_id <> v.vec_id AND len(a.e) = len(v.e)),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank
      FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.search(docs, table(spark, sf_dir, "benchmark"), window=10, out="found")
    items = F.col("found.items")
    return found.select(
        "doc_id", "found.n_words", "found.n_hit", F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (F.col("found.n_hit") > 0).alias("contaminated"),
    )


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
i AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
p AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS size, unnest(list_transform(range(1, greatest(len(ws) - 9, 1) + 1), lambda k: array_to_string(ws[k:k + 9], ' '))) AS phrase
  FROM i WHERE len(ws) > 0),
l AS (SELECT DISTINCT size FROM p),
w AS (SELECT doc_id, size, unnest(range(1, len(ws) - size + 2)) AS place, unnest(list_transform(range(1, len(ws) - size + 2), lambda k: array_to_string(ws[k:k + size - 1], ' '))) AS phrase
      FROM d JOIN l ON len(ws) >= size),
m AS (SELECT doc_id, place, w.size, item_id FROM w JOIN p ON w.size = p.size AND w.phrase = p.phrase),
h AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(place, place + size)) AS word FROM m) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_quality": op2_quality,
    "op3_sharding": op3_sharding,
    "op4_mixing": op4_mixing,
    "op5_hilbert_search": op5_hilbert_search,
    "op6_packing": op6_packing,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_html": op8_html,
    "op9_token_counts": op9_token_counts,
    "op10_language": op10_language,
    "op11_whitening": op11_whitening,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_decontamination": op13_decontamination,
    "pipeline": corpus_pipeline.run,
}
ORACLE_SQL: dict[str, str] = {
    "op1_ngram_join": OP1_SQL,
    "op4_mixing": OP4_SQL,
    "op5_hilbert_search": OP5_SQL,
    "op7_embedding_dedup": OP7_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_decontamination": OP13_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
