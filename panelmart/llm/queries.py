"""The registered queries of this subpackage's operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmart.llm import (
    chat, embeddup, fptree, hardneg, html, minhash, mixing, neighbours, nnlspacking, packing, quality, sharding, tokencount,
)
from panelmart.llm.common import cut_lineage, table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenise(table(spark, sf_dir, "documents"))
    stored = cut_lineage(pieces.select("doc_id", "piece", "start", "length",
                                       F.crc32("ids").alias("ids_crc32")), "pieces")
    return packing.place(stored)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), n_words=3, percent=85)


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.resample(docs, quality.good_labels(table(spark, sf_dir, "labels"))).select(
        "doc_id", "log_ratio", "key", "kept")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", marks), (-1, 1, "assistant", marks)],
                                  "conv_id long, turn long, role string, text string")
    convs = table(spark, sf_dir, "conversations").select(extra.columns).unionByName(extra)
    return chat.read_back(chat.format_chat(convs))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", F.col("mix_size").alias("size"),
                      F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
                      (F.col("mix_size") * F.size("mix_draws")).alias("taken"),
                      F.col("mix_draws.shard").alias("shards"), F.col("mix_draws.place").alias("places"))


def op11_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nnlspacking.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fptree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return hardneg.mine(hardneg.with_noise(vectors, F.col("vec_id") % 50 == 0))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One query for each operator."""
    return {f.__name__: f for f in (
        op1_best_fit_packing, op2_html_extraction, op3_sharding, op4_nearest_neighbours,
        op5_minhash_near_dedup, op6_embedding_near_dedup, op7_token_counts, op8_quality_classifier, op9_chat_formatting,
        op10_source_mixing, op11_nnls_packing, op12_lexical_search,
        op13_hard_negatives)}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the operators that SQL can express."""
    return {"op4_nearest_neighbours": OP4, "op6_embedding_near_dedup": OP6, "op5_minhash_near_dedup": OP5, "op9_chat_formatting": OP9,
            "op12_lexical_search": OP12, "op13_hard_negatives": OP13}


#: Escaping adds one character for each control string or escape character.
OP9 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), m AS (
  SELECT *, length(regexp_replace(text, '\\|</?s>|\[/?INST\]|<</?SYS>>|<</?ROLE>>|<</TURN>>', '\0_', 'g')) AS chars,
    CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 15 WHEN 'assistant' THEN 5 END AS marks
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars + marks) + 3 AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""

#: Shingle sets, pairs that share a shingle, and the closure of the links.
OP5 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x != '') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS sh FROM w
), e AS (
  SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), l AS (
  SELECT a, b FROM p UNION ALL SELECT b, a FROM p
), r AS (
  SELECT doc_id, doc_id AS to_id FROM s UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.to_id = l.a
), c AS (
  SELECT doc_id, min(to_id) AS component_id FROM r GROUP BY doc_id
)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM s JOIN c USING (doc_id)
"""

#: Vectors that take part, with their squared length added up in order.
VECTORS = """v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x != 0)) > 0
), u AS (
  SELECT vec_id, label, e, sqrt(list_reduce(list_transform(e, lambda x: x * x), lambda x, y: x + y)) AS l FROM v
)"""

COSINE = "list_reduce(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2]), lambda x, y: x + y) / (a.l * b.l)"

OP4 = f"""
WITH {VECTORS}, s AS (
  SELECT a.vec_id AS query_id, b.vec_id, {COSINE} AS score
  FROM u a JOIN u b ON a.vec_id % 50 = 0 AND a.vec_id != b.vec_id AND len(a.e) = len(b.e)
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score
FROM s QUALIFY rank <= 5
"""

OP6 = f"""
WITH RECURSIVE {VECTORS}, l AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM u a JOIN u b ON a.label = b.label AND a.vec_id != b.vec_id AND len(a.e) = len(b.e)
  WHERE {COSINE} >= 0.93
), r AS (
  SELECT vec_id, vec_id AS to_id FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.to_id = l.a
), c AS (
  SELECT vec_id, min(to_id) AS component_id FROM r GROUP BY vec_id
), n AS (
  SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a
)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""

#: Every document that shares a term with an item, scored.
OP12 = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
), i AS (
  SELECT DISTINCT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM benchmark
), q AS (
  SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(t) AS term FROM i) GROUP BY ALL
), c AS (
  SELECT count(*) FILTER (len(t) > 0) AS docs, CAST(sum(len(t)) AS BIGINT) AS total FROM d
), p AS (
  SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, len(t) AS n, unnest(t) AS term FROM d) GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM p CROSS JOIN c GROUP BY term
), s AS (
  SELECT item_id, row, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total)))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN w USING (term) CROSS JOIN c GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20
"""

#: All inner products of anchors and rows, exact in doubles.
OP13 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id != b.vec_id AND len(a.e) = len(b.e)
), p AS (
  SELECT a, b AS p, score AS ps FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5
)
SELECT s.a AS anchor_id, p AS positive_id, CAST(row_number() OVER (PARTITION BY s.a, p ORDER BY score DESC, b) AS INTEGER) AS rank,
  b AS negative_id, ps AS positive_score, score AS negative_score
FROM s JOIN p ON s.a = p.a WHERE NOT same AND 50 * ps <= 100 * score AND 100 * score <= 95 * ps QUALIFY rank <= 3
"""
