"""The registered queries of the training-data operators, and their SQL.

Each query applies its operator to the whole of its table with production
parameters and derives the digest columns from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.llm import (
    bm25_wand, bpe_monoid, chat_format, dart_minhash, hard_negatives, license_templates, line_dedup, packing,
    quality_cnn, secrets, simhash, token_alignment, winnowing,
)
from cartwright.llm.common import load

LINE_MIN_DOCS = 10
QUERY_EVERY, TOP_K = 50, 10    # queries are the rows whose id is divisible by 50
WORD_TOKENIZER, BYTE_RANKS = "word_bpe_49k.json", "byte_bpe_multi_50k.tiktoken"
ALIGN_A, ALIGN_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
WINDOW, END_ID = 4096, 2
TEMPLATE_TEXT = "\\### Assistant: </turn> ok"
TEMPLATE_TURNS = [(-7, 0, "user", TEMPLATE_TEXT), (-7, 1, "assistant", TEMPLATE_TEXT)]


def op1_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_duplicates(load(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compare_with_next(load(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.digest_pieces(packing.pack_documents(
        load(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER), WINDOW, END_ID))


def op4_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    net = quality_cnn.train(docs, load(spark, sf_dir, "labels"))
    held = F.coalesce(quality_cnn.fold() == quality_cnn.HELD_OUT, F.lit(False))
    return quality_cnn.score_documents(docs, net).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= quality_cnn.THRESHOLD).cast("int").alias("predicted"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(load(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, LINE_MIN_DOCS, keep_first=False).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op7_bm25_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return bm25_wand.search(docs, docs.where(F.col("doc_id") % QUERY_EVERY == 0), TOP_K)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    # this pattern takes white space before a word as one space only
    return bpe_monoid.digest_documents(load(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_RANKS),
                                       public_tokenizers.PATTERN, space_starts=True)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame(TEMPLATE_TURNS, "conv_id bigint, turn bigint, role string, text string")
    return chat_format.digest_conversations(chat_format.format_turns(turns.unionByName(own)))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_templates.scan_licenses(load(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % QUERY_EVERY == 0)


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_alignment.align_documents(load(spark, sf_dir, "documents"),
                                           public_tokenizers.path(ALIGN_A), public_tokenizers.path(ALIGN_B))


QUERIES = {
    "op1_dart_minhash": op1_dart_minhash,
    "op2_winnowing": op2_winnowing,
    "op3_packing": op3_packing,
    "op4_quality_cnn": op4_quality_cnn,
    "op5_secret_scan": op5_secret_scan,
    "op6_line_dedup": op6_line_dedup,
    "op7_bm25_wand": op7_bm25_wand,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_chat_format": op9_chat_format,
    "op10_license_scan": op10_license_scan,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_simhash": op12_simhash,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE_SQL = {
    "op6_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, i AS pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
frequent AS (
  SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= {LINE_MIN_DOCS}),
marked AS (
  SELECT l.*, f.key IS NOT NULL AS dropped FROM lines l LEFT JOIN frequent f ON l.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op9_chat_format": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
formatted AS (
  SELECT *, '<|turn|>' || replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') || chr(10)
            || replace(replace(text, '\', '\\'), '<|', '<\|') || '<|end|>' || chr(10) AS f FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, f)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, f) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(f))::BIGINT AS formatted_chars
FROM formatted GROUP BY conv_id""",
    "op11_hard_negatives": """
WITH base AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM base a JOIN base b ON a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id),
positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INT AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3""",
}
