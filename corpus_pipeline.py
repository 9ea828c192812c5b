"""The corpus pipeline: five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's result as Parquet into the shared folder and rereads it as the
next stage's documents.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.llm import dart_minhash, line_dedup, packing, quality_cnn, secrets
from cartwright.llm.common import load, materialize, utf8
from cartwright.llm.queries import END_ID, LINE_MIN_DOCS, WINDOW, WORD_TOKENIZER


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    net = quality_cnn.train(docs, load(spark, sf_dir, "labels"))
    return docs.where(quality_cnn.score_column(net, spark) >= quality_cnn.THRESHOLD)


def _row(docs: DataFrame):
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")


def _with_text(rows: DataFrame, text, columns: list[str]) -> DataFrame:
    """The columns, held by the struct ``row``, with another text and its length."""
    new = {"text": text, "n_chars": F.length(text).cast("bigint")}
    return rows.select(*(new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in columns))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in ten or more documents go."""
    return _with_text(line_dedup.dedup_lines(docs, LINE_MIN_DOCS, keep_first=False), F.col("kept").cast("string"),
                      docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays: the one with the least id, NULL last
    (of equal ids, the one whose text hashes lowest; of repeated rows, one)."""
    classes = dart_minhash.near_duplicates(docs)
    least = classes.groupBy("class_key").agg(
        F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("i"), F.col("text_key").alias("t"))).alias("m"))
    rows = docs.select(_row(docs), F.col("doc_id").alias("id"), F.xxhash64(utf8()).alias("text_hash"))
    kept = rows.join(least.select("m.i", "m.t"), F.col("id").eqNullSafe(F.col("i")) & (F.col("text_hash") == F.col("t")),
                     "left_semi")
    return kept.groupBy("id", "text_hash").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are redacted within the texts."""
    rows = docs.select(_row(docs), secrets.redacted_column().alias("redacted"))
    return _with_text(rows, F.col("redacted"), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    import public_tokenizers

    return packing.digest_pieces(packing.pack_documents(
        docs, public_tokenizers.path(WORD_TOKENIZER), WINDOW, END_ID))


STAGES = [("quality", quality), ("line_dedup", lines), ("near_duplicates", near_duplicates),
          ("secret_scan", secret_scan), ("packing", pack)]

ORACLE_SQL = None   # a trained network and randomness tests are beyond SQL; tests/llm has a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{name}")
    return docs
