"""The queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bitpack, counts, ctw, decontaminate, embeddings, html, langid, licenses, merkle, packing, simhash, warc, whitening
from .common import table
from .oracle import ORACLE_SQL  # noqa: F401


def op1_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ctw.scores(table(spark, sf_dir, "documents"), ~ctw.held_out("doc_id", 10, 0))
    return scored.select(F.col("id").alias("doc_id"), (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def capture_digests(captures: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of assembled captures."""
    again = F.col("response.type") == "revisit"
    return captures.select(
        F.col("capture_id").cast("long").alias("page_id"), F.when(again, F.col("referred.payload_bytes")).otherwise(F.col("response.payload_bytes")).alias("payload_bytes"),
        F.when(again, F.col("referred.payload_digest")).otherwise(F.col("response.payload_digest")).alias("payload_digest"), F.col("response.type").alias("record_type"), F.when(again, F.col("referred.capture_id").cast("long")).alias("refers_to"),
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture_digests(warc.captures(warc.write(table(spark, sf_dir, "pages"))))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = ctw.held_out("doc_id", 3, 1)
    found = langid.labelled(docs, langid.fit(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_bitpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitpack.read(bitpack.write(table(spark, sf_dir, "documents")))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(table(spark, sf_dir, "pages"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.counted(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES = {
    "op1_ctw": op1_ctw,
    "op2_packing": op2_packing,
    "op3_decontaminate": op3_decontaminate,
    "op4_warc": op4_warc,
    "op5_simhash": op5_simhash,
    "op6_langid": op6_langid,
    "op7_embeddings": op7_embeddings,
    "op8_bitpack": op8_bitpack,
    "op9_licenses": op9_licenses,
    "op10_html": op10_html,
    "op11_token_counts": op11_token_counts,
    "op12_merkle": op12_merkle,
    "op13_whitening": op13_whitening,
}
