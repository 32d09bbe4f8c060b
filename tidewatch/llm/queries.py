"""Registered queries of the training-data operators, each over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import new_path

from . import clustering, decontaminate, lbl, mixing, neardup, pii, quality, repair, segment, sharding, substrings, tokencount, warc
from .rows import small_batches

#: A public vocabulary of 32,000 pieces; any SentencePiece model file will do.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write(_table(spark, folder, "pages"), path)
    return warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_minhash_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, folder, "documents"), width=3, percent=85)


def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Encode with the 4 best segmentations, decode the best, compare with the text."""
    return segment.encode(_table(spark, folder, "documents"), VOCABULARY, verify=True, columns=["doc_id"]).select(
        "row.doc_id", F.size("ids").cast("long").alias("n_pieces"), "score",
        F.transform("others", lambda o: o["score"]).alias("other_scores"), F.xxhash64("ids").alias("ids_hash"), "round_trip")


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.spans(_table(spark, folder, "documents"))
    return found.select(
        "row.doc_id", *(pii.count(kind).alias(f"n_{kind}") for kind in pii.BASE),
        F.sha2(pii.listed(pii.BASE), 256).alias("base_sha256"), pii.listed([*pii.BASE, *pii.EXTRA]).alias("spans"),
    )


def op5_extendible_sharding(spark: SparkSession, folder: str) -> DataFrame:
    found = sharding.shard(_table(spark, folder, "documents"), limit=16 << 20)
    return found.select("row.doc_id", "n_bytes", "shard", "depth", "shard_bytes", "shard_rows")


def op6_lbl_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lbl.language_model(_table(spark, folder, "documents"))


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(_table(spark, folder, "documents"), columns=["doc_id", "lang"]).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "loss")


def op8_suffix_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark"), columns=["doc_id"])
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"), "longest",
    )


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokencount.token_counts(_table(spark, folder, "documents"), VOCABULARY, columns=["doc_id"]).select(
        "row.doc_id", "n_pretokens", "n_tokens")


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.remove_repeats(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.cluster(_table(spark, folder, "embeddings")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", clustering.digest().alias("centroid_sha256"))


def op12_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"), columns=["doc_id"]).select(
        "row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.report(repair.repair(_table(spark, folder, "conversations")))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_minhash_neardup": op2_minhash_neardup,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_pii": op4_pii,
    "op5_extendible_sharding": op5_extendible_sharding,
    "op6_lbl_scores": op6_lbl_scores,
    "op7_quality_rules": op7_quality_rules,
    "op8_suffix_decontamination": op8_suffix_decontamination,
    "op9_token_counts": op9_token_counts,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_source_mixing": op12_source_mixing,
    "op13_conversation_repair": op13_conversation_repair,
}
