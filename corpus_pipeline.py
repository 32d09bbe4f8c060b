"""The corpus pipeline: quality rules, near-duplicates, benchmark contamination, personal data, subword encoding.

Every stage takes all rows that its predecessor kept and returns all columns of its input, so rows with nulls, repeated
rows, extra columns and empty tables pass through as each operator's module defines. The last stage adds its own
columns; columns of the input with the same names are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import decontaminate, neardup, pii, quality, segment
from tidewatch.llm.queries import VOCABULARY
from tidewatch.llm.rows import small_batches


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie in their language's perplexity band."""
    small_batches(spark)
    return quality.judge(docs).where("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8 and more) the document of the least id."""
    small_batches(spark)
    return neardup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a twentieth of their words in benchmark passages."""
    small_batches(spark)
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(~decontaminate.is_contaminated(F.col("n_words"), F.col("n_hit"))).select("row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each span of personal data replaced by its kind; a null text stays null."""
    small_batches(spark)
    changed = {"text": F.when(F.col("row.text").isNotNull(), pii.redacted())}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.size("spans") > 0, F.length(pii.redacted()).cast(docs.schema["n_chars"].dataType)).otherwise(
            F.col("row.n_chars"))
    return pii.spans(docs).select(*(changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their piece ids, the score, the other segmentations of the four best, and whether the decoded ids give the text."""
    small_batches(spark)
    own = ["ids", "score", "others", "round_trip"]
    return segment.encode(docs, VOCABULARY, verify=True).select(*(f"row.`{c}`" for c in docs.columns if c not in own), *own)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("sentencepiece", sentencepiece),
]

#: The perplexity model and the segmentation are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
