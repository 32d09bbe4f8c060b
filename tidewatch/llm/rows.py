"""Rows that pass through a Python stage as one struct, so that no column names can clash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts are large: fewer rows in each batch that goes to Python bound the memory of both sides."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def carried(docs: DataFrame, columns: list[str] | None = None) -> tuple[Column, T.StructField]:
    """The struct ``row`` of all columns, or of those named, and its field in a schema."""
    names = docs.columns if columns is None else columns
    row = F.struct(*(F.col(f"`{c}`") for c in names)).alias("row")
    return row, T.StructField("row", T.StructType([docs.schema[c] for c in names]))
