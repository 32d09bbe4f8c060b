"""Running a stream to the end of its input, into a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewatch.session import make_folder, new_path, prepare
from tidewatch.streaming.sinks import table_writer


def run_to_end(stream: DataFrame, path: str, checkpoint: str, output_mode: str = "append",
               name: str | None = None) -> StreamingQuery:
    """Process all available input, restartable: batches already stored are replaced, not repeated."""
    make_folder(stream.sparkSession, path)  # batches without rows leave nothing
    writer = stream.writeStream.outputMode(output_mode)
    if name:
        writer = writer.queryName(name)
    query = (
        writer.option("checkpointLocation", checkpoint)
        .foreachBatch(table_writer(path))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def stream_table(stream: DataFrame, name: str) -> DataFrame:
    """The whole output of an append stream as a table in the shared folder."""
    spark = prepare(stream.sparkSession)
    path = new_path(spark, name)
    schema = stream.schema
    run_to_end(stream, f"{path}/rows", f"{path}/checkpoint")
    return spark.read.schema(schema).parquet(f"{path}/rows").select(*schema.names)


def latest_rows(stream: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Final state of an update-mode aggregate: the last row written for each key."""
    spark = prepare(stream.sparkSession)
    path = new_path(spark, name)
    values = [c for c in stream.columns if c not in keys]
    schema = T.StructType([*stream.schema.fields, T.StructField("batch_id", T.LongType())])
    run_to_end(stream, f"{path}/rows", f"{path}/checkpoint", "update")
    rows = spark.read.schema(schema).parquet(f"{path}/rows")
    return rows.groupBy(*keys).agg(*[F.max_by(c, "batch_id").alias(c) for c in values])
