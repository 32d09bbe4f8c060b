"""Bulk files for a document index: a Spark data source that stages bodies of bounded size and publishes them by commit.

Each task writes its documents into bodies of at most ``size`` documents (an action line and a document line each) under names of its own
and reports them; only the commit names a batch's bodies in its manifest, which is what a loader reads. A task that
fails or is tried twice leaves bodies that no manifest names, an aborted batch has no manifest, and a batch that is
written again replaces its own. Works for tables (``df.write.format("bulk")``) and streams (``df.writeStream.format("bulk")``), on any file
system that Arrow can reach.

Options: ``path``; ``index``, the index's name; ``size`` (500); ``id``, a column whose value is the document's id, so that
loading a body again replaces its documents; ``batch`` names the manifest of a table's write.
"""

from __future__ import annotations

import datetime
import decimal
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

from tidewatch.session import has_file
from tidewatch.settings import DEFAULTS


def _text(value: object) -> object:
    if isinstance(value, datetime.datetime):
        return (value if value.tzinfo else value.replace(tzinfo=datetime.UTC)).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return str(value)
    raise TypeError(f"no document value: {type(value).__name__}")


@dataclass
class Staged(WriterCommitMessage):
    """Bodies of one task, with their numbers of documents."""

    bodies: list[tuple[str, int]]


class _Bodies:
    def __init__(self, options: dict[str, str]):
        self.path, self.index = options["path"], options["index"]
        self.size, self.id = int(options.get("size", DEFAULTS.bulk_size)), options.get("id")
        self.batch = options.get("batch") or uuid.uuid4().hex

    def _at(self, name: str) -> tuple[fs.FileSystem, str]:
        where = f"{self.path}/{name}"
        return fs.FileSystem.from_uri(where) if ":/" in where else (fs.LocalFileSystem(), where)

    def _put(self, name: str, content: str) -> None:
        system, file = self._at(name)
        system.create_dir(file.rpartition("/")[0], recursive=True)
        with system.open_output_stream(file) as out:
            out.write(content.encode())

    def write(self, rows: Iterator[Row]) -> Staged:
        task, bodies, lines = uuid.uuid4().hex, [], []

        def end() -> None:
            name = f"bodies/{task}-{len(bodies)}.ndjson"
            self._put(name, "".join(lines))
            bodies.append((name, len(lines) // 2))
            lines.clear()

        for row in rows:
            document = row.asDict(recursive=True)
            action = {"_index": self.index}
            if self.id and document[self.id] is not None:
                action["_id"] = str(document[self.id])
            lines += [json.dumps({"index": action}) + "\n", json.dumps(document, default=_text) + "\n"]
            if len(lines) == 2 * self.size:
                end()
        if lines:
            end()
        return Staged(bodies)

    def publish(self, messages: list[Staged | None], batch: str) -> None:
        bodies = [b for m in messages if m is not None for b in m.bodies]
        self._put(f"manifest/{batch}.json", "".join(json.dumps({"batch": batch, "body": name, "documents": n}) + "\n" for name, n in bodies))

    def discard(self, messages: list[Staged | None]) -> None:
        for name, _ in (b for m in messages if m is not None for b in m.bodies):
            system, file = self._at(name)
            system.delete_file(file)


class _TableWriter(_Bodies, DataSourceWriter):
    def commit(self, messages: list[Staged | None]) -> None:
        self.publish(messages, self.batch)

    def abort(self, messages: list[Staged | None]) -> None:
        self.discard(messages)


class _StreamWriter(_Bodies, DataSourceStreamWriter):
    def commit(self, messages: list[Staged | None], batchId: int) -> None:  # noqa: N803
        self.publish(messages, f"batch-{batchId}")

    def abort(self, messages: list[Staged | None], batchId: int) -> None:  # noqa: N803
        self.discard(messages)


class BulkSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bulk"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return _TableWriter(dict(self.options))

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> DataSourceStreamWriter:  # noqa: N802
        return _StreamWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BulkSource)


def published(spark: SparkSession, path: str) -> DataFrame:
    """``batch, body, documents`` of every body that a manifest names."""
    schema = "batch string, body string, documents bigint"
    return spark.read.schema(schema).json(f"{path}/manifest") if has_file(spark, f"{path}/manifest") else spark.createDataFrame([], schema)


def documents(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The published documents, each with its ``body``, index ``_index`` and ``_id``, as a loader would send them."""
    lines = spark.read.text(f"{path}/bodies", wholetext=True).select(
        F.concat(F.lit("bodies/"), F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)).alias("body"), F.split("value", "\n").alias("lines"))
    own = lines.join(published(spark, path).select("body").distinct(), "body", "left_semi")
    pairs = own.select("body", F.col("lines"), F.explode(F.sequence(F.lit(1), F.floor((F.size("lines") - 1) / 2))).alias("k"))
    action = F.from_json(F.col("lines")[(2 * F.col("k") - 2).cast("int")], "index struct<_index string, _id string>").getField("index")
    document = F.from_json(F.col("lines")[(2 * F.col("k") - 1).cast("int")], schema)
    return pairs.select("body", action.alias("a"), document.alias("d")).select("body", "a._index", "a._id", "d.*")
