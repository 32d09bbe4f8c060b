"""WARC archives: written with Spark's text writer, read back with a verified chain of record boundaries.

Writing. Pages with equal payloads (of ``least`` bytes at least) share one ``response`` record, that of the largest page
id; the others become ``revisit`` records, which carry headers only. A third of all pages may share a payload: the
largest id of each payload that several pages have is found with partial aggregation and written as a table, which the planner sends to the
pages if it is small; only beyond the session's broadcast threshold do pages enter an exchange. Records are texts, so Spark's own
writer puts them into archives on any file system, gzip-compressed, of at most ``ARCHIVE_BYTES`` each; a larger record has its own.

Reading. Every place in an archive that holds the magic (at its start or behind a blank line, as any record does) and a whole
header, however long, is a candidate; it names its successor, the place behind its block. Magic inside a payload makes candidates too. Pointer jumping from the start of each archive (the
reached set and the successor function double their reach in every round) keeps only records on the chain from offset 0.

Defined results: a null or empty html is an empty payload; a null url gives no target header; pages with equal ids and
payloads are all responses if their id is the largest; null page ids are below all others; an empty table gives no records; other
columns are ignored. An archive that breaks off inside a record yields the records before it; one whose
chain ends anywhere else before its last byte fails the query.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import materialise, release

from .words import tidied

ARCHIVE_BYTES = 32 << 20
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
CRLF = "\r\n"
MAGIC = re.compile(rb"(?:\A|(?<=\r\n\r\n))WARC/1\.[01]\r\n")
RECORD = (
    "archive string, offset long, length long, page_id long, record_type string, refers_to long, target string, "
    "payload_bytes long, payload_digest string"
)
_PAGE = re.compile(rb"<urn:page:(-?\d+)>")


def _base32(sha1_hex):
    """Upper-case base32 of a SHA-1 in hex: 5 bits a letter."""
    bits = F.concat(*(F.lpad(F.bin(F.conv(F.substring(sha1_hex, 1 + 10 * k, 10), 16, 10).cast("long")), 40, "0") for k in range(4)))
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.substr(
        F.lit(letters), F.conv(F.substr(bits, i * 5 + 1, F.lit(5)), 2, 10).cast("int") + 1, F.lit(1))), "")


def _pages(pages: DataFrame) -> DataFrame:
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
    ).select("*", F.sha1(F.col("html").cast("binary")).alias("sha1"), F.octet_length("html").cast("long").alias("size"))


def shared_payloads(pages: DataFrame) -> DataFrame:
    """``sha1, newest`` of each payload of several pages."""
    found = _pages(pages).groupBy("sha1").agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("n"))
    return found.where("n > 1").select("sha1", "newest", F.lit(True).alias("shared"))


def records(pages: DataFrame, least: int = 0, date: str = "2024-01-01T00:00:00Z", shared: DataFrame | None = None) -> DataFrame:
    """One record per page as text, without its last line feed. ``shared`` are the written ``shared_payloads``, if there are any."""
    typed = _pages(pages).join(shared_payloads(pages) if shared is None else shared, "sha1", "left").withColumn(
        "revisit", F.col("shared").isNotNull() & (F.col("size") >= least) & ~F.col("page_id").eqNullSafe(F.col("newest")))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    target = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("size").cast("string"), F.lit(CRLF + CRLF))
    block_bytes = F.octet_length(head) + F.when(F.col("revisit"), 0).otherwise(F.col("size"))
    lines = [
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name("page_id")), F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), _base32(F.col("sha1"))),
        F.when(F.col("revisit"), F.concat_ws(
            CRLF, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            F.concat(F.lit("WARC-Refers-To: "), name("newest")))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), block_bytes.cast("string")),
    ]
    return typed.select(F.concat(
        F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF), head,
        F.when(F.col("revisit"), "").otherwise(F.col("html")), F.lit(CRLF + "\r")).alias("value"))


def _archives(limit: int, most: int):
    """A row for each archive: a task's records in order, as many as ``limit`` bytes hold, at most ``most``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, used, n = [], 0, 0

        def row() -> pa.RecordBatch:
            texts = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.concat_arrays(held))
            held.clear()
            return pa.RecordBatch.from_arrays([pc.binary_join(texts, "\n")], names=["value"])

        for batch in batches:
            first = 0
            for k, size in enumerate((pc.binary_length(batch.column(0)).to_numpy() + 1).tolist()):
                if n and (used + size > limit or n == most):
                    held.append(batch.column(0).slice(first, k - first))
                    yield row()
                    first, used, n = k, 0, 0
                used, n = used + size, n + 1
            held.append(batch.column(0).slice(first))
        if n:
            yield row()
    return tidied(run)


def write(pages: DataFrame, path: str, least: int = 0, records_each: int = 20_000) -> None:
    """Write archives of the pages to the folder ``path``: at most ``records_each`` records and ``ARCHIVE_BYTES`` each."""
    spark = pages.sparkSession
    shared = materialise(shared_payloads(pages), "payloads")
    before = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, str(ARCHIVE_BYTES // 2))  # pages may be large
    try:
        texts = records(pages, least, shared=shared).mapInArrow(_archives(ARCHIVE_BYTES, records_each), "value string")
        texts.write.option("lineSep", "\n").option("compression", "gzip").option("maxRecordsPerFile", 1).text(path)
    finally:
        spark.conf.set(BATCH_BYTES, before)
        release(shared)


def _plain(content: bytes) -> bytes:
    """The archive's bytes; any number of gzip members."""
    if content[:2] != b"\x1f\x8b":
        return content
    out = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(content))
        content = member.unused_data
        if not member.eof:
            break
    return b"".join(out)


def _page(value: bytes | None) -> int | None:
    found = _PAGE.search(value or b"")
    return int(found[1]) if found else None


def _parse(data: bytes, at: int) -> dict | None:
    """The record that seems to start at ``at``, and its successor."""
    body = data.find(b"\r\n\r\n", at)  # before the next candidate, so an archive is searched once
    if body < 0:
        return None
    lines = data[at:body].split(b"\r\n")[1:]
    head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in lines)}
    if not head.get(b"content-length", b"").isdigit():
        return None
    begin = body + 4
    end = begin + int(head[b"content-length"])
    if data[end:end + 4] != b"\r\n\r\n":
        return None
    kind = head.get(b"warc-type", b"").decode("latin-1")
    payload = (data.find(b"\r\n\r\n", begin, end) + 4) if head.get(b"content-type", b"").startswith(b"application/http") else begin
    if kind == "revisit":
        sized = re.search(rb"(?i)\r\ncontent-length: *(\d+)", data[begin:payload])
        size, digest = int(sized[1]) if sized else None, head.get(b"warc-payload-digest", b"").decode().removeprefix("sha1:")
    else:
        size, digest = end - payload, base64.b32encode(hashlib.sha1(data[payload:end]).digest()).decode()
    return {
        "offset": at, "length": end + 4 - at, "page_id": _page(head.get(b"warc-record-id")), "record_type": kind,
        "refers_to": _page(head.get(b"warc-refers-to")), "target": head.get(b"warc-target-uri", b"").decode("utf-8", "replace") or None,
        "payload_bytes": size, "payload_digest": digest,
        "payload": data[payload:end],
    }


def _broken_off(data: bytes, at: int) -> bool:
    """Whether the archive ends inside a record that starts at ``at``."""
    body = data.find(b"\r\n\r\n", at)
    if body < 0:
        return data[at:at + 10] in (b"WARC/1.0\r\n"[:len(data) - at], b"WARC/1.1\r\n"[:len(data) - at])
    size = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d+)[ \t]*\r\n", data[at:body + 2])
    return bool(re.match(rb"WARC/1\.[01]\r\n", data[at:at + 10])) and size is not None and body + 4 + int(size[1]) + 4 > len(data)


def _whole(archive: str, data: bytes, offset: list[int], successor: list[int]) -> None:
    """Fail if the chain of the candidates ends before the end of the archive, but for a record that is broken off."""
    successor = np.array(successor, np.int64)
    end = int(successor[reached(np.array(offset, np.int64), successor)].max(initial=0))
    if end < len(data) and not _broken_off(data, end):
        raise ValueError(f"{archive}: no record at byte {end} of {len(data)}")


def _candidates(payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [f.split() for f in RECORD.split(", ")] + ([["payload", "binary"]] if payload else [])
        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        schema = pa.schema([(n, kinds[k]) for n, k in fields])
        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = _plain(content.as_py())
                found, size = [], 0
                offset, successor = [], []
                for m in MAGIC.finditer(data):
                    if record := _parse(data, m.start()):
                        if not payload:
                            del record["payload"]
                        found.append(record | {"archive": archive})
                        offset.append(record["offset"])
                        successor.append(record["offset"] + record["length"])
                        size += len(record.get("payload", b"")) + 500
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(found, schema)
                            found, size = [], 0
                _whole(archive, data, offset, successor)
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema)
    return run


def reached(offset: np.ndarray, successor: np.ndarray) -> np.ndarray:
    """Which candidates (by rising offset) lie on the chain from offset 0, by pointer jumping."""
    n = len(offset)
    jump = np.searchsorted(offset, successor)
    jump = np.where((jump < n) & (offset[np.minimum(jump, n - 1)] == successor), jump, n) if n else jump
    jump = np.append(jump, n)  # n stands for the end
    on = np.append(offset == 0, False)
    while True:
        more = on.copy()
        more[jump[np.flatnonzero(on)]] = True
        jump = jump[jump]
        if (jump == n).all() or (more == on).all():
            return more[:n]
        on = more


def _chain(table: pa.Table) -> pa.Table:
    """Candidates of one archive that its chain reaches."""
    table = table.sort_by("offset")
    offset = table["offset"].to_numpy()
    return table.filter(pa.array(reached(offset, offset + table["length"].to_numpy())))


def read(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """Records of all archives in the folder ``path``; with ``payload`` also their payloads.

    One task reads an archive; the writer bounds their bytes. The boundary check handles offsets and headers only.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    found = files.mapInArrow(_candidates(payload), RECORD + (", payload binary" if payload else ""))
    return found.groupBy("archive").applyInArrow(_chain, found.schema)
