"""Report batches on a stream: a report leaves with its tenth record, or some time after its first, whatever the triggers.

Records of one report window (and lane) wait in list state: at most one less than a batch. A full batch leaves at once;
a timer sends what is left. In live use the timer counts processing time from the first waiting record; over stored
records it waits for the watermark to pass the window's end, which gives the same batches on every run and, as all records of
a trigger are put in order first, those of ``reports.report_batches``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewatch.functions.events import or_unknown
from tidewatch.schemas import ANOMALY
from tidewatch.settings import DEFAULTS, Settings, seconds

BATCHES = T.StructType([
    T.StructField("batch_window", T.TimestampType()), T.StructField("batch_no", T.LongType()), T.StructField("position", T.LongType()),
    *ANOMALY.fields])
KEEP_MS = 24 * 3600 * 1000  # a live window's number of batches is remembered for a day


def _order(row: Row) -> tuple:
    """By second, service, type and a digest of the key, then exactly; nulls first."""
    spread = hashlib.md5((row.session_key or "").encode()).hexdigest()[:2]
    exact = [(x is not None, x) for x in (row.detected_at, row.window_start, row.session_key)]
    return (row.detected_at.replace(microsecond=0), row.service or "unknown", row.anomaly_type or "unknown", spread, *exact)


class Batcher(StatefulProcessor):
    """Waiting records and the number of records that have left, for each report window and lane."""

    def __init__(self, size: int, wait_s: int, live: bool):
        self.size, self.wait_ms, self.live = size, 1000 * wait_s, live

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", ANOMALY)
        self.left = handle.getValueState("left", "n long", KEEP_MS if self.live else None)

    def _batch(self, window, records: list, left: int) -> Iterator[Row]:
        for k, record in enumerate(records):
            yield Row(batch_window=window, batch_no=left // self.size, position=left + k + 1, **dict(zip(ANOMALY.names, record, strict=True)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        fresh = sorted(rows, key=_order)
        records = [tuple(r) for r in self.waiting.get()] + [tuple(r[c] for c in ANOMALY.names) for r in fresh]
        left = self.left.get()[0] if self.left.exists() else 0
        while len(records) >= self.size:
            yield from self._batch(key[0], records[:self.size], left)
            records, left = records[self.size:], left + self.size
            for timer in list(self.handle.listTimers()):  # it was set for a record that has left
                self.handle.deleteTimer(timer)
        self.left.update((left,))
        if records:
            self.waiting.put(records)
            if not list(self.handle.listTimers()):
                self.handle.registerTimer(self._due(key[0], timerValues))
        else:
            self.waiting.clear()

    def _due(self, window, timers) -> int:
        return timers.getCurrentProcessingTimeInMs() + self.wait_ms if self.live else int(window.timestamp() * 1000) + self.wait_ms

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        records = [tuple(r) for r in self.waiting.get()]
        left = self.left.get()[0] if self.left.exists() else 0
        yield from self._batch(key[0], records, left)
        self.waiting.clear()
        if self.live:  # later records of the window begin a batch of their own
            self.left.update(((left + len(records) + self.size - 1) // self.size * self.size,))
        else:
            self.left.clear()

    def close(self) -> None: ...


def report_stream(found: DataFrame, cfg: Settings = DEFAULTS, live: bool = True, lanes: int = 1) -> DataFrame:
    """A stream of anomalies as numbered batches: ``batch_window, batch_no, position`` and the record.

    ``lanes`` parts a window that holds very many records by service and key; batch numbers then count within a lane.
    ``live=False`` needs a watermark on ``detected_at``; windows leave when it passes their end.
    """
    window = F.window("detected_at", seconds(cfg.report_window_s)).getField("start")
    lane = F.pmod(F.xxhash64(or_unknown("service"), "session_key"), F.lit(lanes)).cast("int")
    keyed = found.select(*ANOMALY.names, window.alias("report_window"), lane.alias("lane"))
    return keyed.groupBy("report_window", "lane").transformWithState(
        Batcher(cfg.report_batch, cfg.report_wait_s if live else cfg.report_window_s, live), BATCHES, "append", "ProcessingTime" if live else "EventTime")
