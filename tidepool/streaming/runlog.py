"""Run log of streaming jobs: one ``log_etl_run`` row per micro-batch (SNK10, DCL2).

A ``StreamingQueryListener`` gets the progress of every micro-batch after it has
ended.  Rows read come from the sources' progress, rows written from the sink,
which counts with ``observe()`` while it writes.  There is no second pass to
count, and no log row is written inside a micro-batch, so a repeated micro-batch
adds none.
"""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidepool.sinks.tables import DECLARED_TABLES

SCHEMA = DECLARED_TABLES["log_etl_run"]


class RunLog(StreamingQueryListener):
    """Collects a row per micro-batch of the queries named ``job``, and appends them to the table at ``path``.

    Use as ``with RunLog(spark, path, job): ...``; rows are written in the order of
    their micro-batches when the block ends, or by ``flush``.  Progress events come
    on the session's listener thread: they are only noted there.
    """

    def __init__(self, spark: SparkSession, path: str, job: str, source: str = "diagnostic-json"):
        super().__init__()
        self.spark, self.path, self.job, self.source = spark, path, job, source
        self.rows: list[tuple] = []
        self.ids: set[str] = set()
        self.written: dict[int, int] = {}
        self.lock, self.ended = threading.Lock(), threading.Condition()
        self.running = 0

    def note_written(self, batch_id: int, rows: int) -> None:
        """Rows that the sink wrote (as it observed them)."""
        with self.lock:
            self.written[batch_id] = rows

    def onQueryStarted(self, event) -> None:
        if event.name == self.job:
            with self.ended:
                self.ids.add(str(event.runId))
                self.running += 1

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.job:
            return
        begin = dt.datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
        end = begin + dt.timedelta(milliseconds=(p.durationMs or {}).get("triggerExecution", 0))
        with self.lock:
            self.rows.append((f"{p.runId}-{p.batchId}", begin, end, "Succeeded", int(p.numInputRows), None, p.batchId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.ended:
            if str(event.runId) in self.ids:
                if event.exception:
                    now = dt.datetime.now(dt.timezone.utc)
                    with self.lock:
                        self.rows.append((str(event.runId), now, now, "Failed", None, event.exception[:2000], -1))
                self.running -= 1
                self.ended.notify_all()

    def flush(self) -> int:
        """Append the rows noted so far; returns how many."""
        with self.lock:
            rows, self.rows = self.rows, []
        now = dt.datetime.now(dt.timezone.utc)
        out = [(run, self.source, None, None, self.job, begin, end, status, read, self.written.get(batch), None, error, None, now)
               for run, begin, end, status, read, error, batch in rows]
        if out:
            self.spark.createDataFrame(out, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        return len(out)

    def __enter__(self) -> RunLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        # A query's last events may arrive shortly after it has ended.
        with self.ended:
            self.ended.wait_for(lambda: self.ids and not self.running, timeout=60)
        self.spark.streams.removeListener(self)
        self.flush()

