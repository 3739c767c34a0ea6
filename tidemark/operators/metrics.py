"""Counters: as aggregations over events, and observed while a query runs."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..functions import position as P


def rows_scanned(events: DataFrame) -> DataFrame:
    return events.groupBy(F.concat_ws(".", "keyspace", "table").alias("table_name")).agg(F.count("*").alias("rows_scanned"))


def mutation_counts(log: DataFrame, failed: Column | None = None) -> DataFrame:
    bad = F.lit(False) if failed is None else failed
    return log.agg(F.count_if(~bad).alias("processed"), F.count_if(bad).alias("unrecoverable"))


def latest_position(log: DataFrame) -> DataFrame:
    far = F.max_by(F.struct("file", "pos"), P.position(P.segment_id(F.col("file")), F.col("pos")))
    return log.agg(far.alias("at")).select(F.col("at.file").alias("file"), F.col("at.pos").cast("long").alias("pos"))


def remaining_tables(tables: DataFrame, pending: DataFrame) -> DataFrame:
    """``total, remaining`` from two frames with a ``name`` each."""
    open_ = pending.select("name", F.lit(True).alias("open"))
    return tables.join(open_, "name", "left").agg(F.count("*").alias("total"), F.count("open").alias("remaining"))


def snapshot_seconds(start_ms: Column, stop_ms: Column) -> Column:
    return F.floor((stop_ms - start_ms) / 1000).cast("long")


def observed(events: DataFrame, name: str = "events") -> tuple[DataFrame, Observation]:
    """Events with counters filled by the very job that writes them."""
    seen = Observation(name)
    return events.observe(seen, F.count("*").alias("emitted"), F.count_if(F.col("op") == "d").alias("deletes")), seen


class StreamMetrics(StreamingQueryListener):
    """Totals over all micro-batches of the queries that it listens to."""

    def __init__(self):
        self.rows, self.batches, self.failures, self.active = 0, 0, 0, 0

    def onQueryStarted(self, event):
        self.active += 1

    def onQueryProgress(self, event):
        self.rows += event.progress.numInputRows
        self.batches += 1

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.active -= 1
        self.failures += event.exception is not None


class CaptureMetrics:
    """What a running capture tells about itself, for reports and the HTTP endpoints."""

    def __init__(self, clock: Callable[[], float] = time.time):
        self.clock, self.lock = clock, threading.Lock()
        self.processed, self.unrecoverable, self.failures = 0, 0, 0
        self.events: dict[str, int] = {}
        self.scanned: dict[str, int] = {}
        self.total_tables, self.remaining_tables = 0, 0
        self.started: float | None = None
        self.stopped: float | None = None
        self.snapshot_state = "NONE"

    def mutations(self, processed: int, unrecoverable: int) -> None:
        with self.lock:
            self.processed += processed
            self.unrecoverable += unrecoverable

    def emitted(self, table: str, n: int) -> None:
        with self.lock:
            self.events[table] = self.events.get(table, 0) + n

    def snapshot_begins(self, total: int, remaining: int) -> None:
        self.total_tables, self.remaining_tables = total, remaining
        self.started, self.stopped, self.snapshot_state = self.clock(), None, "RUNNING"

    def table_read(self, table: str, rows: int) -> None:
        self.scanned[table] = self.scanned.get(table, 0) + rows
        self.remaining_tables -= 1

    def snapshot_ends(self, state: str) -> None:
        """``COMPLETED`` or ``ABORTED``."""
        self.stopped, self.snapshot_state = self.clock(), state

    def report(self) -> dict[str, object]:
        """Counters of the log and of the snapshot, by name."""
        seconds = 0 if self.started is None else int((self.clock() if self.stopped is None else self.stopped) - self.started)
        return {
            "mutations_processed": self.processed, "mutations_unrecoverable": self.unrecoverable, "sink_failures": self.failures, "events": dict(self.events),
            "snapshot_state": self.snapshot_state, "snapshot_seconds": seconds, "tables_total": self.total_tables, "tables_remaining": self.remaining_tables, "rows_scanned": dict(self.scanned),
        }


class Endpoints:
    """``/ping``, ``/buildinfo``, ``/metrics`` and ``/health`` over HTTP; port 0 picks a free one."""

    def __init__(self, port: int, metrics: CaptureMetrics, health: Callable[[], dict], build: dict[str, str]):
        pages = {"/ping": lambda: "pong", "/buildinfo": lambda: build, "/metrics": metrics.report, "/health": health}

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self) -> None:
                page = pages.get(self.path)
                body = page() if page else "no such page"
                bad = isinstance(body, dict) and body.get("healthy") is False
                self.send_response(404 if page is None else 500 if bad else 200)
                self.send_header("Content-Type", "application/json" if isinstance(body, dict) else "text/plain")
                self.end_headers()
                self.wfile.write((json.dumps(body) if isinstance(body, dict) else body).encode())

            def log_message(self, *_: object) -> None:
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", port), Handler)
        self.port = self.server.server_address[1]
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def close(self) -> None:
        self.server.shutdown()
        self.server.server_close()
