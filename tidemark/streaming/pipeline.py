"""Continuous capture: a mutation-log stream to a sink, by micro-batches.

Each batch filters by the offsets of its start, writes its events with the sink,
commits offsets and then settles the segments that ended in it.  The end of a
batch is the barrier: a segment is archived only when it is complete and all of
its events are out.  What outlives a batch (offsets, openings of ranges that
wait for their end, segments with failures) is kept in small tables beside the
offsets, so that a restart goes on with it.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.types import TypeSystem
from ..operators import events as E
from ..operators import offsets as O
from ..operators.metrics import CaptureMetrics
from ..spec import SchemaRegistry, TableSpec, local_frame
from .transfer import COMPLETED_PREMATURELY, DOES_NOT_EXIST, ERROR, OK, Files, Transfer

FAIL_FAST, DEAD_LETTER = "failfast", "dead_letter"
Sink = Callable[[DataFrame, TableSpec], None]
#: Openings that wait for their end, as ``operators.events.range_ends`` gives them.
WAITING = (
    f"keyspace string, table string, partition_key map<string,string>, file string, pos int, update_no int, partition string, segment long, head {E.MARKER}, tail {E.MARKER}"
)


class BrokenLines(ValueError):
    """Lines of the log that are no mutations."""


class Capture:
    """A capture of all tables of a registry into a sink.

    ``broken`` takes the lines that are no mutations (``file, at, broken``);
    without it they are a failure of their segment.  ``flush`` says when offsets
    are persisted.
    """

    def __init__(self, spark: SparkSession, registry: SchemaRegistry, store: O.OffsetStore, sink: Sink, *, types: TypeSystem | None = None, excludes: dict[str, list[str]] | None = None,
                 transfer: Transfer | None = None, folder: str = "", failure: str = FAIL_FAST, refresh: Callable[[], None] | None = None, broken: Callable[[DataFrame], None] | None = None,
                 flush: O.FlushPolicy | None = None, metrics: CaptureMetrics | None = None):
        self.spark, self.registry, self.store, self.sink = spark, registry, store, sink
        self.types, self.excludes = types or TypeSystem(), excludes or {}
        self.transfer, self.folder, self.failure, self.refresh = transfer, folder.rstrip("/"), failure, refresh
        self.broken, self.flush, self.metrics, self.files = broken, flush or O.FlushPolicy(), metrics or CaptureMetrics(), Files(spark)
        self.ranges = O.Versions(spark, f"{store.path}_ranges", WAITING)
        self.failed = O.Versions(spark, f"{store.path}_failed", "file string, state string")
        kept = [(r["file"], r["state"]) for r in self.failed.load().collect()]  # segments not settled yet
        self.erroneous: set[str] = {f for f, state in kept if state == "erroneous"}
        self.reprocessing: set[str] = {f for f, state in kept if state == "reprocessing"}
        self.unflushed: dict[tuple[str, str], tuple[str, str, str, int]] = {}
        self.results: dict[str, str] = {}

    def _keep_failed(self) -> None:
        rows = [(f, state) for state, files in (("erroneous", self.erroneous), ("reprocessing", self.reprocessing)) for f in sorted(files)]
        self.failed.put(local_frame(self.spark, rows, "file string, state string"))

    def batch(self, log: DataFrame, batch_id: int = 0) -> None:
        """One micro-batch; a batch without ``eof`` rows holds whole segments."""
        if self.refresh:
            self.refresh()  # altered tables take effect from this batch on
        for c, t in (("eof", "boolean"), ("broken", "string"), ("at", "long")):
            if c not in log.columns:
                log = log.withColumn(c, F.lit(None).cast(t))
        before = set(self.erroneous), set(self.reprocessing)
        log = log.persist(StorageLevel.MEMORY_AND_DISK)
        rows = None
        try:
            seen = log.groupBy("file").agg(F.bool_or(F.coalesce("eof", F.lit(False))).alias("ended"), F.count("broken").alias("broken"), F.count_if(F.col("eof").isNull()).alias("whole"), F.count("pos").alias("mutations")).collect()  # segments of one micro-batch
            if bad := sorted(r["file"] for r in seen if r["broken"]):
                self._broken(log, bad)
            self.metrics.mutations(sum(r["mutations"] for r in seen), sum(r["broken"] for r in seen))
            again = F.col("file").isin(sorted(self.reprocessing)) if self.reprocessing else F.lit(False)
            offsets = O.advance(self.store.load(), O.offsets_frame(self.spark, list(self.unflushed.values()))) if self.unflushed else self.store.load()
            found = E.captured(log.filter("pos IS NOT NULL AND broken IS NULL").withColumn("reprocess", again), self.registry.frame(self.spark), lambda u: O.unprocessed(u, offsets))
            rows, waiting = E.all_changes(found, self.ranges.load())
            # By table inside the cache: each table's sink reads its own cached rows only.
            rows = rows.sortWithinPartitions("keyspace", "table", "file", "pos", "update_no", "seq").persist(StorageLevel.MEMORY_AND_DISK)
            there = {(r["keyspace"], r["table"]): r["n"] for r in rows.groupBy("keyspace", "table").agg(F.count("*").alias("n")).collect()}  # as many as tables
            for spec in self.registry.tables():
                if (spec.keyspace, spec.table) not in there:
                    continue
                one = rows.filter((F.col("keyspace") == spec.keyspace) & (F.col("table") == spec.table))
                try:
                    self.sink(E.with_row(one, spec, self.types, self.excludes.get(spec.name, ())), spec)
                    self.metrics.emitted(spec.name, there[spec.keyspace, spec.table])
                except Exception:
                    self.metrics.failures += 1
                    if self.failure == FAIL_FAST:
                        raise
                    self.erroneous |= {r["file"] for r in one.select("file").distinct().collect()}
            self._commit(rows.filter(~F.col("file").isin(sorted(self.erroneous))) if self.erroneous else rows, sum(there.values()))
            if self.ranges.versions() or not waiting.isEmpty():
                self.ranges.put(waiting)
            for r in sorted(seen):
                if r["ended"] or r["whole"]:
                    self.settle(r["file"])
            if (self.erroneous, self.reprocessing) != before:
                self._keep_failed()
        finally:
            log.unpersist()
            if rows is not None:
                rows.unpersist()

    def _broken(self, log: DataFrame, files: list[str]) -> None:
        lines = log.filter("broken IS NOT NULL").select("file", "at", "broken")
        if self.broken:
            self.broken(lines)
        elif self.failure == FAIL_FAST:
            one = lines.first()
            raise BrokenLines(f"{one['file']} at {one['at']}: {one['broken'][:200]}")
        else:
            self.erroneous |= set(files)

    def _commit(self, marks: DataFrame, records: int) -> None:
        """Persist offsets now, or by the flush policy with those of a later batch."""
        new = {(r["name"], r["kind"]): tuple(r) for r in O.advance(O.offsets_frame(self.spark, list(self.unflushed.values())), O.high_water(marks)).collect()}  # as many as tables
        self.unflushed = new
        if new and self.flush.should_flush(records):
            self.flush_offsets()

    def flush_offsets(self) -> None:
        if self.unflushed:
            self.store.commit(O.offsets_frame(self.spark, list(self.unflushed.values())))
            self.unflushed = {}

    def settle(self, file: str) -> None:
        """The end of a segment: archived and done with, or moved aside to be read again."""
        bad = file in self.erroneous
        path = f"{self.folder}/{file}"
        there = not (self.transfer and self.folder) or self.files.exists(path)
        self.results[file] = ERROR if bad else OK if there else DOES_NOT_EXIST
        if bad:
            self.erroneous.discard(file)
            self.reprocessing.add(file)
        else:
            self.reprocessing.discard(file)
        if self.transfer and self.folder and there:
            (self.transfer.on_error if bad else self.transfer.on_success)(path)

    def start(self, stream: DataFrame, checkpoint: str, once: bool = True, interval: str = "10 seconds") -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.batch).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def stop(query: StreamingQuery, timeout_s: float = 5) -> str:
    """Let the running batch end if it does so in time, then stop; a cut-off batch runs again at the next start.

    Waits no longer than the batch takes, and not at all for a timeout of zero or less."""
    until = time.monotonic() + timeout_s
    try:
        while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
            query.awaitTermination(min(0.1, max(0.01, until - time.monotonic())))
    finally:
        ended = not query.isActive
        query.stop()
    return OK if ended else COMPLETED_PREMATURELY


def healthy(queries: list[StreamingQuery]) -> dict[str, object]:
    """Whether all queries run, and what ended those that do not."""
    down = {q.name or str(q.id): str(q.exception() or "stopped") for q in queries if not q.isActive}
    return {"healthy": not down, "down": down}
