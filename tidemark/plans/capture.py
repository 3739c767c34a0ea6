"""A whole capture from its configuration: snapshots of pending tables and the log, to one sink, once or continuously."""

from __future__ import annotations

import threading
import time
import warnings
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import QUEUE_PLACE, Config
from ..functions.types import TypeSystem
from ..operators import offsets as O
from ..operators.filters import excludes_for, parse_excludes
from ..operators.metrics import CaptureMetrics, Endpoints
from ..sources import mutation_log as L
from ..sources.binary import Decoder, read_binary
from ..sources.snapshot import SnapshotRunner
from ..spec import SchemaRegistry, TableSpec
from ..streaming import log_source
from ..streaming.pipeline import DEAD_LETTER, FAIL_FAST, Capture, healthy, stop
from ..streaming.sinks import EventSink, converter, to_kafka
from ..streaming.transfer import Deletion, Relocation, Transfer, load_transfer

Write = Callable[[DataFrame, TableSpec], None]


class CapturePlan:
    """Everything a capture needs, built from ``config`` and checked before anything is read.

    ``read`` gives a table's rows for snapshots.  ``write`` takes events; without
    it they go to a broker by the keys under ``kafka.producer.`` and the two
    converters.  A ``transfer`` of one's own (or ``commit.log.transfer.class``)
    turns a failing sink into a set-aside segment; without one the capture stops
    at the first failure.  ``schema`` gives the tables as they are now and is
    asked every ``schema.refresh.interval.ms``.  ``broken`` takes log lines that
    are no mutations.  With a ``decoder`` the segments are the store's binary ones.
    """

    def __init__(self, spark: SparkSession, config: Config, registry: SchemaRegistry, log_folder: str, read: Callable[[TableSpec], DataFrame], write: Write | None = None, *, transfer: Transfer | None = None,
                 clock: Callable[[], int] = lambda: int(time.time() * 1000), schema: Callable[[], Iterable[TableSpec]] | None = None, broken: Callable[[DataFrame], None] | None = None, decoder: Decoder | None = None):
        if wrong := config.validate():
            raise ValueError("; ".join(wrong))
        for key, why in config.without_effect().items():
            warnings.warn(f"{key} has no effect: {why}", stacklevel=2)
        self.spark, self.config, self.registry, self.folder, self.clock, self.schema = spark, config, registry, log_folder.rstrip("/"), clock, schema
        self.parsed_excludes = parse_excludes(self._text("field.exclude.list"))
        self.excludes: dict[str, list[str]] = {}
        self._exclude()
        types = TypeSystem(str(config["decimal.handling.mode"]), str(config["varint.handling.mode"]))
        self.store = O.OffsetStore(spark, str(config["offset.backing.store.dir"]))
        self.metrics = CaptureMetrics()
        self.key_converter, self.value_converter = converter(self._text("key.converter")), converter(self._text("value.converter"))
        producer = {k: str(v) for k, v in config.with_prefix("kafka.producer.").items()}
        self.write = write or to_kafka(producer, self._text("key.converter"), self._text("value.converter"))
        prefix, cluster = str(config["topic.prefix"] or ""), str(config["cluster.name"])
        queues = self._number("num.of.change.event.queues")
        more = {"queues": queues if queues > 1 else 0, "mode": str(config["event.order.guarantee.mode"]), "tombstones": bool(config["tombstones.on.delete"]), "types": types, "tracing": bool(config["tracing.enabled"])}
        sinks = {snapshot: EventSink(self.write, prefix, cluster, clock, snapshot=snapshot, **more) for snapshot in (True, False)}  # type: ignore[arg-type]
        self.snapshot_sink = sinks[True]
        self.snapshots = SnapshotRunner(spark, registry, read, self.store, str(config["snapshot.mode"]), types, self.excludes, self.metrics)
        self.relocation = Relocation(spark, str(config["commit.log.relocation.dir"]))
        named = self._text("commit.log.transfer.class")
        self.transfer = transfer or (load_transfer(named, spark, config.with_prefix("commit.log.transfer.")) if named else None)
        self.capture = Capture(
            spark, registry, self.store, sinks[False], types=types, excludes=self.excludes, transfer=self.relocation, folder=self.folder, failure=DEAD_LETTER if self.transfer else FAIL_FAST,
            refresh=self.refresh_schema if schema else None, broken=broken, flush=O.FlushPolicy(self._number("offset.flush.interval.ms"), self._number("max.offset.flush.size")), metrics=self.metrics,
        )
        self.refreshed, self.ddl, self.decoder = -1e18, [], decoder

    def _text(self, key: str) -> str | None:
        value = self.config[key]
        return None if value is None else str(value)

    def _number(self, key: str) -> int:
        return int(self.config[key])  # type: ignore[call-overload]

    def _exclude(self) -> None:
        self.excludes.clear()
        self.excludes.update({s.name: excludes_for(s, self.parsed_excludes) for s in self.registry.tables()})

    def refresh_schema(self) -> list[tuple[str, str]]:
        """Takes over tables created, altered or dropped since, at most once per refresh interval."""
        if self.schema is None or (time.monotonic() - self.refreshed) * 1000 < self._number("schema.refresh.interval.ms"):
            return []
        self.refreshed = time.monotonic()
        changed = self.registry.refresh(self.schema())
        if changed:
            self.ddl += changed
            self._exclude()
        return changed

    def snapshot(self) -> list[str]:
        """One poll for snapshots, by mode."""
        self.refresh_schema()
        return self.snapshots.poll(self.snapshot_sink, self.clock())

    def _stream(self, checkpoint: str, limit: int) -> DataFrame:
        return log_source.read_stream(self.spark, self.folder, bool(self.config["commit.log.real.time.processing.enabled"]), limit, checkpoint, self.decoder)

    def log(self, checkpoint: str) -> None:
        """All that can be read of the log by now: segments set aside before, then the stream, in batches of bounded size."""
        if self.config["commit.log.error.reprocessing.enabled"]:
            self.reprocess()
        if self.config["latest.commit.log.only"]:
            last = L.latest_segment(L.list_segments(self.spark, self.folder)).first()
            if last:
                self.capture.batch(self._read([last["path"]]))
        else:
            limit = self._number("max.queue.size") * QUEUE_PLACE
            while True:
                before = log_source.checkpointed(checkpoint)
                self.capture.start(self._stream(checkpoint, limit), checkpoint).awaitTermination()
                if log_source.checkpointed(checkpoint) == before:
                    break
        self.capture.flush_offsets()
        self.relocate()

    def relocate(self) -> None:
        """Hands archived and failed segments over, if post-processing is on."""
        if self.config["commit.log.post.processing.enabled"]:
            self.relocation.drain(self.transfer or Deletion(self.spark))

    def _read(self, paths: list[str]) -> DataFrame:
        """Whole segments, line by line as the stream reads them."""
        if self.decoder:
            return read_binary(self.spark, paths, self.decoder)
        text = self.spark.read.text(paths, lineSep="\n").withColumn("file", F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1))
        lines = text.filter(F.trim("value") != "").select("file", F.lit(None).cast("long").alias("at"), F.col("value").alias("mutation"), F.lit(False).alias("eof"))
        return L.parsed(lines).drop("eof")

    def reprocess(self) -> None:
        """Segments in the error folder (or that the transfer keeps) again, past the offset filter; each folder for itself."""
        paths = [*self.relocation.error_files(), *(self.transfer.error_files() if self.transfer else [])]
        folders: dict[str, list[str]] = {}
        for p in paths:
            folders.setdefault(p.rsplit("/", 1)[0], []).append(p)
        here = self.capture.folder
        for folder, found in folders.items():
            self.capture.reprocessing |= {p.rsplit("/", 1)[-1] for p in found}
            self.capture.folder = folder
            try:
                self.capture.batch(self._read(found))
            finally:
                self.capture.folder = here

    def run(self, checkpoint: str) -> list[str]:
        done = self.snapshot()
        self.log(checkpoint)
        return done

    def start(self, checkpoint: str, port: int | None = None) -> Running:
        """Snapshots and log from now on; ``port`` (or ``http.port`` if set) serves the endpoints."""
        return Running(self, checkpoint, port)


class Running:
    """A capture that goes on until it is stopped: the log by micro-batches, snapshots and relocation by their own intervals."""

    def __init__(self, plan: CapturePlan, checkpoint: str, port: int | None = None):
        self.plan, self.ended, self.error = plan, threading.Event(), None
        if plan.config["commit.log.error.reprocessing.enabled"]:
            plan.reprocess()
        every = min(plan._number("cdc.dir.poll.interval.ms"), plan._number("commit.log.marked.complete.poll.interval.ms"))
        limit = plan._number("max.queue.size") * QUEUE_PLACE
        self.query: StreamingQuery = plan.capture.start(plan._stream(checkpoint, limit), checkpoint, once=False, interval=f"{every} milliseconds")
        jobs = [(plan.snapshot, "snapshot.scan.interval.ms"), (plan.relocate, "commit.log.relocation.dir.poll.interval.ms")]
        self.threads = [threading.Thread(target=self._repeat, args=(job, plan._number(key) / 1000), daemon=True) for job, key in jobs]
        for t in self.threads:
            t.start()
        asked = port if port is not None else plan.config.values.get("http.port")
        build = {"name": "tidemark", "spark": plan.spark.version}
        self.endpoints = Endpoints(int(asked), plan.metrics, self.health, build) if asked is not None else None  # type: ignore[call-overload]

    def _repeat(self, job: Callable[[], object], seconds: float) -> None:
        while not self.ended.is_set():
            try:
                job()
            except Exception as e:
                self.error = e  # told by health(); the other parts go on
                return
            self.ended.wait(seconds)

    def health(self) -> dict[str, object]:
        found = healthy([self.query])
        if self.error is not None:
            found = {"healthy": False, "down": {**found["down"], "polling": str(self.error)}}  # type: ignore[dict-item]
        return found

    def stop(self) -> str:
        """Waits for the running batch as long as the shutdown timeout allows."""
        self.ended.set()
        out = stop(self.query, self.plan._number("commit.log.processor.shutdown.timeout.seconds"))
        for t in self.threads:
            t.join(self.plan._number("commit.log.processor.shutdown.timeout.seconds"))
        self.plan.capture.flush_offsets()
        if self.endpoints:
            self.endpoints.close()
        return out
