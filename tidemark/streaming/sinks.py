"""Where events go: converters for key and value, and sinks for ``Capture`` and for batch plans."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.types import TypeSystem
from ..operators import events as E
from ..spec import TableSpec

Converter = Callable[[Column], Column]


def json_converter(c: Column) -> Column:
    """JSON with null fields kept, so that unset and null stay apart; a null struct is null (a tombstone's value)."""
    return F.when(c.isNotNull(), F.to_json(c, {"ignoreNullFields": "false"}))


def avro_converter(c: Column) -> Column:
    """Avro; needs Spark's avro module on the class path."""
    from pyspark.sql.avro.functions import to_avro

    return to_avro(c)


CONVERTERS: dict[str, Converter] = {"json": json_converter, "avro": avro_converter}


def converter(name: str | None) -> Converter:
    """A registered converter by name, or by the last word of a class name."""
    key = (name or "json").rsplit(".", 1)[-1].removesuffix("Converter").lower()
    if key not in CONVERTERS:
        raise ValueError(f"unknown converter: {name}")
    return CONVERTERS[key]


def with_headers(events: DataFrame, headers: Mapping[str, Column]) -> DataFrame:
    """A ``headers`` column (tracing ids and the like) as Kafka's sink takes it."""
    each = [F.struct(F.lit(k).alias("key"), v.cast("string").cast("binary").alias("value")) for k, v in headers.items()]
    return events.withColumn("headers", F.array(*each))


def trace_parent() -> Column:
    """A trace context: the trace is the mutation an event comes from, the span the event itself."""
    trace = F.md5(F.concat_ws(":", "file", F.col("pos").cast("string")).cast("binary"))
    span = F.substring(F.md5(F.concat_ws(":", "file", "keyspace", "table", F.col("pos").cast("string"), F.col("seq").cast("string"), F.to_json("key")).cast("binary")), 1, 16)
    return F.concat_ws("-", F.lit("00"), trace, span, F.lit("01"))


def records(events: DataFrame, key: Converter = json_converter, value: Converter = json_converter) -> DataFrame:
    """``topic, key, value`` (and headers): what a message broker takes."""
    more = ["headers"] if "headers" in events.columns else []
    return events.select("topic", key(F.col("key")).alias("key"), value(F.col("value")).alias("value"), *more)


class EventSink:
    """Builds envelopes of a table's rows and hands them to ``write``; a ``Capture`` sink.

    ``write`` gets one DataFrame of events per table and batch.  Order within a
    source file is kept by dealing rows to ``queues`` partitions by file (or by
    partition key) and sorting inside them.
    """

    def __init__(self, write: Callable[[DataFrame, TableSpec], None], prefix: str, cluster: str, clock: Callable[[], int], *, tombstones: bool = False, rewrite: bool = False, queues: int = 0, mode: str = "COMMITLOG_FILE", types: TypeSystem | None = None, snapshot: bool = False, tracing: bool = False):
        self.write, self.prefix, self.cluster, self.clock = write, prefix, cluster, clock
        self.tombstones, self.rewrite, self.queues, self.mode, self.types = tombstones, rewrite, queues, mode, types or TypeSystem()
        self.snapshot, self.tracing = snapshot, tracing

    def __call__(self, rows: DataFrame, spec: TableSpec) -> None:
        by = [f"key.{c.name}" for c in spec.role("PARTITION")]
        if self.queues and not self.snapshot:
            rows = E.partition_for_order(rows, self.queues, self.mode, by)
        events = E.envelope(rows, spec, self.prefix, E.source_block(self.cluster, self.snapshot), self.clock())
        if self.queues:
            events = events.withColumn("queue", E.queue_index(self.queues, self.mode, by, self.snapshot))
        if self.tracing:
            events = with_headers(events, {"traceparent": trace_parent()})
        if self.rewrite:
            events = E.rewrite_envelope(events)
        if self.tombstones:
            events = E.fan_out_tombstones(events)
        self.write(events, spec)


def to_files(root: str, format: str = "json", key: str | None = None, value: str | None = None) -> Callable[[DataFrame, TableSpec], None]:
    """Append each topic's records to a folder of its own."""

    def write(events: DataFrame, spec: TableSpec) -> None:
        records(events, converter(key), converter(value)).drop("topic").write.mode("append").format(format).save(f"{root.rstrip('/')}/{spec.name}")

    return write


def to_kafka(options: Mapping[str, str], key: str | None = None, value: str | None = None) -> Callable[[DataFrame, TableSpec], None]:
    """Spark's Kafka sink; options without their ``kafka.`` prefix, as in a producer's settings.  Needs the connector's jar."""

    def write(events: DataFrame, spec: TableSpec) -> None:
        out = records(events, converter(key), converter(value)).write.format("kafka")
        for k, v in options.items():
            out = out.option(f"kafka.{k}", v)
        out.save()

    return write
