"""Full-table snapshots as insert events."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import position as P
from ..functions.types import TypeSystem
from ..operators import events as E
from ..operators import offsets as O
from ..operators.metrics import CaptureMetrics
from ..spec import REGULAR, ColumnSpec, SchemaRegistry, TableSpec, local_frame

ALWAYS, INITIAL, NEVER = "ALWAYS", "INITIAL", "NEVER"


def statement(source: DataFrame, spec: TableSpec, execution_ms: int) -> DataFrame:
    """All columns of the spec, the ``<column>_ttl`` of each that can have one (null where the source has none), and the time of the read."""
    have = set(source.columns)
    ttl = [(F.col(f"{c.name}_ttl") if f"{c.name}_ttl" in have else F.lit(None)).cast("int").alias(f"{c.name}_ttl") for c in spec.columns if c.role == REGULAR and not c.is_collection]
    return source.select(*[F.col(c.name) for c in spec.columns], *ttl, F.lit(execution_ms).cast("long").alias("execution_time"))


def deletion_ts(execution_ms: Column, ttl_s: Column) -> Column:
    """When a value expires, in microseconds."""
    return execution_ms * 1000 + ttl_s.cast("long") * 1_000_000


def snapshot_cell(c: ColumnSpec, types: TypeSystem) -> Column:
    """Every column becomes a set cell, nulls included; only regular, non-null, non-collection values can expire."""
    value = types.decode(c.cql_type, F.col(c.name))
    if c.role != REGULAR or c.is_collection:
        return E.cell(value)
    return E.cell(value, F.when(F.col(c.name).isNotNull(), deletion_ts(F.col("execution_time"), F.col(f"{c.name}_ttl"))))


def snapshot(source: DataFrame, spec: TableSpec, types: TypeSystem, execution_ms: int, exclude: Iterable[str] = ()) -> DataFrame:
    """Insert changes of one table at the snapshot position, in the shape that ``operators.events.envelope`` takes.

    Excluded columns are not even read: their cells are null.
    """
    read = statement(source, spec, execution_ms)
    gone = set(exclude)
    bound = F.lit(None).cast(E.BOUND)
    cells = [snapshot_cell(c, types).alias(c.name) if c.name not in gone else F.lit(None).cast(cell_ddl(c, types)).alias(c.name) for c in spec.columns]
    rows = read.select(
        F.lit(spec.keyspace).alias("keyspace"), F.lit(spec.table).alias("table"), F.lit(P.SNAPSHOT_FILE).alias("file"), F.lit(P.SNAPSHOT_POS).alias("pos"),
        F.lit(0).alias("update_no"), F.lit(0).cast("long").alias("seq"), F.lit(E.INSERT).alias("op"), (F.col("execution_time") * 1000).alias("event_ts"),
        F.struct(*cells, bound.alias("_range_start"), bound.alias("_range_end")).alias("after"),
    )
    return rows.withColumn("key", E.key_of(spec))


def cell_ddl(c: ColumnSpec, types: TypeSystem) -> str:
    return f"struct<value:{types.spark_type(c.cql_type).simpleString()},deletion_ts:bigint,set:boolean>"


class SnapshotRunner:
    """Snapshots of all pending tables, by mode: at each poll, at the first one, or never.

    A table's offset is committed only once the sink has taken all its rows; an
    empty table is marked at once.  ``excludes`` names columns by table that are
    not read.
    """

    def __init__(self, spark: SparkSession, registry: SchemaRegistry, read: Callable[[TableSpec], DataFrame], store: O.OffsetStore, mode: str = INITIAL, types: TypeSystem | None = None, excludes: Mapping[str, Iterable[str]] | None = None, metrics: CaptureMetrics | None = None):
        self.spark, self.registry, self.read, self.store = spark, registry, read, store
        self.excludes, self.metrics = excludes or {}, metrics or CaptureMetrics()
        self.mode, self.types, self.polls = mode.upper(), types or TypeSystem(), 0
        if self.mode not in (ALWAYS, INITIAL, NEVER):
            raise ValueError(f"unknown snapshot mode: {mode}")

    def pending(self) -> list[TableSpec]:
        specs = self.registry.tables()
        tables = local_frame(self.spark, [(s.name,) for s in specs], "name string")
        names = {r["name"] for r in O.pending_snapshots(tables, self.store.load()).collect()}  # as many as tables
        return [s for s in specs if s.name in names]

    def poll(self, sink: Callable[[DataFrame, TableSpec], None], execution_ms: int) -> list[str]:
        """One polling step; the names of the tables that were read."""
        self.polls += 1
        if self.mode == NEVER or (self.mode == INITIAL and self.polls > 1):
            return []
        done: list[str] = []
        todo = self.pending() if self.mode == INITIAL else self.registry.tables()
        if not todo:
            return done
        self.metrics.snapshot_begins(len(self.registry.tables()), len(todo))
        try:
            for spec in todo:
                seen = Observation()  # counted by the very job that writes the rows
                rows = snapshot(self.read(spec), spec, self.types, execution_ms, self.excludes.get(spec.name, ()))
                sink(rows.observe(seen, F.count("*").alias("rows")), spec)
                self.store.commit(O.offsets_frame(self.spark, [(spec.name, O.SNAPSHOT, P.SNAPSHOT_FILE, P.SNAPSHOT_POS)]))
                self.metrics.table_read(spec.name, self._counted(seen))
                done.append(spec.name)
        finally:
            self.metrics.snapshot_ends("COMPLETED" if len(done) == len(todo) else "ABORTED")
        return done

    @staticmethod
    def _counted(seen: Observation) -> int:
        """Rows that a finished job has observed; 0 if the sink ran none.  What is observed arrives a little after the job's end."""
        for _ in range(40):
            row = seen._jo.getRowOrEmpty() if seen._jo is not None else None
            if row is not None and row.isDefined():
                return int(row.get().getLong(0))
            time.sleep(0.05)
        return 0


def union_events(parts: Iterable[DataFrame]) -> DataFrame:
    """Snapshot and log events in one stream; columns that one side lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
