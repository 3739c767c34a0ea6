"""Per-table offsets: high-water marks, the already-processed filter, flush policy."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import position as P
from ..spec import local_frame

OFFSETS = "name string, kind string, file string, pos int"
LOG, SNAPSHOT = "commitlog", "snapshot"


def offsets_frame(spark: SparkSession, rows: list[tuple[str, str, str, int]]) -> DataFrame:
    """``name`` is ``keyspace.table``; one row per table and kind."""
    return local_frame(spark, rows, OFFSETS)


def unprocessed(updates: DataFrame, offsets: DataFrame) -> DataFrame:
    """Updates beyond their table's log offset; those flagged ``reprocess`` always pass.

    The filter looks at each update by itself: an update already processed does
    not take the rest of its mutation with it.
    """
    marks = offsets.filter(F.col("kind") == LOG).select(F.col("name").alias("__name"), P.position(P.segment_id(F.col("file")), F.col("pos")).alias("__mark"))
    name = F.concat_ws(".", "keyspace", "table")
    here = P.position(P.segment_id(F.col("file")), F.col("pos"))
    again = F.col("reprocess") if "reprocess" in updates.columns else F.lit(False)
    joined = updates.join(marks, name == F.col("__name"), "left")  # one row per table, of a size that Spark knows
    return joined.filter(F.col("__mark").isNull() | (here > F.col("__mark")) | again).drop("__name", "__mark")


def high_water(events: DataFrame) -> DataFrame:
    """The furthest position of each table among the events that may mark an offset, as offset rows."""
    far = events.groupBy(F.concat_ws(".", "keyspace", "table").alias("name")).agg(F.max(F.struct(P.segment_id(F.col("file")).alias("segment"), F.col("pos"), F.col("file"))).alias("at"))
    return far.select("name", F.when(F.col("at.segment") < 0, SNAPSHOT).otherwise(LOG).alias("kind"), "at.file", F.col("at.pos").cast("int").alias("pos"))


def advance(old: DataFrame, new: DataFrame) -> DataFrame:
    """Offsets never move back."""
    both = old.unionByName(new)
    best = both.groupBy("name", "kind").agg(F.max(F.struct(P.segment_id(F.col("file")).alias("segment"), F.col("pos"), F.col("file"))).alias("at"))
    return best.select("name", "kind", "at.file", "at.pos")


def pending_snapshots(tables: DataFrame, offsets: DataFrame, started: DataFrame | None = None) -> DataFrame:
    """Tables (``name``) without a snapshot offset and not started yet; presence alone counts."""
    left = tables.join(offsets.filter(F.col("kind") == SNAPSHOT).select("name"), "name", "left_anti")
    return left if started is None else left.join(started.select("name"), "name", "left_anti")


class FlushPolicy:
    """When to persist offsets: always (interval 0), or once the interval is over or ``max_records`` were marked."""

    def __init__(self, interval_ms: int = 0, max_records: int = 100, clock: Callable[[], float] = time.monotonic):
        self.interval, self.max_records, self.clock = interval_ms / 1000, max_records, clock
        self.last, self.marked = clock(), 0

    def should_flush(self, records: int = 1) -> bool:
        """To be asked with each lot of records that is marked."""
        if self.interval <= 0:
            return True
        if self.clock() - self.last >= self.interval or self.marked >= self.max_records:
            self.last, self.marked = self.clock(), 0
            return True
        self.marked += records
        return False


class Versions:
    """A small table in a folder of numbered versions: a writer adds the next and readers take the last; older ones than the one before are deleted."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema, self.lock = spark, path.rstrip("/"), schema, threading.RLock()

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        return folder, folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        folder, fs = self._fs()
        if not fs.exists(folder):
            return []
        names = [s.getPath() for s in fs.listStatus(folder)]
        jvm = self.spark.sparkContext._jvm
        done = [p.getName() for p in names if p.getName().isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(map(int, done))

    def load(self) -> DataFrame:
        found = self.versions()
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{found[-1]}") if found else self.spark.createDataFrame([], self.schema)

    def put(self, rows: DataFrame) -> None:
        found = self.versions()
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{(found[-1] if found else -1) + 1}")
        folder, fs = self._fs()
        for old in found[:-1]:
            fs.delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, str(old)), True)


class OffsetStore(Versions):
    """Offsets of all tables; log and snapshots may commit from different threads."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path, OFFSETS)

    def load(self) -> DataFrame:
        """As they are now, whatever is committed later."""
        with self.lock:
            rows = [tuple(r) for r in super().load().collect()] if self.versions() else []  # as many as tables
        return local_frame(self.spark, rows, OFFSETS)

    def commit(self, new: DataFrame) -> None:
        with self.lock:
            self.put(advance(self.load(), new))
