"""The open mutation log: one row per mutation, its updates and rows nested.

Files are JSON lines or parquet with ``LOG_SCHEMA``.  Values travel as text
(JSON for composite types), so one schema serves every table.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import position as P

BOUND = "struct<method:string,values:array<struct<name:string,value:string,type:string>>>"
CELL = "struct<value:string,tombstone:boolean,expires_at:bigint>"
#: kind: ROW, RANGE_OPEN, RANGE_CLOSE or RANGE_BOUNDARY (closes one range and opens the next).
ROW = (
    f"struct<seq:bigint,kind:string,liveness_ts:bigint,deleted_at:bigint,written_at:bigint,clustering:map<string,string>,"
    f"cells:map<string,{CELL}>,open_bound:{BOUND},close_bound:{BOUND}>"
)
UPDATE = f"struct<table:string,is_counter:boolean,is_view:boolean,is_index:boolean,partition_key:map<string,string>,partition_deleted_at:bigint,rows:array<{ROW}>>"
LOG_SCHEMA = f"file string, pos int, tracked_by_cdc boolean, keyspace string, updates array<{UPDATE}>"


#: A line of the log before it is parsed; ``eof`` marks the last row of a complete segment, which may have no mutation.
LINES = pa.schema([("file", pa.string()), ("at", pa.int64()), ("mutation", pa.string()), ("eof", pa.bool_())])


def parsed(lines: DataFrame) -> DataFrame:
    """``LOG_SCHEMA`` from ``LINES``, with ``at``, ``eof`` and ``broken``: the text of a line that is no mutation."""
    fields = LOG_SCHEMA.removeprefix("file string, ")
    m = F.from_json("mutation", f"{fields}, broken string", {"columnNameOfCorruptRecord": "broken"})
    none = F.col("m.pos").isNull() & F.col("m.keyspace").isNull()  # JSON, but no mutation
    broken = F.coalesce("m.broken", F.when(none, F.col("mutation"))).alias("broken")
    return lines.withColumn("m", m).select("file", "m.pos", "m.tracked_by_cdc", "m.keyspace", "m.updates", "at", "eof", broken)


def read_log(spark: SparkSession, path: str, format: str = "json") -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).format(format).load(path)


def list_segments(spark: SparkSession, directory: str) -> DataFrame:
    """Segment files of a directory: ``path, name, segment, bytes, modified``, by file metadata only."""
    return _listed(spark, directory, "CommitLog-*.log").filter(P.is_segment(F.col("name")))


def list_indexes(spark: SparkSession, directory: str) -> DataFrame:
    """Index files with what they say: ``path, name, segment, log_name, synced, completed``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*_cdc.idx").load(directory)
    name = F.substring_index("path", "/", -1)
    read = files.select("path", name.alias("name"), P.parse_index(F.decode("content", "UTF-8")).alias("index"))
    return read.filter(P.is_index(F.col("name"))).select("path", "name", P.segment_id(F.col("name")).alias("segment"), P.index_to_segment(F.col("name")).alias("log_name"), "index.synced", "index.completed")


def _listed(spark: SparkSession, directory: str, pattern: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
    name = F.substring_index("path", "/", -1)
    return files.select("path", name.alias("name"), P.segment_id(name).alias("segment"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def ordered(log: DataFrame) -> DataFrame:
    """Global log order: segment id (a number, not text), then position."""
    return log.orderBy(P.segment_id(F.col("file")), "pos")


def latest_segment(segments: DataFrame) -> DataFrame:
    """The last modified segment only."""
    return segments.agg(F.max_by(F.struct(*segments.columns), F.struct("modified", "segment")).alias("s")).filter("s IS NOT NULL").select("s.*")


def directory_bytes(segments: DataFrame) -> DataFrame:
    return segments.agg(F.coalesce(F.sum("bytes"), F.lit(0)).cast("long").alias("total_bytes"), F.count("*").alias("files"))


def with_error_segments(log: DataFrame, errors: DataFrame) -> DataFrame:
    """The log and the segments to be read again, flagged so that the offset filter lets them pass."""
    return log.withColumn("reprocess", F.lit(False)).unionByName(errors.withColumn("reprocess", F.lit(True)))


def updates(log: DataFrame) -> DataFrame:
    """One row per partition update, its place ``update_no`` in the mutation kept."""
    rest = [c for c in log.columns if c != "updates"]
    return log.select(*rest, F.posexplode("updates").alias("update_no", "u")).select(*rest, "update_no", "u.*")
