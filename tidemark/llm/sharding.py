"""Sharding: global byte-size prefix sums from per-partition totals, cut at equal targets.

Documents are put in one global order (content hash, id, size), so equal texts
lie side by side; a sampled range partitioning with the id in the key spreads
even a hot text.  Each partition numbers its rows and bytes by itself; the
driver adds up only the per-partition totals (one row per partition).  A
document goes to the shard in which the middle of its bytes falls, so shards
are contiguous in that order and differ by less than one document's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialize, table, width

_LOCAL = "doc_id long, size long, text_crc32 long, part int, before long, row long"


def _running(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Bytes and rows before each row of this partition, carried from batch to batch."""
    part, before, row = TaskContext.get().partitionId(), 0, 0
    for b in batches:
        ends = b["size"].cumsum() + before
        yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "size": b["size"], "text_crc32": b["text_crc32"], "part": part, "before": ends - b["size"], "row": range(row, row + len(b))})
        before, row = int(ends.iloc[-1]) if len(b) else before, row + len(b)


def shard_by_bytes(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` with law ``bytes``.

    ``size`` is the text's UTF-8 bytes plus 1 (null text: 1), ``slot`` counts
    from 0 inside a shard without gaps.  With fewer bytes than shards some
    shards stay empty.  Repeated rows each get a slot; an empty table gives no
    rows; other columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h")
    )
    sized = materialize(sized, "shard-sizes")
    order = ["h", "doc_id", "size", "text_crc32"]
    local = sized.repartitionByRange(width(spark), *order).sortWithinPartitions(*order).mapInPandas(_running, _LOCAL)
    local = materialize(local, "shard-local")
    discard(sized)
    totals = sorted(local.groupBy("part").agg(F.sum("size").alias("size"), F.count("*").alias("rows")).collect())
    starts, total, rows = [], 0, 0
    for t in totals:
        starts.append((t["part"], total, rows))
        total, rows = total + t["size"], rows + t["rows"]
    starts = spark.createDataFrame(starts, "part int, bytes_off long, rows_off long")
    middle = 2 * (F.col("bytes_off") + F.col("before")) + F.col("size")
    placed = local.join(F.broadcast(starts), "part").select(
        "doc_id", "size", "text_crc32", F.least(F.lit(n_shards - 1), F.floor(middle * n_shards / (2 * max(total, 1)))).cast("int").alias("shard"), (F.col("rows_off") + F.col("row")).alias("row")
    )
    first = placed.groupBy("shard").agg(F.min("row").alias("first"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first")).alias("slot"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_by_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
