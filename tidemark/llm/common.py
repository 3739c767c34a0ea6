"""Helpers shared by the operators: the shared folder, materialised steps, connected components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of every contract in this package, as the inside of a character class.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only where the session names none and runs on this machine alone (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: executors need a folder that all of them share")
        found = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Within this block Spark deletes a job's shuffle files when it ends, instead of at some later collection of the driver's garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark/{tag}-{uuid.uuid4().hex}"
    with swept(spark):
        df.write.parquet(path)
    at, files = _hadoop(spark, path)
    files.deleteOnExit(at)  # what a result still reads stays until the driver ends
    out = spark.read.schema(df.schema).parquet(path)
    out.materialized_at = path
    return out


def _hadoop(spark: SparkSession, path: str) -> tuple:
    """A path and its file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def discard(*frames: DataFrame) -> None:
    """Delete materialised steps of which all that was derived is written by now."""
    for df in frames:
        at, files = _hadoop(df.sparkSession, df.materialized_at)
        files.delete(at, True)
        files.cancelDeleteOnExit(at)


def bound_batches(spark: SparkSession, size: str = "8m") -> None:
    """Arrow batches of about ``size`` bytes instead of the default 64 MB, unless the session has set its own bound.

    A worker and the JVM each hold a few batches at once; with long texts these are what fills their memory."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in ("67108864b", "64m", "67108864"):
        spark.conf.set(key, size)


def share(spark: SparkSession, value) -> Callable:
    """Broadcast a value of bounded size; the function returned gives it on executors, unpickled once per worker process."""
    box = spark.sparkContext.broadcast({"pickled": cloudpickle.dumps(value)})

    def fetch():
        if "value" not in box.value:
            box.value["value"] = cloudpickle.loads(box.value.pop("pickled"))  # only one of the two stays
        return box.value["value"]

    return fetch


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, tag: str) -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(id, label)``, label the smallest id reached.

    A round hooks each id to its smallest neighbour, follows hooks to their end by pointer jumping and
    puts these ends in place of the ids in all edges.  Loops and repeats go, and an end is smaller than all
    its neighbours, so at most half of the ids remain: only the first round joins all edges, however
    many rounds a shape takes.  Each step is written to the shared folder; only flags reach the driver.
    """
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    left = materialize(edges.select(low, high).distinct(), f"{tag}-edges")
    labels: DataFrame | None = None
    while True:
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends = materialize(both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("label")), f"{tag}-ends")
        moved = True
        while moved:
            jump = ends.select(F.col("id").alias("label"), F.col("label").alias("jump"))
            step = ends.join(jump, "label").select("id", F.col("jump").alias("label"), (F.col("jump") < F.col("label")).alias("moved"))
            old, ends = ends, materialize(step, f"{tag}-ends")
            discard(old)
            moved = not ends.filter("moved").isEmpty()
        if labels is None:
            labels = ends
        else:
            end = ends.select(F.col("id").alias("label"), F.col("label").alias("end"))
            old, labels = labels, materialize(labels.join(end, "label", "left").select("id", F.coalesce("end", "label").alias("label")), f"{tag}-labels")
            discard(old)
        of_a, of_b = (ends.select(F.col("id").alias(c), F.col("label").alias(f"{c}_end")) for c in "ab")
        kept = left.join(of_a, "a").join(of_b, "b").filter("a_end <> b_end").select(F.col("a_end").alias("a"), F.col("b_end").alias("b"))
        old, left = left, materialize(kept.select(low, high).distinct(), f"{tag}-edges")
        discard(old, *([] if ends is labels else [ends]))
        if left.isEmpty():
            discard(left)
            return labels.select("id", "label")
