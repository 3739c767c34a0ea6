"""Exact dedup: group by a 128-bit content hash, keep the smallest id, compare bytes inside groups.

The groups are built with ``GROUP BY hash, text``: Spark compares the bytes of
the texts themselves, and the map-side half merges the copies of a hot text
before anything is shuffled.  Only hash, count and smallest id travel on.  A
hash under which two different texts were found (a collision) is resolved by
joining on the text as well; that join is planned only when one exists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, materialize, table


def normalise(text: Column) -> Column:
    """Each run of white space becomes one space.  Runs that are one plain space already are not touched."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"(?:[\x09-\x0D]|\x20(?=[{SPACE}]))[{SPACE}]*", " ")


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_fn=content_hash) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Null and empty texts are equal to each other.  ``group_size`` counts rows.
    Rows that repeat both id and text are the same document and share its
    decision.  A null id is never the smallest unless the whole group has null
    ids.  Other columns of ``docs`` are ignored; an empty table gives no rows.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), normalise(F.col(text_col)).alias("norm"))
    rows = base.withColumn("h", hash_fn(F.col("norm")))
    texts = rows.groupBy("h", "norm").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n"))
    texts = texts.select("h", "keep_id", "n", F.sha2("norm", 256).alias("sha"))
    by_hash = texts.groupBy("h").agg(
        F.count("*").alias("texts"), F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size"), F.min("sha").alias("text_sha256")
    )
    by_hash = materialize(by_hash, "exact-dedup")
    single = rows.select("doc_id", "h").join(by_hash.filter("texts = 1").drop("texts"), "h")
    columns = ["doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"]
    out = single.select(*columns)
    if not (clash := by_hash.filter("texts > 1").select("h")).isEmpty():
        mixed = rows.join(clash, "h", "left_semi")
        exact = mixed.groupBy("h", "norm").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        out = out.union(mixed.join(exact, ["h", "norm"]).withColumn("text_sha256", F.sha2("norm", 256)).select(*columns))
    return out


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g ON d.norm = g.norm
"""
