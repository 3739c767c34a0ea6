"""Line dedup: levelled sorted runs of line hashes; each new batch merge-anti-joins the runs and adds its own.

``LineRuns`` is the store: a run is a table bucketed and sorted by line hash, so
a batch joins all runs without moving them.  When a level holds ``fanout`` runs
they are merged into one run of the next level.  Batches arrive in descending
order of id, so the batch in which a line is new (anti-join) names its holder,
the largest id; later batches only add to its count.

Everything here is DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialize, swept, table, width

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


class LineRuns:
    """Sorted runs of ``(h, docs, holder)`` in levels; ``holder`` is set only where a line was new."""

    def __init__(self, spark: SparkSession, buckets: int, fanout: int = 2):
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.levels: list[list[str]] = []
        self.tables: set[str] = set()  # in the warehouse now, also if a write broke off

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.tables.add(name)
        with swept(self.spark):
            rows.repartition(self.buckets, "h").write.bucketBy(self.buckets, "h").sortBy("h").saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.tables.discard(name)

    def _merged(self, names: list[str]) -> DataFrame:
        """Runs merged by hash; two runs are joined bucket by bucket, in order, without a shuffle."""
        out = self.spark.table(names[0])
        for name in names[1:]:
            other = self.spark.table(name).select("h", F.col("docs").alias("more"), F.col("holder").alias("other"))
            docs = F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))
            out = out.join(other, "h", "full_outer").select("h", docs.alias("docs"), F.greatest("holder", "other").alias("holder"))
        return out

    def runs(self) -> list[str]:
        return [x for level in self.levels for x in level]

    def add(self, lines: DataFrame) -> None:
        """Add a batch of ``(h, doc_id)``, one row per occurrence, ids not above those added before.

        One merge join with each run, none of which moves a run, tells what is new (met in no run) from what only counts on."""
        pairs = lines.groupBy("h", "doc_id").agg(F.lit(1).alias("one"))
        own = pairs.groupBy("h").agg(F.count("*").alias("docs"), F.max("doc_id").alias("holder"))
        new = F.lit(True)
        for i, name in enumerate(self.runs()):
            own = own.join(self.spark.table(name).select("h", F.lit(True).alias(f"met{i}")), "h", "left")
            new = new & F.col(f"met{i}").isNull()
        self._push(0, self._write(own.select("h", "docs", F.when(new, F.col("holder")).alias("holder"))))

    def _push(self, level: int, name: str) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            merged = self._write(self._merged(full))
            for x in full:
                self._drop(x)
            self._push(level + 1, merged)

    def state(self) -> DataFrame:
        """``(h, docs, holder)``, one row per line hash."""
        return self._merged(self.runs())

    def close(self) -> None:
        for x in sorted(self.tables):
            self._drop(x)
        self.levels = []


def mark_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5, batches: int = 4, fanout: int = 2) -> DataFrame:
    """``docs`` with ``__lines`` (all lines) and ``__drop`` (ascending 0-based positions to drop, null: none).

    Null or empty text is one empty line.  A key found in ``min_docs`` or more
    distinct ids loses all its lines except in the largest id holding it.  Rows
    that repeat an id count as one document; a null id counts as one document
    and never holds a line.  Columns of ``docs`` stay; names that start with
    two underscores are the operator's own.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text).alias("row"),
        F.posexplode(F.transform(F.split(text, "\n"), lambda x: F.when(F.char_length(line_key(x)) >= min_chars, F.md5(line_key(x))))).alias("pos", "h"),
    )
    lines = materialize(keyed.filter("h IS NOT NULL").withColumn("h", F.unhex("h")), "line-hashes")
    cuts = lines.agg(F.percentile_approx("doc_id", [i / batches for i in range(batches - 1, 0, -1)], 1000)).first()[0] if batches > 1 else []
    runs = LineRuns(spark, width(spark), fanout)
    tops = [None, *(cuts or [])]
    try:
        for top, low in zip(tops, [*tops[1:], None], strict=True):
            part = lines if low is None else lines.filter(F.col("doc_id") > low)
            part = part if top is None else part.filter((F.col("doc_id") <= top) | F.col("doc_id").isNull()) if low is None else part.filter(F.col("doc_id") <= top)
            runs.add(part.select("h", "doc_id"))
        common = materialize(runs.state().filter(F.col("docs") >= min_docs).select("h", "holder"), "line-common")
    finally:
        runs.close()
    drop = lines.join(common, "h").filter(~F.col("doc_id").eqNullSafe(F.col("holder")))
    drop = drop.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("pos")).alias("__drop"))
    drop = materialize(drop.select(F.col("doc_id").alias("__id"), F.col("row").alias("__other"), "__drop"), "line-drop")
    discard(lines, common)
    left = docs.withColumns({"__row": F.xxhash64(text), "__lines": F.split(text, "\n")})
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.col("__row") == F.col("__other"))
    return left.join(drop, same, "left").drop("__id", "__other", "__row")


def kept_text(lines: Column, drop: Column) -> Column:
    """The lines between dropped positions, as slices: linear in the lines, however many are dropped."""
    ends = F.concat(F.array(F.lit(-1)), drop, F.array(F.size(lines)))
    between = F.transform(F.sequence(F.lit(1), F.size(drop) + 1), lambda i: F.slice(lines, F.get(ends, i - 1) + 2, F.get(ends, i) - F.get(ends, i - 1) - 1))
    return F.when(drop.isNull(), F.array_join(lines, "\n")).otherwise(F.array_join(F.flatten(between), "\n"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``docs`` with the kept text in ``text_col`` and columns ``n_lines, n_dropped`` added (see ``mark_lines``).

    Existing columns of those two names are replaced.
    """
    marked = mark_lines(docs, id_col, text_col, **params)
    return marked.withColumns(
        {text_col: kept_text(F.col("__lines"), F.col("__drop")), "n_lines": F.size("__lines").cast("long"), "n_dropped": F.coalesce(F.size("__drop"), F.lit(0)).cast("long")}
    ).drop("__lines", "__drop")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT doc_id, pos, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id <> c.holder AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
