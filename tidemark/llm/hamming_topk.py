"""Exact top-k search in binary codes by incremental multi-index hashing.

An embedding's code has one bit per dimension (1 where the value is above 0).
Codes are cut into m segments; the index holds each different code once per
segment, in the shard of its segment value (a hash table of bounded size), so it
is m times the codes, however many queries there are.

The search goes by rounds.  In the round of radius s a query probes, in every
segment, the values at distance s from its own; it is sent only to the shards
that hold such values.  What it meets is verified by full Hamming distance and
merged with its k best so far.  All codes within m * (s + 1) - 1 have been met
after radius s, so a query retires as soon as its kth distance is within that.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bound_batches, discard, materialize, table

CELL = ["d", "seg", "shard", "sub"]
#: Queries that are probed together inside a task, and probes at once.
CHUNK, PROBES = 512, 400_000


def masks(width: int, radius: int) -> np.ndarray:
    """All values of ``width`` bits with ``radius`` of them set."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(width), radius)], np.int64)


def cuts(d: int, segment_bits: int) -> np.ndarray:
    """Where the segments of codes of ``d`` bits begin and end."""
    return np.linspace(0, d, max(1, int(d / segment_bits + 0.5)) + 1).astype(np.int64)


def pack(bits: np.ndarray) -> np.ndarray:
    """Rows of 0/1 as rows of 64-bit words."""
    n, d = bits.shape
    padded = np.zeros((n, -(-d // 64) * 64), np.uint8)
    padded[:, :d] = bits
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def segments(words: np.ndarray, d: int, at: np.ndarray) -> np.ndarray:
    """Segment values of packed codes, codes by segments."""
    bits = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")[:, :d]
    return np.stack([bits[:, a:b].astype(np.int64) @ (1 << np.arange(b - a, dtype=np.int64)) for a, b in zip(at, at[1:], strict=False)], axis=1)


def radii(width: int) -> Iterator[tuple[int, int]]:
    """Rounds as (first, last radius): one radius at a time to begin with, then half as far again, to the whole width."""
    low = 0
    while low <= width:
        high = min(width, low if low < 5 else low + low // 2)
        yield low, high
        low = high + 1


class Shard:
    """The hash table of one segment over the codes whose segment value has the shard's high bits."""

    def __init__(self, d: int, seg: int, shard: int, low_bits: int, codes: np.ndarray, at: np.ndarray, ids: list[np.ndarray]):
        self.d, self.seg, self.at, self.shard, self.low = d, seg, at, shard, low_bits
        self.words, self.parts, self.ids = codes, segments(codes, d, at), ids
        value = self.parts[:, seg] & ((1 << low_bits) - 1)
        self.order = np.argsort(value, kind="stable")
        self.sorted = value[self.order]
        self.value = value

    def probe(self, parts: np.ndarray, first: int, last: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, code) whose values in this segment differ in ``first`` to ``last`` bits."""
        own = parts[:, self.seg]
        high = np.bitwise_count(((own >> self.low) ^ self.shard).astype(np.uint64)).astype(np.int64)
        own = own & ((1 << self.low) - 1)
        for away in np.unique(high).tolist():
            rows = np.nonzero(high == away)[0]
            for flips in range(max(0, first - away), min(self.low, last - away) + 1):
                if (tried := masks_count(self.low, flips)) > len(self.value):  # more values than codes: look at the codes
                    for at in range(0, len(rows), step := max(1, PROBES // len(self.value))):
                        q = rows[at : at + step]
                        i, j = np.nonzero(np.bitwise_count((own[q][:, None] ^ self.value[None, :]).astype(np.uint64)) == flips)
                        yield q[i], j
                    continue
                change = masks(self.low, flips)
                for at in range(0, len(rows), step := max(1, PROBES // tried)):
                    q = rows[at : at + step]
                    values = (own[q][:, None] ^ change[None, :]).ravel()
                    start = np.searchsorted(self.sorted, values)
                    n = np.searchsorted(self.sorted, values, side="right") - start
                    hit = self.order[np.repeat(start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
                    yield np.repeat(np.repeat(q, tried), n), hit

    def search(self, ids: np.ndarray, words: np.ndarray, bound: np.ndarray, k: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(query, neighbour id, rows, distance): of what this round meets first, each query's k best within its bound."""
        parts, found = segments(words, self.d, self.at), []
        for q, c in self.probe(parts, first, last):
            dist = np.bitwise_count(self.words[c] ^ words[q]).sum(axis=1, dtype=np.int64)
            ok = dist <= bound[q]
            q, c, dist = q[ok], c[ok], dist[ok]
            apart = np.bitwise_count((self.parts[c] ^ parts[q]).astype(np.uint64))
            # Met in an earlier round through any segment, or in this one through an earlier segment.
            new = (apart >= first).all(axis=1) & ~(apart[:, : self.seg] <= last).any(axis=1)
            found.append((q[new], c[new], dist[new]))
        none = np.zeros(0, np.int64)
        q, c, dist = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (none, none, none)
        q, c, dist = _best(q, c, dist, k + 1)  # one of the codes may hold the query's own id only
        if not len(q):
            return none, none, none, none
        size = np.array([len(x) for x in self.ids])[c]
        pairs = np.concatenate([self.ids[x] for x in c.tolist()])
        q, dist = np.repeat(q, size), np.repeat(dist, size)
        other = pairs[:, 0] != ids[q]
        q, dist, pairs = q[other], dist[other], pairs[other]
        order = np.lexsort((pairs[:, 0], dist, q))
        q, dist, pairs = q[order], dist[order], pairs[order]
        keep = _rank(q) < k
        return q[keep], pairs[keep, 0], pairs[keep, 1], dist[keep]


def masks_count(width: int, radius: int) -> int:
    n = 1
    for i in range(radius):
        n = n * (width - i) // (i + 1)
    return n


def _rank(q: np.ndarray) -> np.ndarray:
    """Place of each row among those of its query, for rows sorted by query."""
    first = np.concatenate([[True], q[1:] != q[:-1]]) if len(q) else np.zeros(0, bool)
    at = np.arange(len(q))
    return at - np.maximum.accumulate(np.where(first, at, 0))


def _best(q: np.ndarray, c: np.ndarray, dist: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's codes up to the distance of its kth, ties included."""
    order = np.lexsort((dist, q))
    q, c, dist = q[order], c[order], dist[order]
    rank = _rank(q)
    limit = np.full(int(q.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    limit[q[rank == k - 1]] = dist[rank == k - 1]
    keep = dist <= limit[q]
    return q[keep], c[keep], dist[keep]


def _codes(column: pa.ChunkedArray, d: int) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<u8").reshape(len(rows), -(-d // 64))


def hamming_topk(
    rows: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", segment_bits: int | None = None, shard_rows: int = 16_384
) -> DataFrame:
    """``query_id, rank, neighbour_id, distance``: the k nearest rows of each query by Hamming distance, ties by smaller id.

    A query never finds rows of its own id.  Queries that repeat id and code are
    one query; an id with several codes is a query for each, with ranks of its
    own.  Repeated rows are rows of their own as neighbours.  Ids are integers;
    null ids, null or empty vectors are neither rows nor queries; values that
    are null or NaN give bit 0; only vectors of the same length are compared.
    With fewer than k rows all are returned; an empty table gives no rows.
    ``segment_bits`` is by default the logarithm of the number of codes.
    """
    spark = rows.sparkSession
    bound_batches(spark)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, lists = b.column(0).to_numpy(zero_copy_only=False), b.column(1)
            ends = np.asarray(lists.offsets)
            flat = np.asarray(lists.values.cast(pa.float64()).fill_null(0.0)) > 0  # NaN: False
            sizes = np.diff(ends)
            for d in np.unique(sizes).tolist():
                at = np.nonzero(sizes == d)[0]
                words = pack(flat[ends[:-1][at][:, None] + np.arange(d)[None, :]].astype(np.uint8))
                codes = pa.array([w.tobytes() for w in words], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(np.full(len(at), d, np.int32)), codes], names=["id", "d", "code"])

    def coded(df: DataFrame) -> DataFrame:
        some = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).filter("id IS NOT NULL AND size(v) > 0")
        return some.mapInArrow(code, "id long, d int, code binary")

    # Of each code the k + 1 smallest ids: what a query can need, one of them being its own.
    pairs = coded(rows).groupBy("d", "code", "id").agg(F.count("*").alias("n"))
    least = F.row_number().over(Window.partitionBy("d", "code").orderBy("id"))
    codes = pairs.withColumn("at", least).filter(F.col("at") <= k + 1).groupBy("d", "code").agg(F.collect_list(F.struct("id", "n")).alias("ids"))
    codes = materialize(codes, "topk-codes")
    asked = coded(queries).distinct().withColumnRenamed("id", "query_id").withColumn("bound", F.col("d"))
    best_schema = "query_id long, d int, code binary, neighbour_id long, n long, distance long"
    lengths = {r["d"]: r["n"] for r in codes.groupBy("d").agg(F.count("*").alias("n")).collect()}  # one row per vector length
    total = max(lengths.values(), default=0)
    asked = asked.filter(F.col("d").isin(*lengths) if lengths else F.lit(False))
    bits = segment_bits or min(20, max(8, round(log2(max(2, total)))))
    at = {d: cuts(d, bits) for d in lengths}
    narrow = min((int(np.diff(c).min()) for c in at.values()), default=0)
    # High bits of a segment value that name its shard.
    high = max(0, min(narrow, ceil(log2(max(1, total / shard_rows)))))
    wide = max((int(np.diff(c).max()) for c in at.values()), default=0)

    def place(df: DataFrame, schema: str, radius: int) -> DataFrame:
        """A row for each segment and each shard (``seg, shard``) whose high bits differ in up to ``radius`` from the code's."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            change = np.concatenate([masks(high, i) for i in range(min(high, radius) + 1)])
            for b in batches:
                ds, out = b.column("d").to_numpy(), [None] * b.num_rows
                for d in np.unique(ds).tolist():
                    rows = np.nonzero(ds == d)[0]
                    values = segments(_codes(b.column("code").take(pa.array(rows)), d), d, at[d]) >> (np.diff(at[d]) - high)[None, :]
                    for r, v in zip(rows.tolist(), values, strict=True):
                        out[r] = (v[:, None] ^ change[None, :]).tolist()
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.list_(pa.list_(pa.int64())))], names=[*b.schema.names, "shards"])

        each = df.mapInArrow(run, f"{schema}, shards array<array<long>>").select(*df.columns, F.posexplode("shards").alias("seg", "shards"))
        return each.select(*df.columns, "seg", F.explode("shards").alias("shard"))

    index = materialize(place(codes, "d int, code binary, ids array<struct<id:long,n:long>>", 0), "topk-index")
    extent = index.groupBy("d", "seg", "shard").agg(F.ceil(F.count("*") / shard_rows).alias("subs"))  # codes that crowd one value are dealt out
    extent = materialize(extent, "topk-extent")
    sub = F.pmod(F.xxhash64("code"), F.col("subs")).cast("int").alias("sub")
    none = "CAST(NULL AS long)"
    shards = materialize(index.join(extent, ["d", "seg", "shard"]).select("d", "seg", "shard", sub, F.lit(0).alias("kind"), "code", "ids", F.expr(none).alias("query_id"), F.lit(0).alias("bound")), "topk-shards")
    discard(index)

    def rounds(first: int, last: int):
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.Table] = []
            shard = cell = None
            for b in batches:
                t = pa.Table.from_batches([b])
                if not t.num_rows:
                    continue
                names = np.stack([t.column(c).to_numpy() for c in [*CELL, "kind"]], axis=1)
                edges = [0, *(np.nonzero((names[1:] != names[:-1]).any(axis=1))[0] + 1).tolist(), t.num_rows]
                for s, e in zip(edges, edges[1:], strict=False):
                    *here, kind = names[s].tolist()
                    if here != cell:
                        cell, held, shard = here, [], None
                    piece = t.slice(s, e - s)
                    if kind == 0:
                        held.append(piece)
                        continue
                    d, seg, number, _ = here
                    if shard is None and held:
                        all_ = pa.concat_tables(held)
                        ids = [np.array([(x["id"], x["n"]) for x in xs], np.int64) for xs in all_.column("ids").to_pylist()]
                        shard, held = Shard(d, seg, number, int(np.diff(at[d])[seg]) - high, _codes(all_.column("code"), d), at[d], ids), []
                    if shard is None:
                        continue
                    for lo in range(0, piece.num_rows, CHUNK):
                        part = piece.slice(lo, CHUNK)
                        ask = part.column("query_id").to_numpy()
                        q, near, n, dist = shard.search(ask, _codes(part.column("code"), d), part.column("bound").to_numpy(), k, first, last)
                        of = part.column("code").combine_chunks().take(pa.array(q))
                        columns = [pa.array(ask[q]), pa.array(np.full(len(q), d, np.int32)), of, pa.array(near), pa.array(n), pa.array(dist)]
                        yield pa.RecordBatch.from_arrays(columns, names=["query_id", "d", "code", "neighbour_id", "n", "distance"])

        return search

    each = Window.partitionBy("query_id", "d", "code").orderBy("distance", "neighbour_id")
    best = spark.createDataFrame([], best_schema)
    live, spent = materialize(asked, "topk-live"), []
    for first, last in radii(wide):
        sent = place(live.select("query_id", "d", "code", "bound"), "query_id long, d int, code binary, bound int", last).join(extent, ["d", "seg", "shard"])
        sent = sent.withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("subs").cast("int") - 1)))
        sent = sent.select(*CELL, F.lit(1).alias("kind"), "code", F.expr("CAST(NULL AS array<struct<id:long,n:long>>)").alias("ids"), "query_id", "bound")
        posed = shards.join(sent.select(*CELL).distinct(), CELL, "left_semi").union(sent) if first else shards.union(sent)
        met = posed.repartition(*CELL).sortWithinPartitions(*CELL, "kind").mapInArrow(rounds(first, last), best_schema)
        best = best.union(met).withColumn("at", F.row_number().over(each)).filter(F.col("at") <= k).drop("at")
        best = materialize(best, "topk-best")
        so_far = F.sum("n").over(each.rowsBetween(Window.unboundedPreceding, Window.currentRow))  # over at most k rows a query
        kth = best.withColumn("rows", so_far).filter(F.col("rows") >= k).groupBy("query_id", "d", "code").agg(F.min("distance").cast("int").alias("kth"))
        covered = F.lit(last + 1) * F.greatest(F.lit(1), F.floor(F.col("d") / bits + 0.5)) - 1  # as many segments as in cuts()
        left = live.join(kth, ["query_id", "d", "code"], "left").filter(F.col("kth").isNull() | (F.col("kth") > covered))
        left = materialize(left.select("query_id", "d", "code", F.coalesce("kth", "bound").alias("bound")), "topk-live")
        discard(*spent, live)
        live, spent = left, [best]
        if live.isEmpty():
            break
    discard(live, shards, extent, codes)
    one = best.withColumn("one", F.explode(F.sequence(F.lit(1).cast("long"), F.least("n", F.lit(k)))))
    rank = F.row_number().over(Window.partitionBy("query_id", "d", "code").orderBy("distance", "neighbour_id"))  # at most k * k rows
    return one.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= k).select("query_id", "rank", "neighbour_id", "distance")


def op8_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return hamming_topk(rows, rows.filter("vec_id % 20 = 0"))


OP8_SQL = """
WITH b AS (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS bits FROM embeddings),
p AS (SELECT q.vec_id AS query_id, r.vec_id AS neighbour_id,
             CAST(list_sum(list_transform(list_zip(q.bits, r.bits), lambda z: CASE WHEN z[1] <> z[2] THEN 1 ELSE 0 END)) AS BIGINT) AS distance
      FROM b q JOIN b r ON q.vec_id % 20 = 0 AND q.vec_id <> r.vec_id AND len(q.bits) = len(r.bits))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS rank, neighbour_id, distance
FROM p QUALIFY rank <= 10
"""
