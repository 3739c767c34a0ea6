"""Suffix-array dedup: remove every byte covered by a 200-byte string that starts anywhere else as well.

Sorting all suffixes by 200 bytes would move the input two hundred times, so the
suffix array is sparse, without losing a match:

1. Winnowing picks positions by content: in each window of ``length`` bytes the
   32-byte gram of smallest hash is an anchor.  Equal windows have their anchor
   at the same place, so only suffixes at anchors that occur twice matter.
2. An anchor's context holds every window that can contain it.  Where two
   anchors have equal contexts (equal 64-bit anchors and equal 128-bit hashes),
   all those windows repeat, and no bytes move.  In uniform or periodic text
   equal contexts follow each other; such a run is one row.
3. What is left are the borders of repeats.  One holder of each different context
   sends its bytes; sampled splitters range-partition these suffixes by their
   leading tokens (the anchor gram), and each bucket sorts them by multikey
   quicksort on 8-byte words and compares neighbours (few suffixes of the same
   start are compared pairwise at once).  Suffixes of equal start are in one
   range, so no match crosses a bucket's boundary; a start with more than
   ``cap`` different contexts leaves the buckets and is grouped by window
   across the cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, discard, materialize, table, width
from .ngram_join import _groups

GRAM = 32
#: Bytes handled at once inside an Arrow batch, also of one longer text; positions in it fit into 24 bits.
STEP = 1 << 22
_LOW = np.uint64((1 << 24) - 1)
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M2
    return x ^ (x >> np.uint64(29))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 32 bytes from each position on."""
    words = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1))
    words = np.ascontiguousarray(words).view("<u8").ravel()
    n = len(data) - GRAM + 1
    h = words[:n] * _M1
    for k in range(1, GRAM // 8):
        h = _mix(h) + words[8 * k : 8 * k + n] * _M1
    return _mix(h)


def anchors(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, position in it, gram hash) of the anchors of concatenated documents."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(data) < length:
        return none
    h = gram_hashes(data)
    key = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
    span, have = length - GRAM + 1, 1
    while have * 2 <= span:
        key = np.minimum(key[:-have], key[have:])
        have *= 2
    if have < span:
        key = np.minimum(key[: len(key) - (span - have)], key[span - have :])
    # Windows that lie inside one document.
    inside = np.zeros(len(key) + 1, np.int64)
    long = sizes >= length
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, np.minimum(starts[long] + sizes[long] - length + 1, len(key)), -1)
    at = np.unique((key[np.cumsum(inside[:-1]) > 0] & _LOW).astype(np.int64))
    doc = np.searchsorted(starts, at, side="right") - 1
    return doc, at - starts[doc], h[at]


def runs(doc: np.ndarray, pos: np.ndarray, c: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of successive anchors of a document with equal contexts at most ``length`` apart.

    Uniform and periodic text has an anchor at each period; its spans overlap, so a run is one row."""
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (c[1:] != c[:-1]).any(axis=1) | (np.diff(pos) > length)
    first = np.nonzero(new)[0]
    return first, np.append(first[1:], len(doc)) - 1 if len(first) else first


def _pieces(texts: pa.Array) -> Iterator[tuple[int, int, list[bytes]]]:
    first, size, held = 0, 0, []
    for i, t in enumerate(texts):
        b = (t.as_py() or "").encode()
        if held and size + len(b) > STEP:
            yield first, i, held
            first, size, held = i, 0, []
        held.append(b)
        size += len(b)
    if held:
        yield first, first + len(held), held


def text_anchors(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``anchors`` of whole texts.  A text above STEP bytes is cut into pieces that overlap by ``length - 1`` bytes, so that each window lies in one piece."""
    sizes = np.array([len(t) for t in texts], np.int64)
    step = max(STEP, 2 * length)
    if sizes.sum() <= step:
        return anchors(np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes) - sizes, sizes, length)
    out = []
    for i, t in enumerate(texts):
        found = []
        for at in range(0, max(1, len(t) - length + 1), step - length + 1):
            piece = np.frombuffer(t, np.uint8)[at : at + step]
            _, pos, h = anchors(piece, np.zeros(1, np.int64), np.array([len(piece)], np.int64), length)
            found.append((pos + at, h))
        pos, first = np.unique(np.concatenate([p for p, _ in found]), return_index=True)  # an anchor in an overlap may come twice
        out.append((np.full(len(pos), i, np.int64), pos, np.concatenate([h for _, h in found])[first]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def multikey_order(words: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of rows of words inside groups: the sorted order, and a flag for each row that equals another.

    All partitions of one depth are split at once by the next word; a partition of one row is done."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    order = np.argsort(group, kind="stable")
    part = np.cumsum(np.concatenate([[0], np.diff(group[order]) != 0]))
    at, equal = np.arange(len(order)), np.zeros(len(order), bool)
    many = np.bincount(part)[part] > 1
    at, part = at[many], part[many]
    for d in range(words.shape[1]):
        if not len(at):
            break
        rows = order[at]
        value = words[rows, d]
        k = np.lexsort((value, part))
        rows, value, part = rows[k], value[k], part[k]
        order[at] = rows
        new = np.ones(len(at), bool)
        new[1:] = (part[1:] != part[:-1]) | (value[1:] != value[:-1])
        part = np.cumsum(new) - 1
        many = np.bincount(part)[part] > 1
        at, part = at[many], part[many]
    equal[order[at]] = True
    return order, equal


def _words(b: np.ndarray) -> np.ndarray:
    """Rows of bytes as rows of big-endian words, padded with zeros."""
    b = np.concatenate([b, np.zeros((len(b), -b.shape[1] % 8), np.uint8)], axis=1)
    return b.view(">u8").astype(np.uint64)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of rows."""
    same = a == b
    return np.where(same.all(axis=1), a.shape[1], same.argmin(axis=1)).astype(np.int16)


def _reach(lcp: np.ndarray) -> np.ndarray:
    """Common prefixes of all pairs of a sorted group from those of neighbours: minima over ranges."""
    g = len(lcp) + 1
    out = np.zeros((g, g), np.int16)
    for i in range(g - 1):
        out[i, i + 1 :] = out[i + 1 :, i] = np.minimum.accumulate(lcp[i:])
    return out


def _mark(diff: np.ndarray, a: np.ndarray, b: np.ndarray, lo: np.ndarray, hi: np.ndarray, right: np.ndarray, left: np.ndarray, length: int) -> None:
    """Add the windows that rows a and b share, given how far they agree on both sides of the anchor (as differences along the offsets)."""
    first = np.maximum(np.maximum(length - right.astype(np.int64), lo[a]), lo[b])
    last = np.minimum(np.minimum(left.astype(np.int64), hi[a]), hi[b])
    ok = first <= last
    wide, flat = diff.shape[1], diff.ravel()
    rows = np.concatenate([a[ok], b[ok]]) * wide
    np.add.at(flat, rows + np.tile(first[ok], 2), 1)
    np.add.at(flat, rows + np.tile(last[ok] + 1, 2), -1)


def _pairwise(m: np.ndarray, lo: np.ndarray, hi: np.ndarray, i: np.ndarray, j: np.ndarray, length: int, out: np.ndarray) -> None:
    back = length - GRAM
    for at in range(0, len(i), 20_000):
        a, b = i[at : at + 20_000], j[at : at + 20_000]
        _mark(out, a, b, lo, hi, _common(m[a, back:], m[b, back:]), _common(m[a, :back][:, ::-1], m[b, :back][:, ::-1]), length)


def repeated_windows(m: np.ndarray, lo: np.ndarray, hi: np.ndarray, group: np.ndarray, length: int, few: int = 12, large: int = 1500) -> np.ndarray:
    """Rows by offsets: whether the window that starts ``offset`` bytes before the anchor occurs in another row of the group.

    ``m`` holds contexts aligned at the anchor, ``lo`` and ``hi`` each row's offsets that lie inside its document.
    Groups of up to ``few`` rows are compared pairwise.  Up to ``large``, the suffixes at the anchor and the reversed
    prefixes before it are sorted; neighbours in either order give what any two rows share on either side.  Beyond
    that, the windows of each offset are sorted by themselves."""
    back = length - GRAM
    diff = np.zeros((len(m), back + 2), np.int32)
    cuts = np.concatenate([[0], np.nonzero(np.diff(group))[0] + 1, [len(group)]])
    sizes = np.diff(cuts)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    middle = np.repeat((sizes > few) & (sizes <= large), sizes)
    if middle.any():
        at = np.nonzero(middle)[0]
        right, left = m[at, back:], m[at, :back][:, ::-1]
        r_order, _ = multikey_order(_words(right), group[at])
        l_order, _ = multikey_order(_words(np.ascontiguousarray(left)), group[at])
        r_next, l_next = _common(right[r_order[:-1]], right[r_order[1:]]), _common(left[l_order[:-1]], left[l_order[1:]])
        start = 0
        for g in sizes[(sizes > few) & (sizes <= large)].tolist():
            ro, lo_ = r_order[start : start + g], l_order[start : start + g]
            r = _reach(r_next[start : start + g - 1])
            place = np.empty(g, np.int64)
            place[lo_ - start] = np.arange(g)
            place = place[ro - start]
            l = _reach(l_next[start : start + g - 1])[np.ix_(place, place)]
            i, j = np.nonzero(np.triu(r + l >= length, 1))
            a, b = at[ro[i]], at[ro[j]]
            _mark(diff, a, b, lo, hi, r[i, j], l[i, j], length)
            start += g
    for s, e in zip(cuts, cuts[1:], strict=False):
        g = int(e - s)
        if g == 2:
            pairs.append((np.array([s]), np.array([s + 1])))
        elif g <= few:
            i, j = np.triu_indices(g, 1)
            pairs.append((i + s, j + s))
        elif g > large:
            for o in range(back + 1):
                rows = s + np.nonzero((lo[s:e] <= o) & (o <= hi[s:e]))[0]
                if len(rows) > 1:
                    _, equal = multikey_order(_words(np.ascontiguousarray(m[rows, back - o : back - o + length])), np.zeros(len(rows), np.int64))
                    diff[rows[equal], o] += 1
                    diff[rows[equal], o + 1] -= 1
    if pairs:
        i, j = (np.concatenate(x) for x in zip(*pairs, strict=True))
        _pairwise(m, lo, hi, i, j, length, diff)
    return np.cumsum(diff[:, :-1], axis=1) > 0


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            if e > out[-1][1]:
                out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
    return out


def repeated_spans(docs: DataFrame, length: int = 200, cap: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """``doc_id, row, s, e`` in two parts: byte spans, maybe overlapping, that cover exactly what repeats; from ``(doc_id, row, text)``."""
    spark, back = docs.sparkSession, length - GRAM
    bound_batches(spark)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, _, texts in _pieces(batch.column(2)):
                sizes = np.array([len(t) for t in texts], np.int64)
                doc, pos, h = text_anchors(texts, length)
                digests = [xxhash.xxh3_128_digest(texts[d][max(0, p - back) : p + length], seed=min(p, back)) for d, p in zip(doc.tolist(), pos.tolist(), strict=True)]
                c = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                i, j = runs(doc, pos, c, length)
                d = doc[i].tolist()
                columns = [[ids[first + x] for x in d], [keys[first + x] for x in d], sizes[doc[i]], pos[i], pos[j], j - i + 1, h[i].view(np.int64), c[i, 0], c[i, 1]]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["doc_id", "row", "n", "pos", "last", "times", "h", "c", "c2"])

    found = materialize(docs.select("doc_id", "row", "text").filter(F.octet_length("text") >= length).mapInArrow(find, "doc_id long, row long, n long, pos long, last long, times long, h long, c long, c2 long"), "suffix-anchors")
    ends = [f(x).alias(f"{name}_{x}") for x in ("c", "c2") for name, f in (("low", F.min), ("top", F.max))]
    often = found.groupBy("h").agg(F.sum("times").alias("times"), *ends).filter("times > 1")
    often = materialize(often.select("h", F.expr("low_c <> top_c OR low_c2 <> top_c2").alias("mixed")), "suffix-often")  # a join of its own, whose hot gram Spark can split
    again = materialize(found.join(often, "h"), "suffix-again")
    discard(found, often)
    kinds = again.filter("mixed").groupBy("h", "c", "c2").agg(F.sum("times").alias("times"), F.min(F.struct("doc_id", "row", "n", "pos")).alias("at"))
    kinds = materialize(kinds, "suffix-kinds")
    lone = kinds.filter("times = 1").select("h", "c", "c2")
    whole = again.filter("NOT mixed").union(again.filter("mixed").join(lone, ["h", "c", "c2"], "left_anti").select(again.columns))
    whole = whole.select("doc_id", "row", F.greatest(F.lit(0), F.col("pos") - back).alias("s"), (F.least("last", F.col("n") - length) + length).alias("e"))
    whole = materialize(whole, "suffix-whole")
    discard(again)

    # The bytes of one holder of each different context.
    asked = kinds.groupBy("at.doc_id", "at.row").agg(F.collect_list(F.struct("at.pos", "h", F.col("times").alias("times"))).alias("asked"))
    asked = materialize(asked, "suffix-asked")
    discard(kinds)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, texts, lists = (batch.column(i) for i in range(4))
            out = []
            for d, r, t, asks in zip(ids.to_pylist(), keys.to_pylist(), texts, lists, strict=True):
                b = t.as_py().encode()
                for x in asks.as_py():
                    p = x["pos"]
                    ctx = b[max(0, p - back) : p + length]
                    left = min(p, back)
                    ctx = bytes(back - left) + ctx + bytes(back + length - (back - left) - len(ctx))
                    out.append((ctx[back : back + GRAM], x["h"], x["times"], d, r, p, max(0, p + length - len(b)), left, ctx))
                if len(out) > 10_000:
                    yield _rows(out)
            if out:
                yield _rows(out)

    names = ["lead", "h", "times", "doc_id", "row", "pos", "lo", "hi", "ctx"]
    types = [pa.binary(), *[pa.int64()] * 7, pa.binary()]

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*out, strict=True))
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    posed = docs.join(asked, ["doc_id", "row"]).select("doc_id", "row", "text", "asked")
    contexts = posed.mapInArrow(fetch, "lead binary, h long, times long, doc_id long, row long, pos long, lo long, hi long, ctx binary")
    contexts = materialize(contexts, "suffix-contexts")
    discard(asked)
    hot = materialize(contexts.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > cap).select("h"), "suffix-hot")
    spread = not hot.isEmpty()
    local = contexts.join(hot, "h", "left_anti").select(names) if spread else contexts
    out = "doc_id long, row long, s long, e long"

    def spans(g: pa.Table, flags: np.ndarray) -> pa.RecordBatch:
        edge = np.diff(np.pad(flags.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        r, first = np.nonzero(edge == 1)
        _, last = np.nonzero(edge == -1)
        pos = g.column("pos").to_numpy()[r]
        of = [g.column(c).combine_chunks().take(pa.array(r)) for c in ("doc_id", "row")]
        return pa.RecordBatch.from_arrays([*of, pa.array(pos - last + 1), pa.array(pos - first + length)], names=["doc_id", "row", "s", "e"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0

        def run() -> pa.RecordBatch:
            g = pa.concat_tables(held)
            m = np.frombuffer(b"".join(g.column("ctx").to_pylist()), np.uint8).reshape(g.num_rows, -1)
            group = np.cumsum(np.concatenate([[0], np.diff(g.column("h").to_numpy()) != 0]))
            flags = repeated_windows(m, g.column("lo").to_numpy(), g.column("hi").to_numpy(), group, length)
            return spans(g, flags & (g.column("times").to_numpy() == 1)[:, None])  # the others are covered whole

        for g in _groups(batches, 2):
            if g.num_rows > 1:
                held.append(g)
                rows += g.num_rows
            if rows > 10_000:
                yield run()
                held, rows = [], 0
        if held:
            yield run()

    ranged = local.repartitionByRange(width(spark), "lead", "h").sortWithinPartitions("lead", "h", "doc_id", "pos")
    border = ranged.mapInArrow(compare, out)
    if spread:
        each = contexts.join(hot, "h").withColumn("o", F.explode(F.sequence("lo", "hi")))
        each = each.withColumn("w", F.expr(f"substring(ctx, cast({back} - o + 1 as int), {length})"))
        each = each.withColumns({"w1": F.xxhash64("w"), "w2": F.xxhash64(F.lit(1), "w")}).select("h", "o", "w1", "w2", "times", "doc_id", "row", "pos")
        twice = each.groupBy("h", "o", "w1", "w2").agg(F.count("*").alias("k")).filter("k > 1").drop("k")
        start = F.col("pos") - F.col("o")
        found_again = each.filter("times = 1").join(twice, ["h", "o", "w1", "w2"])
        border = border.union(found_again.select("doc_id", "row", start.alias("s"), (start + length).alias("e")))
    border = materialize(border, "suffix-border")
    discard(contexts, hot)
    return whole, border


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, cap: int = 100_000) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: the removed byte spans (maximal, ascending) and the bytes left.

    Null text is empty.  Texts shorter than ``length`` bytes lose nothing.
    Matches never cross documents; a document may match itself, overlaps count,
    and all is judged on the input.  Rows that repeat id and text are copies of
    each other.  ``length`` is at least 64; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))
    whole = F.coalesce(F.col("doc_id"), F.lit(-1))  # null ids join like any other
    found = repeated_spans(rows.withColumn("doc_id", whole), length, cap)
    spans = materialize(found[0].union(found[1]).groupBy("doc_id", "row").agg(F.collect_list(F.struct("s", "e")).alias("spans")), "suffix-spans")
    discard(*found)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.int64(), pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])), pa.binary())

        def rows_of(out: list[tuple]) -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "n_bytes", "spans", "kept"])

        for batch in batches:
            out: list[tuple] = []
            size = 0
            for d, t, s in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                b, gone = t.as_py().encode(), merged([(x["s"], x["e"]) for x in s.as_py() or []])
                at, kept = 0, []
                for x, y in gone:
                    kept.append(b[at:x])
                    at = y
                out.append((d, len(b), [{"s": x, "e": y} for x, y in gone], b"".join([*kept, b[at:]])))
                size += len(b)
                if size > STEP:
                    yield rows_of(out)
                    out, size = [], 0
            if out:
                yield rows_of(out)

    at = spans.withColumnsRenamed({"doc_id": "__id", "row": "__row"})
    joined = rows.join(at, (whole == F.col("__id")) & (F.col("row") == F.col("__row")), "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, spans array<struct<s:long,e:long>>, kept binary")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["e"] - s["s"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
