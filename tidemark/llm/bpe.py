"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary resolves a pre-token that
is itself a vocabulary entry with one probe and one comparison.  Tier two: a
miss is merged from single bytes with a heap of candidate pairs over a doubly
linked list, lowest rank first, leftmost first among equals.

The vocabulary is a parameter (a ``.tiktoken`` rank file); it is read by the
driver and broadcast: its size is that of the vocabulary, whatever the input.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, share, table

_MASK = (1 << 64) - 1
#: Pre-tokens remembered between batches by one worker, and the longest that is.
MEMO, MEMO_CHARS = 400_000, 48
#: Text handled at once inside an Arrow batch, in code points.
STEP = 2_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _mixed(h: int, d: int) -> int:
    x = (h ^ (d * 0x9E3779B97F4A7C15)) & _MASK
    x = ((x ^ (x >> 31)) * 0xBF58476D1CE4E5B9) & _MASK
    return x ^ (x >> 29)


class PerfectHash:
    """Minimal perfect hash by hash-and-displace: n keys in n slots, one displacement for about four keys."""

    def __init__(self, keys: list[bytes]):
        self.n = n = len(keys)
        self.buckets = max(1, n // 4)
        hashes = [xxhash.xxh64_intdigest(k) for k in keys]
        by_bucket: dict[int, list[int]] = {}
        for i, h in enumerate(hashes):
            by_bucket.setdefault(h % self.buckets, []).append(i)
        slots, shift, free = [-1] * n, [0] * self.buckets, n - 1
        for b, members in sorted(by_bucket.items(), key=lambda x: -len(x[1])):
            if len(members) == 1:  # any free slot will do; it is stored itself, as a negative number
                while slots[free] >= 0:
                    free -= 1
                slots[free], shift[b] = members[0], -free - 1
                continue
            d = 1
            while len(places := {_mixed(hashes[i], d) % n for i in members}) < len(members) or any(slots[p] >= 0 for p in places):
                d += 1
            shift[b] = d
            for i in members:
                slots[_mixed(hashes[i], d) % n] = i
        self.shift, self.order = np.array(shift, np.int64), slots

    def slot(self, key: bytes) -> int:
        """The slot of a key that is in the set; any slot for another."""
        h = xxhash.xxh64_intdigest(key)
        d = self.shift[h % self.buckets]
        return -d - 1 if d < 0 else _mixed(h, int(d)) % self.n


class Tokenizer:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        keys, self.ranks = list(ranks), ranks
        self.hash = PerfectHash(keys)
        self.hash.shift = self.hash.shift.tolist()
        self.keys = [keys[i] for i in self.hash.order]
        self.ids = [ranks[k] for k in self.keys]
        self.bytes_of = dict(zip(self.ids, self.keys, strict=True))
        self.pattern = pattern
        self.reset()

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("memo", "split")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.reset()

    def reset(self) -> None:
        self.memo = _Memo(self)
        self.split = regex.compile(self.pattern).findall

    def rank(self, piece: bytes) -> int | None:
        s = self.hash.slot(piece)
        return self.ids[s] if self.keys[s] == piece else None

    def piece(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        whole = self.rank(piece)
        return [whole] if whole is not None else self.merge(piece)

    def merge(self, piece: bytes) -> list[int]:
        n, rank, push, pop = len(piece), self.ranks.get, heapq.heappush, heapq.heappop
        end = list(range(1, n + 1))  # of the part that starts here; 0: merged into an earlier one
        prev, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, to = pop(heap)
            j = after[i]
            if not end[i] or j >= n or end[j] != to:
                continue  # one of the two parts has changed since
            end[i], end[j] = to, 0
            after[i] = k = after[j]
            if k < n:
                prev[k] = i
                if (r := rank(piece[i : end[k]])) is not None:
                    push(heap, (r, i, end[k]))
            if (p := prev[i]) >= 0 and (r := rank(piece[p:to])) is not None:
                push(heap, (r, p, to))
        ids, i = [], 0
        while i < n:
            ids.append(rank(piece[i : end[i]]))
            i = after[i]
        return ids

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.memo.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Memo(dict):
    """Ids of pre-tokens in two generations of MEMO / 2: what was not asked for during a whole generation is forgotten."""

    def __init__(self, owner: Tokenizer):
        self.owner, self.old = owner, {}

    def __missing__(self, token: str) -> bytes:
        if (out := self.old.pop(token, None)) is None:
            ids = self.owner.piece(token.encode())
            out = struct.pack(f"<{len(ids)}I", *ids)
        if len(token) > MEMO_CHARS:
            return out
        if len(self) >= MEMO // 2:
            self.old = dict(self)
            self.clear()
        self[token] = out
        return out


def _batches(texts: pa.Array, *others: pa.Array) -> Iterator[tuple]:
    """Slices of an Arrow batch of about STEP code points each."""
    start, size = 0, 0
    lengths = pa.compute.fill_null(pa.compute.utf8_length(texts), 0).to_pylist()
    for i, n in enumerate(lengths):
        size += n
        if size >= STEP or i + 1 == len(lengths):
            yield (texts.slice(start, i + 1 - start).to_pylist(), *(x.slice(start, i + 1 - start) for x in others))
            start, size = i + 1, 0


def bpe_encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, n_tokens, ids, decoded``: ids as little-endian unsigned 32-bit integers, decoded the bytes of those ids.

    Null and empty texts have no ids.  Special tokens are ordinary text.  One
    row per input row, repeated rows included; an empty table gives no rows;
    other columns of ``docs`` are ignored.  Memory: one Arrow batch and the
    memo of pre-tokens.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    shared = share(spark, Tokenizer(read_ranks(ranks_path), pattern))
    out = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared()
        for b in batches:
            for texts, keys in _batches(b.column(1), b.column(0)):
                ids = [t.encode(x or "") for x in texts]
                yield pa.RecordBatch.from_arrays([keys, pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(list(map(t.decode, ids)), pa.binary())], names=out.names)

    return docs.select(id_col, F.col(text_col).cast("string").alias("text")).mapInArrow(run, out)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = bpe_encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
