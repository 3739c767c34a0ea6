"""Binary commit-log segments of the store, as rows of the open mutation log.

Uncompressed segments of format versions 6 and 7 are read: a descriptor, then
sections between sync markers, then checked entries of one mutation each.  A
mutation holds updates of tables by id, in the store's row serialization; the
types come from the specs, so ``tables`` maps table ids to them.  The rest of a
mutation from an unknown table on is skipped, as nothing tells its length.
Compressed and encrypted segments are refused.

A task decodes one segment, whose size the store bounds; segments are
independent of each other.
"""

from __future__ import annotations

import ipaddress
import json
import struct
import uuid
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import asdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..functions.types import parse
from ..spec import CLUSTERING, PARTITION, ColumnSpec, TableSpec
from .mutation_log import LINES, parsed

#: Fixed values of the format: versions, epochs that small numbers are relative to, flags, bound kinds by ordinal.
VERSIONS = (6, 7)
TIMESTAMP_EPOCH, DELETION_EPOCH = 1_442_880_000_000_000, 1_442_880_000
IS_EMPTY, HAS_PARTITION_DELETION, HAS_STATIC, HAS_ESTIMATE = 0x01, 0x04, 0x08, 0x10
END, MARKER, HAS_TIMESTAMP, HAS_TTL, HAS_DELETION, ALL_COLUMNS, COMPLEX_DELETION, EXTENDED = 0x01, 0x02, 0x04, 0x08, 0x10, 0x20, 0x40, 0x80
CELL_DELETED, CELL_EXPIRING, CELL_EMPTY, ROW_TIMESTAMP, ROW_TTL = 0x01, 0x02, 0x04, 0x08, 0x10
BOUND_KINDS = ("EXCL_END_BOUND", "INCL_START_BOUND", "EXCL_END_INCL_START_BOUNDARY", "STATIC_CLUSTERING", "CLUSTERING", "INCL_END_EXCL_START_BOUNDARY", "INCL_END_BOUND", "EXCL_START_BOUND")
FIXED = {"boolean": 1, "int": 4, "float": 4, "bigint": 8, "double": 8, "timestamp": 8, "uuid": 16, "timeuuid": 16}
#: Names that the store gives to the types of bound values.
TYPE_NAMES = {"int": "Int32Type", "bigint": "LongType", "text": "UTF8Type", "varchar": "UTF8Type", "ascii": "AsciiType", "boolean": "BooleanType", "double": "DoubleType", "float": "FloatType", "uuid": "UUIDType", "timeuuid": "TimeUUIDType", "timestamp": "TimestampType", "date": "SimpleDateType", "time": "TimeType", "smallint": "ShortType", "tinyint": "ByteType", "varint": "IntegerType", "decimal": "DecimalType", "inet": "InetAddressType", "blob": "BytesType"}


class Damaged(ValueError):
    """Bytes that are not what the format says."""


class UnknownTable(LookupError):
    pass


class Cursor:
    """Reads big-endian numbers and vints from bytes."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def take(self, n: int) -> bytes:
        out = self.data[self.at : self.at + n]
        if n < 0 or len(out) < n:
            raise Damaged(f"{n} bytes expected at {self.at}, {len(out)} there")
        self.at += n
        return out

    def number(self, code: str) -> int:
        return struct.unpack(f">{code}", self.take(struct.calcsize(code)))[0]

    def vint(self) -> int:
        """Unsigned: the leading ones of the first byte count the bytes that follow."""
        first = self.take(1)[0]
        more = 8 - (first ^ 0xFF).bit_length()
        return int.from_bytes(bytes([first & (0xFF >> more)]) + self.take(more), "big")

    def sized(self) -> bytes:
        return self.take(self.vint())


def _crc(*ints: int) -> int:
    return zlib.crc32(b"".join(struct.pack(">I", i & 0xFFFFFFFF) for i in ints))


def descriptor(data: bytes) -> tuple[int, int, dict, int]:
    """Version, segment id, parameters, and where the first sync marker stands."""
    c = Cursor(data)
    version, segment, size = c.number("i"), c.number("q"), c.number("H")
    text, claimed = c.take(size), c.number("I")
    if zlib.crc32(text, _crc(version, segment, segment >> 32, size)) != claimed:
        raise Damaged("descriptor: wrong checksum")
    parameters = json.loads(text or b"{}")
    if version not in VERSIONS:
        raise Damaged(f"format version {version} is not read, only {VERSIONS}")
    if parameters.get("compressionClass") or parameters.get("encCipher"):
        raise Damaged("compressed or encrypted segments are not read")
    return version, segment, parameters, c.at


def entries(data: bytes) -> Iterator[tuple[int, bytes]]:
    """``(position, mutation)``, the position being where the entry ends; ends at the last synced section."""
    _, segment, _, at = descriptor(data)
    while at + 8 <= len(data):
        following, claimed = struct.unpack_from(">iI", data, at)
        if following == 0 and claimed == 0:
            return  # not synced yet
        if _crc(segment, segment >> 32, at) != claimed or not at + 8 <= following <= len(data):
            raise Damaged(f"sync marker at {at}: wrong checksum")
        c = Cursor(data[:following], at + 8)
        while c.at + 4 <= following and (size := c.number("i")) != 0:
            if _crc(size) != c.number("I"):
                raise Damaged(f"entry at {c.at}: wrong checksum of its size")
            body = c.take(size)
            if zlib.crc32(body, _crc(size)) != c.number("I"):
                raise Damaged(f"entry before {c.at}: wrong checksum")
            yield c.at, body
        at = following


# --- Values ----------------------------------------------------------------------------------------------------------------


def _collection(raw: bytes, each: int) -> list[tuple]:
    c = Cursor(raw)
    return [tuple(_element(c) for _ in range(each)) for _ in range(c.number("i"))]


def _element(c: Cursor) -> bytes | None:
    n = c.number("i")
    return None if n < 0 else c.take(n)


def value(cql: str, raw: bytes | None, udts: Mapping[str, list[tuple[str, str]]] = {}) -> object:
    """A value as the open log holds it before it becomes text: JSON-like for composite types."""
    if raw is None:
        return None
    name, args = parse(cql)
    if name in ("text", "varchar", "ascii"):
        return raw.decode()
    if name == "blob":
        return raw.hex().upper()
    if name in ("list", "set"):
        return [value(args[0], x, udts) for (x,) in _collection(raw, 1)]
    if name == "map":
        return {as_text(args[0], value(args[0], k, udts)): value(args[1], v, udts) for k, v in _collection(raw, 2)}
    if name == "tuple" or name in udts:
        fields = [(f"field{i}", a) for i, a in enumerate(args, 1)] if name == "tuple" else udts[name]
        c = Cursor(raw)
        return {n: value(t, _element(c), udts) if c.at < len(raw) else None for n, t in fields}
    if not raw:
        return None
    if name == "boolean":
        return raw != b"\0"
    if name in ("tinyint", "smallint", "int", "bigint", "counter", "timestamp", "time", "varint"):
        return int.from_bytes(raw, "big", signed=True)
    if name == "date":
        return int.from_bytes(raw, "big", signed=True)  # unsigned in the store; the decoder's sign bit is the same
    if name in ("float", "double"):
        return struct.unpack(">f" if name == "float" else ">d", raw)[0]
    if name in ("uuid", "timeuuid"):
        return str(uuid.UUID(bytes=raw))
    if name == "inet":
        return str(ipaddress.ip_address(raw))
    if name == "decimal":
        scale, unscaled = struct.unpack(">i", raw[:4])[0], int.from_bytes(raw[4:], "big", signed=True)
        return f"{unscaled}E{-scale}" if scale else str(unscaled)
    if name == "duration":
        c = Cursor(raw)
        months, days, nanos = ((n >> 1) ^ -(n & 1) for n in (c.vint(), c.vint(), c.vint()))
        return {"months": months, "days": days, "nanos": nanos}
    raise KeyError(f"no reader for type {cql}")


def as_text(cql: str, v: object) -> str | None:
    """The text of a value in the open log."""
    if v is None:
        return None
    if isinstance(v, (list, dict)):
        return json.dumps(v)
    return str(v).lower() if isinstance(v, bool) else str(v)


def _multi_cell(c: ColumnSpec) -> bool:
    return c.is_collection and not c.cql_type.startswith("frozen")


# --- Mutations ---------------------------------------------------------------------------------------------------------------


class Decoder:
    """Mutations of known tables as rows of the open log."""

    def __init__(self, tables: Mapping[str, TableSpec], udts: Mapping[str, list[tuple[str, str]]] | None = None):
        self.tables, self.udts = {uuid.UUID(k).bytes: s for k, s in tables.items()}, udts or {}

    def to_json(self) -> str:
        specs = {str(uuid.UUID(bytes=k)): asdict(s) for k, s in self.tables.items()}
        return json.dumps({"tables": specs, "udts": self.udts})

    @classmethod
    def from_json(cls, text: str) -> Decoder:
        given = json.loads(text)
        spec = lambda s: TableSpec(**s | {"columns": tuple(ColumnSpec(**c) for c in s["columns"])})
        return cls({k: spec(s) for k, s in given["tables"].items()}, {k: [tuple(f) for f in v] for k, v in given["udts"].items()})

    def batches(self, name: str, data: bytes, start: int = 0, eof: bool = True) -> Iterator[pa.RecordBatch]:
        """The segment's entries that end beyond ``start`` as rows of ``LINES``; its end as a row without mutation."""
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), LINES, strict=True)], schema=LINES)
            rows.clear()
            return out

        at = 0
        try:
            for at, body in entries(data):
                if at > start and (found := self.mutation(at, body))["updates"]:
                    rows.append((name, at, json.dumps(found), False))
                if len(rows) >= 2000:
                    yield batch()
        except (Damaged, KeyError, IndexError, ValueError, struct.error) as e:
            rows.append((name, at, f"not read after {at}: {e}", False))
        if eof:
            rows.append((name, len(data), None, True))
        if rows:
            yield batch()

    def text(self, cql: str, raw: bytes | None) -> str | None:
        return as_text(cql, value(cql, raw, self.udts))

    def mutation(self, position: int, body: bytes) -> dict:
        c, updates, specs = Cursor(body), [], []
        for _ in range(c.vint()):
            try:
                spec, update = self.update(c)
            except UnknownTable:
                break
            specs.append(spec)
            updates.append(update)
        keyspace = specs[0].keyspace if specs else None
        return {"pos": position, "tracked_by_cdc": any(s.cdc for s in specs), "keyspace": keyspace, "updates": updates}

    def update(self, c: Cursor) -> tuple[TableSpec, dict]:
        spec = self.tables.get(c.take(16))
        if spec is None:
            raise UnknownTable
        counter = any(parse(x.cql_type)[0] == "counter" for x in spec.columns)
        key, flags = c.sized(), c.take(1)[0]
        out = {"table": spec.table, "is_counter": counter, "is_view": False, "is_index": False, "partition_key": self.key(spec, key), "partition_deleted_at": None, "rows": []}
        if flags & IS_EMPTY:
            return spec, out
        base = (c.vint() + TIMESTAMP_EPOCH, c.vint() + DELETION_EPOCH, c.vint())
        statics = self.columns(spec, c) if flags & HAS_STATIC else []
        regulars = self.columns(spec, c)
        if flags & HAS_PARTITION_DELETION:
            out["partition_deleted_at"] = self.deletion(c, base)
        if flags & HAS_STATIC:
            self.row(spec, c, c.take(1)[0], base, statics, 0)  # static columns give no events of their own
        if flags & HAS_ESTIMATE:
            c.vint()
        while not (f := c.take(1)[0]) & END:
            out["rows"].append(self.marker(spec, c, base, len(out["rows"])) if f & MARKER else self.row(spec, c, f, base, regulars, len(out["rows"])))
        return spec, out

    def key(self, spec: TableSpec, raw: bytes) -> dict:
        columns = spec.role(PARTITION)
        if len(columns) == 1:
            return {columns[0].name: self.text(columns[0].cql_type, raw)}
        c, out = Cursor(raw), {}
        for x in columns:
            out[x.name] = self.text(x.cql_type, c.take(c.number("H")))
            c.take(1)
        return out

    @staticmethod
    def columns(spec: TableSpec, c: Cursor) -> list[ColumnSpec]:
        names = [c.sized().decode() for _ in range(c.vint())]
        known = {x.name: x for x in spec.columns}
        if missing := [n for n in names if n not in known]:
            raise Damaged(f"{spec.name} has no columns {missing}; its spec is older than the segment")
        return [known[n] for n in names]

    @staticmethod
    def deletion(c: Cursor, base: tuple[int, int, int]) -> int:
        at = c.vint() + base[0]
        c.vint()  # the local time of the deletion
        return at

    def clustering(self, columns: tuple[ColumnSpec, ...], c: Cursor) -> list[bytes | None]:
        """Values in groups of 32, each after a header of two bits a value: 1 empty, 2 null."""
        out: list[bytes | None] = []
        for start in range(0, len(columns), 32):
            header = c.vint()
            for i, x in enumerate(columns[start : start + 32]):
                state = header >> (2 * i) & 3
                out.append(None if state & 2 else b"" if state & 1 else self.raw(x.cql_type, c))
        return out

    @staticmethod
    def raw(cql: str, c: Cursor) -> bytes:
        """A value: of its type's fixed length, or after its length."""
        size = FIXED.get(parse(cql)[0])
        return c.sized() if size is None else c.take(size)

    def row(self, spec: TableSpec, c: Cursor, flags: int, base: tuple[int, int, int], columns: list[ColumnSpec], seq: int) -> dict:
        static = bool(flags & EXTENDED and c.take(1)[0] & 0x01)
        keys = spec.role(CLUSTERING)
        named = {} if static else {x.name: self.text(x.cql_type, v) for x, v in zip(keys, self.clustering(keys, c), strict=True)}
        written = c.vint() + base[0] if flags & HAS_TIMESTAMP else None
        expires = None
        if flags & HAS_TTL:
            c.vint()
            expires = c.vint() + base[1]
        deleted = self.deletion(c, base) if flags & HAS_DELETION else None
        present = columns if flags & ALL_COLUMNS else self.subset(columns, c)
        cells, times = {}, [written] if written is not None else []
        for x in present:
            if _multi_cell(x):
                cells[x.name] = self.complex_cell(x, c, flags, base, written, expires, times)
            else:
                cells[x.name] = self.cell(x.cql_type, c, base, written, expires, times)[0]
        return {"seq": seq, "kind": "ROW", "liveness_ts": written, "deleted_at": deleted, "written_at": max(times, default=None), "clustering": named, "cells": cells, "open_bound": None, "close_bound": None}

    @staticmethod
    def subset(columns: list[ColumnSpec], c: Cursor) -> list[ColumnSpec]:
        """Which columns a row has: a bit map of those missing, or for 64 columns and more a list of positions."""
        if len(columns) < 64:
            missing = c.vint()
            return [x for i, x in enumerate(columns) if not missing >> i & 1]
        n_missing = c.vint()
        n = len(columns) - n_missing
        if n < len(columns) // 2:
            return [columns[c.vint()] for _ in range(n)]
        gone = {c.vint() for _ in range(n_missing)}
        return [x for i, x in enumerate(columns) if i not in gone]

    def cell(self, cql: str, c: Cursor, base: tuple[int, int, int], written: int | None, expires: int | None, times: list[int], path: bool = False) -> tuple[dict, bytes, bytes | None]:
        """The cell, its path in a collection, and its bytes."""
        flags = c.take(1)[0]
        times.append(written if flags & ROW_TIMESTAMP else c.vint() + base[0])  # type: ignore[arg-type]
        at = expires if flags & ROW_TTL else None
        if flags & (CELL_DELETED | CELL_EXPIRING) and not flags & ROW_TTL:
            at = c.vint() + base[1]
        if flags & CELL_EXPIRING and not flags & ROW_TTL:
            c.vint()
        where = c.sized() if path else b""
        raw = None if flags & CELL_EMPTY else c.sized() if path else self.raw(cql, c)  # a collection's type has no fixed length
        gone = bool(flags & CELL_DELETED)
        empty = b"" if raw is None and not gone else raw
        return {"value": None if gone or path else self.text(cql, empty), "tombstone": gone, "expires_at": None if gone else at}, where, None if gone else empty

    def complex_cell(self, x: ColumnSpec, c: Cursor, flags: int, base: tuple[int, int, int], written: int | None, expires: int | None, times: list[int]) -> dict:
        """A collection's cells as one: a list's by position, a set's by path, a map's by key; no cells at all is a tombstone."""
        if flags & COMPLEX_DELETION:
            self.deletion(c, base)
        name, args = parse(x.cql_type)
        found = [self.cell("blob", c, base, written, expires, times, path=True) for _ in range(c.vint())]
        alive = [(path, raw) for cell, path, raw in found if not cell["tombstone"]]
        if not alive:
            return {"value": None, "tombstone": True, "expires_at": None}
        if name == "list":
            v: object = [value(args[0], raw, self.udts) for _, raw in alive]
        elif name == "set":
            v = [value(args[0], path, self.udts) for path, _ in alive]
        else:
            v = {as_text(args[0], value(args[0], path, self.udts)): value(args[1], raw, self.udts) for path, raw in alive}
        return {"value": json.dumps(v), "tombstone": False, "expires_at": None}

    def marker(self, spec: TableSpec, c: Cursor, base: tuple[int, int, int], seq: int) -> dict:
        kind = BOUND_KINDS[c.take(1)[0]]
        columns = spec.role(CLUSTERING)[: c.number("H")]
        values = [{"name": x.name, "value": self.text(x.cql_type, v), "type": TYPE_NAMES.get(parse(x.cql_type)[0], x.cql_type)} for x, v in zip(columns, self.clustering(columns, c), strict=True)]
        bound = lambda method: {"method": method, "values": values}
        out = {"seq": seq, "liveness_ts": None, "written_at": None, "clustering": {}, "cells": {}, "open_bound": None, "close_bound": None}
        if kind.endswith("BOUNDARY"):
            end, start = ("EXCL_END_BOUND", "INCL_START_BOUND") if kind.startswith("EXCL") else ("INCL_END_BOUND", "EXCL_START_BOUND")
            self.deletion(c, base)  # of the range that ends
            return out | {"kind": "RANGE_BOUNDARY", "deleted_at": self.deletion(c, base), "open_bound": bound(start), "close_bound": bound(end)}
        side = "open" if "START" in kind else "close"
        return out | {"kind": f"RANGE_{side.upper()}", "deleted_at": self.deletion(c, base), f"{side}_bound": bound(kind)}


def read_binary(spark: SparkSession, paths: str | list[str], decoder: Decoder) -> DataFrame:
    """Segments as the open log, with ``at``, ``eof`` and ``broken``: what was damaged; a segment is read up to there.

    ``at`` is the position too: where an entry ends in its file."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                yield from decoder.batches(path.rsplit("/", 1)[-1], content.as_py())

    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return parsed(files.mapInArrow(decode, "file string, at long, mutation string, eof boolean"))
