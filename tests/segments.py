"""Writes binary segments for tests, by the public description of the format."""

import json
import struct
import uuid
import zlib

EPOCH, DELETION = 1_442_880_000_000_000, 1_442_880_000


def vint(n):
    for extra in range(9):
        if extra == 8 or n < 1 << (7 * (extra + 1)):
            body = n.to_bytes(extra + 1 if extra < 8 else 9, "big")
            return bytes([body[0] | (0xFF << (8 - extra) & 0xFF)]) + body[1:]


def sized(b):
    return vint(len(b)) + b


def crc(*parts):
    out = 0
    for p in parts:
        out = zlib.crc32(p if isinstance(p, bytes) else struct.pack(">I", p & 0xFFFFFFFF), out)
    return struct.pack(">I", out)


def entry(body):
    size = struct.pack(">i", len(body))
    return size + crc(size) + body + crc(size, body)


def segment(sections, version=7, number=1_700_000_000_123, parameters=None, tail=b""):
    """Sections of mutations, each between sync markers; ``tail`` is what is not synced."""
    text = json.dumps(parameters or {}).encode()
    head = struct.pack(">iqH", version, number, len(text)) + text
    out = head + crc(version, number, number >> 32, len(text), text)
    for mutations in sections:
        body = b"".join(map(entry, mutations)) + struct.pack(">i", 0)
        out += struct.pack(">i", len(out) + 8 + len(body)) + crc(number, number >> 32, len(out)) + body
    return out + struct.pack(">ii", 0, 0) + tail


def deletion(at, base):
    return vint(at - base[0]) + vint(DELETION + 500 - base[1])


def clustering(values):
    """``(bytes, fixed)`` each; None is null."""
    header = sum((2 if v is None else 1 if v[0] == b"" else 0) << (2 * i) for i, v in enumerate(values))
    return vint(header) + b"".join(v[0] if v[1] else sized(v[0]) for v in values if v is not None and v[0])


def cell(value=None, fixed=False, at=None, base=(EPOCH, DELETION, 0), deleted=None, expires=None, path=None):
    flags = (1 if deleted else 0) | (2 if expires else 0) | (4 if value is None else 0) | (8 if at is None else 0)
    out = bytes([flags]) + (b"" if at is None else vint(at - base[0]))
    if deleted or expires:
        out += vint((deleted or expires) - base[1])
    if expires:
        out += vint(60)
    if path is not None:
        out += sized(path)
    return out + (b"" if value is None else value if fixed and path is None else sized(value))


def row(cells, n_columns, keys=(), at=None, base=(EPOCH, DELETION, 0), deleted_at=None, present=None, static=False, ttl=None, complex_deletion=False):
    """``cells``: encoded, of the present columns in order; ``present``: their places, all if None."""
    flags = (4 if at is not None else 0) | (8 if ttl else 0) | (16 if deleted_at is not None else 0) | (32 if present is None else 0) | (64 if complex_deletion else 0) | (128 if static else 0)
    out = bytes([flags]) + (b"\x01" if static else clustering(keys) if keys else b"")
    if at is not None:
        out += vint(at - base[0])
    if ttl:
        out += vint(60) + vint(ttl - base[1])
    if deleted_at is not None:
        out += deletion(deleted_at, base)
    if present is not None:
        out += vint(sum(1 << i for i in range(n_columns) if i not in present)) if n_columns < 64 else large(n_columns, present)
    return out + b"".join(cells)


def large(n, present):
    missing = [i for i in range(n) if i not in present]
    return vint(len(missing)) + b"".join(map(vint, present if len(present) < n // 2 else missing))


def marker(kind, values, *deletions, base=(EPOCH, DELETION, 0)):
    return bytes([2, kind]) + struct.pack(">H", len(values)) + (clustering(values) if values else b"") + b"".join(deletion(d, base) for d in deletions)


def update(table, key, columns, unfiltered, base=(EPOCH, DELETION, 0), deleted_at=None, statics=None, static_row=b""):
    flags = (4 if deleted_at is not None else 0) | (8 if statics else 0) | 16
    names = lambda cs: vint(len(cs)) + b"".join(sized(c.encode()) for c in cs)
    out = uuid.UUID(table).bytes + sized(key) + bytes([flags]) + vint(base[0] - EPOCH) + vint(base[1] - DELETION) + vint(base[2])
    out += (names(statics) if statics else b"") + names(columns)
    if deleted_at is not None:
        out += deletion(deleted_at, base)
    return out + static_row + vint(len(unfiltered)) + b"".join(unfiltered) + b"\x01"


def mutation(*updates):
    return vint(len(updates)) + b"".join(updates)
