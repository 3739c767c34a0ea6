"""CQL types: their Spark types and decoders, all of them Column expressions.

``TypeSystem`` holds the decimal and varint modes of a pipeline and an open
registry; ``decode(cql, col)`` turns a column in the log's form into the output
form, recursively through collections, tuples and user-defined types.

Log form of the scalar types: the natural Spark value, except date (unsigned
days with the epoch at 2^31, as int), inet (address text), timestamp (timestamp
or epoch millis), uuid (text or 16 bytes), decimal and varint (text), duration
(struct of months, days, nanos).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOUBLE, PRECISE, STRING, LONG = "DOUBLE", "PRECISE", "STRING", "LONG"
DAY_NANOS = 86_400_000_000_000

SCALARS: dict[str, T.DataType] = {
    "boolean": T.BooleanType(), "text": T.StringType(), "varchar": T.StringType(), "ascii": T.StringType(), "tinyint": T.ByteType(), "blob": T.BinaryType(),
    "float": T.FloatType(), "double": T.DoubleType(), "int": T.IntegerType(), "smallint": T.ShortType(), "bigint": T.LongType(), "time": T.LongType(),
    "counter": T.LongType(), "date": T.IntegerType(), "inet": T.StringType(), "timestamp": T.LongType(), "uuid": T.StringType(), "timeuuid": T.StringType(), "duration": T.LongType(),
}


def split_types(inner: str) -> list[str]:
    """The top-level, comma-separated parts of a parameter list."""
    parts, depth, start = [], 0, 0
    for i, ch in enumerate(inner):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            parts.append(inner[start:i].strip())
            start = i + 1
    return [*parts, inner[start:].strip()]


def parse(cql: str) -> tuple[str, list[str]]:
    """Name and parameters; ``frozen`` and ``reversed`` wrappers do not change values."""
    cql = cql.strip()
    head, _, rest = cql.partition("<")
    args = split_types(rest[:-1]) if rest else []
    head = head.strip().lower()
    return parse(args[0]) if head in ("frozen", "reversed") else (head, args)


def bytes_to_uuid(b: Column) -> Column:
    return F.regexp_replace(F.lower(F.hex(b)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def uuid_to_bytes(u: Column) -> Column:
    return F.unhex(F.replace(u, F.lit("-"), F.lit("")))


def date_days(raw: Column) -> Column:
    """Unsigned days with the epoch at 2^31 to days since 1970: a 32-bit wraparound, that is, the sign bit flips."""
    return raw.cast("int").bitwiseXOR(F.lit(-2147483648).cast("int"))


def inet_text(address: Column) -> Column:
    return F.concat(F.lit("/"), address)


def duration_nanos(months: Column, days: Column, nanos: Column) -> Column:
    """A month counts as 30 days."""
    return (months.cast("long") * 30 + days.cast("long")) * F.lit(DAY_NANOS) + nanos.cast("long")


def decimal_parts(text: Column) -> Column:
    """``{scale, value}`` of a decimal text, exponents included: the unscaled value as text keeps any precision, and the scale may be negative."""
    has_exponent = F.instr(F.lower(text), "e") > 0
    body = F.regexp_replace(F.substring_index(F.lower(text), "e", 1), "^[+-]", "")
    exponent = F.when(has_exponent, F.substring_index(F.lower(text), "e", -1).cast("int")).otherwise(0)
    fraction = F.when(F.instr(body, ".") > 0, F.length(body) - F.instr(body, ".")).otherwise(0)
    digits = F.regexp_replace(F.replace(body, F.lit("."), F.lit("")), "^0+(?=.)", "")
    unscaled = F.concat(F.when(text.startswith("-"), "-").otherwise(""), digits)
    return F.when(text.isNotNull(), F.struct((fraction - exponent).cast("int").alias("scale"), unscaled.alias("value")))


def decimal_plain(text: Column) -> Column:
    """A decimal text without exponent; most have none and stay as they are."""

    def plain(parts: Column) -> Column:
        scale, digits = parts["scale"], F.regexp_replace(parts["value"], "^-", "")
        sign = F.when(parts["value"].startswith("-"), "-").otherwise("")
        whole = F.when(digits == "0", digits).otherwise(F.concat(digits, F.repeat(F.lit("0"), -scale)))
        wide = F.when(F.length(digits) > scale, digits).otherwise(F.lpad(digits, F.greatest(scale, F.lit(0)) + 1, "0"))
        point = F.length(wide) - scale
        split = F.concat(F.substring(wide, F.lit(1), point), F.lit("."), F.substring(wide, point + 1, F.greatest(scale, F.lit(0))))
        return F.concat(sign, F.when(scale <= 0, whole).otherwise(split))

    once = F.get(F.transform(F.array(decimal_parts(text)), plain), F.lit(0))  # the parts are bound once, not written out at each use
    return F.when(F.instr(F.lower(text), "e") > 0, once).otherwise(text)


def varint_long(text: Column) -> Column:
    """The low 64 bits of an integer of any length, as a narrowing gives them.

    Nine digits at a time, in two halves of 32 bits, so that nothing overflows on the way."""
    low32 = F.lit((1 << 32) - 1)
    digits = F.regexp_replace(text, "^[+-]", "")
    groups = F.ceil(F.length(digits) / 9).cast("int")
    padded = F.lpad(digits, groups * 9, "0")
    each = F.transform(F.sequence(F.lit(0), groups - 1), lambda i: F.substring(padded, i * 9 + 1, F.lit(9)).cast("long"))

    def shifted(acc: Column, x: Column) -> Column:
        low = acc["low"] * 1_000_000_000 + x
        high = acc["high"] * 1_000_000_000 + F.shiftright(low, 32)
        return F.struct(high.bitwiseAND(low32).alias("high"), low.bitwiseAND(low32).alias("low"))

    def signed(acc: Column) -> Column:
        zero = acc["low"] == 0
        high = F.when(text.startswith("-"), (F.bitwise_not(acc["high"]) + F.when(zero, 1).otherwise(0)).bitwiseAND(low32)).otherwise(acc["high"])
        low = F.when(text.startswith("-"), (F.lit(1 << 32) - acc["low"]).bitwiseAND(low32)).otherwise(acc["low"])
        return F.shiftleft(high, 32).bitwiseOR(low)

    start = F.struct(F.lit(0).cast("long").alias("high"), F.lit(0).cast("long").alias("low"))
    value = F.aggregate(each, start, shifted, signed)
    wrong = F.raise_error(F.concat(F.lit("not an integer: "), text)).cast("long")
    return F.when(text.isNotNull(), F.when(text.rlike("^[+-]?[0-9]+$"), value).otherwise(wrong))


def varint_exact(text: Column) -> Column:
    """An integer as ``{scale, value}``, scale 0: the form of precise decimals, for any number of digits."""
    sign = F.when(text.startswith("-"), "-").otherwise("")
    digits = F.regexp_replace(F.regexp_replace(text, "^[+-]", ""), "^0+(?=.)", "")
    return F.when(text.isNotNull(), F.struct(F.lit(0).alias("scale"), F.concat(sign, digits).alias("value")))


@dataclass
class TypeSystem:
    decimal_mode: str = DOUBLE
    varint_mode: str = LONG
    date_shift: bool = True  # off for stores whose logs carry days since 1970 as they are
    udts: dict[str, list[tuple[str, str]]] = field(default_factory=dict)
    extra: dict[str, tuple[T.DataType, Callable[[Column], Column]]] = field(default_factory=dict)

    def register(self, name: str, spark_type: T.DataType, decoder: Callable[[Column], Column]) -> None:
        self.extra[name] = (spark_type, decoder)

    def spark_type(self, cql: str) -> T.DataType:
        name, args = parse(cql)
        if name in self.extra:
            return self.extra[name][0]
        exact = T.StructType([T.StructField("scale", T.IntegerType()), T.StructField("value", T.StringType())])
        if name == "decimal":
            return {DOUBLE: T.DoubleType(), STRING: T.StringType(), PRECISE: exact}[self.decimal_mode]
        if name == "varint":
            return {LONG: T.LongType(), STRING: T.StringType(), PRECISE: exact}[self.varint_mode]
        if name in ("list", "set"):
            return T.ArrayType(self.spark_type(args[0]))
        if name == "map":
            return T.MapType(self.spark_type(args[0]), self.spark_type(args[1]))
        if name == "tuple":
            return T.StructType([T.StructField(f"field{i}", self.spark_type(a)) for i, a in enumerate(args, 1)])
        if name in self.udts:
            return T.StructType([T.StructField(n, self.spark_type(t)) for n, t in self.udts[name]])
        if name in SCALARS:
            return SCALARS[name]
        raise KeyError(f"no decoder for type {cql}")

    def decode(self, cql: str, c: Column) -> Column:
        """Null stays null.  Sets keep no order; duplicate map keys: the last wins."""
        name, args = parse(cql)
        if name in self.extra:
            return self.extra[name][1](c)
        if name == "date":
            return date_days(c) if self.date_shift else c.cast("int")
        if name == "inet":
            return inet_text(c)
        if name == "duration":
            return duration_nanos(c["months"], c["days"], c["nanos"])
        if name == "decimal":
            return {DOUBLE: lambda: c.cast("double"), STRING: lambda: decimal_plain(c.cast("string")), PRECISE: lambda: decimal_parts(c.cast("string"))}[self.decimal_mode]()
        if name == "varint":
            return {LONG: lambda: varint_long(c.cast("string")), STRING: lambda: c.cast("string"), PRECISE: lambda: varint_exact(c.cast("string"))}[self.varint_mode]()
        if name == "list":
            return F.transform(c, lambda x: self.decode(args[0], x))
        if name == "set":
            return F.array_distinct(F.transform(c, lambda x: self.decode(args[0], x)))
        if name == "map":
            entries = F.transform(F.map_entries(c), lambda e: F.struct(self.decode(args[0], e["key"]).alias("key"), self.decode(args[1], e["value"]).alias("value")))
            return F.map_from_entries(entries)
        if name == "tuple":
            return F.when(c.isNotNull(), F.struct(*[self.decode(a, c[f"field{i}"]).alias(f"field{i}") for i, a in enumerate(args, 1)]))
        if name in self.udts:
            return F.when(c.isNotNull(), F.struct(*[self.decode(t, c[n]).alias(n) for n, t in self.udts[name]]))
        return c.cast(self.spark_type(name))

    def from_text(self, cql: str, c: Column) -> Column:
        """Decode a value that the open log carries as text: JSON for composite types, plain text for scalars."""
        name, _ = parse(cql)
        if name in ("list", "set", "map", "tuple", "duration") or name in self.udts:
            return self.decode(cql, F.from_json(c, self.log_type(cql)))
        if name == "blob":
            return F.unhex(c)
        return self.decode(cql, c.cast(self.log_type(cql)))

    def log_type(self, cql: str) -> T.DataType:
        """The type of a value in the log's form."""
        name, args = parse(cql)
        if name == "duration":
            return T.StructType([T.StructField("months", T.IntegerType()), T.StructField("days", T.IntegerType()), T.StructField("nanos", T.LongType())])
        if name in ("decimal", "varint"):
            return T.StringType()
        if name in ("list", "set"):
            return T.ArrayType(self.log_type(args[0]))
        if name == "map":
            return T.MapType(self.log_type(args[0]), self.log_type(args[1]))
        if name == "tuple":
            return T.StructType([T.StructField(f"field{i}", self.log_type(a)) for i, a in enumerate(args, 1)])
        if name in self.udts:
            return T.StructType([T.StructField(n, self.log_type(t)) for n, t in self.udts[name]])
        return self.spark_type(name)


def dedup_entries(entries: Column) -> Column:
    """Map entries (array of key, value) with the last of each key, so that building the map never fails."""
    last = lambda e, i: ~F.exists(F.slice(entries, i + 2, F.greatest(F.size(entries) - i - 1, F.lit(0))), lambda x: x["key"] == e["key"])
    return F.filter(entries, last)


def composite_key(raw: Column, parts: int) -> list[Column]:
    """The components of a serialised partition key.

    One component is the bytes as they are.  Several are each a 2-byte length,
    the bytes and an end byte; a leading 0xFFFF marks a static row and is skipped.
    """
    if parts == 1:
        return [raw]
    number = lambda at: F.conv(F.hex(F.substring(raw, at, F.lit(2))), 16, 10).cast("int")
    at: Column = F.when(F.hex(F.substring(raw, 1, 2)) == "FFFF", F.lit(3)).otherwise(F.lit(1))
    out = []
    for _ in range(parts):
        size = number(at)
        out.append(F.substring(raw, at + 2, size))
        at = at + 2 + size + 1
    return out
