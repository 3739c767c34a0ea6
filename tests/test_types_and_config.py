import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.types import TypeSystem, bytes_to_uuid, composite_key, decimal_parts, parse, uuid_to_bytes
from tidemark.operators.filters import excludes_for, parse_excludes
from tidemark.spec import SchemaRegistry

from logs import spec


def decoded(spark, cql, c, **modes):
    return spark.range(1).select(TypeSystem(**modes).decode(cql, c).alias("v")).first()["v"]


def test_date(spark):
    raw = (dt.date(2019, 2, 19) - dt.date(1970, 1, 1)).days - 2**31
    assert decoded(spark, "date", F.lit(raw)) == 17946
    assert decoded(spark, "date", F.lit(-2147463203)) == 20445
    assert decoded(spark, "date", F.lit(17946), date_shift=False) == 17946


def test_scalars(spark):
    assert decoded(spark, "inet", F.lit("1.2.3.4")) == "/1.2.3.4"
    month = F.struct(F.lit(1).alias("months"), F.lit(3).alias("days"), F.lit(500).alias("nanos"))
    assert decoded(spark, "duration", month) == 33 * 86_400_000_000_000 + 500
    assert decoded(spark, "time", F.lit(30)) == 30
    assert decoded(spark, "reversed<bigint>", F.lit(7)) == 7
    assert decoded(spark, "text", F.lit(None)) is None and decoded(spark, "list<int>", F.lit(None).cast("array<int>")) is None


def test_decimal_and_varint_modes(spark):
    pi = F.lit("3.14159265358979323846264338327950288419716939937510")
    assert decoded(spark, "decimal", pi) == pytest.approx(3.141592653589793)
    assert tuple(decoded(spark, "decimal", pi, decimal_mode="PRECISE")) == (50, "314159265358979323846264338327950288419716939937510")
    assert decoded(spark, "decimal", pi, decimal_mode="STRING").startswith("3.14159265358979323846")
    assert tuple(spark.range(1).select(decimal_parts(F.lit("-0.050")).alias("v")).first()["v"]) == (3, "-50")
    assert decoded(spark, "varint", F.lit("9223372036854775808")) == -(2**63)
    assert decoded(spark, "varint", F.lit("-1")) == -1
    assert decoded(spark, "varint", F.lit("7" * 39), varint_mode="STRING") == "7" * 39
    assert tuple(decoded(spark, "varint", F.lit("12"), varint_mode="PRECISE")) == (0, "12")
    assert tuple(decoded(spark, "varint", F.lit("-" + "7" * 45), varint_mode="PRECISE")) == (0, "-" + "7" * 45)
    assert decoded(spark, "varint", F.lit(None).cast("string")) is None


def test_uuid(spark):
    u = "123e4567-e89b-12d3-a456-426614174000"
    assert spark.range(1).select(bytes_to_uuid(uuid_to_bytes(F.lit(u)))).first()[0] == u


def test_composites(spark):
    udts = {"u": [("name", "ascii"), ("tags", "set<ascii>")]}
    one = F.struct(F.lit("n").alias("name"), F.array(F.lit("a"), F.lit("a"), F.lit("b")).alias("tags"))
    (got,) = decoded(spark, "frozen<list<frozen<u>>>", F.array(one), udts=udts)
    assert got["name"] == "n" and sorted(got["tags"]) == ["a", "b"]
    assert tuple(decoded(spark, "tuple<ascii,smallint>", F.struct(F.lit("foo").alias("field1"), F.lit(1).alias("field2")))) == ("foo", 1)
    assert decoded(spark, "map<int,float>", F.create_map(F.lit(1), F.lit(0.5))) == {1: 0.5}
    nested = F.array(F.array(F.lit(-2147483648)))
    assert decoded(spark, "list<frozen<list<date>>>", nested) == [[0]]


def test_type_strings():
    assert parse("frozen<map<text,frozen<list<int>>>>") == ("map", ["text", "frozen<list<int>>"])
    with pytest.raises(KeyError):
        TypeSystem().spark_type("vector<float,3>")


def test_registered_decoder(spark):
    types = TypeSystem()
    types.register("shout", types.spark_type("text"), F.upper)
    assert spark.range(1).select(types.decode("list<shout>", F.array(F.lit("a"))).alias("v")).first()["v"] == ["A"]


def test_composite_partition_key(spark):
    raw = bytes.fromhex("FFFF" + "0002" + "6162" + "00" + "0001" + "63" + "00")
    one = spark.createDataFrame([(bytearray(raw),)], "raw binary")
    a, b = one.select(*composite_key(F.col("raw"), 2)).first()
    assert (bytes(a), bytes(b)) == (b"ab", b"c")


def test_config():
    c = Config.from_properties("snapshot.mode=always\nnum.of.change.event.queues=4\n# x\nkafka.producer.acks=all\ndb.password=secret\ntombstones.on.delete=TRUE\n")
    assert c["snapshot.mode"] == "ALWAYS" and c["num.of.change.event.queues"] == 4 and c["tombstones.on.delete"] is True
    assert c["decimal.handling.mode"] == "DOUBLE" and c["varint.handling.mode"] == "LONG" and c["max.offset.flush.size"] == 100
    assert c.with_prefix("kafka.producer.") == {"acks": "all"} and "db.password" not in c.printable()
    assert len(c.validate()) == 2
    good = Config.of({"offset.backing.store.dir": "x", "commit.log.relocation.dir": "y"})
    assert good.validate() == [] and good.validate(runtime=True) == ["node.id is required"]
    assert Config.of({**good.values, "field.exclude.list": "a.b"}).validate() and Config.of({**good.values, "snapshot.mode": "sometimes"}).validate()


def test_excludes():
    found = parse_excludes("k.t.a,k.t.b, k.u.c")
    assert found == {"k.t": ["a", "b"], "k.u": ["c"]}
    t = spec("k", "t", ["a:int"], regular=["b:int"])
    assert excludes_for(t, found) == ["a", "b"]
    with pytest.raises(ValueError, match="does not have"):
        excludes_for(t, {"k.t": ["z"]})


def test_registry(spark):
    reg = SchemaRegistry([spec("k", "t", ["a:int"], ["b:int"]), spec("k", "u", ["a:int"])])
    assert [(r["table"], r["has_clustering"]) for r in reg.frame(spark).orderBy("table").collect()] == [("t", True), ("u", False)]
    from dataclasses import replace

    reg.put(replace(reg.get("k.t"), cdc=False))
    assert [s.table for s in reg.tables()] == ["u"]
    reg.drop_keyspace("k")
    assert reg.tables() == []
    t = spec("k", "t", ["a:int"], ["b:text"], ["c:list<int>"])
    assert t.key_type(TypeSystem()).simpleString() == "struct<a:int,b:string>"
    assert t.row_type(TypeSystem())["c"].dataType["value"].dataType.simpleString() == "array<int>"
    assert [c.name for c in t.non_key] == ["b", "c"]


@given(st.lists(st.integers(-(2**200), 2**200) | st.sampled_from([0, -1, 2**63, -(2**63), 2**64, -(2**64), 2**31, 10**9, -(10**18)]), min_size=1, max_size=20))
@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
def test_varints_of_any_length_give_their_low_64_bits(spark, numbers):
    got = spark.createDataFrame([(i, str(n)) for i, n in enumerate(numbers)], "i int, t string").select("i", TypeSystem().decode("varint", F.col("t")).alias("v")).collect()
    assert [r["v"] for r in sorted(got)] == [(n + 2**63) % 2**64 - 2**63 for n in numbers]


@pytest.mark.parametrize("text", ["1.5E+5", "-1.5e-7", "0E+3", "12", "-0.050", "1E+20", "0.0", "123.456E2", "123.456E1", "5E-1", "-7E0", "100", "1" * 45 + ".25E-3"])
def test_decimals_with_exponents(spark, text):
    d = Decimal(text)
    sign, digits, exponent = d.as_tuple()
    assert tuple(decoded(spark, "decimal", F.lit(text), decimal_mode="PRECISE")) == (-exponent, ("-" if sign else "") + "".join(map(str, digits)))
    assert Decimal(decoded(spark, "decimal", F.lit(text), decimal_mode="STRING")) == d
    assert "E" not in decoded(spark, "decimal", F.lit(text), decimal_mode="STRING").upper()
    assert decoded(spark, "decimal", F.lit(text)) == pytest.approx(float(text))


def test_a_broken_integer_is_an_error(spark):
    with pytest.raises(Exception, match="not an integer"):
        decoded(spark, "varint", F.lit("12x"))
