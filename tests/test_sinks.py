import json

import pytest
from pyspark.sql import functions as F

from logs import TS, cell, frame, mutation, row, spec, update
from tidemark.functions.types import TypeSystem
from tidemark.operators import events as E
from tidemark.operators import offsets as O
from tidemark.sources.client import discover, execute
from tidemark.spec import SchemaRegistry
from tidemark.streaming import sinks
from tidemark.streaming.pipeline import Capture

T = spec("ks", "t", ["a:int"], regular=["b:int"])


def log(spark):
    return frame(spark, [mutation(1, update("t", {"a": 1}, [row(0, cells={"b": cell(1)})])), mutation(2, update("t", {"a": 1}, [], deleted_at=TS))])


def test_event_sink_writes_records_in_order(spark, tmp_path):
    sink = sinks.EventSink(sinks.to_files(f"{tmp_path}/out"), "pre", "c", lambda: 7, tombstones=True, rewrite=True, queues=2)
    Capture(spark, SchemaRegistry([T]), O.OffsetStore(spark, f"file://{tmp_path}/o"), sink).batch(log(spark))
    got = spark.read.json(f"{tmp_path}/out/ks.t").collect()
    values = sorted(json.loads(r["value"])["op"] for r in got if r["value"])
    assert values == ["c", "d"] and len(got) == 3 and {r["key"] for r in got} == {'{"a":1}'}


def test_partition_value_mode(spark, tmp_path):
    out = []
    sink = sinks.EventSink(lambda e, s: out.extend(e.collect()), "p", "c", lambda: 7, queues=3, mode="PARTITION_VALUES")
    sink(E.with_row(E.changes(log(spark), SchemaRegistry([T]).frame(spark)), T, TypeSystem()), T)
    assert [r["op"] for r in out] == ["i", "d"]


def test_converters(spark):
    one = spark.range(1).select(F.struct(F.lit(None).cast("int").alias("x")).alias("s"), F.lit(None).cast("struct<x:int>").alias("n"))
    assert tuple(one.select(sinks.json_converter(F.col("s")), sinks.json_converter(F.col("n"))).first()) == ('{"x":null}', None)
    assert sinks.converter("some.pack.JsonConverter") is sinks.json_converter and sinks.converter("avro") is sinks.avro_converter
    with pytest.raises(ValueError, match="unknown converter"):
        sinks.converter("x.Y")


def test_headers(spark):
    e = E.envelope(E.with_row(E.changes(log(spark), SchemaRegistry([T]).frame(spark)), T, TypeSystem()), T, "p", E.source_block("c", False), 1)
    r = sinks.records(sinks.with_headers(e, {"trace": F.col("pos")})).first()
    assert r["topic"] == "p.ks.t" and r["headers"][0]["key"] == "trace"


def test_kafka_needs_its_jar(spark):
    e = E.envelope(E.with_row(E.changes(log(spark), SchemaRegistry([T]).frame(spark)), T, TypeSystem()), T, "p", E.source_block("c", False), 1)
    with pytest.raises(Exception, match="(?i)kafka"):
        sinks.to_kafka({"bootstrap.servers": "localhost:1"})(e, T)


def test_client_and_discovery(spark):
    assert execute(spark, "SELECT :x + 1 AS y", {"x": 1}).first()["y"] == 2 and execute(spark, "SELECT ? AS y", [5]).first()["y"] == 5 and execute(spark, "SELECT 1 AS y").first()["y"] == 1
    spark.sql("CREATE DATABASE IF NOT EXISTS shopdb")
    spark.sql("CREATE TABLE IF NOT EXISTS shopdb.on_ (a INT, b STRING) USING parquet TBLPROPERTIES ('cdc' = 'true')")
    spark.sql("CREATE TABLE IF NOT EXISTS shopdb.off_ (a INT) USING parquet")
    found = discover(spark, "shopdb", {"on_": ["a"]})
    assert [s.name for s in found.tables()] == ["shopdb.on_"] and [c.cql_type for c in found.tables()[0].columns] == ["int", "text"]
    assert [c.name for c in found.tables()[0].primary_key] == ["a"]
    spark.sql("DROP DATABASE shopdb CASCADE")
