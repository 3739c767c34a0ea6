"""The end-to-end fixtures: what a table's mutations become."""

import json

import pytest
from pyspark.sql import functions as F

from logs import TS, bound, cell, frame, mutation, row, spec, update
from tidemark.functions.types import TypeSystem
from tidemark.operators import events as E
from tidemark.operators import offsets as O
from tidemark.spec import SchemaRegistry


def capture(spark, table, mutations, keep=None, **more):
    rows = E.changes(frame(spark, mutations), SchemaRegistry([table]).frame(spark), keep)
    return E.position_order(E.with_row(rows, table, TypeSystem(), **more)).collect()


def ops(rows):
    return [r["op"] for r in rows]


def test_row_inserts(spark):
    t = spec("ks", "t", ["a:int"], regular=["b:int"])
    rows = capture(spark, t, [mutation(i, update("t", {"a": i}, [row(0, cells={"b": cell(i * 2)})])) for i in range(5)])
    assert ops(rows) == ["i"] * 5
    assert [(r["key"]["a"], r["after"]["b"]["value"]) for r in rows] == [(i, i * 2) for i in range(5)]


def test_partition_delete_without_clustering(spark):
    t = spec("ks", "t", ["a:int"], regular=["b:int"])
    rows = capture(spark, t, [mutation(1, update("t", {"a": 1}, [row(0, cells={"b": cell(2)})])), mutation(2, update("t", {"a": 1}, [], deleted_at=TS + 1))])
    assert ops(rows) == ["i", "d"]
    gone = rows[1]["after"]["b"]
    assert (gone["value"], gone["deletion_ts"], gone["set"]) == (None, TS + 1, True)
    assert rows[1]["event_ts"] == TS + 1


def test_partition_delete_with_clustering(spark):
    t = spec("ks", "t", ["a:int"], ["b:int"], ["c:int"])
    rows = capture(spark, t, [
        mutation(1, update("t", {"a": 1}, [row(0, {"b": "1"}, {"c": cell(1)})])), mutation(2, update("t", {"a": 1}, [row(0, {"b": "2"}, {"c": cell(2)})])), mutation(3, update("t", {"a": 1}, [], deleted_at=TS)),
    ])
    assert ops(rows) == ["i", "i", "d"]
    assert rows[2]["key"]["b"] is None and rows[2]["after"]["b"]["set"]


def test_range_delete(spark):
    t = spec("ks", "t", ["a:int"], ["b:int", "c:int", "d:int"], ["e:int"])
    marks = [row(0, kind="RANGE_OPEN", insert=False, deleted_at=TS + 5, opens=bound("INCL_START_BOUND", b=1)), row(1, kind="RANGE_CLOSE", insert=False, deleted_at=TS + 5, closes=bound("INCL_END_BOUND", b=1, c=2))]
    rows = capture(spark, t, [
        mutation(1, update("t", {"a": 1}, [row(0, {"b": "1", "c": "1", "d": "1"}, {"e": cell(1)})])), mutation(2, update("t", {"a": 1}, [row(0, {"b": "1", "c": "2", "d": "3"}, {"e": cell(2)})])), mutation(3, update("t", {"a": 1}, marks)),
    ])
    assert ops(rows) == ["i", "i", "r"]
    after = rows[2]["after"]
    assert after["_range_start"]["method"] == "INCL_START_BOUND" and [tuple(v) for v in after["_range_start"]["values"]] == [("b", "1", "Int32Type")]
    assert [tuple(v)[:2] for v in after["_range_end"]["values"]] == [("b", "1"), ("c", "2")]
    assert after["a"]["value"] == 1 and after["b"] is None and rows[2]["event_ts"] == TS + 5


def test_range_boundary_closes_one_and_opens_the_next(spark):
    t = spec("ks", "t", ["a:int"], ["b:int"])
    marks = [
        row(0, kind="RANGE_OPEN", insert=False, deleted_at=1, opens=bound("INCL_START_BOUND", b=1)), row(1, kind="RANGE_BOUNDARY", insert=False, deleted_at=2, opens=bound("EXCL_START_BOUND", b=2), closes=bound("INCL_END_BOUND", b=2)),
        row(2, kind="RANGE_CLOSE", insert=False, deleted_at=2, closes=bound("INCL_END_BOUND", b=3)),
    ]
    rows = capture(spark, t, [mutation(1, update("t", {"a": 1}, marks))])
    pairs = [(r["after"]["_range_start"]["values"][0]["value"], r["after"]["_range_end"]["values"][0]["value"]) for r in rows]
    assert ops(rows) == ["r", "r"] and pairs == [("1", "2"), ("2", "3")]


def test_an_open_bound_alone_gives_nothing(spark):
    t = spec("ks", "t", ["a:int"], ["b:int"])
    rows = capture(spark, t, [mutation(1, update("t", {"a": 1}, [row(0, kind="RANGE_OPEN", insert=False, deleted_at=1, opens=bound("INCL_START_BOUND", b=1))]))])
    assert rows == []


def test_logged_batch(spark):
    t = spec("ks", "t", ["p1:text", "p2:text", "p3:text"], ["c1:text"], ["col1:text", "col2:text", "amap:map<text,text>"])
    ttl = TS // 1_000_000 + 3600
    each = [row(i, {"c1": c}, {"col1": cell("x", expires_at=ttl), "amap": cell(json.dumps({"k": "v"}), expires_at=ttl)}) for i, c in enumerate(["", "c1value1", "c1value2"])]
    rows = capture(spark, t, [mutation(1, update("t", {"p1": "a", "p2": "b", "p3": "c"}, each, deleted_at=TS - 1))])
    assert ops(rows) == ["d", "i", "i", "i"]
    assert rows[1]["after"]["col1"]["deletion_ts"] == ttl * 1_000_000
    assert rows[1]["after"]["amap"]["deletion_ts"] is None and rows[1]["after"]["amap"]["value"] == {"k": "v"}
    assert rows[1]["after"]["col2"] is None  # unset
    assert rows[0]["after"]["col2"]["set"]


def test_update_unset_null_and_value(spark):
    t = spec("ks", "t", ["a:int"], regular=["b:int", "c:int", "d:int"])
    (r,) = capture(spark, t, [mutation(1, update("t", {"a": 1}, [row(0, cells={"b": cell(None, tombstone=True), "c": cell(3)}, insert=False)]))])
    assert r["op"] == "u" and r["after"]["b"]["set"] and r["after"]["b"]["value"] is None and r["after"]["b"]["deletion_ts"] is None
    assert r["after"]["c"]["value"] == 3 and r["after"]["d"] is None


def test_two_keyspaces_two_tables(spark):
    tables = [spec(k, t, ["a:int"], ["b:int"], ["c:int"]) for k in ("k1", "k2") for t in ("t1", "t2")]
    log = [mutation(i, update(t.table, {"a": 1}, [row(0, {"b": "1"}, {"c": cell(1)})]), keyspace=t.keyspace) for i, t in enumerate(tables)]
    log += [mutation(10 + i, update(t.table, {"a": 1}, [], deleted_at=TS), keyspace=t.keyspace) for i, t in enumerate(tables)]
    rows = E.position_order(E.changes(frame(spark, log), SchemaRegistry(tables).frame(spark))).collect()
    assert ops(rows) == ["i"] * 4 + ["d"] * 4


def test_untracked_unsupported_and_unknown_are_dropped(spark):
    t = spec("ks", "t", ["a:int"], regular=["b:int"])
    one = [row(0, cells={"b": cell(1)})]
    log = [
        mutation(1, update("t", {"a": 1}, one), tracked=False), mutation(2, update("t", {"a": 1}, one, counter=True)), mutation(3, update("t", {"a": 1}, one, view=True)), mutation(4, update("t", {"a": 1}, one, index=True)),
        mutation(5, update("other", {"a": 1}, one)), mutation(6, update("t", {"a": 1}, [row(0, kind="STATIC"), *one])),
    ]
    assert [r["pos"] for r in capture(spark, t, log)] == [6]


def test_reprocessing(spark):
    t = spec("ks", "t", ["id:int"], regular=["val:int"])
    log = frame(spark, [mutation(i, update("t", {"id": i}, [row(0, cells={"val": cell(i)})])) for i in range(5)])
    specs = SchemaRegistry([t]).frame(spark)
    first = E.changes(log, specs)
    marks = O.high_water(first)
    flagged = lambda again: E.changes(log.withColumn("reprocess", F.lit(again)), specs, lambda u: O.unprocessed(u, marks)).count()
    assert (first.count(), flagged(False), flagged(True)) == (5, 0, 5)


def test_one_update_already_processed_leaves_the_others(spark):
    t1, t2 = spec("ks", "t1", ["a:int"], regular=["b:int"]), spec("ks", "t2", ["a:int"], regular=["b:int"])
    one = [row(0, cells={"b": cell(1)})]
    log = frame(spark, [mutation(7, update("t1", {"a": 1}, one), update("t2", {"a": 1}, one))])
    marks = O.offsets_frame(spark, [("ks.t1", O.LOG, "CommitLog-7-1.log", 7)])
    rows = E.changes(log, SchemaRegistry([t1, t2]).frame(spark), lambda u: O.unprocessed(u, marks)).collect()
    assert [r["table"] for r in rows] == ["t2"]


def test_schema_evolution(spark):
    old = spec("ks", "t", ["a:int"], ["b:int"])
    new = old.with_column(spec("ks", "t", [], [], ["c:int"]).columns[0])
    log = [mutation(1, update("t", {"a": 1}, [row(0, {"b": "1"}, {"c": cell(9)})]))]
    assert "c" not in capture(spark, old, log)[0]["after"].asDict()
    assert capture(spark, new, log)[0]["after"]["c"]["value"] == 9


def test_excluded_columns(spark):
    t = spec("ks", "t", ["a:int"], ["k:int"], ["b:int"])
    log = [mutation(1, update("t", {"a": 1}, [row(0, {"k": "1"}, {"b": cell(1)}), row(1, {"k": "2"}, insert=False, deleted_at=TS)]))]
    up, gone = capture(spark, t, log, exclude=["b", "k"])
    assert up["after"]["b"] is None and up["key"]["k"] is None  # an excluded key column leaves the key
    assert gone["after"]["b"]["set"] and gone["key"]["k"] == 2


def test_envelope_tombstones_rewrite_and_json(spark):
    t = spec("ks", "t", ["a:int"], regular=["b:int"])
    log = frame(spark, [mutation(1, update("t", {"a": 1}, [row(0, cells={"b": cell(1)})])), mutation(2, update("t", {"a": 1}, [], deleted_at=TS))])
    rows = E.with_row(E.changes(log, SchemaRegistry([t]).frame(spark)), t, TypeSystem())
    events = E.envelope(rows, t, "pre", E.source_block("c1", False), 5)
    out = E.serialise(E.rewrite_envelope(E.fan_out_tombstones(events))).orderBy("pos", "event_type").collect()
    assert [(r["event_type"], r["topic"], r["mark_offset"]) for r in out] == [("CHANGE", "pre.ks.t", True), ("CHANGE", "pre.ks.t", True), ("TOMBSTONE", "pre.ks.t", False)]
    first = json.loads(out[0]["value"])
    assert first["op"] == "c" and first["ts_ms"] == 5 and first["source"]["cluster"] == "c1" and first["after"]["b"] == {"value": 1, "deletion_ts": None, "set": True}
    assert first["after"]["_range_start"] is None and out[2]["value"] is None and json.loads(out[2]["key"]) == {"a": 1}


@pytest.mark.parametrize(("old", "new"), [("i", "c"), ("u", "u"), ("d", "d"), ("r", "t"), ("x", "x")])
def test_op_codes(spark, old, new):
    assert spark.range(1).select(E.rewrite_op(F.lit(old))).first()[0] == new


def test_unknown_column_lookup_is_struct_only():
    from pyspark.sql import types as T

    from tidemark.spec import struct_field_type

    s = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StructType([]))])
    assert struct_field_type(s, "b") == T.StructType([])
    with pytest.raises(TypeError):
        struct_field_type(s, "a")
