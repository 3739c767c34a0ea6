"""The streaming log source and capture: no line is lost, cut or doubled, and nothing is archived before its end."""

import json
import os

import pytest
from pyspark.sql import functions as F

from logs import TS, bound, frame, mutation, row, spec, update
from tidemark.functions.types import TypeSystem
from tidemark.operators import events as E
from tidemark.operators import offsets as O
from tidemark.sources import mutation_log as L
from tidemark.spec import SchemaRegistry
from tidemark.streaming import log_source as LS
from tidemark.streaming.pipeline import DEAD_LETTER, BrokenLines, Capture
from tidemark.streaming.transfer import OK, Deletion, Relocation

T1 = spec("ks", "t1", ["a:text"], regular=["b:text"])


def change(i, text="x"):
    return {"pos": i, "tracked_by_cdc": True, "keyspace": "ks", "updates": [{"table": "t1", "partition_key": {"a": str(i)}, "rows": [{"seq": 0, "kind": "ROW", "liveness_ts": TS, "written_at": TS, "cells": {"b": {"value": text, "tombstone": False}}}]}]}


def capture(spark, tmp_path, out, **more):
    return Capture(spark, SchemaRegistry([T1]), O.OffsetStore(spark, f"file://{tmp_path}/offsets"), lambda df, s: out.extend((r["pos"], r["after"]["b"]["value"]) for r in df.collect()), **more)


def read_all(reader, start=None):
    """All rows between two offsets."""
    end = reader.latestOffset()
    parts = reader.partitions(start or {}, end)
    return [r for p in parts for b in reader.read(p) for r in b.to_pylist()], end


def test_lines_end_at_newlines_only(spark, tmp_path):
    """Line separators of Unicode, form feeds and carriage returns belong to their line."""
    folder, out = f"{tmp_path}/cdc", []
    texts = ["a\u2028b", "c\u0085d", "e\x0cf", "g\u2029h", "plain"]
    LS.write_segment(folder, "CommitLog-7-1.log", [change(i, t) for i, t in enumerate(texts)])
    capture(spark, tmp_path, out).start(LS.read_stream(spark, folder), f"{tmp_path}/s").awaitTermination()
    assert sorted(out) == list(enumerate(texts))


@pytest.mark.parametrize("slice_bytes", [1 << 26, 100, 7])
def test_a_synced_offset_inside_a_line_loses_nothing(tmp_path, monkeypatch, slice_bytes):
    monkeypatch.setattr(LS, "SLICE", slice_bytes)
    monkeypatch.setattr(LS, "BATCH", 64)
    monkeypatch.setattr(LS, "STEP", 16)
    folder = str(tmp_path)
    body = [json.dumps({"pos": i, "text": "y" * (i * 13 % 90)}) for i in range(40)]
    LS.write_segment(folder, "CommitLog-7-1.log", [json.loads(x) for x in body], completed=False)
    size = os.path.getsize(f"{folder}/CommitLog-7-1.log")
    reader, at, got = LS.LogReader(folder, True), {}, []
    for synced in [*range(0, size, 37), size]:
        LS.write_index(folder, "CommitLog-7-1.log", synced, False)
        rows, end = read_all(reader, at)
        got += rows
        at = end or at
    LS.write_index(folder, "CommitLog-7-1.log", size, True)
    rows, _ = read_all(reader, at)
    assert [r["mutation"] for r in got] == body and not any(r["eof"] for r in got)  # its end comes without a line
    assert [(r["eof"], r["mutation"], r["at"]) for r in rows] == [(True, None, size)]


def test_a_last_line_without_newline_counts_once_complete(tmp_path):
    (tmp_path / "CommitLog-7-1.log").write_bytes(b'{"pos":1}\n{"pos":2}')
    LS.write_index(str(tmp_path), "CommitLog-7-1.log", 19, False)
    reader = LS.LogReader(str(tmp_path), True)
    first, at = read_all(reader)
    LS.write_index(str(tmp_path), "CommitLog-7-1.log", 19, True)
    second, _ = read_all(reader, at)
    assert [r["mutation"] for r in first] == ['{"pos":1}'] and [(r["mutation"], r["eof"]) for r in second] == [('{"pos":2}', True)]


@pytest.mark.parametrize("limit", [1, 60, 250, 10_000])
def test_batches_are_bounded_and_restarts_go_on(tmp_path, limit):
    for i in (2, 10, 1):
        LS.write_segment(str(tmp_path), f"CommitLog-7-{i}.log", [{"pos": j, "text": "z" * 20} for j in range(5)])
    reader, at, got, rounds = LS.LogReader(str(tmp_path), False, limit), {}, [], 0
    while True:
        rows, end = read_all(reader, at)
        if end == at:
            break
        assert sum(len(r["mutation"]) + 1 for r in rows if r["mutation"]) <= max(limit, 43)  # one line at least
        got, at, rounds = got + rows, end, rounds + 1
        if rounds % 2:  # a new reader after a restart
            reader = LS.LogReader(str(tmp_path), False, limit)
            reader.at = json.loads(json.dumps(at))
    assert [(r["file"], json.loads(r["mutation"])["pos"]) for r in got if r["mutation"]] == [(f"CommitLog-7-{i}.log", j) for i in (1, 2, 10) for j in range(5)]
    assert [r["file"] for r in got if r["eof"]] == [f"CommitLog-7-{i}.log" for i in (1, 2, 10)]


def test_offsets_come_from_the_checkpoint(spark, tmp_path):
    folder, state, out = f"{tmp_path}/cdc", f"{tmp_path}/s", []
    LS.write_segment(folder, "CommitLog-7-1.log", [change(i) for i in range(6)])
    c = capture(spark, tmp_path, out)
    size = os.path.getsize(f"{folder}/CommitLog-7-1.log")
    seen = []
    for _ in range(10):
        before = LS.checkpointed(state)
        c.start(LS.read_stream(spark, folder, max_bytes=size // 3, checkpoint=state), state).awaitTermination()
        if LS.checkpointed(state) == before:
            break
        seen.append(len(out))
    assert [x for x, _ in out] == list(range(6)) and len(seen) >= 3 and LS.checkpointed(state) == {"CommitLog-7-1.log": [size, True]}


def test_a_segment_being_written_is_not_archived(spark, tmp_path):
    folder, out = f"{tmp_path}/cdc", []
    move = Relocation(spark, f"{tmp_path}/moved")
    c = capture(spark, tmp_path, out, transfer=move, folder=folder)
    run = lambda: c.start(LS.read_stream(spark, folder, real_time=True), f"{tmp_path}/s").awaitTermination()
    LS.write_segment(folder, "CommitLog-7-1.log", [change(i) for i in range(2)], completed=False)
    run()
    move.drain(Deletion(spark))
    assert len(out) == 2 and c.results == {} and os.path.exists(f"{folder}/CommitLog-7-1.log") and os.path.exists(f"{folder}/CommitLog-7-1_cdc.idx")
    LS.write_segment(folder, "CommitLog-7-1.log", [change(i) for i in range(5)], completed=False)
    run()
    assert len(out) == 5 and os.path.exists(f"{folder}/CommitLog-7-1.log")
    LS.write_segment(folder, "CommitLog-7-1.log", [change(i) for i in range(5)])  # nothing new but its end
    run()
    assert len(out) == 5 and c.results == {"CommitLog-7-1.log": OK} and not os.path.exists(f"{folder}/CommitLog-7-1.log")
    assert os.path.exists(f"{tmp_path}/moved/archive/CommitLog-7-1.log")


def test_segments_are_read_in_order(spark, tmp_path):
    """A later segment waits for the earlier one, else the offsets would take the earlier one's rest for processed."""
    folder, out = f"{tmp_path}/cdc", []
    c = capture(spark, tmp_path, out)
    for real_time, state in ((False, "a"), (True, "b")):
        assert LS.LogReader(folder, real_time).latestOffset() == {}
    LS.write_segment(folder, "CommitLog-7-9.log", [change(i) for i in range(4)], completed=False)
    LS.write_segment(folder, "CommitLog-7-10.log", [change(i) for i in range(2)])
    size = os.path.getsize(f"{folder}/CommitLog-7-9.log")
    LS.write_index(folder, "CommitLog-7-9.log", size // 2, False)
    assert LS.LogReader(folder, False).latestOffset() == {} and list(LS.LogReader(folder, True).latestOffset()) == ["CommitLog-7-9.log"]
    run = lambda: c.start(LS.read_stream(spark, folder, real_time=True), f"{tmp_path}/s").awaitTermination()
    run()
    assert 0 < len(out) < 4
    LS.write_index(folder, "CommitLog-7-9.log", size, True)
    run()
    assert [p for p, _ in out] == [0, 1, 2, 3, 0, 1]


def broken_segment(folder):
    LS.write_segment(folder, "CommitLog-7-1.log", [change(0), change(1)])
    with open(f"{folder}/CommitLog-7-1.log", "ab") as f:
        f.write(b'{"pos": 7, "trunc\n[1]\n{"other": 1}\n')
    LS.write_index(folder, "CommitLog-7-1.log", os.path.getsize(f"{folder}/CommitLog-7-1.log"), True)


def test_broken_lines_are_never_dropped_in_silence(spark, tmp_path):
    folder, out, told = f"{tmp_path}/cdc", [], []
    broken_segment(folder)
    read = lambda: spark.createDataFrame([r for r in read_all(LS.LogReader(folder, False))[0]], "file string, at long, mutation string, eof boolean")
    with pytest.raises(BrokenLines, match="trunc"):
        capture(spark, tmp_path / "a", out).batch(L.parsed(read()))
    assert out == []
    c = capture(spark, tmp_path / "b", out, broken=lambda df: told.extend(df.collect()))
    c.batch(L.parsed(read()))
    assert len(out) == 2 and sorted(r["broken"] for r in told) == ['[1]', '{"other": 1}', '{"pos": 7, "trunc'] and c.results["CommitLog-7-1.log"] == OK
    assert c.metrics.report()["mutations_unrecoverable"] == 3
    move = Relocation(spark, f"{tmp_path}/moved")
    c = capture(spark, tmp_path / "c", out, failure=DEAD_LETTER, transfer=move, folder=folder)
    c.batch(L.parsed(read()))
    assert [os.path.basename(x) for x in move.error_files()] == ["CommitLog-7-1.log"]


def test_failures_outlive_a_restart(spark, tmp_path):
    """A table's failure sets aside only the files that hold its rows, also if their end comes in a later process."""
    t2 = spec("ks", "t2", ["a:text"], regular=["b:text"])
    good = lambda i, f: mutation(i, update("t1", {"a": i}, [row(0)]), file=f)
    bad = lambda i, f: mutation(i, update("t2", {"a": i}, [row(0)]), file=f)

    def sink(df, s):
        if s.table == "t2":
            raise RuntimeError("sink")
        df.count()

    def new():
        return Capture(spark, SchemaRegistry([T1, t2]), O.OffsetStore(spark, f"file://{tmp_path}/offsets"), sink, failure=DEAD_LETTER)

    log = frame(spark, [good(1, "CommitLog-7-1.log"), bad(2, "CommitLog-7-2.log")])
    new().batch(log.withColumn("eof", F.lit(False)))
    again = new()
    assert again.erroneous == {"CommitLog-7-2.log"}
    again.batch(frame(spark, []).withColumn("eof", F.lit(False)))
    end = spark.createDataFrame([("CommitLog-7-1.log", True), ("CommitLog-7-2.log", True)], "file string, eof boolean")
    again.batch(frame(spark, []).withColumn("eof", F.lit(False)).unionByName(end, allowMissingColumns=True))
    assert again.results == {"CommitLog-7-1.log": "OK", "CommitLog-7-2.log": "ERROR"}
    last = new()
    assert last.erroneous == set() and last.reprocessing == {"CommitLog-7-2.log"}


def marker(seq, kind, start=None, end=None, at=TS):
    return row(seq, kind=kind, insert=False, deleted_at=at, opens=None if start is None else bound("INCL_START_BOUND", c=start), closes=None if end is None else bound("INCL_END_BOUND", c=end))


T3 = spec("ks", "t3", ["a:int"], ["c:int"], ["b:int"])


def ranges(rows):
    one = lambda b: int(b["values"][0]["value"])
    return sorted((r["partition_key"]["a"], one(r["range_start"]), one(r["range_end"]), r["deleted_at"]) for r in rows if r["op"] == "r")


UPDATES = [
    ("1", [marker(0, "RANGE_CLOSE", end=9), marker(1, "RANGE_OPEN", 20, at=TS + 1), marker(2, "RANGE_CLOSE", end=30, at=TS + 2)]),  # a closing bound alone first
    ("1", [marker(0, "RANGE_OPEN", 40)]),
    ("2", [marker(0, "RANGE_OPEN", 1), marker(1, "RANGE_OPEN", 2), marker(2, "RANGE_CLOSE", end=3)]),  # the second opening replaces the first
    ("1", [marker(0, "RANGE_BOUNDARY", 50, 45, at=TS + 3), marker(1, "RANGE_CLOSE", end=60)]),
    ("2", [marker(0, "RANGE_CLOSE", end=4)]),  # nothing is open
    ("3", [marker(0, "RANGE_OPEN", 5)]),
    ("3", [marker(0, "RANGE_OPEN", 6), marker(1, "RANGE_CLOSE", end=7)]),
    ("3", [marker(0, "RANGE_CLOSE", end=8)]),
]
EXPECTED = [("1", 20, 30, TS + 1), ("1", 40, 45, TS), ("1", 50, 60, TS + 3), ("2", 2, 3, TS), ("3", 6, 7, TS)]


@pytest.mark.parametrize("one_mutation", [True, False])
def test_ranges_pair_in_order_across_updates(spark, one_mutation):
    ups = [update("t3", {"a": a}, rows) for a, rows in UPDATES]
    log = frame(spark, [mutation(1, *ups)] if one_mutation else [mutation(i, u) for i, u in enumerate(ups)])
    rows, left = E.all_changes(E.captured(log, SchemaRegistry([T3]).frame(spark)))
    assert ranges(rows.collect()) == EXPECTED and left.count() == 0


@pytest.mark.parametrize("size", [1, 2, 3])
def test_ranges_pair_across_batches(spark, tmp_path, size):
    out = []

    def new():
        return Capture(spark, SchemaRegistry([T3]), O.OffsetStore(spark, f"file://{tmp_path}/o"), lambda df, s: out.extend(df.collect()))

    muts = [mutation(i, update("t3", {"a": a}, rows)) for i, (a, rows) in enumerate(UPDATES)]
    for i in range(0, len(muts), size):
        new().batch(frame(spark, muts[i : i + size]).withColumn("eof", F.lit(False)))  # a new process each time
    assert ranges(out) == EXPECTED
    assert E.with_row(E.changes(frame(spark, muts), SchemaRegistry([T3]).frame(spark)), T3, TypeSystem()).filter("op = 'r'").count() == 4  # within updates only


def test_a_segment_that_is_gone_is_told(spark, tmp_path):
    c = capture(spark, tmp_path, [], transfer=Relocation(spark, f"{tmp_path}/moved"), folder=f"{tmp_path}/cdc")
    c.settle("CommitLog-7-77.log")
    assert c.results == {"CommitLog-7-77.log": "DOES_NOT_EXIST"}
