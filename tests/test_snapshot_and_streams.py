import os

import pytest
from pyspark.sql import functions as F

from logs import TS, cell, frame, mutation, row, spec, update
from tidemark.functions.types import TypeSystem
from tidemark.operators import events as E
from tidemark.operators import metrics as M
from tidemark.operators import offsets as O
from tidemark.sources import mutation_log as L
from tidemark.sources import snapshot as S
from tidemark.spec import SchemaRegistry
from tidemark.streaming import log_source
from tidemark.streaming.pipeline import DEAD_LETTER, Capture, healthy
from tidemark.streaming.transfer import ERROR, OK, Deletion, Relocation

T1, T2 = spec("ks", "t1", ["a:int"], regular=["b:text"]), spec("ks", "t2", ["a:int"], regular=["b:text"])


def runner(spark, tmp_path, mode, rows=5, specs=(T1, T2)):
    read = lambda s: spark.range(rows).select(F.col("id").cast("int").alias("a"), F.col("id").cast("string").alias("b"))
    return S.SnapshotRunner(spark, SchemaRegistry(specs), read, O.OffsetStore(spark, f"file://{tmp_path}/{mode}-{rows}"), mode)


def test_snapshot_of_two_tables(spark, tmp_path):
    out = []
    r = runner(spark, tmp_path, "initial")
    assert r.poll(lambda df, s: out.extend(df.collect()), 1) == ["ks.t1", "ks.t2"]
    assert len(out) == 10 and {x["op"] for x in out} == {"i"} and {(x["file"], x["pos"]) for x in out} == {("", -1)}
    assert out[0]["after"]["b"]["set"] and r.pending() == []


@pytest.mark.parametrize(("mode", "runs"), [("ALWAYS", 5), ("INITIAL", 1), ("NEVER", 0)])
def test_snapshot_modes(spark, tmp_path, mode, runs):
    r = runner(spark, tmp_path, mode, specs=(T1,))
    assert sum(bool(r.poll(lambda df, s: None, 1)) for _ in range(5)) == runs


def test_empty_table_is_marked_at_once(spark, tmp_path):
    r = runner(spark, tmp_path, "INITIAL", rows=0)
    r.poll(lambda df, s: df.count(), 1)
    assert r.store.load().count() == 2


def test_a_failed_table_stays_pending(spark, tmp_path):
    r = runner(spark, tmp_path, "INITIAL", specs=(T1,))
    with pytest.raises(RuntimeError):
        r.poll(lambda df, s: (_ for _ in ()).throw(RuntimeError("sink")), 1)
    assert [s.name for s in r.pending()] == ["ks.t1"]


def test_ttl_only_for_regular_values(spark):
    t = spec("ks", "t", ["a:int"], regular=["b:text", "c:list<int>", "d:text"])
    src = spark.sql("SELECT 1 AS a, 'x' AS b, array(1) AS c, CAST(NULL AS string) AS d, 60 AS b_ttl, 60 AS c_ttl, 60 AS d_ttl, 60 AS a_ttl")
    after = S.snapshot(src, t, TypeSystem(), 1_000).first()["after"]
    assert after["b"]["deletion_ts"] == 1_000_000 + 60_000_000
    assert after["c"]["deletion_ts"] is None and after["d"]["deletion_ts"] is None and after["a"]["deletion_ts"] is None and after["d"]["set"]


def test_snapshot_excludes_are_never_read(spark, sf_dir):
    from tidemark.plans.driver_log import ORDERS

    df = S.snapshot(spark.read.parquet(f"{sf_dir}/orders.parquet"), ORDERS, TypeSystem(), 1, exclude=["o_orderpriority"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "o_orderpriority" not in plan[plan.index("ReadSchema") :]
    assert df.first()["after"]["o_orderpriority"] is None


def mutations(n, start=0, file="CommitLog-7-1.log"):
    def as_json(i):
        return {"pos": i, "tracked_by_cdc": True, "keyspace": "ks", "updates": [{"table": "t1", "partition_key": {"a": str(i)}, "rows": [{"seq": 0, "kind": "ROW", "liveness_ts": TS, "written_at": TS, "cells": {"b": {"value": f"v{i}", "tombstone": False}}}]}]}

    return [as_json(i) for i in range(start, start + n)]


def capture(spark, tmp_path, sink, **more):
    return Capture(spark, SchemaRegistry([T1]), O.OffsetStore(spark, f"file://{tmp_path}/offsets"), sink, **more)


def test_stream_honours_index_files_and_restarts(spark, tmp_path):
    folder, state, out = f"{tmp_path}/cdc", f"{tmp_path}/state", []
    log_source.write_segment(folder, "CommitLog-7-1.log", mutations(3))
    log_source.write_segment(folder, "CommitLog-7-2.log", mutations(2), completed=False)
    c = capture(spark, tmp_path, lambda df, s: out.extend(r["file"] for r in df.collect()))
    q = c.start(log_source.read_stream(spark, folder), state)
    q.awaitTermination()
    assert out == ["CommitLog-7-1.log"] * 3
    log_source.write_segment(folder, "CommitLog-7-2.log", mutations(4))
    c.start(log_source.read_stream(spark, folder), state).awaitTermination()
    assert out.count("CommitLog-7-2.log") == 4 and len(out) == 7
    assert healthy([q])["healthy"] is False


def test_real_time_reads_the_synced_part(spark, tmp_path):
    folder, out = f"{tmp_path}/cdc", []
    log_source.write_segment(folder, "CommitLog-7-1.log", mutations(2), completed=False)
    c = capture(spark, tmp_path, lambda df, s: out.extend(df.collect()))
    c.start(log_source.read_stream(spark, folder, real_time=True), f"{tmp_path}/s").awaitTermination()
    log_source.write_segment(folder, "CommitLog-7-1.log", mutations(5), completed=False)
    c.start(log_source.read_stream(spark, folder, real_time=True), f"{tmp_path}/s").awaitTermination()
    assert sorted(r["pos"] for r in out) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize(("text", "real_time", "n"), [("10\nCOMPLETED", False, 10), ("10", False, 0), ("10", True, 10), ("", True, 0), ("10\nCOMPLETED\nx", False, 0)])
def test_readable_bytes(text, real_time, n):
    assert log_source.readable_bytes(text, real_time) == n


def batch(spark, file="CommitLog-7-1.log", n=3):
    return frame(spark, [mutation(i, update("t1", {"a": i}, [row(0, cells={"b": cell("x")})]), file=file) for i in range(n)])


def test_archive_on_success(spark, tmp_path):
    folder = f"{tmp_path}/cdc"
    log_source.write_segment(folder, "CommitLog-7-1.log", mutations(1))
    move = Relocation(spark, f"{tmp_path}/moved")
    c = capture(spark, tmp_path, lambda df, s: df.count(), transfer=move, folder=folder)
    c.batch(batch(spark))
    assert c.results == {"CommitLog-7-1.log": OK} and sorted(x for x in os.listdir(f"{tmp_path}/moved/archive") if not x.startswith(".")) == ["CommitLog-7-1.log", "CommitLog-7-1_cdc.idx"]
    assert move.drain(Deletion(spark)) == {"archive": 1, "error": 0} and not [x for x in os.listdir(f"{tmp_path}/moved/archive") if not x.startswith(".")]


def test_dead_letter_and_reprocessing(spark, tmp_path):
    folder, fail, out = f"{tmp_path}/cdc", [True], []
    log_source.write_segment(folder, "CommitLog-7-1.log", mutations(1))

    def sink(df, s):
        if fail[0]:
            raise RuntimeError("sink")
        out.extend(df.collect())

    move = Relocation(spark, f"{tmp_path}/moved")
    c = capture(spark, tmp_path, sink, failure=DEAD_LETTER, transfer=move, folder=folder)
    c.batch(batch(spark))
    assert c.results == {"CommitLog-7-1.log": ERROR} and c.reprocessing == {"CommitLog-7-1.log"} and c.store.load().count() == 0
    assert [os.path.basename(x) for x in move.error_files()] == ["CommitLog-7-1.log"]
    fail[0] = False
    c.batch(batch(spark))
    assert len(out) == 3 and not c.reprocessing
    c.batch(batch(spark))
    assert len(out) == 3  # behind the offset by now


def test_fail_fast(spark, tmp_path):
    with pytest.raises(RuntimeError):
        capture(spark, tmp_path, lambda df, s: (_ for _ in ()).throw(RuntimeError("sink"))).batch(batch(spark))


def test_only_segments_are_deleted(spark, tmp_path):
    (tmp_path / "x.txt").write_text("x")
    with pytest.raises(ValueError, match="not a segment"):
        Deletion(spark).on_success(f"{tmp_path}/x.txt")


def test_listings(spark, tmp_path):
    for i in (2, 10, 1):
        log_source.write_segment(str(tmp_path), f"CommitLog-7-{i}.log", mutations(1), completed=i != 10)
    (tmp_path / "Not-CommitLog-7-3.log").write_text("x")
    seen = L.list_segments(spark, str(tmp_path))
    assert [r["segment"] for r in seen.orderBy("segment").collect()] == [1, 2, 10]
    assert {r["segment"]: r["completed"] for r in L.list_indexes(spark, str(tmp_path)).collect()} == {1: True, 2: True, 10: False}
    assert L.latest_segment(seen).count() == 1 and L.directory_bytes(seen).first()["files"] == 3
    read = L.read_log(spark, f"{tmp_path}/CommitLog-7-1.log")
    assert read.select("pos").first()[0] == 0


def test_observed_counts(spark, tmp_path):
    rows = E.changes(batch(spark, n=4), SchemaRegistry([T1]).frame(spark))
    df, seen = M.observed(rows)
    df.write.parquet(f"{tmp_path}/o")
    assert seen.get == {"emitted": 4, "deletes": 0}


def test_order_is_kept_inside_queues(spark):
    rows = E.changes(batch(spark, n=50).union(batch(spark, "CommitLog-7-10.log", 50)), SchemaRegistry([T1]).frame(spark))
    dealt = E.partition_for_order(rows, 4).select(F.spark_partition_id().alias("q"), "file", "pos").collect()
    assert len({(r["file"], r["q"]) for r in dealt}) == 2
    for f in {r["file"] for r in dealt}:
        assert [r["pos"] for r in dealt if r["file"] == f] == list(range(50))
    queues = E.partition_for_order(rows, 4).select(F.spark_partition_id().alias("q"), E.queue_index(4)).distinct().collect()
    assert all(r["q"] == r["queue"] for r in queues)
    assert rows.select(E.queue_index(4, snapshot=True)).distinct().count() == 1


def test_listener_and_stop(spark, tmp_path):
    from tidemark.streaming.pipeline import COMPLETED_PREMATURELY, stop

    seen = M.StreamMetrics()
    spark.streams.addListener(seen)
    try:
        folder = f"{tmp_path}/cdc"
        log_source.write_segment(folder, "CommitLog-7-1.log", mutations(3))
        c = capture(spark, tmp_path, lambda df, s: df.count())
        q = c.start(log_source.read_stream(spark, folder), f"{tmp_path}/s", once=False, interval="1 second")
        q.processAllAvailable()
        assert stop(q, 0.5) == COMPLETED_PREMATURELY and not q.isActive
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        assert seen.rows == 3 and seen.failures == 0
    finally:
        spark.streams.removeListener(seen)


def test_stream_and_batch_agree(spark, tmp_path):
    folder, out = f"{tmp_path}/cdc", []
    for i in range(3):
        log_source.write_segment(folder, f"CommitLog-7-{i}.log", mutations(4))
    c = capture(spark, tmp_path, lambda df, s: out.extend((r["file"], r["pos"], r["op"], r["after"]["b"]["value"]) for r in df.collect()))
    c.start(log_source.read_stream(spark, folder), f"{tmp_path}/s").awaitTermination()
    log = L.read_log(spark, f"{folder}/CommitLog-7-*.log").withColumn("file", F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1))
    rows = E.with_row(E.changes(log, SchemaRegistry([T1]).frame(spark)), T1, TypeSystem()).collect()
    assert sorted(out) == sorted((r["file"], r["pos"], r["op"], r["after"]["b"]["value"]) for r in rows) and len(out) == 12
