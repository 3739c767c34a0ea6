import json
import os
import time
import urllib.error
import urllib.request
import warnings

import pytest
from pyspark.sql import functions as F

from test_snapshot_and_streams import T1, T2, mutations
from tidemark.config import Config
from tidemark.plans.capture import CapturePlan
from tidemark.spec import SchemaRegistry
from tidemark.streaming import log_source


class Kept:
    """A transfer that keeps segments where they are and notes them."""

    def __init__(self):
        self.good, self.bad = [], []

    def on_success(self, path):
        self.good.append(os.path.basename(path))

    def on_error(self, path):
        self.bad.append(os.path.basename(path))

    def error_files(self):
        return []


def plan(spark, tmp_path, out, write=None, transfer=None, **more):
    given = {"offset.backing.store.dir": f"file://{tmp_path}/offsets", "commit.log.relocation.dir": f"{tmp_path}/moved", "topic.prefix": "pre", **more}
    read = lambda s: spark.range(2).select(F.col("id").cast("int").alias("a"), F.lit("s").alias("b"))
    write = write or (lambda e, s: out.extend((r["topic"], r["op"], r["value"]["source"]["snapshot"], r["event_type"]) for r in e.collect()))
    return CapturePlan(spark, Config.of(given), SchemaRegistry([T1]), f"{tmp_path}/cdc", read, write, transfer=transfer, clock=lambda: 5)


def test_snapshot_then_log(spark, tmp_path):
    log_source.write_segment(f"{tmp_path}/cdc", "CommitLog-7-1.log", mutations(3))
    out, kept = [], Kept()
    p = plan(spark, tmp_path, out, transfer=kept)
    assert p.run(f"{tmp_path}/state") == ["ks.t1"]
    assert [x[2] for x in out] == ["true"] * 2 + ["false"] * 3 and {x[0] for x in out} == {"pre.ks.t1"}
    assert kept.good == ["CommitLog-7-1.log"]
    assert p.run(f"{tmp_path}/state") == [] and len(out) == 5


def test_segments_are_deleted_by_default(spark, tmp_path):
    log_source.write_segment(f"{tmp_path}/cdc", "CommitLog-7-1.log", mutations(1))
    plan(spark, tmp_path, [], **{"snapshot.mode": "never"}).run(f"{tmp_path}/state")
    left = [f for _, _, fs in os.walk(tmp_path) for f in fs if f.startswith("CommitLog")]
    assert left == []


def test_failed_segments_are_reprocessed(spark, tmp_path):
    log_source.write_segment(f"{tmp_path}/cdc", "CommitLog-7-1.log", mutations(2))
    out, fail = [], [True]

    def write(e, s):
        if fail[0]:
            raise RuntimeError("sink")
        out.extend(e.collect())

    more = {"snapshot.mode": "never", "commit.log.post.processing.enabled": False, "commit.log.error.reprocessing.enabled": True}
    p = plan(spark, tmp_path, out, write, Kept(), **more)
    p.run(f"{tmp_path}/state")
    assert out == [] and os.path.exists(f"{tmp_path}/moved/error/CommitLog-7-1.log")
    fail[0] = False
    p.run(f"{tmp_path}/state")
    assert len(out) == 2 and os.path.exists(f"{tmp_path}/moved/archive/CommitLog-7-1.log") and p.capture.reprocessing == set()


def test_latest_segment_only(spark, tmp_path):
    for i in (1, 2):
        log_source.write_segment(f"{tmp_path}/cdc", f"CommitLog-7-{i}.log", mutations(i))
        os.utime(f"{tmp_path}/cdc/CommitLog-7-{i}.log", (i * 1000, i * 1000))
    out = []
    plan(spark, tmp_path, out, **{"snapshot.mode": "never", "latest.commit.log.only": True, "num.of.change.event.queues": 2}).run(f"{tmp_path}/state")
    assert len(out) == 2


def test_configuration_is_checked_first(spark, tmp_path):
    with pytest.raises(ValueError, match="snapshot.mode"):
        plan(spark, tmp_path, [], **{"snapshot.mode": "sometimes"})
    with pytest.raises(ValueError, match="does not have"):
        plan(spark, tmp_path, [], **{"field.exclude.list": "ks.t1.nope"})


class Noted:
    """A transfer made from the configuration."""

    made = []

    def __init__(self, spark, settings):
        self.settings, self.good = settings, []
        Noted.made.append(self)

    def on_success(self, path):
        self.good.append(os.path.basename(path))

    on_error = on_success

    def error_files(self):
        return []


def wait(seconds, done):
    end = time.time() + seconds
    while time.time() < end and not done():
        time.sleep(0.1)
    assert done()


def get(port, page):
    try:
        with urllib.request.urlopen(f"http://127.0.0.1:{port}{page}") as r:
            return r.status, r.read().decode()
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode()


def test_excluded_columns_leave_snapshots_and_the_log_alike(spark, tmp_path):
    log_source.write_segment(f"{tmp_path}/cdc", "CommitLog-7-1.log", mutations(3))
    out = []
    write = lambda e, s: out.extend((r["value"]["source"]["snapshot"], r["value"]["after"]["b"]) for r in e.collect())
    plan(spark, tmp_path, out, write, **{"field.exclude.list": "ks.t1.b"}).run(f"{tmp_path}/state")
    assert sorted(out, key=str) == [("false", None)] * 3 + [("true", None)] * 2


def test_a_capture_runs_until_it_is_stopped(spark, tmp_path):
    """Snapshots, a segment that grows, a table that is created meanwhile, archiving, endpoints."""
    folder, out = f"{tmp_path}/cdc", []
    log_source.write_segment(folder, "CommitLog-7-1.log", mutations(2), completed=False)
    tables = [T1]
    more = {"commit.log.real.time.processing.enabled": True, "cdc.dir.poll.interval.ms": 200, "commit.log.marked.complete.poll.interval.ms": 200, "snapshot.scan.interval.ms": 200, "schema.refresh.interval.ms": 1, "commit.log.relocation.dir.poll.interval.ms": 200, "snapshot.mode": "always"}
    given = {"offset.backing.store.dir": f"file://{tmp_path}/offsets", "commit.log.relocation.dir": f"{tmp_path}/moved", **more}
    read = lambda s: spark.range(2).select(F.col("id").cast("int").alias("a"), F.lit("s").alias("b"))
    write = lambda e, s: out.extend((s.name, r["op"], r["value"]["source"]["snapshot"]) for r in e.collect())
    p = CapturePlan(spark, Config.of(given), SchemaRegistry([]), folder, read, write, schema=lambda: tables)
    going = p.start(f"{tmp_path}/state", port=0)
    try:
        logged = lambda: sum(x == ("ks.t1", "i", "false") for x in out)
        wait(60, lambda: logged() == 2 and ("ks.t1", "i", "true") in out)
        assert os.path.exists(f"{folder}/CommitLog-7-1.log") and p.ddl == [("CREATED", "ks.t1")]
        tables.append(T2)
        log_source.write_segment(folder, "CommitLog-7-1.log", mutations(5))
        wait(60, lambda: logged() == 5 and not os.path.exists(f"{folder}/CommitLog-7-1.log") and ("ks.t2", "i", "true") in out)
        wait(30, lambda: not os.path.exists(f"{tmp_path}/moved/archive/CommitLog-7-1.log"))
        port = going.endpoints.port
        assert get(port, "/ping") == (200, "pong") and get(port, "/nothing")[0] == 404 and json.loads(get(port, "/buildinfo")[1])["name"] == "tidemark"
        seen = json.loads(get(port, "/metrics")[1])
        assert seen["mutations_processed"] == 5 and seen["events"] == {"ks.t1": 5} and seen["tables_total"] == 2 and seen["rows_scanned"]["ks.t1"] >= 2
        assert get(port, "/health")[0] == 200 and json.loads(get(port, "/health")[1])["healthy"]
        going.query.stop()
        assert get(port, "/health")[0] == 500
    finally:
        going.stop()
    assert not going.query.isActive


def test_keys_reach_what_they_configure(spark, tmp_path):
    log_source.write_segment(f"{tmp_path}/cdc", "CommitLog-7-1.log", mutations(2))
    out = []
    more = {"snapshot.mode": "never", "tracing.enabled": True, "commit.log.transfer.class": "test_capture_plan.Noted", "commit.log.transfer.bucket": "x", "offset.flush.interval.ms": 60_000, "max.offset.flush.size": 3, "num.of.change.event.queues": 2, "key.converter": "a.b.JsonConverter"}
    p = plan(spark, tmp_path, out, lambda e, s: out.extend(e.collect()), **more)
    p.run(f"{tmp_path}/state")
    assert Noted.made[-1].settings["bucket"] == "x" and Noted.made[-1].good == ["CommitLog-7-1.log"]
    header = out[0]["headers"][0]
    assert header["key"] == "traceparent" and bytes(header["value"]).decode().count("-") == 3 and out[0]["queue"] in (0, 1)
    assert len({bytes(r["headers"][0]["value"]) for r in out}) == 2
    assert p.capture.flush.max_records == 3 and p.store.load().count() == 1  # flushed when the run ends
    with pytest.raises(ValueError, match="no such class"):
        plan(spark, tmp_path, out, **{"commit.log.transfer.class": "no.such.Class"})
    with pytest.raises(ValueError, match="unknown converter"):
        plan(spark, tmp_path, out, **{"value.converter": "x.Unknown"})
    with pytest.raises(ValueError, match="max.queue.size must be positive"):
        plan(spark, tmp_path, out, **{"max.queue.size": 0})
    with pytest.warns(UserWarning, match="snapshot.consistency has no effect"):
        plan(spark, tmp_path, out, **{"snapshot.consistency": "ALL"})
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        plan(spark, tmp_path, out, **{"snapshot.consistency": "QUORUM"})


def test_offsets_wait_for_the_flush_policy(spark, tmp_path):
    from tidemark.operators import offsets as O
    from tidemark.streaming.pipeline import Capture
    from test_snapshot_and_streams import batch

    now, out = [0.0], []
    store = O.OffsetStore(spark, f"file://{tmp_path}/o")
    c = Capture(spark, SchemaRegistry([T1]), store, lambda df, s: out.extend(df.collect()), flush=O.FlushPolicy(1000, 5, clock=lambda: now[0]))
    c.batch(batch(spark, "CommitLog-7-1.log", 3))
    assert store.load().count() == 0 and len(out) == 3
    c.batch(batch(spark, "CommitLog-7-1.log", 3))
    assert len(out) == 3  # marked, if not persisted yet
    c.batch(batch(spark, "CommitLog-7-2.log", 3))
    c.batch(batch(spark, "CommitLog-7-3.log", 3))
    assert [tuple(r)[2:] for r in store.load().collect()] == [("CommitLog-7-3.log", 2)]  # more than five
    c.batch(batch(spark, "CommitLog-7-4.log", 1))
    c.flush_offsets()
    assert [tuple(r)[2:] for r in store.load().collect()] == [("CommitLog-7-4.log", 0)] and len(store.versions()) <= 2


def test_backlogs_are_taken_in_bounded_batches(spark, tmp_path):
    for i in range(3):
        log_source.write_segment(f"{tmp_path}/cdc", f"CommitLog-7-{i}.log", mutations(30))
    sizes = []
    p = plan(spark, tmp_path, [], lambda e, s: sizes.append(e.count()), **{"snapshot.mode": "never", "max.queue.size": 5})
    p.run(f"{tmp_path}/state")
    assert sum(sizes) == 90 and len(sizes) > 3 and max(sizes) < 30


def test_registry_refresh_tells_what_changed():
    from tidemark.spec import ColumnSpec

    r = SchemaRegistry([T1])
    altered = T1.with_column(ColumnSpec("c", "int"))
    assert r.refresh([T1, T2]) == [("CREATED", "ks.t2")] and r.refresh([altered]) == [("ALTERED", "ks.t1"), ("DROPPED", "ks.t2")]
    assert r.refresh([altered]) == [] and r.get("ks.t1") == altered
