"""Binary segments: every part of the format, damage, and the way to events."""

import json
import struct
import uuid

import pytest
from hypothesis import given
from hypothesis import strategies as st

import segments as S
from logs import spec
from tidemark.functions.types import TypeSystem
from tidemark.operators import events as E
from tidemark.sources import binary as B
from tidemark.spec import SchemaRegistry

ONE, TWO, WIDE, OTHER = (str(uuid.UUID(int=i)) for i in (1, 2, 3, 99))
AT = 1_700_000_000_000_000
T1 = spec("ks", "t1", ["a:int"], ["c:text", "d:int"], ["b:text", "n:int", "l:list<int>", "m:map<text,int>", "s:set<text>"])
T2 = spec("ks", "t2", ["p:text", "q:int"], (), ["v:bigint"])
T3 = spec("ks", "t3", ["a:int"], (), [f"c{i:02}:int" for i in range(70)])
TABLES = {ONE: T1, TWO: T2, WIDE: T3}
i4 = lambda n: struct.pack(">i", n)
key = lambda c, d: [(c.encode(), False), (i4(d), True)]
BASE = (AT - 1000, S.DELETION + 100, 7)


@given(st.integers(0, 2**64 - 1))
def test_vints(n):
    c = B.Cursor(S.vint(n) + b"x")
    assert c.vint() == n and c.take(1) == b"x"


def decoded(*updates):
    return B.Decoder(TABLES).mutation(5, S.mutation(*updates))


def test_rows_cells_and_collections():
    full = S.row([
        S.cell(b"text"), S.cell(i4(7), True, at=AT + 5, base=BASE), S.vint(2) + S.cell(i4(1), path=b"p1") + S.cell(i4(2), path=b"p2"), S.vint(1) + S.cell(i4(9), path=b"k"), S.vint(2) + S.cell(path=b"x") + S.cell(path=b"y"),
    ], 5, key("ck", 3), at=AT, base=BASE)
    partial = S.row([S.cell(deleted=S.DELETION + 200, base=BASE, at=AT + 1), S.cell(i4(8), True, expires=S.DELETION + 300, at=AT + 2, base=BASE)], 5, key("", 4), present=[0, 1], base=BASE)
    gone = S.row([], 5, key("z", 5), present=[], deleted_at=AT + 3, base=BASE)
    cleared = S.row([S.deletion(AT + 4, BASE) + S.vint(0)], 5, key("y", 6), present=[2], complex_deletion=True, base=BASE)
    found = decoded(S.update(ONE, i4(1), ["b", "n", "l", "m", "s"], [full, partial, gone, cleared], base=BASE))
    (u,) = found["updates"]
    assert (found["pos"], found["keyspace"], found["tracked_by_cdc"], u["table"], u["partition_key"]) == (5, "ks", True, "t1", {"a": "1"})
    a, b, c, d = u["rows"]
    assert (a["liveness_ts"], a["written_at"], a["clustering"]) == (AT, AT + 5, {"c": "ck", "d": "3"})
    assert {k: v["value"] for k, v in a["cells"].items()} == {"b": "text", "n": "7", "l": "[1, 2]", "m": '{"k": 9}', "s": '["x", "y"]'}
    assert b["liveness_ts"] is None and b["clustering"] == {"c": "", "d": "4"} and b["cells"]["b"]["tombstone"]
    assert b["cells"]["n"] == {"value": "8", "tombstone": False, "expires_at": S.DELETION + 300} and set(b["cells"]) == {"b", "n"}
    assert c["deleted_at"] == AT + 3 and c["cells"] == {} and d["cells"]["l"]["tombstone"]
    assert [r["seq"] for r in u["rows"]] == [0, 1, 2, 3]


def test_row_ttl_static_rows_and_partition_deletions():
    plain = S.row([b"\x18" + S.sized(b"v")], 5, key("k", 1), at=AT, ttl=S.DELETION + 400, present=[0], base=BASE)  # row's timestamp and time to live
    plain = plain[: -len(b"\x18" + S.sized(b"v"))] + b"\x1a" + S.sized(b"v")
    static = S.row([S.cell(b"st")], 1, at=AT, static=True, base=BASE)
    u = decoded(S.update(ONE, i4(2), ["b", "n", "l", "m", "s"], [plain], base=BASE, deleted_at=AT + 9, statics=["b"], static_row=static))["updates"][0]
    assert u["partition_deleted_at"] == AT + 9 and [r["cells"] for r in u["rows"]] == [{"b": {"value": "v", "tombstone": False, "expires_at": S.DELETION + 400}}]


def test_composite_keys_unknown_tables_and_wide_tables():
    composite = struct.pack(">H", 2) + b"pk" + b"\0" + struct.pack(">H", 4) + i4(6) + b"\0"
    known = S.update(TWO, composite, ["v"], [S.row([S.cell(struct.pack(">q", -3), True)], 1, at=AT, base=BASE)], base=BASE)
    found = decoded(known, S.update(OTHER, i4(1), ["x"], []), known)
    assert len(found["updates"]) == 1 and found["updates"][0]["partition_key"] == {"p": "pk", "q": "6"} and found["updates"][0]["rows"][0]["cells"]["v"]["value"] == "-3"
    names = [f"c{i:02}" for i in range(70)]
    for present in ([0, 69], [i for i in range(70) if i != 33], []):
        u = decoded(S.update(WIDE, i4(1), names, [S.row([S.cell(i4(i), True) for i in present], 70, at=AT, base=BASE, present=present)], base=BASE))["updates"][0]
        assert {k: v["value"] for k, v in u["rows"][0]["cells"].items()} == {f"c{i:02}": str(i) for i in present}
    with pytest.raises(B.Damaged, match="older than the segment"):
        decoded(S.update(WIDE, i4(1), ["new"], []))


def test_markers():
    open_, close = S.marker(1, key("a", 1)[:1], AT, base=BASE), S.marker(0, key("b", 2), AT, base=BASE)
    both = S.marker(5, key("c", 3), AT + 1, AT + 2, base=BASE)
    rows = decoded(S.update(ONE, i4(1), [], [open_, both, close], base=BASE))["updates"][0]["rows"]
    assert [(r["kind"], r["deleted_at"]) for r in rows] == [("RANGE_OPEN", AT), ("RANGE_BOUNDARY", AT + 2), ("RANGE_CLOSE", AT)]
    assert rows[0]["open_bound"] == {"method": "INCL_START_BOUND", "values": [{"name": "c", "value": "a", "type": "UTF8Type"}]}
    assert rows[1]["close_bound"]["method"] == "INCL_END_BOUND" and rows[1]["open_bound"]["method"] == "EXCL_START_BOUND" and rows[2]["close_bound"]["values"][1] == {"name": "d", "value": "2", "type": "Int32Type"}


@pytest.mark.parametrize(("cql", "raw", "text"), [
    ("boolean", b"\1", "true"), ("smallint", b"\xff\xfe", "-2"), ("varint", bytes([1]) + bytes(20), str(256**20)), ("decimal", i4(2) + b"\x01\x00", "256E-2"), ("decimal", i4(0) + b"\x05", "5"), ("double", struct.pack(">d", 1.5), "1.5"),
    ("uuid", uuid.UUID(int=7).bytes, str(uuid.UUID(int=7))), ("inet", bytes([10, 0, 0, 1]), "10.0.0.1"), ("blob", b"\x0a\xff", "0AFF"), ("duration", S.vint(2) + S.vint(4) + S.vint(5), '{"months": 1, "days": 2, "nanos": -3}'),
    ("frozen<list<int>>", i4(2) + i4(4) + i4(7) + i4(-1), "[7, null]"), ("frozen<map<text,int>>", i4(1) + i4(1) + b"k" + i4(4) + i4(3), '{"k": 3}'), ("tuple<int,text>", i4(4) + i4(9) + i4(1) + b"x", '{"field1": 9, "field2": "x"}'),
    ("date", struct.pack(">I", 2**31 + 17946), str(17946 - 2**31)), ("int", b"", None), ("text", b"", ""), ("text", None, None),
])
def test_values(cql, raw, text):
    assert B.as_text(cql, B.value(cql, raw)) == text


def one(n, at=AT):
    return S.mutation(S.update(ONE, i4(n), ["b", "n", "l", "m", "s"], [S.row([S.cell(f"v{n}".encode())], 5, key("k", n), at=at, present=[0], base=BASE)], base=BASE))


def write(tmp_path, name, data):
    (tmp_path / name).write_bytes(data)
    return str(tmp_path)


def test_from_segment_to_events(spark, tmp_path):
    write(tmp_path, "CommitLog-7-1.log", S.segment([[one(1), S.mutation(S.update(OTHER, i4(0), [], []))], [one(2), one(3)]], tail=b"rubbish that is not synced"))
    folder = write(tmp_path, "CommitLog-7-2.log", S.segment([[one(4)]], version=6))
    log = B.read_binary(spark, f"{folder}/*.log", B.Decoder(TABLES))
    assert log.filter("broken IS NOT NULL").count() == 0 and sorted(r["file"] for r in log.filter("eof").collect()) == ["CommitLog-7-1.log", "CommitLog-7-2.log"]
    rows = E.with_row(E.changes(log, SchemaRegistry([T1]).frame(spark)), T1, TypeSystem()).collect()
    assert sorted((r["file"], r["op"], r["key"]["a"], r["key"]["c"], r["key"]["d"], r["after"]["b"]["value"], r["event_ts"]) for r in rows) == [(f"CommitLog-7-{1 + (i == 4)}.log", "i", i, "k", i, f"v{i}", AT) for i in range(1, 5)]
    place = sorted(r["pos"] for r in rows if r["file"] == "CommitLog-7-1.log")
    data = (tmp_path / "CommitLog-7-1.log").read_bytes()
    assert [p for p, _ in B.entries(data)][0] == place[0] and place == sorted(set(place))


def test_damage_is_told_and_what_comes_before_it_is_kept(spark, tmp_path):
    data = bytearray(S.segment([[one(1), one(2)], [one(3)]]))
    second = [p for p, _ in B.entries(bytes(data))][1]
    data[second - 6] ^= 1  # inside the second mutation
    folder = write(tmp_path, "CommitLog-7-1.log", bytes(data))
    got = B.read_binary(spark, folder, B.Decoder(TABLES)).collect()
    assert sum(r["pos"] is not None for r in got) == 1 and [r["broken"] for r in got if r["broken"]][0].startswith("not read after") and sum(r["eof"] for r in got) == 1
    for bad, why in ((S.segment([], version=8), "version 8"), (S.segment([], parameters={"compressionClass": "LZ4Compressor"}), "compressed"), (b"short", "expected"), (S.segment([])[:6] + b"x" + S.segment([])[7:], "checksum")):
        with pytest.raises(B.Damaged, match=why):
            list(B.entries(bad))
    assert list(B.entries(S.segment([]))) == [] and json.loads("{}") == {}


def test_a_capture_of_binary_segments(spark, tmp_path):
    """In real time up to what the index says is synced, then to the end; then archived and deleted."""
    from tidemark.config import Config
    from tidemark.plans.capture import CapturePlan
    from tidemark.streaming import log_source as LS

    folder, out = f"{tmp_path}/cdc", []
    (tmp_path / "cdc").mkdir()
    data = S.segment([[one(1), one(2)], [one(3)], [one(4)]])
    cuts = [c for c in range(len(data)) if c == 0 or data[c - 4 : c] == bytes(4)]  # ends of sections among others
    first = next(c for c in cuts if c > [p for p, _ in B.entries(data)][1])
    write(tmp_path / "cdc", "CommitLog-7-1.log", data)
    LS.write_index(folder, "CommitLog-7-1.log", first, False)
    given = {"offset.backing.store.dir": f"file://{tmp_path}/o", "commit.log.relocation.dir": f"{tmp_path}/moved", "snapshot.mode": "never", "commit.log.real.time.processing.enabled": True}
    assert B.Decoder.from_json(B.Decoder(TABLES, {"u": [("a", "int")]}).to_json()).tables == B.Decoder(TABLES).tables
    p = CapturePlan(spark, Config.of(given), SchemaRegistry([T1]), folder, lambda s: None, lambda e, s: out.extend(r["key"]["a"] for r in e.collect()), decoder=B.Decoder(TABLES))
    p.run(f"{tmp_path}/s")
    assert out == [1, 2] and (tmp_path / "cdc/CommitLog-7-1.log").exists()
    LS.write_index(folder, "CommitLog-7-1.log", len(data), True)
    p.run(f"{tmp_path}/s")
    assert out == [1, 2, 3, 4] and p.capture.results == {"CommitLog-7-1.log": "OK"} and not (tmp_path / "cdc/CommitLog-7-1.log").exists()
