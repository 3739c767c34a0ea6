import pytest
from pyspark.sql import functions as F

from tidemark.functions import position as P
from tidemark.operators import offsets as O

NAME = "test_keyspace.test_table"


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_marks_never_regress(spark, tmp_path):
    store = O.OffsetStore(spark, f"file://{tmp_path}/offsets")
    assert store.load().count() == 0
    store.commit(O.offsets_frame(spark, [(NAME, O.SNAPSHOT, "", -1), (NAME, O.LOG, "CommitLog-6-12345.log", 100)]))
    store.commit(O.offsets_frame(spark, [(NAME, O.LOG, "CommitLog-6-12344.log", 101)]))
    found = {r["kind"]: (r["file"], r["pos"]) for r in store.load().collect()}
    assert found == {O.SNAPSHOT: ("", -1), O.LOG: ("CommitLog-6-12345.log", 100)}


@pytest.mark.parametrize(("table", "file", "pos", "new"), [
    ("test_table", "CommitLog-6-12345.log", 100, False), ("test_table", "CommitLog-6-12345.log", 101, True), ("test_table", "CommitLog-6-12344.log", 101, False),
    ("test_table", "CommitLog-6-99999.log", 1, True), ("test_table", "CommitLog-6-100000.log", 1, True), ("other", "CommitLog-6-12345.log", 100, True),
])
def test_already_processed(spark, table, file, pos, new):
    u = spark.createDataFrame([("test_keyspace", table, file, pos)], "keyspace string, table string, file string, pos int")
    assert O.unprocessed(u, O.offsets_frame(spark, [(NAME, O.LOG, "CommitLog-6-12345.log", 100)])).count() == int(new)


def test_flush_policy():
    now = [0.0]
    assert all(O.FlushPolicy(0, 3).should_flush() for _ in range(3))
    by_count = O.FlushPolicy(10_000, 3, lambda: now[0])
    assert [by_count.should_flush() for _ in range(5)] == [False, False, False, True, False]
    now[0] = 11
    assert by_count.should_flush()


def test_names(spark):
    assert value(spark, P.is_segment(F.lit("CommitLog-6-12.log"))) and not value(spark, P.is_segment(F.lit("Not-CommitLog-6-12.log")))
    assert value(spark, P.segment_id(F.lit("/x/CommitLog-7-42_cdc.idx"))) == 42 and value(spark, P.segment_id(F.lit(""))) == -1 and value(spark, P.segment_id(F.lit("x"))) is None
    assert value(spark, P.index_to_segment(F.lit("CommitLog-7-42_cdc.idx"))) == "CommitLog-7-42.log"
    assert [P.compare_segments("CommitLog-6-1.log", f"CommitLog-7-{n}.log") for n in (2, 0, 1, 10)] == [-1, 1, 0, -1]


def test_position_text(spark):
    assert value(spark, P.serialise(F.lit("f.log"), F.lit(5))) == "f.log:5"
    assert tuple(value(spark, P.parse_position(F.lit("f.log:5")))) == ("f.log", 5)
    with pytest.raises(Exception, match="not a position"):
        value(spark, P.parse_position(F.lit("f.log:5:6")))


@pytest.mark.parametrize(("text", "synced", "done"), [("100\nCOMPLETED\n", 100, True), ("100", 100, False), ("100\nCOMPLETED\nmore", 100, False), ("100\nOTHER", 100, False)])
def test_index_text(spark, text, synced, done):
    assert tuple(value(spark, P.parse_index(F.lit(text)))) == (synced, done)
