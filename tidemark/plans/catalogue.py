"""The query catalogue: one query per operator over the driver's tables, flat columns only, each with its SQL.

The SQL is written against the tables directly, not against the log, so that it
checks the log, the engine and the flattening together.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import position as P
from ..functions.types import TypeSystem, bytes_to_uuid, composite_key, dedup_entries, uuid_to_bytes
from ..operators import classify as C
from ..operators import events as E
from ..operators import metrics as M
from ..operators import offsets as O
from ..sources import mutation_log as L
from ..sources import snapshot as S
from ..spec import local_frame
from . import driver_log as D

EXEC_MS = 1_700_000_000_000
PREFIX, CLUSTER = "cdc", "cluster1"
MARK = ("app.user_events", O.LOG, "CommitLog-7-20240115.log", 5)
TYPES = TypeSystem()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str = ""):
    def add(f):
        QUERIES[name or f.__name__] = f
        if sql:
            SQL[name or f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# The log in SQL: one row per event with what the mutation log says of it.
EV = """
WITH e AS (SELECT event_id, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, epoch_us(ts) AS us,
                  event_id // 3 AS mid, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS day FROM events),
s AS (SELECT *, min(day) OVER (PARTITION BY mid) AS seg FROM e),
p AS (SELECT *, CAST(dense_rank() OVER (PARTITION BY seg ORDER BY mid) AS INTEGER) AS pos, 'CommitLog-7-' || seg || '.log' AS file, mid % 11 <> 0 AS tracked,
        CASE user_id % 10 WHEN 7 THEN 'user_counts' WHEN 8 THEN 'user_view' WHEN 9 THEN 'user_idx' ELSE 'user_events' END AS tbl,
        CASE WHEN event_type = 'signup' THEN 'INSERT' WHEN event_type = 'purchase' THEN 'UPDATE_TTL' WHEN event_type <> 'error' THEN 'UPDATE'
             WHEN k % 7 = 0 THEN 'PARTITION_DELETE' WHEN k % 5 = 0 THEN 'RANGE' ELSE 'ROW_DELETE' END AS kind FROM s),
ev AS (SELECT *, max(us) OVER (PARTITION BY mid, tbl, user_id) AS update_ts,
        max(CASE WHEN kind = 'PARTITION_DELETE' THEN us END) OVER (PARTITION BY mid, tbl, user_id) AS pd FROM p),
good AS (SELECT * FROM ev WHERE tracked AND tbl = 'user_events'),
rows_ AS (SELECT file, seg, pos, user_id, k, event_id * 2 AS seq, CASE kind WHEN 'INSERT' THEN 'i' WHEN 'ROW_DELETE' THEN 'd' ELSE 'u' END AS op,
        CASE WHEN kind = 'ROW_DELETE' THEN us ELSE update_ts END AS event_ts, kind, event_type, value, us FROM good WHERE kind NOT IN ('PARTITION_DELETE', 'RANGE')),
parts AS (SELECT DISTINCT file, seg, pos, user_id, CAST(NULL AS INTEGER) AS k, CAST(-1 AS BIGINT) AS seq, 'd' AS op, pd AS event_ts, 'PARTITION_DELETE' AS kind, pd AS us
        FROM good WHERE pd IS NOT NULL),
ranges AS (SELECT file, seg, pos, user_id, k, event_id * 2 + 1 AS seq, 'r' AS op, us AS event_ts, kind, us FROM good WHERE kind = 'RANGE'),
change AS (SELECT file, seg, pos, user_id, k, seq, op, event_ts, kind FROM rows_ UNION ALL SELECT file, seg, pos, user_id, k, seq, op, event_ts, kind FROM parts
        UNION ALL SELECT file, seg, pos, user_id, CAST(NULL AS INTEGER), seq, op, event_ts, kind FROM ranges)
"""


def _changes(spark: SparkSession, d: str, keep=None) -> DataFrame:
    return E.changes(D.driver_log(spark, d), D.registry().frame(spark), keep)


def _rows(spark: SparkSession, d: str, **more) -> DataFrame:
    return E.with_row(_changes(spark, d), D.USER_EVENTS, TYPES, **more)


def _flat(df: DataFrame, *more: Column | str) -> DataFrame:
    return df.select("file", F.col("pos").cast("int").alias("pos"), F.col("partition_key")["user_id"].cast("long").alias("user_id"), "seq", "op", *more)


def _cell(name: str, part: str = "value") -> Column:
    return F.col(f"after.{name}.{part}")


# --- Snapshots -----------------------------------------------------------------------------------------------------------


def _snapshot(spec, cols: list[str]):
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = S.snapshot(table(spark, d, spec.table), spec, TYPES, EXEC_MS)
        out = E.envelope(rows.withColumn("partition_key", F.lit(None)), spec, PREFIX, E.source_block(CLUSTER, True), EXEC_MS)
        return out.select(
            "topic", "op", "keyspace", F.col("table").alias("table_name"), *[F.col(f"key.{c.name}").alias(f"key_{c.name}") for c in spec.primary_key],
            *[F.col(f"value.after.{c}.value").alias(f"after_{c}") for c in cols], F.col("value.source.snapshot").alias("snapshot"), F.col("value.source.file").alias("file"), F.col("value.source.pos").alias("pos"), F.col("value.ts_ms").alias("ts_ms"),
        )

    return run


for _spec, _cols in ((D.ORDERS, ["o_totalprice", "o_custkey"]), (D.CUSTOMER, ["c_name", "c_acctbal"]), (D.LINEITEM, ["l_quantity", "l_extendedprice", "l_returnflag"])):
    QUERIES[f"snapshot_{_spec.table}"] = _snapshot(_spec, _cols)
    SQL[f"snapshot_{_spec.table}"] = (
        f"SELECT 'cdc.shop.{_spec.table}' AS topic, 'i' AS op, 'shop' AS keyspace, '{_spec.table}' AS table_name, "
        + ", ".join(f"{c.name} AS key_{c.name}" for c in _spec.primary_key) + ", " + ", ".join(f"{c} AS after_{c}" for c in _cols)
        + f", 'true' AS snapshot, '' AS file, -1 AS pos, {EXEC_MS} AS ts_ms FROM {_spec.table}"
    )


@query(f"""SELECT event_id, CASE WHEN event_type = 'purchase' THEN {EXEC_MS} * 1000 + CAST(json_extract_string(props, '$.k') AS BIGINT) * 1000000 END AS value_deletion_ts, TRUE AS value_set FROM events""")
def snapshot_ttl_deletion_ts(spark, d):
    spec = D.TableSpec("app", "raw", (D.ColumnSpec("event_id", "bigint", D.PARTITION), D.ColumnSpec("value", "double")))
    ttl = F.when(F.col("event_type") == "purchase", F.get_json_object("props", "$.k").cast("int"))
    rows = S.snapshot(table(spark, d, "events").withColumn("value_ttl", ttl), spec, TYPES, EXEC_MS)
    return rows.select(_cell("event_id").alias("event_id"), _cell("value", "deletion_ts").alias("value_deletion_ts"), _cell("value", "set").alias("value_set"))


# Tables of a store, one per nation: every third is off, those of one region are virtual; some have been read, some are being read.
_STORE = "SELECT 'app.t' || n_nationkey AS name, n_nationkey % 3 <> 0 AS cdc, n_regionkey = 3 AS virtual, n_nationkey % 4 = 1 AS done, n_nationkey % 5 = 2 AS started FROM nation"


def _store(spark, d) -> tuple[D.SchemaRegistry, DataFrame]:
    nations = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    specs = [D.TableSpec("app", f"t{r['n_nationkey']}", (), r["n_nationkey"] % 3 != 0, r["n_regionkey"] == 3) for r in nations.collect()]  # a catalogue's size
    return D.SchemaRegistry(specs), nations.select(F.concat(F.lit("app.t"), F.col("n_nationkey").cast("string")).alias("name"), "n_nationkey")


def _pending(spark, d) -> tuple[DataFrame, DataFrame]:
    reg, names = _store(spark, d)
    tables = local_frame(spark, [(s.name,) for s in reg.tables()], "name string")
    done = names.filter("n_nationkey % 4 = 1").select("name", F.lit(O.SNAPSHOT).alias("kind"), F.lit("").alias("file"), F.lit(-1).alias("pos"))
    return tables, O.pending_snapshots(tables, done.unionByName(O.offsets_frame(spark, [MARK])), names.filter("n_nationkey % 5 = 2").select("name"))


@query(f"SELECT name FROM ({_STORE}) WHERE cdc AND NOT virtual AND NOT done AND NOT started")
def snapshot_pending_tables(spark, d):
    return _pending(spark, d)[1]


@query(f"SELECT name FROM ({_STORE}) WHERE cdc AND NOT virtual")
def cdc_tables(spark, d):
    return _store(spark, d)[0].frame(spark).select(F.concat_ws(".", "keyspace", "table").alias("name"))


# --- The log -------------------------------------------------------------------------------------------------------------


@query(EV + "SELECT file, pos, count(DISTINCT (tbl, user_id)) AS n_updates FROM ev WHERE tracked GROUP BY file, pos")
def log_tracked(spark, d):
    return C.tracked(D.driver_log(spark, d)).select("file", "pos", F.size("updates").cast("long").alias("n_updates"))


def _typed_updates(spark, d):
    u = L.updates(D.driver_log(spark, d))
    kind = C.partition_type(F.col("is_counter"), F.col("is_view"), F.col("is_index"), F.col("partition_deleted_at"), F.lit(True))
    return u.withColumn("partition_type", kind)


_PTYPE = "CASE tbl WHEN 'user_counts' THEN 'COUNTER' WHEN 'user_view' THEN 'VIEW' WHEN 'user_idx' THEN 'INDEX' ELSE CASE WHEN pd IS NOT NULL THEN 'DELETE_WITH_CLUSTERING' ELSE 'ROW_LEVEL' END END"


@query(EV + f"SELECT {_PTYPE} AS partition_type, count(*) AS n FROM (SELECT DISTINCT mid, tbl, user_id, pd FROM ev) GROUP BY 1")
def log_partition_types(spark, d):
    return _typed_updates(spark, d).groupBy("partition_type").agg(F.count("*").alias("n"))


@query(EV + "SELECT CASE kind WHEN 'RANGE' THEN 'RANGE' WHEN 'ROW_DELETE' THEN 'DELETE' WHEN 'INSERT' THEN 'INSERT' ELSE 'UPDATE' END AS row_type, CAST(sum(CASE WHEN kind = 'RANGE' THEN 2 ELSE 1 END) AS BIGINT) AS n FROM ev WHERE kind <> 'PARTITION_DELETE' GROUP BY 1")
def log_row_types(spark, d):
    rows = L.updates(D.driver_log(spark, d)).select(F.explode("rows").alias("r"))
    return rows.select(C.row_type(F.col("r.kind"), F.col("r.deleted_at"), F.col("r.liveness_ts")).alias("row_type")).groupBy("row_type").agg(F.count("*").alias("n"))


@query(EV + "SELECT DISTINCT file, pos, tbl AS table_name, user_id FROM ev WHERE tbl = 'user_events'")
def log_supported_only(spark, d):
    return C.supported(_typed_updates(spark, d)).select("file", "pos", F.col("table").alias("table_name"), F.col("partition_key")["user_id"].cast("long").alias("user_id"))


@query(EV + "SELECT tbl AS table_name, count(*) AS n FROM (SELECT DISTINCT mid, tbl, user_id FROM ev WHERE tbl = 'user_events') GROUP BY 1")
def log_known_schema(spark, d):
    u = L.updates(D.driver_log(spark, d)).join(D.registry().frame(spark), ["keyspace", "table"])
    return u.groupBy(F.col("table").alias("table_name")).agg(F.count("*").alias("n"))


def _after_mark(spark):
    return lambda u: O.unprocessed(u, O.offsets_frame(spark, [MARK]))


_BEYOND = "(seg > 20240115 OR (seg = 20240115 AND pos > 5))"


@query(EV + f"SELECT file, pos, user_id, seq, op FROM change WHERE {_BEYOND}")
def log_offset_filter(spark, d):
    return _flat(_changes(spark, d, _after_mark(spark)))


@query(EV + f"SELECT file, pos, user_id, seq, op FROM change WHERE {_BEYOND} OR seg = 20240103")
def log_offset_bypass(spark, d):
    log = D.driver_log(spark, d)
    error = F.col("file") == "CommitLog-7-20240103.log"
    both = L.with_error_segments(log.filter(~error), log.filter(error))
    return _flat(E.changes(both, D.registry().frame(spark), _after_mark(spark)))


def _iud() -> tuple[Column, ...]:
    return (_cell("k").alias("k"), _cell("event_type").alias("event_type"), _cell("value").alias("value"), _cell("value", "deletion_ts").alias("value_deletion_ts"))


@query(EV + "SELECT file, pos, user_id, seq, op, k, event_type, value, CAST(NULL AS BIGINT) AS value_deletion_ts FROM rows_ WHERE op = 'i'")
def log_inserts(spark, d):
    return _flat(_rows(spark, d).filter("op = 'i'"), *_iud())


@query(EV + """SELECT file, pos, user_id, seq, op, k, CASE WHEN event_type <> 'click' THEN event_type END AS event_type, CASE WHEN event_type <> 'view' THEN value END AS value,
    CASE WHEN kind = 'UPDATE_TTL' THEN (us // 1000000 + 3600) * 1000000 END AS value_deletion_ts FROM rows_ WHERE op = 'u'""")
def log_updates(spark, d):
    return _flat(_rows(spark, d).filter("op = 'u'"), *_iud())


@query(EV + "SELECT file, pos, user_id, seq, op, k, CAST(NULL AS VARCHAR) AS event_type, CAST(NULL AS DOUBLE) AS value, us AS value_deletion_ts FROM rows_ WHERE op = 'd'")
def log_deletes(spark, d):
    return _flat(_rows(spark, d).filter("op = 'd' AND NOT whole_partition"), *_iud())


@query(EV + "SELECT file, pos, user_id, seq, op, CAST(NULL AS INTEGER) AS key_k, event_ts, us AS k_deletion_ts, TRUE AS k_set, us AS value_deletion_ts FROM parts")
def log_partition_deletes(spark, d):
    rows = _rows(spark, d).filter("whole_partition")
    return _flat(rows, F.col("key.k").alias("key_k"), "event_ts", _cell("k", "deletion_ts").alias("k_deletion_ts"), _cell("k", "set").alias("k_set"), _cell("value", "deletion_ts").alias("value_deletion_ts"))


@query(EV + """SELECT file, pos, user_id, seq, op, event_ts, 'INCL_START_BOUND' AS start_method, '0' AS start_k, 'INCL_END_BOUND' AS end_method, CAST(k AS VARCHAR) AS end_k, 'k' AS end_name, 'Int32Type' AS end_type FROM ranges""")
def log_range_tombstones(spark, d):
    rows = _rows(spark, d).filter("op = 'r'")
    v = lambda side, part: F.col(f"after._range_{side}.values")[0][part]
    return _flat(rows, "event_ts", F.col("after._range_start.method").alias("start_method"), v("start", "value").alias("start_k"), F.col("after._range_end.method").alias("end_method"), v("end", "value").alias("end_k"), v("end", "name").alias("end_name"), v("end", "type").alias("end_type"))


@query(EV + "SELECT file, pos, user_id, seq, op, event_ts FROM change")
def log_event_time(spark, d):
    return _flat(_changes(spark, d), "event_ts")


@query(EV + """SELECT CASE WHEN event_type = 'click' THEN 'unset' ELSE 'value' END AS event_type_state, CASE WHEN event_type = 'view' THEN 'null' ELSE 'value' END AS value_state, count(*) AS n
    FROM rows_ WHERE op IN ('i', 'u') GROUP BY 1, 2""")
def log_unset_vs_null(spark, d):
    state = lambda c: F.when(F.col(f"after.{c}").isNull(), "unset").when(_cell(c).isNull(), "null").otherwise("value").alias(f"{c}_state")
    return _rows(spark, d).filter("op IN ('i', 'u')").groupBy(state("event_type"), state("value")).agg(F.count("*").alias("n"))


def _events(spark, d, **more) -> DataFrame:
    return E.envelope(_rows(spark, d, **more), D.USER_EVENTS, PREFIX, E.source_block(CLUSTER, False), EXEC_MS)


@query(EV + "SELECT file, pos, seq, op, t AS event_type, t = 'TOMBSTONE' AS no_value, t = 'CHANGE' AS mark_offset FROM change, (VALUES ('CHANGE'), ('TOMBSTONE')) v(t) WHERE t = 'CHANGE' OR op = 'd'")
def log_tombstones(spark, d):
    return E.fan_out_tombstones(_events(spark, d)).select("file", "pos", "seq", "op", "event_type", F.col("value").isNull().alias("no_value"), "mark_offset")


@query(EV + "SELECT file, pos, seq, op, user_id AS key_user_id, k AS key_k FROM change")
def log_keys(spark, d):
    return _rows(spark, d).select("file", "pos", "seq", "op", F.col("key.user_id").alias("key_user_id"), F.col("key.k").alias("key_k"))


@query(EV + """SELECT file, pos, user_id, seq, op, CASE WHEN op NOT IN ('i', 'u') THEN us END AS event_type_deletion_ts, op NOT IN ('i', 'u') AS event_type_set, CASE WHEN op IN ('i', 'u') AND event_type <> 'view' THEN value END AS value FROM rows_""")
def log_exclude_fields(spark, d):
    rows = _rows(spark, d, exclude=["event_type"]).filter("op IN ('i', 'u') OR (op = 'd' AND NOT whole_partition)")
    return _flat(rows, _cell("event_type", "deletion_ts").alias("event_type_deletion_ts"), F.col("after.event_type").isNotNull().alias("event_type_set"), _cell("value").alias("value"))


@query(EV + "SELECT 'cdc.app.user_events' AS topic, op, count(*) AS n FROM change GROUP BY op")
def log_topics(spark, d):
    return _events(spark, d).groupBy("topic", "op").agg(F.count("*").alias("n"))


@query(EV + "SELECT file, pos, seq, CASE op WHEN 'i' THEN 'c' WHEN 'r' THEN 't' ELSE op END AS new_op FROM change")
def log_op_rewrite(spark, d):
    return E.rewrite_envelope(_events(spark, d)).select("file", "pos", "seq", F.col("value.op").alias("new_op"))


@query(EV + """SELECT file, pos, seq, '{"user_id":' || user_id || ',"k":' || coalesce(CAST(k AS VARCHAR), 'null') || '}' AS key_json, op AS value_op, 'cluster1' AS cluster, user_id AS after_user_id, CASE WHEN kind = 'RANGE' THEN 'unset' ELSE 'set' END AS k_state FROM change""")
def log_json_payload(spark, d):
    s = E.serialise(_events(spark, d))
    get = lambda p: F.get_json_object("value", p)
    return s.select("file", "pos", "seq", F.col("key").alias("key_json"), get("$.op").alias("value_op"), get("$.source.cluster").alias("cluster"), get("$.after.user_id.value").cast("long").alias("after_user_id"), F.when(get("$.after.k.set").isNull(), "unset").otherwise("set").alias("k_state"))


@query(EV + "SELECT file, pos, seq, user_id, row_number() OVER (PARTITION BY file ORDER BY pos, first, seq) AS nth FROM (SELECT c.*, g.first FROM change c JOIN (SELECT file, pos, user_id, min(event_id) AS first FROM good GROUP BY ALL) g USING (file, pos, user_id))")
def log_order(spark, d):
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("file").orderBy("pos", "update_no", "seq"))
    return _changes(spark, d).select("file", "pos", "seq", F.col("partition_key")["user_id"].cast("long").alias("user_id"), nth.cast("long").alias("nth"))


@query(EV + "SELECT 'app.user_events' AS name, 'commitlog' AS kind, file, pos FROM change ORDER BY seg DESC, pos DESC LIMIT 1")
def log_high_water(spark, d):
    new = O.high_water(_changes(spark, d))
    return O.advance(O.offsets_frame(spark, [MARK]), new)


@query(EV + "SELECT file, count(*) AS events, CAST(1 AS BIGINT) AS queues, CAST(0 AS BIGINT) AS out_of_order, TRUE AS queue_as_told FROM change GROUP BY file")
def log_partition_balance(spark, d):
    """Each file's events in one queue, that of its name, in order."""
    rows = E.partition_for_order(_changes(spark, d), 8)
    here = F.struct(P.segment_id(F.col("file")), F.col("pos"), F.col("update_no"), F.col("seq")).alias("here")
    dealt = rows.select("file", here, F.spark_partition_id().alias("q"), F.monotonically_increasing_id().alias("nth"), E.queue_index(8))
    from pyspark.sql import Window

    late = dealt.withColumn("late", F.col("here") < F.lag("here").over(Window.partitionBy("q").orderBy("nth")))
    return late.groupBy("file").agg(F.count("*").alias("events"), F.count_distinct("q").alias("queues"), F.count_if("late").alias("out_of_order"), F.bool_and(F.col("q") == F.col("queue")).alias("queue_as_told"))


@query(EV + "SELECT user_id, count(*) AS events, CAST(1 AS BIGINT) AS queues FROM change GROUP BY user_id")
def log_key_queues(spark, d):
    """Dealt by partition key, a key's events are in one queue."""
    rows = E.partition_for_order(_changes(spark, d).withColumn("user_id", F.col("partition_key")["user_id"].cast("long")), 8, "PARTITION_VALUES", ["user_id"])
    return rows.withColumn("q", F.spark_partition_id()).groupBy("user_id").agg(F.count("*").alias("events"), F.count_distinct("q").alias("queues"))


@query(EV + "SELECT DISTINCT file, seg AS segment, 'CommitLog-7-' || seg || '_cdc.idx' AS index_name, file AS log_name, TRUE AS is_segment FROM ev")
def log_segments(spark, d):
    files = D.driver_log(spark, d).select("file").distinct()
    index = F.regexp_replace("file", r"\.log$", "_cdc.idx")
    return files.select("file", P.segment_id(F.col("file")).alias("segment"), index.alias("index_name"), P.index_to_segment(index).alias("log_name"), P.is_segment(F.col("file")).alias("is_segment"))


@query("""SELECT event_id, CAST(event_id * 7 AS INTEGER) AS synced, event_id % 3 = 0 AS completed, 'CommitLog-7-' || event_id || '.log:' || event_id AS position FROM events""")
def idx_parse(spark, d):
    text = F.concat((F.col("event_id") * 7).cast("string"), F.when(F.col("event_id") % 3 == 0, "\nCOMPLETED").when(F.col("event_id") % 3 == 1, "\nCOMPLETED\nmore").otherwise(""))
    e = table(spark, d, "events").select("event_id", P.parse_index(text).alias("i"), P.serialise(F.concat(F.lit("CommitLog-7-"), F.col("event_id").cast("string"), F.lit(".log")), F.col("event_id")).alias("position"))
    back = P.parse_position(F.col("position"))
    return e.select("event_id", "i.synced", "i.completed", F.concat(back["file"], F.lit(":"), back["pos"].cast("string")).alias("position"))


@query(EV + "SELECT 'snapshot' AS origin, o_orderkey AS key, 'i' AS op, '' AS file FROM orders UNION ALL SELECT 'log', user_id, op, file FROM change")
def snapshot_union_log(spark, d):
    snap = S.snapshot(table(spark, d, "orders"), D.ORDERS, TYPES, EXEC_MS).select(F.lit("snapshot").alias("origin"), F.col("key.o_orderkey").alias("key"), "op", "file")
    log = _rows(spark, d).select(F.lit("log").alias("origin"), F.col("key.user_id").alias("key"), "op", "file")
    return S.union_events([snap, log])


# --- Types ---------------------------------------------------------------------------------------------------------------


@query("SELECT event_id, CAST(event_id - 5000 AS INTEGER) AS days FROM events")
def types_date(spark, d):
    raw = (F.col("event_id") - 5000).cast("int").bitwiseXOR(F.lit(-2147483648).cast("int"))
    return table(spark, d, "events").select("event_id", TYPES.decode("date", raw).alias("days"))


_UUID = "substr(md5(CAST(event_id AS VARCHAR)), 1, 8) || '-' || substr(md5(CAST(event_id AS VARCHAR)), 9, 4) || '-' || substr(md5(CAST(event_id AS VARCHAR)), 13, 4) || '-' || substr(md5(CAST(event_id AS VARCHAR)), 17, 4) || '-' || substr(md5(CAST(event_id AS VARCHAR)), 21, 12)"


@query(f"SELECT event_id, {_UUID} AS uuid, {_UUID} AS again FROM events")
def types_uuid(spark, d):
    u = bytes_to_uuid(F.unhex(F.md5(F.col("event_id").cast("string"))))
    return table(spark, d, "events").select("event_id", u.alias("uuid"), TYPES.decode("timeuuid", bytes_to_uuid(uuid_to_bytes(u))).alias("again"))


@query("SELECT event_id, '/10.0.' || (user_id % 256) || '.' || (event_id % 256) AS inet FROM events")
def types_inet(spark, d):
    ip = F.concat_ws(".", F.lit("10"), F.lit("0"), (F.col("user_id") % 256).cast("string"), (F.col("event_id") % 256).cast("string"))
    return table(spark, d, "events").select("event_id", TYPES.decode("inet", ip).alias("inet"))


@query("SELECT event_id, ((event_id % 12) * 30 + event_id % 31) * 86400000000000 + event_id AS nanos FROM events")
def types_duration(spark, d):
    e = table(spark, d, "events").select("event_id", F.struct((F.col("event_id") % 12).cast("int").alias("months"), (F.col("event_id") % 31).cast("int").alias("days"), F.col("event_id").alias("nanos")).alias("dur"))
    return e.select("event_id", TYPES.decode("duration", F.col("dur")).alias("nanos"))


_DEC = "CAST(event_id - 5000 AS VARCHAR) || '.' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0')"


@query(f"""SELECT event_id, CAST({_DEC} AS DOUBLE) AS as_double, {_DEC} AS as_string, 3 AS scale,
    CASE WHEN event_id < 5000 THEN '-' ELSE '' END || coalesce(nullif(ltrim(CAST(abs(event_id - 5000) AS VARCHAR) || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0'), '0'), ''), '0') AS unscaled FROM events""")
def types_decimal(spark, d):
    text = F.concat((F.col("event_id") - 5000).cast("string"), F.lit("."), F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0"))
    e = table(spark, d, "events").select("event_id", text.alias("t"))
    exact = TypeSystem(decimal_mode="PRECISE").decode("decimal", F.col("t"))
    return e.select("event_id", TypeSystem().decode("decimal", F.col("t")).alias("as_double"), TypeSystem(decimal_mode="STRING").decode("decimal", F.col("t")).alias("as_string"), exact["scale"].alias("scale"), exact["value"].alias("unscaled"))


@query("SELECT event_id, event_id * 1000003 - 7 AS small, event_id - 10 AS wrapped, '18446744073709551616' AS as_string FROM events")
def types_varint(spark, d):
    e = table(spark, d, "events").select("event_id", (F.col("event_id") * 1000003 - 7).cast("string").alias("s"), (F.lit("18446744073709551606").cast("decimal(38,0)") + F.col("event_id")).cast("string").alias("w"), F.lit("18446744073709551616").alias("big"))
    return e.select("event_id", TYPES.decode("varint", F.col("s")).alias("small"), TYPES.decode("varint", F.col("w")).alias("wrapped"), TypeSystem(varint_mode="STRING").decode("varint", F.col("big")).alias("as_string"))


@query("SELECT event_id, epoch_us(ts) // 1000 AS millis, event_id * 1000 AS nanos_of_day FROM events")
def types_timestamp_time(spark, d):
    e = table(spark, d, "events").select("event_id", F.floor(D.micros("ts") / 1000).alias("ms"))
    return e.select("event_id", TYPES.decode("timestamp", F.col("ms")).alias("millis"), TYPES.decode("time", F.col("event_id") * 1000).alias("nanos_of_day"))


@query("""SELECT event_id, event_id % 2 = 0 AS b, event_type AS t, CAST(event_id % 100 AS TINYINT) AS ti, CAST(event_id % 1000 AS SMALLINT) AS si, CAST(event_id AS INTEGER) AS i, event_id AS bi, value AS dbl,
    CAST(event_id % 64 AS FLOAT) / 2 AS f, upper(hex(event_type)) AS blob_hex, event_id AS rev, CASE WHEN event_id % 5 <> 0 THEN event_type END AS maybe FROM events""")
def types_basic(spark, d):
    e = table(spark, d, "events")
    x = lambda t, c, n: TYPES.decode(t, c).alias(n)
    n = F.col("event_id")
    return e.select(
        "event_id", x("boolean", n % 2 == 0, "b"), x("text", F.col("event_type"), "t"), x("tinyint", n % 100, "ti"), x("smallint", n % 1000, "si"), x("int", n, "i"), x("bigint", n, "bi"), x("double", F.col("value"), "dbl"),
        x("float", (n % 64).cast("float") / 2, "f"), F.hex(TYPES.decode("blob", F.encode("event_type", "UTF-8"))).alias("blob_hex"), x("reversed<counter>", n, "rev"), x("ascii", F.when(n % 5 != 0, F.col("event_type")), "maybe"),
    )


@query("SELECT event_id, i AS place, CAST(event_id - i AS INTEGER) AS item FROM events, (VALUES (0), (1), (2)) v(i)")
def types_list(spark, d):
    raw = F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda i: (F.col("event_id") - i).cast("int").bitwiseXOR(F.lit(-2147483648).cast("int")))
    e = table(spark, d, "events").select("event_id", TYPES.decode("frozen<list<date>>", raw).alias("l"))
    return e.select("event_id", F.posexplode("l").alias("place", "item"))


@query("SELECT DISTINCT event_id, '/' || CAST(x AS VARCHAR) AS item FROM (SELECT event_id, unnest([event_id % 3, event_id % 2, event_id % 3]) AS x FROM events)")
def types_set(spark, d):
    raw = F.array(*[(F.col("event_id") % n).cast("string") for n in (3, 2, 3)])
    e = table(spark, d, "events").select("event_id", TYPES.decode("set<inet>", raw).alias("s"))
    return e.select("event_id", F.explode("s").alias("item"))


@query("SELECT event_id, k, CASE k WHEN 0 THEN event_id + 100 ELSE event_id END AS v FROM events, (VALUES (0), (1)) t(k)")
def types_map(spark, d):
    entry = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    twice = F.array(entry(0, F.col("event_id")), entry(1, F.col("event_id")), entry(0, F.col("event_id") + 100))
    e = table(spark, d, "events").select("event_id", F.map_from_entries(dedup_entries(twice)).alias("m"))
    return e.select("event_id", F.explode(TYPES.decode("map<int,bigint>", F.col("m"))).alias("k", "v"))


@query("SELECT event_id, event_type AS field1, CAST(event_id % 100 AS SMALLINT) AS field2, '/h' || event_id AS field3_1 FROM events")
def types_tuple(spark, d):
    raw = F.struct(F.col("event_type").alias("field1"), (F.col("event_id") % 100).alias("field2"), F.array(F.concat(F.lit("h"), F.col("event_id").cast("string"))).alias("field3"))
    e = table(spark, d, "events").select("event_id", raw.alias("raw")).select("event_id", TYPES.decode("tuple<ascii,smallint,frozen<list<inet>>>", F.col("raw")).alias("t"))
    return e.select("event_id", "t.field1", "t.field2", F.col("t.field3")[0].alias("field3_1"))


@query("SELECT event_id, event_type AS name, value AS amount, ((event_id % 2) * 30 + 2) * 86400000000000 + 3 AS lasted FROM events")
def types_udt(spark, d):
    types = TypeSystem(udts={"span": [("name", "ascii"), ("amount", "double"), ("lasted", "duration")]})
    dur = F.struct((F.col("event_id") % 2).cast("int").alias("months"), F.lit(2).alias("days"), F.lit(3).cast("long").alias("nanos"))
    e = table(spark, d, "events").select("event_id", F.array(F.struct(F.col("event_type").alias("name"), F.col("value").alias("amount"), dur.alias("lasted"))).alias("raw"))
    return e.select("event_id", F.inline(types.decode("list<frozen<span>>", F.col("raw"))))


@query("SELECT event_id, event_type AS first, CAST(event_id AS VARCHAR) AS second, event_type AS alone FROM events")
def types_partition_key(spark, d):
    part = lambda c: F.concat(F.unhex(F.lpad(F.hex(F.length(c)), 4, "0")), F.encode(c, "UTF-8"), F.unhex(F.lit("00")))
    head = F.when(F.col("event_id") % 2 == 0, F.unhex(F.lit("FFFF"))).otherwise(F.unhex(F.lit("")))
    raw = F.concat(head, part(F.col("event_type")), part(F.col("event_id").cast("string")))
    e = table(spark, d, "events").select("event_id", raw.alias("raw"), F.encode("event_type", "UTF-8").alias("one"))
    a, b = composite_key(F.col("raw"), 2)
    return e.select("event_id", F.decode(a, "UTF-8").alias("first"), F.decode(b, "UTF-8").alias("second"), F.decode(composite_key(F.col("one"), 1)[0], "UTF-8").alias("alone"))


# --- Metrics, files, streams -----------------------------------------------------------------------------------------------


@query("SELECT 'shop.' || t AS table_name, n AS rows_scanned FROM (SELECT 'orders' AS t, count(*) AS n FROM orders UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'lineitem', count(*) FROM lineitem)")
def metrics_rows_scanned(spark, d):
    parts = [S.snapshot(table(spark, d, s.table), s, TYPES, EXEC_MS).select("keyspace", "table") for s in (D.ORDERS, D.CUSTOMER, D.LINEITEM)]
    return M.rows_scanned(S.union_events(parts))


@query(EV + "SELECT count(*) FILTER (WHERE mid % 11 <> 0) AS processed, count(*) FILTER (WHERE mid % 11 = 0) AS unrecoverable FROM (SELECT DISTINCT mid FROM ev)")
def metrics_mutations(spark, d):
    return M.mutation_counts(D.driver_log(spark, d), ~F.col("tracked_by_cdc"))


@query(f"SELECT count(*) AS total, count(*) FILTER (WHERE NOT done AND NOT started) AS remaining, (SELECT (max(n_nationkey) * 1700 - 1) // 1000 FROM nation) AS seconds FROM ({_STORE}) WHERE cdc AND NOT virtual")
def metrics_tables(spark, d):
    last = table(spark, d, "nation").agg(F.max("n_nationkey")).first()[0]
    return M.remaining_tables(*_pending(spark, d)).withColumn("seconds", M.snapshot_seconds(F.lit(1), F.lit(last * 1700)))


@query(EV + "SELECT file, CAST(pos AS BIGINT) AS pos FROM ev ORDER BY seg DESC, pos DESC LIMIT 1")
def latest_position(spark, d):
    return M.latest_position(D.driver_log(spark, d))


@query(EV + "SELECT file, seg AS segment, count(DISTINCT mid) AS mutations FROM ev WHERE seg = (SELECT max(seg) FROM ev) GROUP BY 1, 2")
def latest_segment(spark, d):
    log = D.driver_log(spark, d).groupBy("file").agg(F.count("*").alias("mutations"))
    segments = log.withColumns({"segment": P.segment_id(F.col("file")), "modified": P.segment_id(F.col("file"))})
    return L.latest_segment(segments).select("file", "segment", "mutations")


@query(EV + "SELECT file, pos, seq, CASE WHEN seg % 5 = 0 THEN 'error' ELSE 'archive' END AS folder FROM change")
def log_errors_split(spark, d):
    rows = _changes(spark, d)
    bad = rows.select("file").distinct().filter(P.segment_id(F.col("file")) % 5 == 0)
    error, archive = rows.join(bad, "file", "left_semi"), rows.join(bad, "file", "left_anti")
    pick = lambda df, to: df.select("file", "pos", "seq", F.lit(to).alias("folder"))
    return pick(error, "error").union(pick(archive, "archive"))


@query(EV + """SELECT count(DISTINCT file) AS files, CAST(sum(length('{"pos":' || pos || ',"keyspace":"app"}') + 1) AS BIGINT) AS total_bytes FROM (SELECT DISTINCT file, pos FROM ev)""")
def metrics_dir_bytes(spark, d):
    path = _scratch(spark, "segments")
    D.driver_log(spark, d).select("file", F.to_json(F.struct("pos", "keyspace")).alias("value")).repartition("file").write.partitionBy("file").text(path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(path)
    name = F.regexp_extract("path", r"file=([^/]+)", 1)
    return L.directory_bytes(files.select(name.alias("name"), F.col("length").alias("bytes")).groupBy("name").agg(F.sum("bytes").alias("bytes"))).select("files", "total_bytes")


def _scratch(spark: SparkSession, tag: str) -> str:
    """A folder that driver and executors share; one of our own only where all run on this machine (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir is not set: executors need a folder that all of them share")
    return f"{(found or 'file://' + os.path.realpath(tempfile.mkdtemp(prefix='tidemark-'))).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


@query(EV + "SELECT file, pos, user_id, seq, op, event_ts FROM change")
def stream_equals_batch(spark, d):
    """The log written as parquet, read back as a stream of micro-batches, and captured."""
    source, out, state = (_scratch(spark, x) for x in ("log", "events", "state"))
    D.driver_log(spark, d).write.parquet(source)
    stream = spark.readStream.schema(L.LOG_SCHEMA).option("maxFilesPerTrigger", 8).parquet(source)
    specs = D.registry().frame(spark)
    flat = _flat(E.changes(stream, specs), "event_ts")
    q = flat.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(flat.schema).parquet(out)


# --- Logs of other shapes ----------------------------------------------------------------------------------------------------

# One marker per event: signups open a range, errors close one, purchases do both.
_MARKS = """
WITH e AS (SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, epoch_us(ts) AS us FROM events),
m AS (SELECT *, {up} AS up FROM e WHERE event_type IN ('signup', 'error', 'purchase')),
l AS (SELECT *, lag(event_type) OVER w AS pt, lag(k) OVER w AS pk, lag(us) OVER w AS pus FROM m WINDOW w AS (PARTITION BY {by} ORDER BY event_id))
SELECT user_id, event_id * 2 AS seq, pk AS start_k, k AS end_k, pus AS event_ts FROM l WHERE event_type IN ('error', 'purchase') AND pt IN ('signup', 'purchase')
"""


def _events_table(spark, d) -> DataFrame:
    return table(spark, d, "events").select("event_id", "user_id", "event_type", "value", F.get_json_object("props", "$.k").cast("int").alias("k"), D.micros("ts").alias("us"))


def _mutations(updates: DataFrame, per_file: int = 1000) -> DataFrame:
    """A log of one update per mutation from ``(id, user_id, rows)``, in files of ``per_file`` ids; more columns override the update's fields."""
    null = lambda t: F.lit(None).cast(t)
    own = {"table": F.lit("user_events"), "is_counter": F.lit(False), "is_view": F.lit(False), "is_index": F.lit(False), "partition_key": F.create_map(F.lit("user_id"), F.col("user_id").cast("string")), "partition_deleted_at": null("bigint"), "rows": F.col("rows")}
    own |= {c: F.col(c) for c in ("table", "partition_deleted_at") if c in updates.columns}
    file = F.concat(F.lit("CommitLog-7-"), F.floor(F.col("id") / per_file).cast("string"), F.lit(".log"))
    return updates.select(file.alias("file"), F.col("id").cast("int").alias("pos"), F.lit(True).alias("tracked_by_cdc"), F.lit("app").alias("keyspace"), F.array(F.struct(*[v.alias(n) for n, v in own.items()])).alias("updates"))


def _row(kind: Column, seq: Column, *, us: Column | None = None, deleted: Column | None = None, clustering: Column | None = None, cells: Column | None = None, opens: Column | None = None, closes: Column | None = None) -> Column:
    given = {"seq": seq, "kind": kind, "liveness_ts": us, "deleted_at": deleted, "written_at": us, "clustering": clustering, "cells": cells, "open_bound": opens, "close_bound": closes}
    types = {"liveness_ts": "bigint", "deleted_at": "bigint", "written_at": "bigint", "clustering": "map<string,string>", "cells": f"map<string,{L.CELL}>", "open_bound": L.BOUND, "close_bound": L.BOUND}
    return F.struct(*[(F.lit(None).cast(types[n]) if v is None else v).alias(n) for n, v in given.items()])


def _marked(spark, d) -> DataFrame:
    """``_MARKS`` as rows of a log."""
    e = _events_table(spark, d).filter("event_type IN ('signup', 'error', 'purchase')")
    bound = lambda method: F.struct(F.lit(method).alias("method"), F.array(F.struct(F.lit("k").alias("name"), F.col("k").cast("string").alias("value"), F.lit("Int32Type").alias("type"))).alias("values"))
    kind = F.when(F.col("event_type") == "signup", "RANGE_OPEN").when(F.col("event_type") == "error", "RANGE_CLOSE").otherwise("RANGE_BOUNDARY")
    opens, closes = F.when(F.col("event_type") != "error", bound("INCL_START_BOUND")), F.when(F.col("event_type") != "signup", bound("EXCL_END_BOUND"))
    return e.select("event_id", "user_id", _row(kind, F.col("event_id") * 2, deleted=F.col("us"), opens=opens, closes=closes).alias("row"))


def _ranges(rows: DataFrame) -> DataFrame:
    k = lambda side: F.col(f"after._range_{side}.values")[0]["value"].cast("int")
    out = E.with_row(rows, D.USER_EVENTS, TYPES).filter("op = 'r'")
    return out.select(F.col("key.user_id").alias("user_id"), "seq", k("start").alias("start_k"), k("end").alias("end_k"), "event_ts")


@query(_MARKS.format(up="event_id // 50", by="event_id // 50, user_id"))
def log_ranges_within(spark, d):
    """Bounds pair in order within their update; those left alone there give nothing."""
    e = _marked(spark, d)
    u = e.groupBy(F.expr("event_id div 50").alias("id"), "user_id").agg(F.collect_list("row").alias("rows"))
    return _ranges(E.changes(_mutations(u), D.registry().frame(spark)))


@query(_MARKS.format(up="event_id", by="user_id"))
def log_ranges_across(spark, d):
    """Each bound in a mutation of its own: ranges pair across mutations and files."""
    log = _mutations(_marked(spark, d).select(F.col("event_id").alias("id"), "user_id", F.array("row").alias("rows")))
    return _ranges(E.all_changes(E.captured(log, D.registry().frame(spark)))[0])


_TAGGED = D.TableSpec("app", "tagged", (D.ColumnSpec("user_id", "bigint", D.PARTITION), D.ColumnSpec("tags", "set<int>"), D.ColumnSpec("counts", "map<text,bigint>"), D.ColumnSpec("days", "frozen<list<date>>"), D.ColumnSpec("amount", "varint"), D.ColumnSpec("price", "decimal")))
_CELL_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


@query(f"""SELECT event_id AS pos, 'tags' AS part, CAST(unnest(list_distinct([{_CELL_K}, {_CELL_K} % 2])) AS VARCHAR) AS item, CAST(NULL AS BIGINT) AS deletion_ts FROM events WHERE event_id % 4 <> 3
    UNION ALL SELECT event_id, 'counts', event_type || '=' || event_id, NULL FROM events
    UNION ALL SELECT event_id, 'days', CAST(unnest([event_id - 5000, event_id - 4000]) AS VARCHAR), (epoch_us(ts) // 1000000 + 60) * 1000000 FROM events
    UNION ALL SELECT event_id, 'amount', CAST(event_id * 1000003 * CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END AS VARCHAR), (epoch_us(ts) // 1000000 + 60) * 1000000 FROM events""")
def log_collection_cells(spark, d):
    """Collections of the log as JSON, integers of 70 digits; collections of several cells never expire, frozen ones do, and a tombstone is a set cell without items."""
    e = _events_table(spark, d)
    text = lambda c: F.to_json(c)
    value = lambda v, gone=F.lit(False): F.struct(v.cast("string").alias("value"), gone.alias("tombstone"), (F.floor(F.col("us") / 1_000_000) + 60).cast("long").alias("expires_at"))
    wide = F.concat(F.when(F.col("event_id") % 2 == 0, "").otherwise("-"), (F.col("event_id") + 1).cast("string"), F.repeat(F.lit("0"), F.lit(40)), F.lpad((F.col("event_id") * 1000003).cast("string"), 24, "0"))
    day = lambda n: (F.col("event_id") - n).cast("int").bitwiseXOR(F.lit(-2147483648).cast("int"))
    cells = F.create_map(
        F.lit("tags"), value(text(F.array(F.col("k"), F.col("k") % 2, F.col("k"))), F.col("event_id") % 4 == 3), F.lit("counts"), value(text(F.create_map(F.col("event_type"), F.col("event_id")))),
        F.lit("days"), value(text(F.array(day(5000), day(4000)))), F.lit("amount"), value(wide),
    )
    log = _mutations(e.select(F.col("event_id").alias("id"), "user_id", F.lit("tagged").alias("table"), F.array(_row(F.lit("ROW"), F.lit(0).cast("long"), us=F.col("us"), cells=cells)).alias("rows")))
    reg = D.SchemaRegistry([_TAGGED])
    rows = E.with_row(E.changes(log, reg.frame(spark)), _TAGGED, TYPES)
    as_text = lambda c: F.transform(c, lambda x: x.cast("string"))
    pairs = F.transform(F.map_entries(_cell("counts")), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string")))
    parts = {"tags": as_text(_cell("tags")), "counts": pairs, "days": as_text(_cell("days")), "amount": F.array(_cell("amount").cast("string"))}
    listed = F.array(*[F.struct(F.lit(n).alias("part"), v.alias("items"), _cell(n, "deletion_ts").alias("deletion_ts")) for n, v in parts.items()])
    return rows.select(F.col("pos").cast("long").alias("pos"), F.inline(listed)).select("pos", "part", F.explode("items").alias("item"), "deletion_ts")


_LONE = D.TableSpec("app", "lone", (D.ColumnSpec("user_id", "bigint", D.PARTITION), D.ColumnSpec("value", "double")))


@query("""SELECT CASE WHEN event_type = 'error' THEN 'DELETE_WITHOUT_CLUSTERING' ELSE 'ROW_LEVEL' END AS partition_type, CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'i' ELSE 'u' END AS op, count(*) AS n
    FROM events WHERE event_type <> 'view' GROUP BY 1, 2""")
def log_without_clustering(spark, d):
    """A table without clustering; rows of an unknown kind (views) are dropped."""
    e = _events_table(spark, d)
    kind = F.when(F.col("event_type") == "view", "SOMETHING_ELSE").otherwise("ROW")
    cells = F.create_map(F.lit("value"), F.struct(F.col("value").cast("string").alias("value"), F.lit(False).alias("tombstone"), F.lit(None).cast("long").alias("expires_at")))
    row = _row(kind, F.lit(0).cast("long"), us=F.when(F.col("event_type") == "signup", F.col("us")), cells=cells)
    rows = F.when(F.col("event_type") == "error", F.array_remove(F.array(row), row)).otherwise(F.array(row))
    log = _mutations(e.select(F.col("event_id").alias("id"), "user_id", F.lit("lone").alias("table"), F.when(F.col("event_type") == "error", F.col("us")).alias("partition_deleted_at"), F.filter(F.array(row), lambda r: F.col("event_type") != "error").alias("rows")))
    found = E.with_row(E.changes(log, D.SchemaRegistry([_LONE]).frame(spark)), _LONE, TYPES)
    return found.groupBy("partition_type", "op").agg(F.count("*").alias("n"))


_EXP = "(event_id % 7 - 3)"
_UNSCALED = "((abs(event_id - 5000) * 100 + 25) * CASE WHEN event_id < 5000 THEN -1 ELSE 1 END)"


@query(f"""SELECT event_id, CAST(2 - {_EXP} AS INTEGER) AS scale, CAST({_UNSCALED} AS VARCHAR) AS unscaled,
    CASE WHEN event_id < 5000 THEN '-' ELSE '' END || CASE WHEN {_EXP} = 3 THEN abs({_UNSCALED}) || '0' WHEN {_EXP} = 2 THEN CAST(abs({_UNSCALED}) AS VARCHAR)
        ELSE (abs({_UNSCALED}) // CAST(pow(10, 2 - {_EXP}) AS BIGINT)) || '.' || lpad(CAST(abs({_UNSCALED}) % CAST(pow(10, 2 - {_EXP}) AS BIGINT) AS VARCHAR), CAST(2 - {_EXP} AS INTEGER), '0') END AS plain FROM events""")
def types_decimal_exponent(spark, d):
    n = F.col("event_id") - 5000
    text = F.concat(F.when(n < 0, "-").otherwise(""), F.abs(n).cast("string"), F.lit(".25E"), (F.col("event_id") % 7 - 3).cast("string"))
    e = table(spark, d, "events").select("event_id", text.alias("t"))
    exact = TypeSystem(decimal_mode="PRECISE").decode("decimal", F.col("t"))
    return e.select("event_id", exact["scale"].alias("scale"), exact["value"].alias("unscaled"), TypeSystem(decimal_mode="STRING").decode("decimal", F.col("t")).alias("plain"))


_WIDE = "CASE WHEN event_id % 2 = 0 THEN '' ELSE '-' END || (event_id + 1) || repeat('0', 40) || lpad(CAST(event_id * 1000003 AS VARCHAR), 24, '0')"


@query(f"SELECT event_id, event_id * 1000003 * CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END AS low, 0 AS scale, {_WIDE} AS exact FROM events")
def types_varint_wide(spark, d):
    """Integers of about 70 digits: the low 64 bits (10^64 is a multiple of 2^64), and every digit."""
    n = F.col("event_id")
    text = F.concat(F.when(n % 2 == 0, "").otherwise("-"), (n + 1).cast("string"), F.repeat(F.lit("0"), F.lit(40)), F.lpad((n * 1000003).cast("string"), 24, "0"))
    e = table(spark, d, "events").select("event_id", text.alias("t"))
    exact = TypeSystem(varint_mode="PRECISE").decode("varint", F.col("t"))
    return e.select("event_id", TYPES.decode("varint", F.col("t")).alias("low"), exact["scale"].alias("scale"), exact["value"].alias("exact"))


_SNAP_NULL = "SELECT o_orderkey AS key, o_totalprice AS kept, CAST(NULL AS VARCHAR) AS excluded FROM orders"


@query(_SNAP_NULL)
def snapshot_excludes(spark, d):
    """A snapshot through the runner leaves excluded columns out."""
    out: list[DataFrame] = []
    runner = S.SnapshotRunner(spark, D.SchemaRegistry([D.ORDERS]), lambda s: table(spark, d, s.table), O.OffsetStore(spark, _scratch(spark, "offsets")), excludes={"shop.orders": ["o_orderpriority"]})
    path = _scratch(spark, "snapshot")
    runner.poll(lambda rows, spec: out.append(rows) or rows.select(F.col("key.o_orderkey").alias("key"), _cell("o_totalprice").alias("kept"), _cell("o_orderpriority").alias("excluded")).write.parquet(path), EXEC_MS)
    return spark.read.parquet(path)


@query(EV + "SELECT file, pos, user_id, seq, op, event_ts FROM change")
def stream_growing_segments(spark, d):
    """Segments that are read while they grow, cut within lines, then complete: every change once, and each segment archived once."""
    from ..streaming import log_source as LS
    from ..streaming.pipeline import Capture
    from ..streaming.transfer import Relocation

    folder, moved, offsets, state, out = (_scratch(spark, x) for x in ("segments", "moved", "offsets", "state", "events"))
    log = D.driver_log(spark, d)
    lines = log.select("file", F.to_json(F.struct(*[c for c in log.columns if c != "file"])).alias("value"))
    staged = _scratch(spark, "staged")
    lines.repartition("file").sortWithinPartitions("file", F.get_json_object("value", "$.pos").cast("int")).write.partitionBy("file").text(staged)
    sizes = LS.adopt(spark, staged, folder)

    def sink(rows: DataFrame, spec) -> None:
        _flat(rows, "event_ts").write.mode("append").parquet(out)

    capture = Capture(spark, D.registry(), O.OffsetStore(spark, offsets), sink, transfer=Relocation(spark, moved), folder=folder)
    for part, done in ((0.3, False), (0.7, False), (1, True)):
        for name, size in sizes.items():  # as many as segments
            LS.write_index(folder, name, int(size * part), done)
        capture.start(LS.read_stream(spark, folder, real_time=True), state).awaitTermination()
    left = [n for n in capture.files.names(folder) if n.endswith(".log")]
    if left or len(capture.files.names(f"{moved}/archive")) != 2 * len(sizes):
        raise AssertionError(f"segments not archived: {left}")
    return spark.read.parquet(out)


# --- Extension: not a part of the event stream, but what its consumers compute from it -------------------------------------


@query(EV + """, del AS (SELECT user_id, k, us AS at, NULL AS lo FROM rows_ WHERE op = 'd'), w AS (SELECT user_id, k, event_type, value, kind, us, seq, event_ts FROM rows_ WHERE op IN ('i', 'u')),
  dead AS (SELECT w.user_id, w.k, w.seq FROM w WHERE EXISTS (SELECT 1 FROM del x WHERE x.user_id = w.user_id AND x.k = w.k AND x.at >= w.event_ts)
        OR EXISTS (SELECT 1 FROM parts x WHERE x.user_id = w.user_id AND x.us >= w.event_ts) OR EXISTS (SELECT 1 FROM ranges x WHERE x.user_id = w.user_id AND w.k BETWEEN 0 AND x.k AND x.us >= w.event_ts)),
  live AS (SELECT * FROM w WHERE seq NOT IN (SELECT seq FROM dead))
  SELECT user_id, k, arg_max(event_type, (event_ts, seq)) FILTER (WHERE event_type <> 'click') AS event_type,
    arg_max({'v': CASE WHEN event_type <> 'view' THEN value END}, (event_ts, seq)).v AS value, max(event_ts) AS last_ts
  FROM live GROUP BY user_id, k""")
def current_state(spark, d):
    """Last-write-wins per key and column: rows, partitions and ranges deleted at or after a write hide it."""
    rows = _rows(spark, d).select("op", "whole_partition", "event_ts", "seq", F.col("partition_key")["user_id"].cast("long").alias("user_id"), F.col("clustering")["k"].cast("int").alias("k"), "after")
    end = F.col("after._range_end.values")[0]["value"].cast("int")
    # Deletions and written keys, merged map-side: one row per user and place.  A range [0, end] hides the keys up to its end.
    place = F.when(F.col("op") == "r", end).otherwise(F.col("k"))
    at = lambda when, name: F.max(F.when(when, F.col("event_ts"))).alias(name)
    is_row = F.col("k").isNotNull()
    places = rows.groupBy("user_id", place.alias("place")).agg(at(F.col("whole_partition"), "whole"), at(F.col("op") == "r", "ranged"), at((F.col("op") == "d") & is_row, "gone"), F.bool_or(is_row).alias("written"))
    from pyspark.sql import Window

    user = Window.partitionBy("user_id")
    down = user.orderBy(F.desc_nulls_last("place")).rowsBetween(Window.unboundedPreceding, 0)  # over the different keys of a user, not their writes
    hidden = F.greatest(F.max("whole").over(user), F.max("ranged").over(down), F.col("gone"))
    hidden = places.select("user_id", "place", "written", hidden.alias("hidden")).filter("written AND hidden IS NOT NULL").select("user_id", F.col("place").alias("k"), "hidden")
    writes = rows.filter("op IN ('i', 'u')").join(hidden, ["user_id", "k"], "left")
    live = writes.filter("hidden IS NULL OR event_ts > hidden")
    last = lambda c: F.max(F.when(F.col(f"after.{c}").isNotNull(), F.struct("event_ts", "seq", _cell(c).alias("v"))))["v"].alias(c)
    return live.groupBy("user_id", "k").agg(last("event_type"), last("value"), F.max("event_ts").alias("last_ts"))
