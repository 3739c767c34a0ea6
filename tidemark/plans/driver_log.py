"""A deterministic mutation log over the ``events`` table, and the specs of the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.mutation_log import BOUND, CELL
from ..spec import CLUSTERING, PARTITION, ColumnSpec, SchemaRegistry, TableSpec

USER_EVENTS = TableSpec(
    "app",
    "user_events",
    (ColumnSpec("user_id", "bigint", PARTITION), ColumnSpec("k", "int", CLUSTERING), ColumnSpec("event_type", "text"), ColumnSpec("value", "double")),
)
TTL_S = 3600


def _plain(table: str, key: list[str], columns: dict[str, str]) -> TableSpec:
    return TableSpec("shop", table, tuple(ColumnSpec(c, t, PARTITION if c in key[:1] else CLUSTERING if c in key else "REGULAR") for c, t in columns.items()))


ORDERS = _plain("orders", ["o_orderkey"], {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "text", "o_totalprice": "double", "o_orderpriority": "text"})
CUSTOMER = _plain("customer", ["c_custkey"], {"c_custkey": "bigint", "c_name": "text", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "text"})
LINEITEM = _plain("lineitem", ["l_orderkey", "l_linenumber"], {"l_orderkey": "bigint", "l_linenumber": "int", "l_partkey": "bigint", "l_quantity": "double", "l_extendedprice": "double", "l_returnflag": "text"})


def registry() -> SchemaRegistry:
    return SchemaRegistry([USER_EVENTS, ORDERS, CUSTOMER, LINEITEM])


def micros(ts) -> F.Column:
    """Microseconds since 1970 of a timestamp without zone, whatever the session's zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {ts})")


def driver_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three consecutive events form a mutation; see the survey's definition of kinds, tables and positions."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("int")
    e = e.select("event_id", "user_id", "event_type", "value", k.alias("k"), micros("ts").alias("us"), F.expr("event_id div 3").alias("mid"), F.date_format("ts", "yyyyMMdd").cast("long").alias("day"))
    table = F.when(F.col("user_id") % 10 == 7, "user_counts").when(F.col("user_id") % 10 == 8, "user_view").when(F.col("user_id") % 10 == 9, "user_idx").otherwise("user_events")
    kind = (
        F.when(F.col("event_type") == "signup", "INSERT").when(F.col("event_type") == "purchase", "UPDATE_TTL").when(F.col("event_type") != "error", "UPDATE")
        .when(F.col("k") % 7 == 0, "PARTITION_DELETE").when(F.col("k") % 5 == 0, "RANGE").otherwise("ROW_DELETE")
    )
    e = e.withColumns({"table": table, "kind": kind})
    is_ = lambda *x: F.col("kind").isin(*x)
    null = lambda t: F.lit(None).cast(t)
    expires = F.when(is_("UPDATE_TTL"), F.floor(F.col("us") / 1_000_000) + TTL_S).cast("long")
    value = lambda c: F.struct(F.col(c).cast("string").alias("value"), F.lit(False).alias("tombstone"), expires.alias("expires_at"))
    gone = F.struct(null("string").alias("value"), F.lit(True).alias("tombstone"), null("long").alias("expires_at"))
    # A click leaves event_type unset, a view sets value to null, all others give both columns.
    cells = (
        F.when(F.col("event_type") == "click", F.create_map(F.lit("value"), value("value")))
        .when(F.col("event_type") == "view", F.create_map(F.lit("event_type"), value("event_type"), F.lit("value"), gone))
        .otherwise(F.create_map(F.lit("event_type"), value("event_type"), F.lit("value"), value("value")))
    )
    bound = lambda method, v: F.struct(F.lit(method).alias("method"), F.array(F.struct(F.lit("k").alias("name"), v.cast("string").alias("value"), F.lit("Int32Type").alias("type"))).alias("values"))

    def row(kind_name, seq, deleted, start=None, end=None):
        plain = start is None and end is None
        return F.struct(
            seq.alias("seq"), F.lit(kind_name).alias("kind"), F.when(is_("INSERT"), F.col("us")).alias("liveness_ts"), deleted.alias("deleted_at"), F.col("us").alias("written_at"),
            (F.create_map(F.lit("k"), F.col("k").cast("string")) if plain else null("map<string,string>")).alias("clustering"),
            (F.when(is_("INSERT", "UPDATE", "UPDATE_TTL"), cells) if plain else null(f"map<string,{CELL}>")).alias("cells"),
            (null(BOUND) if start is None else start).alias("open_bound"), (null(BOUND) if end is None else end).alias("close_bound"),
        )

    seq = F.col("event_id") * 2
    rows = (
        F.when(is_("RANGE"), F.array(row("RANGE_OPEN", seq, F.col("us"), start=bound("INCL_START_BOUND", F.lit(0))), row("RANGE_CLOSE", seq + 1, F.col("us"), end=bound("INCL_END_BOUND", F.col("k")))))
        .when(is_("PARTITION_DELETE"), F.array().cast("array<struct<seq:bigint,kind:string,liveness_ts:bigint,deleted_at:bigint,written_at:bigint,clustering:map<string,string>,cells:map<string,struct<value:string,tombstone:boolean,expires_at:bigint>>,open_bound:" + BOUND + ",close_bound:" + BOUND + ">>"))
        .otherwise(F.array(row("ROW", seq, F.when(is_("ROW_DELETE"), F.col("us")))))
    )
    # One shuffle, by mutation; both groupings below are satisfied by it.
    e = e.select("mid", "day", "table", "user_id", "event_id", F.when(is_("PARTITION_DELETE"), F.col("us")).alias("pd"), rows.alias("rows")).repartition("mid")
    u = e.groupBy("mid", "table", "user_id").agg(F.min("day").alias("day"), F.min("event_id").alias("first"), F.max("pd").alias("pd"), F.array_sort(F.collect_list(F.struct("event_id", "rows")), lambda a, b: (a["event_id"] - b["event_id"]).cast("int")).alias("parts"))
    one = F.struct(
        F.col("first"), F.col("table"), (F.col("table") == "user_counts").alias("is_counter"), (F.col("table") == "user_view").alias("is_view"), (F.col("table") == "user_idx").alias("is_index"),
        F.create_map(F.lit("user_id"), F.col("user_id").cast("string")).alias("partition_key"), F.col("pd").alias("partition_deleted_at"), F.flatten(F.transform("parts", lambda p: p["rows"])).alias("rows"),
    )
    m = u.groupBy("mid").agg(F.min("day").alias("seg"), F.array_sort(F.collect_list(one), lambda a, b: (a["first"] - b["first"]).cast("int")).alias("updates"))
    from pyspark.sql import Window

    pos = F.row_number().over(Window.partitionBy("seg").orderBy("mid"))
    drop_first = F.transform("updates", lambda x: x.dropFields("first"))
    return m.select(F.concat(F.lit("CommitLog-7-"), F.col("seg").cast("string"), F.lit(".log")).alias("file"), pos.alias("pos"), (F.col("mid") % 11 != 0).alias("tracked_by_cdc"), F.lit("app").alias("keyspace"), drop_first.alias("updates"))
