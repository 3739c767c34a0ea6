"""From partition updates to change events.

All rows, ranges and the partition deletion of an update are put into one array
of changes by expressions inside the update, and unnested once: no branch is
scanned twice, nothing is shuffled, and the order within the update is kept.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import position as P
from ..functions.types import TypeSystem
from ..spec import CLUSTERING, PARTITION, ColumnSpec, TableSpec
from ..sources.mutation_log import BOUND, CELL, updates
from . import classify as C

INSERT, UPDATE, DELETE, RANGE = "i", "u", "d", "r"

#: Operation codes as the envelope transformation writes them.
REWRITTEN = {"i": "c", "u": "u", "d": "d", "r": "t"}

CHANGE_FIELDS = ("seq", "op", "event_ts", "deleted_at", "clustering", "cells", "range_start", "range_end", "whole_partition")


def _change(seq, op, event_ts, deleted_at, clustering=None, cells=None, start=None, end=None, whole=False) -> Column:
    null = lambda t: F.lit(None).cast(t)
    values = (
        seq, F.lit(op) if isinstance(op, str) else op, event_ts, deleted_at, null("map<string,string>") if clustering is None else clustering,
        null(f"map<string,{CELL}>") if cells is None else cells, null(BOUND) if start is None else start, null(BOUND) if end is None else end, F.lit(whole),
    )
    return F.struct(*[v.alias(n) for v, n in zip(values, CHANGE_FIELDS, strict=True)])


def max_timestamp(rows: Column, partition_deleted_at: Column) -> Column:
    """The largest write or deletion time in a partition update."""
    none = F.lit(C.NO_TIMESTAMP)
    each = F.transform(rows, lambda r: F.greatest(F.coalesce(r["liveness_ts"], none), F.coalesce(r["deleted_at"], none), F.coalesce(r["written_at"], none)))
    return F.greatest(F.array_max(F.concat(each, F.array(F.coalesce(partition_deleted_at, none)))), none)


def _marks(rows: Column) -> Column:
    """The range markers of an update in order of ``seq``."""
    return F.array_sort(F.filter(rows, lambda r: r["kind"].startswith("RANGE_")), lambda a, b: F.when(a["seq"] < b["seq"], -1).when(a["seq"] > b["seq"], 1).otherwise(0))


def _range(opening: Column, closing: Column) -> Column:
    """One range, or null: a closing bound ends what the marker just before it opened.

    That marker is all the state there is: any marker opens, which replaces an earlier opening, or closes, which ends it, or does both.
    A closing bound without an opening gives nothing."""
    both = opening["open_bound"].isNotNull() & closing["close_bound"].isNotNull()
    return F.when(both, _change(closing["seq"], RANGE, opening["deleted_at"], opening["deleted_at"], start=opening["open_bound"], end=closing["close_bound"]))


def pair_ranges(rows: Column) -> Column:
    """Range changes whose two bounds lie in the same update."""
    marks = _marks(rows)
    paired = F.transform(F.sequence(F.lit(1), F.greatest(F.size(marks) - 1, F.lit(1))), lambda i: _range(F.get(marks, i - 1), F.get(marks, i)))
    return F.filter(paired, lambda x: x.isNotNull())


MARKER = f"struct<seq:bigint,deleted_at:bigint,open_bound:{BOUND},close_bound:{BOUND}>"
POSITION = ("segment", "pos", "update_no")


def range_ends(found: DataFrame) -> DataFrame:
    """Updates with range markers, and what of theirs can meet other updates: ``head``, a closing bound that comes first, and ``tail``, an opening one that comes last."""
    marks = F.transform(_marks(F.col("rows")), lambda r: F.struct(*[r[x].alias(x) for x in ("seq", "deleted_at", "open_bound", "close_bound")]))
    some = found.filter(F.exists("rows", lambda r: r["kind"].startswith("RANGE_"))).withColumn("__marks", marks)
    first, last = F.get("__marks", F.lit(0)), F.get("__marks", F.size("__marks") - 1)
    key = F.to_json(F.map_from_entries(F.array_sort(F.map_entries("partition_key")))).alias("partition")
    kept = [c for c in ("keyspace", "table", "partition_key", "file", "pos", "update_no") if c in some.columns]
    return some.select(*kept, key, P.segment_id(F.col("file")).alias("segment"), F.when(first["close_bound"].isNotNull(), first).alias("head"), F.when(last["open_bound"].isNotNull(), last).alias("tail"))


def ranges_across(ends: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ranges whose bounds lie in different updates of a partition, from ``range_ends``; and the openings still waiting for their end.

    The only step from log to events that shuffles: updates with range markers, by partition key."""
    order = Window.partitionBy("keyspace", "table", "partition").orderBy(*POSITION)
    seen = ends.withColumns({"__before": F.lag("tail").over(order), "__next": F.lead("segment").over(order)})
    whole = seen.withColumn("__change", _range(F.col("__before"), F.col("head"))).filter("__change IS NOT NULL")
    rest = [c for c in ends.columns if c not in ("partition", "segment", "head", "tail")]
    return whole.select(*rest, "__change.*"), seen.filter("__next IS NULL AND tail IS NOT NULL").select(ends.columns)


def row_changes(rows: Column, update_ts: Column) -> Column:
    kept = F.filter(rows, lambda r: C.row_type(r["kind"], r["deleted_at"], r["liveness_ts"]).isin("INSERT", "UPDATE", "DELETE"))

    def change(r: Column) -> Column:
        kind = C.row_type(r["kind"], r["deleted_at"], r["liveness_ts"])
        op = F.when(kind == "DELETE", DELETE).when(kind == "INSERT", INSERT).otherwise(UPDATE)
        return _change(r["seq"], op, F.when(kind == "DELETE", r["deleted_at"]).otherwise(update_ts), r["deleted_at"], r["clustering"], r["cells"])

    return F.transform(kept, change)


def captured(log: DataFrame, specs: DataFrame, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The updates that give events: of tracked mutations, known tables, beyond the offsets, and of a supported type."""
    found = updates(C.tracked(log)).join(specs, ["keyspace", "table"])
    if keep is not None:
        found = keep(found)
    kind = C.partition_type(F.col("is_counter"), F.col("is_view"), F.col("is_index"), F.col("partition_deleted_at"), F.col("has_clustering"))
    return C.supported(found.withColumn("partition_type", kind))


def unnested(found: DataFrame) -> DataFrame:
    """The changes of ``captured`` updates, ranges across updates apart."""
    gone = F.when(C.present(F.col("partition_deleted_at")), F.array(_change(F.lit(-1).cast("long"), DELETE, F.col("partition_deleted_at"), F.col("partition_deleted_at"), whole=True)))
    update_ts = max_timestamp(F.col("rows"), F.col("partition_deleted_at"))
    by_seq = lambda a, b: F.when(a["seq"] < b["seq"], -1).when(a["seq"] > b["seq"], 1).otherwise(0)
    listed = F.concat(F.coalesce(gone, F.array().cast(gone_type())), F.array_sort(F.concat(row_changes(F.col("rows"), update_ts), pair_ranges(F.col("rows"))), by_seq))
    rest = [c for c in found.columns if c not in ("rows", "partition_deleted_at", "is_counter", "is_view", "is_index", "tracked_by_cdc", "has_clustering")]
    return found.select(*rest, F.inline(listed))


def changes(log: DataFrame, specs: DataFrame, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Change rows of all registered tables, from the log: filters first, then one unnesting.

    ``specs`` is the registry's frame (one row per table); updates of unknown
    tables are dropped by the join.  ``keep`` is the offset filter, applied
    before rows are unnested.  Bounds of a range pair within their update;
    ``all_changes`` pairs them across updates as well.
    """
    return unnested(captured(log, specs, keep))


def all_changes(found: DataFrame, waiting: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Changes of ``captured`` updates with ranges across updates, and the openings left, to be given as ``waiting`` with what follows in the log."""
    ends = range_ends(found)
    across, left = ranges_across(ends if waiting is None else ends.unionByName(waiting, allowMissingColumns=True))
    return unnested(found).unionByName(across, allowMissingColumns=True), left


def gone_type() -> str:
    return f"array<struct<seq:bigint,op:string,event_ts:bigint,deleted_at:bigint,clustering:map<string,string>,cells:map<string,{CELL}>,range_start:{BOUND},range_end:{BOUND},whole_partition:boolean>>"


def cell(value: Column, deletion_ts: Column | None = None) -> Column:
    return F.struct(value.alias("value"), (F.lit(None) if deletion_ts is None else deletion_ts).cast("long").alias("deletion_ts"), F.lit(True).alias("set"))


def column_cell(c: ColumnSpec, types: TypeSystem) -> Column:
    """The cell of one column of a change: unset is a null struct, null or deleted a set cell without value."""
    null = F.lit(None).cast(types.spark_type(c.cql_type))
    op, gone = F.col("op"), F.col("deleted_at")
    if c.role == PARTITION:
        return cell(types.from_text(c.cql_type, F.col("partition_key")[c.name]))
    if c.role == CLUSTERING:
        there = cell(types.from_text(c.cql_type, F.col("clustering")[c.name]))
        return F.when(F.col("whole_partition"), cell(null, gone)).when(op != RANGE, there)
    given = F.col("cells")[c.name]
    value = types.from_text(c.cql_type, given["value"])
    expiry = F.lit(None) if c.is_collection else given["expires_at"] * 1_000_000
    there = F.when(given["tombstone"], cell(null)).when(given.isNotNull(), cell(value, expiry))
    return F.when(op == DELETE, cell(null, gone)).when(op.isin(INSERT, UPDATE), there)


def with_row(change_rows: DataFrame, spec: TableSpec, types: TypeSystem, exclude: Sequence[str] = ()) -> DataFrame:
    """Adds ``after`` (all cells in schema order and the range bounds) and ``key`` for the rows of one table.

    Excluded columns become unset in inserts and updates; an excluded key
    column leaves the key as well.  Deletions keep all columns.
    """
    one = change_rows.filter((F.col("keyspace") == spec.keyspace) & (F.col("table") == spec.table))
    cells = {c.name: column_cell(c, types) for c in spec.columns}
    for name in exclude:
        cells[name] = F.when(~F.col("op").isin(INSERT, UPDATE), cells[name])
    after = F.struct(*[v.alias(n) for n, v in cells.items()], F.col("range_start").alias("_range_start"), F.col("range_end").alias("_range_end"))
    one = one.withColumn("after", after)
    return one.withColumn("key", key_of(spec))


def key_of(spec: TableSpec) -> Column:
    return F.struct(*[F.col("after")[c.name]["value"].alias(c.name) for c in spec.primary_key])


def source_block(cluster: str, snapshot: bool, version: str = "1", connector: str = "tidemark", name: str = "", ts_ms: Column | None = None) -> Column:
    """Where an event comes from; the database name is fixed text, as tables carry their keyspace."""
    return F.struct(
        F.lit(version).alias("version"), F.lit(connector).alias("connector"), F.lit(name).alias("name"),
        (F.floor(F.col("event_ts") / 1000) if ts_ms is None else ts_ms).cast("long").alias("ts_ms"), F.lit("true" if snapshot else "false").alias("snapshot"), F.lit("NULL").alias("db"),
        F.lit(cluster).alias("cluster"), F.col("file").alias("file"), F.col("pos").cast("int").alias("pos"), F.col("keyspace").alias("keyspace"), F.col("table").alias("table"), F.col("event_ts").alias("ts_micro"),
    )


def envelope(rows: DataFrame, spec: TableSpec, prefix: str, source: Column, ts_ms: int, topic: Callable[[str, TableSpec], str] | None = None) -> DataFrame:
    """``event_type, topic, key, value, mark_offset`` and the position columns; ``ts_ms`` is the processing time, given by the caller."""
    named = topic(prefix, spec) if topic else topic_name(prefix, spec)
    value = F.struct(F.lit(ts_ms).cast("long").alias("ts_ms"), F.col("op").alias("op"), source.alias("source"), F.col("after").alias("after"))
    return rows.select(F.lit("CHANGE").alias("event_type"), F.lit(named).alias("topic"), "key", value.alias("value"), F.lit(True).alias("mark_offset"), "keyspace", "table", "file", "pos", "seq", "op")


def topic_name(prefix: str, spec: TableSpec) -> str:
    return ".".join(x for x in (prefix, spec.keyspace, spec.table) if x)


def fan_out_tombstones(events: DataFrame) -> DataFrame:
    """After each deletion an event with the same key and no value, which marks no offset."""
    kinds = F.when(F.col("op") == DELETE, F.array(F.lit("CHANGE"), F.lit("TOMBSTONE"))).otherwise(F.array(F.lit("CHANGE")))
    twice = events.withColumn("event_type", F.explode(kinds))
    out = {"mark_offset": F.col("mark_offset") & (F.col("event_type") == "CHANGE")}
    if "value" in events.columns:
        out["value"] = F.when(F.col("event_type") == "CHANGE", F.col("value"))
    return twice.withColumns(out)


def rewrite_op(op: Column) -> Column:
    """Insert to create, range to truncate; other codes pass."""
    out = op
    for old, new in REWRITTEN.items():
        out = F.when(op == old, F.lit(new)).otherwise(out)
    return out


def rewrite_envelope(events: DataFrame) -> DataFrame:
    """The rewritten operation inside the value; events without value pass through."""
    return events.withColumn("value", F.when(F.col("value").isNotNull(), F.col("value").withField("op", rewrite_op(F.col("value")["op"]))))


def serialise(events: DataFrame) -> DataFrame:
    """Key and value as JSON text with null fields kept, so that unset and null stay apart."""
    options = {"ignoreNullFields": "false"}
    return events.withColumns({"key": F.to_json("key", options), "value": F.to_json("value", options)})


def position_order(df: DataFrame) -> DataFrame:
    return df.orderBy(P.segment_id(F.col("file")), "pos", "update_no", "seq")


def partition_for_order(df: DataFrame, queues: int, mode: str = "COMMITLOG_FILE", key_columns: Sequence[str] = ()) -> DataFrame:
    """Deal events so that a file's (or a partition key's) events stay together and in order."""
    by = ["file"] if mode == "COMMITLOG_FILE" else list(key_columns)
    order = [P.segment_id(F.col("file")), F.col("pos"), *[F.col(c) for c in ("update_no", "seq") if c in df.columns]]
    return df.repartition(queues, *by).sortWithinPartitions(*order)


def queue_index(queues: int, mode: str = "COMMITLOG_FILE", key_columns: Sequence[str] = (), snapshot: bool = False) -> Column:
    """The queue of an event, where ``partition_for_order`` puts it too; a snapshot's rows go by table, without being moved there."""
    by = ["table"] if snapshot else ["file"] if mode == "COMMITLOG_FILE" else list(key_columns)
    return F.pmod(F.hash(*by), F.lit(queues)).alias("queue")
