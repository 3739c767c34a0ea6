"""Small mutation logs for tests, as the open log format."""

from tidemark.sources.mutation_log import LOG_SCHEMA
from tidemark.spec import CLUSTERING, PARTITION, ColumnSpec, TableSpec

TS = 1_683_810_323_862_000


def spec(keyspace, table, partition, clustering=(), regular=()):
    """Columns as ``name:type``."""
    cols = [(c, r) for cs, r in ((partition, PARTITION), (clustering, CLUSTERING), (regular, "REGULAR")) for c in cs]
    return TableSpec(keyspace, table, tuple(ColumnSpec(*c.split(":"), r) for c, r in cols))


def cell(value, tombstone=False, expires_at=None):
    return (None if value is None else str(value), tombstone, expires_at)


def row(seq, clustering=None, cells=None, *, insert=True, deleted_at=None, written_at=TS, kind="ROW", opens=None, closes=None):
    return (seq, kind, TS if insert else None, deleted_at, written_at, clustering or {}, cells or {}, opens, closes)


def bound(method, **values):
    return (method, [(k, str(v), "Int32Type") for k, v in values.items()])


def update(table, key, rows, *, deleted_at=None, counter=False, view=False, index=False):
    return (table, counter, view, index, {k: str(v) for k, v in key.items()}, deleted_at, rows)


def mutation(pos, *updates, keyspace="ks", file="CommitLog-7-1.log", tracked=True):
    return (file, pos, tracked, keyspace, list(updates))


def frame(spark, mutations):
    return spark.createDataFrame(mutations, LOG_SCHEMA)
