"""Statements by text: the place of a store's query client is taken by Spark SQL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..spec import SchemaRegistry, TableSpec


def execute(spark: SparkSession, text: str, args: Mapping[str, object] | Sequence[object] | None = None) -> DataFrame:
    """A statement, plain or with named (``:x``) or positional (``?``) parameters."""
    return spark.sql(text, args=args) if args else spark.sql(text)


def discover(spark: SparkSession, keyspace: str, partition_keys: Mapping[str, Sequence[str]], clustering: Mapping[str, Sequence[str]] | None = None) -> SchemaRegistry:
    """Specs of a catalog database's tables that carry the table property ``cdc = true``; views are virtual."""
    kinds = {"string": "text", "bigint": "bigint", "int": "int", "double": "double", "float": "float", "boolean": "boolean", "binary": "blob", "smallint": "smallint", "tinyint": "tinyint"}
    found = SchemaRegistry()
    from ..spec import CLUSTERING, PARTITION, REGULAR, ColumnSpec

    for t in spark.catalog.listTables(keyspace):
        if t.isTemporary or t.tableType == "VIEW":
            continue
        name = f"{keyspace}.{t.name}"
        properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        role = lambda c: PARTITION if c in partition_keys.get(t.name, ()) else CLUSTERING if c in (clustering or {}).get(t.name, ()) else REGULAR  # noqa: B023, E731
        columns = tuple(ColumnSpec(c.name, kinds.get(c.dataType, c.dataType), role(c.name)) for c in spark.catalog.listColumns(name))
        found.put(TableSpec(keyspace, t.name, columns, cdc=properties.get("cdc") == "true"))
    return found
