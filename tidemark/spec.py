"""Table specifications and the struct types that follow from them."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import types as T

PARTITION, CLUSTERING, REGULAR = "PARTITION", "CLUSTERING", "REGULAR"

RANGE_VALUE = T.StructType([T.StructField("name", T.StringType()), T.StructField("value", T.StringType()), T.StructField("type", T.StringType())])
RANGE_BOUND = T.StructType([T.StructField("method", T.StringType()), T.StructField("values", T.ArrayType(RANGE_VALUE))])


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    cql_type: str
    role: str = REGULAR
    reversed: bool = False  # clustering order only; values decode alike

    @property
    def is_collection(self) -> bool:
        return self.cql_type.startswith(("list<", "set<", "map<"))


@dataclass(frozen=True)
class TableSpec:
    """One table: columns in schema order, key order by position within a role."""

    keyspace: str
    table: str
    columns: tuple[ColumnSpec, ...]
    cdc: bool = True
    virtual: bool = False

    @property
    def name(self) -> str:
        return f"{self.keyspace}.{self.table}"

    def role(self, *roles: str) -> tuple[ColumnSpec, ...]:
        return tuple(c for c in self.columns if c.role in roles)

    @property
    def primary_key(self) -> tuple[ColumnSpec, ...]:
        return self.role(PARTITION) + self.role(CLUSTERING)

    @property
    def non_key(self) -> tuple[ColumnSpec, ...]:
        """All columns minus the partition key, clustering columns included."""
        return self.role(CLUSTERING, REGULAR)

    def column(self, name: str) -> ColumnSpec:
        return next(c for c in self.columns if c.name == name)

    def with_column(self, column: ColumnSpec) -> TableSpec:
        return replace(self, columns=(*self.columns, column))

    def key_type(self, types) -> T.StructType:
        return T.StructType([T.StructField(c.name, types.spark_type(c.cql_type)) for c in self.primary_key])

    def row_type(self, types) -> T.StructType:
        cells = [T.StructField(c.name, cell_type(types.spark_type(c.cql_type))) for c in self.columns]
        return T.StructType([*cells, T.StructField("_range_start", RANGE_BOUND), T.StructField("_range_end", RANGE_BOUND)])


def local_frame(spark, rows: Iterable[tuple], schema: str):
    """A few driver-side rows as a relation of known size: Spark broadcasts it by that size, or joins it otherwise if it is large."""
    fields = [f.rsplit(" ", 1) for f in schema.split(", ")]

    def literal(v: object) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return str(v).upper() if isinstance(v, bool) else str(int(v))  # type: ignore[call-overload]

    listed = ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows)
    if not listed:
        return spark.sql("SELECT " + ", ".join(f"CAST(NULL AS {t}) AS `{n}`" for n, t in fields) + " WHERE false")
    named = ", ".join(f"`{n}`" for n, _ in fields)
    return spark.sql("SELECT " + ", ".join(f"CAST(`{n}` AS {t}) AS `{n}`" for n, t in fields) + f" FROM VALUES {listed} AS v({named})")


def cell_type(value: T.DataType) -> T.StructType:
    """A cell: null struct = unset; set with null value = deleted or set to null."""
    return T.StructType([T.StructField("value", value), T.StructField("deletion_ts", T.LongType()), T.StructField("set", T.BooleanType())])


class SchemaRegistry:
    """The latest specification of each table; only cdc-enabled, non-virtual tables are kept."""

    def __init__(self, specs: Iterable[TableSpec] = ()):
        self._specs: dict[str, TableSpec] = {}
        for s in specs:
            self.put(s)

    def put(self, spec: TableSpec) -> None:
        """A created or altered table; one whose cdc was turned off is forgotten."""
        if spec.cdc and not spec.virtual:
            self._specs[spec.name] = spec
        else:
            self._specs.pop(spec.name, None)

    def drop(self, name: str) -> None:
        self._specs.pop(name, None)

    def get(self, name: str) -> TableSpec | None:
        return self._specs.get(name)

    def drop_keyspace(self, keyspace: str) -> None:
        for name in [n for n, s in self._specs.items() if s.keyspace == keyspace]:
            self.drop(name)

    def refresh(self, found: Iterable[TableSpec]) -> list[tuple[str, str]]:
        """Take over the tables as they are now; what changed, as ``(CREATED | ALTERED | DROPPED, table)``, by table."""
        now = {s.name: s for s in found if s.cdc and not s.virtual}
        changed = [(("ALTERED" if n in self._specs else "CREATED"), n) for n, s in now.items() if self._specs.get(n) != s]
        changed += [("DROPPED", n) for n in self._specs if n not in now]
        self._specs = now
        return sorted(changed, key=lambda x: x[1])

    def tables(self) -> list[TableSpec]:
        return [self._specs[k] for k in sorted(self._specs)]

    def frame(self, spark):
        """The registry as a DataFrame ``(keyspace, table, has_clustering)``; as many rows as tables."""
        rows = [(s.keyspace, s.table, bool(s.role(CLUSTERING))) for s in self.tables()]
        return local_frame(spark, rows, "keyspace string, table string, has_clustering boolean")


def struct_field_type(schema: T.StructType, name: str) -> T.StructType:
    """The type of a field that must be a struct."""
    found = schema[name].dataType
    if not isinstance(found, T.StructType):
        raise TypeError(f"field {name} is {found.simpleString()}, not a struct")
    return found
