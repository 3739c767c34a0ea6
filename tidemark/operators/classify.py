"""Partition-type and row-type classification, and the filters on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands for "no timestamp"; a log may also leave the field null.
NO_TIMESTAMP = -(1 << 63)

SUPPORTED_PARTITIONS = ("DELETE_WITH_CLUSTERING", "DELETE_WITHOUT_CLUSTERING", "ROW_LEVEL")
SUPPORTED_ROWS = ("RANGE", "DELETE", "INSERT", "UPDATE")


def present(ts: Column) -> Column:
    return F.coalesce(ts > NO_TIMESTAMP, F.lit(False))


def partition_type(is_counter: Column, is_view: Column, is_index: Column, deleted_at: Column, has_clustering: Column) -> Column:
    """The first that applies, in this order."""
    return (
        F.when(F.coalesce(is_counter, F.lit(False)), "COUNTER")
        .when(F.coalesce(is_view, F.lit(False)), "VIEW")
        .when(F.coalesce(is_index, F.lit(False)), "INDEX")
        .when(present(deleted_at) & has_clustering, "DELETE_WITH_CLUSTERING")
        .when(present(deleted_at), "DELETE_WITHOUT_CLUSTERING")
        .otherwise("ROW_LEVEL")
    )


def row_type(kind: Column, deleted_at: Column, liveness_ts: Column) -> Column:
    """A deletion outweighs an insertion; a row without liveness is an update."""
    return (
        F.when(kind.startswith("RANGE_"), "RANGE")
        .when(kind != "ROW", "UNKNOWN")
        .when(present(deleted_at), "DELETE")
        .when(present(liveness_ts), "INSERT")
        .otherwise("UPDATE")
    )


def tracked(log: DataFrame) -> DataFrame:
    """Mutations that the log marks for capture; before anything is unnested."""
    return log.filter("tracked_by_cdc")


def supported(updates: DataFrame) -> DataFrame:
    return updates.filter(F.col("partition_type").isin(*SUPPORTED_PARTITIONS))
