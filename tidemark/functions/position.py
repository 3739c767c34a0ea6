"""Log positions: segment file names, ids, byte positions, their order and text form."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: File names of segments and their index files.
SEGMENT = r"CommitLog-\d+-(\d+)\.log"
INDEX = r"CommitLog-\d+-(\d+)_cdc\.idx"

#: A snapshot's position.
SNAPSHOT_FILE, SNAPSHOT_POS, SNAPSHOT_SEGMENT = "", -1, -1


def is_segment(name: Column) -> Column:
    return name.rlike(f"^{SEGMENT}$")


def is_index(name: Column) -> Column:
    return name.rlike(f"^{INDEX}$")


def segment_id(name: Column) -> Column:
    """Id of a segment or index file; -1 for a snapshot's empty name; null for any other name."""
    base = F.substring_index(name, "/", -1)
    found = F.regexp_extract(base, r"^CommitLog-\d+-(\d+)(?:\.log|_cdc\.idx)$", 1)
    return F.when(base == "", F.lit(-1)).when(found != "", found).cast("long")


def index_to_segment(name: Column) -> Column:
    return F.regexp_replace(name, r"_cdc\.idx$", ".log")


def position(segment: Column, pos: Column) -> Column:
    """A struct that compares by segment, then by byte position."""
    return F.struct(segment.cast("long").alias("segment"), pos.cast("int").alias("pos"))


def serialise(file: Column, pos: Column) -> Column:
    return F.concat(file, F.lit(":"), pos.cast("string"))


def parse_position(text: Column) -> Column:
    """``{file, pos}``; anything but two parts raises an error when evaluated."""
    parts = F.split(text, ":")
    return F.when(F.size(parts) == 2, F.struct(parts[0].alias("file"), parts[1].cast("int").alias("pos"))).otherwise(
        F.raise_error(F.concat(F.lit("not a position: "), text)).cast("struct<file:string,pos:int>")
    )


def compare_segments(a: str, b: str) -> int:
    """-1, 0 or 1 by numeric id, whatever the version in the names."""
    x, y = (int(re.fullmatch(SEGMENT, n)[1]) for n in (a, b))
    return (x > y) - (x < y)


def parse_index(content: Column) -> Column:
    """``{synced, completed}`` of an index file's text; completed only if it has exactly two lines, the second COMPLETED."""
    lines = F.split(F.regexp_replace(content, r"\n$", ""), "\n")
    return F.struct(lines[0].cast("int").alias("synced"), ((F.size(lines) == 2) & (F.get(lines, F.lit(1)) == "COMPLETED")).alias("completed"))
