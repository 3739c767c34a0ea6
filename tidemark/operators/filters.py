"""Field exclusion lists, parsed and validated when a pipeline is configured."""

from __future__ import annotations

from ..spec import TableSpec


def parse_excludes(text: str | None) -> dict[str, list[str]]:
    """``ks.tbl.col,...`` to columns by table; entries are plain names, not patterns."""
    out: dict[str, list[str]] = {}
    for entry in filter(None, (x.strip() for x in (text or "").split(","))):
        parts = entry.split(".")
        if len(parts) != 3 or not all(parts):
            raise ValueError(f"invalid field to exclude: {entry}; expected <keyspace>.<table>.<column>")
        out.setdefault(f"{parts[0]}.{parts[1]}", []).append(parts[2])
    return out


def excludes_for(spec: TableSpec, excludes: dict[str, list[str]]) -> list[str]:
    """The columns of one table to exclude; an unknown column is an error at configuration time."""
    names = {c.name for c in spec.columns}
    found = excludes.get(spec.name, [])
    if unknown := [c for c in found if c not in names]:
        raise ValueError(f"excluded columns that {spec.name} does not have: {unknown}")
    return found
