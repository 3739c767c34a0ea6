"""The configuration surface: keys, defaults, validation."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from .operators.filters import parse_excludes

#: Recognised keys and their defaults (None: no default).
DEFAULTS: dict[str, object] = {
    "topic.prefix": None, "key.converter": None, "value.converter": None, "snapshot.mode": "INITIAL", "snapshot.consistency": "QUORUM", "http.port": 8000,
    "cluster.name": "Test Cluster", "driver.config.file": "application.conf", "node.id": None, "commit.log.relocation.dir": None,
    "tracing.enabled": False, "commit.log.post.processing.enabled": True, "commit.log.error.reprocessing.enabled": False,
    "commit.log.real.time.processing.enabled": False, "commit.log.marked.complete.poll.interval.ms": 10000, "commit.log.transfer.class": None,
    "offset.backing.store.dir": None, "offset.flush.interval.ms": 0, "max.offset.flush.size": 100, "schema.refresh.interval.ms": 10000,
    "cdc.dir.poll.interval.ms": 10000, "snapshot.scan.interval.ms": 10000, "commit.log.relocation.dir.poll.interval.ms": 10000,
    "num.of.change.event.queues": 1, "field.exclude.list": None, "latest.commit.log.only": False, "decimal.handling.mode": "DOUBLE",
    "varint.handling.mode": "LONG", "event.order.guarantee.mode": "COMMITLOG_FILE", "commit.log.processor.shutdown.timeout.seconds": 5,
    "tombstones.on.delete": False, "poll.interval.ms": 1000, "max.queue.size": 8192, "max.batch.size": 2048,
}

_ENUMS = {
    "snapshot.mode": ("ALWAYS", "INITIAL", "NEVER"), "decimal.handling.mode": ("DOUBLE", "PRECISE", "STRING"),
    "varint.handling.mode": ("LONG", "PRECISE", "STRING"), "event.order.guarantee.mode": ("COMMITLOG_FILE", "PARTITION_VALUES"),
}
#: Keys of the store's own client and node, which have no counterpart here; setting one is told, not obeyed.
WITHOUT_EFFECT = {
    "snapshot.consistency": "tables are read by Spark", "driver.config.file": "there is no store client", "node.id": "only checked in hosted mode, where it names the node",
    "poll.interval.ms": "the end of a micro-batch starts the next", "max.batch.size": "a batch is bounded by max.queue.size",
}
#: Bytes of log that a place in the queue stands for.
QUEUE_PLACE = 1024

_REQUIRED = ("offset.backing.store.dir", "commit.log.relocation.dir")
_POSITIVE = (
    "num.of.change.event.queues", "commit.log.marked.complete.poll.interval.ms", "cdc.dir.poll.interval.ms", "snapshot.scan.interval.ms",
    "commit.log.relocation.dir.poll.interval.ms", "schema.refresh.interval.ms", "max.queue.size", "max.batch.size",
)


def _typed(key: str, value: object) -> object:
    default = DEFAULTS.get(key)
    if isinstance(default, bool):
        return value if isinstance(value, bool) else str(value).strip().lower() == "true"
    if isinstance(default, int):
        return int(value)  # type: ignore[call-overload]
    if key in _ENUMS:
        return str(value).upper()
    return value


@dataclass
class Config:
    values: dict[str, object] = field(default_factory=dict)

    @classmethod
    def of(cls, given: Mapping[str, object]) -> Config:
        return cls({k: _typed(k, v) for k, v in given.items() if v is not None})

    @classmethod
    def from_properties(cls, text: str) -> Config:
        """``key=value`` lines; ``#`` starts a comment line."""
        lines = (x.strip() for x in text.splitlines())
        return cls.of(dict((p.strip() for p in x.split("=", 1)) for x in lines if x and not x.startswith("#") and "=" in x))

    def __getitem__(self, key: str) -> object:
        return self.values.get(key, DEFAULTS.get(key))

    def with_prefix(self, prefix: str) -> dict[str, object]:
        """Keys under a prefix, with the prefix taken off (producer, transfer and converter settings)."""
        return {k[len(prefix) :]: v for k, v in self.values.items() if k.startswith(prefix)}

    def without_effect(self) -> dict[str, str]:
        """Keys that are set to other than their default and change nothing here, with the reason."""
        return {k: why for k, why in WITHOUT_EFFECT.items() if k in self.values and self.values[k] != DEFAULTS[k]}

    def printable(self) -> dict[str, object]:
        """Without keys that name users or passwords."""
        return {k: v for k, v in self.values.items() if not any(x in k.lower() for x in ("username", "password"))}

    def validate(self, runtime: bool = False) -> list[str]:
        """What is wrong, in words; ``runtime`` checks the hosted mode, which needs a node id in place of an offset folder."""
        wrong = [f"{k} is required" for k in _REQUIRED if not self[k] and not (runtime and k == "offset.backing.store.dir")]
        if runtime and not self["node.id"]:
            wrong.append("node.id is required")
        if runtime and self["num.of.change.event.queues"] != 1:
            wrong.append("num.of.change.event.queues must be 1 in hosted mode")
        wrong += [f"{k} must be positive, not {self[k]}" for k in _POSITIVE if int(self[k]) <= 0]  # type: ignore[call-overload]
        wrong += [f"{k} must be one of {', '.join(v)}, not {self[k]}" for k, v in _ENUMS.items() if self[k] not in v]
        try:
            parse_excludes(self["field.exclude.list"])  # type: ignore[arg-type]
        except ValueError as e:
            wrong.append(str(e))
        return wrong
