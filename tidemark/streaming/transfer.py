"""What happens to a segment once its events are out: archive, error folder, deletion, or a custom hook."""

from __future__ import annotations

import importlib
import re
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

from pyspark.sql import SparkSession

from ..functions.position import SEGMENT

#: Fixed value: segments that are handed over at a time.
THREADS = 10
OK, ERROR, DOES_NOT_EXIST, COMPLETED_PREMATURELY = "OK", "ERROR", "DOES_NOT_EXIST", "COMPLETED_PREMATURELY"


class Transfer(Protocol):
    def on_success(self, path: str) -> None: ...
    def on_error(self, path: str) -> None: ...
    def error_files(self) -> list[str]: ...


class Files:
    """Moves and deletions through Hadoop's file system, so any store that Spark reaches will do."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def path(self, text: str):
        p = self.jvm.org.apache.hadoop.fs.Path(text)
        return p, p.getFileSystem(self.conf)

    def exists(self, text: str) -> bool:
        p, fs = self.path(text)
        return fs.exists(p)

    def names(self, folder: str) -> list[str]:
        p, fs = self.path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def move(self, text: str, folder: str) -> None:
        p, fs = self.path(text)
        target, _ = self.path(folder)
        fs.mkdirs(target)
        if fs.exists(p):
            fs.rename(p, self.jvm.org.apache.hadoop.fs.Path(target, p.getName()))

    def delete(self, text: str) -> None:
        p, fs = self.path(text)
        fs.delete(p, False)


def index_of(segment_path: str) -> str:
    return re.sub(r"\.log$", "_cdc.idx", segment_path)


def _checked(path: str) -> str:
    name = path.rsplit("/", 1)[-1]
    if not re.fullmatch(SEGMENT, name):
        raise ValueError(f"not a segment: {name}")
    return path


class Relocation:
    """Archive on success, error folder on failure; the index file goes along."""

    def __init__(self, spark: SparkSession, relocation_dir: str):
        self.files, self.root = Files(spark), relocation_dir.rstrip("/")

    def _move(self, path: str, folder: str) -> None:
        self.files.move(_checked(path), f"{self.root}/{folder}")
        self.files.move(index_of(path), f"{self.root}/{folder}")

    def on_success(self, path: str) -> None:
        self._move(path, "archive")

    def on_error(self, path: str) -> None:
        self._move(path, "error")

    def error_files(self) -> list[str]:
        return [f"{self.root}/error/{n}" for n in self.files.names(f"{self.root}/error") if re.fullmatch(SEGMENT, n)]

    def drain(self, transfer: Transfer) -> dict[str, int]:
        """Hand over what lies in both folders, several segments at a time, oldest first."""
        done = {}
        with ThreadPoolExecutor(THREADS) as pool:
            for folder, hand in (("archive", transfer.on_success), ("error", transfer.on_error)):
                names = [n for n in self.files.names(f"{self.root}/{folder}") if re.fullmatch(SEGMENT, n)]
                names.sort(key=lambda n: int(re.fullmatch(SEGMENT, n)[1]))
                done[folder] = len(list(pool.map(lambda n, f=folder, h=hand: h(f"{self.root}/{f}/{n}"), names)))
        return done


class Deletion:
    """Delete segments either way; refuses files that are not segments."""

    def __init__(self, spark: SparkSession):
        self.files = Files(spark)

    def on_success(self, path: str) -> None:
        self.files.delete(_checked(path))
        self.files.delete(index_of(path))

    on_error = on_success

    def error_files(self) -> list[str]:
        return []


def load_transfer(path: str, spark: SparkSession, settings: Mapping[str, object]) -> Transfer:
    """A transfer by the dotted name of its class, made from the session and its own settings."""
    module, _, name = path.rpartition(".")
    try:
        made = getattr(importlib.import_module(module), name)
    except (ImportError, AttributeError, ValueError) as e:
        raise ValueError(f"commit.log.transfer.class: no such class: {path}") from e
    return made(spark, dict(settings))
