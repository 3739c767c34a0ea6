"""A streaming source over mutation-log segments that honours their index files.

A segment is a JSON-lines file; its index names how many bytes are synced and
whether the segment is complete.  In real-time mode the synced lines of an
incomplete segment are read as it grows; otherwise a segment waits until it is
complete.  An offset is, for each segment, the bytes read (always the end of a
line) and whether its end was reached, so a restart goes on where it was.  The
last row of a complete segment says that it is (``eof``; a row without mutation
if there is no line left): only then may the segment be archived.  Segments are
read in order: one is begun when the one before it has ended.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..functions.position import INDEX, SEGMENT
from ..sources.binary import Decoder
from ..sources.mutation_log import LINES as COLUMNS
from ..sources.mutation_log import parsed

#: Bytes of a segment that one task reads, of an Arrow batch, and of a step back in search of a line's end.
SLICE, BATCH, STEP = 64 << 20, 4 << 20, 64 << 10


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def readable_bytes(index_text: str, real_time: bool) -> int:
    """Bytes of a segment that may be read, from its index file's text."""
    synced, done = parse_index(index_text)
    return synced if done or real_time else 0


def parse_index(text: str) -> tuple[int, bool]:
    """Synced bytes, and whether the segment is complete: exactly two lines, the second COMPLETED."""
    lines = text.removesuffix("\n").split("\n")
    done = len(lines) == 2 and lines[1] == "COMPLETED"
    return (int(lines[0]) if lines[0].strip().isdigit() else 0), done


def line_end(files: pafs.FileSystem, path: str, low: int, high: int) -> int:
    """The end of the last whole line in the bytes from ``low`` to ``high`` of a file; ``low`` if there is none."""
    with files.open_input_file(path) as f:
        at = high
        while at > low:
            start = max(low, at - STEP)
            f.seek(start)
            if (found := f.read(at - start).rfind(b"\n")) >= 0:
                return start + found + 1
            at = start
    return low


def next_line(files: pafs.FileSystem, path: str, low: int, high: int) -> int:
    """The end of the first whole line after ``low``; ``high`` if none ends before."""
    with files.open_input_file(path) as f:
        for at in range(low, high, STEP):
            f.seek(at)
            if (found := f.read(min(STEP, high - at)).find(b"\n")) >= 0:
                return at + found + 1
    return high


def checkpointed(folder: str) -> dict:
    """The last offsets that a query's checkpoint has planned; a batch planned but not finished runs again to these offsets."""
    files, root = _open(folder)
    names = [f.base_name for f in files.get_file_info(pafs.FileSelector(f"{root}/offsets", allow_not_found=True)) if f.base_name.isdigit()]
    if not names:
        return {}
    with files.open_input_stream(f"{root}/offsets/{max(names, key=int)}") as s:
        last = s.read().decode().rstrip("\n").split("\n")[-1]
    return json.loads(last) if last.startswith("{") else {}


class Slice(InputPartition):
    """Lines of a segment that begin in ``[start, end)``; the first slice of an offset range begins at a line, others find one."""

    def __init__(self, path: str, start: int, end: int, stop: int, first: bool, eof: bool):
        super().__init__(None)
        self.path, self.start, self.end, self.stop, self.first, self.eof = path, start, end, stop, first, eof


class LogReader(DataSourceStreamReader):
    """Segments of JSON lines, or with a decoder the store's binary ones, whose offsets are ends of synced sections."""

    def __init__(self, folder: str, real_time: bool, max_bytes: int = 0, checkpoint: str = "", decoder: Decoder | None = None):
        self.folder, self.real_time, self.max_bytes, self.decoder = folder.rstrip("/"), real_time, max_bytes, decoder
        self.at = checkpointed(checkpoint) if checkpoint and max_bytes else {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """How far each segment may be read, in order: nothing of a segment before the end of the one before it, as offsets
        are high-water marks and would take what comes late for processed.  With a limit, at least one line."""
        files, root = _open(self.folder)
        seen = []
        for f in files.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
            if m := re.fullmatch(INDEX, f.base_name):
                try:
                    with files.open_input_stream(f.path) as s:
                        seen.append((int(m[1]), f.base_name.replace("_cdc.idx", ".log"), *parse_index(s.read().decode())))
                except FileNotFoundError:
                    continue  # archived meanwhile
        out, left = {}, self.max_bytes or None
        for _, name, synced, done in sorted(seen):
            known, ended = self.at.get(name, (0, False)) if left is not None else (0, False)
            if not (done or self.real_time):
                break
            end = synced if done or self.decoder else line_end(files, f"{root}/{name}", known, synced)
            if left is not None and not ended:
                if end - known > left and self.decoder:  # a segment's size is bounded by the store: all of it, or nothing yet
                    end, done = (end, done) if left == self.max_bytes else (known, False)
                elif end - known > left:
                    cut = line_end(files, f"{root}/{name}", known, known + left) if left > 0 else known
                    if cut == known and left == self.max_bytes:
                        cut = next_line(files, f"{root}/{name}", known, end)
                    end, done = cut, done and cut == end
                left = max(0, left - (end - known))
            if end or done:
                out[name] = [end, done]
            if not done:
                break
        if left is not None:
            self.at = out
        return out

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        _, root = _open(self.folder)
        out: list[InputPartition] = []
        for name, (stop, done) in end.items():
            low, ended = start.get(name, (0, False))
            if stop <= low and done == ended:
                continue
            cuts = [*range(low, stop, SLICE), stop] if stop > low and not self.decoder else [low, stop]
            out += [Slice(f"{root}/{name}", a, b, stop, a == low, done and b == stop) for a, b in zip(cuts, cuts[1:], strict=False)]
        return out

    def read(self, part: Slice) -> Iterator[pa.RecordBatch]:
        files, _ = _open(self.folder)
        if self.decoder:
            with files.open_input_file(part.path) as f:
                yield from self.decoder.batches(part.path.rsplit("/", 1)[-1], f.read(part.stop), part.start, part.eof)
            return
        name, held, size = part.path.rsplit("/", 1)[-1], [], 0

        def batch(eof: bool = False) -> pa.RecordBatch:
            """What is held; the last row of a segment says so, a row of its own if there is no line left."""
            rows = [(at, x.decode(errors="replace")) for at, x in held] or [(part.stop, None)]
            columns = [[name] * len(rows), [at for at, _ in rows], [x for _, x in rows], [False] * (len(rows) - 1) + [eof]]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, COLUMNS, strict=True)], schema=COLUMNS)

        if part.end > part.start:
            start = part.start if part.first else next_line(files, part.path, part.start - 1, part.stop)
            with files.open_input_file(part.path) as f:
                for at, line in lines_from(f, start, part.end, part.stop):
                    if line.strip():
                        held.append((at, line))
                        size += len(line)
                    if size >= BATCH:
                        yield batch()
                        size = 0
        if held or part.eof:
            yield batch(part.eof)


def lines_from(f: pa.NativeFile, start: int, end: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """``(offset, line)`` of the lines that begin in ``[start, end)``; lines end at a newline byte, or at ``stop``."""
    f.seek(start)
    at, rest = start, b""
    while at < end:
        data = f.read(min(BATCH, stop - at - len(rest)))
        if not data:
            if rest:
                yield at, rest
            return
        *whole, rest = (rest + data).split(b"\n")
        for line in whole:
            if at >= end:
                return
            yield at, line
            at += len(line) + 1


class MutationLogSource(DataSource):
    """Format ``tidemark_log``: rows ``(file, at, mutation, eof)``, the mutation as JSON text.

    Options: ``realTime``; ``maxBytesPerTrigger``, which needs the query's ``checkpoint`` to go on after a restart; ``tables``,
    JSON of table specs by id, for binary segments."""

    @classmethod
    def name(cls) -> str:
        return "tidemark_log"

    def schema(self) -> str:
        return "file string, at long, mutation string, eof boolean"

    def streamReader(self, schema) -> LogReader:
        option = lambda name, default: self.options.get(name, default)
        decoder = Decoder.from_json(option("tables", "")) if option("tables", "") else None
        return LogReader(option("path", ""), str(option("realTime", "false")).lower() == "true", int(option("maxBytesPerTrigger", 0)), option("checkpoint", ""), decoder)


def read_stream(spark: SparkSession, folder: str, real_time: bool = False, max_bytes: int = 0, checkpoint: str = "", decoder: Decoder | None = None) -> DataFrame:
    """The log as a stream with the columns of ``LOG_SCHEMA``, ``at``, ``eof`` and ``broken``; with a decoder, of binary segments."""
    spark.dataSource.register(MutationLogSource)
    options = {"realTime": str(real_time).lower(), "maxBytesPerTrigger": str(max_bytes), "checkpoint": checkpoint, "tables": decoder.to_json() if decoder else ""}
    return parsed(spark.readStream.format("tidemark_log").options(**options).load(folder))


def write_segment(folder: str, name: str, mutations: list[dict], completed: bool = True, synced: int | None = None) -> None:
    """A segment and its index, for tests and small tools."""
    files, root = _open(folder)
    files.create_dir(root, recursive=True)
    body = "".join(json.dumps(m, ensure_ascii=False) + "\n" for m in mutations).encode()
    with files.open_output_stream(f"{root}/{name}") as f:
        f.write(body)
    write_index(folder, name, len(body) if synced is None else synced, completed)


def adopt(spark: SparkSession, staged: str, folder: str) -> dict[str, int]:
    """Segments from text that Spark has written by ``file=<name>``, one part each, moved into ``folder``; their sizes."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    files = path(staged).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path(folder))
    sizes = {}
    for s in files.globStatus(path(f"{staged}/file=*/part-*")):
        name = s.getPath().getParent().getName().removeprefix("file=")
        if name in sizes:
            raise ValueError(f"{name} is in several parts")
        sizes[name] = s.getLen()
        files.rename(s.getPath(), path(f"{folder}/{name}"))
    return sizes


def write_index(folder: str, name: str, synced: int, completed: bool) -> None:
    files, root = _open(folder)
    with files.open_output_stream(f"{root}/{name.replace('.log', '_cdc.idx')}") as f:
        f.write(f"{synced}\n{'COMPLETED' if completed else ''}".encode())
