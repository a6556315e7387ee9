"""Files as a Python data source: listed, hashed in chunks and read in byte ranges, in batch and as a stream.

``spark.dataSource.register(FileBytes)``, then ``spark.read.format("file_bytes")`` or
``spark.readStream.format("file_bytes")`` with the options

* ``path`` (required) and ``suffix`` (any case; all files if empty);
* ``mode``: ``digests`` (one row per file) or ``ranges`` (the bytes of every file in pieces);
* ``chunkBytes``: bytes that are held at once, and the size of a piece (4 MiB);
* ``log`` (streams): a folder for the names that the stream has seen.

Files are opened through ``pyarrow.fs``: local paths, ``hdfs://`` (with libhdfs) and ``s3://`` or
``s3a://``; any other scheme is refused by name. No file needs to fit in memory.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

DIGESTS = "path string, name string, length bigint, modified timestamp, sha256 string"
RANGES = "path string, name string, length bigint, offset bigint, content binary"
CHUNK = 4 << 20
#: Bytes of files that one task reads, about, and files at most.
TASK_BYTES, TASK_FILES = 256 << 20, 2000
#: Beyond so many tasks of ranges, a task takes more bytes than it was asked to, but not more than ``TASK_BYTES`` for that.
MANY_TASKS = 1000
#: What opening a file costs, in bytes.
OPEN_BYTES = 4 << 10


def open_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it."""
    uri = path.replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1)
    scheme = uri.split("://", 1)[0] if "://" in uri else "file"
    if scheme not in ("file", "hdfs", "s3", "gs", "abfs", "abfss"):
        raise ValueError(f"files at {scheme}:// can't be opened by tasks; copy them to a local, hdfs or s3 path")
    if uri.startswith("file:") or "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


@dataclass
class Range(InputPartition):
    """Bytes ``start`` to ``end`` of one file."""

    path: str
    length: int
    start: int
    end: int


@dataclass
class Ranges(InputPartition):
    """Ranges of files that one task reads."""

    held: list[Range]


@dataclass
class Files(InputPartition):
    """Whole files: path, length, time of last change in microseconds."""

    found: list[tuple[str, int, int]]


def listed(path: str, suffix: str) -> list[tuple[str, int, int]]:
    """path, length, modified of all files below the folder (or of the file itself), by path.

    Names that begin with a dot or an underscore are left out, as by Spark's own sources.
    """
    system, place = open_system(path)
    info = system.get_file_info(place)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    infos = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(place, recursive=True))

    def shown(i: fs.FileInfo) -> bool:
        below = i.path[len(place.rstrip("/")) :].strip("/").split("/") if i.path != place else []
        return i.type == fs.FileType.File and i.path.lower().endswith(suffix.lower()) and not any(p[:1] in "._" for p in below)

    return sorted((i.path, i.size, (i.mtime_ns or 0) // 1000) for i in infos if shown(i))


def _ranges_of(found: list[tuple[str, int, int]], chunk: int, task_bytes: int) -> list[InputPartition]:
    """Tasks of ranges of ``task_bytes`` at most, or of more where these would be more than MANY_TASKS.

    So every file is cut at the same places as a file alone, and many small files or ranges share a task.
    """
    step = max(chunk, task_bytes // chunk * chunk)
    cost = sum(n + OPEN_BYTES * max(1, -(-n // step)) for _, n, _ in found)
    room = min(TASK_BYTES, cost // MANY_TASKS)
    tasks: list[Ranges] = []
    left = 0
    for path, length, _ in found:
        for at in range(0, max(length, 1), step):
            end = min(length, at + step)
            need = end - at + OPEN_BYTES
            if not tasks or need > left:
                tasks.append(Ranges([]))
                left = room
            held = tasks[-1].held
            if at and held and held[-1].path == path:
                held[-1].end = end
            else:
                held.append(Range(path, length, at, end))
            left -= need
    return [t.held[0] if len(t.held) == 1 else t for t in tasks]


def partitions_of(found: list[tuple[str, int, int]], mode: str, chunk: int, task_bytes: int = TASK_BYTES) -> list[InputPartition]:
    """Tasks of about ``task_bytes``: files together for digests, ranges of files else."""
    if mode == "ranges":
        return _ranges_of(found, chunk, task_bytes)
    tasks: list[Files] = []
    room = 0
    for f in found:
        if not tasks or f[1] > room or len(tasks[-1].found) >= TASK_FILES:
            tasks.append(Files([]))
            room = task_bytes
        tasks[-1].found.append(f)
        room -= f[1]
    return tasks


def rows_of(task: InputPartition, root: str, chunk: int) -> Iterator[tuple]:
    """The rows of a task; ``chunk`` bytes are in memory at a time."""
    import datetime

    system, _ = open_system(root)
    if isinstance(task, (Range, Ranges)):
        for r in task.held if isinstance(task, Ranges) else [task]:
            with system.open_input_file(r.path) as f:
                for at in range(r.start, max(r.end, r.start + 1), chunk):
                    f.seek(at)
                    yield r.path, r.path.rsplit("/", 1)[-1], r.length, at, f.read(min(chunk, r.end - at))
        return
    for path, length, modified in task.found:
        digest = hashlib.sha256()
        with system.open_input_stream(path) as f:
            while piece := f.read(chunk):
                digest.update(piece)
        when = datetime.datetime.fromtimestamp(modified / 1e6, datetime.timezone.utc)
        yield path, path.rsplit("/", 1)[-1], length, when, digest.hexdigest()


class _Options:
    def __init__(self, options: dict):
        if not options.get("path"):
            raise ValueError("file_bytes needs a path")
        self.path, self.suffix = options["path"], options.get("suffix", "")
        self.mode, self.chunk = options.get("mode", "digests"), int(options.get("chunkBytes", CHUNK))
        self.task_bytes, self.log = int(options.get("taskBytes", TASK_BYTES)), options.get("log")
        if self.mode not in ("digests", "ranges"):
            raise ValueError("mode must be digests or ranges")


class FileBytes(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_bytes"

    def schema(self) -> str:
        return RANGES if _Options(self.options).mode == "ranges" else DIGESTS

    def reader(self, schema) -> DataSourceReader:
        return _Batch(_Options(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return _Stream(_Options(self.options))


class _Batch(DataSourceReader):
    def __init__(self, options: _Options):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        o = self.options
        return partitions_of(listed(o.path, o.suffix), o.mode, o.chunk, o.task_bytes) or [Files([])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return rows_of(partition, self.options.path, self.options.chunk)


class _Stream(DataSourceStreamReader):
    """An offset is the number of listings that brought new files.

    Each listing that finds files whose (path, length, time of change) were not seen yet writes them to the log as
    the next entry before it is offered as an offset. So a file counts when it is first seen, whatever its time
    stamp says, a changed file counts again, and a restarted query reads the same files for the same offsets.
    Spark hands the reader to every task: what was seen is read from the log when files are listed, on the driver,
    and stays there.
    """

    def __init__(self, options: _Options):
        if not options.log:
            raise ValueError("a stream of file_bytes needs a log folder")
        self.options = options
        self.system, self.folder = open_system(options.log)
        self.system.create_dir(self.folder, recursive=True)
        self.entries, self.seen = 0, set()

    def __getstate__(self) -> dict:
        return {**self.__dict__, "entries": 0, "seen": set()}

    def _read_log(self) -> None:
        while self._has(self.entries + 1):
            self.entries += 1
            self.seen.update(self._entry(self.entries))

    def _has(self, n: int) -> bool:
        return self.system.get_file_info(f"{self.folder}/{n}.json").type == fs.FileType.File

    def _entry(self, n: int) -> list[tuple]:
        with self.system.open_input_stream(f"{self.folder}/{n}.json") as f:
            return [tuple(x) for x in json.loads(f.read())]

    def initialOffset(self) -> dict:  # noqa: N802
        return {"listing": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        self._read_log()
        new = [f for f in listed(self.options.path, self.options.suffix) if f not in self.seen]
        if new:
            self.entries += 1
            name = f"{self.folder}/{self.entries}.json"
            with self.system.open_output_stream(f"{name}.part") as f:
                f.write(json.dumps(new).encode())
            self.system.move(f"{name}.part", name)
            self.seen.update(new)
        return {"listing": self.entries}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        found = [f for n in range(start["listing"] + 1, end["listing"] + 1) for f in self._entry(n)]
        return partitions_of(found, self.options.mode, self.options.chunk, self.options.task_bytes)

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return rows_of(partition, self.options.path, self.options.chunk)

    def commit(self, end: dict) -> None:
        pass
