"""A Python data source of files: sizes and SHA-256 digests, read chunk by chunk in executor tasks.

`spark.read.format("addrloom_digests")` takes what files it reads from `path` (one, or several
divided by line breaks); a task reads a group of files of like bytes, a chunk at a time, so no file
is a cell and none has a limit of size. A file that can't be read, or that changes while it is read,
is a row with an error, not a failed job.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappush, heapreplace

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..workers import ship_package

#: Bytes of a file that are in memory at once; files of a task at most.
CHUNK, FILES = 4 << 20, 10_000
SCHEMA = "path string, size long, sha256 string, error string"


class Group(InputPartition):
    """Files, with their sizes as they were listed, that one task reads."""

    def __init__(self, files: list[tuple[str, int]]):
        self.files = files


def groups(files: list[tuple[str, int]], tasks: int, most: int = FILES) -> list[Group]:
    """Deals files to tasks so that each has about as many bytes: the largest first, each to the task with the fewest so far. A task that is full takes no more, and further ones are begun."""
    tasks = max(1, min(len(files), max(tasks, -(-len(files) // most))))
    least: list[tuple[int, int]] = []
    out: list[list[tuple[str, int]]] = []
    for f in sorted(files, key=lambda f: (-f[1], f[0])):
        if len(out) < tasks:
            heappush(least, (f[1], len(out)))
            out.append([f])
            continue
        size, k = least[0]
        out[k].append(f)
        # A full task leaves the choice by a load that nothing undercuts.
        heapreplace(least, (size + f[1] if len(out[k]) < most else 1 << 62, k))
    return [Group(g) for g in out]


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and name on it of a path with or without a scheme."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def digest(path: str, expected: int | None = None, chunk: int = CHUNK) -> tuple[str, int | None, str | None, str | None]:
    """path, size, SHA-256, error of a file, of which a chunk at a time is in memory."""
    try:
        fs, name = opened(path)
        state, size = hashlib.sha256(), 0
        with fs.open_input_stream(name) as stream:
            while part := stream.read(chunk):
                state.update(part)
                size += len(part)
        if expected is not None and size != expected:
            return path, None, None, f"{expected} bytes when listed, {size} when read"
        return path, size, state.hexdigest(), None
    except (OSError, pa.ArrowException) as e:
        return path, None, None, f"{type(e).__name__}: {e}"[:500]


class DigestReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        listed = [x for x in options.get("path", "").split("\n") if x]
        sizes = [x for x in options.get("sizes", "").split("\n") if x]
        if sizes and len(sizes) != len(listed):
            raise ValueError("sizes have to be as many as paths")
        self.known = bool(sizes)
        self.files = [(p, int(n)) for p, n in zip(listed, sizes or ["0"] * len(listed), strict=True)]
        self.tasks, self.chunk = int(options.get("tasks", "1")), int(options.get("chunk", CHUNK))

    def partitions(self) -> list[Group]:
        return groups(self.files, self.tasks) if self.files else [Group([])]

    def read(self, partition: Group) -> Iterator[tuple]:
        for path, size in partition.files:
            yield digest(path, size if self.known else None, self.chunk)


class DigestSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "addrloom_digests"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DigestReader:
        return DigestReader(dict(self.options))


def digests(spark: SparkSession, files: list[tuple[str, int]], tasks: int = 0, chunk: int = CHUNK) -> DataFrame:
    """path, size, sha256 and error of files given by path and listed size, in `tasks` tasks (as many as the cluster has cores, if 0). No files give no rows; a path given twice is two rows."""
    ship_package(spark)
    spark.dataSource.register(DigestSource)
    tasks = tasks or spark.sparkContext.defaultParallelism
    options = {"path": "\n".join(p for p, _ in files), "sizes": "\n".join(str(n) for _, n in files), "tasks": tasks, "chunk": chunk}
    return spark.read.format("addrloom_digests").options(**options).load()
