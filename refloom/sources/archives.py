"""Zip archives read by path, one member at a time.

A data source plans its partitions from the archives' directories: a large member is a partition, small ones share one. A task opens the
archive where it lies, goes to its member and inflates it as a stream, so neither an archive nor a member is ever held
whole, and archives may be of any size.
"""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from refloom.sources.documents import decode_fallback, zip_members

#: Compressed bytes that make a partition of small members.
PARTITION_BYTES = 64 << 20
#: Lines, or bytes, that leave a task at once.
BATCH_LINES, BATCH_BYTES = 20_000, 4 << 20
#: Bytes of an archive that is opened in memory.
SMALL = 1 << 10
#: Archives whose directories are read at a time while planning.
PLANNERS = 32


def located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it, of any file system that Arrow knows."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path)


def open_file(path: str) -> pa.NativeFile:
    """A file of any file system that Arrow knows, for reading at any place in it."""
    system, at = located(path)
    return system.open_input_file(at)


def open_archive(path: str) -> zipfile.ZipFile:
    """An archive for reading. Its directory is looked for from the end of the file backwards, and Arrow's files fail where that leads before the
    first byte, as in an archive without members; so the smallest ones are opened in memory."""
    file = open_file(path)
    return zipfile.ZipFile(io.BytesIO(file.read()) if file.size() < SMALL else file)


def write_archives(df: DataFrame, path: str, name: str, content: str) -> None:
    """One archive per task below a shared folder, with a member per row: its name and its content. A task that runs again replaces its archive."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = located(path)
        system.create_dir(folder, recursive=True)
        at = f"{folder}/part-{TaskContext.get().partitionId():06d}.zip"
        with system.open_output_stream(at) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            for batch in batches:
                for member, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    archive.writestr(member, data)
        yield pa.RecordBatch.from_arrays([pa.array([at])], names=["path"])

    df.select(name, F.col(content).cast("binary")).mapInArrow(write, "path string").write.format("noop").mode("overwrite").save()


@dataclass
class Members(InputPartition):
    """Members (archive, name) that one task reads."""

    members: list[tuple[str, str]]


class ZipReader(DataSourceReader):
    def __init__(self, paths: list[str], suffix: str, whole: bool, size: int):
        self.paths, self.suffix, self.whole, self.size = paths, suffix, whole, size

    def _listed(self, path: str) -> list[tuple[str, str, int]]:
        with open_archive(path) as archive:
            found = [i for i in archive.infolist() if not i.is_dir() and i.filename.lower().endswith(self.suffix)]
            return [(path, i.filename, i.compress_size) for i in found]

    def partitions(self) -> list[Members]:
        out, held, size = [], [], 0
        with ThreadPoolExecutor(PLANNERS) as pool:
            for listed in pool.map(self._listed, self.paths):
                for path, name, n in listed:
                    if held and size + n > self.size:
                        out.append(Members(held))
                        held, size = [], 0
                    held.append((path, name))
                    size += n
        return out + [Members(held)]

    def read(self, partition: Members) -> Iterator[pa.RecordBatch]:
        path, archive = None, None
        for at, name in partition.members:
            if at != path:
                path, archive = at, open_archive(at)
            with archive.open(name) as member:
                if self.whole:
                    yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([name]), pa.array([member.read()], pa.binary())], names=["archive", "member", "content"])
                else:
                    yield from _lines(at, name, member)


def _lines(path: str, name: str, member) -> Iterator[pa.RecordBatch]:
    rows, size, start = [], 0, 0

    def batch() -> pa.RecordBatch:
        n = len(rows)
        arrays = [pa.array([path] * n), pa.array([name] * n), pa.array(range(start, start + n), pa.int64()), pa.array(rows, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["archive", "member", "pos", "raw"])

    for line in member:
        rows.append(line.rstrip(b"\r\n"))
        size += len(line)
        if len(rows) >= BATCH_LINES or size >= BATCH_BYTES:
            yield batch()
            rows, size, start = [], 0, start + len(rows)
    if rows:
        yield batch()


class ZipSource(DataSource):
    """``spark.read.format("zip_members")``: options ``paths`` (a JSON list), ``suffix``, ``whole`` and ``partitionBytes``."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def _whole(self) -> bool:
        return self.options.get("whole", "false").lower() == "true"

    def schema(self) -> str:
        rest = "content binary" if self._whole() else "pos long, raw binary"
        return f"archive string, member string, {rest}"

    def reader(self, schema) -> ZipReader:
        size = int(self.options.get("partitionBytes", PARTITION_BYTES))
        return ZipReader(json.loads(self.options["paths"]), self.options.get("suffix", ""), self._whole(), size)


def read_zip_members(
    spark: SparkSession, path: str | list[str], suffix: str, raw: bool = False, partition_bytes: int = PARTITION_BYTES
) -> DataFrame:
    """Members of zip archives by suffix, line by line: (archive, member, pos, line), or whole: (archive, member, content).

    Paths, folders and patterns are listed by Spark; only the names of the archives pass through the driver, as in any file source. In a store that
    only Spark can open, archives are read as binary values instead, of at most 2 GiB each.
    """
    files = spark.read.format("binaryFile").load(path)
    names = sorted(r["path"] for r in files.select("path").toLocalIterator())
    try:
        for name in names[:1]:
            located(name)
    except pa.ArrowInvalid:
        return zip_members(files, suffix, raw)
    spark.dataSource.register(ZipSource)
    options = {"paths": json.dumps(names), "suffix": suffix.lower(), "whole": str(raw), "partitionBytes": str(partition_bytes)}
    rows = spark.read.format("zip_members").options(**options).load()
    return rows if raw else rows.withColumn("line", decode_fallback("raw")).drop("raw")
