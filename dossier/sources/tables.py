"""Readers for the parquet tables and the folder-tree file listing."""

from __future__ import annotations

import heapq
import os
import zlib
from collections.abc import Iterator, Sequence
from itertools import islice

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

LISTING_BATCH = 10_000


def read_table(spark: SparkSession, base_dir: str, name: str, columns: Sequence[str] | None = None,
               tasks: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """``<base_dir>/<name>.parquet``; selecting ``columns`` up front keeps the
    scan's ReadSchema to what the query uses. ``tasks`` deals the rows out to so
    many tasks by their unique ``keys``, for files that can't be split; without
    it the scan's own splits are the tasks and nothing is shuffled."""
    df = spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")
    df = df.select(*columns) if columns else df
    return df.repartition(tasks, *keys) if tasks else df


def folder_source() -> type[DataSource]:
    """The data source ``role_folders``: ``(application_role, file_name)`` for every
    file directly inside a direct subfolder of ``path``. Options: ``parts``, how many
    tasks list a folder (each keeps the names of its hash); ``tasks``, into how many
    tasks all parts are put together; ``max_files``, so many first names of each part
    are enough. Its classes are made here to travel to the executors by value."""

    class Part(InputPartition):
        def __init__(self, folders: list[tuple[str, int]]):
            super().__init__(folders)
            self.folders = folders  # (role, part of its names)

    class Reader(DataSourceReader):
        def __init__(self, options: dict[str, str]):
            self.uri, self.parts = options["path"].rstrip("/"), int(options.get("parts", 1))
            self.tasks = int(options["tasks"]) if "tasks" in options else None
            self.max_files = int(options["max_files"]) if "max_files" in options else None

        def partitions(self) -> list[InputPartition]:
            fs, root = pafs.FileSystem.from_uri(self.uri)
            roles = sorted(f.base_name for f in fs.get_file_info(pafs.FileSelector(root)) if f.type == pafs.FileType.Directory)
            every = [(r, i) for r in roles for i in range(self.parts)]
            n = min(self.tasks or len(every), len(every))
            return [Part(every[i::n]) for i in range(n)]

        def names(self, role: str) -> Iterator[str]:
            """One after the other on a local or mounted path; elsewhere ``pyarrow.fs``
            gives a folder's names at once."""
            fs, root = pafs.FileSystem.from_uri(self.uri)
            if isinstance(fs, pafs.LocalFileSystem):
                with os.scandir(f"{root}/{role}") as found:
                    yield from (os.fsencode(f.name).decode("utf-8", "replace") for f in found if f.is_file())
            else:
                yield from (f.base_name for f in fs.get_file_info(pafs.FileSelector(f"{root}/{role}"))
                            if f.type == pafs.FileType.File)

        def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
            for role, part in partition.folders if partition else []:
                names = self.names(role)
                if self.parts > 1:
                    names = (x for x in names if zlib.crc32(x.encode()) % self.parts == part)
                if self.max_files is not None:
                    names = iter(heapq.nsmallest(self.max_files, names))
                while own := list(islice(names, LISTING_BATCH)):
                    yield pa.RecordBatch.from_arrays([pa.array([role] * len(own), pa.string()), pa.array(own, pa.string())],
                                                     names=["application_role", "file_name"])

    class RoleFolders(DataSource):
        @classmethod
        def name(cls) -> str:
            return "role_folders"

        def schema(self) -> str:
            return "application_role string, file_name string"

        def reader(self, schema: StructType) -> DataSourceReader:
            return Reader(self.options)

    return RoleFolders


def list_folder_tree(spark: SparkSession, base_dir: str, tasks: int | None = None, parts: int = 1,
                     max_files: int | None = None) -> DataFrame:
    """S3 listing: ``(application_role, file_name)`` for every file directly
    inside a direct subfolder of ``base_dir``, whatever its name or extension.
    Only the names of the role folders are read first; tasks list the folders,
    without those below, and pass the names on in batches. A large folder can be
    listed by several tasks (``parts``). ``max_files``: only the first names of
    each role are wanted; at least these come, at most so many a part. Contents are
    never read. ``base_dir`` is a local path or a URI that ``pyarrow.fs`` knows,
    and every executor can reach it."""
    spark.dataSource.register(folder_source())
    reader = spark.read.format("role_folders").option("path", base_dir).option("parts", parts)
    for name, value in (("tasks", tasks), ("max_files", max_files)):
        reader = reader if value is None else reader.option(name, value)
    return reader.load()
