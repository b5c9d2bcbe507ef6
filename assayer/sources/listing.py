"""Folder listings as a data source: spark.read.format("plain_files").load(folder).

Spark's own listing drops names that begin with _ or . and follows links. This one gives every entry but what office
programs and file managers leave behind: path (relative to the folder), full, kind (file, folder, link or unreadable) and
bytes of a file. Links are told and never followed; unreadable is a folder that can't be opened.

The folder is split breadth-first: the driver opens folders from the top until there are `splits` of them or no more
below, and each task walks its share of these. The driver keeps names of folders alone. The folder must be one that
the driver and all executors see. Options: splits (64); recursive (true), else only the folder's own entries, which
FLAT tasks divide by the CRC-32 of their names: each reads all names and asks the file system about its own.
"""

from __future__ import annotations

import os
import zlib
from collections import deque
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import LEFT_BEGINNINGS, LEFT_BEHIND

FLAT = 16
SCHEMA = "path string, full string, kind string, bytes long"
Entry = tuple[str, str, str, int | None]


def entries(folder: str) -> Iterator[os.DirEntry]:
    with os.scandir(folder) as found:
        for entry in found:
            left = entry.name in LEFT_BEHIND or entry.name.startswith(LEFT_BEGINNINGS)
            if not left or entry.is_dir(follow_symlinks=False):
                yield entry


class Folders(InputPartition):
    """Folders relative to the root, and of each whether what lies below it belongs to it; of their entries, those whose
    names' CRC-32 leaves `rest` modulo `of`."""

    def __init__(self, folders: list[tuple[str, bool]], rest: int = 0, of: int = 1):
        super().__init__(folders)
        self.rest, self.of = rest, of


class ListingReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root = os.path.abspath(options["path"])
        self.splits = int(options.get("splits", "64"))
        self.recursive = options.get("recursive", "true").lower() == "true"

    def partitions(self) -> list[InputPartition]:
        if not self.recursive:
            return [Folders([("", False)], k, FLAT) for k in range(FLAT)]
        opened: list[str] = []
        waiting = deque([""])
        while waiting and len(waiting) < self.splits:
            folder = waiting.popleft()
            opened.append(folder)
            try:
                below = sorted(e.name for e in entries(os.path.join(self.root, folder)) if e.is_dir(follow_symlinks=False))
            except OSError:  # its task tells
                continue
            waiting += [os.path.join(folder, name) for name in below]
        share: list[list[tuple[str, bool]]] = [[] for _ in range(max(1, min(self.splits, len(opened) + len(waiting))))]
        for k, one in enumerate([*((f, True) for f in waiting), *((f, False) for f in opened)]):
            share[k % len(share)].append(one)
        return [Folders(x) for x in share]

    def read(self, partition: InputPartition) -> Iterator[Entry]:
        stack = list(partition.value)
        while stack:
            folder, below = stack.pop()
            try:
                found = [e for e in entries(os.path.join(self.root, folder)) if partition.of == 1 or zlib.crc32(os.fsencode(e.name)) % partition.of == partition.rest]
            except OSError:
                if not partition.rest:
                    yield folder, os.path.join(self.root, folder), "unreadable", None
                continue
            for e in found:
                path = os.path.join(folder, e.name)
                if e.is_symlink():
                    yield path, e.path, "link", None
                elif e.is_dir():
                    yield path, e.path, "folder", None
                    if below:
                        stack.append((path, True))
                elif e.is_file():
                    yield path, e.path, "file", e.stat().st_size


class Listing(DataSource):
    @classmethod
    def name(cls) -> str:
        return "plain_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ListingReader(self.options)


def listed(spark: SparkSession, folder: object, recursive: bool = True, splits: int = 64) -> DataFrame:
    """(path, full, kind, bytes) of what lies in a folder."""
    spark.dataSource.register(Listing)
    return spark.read.format("plain_files").option("recursive", str(recursive).lower()).option("splits", splits).load(str(folder))
