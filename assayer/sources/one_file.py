"""One CSV file from a table of any size: df.write.format("one_csv_file").mode("overwrite").save(path).

Each task writes its rows aside, as they will stand in the file; when all are done the parts are joined in the order
of the table's partitions, behind a byte-order mark and a header, and moved into place. No row passes the driver's
session: it copies bytes from part to file. A task that runs twice leaves a part that nobody told of, which goes with
the others. The parts' folder is made before any task and by none, so that a task that outlives a failed job can't bring it
back. An empty table makes no file. The folder must be one that the driver and all executors see.
"""

from __future__ import annotations

import contextlib
import csv
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

BOM = b"\xef\xbb\xbf"


def shown(value: object) -> str:
    """A value as people read it: whole decimals without a point, nothing for null."""
    if value is None or value == "":
        return ""
    return str(int(value)) if hasattr(value, "as_tuple") and value == value.to_integral_value() else str(value)


def parts_of(path: str) -> str:
    return f"{path}.parts-{uuid.uuid4().hex}"


def removed(parts: str) -> None:
    """Takes the folder's name away first: from then on no task opens a file in it, and what is in it stays the same."""
    gone = f"{parts}-gone"
    with contextlib.suppress(FileNotFoundError):
        os.rename(parts, gone)
        shutil.rmtree(gone, ignore_errors=True)


@dataclass
class Part(WriterCommitMessage):
    at: int
    path: str | None


class OneFileWriter(DataSourceWriter):
    def __init__(self, path: str, columns: list[str], parts: str):
        self.path, self.columns, self.parts = path, columns, parts
        os.makedirs(parts, exist_ok=True)

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        at, path, out = TaskContext.get().partitionId(), None, None
        try:
            for row in iterator:
                if out is None:
                    path = os.path.join(self.parts, uuid.uuid4().hex)
                    out = open(path, "w", newline="", encoding="utf-8")  # noqa: SIM115
                    writer = csv.writer(out)
                writer.writerow([shown(v) for v in row])
        finally:
            if out:
                out.close()
        return Part(at, path)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        told = sorted((m for m in messages if m and m.path), key=lambda m: m.at)
        if told:
            whole = os.path.join(self.parts, "whole")
            with open(whole, "w", newline="", encoding="utf-8") as f:
                f.write(BOM.decode())
                csv.writer(f).writerow(self.columns)
            with open(whole, "ab") as f:
                for m in told:
                    with open(m.path, "rb") as part:
                        shutil.copyfileobj(part, f, 1 << 20)
            os.replace(whole, self.path)
        self.abort(messages)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        removed(self.parts)


class OneFile(DataSource):
    @classmethod
    def name(cls) -> str:
        return "one_csv_file"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        path = self.options["path"]
        if not overwrite and os.path.exists(path):
            raise ValueError("the file is there already: mode is overwrite or nothing")
        return OneFileWriter(path, schema.names, self.options.get("parts") or parts_of(path))


def write_csv(df: DataFrame, path: object) -> None:
    """UTF-8 with BOM, one header, the rows in df's order; no file for an empty table."""
    spark = df.sparkSession
    path = os.path.abspath(str(path))
    os.makedirs(os.path.dirname(path), exist_ok=True)
    spark.dataSource.register(OneFile)
    parts = parts_of(path)
    try:
        df.write.format("one_csv_file").mode("overwrite").option("parts", parts).save(path)
    finally:  # a job that fails before its first task is not aborted
        removed(parts)
