"""The verdict log: appended JSON lines, and a compacted snapshot of them in buckets by key.

    <log>/part-*.json            appended batches; a log without anything else is one of old, and is read as it is
    <log>/_snapshot/<id>/        Parquet, a folder a bucket, sorted by key, with a bloom filter on it
    <log>/_snapshot/commit-N     which snapshot counts, its buckets, and the batches that it covers; the greatest N counts

A verdict is the last record of its key, by seq, wherever it lies. A probe for some keys reads the buckets that these
fall into and the batches that no snapshot covers yet. compact() merges these into a new snapshot and moves the commit
into place; of two that run at once, one finds its number taken and gives up. What a commit no longer needs is removed
by the commit after it, so that a reader that began before keeps its files.
"""

from __future__ import annotations

import json
import re
import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scoring import latest_records
from ..schemas import VERDICT

BUCKETS = 64
#: Batches (files) that wait for a snapshot before one is made.
COMPACT_AFTER = 64
_COMMIT = re.compile(r"commit-(\d+)")


class State(NamedTuple):
    number: int
    snapshot: str | None
    buckets: int
    held: list[int]  # buckets that hold rows
    covered: list[str]
    deltas: list[str]
    stale: list[str]  # the snapshot before this one


def _at(spark: SparkSession, path: str):
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), own


def _names(spark: SparkSession, path: str, folders: bool = False) -> list[str]:
    fs, own = _at(spark, path)
    if not fs.exists(own):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(own) if s.isDirectory() == folders)


def state(spark: SparkSession, path: str) -> State:
    """What the log consists of: names of files alone."""
    commits = {int(m[1]): n for n in _names(spark, f"{path}/_snapshot") if (m := _COMMIT.fullmatch(n))}
    said = json.loads(spark.read.text(f"{path}/_snapshot/{commits[max(commits)]}", wholetext=True).first()["value"]) if commits else {}
    covered = said.get("covered", [])
    deltas = [n for n in _names(spark, path) if n[0] not in "._" and n not in set(covered)]
    return State(max(commits, default=0), said.get("snapshot"), said.get("buckets", BUCKETS), said.get("held", []), covered, deltas, said.get("before", []))


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _records(spark: SparkSession, path: str, now: State, buckets: list[int]) -> DataFrame:
    """The records in some buckets of the snapshot, and all that it doesn't cover."""
    parts = [spark.createDataFrame([], VERDICT)]
    if buckets:
        folder = f"{path}/_snapshot/{now.snapshot}"
        parts.append(spark.read.schema(VERDICT).parquet(*[f"{folder}/bucket={b}" for b in buckets]))
    if now.deltas:
        parts.append(spark.read.schema(VERDICT).json([f"{path}/{n}" for n in now.deltas]))
    return parts[-1] if len(parts) < 3 else parts[1].unionByName(parts[2])


def read_verdicts(spark: SparkSession, path: str) -> DataFrame:
    """The last verdict of each key; an absent log has none."""
    now = state(spark, path)
    return latest_records(_records(spark, path, now, now.held), "key", ["seq"])


def probe_verdicts(keys: DataFrame, path: str) -> DataFrame:
    """The last verdict of each of keys(key) that has one, from the buckets that these fall into."""
    spark = keys.sparkSession
    now = state(spark, path)
    hit = {r["b"] for r in keys.select(bucket_of(F.col("key"), now.buckets).alias("b")).distinct().collect()} if now.held else set()
    found = _records(spark, path, now, [b for b in now.held if b in hit])
    return latest_records(found.join(keys.select("key").distinct(), "key", "left_semi"), "key", ["seq"])


def append_verdicts(verdicts: DataFrame, path: str) -> None:
    """Appends judged rows; each task's rows are committed as it ends, so a stopped run loses the running batch alone."""
    verdicts.select(*VERDICT.names).write.mode("append").json(path)


def compact(spark: SparkSession, path: str, buckets: int | None = None) -> bool:
    """Merges what waits into a new snapshot. False if nothing waits or another run was faster."""
    now = state(spark, path)
    buckets = buckets or now.buckets
    if not now.deltas and buckets == now.buckets:
        return False
    name = uuid.uuid4().hex
    rows = latest_records(_records(spark, path, now, now.held), "key", ["seq"]).withColumn("bucket", bucket_of(F.col("key"), buckets))
    target = f"{path}/_snapshot/{name}"
    rows.repartition("bucket").sortWithinPartitions("bucket", "key").write.partitionBy("bucket").option("parquet.bloom.filter.enabled#key", "true").parquet(target)
    held = sorted(int(n.split("=")[1]) for n in _names(spark, target, folders=True) if n.startswith("bucket="))
    there = set(_names(spark, path))
    covered = [*now.deltas, *(n for n in now.covered if n in there)]
    done = _commit(spark, path, now.number + 1, {"snapshot": name, "buckets": buckets, "held": held, "covered": covered, "before": [now.snapshot] if now.snapshot else []})
    if done:
        for n in [*now.covered, *(f"_snapshot/{x}" for x in now.stale)]:
            _remove(spark, f"{path}/{n}")
    else:
        _remove(spark, target)
    return done


def _remove(spark: SparkSession, path: str) -> None:
    fs, own = _at(spark, path)
    fs.delete(own, True)


def _commit(spark: SparkSession, path: str, number: int, content: dict) -> bool:
    """Moves a commit into place, unless its number is taken."""
    fs, to = _at(spark, f"{path}/_snapshot/commit-{number}")
    _, part = _at(spark, f"{path}/_snapshot/.{uuid.uuid4().hex}")
    out = fs.create(part, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    done = not fs.exists(to) and fs.rename(part, to)
    if not done:
        fs.delete(part, False)
    return done
