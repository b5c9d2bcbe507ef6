import csv
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from assayer.sources.one_file import write_csv


def test_one_file_in_order(spark, tmp_path):
    path = tmp_path / "deep/table.csv"
    df = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 2 == 0, F.concat(F.lit('é "q",\n'), F.col("id").cast("string"))).alias("a.b"), (F.col("id") * 1.5).cast("decimal(38,1)").alias("d"))
    for n in (1, 7, 40):  # a file that is there gives way
        write_csv(df.repartition(n).orderBy(F.desc("id")), path)
        assert path.read_bytes().startswith(b"\xef\xbb\xbfid,a.b,d\r\n")
        with path.open(newline="", encoding="utf-8-sig") as f:
            rows = list(csv.reader(f))[1:]
        shown = lambda d: str(int(d)) if d == int(d) else str(d)
        assert rows == [[str(i), f'é "q",\n{i}' if i % 2 == 0 else "", shown(Decimal(i * 15) / 10)] for i in range(4999, -1, -1)]
        assert [p.name for p in path.parent.iterdir()] == ["table.csv"]


def test_nothing_is_left_of_a_failure(spark, tmp_path):
    path = tmp_path / "table.csv"
    write_csv(spark.range(0), path)
    assert not path.exists()
    write_csv(spark.range(3), path)
    before = path.read_bytes()
    with pytest.raises(Exception, match="broken"):
        write_csv(spark.range(100, numPartitions=4).select(F.when(F.col("id") == 70, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id")), path)
    assert path.read_bytes() == before and [p.name for p in tmp_path.iterdir()] == ["table.csv"]
    with pytest.raises(Exception, match="already"):
        spark.range(1).write.format("one_csv_file").mode("append").save(str(path))


def test_a_task_that_outlives_a_failed_job_leaves_nothing(spark, tmp_path, monkeypatch):
    from types import SimpleNamespace

    from pyspark.sql.types import StructType

    from assayer.sources import one_file

    monkeypatch.setattr(one_file, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    writer = one_file.OneFile({"path": str(tmp_path / "table.csv")}).writer(StructType().add("id", "long"), True)
    part = writer.write(iter([(1,)]))
    writer.abort([part])
    with pytest.raises(FileNotFoundError):
        writer.write(iter([(2,)]))
    assert not list(tmp_path.iterdir())
    # a job that fails before its tasks: the broadcast side of a join
    broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        write_csv(spark.range(100).join(F.broadcast(broken), "id"), tmp_path / "table.csv")
    assert not list(tmp_path.iterdir())


def test_lines_are_numbered_over_splits(spark, tmp_path):
    from assayer.plans.bound_files import numbered_lines

    path, name = tmp_path / "lines", "spark.sql.files.maxPartitionBytes"
    path.write_bytes(b"".join(b"%d%s\r\n" % (k, b"x" * (k % 50)) for k in range(3000)))
    before = spark.conf.get(name)
    spark.conf.set(name, "4096")
    try:
        got = numbered_lines(spark, path, "\r\n")
        assert got.rdd.getNumPartitions() > 1
        assert {(r["at"], r["text"]) for r in got.collect()} == {(k, f"{k}{'x' * (k % 50)}") for k in range(3000)}
    finally:
        spark.conf.set(name, before)
