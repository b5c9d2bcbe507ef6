from pyspark.sql import functions as F

from assayer.sources import files
from assayer.sources.listing import listed


def test_files_are_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(50, numPartitions=1).select(F.concat(F.lit("a/"), F.col("id").cast("string")).alias("path"), F.lit("x").cast("binary").alias("content"), F.lit(None).cast("string").alias("source"))
    done = files.stored(rows, tmp_path, [])
    assert done.rdd.getNumPartitions() > 1
    assert done.where("error is null").count() == 50 and len(list((tmp_path / "a").iterdir())) == 50


def test_a_flat_folder_is_listed_by_many_tasks(spark, tmp_path):
    for k in range(40):
        (tmp_path / f"f{k}").write_text("x")
    got = listed(spark, tmp_path, recursive=False)
    assert got.rdd.getNumPartitions() > 1
    assert sorted(r["path"] for r in got.collect()) == sorted(f"f{k}" for k in range(40))
    assert [r["kind"] for r in listed(spark, tmp_path / "none", recursive=False).collect()] == ["unreadable"]
