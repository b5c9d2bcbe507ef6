"""Tables written between steps, in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_base(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where that is unset, a local folder takes its place, but only if all of Spark is on this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="assayer-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def materialised(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read again: computed once, its plan ends there, and lost executors don't
    take it along."""
    spark = df.sparkSession
    path = f"{shared_base(spark)}/step-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
