"""Verdicts as a stream: files of judged rows arrive, the log grows, the newest verdict of a key counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.scoring import latest_records
from ..schemas import VERDICT


def ingest(spark: SparkSession, folder: str, table: str, checkpoint: str) -> StreamingQuery:
    """Appends arriving verdicts to a Parquet log, each micro-batch under its own name, so that a batch that is run
    again after a failure replaces itself. Processes what is there and stops."""

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={number}")

    source = spark.readStream.schema(VERDICT).json(folder)
    return source.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, table: str) -> DataFrame:
    return latest_records(spark.read.schema(VERDICT).option("recursiveFileLookup", True).parquet(table), "key", ["seq"])


def windowed_costs(stream: DataFrame, late: str = "1 hour", width: str = "10 minutes") -> DataFrame:
    """Judging costs by window of the event time column `at`, late rows up to `late` included."""
    return stream.withWatermark("at", late).groupBy(F.window("at", width)).agg(F.count(F.lit(1)).alias("verdicts"), F.sum("cost").alias("cost"))
