"""Five-minute consumption by service, the same code for batches and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions import classify as c
from ..operators import dated


def consumption(usage: DataFrame, minutes: int = 5, lateness: str = "10 minutes") -> DataFrame:
    """(window_start, service_type, n, units) over tumbling windows of usage_start_time.

    Event time becomes a zoned timestamp, as watermarks need; run sessions in
    UTC.  On a stream, rows later than ``lateness`` are dropped; on a batch the
    watermark has no effect.
    """
    timed = usage.withColumn("ts", F.col("usage_start_time").cast("timestamp"))
    if usage.isStreaming:
        timed = timed.withWatermark("ts", lateness)
    return (
        timed.groupBy(F.window("ts", f"{minutes} minutes").alias("w"), c.service_type().alias("service_type"))
        .agg(F.count("*").alias("n"), F.sum("act_usage_unit").cast("double").alias("units"))
        .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "service_type", "n", "units")
    )


def run_consumption(spark: SparkSession, folder: str, schema: StructType, table: str, checkpoint: str, minutes: int = 5, lateness: str = "10 minutes") -> None:
    """Takes in the usage files that are new in ``folder`` and updates ``table``, by day of the
    window.  Open windows and the watermark live in ``checkpoint``: the next run goes on
    with them, and drops rows for windows that ended before the watermark."""

    def load(batch: DataFrame, _: int) -> None:
        rows = dated.with_day(batch, "window_start")
        dated.upsert(batch.sparkSession, table, rows, ["window_start", "service_type"], "n")

    usage = spark.readStream.schema(schema).parquet(folder)
    query = consumption(usage, minutes, lateness).writeStream.outputMode("update").foreachBatch(load).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()


def consumed(spark: SparkSession, table: str) -> DataFrame:
    """(window_start, service_type, n, units) as of the last run."""
    schema = StructType.fromDDL("window_start timestamp_ntz, service_type string, n long, units double, day date")
    return dated.stored(spark, table, schema).drop(dated.DAY)
