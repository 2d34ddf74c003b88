"""Hourly streams to daily values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_events(spark: SparkSession, path: str, files_per_trigger: int = 8) -> DataFrame:
    """Event files as they arrive, with the schema of those already there; event time is UTC."""
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def daily(events: DataFrame, late: str = "2 days", keys: tuple[str, ...] = ("event_type",), value: str = "value") -> DataFrame:
    """Mean, least, greatest and sum per key and day; a day is closed once the watermark has passed it.

    Only running aggregates of open days are state; later rows than the watermark allows are dropped.
    """
    days = events.withWatermark("ts", late).groupBy(*keys, F.window("ts", "1 day").alias("day"))
    found = days.agg(F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"), F.sum(value).alias("sum"), F.count(value).alias("n"))
    return found.select(*keys, F.col("day.start").cast("date").alias("date"), "mean", "min", "max", "sum", "n")


def write_daily(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append closed days to Parquet, exactly once."""
    return df.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def read_written_days(spark: SparkSession, path: str) -> DataFrame:
    """What write_daily() has written, as a stream: closed days, each once."""
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def wet_day_counts(days: DataFrame, threshold: float, keys: tuple[str, ...] = ("event_type",)) -> DataFrame:
    """Days at or above a threshold, of the written daily table or, for complete or update output, of a stream of it.

    The days must have been written first (read_written_days): a count over a stream's open days would count them anew
    with each of their values, and Spark refuses it.
    """
    return days.groupBy(*keys).agg(F.count_if(F.col("sum") >= threshold).alias("wet_days"))
