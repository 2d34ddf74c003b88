"""One-day files taken into a cube as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isohyet.session import durable

#: Where a path tells its day: in the folder that a file is in, or else in its name: eight digits that begin it or follow a mark.
DAY_IN_PATH = r"(?:^|[/_=.-])(\d{8})(?=[^/\d]*(?:/[^/]*)?$)"


def read_days(spark: SparkSession, arrivals: str, schema: T.StructType, files_per_batch: int = 10_000) -> DataFrame:
    """Files of one day each as a stream: their columns, date (told by the path) and arrived (when a file was written, and its path)."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True).parquet(arrivals)
    day = F.try_to_date(F.regexp_extract("_metadata.file_path", DAY_IN_PATH, 1), "yyyyMMdd")
    arrived = F.struct(F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("path"))
    return stream.select(*schema.names, day.alias("date"), arrived.alias("arrived")).filter("date is not null")


def merge_days(batch: DataFrame, cube: str, keys: tuple[str, ...]) -> None:
    """Put days into the cube's years: of one key and day the file that arrived last counts, whatever the batch.

    Only years with new days are read and written, each replaced as a whole. The same batch once more changes nothing, so a
    batch that was cut short can be run again.
    """
    spark = batch.sparkSession
    new = durable(batch.withColumn("year", F.year("date")))
    years = [r.year for r in new.select("year").distinct().collect()]  # a number for each year of the batch
    if not years:
        return
    columns = [c for c in new.columns if c not in (*keys, "date", "year")]
    try:
        old = spark.read.schema(new.schema).parquet(cube).filter(F.col("year").isin(years))
        every = new.unionByName(old)
    except Exception as problem:  # the first batch finds no cube
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        every = new
    last = every.groupBy(*keys, "date", "year").agg(F.max_by(F.struct(*columns), "arrived").alias("x")).select(*keys, "date", "year", "x.*")
    durable(last).repartition("year").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(cube)


def ingest(spark: SparkSession, arrivals: str, cube: str, checkpoint: str, schema: T.StructType, keys: tuple[str, ...] = ("location_id",), files_per_batch: int = 10_000) -> None:
    """Take in what has arrived since the last call, and return; files that were taken in are known from the checkpoint."""
    days = read_days(spark, arrivals, schema, files_per_batch)
    query = days.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda batch, _: merge_days(batch, cube, keys)).start()
    query.awaitTermination()
