"""Queries whose rows come through a stream, held against the same days at once."""

from __future__ import annotations

from pyspark.sql import functions as F

from isohyet.session import durable, scratch
from isohyet.sources import cubes
from isohyet.streaming import ingest, spells

from .catalog import query
from .sql import runs_sql, sql


@query(sql("obs", "SELECT station_id, strftime(date, '%Y-%m-%d') AS date, CASE WHEN year(date) = 1997 THEN value + 1 ELSE value END AS value FROM obs"))
def ingest_of_days(spark, d):
    """Observations as files of a day each, in three arrivals: most years, a corrected 1997, and 1996, which comes late."""
    arrivals, cube, checkpoint = (f"{scratch(spark)}/{x}" for x in ("arrivals", "cube", "checkpoint"))
    obs = cubes.observations(spark, d).withColumn("day", F.date_format("date", "yyyyMMdd"))
    year = F.year("date")
    parts = [obs.filter(year != 1996), obs.filter(year == 1997).withColumn("value", F.col("value") + 1), obs.filter(year == 1996)]
    schema = obs.select("station_id", "value").schema
    for k, part in enumerate(parts):
        part.select("station_id", "value", "day").repartition("day").write.partitionBy("day").parquet(f"{arrivals}/{k}")
        ingest.ingest(spark, arrivals, cube, checkpoint, schema, ("station_id",))
    return spark.read.parquet(cube).select("station_id", F.col("date").cast("string").alias("date"), "value")


@query(sql("pr", "SELECT location_id, year, length, count(*)::BIGINT AS n FROM runs GROUP BY ALL", runs=runs_sql("pr", "pr >= 1")))
def spells_of_stream(spark, d):
    """Wet spells of every cell from days that arrive year by year, out of order within a file; how many of each length."""
    folder, out, checkpoint = (f"{scratch(spark)}/{x}" for x in ("days", "spells", "checkpoint"))
    pr = cubes.precipitation(spark, d).select("location_id", "date", "pr")
    after = cubes.cells(spark, d).select("location_id", F.lit("2002-03-01").cast("date").alias("date"), F.lit(0.0).alias("pr"))  # lets the watermark pass the last day
    days = durable(pr.unionByName(after))
    for year in range(1995, 2003):  # one arrival after the other
        days.filter(F.year("date") == year).repartition(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(pr.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    found = spells.spells(stream, "pr >= 1", late="30 days")
    found.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").start(out).awaitTermination()
    return spark.read.parquet(out).groupBy("location_id", "year", "length").agg(F.count(F.lit(1)).alias("n"))
