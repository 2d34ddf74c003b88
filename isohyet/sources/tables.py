"""Sources and sinks: partitioned Parquet cubes, station CSVs, catalogs of simulations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isohyet import model
from isohyet.operators import select


def read_daily(spark: SparkSession, *paths: str) -> DataFrame:
    """Daily values of one or more Parquet trees, with a fixed schema; var and sim_code prune partitions."""
    return model.missing_to_null(spark.read.schema(model.DAILY).option("recursiveFileLookup", "false").parquet(*paths), "value")


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """path, length, modified of the files below a folder whose names match, at any depth; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def write_cube(df: DataFrame, path: str, by: tuple[str, ...] = ("var", "sim_code")) -> None:
    """Write a table in partitions by the given columns; the commit protocol leaves no half-written output behind."""
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def save_by_series(df: DataFrame, name: str, path: str, keys: tuple[str, ...] = ("location_id",), buckets: int = 64) -> DataFrame:
    """A table whose files hold whole series in order of days, as a table of the catalog; returns it as read.

    A bucket, the series of equal hashes of keys, is one file, sorted by keys and date. Windows over a series' days and
    groupings by its keys then need neither an exchange nor a sort, however often they are computed.
    """
    spark = df.sparkSession
    # one file a bucket: dealt by the hash that buckets are told by
    dealt = df.repartition(buckets, *keys).sortWithinPartitions(*keys, "date")
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys, "date").saveAsTable(name)
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")  # files are whole buckets, so their order holds
    return spark.table(name)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_station_csv(spark: SparkSession, path: str, values: tuple[str, ...], separator: str = ",", stations: DataFrame | None = None, station: str = r"([^/]+?)(\.[^./]*)?$") -> DataFrame:
    """Station series from files with columns annees, mois, jours and values; station_id is the file's name.

    station: a pattern whose first group is the station's name in a file's path. Rows whose date does not exist are
    dropped. With a station table its columns are joined on.
    """
    schema = T.StructType([*(T.StructField(c, T.IntegerType()) for c in ("annees", "mois", "jours")), *(T.StructField(c, T.DoubleType()) for c in values)])
    df = spark.read.schema(schema).option("header", True).option("sep", separator).csv(path)
    name = F.regexp_extract(F.input_file_name(), station, 1)
    df = df.select(name.alias("station_id"), F.try_make_timestamp("annees", "mois", "jours", F.lit(0), F.lit(0), F.lit(0)).cast("date").alias("date"), *values)
    df = model.missing_to_null(df.filter("date is not null"), *values)
    return df if stations is None else df.join(stations, "station_id", "left")


def date_of_path(path: Column) -> Column:
    """The first eight digits in a path, as a date."""
    return F.try_to_date(F.regexp_extract(path, r"(\d{8})", 1), "yyyyMMdd")


def simulation_of_path(path: Column) -> dict[str, Column]:
    """Institute, model and scenario from a path that ends .../institute/model/scenario/file; folders may be told as key=value."""
    parts = F.split(F.regexp_replace(path, r"(?<=/)[^/=]*=", ""), "/")
    return {"institute": F.element_at(parts, -4), "model": F.element_at(parts, -3), "scenario": F.element_at(parts, -2)}


def pair_scenarios(catalog: DataFrame, historical: str = "historical") -> DataFrame:
    """Historical and future paths of the same model, from rows (model, scenario, path)."""
    past = catalog.filter(F.col("scenario") == historical).select("model", F.col("path").alias("historical_path"))
    return catalog.filter(F.col("scenario") != historical).join(past, "model")


def simulation_order() -> tuple[Column, Column]:
    """The reference first, then the others by code."""
    return F.col("sim_code") != "ref", F.col("sim_code")


def order_simulations(df: DataFrame) -> DataFrame:
    return df.orderBy(*simulation_order())


def datasets(df: DataFrame, rcp: str | None = None, sim_code: str | None = None, reference: bool = True) -> DataFrame:
    """Rows of the simulations of a scenario, of one simulation, or of all, with those of the reference or without."""
    wanted = F.lit(True)
    if rcp is not None:
        wanted = model.rcp_of(F.col("sim_code")) == rcp
    if sim_code is not None:
        wanted = wanted & (F.col("sim_code") == sim_code)
    own = F.col("sim_code") == "ref"
    return df.filter(own | wanted if reference else ~own & wanted)


def crop(spark: SparkSession, path: str, keyword: str, cells: DataFrame, lon: tuple[float, float], lat: tuple[float, float], target: str) -> DataFrame:
    """Cut the files of a cube whose path contains the keyword to a box, and write them as a cube; returns it as read.

    Files without the keyword are left out of the scan. The box is widened as select.box_of() tells.
    """
    daily = spark.read.schema(model.DAILY).parquet(path).filter(F.contains(F.col("_metadata.file_path"), F.lit(keyword)))
    write_cube(select.subset_box(daily, cells.withColumn("location_id", F.col("location_id").cast("string")), lon, lat), target)
    return read_daily(spark, target)


def except_simulations(df: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Drop simulations whose code contains one of the excepted texts (column part, a short list from a configuration)."""
    codes = df.select("sim_code").distinct()
    dropped = codes.join(exceptions, F.col("sim_code").contains(F.col("part")), "left_semi")
    return df.join(dropped, "sim_code", "left_anti")


def merge_parts(parts: list[DataFrame], keys: tuple[str, ...] = ("station_id", "date")) -> DataFrame:
    """Stack station files; where a key stands in several, the first part wins."""
    stacked = None
    for k, part in enumerate(parts):
        part = part.withColumn("part", F.lit(k))
        stacked = part if stacked is None else stacked.unionByName(part)
    first = Window.partitionBy(*keys).orderBy("part")
    return stacked.withColumn("place", F.row_number().over(first)).filter("place = 1").drop("place", "part")


def flatten(df: DataFrame, by: str = "day") -> DataFrame:
    """The cube as rows time, longitude, latitude, value, with time cut to the day or the year."""
    time = F.date_format("date", "yyyy-MM-dd" if by == "day" else "yyyy")
    return df.select(time.alias("time"), F.col("lon").alias("longitude"), F.col("lat").alias("latitude"), "value")
