"""Climate cubes derived from the driver's tables: cells are nations on a 5 x 5 grid, days are ship or order dates.

Values are integers or halves, so sums do not depend on their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The whole years that the tables' dates span.
FIRST, LAST = "1995-01-01", "2001-12-31"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """location_id, lon, lat."""
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(n.cast("int").alias("location_id"), (n % 5).cast("double").alias("lon"), F.expr("n_nationkey div 5").cast("double").alias("lat"))


def days(places: DataFrame, first: str = FIRST, last: str = LAST) -> DataFrame:
    """Each row of places for each day; the days are generated in place, without a join."""
    return places.withColumn("date", F.explode(F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))))


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of lineitem with the nation of its supplier as location_id and the ship date as date."""
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("int").alias("location_id"))
    return table(spark, sf_dir, "lineitem").join(supplier, "l_suppkey").withColumn("date", F.col("l_shipdate").cast("date"))


def precipitation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pr in mm, 0 on days without a shipment."""
    sums = shipments(spark, sf_dir).groupBy("location_id", "date").agg(F.sum("l_quantity").alias("pr"))
    return days(cells(spark, sf_dir)).join(sums, ["location_id", "date"], "left").withColumn("pr", F.coalesce("pr", F.lit(0.0)))


def temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tasmax and tasmin in C, NULL on days without a shipment."""
    found = shipments(spark, sf_dir).groupBy("location_id", "date").agg((F.max("l_quantity") / 2 + 15).alias("tasmax"), (F.min("l_quantity") / 2).alias("tasmin"))
    return days(cells(spark, sf_dir)).join(found, ["location_id", "date"], "left")


def wind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """u and v, on days with a shipment."""
    sums = shipments(spark, sf_dir).groupBy("location_id", "date").agg(F.sum("l_linenumber").cast("long").alias("n"), F.sum("l_partkey").alias("p"))
    return sums.select("location_id", "date", (F.col("n") % 13 - 6).cast("double").alias("u"), (F.col("p") % 13 - 6).cast("double").alias("v"))


def simulations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pr of six simulations <line status>_<return flag>_<rcp>, 0 on days without a shipment."""
    rcp = F.element_at(F.create_map(F.lit("A"), F.lit("rcp26"), F.lit("N"), F.lit("rcp45"), F.lit("R"), F.lit("rcp85")), F.col("l_returnflag"))
    code = F.concat_ws("_", "l_linestatus", "l_returnflag", rcp)
    sums = shipments(spark, sf_dir).groupBy(code.alias("sim_code"), "location_id", "date").agg(F.sum("l_quantity").alias("pr"))
    codes = table(spark, sf_dir, "lineitem").select(code.alias("sim_code")).distinct()  # every item has a supplier
    grid = cells(spark, sf_dir)
    every = days(codes.join(F.broadcast(grid), how="cross"))  # simulations by the 25 cells of the grid
    return every.join(sums, ["sim_code", "location_id", "date"], "left").withColumn("pr", F.coalesce("pr", F.lit(0.0))).withColumn("rcp", F.element_at(F.split("sim_code", "_"), -1))


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pr by order date, 0 on days without an order."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("ordered"))
    items = shipments(spark, sf_dir).select("l_orderkey", "location_id", "l_quantity").join(orders, "l_orderkey")
    sums = items.groupBy("location_id", F.col("ordered").alias("date")).agg(F.sum("l_quantity").alias("pr"))
    return days(cells(spark, sf_dir)).join(sums, ["location_id", "date"], "left").withColumn("pr", F.coalesce("pr", F.lit(0.0)))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of each nation and day as station values, with gaps."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("int").alias("nation"))
    orders = table(spark, sf_dir, "orders").join(customer, "o_custkey")
    return orders.groupBy(F.format_string("st%02d", "nation").alias("station_id"), F.col("o_orderdate").cast("date").alias("date")).agg(F.count(F.lit(1)).cast("double").alias("value"))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean value of events by type (as cell) and hour."""
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("location_id"), F.date_trunc("hour", "ts").alias("ts")).agg(F.count(F.lit(1)).cast("double").alias("value"))
