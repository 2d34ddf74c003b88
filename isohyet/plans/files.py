"""Queries of stored files: catalogs of simulations, cropped cubes, station files, results that are made once."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isohyet import model
from isohyet.functions import physics
from isohyet.operators import indices as ix
from isohyet.operators import workflow
from isohyet.session import scratch
from isohyet.sources import cubes, tables

from .catalog import query
from .sql import sql

# models F and O, each with a historical run and two scenarios
_RUNS = "SELECT DISTINCT split_part(sim_code, '_', 1) AS model, CASE WHEN split_part(sim_code, '_', 3) = 'rcp85' THEN 'historical' ELSE split_part(sim_code, '_', 3) END AS scenario FROM simship"


def _catalog(spark, d):
    """institute, model, scenario, path of a stored tree of simulations, from the listing of its files."""
    path = scratch(spark)
    runs = cubes.simulations(spark, d).withColumns({"institute": F.lit("inst"), "model": F.substring("sim_code", 1, 1), "scenario": F.when(F.col("rcp") == "rcp85", "historical").otherwise(F.col("rcp"))})
    by = ("institute", "model", "scenario")
    tables.write_cube(runs.select(*by, "location_id", "date", "pr").repartition(*by), path, by)
    return tables.list_files(spark, path).select(*(c.alias(k) for k, c in tables.simulation_of_path(F.col("path")).items()), "path")


@query(sql("simship", "SELECT 'inst' AS institute, model, scenario FROM runs", runs=_RUNS))
def file_catalog(spark, d):
    """Simulations as the folders of a stored tree tell them."""
    return _catalog(spark, d).drop("path").distinct()


@query(sql("simship", "SELECT model, scenario, 'institute=inst/model=' || model || '/scenario=' || scenario AS path, 'institute=inst/model=' || model || '/scenario=historical' AS historical_path FROM runs WHERE scenario <> 'historical' AND model IN (SELECT model FROM runs WHERE scenario = 'historical')", runs=_RUNS))
def scenario_pairs(spark, d):
    """Folders of each scenario with that of its model's historical run."""
    folders = _catalog(spark, d).withColumn("path", F.regexp_extract("path", "(institute=.*)/[^/]*$", 1)).select("model", "scenario", "path").distinct()
    return tables.pair_scenarios(folders)


_BOTH = "SELECT sim_code, sum(pr)::DOUBLE AS pr FROM (SELECT sim_code, pr FROM sim UNION ALL SELECT 'ref', pr FROM ref) GROUP BY 1"


@query(sql("sim ref", "SELECT sim_code, pr, (row_number() OVER (ORDER BY sim_code <> 'ref', sim_code))::INT AS place FROM (SELECT * FROM totals WHERE sim_code = 'ref' OR sim_code LIKE '%_rcp45')", totals=_BOTH))
def datasets_in_order(spark, d):
    """The reference and the simulations of a scenario, the reference first."""
    both = cubes.simulations(spark, d).select("sim_code", "pr").unionByName(cubes.reference(spark, d).select(F.lit("ref").alias("sim_code"), "pr"))
    totals = tables.datasets(both, rcp="rcp45").groupBy("sim_code").agg(F.sum("pr").alias("pr"))
    return tables.order_simulations(totals.withColumn("place", F.row_number().over(Window.orderBy(*tables.simulation_order()))))  # a row for each simulation


# a slanted grid, whose places have a closed form; the box holds 1 to 4 by 1 to 3
@query(sql("cells pr", "SELECT t.target_id AS location_id, round(t.lon, 6) AS lon, round(t.lat, 6) AS lat, y.year, round(sum((1 - abs(t.x - y.lon)) * (1 - abs(t.y - y.lat)) * y.pr), 4) AS pr FROM placed t JOIN years y ON abs(t.x - y.lon) < 1 AND abs(t.y - y.lat) < 1 GROUP BY ALL",
           years="SELECT location_id, lon, lat, year(date)::INT AS year, sum(pr)::DOUBLE AS pr FROM pr WHERE year(date) BETWEEN 1996 AND 1999 GROUP BY ALL",
           axes="SELECT (max(lon + 0.2 * lat) - min(lon + 0.2 * lat)) AS wide, (max(lat + 0.1 * lon) - min(lat + 0.1 * lon)) AS high, floor(4.8 / 0.7 + 1e-9)::BIGINT AS nx, floor(4.4 / 0.7 + 1e-9)::BIGINT AS ny FROM cells",
           t="SELECT j * (nx + 1) + i AS target_id, (wide - nx * 0.7) / 2 + i * 0.7 AS lon, (high - ny * 0.7) / 2 + j * 0.7 AS lat FROM (SELECT *, unnest(range(0, ny + 1)) AS j FROM (SELECT *, unnest(range(0, nx + 1)) AS i FROM axes))",
           placed="SELECT * FROM (SELECT *, (lon - 0.2 * lat) / 0.98 AS x, (lat - 0.1 * lon) / 0.98 AS y FROM t WHERE lon BETWEEN 1 - 1e-9 AND 4 + 1e-9 AND lat BETWEEN 1 - 1e-9 AND 3 + 1e-9) WHERE x BETWEEN -1e-9 AND 4 + 1e-9 AND y BETWEEN -1e-9 AND 4 + 1e-9"))
def extract_rotated(spark, d):
    """A historical and a future part of a grid with axes of its own, cut to a box and a period of a regular grid."""
    own = cubes.cells(spark, d)
    cells = own.select("location_id", F.col("lon").alias("rlon"), F.col("lat").alias("rlat"), (F.col("lon") + 0.2 * F.col("lat")).alias("lon"), (F.col("lat") + 0.1 * F.col("lon")).alias("lat"))
    pr = cubes.precipitation(spark, d).select("location_id", "date", "pr")
    past, future = pr.filter("date < '1998-01-01'"), pr.filter("date >= '1998-01-01'")
    found = workflow.extract(past, future, cells, (1.0, 4.0), (1.0, 3.0), (1996, 1999), "pr", (0.7, 0.7))
    years = found.groupBy("location_id", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), F.year("date").alias("year"))
    return years.agg(F.round(F.sum("pr"), 4).alias("pr"))


@query(sql("sim", "SELECT sim_code, location_id::VARCHAR AS location_id, year(date)::INT AS year, sum(pr)::DOUBLE AS pr FROM sim WHERE sim_code LIKE 'F%' AND lon BETWEEN 1 AND 3 AND lat BETWEEN 0 AND 2 GROUP BY ALL"))
def cropped_files(spark, d):
    """Files of the simulations that begin with F, cut to a box and written."""
    source, target = scratch(spark), scratch(spark)
    daily = cubes.simulations(spark, d).select(F.lit("pr").alias("var"), "sim_code", F.col("location_id").cast("string").alias("location_id"), "lon", "lat", "date", F.col("pr").alias("value"))
    tables.write_cube(daily, source)
    found = tables.crop(spark, source, "sim_code=F_", cubes.cells(spark, d), (1.0, 3.0), (0.0, 2.0), target)
    return found.groupBy("sim_code", "location_id", F.year("date").alias("year")).agg(F.sum("value").alias("pr"))


@query(sql("pr", "SELECT NULL::VARCHAR AS sim_code, location_id::VARCHAR AS location_id, lon, lat, strftime(date, '%Y-%m-%d') AS date, round(pr, 6) AS value, 'kg m-2 s-1' AS units FROM pr"))
def canonical_cube(spark, d):
    """A source's own names, types and helper columns in canonical form; units are taken from the column's metadata."""
    pr = cubes.precipitation(spark, d)
    source = pr.select(F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), F.col("date").cast("timestamp").alias("time"), (F.col("pr") / physics.SECONDS_A_DAY).alias("rate"), F.lit(2.0).alias("height"), F.lit(0).alias("bnds"), F.col("location_id").alias("place"))
    source = model.with_units(source, "rate", "kg m-2 s-1")
    model.require(source, "time", "rate")
    units = model.units_of(source, "rate")
    found = model.standardise(source, {"latitude": "lat", "longitude": "lon", "time": "date", "rate": "value", "place": "location_id"})
    return found.select("sim_code", "location_id", "lon", "lat", F.col("date").cast("string").alias("date"), F.round(physics.convert(F.col("value"), units, "mm"), 6).alias("value"), F.lit(units).alias("units"))


@query(sql("pr", "SELECT location_id, year, doy, strftime(DATE '1900-01-01' + (doy - 1), '%m-%d') AS month_day FROM (SELECT *, row_number() OVER (PARTITION BY location_id, year ORDER BY pr DESC, doy) AS place FROM (SELECT location_id, year(date)::INT AS year, dayofyear(date)::INT AS doy, pr FROM pr)) WHERE place = 1"))
def wettest_day(spark, d):
    """Each year's first day of most rain, as day of year and as month and day."""
    years = model.with_calendar(cubes.precipitation(spark, d)).groupBy("location_id", "year").agg((-F.max(F.struct("pr", (-F.col("doy")).alias("back")))["back"]).alias("doy"))
    return years.withColumn("month_day", model.month_day(F.col("doy")))


@query(sql("sim", "SELECT sim_code, year(date)::INT AS year, count(*)::BIGINT AS within, count(DISTINCT date)::BIGINT AS draws, 0::BIGINT AS uneven FROM sim GROUP BY ALL"))
def noise_of_days(spark, d):
    """Noise of a simulation's days: all of it within its size, a draw of its own for each day, and the same one for all cells."""
    noisy = cubes.simulations(spark, d).withColumn("noise", physics.perturb(F.col("pr"), "sim_code", "date", size=1e-3) - F.col("pr"))
    days = noisy.groupBy("sim_code", "date").agg(F.count_if(F.col("noise").between(-1e-9, 1e-3 + 1e-9)).alias("within"), F.min(physics.step_noise("sim_code", "date")).alias("draw"), (F.max("noise") - F.min("noise") > 1e-9).alias("uneven"))
    return days.groupBy("sim_code", F.year("date").alias("year")).agg(F.sum("within").alias("within"), F.count_distinct("draw").alias("draws"), F.count_if("uneven").alias("uneven"))


@query(sql("pr", "SELECT location_id, year, value, (row_number() OVER (PARTITION BY location_id ORDER BY year) - 1)::INT AS position FROM (SELECT location_id, year(date)::INT AS year, sum(pr)::DOUBLE AS value FROM pr GROUP BY ALL HAVING sum(pr) > 0)"))
def year_positions(spark, d):
    """Places of the years with rain in each cell's series."""
    years = cubes.precipitation(spark, d).groupBy("location_id", F.year("date").alias("year")).agg(F.sum("pr").alias("value")).filter("value > 0")
    return ix.ranked_years(years, ("location_id",))


@query(sql("pr", "SELECT lat, lon, sum(pr)::DOUBLE AS pr FROM pr GROUP BY ALL ORDER BY lat, lon"))
def cells_in_order(spark, d):
    """Totals by cell, from south to north and from west to east."""
    return cubes.precipitation(spark, d).groupBy("lat", "lon").agg(F.sum("pr").alias("pr")).orderBy("lat", "lon")


@query(sql("obs", "SELECT o.station_id, n.n_name AS station_name, strftime(o.date, '%Y-%m-%d') AS date, o.value FROM obs o JOIN nation n ON o.station_id = printf('st%02d', n.n_nationkey::INT)"))
def station_files(spark, d):
    """Stations' own files of year, month, day and value, with what is known of each station."""
    path = scratch(spark)
    rows = cubes.observations(spark, d).select("station_id", F.year("date").alias("annees"), F.month("date").alias("mois"), F.dayofmonth("date").alias("jours"), "value")
    rows.repartition("station_id").write.partitionBy("station_id").option("header", True).option("sep", ";").csv(path)
    stations = cubes.table(spark, d, "nation").select(F.format_string("st%02d", F.col("n_nationkey").cast("int")).alias("station_id"), F.col("n_name").alias("station_name"))
    found = tables.read_station_csv(spark, path, ("value",), ";", stations, r"station_id=([^/]+)/")
    return found.select("station_id", "station_name", F.col("date").cast("string").alias("date"), "value").orderBy("station_id", "date")


_FLAT = T.StructType([T.StructField("time", T.StringType()), *(T.StructField(c, T.DoubleType()) for c in ("longitude", "latitude", "value"))])


@query(sql("tas", "SELECT strftime(date, '%Y-%m-%d') AS time, lon AS longitude, lat AS latitude, tasmax AS value FROM tas"))
def csv_round_trip(spark, d):
    """Temperatures as text with a header and back, missing values among them."""
    path = scratch(spark)
    tables.write_csv(tables.flatten(cubes.temperature(spark, d).withColumnRenamed("tasmax", "value")), path)
    return spark.read.schema(_FLAT).option("header", True).csv(path)


@query(sql("pr", "SELECT way, location_id, year(date)::INT AS year, sum(pr)::DOUBLE AS pr FROM pr CROSS JOIN (VALUES ('kept'), ('mended')) t(way) GROUP BY ALL"))
def results_made_once(spark, d):
    """A stored result that is there stays; one that a broken write left without its mark is made anew."""
    years = cubes.precipitation(spark, d).groupBy("location_id", F.year("date").alias("year")).agg(F.sum("pr").alias("pr"))
    none = years.filter(F.lit(False))
    whole, broken = scratch(spark), scratch(spark)
    workflow.made(spark, whole, lambda: years)
    none.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(broken)
    kept = workflow.made(spark, whole, lambda: none)
    mended = workflow.made(spark, broken, lambda: years)
    return kept.withColumn("way", F.lit("kept")).unionByName(mended.withColumn("way", F.lit("mended")))
