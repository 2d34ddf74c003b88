"""Queries of selection, calendars, units and resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from isohyet import model
from isohyet.functions import physics
from isohyet.operators import resample, runs, select
from isohyet.sources import cubes, tables

from .catalog import query
from .sql import sql

_DAY = "strftime(date, '%Y-%m-%d') AS date"


def _rows(df, *values):
    return df.select("location_id", F.col("date").cast("string").alias("date"), *(values or ("pr",)))


@query(sql("pr", f"SELECT location_id, {_DAY}, pr FROM pr WHERE dayofyear(date) BETWEEN 60 AND 151"))
def subset_doy(spark, d):
    return _rows(select.subset_doy(cubes.precipitation(spark, d), model.doy_of("03-01"), model.doy_of("05-31")))


@query(sql("pr", f"SELECT location_id, {_DAY}, pr FROM pr WHERE dayofyear(date) >= 335 OR dayofyear(date) <= 59"))
def subset_doy_wrap(spark, d):
    return _rows(select.subset_doy(cubes.precipitation(spark, d), model.doy_of("12-01"), model.doy_of("02-29")))


@query(sql("pr", f"SELECT location_id, {_DAY}, pr FROM pr WHERE year(date) BETWEEN 1996 AND 1997"))
def sel_period(spark, d):
    return _rows(select.select_period(cubes.precipitation(spark, d), 1996, 1997))


@query(sql("pr", f"SELECT location_id, {_DAY}, pr FROM pr WHERE lon BETWEEN 1 AND 2 AND lat BETWEEN -0.1 AND 2.1"))
def box_subset(spark, d):
    return _rows(select.subset_box(cubes.precipitation(spark, d), cubes.cells(spark, d), (1.0, 2.0), (0.9, 1.1)))


@query(sql("pr", f"SELECT location_id, {_DAY}, pr FROM pr WHERE NOT (month(date) = 2 AND day(date) = 29)"))
def remove_feb29(spark, d):
    return _rows(select.remove_feb29(cubes.precipitation(spark, d)))


@query(sql("pr", f"SELECT location_id, {_DAY}, pr FROM pr WHERE location_id = (SELECT location_id FROM cells ORDER BY (lon - 2.2) ** 2 + (lat - 3.1) ** 2 LIMIT 1)"))
def ctrl_pt(spark, d):
    return _rows(select.control_point(cubes.precipitation(spark, d), cubes.cells(spark, d), 2.2, 3.1))


@query(sql("pr", f"SELECT location_id, {_DAY}, pr FROM pr WHERE lon = 2 AND lat = 2"))
def ctrl_pt_centre(spark, d):
    return _rows(select.control_point(cubes.precipitation(spark, d), cubes.cells(spark, d)))


@query(sql("pr", f"SELECT location_id, {_DAY}, CASE WHEN location_id IN (SELECT location_id FROM flat GROUP BY location_id HAVING min(pr) <> max(pr)) THEN pr END AS pr FROM flat", flat="SELECT * REPLACE (CASE WHEN location_id % 4 = 0 THEN 1 ELSE pr END AS pr) FROM pr"))
def mask_minmax(spark, d):
    flat = cubes.precipitation(spark, d).withColumn("pr", F.when(F.col("location_id") % 4 == 0, 1.0).otherwise(F.col("pr")))
    return _rows(select.apply_mask(flat, select.valid_cells(flat, "pr"), "pr"))


_RING = ((0.5, -0.5), (4.6, 0.7), (3.4, 4.3), (1.6, 2.2))
_SIDES = [(*a, *b) for a, b in zip(_RING, (*_RING[1:], _RING[0]), strict=True)]


@query(sql("cells", "SELECT location_id, lon, lat FROM cells WHERE (SELECT count(*) FROM (VALUES {}) e(x1, y1, x2, y2) WHERE (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1) % 2 = 1".format(", ".join("({}::DOUBLE, {}::DOUBLE, {}::DOUBLE, {}::DOUBLE)".format(*s) for s in _SIDES))))
def polygon_clip(spark, d):
    sides = spark.createDataFrame(_SIDES, "x1 double, y1 double, x2 double, y2 double")
    return select.clip(cubes.cells(spark, d), cubes.cells(spark, d), sides)


@query(sql("pr", f"SELECT location_id, {_DAY}, least(greatest(pr - 20, 0), 50) AS pr FROM pr"))
def clamp(spark, d):
    return _rows(cubes.precipitation(spark, d).withColumn("pr", physics.clamp(F.col("pr") - 20, 0.0, 50.0)))


def _converted(value, old, new):
    def run(spark, d):
        df = cubes.temperature(spark, d) if value == "tasmax" else cubes.precipitation(spark, d)
        return _rows(df.withColumn(value, F.round(physics.convert(F.col(value), old, new), 6)), value)

    return run


for _name, _value, _old, _new, _sql in (("units_k_c", "tasmax", "K", "C", "tasmax - 273.15"), ("units_c_k", "tasmax", "C", "K", "tasmax + 273.15"), ("units_mm", "pr", "kg m-2 s-1", "mm", "pr * 86400"), ("units_kg", "pr", "mm", "kg m-2 s-1", "pr / 86400.0"), ("units_kmh", "pr", "m s-1", "km h-1", "pr * 3.6"), ("units_ms", "pr", "km h-1", "m s-1", "pr / 3.6")):
    query(sql("tas" if _value == "tasmax" else "pr", f"SELECT location_id, {_DAY}, round(({_sql})::DOUBLE, 6) AS {_value} FROM {'tas' if _value == 'tasmax' else 'pr'}"), _name)(_converted(_value, _old, _new))


@query(sql("hour", "SELECT location_id, strftime(ts, '%Y-%m-%d') AS date, round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max, sum(value) AS sum FROM hour GROUP BY 1, 2"))
def hourly_to_daily(spark, d):
    daily = resample.hourly_to_daily(cubes.hourly(spark, d), ("mean", "min", "max", "sum"))
    return daily.select("location_id", F.col("date").cast("string").alias("date"), F.round("mean", 6).alias("mean"), "min", "max", "sum")


@query(sql("hour", "SELECT location_id, strftime(ts, '%Y-%m-%d') AS date, value FROM hour WHERE hour(ts) = 23"))
def era5land_23h(spark, d):
    return resample.accumulated_to_daily(cubes.hourly(spark, d)).select("location_id", F.col("date").cast("string").alias("date"), "value")


@query(sql("pr", "SELECT location_id, year(date)::INT AS year, sum(pr) AS pr FROM pr GROUP BY 1, 2"))
def annual_sum(spark, d):
    return resample.annual(cubes.precipitation(spark, d), "pr")


@query(sql("tas", "SELECT location_id, year(date)::INT AS year, round(avg(tasmax), 6) AS tasmax FROM tas GROUP BY 1, 2"))
def annual_mean(spark, d):
    return resample.annual(cubes.temperature(spark, d), "tasmax", "mean").withColumn("tasmax", F.round("tasmax", 6))


@query(sql("pr", "SELECT location_id, year(date)::INT AS year, month(date)::INT AS month, sum(pr) AS pr FROM pr GROUP BY 1, 2, 3"))
def monthly_sum(spark, d):
    return resample.monthly(cubes.precipitation(spark, d), "pr")


@query(sql("tas", "SELECT location_id, year(date)::INT AS year, round(coalesce(sum(tasmax), 0), 6) AS tasmax FROM tas GROUP BY 1, 2"))
def sum_of_missing(spark, d):
    return resample.annual(cubes.temperature(spark, d), "tasmax").withColumn("tasmax", F.round("tasmax", 6))


@query(sql("tas", f"SELECT {_DAY}, round(avg(tasmax), 6) AS tasmax FROM tas GROUP BY date"))
def spatial_mean(spark, d):
    return resample.spatial_mean(cubes.temperature(spark, d), "tasmax").select(F.col("date").cast("string").alias("date"), F.round("tasmax", 6).alias("tasmax"))


@query(sql("pr", "SELECT location_id, dayofyear(make_date(1900, month(date), day(date)))::INT AS doy, round(avg(pr), 6) AS mean, min(pr) AS min, max(pr) AS max FROM pr WHERE NOT (month(date) = 2 AND day(date) = 29) GROUP BY 1, 2"))
def daily_climatology(spark, d):
    return resample.daily_climatology(cubes.precipitation(spark, d), "pr").withColumn("mean", F.round("mean", 6))


@query(sql("pr", "SELECT year, {} FROM (SELECT location_id, year(date)::INT AS year, month(date) AS month, sum(pr) AS pr FROM pr GROUP BY ALL) GROUP BY year".format(", ".join(f"round(avg(pr) FILTER (month = {m}), 6) AS m{m:02d}" for m in range(1, 13)))))
def monthly_matrix(spark, d):
    wide = resample.monthly_matrix(cubes.precipitation(spark, d), "pr")
    return wide.select("year", *(F.round(c, 6).alias(c) for c in wide.columns[1:]))


@query(sql("pr", "SELECT location_id, month, round(avg(pr), 6) AS mean, min(pr) AS min, max(pr) AS max, round(quantile_cont(pr, 0.9), 6) AS quantile FROM (SELECT location_id, year(date) AS year, month(date)::INT AS month, sum(pr) AS pr FROM pr GROUP BY ALL) GROUP BY 1, 2"))
def monthly_statistics(spark, d):
    found = resample.monthly_statistics(cubes.precipitation(spark, d), "pr")
    return found.withColumns({"mean": F.round("mean", 6), "quantile": F.round("quantile", 6)})


@query(sql("pr", "SELECT location_id, year(date)::INT AS year, round(avg(pr) * 365, 6) AS pr FROM pr GROUP BY 1, 2"))
def annual_mean_scaled(spark, d):
    return resample.mean_scaled(cubes.precipitation(spark, d), "pr", 365.0).withColumn("pr", F.round("pr", 6))


@query(sql("pr", "SELECT s.location_id, strftime(make_date(s.year, month(p.day), day(p.day)), '%Y-%m-%d') AS date, s.pr FROM src s JOIN plain p ON p.source = s.doy", src="SELECT location_id, year(date)::INT AS year, dayofyear(date)::INT AS doy, pr FROM pr WHERE dayofyear(date) <= 360", plain="SELECT k, (DATE '1899-12-31' + k::INT)::DATE AS day, greatest(round(k * 360.0::DOUBLE / 365.0::DOUBLE), 1)::INT AS source FROM range(1, 366) t(k)"))
def cal_360_365(spark, d):
    src = cubes.precipitation(spark, d).filter("dayofyear(date) <= 360").select("location_id", F.year("date").alias("year"), F.dayofyear("date").alias("doy"), "pr")
    return _rows(resample.from_360_days(src, "pr"))


@query(sql("tas", "SELECT location_id, {}, round(coalesce(tasmax, v0 + (v1 - v0) * (date - d0)::DOUBLE / (d1 - d0)::DOUBLE), 6) AS tasmax FROM (SELECT *, last_value(tasmax IGNORE NULLS) OVER b AS v0, first_value(tasmax IGNORE NULLS) OVER a AS v1, max(CASE WHEN tasmax IS NOT NULL THEN date END) OVER b AS d0, min(CASE WHEN tasmax IS NOT NULL THEN date END) OVER a AS d1 FROM tas WINDOW b AS (PARTITION BY location_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY location_id ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))".format(_DAY)))
def interp_time(spark, d):
    return _rows(resample.fill_gaps(cubes.temperature(spark, d), "tasmax").withColumn("tasmax", F.round("tasmax", 6)), "tasmax")


@query(sql("tas", f"SELECT location_id, {_DAY}, round(6.11::DOUBLE * pow(10.0::DOUBLE, 7.5::DOUBLE * tasmin / (237.7::DOUBLE + tasmin)), 6) AS hpa FROM tas"))
def vapour_pressure(spark, d):
    return _rows(cubes.temperature(spark, d).withColumn("hpa", F.round(physics.vapour_pressure(F.col("tasmin")), 6)), "hpa")


@query(sql("tas", f"SELECT location_id, {_DAY}, round(0.622::DOUBLE * e / (1000.0::DOUBLE - 0.378::DOUBLE * e), 6) AS huss FROM (SELECT *, 6.11::DOUBLE * pow(10.0::DOUBLE, 7.5::DOUBLE * tasmin / (237.7::DOUBLE + tasmin)) AS e FROM tas)"))
def spec_humidity(spark, d):
    huss = physics.specific_humidity(F.col("tasmin") + physics.KELVIN, F.lit(100000.0))
    return _rows(cubes.temperature(spark, d).withColumn("huss", F.round(huss, 6)), "huss")


@query(sql("wind", f"SELECT location_id, {_DAY}, round(s, 6) AS speed, CASE WHEN s < 0.5 THEN 0.0::DOUBLE WHEN w = 0 THEN 360.0::DOUBLE ELSE w END AS direction FROM (SELECT *, sqrt(u * u + v * v) AS s, round(((270.0::DOUBLE - degrees(atan2(v, u))) % 360 + 360) % 360) AS w FROM wind)"))
def wind_speed_dir(spark, d):
    speed, direction = physics.wind_from_components(F.col("u"), F.col("v"))
    return _rows(cubes.wind(spark, d).withColumns({"speed": F.round(speed, 6), "direction": direction}), "speed", "direction")


@query(sql("wind", f"SELECT location_id, {_DAY}, round(speed * cos(a), 6) + 0.0 AS x, round(speed * sin(a), 6) + 0.0 AS y FROM (SELECT location_id, date, abs(u) AS speed, radians(((270.0::DOUBLE - (v + 6) * 30) % 360 + 360) % 360) AS a FROM wind)"))
def wind_components(spark, d):
    x, y = physics.components_from_wind(F.abs("u"), (F.col("v") + 6) * 30)
    return _rows(cubes.wind(spark, d).withColumns({"x": F.round(x, 6) + 0.0, "y": F.round(y, 6) + 0.0}), "x", "y")


@query(sql("wind", f"SELECT location_id, {_DAY}, least(abs(a - b) % 360, 360 - abs(a - b) % 360)::DOUBLE AS arc FROM (SELECT *, (u + 6) * 30 AS a, (v + 6) * 30 AS b FROM wind)"))
def angle_diff(spark, d):
    return _rows(cubes.wind(spark, d).withColumn("arc", physics.angle_between((F.col("u") + 6) * 30, (F.col("v") + 6) * 30)), "arc")


@query(sql("wind", "SELECT location_id, year, round(((degrees(atan2(s, c)) % 360) + 360) % 360, 4) AS direction FROM (SELECT location_id, year(date)::INT AS year, avg(sin(radians(w))) AS s, avg(cos(radians(w))) AS c FROM (SELECT *, (u + 6) * 30 AS w FROM wind) GROUP BY 1, 2)"))
def circular_mean(spark, d):
    w = cubes.wind(spark, d).withColumn("w", (F.col("u") + 6) * 30)
    return w.groupBy("location_id", F.year("date").alias("year")).agg(F.round(physics.circular_mean(F.col("w")), 4).alias("direction"))


@query(sql("cells", "SELECT location_id, round(degrees(atan2(ny, nx)), 6) AS rlon, round(degrees(asin(nz)), 6) AS rlat FROM (SELECT location_id, (x * cos(p) + y * sin(p)) * cos(t) + z * sin(t) AS nx, y * cos(p) - x * sin(p) AS ny, z * cos(t) - (x * cos(p) + y * sin(p)) * sin(t) AS nz FROM (SELECT *, radians(90 + 39.25::DOUBLE) AS t, radians(18.0::DOUBLE) AS p, cos(radians(lon)) * cos(radians(lat)) AS x, sin(radians(lon)) * cos(radians(lat)) AS y, sin(radians(lat)) AS z FROM cells))"))
def rotate_point(spark, d):
    lon, lat = physics.rotate_pole(F.col("lon"), F.col("lat"), 18.0, 39.25, True)
    return cubes.cells(spark, d).select("location_id", F.round(lon, 6).alias("rlon"), F.round(lat, 6).alias("rlat"))


@query(sql("cells", "SELECT location_id, lon, lat FROM cells WHERE lon BETWEEN 1 AND 3"))
def lon_in_bounds(spark, d):
    return cubes.cells(spark, d).filter(physics.within_bounds(F.col("lon"), 1.0, 3.0))


@query(sql("pr", "SELECT strftime(date, '%Y') AS time, lon AS longitude, lat AS latitude, pr AS value FROM pr"))
def csv_flatten(spark, d):
    return tables.flatten(cubes.precipitation(spark, d).withColumnRenamed("pr", "value"), "year")


@query(sql("obs", "SELECT station_id, strftime(date, '%Y-%m-%d') AS date, arg_min(value, part) AS value FROM (SELECT *, 0 AS part FROM obs WHERE station_id < 'st10' UNION ALL SELECT station_id, date, value + 1, 1 FROM obs WHERE station_id > 'st05') GROUP BY 1, 2"))
def multipart_merge(spark, d):
    obs = cubes.observations(spark, d)
    merged = tables.merge_parts([obs.filter("station_id < 'st10'"), obs.filter("station_id > 'st05'").withColumn("value", F.col("value") + 1)])
    return merged.select("station_id", F.col("date").cast("string").alias("date"), "value")


@query(sql("sim", "SELECT sim_code, count(*)::BIGINT AS n FROM sim WHERE sim_code NOT LIKE '%F_A%' AND sim_code NOT LIKE '%rcp85%' GROUP BY 1"))
def sim_excepts(spark, d):
    parts = spark.createDataFrame([("F_A",), ("rcp85",)], "part string")
    return tables.except_simulations(cubes.simulations(spark, d), parts).groupBy("sim_code").agg(F.count(F.lit(1)).alias("n"))


@query(sql("tas", f"SELECT location_id, {_DAY}, CASE WHEN tasmax IS NOT NULL THEN p END AS p FROM (SELECT *, round((rank() OVER (PARTITION BY location_id, month(date) ORDER BY tasmax NULLS LAST) + (count(tasmax) OVER (PARTITION BY location_id, month(date), tasmax) - 1) / 2.0::DOUBLE) / count(tasmax) OVER (PARTITION BY location_id, month(date)), 6) AS p FROM tas)"))
def pct_rank(spark, d):
    ranked = cubes.temperature(spark, d).withColumn("month", F.month("date")).withColumn("p", F.round(runs.percentile_rank("tasmax", ("location_id", "month")), 6))
    return _rows(ranked, "p")


@query(sql("tas", f"SELECT location_id, {_DAY}, CASE WHEN count(tasmax) OVER w = 5 THEN sum(tasmax) OVER w END AS total FROM tas WINDOW w AS (PARTITION BY location_id ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"))
def rolling_guard(spark, d):
    return _rows(cubes.temperature(spark, d).withColumn("total", runs.rolling("tasmax", 5, F.sum, runs.series())), "total")


@query(sql("", "SELECT DISTINCT 'inst' AS institute, 'model' || (n_nationkey % 3) AS model, CASE WHEN n_nationkey % 2 = 0 THEN 'historical' ELSE 'rcp85' END AS scenario FROM nation"))
def path_catalog(spark, d):
    n = F.col("n_nationkey")
    path = F.concat(F.lit("/data/inst/model"), n % 3, F.lit("/"), F.when(n % 2 == 0, "historical").otherwise("rcp85"), F.lit("/pr.nc"))
    return cubes.table(spark, d, "nation").select(*(c.alias(k) for k, c in tables.simulation_of_path(path).items())).distinct()


@query(sql("", "SELECT n_nationkey::INT AS k, strftime(DATE '1990-01-01' + n_nationkey::INT, '%Y-%m-%d') AS day FROM nation"))
def date_of_name(spark, d):
    path = F.concat(F.lit("/a/b_"), F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), F.col("n_nationkey").cast("int")), "yyyyMMdd"), F.lit(".nc"))
    return cubes.table(spark, d, "nation").select(F.col("n_nationkey").cast("int").alias("k"), tables.date_of_path(path).cast("string").alias("day"))
