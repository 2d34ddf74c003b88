"""Queries of whole workflows over all simulations."""

from __future__ import annotations

from pyspark.sql import functions as F

from isohyet import model
from isohyet.operators import availability, grid, select, workflow
from isohyet.sources import cubes
from isohyet.streaming import aggregates

from . import indices, seasons
from .catalog import ORACLE_SQL, query
from .sql import runs_sql, sql

_KEY = "sim_code, location_id, year(date)::INT AS year"


@query(sql("sim", f"SELECT 'wetdays' AS idx, {_KEY}, (count(*) FILTER (pr >= 20))::DOUBLE AS value FROM sim GROUP BY ALL UNION ALL SELECT 'rx1day', {_KEY}, max(pr) FROM sim GROUP BY ALL UNION ALL SELECT 'cdd', y.sim_code, y.location_id, y.year, coalesce(x.value, 0)::DOUBLE FROM (SELECT DISTINCT {_KEY} FROM sim) y LEFT JOIN (SELECT sim_code, location_id, year, max(length) AS value FROM r GROUP BY 1, 2, 3) x ON x.sim_code = y.sim_code AND x.location_id = y.location_id AND x.year = y.year", r=runs_sql("sim", "pr < 5", "sim_code, location_id")))
def indices_by_simulation(spark, d):
    return workflow.run_indices([("wetdays", 20.0), ("rx1day",), ("cdd", 5.0)], cubes.simulations(spark, d))


@query(sql("sim ref", f"SELECT 'wetdays' AS idx, {_KEY}, (count(*) FILTER (pr >= (SELECT round(quantile_cont(pr::DOUBLE, 0.9), 2) FROM ref)))::DOUBLE AS value FROM sim GROUP BY ALL"))
def index_of_percentile(spark, d):
    return workflow.run_index("wetdays", cubes.simulations(spark, d), "90p", reference=cubes.reference(spark, d))


_DOY = model.doy_of
#: Each index as asked for, under the name of the query whose SQL it is held against.
_ALL = [
    ("txdaysabove", 38.0, _DOY("03-01"), _DOY("11-30"), {"as": "tx_days_above"}), ("tx90p", "90p", {"as": "tx90p"}), ("tndaysbelow", 3.0, _DOY("12-01"), _DOY("02-28"), {"as": "tn_days_below"}),
    ("tngmonthsbelow", 12.0, {"as": "tng_months_below"}), ("hotspellfreq", 30.0, 3, {"as": "hot_spell_frequency"}), ("hotspellmaxlen", 30.0, 3, {"as": "hot_spell_max_length"}), ("hotspelltotlen", 30.0, 3, {"as": "hot_spell_total_length"}),
    ("wsdi", 2), ("heatwavemaxlen", 2.0, 30.0, 2, {"as": "heat_wave_max_length"}), ("heatwavetotlen", 2.0, 30.0, 2, {"as": "heat_wave_total_length"}), ("txg",), ("txx",), ("tng",), ("tnx",), ("tgg",), ("etr",),
    ("tropicalnights", 5.0, {"as": "tropical_nights"}), ("droughtcode", {"as": "drought_code"}), ("rx1day",), ("rx5day",), ("prcptot", _DOY("06-01"), _DOY("10-31")), ("cwd", 20.0), ("cdd", 20.0), ("wetdays", 1.0, {"as": "wet_days"}),
    ("wetdays", 10.0, 20.0, {"as": "wet_days_between"}), ("r10mm",), ("r20mm",), ("drydays", 1.0, {"as": "dry_days"}), ("sdii", 1.0), ("dryspelltotlen", 20.0, 5, "max", {"as": "dry_spell_max"}),
    ("dryspelltotlen", 60.0, 5, "sum", _DOY("03-01"), _DOY("11-30"), {"as": "dry_spell_sum_season"}), ("wxdaysabove", 3.0, {"as": "wx_days_above"}), ("wgdaysabove", 3.0, 180.0, 45.0, {"as": "wg_days_above"}),
    ("rainstart", seasons.START, {"as": "rain_season_start"}), ("rainend", seasons.START, seasons.ENDS["max"], {"as": "rain_season_end_max"}), ("rainlength", seasons.START, seasons.ENDS["max"], {"as": "rain_season_length"}),
    ("rainamount", seasons.START, seasons.ENDS["max"], {"as": "rain_season_prcptot"}), ("rainseason", seasons.START, seasons.ENDS["sum"]),
]
#: The reference of one call is the same for all its indices, so these can't have a shorter one.
_OWN_SQL = {
    "tx90p": indices._count("tas", "tasmax > (SELECT round(quantile_cont(tasmax::DOUBLE, 0.9), 2) FROM tas)"),
    "wsdi": ORACLE_SQL["wsdi"].replace("WHERE year(date) <= 1997 ", ""),
}
#: Every year with days has a row here, also where no day has wind.
_OWN_SQL |= {k: sql("tas", f"SELECT y.location_id, y.year, coalesce(x.value, 0) AS value FROM (SELECT DISTINCT location_id, year(date)::INT AS year FROM tas) y LEFT JOIN ({ORACLE_SQL[k]}) x ON x.location_id = y.location_id AND x.year = y.year") for k in ("wx_days_above", "wg_days_above")}


def _all_sql() -> str:
    labels = [x[-1]["as"] if isinstance(x[-1], dict) and "as" in x[-1] else x[0] for x in _ALL]
    parts = {label: _OWN_SQL.get(label) or ORACLE_SQL[label] for label in labels if label != "rainseason"}
    chain = "SELECT location_id, year, a AS value FROM pair", "SELECT location_id, year, b AS value FROM pair", seasons.LENGTH, seasons.AMOUNT
    parts |= {f"rainseason_{c}": seasons.season_sql(q, "sum") for c, q in zip(("start", "end", "length", "amount"), chain, strict=True)}
    return " UNION ALL ".join(f"SELECT '{label}' AS idx, location_id, year::INT AS year, round(value::DOUBLE, 6) AS value FROM ({q})" for label, q in parts.items())


def _every_variable(spark, d):
    wind = cubes.wind(spark, d).select("location_id", "date", F.abs("u").alias("vv"), ((F.col("v") + 6) * 30).alias("dd"))
    return cubes.temperature(spark, d).withColumn("tas", (F.col("tasmin") + F.col("tasmax")) / 2).join(cubes.precipitation(spark, d).select("location_id", "date", "pr"), ["location_id", "date"]).join(wind, ["location_id", "date"], "left")


@query(_all_sql())
def all_indices(spark, d):
    daily = _every_variable(spark, d)
    found = workflow.run_indices(_ALL, daily, reference=daily, keys=("location_id",))
    return found.select("idx", "location_id", "year", F.round("value", 6).alias("value"))


_Q = "[0.0001::DOUBLE, 0.125::DOUBLE, 0.375::DOUBLE, 0.625::DOUBLE, 0.875::DOUBLE, 0.9999::DOUBLE]"
_PLAIN = "NOT (month(date) = 2 AND day(date) = 29)"


@query(sql("sim ref", "SELECT r.sim_code, r.location_id, strftime(r.date, '%Y-%m-%d') AS date, round(r.pr * greatest(least(f.factor, 3), -3), 6) + 0.0 AS adjusted FROM (SELECT r.*, arg_min(m.node, (abs(m.q - r.p), -m.q)) AS node FROM ranked r CROSS JOIN marks m GROUP BY ALL) r JOIN f ON f.sim_code = r.sim_code AND f.location_id = r.location_id AND f.grp = r.grp AND f.node = r.node WHERE f.factor IS NOT NULL",
           rn="SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY date) AS rn FROM ref WHERE NOT (month(date) = 2 AND day(date) = 29)",
           sn=f"SELECT *, row_number() OVER (PARTITION BY sim_code, location_id ORDER BY date) AS rn FROM sim WHERE {_PLAIN}",
           rq=f"SELECT a.location_id, dayofyear(b.date)::INT AS grp, quantile_cont(a.pr::DOUBLE, {_Q}) AS q FROM rn a JOIN rn b ON a.location_id = b.location_id AND b.rn BETWEEN a.rn - 4 AND a.rn + 5 GROUP BY 1, 2",
           sq=f"SELECT a.sim_code, a.location_id, dayofyear(b.date)::INT AS grp, quantile_cont(a.pr::DOUBLE, {_Q}) AS q FROM sn a JOIN sn b ON a.sim_code = b.sim_code AND a.location_id = b.location_id AND b.rn BETWEEN a.rn - 4 AND a.rn + 5 GROUP BY 1, 2, 3",
           f="SELECT s.sim_code, s.location_id, s.grp, k::INT AS node, r.q[k + 1] / nullif(s.q[k + 1], 0) AS factor FROM rq r JOIN sq s ON r.location_id = s.location_id AND r.grp = s.grp CROSS JOIN range(6) t(k)",
           marks=f"SELECT (k - 1)::INT AS node, {_Q}[k] AS q FROM range(1, 7) t(k)",
           ranked="SELECT sim_code, location_id, date, pr, dayofyear(date)::INT AS grp, (rank() OVER (PARTITION BY sim_code, location_id, dayofyear(date) ORDER BY pr) + (count(*) OVER (PARTITION BY sim_code, location_id, dayofyear(date), pr) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY sim_code, location_id, dayofyear(date)) AS p FROM sn"))
def scenario_adjusted(spark, d):
    found = workflow.scenario(cubes.reference(spark, d), cubes.simulations(spark, d), "pr", "pr", 4, 10)
    return found.filter("adjusted is not null").select("sim_code", "location_id", F.col("date").cast("string").alias("date"), (F.round("adjusted", 6) + 0.0).alias("adjusted"))


@query(sql("pr", "SELECT location_id, strftime(date, '%Y-%m-%d') AS date, CASE WHEN location_id % 4 <> 0 THEN round(avg(pr) * 86400, 6) END AS value FROM pr WHERE lon BETWEEN 0 AND 3 AND lat BETWEEN 1 AND 4 GROUP BY location_id, date"))
def reanalysis_load(spark, d):
    cells = cubes.cells(spark, d)
    raw = cubes.precipitation(spark, d).select("location_id", "date", F.col("pr").alias("value"))
    twice = raw.withColumn("value", F.col("value") - 1).unionByName(raw.withColumn("value", F.col("value") + 1))
    found = workflow.load_reanalysis(twice, "pr", cells, (0.0, 3.0), (1.0, 4.0), cells.filter("location_id % 4 <> 0"), True, "kg m-2 s-1", "mm")
    return found.select("location_id", F.col("date").cast("string").alias("date"), F.round("value", 6).alias("value"))


@query(sql("pr", "SELECT location_id, strftime(date, '%Y-%m-%d') AS date, pr FROM pr WHERE lon BETWEEN 0 AND 2 AND lat BETWEEN 0 AND 2 AND year(date) BETWEEN 1996 AND 1999"))
def extract_series(spark, d):
    pr = cubes.precipitation(spark, d)
    past, future = select.select_period(pr, 1990, 1997), select.select_period(pr, 1998, 2010)
    found = workflow.extract(past, future, cubes.cells(spark, d), (0.0, 2.0), (0.0, 2.0), (1996, 1999))
    return found.select("location_id", F.col("date").cast("string").alias("date"), "pr")


@query(sql("sim", "SELECT s.sim_code, t.target_id, strftime(s.date, '%Y-%m-%d') AS date, round(sum((1 - abs(t.lon - s.lon)) * (1 - abs(t.lat - s.lat)) * s.pr), 6) AS value FROM t JOIN sim s ON abs(t.lon - s.lon) < 1 AND abs(t.lat - s.lat) < 1 WHERE t.lon <= 4 AND t.lat <= 4 GROUP BY 1, 2, 3", t="SELECT location_id::BIGINT AS target_id, lon + 0.25 AS lon, lat + 0.5 AS lat FROM cells"))
def interpolate_simulations(spark, d):
    targets = cubes.cells(spark, d).select(F.col("location_id").cast("long").alias("target_id"), (F.col("lon") + 0.25).alias("lon"), (F.col("lat") + 0.5).alias("lat"))
    daily = cubes.simulations(spark, d).select("sim_code", "location_id", "date", F.col("pr").alias("value"))
    found = workflow.interpolate(daily, grid.bilinear_weights(targets, cubes.cells(spark, d)))
    return found.select("sim_code", "target_id", F.col("date").cast("string").alias("date"), F.round("value", 6).alias("value"))


@query(sql("", "SELECT p_partkey, 'part' || lpad((p_partkey % 120)::VARCHAR, 12, '0') || '-' || lpad((p_partkey % 7)::VARCHAR, 12, '0') AS key FROM part"))
def natural_sort_key(spark, d):
    text = F.concat(F.lit("Part"), F.col("p_partkey") % 120, F.lit("-"), F.col("p_partkey") % 7)
    return cubes.table(spark, d, "part").select("p_partkey", workflow.natural_key(text).alias("key"))


@query(sql("pr", "SELECT location_id, strftime(make_date((2001 + (rn - 1) // 365)::INT, month(x), day(x)), '%Y-%m-%d') AS date, pr FROM (SELECT *, DATE '1900-01-01' + ((rn - 1) % 365)::INT AS x FROM (SELECT location_id, pr, row_number() OVER (PARTITION BY location_id ORDER BY date) AS rn FROM pr WHERE NOT (month(date) = 2 AND day(date) = 29)))"))
def calendar_reset(spark, d):
    found = workflow.reset_calendar(select.remove_feb29(cubes.precipitation(spark, d)), 2001)
    return found.select("location_id", F.col("date").cast("string").alias("date"), "pr")


@query(sql("obs", "SELECT s.station_id, y::INT AS year, count(o.v)::BIGINT AS n FROM (SELECT DISTINCT station_id FROM obs) s CROSS JOIN range(1990, 2005) t(y) LEFT JOIN (SELECT DISTINCT station_id, year(date) AS v FROM obs) o ON o.v = y AND o.station_id = s.station_id GROUP BY 1, 2"))
def years_completed(spark, d):
    from isohyet.operators import resample

    years = cubes.observations(spark, d).select("station_id", F.year("date").alias("year")).distinct().withColumn("has", F.lit(1))
    return resample.complete_years(years, 1990, 2004, ("station_id",)).groupBy("station_id", "year").agg(F.count("has").alias("n"))


@query(sql("obs", "SELECT station_id, (count(*) FILTER (value IS NOT NULL))::BIGINT AS n, count(*)::BIGINT AS n_days FROM (SELECT s.station_id, t.date, o.value FROM (SELECT DISTINCT station_id FROM obs) s CROSS JOIN (SELECT unnest(generate_series(DATE '1996-01-01', DATE '1997-12-31', INTERVAL 1 DAY))::DATE AS date) t LEFT JOIN obs o ON o.station_id = s.station_id AND o.date = t.date) GROUP BY 1"))
def observations_dense(spark, d):
    dense = availability.dense(cubes.observations(spark, d), 1996, 1997)
    return dense.groupBy("station_id").agg(F.count("value").alias("n"), F.count(F.lit(1)).alias("n_days"))


@query(sql("", "SELECT event_type, strftime(ts, '%Y-%m-%d') AS date, round(avg(value), 6) AS mean, round(sum(value), 4) AS sum, count(value)::BIGINT AS n FROM events GROUP BY 1, 2"))
def daily_by_batch(spark, d):
    """The streaming aggregation, over the table as it stands; tests hold the stream itself against it."""
    events = cubes.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    found = aggregates.daily(events)
    return found.select("event_type", F.col("date").cast("string").alias("date"), F.round("mean", 6).alias("mean"), F.round("sum", 4).alias("sum"), "n")
