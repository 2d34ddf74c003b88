"""Queries of annual climate indices."""

from __future__ import annotations

from pyspark.sql import functions as F

from isohyet import model
from isohyet.functions import physics
from isohyet.operators import indices as ix
from isohyet.operators import runs, select
from isohyet.sources import cubes

from .catalog import query
from .sql import runs_sql, sql

_KEY = "location_id, year(date)::INT AS year"


def _count(cube: str, condition: str, where: str = "true") -> str:
    return sql(cube, f"SELECT {_KEY}, (count(*) FILTER ({condition}))::BIGINT AS value FROM {cube} WHERE {where} GROUP BY 1, 2")


def _agg(cube: str, agg: str) -> str:
    return sql(cube, f"SELECT {_KEY}, {agg} AS value FROM {cube} GROUP BY 1, 2")


def _runs(cube: str, condition: str, agg: str) -> str:
    """Aggregates over runs; years of the period without a run have 0."""
    return sql(cube, f"SELECT y.location_id, y.year, coalesce(x.value, 0)::BIGINT AS value FROM (SELECT DISTINCT {_KEY} FROM {cube}) y LEFT JOIN (SELECT location_id, year, {agg} AS value FROM r GROUP BY 1, 2) x ON x.location_id = y.location_id AND x.year = y.year", r=runs_sql(cube, condition))


def _season(first: str, last: str) -> str:
    a, b = model.doy_of(first), model.doy_of(last)
    return f"dayofyear(date) BETWEEN {a} AND {b}" if a <= b else f"(dayofyear(date) >= {a} OR dayofyear(date) <= {b})"


_pr, _tas = cubes.precipitation, cubes.temperature


# --- temperature -----------------------------------------------------------------------------------------------------


@query(_count("tas", "tasmax > 38", _season("03-01", "11-30")))
def tx_days_above(spark, d):
    return ix.days_above(_tas(spark, d), "tasmax", 38.0, model.doy_of("03-01"), model.doy_of("11-30"))


_P90 = "(SELECT round(quantile_cont(tasmax::DOUBLE, 0.9), 2) FROM tas WHERE date BETWEEN DATE '1995-01-01' AND DATE '1996-12-31')"


@query(_count("tas", f"tasmax > {_P90}"))
def tx90p(spark, d):
    tas = _tas(spark, d)
    return ix.days_above_reference(tas, ix.reference_quantile(select.select_period(tas, 1995, 1996), "tasmax", 0.9), "tasmax")


@query(_count("tas", "tasmin < 3", _season("12-01", "02-28")))
def tn_days_below(spark, d):
    return ix.days_below(_tas(spark, d), "tasmin", 3.0, model.doy_of("12-01"), model.doy_of("02-28"))


@query(sql("tas", "SELECT location_id, year, (count(*) FILTER (m < 12))::BIGINT AS value FROM (SELECT location_id, year(date)::INT AS year, month(date), avg(tasmin) AS m FROM tas GROUP BY ALL) GROUP BY 1, 2"))
def tng_months_below(spark, d):
    return ix.months_below(_tas(spark, d), "tasmin", 12.0)


@query(_runs("tas", "tasmax > 30", "count(*) FILTER (length >= 3)"))
def hot_spell_frequency(spark, d):
    return ix.hot_spell_frequency(_tas(spark, d), "tasmax", 30.0, 3)


@query(_runs("tas", "tasmax > 30", "CASE WHEN max(length) >= 3 THEN max(length) ELSE 0 END"))
def hot_spell_max_length(spark, d):
    return ix.hot_spell_max_length(_tas(spark, d), "tasmax", 30.0, 3)


@query(sql("tas", f"SELECT {_KEY}, (count(*) FILTER (EXISTS (SELECT 1 FROM e WHERE e.location_id = n.location_id AND e.rn BETWEEN n.rn AND n.rn + 2 AND e.ends)))::BIGINT AS value FROM n GROUP BY 1, 2", n="SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY date) AS rn FROM tas", e="SELECT location_id, rn, count(tasmax) OVER w = 3 AND min(tasmax) OVER w >= 30 AS ends FROM n WINDOW w AS (PARTITION BY location_id ORDER BY rn ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"))
def hot_spell_total_length(spark, d):
    return ix.hot_spell_total_length(_tas(spark, d), "tasmax", 30.0, 3)


@query(sql("tas", "SELECT y.location_id, y.year, coalesce(x.value, 0)::BIGINT AS value FROM (SELECT DISTINCT location_id, year(date)::INT AS year FROM tas) y LEFT JOIN (SELECT location_id, year, sum(length) FILTER (length >= 2) AS value FROM r GROUP BY 1, 2) x ON x.location_id = y.location_id AND x.year = y.year",
           thr="SELECT location_id, ((least(dayofyear(date), 365) - 1 + k + 365) % 365 + 1)::INT AS doy, quantile_cont(tasmax::DOUBLE, 0.9) AS t FROM tas, (SELECT unnest([-2, -1, 0, 1, 2]) AS k) WHERE year(date) <= 1997 GROUP BY 1, 2", hot="SELECT tas.*, thr.t FROM tas LEFT JOIN thr ON thr.location_id = tas.location_id AND thr.doy = least(dayofyear(date), 365)", r=runs_sql("hot", "tasmax > t")))
def wsdi(spark, d):
    tas = _tas(spark, d)
    return ix.warm_spell_duration(tas, ix.doy_percentile(select.select_period(tas, 1995, 1997), "tasmax"), "tasmax", 2)


@query(_runs("tas", "tasmin > 2 AND tasmax > 30", "CASE WHEN max(length) >= 2 THEN max(length) ELSE 0 END"))
def heat_wave_max_length(spark, d):
    return ix.heat_wave_max_length(_tas(spark, d), 2.0, 30.0, 2)


@query(_runs("tas", "tasmin > 2 AND tasmax > 30", "coalesce(sum(length) FILTER (length >= 2), 0)"))
def heat_wave_total_length(spark, d):
    return ix.heat_wave_total_length(_tas(spark, d), 2.0, 30.0, 2)


@query(sql("tas", "SELECT coalesce(a.location_id, b.location_id) AS location_id, (count(*) FILTER (coalesce(a.tasmin > 2, false) AND coalesce(b.tasmax > 30, false)))::BIGINT AS n, count(*)::BIGINT AS n_days FROM (SELECT * FROM tas WHERE month(date) <> 1) a FULL JOIN (SELECT * FROM tas WHERE month(date) <> 12) b ON a.location_id = b.location_id AND a.date = b.date GROUP BY 1"))
def heat_wave_unaligned(spark, d):
    tas = _tas(spark, d)
    nights = tas.filter("month(date) <> 1").select("location_id", "date", F.coalesce(F.col("tasmin") > 2, F.lit(False)).alias("ok"))
    days = tas.filter("month(date) <> 12").select("location_id", "date", F.coalesce(F.col("tasmax") > 30, F.lit(False)).alias("ok"))
    both = select.merge_unaligned(nights, days, ["location_id", "date"])
    return both.groupBy("location_id").agg(F.count_if("ok").alias("n"), F.count(F.lit(1)).alias("n_days"))


for _name, _value, _how, _sql in (("txg", "tasmax", ix.annual_mean, "round(avg(tasmax), 6)"), ("txx", "tasmax", ix.annual_max, "max(tasmax)"), ("tng", "tasmin", ix.annual_mean, "round(avg(tasmin), 6)"), ("tnx", "tasmin", ix.annual_max, "max(tasmin)")):
    query(_agg("tas", _sql), _name)(lambda spark, d, value=_value, how=_how: how(_tas(spark, d), value).withColumn("value", F.round("value", 6)))


@query(_count("tas", "tasmin > 5"))
def tropical_nights(spark, d):
    return ix.tropical_nights(_tas(spark, d), 5.0)


@query(_agg("tas", "round(avg((tasmin + tasmax) / 2), 6)"))
def tgg(spark, d):
    return ix.mean_temperature(_tas(spark, d)).withColumn("value", F.round("value", 6))


@query(_agg("tas", "max(tasmax) - min(tasmin)"))
def etr(spark, d):
    return ix.extreme_range(_tas(spark, d))


_DRIED = "greatest(0, 0.36 * (greatest(x.t, -2.8) + 2.8) + 1.4) * 0.5"
_WETTED = "greatest(0, d.code - 400 * ln(1 + 3.937 * (0.83 * x.r - 1.27) / (800 * exp(-d.code / 400))))"


@query("WITH RECURSIVE " + sql("tas pr", f"SELECT location_id, year(date)::INT AS year, round(avg(code), 6) AS value FROM d WHERE rn > 0 GROUP BY 1, 2",
           x="SELECT tas.location_id, tas.date, (tasmin::DOUBLE + tasmax::DOUBLE) / 2 AS t, pr::DOUBLE AS r, row_number() OVER (PARTITION BY tas.location_id ORDER BY tas.date) AS rn FROM tas JOIN pr ON pr.location_id = tas.location_id AND pr.date = tas.date",
           d=f"SELECT DISTINCT location_id, NULL::DATE AS date, 0::BIGINT AS rn, 15::DOUBLE AS code FROM x UNION ALL SELECT x.location_id, x.date, x.rn, CASE WHEN x.t IS NULL OR x.r IS NULL THEN d.code ELSE CASE WHEN x.r > 2.8 THEN {_WETTED} ELSE d.code END + {_DRIED} END FROM d JOIN x ON x.location_id = d.location_id AND x.rn = d.rn + 1").removeprefix("WITH "))
def drought_code(spark, d):
    both = _tas(spark, d).withColumn("tas", (F.col("tasmin") + F.col("tasmax")) / 2).join(_pr(spark, d).select("location_id", "date", "pr"), ["location_id", "date"])
    return ix.drought_code(both).withColumn("value", F.round("value", 6))


# --- precipitation ---------------------------------------------------------------------------------------------------


@query(_agg("pr", "max(pr)"))
def rx1day(spark, d):
    return ix.max_amount(_pr(spark, d))


@query(sql("pr", f"SELECT {_KEY}, max(s) AS value FROM (SELECT location_id, date, CASE WHEN count(*) OVER w = 5 THEN sum(pr) OVER w END AS s FROM pr WINDOW w AS (PARTITION BY location_id ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) GROUP BY 1, 2"))
def rx5day(spark, d):
    return ix.max_amount(_pr(spark, d), 5)


@query(sql("pr", f"SELECT {_KEY}, sum(pr) AS value FROM pr WHERE {_season('06-01', '10-31')} GROUP BY 1, 2"))
def prcptot(spark, d):
    return ix.total_amount(_pr(spark, d), model.doy_of("06-01"), model.doy_of("10-31"))


@query(sql("pr", "SELECT round(quantile_cont(t, 0.9), 2) AS threshold FROM (SELECT year, avg(total) AS t FROM (SELECT location_id, year(date) AS year, sum(pr) AS total FROM pr GROUP BY ALL) GROUP BY year)"))
def prcptot_threshold(spark, d):
    return ix.reference_total_quantile(_pr(spark, d), "pr", 0.9)


@query(_runs("pr", "pr >= 20", "max(length)"))
def cwd(spark, d):
    return ix.consecutive_wet_days(_pr(spark, d), 20.0)


@query(_runs("pr", "pr < 20", "max(length)"))
def cdd(spark, d):
    return ix.consecutive_dry_days(_pr(spark, d), 20.0)


@query(_count("pr", "pr >= 1"))
def wet_days(spark, d):
    return ix.wet_days(_pr(spark, d), 1.0)


@query(_count("pr", "pr >= 10 AND pr < 20"))
def wet_days_between(spark, d):
    return ix.wet_days(_pr(spark, d), 10.0, 20.0)


@query(_count("pr", "pr >= 10"))
def r10mm(spark, d):
    return ix.wet_days(_pr(spark, d), 10.0)


@query(_count("pr", "pr >= 20"))
def r20mm(spark, d):
    return ix.wet_days(_pr(spark, d), 20.0)


@query(_count("pr", "pr < 1"))
def dry_days(spark, d):
    return ix.dry_days(_pr(spark, d), 1.0)


@query(_agg("pr", "floor(avg(pr) FILTER (pr >= 1))::DOUBLE"))
def sdii(spark, d):
    return ix.daily_intensity(_pr(spark, d), 1.0)


def _dry_sql(op: str, threshold: int, window: int, season: str) -> str:
    """The definition: a day is dry if some dry window holds it."""
    amount = f"CASE WHEN pr < {threshold if op == 'max' else 0} THEN 0 ELSE pr END"
    return sql("pr", f"SELECT {_KEY}, (count(*) FILTER (({season}) AND EXISTS (SELECT 1 FROM e WHERE e.location_id = n.location_id AND e.rn BETWEEN n.rn AND n.rn + {window - 1} AND e.ends)))::BIGINT AS value FROM n GROUP BY 1, 2", n="SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY date) AS rn FROM pr", e=f"SELECT location_id, rn, rn >= {window} AND {op}({amount}) OVER (PARTITION BY location_id ORDER BY rn ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW) < {threshold} AS ends FROM n")


@query(_dry_sql("max", 20, 5, "true"))
def dry_spell_max(spark, d):
    return ix.dry_spell_total_length(_pr(spark, d), 20.0, 5, "max")


@query(_dry_sql("sum", 60, 5, "dayofyear(date) BETWEEN 60 + s AND 334 + s").replace("FROM n GROUP", "FROM (SELECT *, CASE WHEN day(last_day(make_date(year(date), 2, 1))) = 29 THEN 1 ELSE 0 END AS s FROM n) n GROUP"))
def dry_spell_sum_season(spark, d):
    return ix.dry_spell_total_length(_pr(spark, d), 60.0, 5, "sum", model.doy_of("03-01"), model.doy_of("11-30"))


@query(sql("pr", f"SELECT {_KEY}, (count(*) FILTER (EXISTS (SELECT 1 FROM e WHERE e.location_id = n.location_id AND e.rn BETWEEN n.rn AND n.rn + 4 AND e.ends)))::BIGINT AS value FROM n GROUP BY 1, 2", n="SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY date) AS rn FROM pr", e="SELECT location_id, rn, rn >= 5 AND sum(pr) OVER (PARTITION BY location_id ORDER BY rn ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) < 80 AS ends FROM n"))
def dry_spell_raw(spark, d):
    return ix.dry_spell_total_length_raw(_pr(spark, d), 80.0, 5)


# --- wind ------------------------------------------------------------------------------------------------------------


def _wind(spark, d):
    return cubes.wind(spark, d).select("location_id", "date", F.abs("u").alias("vv"), ((F.col("v") + 6) * 30).alias("dd"))


@query(sql("wind", f"SELECT {_KEY}, (count(*) FILTER (abs(u) > 3))::BIGINT AS value FROM wind WHERE dayofyear(date) BETWEEN 1 AND 365 GROUP BY 1, 2"))
def wx_days_above(spark, d):
    return ix.strong_wind_days(_wind(spark, d), 3.0)


@query(sql("wind", f"SELECT {_KEY}, (count(*) FILTER (abs(u) > 3 AND (v + 6) * 30 - 180 <= 45))::BIGINT AS value FROM wind WHERE dayofyear(date) BETWEEN 1 AND 365 GROUP BY 1, 2"))
def wg_days_above(spark, d):
    return ix.strong_wind_days(_wind(spark, d), 3.0, 180.0, 45.0)


@query(sql("wind", f"SELECT {_KEY}, (count(*) FILTER (abs(u) > 3 AND least(abs(a - 10) % 360, 360 - abs(a - 10) % 360) <= 45))::BIGINT AS value FROM (SELECT *, (v + 6) * 30 AS a FROM wind) WHERE dayofyear(date) BETWEEN 1 AND 365 GROUP BY 1, 2"))
def w_days_above_circular(spark, d):
    return ix.strong_wind_days(_wind(spark, d), 3.0, 10.0, 45.0, circular=True)


# --- runs on their own -----------------------------------------------------------------------------------------------


@query(_runs("pr", "pr > 30", "max(length)"))
def longest_run(spark, d):
    return runs.longest_run(_pr(spark, d), "pr > 30")


@query(_runs("pr", "pr > 30", "coalesce(sum(length) FILTER (length >= 3), 0)"))
def run_total(spark, d):
    return runs.run_total(_pr(spark, d), "pr > 30", 3)


@query(_runs("pr", "pr > 30", "count(*) FILTER (length >= 3)"))
def run_events(spark, d):
    return runs.run_events(_pr(spark, d), "pr > 30", 3)


@query(sql("pr", f"SELECT {_KEY}, min(CASE WHEN pr > 60 THEN dayofyear(date) END)::INT AS value FROM pr GROUP BY 1, 2"))
def first_doy(spark, d):
    return runs.first_doy(_pr(spark, d), "pr > 60")


@query(sql("pr", "SELECT y.location_id, y.year, CASE WHEN y.location_id IN (SELECT location_id FROM pr GROUP BY 1 HAVING max(pr) >= 150) THEN y.value END AS value FROM (SELECT location_id, year(date)::INT AS year, max(pr) AS value FROM pr GROUP BY 1, 2) y"))
def index_masked(spark, d):
    pr = _pr(spark, d)
    land = pr.groupBy("location_id").agg(F.max("pr").alias("m")).filter("m >= 150")
    return ix.mask_index(ix.max_amount(pr), land)


@query(sql("wind", f"SELECT {_KEY}, round(max(sqrt(u * u + v * v)), 6) AS value FROM wind GROUP BY 1, 2"))
def annual_max_wind(spark, d):
    speed = cubes.wind(spark, d).withColumn("speed", physics.wind_speed(F.col("u"), F.col("v")))
    return ix.annual_max(speed, "speed").withColumn("value", F.round("value", 6))
