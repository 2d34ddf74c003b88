"""Queries of data availability."""

from __future__ import annotations

from pyspark.sql import functions as F

from isohyet.operators import availability as av
from isohyet.operators import select
from isohyet.sources import cubes

from .catalog import query
from .sql import sql

_Y1, _Y2 = 1995, 2001
_GAPS = {
    "dense": f"SELECT s.station_id, t.date, o.value IS NULL AS gone FROM (SELECT DISTINCT station_id FROM obs) s CROSS JOIN (SELECT unnest(generate_series(DATE '{_Y1}-01-01', DATE '{_Y2}-12-31', INTERVAL 1 DAY))::DATE AS date) t LEFT JOIN obs o ON o.station_id = s.station_id AND o.date = t.date",
    "runs": "SELECT station_id, y, m, max(n) AS longest FROM (SELECT station_id, y, m, count(*) AS n FROM (SELECT station_id, year(date)::INT AS y, month(date)::INT AS m, gone, row_number() OVER (PARTITION BY station_id, year(date), month(date) ORDER BY date) - row_number() OVER (PARTITION BY station_id, year(date), month(date), gone ORDER BY date) AS g FROM dense) WHERE gone GROUP BY station_id, y, m, g) GROUP BY 1, 2, 3",
    "gaps": "SELECT a.*, coalesce(r.longest, 0)::BIGINT AS longest FROM (SELECT station_id, year(date)::INT AS year, month(date)::INT AS month, count(*)::BIGINT AS n_days, (count(*) FILTER (gone))::BIGINT AS n_missing FROM dense GROUP BY ALL) a LEFT JOIN runs r ON r.station_id = a.station_id AND r.y = a.year AND r.m = a.month",
}


def _gaps(spark, d):
    return av.month_gaps(cubes.observations(spark, d), _Y1, _Y2)


@query(sql("obs", "SELECT * FROM gaps", **_GAPS))
def avail_month_gaps(spark, d):
    return _gaps(spark, d)


def _wide(ok: str, months: str, n: int, least: int) -> str:
    cols = ", ".join(f"(count(*) FILTER (year = {y} AND has))::INT AS y{y}" for y in range(_Y1, _Y2 + 1))
    total = " + ".join(f"y{y}" for y in range(_Y1, _Y2 + 1))
    return f"SELECT *, ({total})::INT AS n_years_w_data FROM (SELECT station_id, {cols} FROM (SELECT station_id, year, count(*) FILTER ({ok}) = {n} AS has FROM gaps WHERE {months} GROUP BY 1, 2) GROUP BY 1) WHERE {total} >= {least}"


@query(sql("obs", _wide("n_missing < 25 AND longest < 12", "true", 12, 1), **_GAPS))
def avail_wmo(spark, d):
    return av.station_table(av.year_availability(_gaps(spark, d), av.month_ok("wmo", 25, 12)), _Y1, _Y2, 1)


@query(sql("obs", _wide("n_missing::DOUBLE / n_days < 0.6", "month IN (6, 7, 8)", 3, 0), **_GAPS))
def avail_pct(spark, d):
    months = (6, 7, 8)
    return av.station_table(av.year_availability(_gaps(spark, d), av.month_ok("pct", share=0.6), months), _Y1, _Y2)


@query(sql("obs", "SELECT n_years::INT AS n_years, share, months, (count(*) FILTER (years >= n_years))::BIGINT AS n_stations FROM (SELECT station_id, share, months, count(*) FILTER (has) AS years FROM (SELECT station_id, year, share, months, count(*) FILTER (n_missing::DOUBLE / n_days < share) = size AS has FROM gaps, (VALUES (0.5::DOUBLE), (0.7::DOUBLE)) s(share), (VALUES ('6,7,8', [6, 7, 8], 3), ('1,2', [1, 2], 2)) m(months, list, size) WHERE list_contains(list, month) GROUP BY station_id, year, share, months, size) GROUP BY 1, 2, 3), (VALUES (1), (3)) n(n_years) GROUP BY 1, 2, 3", **_GAPS))
def avail_sensitivity(spark, d):
    return av.sensitivity(_gaps(spark, d), [1, 3], [0.5, 0.7], [(6, 7, 8), (1, 2)])


@query(sql("obs", "SELECT count(DISTINCT station_id)::BIGINT AS n FROM obs WHERE contains(station_id, '1')"))
def stn_key_count(spark, d):
    return select.count_matching(cubes.observations(spark, d).select("station_id").distinct(), "1").select(F.col("n").cast("long").alias("n"))
