"""Queries that are SQL text over the engine's views and functions."""

from __future__ import annotations

from isohyet import surface
from isohyet.sources import cubes

from .catalog import query
from .sql import runs_sql, sql


@query(sql("pr tas", "SELECT idx, location_id, year, sum(value)::BIGINT AS value FROM every GROUP BY ALL",
           wet=runs_sql("pr", "pr >= 1"), hot=runs_sql("tas", "tasmax > 30"),
           every="SELECT 'wet_days' AS idx, location_id, year(date)::INT AS year, count(*) FILTER (pr >= 1)::BIGINT AS value FROM pr GROUP BY ALL UNION ALL SELECT 'cwd', y.location_id, y.year, coalesce(max(length), 0) FROM (SELECT DISTINCT location_id, year(date)::INT AS year FROM pr) y LEFT JOIN wet w ON w.location_id = y.location_id AND w.year = y.year GROUP BY ALL UNION ALL SELECT 'tx_days_above', location_id, year(date)::INT, count(*) FILTER (tasmax > 30 AND dayofyear(date) NOT BETWEEN 60 AND 299)::BIGINT FROM tas GROUP BY ALL UNION ALL SELECT 'tropical_nights', location_id, year(date)::INT, count(*) FILTER (tasmin > 10)::BIGINT FROM tas GROUP BY ALL UNION ALL SELECT 'hot_spell_frequency', y.location_id, y.year, count(*) FILTER (length >= 2) FROM (SELECT DISTINCT location_id, year(date)::INT AS year FROM tas) y LEFT JOIN hot w ON w.location_id = y.location_id AND w.year = y.year GROUP BY ALL"))
def indices_in_sql(spark, d):
    """Five indices by SQL text alone."""
    surface.register(spark, daily_pr=cubes.precipitation(spark, d), daily_tas=cubes.temperature(spark, d))
    calls = {"wet_days": "1.0D", "cwd": "1.0D", "tx_days_above": "30.0D, 300, 59", "tropical_nights": "10.0D", "hot_spell_frequency": "30.0D, 2"}
    return spark.sql(" UNION ALL ".join(f"SELECT '{name}' AS idx, location_id, year, value FROM {name}({arguments})" for name, arguments in calls.items()))


@query(sql("tas wind", "SELECT w.location_id, strftime(w.date, '%Y-%m-%d') AS date, round(sqrt(u * u + v * v), 6) AS speed, round(6.11::DOUBLE * pow(10.0::DOUBLE, 7.5::DOUBLE * tasmin / (237.7::DOUBLE + tasmin)), 6) AS hpa FROM wind w JOIN tas t ON t.location_id = w.location_id AND t.date = w.date"))
def functions_in_sql(spark, d):
    """Scalar functions in SQL text, over two views."""
    surface.register(spark, daily_tas=cubes.temperature(spark, d))
    cubes.wind(spark, d).createOrReplaceTempView("daily_wind")
    return spark.sql("SELECT location_id, string(date) AS date, round(wind_speed(u, v), 6) AS speed, round(vapour_pressure(tasmin), 6) AS hpa FROM daily_wind JOIN daily_tas USING (location_id, date)")
