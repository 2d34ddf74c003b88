"""The engine in SQL: views over cubes, and functions that Catalyst inlines into the queries that call them.

    surface.register(spark, daily_pr=..., daily_tas=...)
    spark.sql("SELECT * FROM wet_days(1.0) WHERE year > 2000")

Table functions are queries of the views; nothing runs in Python, and filters reach the cubes through them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from isohyet import model

#: Of each view: the columns that its functions read.
VIEWS = {"daily_pr": ("location_id", "date", "pr"), "daily_tas": ("location_id", "date", "tasmin", "tasmax")}

_ANNUAL = "RETURNS TABLE (location_id INT, year INT, value {})"
_COUNT = "SELECT location_id, year, count_if(ok) FROM (SELECT location_id, year(date) AS year, {} AS ok FROM {}) GROUP BY location_id, year"
# parameters are compared below the aggregates, as Spark asks
_RUNS = "SELECT location_id, year, {} FROM (SELECT location_id, year, length, {} AS long FROM (SELECT location_id, year, sum(int(ok)) AS length FROM (SELECT location_id, year, ok, sum(int(NOT ok)) OVER (PARTITION BY location_id, year ORDER BY date) AS run FROM (SELECT location_id, year(date) AS year, date, coalesce({}, false) AS ok FROM {})) GROUP BY location_id, year, run)) GROUP BY location_id, year"

#: Name and parameters, what it returns, its body, and the view it reads (None: a scalar function).
FUNCTIONS = [
    ("wet_days(threshold DOUBLE)", _ANNUAL.format("BIGINT"), _COUNT.format("pr >= wet_days.threshold", "daily_pr"), "daily_pr"),
    ("dry_days(threshold DOUBLE)", _ANNUAL.format("BIGINT"), _COUNT.format("pr < dry_days.threshold", "daily_pr"), "daily_pr"),
    ("prcptot()", _ANNUAL.format("DOUBLE"), "SELECT location_id, year(date), sum(pr) FROM daily_pr GROUP BY location_id, year(date)", "daily_pr"),
    ("rx1day()", _ANNUAL.format("DOUBLE"), "SELECT location_id, year(date), max(pr) FROM daily_pr GROUP BY location_id, year(date)", "daily_pr"),
    ("cwd(threshold DOUBLE)", _ANNUAL.format("BIGINT"), _RUNS.format("max(length)", "true", "pr >= cwd.threshold", "daily_pr"), "daily_pr"),
    ("cdd(threshold DOUBLE)", _ANNUAL.format("BIGINT"), _RUNS.format("max(length)", "true", "pr < cdd.threshold", "daily_pr"), "daily_pr"),
    ("tx_days_above(threshold DOUBLE, first INT, last INT)", _ANNUAL.format("BIGINT"), _COUNT.format("tasmax > tx_days_above.threshold AND in_season(dayofyear(date), tx_days_above.first, tx_days_above.last)", "daily_tas"), "daily_tas"),
    ("tropical_nights(threshold DOUBLE)", _ANNUAL.format("BIGINT"), _COUNT.format("tasmin > tropical_nights.threshold", "daily_tas"), "daily_tas"),
    ("hot_spell_frequency(threshold DOUBLE, days INT)", _ANNUAL.format("BIGINT"), _RUNS.format("count_if(long)", "length >= hot_spell_frequency.days", "tasmax > hot_spell_frequency.threshold", "daily_tas"), "daily_tas"),
    ("in_season(day INT, first INT, last INT)", "RETURNS BOOLEAN", "CASE WHEN last >= first THEN day BETWEEN first AND last ELSE day <= last OR day >= first END", None),
    ("vapour_pressure(celsius DOUBLE)", "RETURNS DOUBLE", "6.11D * pow(10D, 7.5D * celsius / (237.7D + celsius))", None),
    ("wind_speed(u DOUBLE, v DOUBLE)", "RETURNS DOUBLE", "sqrt(u * u + v * v)", None),
    ("angle_between(a DOUBLE, b DOUBLE)", "RETURNS DOUBLE", "least(pmod(a - b, 360D), 360D - pmod(a - b, 360D))", None),
]


def register(spark: SparkSession, **views: DataFrame) -> list[str]:
    """Make the views and the functions that read them; returns the functions' names. Called again, it replaces both."""
    for name, df in views.items():
        model.require(df, *VIEWS[name])
        df.createOrReplaceTempView(name)
    made = []
    for signature, returns, body, view in sorted(FUNCTIONS, key=lambda f: f[3] is not None):  # scalar functions first: others call them
        if view is None or view in views:
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} {returns} RETURN {body}")
            made.append(signature.split("(")[0])
    return made
