"""How complete station series are."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ALL_MONTHS = tuple(range(1, 13))


def dense(obs: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Each station on each day of whole years; value NULL where there is none."""
    days = F.explode(F.sequence(F.make_date(F.lit(first_year), F.lit(1), F.lit(1)), F.make_date(F.lit(last_year), F.lit(12), F.lit(31))))
    inside = obs.filter(F.col("date").between(F.lit(f"{first_year}-01-01").cast("date"), F.lit(f"{last_year}-12-31").cast("date")))
    return obs.select("station_id").distinct().withColumn("date", days).join(inside.groupBy("station_id", "date").agg(F.max("value").alias("value")), ["station_id", "date"], "left")


def month_gaps(obs: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """station_id, year, month, n_days, n_missing, longest (run of missing days in the month)."""
    d = dense(obs, first_year, last_year).withColumns({"year": F.year("date"), "month": F.month("date"), "gone": F.col("value").isNull().cast("int")})
    here = F.sum(1 - F.col("gone")).over(Window.partitionBy("station_id", "year", "month").orderBy("date").rowsBetween(Window.unboundedPreceding, 0))
    runs = d.withColumn("run", here).groupBy("station_id", "year", "month", "run").agg(F.count(F.lit(1)).alias("n"), F.sum("gone").alias("length"))
    return runs.groupBy("station_id", "year", "month").agg(F.sum("n").alias("n_days"), F.sum("length").alias("n_missing"), F.max("length").alias("longest"))


def month_ok(method: str, most_missing: int = 11, most_in_a_row: int = 5, share: float = 0.1) -> Column:
    """Whether a month counts. wmo: fewer missing days than so many and no run of so many; pct: a smaller share missing."""
    if method == "wmo":
        return (F.col("n_missing") < most_missing) & (F.col("longest") < most_in_a_row)
    if method == "pct":
        return F.col("n_missing") / F.col("n_days") < share
    raise ValueError(f"unknown method: {method}")


def year_availability(gaps: DataFrame, ok: Column, months: tuple[int, ...] = ALL_MONTHS) -> DataFrame:
    """station_id, year, has_data: 1 if all the months in question count."""
    return gaps.filter(F.col("month").isin(*months)).groupBy("station_id", "year").agg((F.count_if(ok) == len(months)).cast("int").alias("has_data"))


def station_table(years: DataFrame, first_year: int, last_year: int, at_least: int = 0) -> DataFrame:
    """A row per station with a 0/1 column y<year> each and n_years_w_data, of stations with at least so many years."""
    wide = years.groupBy("station_id").pivot("year", list(range(first_year, last_year + 1))).agg(F.max("has_data"))
    named = wide.select("station_id", *(F.coalesce(F.col(str(y)), F.lit(0)).alias(f"y{y}") for y in range(first_year, last_year + 1)))
    total = reduce(lambda a, b: a + b, (F.col(f"y{y}") for y in range(first_year, last_year + 1)))
    return named.withColumn("n_years_w_data", total.cast("int")).filter(F.col("n_years_w_data") >= at_least)


def sensitivity(gaps: DataFrame, min_years: list[int], shares: list[float], months: list[tuple[int, ...]], station_key: str = "total") -> DataFrame:
    """n_years, share, months, n_stations for every combination of parameters; gaps are found once for all of them.

    A month's gaps are compared with all shares at once; the parameters are a short list, carried as literals.
    """
    hit = F.lit(True) if station_key == "total" else F.contains(F.col("station_id"), F.lit(station_key))
    sets = F.array(*(F.struct(F.lit(k).alias("set"), F.lit(",".join(map(str, m))).alias("months"), F.lit(len(m)).alias("size"), F.array(*map(F.lit, m)).alias("list")) for k, m in enumerate(months)))
    wanted = gaps.filter(hit).withColumn("p", F.explode(F.filter(sets, lambda m: F.array_contains(m["list"], F.col("month")))))
    wanted = wanted.withColumn("share", F.explode(F.array(*map(F.lit, shares))))
    ok = F.col("n_missing") / F.col("n_days") < F.col("share")
    years = wanted.groupBy("station_id", "year", "share", "p.months", "p.size").agg(F.count_if(ok).alias("n")).withColumn("has", (F.col("n") == F.col("size")).cast("int"))
    stations = years.groupBy("station_id", "share", "months").agg(F.sum("has").alias("years"))
    per = stations.withColumn("n_years", F.explode(F.array(*map(F.lit, min_years))))
    return per.groupBy("n_years", "share", "months").agg(F.count_if(F.col("years") >= F.col("n_years")).alias("n_stations"))
