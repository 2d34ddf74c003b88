"""Resampling in time, calendars and gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import runs

#: How daily values come from hourly ones.
HOURLY = {"mean": F.avg, "min": F.min, "max": F.max, "sum": F.sum}


def hourly_to_daily(df: DataFrame, stats: tuple[str, ...] = ("mean",), value: str = "value", keys: tuple[str, ...] = ("location_id",)) -> DataFrame:
    """Daily statistics of hourly rows (ts), one column for each."""
    return df.groupBy(*keys, F.col("ts").cast("date").alias("date")).agg(*(HOURLY[s](value).alias(s) for s in stats))


def accumulated_to_daily(df: DataFrame) -> DataFrame:
    """Daily amounts of series that are accumulated over the day: the record of 23 h."""
    return df.filter(F.hour("ts") == 23).withColumn("date", F.col("ts").cast("date")).drop("ts")


def sum_or_zero(value: str) -> Column:
    """A sum that is 0, not NULL, where all values are missing."""
    return F.coalesce(F.sum(value), F.lit(0.0))


def annual(df: DataFrame, value: str, how: str = "sum", keys: tuple[str, ...] = ("location_id",)) -> DataFrame:
    agg = sum_or_zero(value) if how == "sum" else F.avg(value)
    return df.groupBy(*keys, F.year("date").alias("year")).agg(agg.alias(value))


def monthly(df: DataFrame, value: str, how: str = "sum", keys: tuple[str, ...] = ("location_id",)) -> DataFrame:
    agg = sum_or_zero(value) if how == "sum" else F.avg(value)
    return df.groupBy(*keys, F.year("date").alias("year"), F.month("date").alias("month")).agg(agg.alias(value))


def spatial_mean(df: DataFrame, value: str, keys: tuple[str, ...] = ("date",)) -> DataFrame:
    """Unweighted mean over cells."""
    return df.groupBy(*keys).agg(F.avg(value).alias(value))


def daily_climatology(df: DataFrame, value: str, keys: tuple[str, ...] = ("location_id",)) -> DataFrame:
    """Mean, least and greatest value of each day of year; in leap years 29 February is not there and later days move up."""
    leap = F.dayofmonth(F.last_day(F.make_date(F.year("date"), F.lit(2), F.lit(1)))) == 29
    d = F.dayofyear("date") - F.when(leap & (F.dayofyear("date") > 60), 1).otherwise(0)
    plain = df.filter(~((F.month("date") == 2) & (F.dayofmonth("date") == 29)))
    return plain.groupBy(*keys, d.alias("doy")).agg(F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"))


def monthly_matrix(df: DataFrame, value: str, how: str = "sum") -> DataFrame:
    """A row per year, a column per month: means over cells of monthly sums or means."""
    by_month = monthly(df, value, how)
    wide = by_month.groupBy("year").pivot("month", list(range(1, 13))).agg(F.avg(value))
    return wide.select("year", *(F.col(str(m)).alias(f"m{m:02d}") for m in range(1, 13)))


def monthly_statistics(df: DataFrame, value: str, how: str = "sum", quantile: float = 0.9, keys: tuple[str, ...] = ("location_id",)) -> DataFrame:
    """Over the years, for each month: mean, min, max and a quantile of monthly sums or means."""
    return monthly(df, value, how, keys).groupBy(*keys, "month").agg(F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"), F.percentile(value, quantile).alias("quantile"))


def mean_scaled(df: DataFrame, value: str, factor: float, keys: tuple[str, ...] = ("location_id",)) -> DataFrame:
    """Annual mean times a factor, such as seconds or days a year."""
    return annual(df, value, "mean", keys).withColumn(value, F.col(value) * F.lit(factor))


def from_360_days(df: DataFrame, value: str, keys: tuple[str, ...] = ("location_id",)) -> DataFrame:
    """A 360-day series (year, doy 1 to 360) on a 365-day one: day k takes the day nearest to k * 360 / 365.

    Every source day is sent to the one or two target days that take it: an equi-join is not needed.
    """
    target = F.explode(F.filter(F.sequence(F.col("doy"), F.col("doy") + 5), lambda k: (F.round(k * 360.0 / 365.0) == F.col("doy")) | ((k == 1) & (F.col("doy") == 1))))
    moved = df.select(*keys, "year", target.alias("target"), value)
    plain = F.date_add(F.make_date(F.lit(1900), F.lit(1), F.lit(1)), F.col("target") - 1)
    return moved.select(*keys, F.make_date("year", F.month(plain), F.dayofmonth(plain)).alias("date"), value)


def plain_calendar(years: DataFrame) -> DataFrame:
    """Each year's 365 days without 29 February."""
    day = F.explode(F.sequence(F.make_date("year", F.lit(1), F.lit(1)), F.make_date("year", F.lit(12), F.lit(31))))
    return years.withColumn("date", day).filter(~((F.month("date") == 2) & (F.dayofmonth("date") == 29)))


def fill_gaps(df: DataFrame, value: str, keys: tuple[str, ...] = ("location_id",)) -> DataFrame:
    """Linear interpolation in time of missing values that have one before and one after."""
    w = Window.partitionBy(*keys).orderBy("date")
    before, after = w.rowsBetween(Window.unboundedPreceding, 0), runs.backwards(keys)
    at = F.when(F.col(value).isNotNull(), F.col("date"))
    ends = df.withColumns({"v0": F.last(value, True).over(before), "d0": F.last(at, True).over(before)}).withColumns({"v1": F.last(value, True).over(after), "d1": F.last(at, True).over(after)})
    share = F.try_divide(F.datediff("date", "d0").cast("double"), F.datediff("d1", "d0").cast("double"))
    return ends.withColumn(value, F.coalesce(value, F.col("v0") + (F.col("v1") - F.col("v0")) * share)).drop("v0", "v1", "d0", "d1")


def fill_days(df: DataFrame, value: str, keys: tuple[str, ...] = ("location_id",)) -> DataFrame:
    """keys, date, value for each day from a series' first known value to its last, linear where days are missing or have no row.

    A known day tells the days up to the next known one, so one window serves, without a join to a calendar.
    """
    w = Window.partitionBy(*keys).orderBy("date")
    known = df.select(*keys, "date", F.col(value).cast("double").alias("v0")).filter("v0 is not null")
    spans = known.withColumns({"d1": F.lead("date").over(w), "v1": F.lead("v0").over(w)}).withColumn("gap", F.datediff("d1", "date"))
    told = spans.withColumn("step", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("gap") - 1, F.lit(0)))))
    share = F.try_divide(F.col("step").cast("double"), F.col("gap").cast("double"))
    return told.select(*keys, F.date_add("date", F.col("step")).alias("date"), F.coalesce(F.col("v0") + (F.col("v1") - F.col("v0")) * share, "v0").alias(value))


def complete_years(df: DataFrame, first: int, last: int, keys: tuple[str, ...]) -> DataFrame:
    """Rows for every year of a range; what was absent is NULL."""
    every = df.select(*keys).distinct().withColumn("year", F.explode(F.sequence(F.lit(first), F.lit(last))))
    return every.join(df, [*keys, "year"], "left")
