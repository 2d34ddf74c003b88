"""Run lengths, rolling windows and ranks over ordered days.

All take a boolean or numeric column of a table with one row per key and day. Frames of one function share a partition
and an order, so each needs one exchange and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

KEYS = ("location_id",)


def series(keys: tuple[str, ...] = KEYS) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy("date")


def backwards(keys: tuple[str, ...] = KEYS) -> WindowSpec:
    """From the last day to here. A frame that is open towards the end of a series costs its square; this one its length."""
    return Window.partitionBy(*keys).orderBy(F.col("date").desc()).rowsBetween(Window.unboundedPreceding, 0)


def rolling(value: str | Column, n: int, how, over: WindowSpec, forward: bool = False, skip: int = 0) -> Column:
    """An aggregate of n rows ending (or beginning) skip rows from here; NULL unless all n are in the series and present."""
    frame = over.rowsBetween(skip, skip + n - 1) if forward else over.rowsBetween(-(n - 1) - skip, -skip)
    return F.when(F.count(value).over(frame) == n, how(value).over(frame))


def runs(df: DataFrame, condition: str | Column, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """A row per run of days that meet the condition: keys, year, length; runs are cut at the new year.

    A run's number is how many days before it failed, so one window suffices and the grouping reuses its partitions. A
    year without a run has one row of length 0.
    """
    ok = F.coalesce(F.expr(condition) if isinstance(condition, str) else condition, F.lit(False))
    marked = df.select(*keys, "date", F.year("date").alias("year"), ok.alias("ok"))
    failed = F.sum((~F.col("ok")).cast("int")).over(Window.partitionBy(*keys, "year").orderBy("date").rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("run", failed).groupBy(*keys, "year", "run").agg(F.sum(F.col("ok").cast("long")).alias("length")).drop("run")


def spells(df: DataFrame, condition: str | Column, at_least: int = 1, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """keys, year, start, end, length of each run of at least so many days; runs are cut at the new year."""
    ok = F.coalesce(F.expr(condition) if isinstance(condition, str) else condition, F.lit(False))
    marked = df.select(*keys, "date", F.year("date").alias("year"), ok.alias("ok"))
    failed = F.sum((~F.col("ok")).cast("int")).over(Window.partitionBy(*keys, "year").orderBy("date").rowsBetween(Window.unboundedPreceding, 0))
    days = marked.withColumn("run", failed).filter("ok").groupBy(*keys, "year", "run")
    return days.agg(F.min("date").alias("start"), F.max("date").alias("end"), F.count(F.lit(1)).alias("length")).filter(F.col("length") >= at_least).drop("run")


def longest_run(df: DataFrame, condition: str | Column, at_least: int = 1, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """value: days of the year's longest run, 0 if shorter than at_least."""
    longest = runs(df, condition, keys).groupBy(*keys, "year").agg(F.max("length").alias("value"))
    return longest.withColumn("value", F.when(F.col("value") >= at_least, F.col("value")).otherwise(0))


def run_total(df: DataFrame, condition: str | Column, at_least: int, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """value: days of the year in runs of at least so many days."""
    return runs(df, condition, keys).groupBy(*keys, "year").agg(F.sum(F.when(F.col("length") >= at_least, F.col("length")).otherwise(0)).alias("value"))


def run_events(df: DataFrame, condition: str | Column, at_least: int, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """value: the year's number of runs of at least so many days."""
    return runs(df, condition, keys).groupBy(*keys, "year").agg(F.count_if((F.col("length") >= at_least) & (F.col("length") > 0)).alias("value"))


def first_doy(df: DataFrame, condition: str | Column, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """value: the year's first day of year that meets the condition, or NULL."""
    ok = F.expr(condition) if isinstance(condition, str) else condition
    return df.groupBy(*keys, F.year("date").alias("year")).agg(F.min(F.when(ok, F.dayofyear("date"))).alias("value"))


def in_any_window(ok_ending_here: str, n: int, over: WindowSpec) -> Column:
    """Whether a day lies in some window of n days that is marked on its last day."""
    return F.coalesce(F.max(F.col(ok_ending_here).cast("int")).over(over.rowsBetween(0, n - 1)), F.lit(0)) == 1


def percentile_rank(value: str, keys: tuple[str, ...]) -> Column:
    """Average rank of a value in its group over the group's count of values; NULL for NULL."""
    group = Window.partitionBy(*keys)
    ties = F.count(value).over(Window.partitionBy(*keys, value))
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(F.col(value).asc_nulls_last()))
    return F.when(F.col(value).isNotNull(), (rank + (ties - 1) / 2) / F.count(value).over(group))
