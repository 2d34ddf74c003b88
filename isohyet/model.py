"""Data model: one row per cell and day; missing is NULL; units are column metadata."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAILY = T.StructType([T.StructField("var", T.StringType()), T.StructField("sim_code", T.StringType()), T.StructField("location_id", T.StringType()), T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType()), T.StructField("date", T.DateType()), T.StructField("value", T.DoubleType())])
ANNUAL = T.StructType([T.StructField("idx", T.StringType()), T.StructField("sim_code", T.StringType()), T.StructField("location_id", T.StringType()), T.StructField("year", T.IntegerType()), T.StructField("value", T.DoubleType())])
STATIONS = T.StructType([T.StructField("station_id", T.StringType()), T.StructField("station_name", T.StringType()), T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])

#: Year whose days of year stand for month-day bounds; it is no leap year.
_PLAIN_YEAR = 1900


def missing_to_null(df: DataFrame, *columns: str) -> DataFrame:
    """NaN becomes NULL, once, on the way in: afterwards aggregates skip it and comparisons are not true of it."""
    return df.withColumns({c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns})


def with_units(df: DataFrame, column: str, units: str) -> DataFrame:
    return df.withMetadata(column, {**df.schema[column].metadata, "units": units})


def units_of(df: DataFrame, column: str) -> str | None:
    return df.schema[column].metadata.get("units")


def require(df: DataFrame, *columns: str) -> None:
    """Reject a table that lacks canonical columns, rather than guess their names."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")


def standardise(df: DataFrame, names: dict[str, str], schema: T.StructType = DAILY) -> DataFrame:
    """A source's table in canonical columns: renamed (names: its name to ours), cast, in the schema's order; the rest goes.

    Columns of the schema that the source lacks are NULL. Names are compared as Spark does, and no two may become one.
    """
    taken = [names.get(c, c) for c in df.columns]
    twice = sorted({c for c in taken if taken.count(c) > 1 and c in schema.names})
    if twice:
        raise ValueError(f"several columns for {twice}")
    source = {ours: c for c, ours in zip(df.columns, taken, strict=True)}
    return df.select(*((df[f"`{source[f.name]}`"] if f.name in source else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))


def doy_of(month_day: str) -> int:
    """Day of year of "mm-dd" in a plain year; 29 February counts as 28 February."""
    month, day = (int(x) for x in month_day.split("-"))
    if (month, day) == (2, 29):
        day = 28
    return date(_PLAIN_YEAR, month, day).timetuple().tm_yday


def month_day_of(doy: int) -> str:
    return (date(_PLAIN_YEAR, 1, 1) + timedelta(days=doy - 1)).strftime("%m-%d")


def month_day(day_of_year: Column) -> Column:
    """month_day_of() of a column."""
    return F.date_format(F.date_add(F.lit(f"{_PLAIN_YEAR}-01-01").cast("date"), day_of_year - 1), "MM-dd")


def is_leap(year: Column) -> Column:
    return (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))


def doy(day: str | Column = "date") -> Column:
    return F.dayofyear(day)


def with_calendar(df: DataFrame) -> DataFrame:
    """Add year, month and doy."""
    return df.withColumns({"year": F.year("date"), "month": F.month("date"), "doy": F.dayofyear("date")})


def in_season(day_of_year: Column, first: int = -1, last: int = -1) -> Column:
    """Whether a day of year lies in [first, last]; -1 leaves an end open; a later first wraps around the new year."""
    lo, hi = (1 if first == -1 else first), (365 if last == -1 else last)
    if hi >= lo:
        return day_of_year.between(lo, hi)
    return (day_of_year <= hi) | (day_of_year >= lo)


def in_season_leap(day: Column, first: int = -1, last: int = -1) -> Column:
    """As in_season, but bounds from March on move by one day in leap years."""
    shift = F.when(is_leap(F.year(day)), 1).otherwise(0)
    lo, hi = (1 if first == -1 else first), (365 if last == -1 else last)
    d = F.dayofyear(day)
    low = F.lit(lo) + (shift if lo >= 60 else F.lit(0))
    high = F.lit(hi) + (shift if hi >= 60 else F.lit(0))
    return d.between(low, high) if hi >= lo else (d <= high) | (d >= low)


def rcp_of(sim_code: Column) -> Column:
    """The emission scenario is the last token of a simulation's code."""
    return F.element_at(F.split(sim_code, "_"), -1)
