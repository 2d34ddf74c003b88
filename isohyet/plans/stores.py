"""Queries of cubes that are first stored in the formats of climate data and then read from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from isohyet.operators import annual
from isohyet.session import scratch
from isohyet.sources import cubes, netcdf, tables, zarr

from .catalog import ORACLE_SQL, query
from .sql import sql

from . import indices  # noqa: F401  its SQL is used below

_BOX = "lon BETWEEN 1 AND 3 AND lat >= 2 AND date BETWEEN DATE '1996-03-01' AND DATE '1999-02-28'"
_BOX_SQL = f"SELECT location_id::BIGINT AS location_id, year(date)::INT AS year, count(*)::BIGINT AS days, sum(pr)::DOUBLE AS pr FROM pr WHERE {_BOX} GROUP BY ALL"


def _of_box(df):
    return df.filter(_BOX).groupBy("location_id", F.year("date").alias("year")).agg(F.count(F.lit(1)).alias("days"), F.sum("pr").alias("pr"))


@query(sql("pr", _BOX_SQL))
def zarr_box(spark, d):
    """Precipitation as a Zarr store, and a box and period of it: only the chunks that they touch are opened."""
    path = f"{scratch(spark)}/pr.zarr"
    zarr.write_zarr(cubes.precipitation(spark, d), path, ["pr"], (365, 2, 2))
    return _of_box(zarr.read_zarr(spark, path))


@query(sql("tas", "SELECT location_id::BIGINT AS location_id, lon, lat, strftime(date, '%Y-%m-%d') AS date, tasmin, tasmax FROM tas"))
def zarr_round_trip(spark, d):
    """Temperatures of every cell and day through a Zarr store, missing values among them."""
    path = f"{scratch(spark)}/tas.zarr"
    zarr.write_zarr(cubes.temperature(spark, d), path, ["tasmin", "tasmax"], (400, 3, 5), "zlib", 6)
    return zarr.read_zarr(spark, path).select("location_id", "lon", "lat", F.col("date").cast("string").alias("date"), "tasmin", "tasmax")


@query(sql("pr", _BOX_SQL))
def netcdf_box(spark, d):
    """Precipitation as NetCDF files of a year each, and a box and period of them: only their byte ranges are read."""
    files = netcdf.write_netcdf(cubes.precipitation(spark, d), f"{scratch(spark)}/pr", ["pr"]).collect()  # one row a year
    return _of_box(netcdf.read_netcdf(spark, [r.path for r in files]))


#: Indices over stored series, under the names of the queries whose SQL they are held against.
_STORED = [("wetdays", 1.0, {"as": "wet_days"}), ("cdd", 20.0), ("cwd", 20.0), ("rx1day",), ("rx5day",), ("dryspelltotlen", 20.0, 5, "max", {"as": "dry_spell_max"})]


@query(" UNION ALL ".join(f"SELECT '{x}' AS idx, location_id, year::INT AS year, round(value::DOUBLE, 6) AS value FROM ({ORACLE_SQL[x]})" for x in ("wet_days", "cdd", "cwd", "rx1day", "rx5day", "dry_spell_max")))
def indices_of_stored_series(spark, d):
    """Six indices over precipitation that is stored by cell and day: no exchange, no sort."""
    pr = cubes.precipitation(spark, d).select("location_id", "date", "pr")
    path = scratch(spark)
    series = tables.save_by_series(pr, f"series_{path.rsplit('/', 1)[1]}", path, buckets=8)
    found = annual.indices_of(_STORED, series, keys=("location_id",))
    return found.select("idx", "location_id", "year", F.round("value", 6).alias("value"))
