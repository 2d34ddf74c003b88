"""Whole workflows over all simulations at once: loading, extraction, scenarios, indices by name.

A simulation is a key, not a loop: one plan serves all of them, and thresholds that come from the reference are a table
of one row that every simulation is joined to.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.functions import physics

from . import annual, grid, quantile_mapping, resample, select

SIM_KEYS = annual.SIM_KEYS

#: Variables that are amounts: their annual value is a sum and their bias a ratio.
SUMMABLE = ("pr", "evspsbl", "evspsblpot")
#: Variables whose sign the source gives the other way round.
FLIPPED = ("evspsbl", "evspsblpot")


def load_reanalysis(df: DataFrame, var: str, cells: DataFrame, lon: tuple[float, float], lat: tuple[float, float], land: DataFrame | None = None, duplicates: bool = False, old_units: str | None = None, new_units: str | None = None) -> DataFrame:
    """Reference series of a box: repeated cell-days are averaged, sea is NULL, units converted, evaporation made positive."""
    out = select.subset_box(df, cells, lon, lat)
    if duplicates:
        out = out.groupBy("location_id", "date").agg(F.avg("value").alias("value"))
    if land is not None:
        out = select.apply_mask(out, land, "value")
    value: Column = F.col("value")
    if old_units and new_units:
        value = physics.convert(value, old_units, new_units)
    return out.withColumn("value", -value if var in FLIPPED else value)


def extract(historical: DataFrame, future: DataFrame, cells: DataFrame, lon: tuple[float, float], lat: tuple[float, float], years: tuple[int, int], value: str = "value", step: tuple[float, float] | None = None, keys: tuple[str, ...] = ("date",)) -> DataFrame:
    """Historical and future rows of a box and a range of years, as one series.

    Where cells are those of a rotated grid (columns rlon and rlat beside lon and lat), the series comes on a regular grid of
    the given steps instead, as to_regular() gives it: keys, location_id (new), lon, lat, value.
    """
    series = select.select_period(historical.unionByName(future), *years)
    if not grid.has_rotated_axes(cells):
        return select.subset_box(series, cells, lon, lat)
    if step is None:
        raise ValueError("cells of a rotated grid need the steps of the regular one")
    return to_regular(series, grid.with_places(cells), value, *step, keys, (lon, lat))


def to_regular(df: DataFrame, cells: DataFrame, value: str, step_lon: float, step_lat: float, keys: tuple[str, ...] = ("date",), box: tuple[tuple[float, float], tuple[float, float]] | None = None) -> DataFrame:
    """Values of a rotated or otherwise bent grid on a regular one over it: keys, location_id (new), lon, lat, value.

    cells: location_id, places i and j in the grid, lon, lat. Targets outside the bent grid get no rows; values whose
    corners are not all known are NULL. With a box only its targets are kept, and only cells around them are joined.
    """
    targets = grid.regular_targets(cells, step_lon, step_lat)
    if box:
        for axis, (low, high) in zip(("lon", "lat"), box, strict=True):
            targets = targets.filter(F.col(axis).between(low - grid.SNAP, high + grid.SNAP))
    found = grid.regrid(df, grid.curvilinear_weights(targets, cells, max(step_lon, step_lat)), value, keys)
    return found.join(targets, "target_id").select(*keys, F.col("target_id").alias("location_id"), "lon", "lat", value)


def is_hourly(df: DataFrame, keys: tuple[str, ...] = ("location_id",)) -> bool:
    """Whether a day has more than one record of a cell: a look at one day of one cell, the first row's."""
    one = df.select(*keys, F.col("ts").cast("date").alias("day")).first()
    if one is None:
        return False
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.lit(one[k]))
    return df.filter(same & (F.col("ts").cast("date") == F.lit(one["day"]))).limit(2).count() > 1


def interpolate(df: DataFrame, weights: DataFrame, keys: tuple[str, ...] = ("sim_code", "date")) -> DataFrame:
    """Daily values on the reference's grid; weights come from grid.bilinear_weights or, for stations, select.nearest_cells.

    Records by ts instead of date are averaged by day first, which leaves daily ones as they are.
    """
    if "ts" in df.columns and "date" not in df.columns:
        own = [k for k in keys if k != "date"]
        df = df.groupBy(*own, "location_id", F.col("ts").cast("date").alias("date")).agg(F.avg("value").alias("value"))
    if "weight" not in weights.columns:
        return df.join(weights.withColumnRenamed("station_id", "target_id"), "location_id")
    met = df.join(weights, "location_id")
    return met.groupBy(*keys, "target_id").agg(F.when(F.count("value") == F.count(F.lit(1)), F.sum(F.col("weight") * F.col("value"))).alias("value"))


def scenario(reference: DataFrame, simulations: DataFrame, value: str, var: str, nq: int = 50, window: int = 30, limit: float = 3.0, years: tuple[int, int] | None = None) -> DataFrame:
    """Bias-adjusted series of every simulation (sim_code, location_id, date): column adjusted."""
    volumetric = var in SUMMABLE
    kind = "*" if volumetric else "+"
    clean = lambda x, keys: resample.fill_gaps(quantile_mapping.preprocess(x, value, volumetric), value, keys)
    ref, sims = clean(reference, ("location_id",)), clean(simulations, SIM_KEYS)
    past = select.select_period(sims, *years) if years else sims
    ref_q = quantile_mapping.quantiles(ref, value, nq, "doy", window).withColumnRenamed("quantiles", "ref_q")
    sim_q = quantile_mapping.quantiles(past, value, nq, "doy", window, SIM_KEYS)
    factor = F.zip_with("ref_q", "quantiles", (lambda r, s: r - s) if kind == "+" else (lambda r, s: F.try_divide(r, s)))
    factors = sim_q.join(ref_q, ["location_id", "grp"]).select(*SIM_KEYS, "grp", F.posexplode(factor).alias("node", "factor"))
    if volumetric:
        factors = quantile_mapping.clip_factors(factors, limit)
    return quantile_mapping.predict(sims, factors, value, nq, kind, "doy", SIM_KEYS)


def scenarios(reference: DataFrame, simulations: DataFrame, variables: tuple[str, ...], **options) -> DataFrame:
    """var, sim_code, location_id, date, value, adjusted of several variables, all simulations and places in one job.

    Both tables are long (column var); each variable follows its own rules (see scenario), and reads only its partition.
    """
    out = None
    for var in variables:
        own = [x.filter(F.col("var") == var).drop("var") for x in (reference, simulations)]
        found = scenario(*own, "value", var, **options).select(F.lit(var).alias("var"), *SIM_KEYS, "date", "value", "adjusted")
        out = found if out is None else out.unionByName(found)
    if out is None:
        raise ValueError("no variables")
    return out


def run_index(name: str, daily: DataFrame, *parameters, reference: DataFrame | None = None, keys: tuple[str, ...] = SIM_KEYS) -> DataFrame:
    """idx, keys, year, value of an index over all simulations; percentile parameters are of the index's first variable."""
    return annual.indices_of([(name, *parameters)], daily, reference, keys)


def run_indices(runs: list[tuple], daily: DataFrame, reference: DataFrame | None = None, keys: tuple[str, ...] = SIM_KEYS) -> DataFrame:
    """Several indices, each (name, *parameters), from one pass over the days (see annual.indices_of)."""
    return annual.indices_of(runs, daily, reference, keys)


def made(spark: SparkSession, path: str, build: Callable[[], DataFrame], force: bool = False) -> DataFrame:
    """A stored result, built and written only if it is not there yet; a half-written one has no _SUCCESS and is built anew."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if force or not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def natural_key(text: Column) -> Column:
    """A sort key that orders digit runs as numbers: each run is padded to 12 digits, the rest is lower case."""
    parts = F.regexp_extract_all(F.lower(text), F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^\d+$"), F.lpad(p, 12, "0")).otherwise(p)), "")


def reset_calendar(df: DataFrame, first_year: int, keys: tuple[str, ...] = ("location_id",)) -> DataFrame:
    """Dates anew by place in the series: 365 days a year from 1 January of first_year, without 29 February."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy(*keys).orderBy("date")) - 1
    plain = F.date_add(F.lit("1900-01-01").cast("date"), (place % 365).cast("int"))
    return df.withColumn("date", F.make_date((F.lit(first_year) + F.floor(place / 365)).cast("int"), F.month(plain), F.dayofmonth(plain)))


def quantile_to_centile(q: Column) -> Column:
    """Quantiles between 0 and 1 as centiles; others stay."""
    return F.when((q > 0) & (q < 1), q * 100).otherwise(q)
