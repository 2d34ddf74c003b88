"""Annual climate indices: from daily rows to (keys, year, value).

Each index is a function of a table of daily values and its thresholds; what it is is told in yearly.py. Comparisons are
strict or not as each index defines. Counts are longs; a year with days has a row, a year without has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isohyet import model
from isohyet.session import durable

from . import runs, select, yearly

KEYS = runs.KEYS


def _count(df: DataFrame, condition: Column, keys: tuple[str, ...] = KEYS) -> DataFrame:
    return df.groupBy(*keys, F.year("date").alias("year")).agg(F.count_if(condition).alias("value"))


# --- thresholds ------------------------------------------------------------------------------------------------------


#: Distinct values up to which one task looks a quantile up; beyond it the values are cut into ranges.
FEW_VALUES = 200_000


def reference_quantile(reference: DataFrame, value: str, q: float, places: int = 2, few: int = FEW_VALUES) -> DataFrame:
    """One row, threshold: a quantile over all days and cells of the reference, rounded.

    Exact, without all days in one task, and the days are read once: equal values are counted before they are shuffled, and
    the counts are kept. Up to `few` distinct values, which measurements of a fixed precision have, are weighed by one
    aggregate; more are summed by ranges, and the quantile's rank, or the two around it, is looked up inside a range.
    """
    counts = durable(reference.filter(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n")))
    if counts.count() <= few:
        return counts.agg(F.round(F.percentile("v", float(q), F.col("n")), places).alias("threshold"))
    laid = durable(counts.repartitionByRange("v").withColumn("part", F.spark_partition_id()))
    # one row a range
    parts = laid.groupBy("part").agg(F.sum("n").alias("own")).select("part", F.coalesce(F.sum("own").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"), F.sum("own").over(Window.partitionBy()).alias("all"))
    running = laid.join(F.broadcast(parts), "part").withColumn("upto", F.col("base") + F.sum("n").over(Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
    at = F.lit(float(q)) * (F.col("all") - 1)
    low, high = (F.min(F.when(F.col("upto") > f(at), F.col("v"))) for f in (F.floor, F.ceil))
    found = running.agg(low.alias("low"), high.alias("high"), F.max(at - F.floor(at)).alias("over"))
    return found.select(F.round(F.col("low") * (1 - F.col("over")) + F.col("high") * F.col("over"), places).alias("threshold"))


def reference_total_quantile(reference: DataFrame, value: str, q: float, places: int = 2) -> DataFrame:
    """One row, threshold: a quantile of the annual sums' means over cells."""
    totals = reference.groupBy("location_id", F.year("date").alias("year")).agg(F.sum(value).alias("total")).groupBy("year").agg(F.avg("total").alias("total"))
    return totals.agg(F.round(F.percentile("total", q), places).alias("threshold"))


def days_above_reference(df: DataFrame, threshold: DataFrame, value: str, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Days above a threshold that was derived from the reference: one row, joined to every simulation."""
    return yearly.one("txdaysabove", df.crossJoin(F.broadcast(threshold)), F.col("threshold"), keys=keys, tasmax=value)


# --- temperature -----------------------------------------------------------------------------------------------------


def days_above(df: DataFrame, value: str, threshold: float, first: int = -1, last: int = -1, keys: tuple[str, ...] = KEYS) -> DataFrame:
    return yearly.one("txdaysabove", df, threshold, first, last, keys=keys, tasmax=value)


def days_below(df: DataFrame, value: str, threshold: float, first: int = -1, last: int = -1, keys: tuple[str, ...] = KEYS) -> DataFrame:
    return yearly.one("tndaysbelow", df, threshold, first, last, keys=keys, tasmin=value)


def months_below(df: DataFrame, value: str, threshold: float, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Months whose mean is below a threshold."""
    return yearly.one("tngmonthsbelow", df, threshold, keys=keys, tasmin=value)


def hot_spell_frequency(df: DataFrame, value: str, threshold: float, window: int, keys: tuple[str, ...] = KEYS) -> DataFrame:
    return yearly.one("hotspellfreq", df, threshold, window, keys=keys, tasmax=value)


def hot_spell_max_length(df: DataFrame, value: str, threshold: float, window: int, keys: tuple[str, ...] = KEYS) -> DataFrame:
    return yearly.one("hotspellmaxlen", df, threshold, window, keys=keys, tasmax=value)


def hot_spell_total_length(df: DataFrame, value: str, threshold: float, window: int, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Days in spells of at least window days at or above the threshold; a spell may cross the new year."""
    return yearly.one("hotspelltotlen", df, threshold, window, keys=keys, tasmax=value)


def doy_percentile(reference: DataFrame, value: str, q: float = 0.9, window: int = 5, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """keys, doy, threshold: a percentile of each day of year's values pooled with those of the days around it."""
    half = window // 2
    pooled = reference.withColumn("doy", F.explode(F.transform(F.sequence(F.lit(-half), F.lit(half)), lambda k: F.pmod(F.least(F.dayofyear("date"), F.lit(365)) - 1 + k, F.lit(365)) + 1)))
    return pooled.groupBy(*keys, "doy").agg(F.percentile(value, q).alias("threshold"))


def with_doy_threshold(df: DataFrame, thresholds: DataFrame) -> DataFrame:
    """The days with their day of year's threshold, NULL where there is none; thresholds by doy and whatever keys they have."""
    by_doy = thresholds.withColumnRenamed("threshold", "doy_threshold")
    return df.withColumn("doy", F.least(F.dayofyear("date"), F.lit(365))).join(by_doy, [c for c in by_doy.columns if c != "doy_threshold"], "left")


def warm_spell_duration(df: DataFrame, thresholds: DataFrame, value: str, window: int = 6, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Days in runs of at least window days above the percentile of their day of year."""
    return yearly.one("wsdi", with_doy_threshold(df, thresholds), window, keys=keys, tasmax=value)


def heat_wave_max_length(df: DataFrame, tasmin: float, tasmax: float, window: int, keys: tuple[str, ...] = KEYS) -> DataFrame:
    return yearly.one("heatwavemaxlen", df, tasmin, tasmax, window, keys=keys)


def heat_wave_total_length(df: DataFrame, tasmin: float, tasmax: float, window: int, keys: tuple[str, ...] = KEYS) -> DataFrame:
    return yearly.one("heatwavetotlen", df, tasmin, tasmax, window, keys=keys)


def annual_mean(df: DataFrame, value: str, keys: tuple[str, ...] = KEYS) -> DataFrame:
    return yearly.one("txg", df, keys=keys, tasmax=value)


def annual_max(df: DataFrame, value: str, keys: tuple[str, ...] = KEYS) -> DataFrame:
    return yearly.one("txx", df, keys=keys, tasmax=value)


def mean_temperature(df: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    return yearly.one("tgg", df, keys=keys)


def extreme_range(df: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    return yearly.one("etr", df, keys=keys)


def tropical_nights(df: DataFrame, threshold: float, keys: tuple[str, ...] = KEYS) -> DataFrame:
    return yearly.one("tropicalnights", df, threshold, keys=keys)


# --- precipitation ---------------------------------------------------------------------------------------------------


def max_amount(df: DataFrame, days: int = 1, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The year's greatest amount in so many consecutive days; the days may begin in the year before."""
    if days == 1:
        return yearly.one("rx1day", df, keys=keys)
    return yearly.one("rx5day", df, days, keys=keys)


def total_amount(df: DataFrame, first: int = -1, last: int = -1, keys: tuple[str, ...] = KEYS) -> DataFrame:
    return yearly.one("prcptot", df, first, last, keys=keys)


def consecutive_wet_days(df: DataFrame, threshold: float, keys: tuple[str, ...] = KEYS) -> DataFrame:
    return yearly.one("cwd", df, threshold, keys=keys)


def consecutive_dry_days(df: DataFrame, threshold: float, keys: tuple[str, ...] = KEYS) -> DataFrame:
    return yearly.one("cdd", df, threshold, keys=keys)


def wet_days(df: DataFrame, low: float, high: float | None = None, keys: tuple[str, ...] = KEYS) -> DataFrame:
    return yearly.one("wetdays", df, low, high, keys=keys)


def dry_days(df: DataFrame, threshold: float, keys: tuple[str, ...] = KEYS) -> DataFrame:
    return yearly.one("drydays", df, threshold, keys=keys)


def daily_intensity(df: DataFrame, threshold: float, truncate: bool = True, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Mean amount of wet days; cut to whole mm unless truncate is False. NULL in years without a wet day."""
    return yearly.one("sdii", df, threshold, truncate, keys=keys)


def dry_spell_total_length(df: DataFrame, threshold: float, window: int, op: str = "max", first: int = -1, last: int = -1, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Days of the season that lie in some dry window of so many days.

    A window is dry if all its amounts are below the threshold (op max) or their sum is (op sum); with op max amounts
    below the threshold count as none. Windows may cross the new year. Bounds from March on move in leap years.
    """
    return yearly.one("dryspelltotlen", df, threshold, window, op, first, last, keys=keys)


def dry_spell_total_length_raw(df: DataFrame, threshold: float, window: int, op: str = "sum", first: int = -1, last: int = -1, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The earlier form of the index: windows of amounts as they are, and season bounds that do not move in leap years."""
    w = runs.series(keys)
    ended = df.withColumn("ends", runs.rolling("pr", window, F.max if op == "max" else F.sum, w) < threshold)
    marked = ended.withColumn("dry", runs.in_any_window("ends", window, w))
    season = model.in_season(F.dayofyear("date"), first, last) if (first, last) != (-1, -1) else F.lit(True)
    return _count(marked, F.col("dry") & season, keys)


# --- wind ------------------------------------------------------------------------------------------------------------


def strong_wind_days(df: DataFrame, speed: float, direction: float | None = None, tolerance: float = 0.0, first: int = -1, last: int = -1, circular: bool = False, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Days with a stronger wind (vv), and, if a direction is given, with dd - direction at most the tolerance.

    circular compares the shorter arc instead of the plain difference.
    """
    return yearly.one("wgdaysabove", df, speed, direction, tolerance, first, last, circular, keys=keys)


# --- drought code ----------------------------------------------------------------------------------------------------

# Monthly day-length factors of the drought code, January to December, north of 20 N, south of 20 S, between.
_NORTH = (-1.6, -1.6, -1.6, 0.9, 3.8, 5.8, 6.4, 5.0, 2.4, 0.4, -1.6, -1.6)
_SOUTH = (6.4, 5.0, 2.4, 0.4, -1.6, -1.6, -1.6, -1.6, -1.6, 0.9, 3.8, 5.8)
_EQUATOR = (1.4,) * 12
DROUGHT_START = 15.0


def drought_step(code: np.ndarray, temperature: np.ndarray, rain: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """One day of the Canadian drought code (Van Wagner 1987) of many cells: rain above 2.8 mm wets, warmth dries."""
    effective = np.maximum(0.83 * rain - 1.27, 0.0)
    moisture = 800.0 * np.exp(-code / 400.0)
    wetted = np.maximum(0.0, code - 400.0 * np.log(1.0 + 3.937 * effective / moisture))
    dried = np.maximum(0.0, 0.36 * (np.maximum(temperature, -2.8) + 2.8) + factor) * 0.5
    return np.where(rain > 2.8, wetted, code) + dried


def drought_code(df: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Annual mean of the daily drought code of tas (C), pr (mm) at lat.

    A recursion over the days of a cell: cells are dealt by hash, each task reads its cells' days in order of dates, and
    takes a day of all its cells at once. It holds a few numbers for each of its cells, however long the series. A day with
    a missing value keeps the code; a cell has one row a day at most.
    """
    keyed = df.select(F.xxhash64(*keys).alias("cell"), *keys, "date", "tas", "pr", "lat")
    named = keyed.select(*keys).schema.fields
    out_schema = pa.schema([pa.field("cell", pa.int64()), ("year", pa.int32()), ("value", pa.float64())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.empty(0, dtype=np.int64)
        code = total = np.empty(0)
        n = np.empty(0, dtype=np.int64)
        year = None

        def close() -> pa.RecordBatch:
            had = np.flatnonzero(n)
            return pa.RecordBatch.from_arrays([pa.array(cells[had]), pa.array(np.full(len(had), year), pa.int32()), pa.array(total[had] / n[had])], schema=out_schema)

        for batch in batches:
            own, days = batch.column(0).to_numpy(), batch.column(1).cast(pa.int32()).to_numpy()
            years, months = (np.asarray(pc.year(batch.column(1))), np.asarray(pc.month(batch.column(1))))
            tas, pr, lat = (batch.column(k).to_numpy(zero_copy_only=False).astype(float) for k in (2, 3, 4))
            cuts = np.r_[0, np.flatnonzero(np.diff(days)) + 1, len(days)]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if years[a] != year:
                    if year is not None:
                        yield close()
                        total, n = np.zeros(len(cells)), np.zeros(len(cells), dtype=np.int64)
                    year = int(years[a])
                fresh = np.setdiff1d(own[a:b], cells)
                if len(fresh):
                    order = np.argsort(np.r_[cells, fresh], kind="stable")
                    grown = [np.r_[x, np.full(len(fresh), v, dtype=x.dtype)][order] for x, v in ((cells, 0), (code, DROUGHT_START), (total, 0), (n, 0))]
                    cells, code, total, n = np.sort(np.r_[cells, fresh]), *grown[1:]
                at = np.searchsorted(cells, own[a:b])
                t, r, month = tas[a:b], pr[a:b], months[a] - 1
                factor = np.where(lat[a:b] > 20, _NORTH[month], np.where(lat[a:b] < -20, _SOUTH[month], _EQUATOR[month]))
                known = ~(np.isnan(t) | np.isnan(r))
                code[at[known]] = drought_step(code[at[known]], t[known], r[known], factor[known])
                total[at] += code[at]
                n[at] += 1
        if year is not None:
            yield close()

    ordered = keyed.select("cell", "date", "tas", "pr", "lat").repartition("cell").sortWithinPartitions("date", "cell")
    found = ordered.mapInArrow(walk, "cell long, year int, value double")
    names = keyed.select("cell", *(f.name for f in named)).distinct()
    return found.join(names, "cell").select(*keys, "year", "value")


# --- after an index --------------------------------------------------------------------------------------------------


def mask_index(index: DataFrame, land: DataFrame, value: str = "value") -> DataFrame:
    """Cells that are no land become NULL, as select.valid_cells finds them; annual.postprocess() fills before it masks."""
    return select.apply_mask(index, land, value)


def ranked_years(index: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Position of each year in its cell's series, from 0."""
    return index.withColumn("position", F.row_number().over(Window.partitionBy(*keys).orderBy("year")) - 1)
