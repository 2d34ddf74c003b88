"""The rain season: its start, end, length and amount.

Days of a season that wraps around the new year belong to the year in which the season began; an end that falls into
the next year is reported there. Windows need all their days in the series.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from isohyet import model
from isohyet.session import durable

from . import runs

KEYS = runs.KEYS
#: Sums that differ by less count as equal.
TOLERANCE = 1e-9


def _bounds(first: int, last: int) -> tuple[int, int]:
    """A season's bounds; a missing one is the day next to the other."""
    if first == -1 and last == -1:
        return 1, 365
    if first == -1:
        return (1 if last == 365 else last + 1), last
    if last == -1:
        return first, (365 if first == 1 else first - 1)
    return first, last


def start(df: DataFrame, wet_amount: float, wet_window: int, dry_threshold: float, dry_days: int, dry_window: int, first: int = -1, last: int = -1, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """keys, year, value: first day of the season that begins a wet spell with no dry sequence soon after, or NULL.

    A wet spell: at least wet_amount in wet_window days, more than dry_threshold on the first. With j the fewest days
    that reach the amount, none of the sequences of dry_days dry days may begin from day wet_window - j + 1 on, over the
    dry_window - dry_days - 1 days from there.
    """
    first, last = _bounds(first, last)
    w = runs.series(keys)
    v = df.select(*keys, "date", F.greatest("pr", F.lit(0.0)).alias("v"))
    amounts = [F.sum("v").over(w.rowsBetween(0, k)) for k in range(wet_window)]
    enough = [F.coalesce(a >= wet_amount - TOLERANCE, F.lit(False)) for a in amounts]
    j = F.lit(wet_window)
    for k in range(wet_window - 1, 0, -1):
        j = F.when(enough[k - 1], F.lit(k)).otherwise(j)
    rn = F.row_number().over(w)
    v = v.withColumns({"rn": rn, "is_wet": enough[-1] & (F.count("v").over(w.rowsBetween(0, wet_window - 1)) == wet_window) & (F.col("v") > dry_threshold), "j": j, "n": F.count(F.lit(1)).over(Window.partitionBy(*keys))})
    next_wet = F.min(F.when(~F.coalesce(F.col("v") < dry_threshold, F.lit(False)), F.col("rn"))).over(runs.backwards(keys))
    v = v.withColumn("opens_dry", (F.coalesce(next_wet, F.col("n") + 1) - F.col("rn") >= dry_days).cast("int"))
    late = dry_window - dry_days - 2
    bad: Column = F.lit(0)
    for k in range(1, wet_window + 1) if late >= 0 else ():
        bad = F.when(F.col("j") == k, F.coalesce(F.max("opens_dry").over(w.rowsBetween(1 + wet_window - k, 1 + wet_window - k + late)), F.lit(0))).otherwise(bad)
    found = v.withColumn("bad", bad)
    ok = F.col("is_wet") & (F.col("bad") == 0) & model.in_season(F.dayofyear("date"), first, last)
    days = runs.first_doy(found, ok, keys)
    return days.withColumn("value", F.when(F.col("value") <= 365, F.col("value")))


def _evaporated(table: pa.Table, keys: tuple[str, ...], least: int, most: int, threshold: float) -> pa.Table:
    """Of one cell's days: for each season the day with the shortest span of least to most days that lose the threshold.

    With C the running sum of losses, w days to t lose C(t) - C(t - w); each w is tried on all days at once, and days drop
    out as soon as they are found. A cell's series is as long as its calendar, 40,000 days for 110 years.
    """
    table = table.sort_by("date")
    date = table.column("date").cast(pa.int32()).to_numpy()
    year, doy, season, in_season, rains = (table.column(c).to_numpy() for c in ("year", "doy", "season", "in_season", "rains"))
    c = np.r_[0.0, np.cumsum(np.nan_to_num(table.column("loss").to_numpy().astype(float)))]
    span = np.zeros(len(date), dtype=np.int64)
    open_ = np.flatnonzero(in_season)
    for w in range(max(1, least), most + 1):
        open_ = open_[open_ + 1 >= w] if w > 1 else open_
        hit = c[open_ + 1] - c[np.maximum(open_ + 1 - w, 0)] >= threshold - TOLERANCE
        span[open_[hit]] = w
        open_ = open_[~hit]
        if not len(open_):
            break
    hits = np.flatnonzero(span)
    hits = hits[np.lexsort((date[hits], span[hits], season[hits]))]
    hits = hits[np.r_[True, season[hits][1:] != season[hits][:-1]]] if len(hits) else hits
    last = np.maximum.accumulate(np.where(rains, np.arange(len(date)), -1))[hits]
    near = (last >= 0) & (date[hits] - date[last] <= span[hits]) & (year[hits] == year[last])
    own = [table.column(k).combine_chunks().take(pa.array(hits)) for k in keys]
    return pa.Table.from_arrays([*own, *(pa.array(x[hits], pa.int32()) for x in (season, year, doy)), pa.array(near)], names=[*keys, "season", "year", "doy", "rain_near"])


def end(df: DataFrame, op: str, threshold: float, window: int, rate: float = 0.0, first: int = -1, last: int = -1, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """keys, year, value: day of year on which the season ends, or NULL, before it is held against the season's start.

    max, sum: the first day after which window days each have less than the threshold, or do so in sum. etp: the first day
    to which the least number of days leads that would evaporate the threshold beyond their rain, at a constant rate or
    that of column etp. Either way it must have rained on that day or in the window that decided.
    """
    first, last = _bounds(first, last)
    w = runs.series(keys)
    wraps = last < first
    base = df.withColumns({"doy": F.dayofyear("date"), "year": F.year("date")})
    # with op etp every calendar year is searched by itself
    base = base.withColumn("season", F.col("year") - F.when(F.lit(wraps and op != "etp") & (F.col("doy") < first), 1).otherwise(0))
    base = base.withColumn("in_season", model.in_season(F.col("doy"), first, last))
    if op in ("max", "sum"):
        how = F.max if op == "max" else F.sum
        day = base.withColumn("dry", F.coalesce(runs.rolling("pr", window, how, w, forward=True, skip=1) < threshold, F.lit(False)) & F.col("in_season"))
        # the first rain from here on, in the window and in the same year
        rains = F.min(F.when(F.col("pr") > 0, F.col("date"))).over(w.rowsBetween(0, window))
        hits = day.withColumn("rain_near", F.coalesce(F.year(rains) == F.col("year"), F.lit(False))).filter("dry")
        found = hits.groupBy(*keys, "season").agg(F.min_by(F.struct("year", "doy", "rain_near"), F.col("date")).alias("x"))
    elif op == "etp":
        length = (last - first if not wraps else 365 - first + last) + 1
        least = math.ceil(threshold / rate) if rate > 0 else (1 if "etp" in df.columns else length)
        most = length - least if rate > 0 or "etp" in df.columns else length
        loss = (F.col("etp") if rate <= 0 and "etp" in df.columns else F.lit(float(rate))) - F.col("pr")
        days = base.select(*keys, "date", "year", "doy", "season", "in_season", loss.cast("double").alias("loss"), F.coalesce(F.col("pr") > 0, F.lit(False)).alias("rains"))
        schema = StructType([*(days.schema[k] for k in keys), StructField("season", IntegerType()), StructField("year", IntegerType()), StructField("doy", IntegerType()), StructField("rain_near", BooleanType())])

        def search(table: pa.Table) -> pa.Table:
            return _evaporated(table, keys, least, most, threshold)

        found = days.groupBy(*keys).applyInArrow(search, schema).select(*keys, "season", F.struct("year", "doy", "rain_near").alias("x"))
    else:
        raise ValueError(f"unknown op: {op}")
    days = found.filter("x.rain_near").select(*keys, F.col("x.year").alias("year"), F.col("x.doy").alias("value"), (F.col("x.year") == F.col("season")).alias("own"))
    # an end in the year in which its season began goes before one that came over from the year before
    best = days.groupBy(*keys, "year").agg(F.max_by("value", "own").alias("value"))
    years = base.select(*keys, "year").distinct()
    return years.join(best, [*keys, "year"], "left")


def reconcile(ends: DataFrame, starts: DataFrame, next_starts: DataFrame | None = None, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Ends not after their start are none; one at or after the next season's start is the day before that."""
    both = ends.join(starts.withColumnRenamed("value", "start"), [*keys, "year"], "left")
    value = F.when(F.col("start").isNull() | (F.col("value") > F.col("start")), F.col("value"))
    if next_starts is not None:
        both = both.join(next_starts.withColumnRenamed("value", "next"), [*keys, "year"], "left")
        day_before = F.when(F.col("next") - 1 < 1, 365).otherwise(F.col("next") - 1)
        value = F.when(F.col("next").isNotNull() & (value >= F.col("next")), day_before).otherwise(value)
    return both.select(*keys, "year", value.alias("value"))


def _pairs(starts: DataFrame, ends: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return starts.withColumnRenamed("value", "start").join(ends.withColumnRenamed("value", "end"), [*keys, "year"], "full")


def length(starts: DataFrame, ends: DataFrame, keys: tuple[str, ...] = KEYS, cell: str = "location_id") -> DataFrame:
    """Days from start to end. Where, on average over a series' cells and years, starts come after ends, a season ends in the next year.

    A series is what the keys other than the cell tell: each simulation decides for itself.
    """
    both = _pairs(starts, ends, keys)
    series = [k for k in keys if k != cell]
    means = both.groupBy(*series).agg((F.avg("start") <= F.avg("end")).alias("same_year"))  # a row for each series
    following = both.withColumn("next_end", F.lead("end").over(Window.partitionBy(*keys).orderBy("year")))
    both = following.join(means, series) if series else following.crossJoin(F.broadcast(means))
    days = F.when(F.col("same_year"), F.col("end") - F.col("start") + 1).otherwise(365 - F.col("start") + F.col("next_end") + 1)
    # a season that would end before it starts has no length
    return both.select(*keys, "year", F.when(days >= 0, days).when(days < 0, 0).alias("value"))


def amount(df: DataFrame, starts: DataFrame, ends: DataFrame, next_year: bool = False, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Amount from start to end, in whole mm, or NULL if either is missing.

    Cells whose starts come after their ends on average have seasons across the new year: from start to day 365, and to
    the next year's end, of the same calendar year's days, or with next_year of the following one's.
    """
    both = _pairs(starts, ends, keys)
    means = Window.partitionBy(*keys)
    both = both.withColumns({"same_year": F.avg("start").over(means) <= F.avg("end").over(means), "next_end": F.lead("end").over(Window.partitionBy(*keys).orderBy("year"))})
    days = df.select(*keys, F.year("date").alias("year"), F.dayofyear("date").alias("doy"), "pr")
    per = days.join(both, [*keys, "year"])
    inside = F.when(F.col("same_year"), F.col("doy").between(F.col("start"), F.col("end"))).otherwise(F.col("doy").between(F.col("start"), F.lit(365)))
    head = (F.col("doy") <= F.col("next_end")) & ~F.col("same_year")
    known = F.when(F.col("same_year"), F.col("end").isNotNull()).otherwise(F.col("next_end").isNotNull()) & F.col("start").isNotNull()
    if not next_year:
        total = F.sum(F.when(inside, F.col("pr")).otherwise(0.0) + F.when(head, F.col("pr")).otherwise(0.0))
        got = per.groupBy(*keys, "year").agg(F.when(F.max(known), total).alias("value"))
    else:
        own = per.groupBy(*keys, "year").agg(F.max(known).alias("known"), F.sum(F.when(inside, F.col("pr"))).alias("own"))
        after = both.filter(~F.col("same_year")).select(*keys, (F.col("year") + 1).alias("year"), "next_end")
        tail = days.join(after, [*keys, "year"]).filter("doy <= next_end").groupBy(*keys, (F.col("year") - 1).alias("year")).agg(F.sum("pr").alias("tail"))
        got = own.join(tail, [*keys, "year"], "left").select(*keys, "year", F.when(F.col("known"), F.coalesce("own", F.lit(0.0)) + F.coalesce("tail", F.lit(0.0))).alias("value"))
    years = both.select(*keys, "year")
    return years.join(got.withColumn("value", F.floor(F.col("value") + TOLERANCE).cast("double")), [*keys, "year"], "left")


def season(df: DataFrame, start_args: dict, end_args: dict, next_starts: DataFrame | None = None, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """keys, year, start, end, length, amount.

    Starts and ends, a row per cell and year, are computed once and stored for the lengths and amounts that read them.
    """
    starts = durable(start(df, **start_args, keys=keys))
    ends = durable(reconcile(end(df, **end_args, keys=keys), starts, next_starts, keys))
    out = _pairs(starts, ends, keys)
    for name, part in (("length", length(starts, ends, keys)), ("amount", amount(df, starts, ends, keys=keys))):
        out = out.join(part.withColumnRenamed("value", name), [*keys, "year"], "left")
    return out
