"""All annual indices in one pass over the days.

An index is told (yearly.py) as columns over the ordered days of a series and one aggregate over each year of them. The columns
of all indices asked for share one partitioning and one order, and the aggregates share one grouping by the same keys: one scan,
one exchange and one sort serve any number of indices. A run's length so far is the distance to the last day that broke
it, so longest runs, days in runs and numbers of runs are plain aggregates too.

The rain season and the drought code are not sums over a year's days; they read the same prepared table on their own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isohyet.session import durable, stored

from . import grid, indices, rainseason, select
from .yearly import FUSED, over_years

SIM_KEYS = ("sim_code", "location_id")
#: Variables that sources give in kelvin.
KELVIN = ("tas", "tasmin", "tasmax")


#: Parts of the rain season, and the variables that these and the drought code read.
SEASON = {"rainstart": "start", "rainend": "end", "rainlength": "length", "rainamount": "amount"}
APART: dict[str, tuple[str, ...]] = {**dict.fromkeys((*SEASON, "rainseason"), ("pr",)), "droughtcode": ("tas", "pr", "lat")}
NAMES = (*FUSED, *APART)


def prepare(daily: DataFrame, kelvin: bool = False, reference: str = "ref", period: tuple[int, int] | None = None) -> DataFrame:
    """The days that indices are taken of: temperatures in C, the reference without 29 February and in its period only.

    The reference is the simulation of that code; without a column sim_code nothing is dropped.
    """
    out = daily.withColumns({v: F.col(v) - 273.15 for v in KELVIN if v in daily.columns}) if kelvin else daily
    if "sim_code" in daily.columns:
        other = F.col("sim_code") != reference
        out = out.filter(other | ~((F.month("date") == 2) & (F.dayofmonth("date") == 29)))
        if period:
            out = out.filter(other | F.year("date").between(*period))
    return out


def _is_percentile(p) -> bool:
    return isinstance(p, str) and p.endswith("p") and p[:-1].replace(".", "", 1).isdigit()


def _thresholds(wanted: list[tuple[str, str]], reference: DataFrame) -> DataFrame:
    """One row: a column for each percentile of the reference, rounded to 2 places."""
    found = [indices.reference_quantile(reference, v, float(p[:-1]) / 100).withColumnRenamed("threshold", f"{v}_{p}") for v, p in wanted]
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), found)  # of one row each


def indices_of(wanted: list[tuple], daily: DataFrame, reference: DataFrame | None = None, keys: tuple[str, ...] = SIM_KEYS) -> DataFrame:
    """idx, keys, year, value of the indices asked for, each (name, *parameters) or (name, *parameters, {"as": label}).

    Parameters such as "90p" are percentiles of the index's first variable in the reference. A year with days has a row. The
    parts of the rain season take the arguments of rainseason.season(); rainseason gives all four, as <label>_<part>.
    """
    labelled = [(x[-1]["as"], *x[:-1]) if isinstance(x[-1], dict) and "as" in x[-1] else (x[0], *x) for x in wanted]
    for _, name, *_ in labelled:
        if name not in NAMES:
            raise ValueError(f"unknown index: {name}")
        absent = [v for v in (FUSED[name][0] if name in FUSED else APART[name]) if v not in daily.columns]
        if absent:
            raise ValueError(f"{name} needs {absent}")
    fused, apart = [x for x in labelled if x[1] in FUSED], [x for x in labelled if x[1] in APART]
    # what is read on its own is kept as Parquet if it is read again, and no other column of the days
    needed = sorted({v for _, name, *_ in apart for v in APART[name]})
    days = stored(daily.select(*keys, "date", *needed)) if len(apart) > 1 else daily
    parts = [_fused(fused, daily, reference, keys)] if fused else []
    seasons: dict[str, DataFrame] = {}
    for label, name, *parameters in apart:
        if name == "droughtcode":
            found = indices.drought_code(days, keys).withColumn("idx", F.lit(label))
        elif name == "rainstart":
            found = rainseason.start(days, **parameters[0], keys=keys).withColumn("idx", F.lit(label))
        else:  # start and end arguments: a season is searched once, whatever is asked of it
            told = repr(parameters)
            if told not in seasons:
                seasons[told] = durable(rainseason.season(days, *parameters, keys=keys))
            asked = SEASON.items() if name == "rainseason" else [(name, SEASON[name])]
            rows = F.array(*(F.struct(F.lit(f"{label}_{c}" if name == "rainseason" else label).alias("idx"), F.col(c).cast("double").alias("value")) for _, c in asked))
            found = seasons[told].select(*keys, "year", F.explode(rows).alias("x")).select(*keys, "year", "x.idx", "x.value")
        parts.append(found.select("idx", *keys, "year", F.col("value").cast("double").alias("value")))
    return reduce(DataFrame.unionByName, parts)


def _fused(wanted: list[tuple], days: DataFrame, reference: DataFrame | None, keys: tuple[str, ...]) -> DataFrame:
    percentiles = sorted({(FUSED[name][0][0], p) for _, name, *parameters in wanted for p in parameters if _is_percentile(p)})
    if percentiles:
        days = days.crossJoin(F.broadcast(_thresholds(percentiles, reference)))  # one row
    if any(name == "wsdi" for _, name, *_ in wanted):
        days = indices.with_doy_threshold(days, indices.doy_percentile(reference, "tasmax", keys=("location_id",)))
    told = [(name, tuple(F.col(f"`{FUSED[name][0][0]}_{p}`") if _is_percentile(p) else p for p in parameters)) for _, name, *parameters in wanted]
    days, values = over_years(told, days, keys)
    values = [F.struct(F.lit(label).alias("idx"), v.cast("double").alias("value")) for (label, *_), v in zip(wanted, values, strict=True)]
    years = days.groupBy(*keys, F.year("date").alias("year")).agg(F.array(*values).alias("x"))
    return years.select(*keys, "year", F.explode("x").alias("x")).select("x.idx", *keys, "year", "x.value")


def postprocess(found: DataFrame, cells: DataFrame, land: DataFrame, keys: tuple[str, ...] = ("idx", "sim_code", "year")) -> DataFrame:
    """Index maps as they are kept: missing cells filled from their neighbours, then cells that are no land NULL, years as dates.

    cells: location_id, lon, lat; land: location_id of the cells that are kept (see select.valid_cells).
    """
    keys = tuple(k for k in keys if k in found.columns)
    placed = found.join(cells.select("location_id", "lon", "lat"), "location_id")
    filled = grid.fill_in_space(placed, "value", keys).join(cells.select("location_id", "lon", "lat"), ["lon", "lat"])
    masked = select.apply_mask(filled, land, "value")
    return masked.select(*keys, "location_id", F.make_date(F.col("year"), F.lit(1), F.lit(1)).alias("date"), "value")
