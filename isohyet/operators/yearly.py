"""Annual indices, each told once: columns over the ordered days of a series and one aggregate over each year of them.

indices.py takes one of them for a table of days, annual.py any number in one pass; both apply what is told here, so a rule is
the same in either. A year with days has a row, whatever its days hold and whether or not one of them is in the season.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isohyet import model
from isohyet.functions import physics

from . import runs


@dataclass(frozen=True)
class Plan:
    """An index: windows in two levels over the ordered days (the second may use the first), conditions of runs, an aggregate.

    A condition named c is followed as c_run: the length of the run that has come to this day, 0 where it fails.
    """

    value: Column
    first: dict[str, Column] = field(default_factory=dict)
    second: dict[str, Column] = field(default_factory=dict)
    run_of: dict[str, Column] = field(default_factory=dict)


Build = Callable[..., Plan]


def _count(condition: Column) -> Plan:
    return Plan(F.count_if(condition))


def _in(a: int, b: int) -> Column:
    return model.in_season(F.dayofyear("date"), a, b)


def _season(condition: Column, a: int, b: int) -> Plan:
    return _count(condition & _in(a, b) if (a, b) != (-1, -1) else condition)


def _longest(n: str, w, condition: Column, at_least: int) -> Plan:
    longest = F.max(f"{n}_run")
    return Plan(F.when(longest >= at_least, longest).otherwise(0).cast("long"), run_of={n: condition})


def _in_runs(n: str, w, condition: Column, at_least: int) -> Plan:
    # a run's first at_least days count once it has come so far
    return Plan(F.sum(F.when(F.col(f"{n}_run") == at_least, at_least).when(F.col(f"{n}_run") > at_least, 1).otherwise(0)), run_of={n: condition})


def _events(n: str, w, condition: Column, at_least: int) -> Plan:
    return Plan(F.count_if(F.col(f"{n}_run") == max(1, at_least)), run_of={n: condition})


def _windows(n: str, w, value: Column, length: int, how, ok: Callable[[Column], Column], inside: Column) -> Plan:
    """Days that lie in some window of so many days whose aggregate is ok."""
    ends = F.coalesce(ok(F.when(F.count(f"{n}_v").over(w.rowsBetween(-(length - 1), 0)) == length, how(f"{n}_v").over(w.rowsBetween(-(length - 1), 0)))), F.lit(False))
    return Plan(F.count_if(F.col(f"{n}_in") & inside), {f"{n}_v": value}, {f"{n}_ends": ends}, {}), length


def _months_below(t: Column) -> Plan:
    means = [F.avg(F.when(F.month("date") == m, F.col("tasmin"))) for m in range(1, 13)]
    return Plan(reduce(lambda a, b: a + b, (F.when(m < t, 1).otherwise(0) for m in means)).cast("long"))


def _wet_mean(t: Column, truncate: bool) -> Plan:
    mean = F.avg(F.when(F.col("pr") >= t, F.col("pr")))
    return Plan(F.when(mean < 0, F.ceil(mean)).otherwise(F.floor(mean)).cast("double") if truncate else mean)


def _wind(n: str, w, speed: Column, direction: float | None = None, tolerance: float = 0.0, a: int = -1, b: int = -1, circular: bool = False) -> Plan:
    strong = F.col("vv") > speed
    if direction is not None:
        apart = physics.angle_between(F.col("dd"), F.lit(direction)) if circular else F.col("dd") - direction
        strong = strong & (apart <= tolerance)
    return _count(strong & _in(a, b))


def _dry_spell(n: str, w, t: Column, length: int, op: str = "sum", a: int = -1, b: int = -1):
    amount = F.when(F.col("pr") < (t if op == "max" else F.lit(0.0)), 0.0).otherwise(F.col("pr"))
    inside = model.in_season_leap(F.col("date"), a, b) if (a, b) != (-1, -1) else F.lit(True)
    return _windows(n, w, amount, length, F.max if op == "max" else F.sum, lambda x: x < t, inside)


_hot = lambda t: F.col("tasmax") > t
_wave = lambda n, x: (F.col("tasmin") > n) & (F.col("tasmax") > x)

#: Name: the variables it reads, and its plan from (a name of its own, the windows' order, *parameters).
FUSED: dict[str, tuple[tuple[str, ...], Build]] = {
    "txdaysabove": (("tasmax",), lambda n, w, t, a=-1, b=-1: _season(_hot(t), a, b)),
    "tx90p": (("tasmax",), lambda n, w, t, a=-1, b=-1: _season(_hot(t), a, b)),
    "tndaysbelow": (("tasmin",), lambda n, w, t, a=-1, b=-1: _season(F.col("tasmin") < t, a, b)),
    "tngmonthsbelow": (("tasmin",), lambda n, w, t: _months_below(t)),
    "hotspellfreq": (("tasmax",), lambda n, w, t, k: _events(n, w, _hot(t), k)),
    "hotspellmaxlen": (("tasmax",), lambda n, w, t, k: _longest(n, w, _hot(t), k)),
    "hotspelltotlen": (("tasmax",), lambda n, w, t, k: _windows(n, w, F.col("tasmax"), k, F.min, lambda x: x >= t, F.lit(True))),
    "wsdi": (("tasmax",), lambda n, w, k=6: _in_runs(n, w, F.col("tasmax") > F.col("doy_threshold"), k)),
    "heatwavemaxlen": (("tasmin", "tasmax"), lambda n, w, lo, hi, k: _longest(n, w, _wave(lo, hi), k)),
    "heatwavetotlen": (("tasmin", "tasmax"), lambda n, w, lo, hi, k: _in_runs(n, w, _wave(lo, hi), k)),
    "txg": (("tasmax",), lambda n, w: Plan(F.avg("tasmax"))),
    "txx": (("tasmax",), lambda n, w: Plan(F.max("tasmax"))),
    "tng": (("tasmin",), lambda n, w: Plan(F.avg("tasmin"))),
    "tnx": (("tasmin",), lambda n, w: Plan(F.max("tasmin"))),
    "tgg": (("tasmin", "tasmax"), lambda n, w: Plan(F.avg((F.col("tasmin") + F.col("tasmax")) / 2))),
    "etr": (("tasmin", "tasmax"), lambda n, w: Plan(F.max("tasmax") - F.min("tasmin"))),
    "tropicalnights": (("tasmin",), lambda n, w, t: _count(F.col("tasmin") > t)),
    "rx1day": (("pr",), lambda n, w: Plan(F.max("pr"))),
    "rx5day": (("pr",), lambda n, w, k=5: Plan(F.max(f"{n}_s"), {f"{n}_s": runs.rolling("pr", k, F.sum, w)})),
    "prcptot": (("pr",), lambda n, w, a=-1, b=-1: Plan(F.coalesce(F.sum(F.when(_in(a, b), F.col("pr"))), F.lit(0.0)))),
    "cwd": (("pr",), lambda n, w, t: _longest(n, w, F.col("pr") >= t, 1)),
    "cdd": (("pr",), lambda n, w, t: _longest(n, w, F.col("pr") < t, 1)),
    "wetdays": (("pr",), lambda n, w, lo, hi=None: _count(F.col("pr") >= lo if hi is None else (F.col("pr") >= lo) & (F.col("pr") < hi))),
    "r10mm": (("pr",), lambda n, w: _count(F.col("pr") >= 10)),
    "r20mm": (("pr",), lambda n, w: _count(F.col("pr") >= 20)),
    "drydays": (("pr",), lambda n, w, t: _count(F.col("pr") < t)),
    "sdii": (("pr",), lambda n, w, t, truncate=True: _wet_mean(t, truncate)),
    "dryspelltotlen": (("pr",), _dry_spell),
    "wgdaysabove": (("vv", "dd"), _wind),
    "wxdaysabove": (("vv", "dd"), _wind),
}


def _literal(p) -> object:
    return F.lit(p) if isinstance(p, float) else p


def over_years(wanted: list[tuple[str, tuple]], days: DataFrame, keys: tuple[str, ...]) -> tuple[DataFrame, list[Column]]:
    """The days with the columns that the indices need, and an aggregate over a year of them for each (name, parameters).

    Parameters are numbers or columns of the days. Windows of all indices share one partitioning and one order.
    """
    w = runs.series(keys)
    plain: dict[str, Column] = {}
    first: dict[str, Column] = {}
    second: dict[str, Column] = {}
    third: dict[str, Column] = {}
    breaks = {}
    values = []
    for k, (name, parameters) in enumerate(wanted):
        plan = FUSED[name][1](f"i{k}", w, *map(_literal, parameters))
        if isinstance(plan, tuple):  # windows that mark days: values, ends, days inside
            plan, length = plan
            plain.update(plan.first)
            second.update(plan.second)
            third[f"i{k}_in"] = runs.in_any_window(f"i{k}_ends", length, w)
        else:
            first.update(plan.first)
        for c, condition in plan.run_of.items():
            plain[f"{c}_ok"] = F.coalesce(condition, F.lit(False))
            breaks[c] = F.max(F.when(~F.col(f"{c}_ok"), F.col("place")).when(F.col("opens"), F.col("place") - 1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
        values.append(plan.value)
    if breaks:
        first |= {"place": F.row_number().over(w), "opens": F.coalesce(F.year("date") != F.year(F.lag("date").over(w)), F.lit(True))}
        second |= {f"{c}_break": b for c, b in breaks.items()}
        third |= {f"{c}_run": F.col("place") - F.col(f"{c}_break") for c in breaks}
    for level in (plain, first, second, third):
        if level:
            days = days.withColumns(level)
    return days, values


def one(name: str, days: DataFrame, *parameters, keys: tuple[str, ...] = runs.KEYS, **columns: str) -> DataFrame:
    """keys, year, value of one index; columns tell which column of the days stands for a variable of another name."""
    if columns:
        days = days.withColumns({variable: F.col(c) for variable, c in columns.items() if variable != c})
    days, (value,) = over_years([(name, parameters)], days, keys)
    return days.groupBy(*keys, F.year("date").alias("year")).agg(value.alias("value"))
