"""Statistics over simulations: ensembles, tables, series, maps, diagrams, errors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isohyet.functions import physics

from . import resample, select

#: Scenario name of all simulations together, and of the reference.
POOLED, REFERENCE = "rcpxx", "ref"


def ensemble(df: DataFrame, value: str, keys: tuple[str, ...], centiles: tuple[float, ...] = ()) -> DataFrame:
    """Over simulations, for each key: mean, std (of the population), max, min and exact centiles c<nn>."""
    out = [F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.max(value).alias("max"), F.min(value).alias("min")]
    if centiles:
        out.append(F.percentile(value, F.array(*(F.lit(c / 100) for c in centiles))).alias("c"))
    found = df.groupBy(*keys).agg(*out)
    for k, c in enumerate(centiles):
        found = found.withColumn(f"c{c:g}", F.col("c")[k])
    return found.drop("c")


def horizons(df: DataFrame, spans: list[tuple[int, int]], year: str = "year") -> DataFrame:
    """Each row once for every span of years that it lies in, with column hor "first-last"."""
    hits = F.array(*(F.when(F.col(year).between(a, b), F.lit(f"{a}-{b}")) for a, b in spans))
    return df.withColumn("hor", F.explode(F.filter(hits, lambda x: x.isNotNull())))


def statistics_table(df: DataFrame, value: str, centiles: tuple[float, ...] = (10, 50, 90)) -> DataFrame:
    """rcp, hor, stat, centile, val from annual means by simulation (sim_code, rcp, hor): over years, then simulations.

    Each scenario and all of them together (rcpxx) come from one pass of grouping sets; the reference has its mean only,
    under stat none.
    """
    per_sim = df.groupBy("sim_code", "rcp", "hor").agg(F.avg(value).alias("v")).withColumn("s", F.when(F.col("rcp") != REFERENCE, F.col("v")))
    marks = [F.avg("v").alias("none"), F.avg("s").alias("mean"), F.min("s").alias("min"), F.max("s").alias("max"), F.percentile("s", F.array(*(F.lit(c / 100) for c in centiles))).alias("c")]
    sets = per_sim.groupingSets([["rcp", "hor"], ["hor"]], "rcp", "hor").agg(*marks)
    row = lambda stat, val, c=-1.0: F.struct(F.lit(stat).alias("stat"), F.lit(float(c)).alias("centile"), val.alias("val"))
    rows = [row(s, F.col(s)) for s in ("mean", "min", "max")] + [row("quantile", F.col("c")[k], c) for k, c in enumerate(centiles)]
    several = F.when(F.col("rcp") == REFERENCE, F.array(row("none", F.col("none")))).when(F.col("mean").isNotNull(), F.array(*rows))
    found = sets.select(F.coalesce("rcp", F.lit(POOLED)).alias("rcp"), "hor", F.explode(several).alias("x"))
    return found.select("rcp", "hor", "x.stat", "x.centile", F.round("x.val", 6).alias("val"))


def delta(df: DataFrame, value: str, reference: DataFrame) -> DataFrame:
    """Values minus the reference's overall mean, one number."""
    mean = reference.agg(F.avg(value).alias("ref_mean"))
    return df.crossJoin(F.broadcast(mean)).withColumn(value, F.col(value) - F.col("ref_mean")).drop("ref_mean")


def delta_by(df: DataFrame, value: str, reference: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Values minus the reference's at the same keys."""
    ref = reference.groupBy(*keys).agg(F.avg(value).alias("ref_value"))
    return df.join(ref, [*keys]).withColumn(value, F.col(value) - F.col("ref_value")).drop("ref_value")


def series_by_simulation(df: DataFrame, value: str, codes: list[str]) -> DataFrame:
    """A row per year, a column per simulation: means over cells."""
    wide = df.groupBy("year").pivot("sim_code", codes).agg(F.avg(value))
    return wide


def series_by_scenario(df: DataFrame, value: str, lower: float = 10, upper: float = 90) -> DataFrame:
    """year, rcp, lower, middle, upper: centile, mean and centile over simulations of their means over cells."""
    per_sim = df.groupBy("sim_code", "rcp", "year").agg(F.avg(value).alias("v"))
    return per_sim.groupBy("year", "rcp").agg(F.percentile("v", lower / 100).alias("lower"), F.avg("v").alias("middle"), F.percentile("v", upper / 100).alias("upper"))


def mean_map(df: DataFrame, value: str, keys: tuple[str, ...] = ("rcp", "hor")) -> DataFrame:
    """Mean over simulations' means over years, by cell."""
    per_sim = df.groupBy(*keys, "sim_code", "location_id").agg(F.avg(value).alias("v"))
    return per_sim.groupBy(*keys, "location_id").agg(F.avg("v").alias("val"))


def map_range(maps: DataFrame) -> DataFrame:
    """Least and greatest value of all maps of a horizon, for one colour scale."""
    return maps.groupBy("hor").agg(F.min("val").alias("low"), F.max("val").alias("high"))


def taylor(df: DataFrame, value: str, reference: DataFrame, on: tuple[str, ...]) -> DataFrame:
    """sim_code, sdev, crmsd, ccoef: spread, centred root mean square difference and correlation against the reference.

    Pairs with a missing side are left out. The reference's own row is labelled ref.
    """
    ref = reference.select(*on, F.col(value).alias("r")).filter("r is not null")
    pairs = df.select("sim_code", *on, F.col(value).alias("p")).filter("p is not null").join(ref, [*on])
    out = pairs.groupBy("sim_code").agg(F.stddev_pop("p").alias("sdev"), F.stddev_pop(F.col("p") - F.col("r")).alias("crmsd"), F.corr("p", "r").alias("ccoef"))
    own = ref.agg(F.stddev_pop("r").alias("sdev")).select(F.lit(REFERENCE).alias("sim_code"), "sdev", F.lit(0.0).alias("crmsd"), F.lit(1.0).alias("ccoef"))
    return own.unionByName(out)


#: What values are grouped by in Taylor statistics; a year is one group of all days.
STEPS = {"day": F.dayofmonth, "month": F.month, "year": lambda date: F.lit(0)}


def taylor_of_days(df: DataFrame, value: str, reference: DataFrame, step: str = "month", summable: bool = False, period: tuple[int, int] | None = None, cells: DataFrame | None = None, places: int | None = None) -> DataFrame:
    """sim_code, sdev, crmsd, ccoef from daily cubes, as taylor() gives them of ready series; the reference is labelled ref.

    Of each series: by days, gaps are closed first (amounts count as none, other values are interpolated in time); then
    29 February goes, the period and the cells (location_id) are kept, each day is the mean over cells, and days are grouped by
    day of month or month, or taken together: sums over the number of years with days, or means. A simulation that
    lacks one of the reference's groups, or has others, is left out.

    The reference is one more simulation in one plan; its values reach the others' groups by a window over a row for each
    simulation and group, not by a join.
    """
    series = reference.select(F.lit(REFERENCE).alias("sim_code"), "location_id", "date", value).unionByName(df.select("sim_code", "location_id", "date", value))
    if cells is not None:
        series = series.join(cells.select("location_id").distinct(), "location_id", "left_semi")
    if step == "day":
        series = series.withColumn(value, F.coalesce(value, F.lit(0.0))) if summable else resample.fill_days(series, value, ("sim_code", "location_id"))
    series = select.remove_feb29(select.select_period(series, *period) if period else series)
    days = series.groupBy("sim_code", "date").agg(F.avg(value).alias("v"))
    groups = days.groupBy("sim_code", STEPS[step](F.col("date")).alias("step")).agg(F.sum("v").alias("sum"), F.avg("v").alias("mean"), F.collect_set(F.year("date")).alias("years"))
    own = Window.partitionBy("sim_code")
    n_years = F.size(F.array_distinct(F.flatten(F.collect_list("years").over(own))))
    values = groups.select("sim_code", "step", (F.coalesce("sum", F.lit(0.0)) / n_years if summable else F.col("mean")).alias("p"), F.count(F.lit(1)).over(own).alias("n"))
    same = Window.partitionBy("step")
    of_ref = lambda c: F.max(F.when(F.col("sim_code") == REFERENCE, F.col(c))).over(same)
    pairs = values.withColumns({"r": of_ref("p"), "n_ref": of_ref("n")}).withColumn("met", F.count("n_ref").over(own))
    both = pairs.filter("n = n_ref and met = n and p is not null and r is not null").groupBy("sim_code")
    out = both.agg(F.stddev_pop("p").alias("sdev"), F.stddev_pop(F.col("p") - F.col("r")).alias("crmsd"), F.when(F.col("sim_code") == REFERENCE, 1.0).otherwise(F.corr("p", "r")).alias("ccoef"))
    return out if places is None else out.withColumns({c: F.round(c, places) for c in ("sdev", "crmsd", "ccoef")})


def error(method: str, obs: str = "obs", pred: str = "pred") -> Column:
    """Aggregate: r2, mae, rmse or rrmse of predictions; pairs with a missing side do not count."""
    both = F.col(obs).isNotNull() & F.col(pred).isNotNull()
    o, p = F.when(both, F.col(obs)), F.when(both, F.col(pred))
    if method == "r2":
        return 1 - F.try_divide(F.sum((o - p) * (o - p)), F.var_pop(o) * F.count(o))
    if method == "mae":
        return F.avg(F.abs(o - p))
    rmse = F.sqrt(F.avg((o - p) * (o - p)))
    if method == "rmse":
        return rmse
    if method == "rrmse":
        return F.coalesce(F.try_divide(rmse, F.stddev_pop(o)), F.lit(0.0))
    raise ValueError(f"unknown method: {method}")


def paired(obs: DataFrame, pred: DataFrame, value: str, on: tuple[str, ...]) -> DataFrame:
    """Observations and predictions of the same keys: columns obs, pred."""
    return obs.select(*on, F.col(value).alias("obs")).join(pred.select(*on, F.col(value).alias("pred")), [*on])


def bias_error(reference: DataFrame, adjusted: DataFrame, value: str, method: str = "rrmse", keys: tuple[str, ...] = ("location_id",)) -> DataFrame:
    """Error of monthly sums, rounded to 4 places, by cell."""
    months = paired(resample.monthly(reference, value, "sum", keys), resample.monthly(adjusted, value, "sum", keys), value, (*keys, "year", "month"))
    return months.groupBy(*keys).agg(F.round(error(method), 4).alias("bias_err"))


def annual_comparison(obs: DataFrame, sim: DataFrame, adjusted: DataFrame, value: str, keys: tuple[str, ...] = ("location_id",)) -> DataFrame:
    """keys, year, obs, sim, adjusted: annual means, with years of any of the three."""
    parts = [resample.annual(x, value, "mean", keys).withColumnRenamed(value, n) for x, n in ((obs, "obs"), (sim, "sim"), (adjusted, "adjusted"))]
    return parts[0].join(parts[1], [*keys, "year"], "full").join(parts[2], [*keys, "year"], "full")


def bias_comparison(obs: DataFrame, sim: DataFrame, adjusted: DataFrame, value: str, keys: tuple[str, ...] = ("location_id",)) -> DataFrame:
    """keys, day, obs, sim, adjusted by place in the series, from 1. Days of simulations; what observations have beyond them goes.

    The series are stacked and numbered, and one grouping by the numbering's own keys puts them side by side.
    """
    named = [x.select(*keys, "date", F.lit(n).alias("series"), F.col(value).alias("v")) for x, n in ((obs, "obs"), (sim, "sim"), (adjusted, "adjusted"))]
    stacked = named[0].unionByName(named[1]).unionByName(named[2])
    placed = stacked.withColumn("day", F.row_number().over(Window.partitionBy(*keys, "series").orderBy("date")))
    wide = placed.groupBy(*keys, "day").agg(*(F.max(F.when(F.col("series") == n, F.col("v"))).alias(n) for n in ("obs", "sim", "adjusted")), F.max((F.col("series") != "obs").cast("int")).alias("simulated"))
    return wide.filter("simulated = 1").drop("simulated")


def positional_comparison(obs: DataFrame, sim: DataFrame, value: str, keys: tuple[str, ...] = ("location_id",)) -> DataFrame:
    """Daily values side by side by their place in the series, from 1, whatever their dates."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("date"))
    a = obs.select(*keys, place.alias("day"), F.col(value).alias("obs"))
    b = sim.select(*keys, place.alias("day"), F.col(value).alias("sim"))
    return a.join(b, [*keys, "day"], "full")


def shared_simulations(df: DataFrame, n_vars: int) -> DataFrame:
    """Simulations that have all of the variables."""
    return df.groupBy("sim_code").agg(F.count_distinct("var").alias("n")).filter(F.col("n") == n_vars).select("sim_code")


def halves(features: DataFrame, columns: list[str]) -> DataFrame:
    """Add cluster, 0 or 1: of all splits in two, by one or two feature columns, the one with the least sum of squares about its means.

    A line parts the halves of that split, and can be turned until it goes through a simulation of each. So every pair tells
    two splits: what is left, or right, of its line, with what is on the line on the first one's side of their midpoint.
    The best split leaves a gap in the order of extent / n^1.5, so what is within 1e-12 of the extent counts as on the line.
    Of equal splits it is the one that keeps the last simulations, by the other columns, in one half. One simulation has no split.
    """
    keys = [c for c in features.columns if c not in columns]
    known = [F.when(F.col(c).isNull() | F.isnan(F.col(c).cast("double")), F.raise_error(F.lit(f"{c} has a missing value"))).otherwise(F.col(c)).alias(c) for c in columns]
    whole = features.select(F.struct(*keys, *known).alias("row")).agg(F.array_sort(F.collect_list("row")).alias("rows"))
    x, y = (F.transform("rows", lambda r: r[columns[k]].cast("double") if k < len(columns) else F.lit(0.0)) for k in (0, 1))
    first = whole.select("rows", x.alias("x"), y.alias("y")).select("*", F.posexplode("x").alias("i", "xi")).repartition("i")
    pairs = first.select("*", F.posexplode("x").alias("j", "xj")).filter("i < j")
    lines = pairs.selectExpr("rows", "x", "y", "i", "xi", "y[i] AS yi", "xj - xi AS dx", "y[j] - y[i] AS dy", "1e-12D * (array_max(x) - array_min(x) + array_max(y) - array_min(y)) AS near", "explode(array(1, -1)) AS turn")
    side = """transform(x, (v, n) -> CASE
        WHEN turn * (dx * (y[n] - yi) - dy * (v - xi)) > near * sqrt(dx * dx + dy * dy) THEN 1
        WHEN turn * (dx * (y[n] - yi) - dy * (v - xi)) < -near * sqrt(dx * dx + dy * dy) THEN 0
        WHEN dx = 0 AND dy = 0 THEN int(n <= i)
        ELSE int(2 * (dx * (v - xi) + dy * (y[n] - yi)) < dx * dx + dy * dy) END)"""
    splits = lines.select("rows", "x", "y", F.expr(side).alias("side")).withColumn("g", F.expr("transform(side, s -> int(s != element_at(side, -1)))"))
    means = {f"{c}{g}": F.expr(f"aggregate(zip_with(g, {c}, (s, v) -> if(s = {g}, v, 0D)), 0D, (a, v) -> a + v) / size(filter(g, s -> s = {g}))") for c in "xy" for g in (0, 1)}
    spread = "aggregate(transform(g, (s, n) -> pow(x[n] - if(s = 1, x1, x0), 2) + pow(y[n] - if(s = 1, y1, y0), 2)), 0D, (a, v) -> a + v)"
    named = "if(x1 < x0 OR x1 = x0 AND y1 < y0, transform(g, s -> 1 - s), g)"
    told = splits.withColumns(means).selectExpr("rows", f"{named} AS named", f"struct({spread} AS ss, reverse(g) AS g) AS rank")
    best = told.agg(F.min_by("named", "rank").alias("named"), F.first("rows").alias("rows"))
    return best.select("named", F.posexplode("rows").alias("n", "row")).select(*(F.col("row")[c].alias(c) for c in features.columns), F.get("named", "n").alias("cluster"))


def clusters(features: DataFrame, columns: list[str], k: int, seed: int = 42) -> DataFrame:
    """Add cluster, from k-means over the feature columns; clusters are numbered in order of their first feature's mean.

    Two clusters of one or two features are the best split of all; others are what k-means ends at from its seed.
    """
    if k == 2 and len(columns) <= 2:
        return halves(features, columns)
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    assembled = VectorAssembler(inputCols=columns, outputCol="features").transform(features)
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="found").fit(assembled)
    centres = [tuple(c) for c in model.clusterCenters()]  # k points
    names = F.array(*(F.lit(sorted(centres).index(c)) for c in centres))
    return model.transform(assembled).withColumn("cluster", F.get(names, F.col("found"))).drop("features", "found")


def clusters_of_all(features: DataFrame, columns: list[str], n: int, seed: int = 42) -> DataFrame:
    """k and cluster for every number of clusters from 1 to n - 1, of the n simulations in features."""
    one = features.withColumns({"k": F.lit(1), "cluster": F.lit(0)})
    for k in range(2, n):  # a model for each k; simulations are few
        one = one.unionByName(clusters(features, columns, k, seed).withColumn("k", F.lit(k)))
    return one


def calc_stats(daily: DataFrame, value: str, var: str, spans: list[tuple[int, int]], keys: tuple[str, ...] = ("rcp", "hor"), cells: DataFrame | None = None, units: tuple[str, str] | None = None, centiles: tuple[float, ...] = (), reference: DataFrame | None = None) -> DataFrame:
    """keys, mean, std, max, min and centiles over simulations of a variable's annual values in horizons.

    daily: sim_code, rcp, location_id, date, value. Amounts are summed over a year, others averaged; cells (location_id of a
    clip or of one point) limit where, units (from, to) converts, and with a reference, of the same form without sim_code,
    its mean over years is taken off. One scan of each: years, horizons and simulations are groupings of the same rows.
    """
    how = "sum" if var in ("pr", "evspsbl", "evspsblpot") else "mean"

    def years(df: DataFrame, own: tuple[str, ...]) -> DataFrame:
        out = df if cells is None else df.join(cells.select("location_id"), "location_id", "left_semi")
        out = resample.annual(out, value, how, (*own, "location_id"))
        return out.withColumn(value, physics.convert(F.col(value), *units)) if units else out

    per_sim = horizons(years(daily, ("sim_code", "rcp")), spans).groupBy("sim_code", *keys).agg(F.avg(value).alias(value))
    if reference is not None:
        per_sim = delta(per_sim, value, years(reference, ()))
    return ensemble(per_sim, value, keys, centiles)


def linear_trend(df: DataFrame, value: str, keys: tuple[str, ...], x: str = "year") -> DataFrame:
    """keys, slope, intercept of a straight line by least squares."""
    return df.groupBy(*keys).agg(F.regr_slope(value, x).alias("slope"), F.regr_intercept(value, x).alias("intercept"))


def detrend(df: DataFrame, value: str, keys: tuple[str, ...], x: str = "year") -> DataFrame:
    """Values minus their straight line, plus the line's mean."""
    fit = linear_trend(df, value, keys, x)
    mean = F.avg(F.col("slope") * F.col(x) + F.col("intercept")).over(Window.partitionBy(*keys))
    line = F.col("slope") * F.col(x) + F.col("intercept")
    return df.join(fit, [*keys]).withColumn(value, F.col(value) - line + mean).drop("slope", "intercept")


def polynomial(df: DataFrame, value: str, keys: tuple[str, ...], degree: int, x: str = "year") -> DataFrame:
    """keys, coefficients (highest power first, of x minus its mean) by least squares over each key's rows.

    Power sums are added up by Spark, so no group is gathered; only the (degree + 1) square systems go to Python.
    """
    usable = df.filter(F.col(value).isNotNull()).join(df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.avg(x).alias("x0"), F.greatest(F.max(x) - F.min(x), F.lit(1)).alias("xs")), [*keys])
    z = (F.col(x) - F.col("x0")) / F.col("xs")
    sums = usable.groupBy(*keys).agg(F.first("x0").alias("x0"), F.first("xs").cast("double").alias("xs"), F.array(*(F.sum(F.pow(z, F.lit(float(p)))) for p in range(2 * degree + 1))).alias("s"), F.array(*(F.sum(F.pow(z, F.lit(float(p))) * F.col(value)) for p in range(degree + 1))).alias("t"))

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def solve(s: pd.Series, t: pd.Series, xs: pd.Series) -> pd.Series:
        out = []
        for a, b, scale in zip(s, t, xs, strict=True):
            m = np.array([[a[i + j] for j in range(degree + 1)] for i in range(degree + 1)])
            c = np.linalg.lstsq(m, np.array(b), rcond=None)[0] / scale ** np.arange(degree + 1)
            out.append(c[::-1])
        return pd.Series(out)

    return sums.select(*keys, "x0", solve("s", "t", "xs").alias("coefficients"))


def trend_table(df: DataFrame, value: str, keys: tuple[str, ...], degree: int = 4, x: str = "year") -> DataFrame:
    """keys, x, value, trend (a polynomial) and detrended (without the straight line): the rows behind the trend diagram."""
    fit = polynomial(df, value, keys, degree, x)
    flat = detrend(df, value, keys, x).select(*keys, x, F.col(value).alias("detrended"))
    curve = df.join(fit, [*keys]).withColumn("trend", evaluate_polynomial("coefficients", F.col(x) - F.col("x0")))
    return curve.select(*keys, x, value, "trend").join(flat, [*keys, x])


def evaluate_polynomial(coefficients: str, x: Column) -> Column:
    return F.aggregate(coefficients, F.lit(0.0), lambda acc, c: acc * x + c)
