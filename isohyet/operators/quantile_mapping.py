"""Bias adjustment by quantile mapping: factors by day of year (or month, or overall) and quantile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isohyet.functions import physics

from . import ensemble, resample, runs, select

KEYS = runs.KEYS
LOW, HIGH = 0.0001, 0.9999


def nodes(nq: int) -> list[float]:
    """The quantiles at which factors are known: nq equal steps, and one near each end."""
    return [LOW, *((k + 0.5) / nq for k in range(nq)), HIGH]


def _pooled(df: DataFrame, value: str, group: str, window: int, keys: tuple[str, ...]) -> DataFrame:
    """Values by group; for days of year each value also counts for the rows around it: a centred window of rows.

    A row goes to the rows whose windows hold it, so pooling is an explode and not a range join. Windows that reach over
    an end of the series are shorter there.
    """
    if group == "month":
        return df.select(*keys, F.month("date").alias("grp"), value)
    if group == "all":
        return df.select(*keys, F.lit(1).alias("grp"), value)
    if group != "doy":
        raise ValueError(f"unknown group: {group}")
    if window <= 1:
        return df.select(*keys, F.dayofyear("date").alias("grp"), value)
    half = window // 2
    w = runs.series(keys)
    around = F.collect_list(F.dayofyear("date")).over(w.rowsBetween(-(window - half - 1), half))
    return df.withColumn("around", around).select(*keys, F.explode("around").alias("grp"), value)


def quantiles(df: DataFrame, value: str, nq: int, group: str = "doy", window: int = 1, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """keys, grp, quantiles: an array along nodes(nq), from one exact aggregation."""
    return _pooled(df, value, group, window, keys).groupBy(*keys, "grp").agg(F.percentile(value, F.array(*map(F.lit, nodes(nq)))).alias("quantiles"))


def train(reference: DataFrame, simulated: DataFrame, value: str, nq: int, kind: str = "+", group: str = "doy", window: int = 1, keys: tuple[str, ...] = KEYS, detrend: bool = False) -> DataFrame:
    """keys, grp, node, q, factor: what to add to (kind +) or multiply (kind *) simulated values by; NULL where 0 divides.

    detrend takes each series' straight line over time off first.
    """
    if detrend:
        reference, simulated = detrended(reference, value, keys), detrended(simulated, value, keys)
    ref = quantiles(reference, value, nq, group, window, keys).withColumnRenamed("quantiles", "ref_q")
    sim = quantiles(simulated, value, nq, group, window, keys)
    both = ref.join(sim, [*keys, "grp"])
    factors = F.zip_with("ref_q", "quantiles", (lambda r, s: r - s) if kind == "+" else (lambda r, s: F.try_divide(r, s)))
    marks = F.array(*map(F.lit, nodes(nq)))
    return both.select(*keys, "grp", F.posexplode(F.arrays_zip(marks.alias("q"), factors.alias("factor")))).select(*keys, "grp", F.col("pos").alias("node"), F.col("col.q").alias("q"), F.col("col.factor").alias("factor"))


def clip_factors(factors: DataFrame, limit: float = 3.0) -> DataFrame:
    return factors.withColumn("factor", F.when(F.col("factor").isNotNull(), F.greatest(F.least("factor", F.lit(limit)), F.lit(-limit))))


def nearest_node(p: Column, nq: int) -> Column:
    """Index of the node nearest to a rank, ties to the larger; in closed form, without a search."""
    d = 1 / (2 * nq)
    inner = F.least(F.greatest(F.floor((p - d) * nq + 0.5), F.lit(0)), F.lit(nq - 1)) + 1
    return F.when(p < (LOW + d) / 2, 0).when(p >= (HIGH + 1 - d) / 2, nq + 1).otherwise(inner).cast("int")


def _group(group: str) -> Column:
    return {"doy": F.dayofyear("date"), "month": F.month("date"), "all": F.lit(1)}[group]


def _adjusted(value: str, factor: Column, kind: str) -> Column:
    return F.col(value) + factor if kind == "+" else F.col(value) * factor


def predict(simulated: DataFrame, factors: DataFrame, value: str, nq: int, kind: str = "+", group: str = "doy", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The series with column adjusted: each value's rank in its group picks the nearest node's factor.

    A group's factors are one map, joined on the group, by which the ranked rows are already partitioned.
    """
    ranked = simulated.withColumn("grp", _group(group)).withColumn("p", runs.percentile_rank(value, (*keys, "grp")))
    ranked = ranked.withColumn("node", nearest_node(F.col("p"), nq))
    by_node = factors.groupBy(*keys, "grp").agg(F.map_from_entries(F.collect_list(F.struct("node", "factor"))).alias("f"))
    found = ranked.join(by_node, [*keys, "grp"], "left")
    return found.withColumn("adjusted", _adjusted(value, F.try_element_at("f", F.col("node")), kind)).drop("node", "f", "p")


def predict_interpolated(simulated: DataFrame, factors: DataFrame, value: str, nq: int, kind: str = "+", group: str = "doy", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """As predict, with factors interpolated between the two nodes around a rank; beyond the outer nodes they are flat.

    Groups are whole days of year, so interpolation along them meets a node exactly.
    """
    lists = factors.groupBy(*keys, "grp").agg(F.transform(F.array_sort(F.collect_list(F.struct("node", "factor"))), lambda x: x["factor"]).alias("f"))
    ranked = simulated.withColumn("grp", _group(group)).withColumn("p", runs.percentile_rank(value, (*keys, "grp"))).join(lists, [*keys, "grp"], "left")
    marks = F.array(*map(F.lit, nodes(nq)))
    above = F.size(F.filter(marks, lambda q: q <= F.col("p")))  # nodes at or below the rank
    lo, hi = F.greatest(above, F.lit(1)), F.least(above + 1, F.lit(nq + 2))
    q0, q1 = F.element_at(marks, lo), F.element_at(marks, hi)
    f0, f1 = F.element_at("f", lo), F.element_at("f", hi)
    factor = F.when(above == 0, f0).when(above == nq + 2, F.element_at("f", nq + 2)).otherwise(f0 + (f1 - f0) * (F.col("p") - q0) / (q1 - q0))
    return ranked.withColumn("adjusted", _adjusted(value, F.when(F.col("p").isNotNull(), factor), kind)).drop("f", "p")


def pad_cyclic(factors: DataFrame, last: int = 365, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Also day 0, as the last day, and the day after the last, as the first."""
    before = factors.filter(F.col("grp") == last).withColumn("grp", F.lit(0))
    after = factors.filter("grp = 1").withColumn("grp", F.lit(last + 1))
    return factors.unionByName(before).unionByName(after)


def pad_quantiles(factors: DataFrame, nq: int) -> DataFrame:
    """Also quantiles 0 and 1, with the factors of the first and the last node."""
    low = factors.filter("node = 0").withColumns({"node": F.lit(-1), "q": F.lit(0.0)})
    high = factors.filter(F.col("node") == nq + 1).withColumns({"node": F.lit(nq + 2), "q": F.lit(1.0)})
    return factors.unionByName(low).unionByName(high)


def _position() -> Column:
    return F.datediff("date", F.lit("1970-01-01").cast("date")).cast("double")


def detrended(df: DataFrame, value: str, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The series without its straight line over time, around the line's mean; column trend holds what was taken off."""
    mean = Window.partitionBy(*keys)
    fit = ensemble.linear_trend(df.withColumn("x", _position()), value, keys, "x")
    line = F.col("slope") * _position() + F.col("intercept")
    out = df.join(fit, [*keys]).withColumn("line", line)
    out = out.withColumn("trend", F.col("line") - F.avg("line").over(mean))
    return out.withColumn(value, F.col(value) - F.col("trend")).drop("slope", "intercept", "line")


def predict_detrended(simulated: DataFrame, factors: DataFrame, value: str, nq: int, kind: str = "+", group: str = "doy", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """As predict, of the series without its trend, which is put back afterwards; factors come of train(..., detrend=True)."""
    found = predict(detrended(simulated, value, keys), factors, value, nq, kind, group, keys)
    return found.withColumns({value: F.col(value) + F.col("trend"), "adjusted": F.col("adjusted") + F.col("trend")}).drop("trend")


def preprocess(df: DataFrame, value: str, volumetric: bool, noise: float = 0.0, seed: int = 42, ceiling: float | None = None, implausible: float | None = None, days_of_year: int = 365) -> DataFrame:
    """Without 29 February; volumetric values are not negative.

    With noise each day of a simulation gets one seeded draw, the same for all its cells. Values above the ceiling (100 for
    cloud cover) become it, and those above what is plausible (0.01 for rates in kg m-2 s-1) next to nothing. Series of
    360-day years (columns year and doy instead of date) are brought onto plain years first.
    """
    keys = tuple(k for k in ("sim_code", "location_id") if k in df.columns)
    out = select.remove_feb29(resample.from_360_days(df, value, keys) if days_of_year == 360 else df)
    if ceiling is not None:
        out = out.withColumn(value, physics.clamp(F.col(value), high=ceiling))
    if implausible is not None:
        out = out.withColumn(value, F.when(F.col(value) > implausible, 1e-12).otherwise(F.col(value)))
    if volumetric:
        out = out.withColumn(value, physics.clamp(F.col(value), low=0.0))
        out = out.withColumn(value, physics.perturb(F.col(value), *(k for k in keys if k == "sim_code"), "date", size=noise, seed=seed)) if noise else out
    return out


def adjust(reference: DataFrame, simulated: DataFrame, value: str, volumetric: bool, nq: int = 50, window: int = 30, limit: float = 3.0, reference_years: tuple[int, int] | None = None, keys: tuple[str, ...] = KEYS, detrend: bool = False) -> DataFrame:
    """The whole chain: clean, fill gaps, learn factors over the reference years, clip them and apply them to all years."""
    kind = "*" if volumetric else "+"
    ref, sim = (resample.fill_gaps(preprocess(x, value, volumetric), value, keys) for x in (reference, simulated))
    past = select.select_period(sim, *reference_years) if reference_years else sim
    factors = train(ref, past, value, nq, kind, "doy", window, keys, detrend)
    return (predict_detrended if detrend else predict)(sim, clip_factors(factors, limit) if volumetric else factors, value, nq, kind, "doy", keys)


def missing_parameters(wanted: DataFrame, known: DataFrame, keys: tuple[str, ...] = ("sim_code", "var")) -> DataFrame:
    """Rows of the bias-parameter table that are not there yet."""
    return wanted.join(known, [*keys], "left_anti")


def update_parameters(known: DataFrame, wanted: DataFrame, keys: tuple[str, ...] = ("sim_code", "var")) -> DataFrame:
    """The known rows, and the wanted ones that are not there yet."""
    return known.unionByName(missing_parameters(wanted, known, keys))


def write_errors(known: DataFrame, errors: DataFrame, keys: tuple[str, ...] = ("sim_code", "var")) -> DataFrame:
    """The bias-parameter table with bias_err replaced where an error was computed."""
    return known.join(errors.select(*keys, F.col("bias_err").alias("fresh")), [*keys], "left").withColumn("bias_err", F.coalesce("fresh", "bias_err")).select(known.columns)


def moving_window_rows(df: DataFrame, value: str, window: int, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """A row's centred window as an array, from window - window // 2 - 1 rows before it to window // 2 after."""
    half = window // 2
    return df.withColumn("window", F.collect_list(value).over(Window.partitionBy(*keys).orderBy("date").rowsBetween(-half, window - half - 1)))
