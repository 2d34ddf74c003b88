"""Single indices and one pass over all of them give the same rows, also for years and days that are not whole."""

from __future__ import annotations

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from isohyet import model
from isohyet.operators import annual, indices

DDL = "location_id int, date date, tasmin double, tasmax double, pr double, vv double, dd double"


def _days(spark):
    """A whole year, a leap year with gaps, a year of 29 February alone, one of winter only, and a cell without values."""
    rng = random.Random(7)
    whole = [date(1999, 1, 1) + timedelta(days=k) for k in range(365)]
    leap = [date(2000, 1, 1) + timedelta(days=k) for k in range(366) if rng.random() < 0.9]
    few = [date(2004, 2, 29), date(2008, 12, 31), *(date(2009, 1, 1) + timedelta(days=k) for k in range(40))]
    some = lambda *values: None if rng.random() < 0.1 else rng.choice(values)
    rows = [(1, d, some(1.0, 3.0, 8.0), some(28.0, 31.0, 39.0), some(0.0, 0.5, 2.0, 12.0, 25.0), some(2.0, 5.0), some(10.0, 190.0, 350.0)) for d in (*whole, *leap, *few)]
    return spark.createDataFrame(rows + [(2, d, *[None] * 5) for d in whole], DDL)


def test_single_indices_and_one_pass_agree(spark):
    df = _days(spark).persist()
    a, b = model.doy_of("03-01"), model.doy_of("11-30")
    single = {
        ("txdaysabove", 30.0, a, b): indices.days_above(df, "tasmax", 30.0, a, b),
        ("tx90p", "90p"): indices.days_above_reference(df, indices.reference_quantile(df, "tasmax", 0.9), "tasmax"),
        ("tndaysbelow", 2.0, b, a): indices.days_below(df, "tasmin", 2.0, b, a),
        ("tngmonthsbelow", 4.0): indices.months_below(df, "tasmin", 4.0),
        ("hotspellfreq", 30.0, 2): indices.hot_spell_frequency(df, "tasmax", 30.0, 2),
        ("hotspellmaxlen", 30.0, 2): indices.hot_spell_max_length(df, "tasmax", 30.0, 2),
        ("hotspelltotlen", 30.0, 3): indices.hot_spell_total_length(df, "tasmax", 30.0, 3),
        ("wsdi", 2): indices.warm_spell_duration(df, indices.doy_percentile(df, "tasmax"), "tasmax", 2),
        ("heatwavemaxlen", 2.0, 30.0, 2): indices.heat_wave_max_length(df, 2.0, 30.0, 2),
        ("heatwavetotlen", 2.0, 30.0, 2): indices.heat_wave_total_length(df, 2.0, 30.0, 2),
        ("txg",): indices.annual_mean(df, "tasmax"),
        ("tnx",): indices.annual_max(df, "tasmin"),
        ("tgg",): indices.mean_temperature(df),
        ("etr",): indices.extreme_range(df),
        ("tropicalnights", 2.0): indices.tropical_nights(df, 2.0),
        ("rx1day",): indices.max_amount(df),
        ("rx5day",): indices.max_amount(df, 5),
        ("prcptot", a, b): indices.total_amount(df, a, b),
        ("cwd", 1.0): indices.consecutive_wet_days(df, 1.0),
        ("cdd", 1.0): indices.consecutive_dry_days(df, 1.0),
        ("wetdays", 1.0, 20.0): indices.wet_days(df, 1.0, 20.0),
        ("drydays", 1.0): indices.dry_days(df, 1.0),
        ("sdii", 1.0): indices.daily_intensity(df, 1.0),
        ("dryspelltotlen", 3.0, 3, "max", a, b): indices.dry_spell_total_length(df, 3.0, 3, "max", a, b),
        ("wgdaysabove", 3.0, 180.0, 45.0): indices.strong_wind_days(df, 3.0, 180.0, 45.0),
    }
    asked = [(*x, {"as": f"i{k}"}) for k, x in enumerate(single)]
    found = {}
    for r in annual.indices_of(asked, df, df, ("location_id",)).collect():
        found.setdefault(r.idx, {})[r.location_id, r.year] = None if r.value is None else round(r.value, 9)
    years = {tuple(r) for r in df.select("location_id", F.year("date")).distinct().collect()}
    for k, (name, own) in enumerate(single.items()):
        got = {(r.location_id, r.year): None if r.value is None else round(float(r.value), 9) for r in own.collect()}
        assert set(got) == years, name  # a year with days has a row
        assert got == found[f"i{k}"], name


def test_counts_are_longs(spark):
    df = _days(spark)
    counts = [indices.days_above(df, "tasmax", 30.0), indices.months_below(df, "tasmin", 4.0), indices.hot_spell_max_length(df, "tasmax", 30.0, 2), indices.hot_spell_frequency(df, "tasmax", 30.0, 2), indices.heat_wave_total_length(df, 2.0, 30.0, 2), indices.dry_spell_total_length(df, 3.0, 3)]
    assert {dict(x.dtypes)["value"] for x in counts} == {"bigint"}
