"""SQL functions and stored series: the same rows as the functions', and plans without what they are there to avoid."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from isohyet import surface
from isohyet.operators import annual, indices
from isohyet.plans import catalog
from isohyet.sources import cubes, tables


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_functions_in_sql(spark, sf_dir):
    pr, tas = cubes.precipitation(spark, sf_dir), cubes.temperature(spark, sf_dir)
    assert set(surface.register(spark, daily_pr=pr)) & {"wet_days", "tx_days_above"} == {"wet_days"}
    made = surface.register(spark, daily_pr=pr, daily_tas=tas)
    assert len(made) == len(set(made)) == len(surface.FUNCTIONS)
    rows = lambda df: sorted(tuple(r) for r in df.select("location_id", "year", "value").collect())
    same = {"wet_days(20D)": indices.wet_days(pr, 20.0), "dry_days(1D)": indices.dry_days(pr, 1.0), "rx1day()": indices.max_amount(pr), "cdd(20D)": indices.consecutive_dry_days(pr, 20.0), "hot_spell_frequency(30D, 3)": indices.hot_spell_frequency(tas, "tasmax", 30.0, 3)}
    for call, want in same.items():
        found = spark.sql(f"SELECT * FROM {call}")
        assert rows(found) == rows(want), call
        for word in ("Python", "NestedLoop", "Cartesian"):
            assert word not in _plan(found)
        assert _plan(found).count("Exchange") <= _plan(want).count("Exchange"), call
    one = spark.sql("SELECT * FROM wet_days(20D) WHERE location_id = 3")
    assert one.count() == 7
    assert spark.sql("SELECT in_season(10, 300, 59), in_season(100, 300, 59), angle_between(350D, 20D), round(wind_speed(3D, 4D), 6)").first()[:] == (True, False, 30.0, 5.0)
    with pytest.raises(ValueError, match="missing columns"):
        surface.register(spark, daily_pr=tas)


def test_stored_series_need_no_exchange(spark, sf_dir, tmp_path):
    pr = cubes.precipitation(spark, sf_dir).select("location_id", "date", "pr")
    series = tables.save_by_series(pr, "series_of_test", str(tmp_path / "series"), buckets=4)
    wanted = [("wetdays", 1.0), ("cdd", 20.0), ("rx5day",), ("dryspelltotlen", 20.0, 5, "max")]
    found = annual.indices_of(wanted, series, keys=("location_id",))
    assert "Exchange" not in _plan(found) and "Sort " not in _plan(found)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, annual.indices_of(wanted, pr, keys=("location_id",)).collect()))
    assert "Exchange" not in _plan(series.filter("location_id = 3").groupBy("location_id").agg(F.sum("pr")))


def test_quantiles_by_counts_and_by_ranges(spark):
    df = spark.range(1000).select((F.col("id") * F.col("id") % 97 / 4).alias("v")).unionByName(spark.range(3).select(F.lit(None).cast("double").alias("v")))
    for q in (0.0, 0.1, 0.5, 0.937, 1.0):
        want = df.agg(F.round(F.percentile("v", q), 4)).first()[0]
        for few in (0, 10_000):
            assert indices.reference_quantile(df, "v", q, 4, few).first().threshold == want, (q, few)


def test_all_indices_keep_only_what_they_read_again(spark, sf_dir):
    """What is stored for the parts that read the days on their own has their columns only."""
    daily = cubes.precipitation(spark, sf_dir).withColumn("wide", F.lit("x" * 50))
    found = annual.indices_of([("rx1day",), ("rainstart", {"wet_amount": 110.0, "wet_window": 3, "dry_threshold": 12.0, "dry_days": 4, "dry_window": 12, "first": 60, "last": 365}), ("rainstart", {"wet_amount": 90.0, "wet_window": 3, "dry_threshold": 12.0, "dry_days": 4, "dry_window": 12, "first": 60, "last": 365}, {"as": "other"})], daily, keys=("location_id",))
    scans = [line for line in _plan(found).splitlines() if "FileScan" in line and "isohyet" in line]
    assert scans and all("wide" not in line for line in scans)
    assert {r.idx for r in found.select("idx").distinct().collect()} == {"rx1day", "rainstart", "other"}


def test_queries_of_streams_and_stores_are_registered():
    assert {"zarr_box", "netcdf_box", "ingest_of_days", "spells_of_stream", "mean_by_region", "last_order_before", "dry_spells_of_seasons", "indices_in_sql"} <= set(catalog.ORACLE_SQL)
