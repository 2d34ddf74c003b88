"""Properties of operators that need no tables."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from isohyet import config, model
from isohyet.functions import physics
from isohyet.operators import annual, ensemble, grid, indices, quantile_mapping, rainseason, resample, runs, select, workflow
from isohyet.sources import tables
from isohyet.streaming import aggregates


def _daily(spark, values, start=date(2001, 1, 1), name="v"):
    return spark.createDataFrame([("a", start + timedelta(days=k), v) for k, v in enumerate(values)], f"location_id string, date date, {name} double")


def test_doy_helpers():
    assert model.doy_of("03-01") == 60 and model.doy_of("02-29") == 59 and model.doy_of("12-31") == 365
    assert all(model.doy_of(model.month_day_of(d)) == d for d in range(1, 366))
    assert config.season_of("nan", "01-31") == (-1, 31)


def test_missing_values(spark):
    df = model.missing_to_null(_daily(spark, [1.0, float("nan"), 3.0]), "v")
    assert df.agg(F.avg("v"), F.count("v")).first()[:] == (2.0, 2)
    assert model.units_of(model.with_units(df, "v", "mm"), "v") == "mm"
    with pytest.raises(ValueError):
        model.require(df, "tas")


def test_run_lengths_add_up(spark):
    rng = np.random.default_rng(1)
    wet = rng.random(800) < 0.6
    df = _daily(spark, wet.astype(float).tolist())
    total = runs.run_total(df, "v > 0", 1).agg(F.sum("value")).first()[0]
    assert total == wet.sum()
    longest = {r.year: r.value for r in runs.longest_run(df, "v > 0").collect()}
    days = [date(2001, 1, 1) + timedelta(days=k) for k in range(800)]
    for year in (2001, 2002, 2003):
        best = at = 0
        for d, w in zip(days, wet):
            if d.year == year:
                at = at + 1 if w else 0
                best = max(best, at)
        assert longest[year] == best


def test_units_and_wind(spark):
    one = spark.range(1)
    value = lambda c: one.select(c).first()[0]
    assert value(physics.convert(F.lit(300.0), "K", "C")) == pytest.approx(26.85)
    assert value(physics.convert(F.lit(1.0), "kg m-2 s-1", "mm")) == 86400
    with pytest.raises(ValueError):
        physics.convert(F.lit(1.0), "mm", "K")
    speed, direction = physics.wind_from_components(F.lit(0.0), F.lit(-3.0))
    assert (value(speed), value(direction)) == (3.0, 360.0)
    u, v = physics.components_from_wind(F.lit(2.0), F.lit(90.0))
    assert (value(u), value(v)) == pytest.approx((-2.0, 0.0), abs=1e-12)
    assert value(physics.angle_between(F.lit(350.0), F.lit(10.0))) == 20
    lon, lat = physics.rotate_pole(F.lit(12.0), F.lit(34.0), 18.0, 39.25, True)
    back = physics.rotate_pole(lon, lat, 18.0, 39.25, False)
    assert (value(back[0]), value(back[1])) == pytest.approx((12.0, 34.0))


def test_mapping_onto_itself_changes_nothing(spark):
    rng = np.random.default_rng(2)
    df = _daily(spark, rng.normal(size=730).round(3).tolist())
    for group in ("doy", "month", "all"):
        factors = quantile_mapping.train(df, df, "v", 5, "+", group, 10)
        assert factors.filter("factor <> 0").count() == 0
        moved = quantile_mapping.predict(df, factors, "v", 5, "+", group)
        assert moved.filter("adjusted <> v").count() == 0 and moved.count() == 730


def test_nearest_node_is_the_nearest(spark):
    nq = 7
    marks = quantile_mapping.nodes(nq)
    ranks = [k / 97 for k in range(1, 98)]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in ranks], "p double").select(quantile_mapping.nearest_node(F.col("p"), nq)).collect()]
    for p, node in zip(ranks, got):
        assert abs(marks[node] - p) <= min(abs(m - p) for m in marks) + 1e-12


def test_whole_adjustment(spark):
    rng = np.random.default_rng(3)
    ref = _daily(spark, (rng.gamma(2, 3, 1095) + 1).tolist())
    sim = _daily(spark, (rng.gamma(2, 3, 1095) * 1.5 + 1).tolist())
    out = quantile_mapping.adjust(ref, sim, "v", True, nq=10, window=30)
    mean = lambda df, c: df.agg(F.avg(c)).first()[0]
    assert abs(mean(out, "adjusted") - mean(ref, "v")) < abs(mean(sim, "v") - mean(ref, "v")) / 3


def test_padding(spark):
    df = _daily(spark, [float(k % 50) for k in range(365)])
    factors = quantile_mapping.train(df, df.withColumn("v", F.col("v") + 1), "v", 4)
    padded = quantile_mapping.pad_quantiles(quantile_mapping.pad_cyclic(factors), 4)
    assert padded.select("grp").distinct().count() == 367 and padded.select("node").distinct().count() == 8


def test_gaps_in_time_and_space(spark):
    filled = resample.fill_gaps(_daily(spark, [None, 1.0, None, None, 4.0, None]), "v")
    assert [r.v for r in filled.orderBy("date").collect()] == [None, 1.0, 2.0, 3.0, 4.0, None]
    rows = [(2000, float(x), float(y), None if (x, y) == (1, 1) else float(x + y)) for x in range(3) for y in range(3)]
    got = grid.fill_in_space(spark.createDataFrame(rows, "year int, lon double, lat double, v double"), "v").filter("lon = 1 and lat = 1").first().v
    assert got == 2.0


def test_polynomial(spark):
    xs = range(1990, 2011)
    df = spark.createDataFrame([("a", x, 2.0 * (x - 2000) ** 2 - (x - 2000) + 5) for x in xs], "k string, year int, v double")
    row = ensemble.polynomial(df, "v", ("k",), 2).first()
    assert row.coefficients == pytest.approx([2.0, -1.0, 5.0], abs=1e-6)
    assert spark.createDataFrame([row]).select(ensemble.evaluate_polynomial("coefficients", F.lit(3.0))).first()[0] == pytest.approx(20.0)


def test_drought_code_recursion(spark):
    rng = np.random.default_rng(4)
    t, r = rng.normal(15, 5, 400), rng.gamma(0.3, 8, 400)
    day = [date(2001, 6, 1) + timedelta(days=k) for k in range(400)]
    df = spark.createDataFrame([("a", d, float(x), float(y), 45.0) for d, x, y in zip(day, t, r)], "location_id string, date date, tas double, pr double, lat double")
    code, by_year = indices.DROUGHT_START, {}
    for d, x, y in zip(day, t, r):
        code = indices.drought_step(code, x, y, indices._NORTH[d.month - 1])
        by_year.setdefault(d.year, []).append(code)
    got = {r.year: r.value for r in indices.drought_code(df).collect()}
    assert got == pytest.approx({y: float(np.mean(v)) for y, v in by_year.items()})


def test_control_point_and_mask(spark):
    cells = spark.createDataFrame([(k, float(k % 3), float(k // 3)) for k in range(9)], "location_id int, lon double, lat double")
    assert [r.location_id for r in select.control_point(cells, cells).collect()] == [4]
    masked = select.apply_mask(cells.withColumn("v", F.lit(1.0)), cells.filter("location_id < 4"), "v")
    assert masked.filter("v is null").count() == 5


def test_station_csv(spark, tmp_path):
    (tmp_path / "dakar.csv").write_text("annees;mois;jours;pr\n2000;2;29;1.5\n2000;2;30;2.0\n2001;1;1;NaN\n")
    df = tables.read_station_csv(spark, str(tmp_path), ("pr",), ";")
    assert sorted((r.station_id, str(r.date), r.pr) for r in df.collect()) == [("dakar", "2000-02-29", 1.5), ("dakar", "2001-01-01", None)]


def test_cube_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("pr", "ref", "1", 0.0, 0.0, date(2000, 1, 1), 1.0), ("pr", "x_rcp26", "1", 0.0, 0.0, date(2000, 1, 1), float("nan"))], model.DAILY)
    tables.write_cube(df, str(tmp_path / "cube"))
    back = tables.read_daily(spark, str(tmp_path / "cube"))
    assert back.filter("sim_code = 'x_rcp26'").first().value is None and back.count() == 2
    assert [r.sim_code for r in tables.order_simulations(back).collect()] == ["ref", "x_rcp26"]


def test_configuration():
    c = config.parse("[a]\nreference_period = [1981, 2010]\nhorizons = [[2021, 2050], [1981, 2010]]\nscenarios = ['rcp26', 'rcp45']\nvariables = pr\n[b]\nnq = 20\nother = x\n")
    assert c.all_horizons == ((1981, 2010), (2021, 2050)) and c.variables == ("pr",) and c.nq == 20 and c.options == {"b.other": "x"}


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    source, out = tmp_path / "events", str(tmp_path / "out")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(3).write.parquet(str(source))
    query = aggregates.write_daily(aggregates.daily(aggregates.read_events(spark, str(source))), out, str(tmp_path / "checkpoint"))
    query.awaitTermination()
    got = {(r.event_type, str(r.date)): round(r.sum, 6) for r in spark.read.parquet(out).collect()}
    # a day is closed once the watermark, two days before the latest event, has reached its end
    closed = F.date_add(F.col("date"), 1).cast("timestamp") <= F.lit(events.agg(F.max("ts")).first()[0]) - F.expr("interval 2 days")
    batch = events.groupBy("event_type", F.col("ts").cast("date").alias("date")).agg(F.sum("value").alias("sum"))
    assert got == {(r.event_type, str(r.date)): round(r.sum, 6) for r in batch.filter(closed).collect()}
    days = spark.read.parquet(out)
    want = {r.event_type: r.n for r in days.filter("sum >= 50").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {r.event_type: r.wet_days for r in aggregates.wet_day_counts(days, 50.0).filter("wet_days > 0").collect()} == want and want
    counts = aggregates.wet_day_counts(aggregates.read_written_days(spark, out), 50.0)
    counts.writeStream.outputMode("complete").format("memory").queryName("wet_days_of_stream").option("checkpointLocation", str(tmp_path / "counts")).trigger(availableNow=True).start().awaitTermination()
    assert {r.event_type: r.wet_days for r in spark.table("wet_days_of_stream").filter("wet_days > 0").collect()} == want


def test_clusters_part_what_is_apart(spark):
    rng = np.random.default_rng(5)
    rows = [(f"s{k}", float(v + 100 * (k % 2)), float(w)) for k, (v, w) in enumerate(rng.normal(size=(20, 2)))]
    found = {r.sim_code: r.cluster for r in ensemble.clusters(spark.createDataFrame(rows, "sim_code string, mean double, std double"), ["mean", "std"], 2).collect()}
    assert len({found[f"s{k}"] for k in range(0, 20, 2)}) == 1 and found["s0"] != found["s1"]


def _best_split(points):
    """Of all splits of the points in two the one that spreads least, of equal ones the least as a number; clusters by their first mean."""
    n, best = len(points), None
    for m in range(1, 2 ** (n - 1)):
        sides = [[p for k, p in enumerate(points) if m >> k & 1 == g] for g in (0, 1)]
        means = [np.mean(s, axis=0) for s in sides]
        ss = sum(((np.array(s) - c) ** 2).sum() for s, c in zip(sides, means))
        if best is None or ss < best[0] - 1e-9:
            best = ss, m, tuple(means[1]) < tuple(means[0])
    return [(best[1] >> k & 1) ^ best[2] for k in range(n)]


def _clusters(spark, points, order, parts):
    rows = [(f"s{k:02d}", float(points[k][0]), float(points[k][1])) for k in order]
    found = ensemble.clusters(spark.createDataFrame(spark.sparkContext.parallelize(rows, parts), "sim_code string, mean double, std double"), ["mean", "std"], 2)
    return [r.cluster for r in sorted(found.collect())]


def test_two_clusters_spread_least_in_any_order_of_rows(spark):
    rng = np.random.default_rng(8)
    points = [(14602.737, 2486.688), (14534.88, 2345.908), (14597.554, 2461.394), (14478.509, 2418.893), (14643.297, 2463.613), (14574.057, 2400.229)]
    assert {tuple(_clusters(spark, points, rng.permutation(6), parts)) for parts in (1, 2, 3, 6)} == {(1, 0, 1, 0, 1, 0)}


@pytest.mark.parametrize("points", [
    [(0, 0), (1, 0), (2, 0)],  # two splits are equal
    [(0, 0), (0, 1), (1, 0), (1, 1)],
    [(0, 3), (5, 3), (0, 3), (5, 3), (5, 3)],
    [(2, 0), (2, 9), (2, 1), (2, 8)],  # equal first means
    [(k, 2 * k) for k in (0, 7, 1, 9, 3, 8)],
    [(1, 1), (1, 1), (1, 1)],
    [(4, 4), (1, 1)],
    *(np.random.default_rng(k).normal(size=(9, 2)) * (1, 10**k) for k in range(3)),
    *(np.random.default_rng(k).integers(0, 6, size=(9, 2)) for k in range(3)),
])
def test_two_clusters_against_all_splits(spark, points):
    assert _clusters(spark, points, range(len(points)), 2) == _best_split(points)


def test_two_clusters_of_one_feature_and_other_columns(spark):
    rows = [("a", 7.0, None), ("b", 0.0, 1), ("c", 1.0, 2), ("d", 3.0, 3)]
    found = ensemble.clusters(spark.createDataFrame(rows, "sim_code string, mean double, n int"), ["mean"], 2)
    assert found.columns == ["sim_code", "mean", "n", "cluster"]
    assert sorted(tuple(r) for r in found.collect()) == [("a", 7.0, None, 1), ("b", 0.0, 1, 0), ("c", 1.0, 2, 0), ("d", 3.0, 3, 0)]
    assert ensemble.clusters(spark.createDataFrame(rows[:1], "sim_code string, mean double, n int"), ["mean"], 2).collect() == []
    with pytest.raises(Exception, match="missing value"):
        ensemble.clusters(spark.createDataFrame([("a", 1.0), ("b", float("nan"))], "sim_code string, mean double"), ["mean"], 2).collect()


def test_rotated_grid_keeps_linear_fields(spark):
    cells = spark.createDataFrame([(5 * x + y, float(x), float(y)) for x in range(5) for y in range(5)], "location_id int, rlon double, rlat double")
    plain = grid.unrotate(cells, 10.0, 80.0)
    points = [(1, 0.0, 0.0), (2, 1.25, 3.5), (3, 3.9, 0.1), (4, 4.5, 1.0)]
    turned = spark.createDataFrame(points, "location_id int, rlon double, rlat double")
    targets = grid.unrotate(turned, 10.0, 80.0).select(F.col("location_id").alias("target_id"), "lon", "lat")
    weights = grid.rotated_weights(targets, plain.select("location_id", "rlon", "rlat"), 10.0, 80.0)
    field = cells.select("location_id", F.lit("2000-01-01").cast("date").alias("date"), (3 * F.col("rlon") - 2 * F.col("rlat") + 1).alias("v"))
    got = {r.target_id: r.v for r in grid.regrid(field, weights, "v").collect()}
    want = {k: 3 * x - 2 * y + 1 for k, x, y in points if 0 <= x <= 4 and 0 <= y <= 4}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], abs=1e-6) for k in want)
    own = grid.rotated_weights(plain.select(F.col("location_id").alias("target_id"), "lon", "lat"), plain.select("location_id", "rlon", "rlat"), 10.0, 80.0)
    assert sorted((r.target_id, r.location_id) for r in own.collect()) == [(k, k) for k in range(25)]


@pytest.mark.parametrize("away", [0.0, 177.5])
def test_bent_grids(spark, away):
    """Places are found again in a grid of any quads, also across the 180th meridian; each target once, none outside."""
    rng = np.random.default_rng(4)
    n = 7
    lon = away + np.arange(n)[:, None] * 0.9 + 0.15 * rng.normal(size=(n, n)) + 0.2 * np.arange(n)
    lat = 40 + np.arange(n) * 0.8 + 0.1 * rng.normal(size=(n, n)) - 0.1 * np.arange(n)[:, None]
    wrap = lambda x: (x + 180) % 360 - 180
    cells = spark.createDataFrame([(n * i + j, i, j, float(wrap(lon[i, j])), float(lat[i, j])) for i in range(n) for j in range(n)], "location_id int, i int, j int, lon double, lat double")
    places = [(float(rng.integers(0, n - 1)), float(rng.integers(0, n - 1)), *rng.random(2)) for _ in range(200)]
    places += [(i, j, u, v) for i in (0, 2, 5) for j in (0, 3, 5) for u, v in ((0, 0), (1, 1), (0.5, 0), (1, 0.25))]
    rows, want = [], {}
    for k, (i, j, u, v) in enumerate(places):
        i, j = int(i), int(j)
        w = {(i, j): (1 - u) * (1 - v), (i + 1, j): u * (1 - v), (i, j + 1): (1 - u) * v, (i + 1, j + 1): u * v}
        rows.append((k, float(wrap(sum(x * lon[c] for c, x in w.items()))), float(sum(x * lat[c] for c, x in w.items()))))
        want |= {(k, n * a + b): x for (a, b), x in w.items() if x > 1e-9}
    rows += [(999, float(wrap(away - 3)), 42.0), (998, float(wrap(away + 3)), 55.0)]
    for size in (0.5, 5.0, 400.0):
        found = grid.curvilinear_weights(spark.createDataFrame(rows, "target_id int, lon double, lat double"), cells, size).collect()
        got = {(r.target_id, r.location_id): r.weight for r in found}
        assert len(got) == len(found) and set(got) == set(want) and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    holes = grid.curvilinear_weights(spark.createDataFrame(rows, "target_id int, lon double, lat double"), cells.filter("location_id <> 8"), 1.0)
    assert 8 not in {r.location_id for r in holes.collect()} and holes.count() > 0


def test_gaps_do_not_spread(spark):
    cells = spark.createDataFrame([(4 * y + x, 0.1 * x, 0.1 * y) for x in range(4) for y in range(4)], "location_id int, lon double, lat double")
    targets = cells.select(F.col("location_id").alias("target_id"), "lon", "lat")
    weights = grid.bilinear_weights(targets, cells)
    assert weights.count() == 16 and weights.filter("weight <> 1").count() == 0
    field = cells.select("location_id", F.lit(1).alias("date"), F.when(F.col("location_id") != 10, F.col("lon")).alias("v"))
    got = {r.target_id: r.v for r in grid.regrid(field, weights, "v").collect()}
    assert set(got) == set(range(16)) and [k for k, v in got.items() if v is None] == [10]
    line = cells.filter("lat = 0")
    assert {r.target_id for r in grid.bilinear_weights(targets, line).collect()} == {0, 1, 2, 3}
    assert grid.bilinear_weights(targets, cells.limit(0)).count() == 0


def test_each_simulation_has_its_own_season(spark):
    rows = [("a", c, y, 100, 200) for c in (1, 2) for y in (1, 2)] + [("b", c, y, 300, 50) for c in (1, 2) for y in (1, 2)]
    both = spark.createDataFrame(rows, "sim_code string, location_id int, year int, s int, e int")
    found = rainseason.length(both.select("sim_code", "location_id", "year", F.col("s").alias("value")), both.select("sim_code", "location_id", "year", F.col("e").alias("value")), ("sim_code", "location_id"))
    assert {(r.sim_code, r.year, r.value) for r in found.collect()} == {("a", 1, 101), ("a", 2, 101), ("b", 1, 116), ("b", 2, None)}


def test_index_by_name_needs_its_variables(spark):
    from isohyet.operators import workflow

    df = _daily(spark, [1.0, 5.0, 30.0], name="pr").withColumn("sim_code", F.lit("a_rcp26"))
    assert workflow.run_index("wetdays", df, "50p", reference=df).first().value == 2.0
    with pytest.raises(ValueError):
        workflow.run_index("txg", df)


def test_stored_results_are_built_once(spark, tmp_path):
    from isohyet.operators import workflow

    calls = []
    build = lambda: calls.append(1) or spark.range(3)
    for force in (False, False, True):
        assert workflow.made(spark, str(tmp_path / "x"), build, force).count() == 3
    assert len(calls) == 2


def test_noise_is_one_draw_a_step(spark):
    df = spark.range(400).selectExpr("concat('s', id % 2) as sim_code", "cast(id div 40 as int) as location_id", "date_add(date'2001-01-01', cast(id % 40 as int)) as date", "1.0 as pr")
    noisy = lambda x: {(r.sim_code, r.location_id, r.date): r.pr - 1 for r in quantile_mapping.preprocess(x, "pr", True, 0.5).collect()}
    found = noisy(df)
    assert found == noisy(df.repartition(7)) and all(0 <= v < 0.5 for v in found.values())
    by_step = {}
    for (sim, _, day), v in found.items():
        by_step.setdefault((sim, day), set()).add(v)
    assert all(len(v) == 1 for v in by_step.values()) and len({next(iter(v)) for v in by_step.values()}) == len(by_step)


def test_detrended_mapping_puts_the_trend_back(spark):
    days = [date(2001, 1, 1) + timedelta(days=k) for k in range(730)]
    rng = np.random.default_rng(1)
    flat = rng.normal(0, 1, 730)
    sim = spark.createDataFrame([(1, d, float(v + 0.01 * k + 3)) for k, (d, v) in enumerate(zip(days, flat))], "location_id int, date date, tas double")
    ref = spark.createDataFrame([(1, d, float(v)) for d, v in zip(days, flat)], "location_id int, date date, tas double")
    factors = quantile_mapping.train(ref, sim, "tas", 5, "+", "all", detrend=True)
    found = [r.adjusted for r in quantile_mapping.predict_detrended(sim, factors, "tas", 5, "+", "all").orderBy("date").collect()]
    slope = np.polyfit(np.arange(730), found, 1)[0]
    assert abs(np.mean(found) - flat.mean()) < 0.1 and abs(slope - 0.01) < 0.001


def test_bias_parameters_are_kept_up(spark):
    known = spark.createDataFrame([("a", "pr", 0.5), ("b", "pr", None)], "sim_code string, var string, bias_err double")
    wanted = spark.createDataFrame([("a", "pr", None), ("c", "pr", None)], "sim_code string, var string, bias_err double")
    grown = quantile_mapping.update_parameters(known, wanted)
    assert {tuple(r) for r in grown.collect()} == {("a", "pr", 0.5), ("b", "pr", None), ("c", "pr", None)}
    errors = spark.createDataFrame([("b", "pr", 0.25)], "sim_code string, var string, bias_err double")
    assert {tuple(r) for r in quantile_mapping.write_errors(grown, errors).collect()} == {("a", "pr", 0.5), ("b", "pr", 0.25), ("c", "pr", None)}


def test_hourly_records_are_seen_and_averaged(spark):
    hours = spark.range(48).selectExpr("'s' as sim_code", "1 as location_id", "timestamp'2001-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id as int)) as ts", "cast(id as double) as value")
    assert workflow.is_hourly(hours) and not workflow.is_hourly(hours.filter("hour(ts) = 3")) and not workflow.is_hourly(hours.limit(0))
    weights = spark.createDataFrame([(9, 1, 1.0)], "target_id long, location_id int, weight double")
    assert {str(r.date): r.value for r in workflow.interpolate(hours, weights).collect()} == {"2001-01-01": 11.5, "2001-01-02": 35.5}


def test_regular_targets_and_land(spark):
    cells = spark.createDataFrame([(0, 0.0, 10.0, 0.0), (1, 1.1, 10.4, 0.3), (2, 2.3, 11.0, 1.0)], "location_id int, lon double, lat double, sftlf double")
    found = sorted((r.target_id, round(r.lon, 6), round(r.lat, 6)) for r in grid.regular_targets(cells, 1.0, 0.5).collect())
    assert found == [(k, round(0.15 + k % 3, 6), round(10.0 + 0.5 * (k // 3), 6)) for k in range(9)]
    assert [r.location_id for r in grid.land_cells(cells).collect()] == [1, 2]
    daily = spark.createDataFrame([(0, 1.0), (0, 1.0), (1, 1.0), (1, 2.0), (2, None)], "location_id int, value double")
    assert [r.location_id for r in grid.land_cells(cells.drop("sftlf"), daily).collect()] == [1]
    assert grid.has_rotated_axes(cells.withColumnRenamed("lon", "rlon").withColumnRenamed("lat", "rlat")) and not grid.has_rotated_axes(cells)


def test_index_maps_are_filled_then_masked(spark):
    cells = spark.createDataFrame([(k, float(k % 3), float(k // 3)) for k in range(9)], "location_id int, lon double, lat double")
    found = spark.createDataFrame([("txx", "s", k, 2001, None if k == 4 else float(k)) for k in range(9)], "idx string, sim_code string, location_id int, year int, value double")
    got = {r.location_id: (str(r.date), r.value) for r in annual.postprocess(found, cells, cells.filter("location_id <> 8")).collect()}
    assert got[4] == ("2001-01-01", 4.0) and got[8] == ("2001-01-01", None) and got[7][1] == 7.0 and len(got) == 9


def test_prepared_days(spark):
    df = spark.createDataFrame([(s, 1, date(y, m, d), 280.15) for s in ("ref", "x") for y, m, d in ((2000, 2, 29), (2000, 3, 1), (2003, 1, 1))], "sim_code string, location_id int, date date, tasmax double")
    got = sorted((r.sim_code, str(r.date), round(r.tasmax, 6)) for r in annual.prepare(df, True, "ref", (1999, 2001)).collect())
    assert got == [("ref", "2000-03-01", 7.0), ("x", "2000-02-29", 7.0), ("x", "2000-03-01", 7.0), ("x", "2003-01-01", 7.0)]
    with pytest.raises(ValueError):
        annual.indices_of([("nothing",)], df)


def test_quantiles_by_counts(spark):
    rng = np.random.default_rng(2)
    values = [None if rng.random() < 0.1 else float(v) for v in rng.integers(0, 40, 997)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    known = [v for v in values if v is not None]
    for q in (0.0, 0.31, 0.5, 0.9, 1.0):
        assert indices.reference_quantile(df, "v", q, 6).first()[0] == pytest.approx(np.quantile(known, q))


def test_small_helpers(spark, tmp_path):
    df = spark.createDataFrame([(1, 2003, 1.0), (1, 2001, 2.0), (2, 2002, 3.0)], "location_id int, year int, value double")
    assert sorted((r.location_id, r.year, r.position) for r in indices.ranked_years(df).collect()) == [(1, 2001, 0), (1, 2003, 1), (2, 2002, 0)]
    days = spark.createDataFrame([(1, date(2001, 1, k), float(k)) for k in range(1, 6)], "location_id int, date date, v double")
    assert [r.window for r in quantile_mapping.moving_window_rows(days, "v", 3).orderBy("date").collect()] == [[1.0, 2.0], [1.0, 2.0, 3.0], [2.0, 3.0, 4.0], [3.0, 4.0, 5.0], [4.0, 5.0]]
    tables.write_csv(df, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 3
    sims = spark.createDataFrame([("b",), ("ref",), ("a",)], "sim_code string")
    assert [r.sim_code for r in tables.order_simulations(sims).collect()] == ["ref", "a", "b"]


def test_several_variables_are_adjusted_in_one_job(spark):
    from isohyet.operators import workflow

    days = spark.range(730).selectExpr("cast(id % 2 as int) as location_id", "date_add(date'2001-01-01', cast(id div 2 as int)) as date", "1.0 + id * 37 % 11 as value")
    both = lambda df: df.withColumn("var", F.explode(F.array(F.lit("pr"), F.lit("tas"))))
    ref, sims = both(days), both(days.select(F.lit("a_rcp26").alias("sim_code"), "location_id", "date", (F.col("value") * 2).alias("value")))
    found = workflow.scenarios(ref, sims, ("pr", "tas"), nq=4, window=10)
    for var in ("pr", "tas"):
        alone = workflow.scenario(ref.filter(ref["var"] == var).drop("var"), sims.filter(sims["var"] == var).drop("var"), "value", var, 4, 10)
        want = sorted((r.location_id, r.date, round(r.adjusted, 6)) for r in alone.collect())
        assert len(want) == 730 and sorted((r.location_id, r.date, round(r.adjusted, 6)) for r in found.filter(found["var"] == var).collect()) == want
    with pytest.raises(ValueError):
        workflow.scenarios(ref, sims, ())


def test_broken_writes_are_built_anew(spark, tmp_path):
    from isohyet.operators import workflow

    path = tmp_path / "cube"
    path.mkdir()
    (path / "part-00000.parquet").write_bytes(b"PAR1 cut off")
    assert workflow.made(spark, str(path), lambda: spark.range(4)).count() == 4
    files = [r.path.rsplit("/", 1)[1] for r in tables.list_files(spark, str(tmp_path)).collect()]
    assert files and "part-00000.parquet" not in files
    assert tables.list_files(spark, str(tmp_path), "*.csv").count() == 0


def test_sources_in_canonical_columns(spark):
    df = spark.createDataFrame([("a", 1, "2001-02-03", 2, 9.5)], "`Sim.Code` string, place int, day string, tas int, height double")
    found = model.standardise(df, {"Sim.Code": "sim_code", "place": "location_id", "day": "date", "tas": "value"})
    assert found.schema.names == model.DAILY.names and [f.dataType for f in found.schema] == [f.dataType for f in model.DAILY]
    assert tuple(found.first()) == (None, "a", "1", None, None, date(2001, 2, 3), 2.0)
    with pytest.raises(ValueError):
        model.standardise(df, {"tas": "value", "height": "value"})
