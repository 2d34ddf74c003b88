"""Regions, as-of and interval joins against brute force; plans without nested loops."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from isohyet.operators import joins, runs, select


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_regions(spark):
    rng = random.Random(1)
    cells = [(k, rng.uniform(0, 10), rng.uniform(0, 10)) for k in range(400)] + [(1000 + 10 * x + y, float(x), float(y)) for x in range(10) for y in range(10)]
    rings = {"a": [[(1, 1), (6, 1), (6, 7), (1, 7)], [(2, 2), (4, 2), (4, 4), (2, 4)]], "b": [[(6, 1), (9, 1), (9, 7), (6, 7)]], "c": [[(0.5, 0.2), (9.7, 5.1), (3.3, 9.9)]], "flat": [[(1, 3), (5, 3), (8, 3)]]}
    edges = [(n, *map(float, p), *map(float, q)) for n, rs in rings.items() for r in rs for p, q in zip(r, [*r[1:], r[0]], strict=True)]
    want = set()
    for name in rings:
        for k, x, y in cells:
            if sum((y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 for n, x1, y1, x2, y2 in edges if n == name) % 2:
                want.add((name, k))
    table, sides = spark.createDataFrame(cells, "location_id int, lon double, lat double"), spark.createDataFrame(edges, "region string, x1 double, y1 double, x2 double, y2 double")
    found = select.regions_of(table, sides)
    assert {tuple(r) for r in found.collect()} == want
    assert not {k for n, k in want if n == "a"} & {k for n, k in want if n == "b"}  # a cell on the border of two is in one
    assert "NestedLoop" not in _plan(found) and "Cartesian" not in _plan(found)
    one = table.filter("location_id = 1055")
    assert [tuple(r) for r in select.regions_of(one, sides).orderBy("region").collect()] == sorted(x for x in want if x[1] == 1055)
    assert select.regions_of(table.limit(0), sides).count() == 0
    values = table.select("location_id", F.lit(1).alias("date"), F.col("lon").alias("v"))
    got = {r.region: r.v for r in select.region_means(values, found, "v").collect()}
    inside = {n: [x for k, x, _ in cells if (n, k) in want] for n in ("a", "b", "c")}
    assert set(got) == set(inside) and all(abs(got[n] - sum(x) / len(x)) < 1e-9 for n, x in inside.items())


def test_as_of(spark):
    rng = random.Random(2)
    base = datetime(2000, 1, 1)
    key = lambda: rng.choice(["hot"] * 6 + ["a", "b", None])
    left = [(k, key(), base + timedelta(hours=rng.randrange(24 * 300)) if rng.random() < 0.97 else None, "x") for k in range(600)]
    right = [(key(), base + timedelta(hours=rng.randrange(24 * 300)) if rng.random() < 0.97 else None, rng.randrange(9), None if rng.random() < 0.2 else k) for k in range(150)]
    right += [(right[0][0], right[0][1], 3, 777), (right[0][0], right[0][1], 10, 778)]  # ties
    a, b = spark.createDataFrame(left, "id int, key string, at timestamp, side string"), spark.createDataFrame(right, "key string, at timestamp, rank int, value int")
    for days, tolerance in ((30, None), (1, None), (1000, 2.5), (3, 0.0)):
        found = joins.as_of(a, b, ["key"], "at", ["value", "rank"], ties=["rank", "value"], tolerance_days=tolerance, bucket_days=days)
        want = {}
        for k, name, at, _ in left:
            fit = [r for r in right if at is not None and r[1] is not None and r[0] == name and r[1] <= at]
            best = max(fit, key=lambda r: (r[1], r[2], -1 if r[3] is None else r[3]), default=None)
            if best and tolerance is not None and at - best[1] > timedelta(days=tolerance):
                best = None
            want[k] = (best[3], best[2]) if best else (None, None)
        got = found.collect()
        assert found.columns == ["id", "key", "at", "side", "value", "rank"]
        assert {r.id: (r.value, r["rank"]) for r in got} == want and len(got) == len(left) and "NestedLoop" not in _plan(found)
    assert joins.as_of(a.limit(0), b, ["key"], "at", ["value"]).count() == 0
    assert joins.as_of(a, b.limit(0), ["key"], "at", ["value"]).filter("value is not null").count() == 0
    hot = joins.as_of(a, b, ["key"], "at", ["value"], bucket_days=10)
    assert hot.filter("key = 'hot'").select(joins._bucket(F.col("at"), 10)).distinct().count() > 20  # its rows are many groups


def test_overlapping(spark):
    rng = random.Random(3)
    def some(n):
        out = []
        for k in range(n):
            a = date(2000, 1, 1) + timedelta(days=rng.randrange(300))
            out.append((k, rng.choice([1, 1, 1, 2]), a, a + timedelta(days=rng.randrange(-2, 90))))
        return [*out, (n, 1, None, date(2000, 3, 1)), (n + 1, 2, date(2000, 3, 1), None)]
    left, right = some(60), some(50)
    a, b = spark.createDataFrame(left, "l int, key int, start date, end date"), spark.createDataFrame(right, "r int, key int, from date, to date")
    want = {(p[0], q[0], (min(p[3], q[3]) - max(p[2], q[2])).days + 1) for p in left for q in right if None not in (*p, *q) and p[1] == q[1] and p[2] <= p[3] and q[2] <= q[3] and p[2] <= q[3] and q[2] <= p[3]}
    for days in (1, 30, 5000):
        found = joins.overlapping(a, b, ["key"], bin_days=days)
        got = [(r.l, r.r, r.days) for r in found.collect()]
        assert len(got) == len(set(got)) and set(got) == want and "NestedLoop" not in _plan(found)


def test_spells_have_bounds(spark):
    rows = [(1, date(1999, 12, 28) + timedelta(days=k), v) for k, v in enumerate([1.0, 1.0, 0.0, 1.0, 1.0, None, 1.0])]
    found = runs.spells(spark.createDataFrame(rows, "location_id int, date date, pr double"), "pr >= 1", 1)
    assert sorted((str(r.start), str(r.end), r.length, r.year) for r in found.collect()) == [("1999-12-28", "1999-12-29", 2, 1999), ("1999-12-31", "1999-12-31", 1, 1999), ("2000-01-01", "2000-01-01", 1, 2000), ("2000-01-03", "2000-01-03", 1, 2000)]
