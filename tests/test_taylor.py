"""Taylor statistics from daily cubes against plain loops."""

from __future__ import annotations

import random
from datetime import date, timedelta

import numpy as np
import pytest

from isohyet.operators import ensemble, resample

DDL = "sim_code string, location_id int, date date, v double"


def _series(rng, sim, absent=0.0):
    days = [date(1999, 1, 1) + timedelta(days=k) for k in range(800)]
    return [(sim, c, d, None if rng.random() < 0.2 else rng.uniform(0, 9)) for c in (1, 2, 3) for d in days if rng.random() >= absent]


def _closed(rows):
    """Linear between known days, which a dictionary by day holds."""
    known = sorted((r[2].toordinal(), r[3]) for r in rows if r[3] is not None)
    at = np.arange(known[0][0], known[-1][0] + 1)
    return dict(zip(map(date.fromordinal, at.tolist()), np.interp(at, *zip(*known)).tolist(), strict=True))


def _groups(rows, step, summable):
    cells = {}
    for c in sorted({r[1] for r in rows}):
        own = [r for r in rows if r[1] == c]
        cells[c] = ({r[2]: r[3] or 0.0 for r in own} if summable else _closed(own)) if step == "day" else {r[2]: r[3] for r in own}
    days = {}
    for own in cells.values():
        for d, v in own.items():
            if (d.month, d.day) != (2, 29) and d.year in (1999, 2000):
                days.setdefault(d, []).append(v)
    means = {d: np.mean([v for v in vs if v is not None]) for d, vs in days.items() if any(v is not None for v in vs)}
    out = {}
    for d, v in means.items():
        out.setdefault({"day": d.day, "month": d.month, "year": 0}[step], []).append(v)
    return {k: (sum(v) / 2 if summable else np.mean(v)) for k, v in out.items()}


@pytest.mark.parametrize(("step", "summable"), [("day", False), ("day", True), ("month", True), ("month", False), ("year", False)])
def test_taylor_of_days(spark, step, summable):
    rng = random.Random(5)
    ref, a = _series(rng, "ref"), _series(rng, "a", 0.1 if not summable else 0.0)
    short = [r for r in _series(rng, "short") if r[2] < date(1999, 1, 20)]  # lacks days of month and months
    df = spark.createDataFrame(a + short, DDL)
    found = {r.sim_code: r for r in ensemble.taylor_of_days(df, "v", spark.createDataFrame(ref, DDL).drop("sim_code"), step, summable, (1999, 2000)).collect()}
    assert set(found) == ({"ref", "a"} if step != "year" else {"ref", "a", "short"})
    p, r = (_groups(x, step, summable) for x in (a, ref))
    p, r = np.array([p[k] for k in sorted(r)]), np.array([r[k] for k in sorted(r)])
    assert found["a"].sdev == pytest.approx(p.std(), abs=1e-9) and found["ref"].sdev == pytest.approx(r.std(), abs=1e-9)
    assert found["a"].crmsd == pytest.approx((p - r).std(), abs=1e-9) and found["ref"].crmsd == 0
    assert found["ref"].ccoef == 1.0
    if step == "year":
        assert found["a"].ccoef is None or np.isnan(found["a"].ccoef)  # one value has no correlation
    else:
        assert found["a"].ccoef == pytest.approx(np.corrcoef(p, r)[0, 1])


def test_cells_places_and_nothing(spark):
    rng = random.Random(6)
    ref, a = _series(rng, "ref"), _series(rng, "a")
    df, reference = spark.createDataFrame(a, DDL), spark.createDataFrame(ref, DDL).drop("sim_code")
    cells = spark.createDataFrame([(1,), (1,), (2,)], "location_id int")
    found = ensemble.taylor_of_days(df, "v", reference, "month", cells=cells, places=2)
    want = ensemble.taylor_of_days(df.filter("location_id < 3"), "v", reference.filter("location_id < 3"), "month")
    assert sorted((r[0], *(round(x, 2) for x in r[1:])) for r in want.collect()) == sorted(map(tuple, found.collect()))
    assert ensemble.taylor_of_days(df.limit(0), "v", reference.limit(0), "day").count() == 0
    assert [r.sim_code for r in ensemble.taylor_of_days(df.limit(0), "v", reference, "day").collect()] == ["ref"]
    assert "Join" not in ensemble.taylor_of_days(df, "v", reference)._jdf.queryExecution().executedPlan().toString()


def test_fill_days(spark):
    rows = [("s", 1, date(2000, 2, 27), 1.0), ("s", 1, date(2000, 2, 28), None), ("s", 1, date(2000, 3, 2), 5.0), ("s", 2, date(2000, 1, 1), None), ("s", 3, date(2000, 1, 1), 7.0)]
    got = sorted((r.location_id, str(r.date), round(r.v, 9)) for r in resample.fill_days(spark.createDataFrame(rows, DDL), "v").collect())
    assert got == [(1, "2000-02-27", 1.0), (1, "2000-02-28", 2.0), (1, "2000-02-29", 3.0), (1, "2000-03-01", 4.0), (1, "2000-03-02", 5.0), (3, "2000-01-01", 7.0)]
