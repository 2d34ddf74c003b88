"""Queries of the rain season."""

from __future__ import annotations

from pyspark.sql import functions as F

from isohyet import model
from isohyet.operators import rainseason as rs
from isohyet.operators import runs
from isohyet.sources import cubes

from .catalog import query
from .sql import sql

_FIRST, _LAST = model.doy_of("03-01"), model.doy_of("12-31")
_END_FIRST, _END_LAST = model.doy_of("09-01"), model.doy_of("12-31")
START = {"wet_amount": 110.0, "wet_window": 3, "dry_threshold": 12.0, "dry_days": 4, "dry_window": 12, "first": _FIRST, "last": _LAST}
_RATE, _ETP = 35.0, 70.0
ENDS = {"max": {"op": "max", "threshold": 40.0, "window": 4, "first": _END_FIRST, "last": _END_LAST}, "sum": {"op": "sum", "threshold": 60.0, "window": 4, "first": _END_FIRST, "last": _END_LAST}, "etp": {"op": "etp", "threshold": _ETP, "window": 4, "rate": _RATE, "first": _END_FIRST, "last": _END_LAST}}

_N = "SELECT location_id, date, pr, year(date)::INT AS year, dayofyear(date)::INT AS doy, row_number() OVER (PARTITION BY location_id ORDER BY date) AS rn FROM pr"
_YEARS = "SELECT DISTINCT location_id, year FROM n"
_start = {
    "n": _N,
    "wet": "SELECT * FROM (SELECT *, sum(pr) OVER (PARTITION BY location_id ORDER BY rn ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS s3, sum(pr) OVER (PARTITION BY location_id ORDER BY rn ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING) AS s2, count(*) OVER (PARTITION BY location_id ORDER BY rn ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS c FROM n) WHERE s3 >= 110 AND c = 3 AND pr > 12",
    "opens": "SELECT location_id, rn FROM (SELECT location_id, rn, count(*) OVER w AS c, max(pr) OVER w AS m FROM n WINDOW w AS (PARTITION BY location_id ORDER BY rn ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)) WHERE c = 4 AND m < 12",
    "good": "SELECT w.* FROM (SELECT *, CASE WHEN pr >= 110 THEN 1 WHEN s2 >= 110 THEN 2 ELSE 3 END AS j FROM wet) w WHERE NOT EXISTS (SELECT 1 FROM opens o WHERE o.location_id = w.location_id AND o.rn BETWEEN w.rn + 4 - j AND w.rn + 4 - j + 6)",
    "starts": f"SELECT y.location_id, y.year, min(g.doy) FILTER (g.doy <= 365) AS value FROM ({_YEARS}) y LEFT JOIN good g ON g.location_id = y.location_id AND g.year = y.year AND g.doy BETWEEN {_FIRST} AND {_LAST} GROUP BY 1, 2",
}


def _ends_sql(op: str) -> dict[str, str]:
    if op == "etp":
        hits = f"SELECT t.*, w.w FROM c t CROSS JOIN range(2, 121) w(w) LEFT JOIN c b ON b.location_id = t.location_id AND b.rn = t.rn - w.w WHERE t.doy BETWEEN {_END_FIRST} AND {_END_LAST} AND t.rn >= w.w AND t.c - coalesce(b.c, 0) >= {_ETP}"
        first = "SELECT location_id, year, arg_min(doy, (w, doy)) AS value, arg_min(w, (w, doy)) AS w, arg_min(rn, (w, doy)) AS rn FROM hits GROUP BY 1, 2"
        near = "EXISTS (SELECT 1 FROM n WHERE n.location_id = f.location_id AND n.year = f.year AND n.rn BETWEEN f.rn - f.w AND f.rn AND n.pr > 0)"
        own = {"c": f"SELECT *, sum({_RATE} - pr) OVER (PARTITION BY location_id ORDER BY rn) AS c FROM n", "hits": hits, "firsts": first}
    else:
        dry = "max(pr) OVER w < 40" if op == "max" else "sum(pr) OVER w < 60"
        own = {"dry": f"SELECT * FROM (SELECT *, {dry} AS ok, count(*) OVER w AS c FROM n WINDOW w AS (PARTITION BY location_id ORDER BY rn ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING)) WHERE ok AND c = 4 AND doy BETWEEN {_END_FIRST} AND {_END_LAST}", "firsts": "SELECT location_id, year, min(doy) AS value, min(rn) AS rn FROM dry GROUP BY 1, 2"}
        near = "EXISTS (SELECT 1 FROM n WHERE n.location_id = f.location_id AND n.year = f.year AND n.rn BETWEEN f.rn AND f.rn + 4 AND n.pr > 0)"
    return {**own, "raw": f"SELECT y.location_id, y.year, f.value FROM ({_YEARS}) y LEFT JOIN (SELECT * FROM firsts f WHERE {near}) f ON f.location_id = y.location_id AND f.year = y.year", "ends": "SELECT r.location_id, r.year, CASE WHEN s.value IS NULL OR r.value > s.value THEN r.value END AS value FROM raw r LEFT JOIN starts s ON s.location_id = r.location_id AND s.year = r.year"}


@query(sql("pr", "SELECT location_id, year, value::INT AS value FROM starts", **_start))
def rain_season_start(spark, d):
    return rs.start(cubes.precipitation(spark, d), **START)


def _end(op):
    def run(spark, d):
        pr = cubes.precipitation(spark, d)
        return rs.reconcile(rs.end(pr, **ENDS[op]), rs.start(pr, **START))

    return run


for _op in ENDS:
    query(sql("pr", "SELECT location_id, year, value::INT AS value FROM ends", **_start, **_ends_sql(_op)), f"rain_season_end_{_op}")(_end(_op))


_PAIR = {"pair": "SELECT s.location_id, s.year, s.value AS a, e.value AS b, lead(e.value) OVER (PARTITION BY s.location_id ORDER BY s.year) AS nb FROM starts s JOIN ends e ON e.location_id = s.location_id AND e.year = s.year"}


LENGTH = "SELECT location_id, year, greatest(CASE WHEN (SELECT avg(a) <= avg(b) FROM pair) THEN b - a + 1 ELSE 365 - a + nb + 1 END, 0)::INT AS value FROM pair".replace("greatest(CASE", "CASE WHEN a IS NULL OR (CASE WHEN (SELECT avg(a) <= avg(b) FROM pair) THEN b ELSE nb END) IS NULL THEN NULL ELSE greatest(CASE").replace("END, 0)::INT", "END, 0)::INT END")
AMOUNT = "SELECT p.location_id, p.year, CASE WHEN p.a IS NULL THEN NULL WHEN m.same AND p.b IS NOT NULL THEN (SELECT floor(sum(pr)) FROM n WHERE n.location_id = p.location_id AND n.year = p.year AND n.doy BETWEEN p.a AND p.b) WHEN NOT m.same AND p.nb IS NOT NULL THEN (SELECT floor(coalesce(sum(pr) FILTER (n.doy BETWEEN p.a AND 365), 0) + coalesce(sum(pr) FILTER (n.doy <= p.nb), 0)) FROM n WHERE n.location_id = p.location_id AND n.year = p.year) END::DOUBLE AS value FROM pair p JOIN (SELECT location_id, avg(a) <= avg(b) AS same FROM pair GROUP BY 1) m ON m.location_id = p.location_id"


def season_sql(query_: str, op: str) -> str:
    return sql("pr", query_, **_start, **_ends_sql(op), **_PAIR)


@query(season_sql(LENGTH, "max"))
def rain_season_length(spark, d):
    pr = cubes.precipitation(spark, d)
    starts = rs.start(pr, **START)
    return rs.length(starts, rs.reconcile(rs.end(pr, **ENDS["max"]), starts))


@query(season_sql(AMOUNT, "max"))
def rain_season_prcptot(spark, d):
    pr = cubes.precipitation(spark, d)
    starts = rs.start(pr, **START)  # its exchanges are the same wherever it is read, and Spark makes them once
    return rs.amount(pr, starts, rs.reconcile(rs.end(pr, **ENDS["max"]), starts))


@query(season_sql("SELECT location_id, year, a::INT AS start, b::INT AS \"end\" FROM pair", "sum"))
def rain_season_chain(spark, d):
    return rs.season(cubes.precipitation(spark, d), START, ENDS["sum"]).select("location_id", "year", F.col("start"), F.col("end"))


# simulations of rcp85 have their season across the new year, the others within it
_OPEN = "pr >= 1 AND dayofyear(date) >= CASE WHEN rcp = 'rcp85' THEN 250 ELSE 60 END"
_CLOSE = "pr >= 1 AND dayofyear(date) >= CASE WHEN rcp = 'rcp85' THEN 30 ELSE 200 END"


@query(sql("sim", "SELECT p.sim_code, p.location_id, p.year, greatest(CASE WHEN m.same THEN b - a + 1 ELSE 365 - a + nb + 1 END, CASE WHEN a IS NOT NULL AND (CASE WHEN m.same THEN b ELSE nb END) IS NOT NULL THEN 0 END)::INT AS value FROM pair p JOIN (SELECT sim_code, avg(a) <= avg(b) AS same FROM pair GROUP BY 1) m ON m.sim_code = p.sim_code",
           pair=f"SELECT *, lead(b) OVER (PARTITION BY sim_code, location_id ORDER BY year) AS nb FROM (SELECT sim_code, location_id, year(date)::INT AS year, min(CASE WHEN {_OPEN} THEN dayofyear(date) END) AS a, min(CASE WHEN {_CLOSE} THEN dayofyear(date) END) AS b FROM sim GROUP BY ALL)"))
def rain_season_length_by_simulation(spark, d):
    """Lengths where some simulations' seasons cross the new year: each decides by its own means."""
    pr, keys = cubes.simulations(spark, d), ("sim_code", "location_id")
    return rs.length(runs.first_doy(pr, _OPEN, keys), runs.first_doy(pr, _CLOSE, keys), keys)
