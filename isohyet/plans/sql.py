"""Common table expressions of the cubes, in the SQL that checks the queries."""

from __future__ import annotations

_PARTS = {
    "ship": "SELECT s.s_nationkey::INT AS location_id, l.l_shipdate::DATE AS date, l.* FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey",
    "cells": "SELECT n_nationkey::INT AS location_id, (n_nationkey % 5)::DOUBLE AS lon, (n_nationkey // 5)::DOUBLE AS lat FROM nation",
    "days": "SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY))::DATE AS date",
    "pr": "SELECT c.location_id, c.lon, c.lat, d.date, coalesce(x.pr, 0)::DOUBLE AS pr FROM cells c CROSS JOIN days d LEFT JOIN (SELECT location_id, date, sum(l_quantity) AS pr FROM ship GROUP BY ALL) x ON x.location_id = c.location_id AND x.date = d.date",
    "tas": "SELECT c.location_id, c.lon, c.lat, d.date, x.tasmax, x.tasmin FROM cells c CROSS JOIN days d LEFT JOIN (SELECT location_id, date, 15 + max(l_quantity) / 2 AS tasmax, min(l_quantity) / 2 AS tasmin FROM ship GROUP BY ALL) x ON x.location_id = c.location_id AND x.date = d.date",
    "wind": "SELECT location_id, date, (sum(l_linenumber)::BIGINT % 13 - 6)::DOUBLE AS u, (sum(l_partkey)::BIGINT % 13 - 6)::DOUBLE AS v FROM ship GROUP BY ALL",
    "simship": "SELECT *, l_linestatus || '_' || l_returnflag || '_' || CASE l_returnflag WHEN 'A' THEN 'rcp26' WHEN 'N' THEN 'rcp45' ELSE 'rcp85' END AS sim_code FROM ship",
    "sim": "SELECT s.sim_code, split_part(s.sim_code, '_', 3) AS rcp, c.location_id, c.lon, c.lat, d.date, coalesce(x.pr, 0)::DOUBLE AS pr FROM (SELECT DISTINCT sim_code FROM simship) s CROSS JOIN cells c CROSS JOIN days d LEFT JOIN (SELECT sim_code, location_id, date, sum(l_quantity) AS pr FROM simship GROUP BY ALL) x ON x.sim_code = s.sim_code AND x.location_id = c.location_id AND x.date = d.date",
    "ref": "SELECT c.location_id, c.lon, c.lat, d.date, coalesce(x.pr, 0)::DOUBLE AS pr FROM cells c CROSS JOIN days d LEFT JOIN (SELECT s.location_id, o.o_orderdate::DATE AS date, sum(l_quantity) AS pr FROM ship s JOIN orders o ON s.l_orderkey = o.o_orderkey GROUP BY ALL) x ON x.location_id = c.location_id AND x.date = d.date",
    "obs": "SELECT printf('st%02d', c.c_nationkey::INT) AS station_id, o.o_orderdate::DATE AS date, count(*)::DOUBLE AS value FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY ALL",
    "hour": "SELECT event_type AS location_id, date_trunc('hour', ts) AS ts, count(*)::DOUBLE AS value FROM events GROUP BY ALL",
    "simyear": "SELECT sim_code, rcp, location_id, year(date)::INT AS year, sum(pr) AS pr FROM sim GROUP BY ALL",
    "refyear": "SELECT location_id, year(date)::INT AS year, sum(pr) AS pr FROM ref GROUP BY ALL",
}
_NEEDS = {"pr": ("ship", "cells", "days"), "tas": ("ship", "cells", "days"), "wind": ("ship",), "simship": ("ship",), "sim": ("simship", "cells", "days"), "ref": ("ship", "cells", "days"), "simyear": ("sim",), "refyear": ("ref",)}


def sql(needs: str, query: str, **own: str) -> str:
    """The query after the named cubes and its own expressions, which may use the cubes."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in _NEEDS.get(name, ()):
            add(n)
        if name not in order:
            order.append(name)

    for name in needs.split():
        add(name)
    parts = [f"{n} AS ({_PARTS[n]})" for n in order] + [f"{n} AS ({q})" for n, q in own.items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + query


def runs_sql(cube: str, condition: str, keys: str = "location_id") -> str:
    """Runs of days that meet a condition, cut at the new year: keys, year, length."""
    return f"SELECT {keys}, year, count(*)::BIGINT AS length FROM (SELECT {keys}, year(date)::INT AS year, ok, row_number() OVER (PARTITION BY {keys}, year(date) ORDER BY date) - row_number() OVER (PARTITION BY {keys}, year(date), ok ORDER BY date) AS g FROM (SELECT *, coalesce({condition}, false) AS ok FROM {cube})) WHERE ok GROUP BY {keys}, year, g"
