"""Every query that has SQL gives the rows of that SQL."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from isohyet.plans import catalog

def _rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)

    def plain(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return None
        return f"{v:.6f}" if isinstance(v, float) else v

    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query(spark, duck, sf_dir, name):
    got = catalog.QUERIES[name](spark, sf_dir)
    want = duck.sql(catalog.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows(want.columns, want.fetchall())


_ITEMS = {
    "one simulation": "VALUES (1, 'F', 'A', 5)",
    "equal means": "VALUES (1, 'F', 'A', 8), (1, 'F', 'N', 4), (2, 'F', 'N', 4), (1, 'O', 'A', 4), (2, 'O', 'A', 4)",
    "equal simulations": "VALUES (1, 'F', 'A', 8), (2, 'F', 'N', 8), (1, 'O', 'N', 8)",
}


@pytest.mark.parametrize("items", _ITEMS)
def test_clusters_of_few_items(spark, tmp_path, items):
    con = duckdb.connect()
    con.execute(f"create table lineitem as select s::bigint as l_suppkey, date '1997-01-01' + interval (s) day as l_shipdate, a as l_linestatus, b as l_returnflag, q::double as l_quantity from ({_ITEMS[items]}) v(s, a, b, q)")
    con.execute("create table supplier as select k::bigint as s_suppkey, k::int as s_nationkey from range(4) t(k)")
    con.execute("create table nation as select k::int as n_nationkey from range(4) t(k)")
    for name in ("lineitem", "supplier", "nation"):
        con.execute(f"copy {name} to '{tmp_path / name}.parquet'")
    want = con.sql(catalog.ORACLE_SQL["clusters"]).fetchall()
    assert sorted(tuple(r) for r in catalog.QUERIES["clusters"](spark, str(tmp_path)).collect()) == sorted(want)


def test_registry():
    assert set(catalog.ORACLE_SQL) <= set(catalog.QUERIES)
    assert len(catalog.QUERIES) > 100
    assert set(catalog.QUERIES) - set(catalog.ORACLE_SQL) == {"clusters_of_all"}


def test_entry(spark):
    import __spark_entry__

    found = __spark_entry__.entry(spark)
    assert found.columns == ["location_id", "year", "value"] and found.count() == 25 * 7  # cells by years
