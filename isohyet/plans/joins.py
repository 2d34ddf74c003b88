"""Queries of regions and of joins by order and by overlap."""

from __future__ import annotations

from pyspark.sql import functions as F

from isohyet.operators import joins, runs, select
from isohyet.sources import cubes

from .catalog import query
from .sql import runs_sql, sql

# Two regions that share a border, the first with a hole, and a third that overlaps both
_RINGS = {"west": [[(-0.5, -0.5), (2.0, -0.5), (2.0, 4.5), (-0.5, 4.5)], [(0.5, 0.5), (1.5, 0.5), (1.5, 2.5), (0.5, 2.5)]], "east": [[(2.0, -0.5), (4.5, -0.5), (4.5, 4.5), (2.0, 4.5)]], "middle": [[(1.2, 0.4), (3.6, 1.3), (2.4, 4.2)]]}
_EDGES = [(name, *a, *b) for name, rings in _RINGS.items() for ring in rings for a, b in zip(ring, [*ring[1:], ring[0]], strict=True)]
_EDGES_SQL = "SELECT * FROM (VALUES {}) AS e(region, x1, y1, x2, y2)".format(", ".join(f"('{n}', {', '.join(f'{v}::DOUBLE' for v in x)})" for n, *x in _EDGES))
_MEMBERS_SQL = "SELECT e.region, c.location_id FROM cells c JOIN edges e ON (e.y1 > c.lat) <> (e.y2 > c.lat) AND c.lon < (e.x2 - e.x1) * (c.lat - e.y1) / CASE WHEN e.y2 <> e.y1 THEN e.y2 - e.y1 END + e.x1 GROUP BY ALL HAVING count(*) % 2 = 1"


@query(sql("cells pr", "SELECT region, strftime(date, '%Y-%m-%d') AS date, round(avg(pr), 6) AS pr FROM pr JOIN members USING (location_id) GROUP BY region, pr.date", edges=_EDGES_SQL, members=_MEMBERS_SQL))
def mean_by_region(spark, d):
    edges = spark.createDataFrame(_EDGES, "region string, x1 double, y1 double, x2 double, y2 double")
    found = select.region_means(cubes.precipitation(spark, d), select.regions_of(cubes.cells(spark, d), edges), "pr")
    return found.select("region", F.col("date").cast("string").alias("date"), F.round("pr", 6).alias("pr"))


# every second nation is one key, which then holds half of all rows
_KEY_SQL = "CASE WHEN {0} % 2 = 0 THEN 0 ELSE {0} END"
_ORDERED = f"SELECT {_KEY_SQL.format('c_nationkey')}::INT AS key, o_orderdate::DATE AS date, max(o_orderkey) AS order_id, count(*)::BIGINT AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"
_SHIPPED = f"SELECT {_KEY_SQL.format('location_id')}::INT AS key, date, l_orderkey, l_linenumber, l_partkey FROM ship"


def _key(c):
    return F.when(F.col(c) % 2 == 0, 0).otherwise(F.col(c)).cast("int").alias("key")


@query(sql("ship", "SELECT key, strftime(s.date, '%Y-%m-%d') AS date, l_orderkey, l_linenumber, l_partkey, CASE WHEN s.date - o.date <= 2 THEN order_id END AS order_id, CASE WHEN s.date - o.date <= 2 THEN orders END AS orders FROM (SELECT * FROM shipped) s ASOF LEFT JOIN (SELECT * FROM ordered) o USING (key, date)".replace("USING (key, date)", "ON s.key = o.key AND s.date >= o.date").replace("SELECT key,", "SELECT s.key,"), shipped=_SHIPPED, ordered=_ORDERED))
def last_order_before(spark, d):
    """Each shipment with its nation's last orders of the two days before; one key holds half of all rows."""
    shipped = cubes.shipments(spark, d).select(_key("location_id"), "date", "l_orderkey", "l_linenumber", "l_partkey")
    customer = cubes.table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    ordered = cubes.table(spark, d, "orders").join(customer, "o_custkey").groupBy(_key("c_nationkey"), F.col("o_orderdate").cast("date").alias("date")).agg(F.max("o_orderkey").alias("order_id"), F.count(F.lit(1)).alias("orders"))
    return joins.as_of(shipped, ordered, ["key"], "date", ["order_id", "orders"], tolerance_days=2).withColumn("date", F.col("date").cast("string"))


_FIRST = "pr >= 20 AND dayofyear(date) >= {}"
_SEASONS = f"SELECT location_id, year(date)::INT AS season, min(CASE WHEN {_FIRST.format(60)} THEN date END) AS a, min(CASE WHEN {_FIRST.format(250)} THEN date END) AS b FROM pr GROUP BY ALL"


@query(sql("pr", "SELECT s.location_id, s.season, strftime(r.start, '%Y-%m-%d') AS start, r.length, (least(r.stop, s.b) - greatest(r.start, s.a) + 1)::INT AS days FROM seasons s JOIN spells r ON r.location_id = s.location_id AND r.start <= s.b AND s.a <= r.stop WHERE s.a <= s.b", seasons=_SEASONS,
           spells=runs_sql("pr", "pr < 1").replace("count(*)::BIGINT AS length", "count(*)::BIGINT AS length, min(date) AS start, max(date) AS stop").replace("SELECT location_id, year(date)::INT AS year, ok,", "SELECT location_id, date, year(date)::INT AS year, ok,").replace("GROUP BY location_id, year, g", "GROUP BY location_id, year, g HAVING count(*) >= 2")))
def dry_spells_of_seasons(spark, d):
    """Dry spells of two days or more that overlap a rain season, and the days of them inside it."""
    pr = cubes.precipitation(spark, d)
    bound = lambda doy: F.min(F.when(F.expr(_FIRST.format(doy)), F.col("date")))
    seasons = pr.groupBy("location_id", F.year("date").alias("season")).agg(bound(60).alias("from"), bound(250).alias("to"))
    found = joins.overlapping(runs.spells(pr, "pr < 1", 2), seasons, ["location_id"])
    return found.select("location_id", "season", F.col("start").cast("string").alias("start"), "length", "days")
