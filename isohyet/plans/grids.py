"""Queries of grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from isohyet.operators import grid, select, workflow
from isohyet.sources import cubes

from .catalog import query
from .sql import sql

_TARGETS = "SELECT location_id::BIGINT AS target_id, lon + 0.25 AS lon, lat + 0.5 AS lat FROM cells"


def _targets(spark, d):
    """A point inside each cell's square, those of the last row and column outside the grid."""
    return cubes.cells(spark, d).select(F.col("location_id").cast("long").alias("target_id"), (F.col("lon") + 0.25).alias("lon"), (F.col("lat") + 0.5).alias("lat"))


@query(sql("cells", "SELECT count(DISTINCT lon)::BIGINT AS n_lon, count(DISTINCT lat)::BIGINT AS n_lat, (max(lon) - min(lon)) / (count(DISTINCT lon) - 1) AS d_lon, (max(lat) - min(lat)) / (count(DISTINCT lat) - 1) AS d_lat FROM cells"))
def grid_properties(spark, d):
    return grid.properties(cubes.cells(spark, d))


@query(sql("pr", "SELECT t.target_id, strftime(p.date, '%Y-%m-%d') AS date, round(sum((1 - abs(t.lon - p.lon)) * (1 - abs(t.lat - p.lat)) * p.pr), 6) AS pr FROM t JOIN pr p ON abs(t.lon - p.lon) < 1 AND abs(t.lat - p.lat) < 1 WHERE t.lon <= 4 AND t.lat <= 4 GROUP BY 1, 2", t=_TARGETS))
def regrid_bilinear(spark, d):
    weights = grid.bilinear_weights(_targets(spark, d), cubes.cells(spark, d))
    found = grid.regrid(cubes.precipitation(spark, d), weights, "pr")
    return found.select("target_id", F.col("date").cast("string").alias("date"), F.round("pr", 6).alias("pr"))


@query(sql("cells", "SELECT t.target_id::VARCHAR AS station_id, arg_min(c.location_id, ((c.lon - t.lon) ** 2 + (c.lat - t.lat) ** 2, c.location_id)) AS location_id FROM t JOIN cells c ON abs(c.lon - t.lon) <= 1 AND abs(c.lat - t.lat) <= 1 GROUP BY 1", t=_TARGETS))
def nearest_station(spark, d):
    stations = _targets(spark, d).select(F.col("target_id").cast("string").alias("station_id"), "lon", "lat")
    return select.nearest_cells(stations, cubes.cells(spark, d))


@query(sql("cells", "SELECT t.target_id, count(*)::BIGINT AS n, round(sum((1 - abs(t.lon - p.lon)) * (1 - abs(t.lat - p.lat))), 6) AS total FROM t JOIN cells p ON abs(t.lon - p.lon) < 1 AND abs(t.lat - p.lat) < 1 WHERE t.lon <= 4 AND t.lat <= 4 GROUP BY 1", t=_TARGETS))
def regrid_weights(spark, d):
    return grid.bilinear_weights(_targets(spark, d), cubes.cells(spark, d)).groupBy("target_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("weight"), 6).alias("total"))


# holes have known neighbours on all sides, so one sweep fills them
@query(sql("pr", "SELECT h.year, h.lon, h.lat, round(coalesce(h.value, f.value), 6) AS value FROM holes h LEFT JOIN filled f ON f.year = h.year AND f.lon = h.lon AND f.lat = h.lat",
           years="SELECT location_id, lon, lat, year(date)::INT AS year, sum(pr)::DOUBLE AS value FROM pr GROUP BY ALL", holes="SELECT * EXCLUDE (value), CASE WHEN location_id % 6 <> 1 THEN value END AS value FROM years",
           filled="SELECT year, lon, lat, avg(v) AS value FROM (SELECT h.year, h.lon, h.lat, n.lon = h.lon AS axis, avg(n.value) AS v FROM holes h JOIN holes n ON n.year = h.year AND abs(n.lon - h.lon) + abs(n.lat - h.lat) = 1 AND n.value IS NOT NULL WHERE h.value IS NULL GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3"))
def fill_na_spatial(spark, d):
    years = cubes.precipitation(spark, d).groupBy("location_id", "lon", "lat", F.year("date").alias("year")).agg(F.sum("pr").alias("value"))
    holes = years.withColumn("value", F.when(F.col("location_id") % 6 != 1, F.col("value")))
    return grid.fill_in_space(holes, "value").withColumn("value", F.round("value", 6))


@query(sql("pr", "SELECT t.target_id, y.year, CASE WHEN count(y.value) = count(*) THEN round(avg(y.value), 6) END AS value FROM t JOIN years y ON abs(t.x - y.lon) <= 0.5 AND y.lat = t.y GROUP BY 1, 2",
           years="SELECT location_id, lon, lat, year(date)::INT AS year, CASE WHEN location_id % 6 <> 1 THEN sum(pr)::DOUBLE END AS value FROM pr GROUP BY 1, 2, 3, 4",
           t="SELECT location_id::BIGINT AS target_id, lon AS x, lat AS y FROM cells UNION ALL SELECT location_id + 100, lon + 0.5, lat FROM cells WHERE lon < 4"))
def regrid_beside_gaps(spark, d):
    """A grid of tenths of a degree onto its own cells and the middles between them: a gap spreads to no cell that is known."""
    years = cubes.precipitation(spark, d).groupBy("location_id", F.year("date").alias("year")).agg(F.sum("pr").alias("value"))
    holes = years.withColumn("value", F.when(F.col("location_id") % 6 != 1, F.col("value")))
    cells = cubes.cells(spark, d).select("location_id", (F.col("lon") * 0.1).alias("lon"), (F.col("lat") * 0.1).alias("lat"))
    own, beside = (cells.select((F.col("location_id") + k).cast("long").alias("target_id"), (F.col("lon") + more).alias("lon"), "lat") for k, more in ((0, 0.0), (100, 0.05)))
    found = grid.regrid(holes, grid.bilinear_weights(own.unionByName(beside), cells), "value", ("year",))
    return found.select("target_id", "year", F.round("value", 6).alias("value"))


@query(sql("cells", "SELECT location_id AS target_id, location_id, 1::DOUBLE AS weight FROM cells"))
def rotated_regrid(spark, d):
    cells = cubes.cells(spark, d).select("location_id", F.col("lon").alias("rlon"), F.col("lat").alias("rlat"))
    plain = grid.unrotate(cells, 10.0, 80.0)
    targets = plain.select(F.col("location_id").alias("target_id"), "lon", "lat")
    weights = grid.rotated_weights(targets, cells, 10.0, 80.0)
    return weights.select("target_id", "location_id", F.round("weight", 6).alias("weight"))


_TURN = {"sin": "sin(radians(170))", "cos": "cos(radians(170))", "sp": "sin(radians(10))", "cp": "cos(radians(10))"}
_BACK = "SELECT location_id, rlon, rlat, degrees(atan2(along * {sp} + ny * {cp}, along * {cp} - ny * {sp})) AS lon, degrees(asin(nz)) AS lat FROM (SELECT *, x * {cos} - z * {sin} AS along, y AS ny, x * {sin} + z * {cos} AS nz FROM (SELECT location_id, lon AS rlon, lat AS rlat, cos(radians(lon)) * cos(radians(lat)) AS x, sin(radians(lon)) * cos(radians(lat)) AS y, sin(radians(lat)) AS z FROM cells))".format(**_TURN)
_THERE = "SELECT target_id, degrees(atan2(across, along * {cos} + z * {sin})) AS x, degrees(asin(z * {cos} - along * {sin})) AS y FROM (SELECT target_id, z, p * {cp} + q * {sp} AS along, q * {cp} - p * {sp} AS across FROM (SELECT target_id, cos(radians(lon)) * cos(radians(lat)) AS p, sin(radians(lon)) * cos(radians(lat)) AS q, sin(radians(lat)) AS z FROM t))".format(**_TURN)


@query(sql("cells", "SELECT t.target_id, c.location_id, round((1 - abs(t.x - c.rlon)) * (1 - abs(t.y - c.rlat)), 6) AS weight FROM turned t JOIN plain c ON abs(t.x - c.rlon) < 1 AND abs(t.y - c.rlat) < 1 WHERE t.x BETWEEN 0 AND 4 AND t.y BETWEEN 0 AND 4",
           plain=_BACK, t="SELECT location_id::BIGINT AS target_id, lon + 0.31 AS lon, lat - 0.23 AS lat FROM plain", turned=_THERE))
def rotated_weights(spark, d):
    """Bilinear weights of a rotated grid at points beside its cells, those outside left out."""
    cells = cubes.cells(spark, d).select("location_id", F.col("lon").alias("rlon"), F.col("lat").alias("rlat"))
    plain = grid.unrotate(cells, 10.0, 80.0)
    targets = plain.select(F.col("location_id").cast("long").alias("target_id"), (F.col("lon") + 0.31).alias("lon"), (F.col("lat") - 0.23).alias("lat"))
    return grid.rotated_weights(targets, cells, 10.0, 80.0).select("target_id", "location_id", F.round("weight", 6).alias("weight"))


_STEP = 0.7


@query(sql("cells", f"SELECT (j * (nx + 1) + i)::BIGINT AS target_id, round(x0 + i * {_STEP}, 6) AS lon, round(y0 + j * {_STEP}, 6) AS lat FROM (SELECT *, unnest(range(0, ny + 1)) AS j FROM (SELECT *, unnest(range(0, nx + 1)) AS i FROM (SELECT lo + ((hi - lo) - nx * {_STEP}) / 2 AS x0, la + ((ha - la) - ny * {_STEP}) / 2 AS y0, nx, ny FROM (SELECT *, floor((hi - lo) / {_STEP})::BIGINT AS nx, floor((ha - la) / {_STEP})::BIGINT AS ny FROM (SELECT min(lon) AS lo, max(lon) AS hi, min(lat) AS la, max(lat) AS ha FROM cells)))))"))
def regular_targets(spark, d):
    return grid.regular_targets(cubes.cells(spark, d), _STEP, _STEP).select("target_id", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


# a grid whose lon and lat are bilinear in its own places x and y, and points at known places of it: inside, on an edge, at a cell, outside
_BEND = "{x} + 0.05 * {x} * {y} + 0.2 * {y} AS lon, {y} - 0.03 * {x} * {y} + 0.1 * {x} AS lat"
_SPOTS = ((0, 0.3, 0.6), (100, 0.5, 0.0), (200, 0.0, 0.0))


@query(sql("cells", "SELECT t.target_id, c.location_id, round((1 - abs(t.x - c.lon)) * (1 - abs(t.y - c.lat)), 9) AS weight FROM t JOIN cells c ON abs(t.x - c.lon) < 1 AND abs(t.y - c.lat) < 1 WHERE t.x <= 4 AND t.y <= 4",
           t=" UNION ALL ".join(f"SELECT location_id::BIGINT + {k} AS target_id, lon + {dx} AS x, lat + {dy} AS y FROM cells" for k, dx, dy in _SPOTS)))
def curvilinear_weights(spark, d):
    """Weights of a bent grid that is known by its cells' lon and lat alone."""
    own = cubes.cells(spark, d).select("location_id", F.col("lon").alias("x"), F.col("lat").alias("y"))
    bent = lambda df, name: df.selectExpr(name, "x", "y", *(part.format(x="x", y="y") for part in _BEND.split(", ")))
    cells = bent(own, "location_id").select("location_id", F.col("x").cast("int").alias("i"), F.col("y").cast("int").alias("j"), "lon", "lat")
    spots = [own.selectExpr(f"cast(location_id as bigint) + {k} as target_id", f"x + {dx} as x", f"y + {dy} as y") for k, dx, dy in _SPOTS]
    targets = bent(spots[0].unionByName(spots[1]).unionByName(spots[2]), "target_id")
    return grid.curvilinear_weights(targets, cells).select("target_id", "location_id", F.round("weight", 9).alias("weight"))


@query(sql("cells pr", "SELECT t.target_id AS location_id, round(t.lon, 6) AS lon, round(t.lat, 6) AS lat, y.year, round(sum((1 - abs(t.x - y.lon)) * (1 - abs(t.y - y.lat)) * y.pr), 4) AS pr FROM placed t JOIN years y ON abs(t.x - y.lon) < 1 AND abs(t.y - y.lat) < 1 GROUP BY ALL",
           years="SELECT location_id, lon, lat, year(date)::INT AS year, sum(pr)::DOUBLE AS pr FROM pr GROUP BY ALL",
           axes="SELECT (max(lon + 0.2 * lat) - min(lon + 0.2 * lat)) AS wide, (max(lat + 0.1 * lon) - min(lat + 0.1 * lon)) AS high, floor(4.8 / 0.7 + 1e-9)::BIGINT AS nx, floor(4.4 / 0.7 + 1e-9)::BIGINT AS ny FROM cells",
           t="SELECT j * (nx + 1) + i AS target_id, (wide - nx * 0.7) / 2 + i * 0.7 AS lon, (high - ny * 0.7) / 2 + j * 0.7 AS lat FROM (SELECT *, unnest(range(0, ny + 1)) AS j FROM (SELECT *, unnest(range(0, nx + 1)) AS i FROM axes))",
           placed="SELECT * FROM (SELECT *, (lon - 0.2 * lat) / 0.98 AS x, (lat - 0.1 * lon) / 0.98 AS y FROM t) WHERE x BETWEEN -1e-9 AND 4 + 1e-9 AND y BETWEEN -1e-9 AND 4 + 1e-9"))
def curvilinear_to_regular(spark, d):
    """Annual precipitation of a slanted grid on a regular one."""
    years = cubes.precipitation(spark, d).groupBy("location_id", F.year("date").alias("year")).agg(F.sum("pr").alias("pr"))
    cells = cubes.cells(spark, d).select("location_id", F.col("lon").cast("int").alias("i"), F.col("lat").cast("int").alias("j"), (F.col("lon") + 0.2 * F.col("lat")).alias("lon"), (F.col("lat") + 0.1 * F.col("lon")).alias("lat"))
    return workflow.to_regular(years, cells, "pr", 0.7, 0.7, ("year",)).select("location_id", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), "year", F.round("pr", 4).alias("pr"))
