"""Regular grids: properties, bilinear weights, regridding, rotated poles, filling in space."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isohyet.functions import physics

from . import select


def properties(cells: DataFrame) -> DataFrame:
    """One row: n_lon, n_lat and the cell size on each axis (NULL with one cell only)."""
    size = lambda c: F.try_divide(F.max(c) - F.min(c), F.count_distinct(c) - 1)
    return cells.agg(F.count_distinct("lon").alias("n_lon"), F.count_distinct("lat").alias("n_lat"), size("lon").alias("d_lon"), size("lat").alias("d_lat"))


#: Parts of a cell below which a place is a cell's own, and weights below which a corner plays no part.
SNAP = 1e-9


def bilinear_weights(targets: DataFrame, cells: DataFrame) -> DataFrame:
    """target_id, location_id, weight of a regular grid's four corners around each target; none for targets outside.

    A corner is found by its place on the axes, so targets and cells meet by an equi-join. Places within SNAP of a cell
    are the cell's own: rounding makes no corner of a neighbour, and loses no target on the edge.
    """
    p = cells.agg(F.min("lon").alias("lon0"), F.max("lon").alias("lon1"), F.min("lat").alias("lat0"), F.max("lat").alias("lat1"), F.count_distinct("lon").alias("nx"), F.count_distinct("lat").alias("ny"))
    # an axis with one cell has steps of 1, and only that cell is on it
    step = lambda c, n: F.when(F.col(n) > 1, (F.col(f"{c}1") - F.col(f"{c}0")) / (F.col(n) - 1)).otherwise(1.0)
    sized = p.withColumns({"dx": step("lon", "nx"), "dy": step("lat", "ny")})
    at = targets.crossJoin(F.broadcast(sized))  # one row
    place = lambda c, d: (F.col(c) - F.col(f"{c}0")) / F.col(d)
    snapped = lambda x: F.when(F.abs(x - F.rint(x)) <= SNAP, F.rint(x)).otherwise(x)
    at = at.withColumns({"x": snapped(place("lon", "dx")), "y": snapped(place("lat", "dy"))}).filter("x between 0 and nx - 1 and y between 0 and ny - 1")
    at = at.withColumns({"i": F.least(F.floor("x"), F.greatest(F.col("nx") - 2, F.lit(0))), "j": F.least(F.floor("y"), F.greatest(F.col("ny") - 2, F.lit(0)))})
    fx, fy = F.col("x") - F.col("i"), F.col("y") - F.col("j")
    corner = F.explode(F.array(*(F.struct((F.col("i") + a).alias("i"), (F.col("j") + b).alias("j"), ((fx if a else 1 - fx) * (fy if b else 1 - fy)).alias("weight")) for a in (0, 1) for b in (0, 1))))
    corners = at.select("target_id", corner.alias("k")).select("target_id", "k.*").filter(F.col("weight") > SNAP)
    placed = cells.crossJoin(F.broadcast(sized)).select("location_id", F.rint(place("lon", "dx")).cast("long").alias("i"), F.rint(place("lat", "dy")).cast("long").alias("j"))  # one row
    return corners.join(placed, ["i", "j"]).select("target_id", "location_id", "weight")


def regrid(df: DataFrame, weights: DataFrame, value: str, keys: tuple[str, ...] = ("date",)) -> DataFrame:
    """keys, target_id, value: weighted sums; NULL if a corner's value is missing."""
    met = df.join(weights, "location_id")
    whole = F.count(value) == F.count(F.lit(1))
    return met.groupBy(*keys, "target_id").agg(F.when(whole, F.sum(F.col("weight") * F.col(value))).alias(value))


def unrotate(cells: DataFrame, pole_lon: float, pole_lat: float) -> DataFrame:
    """lon and lat of cells given by rlon and rlat on a rotated pole."""
    lon, lat = physics.rotate_pole(F.col("rlon"), F.col("rlat"), pole_lon, pole_lat, False)
    return cells.withColumns({"lon": lon, "lat": lat})


def rotated_weights(targets: DataFrame, cells: DataFrame, pole_lon: float, pole_lat: float) -> DataFrame:
    """Bilinear weights of a rotated grid: the targets are turned to it, where the grid is regular."""
    rlon, rlat = physics.rotate_pole(F.col("lon"), F.col("lat"), pole_lon, pole_lat, True)
    turned = targets.withColumns({"rlon": rlon, "rlat": rlat}).select("target_id", F.col("rlon").alias("lon"), F.col("rlat").alias("lat"))
    return bilinear_weights(turned, cells.select("location_id", F.col("rlon").alias("lon"), F.col("rlat").alias("lat")))


def _turned(lon: Column, beside: Column) -> Column:
    """A longitude as the one of its turns that is nearest to another."""
    return beside + F.pmod(lon - beside + 180, F.lit(360.0)) - 180


def curvilinear_weights(targets: DataFrame, cells: DataFrame, bin_degrees: float = 1.0) -> DataFrame:
    """target_id, location_id, weight for a grid that is told by its cells' lon and lat alone (and places i, j in it).

    Four neighbouring cells make a quad, on which longitude and latitude are bilinear; where a target lies in it is the
    root of a quadratic equation. Quads and targets meet by the squares of `bin_degrees` that they touch, an equi-join. A
    target on an edge is in several quads and takes the one of the least place; targets in none get no row. Missing cells
    make no quads. Grids may cross the 180th meridian; a quad around a pole isn't told by longitudes and makes none.
    """
    across = max(1, round(360 / bin_degrees))
    size = 360 / across
    named = lambda k: cells.select("i", "j", *(F.col(c).cast("double" if c != "location_id" else cells.schema[c].dataType).alias(f"{c}_{k}") for c in ("location_id", "lon", "lat")))
    quads = named("a")
    for k, (di, dj) in zip("bcd", ((1, 0), (0, 1), (1, 1)), strict=True):
        quads = quads.join(named(k).withColumns({"i": F.col("i") - di, "j": F.col("j") - dj}), ["i", "j"])
    quads = quads.withColumns({f"lon_{k}": _turned(F.col(f"lon_{k}"), F.col("lon_a")) for k in "bcd"})
    bound = lambda f, c: f(*(F.col(f"{c}_{k}") for k in "abcd"))
    quads = quads.withColumns({"west": bound(F.least, "lon"), "east": bound(F.greatest, "lon"), "south": bound(F.least, "lat"), "north": bound(F.greatest, "lat")}).filter("east - west < 180")
    square = lambda x: F.floor(x / size)
    touched = lambda low, high: F.explode(F.sequence(square(F.col(low) - SNAP), square(F.col(high) + SNAP)))
    placed = quads.withColumn("bx", touched("west", "east")).withColumn("by", touched("south", "north")).withColumn("bx", F.pmod("bx", F.lit(across))).drop("west", "east", "south", "north")
    at = targets.select("target_id", F.col("lon").alias("x"), F.col("lat").alias("y"), F.pmod(square(F.col("lon")), F.lit(across)).alias("bx"), square(F.col("lat")).alias("by"))
    met = at.join(placed.distinct() if across < 4 else placed, ["bx", "by"])
    # corner a, the sides to b and to c, what d is off their parallelogram, and the target, all from a
    part = {f"{n}{c}": e for c, axis in (("x", "lon"), ("y", "lat")) for n, e in (("e", F.col(f"{axis}_b") - F.col(f"{axis}_a")), ("f", F.col(f"{axis}_c") - F.col(f"{axis}_a")), ("g", F.col(f"{axis}_a") - F.col(f"{axis}_b") - F.col(f"{axis}_c") + F.col(f"{axis}_d")))}
    met = met.withColumns({**part, "hx": _turned(F.col("x"), F.col("lon_a")) - F.col("lon_a"), "hy": F.col("y") - F.col("lat_a")})
    cross = lambda a, b: F.col(f"{a}x") * F.col(f"{b}y") - F.col(f"{a}y") * F.col(f"{b}x")
    met = met.withColumns({"k2": cross("g", "f"), "k1": cross("e", "f") + cross("h", "g"), "k0": cross("h", "e")})
    root = F.sqrt(F.greatest(F.col("k1") * F.col("k1") - 4 * F.col("k2") * F.col("k0"), F.lit(0.0)))
    half = -(F.col("k1") + F.when(F.col("k1") < 0, -root).otherwise(root)) / 2  # never a difference of like numbers
    both = F.explode(F.array(F.try_divide(half, F.col("k2")), F.try_divide(F.col("k0"), half)))
    met = met.withColumn("v", both).filter("v is not null")
    wide = F.abs(F.col("ex") + F.col("gx") * F.col("v")) >= F.abs(F.col("ey") + F.col("gy") * F.col("v"))
    along = lambda c: F.try_divide(F.col(f"h{c}") - F.col(f"f{c}") * F.col("v"), F.col(f"e{c}") + F.col(f"g{c}") * F.col("v"))
    snapped = lambda c: F.when(F.abs(c) <= SNAP, 0.0).when(F.abs(c - 1) <= SNAP, 1.0).otherwise(c)
    inside = met.withColumn("u", F.when(wide, along("x")).otherwise(along("y"))).withColumns({"u": snapped(F.col("u")), "v": snapped(F.col("v"))}).filter("u between 0 and 1 and v between 0 and 1")
    u, v = F.col("u"), F.col("v")
    corners = F.array(*(F.struct(F.col(f"location_id_{k}").alias("location_id"), w.alias("weight")) for k, w in (("a", (1 - u) * (1 - v)), ("b", u * (1 - v)), ("c", (1 - u) * v), ("d", u * v))))
    one = inside.groupBy("target_id").agg(F.min(F.struct("i", "j", "v", "u", corners.alias("corners"))).alias("q"))
    return one.select("target_id", F.explode("q.corners").alias("k")).select("target_id", "k.*").filter(F.col("weight") > SNAP)


def has_rotated_axes(cells: DataFrame) -> bool:
    """Whether cells are told by places on a rotated grid, by their columns alone."""
    return {"rlon", "rlat"} <= set(cells.columns)


def with_places(cells: DataFrame) -> DataFrame:
    """Cells of a rotated grid with their places i and j on its axes, which are numbered by one task (a row for each place)."""
    for axis, place in (("rlon", "i"), ("rlat", "j")):
        numbered = cells.select(axis).distinct().withColumn(place, F.row_number().over(Window.orderBy(axis)) - 1)
        cells = cells.join(numbered, axis)
    return cells


def regular_targets(cells: DataFrame, step_lon: float, step_lat: float) -> DataFrame:
    """target_id, lon, lat: a regular grid over the cells' lon and lat, with the mean cell size as step.

    An axis holds as many whole steps as its extent; what is left over is half before the first place and half after the
    last. The grid is made of one row of extents, in place.
    """
    extent = cells.agg(*(f(c).alias(f"{c}{k}") for c in ("lon", "lat") for k, f in enumerate((F.min, F.max))))
    steps = lambda c, step: F.floor((F.col(f"{c}1") - F.col(f"{c}0")) / step + 1e-9)
    first = lambda c, step: F.col(f"{c}0") + ((F.col(f"{c}1") - F.col(f"{c}0")) - steps(c, step) * step) / 2
    axes = extent.select(first("lon", step_lon).alias("x0"), first("lat", step_lat).alias("y0"), steps("lon", step_lon).alias("nx"), F.explode(F.sequence(F.lit(0), steps("lat", step_lat))).alias("j"))
    every = axes.select("x0", "y0", "nx", "j", F.explode(F.sequence(F.lit(0), F.col("nx"))).alias("i"))
    return every.select((F.col("j") * (F.col("nx") + 1) + F.col("i")).cast("long").alias("target_id"), (F.col("x0") + F.col("i") * step_lon).alias("lon"), (F.col("y0") + F.col("j") * step_lat).alias("lat"))


def land_cells(cells: DataFrame, daily: DataFrame | None = None, value: str = "value", fraction: str = "sftlf") -> DataFrame:
    """location_id of land: cells with some share of it where that is known, else those whose daily values vary."""
    if fraction in cells.columns:
        return cells.filter(F.col(fraction) > 0).select("location_id")
    return select.valid_cells(daily, value)


def _filled(matrix: np.ndarray, sweeps: int) -> np.ndarray:
    """Sweeps that fill missing cells next to known ones: linear along each axis, one cell from either side, averaged."""
    known = matrix.copy()
    for _ in range(sweeps):
        gaps = np.isnan(known)
        if not gaps.any() or gaps.all():
            break
        found = []
        for axis in (0, 1):
            a = np.moveaxis(known, axis, 0)
            out = a.copy()
            at = np.arange(len(a))
            for line in range(a.shape[1]):
                ok = ~np.isnan(a[:, line])
                if not ok.any():
                    continue
                near = np.zeros(len(a), dtype=bool)
                near[1:] |= ok[:-1]
                near[:-1] |= ok[1:]
                fill = ~ok & near
                out[fill, line] = np.interp(at[fill], at[ok], a[ok, line])
            found.append(np.moveaxis(out, 0, axis))
        both = np.stack(found)
        n = (~np.isnan(both)).sum(0)
        mean = np.where(n > 0, np.nansum(both, 0) / np.maximum(n, 1), np.nan)
        known = np.where(gaps, mean, known)
    return known


def fill_in_space(df: DataFrame, value: str, keys: tuple[str, ...] = ("year",)) -> DataFrame:
    """Fill missing cells of each key's map (lon, lat, value) from those around them, sweep by sweep.

    A map is one small matrix, so one group in Python holds one map.
    """
    schema = df.select(*keys, "lon", "lat", value).schema

    def fill(table: pa.Table) -> pa.Table:
        lon, lat = (np.array(table.column(c).to_pylist(), dtype=float) for c in ("lon", "lat"))
        xs, i = np.unique(lon, return_inverse=True)
        ys, j = np.unique(lat, return_inverse=True)
        matrix = np.full((len(xs), len(ys)), np.nan)
        matrix[i, j] = np.array([np.nan if v is None else v for v in table.column(value).to_pylist()], dtype=float)
        out = _filled(matrix, max(matrix.shape))[i, j]
        return table.set_column(table.schema.get_field_index(value), value, pa.array([None if np.isnan(v) else float(v) for v in out], pa.float64()))

    return df.select(*keys, "lon", "lat", value).groupBy(*keys).applyInArrow(fill, schema)
