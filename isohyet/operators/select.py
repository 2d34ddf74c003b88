"""Selection in time and space."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isohyet import model


def subset_doy(df: DataFrame, first: int = -1, last: int = -1) -> DataFrame:
    """Days of year in [first, last], wrapping if first is later; -1 is an open end, so day 366 is never in."""
    return df.filter(model.in_season(F.dayofyear("date"), first, last))


def select_period(df: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Whole years, as a range of dates that Parquet scans can skip by."""
    return df.filter(F.col("date").between(F.lit(f"{first_year}-01-01").cast("date"), F.lit(f"{last_year}-12-31").cast("date")))


def remove_feb29(df: DataFrame) -> DataFrame:
    return df.filter(~((F.month("date") == 2) & (F.dayofmonth("date") == 29)))


def box_of(cells: DataFrame, lon: tuple[float, float], lat: tuple[float, float]) -> tuple[tuple[float, float], tuple[float, float]]:
    """A box clamped to the grid; an axis with at most one cell in it is widened by half a cell, then by a whole one."""
    extent = cells.agg(*(f(c) for c in ("lon", "lat") for f in (F.min, F.max, F.count_distinct))).first()
    out = []
    for (lo, hi), (least, most, n) in zip((lon, lat), (extent[:3], extent[3:]), strict=True):
        step = (most - least) / (n - 1) if n > 1 else 1.0
        lo, hi = max(lo, least), min(hi, most)
        for more in (0.0, 0.5, 1.0):
            a, b = lo - more * step, hi + more * step
            inside = sum(a <= least + k * step <= b for k in range(max(0, int((a - least) // step)), min(n, int((b - least) // step) + 2)))
            if inside > 1:
                break
        out.append((a, b))
    return out[0], out[1]


def subset_box(df: DataFrame, cells: DataFrame, lon: tuple[float, float], lat: tuple[float, float]) -> DataFrame:
    """Rows of the cells in the box (see box_of); cells has location_id, lon, lat, one row per cell."""
    (a, b), (c, d) = box_of(cells, lon, lat)
    return df.join(cells.filter(F.col("lon").between(a, b) & F.col("lat").between(c, d)).select("location_id"), "location_id", "left_semi")


def control_point(df: DataFrame, cells: DataFrame, lon: float | None = None, lat: float | None = None) -> DataFrame:
    """Rows of one cell: the nearest to the point, or the middle one of the grid's axes."""
    if lon is not None and lat is not None:
        distance = F.pow(F.col("lon") - lon, 2) + F.pow(F.col("lat") - lat, 2)
        cell = cells.agg(F.min_by("location_id", F.struct(distance, "location_id")).alias("location_id"))
    else:
        sides = cells.agg(F.array_sort(F.collect_set("lon")).alias("x"), F.array_sort(F.collect_set("lat")).alias("y"))
        middle = sides.select(F.element_at("x", F.expr("cast(size(x) div 2 + 1 as int)")).alias("lon"), F.element_at("y", F.expr("cast(size(y) div 2 + 1 as int)")).alias("lat"))
        cell = cells.join(middle, ["lon", "lat"]).select("location_id")
    return df.join(cell, "location_id", "left_semi")


def regions_of(cells: DataFrame, edges: DataFrame) -> DataFrame:
    """region, location_id of cells whose centre lies in a region: a ray to the right crosses its rings an odd number of times.

    edges: region, x1, y1, x2, y2, a row for each side of any ring, holes among them. A side is told in each row of
    latitudes that it reaches, as wide as the cells are apart, and meets the cells of that row by an equi-join. Of regions
    that share a border a cell on it lies in one; where regions overlap it lies in each.
    """
    apart = cells.agg(F.try_divide(F.max("lat") - F.min("lat"), F.count_distinct("lat") - 1).alias("height"))
    height = apart.select(F.when(F.col("height") > 0, F.col("height")).otherwise(1.0)).scalar()
    row = lambda c: F.floor(F.col(c) / F.col("height"))
    sides = edges.filter("y1 <> y2").withColumns({"height": height, "low": F.least("y1", "y2"), "high": F.greatest("y1", "y2")})
    told = sides.withColumn("row", F.explode(F.sequence(row("low"), row("high")))).select("region", "row", "x1", "y1", "x2", "y2")
    placed = cells.withColumn("height", height).select("location_id", "lon", "lat", row("lat").alias("row"))
    crosses = ((F.col("y1") > F.col("lat")) != (F.col("y2") > F.col("lat"))) & (F.col("lon") < (F.col("x2") - F.col("x1")) * (F.col("lat") - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1"))
    return placed.join(told, "row").filter(crosses).groupBy("region", "location_id").agg(F.count(F.lit(1)).alias("n")).filter("n % 2 = 1").select("region", "location_id")


def region_means(df: DataFrame, members: DataFrame, value: str, keys: tuple[str, ...] = ("date",)) -> DataFrame:
    """region, keys, value: the mean over the cells of each region; members as regions_of() gives them."""
    return df.join(members, "location_id").groupBy("region", *keys).agg(F.avg(value).alias(value))


def inside_polygon(cells: DataFrame, edges: DataFrame) -> DataFrame:
    """location_id of cells whose centre lies in one polygon (sides x1, y1, x2, y2)."""
    return regions_of(cells, edges.select(F.lit(0).alias("region"), "x1", "y1", "x2", "y2")).select("location_id")


def clip(df: DataFrame, cells: DataFrame, edges: DataFrame) -> DataFrame:
    return df.join(inside_polygon(cells, edges), "location_id", "left_semi")


def valid_cells(df: DataFrame, value: str) -> DataFrame:
    """location_id of cells with a value that varies: cells that are constant or missing throughout are no land."""
    return df.groupBy("location_id").agg(F.min(value).alias("low"), F.max(value).alias("high")).filter("low is not null and low <> high").select("location_id")


def apply_mask(df: DataFrame, kept: DataFrame, value: str) -> DataFrame:
    """Values outside the kept cells become NULL; rows stay."""
    marked = kept.select("location_id").distinct().withColumn("in_mask", F.lit(True))
    return df.join(marked, "location_id", "left").withColumn(value, F.when(F.col("in_mask"), F.col(value))).drop("in_mask")


def count_matching(stations: DataFrame, key: str) -> DataFrame:
    """How many station ids contain a text; "total" counts all."""
    hit: Column = F.lit(True) if key == "total" else F.contains(F.col("station_id"), F.lit(key))
    return stations.agg(F.count_if(hit).alias("n"))


def merge_unaligned(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join of two boolean series (column ok) by day: a day missing on either side is not ok."""
    both = left.withColumnRenamed("ok", "left_ok").join(right.withColumnRenamed("ok", "right_ok"), keys, "full")
    return both.withColumn("ok", F.coalesce("left_ok", F.lit(False)) & F.coalesce("right_ok", F.lit(False))).drop("left_ok", "right_ok")


def nearest_cells(stations: DataFrame, cells: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """station_id and the nearest cell within the tolerance on both axes.

    Cells and stations meet only in equal or neighbouring squares of the tolerance's size.
    """
    square = lambda c: F.floor(F.col(c) / tolerance)
    near = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    spread = stations.withColumn("dx", near).withColumn("dy", near).select("station_id", F.col("lon").alias("x"), F.col("lat").alias("y"), (square("lon") + F.col("dx")).alias("i"), (square("lat") + F.col("dy")).alias("j"))
    placed = cells.select("location_id", "lon", "lat", square("lon").alias("i"), square("lat").alias("j"))
    met = spread.join(placed, ["i", "j"]).filter((F.abs(F.col("lon") - F.col("x")) <= tolerance) & (F.abs(F.col("lat") - F.col("y")) <= tolerance))
    distance = F.pow(F.col("lon") - F.col("x"), 2) + F.pow(F.col("lat") - F.col("y"), 2)
    return met.groupBy("station_id").agg(F.min_by("location_id", F.struct(distance, "location_id")).alias("location_id"))


def first_in(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("place = 1").drop("place")
