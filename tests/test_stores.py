"""Zarr and NetCDF sources and sinks: round trips, what is opened, and writes that are cut short."""

from __future__ import annotations

import json
import os
from collections import Counter
from datetime import date
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from isohyet import model
from isohyet.operators import workflow
from isohyet.sources import netcdf, tables, zarr

BOX = "lon between 1 and 2 and lat >= 3 and date between date'1996-02-01' and date'1996-12-01'"


@pytest.fixture(scope="module")
def cube(spark):
    """Two years of 5 x 4 cells; every seventh value is missing, and so is a whole cell on some days."""
    cells = spark.range(20).selectExpr("id as location_id", "cast(id % 5 as double) / 2 as lon", "cast(id div 5 as double) - 1 as lat")
    days = cells.selectExpr("*", "explode(sequence(date'1995-12-01', date'1997-01-10')) as date").filter("not (location_id = 3 and month(date) = 5)")
    v = F.when((F.dayofyear("date") + F.col("location_id")) % 7 != 0, F.dayofyear("date") * 100 + F.col("location_id") + 0.25)
    return days.select("location_id", "lon", "lat", "date", v.alias("v"), (-v).alias("w"))


def _rows(df, with_missing=False):
    return Counter((r.location_id, r.lon, r.lat, r.date, r.v, r.w) for r in df.collect() if with_missing or r.v is not None)


@pytest.mark.parametrize("codec", ["zlib", "gzip", "zstd"])
def test_zarr_round_trip(spark, cube, tmp_path, codec):
    path = f"file://{tmp_path}/a.zarr"
    zarr.write_zarr(cube, path, ["v", "w"], (100, 3, 2), codec)
    back = zarr.read_zarr(spark, path)
    assert back.count() == 20 * 407 and _rows(back) == _rows(cube)
    assert zarr.read_zarr(spark, path, ["w"]).columns == ["location_id", "lon", "lat", "date", "w"]
    assert sorted(os.listdir(tmp_path / "a.zarr")) == [".zattrs", ".zgroup", "lat", "lon", "time", "v", "w"]
    meta = json.loads((tmp_path / "a.zarr" / "v" / ".zarray").read_text())
    assert meta["shape"] == [407, 4, 5] and meta["chunks"] == [100, 3, 2] and meta["compressor"]["id"] == codec
    with pytest.raises(FileExistsError):
        zarr.write_zarr(cube, path, ["v"])


def test_only_chunks_of_the_filter_are_opened(spark, cube, tmp_path):
    path = f"file://{tmp_path}/a.zarr"
    zarr.write_zarr(cube, path, ["v", "w"], (100, 2, 2))
    for chunk in (tmp_path / "a.zarr").glob("[vw]/[0-9]*"):
        t, y, x = (int(k) for k in chunk.name.split("."))
        if not (t < 4 and y == 1 and x in (1, 2)):  # days 62 to 366, latitudes from 2 on, longitudes 1 to 2
            chunk.write_bytes(b"unreadable")
    box = "lat = 2 and lon between 1 and 2 and date between date'1996-02-01' and date'1996-12-01'"
    found = zarr.read_zarr(spark, path).filter(box)
    assert found.rdd.getNumPartitions() == 8 and _rows(found) == _rows(cube.filter(box))
    with pytest.raises(Exception, match="(?i)zstd|frame|magic"):
        zarr.read_zarr(spark, path).count()
    assert zarr.read_zarr(spark, path).filter("lat > 90").count() == 0


def test_filters_on_coordinates():
    values = np.array([1.0, 2.0, 3.0, 4.0])
    told = [GreaterThanOrEqual(("lat",), 2.0), LessThan(("lat",), 4.0), In(("lat",), (3.0, 4.0, None)), EqualTo(("lon",), 9.0), LessThanOrEqual(("lat",), 3.0)]
    assert zarr.wanted(told, "lat", values).tolist() == [False, False, True, False]
    assert zarr.days_of(np.array([0, 36]), "hours since 1970-01-02 12:00:00").tolist() == [1, 3]
    with pytest.raises(ValueError, match="not read"):
        zarr.days_of(np.array([1]), "months since 1970-01-01")


def _task(chunk, value):
    t = np.array(chunk, dtype=np.int32)
    names = ["chunk_t", "chunk_y", "chunk_x", "t", "y", "x", "v"]
    return iter([pa.RecordBatch.from_arrays([*(pa.array([int(k)], pa.int32()) for k in t), *(pa.array([int(k)], pa.int32()) for k in t), pa.array([value])], names=names)])


def test_a_lost_task_leaves_nothing(tmp_path):
    path = f"file://{tmp_path}/a.zarr"
    axes = {"time": [0, 1], "lat": [0.0], "lon": [0.0]}
    options = {"path": path, "chunks": "[1, 1, 1]", "shape": "[2, 1, 1]", "codec": "zlib", "level": "1", "metadata": json.dumps(axes)}
    schema = StructType()
    for c in ("chunk_t", "chunk_y", "chunk_x", "t", "y", "x"):
        schema = schema.add(c, "integer")
    writer = zarr._Writer(options, schema.add("v", "double"))

    def broken():
        yield from _task((1, 0, 0), 99.0)
        yield from _task((0, 0, 0), 98.0)
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        writer.write(broken())
    done = [writer.write(_task((0, 0, 0), 1.0)), None]
    with pytest.raises(FileNotFoundError):  # before the commit there is no store
        zarr._variables(path)
    writer.commit(done)
    assert sorted(p.name for p in (tmp_path / "a.zarr" / "v").iterdir()) == [".zarray", ".zattrs", "0.0.0"]
    assert not list((tmp_path / "a.zarr").glob(".attempts*"))
    v = zarr.Array(path, "v")
    assert v.floats((0, 0, 0)).tolist() == [[[1.0]]] and np.isnan(v.floats((1, 0, 0))).all()
    other = zarr._Writer({**options, "path": f"file://{tmp_path}/b.zarr"}, schema)
    other.variables = ["v"]
    other.abort([other.write(_task((0, 0, 0), 1.0))])
    assert not [p for p in Path(f"{tmp_path}/b.zarr").rglob("*") if p.is_file()]


def test_stores_that_others_wrote(spark, tmp_path):
    """Packed integers with a missing value and a scale, no compressor, nested chunk names, hours as time."""
    root = tmp_path / "o.zarr"

    def put(name, values, chunks, attrs, **more):
        (root / name).mkdir(parents=True)
        (root / name / ".zarray").write_text(json.dumps({"zarr_format": 2, "shape": values.shape, "chunks": chunks, "dtype": values.dtype.str, "compressor": None, "fill_value": None, "order": "C", "filters": None} | more))
        (root / name / ".zattrs").write_text(json.dumps(attrs))

    put("time", t := np.array([12, 36], dtype="<i4"), [2], {"_ARRAY_DIMENSIONS": ["time"], "units": "hours since 2000-02-28 00:00:00"})
    put("lat", y := np.array([5.0, 4.0], dtype="<f4"), [2], {"_ARRAY_DIMENSIONS": ["lat"]})
    put("lon", x := np.array([1.0], dtype="<f4"), [1], {"_ARRAY_DIMENSIONS": ["lon"]})
    packed = np.array([[[10], [-1]], [[30], [40]]], dtype="<i2")
    put("p", packed, [1, 2, 1], {"_ARRAY_DIMENSIONS": ["time", "lat", "lon"], "scale_factor": 0.5, "add_offset": 1.0, "_FillValue": -1}, dimension_separator="/", fill_value=-1)
    for name, values in (("time", t), ("lat", y), ("lon", x)):
        (root / name / "0").write_bytes(values.tobytes())
    (root / "p" / "0" / "0").mkdir(parents=True)
    (root / "p" / "0" / "0" / "0").write_bytes(packed[0].tobytes())  # the second chunk has no file
    with pytest.raises(Exception, match="no finished store"):
        zarr.read_zarr(spark, f"file://{root}").count()
    (root / ".zgroup").write_text("{}")
    found = [(r.location_id, r.lat, r.date, r.p) for r in zarr.read_many(spark, {"ref": f"file://{root}"}).orderBy("date", "location_id").collect()]
    assert found == [(0, 5.0, date(2000, 2, 28), 6.0), (1, 4.0, date(2000, 2, 28), None), (0, 5.0, date(2000, 2, 29), None), (1, 4.0, date(2000, 2, 29), None)]


@pytest.mark.parametrize("records", [True, False])
def test_netcdf_round_trip(spark, cube, tmp_path, records):
    files = [r.path for r in netcdf.write_netcdf(cube, f"file://{tmp_path}/n", ["v", "w"], records).orderBy("year").collect()]
    assert sorted(os.listdir(tmp_path / "n")) == ["1995.nc", "1996.nc", "1997.nc"]
    back = netcdf.read_netcdf(spark, files)
    assert back.count() == 20 * 407 and _rows(back) == _rows(cube)
    box = back.filter(BOX)
    assert box.rdd.getNumPartitions() == 1 and _rows(box) == _rows(cube.filter(BOX))
    Path(files[0].removeprefix("file://")).write_bytes(Path(files[0].removeprefix("file://")).read_bytes()[:900])  # its data are gone
    assert _rows(netcdf.read_netcdf(spark, files[1:]).filter(BOX)) == _rows(cube.filter(BOX))
    assert netcdf.read_netcdf(spark, files[1:], ["w"]).filter("date > date'2010-01-01'").count() == 0


def test_netcdf_ranges(tmp_path, monkeypatch):
    """Steps and rows outside the filters are not read: of a file whose other numbers are missing, the rest is right."""
    days, lats, lons = np.arange(100, 110), np.arange(6.0), np.arange(3.0)
    values = np.arange(10 * 18.0).reshape(10, 6, 3)
    path = tmp_path / "a.nc"
    path.write_bytes(netcdf.encode(days, lats, lons, {"v": values, "u": -values}))
    reader = netcdf._Reader([f"file://{path}"], StructType().add("lat", "double").add("date", "date").add("v", "double"))
    reader.pushFilters([GreaterThanOrEqual(("lat",), 2.0), LessThan(("lat",), 4.0), GreaterThanOrEqual(("date",), date(1970, 4, 15))])
    monkeypatch.setattr(netcdf, "PARTITION_BYTES", 8 * 18 * 3)
    parts = reader.partitions()
    assert [(p.low, p.high) for p in parts] == [(4, 7), (7, 10)]
    got = [v for p in parts for b in reader.read(p) for v in b.column(2).to_pylist()]
    assert got == values[4:, 2:4].ravel().tolist()
    with pytest.raises(ValueError, match="classic"):
        netcdf.Header(b"HDF5" + bytes(60))
    with pytest.raises(EOFError):
        netcdf.Header(path.read_bytes()[:40])


def test_long_headers_are_read_again(tmp_path, monkeypatch):
    monkeypatch.setattr(netcdf, "HEAD_BYTES", 40)
    path = tmp_path / "a.nc"
    path.write_bytes(netcdf.encode(np.arange(2), np.arange(1.0), np.arange(1.0), {"v": np.zeros((2, 1, 1))}))
    assert list(netcdf.read_header(f"file://{path}").variables) == ["lat", "lon", "time", "v"]
    path.write_bytes(path.read_bytes()[:60])
    with pytest.raises(ValueError, match="ends early"):
        netcdf.read_header(f"file://{path}")


def test_crop_scans_only_files_with_the_keyword(spark, tmp_path):
    rows = [("pr", sim, str(k), float(k), 0.0, date(2000, 1, 1), float(k)) for sim in ("A_x", "B_x") for k in range(4)]
    daily = spark.createDataFrame(rows, model.DAILY)
    tables.write_cube(daily, f"{tmp_path}/whole")
    others = list(Path(f"{tmp_path}/whole").glob("var=pr/sim_code=A_x/*.parquet"))
    assert others
    for file in others:
        file.write_bytes(b"no Parquet: whoever opens it fails")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    cells = daily.select("location_id", "lon", "lat").distinct()
    found = tables.crop(spark, f"{tmp_path}/whole", "sim_code=B_", cells, (1.0, 2.0), (-1.0, 1.0), f"{tmp_path}/cut")
    assert {(r.sim_code, r.location_id) for r in found.collect()} == {("B_x", "1"), ("B_x", "2")}
    assert all("sim_code=B_" in r.path for r in tables.list_files(spark, f"{tmp_path}/cut").collect())


def test_rotated_extract_needs_steps(spark):
    daily = spark.createDataFrame([(0, date(2000, 1, 1), 1.0)], "location_id int, date date, value double")
    cells = spark.createDataFrame([(0, 0.0, 0.0, 0.0, 0.0)], "location_id int, rlon double, rlat double, lon double, lat double")
    with pytest.raises(ValueError, match="steps"):
        workflow.extract(daily, daily, cells, (0.0, 1.0), (0.0, 1.0), (2000, 2000))
