"""Days that arrive in any order: the cube they are taken into, and the spells that are told of them."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from isohyet.operators import runs
from isohyet.streaming import ingest, spells

EPOCH = date(1970, 1, 1)


def _write(spark, folder, day, rows):
    spark.createDataFrame(rows, "location_id long, value double").coalesce(1).write.mode("append").parquet(f"{folder}/tas_{day}.nc")


def _cube(spark, path):
    return {(r.location_id, str(r.date)): r.value for r in spark.read.parquet(path).collect()}


def test_days_arrive_late_and_twice(spark, tmp_path):
    arrivals, cube, checkpoint = (str(tmp_path / x) for x in ("arrivals", "cube", "checkpoint"))
    schema = spark.createDataFrame([], "location_id long, value double").schema
    take = lambda: ingest.ingest(spark, arrivals, cube, checkpoint, schema, files_per_batch=2)
    _write(spark, arrivals, "20011230", [(1, 1.0), (2, None)])
    _write(spark, arrivals, "20020101", [(1, 3.0)])
    _write(spark, arrivals, "notaday0", [(1, 99.0)])
    take()
    assert _cube(spark, cube) == {(1, "2001-12-30"): 1.0, (2, "2001-12-30"): None, (1, "2002-01-01"): 3.0}
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "cube" / "year=2002").glob("*.parquet")}
    _write(spark, arrivals, "20011230", [(1, 10.0), (3, 7.0)])  # once more, and corrected
    take()
    _write(spark, arrivals, "20011229", [(1, 5.0), (1, 5.0)])  # late, with a repeated row
    take()
    want = {(1, "2001-12-30"): 10.0, (2, "2001-12-30"): None, (3, "2001-12-30"): 7.0, (1, "2002-01-01"): 3.0, (1, "2001-12-29"): 5.0}
    assert _cube(spark, cube) == want and spark.read.parquet(cube).count() == len(want)
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "cube" / "year=2002").glob("*.parquet")} == untouched  # other years aren't written again
    take()
    assert _cube(spark, cube) == want
    # the last batch once more, as after a failure before its commit
    day = F.try_to_date(F.regexp_extract("_metadata.file_path", ingest.DAY_IN_PATH, 1), "yyyyMMdd")
    again = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(arrivals).select("*", day.alias("date"), F.struct(F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("path")).alias("arrived")).filter("date = date'2001-12-29'")
    ingest.merge_days(again, cube, ("location_id",))
    ingest.merge_days(again.limit(0), cube, ("location_id",))
    assert _cube(spark, cube) == want


@pytest.mark.parametrize(("path", "day"), [("/a/20010203/x-12345678-9.parquet", "20010203"), ("/20010203/a/b/x.nc", None), ("/a/day=20010203/part-0.parquet", "20010203"), ("/b/pr_20010203.nc", "20010203"), ("/b/20010203.csv", "20010203"), ("/b/x120010203.nc", None), ("/b/day=20010203/part-00000-ab12.snappy.parquet", "20010203")])
def test_days_in_paths(spark, path, day):
    found = spark.range(1).select(F.regexp_extract(F.lit(path), ingest.DAY_IN_PATH, 1).alias("x")).first().x
    assert (found or None) == day


def _brute(days: dict[int, bool]) -> set[tuple[int, int]]:
    out, first = set(), None
    for d in sorted(days):
        begins = not days.get(d - 1, False) or (EPOCH + timedelta(days=d)).timetuple().tm_yday == 1
        if days[d]:
            first = d if begins else first
            ends = not days.get(d + 1, False) or (EPOCH + timedelta(days=d + 1)).timetuple().tm_yday == 1
            if ends:
                out.add((first, d))
    return out


def test_spells_do_not_depend_on_the_order_of_days():
    rng = random.Random(2)
    for _ in range(200):
        days = {360 + k: rng.random() < 0.7 for k in range(40) if rng.random() < 0.95}
        order = sorted(days, key=lambda d: d + rng.uniform(0, 5))
        spell, found, latest = spells.Spell(None, None, None, {}), [], 0
        for at in range(0, len(order), 4):
            for d in order[at : at + 4]:
                spell.add(d, days[d])
                latest = max(latest, d)
            found += spell.close(latest - 5)
            spell = spells.Spell(spell.first, spell.last, spell.closed, dict(spell.waiting))
        found += spell.close(10_000)
        assert len(found) == len(set(found)) and set(found) == _brute(days)
    late = spells.Spell(None, None, 100, {})
    late.add(100, True)
    late.add(101, True)
    late.add(101, False)
    assert late.waiting == {101: False}


def test_spells_of_a_stream(spark, tmp_path):
    rng = random.Random(3)
    rows = [(s, c, date(1999, 11, 1) + timedelta(days=k), None if rng.random() < 0.1 else rng.choice([0.0, 2.0, 3.0])) for s in ("a", "b") for c in (1, 2) for k in range(120)]
    order = sorted(rows, key=lambda r: r[2] + timedelta(days=rng.randrange(4)))
    ddl = "sim_code string, location_id int, date date, pr double"
    ends = [(s, c, date(2000, 6, 1), 0.0) for s in ("a", "b") for c in (1, 2)]
    for k in range(0, len(order), 96):
        spark.createDataFrame(order[k : k + 96], ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / "days"))
    spark.createDataFrame(ends, ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / "days"))
    keys = ("sim_code", "location_id")
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "days"))
    query = spells.spells(stream, "pr >= 2", keys, "5 days").writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).format("parquet").start(str(tmp_path / "out"))
    query.awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out"))
    want = runs.run_events(spark.createDataFrame(rows, ddl), "pr >= 2", 2, keys)
    got = found.filter("length >= 2").groupBy(*keys, "year").agg(F.count(F.lit(1)).alias("value"))
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.filter("value > 0").collect()}
    assert found.filter("datediff(end, start) + 1 <> length or year(start) <> year or year(end) <> year").count() == 0
