"""Golden values of dry spells and the rain season."""

from __future__ import annotations

from datetime import date, timedelta

import pytest

from isohyet.model import doy_of
from isohyet.operators import indices, rainseason
from tests.daily import PROFILE, rows, series


def _df(spark, cases):
    return spark.createDataFrame(rows(cases), "location_id string, date date, pr double")


def _got(df, years=(1981, 1982)):
    out = {}
    for r in df.collect():
        out.setdefault(r.location_id, {})[r.year] = r.value
    return {k: tuple(v.get(y) for y in years) for k, v in out.items()}


def _season(text):
    first, _, last = text.partition(" ")
    return (doy_of(first) if first != "-" else -1), (doy_of(last) if last != "-" else -1)


# Golden cases of the definition of dry spells: case, op, threshold, window, season, base amount, assigned
# amounts, and the days of the index in 1981 and 1982.
DRY = [
    (5, "max", 1, 14, "03-01 11-30", 1, "1/3-14/3=0", (14, 0)), (6, "max", 1, 14, "03-01 11-30", 1, "1/3-13/3=0", (0, 0)), (7, "max", 1, 14, "03-01 11-30", 1, "1/3-7/3=0, 9/3-15/3=0", (0, 0)),
    (8, "max", 1, 14, "03-01 11-30", 1, "28/2-13/3=0", (13, 0)), (9, "max", 1, 14, "03-01 11-30", 1, "18/11-1/12=0", (13, 0)), (10, "max", 1, 14, "03-01 11-30", 1, "1/3-14/3=0, 1/8-14/8=0", (28, 0)),
    (11, "max", 1, 14, "12-01 02-28", 1, "1/3-14/3=0", (0, 0)), (12, "max", 1, 14, "12-01 02-28", 1, "1/3-13/3=0", (0, 0)), (13, "max", 1, 14, "12-01 02-28", 1, "1/3-7/3=0, 9/3-15/3=0", (0, 0)),
    (14, "max", 1, 14, "12-01 02-28", 1, "28/2-13/3=0", (1, 0)), (15, "max", 1, 14, "12-01 02-28", 1, "18/11-1/12=0", (1, 0)), (16, "max", 1, 14, "12-01 02-28", 1, "1/3-14/3=0, 1/8-14/8=0", (0, 0)),
    (17, "max", 1, 14, "- -", 1, "1/3-14/3=0", (14, 0)), (18, "max", 1, 14, "03-01 -", 1, "1/3-14/3=0", (14, 0)), (19, "max", 1, 14, "- 11-30", 1, "1/3-14/3=0", (14, 0)),
    (20, "max", 1, 14, "03-01 -", 1, "22/2-7/3=0", (7, 0)), (21, "max", 1, 14, "- 11-30", 1, "24/11-7/12=0", (7, 0)), (22, "max", 1, 14, "12-01 01-31", 1, "1/1-14/1=0", (14, 0)),
    (23, "max", 1, 14, "12-01 01-31", 1, "18/12'-31/12'=0", (0, 14)), (24, "max", 3, 3, "- -", 3, "1/3-3/3=1, 1/6-2/6=1, 1/9-3/9=1, 1/3'-3/3'=1, 1/6'-2/6'=1, 1/9'-3/9'=1", (6, 6)),
    (25, "sum", 14, 14, "- -", 0, "", (365, 365)), (26, "sum", 14, 14, "- -", 0, "1/3=13", (365, 365)), (27, "sum", 14, 14, "- -", 0, "1/3=14", (364, 365)), (28, "sum", 14, 14, "- -", 0, "1/3-3/3=7", (364, 365)),
    (29, "sum", 14, 14, "- -", 0, "1/3-14/3=1", (365, 365)), (30, "sum", 14, 14, "- -", 0, "25/12-7/1'=1", (365, 365)), (31, "sum", 14, 14, "- -", 0, "25/12-7/1'=14", (358, 358)),
    (32, "sum", 15, 15, "- -", 0, "1/3-15/3=3", (358, 365)), (33, "sum", 3, 3, "- -", 0, "1/3-9/3=1", (360, 365)),
]


def test_dry_spells(spark):
    groups: dict[tuple, dict] = {}
    for case, op, threshold, window, season, base, assigned, expected in DRY:
        groups.setdefault((op, threshold, window, season), {})[str(case)] = (series(assigned, base), expected)
    for (op, threshold, window, season), cases in groups.items():
        df = _df(spark, {k: v for k, (v, _) in cases.items()})
        got = _got(indices.dry_spell_total_length(df, float(threshold), window, op, *_season(season)))
        assert got == {k: e for k, (_, e) in cases.items()}, (op, threshold, window, season)


# Golden cases of the definition of dry spells over short series.
@pytest.mark.parametrize("values, expected", [
    ([1.01] * 6 + [0.01] * 3 + [0.51] * 2 + [0.75] * 2 + [0.51] + [0.01] * 3 + [1.01] * 3, {"max": 20, "sum": 12}),
    ([0.01] * 6 + [1.01] * 3 + [0.51] * 2 + [0.75] * 2 + [0.51] + [0.01] * 6, {"max": 20, "sum": 18}),
])
def test_short_dry_spells(spark, values, expected):
    df = spark.createDataFrame([("a", date(2000, 7, 1) + timedelta(days=k), v) for k, v in enumerate(values)], "location_id string, date date, pr double")
    for op, days in expected.items():
        assert _got(indices.dry_spell_total_length(df, 3.0, 7, op), (2000,)) == {"a": (days,)}


@pytest.mark.parametrize("op, threshold", [("max", 1.0), ("sum", 14.0)])
def test_dry_spell_across_new_year(spark, op, threshold):
    values = [threshold + 0.01] * 358 + [0.99] * 14 + [threshold + 0.01] * 358
    df = spark.createDataFrame([("a", date(1981, 1, 1) + timedelta(days=k), v) for k, v in enumerate(values)], "location_id string, date date, pr double")
    assert _got(indices.dry_spell_total_length(df, threshold, 14, op, *_season("12-01 01-31"))) == {"a": (7, 7)}


# Golden cases of the definition of the season's start: season, and by case the assigned amounts and the day
# of year in 1981 (none in 1982).
STARTS = [
    ("03-01 12-31", {"1": (PROFILE, 91), "3": ("1/4-3/4=5, 4/4-3/5=1", 91), "4": ("1/4-3/4=5, 4/4-13/4=1, 23/4-3/5=1", 91), "5": ("1/4-3/4=5, 4/4-13/4=1, 24/4-3/5=1", None), "6": ("1/4-2/4=5, 4/4-13/4=1, 23/4-3/5=1", None),
                     "7": ("1/4-3/4=5, 4/4-28/4=1", 91), "8": ("1/4-3/4=5, 4/4-8/4=1, 14/4-23/4=1, 29/4-3/5=1", 91), "9": ("1/4-2/4=5, 4/4-3/5=1, 1/6-3/6=5, 4/6-3/7=1", 152), "12": ("1/4=15, 3/4-22/4=1", 91), "13": ("1/4=15, 3/4-21/4=1", None)}),
    ("04-04 12-31", {"10": ("1/4-3/4=5, 4/4-3/5=1", None)}),
    ("09-01 06-30", {"11": ("1/10-3/10=5, 4/10-2/11=1", 274)}),
]


@pytest.mark.parametrize("season, cases", STARTS)
def test_rain_season_starts(spark, season, cases):
    df = _df(spark, {k: series(v) for k, (v, _) in cases.items()})
    got = _got(rainseason.start(df, 15.0, 3, 1.0, 10, 30, *_season(season)))
    assert got == {k: (e, None) for k, (_, e) in cases.items()}


# Golden cases of the definition of the season's end: op, threshold, season, rate, and by case the assigned
# amounts and the days of year in 1981 and 1982.
ENDS = [
    ("max", 5.0, "09-01 12-31", 5.0, {"1": (PROFILE, 288, None), "3": ("", None, None), "11": ("1/4-30/9=5", 273, None), "12": ("1/4-31/8=5", None, None), "13": ("1/4-30/9=2.5", 244, None), "14": ("1/4-15/10=5", 288, None)}),
    ("sum", 70.0, "09-01 12-31", 5.0, {"1": (PROFILE, 275, None), "3": ("", None, None), "17": ("1/4-30/9=70", 273, None), "18": ("1/4-30/9=70, 1/10=70", 274, None), "19": ("1/4-30/9=70, 8/10=70", 281, None)}),
    # case 1 is 305 where sums are rounded; of exact sums the day after is the first
    ("etp", 70.0, "09-01 12-31", 5.0, {"1": (PROFILE, 306, None), "3": ("", None, None), "5": ("1/4-30/9=5", 287, None), "6": ("1/4-30/9=5, 1/10-31/12=2.5", 301, None)}),
    ("etp", 70.0, "09-01 12-31", 0.0, {"7": ("1/4-30/9=5", None, None)}),
    ("etp", 70.0, "09-01 12-31", 10.0, {"8": ("1/4-30/9=5", 280, None), "9": ("1/4-30/9=5, 3/10-4/10=10", 284, None)}),
    ("etp", 70.0, "06-01 03-31", 5.0, {"10": ("1/10-16/12=5, 1/1'-15/1'=5", None, 29)}),
    ("max", 5.0, "09-01 12-16", 5.0, {"15": ("1/4-31/8=5, 17/12-31/12=5", None, None)}),
    ("max", 5.0, "06-01 03-31", 5.0, {"16": ("1/4-24/12=5, 7/1'=5", None, 7)}),
    ("sum", 70.0, "06-01 03-31", 5.0, {"20": ("1/4-24/12=70", 358, None), "21": ("1/4-24/12=70, 7/1'=70", None, 7)}),
]


@pytest.mark.parametrize("op, threshold, season, rate, cases", ENDS)
def test_rain_season_ends(spark, op, threshold, season, rate, cases):
    df = _df(spark, {k: series(v) for k, (v, _, _) in cases.items()})
    got = _got(rainseason.end(df, op, threshold, 14, rate, *_season(season)))
    assert got == {k: (a, b) for k, (_, a, b) in cases.items()}


@pytest.mark.parametrize("op, threshold, rate", [("max", 5.0, 5.0), ("sum", 70.0, 5.0), ("etp", 70.0, 5.0)])
def test_no_end_in_steady_rain(spark, op, threshold, rate):
    df = _df(spark, {"4": series("", 5.0)})
    assert _got(rainseason.end(df, op, threshold, 14, rate, *_season("09-01 12-31"))) == {"4": (None, None)}


# Golden cases of the definition of the season's length and amount: case, assigned amounts, base amount,
# and starts, ends, lengths and amounts in 1981 and 1982.
LENGTHS = [
    ("1", PROFILE, 0.0, (91, None), (288, None), (198, None), (871, None)),
    ("3", "", 1.0, (91, 92), (273, 272), (183, 181), (183, 181)),
    ("4", "", 1.0, (273, None), (None, 91), (184, None), (184, None)),
    ("5", "", 1.0, (273, 273), (91, 91), (184, None), (184, None)),
    ("6", "", 1.0, (None, 91), (273, None), (None, None), (None, None)),
    ("7", "", 1.0, (91, None), (90, None), (None, None), (None, None)),
]


@pytest.mark.parametrize("case, assigned, base, starts, ends, length, amount", LENGTHS)
def test_length_and_amount(spark, case, assigned, base, starts, ends, length, amount):
    pr = _df(spark, {case: series(assigned, base)})
    a, b = (spark.createDataFrame([(case, 1981, x[0]), (case, 1982, x[1])], "location_id string, year int, value int") for x in (starts, ends))
    assert _got(rainseason.length(a, b)) == {case: length}
    assert _got(rainseason.amount(pr, a, b)) == {case: amount}
    if case == "5":  # the same days of the following year
        assert _got(rainseason.amount(pr, a, b, next_year=True)) == {case: amount}


# Golden cases of a whole season, with its start, end, length and amount in 1981.
CHAIN = "1/1-31/3=1.01, 1/4-3/4=5.01, 4/4-13/4=1.01, 14/4-22/4=0.99, 23/4-3/5=1.01, 4/5-15/10=5, 16/10=4, 17/10=3, 18/10=2, 19/10=1"


@pytest.mark.parametrize("assigned, end, next_start, expected", [
    (CHAIN, {"op": "max", "threshold": 5.0, "window": 14}, None, (91, 288, 198, 870)),
    ("1/4-3/4=5, 4/4-30/9=1", {"op": "sum", "threshold": 14.0, "window": 14}, None, (91, 260, 170, 182)),
    ("1/4-3/4=5, 4/4-30/9=1", {"op": "sum", "threshold": 14.0, "window": 14}, "09-05", (91, 247, 157, 169)),
])
def test_chain(spark, assigned, end, next_start, expected):
    pr = _df(spark, {"a": series(assigned)})
    nxt = spark.createDataFrame([("a", 1981, doy_of(next_start))], "location_id string, year int, value int") if next_start else None
    start = {"wet_amount": 15.0, "wet_window": 3, "dry_threshold": 1.0, "dry_days": 10, "dry_window": 30, "first": doy_of("03-01"), "last": doy_of("12-31")}
    row = rainseason.season(pr, start, {**end, "first": doy_of("09-01"), "last": doy_of("12-31")}, nxt).filter("year = 1981").first()
    assert (row["start"], row["end"], row["length"], row["amount"]) == expected
