"""Daily fixtures: one cell, the calendar years 1981 and 1982, a base value and assigned ranges."""

from __future__ import annotations

from datetime import date, timedelta

FIRST, LAST = date(1981, 1, 1), date(1982, 12, 31)


def day(text: str) -> date:
    """"d/m" of 1981, with a quote of 1982."""
    d, m = text.rstrip("'").split("/")
    return date(1982 if text.endswith("'") else 1981, int(m), int(d))


def series(assigned: str = "", base: float = 0.0) -> dict[date, float]:
    """Assignments as "1/3-31/3=1.01, 1/4=5"; an unquoted end of a range takes the year of its begin unless it lies before."""
    out = {FIRST + timedelta(days=k): float(base) for k in range((LAST - FIRST).days + 1)}
    for part in filter(None, (p.strip() for p in assigned.split(","))):
        span, value = part.split("=")
        a, _, b = span.partition("-")
        at, end = day(a), day(b or a)
        while at <= end:
            out[at] = float(value)
            at += timedelta(days=1)
    return out


def rows(cases: dict[str, dict[date, float]]) -> list[tuple]:
    return [(name, d, v) for name, values in cases.items() for d, v in values.items()]


# Fixed value: the profile of amounts that golden cases of the rain season share.
PROFILE = "1/1-31/3=1.01, 1/4-3/4=5.01, 4/4-13/4=1.01, 14/4-22/4=0.99, 23/4-3/5=1.01, 4/5-15/10=5.01, 16/10=4.01, 17/10=3.01, 18/10=2.01, 19/10=1.01"
