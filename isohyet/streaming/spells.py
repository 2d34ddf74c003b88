"""Spells of days that meet a condition, told as soon as they are over, from days that arrive in any order."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_DAY_MS = 86_400_000
_EPOCH = date(1970, 1, 1)


class Spell:
    """The open spell of one series, and the days that may still get earlier ones beside them.

    Days are numbers since 1970. A spell ends at a day that fails, at a day that is missing and at the new year.
    """

    def __init__(self, first: int | None, last: int | None, closed: int | None, waiting: dict[int, bool]):
        self.first, self.last, self.closed, self.waiting = first, last, closed, waiting

    def add(self, day: int, ok: bool) -> None:
        """A day; days that are closed already come too late, and of a repeated day what fails counts."""
        if self.closed is None or day > self.closed:
            self.waiting[day] = self.waiting.get(day, True) and ok

    def close(self, until: int) -> Iterator[tuple[int, int]]:
        """Spells that are over once all days before a given one are known."""
        for day in sorted(d for d in self.waiting if d < until):
            ok = self.waiting.pop(day)
            new_year = (_EPOCH + timedelta(days=day)).timetuple().tm_yday == 1
            if self.first is not None and (not ok or day != self.last + 1 or new_year):
                yield self.first, self.last
                self.first = None
            if ok:
                self.first = day if self.first is None else self.first
                self.last = day
        if self.first is not None and until > self.last + 1 and not any(d == self.last + 1 for d in self.waiting):
            yield self.first, self.last
            self.first = None
        self.closed = max(until - 1, self.closed if self.closed is not None else until - 1)


_STATE = "first long, last long, closed long, days array<long>, ok array<boolean>"


def spells(days: DataFrame, condition: Column | str, keys: tuple[str, ...] = ("location_id",), late: str = "5 days", date_column: str = "date") -> DataFrame:
    """keys, year, start, end, length of each spell that is over, for append output.

    A day may arrive as long as the watermark, the latest day less `late`, hasn't passed it; then it is merged where it
    belongs. State of a series: its open spell, and the days of the last `late`. A day without a value fails.
    """
    ok = F.expr(condition) if isinstance(condition, str) else condition
    read = days.select(*keys, F.col(date_column).cast("timestamp").alias("day"), F.coalesce(ok, F.lit(False)).alias("ok")).withWatermark("day", late)
    types = dict(days.dtypes)
    out = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "year int", "start date", "end date", "length long"])

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.getOption
        spell = Spell(None, None, None, {}) if held is None else Spell(held[0], held[1], held[2], dict(zip(held[3], held[4], strict=True)))
        for frame in frames:
            for day, good in zip(frame["day"], frame["ok"], strict=True):
                spell.add((pd.Timestamp(day).date() - _EPOCH).days, bool(good))
        until = state.getCurrentWatermarkMs() // _DAY_MS
        over = list(spell.close(until)) if until > 0 else []
        order = sorted(spell.waiting)
        state.update((spell.first, spell.last, spell.closed, order, [spell.waiting[d] for d in order]))
        if order or spell.first is not None:  # looked at again once the watermark has passed the next day that matters
            following = min([*order, *([spell.last + 1] if spell.first is not None else [])])
            state.setTimeoutTimestamp(max((following + 1) * _DAY_MS, state.getCurrentWatermarkMs() + 1))
        if over:
            day = lambda n: _EPOCH + timedelta(days=int(n))
            yield pd.DataFrame([(*key, day(a).year, day(a), day(b), b - a + 1) for a, b in over], columns=[*keys, "year", "start", "end", "length"])

    return read.groupBy(*keys).applyInPandasWithState(step, out, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
