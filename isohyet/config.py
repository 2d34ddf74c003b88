"""Run parameters from INI files, as frozen values."""

from __future__ import annotations

import ast
from configparser import ConfigParser
from dataclasses import dataclass, field

from isohyet import model


@dataclass(frozen=True)
class Config:
    """What a run needs to know. Sections of the file are flattened; unknown keys are kept under options."""

    reference_period: tuple[int, int] = (1981, 2010)
    future_period: tuple[int, int] = (1981, 2100)
    horizons: tuple[tuple[int, int], ...] = ()
    scenarios: tuple[str, ...] = ()
    variables: tuple[str, ...] = ()
    indices: tuple[str, ...] = ()
    index_parameters: tuple[tuple, ...] = ()
    lon: tuple[float, float] | None = None
    lat: tuple[float, float] | None = None
    excluded_simulations: tuple[str, ...] = ()
    centiles: tuple[float, ...] = (10, 50, 90)
    nq: int = 50
    up_qmf: float = 3.0
    time_window: int = 30
    error_method: str = "rrmse"
    options: dict = field(default_factory=dict, hash=False)

    @property
    def all_horizons(self) -> tuple[tuple[int, int], ...]:
        """The reference period comes first."""
        return (self.reference_period, *(h for h in self.horizons if h != self.reference_period))


def _value(text: str):
    """A Python literal, or the text itself; lists become tuples."""

    def frozen(x):
        return tuple(frozen(v) for v in x) if isinstance(x, (list, tuple)) else x

    try:
        return frozen(ast.literal_eval(text))
    except (ValueError, SyntaxError):
        return text


def parse(text: str) -> Config:
    """From INI text whose keys are the fields of Config; one value where several are expected is a list of one."""
    parser = ConfigParser()
    parser.read_string(text)
    known, options = {}, {}
    for section in parser.sections():
        for key, raw in parser.items(section):
            value = _value(raw)
            if key in Config.__dataclass_fields__ and key != "options":
                if key in ("scenarios", "variables", "indices", "centiles", "excluded_simulations") and not isinstance(value, tuple):
                    value = (value,)
                known[key] = value
            else:
                options[f"{section}.{key}"] = value
    return Config(**known, options=options)


def read(path: str) -> Config:
    with open(path, encoding="utf-8") as file:
        return parse(file.read())


def season_of(first: str, last: str) -> tuple[int, int]:
    """Days of year of "mm-dd" bounds; "nan" or an empty text is open."""
    return tuple(-1 if x in ("", "nan", "None") else model.doy_of(x) for x in (first, last))
