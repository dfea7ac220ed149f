"""Order-insensitive comparison of result tables."""

from __future__ import annotations

import datetime
import math

import pandas as pd


def cell(value) -> str:
    if value is None or value is pd.NA or value is pd.NaT:
        return "null"
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return "null" if math.isnan(value) else repr(float(value) + 0.0)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return str(value)


def rows(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    ordered = frame[sorted(frame.columns)]
    return sorted(tuple(cell(v) for v in r) for r in ordered.itertuples(index=False))
