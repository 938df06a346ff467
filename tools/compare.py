"""Order-insensitive result comparison shared by tools/check.py and the tests."""

from __future__ import annotations

import math

import pandas as pd


def norm(v):
    try:
        if v is None or v is pd.NA or (not isinstance(v, (str, bytes, list, tuple)) and pd.isna(v)):
            return None
    except (TypeError, ValueError):
        pass
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, float) and v.is_integer() and abs(v) < 2**53:
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


def rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))
