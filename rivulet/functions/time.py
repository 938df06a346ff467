"""Time helpers: epoch conversions (exact, hash-stable outputs) and millis parsing."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def epoch_seconds(c: Column | str) -> Column:
    """Whole epoch seconds of a timestamp (window bounds are whole seconds)."""
    return F.unix_seconds(F.col(c) if isinstance(c, str) else c)


def epoch_micros(c: Column | str) -> Column:
    """Exact epoch microseconds of a timestamp."""
    return F.unix_micros(F.col(c) if isinstance(c, str) else c)


def millis_to_timestamp(c: Column | str) -> Column:
    """Epoch millis to timestamp on the JVM side (no UDF needed)."""
    return F.timestamp_millis(F.col(c) if isinstance(c, str) else c)


@F.pandas_udf(T.TimestampType())
def millis_to_timestamp_udf(ms: pd.Series) -> pd.Series:
    """The same conversion as an Arrow-batched pandas UDF, for callers whose
    conversion logic is not expressible with built-ins (one call per batch, not per row)."""
    return pd.to_datetime(ms, unit="ms", utc=True)
