"""Payload parsing and encoding (JVM-side built-ins only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ISO-8601 with microseconds: the default JSON timestamp format keeps milliseconds only,
# which would silently truncate event times on a round trip.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
JSON_OPTIONS = {"timestampFormat": ISO_MICROS}

# Whitespace that separates words (an explicit class, the same in every regex dialect).
WORD_SPLIT = "[ \t\n\r\f]+"


def to_json_payload(cols: Sequence[str | Column]) -> Column:
    """Object -> JSON text with ISO-8601 timestamps."""
    return F.to_json(F.struct(*cols), JSON_OPTIONS)


def parse_json(text: Column, schema: T.StructType, corrupt_col: str | None = None) -> Column:
    """JSON text -> struct. Malformed text gives a struct of nulls (PERMISSIVE); with
    ``corrupt_col`` (a string field present in ``schema``) the raw text is kept there."""
    opts = dict(JSON_OPTIONS)
    if corrupt_col:
        opts["columnNameOfCorruptRecord"] = corrupt_col
    return F.from_json(text, schema, opts)


def parse_csv_line(value: Column, fields: Sequence[tuple[str, str]], sep: str = ",") -> list[Column]:
    """``"a,b,..."`` -> typed columns. Bad numbers become null (``try_cast``) instead of
    failing the query under ANSI mode; callers filter nulls explicitly."""
    parts = F.split(value, sep)
    # get() gives null for a missing field (getItem raises under ANSI mode)
    return [(F.get(parts, i) if t == "string" else F.get(parts, i).try_cast(t)).alias(n)
            for i, (n, t) in enumerate(fields)]


def words(text: Column) -> Column:
    """Whitespace-separated tokens of a text (the first or last may be empty)."""
    return F.split(text, WORD_SPLIT)
