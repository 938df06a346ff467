"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.session import run_dir
from rivulet.sources.tables import read_table

#: ASCII white space of all word contracts, as a regex class and as characters.
WS = r"[\x20\x09-\x0D]+"
WS_CHARS = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared folder (``spark.checkpoint.dir``) and read it
    back: cuts lineage, survives lost executors, and fixes generated row numbers."""
    path = run_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def words_col(text: Column) -> Column:
    """Array of the words of ``text``; no words give an empty array."""
    trimmed = F.btrim(text, F.lit(WS_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, WS, -1))


# ------------------------------------------------------------------ Arrow and numpy

def text_slices(batch: pa.RecordBatch, col: str = "text",
                max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a record batch into row slices of about ``max_bytes`` of text, so that the
    working arrays stay small whatever the row count (a row is never cut). An integer
    ``col`` holds the sizes themselves, for texts that travel compressed."""
    if batch.num_rows == 0:
        return
    sizes = batch.column(col)
    sizes = sizes if pa.types.is_integer(sizes.type) else pc.binary_length(sizes)
    sizes = pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64) + 64)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def flat_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of a string array: (doc index of each word, code of each word, the distinct
    words that the codes number). Null is a text without words."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat = lists.flatten()
    doc = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    filled = pc.not_equal(flat, "")
    doc = doc[filled.to_numpy(zero_copy_only=False)]
    enc = flat.filter(filled).dictionary_encode()
    return doc, enc.indices.to_numpy().astype(np.int64), enc.dictionary


def bounds(doc: np.ndarray, n: int) -> np.ndarray:
    """Start of each doc's run in a sorted doc index, with the end appended."""
    return np.searchsorted(doc, np.arange(n + 1))


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words = words.cast(pa.large_binary())
    _, offs, data = words.buffers()
    offsets = np.frombuffer(offs, np.int64)[words.offset:words.offset + len(words) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every input bit over the 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(words: pa.Array, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same in every process: bytes and their
    positions are mixed, summed over the word and mixed again."""
    raw, offsets = _bytes_of(words)
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    lens = np.diff(offsets)
    pos = np.arange(len(raw)) - np.repeat(offsets[:-1], lens)
    h = mix64(raw.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
              + pos.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03) + np.uint64(seed + 1))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h, dtype=np.uint64)])
    return mix64(total[offsets[1:]] - total[offsets[:-1]] + lens.astype(np.uint64))
