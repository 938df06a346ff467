"""Operator 7, substring dedup: super-k-mer partitioning.

A window is ``WINDOW`` consecutive words. Its minimiser is the smallest hash among its
``GRAM``-word runs, so equal windows have equal minimisers, and consecutive windows mostly
share one. A maximal run of consecutive windows with the same minimiser (a super-k-mer)
travels as one packed string, its words once, to the bucket that the minimiser names,
instead of a record per window. All occurrences of a window meet in one bucket, where
sorting counts them exactly: windows are sorted by fingerprint and equal neighbours are
compared word by word.

Skew: a passage that very many documents share gives them one minimiser. Misra-Gries
counters (``DataFrame.freqItems``) find the minimisers with more than ``1/HOT`` of all
runs; at most ``HOT`` of them, a proven size, are sent with the task, and windows under
such a minimiser are dealt one by one by a hash of the whole window. Equal runs of a slice
travel once, with their places.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rivulet.llm.common import flat_words, mix64, stored, text_slices, whole_text, word_hashes

WINDOW = 35
GRAM = 4
#: Runs in a bucket, on average; their number sets how many buckets there are.
RUNS_PER_BUCKET = 16_000
HOT = 5_000
#: Text bytes whose runs are grouped together on the sending side.
SLICE = 8 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive entries of ``h`` (their order counts)."""
    if len(h) < width:
        return np.zeros(0, np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * _powers(_BASE, len(h)), dtype=np.uint64)])
    n = len(h) - width + 1
    return mix64((total[width:] - total[:-width]) * _powers(_BASE_INVERSE, n))


def _minimisers(doc: np.ndarray, h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, minimiser) of every window that lies within one document."""
    grams = _rolling(h, GRAM)
    low, reach, span = grams, 1, window - GRAM + 1
    while reach < span:  # low[i] is the least of grams[i : i + reach]
        step = min(reach, span - reach)
        low = np.minimum(low[:-step], low[step:]) if len(low) > step else low[:0]
        reach += step
    at = np.arange(len(low))
    at = at[doc[:len(low)] == doc[window - 1:window - 1 + len(low)]]
    return at, low[at]


def _runs(doc: np.ndarray, at: np.ndarray, least: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """Index in ``at`` where each run starts; ``alone`` marks windows dealt one by one."""
    if len(at) == 0:
        return np.zeros(0, np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1) | alone[1:] | (doc[at[1:]] != doc[at[:-1]])
    return np.flatnonzero(new)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_key`` tells rows apart that differ in id or text. Rows that agree in both have the
    same windows and lose the same words, so they may share one."""
    text = whole_text(text_col)
    key = F.unhex(F.md5(F.concat_ws("\x00", F.coalesce(F.col(id_col).cast("string"), F.lit("\x01")), text)))
    return docs.select(F.col(id_col).alias("_id"), text.alias("_text"), key.alias("_key"))


def _send(part: pa.RecordBatch, hot: np.ndarray, n_buckets: int, window: int) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed runs) of a slice. A packet is: counts, document keys, then per place
    (document, first word, run) and per run (windows), then the words of the runs."""
    doc, code, distinct = flat_words(part.column("_text"))
    h = word_hashes(distinct)[code]
    at, least = _minimisers(doc, h, window)
    if len(at) == 0:
        return
    alone = np.isin(least, hot) if len(hot) else np.zeros(len(at), bool)
    first = _runs(doc, at, least, alone)
    size = np.diff(np.append(first, len(at)))
    deal = least[first].copy()
    single = alone[first]
    if single.any():
        deal[single] = _rolling(h, window)[at[first[single]]]
    bucket = (mix64(deal) % np.uint64(n_buckets)).astype(np.int64)

    # the words of a slice in one buffer, each followed by a space: a run is a slice of it
    ended = pc.binary_join_element_wise(distinct.cast(pa.large_string()), *(pa.scalar(x, pa.large_string()) for x in ("", " ")))
    spaced = ended.take(pa.array(code))
    _, offs, data = spaced.buffers()
    edge = np.frombuffer(offs, np.int64)[spaced.offset:spaced.offset + len(spaced) + 1]
    text = memoryview(data)
    begin = at[first]
    lo, hi = edge[begin].tolist(), edge[begin + size + window - 1].tolist()
    doc_start = np.searchsorted(doc, np.arange(part.num_rows))
    keys = part.column("_key")
    press = zstandard.ZstdCompressor(level=3)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for group in np.split(order, cuts):
        seen: dict[bytes, int] = {}
        which = np.fromiter((seen.setdefault(bytes(text[lo[r]:hi[r]]), len(seen)) for r in group.tolist()),
                            np.uint32, len(group))
        owners, local = np.unique(doc[begin[group]], return_inverse=True)
        wins = np.zeros(len(seen), np.uint32)
        wins[which] = size[group]
        body = b"".join([
            struct.pack("<3I", len(owners), len(group), len(seen)),
            b"".join(keys.take(pa.array(owners)).to_pylist()), local.astype(np.uint32).tobytes(),
            (begin[group] - doc_start[doc[begin[group]]]).astype(np.uint32).tobytes(),
            which.tobytes(), wins.tobytes(), *seen])
        yield int(bucket[group[0]]), press.compress(body)


def _receive(packets: list[bytes], window: int):
    """All packets of a bucket: (keys, document, first word and run of each place, windows
    of each run, the runs' words as one byte string)."""
    press = zstandard.ZstdDecompressor()
    parts, n_docs, n_runs = [], 0, 0
    for p in packets:
        b = press.decompress(p)
        docs, places, runs = struct.unpack_from("<3I", b)
        o = 12 + 16 * docs
        a = np.frombuffer(b, np.uint32, 3 * places + runs, o).astype(np.int64)
        parts.append((b[12:o], a[:places] + n_docs, a[places:2 * places], a[2 * places:3 * places] + n_runs,
                      a[3 * places:], b[o + 4 * (3 * places + runs):]))
        n_docs, n_runs = n_docs + docs, n_runs + runs
    keys, doc, pos, run, wins, text = zip(*parts)
    return b"".join(keys), *(np.concatenate(x) for x in (doc, pos, run, wins)), b"".join(text)


def _repeated(code: np.ndarray, at: np.ndarray, weight: np.ndarray, window: int) -> np.ndarray:
    """Which windows (starting at ``at`` in ``code``) occur more than once. They are sorted
    by fingerprint; equal neighbours are compared word by word, and should two different
    windows ever share a fingerprint, that fingerprint's windows are told apart exactly."""
    print_ = _rolling(mix64(code.astype(np.uint64) + np.uint64(1)), window)[at]
    order = np.argsort(print_, kind="stable")
    twin = np.flatnonzero(print_[order[1:]] == print_[order[:-1]])
    twice = weight > 1
    for chunk in np.array_split(twin, max(1, len(twin) // 50_000)):
        a, b = order[chunk], order[chunk + 1]
        same = np.ones(len(chunk), bool)
        for k in range(window):
            same &= code[at[a] + k] == code[at[b] + k]
        twice[a[same]] = True
        twice[b[same]] = True
        for clash in np.unique(print_[a[~same]]):
            mine = np.flatnonzero(print_ == clash)
            rows = np.stack([code[at[mine] + k] for k in range(window)], 1)
            _, which, n = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
            twice[mine] |= n[which.ravel()] > 1
    return twice


def _count(packets: list[bytes], window: int) -> pa.Table:
    """Words ``[start, stop)`` of documents that repeated windows of one bucket cover."""
    keys, doc, pos, run, wins, text = _receive(packets, window)
    words = pc.split_pattern(pa.array([text], pa.large_binary()).cast(pa.large_string()), " ").flatten()
    code = words.slice(0, len(words) - 1).dictionary_encode().indices.to_numpy().astype(np.int64)
    begin = np.cumsum(wins + window - 1) - (wins + window - 1)
    of = np.repeat(np.arange(len(wins)), wins)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(wins) - wins, wins)
    twice = _repeated(code, begin[of] + nth, np.bincount(run, minlength=len(wins))[of], window)
    # repeated windows in a row, per run, as stretches of words
    hit = np.flatnonzero(twice)
    new = np.ones(len(hit), bool)
    new[1:] = (hit[1:] != hit[:-1] + 1) | (of[hit[1:]] != of[hit[:-1]])
    lead = np.flatnonzero(new)
    tail = (np.append(lead[1:], len(hit)) - 1)[:len(lead)]
    s_run, s_from, s_to = of[hit[lead]], nth[hit[lead]], nth[hit[tail]] + window
    # every place of a run gets its stretches
    per = np.bincount(s_run, minlength=len(wins))
    base = np.cumsum(per) - per
    n = per[run]
    place = np.repeat(np.arange(len(run)), n)
    s = np.repeat(base[run], n) + np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n)
    all_keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(keys) // 16, [None, pa.py_buffer(keys)])
    return pa.table({"_key": all_keys.take(pa.array(doc[place])).cast(pa.binary()),
                     "start": pa.array((pos[place] + s_from[s]).astype(np.int32)),
                     "stop": pa.array((pos[place] + s_to[s]).astype(np.int32))})


def repeated_stretches(keyed: DataFrame, window: int = WINDOW, runs_per_bucket: int = RUNS_PER_BUCKET) -> DataFrame:
    """``_key, start, stop``: the words of each document that repeated windows cover."""
    def scout(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "_text", SLICE):
                doc, code, distinct = flat_words(part.column("_text"))
                at, least = _minimisers(doc, word_hashes(distinct)[code], window)
                first = _runs(doc, at, least, np.zeros(len(at), bool))
                yield pa.record_batch({"least": pa.array(least[first].view(np.int64))})

    seen = Observation()
    found = (keyed.select("_text").mapInArrow(scout, "least long")
             .observe(seen, F.count(F.lit(1)).alias("runs")).freqItems(["least"], 1 / HOT).first())
    hot = np.unique(np.array(found[0] or [], np.int64)).view(np.uint64)  # at most HOT numbers
    n_buckets = max(1, -(-seen.get["runs"] // runs_per_bucket))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "_text", SLICE):
                rows = list(_send(part, hot, n_buckets, window))
                yield pa.record_batch({"bucket": pa.array([b for b, _ in rows], pa.int64()),
                                       "runs": pa.array([r for _, r in rows], pa.binary())})

    def count(table: pa.Table) -> pa.Table:
        return _count(table.column("runs").to_pylist(), window)

    return (keyed.select("_key", "_text").mapInArrow(send, "bucket long, runs binary")
            .groupBy("bucket").applyInArrow(count, "_key binary, start int, stop int"))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW, with_text: bool = False,
                    runs_per_bucket: int = RUNS_PER_BUCKET) -> DataFrame:
    """One row per document: ``id_col, n_words, n_removed, kept_sha256`` (``kept_text`` too
    on request): the words not covered by any window that starts in more than one place.

    A null text has no words; texts shorter than a window lose nothing; repeated rows are
    different places, so each loses what they share; other columns are ignored; an empty
    table gives an empty result."""
    keyed = _keyed(docs, id_col, text_col)
    cover = stored(repeated_stretches(keyed, window, runs_per_bucket), "substring-stretches")
    cover = cover.groupBy("_key").agg(F.collect_set(F.struct("start", "stop")).alias("cover"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            plain = batch.column("_text").cast(pa.large_binary())
            texts = [press.compress(t.as_buffer()) for t in plain]
            yield pa.record_batch({"_id": batch.column("_id"), "_key": batch.column("_key"), "_text": pa.array(texts, pa.binary()),
                                   "_size": pc.binary_length(plain).cast(pa.int64())})

    # texts meet their stretches compressed: the shuffle carries half the bytes. They are
    # unpacked in slices of their plain size, which a repeated word hides
    packed = keyed.select("_id", "_key", F.col("_text").cast("binary").alias("_text"), F.lit(0).cast("long").alias("_size"))
    packed = keyed.select("_id", "_key", "_text").mapInArrow(pack, packed.schema)
    wide = packed.join(cover, "_key", "left").select("_id", "_text", "_size", "cover")
    out = wide.select("_id", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"),
                      F.lit("").alias("kept_sha256"), *([F.lit("").alias("kept_text")] if with_text else [])).schema

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            for part in text_slices(batch, "_size", 2 << 20):
                texts = pa.array([press.decompress(t.as_buffer()) for t in part.column("_text")], pa.large_binary())
                doc, code, distinct = flat_words(texts)
                start = np.searchsorted(doc, np.arange(part.num_rows + 1))
                lists = part.column("cover")
                p = lists.flatten()
                row = np.repeat(np.arange(part.num_rows), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
                depth = np.zeros(len(doc) + 1, np.int64)
                np.add.at(depth, start[row] + p.field("start").to_numpy(), 1)
                np.add.at(depth, start[row] + p.field("stop").to_numpy(), -1)
                gone = np.cumsum(depth)[:-1] > 0
                words = distinct.take(pa.array(code[~gone]))
                n_gone = np.bincount(doc[gone], minlength=part.num_rows)
                n_words = np.diff(start)
                ends = np.concatenate([[0], np.cumsum(n_words - n_gone)])
                kept = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words.cast(pa.string())), " ")
                cols = {"_id": part.column("_id"), "n_words": pa.array(n_words), "n_removed": pa.array(n_gone),
                        "kept_sha256": pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in kept])}
                if with_text:
                    cols["kept_text"] = kept
                yield pa.record_batch(cols)

    return wide.mapInArrow(strip, out).withColumnRenamed("_id", id_col)
