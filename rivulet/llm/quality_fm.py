"""Operator 4, quality classifier: a second-order factorisation machine.

A document is a sparse vector: hashed word counts (square-rooted, unit length), structure
statistics of the text and numeric metadata. Every pair of features interacts through the
inner product of their factor rows, and the sum over all pairs is computed in time linear
in the features: ``sum_{i<j} <v_i,v_j> x_i x_j = (|sum_i v_i x_i|^2 - sum_i |v_i x_i|^2)/2``.

Word splitting and counting run in Arrow and numpy inside the tasks, over whole texts. The
model is fitted in numpy on a bounded sample of labelled rows and has a fixed size (about
``(BUCKETS + STATS) * (FACTORS + 1)`` floats), so it travels with the task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import flat_words, text_slices, whole_text, word_hashes

BUCKETS = 1 << 15
FACTORS = 8
#: Labelled rows used per class at most: those with the smallest hash of their id.
SAMPLE_PER_CLASS = 3000
EPOCHS = 12
KEEP_AT = 0.7

#: Metadata columns of ``documents`` that the registered query and the pipeline use.
META = ("n_chars",)

#: Byte classes whose shares of the text are statistics.
_CLASSES = ("other", "lower", "upper", "digit", "space", "newline", "stop", "bang", "bar", "symbol")
_CLASS_OF = np.zeros(256, np.int64)
for _name, _chars in (("lower", "abcdefghijklmnopqrstuvwxyz"), ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                      ("digit", "0123456789"), ("space", " \t\x0b\x0c\r"), ("newline", "\n"),
                      ("stop", ".,;:?'\"()-"), ("bang", "!"), ("bar", "|"), ("symbol", "#*$%&<>{}[]=+~^_@/\\`")):
    _CLASS_OF[[ord(c) for c in _chars]] = _CLASSES.index(_name)
STATS = len(_CLASSES) + 6


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int,
                    per_class: int, id_col: str = "doc_id") -> DataFrame:
    """``docs`` (with ``_id``) and ``_label`` for at most ``per_class`` labelled rows of each
    class, never from the held-out fold. The chosen label rows are a broadcast of that
    proven size; of ``labels`` only ``id_col`` and ``label`` are read."""
    rows = labels.where(crc_fold(F.col(id_col), folds) != held).select(
        F.col(id_col).alias("_label_id"), F.col(label).cast("int").alias("_label"))
    picked = None
    for value in (0, 1):
        part = rows.where(F.col("_label") == value).orderBy(F.xxhash64("_label_id"), "_label_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    return docs.join(F.broadcast(picked), F.col("_id") == F.col("_label_id"))


def vectors(batch: pa.RecordBatch, meta: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row starts, feature numbers, values) of a slice of ``_text`` and metadata."""
    n = batch.num_rows
    texts = batch.column("_text").cast(pa.large_string())
    doc, code, words = flat_words(texts)
    hashed = (word_hashes(words) % np.uint64(BUCKETS)).astype(np.int64)
    pairs, counts = np.unique(doc * BUCKETS + hashed[code], return_counts=True)
    row, value = pairs // BUCKETS, np.sqrt(counts)
    norm = np.sqrt(np.bincount(row, value * value, n))
    value = value / norm[row]

    raw = texts.cast(pa.large_binary())
    size = pc.binary_length(raw).to_numpy(zero_copy_only=False).astype(np.int64)
    _, offs, data = raw.buffers()
    offsets = np.frombuffer(offs, np.int64)[raw.offset:raw.offset + n + 1]
    content = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    kinds = np.bincount(np.repeat(np.arange(n), size) * len(_CLASSES) + _CLASS_OF[content],
                        minlength=n * len(_CLASSES)).reshape(n, len(_CLASSES))
    shares = kinds / np.maximum(size, 1)[:, None]

    n_words = np.bincount(doc, minlength=n)
    some = np.maximum(n_words, 1)
    distinct = np.bincount(np.unique(doc * (len(words) + 1) + code) // (len(words) + 1), minlength=n)
    stutter = np.bincount(doc[1:][(code[1:] == code[:-1]) & (doc[1:] == doc[:-1])], minlength=n)
    extra = np.stack([np.log1p(n_words) / 10, distinct / some, stutter / some,
                      np.minimum(size / some / 20, 1.0), np.log1p(size) / 15, np.ones(n)], 1)
    stats = [np.sqrt(shares), extra]
    for name in meta:
        known = pc.fill_null(pc.cast(batch.column(name), pa.float64()), 0.0).to_numpy(zero_copy_only=False)
        stats.append((np.log1p(np.abs(np.nan_to_num(known, posinf=0.0, neginf=0.0))) / 15)[:, None])
    dense = np.concatenate(stats, 1)
    width = dense.shape[1]

    row = np.concatenate([row, np.repeat(np.arange(n), width)])
    index = np.concatenate([pairs % BUCKETS + width, np.tile(np.arange(width), n)])
    value = np.concatenate([value, dense.ravel()])
    order = np.argsort(row, kind="stable")
    return np.searchsorted(row[order], np.arange(n + 1)), index[order], value[order].astype(np.float32)


@dataclass
class Machine:
    bias: float
    weight: np.ndarray
    factor: np.ndarray
    learned: bool = True  # from at least one labelled row

    def raw(self, starts: np.ndarray, index: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Scores before the logistic; every row has at least its statistics."""
        vx = self.factor[index] * value[:, None]
        total = np.add.reduceat(vx, starts[:-1], axis=0)
        own = np.add.reduceat((vx * vx).sum(1), starts[:-1])
        linear = np.add.reduceat(self.weight[index] * value, starts[:-1])
        return self.bias + linear + 0.5 * ((total * total).sum(1) - own)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], width: int, epochs: int = EPOCHS,
        rate: float = 0.1, decay: float = 1e-5, seed: int = 7) -> Machine:
    """AdaGrad on the logistic loss; the two classes weigh the same. One class alone, or no
    rows, gives the constant that fits them (a half without rows)."""
    rng = np.random.default_rng(seed)
    m = Machine(0.0, np.zeros(width, np.float32), rng.normal(0, 0.05, (width, FACTORS)).astype(np.float32))
    y = np.array([r[0] for r in rows], np.float32)
    if len(rows) == 0 or y.min() == y.max():
        m.factor[:] = 0
        m.learned = len(rows) > 0
        m.bias = 0.0 if len(rows) == 0 else (4.0 if y[0] else -4.0)
        return m
    share = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    seen_w, seen_v, seen_b = np.full(width, 1e-6, np.float32), np.full_like(m.factor, 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for part in np.array_split(order, max(1, len(rows) // 64)):
            index = np.concatenate([rows[i][1] for i in part])
            value = np.concatenate([rows[i][2] for i in part])
            lens = np.array([len(rows[i][1]) for i in part])
            starts = np.concatenate([[0], np.cumsum(lens)])
            vx = m.factor[index] * value[:, None]
            total = np.add.reduceat(vx, starts[:-1], axis=0)
            g = (logistic(m.raw(starts, index, value)) - y[part]) * share[part] / len(part)
            each = np.repeat(g, lens) * value
            touched, where = np.unique(index, return_inverse=True)
            gw = np.bincount(where, each) + decay * m.weight[touched]
            pair = each[:, None] * (np.repeat(total, lens, axis=0) - vx)
            gv = np.stack([np.bincount(where, pair[:, f]) for f in range(FACTORS)], 1) + decay * m.factor[touched]
            gb = float(g.sum())
            seen_w[touched] += gw * gw
            seen_v[touched] += gv * gv
            seen_b += gb * gb
            m.weight[touched] -= rate * gw / np.sqrt(seen_w[touched])
            m.factor[touched] -= rate * gv / np.sqrt(seen_v[touched])
            m.bias -= rate * gb / np.sqrt(seen_b)
    return m


def _prepared(docs: DataFrame, text_col: str, meta: Sequence[str], *keep: Column) -> DataFrame:
    return docs.select(*keep, whole_text(text_col).alias("_text"),
                       *[F.col(f"`{c}`").cast("double").alias(f"_meta{i}") for i, c in enumerate(meta)])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          meta: Sequence[str] = (), per_class: int = SAMPLE_PER_CLASS) -> Machine:
    """Fit on a bounded labelled sample. Tasks turn its texts into sparse vectors, so the
    driver receives numbers, of a bounded number of rows, and no text."""
    names = [f"_meta{i}" for i in range(len(meta))]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "_text"):
                starts, index, value = vectors(part, names)
                yield pa.record_batch({
                    "label": part.column("_label"),
                    "index": pa.array([index[a:b].astype(np.int32).tobytes() for a, b in zip(starts, starts[1:])], pa.binary()),
                    "value": pa.array([value[a:b].tobytes() for a, b in zip(starts, starts[1:])], pa.binary())})

    slim = _prepared(docs, text_col, meta, F.col(id_col).alias("_id"))
    sample = labelled_sample(slim, labels, "quality", 4, 2, per_class, id_col)
    found = sample.select("_label", "_text", *names).mapInArrow(
        encode, "label int, index binary, value binary").collect()
    rows = sorted((r["label"], bytes(r["index"]), bytes(r["value"])) for r in found)  # fixed order, fixed model
    return fit([(y, np.frombuffer(i, np.int32), np.frombuffer(v, np.float32)) for y, i, v in rows],
               BUCKETS + STATS + len(meta))


def score(docs: DataFrame, model: Machine, carry: Sequence[str], text_col: str = "text",
          meta: Sequence[str] = ()) -> DataFrame:
    """``_row``, a struct of the ``carry`` columns, and ``_score`` in [0, 1] per document."""
    names = [f"_meta{i}" for i in range(len(meta))]
    wide = _prepared(docs, text_col, meta, F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_row"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "_text"):
                yield pa.record_batch({
                    "_row": part.column("_row"),
                    "_score": logistic(model.raw(*vectors(part, names)).astype(np.float64))})

    return wide.mapInArrow(judge, wide.select("_row", F.lit(0.0).alias("_score")).schema)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             meta: Sequence[str] = (), per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """One row per document: ``id_col, held_out, score, predicted``.

    Learns ``labels.quality`` from at most ``per_class`` labelled rows per class whose
    crc32(id) mod 4 is not 2. A null or empty text is scored from its (zero) statistics;
    null metadata counts as 0; a null id is not held out; repeated rows each get a row;
    without labels every score is a half; an empty table gives an empty result."""
    model = train(docs, labels, id_col, text_col, meta, per_class)
    out = score(docs, model, [id_col], text_col, meta)
    doc_id = F.col("_row").getField(id_col)
    return out.select(doc_id.alias(id_col),
                      F.coalesce(crc_fold(doc_id, 4) == 2, F.lit(False)).alias("held_out"),
                      F.col("_score").alias("score"),
                      (F.col("_score") >= KEEP_AT).cast("int").alias("predicted"))


def kept(docs: DataFrame, labels: DataFrame, text_col: str = "text", meta: Sequence[str] = (),
         per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``KEEP_AT``, with their own columns; all
    of them when no labelled row could teach a rejection."""
    model = train(docs, labels, "doc_id", text_col, meta, per_class)
    if not model.learned:
        return docs
    return score(docs, model, docs.columns, text_col, meta).where(F.col("_score") >= KEEP_AT).select("_row.*")
