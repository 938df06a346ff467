"""Operator 12, cross-tokenizer alignment: interval coalescing.

Tokenizer A (byte-level BPE) and tokenizer B (pieces with byte fallback) cut the same bytes,
a space and the text, into two rows of intervals. All tokens of a slice of documents, laid
end to end, are lexsorted by start; ``maximum.accumulate`` over their ends gives how far the
tokens so far reach, and a group breaks where a start reaches that maximum. Inside the groups
the overlapping A-B pairs are expanded; those whose ranges end together are the links.

Texts are tokenised once. What is kept of a document is its links, an id pair each,
compressed. Corpus counts of id pairs are combined per task before the shuffle. Since two
tokens that end together share their bytes up to the shorter one's length, one is a suffix
of the other: there are at most as many different pairs as the two vocabularies have bytes
(times the ids that share their bytes), whatever the corpus, so the summed counts are a
table of bounded size and go to the tasks that score the documents as a broadcast.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import text_slices, whole_text

#: Text bytes that are aligned at a time.
SLICE = 1 << 20
#: Different pairs that a task holds before it folds its counts.
FOLD = 1 << 20
#: Fixed value: the published pre-tokenisation pattern of the byte-level BPE vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ------------------------------------------------------------------ tokenizers

def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable bytes for
    themselves, the others, in order, for the code points from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class _Vocabulary:
    """Bytes of the tokens, by id."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.raw = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        n = self.size[ids]
        return self.raw[np.repeat(self.at[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


class ByteBpe:
    """Byte-level BPE from a tokenizer file; text of special tokens is plain text.

    Where the ids of the merged tokens rise with their merges (so that a merge's rank can be
    read off its id), the merges run in tiktoken, which gives the same ids several times faster;
    any other file, or a text that tiktoken refuses, is encoded by the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if all(c in letters for c in t)}
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        order = [model["vocab"][t] for t in merged]
        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        n = self.plain.get_vocab_size(with_added_tokens=True)
        by_id = {i: t for t, i in ranks.items()}
        self.vocabulary = _Vocabulary([by_id.get(i, b"") for i in range(n)])
        self.fast = None
        single = [ranks.get(bytes([b])) for b in range(256)]
        if None not in single and order and max(single) < order[0] and all(a < b for a, b in zip(order, order[1:])):
            import tiktoken

            kept = set(single) | set(order)
            self.fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, special_tokens={},
                                          mergeable_ranks={t: i for t, i in ranks.items() if i in kept})

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for t in texts:
            if self.fast is not None:
                try:
                    out.append(self.fast.encode_to_numpy(t, disallowed_special=()))
                    continue
                except (ValueError, RuntimeError):
                    pass
            out.append(np.array(self.plain.encode(t, add_special_tokens=False).ids, np.uint32))
        return out


class Pieces:
    """A sentencepiece model; it puts the space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model

        def token(i: int) -> bytes:
            piece = m.id_to_piece(i)
            return bytes([int(piece[3:5], 16)]) if m.is_byte(i) else piece.replace("▁", " ").encode()

        self.vocabulary = _Vocabulary([token(i) for i in range(m.get_piece_size())])

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.uint32) for x in self.model.encode(texts, num_threads=1)]


# ------------------------------------------------------------------ alignment of a slice

def _starts(end: np.ndarray) -> np.ndarray:
    start = np.zeros_like(end)
    start[1:] = end[:-1]
    return start


def coalesce(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups of the A and of the B tokens, given where they end; each row of tokens covers
    the same bytes from 0 on without gaps."""
    start, end = np.concatenate([_starts(a_end), _starts(b_end)]), np.concatenate([a_end, b_end])
    kind = np.repeat(np.array([0, 1], np.int8), (len(a_end), len(b_end)))
    order = np.lexsort((kind, start))
    reach = np.maximum.accumulate(end[order])
    cut = np.ones(len(order), bool)
    cut[1:] = start[order[1:]] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(cut) - 1
    return group[:len(a_end)], group[len(a_end):]


def overlaps(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of an A and a B token that share a byte."""
    lo = np.searchsorted(b_end, _starts(a_end), side="right")
    n = np.searchsorted(_starts(b_end), a_end, side="left") - lo
    a = np.repeat(np.arange(len(a_end)), n)
    return a, np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(len(a))


def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of the numbers below ``n``, a row each with a place left over, and how many."""
    names = np.array([str(i) for i in range(n)], f"S{len(str(n)) + 1}")
    return names.view(np.uint8).reshape(n, -1), np.char.str_len(names)


def _written(a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray, n_groups: int,
             decimals: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The groups as text, ``a1,a2|b1;a3|b2,b3;``, and where each group's text ends."""
    na, nb = np.bincount(ga, minlength=n_groups), np.bincount(gb, minlength=n_groups)
    ids = np.empty(len(a) + len(b), np.int64)
    mark = np.full(len(ids), ord(","), np.uint8)
    ids[np.arange(len(a)) + (np.cumsum(nb) - nb)[ga]] = a
    ids[np.arange(len(b)) + np.cumsum(na)[gb]] = b
    last = np.cumsum(na + nb) - 1
    mark[last], mark[last - nb] = ord(";"), ord("|")
    digits, width = decimals
    rows, n = digits[ids], width[ids]
    rows[np.arange(len(ids)), n] = mark
    return rows[rows != 0], np.cumsum(n + 1)[last]


class Aligner:
    """Alignment of a slice of texts by two tokenizers."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteBpe(a_path), Pieces(b_path)
        self.decimals = _decimals(max(len(x.vocabulary.size) for x in (self.a, self.b)))

    def tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids by A and by B; none for an empty text or one whose bytes either does not give back."""
        none = np.zeros(0, np.uint32)
        some = [k for k, t in enumerate(texts) if t]
        given = [f" {texts[k]}" for k in some]
        a, b = self.a(given), self.b([texts[k] for k in some])
        out_a, out_b = [none] * len(texts), [none] * len(texts)
        for k, t, x, y in zip(some, given, a, b):
            raw = np.frombuffer(t.encode(), np.uint8)
            if all(int(v.size[i].sum()) == len(raw) and np.array_equal(v.joined(i), raw)
                   for v, i in ((self.a.vocabulary, x), (self.b.vocabulary, y))):
                out_a[k], out_b[k] = x, y
        return out_a, out_b

    def __call__(self, texts: list[str]) -> dict[str, np.ndarray | list]:
        """Per text: ids of A and B, groups, their text, and the id pairs of the links, as one
        number each (A id times the size of B's vocabulary plus B id)."""
        a_ids, b_ids = self.tokens(texts)
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (a_ids, b_ids))
        a, b = (np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.int64) for ids in (a_ids, b_ids))
        a_end, b_end = np.cumsum(self.a.vocabulary.size[a]), np.cumsum(self.b.vocabulary.size[b])
        ga, gb = coalesce(a_end, b_end)
        n_groups = int(ga[-1]) + 1 if len(ga) else 0
        text, text_end = _written(a, b, ga, gb, n_groups, self.decimals)
        i, j = overlaps(a_end, b_end)
        together = a_end[i] == b_end[j]
        i, j = i[together], j[together]
        pair = a[i] * len(self.b.vocabulary.size) + b[j]
        stop = np.cumsum(n_a)
        group_stop = np.where(stop > 0, ga[stop - 1] + 1, 0) if len(ga) else np.zeros(len(texts), np.int64)
        link_stop = np.searchsorted(i, stop, side="left")
        text_stop = np.concatenate([[0], text_end])[group_stop]
        return {"n_a": n_a, "n_b": n_b, "n_groups": np.diff(group_stop, prepend=0), "n_links": np.diff(link_stop, prepend=0),
                "pair": pair, "text": text, "text_stop": text_stop}


# ------------------------------------------------------------------ Spark

def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          tokenizers: tuple[str, str] | None = None) -> DataFrame:
    """One row per document: ``id_col, n_a, n_b, n_groups, n_links, groups, links``.

    ``groups`` is the alignment as text (``a1,a2|b1;a3|b2,b3``, ids in order); ``links`` has the
    id pairs of the linked tokens (see ``unpacked``). Null and empty texts, and texts whose
    bytes a tokenizer does not give back, have no tokens: zeros, no groups, no links. Rows may
    repeat, ids may be null, other columns are ignored, an empty table gives an empty result;
    long texts are aligned whole."""
    a_path, b_path = tokenizers or default_tokenizers()
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, press = None, zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in text_slices(batch, "_text", SLICE):
                aligner = aligner or Aligner(a_path, b_path)
                got = aligner(part.column("_text").to_pylist())
                raw, at = got["text"].tobytes(), 0
                groups, links, done = [], [], 0
                wide = np.uint32 if len(aligner.a.vocabulary.size) * len(aligner.b.vocabulary.size) < 1 << 32 else np.uint64
                pair = got["pair"].astype(wide)
                for stop, n in zip(got["text_stop"].tolist(), got["n_links"].tolist()):
                    groups.append(raw[at:stop - 1] if stop > at else b"")
                    links.append(press.compress(pair[done:done + n].tobytes()) if n else b"")
                    at, done = stop, done + n
                yield pa.record_batch({
                    id_col: part.column("_id"), **{c: pa.array(got[c]) for c in ("n_a", "n_b", "n_groups", "n_links")},
                    "groups": pa.array(groups, pa.binary()).cast(pa.string()), "links": pa.array(links, pa.binary())})

    return docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text")).mapInArrow(
        run, f"`{id_col}` {id_type}, n_a long, n_b long, n_groups long, n_links long, groups string, links binary")


def unpacked(links: list[bytes], n: np.ndarray) -> np.ndarray:
    """The id pairs of several documents, one after the other."""
    press = zstandard.ZstdDecompressor()
    parts = []
    for x, k in zip(links, n.tolist()):
        if k:
            raw = press.decompress(x)
            parts.append(np.frombuffer(raw, np.uint32 if len(raw) == 4 * k else np.uint64).astype(np.int64))
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def link_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n``: how many links of the whole corpus hold each id pair."""
    def fold(parts: list) -> tuple[np.ndarray, np.ndarray]:
        pair, place = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
        total = np.zeros(len(pair), np.int64)
        np.add.at(total, place, np.concatenate([n for _, n in parts]))
        return pair, total

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            n = batch.column("n_links").to_numpy()
            for part in _link_slices(batch, n):
                parts.append(np.unique(part[0], return_counts=True))
                held += len(parts[-1][0])
                if held > FOLD:
                    parts = [fold(parts)]
                    held = len(parts[0][0])
                    if held > FOLD // 2:
                        yield pa.record_batch({"pair": parts[0][0], "n": parts[0][1]})
                        parts, held = [], 0
        if parts:
            pair, n = fold(parts)
            yield pa.record_batch({"pair": pair, "n": n})

    return aligned.select("n_links", "links").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _link_slices(batch: pa.RecordBatch, n: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, int, int]]:
    """(id pairs, first row, row after the last) of stretches of rows with about ``most`` links."""
    links, ends, start = batch.column("links"), np.cumsum(n), 0
    while start < len(n):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield unpacked(links.slice(start, stop - start).to_pylist(), n[start:stop]), start, stop
        start = stop


def scored(aligned: DataFrame, n_b: int) -> DataFrame:
    """``aligned`` with ``n_best``, links whose pair is the most frequent of the corpus for its
    B id (ties included), and ``count_sum``, the corpus counts of all its links added up;
    ``links`` goes. ``n_b`` is the size of B's vocabulary. ``aligned`` is read twice: store it."""
    counts = link_counts(aligned).toArrow()
    order = np.argsort(counts.column("pair").to_numpy())
    pairs, count = (counts.column(c).to_numpy()[order] for c in ("pair", "n"))
    best = np.zeros(n_b, np.int64)
    np.maximum.at(best, pairs % n_b, count)
    table = aligned.sparkSession.sparkContext.broadcast((pairs, count, best))
    rest = [f for f in aligned.schema if f.name != "links"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, count, best = table.value
        for batch in batches:
            n = batch.column("n_links").to_numpy()
            n_best, total = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            for pair, a, b in _link_slices(batch, n):
                of = count[np.searchsorted(pairs, pair)]
                at = np.concatenate([[0], np.cumsum(n[a:b])])
                for out, x in ((n_best, of == best[pair % n_b]), (total, of)):
                    upto = np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
                    out[a:b] = upto[at[1:]] - upto[at[:-1]]
            kept = batch.select([f.name for f in rest])
            yield pa.record_batch([*kept.columns, pa.array(n_best), pa.array(total)], [*kept.schema.names, "n_best", "count_sum"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)
    return aligned.mapInArrow(score, f"{fields}, n_best long, count_sum long")


def piece_count(path: str | None = None) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path or default_tokenizers()[1]).get_piece_size()
