"""Operator 1, packing: mixture-controlled deficit round-robin.

Every source is a queue of packets (pieces of at most ``PACKET`` tokens of its documents,
in row order). In each round, one per window of ``SEQUENCE`` tokens, every queue gains
credit for its target share of the window and serves packets while its credit lasts; what
is left over, at most a packet, is its deficit and carries into the next window. Since a
queue's credit after round ``r`` is ``(r + 1) * share * SEQUENCE``, the packet that ends at
queue position ``e`` is served in round ``ceil(e / (share * SEQUENCE)) - 1``: the deficits
of any window, in any partition, follow from prefix sums, and no task replays the rounds.

Prefix sums are two-level everywhere: inside (source, input partition) for queue positions
and inside blocks of rounds for positions in the output stream, with small tables of block
totals in between, so a source that holds a third of all rows is spread like any other.
Windows are consecutive runs of the stream, so only the very last one is not full.

Texts are tokenised once, over whole texts, each distinct word of a slice once: the
tokenizer never joins text across ASCII white space. The ids are kept compressed in the
shared folder and meet their pieces by a shuffle on row number.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import flat_words, stored, text_slices, whole_text

SEQUENCE = 2048
PACKET = 512
#: Text bytes whose words are told apart at a time.
SLICE = 4 << 20
END_ID = 1
#: Rounds whose packets one task orders: a bounded number of tokens, about 2 million.
ROUNDS = 1024
#: Blocks under one total of the second level of the stream's prefix sum.
BLOCKS = 4096
#: Distinct word stems whose ids a task remembers in each of two generations.
_REMEMBER = 150_000
#: Plain words, letters and then ASCII punctuation, and that punctuation.
_PLAIN = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+[!-&(-/:-@\[-`{-~]*$"
_LETTERS = "".join(c for c in map(chr, range(65, 256)) if c.isalpha() and c not in "\xaa\xb5\xba")
_PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
#: Stems that are encoded in one string.
_TOGETHER = 500


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Token ids of single words, as bytes of unsigned 32-bit numbers.

    The tokenizer lower-cases, and letters and punctuation never share a token, so a plain
    word has the ids of its lower-cased stem and then those of its punctuation. Stems are
    encoded many in one string and told apart afterwards: the vocabulary marks the tokens
    that end a word. Should the marks not add up, and for all other words, each is encoded
    by itself."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocabulary = self.tok.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.now: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def _alone(self, words: list[str]) -> None:
        for w, e in zip(words, self.tok.encode_batch_fast(words, add_special_tokens=False)):
            self.now[w] = np.array(e.ids, np.uint32).tobytes()

    def _together(self, stems: list[str]) -> None:
        groups = [stems[i:i + _TOGETHER] for i in range(0, len(stems), _TOGETHER)]
        for g, e in zip(groups, self.tok.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(g):
                self._alone(g)
                continue
            raw, a = ids.tobytes(), 0
            for stem, b in zip(g, (4 * stops).tolist()):
                self.now[stem] = raw[a:b]
                a = b

    def _known(self, stems: pa.Array, plain: np.ndarray) -> list[bytes]:
        """Ids of distinct ``stems``; those not ``plain`` are encoded by themselves."""
        now, old, names = self.now, self.old, stems.to_pylist()
        new = []
        for k, w in enumerate(names):
            if w not in now:
                if w in old:
                    now[w] = old[w]
                else:
                    new.append(k)
        self._together([names[k] for k in new if plain[k]])
        self._alone([names[k] for k in new if not plain[k]])
        return [now[w] for w in names]

    def __call__(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, how many each word has)."""
        if len(self.now) > _REMEMBER:
            self.old, self.now = self.now, {"": b""}
        plain = pc.match_substring_regex(distinct, _PLAIN)
        stems = pc.if_else(plain, pc.utf8_lower(pc.utf8_rtrim(distinct, _PUNCTUATION)), distinct).dictionary_encode()
        tails = pc.if_else(plain, pc.utf8_ltrim(distinct, _LETTERS), "").dictionary_encode()
        whole = pc.match_substring_regex(stems.dictionary, _PLAIN).to_numpy(zero_copy_only=False)
        parts = self._known(stems.dictionary, whole) + self._known(tails.dictionary, np.zeros(len(tails.dictionary), bool))
        pick = np.stack([stems.indices.to_numpy(), tails.indices.to_numpy() + len(stems.dictionary)], 1).ravel()
        return _gather(parts, pick, 2)


def _gather(parts: list[bytes], pick: np.ndarray, each: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of ``parts[pick]`` one after the other, and their number per ``each`` picks."""
    size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    flat, lens = _ragged(np.frombuffer(b"".join(parts), np.uint32), size, pick)
    return flat, lens.reshape(-1, each).sum(1)


def _ragged(ids: np.ndarray, size: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs ``pick`` of ``ids``, which are cut into runs of ``size``, and their lengths."""
    begin, lens = (np.cumsum(size) - size)[pick], size[pick]
    return ids[np.repeat(begin - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())], lens


def tokenized(docs: DataFrame, id_col: str, text_col: str, source_col: str, tokenizer: str) -> DataFrame:
    """``_uid, _id, _source, n, ids`` per document: ``ids`` are zstd-compressed unsigned
    32-bit numbers, the end id included; stored once."""
    from pyspark.sql import types as T

    slim = docs.select(F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("_source"),
                       whole_text(text_col).alias("_text"))
    schema = T.StructType([*slim.drop("_text").schema, T.StructField("n", T.LongType()),
                           T.StructField("ids", T.BinaryType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_ids, press = WordIds(tokenizer), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in text_slices(batch, "_text", SLICE):
                doc, code, distinct = flat_words(part.column("_text"))
                flat, lens = _ragged(*word_ids(distinct), code)
                count = np.bincount(doc, lens, part.num_rows).astype(np.int64)
                ends = np.cumsum(count)
                rows = [press.compress(flat[e - c:e].tobytes() + np.uint32(END_ID).tobytes())
                        for c, e in zip(count, ends)]
                yield pa.record_batch({"_id": part.column("_id"), "_source": part.column("_source"),
                                       "n": pa.array(count + 1), "ids": pa.array(rows, pa.binary())})
                del doc, code, distinct, flat, rows
                pa.default_memory_pool().release_unused()  # else the pool keeps a slice's memory

    return stored(slim.mapInArrow(encode, schema).withColumn("_uid", F.monotonically_increasing_id()),
                  "pack-ids")


def _before(cols, *, by=(), order) -> Column:
    """Sum of ``cols`` over the rows before this one."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(cols).over(w), F.lit(0))


def packets(tokens: DataFrame, weights: Mapping[str, float] | None, packet: int, sequence: int) -> DataFrame:
    """``_uid, source, start, length, round, end`` of every packet, ``end`` in its queue."""
    docs = tokens.select("_uid", F.coalesce("_source", F.lit("")).alias("source"), "n",
                         F.shiftright("_uid", 33).alias("part"))
    parts = docs.groupBy("source", "part").agg(F.sum("n").alias("n"))
    queues = parts.groupBy("source").agg(F.sum("n").alias("tokens"))
    weight = F.col("tokens").cast("double")
    if weights:
        if min(weights.values()) <= 0:
            raise ValueError("a source's weight must be positive")
        weight = F.lit(float(min(weights.values())))
        for name, w in weights.items():
            weight = F.when(F.col("source") == name, F.lit(float(w))).otherwise(weight)
    queues = queues.withColumn("weight", weight)
    every = queues.select(F.sum("weight")).scalar()
    quantum = queues.select("source", (F.col("weight") / every * sequence).alias("quantum"))
    parts = stored(parts.select("source", "part", _before("n", by=["source"], order=["part"]).alias("base"))
                   .join(quantum, "source"), "pack-queues")
    docs = docs.withColumn("before", _before("n", by=["source", "part"], order=["_uid"]))
    docs = docs.join(parts, ["source", "part"]).withColumn("begin", F.col("base") + F.col("before"))
    cut = docs.select("_uid", "source", "quantum", "begin", "n", F.explode(F.sequence(
        F.lit(0).cast("long"), F.expr(f"(n - 1) div {packet}"))).alias("k"))
    cut = cut.select("_uid", "source", "quantum", (F.col("k") * packet).alias("start"),
                     F.least(F.lit(packet), F.col("n") - F.col("k") * packet).cast("long").alias("length"), "begin")
    cut = cut.withColumn("end", F.col("begin") + F.col("start") + F.col("length"))
    return cut.select("_uid", "source", "start", "length", "end", F.greatest(
        F.lit(0), F.ceil(F.col("end") / F.col("quantum")) - 1).cast("long").alias("round"))


def laid_out(pkts: DataFrame, sequence: int) -> DataFrame:
    """Pieces ``_uid, source, start, length, sequence_id, offset, round`` in the stream."""
    pkts = pkts.withColumn("block", F.expr(f"round div {ROUNDS}"))
    blocks = pkts.groupBy("block").agg(F.sum("length").alias("n")).withColumn(
        "upper", F.expr(f"block div {BLOCKS}"))
    uppers = blocks.groupBy("upper").agg(F.sum("n").alias("n"))
    uppers = uppers.select("upper", _before("n", order=["upper"]).alias("far"))
    blocks = blocks.withColumn("near", _before("n", by=["upper"], order=["block"])).join(uppers, "upper")
    base = stored(blocks.select("block", (F.col("far") + F.col("near")).alias("base")), "pack-blocks")
    pos = pkts.withColumn("inside", _before("length", by=["block"], order=["round", "source", "end"]))
    pos = pos.join(base, "block").withColumn("at", F.col("base") + F.col("inside"))
    pos = pos.withColumn("sequence_id", F.explode(F.sequence(
        F.expr(f"at div {sequence}"), F.expr(f"(at + length - 1) div {sequence}"))))
    lo = F.greatest("at", F.col("sequence_id") * sequence)
    hi = F.least(F.col("at") + F.col("length"), (F.col("sequence_id") + 1) * sequence)
    return pos.select("_uid", "source", (F.col("start") + lo - F.col("at")).alias("start"),
                      (hi - lo).alias("length"), "sequence_id",
                      (lo - F.col("sequence_id") * sequence).alias("offset"), "round")


def pack(docs: DataFrame, weights: Mapping[str, float] | None = None, id_col: str = "doc_id",
         text_col: str = "text", source_col: str = "source", tokenizer: str | None = None,
         sequence: int = SEQUENCE, packet: int = PACKET) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, source, round``.

    ``weights`` are target shares by source (unlisted sources get the smallest; they need
    not sum to 1); None takes each source's own share of the tokens, which empties all
    queues in the same window. When a queue runs dry its later rounds are smaller and the
    stream goes on with the others, so every document is packed. The last sequence is
    padded to ``sequence`` unless it holds a power of two of tokens.

    Null and empty texts are the end id alone; null sources are a queue of their own;
    repeated rows are packed each; other columns are ignored; an empty table gives an
    empty result."""
    if not 0 < packet <= sequence:
        raise ValueError("a packet must fit a sequence")
    tokens = tokenized(docs, id_col, text_col, source_col, tokenizer or default_tokenizer())
    pieces = laid_out(packets(tokens, weights, packet, sequence), sequence)
    per_doc = pieces.groupBy("_uid", F.col("source").alias("source")).agg(F.collect_list(F.struct(
        "start", "length", "sequence_id", "offset", "round")).alias("pieces"))
    joined = tokens.select("_uid", "_id", "_source", "n", "ids").join(per_doc, "_uid")
    wide = joined.select("_id", "_source", "n", "ids", "pieces")
    out = wide.select("_id", "_source", F.col("n").alias("doc_tokens"), F.explode("pieces").alias("p"),
                      F.lit(0).cast("long").alias("ids_crc32")).schema

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            lists = batch.column("pieces")
            p = lists.flatten()
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            start, size = (p.field(f).to_numpy().astype(np.int64) * 4 for f in ("start", "length"))
            crc, last, ids = np.empty(len(row), np.int64), -1, b""
            raw = batch.column("ids")
            for k, (r, a, n) in enumerate(zip(row.tolist(), start.tolist(), size.tolist())):
                if r != last:
                    last, ids = r, press.decompress(raw[r].as_py())
                crc[k] = zlib.crc32(ids[a:a + n])
            take = pa.array(row)
            yield pa.record_batch({"_id": batch.column("_id").take(take), "_source": batch.column("_source").take(take),
                                   "doc_tokens": batch.column("n").take(take), "p": p, "ids_crc32": pa.array(crc)})

    return wide.mapInArrow(sums, out).select(
        F.col("_id").alias(id_col), "p.start", "p.length", "ids_crc32", "doc_tokens", "p.sequence_id",
        "p.offset", F.col("_source").alias("source"), "p.round")
