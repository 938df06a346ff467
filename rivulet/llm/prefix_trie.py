"""Operator 11, conversation prefix trie: truncation peeling.

A conversation is a path of turns; a turn is known by 24 bytes, a digest of role and text
and the number of words of the text, so no text travels beyond the first shuffle. Equal
conversations collapse to one path with a count. The distinct paths are sorted in ranges,
and every task peels its stretch of them from the deepest level up: at depth ``d`` the
conversations that end there join the nodes that survive from ``d + 1``, stripping their
last turn regroups them (neighbours in the sorted stretch fall together where their common
prefix reaches ``d``), and members, children, leaves and savings are added up as the nodes
are found. So the number of Spark stages does not depend on the depth.

Only nodes on the path of a stretch's first or last row can reach into a neighbouring
stretch. They stay open: what the task found below them travels on as one item a depth,
and blocks of ``FAN`` neighbouring stretches are peeled again, in order, with those items in
place of ended conversations, until one block is left. A task holds a batch of paths, or
the outer paths of ``FAN`` blocks, whatever the number of conversations that share a prefix.
A conversation's own digests (24 bytes a turn) have to fit in a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import stored, text_slices, whole_text, words_col

#: Neighbouring blocks that are peeled together.
FAN = 64
#: Bytes of ids in one piece of a node's list of ended conversations.
PIECE = 1 << 20
#: Bytes of one turn in a path.
TURN = 24
_NONE = np.int64(np.iinfo(np.int64).max)
#: In place of a parent's id: not known, or none.
_NO_ID = np.int64(np.iinfo(np.int64).min)
_PEELED = ("block long, depth long, conv_id long, parent_conv_id long, parent_key binary, key binary, n_convs long, "
           "n_children long, n_leaves long, saved_tokens long, seq binary, path binary, items binary, seqs binary")
_NAMES = [f.split()[0] for f in _PEELED.split(", ")]
_TYPES = [pa.int64() if f.endswith("long") else pa.binary() for f in _PEELED.split(", ")]


# ------------------------------------------------------------------ paths

def sequences(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """``conv_id, path``: the turns of each conversation in the order of their number (null
    first; equal numbers by the digest of role and text), each as 48 hexadecimal digits.
    Null role or text counts as empty. Rows without a conversation id belong to none."""
    role, text = whole_text(role_col), whole_text(text_col)
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turn = F.concat(digest, F.lpad(F.hex(F.size(words_col(text)).cast("long")), 16, "0"))
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("t"), turn.alias("e"))
    return rows.groupBy("conv_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("t", "e"))), lambda x: x["e"]).alias("path"))


def grafted(seqs: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations that share openings: the first ``h`` turns of conversation ``c`` are
    those of ``c - c % every`` (all it has if fewer, none if it is absent), then follow
    ``c``'s own after its first ``h``; ``h`` is the CRC-32 of decimal ``c`` modulo ``most``."""
    base = F.col("conv_id") - F.col("conv_id") % every
    heads = seqs.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("path", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    none = F.array().cast("array<string>")
    own = F.slice("path", h + 1, F.greatest(F.size("path") - h, F.lit(0)))
    return seqs.withColumn("base", base).join(heads, "base", "left").select(
        "conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), h), own).alias("path"))


# ------------------------------------------------------------------ peeling

def _paths(paths: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(turns of each path, where it begins, common prefix with the path before, words of
    every turn) of sorted distinct paths."""
    raw = np.frombuffer(b"".join(paths), ">u8").reshape(-1, 3)
    size = np.array([len(p) // TURN for p in paths], np.int64)
    at = np.cumsum(size) - size
    both = np.minimum(size[1:], size[:-1])
    row = np.repeat(np.arange(1, len(paths)), both)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(both) - both, both)
    a, b = raw[at[row] + nth], raw[at[row - 1] + nth]
    differ = np.flatnonzero((a[:, 0] != b[:, 0]) | (a[:, 1] != b[:, 1]))
    common = np.concatenate([[-1], both])
    np.minimum.at(common, row[differ], nth[differ])
    return size, at, common, raw[:, 2].astype(np.int64)


def _prefix_keys(path: bytes) -> list[bytes]:
    """A digest of every prefix of a path, by its depth."""
    h = hashlib.md5(usedforsecurity=False)
    out = [h.digest()]
    for a in range(0, len(path), TURN):
        h.update(path[a:a + TURN])
        out.append(h.digest())
    return out


def _peel(paths: list[bytes], items: np.ndarray, seqs: list[bytes], block: int, final: bool,
          merging: bool) -> tuple[pa.RecordBatch, list[tuple[bytes, np.ndarray, list[bytes]]]]:
    """Peel sorted distinct ``paths``. ``items`` has rows of (path, depth, members, least
    member, children, leaves, saved tokens, place in ``seqs`` or -1): what a path brings in at
    a depth; every path has one at its own length. Gives the finished nodes, and unless
    ``final`` the first and the last path with the items of the nodes on them, which stay open."""
    size, at, common, words = _paths(paths)
    last = len(paths) - 1
    keys = {r: _prefix_keys(paths[r]) for r in ({0, last} if not merging else range(len(paths)))}
    items = items[np.lexsort((items[:, 0], -items[:, 1]))]
    found, opened = [], []
    live = np.zeros((0, 7), np.int64)  # first path, members, least member, 1, leaves, saved, -1
    is_open = np.zeros(0, bool)
    node = np.zeros((0, 6), np.int64)  # of the live nodes: first path, members, least member, children, leaves, saved
    seq_of = np.zeros(0, np.int64)
    lo = 0
    for d in range(int(size.max()), -1, -1):
        hi = lo + int(np.searchsorted(-items[lo:, 1], -d, side="right"))
        new = items[lo:hi]
        lo = hi
        rows = np.concatenate([live, new[:, [0, 2, 3, 4, 5, 6, 7]]])
        order = np.argsort(rows[:, 0], kind="stable")
        rows = rows[order]
        start = rows[:, 0]
        first = np.ones(len(rows), bool)
        first[1:] = (start[1:] != start[:-1]) & (common[start[1:]] < d)
        g = np.flatnonzero(first)
        group = np.empty(len(rows), np.int64)
        group[order] = np.cumsum(first) - 1
        n, kids, leaves, saved = (np.add.reduceat(rows[:, c], g) for c in (1, 3, 4, 5))
        conv, seq = np.minimum.reduceat(rows[:, 2], g), np.maximum.reduceat(rows[:, 6], g)
        start = start[g]
        outer = np.zeros(len(g), bool)
        if not final:
            outer[0] = start[0] == 0
            outer[-1] |= size[last] >= d
        shut = ~outer
        leaves = np.where(shut & (kids == 0), 1, leaves)
        if d:
            saved = saved + np.where(shut, (n - 1) * words[at[start] + d - 1], 0)
        done = np.flatnonzero(~is_open)
        if len(done):
            above = group[done]
            found.append((d + 1, node[done], seq_of[done], np.where(shut[above], conv[above], _NO_ID),
                          np.where(shut[above], -1, np.where((above == 0) & (start[0] == 0), 0, last))))
        for k in np.flatnonzero(outer):
            side = 0 if k == 0 and start[0] == 0 else last
            opened.append((side, d, n[k], conv[k], kids[k], leaves[k], saved[k], seq[k]))
        node, seq_of, is_open = np.stack([start, n, conv, kids, leaves, saved], 1), seq, outer
        zero = np.zeros(len(g), np.int64)
        live = np.stack([start, np.where(outer, zero, n), np.where(outer, _NONE, conv), np.where(outer, 0, 1),
                         np.where(outer, zero, leaves), np.where(outer, zero, saved), zero - 1], 1)
    if final:
        found.append((0, node, seq_of, np.full(len(node), _NO_ID), np.full(len(node), -1)))
    spines = []
    for r in sorted({0, last}) if not final else ():
        mine = [o for o in opened if o[0] == r]
        held = [seqs[o[7]] if o[7] >= 0 else b"" for o in mine]
        spines.append((paths[r], np.array([o[1:7] for o in mine], np.int64).reshape(-1, 6), held))
    return _nodes(found, keys, seqs, block, merging), spines


def _nodes(found: list, keys: dict[int, list[bytes]], seqs: list[bytes], block: int, merging: bool) -> pa.RecordBatch:
    cols: dict[str, list] = {c: [] for c in _NAMES}
    for depth, node, seq, parent, side in found:
        cols["depth"].append(np.full(len(node), depth))
        for c, x in zip(("conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"), (2, 1, 3, 4, 5)):
            cols[c].append(node[:, x])
        cols["parent_conv_id"].append(parent)
        cols["parent_key"] += [None if s < 0 else keys[s][depth - 1] for s in side.tolist()]
        cols["key"] += [keys[r][depth] for r in node[:, 0].tolist()] if merging else [None] * len(node)
        cols["seq"] += [None if s < 0 else seqs[s] for s in seq.tolist()]
    n = len(cols["key"])
    arrays = []
    for c, t in zip(_NAMES, _TYPES):
        if c == "block":
            arrays.append(pa.array(np.full(n, block), t))
        elif c in ("path", "items", "seqs"):
            arrays.append(pa.nulls(n, t))
        elif t == pa.binary():
            arrays.append(pa.array(cols[c], t))
        else:
            flat = np.concatenate(cols[c]) if cols[c] else np.zeros(0, np.int64)
            arrays.append(pa.array(flat, t, mask=flat == _NO_ID if c == "parent_conv_id" else None))
    return pa.record_batch(arrays, _NAMES)


def _spine_rows(block: int, spines: list) -> pa.RecordBatch:
    n = len(spines)
    given = {"block": pa.array([block] * n, pa.int64()), "depth": pa.array(range(n), pa.int64()),
             "path": pa.array([p for p, _, _ in spines], pa.binary()),
             "items": pa.array([i.tobytes() for _, i, _ in spines], pa.binary()),
             "seqs": pa.array([b"".join(b"\x01" + s if s else b"\x00" * 17 for s in held) for _, _, held in spines], pa.binary())}
    return pa.record_batch([given.get(c, pa.nulls(n, t)) for c, t in zip(_NAMES, _TYPES)], _NAMES)


def _again(spines: list, block: int, final: bool):
    """Peel the outer paths of neighbouring blocks, which come in order."""
    paths, rows, seqs = [], [], []
    for path, items, held in spines:
        if not paths or paths[-1] != path:
            paths.append(path)
        place = np.array([len(seqs) + k if s else -1 for k, s in enumerate(held)], np.int64)
        seqs += held
        rows.append(np.column_stack([np.full(len(items), len(paths) - 1), items, place]))
    return _peel(paths, np.concatenate(rows), seqs, block, final, True)


def _peel_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = TaskContext.get().partitionId()
    blocks: list[list] = []
    for batch in batches:
        for part in text_slices(batch, "path"):
            k = part.num_rows
            items = np.zeros((k, 8), np.int64)
            items[:, 0] = items[:, 7] = np.arange(k)
            paths = part.column("path").to_pylist()
            items[:, 1] = [len(p) // TURN for p in paths]
            items[:, 2], items[:, 3] = (part.column(c).to_numpy() for c in ("n", "conv"))
            nodes, spines = _peel(paths, items, part.column("seq").to_pylist(), block, False, False)
            yield nodes
            blocks.append(spines)
            if len(blocks) == FAN:
                nodes, spines = _again([s for b in blocks for s in b], block, False)
                yield nodes
                blocks = [spines]
    if len(blocks) > 1:
        nodes, spines = _again([s for b in blocks for s in b], block, False)
        yield nodes
        blocks = [spines]
    for spines in blocks:
        yield _spine_rows(block, spines)


def _merge(final: bool):
    def merge(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("block", "ascending"), ("depth", "ascending")])
        spines = []
        for path, items, seqs in zip(*(table.column(c).to_pylist() for c in ("path", "items", "seqs"))):
            held = [seqs[a + 1:a + 17] if seqs[a] else b"" for a in range(0, len(seqs), 17)]
            spines.append((path, np.frombuffer(items, np.int64).reshape(-1, 6), held))
        nodes, left = _again(spines, -1, final)
        out = [nodes] if final else [nodes, _spine_rows(key[0].as_py(), left)]
        return pa.Table.from_batches(out)

    return merge


def prefix_trie(seqs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(nodes, ended)`` of the trie over ``seqs`` (``conv_id`` long, unique; ``path`` as
    ``sequences`` gives it).

    A node is a distinct sequence of the first ``depth`` turns, from the root of depth 0;
    ``conv_id``, its smallest member, tells nodes of one depth apart. Further columns:
    ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``, ``n_leaves`` (childless
    nodes in its subtree, itself included), ``saved_tokens`` (over its subtree, the words of
    each node's last turn once for every member but one) and ``seq``, which names the
    conversations that end at it in ``ended`` (``seq, conv_id``) and is null if there are none.
    A conversation without turns ends at the root. No conversations give no nodes."""
    path = F.unhex(F.array_join("path", ""))
    ended = stored(seqs.select("conv_id", path.alias("path"), F.unhex(F.md5(path)).alias("seq")), "trie-paths")
    distinct = ended.groupBy("path", "seq").agg(F.min("conv_id").alias("conv"), F.count(F.lit(1)).alias("n"))
    peeled = stored(distinct.repartitionByRange("path").sortWithinPartitions("path").mapInArrow(_peel_ranges, _PEELED),
                    "trie-peeled")
    parts = [peeled.where("path is null")]
    spines = peeled.where("path is not null")
    blocks = (spines.agg(F.max("block")).first()[0] or 0) + 1
    while True:
        final = blocks <= FAN
        merged = stored(spines.withColumn("_group", F.floor(F.col("block") / FAN).cast("long")).groupBy("_group")
                        .applyInArrow(_merge(final), _PEELED), "trie-merged")
        parts.append(merged.where("path is null"))
        if final:
            break
        spines, blocks = merged.where("path is not null"), -(-blocks // FAN)
    nodes = parts[0]
    for more in parts[1:]:
        nodes = nodes.unionByName(more)
    # nodes below one that was still open: its smallest member is known by now
    waiting = nodes.where("parent_key is not null").drop("parent_conv_id")
    known = nodes.where("key is not null").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    told = waiting.select("block", "parent_key").distinct().join(known, "parent_key")
    whole = nodes.where("parent_key is null").unionByName(waiting.join(told, ["block", "parent_key"]))
    return (whole.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "seq"),
            ended.select("seq", "conv_id"))


# ------------------------------------------------------------------ lists of ended conversations

def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Comma-joined ids of each run of equal ``seq`` of a sorted partition, in pieces; a run
    that touches the partition's edge or a piece's limit is not ``whole``."""
    current, ids, size, cut = None, [], 0, True  # cut: the run may have begun before
    out: list[tuple] = []

    def flush(whole: bool) -> None:
        if ids:
            out.append((current, int(ids[0]), ",".join(ids), whole))

    def batch_of() -> pa.RecordBatch:
        cols = list(zip(*out)) or [[], [], [], []]
        out.clear()
        return pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.string(), pa.bool_()))],
                               ["seq", "first", "ids", "whole"])

    for batch in batches:
        for seq, conv in zip(batch.column("seq").to_pylist(), batch.column("conv_id").to_pylist()):
            if seq != current:
                flush(not cut)
                cut = current is None
                current, ids, size = seq, [], 0
            elif size > PIECE:
                flush(False)
                ids, size, cut = [], 0, True
            text = str(conv)
            ids.append(text)
            size += len(text) + 1
        yield batch_of()
    flush(False)
    yield batch_of()


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, h = None, hashlib.sha256()
    for batch in batches:
        out = []
        for seq, ids in zip(batch.column("seq").to_pylist(), batch.column("ids").to_pylist()):
            if seq != current:
                if current is not None:
                    out.append((current, h.hexdigest()))
                current, h = seq, hashlib.sha256(ids.encode())
            else:
                h.update(b"," + ids.encode())
        yield pa.record_batch([pa.array([s for s, _ in out], pa.binary()), pa.array([x for _, x in out], pa.string())],
                              ["seq", "digest"])
    if current is not None:
        yield pa.record_batch([pa.array([current], pa.binary()), pa.array([h.hexdigest()])], ["seq", "digest"])


def ended_digests(ended: DataFrame) -> DataFrame:
    """``seq, digest``: the SHA-256 of the decimal ids that ended together, ascending and
    joined by commas. Runs of ids are joined where the sorted ranges lie; the pieces of a
    long run are hashed one after the other, without ever being held together."""
    pieces = stored(ended.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
                    .mapInArrow(_pieces, "seq binary, first long, ids string, whole boolean"), "trie-pieces")
    whole = pieces.where("whole").select("seq", F.sha2("ids", 256).alias("digest"))
    rest = pieces.where("not whole").select("seq", "first", "ids").repartition("seq").sortWithinPartitions("seq", "first")
    return whole.unionByName(rest.mapInArrow(_hash_pieces, "seq binary, digest string"))


def digested(nodes: DataFrame, ended: DataFrame) -> DataFrame:
    """``nodes`` with ``ends_sha256`` instead of ``seq``; nodes where none ends get the digest
    of the empty string."""
    some = nodes.where("seq is not null").join(ended_digests(ended), "seq")
    none = nodes.where("seq is null").withColumn("digest", F.sha2(F.lit(""), 256))
    return some.unionByName(none).withColumnRenamed("digest", "ends_sha256").drop("seq")
