"""Operator 13, n-gram Jaccard join: vertical partitioning.

A document is its set of distinct ``GRAM``-word shingles, in one global order, that of their
64-bit hashes. The order is cut into fragments, so that every set falls into segments, and
whatever two sets share they share segment by segment.

Candidates: two sets of ``n`` and ``m`` shingles with a Jaccard similarity of at least
``t`` percent differ in at most ``(100 - t) * (n + m) / (100 + t)`` shingles. Cut into more
fragments than that, they have equal segments in at least one of them, so sets meet only
where a whole segment is equal. A frequent passage or shingle makes no candidates by itself:
the other shingles of a segment go with it. Sets of similar size are cut alike (``_classes``);
a set near the upper end of its class is cut as the next one too. Equal *empty* segments say
nothing: a few fragments more than needed make up for them, and a set with more empty segments
than that is cut once more with other hashes, again until it has fewer; a pair that no
earlier cut brings together has such a last cut in common. So no link is lost.

Verification: the sets of a candidate pair are cut into ``PARTS`` fragments, the overlaps are
counted in each fragment separately and summed per pair.

Equal sets collapse to one node first. In a bucket of equal segments each node is paired with
the bucket's hub, the node that meets most others; buckets whose nodes then lie in one
component are done. In the others the next hubs are nodes of other components, for
``HUB_ROUNDS`` rounds; what is still apart after them is compared across components in blocks,
inside tasks. A bucket of copies costs its size, and no pair but a node with its hub becomes a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import flat_words, mix64, stored, text_slices, whole_text, word_hashes
from rivulet.llm.graph import components

GRAM = 3
PERCENT = 90
#: Fragments of the order in which overlaps are counted.
PARTS = 4
HUB_ROUNDS = 1
#: Sets of a cluster, and bytes of them, that are compared with as many others at a time.
BLOCK, BLOCK_BYTES = 512, 8 << 20
_COLUMNS = 4096
#: Sizes in one class differ by this factor at most.
_SPREAD = 1.5
_ORDER = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(texts: pa.Array, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(text, 64-bit hash) of the distinct shingles of each text, in the global order. A text
    of fewer words is one shingle; one without words has none. ASCII letters count as lower case."""
    doc, code, distinct = flat_words(texts)
    h = word_hashes(_ascii_lower(distinct), 13)[code]
    n, size = len(h), np.bincount(doc, minlength=len(texts))
    width = np.minimum(gram, size)
    left = np.repeat(np.cumsum(size), size) - np.arange(n)
    first = np.flatnonzero(left >= width[doc])
    owner = doc[first]
    value = mix64(width[owner].astype(np.uint64))
    for k in range(gram):
        value = np.where(k < width[owner], mix64(value * _ORDER + h[np.minimum(first + k, max(n - 1, 0))]), value)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return owner[new], value[new]


def _ascii_lower(words: pa.Array) -> pa.Array:
    """A-Z as a-z, every other letter as it is."""
    words = words.cast(pa.large_string())
    if len(words) == 0:
        return words
    _, offsets, data = words.buffers()
    raw = np.frombuffer(data, np.uint8).copy() if data is not None else np.zeros(0, np.uint8)
    raw[(raw >= 65) & (raw <= 90)] += 32
    return pa.Array.from_buffers(pa.large_string(), len(words), [None, offsets, pa.py_buffer(raw)], offset=words.offset)


# ------------------------------------------------------------------ cuts

def _classes(top: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(least size of each class, largest size that can link into it, fragments it is cut into,
    empty segments it can put up with) for sizes up to ``top``. Class ``k`` finds the links
    whose smaller set is in it."""
    least = [1]
    while least[-1] <= top:
        least.append(max(least[-1] + 1, int(least[-1] * _SPREAD)))
    smaller = np.array(least[1:], np.int64) - 1
    larger = smaller * 100 // percent
    differ = (100 - percent) * (smaller + larger) // (100 + percent)
    slack = 2 + differ // 50
    return np.array(least[:-1], np.int64), larger, differ + 1 + slack, slack


def _signatures(owner: np.ndarray, value: np.ndarray, kind: np.ndarray, fragments: np.ndarray,
                seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, signature) of every segment that is not empty, when ``kind`` (class of each
    text) says how it is cut."""
    if seed:
        value = mix64(value + np.uint64(seed) * _ORDER)
    cut = ((value >> np.uint64(32)) * fragments[owner].astype(np.uint64)) >> np.uint64(32)
    order = np.lexsort((cut, owner))
    who, cut, what = owner[order], cut[order], mix64(value[order] ^ _ORDER)
    new = np.ones(len(who), bool)
    new[1:] = (who[1:] != who[:-1]) | (cut[1:] != cut[:-1])
    at = np.flatnonzero(new)
    if len(at) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.add.reduceat(what, at)
    name = (kind[who[at]].astype(np.uint64) << np.uint64(40)) + (np.uint64(seed) << np.uint64(32)) + cut[at]
    return who[at], mix64(total + mix64(name))


def cuts(owner: np.ndarray, value: np.ndarray, n: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, signature) of all segments by which the ``n`` sets can meet others. Sets so small
    that only an equal one can link to them have none."""
    size = np.bincount(owner, minlength=n)
    least, larger, fragments, slack = _classes(max(1, int(size.max(initial=1))), percent)
    own = np.searchsorted(least, size, side="right") - 1
    out = []
    # of two sets that differ and are linked, each has at least so many shingles
    enough = size * (100 - percent) >= percent
    below = np.maximum(own - 1, 0)
    for kind, mine in ((own, enough), (below, enough & (own > 0) & (size <= larger[below]))):
        seed = 0
        while mine.any():
            k = np.maximum(kind, 0)
            pick = mine[owner]
            who, sign = _signatures(owner[pick], value[pick], k, fragments[k], seed)
            out.append((who, sign))
            empty = fragments[k] - np.bincount(who, minlength=n)
            mine = mine & (empty > slack[k])
            seed += 1
    return (np.concatenate([w for w, _ in out]), np.concatenate([s for _, s in out])) if out else (
        np.zeros(0, np.int64), np.zeros(0, np.uint64))


# ------------------------------------------------------------------ Spark

def _sign(gram: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "_text"):
                n = part.num_rows
                owner, value = shingle_sets(part.column("_text"), gram)
                size = np.bincount(owner, minlength=n)
                who, sign = cuts(owner, value, n, percent)
                order = np.argsort(who, kind="stable")
                at = np.searchsorted(who[order], np.arange(n + 1))
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(sign[order].view(np.int64)))
                # the whole set's name: two independent sums of 64 bits
                names = []
                for salt in (17, 29):
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(value + np.uint64(salt)), dtype=np.uint64)])
                    ends = np.cumsum(size)
                    names.append(total[ends] - total[ends - size])
                raw = np.stack(names, 1).astype("<u8").tobytes()
                keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), n, [None, pa.py_buffer(raw)]).cast(pa.binary())
                yield pa.record_batch({"_id": part.column("_id"), "_key": part.column("_key"), "name": keys,
                                       "size": pa.array(size), "signs": lists})

    return run


def _segments(gram: int):
    """Segments of the sets in the fragments of the order, to count overlaps in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "_text"):
                owner, value = shingle_sets(part.column("_text"), gram)
                cut = ((value >> np.uint64(32)) * np.uint64(PARTS)) >> np.uint64(32)
                at = np.searchsorted(owner * PARTS + cut.astype(np.int64), np.arange(part.num_rows * PARTS + 1))
                raw = value.tobytes()
                yield pa.record_batch({
                    "uid": pa.array(np.repeat(part.column("uid").to_numpy(), PARTS)),
                    "part": pa.array(np.tile(np.arange(PARTS, dtype=np.int32), part.num_rows)),
                    "held": pa.array([raw[8 * a:8 * b] for a, b in zip(at.tolist(), at[1:].tolist())], pa.binary())})

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlap of two segments in every row."""
    for batch in batches:
        for part in text_slices(batch, "ha"):
            rows, values = [], []
            for side in ("ha", "hb"):
                n = pc.binary_length(part.column(side)).to_numpy(zero_copy_only=False).astype(np.int64) // 8
                rows.append(np.repeat(np.arange(len(n)), n))
                values.append(np.frombuffer(b"".join(part.column(side).to_pylist()), np.uint64))
            row, value = np.concatenate(rows), np.concatenate(values)
            order = np.lexsort((value, row))
            row, value = row[order], value[order]
            twice = (row[1:] == row[:-1]) & (value[1:] == value[:-1])
            both = np.bincount(row[1:][twice], minlength=part.num_rows)
            yield pa.record_batch({"a": part.column("a"), "b": part.column("b"), "both": pa.array(both)})


def _verified(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a, b, na, nb``) whose sets are similar: overlaps are counted in every
    fragment and summed."""
    left = segments.select(F.col("uid").alias("a"), "part", F.col("held").alias("ha"))
    right = segments.select(F.col("uid").alias("b"), "part", F.col("held").alias("hb"))
    met = pairs.select("a", "b").join(left, "a").join(right, ["b", "part"]).select("a", "b", "ha", "hb")
    total = met.mapInArrow(_shared, "a long, b long, both long").groupBy("a", "b").agg(F.sum("both").alias("both"))
    return pairs.join(total, ["a", "b"]).where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))
                                               ).select("a", "b")


def _fits(n: Column, m: Column, percent: int) -> Column:
    """Whether sets of these sizes can be similar."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _star(bucket: DataFrame, hubs: DataFrame, percent: int) -> DataFrame:
    """Every node of a bucket with the bucket's hub (``sign, hub, nh, hroot``), unless they are
    in one component or differ too much in size."""
    met = bucket.join(hubs, "sign").where((F.col("root") != F.col("hroot")) & _fits(F.col("size"), F.col("nh"), percent))
    return met.select(F.col("hub").alias("a"), F.col("uid").alias("b"), F.col("nh").alias("na"), F.col("size").alias("nb")
                      ).distinct()


def _roots(links: DataFrame) -> DataFrame:
    return components(links).select(F.col("node").alias("uid"), F.col("root").alias("found"))


def _torn(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """``shared`` with the nodes' components, without the buckets that lie in one component."""
    placed = shared.drop("root").join(roots, "uid", "left").withColumn("root", F.coalesce("found", "uid")).drop("found")
    open_ = placed.groupBy("sign").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    return placed.join(open_.select("sign"), "sign", "left_semi")


def _overlaps(held: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many shingles each left set shares with each right one in one fragment: products of
    0/1 matrices, a stretch of the shingles that two sets or more have at a time."""
    out = np.zeros((len(left), len(right)), np.float32)
    row = np.repeat(np.arange(len(held)), [len(x) for x in held])
    _, column, count = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
    row, column = row[count[column] > 1], (np.cumsum(count > 1) - 1)[column[count[column] > 1]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        lo, hi = np.searchsorted(column, (start, start + _COLUMNS))
        there = np.zeros((len(held), _COLUMNS), np.float32)
        there[row[lo:hi], column[lo:hi] - start] = 1
        out += there[left] @ there[right].T
    return out


def _joined(uid: np.ndarray, root: np.ndarray, alike: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Of the similar pairs, as few as join the same components."""
    top = {int(r): int(r) for r in np.unique(root)}

    def find(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(alike)):
        i, j = left[i], right[j]
        x, y = find(int(root[i])), find(int(root[j]))
        if x != y:
            top[x] = y
            out.append((int(uid[i]), int(uid[j])))
    return out


def _within(torn: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """Links between components that share a bucket. The sets that buckets hold together form
    clusters; a cluster is cut into blocks, and the sets of every two blocks are compared
    inside a task, fragment by fragment, so that pairs never become rows. Small clusters share a task."""
    hubs = torn.groupBy("sign").agg(F.min("uid").alias("a"))
    edges = torn.join(hubs, "sign").select("a", F.col("uid").alias("b")).distinct()
    cluster = components(edges).select(F.col("node").alias("uid"), F.col("root").alias("cluster"))
    nodes = stored(torn.select("uid", "size", "root").distinct().join(cluster, "uid"), "gram-clusters")
    tasks = nodes.agg(F.sum("size")).first()[0] * 8 // BLOCK_BYTES + 1
    blocks = nodes.groupBy("cluster").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("size") * 8 / BLOCK_BYTES)).alias("blocks"))
    dealt = nodes.join(blocks, "cluster").withColumn("block", F.pmod(F.xxhash64("uid"), "blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    task = F.when(F.col("blocks") > 1, F.col("cluster")).otherwise(-1 - F.pmod(F.xxhash64("cluster"), F.lit(tasks)))
    dealt = dealt.select("uid", "size", "root", "cluster", "block", task.alias("task"),
                         F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))

    def compare(t: pa.Table) -> pa.Table:
        found = []
        t = t.sort_by([("cluster", "ascending"), ("uid", "ascending"), ("part", "ascending")])
        lo, hi = t.column("lo")[0].as_py(), t.column("hi")[0].as_py()
        first = slice(None, None, PARTS)
        uid, size, root, cluster, block = (t.column(c).to_numpy()[first] for c in ("uid", "size", "root", "cluster", "block"))
        held = t.column("held").combine_chunks()
        cut = np.flatnonzero(np.diff(cluster, prepend=-1, append=-1))
        for x, y in zip(cut, cut[1:]):
            left = np.flatnonzero(block[x:y] == lo)
            right = left if lo == hi else np.flatnonzero(block[x:y] == hi)
            both = np.zeros((len(left), len(right)), np.float32)
            for part in range(PARTS):
                both += _overlaps([np.frombuffer(held[k * PARTS + part].as_buffer(), np.uint64) for k in range(x, y)], left, right)
            n, m = size[x:y][left][:, None], size[x:y][right][None, :]
            alike = (100 * both >= percent * (n + m - both)) & (root[x:y][left][:, None] != root[x:y][right][None, :])
            found += _joined(uid[x:y], root[x:y], alike, left, right)
        return pa.table({"a": pa.array([i for i, _ in found], pa.int64()), "b": pa.array([j for _, j in found], pa.int64())})

    return dealt.join(segments, "uid").groupBy("task", "lo", "hi").applyInArrow(compare, "a long, b long")


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM,
               percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """``(members, links)``. ``members`` has a row per document: ``id_col, n_shingles, uid,
    component``; documents with equal sets share ``uid``. ``links`` (``a, b``, of ``uid``) joins all
    sets of a component with at least ``percent`` percent Jaccard similarity by verified links.

    Null and empty texts and texts without words have an empty set, are linked with nothing
    and have no ``uid`` (``component`` null too). A text of fewer than ``gram`` words is one shingle
    and equals only the same words. Null and repeated ids are rows like any other; other columns
    are ignored; an empty table gives an empty result; long texts count whole."""
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("_id"), F.unhex(F.md5(whole_text(text_col))).alias("_key"),
                        whole_text(text_col).alias("_text"))
    signed = stored(texts.mapInArrow(_sign(gram, percent), f"_id {id_type}, _key binary, name binary, size long, "
                                     "signs array<long>"), "gram-signed")
    nodes = stored(signed.where("size > 0").groupBy("name").agg(
        F.min("_key").alias("_key"), F.first("size").alias("size"), F.first("signs").alias("signs"))
        .withColumn("uid", F.monotonically_increasing_id()), "gram-nodes")
    entry = nodes.select("uid", "size", F.explode("signs").alias("sign"))
    many = entry.groupBy("sign").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(entry.join(many, "sign").withColumn("root", F.col("uid")), "gram-shared")

    # whole texts of the sets that met others, cut into the fragments that overlaps are counted in
    wanted = shared.select("uid").distinct().join(nodes.select("uid", "_key"), "uid")
    one = texts.groupBy("_key").agg(F.first("_text").alias("_text"))
    segments = stored(wanted.join(one, "_key").select("uid", "_text").mapInArrow(
        _segments(gram), "uid long, part int, held binary"), "gram-segments")

    # the first hub of a bucket meets most others in all its buckets
    meets = shared.groupBy("uid").agg(F.sum("n").alias("meets"))
    rank = F.struct(F.col("meets"), -F.col("uid"))
    torn, links = shared, None
    for turn in range(HUB_ROUNDS):
        if turn == 0:
            first = torn.join(meets, "uid").withColumn("rank", rank)
        else:  # another component's node, another one in each round
            first = torn.withColumn("rank", F.struct(F.xxhash64("root", F.lit(turn)), -F.col("uid")))
        hubs = first.groupBy("sign").agg(F.max(F.struct("rank", "uid", "size", "root")).alias("h")).select(
            "sign", F.col("h.uid").alias("hub"), F.col("h.size").alias("nh"), F.col("h.root").alias("hroot"))
        new = stored(_verified(stored(_star(torn, hubs, percent), "gram-star"), segments, percent), "gram-links")
        links = new if links is None else stored(links.unionByName(new), "gram-links")
        roots = _roots(links)
        torn = stored(_torn(torn, roots), "gram-torn")
        if torn.isEmpty():
            break
    else:
        new = stored(_within(torn, segments, percent), "gram-links")
        links = links.unionByName(new)
        roots = _roots(links)
    placed = stored(nodes.select("name", "uid").join(roots, "uid", "left").select(
        "name", "uid", F.coalesce("found", "uid").alias("component")), "gram-placed")
    rows = signed.select(F.col("_id").alias(id_col), F.col("size").alias("n_shingles"), "name")
    some = rows.where("n_shingles > 0").join(placed, "name").drop("name")
    none = rows.where("n_shingles = 0").drop("name").withColumns(
        {"uid": F.lit(None).cast("long"), "component": F.lit(None).cast("long")})
    return some.unionByName(none), links


def smallest_ids(members: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id_col, n_shingles, component_id``: the smallest document id that links reach; a
    document that is linked with nothing has its own."""
    members = stored(members, "gram-members")
    least = members.where("component is not null").groupBy("component").agg(F.min(id_col).alias("component_id"))
    some = members.join(least, "component").select(id_col, "n_shingles", "component_id")
    return some.unionByName(members.where("component is null").select(id_col, "n_shingles", F.col(id_col).alias("component_id")))
