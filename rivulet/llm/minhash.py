"""Operator 6, near-dedup: ProbMinHash, banding and exact verification.

A text is a weighted set of its ``SHINGLE``-word runs, weighted by how often each occurs.
ProbMinHash (Ertl, 2020) lets every element send arrivals, a Poisson process whose rate is
its weight, to random registers; a register remembers the element that came first. Two
texts agree in a register with the probability Jaccard similarity
``J_P = sum_i 1 / sum_j max(a_j/a_i, b_j/b_i)``, which is the plain Jaccard similarity when
all weights are 1. An element stops as soon as its next arrival is later than the latest
register, so a text costs its length plus ``m log m``, not length times ``m``.

Equal texts collapse to one node first. Nodes meet in bands of registers. In every bucket
each node is compared with the bucket's hub only, the node that meets most others; buckets
that these links join into one component are finished. In the others the nodes of
different components are compared as well, block against block inside a task: no pair
becomes a row, only the links that join components do. So no link that decides the classes
is lost, and a bucket of many copies costs its size. Every link is verified by the exact
similarity of the two whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import flat_words, mix64, stored, text_slices, whole_text, word_hashes
from rivulet.llm.graph import components

SHINGLE = 5
THRESHOLD = 0.8
#: A pair at the threshold misses every band with probability (1 - 0.8**6)**32 < 1e-4.
BANDS, ROWS = 32, 6
#: Nodes of a bucket, and bytes of their shingles, that are compared with as many others at
#: a time. Larger buckets are cut into blocks, and every two blocks are compared.
BLOCK_NODES, BLOCK_BYTES = 256, 8 << 20
_COLUMNS = 4096
_ORDER = np.uint64(0xD6E8FEB86659FD93)


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, 64-bit hash, count) of the distinct shingles of each text, sorted. A text of
    fewer than five words is one shingle; one without words has none."""
    doc, code, distinct = flat_words(texts)
    h = word_hashes(distinct, 3)[code]
    n, size = len(h), np.bincount(doc, minlength=len(texts))
    width = np.minimum(SHINGLE, size)
    left = np.repeat(np.cumsum(size), size) - np.arange(n)  # words from here to the text's end
    first = np.flatnonzero(left >= width[doc])
    value = mix64(width[doc[first]].astype(np.uint64))
    for k in range(SHINGLE):
        word = h[np.minimum(first + k, n - 1)]
        value = np.where(k < width[doc[first]], mix64(value * _ORDER + word), value)
    owner = doc[first]
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return owner[at], value[at], np.diff(np.append(at, len(owner)))


def prob_minhash(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, m: int) -> np.ndarray:
    """Registers (n x m) of the weighted sets; a set without elements keeps zeros."""
    time = np.full(n * m, np.inf)
    held = np.zeros(n * m, np.uint64)
    clock = np.zeros(len(element))
    turn = np.uint64(0)
    while len(element):
        turn += np.uint64(1)
        r = mix64(element ^ mix64(np.array([turn * np.uint64(2)], np.uint64)))
        uniform = ((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
        clock = clock - np.log(uniform) / weight
        pick = mix64(element ^ mix64(np.array([turn * np.uint64(2) + np.uint64(1)], np.uint64)))
        slot = owner * m + (pick % np.uint64(m)).astype(np.int64)
        np.minimum.at(time, slot, clock)
        won = clock == time[slot]
        held[slot[won]] = element[won]
        latest = time.reshape(n, m).max(1)
        on = clock < latest[owner]
        owner, element, weight, clock = owner[on], element[on], weight[on], clock[on]
    return held.reshape(n, m)


def similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Exact probability Jaccard of two weighted sets with sorted distinct elements."""
    common, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(common) == 0:
        return 0.0
    if wa.max() == 1 and wb.max() == 1:
        return len(common) / (len(a) + len(b) - len(common))
    x, y = wa[ia].astype(np.float64), wb[ib].astype(np.float64)
    ratio = x / y
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    # for element i: elements with a larger a/b ratio count by a, the others by b
    above = x.sum() - np.concatenate([[0.0], np.cumsum(x)])
    below = np.concatenate([[0.0], np.cumsum(y)])
    split = np.searchsorted(ratio, ratio, side="left")
    only_a, only_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    return float((1 / ((above[split] + only_a) / x + (below[split] + only_b) / y)).sum())


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "_text"):
            n = part.num_rows
            owner, element, count = shingles(part.column("_text"))
            held = prob_minhash(owner, element, count.astype(np.float64), n, BANDS * ROWS).reshape(n, BANDS, ROWS)
            band = np.zeros((n, BANDS), np.uint64)
            for r in range(ROWS):
                band = mix64(band * _ORDER + held[:, :, r])
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, (n + 1) * BANDS, BANDS), pa.int32()), pa.array(band.ravel().view(np.int64)))
            some = np.bincount(owner, minlength=n) > 0
            yield pa.record_batch({"_key": part.column("_key"),
                                   "bands": pc.if_else(pa.array(some), lists, pa.scalar(None, lists.type))})


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "_text"):
            owner, element, count = shingles(part.column("_text"))
            at = np.searchsorted(owner, np.arange(part.num_rows + 1))
            yield pa.record_batch({
                "uid": part.column("uid"),
                "elements": pa.array([element[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary()),
                "counts": pa.array([count[a:b].astype(np.uint32).tobytes() for a, b in zip(at, at[1:])], pa.binary())})


def _verify(pairs: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``(a, b)`` whose texts are similar."""
    def side(name):
        return bags.select(F.col("uid").alias(name), F.col("elements").alias(f"e{name}"), F.col("counts").alias(f"c{name}"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for ea, ca, eb, cb in zip(*(batch.column(c) for c in ("ea", "ca", "eb", "cb"))):
                a, b = np.frombuffer(ea.as_buffer(), np.uint64), np.frombuffer(eb.as_buffer(), np.uint64)
                wa, wb = np.frombuffer(ca.as_buffer(), np.uint32), np.frombuffer(cb.as_buffer(), np.uint32)
                keep.append(similarity(a, wa, b, wb) >= threshold)
            yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b")}).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.select("a", "b", "ea", "ca", "eb", "cb").mapInArrow(check, "a long, b long")


def _overlaps(bags: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many elements each left bag shares with each right bag: products of 0/1 matrices,
    a stretch of the elements at a time."""
    size = np.array([len(b) for b in bags])
    _, column = np.unique(np.concatenate(bags), return_inverse=True)
    row = np.repeat(np.arange(len(bags)), size)
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        lo, hi = np.searchsorted(column, (start, start + _COLUMNS))
        part = np.zeros((len(bags), _COLUMNS), np.float32)
        part[row[lo:hi], column[lo:hi] - start] = 1
        out += part[left] @ part[right].T
    return out


def _links(band: int, uid: np.ndarray, root: np.ndarray, bands: np.ndarray, left: np.ndarray, right: np.ndarray,
           bags: list[np.ndarray], counts: list[np.ndarray], threshold: float) -> list[tuple[int, int]]:
    """Links between left and right nodes of one bucket, as few as join the same nodes: of
    the pairs of different roots that meet in no earlier band."""
    met = root[left][:, None] == root[right][None, :]
    for k in range(band):
        met |= bands[left, k][:, None] == bands[right, k][None, :]
    a, b = np.nonzero(~met & (uid[left][:, None] < uid[right][None, :])) if left is right else np.nonzero(~met)
    if len(a) == 0:
        return []
    size = np.array([len(x) for x in bags])
    shared = _overlaps(bags, left, right)[a, b]
    a, b = left[a], right[b]
    plain = np.array([len(c) == 0 or c.max() == 1 for c in counts])
    alike = shared >= threshold * (size[a] + size[b] - shared)
    alike &= plain[a] & plain[b]
    top = {int(r): int(r) for r in np.unique(root)}

    def find(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    out = []
    for k in np.flatnonzero(alike | ~(plain[a] & plain[b]) & (shared > 0)):
        i, j = a[k], b[k]
        x, y = find(int(root[i])), find(int(root[j]))
        if x != y and (alike[k] or similarity(bags[i], counts[i], bags[j], counts[j]) >= threshold):
            top[x] = y
            out.append((int(uid[i]), int(uid[j])))
    return out


def _cross_links(torn: DataFrame, nodes: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """Links ``(a, b)`` between the components that share a bucket of ``torn`` (``band, value,
    uid, root``). A node goes to every pair of blocks that its block is part of."""
    size = bags.select("uid", (F.length("elements") + F.length("counts")).alias("bytes"))
    blocks = torn.join(size, "uid").groupBy("band", "value").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_NODES), F.ceil(F.sum("bytes") / BLOCK_BYTES)).alias("blocks"))
    dealt = torn.join(blocks, ["band", "value"]).withColumn("block", F.pmod(F.xxhash64("uid"), "blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("band", "value", "uid", "root", "block", F.least("block", "other").alias("lo"),
                         F.greatest("block", "other").alias("hi"))
    full = dealt.join(bags, "uid").join(nodes.select("uid", "bands"), "uid")

    def compare(t: pa.Table) -> pa.Table:
        uid, root, block, lo, hi = (t.column(c).to_numpy() for c in ("uid", "root", "block", "lo", "hi"))
        bands = np.stack(t.column("bands").to_pylist())
        bag = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("elements")]
        count = [np.frombuffer(x.as_buffer(), np.uint32) for x in t.column("counts")]
        left = np.flatnonzero(block == lo)
        right = left if lo[0] == hi[0] else np.flatnonzero(block == hi)
        found = _links(int(t.column("band")[0].as_py()), uid, root, bands, left, right, bag, count, threshold)
        return pa.table({"a": pa.array([i for i, _ in found], pa.int64()), "b": pa.array([j for _, j in found], pa.int64())})

    return full.groupBy("band", "value", "lo", "hi").applyInArrow(compare, "a long, b long")


def classes(rows: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(_key, root)`` for every distinct text: equal ``root`` means the same class.
    ``rows`` has ``_key``; ``texts`` has ``_key`` and ``_text``, copies allowed."""
    signed = texts.mapInArrow(_signatures, "_key binary, bands array<long>")
    nodes = stored(signed.groupBy("_key").agg(F.first("bands").alias("bands"))
                   .withColumn("uid", F.monotonically_increasing_id()), "near-nodes")
    member = nodes.select("uid", F.posexplode("bands").alias("band", "value"))
    many = member.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(member.join(many, ["band", "value"]), "near-shared")
    # a bucket's hub: the node that meets most others in all its buckets, of equals the least
    meets = shared.groupBy("uid").agg(F.sum("n").alias("meets"))
    rank = (F.col("meets").cast("decimal(18,0)") * F.lit(str(1 << 63)).cast("decimal(19,0)")
            - F.col("uid")).cast("decimal(38,0)")
    hubs = shared.join(meets, "uid").groupBy("band", "value").agg(F.max_by("uid", rank).alias("hub"))
    star = stored(shared.join(hubs, ["band", "value"]).where("uid != hub")
                  .select(F.col("hub").alias("a"), F.col("uid").alias("b")).distinct(), "near-star")

    wanted = shared.select("uid").distinct().join(nodes.select("uid", "_key"), "uid")
    one = texts.groupBy("_key").agg(F.first("_text").alias("_text"))
    bags = stored(wanted.join(one, "_key").select("uid", "_text").mapInArrow(
        _bags, "uid long, elements binary, counts binary"), "near-bags")

    links = stored(_verify(star, bags, threshold), "near-links")
    root = components(links)
    placed = shared.join(root.withColumnRenamed("node", "uid"), "uid", "left").select(
        "band", "value", "uid", F.coalesce("root", "uid").alias("root"))
    torn = placed.groupBy("band", "value").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                               F.count(F.lit(1)).alias("n")).where("lo < hi and n > 2")
    torn = stored(placed.join(torn.select("band", "value"), ["band", "value"]), "near-torn")
    more = stored(_cross_links(torn, nodes, bags, threshold), "near-links")
    root = components(links.unionByName(more))
    return nodes.select("_key", "uid").join(root.withColumnRenamed("node", "uid"), "uid", "left").select(
        "_key", F.coalesce("root", "uid").alias("root"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"), F.unhex(F.md5(whole_text(text_col))).alias("_key"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``id_col, class_id, class_size, kept``.

    A class is a connected component of texts with at least ``threshold`` probability
    Jaccard similarity of their weighted five-word shingles; its id is its smallest document id, and the
    row with that id is the one kept (null ids last; of rows that share it exactly one).
    Equal texts are one class, empty and null ones too; a text without words is similar to
    no other text; other columns are ignored; an empty table gives an empty result."""
    rows = stored(_keyed(docs, id_col, text_col).withColumn("_row", F.monotonically_increasing_id()), "near-rows")
    texts = docs.select(F.unhex(F.md5(whole_text(text_col))).alias("_key"), whole_text(text_col).alias("_text"))
    placed = stored(rows.join(classes(rows, texts, threshold), "_key").select("_id", "_row", "root"), "near-placed")
    found = placed.groupBy("root").agg(
        F.min("_id").alias("class_id"), F.coalesce(F.min_by("_row", "_id"), F.min("_row")).alias("_first"),
        F.count(F.lit(1)).alias("class_size"))
    return placed.join(found, "root").select(
        F.col("_id").alias(id_col), "class_id", "class_size", (F.col("_row") == F.col("_first")).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that ``near_dedup`` keeps, with their own columns."""
    names = docs.columns
    pid = F.coalesce(F.col(id_col).cast("string"), F.lit("\x01"))
    key = F.unhex(F.md5(whole_text(text_col)))
    rows = stored(docs.select(pid.alias("_pid"), F.col(id_col).alias("_id"), key.alias("_key")), "near-rows")
    texts = docs.select(key.alias("_key"), whole_text(text_col).alias("_text"))
    placed = stored(rows.join(classes(rows, texts, threshold), "_key").select("_id", "_pid", "_key", "root"), "near-placed")
    best = placed.groupBy("root").agg(F.min("_id").alias("class_id"))
    chosen = placed.join(best, "root").where(F.col("_id").eqNullSafe(F.col("class_id"))).groupBy("root").agg(
        F.min(F.struct("_key", "_pid")).alias("_k")).select("_k.*")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), pid.alias("_pid"), key.alias("_key"))
    nth = F.row_number().over(Window.partitionBy("_key", "_pid").orderBy("_pid"))
    return (whole.join(chosen, ["_key", "_pid"]).withColumn("_nth", nth).where("_nth = 1").select("_row.*"))
