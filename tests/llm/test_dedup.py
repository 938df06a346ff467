"""Near-dedup (ProbMinHash) and substring dedup (super-k-mers) against brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from cases import PROSE, docs, empty, prose, rows
from rivulet.llm import minhash, substring_dedup
from rivulet.llm.graph import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def _bag(text):
    w = WORDS.findall(text or "")
    return collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def _jp(a, b):
    every = set(a) | set(b)
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in every) for i in set(a) & set(b))


def test_similarity_is_probability_jaccard():
    rnd = random.Random(0)
    for _ in range(200):
        a = {rnd.randrange(12): rnd.randint(1, 4) for _ in range(rnd.randint(1, 9))}
        b = {rnd.randrange(12): rnd.randint(1, 4) for _ in range(rnd.randint(1, 9))}
        arrays = [np.array(x) for s in (a, b) for x in (sorted(s), [s[k] for k in sorted(s)])]
        want = _jp(collections.Counter(a), collections.Counter(b))
        assert minhash.similarity(*arrays) == pytest.approx(want)


def test_registers_estimate_probability_jaccard():
    a = {i: 1 + i % 3 for i in range(40)}
    b = {i: 1 + i % 2 for i in range(10, 60)}
    owner = np.array([0] * len(a) + [1] * len(b))
    weight = np.array([*a.values(), *b.values()], float)
    found = []
    for seed in range(20):
        element = minhash.mix64(np.array([*a, *b], np.uint64) + np.uint64(1000 * seed))
        held = minhash.prob_minhash(owner, element, weight, 2, 1024)
        found.append((held[0] == held[1]).mean())
    want = _jp(collections.Counter(a), collections.Counter(b))
    assert abs(np.mean(found) - want) < 0.015


def test_components(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(300)] + [(i, i + 1) for i in range(1000, 1060)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.root for r in got} == {x: find(x) for x in linked} and len(got) == len(linked)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _near_texts():
    rnd = random.Random(8)
    out = []
    for base in range(12):
        words = prose(base, 150).split()
        for copy in range(1 + base % 6):
            w = list(words)
            for _ in range(copy):
                w[rnd.randrange(len(w))] = rnd.choice(PROSE) + "x"
            out.append(" ".join(w))
    out += [out[0], out[3], out[3], "a b c", "a b c", "a b d", "hey " * 50, "hey " * 51, "", None]
    return out


def test_near_dedup_matches_brute_force(spark):
    texts = _near_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    bags = [_bag(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            if (texts[i] or "") == (texts[j] or "") or _jp(bags[i], bags[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    size = collections.Counter(find(i) for i in range(len(texts)))
    got = minhash.near_dedup(df).collect()
    assert {r.doc_id: (r.class_id, r.class_size, r.kept) for r in got} == {
        i: (find(i), size[find(i)], find(i) == i) for i in range(len(texts))}
    left = minhash.deduplicated(df).collect()
    assert sorted(r.doc_id for r in left) == sorted(size)


def test_near_dedup_compares_across_components_of_a_bucket(spark):
    """A chain in which the smallest node of a bucket is not similar to all of it."""
    words = prose(50, 200).split()
    texts = []
    for k in range(8):  # neighbours differ in few words, the ends in many
        texts.append(" ".join(w + ("z" if i < 5 * k else "") for i, w in enumerate(words)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert _jp(_bag(texts[0]), _bag(texts[7])) < 0.8 <= _jp(_bag(texts[3]), _bag(texts[4]))
    assert {r.class_id for r in minhash.near_dedup(df).collect()} == {0}


def test_near_dedup_edge_cases(spark):
    got = minhash.near_dedup(docs(spark)).collect()
    assert len(got) == len(rows())
    by = collections.defaultdict(set)
    for r in got:
        by[r.doc_id].add(r.class_id)
    assert by[1] == by[2] == by[3] == {1} and by[10] == {10} and by[8] == {8}
    classes = {r.class_id for r in got}
    assert sum(r.kept for r in got) == len(classes)
    left = minhash.deduplicated(docs(spark))
    assert left.columns == docs(spark).columns and left.count() == len(classes)
    assert minhash.near_dedup(empty(spark)).count() == 0 and minhash.deduplicated(empty(spark)).count() == 0


def _strip(texts, k):
    words = [WORDS.findall(t or "") for t in texts]
    seen = collections.Counter(tuple(w[i:i + k]) for w in words for i in range(len(w) - k + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - k + 1):
            if seen[tuple(w[i:i + k])] > 1:
                gone.update(range(i, i + k))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), kept, hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("window", [6, 35])
def test_substring_dedup_matches_brute_force(spark, window):
    rnd = random.Random(window)
    passage = prose(77, 70).split()
    texts = []
    for i in range(60):
        w = [rnd.choice(PROSE) for _ in range(rnd.randrange(0, 200))]
        for _ in range(rnd.randrange(3)):
            at, a = rnd.randrange(len(w) + 1), rnd.randrange(30)
            w[at:at] = passage[a:a + rnd.randrange(5, 60)]
        texts.append(("  " if i % 2 else "\n").join(w))
    texts += [texts[5], "la " * 120, prose(1, window), prose(1, window - 1), "", None, " \t "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = substring_dedup.substring_dedup(df, window=window, with_text=True, runs_per_bucket=40).collect()
    want = _strip(texts, window)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text, r.kept_sha256) for r in got} == dict(enumerate(want))


def test_substring_dedup_deals_windows_of_hot_minimisers_singly(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT", 40)
    passage = prose(5, 50)
    texts = [f"{prose(100 + i, 45)} {passage} {prose(500 + i, 45)}" for i in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = substring_dedup.substring_dedup(df, runs_per_bucket=100).collect()
    want = _strip(texts, 35)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == {
        i: (a, b, d) for i, (a, b, _, d) in enumerate(want)}


def test_windows_with_one_fingerprint_are_told_apart(monkeypatch):
    code = np.arange(12) % 6
    monkeypatch.setattr(substring_dedup, "_rolling", lambda h, k: np.zeros(len(h) - k + 1, np.uint64))
    at = np.arange(9)
    got = substring_dedup._repeated(code, at, np.ones(9, int), 4)
    seen = collections.Counter(tuple(code[i:i + 4]) for i in at)
    assert got.tolist() == [seen[tuple(code[i:i + 4])] > 1 for i in at]


def test_packed_texts_are_sliced_by_their_plain_size():
    import pyarrow as pa

    from rivulet.llm.common import text_slices

    batch = pa.record_batch({"_text": pa.array([b"x"] * 6), "_size": pa.array([900, 900, 3000, None, 10, 900], pa.int64())})
    assert [s.num_rows for s in text_slices(batch, "_size", 2000)] == [2, 1, 3]
    assert [s.num_rows for s in text_slices(batch, "_text", 2000)] == [6]


def test_substring_dedup_of_long_repeated_words(spark):
    long = [(i, "word " * 200_000 + f"end{i}") for i in range(6)]
    df = spark.createDataFrame(long + [(9, " ".join(f"w{k}" for k in range(100)))], "doc_id long, text string")
    got = {r.doc_id: r for r in substring_dedup.substring_dedup(df).collect()}
    assert [(got[i].n_words, got[i].n_removed) for i in range(6)] == [(200_001, 200_000)] * 6
    assert got[0].kept_sha256 == hashlib.sha256(b"end0").hexdigest() and (got[9].n_words, got[9].n_removed) == (100, 0)


def test_substring_dedup_edge_cases(spark):
    got = substring_dedup.substring_dedup(docs(spark)).collect()
    want = collections.Counter()
    for r, (n, gone, _, sha) in zip(rows(), _strip([r[1] for r in rows()], 35)):
        want[r[0], n, gone, sha] += 1
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want
    assert substring_dedup.substring_dedup(empty(spark)).count() == 0
