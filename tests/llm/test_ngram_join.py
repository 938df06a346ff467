"""The n-gram Jaccard join against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from cases import docs, empty, prose, rows
from rivulet.llm import ngram_join as J

SCHEMA = "doc_id long, text string"


def grams(text: str | None) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 3:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(words, words[1:], words[2:]))


def linked(a: frozenset, b: frozenset) -> bool:
    return bool(a and b) and 100 * len(a & b) >= 90 * len(a | b)


def brute(table: list[tuple]) -> list[tuple]:
    sets = [grams(t) for _, t in table]
    top = list(range(len(table)))
    for i in range(len(table)):
        for j in range(i):
            if linked(sets[i], sets[j]) and top[i] != top[j]:
                top = [top[j] if x == top[i] else x for x in top]
    out = []
    for k, (doc_id, _) in enumerate(table):
        ids = [d for d, x in zip((d for d, _ in table), top) if x == top[k] and d is not None]
        out.append((doc_id, len(sets[k]), doc_id if not sets[k] else min(ids, default=None)))
    return sorted(out, key=str)


def run(df) -> list[tuple]:
    return sorted((tuple(r) for r in J.smallest_ids(J.ngram_join(df)[0]).collect()), key=str)


def near_copies(seed: int, families: int, members: int) -> list[tuple]:
    r = random.Random(seed)
    out = []
    for _ in range(families):
        words = prose(r.randrange(10_000), r.choice([9, 11, 12, 20, 35, 80, 150])).split()
        for _ in range(members):
            w = list(words)
            for _ in range(r.randrange(0, max(2, len(w) // 25))):
                k = r.randrange(len(w))
                w[k:k + 1] = r.choice([[], ["new"], [w[k], "more"], [w[k].upper()]])
            out.append(" ".join(w))
    r.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_all_pairs(spark, monkeypatch, seed):
    monkeypatch.setattr(J, "HUB_ROUNDS", 2 - seed % 2)
    monkeypatch.setattr(J, "BLOCK", 4 if seed == 1 else 100)
    monkeypatch.setattr(J, "_COLUMNS", 50)
    table = near_copies(seed, 16, 12)
    assert run(spark.createDataFrame(table, SCHEMA).repartition(4)) == brute(table)


def test_shared_passages_do_not_link(spark):
    passage = prose(5, 60)
    table = [(i, prose(100 + i, 40) + " " + passage + " " + prose(300 + i, 40)) for i in range(60)]
    table += [(100 + i, passage + (" tail" if i % 2 else "")) for i in range(6)]
    assert run(spark.createDataFrame(table, SCHEMA)) == brute(table)


def test_awkward_rows(spark):
    assert run(docs(spark)) == brute([(r[0], r[1]) for r in rows()])


def test_empty_table_and_texts(spark):
    assert run(empty(spark)) == []
    assert run(spark.createDataFrame([(1, None), (2, ""), (None, " ")], SCHEMA)) == brute([(1, None), (2, ""), (None, " ")])


@pytest.mark.parametrize("n", [9, 10, 12, 13, 18, 19, 40, 300, 4000])
def test_every_similar_pair_meets_in_a_segment(n):
    """Pairs right at the threshold, with differences spread as evenly as they can be."""
    r = np.random.default_rng(n)
    for turn in range(30):
        base = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64))
        m = len(base)
        gone = int(r.integers(0, m // 10 + 1))
        new = 0
        while 100 * (m - gone) >= 90 * (m + new + 1) and r.random() < 0.95:
            new += 1
        if 100 * (m - gone) < 90 * (m + new):
            continue
        order = np.argsort(base % np.uint64(97), kind="stable")  # drop evenly
        other = np.sort(np.concatenate([np.delete(base[order], np.linspace(0, m - 1, gone).astype(int)) if gone else base,
                                        r.integers(0, 1 << 63, new).astype(np.uint64)]))
        owner = np.repeat([0, 1], (m, len(other)))
        if 100 * len(np.intersect1d(base, other)) < 90 * len(np.union1d(base, other)):
            continue
        who, sign = J.cuts(owner, np.concatenate([base, other]), 2, 90)
        if not np.array_equal(base, other):
            assert set(sign[who == 0].tolist()) & set(sign[who == 1].tolist())


def test_ascii_lower_keeps_other_letters():
    words = pa.array(["xx", "AbZ", "ÀÉ", "[`{@", ""], pa.large_string()).slice(1)
    assert J._ascii_lower(words).to_pylist() == ["abz", "ÀÉ", "[`{@", ""]
