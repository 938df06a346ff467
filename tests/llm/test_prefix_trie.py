"""The prefix trie against a brute-force trie."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from cases import CLASHES
from rivulet.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string"
COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows: list[tuple]) -> dict[int, list[tuple[str, str]]]:
    turns: dict[int, list] = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            dig = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns.setdefault(c, []).append((t is not None, t or 0, dig, role, text))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in turns.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + v[h:]
    return out


def brute(convs: dict[int, list]) -> list[tuple]:
    members: dict[tuple, list[int]] = {}
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    kids = {k: sum(len(x) == len(k) + 1 and x[:len(k)] == k for x in members) for k in members}
    out = []
    for k, m in members.items():
        below = [x for x in members if x[:len(k)] == k]
        saved = sum((len(members[x]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) for x in below if x)
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(k))))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k],
                    sum(kids[x] == 0 for x in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie(df) -> list[tuple]:
    out = P.digested(*P.prefix_trie(P.grafted(P.sequences(df)))).select(*COLS)
    return sorted((tuple(r) for r in out.collect()), key=str)


def random_rows(seed: int, n: int, most: int) -> list[tuple]:
    r = random.Random(seed)
    says = ["", None, "hi", "tell me more", "a b\tc", "x  y", "\x00 odd é"]
    return [(c, t if r.random() < 0.95 else None, r.choice(["user", "assistant", None, ""]) if r.random() < 0.2 else "user",
             r.choice(says[:2 + seed % 6])) for c in range(n) for t in range(r.randint(1, most))]


@pytest.mark.parametrize("seed,n,most", [(1, 60, 5), (5, 90, 4), (4, 25, 30)])
def test_equal_to_brute_force(spark, seed, n, most):
    rows = random_rows(seed, n, most)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert trie(df) == brute(rebuilt(rows))


def test_small_batches_and_many_blocks(spark, conf, monkeypatch):
    """Nodes that reach over batches, partitions and rounds of merging."""
    monkeypatch.setattr(P, "FAN", 3)
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "13")
    rows = random_rows(3, 160, 6)
    df = spark.createDataFrame(rows, SCHEMA)
    assert trie(df) == brute(rebuilt(rows))


def test_many_equal_conversations(spark, monkeypatch):
    monkeypatch.setattr(P, "PIECE", 40)
    rows = [(20 * c, t, "user", f"turn {t}") for c in range(300) for t in range(3)] + [(7, 0, "user", "alone")]
    assert trie(spark.createDataFrame(rows, SCHEMA)) == brute(rebuilt(rows))


def test_awkward_rows(spark):
    long = "word " * 60_000
    rows = [(None, 0, "user", "x"), (0, None, None, None), (0, 0, "user", long), (0, 0, "user", long), (1, 5, "user", ""),
            (1, 5, "user", "tie"), (1, 5, "a", "tie"), (3, 0, "user", "x"), (-21, 0, "user", "minus"), (40, 1, "u", "a")]
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.selectExpr("*", *[f"{i} as `{c}`" for i, c in enumerate([*CLASHES, "path", "seq", "base", "depth"])])
    assert trie(df.repartition(4)) == brute(rebuilt(rows))


def test_empty_table(spark):
    assert trie(spark.createDataFrame([], SCHEMA)) == []
