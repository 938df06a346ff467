"""Cross-tokenizer alignment against a plain version with the tokenizers library."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import docs, empty, prose, rows
from rivulet.llm import token_align as T
from rivulet.llm.common import stored

NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plain_tokens(text: str, a, b, letters) -> tuple[list, list]:
    """(id, bytes) of A's and B's tokens."""
    x = a.encode(f" {text}", add_special_tokens=False)
    left = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in x.ids]
    right = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
             for i in b.encode(text) for p in [b.id_to_piece(i)]]
    whole = f" {text}".encode()
    if not text or any(b"".join(t for _, t in side) != whole for side in (left, right)):
        return [], []
    return left, right


def brute(table: list[tuple]) -> list[tuple]:
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path = T.default_tokenizers()
    a, b, letters = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path), T._byte_letters()
    a.encode_special_tokens = True
    found = []
    for doc_id, text in table:
        sides = []
        for tokens in plain_tokens(text or "", a, b, letters):
            at, spans = 0, []
            for i, raw in tokens:
                spans.append((at, at + len(raw), i))
                at += len(raw)
            sides.append(spans)
        left, right = sides
        cuts = sorted({e for _, e, _ in left} & {e for _, e, _ in right})
        groups, at = [], [0, 0]
        for hi in cuts:
            group = []
            for k, side in enumerate((left, right)):
                first = at[k]
                while at[k] < len(side) and side[at[k]][1] <= hi:
                    at[k] += 1
                group.append([i for _, _, i in side[first:at[k]]])
            groups.append(tuple(group))
        by_end = defaultdict(list)
        for _, e, j in right:
            by_end[e].append(j)
        links = [(i, j) for _, e, i in left for j in by_end[e]]
        found.append((doc_id, left, right, groups, links))
    count = Counter(x for *_, links in found for x in links)
    best = defaultdict(int)
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    out = []
    for doc_id, left, right, groups, links in found:
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((doc_id, len(left), len(right), len(groups), len(links), sum(count[x] == best[x[1]] for x in links),
                    sum(count[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if left else ""))
    return sorted(out, key=str)


def run(df) -> list[tuple]:
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    aligned = stored(T.align(df).withColumn("groups_sha256", digest).drop("groups"), "test-aligned")
    return sorted((tuple(r) for r in T.scored(aligned, T.piece_count()).select(*NAMES).collect()), key=str)


ODD = ["<|endoftext|> plain <s> text </s>", "<0x41> is A", "▁ a mark", "  two  spaces ", "tab\tand\nline\r\n", "\x00\x01",
       "á ﬁ Ａ ​", "日本語 텍스트 \U0001f600\U0001f468‍\U0001f469", "x" * 3000, " " * 3000, "­", "don't I'll"]


def test_equal_to_brute_force(spark, monkeypatch):
    monkeypatch.setattr(T, "SLICE", 2000)
    monkeypatch.setattr(T, "FOLD", 300)
    table = [(i, x) for i, x in enumerate(ODD)] + [(100 + i, prose(i % 7, 40)) for i in range(20)] + [(5, None), (None, "")]
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    assert run(df) == brute(table)


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert run(df) == brute([tuple(r) for r in df.collect()])


def test_awkward_rows(spark):
    assert run(docs(spark)) == brute([(r[0], r[1]) for r in rows()])


def test_empty_table(spark):
    assert run(empty(spark)) == []


@pytest.mark.parametrize("seed", range(4))
def test_groups_and_overlaps(seed):
    r = np.random.default_rng(seed)
    total = 60
    a, b = (np.append(np.sort(r.choice(np.arange(1, total), 20, replace=False)), total) for _ in range(2))
    ga, gb = T.coalesce(a, b)
    cuts = sorted(set(a.tolist()) & set(b.tolist()))
    assert ga.tolist() == [sum(c < e for c in cuts) for e in a.tolist()]
    assert gb.tolist() == [sum(c < e for c in cuts) for e in b.tolist()]
    sa, sb = np.append(0, a[:-1]), np.append(0, b[:-1])
    want = [(i, j) for i in range(len(a)) for j in range(len(b)) if sa[i] < b[j] and sb[j] < a[i]]
    assert list(zip(*(x.tolist() for x in T.overlaps(a, b)))) == want


def test_other_vocabulary_goes_through_the_library(tmp_path, monkeypatch):
    """A file whose ids do not rise with its merges is not read as ranks."""
    import json

    path = T.default_tokenizers()[0]
    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    whole["model"]["merges"][:2] = whole["model"]["merges"][1::-1]
    other = tmp_path / "t.json"
    other.write_text(json.dumps(whole), encoding="utf-8")
    assert T.ByteBpe(str(other)).fast is None and T.ByteBpe(path).fast is not None
    text = [" the quick brown fox, don't", "  12 <|endoftext|>"]
    assert [x.tolist() for x in T.ByteBpe(path)(text)] == [
        T.ByteBpe(path).plain.encode(t, add_special_tokens=False).ids for t in text]
