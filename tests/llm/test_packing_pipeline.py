"""Packing, and the pipeline as a whole."""

from __future__ import annotations

import collections
import struct
import zlib

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cases import docs, empty, prose, rows
from rivulet.llm import packing


def _ids(text):
    from tokenizers import Tokenizer

    global _TOK
    if "_TOK" not in globals():
        _TOK = Tokenizer.from_file(packing.default_tokenizer())
    return _TOK.encode(text or "", add_special_tokens=False).ids + [1]


def _check(got, texts, sequence=2048):
    """Every id in exactly one piece; sequences without gaps; all full but the last."""
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert set(by) == set(texts)
    for i, pieces in by.items():
        ids, at = _ids(texts[i]), 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[at:at + r.length]))
            at += r.length
        assert at == len(ids)
    windows = collections.defaultdict(list)
    for r in got:
        windows[r.sequence_id].append((r.offset, r.length))
    for k, parts in windows.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == sequence or k == max(windows)
    assert sorted(windows) == list(range(len(windows)))


def _mixture(spark, n=300):
    data = [(i, prose(i, 5 + (i * 31) % 400), f"src{min(i % 7, 3)}") for i in range(n)]
    return {i: t for i, t, _ in data}, spark.createDataFrame(data, "doc_id long, text string, source string").repartition(5)


def test_packs_every_id_once(spark):
    texts, df = _mixture(spark)
    _check(packing.pack(df).collect(), texts)
    _check(packing.pack(df, sequence=256, packet=100).collect(), texts, 256)


@pytest.mark.parametrize("weights", [None, {"src0": 5.0, "src1": 1.0, "src2": 1.0, "src3": 1.0}])
def test_deficits_stay_under_a_packet(spark, weights):
    texts, df = _mixture(spark)
    got = packing.pack(df, weights, sequence=512, packet=64).collect()
    _check(got, texts, 512)
    total = collections.Counter()
    for r in got:
        total[r.source] += r.length
    share = {s: (weights or total)[s] / sum((weights or total).values()) for s in total}
    served = collections.defaultdict(collections.Counter)
    for r in got:
        served[r.round][r.source] += r.length
    so_far, dry = collections.Counter(), set()
    for k in sorted(served):
        so_far += served[k]
        for s in total:
            credit = (k + 1) * share[s] * 512
            if so_far[s] < total[s]:  # while the queue lasts, at most a packet is owed
                assert -1e-6 <= credit - so_far[s] < 64 + 1e-6
    assert so_far == total


def test_packing_is_a_round_robin_replayed(spark):
    """The closed form serves packets in the rounds of a simulated deficit round-robin."""
    texts, df = _mixture(spark, 60)
    tokens = packing.tokenized(df, "doc_id", "text", "source", packing.default_tokenizer())
    weights = {"src0": 2.0, "src1": 1.0, "src2": 3.0, "src3": 1.5}
    pkts = packing.packets(tokens, weights, 50, 200).collect()
    queues = collections.defaultdict(list)
    for p in sorted(pkts, key=lambda p: p.end):
        queues[p.source].append(p)
    for source, queue in queues.items():
        credit, k = 0.0, 0
        rounds = {}
        while k < len(queue):
            credit += weights[source] / 7.5 * 200
            turn = rounds.setdefault("turn", -1) + 1
            rounds["turn"] = turn
            while k < len(queue) and queue[k].length <= credit + 1e-9:
                assert queue[k].round == turn
                credit -= queue[k].length
                k += 1


def test_packing_edge_cases(spark):
    got = packing.pack(docs(spark)).collect()
    pieces = collections.Counter()
    for r in got:
        pieces[r.doc_id] += r.length
    want = collections.Counter()
    for r in rows():
        want[r[0]] += len(_ids(r[1]))
    assert pieces == want
    assert packing.pack(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs(spark), {"src0": 0.0})


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/documents.parquet")
    current = table
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "near_dedup", "mixing", "packing"]
    from rivulet.llm.common import stored
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, current, sf), f"test-{name}")
        if name != "packing":
            assert out.columns == table.columns
            kept[name] = [r.doc_id for r in out.collect()]
            current = out
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1]
    passed = set(kept["quality_classifier"])
    assert sum(i in passed for i in good) > 0.9 * len(good)
    assert sum(i in passed for i, q in labels.items() if q == 0) < 0.2 * max(1, sum(q == 0 for q in labels.values()))
    texts = {r.doc_id: r.text for r in table.collect()}
    assert len({" ".join(texts[i].split()) for i in kept["exact_dedup"]}) == len(kept["exact_dedup"])
    assert set(kept["near_dedup"]) <= set(kept["exact_dedup"])
    copies = collections.Counter(kept["mixing"])
    assert set(copies) <= set(kept["near_dedup"])
    packed = collections.Counter()
    for r in out.collect():
        packed[r.doc_id] += r.length
    assert packed == collections.Counter({i: n * len(_ids(texts[i])) for i, n in copies.items()})


def test_pipeline_decides_by_the_machine_of_the_query(spark, monkeypatch):
    from rivulet.llm import quality_fm
    sf, train, models = "/root/testdata/sf0.001", quality_fm.train, []
    monkeypatch.setattr(quality_fm, "train", lambda *a: models.append(train(*a)) or models[-1])
    table = spark.read.parquet(f"{sf}/documents.parquet")
    left = {r.doc_id for r in corpus_pipeline.quality(spark, table, sf).collect()}
    judged = entry.queries()["op4_quality_classifier"](spark, sf).collect()
    assert left == {r.doc_id for r in judged if r.predicted} and 0 < len(left) < len(judged)
    assert len(models[0].weight) == len(models[1].weight) and (models[0].weight == models[1].weight).all()


def test_quality_stage_without_labels_keeps_all(spark):
    from rivulet.llm import quality_fm
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    none = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").where("false")
    assert quality_fm.kept(table, none, meta=quality_fm.META).count() == table.count() > 0


def test_pipeline_on_an_empty_table(spark):
    from rivulet.llm.common import stored
    current = empty(spark)
    for name, stage in corpus_pipeline.STAGES:
        current = stored(stage(spark, current, "/root/testdata/sf0.001"), f"test-{name}")
        assert current.count() == 0


def test_queries_are_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
