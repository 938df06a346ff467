"""Quality classifier (factorisation machine) and toxicity (bidirectional GRU)."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from cases import docs, empty, prose, rows
from rivulet.llm import quality_fm, toxicity_gru

LABELS = "doc_id long, quality int, toxic int"


def test_pair_sum_equals_the_double_loop():
    rng = np.random.default_rng(0)
    m = quality_fm.Machine(0.3, rng.normal(size=30).astype(np.float32), rng.normal(size=(30, 4)).astype(np.float32))
    index = np.array([1, 4, 9, 4, 20, 29, 2])
    value = rng.normal(size=7).astype(np.float32)
    starts = np.array([0, 3, 7])
    got = m.raw(starts, index, value)
    for k, (a, b) in enumerate(zip(starts, starts[1:])):
        i, x = index[a:b], value[a:b]
        want = 0.3 + sum(m.weight[i] * x)
        want += sum(float(m.factor[i[p]] @ m.factor[i[q]]) * x[p] * x[q] for p in range(len(i)) for q in range(p))
        assert got[k] == pytest.approx(want, abs=1e-4)


def test_factors_learn_what_no_linear_model_can():
    rnd = random.Random(1)
    data = []
    for _ in range(600):  # label is whether exactly one of two features is on
        a, b = rnd.random() < 0.5, rnd.random() < 0.5
        index = [2] + [0] * a + [1] * b
        data.append((int(a != b), np.array(index, np.int32), np.ones(len(index), np.float32)))
    m = quality_fm.fit(data, 3, epochs=60)
    score = [m.raw(np.array([0, len(i)]), i, v)[0] > 0 for _, i, v in data]
    assert np.mean([s == bool(y) for s, (y, _, _) in zip(score, data)]) > 0.98


def _quality_docs(spark):
    junk = [prose(i, 60).replace(" ", " ## | ") if i % 2 else "buy now!! " * 40 for i in range(60)]
    clean = [prose(1000 + i, 40 + i) + "." for i in range(140)]
    texts = junk + clean
    df = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in enumerate(texts)],
                               "doc_id long, text string, lang string, source string, n_chars long")
    return df, spark.createDataFrame([(i, int(i >= 60), 0) for i in range(200)], LABELS)


def test_quality_held_out_accuracy_and_stage(spark):
    df, labels = _quality_docs(spark)
    got = quality_fm.classify(df, labels, meta=("n_chars",)).collect()
    assert len(got) == 200
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == int(r.doc_id >= 60) for r in held]) > 0.95
    left = quality_fm.kept(df, labels)
    assert left.columns == df.columns and 130 <= left.count() <= 145
    assert quality_fm.classify(df, labels, meta=("n_chars",)).collect() == got  # same sample, same model


def test_quality_never_learns_from_the_held_out_fold(spark):
    df, labels = _quality_docs(spark)
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 4 = 2 then 1 - quality else quality end as quality", "toxic")
    assert quality_fm.classify(df, labels).collect() == quality_fm.classify(df, flipped).collect()


def test_quality_edge_cases(spark):
    df, labels = _quality_docs(spark)
    got = quality_fm.classify(docs(spark), labels, meta=("n_chars",)).collect()
    assert len(got) == len(rows()) and all(0 <= r.score <= 1 for r in got)
    assert not any(r.held_out for r in got if r.doc_id is None)
    assert quality_fm.kept(docs(spark), labels).columns == docs(spark).columns
    wide = labels.selectExpr("*", "1 as _id", "2 as _label", "3 as _label_id", "4 as _text")
    assert quality_fm.classify(docs(spark), wide, meta=("n_chars",)).collect() == got
    none = labels.where("false")
    assert {r.score for r in quality_fm.classify(df, none).collect()} == {0.5}
    assert quality_fm.classify(empty(spark), labels).count() == 0


def _net(seed=1):
    net = toxicity_gru.Net(seed)
    for k in ("word", "gram", "att", "att_v", "out", "in_f", "in_b", "gate_f", "gate_b", "cand_f", "cand_b"):
        net.p[k] = net.p[k].astype(np.float64)
    return net


def test_gru_gradients():
    rng = np.random.default_rng(2)
    net = _net()
    x = rng.normal(size=(9, 2 * toxicity_gru.EMBED))
    code = rng.integers(0, 9, (6, 5))
    live = np.arange(6)[:, None] < np.array([6, 3, 1, 5, 6])
    y = np.array([1, 0, 1, 0, 1.0])

    def loss():
        z = net.forward(net.gates(x), code, live).astype(np.float64)
        return float((np.log1p(np.exp(z)) - y * z).sum())

    cache = net.forward(net.gates(x), code, live, keep=True)
    grads, _ = net.backward(cache, code, live, 1 / (1 + np.exp(-cache[0])) - y)
    for name in ("gate_f", "cand_b", "att", "att_v", "out"):
        flat = net.p[name].reshape(-1)
        for k in (0, len(flat) // 2, len(flat) - 1):
            was = flat[k]
            flat[k] = was + 1e-2
            up = loss()
            flat[k] = was - 1e-2
            down = loss()
            flat[k] = was
            assert np.asarray(grads[name]).reshape(-1)[k] == pytest.approx((up - down) / 2e-2, rel=0.05, abs=2e-3), name


def test_windows_cover_every_word_and_overlap():
    size = [0, 1, 47, 48, 49, 80, 81, 200]
    doc = np.repeat(np.arange(len(size)), size)
    owner, first, n = toxicity_gru.windows(doc, len(size))
    start = np.cumsum([0] + size)
    for d, s in enumerate(size):
        mine = [(f - start[d], f - start[d] + k) for o, f, k in zip(owner, first, n) if o == d]
        assert {w for a, b in mine for w in range(a, b)} == set(range(s))
        assert all(b2 <= s and a2 < b1 for (_, b1), (a2, b2) in zip(mine, mine[1:]))


def _toxic_docs(spark):
    rnd = random.Random(5)
    data = []
    for i in range(400):
        words = prose(i, 30 + (i * 37) % 300).split()
        bad = i % 3 == 0
        for _ in range(2 + len(words) // 60 if bad else 0):
            word = rnd.choice(["moronic", "scumbag", "idiot", "trash"]) + rnd.choice(["", "s", "ly", "!"])
            words.insert(rnd.randrange(len(words)), word)
        data.append((i, " ".join(words), int(bad)))
    df = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    return df, spark.createDataFrame([(i, 1, y) for i, _, y in data], LABELS)


def test_toxicity_held_out_accuracy_and_edges(spark, monkeypatch):
    monkeypatch.setattr(toxicity_gru, "LEAST_STEPS", 300)
    df, labels = _toxic_docs(spark)
    more = docs(spark).selectExpr("doc_id + 1000 as doc_id", "text", "_id", "_text", "score", "label")
    both = df.unionByName(more, allowMissingColumns=True)
    got = toxicity_gru.toxicity(both, labels).collect()
    assert len(got) == 400 + len(rows())
    known = [r for r in got if r.doc_id is not None and r.doc_id < 1000]
    for r in known:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.5)
    held = [r for r in known if r.held_out]
    assert np.mean([r.predicted == int(r.doc_id % 3 == 0) for r in held]) > 0.93
    quiet = {r.doc_id: r.score for r in got if r.doc_id in (1004, 1005, 1006)}  # null, empty, white space
    assert len(quiet) == 3 and max(quiet.values()) < 0.01
    assert not any(r.held_out for r in got if r.doc_id is None)


def test_toxicity_without_labels_or_rows(spark):
    labels = _toxic_docs(spark)[1].selectExpr("*", "1 as _id", "2 as _label", "3 as _label_id", "4 as _text")
    got = toxicity_gru.toxicity(docs(spark), labels.where("false")).collect()
    assert {round(r.score, 6) for r in got if (r.doc_id or 0) in (1, 2, 7, 8)} == {0.5}
    assert toxicity_gru.toxicity(empty(spark), labels).count() == 0


def test_toxicity_score_does_not_depend_on_neighbours():
    net = toxicity_gru.Net(3)
    texts = [prose(i, n) for i, n in enumerate((5, 48, 49, 300, 0, 1))]
    alone = [float(net.documents(pa.array([t]))[0]) for t in texts]
    together = net.documents(pa.array(texts + [None]))
    assert np.allclose(together[:-1], alone, atol=1e-5)
