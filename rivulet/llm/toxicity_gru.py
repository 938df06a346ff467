"""Operator 5, toxicity: bidirectional gated recurrent network with attention pooling.

Each word enters as a hashed word embedding next to the mean of its hashed character
n-gram embeddings, so misspelt or joined insults share input with the plain ones. Two GRUs
read a window of ``WINDOW`` words in both directions, attention pools their states, and a
logistic unit scores the window. Windows overlap (one starts every ``STRIDE`` words) and
all windows of the whole text are scored; a document takes its worst window, calibrated on
the training documents.

Everything is numpy. The model has a fixed size and travels with the task. Inputs are
computed once per distinct word of a slice, already multiplied into the gates, so a time
step costs one gather and one small matrix product per direction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import _bytes_of, flat_words, mix64, text_slices, whole_text, word_hashes
from rivulet.llm.quality_fm import crc_fold, labelled_sample, logistic

WINDOW = 48
STRIDE = 32
HIDDEN = 8
EMBED = 8
ATTEND = 8
WORD_BUCKETS = 1 << 13
GRAM_BUCKETS = 1 << 13
#: Labelled rows used per class at most: those with the smallest hash of their id.
SAMPLE_PER_CLASS = 1500
EPOCHS = 12
#: Small samples go on until the network has taken this many steps.
LEAST_STEPS = 1000
TOXIC_AT = 0.5
#: How many toxic documents a clean one counts for in the calibration: most texts are clean.
CLEAN_WEIGHT = 8.0
#: Windows that go through the network together.
BLOCK = 2048


def _grams(words: pa.Array, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(word number from ``base``, bucket) of every character 3- and 4-gram, by word. Words
    are framed by zero bytes, so that grams see where they start and end."""
    raw, offsets = _bytes_of(words)
    lens = np.diff(offsets)
    ends = np.cumsum(lens + 2)
    text = np.zeros(int(ends[-1]) + 3, np.uint64)
    owner = np.repeat(np.arange(len(words)), lens + 2)
    text[np.arange(len(raw)) + 2 * np.repeat(np.arange(len(words)), lens) + 1] = raw + np.uint64(1)
    body = np.arange(len(owner))
    left = ends[owner] - body  # bytes from here to the word's end
    packed = text[body] | text[body + 1] << np.uint64(9) | text[body + 2] << np.uint64(18)
    tri, quad = left >= 3, left >= 4
    grams = np.concatenate([packed[tri], packed[quad] | text[body[quad] + 3] << np.uint64(27) | np.uint64(1 << 40)])
    owners = np.concatenate([owner[tri], owner[quad]])
    order = np.argsort(owners, kind="stable")
    return (owners[order] + base).astype(np.int32), (mix64(grams[order]) % np.uint64(GRAM_BUCKETS)).astype(np.int32)


class Words:
    """Inputs of distinct words: word bucket, and character 3- and 4-gram buckets."""

    def __init__(self, words: pa.Array):
        words = pc.utf8_trim(pc.utf8_lower(words.cast(pa.large_string())), ".,;:!?\"'()[]")
        self.n = len(words)
        self.word = (word_hashes(words, 11) % np.uint64(WORD_BUCKETS)).astype(np.int32)
        parts = [_grams(words.slice(i, 1 << 15), i) for i in range(0, self.n, 1 << 15)] or [
            (np.zeros(0, np.int32),) * 2]
        self.gram_of, self.gram = (np.concatenate(x) for x in zip(*parts))
        self.gram_start = np.searchsorted(self.gram_of, np.arange(self.n + 1))
        self.gram_n = np.maximum(np.diff(self.gram_start), 1).astype(np.float32)

    def gram_mean(self, table: np.ndarray) -> np.ndarray:
        out = np.empty((self.n, table.shape[1]), np.float32)
        for k in range(table.shape[1]):
            out[:, k] = np.bincount(self.gram_of, table[self.gram, k], self.n)
        return out / self.gram_n[:, None]


def windows(doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, words) of every window; each document's windows cover it."""
    start = np.searchsorted(doc, np.arange(n_docs + 1))
    size = np.diff(start)
    count = np.where(size == 0, 0, 1 + np.maximum(0, -(-(size - WINDOW) // STRIDE)))
    owner = np.repeat(np.arange(n_docs), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    first = start[owner] + nth * STRIDE
    return owner, first, np.minimum(WINDOW, start[owner + 1] - first)


class Net:
    """The network's parameters by name, all float32."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        d, h = 2 * EMBED, HIDDEN
        p = {"word": r.normal(0, 0.3, (WORD_BUCKETS, EMBED)), "gram": r.normal(0, 0.3, (GRAM_BUCKETS, EMBED)),
             "att": r.normal(0, 0.3, (2 * h, ATTEND)), "att_b": np.zeros(ATTEND), "att_v": r.normal(0, 0.3, ATTEND),
             "out": r.normal(0, 0.3, 2 * h), "out_b": np.zeros(1)}
        for way in "fb":
            p[f"in_{way}"] = r.normal(0, d ** -0.5, (d, 3 * h))
            p[f"bias_{way}"] = np.zeros(3 * h)
            p[f"gate_{way}"] = r.normal(0, h ** -0.5, (h, 2 * h))
            p[f"cand_{way}"] = r.normal(0, h ** -0.5, (h, h))
        self.p = {k: v.astype(np.float32) for k, v in p.items()}
        self.scale, self.shift = 1.0, 0.0  # calibration of a document's worst window

    def inputs(self, words: Words) -> np.ndarray:
        return np.concatenate([self.p["word"][words.word], words.gram_mean(self.p["gram"])], 1)

    def gates(self, x: np.ndarray) -> dict[str, np.ndarray]:
        return {w: x @ self.p[f"in_{w}"] + self.p[f"bias_{w}"] for w in "fb"}

    def forward(self, pre: dict[str, np.ndarray], code: np.ndarray, live: np.ndarray, keep: bool = False):
        """Scores of windows whose words are ``code`` (steps x windows); steps that are not
        ``live`` leave the state as it is and get no attention."""
        p, steps, n, h = self.p, *code.shape, HIDDEN
        states = np.empty((steps, n, 2 * h), np.float32)
        tape = {"f": [None] * steps, "b": [None] * steps}
        for way, at, cols in (("f", range(steps), slice(0, h)), ("b", range(steps - 1, -1, -1), slice(h, 2 * h))):
            s = np.zeros((n, h), np.float32)
            gate, cand = p[f"gate_{way}"], p[f"cand_{way}"]
            for t in at:
                a = pre[way][code[t]]
                zr = 0.5 * np.tanh(0.5 * (a[:, :2 * h] + s @ gate)) + 0.5
                z = zr[:, :h] * live[t][:, None]
                rs = zr[:, h:] * s
                c = np.tanh(a[:, 2 * h:] + rs @ cand)
                if keep:
                    tape[way][t] = (s, zr, z, rs, c)
                s = s + z * (c - s)
                states[t, :, cols] = s
        hid = np.tanh(states @ p["att"] + p["att_b"])
        e = hid @ p["att_v"]
        e = np.where(live, e, -1e9)
        e = np.exp(e - e.max(0))
        alpha = e / e.sum(0)
        pooled = np.einsum("tn,tnk->nk", alpha, states)
        logit = pooled @ p["out"] + p["out_b"][0]
        return (logit, states, tape, hid, alpha, pooled) if keep else logit

    def backward(self, cache, code: np.ndarray, live: np.ndarray, g: np.ndarray):
        """Gradients of the parameters for loss gradients ``g`` of the logits; those of the
        gate inputs come per (step, window)."""
        _, states, tape, hid, alpha, pooled = cache
        p, steps, h = self.p, len(code), HIDDEN
        d = {"out": pooled.T @ g, "out_b": np.array([g.sum()])}
        d_pool = g[:, None] * p["out"]
        d_alpha = np.einsum("nk,tnk->tn", d_pool, states)
        d_e = alpha * (d_alpha - (alpha * d_alpha).sum(0))
        d["att_v"] = np.einsum("tn,tna->a", d_e, hid)
        d_hid = d_e[:, :, None] * p["att_v"] * (1 - hid * hid)
        d["att"] = np.einsum("tnk,tna->ka", states, d_hid)
        d["att_b"] = d_hid.sum((0, 1))
        d_states = alpha[:, :, None] * d_pool + d_hid @ p["att"].T
        d_pre = {}
        for way, at, cols in (("f", range(steps - 1, -1, -1), slice(0, h)), ("b", range(steps), slice(h, 2 * h))):
            gate, cand = p[f"gate_{way}"], p[f"cand_{way}"]
            d_gate, d_cand = np.zeros_like(gate), np.zeros_like(cand)
            out = np.empty((steps, len(g), 3 * h), np.float32)
            ds = np.zeros((len(g), h), np.float32)
            for t in at:
                s, zr, z, rs, c = tape[way][t]
                ds = ds + d_states[t, :, cols]
                dc = ds * z * (1 - c * c)
                dz = ds * (c - s) * live[t][:, None]
                drs = dc @ cand.T
                d_cand += rs.T @ dc
                dzr = np.concatenate([dz, drs * s], 1) * zr * (1 - zr)
                d_gate += s.T @ dzr
                ds = ds * (1 - z) + drs * zr[:, h:] + dzr @ gate.T
                out[t] = np.concatenate([dzr, dc], 1)
            d[f"gate_{way}"], d[f"cand_{way}"], d_pre[way] = d_gate, d_cand, out
        return d, d_pre

    def window_scores(self, pre, code: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Logits of windows into the word sequence ``code``, in blocks of similar length."""
        scores = np.empty(len(first), np.float32)
        order = np.argsort(size, kind="stable")
        for part in (order[i:i + BLOCK] for i in range(0, len(order), BLOCK)):
            steps = int(size[part].max())
            step = np.arange(steps)[:, None]
            live = step < size[part]
            at = np.where(live, first[part] + step, first[part])
            scores[part] = self.forward(pre, code[at], live)
        return scores

    def documents(self, texts: pa.Array) -> np.ndarray:
        """Calibrated probability per text; one without words scores as no toxicity at all."""
        doc, code, distinct = flat_words(texts)
        owner, first, size = windows(doc, len(texts))
        worst = np.full(len(texts), -np.inf)
        if len(owner):
            scores = self.window_scores(self.gates(self.inputs(Words(distinct))), code, first, size)
            np.maximum.at(worst, owner, scores)
        return logistic(np.where(np.isfinite(worst), worst * self.scale + self.shift, -20.0))


class _Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.rate, self.t = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, params, grads):
        self.t += 1
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            params[k] -= (self.rate * (self.m[k] / (1 - 0.9 ** self.t))
                          / (np.sqrt(self.v[k] / (1 - 0.999 ** self.t)) + 1e-7)).astype(np.float32)


def fit(texts: pa.Array, toxic: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, seed: int = 5) -> Net:
    """Train on documents with labels only for the whole text. A window inherits its
    document's label in the first epochs; after that a toxic document teaches with the
    window that the network finds worst, a clean one with its worst and a random one. One
    class alone, or no rows, gives a constant score (a half without rows)."""
    net, rng = Net(seed), np.random.default_rng(seed)
    if len(toxic) == 0 or toxic.min() == toxic.max():
        net.scale, net.shift = 0.0, 0.0 if len(toxic) == 0 else (4.0 if toxic[0] else -4.0)
        return net
    doc, code, distinct = flat_words(texts)
    words = Words(distinct)
    owner, first, size = windows(doc, len(texts))
    adam = _Adam(net.p, rate)
    begin = np.searchsorted(owner, np.arange(len(texts) + 1))
    has = np.flatnonzero(np.diff(begin) > 0)
    if len(has) == 0:
        net.scale = 0.0
        return net

    def worst(scores):
        order = np.lexsort((scores, owner))
        return order[begin[has + 1] - 1]

    epochs = max(epochs, -(-LEAST_STEPS * 128 // (2 * len(has))))
    every, top = max(1, epochs // 7), None  # how often the worst windows are sought anew
    for epoch in range(epochs):
        rand = begin[has] + (rng.random(len(has)) * np.diff(begin)[has]).astype(np.int64)
        if epoch < epochs // 4:
            more = begin[has] + (rng.random(len(has)) * np.diff(begin)[has]).astype(np.int64)
            chosen = np.unique(np.concatenate([rand, more]))
        else:
            if top is None or epoch % every == 0:
                top = worst(net.window_scores(net.gates(net.inputs(words)), code, first, size))
            chosen = np.unique(np.concatenate([top, rand[toxic[has] == 0]]))
        label = toxic[owner[chosen]].astype(np.float32)
        weight = np.where(label == 1, 0.5 / max(label.mean(), 1e-6), 0.5 / max(1 - label.mean(), 1e-6))
        for part in np.array_split(rng.permutation(len(chosen)), max(1, len(chosen) // 128)):
            _learn(net, adam, words, code, first[chosen[part]], size[chosen[part]],
                   label[part], weight[part].astype(np.float32), rng)
    scores = net.window_scores(net.gates(net.inputs(words)), code, first, size)
    _calibrate(net, scores[worst(scores)].astype(np.float64), toxic[has])
    return net


def _learn(net: Net, adam: _Adam, words: Words, code, first, size, label, weight, rng) -> None:
    steps = np.arange(int(size.max()))[:, None]
    live = steps < size
    at = code[np.where(live, first + steps, first)]
    used, local = np.unique(at, return_inverse=True)
    local = local.reshape(at.shape)
    # inputs of the words in this batch; now and then a word must do with its characters
    seen = rng.random(len(used)) >= 0.25
    w = net.p["word"][words.word[used]] * seen[:, None]
    lens = np.diff(words.gram_start)[used]
    owner = np.repeat(np.arange(len(used)), lens)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(lens) - lens, lens)
    gram = words.gram[words.gram_start[used][owner] + offset]
    share = (1 / words.gram_n[used])[owner]
    table = net.p["gram"]
    c = np.stack([np.bincount(owner, table[gram, k] * share, len(used)) for k in range(EMBED)], 1)
    x = np.concatenate([w, c], 1).astype(np.float32)
    cache = net.forward(net.gates(x), local, live, keep=True)
    g = ((logistic(cache[0]) - label) * weight / len(label)).astype(np.float32)
    grads, d_pre = net.backward(cache, local, live, g)
    dx = np.zeros_like(x)
    for way, d in d_pre.items():
        flat = (d * live[:, :, None]).reshape(-1, 3 * HIDDEN)
        per = np.stack([np.bincount(local.ravel(), flat[:, k], len(used)) for k in range(3 * HIDDEN)], 1).astype(np.float32)
        grads[f"in_{way}"], grads[f"bias_{way}"] = x.T @ per, per.sum(0)
        dx += per @ net.p[f"in_{way}"].T
    dw = dx[:, :EMBED] * seen[:, None]
    grads["word"] = np.stack([np.bincount(words.word[used], dw[:, k], WORD_BUCKETS) for k in range(EMBED)], 1)
    dc = dx[:, EMBED:][owner] * share[:, None]
    grads["gram"] = np.stack([np.bincount(gram, dc[:, k], GRAM_BUCKETS) for k in range(EMBED)], 1)
    size_all = np.sqrt(sum(float((v * v).sum()) for v in grads.values()))
    if size_all > 5:
        grads = {k: v * (5 / size_all) for k, v in grads.items()}
    adam.step(net.p, grads)


def _calibrate(net: Net, score: np.ndarray, toxic: np.ndarray) -> None:
    """Logistic regression of the label on a document's worst window (Newton steps, a small
    ridge so that separable samples stay finite)."""
    mid, spread = score.mean(), score.std() + 1e-9
    x = np.stack([(score - mid) / spread, np.ones_like(score)], 1)
    beta = np.zeros(2)
    share = np.where(toxic == 1, 1 / toxic.mean(), CLEAN_WEIGHT / (1 - toxic.mean())) / (1 + CLEAN_WEIGHT)
    for _ in range(50):
        p = logistic(x @ beta)
        grad = x.T @ (share * (p - toxic)) / len(x) + 1e-3 * beta
        hess = (x * (share * p * (1 - p) / len(x))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    net.scale = float(beta[0] / spread)
    net.shift = float(beta[1] - beta[0] * mid / spread)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """One row per document: ``id_col, held_out, score, predicted``.

    Learns ``labels.toxic`` from at most ``per_class`` labelled rows per class whose
    crc32(id) mod 5 is not 0; those texts are the only ones the driver receives. Texts
    without words score near 0; a null id is not held out; repeated rows each get a row;
    other columns are ignored; without labels every text with words scores a half; an
    empty table gives an empty result."""
    sample = labelled_sample(docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text")),
                             labels, "toxic", 5, 0, per_class, id_col)
    rows = sorted((r["_label"], r["_text"]) for r in sample.select("_label", "_text").collect())
    net = fit(pa.array([t for _, t in rows], pa.large_string()), np.array([y for y, _ in rows], np.int64))
    del rows

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "_text", 2 << 20):
                yield pa.record_batch({"_id": part.column("_id"),
                                       "_score": pa.array(net.documents(part.column("_text")), pa.float64())})

    slim = docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text"))
    out = slim.mapInArrow(judge, slim.select("_id", F.lit(0.0).alias("_score")).schema)
    return out.select(F.col("_id").alias(id_col),
                      F.coalesce(crc_fold(F.col("_id"), 5) == 0, F.lit(False)).alias("held_out"),
                      F.col("_score").alias("score"),
                      (F.col("_score") >= TOXIC_AT).cast("int").alias("predicted"))
