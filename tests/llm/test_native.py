"""Exact dedup, quality rules and mixing."""

from __future__ import annotations

import collections
import hashlib
import re

import duckdb
import pytest

import __spark_entry__ as entry
from cases import docs, empty, rows
from rivulet.llm import exact_dedup, mixing, quality_rules
from tools.compare import rows as as_rows

SF0001 = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", ["op8_exact_dedup", "op10_mixing"])
def test_matches_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF0001}/documents.parquet')")
    got = entry.queries()[name](spark, SF0001).toPandas()
    assert as_rows(got) == as_rows(con.execute(entry.oracle_sql()[name]).df())


def _digest(t):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()


def test_exact_dedup_edge_cases(spark):
    got = exact_dedup.exact_dedup(docs(spark)).collect()
    groups = collections.defaultdict(list)
    for r in rows():
        groups[_digest(r[1])].append(r[0])
    assert len(got) == len(rows())
    kept = collections.Counter()
    for r in got:
        ids = groups[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert r.group_size == len(ids) and r.keep_id == (min(known) if known else None)
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    left = exact_dedup.deduplicated(docs(spark))
    assert left.columns == docs(spark).columns
    assert sorted(_digest(r.text) for r in left.collect()) == sorted(groups)


def test_exact_dedup_hot_digest_never_shuffles_its_rows(spark):
    many = spark.range(3000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'same  text' else concat('t', id) end as text")
    got = exact_dedup.exact_dedup(many)
    hot = got.where("group_size > 1").collect()
    assert len(hot) == 1000 and {r.keep_id for r in hot} == {0} and sum(r.kept for r in hot) == 1
    assert got.count() == 3000
    found = exact_dedup.heavy_winners(many.select(many.doc_id.alias("_id"), exact_dedup.digest().alias("_digest"),
                                                  many.doc_id.alias("_uid")), 0.01)
    assert found.count() <= 100 and found.where("_n = 1000 and _keep = 0").count() == 1


def test_exact_dedup_empty(spark):
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0
    assert exact_dedup.deduplicated(empty(spark)).columns == empty(spark).columns


def _counts(t):
    w = WORDS.findall(t or "")
    lines = [x for x in (t or "").split("\n") if WORDS.search(x)]
    seen = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = set()
    for i in range(len(w) - 4):
        if seen[tuple(w[i:i + 5])] > 1:
            covered.update(range(i, i + 5))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_rules_counts_and_base(spark):
    texts = [r[1] for r in rows()] + ["a b c d e f " * 4, "x\nx\n \nx y\nx y\n", "! # | a b c d e f g h i j k l m"] + [
        "la " * 30, " ".join(map(str, range(40))) + " 1 2 3 4 5 6"]
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, kept long")
    for r in quality_rules.quality_rules(df).collect():
        n, chars, symbols, dup, rep = _counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, rep)
        assert r.base_failed == (n < 10 or 100 * rep > 20 * n)
        assert not (r.base_failed and r.kept)
    assert quality_rules.quality_rules(empty(spark)).count() == 0


def test_quality_rules_variety_does_not_depend_on_length(spark):
    import random
    rnd = random.Random(4)
    few, many = [f"word{i}" for i in range(50)], [f"term{i}" for i in range(4000)]
    sizes = (400, 2000, 2001, 9000)
    texts = [" ".join(rnd.choice(w) for _ in range(n)) for w in (few, many) for n in sizes]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(quality_rules.quality_rules(df).collect(), key=lambda r: r.doc_id)
    assert [(r.vote_variety, r.vote_plain, r.kept) for r in got] == [(-1, 0, False)] * 4 + [(0, 1, True)] * 4
    found = {r._id: r.n_stretch_distinct for r in quality_rules.features(df).collect()}
    for i, t in enumerate(texts):
        w = t.split()
        assert found[i] == sum(len(set(w[k:k + 500])) for k in range(0, len(w), 500))


def test_quality_rules_em_finds_the_accurate_rules():
    import random
    rnd, k = random.Random(3), len(quality_rules.RULES)
    accuracy = [0.95, 0.9, 0.9, 0.6, 0.85, 0.95, 0.8]
    seen = collections.Counter()
    for _ in range(20000):
        label = rnd.choice((1, -1))
        seen[tuple(0 if rnd.random() < 0.4 else label * (1 if rnd.random() < a else -1) for a in accuracy)] += 1
    found = quality_rules.fit(sorted(seen.items()))
    assert len(found) == k and max(abs(a - b) for a, b in zip(found, accuracy)) < 0.03
    assert quality_rules.fit([]) == [quality_rules.START] * k


def test_quality_rules_against_labels(spark):
    sf = SF0001.replace("0.001", "0.01")
    got = quality_rules.quality_rules(spark.read.parquet(f"{sf}/documents.parquet"))
    lab = spark.read.parquet(f"{sf}/labels.parquet")
    pdf = got.join(lab, "doc_id").toPandas()
    assert pdf[(pdf.quality == 1) & ~pdf.base_failed].kept.mean() > 0.98
    assert pdf[pdf.quality == 0].kept.mean() < 0.05


def _fill(budget, caps, weights):
    """Water filling by repeated passes."""
    give, open_ = {k: 0.0 for k in caps}, {k for k in caps if weights[k] > 0}
    budget = min(budget, sum(caps[k] for k in open_))
    while open_ and budget > 1e-9:
        total = sum(weights[k] for k in open_)
        full = {k for k in open_ if caps[k] - give[k] <= budget * weights[k] / total + 1e-12}
        if not full:
            for k in open_:
                give[k] += budget * weights[k] / total
            break
        spent = 0.0
        for k in full:
            spent += caps[k] - give[k]
            give[k] = caps[k]
        budget -= spent
        open_ -= full
    return give


def test_allocate_redistributes_among_siblings_first(spark):
    leaves = [("a", "en", 100), ("a", "de", 10), ("b", "en", 50), ("b", None, 5), ("c", "en", 1000), ("z", "en", 30)]
    weights = {"d": {"a": 4.0, "b": 3.0, "c": 2.0, "z": 0.0}, "l": {"en": 1.0, "de": 5.0}}
    df = spark.createDataFrame(leaves, "d string, l string, supply long")
    for budget in (50, 300, 700, 5000, None):
        got = {(r.d, r.l): r.quota for r in mixing.allocate(df, ["d", "l"], weights, budget, 2).collect()}
        caps = collections.defaultdict(float)
        for d, _, n in leaves:
            caps[d] += 2 * n
        caps["z"] = 0.0
        want_b = sum(n for *_, n in leaves) if budget is None else budget
        top = _fill(want_b, caps, weights["d"])
        for d in "abcz":
            mine = {l: 2.0 * n for x, l, n in leaves if x == d}
            low = _fill(top[d], mine, {l: weights["l"].get(l, 1.0) for l in mine})
            for l, v in low.items():
                assert abs(got[d, l] - v) <= 1, (budget, d, l)


def test_mixing_takes_prefixes_of_seeded_epochs(spark):
    data = [(i, "w " * (1 + i % 7), "en", "src0" if i % 3 else f"src{i % 5}") for i in range(600)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    got = mixing.mixed(df, max_epochs=3).collect()
    leaf_of = {r.doc_id: (r.domain, r.lang, r.source) for r in got}
    size = {i: 1 + i % 7 for i in range(600)}
    supply, taken = collections.Counter(), collections.defaultdict(collections.Counter)
    for i, _, lang, source in data:
        supply["domain" + str(int(source[3:]) % 4), lang, source] += size[i]
    for r in got:
        assert r.n_tokens == size[r.doc_id]
        taken[leaf_of[r.doc_id]][r.epoch, r.doc_id] += 1
    for leaf, copies in taken.items():
        assert set(copies.values()) == {1}
        epochs = collections.defaultdict(set)
        for e, i in copies:
            epochs[e].add(i)
        last = max(epochs)
        everyone = {i for i, _, lang, s in data if ("domain" + str(int(s[3:]) % 4), lang, s) == leaf}
        assert all(epochs[e] == everyone for e in range(last))
        order = sorted(everyone, key=lambda i: hashlib.md5(f"17:{last}:{i}".encode()).hexdigest())
        assert epochs[last] == set(order[:len(epochs[last])])  # a prefix of that epoch's order
    total = sum(size[i] for i in size)
    assert total * 0.97 <= sum(r.n_tokens for r in got) <= total
    again = mixing.mixed(df, max_epochs=3)
    assert sorted(again.collect()) == sorted(got)


def test_mixing_edge_cases(spark):
    got = mixing.mixed_documents(docs(spark))
    assert got.columns == docs(spark).columns and got.count() > 0
    chosen = mixing.mixed(docs(spark)).collect()
    assert {r.doc_id for r in chosen} <= {r[0] for r in rows()}
    per = collections.Counter((r.doc_id, r.epoch) for r in chosen)
    assert per.get((10, 0), 3) == 3  # rows that share an id go together
    assert mixing.mixed(empty(spark)).count() == 0
    assert mixing.mixed_documents(empty(spark)).count() == 0
