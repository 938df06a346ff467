"""Operator 9, quality rules (native): weak supervision.

Each rule votes good or bad, or abstains. How far to trust a rule is not set by hand: in a
latent label model, where rules err independently, abstain regardless of the label and the
two labels are equally likely beforehand, expectation-maximisation estimates each rule's
accuracy, and a document's posterior probability of being good replaces "must pass every
rule". EM needs only how often each combination of votes occurs; there are at most
``3 ** len(RULES)`` combinations, counted over all documents by a hash aggregate, so the
fit works on a table of proven size at any corpus size. The posterior is the sum of the
votes weighted by log-odds of accuracy, a plain SQL expression.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import WS_CHARS, stored, whole_text, words_col

WINDOW = 5
#: Variety is the share of distinct words in stretches of so many words, over the whole text:
#: that of a text as a whole falls with its length.
STRETCH = 500
#: A document is kept when its posterior probability of being good reaches this.
KEEP_AT = 0.5
RULES = ("length", "symbols", "repeats", "lines", "shouting", "variety", "plain")
EM_ROUNDS = 200
#: Accuracy that EM starts from, held against the data with the weight of so many votes.
START, START_VOTES = 0.8, 10.0


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))


def _vote(bad: Column, good: Column | None = None) -> Column:
    no = F.when(bad, F.lit(-1))
    return no.otherwise(F.lit(0)) if good is None else no.when(good, F.lit(1)).otherwise(F.lit(0))


def rules() -> dict[str, Column]:
    """Votes over the feature columns: 1 good, -1 bad, 0 abstain. A rule votes good only
    for what bad texts of every kind lack; the absence of one fault is no vote."""
    length, symbols = _ratio("word_chars", "n_words"), _ratio("n_symbols", "n_words")
    repeats, dup_lines = _ratio("n_repeat_words", "n_words"), _ratio("n_dup_lines", "n_lines")
    shouts, distinct = _ratio("n_shouts", "n_words"), _ratio("n_stretch_distinct", "n_words")
    return {
        "length": _vote((length < 2.0) | (length > 14.0)),
        "symbols": _vote(symbols > 0.1),
        "repeats": _vote(repeats > 0.15),
        "lines": _vote(dup_lines > 0.3),
        "shouting": _vote(shouts > 0.1),
        "variety": _vote(distinct < 0.25),
        "plain": _vote(F.lit(False), (symbols < 0.02) & (shouts < 0.02) & (repeats < 0.05) & (distinct > 0.4)),
    }


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of each text that the rules look at, one narrow row per document."""
    df = docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_t"))
    df = df.withColumn("_w", words_col(F.col("_t")))
    df = df.withColumn("_l", F.filter(F.split("_t", "\n", -1), lambda x: F.btrim(x, F.lit(WS_CHARS)) != ""))
    n = F.size("_w").cast("long")
    # a 64-bit hash of each window stands for its five words (within one document)
    grams = F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("_w") - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col("_w"), i + k) for k in range(WINDOW)]))
    ).otherwise(F.array().cast("array<bigint>"))
    varied = F.aggregate(
        F.transform(F.sequence(F.lit(0), F.floor((F.size("_w") - 1) / STRETCH).cast("int")), lambda i: F.size(
            F.array_distinct(F.slice("_w", i * STRETCH + 1, STRETCH))).cast("long")),
        F.lit(0).cast("long"), lambda a, b: a + b)
    varied = F.when(n > 0, varied).otherwise(F.lit(0).cast("long"))
    df = df.select(
        "_id", n.alias("n_words"),
        F.length(F.translate("_t", WS_CHARS, "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        (F.length("_t") - F.length(F.replace(F.col("_t"), F.lit("!"), F.lit("")))).cast("long").alias("n_shouts"),
        varied.alias("n_stretch_distinct"),
        grams.alias("_g"))
    # most texts repeat no window: only the others are sorted
    df = df.withColumn("_g", F.when(F.size(F.array_distinct("_g")) < F.size("_g"), F.col("_g")))
    df = df.withColumn("_s", F.array_sort(F.transform(
        "_g", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.withColumn("_p", F.array_sort(F.transform(
        F.filter("_s", lambda x, j: (F.get(F.col("_s"), j - 1)["h"] == x["h"]).eqNullSafe(True)
                 | (F.get(F.col("_s"), j + 1)["h"] == x["h"]).eqNullSafe(True)), lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("_p", lambda x, j: F.least(F.lit(WINDOW), F.coalesce(
            F.get(F.col("_p"), j + 1) - x, F.lit(WINDOW)))),
        F.lit(0), lambda a, b: a + b)
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_g", "_s", "_p")


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = EM_ROUNDS) -> list[float]:
    """Each rule's accuracy by EM, from ``(votes, count)``; without votes that of ``START``."""
    accuracy = [START] * len(RULES)
    for _ in range(rounds):
        right = [START * START_VOTES] * len(RULES)
        cast = [START_VOTES] * len(RULES)
        for votes, count in patterns:
            p = 1 / (1 + math.exp(-sum(v * _log_odds(a) for v, a in zip(votes, accuracy))))
            for j, v in enumerate(votes):
                cast[j] += abs(v) * count
                right[j] += count * (p if v > 0 else 1 - p if v < 0 else 0)
        was, accuracy = accuracy, [r / c for r, c in zip(right, cast)]
        if max(abs(x - y) for x, y in zip(was, accuracy)) < 1e-12:
            break
    return accuracy


def _log_odds(accuracy: float) -> float:
    a = min(max(accuracy, 1e-6), 1 - 1e-6)
    return math.log(a / (1 - a))


def posterior(accuracy: list[float]) -> Column:
    odds = F.lit(0.0)
    for name, a in zip(RULES, accuracy):
        odds = odds + F.col(f"vote_{name}") * F.lit(_log_odds(a))
    return 1 / (1 + F.exp(-odds))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  keep_at: float = KEEP_AT) -> DataFrame:
    """One row per document: its counts, ``base_failed``, each rule's vote, ``p_good`` and
    ``kept`` (never when ``base_failed``). A text on which no rule votes is kept.

    A null text has no words, and every text under ten words fails the base. Documents
    that fail the base still vote in the fit. Repeated rows each get a row; other columns
    are ignored; an empty table gives an empty result."""
    found = features(docs, id_col, text_col)
    found = found.withColumn("base_failed", (F.col("n_words") < 10) | (
        100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    found = stored(found.select("*", *[v.alias(f"vote_{n}") for n, v in rules().items()]), "rules-votes")
    votes = [f"vote_{n}" for n in RULES]
    patterns = [(tuple(r[v] for v in votes), r["n"])  # at most 3 ** len(RULES) rows
                for r in found.groupBy(*votes).agg(F.count(F.lit(1)).alias("n")).collect()]
    accuracy = fit(sorted(patterns))
    return found.withColumn("p_good", posterior(accuracy)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("p_good") >= keep_at)).select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "p_good", *votes)
