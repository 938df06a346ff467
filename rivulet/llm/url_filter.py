"""Operator 2, URL filters: host word segmentation and naive Bayes.

Rules decide the urls they fit. Every other url is judged by its words: hosts and paths
glue words together, so each piece between punctuation is split by unigram Viterbi, with
word frequencies counted over all pages, and a multinomial naive Bayes model, trained on
the urls that the rules decided, scores the segmented host and path words.

Nothing is looked up in a vocabulary on the driver: every distinct piece offers its
substrings to a join with the word counts, so the vocabulary may be of any size, and only
distinct pieces and distinct url shapes (numbers set equal) are segmented and scored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import stored

#: (host, path, verdict) of the registered query; fixed values.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
#: Longest word that segmentation considers.
LONGEST = 20
SMOOTH = 1.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty
    without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _matching(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits ``host`` and ``path``, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for host, path, word in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(word)).otherwise(verdict)
    return rule, verdict


def _pieces(text: Column, side: str) -> Column:
    """Letter runs of a host or path, marked with their side; a number is ``0``."""
    lowered = F.regexp_replace(F.lower(text), "[0-9]+", " 0 ")
    return F.transform(F.filter(F.split(lowered, "[^\\p{L}0]+"), lambda x: x != ""),
                       lambda x: F.concat(F.lit(side + ":"), x))


def word_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """``(word, n)`` over all texts: runs of letters, lower-cased."""
    words = F.split(F.lower(F.col(text_col)), "[^\\p{L}]+")
    return (texts.select(F.explode(words).alias("word")).where(F.length("word").between(1, LONGEST))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def segment(piece: str, counts: dict[str, int], total: int) -> list[str]:
    """Most probable split of ``piece`` under the unigram model. A word that the corpus
    lacks costs as much as a tenth of one occurrence per letter, to the power of its
    length, so unknown stretches stay whole only where no known words cover them."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(piece) + 1):
        options = []
        for begin in range(max(0, end - LONGEST), end):
            n = counts.get(piece[begin:end], 0)
            cost = -math.log(n / total) if n else math.log(total) + (end - begin) * math.log(10)
            options.append((best[begin][0] + cost, begin))
        best.append(min(options))
    out, end = [], len(piece)
    while end:
        begin = best[end][1]
        out.append(piece[begin:end])
        end = begin
    return out[::-1]


def segmented(pieces: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """``(piece, word)`` rows of the distinct ``piece`` values (``h:name`` or ``p:name``)."""
    names = pieces.select(F.substring("piece", 3, 1 << 30).alias("name")).distinct()
    size = F.length("name")
    starts = names.select("name", size.alias("size"), F.explode(F.sequence(F.lit(1), size)).alias("at"))
    parts = starts.select("name", F.explode(F.sequence(
        F.lit(1), F.least(F.lit(LONGEST), F.col("size") - F.col("at") + 1))).alias("len"), "at")
    parts = parts.select("name", F.expr("substring(name, at, len)").alias("word")).distinct()
    known = parts.join(counts, "word").groupBy("name").agg(F.collect_list(F.struct("word", "n")).alias("known"))

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"name": f["name"], "words": [
                segment(name, {k["word"]: k["n"] for k in ([] if known is None else known)}, total)
                for name, known in zip(f["name"], f["known"])]})

    words = names.join(known, "name", "left").mapInPandas(split, "name string, words array<string>")
    whole = pieces.select("piece").distinct().withColumn("name", F.substring("piece", 3, 1 << 30)).join(words, "name")
    return whole.select("piece", F.explode("words").alias("w")).select(
        "piece", F.concat(F.substring("piece", 1, 2), "w").alias("word"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id",
          url_col: str = "url", text_col: str = "html") -> DataFrame:
    """One row per page: ``id_col, host, path, rule, verdict, block_odds`` (log-odds of
    block under naive Bayes).

    A url that is null or has no ``://`` has an empty host and path and fits no rule; so
    has an empty host. Naive Bayes says block when its odds are positive; with no words,
    or when the rules decided for one verdict only, its odds are 0 and the url is allowed.
    Repeated rows each get a row; other columns are ignored; an empty table gives an empty
    result."""
    urls = pages.select(F.col(id_col).alias("_id"), host_of(F.col(url_col)).alias("host"),
                        path_of(F.col(url_col)).alias("path"))
    rule, verdict = _matching(rules)
    urls = urls.withColumn("rule", rule).withColumn("_ruled", verdict).withColumn(
        "_pieces", F.concat(_pieces(F.col("host"), "h"), _pieces(F.col("path"), "p")))
    urls = stored(urls.withColumn("_shape", F.concat_ws(" ", "_pieces")), "url-shapes")
    shapes = stored(urls.groupBy("_shape", "_ruled").agg(F.count(F.lit(1)).alias("n")), "url-counts")

    counts = word_counts(pages, text_col)
    pieces = shapes.select(F.explode(F.split("_shape", " ")).alias("piece")).where("piece <> ''")
    counts = stored(counts, "url-words")
    total = counts.agg(F.sum("n")).first()[0] or 1
    words = stored(segmented(pieces, counts, total), "url-segments")

    # how often each word occurs under each verdict
    shape_words = shapes.select("_shape", "_ruled", "n", F.explode(F.split("_shape", " ")).alias("piece")).join(words, "piece")
    seen = shape_words.where(F.col("_ruled").isNotNull()).groupBy("word").agg(
        F.sum(F.when(F.col("_ruled") == "block", F.col("n")).otherwise(0)).alias("b"),
        F.sum(F.when(F.col("_ruled") == "allow", F.col("n")).otherwise(0)).alias("a"))
    seen = stored(seen, "url-bayes")
    urls_by = {r["_ruled"]: r["n"] for r in shapes.groupBy("_ruled").agg(F.sum("n").alias("n")).collect()}  # <= 3 rows
    nb, na = urls_by.get("block", 0), urls_by.get("allow", 0)
    sums = seen.agg(F.sum("b").alias("b"), F.sum("a").alias("a"), F.count(F.lit(1)).alias("v")).first()
    if nb and na:
        base_b, base_a = (sums["b"] or 0) + SMOOTH * (sums["v"] + 1), (sums["a"] or 0) + SMOOTH * (sums["v"] + 1)
        scale = math.log(base_a / base_b)  # all that a word without occurrences says
        gain = seen.select("word", (F.log(F.col("b") + SMOOTH) - F.log(F.col("a") + SMOOTH) + scale).alias("gain"))
        per_piece = words.join(gain, "word", "left").groupBy("piece").agg(
            F.sum(F.coalesce("gain", F.lit(scale))).alias("gain"))
        odds = (shapes.select("_shape").distinct().select("_shape", F.explode(F.split("_shape", " ")).alias("piece"))
                .join(per_piece, "piece").groupBy("_shape").agg((F.sum("gain") + math.log(nb / na)).alias("block_odds")))
    else:
        odds = shapes.select("_shape").distinct().withColumn("block_odds", F.lit(0.0))
    odds = stored(odds, "url-odds")
    out = urls.join(odds, "_shape", "left").withColumn("block_odds", F.coalesce("block_odds", F.lit(0.0)))
    return out.select(F.col("_id").alias(id_col), "host", "path", "rule", F.coalesce(
        "_ruled", F.when(F.col("block_odds") > 0, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "block_odds")
