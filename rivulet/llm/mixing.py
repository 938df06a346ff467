"""Operator 10, mixing sources to target weights (native): hierarchical budgeting.

A token budget flows down a tree of groups (domain, language, source). At each node it is
split among the children by weight; a child that cannot use its share (its tokens times
``max_epochs``) is filled, and what it leaves goes to its siblings by weight. Only when a
whole subtree is full does the rest go to the parent's siblings, because each node is
capped by what its subtree can hold. The level of each split has a closed form: children
in order of capacity/weight fill first, so windows over the (small) node table solve it.

A leaf then takes whole epochs and a prefix of one more. The order of an epoch is a hash
of (seed, epoch, id); a prefix is therefore just a key bound, found from totals per
4096-way key range and one exact running sum inside a single range per leaf. Documents
meet only that bound, so no text is shuffled and no leaf, however large, is sorted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import WS, WS_CHARS, stored, whole_text

LEVELS = ("domain", "lang", "source")
#: Target weights of the registered query and the pipeline; a value that is not listed
#: (any source, or an unknown domain or language) weighs 1 among its siblings.
WEIGHTS = {"domain": {"domain0": 4.0, "domain1": 3.0, "domain2": 2.0, "domain3": 1.0},
           "lang": {"en": 11.0, "de": 3.0, "fr": 3.0, "es": 3.0}}
MAX_EPOCHS = 4
SEED = 17


def source_domain(source: str = "source") -> Column:
    """Domain of a source: its trailing number modulo 4; ``other`` without a number."""
    digits = F.regexp_extract(F.col(source), r"([0-9]{1,9})$", 1)
    return F.when(F.col(source).isNull(), None).when(digits == "", F.lit("other")).otherwise(
        F.concat(F.lit("domain"), (digits.cast("int") % 4).cast("string")))


def token_count(text_col: str = "text") -> Column:
    """Number of ASCII-white-space separated words."""
    trimmed = F.btrim(whole_text(text_col), F.lit(WS_CHARS))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, WS, -1))).cast("long")


def _weight(level: str, weights: Mapping[str, Mapping[str, float]]) -> Column:
    out = F.lit(1.0)
    for value, w in weights.get(level, {}).items():
        out = F.when(F.col(level).eqNullSafe(F.lit(value)), F.lit(float(w))).otherwise(out)
    return out


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with null equal to null; the left side's keys stay."""
    other = right.select(*[F.col(k).alias(f"_right_{k}") for k in keys],
                         *[c for c in right.columns if c not in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"`{k}`").eqNullSafe(F.col(f"_right_{k}"))
    return left.join(other, cond, how).drop(*[f"_right_{k}" for k in keys])


def allocate(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, float]],
             budget: float | None = None, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``leaves`` (the ``levels`` columns and ``supply``) with ``quota`` tokens each.

    ``budget`` None means as many tokens as there are. A weight of 0 takes its subtree
    out. Quotas are whole tokens (rounded down)."""
    usable = F.lit(True)
    for level in levels:
        usable = usable & (_weight(level, weights) > 0)
    nodes = leaves.withColumn("_cap", F.when(usable, F.col("supply") * F.lit(float(max_epochs)))
                              .otherwise(F.lit(0.0)))
    total = nodes.agg(F.sum("_cap").alias("_all"), F.sum("supply").alias("_sum"))
    given = F.col("_sum").cast("double") if budget is None else F.lit(float(budget))
    whole = total.select(F.least(F.col("_all"), given)).scalar()
    parent = None
    for depth, level in enumerate(levels, 1):
        keys = list(levels[:depth])
        here = nodes.groupBy(*keys).agg(F.sum("_cap").alias("_cap")).withColumn(
            "_w", _weight(level, weights))
        if depth == 1:
            here = here.withColumn("_give", whole)
        else:
            here = _join(here, parent, keys[:-1])
        group = Window.partitionBy(*keys[:-1])
        order = group.orderBy(F.col("_ratio").asc_nulls_last(), F.col(level).asc_nulls_first())
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        here = (
            here.withColumn("_ratio", F.when(F.col("_w") > 0, F.col("_cap") / F.col("_w")))
            .withColumn("_level", (F.col("_give") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                        / F.sum(F.when(F.col("_w") > 0, F.col("_w"))).over(after))
            .withColumn("_full", F.col("_ratio") <= F.col("_level"))
            .withColumn("_share", F.max(F.when(~F.col("_full"), F.col("_level"))).over(group)))
        parent = here.select(*keys, F.when(F.col("_w") <= 0, F.lit(0.0))
                             .when(F.col("_full"), F.col("_cap"))
                             .otherwise(F.col("_w") * F.col("_share")).alias("_give"))
    quota = parent.select(*levels, F.floor(F.col("_give") + F.lit(1e-6)).cast("long").alias("quota"))
    return _join(leaves, quota, levels)


def _key(epoch: Column, id_col: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"),
                             F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


def plan(rows: DataFrame, levels: Sequence[str] = LEVELS, weights=WEIGHTS,
         budget: float | None = None, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
         id_col: str = "doc_id") -> DataFrame:
    """Per leaf: ``quota``, whole ``epochs`` and ``cut_key``, the largest key of the
    prefix taken from the next epoch. ``rows`` has the levels, the id and ``n_tokens``."""
    leaves = rows.groupBy(*levels).agg(F.sum("n_tokens").alias("supply"))
    leaves = stored(allocate(leaves, levels, weights, budget, max_epochs)
                    .withColumn("epochs", F.when(F.col("supply") > 0, F.floor(
                        F.col("quota") / F.col("supply"))).otherwise(0).cast("long"))
                    .withColumn("rest", F.col("quota") - F.col("epochs") * F.col("supply")),
                    "mix-leaves")
    want = leaves.where("rest > 0")
    keyed = _join(rows, want, levels).select(
        *levels, "n_tokens", "rest", _key(F.col("epochs"), id_col, seed).alias("key"))
    keyed = keyed.withColumn("range", F.substring("key", 1, 3))
    leaf = Window.partitionBy(*levels)
    ranges = keyed.groupBy(*levels, "range").agg(F.sum("n_tokens").alias("n"), F.max("rest").alias("rest"))
    ranges = ranges.withColumn("end", F.sum("n").over(leaf.orderBy("range")))
    cut = (ranges.where("end > rest and end - n <= rest")  # the range in which the prefix ends
           .select(*levels, "range", (F.col("end") - F.col("n")).alias("before")))
    cut = stored(cut, "mix-cut")
    inside = (_join(keyed, cut, [*levels, "range"]).groupBy(*levels, "key").agg(F.sum("n_tokens").alias("n"), F.max("rest").alias("rest"),
                                                 F.max("before").alias("before"))
              .withColumn("end", F.col("before") + F.sum("n").over(leaf.orderBy("key")))
              .where("end <= rest").groupBy(*levels).agg(F.max("key").alias("last")))
    out = _join(_join(leaves, cut.drop("before"), levels, "left"), inside, levels, "left")
    return stored(out.select(*levels, "supply", "quota", "epochs", F.coalesce("last", "range", F.lit("")).alias("cut_key")), "mix-plan")


def select_copies(rows: DataFrame, leaf_plan: DataFrame, levels: Sequence[str] = LEVELS,
                  seed: int = SEED, id_col: str = "doc_id") -> DataFrame:
    """``rows`` once per epoch that takes them, with ``epoch``; all their columns stay."""
    names = rows.columns
    taken = _join(rows, leaf_plan.select(*levels, F.col("epochs").alias("_epochs"),
                                         F.col("cut_key").alias("_cut")), levels)
    copies = F.col("_epochs") + (_key(F.col("_epochs"), id_col, seed) <= F.col("_cut")).cast("long")
    return (taken.withColumn("_copies", copies).where("_copies > 0")
            .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
            .select(*[F.col(f"`{c}`") for c in names], "epoch"))


def mixed(docs: DataFrame, weights=WEIGHTS, budget: float | None = None,
          max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """One row per chosen document and epoch: ``doc_id, domain, lang, source, n_tokens,
    epoch``.

    ``docs`` has ``doc_id, text, lang, source``; more columns are ignored. Null languages,
    sources and domains are groups of their own. A null text has no tokens; a leaf
    without tokens takes nothing. Rows that share an id share their place in the order
    and are taken or left together. An empty table gives an empty result."""
    rows = stored(_leaf_rows(docs), "mix-rows")
    return select_copies(rows, plan(rows, LEVELS, weights, budget, max_epochs, seed), seed=seed)


def _leaf_rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", source_domain().alias("domain"), "lang", "source",
                       token_count().alias("n_tokens"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, budget: float | None = None,
                    max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The chosen rows of ``docs`` with their own columns, repeated once per epoch."""
    names = docs.columns
    rows = stored(_leaf_rows(docs), "mix-rows")
    leaf_plan = plan(rows, LEVELS, weights, budget, max_epochs, seed)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), "doc_id",
                        source_domain().alias("domain"), "lang", "source")
    return select_copies(whole, leaf_plan, seed=seed).select("_row.*")
