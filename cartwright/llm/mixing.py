"""Mixing sources to target weights by repeating their documents.

The words of every source are added up, each source gets a target number of words, and
target / words is its repetition rate. A document is emitted floor(rate) times, and once
more if a draw seeded by its id and text falls below the fraction of the rate. So the
expected words of a source are its target, and the same rows give the same mix on every
run, in any partitioning.

Targets: the sources in code point order (null last) take the weights in turn, and share
``share`` times all words by weight. No target exceeds ``most`` times the words of its
source; what is above is shared again by weight among the others until none is above.
The targets then all lie on one level per unit of weight or at their limit; the level is
found by sums over the table of sources, which is never collected.

Only partial sums of words are shuffled, so a hot source stays where it is. The join with
the targets is left to Spark: small tables of sources are broadcast by their size, others
are joined by shuffles that AQE splits.

Defined results: a null text has no words. Sources without words have target 0 and none of
their documents is emitted. Rows equal in id and text share one draw. Other columns pass
through; columns of the names that the plan adds are replaced. An empty table gives an
empty mix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from cartwright.operators.generate import digest
from cartwright.operators.keys import number_in_order

from .common import store

SPACE = " \t\n\x0b\x0c\r"
DRAW_DIGITS = 13  # hex digits of a draw: 52 bits, all that a fraction can hold


def n_words(text: Column) -> Column:
    r"""Number of maximal runs of characters outside ``[\x20\x09-\x0D]``; 0 for null."""
    marked = F.regexp_replace(text, r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", "w")
    kept = F.char_length(F.rtrim(marked, F.lit(SPACE)))  # space after the last word
    return F.coalesce(kept, F.lit(0)).cast("long")


def source_sizes(docs: DataFrame) -> DataFrame:
    """(source, source_size): words of each source."""
    return docs.groupBy(F.col("source").cast("string").alias("source")).agg(
        F.sum(n_words(F.col("text"))).alias("source_size")
    )


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """(source, source_size, target), stored."""
    last = sizes.withColumn("_last", F.col("source").isNull())
    numbered = number_in_order(last, "_last", "source")
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.col("number") % len(weights) + 1).cast("int"),
    )
    limit = F.col("source_size") * F.lit(float(most))
    table = store(
        numbered.select("source", "source_size", weight.alias("weight"), limit.alias("limit")),
        "sources",
    )
    total = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    level, at_limit = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > F.col("limit")
        full, taken, open_weight = table.agg(
            F.count_if(over),
            F.coalesce(F.sum(F.when(over, F.col("limit"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)),
        ).first()
        if full == at_limit:
            break
        at_limit = full
        # With all at their limit there is nobody left to share with.
        level = (total - taken) / open_weight if open_weight else math.inf
    target = F.least(F.col("weight") * F.lit(level), F.col("limit"))
    return store(table.select("source", "source_size", target.alias("target")), "targets")


def mixing_plan(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 13,
) -> DataFrame:
    """The documents with size, source_size, target, copies and taken (size x copies)."""
    targets = source_targets(source_sizes(docs), weights, share, most)
    added = ("size", "source_size", "target", "copies", "taken")
    kept = [F.col(f"d.{c}") for c in docs.columns if c not in added]
    words, target = F.col("t.source_size"), F.col("t.target")
    rate = F.when(words > 0, target / words).otherwise(0.0)
    drawn = F.substring(digest(seed, "mix", F.col("d.doc_id"), F.md5("d.text")), 1, DRAW_DIGITS)
    draw = F.conv(drawn, 16, 10).cast("double") / F.lit(float(16**DRAW_DIGITS))
    copies = F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)
    same = F.col("d.source").cast("string").eqNullSafe(F.col("t.source"))
    return (
        docs.alias("d")
        .join(targets.alias("t"), same, "left")
        .select(
            *kept,
            n_words(F.col("d.text")).alias("size"),
            words.alias("source_size"),
            target.alias("target"),
            copies.cast("long").alias("copies"),
        )
        .withColumn("taken", F.col("size") * F.col("copies"))
    )


def mix(plan: DataFrame) -> DataFrame:
    """The documents of the plan, each as often as it says, numbered from 0 by ``copy``.

    A document is never repeated more than ``most`` times, so a row grows by little.
    """
    copies = F.sequence(F.lit(0), F.col("copies").cast("int") - 1)
    return plan.where("copies > 0").withColumn("copy", F.explode(copies))
