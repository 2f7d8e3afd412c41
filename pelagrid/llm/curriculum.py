"""Mixing sources to target weights along a time-varying curriculum.

Every source has a target number of words: its share by weight of the words to be drawn, at
most ``most_passes`` times its own size, the excess shared again by weight until none is
above. Over training time 0 to 1 a source is drawn with a density given by straight
lines between knots (integral 1), so its cumulative demand is a known function of time.
A source's documents stand in a fixed shuffled order; a copy of a document is due when the demand
reaches the words before it, which the inverse of the demand turns into a training
position. Sorting copies by position (a range sort) gives the training order.

The last copy that a target needs is cut at a word, so the words taken of a source are
its target to the nearest word. No document is taken more than ``most_passes`` times.

Defined results: null and empty texts have size 0, are taken 0 times and have no position;
null sources are one source, last in order; documents with equal ids keep an order by size, equal
rows are interchangeable. Extra columns are carried along.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagrid.llm.graph import AT, SLICE, running, sliced, written

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Curriculum:
    """``weights`` and ``schedules`` repeat over sources in code point order, null last.

    A schedule is a list of (time, density) knots from time 0 to 1; it is scaled to integral 1.
    """

    weights: tuple[float, ...] = (3, 1, 2)
    draw: float = 1.5
    most_passes: int = 2
    schedules: tuple[tuple[tuple[float, float], ...], ...] = (
        ((0.0, 1.5), (1.0, 0.5)),
        ((0.0, 1.0), (1.0, 1.0)),
        ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
    )


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def due(schedule: tuple[tuple[float, float], ...], share: Column) -> Column:
    """Training time at which a source's cumulative demand reaches ``share`` of its target."""
    area = sum((t1 - t0) * (d0 + d1) / 2 for (t0, d0), (t1, d1) in zip(schedule, schedule[1:]))
    at, found = 0.0, None
    steps = []
    for (t0, d0), (t1, d1) in zip(schedule, schedule[1:], strict=False):
        d0, d1 = d0 / area, d1 / area
        slope = (d1 - d0) / (t1 - t0)
        rest = share - F.lit(at)
        # d0 x + slope x^2 / 2 = rest, in the form that also holds for slope 0
        root = F.sqrt(F.greatest(F.lit(d0 * d0) + 2 * slope * rest, F.lit(0.0)))
        steps.append((at + (t1 - t0) * (d0 + d1) / 2, F.lit(t0) + 2 * rest / (F.lit(d0) + root)))
        at = steps[-1][0]
    for end, value in reversed(steps):
        found = value if found is None else F.when(share <= end, value).otherwise(found)
    return found


def targets(sizes: DataFrame, plan: Curriculum = Curriculum()) -> DataFrame:
    """source, source_size, order (from 0), weight, target from sizes(source, source_size)."""
    keyed = sliced(sizes, [F.col("source").asc_nulls_last()], "sources").withColumn("_one", F.lit(1))
    ranked = running(keyed, [], "_one", "order").drop("_one", SLICE, AT)
    choices = F.array(*[F.lit(float(w)) for w in plan.weights])
    place = (F.col("order") % len(plan.weights)).cast("int")
    table = written(ranked.withColumn("weight", F.get(choices, place)), "weights")
    cap = F.col("source_size") * float(plan.most_passes)
    total = table.agg(F.sum("source_size")).first()[0] or 0
    # Each round caps the sources that are above; the rest share what is left by weight.
    level, capped = math.inf, -1
    while total:
        above = cap <= F.col("weight") * level if math.isfinite(level) else F.lit(False)
        took, free, n = table.agg(
            F.sum(F.when(above, cap).otherwise(0.0)),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))),
            F.sum(above.cast("long")),
        ).first()
        if n == capped or not free:
            break
        capped = n
        level = (plan.draw * total - took) / free
    share = F.col("weight") * (level if math.isfinite(level) else 0.0)
    return table.withColumn("target", F.least(cap, share))


def schedule(documents: DataFrame, plan: Curriculum = Curriculum()) -> DataFrame:
    """All columns but the text, with size, source_size, target, taken, copies(position, words)."""
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sized = documents.withColumn("size", n_words(F.col("text").cast("string"))).withColumn("_order", order)
    rows = sliced(
        sized.drop("text"),
        [F.col("source").asc_nulls_last(), "_order", "doc_id", "size"],
        "documents",
    ).drop("_order")
    before = running(rows, ["source"], "size", "_before_words").drop(SLICE, AT)
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(sums, plan).withColumnRenamed("source", "_source")
    joined = before.join(goal, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    words = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, (words / F.col("source_size")).cast("long")).otherwise(F.lit(0))
    joined = joined.withColumns({"_words": words, "_passes": passes})
    joined = joined.withColumn("_rest", F.col("_words") - F.col("_passes") * F.col("source_size"))
    copies = []
    for k in range(plan.most_passes):
        own = F.when(F.col("_passes") > k, F.col("size")).when(
            F.col("_passes") == k,
            F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rest") - F.col("_before_words"))),
        ).otherwise(F.lit(0)).cast("long")
        share = F.try_divide(k * F.col("source_size") + F.col("_before_words"), F.col("target"))
        position = None
        for c, knots in enumerate(plan.schedules):
            here = due(knots, share)
            position = here if position is None else F.when(
                F.col("order") % len(plan.schedules) == c, here
            ).otherwise(position)
        copies.append(F.struct(position.alias("position"), own.alias("words")))
    made = joined.withColumn("copies", F.filter(F.array(*copies), lambda x: x["words"] > 0))
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda total, x: total + x["words"])
    return made.withColumn("taken", taken).drop("_words", "_passes", "_rest", "_before_words", "order", "weight")


def training_order(scheduled: DataFrame) -> DataFrame:
    """One row for each copy, range-sorted by its training position."""
    return scheduled.select("*", F.inline("copies")).drop("copies").orderBy("position", "doc_id")
