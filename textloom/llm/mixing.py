"""Mixing sources to target weights by systematic sampling (DataFrame and SQL only).

Every document of a source has the same number of expected copies, the
source's target divided by its size. Documents of a source are put in order
of size and id, their expected copies are summed from the front, one random
offset is added for the source, and a document is emitted once per whole
number that its part of the sum crosses. Because neighbours in that order
have nearly the same size, the words taken differ from the target by no more
than about the longest document of the source.

Sums are kept in units of 2**-28 copies as whole numbers, so no rounding
error builds up along a source of any length.

Defined results: a null or empty text has size 0; a null source is a source
of its own, ordered last; an empty table gives an empty mix; if all sizes are
0, all targets are 0 and nothing is taken; rows with the same id and size are
neighbours, and each has copies of its own; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import WORD, written

#: Units that make one copy.
UNITS = 1 << 28


def _offset(source: Column, seed: int) -> Column:
    """One offset per source, below one copy: 28 bits of a digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("\u0001"))))
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], most: int) -> DataFrame:
    """``source, source_size`` with the target of each source.

    Shares by weight, where no source gives more than ``most`` times its size
    and what it can't give is shared among the others. With L the level at
    which all targets ``min(most * size, L * weight)`` add up to the total, L
    is the greatest of the levels reached when sources are closed in order of
    ``size / weight``. One row per source, already added up.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]),
        (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    by_ratio = Window.orderBy(
        F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source")
    )
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    closed = most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    closed_weight = F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = (F.sum("source_size").over(everything) - closed) / (
        F.sum("weight").over(everything) - closed_weight
    )
    return (
        sizes.withColumn("weight", weight)
        .withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .withColumn(
            "target",
            F.least(
                (most * F.col("source_size")).cast("double"), F.col("level") * F.col("weight")
            ),
        )
        .select("source", "source_size", "target")
    )


def mix_plan(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    most: int = 3,
    seed: int = 7,
    key: str = "doc_id",
) -> DataFrame:
    """How often each row of ``docs`` is taken.

    Returns ``key, source, size, source_size, target, copies``. Weights are
    given to the sources in code-point order, over and over. Only ids, sources
    and sizes are moved: they are range-partitioned, so that a source may span
    any number of tasks, and a row's place in its source is its place in its
    task plus the source's rows in earlier tasks.
    """
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    order = [F.col("source").isNull(), F.col("source"), F.col("size"), F.col(key)]
    sized = docs.select(key, "source", size.alias("size"))
    ranged = written(
        sized.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()),
        "mix-sizes",
    ).withColumn("part", F.shiftright("place", 33))
    runs = ranged.groupBy("source", "part").agg(
        F.min("place").alias("first"), F.count("*").alias("rows"), F.sum("size").alias("words")
    )
    earlier = (
        Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = runs.select(
        F.col("source").alias("_source"),
        F.col("part").alias("_part"),
        (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
    )
    targets = source_targets(
        runs.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most
    ).withColumnRenamed("source", "_of")
    same_run = F.col("source").eqNullSafe(F.col("_source")) & (F.col("part") == F.col("_part"))
    shifts = shifts.join(targets, F.col("_source").eqNullSafe(F.col("_of")))
    rate = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNITS)
    ).otherwise(F.lit(0)).cast("long")
    end = F.col("place") + F.col("shift") + 1
    crossed = lambda k: F.shiftright(rate * k + _offset(F.col("source"), seed), 28)
    return (
        ranged.join(shifts, same_run)
        .withColumn("copies", crossed(end) - crossed(end - 1))
        .select(key, "source", "size", "source_size", "target", "copies")
    )


def mixed(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    most: int = 3,
    seed: int = 7,
    key: str = "doc_id",
) -> DataFrame:
    """The rows of the mix, each as often as it is taken, with the columns of ``docs``.

    Rows alike in id, source and size take as many copies as the first of them.
    """
    own = "__mix"  # names that no column of ``docs`` has
    while any(c.lower().startswith(own) for c in docs.columns):
        own += "_"
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    plan = mix_plan(docs, weights, most, seed, key)
    taken = (
        plan.groupBy(
            F.col(key).alias(f"{own}_key"), F.col("source").alias(f"{own}_source"), F.col("size").alias(f"{own}_size")
        )
        .agg(F.max("copies").cast("int").alias(f"{own}_copies"))
        .filter(f"`{own}_copies` > 0")
    )
    same = (
        F.col(key).eqNullSafe(F.col(f"{own}_key"))
        & F.col("source").eqNullSafe(F.col(f"{own}_source"))
        & (size == F.col(f"{own}_size"))
    )
    return (
        docs.join(taken, same)
        .withColumn(f"{own}_copy", F.explode(F.sequence(F.lit(1), F.col(f"{own}_copies"))))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
