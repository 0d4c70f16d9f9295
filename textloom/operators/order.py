"""Dense row numbers in key order without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.session import broadcast_if_small, stored

_LOCAL = (1 << 33) - 1


def _ranged(df: DataFrame, order: list) -> DataFrame:
    """Rows written in ``order`` with their partition and place in it; as they lie without one."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    written = stored(ordered.withColumn("_mid", F.monotonically_increasing_id()))
    return written.withColumn("_part", F.shiftright("_mid", 33))


def _offsets(ranged: DataFrame, size) -> DataFrame:
    """Total size of all earlier partitions; one row per partition."""
    sizes = ranged.groupBy("_part").agg(size.alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))


def dense_index(df: DataFrame, order: list, name: str = "row_no") -> DataFrame:
    """Add 0-based consecutive numbers in ``order``.

    Rows are range partitioned and sorted, then written once so that the
    partition boundaries are fixed; each partition's offset is the number of
    rows before it. Only one count per partition is ever ranked centrally.
    Without an ``order`` rows are numbered as they lie.
    """
    ranged = _ranged(df, order)
    offsets = _offsets(ranged, F.count("*"))
    numbered = ranged.join(F.broadcast(offsets), "_part")
    index = F.col("_offset") + F.col("_mid").bitwiseAND(_LOCAL)
    return numbered.withColumn(name, index).drop("_part", "_mid", "_offset")


def rank_within(df: DataFrame, groups: list[str], order: list, name: str = "row_no") -> DataFrame:
    """0-based number inside each group; a group may span many partitions."""
    indexed = dense_index(df, [F.col(g) for g in groups] + list(order), "_index")
    starts = indexed.groupBy(*groups).agg(F.min("_index").alias("_start"))
    return (
        indexed.join(broadcast_if_small(starts), groups)
        .withColumn(name, F.col("_index") - F.col("_start"))
        .drop("_index", "_start")
    )


def running_start(df: DataFrame, order: list, size: str, name: str) -> DataFrame:
    """Add the sum of ``size`` over all earlier rows in ``order``.

    Sums run inside each range partition and are shifted by the totals of the
    partitions before it.
    """
    ranged = _ranged(df, order)
    offsets = _offsets(ranged, F.sum(size))
    inside = Window.partitionBy("_part").orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum(size).over(inside), F.lit(0))
    return (
        ranged.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + local)
        .drop("_part", "_mid", "_offset")
    )
