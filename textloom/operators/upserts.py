"""Keyed updates resolved from a change log.

Writers only append; readers fold the log with map-side combined aggregates,
so a key holding a large share of the changes is reduced before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import url_key


def _latest(columns: list[str], order: list[str]):
    """Newest row of each group by ``order``."""
    return F.max_by(F.struct(*columns), F.struct(*order))


def replace_records(inferences: DataFrame, tie: str = "seq") -> DataFrame:
    """Last write wins per md5(url): the whole record is replaced.

    Input ``(url, payload, recommendation, ts, <tie>)``. ``<tie>`` is kept, so
    that later changes can tell what came after the record.
    """
    columns = ["url", "payload", "recommendation", "ts", tie]
    newest = inferences.groupBy(url_key(F.col("url")).alias("_id")).agg(
        _latest(columns, ["ts", tie]).alias("r")
    )
    return newest.select("_id", "r.*")


def apply_feedback(records: DataFrame, feedback: DataFrame, tie: str = "seq") -> DataFrame:
    """Set ``golden_standard``, ``ts`` and ``<tie>`` on existing records; never inserts.

    Feedback is applied only where it is newer than the record by
    ``(ts, <tie>)``: a record that was replaced after it has lost it.
    """
    newest = feedback.groupBy(url_key(F.col("url")).alias("_id")).agg(
        _latest(["golden_standard", "ts", tie], ["ts", tie]).alias("f")
    )
    joined = records.join(newest, "_id", "left")
    kept = [c for c in records.columns if c not in ("ts", tie, "golden_standard")]
    old = F.col("golden_standard") if "golden_standard" in records.columns else F.lit(None)
    later = F.struct("f.ts", f"f.{tie}") > F.struct("ts", tie)
    newer = F.col("f").isNotNull() & later
    return joined.select(
        *kept,
        F.when(newer, F.col("f.golden_standard")).otherwise(old.cast("string")).alias("golden_standard"),
        F.when(newer, F.col("f.ts")).otherwise(F.col("ts")).alias("ts"),
        F.when(newer, F.col(f"f.{tie}")).otherwise(F.col(tie)).alias(tie),
    )


def current_records(log: DataFrame, tie: str = "seq") -> DataFrame:
    """Replay a mixed log in order.

    Rows have ``kind`` ('infer' or 'feedback'). An inference replaces the
    record, which drops earlier feedback; feedback before any inference is
    ignored.
    """
    infer = F.when(
        F.col("kind") == "infer",
        F.struct("ts", tie, "url", "payload", "recommendation"),
    )
    feedback = F.when(F.col("kind") == "feedback", F.struct("ts", tie, "golden_standard"))
    folded = log.groupBy(url_key(F.col("url")).alias("_id")).agg(
        F.max(infer).alias("i"), F.max(feedback).alias("f")
    )
    later = F.struct("f.ts", f"f.{tie}") > F.struct("i.ts", f"i.{tie}")
    return folded.filter("i is not null").select(
        "_id",
        "i.url",
        "i.payload",
        "i.recommendation",
        F.when(later, F.col("f.golden_standard")).alias("golden_standard"),
        F.when(later, F.col("f.ts")).otherwise(F.col("i.ts")).alias("ts"),
    )
