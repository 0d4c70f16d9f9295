"""Labelled datasets: label explosion, top labels, balancing and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textloom.functions import text as X
from textloom.functions.draws import TWO32, draw_bits, draw_hex, pick
from textloom.operators.order import dense_index, rank_within
from textloom.session import broadcast_if_small

REMAINDER = "other_remainder"


def has_text(df: DataFrame, text: str = "text") -> DataFrame:
    """Drop empty texts; missing texts stay, array texts may not hold ''."""
    if df.schema[text].dataType.typeName() == "array":
        return df.filter(F.col(text).isNull() | ~F.array_contains(text, ""))
    return df.filter(~F.col(text).eqNullSafe(F.lit("")))


def drop_missing(df: DataFrame, tag: str, text: str = "text") -> DataFrame:
    """Rows that have both the tag and a text."""
    return df.dropna(subset=[tag, text])


def keep_labels(df: DataFrame, label: str, listed: list) -> DataFrame:
    """Rows whose label is one of ``listed``."""
    return df.filter(F.col(label).isin(*listed))


def raw_labels(df: DataFrame, tags: list[str], keys: list[str], text: str = "text") -> DataFrame:
    """One row per (tag column, row, label) as it stands, beside the row's text.

    All tag columns are handled in one pass; rows without the tag or without
    text are dropped. An array text is represented by its first element.
    """
    body = F.get(text, F.lit(0)) if df.schema[text].dataType.typeName() == "array" else F.col(text)
    tagged = F.array(*[F.struct(F.lit(t).alias("tag"), F.col(t).alias("labels")) for t in tags])
    return (
        df.filter(F.col(text).isNotNull())
        .select(*keys, body.alias("text"), F.explode(tagged).alias("t"))
        .select(*keys, "text", F.col("t.tag").alias("tag"), F.posexplode("t.labels").alias("label_no", "label"))
        .filter("label is not null")
    )


def explode_labels(df: DataFrame, tags: list[str], keys: list[str], text: str = "text") -> DataFrame:
    """One row per (tag column, row, label) with the label's name: ``keys, tag, label_no, label, text``."""
    return raw_labels(df, tags, keys, text).withColumn("label", X.label_name(F.col("label")))


def label_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("tag", "label").agg(F.count("*").alias("n"))


def top_labels(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` most frequent labels per tag with 0-based ``label_id``.

    Equal counts keep alphabetical order. Only aggregated counts are ranked.
    """
    by_count = Window.partitionBy("tag").orderBy(F.desc("n"), "label")
    ranked = label_counts(rows).withColumn("place", F.row_number().over(by_count))
    # A plain limit on the row number is also applied before the shuffle.
    listed = ranked.filter(F.col("place") <= n)
    return listed.select("tag", "label", "n", (F.col("place") - 1).alias("label_id"))


def label_names(rows: DataFrame) -> DataFrame:
    """Sorted distinct labels per tag."""
    return rows.select("tag", "label").distinct().orderBy("tag", "label")


def smallest_count(top: DataFrame) -> DataFrame:
    return top.groupBy("tag").agg(F.min("n").alias("n"))


def restrict_labels(rows: DataFrame, top: DataFrame, keep_other: bool) -> DataFrame:
    """Rare labels become the remainder label, or their rows are dropped.

    The remainder takes the id after the listed labels.
    """
    table = broadcast_if_small(top.select("tag", "label", "label_id"))
    if not keep_other:
        return rows.join(table, ["tag", "label"])
    sizes = broadcast_if_small(top.groupBy("tag").agg(F.count("*").cast("int").alias("listed")))
    return (
        rows.join(table, ["tag", "label"], "left")
        .join(sizes, "tag", "left")
        .withColumn("label", F.when(F.col("label_id").isNull(), REMAINDER).otherwise(F.col("label")))
        .withColumn("label_id", F.coalesce("label_id", "listed", F.lit(0)))
        .drop("listed")
    )


def selected_labels(rows: DataFrame, top: DataFrame, keep_other: bool) -> DataFrame:
    """The label list that belongs to the ids, remainder included."""
    listed = top.select("tag", "label", "label_id")
    if not keep_other:
        return listed
    all_labels = rows.groupBy("tag").agg(F.countDistinct("label").alias("every"))
    extra = (
        top.groupBy("tag").agg(F.count("*").cast("int").alias("label_id"))
        .join(all_labels, "tag")
        .filter(F.col("every") > F.col("label_id"))
        .select("tag", F.lit(REMAINDER).alias("label"), "label_id")
    )
    return listed.unionByName(extra)


def positional_split(
    rows: DataFrame, groups: list[str], order: list[str], train_share: float
) -> DataFrame:
    """First round(share * n) rows of each group train, the others test."""
    ranked = rank_within(rows, groups, order, "_rank")
    sizes = broadcast_if_small(ranked.groupBy(*groups).agg(F.count("*").alias("_n")))
    limit = F.bround(F.col("_n") * F.lit(train_share))
    return (
        ranked.join(sizes, groups)
        .withColumn("split", F.when(F.col("_rank") < limit, "train").otherwise("test"))
        .drop("_rank", "_n")
    )


def hashed_split(rows: DataFrame, keys: list[str], train_share: float, seed: str = "12345") -> DataFrame:
    """Split by a hash of the row key: no ranking, no shuffle, stable under growth."""
    draw = draw_bits(draw_hex(seed + "/split", *keys))
    return rows.withColumn(
        "split", F.when(draw < int(train_share * TWO32), "train").otherwise("test")
    )


def shuffled(rows: DataFrame, keys: list[str], seed: str = "12345", name: str = "place") -> DataFrame:
    """Rows numbered in hashed order (range partitioned, no central sort)."""
    return dense_index(rows, [draw_hex(seed + "/shuffle", *keys), *keys], name)


def hash_ranked(rows: DataFrame, label: str, keys: list[str], seed: str) -> DataFrame:
    """0-based ``rank`` of each row inside its label, in hashed order."""
    keyed = rows.withColumn("_h", draw_hex(seed + "/balance", *keys))
    return rank_within(keyed, [label], [F.col("_h"), *keys], "rank").drop("_h")


def balance_down(
    rows: DataFrame, label: str, keys: list[str], seed: str = "12345"
) -> DataFrame:
    """Without replacement, down to the size of the smallest label."""
    ranked = hash_ranked(rows, label, keys, seed)
    smallest = ranked.groupBy(label).agg(F.count("*").alias("n")).agg(F.min("n")).first()[0] or 0
    return ranked.filter(F.col("rank") < smallest).drop("rank")


#: Draws made from one row.
_BLOCK = 10_000


def balance_to(
    rows: DataFrame, label: str, keys: list[str], size: int, seed: str = "12345"
) -> DataFrame:
    """With replacement, exactly ``size`` rows per label; adds ``draw_no``.

    Draw numbers are made in blocks that are dealt out before they are
    expanded, and meet the rows by equality on (label, rank), so neither a
    large label nor a large ``size`` is gathered in one task.
    """
    ranked = hash_ranked(rows, label, keys, seed)
    sizes = ranked.groupBy(label).agg(F.count("*").alias("n"))
    blocks = sizes.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit((size - 1) // _BLOCK))))
    if size > _BLOCK:
        blocks = blocks.repartition(label, "_block")
    first = F.col("_block") * _BLOCK
    last = F.least(first + _BLOCK, F.lit(size)) - 1
    picks = blocks.withColumn("draw_no", F.explode(F.sequence(first, last)))
    digest = draw_hex(seed + "/replace", F.col(label), F.col("draw_no"))
    wanted = picks.select(label, "draw_no", pick(digest, F.col("n")).alias("rank"))
    return ranked.join(wanted, [label, "rank"]).drop("rank")


def row_range(rows: DataFrame, order: list[str], first: int, last: int) -> DataFrame:
    """Rows first..last (inclusive, 0-based positions in ``order``)."""
    return dense_index(rows, order, "row_no").filter(F.col("row_no").between(first, last))


def prefix(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows in ``order``; any number of them, spread over the tasks."""
    return dense_index(rows, order, "_row_no").filter(F.col("_row_no") < n).drop("_row_no")


def batches(rows: DataFrame, order: list[str], size: int, drop_last: bool = False) -> DataFrame:
    """Consecutive batches of ``size`` rows; the short last one is optional."""
    numbered = dense_index(rows, order, "row_no").withColumn(
        "batch_no", F.floor(F.col("row_no") / size)
    )
    if not drop_last:
        return numbered
    top = numbered.agg(F.max("row_no")).first()[0]
    full = 0 if top is None else (top + 1) // size
    return numbered.filter(F.col("batch_no") < full)


def guid(prefix: str, number) -> object:
    return F.concat_ws("-", F.lit(prefix), number.cast("string"))
