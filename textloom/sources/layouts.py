"""Dataset layouts: how each labelled file format maps to example rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.draws import TWO32, draw_bits, draw_hex
from textloom.operators.labels import guid
from textloom.operators.order import dense_index
from textloom.sources.readers import (
    label_list,
    read_fields,
    read_label_list,
    read_lines,
    read_records,
)


@dataclass(frozen=True)
class Layout:
    """Positions (from 0; negative from the end) inside a tab-separated row."""

    text_a: int
    text_b: int | None = None
    label: int | None = None
    row_id: int | None = None
    constant: str | None = None
    header: bool = True
    recode: tuple[tuple[str, str], ...] = ()
    keep: tuple[int, str] | None = None


@dataclass(frozen=True)
class DatasetSpec:
    labels: tuple[str, ...]
    splits: dict[str, Layout | None]
    reader: Callable[..., DataFrame] | None = None


def _field(position: int) -> Column:
    return F.element_at("fields", position + 1 if position >= 0 else position)


def apply_layout(rows: DataFrame, layout: Layout, set_name: str) -> DataFrame:
    """``(line_no, fields)`` to ``(guid, text_a, text_b, label)``."""
    if layout.keep is not None:
        rows = rows.filter(_field(layout.keep[0]) == layout.keep[1])
    number = F.col("line_no") if layout.row_id is None else _field(layout.row_id)
    label = F.lit(layout.constant) if layout.constant is not None else _field(layout.label)
    for old, new in layout.recode:
        label = F.when(label == old, new).otherwise(label)
    return rows.select(
        guid(set_name, number).alias("guid"),
        _field(layout.text_a).alias("text_a"),
        (F.lit(None).cast("string") if layout.text_b is None else _field(layout.text_b)).alias("text_b"),
        label.alias("label"),
    )


def comma_rows(lines: DataFrame) -> DataFrame:
    """``(line_no, value)`` lines with exactly three comma-separated fields."""
    first_cell = F.element_at(F.split("value", "\t", -1), 1)
    fields = F.split(first_cell, ",", -1)
    return lines.withColumn("fields", fields).filter(F.size("fields") == 3)


def read_comma(
    spark: SparkSession,
    path: str,
    split: str,
    lines: tuple[int, int] | None = None,
    share: tuple[float, float] | None = None,
    header: bool = True,
) -> DataFrame:
    """Comma rows of one split of a file; every line that is asked for is kept.

    All lines by default. ``lines`` keeps the 0-based range ``first`` to
    ``last``, ``share`` the lines whose hashed draw lies in ``[low, high)``, so
    that shares that tile 0 to 1 part the file. Row numbers are line numbers.
    """
    rows = read_lines(spark, path)
    if header:
        rows = rows.filter("line_no > 0")
    if lines is not None:
        rows = rows.filter(F.col("line_no").between(*lines))
    if share is not None:
        draw = draw_bits(draw_hex("12345/comma", F.col("line_no"))) / TWO32
        rows = rows.filter((draw >= share[0]) & (draw < share[1]))
    return comma_rows(rows).select(
        guid(split, F.col("line_no")).alias("guid"),
        F.element_at("fields", 2).alias("text_a"),
        F.lit(None).cast("string").alias("text_b"),
        F.element_at("fields", 3).alias("label"),
    )


def read_record_examples(spark: SparkSession, path: str, split: str) -> DataFrame:
    """JSON records; every record counts, also the first of a test set.

    Numbered from 0 in file order, whatever the splits.
    """
    placed = read_records(spark, path, numbered=True)
    numbered = dense_index(placed, ["file", "element_no"], "row_no")
    return numbered.select(
        guid(split, F.col("row_no")).alias("guid"),
        F.col("inputs").alias("text_a"),
        F.lit(None).cast("string").alias("text_b"),
        "label",
    )


# Column positions and labels of the supported layouts.
SPECS = {
    "cross_lingual": DatasetSpec(
        ("contradiction", "entailment", "neutral"),
        {
            "train": Layout(0, 1, 2, recode=(("contradictory", "contradiction"),)),
            "dev": Layout(6, 7, 1, keep=(0, "zh")),
        },
    ),
    "multi_genre": DatasetSpec(
        ("contradiction", "entailment", "neutral"),
        {
            "train": Layout(8, 9, -1, row_id=0),
            "dev_matched": Layout(8, 9, -1, row_id=0),
            "test": Layout(8, 9, row_id=0, constant="contradiction"),
        },
    ),
    "paraphrase": DatasetSpec(
        ("0", "1"),
        {"train": Layout(3, 4, 0), "dev": Layout(3, 4, 0), "test": Layout(3, 4, constant="0")},
    ),
    "acceptability": DatasetSpec(
        ("0", "1"),
        {
            "train": Layout(3, label=1, header=False),
            "dev": Layout(3, label=1, header=False),
            "test": Layout(1, constant="0"),
        },
    ),
    "comma_questions": DatasetSpec(
        ("0", "1"), {s: None for s in ("train", "dev", "test")}, read_comma
    ),
    "tagged": DatasetSpec((), {s: None for s in ("train", "dev", "test")}, read_record_examples),
    "reviews": DatasetSpec(("0", "1"), {s: None for s in ("train", "dev", "test")}, read_record_examples),
    "tweets": DatasetSpec(("0", "4"), {s: None for s in ("train", "dev", "test")}, read_record_examples),
}


def register(name: str, added: DatasetSpec) -> None:
    """Add a layout of one's own; its name must be new."""
    if name in SPECS:
        raise ValueError(f"dataset layout {name} exists already")
    SPECS[name] = added


def spec(name: str) -> DatasetSpec:
    if name not in SPECS:
        raise ValueError(f"unknown dataset layout: {name}")
    return SPECS[name]


def read_examples(spark: SparkSession, name: str, split: str, path: str, **options) -> DataFrame:
    """Any registered layout to ``(guid, text_a, text_b, label)``; ``options`` go to its reader."""
    chosen = spec(name)
    if split not in chosen.splits:
        raise ValueError(f"layout {name} has no split {split}")
    if chosen.reader is not None:
        return chosen.reader(spark, path, split, **options)
    layout = chosen.splits[split]
    return apply_layout(read_fields(spark, path, header=layout.header), layout, split)


def labels_of(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """Labels of a layout with their numbers; tagged sets name theirs in a file."""
    known = list(spec(name).labels)
    if path is not None:
        return read_label_list(spark, path)
    if not known:
        raise ValueError(f"layout {name} needs a label file")
    return label_list(spark, known)
