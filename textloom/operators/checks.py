"""Row constraints as counted violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``(rule, bad)``: how many rows break each rule; a rule is true where a row breaks it."""
    names = list(rules)
    counts = rows.agg(*[F.count(F.when(rules[n], 1)).alias(n) for n in names])
    return counts.unpivot([], names, "rule", "bad")


def question_rules(qa: str = "qa", negatives: bool = False) -> dict[str, Column]:
    """One answer to each question that has one, and a question that says something."""
    wrong = F.coalesce(F.size(F.col(f"{qa}.answers")), F.lit(0)) != 1
    if negatives:
        wrong = wrong & ~F.coalesce(F.col(f"{qa}.is_impossible"), F.lit(False))
    return {"answers": wrong, "empty_question": F.coalesce(F.col(f"{qa}.question"), F.lit("")) == ""}


def width_rules(widths: dict[str, int]) -> dict[str, Column]:
    """Arrays of exactly the stated lengths."""
    return {f"{c}_width": F.coalesce(F.size(c), F.lit(-1)) != n for c, n in widths.items()}


def side_rules(*sides: str) -> dict[str, Column]:
    """Token sides that hold something."""
    return {f"empty_{c}": F.coalesce(F.size(c), F.lit(0)) == 0 for c in sides}
