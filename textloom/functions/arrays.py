"""Array expressions: sequence assembly, ranking inside arrays, scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(body, *values: Column) -> Column:
    """Evaluate each value once per row and hand them to ``body``.

    A lambda body runs per element, and the optimiser inlines earlier
    projections into it, so row-level values used inside one are bound first.
    """
    bound = F.struct(*[v.alias(f"v{i}") for i, v in enumerate(values)])
    return F.get(
        F.transform(F.array(bound), lambda s: body(*[s[f"v{i}"] for i in range(len(values))])),
        F.lit(0),
    )


def pair_lengths(len_a: Column, len_b: Column, limit) -> tuple[Column, Column]:
    """Lengths left after popping the longer side (ties pop B) down to ``limit``."""
    limit = limit if isinstance(limit, Column) else F.lit(limit)
    half = F.floor(limit / 2).cast("int")
    keep_a = F.least(len_a, F.greatest(limit - len_b, limit - half))
    keep_b = F.least(len_b, F.greatest(limit - len_a, half))
    return keep_a.cast("int"), keep_b.cast("int")


def head(values: Column, n) -> Column:
    return F.slice(values, F.lit(1), n if isinstance(n, Column) else F.lit(n))


def pad(values: Column, width: int, filler: Column) -> Column:
    """Append ``filler`` up to ``width``; longer input is a data error."""
    size = F.size(values)
    checked = F.when(
        size > width, F.raise_error(F.concat(F.lit("sequence longer than "), F.lit(str(width))))
    ).otherwise(F.array_repeat(filler, F.lit(width) - size))
    return F.concat(values, checked)


def bracketed(a: Column, b: Column, cls: Column, sep: Column) -> Column:
    """[CLS] a [SEP], followed by b [SEP] when b has elements."""
    first = F.concat(F.array(cls), a, F.array(sep))
    return F.when(F.size(b) > 0, F.concat(first, b, F.array(sep))).otherwise(first)


def segment_marks(a: Column, b: Column) -> Column:
    zeros = F.array_repeat(F.lit(0), F.size(a) + 2)
    ones = F.array_repeat(F.lit(1), F.size(b) + 1)
    return F.when(F.size(b) > 0, F.concat(zeros, ones)).otherwise(zeros)


def best_indexes(scores: Column, n: int) -> Column:
    """0-based indexes of the ``n`` highest scores; equal scores keep the lower index."""

    def pick(values: Column, least: Column) -> Column:
        # Plain doubles sort fast; only positions that can be listed are ranked.
        near = F.filter(
            F.transform(values, lambda v, i: i),
            lambda i: F.coalesce(F.get(values, i) >= least, F.lit(True)),
        )
        ranked = F.array_sort(
            F.transform(near, lambda i: F.struct((-F.get(values, i)).alias("neg"), i.alias("pos")))
        )
        return F.transform(F.slice(ranked, 1, n), lambda s: s["pos"])

    nth = F.get(F.sort_array(scores, asc=False), F.lit(n - 1))
    return let(pick, scores, nth)


def argmax(scores: Column) -> Column:
    """0-based index of the first maximum."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def softmax(scores: Column) -> Column:
    """Shifted by the maximum; an empty array stays empty."""

    def shares(exps: Column) -> Column:
        total = F.aggregate(exps, F.lit(0.0), lambda acc, v: acc + v)
        return let(lambda e, t: F.transform(e, lambda v: v / t), exps, total)

    exps = let(
        lambda s, top: F.transform(s, lambda v: F.exp(v - top)), scores, F.array_max(scores)
    )
    return let(shares, exps)


def log_sum_exp(scores: Column) -> Column:
    return let(
        lambda s, top: top
        + F.ln(F.aggregate(s, F.lit(0.0), lambda acc, v: acc + F.exp(v - top))),
        scores,
        F.array_max(scores).cast("double"),
    )


def log_softmax(scores: Column) -> Column:
    return let(
        lambda s, norm: F.transform(s, lambda v: v - norm), scores, log_sum_exp(scores)
    )


def cross_entropy(scores: Column, label: Column) -> Column:
    return log_sum_exp(scores) - F.element_at(scores, label + 1)


def gather(values: Column, positions: Column) -> Column:
    return let(lambda v, ps: F.transform(ps, lambda p: F.element_at(v, p + 1)), values, positions)


def rounded(values: Column, digits: int = 6) -> Column:
    return F.transform(values, lambda v: F.round(v, digits))


def pick_layers(layers: Column, indexes: list[int]) -> Column:
    """Select layers by signed index (-1 is the last one)."""
    return F.array(*[F.element_at(layers, i + 1 if i >= 0 else i) for i in indexes])


def as_int32(values: Column) -> Column:
    return F.transform(values, lambda v: v.cast("int"))


def text_of(values: Column) -> Column:
    """Space-joined rendering of an array (for reports and comparisons)."""
    # Cast as a whole: a lambda is interpreted for each element.
    return F.array_join(values.cast("array<string>"), " ")
