"""Array expressions for scoring classifier outputs (all narrow, no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def softmax(logits: Column) -> Column:
    """Max-shifted softmax of an ``array<double>``.

    Written so every per-row quantity is an argument, not an outer reference
    inside a lambda: higher-order functions re-evaluate outer expressions for
    each element, which would make the max and the sum quadratic (or worse) in
    the array length. The max is spread with ``array_repeat`` into ``zip_with``,
    and the sum reaches the division through ``aggregate``'s finish function.
    """
    shifted = F.zip_with(logits, F.array_repeat(F.array_max(logits), F.size(logits)),
                         lambda x, m: F.exp(x - m))
    return F.aggregate(shifted, F.lit(0.0), lambda acc, x: acc + x,
                       lambda total: F.transform(shifted, lambda x: x / total))


def argmax(probs: Column) -> Column:
    """0-based index of the largest value (first one on ties)."""
    return (F.array_position(probs, F.array_max(probs)) - 1).cast("int")


def top_k(probs: Column, k: int = 3) -> Column:
    """``array<struct<idx int, p double>>`` of the k largest, higher first, lower index on ties."""
    ranked = F.array_sort(F.transform(probs, lambda p, i: F.struct((-p).alias("neg_p"), i.alias("idx"))))
    return F.transform(F.slice(ranked, 1, k),
                       lambda s: F.struct(s["idx"].cast("int").alias("idx"), (-s["neg_p"]).alias("p")))


def valid_logits(logits: Column) -> Column:
    """Non-null, non-empty, no null/NaN/infinite element."""
    bad = F.exists(logits, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return logits.isNotNull() & (F.size(logits) > 0) & ~bad
