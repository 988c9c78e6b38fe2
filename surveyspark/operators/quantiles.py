"""Exact quantiles in a fixed number of passes.

The linearly interpolated quantile ``q`` of a group needs the values at ranks
``floor(q (n - 1))`` and the next one. A mergeable sketch (Spark's approximate
percentiles, of rank error n / ``ACCURACY``) brackets both ranks; a second
sketch, of the values inside the bracket alone, narrows it; the last pass counts
what lies below and adds up the distinct values inside, where running counts
give the two values. So a group of n rows leaves about n / 50,000 distinct values
for one task to order, a value repeated in a third of all rows is one of them,
and groups up to ``SMALL`` rows skip the sketches' brackets and are ordered as
they are. The passes are one lazy plan, without a loop and without the driver.

A sketch only guides: the ranks are counted, and a bracket that missed one would
be an error, never a wrong value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000
SMALL = 100_000
#: Points of the second sketch over its bracket.
POINTS = 200


def exact_quantile(df: DataFrame, value_col: str, q: float, keys=(), small: int = SMALL) -> DataFrame:
    """``(keys..., n, quantile)`` with numpy's default (linear) interpolation; NaN and null values are ignored and
    groups without other values are left out; infinities are values. Null keys are a group."""
    keys = list(keys)
    names = [f"_k{i}" for i in range(len(keys))]
    vals = (df.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)], F.col(value_col).cast("double").alias("v"))
              .where(F.col("v").isNotNull() & ~F.isnan("v")))
    vals = vals.withColumn("v", F.col("v") + F.lit(0.0))  # one zero
    names, vals = (names, vals) if names else (["_k0"], vals.withColumn("_k0", F.lit(0)))

    def beside(rows: DataFrame, of: DataFrame) -> DataFrame:
        """``rows`` with their group's columns of ``of`` (one row a group)."""
        of = of.select(*[F.col(n).alias(f"{n}_") for n in names], *[c for c in of.columns if c not in names])
        same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"{n}_")) for n in names])
        return rows.join(of, same).drop(*[f"{n}_" for n in names])

    room = 3.0 / ACCURACY
    ends = F.percentile_approx("v", [max(0.0, q - room), min(1.0, q + room)], ACCURACY)
    n = F.count(F.lit(1))
    first = vals.groupBy(*names).agg(n.alias("n"), F.when(n > small, ends[0]).otherwise(F.min("v")).alias("lo"), F.when(n > small, ends[1]).otherwise(F.max("v")).alias("hi"))
    first = first.withColumn("r0", F.floor(F.lit(q) * (F.col("n") - 1)))

    inside = (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi"))
    points = F.percentile_approx(F.when(inside, F.col("v")), [i / POINTS for i in range(POINTS + 1)], ACCURACY)
    held = F.count_if(inside)
    second = beside(vals, first).groupBy(*names).agg(
        F.first("n").alias("n"), F.first("r0").alias("r0"), F.first("lo").alias("lo"), F.first("hi").alias("hi"),
        F.count_if(F.col("v") < F.col("lo")).alias("below"), held.alias("held"), points.alias("points"))
    share = (F.col("r0") - F.col("below")) / F.col("held") * POINTS
    at = lambda i: F.get("points", F.greatest(F.lit(0), F.least(F.lit(POINTS), i.cast("int"))))
    narrow = F.col("held") > small
    second = second.select(*names, "n", "r0", F.when(narrow, at(F.floor(share) - 2)).otherwise(F.col("lo")).alias("lo"),
                           F.when(narrow, at(F.ceil(share) + 2)).otherwise(F.col("hi")).alias("hi"))

    rows = beside(vals, second).where(F.col("v") <= F.col("hi"))
    rows = rows.groupBy(*names, F.when(inside, F.col("v")).alias("v")).agg(n.alias("c"), F.first("n").alias("n"), F.first("r0").alias("r0"))
    upto = F.sum("c").over(Window.partitionBy(*names).orderBy(F.col("v").asc_nulls_first()))  # those below come first
    rows = rows.withColumn("upto", upto).where("v is not null")

    def value(rank):
        return F.max(F.when((F.col("upto") > rank) & (F.col("upto") - F.col("c") <= rank), F.col("v")))

    out = rows.groupBy(*names).agg(F.first("n").alias("n"), value(F.col("r0")).alias("v0"), value(F.least(F.col("r0") + 1, F.col("n") - 1)).alias("v1"),
                                   (F.lit(q) * (F.first("n") - 1) - F.first("r0")).alias("part"))
    sure = F.when(F.col("v0").isNull() | F.col("v1").isNull(), F.raise_error(F.lit("A quantile's rank lies outside its bracket."))).otherwise(F.col("v0"))
    exact = F.when((F.col("v0") == F.col("v1")) | (F.col("part") == 0), sure).otherwise(sure + F.col("part") * (F.col("v1") - F.col("v0")))
    return out.select(*[F.col(nm).alias(k) for nm, k in zip(names, keys)], "n", exact.alias("quantile"))
