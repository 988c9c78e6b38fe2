"""Joins that keep working when a key is hot or null.

Tables derived from the data (counts per cell, group -> fold, species
dimensions) are joined without a hint: adaptive execution broadcasts a side
whose measured bytes are under its limit and splits hot keys otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_spread_nulls(left: DataFrame, right: DataFrame, key: str, buckets: int = 4096) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on ``key`` where ``left`` may hold many null keys.

    A shuffle join hashes every null key to the same partition, so a column that
    is null for a third of the rows makes one task take a third of the data.
    Null keys are replaced by a text that can never match (it starts with a NUL
    character) spread over ``buckets`` values; non-null keys join as text.
    """
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(buckets)).cast("string")
    lk = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("\u0000null:"), salt))
    l2 = left.withColumn("_jk", lk)
    r2 = right.withColumn("_jk", F.col(key).cast("string")).drop(key)
    return l2.join(r2, "_jk", "left").drop("_jk")


def prefix_lengths(names: DataFrame, col: str) -> list[int]:
    """The distinct lengths of the names: at most as many as the longest name has characters."""
    return sorted(r[0] for r in names.where(F.length(col) > 0).select(F.length(col)).distinct().collect())


def join_by_prefix(df: DataFrame, names: DataFrame, col: str, name_col: str) -> DataFrame:
    """Each row of ``df`` with every row of ``names`` whose ``name_col`` starts ``col``.

    An equi-join: a row is repeated once per distinct name length that fits it,
    with its prefix of that length as the key.
    """
    sizes = F.array(*[F.lit(n) for n in prefix_lengths(names, name_col)]).cast("array<int>")
    at = df.withColumn("_n", F.explode(F.filter(sizes, lambda n: n <= F.length(col))))
    key = F.substring(F.col(col), F.lit(1), F.col("_n"))
    return at.withColumn("_key", key).join(names, F.col("_key") == F.col(name_col)).drop("_n", "_key")
