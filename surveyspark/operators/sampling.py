"""Seeded sampling and seeded random parameter draws (deterministic under any partitioning)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config


def seeded_sample(df: DataFrame, n: int, seed: int = config.SEED, id_col: str = "id") -> DataFrame:
    """n rows without replacement (all rows when fewer), chosen by a seeded hash of
    the row id: a distributed top-n (TakeOrderedAndProject), no global shuffle."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    return df.orderBy(key, F.col(id_col)).limit(n)


def random_params(spark: SparkSession, n_trials: int, grid: dict | None = None, seed: int = config.SEED) -> DataFrame:
    """``n_trials`` rows, each drawing every parameter with replacement from its list
    (default: the network grid of ``config``)."""
    grid = grid or config.HYPERPARAMETER_GRID
    out = spark.range(n_trials).withColumnRenamed("id", "trial")
    for i, (name, values) in enumerate(grid.items()):
        arr = F.array(*[F.lit(v) for v in values])
        idx = F.pmod(F.xxhash64(F.lit(seed), F.col("trial"), F.lit(i)), F.lit(len(values)))
        out = out.withColumn(name, F.element_at(arr, (idx + 1).cast("int")))
    return out
