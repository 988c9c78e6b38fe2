"""Synthetic occurrence generator: per species n rows, a weighted district
choice, uniform jitter around the district centre, 5-decimal coordinates.

Randomness comes from seeded hashes of (seed, row id, stream), not ``rand()``,
so every row is the same whatever the partitioning or retry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config


def _uniform(seed: int, stream: int) -> F.Column:
    h = F.xxhash64(F.lit(seed), F.col("id"), F.lit(stream))
    return F.pmod(h, F.lit(1 << 53)).cast("double") / float(1 << 53)


def synthetic_occurrences(spark: SparkSession, per_species: int = 30, seed: int = config.SEED,
                          species=None, districts=None, weights=None, root: str = "data_raw/synthetic",
                          n_partitions: int | None = None) -> DataFrame:
    species = species or [n for a, b, _ in config.SPECIES_PAIRS for n in (a, b) if n]
    districts = districts or config.SYNTHETIC_DISTRICTS
    weights = weights or config.SYNTHETIC_DISTRICT_WEIGHTS
    cum, acc = [], 0.0
    for w in weights:
        acc += w
        cum.append(acc)
    n = per_species * len(species)
    base = spark.range(0, n, numPartitions=n_partitions) if n_partitions else spark.range(0, n)
    sp = F.array(*[F.lit(s) for s in species])
    u = _uniform(seed, 0) * F.lit(acc)
    # district index = number of cumulative weights below u (fixed short list)
    d_idx = sum((u >= F.lit(c)).cast("int") for c in cum[:-1])
    lat0 = F.array(*[F.lit(d[1]) for d in districts])
    lon0 = F.array(*[F.lit(d[2]) for d in districts])
    jit = F.array(*[F.lit(d[3]) for d in districts])
    name = F.array(*[F.lit(d[0]) for d in districts])
    df = (base.withColumn("species_idx", (F.col("id") / per_species).cast("int"))
              .withColumn("i", (F.col("id") % per_species).cast("int"))
              .withColumn("d", d_idx + 1))
    j = F.element_at(jit, F.col("d"))
    label = F.element_at(sp, F.col("species_idx") + 1)
    dirname = F.replace(label, F.lit(" "), F.lit("_"))
    return df.select(
        F.concat_ws("/", F.lit(root), dirname,
                    F.concat(dirname, F.lit("_"), F.format_string("%04d", F.col("i")), F.lit(".jpg"))
                    ).alias("filepath"),
        label.alias("label"), F.element_at(name, F.col("d")).alias("region"),
        F.round(F.element_at(lat0, F.col("d")) + (_uniform(seed, 1) * 2 - 1) * j, 5).alias("latitude"),
        F.round(F.element_at(lon0, F.col("d")) + (_uniform(seed, 2) * 2 - 1) * j, 5).alias("longitude"),
        F.lit("synthetic").alias("source"))
