"""Risk map aggregates over an occurrence manifest (one shuffle each)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def risk_by_region(df: DataFrame, top: int = 10) -> DataFrame:
    """Invasive records per region with risk score = invasive / all records of
    the region; regions with no invasive record are left out; top ``top``."""
    agg = (df.where(F.col("region").isNotNull())
             .groupBy("region")
             .agg(F.count_if(F.col("status") == "invasive").alias("n_invasive"),
                  F.count(F.lit(1)).alias("n_records")))
    return (agg.where(F.col("n_invasive") > 0)
               .withColumn("risk_score", F.col("n_invasive") / F.col("n_records"))
               .orderBy(F.col("n_invasive").desc(), F.col("region").asc()).limit(top))


def risk_by_species(df: DataFrame) -> DataFrame:
    return (df.where((F.col("status") == "invasive") & F.col("label").isNotNull())
              .groupBy("label").agg(F.count(F.lit(1)).alias("n_invasive")))
