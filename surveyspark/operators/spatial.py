"""Spatial blocking: grid cell -> district -> macro-region groups.

Plan shape: one partial (map-side combined) grouping-sets aggregation over
the two key columns gives the cell and district sizes; they are joined back
to the rows on their keys. The count table is bounded by geography (at most
one row per 0.2-degree cell and one per district): adaptive execution
broadcasts it when its bytes allow it, and splits hot cells (metro areas,
``no_coords``) when they do not. A
window ``count() over (partition by cell)`` is avoided on purpose: it would
put every row of a hot cell into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions.spatial import grid_cell, has_coords


def macro_map_df(spark: SparkSession, entries=None) -> DataFrame:
    """District -> macro-region dimension (fixed 12 rows by default)."""
    entries = entries if entries is not None else config.MACRO_REGION_MAP
    return spark.createDataFrame(entries, "district string, macro string")


def assign_grid_cell(df: DataFrame, lat="latitude", lon="longitude",
                     size: float = config.GRID_CELL_SIZE_DEG, out="grid_cell") -> DataFrame:
    return df.withColumn(out, grid_cell(F.col(lat), F.col(lon), size))


def _level_counts(df: DataFrame, macro_map: DataFrame, grid_col: str, district_col: str):
    """Grid-cell sizes and district sizes (with each district's macro-region) from ONE
    narrow pass: grouping sets over the two key columns only, combined map-side.
    The macro map is joined to the district counts (small to small), so the rows
    need a single small table. Null keys are not counted (a null
    region has size 0 and falls through to the macro level)."""
    both = (df.select(grid_col, district_col)
              .groupingSets([[grid_col], [district_col]], grid_col, district_col)
              .agg(F.count(F.lit(1)).alias("_n"), F.grouping_id(grid_col, district_col).alias("_gid")))
    mm = (macro_map.select(F.col("district").alias("_mm_district"), F.col("macro").alias("_mm_macro"))
          .dropDuplicates(["_mm_district"]))
    levels = both.join(mm, (F.col("_gid") == 2) & (F.col(district_col) == F.col("_mm_district")), "left") \
                 .drop("_mm_district")
    gc = levels.where((F.col("_gid") == 1) & F.col(grid_col).isNotNull()) \
               .select(grid_col, F.col("_n").alias("_grid_n"))
    dc = levels.where((F.col("_gid") == 2) & F.col(district_col).isNotNull()) \
               .select(district_col, F.col("_n").alias("_district_n"), "_mm_macro")
    return gc, dc


def hierarchical_group(df: DataFrame, macro_map: DataFrame, grid_col="grid_cell",
                       district_col="region", min_grid: int = config.MIN_GRID_SIZE,
                       min_district: int = config.MIN_DISTRICT_SIZE, out="group") -> DataFrame:
    """Grid cell if it has >= min_grid rows, else district if it has >= min_district
    rows, else the district's macro-region (``Other`` when unmapped)."""
    gc, dc = _level_counts(df, macro_map, grid_col, district_col)
    cols = df.columns
    j = df.join(gc, on=grid_col, how="left").join(dc, on=district_col, how="left")
    grp = (F.when(F.coalesce(F.col("_grid_n"), F.lit(0)) >= min_grid,
                  F.concat(F.lit("grid:"), F.col(grid_col)))
            .when(F.coalesce(F.col("_district_n"), F.lit(0)) >= min_district,
                  F.concat(F.lit("district:"), F.col(district_col)))
            .otherwise(F.concat(F.lit("macro:"), F.coalesce(F.col("_mm_macro"), F.lit("Other")))))
    return j.select(*[F.col(c) for c in cols], grp.alias(out))


def group_with_no_coords(df: DataFrame, macro_map: DataFrame, lat="latitude", lon="longitude",
                         size: float = config.GRID_CELL_SIZE_DEG,
                         min_grid: int = config.MIN_GRID_SIZE,
                         min_district: int = config.MIN_DISTRICT_SIZE) -> DataFrame:
    """Merge-time grouping: rows lacking a coordinate get ``grid_cell='no_coords'``
    and ``group='no_coords:<source>:<region>'``; they still count toward their
    district's size."""
    coords = has_coords(F.col(lat), F.col(lon))
    df = df.drop("grid_cell", "group")  # recomputed, as the merge overwrites them
    with_cell = df.withColumn(
        "grid_cell", F.when(coords, grid_cell(F.col(lat), F.col(lon), size)).otherwise(F.lit("no_coords")))
    grouped = hierarchical_group(with_cell, macro_map, min_grid=min_grid, min_district=min_district)
    nc = F.concat(F.lit("no_coords:"), F.coalesce(F.col("source").cast("string"), F.lit("nan")),
                  F.lit(":"), F.coalesce(F.col("region").cast("string"), F.lit("nan")))
    return grouped.withColumn("group", F.when(coords, F.col("group")).otherwise(nc))


def group_invasive_share(grouped: DataFrame, group_col="group") -> DataFrame:
    """Records, invasive records and invasive share per spatial group."""
    return (grouped.groupBy(group_col)
            .agg(F.count(F.lit(1)).alias("n_records"),
                 F.count_if(F.col("status") == "invasive").alias("n_invasive"))
            .withColumn("invasive_share", F.col("n_invasive") / F.col("n_records")))
