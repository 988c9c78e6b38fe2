"""Merge source manifests and remove duplicates with a defined survivor.

"Keep first" needs an order, and DataFrames have none: every row carries
``src_ord`` (position of its source in merge order) and ``row_ord`` (its
position inside the source). The survivor of a key is the row with the
smallest ``(src_ord, row_ord)``.

Survivors are picked with ``groupBy(key).agg(min(struct(order, row)))``
rather than ``row_number()`` over a window: the aggregation is combined
map-side, so a key holding a third of all rows is reduced to one row per
input partition before the shuffle instead of being sorted inside one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_path

ORDER = ("src_ord", "row_ord")


def keep_first(df: DataFrame, keys: list[str], order=ORDER) -> DataFrame:
    """One row per key: the first by ``order``. Null keys are ordinary keys here."""
    cols = df.columns
    payload = [c for c in cols if c not in keys]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in payload]).alias("_first")
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return agg.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in payload]).select(*cols)


def keep_first_keyed(df: DataFrame, keys: list[str], order=ORDER) -> DataFrame:
    """Keep the first row per key among rows whose key columns are all non-null;
    rows with a null key component all survive.

    Null-key rows are not routed to one hot null group: their grouping key is
    their own (unique) order, so they spread over the shuffle like any other.
    """
    cols = df.columns
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    gkey = F.struct(keyed.alias("k"),
                    *[F.when(keyed, F.col(k)).alias(f"k_{k}") for k in keys],
                    *[F.when(~keyed, F.col(o)).alias(f"u_{o}") for o in order]).alias("_gkey")
    payload = cols
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in payload])
    agg = df.groupBy(gkey).agg(F.min(packed).alias("_first"))
    return agg.select(*[F.col(f"_first.{c}").alias(c) for c in payload])


def normalize_paths(df: DataFrame, root: str | None = None, col="filepath") -> DataFrame:
    return df.withColumn(col, normalize_path(F.col(col), root))


def dedupe_filepath(df: DataFrame, order=ORDER) -> DataFrame:
    """First row per file path (after normalisation)."""
    return keep_first(df, ["filepath"], order)


def dedupe_source_key(df: DataFrame, order=ORDER) -> DataFrame:
    """First row per (source, gbif_id) where both are present."""
    return keep_first_keyed(df, ["source", "gbif_id"], order)


def deduplicate(df: DataFrame, order=ORDER) -> DataFrame:
    """First row per file path, then per (source, gbif_id). Both rules are decided on the narrow key columns;
    the survivors' orders, which are unique, then pick the whole rows."""
    narrow = df.select(*order, "filepath", "source", "gbif_id")
    kept = dedupe_source_key(dedupe_filepath(narrow, order), order).select(*order)
    return df.join(kept, list(order), "left_semi").select(*df.columns)


def union_sources(parts: list[DataFrame]) -> DataFrame:
    """Concatenate source manifests in the given order, tagging ``src_ord``.

    Columns missing from a part become nulls. Parts must already carry a
    ``row_ord``; ``sources.readers.read_manifest`` adds one from the file
    offsets.
    """
    if not parts:
        raise FileNotFoundError("No manifest sources found.")
    tagged = [p.withColumn("src_ord", F.lit(i)) for i, p in enumerate(parts)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def merge_manifests(parts_or_df, macro_map: DataFrame, root: str | None = None,
                    min_grid: int | None = None, min_district: int | None = None) -> DataFrame:
    """Concatenate -> normalise paths -> dedupe -> grid cell -> spatial group."""
    from . import spatial
    from .. import config
    df = union_sources(parts_or_df) if isinstance(parts_or_df, list) else parts_or_df
    df = deduplicate(normalize_paths(df, root))
    return spatial.group_with_no_coords(
        df, macro_map,
        min_grid=config.MIN_GRID_SIZE if min_grid is None else min_grid,
        min_district=config.MIN_DISTRICT_SIZE if min_district is None else min_district)
