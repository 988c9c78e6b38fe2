"""Importers: from occurrence dumps and mapping files to manifest rows, in one flow each.

Every importer filters the dump, pairs records with the species list, keeps the
first ``cap`` records of each species (all without one), finds the image URL
and names the file it will be stored as. The rows have the columns of a source
manifest and a ``row_ord``, so they go into the merge as they are; downloading
is the work log's part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.spatial import present
from ..functions.text import (last_path_segment, normalize_id, region_fallback, species_dirname, url_extension,
                              url_hash_name)
from . import ingest


def _stored_as(folder: str, species: Column, name: Column) -> Column:
    return F.concat_ws("/", F.lit(folder.rstrip("/")), species_dirname(species), name)


def _capped(df: DataFrame, cap: int | None) -> DataFrame:
    return df if cap is None else ingest.cap_per_species(df, cap)


def import_dwca(occ: DataFrame, species: DataFrame, folder: str, source: str, cap: int | None = None,
                id_col: str = "id") -> DataFrame:
    """Darwin Core archive records with media: ``associatedMedia`` is the image."""
    rows = _capped(ingest.prefix_join(occ.where(F.col("associatedMedia").isNotNull()), species), cap)
    url = F.trim("associatedMedia")
    return rows.select(
        _stored_as(folder, F.col("species"), url_hash_name(url)).alias("filepath"), F.col("species").alias("label"),
        region_fallback(F.col("stateProvince"), F.col("county")).alias("region"),
        present(F.col("decimalLatitude")).alias("latitude"), present(F.col("decimalLongitude")).alias("longitude"),
        F.lit(source).alias("source"), normalize_id(F.col(id_col)).alias("gbif_id"), url.alias("url"), "row_ord")


def import_mapping(mapping: DataFrame, species: DataFrame, folder: str, source: str, cap: int | None = None) -> DataFrame:
    """Mapping file rows (``species``, ``url``, ``filename``, ``gbif_id``) of exactly the listed species; a row
    without a file name gets one from its URL."""
    rows = _capped(mapping.join(species.select("species").distinct(), "species", "left_semi"), cap)
    url = F.trim("url")
    name = last_path_segment(F.coalesce(F.nullif(F.trim("filename"), F.lit("")), url_hash_name(url, F.lit(".jpg"))))
    return rows.select(
        _stored_as(folder, F.col("species"), name).alias("filepath"), F.col("species").alias("label"),
        F.lit("Unknown").alias("region"), F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"), F.lit(source).alias("source"),
        normalize_id(F.col("gbif_id")).alias("gbif_id"), url.alias("url"), "row_ord")


def import_occurrences(occ: DataFrame, media: DataFrame, species: DataFrame, folder: str, source: str, dataset_key: str,
                       country: str = "PT", kingdom: str = "Plantae", cap: int | None = None) -> DataFrame:
    """Occurrence export: one dataset, country and kingdom, still images; the image is the first still image of
    the record's media, and records without one are left out after the cap, as a download would."""
    kept = ingest.filter_conjunction(occ, datasetKey=dataset_key, countryCode=country, kingdom=kingdom, mediaType="StillImage")
    rows = _capped(ingest.prefix_join(kept, species), cap).withColumn("_id", normalize_id(F.col("gbifID")))
    with_url = ingest.media_join(rows, media, "_id").where(F.col("image_url").isNotNull())
    name = F.concat(F.col("_id").cast("string"), url_extension(F.col("image_url")))
    return with_url.select(
        _stored_as(f"{folder.rstrip('/')}/{source}", F.col("species"), name).alias("filepath"), F.col("species").alias("label"),
        region_fallback(F.col("stateProvince")).alias("region"),
        present(F.col("decimalLatitude")).alias("latitude"), present(F.col("decimalLongitude")).alias("longitude"),
        F.lit(source).alias("source"), F.col("_id").alias("gbif_id"), F.col("image_url").alias("url"), "row_ord")
