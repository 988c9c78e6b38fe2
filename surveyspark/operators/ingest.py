"""Occurrence ingest: filters, projections, lookups and per-species sampling.

Filters are plain predicates so Catalyst pushes them into the Parquet/CSV
scan. Species lists are short fixed lists, so membership tests are inlined
literals and the prefix theta-join broadcasts the list (a nested-loop join
against a handful of rows, never against data). Per-species caps use
``row_number() <= n``, which Spark turns into a per-partition group limit
before the shuffle, so a hot species ships at most n rows per input split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.spatial import coarse_group, has_coords
from ..functions.text import first_media_identifier, raw_url_extension, region_fallback
from .joins import join_by_prefix, left_join_spread_nulls


# Parts that a hot species is split into before its first rows are picked
SALTS = 64


def map_columns(df: DataFrame, mapping: dict) -> DataFrame:
    """Rename source columns to canonical names: ``{canonical: source}``; absent sources are skipped."""
    return df.select(*[F.col(src).alias(dst) for dst, src in mapping.items() if src in df.columns])


def filter_equals(df: DataFrame, col: str, value) -> DataFrame:
    """``col = value``; a no-op when the column is absent (e.g. phylum)."""
    return df.where(F.col(col) == value) if col in df.columns else df


def filter_species_ci(df: DataFrame, species, col: str = "scientificName") -> DataFrame:
    return df.where(F.lower(F.col(col)).isin([s.lower() for s in species]))


def filter_species_exact(df: DataFrame, species, col: str = "species") -> DataFrame:
    return df.where(F.col(col).isin(list(species)))


def starts_with_any(col: Column, prefixes) -> Column:
    """An OR of prefix tests, which reaches the scan as pushed filters."""
    return reduce(lambda a, b: a | b, [col.startswith(p) for p in prefixes], F.lit(False))


def filter_species_prefix(df: DataFrame, species, col: str = "scientificName") -> DataFrame:
    return df.where(F.coalesce(starts_with_any(F.col(col).cast("string"), species), F.lit(False)))


def filter_conjunction(df: DataFrame, **equals) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [F.col(c) == v for c, v in equals.items()]))


def filter_complete(df: DataFrame, cols) -> DataFrame:
    return df.na.drop(subset=list(cols))


def filter_blank(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.trim(F.col(col)) != "")


def path_extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"[^/]+(\.[^./]+)$", 1))


def filter_extension(df: DataFrame, col: str = "path", exts=config.IMAGE_EXTENSIONS) -> DataFrame:
    return df.where(path_extension(F.col(col)).isin([e.lower() for e in exts]))


def derive_status(name: Column, invasive) -> Column:
    """``invasive`` iff the name is exactly (case-sensitive) an invasive species."""
    return F.when(name.isin(list(invasive)), F.lit("invasive")).otherwise(F.lit("native"))


def invasive_names(pairs=None):
    return [a for a, _, _ in (pairs or config.SPECIES_PAIRS)]


def occurrence_to_manifest(df: DataFrame, source: str = "gbif", scheme: str = "gbif",
                           id_col: str = "gbifID", invasive=None) -> DataFrame:
    """Occurrence rows -> manifest rows with a virtual ``<scheme>://<id>`` path;
    blank names dropped; group ``<region>_<int(lat)>``."""
    invasive = invasive if invasive is not None else invasive_names()
    name = F.trim(F.col("scientificName"))
    region = F.coalesce(F.col("stateProvince"), F.lit("unknown"))
    return (df.where(name.isNotNull() & (name != ""))
              .select(F.concat(F.lit(f"{scheme}://"), F.coalesce(F.col(id_col), F.lit(""))).alias("filepath"),
                      name.alias("label"), F.lit(source).alias("source"), region.alias("region"),
                      F.col("decimalLatitude").alias("latitude"), F.col("decimalLongitude").alias("longitude"),
                      coarse_group(F.col("stateProvince"), F.col("decimalLatitude")).alias("group"),
                      derive_status(name, invasive).alias("status")))


def media_filename(df: DataFrame, url_col: str = "associatedMedia") -> DataFrame:
    """Record id (``gbifID`` falling back to ``key``) plus the raw URL's suffix."""
    rid = F.coalesce(F.col("gbifID"), F.col("key"))
    return df.withColumn("record_id", rid).withColumn(
        "filename", F.concat(rid, raw_url_extension(F.col(url_col))))


def with_region(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumn("region", region_fallback(*[F.col(c) for c in cols]))


def first_media(df: DataFrame, media_col: str = "media") -> DataFrame:
    return df.withColumn("image_url", first_media_identifier(F.col(media_col)))


def media_join(occ: DataFrame, media: DataFrame, id_col: str = "gbif_id") -> DataFrame:
    """Occurrence -> first still-image URL by media order (null when none).

    The media table is reduced to one row per id with a partial ``min_by``
    before the join, so ids with many media never meet the occurrences whole;
    occurrences without an id are spread over the shuffle instead of all
    landing in the null-key partition.
    """
    first = (media.where((F.col("media_type") == "StillImage") & F.col("identifier").isNotNull()
                         & (F.col("identifier") != ""))
                  .groupBy(F.col("gbif_id").alias(id_col))
                  .agg(F.min_by("identifier", "media_ord").alias("image_url")))
    return left_join_spread_nulls(occ, first, id_col)


def species_table(spark: SparkSession, species) -> DataFrame:
    return spark.createDataFrame([(s,) for s in species], "species string")


def prefix_join(df: DataFrame, species: DataFrame, col: str = "scientificName") -> DataFrame:
    """Each record paired with every species its name starts with."""
    return join_by_prefix(df, species, col, "species")


def aliases_table(spark: SparkSession, aliases=None) -> DataFrame:
    aliases = aliases if aliases is not None else config.SPECIES_ALIASES
    return (spark.createDataFrame(aliases, "scientific_name string, aliases array<string>")
                 .select("scientific_name", F.explode("aliases").alias("alias")))


def alias_lookup(df: DataFrame, aliases: DataFrame, col: str) -> DataFrame:
    """Common name -> scientific name (case/space-insensitive); unknown names kept as they are."""
    a = aliases.select(F.lower(F.trim("alias")).alias("_alias"), F.col("scientific_name").alias("_sci"))
    j = df.join(a, F.lower(F.trim(F.col(col))) == F.col("_alias"), "left")
    return j.withColumn("resolved_name", F.coalesce("_sci", F.col(col))).drop("_alias", "_sci")


def union_occurrences(parts) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def target_species(pairs_df: DataFrame) -> DataFrame:
    """Sorted distinct union of invasive and native names."""
    return (pairs_df.select(F.col("invasive").alias("species"))
            .union(pairs_df.select(F.col("native").alias("species")))
            .where(F.col("species").isNotNull()).distinct().orderBy("species"))


def cap_per_species(df: DataFrame, n: int, species_col: str = "species", order_col: str = "row_ord") -> DataFrame:
    """First n rows per species in input order, in two steps: the first n of each (species, salt), then of
    each species, so that a hot species is cut down by many tasks before its rows meet."""
    salt = F.pmod(F.xxhash64(order_col), F.lit(SALTS))
    first = _first_n(df.withColumn("_salt", salt), n, [species_col, "_salt"], [order_col])
    return _first_n(first.drop("_salt"), n, [species_col], [order_col])


def _first_n(df: DataFrame, n: int, keys: list, order: list) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def balanced_sample(df: DataFrame, n: int, seed: int = config.SEED, species_col: str = "species",
                    stream_col: str = "datasetKey", id_col: str = "gbifID") -> DataFrame:
    """About n rows per species, dealt round-robin over its datasets in a seeded
    hash order. A dataset's rows are cut to n by salt first, then ranked, so a
    hot one is reduced by many tasks."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    w1 = Window.partitionBy(species_col, stream_col).orderBy(h, F.col(id_col))
    salted = _first_n(df.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(SALTS))), n,
                      [species_col, stream_col, "_salt"], [h, F.col(id_col)]).drop("_salt")
    first = salted.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= n)
    w2 = Window.partitionBy(species_col).orderBy("_r1", stream_col)
    return (first.withColumn("_r2", F.row_number().over(w2)).where(F.col("_r2") <= n)
                 .withColumnRenamed("_r1", "stream_rank").withColumnRenamed("_r2", "sample_rank"))


def param_product(df: DataFrame, **params) -> DataFrame:
    """Each row once per combination of the parameter lists (generators, no join)."""
    out = df
    for k, vals in params.items():
        out = out.withColumn(k, F.explode(F.array(*[F.lit(v) for v in vals])))
    return out


def feasibility_counts(occ: DataFrame, species: DataFrame, country: str = "PT",
                       dataset_key: str | None = None) -> DataFrame:
    """Per listed species (always present): records, with image, with coordinates.

    Occurrences are first reduced to per-name counts (partial aggregation),
    then matched to the species list by prefix (scientific names carry an
    author suffix).
    """
    f = occ.where(F.col("countryCode") == country)
    if dataset_key:
        f = f.where(F.col("datasetKey") == dataset_key)
    per_name = f.groupBy("scientificName").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("mediaType") == "StillImage").alias("with_image"),
        F.count_if(has_coords(F.col("decimalLatitude"), F.col("decimalLongitude")))
         .alias("with_coords"))
    # then an equi-join back to the list so species without records still appear
    matched = (join_by_prefix(per_name, species.select("species"), "scientificName", "species")
                       .groupBy("species").agg(F.sum("total").alias("total"), F.sum("with_image").alias("with_image"),
                                               F.sum("with_coords").alias("with_coords")))
    return species.select("species").join(matched, "species", "left").select(
        "species",
        F.coalesce(F.col("total"), F.lit(0)).alias("total_records"),
        F.coalesce(F.col("with_image"), F.lit(0)).alias("records_with_image"),
        F.coalesce(F.col("with_coords"), F.lit(0)).alias("records_with_coordinates")
    ).withColumn("dataset_key", F.lit(dataset_key or "any"))
