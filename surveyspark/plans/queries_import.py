"""Registered queries: the composed importers and their way into the merge."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import importers, ingest, merge
from ..session import scratch_path
from ..sources.csv_records import read_csv
from ..sources.sinks import write_table
from .fixtures import oracle, view
from .queries_ingest import _SPECIES_VALUES, _URL_EXT, TARGETS, dwc
from .registry import query

_XY = """case when isnan(decimalLatitude) then null else decimalLatitude end as latitude,
       case when isnan(decimalLongitude) then null else decimalLongitude end as longitude"""
_OUT = "filepath, label, region, latitude, longitude, source, gbif_id"

_IMPORT_CTES = f"""
dw as (
  select *, row_number() over (partition by species order by row_ord) as rn
  from occ_dwc join {_SPECIES_VALUES} on starts_with(scientificName, species) where associatedMedia is not null),
dwca as (
  select 'photos/' || replace(species, ' ', '_') || '/' || substr(md5(trim(associatedMedia)), 1, 16)
           || {_URL_EXT.format(u='trim(associatedMedia)')} as filepath, species as label,
         coalesce(nullif(trim(stateProvince), ''), nullif(trim(county), ''), 'Unknown') as region, {_XY},
         'archive' as source, cast(gbifID as bigint) as gbif_id, row_ord from dw where rn <= 50),
mp as (
  select *, row_number() over (partition by species order by row_ord) as rn
  from image_mapping where species in (select species from {_SPECIES_VALUES})),
mapped as (
  select 'photos/' || replace(species, ' ', '_') || '/' || regexp_extract(
           coalesce(nullif(trim(filename), ''), substr(md5(trim(url)), 1, 16) || '.jpg'), '([^/]+)/?$', 1) as filepath,
         species as label, 'Unknown' as region, cast(null as double) as latitude, cast(null as double) as longitude,
         'mapping' as source, cast(gbif_id as bigint) as gbif_id, row_ord from mp where rn <= 40),
oc as (
  select *, row_number() over (partition by species order by row_ord) as rn
  from occ_dwc join {_SPECIES_VALUES} on starts_with(scientificName, species)
  where datasetKey = 'ds-invasoras' and countryCode = 'PT' and kingdom = 'Plantae' and mediaType = 'StillImage'),
fm as (
  select gbif_id as mid, arg_min(identifier, media_ord) as image_url from media
  where media_type = 'StillImage' and identifier is not null and identifier <> '' group by gbif_id),
occs as (
  select 'photos/export/' || replace(species, ' ', '_') || '/' || gbifID || {_URL_EXT.format(u='image_url')} as filepath,
         species as label, coalesce(nullif(trim(stateProvince), ''), 'Unknown') as region, {_XY},
         'export' as source, cast(gbifID as bigint) as gbif_id, row_ord
  from oc join fm on cast(gbifID as bigint) = mid where rn <= 60)
"""
_FIX = ["occ_dwc", "media", "image_mapping"]


def _species(spark):
    return ingest.species_table(spark, TARGETS)


def _parts(spark, sf):
    return [importers.import_dwca(dwc(spark, sf), _species(spark), "photos", "archive", 50, id_col="gbifID"),
            importers.import_mapping(view(spark, sf, "image_mapping"), _species(spark), "photos", "mapping", 40),
            importers.import_occurrences(dwc(spark, sf), view(spark, sf, "media"), _species(spark), "photos", "export",
                                         "ds-invasoras", cap=60)]


_COLS = _OUT.split(", ")


@query("import_dwca", oracle(_FIX, f"select {_OUT} from dwca", _IMPORT_CTES))
def q_import_dwca(spark, sf):
    return _parts(spark, sf)[0].select(*_COLS)


@query("import_mapping", oracle(_FIX, f"select {_OUT} from mapped", _IMPORT_CTES))
def q_import_mapping(spark, sf):
    return _parts(spark, sf)[1].select(*_COLS)


@query("import_occurrences", oracle(_FIX, f"select {_OUT} from occs", _IMPORT_CTES))
def q_import_occurrences(spark, sf):
    return _parts(spark, sf)[2].select(*_COLS)


@query("import_merged", oracle(_FIX, f"""
select {_OUT}, src_ord from (
  select *, case when gbif_id is null then 1
                 else row_number() over (partition by source, gbif_id order by src_ord, row_ord) end as k from (
    select *, row_number() over (partition by filepath order by src_ord, row_ord) as f from (
      select 0 as src_ord, * from dwca union all select 1, * from mapped union all select 2, * from occs))
  where f = 1)
where k = 1
""", _IMPORT_CTES))
def q_import_merged(spark, sf):
    """All three imports merged: from dumps to the deduplicated manifest that the folds are dealt on."""
    rows = merge.deduplicate(merge.normalize_paths(merge.union_sources(_parts(spark, sf))))
    return rows.select(*_COLS, F.col("src_ord").cast("int").alias("src_ord"))


@query("csv_records", """
select cast(doc_id as varchar) as doc_id, lang, md5(text) as text_md5, length(text) as n_chars from documents
""")
def q_csv_records(spark, sf):
    """Whole texts, with their quotes and line breaks, through CSV files and back."""
    path = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    write_table(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text"), path, fmt="csv")
    return read_csv(spark, path).select("doc_id", "lang", F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("n_chars"))
