"""Registered queries: ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config
from ..functions import text
from ..functions.spatial import coarse_group
from ..operators import ingest, riskmap
from .fixtures import oracle, view
from .registry import query

TARGETS = sorted({n for a, b, _ in config.SPECIES_PAIRS for n in (a, b)})
INVASIVE = [a for a, _, _ in config.SPECIES_PAIRS]
IMAGE_EXTS = config.IMAGE_EXTENSIONS


def _sql_list(xs):
    return "(" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + ")"


def dwc(spark, sf):
    return view(spark, sf, "occ_dwc")


@query("map_columns", oracle(["names"], """
select scientific_name as label, dataset_key as image_url, rec_id as gbif_id from names
"""))
def q_map_columns(spark, sf):
    return ingest.map_columns(view(spark, sf, "names"),
                              {"label": "scientific_name", "image_url": "dataset_key", "gbif_id": "rec_id"})


@query("occurrence_to_manifest", oracle(["occ_dwc"], f"""
select 'gbif://' || coalesce(gbifID, '') as filepath, trim(scientificName) as label, 'gbif' as source,
       coalesce(stateProvince, 'unknown') as region, decimalLatitude as latitude, decimalLongitude as longitude,
       coalesce(stateProvince, 'unknown') || '_' || cast(coalesce(cast(trunc(case when isnan(decimalLatitude) then null else decimalLatitude end) as integer), 0) as varchar)
         as "group",
       case when trim(scientificName) in {_sql_list(INVASIVE)} then 'invasive' else 'native' end as status
from occ_dwc where trim(scientificName) <> ''
"""))
def q_occurrence_to_manifest(spark, sf):
    return ingest.occurrence_to_manifest(dwc(spark, sf))


@query("filter_equals", oracle(["occ_dwc"], "select gbifID from occ_dwc where phylum = 'Tracheophyta'"))
def q_filter_equals(spark, sf):
    return ingest.filter_equals(dwc(spark, sf), "phylum", "Tracheophyta").select("gbifID")


@query("filter_species_ci", oracle(["occ_dwc"], f"""
select gbifID, scientificName from occ_dwc where lower(scientificName) in {_sql_list([t.lower() for t in TARGETS])}
"""))
def q_filter_species_ci(spark, sf):
    return ingest.filter_species_ci(dwc(spark, sf), TARGETS).select("gbifID", "scientificName")


@query("filter_species_exact", oracle(["occ_dwc"], f"""
select gbifID, scientificName from occ_dwc where scientificName in {_sql_list(TARGETS)}
"""))
def q_filter_species_exact(spark, sf):
    return ingest.filter_species_exact(dwc(spark, sf), TARGETS, "scientificName").select("gbifID", "scientificName")


@query("filter_species_prefix", oracle(["occ_dwc"], f"""
select gbifID, scientificName from occ_dwc
where {" or ".join(f"starts_with(scientificName, '{t}')" for t in TARGETS)}
"""))
def q_filter_species_prefix(spark, sf):
    return ingest.filter_species_prefix(dwc(spark, sf), TARGETS).select("gbifID", "scientificName")


@query("filter_conjunction", oracle(["occ_dwc"], """
select gbifID from occ_dwc
where datasetKey = 'ds-invasoras' and countryCode = 'PT' and kingdom = 'Plantae' and mediaType = 'StillImage'
"""))
def q_filter_conjunction(spark, sf):
    return ingest.filter_conjunction(dwc(spark, sf), datasetKey="ds-invasoras", countryCode="PT",
                                     kingdom="Plantae", mediaType="StillImage").select("gbifID")


@query("filter_complete", oracle(["occ_dwc"], """
select gbifID from occ_dwc
where associatedMedia is not null and decimalLatitude is not null and not isnan(decimalLatitude) and decimalLongitude is not null
"""))
def q_filter_complete(spark, sf):
    return ingest.filter_complete(dwc(spark, sf), ["associatedMedia", "decimalLatitude",
                                                  "decimalLongitude"]).select("gbifID")


@query("filter_blank", oracle(["occ_dwc"], "select gbifID from occ_dwc where trim(scientificName) <> ''"))
def q_filter_blank(spark, sf):
    return ingest.filter_blank(dwc(spark, sf), "scientificName").select("gbifID")


@query("filter_extension", oracle(["media", "urls"], f"""
select path from (select identifier as path from media union all select url from urls)
where lower(regexp_extract(path, '[^/]+(\\.[^./]+)$', 1)) in {_sql_list(IMAGE_EXTS)}
"""))
def q_filter_extension(spark, sf):
    paths = (view(spark, sf, "media").select(F.col("identifier").alias("path"))
             .unionByName(view(spark, sf, "urls").select(F.col("url").alias("path"))))
    return ingest.filter_extension(paths, "path")


@query("derive_status", oracle(["names"], """
select rec_id, case when scientific_name in ('small ring', 'red widget') then 'invasive' else 'native' end as status
from names
"""))
def q_derive_status(spark, sf):
    return view(spark, sf, "names").select(
        "rec_id", ingest.derive_status(F.col("scientific_name"), ["small ring", "red widget"]).alias("status"))


@query("region_fallback", oracle(["occ_dwc"], """
select gbifID, coalesce(nullif(trim(stateProvince), ''), nullif(trim(county), ''), 'Unknown') as region from occ_dwc
"""))
def q_region_fallback(spark, sf):
    return ingest.with_region(dwc(spark, sf), "stateProvince", "county").select("gbifID", "region")


@query("coarse_group", oracle(["occ_dwc"], """
select gbifID, coalesce(stateProvince, 'unknown') || '_'
       || cast(coalesce(cast(trunc(case when isnan(decimalLatitude) then null else decimalLatitude end) as integer), 0) as varchar) as "group"
from occ_dwc
"""))
def q_coarse_group(spark, sf):
    return dwc(spark, sf).select("gbifID", coarse_group(F.col("stateProvince"), F.col("decimalLatitude")).alias("group"))


_RAW_EXT = """coalesce(nullif(regexp_extract(regexp_extract({u}, '([^/]+)/?$', 1), '.(\\.[^.]+)$', 1), ''), '.jpg')"""


@query("media_filename", oracle(["occ_dwc"], f"""
select coalesce(gbifID, key) as record_id,
       coalesce(gbifID, key) || {_RAW_EXT.format(u='associatedMedia')} as filename
from occ_dwc where associatedMedia is not null
"""))
def q_media_filename(spark, sf):
    d = dwc(spark, sf).where(F.col("associatedMedia").isNotNull())
    return ingest.media_filename(d).select("record_id", "filename")


_URL_EXT = """coalesce(nullif(regexp_extract(regexp_extract(regexp_extract({u}, '^[a-z]+://[^/?#]*([^?#]*)', 1),
              '([^/]+)/?$', 1), '.(\\.[^.]+)$', 1), ''), '.jpg')"""


@query("url_extension", oracle(["urls"], f"select page_id, {_URL_EXT.format(u='url')} as ext from urls"))
def q_url_extension(spark, sf):
    return view(spark, sf, "urls").select("page_id", text.url_extension(F.col("url")).alias("ext"))


@query("url_hash_name", oracle(["urls"], f"""
select page_id, substr(md5(trim(url)), 1, 16) || {_URL_EXT.format(u='trim(url)')} as filename from urls
"""))
def q_url_hash_name(spark, sf):
    return view(spark, sf, "urls").select("page_id", text.url_hash_name(F.col("url")).alias("filename"))


@query("species_dirname", oracle(["names"], """
select rec_id, replace(scientific_name, ' ', '_') as dirname,
       replace(replace(scientific_name, ' ', '_'), '_', ' ') as species from names
"""))
def q_species_dirname(spark, sf):
    n = view(spark, sf, "names").select("rec_id", text.species_dirname(F.col("scientific_name")).alias("dirname"))
    return n.withColumn("species", text.species_from_dirname(F.col("dirname")))


@query("first_media", oracle(["media_nested"], """
select gbif_id, list_filter(media, lambda m: m.type = 'StillImage' and m.identifier is not null
                                             and m.identifier <> '')[1].identifier as image_url
from media_nested
"""))
def q_first_media(spark, sf):
    return ingest.first_media(view(spark, sf, "media_nested")).select("gbif_id", "image_url")


@query("media_join", oracle(["occ", "media"], """
select o.occ_id, o.gbif_id, f.image_url from occ o left join (
  select gbif_id, arg_min(identifier, media_ord) as image_url from media
  where media_type = 'StillImage' and identifier is not null and identifier <> '' group by gbif_id) f
  on o.gbif_id = f.gbif_id
"""))
def q_media_join(spark, sf):
    return ingest.media_join(view(spark, sf, "occ"), view(spark, sf, "media")).select("occ_id", "gbif_id",
                                                                                   "image_url")


_SPECIES_VALUES = "(values " + ", ".join(f"('{t}')" for t in TARGETS) + ") sp(species)"


@query("prefix_join", oracle(["occ_dwc"], f"""
select gbifID, species from occ_dwc join {_SPECIES_VALUES} on starts_with(scientificName, species)
"""))
def q_prefix_join(spark, sf):
    return ingest.prefix_join(dwc(spark, sf), ingest.species_table(spark, TARGETS)).select("gbifID", "species")


_ALIAS_VALUES = "(values " + ", ".join(
    f"('{sci}', '{a}')" for sci, names in config.SPECIES_ALIASES for a in names) + ") al(sci, alias)"


@query("alias_lookup", oracle(["occ_dwc"], f"""
select gbifID, coalesce(al.sci, vernacularName) as resolved_name
from occ_dwc left join {_ALIAS_VALUES} on lower(trim(vernacularName)) = lower(trim(al.alias))
"""))
def q_alias_lookup(spark, sf):
    return ingest.alias_lookup(dwc(spark, sf), ingest.aliases_table(spark), "vernacularName").select(
        "gbifID", "resolved_name")


@query("union_occurrences", oracle(["occ_dwc"], f"""
select 'gbif://' || coalesce(gbifID, '') as filepath, trim(scientificName) as label, 'gbif' as source
from occ_dwc where trim(scientificName) <> ''
union all
select 'invasoras://' || coalesce(occurrenceID, ''), trim(scientificName), 'invasoras'
from occ_dwc where trim(scientificName) <> '' and datasetKey = 'ds-invasoras'
"""))
def q_union_occurrences(spark, sf):
    d = dwc(spark, sf)
    g = ingest.occurrence_to_manifest(d)
    i = ingest.occurrence_to_manifest(d.where(F.col("datasetKey") == "ds-invasoras"), source="invasoras",
                                      scheme="invasoras", id_col="occurrenceID")
    return ingest.union_occurrences([g, i]).select("filepath", "label", "source")


@query("target_species", oracle(["invasive_species"], """
select species from (select invasive as species from invasive_species union select native from invasive_species)
where species is not null
"""))
def q_target_species(spark, sf):
    return ingest.target_species(view(spark, sf, "invasive_species"))


def _species_rows(spark, sf):
    return ingest.prefix_join(dwc(spark, sf), ingest.species_table(spark, TARGETS))


@query("cap_per_species", oracle(["occ_dwc"], f"""
select gbifID, species from (
  select gbifID, species, row_number() over (partition by species order by row_ord) as rn
  from occ_dwc join {_SPECIES_VALUES} on starts_with(scientificName, species))
where rn <= 50
"""))
def q_cap_per_species(spark, sf):
    return ingest.cap_per_species(_species_rows(spark, sf), 50).select("gbifID", "species")


@query("balanced_sample", oracle(["occ_dwc"], f"""
select gbifID, species, datasetKey, stream_rank, sample_rank from (
  select *, cast(row_number() over (partition by species order by stream_rank, datasetKey) as integer)
              as sample_rank from (
    select gbifID, species, datasetKey,
           cast(row_number() over (partition by species, datasetKey order by md5('42:' || gbifID), gbifID)
                as integer) as stream_rank
    from occ_dwc join {_SPECIES_VALUES} on starts_with(scientificName, species))
  where stream_rank <= 40)
where sample_rank <= 40
"""))
def q_balanced_sample(spark, sf):
    return ingest.balanced_sample(_species_rows(spark, sf), 40).select(
        "gbifID", "species", "datasetKey", "stream_rank", "sample_rank")


@query("param_grid", oracle(["occ_dwc"], """
select species, country, datasetKey from
  (select distinct trim(scientificName) as species from occ_dwc where trim(scientificName) <> ''),
  (values ('PT')) c(country), (values ('ds-invasoras'), ('ds-other')) d(datasetKey)
"""))
def q_param_grid(spark, sf):
    sp = dwc(spark, sf).select(F.trim("scientificName").alias("species")).where(F.col("species") != "").distinct()
    return ingest.param_product(sp, country=["PT"], datasetKey=["ds-invasoras", "ds-other"])


@query("feasibility_counts", oracle(["occ_dwc"], f"""
select sp.species, coalesce(sum(c.total), 0)::bigint as total_records,
       coalesce(sum(c.with_image), 0)::bigint as records_with_image,
       coalesce(sum(c.with_coords), 0)::bigint as records_with_coordinates, 'any' as dataset_key
from {_SPECIES_VALUES}
left join (select scientificName, count(*) as total,
                  count(*) filter (where mediaType = 'StillImage') as with_image,
                  count(*) filter (where decimalLatitude is not null and not isnan(decimalLatitude) and decimalLongitude is not null) as with_coords
           from occ_dwc where countryCode = 'PT' group by 1) c on starts_with(c.scientificName, sp.species)
group by sp.species
"""))
def q_feasibility_counts(spark, sf):
    return ingest.feasibility_counts(dwc(spark, sf), ingest.species_table(spark, TARGETS))


@query("risk_by_region", oracle(["occ"], """
select region, count(*) filter (where status = 'invasive') as n_invasive, count(*) as n_records,
       (count(*) filter (where status = 'invasive')) / count(*) as risk_score
from occ where region is not null group by region having count(*) filter (where status = 'invasive') > 0
order by n_invasive desc, region limit 10
"""))
def q_risk_by_region(spark, sf):
    return riskmap.risk_by_region(view(spark, sf, "occ"))


@query("risk_by_species", oracle(["occ"], """
select label, count(*) as n_invasive from occ where status = 'invasive' and label is not null group by label
"""))
def q_risk_by_species(spark, sf):
    return riskmap.risk_by_species(view(spark, sf, "occ"))


# --- end-to-end: occurrence dumps -> manifest rows -> risk map --------------------------

def _dump_manifest(spark, sf):
    d = ingest.filter_species_ci(ingest.filter_equals(dwc(spark, sf), "phylum", "Tracheophyta"), TARGETS)
    g = ingest.occurrence_to_manifest(d)
    i = ingest.occurrence_to_manifest(d.where(F.col("datasetKey") == "ds-invasoras"), source="invasoras",
                                      scheme="invasoras", id_col="occurrenceID")
    return ingest.union_occurrences([g, i])


_DUMP_CTES = f"""
dm as (
  select trim(scientificName) as label, coalesce(stateProvince, 'unknown') as region,
         case when trim(scientificName) in {_sql_list(INVASIVE)} then 'invasive' else 'native' end as status
  from occ_dwc
  where phylum = 'Tracheophyta' and lower(scientificName) in {_sql_list([t.lower() for t in TARGETS])}
    and trim(scientificName) <> ''
  union all
  select trim(scientificName), coalesce(stateProvince, 'unknown'),
         case when trim(scientificName) in {_sql_list(INVASIVE)} then 'invasive' else 'native' end
  from occ_dwc
  where phylum = 'Tracheophyta' and lower(scientificName) in {_sql_list([t.lower() for t in TARGETS])}
    and trim(scientificName) <> '' and datasetKey = 'ds-invasoras'
)
"""


@query("riskmap_from_dumps", oracle(["occ_dwc"], """
select region, count(*) filter (where status = 'invasive') as n_invasive, count(*) as n_records,
       (count(*) filter (where status = 'invasive')) / count(*) as risk_score
from dm where region is not null group by region having count(*) filter (where status = 'invasive') > 0
order by n_invasive desc, region limit 10
""", _DUMP_CTES))
def q_riskmap_from_dumps(spark, sf):
    return riskmap.risk_by_region(_dump_manifest(spark, sf))
