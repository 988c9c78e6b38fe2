"""Fixture views: the reference's input shapes derived from the driver's tables.

Each view is SQL text that runs on Spark and on DuckDB. Where the two
dialects differ (lambdas, struct literals) a view carries one text per
engine. ``queries()`` builds its inputs from these views and ``oracle_sql()``
prefixes the same texts as CTEs, so both sides read identical inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


@dataclass(frozen=True)
class View:
    sql: str
    deps: tuple = ()
    duck: str | None = None  # DuckDB text when it differs

    def text(self, engine: str) -> str:
        return self.duck if (engine == "duckdb" and self.duck) else self.sql


VIEWS: dict[str, View] = {}


def _view(name, sql, deps=(), duck=None):
    VIEWS[name] = View(sql.strip(), tuple(deps), duck.strip() if duck else None)


# Occurrence manifest rows (the central table)
_view("occ", """
select c_custkey as occ_id,
       concat('img/', c_mktsegment, '/', c_name, '.jpg') as filepath,
       c_mktsegment as label, n_name as region, r_name as source,
       case when c_custkey % 13 = 0 then null when c_custkey % 97 = 1 then cast('NaN' as double)
            when c_custkey % 10 < 6 then 38.5e0 + (c_custkey * 7919 % 700) / 1000e0
            else 37.0e0 + (c_custkey * 7919 % 5000) / 1000e0 end as latitude,
       case when c_custkey % 13 = 0 then null
            when c_custkey % 10 < 6 then -9.5e0 + (c_custkey * 104729 % 700) / 1000e0
            else -9.5e0 + (c_custkey * 104729 % 3000) / 1000e0 end as longitude,
       case when c_custkey % 17 = 0 then null else c_custkey - c_custkey % 3 end as gbif_id,
       case when c_mktsegment in ('BUILDING','MACHINERY','FURNITURE') then 'invasive' else 'native' end as status
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
""")

# District -> macro-region dimension for the fixture (nation -> region)
_view("macro_map", """
select n_name as district, r_name as macro
from nation join region on n_regionkey = r_regionkey
""")

# Two source manifests concatenated: part 0 re-emits every 20th row with a
# Windows-style absolute path and a lower-case label, and comes first in
# merge order, so it is the defined survivor of those duplicates.
_view("occ_parts", """
select 1 as src_ord, occ_id as row_ord, occ_id, filepath, label, region, source,
       latitude, longitude, gbif_id, status
from occ
union all
select 0 as src_ord, occ_id as row_ord, occ_id,
       concat('C:', chr(92), 'data', chr(92), replace(filepath, '/', chr(92))) as filepath,
       lower(label) as label, region, source, latitude, longitude, gbif_id, status
from occ where occ_id % 20 = 0
""", deps=("occ",))

# Paired predictions of two models on the same rows
_view("pred_pairs", """
select c_custkey as row_id,
       cast(c_custkey % 5 as int) as label,
       cast(case when c_custkey % 8 = 0 then (c_custkey + 1) % 5 else c_custkey % 5 end as int) as pred_a,
       cast(case when c_custkey % 9 = 0 then (c_custkey + 2) % 5 else c_custkey % 5 end as int) as pred_b,
       0.3e0 + (c_custkey * 37 % 700) / 1000e0 as conf_a,
       case when c_custkey % 23 = 0 then cast('NaN' as double)
            else 0.3e0 + (c_custkey * 53 % 700) / 1000e0 end as conf_b,
       cast(cast((c_custkey - c_custkey % 7) / 7 as bigint) % 5 as int) as fold
from customer
""")

# Class dimension: index = rank of the label in sorted distinct labels
_view("classes", """
select distinct c_mktsegment as class_name from customer
""")

# Scoring input: 10 logits per row, each the sum of every tenth value of the embedding; null array on every 50th
_view("logits", """
select vec_id as row_id, label,
       case when vec_id % 50 = 0 then cast(null as array<double>)
            else transform(sequence(0, 9), b -> aggregate(filter(embedding, (x, i) -> i % 10 = b), 0e0,
                   (a, x) -> a + cast(x as double)) * 8e0) end as logits
from embeddings
""", duck="""
select vec_id as row_id, label,
       case when vec_id % 50 = 0 then null
            else list_transform(range(0, 10), lambda b: list_sum(list_transform(list_filter(
                   range(0, len(embedding)), lambda i: i % 10 = b), lambda i: cast(embedding[i + 1] as double))) * 8e0)
            end as logits
from embeddings
""")

# Decision input: predictions with class names in mixed case
_view("decisions_in", """
select row_id,
       case pred_a when 0 then 'Automobile' when 1 then 'building' when 2 then 'FURNITURE'
                   when 3 then 'Household' else 'machinery' end as predicted_class,
       conf_a as confidence,
       conf_a < 0.5e0 as abstain
from pred_pairs
""", deps=("pred_pairs",))

# Invasive species dimension (3 of the 5 segments), derived from the data
_view("invasive_species", """
select distinct concat(upper(substr(c_mktsegment, 1, 1)), lower(substr(c_mktsegment, 2))) as invasive,
       case c_mktsegment when 'BUILDING' then 'Automobile' else 'Household' end as native
from customer where c_mktsegment in ('BUILDING', 'MACHINERY', 'FURNITURE')
""")

# Flat media table: several media rows per occurrence id
_view("media", """
select user_id as gbif_id, event_id as media_ord,
       case when event_type in ('view', 'click') then 'StillImage' else 'Sound' end as media_type,
       concat('https://media.example.org/', cast(event_id as string),
              case when event_id % 3 = 0 then '.png' else '.jpg' end) as identifier
from events
""")

# Nested media: each record carries its own array of media structs
_view("media_nested", """
select event_id as gbif_id, cast(user_id as string) as record_key, event_type,
       array(named_struct('type', case when event_type = 'error' then 'StillImage' else 'Sound' end,
                          'identifier', concat('https://a.example.org/', cast(event_id as string), '.wav')),
             named_struct('type', case when event_type in ('view', 'error') then 'StillImage' else 'MovingImage' end,
                          'identifier', concat('https://b.example.org/', cast(event_id as string), '.jpg')),
             named_struct('type', 'StillImage',
                          'identifier', concat('https://c.example.org/', cast(event_id as string), '.png'))) as media
from events
""", duck="""
select event_id as gbif_id, cast(user_id as string) as record_key, event_type,
       [struct_pack(type := case when event_type = 'error' then 'StillImage' else 'Sound' end,
                    identifier := concat('https://a.example.org/', cast(event_id as string), '.wav')),
        struct_pack(type := case when event_type in ('view', 'error') then 'StillImage' else 'MovingImage' end,
                    identifier := concat('https://b.example.org/', cast(event_id as string), '.jpg')),
        struct_pack(type := 'StillImage',
                    identifier := concat('https://c.example.org/', cast(event_id as string), '.png'))] as media
from events
""")

# Download work log: one attempt per event
_view("status_log", """
select concat('https://img.example.org/u/', cast(user_id as string)) as url,
       case when event_type = 'error' then 'failed' else 'success' end as status,
       ts, event_id as attempt_id,
       concat('data_raw/u/', cast(user_id as string), '.jpg') as filepath,
       case when event_type = 'error' then null else md5(props) end as md5,
       case when event_type = 'error' then concat('HTTP ', cast(500 + event_id % 4 as string)) end as error
from events
""")

# Work list: every url we want, with the checksum we expect and the size on disk
_view("work_list", """
select concat('https://img.example.org/u/', cast(user_id as string)) as url,
       case when user_id % 11 = 0 then null else max(md5(props)) end as expected_md5,
       cast(floor(min(value) * 100) as bigint) as bytes_on_disk
from events group by user_id
""")

# Darwin Core shaped occurrence records (scientific names with author suffixes
# and mixed case, blanks, missing media, other countries and datasets)
_view("occ_dwc", """
select cast(occ_id as string) as gbifID, cast(occ_id + 1000000 as string) as key,
       concat('urn:occ:', cast(occ_id as string)) as occurrenceID,
       case when occ_id % 29 = 0 then '  '
            when label = 'AUTOMOBILE' then 'Phragmites australis (Cav.) Trin. ex Steud.'
            when label = 'BUILDING' then 'Arundo donax L.'
            when label = 'FURNITURE' then 'acacia dealbata'
            when label = 'HOUSEHOLD' then 'Ammophila arenaria'
            else 'Cortaderia selloana' end as scientificName,
       case when occ_id % 31 = 0 then 'Bryophyta' else 'Tracheophyta' end as phylum,
       'Plantae' as kingdom,
       case when occ_id % 19 = 0 then 'ES' else 'PT' end as countryCode,
       case when occ_id % 2 = 0 then 'ds-invasoras' else 'ds-other' end as datasetKey,
       case when occ_id % 5 = 0 then null else 'StillImage' end as mediaType,
       case when occ_id % 5 = 0 then null
            else concat('https://media.example.org/o/', cast(occ_id as string),
                        case occ_id % 4 when 0 then '.png' when 1 then '.jpeg?size=large'
                                        when 2 then '' else '.jpg' end) end as associatedMedia,
       case when occ_id % 7 = 0 then '' when occ_id % 11 = 0 then null else region end as stateProvince,
       case when occ_id % 3 = 0 then null else concat(source, ' county') end as county,
       latitude as decimalLatitude, longitude as decimalLongitude,
       case occ_id % 6 when 0 then 'Giant Reed' when 1 then ' pampas grass ' when 2 then 'MIMOSA'
                       when 3 then 'reed' else label end as vernacularName,
       occ_id as row_ord
from occ
""", deps=("occ",))

# Image mapping file rows: names with and without a file name, other species between
_view("image_mapping", """
select event_id as row_ord,
       case event_id % 5 when 0 then 'Arundo donax' when 1 then 'Acacia dealbata' when 2 then 'Cortaderia selloana'
                         when 3 then 'Other species' end as species,
       concat(' https://img.example.org/m/', cast(event_id as string), '.png?x=1 ') as url,
       case when event_id % 3 = 0 then concat('a/b/', cast(event_id as string), '.jpeg') when event_id % 3 = 1 then ' ' end as filename,
       case when event_id % 7 = 0 then null else cast(user_id as string) end as gbif_id
from events
""")

# File listing: the image files present on disk (customers with a
# non-negative balance have theirs downloaded)
_view("file_listing", """
select concat('img/', c_mktsegment, '/', c_name, '.jpg') as path, cast(c_custkey * 97 % 4096 as bigint) as length
from customer where c_acctbal >= 0
""")

# Web URLs with query strings, fragments, .html and none
_view("urls", """
select page_id, url from pages
""")

# Names for prefix / exact / case-insensitive filters
_view("names", """
select p_partkey as rec_id, p_name as scientific_name, p_type as kingdom, p_brand as dataset_key,
       p_size as size
from part
""")

# Feature vectors for Spark ML
_view("features", """
select vec_id as row_id, embedding, label from embeddings
""")


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in VIEWS[n].deps:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_clause(names, engine: str) -> str:
    """``with a as (...), b as (...)`` for the views and their dependencies."""
    parts = [f"{n} as (\n{VIEWS[n].text(engine)}\n)" for n in _closure(names)]
    return "with " + ",\n".join(parts) + "\n" if parts else ""


def oracle(names, body: str, ctes: str | None = None) -> str:
    """DuckDB oracle text: fixture CTEs, then extra ``ctes`` (``a as (...), ...``),
    then ``body``."""
    if isinstance(names, str):
        names = [names]
    head = with_clause(names, "duckdb").rstrip()
    if ctes:
        head = (head + ",\n" if head else "with ") + ctes.strip()
    return head + "\n" + body.strip()


_registered: dict[int, str] = {}


def register_tables(spark: SparkSession, sf_dir: str) -> None:
    """Register the driver's parquet tables as temp views for ``sf_dir``."""
    key = id(spark)
    if _registered.get(key) == sf_dir and spark.catalog.tableExists("customer"):
        return
    for t in BASE_TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    _registered[key] = sf_dir


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view as a lazy DataFrame over ``sf_dir``'s tables."""
    register_tables(spark, sf_dir)
    return spark.sql(with_clause([name], "spark") + f"select * from {name}")
