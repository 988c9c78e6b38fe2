"""Registered queries: spatial blocking, merge, dedupe."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.spatial import duck_grid_cell
from ..operators import merge, spatial
from .fixtures import oracle, view
from .registry import query

MIN_GRID = 15
MIN_DISTRICT = 60

# --- shared oracle fragments --------------------------------------------------

_GRID = duck_grid_cell("latitude", "longitude")

_GROUPED_SQL = f"""
cells as (
  select *, case when latitude is not null and longitude is not null and not isnan(latitude) and not isnan(longitude) then {_GRID}
                 else 'no_coords' end as grid_cell
  from {{src}}
),
gc as (select grid_cell, count(*) as n from cells where grid_cell is not null group by grid_cell),
dc as (select region, count(*) as n from cells where region is not null group by region),
grouped as (
  select cells.*,
         case when cells.latitude is null or cells.longitude is null or isnan(cells.latitude) or isnan(cells.longitude)
                then 'no_coords:' || coalesce(cast(cells.source as varchar), 'nan') || ':'
                     || coalesce(cast(cells.region as varchar), 'nan')
              when coalesce(gc.n, 0) >= {MIN_GRID} then 'grid:' || cells.grid_cell
              when coalesce(dc.n, 0) >= {MIN_DISTRICT} then 'district:' || cells.region
              else 'macro:' || coalesce(mm.macro, 'Other') end as "group"
  from cells
  left join gc on cells.grid_cell = gc.grid_cell
  left join dc on cells.region = dc.region
  left join macro_map mm on cells.region = mm.district
)
"""


def grouped_sql(src: str = "occ") -> str:
    """CTE text ``cells, gc, dc, grouped`` continuing a ``with`` clause."""
    return _GROUPED_SQL.replace("{src}", src)


def occ_grouped(spark, sf):
    occ = view(spark, sf, "occ")
    return spatial.group_with_no_coords(occ, view(spark, sf, "macro_map"),
                                        min_grid=MIN_GRID, min_district=MIN_DISTRICT)


# --- F1 / W5 / W6 / J1 / J7 ------------------------------------------------------

@query("grid_cell", oracle(["occ"], f"""
select occ_id, {_GRID} as grid_cell from occ where latitude is not null and longitude is not null and not isnan(latitude) and not isnan(longitude)
"""))
def q_grid_cell(spark, sf):
    return spatial.assign_grid_cell(view(spark, sf, "occ")).where("grid_cell is not null").select("occ_id", "grid_cell")


@query("group_with_no_coords", oracle(["occ", "macro_map"], """
select occ_id, grid_cell, "group" from grouped
""", grouped_sql()))
def q_group_with_no_coords(spark, sf):
    return occ_grouped(spark, sf).select("occ_id", "grid_cell", "group")


@query("group_invasive_share", oracle(["occ", "macro_map"], """
select "group", count(*) as n_records, count(*) filter (where status = 'invasive') as n_invasive,
       (count(*) filter (where status = 'invasive')) / count(*) as invasive_share
from grouped group by "group"
""", grouped_sql()))
def q_group_invasive_share(spark, sf):
    return spatial.group_invasive_share(occ_grouped(spark, sf))


@query("hierarchical_group", oracle(["occ", "macro_map"], f"""
select occ_id, case when g.n >= {MIN_GRID} then 'grid:' || c.grid_cell when d.n >= {MIN_DISTRICT} then 'district:' || c.region
                    else 'macro:' || coalesce(m.macro, 'Other') end as "group"
from c left join g using (grid_cell) left join d using (region) left join macro_map m on c.region = m.district
""", f"""
c as (select occ_id, region, case when latitude is not null and longitude is not null and not isnan(latitude)
             and not isnan(longitude) then {_GRID} end as grid_cell from occ),
g as (select grid_cell, count(*) as n from c where grid_cell is not null group by 1),
d as (select region, count(*) as n from c where region is not null group by 1)
"""))
def q_hierarchical_group(spark, sf):
    """Grid cell, else district, else macro-region (W5 with J1 and J7), rows without coordinates included."""
    g = spatial.hierarchical_group(spatial.assign_grid_cell(view(spark, sf, "occ")), view(spark, sf, "macro_map"),
                                   min_grid=MIN_GRID, min_district=MIN_DISTRICT)
    return g.select("occ_id", "group")


# --- F13 / W1 / W2 / S6 merge ------------------------------------------------------

ROOT = "C:/data"

_MERGE_CTES = """
norm as (
  select src_ord, row_ord, occ_id,
         case when starts_with(replace(filepath, chr(92), '/'), 'C:/data/')
              then substr(replace(filepath, chr(92), '/'), 9)
              else replace(filepath, chr(92), '/') end as filepath,
         label, region, source, latitude, longitude, gbif_id, status
  from occ_parts
),
w1 as (
  select * exclude (rn) from (
    select *, row_number() over (partition by filepath order by src_ord, row_ord) as rn from norm)
  where rn = 1
),
w2 as (
  select * exclude (rn) from (
    select *, case when source is null or gbif_id is null then 1
                   else row_number() over (partition by source, gbif_id order by src_ord, row_ord) end as rn
    from w1)
  where rn = 1
)
"""


def _norm(spark, sf):
    return merge.normalize_paths(view(spark, sf, "occ_parts"), ROOT)


@query("normalize_path", oracle(["occ_parts"], """
select src_ord, occ_id, filepath from norm
""", _MERGE_CTES))
def q_normalize_path(spark, sf):
    return _norm(spark, sf).select("src_ord", "occ_id", "filepath")


@query("dedupe_filepath", oracle(["occ_parts"], """
select src_ord, row_ord, occ_id, filepath, label, source, gbif_id from w1
""", _MERGE_CTES))
def q_dedupe_filepath(spark, sf):
    return (merge.dedupe_filepath(_norm(spark, sf))
            .select("src_ord", "row_ord", "occ_id", "filepath", "label", "source", "gbif_id"))


@query("dedupe_source_key", oracle(["occ_parts"], """
select src_ord, row_ord, occ_id, filepath, label, source, gbif_id from w2
""", _MERGE_CTES))
def q_dedupe_source_key(spark, sf):
    return (merge.deduplicate(_norm(spark, sf))
            .select("src_ord", "row_ord", "occ_id", "filepath", "label", "source", "gbif_id"))


@query("merge_manifests", oracle(["occ_parts", "macro_map"], """
select src_ord, occ_id, filepath, label, region, grid_cell, "group" from grouped
""", _MERGE_CTES + "," + grouped_sql("w2")))
def q_merge_manifests(spark, sf):
    merged = merge.merge_manifests(view(spark, sf, "occ_parts"), view(spark, sf, "macro_map"), ROOT,
                                   min_grid=MIN_GRID, min_district=MIN_DISTRICT)
    return merged.select("src_ord", "occ_id", "filepath", "label", "region", "grid_cell", "group")
