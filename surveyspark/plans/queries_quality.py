"""Registered queries: audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merge, quality, resolve, spatial
from ..session import materialize
from .fixtures import oracle, view
from .queries_core import _MERGE_CTES, MIN_DISTRICT, MIN_GRID, ROOT, grouped_sql
from .registry import query

# Audited table: the concatenated, path-normalised, spatially grouped manifest
# (not deduplicated, so the duplicate rules fire).
_AUDIT_CTES = _MERGE_CTES + "," + grouped_sql("norm")
_MERGED_CTES = _MERGE_CTES + "," + grouped_sql("w2")
_FIX = ["occ_parts", "macro_map"]


def normalized(spark, sf):
    """All rows with canonical paths: enough for duplicate counts."""
    return merge.normalize_paths(view(spark, sf, "occ_parts"), ROOT)


def deduplicated(spark, sf):
    """The merged rows before spatial grouping: enough wherever the group is not asked for."""
    return merge.deduplicate(normalized(spark, sf))


def audited(spark, sf):
    """Written once: the audit reads it in several passes."""
    return materialize(spatial.group_with_no_coords(normalized(spark, sf), view(spark, sf, "macro_map"),
                                                    min_grid=MIN_GRID, min_district=MIN_DISTRICT), "audited")


def merged(spark, sf):
    """The merged manifest, lazy."""
    return merge.merge_manifests(view(spark, sf, "occ_parts"), view(spark, sf, "macro_map"), ROOT,
                                 min_grid=MIN_GRID, min_district=MIN_DISTRICT)


def merged_table(spark, sf):
    """The merged manifest written once, for the fold join, whose histogram and rows both read it. Rows are
    deduplicated and written before grouping, so the merge runs once."""
    rows = materialize(deduplicated(spark, sf), "deduplicated")
    return spatial.group_with_no_coords(rows, view(spark, sf, "macro_map"), min_grid=MIN_GRID, min_district=MIN_DISTRICT)


@query("value_counts", oracle(_FIX, """
select coalesce(cast(gbif_id as varchar), 'nan') as value, count(*) as n from grouped group by 1
""", _MERGED_CTES))
def q_value_counts(spark, sf):
    return quality.value_counts(deduplicated(spark, sf), "gbif_id", keep_null=True)


@query("value_counts_nonnull", oracle(_FIX, """
select cast(gbif_id as varchar) as value, count(*) as n from grouped where gbif_id is not null group by 1
""", _MERGED_CTES))
def q_value_counts_nonnull(spark, sf):
    return quality.value_counts(deduplicated(spark, sf), "gbif_id", keep_null=False)


@query("distinct_counts", oracle(_FIX, """
select count(distinct label) as n_label, count(distinct source) as n_source,
       count(distinct "group") as n_group, count(distinct gbif_id) as n_gbif_id from grouped
""", _MERGED_CTES))
def q_distinct_counts(spark, sf):
    return quality.distinct_counts(merged(spark, sf), ["label", "source", "group", "gbif_id"])


@query("duplicate_counts", oracle(_FIX, """
select (select coalesce(sum(n - 1), 0) from (select filepath, count(*) as n from grouped group by filepath))::bigint
         as duplicate_filepaths,
       (select coalesce(sum(n - 1), 0) from (select source, gbif_id, count(*) as n from grouped
          where source is not null and gbif_id is not null group by 1, 2))::bigint as duplicate_source_gbif
""", _AUDIT_CTES))
def q_duplicate_counts(spark, sf):
    return quality.duplicate_counts(normalized(spark, sf))


@query("coordinate_coverage", oracle(_FIX, """
select count(*) filter (where not no_xy) as rows_with_coordinates,
       count(*) filter (where no_xy) as rows_without_coordinates,
       coalesce((count(*) filter (where no_xy)) / count(*), 0e0)
         as rows_without_coordinates_ratio
from (select latitude is null or longitude is null or isnan(latitude) or isnan(longitude) as no_xy from grouped)
""", _MERGED_CTES))
def q_coordinate_coverage(spark, sf):
    return quality.coordinate_coverage(deduplicated(spark, sf))


@query("group_balance", oracle(_FIX, """
select (select max(n) from (select "group", count(*) as n from grouped group by 1))
         / (select count(*) from grouped) as largest_group_share,
       (select min(n) from (select label, count(*) as n from grouped group by 1)) as smallest_class_count
""", _MERGED_CTES))
def q_group_balance(spark, sf):
    return quality.group_balance(merged(spark, sf))


@query("top_groups", oracle(_FIX, """
select "group", count(*) as n from grouped group by 1 order by n desc, "group" limit 10
""", _MERGED_CTES))
def q_top_groups(spark, sf):
    return quality.top_groups(merged(spark, sf))


@query("missing_files", oracle(_FIX + ["file_listing"], """
select occ_id, src_ord, filepath from grouped
where filepath not in (select path from file_listing)
""", _MERGED_CTES))
def q_missing_files(spark, sf):
    return (quality.missing_files(deduplicated(spark, sf), view(spark, sf, "file_listing"))
            .select("occ_id", "src_ord", "filepath"))


#: Half of the files lie beside the manifest, the others under the root.
_PLACES = "(select case when length % 2 = 0 then '/srv/manifests/' else '/srv/project/' end || path as path from file_listing)"


@query("resolved_paths", oracle(_FIX + ["file_listing"], f"""
select f.filepath, coalesce(a.path, b.path, '/srv/project/' || f.filepath) as resolved, coalesce(a.path, b.path) is not null as exists
from (select distinct filepath from grouped where filepath is not null) f
left join (select distinct path from {_PLACES}) a on a.path = '/srv/manifests/' || f.filepath
left join (select distinct path from {_PLACES}) b on b.path = '/srv/project/' || f.filepath
""", _MERGED_CTES))
def q_resolved_paths(spark, sf):
    there = view(spark, sf, "file_listing").select(
        F.concat(F.when(F.col("length") % 2 == 0, F.lit("/srv/manifests/")).otherwise(F.lit("/srv/project/")), "path").alias("path"))
    return resolve.resolved_paths(deduplicated(spark, sf), there, "/srv/project", "/srv/manifests").where("filepath is not null")


_REPORT_CTES = _AUDIT_CTES + """,
a as (
  select g.*, (g.latitude is not null and g.longitude is not null and not isnan(g.latitude) and not isnan(g.longitude)) as has_coords,
         l.path is not null as present
  from grouped g left join (select distinct path from file_listing) l on g.filepath = l.path
),
s as (
  select count(*) as n_rows, count(distinct label) as n_classes, count(distinct source) as n_sources,
         count(distinct "group") as n_groups,
         count(*) filter (where not present) as missing_files,
         count(*) filter (where has_coords) as rows_with_coordinates,
         count(*) filter (where not has_coords) as rows_without_coordinates
  from a
),
cc as (select coalesce(cast(label as varchar), 'nan') as k, count(*) as n from a group by 1),
sc as (select coalesce(cast(source as varchar), 'nan') as k, count(*) as n from a group by 1),
gcnt as (select coalesce("group", 'nan') as k, count(*) as n from a group by 1),
tg as (select k, n from gcnt order by n desc, k limit 10),
rep as (
  select s.*,
         (select coalesce(sum(n - 1), 0) from (select filepath, count(*) as n from a group by 1))::bigint
           as duplicate_filepaths,
         (select coalesce(sum(n - 1), 0) from (select source, gbif_id, count(*) as n from a
            where source is not null and gbif_id is not null group by 1, 2))::bigint as duplicate_source_gbif,
         coalesce(rows_without_coordinates / n_rows, 0e0) as rows_without_coordinates_ratio,
         coalesce((select max(n) from gcnt) / n_rows, 0e0) as largest_group_share,
         coalesce((select min(n) from cc), 0) as smallest_class_count
  from s
),
cand as (
  select 0 as o, printf('%d manifest paths do not exist on disk.', missing_files) as t from rep where missing_files > 0
  union all select 1, printf('%d duplicate filepath rows found.', duplicate_filepaths) from rep where duplicate_filepaths > 0
  union all select 2, printf('%d duplicate source/gbif_id rows found.', duplicate_source_gbif) from rep
    where duplicate_source_gbif > 0
  union all select 3, printf('%.0f%% of rows lack latitude/longitude.', rows_without_coordinates_ratio * 100)
    from rep where rows_without_coordinates_ratio > 0.25e0
  union all select 4, printf('Largest validation group holds %.0f%% of rows.', largest_group_share * 100)
    from rep where largest_group_share > 0.30e0
  union all select 5, printf('Smallest class has only %d images.', smallest_class_count) from rep
    where smallest_class_count > 0 and smallest_class_count < 100
),
issues as (select cast(row_number() over (order by o) - 1 as varchar) as item, t as value from cand)
"""


def _report(spark, sf):
    return quality.audit_manifest(audited(spark, sf), view(spark, sf, "file_listing"), name="combined")


@query("audit_issues", oracle(_FIX + ["file_listing"], """
select cast(item as integer) as pos, value as issue from issues
""", _REPORT_CTES))
def q_audit_issues(spark, sf):
    return _report(spark, sf).select(F.posexplode("issues").alias("pos", "issue"))


_LONG_SCALARS = ["n_rows", "n_classes", "n_sources", "n_groups", "missing_files", "duplicate_filepaths",
                 "duplicate_source_gbif", "rows_with_coordinates", "rows_without_coordinates",
                 "smallest_class_count"]


@query("audit_manifest", oracle(_FIX + ["file_listing"], "\nunion all\n".join(
    [f"select '{c}' as metric, '' as item, cast({c} as varchar) as value from rep" for c in _LONG_SCALARS]
    + [f"select '{c}', '', printf('%.6f', {c}) from rep"
       for c in ["rows_without_coordinates_ratio", "largest_group_share"]]
    + ["select 'class_counts', k, cast(n as varchar) from cc",
       "select 'source_counts', k, cast(n as varchar) from sc",
       "select 'top_groups', k, cast(n as varchar) from tg",
       "select 'issues', item, value from issues"]), _REPORT_CTES))
def q_audit_manifest(spark, sf):
    return quality.audit_long(_report(spark, sf))
