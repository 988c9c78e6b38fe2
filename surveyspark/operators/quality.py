"""Manifest audit: frequencies, duplicates, coverage, balance and issue rules.

The report comes from three narrow passes: one ``GROUPING SETS`` aggregation
counts rows per label, source, group, coordinate presence and file presence
(reduced map-side to a few rows per task), and two key-only aggregations count
duplicate file paths and (source, gbif_id) keys; one more aggregation folds all
of it into the report row. (Putting the near-unique keys into the grouping
sets would copy every wide row once per set before the shuffle.)
Only bounded things are collected into arrays: per-class and per-source
counts and the ten largest groups (picked with a distributed top-k).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions.spatial import has_coords
from ..functions.text import percent_text
from ..sources.csv_records import read_csv
from ..sources.readers import MANIFEST_SCHEMA, file_listing, read_manifest
from .resolve import resolved_paths

REQUIRED = ("filepath", "label", "region", "source")


def require_columns(df: DataFrame, required) -> None:
    """Raise listing the missing columns (plan-time check, runs no job)."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def value_counts(df: DataFrame, col: str, keep_null: bool = True) -> DataFrame:
    """``(value, n)``; nulls become the key ``nan`` or are dropped."""
    key = F.coalesce(F.col(col).cast("string"), F.lit("nan")) if keep_null else F.col(col).cast("string")
    src = df if keep_null else df.where(F.col(col).isNotNull())
    return src.groupBy(key.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(df: DataFrame, cols) -> DataFrame:
    """Exact distinct non-null counts, one column ``n_<col>`` per input column."""
    return df.agg(*[F.countDistinct(c).alias(f"n_{c}") for c in cols])


def duplicate_counts(df: DataFrame) -> DataFrame:
    """Rows beyond the first per file path, and per (source, gbif_id) when both present."""
    fp = df.groupBy("filepath").agg(F.count(F.lit(1)).alias("n"))
    key = (df.where(F.col("source").isNotNull() & F.col("gbif_id").isNotNull())
             .groupBy("source", "gbif_id").agg(F.count(F.lit(1)).alias("n")))
    both = (fp.select(F.lit("fp").alias("k"), "n")
            .unionByName(key.select(F.lit("key").alias("k"), "n")))
    return both.agg(
        F.coalesce(F.sum(F.when(F.col("k") == "fp", F.col("n") - 1)), F.lit(0)).alias("duplicate_filepaths"),
        F.coalesce(F.sum(F.when(F.col("k") == "key", F.col("n") - 1)), F.lit(0)).alias("duplicate_source_gbif"))


def coordinate_coverage(df: DataFrame) -> DataFrame:
    has = has_coords(F.col("latitude"), F.col("longitude"))
    return (df.agg(F.count_if(has).alias("rows_with_coordinates"),
                   F.count_if(~has).alias("rows_without_coordinates"),
                   F.count(F.lit(1)).alias("_n"))
              .select("rows_with_coordinates", "rows_without_coordinates",
                      F.coalesce(F.try_divide(F.col("rows_without_coordinates"), F.col("_n")),
                                 F.lit(0.0)).alias("rows_without_coordinates_ratio")))


def group_balance(df: DataFrame, group_col="group", class_col="label") -> DataFrame:
    """Largest group share of all rows and the smallest class count."""
    g = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("n"))
    c = df.groupBy(class_col).agg(F.count(F.lit(1)).alias("n"))
    both = g.select(F.lit("g").alias("k"), "n").unionByName(c.select(F.lit("c").alias("k"), "n"))
    return both.agg(
        F.coalesce(F.try_divide(F.max(F.when(F.col("k") == "g", F.col("n"))),
                                F.sum(F.when(F.col("k") == "g", F.col("n")))), F.lit(0.0)).alias("largest_group_share"),
        F.coalesce(F.min(F.when(F.col("k") == "c", F.col("n"))), F.lit(0)).alias("smallest_class_count"))


def top_groups(df: DataFrame, n: int = 10, group_col="group") -> DataFrame:
    """The n largest groups, ties by name (distributed top-k)."""
    return (df.groupBy(group_col).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.col("n").desc(), F.col(group_col).asc()).limit(n))


def missing_files(df: DataFrame, listing: DataFrame, path_col="filepath", root: str | None = None, beside: str | None = None) -> DataFrame:
    """Manifest rows whose path is absent from a file listing (``path`` column). With a ``root`` (and the folder of
    the manifest as ``beside``) the listing holds absolute paths and a path may be at either place."""
    if root is not None:
        gone = resolved_paths(df, listing, root, beside, path_col).where("not exists").select(F.col(path_col).alias("_gone"))
        return df.join(gone, F.col(path_col).eqNullSafe(F.col("_gone")), "left_semi")
    present = listing.select(F.col("path").alias(path_col)).distinct()
    return df.join(present, on=path_col, how="left_anti")


def audit_file(spark: SparkSession, manifest: str, root: str) -> DataFrame:
    """The audit report of a manifest CSV; its paths may lie beside it or under ``root``."""
    present = read_csv(spark, manifest).columns
    beside = manifest.rsplit("/", 1)[0]
    df = read_manifest(spark, manifest, with_order=False).select([c for c in [f.name for f in MANIFEST_SCHEMA.fields] if c in present])
    listing = file_listing(spark, root).union(file_listing(spark, beside)).select("path")
    return audit_manifest(df, listing, manifest.rsplit("/", 1)[1], root=root, beside=beside)


def _issue_rules(r) -> list:
    """Issue texts in fixed order from a column namespace ``r``."""
    return [
        F.when(r("missing_files") > 0,
               F.format_string(config.ISSUE_MISSING_FILES.replace("{n}", "%d"), r("missing_files"))),
        F.when(r("duplicate_filepaths") > 0,
               F.format_string(config.ISSUE_DUP_PATHS.replace("{n}", "%d"), r("duplicate_filepaths"))),
        F.when(r("duplicate_source_gbif") > 0,
               F.format_string(config.ISSUE_DUP_KEYS.replace("{n}", "%d"), r("duplicate_source_gbif"))),
        F.when(r("rows_without_coordinates_ratio") > config.AUDIT_NO_COORDS_RATIO,
               F.replace(F.lit(config.ISSUE_NO_COORDS), F.lit("{pct}"),
                         percent_text(r("rows_without_coordinates_ratio"), 0))),
        F.when(r("largest_group_share") > config.AUDIT_LARGEST_GROUP_SHARE,
               F.replace(F.lit(config.ISSUE_BIG_GROUP), F.lit("{pct}"),
                         percent_text(r("largest_group_share"), 0))),
        F.when((r("smallest_class_count") > 0) & (r("smallest_class_count") < config.AUDIT_SMALLEST_CLASS),
               F.format_string(config.ISSUE_SMALL_CLASS.replace("{n}", "%d"), r("smallest_class_count"))),
    ]


def issues_column(r=F.col):
    return F.filter(F.array(*_issue_rules(r)), lambda x: x.isNotNull())


def audit_manifest(df: DataFrame, listing: DataFrame | None = None, name: str = "manifest",
                   present_col: str | None = None, root: str | None = None, beside: str | None = None) -> DataFrame:
    """One-row audit report (18 keys). Short form when required columns are missing.

    ``listing`` is a file listing with a ``path`` column (``sources.readers.file_listing``);
    without one every path counts as present unless ``present_col`` names a
    boolean column already on ``df``. With a ``root`` the listing's paths are absolute and
    a path is looked for beside the manifest (in the folder ``beside``), then under the root.
    """
    missing_cols = sorted(set(REQUIRED) - set(df.columns))
    if missing_cols:
        return (df.agg(F.count(F.lit(1)).alias("n_rows"))
                  .select(F.lit(name).alias("manifest"), "n_rows",
                          F.array(*[F.lit(c) for c in missing_cols]).alias("missing_required_columns"),
                          F.array(F.lit(f"Missing required columns: {missing_cols}")).alias("issues")))
    has_group = "group" in df.columns
    base = df.select(
        "filepath", "label", "source",
        (F.col("group") if has_group else F.lit(None).cast("string")).alias("group"),
        (F.col("gbif_id") if "gbif_id" in df.columns else F.lit(None).cast("bigint")).alias("gbif_id"),
        (has_coords(F.col("latitude"), F.col("longitude"))
         if {"latitude", "longitude"} <= set(df.columns) else F.lit(False)).alias("has_coords"))
    core = base
    if listing is not None and root is not None:
        at = resolved_paths(base, listing, root, beside).select(F.col("filepath").alias("_path"), "exists")
        base = base.join(at, F.col("filepath").eqNullSafe(F.col("_path"))).drop("_path")
    elif listing is not None:
        present = listing.select(F.col("path").alias("filepath")).distinct().withColumn("_present", F.lit(True))
        base = base.join(present, "filepath", "left").withColumn("exists", F.coalesce("_present", F.lit(False)))
        base = base.drop("_present")
    elif present_col:
        base = base.withColumn("exists", F.col(present_col))
    else:
        base = base.withColumn("exists", F.lit(True))

    # low-cardinality keys: one grouping-sets pass, reduced map-side to a few rows per task
    gcols = ["label", "source", "group", "has_coords", "exists"]
    sets = [[c] for c in gcols]
    stats = (base.select(*gcols).groupingSets(sets, *gcols)
             .agg(F.count(F.lit(1)).alias("n"), F.grouping_id(*gcols).alias("gid")))
    G = {c: sum(1 << (len(gcols) - 1 - i) for i, o in enumerate(gcols) if o != c) for c in gcols}
    G.update({"coords": G["has_coords"], "filepath": -2, "key": -3})
    is_ = lambda k: F.col("gid") == G[k]

    # near-unique keys: narrow key-only aggregations (no wide rows copied per grouping set)
    dup_fp = (core.groupBy("filepath").agg(F.count(F.lit(1)).alias("c"))
                  .agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("n"))
                  .select(F.lit(G["filepath"]).alias("gid"), "n"))
    dup_key = (core.where(F.col("source").isNotNull() & F.col("gbif_id").isNotNull())
                   .groupBy("source", "gbif_id").agg(F.count(F.lit(1)).alias("c"))
                   .agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("n"))
                   .select(F.lit(G["key"]).alias("gid"), "n"))

    top = (stats.where(is_("group"))
                .orderBy(F.col("n").desc(), F.col("group").asc_nulls_first()).limit(10)
                .select(F.lit(-1).alias("gid"), "group", "n"))
    # the maps' keys, a null one and a literal ``nan`` as one
    named = (stats.where(is_("label") | is_("source"))
                  .groupBy(F.when(is_("label"), F.lit(-4)).otherwise(F.lit(-5)).alias("gid"),
                           F.coalesce(F.when(is_("label"), F.col("label").cast("string")).otherwise(F.col("source").cast("string")), F.lit("nan")).alias("key"))
                  .agg(F.sum("n").alias("n")))
    parts = (stats.select("gid", "label", "source", "group", "has_coords", "exists", "n")
             .unionByName(named, allowMissingColumns=True)
             .unionByName(top, allowMissingColumns=True)
             .unionByName(dup_fp, allowMissingColumns=True)
             .unionByName(dup_key, allowMissingColumns=True))

    def counts(gid):
        entries = F.collect_list(F.when(F.col("gid") == gid, F.struct("key", F.col("n").alias("value"))))
        return F.map_from_entries(F.array_sort(entries))

    agg = parts.agg(
        F.sum(F.when(is_("label"), F.col("n"))).alias("n_rows"),
        F.count(F.when(is_("label") & F.col("label").isNotNull(), 1)).alias("n_classes"),
        F.count(F.when(is_("source") & F.col("source").isNotNull(), 1)).alias("n_sources"),
        F.count(F.when(is_("group") & F.col("group").isNotNull(), 1)).alias("n_groups"),
        F.coalesce(F.sum(F.when(is_("exists") & ~F.col("exists"), F.col("n"))), F.lit(0)).alias("missing_files"),
        F.coalesce(F.sum(F.when(is_("filepath"), F.col("n"))), F.lit(0)).alias("duplicate_filepaths"),
        F.coalesce(F.sum(F.when(is_("key"), F.col("n"))), F.lit(0)).alias("duplicate_source_gbif"),
        F.coalesce(F.sum(F.when(is_("coords") & F.col("has_coords"), F.col("n"))), F.lit(0)).alias("rows_with_coordinates"),
        F.coalesce(F.sum(F.when(is_("coords") & ~F.col("has_coords"), F.col("n"))), F.lit(0)).alias("rows_without_coordinates"),
        F.coalesce(F.max(F.when(is_("group"), F.col("n"))), F.lit(0)).alias("_largest_group"),
        F.coalesce(F.min(F.when(is_("label"), F.col("n"))), F.lit(0)).alias("smallest_class_count"),
        counts(-4).alias("class_counts"), counts(-5).alias("source_counts"),
        F.collect_list(F.when(F.col("gid") == -1, F.struct(
            (-F.col("n")).alias("o"), F.coalesce(F.col("group"), F.lit("nan")).alias("key"),
            F.col("n").alias("value")))).alias("_top"),
    )
    n = F.coalesce(F.col("n_rows"), F.lit(0))
    rep = agg.select(
        F.lit(name).alias("manifest"), n.alias("n_rows"), "n_classes", "n_sources",
        (F.col("n_groups") if has_group else F.lit(None).cast("bigint")).alias("n_groups"),
        F.array().cast("array<string>").alias("missing_required_columns"),
        "missing_files", "duplicate_filepaths", "duplicate_source_gbif",
        "rows_with_coordinates", "rows_without_coordinates",
        F.coalesce(F.try_divide(F.col("rows_without_coordinates"), n), F.lit(0.0)).alias("rows_without_coordinates_ratio"),
        F.coalesce(F.try_divide(F.col("_largest_group"), n), F.lit(0.0)).alias("largest_group_share"),
        "smallest_class_count",
        "class_counts", "source_counts",
        _count_map(F.transform(F.array_sort("_top"), lambda s: F.struct(s["key"], s["value"]))).alias("top_groups"),
    )
    return rep.withColumn("issues", issues_column())


def _count_map(e: F.Column) -> F.Column:
    """A few entries as a map; a null key and a literal ``nan`` are one key and their counts add up."""
    keys = F.array_distinct(F.transform(e, lambda x: x["key"]))
    total = lambda k: F.aggregate(F.filter(e, lambda x: x["key"] == k), F.lit(0).cast("bigint"), lambda a, x: a + x["value"])
    return F.map_from_arrays(keys, F.transform(keys, total))


def audit_long(report: DataFrame) -> DataFrame:
    """Report row -> ``(metric, item, value)`` text rows (maps and lists exploded)."""
    scalars = ["n_rows", "n_classes", "n_sources", "n_groups", "missing_files", "duplicate_filepaths",
               "duplicate_source_gbif", "rows_with_coordinates", "rows_without_coordinates",
               "smallest_class_count"]
    ratios = ["rows_without_coordinates_ratio", "largest_group_share"]
    entries = [F.struct(F.lit(c).alias("metric"), F.lit("").alias("item"),
                        F.col(c).cast("string").alias("value")) for c in scalars]
    entries += [F.struct(F.lit(c).alias("metric"), F.lit("").alias("item"),
                         F.format_string("%.6f", F.col(c)).alias("value")) for c in ratios]
    arrays = [F.array(*entries)]
    def entry_of(metric):
        return lambda e: F.struct(F.lit(metric).alias("metric"), e["key"].alias("item"),
                                  e["value"].cast("string").alias("value"))

    for m in ["class_counts", "source_counts", "top_groups"]:
        arrays.append(F.transform(F.map_entries(m), entry_of(m)))
    arrays.append(F.transform(F.col("issues"), lambda x, i: F.struct(
        F.lit("issues").alias("metric"), i.cast("string").alias("item"), x.alias("value"))))
    return report.select(F.inline(F.concat(*arrays)))
