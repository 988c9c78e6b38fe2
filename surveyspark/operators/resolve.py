"""Where a manifest's path lies: beside the manifest, else under the project's root.

A path has ranked candidates; those that a file listing holds are found by one
join of the distinct paths' candidates with the listing, and the first of them
is taken. Nothing asks a file system row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_path, resolve_path


def candidates(path: F.Column, root: str, beside: str | None = None) -> F.Column:
    """Full paths where the file may be, the preferred one first: an absolute path is its own and only one."""
    places = [p for p in (beside, root) if p is not None]
    full = [normalize_path(resolve_path(path, normalize(p))) for p in places]
    return F.array_distinct(F.array(*full))


def normalize(folder: str) -> str:
    folder = folder.replace("\\", "/")
    return "/" + folder[5:].lstrip("/") if folder.startswith("file:/") else folder.rstrip("/") or "/"


def resolved_paths(df: DataFrame, listing: DataFrame, root: str, beside: str | None = None, path_col: str = "filepath") -> DataFrame:
    """``(path_col, resolved, exists)`` for every distinct path of ``df``: the first candidate that ``listing``
    (``path``, absolute) has; where none exists, the place under the root. A null path has no place."""
    paths = df.select(F.col(path_col)).distinct()
    tried = paths.where(F.col(path_col).isNotNull()).select(path_col, F.posexplode(candidates(F.col(path_col), root, beside)).alias("rank", "at"))
    there = listing.select(normalize_path(F.col("path")).alias("at")).distinct()
    found = tried.join(there, "at", "left_semi").groupBy(path_col).agg(F.min_by("at", "rank").alias("_at"))
    default = F.element_at(candidates(F.col(path_col), root, beside), -1)
    out = paths.join(found.withColumnRenamed(path_col, "_path"), F.col(path_col) == F.col("_path"), "left")
    return out.select(path_col, F.coalesce("_at", F.when(F.col(path_col).isNotNull(), default)).alias("resolved"), F.col("_at").isNotNull().alias("exists"))
