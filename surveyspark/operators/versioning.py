"""Table versioning: profiles, an order-independent content hash, file
checksums, a versions table and drift between two profiles.

The content hash needs no global sort. A row's code is, for each column, a mark
for null or the length of the value's text and the text, so no two rows of other
values have one code; its SHA-256 is cut into lanes, each lane is added up
exactly over all rows (sums do not depend on order or partitioning and, unlike
XOR, change with a repeated row), and the table's hash is the SHA-256 of the row
count, the lanes' sums and the columns' names and types.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Hex digits of a lane, so that a lane is a long, and the lanes of a SHA-256 (the last is shorter).
LANE = 13
LANES = range(1, 64, LANE)


def value_text(name: str, of: T.DataType) -> Column:
    """A text for every value of a column, another one for every other value of its type."""
    c = F.col(f"`{name}`")
    if isinstance(of, T.BinaryType):
        return F.hex(c)
    if isinstance(of, T.TimestampType):
        return F.unix_micros(c).cast("string")  # not the session's time zone
    if isinstance(of, T.MapType):
        c = F.array_sort(F.map_entries(c))
    if isinstance(of, (T.MapType, T.ArrayType, T.StructType)):
        return F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})
    return c.cast("string")


def row_hash(df: DataFrame) -> Column:
    """SHA-256 of a row's code; the code is the values' alone, not the columns' names."""
    parts = []
    for f in df.schema.fields:
        text = value_text(f.name, f.dataType)
        some = F.concat(F.length(text).cast("string"), F.lit(":"), text)
        parts.append(F.when(F.col(f"`{f.name}`").isNull(), F.lit("-")).otherwise(some))
    return F.sha2(F.concat(F.lit(""), *parts), 256)


def header_text(df: DataFrame) -> str:
    """Names and types of the columns, in order."""
    return "".join(f"{len(f.name)}:{f.name}{f.dataType.simpleString()};" for f in df.schema.fields)


def content_hash(df: DataFrame) -> DataFrame:
    """``(n_rows, hash_sum)``: the row count and the table's hash in hex digits. An empty table's hash is that of
    its columns."""
    lanes = [F.conv(F.substring("h", at, LANE), 16, 10).cast("decimal(38,0)") for at in LANES]
    sums = df.select(row_hash(df).alias("h")).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.coalesce(F.sum(x), F.lit(0).cast("decimal(38,0)")).cast("string").alias(f"s{i}") for i, x in enumerate(lanes)])
    text = F.concat_ws("|", F.col("n_rows").cast("string"), *[F.col(f"s{i}") for i in range(len(lanes))], F.lit(header_text(df)))
    return sums.select("n_rows", F.sha2(text, 256).alias("hash_sum"))


def table_profile(df: DataFrame, label_col="label", source_col="source", group_col="group") -> DataFrame:
    """Long ``(key, item, value)`` profile: sizes, distinct counts, column list and
    class / source distributions (nulls dropped)."""
    cols = df.columns
    scal = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[(F.countDistinct(c) if c in cols else F.lit(None).cast("bigint")).alias(f"n_{k}")
          for k, c in [("classes", label_col), ("sources", source_col), ("groups", group_col)]])
    scalars = scal.select(F.inline(F.array(
        *[F.struct(F.lit(k).alias("key"), F.lit("").alias("item"), F.col(k).cast("string").alias("value"))
          for k in ["n_rows", "n_classes", "n_sources", "n_groups"]],
        F.struct(F.lit("n_columns").alias("key"), F.lit("").alias("item"), F.lit(str(len(cols))).alias("value")),
        F.struct(F.lit("columns").alias("key"), F.lit("").alias("item"), F.lit(",".join(cols)).alias("value")))))
    dists = []
    for key, c in [("class_distribution", label_col), ("source_distribution", source_col)]:
        if c in cols:
            dists.append(df.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("item"))
                           .agg(F.count(F.lit(1)).cast("string").alias("value"))
                           .select(F.lit(key).alias("key"), "item", "value"))
    out = scalars
    for d in dists:
        out = out.unionByName(d)
    return out


def detect_drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Profile entries whose value changed, appeared or disappeared."""
    o = old.select("key", "item", F.col("value").alias("old"))
    n = new.select("key", "item", F.col("value").alias("new"))
    return o.join(n, ["key", "item"], "full_outer").where(~F.col("old").eqNullSafe(F.col("new")))


def file_checksums(files: DataFrame) -> DataFrame:
    """MD5 and SHA-256 of ``binaryFile`` rows (``path``, ``content``)."""
    return files.select("path", "length", F.md5("content").alias("md5"), F.sha2("content", 256).alias("sha256"))


def version_record(df: DataFrame, description: str = "", checksums: DataFrame | None = None,
                   ts: float | None = None, label_col="label", source_col="source", group_col="group") -> DataFrame:
    """One-row version record: time, description, content hash, sizes, the table's profile and, where given,
    the files' checksums in one digest.

    ``profile`` holds the rows of :func:`table_profile` (one per class and source). The files' digest is a sum
    over all files, so it changes with any of them; their number is kept beside it.
    """
    rec = content_hash(df).select(
        F.lit(float(ts if ts is not None else time.time())).alias("timestamp"),
        F.lit(description).alias("description"), "n_rows", "hash_sum",
        F.lit(len(df.columns)).alias("n_columns"))
    profile = table_profile(df, label_col, source_col, group_col).agg(
        F.sort_array(F.collect_list(F.struct("key", "item", "value"))).alias("profile"))
    out = rec.select("*", F.lit(0).alias("_k")).join(profile.select("*", F.lit(0).alias("_k")), "_k")
    if checksums is None:
        return out.drop("_k").withColumns({"n_files": F.lit(None).cast("bigint"), "md5": F.lit(None).cast("string"),
                                           "sha256": F.lit(None).cast("string")})
    path = [c for c in checksums.columns if c == "path"]
    files = content_hash(checksums.select(*path, "md5")).select("n_rows", F.col("hash_sum").alias("md5"))
    files = files.select(F.col("n_rows").alias("n_files"), "md5", F.lit(0).alias("_k"))
    sha = content_hash(checksums.select(*path, "sha256")).select(F.col("hash_sum").alias("sha256"), F.lit(0).alias("_k"))
    return out.join(files, "_k").join(sha, "_k").drop("_k")


def save_version(record: DataFrame, path: str) -> None:
    """Append to the versions table (Parquet)."""
    record.write.mode("append").parquet(path)


def load_latest(spark: SparkSession, path: str):
    """Latest version row, or None when there is no versions table; a table that cannot be read is an error."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(conf).exists(at):
        return None
    v = spark.read.parquet(path)
    row = v.agg(F.max_by(F.struct(*v.columns), "timestamp").alias("v")).first()
    return row["v"] if row and row["v"] is not None else None


def saved_profile(spark: SparkSession, path: str) -> DataFrame:
    """``(key, item, value)`` of the latest saved version; no rows when there is none."""
    latest = load_latest(spark, path)
    rows = [tuple(r) for r in latest["profile"]] if latest is not None else []
    return spark.createDataFrame(rows, "key string, item string, value string")


def drift_from_saved(df: DataFrame, path: str, **columns) -> DataFrame | None:
    """Drift of ``df`` against the latest saved version; None when no version was saved."""
    spark = df.sparkSession
    if load_latest(spark, path) is None:
        return None
    return detect_drift(saved_profile(spark, path), table_profile(df, **columns))


def verify(current: DataFrame, spark: SparkSession, path: str):
    """``(matches, message)`` against the latest saved version; no saved version is a match. The content is
    always compared, files where both versions have their checksums."""
    latest = load_latest(spark, path)
    if latest is None:
        return True, None
    cur = current.first()
    if cur["n_rows"] != latest["n_rows"]:
        return False, f"content mismatch: {latest['n_rows']} rows saved, {cur['n_rows']} now"
    if cur["hash_sum"] != latest["hash_sum"]:
        names = [next((p["value"] for p in v["profile"] if p["key"] == "columns"), None) for v in (latest, cur)]
        what = f"columns {names[0]} saved, {names[1]} now" if names[0] != names[1] else "other values or types in as many rows"
        return False, f"content mismatch: {what}"
    if cur["n_files"] is not None and latest["n_files"] is not None:
        if cur["md5"] != latest["md5"]:
            return False, "MD5 mismatch — manifest file has changed"
        if cur["sha256"] != latest["sha256"]:
            return False, "SHA256 mismatch — manifest file has changed"
    return True, None
