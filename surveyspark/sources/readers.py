"""Readers: manifests, occurrence dumps, mapping files, image trees, prediction
store, class lists.

Every reader declares its schema (no inference pass over the data), keeps
ids as text until they are normalised, and reads file listings through the
``binaryFile`` source with the ``content`` column pruned, so a listing of a
million images never loads a byte of image data.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions.spatial import has_coords
from ..functions.text import normalize_id, normalize_path, resolve_path, species_from_dirname
from .csv_records import read_csv

MANIFEST_SCHEMA = T.StructType([
    T.StructField("filepath", T.StringType()), T.StructField("label", T.StringType()),
    T.StructField("region", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
    T.StructField("gbif_id", T.StringType()), T.StructField("grid_cell", T.StringType()),
    T.StructField("group", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("floralens_set", T.StringType()), T.StructField("floralens_repos", T.StringType()),
    T.StructField("gbif_platform", T.StringType()),
])

OCCURRENCE_FIELDS = ["gbifID", "key", "occurrenceID", "scientificName", "phylum", "kingdom", "countryCode",
                     "datasetKey", "mediaType", "associatedMedia", "stateProvince", "county"]
OCCURRENCE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in OCCURRENCE_FIELDS]
    + [T.StructField("decimalLatitude", T.DoubleType()), T.StructField("decimalLongitude", T.DoubleType())])
MEDIA_TYPE = T.ArrayType(T.StructType([T.StructField("type", T.StringType()),
                                       T.StructField("identifier", T.StringType())]))
OCCURRENCE_JSON_SCHEMA = T.StructType(OCCURRENCE_SCHEMA.fields + [T.StructField("media", MEDIA_TYPE)])

#: Columns of a mapping file in JSON (a list of objects); other keys are not read.
MAPPING_SCHEMA = "species string, image_url string, url string, filename string, gbif_id string, `set` string, repos string"
PREDICTION_SCHEMA = "row_id bigint, label int, pred int, confidence double, logits array<double>"


def with_row_ord(df: DataFrame) -> DataFrame:
    """File order of each row: ``(file, split offset, position in split)`` packed in a struct.

    Must be applied right after the scan, before any shuffle.
    """
    return df.withColumn("row_ord", F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos")))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system that Spark reads exists."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_manifest(spark: SparkSession, path: str, with_order: bool = True) -> DataFrame:
    """Manifest CSV with header (quoted line breaks and doubled quotes included, see ``csv_records``); every optional column present (null when absent);
    ``gbif_id`` normalised from ``123`` / ``123.0`` to bigint. A number that cannot be read is null, and its
    text is kept in ``_rejected`` (``column=text``)."""
    raw = read_csv(spark, path, order=True)
    present = set(raw.columns)
    cols = [(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType))
            .alias(f.name) for f in MANIFEST_SCHEMA.fields if f.name != "gbif_id"]
    gid = normalize_id(F.col("gbif_id")) if "gbif_id" in present else F.lit(None).cast("bigint")
    bad = [F.when(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull(),
                  F.concat(F.lit(f"{f.name}="), F.col(f"`{f.name}`")))
           for f in MANIFEST_SCHEMA.fields if f.name in present and f.dataType != T.StringType()]
    rejected = F.nullif(F.concat_ws("; ", *bad), F.lit("")) if bad else F.lit(None).cast("string")
    return raw.select(*cols, gid.alias("gbif_id"), rejected.alias("_rejected"), *(["row_ord"] if with_order else []))


def read_manifests(spark: SparkSession, manifest_dir: str, names=config.MANIFEST_SOURCES) -> list[DataFrame]:
    """The source manifests that exist, in merge order (``src_ord`` added by the merge)."""
    paths = [f"{manifest_dir.rstrip('/')}/{n}" for n in names]
    parts = [read_manifest(spark, p) for p in paths if path_exists(spark, p)]
    if not parts:
        raise FileNotFoundError(f"No manifest CSVs found in {manifest_dir}.")
    return parts


def read_occurrences(spark: SparkSession, path: str) -> DataFrame:
    """Darwin Core occurrence TSV by its header names, whatever their order and whatever other columns there
    are; absent columns are null, ``id`` stands in for an absent ``gbifID``. Numbers that cannot be read are null,
    their text is kept in ``_rejected``."""
    raw = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(path)
    names = set(raw.columns)
    text = lambda c: F.col(f"`{c}`") if c in names else F.lit(None).cast("string")
    cols, bad = [text("id").alias("id")], []
    for f in OCCURRENCE_SCHEMA.fields:
        value = text("id") if f.name == "gbifID" and "gbifID" not in names else text(f.name)
        if f.dataType != T.StringType():
            bad.append(F.when(value.isNotNull() & value.try_cast(f.dataType).isNull(), F.concat(F.lit(f"{f.name}="), value)))
            value = value.try_cast(f.dataType)
        cols.append(value.alias(f.name))
    return raw.select(*cols, F.nullif(F.concat_ws("; ", *bad), F.lit("")).alias("_rejected"))


def read_occurrences_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OCCURRENCE_JSON_SCHEMA).json(path)


def fetch_occurrences(dump: DataFrame, species: str, dataset_key: str, country: str = "PT") -> DataFrame:
    """Records of one species in one dataset and country that have coordinates
    and a still image (predicates pushed to the scan where the format allows)."""
    has_image = F.exists(F.col("media"), lambda m: m["type"] == "StillImage")
    return dump.where((F.col("scientificName") == species) & (F.col("datasetKey") == dataset_key)
                      & (F.col("countryCode") == country) & has_coords(F.col("decimalLatitude"), F.col("decimalLongitude"))
                      & F.coalesce(has_image, F.lit(False)))


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Mapping file reader chosen by extension: ``.json``, ``.tsv``, else CSV."""
    if path.endswith(".json"):
        return spark.read.json(path, multiLine=True, schema=MAPPING_SCHEMA)
    return read_csv(spark, path, "\t" if path.endswith(".tsv") else ",")


def scan_image_tree(spark: SparkSession, root: str, source: str,
                    exts=config.IMAGE_EXTENSIONS, project: str | None = None) -> DataFrame:
    """``<root>/<Species_Name>/<file>`` -> manifest rows: exactly one level below ``root``, label from the
    folder, image extensions only (case-insensitive), region ``Unknown``; paths relative to ``project``
    (default: the folder that holds ``root``), as the other manifests write them. ``row_ord`` is the path,
    so rows are in path order."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
             .select("path", "length", "modificationTime"))
    ext = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    plain = lambda p: re.sub(r"^file:/+", "/", p).rstrip("/")
    top = plain(root)
    full = F.regexp_replace("path", "^file:/+", "/")
    below = F.split(F.substring(full, F.instr(full, top) + len(top) + 1, F.length(full)), "/")
    path = normalize_path(full, plain(project) if project else top.rsplit("/", 1)[0])
    return (files.where(ext.isin([e.lower() for e in exts]) & (F.size(below) == 2))
                 .select(path.alias("filepath"), species_from_dirname(F.get(below, 0)).alias("label"),
                         F.lit("Unknown").alias("region"), F.lit(source).alias("source"), "length",
                         "modificationTime", path.alias("row_ord")))


def scan_survey_folder(spark: SparkSession, folder: str, glob: str = config.SURVEY_GLOB) -> DataFrame:
    """Flat listing of a survey folder's photos (metadata only)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
            .select("path", "length", "modificationTime"))


def file_listing(spark: SparkSession, root: str) -> DataFrame:
    """``(path, length)`` of every file under ``root`` (for existence joins)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
            .select("path", "length"))


def result_sets(spark: SparkSession, path_glob: str) -> DataFrame:
    """``(location, parts, bytes, written)`` of every exported result set: the ``part-`` files of one folder are
    one set, named by the folder; any other CSV is a set of its own. ``written`` is the time of its last part."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
             .load(path_glob).select("path", "length", "modificationTime"))
    folder = F.regexp_extract("path", r"^(.*)/part-[^/]*$", 1)
    return (files.groupBy(F.when(folder != "", folder).otherwise(F.col("path")).alias("location"))
                 .agg(F.count(F.lit(1)).alias("parts"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("written")))


def latest_results(spark: SparkSession, path_glob: str, schema=None) -> DataFrame:
    """All rows of the newest result set (see :func:`result_sets`; ties: the greater name), whatever the number of
    its parts; parts without rows decide nothing. With a ``schema`` its columns are taken by header name; absent
    ones are null, as are values that do not fit. No set at all is an error."""
    newest = result_sets(spark, path_glob).agg(F.max_by("location", F.struct("written", "location")).alias("at")).first()["at"]
    if newest is None:
        raise FileNotFoundError(f"No results CSV at {path_glob}.")
    df = read_csv(spark, newest, pathGlobFilter="*.csv")
    if schema is None:
        return df
    want = spark.createDataFrame([], schema).schema
    return df.select(*[(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType))
                       .alias(f.name) for f in want.fields])


def write_predictions(df: DataFrame, path: str, model: str, fold: int) -> None:
    """Store a fold's prediction bundle, partitioned by model and fold, in place of one that is there; other folds
    stay. All models have the columns of ``PREDICTION_SCHEMA``: an absent confidence is NaN, other absent ones are
    null, and further columns are an error. The parts of a fold are swapped when all are written."""
    spark = df.sparkSession
    want = spark.createDataFrame([], PREDICTION_SCHEMA).schema
    more = [c for c in df.columns if c not in want.names]
    if more:
        raise ValueError(f"Columns that predictions do not have: {more}")
    absent = {"confidence": F.lit(float("nan"))}
    rows = df.select(*[(F.col(f.name) if f.name in df.columns else absent.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in want.fields],
                     F.lit(model).alias("model"), F.lit(int(fold)).alias("fold"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model", "fold").parquet(path)
    if df.isEmpty():  # a dynamic overwrite leaves partitions without rows as they are
        name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(model)
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/model={name}/fold={int(fold)}")
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def load_predictions(spark: SparkSession, path: str, model: str, fold: int = 0) -> DataFrame:
    """A fold's bundle (partition-pruned); a missing confidence reads as NaN, a fold that is not there as no rows."""
    df = spark.read.schema(f"{PREDICTION_SCHEMA}, model string, fold int").parquet(path).where((F.col("model") == model) & (F.col("fold") == fold))
    return df.withColumn("confidence", F.coalesce("confidence", F.lit(float("nan"))))


def read_classes(spark: SparkSession, metrics_json: str) -> list[str]:
    """Class list from a metrics JSON (``{"classes": [...]}``); error when absent or empty."""
    df = spark.read.option("multiLine", True).json(metrics_json)
    if "classes" not in df.columns:
        raise ValueError(f"No classes in {metrics_json}")
    classes = [r["c"] for r in df.select(F.explode("classes").alias("c")).collect()]
    if not classes:
        raise ValueError(f"Empty class list in {metrics_json}")
    return classes


def validate_images(spark: SparkSession, paths: DataFrame, root: str,
                    min_bytes: int = config.MIN_IMAGE_BYTES, project: str | None = None) -> DataFrame:
    """Per manifest path: exists, at least ``min_bytes``, decodes; ``reason`` when not.

    ``paths`` has a ``path`` column, absolute or relative to ``project`` (default: the folder that holds ``root``).
    Existence and size come from the ``binaryFile`` listing; decodability from
    the ``image`` source with invalid images kept (height -1).
    """
    def local(c):  # the image source writes file:///x, the file listing file:/x
        return F.regexp_replace(c, r"^file:/+", "/")

    listing = file_listing(spark, root).select(local(F.col("path")).alias("_p"), "length")
    decoded = (spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True)
               .load(root).select(local(F.col("image.origin")).alias("_o"),
                                  (F.col("image.height") >= 0).alias("decodes")))
    base = project or root.rstrip("/").rsplit("/", 1)[0]
    full = local(F.when(F.col("path").startswith("file:"), F.col("path")).otherwise(resolve_path(F.col("path"), base)))
    j = (paths.withColumn("_full", full).join(listing, F.col("_full") == F.col("_p"), "left")
              .join(decoded, F.col("_full") == F.col("_o"), "left"))
    reason = (F.when(F.col("_p").isNull(), F.lit("missing"))
               .when(F.col("length") < min_bytes, F.lit("too small"))
               .when(~F.coalesce(F.col("decodes"), F.lit(False)), F.lit("cannot decode")))
    return j.select("path", "length", reason.isNull().alias("valid"), reason.alias("reason"))
