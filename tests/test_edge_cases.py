"""Edge cases: empty frames, all-null coordinates, null regions and keys, one row out per row in."""
import pytest
from pyspark.sql import functions as F

from surveyspark.operators import decisions, folds, merge, quality, scoring, spatial, versioning
from surveyspark.plans.fixtures import view

from .conftest import SF_SMALL

SCHEMA = ("src_ord int, row_ord long, filepath string, label string, region string, source string, "
          "latitude double, longitude double, gbif_id long, status string")


def test_empty_manifest_everywhere(spark):
    empty = spark.createDataFrame([], SCHEMA)
    m = merge.merge_manifests(empty, spatial.macro_map_df(spark))
    assert m.count() == 0 and "group" in m.columns
    rep = quality.audit_manifest(m).first()
    assert rep.n_rows == 0 and rep.rows_without_coordinates_ratio == 0.0 and rep.largest_group_share == 0.0
    assert list(rep.issues) == []
    assert folds.assign_folds(m).count() == 0
    assert folds.choose_n_folds(m).first().n_folds is None
    with pytest.raises(ValueError):
        folds.choose_n_folds_value(m)
    assert versioning.content_hash(m).first().n_rows == 0


def test_all_null_coordinates_and_null_region(spark):
    rows = [(0, i, f"f{i}.jpg", "A", None if i % 2 else "Lisboa", "s", None, None, i, "native") for i in range(10)]
    df = spark.createDataFrame(rows, SCHEMA)
    g = {r.row_ord: r for r in spatial.group_with_no_coords(df, spatial.macro_map_df(spark)).collect()}
    assert g[0].grid_cell == "no_coords" and g[0].group == "no_coords:s:Lisboa"
    assert g[1].group == "no_coords:s:nan"
    cov = quality.coordinate_coverage(df).first()
    assert cov.rows_with_coordinates == 0 and cov.rows_without_coordinates_ratio == 1.0
    issues = quality.audit_manifest(df.withColumn("group", F.lit("g"))).first().issues
    assert "100% of rows lack latitude/longitude." in issues


def test_null_region_with_coordinates_goes_to_macro_other(spark):
    rows = [(0, i, f"f{i}.jpg", "A", None, "s", 38.7 + i, -9.1, i, "native") for i in range(3)]
    g = spatial.group_with_no_coords(spark.createDataFrame(rows, SCHEMA), spatial.macro_map_df(spark))
    assert {r.group for r in g.collect()} == {"macro:Other"}


def test_one_row_out_per_row_in(spark):
    logits = view(spark, SF_SMALL, "logits")
    n = logits.count()
    classes = [f"class_{i}" for i in range(10)]
    scored = scoring.score(logits, classes)
    assert scored.count() == n and scored.select("row_id").distinct().count() == n
    d = view(spark, SF_SMALL, "decisions_in")
    dec = decisions.decide(d, view(spark, SF_SMALL, "invasive_species"))
    assert dec.count() == d.count()
    occ = view(spark, SF_SMALL, "occ")
    assert spatial.group_with_no_coords(occ, view(spark, SF_SMALL, "macro_map")).count() == occ.count()


@pytest.mark.parametrize("conf,level", [(0.0, "MEDIUM"), (0.6999999999, "MEDIUM"), (0.7, "HIGH"),
                                        (0.8999999999, "HIGH"), (0.9, "CRITICAL"), (1.0, "CRITICAL")])
def test_boundary_confidences_not_abstaining(spark, conf, level):
    df = spark.createDataFrame([(1, "ARUNDO DONAX", conf, False)],
                               "row_id long, predicted_class string, confidence double, abstain boolean")
    assert decisions.decide(df, decisions.species_dim(spark)).first().risk_level == level


def test_decisions_with_null_class_are_native_or_medium(spark):
    df = spark.createDataFrame([(1, None, None, True), (2, None, 0.95, False)],
                               "row_id long, predicted_class string, confidence double, abstain boolean")
    out = {r.row_id: r.risk_level for r in decisions.decide(df, decisions.species_dim(spark)).collect()}
    assert out == {1: "MEDIUM", 2: "NATIVE"}


def test_cluster_conf_sizing():
    from surveyspark.session import cluster_conf
    c = cluster_conf(100 * 1024 ** 4, executors=1000, cores_per_executor=8)
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (256 * 1024 ** 2)  # 409600
    assert int(c["spark.sql.adaptive.autoBroadcastJoinThreshold"]) <= 256 * 1024 ** 2
    small = cluster_conf(10 * 1024 ** 2, executors=2, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 24


def test_materialize_uses_session_checkpoint_dir(spark):
    from surveyspark.session import checkpoint_dir, materialize
    base = checkpoint_dir(spark)
    assert base == spark.conf.get("spark.checkpoint.dir")
    out = materialize(view(spark, SF_SMALL, "occ"), "t")
    files = out.inputFiles()
    assert files and all(base.rstrip("/") in f for f in files)
    assert out.count() == view(spark, SF_SMALL, "occ").count()
