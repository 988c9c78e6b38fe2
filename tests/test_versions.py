"""Content hashes that tell tables apart, saved versions, stored predictions, path resolution."""
import datetime
import os

import pytest
from pyspark.sql import functions as F

from surveyspark.operators import versioning
from surveyspark.sources import readers

SEP = "\u001f"


def _hash(spark, rows, schema):
    return versioning.content_hash(spark.createDataFrame(rows, schema)).first()


@pytest.mark.parametrize("a,b", [
    (([(f"a{SEP}b", "c")], "x string, y string"), ([("a", f"b{SEP}c")], "x string, y string")),
    (([(None, "c")], "x string, y string"), ([("\0", "c")], "x string, y string")),
    (([("a", "c")], "x string, y string"), ([("a", "c")], "x string, z string")),
    (([("1", "c")], "x string, y string"), ([(1, "c")], "x int, y string")),
    (([("1:a", "")], "x string, y string"), ([("1", "a")], "x string, y string")),
    (([("-", None)], "x string, y string"), ([(None, "-")], "x string, y string")),
    (([(["a, b"],)], "x array<string>"), ([(["a", "b"],)], "x array<string>")),
    (([({"a": 1, "b": None},)], "x map<string,int>"), ([({"a": 1},)], "x map<string,int>")),
    (([(1,), (1,), (2,)], "x int"), ([(1,), (2,), (2,)], "x int")),
    (([], "x int"), ([], "y int")),
])
def test_other_tables_have_other_hashes(spark, a, b):
    assert _hash(spark, *a) != _hash(spark, *b)


def test_hash_depends_on_neither_order_nor_partitions_nor_zone(spark):
    rows = [(i, f"é{i % 7}" if i % 3 else None, float("nan") if i % 5 == 0 else i / 3, bytes([i % 256]), {"b": i, "a": 1}, datetime.datetime(2024, 1, 1 + i % 20)) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, s string, d double, b binary, m map<string,int>, t timestamp")
    want = versioning.content_hash(df).first()
    assert versioning.content_hash(df.repartition(7, "s").orderBy(F.rand(1))).first() == want
    turned = df.withColumn("m", F.map_from_entries(F.reverse(F.map_entries("m"))))
    assert versioning.content_hash(turned).first() == want
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert versioning.content_hash(df).first() == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_verify_sees_a_renamed_column_and_changed_values(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "versions")
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "label string, source string")
    versioning.save_version(versioning.version_record(df, "one", ts=1.0), path)
    assert versioning.verify(versioning.version_record(df), spark, path) == (True, None)
    ok, why = versioning.verify(versioning.version_record(df.withColumnRenamed("source", "src")), spark, path)
    assert not ok and "columns label,source saved, label,src now" in why
    ok, why = versioning.verify(versioning.version_record(df.replace("x", "z")), spark, path)
    assert not ok and "other values" in why
    assert "3 now" in versioning.verify(versioning.version_record(df.union(df.limit(1))), spark, path)[1]


def test_a_fold_is_replaced_and_models_share_a_schema(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "preds")
    df = spark.createDataFrame([(i, 0, 0, 0.9, [1.0, 0.0]) for i in range(5)], readers.PREDICTION_SCHEMA)
    for _ in range(2):
        readers.write_predictions(df, path, "resnet", 0)
    readers.write_predictions(df.limit(2), path, "resnet", 1)
    readers.write_predictions(df.drop("confidence").limit(3), path, "cnn", 0)
    readers.write_predictions(df.limit(4), path, "resnet", 1)
    count = lambda m, f: readers.load_predictions(spark, path, m, f).count()
    assert (count("resnet", 0), count("resnet", 1), count("cnn", 0), count("cnn", 1)) == (5, 4, 3, 0)
    assert all(r.confidence != r.confidence for r in readers.load_predictions(spark, path, "cnn", 0).collect())
    assert {r.confidence for r in readers.load_predictions(spark, path, "resnet", 0).collect()} == {0.9}
    readers.write_predictions(df.limit(0), path, "resnet", 1)  # an empty fold replaces too
    assert (count("resnet", 0), count("resnet", 1)) == (5, 0)


def test_paths_beside_the_manifest_come_first(spark):
    from surveyspark.operators import quality
    from surveyspark.operators.resolve import resolved_paths

    listing = spark.createDataFrame([("file:/m/a.jpg",), ("/r/a.jpg",), ("/r/b.jpg",), ("/m/x/c.jpg",), ("/abs/d.jpg",), ("/r/q/e.jpg",)], "path string")
    rows = [("a.jpg",), ("b.jpg",), ("x\\c.jpg",), ("/abs/d.jpg",), ("/abs/no.jpg",), ("no.jpg",), ("./b.jpg",), ("x/../q/e.jpg",), (None,), ("a.jpg",)]
    df = spark.createDataFrame(rows, "filepath string").selectExpr("filepath", "'A' as label", "'r' as region", "'s' as source")
    got = {r.filepath: (r.resolved, r.exists) for r in resolved_paths(df, listing, "/r/", "/m").collect()}
    assert got == {"a.jpg": ("/m/a.jpg", True), "b.jpg": ("/r/b.jpg", True), "x\\c.jpg": ("/m/x/c.jpg", True), "/abs/d.jpg": ("/abs/d.jpg", True), "/abs/no.jpg": ("/abs/no.jpg", False),
                   "no.jpg": ("/r/no.jpg", False), "./b.jpg": ("/r/b.jpg", True), "x/../q/e.jpg": ("/r/q/e.jpg", True), None: (None, False)}
    assert {r.filepath: r.resolved for r in resolved_paths(df, listing, "/r").collect()}["a.jpg"] == "/r/a.jpg"
    assert sorted(str(r.filepath) for r in quality.missing_files(df, listing, root="/r", beside="/m").collect()) == ["/abs/no.jpg", "None", "no.jpg"]
    assert quality.audit_manifest(df, listing, root="/r", beside="/m").first().missing_files == 3
    assert quality.audit_manifest(df, listing, root="/r").first().missing_files == 4


def test_greedy_folds_balance_skewed_labels(spark):
    from surveyspark.operators import folds

    # 300,000 groups; one label holds most of them, sizes from 1 to 4096, a few large groups
    df = spark.range(300_000).selectExpr("id as g", "case when id % 10 < 8 then 'a' when id % 100 = 9 then 'c' else 'b' end as label",
                                         "cast(case when id % 5000 = 9 then 4096 when id % 200 = 8 then 100 + id % 37 else 1 + id % 3 end as int) as size")
    hist = df.selectExpr("g as group", "label", "size as n")
    import pytest as _pytest
    patch = _pytest.MonkeyPatch()
    patch.setattr(folds, "group_label_hist", lambda *a: hist)
    try:
        dealt = folds.greedy_folds(df, 5).persist()
    finally:
        patch.undo()
    assert dealt.count() == dealt.select("group").distinct().count() == 300_000
    per = df.join(dealt, F.col("g") == F.col("group")).groupBy("label", "fold").agg(F.sum("size").alias("n"), F.max("size").alias("largest")).collect()
    for label in "abc":
        mine = [r for r in per if r.label == label]
        assert len(mine) == 5 and max(r.n for r in mine) - min(r.n for r in mine) <= max(r.largest for r in mine)


def test_audit_of_a_manifest_file(spark, tmpdir_path):
    from surveyspark.operators import quality

    root, beside = (os.path.join(tmpdir_path, n) for n in ("root", "lists"))
    for folder, name in ((root, "img/a.jpg"), (root, "img/b.jpg"), (beside, "img/c.jpg")):
        os.makedirs(os.path.dirname(os.path.join(folder, name)), exist_ok=True)
        open(os.path.join(folder, name), "w").write("x")
    path = os.path.join(beside, "m.csv")
    open(path, "w").write('filepath,label,region,source\nimg/a.jpg,A,r,s\nimg/b.jpg,"nan",r,s\nimg/c.jpg,,r,\nimg/d.jpg,A,r,s\n')
    r = quality.audit_file(spark, path, root).first()
    assert (r.n_rows, r.missing_files, r.n_classes, r.class_counts, r.source_counts) == (4, 1, 1, {"A": 2, "nan": 2}, {"s": 3, "nan": 1})
    open(path, "w").write("filepath,label\nimg/a.jpg,A\n")
    assert quality.audit_file(spark, path, root).first().missing_required_columns == ["region", "source"]
