"""File sources, sinks, versioning, generator, streaming and Spark ML on small files made by the test."""
import os
import struct
import time
import zlib

import pytest
from pyspark.sql import functions as F

from surveyspark.operators import merge, sampling, scoring, spatial, tuning, versioning
from surveyspark.plans.fixtures import view
from surveyspark.sources import generate, readers, sinks
from surveyspark.streaming import scoring_stream

from .conftest import SF_SMALL


def tempfile_dir():
    import tempfile
    return tempfile.mkdtemp(prefix="surveyspark-m-")


def _png(w=40, h=40):
    raw = b"".join(b"\x00" + bytes([(x * 7 + y) % 256 for x in range(w * 3)]) for y in range(h))

    def chunk(t, d):
        return struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d) & 0xFFFFFFFF)
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw, 0)) + chunk(b"IEND", b""))


def test_manifest_csv_merge_order_and_ids(spark, tmpdir_path):
    a = os.path.join(tmpdir_path, "invasoras_manifest.csv")
    b = os.path.join(tmpdir_path, "synthetic_manifest.csv")
    open(a, "w").write("filepath,label,region,source,latitude,longitude,gbif_id\n"
                       "x/1.jpg,A,Lisboa,invasoras,38.7,-9.1,123.0\nx/2.jpg,A,Lisboa,invasoras,38.7,-9.1,123\n")
    open(b, "w").write("filepath,label,region,latitude,longitude,source\n"
                       "C:\\root\\x\\1.jpg,B,Porto,41.1,-8.6,synthetic\nx/3.jpg,B,,41.1,-8.6,synthetic\n")
    parts = readers.read_manifests(spark, tmpdir_path)
    assert len(parts) == 2
    m = merge.merge_manifests(parts, spatial.macro_map_df(spark), root="C:\\root", min_grid=1, min_district=1)
    got = {r.filepath: (r.label, r.gbif_id) for r in m.collect()}
    # x/1.jpg: the earlier source wins; x/2.jpg repeats (invasoras, 123) and goes
    assert got == {"x/1.jpg": ("A", 123), "x/3.jpg": ("B", None)}


def test_image_tree_survey_folder_checksums_validity(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "tree")
    os.makedirs(os.path.join(root, "Arundo_donax"))
    os.makedirs(os.path.join(root, "Acacia_dealbata"))
    good = os.path.join(root, "Arundo_donax", "a.PNG")
    open(good, "wb").write(_png())
    open(os.path.join(root, "Acacia_dealbata", "b.jpg"), "wb").write(b"not an image" * 200)
    open(os.path.join(root, "Acacia_dealbata", "notes.txt"), "w").write("x")
    tree = readers.scan_image_tree(spark, root, "local")
    labels = sorted(r.label for r in tree.collect())
    assert labels == ["Acacia dealbata", "Arundo donax"]
    survey = readers.scan_survey_folder(spark, os.path.join(root, "Acacia_dealbata"))
    assert [os.path.basename(r.path) for r in survey.collect()] == ["b.jpg"]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    ck = {os.path.basename(r.path): r for r in versioning.file_checksums(files).collect()}
    import hashlib
    assert ck["notes.txt"].md5 == hashlib.md5(b"x").hexdigest()
    paths = tree.select(F.col("filepath").alias("path")).unionByName(
        spark.createDataFrame([("file:" + os.path.join(root, "gone.jpg"),)], "path string"))
    v = {os.path.basename(r.path): r.reason for r in readers.validate_images(spark, paths, root).collect()}
    assert v["b.jpg"] == "cannot decode" and v["gone.jpg"] == "missing"
    assert v["a.PNG"] in (None, "too small")


def test_prediction_store_and_classes(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "preds")
    df = spark.createDataFrame([(1, 0, 0, 0.9, [1.0, 0.0])], readers.PREDICTION_SCHEMA)
    readers.write_predictions(df, p, "resnet", 0)
    readers.write_predictions(df.drop("confidence"), p + "_nc", "cnn", 0)
    assert readers.load_predictions(spark, p, "resnet", 0).count() == 1
    j = os.path.join(tmpdir_path, "metrics.json")
    open(j, "w").write('{"classes": ["A", "B"], "accuracy": 0.5}')
    assert readers.read_classes(spark, j) == ["A", "B"]


def test_sinks_and_latest_results(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    sinks.write_table(df, os.path.join(tmpdir_path, "r1"), fmt="csv")
    time.sleep(1.1)
    sinks.write_table(spark.createDataFrame([(2, "b")], "id int, v string"), os.path.join(tmpdir_path, "r2"), fmt="csv")
    latest = readers.latest_results(spark, os.path.join(tmpdir_path, "r*"), schema="id int, v string")
    assert [r.id for r in latest.collect()] == [2]


def test_content_hash_stable_under_repartition_and_duplicates(spark):
    occ = view(spark, SF_SMALL, "occ")
    h1 = versioning.content_hash(occ).first()
    h2 = versioning.content_hash(occ.repartition(7, "label").orderBy(F.rand(3))).first()
    assert h1 == h2
    h3 = versioning.content_hash(occ.unionByName(occ.limit(1))).first()
    assert h3.hash_sum != h1.hash_sum


def test_version_table_roundtrip(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "versions")
    occ = view(spark, SF_SMALL, "occ")
    ck = spark.createDataFrame([("m1", "s1")], "md5 string, sha256 string")
    assert versioning.verify(versioning.version_record(occ, "x", ck), spark, path) == (True, None)
    versioning.save_version(versioning.version_record(occ, "v1", ck, ts=1.0), path)
    ck2 = spark.createDataFrame([("m2", "s1")], "md5 string, sha256 string")
    ok, msg = versioning.verify(versioning.version_record(occ, "v2", ck2), spark, path)
    assert not ok and msg.startswith("MD5 mismatch")
    # changed rows are seen without checksums, a second file's change is seen, a broken table is an error
    assert not versioning.verify(versioning.version_record(occ.limit(occ.count() - 1)), spark, path)[0]
    two = [spark.createDataFrame([("a", "m1", "s1"), ("b", m, "s2")], "path string, md5 string, sha256 string") for m in ("m2", "m3")]
    versioning.save_version(versioning.version_record(occ, "v3", two[0], ts=2.0), path)
    assert versioning.verify(versioning.version_record(occ, "v4", two[0]), spark, path) == (True, None)
    assert not versioning.verify(versioning.version_record(occ, "v4", two[1]), spark, path)[0]
    drift = versioning.drift_from_saved(occ.where("label <> 'BUILDING'").withColumn("group", F.lit("g")), path)
    assert drift.where("key = 'class_distribution' and item = 'BUILDING' and new is null").count() == 1
    assert versioning.drift_from_saved(occ, path + "-none") is None
    broken = os.path.join(tmpdir_path, "broken")
    os.makedirs(broken)
    open(os.path.join(broken, "x.parquet"), "w").write("no parquet")
    with pytest.raises(Exception):
        versioning.verify(versioning.version_record(occ), spark, broken)


def test_manifests_by_uri_bad_numbers_and_tree_merge(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "manifests")
    root = os.path.join(tmpdir_path, "img")
    os.makedirs(folder)
    os.makedirs(os.path.join(root, "Arundo_donax", "thumbs"))
    for f in ("img/Arundo_donax/a.jpg", "img/Arundo_donax/thumbs/t.jpg", "img/root.jpg", "img/Arundo_donax/b.jpg"):
        open(os.path.join(tmpdir_path, f), "wb").write(b"x")
    name = readers.config.MANIFEST_SOURCES[0]
    with open(os.path.join(folder, name), "w") as f:
        f.write("filepath,label,region,source,latitude,longitude,gbif_id\n./img/x/../Arundo_donax/a.jpg,Arundo donax,R,s,bad,1.5,7.0\n")
    (part,) = readers.read_manifests(spark, "file://" + folder)
    row = part.first()
    assert (row.latitude, row.longitude, row.gbif_id, row._rejected) == (None, 1.5, 7, "latitude=bad")
    tree = readers.scan_image_tree(spark, root, "local")
    assert sorted((r.filepath, r.label) for r in tree.collect()) == [("img/Arundo_donax/a.jpg", "Arundo donax"), ("img/Arundo_donax/b.jpg", "Arundo donax")]
    path = merge.normalize_paths(part, tmpdir_path).select("filepath").union(merge.normalize_paths(tree, tmpdir_path).select("filepath"))
    assert path.distinct().count() == 2
    odd = ["a/./b.jpg", "./a", "x/../a.jpg", "../a", "a/../../b", "/p/q/../r", "file:/p/a.jpg", "file:///p/a.jpg", "a..b/c.jpg", "C:\\d\\e.jpg"]
    got = merge.normalize_paths(spark.createDataFrame([(i, p) for i, p in enumerate(odd)], "i int, filepath string"), "/p").orderBy("i").collect()
    assert [r.filepath for r in got] == ["a/b.jpg", "a", "a.jpg", "../a", "../b", "r", "a.jpg", "a.jpg", "a..b/c.jpg", "C:/d/e.jpg"]


def test_species_table_columns_and_last_row(spark):
    from surveyspark.operators import decisions

    dim = spark.createDataFrame([("Arundo donax", "A", "low", "x", 1), ("arundo DONAX", "B", "urgent", None, 2), (None, "C", "c", "c", 3)],
                                "invasive string, native string, priority string, impacts string, row_ord int")
    df = spark.createDataFrame([(1, "ARUNDO donax"), (2, "Other"), (3, None)], "row_id long, predicted_class string")
    got = {r.row_id: r for r in decisions.species_lookup(df, dim).collect()}
    assert (got[1].native_comparison, got[1].priority, got[1].impacts, got[1].is_invasive) == ("B", "urgent", "", True)
    assert not got[2].is_invasive and got[3].priority is None and len(got) == 3


def test_retry_and_pending_with_ties_and_nulls(spark):
    from surveyspark.operators import worklog

    log = spark.createDataFrame([("u", "success", "2024-01-01 00:00:00", 1, "m"), ("u", "failed", "2024-01-01 00:00:00", 2, None), ("v", "success", "2024-01-01 00:00:00", 3, "m")],
                                "url string, status string, ts string, attempt_id long, md5 string").selectExpr(
        "url", "status", "cast(ts as timestamp_ntz) ts", "attempt_id", "md5", "'' as filepath", "'' as error")
    assert {r.url for r in worklog.latest_failed(log).collect()} == {r.url for r in worklog.retry_schedule(log).collect()} == {"u"}
    work = spark.createDataFrame([("u", "m", 5), ("v", None, 5), ("w", None, 0), ("x", "m", 5), ("v", "m", None)], "url string, expected_md5 string, bytes_on_disk long")
    assert sorted((r.url, r.bytes_on_disk) for r in worklog.pending_items(work, log).collect()) == [("v", None), ("w", 0), ("x", 5)]


def test_synthetic_generator_deterministic(spark):
    a = generate.synthetic_occurrences(spark, per_species=30)
    b = generate.synthetic_occurrences(spark, per_species=30, n_partitions=7)
    assert a.count() == 180
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    share = a.where(F.col("region") == "Lisboa").count() / 180
    assert 0.3 < share < 0.6


def test_random_params_deterministic(spark):
    g = {"learning_rate": [1e-5, 1e-4, 1e-3], "batch_size": [16, 32, 64]}
    a = sampling.random_params(spark, 20, g, seed=42).collect()
    b = sampling.random_params(spark, 20, g, seed=42).collect()
    assert a == b and all(r.batch_size in (16, 32, 64) for r in a)


def test_stream_equals_batch(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "req")
    rows = [(1, [1.0, 2.0, 0.5], None), (2, None, None), (3, [0.1, 0.1, 3.0], "0.99"), (4, [2.0, 1.0, 0.0], "x")]
    df = spark.createDataFrame(rows, scoring_stream.REQUEST_SCHEMA)
    df.write.parquet(src)
    sink = os.path.join(tmpdir_path, "out")
    q = scoring_stream.run_scoring_stream(spark, src, sink, ["a", "b", "c"],
                                          checkpoint=os.path.join(tmpdir_path, "ck"))
    q.awaitTermination(120)
    got = sorted((r.row_id, r.predicted_class, r.abstain, r.error) for r in spark.read.parquet(sink).collect())
    batch = scoring.score(df, ["a", "b", "c"], threshold_col="threshold_override")
    want = sorted((r.row_id, r.predicted_class, r.abstain, r.error) for r in batch.collect())
    assert got == want and len(got) == 4


def test_grid_search_and_train_folds(spark):
    feats = view(spark, SF_SMALL, "features").withColumn("group", (F.col("row_id") % 12).cast("string"))
    mdir = os.path.join(tempfile_dir(), "models")
    oof = tuning.train_folds(feats, n_folds=3, max_iter=5, model_dir=mdir)
    assert oof.count() == feats.count()
    from pyspark.ml.classification import LogisticRegressionModel
    assert LogisticRegressionModel.load(os.path.join(mdir, "fold=0")).numClasses == 10
    trials = tuning.grid_search(feats, n_classes=10, reg_params=(0.0, 0.5), max_iter=(5,), n_folds=3)
    assert trials.count() == 2
    assert tuning.top_trials(trials, 1).count() == 1
    for r in trials.collect():
        assert len(r.folds) == 3 and abs(sum(f.accuracy for f in r.folds) / 3 - r.accuracy) < 1e-9
        assert abs(sum(f.macro_f1 for f in r.folds) / 3 - r.macro_f1) < 1e-9
    per_fold = {r.fold: r.accuracy for r in tuning.fold_metrics(oof, 10).collect()}
    rows = oof.collect()
    assert per_fold == {k: pytest.approx(sum(r.label == r.pred for r in rows if r.fold == k) / sum(r.fold == k for r in rows)) for k in range(3)}
    # labels that depend on the features: a Newton fit in numpy gives the same predictions
    import numpy as np

    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(300, 3))
    y = (x @ [1.0, -2.0, 0.5] + rnd.normal(size=300) > 0).astype(int)
    frame = spark.createDataFrame([(i, x[i].tolist(), int(y[i]), int(i % 3)) for i in range(300)], "row_id long, embedding array<double>, label int, fold int")
    got = {r.row_id: r.pred for r in tuning.train_folds(frame, n_folds=3, max_iter=100).collect()}
    for k in range(3):
        tr, te = np.arange(300) % 3 != k, np.arange(300) % 3 == k
        a, w = np.column_stack([np.ones(300), x]), np.zeros(4)
        for _ in range(30):
            p = 1 / (1 + np.exp(-a[tr] @ w))
            w += np.linalg.solve((a[tr] * (p * (1 - p))[:, None]).T @ a[tr], a[tr].T @ (y[tr] - p))
        far = np.abs(a @ w) > 0.05
        assert all(got[i] == int(a[i] @ w > 0) for i in np.flatnonzero(te & far))


def test_occurrence_readers_mapping_and_fetch(spark, tmpdir_path):
    tsv = os.path.join(tmpdir_path, "occurrence.txt")
    header = "\t".join(readers.OCCURRENCE_FIELDS + ["decimalLatitude", "decimalLongitude"])
    good = "\t".join(["1", "k1", "o1", "Arundo donax L.", "Tracheophyta", "Plantae", "PT", "ds", "StillImage",
                      "http://x/1.jpg", "Lisboa", "", "38.7", "-9.1"])
    bad = "\t".join(["2", "k2", "o2", "Arundo donax", "Tracheophyta", "Plantae", "PT", "ds", "", "", "", "",
                     "not-a-number", "-9.1"])
    open(tsv, "w").write(header + "\n" + good + "\n" + bad + "\n")
    occ = readers.read_occurrences(spark, tsv).collect()
    assert len(occ) == 2 and occ[0]["_rejected"] is None and occ[1]["_rejected"] == "decimalLatitude=not-a-number"
    mixed = os.path.join(tmpdir_path, "mixed.tsv")
    with open(mixed, "w") as f:
        f.write("id\tscientificName\trights\tstateProvince\tdecimalLatitude\n7\tArundo donax L.\tcc\tLisboa\t38.7\n8\tx\t\t\t\n")
    rows = readers.read_occurrences(spark, mixed).orderBy("id").collect()
    assert [(r.id, r.gbifID, r.scientificName, r.stateProvince, r.decimalLatitude, r.key) for r in rows] == [
        ("7", "7", "Arundo donax L.", "Lisboa", 38.7, None), ("8", "8", "x", None, None, None)]
    for name, body in [("m.csv", "species,image_url\nA,u1\n"), ("m.tsv", "species\timage_url\nA\tu1\n"),
                       ("m.json", '[{"species": "A", "image_url": "u1"}]')]:
        p = os.path.join(tmpdir_path, name)
        open(p, "w").write(body)
        assert [tuple(r) for r in readers.read_mapping(spark, p).select("species", "image_url").collect()] == \
            [("A", "u1")]
    js = os.path.join(tmpdir_path, "dump.json")
    import json
    recs = [{"gbifID": "1", "scientificName": "Arundo donax", "datasetKey": "ds", "countryCode": "PT",
             "decimalLatitude": 38.7, "decimalLongitude": -9.1, "media": [{"type": "StillImage", "identifier": "u"}]},
            {"gbifID": "2", "scientificName": "Arundo donax", "datasetKey": "ds", "countryCode": "PT",
             "decimalLatitude": 38.7, "decimalLongitude": -9.1, "media": [{"type": "Sound", "identifier": "s"}]},
            {"gbifID": "3", "scientificName": "Arundo donax", "datasetKey": "ds", "countryCode": "ES",
             "decimalLatitude": 38.7, "decimalLongitude": -9.1, "media": [{"type": "StillImage", "identifier": "u"}]}]
    open(js, "w").write("\n".join(json.dumps(r) for r in recs))
    dump = readers.read_occurrences_json(spark, js)
    got = [r.gbifID for r in readers.fetch_occurrences(dump, "Arundo donax", "ds").collect()]
    assert got == ["1"]


def test_report_sink_and_required_columns(spark, tmpdir_path):
    import pytest

    from surveyspark.operators import decisions, quality
    df = spark.createDataFrame([(1, "Arundo donax", 0.95, False)],
                               "row_id long, predicted_class string, confidence double, abstain boolean")
    lines = decisions.report_lines(decisions.decide(df, decisions.species_dim(spark)))
    out = os.path.join(tmpdir_path, "report")
    sinks.write_report(lines, out)
    text = spark.read.text(out).collect()
    assert text[0].value == "=" * 70 and any("CRITICAL FINDINGS" in r.value for r in text)
    with pytest.raises(ValueError, match="label"):
        quality.require_columns(spark.createDataFrame([("x",)], "filepath string"), ["filepath", "label"])


def test_synthetic_file_names_unique_beyond_four_digits(spark):
    a = generate.synthetic_occurrences(spark, per_species=12_000, species=["Arundo donax"])
    assert a.select("filepath").distinct().count() == 12_000
    assert a.where(F.col("filepath").endswith("Arundo_donax_11999.jpg")).count() == 1


def test_random_search(spark):
    feats = view(spark, SF_SMALL, "features").withColumn("group", (F.col("row_id") % 12).cast("string"))
    trials = tuning.random_search(feats, n_classes=10, n_trials=2, seed=3)
    rows = trials.collect()
    assert len(rows) == 2 and all(0.0 <= r.macro_f1 <= 1.0 for r in rows)
