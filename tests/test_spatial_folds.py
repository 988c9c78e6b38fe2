"""Spatial blocking and folds: edge values, hierarchy, leakage, balance (synthetic 1,336-row frame)."""
import random

from pyspark.sql import functions as F

from surveyspark.functions.spatial import floor_bin_text
from surveyspark.operators import folds, merge, spatial


def py_bin(x, s=0.2):
    return str(round((x // s) * s, 2))


def test_floor_bin_matches_python_floor_division(spark):
    vals = [0.0, 0.2, 0.4, 0.6, 38.6, 38.8, -9.2, -9.4, 39.0, -0.2, 1.0, 37.4, 41.2, -16.8, 0.19999, 38.59999999]
    rnd = random.Random(1)
    vals += [round(rnd.uniform(-20, 45), rnd.choice([1, 2, 5])) for _ in range(400)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {r.x: r.t for r in df.select("x", floor_bin_text(F.col("x"), 0.2).alias("t")).collect()}
    bad = [(v, got[v], py_bin(v)) for v in vals if got[v] != py_bin(v) and py_bin(v) != "-0.0"]
    assert not bad, bad[:5]


def spatial_frame(spark):
    """8 districts, 800/500/8/5/12/3/2/6 rows, metros jittered widely."""
    rnd = random.Random(42)
    spec = [("Lisboa", 38.72, -9.14, 800, 0.35), ("Porto", 41.15, -8.61, 500, 0.30),
            ("Faro", 37.02, -7.93, 8, 0.03), ("Braga", 41.55, -8.42, 5, 0.03),
            ("Setúbal", 38.52, -8.89, 12, 0.03), ("Madeira", 32.65, -16.9, 3, 0.03),
            ("Beja", 38.0, -7.86, 2, 0.03), ("Évora", 38.57, -7.9, 6, 0.03)]
    rows, i = [], 0
    for name, lat, lon, n, j in spec:
        labels = ["A", "B", "C", "D", "E"] if n >= 100 else ["A", "B", "C"]
        for _ in range(n):
            rows.append((i, f"f{i}.jpg", labels[i % len(labels)], name, "synthetic",
                         lat + rnd.uniform(-j, j), lon + rnd.uniform(-j, j)))
            i += 1
    return spark.createDataFrame(rows, "row_id long, filepath string, label string, region string, source string, "
                                       "latitude double, longitude double")


def test_hierarchy_splits_dominant_district_and_sends_sparse_to_macro(spark):
    df = spatial_frame(spark)
    g = spatial.group_with_no_coords(df, spatial.macro_map_df(spark))
    lis = {r.group for r in g.where(F.col("region") == "Lisboa").select("group").distinct().collect()}
    assert len(lis) > 1
    sparse = {r.group for r in g.where(F.col("region").isin("Beja", "Madeira")).select("group").distinct().collect()}
    assert all(x.startswith("macro:") for x in sparse)
    assert "macro:Sul" in sparse and "macro:Ilhas" in sparse


def test_no_coords_rows_keep_district_counts(spark):
    rows = [(i, "Lisboa", None if i < 20 else 38.7, -9.1) for i in range(40)]
    df = spark.createDataFrame(rows, "row_id long, region string, latitude double, longitude double") \
        .withColumn("source", F.lit("s"))
    g = spatial.group_with_no_coords(df, spatial.macro_map_df(spark), min_grid=100, min_district=30)
    got = {r.row_id: r.group for r in g.collect()}
    assert got[0] == "no_coords:s:Lisboa"
    assert got[30] == "district:Lisboa"  # 40 rows counted, coords or not


def test_folds_disjoint_balanced_and_fold_zero_exists(spark):
    df = spatial_frame(spark)
    g = spatial.group_with_no_coords(df, spatial.macro_map_df(spark))
    a = folds.assign_folds(g, 5)
    assert a.count() == df.count()
    leak = folds.fold_leakage(a, 5).collect()
    assert all(r.n_shared == 0 for r in leak)
    sizes = {r.fold: r.share for r in folds.fold_sizes(a).collect()}
    assert set(sizes) == {0, 1, 2, 3, 4}
    assert max(sizes.values()) < 0.45
    assert folds.comparison_split(a, 0).count() > 0
    assert folds.choose_n_folds_value(g, 5) == 5


def test_keep_first_survivor_and_null_keys(spark):
    rows = [(1, 0, "a.jpg", "s", 10), (0, 5, "a.jpg", "s", 11), (1, 1, "b.jpg", "s", 10),
            (1, 2, "c.jpg", "s", None), (1, 3, "d.jpg", "s", None), (1, 4, "e.jpg", None, 12),
            (1, 6, "f.jpg", "s", 11)]
    df = spark.createDataFrame(rows, "src_ord int, row_ord long, filepath string, source string, gbif_id long")
    out = {(r.filepath, r.src_ord) for r in merge.deduplicate(df).collect()}
    # a.jpg: the src 0 copy wins; f.jpg repeats its (s, 11) key later and goes;
    # b.jpg's key (s, 10) is unique once a.jpg's other copy is gone; null keys all stay
    assert out == {("a.jpg", 0), ("b.jpg", 1), ("c.jpg", 1), ("d.jpg", 1), ("e.jpg", 1)}


def test_no_row_is_lost_without_label_or_group(spark):
    rows = [(i, f"g{i % 9}" if i % 5 else None, ("x", "y", None)[i % 3]) for i in range(65)] + [(100 + i, "unlabelled", None) for i in range(5)]
    df = spark.createDataFrame(rows, "row_id long, group string, label string")
    a = folds.assign_folds(df, 3)
    assert a.count() == 70 and a.where("fold is null").count() == 0
    assert all(r.n_shared == 0 for r in folds.fold_leakage(a, 3).collect())
    h = folds.fold_hist(df, 3)
    assert sorted(map(tuple, folds.fold_sizes(h).collect())) == sorted(map(tuple, folds.fold_sizes(a).collect()))


def test_nan_coordinates_are_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame([(nan, 1.0), (1.0, nan), (None, 1.0), (1.0, 1.0)], "latitude double, longitude double") \
        .withColumn("region", F.lit("R")).withColumn("source", F.lit("s"))
    g = spatial.group_with_no_coords(df, spatial.macro_map_df(spark))
    assert g.where("grid_cell = 'no_coords' and group = 'no_coords:s:R'").count() == 3


def test_floor_bin_on_cell_edges_and_neighbours(spark):
    import math
    vals = []
    for k in range(-450, 451):
        e = k * 0.2
        vals += [e, math.nextafter(e, math.inf), math.nextafter(e, -math.inf), round(e, 1), round(e, 2)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {r.x: r.t for r in df.select("x", floor_bin_text(F.col("x"), 0.2).alias("t")).collect()}
    bad = [(v, got[v], py_bin(v)) for v in vals if got[v] != py_bin(v) and py_bin(v) != "-0.0"]
    assert not bad, bad[:5]
