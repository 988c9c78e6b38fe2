"""Property checks against plain Python/numpy on random (seeded) inputs, including hot keys."""
import random

import pytest

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from surveyspark.operators import merge, quantiles


def test_exact_quantile_matches_numpy_with_hot_values(spark):
    rnd = random.Random(7)
    rows = []
    for g in ["a", "b", "c"]:
        n = rnd.randint(1, 3000)
        for i in range(n):
            v = 0.75 if (g == "a" and i % 3 == 0) else round(rnd.random(), rnd.choice([2, 6, 12]))
            rows.append((g, v))
    rows += [("c", float("nan")), ("d", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    for q in (0.25, 0.5, 0.9):
        got = {r.g: r.quantile for r in quantiles.exact_quantile(df, "v", q, ["g"]).collect()}
        pdf = pd.DataFrame(rows, columns=["g", "v"]).dropna()
        for g, vs in pdf.groupby("g")["v"]:
            assert abs(got[g] - float(np.percentile(vs.to_numpy(), q * 100))) < 1e-12, (g, q)
    one = quantiles.exact_quantile(df.where("g = 'b'"), "v", 0.25).first()
    assert one.n == sum(1 for g, v in rows if g == "b")


def test_keep_first_matches_pandas_drop_duplicates(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(2000):
        # one key holds about a third of the rows
        key = "hot.jpg" if rnd.random() < 0.33 else f"f{rnd.randint(0, 400)}.jpg"
        rows.append((rnd.randint(0, 3), i, key, rnd.choice(["s1", "s2", None]),
                     rnd.choice([None, rnd.randint(0, 50)]), f"label{i % 7}"))
    cols = ["src_ord", "row_ord", "filepath", "source", "gbif_id", "label"]
    df = spark.createDataFrame(rows, "src_ord int, row_ord long, filepath string, source string, "
                                     "gbif_id long, label string")
    got = sorted(map(tuple, merge.deduplicate(df).select(*cols).collect()), key=lambda r: (r[0], r[1]))
    pdf = pd.DataFrame(rows, columns=cols).sort_values(["src_ord", "row_ord"])
    pdf = pdf.drop_duplicates(subset=["filepath"])
    keyed = pdf["source"].notna() & pdf["gbif_id"].notna()
    dup = pdf[keyed].duplicated(subset=["source", "gbif_id"], keep="first")
    pdf = pdf.drop(index=dup[dup].index)
    want = sorted(((int(a), int(b), c, d if isinstance(d, str) else None,
                    None if pd.isna(e) else int(e), f) for a, b, c, d, e, f in pdf.itertuples(index=False)),
                  key=lambda r: (r[0], r[1]))
    assert got == want


def test_grid_cell_partition_independent(spark):
    from surveyspark.functions.spatial import grid_cell
    rnd = random.Random(11)
    df = spark.createDataFrame([(i, rnd.uniform(30, 45), rnd.uniform(-20, 0)) for i in range(3000)],
                               "id long, lat double, lon double")
    a = {r.id: r.c for r in df.select("id", grid_cell(F.col("lat"), F.col("lon")).alias("c")).collect()}
    b = {r.id: r.c for r in df.repartition(13).select("id", grid_cell(F.col("lat"), F.col("lon")).alias("c")).collect()}
    assert a == b


def test_distributed_rank_matches_window(spark):
    from pyspark.sql import Window

    from surveyspark.operators.folds import distributed_rank
    rnd = random.Random(5)
    rows = [(f"g{i}", rnd.choice(["A"] * 8 + ["B", "C"]), rnd.randint(1, 50)) for i in range(5000)]
    df = spark.createDataFrame(rows, "grp string, dom string, size long").repartition(9)
    order = [F.col("size").desc(), F.col("grp").asc()]
    got = {r.grp: r.rn for r in distributed_rank(df, "dom", order).collect()}
    want = {r.grp: r.rn for r in df.withColumn(
        "rn", F.row_number().over(Window.partitionBy("dom").orderBy(*order)) - 1).collect()}
    assert got == want


def test_left_join_spread_nulls_keeps_rows(spark):
    from surveyspark.operators.joins import join_by_prefix, left_join_spread_nulls
    big = spark.createDataFrame([(i, i % 7 if i % 3 else None) for i in range(3000)], "id long, k long")
    small = spark.createDataFrame([(k, f"v{k}") for k in range(5)], "k long, v string")
    a = {tuple(r) for r in big.join(small, "k", "left").collect()}
    c = {(r.id, r.k, r.v) for r in left_join_spread_nulls(big, small, "k").collect()}
    assert c == {(r[1], r[0], r[2]) for r in a}
    names = spark.createDataFrame([("Ab",), ("Abc",), ("X",), ("",), (None,), ("Long name",)], "species string")
    got = join_by_prefix(spark.createDataFrame([("Abcd",), ("Ab",), ("A",), (None,), ("Xy",)], "n string"), names, "n", "species")
    assert sorted(tuple(r) for r in got.collect()) == [("Ab", "Ab"), ("Abcd", "Ab"), ("Abcd", "Abc"), ("Xy", "X")]


@pytest.mark.parametrize("reuse,aqe", [("true", "true"), ("false", "true"), ("false", "false")])
def test_folds_of_many_groups_whatever_the_plan(spark, reuse, aqe):
    from pyspark.sql import Window

    from surveyspark.operators.folds import distributed_rank
    for k, v in (("spark.sql.exchange.reuse", reuse), ("spark.sql.adaptive.enabled", aqe)):
        spark.conf.set(k, v)
    try:
        df = spark.range(300_000).select(F.concat(F.lit("g"), F.col("id")).alias("grp"),
                                         F.when(F.col("id") % 10 < 8, "A").when(F.col("id") % 10 < 9, "B").alias("dom"),
                                         (F.xxhash64("id") % 50).alias("size"))
        order = [F.col("size").desc(), F.col("grp").asc()]
        want = df.withColumn("want", F.row_number().over(Window.partitionBy("dom").orderBy(*order)) - 1).select("grp", "want")
        got = distributed_rank(df, "dom", order).join(want, "grp")
        assert got.where("rn <> want").count() == 0 and got.count() == 300_000
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_exact_quantile_with_infinities_and_wide_ranges(spark):
    import math

    inf = float("inf")
    rows = [("a", v) for v in (-inf, 1.0, 2.0, inf)] + [("b", v) for v in (-1.7e308, -1.0, 0.0, 5e-324, 1.7e308)] + [("c", -inf)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r.g, q): r.quantile for q in (0.0, 0.25, 0.5, 1.0) for r in quantiles.exact_quantile(df, "v", q, ["g"]).collect()}
    assert got[("a", 0.0)] == -inf and got[("a", 0.5)] == 1.5 and got[("a", 1.0)] == inf and got[("c", 0.5)] == -inf
    assert got[("b", 0.25)] == -1.0 and got[("b", 0.5)] == 0.0 and got[("b", 1.0)] == 1.7e308
    assert math.isnan(got[("a", 0.25)])  # as numpy has it: -inf and a finite value
