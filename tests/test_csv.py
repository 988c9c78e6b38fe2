"""CSV records across splits, against Python's csv module and pandas; result sets as units."""
import csv
import io
import os
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from surveyspark.sources import readers, sinks
from surveyspark.sources.csv_records import NA_TEXTS, csv_records, ends_inside, read_csv, split_fields


def _field(r):
    kind = r.random()
    if kind < 0.3:
        return "".join(r.choice('ab,"\n ') for _ in range(r.randint(0, 30)))
    if kind < 0.35:
        return "two\r\nlines"
    return r.choice(["Arundo donax", 'Arundo "x" donax', "x", "", "NA", "5 pots", "ß,é"])


def test_states_and_fields_match_the_csv_module():
    r = random.Random(2)
    for _ in range(3000):
        row = [_field(r) for _ in range(r.randint(1, 4))]
        out = io.StringIO()
        csv.writer(out, lineterminator="\n", quoting=r.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL])).writerow(row)
        record = out.getvalue()[:-1]
        assert [x or "" for x in split_fields(record, ",", frozenset([""]))] == row
        inside = False
        for i, line in enumerate(record.split("\n")):
            assert inside == (i > 0)
            inside = ends_inside(line, inside, ",")
        assert not inside
    assert not ends_inside('5" pot,x', False, ",") and split_fields('5" pot,x', ",", frozenset()) == ['5" pot', "x"]


@pytest.mark.parametrize("split", [64, 300, 5000])
def test_records_across_splits(spark, tmpdir_path, split):
    r = random.Random(split)
    rows = [[str(i)] + [_field(r) for _ in range(3)] for i in range(400)]
    rows[7][1] = "long " * 300 + "\n" * 200  # a record over many splits
    path = os.path.join(tmpdir_path, "m.csv")
    with open(path, "w", newline="") as f:
        csv.writer(f, lineterminator="\n").writerows([["i", "a", "b", "c"]] + rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        df = read_csv(spark, path, order=True)
        got = df.orderBy("row_ord").collect()
        assert df.rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = pd.read_csv(path, dtype=str).astype(object).where(lambda d: d.notna(), None)
    assert [tuple(x)[:4] for x in got] == [tuple(x) for x in want.itertuples(index=False)]


def test_manifest_with_quotes_and_line_breaks(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "q.csv")
    open(path, "w").write('filepath,label,region,source,gbif_id\r\nx/1.jpg,"Arundo ""x"" donax","two\nlines",s,12.0\r\n\r\nx/2.jpg,B,NA,s\r\n')
    got = readers.read_manifest(spark, path).orderBy("row_ord").collect()
    assert [(x.filepath, x.label, x.region, x.gbif_id) for x in got] == [("x/1.jpg", 'Arundo "x" donax', "two\nlines", 12), ("x/2.jpg", "B", None, None)]
    assert readers.read_mapping(spark, path).count() == 2
    assert "NA" in NA_TEXTS


def test_odd_files(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "o.csv")
    open(path, "w").write('a,b\n1,"never closed\n2,x\n')
    with pytest.raises(ValueError, match="never closed"):
        csv_records(spark, path)
    open(path, "w").write("")
    assert read_csv(spark, path).columns == []
    open(path, "w").write("﻿a,b\n")
    df = read_csv(spark, path)
    assert df.columns == ["a", "b"] and df.count() == 0
    open(os.path.join(tmpdir_path, "p.csv"), "w").write("b,a\n1,2\n")
    with pytest.raises(ValueError, match="different headers"):
        read_csv(spark, tmpdir_path)


def test_newest_result_set_is_read_whole(spark, tmpdir_path):
    rows = spark.range(100).select(F.col("id").cast("int").alias("id"), F.format_string('say "%d"\nagain', "id").alias("v"))
    sinks.write_table(rows.where("id < 50"), os.path.join(tmpdir_path, "r1"), fmt="csv")
    time.sleep(1.1)
    sinks.write_table(rows.repartition(4).union(rows.limit(0)), os.path.join(tmpdir_path, "r2"), fmt="csv")
    glob = os.path.join(tmpdir_path, "r*")
    assert {r.location.rsplit("/", 1)[1]: r.parts for r in readers.result_sets(spark, glob).collect()}["r2"] >= 4
    got = readers.latest_results(spark, glob, schema="id int, v string, absent double").collect()
    assert sorted((x.id, x.v, x.absent) for x in got) == [(i, f'say "{i}"\nagain', None) for i in range(100)]
    time.sleep(1.1)
    open(os.path.join(tmpdir_path, "r9.csv"), "w").write("id,v\n7,x\n")
    assert [x.id for x in readers.latest_results(spark, tmpdir_path).collect()] == ["7"]
    with pytest.raises(FileNotFoundError):
        readers.latest_results(spark, os.path.join(tmpdir_path, "r1"), schema="id int") and readers.latest_results(spark, _empty(tmpdir_path))


def _empty(base):
    path = os.path.join(base, "none")
    os.makedirs(path)
    return path
