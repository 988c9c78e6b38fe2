"""Streams that outlive bad files and replayed batches; states that equal the batch result."""
import os
import random

from pyspark.sql import functions as F

from surveyspark.operators import scoring, worklog
from surveyspark.plans.fixtures import view
from surveyspark.streaming import attempt_stream, scoring_stream

from .conftest import SF_SMALL

CLASSES = ["a", "b", "c"]


def test_scoring_goes_on_after_bad_files(spark, tmpdir_path):
    src, sink, check = (os.path.join(tmpdir_path, n) for n in ("in", "out", "check"))
    r = random.Random(1)
    rows = [(i, [r.random() for _ in range(3)], r.choice([None, "0.4", "x"])) for i in range(90)]
    df = spark.createDataFrame(rows, scoring_stream.REQUEST_SCHEMA)
    df.repartition(3).write.parquet(src)
    good = [f for f in os.listdir(src) if f.endswith(".parquet")]
    whole = open(os.path.join(src, good[0]), "rb").read()
    open(os.path.join(src, "cut.parquet"), "wb").write(whole[:len(whole) // 2])
    open(os.path.join(src, "text.parquet"), "w").write("no parquet")
    open(os.path.join(src, "empty.parquet"), "w").write("")  # holds no request
    other = os.path.join(tmpdir_path, "other")
    df.select("row_id").coalesce(1).write.parquet(other)
    os.rename(*(os.path.join(d, n) for d, n in ((other, next(f for f in os.listdir(other) if f.endswith(".parquet"))), (src, "columns.parquet"))))

    def run():
        q = scoring_stream.run_scoring_stream(spark, src, sink, CLASSES, check, max_files_per_trigger=3)
        q.awaitTermination(300)
        assert q.exception() is None

    run()
    cols = ["row_id", "predicted_class", "abstain", "error"]
    want = sorted(map(str, scoring.score(df, CLASSES, threshold_col="threshold_override").select(*cols).collect()))
    assert sorted(map(str, spark.read.parquet(sink).select(*cols).collect())) == want
    dead = {os.path.basename(x.path): x.error for x in spark.read.parquet(sink + "_dead").collect()}
    assert set(dead) == {"cut.parquet", "text.parquet", "columns.parquet"} and all(dead.values())
    # new files go on from the checkpoint, and a batch done again adds nothing
    spark.createDataFrame([(1000, [0.0, 9.0, 0.0], None)], scoring_stream.REQUEST_SCHEMA).write.mode("append").parquet(src)
    run()
    assert spark.read.parquet(sink).count() == 91
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(src)
    scoring_stream.score_files(files, 0, sink + "2", sink + "2_dead", CLASSES, 0.5)
    scoring_stream.score_files(files, 0, sink + "2", sink + "2_dead", CLASSES, 0.5)
    assert spark.read.parquet(sink + "2").count() == 91 and spark.read.parquet(sink + "2_dead").count() == 3


def test_large_files_are_dead_letters(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(scoring_stream, "MOST_BYTES", 10)
    src, sink = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "out")
    spark.createDataFrame([(1, [1.0], None)], scoring_stream.REQUEST_SCHEMA).coalesce(1).write.parquet(src)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(src)
    scoring_stream.score_files(files, 0, sink, sink + "_dead", CLASSES, 0.5)
    assert spark.read.parquet(sink).count() == 0
    assert "more than 10" in spark.read.parquet(sink + "_dead").first().error


def test_states_equal_the_whole_log(spark, tmpdir_path):
    src, sink, check = (os.path.join(tmpdir_path, n) for n in ("log", "state", "check"))
    cols = [c.split()[0] for c in attempt_stream.LOG_SCHEMA.split(", ")]
    log = view(spark, SF_SMALL, "status_log").withColumn("ts", F.col("ts").cast("timestamp_ntz")).select(*cols)
    hard = [("u", s, t, i, None, None, "e" if s == "failed" else None) for i, (s, t) in enumerate(
        [("failed", 1), ("failed", 2), ("success", 3), ("failed", 5), ("failed", 4), ("failed", 6)])]
    hard += [("v", "failed", t, t, None, None, "e") for t in range(1, 9)] + [("w", "failed", 1, 1, None, None, "e"), ("w", "success", 1, 2, "f", "m", None)]
    made = spark.createDataFrame(hard, "url string, status string, t long, attempt_id long, filepath string, md5 string, error string")
    made = made.withColumn("ts", F.timestamp_add("SECOND", "t", F.lit("2024-05-01 00:00:00").cast("timestamp_ntz"))).select(*cols)
    log = log.union(made).persist()
    parts = log.withColumn("p", F.pmod(F.xxhash64("attempt_id", "url"), F.lit(4)))  # out of order
    for p in range(4):
        parts.where(F.col("p") == p).drop("p").coalesce(1).write.mode("append").parquet(src)
        if p in (1, 3):  # stopped and started again in between
            q = attempt_stream.run_attempt_stream(spark, src, sink, check, max_files_per_trigger=1)
            q.awaitTermination(300)
            assert q.exception() is None
    states = attempt_stream.tracked(spark, sink).persist()
    key = lambda df: sorted(map(str, df.collect()))
    names = ["url", "status", "ts", "filepath", "md5", "error"]
    assert key(states.select(*names)) == key(worklog.latest_status(log).select(*names))
    names = ["url", "n_failures", "delay_s", "next_attempt_epoch"]
    assert key(attempt_stream.tracked_schedule(states).select(*names)) == key(worklog.retry_schedule(log).select(*names))
