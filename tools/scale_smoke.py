"""Skew smoke test on a larger hash-generated manifest (no test data needed).

Builds N synthetic occurrences (district weights 45/25/10/8/7/5 %, so one
district and its cells are hot), adds a hot duplicated file path holding a
third of all rows and a third of rows without gbif ids, then runs merge ->
spatial groups -> folds -> audit. Spark's event log (written to a scratch
folder) gives per-stage task record counts; the script prints wall time and
the worst max/median task ratio so a hot key landing in one task shows up.

usage: python tools/scale_smoke.py [rows] [cpus]
"""
import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from surveyspark.operators import decisions, folds, merge, quality, scoring, spatial  # noqa: E402
from surveyspark.session import get_spark  # noqa: E402
from surveyspark.sources.generate import synthetic_occurrences  # noqa: E402


def main():
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    cpus = sys.argv[2] if len(sys.argv) > 2 else "8"
    scratch = tempfile.mkdtemp(prefix="surveyspark-scale-")
    logdir = os.path.join(scratch, "events")
    os.makedirs(logdir)
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=32,
                      extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
                             "spark.eventLog.compress": "false",
                             "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                             "spark.driver.memory": "8g"})
    per_species = max(1, n // 6)
    base = synthetic_occurrences(spark, per_species=per_species, n_partitions=32)
    df = (base.withColumn("row_ord", F.monotonically_increasing_id())
              .withColumn("src_ord", F.lit(0))
              .withColumn("gbif_id", F.when(F.col("row_ord") % 3 == 0, F.lit(None))
                          .otherwise(F.col("row_ord") - F.col("row_ord") % 2))
              .withColumn("filepath", F.when(F.col("row_ord") % 3 == 1, F.lit("hot/duplicated.jpg"))
                          .otherwise(F.col("filepath")))
              .withColumn("status", F.lit("native")))
    t0 = time.time()
    merged = merge.merge_manifests(df, spatial.macro_map_df(spark), min_grid=15, min_district=30)
    assigned = folds.assign_folds(merged, 5)
    sizes = folds.fold_sizes(assigned).collect()
    report = quality.audit_manifest(assigned).first()
    wall = time.time() - t0

    # scoring leg: n rows of 10 hash-generated logits -> predictions -> decisions -> report lines
    t1 = time.time()
    logits = spark.range(0, n, numPartitions=32).select(
        F.col("id").alias("row_id"),
        F.transform(F.sequence(F.lit(0), F.lit(9)),
                    lambda i: (F.pmod(F.xxhash64(F.col("id"), i), F.lit(10_000)) / 1000.0)).alias("logits"))
    classes = [f"class_{i}" for i in range(10)]
    scored = scoring.score(logits, classes, 0.15).select("row_id", "predicted_class", "confidence", "abstain")
    inv = spark.createDataFrame([("class_1", None), ("class_2", None)], "invasive string, native string")
    dec = decisions.decide(scored, inv, threshold=0.2, critical=0.3)
    levels = {r.risk_level: r.n for r in decisions.risk_summary(dec, decisions.level_dim(spark)).collect()}
    n_lines = decisions.report_lines(dec).count()
    score_wall = time.time() - t1
    spark.stop()

    worst = (0.0, None)
    for path in [p for p in glob.glob(os.path.join(logdir, "**", "*"), recursive=True) if os.path.isfile(p)]:
        stages = {}
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerTaskEnd":
                    continue
                m = ev.get("Task Metrics") or {}
                recs = (m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                        + m.get("Input Metrics", {}).get("Records Read", 0))
                stages.setdefault(ev["Stage ID"], []).append(recs)
        for sid, recs in stages.items():
            if len(recs) >= 4 and sum(recs) > n // 10:
                med = statistics.median(recs) or 1
                ratio = max(recs) / med
                if ratio > worst[0]:
                    worst = (ratio, (sid, max(recs), med, len(recs)))
    print(json.dumps({"rows": n, "wall_sec": round(wall, 1), "merged_rows": report.n_rows,
                      "fold_shares": sorted(round(r.share, 3) for r in sizes),
                      "worst_stage_max_over_median_records": round(worst[0], 2), "worst_stage": worst[1],
                      "scoring_wall_sec": round(score_wall, 1), "risk_levels": levels, "report_lines": n_lines}))


if __name__ == "__main__":
    main()
