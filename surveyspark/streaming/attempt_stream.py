"""The download log as a stream: the state of each url kept as attempts arrive.

A url's state is its last attempt, the time of its last success and the failures
after it, of which no more are kept than a url may have before it is given up
(the schedule needs no higher number). Attempts may arrive in any order and in
any batches: the state depends on the set of attempts alone, so the table of
last states equals :func:`operators.worklog.latest_status` and
:func:`operators.worklog.retry_schedule` on the whole log, without rereading it.

Each batch writes the states it changed under its own number, in place of an
earlier try; the latest batch of a url counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import config

LOG_SCHEMA = "url string, status string, ts timestamp_ntz, attempt_id bigint, filepath string, md5 string, error string"
_STATE = "micros bigint, attempt_id bigint, status string, filepath string, md5 string, error string, ok_micros bigint, ok_id bigint, fail_micros array<bigint>, fail_ids array<bigint>"
_OUT = "url string, status string, micros bigint, attempt_id bigint, filepath string, md5 string, error string, n_failures bigint"


def _none(v):
    return None if v is None or v is pd.NaT or (isinstance(v, float) and v != v) else v


def _tracker(max_attempts: int):
    def track(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, ok, fails = None, None, []
        if state.exists:
            s = state.get
            last = (s[0], s[1], *s[2:6])
            ok = (s[6], s[7]) if s[6] is not None else None
            fails = list(zip(s[8], s[9]))
        for part in parts:
            for r in part.itertuples(index=False):
                at = (int(r.micros), int(r.attempt_id))
                if last is None or at >= last[:2]:
                    last = (*at, *(_none(v) for v in (r.status, r.filepath, r.md5, r.error)))
                if r.status == "success":
                    ok = max(ok, at) if ok else at
                elif r.status == "failed":
                    fails.append(at)
        fails = sorted(f for f in fails if ok is None or f > ok)[-max_attempts:]
        state.update((*last, *(ok or (None, None)), [f[0] for f in fails], [f[1] for f in fails]))
        yield pd.DataFrame([(key[0], last[2], last[0], last[1], *last[3:], len(fails))], columns=[c.split()[0] for c in _OUT.split(", ")])
    return track


def run_attempt_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str, max_attempts: int = config.RETRY_MAX_ATTEMPTS,
                       available_now: bool = True, max_files_per_trigger: int = 1000):
    """Follow the log's new Parquet files in ``source_dir``; changed states go to ``sink_dir/batch=<n>``. Attempts
    without a url, a time or an id are no attempts."""
    log = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir)
    log = log.where("url is not null and ts is not null and attempt_id is not null").withColumn(
        "micros", F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))).drop("ts")
    states = log.groupBy("url").applyInPandasWithState(_tracker(max_attempts), _OUT, _STATE, "update", GroupStateTimeout.NoTimeout)

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{sink_dir}/batch={batch}")

    w = states.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()


def tracked(spark: SparkSession, sink_dir: str) -> DataFrame:
    """``(url, status, ts, filepath, md5, error, n_failures)``: the state of every url by its latest batch."""
    rows = spark.read.parquet(sink_dir)
    last = rows.groupBy("url").agg(F.max_by(F.struct("status", "micros", "filepath", "md5", "error", "n_failures"), "batch").alias("s"))
    ts = F.timestamp_add("MICROSECOND", F.col("s.micros"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return last.select("url", "s.status", ts.alias("ts"), "s.filepath", "s.md5", "s.error", "s.n_failures")


def tracked_schedule(states: DataFrame, initial: float = config.RETRY_INITIAL, factor: float = config.RETRY_FACTOR,
                     max_delay: float = config.RETRY_MAX_DELAY, max_attempts: int = config.RETRY_MAX_ATTEMPTS) -> DataFrame:
    """The retry schedule of tracked states, as ``worklog.retry_schedule`` has it."""
    delay = F.least(F.lit(initial) * F.pow(F.lit(factor), F.col("n_failures") - 1), F.lit(max_delay))
    epoch = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")) / 1e6
    return states.where((F.col("status") == "failed") & (F.col("n_failures") < max_attempts)).select(
        "url", "n_failures", delay.alias("delay_s"), (epoch + delay).alias("next_attempt_epoch"))
