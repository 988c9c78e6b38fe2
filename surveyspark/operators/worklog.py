"""Download bookkeeping as tables: an append-only attempt log
``(url, status, ts, attempt_id, filepath, md5, error)`` replaces the
reference's in-place JSON map. Latest state per url is an aggregation
(``max_by`` with partial combine), never a per-url loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config


def latest_status(log: DataFrame) -> DataFrame:
    """Last attempt per url (by ``ts``, then ``attempt_id``)."""
    order = F.struct("ts", "attempt_id")
    return log.groupBy("url").agg(
        F.max_by(F.struct("status", "ts", "filepath", "md5", "error"), order).alias("last")
    ).select("url", "last.*")


def latest_failed(log: DataFrame) -> DataFrame:
    """Urls whose last attempt failed."""
    return latest_status(log).where(F.col("status") == "failed")


def retry_schedule(log: DataFrame, initial: float = config.RETRY_INITIAL, factor: float = config.RETRY_FACTOR,
                   max_delay: float = config.RETRY_MAX_DELAY,
                   max_attempts: int = config.RETRY_MAX_ATTEMPTS) -> DataFrame:
    """For urls whose last attempt failed: failures since the last success, the
    back-off delay ``min(initial * factor^(failures-1), max_delay)`` and the next
    attempt time; urls out of attempts are dropped."""
    per_url = log.groupBy("url").agg(
        F.max(F.when(F.col("status") == "success", F.struct("ts", "attempt_id"))).alias("last_ok"),
        F.max_by("status", F.struct("ts", "attempt_id")).alias("last_status"),
        F.max("ts").alias("last_ts"))
    failing = per_url.where(F.col("last_status") == "failed")
    fails = (log.where(F.col("status") == "failed").join(failing, "url")
                .where(F.col("last_ok").isNull() | (F.struct("ts", "attempt_id") > F.col("last_ok")))
                .groupBy("url", "last_ts").agg(F.count(F.lit(1)).alias("n_failures")))
    delay = F.least(F.lit(initial) * F.pow(F.lit(factor), F.col("n_failures") - 1), F.lit(max_delay))
    return (fails.where(F.col("n_failures") < max_attempts)
                 .select("url", "n_failures", delay.alias("delay_s"),
                         (_epoch_seconds(F.col("last_ts")) + delay).alias("next_attempt_epoch")))


def _epoch_seconds(ts) -> F.Column:
    """Seconds since 1970-01-01 of a wall-clock (time-zone-free) timestamp, whatever the session zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, ts.cast("timestamp_ntz")) / 1e6


def pending_items(work: DataFrame, log: DataFrame) -> DataFrame:
    """Work items not yet done: an empty file on disk, or an expected checksum that no successful download
    has. An item without an expected checksum is done when its file is there and not empty."""
    done = (log.where((F.col("status") == "success") & F.col("md5").isNotNull())
               .select(F.col("url").alias("_url"), F.col("md5").alias("_md5")).distinct())
    there = F.coalesce(F.col("bytes_on_disk") > 0, F.lit(False))
    asked = work.where(~there | F.col("expected_md5").isNotNull())
    return asked.join(done, (asked["url"] == done["_url"]) & (asked["expected_md5"] == done["_md5"]) & there, "left_anti")
