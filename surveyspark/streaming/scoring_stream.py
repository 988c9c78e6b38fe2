"""Streaming scoring job: the request-at-a-time prediction endpoint re-aimed as
Structured Streaming.

New files of ``(row_id, logits, threshold_override)`` are scored with the same
column functions as batch scoring; a bad threshold or bad logits become an error
record. The stream also outlives files that cannot be read: it takes files as
bytes, parses each inside a task, and a file that is cut off, no Parquet, without
the columns or larger than ``MOST_BYTES`` becomes one row of a dead-letter table. (An
empty file holds no request and leaves no trace: Spark does not open it.)

A batch is written under its own number in place of what an earlier try of the
same batch left, so a replayed batch adds nothing. Each stream has a checkpoint
folder of its own in shared storage, so a restarted driver resumes where it left
off and a lost executor only re-runs its tasks.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators import scoring

REQUEST_SCHEMA = "row_id bigint, logits array<double>, threshold_override string"
_ARROW = pa.schema([("row_id", pa.int64()), ("logits", pa.list_(pa.float64())), ("threshold_override", pa.string())])
#: Request files are read whole by a task; larger ones go to the dead letters unread.
MOST_BYTES = 256 << 20
OUT_COLUMNS = ["row_id", "success", "predicted_class", "confidence", "abstain", "top_3", "threshold_used", "error"]


def scored_stream(spark: SparkSession, source_dir: str, classes,
                  threshold: float = config.PREDICTOR_THRESHOLD, max_files_per_trigger: int = 1000) -> DataFrame:
    """Scores as a streaming DataFrame, for files that are known to be readable."""
    requests = (spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
                .parquet(source_dir))
    return scoring.score(requests, classes, threshold, threshold_col="threshold_override").select(*OUT_COLUMNS)


def _parsed(batches):
    """The requests of each file, or one row with the reason why it cannot be read."""
    for b in batches:
        for path, content in zip(b.column(0), b.column(1)):
            try:
                table = pq.read_table(pa.BufferReader(content.as_buffer()), columns=_ARROW.names)
                absent = [n for n in _ARROW.names if n not in table.column_names]
                if absent:
                    raise ValueError(f"No column {', '.join(absent)}")
                parts, why = table.cast(_ARROW).to_batches(max_chunksize=4096), None
            except Exception as e:  # noqa: BLE001 - whatever the file holds, the stream goes on
                why = f"{type(e).__name__}: {str(e)[:200]}"
                parts = [pa.RecordBatch.from_arrays([pa.nulls(1, f.type) for f in _ARROW], schema=_ARROW)]
            for part in parts:
                n = part.num_rows
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([path.as_py()] * n, pa.string()), pa.array([why] * n, pa.string())],
                                                 [*_ARROW.names, "path", "unreadable"])


def score_files(files: DataFrame, batch: int, sink_dir: str, dead_dir: str, classes, threshold: float) -> None:
    """Score one batch of ``binaryFile`` rows into ``sink_dir/batch=<n>``, its unreadable files into
    ``dead_dir/batch=<n>``; both are replaced when the batch comes again."""
    read = files.where(F.col("length") <= MOST_BYTES).select("path", "content").mapInArrow(_parsed, REQUEST_SCHEMA + ", path string, unreadable string").persist()
    try:
        good = read.where("unreadable is null").drop("path", "unreadable")
        scored = scoring.score(good, classes, threshold, threshold_col="threshold_override").select(*OUT_COLUMNS)
        scored.write.mode("overwrite").parquet(f"{sink_dir}/batch={batch}")
        large = files.where(F.col("length") > MOST_BYTES).select("path", F.format_string(f"%d bytes, more than {MOST_BYTES}", "length").alias("error"))
        dead = read.where("unreadable is not null").select("path", F.col("unreadable").alias("error")).union(large)
        dead.write.mode("overwrite").parquet(f"{dead_dir}/batch={batch}")
    finally:
        read.unpersist()


def run_scoring_stream(spark: SparkSession, source_dir: str, sink_dir: str, classes,
                       checkpoint: str, threshold: float = config.PREDICTOR_THRESHOLD, available_now: bool = True,
                       dead_dir: str | None = None, max_files_per_trigger: int = 1000):
    """Start the job; with ``available_now`` it processes what is there and stops. ``checkpoint`` is this
    stream's own folder in shared storage; unreadable files go to ``dead_dir`` (default: beside the sink)."""
    dead_dir = dead_dir or sink_dir.rstrip("/") + "_dead"
    files = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
             .option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", max_files_per_trigger).load(source_dir))
    w = (files.writeStream.foreachBatch(lambda df, batch: score_files(df, batch, sink_dir, dead_dir, classes, threshold))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
