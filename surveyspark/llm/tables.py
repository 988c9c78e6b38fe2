"""Tables written to the shared folder, so that a stage survives lost executors."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_MADE: list[list] = []


@contextmanager
def temporary():
    """Tables that operators put within this block go at its end, when what was made of them is written."""
    made: list[Shared] = []
    _MADE.append(made)
    try:
        yield
    finally:
        _MADE.pop()
        for shared in made:
            shared.close()


#: Spark's setting that deletes the shuffle files of a query when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def unused(name: str, columns: list[str]) -> str:
    """``name``, with underscores added until no column has it (names differ by more than case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


class Shared:
    """Names, writes, rereads and deletes tables under ``spark.checkpoint.dir``; what is left goes when the session ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        small_batches(spark)
        self.base = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
        self.n, self.paths = 0, {}
        if _MADE:
            _MADE[-1].append(self)

    def put(self, df: DataFrame, name: str = "t") -> DataFrame:
        """Write ``df`` as Parquet and read it back; the lineage ends at the files, and the shuffle files behind them go."""
        self.n += 1
        path = f"{self.base}/{self.n:03d}-{name}"
        if self.n == 1:
            self._fs(self.base)[1].deleteOnExit(self._fs(self.base)[0])
        before = self.spark.conf.get(CLEANUP)
        self.spark.conf.set(CLEANUP, "true")  # for this write alone
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete the files of a table of ``put`` that nothing reads any more."""
        self._delete(self.paths.pop(id(df))[1])

    def close(self) -> None:
        """Delete all tables."""
        self._delete(self.base)

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _delete(self, path: str) -> None:
        p, fs = self._fs(path)
        fs.delete(p, True)


#: Bits of the id filter below: ``SPARE`` to an id, and 32 MB at most. Beyond some 10**8 ids more and more rows pass
#: it for nothing; it never keeps one back.
SPARE, MOST_BITS = 16, 1 << 28


def id_filter(ids: DataFrame, col: str = "id") -> np.ndarray:
    """A bitmap of the low bits of the ids: a scan can leave out rows that are not in it before an exact join takes
    out the rest."""
    bits = 1 << min(MOST_BITS.bit_length() - 1, max(10, (SPARE * ids.count()).bit_length()))
    at = F.col(col).bitwiseAND(F.lit(bits - 1))
    words = ids.select(F.shiftright(at, 6).alias("w"), F.expr(f"shiftleft(1L, cast({col} & 63L as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    out = np.zeros(bits >> 6, np.int64)
    for batch in words.toArrow().to_batches():
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out.view(np.uint64)


def in_filter(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at = ids & (64 * len(bits) - 1)
    return (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0


#: Keys that a join spreads by broadcasting them.
HEAVY = 1 << 16


def spread_join(left: DataFrame, right: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """``left`` joined with ``right``, which has one row per key and, as ``weight``, the number of left rows of it.

    Keys that hold more than one in ``HEAVY`` of the ``total`` left rows, so fewer than ``HEAVY`` keys, come to the
    left rows by broadcast; only the others are shuffled, so no task gets more than that part for one key."""
    heavy = F.col(weight) * HEAVY > total
    if right.where(heavy).isEmpty():
        return left.join(right.drop(weight), key)
    some, others = right.where(heavy).drop(weight), right.where(~heavy).drop(weight)
    rest = left.join(F.broadcast(some.select(key)), key, "left_anti")
    return left.join(F.broadcast(some), key).unionByName(rest.join(others, key))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let Arrow batches have at most ``rows`` rows from now on: whole texts of 10,000 rows, Spark's default, are
    too much memory for an executor's share."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))
