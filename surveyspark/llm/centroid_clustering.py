"""Centroid clustering on integers with Ptolemaic pivots.

Lloyd's rounds over exact integer vectors. For a vector x, a centroid c and two
pivots p and q, Ptolemy's inequality gives

    d(x, c) >= |d(x, p) d(c, q) - d(x, q) d(c, p)| / d(p, q),

the most over all pairs of pivots is a lower bound that needs no component of x:
the distances of x to the pivots are computed once and kept beside it, those of
the centroids are a few numbers a round. A task takes, for each vector, the
centroid of the least bound exactly, drops all centroids whose bound, rounded
down by more than its possible error, exceeds that distance, and computes the
distances of the others exactly, in integers. So the assignment is that of a
full search, ties (the smaller number) included.

Pivots are fixed centroids: those of the start serve the first rounds, and as a
bound is sharpest near its pivots they are replaced, with the kept distances,
by the centroids of rounds 2 and 5. Distances to pivots and centroids are from
integers; a round is one pass over the kept table, whose sums are added up per
task and reach the driver as one row per centroid and dimension.

A vector takes part when it has exactly ``dim`` components, none null or
non-finite, and a non-null id. Components whose integer is beyond +-2**27 put a
vector out as well: its squared distances need not fit a long. Rows of one id
are vectors of their own (at the start, ties of the hash go to the smaller
vector); with fewer vectors than ``k`` there are fewer centroids, and an empty
table gives an empty result. Columns other than the id and the vector are not
read. A sum of distances that does not fit a long is null.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import Shared, source
from .vectors import binary, flat, matrix, sound

K = 8
ROUNDS = 10
DIM = 64
SCALE = 1024
LARGEST = 2 ** 27
#: Rounds whose centroids become the pivots (0: the start).
PIVOT_ROUNDS = (0, 2, 5)
#: Relative room for the error of a bound in double precision.
ROOM = 1e-9

_KEPT = "id long, vec binary, far binary"


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``x`` to the integer point ``c``, exact."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def lower_bounds(far: np.ndarray, c_far: np.ndarray, between: np.ndarray) -> np.ndarray:
    """Lower bounds (rows x centroids) of the distance by the best pair of pivots: ``far`` has the rows'
    distances to the pivots, ``c_far`` the centroids', ``between`` the pivots' own."""
    out = np.zeros((len(far), len(c_far)))
    for p, q in combinations(range(len(between)), 2):
        if between[p, q] > 0:
            a, b = far[:, p, None] * c_far[None, :, q], far[:, q, None] * c_far[None, :, p]
            # the products are near each other where the bound is small, so the error is of their size
            out = np.maximum(out, (np.abs(a - b) - ROOM * (a + b)) / between[p, q])
    return np.maximum(out, 0.0)


def nearest_centroid(x: np.ndarray, far: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance, number of distances computed) for each row, ties to the smaller number."""
    c_far = np.sqrt(np.stack([squared(centroids, p) for p in pivots], 1).astype(np.float64))
    between = np.sqrt(np.stack([squared(pivots, p) for p in pivots], 1).astype(np.float64))
    low = lower_bounds(far, c_far, between)
    low = low * low * (1 - ROOM)
    best_at = low.argmin(1)
    d = x - centroids[best_at]
    best = np.einsum("ij,ij->i", d, d)
    cluster, done = best_at.copy(), len(x)
    for c in range(len(centroids)):
        rows = np.flatnonzero((best_at != c) & (low[:, c] <= best))
        s = squared(x[rows], centroids[c])
        closer = (s < best[rows]) | ((s == best[rows]) & (c < cluster[rows]))
        best[rows[closer]], cluster[rows[closer]] = s[closer], c
        done += len(rows)
    return cluster, best, done


def _integers(batches):
    for b in batches:
        x = np.floor(flat(b.column(1)) * SCALE)
        fits = (np.abs(x) <= LARGEST).all(1) if len(x) else np.zeros(0, bool)
        yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(fits)), binary(x[fits].astype(np.int32).reshape(-1, DIM))], ["id", "vec"])


def _with_pivots(pivots: np.ndarray):
    def run(batches):
        for b in batches:
            x = matrix(b.column(1), np.int32).astype(np.int64).reshape(-1, DIM)
            far = np.sqrt(np.stack([squared(x, p) for p in pivots], 1).astype(np.float64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), binary(far)], ["id", "vec", "far"])
    return run


def _sums(centroids: np.ndarray, pivots: np.ndarray):
    """Of a task: (cluster, dim, sum, n) and, under cluster -1, the number of distances computed."""
    k, dim = centroids.shape

    def run(batches):
        total, n, done = np.zeros((k, dim), np.int64), np.zeros(k, np.int64), 0
        for b in batches:
            x = matrix(b.column(1), np.int32).astype(np.int64).reshape(-1, dim)
            cluster, _, c = nearest_centroid(x, matrix(b.column(2), np.float64).reshape(len(x), -1), centroids, pivots)
            np.add.at(total, cluster, x)
            n += np.bincount(cluster, minlength=k)
            done += c
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.repeat(np.arange(k), dim), -1)), pa.array(np.append(np.tile(np.arange(dim), k), 0)),
                                          pa.array(np.append(total.ravel(), done)), pa.array(np.append(np.repeat(n, dim), n.sum()))], ["c", "d", "s", "n"])
    return run


def _final(centroids: np.ndarray, pivots: np.ndarray):
    def run(batches):
        for b in batches:
            x = matrix(b.column(1), np.int32).astype(np.int64).reshape(-1, centroids.shape[1])
            cluster, best, _ = nearest_centroid(x, matrix(b.column(2), np.float64).reshape(len(x), -1), centroids, pivots)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cluster.astype(np.int32)), pa.array(best)], ["id", "cluster", "distance"])
    return run


def centroid_clusters(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, rounds: int = ROUNDS, salt: str = "3:",
                      report: list | None = None) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for every vector; ``report`` gets, per
    round, the number of distances computed and of those that a full search computes."""
    spark = vectors.sparkSession
    shared = Shared(spark, "centroids")
    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).where("id is not null")
    src = src.where((F.size("v") == DIM) & sound("v")).select("id", F.col("v").cast("array<double>"))
    plain = shared.put(src.mapInArrow(_integers, "id long, vec binary"), "integers")
    first = plain.orderBy(F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256), "id", "vec").limit(k).toArrow()
    if not first.num_rows:
        return spark.createDataFrame([], f"{id_col} long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = matrix(first["vec"], np.int32).astype(np.int64)
    table, pivots = None, None
    for r in range(rounds):
        if r in PIVOT_ROUNDS:
            pivots, old = centroids.copy(), table
            table = shared.put(plain.mapInArrow(_with_pivots(pivots), _KEPT), "kept")
            if old is not None:
                shared.drop(old)
        sums = table.mapInArrow(_sums(centroids, pivots), "c long, d long, s long, n long").groupBy("c", "d")
        sums = sums.agg(F.sum(F.col("s").cast("decimal(38,0)")).cast("string").alias("s"), F.sum("n").alias("n")).collect()
        moved = centroids.copy()
        for c, d, s, n in sums:
            if c < 0 and report is not None:
                report.append((int(s), n * len(centroids)))
            elif c >= 0 and n:
                moved[c, d] = int(s) // n  # floor, also below zero
        centroids = moved
    out = shared.put(table.mapInArrow(_final(centroids, pivots), "id long, cluster int, distance long"), "assigned")
    per = out.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia"))
    names = spark.createDataFrame([(i, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    of = names.join(per, "cluster").collect()  # k rows
    sums = [r["cluster_inertia"] for r in of]
    total = sum(sums) if None not in sums and sum(sums) < 2 ** 63 else None
    of = spark.createDataFrame([(*r, total) for r in of], "cluster int, centroid_sha256 string, cluster_inertia long, inertia long")
    return out.join(F.broadcast(of), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 clusters of all ``embeddings`` after 10 rounds."""
    return centroid_clusters(source(spark, sf_dir, "embeddings"))


def op13_sql() -> str:
    """The same in DuckDB's SQL, round by round."""
    steps = ["""v as materialized (select vec_id, list_transform(embedding, lambda e: cast(floor(1024 * cast(e as double)) as bigint)) as x from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = 64)""",
             """c0 as materialized (select row_number() over (order by h) - 1 as c, x from (select x, sha256('3:' || vec_id) as h from v order by h limit 8))"""]
    for r in range(ROUNDS + 1):
        steps.append(f"""a{r} as materialized (select vec_id, x, min(struct_pack(d := d, c := c)) as b from (select v.vec_id, v.x, c.c,
  list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i]))) as d from v, c{r} c) group by vec_id, x)""")
        if r < ROUNDS:
            steps.append(f"""c{r + 1} as materialized (select c.c, coalesce(m.x, c.x) as x from c{r} c left join (select c, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) as x
  from (select b.c as c, i, sum(x[i]) as s, count(*) as n from a{r}, (select unnest(range(1, 65)) as i) group by all) group by c) m using (c))""")
    return "with " + ",\n".join(steps) + f"""
select vec_id, cast(b.c as integer) as cluster, cast(b.d as bigint) as distance, cast(sum(b.d) over (partition by b.c) as bigint) as cluster_inertia,
  cast(sum(b.d) over () as bigint) as inertia, sha256(array_to_string(c.x, ',')) as centroid_sha256 from a{ROUNDS} a join c{ROUNDS} c on a.b.c = c.c
"""
