"""Approximate nearest neighbours: a forest of random-projection trees, one priority queue, exact reranking.

The trees are built on at most ``SAMPLE`` vectors (those with the smallest
hashes of their ids): a node splits its points at the median of their
projections on the difference of two of them. Every row is put into one leaf
of each tree. A query walks all trees through one queue, nearest split margin
first, and takes leaves until they hold ``share`` of the rows of all trees
together, so the effort is one dial for all sizes; the default reaches a
recall above 0.9 even on vectors without any structure, where no index helps
much. Leaves and the queries that took them meet in blocks of bounded size (a
leaf with very many rows, as of one repeated vector, is several blocks; so are
many queries), where cosines are computed in double precision on the original
vectors.

Equal vectors are one row, the one with the least id, until the exact scores are
there; then a row stands for the least ids of its copies. A block's matrix product
depends in its last bits on the block, so its candidates within ``ERROR`` of the
last place are scored again, pair by pair, inside the block: it gives at most
``k`` pairs of a query, also where all its rows are multiples of one vector.

Vectors that are null, empty, zero or hold null or non-finite components take
no part; nor do those of another length than most (ties: the shorter). A null
id takes no part; of repeated ids the least vector counts. Ties go to the
smaller id.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .tables import Shared, source

SAMPLE = 10_000
TREES = 4
LEAF = 512
SHARE = 0.35
BLOCK_ROWS = 2048
BUCKET_ROWS = 4096
QUERY_BLOCK = 8192
ERROR = 1e-11
PAIRS = 8192  # scored at once


class Forest:
    """Trees in flat arrays: for each node its normal, threshold and two children; a child below zero is
    leaf -child - 1, numbered over all trees."""

    def __init__(self, points: np.ndarray, trees: int, leaf: int, seed: int = 5):
        self.rng = np.random.default_rng(seed)
        self.points, self.leaf, self.leaves = points, leaf, 0
        self.normal, self.cut, self.kids, self.roots = [], [], [], []
        for _ in range(trees):
            self.roots.append(self._grow(np.arange(len(points))))
        self.normal = np.array(self.normal).reshape(len(self.cut), points.shape[1])
        del self.points, self.rng

    def _grow(self, root: np.ndarray) -> int:
        first = None
        todo = [(root, None, 0)]
        while todo:
            idx, parent, side = todo.pop()
            node = self._split(idx)
            if node is None:
                self.leaves += 1
                at = -self.leaves
            else:
                normal, cut, left, right = node
                at = len(self.cut)
                self.normal.append(normal)
                self.cut.append(cut)
                self.kids.append([0, 0])
                todo += [(right, at, 1), (left, at, 0)]
            if parent is None:
                first = at
            else:
                self.kids[parent][side] = at
        return first

    def _split(self, idx: np.ndarray):
        if len(idx) <= self.leaf:
            return None
        for _ in range(5):
            a, b = self.rng.choice(idx, 2, replace=False)
            normal = self.points[a] - self.points[b]
            length = np.linalg.norm(normal)
            if length < 1e-9:
                continue
            p = self.points[idx] @ (normal / length)
            cut = float(np.median(p))
            low = p <= cut
            if 0 < low.sum() < len(idx):
                return normal / length, cut, idx[low], idx[~low]
        return None

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree."""
        out = np.empty((len(x), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            todo = [(root, np.arange(len(x)))]
            while todo:
                at, rows = todo.pop()
                if at < 0:
                    out[rows, t] = -at - 1
                elif len(rows):
                    low = x[rows] @ self.normal[at] <= self.cut[at]
                    todo += [(self.kids[at][0], rows[low]), (self.kids[at][1], rows[~low])]
        return out

    def probe(self, q: np.ndarray, sizes: np.ndarray, budget: float) -> list[int]:
        """Leaves in the order of the shared queue until they hold ``budget`` rows."""
        side = (self.normal @ q - np.array(self.cut)).tolist() if len(self.cut) else []
        queue = [(0.0, r) for r in self.roots]
        heapq.heapify(queue)
        out, held = [], 0
        while queue and held < budget:
            margin, at = heapq.heappop(queue)
            while at >= 0:
                d = side[at]
                near, far = self.kids[at] if d <= 0 else self.kids[at][::-1]
                heapq.heappush(queue, (max(margin, abs(d)), far))
                at = near
            out.append(-at - 1)
            held += sizes[-at - 1]
        return out


def _matrix(col: pa.Array, kind) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return np.array([np.frombuffer(x, kind) for x in col.to_pylist()]).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _placed(forest, kind):
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            leaves = forest.value.place(_unit(_matrix(b.column(1), kind)))
            at = np.repeat(np.arange(b.num_rows), leaves.shape[1])
            for i in range(0, len(at), 8192):
                rows = pa.array(at[i:i + 8192])
                yield pa.RecordBatch.from_arrays([pa.array(leaves.ravel()[i:i + 8192]), b.column(0).take(rows), b.column(1).take(rows)], ["leaf", "id", "vec"])
    return run


def _probes(forest, sizes: np.ndarray, budget: float, kind):
    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                x = _unit(_matrix(part.column(1), kind))
                taken = [forest.value.probe(q, sizes, budget) for q in x]
                rows = pa.array(np.repeat(np.arange(len(x)), [len(t) for t in taken]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(taken).astype(np.int64)), part.column(0).take(rows), part.column(1).take(rows)], ["leaf", "q", "qvec"])
    return run


def _best(q: np.ndarray, v: np.ndarray, s: np.ndarray, k: int):
    """The k best of each query, ties to the smaller id, each candidate once."""
    order = np.lexsort((v, -s, q))
    q, v, s = q[order], v[order], s[order]
    if not len(q):
        return q, v, s
    _, once = np.unique(np.stack([q, v], 1), axis=0, return_index=True)
    once.sort()
    q, v, s = q[once], v[once], s[once]
    head = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
    keep = np.arange(len(q)) - np.repeat(head, np.diff(np.append(head, len(q)))) < k
    return q[keep], v[keep], s[keep]


def _cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines row by row; a score does not depend on the rows beside it."""
    return (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1))) if len(x) else np.zeros(0)


def _rerank(k: int, kind):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if left.num_rows and right.num_rows:
            x, ids, block = _matrix(left["vec"], kind), left["id"].to_numpy(), left["block"].to_numpy()
            y, qs, asked = _matrix(right["qvec"], kind), right["q"].to_numpy(), right["block"].to_numpy()
            nx, ny = np.sqrt((x * x).sum(1)), np.sqrt((y * y).sum(1))
            by, to = np.argsort(block, kind="stable"), np.argsort(asked, kind="stable")
            for b in np.unique(block):
                m = by[slice(*np.searchsorted(block[by], [b, b + 1]))]
                r = to[slice(*np.searchsorted(asked[to], [b, b + 1]))]
                for i in range(0, len(r), 512):
                    part = r[i:i + 512]
                    s = (y[part] @ x[m].T) / (ny[part][:, None] * nx[m][None])
                    s[qs[part][:, None] == ids[m][None]] = -np.inf
                    n = min(k, len(m))
                    kth = -np.partition(-s, n - 1, axis=1)[:, n - 1:n]
                    a, c = np.nonzero((s >= kth - ERROR) & (s > -np.inf))
                    near = [_cosines(x[m[c[z:z + PAIRS]]], y[part[a[z:z + PAIRS]]]) for z in range(0, len(a), PAIRS)]
                    found.append(_best(qs[part][a], ids[m][c], np.concatenate([np.zeros(0), *near]), k))
        q, v, s = _best(*(np.concatenate(z) for z in zip(*found)), k)
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.float64())})
    return run


def _own(kind):
    """(query_id, vec_id, score) of rows with themselves, for the copies of a query."""
    def run(batches):
        for b in batches:
            x = _matrix(b.column(1), kind)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(0), pa.array(_cosines(x, x))], ["query_id", "vec_id", "score"])
    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", trees: int = TREES, share: float = SHARE,
            sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row of ``vectors`` where ``is_query``
    (a condition on the id, as column ``id``) holds, by cosine, against all rows but itself."""
    spark = vectors.sparkSession
    shared = Shared(spark, "ann-forest")
    single = vectors.schema[vec_col].dataType.elementType.simpleString() == "float"
    kind = np.float32 if single else np.float64
    value = F.col(vec_col) if single else F.col(vec_col).cast("array<double>")
    src = vectors.select(F.col(id_col).cast("long").alias("id"), value.alias("v")).where("id is not null and v is not null")
    src = src.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    if src.groupBy("id").count().where("count > 1").limit(1).count():
        src = src.groupBy("id").agg(F.min("v").alias("v"))
    sizes = src.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not sizes:
        return empty
    dim = sizes[0][0]
    src = src.where(F.size("v") == dim)

    def packed(batches):
        for b in batches:
            flat = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dim) + kind(0)  # no minus zeros
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in flat], pa.binary())], ["id", "vec"])

    all_ = shared.put(src.mapInArrow(packed, "id long, vec binary"), "vectors")
    # (rep, id): the copies of vectors that are there more than once, rep the least id of them
    keyed = all_.select("id", F.unhex(F.sha1("vec")).alias("key"))
    many = keyed.groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("c")).where("c > 1")
    copies = shared.put(keyed.join(many, "key").select("rep", "id"), "copies")
    src = all_.join(copies.where("id <> rep").select("id"), "id", "left_anti")
    src = shared.put(src, "distinct") if not copies.isEmpty() else all_
    n = src.count()
    drawn = src.orderBy(F.xxhash64("id"), "id").limit(sample).toArrow()
    forest = Forest(_unit(_matrix(drawn["vec"], kind)), trees, max(8, LEAF * drawn.num_rows // n))
    on_all = spark.sparkContext.broadcast(forest)
    index = shared.put(src.mapInArrow(_placed(on_all, kind), "leaf long, id long, vec binary"), "index")
    held = np.zeros(forest.leaves, np.int64)  # at most trees x sample / 4 leaves, whatever the number of rows
    for leaf, c in index.groupBy("leaf").count().collect():
        held[leaf] = c
    asked = all_.where(is_query).select("id").join(copies, "id", "left").select(F.coalesce("rep", "id").alias("rep"), F.col("id").alias("q"))
    queries = src.join(asked.select(F.col("rep").alias("id")).distinct(), "id", "left_semi").select("id", "vec")
    probes = queries.mapInArrow(_probes(on_all, held, share * n * trees, kind), "leaf long, q long, qvec binary")

    parts = spark.createDataFrame([(i, int(-(-c // BLOCK_ROWS))) for i, c in enumerate(held.tolist()) if c], "leaf long, parts int")
    buckets, q_blocks = -(-n * trees // BUCKET_ROWS), -(-max(1, queries.count()) // QUERY_BLOCK)
    key = lambda part, q: F.struct(F.pmod(F.xxhash64("leaf", part), F.lit(buckets)).alias("bucket"), q.alias("qb"))
    block = lambda part: (F.col("leaf") * 1_000_000 + part).alias("block")
    rows = index.join(F.broadcast(parts), "leaf").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    rows = rows.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))).select(key(F.col("part"), F.col("qb")).alias("key"), block(F.col("part")), "id", "vec")
    asks = probes.join(F.broadcast(parts), "leaf").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("parts") - 1).cast("long"))))
    asks = asks.select(key(F.col("part"), F.pmod(F.xxhash64("q"), F.lit(q_blocks)).cast("int")).alias("key"), block(F.col("part")), "q", "qvec")
    found = rows.groupBy("key").cogroup(asks.groupBy("key")).applyInArrow(_rerank(k, kind), "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).drop("r")
    copied = src.join(asked.join(copies.select("rep").distinct(), "rep").select(F.col("rep").alias("id")).distinct(), "id", "left_semi").select("id", "vec")
    exact = found.union(copied.mapInArrow(_own(kind), "query_id long, vec_id long, score double"))
    # rows for their copies: k + 1 of them, as one may be the query itself
    least = copies.withColumn("r", F.row_number().over(W.partitionBy("rep").orderBy("id"))).where(F.col("r") <= k + 1).select(F.col("rep").alias("vec_id"), "id")
    exact = exact.join(asked.select(F.col("rep").alias("query_id"), "q"), "query_id").join(least, "vec_id", "left")
    exact = exact.select(F.col("q").alias("query_id"), F.coalesce("id", "vec_id").alias("vec_id"), "score").where("query_id <> vec_id")
    return exact.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_ann_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every vector whose id is divisible by 50, against all of ``embeddings``."""
    return nearest(source(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
