"""Near-duplicate vectors by a robust-pruned flat graph.

Rows meet only within a label (any key column). The work is dealt to shards:

* Medoids are fitted on a bounded sample: leaders of groups so dense that a
  sample sees them, then the middles of k-means clusters; of two that are close
  the first stays. Every row is indexed, in the shards of its ``overlap``
  nearest medoids and of all that its links to a core (below) may lie at.
* In each shard, in parts of bounded size, a graph is built: the nearest rows of
  a row, robust-pruned (a neighbour goes when a kept one is ``ALPHA`` times
  nearer to it than the row is), with the edges back. The lists of a row from
  all its shards are united, so the graph is one, and flat.
* Every row is searched for in its shards: a greedy beam search from the part's
  medoids, and from the row's own node where it is in that part, in step for many
  rows at once; then the range expands: all nodes in range, with some room, are
  opened until no more are found. What is found is verified by the cosine in
  double precision. A pair counts in the first shard that both rows are in.
* The links found are audited against brute force over all rows, for a bounded
  number of rows drawn by hash; below the asked recall the shards overlap more
  and the beam is wider, and the search is done again.

A very dense group needs no search within: rows within half the angle of the
threshold of a medoid (its core) are linked with each other by the triangle
inequality. They are counted, joined by a star, and searched for only among the
shard's other rows, so a core of any size costs as much as it has rows. Equal
vectors are one row with a weight. Tasks give numbers of links and a spanning
forest, never the pairs.

Null ids give no row; of repeated ids the row of the least (label, vector)
counts. Vectors that are null, zero or hold null or non-finite components, or
are of another length than most (ties: the shorter), or have a null label, link
with nothing. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .graph import components
from .tables import Shared, source
from .vectors import binary, flat, matrix, most_common_size, sound

THRESHOLD = 0.93
#: Rows the medoids are fitted on, and those of them that are compared with each other to see dense groups.
SAMPLE, DENSE_SAMPLE = 20_000, 2_000
#: The part of the dense sample that makes a leader; medoids at most.
DENSE, MOST_MEDOIDS = 0.02, 4096
#: Rows of a label to a cluster; rows of a part of a shard.
PER_CLUSTER, PART = 250, 2048
OVERLAP, BEAM = 2, 24
#: Nearest rows that are pruned, neighbours kept (and as many edges back, the nearest), and the factor of the pruning.
CANDIDATES, DEGREE, ALPHA = 32, 16, 1.2
#: The range of the search as a factor of the threshold's angle.
ROOM = 1.2
AUDIT, RECALL = 1000, 0.95


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def medoids(x: np.ndarray, clusters: int, half: float, seed: int = 3) -> np.ndarray:
    """Leaders of dense groups and middles of clusters among the unit rows ``x``; none within the cosine
    ``half`` of an earlier one."""
    rng, out = np.random.default_rng(seed), []
    few = x[:DENSE_SAMPLE]
    near = few @ few.T >= half
    while len(few):
        at = int(near.sum(1).argmax())
        if near[at].sum() < max(3, DENSE * len(few)):
            break
        out.append(few[at])
        near[near[at]] = False
    c = x[rng.choice(len(x), min(clusters, len(x)), replace=False)]
    for _ in range(6):
        at = (x @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        long = np.linalg.norm(sums, axis=1) > 1e-12
        c[long] = unit(sums[long])
    sims = x @ c.T
    size = np.bincount(sims.argmax(1), minlength=len(c))
    for j in np.argsort(-size, kind="stable"):
        m = x[sims[:, j].argmax()]
        if not out or (np.stack(out) @ m).max() < half:
            out.append(m)
    return np.stack(out)


def placed(x: np.ndarray, mids: np.ndarray, overlap: int, half: float, reach: float) -> tuple[np.ndarray, list[list[int]]]:
    """(core, shards) of unit rows: the medoid whose core holds the row, or -1, and the shards it goes to."""
    s = x @ mids.T
    top = s.argmax(1)
    best = s[np.arange(len(x)), top]
    core = np.where(best >= half + 1e-6, top, -1)
    k = min(overlap, len(mids))
    nearest = np.argpartition(-s, k - 1, axis=1)[:, :k]
    near = s >= reach - 1e-6
    out = []
    for i in range(len(x)):
        reached = np.flatnonzero(near[i])
        if core[i] >= 0:  # rows of a core go to the shards of denser ones only, so of two cores one stays
            out.append(sorted({int(core[i]), *reached[reached < core[i]].tolist()}))
        else:
            out.append(sorted({*nearest[i].tolist(), *reached.tolist()}))
    return core, out


def _sharded(kind, mids, overlap: int, half: float, reach: float):
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            core, shards = placed(unit(matrix(b.column(2), kind).astype(np.float64)), mids.value, overlap, half, reach)
            at = pa.array(np.repeat(np.arange(len(core)), [len(s) for s in shards]))
            yield pa.RecordBatch.from_arrays(
                [b.column(1).take(at), pa.array([s for ss in shards for s in ss], pa.int32()), b.column(0).take(at), b.column(2).take(at), b.column(3).take(at),
                 pa.array(core.astype(np.int32)).take(at), pa.array(shards, pa.list_(pa.int32())).take(at)], ["label", "shard", "id", "vec", "w", "core", "shards"])
    return run


def robust_pruned(x: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA, candidates: int = CANDIDATES) -> np.ndarray:
    """Neighbours (rows x degree, -1 where there are fewer) of unit rows: of the nearest rows, in order, those that
    no kept one hides."""
    n = len(x)
    s = x @ x.T
    np.fill_diagonal(s, -4.0)
    c = min(candidates, n - 1)
    out = np.full((n, degree), -1, np.int64)
    if c < 1:
        return out
    cand = np.argpartition(-s, c - 1, axis=1)[:, :c]
    cand = np.take_along_axis(cand, np.argsort(-np.take_along_axis(s, cand, 1), axis=1, kind="stable"), 1)
    far = np.sqrt(np.maximum(2 - 2 * np.take_along_axis(s, cand, 1), 0))
    alive, rows = np.ones(cand.shape, bool), np.arange(n)
    for j in range(degree):
        first = alive.argmax(1)
        some = alive[rows, first]
        if not some.any():
            break
        pick = cand[rows, first]
        out[some, j] = pick[some]
        hidden = alpha * np.sqrt(np.maximum(2 - 2 * s[pick[:, None], cand], 0)) <= far
        alive &= ~hidden
        alive[rows, first] = False
    return out


def _built(kind):
    """Adjacency lists of a part, edges in both directions."""
    def run(table: pa.Table) -> pa.Table:
        ids = table["id"].to_numpy()
        x = unit(matrix(table["vec"], kind).astype(np.float64)).astype(np.float32)
        near = robust_pruned(x)
        u, j = np.nonzero(near >= 0)
        v = near[u, j]
        order = np.lexsort((-np.einsum("ij,ij->i", x[u], x[v]), v))
        place = np.arange(len(v)) - np.searchsorted(v[order], v[order])
        back = order[place < DEGREE]
        both = np.unique(np.stack([np.concatenate([u, v[back]]), np.concatenate([v, u[back]])], 1), axis=0)
        offs = np.searchsorted(both[:, 0], np.arange(len(ids) + 1)).astype(np.int32)
        return pa.table({"id": pa.array(ids), "near": pa.ListArray.from_arrays(pa.array(offs), pa.array(ids[both[:, 1]]))})
    return run


def range_search(x: np.ndarray, adj: np.ndarray, starts: list[int], q: np.ndarray, own: np.ndarray, beam: int, opened: float, wanted: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) of at least the cosine ``wanted``: a greedy beam search for all unit queries in step,
    then all nodes of at least the cosine ``opened`` are opened until none is new. ``adj`` holds -1 for no edge."""
    n, (count, dim) = len(x), q.shape
    padded = np.vstack([x, np.zeros((1, dim), x.dtype)])
    adj = np.vstack([np.where(adj < 0, n, adj), np.full((1, adj.shape[1]), n)])
    rows = np.arange(count)
    seen = np.zeros((count, n + 1), bool)
    seen[:, n] = True
    first = np.concatenate([np.tile(starts, (count, 1)), np.where(own < 0, n, own)[:, None]], 1)
    held = np.full((count, beam + first.shape[1]), n)
    score = np.full(held.shape, -np.inf, np.float32)
    hits = []

    def look(r, nodes):
        """Scores of nodes not seen yet, which are then seen; -inf for the others."""
        fresh = ~seen[r[:, None], nodes]
        seen[r[:, None], nodes] = True
        s = np.where(fresh, np.einsum("ijk,ik->ij", padded[nodes], q[r]), -np.inf)
        i, j = np.nonzero(s >= opened)
        hits.append((r[i], nodes[i, j], s[i, j]))
        return s

    for j in range(first.shape[1]):  # one at a time: the own node may be a start
        held[:, j:j + 1] = first[:, j:j + 1]
        score[:, j:j + 1] = look(rows, first[:, j:j + 1])
    held, score = held[:, :beam], score[:, :beam]
    closed = score == -np.inf
    while not closed.all():
        r = np.flatnonzero(~closed.all(1))
        at = np.where(closed[r], -np.inf, score[r]).argmax(1)
        closed[r, at] = True
        nodes = adj[held[r, at]]
        s = look(r, nodes)
        all_s, all_n = np.concatenate([score[r], s], 1), np.concatenate([held[r], nodes], 1)
        all_c = np.concatenate([closed[r], s == -np.inf], 1)
        best = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
        score[r], held[r], closed[r] = (np.take_along_axis(z, best, 1) for z in (all_s, all_n, all_c))
    at = 0
    while at < len(hits):  # the range expands
        r, v, _ = hits[at]
        at += 1
        for i in range(0, len(r), 8192):
            rr, nodes = r[i:i + 8192], adj[v[i:i + 8192]]
            fresh = ~seen[rr[:, None], nodes]
            key = np.unique((rr[:, None] * (n + 1) + nodes)[fresh])
            for k in range(0, len(key), 65536):
                a, b = np.divmod(key[k:k + 65536], n + 1)
                seen[a, b] = True
                s = np.einsum("ij,ij->i", padded[b], q[a])
                near = s >= opened
                if near.any():
                    hits.append((a[near], b[near], s[near]))
    r, v, s = (np.concatenate(z) for z in zip(*hits))
    return r[s >= wanted], v[s >= wanted]


def _neighbours(ids: np.ndarray, lists: pa.ListArray) -> np.ndarray:
    """The lists of ids as places in ``ids`` (ascending), those that are not there left out, in a matrix filled
    with -1."""
    row = pc.list_parent_indices(lists).to_numpy()
    to = pc.list_flatten(lists).to_numpy()
    at = np.minimum(np.searchsorted(ids, to), len(ids) - 1)
    here = ids[at] == to
    row, to = row[here], at[here]
    size = np.bincount(row, minlength=len(ids))
    out = np.full((len(ids), max(1, int(size.max()))), -1, np.int64)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = to
    return out


def _first_common(shards: list[list[int]], u: np.ndarray, v: np.ndarray) -> np.ndarray:
    width = max(map(len, shards))
    m = np.array([s + [2 ** 30 + 1] * (width - len(s)) for s in shards], np.int64)
    out = np.full(len(u), 2 ** 30)
    for j in range(width):
        mine = m[u, j]
        common = (mine[:, None] == m[v]).any(1)
        out = np.where(common, np.minimum(out, mine), out)
    return out


def _roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least place of each place's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _searched(kind, threshold: float, beam: int):
    """Of a tile: (id, links, root) of the rows of part b that link with rows of part a, and of those rows."""
    opened = math.cos(min(math.pi, ROOM * math.acos(threshold)))

    def run(table: pa.Table) -> pa.Table:
        none = pa.table({"id": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        table = table.sort_by("id").combine_chunks()
        a, b, part, shard = (table[c][0].as_py() if c != "part" else table[c].to_numpy() for c in ("a", "b", "part", "shard"))
        ids, w, core = (table[c].to_numpy() for c in ("id", "w", "core"))
        rest = core != shard
        index = np.flatnonzero(rest)
        if not (part == a).any():
            return none
        exact = unit(matrix(table["vec"], kind).astype(np.float64))
        x = exact.astype(np.float32)
        adj = _neighbours(ids[index], table["near"].take(pa.array(index)).combine_chunks())
        here = np.full(len(ids), -1)
        here[index] = np.arange(len(index))
        starts = []
        for p in {a, b}:
            of = np.flatnonzero(rest & (part == p))
            if len(of):
                starts.append(int(here[of[(x[of] @ x[of].mean(0)).argmax()]]))
        asked = np.flatnonzero(part == b)
        us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in range(0, len(asked), 256):
            some = asked[i:i + 256]
            r, v = range_search(x[index], adj, starts, x[some], here[some], beam, opened, threshold - 1e-4)
            u, v = some[r], index[v]
            keep = (part[v] == a) & (u != v) & ((core[u] != core[v]) | (core[u] < 0))
            u, v = u[keep], v[keep]
            for k in range(0, len(u), 65536):
                uu, vv = u[k:k + 65536], v[k:k + 65536]
                good = np.einsum("ij,ij->i", exact[uu], exact[vv]) >= threshold
                us.append(uu[good])
                vs.append(vv[good])
        u, v = (np.concatenate(z) for z in (us, vs))
        key = np.unique(np.minimum(u, v) * len(ids) + np.maximum(u, v))
        u, v = np.divmod(key, len(ids))
        if len(u):
            shards = table["shards"].to_pylist()
            mine = np.concatenate([_first_common(shards, u[k:k + 65536], v[k:k + 65536]) for k in range(0, len(u), 65536)]) == shard
            u, v = u[mine], v[mine]
        if not len(u):
            return none
        n = np.zeros(len(ids), np.int64)
        np.add.at(n, u, w[v])
        np.add.at(n, v, w[u])
        root, some = _roots(len(ids), u, v), n > 0
        return pa.table({"id": pa.array(ids[some]), "n": pa.array(n[some]), "root": pa.array(ids[root[some]])})
    return run


def _true_links(kind, asked, threshold: float):
    """Brute force for the audit: (id, links) of the asked rows with the rows of a batch."""
    def run(batches):
        ids, labels, x = asked.value
        for b in batches:
            if not b.num_rows:
                continue
            mine, label, w = b.column(0).to_numpy(), np.array(b.column(1).to_pylist(), object), b.column(3).to_numpy()
            s = x @ unit(matrix(b.column(2), kind).astype(np.float64)).T
            hit = (s >= threshold) & (labels[:, None] == label[None]) & (ids[:, None] != mine[None])
            n = hit @ w
            yield pa.RecordBatch.from_arrays([pa.array(ids[n > 0]), pa.array(n[n > 0])], ["id", "n"])
    return run


def _graph_links(nodes: DataFrame, shared: Shared, kind, mids, overlap: int, beam: int, threshold: float) -> DataFrame:
    """(id, n, root): links counted and a row each is linked with, by tile."""
    half, reach = math.cos(math.acos(threshold) / 2), math.cos(1.5 * math.acos(threshold))
    rows = nodes.mapInArrow(_sharded(kind, mids, overlap, half, reach), "label string, shard int, id long, vec binary, w long, core int, shards array<int>")
    rows = shared.put(rows, "shards")
    in_core = F.col("core") == F.col("shard")
    parts = lambda c: F.ceil(F.count(F.when(c, 1)) / PART).cast("int")
    sizes = rows.groupBy("label", "shard").agg(parts(~in_core).alias("rests"), parts(in_core).alias("cores"))
    rows = rows.join(sizes, ["label", "shard"])
    dealt = lambda of: F.pmod(F.xxhash64("id"), F.greatest(of, F.lit(1))).cast("int")
    rows = rows.withColumn("part", F.when(in_core, F.col("rests") + dealt(F.col("cores"))).otherwise(dealt(F.col("rests"))))
    rows = shared.put(rows, "parts")
    rest, cores = rows.where(~in_core), rows.where(in_core)
    lists = rest.select("label", "shard", "part", "id", "vec").groupBy("label", "shard", "part").applyInArrow(_built(kind), "id long, near array<long>")
    lists = shared.put(lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph")
    # part a of other rows with every part from a on: its own, later ones and those of the core
    span = lambda low, high: F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    zero, part, last = F.lit(0), F.col("part"), F.col("rests") + F.col("cores") - 1
    tiles = F.when(in_core, F.transform(span(zero, F.col("rests") - 1), lambda a: F.struct(a.alias("a"), part.alias("b")))).otherwise(
        F.concat(F.transform(span(zero, part - 1), lambda a: F.struct(a.alias("a"), part.alias("b"))), F.transform(span(part, last), lambda b: F.struct(part.alias("a"), b.alias("b")))))
    rows = rows.join(lists, "id", "left").withColumn("t", F.explode(tiles)).select("label", "shard", "part", "id", "vec", "w", "core", "shards", "t.a", "t.b", "near")
    found = rows.groupBy("label", "shard", "a", "b").applyInArrow(_searched(kind, threshold, beam), "id long, n long, root long")
    # a core is linked with itself
    mine = cores.select("label", "core", "id", "w")
    group = mine.groupBy("label", "core").agg(F.sum("w").alias("all"), F.min("id").alias("root"))
    stars = mine.join(group, ["label", "core"]).select("id", (F.col("all") - F.col("w")).alias("n"), "root")
    return shared.put(found.union(stars), "links")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD,
                 overlap: int = OVERLAP, beam: int = BEAM, report: list | None = None) -> DataFrame:
    """(id_col, n_links, component_id, kept) for every id of ``vectors``; ``report`` gets (overlap, audited links,
    audited links found) of each search."""
    spark = vectors.sparkSession
    shared = Shared(spark, "flat-graph")
    single = vectors.schema[vec_col].dataType.elementType.simpleString() == "float"
    kind = np.float32 if single else np.float64
    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).cast("array<float>" if single else "array<double>").alias("v")).where("id is not null")
    if src.groupBy("id").count().where("count > 1").limit(1).count():
        src = src.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")
    good = src.where(F.col("label").isNotNull() & sound("v", zero=False))
    dim = most_common_size(good, "v")
    name = [F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id")]
    kept = (F.col(id_col) == F.col("component_id")).alias("kept")
    if dim is None:
        return src.select("id", F.lit(0).alias("n"), F.col("id").alias("component")).select(*name).select("*", kept)

    def packed(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), binary(flat(b.column(2), kind) + kind(0))], ["id", "label", "vec"])  # no minus zeros

    table = shared.put(good.where(F.size("v") == dim).mapInArrow(packed, "id long, label string, vec binary"), "vectors")
    keyed = table.select("id", "label", F.unhex(F.sha1("vec")).alias("key"))
    copies = keyed.groupBy("label", "key").agg(F.min("id").alias("rep"), F.count("*").alias("w")).where("w > 1")
    copies = shared.put(keyed.join(copies, ["label", "key"]).select("id", "rep", "w"), "copies")
    nodes = table.join(copies, "id", "left").where("rep is null or rep = id").select("id", "label", "vec", F.coalesce("w", F.lit(1)).alias("w"))
    nodes = shared.put(nodes, "nodes")

    per = nodes.groupBy("label").count().agg(F.sum(F.col("count") * F.col("count").cast("double")).alias("squares"), F.sum("count").alias("n")).first()
    clusters = math.ceil(per["squares"] / per["n"] / PER_CLUSTER)
    clusters = min(MOST_MEDOIDS, clusters) if clusters > overlap else 1
    drawn = nodes.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vec").toArrow()
    mids = spark.sparkContext.broadcast(medoids(unit(matrix(drawn["vec"], kind).astype(np.float64)), clusters, math.cos(math.acos(threshold) / 2)))

    chosen = nodes.orderBy(F.xxhash64("id", F.lit("audit")), "id").limit(AUDIT).toArrow()
    asked = spark.sparkContext.broadcast((chosen["id"].to_numpy(), np.array(chosen["label"].to_pylist(), object), unit(matrix(chosen["vec"], kind).astype(np.float64))))
    truth = {r["id"]: r["n"] for r in nodes.mapInArrow(_true_links(kind, asked, threshold), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()}
    while True:
        links = _graph_links(nodes, shared, kind, mids, overlap, beam, threshold)
        n = shared.put(links.groupBy("id").agg(F.sum("n").alias("n")), "counts")
        found = n.join(F.broadcast(spark.createDataFrame([(i,) for i in truth], "id long")), "id").agg(F.sum("n")).first()[0] or 0
        if report is not None:
            report.append((overlap, sum(truth.values()), found))
        if found >= RECALL * sum(truth.values()) or overlap >= len(mids.value):
            break
        overlap, beam = 2 * overlap, 2 * beam

    comp = components(links.select(F.col("id").alias("u"), F.col("root").alias("v")).where("u <> v"), shared)
    all_ = src.select("id").join(copies, "id", "left").withColumn("rep", F.coalesce("rep", "id"))
    all_ = all_.join(n.withColumnRenamed("id", "rep"), "rep", "left").join(comp.withColumnRenamed("id", "rep"), "rep", "left")
    all_ = all_.select("id", (F.coalesce("n", F.lit(0)) + F.coalesce("w", F.lit(1)) - 1).alias("n"), F.coalesce("component", "rep").alias("component"))
    return all_.select(*name).select("*", kept)


def op11_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of ``embeddings`` of one label that are alike to 0.93 or more."""
    return near_vectors(source(spark, sf_dir, "embeddings"))


#: The same in DuckDB's SQL: all pairs of a label, reachability.
OP11_SQL = """
with recursive v as materialized (select vec_id, label, list_transform(embedding, lambda e: cast(e as double)) as x from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = len(embedding)),
u as materialized (select vec_id, label, x, sqrt(list_dot_product(x, x)) as l from v where list_dot_product(x, x) > 0),
k as materialized (select a.vec_id as a, b.vec_id as b from u a join u b on a.label = b.label and a.vec_id < b.vec_id
  where list_dot_product(a.x, b.x) / (a.l * b.l) >= 0.93),
e as materialized (select a, b from k union all select b, a from k),
r as (select vec_id, vec_id as other from embeddings union select r.vec_id, e.b from r join e on r.other = e.a),
n as (select a, count(*) as n from e group by a)
select r.vec_id, cast(coalesce(any_value(n.n), 0) as bigint) as n_links, min(other) as component_id, r.vec_id = min(other) as kept
from r left join n on n.a = r.vec_id group by r.vec_id
"""
