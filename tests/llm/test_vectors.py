"""Operators on embeddings against plain versions: whitening, clustering, the flat graph."""
import hashlib
import math

import numpy as np
import pytest

from surveyspark.llm import flat_graph, whitening
from surveyspark.llm.centroid_clustering import DIM, centroid_clusters, lower_bounds, nearest_centroid, op13_centroid_clusters, squared
from surveyspark.llm.flat_graph import near_vectors, op11_flat_graph
from surveyspark.llm.whitening import leading_eigenpairs, op12_whitening, whiten

from .data import SF, table, union_find

NAN, INF = float("nan"), float("inf")


# --- clustering

def plain_clusters(rows, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * float(c)) for c in v]) for i, v in rows if v is not None and len(v) == DIM and all(c is not None and math.isfinite(c) for c in v)]
    start = sorted(kept, key=lambda r: hashlib.sha256(f"3:{r[0]}".encode()).hexdigest())[:k]
    x, centroids = np.array([v for _, v in kept], np.int64), [v for _, v in start]
    for r in range(rounds + 1):
        c = np.array(centroids, np.int64)
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        at = d.argmin(1)
        if r < rounds:
            for j in set(at.tolist()):
                n = int((at == j).sum())
                centroids[j] = [s // n for s in x[at == j].sum(0).tolist()]
    best = d.min(1)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((i, int(a), int(b), int(best[at == a].sum()), int(best.sum()), sha[a]) for (i, _), a, b in zip(kept, at, best))


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.1"])
def test_op13_matches_full_search(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in table("embeddings", sf)]
    assert sorted(tuple(x) for x in op13_centroid_clusters(spark, sf).collect()) == plain_clusters(rows)


def test_bounds_are_below_and_prune():
    r = np.random.default_rng(1)
    for scale in (3, 1000, 2 ** 27):
        x, c, p = (r.integers(-scale, scale, (n, 64)) for n in (300, 8, 6))
        p[1] = p[0]
        dist = lambda a, b: np.sqrt(np.stack([squared(a, y) for y in b], 1).astype(float))
        low = lower_bounds(dist(x, p), dist(c, p), dist(p, p))
        assert (low <= dist(x, c)).all() and (low > 0).any()
    centres = r.integers(-500, 500, (8, 64))
    x = centres[r.integers(0, 8, 2000)] + r.integers(-20, 20, (2000, 64))
    cluster, best, done = nearest_centroid(x, dist(x, centres), centres, centres)
    full = np.stack([squared(x, y) for y in centres], 1)
    assert (cluster == full.argmin(1)).all() and (best == full.min(1)).all() and done < 1.1 * len(x)


def test_clusters_of_odd_tables(spark):
    v = [float(i % 5) for i in range(DIM)]
    rows = [(1, v), (2, None), (3, v[:-1] + [None]), (4, v[:-1] + [NAN]), (5, v[:-1] + [INF]), (6, v[:5]), (None, v), (7, v[:-1] + [1e30]), (1, v), (8, [x + 1 for x in v]), (9, [-x / 3 for x in v])]
    schema = "vec_id long, embedding array<double>, id string, cluster int"
    docs = spark.createDataFrame([(*r, "x", 5) for r in rows], schema)
    kept = [r for r in rows if r[0] is not None and r[0] != 7]
    assert sorted(tuple(x) for x in centroid_clusters(docs).collect()) == plain_clusters(kept)
    assert centroid_clusters(docs.limit(0)).count() == 0 and centroid_clusters(docs.where("vec_id = 2")).count() == 0
    same = spark.createDataFrame([(i, v) for i in range(20)], "vec_id long, embedding array<double>")
    assert {(x.cluster, x.distance, x.inertia) for x in centroid_clusters(same).collect()} == {(0, 0, 0)}


# --- whitening

def check_whitening(rows, got, k=8, dim=None):
    kept = [(i, [math.floor(1024 * float(c)) + 100_000 for c in v]) for i, v in rows
            if v and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    x = [v for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    dev = {}
    for i, v in kept:
        dev[i] = sum((n * a - s) ** 2 for a, s in zip(v, sums))
    y = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in x])
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    want = y @ u / np.sqrt(e)
    w = {}
    for r in got:
        assert r.n == n and r.deviation == (dev[r.vec_id] if dev[r.vec_id] < 2 ** 63 else None) and r.identity_error < 1e-4
        assert r.explained == pytest.approx(e[r.component - 1] * n / (y * y).sum(), rel=1e-6)
        w[r.vec_id, r.component] = r.whitened
    assert len(got) == len(w) == n * k
    for c in range(k):
        mine = np.array([w[i, c + 1] for i, _ in kept])
        assert np.allclose(mine, want[:, c] * np.sign(mine @ want[:, c]), atol=1e-7)


def test_op12_matches_numpy(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in table("embeddings")]
    check_whitening(rows, op12_whitening(spark, SF).collect(), dim=64)


def test_whitening_of_odd_tables(spark):
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=5).tolist()) for i in range(50)]
    rows += [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [NAN] * 5), (103, [INF] * 5), (104, [1.0]), (105, []), (106, [1e30] * 5)]
    schema = "vec_id long, embedding array<double>, n int, component string"
    docs = spark.createDataFrame([(*x, 1, "c") for x in rows], schema)
    check_whitening(rows[:50], whiten(docs).collect(), k=5, dim=5)
    far = [(i, [v * 1e9 for v in x]) for i, x in rows[:50]]  # deviations beyond a long
    got = whiten(spark.createDataFrame(far, "vec_id long, embedding array<double>")).collect()
    assert any(x.deviation is None for x in got)
    check_whitening(far, got, k=5, dim=5)
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 7.0]) for i in range(5)], "vec_id long, embedding array<double>")
    one = whiten(flat).collect()
    assert {x.component for x in one} == {1} and one[0].explained == pytest.approx(1)
    for few in (docs.limit(0), docs.where("vec_id >= 100 and vec_id < 104"), docs.where("vec_id = 1"), flat.where("vec_id = 2").union(flat.where("vec_id = 2"))):
        assert whiten(few).count() == 0


def test_filter_certifies_small_gaps(monkeypatch):
    r = np.random.default_rng(5)
    basis = np.linalg.qr(r.normal(size=(120, 120)))[0]
    for e in (np.linspace(1, 0.999, 120), np.ones(120), np.r_[np.ones(60), np.full(60, 1 - 1e-6)], np.r_[1.0, np.zeros(119)], 0.5 ** np.arange(120)):
        v = basis * e @ basis.T
        passes = []
        got, u, history = leading_eigenpairs(lambda q: passes.append(1) or v @ q, 120, 8)
        assert np.allclose(got, np.sort(e)[::-1][:8], atol=1e-9) and len(passes) < 400
        assert np.abs(u.T @ u - np.eye(u.shape[1])).max() < 1e-12 and history[-1] < 1e-9
    assert whitening.TOL < whitening.FLOOR


# --- the flat graph

def plain_links(rows, t=0.93):
    ids = sorted({i for i, _, _ in rows if i is not None})
    least = {}
    for i, label, v in rows:
        if i is not None and (i not in least or (label is not None, label, v) < least[i]):
            least[i] = (label is not None, label, v)
    good = [(i, la, np.array(v, float)) for i, (ok, la, v) in least.items() if ok and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    n, pairs = dict.fromkeys(ids, 0), []
    for label in {la for _, la, _ in good}:
        mine = [(i, v) for i, la, v in good if la == label]
        x = np.stack([v for _, v in mine])
        size = np.sqrt((x * x).sum(1))
        a, b = np.nonzero(np.triu(x @ x.T / np.outer(size, size) >= t, 1))
        for p, q in zip(a.tolist(), b.tolist()):
            pairs.append((mine[p][0], mine[q][0]))
            n[mine[p][0]] += 1
            n[mine[q][0]] += 1
    return {i: (n[i], c, c == i) for i, c in union_find(ids, pairs).items()}


def vector_groups(seed=1, dim=24):
    """(id, label, vector): noise, near copies of few centres (tight and loose), copies, multiples and chains."""
    r = np.random.default_rng(seed)
    rows = [v for v in r.normal(size=(600, dim))]
    for spread, size in ((0.02, 150), (0.2, 150), (0.27, 100), (0.35, 60)):
        centre = r.normal(size=dim)
        rows += [centre * r.uniform(0.5, 3) + spread * np.linalg.norm(centre) / dim ** 0.5 * r.normal(size=dim) for _ in range(size)]
    rows += [rows[3]] * 20 + [rows[4] * k for k in range(2, 30)]
    a, b = r.normal(size=(2, dim))
    a, b = a / np.linalg.norm(a), b / np.linalg.norm(b)
    b -= a * (a @ b)
    b /= np.linalg.norm(b)
    rows += [a * math.cos(0.3 * i) + b * math.sin(0.3 * i) for i in range(12)]
    order = r.permutation(len(rows))
    return [(int(i), int(r.integers(0, 2)) if i % 7 == 0 else 1, [float(c) for c in rows[o]]) for i, o in enumerate(order)]


@pytest.mark.parametrize("per_cluster,part,dense", [(250, 2048, 0.02), (40, 64, 0.02), (60, 100, 2.0)])
def test_graph_links_match_brute_force(spark, monkeypatch, per_cluster, part, dense):
    for name, value in (("PER_CLUSTER", per_cluster), ("PART", part), ("DENSE", dense)):
        monkeypatch.setattr(flat_graph, name, value)
    rows, report = vector_groups(), []
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in near_vectors(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"), report=report).collect()}
    want = plain_links(rows)
    assert set(got) == set(want) and all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _, _ in got.values()) >= 0.95 * sum(n for n, _, _ in want.values())
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.95 * len(want)
    assert report[-1][2] >= 0.95 * report[-1][1] > 0


def test_cores_are_counted_without_pairs(spark, monkeypatch):
    r = np.random.default_rng(2)
    x = r.normal(size=16) + 0.01 * r.normal(size=(3000, 16))
    tiles = []
    monkeypatch.setattr(flat_graph, "_searched", lambda *a: lambda t: tiles.append(1) or (_ for _ in ()).throw(AssertionError("searched")))
    docs = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(x)], "vec_id long, label int, embedding array<double>")
    assert {(x.n_links, x.component_id) for x in near_vectors(docs).collect()} == {(2999, 0)}


def test_robust_pruned_graph_and_range_search():
    r = np.random.default_rng(4)
    x = flat_graph.unit(np.vstack([r.normal(size=(700, 16)), r.normal(size=16) + 0.2 * r.normal(size=(80, 16))])).astype(np.float32)
    near = flat_graph.robust_pruned(x)
    s = x @ x.T
    np.fill_diagonal(s, -4)
    assert (near[:, 0] == s.argmax(1)).all()  # the nearest row is always kept
    for i in range(0, 780, 60):
        kept = near[i][near[i] >= 0]
        d = lambda a, b: math.sqrt(max(0.0, 2 - 2 * float(x[a] @ x[b])))
        assert all(flat_graph.ALPHA * d(p, q) > d(i, q) - 1e-5 for k, q in enumerate(kept) for p in kept[:k])
    adj = np.full((780, 780), -1)
    for u, v in {(a, b) for i, row in enumerate(near) for j in row if j >= 0 for a, b in ((i, int(j)), (int(j), i))}:
        adj[u, (adj[u] >= 0).sum()] = v
    u, v = flat_graph.range_search(x, adj, [0], x, np.full(780, -1), 32, 0.85, 0.93)
    want = {(a, b) for a, b in zip(*np.nonzero(x @ x.T >= 0.93))}
    assert set(zip(u.tolist(), v.tolist())) <= want and len(u) >= 0.95 * len(want) and len(set(zip(u, v))) == len(u)


def test_graph_of_odd_tables(spark):
    rows = [(1, 1, [1.0, 0.0]), (2, 1, [2.0, 0.0]), (3, 2, [1.0, 0.0]), (4, None, [1.0, 0.0]), (5, 1, None), (6, 1, [0.0, 0.0]), (7, 1, [NAN, 1.0]), (8, 1, [INF, 1.0]), (9, 1, [1.0, None]),
            (10, 1, []), (None, 1, [1.0, 0.0]), (11, 1, [1.0, 0.0]), (11, 1, [1.0, 0.0]), (12, 1, [1.0, 0.0]), (13, 1, [0.0, 1.0]), (14, 1, [1e200, 1e190]), (15, 1, [-1.0, -0.0])]
    docs = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, label int, embedding array<double>, n int, shard string")
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in near_vectors(docs).collect()}
    linked = {1, 2, 11, 12, 14}
    assert got == {i: (4, 1, i == 1) if i in linked else (0, i, True) for i in range(1, 16)}
    assert near_vectors(docs.limit(0)).count() == 0
    assert [tuple(x) for x in near_vectors(docs.where("vec_id = 5")).collect()] == [(5, 0, 5, True)]


@pytest.mark.parametrize("sf", [SF, "/root/testdata/check_h"])
def test_op11_recall_on_given_tables(spark, sf):
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in table("embeddings", sf)]
    want, got = plain_links(rows), {x.vec_id: (x.n_links, x.component_id, x.kept) for x in op11_flat_graph(spark, sf).collect()}
    assert set(got) == set(want) and all(got[i][0] <= want[i][0] for i in want)
    total, found = (sum(n for n, _, _ in z.values()) for z in (want, got))
    print("links", total, "found", found)
    assert found >= 0.95 * total
