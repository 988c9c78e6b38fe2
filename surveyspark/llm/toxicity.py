"""Toxicity by a classifier chain over label categories.

The categories are predicted in a fixed order. Each has an L1-regularised
logistic model over the words of a text and their character n-grams; from the
second category on, the logits of the earlier categories are features as well.
In training those are out-of-fold predictions, so a later model learns from
logits as unsure as the ones it will see; in scoring they come from the models
fitted on the whole sample.

The models are fitted on at most ``MAX_TRAIN`` labelled documents, those with
the smallest hashes of their ids, and at most ``MAX_FEATURES`` features a
category, so a model is small whatever the corpus. Texts of over
``MAX_TRAIN_CHARS`` characters do not train, so that the sample is bounded in
bytes as well. The sample's words and n-grams are counted and chosen by Spark
jobs; only the counts of the chosen ones come to the driver, which fits the
models. Scoring covers every row, whole, in one pass without a shuffle.

Each row of ``docs`` gives one row. Null and empty texts have no words and get
the models' base rate. Of repeated label rows of an id the largest of each
label counts; labels that are null count as 0 (not toxic, quality 1). Where the
sample lacks one of a category's two values its probability is the share seen
(0 without labels), and nothing is rejected for it. Columns of ``docs`` with the
names of the result's are replaced.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import Shared, small_batches, source
from .text import lean, release_memory

MAX_TRAIN = 4000
MAX_TRAIN_CHARS = 50_000
MAX_FEATURES = 2000
MIN_TEXTS = 5  # that have a feature
FOLDS = 4
GRAM = 5
L1 = 2e-2  # over the root of the number of rows
TASKS = 24  # that the training texts are dealt to
_CACHE = 200_000


def grams(word: str) -> list[str]:
    """A word's features: itself between marks and its character n-grams."""
    w = f"^{word}$"
    return [w, *(w[i:i + GRAM] for i in range(len(w) - GRAM + 1))] if len(w) > GRAM else [w]


def words_of(text: str | None) -> set[str]:
    return set((text or "").lower().split())


class Sparse:
    """Rows of (feature, count) with products by whole-array numpy calls."""

    def __init__(self, row: np.ndarray, col: np.ndarray, val: np.ndarray, shape: tuple[int, int]):
        self.row, self.col, self.val, self.shape = row, col, val, shape

    def take(self, keep: np.ndarray) -> Sparse:
        at = keep[self.row]
        return Sparse((np.cumsum(keep) - 1)[self.row[at]], self.col[at], self.val[at], (int(keep.sum()), self.shape[1]))

    def scaled(self, by: np.ndarray) -> Sparse:
        return Sparse(self.row, self.col, self.val * by[self.col], self.shape)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.val * w[self.col], self.shape[0])

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self.val * r[self.row], self.shape[1])


def fit(x: Sparse, y: np.ndarray, l1: float | None = None, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated proximal gradient steps (FISTA) on columns scaled to a mean square
    of one; the weights are for the columns as given. ``steps`` ends them before the optimum on small samples."""
    n = len(y)
    l1 = L1 / n ** 0.5 if l1 is None else l1
    scale = 1 / np.sqrt(np.maximum(np.bincount(x.col, x.val ** 2, x.shape[1]) / n, 1e-12))
    x = x.scaled(scale)
    probe = np.ones(x.shape[1])
    for _ in range(12):
        probe = x.back(x.dot(probe))
        probe /= np.linalg.norm(probe) or 1
    top = np.linalg.norm(x.back(x.dot(probe))) + n
    rate = 4 * n / top
    w, v, t = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 1.0
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    b = c = float(np.log(share / (1 - share)))
    for _ in range(steps):
        r = (1 / (1 + np.exp(-np.clip(x.dot(v) + c, -35, 35))) - y) / n
        w2 = v - rate * x.back(r)
        w2 = np.sign(w2) * np.maximum(np.abs(w2) - rate * l1, 0)
        b2 = c - rate * r.sum()
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, c = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    return w * scale, b


def count_grams(texts: Iterable[str | None]) -> tuple[list[str], Sparse]:
    """All features and, for each text, the number of its distinct words that have each. Words and features
    are numbered once, so the whole sample is a few integer arrays."""
    word_id: dict[str, int] = {}
    gram_id: dict[str, int] = {}
    grams_of: list[np.ndarray] = []
    rows, cols, counts = [], [], []
    for r, text in enumerate(texts):
        ids = []
        for w in words_of(text):
            i = word_id.get(w)
            if i is None:
                i = word_id[w] = len(grams_of)
                grams_of.append(np.array(sorted({gram_id.setdefault(g, len(gram_id)) for g in grams(w)}), np.int32))
            ids.append(i)
        if ids:
            col, n = np.unique(np.concatenate([grams_of[i] for i in ids]), return_counts=True)
            rows.append(np.full(len(col), r, np.int32))
            cols.append(col)
            counts.append(n.astype(np.float32))
    join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    total = r + 1 if rows else 0
    return list(gram_id), Sparse(join(rows, np.int32), join(cols, np.int32), join(counts, np.float32), (total, len(gram_id)))


def _gram_totals(n: int):
    """For each feature of a task's texts, the number of texts that have it: all, and those of each of ``n``
    categories. A feature may come in several rows."""
    def run(batches):
        kinds = pa.schema([("gram", pa.string()), ("df", pa.int64()), *((f"n{c}", pa.int64()) for c in range(n))])
        counts = [Counter() for _ in range(n + 1)]

        def rows():
            found = list(counts[0])
            for i in range(0, len(found), 10_000):
                part = found[i:i + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *(pa.array([of[g] for g in part], pa.int64()) for of in counts)], schema=kinds)
            for of in counts:
                of.clear()

        for b in batches:
            for text, *y in zip(*(col.to_pylist() for col in b.columns)):
                has = {g for w in words_of(text) for g in grams(w)}
                for of, hit in zip(counts, (1, *y)):
                    if hit:
                        of.update(has)
                if len(counts[0]) > _CACHE:
                    yield from rows()
        yield from rows()
    return lean(run)


def _chosen_counts(shared_place, n: int):
    """For each text, its id and labels, the numbers of the chosen features that it has and the number of its
    distinct words that have each."""
    place = shared_place.value

    def run(batches):
        for b in batches:
            col, count = [], []
            for text in b.column(n + 1).to_pylist():
                got = Counter(place[g] for w in words_of(text) for g in {*grams(w)} if g in place)
                col.append(sorted(got))
                count.append([got[i] for i in col[-1]])
            yield pa.RecordBatch.from_arrays([*b.columns[:n + 1], pa.array(col, pa.list_(pa.int32())), pa.array(count, pa.list_(pa.int32()))],
                                             [*b.schema.names[:n + 1], "col", "n"])
    return lean(run)


def count_chosen(sample: DataFrame, n: int) -> tuple[tuple[list[str], Sparse], list[int], np.ndarray]:
    """What ``train_chain`` takes, from ``sample`` with ``_id``, ``_y0`` ... and ``_text``: the features that ``select``
    chooses for one of the ``n`` categories with their counts, the ids in order, and the labels.

    ``select`` chooses among these as among all, since it scores each feature by itself."""
    spark, marks = sample.sparkSession, [f"_y{c}" for c in range(n)]
    total = sample.agg(F.count("*"), *(F.sum(m) for m in marks)).first()
    fields = ", ".join(["gram string, df long", *(f"n{c} long" for c in range(n))])
    shared = Shared(spark, "toxicity")
    found = sample.select("_text", *marks).mapInArrow(_gram_totals(n), fields).groupBy("gram").agg(*(F.sum(c).alias(c) for c in ("df", *(f"n{c}" for c in range(n)))))
    found = shared.put(found.where((F.col("df") >= MIN_TEXTS) & (F.col("df") < total[0])), "grams")
    names: dict[str, int] = {}
    for c in range(n):
        df, here = F.col("df").cast("double"), F.lit(float(total[c + 1] or 0))
        diff = F.col(f"n{c}") * F.lit(float(total[0])) - df * here
        best = found.where(diff > 0).orderBy(F.desc(diff * diff / (df * (float(total[0]) - df))), "gram").limit(MAX_FEATURES)
        for g in best.select("gram").toArrow()["gram"].to_pylist():
            names.setdefault(g, len(names))
    shared.close()
    kept = ", ".join(["_id long", *(f"{m} int" for m in marks), "col array<int>, n array<int>"])
    rows = sample.select("_id", *marks, "_text").mapInArrow(_chosen_counts(spark.sparkContext.broadcast(names), n), kept).orderBy("_id").toArrow()
    flat = lambda name, kind: np.concatenate([np.zeros(0, kind), *(c.flatten().to_numpy().astype(kind) for c in rows[name].chunks)])
    sizes = pc.list_value_length(rows["col"]).to_numpy()
    x = Sparse(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), flat("col", np.int32), flat("n", np.float32), (len(sizes), len(names)))
    return (list(names), x), rows["_id"].to_pylist(), np.column_stack([rows[m].to_numpy() for m in marks])


def select(names: list[str], x: Sparse, y: np.ndarray, most: int = MAX_FEATURES) -> np.ndarray:
    """The features that speak for ``y``, in ``MIN_TEXTS`` documents or more, with the largest chi-square scores."""
    df = np.bincount(x.col, minlength=x.shape[1]).astype(np.float64)
    n1_g = np.bincount(x.col, y[x.row], x.shape[1])
    n1, n = float(y.sum()), float(len(y))
    good = np.flatnonzero((df >= MIN_TEXTS) & (n1_g * n > df * n1) & (df < n))
    diff = n1_g[good] * n - df[good] * n1
    score = diff * diff / (df[good] * (n - df[good]))
    order = sorted(range(len(good)), key=lambda i: (-score[i], names[good[i]]))
    return good[order[:most]]


def train_chain(texts: Iterable[str | None] | tuple[list[str], Sparse], ids: Sequence[int], labels: np.ndarray) -> dict:
    """``texts`` or, as a tuple, what ``count_grams`` or ``count_chosen`` made of them; ``labels`` has a column for
    each category in chain order. Returns feature weights, intercepts, the weights of earlier logits and the
    thresholds by the out-of-fold predictions (``best_cut``)."""
    fold = np.array([zlib.crc32(str(i).encode()) % FOLDS for i in ids])
    weights: dict[str, list[float]] = defaultdict(lambda: [0.0] * labels.shape[1])
    model = {"bias": [], "chain": [], "cut": []}
    earlier = np.zeros((len(ids), 0))
    names, every = texts if isinstance(texts, tuple) else count_grams(texts)
    for c in range(labels.shape[1]):
        y = labels[:, c].astype(np.float64)
        if not len(y) or y.min() == y.max():
            share = float(y.mean()) if len(y) else 0.0
            model["bias"].append(float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
            model["chain"].append([0.0] * c)
            model["cut"].append(2.0)
            earlier = np.column_stack([earlier, np.zeros(len(ids))])
            continue
        chosen = select(names, every, y, MAX_FEATURES)
        width = len(chosen)
        place = np.full(every.shape[1], -1, np.int32)
        place[chosen] = np.arange(width)
        at = place[every.col] >= 0 if every.shape[1] else np.zeros(0, bool)
        row = np.concatenate([every.row[at], np.tile(np.arange(len(y), dtype=np.int32), c)])
        col = np.concatenate([place[every.col[at]], np.repeat(width + np.arange(c, dtype=np.int32), len(y))])
        x = Sparse(row, col, np.concatenate([every.val[at].astype(np.float64), earlier.T.ravel() / 10]), (len(y), width + c))
        out = np.zeros(len(y))
        for f in range(FOLDS):
            inside = fold != f
            if inside.all() or not inside.any() or y[inside].min() == y[inside].max():
                out[~inside] = np.log(y.mean() / (1 - y.mean()))
                continue
            w, b = fit(x.take(inside), y[inside])
            out[~inside] = x.take(~inside).dot(w) + b
        w, b = fit(x, y)
        for k in np.flatnonzero(w[:width]):
            weights[names[chosen[k]]][c] = float(w[k])
        model["bias"].append(float(b))
        model["chain"].append([float(v) / 10 for v in w[width:]])
        model["cut"].append(best_cut(1 / (1 + np.exp(-np.clip(out, -35, 35))), y))
        earlier = np.column_stack([earlier, np.clip(out, -20, 20)])
    return model | {"weights": dict(weights)}


def best_cut(p: np.ndarray, y: np.ndarray, precision: float = 0.8) -> float:
    """The middle of the gap below the cut with the best F1 among those of at least ``precision``, the highest
    among equals; one half where no cut is that precise."""
    order = np.argsort(-p, kind="stable")
    hit, n = np.cumsum(y[order]), np.arange(1, len(y) + 1)
    tie = np.append(p[order][1:] == p[order][:-1], False)  # a cut takes all of one value
    f1 = np.where((hit >= precision * n) & ~tie, 2 * hit / (n + y.sum()), 0)
    k = int(np.argmax(f1))
    if not f1[k]:
        return 0.5
    below = p[order[k + 1]] if k + 1 < len(p) else 0.0
    return float((p[order[k]] + below) / 2)


def _score(shared_model, names: list[str], at: int):
    model = shared_model.value
    weights, n = model["weights"], len(names)

    def run(batches):
        cache: dict[str, tuple | None] = {}
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                b = whole.slice(i, 512)
                logit = np.zeros((n, b.num_rows))
                for r, text in enumerate(b.column(at).to_pylist()):
                    total = [0.0] * n
                    for w in words_of(text):
                        if w in cache:
                            got = cache[w]
                        else:
                            if len(cache) > _CACHE:
                                cache.clear()
                            hits = [weights[g] for g in grams(w) if g in weights]
                            got = cache[w] = tuple(map(sum, zip(*hits))) if hits else None
                        if got:
                            for c in range(n):
                                total[c] += got[c]
                    logit[:, r] = total
                for c in range(n):
                    logit[c] += model["bias"][c]
                    for k, v in enumerate(model["chain"][c]):
                        logit[c] += v * np.clip(logit[k], -20, 20)
                p = 1 / (1 + np.exp(-np.clip(logit, -35, 35)))
                yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, p)], [*b.schema.names, *names])
    return lean(run)


def toxicity_chain(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], reject: str, id_col: str = "doc_id", text_col: str = "text",
                   max_train: int = MAX_TRAIN) -> tuple[DataFrame, dict]:
    """``docs`` with a probability ``p_<category>`` for each category and ``rejected``, and the fitted model.

    ``categories``: for each name, in chain order, a 0/1 column of ``labels``; ``reject`` names the one
    whose probability rejects a document.
    """
    spark = docs.sparkSession
    names = [f"p_{c}" for c in categories]
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("_id")).agg(
        *(F.max(F.coalesce(e.cast("int"), F.lit(0))).alias(f"_y{k}") for k, e in enumerate(categories.values())))
    marks = marks.orderBy(F.xxhash64("_id"), "_id").limit(max_train).toPandas()
    shape = "_id long, " + ", ".join(f"_y{k} int" for k in range(len(categories)))
    few = F.broadcast(spark.createDataFrame([tuple(map(int, r)) for r in marks.itertuples(index=False)], shape))
    sample = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text")).join(few, "_id")
    sample = sample.where(F.coalesce(F.length("_text"), F.lit(0)) <= MAX_TRAIN_CHARS)
    sample = sample.groupBy(*few.columns).agg(F.min("_text").alias("_text"))
    shared = Shared(spark, "toxicity")
    counted, ids, y = count_chosen(shared.put(sample.repartition(TASKS, "_id"), "sample"), len(categories))
    shared.close()
    model = train_chain(counted, ids, y)
    del counted
    release_memory()
    small_batches(spark)
    docs = docs.drop(*names, "rejected")
    fields = T.StructType([*docs.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names)])
    scored = docs.mapInArrow(_score(spark.sparkContext.broadcast(model), names, docs.columns.index(text_col)), fields)
    cut = model["cut"][list(categories).index(reject)]
    return scored.withColumn("rejected", F.col(f"p_{reject}") >= cut), model


def label_categories() -> dict[str, Column]:
    """The chain over the columns of ``labels``: low quality first, then toxic."""
    return {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents``: doc_id, the chain's probabilities and whether it is rejected as toxic."""
    docs = source(spark, sf_dir, "documents").select("doc_id", "text")
    scored, _ = toxicity_chain(docs, source(spark, sf_dir, "labels"), label_categories(), "toxic")
    return scored.drop("text")
