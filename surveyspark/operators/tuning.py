"""Model training and tuning on feature vectors with Spark ML.

The reference trains image networks per fold; here the same protocol runs on
feature vectors: group-disjoint folds (``operators.folds``), one distributed
``LogisticRegression`` fit per fold (a driver loop over at most ``n_folds``
fits, each one a distributed job), out-of-fold predictions as a table, and
grid and random searches whose trials keep their per-fold metrics.
"""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..session import materialize
from . import evaluation, folds


def top_trials(trials: DataFrame, n: int = 5, order: list[Column] | None = None) -> DataFrame:
    """Best ``n`` trials by macro-F1 (ties by the remaining order columns)."""
    return trials.orderBy(*(order or [F.col("macro_f1").desc()])).limit(n)


def _prepare(feats: DataFrame, n_folds: int, features_col="embedding") -> DataFrame:
    """Feature vectors with folds, written once: every fit and prediction reads this table. Features that carry
    a ``fold`` already (assigned earlier) keep it."""
    with_folds = feats if "fold" in feats.columns else folds.assign_folds(feats, n_folds)
    narrow = with_folds.select("row_id", "fold", F.col("label").cast("int").alias("label"), F.col(features_col).cast("array<double>").alias("_x"))
    table = materialize(narrow, "features")
    return table.select("row_id", "fold", F.col("label").cast("double").alias("label"), array_to_vector("_x").alias("features"))


def _out_of_fold(data: DataFrame, trials: list[dict], n_folds: int, model_dir: str | None = None, parallelism: int = 1) -> DataFrame:
    """``(trial, row_id, fold, label, pred, confidence)``: each trial's model of a fold, fitted on the other
    folds, on that fold's rows. Fits are distributed jobs; at most ``parallelism`` run at a time."""
    def fit(task):
        t, k = task
        return LogisticRegression(**trials[t]).fit(data.where(F.col("fold") != k))

    tasks = [(t, k) for t in range(len(trials)) for k in range(n_folds)]
    with ThreadPool(parallelism) as pool:
        models = pool.map(fit, tasks)
    outs = []
    for (t, k), model in zip(tasks, models):
        if model_dir:
            model.write().overwrite().save(f"{model_dir.rstrip('/')}/fold={k}")
        pred = model.transform(data.where(F.col("fold") == k))
        outs.append(pred.select(F.lit(t).alias("trial"), "row_id", "fold", F.col("label").cast("int").alias("label"),
                                F.col("prediction").cast("int").alias("pred"),
                                F.array_max(vector_to_array("probability")).alias("confidence")))
    return reduce(DataFrame.unionByName, outs)


def train_folds(feats: DataFrame, n_folds: int = config.N_FOLDS, max_iter: int = 50, reg: float = 0.0,
                features_col: str = "embedding", model_dir: str | None = None) -> DataFrame:
    """Out-of-fold predictions ``(row_id, fold, label, pred, confidence)``.

    With ``model_dir`` (a shared folder) each fold's model is saved under
    ``<model_dir>/fold=<k>`` and can be reloaded with ``LogisticRegressionModel.load``.
    """
    data = _prepare(feats, n_folds, features_col)
    return _out_of_fold(data, [{"maxIter": max_iter, "regParam": reg}], n_folds, model_dir).drop("trial")


def fold_metrics(preds: DataFrame, n_classes: int, keys=("fold",)) -> DataFrame:
    """Accuracy and macro-F1 of each fold (and each further key) of out-of-fold predictions."""
    return evaluation.overall_metrics(preds, n_classes, keys)


def _search(feats: DataFrame, n_classes: int, trials: list[dict], n_folds: int, features_col: str, parallelism: int) -> tuple[DataFrame, DataFrame]:
    """Per-fold metrics of all trials ``(trial, fold, accuracy, macro_f1, n)`` and their averages, from one
    evaluation over the union of all predictions."""
    preds = _out_of_fold(_prepare(feats, n_folds, features_col), trials, n_folds, parallelism=parallelism)
    per_fold = materialize(fold_metrics(preds, n_classes, ("trial", "fold")), "trials")
    mean = evaluation.fold_average(per_fold, ("trial",)).select(
        "trial", F.col("accuracy_mean").alias("accuracy"), "accuracy_std", F.col("macro_f1_mean").alias("macro_f1"), "macro_f1_std")
    folds_of = per_fold.groupBy("trial").agg(F.sort_array(F.collect_list(F.struct("fold", "accuracy", "macro_f1", "n"))).alias("folds"))
    return per_fold, mean.join(folds_of, "trial")


def grid_search(feats: DataFrame, n_classes: int, reg_params=(0.0, 0.1), elastic=(0.0,), max_iter=(20,),
                n_folds: int = 3, features_col: str = "embedding", parallelism: int = 2) -> DataFrame:
    """Every grid point scored by grouped CV: ``(trial, params..., accuracy, macro_f1, their stds, folds)``;
    ``folds`` has each fold's metrics."""
    grid = [(r, e, m) for r in reg_params for e in elastic for m in max_iter]
    _, scored = _search(feats, n_classes, [{"regParam": r, "elasticNetParam": e, "maxIter": m} for r, e, m in grid],
                        n_folds, features_col, parallelism)
    params = feats.sparkSession.createDataFrame([(i, float(r), float(e), int(m)) for i, (r, e, m) in enumerate(grid)],
                                                "trial int, reg_param double, elastic_net double, max_iter int")
    return params.join(scored, "trial")


def random_search(feats: DataFrame, n_classes: int, n_trials: int, space: dict | None = None,
                  seed: int = config.SEED, n_folds: int = 3, features_col: str = "embedding",
                  parallelism: int = 2) -> DataFrame:
    """Seeded random search: ``n_trials`` draws (with replacement) from each parameter
    list (``sampling.random_params``), each scored as in :func:`grid_search`. The draws
    are a short table read once on the driver."""
    from .sampling import random_params
    space = space or {"regParam": [0.0, 0.01, 0.1], "elasticNetParam": [0.0, 0.5], "maxIter": [10, 20]}
    draws = random_params(feats.sparkSession, n_trials, space, seed).orderBy("trial").collect()
    trials = [{k: (int(d[k]) if k == "maxIter" else float(d[k])) for k in space} for d in draws]
    _, scored = _search(feats, n_classes, trials, n_folds, features_col, parallelism)
    schema = "trial int, " + ", ".join(f"{k} double" for k in space)
    params = feats.sparkSession.createDataFrame([(i, *[float(t[k]) for k in space]) for i, t in enumerate(trials)], schema)
    return params.join(scored, "trial")
