"""Model evaluation: per-class metrics, accuracy / macro-F1, fold averages,
McNemar's paired test, calibration and confidence comparison.

Inputs are long prediction tables ``(model, [fold,] row_id, label, pred, confidence)``.
Every metric starts with a partial aggregation down to a confusion table of
at most (#classes)^2 rows per model and fold, so the work after the first
shuffle is tiny whatever the row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.stats import chi2_sf1_udf, mcnemar_exact_p_udf
from . import quantiles


def confusion(preds: DataFrame, keys=("model",)) -> DataFrame:
    return preds.groupBy(*keys, "label", "pred").agg(F.count(F.lit(1)).alias("n"))


def per_class_metrics(preds: DataFrame, n_classes: int, keys=("model",)) -> DataFrame:
    """Precision, recall, F1 and support for every class index in [0, n_classes); 0/0 -> 0."""
    keys = list(keys)
    cm = confusion(preds, keys)
    cls = F.explode(F.sequence(F.lit(0), F.lit(n_classes - 1))).alias("class_idx")
    # <= C^2 rows per key: expand each confusion cell to the classes it touches
    x = cm.select(*keys, "label", "pred", "n", cls).where(
        (F.col("label") == F.col("class_idx")) | (F.col("pred") == F.col("class_idx")))
    agg = x.groupBy(*keys, "class_idx").agg(
        F.sum(F.when((F.col("label") == F.col("class_idx")) & (F.col("pred") == F.col("class_idx")),
                     F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when((F.col("label") != F.col("class_idx")) & (F.col("pred") == F.col("class_idx")),
                     F.col("n")).otherwise(0)).alias("fp"),
        F.sum(F.when((F.col("label") == F.col("class_idx")) & (F.col("pred") != F.col("class_idx")),
                     F.col("n")).otherwise(0)).alias("fn"))
    all_cls = cm.select(*keys).distinct().select(*keys, cls)
    m = all_cls.join(agg, [*keys, "class_idx"], "left").na.fill(0, ["tp", "fp", "fn"])
    p = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    return (m.withColumn("precision", p).withColumn("recall", r)
             .withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                       F.col("precision") + F.col("recall")), F.lit(0.0)))
             .withColumn("support", (F.col("tp") + F.col("fn")).cast("bigint"))
             .select(*keys, F.col("class_idx").cast("int").alias("class_idx"), "precision", "recall", "f1",
                     "support", "tp", "fp", "fn"))


def with_class_names(metrics: DataFrame, classes) -> DataFrame:
    names = F.array(*[F.lit(str(c)) for c in classes])
    return metrics.withColumn("class_name", F.element_at(names, F.col("class_idx") + 1))


def overall_metrics(preds: DataFrame, n_classes: int, keys=("model",)) -> DataFrame:
    """Accuracy and macro-F1 (averaged over labels seen in truth or prediction)."""
    keys = list(keys)
    pc = per_class_metrics(preds, n_classes, keys)
    present = pc.where((F.col("tp") + F.col("fp") + F.col("fn")) > 0)
    macro = present.groupBy(*keys).agg(F.avg("f1").alias("macro_f1"))
    acc = preds.groupBy(*keys).agg(F.avg((F.col("label") == F.col("pred")).cast("double")).alias("accuracy"),
                                   F.count(F.lit(1)).alias("n"))
    return acc.join(macro, keys, "left").select(*keys, "accuracy", F.coalesce("macro_f1", F.lit(0.0)).alias("macro_f1"),
                                                "n")


def fold_average(fold_metrics: DataFrame, keys=("model",)) -> DataFrame:
    """Unweighted mean and population std of per-fold accuracy and macro-F1."""
    return fold_metrics.groupBy(*keys).agg(
        F.avg("accuracy").alias("accuracy_mean"), F.stddev_pop("accuracy").alias("accuracy_std"),
        F.avg("macro_f1").alias("macro_f1_mean"), F.stddev_pop("macro_f1").alias("macro_f1_std"),
        F.count(F.lit(1)).alias("n_folds"))


def paired_predictions(a: DataFrame, b: DataFrame) -> DataFrame:
    """Full outer join on ``row_id``; ``status`` says which side(s) have the row."""
    aa = a.select("row_id", F.col("label").alias("label_a"), F.col("pred").alias("pred_a"),
                  F.col("confidence").alias("conf_a"))
    bb = b.select("row_id", F.col("label").alias("label_b"), F.col("pred").alias("pred_b"),
                  F.col("confidence").alias("conf_b"))
    j = aa.join(bb, "row_id", "full_outer")
    status = (F.when(F.col("pred_a").isNull() & F.col("label_a").isNull(), F.lit("only_b"))
               .when(F.col("pred_b").isNull() & F.col("label_b").isNull(), F.lit("only_a"))
               .otherwise(F.lit("both")))
    return j.withColumn("status", status).withColumn("label", F.coalesce("label_a", "label_b"))


def row_set_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Row ids in exactly one of the two prediction sets (empty means identical sets)."""
    ia, ib = a.select("row_id"), b.select("row_id")
    return (ia.exceptAll(ib).withColumn("side", F.lit("only_a"))
            .unionByName(ib.exceptAll(ia).withColumn("side", F.lit("only_b"))))


def require_same_rows(a: DataFrame, b: DataFrame) -> None:
    """Raise when the two models were evaluated on different rows (one small job)."""
    if not row_set_diff(a, b).isEmpty():
        raise ValueError("The two models were evaluated on different row indices.")


def mcnemar_table(paired: DataFrame, keys=()) -> DataFrame:
    ca = F.col("pred_a") == F.col("label")
    cb = F.col("pred_b") == F.col("label")
    t = paired.groupBy(*keys).agg(
        F.count_if(ca & cb).alias("both_correct"), F.count_if(ca & ~cb).alias("only_a_correct"),
        F.count_if(~ca & cb).alias("only_b_correct"), F.count_if(~ca & ~cb).alias("both_wrong"))
    return t.withColumn("n_discordant", F.col("only_a_correct") + F.col("only_b_correct"))


def mcnemar_test(table: DataFrame, exact: bool = True) -> DataFrame:
    """Statistic, p-value and interpretation from a McNemar table."""
    b, c = F.col("only_a_correct"), F.col("only_b_correct")
    if exact:
        out = table.withColumn("statistic", F.least(b, c).cast("double")) \
                   .withColumn("p_value", mcnemar_exact_p_udf(b, c))
    else:
        n = b + c
        stat = F.when(n > 0, F.pow(F.abs(b - c) - 1.0, 2) / n).otherwise(F.lit(float("nan")))
        out = table.withColumn("statistic", stat).withColumn("p_value", chi2_sf1_udf(F.col("statistic")))
    return out.withColumn("interpretation", F.when(F.col("p_value") < 0.05, F.lit(config.MCNEMAR_SIGNIFICANT))
                          .otherwise(F.lit(config.MCNEMAR_NOT_SIGNIFICANT)))


def calibration(preds: DataFrame, keys=("model",)) -> DataFrame:
    """Mean confidence when right / wrong, counts, accuracy, min / max and the
    recommended threshold (25th percentile, linear, of the confidences of correct
    rows; 0.5 when there are none). A model whose confidences are all missing
    gets a warning instead.

    The percentile is exact and takes a fixed number of passes
    (:func:`quantiles.exact_quantile`), so no task ever holds a model's
    confidences; the per-model result is joined back.
    """
    keys = list(keys)
    conf = F.nanvl(F.col("confidence"), F.lit(None).cast("double"))
    ok = F.col("pred") == F.col("label")
    agg = preds.groupBy(*keys).agg(
        F.avg(F.when(ok, conf)).alias("mean_confidence_correct"),
        F.avg(F.when(~ok, conf)).alias("mean_confidence_incorrect"),
        F.count_if(ok).alias("n_correct"), F.count_if(~ok).alias("n_incorrect"),
        (F.count_if(ok) / F.count(F.lit(1))).alias("accuracy"),
        F.min(conf).alias("min_confidence"), F.max(conf).alias("max_confidence"),
        F.count(conf).alias("_n_conf"))
    q25 = quantiles.exact_quantile(preds.where(ok), "confidence", 0.25, keys).select(
        *keys, F.col("quantile").alias("_q25"))
    return (agg.join(q25, keys, "left")
               .withColumn("recommended_threshold", F.coalesce("_q25", F.lit(0.5)))
               .withColumn("warning", F.when(F.col("_n_conf") == 0,
                                             F.lit("No confidence data in fold 0 predictions")))
               .drop("_n_conf", "_q25"))


def confidence_compare(paired: DataFrame, keys=(), margin: float = 0.1) -> DataFrame:
    """NaN-ignoring mean / population std per model and rows where one model is
    more confident than the other by more than ``margin``."""
    a = F.nanvl(F.col("conf_a"), F.lit(None).cast("double"))
    b = F.nanvl(F.col("conf_b"), F.lit(None).cast("double"))
    d = b - a
    return paired.groupBy(*keys).agg(
        F.avg(a).alias("mean_conf_a"), F.stddev_pop(a).alias("std_conf_a"),
        F.avg(b).alias("mean_conf_b"), F.stddev_pop(b).alias("std_conf_b"),
        F.count_if(d > margin).alias("n_b_more_confident"),
        F.count_if(d < -margin).alias("n_a_more_confident"))


def compare_models(paired: DataFrame, keys=("model_a", "model_b"), exact: bool = True) -> DataFrame:
    """McNemar + confidence comparison for every model pair in one job."""
    keys = list(keys)
    if not keys:
        raise ValueError("compare_models needs the model-pair key columns")
    t = mcnemar_test(mcnemar_table(paired, keys), exact)
    # both sides hold one row per model pair
    return t.join(confidence_compare(paired, keys), keys, "inner")
