"""Score classifier outputs: softmax, arg-max, abstention, top-3, error rows.

Everything here is a narrow projection over the input rows (one output row
per input row, no shuffle), so scoring runs at scan speed in whole-stage
codegen. The class list is a short Python list (the model's output classes,
read once from the metrics file or from :func:`class_index`), inlined as a
literal array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.scoring import argmax, softmax, top_k, valid_logits


def class_index(df: DataFrame, label_col: str = "label") -> DataFrame:
    """``(label, class_idx)``: index = rank of the label among sorted distinct labels."""
    labels = df.select(F.col(label_col).alias("label")).where(F.col("label").isNotNull()).distinct()
    # one row per class: the un-partitioned window runs over the class list only
    return labels.withColumn("class_idx", (F.row_number().over(Window.orderBy("label")) - 1).cast("int"))


def class_list(df: DataFrame, label_col: str = "label") -> list[str]:
    """Sorted class names (a short driver-side list)."""
    return [r["label"] for r in class_index(df, label_col).orderBy("class_idx").collect()]


def _names(classes) -> Column:
    return F.array(*[F.lit(str(c)) for c in classes])


def score(df: DataFrame, classes, threshold: float = config.PREDICTOR_THRESHOLD,
          logits_col: str = "logits", threshold_col: str | None = None) -> DataFrame:
    """Add ``probs, pred_idx, predicted_class, confidence, abstain, top_3, error``.

    A row whose logits are null, empty, non-finite or of the wrong length is
    kept with null class and confidence, ``abstain = true`` and an error text
    (never raises). ``threshold_col`` may hold a per-row override as text or
    number; one that does not parse as a number is an error too (no range
    check: a threshold above 1 simply makes every row abstain).
    """
    names = _names(classes)
    n = len(classes)
    lg = F.col(logits_col).cast("array<double>")
    ok_shape = valid_logits(lg) & (F.size(lg) == n)
    if threshold_col:
        t_raw = F.col(threshold_col)
        t_num = t_raw.cast("string").try_cast("double")
        t_bad = t_raw.isNotNull() & t_num.isNull()
        t = F.coalesce(t_num, F.lit(float(threshold)))
    else:
        t_bad = F.lit(False)
        t = F.lit(float(threshold))
    ok = ok_shape & ~t_bad
    probs = softmax(lg)
    out = df.withColumn("_ok", ok).withColumn("probs", F.when(F.col("_ok"), probs))
    idx = argmax(F.col("probs"))
    out = (out.withColumn("pred_idx", F.when(F.col("_ok"), idx))
              # guarded: element_at of a literal array with a null index is not null here
              .withColumn("predicted_class", F.when(F.col("pred_idx").isNotNull(),
                                                    F.element_at(names, F.col("pred_idx") + 1)))
              .withColumn("confidence", F.element_at(F.col("probs"), F.col("pred_idx") + 1))
              .withColumn("abstain", F.when(F.col("_ok"), F.col("confidence") < t).otherwise(F.lit(True)))
              .withColumn("top_3", F.when(F.col("_ok"), F.transform(
                  top_k(F.col("probs"), 3),
                  lambda s: F.struct(F.element_at(names, s["idx"] + 1).alias("class"),
                                     s["p"].alias("confidence")))))
              .withColumn("error", F.when(F.col("_ok"), F.lit(None).cast("string"))
                          .when(F.col(logits_col).isNull(), F.lit("missing logits"))
                          .when(t_bad, F.concat(F.lit("invalid threshold: "), F.col(threshold_col).cast("string"))
                                if threshold_col else F.lit(None).cast("string"))
                          .when(F.size(lg) != n, F.format_string(f"expected {n} logits, got %d", F.size(lg)))
                          .otherwise(F.lit("non-finite logits"))))
    return (out.withColumn("threshold_used", F.when(~t_bad, t))
               .withColumn("success", F.col("_ok")).drop("_ok"))
