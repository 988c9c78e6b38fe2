"""Hand-computed goldens: audit, evaluation, McNemar, calibration, decisions, reports."""
import os

import pytest
from pyspark.sql import functions as F

from surveyspark.functions.stats import mcnemar_chi2, mcnemar_exact_p
from surveyspark.operators import decisions, evaluation as ev, quality, scoring


def test_audit_golden(spark, tmpdir_path):
    present = os.path.join(tmpdir_path, "a.jpg")
    open(present, "wb").write(b"x")
    rows = [(present, "A", "Lisboa", "s", 38.7, -9.1, "g1"),
            (os.path.join(tmpdir_path, "missing.jpg"), "B", "Porto", "s", None, None, "g2")]
    df = spark.createDataFrame(rows, "filepath string, label string, region string, source string, "
                                     "latitude double, longitude double, group string")
    listing = spark.createDataFrame([(present,)], "path string")
    r = quality.audit_manifest(df, listing).first()
    assert r.n_rows == 2 and r.missing_files == 1 and r.rows_without_coordinates == 1
    assert r.class_counts == {"A": 1, "B": 1}
    assert len(r.issues) > 0 and r.issues[0] == "1 manifest paths do not exist on disk."


def test_audit_short_form(spark):
    df = spark.createDataFrame([("x",)], "filepath string")
    r = quality.audit_manifest(df).first()
    assert r.missing_required_columns == ["label", "region", "source"]


def _preds(spark, truth, pred, model="m"):
    return spark.createDataFrame([(model, i, t, p) for i, (t, p) in enumerate(zip(truth, pred))],
                                 "model string, row_id long, label int, pred int")


def test_perfect_and_known_confusion(spark):
    o = ev.overall_metrics(_preds(spark, [0, 1, 2, 0], [0, 1, 2, 0]), 3).first()
    assert o.accuracy == 1.0 and o.macro_f1 == 1.0
    pc = {r.class_idx: r for r in ev.per_class_metrics(_preds(spark, [0] * 4 + [1] * 4,
                                                              [0, 0, 0, 0, 1, 1, 0, 0]), 2).collect()}
    assert pc[1].recall == 0.5 and pc[1].precision == 1.0
    assert abs(pc[0].precision - 4 / 6) < 1e-12


def test_mcnemar_goldens(spark):
    assert mcnemar_exact_p(6, 7) > 0.9
    assert mcnemar_exact_p(0, 40) < 0.001
    assert mcnemar_exact_p(0, 0) == 1.0
    stat, p = mcnemar_chi2(6, 7)
    assert stat == 0.0 and p == 1.0
    # large counts go through the continued fraction and agree with the direct sum
    import math

    import numpy as np

    from surveyspark.functions.stats import binom_cdf_half
    k, n = 250_300, 500_000
    i = np.arange(k + 1, dtype=np.float64)
    lg = np.vectorize(math.lgamma)
    logs = math.lgamma(n + 1) - lg(i + 1) - lg(n - i + 1) - n * math.log(2.0)
    direct = float(np.exp(logs - logs.max()).sum() * math.exp(logs.max()))
    assert abs(binom_cdf_half(k, n) - direct) < 1e-9
    t = spark.createDataFrame([(59, 6, 7, 8)], "both_correct long, only_a_correct long, only_b_correct long, "
                                               "both_wrong long")
    r = ev.mcnemar_test(t).first()
    assert r.p_value > 0.9 and r.statistic == 6.0 and "No statistically" in r.interpretation


def test_fold_average_unweighted(spark):
    fm = spark.createDataFrame([("m", 0, 0.8, 0.7), ("m", 1, 0.82, 0.72), ("m", 2, 0.78, 0.68)],
                               "model string, fold int, accuracy double, macro_f1 double")
    r = ev.fold_average(fm).first()
    assert abs(r.accuracy_mean - 0.8) < 1e-12 and r.n_folds == 3


def test_calibration_golden(spark):
    rows = [("m", 0, 0, 0.9), ("m", 1, 1, 0.85), ("m", 2, 2, 0.88), ("m", 0, 0, 0.92), ("m", 2, 1, 0.6)]
    df = spark.createDataFrame(rows, "model string, label int, pred int, confidence double")
    r = ev.calibration(df).first()
    assert r.accuracy == 0.8 and abs(r.recommended_threshold - 0.8725) < 1e-12
    assert r.n_correct == 4 and r.n_incorrect == 1


@pytest.mark.parametrize("conf,abstain,species,level", [
    (0.55, True, "Arundo donax", "MEDIUM"), (0.699, True, "Arundo donax", "MEDIUM"),
    (0.70, False, "Arundo donax", "HIGH"), (0.899, False, "arundo DONAX", "HIGH"),
    (0.90, False, "Arundo donax", "CRITICAL"), (0.95, False, "Cortaderia selloana", "CRITICAL"),
    (0.95, False, "Phragmites australis", "NATIVE"), (0.92, False, "Unknown plant", "NATIVE"),
    (0.95, False, "Acacia longifolia", "NATIVE"), (0.60, False, "Acacia dealbata", "MEDIUM"),
])
def test_decision_branches(spark, conf, abstain, species, level):
    df = spark.createDataFrame([(1, species, conf, abstain)],
                               "row_id long, predicted_class string, confidence double, abstain boolean")
    r = decisions.decide(df, decisions.species_dim(spark)).first()
    assert r.risk_level == level
    n = {"MEDIUM": 4 if abstain else 3, "HIGH": 5, "CRITICAL": 5, "NATIVE": 1}[level]
    assert len(r.follow_up_actions) == n


def test_percent_in_reasoning_and_report(spark):
    df = spark.createDataFrame([(1, "Arundo donax", 0.873, False), (2, "Arundo donax", 0.95, False),
                                (3, "Phragmites australis", 0.9, False)],
                               "row_id long, predicted_class string, confidence double, abstain boolean")
    d = decisions.decide(df, decisions.species_dim(spark))
    assert "87.3%" in d.where("row_id = 1").first().reasoning
    text = decisions.report_text(decisions.report_lines(d))
    assert "CRITICAL FINDINGS (IMMEDIATE ACTION REQUIRED):" in text and "HIGH PRIORITY FINDINGS:" in text
    assert "  • Immediate removal: 1 locations" in text and "  NATIVE: 1" in text
    empty = decisions.report_text(decisions.report_lines(d.limit(0)))
    assert "SUMMARY:" in empty and "CRITICAL FINDINGS" not in empty and "RECOMMENDED ACTIONS:" in empty


def test_scoring_shapes_and_errors(spark):
    df = spark.createDataFrame([(1, [1.0, 3.0, 2.0], None), (2, None, None), (3, [1.0, 1.0, 1.0], "0.2"),
                                (4, [0.0, 0.0, 9.0], "abc"), (5, [0.0, 0.0, 9.0], "1.5")],
                               "row_id long, logits array<double>, threshold_override string")
    out = {r.row_id: r for r in scoring.score(df, ["a", "b", "c"], 0.5, threshold_col="threshold_override").collect()}
    assert out[1].predicted_class == "b" and [t["class"] for t in out[1].top_3] == ["b", "c", "a"]
    assert abs(sum(out[1].probs) - 1.0) < 1e-12
    assert out[2].predicted_class is None and out[2].abstain and out[2].error == "missing logits"
    assert out[3].predicted_class == "a" and out[3].abstain is False  # tie -> first, override 0.2
    assert out[4].abstain and out[4].error.startswith("invalid threshold") and not out[4].success
    assert out[5].abstain and out[5].error is None and out[5].threshold_used == 1.5


def test_mcnemar_chi2_in_spark(spark):
    t = spark.createDataFrame([(1, 59, 6, 7, 8), (2, 10, 0, 40, 50), (3, 5, 0, 0, 5)],
                              "k int, both_correct long, only_a_correct long, only_b_correct long, both_wrong long")
    r = {x.k: x for x in ev.mcnemar_test(t, exact=False).collect()}
    assert r[1].statistic == 0.0 and r[1].p_value == 1.0
    assert abs(r[2].statistic - 38.025) < 1e-12 and r[2].p_value < 0.001
    assert "differ significantly" in r[2].interpretation
    assert r[3].statistic != r[3].statistic  # no discordant pairs: undefined


def test_resolve_and_normalize_paths(spark):
    from surveyspark.functions.text import normalize_path, resolve_path
    df = spark.createDataFrame([("C:\\proj\\data_raw\\a.jpg",), ("data_raw/b.jpg",), ("/abs/c.jpg",)], "p string")
    got = [tuple(r) for r in df.select(normalize_path(F.col("p"), "C:\\proj").alias("n"),
                                       resolve_path(F.col("p"), "/root/proj").alias("r")).collect()]
    assert got == [("data_raw/a.jpg", "C:/proj/data_raw/a.jpg"), ("data_raw/b.jpg", "/root/proj/data_raw/b.jpg"),
                   ("/abs/c.jpg", "/abs/c.jpg")]
