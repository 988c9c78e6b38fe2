"""Registered queries: evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluation as ev
from .fixtures import oracle, view
from .registry import query

N_CLASSES = 5


def preds_long(spark, sf):
    p = view(spark, sf, "pred_pairs")
    a = p.select(F.lit("a").alias("model"), "row_id", "fold", "label", F.col("pred_a").alias("pred"),
                 F.col("conf_a").alias("confidence"))
    b = p.select(F.lit("b").alias("model"), "row_id", "fold", "label", F.col("pred_b").alias("pred"),
                 F.col("conf_b").alias("confidence"))
    return a.unionByName(b)


def _side(spark, sf, model, drop_nan=False):
    p = preds_long(spark, sf).where(F.col("model") == model)
    return p.where(~F.isnan("confidence")) if drop_nan else p


def _r(c):
    return F.round(c, 9).alias(c)


_EVAL_CTES = f"""
pl as (select 'a' as model, row_id, fold, label, pred_a as pred, conf_a as confidence from pred_pairs
       union all select 'b', row_id, fold, label, pred_b, conf_b from pred_pairs),
cnt as (select model, c.range::integer as class_idx,
               count(*) filter (where label = c.range and pred = c.range) as tp,
               count(*) filter (where label <> c.range and pred = c.range) as fp,
               count(*) filter (where label = c.range and pred <> c.range) as fn
        from pl, range(0, {N_CLASSES}) c group by 1, 2),
pcm as (select *, case when tp + fp = 0 then 0e0 else tp / (tp + fp) end as precision,
               case when tp + fn = 0 then 0e0 else tp / (tp + fn) end as recall from cnt),
pcf as (select *, case when precision + recall = 0 then 0e0
                       else 2 * precision * recall / (precision + recall) end as f1 from pcm),
fcnt as (select model, fold, c.range::integer as class_idx,
                count(*) filter (where label = c.range and pred = c.range) as tp,
                count(*) filter (where label <> c.range and pred = c.range) as fp,
                count(*) filter (where label = c.range and pred <> c.range) as fn
         from pl, range(0, {N_CLASSES}) c group by 1, 2, 3),
fpcm as (select *, case when tp + fp = 0 then 0e0 else tp / (tp + fp) end as precision,
                case when tp + fn = 0 then 0e0 else tp / (tp + fn) end as recall from fcnt),
fpcf as (select *, case when precision + recall = 0 then 0e0
                        else 2 * precision * recall / (precision + recall) end as f1 from fpcm),
fold_m as (select a.model, a.fold, a.accuracy, coalesce(m.macro_f1, 0e0) as macro_f1 from
             (select model, fold, avg(case when label = pred then 1e0 else 0e0 end) as accuracy
              from pl group by 1, 2) a
             left join (select model, fold, avg(f1) as macro_f1 from fpcf where tp + fp + fn > 0 group by 1, 2) m
             using (model, fold)),
sa as (select row_id, label, pred, confidence from pl where model = 'a'),
sb as (select row_id, label, pred, confidence from pl where model = 'b' and not isnan(confidence)),
paired as (select coalesce(sa.row_id, sb.row_id) as row_id,
                  case when sa.row_id is null then 'only_b' when sb.row_id is null then 'only_a' else 'both' end
                    as status, sa.pred as pred_a, sb.pred as pred_b
           from sa full outer join sb on sa.row_id = sb.row_id),
mt as (select count(*) filter (where pred_a = label and pred_b = label) as both_correct,
              count(*) filter (where pred_a = label and pred_b <> label) as only_a_correct,
              count(*) filter (where pred_a <> label and pred_b = label) as only_b_correct,
              count(*) filter (where pred_a <> label and pred_b <> label) as both_wrong
       from pred_pairs),
mx as (select *, only_a_correct + only_b_correct as n_discordant,
              cast(least(only_a_correct, only_b_correct) as double) as statistic,
              least(1e0, 2e0 * list_sum(list_transform(range(0, least(only_a_correct, only_b_correct) + 1),
                 lambda i: exp(lgamma(only_a_correct + only_b_correct + 1) - lgamma(i + 1)
                               - lgamma(only_a_correct + only_b_correct - i + 1)
                               - (only_a_correct + only_b_correct) * ln(2e0))))) as p_value
       from mt),
cc as (select avg(case when isnan(conf_a) then null else conf_a end) as mean_conf_a,
              stddev_pop(case when isnan(conf_a) then null else conf_a end) as std_conf_a,
              avg(case when isnan(conf_b) then null else conf_b end) as mean_conf_b,
              stddev_pop(case when isnan(conf_b) then null else conf_b end) as std_conf_b,
              count(*) filter (where conf_b - conf_a > 0.1e0 and not isnan(conf_b)) as n_b_more_confident,
              count(*) filter (where conf_b - conf_a < -0.1e0 and not isnan(conf_b)) as n_a_more_confident
       from pred_pairs)
"""
_PP = ["pred_pairs"]


@query("per_class_metrics", oracle(_PP, """
select model, class_idx, round(precision, 9) as precision, round(recall, 9) as recall, round(f1, 9) as f1,
       tp + fn as support from pcf
""", _EVAL_CTES))
def q_per_class_metrics(spark, sf):
    m = ev.per_class_metrics(preds_long(spark, sf), N_CLASSES)
    return m.select("model", "class_idx", _r("precision"), _r("recall"), _r("f1"), "support")


@query("overall_metrics", oracle(_PP, """
select a.model, round(a.accuracy, 9) as accuracy, round(m.macro_f1, 9) as macro_f1, a.n from
  (select model, avg(case when label = pred then 1e0 else 0e0 end) as accuracy, count(*) as n from pl group by 1) a
  join (select model, avg(f1) as macro_f1 from pcf where tp + fp + fn > 0 group by 1) m using (model)
""", _EVAL_CTES))
def q_overall_metrics(spark, sf):
    m = ev.overall_metrics(preds_long(spark, sf), N_CLASSES)
    return m.select("model", _r("accuracy"), _r("macro_f1"), "n")


@query("fold_average", oracle(_PP, """
select model, round(avg(accuracy), 9) as accuracy_mean, round(stddev_pop(accuracy), 9) as accuracy_std,
       round(avg(macro_f1), 9) as macro_f1_mean, round(stddev_pop(macro_f1), 9) as macro_f1_std,
       count(*) as n_folds
from fold_m group by model
""", _EVAL_CTES))
def q_fold_average(spark, sf):
    fm = ev.overall_metrics(preds_long(spark, sf), N_CLASSES, keys=("model", "fold"))
    fa = ev.fold_average(fm)
    return fa.select("model", *[_r(c) for c in ["accuracy_mean", "accuracy_std", "macro_f1_mean", "macro_f1_std"]],
                     "n_folds")


@query("paired_predictions", oracle(_PP, "select row_id, status, pred_a, pred_b from paired", _EVAL_CTES))
def q_paired_predictions(spark, sf):
    p = ev.paired_predictions(_side(spark, sf, "a"), _side(spark, sf, "b", drop_nan=True))
    return p.select("row_id", "status", "pred_a", "pred_b")


@query("row_set_diff", oracle(_PP, """
select row_id, 'only_a' as side from (select row_id from sa except all select row_id from sb)
union all select row_id, 'only_b' from (select row_id from sb except all select row_id from sa)
""", _EVAL_CTES))
def q_row_set_diff(spark, sf):
    return ev.row_set_diff(_side(spark, sf, "a"), _side(spark, sf, "b", drop_nan=True))


def _pairs(spark, sf):
    p = view(spark, sf, "pred_pairs")
    return p.select(F.lit("model_a").alias("model_a"), F.lit("model_b").alias("model_b"), "row_id", "label",
                    "pred_a", "pred_b", "conf_a", "conf_b")


@query("mcnemar_table", oracle(_PP, """
select both_correct, only_a_correct, only_b_correct, both_wrong, n_discordant from mx
""", _EVAL_CTES))
def q_mcnemar_table(spark, sf):
    return ev.mcnemar_table(_pairs(spark, sf)).select("both_correct", "only_a_correct", "only_b_correct",
                                                      "both_wrong", "n_discordant")


@query("mcnemar_exact", oracle(_PP, """
select n_discordant, statistic, round(p_value, 9) as p_value,
       case when p_value < 0.05e0 then 'Models differ significantly (p < 0.05).'
            else 'No statistically significant difference detected (p >= 0.05).' end as interpretation
from mx
""", _EVAL_CTES))
def q_mcnemar_exact(spark, sf):
    t = ev.mcnemar_test(ev.mcnemar_table(_pairs(spark, sf)), exact=True)
    return t.select("n_discordant", "statistic", _r("p_value"), "interpretation")


@query("calibration", oracle(_PP, """
select model, round(avg(confidence) filter (where pred = label and not isnan(confidence)), 9)
         as mean_confidence_correct,
       round(avg(confidence) filter (where pred <> label and not isnan(confidence)), 9) as mean_confidence_incorrect,
       count(*) filter (where pred = label) as n_correct, count(*) filter (where pred <> label) as n_incorrect,
       round((count(*) filter (where pred = label)) / count(*), 9) as accuracy,
       round(coalesce(quantile_cont(confidence, 0.25e0) filter (where pred = label and not isnan(confidence)),
                      0.5e0), 9) as recommended_threshold
from pl where fold = 0 group by model
""", _EVAL_CTES))
def q_calibration(spark, sf):
    c = ev.calibration(preds_long(spark, sf).where(F.col("fold") == 0))
    return c.select("model", _r("mean_confidence_correct"), _r("mean_confidence_incorrect"), "n_correct",
                    "n_incorrect", _r("accuracy"), _r("recommended_threshold"))


@query("confidence_compare", oracle(_PP, """
select round(mean_conf_a, 9) as mean_conf_a, round(std_conf_a, 9) as std_conf_a,
       round(mean_conf_b, 9) as mean_conf_b, round(std_conf_b, 9) as std_conf_b,
       n_b_more_confident, n_a_more_confident from cc
""", _EVAL_CTES))
def q_confidence_compare(spark, sf):
    c = ev.confidence_compare(_pairs(spark, sf))
    return c.select(*[_r(x) for x in ["mean_conf_a", "std_conf_a", "mean_conf_b", "std_conf_b"]],
                    "n_b_more_confident", "n_a_more_confident")


@query("compare_models", oracle(_PP, """
select 'model_a' as model_a, 'model_b' as model_b, both_correct, only_a_correct, only_b_correct, both_wrong,
       round(p_value, 9) as p_value, round(mean_conf_a, 9) as mean_conf_a, round(mean_conf_b, 9) as mean_conf_b,
       n_b_more_confident, n_a_more_confident
from mx, cc
""", _EVAL_CTES))
def q_compare_models(spark, sf):
    c = ev.compare_models(_pairs(spark, sf))
    return c.select("model_a", "model_b", "both_correct", "only_a_correct", "only_b_correct", "both_wrong",
                    _r("p_value"), _r("mean_conf_a"), _r("mean_conf_b"), "n_b_more_confident",
                    "n_a_more_confident")
