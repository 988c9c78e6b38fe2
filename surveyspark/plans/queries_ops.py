"""Registered queries: work log (W11, W12, J13), versioning (A21, A23, J11),
sampling and trials (K4, K2), model training (M1, rows-only)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluation as ev
from ..operators import sampling, tuning, versioning, worklog
from .fixtures import oracle, view
from .queries_eval import _EVAL_CTES, N_CLASSES, preds_long
from .queries_quality import _FIX, _MERGED_CTES, merged
from .registry import query


@query("latest_status", oracle(["status_log"], """
select url, arg_max(status, (ts, attempt_id)) as status, max(ts) as ts from status_log group by url
"""))
def q_latest_status(spark, sf):
    return worklog.latest_status(view(spark, sf, "status_log")).select("url", "status", "ts")


@query("latest_failed", oracle(["status_log"], """
select url, error from (
  select url, arg_max(status, (ts, attempt_id)) as status, arg_max(error, (ts, attempt_id)) as error
  from status_log group by url) where status = 'failed'
"""))
def q_latest_failed(spark, sf):
    return worklog.latest_failed(view(spark, sf, "status_log")).select("url", "error")


@query("retry_schedule", oracle(["status_log"], """
select url, n_failures, least(1e0 * pow(2e0, n_failures - 1), 60e0) as delay_s,
       round(epoch_us(last_ts) / 1e6 + least(1e0 * pow(2e0, n_failures - 1), 60e0), 6) as next_attempt_epoch
from fails where n_failures < 5
""", """
per_url as (
  select url, max({'ts': ts, 'a': attempt_id}) filter (where status = 'success') as last_ok,
         arg_max(status, (ts, attempt_id)) as last_status, max(ts) as last_ts
  from status_log group by url),
fails as (
  select l.url, p.last_ts, count(*) as n_failures from status_log l join per_url p using (url)
  where p.last_status = 'failed' and l.status = 'failed' and (p.last_ok is null or {'ts': l.ts, 'a': l.attempt_id} > p.last_ok)
  group by l.url, p.last_ts)
"""))
def q_retry_schedule(spark, sf):
    r = worklog.retry_schedule(view(spark, sf, "status_log"))
    return r.withColumn("next_attempt_epoch", F.round("next_attempt_epoch", 6))


@query("pending_items", oracle(["work_list", "status_log"], """
select url, expected_md5, bytes_on_disk from work_list w
where coalesce(bytes_on_disk, 0) <= 0 or (expected_md5 is not null and not exists (
  select 1 from status_log s where s.status = 'success' and s.md5 is not null and s.url = w.url and s.md5 = w.expected_md5))
"""))
def q_pending_items(spark, sf):
    return worklog.pending_items(view(spark, sf, "work_list"), view(spark, sf, "status_log"))


_PROFILE = """
select 'n_rows' as key, '' as item, cast(count(*) as varchar) as value from {t}
union all select 'n_classes', '', cast(count(distinct label) as varchar) from {t}
union all select 'n_sources', '', cast(count(distinct source) as varchar) from {t}
union all select 'n_groups', '', cast(count(distinct "group") as varchar) from {t}
union all select 'n_columns', '', '{ncols}'
union all select 'columns', '', '{cols}'
union all select 'class_distribution', cast(label as varchar), cast(count(*) as varchar) from {t}
  where label is not null group by label
union all select 'source_distribution', cast(source as varchar), cast(count(*) as varchar) from {t}
  where source is not null group by source
"""
_PROF_COLS = ["occ_id", "filepath", "label", "region", "source", "group", "status"]


def _profiled(df):
    return df.select(*_PROF_COLS)


@query("table_profile", oracle(_FIX, _PROFILE.format(t="grouped", ncols=len(_PROF_COLS), cols=",".join(_PROF_COLS)),
                               _MERGED_CTES))
def q_table_profile(spark, sf):
    return versioning.table_profile(_profiled(merged(spark, sf)))


@query("detect_drift", oracle(_FIX, f"""
select coalesce(o.key, n.key) as key, coalesce(o.item, n.item) as item, o.value as old, n.value as new
from old_p o full outer join new_p n on o.key = n.key and o.item = n.item
where o.value is distinct from n.value
""", _MERGED_CTES + ",\nold_p as (" + _PROFILE.format(
    t="(select occ_id, filepath, label, region, source, null::varchar as \"group\", status from occ)",
    ncols=len(_PROF_COLS), cols=",".join(_PROF_COLS)) + "),\nnew_p as (" + _PROFILE.format(
    t="grouped", ncols=len(_PROF_COLS), cols=",".join(_PROF_COLS)) + ")"))
def q_detect_drift(spark, sf):
    old = view(spark, sf, "occ").withColumn("group", F.lit(None).cast("string"))
    d = versioning.detect_drift(versioning.table_profile(_profiled(old)),
                                versioning.table_profile(_profiled(merged(spark, sf))))
    return d.select("key", "item", "old", "new")


_HASH_COLS = ["occ_id", "filepath", "label", "source", "group"]


_CODE = " || ".join(f"""case when {c} is null then '-' else length(cast({c} as varchar)) || ':' || cast({c} as varchar) end"""
                    for c in (f'"{n}"' for n in _HASH_COLS))
_SUMS = ", ".join(f"cast(coalesce(sum(('0x' || substr(h, {at}, {versioning.LANE}))::bigint), 0) as varchar) as s{i}" for i, at in enumerate(versioning.LANES))
_HEADER = "".join(f"{len(n)}:{n}{'bigint' if n == 'occ_id' else 'string'};" for n in _HASH_COLS)


@query("content_hash", oracle(_FIX, f"""
select n_rows, sha256(concat_ws('|', n_rows, {", ".join(f"s{i}" for i in range(len(versioning.LANES)))}, '{_HEADER}')) as hash_sum
from (select count(*) as n_rows, {_SUMS} from (select sha256({_CODE}) as h from grouped))
""", _MERGED_CTES))
def q_content_hash(spark, sf):
    return versioning.content_hash(merged(spark, sf).select(*_HASH_COLS))


@query("seeded_sample", oracle(["occ"], """
select occ_id, label from occ order by md5('42:' || cast(occ_id as varchar)), occ_id limit 100
"""))
def q_seeded_sample(spark, sf):
    return sampling.seeded_sample(view(spark, sf, "occ"), 100, seed=42, id_col="occ_id").select("occ_id", "label")


@query("top_trials", oracle(["pred_pairs"], """
select model, fold, round(macro_f1, 9) as macro_f1, round(accuracy, 9) as accuracy from fold_m
order by macro_f1 desc, model, fold limit 5
""", _EVAL_CTES))
def q_top_trials(spark, sf):
    fm = ev.overall_metrics(preds_long(spark, sf), N_CLASSES, keys=("model", "fold"))
    trials = fm.select("model", "fold", F.round("macro_f1", 9).alias("macro_f1"), F.round("accuracy", 9).alias("accuracy"))
    return tuning.top_trials(trials, 5, order=[F.col("macro_f1").desc(), F.col("model"), F.col("fold")])


_ML_FOLD_CTES = """
f as (select row_id, label, cast(row_id % 25 as varchar) as "group" from features),
hist as (select "group", label, count(*) as n from f group by 1, 2),
gs as (select "group", sum(n)::bigint as size, first(label order by n desc, label) as dom from hist group by 1),
dr as (select dom, dense_rank() over (order by dom) - 1 as r from (select distinct dom from gs)),
gp as (select gs."group", row_number() over (partition by gs.dom order by size desc, "group") - 1 + dr.r as pos from gs join dr using (dom)),
gf as (select "group", cast(case when pos % 6 < 3 then pos % 6 else 5 - pos % 6 end as integer) as fold from gp)
"""


@query("train_fold_rows", oracle(["features"], 'select row_id, fold, label from f join gf using ("group")', _ML_FOLD_CTES))
def q_train_fold_rows(spark, sf):
    """The rows that out-of-fold training predicts, with their folds and true labels."""
    return q_train_folds(spark, sf).select("row_id", "fold", "label")


@query("train_fold_metrics")
def q_train_fold_metrics(spark, sf):
    """Accuracy and macro-F1 of each fold's model (rows-only; a numpy fit is held against it in the tests)."""
    return tuning.fold_metrics(q_train_folds(spark, sf), 10)


@query("train_folds")
def q_train_folds(spark, sf):
    feats = view(spark, sf, "features").withColumn("group", (F.col("row_id") % 25).cast("string"))
    return tuning.train_folds(feats, n_folds=3, max_iter=20)


_ERF = """(2e0 / sqrt(pi()) * exp(-z * z) * list_sum(list_transform(range(0, 200), lambda n:
  exp(n * ln(2e0 * z * z) + ln(z) - (lgamma(2 * n + 3) - (n + 1) * ln(2e0) - lgamma(n + 2))))))"""


@query("mcnemar_chi2", oracle(["pred_pairs"], f"""
select n_discordant, round(statistic, 9) as statistic, round(case when z = 0 then 1e0 else 1 - {_ERF} end, 9) as p_value,
       case when (case when z = 0 then 1e0 else 1 - {_ERF} end) < 0.05e0 then 'Models differ significantly (p < 0.05).'
            else 'No statistically significant difference detected (p >= 0.05).' end as interpretation
from (select n as n_discordant, pow(abs(b - c) - 1, 2) / n as statistic, sqrt(pow(abs(b - c) - 1, 2) / n / 2) as z
      from (select b, c, b + c as n from mc))
""", """
mc as (select count(*) filter (where pred_a = label and pred_b <> label) as b,
              count(*) filter (where pred_a <> label and pred_b = label) as c from pred_pairs)
"""))
def q_mcnemar_chi2(spark, sf):
    """Chi-square McNemar with continuity correction (the oracle sums the series of erf)."""
    from .queries_eval import _pairs
    t = ev.mcnemar_test(ev.mcnemar_table(_pairs(spark, sf)), exact=False)
    return t.select("n_discordant", F.round("statistic", 9).alias("statistic"), F.round("p_value", 9).alias("p_value"), "interpretation")


@query("grid_search")
def q_grid_search(spark, sf):
    """Grouped-CV grid search scored by macro-F1 (rows-only)."""
    feats = view(spark, sf, "features").withColumn("group", (F.col("row_id") % 25).cast("string"))
    return tuning.grid_search(feats, n_classes=10, reg_params=(0.0, 0.1), max_iter=(10,), n_folds=3).withColumn(
        "folds", F.to_json("folds"))
