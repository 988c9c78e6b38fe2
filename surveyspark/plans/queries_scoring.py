"""Registered queries: scoring (F2-F4, F16, K3, J10) and decisions/reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.text import percent_text
from ..operators import decisions, scoring
from ..session import scratch_path
from ..sources.readers import latest_results
from ..sources.sinks import write_table
from .fixtures import oracle, view
from .registry import query

THRESHOLD = 0.5


def _classes(spark, sf):
    feats = view(spark, sf, "features").select(F.concat(F.lit("class_"), F.col("label")).alias("label"))
    return scoring.class_list(feats)


def scored(spark, sf):
    return scoring.score(view(spark, sf, "logits"), _classes(spark, sf), THRESHOLD)


_SCORE_CTES = """
cls as (select distinct 'class_' || cast(label as varchar) as name from embeddings),
cl as (select list(name order by name) as names from cls),
sm as (select row_id, label, logits,
              list_transform(logits, lambda x: exp(x - list_max(logits))) as e from logits),
pr as (select row_id, label, logits, list_transform(e, lambda x: x / list_sum(e)) as probs from sm),
pd as (select row_id, probs, cast(list_position(probs, list_max(probs)) - 1 as integer) as pred_idx,
              list_max(probs) as confidence from pr),
pc as (select pd.*, cl.names[pred_idx + 1] as predicted_class from pd, cl)
"""


@query("softmax", oracle(["logits"], """
select row_id, cast(i - 1 as integer) as idx, round(p, 9) as p
from (select row_id, unnest(probs) as p, generate_subscripts(probs, 1) as i from pr)
""", _SCORE_CTES))
def q_softmax(spark, sf):
    return (scored(spark, sf).where(F.col("probs").isNotNull())
            .select("row_id", F.posexplode("probs").alias("idx", "p"))
            .select("row_id", F.col("idx").cast("int").alias("idx"), F.round("p", 9).alias("p")))


@query("predict", oracle(["logits"], f"""
select row_id, pred_idx, predicted_class, round(confidence, 9) as confidence, confidence < {THRESHOLD}e0 as abstain
from pc where probs is not null
""", _SCORE_CTES))
def q_predict(spark, sf):
    return (scored(spark, sf).where(F.col("error").isNull())
            .select("row_id", "pred_idx", "predicted_class", F.round("confidence", 9).alias("confidence"),
                    "abstain"))


@query("top3_classes", oracle(["logits"], """
select row_id, cast(rk as integer) as rank, cl.names[i] as class, round(p, 9) as confidence
from (select row_id, p, i, row_number() over (partition by row_id order by p desc, i) - 1 as rk
      from (select row_id, unnest(probs) as p, generate_subscripts(probs, 1) as i from pr where probs is not null)),
     cl
where rk < 3
""", _SCORE_CTES))
def q_top3_classes(spark, sf):
    return (scored(spark, sf).where(F.col("top_3").isNotNull())
            .select("row_id", F.posexplode("top_3").alias("rank", "t"))
            .select("row_id", F.col("rank").cast("int").alias("rank"), F.col("t.class").alias("class"),
                    F.round("t.confidence", 9).alias("confidence")))


@query("score_with_errors", oracle(["logits"], f"""
select row_id, predicted_class, case when probs is null then true else confidence < {THRESHOLD}e0 end as abstain,
       case when probs is null then 'missing logits' end as error
from pc
""", _SCORE_CTES))
def q_score_with_errors(spark, sf):
    return scored(spark, sf).select("row_id", "predicted_class", "abstain", "error")


@query("class_index", oracle(["classes"], """
select class_name as label, cast(row_number() over (order by class_name) - 1 as integer) as class_idx
from classes
"""))
def q_class_index(spark, sf):
    return scoring.class_index(view(spark, sf, "classes"), "class_name")


# --- decisions ------------------------------------------------------------------------

def decided(spark, sf):
    return decisions.decide(view(spark, sf, "decisions_in"), view(spark, sf, "invasive_species"))


_DECIDE_CTES = """
sp as (select lower(invasive) as k, first(native) as native_comparison from invasive_species group by 1),
j as (select d.*, sp.k is not null as is_invasive, sp.native_comparison
      from decisions_in d left join sp on lower(d.predicted_class) = sp.k),
b as (select *, printf('%.1f%%', confidence * 100) as pct,
             case when abstain then 'abstain' when not is_invasive then 'native'
                  when confidence >= 0.9e0 then 'critical' when confidence >= 0.7e0 then 'high'
                  else 'possible' end as br from j),
dec as (
  select row_id, predicted_class as species, confidence, abstain, is_invasive, native_comparison, br,
         case br when 'abstain' then 'MEDIUM' when 'native' then 'NATIVE' when 'critical' then 'CRITICAL'
                 when 'high' then 'HIGH' else 'MEDIUM' end as risk_level,
         case br when 'abstain' then 'Monitoring' when 'native' then 'No action'
                 when 'critical' then 'Immediate removal' when 'high' then 'Containment measures'
                 else 'Monitoring' end as recommended_action,
         case br when 'abstain' then 'Low confidence detection (' || pct || '). Requires field verification.'
                 when 'native' then 'Native or non-target species detected (' || pct || ' confidence).'
                 when 'critical' then 'High-confidence invasive species detection (' || pct || ').'
                 when 'high' then 'Confirmed invasive species detection (' || pct || ').'
                 else 'Possible invasive species (' || pct || '). Requires verification.' end as reasoning,
         case br when 'abstain' then ['Manual photo review recommended', 'Collect multiple angle shots',
                                      'Document GPS location precisely', 'Re-photograph in different lighting']
                 when 'native' then ['Document sighting for biodiversity records']
                 when 'critical' then ['Schedule immediate removal assessment',
                                       'Check for ecological damage indicators',
                                       'Document population size and extent',
                                       'Notify local environmental authorities', 'Plan management strategy']
                 when 'high' then ['Initiate containment protocol', 'Schedule removal within 30 days',
                                   'Mark area for monitoring', 'Check for spread to adjacent areas',
                                   'Plan multi-year management if extensive']
                 else ['Schedule field verification', 'Collect reference samples',
                       'Document location and habitat'] end as follow_up_actions
  from b
)
"""
_DEC = ["decisions_in", "invasive_species"]


@query("species_lookup", oracle(_DEC, """
select row_id, predicted_class, is_invasive, native_comparison from j
""", _DECIDE_CTES))
def q_species_lookup(spark, sf):
    return (decisions.species_lookup(view(spark, sf, "decisions_in"), view(spark, sf, "invasive_species"))
            .select("row_id", "predicted_class", "is_invasive", "native_comparison"))


@query("decide", oracle(_DEC, """
select row_id, species, risk_level, recommended_action, reasoning from dec
""", _DECIDE_CTES))
def q_decide(spark, sf):
    return decided(spark, sf).select("row_id", "species", "risk_level", "recommended_action", "reasoning")


@query("decide_followups", oracle(_DEC, """
select row_id, cast(len(follow_up_actions) as integer) as follow_up_count,
       array_to_string(follow_up_actions, '|') as follow_ups from dec
""", _DECIDE_CTES))
def q_decide_followups(spark, sf):
    return decided(spark, sf).select("row_id", F.size("follow_up_actions").alias("follow_up_count"),
                                     F.array_join("follow_up_actions", "|").alias("follow_ups"))


@query("percent_text", oracle(["pred_pairs"], """
select row_id, printf('%.1f%%', conf_a * 100) as pct1, printf('%.2f%%', conf_a * 100) as pct2,
       printf('%.0f%%', conf_a * 100) as pct0
from pred_pairs
"""))
def q_percent_text(spark, sf):
    c = F.col("conf_a")
    return view(spark, sf, "pred_pairs").select("row_id", percent_text(c, 1).alias("pct1"),
                                                percent_text(c, 2).alias("pct2"), percent_text(c, 0).alias("pct0"))


@query("decision_text", oracle(_DEC, """
select row_id, risk_level || ' RISK: ' || species || ' (confidence: ' || printf('%.1f%%', confidence * 100) || ')'
       || chr(10) || 'Action: ' || recommended_action || chr(10) || 'Reasoning: ' || reasoning as text
from dec
""", _DECIDE_CTES))
def q_decision_text(spark, sf):
    return decided(spark, sf).select("row_id", decisions.decision_text().alias("text"))


@query("assess_batch", oracle(_DEC, """
select row_id, species, printf('%.2f%%', confidence * 100) as confidence, risk_level, recommended_action,
       reasoning, cast(len(follow_up_actions) as integer) as follow_up_count
from dec
""", _DECIDE_CTES))
def q_assess_batch(spark, sf):
    return decisions.export_projection(decided(spark, sf))


@query("risk_summary", oracle(_DEC, """
select l.risk_level, coalesce(c.n, 0) as n
from (select unnest(['CRITICAL', 'HIGH', 'MEDIUM', 'LOW', 'NATIVE']) as risk_level) l
left join (select risk_level, count(*) as n from dec group by 1) c using (risk_level)
""", _DECIDE_CTES))
def q_risk_summary(spark, sf):
    return decisions.risk_summary(decided(spark, sf), decisions.level_dim(spark))


@query("action_summary", oracle(_DEC, """
select recommended_action, count(*) as n from dec where risk_level in ('CRITICAL', 'HIGH') group by 1
""", _DECIDE_CTES))
def q_action_summary(spark, sf):
    return decisions.action_summary(decided(spark, sf), urgent_only=True)


@query("action_summary_all", oracle(_DEC, """
select recommended_action, count(*) as n from dec group by 1
""", _DECIDE_CTES))
def q_action_summary_all(spark, sf):
    return decisions.action_summary(decided(spark, sf), urgent_only=False)


@query("latest_results_actions", oracle(_DEC, """
select recommended_action, count(*) as n, min(reasoning) as first_reasoning from dec group by 1
""", _DECIDE_CTES))
def q_latest_results_actions(spark, sf):
    """Decisions exported twice, as an older and a newer result set of several parts: totals of the newest."""
    base = scratch_path(spark, f"results-{uuid.uuid4().hex}")
    rows = decided(spark, sf).select("species", "risk_level", "recommended_action", "reasoning")
    write_table(rows.where("risk_level = 'HIGH'"), f"{base}/first", fmt="csv")
    write_table(rows, f"{base}/second", fmt="csv")
    newest = latest_results(spark, f"{base}/*", "recommended_action string, reasoning string")
    return newest.groupBy("recommended_action").agg(F.count(F.lit(1)).alias("n"), F.min("reasoning").alias("first_reasoning"))


_RULE = "=" * 70
_LEVEL_RANK = {k: i for i, k in enumerate(sorted(["CRITICAL", "HIGH", "MEDIUM", "LOW", "NATIVE"]))}
_ACTION_RANK = {k: i for i, k in enumerate(sorted(["Immediate removal", "Herbicide treatment", "Mechanical removal",
                                                   "Containment measures", "Monitoring", "No action"]))}


def _case(col, ranks):
    return "case " + col + " " + " ".join(f"when '{k}' then {v}" for k, v in ranks.items()) + " end"


@query("report_lines", oracle(_DEC, f"""
select section, row_ord, cast(line_no as integer) as line_no, line from (
  select 0 as section, -1 as row_ord, 0 as line_no, '{_RULE}' as line
  union all select 0, -1, 1, 'INVASIVE SPECIES ASSESSMENT REPORT'
  union all select 0, -1, 2, '{_RULE}'
  union all select 1, -1, 0, chr(10) || 'SUMMARY:'
  union all select 4, -1, 0, chr(10) || '{_RULE}'
  union all select 4, -1, 1, 'RECOMMENDED ACTIONS:'
  union all select 4, -1, 2, '{_RULE}'
  union all select 4, 1099511627776, 0, chr(10) || '{_RULE}'
  union all select 1, {_case('risk_level', _LEVEL_RANK)}, 0, printf('  %s: %d', risk_level, count(*))
    from dec group by risk_level
  union all select distinct case risk_level when 'CRITICAL' then 2 else 3 end, -1, 0,
    case risk_level when 'CRITICAL' then chr(10) || 'CRITICAL FINDINGS (IMMEDIATE ACTION REQUIRED):'
                    else chr(10) || 'HIGH PRIORITY FINDINGS:' end
    from dec where risk_level in ('CRITICAL', 'HIGH')
  union all select case risk_level when 'CRITICAL' then 2 else 3 end, row_id, 0,
    chr(10) || '  ' || species || ' (' || printf('%.1f%%', confidence * 100) || ')'
    from dec where risk_level in ('CRITICAL', 'HIGH')
  union all select case risk_level when 'CRITICAL' then 2 else 3 end, row_id, 1, '  Action: ' || recommended_action
    from dec where risk_level in ('CRITICAL', 'HIGH')
  union all select 2, row_id, 2, '  Reasoning: ' || reasoning from dec where risk_level = 'CRITICAL'
  union all select 2, row_id, 3, '  Next steps:' from dec where risk_level = 'CRITICAL' and len(follow_up_actions) > 0
  union all select 2, row_id, 3 + i, '    • ' || follow_up_actions[i]
    from (select *, generate_subscripts(follow_up_actions, 1) as i from dec where risk_level = 'CRITICAL')
  union all select 4, {_case('recommended_action', _ACTION_RANK)}, 3,
    printf('  • %s: %d locations', recommended_action, count(*))
    from dec where risk_level in ('CRITICAL', 'HIGH') group by recommended_action
)
""", _DECIDE_CTES))
def q_report_lines(spark, sf):
    return decisions.report_lines(decided(spark, sf))


# --- end-to-end: classifier outputs -> predictions -> decisions -> report -----------------

def survey_decisions(spark, sf):
    """Score the logits, then decide with the class names of labels 0-2 as invasive species."""
    sc = scored(spark, sf).select("row_id", "predicted_class", "confidence", "abstain")
    inv = (view(spark, sf, "features").where(F.col("label") < 3)
           .select(F.concat(F.lit("CLASS_"), F.col("label")).alias("invasive"),
                   F.lit(None).cast("string").alias("native")).distinct())
    return decisions.decide(sc, inv, threshold=0.3, critical=0.6)


_SURVEY_CTES = _SCORE_CTES + """,
inv as (select distinct 'CLASS_' || cast(label as varchar) as invasive from embeddings where label < 3),
sdec as (
  select row_id, predicted_class as species,
         case when probs is null or confidence < 0.5e0 then 'MEDIUM'
              when lower(predicted_class) not in (select lower(invasive) from inv) then 'NATIVE'
              when confidence >= 0.6e0 then 'CRITICAL'
              when confidence >= 0.3e0 then 'HIGH' else 'MEDIUM' end as risk_level
  from pc
)
"""


@query("survey_risk_summary", oracle(["logits"], """
select risk_level, count(*) as n from sdec group by risk_level
""", _SURVEY_CTES))
def q_survey_risk_summary(spark, sf):
    return survey_decisions(spark, sf).groupBy("risk_level").agg(F.count(F.lit(1)).alias("n"))
