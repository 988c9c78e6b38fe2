"""Risk decisions from predictions, and the reports built from them.

A decision is one ordered ``when`` chain per row (narrow). Invasive-species
membership is a left join on the lower-cased name against the species
dimension; adaptive execution broadcasts a dimension of few bytes and splits
hot names beyond that. Reports are produced as ordered line rows
``(section, row_ord, line_no, line)`` so a report over millions of decisions
is still built by the executors; only the text sink sorts and concatenates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions.text import percent_text


def species_dim(spark: SparkSession, pairs=None) -> DataFrame:
    """``(invasive, native)`` pairs; default the fixed three."""
    pairs = pairs if pairs is not None else [(a, b) for a, b, _ in config.SPECIES_PAIRS]
    return spark.createDataFrame(pairs, "invasive string, native string")


def species_lookup(df: DataFrame, species: DataFrame, name_col: str = "predicted_class") -> DataFrame:
    """Attach ``is_invasive, native_comparison, priority, impacts`` by case-insensitive name.

    ``priority`` and ``impacts`` come from the species table where it has them
    (``normal`` and empty where it does not). Of a repeated name the last row
    counts: by ``row_ord`` where the table has it, else by its values.
    """
    def of(c, default):
        return F.coalesce(F.col(c), F.lit(default)) if c in species.columns else F.lit(default)

    row = F.struct(F.col("native").alias("native_comparison"), of("priority", "normal").alias("priority"),
                   of("impacts", "").alias("impacts"))
    last = F.col("row_ord") if "row_ord" in species.columns else row
    dim = (species.where(F.col("invasive").isNotNull()).groupBy(F.lower(F.col("invasive")).alias("_key"))
                  .agg(F.max_by(row, last).alias("_dim")))
    j = df.join(dim, F.lower(F.col(name_col)) == F.col("_key"), "left")
    return (j.withColumn("is_invasive", F.col("_key").isNotNull())
             .select("*", "_dim.*").drop("_key", "_dim"))


def _arr(items) -> Column:
    return F.array(*[F.lit(s) for s in items])


def _reason(template: str, pct: Column) -> Column:
    head, tail = template.split("{pct}")
    return F.concat(F.lit(head), pct, F.lit(tail))


def decide(df: DataFrame, species: DataFrame, threshold: float = config.DECISION_THRESHOLD,
           critical: float = config.CRITICAL_THRESHOLD, name_col: str = "predicted_class",
           conf_col: str = "confidence", abstain_col: str = "abstain") -> DataFrame:
    """Add ``species, risk_level, recommended_action, reasoning, follow_up_actions``."""
    j = species_lookup(df, species, name_col)
    c = F.col(conf_col)
    pct = percent_text(c, 1)
    ab, inv = F.col(abstain_col), F.col("is_invasive")
    branch = (F.when(ab, F.lit("abstain"))
               .when(~inv, F.lit("native"))
               .when(c >= critical, F.lit("critical"))
               .when(c >= threshold, F.lit("high"))
               .otherwise(F.lit("possible")))
    pick = lambda **v: (F.when(F.col("_b") == "abstain", v["abstain"])
                         .when(F.col("_b") == "native", v["native"])
                         .when(F.col("_b") == "critical", v["critical"])
                         .when(F.col("_b") == "high", v["high"])
                         .otherwise(v["possible"]))
    return (j.withColumn("_b", branch)
             .withColumn("species", F.col(name_col))
             .withColumn("risk_level", pick(abstain=F.lit("MEDIUM"), native=F.lit("NATIVE"),
                                            critical=F.lit("CRITICAL"), high=F.lit("HIGH"),
                                            possible=F.lit("MEDIUM")))
             .withColumn("recommended_action", pick(
                 abstain=F.lit("Monitoring"), native=F.lit("No action"), critical=F.lit("Immediate removal"),
                 high=F.lit("Containment measures"), possible=F.lit("Monitoring")))
             .withColumn("reasoning", pick(
                 abstain=_reason(config.REASON_ABSTAIN, pct), native=_reason(config.REASON_NATIVE, pct),
                 critical=_reason(config.REASON_CRITICAL, pct), high=_reason(config.REASON_HIGH, pct),
                 possible=_reason(config.REASON_POSSIBLE, pct)))
             .withColumn("follow_up_actions", pick(
                 abstain=_arr(config.FOLLOW_UPS_ABSTAIN), native=_arr(config.FOLLOW_UPS_NATIVE),
                 critical=_arr(config.FOLLOW_UPS_CRITICAL), high=_arr(config.FOLLOW_UPS_HIGH),
                 possible=_arr(config.FOLLOW_UPS_POSSIBLE)))
             .drop("_b"))


def decision_text(conf_col: str = "confidence") -> Column:
    """Three-line display string."""
    return F.concat_ws("\n",
                       F.concat(F.col("risk_level"), F.lit(" RISK: "), F.col("species"),
                                F.lit(" (confidence: "), percent_text(F.col(conf_col), 1), F.lit(")")),
                       F.concat(F.lit("Action: "), F.col("recommended_action")),
                       F.concat(F.lit("Reasoning: "), F.col("reasoning")))


def export_projection(decisions: DataFrame, conf_col: str = "confidence") -> DataFrame:
    """Batch export columns (two-decimal percent text, follow-up count)."""
    return decisions.select(
        *[c for c in ["row_id"] if c in decisions.columns],
        "species", percent_text(F.col(conf_col), 2).alias("confidence"), "risk_level",
        "recommended_action", "reasoning", F.size("follow_up_actions").alias("follow_up_count"))


def level_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(lv,) for lv in config.RISK_LEVELS], "risk_level string")


def risk_summary(decisions: DataFrame, levels: DataFrame) -> DataFrame:
    """Decisions per risk level, every declared level present (zero when unused)."""
    counts = decisions.groupBy("risk_level").agg(F.count(F.lit(1)).alias("n"))
    return (F.broadcast(levels).join(counts, "risk_level", "left")
            .select("risk_level", F.coalesce("n", F.lit(0)).alias("n")))


def action_summary(decisions: DataFrame, urgent_only: bool = True) -> DataFrame:
    """Locations per recommended action; CRITICAL and HIGH only unless ``urgent_only=False``."""
    src = decisions.where(F.col("risk_level").isin("CRITICAL", "HIGH")) if urgent_only else decisions
    return src.groupBy("recommended_action").agg(F.count(F.lit(1)).alias("n"))


def _rank_of(col: Column, names) -> Column:
    """Position of ``col`` in the sorted fixed list ``names``."""
    m = F.create_map(*[x for i, nm in enumerate(sorted(names)) for x in (F.lit(nm), F.lit(i))])
    return F.element_at(m, col).cast("bigint")


def report_lines(decisions: DataFrame, row_ord: str = "row_id", conf_col: str = "confidence") -> DataFrame:
    """Report as rows ``(section, row_ord, line_no, line)``; sort them and join with newlines.

    Sections: 0 header, 1 summary, 2 critical findings, 3 high findings,
    4 recommended actions. Empty sections are omitted; an empty input still
    gives a valid report (header, empty summary, actions block).

    The decisions are read twice, whatever their size: one narrow pass emits
    every per-decision line (``inline`` of a per-row array), and one
    aggregation to at most (#levels x #actions) rows feeds every summary line.
    """
    R = config.REPORT_RULE
    d = decisions.select(F.col(row_ord).cast("bigint").alias("ord"), "species",
                         F.col(conf_col).alias("conf"), "risk_level", "recommended_action",
                         "reasoning", "follow_up_actions")
    spark = decisions.sparkSession
    out_cols = ["section", "row_ord", "line_no", "line"]

    def line(section, ordc, no, text):
        return F.struct(F.lit(section).cast("int").alias("section"), ordc.cast("bigint").alias("row_ord"),
                        F.lit(no).cast("int").alias("line_no"), text.alias("line"))

    head = spark.createDataFrame(
        [(0, -1, 0, R), (0, -1, 1, config.REPORT_TITLE), (0, -1, 2, R), (1, -1, 0, "\nSUMMARY:"),
         (4, -1, 0, "\n" + R), (4, -1, 1, config.REPORT_ACTIONS_HEADER), (4, -1, 2, R),
         (4, 1 << 40, 0, "\n" + R)],
        "section int, row_ord bigint, line_no int, line string")

    # pass 1: per-decision lines
    o = F.col("ord")
    title = F.concat(F.lit("\n  "), F.col("species"), F.lit(" ("), percent_text(F.col("conf"), 1), F.lit(")"))
    action = F.concat(F.lit("  Action: "), F.col("recommended_action"))
    steps = F.transform("follow_up_actions", lambda a, i: F.struct(
        F.lit(2).alias("section"), o.alias("row_ord"), (i + 4).cast("int").alias("line_no"),
        F.concat(F.lit(f"    {config.REPORT_BULLET} "), a).alias("line")))
    crit = F.concat(
        F.array(line(2, o, 0, title), line(2, o, 1, action),
                line(2, o, 2, F.concat(F.lit("  Reasoning: "), F.col("reasoning")))),
        F.when(F.size("follow_up_actions") > 0, F.array(line(2, o, 3, F.lit("  Next steps:"))))
         .otherwise(F.array().cast("array<struct<section:int,row_ord:bigint,line_no:int,line:string>>")),
        steps)
    high = F.array(line(3, o, 0, title), line(3, o, 1, action))
    per_row = (d.where(F.col("risk_level").isin("CRITICAL", "HIGH"))
                .select(F.inline(F.when(F.col("risk_level") == "CRITICAL", crit).otherwise(high))))

    # pass 2: one small aggregation for the summary, section headers and action totals
    counts = d.groupBy("risk_level", "recommended_action").agg(F.count(F.lit(1)).alias("n"))
    urgent = F.col("risk_level").isin("CRITICAL", "HIGH")
    levels = (counts.groupBy("risk_level").agg(F.sum("n").alias("n"))
              .select(F.lit(1).alias("section"), _rank_of(F.col("risk_level"), config.RISK_LEVELS).alias("row_ord"),
                      F.lit(0).alias("line_no"),
                      F.format_string("  %s: %d", F.col("risk_level"), F.col("n")).alias("line")))
    section_heads = (counts.where(urgent).select("risk_level").distinct()
                     .select(F.when(F.col("risk_level") == "CRITICAL", 2).otherwise(3).alias("section"),
                             F.lit(-1).alias("row_ord"), F.lit(0).alias("line_no"),
                             F.when(F.col("risk_level") == "CRITICAL", F.lit("\n" + config.REPORT_CRITICAL_HEADER))
                             .otherwise(F.lit("\n" + config.REPORT_HIGH_HEADER)).alias("line")))
    actions = (counts.where(urgent).groupBy("recommended_action").agg(F.sum("n").alias("n"))
               .select(F.lit(4).alias("section"), _rank_of(F.col("recommended_action"), config.ACTIONS).alias("row_ord"),
                       F.lit(3).alias("line_no"),
                       F.format_string(f"  {config.REPORT_BULLET} %s: %d locations",
                                       F.col("recommended_action"), F.col("n")).alias("line")))
    out = head
    for p in [levels, section_heads, per_row, actions]:
        out = out.unionByName(p.select(F.col("section").cast("int").alias("section"),
                                       F.col("row_ord").cast("bigint").alias("row_ord"),
                                       F.col("line_no").cast("int").alias("line_no"), "line"))
    return out.select(*out_cols)


def report_text(lines: DataFrame, most: int = 10_000) -> str:
    """Report lines as one text on the driver; a report of more than ``most`` lines is an error (``write_report``
    takes any size)."""
    rows = lines.orderBy("section", "row_ord", "line_no").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"The report has more than {most} lines; write it with sinks.write_report.")
    return "\n".join(r["line"] for r in rows)
