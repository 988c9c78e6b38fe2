"""Preference formatting: one prompt and a pair of masked completions.

A chosen and a rejected conversation with the same pair id are compared turn by
turn; the turns before the first difference are their longest common prefix.
The prefix is rendered once, as the prompt; the rest of either conversation is
a completion, in which only what the assistant says is trained on.

The result has one row per rendered turn, with its place in its part's string
in code points, so no conversation has to fit into one cell or task: the prefix
is found by aggregates, and places are sums over runs of ``RUN`` turns, then
within a run. ``assemble`` joins the parts into strings for pairs of common
size.

Turns are matched by their numbers, and a turn's rows by role and text. Equal
rows of one conversation and turn count once; different rows of one turn stand
in the order of role and text. A null pair id takes no part; a null turn stands
first; a null role or text is rendered as empty and equals only a null. A pair
with one side only has no prompt, and ``paired`` is false.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .tables import source

#: The marks of a rendered turn.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
RUN = 256


def preference_segments(chosen: DataFrame, rejected: DataFrame, pair_col: str = "pair_id", assistant: str = "assistant") -> DataFrame:
    """(pair_col, part, turn, role, segment, start, end, loss_start, loss, paired) for every turn; ``part`` is prompt,
    chosen or rejected, and ``loss`` marks segments whose text from ``loss_start`` on is trained on.
    Both inputs have pair_col, turn, role and text; other columns are not read."""
    cols = [F.col(pair_col).alias("pair"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")]
    rows = chosen.select(F.lit(0).alias("side"), *cols).union(rejected.select(F.lit(1).alias("side"), *cols)).where("pair is not null").distinct()
    said = F.xxhash64("role", "text", F.col("role").isNull(), F.col("text").isNull()).cast("decimal(38,0)")
    turns = rows.groupBy("pair", "side", "turn").agg(F.sum(said).alias("h"), F.count("*").alias("n"))
    turns = turns.groupBy("pair", "turn").agg(F.count("*").alias("sides"), F.min("side").alias("low"), F.max("side").alias("high"), (
        (F.count("*") < 2) | (F.min("h") != F.max("h")) | (F.min("n") != F.max("n"))).alias("differs"))
    place = F.struct(F.col("turn").isNotNull().alias("later"), F.col("turn").alias("turn"))
    first = turns.groupBy("pair").agg(F.min(F.when(F.col("differs"), place)).alias("first"), ((F.min("low") == 0) & (F.max("high") == 1)).alias("paired"))
    both = rows.join(first, "pair")
    common = F.col("paired") & (F.col("first").isNull() | (place < F.col("first")))
    part = F.when(common, "prompt").when(F.col("side") == 0, "chosen").otherwise("rejected")
    both = both.withColumn("part", part).where("not (part = 'prompt' and side = 1)")
    head = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("")), F.lit(MIDDLE))
    both = both.withColumn("segment", F.concat(head, F.coalesce("text", F.lit("")), F.lit(CLOSE)))
    both = both.withColumn("size", F.length("segment").cast("long")).withColumn("run", F.expr(f"coalesce(turn div {RUN}, -1L << 40)"))

    runs = both.groupBy("pair", "part", "run").agg(F.sum("size").alias("all"))
    before = F.coalesce(F.sum("all").over(W.partitionBy("pair", "part").orderBy("run").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("pair", "part", "run", before.alias("before"))
    inside = F.sum("size").over(W.partitionBy("pair", "part", "run").orderBy("turn", "role", "text").rowsBetween(W.unboundedPreceding, 0))
    placed = both.withColumn("inside", inside).join(runs, ["pair", "part", "run"])
    end = F.col("before") + F.col("inside")
    return placed.select(
        F.col("pair").alias(pair_col), "part", "turn", "role", "segment", (end - F.col("size")).alias("start"), end.alias("end"),
        (end - F.col("size") + F.length(head)).alias("loss_start"), ((F.col("part") != "prompt") & F.coalesce(F.col("role") == assistant, F.lit(False))).alias("loss"), "paired")


def assemble(segments: DataFrame, pair_col: str = "pair_id") -> DataFrame:
    """(pair_col, prompt, chosen, rejected, chosen_loss, rejected_loss): whole strings and the spans trained on."""
    of = lambda part, e: F.sort_array(F.collect_list(F.when(F.col("part") == part, e)))
    text = lambda part: F.array_join(F.transform(of(part, F.struct("start", "segment")), lambda x: x["segment"]), "").alias(part)
    loss = lambda part: of(part, F.when(F.col("loss"), F.struct(F.col("loss_start").alias("start"), "end"))).alias(f"{part}_loss")
    return segments.groupBy(pair_col).agg(*map(text, ("prompt", "chosen", "rejected")), loss("chosen"), loss("rejected"))


def op1_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of neighbouring ids of ``conversations``: 2 k is the chosen and 2 k + 1 the rejected one of pair k."""
    conv = source(spark, sf_dir, "conversations").withColumn("pair_id", F.expr("conv_id >> 1"))
    return preference_segments(conv.where("conv_id & 1 = 0"), conv.where("conv_id & 1 = 1"))


OP1_SQL = """
with r as (select distinct conv_id // 2 as pair_id, conv_id % 2 as side, turn, role, text from conversations where conv_id is not null),
t as (select pair_id, side, turn, list(struct_pack(a := role, b := text) order by role nulls first, text nulls first) as said from r group by all),
d as (select pair_id, turn, min(side) as low, max(side) as high, count(*) < 2 or min(said) <> max(said) as differs from t group by all),
f as (select pair_id, min(turn) filter (differs) as first_turn, min(low) = 0 and max(high) = 1 as paired from d group by all),
p as (select r.*, f.paired, case when f.paired and (first_turn is null or turn < first_turn) then 'prompt' when side = 0 then 'chosen' else 'rejected' end as part,
  '<|im_start|>' || coalesce(role, '') || chr(10) as head, '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) as segment
  from r join f using (pair_id)),
o as (select *, (sum(length(segment)) over (partition by pair_id, part order by turn nulls first, role nulls first, text nulls first rows unbounded preceding))::bigint as "end"
  from p where not (part = 'prompt' and side = 1))
select pair_id, part, turn, role, segment, "end" - length(segment) as start, "end", "end" - length(segment) + length(head) as loss_start,
  part <> 'prompt' and coalesce(role = 'assistant', false) as loss, paired from o
"""
