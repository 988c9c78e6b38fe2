"""Stratified, group-disjoint k-fold assignment and its checks.

Folds are dealt on the group x label histogram, never on rows: the histogram
has one row per (spatial group, label) and is bounded by geography, so the
deal stays small at any data size. Rows get their fold through an equi-join
on ``group``, null groups included (AQE broadcasts the group -> fold table when
its bytes allow it, and splits hot groups when they do not).

Serpentine deal: groups are ranked inside their dominant label by size
(descending, then name), shifted by the label's rank, and snaked over the
folds 0,1,..,F-1,F-1,..,1,0,... A group is in exactly one fold, every label's
largest groups spread over different folds, and fold sizes even out. The rank
is a distributed row number (:func:`distributed_rank`), so a label that
dominates most groups is still ranked by many tasks.

Greedy deal (:func:`greedy_folds`): folds are chosen by the rows they have of a
group's dominant label, in rounds over size classes.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..session import materialize


def group_label_hist(df: DataFrame, group_col="group", label_col="label") -> DataFrame:
    return df.groupBy(group_col, label_col).agg(F.count(F.lit(1)).alias("n"))


def distributed_rank(df: DataFrame, part: str, order: list, out: str = "rn") -> DataFrame:
    """0-based ``row_number()`` within ``part`` by ``order`` without one task per ``part`` value.

    Rows are range-partitioned on ``(part, order...)``, ranked inside their own
    range and written once with the range's number; the offsets of the ranges
    and the rows are then both read from that table, so they cannot see
    different range bounds. ``order`` must make the order total (end with a
    unique column).
    """
    ranged = df.repartitionByRange(F.col(part), *order).withColumn("_pid", F.spark_partition_id())
    local = materialize(ranged.withColumn("_local", F.row_number().over(
        Window.partitionBy("_pid", part).orderBy(*order)) - 1), "ranked")
    sizes = local.groupBy("_pid", part).agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = sizes.select(
        F.col("_pid").alias("_p"), F.col(part).alias("_v"),
        F.coalesce(F.sum("_cnt").over(Window.partitionBy(part).orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    same = (F.col("_pid") == F.col("_p")) & F.col(part).eqNullSafe(F.col("_v"))
    return local.join(offsets, same).withColumn(out, F.col("_off") + F.col("_local")).drop(
        "_pid", "_local", "_off", "_p", "_v")


def group_positions(hist: DataFrame, group_col="group", label_col="label") -> DataFrame:
    """Per group: size, dominant label, and its position in the deal order."""
    gs = hist.groupBy(group_col).agg(
        F.sum("n").alias("size"),
        F.min(F.struct((-F.col("n")).alias("neg_n"), F.col(label_col).alias("lab")))["lab"].alias("dom"))
    ranked = distributed_rank(gs, "dom", [F.col("size").desc(), F.col(group_col).asc()], "_rn")
    # one row per label: bounded by the class count
    dom_rank = (ranked.select(F.col("dom").alias("_dom")).distinct()
                  .withColumn("dom_rank", F.dense_rank().over(Window.orderBy("_dom")) - 1))
    return (ranked.join(dom_rank, F.col("dom").eqNullSafe(F.col("_dom")))
                  .withColumn("pos", F.col("_rn") + F.col("dom_rank")).drop("_rn", "_dom"))


def serpentine(pos, n_folds) -> F.Column:
    m = F.pmod(pos, F.lit(2) * n_folds)
    return F.when(m < n_folds, m).otherwise(F.lit(2) * n_folds - 1 - m).cast("int")


def greedy_folds(df: DataFrame, n_folds: int = config.N_FOLDS, group_col="group", label_col="label") -> DataFrame:
    """``(group, fold)`` by a greedy stratified deal, an alternative to :func:`group_folds` for skewed sizes.

    Groups of one dominant label are taken by size class (powers of two, the largest first). In a class they are
    snaked over ``n_folds`` hands, by size; then the hands, the one with most rows of the label first, go to the
    folds that have fewest of it so far. The totals of a label are all that passes from class to class: a row per
    label, class and hand, whatever the number of groups. So a label's folds differ by no more than its largest
    group and the unevenness of one class.
    """
    hist = group_label_hist(df, group_col, label_col)
    gs = hist.groupBy(group_col).agg(F.sum("n").alias("size"), F.min(F.struct((-F.col("n")).alias("neg_n"), F.col(label_col).alias("lab"))).alias("d"))
    gs = gs.select(group_col, "size", F.col("d.lab").alias("dom"), (-F.col("d.neg_n")).alias("mine"), F.floor(F.log2("size")).cast("int").alias("step"))
    cell = F.struct("dom", "step")
    ranked = distributed_rank(gs.withColumn("cell", cell), "cell", [F.col("size").desc(), F.col(group_col).asc()], "_rn")
    ranked = ranked.withColumn("hand", serpentine(F.col("_rn"), F.lit(n_folds)))
    hands = ranked.groupBy("dom", "step", "hand").agg(F.sum("mine").alias("mine"))
    rank = hands.select("dom").distinct().withColumn("shift", F.dense_rank().over(Window.orderBy("dom")) - 1)  # one row a label
    hands = hands.join(rank.withColumnRenamed("dom", "_dom"), F.col("dom").eqNullSafe(F.col("_dom"))).drop("_dom")

    def deal(key, rows):
        total, out = [0] * n_folds, []
        shift = int(rows["shift"].iloc[0]) % n_folds
        for step, of in sorted(rows.groupby("step"), reverse=True):
            have = dict(zip(of["hand"], of["mine"]))
            order = sorted(range(n_folds), key=lambda f: (total[f], (f - shift) % n_folds))
            for fold, hand in zip(order, sorted(range(n_folds), key=lambda h: (-have.get(h, 0), h))):
                total[fold] += int(have.get(hand, 0))
                out.append((key[0], step, hand, fold))
        return pd.DataFrame(out, columns=["_dom", "_step", "_hand", "fold"])

    of = dict(gs.dtypes)["dom"]
    dealt = hands.groupBy("dom").applyInPandas(deal, f"_dom {of}, _step int, _hand int, fold int")
    same = F.col("dom").eqNullSafe(F.col("_dom")) & (F.col("step") == F.col("_step")) & (F.col("hand") == F.col("_hand"))
    return ranked.join(dealt, same).select(group_col, "fold")


def group_folds(df: DataFrame, n_folds: int = config.N_FOLDS, group_col="group",
                label_col="label") -> DataFrame:
    """``(group, fold)`` for every group."""
    pos = group_positions(group_label_hist(df, group_col, label_col), group_col, label_col)
    return pos.select(group_col, serpentine(F.col("pos"), F.lit(n_folds)).alias("fold"))


def assign_folds(df: DataFrame, n_folds: int = config.N_FOLDS, group_col="group",
                 label_col="label") -> DataFrame:
    """Every row with the fold of its group; rows without a group are a group of their own."""
    gf = group_folds(df, n_folds, group_col, label_col).withColumnRenamed(group_col, "_group")
    return df.join(gf, F.col(group_col).eqNullSafe(F.col("_group")), "left").drop("_group")


def fold_hist(df: DataFrame, n_folds: int = config.N_FOLDS, group_col="group", label_col="label") -> DataFrame:
    """``(group, fold, n)``: the fold table with group sizes, from the histogram alone."""
    pos = group_positions(group_label_hist(df, group_col, label_col), group_col, label_col)
    return pos.select(group_col, serpentine(F.col("pos"), F.lit(n_folds)).alias("fold"), F.col("size").alias("n"))


def fold_sizes(assigned: DataFrame) -> DataFrame:
    """Rows per fold and their share; ``assigned`` has a row each, or ``n`` rows in one (``fold_hist``)."""
    rows = F.sum("n") if "n" in assigned.columns else F.count(F.lit(1))
    sizes = assigned.groupBy("fold").agg(rows.alias("n"))
    # the total is taken over the <= F aggregated rows, not over the data
    return sizes.select("fold", "n", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))


def fold_leakage(assigned: DataFrame, n_folds: int = config.N_FOLDS, group_col="group") -> DataFrame:
    """Per fold: validation groups, training groups, and groups on both sides (must be 0)."""
    per_group = assigned.groupBy(group_col).agg(F.collect_set("fold").alias("folds"))
    k = F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1))).alias("k")
    x = per_group.select(group_col, "folds", k)
    in_val = F.array_contains("folds", F.col("k"))
    in_train = F.size(F.array_remove("folds", F.col("k"))) > 0
    return x.groupBy("k").agg(
        F.count_if(in_val).alias("n_val_groups"),
        F.count_if(in_train).alias("n_train_groups"),
        F.count_if(in_val & in_train).alias("n_shared")).withColumnRenamed("k", "fold")


def choose_n_folds(df: DataFrame, max_folds: int = config.N_FOLDS, group_col="group",
                   label_col="label") -> DataFrame:
    """Largest fold count in [2, min(max_folds, rows, groups)] with no empty fold.

    All candidate counts are dealt at once on the group table (one job);
    ``n_folds`` is null when no count works.
    """
    pos = group_positions(group_label_hist(df, group_col, label_col), group_col, label_col)
    # k above the group count can never fill every fold, so no explicit upper
    # bound (and no join with the totals) is needed
    cand = pos.select(F.explode(F.sequence(F.lit(2), F.lit(max(2, max_folds)))).alias("k"), "pos") \
              .where(F.col("k") <= max_folds) \
              .select("k", serpentine(F.col("pos"), F.col("k")).alias("fold"))
    ok = (cand.groupBy("k").agg(F.countDistinct("fold").alias("used"))
              .where(F.col("used") == F.col("k")))
    return ok.agg(F.max("k").cast("int").alias("n_folds"))


def choose_n_folds_value(df: DataFrame, max_folds: int = config.N_FOLDS, **kw) -> int:
    """Driver-side value of :func:`choose_n_folds` (a one-row summary); raises when none works."""
    n = choose_n_folds(df, max_folds, **kw).first()["n_folds"]
    if n is None:
        raise ValueError("Dataset too small for grouped CV.")
    return int(n)


def comparison_split(assigned: DataFrame, fold: int = config.COMPARISON_FOLD) -> DataFrame:
    return assigned.where(F.col("fold") == fold)


def fold_roles(assigned: DataFrame, n_folds: int = config.N_FOLDS) -> DataFrame:
    """Each row once per CV round: ``val`` in its own fold's round, ``train`` otherwise."""
    return (assigned.withColumn("cv_round", F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1))))
                    .withColumn("role", F.when(F.col("fold") == F.col("cv_round"), F.lit("val"))
                                .otherwise(F.lit("train"))))

