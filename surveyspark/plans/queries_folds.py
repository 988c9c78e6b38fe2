"""Registered queries: folds."""

from __future__ import annotations


from ..operators import folds
from .fixtures import oracle
from .queries_quality import _FIX, _MERGED_CTES, merged, merged_table
from .registry import query

F_ = 5

_FOLD_CTES = _MERGED_CTES + f""",
hist as (select "group", label, count(*) as n from grouped group by 1, 2),
gs as (select "group", sum(n)::bigint as size, first(label order by n desc, label) as dom from hist group by 1),
dr as (select dom, dense_rank() over (order by dom) - 1 as r from (select distinct dom from gs)),
gp as (select gs.*, row_number() over (partition by gs.dom order by size desc, "group") - 1 + dr.r as pos
       from gs join dr using (dom)),
gf as (select "group", cast(case when pos % {2 * F_} < {F_} then pos % {2 * F_}
                                 else {2 * F_ - 1} - pos % {2 * F_} end as integer) as fold from gp),
assigned as (select grouped.*, gf.fold from grouped left join gf on grouped."group" is not distinct from gf."group")
"""


def assigned(spark, sf):
    return folds.assign_folds(merged_table(spark, sf), F_)


@query("group_label_hist", oracle(_FIX, 'select "group", label, n from hist', _FOLD_CTES))
def q_group_label_hist(spark, sf):
    return folds.group_label_hist(merged(spark, sf))


@query("assign_folds", oracle(_FIX, 'select occ_id, "group", fold from assigned', _FOLD_CTES))
def q_assign_folds(spark, sf):
    return assigned(spark, sf).select("occ_id", "group", "fold")


@query("fold_sizes", oracle(_FIX, """
select fold, count(*) as n, count(*) / sum(count(*)) over () as share from assigned group by fold
""", _FOLD_CTES))
def q_fold_sizes(spark, sf):
    return folds.fold_sizes(folds.fold_hist(merged(spark, sf), F_))


@query("fold_leakage", oracle(_FIX, f"""
select k.fold,
       count(distinct a."group") filter (where a.fold = k.fold) as n_val_groups,
       count(distinct a."group") filter (where a.fold <> k.fold) as n_train_groups,
       (select count(*) from (select "group" from assigned where fold = k.fold
                              intersect select "group" from assigned where fold <> k.fold)) as n_shared
from (select range::integer as fold from range(0, {F_})) k, assigned a
group by k.fold
""", _FOLD_CTES))
def q_fold_leakage(spark, sf):
    return folds.fold_leakage(folds.fold_hist(merged(spark, sf), F_), F_)


@query("choose_n_folds", oracle(_FIX, """
select cast(max(k) as integer) as n_folds from (
  select k from (select range as k from range(2, 11)) ks, gp
  group by k
  having count(distinct case when pos % (2 * k) < k then pos % (2 * k) else 2 * k - 1 - pos % (2 * k) end) = k)
""", _FOLD_CTES))
def q_choose_n_folds(spark, sf):
    return folds.choose_n_folds(merged(spark, sf), max_folds=10)


@query("comparison_split", oracle(_FIX, 'select occ_id, "group", label from assigned where fold = 0',
                                  _FOLD_CTES))
def q_comparison_split(spark, sf):
    return folds.comparison_split(assigned(spark, sf), 0).select("occ_id", "group", "label")


@query("fold_roles", oracle(_FIX, f"""
select occ_id, fold, r.range::integer as cv_round, case when fold = r.range then 'val' else 'train' end as role
from assigned, range(0, {F_}) r
""", _FOLD_CTES))
def q_fold_roles(spark, sf):
    return folds.fold_roles(assigned(spark, sf), F_).select("occ_id", "fold", "cv_round", "role")


_GREEDY_CTES = _MERGED_CTES + """,
hist as (select "group", label, count(*) as n from grouped group by 1, 2),
gs as (select "group", sum(n)::bigint as size, first(label order by n desc, label) as dom, max(n) as mine from hist group by 1),
gr as (select *, cast(floor(log2(size)) as integer) as step,
              row_number() over (partition by dom, cast(floor(log2(size)) as integer) order by size desc, "group") - 1 as pos from gs),
gh as (select *, cast(case when pos % {t} < {f} then pos % {t} else {t} - 1 - pos % {t} end as integer) as hand from gr),
fold_cells as (select dom, step, row_number() over (partition by dom order by step desc) as k, list({{'neg': -m, 'hand': hand}} order by -m, hand) as hands
          from (select c.dom, c.step, h.hand, coalesce(sum(g.mine), 0)::bigint as m
                from (select distinct dom, step from gh) c cross join (select range::integer as hand from range(0, {f})) h
                left join gh g on g.dom is not distinct from c.dom and g.step = c.step and g.hand = h.hand group by all) group by 1, 2),
dealt as (
  select dom, 0::bigint as k, 0 as step, list_transform(range(0, {f}), lambda i: {{'t': 0::bigint, 's': ((i - s) % {f} + {f}) % {f}, 'f': i}}) as folds,
         list_transform(range(0, {f}), lambda i: 0) as hand_of
  from (select dom, dense_rank() over (order by dom nulls first) - 1 as s from (select distinct dom from fold_cells))
  union all
  select d.dom, c.k, c.step,
         list_transform(range(1, {f} + 1), lambda i: {{'t': list_sort(d.folds)[i].t - c.hands[i].neg, 's': list_sort(d.folds)[i].s, 'f': list_sort(d.folds)[i].f}}),
         list_transform(range(1, {f} + 1), lambda i: c.hands[i].hand)
  from dealt d join fold_cells c on c.dom is not distinct from d.dom and c.k = d.k + 1),
hand_fold as (select dom, step, unnest(hand_of) as hand, cast(unnest(list_transform(folds, lambda x: x.f)) as integer) as fold from dealt where k > 0)
""".format(f=F_, t=2 * F_)


@query("greedy_folds", oracle(_FIX, """
select g."group", h.fold from gh g join hand_fold h on h.dom is not distinct from g.dom and h.step = g.step and h.hand = g.hand
""", _GREEDY_CTES).replace("with ", "with recursive ", 1))
def q_greedy_folds(spark, sf):
    return folds.greedy_folds(merged(spark, sf), F_)
