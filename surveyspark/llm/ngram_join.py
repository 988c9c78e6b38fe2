"""N-gram Jaccard self-join as a blocked sparse product of the document by shingle incidence.

Two documents link when the Jaccard similarity of their sets of word shingles
is at least ``num / den``. The product runs over the columns (shingles) that a
linked pair must share:

* Documents with equal sets are one row of the matrix (a class), named by a
  64-bit key of the set.
* All rows order their shingles alike: shingles that are frequent in the corpus
  last, by frequency, the others by hash. A linked pair shares a shingle among
  the first ``n - ceil(t n) + 1`` of each row, so only these are incidences.
* A column is a block. Its first product is with its least row alone, which
  already joins groups of near copies; a second product takes, in each column,
  the pairs of rows that are in different components by then, the rows outside
  the column's largest component against all. So no group is expanded into all
  of its pairs, and no pair of different components is left out.
* A pair is dropped when its sizes or its places in the column leave too little
  for the overlap that its sizes ask for; the overlap of the others is counted
  exactly.

Shingles and sets are compared by 64-bit hashes. Any order that is the same for
all rows gives the same links; frequencies only keep the columns short, so it is
enough to count them over all documents for a part of the hash range, and to
list the most frequent ones up to a fixed number. A column may be long all the
same (a large group of near copies shares rare shingles): its first row comes
from a sum made before the shuffle, and goes back to the rows of long columns by
broadcast (``spread_join``), so no task gets a long column.

Null, empty and blank texts have no shingles, link with nothing and are their
own component. Texts shorter than ``k`` words have their whole sequence as one
shingle. Repeated rows of one id count as one, with its least text; a null id
takes no part. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .graph import components, merged
from .tables import Shared, id_filter, in_filter, source, spread_join
from .text import Words, chunks, lean, mix

#: A shingle counts as frequent in more texts than this, or than the power of two times it that keeps the
#: list of them, which every task gets, at ``FREQUENT_MOST`` or fewer.
FREQUENT = 8
FREQUENT_MOST = 1 << 19
#: Rows of a column up to which its pairs are listed; the rows of longer columns are multiplied in tiles of
#: so many shingles.
SHORT = 64
TILE = 400_000
#: Frequencies are counted in this part of the hash range. A row's first part by hash lies in the lowest
#: quarter; the rest is for rows that have many frequent shingles to pass over.
COUNTED = np.uint64(2 * 2 ** 64 // 5)

_KEYS = "id long, n int, row long"


def _row_keys(h: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The keys of sets that follow one another in ``h``: sums of two hashes of a set's members, mixed with its size."""
    ends = np.concatenate([[0], np.cumsum(lens)])
    sums = [np.diff(np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h + np.uint64(x)), dtype=np.uint64)])[ends]) for x in (0, 77)]
    a, b = (mix(s * np.uint64(x) + lens.astype(np.uint64)) for s, x in zip(sums, (3, 5)))
    return mix(a + b * np.uint64(7)).view(np.int64)


def _joined(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The members of all sets, one set after the other, and the sets' sizes."""
    return np.concatenate(sets), np.array([len(s) for s in sets], np.int64)


def _keys(k: int):
    def run(batches):
        for b in batches:
            for i, j, data, offs in chunks(b.column(1)):
                h, lens = _joined(Words(data, offs).sets(k))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i).cast(pa.int64()), pa.array(lens.astype(np.int32)), pa.array(_row_keys(h, lens))], ["id", "n", "row"])
    return lean(run)


def _counts(k: int):
    """Shingles of the counted part of the hash range, with the number of texts of a run that hold them."""
    def run(batches):
        for b in batches:
            for _, _, data, offs in chunks(b.column(1), 1 << 20):
                h = np.concatenate(Words(data, offs).sets(k))
                h, n = np.unique(h[h < COUNTED], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int32))], ["h", "n"])
    return lean(run)


def frequent_shingles(src: DataFrame, k: int, shared: Shared) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the shingles that are in more than a limit of texts: the least limit of
    ``FREQUENT`` x 2, x 4, ... that at most ``FREQUENT_MOST`` shingles exceed."""
    df = src.mapInArrow(_counts(k), "h long, n int").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") > FREQUENT)
    df = shared.put(df, "frequent")
    at, limit = df.groupBy(F.floor(F.log2(F.col("n") / FREQUENT)).alias("step")).count().toPandas(), FREQUENT
    while at[at["step"] >= np.log2(limit / FREQUENT)]["count"].sum() > FREQUENT_MOST:
        limit *= 2
    hot = df.where(F.col("n") >= limit).toPandas()
    h = hot["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(h)
    return h[order], hot["n"].to_numpy(np.int64)[order]


def _incidence(k: int, num: int, den: int, frequent):
    """(h, row, at): the first n - ceil(t n) + 1 shingles of each row; ``at`` holds n and the place."""
    hot_h, hot_n = frequent.value

    def run(batches):
        for b in batches:
            for _, _, data, offs in chunks(b.column(1)):
                h, lens = _joined(Words(data, offs).sets(k))
                if not len(h):
                    continue
                keys = _row_keys(h, lens)
                _, first = np.unique(keys, return_index=True)  # copies in a run count once
                once = np.zeros(len(keys), bool)
                once[first] = True
                doc = np.repeat(np.arange(len(lens)), lens)
                rank = np.zeros(len(h), np.int64)
                if len(hot_h):
                    at = np.minimum(np.searchsorted(hot_h, h), len(hot_h) - 1)
                    rank = np.where(hot_h[at] == h, hot_n[at], 0)
                order = np.argsort(doc << 40 | rank, kind="stable")  # a set's hashes ascend
                pos = np.arange(len(h)) - np.repeat(np.cumsum(lens) - lens, lens)
                take = (pos < np.repeat(lens - (lens * num + den - 1) // den + 1, lens)) & once[doc]
                o, pos = order[take], pos[take]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[o].view(np.int64)), pa.array(keys[doc[o]]), pa.array((lens[doc[o]] << 32) | pos)], ["h", "row", "at"])
    return lean(run)


def _sets(k: int, bits):
    def run(batches):
        for b in batches:
            ids = b.column(0).cast(pa.int64()).to_numpy(zero_copy_only=False)
            keep = in_filter(bits.value, ids)
            b = b.filter(pa.array(keep))
            for i, j, data, offs in chunks(b.column(1)):
                sets = Words(data, offs).sets(k)
                off = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i).cast(pa.int64()), pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(sets).view(np.int64)))], ["id", "set"])
    return lean(run)


def _fits(num: int, den: int, a: Column, b: Column) -> Column:
    """Bounds of a pair from its sizes and places: the smaller set must reach t x the larger, and what can
    still be shared from the common column on, with all before it, the overlap t / (1 + t) x (|a| + |b|)."""
    na, nb, pa_, pb = F.shiftright(a, 32), F.shiftright(b, 32), a.bitwiseAND(F.lit(0xFFFFFFFF)), b.bitwiseAND(F.lit(0xFFFFFFFF))
    most = F.least(na - pa_, nb - pb) + F.least(pa_, pb)
    return (F.least(na, nb) * den >= F.greatest(na, nb) * num) & (most * (num + den) >= (na + nb) * num)


def _may_link(pairs: DataFrame, block: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (u, v) whose overlap, added up over the blocks, with all that follows the first part of a row,
    can reach the overlap that their sizes ask for."""
    a = block.select(F.col("row").alias("u"), "h", F.shiftright("at", 32).alias("nu"))
    b = block.select(F.col("row").alias("v"), "h", F.shiftright("at", 32).alias("nv"))
    shared = pairs.join(a, "u").join(b, ["v", "h"]).groupBy("u", "v").agg(F.count("*").alias("o"), F.max("nu").alias("nu"), F.max("nv").alias("nv"))
    after = F.expr(f"cast(ceil(greatest(nu, nv) * {num} / {den}) as long)") - 1
    return shared.where((F.col("o") + after) * (num + den) >= (F.col("nu") + F.col("nv")) * num).select("u", "v")


def _linked(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (u, v) whose sets overlap enough, counted exactly."""
    a = sets.select(F.col("row").alias("u"), F.col("set").alias("su"))
    b = sets.select(F.col("row").alias("v"), F.col("set").alias("sv"))
    both = pairs.join(b, "v").join(a, "u").withColumn("o", F.size(F.array_intersect("su", "sv")))
    return both.where(F.col("o") * (num + den) >= (F.size("su") + F.size("sv")) * num).select("u", "v")


def _product(num: int, den: int):
    """Overlaps of all rows of two tiles by one sparse product; for each row and component of the other tile,
    one link where there is one."""
    def run(table: pa.Table) -> pa.Table:
        rows, comps = table["row"].to_numpy(), table["comp"].to_numpy()
        left, right = (table["tile"].to_numpy() == table[c].to_numpy() for c in ("ta", "tb"))
        h, offs = table["set"].combine_chunks().flatten().to_numpy(), np.concatenate([[0], np.cumsum(table["n"].to_numpy())])
        _, col = np.unique(h, return_inverse=True)
        size = np.diff(offs)
        b = np.flatnonzero(right)
        b_cols = np.concatenate([col[offs[i]:offs[i + 1]] for i in b])
        b_offs = np.cumsum(size[b]) - size[b]
        mark = np.zeros(len(h), np.int32)
        u, v = [], []
        for i in np.flatnonzero(left).tolist():
            mine = col[offs[i]:offs[i + 1]]
            mark[mine] = 1
            both = np.add.reduceat(mark[b_cols], b_offs)
            mark[mine] = 0
            hit = b[(both * (num + den) >= (size[i] + size[b]) * num) & (comps[b] != comps[i])]
            _, once = np.unique(comps[hit], return_index=True)
            u += [rows[i]] * len(once)
            v += rows[hit[once]].tolist()
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})
    return run


def tiled(rest: DataFrame, sets: DataFrame, shared: Shared, num: int, den: int) -> DataFrame:
    """Links between rows of different components in long columns; ``sets`` has the set of each such row.

    Rows that meet in long columns are dealt into tiles of about ``TILE`` shingles, those with one first
    column's least row together; two tiles with a common column are multiplied in one task."""
    of = rest.groupBy("row").agg(F.min("least").alias("c"), F.max("comp").alias("comp"), F.max(F.shiftright("at", 32)).alias("n"))
    tiles = of.groupBy("c").agg(F.ceil(F.sum("n") / TILE).alias("k"))
    of = shared.put(of.join(tiles, "c").select("row", "comp", "n", F.xxhash64("c", F.pmod(F.xxhash64("row"), "k")).alias("tile")), "tiles")
    at = rest.join(of.select("row", "tile"), "row").groupBy("h", "tile").agg(F.max((F.col("comp") != F.col("large")).cast("int")).alias("open"))
    at = shared.put(at, "columns")
    a, b = at.where("open = 1").select("h", F.col("tile").alias("a")), at.select("h", F.col("tile").alias("b"))
    both = a.join(b, "h").select(F.least("a", "b").alias("ta"), F.greatest("a", "b").alias("tb")).distinct()
    sides = both.select("ta", "tb", F.explode(F.array_distinct(F.array("ta", "tb"))).alias("tile"))
    sets = of.join(sets, "row").withColumn("n", F.size("set"))
    return sides.join(sets, "tile").groupBy("ta", "tb").applyInArrow(_product(num, den), "u long, v long").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def ngram_jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 3, den: int = 4) -> DataFrame:
    """(id_col, n_shingles, component_id) for every id of ``docs``; the threshold is num / den."""
    spark = docs.sparkSession
    shared = Shared(spark, "ngram-join")
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    keyed = shared.put(src.mapInArrow(_keys(k), _KEYS), "keys")
    if keyed.groupBy("id").count().where("count > 1").limit(1).count():
        src = src.groupBy("id").agg(F.min("text").alias("text"))
        keyed = shared.put(src.mapInArrow(_keys(k), _KEYS), "keys")
    rows = shared.put(keyed.where("n > 0").groupBy("row").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "rows")
    frequent = spark.sparkContext.broadcast(frequent_shingles(src, k, shared))
    inc = shared.put(src.mapInArrow(_incidence(k, num, den, frequent), "h long, row long, at long"), "incidence")

    def sets_of(asked: DataFrame) -> DataFrame:
        needed = shared.put(asked.join(rows.select("row", "id"), "row"), "needed")
        bits = spark.sparkContext.broadcast(id_filter(needed))
        return shared.put(src.mapInArrow(_sets(k, bits), "id long, set array<long>").join(needed, "id").select("row", "set"), "sets")

    ends = lambda pairs: pairs.select(F.col("u").alias("row")).union(pairs.select(F.col("v").alias("row")))

    # the first row of each column with more than one; a row has the same place wherever it stands
    heads = inc.groupBy("h").agg(F.min("row").alias("least"), F.min_by("at", "row").alias("at"), F.max("row").alias("last"), F.count("*").alias("c"))
    heads = heads.where("least < last").select("h", F.struct(F.col("least").alias("row"), "at").alias("b"), "c")
    heads = shared.put(heads, "heads")
    block = shared.put(spread_join(inc, heads, "h", "c", inc.count()).select("h", "row", "at", "b").distinct(), "block")
    shared.drop(inc)
    first = block.where((F.col("b.row") < F.col("row")) & _fits(num, den, F.col("at"), F.col("b.at")))
    first = shared.put(first.select(F.col("b.row").alias("u"), F.col("row").alias("v")).distinct(), "pairs")

    likely = shared.put(_may_link(first, block, num, den), "likely")
    links = shared.put(_linked(likely, sets_of(ends(likely).distinct()), num, den), "links")
    comp = shared.put(components(links, shared), "components")

    # second product: columns that still hold rows of different components
    named = block.select("h", "row", "at").join(comp.withColumnRenamed("id", "row"), "row", "left")
    named = shared.put(named.select("h", "row", "at", F.coalesce("component", "row").alias("comp")), "named")
    per = named.groupBy("h", "comp").agg(F.count("*").alias("c"), F.min("row").alias("least"))
    mixed = per.groupBy("h").agg(F.max_by("comp", F.struct("c", "comp")).alias("large"), F.min("least").alias("least"), F.count("*").alias("comps"), F.sum("c").alias("size"))
    mixed = shared.put(mixed.where("comps > 1").drop("comps").withColumn("c", F.col("size")), "mixed")
    rest = shared.put(spread_join(named, mixed, "h", "c", named.count()), "rest")
    short = rest.where(F.col("size") <= SHORT)
    small, all_ = short.where("comp <> large").alias("a"), short.alias("b")
    apart = (F.col("a.comp") != F.col("b.comp")) & ((F.col("b.comp") == F.col("b.large")) | (F.col("a.row") < F.col("b.row")))
    pairs = small.join(all_, (F.col("a.h") == F.col("b.h")) & apart & _fits(num, den, F.col("a.at"), F.col("b.at")))
    pairs = pairs.select(F.least("a.row", "b.row").alias("u"), F.greatest("a.row", "b.row").alias("v")).distinct()
    pairs = shared.put(pairs.join(first, ["u", "v"], "left_anti"), "pairs")
    likely, long = shared.put(_may_link(pairs, block, num, den), "likely"), rest.where(F.col("size") > SHORT)
    sets = sets_of(ends(likely).union(long.select("row")).distinct())  # one scan of the texts for both
    more = _linked(likely, sets, num, den)
    if not long.isEmpty():
        more = more.union(tiled(long, sets, shared, num, den))
    more = shared.put(more, "links")
    if not more.isEmpty():
        comp = shared.put(components(merged(comp, more), shared), "components")

    named = shared.put(rows.join(comp.withColumnRenamed("id", "row"), "row", "left").withColumn("comp", F.coalesce("component", "row")).drop("component"), "classes")
    ids = shared.put(named.groupBy("comp").agg(F.min("id").alias("component_id"), F.count("*").alias("c")), "names")
    named = shared.put(spread_join(named.select("comp", "row", "copies"), ids, "comp", "c", named.count()).select("row", "component_id", "copies"), "named")
    some = spread_join(keyed.where("n > 0"), named, "row", "copies", keyed.count()).select("id", "n", "component_id")
    out = some.union(keyed.where("n = 0").select("id", "n", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), "component_id")


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity of 0.75 or more, over all of ``documents``."""
    return ngram_jaccard_components(source(spark, sf_dir, "documents"))


#: The same in DuckDB's SQL: shingles as text, all pairs by shared shingles, reachability.
OP4_SQL = """
with recursive w as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws from documents),
s as (select distinct doc_id, g from (select doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
  else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as g from w)),
n as (select w.doc_id, count(g) as n from w left join s using (doc_id) group by 1),
o as (select a.doc_id as u, b.doc_id as v, count(*) as o from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
l as (select u, v from o join n x on u = x.doc_id join n y on v = y.doc_id where 100 * o >= 75 * (x.n + y.n - o)),
e as (select u, v from l union select v, u from l),
r as (select doc_id, doc_id as other from n union select r.doc_id, e.v from r join e on r.other = e.u)
select r.doc_id, any_value(n.n) as n_shingles, min(other) as component_id from r join n using (doc_id) group by 1
"""
