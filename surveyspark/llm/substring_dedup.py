"""Substring deduplication: MinHash banding of short paragraphs, exact verification, components.

A text is cut into paragraphs by its content alone: at line ends, and after the
word that is the least of some ``WINDOW`` words in a row by the hash of it and
the next one (sentence ends before all others), unless that is less than
``WINDOW`` words from the ends of its line. A cut depends on no more than the
``WINDOW`` words to either side, so a passage that is set into other text has
the same cuts wherever it stands, but for its two ends: of n words in a row,
n - 4 * WINDOW + 2 at least are paragraphs of all copies. Paragraphs are
compared with the words that follow them in their line up to ``MIN_WORDS``, so
that a short one is not taken for an unrelated one.

1. Occurrences (paragraph hash, document, place) are written once.
2. Paragraphs of at least ``k`` words of their own get MinHash values of their
   word shingles (the others overlap the next ones and must be equal);
   ``tune_bands`` picks rows and bands for the recall asked for at the
   threshold. A paragraph that is in very many texts comes from each task a few
   times only. Paragraphs that share a band are candidates with the least one
   of the band.
3. The exact Jaccard similarity of the candidates' shingle sets is taken from
   their texts; pairs at ``num / den`` or more are linked. Where the others of
   a band are in several components by then, they are joined once more by the
   shingles that a linked pair must share, in an order with the frequent ones
   last, and those of different components are compared, in short columns pair
   by pair and in long ones by tiles. Components of all links and equal
   paragraphs are the classes.
4. In each class the first occurrence stays, that of the least id and there the
   first place. The others, in other documents or later in the same one, go where
   adjoining ones (with at most one other paragraph or ``BRIDGE`` words between)
   have ``min_repeat`` words or more in all, so that chance repeats of a short
   line stay.

Null and empty texts have no paragraphs. Repeated rows of one id count as one
document with its least text. A null id takes no part. Extra columns are not
read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .graph import components, merged
from .ngram_join import SHORT, tiled
from .tables import Shared, id_filter, in_filter, source, spread_join, unused
from .text import Words, chunks, distinct, lean, mix

MIN_WORDS = 8
MIN_REPEAT = 20
WINDOW = 8
BRIDGE = 2 * WINDOW
SEEN = 1 << 17
_U = np.uint64
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?"]] = True
_STEP, _BACK = _U(0xD1342543DE82EF95), _U(pow(0xD1342543DE82EF95, -1, 1 << 64))


def tune_bands(threshold: float, recall: float = 0.95, most_rows: int = 4) -> tuple[int, int]:
    """(rows, bands) with the fewest bands, then the most rows, whose chance of a shared band at
    ``threshold`` is ``recall`` or more."""
    need = [(max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold ** r))), -r) for r in range(1, most_rows + 1)]
    bands, r = min(need)
    return -r, bands


def _least(w: Words, data: np.ndarray) -> np.ndarray:
    """The words that are the last least of some ``WINDOW`` words in a row."""
    n = len(w.start)
    out = np.zeros(n, bool)
    if n > WINDOW:
        value = mix(w.hash[1:] + w.hash[:-1] * _U(3)) >> _U(1)
        value[~_END[data[w.end[:-1] - 1]]] |= _U(1 << 63)
        m = n - WINDOW  # windows of words that have a next one
        least = value[:m].copy()
        for j in range(1, WINDOW):
            np.minimum(least, value[j:j + m], out=least)
        at = np.zeros(m, np.int64)
        for j in range(WINDOW):
            at[value[j:j + m] == least] = j
        out[at + np.arange(m)] = True
    return out


class Paragraphs:
    """Paragraphs of a run of texts: words ``a`` to ``b``, compared up to ``e``; ``doc``, number ``pos`` and first
    word ``word`` in it, ``hash``."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        w = self.words = Words(data, offs)
        n = len(w.start)
        breaks = np.flatnonzero(data == 10)
        last = np.zeros(n, bool)
        last[w.first[1:][w.first[1:] > w.first[:-1]] - 1] = True
        hard = last.copy()
        hard[:-1] |= np.searchsorted(breaks, w.start[1:]) > np.searchsorted(breaks, w.end[:-1])
        hard = np.flatnonzero(hard)
        line_of = np.searchsorted(hard, np.arange(n))
        begin = np.concatenate([[0], hard[:-1] + 1])[line_of] if n else hard
        end = hard[line_of] + 1
        soft = _least(w, data)
        at = np.arange(n) + 1
        soft &= (at - begin >= WINDOW) & (end - at >= WINDOW)
        soft[hard] = True
        self.b = np.flatnonzero(soft) + 1
        self.a = np.concatenate([[0], self.b[:-1]]).astype(np.int64) if n else self.b
        self.e = np.maximum(self.b, np.minimum(self.a + MIN_WORDS, end[self.a]))
        self.doc = np.searchsorted(w.first, self.a, side="right") - 1
        self.pos = np.arange(len(self.a)) - np.searchsorted(self.a, w.first)[self.doc]
        self.word = self.a - w.first[self.doc]
        up = np.full(n + 1, _STEP, _U)
        up[0] = 1
        down = np.full(n + 1, _BACK, _U)
        down[0] = 1
        up, down = np.cumprod(up, dtype=_U), np.cumprod(down, dtype=_U)
        run = np.concatenate([np.zeros(1, _U), np.cumsum(w.hash * up[:n], dtype=_U)])
        self.hash = mix((run[self.e] - run[self.a]) * down[self.a] + (self.e - self.a).astype(_U))

    def code_points(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each paragraph in code points of its text."""
        w = self.words
        inner = np.flatnonzero((w.data & 0xC0) == 0x80)  # bytes that go on with a code point
        chars = lambda at: at - np.searchsorted(inner, at)
        zero = chars(w.offs[self.doc])
        return chars(w.start[self.a]) - zero, chars(w.end[self.b - 1]) - zero


def _occurrences(batches):
    for b in batches:
        for i, j, data, offs in chunks(b.column(1)):
            p = Paragraphs(data, offs)
            ids = b.column(0).slice(i, j - i).to_numpy(zero_copy_only=False)
            s, e = p.code_points()
            order = np.lexsort((p.hash, p.doc))  # stable, so the places of a paragraph in a text ascend
            new = np.ones(len(order) + 1, bool)
            new[1:-1] = (np.diff(p.doc[order]) != 0) | (np.diff(p.hash[order]) != 0)
            edge = np.zeros(len(order), np.int32)
            edge[order] = new[:-1] + 2 * new[1:]
            yield pa.RecordBatch.from_arrays(
                [pa.array(p.hash.view(np.int64)), pa.array(ids[p.doc]), *(pa.array(x.astype(np.int32)) for x in (p.pos, p.word, s, e, p.b - p.a, edge))],
                ["par", "id", "pos", "word", "start", "end", "words", "edge"])


def _bands(k: int, rows: int, bands: int):
    seeds = np.random.default_rng(11).integers(1, 2 ** 63, rows * bands, dtype=np.uint64)

    def run(batches):
        seen = np.zeros(SEEN, _U)  # by the low bits of their hash, the last paragraphs that this task gave
        seen[0] = 1  # no paragraph of this place
        for b in batches:
            got = []
            for _, _, data, offs in chunks(b.column(1)):
                p = Paragraphs(data, offs)
                long = (p.b == p.e) & (p.b - p.a >= k)
                a, e, h = p.a[long], p.b[long] - k + 1, p.hash[long]
                if not len(a):
                    continue
                h, first = np.unique(h, return_index=True)
                a, e = a[first], e[first]
                slot = (h & _U(SEEN - 1)).astype(np.int64)
                new = seen[slot] != h
                seen[slot] = h
                if not new.any():
                    continue
                a, e, h = a[new], e[new], h[new]
                cut = np.stack([a, e], 1).ravel()
                sh = np.append(p.words.shingles(k), _U(0))
                low = [np.minimum.reduceat(mix(sh ^ s), cut)[::2] for s in seeds]
                for q in range(bands):
                    key = rolled_columns(low[q * rows:(q + 1) * rows], q)
                    got.append((key, h))
            if got:
                key, h = (np.concatenate(x) for x in zip(*got))
                _, first = np.unique(key * _U(31) + h, return_index=True)
                key, h = key[first], h[first]
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(h.view(np.int64))], ["band", "par"])
    return lean(run)


def rolled_columns(cols: list[np.ndarray], salt: int) -> np.ndarray:
    x = np.full(len(cols[0]), salt + 1, _U)
    for c in cols:
        x = mix(x + c)
    return x


def _held(bits):
    """The rows whose ids may be asked for."""
    def run(batches):
        for b in batches:
            yield b.filter(pa.array(in_filter(bits.value, b.column(0).to_numpy(zero_copy_only=False))))
    return run


def _sets(k: int):
    """Shingle sets of the paragraphs named by (par, pos) lists, from their documents' texts."""
    def run(batches):
        for b in batches:
            for i, j, data, offs in chunks(b.column(1)):
                p = Paragraphs(data, offs)
                at = np.searchsorted(p.a, p.words.first)
                sh = p.words.shingles(k)
                par, off, out = [], [0], []
                for d, wanted in enumerate(b.column(2).slice(i, j - i).to_pylist()):
                    for pos in wanted:
                        q = at[d] + pos
                        s = distinct(sh[p.a[q]:p.e[q] - k + 1])
                        par.append(p.hash[q])
                        out.append(s)
                        off.append(off[-1] + len(s))
                if par:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.array(par, _U).view(np.int64)), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(np.concatenate(out).view(np.int64)))], ["par", "set"])
    return lean(run)


def _apart(near: DataFrame, sets: DataFrame, comp: DataFrame, num: int, den: int, shared: Shared) -> DataFrame:
    """Links (u, v) between paragraphs of different components that have a candidate ``near`` in common.

    A linked pair has a shingle in common among the first n - ceil(t n) + 1 of each, in any order that is the
    same for all; the rare ones first keep the columns short. In a column the paragraphs outside its largest
    component are compared with all of other components."""
    named = comp.withColumnRenamed("id", "par").withColumnRenamed("component", "comp")
    both = near.join(named.withColumnRenamed("par", "v"), "v", "left").withColumn("comp", F.coalesce("comp", "v"))
    both = shared.put(both.select("u", "v", "comp"), "named")
    mixed = both.groupBy("u").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("u")
    rest = both.join(mixed, "u", "left_semi").select(F.col("v").alias("par"), "comp").distinct()
    rest = shared.put(rest.join(sets, "par").select("par", "comp", "set"), "rest")

    each = rest.select("par", "comp", F.size("set").alias("n"), F.explode("set").alias("h"))
    count = each.groupBy("h").agg(F.count("*").alias("c")).where("c > 1")
    first = each.join(count, "h", "left").groupBy("par").agg(
        F.max("comp").alias("comp"), F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct(F.coalesce("c", F.lit(1)).alias("c"), "h"))).alias("all"))
    first = first.withColumn("all", F.expr(f"slice(all, 1, n - cast(ceil(n * {num} / {den}) as int) + 1)"))
    first = first.select("par", "comp", "n", F.explode("all").alias("x")).where("x.c > 1")
    first = shared.put(first.select(F.col("x.h").alias("h"), "par", "comp", "n"), "columns")
    per = first.groupBy("h", "comp").agg(F.count("*").alias("c"), F.min("par").alias("least"))
    large = per.groupBy("h").agg(F.max_by("comp", F.struct("c", "comp")).alias("large"), F.min("least").alias("least"), F.count("*").alias("comps"), F.sum("c").alias("size"))
    large = shared.put(large.where("comps > 1").drop("comps").withColumn("c", F.col("size")), "mixed")
    first = shared.put(spread_join(first, large, "h", "c", first.count()), "mixed-columns")
    short = first.where(F.col("size") <= SHORT)
    a, b = short.where("comp <> large").alias("a"), short.alias("b")
    apart = (F.col("a.comp") != F.col("b.comp")) & ((F.col("b.comp") == F.col("b.large")) | (F.col("a.par") < F.col("b.par")))
    fits = F.least("a.n", "b.n") * den >= F.greatest("a.n", "b.n") * num
    pairs = a.join(b, (F.col("a.h") == F.col("b.h")) & apart & fits)
    pairs = shared.put(pairs.select(F.least("a.par", "b.par").alias("u"), F.greatest("a.par", "b.par").alias("v")).distinct(), "pairs")
    long = first.where(F.col("size") > SHORT).select("h", F.col("par").alias("row"), F.shiftleft(F.col("n").cast("long"), 32).alias("at"), "comp", "large", "least")
    links = _similar(pairs, rest, num, den)
    if not long.isEmpty():
        links = links.union(tiled(long, rest.select(F.col("par").alias("row"), "set"), shared, num, den))
    links = shared.put(links, "links")
    for done in (both, rest, pairs, first):
        shared.drop(done)
    return links


def _similar(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (u, v) whose sets have a Jaccard similarity of num / den or more."""
    a = sets.select(F.col("par").alias("u"), F.col("set").alias("su"))
    b = sets.select(F.col("par").alias("v"), F.col("set").alias("sv"))
    both = pairs.join(b, "v").join(a, "u").withColumn("o", F.size(F.array_intersect("su", "sv")))
    return both.where(F.col("o") * (num + den) >= (F.size("su") + F.size("sv")) * num).select("u", "v")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 3, den: int = 4,
                   recall: float = 0.95, min_repeat: int = MIN_REPEAT) -> DataFrame:
    """(id_col, start, end, n_words, class_id, kept_doc_id): the spans of ``docs`` to remove, in code points,
    and the least document that keeps such a passage."""
    spark = docs.sparkSession
    shared = Shared(spark, "substring-dedup")
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    # edge: 1 for the first place of a paragraph in its text, 2 for the last, 3 for the only one, 0 between them
    shape = "par long, id long, pos int, word int, start int, end int, words int, edge int"
    occ = shared.put(src.mapInArrow(lean(_occurrences), shape), "occurrences")
    if occ.where("pos = 0").groupBy("id").count().where("count > 1").limit(1).count():
        src = src.groupBy("id").agg(F.min("text").alias("text"))
        occ = shared.put(src.mapInArrow(lean(_occurrences), shape), "occurrences")

    rows, bands = tune_bands(num / den, recall)
    # the least paragraph of a band, by a sum before the shuffle, goes to the others; bands of very many by broadcast
    band = shared.put(src.mapInArrow(_bands(k, rows, bands), "band long, par long"), "bands")
    hubs = band.groupBy("band").agg(F.min("par").alias("hub"), F.max("par").alias("last"), F.count("*").alias("c")).where("hub < last").drop("last")
    hubs = shared.put(hubs, "hubs")
    near = spread_join(band, hubs, "band", "c", band.count()).where("par <> hub")
    near = shared.put(near.select(F.col("hub").alias("u"), F.col("par").alias("v")).distinct(), "candidates")
    shared.drop(band)
    shared.drop(hubs)
    asked = near.select(F.col("u").alias("par")).union(near.select(F.col("v").alias("par"))).distinct()
    # one row per paragraph, summed up before the shuffle: its first and its last place; those with one place that
    # are no candidates can't be in a class with others
    place = F.struct("id", "pos")
    each = occ.groupBy("par").agg(
        F.min("id").alias("id"), F.min_by("pos", F.when(F.expr("edge & 1") > 0, F.col("id"))).alias("pos"),
        F.max("id").alias("id2"), F.max_by("pos", F.when(F.expr("edge & 2") > 0, F.col("id"))).alias("pos2"))
    each = each.select("par", place.alias("at"), F.struct(F.col("id2").alias("id"), F.col("pos2").alias("pos")).alias("high"))
    each = each.join(asked.withColumn("asked", F.lit(True)), "par", "left").where("asked or at < high")
    each = shared.put(each, "paragraphs")
    wanted = shared.put(each.where("asked").groupBy(F.col("at.id").alias("id")).agg(F.collect_list("at.pos").alias("wanted")), "wanted")
    bits = spark.sparkContext.broadcast(id_filter(wanted))  # texts without such a paragraph are not shuffled
    some = src.mapInArrow(_held(bits), src.schema).join(wanted, "id").select("id", "text", "wanted")
    sets = shared.put(some.mapInArrow(_sets(k), "par long, set array<long>"), "sets")
    links = shared.put(_similar(near, sets, num, den), "links")
    comp = components(links, shared)
    more = _apart(near, sets, comp, num, den, shared)
    if not more.isEmpty():
        comp = components(merged(comp, more), shared)
    shared.drop(near)
    shared.drop(sets)

    equal = each.join(comp.withColumnRenamed("id", "par"), "par", "left").where("component is not null or at < high")
    equal = shared.put(equal.select("par", F.coalesce("component", "par").alias("class_id"), F.col("at").alias("low"), "high"), "classes")
    kept = equal.groupBy("class_id").agg(F.min("low").alias("kept"), F.max("high").alias("high")).where("kept < high").drop("high")
    classes = equal.join(kept, "class_id").select("par", "class_id", "kept")
    again = occ.join(classes, "par").where(place != F.col("kept"))

    by = W.partitionBy("id").orderBy("pos")
    gap = F.col("pos") - F.lag("pos").over(by)
    between = F.col("word") - F.lag(F.col("word") + F.col("words")).over(by)
    again = again.withColumn("gap", F.coalesce(gap, F.lit(9))).withColumn("between", F.coalesce(between, F.lit(BRIDGE + 1)))
    again = again.withColumn("run", F.sum(((F.col("gap") > 2) & (F.col("between") > BRIDGE)).cast("int")).over(by))
    again = again.withColumn("piece", F.sum((F.col("gap") > 1).cast("int")).over(by))
    piece = again.groupBy("id", "run", "piece").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("n_words"), F.min("class_id").alias("class_id"), F.min("kept.id").alias("kept_doc_id"))
    piece = piece.withColumn("all", F.sum("n_words").over(W.partitionBy("id", "run"))).where(F.col("all") >= min_repeat)
    return piece.select(F.col("id").alias(id_col), "start", "end", "n_words", "class_id", "kept_doc_id")


def _remaining(text_at: int, count_at: int | None):
    """The rows without their last column, the spans to cut out of their texts, where there are any; those with
    nothing but white space left go."""
    def run(batches):
        for b in batches:
            cuts, cols = b.column(b.num_columns - 1), b.columns[:-1]
            at, cut = cuts.offsets.to_numpy(), cuts.is_valid().to_numpy(zero_copy_only=False)
            start, end = (cuts.values.field(n).to_numpy().tolist() for n in ("start", "end"))
            keep, texts = np.ones(len(cut), bool), cols[text_at].to_pylist()
            for r in np.flatnonzero(cut).tolist():
                t, i, j = texts[r] or "", at[r], at[r + 1]
                t = texts[r] = "".join([t[x:y] for x, y in zip([0, *end[i:j]], [*start[i:j], len(t)])])
                keep[r] = bool(t.strip(" \t\n\v\f\r"))
            cols[text_at] = pa.array(texts, cols[text_at].type)
            if count_at is not None:
                counts = cols[count_at].to_pylist()
                cols[count_at] = pa.array([len(t) if c else n for n, t, c in zip(counts, texts, cut.tolist())], cols[count_at].type)
            yield pa.RecordBatch.from_arrays(cols, b.schema.names[:-1]).filter(pa.array(keep))
    return run


def remove_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str = "n_chars") -> DataFrame:
    """``docs`` without the ``spans`` of their texts; ``count_col``, where there is one, follows. Documents
    with nothing but white space left go; those without spans are as they were. Of a repeated id, the rows with
    the least text have its spans; its other rows stay whole."""
    ref, cuts, text_of = (unused(n, docs.columns) for n in ("_id", "_cut", "_least"))
    cut = spans.groupBy(F.col(id_col).alias(ref)).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(cuts))
    both = docs.join(cut, docs[id_col] == F.col(ref), "left").drop(ref)
    many = docs.groupBy(F.col(id_col).alias(ref)).agg(F.count("*").alias("count")).where(f"count > 1 and {ref} is not null").select(ref)
    if many.limit(1).count():
        least = docs.select(F.col(id_col).alias(ref), text_col).join(many, ref, "left_semi").groupBy(ref).agg(F.min(text_col).alias(text_of))
        both = both.join(least, both[id_col] == F.col(ref), "left").drop(ref)
        other = F.col(text_of).isNotNull() & ~F.col(text_of).eqNullSafe(F.col(text_col))
        both = both.withColumn(cuts, F.when(~other, F.col(cuts))).drop(text_of)
    places = docs.columns.index(text_col), docs.columns.index(count_col) if count_col in docs.columns else None
    return both.select(*docs.columns, cuts).mapInArrow(lean(_remaining(*places)), docs.schema)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repeated passages of all of ``documents``: one row per span to remove."""
    return repeated_spans(source(spark, sf_dir, "documents"))
