"""Personal data by bootstrapped contextual extraction.

Seeds are the spans of four base expressions (email, ip, card, phone). Every
seed, and every other token with a digit or an at sign, is an instance: its
text in lower case. Each place of an instance gives lexical patterns: its shape
(digits as 9, letters as a), and two contexts, the word before it and the word
after it, each with the instance's loose shape (at sign, letters, three dots,
few, some or many digits), so that another way of writing has the same ones.
Patterns and instances are the two sides of a graph that Spark scores in rounds:

* a pattern's confidence for a kind is the sum of its instances' scores over
  their number plus one, so that unknown instances and low support lower it;
* an instance that is no seed gets the mean confidence of its patterns;
* beside it, the best confidence of its contexts that at least ``CONTEXT`` seeds
  of the kind share. There only seeds and accepted instances count for a
  pattern, so that unknown ones don't lift each other.

Instances whose mean reaches ``ACCEPT`` for a kind, with a pattern that at least
``SUPPORT`` seeds share, or whose best context reaches it, are identifiers of
that kind wherever they occur. Base
spans stay as they are; added ones never overlap them.

Null and empty texts have no spans. Each row of ``docs`` gives one row; repeated
rows give equal rows. Places are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import Shared, id_filter, in_filter, source, unused
from .text import lean

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
ACCEPT = 0.75
SUPPORT = 5
CONTEXT = 10

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_MARK = re.compile(r"[0-9@]")
_WORD_END = re.compile(r"[\x20\x09-\x0D]|\Z")
_MORE = re.compile(r"(?:\x20(?=[(0-9])[0-9().-]+(?![^\x20\x09-\x0D.,;:!?]))*")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base expressions, leftmost and non-overlapping for each kind."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, 0, m.end()))
            done = m.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Tokens with a digit or an at sign, without the marks around them, that overlap no base span."""
    out, k, done = [], 0, 0
    order = sorted((s, e) for s, _, e in taken)
    while m := _MARK.search(text, done):
        s = max(done, *(text.rfind(c, done, m.start()) + 1 for c in " \t\n\v\f\r"))
        done = e = _MORE.match(text, _WORD_END.search(text, m.start()).start()).end()
        while s < e and not (text[s].isalnum() or text[s] in "(+"):
            s += 1
        while e > s and not text[e - 1].isalnum():
            e -= 1
        while k < len(order) and order[k][1] <= s:
            k += 1
        if s < e and not any(a < e and b > s for a, b in order[k:k + 4]):
            out.append((s, e))
    return out


def shape(s: str) -> str:
    return "".join("9" if "0" <= c <= "9" else "a" if c.isalpha() else c for c in s)


def loose(s: str) -> str:
    """What is left of a shape when separators, signs and exact lengths don't count."""
    if "@" in s:
        return "@"
    n = len(_digits(s))
    return ("a" if any(c.isalpha() for c in s) else "") + ("..." if s.count(".") == 3 else "") + "9" * (1 + (n > 3) + (n > 6))


def _hash(s: str) -> int:
    return int.from_bytes(hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def word_beside(text: str, at: int, step: int) -> str:
    """The whole word before (``step`` -1) or from (1) a place on, of any length, in lower case and without marks."""
    i = at if step > 0 else at - 1
    while 0 <= i < len(text) and text[i].isspace():
        i += step
    j = i
    while 0 <= j < len(text) and not text[j].isspace():
        j += step
    return (text[i:j] if step > 0 else text[j + 1:i + 1]).lower().strip(".,;:!?\"'()")


def patterns(text: str, start: int, end: int) -> list[int]:
    """Hashes of the lexical patterns of one place of an instance; odd for contexts of a word, even for others."""
    full = shape(text[start:end])
    part = loose(text[start:end])
    left, right = word_beside(text, start, -1), word_beside(text, end, 1)
    return [_hash(f"shape {full}") & ~1, *(_hash(f"{side} {word} {part}") & ~1 | bool(word) for side, word in (("left", left), ("right", right)))]


_OCC = T.StructType().add("kind", T.IntegerType()).add("start", T.IntegerType()).add("end", T.IntegerType()).add("inst", T.LongType()).add("patterns", T.ArrayType(T.LongType()))


def spans_text(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan(batches):
    """(id, two keys, hash of the base spans, their counts, places of instances) of each row."""
    for b in batches:
        counts, occ, sha = [[] for _ in KINDS], [], []
        for text in b.column(3).to_pylist():
            text = text or ""
            found = base_spans(text)
            sha.append(hashlib.sha256(spans_text(found).encode()).hexdigest())
            for k, c in enumerate(counts):
                c.append(sum(x[1] == k for x in found))
            places = [(k, s, e) for s, k, e in found] + [(-1, s, e) for s, e in candidates(text, found)]
            occ.append([{"kind": k, "start": s, "end": e, "inst": _hash(text[s:e].lower()), "patterns": patterns(text, s, e)} for k, s, e in places])
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("inst", pa.int64()), ("patterns", pa.list_(pa.int64()))]))
        yield pa.RecordBatch.from_arrays(
            [*b.columns[:3], pa.array(sha, pa.string()), *(pa.array(c, pa.int64()) for c in counts), pa.array(occ, kind)],
            [b.schema.names[0], "key", "key2", "base_sha256", *(f"n_{k}" for k in KINDS), "occ"])


def score_instances(occ: DataFrame, shared: Shared, rounds: int = ROUNDS, accept: float = ACCEPT, support: int = SUPPORT) -> DataFrame:
    """(inst, kind) of the instances that the graph's rounds accept.

    ``occ``: kind (-1: unknown), inst, patterns. Only patterns of at least one seed take part. The graph's
    tables hold distinct edges, so a pattern or an instance that is everywhere costs one row for each partner.
    """
    edges = occ.select("inst", "kind", F.explode("patterns").alias("pat")).groupBy("pat", "inst").agg(F.max("kind").alias("kind"))
    edges = shared.put(edges, "edges")
    known = edges.groupBy("pat").agg(F.count_if(F.col("kind") >= 0).alias("seeds"), F.count("*").alias("n")).where("seeds > 0 and n > seeds")
    open_ = edges.where("kind < 0").join(known, "pat").select("pat", "inst", "seeds", "n")
    open_ = shared.put(open_, "open")
    places = edges.where("kind < 0").groupBy("inst").agg(F.count("*").alias("deg"))
    sums = edges.where("kind >= 0").join(open_.select("pat").distinct(), "pat", "left_semi")
    seed = shared.put(sums.groupBy("pat", "kind").agg(F.count("*").cast("double").alias("seed_sum")), "seeds")
    sure = ((F.col("score") >= accept) & (F.col("seeds") >= support)) | (F.col("best") >= accept)
    score = None
    for _ in range(rounds):
        total = seed.withColumn("of_kind", F.col("seed_sum")).withColumn("sure_sum", F.col("seed_sum"))
        if score is not None:
            given = score.select("inst", "kind", "score", F.when(sure, F.greatest("score", "best")).otherwise(0.0).alias("sure"))
            more = open_.join(given, "inst").groupBy("pat", "kind").agg(F.sum("score").alias("more"), F.sum("sure").alias("sure"))
            own = F.coalesce("seed_sum", F.lit(0.0))
            total = seed.join(more, ["pat", "kind"], "full").select("pat", "kind", own.alias("of_kind"), *(
                (own + F.coalesce(x, F.lit(0.0))).alias(name) for x, name in (("more", "seed_sum"), ("sure", "sure_sum"))))
        context = (F.col("pat").bitwiseAND(F.lit(1)) == 1) & (F.col("of_kind") >= CONTEXT)
        hits = open_.join(total, "pat").groupBy("inst", "kind").agg(
            F.sum(F.col("seed_sum") / (F.col("n") + 1)).alias("conf"), F.max("seeds").alias("seeds"),
            F.max(F.when(context, F.col("sure_sum") / (F.col("n") + 1)).otherwise(0.0)).alias("best"))
        last = score
        score = shared.put(hits.join(places, "inst").select("inst", "kind", (F.col("conf") / F.col("deg")).alias("score"), "seeds", "best"), "scores")
        if last is not None:
            shared.drop(last)
    return score.where(sure).groupBy("inst").agg(F.max_by("kind", F.struct(F.greatest("score", "best"), -F.col("kind"))).alias("kind"))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(id_col, key, key2, base_sha256, a count for each kind, occ) of every row of ``docs``, a frame of ``with_key``,
    and (key, key2, added: array of start, kind, end) of the rows with added spans. ``occ`` has the base spans
    (kind 0 to 3) and the other instances (kind -1)."""
    shared = Shared(docs.sparkSession, "pii")
    key, key2 = docs.columns[-2:]
    rows = docs.select(id_col, F.col(key).alias("key"), F.col(key2).alias("key2"), F.col(text_col).cast("string").alias("text"))
    fields = T.StructType([*rows.schema[:3], T.StructField("base_sha256", T.StringType()),
                           *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS), T.StructField("occ", T.ArrayType(_OCC))])
    base = shared.put(rows.mapInArrow(lean(_scan), fields), "base")
    occ = base.select("key", "key2", F.explode("occ").alias("o")).select("key", "key2", "o.*")
    accepted = shared.put(score_instances(occ, shared), "accepted")
    added = occ.where("kind < 0").drop("kind", "patterns").join(accepted, "inst")
    added = added.groupBy("key", "key2").agg(F.sort_array(F.collect_set(F.struct("start", "kind", "end"))).alias("added"))
    return base, shared.put(added, "added")


def with_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with two 64-bit keys of id and text as its last columns, under names that it does not have."""
    first = unused("_key", docs.columns)
    second = unused("_key2", [*docs.columns, first])
    what = F.col(id_col), F.col(text_col)
    return docs.select("*", F.xxhash64(*what).alias(first), F.xxhash64(F.lit("key2"), *what, F.length(text_col)).alias(second))


def _redact(text: str, spans) -> str:
    out, at = [], 0
    for s, k, e in sorted(spans):
        if s < at:
            at = max(at, e)
            continue
        out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = e
    return "".join([*out, text[at:]])


def _redacted(text_col: str, count_col: str | None, bits, inside: bool, width: int):
    """Rows of ``width`` columns, and two keys, with their spans replaced; those in the filter (``inside``) come
    with added spans as the last column."""
    def run(batches):
        for b in batches:
            names = b.schema.names[:width]
            if not inside:
                b = b.filter(pa.array(~in_filter(bits.value, b.column(width).to_numpy())))
            texts = b.column(names.index(text_col)).to_pylist()
            added = b.column(b.num_columns - 1).to_pylist() if inside else [None] * len(texts)
            new = []
            for t, a in zip(texts, added):
                spans = base_spans(t or "") + [(x["start"], x["kind"], x["end"]) for x in a or []]
                new.append(_redact(t, spans) if spans else t)
            cols = []
            for n, c in zip(names, b.columns[:width]):
                if n == text_col:
                    cols.append(pa.array(new, c.type))
                elif n == count_col:
                    cols.append(pa.array([x if t == u else len(u) for x, t, u in zip(c.to_pylist(), texts, new)], c.type))
                else:
                    cols.append(c)
            yield pa.RecordBatch.from_arrays(cols, names)
    return lean(run)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str = "n_chars") -> DataFrame:
    """``docs`` with every base and added span replaced by its kind, as in [EMAIL]; ``count_col``, where there
    is one, follows the text. Only rows that may have added spans are shuffled."""
    keyed = with_key(docs, id_col, text_col)
    width, (key, key2) = len(docs.columns), keyed.columns[-2:]
    _, added = find_pii(keyed, id_col, text_col)
    bits = docs.sparkSession.sparkContext.broadcast(id_filter(added, "key"))
    count = count_col if count_col in docs.columns else None
    plain = keyed.mapInArrow(_redacted(text_col, count, bits, False, width), docs.schema)

    def some(batches):
        for b in batches:
            yield b.filter(pa.array(in_filter(bits.value, b.column(width).to_numpy())))

    spans = unused("added", keyed.columns)
    added = added.select(F.col("key").alias(key), F.col("key2").alias(key2), F.col("added").alias(spans))
    few = keyed.mapInArrow(lean(some), keyed.schema).join(added, [key, key2], "left")
    return plain.union(few.select(*docs.columns, key, key2, spans).mapInArrow(_redacted(text_col, count, bits, True, width), docs.schema))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and added spans of all of ``documents``."""
    base, added = find_pii(with_key(source(spark, sf_dir, "documents").select("doc_id", "text")))
    own = F.transform(F.filter("occ", lambda o: o["kind"] >= 0), lambda o: F.struct(o["start"].alias("start"), o["kind"].alias("kind"), o["end"].alias("end")))
    name = lambda k: F.get(F.array(*map(F.lit, KINDS)), k)
    text = lambda o: F.concat_ws(":", name(o["kind"]), o["start"].cast("string"), o["end"].cast("string"))
    all_ = F.sort_array(F.when(F.col("added").isNull(), own).otherwise(F.concat(own, "added")))
    return base.join(added, ["key", "key2"], "left").select(
        "doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", F.array_join(F.transform(all_, text), ",").alias("spans"),
        F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_added"))
