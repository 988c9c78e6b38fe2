"""Quality rules by distribution divergence, in DataFrame functions only.

Base counts of each text: words, characters in words, symbols, lines that
repeat an earlier one and words inside repeated three-word windows. The
verdict compares two histograms of a text with its language's reference: the
classes of its characters and its common words. References are sums over all
documents of the language, and the measure is the Jensen-Shannon distance (the
root of the divergence, base 2). A text shorter than a guard skips the
histogram that it is too short for.

Each row gives one row, repeated rows and rows without an id too; an empty
table gives an empty one. Other columns, whatever their names, are not read. A
text at a threshold passes: exactly 50 words, exactly half of the words in
repeated windows, a distance equal to its limit. Null texts count as empty. Languages other than those
of ``COMMON`` (and null) share one reference, so there are at most five.
Repeated windows are found by sorting a text's window hashes, so a very long
text costs n log n.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import Shared, source

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Common words by language.
COMMON = {
    "en": "the of and to in a is that it for on with as was at by be this from are".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par sur pas au avec".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
}
#: Character classes: lower case, upper case, digits, white space, marks, other ASCII; the rest is the last.
CLASSES = {
    "a": "abcdefghijklmnopqrstuvwxyz",
    "A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "0": "0123456789",
    " ": SPACES,
    ".": ".,;:!?'\"()-",
    "#": "#*$%&|<>@[]{}/\\=+_^~`",
}
MIN_CHARS = 200
MIN_COMMON = 30
MAX_CHAR_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.6


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, evaluated once however often the body's lambdas use it."""
    return F.get(F.transform(F.array(value), body), 0)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def repeated_lines(text: Column) -> Column:
    """The number of lines that hold a word and equal an earlier line."""
    inked = lambda lines: F.filter(lines, lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return let(F.split(text, "\n"), lambda x: let(F.array_distinct(x), lambda d: F.when(F.size(d) == F.size(x), F.lit(0)).otherwise(
        F.size(inked(x)) - F.size(inked(d)))))


def repeated_window_words(words: Column) -> Column:
    """The number of words inside three-word windows that the array holds twice or more."""
    def marked(s: Column) -> Column:
        same = lambda x, j: x["h"].eqNullSafe(F.get(s, j - 1)["h"]) | x["h"].eqNullSafe(F.get(s, j + 1)["h"])
        return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - i, F.lit(3)))), F.lit(0), lambda a, b: a + b)

    def of(w: Column) -> Column:
        hashes = F.slice(F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))), F.lit(1), F.size(w) - 2)
        placed = lambda h: F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(placed(h), lambda s: let(marked(s), covered))))

    return let(words, lambda w: F.when(F.size(w) < 3, F.lit(0)).otherwise(of(w)))


#: The characters that stand for the classes of CLASSES, and for SYMBOLS apart from their class.
SIGNS = [*CLASSES, "@"]


def by_class(text: Column) -> Column:
    """The text with one sign for all characters of a class; "#" is left for SYMBOLS, the rest of their class is "@"."""
    signs = {x: c for c, v in CLASSES.items() for x in v}
    signs |= {x: "#" if x in SYMBOLS else "@" for x in CLASSES["#"]}
    return F.translate(text, "".join(signs), "".join(signs.values()))


def sign_counts(signs: Column) -> Column:
    """Counts of SIGNS, and of all other characters."""
    def counts(t: Column, left: list[str], got: list[Column]) -> Column:
        if not left:
            return F.array(*got, F.length(t))
        return let(F.replace(t, F.lit(left[0]), F.lit("")), lambda rest: counts(rest, left[1:], [*got, F.length(t) - F.length(rest)]))

    return let(signs, lambda t: counts(t, SIGNS, []))


def common_counts(words: Column) -> Column:
    """(w, n) of the common words of any language in the array, by word."""
    every = sorted({w for v in COMMON.values() for w in v})
    kept = F.sort_array(F.transform(F.filter(words, lambda w: F.lower(w).isin(every)), F.lower))
    each = lambda s: let(F.array_distinct(s), lambda d: let(F.transform(d, lambda x: F.array_position(s, x)), lambda p: F.transform(
        d, lambda x, k: F.struct(x.alias("w"), (F.coalesce(F.get(p, k + 1), F.size(s) + 1) - F.get(p, k)).cast("int").alias("n")))))
    return let(kept, each)


def _js(p: Column, q: Column) -> Column:
    """A bin's share of twice the divergence."""
    part = lambda x: F.when(x > 0, x * F.log2(2 * x / (p + q))).otherwise(F.lit(0.0))
    return part(p) + part(q)


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda x, y: x + y)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_char: float = MAX_CHAR_DISTANCE,
                  max_word: float = MAX_WORD_DISTANCE) -> DataFrame:
    """(id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_distance, word_distance, kept);
    a distance is null where the text is under its guard or the language has no reference."""
    shared = Shared(docs.sparkSession, "quality")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lang = F.lower(F.col(lang_col).cast("string"))
    src = docs.select(F.col(id_col), text.alias("t"), F.when(lang.isin(list(COMMON)), lang).otherwise("other").alias("ref"))
    long = lambda c: c.cast("long")
    at = lambda sign: F.get("signs", F.lit(SIGNS.index(sign)))
    counted = src.select("*", F.length("t").alias("size"), words_of(F.col("t")).alias("w"), sign_counts(by_class(F.col("t"))).alias("signs"))
    stats = counted.select(
        id_col, "ref", long(F.size("w")).alias("n_words"),
        long(F.col("size") - at(" ")).alias("word_chars"),
        long(at("#")).alias("n_symbols"),
        long(repeated_lines(F.col("t"))).alias("n_dup_lines"),
        long(repeated_window_words(F.col("w"))).alias("n_repeat_words"),
        F.array(*(at(c) + at("@") if c == "#" else at(c) for c in CLASSES), F.get("signs", F.lit(len(SIGNS)))).alias("chars"),
        "size", common_counts(F.col("w")).alias("common"))
    stats = stats.withColumn("hits", F.aggregate("common", F.lit(0), lambda a, x: a + x["n"]))
    stats = shared.put(stats, "stats")

    n = len(CLASSES) + 1
    chars = stats.groupBy("ref").agg(*(F.sum(F.get("chars", F.lit(i))).cast("double").alias(f"c{i}") for i in range(n)))
    total = sum((F.col(f"c{i}") for i in range(1, n)), F.col("c0"))
    chars = chars.select("ref", F.when(total > 0, F.array(*(F.col(f"c{i}") / total for i in range(n)))).alias("cq"))
    common = stats.select("ref", F.explode("common").alias("x")).groupBy("ref", "x.w").agg(F.sum("x.n").cast("double").alias("n"))
    common = common.groupBy("ref").agg(F.map_from_entries(F.collect_list(F.struct("w", "n"))).alias("m"), F.sum("n").alias("s"))
    refs = chars.join(common, "ref", "left").select("ref", "cq", F.transform_values("m", lambda _, v: v / F.col("s")).alias("wq"))
    both = stats.join(F.broadcast(refs), "ref", "left")  # one row a language of COMMON, and one for all others

    size, hits = F.col("size"), F.col("hits")
    char_div = F.when(size >= MIN_CHARS, _sum(F.zip_with("chars", "cq", lambda c, q: _js(c / size, q))))
    inside = F.transform("common", lambda x: F.struct((x["n"] / hits).alias("p"), F.coalesce(F.try_element_at("wq", x["w"]), F.lit(0.0)).alias("q")))
    word_div = F.when(hits >= MIN_COMMON, let(inside, lambda s: _sum(F.transform(s, lambda x: _js(x["p"], x["q"]))) + 1 - _sum(F.transform(s, lambda x: x["q"]))))
    root = lambda d: let(d, lambda x: F.when(x.isNotNull(), F.sqrt(F.greatest(x / 2, F.lit(0.0)))))
    out = both.withColumn("char_distance", root(char_div)).withColumn("word_distance", root(word_div))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    near = (F.coalesce("char_distance", F.lit(0.0)) <= max_char) & (F.coalesce("word_distance", F.lit(0.0)) <= max_word)
    return out.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                      "char_distance", "word_distance", (~failed & near).alias("kept"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of every text of ``documents``; distances to nine places."""
    rules = quality_rules(source(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return rules.withColumns({c: F.round(c, 9) for c in ("char_distance", "word_distance")})


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def op10_sql() -> str:
    """The same in DuckDB's SQL."""
    every = ", ".join(_quoted(w) for w in sorted({w for v in COMMON.values() for w in v}))
    langs = ", ".join(map(_quoted, COMMON))
    marks = [v.replace("\n", "").replace("\x0b", "").replace("\x0c", "").replace("\r", "").replace("\t", "") for v in CLASSES.values()]
    space = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    sets = [space if k == " " else _quoted(m) for k, m in zip(CLASSES, marks)]
    n = len(CLASSES) + 1
    counts = ", ".join(f"length(t) - length(translate(t, {x}, '')) as c{i}" for i, x in enumerate(sets))
    js = lambda p, q: f"(case when {p} > 0 then {p} * log2(2 * {p} / ({p} + {q})) else 0 end + case when {q} > 0 then {q} * log2(2 * {q} / ({p} + {q})) else 0 end)"
    char_div = " + ".join(js(f"(c{i} / size)", f"q{i}") for i in range(n))
    return f"""
with t as (select doc_id, coalesce(text, '') as t, case when lower(lang) in ({langs}) then lower(lang) else 'other' end as ref from documents),
w as (select *, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from t),
wi as (select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as g from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from w)),
dup as (select doc_id, g from wi group by all having count(*) > 1),
cov as (select doc_id, count(distinct p) as n from (select wi.doc_id, unnest([i, i + 1, i + 2]) as p from wi join dup using (doc_id, g)) group by 1),
c0_ as (select doc_id, ref, length(t) as size, {counts} from t),
c as (select *, size - {" - ".join(f"c{i}" for i in range(n - 1))} as c{n - 1} from c0_),
q as (select ref, {", ".join(f"sum(c{i}) / sum(size) as q{i}" for i in range(n))} from c group by ref having sum(size) > 0),
cd as (select doc_id, case when size >= {MIN_CHARS} then sqrt(greatest(({char_div}) / 2, 0)) end as char_distance from c left join q using (ref)),
cw as (select doc_id, ref, x, count(*) as n from (select doc_id, ref, lower(unnest(ws)) as x from w) where x in ({every}) group by all),
rw as (select ref, x, sum(n) / sum(sum(n)) over (partition by ref) as q from cw group by ref, x),
hits as (select doc_id, sum(n) as hits from cw group by 1),
wd as (select doc_id, sqrt(greatest((sum({js("(n / hits)", "q")}) + 1 - sum(q)) / 2, 0)) as word_distance
  from cw join hits using (doc_id) join rw using (ref, x) where hits >= {MIN_COMMON} group by doc_id),
b as (select w.doc_id, len(ws) as n_words, length(translate(t, {space}, '')) as word_chars, length(t) - length(translate(t, {_quoted(SYMBOLS)}, '')) as n_symbols,
  len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(cov.n, 0) as n_repeat_words, char_distance, word_distance
  from w left join cov using (doc_id) left join cd using (doc_id) left join wd using (doc_id)),
v as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from b)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, round(char_distance, 9) as char_distance,
  round(word_distance, 9) as word_distance,
  not base_failed and coalesce(char_distance, 0) <= {MAX_CHAR_DISTANCE} and coalesce(word_distance, 0) <= {MAX_WORD_DISTANCE} as kept from v
"""
