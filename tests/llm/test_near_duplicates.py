import numpy as np
import pytest

from pyspark.sql import functions as F

from surveyspark.llm import ngram_join, tables
from surveyspark.llm.graph import components
from surveyspark.llm.ngram_join import ngram_jaccard_components, op4_ngram_jaccard_join
from surveyspark.llm.substring_dedup import MIN_REPEAT, Paragraphs, _bands, op9_substring_dedup, remove_spans, repeated_spans, tune_bands
from surveyspark.llm.tables import Shared, id_filter, in_filter
from surveyspark.llm.text import Words, chunks

from .data import SF, WORD, LOWER, corpus, jaccard_components, sentence, table, union_find

SCHEMA = "doc_id long, text string"


def test_components_match_union_find(spark):
    r = np.random.default_rng(3)
    pairs = [tuple(map(int, p)) for p in r.integers(0, 300, (220, 2))] + [(1000, 1000 + i) for i in range(1, 60)] + [(2000 + i, 2001 + i) for i in range(40)]
    got = {x.id: x.component for x in components(spark.createDataFrame(pairs, "u long, v long"), Shared(spark, "t")).collect()}
    pairs = [p for p in pairs if p[0] != p[1]]
    assert got == union_find({i for p in pairs for i in p}, pairs)
    assert components(spark.createDataFrame([], "u long, v long"), Shared(spark, "t")).count() == 0


def test_stars_are_components_without_a_round(spark):
    for edges, tables_put in (([(9, 1), (1, 8), (7, 1), (5, 4)], 1), ([(3, 2), (2, 1)], 2), ([(3, 1), (3, 2)], 2)):
        shared = tables.Shared(spark, "t")
        got = {(r.id, r.component) for r in components(spark.createDataFrame(edges, "u long, v long"), shared).collect()}
        assert got == set(union_find({x for e in edges for x in e}, edges).items())
        assert shared.n == tables_put


def test_words_are_those_of_the_pattern():
    import pyarrow as pa

    texts = ["a B\tc", None, "", " x", "y ", "é ß\x1cq \x0b\x0cz", "tail", "head", "\n"]
    for limit in (1, 4, 1 << 20):
        seen = []
        for _, _, data, offs in chunks(pa.array(texts), limit):
            w = Words(data, offs)
            for a, b in zip(w.first, w.first[1:]):
                seen.append([bytes(data[s:e]).decode() for s, e in zip(w.start[a:b], w.end[a:b])])
        assert seen == [WORD.findall(t or "") for t in texts]
    data, offs = next(chunks(pa.array(["ABC abc aBc x"])))[2:]
    h = Words(data, offs).hash
    assert h[0] == h[1] == h[2] != h[3]


def test_join_matches_brute_force(spark):
    rows = corpus()
    got = ngram_jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == jaccard_components(rows)
    assert len(got) == len(rows)


@pytest.mark.parametrize("short,tile,frequent", [(2, 300, 2), (10 ** 6, 400_000, 10 ** 6)])
def test_join_is_the_same_by_tiles_and_by_pairs(spark, monkeypatch, short, tile, frequent):
    for name, value in (("SHORT", short), ("TILE", tile), ("FREQUENT", frequent)):
        monkeypatch.setattr(ngram_join, name, value)
    rows = corpus(2)
    got = ngram_jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == jaccard_components(rows)


def test_join_odd_tables(spark):
    assert ngram_jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0
    assert ngram_jaccard_components(spark.createDataFrame([(1, None), (2, ""), (3, " ")], SCHEMA)).count() == 3
    rows = [(1, "q w e r t y", 0), (1, "a b c d e f", 1), (2, "a b c d e f", 2), (None, "a b c d e f", 3), (1, "a b c d e f", 4)]
    got = ngram_jaccard_components(spark.createDataFrame(rows, "doc_id long, text string, row long")).collect()
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in got) == [(1, 2, 1), (2, 2, 1)]


def test_shingles_of_short_runs():
    import pyarrow as pa

    for n in range(8):
        sets = Words(*next(chunks(pa.array([" ".join("abcdefg"[:n])] * 2)))[2:]).sets(5)
        assert [len(s) for s in sets] == [max(n - 4, min(n, 1))] * 2 and (sets[0] == sets[1]).all()


@pytest.mark.parametrize("texts", [["a b c"], ["x " * 300_000, "a b c"], ["a b", "a b", "A b c", ""]])
def test_join_of_short_runs(spark, texts):
    rows = list(enumerate(texts))
    got = ngram_jaccard_components(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == jaccard_components(rows)


def test_no_column_of_near_copies_is_in_one_task(spark):
    """3,000 near copies: whole columns are only summed (before the shuffle) or met by broadcast."""
    import random

    r = random.Random(5)
    base, rows = sentence(r, 200).split(), []
    for i in range(3000):
        w = base[:]
        w[r.randrange(200)] = sentence(r, 1)
        rows.append((i, " ".join(w)))
    rows += [(5000 + i, sentence(r, 30)) for i in range(50)]
    got = {x.doc_id: x.component_id for x in ngram_jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {got[i] for i in range(3000)} == {0} and all(got[i] == i for i in range(5000, 5050))


def test_spread_join_broadcasts_heavy_keys_only(spark, monkeypatch):
    monkeypatch.setattr(tables, "HEAVY", 8)
    left = spark.createDataFrame([(0, i) for i in range(600)] + [(1 + i % 200, i) for i in range(600)], "k long, x long")
    right = left.groupBy("k").agg(F.count("*").alias("c"), F.sum("x").alias("s")).where("k <> 7")
    got = tables.spread_join(left, right, "k", "c", left.count())
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, left.join(right.drop("c"), "k").collect()))
    keys = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in keys and "LeftAnti" in keys


def test_op4_on_the_given_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in table("documents")]
    got = op4_ngram_jaccard_join(spark, SF).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == jaccard_components(rows)


def test_id_filter_lets_all_ids_pass(spark):
    ids = np.array([0, 5, 2 ** 40 + 3, -7, 2 ** 62], np.int64)
    bits = id_filter(spark.createDataFrame([(int(i),) for i in ids], "id long"))
    assert in_filter(bits, ids).all() and not in_filter(bits, np.arange(100, 200)).any()


def test_bands_reach_their_recall():
    for t in (0.5, 0.75, 0.9):
        for recall in (0.9, 0.95, 0.99):
            r, b = tune_bands(t, recall)
            assert 1 - (1 - t ** r) ** b >= recall


def _windows(text, n=50):
    w = (text or "").translate(LOWER).split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def _repeated(rows):
    first, out = {}, {}
    for i, t in sorted(rows):
        for x in _windows(t):
            if x in first and first[x] != i:
                out.setdefault(i, first[x])
            first.setdefault(x, i)
    return out


def test_repeated_passages_go_and_clean_texts_stay(spark):
    rows = corpus(4)
    docs = spark.createDataFrame([(i, t, "en", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, n_chars long")
    spans = repeated_spans(docs)
    got, again = {x.doc_id for x in spans.collect()}, _repeated(rows)
    assert set(again) <= got
    text = dict(rows)
    for x in spans.collect():
        part = text[x.doc_id][x.start:x.end]
        assert part == part.strip() and len(part.split()) == x.n_words and x.kept_doc_id <= x.doc_id
    assert not got & set(range(40))  # random texts before their copies
    left = {x.doc_id: x for x in remove_spans(docs, spans).collect()}
    assert not _repeated([(i, x.text) for i, x in left.items()])
    assert all(x.n_chars == len(x.text or "") for x in left.values())
    assert all(left[i].text == text[i] for i in range(40)) and left[rows[-1][0]].text == rows[-1][1]


def test_near_equal_paragraph_is_found(spark):
    import random

    r = random.Random(8)
    w = sentence(r, 60).split()
    a = [" ".join(w[i:i + 20]) + "." for i in range(0, 60, 20)]
    b = [x.replace(" ", "  ") for x in a]
    b[0] = "New " + b[0]  # one more word in the first sentence
    rows = [(1, sentence(r, 30) + ".\n" + " ".join(a)), (2, sentence(r, 30) + ".\n" + " ".join(b)), (3, sentence(r, 90))]
    got = repeated_spans(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {x.doc_id for x in got} == {2} and sum(x.n_words for x in got) >= 40


def _inline(r, words, passage):
    at = r.randrange(len(words))
    return " ".join(words[:at] + passage + words[at:])


def test_cuts_of_a_passage_are_those_of_its_copies():
    import random

    import pyarrow as pa

    r = random.Random(21)
    words = [w for row in table("documents") for w in (row["text"] or "").split()]
    pick = lambda n: (lambda i: words[i:i + n])(r.randrange(len(words) - n))
    for trial in range(3000):
        n = 50 + trial % 11
        passage = pick(n) if trial % 50 else (pick(trial % 7 + 1) * n)[:n]  # some with few different words
        sets = []
        for _, _, data, offs in chunks(pa.array([_inline(r, pick(r.randint(20, 200)), passage) for _ in range(2)])):
            p = Paragraphs(data, offs)
            sets += [dict(zip(p.hash[p.doc == d].tolist(), (p.b - p.a)[p.doc == d].tolist())) for d in (0, 1)]
            again = [h in sets[0] for h in p.hash[p.doc == 1].tolist()]
            assert np.dot(again, (p.b - p.a)[p.doc == 1]) >= MIN_REPEAT


def test_passage_in_exactly_two_documents_is_found(spark):
    import random

    r = random.Random(22)
    rows = []
    for trial in range(300):
        passage = sentence(r, 51 + trial % 10).split()
        rows += [(2 * trial + i, _inline(r, sentence(r, r.randint(30, 300)).split(), passage)) for i in range(2)]
    spans = repeated_spans(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {x.doc_id for x in spans} == set(range(1, 600, 2)) and all(x.kept_doc_id == x.doc_id - 1 for x in spans)


@pytest.mark.parametrize("common", [8, 10, 11])
def test_near_equal_pairs_beside_a_frequent_phrase_are_found(spark, common):
    import random

    r = random.Random(common)
    phrase, rows = sentence(r, common), []
    for i in range(300):  # pairs that differ in the last word, and others with the same first words
        line = f"{phrase} {sentence(r, 13 - common)}".rstrip()
        rows += [(2 * i, f"{line} {sentence(r, 1)}"), (2 * i + 1, f"{line} {sentence(r, 1)}")]
    rows += [(1000 + i, f"{phrase} {sentence(r, 14 - common)}") for i in range(1000)]
    spans = repeated_spans(spark.createDataFrame(rows, SCHEMA), min_repeat=10).collect()
    kept = {x.doc_id: x.class_id for x in spans}
    assert len({i for i in range(1, 600, 2) if i in kept}) >= 0.95 * 300


def test_bands_of_a_frequent_paragraph_come_once_a_task():
    import random

    import pyarrow as pa

    r = random.Random(5)
    often, texts = sentence(r, 12), []
    for i in range(3000):
        texts += [sentence(r, 12), often] if i % 3 == 0 else [sentence(r, 12)]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(100)), pa.array(texts[i:i + 100])], ["id", "text"]) for i in range(0, len(texts), 100)]
    got = [x for b in _bands(5, 1, 3)(batches) for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
    data, offs = next(chunks(pa.array([often])))[2:]
    (hot,) = Paragraphs(data, offs).hash.view(np.int64).tolist()
    assert 3 <= sum(p == hot for _, p in got) <= 3 * 20
    assert len({p for _, p in got}) == 3001 and len(set(got)) == 3 * 3001


def test_substring_odd_tables(spark):
    assert repeated_spans(spark.createDataFrame([], SCHEMA)).count() == 0
    long = " ".join(f"w{i}" for i in range(80))
    rows = [(1, None), (2, ""), (3, " \n "), (4, long), (4, long), (None, long)]
    assert repeated_spans(spark.createDataFrame(rows, SCHEMA)).count() == 0
    docs = spark.createDataFrame(rows + [(9, long)], SCHEMA)
    spans = repeated_spans(docs)
    assert {x.doc_id for x in spans.collect()} == {9}
    assert sorted(str(x.doc_id) for x in remove_spans(docs, spans).collect()) == sorted(map(str, [1, 2, 3, 4, 4, None]))


def _in_document_repeats(text, n=50):
    """Whether ``n`` words in a row stand twice, apart from each other, in a text."""
    w = (text or "").translate(LOWER).split()
    first = {}
    for i in range(len(w) - n + 1):
        at = first.setdefault(tuple(w[i:i + n]), i)
        if i - at >= n:
            return True
    return False


def test_repeats_inside_a_document_go_but_for_the_first(spark):
    import random

    r = random.Random(12)
    passages = [sentence(r, 80) + "." for _ in range(30)]
    rows = [(i, f"{sentence(r, r.randint(0, 40))} {p} {sentence(r, r.randint(10, 60))} {p} {sentence(r, r.randint(0, 30))} {p if i % 3 == 0 else ''}") for i, p in enumerate(passages)]
    rows += [(100 + i, sentence(r, 300)) for i in range(30)] + [(200, f"{sentence(r, 20)} {passages[5]} {sentence(r, 20)}")]
    docs = spark.createDataFrame([(*x, "a", "b") for x in rows], "doc_id long, text string, _id string, _cut string")
    assert all(_in_document_repeats(t) for i, t in rows if i < 30)
    spans = repeated_spans(docs)
    found = spans.collect()
    assert {x.doc_id for x in found} == {*range(30), 200} and {x.kept_doc_id for x in found if x.doc_id == 200} == {5}
    left = {x.doc_id: x.text for x in remove_spans(docs, spans).collect()}
    text = dict(rows)
    for i, p in enumerate(passages):
        assert not _in_document_repeats(left[i]) and p in left[i]  # the first one is whole
        assert left[i].startswith(text[i][:text[i].index(p) + len(p)])
    assert all(left[i] == text[i] for i in range(100, 130)) and not _repeated([(i, t) for i, t in left.items()])


@pytest.mark.parametrize("short", [2, 10 ** 6])
def test_near_equal_paragraphs_by_tiles_and_by_pairs(spark, monkeypatch, short):
    import random

    from surveyspark.llm import substring_dedup

    monkeypatch.setattr(substring_dedup, "SHORT", short)
    r = random.Random(3)
    phrase, rows = sentence(r, 10), []
    for i in range(40):  # pairs that share more with each other than the phrase that all have
        w = f"{phrase} {sentence(r, 30)}".split()
        v = w[:]
        v[25] = sentence(r, 1)
        rows += [(2 * i, f"{sentence(r, 30)}\n{' '.join(w)}."), (2 * i + 1, f"{sentence(r, 30)}\n{' '.join(v)}.")]
    got = {x.doc_id for x in repeated_spans(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got <= set(range(1, 80, 2)) and len(got) >= 36


def test_other_texts_of_a_repeated_id_stay_whole(spark):
    import random

    r = random.Random(6)
    passage, other = "b " + sentence(r, 80), "z " + sentence(r, 120)
    docs = spark.createDataFrame([(1, passage), (2, passage), (2, other), (2, passage), (2, None), (3, other)], SCHEMA)
    left = sorted((x.doc_id, x.text or "") for x in remove_spans(docs, repeated_spans(docs)).collect())
    assert left == [(1, passage), (2, ""), (2, other), (3, other)]


def test_op9_on_the_given_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in table("documents")]
    assert set(_repeated(rows)) <= {x.doc_id for x in op9_substring_dedup(spark, SF).collect()}
