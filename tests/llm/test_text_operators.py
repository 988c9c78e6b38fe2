import base64
import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyspark.llm import byte_bpe, packing, pii, toxicity
from surveyspark.llm.quality_rules import op10_quality_rules, quality_rules
from surveyspark.llm.tables import Shared, source

from .data import SF, WORD, table

public_tokenizers = pytest.importorskip("public_tokenizers")
BYTE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "  a", "don't we'll I'VE 's's ''re", "a\n\n b\t\tc ", "é ￿ 한글 👍½", "'", "x" * 5000, "12,345 abc!!  \n", "\x85 　z\x1c"]


# --- PII

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(t) if 12 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 9 <= len(digits(m.group())) <= 15]
    return sorted(out)


def test_base_spans_match_the_expressions():
    r = random.Random(1)
    for _ in range(4000):
        t = "".join(r.choice("a1.@+- (9)0\n2é") for _ in range(r.randint(0, 60)))
        assert pii.base_spans(t) == plain_spans(t)


def test_base_spans_of_long_runs_are_quick():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "a@" * 100_000, "+1" * 100_000, "0" * 6000 + ".1.1.1"):
        pii.base_spans(t)
        pii.candidates(t, [])


def test_op2_on_the_given_table(spark):
    got = {x.doc_id: x for x in pii.op2_pii(spark, SF).collect()}
    rows = table("documents")
    assert len(got) == len(rows)
    for r in rows:
        base = plain_spans(r["text"] or "")
        x = got[r["doc_id"]]
        assert x.base_sha256 == hashlib.sha256(pii.spans_text(base).encode()).hexdigest()
        assert [x.n_email, x.n_ip, x.n_card, x.n_phone] == [sum(s[1] == k for s in base) for k in range(4)]
        assert set(pii.spans_text(base).split(",")) <= set(x.spans.split(","))


def test_context_finds_unseen_identifiers_only(spark):
    r = random.Random(2)
    card = lambda: next(s for s in iter(lambda: "".join(r.choice("0123456789") for _ in range(16)), 0) if pii.luhn(s))
    rows = [(i, f"word card {card()} holder and some more {r.randint(1, 999)} words") for i in range(60)]
    wrong = [(100 + i, f"word card 4000 1234567890{i} holder", ) for i in range(0)]
    rows += wrong + [(200, "word card 1234567890123456 holder says"), (201, "the year 1987 was long"), (202, None), (203, ""), (204, "clean text only")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    base, added = pii.find_pii(pii.with_key(docs))
    ids = {x.key: x.doc_id for x in base.collect()}
    found = {ids[x.key]: x.added for x in added.collect()}
    assert set(found) == {200}
    (s,) = found[200]
    assert (rows[-5][1][s.start:s.end], s.kind) == ("1234567890123456", 2)
    out = {x.doc_id: x.text for x in pii.redact(docs).collect()}
    assert out[200] == "word card [CARD] holder says" and out[201] == "the year 1987 was long" and out[202] is None and out[204] == "clean text only"
    assert all("[CARD]" in out[i] for i in range(60))


def test_one_sided_and_plus_less_contexts_find_unseen_identifiers(spark):
    r = random.Random(12)
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(7))
    rows = []
    for i in range(40):  # each beside a word of its own on the other side
        rows.append(f"{word()} call +1 555 {digits(3)} {digits(4)} {word()}")
        rows.append(f"{word()} {word()}{i}@{word()}.org wrote {word()}")
        rows.append(f"{word()} host 10.{r.randint(0, 255)}.{r.randint(0, 255)}.{i} {word()}")
        rows.append(f"{word()} {word()} {digits(9)} {word()} and the {r.randint(1000, 2000)} of {word()} or {digits(3)}")
    n = len(rows)
    rows += ["we call 5551234567 today", "please call 555-123-4568", "name@host wrote this", "see host 10.0.300.1 again", "call 4711 now", "room 303 wrote", "the order 555123456789 came"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    base, added = pii.find_pii(pii.with_key(docs))
    ids = {x.key: x.doc_id for x in base.collect()}
    found = {ids[x.key]: [(rows[ids[x.key]][s.start:s.end], s.kind) for s in x.added] for x in added.collect()}
    assert found == {n: [("5551234567", 3)], n + 1: [("555-123-4568", 3)], n + 2: [("name@host", 0)], n + 3: [("10.0.300.1", 1)]}
    out = {x.doc_id: x.text for x in pii.redact(docs).collect()}
    assert out[n] == "we call [PHONE] today" and out[n + 2] == "[EMAIL] wrote this" and out[n + 4] == rows[n + 4]


def plain_scores(occ, rounds, accept, support, context):
    """{instance: kind} that the pattern-instance graph accepts, in plain Python."""
    kind = {}
    for k, inst, pats in occ:
        for p in pats:
            kind[p, inst] = max(kind.get((p, inst), -1), k)
    insts = defaultdict(dict)
    for (p, i), k in kind.items():
        insts[p][i] = k
    count = {p: Counter(k for k in by.values() if k >= 0) for p, by in insts.items()}
    deg = Counter(i for (_, i), k in kind.items() if k < 0)
    score = {}
    for _ in range(rounds):
        conf, best, seeds = defaultdict(float), defaultdict(float), defaultdict(int)
        for p, by in insts.items():
            unknown = [i for i, k in by.items() if k < 0]
            if not unknown or not count[p]:
                continue
            for k in range(4):
                rows = [score[i, k] for i in unknown if (i, k) in score]
                if not count[p][k] and not rows:
                    continue
                given = count[p][k] + sum(s for s, _, _ in rows)
                sure = count[p][k] + sum(max(s, b) for s, b, ok in rows if ok)
                for i in unknown:
                    conf[i, k] += given / (len(by) + 1)
                    seeds[i, k] = max(seeds[i, k], sum(count[p].values()))
                    if p % 2 and count[p][k] >= context:
                        best[i, k] = max(best[i, k], sure / (len(by) + 1))
        score = {}
        for (i, k), c in conf.items():
            mean, one = c / deg[i], best[i, k]
            score[i, k] = mean, one, mean >= accept and seeds[i, k] >= support or one >= accept
    out = {}
    for (i, k), (mean, one, ok) in score.items():
        if ok:
            out[i] = max(out.get(i, (0.0, -9)), (max(mean, one), -k))
    return {i: -k for i, (_, k) in out.items()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_graph_scores_match_plain_python(spark, monkeypatch, seed):
    monkeypatch.setattr(pii, "CONTEXT", 4)
    r = random.Random(seed)
    mostly = [r.choice((0, 1, 2, 3, -1)) for _ in range(30)]  # what kind of instance a pattern stands beside
    occ = []
    for inst in range(400):
        at = r.randrange(30)
        k = mostly[at] if r.random() < 0.6 else -1 if r.random() < 0.7 else r.randrange(4)
        for _ in range(r.randint(1, 2)):
            occ.append((k if r.random() < 0.95 else -1, inst, [at, *(r.choice((at, r.randrange(30))) for _ in range(2))]))
    docs = spark.createDataFrame(occ, "kind int, inst long, patterns array<long>")
    for accept in (0.3, 0.45, 0.6):
        want = plain_scores(occ, 3, accept, 3, 4)
        got = {x.inst: x.kind for x in pii.score_instances(docs, Shared(spark, "pii-test"), 3, accept, 3).collect()}
        assert got == want
        assert want or accept > 0.5


def test_pii_odd_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find_pii(pii.with_key(docs))[0].count() == 0 and pii.redact(docs).count() == 0
    rows = [(1, "a@b.cd", 1, "k"), (1, "a@b.cd", 1, "k"), (None, None, 2, "k")]
    out = pii.redact(spark.createDataFrame(rows, "doc_id long, text string, n_chars int, key string")).collect()
    assert sorted((str(x.text), x.n_chars, x.key) for x in out) == [("None", 2, "k"), ("[EMAIL]", 7, "k"), ("[EMAIL]", 7, "k")]


# --- toxicity

def _toxic_rows(n=600, seed=3):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    bad, out = ["zorkan", "zorkel", "zorkum", "quixnab"], []
    for i in range(n):
        toxic, poor = int(r.random() < 0.2), int(r.random() < 0.2)
        w = [r.choice(words) for _ in range(r.randint(10, 80))]
        if toxic:
            w[r.randrange(len(w))] = r.choice(bad)
            w[r.randrange(len(w))] = r.choice(bad)
        if poor:
            w = [x + "%%%" for x in w]
        out.append((i, " ".join(w), 1 - poor, int(any(b in x for x in w for b in ("zork", "quix")))))
    return out


def test_chain_is_accurate_on_held_out_rows(spark):
    rows = _toxic_rows()
    docs = spark.createDataFrame([(i, t, "kept", -1.0) for i, t, _, _ in rows] + [(9000, None, "kept", -1.0), (9001, "", "kept", -1.0)], "doc_id long, text string, lang string, p_toxic double")
    labels = spark.createDataFrame([(i, q, t) for i, _, q, t in rows[:400]] + [(0, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    scored, model = toxicity.toxicity_chain(docs, labels, toxicity.label_categories(), "toxic")
    got = {x.doc_id: x for x in scored.collect()}
    assert len(got) == 602 and scored.columns == ["doc_id", "text", "lang", "p_low_quality", "p_toxic", "rejected"]
    held = rows[400:]
    assert sum(got[i].rejected == bool(t) for i, _, _, t in held) >= 0.97 * len(held)
    assert len(model["chain"][1]) == 1 and not got[9000].rejected and got[9000].p_toxic == got[9001].p_toxic


def _dense_fit(x, y):
    """L1 logistic regression on a dense matrix, run until the conditions of an optimum hold."""
    n = len(y)
    scale = 1 / np.sqrt(np.maximum((x ** 2).mean(0), 1e-12))
    z = np.column_stack([x * scale, np.ones(n)])
    rate, l1 = 4 * n / np.linalg.norm(z, 2) ** 2, np.append(np.full(x.shape[1], toxicity.L1 / n ** 0.5), 0.0)
    w = v = np.zeros(len(l1))
    t = 1.0
    for step in range(20_000):
        g = z.T @ (1 / (1 + np.exp(-z @ v)) - y) / n
        new = v - rate * g
        new = np.sign(new) * np.maximum(np.abs(new) - rate * l1, 0)
        t, last = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        w, v = new, new + (last - 1) / t * (new - w)
        if step % 500 == 499:
            g = z.T @ (1 / (1 + np.exp(-z @ w)) - y) / n
            if np.abs(np.where(w != 0, g + l1 * np.sign(w), np.maximum(np.abs(g) - l1, 0))).max() < 1e-6:
                break
    return w[:-1] * scale, w[-1]


def test_chain_matches_a_plain_version(monkeypatch):
    """Counts, chi-square choice, folds, out-of-fold logits and scores, by loops and dense matrices; both fits
    run to their optimum here, the operator's own steps stop earlier."""
    stop_early = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda x, y: stop_early(x, y, steps=8000))
    rows = _toxic_rows(160, seed=8)
    texts, ids = [t for _, t, _, _ in rows], [i for i, _, _, _ in rows]
    y = np.array([[1 - q, t] for _, _, q, t in rows], float)
    model = toxicity.train_chain(iter(texts), ids, y.astype(int))
    grams = [Counter(g for w in set(t.lower().split()) for g in set(toxicity.grams(w))) for t in texts]
    fold = np.array([zlib.crc32(str(i).encode()) % toxicity.FOLDS for i in ids])
    earlier, logits = [], []
    for c in range(2):
        found = []
        for g in sorted({g for x in grams for g in x}):
            has = np.array([g in x for x in grams])
            n, df, a, n1 = len(y), has.sum(), y[has, c].sum(), y[:, c].sum()
            if df >= 5 and df < n and a * n > df * n1:
                table = np.array([[a, df - a], [n1 - a, n - n1 - df + a]])
                expect = np.outer(table.sum(1), table.sum(0)) / n
                found.append((-round(((table - expect) ** 2 / expect).sum(), 9), g))
        chosen = [g for _, g in sorted(found)[:toxicity.MAX_FEATURES]]
        x = np.array([[g_[g] for g in chosen] for g_ in grams], float)
        x = np.column_stack([x, *(e / 10 for e in earlier)])
        assert {g for g, w in model["weights"].items() if w[c]} <= set(chosen)
        out = np.zeros(len(y))
        for f in range(toxicity.FOLDS):
            w, b = _dense_fit(x[fold != f], y[fold != f, c])
            out[fold == f] = x[fold == f] @ w + b
        w, b = _dense_fit(x, y[:, c])
        own = [sum(g_[g] * model["weights"][g][c] for g in g_ if g in model["weights"]) + model["bias"][c] for g_ in grams]
        own = np.array(own) + sum(v * np.clip(e, -20, 20) for v, e in zip(model["chain"][c], earlier))
        assert np.abs(own - (x @ w + b)).max() < 0.1
        cut = toxicity.best_cut(1 / (1 + np.exp(-out)), y[:, c])
        assert abs(model["cut"][c] - cut) < 0.02
        earlier.append(np.clip(out, -20, 20))


def test_the_driver_gets_the_counts_of_chosen_features_only(spark, monkeypatch):
    """The model is the one of the whole texts; the memory of the driver's Python does not grow with their words."""
    r = random.Random(5)
    rows = [(i, f"{t} {' '.join(f'{r.getrandbits(40):x}' for _ in range(300))}", q, y) for i, t, q, y in _toxic_rows(500)]
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, t) for i, _, q, t in rows], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(toxicity, "MAX_FEATURES", 40)
    monkeypatch.setattr(toxicity, "_CACHE", 1000)
    seen, plain = [], toxicity.train_chain
    monkeypatch.setattr(toxicity, "train_chain", lambda texts, ids, y: seen.append((texts, ids, y)) or plain(texts, ids, y))
    tracemalloc.start()
    _, model = toxicity.toxicity_chain(docs, labels, toxicity.label_categories(), "toxic")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6
    (names, x), ids, y = seen[0]
    assert ids == [i for i, _, _, _ in rows] and y.tolist() == [[1 - q, t] for _, _, q, t in rows]
    assert 40 <= len(names) <= 80 and x.shape == (500, len(names))
    want = plain((t for _, t, _, _ in rows), ids, y)
    assert model["weights"].keys() == want["weights"].keys()
    assert all(np.allclose(model["weights"][g], w, atol=1e-6) for g, w in want["weights"].items())
    assert np.allclose(model["bias"], want["bias"]) and np.allclose(model["cut"], want["cut"]) and np.allclose(model["chain"][1], want["chain"][1])


def test_long_texts_are_scored_but_do_not_train(spark, monkeypatch):
    rows = _toxic_rows(400)
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows] + [(9000, "zorkan " * 2000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, t) for i, _, q, t in rows] + [(9000, 1, 0)], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(toxicity, "MAX_TRAIN_CHARS", 10_000)
    seen = []
    plain = toxicity.train_chain
    monkeypatch.setattr(toxicity, "train_chain", lambda texts, ids, y: seen.extend(ids) or plain(texts, ids, y))
    scored, _ = toxicity.toxicity_chain(docs, labels, toxicity.label_categories(), "toxic")
    assert len(seen) == 400 and 9000 not in seen and scored.where("doc_id = 9000 and rejected").count() == 1


def test_chain_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    scored, _ = toxicity.toxicity_chain(docs, none, toxicity.label_categories(), "toxic")
    assert [x.rejected for x in scored.collect()] == [False] * 3
    scored, _ = toxicity.toxicity_chain(docs.limit(0), none, toxicity.label_categories(), "toxic")
    assert scored.count() == 0


def test_op3_on_the_given_table(spark):
    assert toxicity.op3_toxicity(spark, SF).count() == len(table("documents"))


# --- byte-level BPE

def _tiktoken():
    tiktoken = pytest.importorskip("tiktoken")
    with open(BYTE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_matches_tiktoken():
    enc, bpe, r = _tiktoken(), byte_bpe.coder(BYTE), random.Random(3)
    parts = ["a", "B", "'", "s", "re", "ll", "'ve", "'d", " ", "  ", "\t", "\n", "\x1c", "\x85", "é", "ß", "1", "٣", "!", "<|endoftext|>", "한글", "👍", "½"]
    texts = ODD + ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(3000)] + ["ab" * 2000, " " * 3000]
    for run in byte_bpe._runs(texts):
        for t, ids in zip(run, bpe.encode(run)):
            assert np.frombuffer(ids, "<u4").tolist() == enc.encode_ordinary(t)
            assert bpe.decode(ids) == t.encode()


def test_byte_bpe_round_trip_with_offsets(spark):
    docs = spark.createDataFrame([*enumerate(ODD), (99, None)], "doc_id long, text string")
    tokens = byte_bpe.encode(docs, BYTE)
    back = {x.doc_id: x for x in byte_bpe.decode(tokens, BYTE).collect()}
    bpe = byte_bpe.coder(BYTE)
    for i, t in [*enumerate(ODD), (99, "")]:
        assert back[i].text == t
        data = t.encode()
        ends = [*back[i].offsets[1:], len(data)]
        assert [data[a:b] for a, b in zip(back[i].offsets, ends)] == [bpe.bytes_of[k] for k in back[i].ids]
    assert byte_bpe.encode(docs.limit(0), BYTE).count() == 0


def test_op5_on_the_given_table(spark):
    enc = _tiktoken()
    got = {x.doc_id: x for x in byte_bpe.op5_byte_bpe(spark, SF).collect()}
    for r in table("documents"):
        ids = enc.encode_ordinary(r["text"] or "")
        x = got[r["doc_id"]]
        assert (x.n_tokens, x.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert x.decoded_sha256 == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_whole_words_are_contexts():
    text = "x" * 50 + "shared 12-34 " + "next" * 30 + " end"
    at = text.index("12-34")
    assert pii.word_beside(text, at, -1) == "x" * 50 + "shared" and pii.word_beside(text, at + 5, 1) == "next" * 30
    other = "y" * 50 + text[50:]
    assert pii.patterns(text, at, at + 5)[1] != pii.patterns(other, at, at + 5)[1]
    assert pii.word_beside("", 0, 1) == pii.word_beside("a", 0, -1) == pii.word_beside("  a", 2, -1) == ""


def test_redact_with_columns_of_the_same_names(spark):
    rows = [(1, "mail to a.b@example.org now", 5, "k", [1]), (1, "mail to a.b@example.org now", 5, "k", [1]), (2, None, 6, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key int, added string, key array<int>")
    got = pii.redact(docs)
    assert got.columns == docs.columns
    want = [(1, "mail to [EMAIL] now", 5, "k", [1])] * 2 + [(2, None, 6, None, None)]
    assert sorted(str(tuple(x)) for x in got.collect()) == sorted(map(str, want))


def test_decode_replaces_a_text_column(spark):
    docs = spark.createDataFrame([(1, "héllo wörld"), (2, None), (1, "héllo wörld")], "doc_id long, text string")
    tokens = byte_bpe.encode(docs, BYTE).withColumn("text", F.lit("old"))
    assert sorted((x.doc_id, x.text) for x in byte_bpe.decode(tokens, BYTE).collect()) == [(1, "héllo wörld"), (1, "héllo wörld"), (2, "")]


def test_classes_of_all_code_points_are_the_librarys():
    import tiktoken

    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    table = byte_bpe.class_table()
    for name, kind in (("L", byte_bpe.LETTER), ("N", byte_bpe.NUMBER)):
        one = tiktoken.Encoding(name, pat_str=rf"\p{{{name}}}", mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        theirs = [c for c, ids in zip(points, one.encode_ordinary_batch([chr(c) for c in points])) if ids]
        assert theirs == [c for c in points if table[c] == kind]


# --- packing

def plain_tokenizer():
    """As loaded, not touched by the code."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


def test_word_cache_matches_the_tokenizer():
    words, r, tokenizer = packing.WordCache(WORDS), random.Random(5), plain_tokenizer()
    texts = ODD + ["".join(r.choice("aB'sΣς \t\n\r\x0b\x1c  é́İß1٣²!<|>endoftext　ﬁ한") for _ in range(r.randint(0, 25))) for _ in range(2000)]
    for t, ids in zip(texts, words.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids
    marks = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "<|", "|>", "İ.", "Σ.", "ΑΣ.", "ŉ,", "ẞ.", " ", "\n", "a", "B", "é,", "q" * 600]
    texts += ["".join(r.choice(marks) for _ in range(r.randint(0, 8))) for _ in range(5000)]
    for t, ids in zip(texts, words.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids
    assert all(len(p) <= packing._LONG for p in words.new)
    small = packing.WordCache(WORDS)
    packing._CACHE, before = 20, packing._CACHE
    try:
        assert [small.encode([t])[0] for t in texts[:300]] == words.encode(texts[:300])
    finally:
        packing._CACHE = before


def test_best_fit_and_bound():
    r = np.random.default_rng(1)
    for _ in range(60):
        size = int(r.integers(5, 60))
        lengths = r.integers(1, size + 1, int(r.integers(1, 40)))
        bins, offsets = packing.best_fit_decreasing(lengths, size)
        made = bins.max() + 1
        fill = np.bincount(bins, lengths)
        assert fill.max() <= size and made >= packing.lower_bound(lengths, size) >= -(-lengths.sum() // size)
        for b in range(made):
            o = np.sort(offsets[bins == b])
            order = np.argsort(offsets[bins == b])
            assert (o == np.concatenate([[0], np.cumsum(lengths[bins == b][order])[:-1]])).all()
    assert packing.lower_bound(np.array([51, 51, 51]), 100) == 3 and packing.lower_bound(np.array([34] * 6), 100) == 3


def check_packing(rows, texts, size):
    by = Counter()
    tokenizer = plain_tokenizer()
    for i, t in texts:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for k in range(0, len(ids), size):
            cut = ids[k:k + size]
            by[(i, k // size, k, len(cut), zlib.crc32(cut.tobytes()))] += 1
    assert by == Counter((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in rows)
    seqs = {}
    for x in rows:
        seqs.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= size
    return len(seqs), -(-sum(x.length for x in rows) // size)


def test_packing_is_tight_over_groups(spark):
    texts = [(r["doc_id"], r["text"]) for r in table("documents")] + [(5, "same id"), (5, "same id"), (7000, None), (7001, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = packing.pack(docs, WORDS, size=512, group=60).collect()
    made, _ = check_packing(rows, texts, 512)
    assert made <= 1.02 * packing.lower_bound(np.array([x.length for x in rows]), 512)
    assert packing.pack(docs.limit(0), WORDS).count() == 0


def test_packing_goes_on_while_the_total_shrinks(spark, monkeypatch):
    calls = []

    def slow(size, fields):  # round c joins c pairs of a group, up to six
        calls.append(size)
        c = min(len(calls), 6)

        def run(pdf):
            i = np.arange(len(pdf))
            second = (i < 2 * c) & (i % 2 == 1)
            bins = np.cumsum(~second) - 1
            length = pdf["length"].to_numpy()
            return pdf.assign(bin=bins, offset=np.where(second, np.roll(length, 1), 0), fill=np.bincount(bins, length).astype(np.int64)[bins], gap=1)[fields]
        return run

    monkeypatch.setattr(packing, "_pack", slow)
    texts = [(i, "a a a") for i in range(100)]
    rows = packing.pack(spark.createDataFrame(texts, "doc_id long, text string"), WORDS, size=100, group=50).collect()
    made, _ = check_packing(rows, texts, 100)
    assert (made, len(calls)) == (100 - 2 * 6, 7)


def test_op8_on_the_given_table(spark):
    texts = [(r["doc_id"], r["text"]) for r in table("documents")]
    made, least = check_packing(packing.op8_best_fit_packing(spark, SF).collect(), texts, 4096)
    assert made <= least + 1


# --- quality rules

def plain_quality(t):
    t = t or ""
    w = WORD.findall(t)
    g = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    c = Counter(g)
    cov = {i + d for i, x in enumerate(g) if c[x] > 1 for d in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(t.count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(cov), len(w) < 50 or 100 * len(cov) > 50 * len(w))


def test_quality_counts_match_plain_python(spark):
    texts = [None, *ODD, "a b c a b c", "a a a a a", "l\nl\n \nl", "a b", "x " * 3000] + [r["text"] for r in table("documents")]
    docs = spark.createDataFrame([(i, t, None if i % 5 == 0 else "EN") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = quality_rules(docs).collect()
    assert len(got) == len(texts)
    for x in got:
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) == plain_quality(texts[x.doc_id]), x
        assert not (x.kept and x.base_failed)


def test_quality_distances_match_plain_python(spark):
    import math

    from surveyspark.llm.quality_rules import CLASSES, COMMON, MIN_CHARS, MIN_COMMON

    rows = [r for r in table("documents")]
    every = {w for v in COMMON.values() for w in v}
    low = lambda w: w.lower()
    ref = lambda r: r["lang"] if r["lang"] in COMMON else "other"
    kind = {c: k for k, v in CLASSES.items() for c in v}
    chars, words = {}, {}
    for r in rows:
        chars.setdefault(ref(r), Counter()).update(kind.get(c, "?") for c in r["text"])
        words.setdefault(ref(r), Counter()).update(w for w in map(low, WORD.findall(r["text"])) if w in every)

    def distance(p, q):
        if not sum(p.values()) or not sum(q.values()):
            return 0.0
        n, m = sum(p.values()), sum(q.values())
        f = lambda x, y: x * math.log2(2 * x / (x + y)) if x else 0.0
        return math.sqrt(max(0.0, sum(f(p[k] / n, q[k] / m) + f(q[k] / m, p[k] / n) for k in p.keys() | q.keys()) / 2))

    got = {x.doc_id: x for x in op10_quality_rules(spark, SF).collect()}
    for r in rows:
        c, w = Counter(kind.get(c, "?") for c in r["text"]), Counter(w for w in map(low, WORD.findall(r["text"])) if w in every)
        x = got[r["doc_id"]]
        assert (x.char_distance is None) == (len(r["text"]) < MIN_CHARS) and (x.word_distance is None) == (sum(w.values()) < MIN_COMMON)
        if x.char_distance is not None:
            assert x.char_distance == pytest.approx(distance(c, chars[ref(r)]), abs=1e-7)
        if x.word_distance is not None:
            assert x.word_distance == pytest.approx(distance(w, words[ref(r)]), abs=1e-7)


def test_quality_plan_has_no_python(spark):
    docs = source(spark, SF, "documents")
    plan = quality_rules(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert quality_rules(docs.limit(0)).count() == 0
