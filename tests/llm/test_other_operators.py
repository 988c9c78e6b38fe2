import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from surveyspark.llm import html_extract as H
from surveyspark.llm.ann_forest import _best, _cosines, _rerank, nearest, op7_ann_forest
from surveyspark.llm.preference import assemble, op1_preference_format, preference_segments

from .data import SF, table


# --- preference formatting

TURNS = "pair_id long, turn long, role string, text string"


def render(role, text):
    return f"<|im_start|>{role or ''}\n{text or ''}<|im_end|>\n"


def test_preference_prompt_is_the_longest_common_prefix(spark):
    r = random.Random(1)
    chosen, rejected, want = [], [], {}
    for p in range(40):
        common = [(t, r.choice(["user", "assistant", "system"]), f"t{r.randint(0, 3)}") for t in range(r.randint(0, 5))]
        a = [(t, r.choice(["user", "assistant"]), f"a{r.randint(0, 1)}é") for t in range(len(common), len(common) + r.randint(0, 4))]
        b = [(t, r.choice(["user", "assistant"]), f"a{r.randint(0, 1)}é") for t in range(len(common), len(common) + r.randint(0, 4))]
        chosen += [(p, *x) for x in common + a]
        rejected += [(p, *x) for x in common + b]
        x, y = common + a, common + b
        n = next((i for i, (s, t) in enumerate(zip(x, y)) if s != t), min(len(x), len(y))) if x and y else 0
        if x or y:
            want[p] = ["".join(render(*t[1:]) for t in part) for part in (x[:n], x[n:], y[n:])]
    seg = preference_segments(spark.createDataFrame(chosen, TURNS), spark.createDataFrame(rejected, TURNS))
    got = {x.pair_id: x for x in assemble(seg).collect()}
    assert {p: [x.prompt, x.chosen, x.rejected] for p, x in got.items()} == want
    for x in got.values():
        for text, spans in ((x.chosen, x.chosen_loss), (x.rejected, x.rejected_loss)):
            assert all(text[:s.start].endswith("<|im_start|>assistant\n") and text[s.start:s.end].endswith("<|im_end|>\n") for s in spans)
            assert len(spans) == text.count("<|im_start|>assistant\n")


def test_preference_odd_rows(spark):
    a = [(1, 0, "user", "x"), (1, 0, "user", "x"), (1, None, "system", None), (1, 1, "assistant", ""), (2, 0, "user", "only"), (None, 0, "user", "no"), (3, 0, "u", "b"), (3, 0, "u", "a")]
    b = [(1, None, "system", None), (1, 0, "user", "x"), (1, 1, "assistant", None), (3, 0, "u", "a"), (3, 0, "u", "b")]
    seg = preference_segments(spark.createDataFrame(a, TURNS).withColumn("part", F.lit("mine")), spark.createDataFrame(b, TURNS))
    got = {x.pair_id: x for x in assemble(seg).collect()}
    assert set(got) == {1, 2, 3}
    assert got[1].prompt == render("system", "") + render("user", "x") and got[1].chosen == got[1].rejected == render("assistant", "")
    assert (got[2].prompt, got[2].chosen) == ("", render("user", "only")) and got[3].prompt == render("u", "a") + render("u", "b")
    assert [x.paired for x in seg.where("pair_id = 2").collect()] == [False]
    empty = spark.createDataFrame([], TURNS)
    assert preference_segments(empty, empty).count() == 0


def test_preference_places_of_a_long_conversation(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", "w" * (t % 7)) for t in range(3000)]
    seg = preference_segments(spark.createDataFrame(rows, TURNS), spark.createDataFrame(rows[:2000] + [(1, 2000, "user", "other")], TURNS)).collect()
    at = {"prompt": 0, "chosen": 0, "rejected": 0}
    for x in sorted(seg, key=lambda x: (x.part, x.turn)):
        assert x.start == at[x.part] and x.end == x.start + len(x.segment)
        at[x.part] = x.end
    assert sum(x.part == "prompt" for x in seg) == 2000 and sum(x.part == "chosen" for x in seg) == 1000


def test_op1_covers_every_row(spark):
    seg = op1_preference_format(spark, SF)
    rows = {(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table("conversations")}
    assert seg.where("part <> 'prompt'").count() + 2 * seg.where("part = 'prompt'").count() == len(rows)


# --- nearest neighbours

def plain_nearest(rows, query, k):
    ok = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in ok:
        if query(i):
            s = sorted((-float(v @ u) / (np.sqrt(v @ v) * np.sqrt(u @ u)), j) for j, u in ok if j != i)
            out[i] = [(j, -d) for d, j in s[:k]]
    return out


def test_forest_recall_and_scores(spark):
    r = np.random.default_rng(2)
    rows = [(i, r.normal(size=16).tolist()) for i in range(2500)]
    rows += [(5000 + i, rows[7][1]) for i in range(900)]  # one vector many times
    want = plain_nearest(rows, lambda i: i % 50 == 0, 5)
    got = {}
    for x in nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 50 == 0, share=0.4).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append((x.vec_id, x.score))
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    hit = sum(len({j for j, _ in want[q]} & {j for j, _ in got[q]}) for q in want)
    assert hit >= 0.9 * 5 * len(want)
    for q, found in got.items():
        all_ = {j: s for j, s in plain_nearest([rows[0], *rows], lambda i: i == q, 10 ** 6)[q]} if q < 300 else None
        if all_:
            assert all(abs(all_[j] - s) < 1e-9 for j, s in found)
        assert all(a[1] > b[1] or (a[1] == b[1] and a[0] < b[0]) for a, b in zip(found, found[1:]))


def test_forest_ties_go_to_the_smaller_ids(spark):
    r = np.random.default_rng(9)
    base = r.normal(size=(60, 96))
    rows = [(i, base[i % 60].tolist()) for i in range(1500)]  # 25 copies of each
    rows += [(2000 + i, (base[i % 60] * 2.0 ** (i // 60)).tolist()) for i in range(600)]  # multiples with equal cosines
    r.shuffle(rows)
    rows = [(int(i), v) for i, v in rows]
    want = plain_nearest(rows, lambda i: i % 50 == 0, 5)
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for parts in (3, 7):
        got = {}
        for x in nearest(docs.repartition(parts), F.col("id") % 50 == 0, share=1.0).orderBy("query_id", "rank").collect():
            got.setdefault(x.query_id, []).append((x.vec_id, x.score))
        assert set(got) == set(want)
        for q, found in got.items():
            top = {j: s for j, s in plain_nearest(rows, lambda i: i == q, 10 ** 6)[q]}
            best = max(top.values())
            assert [j for j, _ in found] == sorted(j for j, s in top.items() if s > best - 1e-9 and j < 1500)[:5]


def test_best_takes_ties_by_id_and_each_candidate_once():
    q, v, s = np.array([3, 1, 1, 1, 1, 3]), np.array([9, 8, 2, 5, 2, 4]), np.array([.1, .7, .7, .7, .7, .2])
    assert [list(x) for x in _best(q, v, s, 2)] == [[1, 1, 3, 3], [2, 5, 4, 9], [.7, .7, .2, .1]]
    assert len(_best(q[:0], v[:0], s[:0], 2)[0]) == 0


def test_scores_do_not_depend_on_the_block():
    x, y = np.random.default_rng(3).normal(size=(2, 300, 96))
    every = _cosines(x, y)
    assert all(_cosines(x[i:j], y[i:j]).tolist() == every[i:j].tolist() for i, j in ((0, 1), (5, 12), (17, 300)))


def test_blocks_of_multiples_give_k_pairs_a_query():
    """4,000 multiples of one vector: no block keeps more than k pairs of a query, and the ids are the right ones."""
    v = np.random.default_rng(4).normal(size=24)
    rows = [((i + 1) * v).tobytes() for i in range(4000)]
    left = pa.table({"block": np.arange(4000) // 2000, "id": np.arange(4000), "vec": pa.array(rows, pa.binary())})
    asked = np.arange(0, 4000, 50)
    right = pa.table({"block": np.repeat([0, 1], len(asked)), "q": np.tile(asked, 2), "qvec": pa.array([rows[i] for i in asked] * 2, pa.binary())})
    out = _rerank(5, np.float64)(left, right)
    assert out.num_rows == 5 * len(asked)
    x = np.array([np.frombuffer(r) for r in rows])
    got = {}
    for r in out.to_pylist():
        got.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    for q in asked[::9]:
        s = _cosines(x, np.tile(x[q], (4000, 1)))
        assert sorted(got[q]) == sorted((-s[j], j) for j in range(4000) if j != q)[:5]


def test_forest_on_few_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [2.0, 0.0]), (7, [0.0, 3.0]), (8, []), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (50, [1.0, 1.0]), (50, [1.0, 1.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(x.query_id, x["rank"], x.vec_id) for x in nearest(docs, F.col("id") % 50 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 6), (0, 2, 50), (0, 3, 7), (50, 1, 0), (50, 2, 6), (50, 3, 7)]
    for few in (docs.where("vec_id = 1"), docs.limit(0), docs.where("vec_id = 0")):
        assert nearest(few, F.col("id") % 50 == 0).count() == 0


def test_op7_recall_on_the_given_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in table("embeddings", "/root/testdata/sf0.1")]
    want = plain_nearest(rows, lambda i: i % 50 == 0, 5)
    got = {}
    for x in op7_ann_forest(spark, "/root/testdata/sf0.1").collect():
        got.setdefault(x.query_id, set()).add(x.vec_id)
    assert sum(len({j for j, _ in want[q]} & got[q]) for q in want) >= 0.9 * 5 * len(want)


# --- HTML

LINE = "Many words stand here in this line, and they are read. Then one more sentence comes."


@pytest.fixture(scope="module")
def model():
    return H.train([r["html"] for r in table("pages")])


def plain_article(page):
    import html
    import re

    a = page[page.index("<article>") + 9:]
    a = a[:a.index("</article>")] if "</article>" in a else a
    a = re.sub(r"</?(b|i|em|strong|span|a)\b[^>]*>", "", a)
    return " ".join(html.unescape(re.sub(r"<[a-zA-Z/][^>]*>", " ", a)).split())


def test_pages_not_trained_on(model):
    trained = {r["html"] for r in table("pages")}
    for r in table("pages", "/root/testdata/sf0.01"):
        if r["html"] not in trained:
            assert H.main_text(r["html"], model) == plain_article(r["html"])


@pytest.mark.parametrize("page,want", [
    (f'<div id="wrap"><div class="header"><a href=x>Home</a></div><div class="sidebar"><p>{LINE}</p></div><div class="post-content"><h2>Title one</h2><p>{LINE}</p><p>Two {LINE}</p></div>'
     f'<div class="comments"><p>{LINE}</p></div></div>', f"Title one {LINE} Two {LINE}"),
    (f"<body><header><h1>Site</h1></header><main><p>{LINE}<br>x&nbsp;y &lt;b&gt;</p><aside><p>{LINE}</p></aside><form><p>{LINE}</p></form></main><footer>f</footer>", f"{LINE} x y <b>"),
    (f"<article><p>{LINE}</p><section class='reader-comments'><p>{LINE}</p></section><div class=cookie-notice>{LINE}</div></article>", LINE),
    (f"<p>{LINE}</p><p>{LINE}", f"{LINE} {LINE}"),
    (f"<article><p>{LINE} wo<b>rd</b> <i>x</i></p><script>var a='<p>no</p>'</script><!-- <p>no</p> --><style>p{{}}</style></article>", f"{LINE} word x"),
    (None, ""), ("", ""), ("<p>", ""), ('<a title="x>', ""), ("<!--", ""), ("</p></div>", ""),
])
def test_made_layouts(model, page, want):
    assert H.main_text(page, model) == want


INSIDE = [
    "<table><tr><th>Name</th><th>Sum</th></tr><tr><td>Alpha</td><td>17</td></tr></table>", "<table><caption>Some caption</caption><tr><td>cell</td></tr></table>",
    "<figure><img src=x><figcaption>A caption</figcaption></figure>", "<pre>code here</pre>", "<ul><li>One</li><li>Two words</li></ul>", "<ol><li>One</li></ol>",
    "<dl><dt>T</dt><dd>Def</dd></dl>", "<details><summary>More</summary>Here</details>", "<blockquote>Quote</blockquote>", "<section><h3>Sub</h3><p>Short</p></section>",
    "<address>Street 1</address>", "<center>Mid</center>", "<dir><li>x</li></dir>", "<hgroup><h2>H</h2><p>sub</p></hgroup>", "<fieldset><legend>Leg</legend>text</fieldset>",
    "<div>Plain</div>", "<p>Hm.</p>", "<h6>Six</h6>", "<p><a href=x>Link only</a></p>", "<table><thead><tr><th>a</th></tr></thead><tbody><tr><td>b</td></tr></tbody><tfoot><tr><td>c</td></tr></tfoot></table>"]
WRAPS = [("<article>", "</article>"), ("<main>", "</main>"), ("<div><div>", "</div></div>"), ("<div>", "</div>"), ('<div class="post-content">', "</div>"),
         ('<div class="xyzzy">', "</div>"), ("<section>", "</section>"), ("", "")]


@pytest.mark.parametrize("block", INSIDE)
def test_every_block_of_an_article_is_kept(model, block):
    """In an article named in any way or none, alone and beside elements that hold the same block."""
    import re

    around = [("", ""), ("<nav><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li></ul></nav>", "<footer>&copy; x</footer>"),
              ('<div class="header"><a href=a>Home</a></div>', f'<div class="sidebar"><h3>Also</h3><p>{LINE}</p>{block}</div>'),
              ("", f'<div class="widget-area"><h3>Also</h3><p>{LINE}</p></div>'), ("", f'<div class="comments"><div class="comment"><p>{LINE}</p>{block}</div></div>'),
              (f'<div class="ad-banner">{LINE}</div>', '<div id="cookie-consent"><p>We use cookies.</p></div>')]
    for open_, close in WRAPS:
        for text in (f"<h1>Title</h1><p>{LINE}</p>{block}<p>{LINE}</p>", f"<h1>Title</h1><p>{LINE}</p>{block}"):
            want = " ".join(re.sub(r"<[^>]*>", " ", text).split())
            for before, behind in around:
                page = f"<html><head><title>x</title></head><body>{before}{open_}{text}{close}{behind}</body></html>"
                assert H.main_text(page, model) == want, page


def test_made_pages_have_every_block():
    tags = {t for page, y in H.made_pages() for t, v in zip(page.tag, y) if v}
    frame = {"head", "body", "html", *H.ASIDE_TAGS}
    assert H.BLOCKS - frame <= tags
    assert set(H.ASIDE_TAGS) <= {t for page, y in H.made_pages() for t, v in zip(page.tag, y) if not v}


def test_sweeps_over_all_trees_match_single_ones():
    r = random.Random(9)
    groups, unary = {}, []
    for k in range(30):
        n = r.randint(1, 40)
        parent = (-1, *(r.randrange(max(0, i - 3), i) for i in range(1, n)))
        groups[(tuple((k,) for _ in range(n)), parent, tuple(r.randint(0, 1) for _ in range(n)))] = r.randint(1, 5)
        unary.append([r.gauss(0, 3) for _ in range(n)])
    couple = [[r.gauss(0, 2) for _ in range(2)] for _ in range(2)]
    trees = H._Trees(groups)
    got, joint = trees.marginals(np.concatenate(unary), np.array(couple))
    single = [H.marginals(list(parent), u, couple) for (_, parent, _), u in zip(groups, unary)]
    assert got == pytest.approx([x for p, _ in single for x in p])
    want = sum(c * np.array(j[1:]).reshape(-1, 4).sum(0) for (_, j), c in zip(single, groups.values()))
    assert joint.ravel() == pytest.approx(want)


def test_marginals_match_enumeration():
    import itertools
    import math

    r = random.Random(4)
    for _ in range(20):
        n = r.randint(1, 7)
        parent = [-1] + [r.randrange(i) for i in range(1, n)]
        unary, couple = [r.gauss(0, 2) for _ in range(n)], [[r.gauss(0, 1) for _ in range(2)] for _ in range(2)]
        weight = {y: math.exp(sum(u * v for u, v in zip(unary, y)) + sum(couple[y[parent[i]]][y[i]] for i in range(1, n))) for y in itertools.product((0, 1), repeat=n)}
        z = sum(weight.values())
        p, joint = H.marginals(parent, unary, couple)
        for i in range(n):
            assert p[i] == pytest.approx(sum(w for y, w in weight.items() if y[i]) / z)
            if i:
                assert joint[i][3] == pytest.approx(sum(w for y, w in weight.items() if y[i] and y[parent[i]]) / z)


def test_bad_pages_are_quick(model):
    for page in ('<a "' * 100_000, '<a x="' * 100_000, "<!--" * 100_000, "<div>" * 5000 + "x", "<p>x" * 20_000, "<" * 100_000, "&amp" * 50_000):
        H.main_text(page, model)


def test_extract_keeps_rows_and_columns(spark, model):
    rows = [(1, "u", None, "old"), (1, "u", None, "old"), (2, None, f"<article><p>{LINE}</p></article>", "old")]
    out = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"), model)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((x.page_id, x.text, x.n_chars) for x in out.collect()) == [(1, "", 0), (1, "", 0), (2, LINE, len(LINE))]
    assert H.extract(out.limit(0).withColumn("html", F.lit("")), H.train([])).count() == 0


def test_op6_on_the_given_table(spark):
    got = {x.page_id: x for x in H.op6_html_extract(spark, SF).collect()}
    for r in table("pages"):
        assert got[r["page_id"]].text == plain_article(r["html"]) and got[r["page_id"]].url == r["url"]
