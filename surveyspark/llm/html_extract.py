"""Main text of web pages by a tree-structured graphical model over DOM nodes.

Every block element is a binary variable: does it hold article text. A node's
potential is a log-linear function of its tag, the words of its class, id and
role, the link share, length and sentences of the text below it. Parent-child
potentials couple the variables along the tree. Messages go up and down the
tree once (sum-product), which gives each node's exact marginal; the text of
the nodes at one half or more is the result.

The potentials are fitted by maximum likelihood, with gradients from the same
marginals, on labelled pages: at most ``MAX_TRAIN`` pages of the table that
have an article or main element (all it holds is article text, but for
elements that say otherwise by tag or class), the same pages with that element
renamed to div and with a div around all, and short pages made from ``ASIDE_WORDS``, ``TEXT_WORDS`` and
``ARTICLE_BLOCKS``. Pages of over ``MAX_TRAIN_CHARS`` characters are extracted, but never train.

Each row gives one row, also repeated ones; an empty table gives none. Pages are
read whole, however long. Null and empty pages have the empty text. The parser
takes what pages have: unclosed tags, comments and quotes, stray end tags.
Scripts, styles, titles and other elements that show no text are skipped.
"""

from __future__ import annotations

import html
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import small_batches, source

MAX_TRAIN = 160
MAX_TRAIN_CHARS = 200_000
STEPS = 800
FRAME = "frame"  # the only feature of the root and the body, which hold all text
#: Elements of HTML by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template title textarea select svg math iframe object canvas audio video button datalist".split())
BLOCKS = frozenset(
    "html body head address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup "
    "legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption".split())
BREAKS = frozenset(["br", "hr"])
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead"}}
FENCE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "tbody": {"table"}}
ASIDE_TAGS = ("nav", "aside", "footer", "form", "header", "menu", "dialog", "search")
ASIDE_WORDS = (
    "nav navigation menu sidebar ad ads advert advertisement banner sponsor sponsored promo cookie cookies consent notice alert popup modal overlay newsletter "
    "subscribe signup login search share sharing social related recommended breadcrumb breadcrumbs pagination pager footer header masthead toolbar comment comments "
    "reply replies respond disqus discussion widget skip toc copyright disclaimer").split()
TEXT_WORDS = "article content post entry story main text body".split()
_LINE = "This is a line of text that says something. It goes on for a while, and then it ends."
#: Elements that an article may hold besides paragraphs, with short and with long text; between them they have
#: every element of ``BLOCKS`` that is no part of the page's frame.
ARTICLE_BLOCKS = (
    "<table><caption>{0}</caption><thead><tr><th>{0}</th><th>Year</th></tr></thead><tbody><tr><td>12</td><td>{0}</td></tr></tbody><tfoot><tr><td>{0}</td></tr></tfoot></table>",
    "<table><tr><td>{0}</td><td>12.5</td></tr><tr><td>{1}</td><td>{0}</td></tr></table>", "<table><tbody><tr><td><p>{1}</p></td></tr></tbody></table>",
    "<figure><figcaption>{0}</figcaption></figure>", "<figure><figcaption><p>{1}</p></figcaption></figure>", "<pre>x = 1</pre>", "<pre>{1}</pre>", "<ul><li>{0}</li><li>One</li></ul>",
    "<ul><li><p>{1}</p></li></ul>", "<ol><li>{0}</li><li>{1}</li></ol>", "<ul><li>{0}<ul><li>{0}</li></ul></li></ul>", "<dl><dt>{0}</dt><dd>{0}</dd><dt>Two</dt><dd>{1}</dd></dl>",
    "<details><summary>{0}</summary><p>{1}</p></details>", "<details><summary>{0}</summary>{0}</details>", "<blockquote>{0}</blockquote>", "<blockquote><p>{1}</p></blockquote>",
    "<section><h2>{0}</h2><p>{1}</p></section>", "<section>{0}</section>", "<div>{0}</div>", "<div>{1}</div>", "<div><div><p>{1}</p><p>{0}</p></div></div>", "<center>{0}</center>",
    "<address>{0}</address>", "<dir><li>{0}</li></dir>", "<hgroup><h1>{0}</h1><p>{0}</p></hgroup>", "<fieldset><legend>{0}</legend><p>{1}</p></fieldset>", "<p>{0}</p>", "<p>So.</p>",
    "<h2>{0}</h2>", "<h4>{0}</h4><p>{1}</p>", "<p>{1} <a href=x>{0}</a></p>", "<p><a href=x>{0}</a></p>", "<ul><li><a href=x>{0}</a> {1}</li></ul>", "{0}", "{1}")

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r">|=\s*[\"']")
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z0-9]+")
_HEADING = re.compile(r"h[1-6]$")
_SENTENCE = re.compile(r"[.!?](?:\s|$)")
_SILENT_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in SILENT}


class Page:
    """Block nodes in document order (``tag``, ``words``, ``parent``) and pieces of text (node, text)."""

    def __init__(self, source_text: str):
        self.tag, self.words, self.parent = ["html"], [[]], [-1]
        self.pieces: list[tuple[int, str]] = []
        self.chars, self.linked = [0], [0]
        self._parse(source_text)

    def _parse(self, s: str) -> None:
        stack, run, link = [0], [], False
        at, n = 0, len(s)
        dead: set[str] = set()

        def flush() -> None:
            if run:
                text = " ".join(html.unescape("".join(run)).split())
                run.clear()
                if text:
                    self.pieces.append((stack[-1], text))

        while at < n:
            lt = s.find("<", at)
            if lt < 0:
                lt = n
            if lt > at:
                part = s[at:lt]
                run.append(part)
                size = len(part.strip())
                self.chars[stack[-1]] += size
                if link:
                    self.linked[stack[-1]] += size
            if lt >= n - 1:
                break
            c = s[lt + 1]
            if c == "!":
                end = s.find("-->", lt + 4) if s.startswith("<!--", lt) else s.find(">", lt)
                at = n if end < 0 else end + (3 if s.startswith("<!--", lt) else 1)
                continue
            if c == "?":
                end = s.find(">", lt)
                at = n if end < 0 else end + 1
                continue
            close = c == "/"
            m = _NAME.match(s, lt + 1 + close)
            if not m:
                if close:
                    end = s.find(">", lt)
                    at = n if end < 0 else end + 1
                else:
                    run.append("<")
                    at = lt + 1
                continue
            tag, at = m.group().lower(), m.end()
            head = at
            while True:
                stop = _STOP.search(s, at)
                if not stop:
                    at = n
                    break
                at = stop.end()
                if s[at - 1] == ">":
                    break
                quote = s[at - 1]
                end = -1 if quote in dead else s.find(quote, at)
                if end < 0:
                    dead.add(quote)
                else:
                    at = end + 1
            if close:
                if tag == "a":
                    link = False
                if tag in BLOCKS and tag not in ("html", "body"):
                    flush()
                    for k in range(len(stack) - 1, 0, -1):
                        if self.tag[stack[k]] == tag:
                            del stack[k:]
                            break
                continue
            if tag in SILENT:
                end = None if s[at - 2:at] == "/>" and tag in ("svg", "math") else _SILENT_END[tag].search(s, at)
                if end:
                    at = end.end()
                elif tag in ("script", "style", "textarea", "title", "iframe"):
                    at = n
                continue
            if tag in BREAKS:
                flush()
            elif tag == "a":
                link = True
            elif tag in BLOCKS and tag != "html":
                flush()
                link = False
                if self.tag[stack[-1]] == "p":
                    stack.pop()
                if (close_set := CLOSES.get(tag)) is not None:
                    for k in range(len(stack) - 1, 0, -1):
                        t = self.tag[stack[k]]
                        if t in FENCE[tag]:
                            break
                        if t in close_set:
                            del stack[k:]
                            break
                if tag == "body" and "body" in self.tag[:3]:
                    continue
                words = [w for a in _ATTR.finditer(s, head, at) for w in _WORD.findall((a.group(2) or a.group(3) or a.group(4) or "").lower())]
                self.tag.append(tag)
                self.words.append(words)
                self.parent.append(stack[-1])
                self.chars.append(0)
                self.linked.append(0)
                stack.append(len(self.tag) - 1)
        flush()

    def features(self) -> list[list[str]]:
        n = len(self.tag)
        chars, linked, ends = self.chars[:], self.linked[:], [0] * n
        for i, t in self.pieces:
            ends[i] += len(_SENTENCE.findall(t))
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            chars[p] += chars[i]
            linked[p] += linked[i]
            ends[p] += ends[i]
        out = []
        for i in range(n):
            if i == 0 or self.tag[i] == "body":
                out.append([FRAME])
                continue
            share = linked[i] / chars[i] if chars[i] else 0
            out.append(["bias", f"tag {'heading' if _HEADING.match(self.tag[i]) else self.tag[i]}", *{f"word {w}" for w in self.words[i]},
                        f"links {0 if share < .05 else 1 if share < .3 else 2 if share < .6 else 3}",
                        f"chars {sum(chars[i] >= x for x in (1, 25, 80, 250, 1000))}", f"ends {min(ends[i], 3)}"])
        return out

    def labels(self) -> list[int] | None:
        """1 for nodes that hold article text by an article or main element; None without one."""
        n = len(self.tag)
        root = [i for i in range(n) if self.tag[i] in ("article", "main") or "main" in self.words[i] and "role" not in self.words[i]]
        if not any(self.tag[i] in ("article", "main") for i in root):
            return None
        inside, aside = [False] * n, [False] * n
        for i in range(n):
            p = self.parent[i]
            aside[i] = (p >= 0 and aside[p]) or self.tag[i] in ASIDE_TAGS or any(w in ASIDE_WORDS for w in self.words[i])
            inside[i] = self.tag[i] in ("article", "main") or (p >= 0 and inside[p])
        out = [int(inside[i] and not aside[i]) for i in range(n)]
        for i in range(n - 1, 0, -1):
            if out[i]:
                out[self.parent[i]] = 1
        return out


def marginals(parent: list[int], unary: list[float], couple: list[list[float]]) -> tuple[list[float], list[list[float]]]:
    """P(node = 1) of each node, and for each node but the root the joint table of parent and node, by one
    sweep of messages up and one down. ``couple[a][b]``: log potential of parent a and child b."""
    n = len(parent)
    e = [[math.exp(x) for x in row] for row in couple]
    up = [(1.0, math.exp(max(-30.0, min(30.0, u)))) for u in unary]  # node and all below it
    sent = [(1.0, 1.0)] * n
    for i in range(n - 1, 0, -1):
        b0, b1 = up[i]
        m0, m1 = e[0][0] * b0 + e[0][1] * b1, e[1][0] * b0 + e[1][1] * b1
        z = m0 + m1
        sent[i] = (m0 / z, m1 / z)
        p0, p1 = up[parent[i]]
        p0, p1 = p0 * sent[i][0], p1 * sent[i][1]
        z = p0 + p1
        up[parent[i]] = (p0 / z, p1 / z) if z > 0 else (0.5, 0.5)
    belief: list[tuple[float, float]] = [(0.5, 0.5)] * n
    z = up[0][0] + up[0][1]
    belief[0] = (up[0][0] / z, up[0][1] / z)
    joint = [[0.0] * 4] * n
    for i in range(1, n):
        q0, q1 = belief[parent[i]]
        c0, c1 = q0 / max(sent[i][0], 1e-300), q1 / max(sent[i][1], 1e-300)
        b0, b1 = up[i]
        j = [c0 * e[0][0] * b0, c0 * e[0][1] * b1, c1 * e[1][0] * b0, c1 * e[1][1] * b1]
        z = sum(j) or 1.0
        j = [x / z for x in j]
        joint[i] = j
        belief[i] = (j[0] + j[2], j[1] + j[3])
    return [b[1] for b in belief], joint


def made_pages() -> list[tuple[Page, list[int]]]:
    """Short labelled pages: one element that is no article text, by word or tag, before, behind or within one
    that is. Both hold each of ``ARTICLE_BLOCKS``, the article is named by an element, by a word or not at all."""
    wraps = [("<article>", "</article>"), ("<main>", "</main>"), ("<div class={0}>", "</div>"), ("<div><div>", "</div></div>"), ("<div>", "</div>"), ("", "")]
    links = "<ul>" + "<li><a href=x>One more</a></li>" * 3 + "</ul>"
    marks = [f"div class={w}" for w in ASIDE_WORDS] + [f"section id={w}" for w in ASIDE_WORDS] + [*ASIDE_TAGS] * 8
    out = []
    for n in range(len(marks) * len(wraps)):
        k, j = divmod(n, len(wraps))
        tag, _, word = marks[k].partition(" ")
        block, other = (ARTICLE_BLOCKS[i % len(ARTICLE_BLOCKS)].format("A few words", _LINE) for i in (n, 11 * n + 3))
        title, lines = f"<h{1 + k % 6}>A title</h{1 + k % 6}>", f"<p>{_LINE}</p>" * (1 + n * 5 % 9)
        text = (title + lines + block + lines, title + block, block + lines, f"{title}{lines}<h2>Part</h2>{lines}{block}")[(k + n // 7) % 4]
        rest = (other, f"<h3>A name</h3>{other}{lines}", _LINE, links, lines + other, other + links, f"<h2>A name</h2><p>{_LINE}</p>{other}")[n % 7]
        rest = f"<{marks[k]}>{rest}</{tag}>"
        open_, close = wraps[j][0].format(TEXT_WORDS[k % len(TEXT_WORDS)]), wraps[j][1]
        body = (open_ + text + close + rest, rest + open_ + text + close, open_ + text + rest + close)[(k + j) % 3]
        page, words = Page(f"<html><body>{body}</body></html>"), [word.partition("=")[2]] * bool(word)
        y = [1] * len(page.tag)
        for i in range(1, len(y)):
            y[i] = int(y[page.parent[i]] and not (page.tag[i] == tag and page.words[i] == words))
        out.append((page, y))
    return out


def train(pages: list[str], steps: int = STEPS) -> dict:
    """Feature weights and parent-child potentials by gradient ascent with per-weight rates; the made pages
    weigh as much as the others in all."""
    data = []
    for text in pages:
        wrapped = re.sub(r"(?i)(<body[^>]*>)", r"\1<div>", text, count=1)
        for marked in (text, wrapped):
            y = Page(marked).labels()
            for s in dict.fromkeys((marked, re.sub(r"(?i)<(/?)(article|main)\b", r"<\1div", marked))):
                page = Page(s)
                if y is not None and len(y) == len(page.tag):
                    data.append((page, y))
    made = made_pages()
    data += made
    index: dict[str, int] = {FRAME: 0}
    groups: dict[tuple, int] = {}
    own = len(data) - len(made)
    for k, (page, y) in enumerate(data):
        feats = tuple(tuple(index.setdefault(f, len(index)) for f in fs) for fs in page.features())
        key = (feats, tuple(page.parent), tuple(y))
        groups[key] = groups.get(key, 0) + (1 if k < own else max(1, own // len(made)))
    trees = _Trees(groups)
    w, couple = np.zeros(len(index)), np.zeros((2, 2))
    hw, hc = np.full(len(index), 1e-6), np.full((2, 2), 1e-6)
    w[0] = 30.0  # the frame holds the article
    total = float(trees.weight.sum())
    for _ in range(steps):
        p, joint = trees.marginals(np.bincount(trees.node, w[trees.feature], len(trees.y)), couple)
        gw = np.bincount(trees.feature, (trees.weight * (trees.y - p))[trees.node], len(index)) - 1e-6 * w * total
        gw[0] = 0
        gc = trees.seen - joint - 1e-6 * couple * total
        hw += gw ** 2
        hc += gc ** 2
        w += 0.7 * gw / np.sqrt(hw)
        couple += 0.7 * gc / np.sqrt(hc)
    return {"weights": {f: float(w[i]) for f, i in index.items()}, "couple": couple.tolist()}


class _Trees:
    """The nodes of all training pages in a row, for sweeps over all trees at once, a level at a time."""

    def __init__(self, groups: dict[tuple, int]):
        starts = np.cumsum([0, *(len(y) for _, _, y in groups)])
        self.y = np.array([v for _, _, y in groups for v in y])
        self.parent = np.array([p + s if p >= 0 else -1 for (_, parent, _), s in zip(groups, starts) for p in parent])
        self.weight = np.repeat(np.array(list(groups.values()), float), np.diff(starts))
        every = [fs for feats, _, _ in groups for fs in feats]
        self.node = np.repeat(np.arange(len(every)), [len(fs) for fs in every])
        self.feature = np.array([f for fs in every for f in fs])
        depth = [0] * len(every)
        for i, q in enumerate(self.parent.tolist()):
            depth[i] = depth[q] + 1 if q >= 0 else 0
        self.levels = [np.flatnonzero(np.array(depth) == d) for d in range(1, max(depth) + 1)]
        child = np.flatnonzero(self.parent >= 0)
        self.seen = np.bincount(2 * self.y[self.parent[child]] + self.y[child], self.weight[child], 4).reshape(2, 2)

    def marginals(self, unary: np.ndarray, couple: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``marginals``, in log odds: P(node = 1), and the weighted sum of the joint tables of parent and child."""
        up, sent = np.clip(unary, -30, 30), np.zeros(len(unary))
        for at in reversed(self.levels):
            sent[at] = np.logaddexp(couple[1, 0], couple[1, 1] + up[at]) - np.logaddexp(couple[0, 0], couple[0, 1] + up[at])
            up += np.bincount(self.parent[at], sent[at], len(up))
        belief, joint = up.copy(), np.zeros((2, 2))
        for at in self.levels:
            rest = belief[self.parent[at]] - sent[at]
            j = np.array([[np.full(len(at), couple[0, 0]), couple[0, 1] + up[at]], [couple[1, 0] + rest, couple[1, 1] + rest + up[at]]])
            j = np.exp(j - j.max(axis=(0, 1)))
            j /= j.sum(axis=(0, 1))
            belief[at] = np.log(np.maximum(j[:, 1].sum(0), 1e-300)) - np.log(np.maximum(j[:, 0].sum(0), 1e-300))
            joint += (j * self.weight[at]).sum(2)
        return 1 / (1 + np.exp(-np.clip(belief, -700, 700))), joint


def main_text(source_text: str | None, model: dict) -> str:
    page = Page(source_text or "")
    if not page.pieces:
        return ""
    weights = model["weights"]
    p, _ = marginals(page.parent, [sum(weights.get(f, 0.0) for f in fs) for fs in page.features()], model["couple"])
    return " ".join(t for i, t in page.pieces if p[i] >= 0.5)


def fit_on(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", most: int = MAX_TRAIN) -> dict:
    """A model from at most ``most`` pages with an article or main element, those with the smallest id hashes."""
    marked = pages.where(F.col(html_col).rlike(r"(?i)<(article|main)\b") & (F.length(html_col) <= MAX_TRAIN_CHARS))
    rows = marked.orderBy(F.xxhash64(id_col), id_col, html_col).limit(most).select(F.col(html_col).alias("h")).toArrow()
    return train(rows["h"].to_pylist())


def extract(pages: DataFrame, model: dict, html_col: str = "html") -> DataFrame:
    """``pages`` without its html, with ``text`` and ``n_chars``; columns of these names are replaced."""
    spark = pages.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    keep = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    src = pages.select(*keep, F.col(html_col).cast("string").alias("_html"))
    fields = T.StructType([*src.schema.fields[:-1], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        for b in batches:
            texts = [main_text(h, shared.value) for h in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*keep, "text", "n_chars"])

    return src.mapInArrow(run, fields)


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every row of ``pages``."""
    pages = source(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages, fit_on(pages))
