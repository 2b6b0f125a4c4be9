"""Main text of web pages by a tree-structured graphical model.

Every block element and every run of text of a page is a node that is content (1) or not (0).  A node's features give a
potential of its own, and each parent-child edge a table of four.  Messages pass upward from the leaves and downward from
the root (sum-product), which makes exact marginals; a run of text is taken if its marginal of content is above one half.

The potentials are trained by gradient ascent on the likelihood of labelled pages: a few written ones below, and a bounded
sample of the table's pages whose own markup says where the article is.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlens.llm.dom import Node, Page
from pactlens.llm.text import read_table, whole_text

SAMPLE = 60
#: Longer pages are not learned from, which bounds what reaches the driver; they are extracted like all others.
SAMPLE_CHARS = 200_000
STEPS = 150
RIDGE = 2e-5
#: How often the written pages are gone through beside the sample.
WRITTEN_SHARE = 10
CONTENT_TAGS = frozenset(("article", "main"))
ASIDE_TAGS = frozenset(("nav", "footer", "header", "aside", "form", "menu", "dialog", "fieldset"))
TAGS = ("#text", "html", "article", "main", "section", "div", "p", "h1", "h2", "h3", "li", "ul", "ol", "blockquote", "pre", "td", "table", "nav", "footer", "header", "aside", "form", "menu", "dialog", "figure", "figcaption")
#: Words of class, id and role by what they speak for.
NAMED = {
    "advert": "ad ads advert advertisement adsense banner promo promoted sponsor sponsored",
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs pager pagination toc tabs",
    "comment": "comment comments reply replies respond discussion disqus",
    "notice": "cookie cookies consent notice alert gdpr popup modal overlay newsletter subscribe signup paywall dialog",
    "side": "sidebar aside related widget share sharing social recommended more tags complementary",
    "foot": "footer foot copyright legal colophon contentinfo",
    "head": "header masthead topbar logo banner",
    "form": "form search login contact",
    "content": "content article post entry story main text body",
}
_OF_WORD = {}
for _name, _listed in NAMED.items():
    for _word in _listed.split():
        _OF_WORD.setdefault(_word, []).append(_name)
_EXTRA = ("short", "middle", "long", "very long", "linked", "sentence", "heading")
_NOT_LETTER, _SENTENCE = re.compile(r"[^a-z]+"), re.compile(r"[.!?,;:]")
FEATURES = {name: i for i, name in enumerate(["bias", *(f"tag {t}" for t in TAGS), "tag other", *(f"named {n}" for n in NAMED), *_EXTRA])}

_TAG = {t: FEATURES[f"tag {t}"] for t in (*TAGS, "other")}

#: Written pages; ``data-main`` marks content and ``data-rest`` what is not, each for all that is inside.
WRITTEN = (
    '<body><header data-rest><h2>Site name</h2><p>The daily site.</p></header><nav data-rest><ul><li><a>Home</a></li><li><a>News</a></li></ul></nav><main data-main><h1>A title of a story</h1><p>First paragraph of the story, with a comma and a full stop. It goes on for a while, as stories do, and then it ends.</p><p>Short one.</p><ul><li>An item of the story.</li><li>Another item, longer.</li></ul><aside data-rest><h3>Related</h3><ul><li><a>Another story</a></li></ul></aside><blockquote><p>Someone said this, and it was written down.</p></blockquote></main><aside data-rest class="sidebar"><p>Most read stories of this week, in a list.</p></aside><footer data-rest><p>All rights reserved. Contact us by mail, or do not.</p></footer></body>',
    '<body><div class="cookie-notice" data-rest><p>We use cookies to make this site better, and to measure how it is used.</p></div><div class="menu" data-rest><ul><li><a>Home</a></li><li><a>About</a></li></ul></div><div class="content" data-main><h1>Title</h1><p>Text of the page, in a sentence of some length. Then another sentence, which is longer than the first one was.</p><p>More text, and more of it.</p><table><tr><td>A cell</td><td>of a table</td></tr></table></div><div class="comments" data-rest><h3>Comments</h3><div><p>I do not agree with this at all, and I shall say why at length here.</p></div></div><div class="footer" data-rest>Copyright by the site.</div></body>',
    '<body><article data-main><h1>Heading of the article</h1><div class="ad" data-rest>Buy this now, it is cheap and good.</div><p>A paragraph. It has sentences, and words.</p><figure><figcaption>A caption of a picture.</figcaption></figure><div class="share" data-rest><a>Share</a></div><p>Last words.</p><section class="comments" data-rest><h2>3 comments</h2><p>First! And a longer remark, with a comma.</p></section><form data-rest><p>Your name and your remark, please.</p></form></article><div class="newsletter" data-rest><p>Subscribe to our letter, every week.</p><form data-rest><p>Mail</p></form></div></body>',
    '<body><ul data-rest><li><a>One</a></li><li><a>Two</a></li><li><a>Three</a></li></ul><div data-main><p>A page without any names has long paragraphs with sentences, commas and full stops. They are the content, since nothing else could be. This is what is wanted from it.</p><p>Another paragraph of the same kind, which is long enough to be taken for text that someone wrote for readers.</p></div><div data-rest><a>Imprint</a> <a>Privacy</a></div></body>',
    '<body><div class="ad" data-rest>Some advertising text with a sentence. And one more.</div><article data-main><h1>Heading</h1><p>Text.</p><p>Of.</p><p>A | B | C | D</p></article><footer data-rest>&copy; example &middot; Some words of the footer, as a sentence. And more.</footer></body>',
    '<body><article data-main><h1>A heading</h1><p>x</p><p>One</p></article><p data-rest><a>Back</a></p></body>',
    '<body><main data-main><p>hello</p><ul><li>first</li><li>second</li></ul><h2>Part</h2><div>Words in a box.</div></main></body>',
    '<body><div data-main><p>Nothing but a paragraph here, with some words in it.</p><p>And another.</p></div></body>',
    '<body><div id="main" data-main><div class="entry"><h2>Entry</h2><p>Short text.</p></div></div><form data-rest><p>Please give your name, and mail.</p></form></body>',
    '<body><div class="post" data-main><h1>Heading</h1><p>Text of the post, a sentence or two. It ends here.</p></div><div class="sidebar" data-rest><p>Something about the author, who writes here.</p></div><div class="related" data-rest><p>Read this too, it is about the same thing.</p></div><section id="comments" data-rest><p>A remark of a reader, who liked it a lot.</p></section><div role="alert" data-rest>There is a new version.</div></body>',
)


def features(nodes: list[Node]) -> list[list[int]]:
    """For each node the numbers of the features it has."""
    out = []
    for node in nodes:
        on = [0, _TAG.get(node.tag, _TAG["other"])]
        if node.words:
            on += sorted({FEATURES[f"named {n}"] for word in _NOT_LETTER.split(node.words) for n in _OF_WORD.get(word, ())})
        if node.tag == "#text":
            size = len(node.text)
            on.append(FEATURES["short" if size < 25 else "middle" if size < 100 else "long" if size < 400 else "very long"])
            if 2 * node.linked > size:
                on.append(FEATURES["linked"])
            if _SENTENCE.search(node.text):
                on.append(FEATURES["sentence"])
            if nodes[node.above].tag in ("h1", "h2", "h3", "h4"):
                on.append(FEATURES["heading"])
        out.append(on)
    return out


def marginals(scores: list[float], above: list[int], tables: list) -> tuple[list[float], list[float], list[float]]:
    """Sum-product on a tree whose nodes come after their parents; each value is the odds of content.

    ``scores``: logarithms of the odds a node has of its own.  ``tables[i][p][c]``: potential of the edge from the parent's
    value p to the value c of node i.  Returns the odds of the nodes' marginals, the odds of each node by itself and what is
    below it, and the odds of its parent by all but the node.
    """
    n = len(scores)
    low, high = 1e-100, 1e100
    up = [math.exp(min(max(s, -60.0), 60.0)) for s in scores]
    sent = [1.0] * n
    for i in range(n - 1, 0, -1):
        (t00, t01), (t10, t11) = tables[i]
        u = up[i]
        sent[i] = (t10 + t11 * u) / (t00 + t01 * u)
        k = above[i]
        up[k] = min(max(up[k] * sent[i], low), high)
    odds, rest = [up[0]] * n, [1.0] * n
    for i in range(1, n):
        (t00, t01), (t10, t11) = tables[i]
        rest[i] = b = min(max(odds[above[i]] / sent[i], low), high)
        odds[i] = min(max(up[i] * (t01 + t11 * b) / (t00 + t10 * b), low), high)
    return odds, up, rest


class TreeModel:
    def __init__(self) -> None:
        self.weights = np.zeros(len(FEATURES))
        self.edges = np.zeros((2, 2, 2))

    def _infer(self, seen: list[list[int]], above: list[int], kind: list[int]):
        weights, both = self.weights.tolist(), np.exp(self.edges).tolist()
        return marginals([sum([weights[j] for j in on]) for on in seen], above, [both[k] for k in kind])

    def content(self, nodes: list[Node]) -> list[float]:
        """For each node the probability that it is content."""
        odds, _, _ = self._infer(features(nodes), [x.above for x in nodes], [int(x.tag == "#text") for x in nodes])
        return [o / (1 + o) for o in odds]

    def fit(self, pages: list[tuple[list[Node], np.ndarray]], steps: int = STEPS, ridge: float = RIDGE) -> None:
        """Gradient ascent on the mean likelihood of the labels, with a step for each parameter (Adam)."""
        parts = [(features(n), [x.above for x in n], [int(x.tag == "#text") for x in n], y.tolist()) for n, y in pages]
        flat = np.array([j for seen, *_ in parts for on in seen for j in on])
        owner = np.repeat(np.arange(sum(len(p[0]) for p in parts)), [len(on) for seen, *_ in parts for on in seen])
        labels = np.array([y for *_, ys in parts for y in ys], float)
        size = len(labels)
        values = [self.weights, self.edges]
        first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
        for step in range(1, steps + 1):
            chance, d_edges = [], np.zeros((2, 2, 2))
            both = np.exp(self.edges).tolist()
            for seen, above, kind, ys in parts:
                odds, up, rest = self._infer(seen, above, kind)
                chance += [o / (1 + o) for o in odds]
                for i in range(1, len(ys)):
                    (t00, t01), (t10, t11) = both[kind[i]]
                    u, b = up[i], rest[i]
                    cells = np.array([[t00, t01 * u], [t10 * b, t11 * b * u]])
                    d_edges[kind[i]] -= cells / cells.sum()
                    d_edges[kind[i], ys[above[i]], ys[i]] += 1
            miss = labels - np.array(chance)
            grads = [np.bincount(flat, weights=miss[owner], minlength=len(FEATURES)) / size - ridge * self.weights, d_edges / size - ridge * self.edges]
            for value, grad, a, b in zip(values, grads, first, second, strict=True):
                a += 0.2 * (grad - a)
                b += 0.05 * (grad * grad - b)
                value += 0.2 * (1 - 0.9 * step / steps) * (a / (1 - 0.8**step)) / (np.sqrt(b / (1 - 0.95**step)) + 1e-8)

    def text(self, html: str) -> str:
        nodes = Page(html).nodes
        chance = self.content(nodes)
        return "\n\n".join(x.text for x, p in zip(nodes, chance, strict=True) if x.tag == "#text" and p > 0.5)


def labelled(html: str) -> tuple[list[Node], np.ndarray] | None:
    """Nodes and labels where the page's own markup has an article; None where it has none."""
    nodes = Page(html).nodes
    labels = np.zeros(len(nodes), int)
    for i, node in enumerate(nodes[1:], 1):
        labels[i] = 1 if node.tag in CONTENT_TAGS else 0 if node.tag in ASIDE_TAGS or _named_rest(node) else labels[node.above]
    return (nodes, labels) if labels.any() else None


def _named_rest(node: Node) -> bool:
    return any(n != "content" for w in re.split(r"[^a-z]+", node.words) for n in _OF_WORD.get(w, ()))


def written_pages() -> list[tuple[list[Node], np.ndarray]]:
    out = []
    for html in WRITTEN:
        marked = Page(re.sub(r"<(\w+)([^>]*) data-(main|rest)", r'<\1 data-x="" role="mark\3"\2', html).replace('role="markmain" class="', 'class="markmain ').replace('role="markrest" class="', 'class="markrest ')).nodes
        labels = np.zeros(len(marked), int)
        for i, node in enumerate(marked[1:], 1):
            labels[i] = 1 if "markmain" in node.words else 0 if "markrest" in node.words else labels[node.above]
        out.append((Page(html).nodes, labels))
    return out


def train(pages: DataFrame, html_column: str = "html", sample: int = SAMPLE) -> TreeModel:
    """A model from the written pages and from at most ``sample`` of the table's, the least by a hash of the text."""
    html = whole_text(html_column)
    rows = pages.select(html.alias("html")).where(F.length("html").between(1, SAMPLE_CHARS))
    keys = [r["k"] for r in rows.select(F.xxhash64("html").alias("k")).distinct().orderBy("k").limit(sample).collect()]
    chosen = rows.where(F.xxhash64("html").isin(keys)).dropDuplicates(["html"]).toPandas()["html"] if keys else []
    found = [x for x in (labelled(h) for h in sorted(chosen)) if x is not None]
    model = TreeModel()
    model.fit([*written_pages() * WRITTEN_SHARE, *found])
    return model


def extract(pages: DataFrame, model: TreeModel, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(page_id, url, text) of every row.  Null html is empty and has no text; a page without content has the empty text;
    repeated rows each give a row; an empty table gives none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.drop(columns="html").assign(text=[model.text(h) for h in batch["html"]])

    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"), whole_text(html_column).alias("html"))
    return rows.mapInPandas(run, "page_id long, url string, text string")


def op7_extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    done = extract(pages, train(pages))
    return done.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
