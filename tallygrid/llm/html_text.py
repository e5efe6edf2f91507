"""Main text of web pages by gradient-boosted trees over DOM nodes (operator 9).

Training needs no hand labels. From a bounded sample of pages (``SAMPLE``, by a hash of the
page) come two kinds of labelled trees: the pages themselves where they use HTML's own
article or main element, and the same paragraphs laid out anew in page layouts drawn from the lists
below, whose parts are known to be main text or not. Spark's gradient-boosted trees learn which nodes
are kept. Every page is then parsed, its nodes scored, and the best choice without
contradictions decoded: what lies inside a dropped node is dropped.
"""

from __future__ import annotations

import html as markup
import random

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from tallygrid.llm.common import map_batches, settle
from tallygrid.llm.dom import Tree, decode, features, kept_above

#: Pages that training reads, layouts made of each, trees and their depth.
SAMPLE, LAYOUTS, TREES, DEPTH, SEED = 240, 3, 16, 5, 11

# How layouts wrap the main text and the other parts. (tag, attributes), {} is a random number.
MAIN_WRAPS = [
    ("article", ""), ("main", ""), ("article", 'class="post"'), ("div", 'class="content"'), ("div", 'id="main-content"'), ("div", 'class="post-body"'),
    ("section", 'class="entry-content"'), ("div", 'class="article-text"'), ("div", 'id="story"'), ("div", ""), ("section", ""), ("div", 'role="main"'),
    ("div", 'class="c{}"'), ("td", ""),
]
OTHER_PARTS = {
    "nav": [("nav", ""), ("div", 'class="navbar"'), ("ul", 'class="menu"'), ("div", 'id="nav"'), ("div", 'class="breadcrumbs"'), ("div", "")],
    "header": [("header", ""), ("div", 'id="header"'), ("div", 'class="masthead"'), ("header", 'class="site-header"')],
    "footer": [("footer", ""), ("div", 'id="footer"'), ("div", 'class="footer copyright"'), ("footer", 'class="site-footer"')],
    "side": [("aside", ""), ("div", 'class="sidebar"'), ("div", 'id="sidebar"'), ("aside", 'class="widget"'), ("div", 'class="related"'), ("section", 'class="related-posts"')],
    "ad": [("div", 'class="ad"'), ("div", 'class="advert"'), ("div", 'class="ad-banner"'), ("div", 'id="ad{}"'), ("aside", 'class="sponsored"'), ("div", 'class="promo"')],
    "notice": [("div", 'class="cookie-notice"'), ("div", 'id="cookie-consent"'), ("div", 'class="notice"'), ("dialog", ""), ("div", 'class="popup"'), ("div", 'role="alert"')],
    "form": [("form", ""), ("form", 'class="newsletter"'), ("div", 'class="subscribe"'), ("form", 'id="search"'), ("div", 'class="login-form"')],
    "comments": [("section", 'class="comments"'), ("div", 'id="comments"'), ("div", 'class="comment-list"'), ("ol", 'class="commentlist"'), ("div", 'class="discussion"')],
    "share": [("div", 'class="share"'), ("ul", 'class="social"'), ("div", 'class="byline meta"')],
}
BEFORE, INSIDE, AFTER = ("header", "nav", "notice", "ad", "form"), ("ad", "share", "side", "form"), ("comments", "side", "share", "form", "ad", "notice", "nav")


def _mark(r: random.Random, tag: str, attributes: str, inner: str) -> str:
    attributes = attributes.format(r.randrange(1000)) if attributes else ""
    return f"<{tag}{' ' if attributes else ''}{attributes}>{inner}</{tag}>"


def _some(r: random.Random, texts: list[str], short: bool) -> str:
    w = r.choice(texts).split()
    n = r.randint(1, 4) if short else r.randint(6, 60)
    at = r.randrange(max(1, len(w) - n + 1))
    return markup.escape(" ".join(w[at : at + n]) or "more")


def _other(r: random.Random, kind: str, texts: list[str]) -> str:
    """A part that is not main text."""
    tag, attributes = r.choice(OTHER_PARTS[kind])
    links = "".join(f'<li><a href="/{i}">{_some(r, texts, True)}</a></li>' for i in range(r.randint(2, 9)))
    listed = links if tag in ("ul", "ol") else f"<ul>{links}</ul>"
    long = lambda: _some(r, texts, False)
    if kind == "comments":
        inner = "".join(
            _mark(r, "li" if tag == "ol" else "div", r.choice(['class="comment"', 'class="reply"', ""]), f"<b>{_some(r, texts, True)}</b> <p>{long()}</p>" if r.random() < 0.7 else long())
            for _ in range(r.randint(1, 6))
        )
    elif kind == "form":
        inner = f'<label>{_some(r, texts, True)}</label><input name="q"><p>{_some(r, texts, r.random() < 0.5)}</p><button>{_some(r, texts, True)}</button>'
    elif kind in ("ad", "notice"):
        inner = r.choice([long(), f"<p>{long()}</p>", f'<a href="/x">{long()}</a>', f"<p>{long()}</p><button>{_some(r, texts, True)}</button>"])
    elif kind == "footer":
        inner = r.choice([f"&copy; {_some(r, texts, True)} &middot; {long()}", f"<p>&copy; 20{r.randrange(30):02} {_some(r, texts, True)}</p>", listed])
    elif kind == "header":
        inner = r.choice([f'<a href="/">{_some(r, texts, True)}</a>', f"<h2>{_some(r, texts, True)}</h2>{listed}", f"<p>{_some(r, texts, True)}</p>"])
    elif kind == "side":
        inner = r.choice([f"<h3>{_some(r, texts, True)}</h3>{listed}", f"<h3>{_some(r, texts, True)}</h3><p>{long()}</p>", f"<p>{long()}</p>"])
    else:
        inner = listed
    return _mark(r, tag, attributes, inner)


def _main_block(r: random.Random, text: str) -> str:
    """A block of main text, marked as such; sometimes left open, as careless pages do."""
    t, kind = markup.escape(text), r.random()
    if kind < 0.7:
        return f"<p data-keep>{t}</p>" if r.random() < 0.8 else f"<p data-keep><b>{t}<br>"
    if kind < 0.8:
        tag = r.choice(["h2", "h3"])
        return f"<{tag} data-keep>{markup.escape(' '.join(text.split()[:8]))}</{tag}>"
    if kind < 0.88:
        return "<ul>" + "".join(f"<li data-keep>{markup.escape(x)}</li>" for x in text.split(". ") if x.strip()) + "</ul>"
    return r.choice([f"<blockquote data-keep>{t}</blockquote>", f"<pre data-keep>{t}</pre>", f"<div data-keep>{t}</div>", f"<table><tr><td data-keep>{t}</td></tr></table>"])


def layout(r: random.Random, blocks: list[str]) -> str:
    """A page around some blocks of main text."""
    own = r.sample(blocks, min(len(blocks), r.randint(1, 12)))
    main = [_main_block(r, b) for b in own]
    if r.random() < 0.8:
        title = f"<h1 data-keep>{markup.escape(' '.join(own[0].split()[:12]))}</h1>"
        main.insert(0, f"<header>{title}</header>" if r.random() < 0.2 else title)
    for kind in r.sample(INSIDE, r.choice((0, 0, 1, 2))):
        main.insert(r.randint(1, len(main)), _other(r, kind, blocks))
    tag, attributes = r.choice(MAIN_WRAPS)
    inner = _mark(r, tag, attributes, "".join(main)) if r.random() < 0.9 else "".join(main)
    if tag == "td":
        inner = f"<table><tr><td>{_other(r, 'nav', blocks)}</td>{inner}</tr></table>"
    before = "".join(_other(r, k, blocks) for k in r.sample(BEFORE, r.randint(0, 4)))
    after = "".join(_other(r, k, blocks) for k in r.sample(AFTER, r.randint(0, 4)))
    if r.random() < 0.3:
        inner = _mark(r, "div", r.choice(['class="wrapper"', 'id="page"', 'class="container"', ""]), inner)
    return f"<html><body>{before}{inner}{after}</body></html>"


def own_labels(t: Tree) -> list[bool] | None:
    """Runs inside an article or main element, outside of parts that HTML itself calls something else; None without one."""
    inside, out = [False] * len(t.tag), [False] * len(t.tag)
    for i in range(1, len(t.tag)):
        p = t.parent[i]
        out[i] = out[p] or t.tag[i] in ("nav", "aside", "footer", "form", "dialog")
        inside[i] = inside[p] or t.tag[i] in ("article", "main")
    keep = [inside[i] and not out[i] and bool(t.text[i]) for i in range(len(t.tag))]
    return keep if any(keep) else None


def examples(page: str, seed: int) -> tuple[list[list[float]], list[int]]:
    """Features and labels of a page's nodes, as it is and in new layouts."""
    r, x, y = random.Random(seed), [], []
    tree = Tree(page)
    keep = own_labels(tree)
    blocks = [t for i, t in enumerate(tree.text) if t and (keep is None or keep[i])]
    if keep is not None:
        x += features(tree).tolist()
        y += kept_above(tree, keep)
    for _ in range(LAYOUTS if blocks else 0):
        made = Tree(layout(r, blocks))
        marked = [bool(made.text[i]) and made.marked[made.parent[i]] for i in range(len(made.tag))]
        x += features(made).tolist()
        y += kept_above(made, marked)
    return x, y


class Trees:
    """The learned trees as arrays, for scoring whole batches of nodes."""

    def __init__(self, model):
        self.trees = []
        for tree, weight in zip(model.trees, model.treeWeights):
            nodes: list[list[float]] = []
            self._walk(tree._java_obj.rootNode(), nodes)
            a = np.array(nodes)
            self.trees.append((weight, a[:, 0].astype(int), a[:, 1], a[:, 2].astype(int), a[:, 3].astype(int), a[:, 4]))

    def _walk(self, node, nodes) -> int:
        """(feature or -1, threshold, left, right, value) per node."""
        at = len(nodes)
        nodes.append([-1, 0.0, at, at, node.prediction()])
        if node.subtreeDepth():
            split = node.split()
            nodes[at][:2] = [split.featureIndex(), split.threshold()]
            nodes[at][2] = self._walk(node.leftChild(), nodes)
            nodes[at][3] = self._walk(node.rightChild(), nodes)
        return at

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Log odds of being kept."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for weight, feature, threshold, left, right, value in self.trees:
            at = np.zeros(len(x), dtype=int)
            for _ in range(DEPTH):
                f = feature[at]
                go_left = x[rows, np.maximum(f, 0)] <= threshold[at]
                at = np.where(f < 0, at, np.where(go_left, left[at], right[at]))
            total += weight * value[at]
        return 2 * total


def learn(pages: DataFrame, sample: int = SAMPLE) -> Trees | None:
    """Trees from at most ``sample`` pages; None if there is nothing to learn from."""
    chosen = pages.where(F.length("html") > 0).select(F.xxhash64("page_id", "html").alias("h"), "html").orderBy("h").limit(sample)

    def rows(batches):
        for batch in batches:
            out = {"x": [], "y": []}
            for h, page in zip(batch["h"], batch["html"]):
                x, y = examples(page, h)
                out["x"] += x
                out["y"] += y
            yield out

    found = settle(map_batches(chosen, "x array<double>, y int", rows))
    if found.select("y").distinct().count() < 2:
        return None
    data = found.select(array_to_vector("x").alias("features"), F.col("y").cast("double").alias("label"))
    return Trees(GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=SEED, maxBins=48).fit(data))


def main_text(trees: list[Tree], scores: list[np.ndarray]) -> list[str]:
    return ["\n\n".join(t.text[i] for i in decode(t, s)) for t, s in zip(trees, scores)]


def extract(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row of ``pages``: page_id, url, text (main text, blocks joined by two line feeds), n_chars.

    Null and empty pages give empty texts. If no page tells main text from the rest, all blocks
    are kept. Repeated pages each give a row.
    """
    model = learn(pages.select("page_id", "html"), sample)
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        model = shared.value
        for batch in batches:
            trees = [Tree(h) for h in batch["html"]]
            x = [features(t) for t in trees]
            flat = model(np.vstack(x)) if model and x else np.ones(sum(map(len, x)))
            scores = np.split(flat, np.cumsum([len(v) for v in x])[:-1]) if x else []
            texts = main_text(trees, scores)
            yield {"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    source = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce("html", F.lit("")).alias("html"))
    return map_batches(source, "page_id long, url string, text string, n_chars long", rows)


