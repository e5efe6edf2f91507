"""A lenient tree of blocks from HTML, and the features of its nodes."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np

# HTML's own kinds of elements.
BLOCK = set(
    "html body article main section div nav header footer aside form fieldset address blockquote figure figcaption details summary dialog "
    "p h1 h2 h3 h4 h5 h6 hgroup ul ol li dl dt dd table caption thead tbody tfoot tr td th pre hr select option textarea button label center "
    "menu search head datalist".split()
)
#: What is no text of the page. All else is, such as formulas or what stands in for scripts and media: the trees judge it.
SILENT = set("script style title template iframe noembed noframes".split())
VOID = set("area base br col embed hr img input link meta source track wbr".split())
#: An opening tag ends the nearest open one of these, as far as the second set reaches.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"}),
}
_SCOPE = set("td th table button html body caption".split())

# Groups of tags, and words in class, id and role that hint at a part's use.
TAGS = {
    "heading": "h1 h2 h3 h4 h5 h6 hgroup", "p": "p", "list": "ul ol menu dl", "item": "li dt dd", "table": "table tr td th tbody thead tfoot caption",
    "quote": "blockquote pre figure figcaption", "box": "div section center details summary", "main": "article main", "nav": "nav search",
    "header": "header", "footer": "footer address", "aside": "aside dialog", "form": "form fieldset select option textarea button label datalist", "root": "html body head",
}
HINTS = {
    "main": "content article post entry story body text main page blog news prose",
    "nav": "nav menu navigation breadcrumb breadcrumbs navbar topbar links pagination pager toc tabs skip",
    "ad": "ad ads advert adverts advertisement banner sponsor sponsored promo promotion adsense commercial",
    "comment": "comment comments commentlist reply replies disqus discussion respond reader feedback thread",
    "notice": "cookie cookies consent notice gdpr alert popup modal overlay privacy warning message toast",
    "side": "sidebar side aside widget widgets rail column related recommended popular trending tags tag more archive",
    "form": "form search newsletter subscribe signup login contact input register",
    "share": "share social follow twitter facebook meta byline author date buttons toolbar",
    "edge": "header footer masthead foot copyright legal colophon bottom top logo",
}
_TAG_BIT = {t: i for i, tags in enumerate(TAGS.values()) for t in tags.split()}
_HINT_BIT = {w: i for i, words in enumerate(HINTS.values()) for w in words.split()}
_POOR = sum(1 << i for i, k in enumerate(TAGS) if k in ("nav", "header", "footer", "aside", "form"))
_RICH = sum(1 << i for i, k in enumerate(TAGS) if k == "main")
_POOR_HINTS = sum(1 << i for i, k in enumerate(HINTS) if k != "main")
_TOKEN = re.compile(r"[a-z]+")
_STOPS = re.compile(r"[.,;:!?]")


class Tree(HTMLParser):
    """Nodes in document order: block elements, and runs of text between block borders."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.hints, self.text, self.link, self.marked = ["html"], [-1], [0], [""], [0], [False]
        self.open, self.links, self.pieces, self.linked = [0], 0, [], 0
        #: Places in ``open`` per tag, so that the nearest open one is found at once.
        self.places: dict[str, list[int]] = {}
        #: The silent element that is open, and how often each tag is open inside it.
        self.silent, self.inside = "", {}
        self.feed(html)
        self.close()
        self._flush()

    def _flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self._node("", 0, text, self.linked, False)
            self.pieces, self.linked = [], 0

    def _node(self, tag: str, hints: int, text: str, linked: int, marked: bool) -> int:
        for column, value in zip((self.tag, self.parent, self.hints, self.text, self.link, self.marked), (tag, self.open[-1], hints, text, linked, marked)):
            column.append(value)
        return len(self.tag) - 1

    def _nearest(self, tags: set[str]) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def _end_nearest(self, tags: set[str], scope: set[str]) -> None:
        """Closes the nearest open element of ``tags``, unless one of ``scope`` is nearer."""
        at = self._nearest(tags)
        if not at or self._nearest(scope - tags) > at:
            return
        self._flush()
        for node in reversed(self.open[at:]):
            self.places[self.tag[node]].pop()
        del self.open[at:]

    def handle_starttag(self, tag, attrs):
        if self.silent:
            if tag not in VOID:
                self.inside[tag] = self.inside.get(tag, 0) + 1
            return
        if tag in SILENT:
            self.silent, self.inside = tag, {tag: 1}
            return
        if tag == "a":
            self.links += 1
        if tag == "br":
            self.pieces.append(" ")
        if tag not in BLOCK:
            return
        self._flush()
        if tag == "html":
            return
        if tag in ENDS:
            self._end_nearest(*ENDS[tag])
        if tag not in ("option", "label", "button", "td", "th", "tr"):
            self._end_nearest({"p"}, _SCOPE)
        if tag in VOID:
            return
        hints, marked = 0, False
        for name, value in attrs:
            if name in ("class", "id", "role", "itemprop", "aria-label") and value:
                for word in _TOKEN.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()):
                    bit = _HINT_BIT.get(word)
                    if bit is not None:
                        hints |= 1 << bit
            marked |= name == "data-keep"
        self.links = 0  # a block ends any link that was left open around it
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append(self._node(tag, hints, "", 0, marked))

    def handle_startendtag(self, tag, attrs):
        if tag in VOID or tag not in SILENT:
            self.handle_starttag(tag, attrs)
            if tag in BLOCK and tag not in VOID:
                self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.silent:
            if self.inside.get(tag):
                self.inside[tag] -= 1
                if tag == self.silent and not self.inside[tag]:
                    self.silent = ""
                return
            if not self.places.get(tag):
                return
            self.silent = ""  # its parent ends, so it was never closed
        if tag == "a":
            self.links = max(0, self.links - 1)
        elif tag in BLOCK and tag not in ("html", "body"):
            self._end_nearest({tag}, set())

    def handle_data(self, data):
        if not self.silent:
            self.pieces.append(data)
            if self.links:
                self.linked += len(data.strip())


NAMES = (
    ["run", "depth", "sibling", "siblings", "text", "share", "link_share", "words_per_run", "stops", "runs", "elements", "starts", "ends"]
    + [f"tag_{k}" for k in TAGS] + [f"hint_{k}" for k in HINTS] + [f"above_{k}" for k in HINTS]
    + ["above_poor_tag", "above_rich_tag", "above_poor_hint", "parent_item", "parent_p", "after_rich"]
)


def features(t: Tree) -> np.ndarray:
    """One row of NAMES per node. Subtrees are ranges of the document order, so their sums are differences of running sums."""
    n = len(t.tag)
    parent = np.array(t.parent)
    size, depth, sibling = np.ones(n, dtype=np.int64), np.zeros(n), np.zeros(n)
    tags = [1 << _TAG_BIT[x] if x in _TAG_BIT else 0 for x in t.tag]
    above_tags, above_hints, after = [0] * n, [0] * n, [0] * n
    children = [0] * n
    rich_seen = 0
    for i in range(1, n):
        p = t.parent[i]
        depth[i], sibling[i] = depth[p] + 1, children[p]
        children[p] += 1
        above_tags[i], above_hints[i] = above_tags[p] | tags[p], above_hints[p] | t.hints[p]
        after[i] = rich_seen and not (above_tags[i] | tags[i]) & _RICH
        rich_seen |= bool(tags[i] & _RICH)
    for i in range(n - 1, 0, -1):
        size[t.parent[i]] += size[i]
    chars = np.array([len(x) for x in t.text], dtype=float)
    words = np.array([x.count(" ") + 1 if x else 0 for x in t.text], dtype=float)
    stops = np.array([len(_STOPS.findall(x)) for x in t.text], dtype=float)
    run = chars > 0
    end = np.arange(n) + size

    def under(v):
        total = np.concatenate(([0.0], np.cumsum(v)))
        return total[end] - total[:n]

    text, all_text = under(chars), max(chars.sum(), 1.0)
    before = np.concatenate(([0.0], np.cumsum(chars)))
    runs, elements = under(run), under(~run)
    siblings = np.array(children, dtype=float)[np.maximum(parent, 0)]
    columns = [
        run, depth, np.log1p(sibling), np.log1p(siblings), np.log1p(text), text / all_text, under(np.array(t.link, dtype=float)) / np.maximum(text, 1),
        np.log1p(under(words) / np.maximum(runs, 1)), under(stops) / np.maximum(under(words), 1), np.log1p(runs), elements / (text + 10),
        before[:n] / all_text, before[end] / all_text,
    ]
    hints, above = np.array(t.hints), np.array(above_hints)
    tag, above_tag = np.array(tags), np.array(above_tags)
    columns += [tag >> i & 1 for i in range(len(TAGS))] + [hints >> i & 1 for i in range(len(HINTS))] + [above >> i & 1 for i in range(len(HINTS))]
    parent_tag = tag[np.maximum(parent, 0)]
    columns += [
        above_tag & _POOR != 0, above_tag & _RICH != 0, above & _POOR_HINTS != 0,
        parent_tag & 1 << list(TAGS).index("item") != 0, parent_tag & 1 << list(TAGS).index("p") != 0, np.array(after, dtype=float),
    ]
    return np.column_stack(columns).astype(float)


def kept_above(t: Tree, keep_run: list[bool]) -> list[int]:
    """Labels of all nodes from those of the runs: an element is kept if a kept run is inside."""
    keep = [int(k) for k in keep_run]
    for i in range(len(t.tag) - 1, 0, -1):
        if keep[i]:
            keep[t.parent[i]] = 1
    return keep


def decode(t: Tree, score: np.ndarray) -> list[int]:
    """Runs of the best consistent choice: a dropped element drops all inside, a kept one may hold dropped parts.

    Bottom-up: the gain of keeping a node is its own score and, per child, the better of keeping
    and dropping; dropping costs the scores of the whole subtree.
    """
    n = len(t.tag)
    keep, drop = score.astype(float).copy(), -score.astype(float)
    for i in range(n - 1, 0, -1):
        p = t.parent[i]
        keep[p] += max(keep[i], drop[i])
        drop[p] += drop[i]
    kept = [True] + [False] * (n - 1)
    for i in range(1, n):
        kept[i] = bool(kept[t.parent[i]] and keep[i] > drop[i])
    return [i for i in range(n) if kept[i] and t.text[i]]
