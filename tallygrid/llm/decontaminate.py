"""Benchmark decontamination by q-gram lemma filtering (operator 4).

Texts are folded (case-folded words joined by single blanks). A window of w folded characters of
a benchmark item leaks if a document holds it with at most k edits. By the q-gram lemma such
a region shares at least w + 1 - q * (k + 1) q-grams with the window, all within k diagonals of
each other. So a document's q-grams are looked up in the benchmark's; hits are counted per item
in overlapping bands of diagonals, every k + 1 diagonals wide twice over; where a window's
length holds enough hits in one band, a banded alignment verifies every window around them.
Of the equal windows of an item only the first is looked for, as the others find the same.

The benchmark is the stated query set. It is indexed in blocks of ``BLOCK_CHARS`` characters,
which bounds what a task holds; every block passes over all documents. Documents are never
shuffled, and each is read whole, in overlapping pieces if it is very long.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tallygrid.llm.common import map_batches, ready, whole_text

Q = 12
#: Length of a window and its edit budget. A shorter item is one window, its budget cut until the lemma bounds it.
WINDOW, EDITS = 80, 5
BLOCK_CHARS = 2_000_000
WINDOWS_AT_ONCE = 512
#: Characters of a document that are looked up at a time, and most hits among them.
PIECE, HITS = 65_536, 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 22
_WORDS = re.compile(r"[^\W_]+")


def folded(text: str) -> str:
    return " ".join(_WORDS.findall(text.casefold()))


def origin(text: str) -> np.ndarray:
    """For every folded character, its place in the text."""
    lengths = [len(c.casefold()) for c in text]
    place = np.repeat(np.arange(len(text)), lengths)
    out: list[int] = []
    for m in _WORDS.finditer(text.casefold()):
        if out:
            out.append(out[-1])
        out += place[m.start() : m.end()].tolist()
    return np.array(out, dtype=np.int64)


def grams(chars: np.ndarray) -> np.ndarray:
    """64-bit codes of all q-grams."""
    m = len(chars) - Q + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    code = np.zeros(m, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(Q):
            code = code * _BASE + chars[i : i + m]
        return code ^ (code >> np.uint64(29))


def as_chars(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


def banded_distances(own: np.ndarray, starts: np.ndarray, lows: np.ndarray, window: int, chars: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """For every window own[j : j + window] of ``starts``: its least edits against a part of ``chars``, and that part's start and end.

    The alignment of a window stays within ``width`` diagonals (place in chars - place in own) from its entry of ``lows`` on.
    """
    step = np.arange(width, dtype=np.int64)
    # beyond either end stand characters that nothing equals; one of them costs what leaving it out costs
    at = np.clip((starts + lows)[:, None] + np.arange(width + window)[None, :], -1, len(chars))
    inside = (at >= 0) & (at < len(chars))
    there = np.where(inside, chars[np.clip(at, 0, len(chars) - 1)], np.uint64(2**63))
    # edits times the number of diagonals, plus the diagonal of the start
    cost = np.tile(step, (len(starts), 1))
    for i in range(window):
        change = cost + width * (there[:, i : i + width] != own[starts + i][:, None])
        change[:, :-1] = np.minimum(change[:, :-1], cost[:, 1:] + width)
        cost = np.minimum.accumulate(change - width * step, axis=1) + width * step  # insertions
    last = cost.argmin(axis=1)
    edits, first = np.divmod(cost[np.arange(len(starts)), last], width)
    begin, stop = starts + lows + first, starts + lows + window + last
    return edits, np.clip(begin, 0, len(chars)), np.clip(stop, 0, len(chars))


def fresh_windows(chars: np.ndarray, window: int) -> np.ndarray:
    """Which windows of an item have a content that no earlier one has, compared by two 64-bit codes."""
    m = len(chars) - window + 1
    if m <= 0:
        return np.zeros(0, dtype=bool)
    one, two = np.zeros(m, dtype=np.uint64), np.zeros(m, dtype=np.uint64)
    for i in range(window):
        part = chars[i : i + m]
        one, two = one * _BASE + part, (two ^ (part + np.uint64(1))) * np.uint64(0xC2B2AE3D27D4EB4F)
        two ^= two >> np.uint64(31)
    order = np.lexsort((two, one))
    first = np.concatenate(([True], (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])))
    out = np.zeros(m, dtype=bool)
    out[order[first]] = True
    return out


class Index:
    """q-grams of a block of items, with the places where they stand."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.ids = [i for i, _ in items]
        self.chars = [as_chars(folded(t)) for _, t in items]
        self.windows = [min(WINDOW, len(c)) for c in self.chars]
        self.budgets = [max(0, min(EDITS, (w + 1 - 1) // Q - 1)) for w in self.windows]
        # equal windows of an item have equal results, so only the first of them and its q-grams are looked for
        self.fresh = [fresh_windows(c, w) if len(c) >= Q else np.zeros(0, dtype=bool) for c, w in zip(self.chars, self.windows)]
        places = [self._needed(f, w) for f, w in zip(self.fresh, self.windows)]
        found = [grams(c)[p] for c, p in zip(self.chars, places)]
        codes = np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)
        item = np.repeat(np.arange(len(found)), [len(g) for g in found])
        place = np.concatenate(places) if found else np.zeros(0, dtype=np.int64)
        order = np.argsort(codes, kind="stable")
        self.codes, first = np.unique(codes[order], return_index=True)
        self.item, self.place = item[order], place[order]
        self.ends = np.append(first[1:], len(order))
        self.starts = first
        self.table = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.table[(self.codes >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True

    @staticmethod
    def _needed(fresh: np.ndarray, window: int) -> np.ndarray:
        """Places of the q-grams that lie in fresh windows."""
        if not len(fresh):
            return np.zeros(0, dtype=np.int64)
        edges = np.zeros(len(fresh) + window - Q + 2, dtype=np.int64)
        edges[np.flatnonzero(fresh)] += 1
        np.subtract.at(edges, np.flatnonzero(fresh) + window - Q + 1, 1)
        return np.flatnonzero(np.cumsum(edges) > 0)

    def _entries(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the document, number of the code) of every shared q-gram."""
        at = np.flatnonzero(self.table[(code >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)])
        entry = np.searchsorted(self.codes, code[at])
        entry[entry == len(self.codes)] = 0
        real = self.codes[entry] == code[at] if len(at) else np.zeros(0, dtype=bool)
        return at[real], entry[real]

    def hits(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the document, item, place in the item) of every shared q-gram."""
        at, entry = self._entries(code)
        if not len(at):
            empty = np.zeros(0, dtype=np.int64)
            return empty, empty, empty
        times = self.ends[entry] - self.starts[entry]
        flat = np.repeat(self.starts[entry] - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(times.sum())
        return np.repeat(at, times), self.item[flat], self.place[flat]

    def regions(self, text: str, first_only: bool = False) -> list[tuple[int, int, int, int]]:
        """(item number, start, end, edits) of verified regions in a folded text, overlapping ones merged."""
        chars = as_chars(text)
        found: list[tuple[int, int, int, int]] = []
        for at, piece in self._pieces(chars):
            for item, start, end, edits in self._piece(piece, first_only):
                found.append((item, at + start, at + end, edits))
                if first_only:
                    return found
        merged: list[tuple[int, int, int, int]] = []
        for item, start, end, edits in sorted(set(found)):
            if merged and merged[-1][0] == item and start <= merged[-1][2]:
                last = merged.pop()
                start, end, edits = last[1], max(end, last[2]), min(edits, last[3])
            merged.append((item, start, end, edits))
        return merged

    def _pieces(self, chars: np.ndarray):
        """(start, characters): overlapping pieces that hold at most ``HITS`` hits each, or are two windows long."""
        waiting = [(at, min(len(chars), at + PIECE + 2 * WINDOW)) for at in range(0, max(1, len(chars) - Q + 1), PIECE)][::-1]
        while waiting:
            start, end = waiting.pop()
            if end - start > 6 * WINDOW:
                _, entry = self._entries(grams(chars[start:end]))
                if (self.ends[entry] - self.starts[entry]).sum() > HITS:
                    middle = (start + end) // 2
                    waiting += [(middle - WINDOW, end), (start, middle + WINDOW)]
                    continue
            yield start, chars[start:end]

    def _piece(self, chars: np.ndarray, first_only: bool):
        at, item, place = self.hits(grams(chars))
        if not len(at):
            return
        # items with too few hits in all cannot reach the bound
        enough = np.bincount(item, minlength=len(self.ids))
        least = np.array([w + 1 - Q * (k + 1) for w, k in zip(self.windows, self.budgets)])
        good = (enough >= least)[item]
        at, item, place = at[good], item[good], place[good]
        diagonal = at - place
        for number in np.unique(item):
            mine = item == number
            yield from self._item(chars, int(number), place[mine], diagonal[mine], int(least[number]), first_only)

    def _item(self, chars, number, place, diagonal, least, first_only):
        window, k, own = self.windows[number], self.budgets[number], self.chars[number]
        least = max(1, least)
        order = np.argsort(diagonal, kind="stable")
        place, band = place[order], diagonal[order] // (k + 1)
        named = np.unique(np.concatenate((band, band - 1)))
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for one, a, b in zip(named.tolist(), np.searchsorted(band, named, "left").tolist(), np.searchsorted(band, named + 1, "right").tolist()):
            if b - a >= least:
                p = np.sort(place[a:b])
                dense = np.flatnonzero(p[least - 1 :] - p[: len(p) - least + 1] <= window - Q)
                # every window that holds the hits of a dense stretch, wherever in the window they lie
                opens = np.zeros(len(own) - window + 2, dtype=np.int64)
                np.add.at(opens, np.maximum(0, p[dense + least - 1] + Q - window), 1)
                np.add.at(opens, np.minimum(p[dense], len(own) - window) + 1, -1)
                starts = np.flatnonzero((np.cumsum(opens)[:-1] > 0) & self.fresh[number])
                # an alignment with at most k edits leaves its hits' diagonals by at most k
                held.append((starts, np.full(len(starts), one * (k + 1) - k)))
                size += len(starts)
            if size >= WINDOWS_AT_ONCE or one == named[-1]:
                starts, lows = (np.concatenate([h[i] for h in held]) if held else np.zeros(0, dtype=np.int64) for i in (0, 1))
                held, size = [], 0
                for at in range(0, len(starts), WINDOWS_AT_ONCE):
                    some = slice(at, at + WINDOWS_AT_ONCE)
                    edits, start, end = banded_distances(own, starts[some], lows[some], window, chars, 2 * (k + 1) + 2 * k)
                    good = (edits <= k) & (start < end)
                    for region in zip(start[good].tolist(), end[good].tolist(), edits[good].tolist()):
                        yield number, *region
                        if first_only:
                            return


def blocks(benchmark: DataFrame, most: int = BLOCK_CHARS):
    """Indexes over the benchmark's items, each of at most ``most`` characters or one item."""
    held, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("long"), whole_text().alias("text")).toLocalIterator():
        if held and size + len(r.text) > most:
            yield Index(held)
            held, size = [], 0
        held.append((r.item_id, r.text))
        size += len(r.text)
    if held:
        yield Index(held)


_SCHEMA = "doc_id long, item_id long, start long, end long, edits int"


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per region of a document that holds a benchmark passage: doc_id, item_id, start, end, edits.

    start and end are code points of the document's text; edits is the least of the region's
    windows. Clean documents give no row; null and empty texts are clean. Items shorter than
    a q-gram when folded cannot be told from ordinary words and match nothing. Repeated
    documents and items each give their rows. Without a benchmark the result is empty.
    """
    source = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    out = docs.sparkSession.createDataFrame([], _SCHEMA)
    for index in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def rows(batches, shared=shared):
            index = shared.value
            for batch in batches:
                found = {k: [] for k in ("doc_id", "item_id", "start", "end", "edits")}
                for doc_id, text in zip(batch["doc_id"], batch["text"]):
                    regions = index.regions(folded(text))
                    place = origin(text) if regions else None
                    for number, start, end, edits in regions:
                        for k, v in zip(found, (doc_id, index.ids[number], place[start], place[end - 1] + 1, edits)):
                            found[k].append(v)
                yield found

        out = out.unionByName(map_batches(source, _SCHEMA, rows))
    return out


def contaminated(text: Column, shared) -> Column:
    """Whether the text holds a passage of a block of the benchmark (a broadcast Index)."""
    return F.udf(lambda t: bool(shared.value.regions(folded(t), first_only=True)), "boolean", useArrow=True)(text)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any benchmark passage, with all their columns."""
    ready(docs.sparkSession)
    for index in blocks(benchmark):
        docs = docs.where(~contaminated(whole_text(), docs.sparkSession.sparkContext.broadcast(index)))
    return docs
