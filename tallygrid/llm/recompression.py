"""Repeated passages by recompression (operator 13).

A text is a sequence of words. Rounds of recompression shrink it: a round names every run of
equal symbols, then every pair of neighbours whose first symbol falls to the left and whose
second falls to the right of this round's split of the alphabet. A name is a hash of what it
stands for, so every task gives the same name to the same run or pair, all over the corpus.

Where a name stands depends on a few symbols around it: its context ``[lo, hi)``. A window of
words that holds the context holds the name wherever the window occurs, so equal windows agree
in their interior symbols. Each window chooses one of them, the least name of its highest level
(``anchors``); neighbouring windows mostly choose the same, so there are far fewer anchors than
windows. Equal windows have the same anchor at the same place.

* Anchors meet by name. One that no other text has settles its windows: they occur once.
* The words around an anchor, as far as its windows reach, are its surroundings. The first
  occurrence of an anchor with these surroundings (by document, then place) is the original, every
  other one is a repeat, and so are all its windows.
* Anchors that occur in different surroundings leave open which of their windows agree. Only
  these windows, of one occurrence per surroundings, are named one by one and meet by that name.

Surroundings and windows are compared by 128 bits, made of 128-bit word hashes.

Scale. A batch of texts settles what repeats inside it, and sends at most one row per anchor (or
window) and batch, whatever the number of copies; no key holds a group in memory, as rows of a
key are read in sorted order with one row remembered. Texts are shuffled in compressed form:
those with open windows once, and all once at the end.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from tallygrid.llm.common import map_arrow, settle, whole_text

WINDOW = 20
#: Rounds of recompression; a symbol of the second round has 2.4 words on average.
ROUNDS = 2
#: Least words of a chain of symbols.
CHAIN = 4
#: Document ids that occur more than once are broadcast up to so many; beyond, they meet the rows by an ordinary join.
BROADCAST_IDS = 100_000
#: Words whose hashes a task remembers.
REMEMBERED = 400_000
#: Compressed bytes of text that a task works on at a time (or one text): some 200,000 words, at 200 to 300 bytes each.
PIECE = 300_000

_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)
_FAR = np.int64(1 << 60)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def salted(salt: int) -> np.uint64:
    return np.uint64(salt * int(_K[3]) & 0xFFFFFFFFFFFFFFFF)


def joined(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """One name for an ordered pair of names."""
    return mixed(a * _K[0] + mixed(b + _K[1]) * _K[2] + salted(salt))


class Words:
    """128-bit hashes of words as two arrays; remembers those it has seen, up to ``REMEMBERED``."""

    def __init__(self):
        self.place: dict[bytes, int] = {}
        self.hashes = np.zeros((0, 2), dtype=np.uint64)

    def lanes(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        fresh = set(tokens).difference(self.place)
        if len(self.place) + len(fresh) > REMEMBERED and self.place:
            self.__init__()
            fresh = set(tokens)
        if fresh:
            self.place.update(zip(fresh, itertools.count(len(self.place))))
            digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, fresh)), dtype=np.uint64).reshape(-1, 2)
            self.hashes = np.concatenate((self.hashes, digests))
        at = np.fromiter(map(self.place.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        return self.hashes[at, 0], self.hashes[at, 1]


class Level:
    """Symbols of one level in order: name, first word, end, and the words [lo, hi) that fix it. ``part`` is the text each belongs to."""

    def __init__(self, name, start, end, lo, hi, part):
        self.name, self.start, self.end, self.lo, self.hi, self.part = name, start, end, lo, hi, part

    def _around(self):
        """lo of the left and hi of the right neighbour; beyond a text's ends nothing is known, so no window fixes these."""
        edge = self.part[1:] != self.part[:-1]
        left = np.concatenate(([-_FAR], np.where(edge, -_FAR, self.lo[:-1])))
        right = np.concatenate((np.where(edge, _FAR, self.hi[1:]), [_FAR]))
        return edge, left, right

    def runs(self, salt: int) -> "Level":
        """Runs of equal symbols become one; where a run ends is told by its neighbours."""
        edge, left, right = self._around()
        cut = edge | (self.name[1:] != self.name[:-1])
        first = np.flatnonzero(np.concatenate(([True], cut)))
        last = np.flatnonzero(np.concatenate((cut, [True])))
        length = last - first + 1
        name = np.where(length == 1, self.name[first], joined(self.name[first], length.astype(np.uint64), salt))
        return Level(name, self.start[first], self.end[last], left[first], right[last], self.part[first])

    def pairs(self, salt: int) -> "Level":
        """Pairs of a left and a right symbol become one; equal neighbours are gone, so pairs never overlap."""
        edge, left, right = self._around()
        goes_left = mixed(self.name + salted(salt)) >> np.uint64(63) == 0
        meets = np.flatnonzero(goes_left[:-1] & ~goes_left[1:] & ~edge)
        # a right symbol may have met its left neighbour, a left symbol its right one: that must be known, too
        name, end, lo, hi = self.name.copy(), self.end.copy(), np.where(goes_left, self.lo, left), np.where(goes_left, right, self.hi)
        name[meets] = joined(self.name[meets], self.name[meets + 1], salt)
        end[meets], hi[meets] = end[meets + 1], hi[meets + 1]
        stay = np.ones(len(name), dtype=bool)
        stay[meets + 1] = False
        return Level(name[stay], self.start[stay], end[stay], lo[stay], hi[stay], self.part[stay])

    def chains(self, least: int, salt: int) -> "Level":
        """From each symbol on, as many as it takes to hold ``least`` words, under one name; those that pass a text's end are left out."""
        last = np.searchsorted(self.end, self.start + least, "left")
        keep = np.flatnonzero(last < len(self.end))
        keep = keep[self.part[last[keep]] == self.part[keep]]
        last = last[keep]
        name = self.name[keep]
        for k in range(1, int((last - keep).max(initial=0)) + 1):
            more = np.flatnonzero(keep + k <= last)
            name[more] = joined(name[more], self.name[keep[more] + k], salt)
        return Level(name, self.start[keep], self.end[last], self.lo[keep], self.hi[last], self.part[keep])


def levels(name: np.ndarray, part: np.ndarray, rounds: int) -> list[Level]:
    """The words themselves and each round's symbols."""
    at = np.arange(len(name), dtype=np.int64)
    out = [Level(name, at, at + 1, at, at + 1, part)]
    for r in range(rounds):
        out.append(out[-1].runs(2 * r + 1).pairs(2 * r + 2))
    return out


def spans(lane: np.ndarray, reach: int, salt: int) -> list[np.ndarray]:
    """Names of 1, 2, 4, ... words (up to ``reach``) from each place on; those that pass the end are unused."""
    out = [mixed(lane + salted(salt))]
    while 1 << len(out) <= reach:
        half, last = 1 << (len(out) - 1), out[-1]
        ahead = np.concatenate((last[half:], last[:half])) if len(last) > half else last
        out.append(joined(last, ahead, salt + len(out)))
    return out


def span_name(table: list[np.ndarray], start: np.ndarray, length: np.ndarray, salt: int) -> np.ndarray:
    """Names of ``length`` words from ``start`` on: of the two largest spans that cover them."""
    out = np.zeros(len(start), dtype=np.uint64)
    size = np.frexp(length)[1] - 1
    for k in np.unique(size):
        here = np.flatnonzero(size == k)
        s, n = start[here], length[here]
        out[here] = joined(table[k][s], table[k][s + n - (1 << int(k))] + n.astype(np.uint64), salt)
    return out


def anchors(name: np.ndarray, part: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS, least: int = CHAIN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, name, place) of each window's anchor; windows lie inside one text.

    The chain of least name among those of the highest level that the window fixes; the words themselves always are.
    """
    starts = np.flatnonzero(part[: len(part) - window + 1] == part[window - 1 :]) if len(part) >= window else np.zeros(0, dtype=np.int64)
    chosen, place = np.zeros(len(starts), dtype=np.uint64), np.zeros(len(starts), dtype=np.int64)
    if not len(starts):
        return starts, chosen, place
    open_ = np.arange(len(starts))
    for number, symbols in reversed(list(enumerate(levels(name, part, rounds)))):
        chain = symbols.chains(min(least, window), 97)
        fixed = (chain.lo >= 0) & (chain.hi < _FAR)
        lo, hi, names = chain.lo[fixed], chain.hi[fixed], chain.name[fixed]
        first, end = np.searchsorted(lo, starts[open_], "left"), np.searchsorted(hi, starts[open_] + window, "right")
        some = end > first
        first, end, here = first[some], end[some], open_[some]
        best, at = names[first], first.copy()
        for k in range(1, int((end - first).max(initial=0))):
            better = np.flatnonzero(first + k < end)
            better = better[names[first[better] + k] < best[better]]
            at[better] = first[better] + k
            best[better] = names[at[better]]
        chosen[here], place[here] = joined(best, np.full(1, number, dtype=np.uint64), 98), lo[at]
        open_ = open_[~some]
    return starts, chosen, place


# ------------------------------------------------------------------ rows

#: What a row says: an occurrence to be met by name, windows that are repeats, windows that are open.
MEET, REPEAT, OPEN = 0, 1, 2
REF = ("none", "doc_id", "h", "at")
#: ``pack`` holds at, more, several and kind (31, 29, 1 and 2 bits), so that rows sort by place and travel small.
ROW = "name long, c1 long, c2 long, none byte, doc_id long, h long, pack long"
TOLD = "kind byte, none byte, doc_id long, h long, at int, more int"


def packed_places(at: np.ndarray, more: np.ndarray, several: np.ndarray, kind: np.ndarray) -> np.ndarray:
    return at.astype(np.int64) << 32 | more.astype(np.int64) << 3 | several.astype(np.int64) << 2 | kind


def unpacked(pack: np.ndarray) -> dict[str, np.ndarray]:
    return {"at": (pack >> 32).astype(np.int32), "more": ((pack & 0xFFFFFFFF) >> 3).astype(np.int32), "several": (pack >> 2 & 1).astype(bool), "kind": (pack & 3).astype(np.int8)}


def pieces(batches: Iterator[pa.RecordBatch], most: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The batches, cut where they hold more than ``most`` bytes of compressed text."""
    for batch in batches:
        sizes = np.cumsum(pa.compute.binary_length(batch.column("z")).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(sizes):
            before = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, before + most, "right")))
            yield batch.slice(at, end - at)
            at = end


class Texts:
    """The texts of one batch, each row key once, as words in a row."""

    def __init__(self, batch: pa.RecordBatch, cache: Words):
        none, ids, hs = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("none", "doc_id", "h"))
        order = np.lexsort((hs, ids, none))
        same = (none[order][1:] == none[order][:-1]) & (ids[order][1:] == ids[order][:-1]) & (hs[order][1:] == hs[order][:-1])
        keep = order[np.concatenate((np.ones(min(1, len(order)), dtype=bool), ~same))]  # in the order of documents
        unpack = zstandard.ZstdDecompressor().decompress
        packed = batch.column("z")
        self.tokens = [unpack(packed[int(i)].as_py()).split() for i in keep]
        self.rows = keep
        self.none, self.ids, self.hs = none[keep], ids[keep], hs[keep]
        self.sizes = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.part = np.repeat(np.arange(len(keep)), self.sizes)
        self.lane1, self.lane2 = cache.lanes(list(itertools.chain.from_iterable(self.tokens)))


def settled(texts: Texts, start: np.ndarray, more: np.ndarray, name, c1, c2, exact: bool) -> dict[str, np.ndarray]:
    """Rows for occurrences (windows ``start`` to ``start + more``) of one batch, after what the batch itself can tell.

    Texts lie in the order of documents, so the smallest start of equal (name, c1, c2) is the first one.
    """
    order = np.lexsort((start, c2, c1, name))
    start, more, name, c1, c2 = start[order], more[order], name[order], c1[order], c2[order]
    other_name = np.concatenate((np.ones(min(1, len(name)), dtype=bool), name[1:] != name[:-1]))
    first = other_name | np.concatenate((np.ones(min(1, len(name)), dtype=bool), (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])))
    group = np.cumsum(other_name) - 1
    several = np.bincount(group, weights=first)[group] > 1 if len(group) else np.zeros(0, dtype=bool)
    if exact:
        meet, open_ = first, np.zeros(len(first), dtype=bool)
    else:
        meet, open_ = other_name, first & several
    again = np.flatnonzero(~first)
    again = again[np.argsort(start[again], kind="stable")]
    s, e = start[again], start[again] + more[again]
    fresh = np.concatenate((np.ones(min(1, len(s)), dtype=bool), (s[1:] != e[:-1] + 1) | (texts.part[s[1:]] != texts.part[s[:-1]])))
    run = np.flatnonzero(fresh)
    s, e = s[run], e[np.concatenate((run[1:] - 1, [len(e) - 1])).astype(np.int64)] if len(run) else e
    starts = np.concatenate((start[meet], s, start[open_]))
    part = texts.part[starts]
    n = (int(meet.sum()), len(s), int(open_.sum()))
    spread = mixed(starts[n[0] :].astype(np.uint64) + texts.ids[part[n[0] :]].view(np.uint64))  # these need no meeting, so they go anywhere
    blank = np.zeros(n[1] + n[2], dtype=np.uint64)
    kinds = np.repeat(np.array([MEET, REPEAT, OPEN], dtype=np.int64), n)
    flags = np.concatenate((several[meet] & (not exact), np.zeros(n[1] + n[2], dtype=bool)))
    return {
        "name": np.concatenate((name[meet], spread)).view(np.int64),
        "c1": np.concatenate((c1[meet], blank)).view(np.int64),
        "c2": np.concatenate((c2[meet], blank)).view(np.int64),
        "none": texts.none[part], "doc_id": texts.ids[part], "h": texts.hs[part],
        "pack": packed_places(starts - texts.first[part], np.concatenate((more[meet], e - s, more[open_])), flags, kinds),
    }


def occurrences(texts: Texts, window: int) -> dict[str, np.ndarray]:
    """Rows for the anchors of a batch, with their surroundings."""
    start, name, place = anchors(texts.lane1, texts.part, window)
    new = np.concatenate((np.ones(min(1, len(start)), dtype=bool), (name[1:] != name[:-1]) | (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)))
    at = np.flatnonzero(new)
    first = start[at]
    more = (start[np.concatenate((at[1:] - 1, [len(start) - 1])).astype(np.int64)] if len(at) else first) - first
    offset = (place[at] - first).astype(np.uint64)
    around = [span_name(spans(lane, 2 * window, salt), first, more + window, salt) for lane, salt in ((texts.lane1, 11), (texts.lane2, 29))]
    return settled(texts, first, more, name[at], joined(around[0], offset, 41), around[1], False)


def windows(texts: Texts, ranges: list, window: int) -> dict[str, np.ndarray]:
    """Rows for single windows: those whose first words are in ``ranges`` of (at, more) per text."""
    found = [np.zeros(0, dtype=np.int64)]
    for base, size, own in zip(texts.first, texts.sizes, ranges):
        marked = np.zeros(size + 1, dtype=np.int64)
        for at, more in own:
            marked[at] += 1
            marked[at + more + 1] -= 1
        found.append(np.flatnonzero(np.cumsum(marked) > 0) + base)
    start = np.concatenate(found)
    length = np.full(len(start), window, dtype=np.int64)
    name, c1 = (span_name(spans(lane, window, salt), start, length, salt) for lane, salt in ((texts.lane1, 11), (texts.lane2, 29)))
    return settled(texts, start, np.zeros(len(start), dtype=np.int64), name, c1, np.zeros(len(start), dtype=np.uint64), True)


def met(rows: DataFrame) -> DataFrame:
    """(kind, none, doc_id, h, at, more): what the occurrences of each name tell, when all batches are put together.

    Rows come sorted by name, surroundings and place; of a name that goes on in the next batch one row is remembered.
    """
    ordered = rows.repartition("name").sortWithinPartitions("name", "c1", "c2", "none", "doc_id", "h", "pack")

    def tell(batches: Iterator[pa.RecordBatch]):
        held = None
        for batch in batches:
            x = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in ("name", "c1", "c2", "none", "doc_id", "h", "pack")}
            x |= unpacked(x.pop("pack"))
            aside = x["kind"] != MEET
            out = [{k: x[k][aside] for k in ("kind", *REF, "more")}]
            x = {k: v[~aside] for k, v in x.items()}
            if held:
                x = {k: np.concatenate((held[k], v)) for k, v in x.items()}
            if not len(x["name"]):
                yield out[0]
                continue
            one = np.ones(1, dtype=bool)
            other = np.concatenate((one, x["name"][1:] != x["name"][:-1]))
            first = other | np.concatenate((one, (x["c1"][1:] != x["c1"][:-1]) | (x["c2"][1:] != x["c2"][:-1])))
            lead = np.flatnonzero(first)[np.cumsum(first) - 1]
            repeat = ~first
            repeat &= np.logical_or.reduce([x[k] != x[k][lead] for k in REF])  # a row that occurs twice is no repeat of itself
            group = np.cumsum(other) - 1
            several = (np.bincount(group, weights=first) > 1) | (np.bincount(group, weights=x["several"]) > 0)
            told = first & several[group] & ~x["several"]
            for kind, which in ((REPEAT, repeat), (OPEN, told)):
                out.append({k: x[k][which] for k in (*REF, "more")} | {"kind": np.full(int(which.sum()), kind, dtype=np.int8)})
            # of the last name: the leader of its last surroundings; flagged if the name is known to have several
            held = {k: v[lead[-1] :][:1] for k, v in x.items()}
            if several[-1]:
                held["several"] = one
            yield {k: np.concatenate([o[k] for o in out]) for k in out[0]}

    return map_arrow(ordered, TOLD, tell)


# ------------------------------------------------------------------ operator


def keyed(docs: DataFrame) -> DataFrame:
    """(none, doc_id, h, text): keys of rows without nulls; ``h`` tells rows with equal ids apart."""
    plain = docs.select(F.col("doc_id").isNull().cast("byte").alias("none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), whole_text().alias("text"))
    twice = settle(plain.groupBy("none", "doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("none").alias("_none"), F.col("doc_id").alias("_id")))
    n = twice.count()
    if not n:
        return plain.withColumn("h", F.lit(0).cast("long"))
    right = F.broadcast(twice) if n <= BROADCAST_IDS else twice
    found = plain.join(right, (F.col("none") == F.col("_none")) & (F.col("doc_id") == F.col("_id")), "left")
    return found.select("none", "doc_id", "text", F.when(F.col("_id").isNull(), 0).otherwise(F.xxhash64("text")).alias("h"))


def packed(docs: DataFrame) -> DataFrame:
    """Keyed rows with their text compressed, so that it is shuffled at a third of its size."""

    def rows(batches: Iterator[pa.RecordBatch]):
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = batch.column("text")
            yield {k: batch.column(k) for k in ("none", "doc_id", "h")} | {"z": [pack(texts[i].as_py().encode("utf-8", "surrogatepass")) for i in range(len(texts))]}

    return map_arrow(docs, "none byte, doc_id long, h long, z binary", rows)


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, removed (start and end of each run of removed words), kept (the other words, one space between).

    A word is removed if a window of ``window`` words that covers it occurs earlier: in a document of smaller id, or in
    the same document at an earlier place. Windows are judged on the texts as they are.

    A null text has no words. Null ids come after all others. Rows that share an id and differ in text are ordered by a
    hash of their text; rows equal in both are one document that is listed twice: each gets the same result. Texts of
    fewer than ``window`` words are kept whole. An empty table gives an empty result; further columns are ignored.
    """
    source = packed(keyed(docs))

    def first_look(batches: Iterator[pa.RecordBatch]):
        cache = Words()
        for batch in pieces(batches):
            yield occurrences(Texts(batch, cache), window)

    def second_look(batches: Iterator[pa.RecordBatch]):
        cache = Words()
        for batch in pieces(batches):
            texts, ranges = Texts(batch, cache), batch.column("ranges")
            yield windows(texts, [[(r["at"], r["more"]) for r in ranges[int(i)].as_py()] for i in texts.rows], window)

    def cut(batches: Iterator[pa.RecordBatch]):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in pieces(batches):
            out = {"doc_id": [], "n_words": [], "removed": [], "kept": []}
            for none, doc_id, z, ranges in zip(*(batch.column(k).to_pylist() for k in ("none", "doc_id", "z", "ranges"))):
                tokens = unpack(z).split()
                edges = np.zeros(len(tokens) + 1, dtype=np.int64)
                for r in ranges or ():
                    edges[r["at"]] += 1
                    edges[r["at"] + r["more"] + window] -= 1
                gone = np.cumsum(edges[:-1]) > 0
                if gone.any():
                    turn = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))).reshape(-1, 2).tolist()
                    out["removed"].append([{"start": a, "end": b} for a, b in turn])
                    kept = itertools.compress(tokens, (~gone).tolist())
                else:
                    out["removed"].append([])
                    kept = tokens
                out["doc_id"].append(None if none else doc_id)
                out["n_words"].append(len(tokens))
                out["kept"].append(b" ".join(kept).decode("utf-8", "surrogatepass"))
            yield out

    key = ["none", "doc_id", "h"]
    listed = F.collect_list(F.struct("at", "more")).alias("ranges")
    first = settle(met(map_arrow(source, ROW, first_look)))
    open_ = first.where(F.col("kind") == OPEN).groupBy(*key).agg(listed)
    second = met(map_arrow(source.join(open_, key), ROW, second_look))
    gone = first.where(F.col("kind") == REPEAT).unionByName(second.where(F.col("kind") == REPEAT)).groupBy(*key).agg(listed)
    return map_arrow(source.join(gone, key, "left"), "doc_id long, n_words long, removed array<struct<start:int,end:int>>, kept string", cut)
