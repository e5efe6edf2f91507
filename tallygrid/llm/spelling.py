"""Groups of spelling variants by a frequency-vector trie (operator 11).

A word's frequency vector counts its letters in ``GROUPS`` of letters. One inserted letter adds one
to a count (a surplus), one deleted letter takes one away (a deficit), a replaced letter does both
or neither. The words are arranged in a trie by their successive counts; a depth-first search for a
word spends a budget of one surplus and one deficit and meets every word that can be near, and few
others; the leaves it reaches are verified letter by letter.

Scale. The upper ``SHARED`` levels of the trie are the key of a Spark exchange: every word is filed
under its own counts, and asks there and under the counts that the budget reaches (22 keys). Of two
words of equal length one asks the other, so no pair is looked at twice. A key with more than ``SHARD`` words is cut
by a hash of the word into parts of about that size, which are all asked; a task holds one part and
a block of questions. The lower levels are searched in the task for many words at once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallygrid.llm.common import map_arrow, settle, whole_text

#: Least letters of a word, and least occurrences.
LETTERS, OCCURRENCES = 5, 3
#: One run in so many, by its hash with the document's id, loses a letter first; 0 for none.
DROPPED = 97
#: Letters that are counted together, in the order of the trie's levels; other letters are the last group.
GROUPS = ("e", "a", "n", "i", "r", "t", "o", "s", "l", "d", "u", "c", "m", "gh", "bp", "fv", "kw", "yjqxz")
#: Levels of the trie that are the key of the exchange; words of a part of a key; questions that are asked at once.
SHARED, SHARD, ASKED = 6, 20_000, 8_192
#: Words that a task counts before it passes them on; longest words that are verified side by side; pairs at a time.
HELD, WIDE, PAIRS = 300_000, 48, 200_000

# Fixed value: letters are A-Z, a-z and U+00C0 to U+00FF; only A-Z are lower-cased. A code point is a byte in Latin-1.
_FOLD = bytes(c if 0xC0 <= c or chr(c).isalpha() and c < 128 else 32 for c in range(256)).lower()
_BEYOND = re.compile(r"[^\x00-\xFF]")
_GROUP = np.full(256, len(GROUPS), dtype=np.int64)
for _at, _letters in enumerate(GROUPS):
    _GROUP[list(_letters.encode())] = _at
_LEVELS = len(GROUPS) + 1


def runs(text: str) -> list[bytes]:
    """Maximal runs of letters, A-Z lower-cased, a byte per code point."""
    return text.encode("latin-1", "replace").translate(_FOLD).split()


def result(run: bytes, start: int, dropped: int = DROPPED) -> bytes:
    """The run, without one letter if its hash says so; ``start`` is the hash of the id and the colon."""
    if dropped:
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % dropped == 0:
            k = h % len(run)
            return run[:k] + run[k + 1 :]
    return run


def counted(docs: DataFrame, dropped: int = DROPPED) -> DataFrame:
    """(word, n): the words of enough letters and occurrences."""

    def rows(batches: Iterator[pa.RecordBatch]):
        found: Counter = Counter()

        def passed():
            out = {"word": [w.decode("latin-1") for w in found], "n": list(found.values())}
            found.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in Counter(runs(text)).items():
                    if len(run) >= LETTERS:
                        word = result(run, start, dropped)
                        if len(word) >= LETTERS:
                            found[word] += n
                if len(found) > HELD:
                    yield passed()
        yield passed()

    source = docs.select(F.col("doc_id").cast("string").alias("doc_id"), whole_text().alias("text"))
    return map_arrow(source, "word string, n long", rows).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= OCCURRENCES)


# ------------------------------------------------------------------ trie


def vectors(words: list[bytes]) -> np.ndarray:
    """(words, levels): counts of the letter groups."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    group = _GROUP[np.frombuffer(b"".join(words), dtype=np.uint8)]
    at = np.repeat(np.arange(len(words)), sizes) * _LEVELS + group
    return np.bincount(at, minlength=len(words) * _LEVELS).reshape(-1, _LEVELS)


def keys(counts: np.ndarray) -> np.ndarray:
    """The upper levels as one number; counts wrap, as neighbours then stay neighbours."""
    return ((counts[:, :SHARED] % 1024) << (10 * np.arange(SHARED))).sum(axis=1)


def steps() -> list[tuple[list[int], int, int]]:
    """Differences of the upper levels that a word asks for, with the surplus and deficit that are left.

    Nothing; one more of a group; one more of a group and one less of a later one. The word on the other side of any
    other difference asks.
    """
    out = [([0] * SHARED, 1, 1)]
    for g in range(SHARED):
        more = [int(k == g) for k in range(SHARED)]
        out.append((more, 0, 1))
        out += [([x - int(k == h) for k, x in enumerate(more)], 0, 0) for h in range(g + 1, SHARED)]
    return out


class Side:
    """Words as Latin-1 bytes, with counts, padded letters and numbers of occurrences."""

    def __init__(self, words: list[bytes], n: np.ndarray):
        self.words, self.n = words, n
        self.counts = vectors(words) if words else np.zeros((0, _LEVELS), dtype=np.int64)
        self.sizes = np.array([len(w) for w in words], dtype=np.int64)
        short = [w if len(w) <= WIDE else b"" for w in words]
        self.letters = np.array(short, dtype=f"S{WIDE}").view(np.uint8).reshape(len(words), WIDE) if words else np.zeros((0, WIDE), dtype=np.uint8)

    def taken(self, order: np.ndarray) -> "Side":
        out = object.__new__(Side)
        out.words, out.n = [self.words[i] for i in order], self.n[order]
        out.counts, out.sizes, out.letters = self.counts[order], self.sizes[order], self.letters[order]
        return out


def near(a: bytes, b: bytes) -> bool:
    """Whether b is a with one letter replaced or inserted."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(b) != len(a) + 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k:] == b[k + 1 :]


def verified(tree: Side, ask: Side, t: np.ndarray, q: np.ndarray, twice: np.ndarray) -> np.ndarray:
    """Which pairs are near: the tree's word has one letter more, or as many; then it is the greater one if both words ask (``twice``)."""
    more = tree.sizes[t] - ask.sizes[q]
    good = np.zeros(len(t), dtype=bool)
    short = (tree.sizes[t] <= WIDE) & (ask.sizes[q] <= WIDE)
    for number in (0, 1):
        here = np.flatnonzero((more == number) & short)
        for at in range(0, len(here), PAIRS):
            part = here[at : at + PAIRS]
            b, a = tree.letters[t[part]], ask.letters[q[part]]
            differ = a != b
            first = differ.argmax(axis=1)
            if number == 0:
                one = differ.sum(axis=1) == 1
                rows = np.arange(len(part))
                good[part] = one & (~twice[part] | (a[rows, first] < b[rows, first]))  # they differ there alone, so this orders them
            else:
                after = np.arange(WIDE - 1)[None, :] >= first[:, None]
                good[part] = ~((a[:, :-1] != b[:, 1:]) & after).any(axis=1)
    for k in np.flatnonzero(~short & ((more == 0) | (more == 1))):
        x, y = ask.words[q[k]], tree.words[t[k]]
        good[k] = near(x, y) and (len(x) < len(y) or not twice[k] or x < y)
    return good


def searched(tree: Side, ask: Side, surplus: np.ndarray, deficit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place in tree, place in ask) of near words; the tree is sorted by its counts.

    Depth first: a node is a range of the sorted words that agree in all counts so far, with the questions that still reach it.
    """
    found_t, found_q, twice = [], [], surplus & deficit  # words under one key ask each other
    stack = [(0, len(tree.words), SHARED, np.arange(len(ask.words)), surplus, deficit)] if tree.words else []
    while stack:
        low, high, level, q, s, d = stack.pop()
        if level == _LEVELS or high - low == 1:
            for at in range(0, len(q), max(1, PAIRS // (high - low))):
                part = q[at : at + max(1, PAIRS // (high - low))]
                t = np.repeat(np.arange(low, high), len(part))
                both = np.tile(part, high - low)
                good = verified(tree, ask, t, both, twice[both])
                found_t.append(t[good])
                found_q.append(both[good])
            continue
        column = tree.counts[low:high, level]
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(column)) + 1, [high - low]))
        own = ask.counts[q, level]
        for a, b in zip(cuts[:-1], cuts[1:]):
            more = column[a] - own
            stay = np.flatnonzero((more == 0) | (more == 1) & s | (more == -1) & d)
            if len(stay):
                m = more[stay]
                stack.append((low + int(a), low + int(b), level + 1, q[stay], s[stay] & (m != 1), d[stay] & (m != -1)))
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *found_t]), np.concatenate([none, *found_q])


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, near_n): both directions of every pair of near words, from (word, n)."""
    words = words.select("word", "n")

    def file(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            found = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            if found:
                yield {"key": keys(vectors(found)), "word": batch.column("word"), "n": batch.column("n")}

    def ask(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            found = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            counts = vectors(found) if found else np.zeros((0, _LEVELS), dtype=np.int64)
            for step, s, d in steps():
                other = counts[:, :SHARED] + np.array(step)
                real = np.flatnonzero((other >= 0).all(axis=1))
                yield {
                    "key": keys(other[real]), "word": batch.column("word").take(pa.array(real)), "n": batch.column("n").take(pa.array(real)),
                    "surplus": np.full(len(real), bool(s)), "deficit": np.full(len(real), bool(d)),
                }

    filed = settle(map_arrow(words, "key long, word string, n long", file))
    parts = settle(filed.groupBy("key").agg(F.count("*").alias("size")).select("key", F.ceil(F.col("size") / SHARD).cast("int").alias("parts")))
    asked = map_arrow(words, "key long, word string, n long, surplus boolean, deficit boolean", ask)
    no = F.lit(None).cast("boolean")
    held = filed.join(parts, "key").select("key", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int").alias("part"), "word", "n", no.alias("surplus"), no.alias("deficit"))
    # a key without words answers nothing, so an inner join
    put = asked.join(parts, "key").select("key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "word", "n", "surplus", "deficit")
    met = held.unionByName(put).repartition("key", "part").sortWithinPartitions("key", "part", F.col("surplus").isNotNull())

    def meet(batches: Iterator[pa.RecordBatch]):
        name, tree, held_w, held_n = None, None, [], []
        for batch in batches:
            key, part = (batch.column(k).to_numpy() for k in ("key", "part"))
            n = batch.column("n").to_numpy()
            word = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            question = np.array(batch.column("surplus").is_valid().to_pylist(), dtype=bool)
            s, d = (np.array(batch.column(k).fill_null(False).to_pylist(), dtype=bool) for k in ("surplus", "deficit"))
            cuts = np.concatenate(([0], np.flatnonzero((np.diff(key) != 0) | (np.diff(part) != 0)) + 1, [len(key)])).astype(int)
            out = {"word": [], "near": [], "near_n": []}
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if (key[a], part[a]) != name:
                    name, tree, held_w, held_n = (key[a], part[a]), None, [], []
                asks = a + int(np.count_nonzero(~question[a:b]))  # the words come before the questions
                held_w += word[a:asks]
                held_n.append(n[a:asks])
                if asks == b:
                    continue
                if tree is None:
                    side = Side(held_w, np.concatenate(held_n))
                    tree = side.taken(np.lexsort(side.counts.T[::-1]))
                for at in range(asks, b, ASKED):
                    end = min(b, at + ASKED)
                    own = Side(word[at:end], n[at:end])
                    t, q = searched(tree, own, s[at:end], d[at:end])
                    out["word"] += [own.words[i].decode("latin-1") for i in q] + [tree.words[i].decode("latin-1") for i in t]
                    out["near"] += [tree.words[i].decode("latin-1") for i in t] + [own.words[i].decode("latin-1") for i in q]
                    out["near_n"] += tree.n[t].tolist() + own.n[q].tolist()
            yield out

    return map_arrow(met, "word string, near string, near_n long", meet)


# ------------------------------------------------------------------ operator


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): follow forms to the last one. Each round doubles the way that is followed."""
    found = settle(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = found.select(F.col("word").alias("at"), F.col("root").alias("next"))
        step = settle(found.join(ahead, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        found = step.select("word", "root")
        if step.where("moved").isEmpty():
            return found


def variants(docs: DataFrame, dropped: int = DROPPED) -> DataFrame:
    """Per word of ``docs``: word, form, root, n, n_near, form_n.

    Words are runs of letters (after ``dropped`` has taken a letter from some) with at least ``LETTERS`` letters and
    ``OCCURRENCES`` occurrences. Two are near if one letter is inserted, deleted or replaced. A word's form is its near word of largest n,
    the least of several, if that is at least twice its own n; the root is the last of the forms of forms.

    A null text holds no word; a null id counts as empty text; repeated rows count as often as they occur. Empty
    tables give an empty result; further columns are ignored.
    """
    words = settle(counted(docs, dropped))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    found = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best).withColumnRenamed("word", "w")
    takes = -F.col("best.less") >= 2 * F.col("n")
    named = settle(words.join(found, F.col("word") == F.col("w"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, F.col("best.near")).alias("form"), F.when(takes, -F.col("best.less")).alias("form_n"),
    ))
    last = roots(named.where(F.col("form").isNotNull())).withColumnRenamed("word", "w")
    return named.join(last, F.col("word") == F.col("w"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
