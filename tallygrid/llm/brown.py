"""Language-model scoring with a Brown class-based bigram (operator 1).

    p(w_i | w_i-1) = p(class_i | class_i-1) * p(w_i | class_i)

Counting. Word counts cover all training rows: tasks add up their own words, Spark sums them.
Every word from a count on that follows from the number of tokens (``floor_of``) takes part in the clustering
as a unit of its own; there cannot be more than ``FLOOR`` of them, whatever the corpus. Rarer words are one unit
per ending of theirs, and these take part as well. Neighbouring units are counted by Spark, all of them.

Clustering. Exchange moves units between classes while the average mutual information of neighbouring
classes grows. The neighbours of each unit are one row of a table that Spark has dealt out by unit. In a sweep
every task takes its units one by one out of their class and puts each where the gain is greatest, with the
class-by-class counts of all units, which it keeps up to date with its own moves; then Spark adds up the
class-by-class counts again. Sweeps go on until they bring hardly any gain.

Scoring. The most frequent words (at most ``HEAD``, cut at a count, so the bound is proven)
are known to every task. Other words leave the task as (row, word, times) and meet their
counts by a shuffle join; frequent words, the hot keys of such a join, never take part.

A word's emission is (c + 1) / (n + v + 1) within its class (n tokens, v types): each class keeps
one share for unseen words, which belong to the class of their ending. Transitions are
smoothed towards the class frequencies. Both sum to 1, so perplexities compare.
"""

from __future__ import annotations

import copy
import hashlib
import zlib
from collections import Counter
from itertools import repeat

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tallygrid.llm.common import lower_words, map_batches, settle, whole_text

HEAD = 200_000
#: Longer words go by a digest, so the head's bytes are bounded as well.
LONG = 64
#: Words are clustered each from a count on that follows from the tokens: one in ``FLOOR`` of them (the head holds all such words),
#: but no less than their root over ``FEW``, as classes of words that were hardly seen say nothing about other texts.
FLOOR, FEW = 100_000, 16
ENDINGS, CLASSES = 128, 64
SMOOTH = 2.0
#: Different words that a task holds before it emits them.
HELD = 500_000
#: Different pairs of units that a task holds before it adds them up or emits them.
HELD_PAIRS = 3_000_000
#: Sweeps end at a gain below this (in nats a token); a sweep without gain is tried again with one unit in 2, then in 4.
ENOUGH, SHARES = 2e-4, 4
END = b" "  # no word holds a blank
BINS_PER_DOUBLING = 16


def ending(word: bytes) -> int:
    """The unit of a word that has none of its own."""
    return zlib.crc32(word[-2:]) % ENDINGS


def keys(text: str) -> list[bytes]:
    """The text's words; long ones by a digest that no word equals but by chance (256 bits)."""
    tokens = lower_words(text)
    if len(text) <= LONG or max(map(len, tokens), default=0) <= LONG:
        return tokens
    return [t if len(t) <= LONG else b" " + hashlib.sha256(t).digest() for t in tokens]


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, c) over all rows of ``text``; every text also counts one END."""

    def count(batches):
        held, ends = Counter(), 0

        def flush():
            items = list(held.items())
            for at in range(0, len(items), 50_000):
                part = items[at : at + 50_000]
                yield {"word": [w for w, _ in part], "c": [n for _, n in part]}
            held.clear()

        for batch in batches:
            for text in batch["text"]:
                held.update(keys(text))
                ends += 1
                if len(held) > HELD:
                    yield from flush()
        held[END] = ends
        yield from flush()

    found = map_batches(rows.select(whole_text().alias("text")), "word binary, c long", count)
    return found.groupBy("word").agg(F.sum("c").alias("c")).where("c > 0")


def head_of(counts: DataFrame, most: int = HEAD) -> list[tuple[bytes, int]]:
    """The most frequent words, at most ``most``, most frequent first; END is not among them.

    The counts are first counted in bins, and the cut lies between two bins, so no more than
    ``most`` rows ever reach the driver.
    """
    able = counts.where(F.col("word") != F.lit(END))
    able = able.withColumn("bin", F.floor(F.log2("c") * BINS_PER_DOUBLING).cast("int"))
    cut, total = None, 0
    for r in sorted(able.groupBy("bin").count().collect(), key=lambda r: -r["bin"]):
        total += r["count"]
        if total > most:
            break
        cut = r["bin"]
    if cut is None:
        return []
    found = [(bytes(r.word), r.c) for r in able.where(F.col("bin") >= cut).select("word", "c").collect()]
    return sorted(found, key=lambda x: (-x[1], x[0]))


def floor_of(total: int) -> float:
    """The count from which a word is clustered, of ``total`` tokens."""
    return max(total / FLOOR, total**0.5 / FEW)


class Units:
    """Numbers of words: place in the head, and unit (own, or that of the ending, or END)."""

    def __init__(self, head: list[tuple[bytes, int]], total: int):
        self.place = {w: i for i, (w, _) in enumerate(head)}
        self.own = sum(c >= floor_of(total) for _, c in head)
        self.end = self.own + ENDINGS
        self.size = self.end + 1
        self.unit = np.array([i if i < self.own else self.own + ending(w) for i, (w, _) in enumerate(head)], dtype=np.int64)

    def of(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Per token: its place in the head (-1: not there) and its unit."""
        place = np.fromiter(map(self.place.get, tokens, repeat(-1)), dtype=np.int64, count=len(tokens))
        unit = self.unit[place] if len(self.unit) else np.zeros(len(place), dtype=np.int64)
        for i in np.flatnonzero(place < 0):
            unit[i] = self.own + ending(tokens[i])
        return place, unit

    def of_word(self, word: bytes) -> int:
        if word == END:
            return self.end
        place = self.place.get(word)
        return self.own + ending(word) if place is None else int(self.unit[place])


def bigrams(rows: DataFrame, units) -> DataFrame:
    """(a, b, n): neighbouring units over all rows. A text starts and ends at END."""

    def count(batches):
        u = units.value
        held, size = [], 0

        def added():
            code, at = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
            return code, np.bincount(at, weights=np.concatenate([n for _, n in held])).astype(np.int64)

        for batch in batches:
            codes = []
            for text in batch["text"]:
                _, unit = u.of(keys(text))
                line = np.concatenate(([u.end], unit, [u.end]))
                codes.append(line[:-1] * u.size + line[1:])
            if codes:
                held.append(np.unique(np.concatenate(codes), return_counts=True))
                size += len(held[-1][0])
            if size > HELD_PAIRS:
                held = [added()]
                size = len(held[0][0])
                if size > HELD_PAIRS // 2:
                    yield {"a": held[0][0] // u.size, "b": held[0][0] % u.size, "n": held[0][1]}
                    held, size = [], 0
        if held:
            code, n = added()
            yield {"a": code // u.size, "b": code % u.size, "n": n}

    found = map_batches(rows.select(whole_text().alias("text")), "a int, b int, n long", count)
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"))


def neighbours(pairs: DataFrame) -> DataFrame:
    """(unit, after, after_n, before, before_n): one row per unit, its neighbours packed as 64-bit integers; no more of them than units."""
    both = pairs.select(F.col("a").alias("unit"), F.lit(0).alias("side"), F.col("b").alias("other"), "n").union(
        pairs.select(F.col("b").alias("unit"), F.lit(1).alias("side"), F.col("a").alias("other"), "n"))
    ordered = both.repartition("unit").sortWithinPartitions("unit", "side", "other")

    def pack(batches):
        name, held = None, []

        def packed():
            side, other, n = (np.concatenate([h[i] for h in held]) for i in range(3))
            cells = [x.astype(np.int64).tobytes() for k in (0, 1) for x in (other[side == k], n[side == k])]
            return dict(zip(("unit", "after", "after_n", "before", "before_n"), ([int(name)], *([c] for c in cells))))

        for batch in batches:
            unit, *rest = (np.array(batch[k], dtype=np.int64) for k in ("unit", "side", "other", "n"))
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(unit)) + 1, [len(unit)])).astype(int)
            for x, y in zip(cuts[:-1], cuts[1:]):
                if x < y:
                    if held and unit[x] != name:
                        yield packed()
                        held = []
                    name = unit[x]
                    held.append([r[x:y] for r in rest])
        if held:
            yield packed()

    return map_batches(ordered, "unit int, after binary, after_n binary, before binary, before_n binary", pack)


def class_pairs(table: DataFrame, g: np.ndarray) -> np.ndarray:
    """Class-by-class counts of neighbours, added up by Spark."""
    shared = table.sparkSession.sparkContext.broadcast(g)

    def add(batches):
        g = shared.value
        m = np.zeros((CLASSES + 1, CLASSES + 1))
        for batch in batches:
            for unit, other, n in zip(batch["unit"], batch["after"], batch["after_n"]):
                m[g[unit]] += np.bincount(g[np.frombuffer(other, dtype=np.int64)], weights=np.frombuffer(n, dtype=np.int64), minlength=CLASSES + 1)
        yield {"cell": np.arange(m.size), "n": m.ravel()}

    out = np.zeros((CLASSES + 1) ** 2)
    for r in map_batches(table.select("unit", "after", "after_n"), "cell int, n double", add).groupBy("cell").agg(F.sum("n")).collect():
        out[r[0]] = r[1]
    return out.reshape(CLASSES + 1, CLASSES + 1)


def _f(x):
    return x * np.log(np.maximum(x, 1e-300))


def information(m: np.ndarray) -> float:
    """What exchange makes greater: the sum of f(class pairs) - f(left classes) - f(right classes), f(x) = x log x."""
    return float(_f(m).sum() - _f(m.sum(axis=0)).sum() - _f(m.sum(axis=1)).sum())


def moved(units, g: np.ndarray, m: np.ndarray) -> list[tuple[int, int]]:
    """(unit, class) of the units that move, one after the other, each where the gain is greatest; ``g`` and ``m`` follow.

    ``units`` gives (unit, others after, times, others before, times).
    """
    left, right, out = m.sum(axis=1), m.sum(axis=0), []
    for unit, after, after_n, before, before_n in units:
        a, same = g[unit], float(after_n[after == unit].sum())
        s = np.bincount(g[after], weights=after_n, minlength=CLASSES + 1)
        p = np.bincount(g[before], weights=before_n, minlength=CLASSES + 1)
        leaves, enters = s.sum(), p.sum()
        s[a] -= same
        p[a] -= same
        m[a, :] -= s
        m[:, a] -= p
        m[a, a] -= same
        left[a] -= leaves
        right[a] -= enters
        d = np.diagonal(m)
        rows, columns = _f(m + s) - _f(m), _f(m + p[:, None]) - _f(m)
        gain = rows.sum(axis=1) - np.diagonal(rows) + columns.sum(axis=0) - np.diagonal(columns)
        gain += _f(d + s + p + same) - _f(d)
        gain -= _f(left + leaves) - _f(left) + _f(right + enters) - _f(right)
        b = int(np.argmax(gain[:CLASSES]))
        if gain[b] <= gain[a] + 1e-6:
            b = a
        if b != a:
            out.append((unit, b))
        g[unit] = b
        m[b, :] += s
        m[:, b] += p
        m[b, b] += same
        left[b] += leaves
        right[b] += enters
    return out


def exchange(table: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Class of each unit, and the class-by-class counts; the last unit (END) keeps the last class.

    Tasks move their units at the same time, each knowing the others' classes as they were. A sweep that brings no gain in
    all is tried again with every second unit, then every fourth; what brings none even so is dropped, and the clustering ends.
    """
    g = np.arange(size) % max(1, min(CLASSES, size - 1))
    g[-1] = CLASSES
    m = class_pairs(table, g)
    value, share, turn = information(m), 1, 0
    context = table.sparkSession.sparkContext
    while True:
        state = context.broadcast((g, m, share, turn))

        def sweep(batches, state=state, size=size):
            g, m, share, turn = state.value
            g, m = g.copy(), m.copy()
            found = []
            for batch in batches:
                cells = zip(*(batch[k] for k in ("unit", "after", "after_n", "before", "before_n")))
                units = ((u, *(np.frombuffer(c, dtype=np.int64) for c in rest)) for u, *rest in cells if u < size - 1 and (u + turn) % share == 0)
                found += moved(units, g, m)
            yield {"unit": [u for u, _ in found], "cls": [c for _, c in found]}

        new = g.copy()
        moves = map_batches(table, "unit int, cls int", sweep).collect()  # at most a row per unit
        for r in moves:
            new[r.unit] = r.cls
        after = class_pairs(table, new) if moves else m
        gained = (information(after) - value) / max(1.0, m.sum())
        if gained > 0:
            g, m, value = new, after, information(after)
            if gained < ENOUGH:
                return g, m
        elif share == SHARES or not moves:
            return g, m
        else:
            share *= 2
        turn += 1


def placed(rows: DataFrame, units, g: np.ndarray, m: np.ndarray) -> DataFrame:
    """(word, c, cls): every training word that is no unit of its own, each in a class of its own choosing.

    Tasks count the classes next to each such word, as the exchange left them (a word without a unit counts by its
    ending's); Spark adds them up by word. Each word then goes where ``moved`` would put it, out of its ending's class,
    against the class-by-class counts of the exchange; words are placed at the same time, none seeing the others' moves.
    """
    context = rows.sparkSession.sparkContext
    state = context.broadcast((units, g, m))

    def count(batches):
        u, g, _ = state.value
        held = Counter()

        def flush():
            items = list(held.items())
            for at in range(0, len(items), 50_000):
                part = items[at : at + 50_000]
                yield {"word": [k[0] for k, _ in part], "side": [k[1] for k, _ in part], "cls": [k[2] for k, _ in part], "n": [n for _, n in part]}
            held.clear()

        for batch in batches:
            for text in batch["text"]:
                tokens = keys(text)
                place, unit = u.of(tokens)
                line = np.concatenate(([CLASSES], g[unit], [CLASSES]))
                for i in np.flatnonzero((place < 0) | (place >= u.own)):
                    w = tokens[i]
                    if i + 1 < len(tokens) and tokens[i + 1] == w:
                        held[(w, 2, 0)] += 1
                    else:
                        held[(w, 0, int(line[i + 2]))] += 1
                    if i == 0 or tokens[i - 1] != w:
                        held[(w, 1, int(line[i]))] += 1
            if len(held) > HELD:
                yield from flush()
        yield from flush()

    def best(batches):
        u, g, m = state.value
        left, right = m.sum(axis=1), m.sum(axis=0)
        size = CLASSES + 1
        for batch in batches:
            words, sides = batch["word"], batch["sides"]
            k = len(words)
            s, p, same = np.zeros((k, size)), np.zeros((k, size)), np.zeros(k)
            for i, entries in enumerate(sides):
                for e in entries:
                    if e["side"] == 2:
                        same[i] += e["n"]
                    else:
                        (s, p)[e["side"]][i, e["cls"]] += e["n"]
            a = g[[u.own + ending(w) for w in words]] if k else np.zeros(0, dtype=np.int64)
            cls = np.empty(k, dtype=np.int64)
            for x in range(0, k, 256):
                cls[x : x + 256] = _best(m, left, right, s[x : x + 256], p[x : x + 256], same[x : x + 256], a[x : x + 256])
            c = (s.sum(axis=1) + same).astype(np.int64)
            yield {"word": words, "c": c, "cls": cls}

    found = map_batches(rows.select(whole_text().alias("text")), "word binary, side int, cls int, n long", count)
    sides = found.groupBy("word").agg(F.collect_list(F.struct("side", "cls", "n")).alias("sides"))
    return map_batches(sides, "word binary, c long, cls int", best)


def _best(m, left, right, s, p, same, a) -> np.ndarray:
    """The class of most gain for each word (rows of ``s``, ``p``, ``same``, ``a``), as ``moved`` finds it for one unit.

    Only the classes a word meets enter its sums, so a word costs its neighbours' classes times the classes.
    """
    k, at = len(a), np.arange(len(a))
    leaves, enters = s.sum(axis=1) + same, p.sum(axis=1) + same
    lf, rt = np.repeat(left[None], k, axis=0), np.repeat(right[None], k, axis=0)
    lf[at, a] -= leaves
    rt[at, a] -= enters

    def met(v):
        """Columns of ``v`` that are not 0, padded: (class, value), k x most."""
        most = max(1, int((v > 0).sum(axis=1).max(initial=0)))
        j = np.argsort(v <= 0, axis=1, kind="stable")[:, :most]
        return j, np.take_along_axis(v, j, axis=1)

    # after: m'[b, j] for the classes j that follow the word, laid out (word, j, b)
    j, sv = met(s)
    after = m.T[j].copy()
    after[at[:, None], np.arange(j.shape[1])[None], a[:, None]] -= sv
    own = j == a[:, None]
    after -= own[:, :, None] * p[:, None, :]
    after[at[:, None], np.arange(j.shape[1])[None], a[:, None]] -= own * same[:, None]
    rows = _f(after + sv[:, :, None]) - _f(after)
    rows[j[:, :, None] == np.arange(CLASSES + 1)[None, None]] = 0
    # before: m'[i, b] for the classes i that lead to the word, laid out (word, i, b)
    i, pv = met(p)
    before = m[i].copy()
    own = i == a[:, None]
    before -= own[:, :, None] * s[:, None, :]
    before[at[:, None], np.arange(i.shape[1])[None], a[:, None]] -= own * same[:, None] + pv
    columns = _f(before + pv[:, :, None]) - _f(before)
    columns[i[:, :, None] == np.arange(CLASSES + 1)[None, None]] = 0
    d = np.repeat(np.diagonal(m)[None], k, axis=0)
    d[at, a] -= s[at, a] + p[at, a] + same
    gain = rows.sum(axis=1) + columns.sum(axis=1) + _f(d + s + p + same[:, None]) - _f(d)
    gain -= _f(lf + leaves[:, None]) - _f(lf) + _f(rt + enters[:, None]) - _f(rt)
    b = np.argmax(gain[:, :CLASSES], axis=1)
    stay = gain[at, b] <= gain[at, a] + 1e-6
    return np.where(stay, a, b)


def with_rows(rows: DataFrame) -> DataFrame:
    """The rows with a whole text and a number of their own, kept, so that later reads meet the same numbers."""
    return settle(rows.withColumn("text", whole_text()).withColumn("row", F.monotonically_increasing_id()))


def filled(rows: DataFrame, model, rest: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``rows`` (row, text, ``keep`` ...): ``keep``, n_words, head (sum of the head's log counts of its words), n_head
    (its words in the head), line (each word's class, one byte a word) and ``rest_at``: (pos, cls, c) of each of its words outside
    the head that was trained on.

    Texts stay where they lie: a row leaves its task as its line, and words outside the head meet their class and count by a
    shuffle join on the word, then come back to their row's line by its number.
    """

    def emit(batches):
        u = model.value.units
        for batch in batches:
            out = {"row": [], "pos": [], "word": []}
            for row, text in zip(batch["row"], batch["text"]):
                tokens = keys(text)
                place = np.fromiter(map(u.place.get, tokens, repeat(-1)), dtype=np.int64, count=len(tokens))
                for i in np.flatnonzero(place < 0):
                    out["row"].append(row)
                    out["pos"].append(int(i))
                    out["word"].append(tokens[i])
            yield out

    def lines(batches):
        m = model.value
        for batch in batches:
            out = {k: [] for k in ("row", *keep, "n_words", "head", "n_head", "line")}
            for at, text in enumerate(batch["text"]):
                tokens = keys(text)
                place, unit = m.units.of(tokens)
                known = place >= 0
                for k in ("row", *keep):
                    out[k].append(batch[k][at])
                out["n_words"].append(len(tokens))
                out["head"].append(float(m.count[place[known]].sum()))
                out["n_head"].append(int(known.sum()))
                out["line"].append(m.classes[unit].astype(np.uint8).tobytes())
            yield out

    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join([f"{k} {types[k]}" for k in ("row", *keep)] + ["n_words long", "head double", "n_head long", "line binary"])
    own = map_batches(rows.select("row", "text", *keep), schema, lines)
    outside = map_batches(rows.select("row", "text"), "row long, pos int, word binary", emit)
    met = outside.join(rest.select("word", "c", "cls"), "word")
    found = met.groupBy("row").agg(F.collect_list(F.struct("pos", "cls", "c")).alias("rest_at"))
    return own.join(found, "row", "left")


def line_of(line: bytes, rest_at) -> np.ndarray:
    """A row's classes from its ``filled`` line and ``rest_at``, between two ENDs."""
    classes = np.frombuffer(line, dtype=np.uint8).astype(np.int64)
    for e in rest_at or ():
        classes[e["pos"]] = e["cls"]
    return np.concatenate(([CLASSES], classes, [CLASSES]))


class Model:
    """What a task needs to score: head counts, classes, log transitions, log class totals.

    Units of their own were clustered by exchange; every other word of the head has a unit and class of its own after them
    (``units.unit`` from ``units.size`` on); words outside the head keep theirs in ``rest``, a table, met by a join.
    """

    def __init__(self, head, counts: DataFrame, rows: DataFrame):
        context = rows.sparkSession.sparkContext
        if "row" not in rows.columns:
            rows = with_rows(rows)
        exchanged = Units(head, counts.agg(F.coalesce(F.sum("c"), F.lit(0))).head()[0])
        table = settle(neighbours(bigrams(rows, context.broadcast(exchanged))))
        g, pairs = exchange(table, exchanged.size)
        placed_words = settle(placed(rows, exchanged, g, pairs))
        least = head[-1][1] if head else None
        own_class = {}
        if least is not None and len(head) > exchanged.own:
            for r in placed_words.where(F.col("c") >= least).select("word", "cls").collect():  # head words only
                own_class[bytes(r.word)] = r.cls
        self.units = copy.copy(exchanged)
        below = [w for w, _ in head[exchanged.own :]]
        if below:
            self.units.unit = exchanged.unit.copy()
            self.units.unit[exchanged.own :] = exchanged.size + np.arange(len(below))
        fallback = lambda w: int(g[exchanged.own + ending(w)])  # noqa: E731  (a head word without training neighbours)
        self.classes = np.concatenate([g, np.array([own_class.get(w, fallback(w)) for w in below], dtype=np.int64)])
        self.rest = placed_words if least is None else placed_words.where(F.col("c") < least)
        self.count = np.log10(np.array([c for _, c in head], dtype=float) + 1)
        pairs = self._pairs(rows, context)
        size = CLASSES + 1
        share = (pairs.sum(axis=0) + 1) / (pairs.sum() + size)
        self.transition = np.log10((pairs + SMOOTH * share) / (pairs.sum(axis=1, keepdims=True) + SMOOTH))
        tokens, types = self._totals(head, counts)
        self.class_total = np.log10(tokens + types + 1)
        self.end_count = 0.0
        for r in counts.where(F.col("word") == F.lit(END)).collect():
            self.end_count = float(np.log10(r.c + 1))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "rest"}

    def classes_of(self, tokens: list[bytes], rest_at) -> tuple[np.ndarray, np.ndarray]:
        """Per token: place in the head (-1: not there) and class; words outside the head take theirs from ``rest_at``."""
        place, unit = self.units.of(tokens)
        classes = self.classes[unit]
        for e in rest_at or ():
            classes[e["pos"]] = e["cls"]
        return place, classes

    def _pairs(self, rows: DataFrame, context) -> np.ndarray:
        """Class-by-class counts of neighbouring words, each word in its own class, added up by Spark."""
        shared = context.broadcast(self)

        def add(batches):
            m = np.zeros((CLASSES + 1, CLASSES + 1), dtype=np.int64)
            for batch in batches:
                for line, rest_at in zip(batch["line"], batch["rest_at"]):
                    line = line_of(line, rest_at)
                    np.add.at(m, (line[:-1], line[1:]), 1)
            yield {"cell": np.arange(m.size), "n": m.ravel()}

        found = map_batches(filled(rows, shared, self.rest).select("line", "rest_at"), "cell int, n long", add)
        out = np.zeros((CLASSES + 1) ** 2)
        for r in found.groupBy("cell").agg(F.sum("n")).collect():
            out[r[0]] = r[1]
        return out.reshape(CLASSES + 1, CLASSES + 1)

    def _totals(self, head, counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and types per class: the head's here, the others' added up by Spark."""
        tokens, types = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
        for w, c in head:
            k = self.classes[self.units.of_word(w)]
            tokens[k] += c
            types[k] += 1
        for r in counts.where(F.col("word") == F.lit(END)).collect():
            tokens[CLASSES] += r.c
            types[CLASSES] += 1
        for r in self.rest.groupBy("cls").agg(F.sum("c"), F.count("*")).collect():
            tokens[r[0]] += r[1]
            types[r[0]] += r[2]
        return tokens, types


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows that are not held out. Null and empty texts are one END token. With
    nothing to learn from, counts are 0. Repeated rows each count and each give a row.
    """
    rows = with_rows(docs.select(F.col("doc_id").cast("long"), "text", held_out.alias("held_out")))
    train = rows.where("NOT held_out")
    counts = settle(word_counts(train))
    total, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).head()
    head = head_of(counts)
    model = Model(head, counts, train)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(model)
    norm = float(np.log10(total + kinds + 1))

    def scored(batches):
        m = shared.value
        has_end = int(m.end_count > 0)
        for batch in batches:
            out = {k: [] for k in ("doc_id", "held_out", "n_tokens", "n_known", "base_score", "score")}
            cells = zip(*(batch[k] for k in ("doc_id", "held_out", "n_words", "head", "n_head", "line", "rest_at")))
            for doc_id, held, n_words, head, n_head, line, rest_at in cells:
                line = line_of(line, rest_at)
                counted = head + m.end_count + sum(float(np.log10(e["c"] + 1)) for e in rest_at or ())
                n_known = n_head + has_end + len(rest_at or ())
                out["doc_id"].append(doc_id)
                out["held_out"].append(held)
                out["n_tokens"].append(n_words + 1)
                out["n_known"].append(n_known)
                out["base_score"].append(counted - (n_words + 1) * norm)
                moves = m.transition[line[:-1], line[1:]].sum() - m.class_total[line[1:]].sum()
                out["score"].append(counted + float(moves))
            yield out

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    found = map_batches(filled(rows, shared, model.rest, ("doc_id", "held_out")), schema, scored)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
