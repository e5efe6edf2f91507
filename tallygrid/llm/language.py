"""Language identification by rank-order profiles (operator 8).

Every language's profile is the list of its most frequent character n-grams (1 to 5,
words padded with a blank) over all training rows. A text is compared to each profile by
the out-of-place distance: the sum, over the text's own most frequent n-grams, of how far
their ranks lie apart, with the longest distance for n-grams that the profile lacks.

Counting is partition-wise: a task adds up its own n-grams and emits each once per flush;
Spark sums them and keeps the top of each language, cut per task before the shuffle.
N-grams are 64-bit polynomial codes, so a text costs a few sorts of integers.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallygrid.llm.common import map_batches, settle, whole_text

LONGEST = 5
#: n-grams in a profile, and of a text that is compared.
PROFILE, OF_TEXT = 400, 400
#: Different n-grams that a task holds before it emits them.
HELD = 1_000_000
UNKNOWN = "und"

_BASE = np.uint64(0x9E3779B97F4A7C15)


def letters_only(text: Column) -> Column:
    """Lower case, every run of other characters as one blank, a blank around."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")), F.lit(" "))


def codes(text: str) -> np.ndarray:
    """A 64-bit code for every n-gram of 1 to LONGEST characters that does not hold a blank inside; lone blanks left out."""
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    blank = chars == 32
    found, code, inside = [], np.zeros(len(chars), dtype=np.uint64), np.zeros(len(chars), dtype=bool)
    with np.errstate(over="ignore"):
        for n in range(1, LONGEST + 1):
            if len(chars) < n:
                break
            m = len(chars) - n + 1
            code = (code[:m] + chars[n - 1 :]) * _BASE + np.uint64(n)
            # a blank may open or end an n-gram, but not stand inside it
            inside = inside[:m] | blank[n - 2 : n - 2 + m] if n > 2 else np.zeros(m, dtype=bool)
            keep = ~inside if n > 1 else ~blank
            found.append(code[keep])
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(codes(text), return_counts=True)


def top_codes(text: str, k: int = OF_TEXT) -> np.ndarray:
    """The text's most frequent n-grams, most frequent first; ties by code."""
    code, n = counted(text)
    return code[np.lexsort((code, -n))[:k]]


class _Sums:
    """Counts by code, kept sorted; merged when the pieces at hand are many."""

    def __init__(self):
        self.codes, self.counts, self.size = [], [], 0

    def add(self, code: np.ndarray, n: np.ndarray) -> None:
        self.codes.append(code)
        self.counts.append(n)
        self.size += len(code)

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.codes:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        code, inverse = np.unique(np.concatenate(self.codes), return_inverse=True)
        n = np.bincount(inverse, weights=np.concatenate(self.counts)).astype(np.int64)
        self.codes, self.counts, self.size = [code], [n], len(code)
        return code, n


def profiles(rows: DataFrame, k: int = PROFILE) -> DataFrame:
    """lang, code, n, rank (0 is the most frequent) from rows of lang (not null) and text."""

    def count(batches):
        sums: dict[str, _Sums] = {}

        def flush():
            for lang, s in sums.items():
                code, n = s.merge()
                for at in range(0, len(code), 50_000):
                    part = code[at : at + 50_000].view(np.int64)
                    yield {"lang": [lang] * len(part), "code": part, "n": n[at : at + 50_000]}
            sums.clear()

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                s = sums.setdefault(lang, _Sums())
                s.add(*counted(text))
                if s.size > 2 * HELD:
                    s.merge()
            if sum(s.size for s in sums.values()) > 4 * HELD:
                for s in sums.values():
                    s.merge()
                if sum(s.size for s in sums.values()) > HELD:
                    yield from flush()
        yield from flush()

    source = rows.select(F.col("lang").cast("string"), letters_only(whole_text()).alias("text"))
    total = map_batches(source, "lang string, code long, n long", count).groupBy("lang", "code").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    # the limit stands on the row number itself, so every task cuts its own n-grams before they meet
    return total.withColumn("rank", rank).where(F.col("rank") <= k).withColumn("rank", F.col("rank") - 1)


class Compared:
    """Out-of-place distances to all profiles at once."""

    def __init__(self, rows: list[tuple[str, int, int]], k: int = PROFILE):
        self.langs = sorted({lang for lang, _, _ in rows})
        at = {lang: i for i, lang in enumerate(self.langs)}
        self.codes = np.unique(np.array([code for _, code, _ in rows], dtype=np.int64).view(np.uint64))
        self.ranks = np.full((len(self.codes) + 1, len(self.langs)), -1, dtype=np.int64)
        for lang, code, rank in rows:
            self.ranks[np.searchsorted(self.codes, np.uint64(code % 2**64)), at[lang]] = rank
        self.k = k

    def best(self, text: str) -> tuple[str, float]:
        """The nearest language (first by name in a tie), and 1 minus its distance over the longest possible."""
        top = top_codes(text)
        if not len(top) or not self.langs:
            return UNKNOWN, 0.0
        place = np.searchsorted(self.codes, top)
        place[place == len(self.codes)] = 0
        place = np.where(self.codes[place] == top, place, len(self.codes))
        ranks = self.ranks[place]
        apart = np.where(ranks < 0, self.k, np.abs(ranks - np.arange(len(top))[:, None])).sum(axis=0)
        i = int(np.argmin(apart))
        return self.langs[i], 1.0 - float(apart[i]) / (self.k * len(top))


def identify(docs: DataFrame, learned: DataFrame, carried: list[str]) -> DataFrame:
    """Per row of ``docs``: the columns in ``carried``, lang_pred and score.

    ``learned``: profiles. They come to the driver once: languages times PROFILE rows.
    Texts that are null or hold no letter give ``und`` and 0, and so does everything if nothing was learned.
    """
    compared = Compared([(r.lang, r.code, r["rank"]) for r in learned.collect()])

    def rows(batches):
        for batch in batches:
            found = [compared.best(t) if has else (UNKNOWN, 0.0) for t, has in zip(batch["_text"], batch["_letters"])]
            yield {**{c: batch[c] for c in carried}, "lang_pred": [x for x, _ in found], "score": [s for _, s in found]}

    source = docs.select(*carried, letters_only(whole_text()).alias("_text"), whole_text().rlike(r"\p{L}").alias("_letters"))
    fields = ", ".join(f"{source.schema[c].name} {source.schema[c].dataType.simpleString()}" for c in carried)
    return map_batches(source, f"{fields}, lang_pred string, score double", rows)


def predicted(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score; profiles come from the rows that are not held out and have a language."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.col("lang").cast("string"), held_out.alias("held_out"))
    learned = settle(profiles(rows.where("NOT held_out AND lang IS NOT NULL")))
    return identify(rows.drop("lang"), learned, ["doc_id", "held_out"])
