"""Statistics of one text, by vectorised counting; shared by quality rules and the quality classifier."""

from __future__ import annotations

import itertools
import re

import numpy as np

from tallygrid.llm.common import words

# Fixed value: the symbols that are counted.
SYMBOLS = "#*$%&|<>"
_WHITE = " \t\n\x0b\x0c\r"


def repeated_words(ids: np.ndarray) -> int:
    """Words inside a 3-word window that is found twice or more, the first one included."""
    if len(ids) < 4:
        return 0
    size = np.int64(ids.max()) + 1
    if size < 2_000_000:
        keys = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
    else:  # too many different words for one integer: number the pairs first
        pair = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)[1].astype(np.int64)
        keys = pair[:-1] * size + ids[2:]
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    covered = np.zeros(len(ids), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def numbered(tokens: list[bytes]) -> np.ndarray:
    """Words as numbers by first occurrence."""
    index = dict(zip(dict.fromkeys(tokens), itertools.count()))
    return np.fromiter(map(index.__getitem__, tokens), dtype=np.int64, count=len(tokens))


def counts(text: str) -> dict[str, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and n_distinct words."""
    tokens = words(text)
    ids = numbered(tokens)
    lines = [x for x in text.split("\n") if x.strip(_WHITE)] if "\n" in text else []
    return {
        "n_words": len(tokens),
        "word_chars": len(text) - sum(map(text.count, _WHITE)),
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated_words(ids),
        "n_distinct": int(ids.max()) + 1 if len(ids) else 0,
    }


_CLASSES = (
    ("upper", re.compile(r"[A-ZÀ-ÖØ-Þ]")),
    ("digit", re.compile(r"[0-9]")),
    ("stop", re.compile(r"[.!?]")),
    ("comma", re.compile(r"[,;:]")),
    ("loud", re.compile(r"!")),
    ("bar", re.compile(r"\|")),
)


def shape(text: str) -> dict[str, int]:
    """Characters of a few classes, lines, and characters outside of letters."""
    out = {name: len(pattern.findall(text)) for name, pattern in _CLASSES}
    return out | {"lines": text.count("\n") + 1}


def ratios(c: dict[str, int], s: dict[str, int]) -> list[float]:
    """Variance-stabilised statistics: arcsine roots of shares, logs of means."""
    n, chars = max(c["n_words"], 1), max(c["word_chars"], 1)
    share = lambda k, of: float(np.arcsin(np.sqrt(min(1.0, k / max(of, 1)))))
    return [
        float(np.log(chars / n)),
        share(c["n_symbols"], chars),
        share(c["n_repeat_words"], n),
        share(c["n_dup_lines"], s["lines"]),
        share(s["upper"], chars),
        share(s["digit"], chars),
        share(s["stop"], chars),
        share(s["comma"], chars),
        share(s["loud"] + s["bar"], chars),
        float(np.log(max(c["n_distinct"], 1)) / max(np.log(n), 1.0)) if n > 1 else 1.0,
    ]


RATIOS = (
    "log_word_length", "symbols", "repeats", "dup_lines", "upper", "digits", "stops", "commas", "loud", "variety",
)
