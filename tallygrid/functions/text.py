"""Text functions on columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def path_part(path: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(path, pattern, group)


def strip_word(c: Column, word: str) -> Column:
    """Remove every occurrence of a word, then collapse the blanks it leaves."""
    pieces = F.split(F.replace(c, F.lit(word), F.lit("")), " ", -1)
    return F.array_join(F.filter(pieces, lambda p: p != ""), " ")


def padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def joined(*parts: Column) -> Column:
    """Concatenate; an empty part counts as an empty text."""
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def standardise(c: Column, mapping: Mapping[str, Sequence[str]]) -> Column:
    """Map spelling variants to one label; unknown spellings become empty."""
    result = None
    for label, variants in mapping.items():
        test = c.isin(list(variants))
        result = F.when(test, F.lit(label)) if result is None else result.when(test, F.lit(label))
    return F.lit(None).cast("string") if result is None else result


def same_text(a: Column, b: Column | str) -> Column:
    """Equality that ignores case, as text comparison does in metrics."""
    other = F.lit(b) if isinstance(b, str) else b
    return F.lower(a) == F.lower(other)
