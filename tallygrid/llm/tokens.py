"""Token counts by overlap resynchronisation (operator 10).

Short texts are encoded in one call. A text longer than ``chunk`` bytes or so is
encoded in overlapping chunks with offsets, and neighbouring chunks are spliced
at a boundary inside their overlap that is

* a token boundary of both encodings, and
* proven stable: no vocabulary piece holds a white-space mark behind another
  character, so no merge ever crosses from a character to the white space after
  it, and the tokens on either side of such a place do not depend on the other.

If an overlap holds no such place (a very long run without white space), the
left chunk is encoded again with twice the overlap, up to the whole rest. The
result always equals one call on the whole text.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, functions as F

from tallygrid.llm.common import map_batches, whole_text

CHUNK = 32_768
OVERLAP = 1_024
LIMIT = 4_096
MARK = "▁"  # the vocabulary's white-space mark


@lru_cache(maxsize=2)
def model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=2)
def stable_before_space(path: str) -> bool:
    """True if no piece holds the white-space mark behind another character."""
    sp = model(path)
    return not any(MARK in sp.id_to_piece(i).lstrip(MARK) for i in range(sp.get_piece_size()))


def _offsets(sp, chunk: bytes) -> list[tuple[int, int]]:
    """(begin, end) of a chunk's tokens, in bytes."""
    return [(p.begin, p.end) for p in sp.encode(chunk.decode(), return_type="proto").pieces]


def _stable(text: bytes, j: int) -> bool:
    """Is j a blank right behind another character than a blank or the mark?"""
    return text[j] == 32 and text[j - 1] != 32 and text[max(j - len(MARK.encode()), 0) : j] != MARK.encode()


def _char(text: bytes, at: int) -> int:
    """The nearest start of a character at or before a byte."""
    while at < len(text) and text[at] & 0xC0 == 0x80:
        at -= 1
    return at


def splice_counts(encode, text: bytes, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a UTF-8 text, from chunks. ``encode`` gives the (begin, end) offsets of a chunk's tokens.

    ``begin`` is where the current chunk starts, ``base`` from where its tokens count.
    """
    n, total, begin, base = len(text), 0, 0, 0
    end = _char(text, min(chunk, n))
    tokens = encode(text[:end])
    while True:
        wide = overlap
        while end < n:
            after = _char(text, max(end - wide, base))
            until = _char(text, min(after + max(chunk, 2 * wide), n))
            follower = encode(text[after:until])
            left, right = {b + begin for b, _ in tokens}, {b + after for b, _ in follower}
            middle = (after + end) // 2
            places = (j for j in left & right if after < j < end and j > base and _stable(text, j))
            place = min(places, key=lambda j: (abs(j - middle), j), default=None)
            if place is not None:
                break
            wide *= 2  # no stable place: the left chunk grows, and with it the overlap
            end = _char(text, min(end + wide, n))
            tokens = encode(text[begin:end])
        if end == n:
            return total + sum(1 for b, _ in tokens if b + begin >= base)
        total += sum(1 for b, _ in tokens if base <= b + begin < place)
        begin, base, end, tokens = after, place, until, follower


def counter(path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
    """Function from a list of texts to their token counts."""

    def count(texts: list[str]) -> list[int]:
        sp = model(path)
        spliced = stable_before_space(path)
        short = [t for t in texts if len(t) <= chunk or not spliced]
        plain = iter(sp.encode(short, num_threads=1) if short else [])
        return [
            len(next(plain)) if len(t) <= chunk or not spliced else splice_counts(lambda x: _offsets(sp, x), t.encode(), chunk, overlap)
            for t in texts
        ]

    return count


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Null and empty texts have no tokens. Rows are independent: repeated rows and null ids
    stay as they are, an empty table gives an empty result, other columns are not read.
    """
    count = counter(path, chunk, overlap)

    def rows(batches):
        for batch in batches:
            tokens = count(batch["text"])
            yield {
                "doc_id": batch["doc_id"], "n_bytes": [len(t.encode()) for t in batch["text"]],
                "n_tokens": tokens, "over_limit": [n > limit for n in tokens],
            }

    source = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    return map_batches(source, "doc_id long, n_bytes long, n_tokens long, over_limit boolean", rows)
