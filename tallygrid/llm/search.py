"""Ranked lexical search over bit-sliced Bloom signatures (operator 12).

Index. Documents of similar size form blocks of up to ``BLOCK`` rows. A document's signature is a
Bloom filter of its terms; a block stores it sliced: for every bit of the signature a bitmap over
the block's documents. A term is filed once for each level of its frequency that it reaches (once,
twice, three times, ...), so the filter bounds a frequency from above, too. The lexicon counts the
documents of every term.

Search. The bitmaps of a term's bits, intersected, name all documents that may hold it, and some
more. Weighted sums of these slices bound every document's score from above; the sums are exact
integers, so the bound never falls below the score. The documents of highest bound are scored
exactly first: the tenth score found is a floor for the answer. Then every document whose bound
reaches the floor is scored exactly, so nothing that belongs to the answer is excluded.

Scale. The index has about twelve bits per term and document and is read instead of the texts. Items
come in blocks of at most ``ITEM_BYTES`` text; a block's terms and floors are broadcast. Only texts
of documents that are not excluded are read again. Nothing is gathered per item except the best
``FIRST`` bounds a task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallygrid.llm.common import map_arrow, settle, whole_text
from tallygrid.session import scratch_path

#: Results per item, and documents of highest bound per item that are scored to find the floor.
BEST, FIRST = 10, 24
#: Frequencies at which a term is filed once more; the last bounds nothing.
LEVELS = (1, 2, 3, 4, 5, 7, 10, 15)
HASHES, BITS_PER_ENTRY = 4, 12
#: Documents of a block, and most bytes of its slices.
BLOCK, BLOCK_BYTES = 512, 4 << 20
#: Signature widths grow by this factor from class to class.
GROWTH = 1.25
#: Terms that a task counts or remembers before it passes them on.
HELD = 300_000
#: Most bytes of item text in a block of items.
ITEM_BYTES = 1 << 20
#: Pairs of document and item that are broadcast to the texts; more of them meet the texts by an ordinary join.
BROADCAST_PAIRS = 200_000

# Fixed value: characters of a term are ASCII letters and digits and all beyond ASCII; A-Z count as a-z.
_FOLD = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256)).lower()

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def terms(text: str) -> list[bytes]:
    """Terms as UTF-8, in order. No byte of a character beyond ASCII is below 128, so bytes can be told one by one."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def entries(hashes: np.ndarray, level: int) -> np.ndarray:
    x = hashes + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def places(found: np.ndarray, width: int) -> np.ndarray:
    """(HASHES, n) bits of entries in a signature of ``width`` bits."""
    step = (found >> np.uint64(32)) | np.uint64(1)
    return np.stack([(found + np.uint64(k) * step) % np.uint64(width) for k in range(HASHES)]).astype(np.int64)


def width_class(n: int) -> int:
    """The class whose width suits ``n`` entries."""
    return max(0, math.ceil(math.log(max(n, 8) * BITS_PER_ENTRY / 96, GROWTH)))


def width_of(c: int) -> int:
    return math.ceil(96 * GROWTH**c)


# ------------------------------------------------------------------ index

INDEX = "kind byte, term binary, df long, width int, rows int, keys binary, bits binary"
LEXICON, SLICES = 0, 1


def keyed(docs: DataFrame) -> DataFrame:
    """(none, doc_id, h, text): keys of rows without nulls."""
    text = whole_text()
    return docs.select(F.col("doc_id").isNull().cast("long").alias("none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))


class Blocks:
    """Documents by width class; a full class becomes a block."""

    def __init__(self):
        self.open: dict[int, list[tuple]] = {}

    def add(self, key: tuple, hashes: np.ndarray, counts: np.ndarray) -> dict | None:
        found = np.concatenate([entries(hashes[counts >= least], level) for level, least in enumerate(LEVELS)])
        c = width_class(len(found))
        held = self.open.setdefault(c, [])
        held.append((key, found))
        return self.close(c) if len(held) >= min(BLOCK, max(8, BLOCK_BYTES * 8 // width_of(c))) else None

    def close(self, c: int) -> dict:
        held, width = self.open.pop(c), width_of(c)
        bits = np.zeros((width, len(held)), dtype=bool)
        for at, (_, found) in enumerate(held):
            bits[places(found, width).ravel(), at] = True
        keys = np.array([key for key, _ in held], dtype=np.int64)
        return {"kind": [SLICES], "term": [None], "df": [None], "width": [width], "rows": [len(held)], "keys": [keys.tobytes()], "bits": [np.packbits(bits, axis=1).tobytes()]}


def index(docs: DataFrame, path: str) -> str:
    """Writes the index of ``docs`` below ``path``: the lexicon (term, df) and the sliced signatures, in one pass over the texts."""

    def rows(batches: Iterator[pa.RecordBatch]):
        blocks, df, known = Blocks(), Counter(), {}

        def counted():
            out = {"term": list(df), "df": list(df.values())}
            df.clear()
            n = len(out["term"])
            return out | {"kind": [LEXICON] * n, "width": [None] * n, "rows": [None] * n, "keys": [None] * n, "bits": [None] * n}

        for batch in batches:
            for none, doc_id, h, text in zip(*(batch.column(k).to_pylist() for k in ("none", "doc_id", "h", "text"))):
                found = terms(text)
                if not found:
                    continue
                tf = Counter(found)
                df.update(tf.keys())
                if len(known) > HELD:
                    known.clear()
                for t in set(tf).difference(known):
                    known[t] = xxhash.xxh3_64_intdigest(t)
                hashes = np.fromiter(map(known.__getitem__, tf), dtype=np.uint64, count=len(tf))
                counts = np.fromiter(tf.values(), dtype=np.int64, count=len(tf))
                if block := blocks.add((none, doc_id, h, len(found)), hashes, counts):
                    yield block
                if len(df) > HELD:
                    yield counted()
        for c in list(blocks.open):
            yield blocks.close(c)
        yield counted()

    found = map_arrow(keyed(docs), INDEX, rows)
    found.write.partitionBy("kind").parquet(path)
    return path


@dataclass
class Corpus:
    """An index and its totals: documents with a term (N) and all their terms (L)."""

    lexicon: DataFrame
    slices: DataFrame
    n: int
    length: int


def opened(spark: SparkSession, path: str) -> Corpus:
    stored = spark.read.schema(INDEX).parquet(path)
    lexicon = stored.where(F.col("kind") == LEXICON).groupBy("term").agg(F.sum("df").alias("df"))
    slices = stored.where(F.col("kind") == SLICES).select("width", "rows", "keys", "bits")

    def totals(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            sizes = [np.frombuffer(k, dtype=np.int64).reshape(-1, 4)[:, 3] for k in batch.column("keys").to_pylist()]
            yield {"n": [sum(map(len, sizes))], "length": [int(sum(s.sum() for s in sizes))]}

    head = map_arrow(slices.select("keys"), "n long, length long", totals).agg(F.sum("n"), F.sum("length")).head()
    return Corpus(lexicon, slices, head[0] or 0, head[1] or 0)


# ------------------------------------------------------------------ scores


class Items:
    """A block of items: their terms with weights, and what scores need of the corpus."""

    def __init__(self, found: list[list[bytes]], df: dict[bytes, int], n: int, length: int):
        self.n, self.length, self.size = n, length, len(found)
        weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for t, x in df.items()}
        self.terms = [[(t, weight[t] * times) for t, times in sorted(Counter(f).items()) if t in weight] for f in found]
        vocabulary = sorted({t for own in self.terms for t, _ in own})
        number = {t: i for i, t in enumerate(vocabulary)}
        self.hashes = np.array([xxhash.xxh3_64_intdigest(t) for t in vocabulary], dtype=np.uint64)
        self.own = [(np.array([number[t] for t, _ in own], dtype=np.int64), np.array([w for _, w in own], dtype=np.float64)) for own in self.terms]

    def norm(self, size):
        """m of a document (or an array of them) with ``size`` terms."""
        return 100 - 75 + (75 * size * self.n) // self.length

    def score(self, item: int, tf: dict[bytes, int], m: int) -> int:
        return sum(w * ((1_000_000_000 * f) // (1000 * f + 8 * m)) for t, w in self.terms[item] if (f := tf.get(t)))

    def bounds(self, width: int, keys: np.ndarray, bits: bytes) -> np.ndarray:
        """(items, documents) of a block: no score is above its bound."""
        rows = len(keys)
        slices = np.frombuffer(bits, dtype=np.uint8).reshape(width, -1)
        m = self.norm(keys[:, 3])
        out, before, there = np.zeros((self.size, rows)), np.zeros(rows), None
        for level, least in enumerate(LEVELS):
            held = np.bitwise_and.reduce(slices[places(entries(self.hashes, level), width)], axis=0)
            there = held if there is None else there & held
            if not there.any():
                break
            if level + 1 < len(LEVELS):
                most = LEVELS[level + 1] - 1
                value = ((1_000_000_000 * most) // (1000 * most + 8 * m)).astype(np.float64)
            else:
                value = np.full(rows, 1_000_000.0)
            gain, before = value - before, value
            some = there.any(axis=1)
            held = np.unpackbits(there, axis=1, count=rows)
            for item, (own, weights) in enumerate(self.own):
                use = some[own]
                if use.any():
                    out[item] += (weights[use] @ held[own[use]].astype(np.float64)) * gain
        return out


def _blocks(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for width, keys, bits in zip(*(batch.column(k).to_pylist() for k in ("width", "keys", "bits"))):
            yield width, np.frombuffer(keys, dtype=np.int64).reshape(-1, 4), bits


PAIRS = "item int, bound double, none long, doc_id long, h long"


def hopeful(corpus: Corpus, items, best: int) -> DataFrame:
    """Per item the documents of highest bound."""

    def rows(batches: Iterator[pa.RecordBatch]):
        own = items.value
        bounds, keys = np.zeros((own.size, 0)), np.zeros((own.size, 0, 3), dtype=np.int64)
        for width, found, bits in _blocks(batches):
            bounds = np.concatenate((bounds, own.bounds(width, found, bits)), axis=1)
            keys = np.concatenate((keys, np.broadcast_to(found[None, :, :3], (own.size, len(found), 3))), axis=1)
            if bounds.shape[1] > best:
                top = np.argpartition(-bounds, best - 1, axis=1)[:, :best]
                bounds, keys = np.take_along_axis(bounds, top, 1), np.take_along_axis(keys, top[:, :, None], 1)
        use = bounds > 0
        found = keys[use]
        yield {"item": np.nonzero(use)[0].astype(np.int32), "bound": bounds[use], "none": found[:, 0], "doc_id": found[:, 1], "h": found[:, 2]}

    first = Window.partitionBy("item").orderBy(F.desc("bound"), "none", "doc_id", "h")
    return map_arrow(corpus.slices, PAIRS, rows).withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= best).drop("nth")


def not_excluded(corpus: Corpus, items, floors) -> DataFrame:
    """All pairs of an item and a document whose bound reaches the item's floor."""

    def rows(batches: Iterator[pa.RecordBatch]):
        own, least = items.value, np.maximum(floors.value, 1)[:, None]
        for width, found, bits in _blocks(batches):
            bounds = own.bounds(width, found, bits)
            item, at = np.nonzero(bounds >= least)
            yield {"item": item.astype(np.int32), "bound": bounds[item, at], "none": found[at, 0], "doc_id": found[at, 1], "h": found[at, 2]}

    return map_arrow(corpus.slices, PAIRS, rows)


def scored(docs: DataFrame, pairs: DataFrame, items, best: int) -> DataFrame:
    """(item, none, doc_id, score): the best exact scores above 0 among the pairs."""
    pairs = settle(pairs.select("item", "none", "doc_id", "h"))
    n = pairs.count()
    wanted = pairs.groupBy("none", "doc_id", "h").agg(F.collect_set("item").alias("items"))  # at most a block of items
    texts = keyed(docs).join(F.broadcast(wanted) if n <= BROADCAST_PAIRS else wanted, ["none", "doc_id", "h"])

    def rows(batches: Iterator[pa.RecordBatch]):
        own = items.value
        for batch in batches:
            out = {"item": [], "none": [], "doc_id": [], "score": []}
            for none, doc_id, text, asked in zip(*(batch.column(k).to_pylist() for k in ("none", "doc_id", "text", "items"))):
                found = terms(text)
                tf, m = Counter(found), own.norm(len(found))
                for item in asked:
                    if score := own.score(item, tf, m):
                        out["item"].append(item)
                        out["none"].append(none)
                        out["doc_id"].append(doc_id)
                        out["score"].append(score)
            yield out

    first = Window.partitionBy("item").orderBy(F.desc("score"), "none", "doc_id")
    found = map_arrow(texts, "item int, none long, doc_id long, score long", rows)
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= best)


def blocks_of(items: DataFrame, most: int = ITEM_BYTES) -> Iterator[list[tuple]]:
    """Rows of (item_id, text) in blocks of at most ``most`` characters (or one item)."""
    block, size = [], 0
    for row in items.select("item_id", whole_text().alias("text")).toLocalIterator():
        if block and size + len(row.text) > most:
            yield block
            block, size = [], 0
        block.append((row.item_id, row.text))
        size += len(row.text)
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, best: int = BEST, path: str | None = None) -> DataFrame:
    """(item_id, rank, doc_id, score): for every row of ``items`` the ``best`` documents of highest score above 0.

    ``path`` is an index that ``index`` has written of ``docs``; without one it is written first, to the shared folder.
    Equal scores rank by ascending doc_id, null ids last. Null and empty texts hold no term: such documents are never
    found, such items find nothing. Every row of ``docs`` is a document and every row of ``items`` an item, repeated
    ones, too. Empty tables give an empty result; further columns are ignored.
    """
    spark = docs.sparkSession
    corpus = opened(spark, path or index(docs, scratch_path(spark, "signatures")))
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in blocks_of(items):
        found = [terms(text) for _, text in block]
        asked = spark.createDataFrame([(t,) for t in {t for own in found for t in own}], "term binary")
        df = {bytes(r.term): r.df for r in asked.join(corpus.lexicon, "term").collect()}  # the terms of one block of items
        if not df:
            continue
        own = spark.sparkContext.broadcast(Items(found, df, corpus.n, corpus.length))
        floor = np.zeros(len(block))
        for r in scored(docs, hopeful(corpus, own, max(FIRST, best)), own, best).where(F.col("rank") == best).collect():
            floor[r.item] = r.score
        ranked = scored(docs, not_excluded(corpus, own, spark.sparkContext.broadcast(floor)), own, best)
        names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], f"item int, item_id {kind}")
        shown = ranked.join(F.broadcast(names), "item")
        out = out.unionByName(shown.select("item_id", "rank", F.when(F.col("none") == 0, F.col("doc_id")).alias("doc_id"), "score"))
    return out
