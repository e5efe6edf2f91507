"""Mixing sources to target weights by cube-method balanced sampling (operator 3).

A source with target t and size s is taken t / s times: every document gets the whole part of
that as copies, and the fraction is the inclusion probability of one more. Which documents
get one more is a balanced sample: the flight phase moves the probabilities of three undecided
documents at a time along the null space of the two balancing equations (words and
documents), so both totals stay exactly as they are, until one probability is 0 or 1. When
fewer than three are undecided, they land: of all ways to decide them, the one nearest to
the word total is taken.

Scale: a flight runs through one bucket of a source, in order, and holds three documents. Buckets
(by a hash of the document) leave at most two undecided each, which fly on in fewer,
wider buckets, and at last in one per source: a source with a third of all rows is ``BUCKETS``
flights, not one, and no step sees more than ``2 * FAN`` rows of a source after the first.
Numbers that look random come from the bucket's name, so reruns agree, however Spark deals
the rows out. The targets follow from a level that is found by sums over the sources; no list of sources
reaches the driver.
"""

from __future__ import annotations

import itertools
import random

from pyspark.sql import DataFrame, functions as F

from tallygrid.llm.common import WORD, map_batches, one_row_each, row_key, settle, whole_text
from tallygrid.operators.numbering import with_index

# The weights of sources, by code point, repeating; the most that a source is taken.
WEIGHTS = (1, 2, 3)
MOST = 3
BUCKETS, FAN = 4_096, 64
#: Targets are broadcast up to so many sources; beyond, they meet the documents by an ordinary join.
BROADCAST_SOURCES = 10_000
_EPS = 1e-9


def sized(docs: DataFrame, id_type: str = "long") -> DataFrame:
    """(doc_id, source, size): the number of words, null as none."""
    return docs.select(
        F.col("doc_id").cast(id_type), F.col("source").cast("string"), F.regexp_count(whole_text(), F.lit(WORD)).cast("long").alias("size")
    )


def plan(units: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(key, source_size, target, copies, p) per source; ``key`` is the source as text that a null has too.

    All words are shared by weight; a source that would get more than ``most`` times its own stops there, and the
    excess is shared again. So a target is the source's weight times one level, or its limit if that is less. The level
    rises until no further source stops; only sums reach the driver, however many sources there are.
    """
    sources = units.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = with_index(sources.withColumn("none", F.col("source").isNull()), ["none", "source"], "place", 0)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = settle(ordered.select("source", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * most).alias("limit")))
    total = weighed.agg(F.sum("source_size")).head()[0] or 0
    level, before = 0.0, -1
    while True:
        stops = F.col("limit") < F.lit(level) * F.col("weight")
        n, stopped, free = weighed.agg(F.count(F.when(stops, 1)), F.sum(F.when(stops, F.col("limit"))), F.sum(F.when(~stops, F.col("weight")))).head()
        if n == before or not free:
            break
        level, before = (total - (stopped or 0)) / free, n
    target = F.least(F.col("limit").cast("double"), F.lit(level) * F.col("weight"))
    ratio = F.when(F.col("source_size") > 0, F.least(target / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    copies = F.floor(ratio + _EPS)
    p = ratio - copies
    return weighed.select(
        _key().alias("key"), "source_size", target.alias("target"), copies.cast("int").alias("copies"), F.when(p > _EPS, p).otherwise(0.0).alias("p"))


def _key():
    return F.to_json(F.struct(F.col("source")))


class Flight:
    """Moves three undecided units at a time; ``held`` are the undecided ones, as [p, size, id]."""

    def __init__(self, name: str):
        self.random, self.held = random.Random(name), []

    def add(self, p: float, size: int, doc_id: int | None) -> list[list]:
        """The units that are decided by now, p at 0 or 1."""
        if p <= _EPS or p >= 1 - _EPS:
            return [[round(p), size, doc_id]]
        self.held.append([p, size, doc_id])
        decided = []
        while len(self.held) == 3 or len(self.held) == 2 and self.held[0][1] == self.held[1][1]:
            decided += self._move()
        return decided

    def _move(self) -> list[list]:
        """One step along the null space of (size, 1): both totals stay as they are."""
        size = [u[1] for u in self.held]
        if len(size) == 2 or size[0] == size[1] == size[2]:
            step = [1, -1, 0][: len(size)]
        else:
            step = [size[1] - size[2], size[2] - size[0], size[0] - size[1]]
        p = [u[0] for u in self.held]
        up = min((1 - x) / s if s > 0 else -x / s for x, s in zip(p, step) if s)
        down = min(x / s if s > 0 else (x - 1) / s for x, s in zip(p, step) if s)
        by = up if self.random.random() * (up + down) < down else -down
        for u, s in zip(self.held, step):
            u[0] += by * s
        decided = [[round(u[0]), u[1], u[2]] for u in self.held if u[0] <= _EPS or u[0] >= 1 - _EPS]
        self.held = [u for u in self.held if _EPS < u[0] < 1 - _EPS]
        return decided

    def land(self) -> list[list]:
        """The decision for what is left (two units at most) that is nearest to the word total, then to the count."""
        ways = itertools.product((0, 1), repeat=len(self.held))
        miss = lambda way, k: abs(sum((w - u[0]) * (u[1] if k else 1) for w, u in zip(way, self.held)))
        best = min(ways, key=lambda way: (round(miss(way, 1), 6), round(miss(way, 0), 6), way))
        return [[w, u[1], u[2]] for w, u in zip(best, self.held)]


def fly(units: DataFrame, buckets: int, land: bool = False) -> DataFrame:
    """One flight per source and bucket over rows of (key, h, doc_id, size, p); the same columns, most p at 0 or 1."""
    placed = units.withColumn("bucket", F.pmod("h", F.lit(buckets)))
    ordered = placed.repartition("key", "bucket").sortWithinPartitions("key", "bucket", "doc_id", "size", "p")

    def rows(batches):
        name, flight = None, None

        def fields(key, bucket, done):
            return [(key, bucket, d, s, float(p)) for p, s, d in done]

        for batch in batches:
            out = []
            for key, h, doc_id, size, p, bucket in zip(*(batch[k] for k in ("key", "h", "doc_id", "size", "p", "bucket"))):
                if (key, bucket) != name:
                    if flight:
                        out += fields(*name, flight.land() if land else flight.held)
                    name, flight = (key, bucket), Flight(f"{buckets}:{bucket}:{key}")
                out += fields(key, bucket, flight.add(p, size, doc_id))
            yield _columns(out)
        if flight:
            yield _columns(fields(*name, flight.land() if land else flight.held))

    return map_batches(ordered, f"key string, h long, doc_id {units.schema['doc_id'].dataType.simpleString()}, size long, p double", rows)


def _columns(rows: list[tuple]) -> dict[str, list]:
    return dict(zip(("key", "h", "doc_id", "size", "p"), map(list, zip(*rows)))) if rows else {k: [] for k in ("key", "h", "doc_id", "size", "p")}


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, id_type: str = "long") -> DataFrame:
    """Per row of ``docs``: doc_id, source, size, source_size, target, taken (words, repeats counted).

    A null source is a source of its own, last in order. Documents without words are never
    taken (taken is 0). Repeated rows are documents of their own; an empty table gives an empty result.
    """
    units = settle(sized(docs, id_type))
    plans = plan(units, weights, most)
    small = plans.count() <= BROADCAST_SOURCES
    named = units.withColumn("key", _key())
    placed = named.join(F.broadcast(plans) if small else plans, "key")
    flying = (F.col("p") > 0) & (F.col("size") > 0)
    state = placed.where(flying).select("key", F.xxhash64("doc_id", "size").alias("h"), "doc_id", "size", "p")
    decided = []
    for buckets in (BUCKETS, FAN, 1):
        flown = settle(fly(state, buckets, land=buckets == 1))
        undecided = (F.col("p") > 0) & (F.col("p") < 1)
        decided.append(flown.where(~undecided))
        state = flown.where(undecided)
    extra = decided[0].unionByName(decided[1]).unionByName(decided[2]).select("key", "doc_id", "size", F.col("p").alias("more"))
    rest = placed.where(~flying).select("key", "doc_id", "size", F.lit(0.0).alias("more"))
    every = extra.unionByName(rest)
    return every.join(F.broadcast(plans) if small else plans, "key").select(
        "doc_id", F.get_json_object("key", "$.source").alias("source"), "size", "source_size", "target",
        (F.col("size") * (F.col("copies") + F.col("more"))).cast("long").alias("taken"),
    )


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix itself: the rows of ``docs`` as often as the mix takes them, with their number (``copy``), size, source_size and target.

    Documents that are not taken, and those without words, are left out. Rows with equal doc_id, text and
    source are interchangeable: what the mix takes of them comes as copies of one. Where ``docs`` has a column of
    such a name already, the added one gets underscores.
    """
    identity = ("doc_id", "text", "source")
    units = docs.select(row_key(*identity).alias("doc_id"), "text", "source")
    taken = mix(units, weights, most, "string").where("size > 0").groupBy(F.col("doc_id").alias("row")).agg(
        F.count("*").alias("n"), F.sum(F.expr("taken div size")).alias("times"),
        *[F.any_value(c).alias(f"mix_{c}") for c in ("size", "source_size", "target")],
    )
    return one_row_each(docs, settle(taken.where("times > 0")), identity, times=True)
