"""SimHash near-duplicates with pigeonring filtering (operator 6).

A text's fingerprint has 64 bits: a bit is set if it is set in over half of the hashes of
the text's shingles. Two fingerprints link if they differ in at most ``distance`` bits.

Candidates. The fingerprint is a ring of ``distance + 1`` segments. By the pigeonring
principle, two linked fingerprints have a segment from which every chain of consecutive
segments stays within its proportional budget: no difference in the first, at most one in
the first two, two in three, and so on. So each different fingerprint is filed once per
segment and bit of the following segment, under the first segment's bits and the following
segment's with that bit masked: whoever meets there fulfils the budgets of the first two
segments, and longer chains are tried before the full Hamming check. Keys have 25 of 64
bits, so unrelated fingerprints rarely meet.

Groups. Exact copies share a fingerprint and are one entry, however many they are. Within
a bucket links are found breadth-first: a fingerprint that is reached is not compared
again, so a dense group of n fingerprints gives at most n - 1 links, never all pairs, and
no connection is lost. Components come from alternating large-star and small-star steps.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tallygrid.llm.common import lower_words, map_batches, one_row_each, row_key, settle, whole_text

BITS, DISTANCE, SHINGLE, SEED = 64, 4, 4, 42


# ------------------------------------------------------------------ fingerprints


def shingles(text: str, size: int = SHINGLE) -> list[bytes]:
    """Space-joined runs of ``size`` words; a text with fewer words is one shingle, one without words has none."""
    w = lower_words(text)
    if len(w) < size:
        return [b" ".join(w)] if w else []
    return list(map(b" ".join, zip(*[w[i:] for i in range(size)])))


def fingerprint(found: list[bytes], seed: int = SEED) -> int:
    """SimHash as a signed 64-bit integer; 0 without shingles."""
    if not found:
        return 0
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, seed) for s in found), dtype=np.uint64, count=len(found))
    set_in = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        set_in += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(set_in * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def with_fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, row, fp) per row; ``row`` is the row's key."""

    def rows(batches):
        for batch in batches:
            yield {"doc_id": batch["doc_id"], "row": batch["row"], "fp": [fingerprint(shingles(t, size)) for t in batch["text"]]}

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key("doc_id", "text").alias("row"), whole_text().alias("text"))
    return map_batches(source, "doc_id long, row string, fp long", rows)


# ------------------------------------------------------------------ links


def segments(distance: int = DISTANCE) -> list[tuple[int, int]]:
    """(offset, width) of the ring's segments: as even as can be."""
    m = distance + 1
    cuts = [round(i * BITS / m) for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def filed(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(key, fp): every fingerprint under its chain heads. A key: segment, masked bit, and the bits that must agree."""
    ring = segments(distance)
    fp, keys = F.col("fp"), []

    def part(i: int) -> Column:
        offset, width = ring[i % len(ring)]
        return F.shiftrightunsigned(fp, offset).bitwiseAND(F.lit((1 << width) - 1).cast("long"))

    for i in range(len(ring)):
        follower = ring[(i + 1) % len(ring)][1]
        for bit in range(follower):
            head = F.shiftleft(part(i), follower).bitwiseOR(part(i + 1).bitwiseAND(F.lit(((1 << follower) - 1) ^ (1 << bit)).cast("long")))
            keys.append(head.bitwiseOR(F.lit((i << 5 | bit) << 50).cast("long")))
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp", *[c for c in fps.columns if c != "fp"])


def _within(one: np.uint64, many: np.ndarray, start: int, distance: int) -> np.ndarray:
    """Which of ``many`` link to ``one``: chains from ``start`` within budget, then the full distance."""
    ring = segments(distance)
    m = len(ring)
    apart = many ^ one
    good, total = np.ones(len(many), dtype=bool), np.zeros(len(many), dtype=np.int64)
    for length in range(1, m):
        offset, width = ring[(start + length - 1) % m]
        total += np.bitwise_count(apart >> np.uint64(offset) & np.uint64((1 << width) - 1))
        good &= total * m <= length * distance  # proportional budget: length * distance / m
    full = np.zeros(len(many), dtype=bool)
    full[good] = np.bitwise_count(apart[good]) <= distance
    return full


def spanned(members: np.ndarray, near_to: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Links (places in ``members``) that connect what ``near_to`` links, breadth-first; at most len(members) - 1."""
    links, rest = [], np.arange(len(members))
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            one = queue.pop()
            hit = near_to(members[one], members[rest])
            if hit.any():
                links += [(one, x) for x in rest[hit]]
                queue += list(rest[hit])
                rest = rest[~hit]
    return links


def bucket_links(members: np.ndarray, start: int, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Links between fingerprints that connect what is linked in one bucket."""
    return [(members[i], members[j]) for i, j in spanned(members, lambda one, many: _within(one, many, start, distance))]


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b), a < b as signed integers: links that connect all fingerprints within ``distance``, from distinct ``fp``."""
    ordered = filed(fps, distance).repartition("key").sortWithinPartitions("key")

    def rows(batches):
        key, held = None, []

        def pairs(k, members):
            out = bucket_links(np.concatenate(members), int(k >> 55), distance)
            return [sorted((int(np.int64(a.view(np.int64))), int(np.int64(b.view(np.int64))))) for a, b in out]

        for batch in batches:
            keys = np.array(batch["key"], dtype=np.int64)
            values = np.array(batch["fp"], dtype=np.int64).view(np.uint64)
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(keys)]))
            found = []
            # buckets of one row inside the batch need no look; the first and last may go on in other batches
            for i in np.flatnonzero((ends - starts > 1) | (starts == 0) | (ends == len(keys))):
                k, part = int(keys[starts[i]]), values[starts[i] : ends[i]]
                if k == key:
                    held.append(part)
                    continue
                if sum(map(len, held)) > 1:
                    found += pairs(key, held)
                key, held = k, [part]
            if found:
                yield {"a": [a for a, _ in found], "b": [b for _, b in found]}
        if sum(map(len, held)) > 1 and (found := pairs(key, held)):
            yield {"a": [a for a, _ in found], "b": [b for _, b in found]}

    return map_batches(ordered, "a long, b long", rows).distinct()


# ------------------------------------------------------------------ components


def components(pairs: DataFrame) -> DataFrame:
    """(node, root): for each node of (a, b) pairs, the least node that it reaches.

    Large-star and small-star steps alternate until the pairs stay the same; a step is an
    aggregation and a join on the node, which adaptive execution splits where a node is hot.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.union(edges.select("b", "a"))
        else:
            both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        least = least.repartition("w")  # an exchange of its own, so that a hot side can be split
        met = both.join(least, F.col("u") == F.col("w"))
        if large:
            out = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).union(met.select("u", "m"))
        return out.where("a <> b").distinct()

    def state(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()

    edges = settle(pairs.where("a <> b"))
    before = state(edges)
    while before[0]:
        edges = settle(star(star(edges, True), False))
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def grouped(ids: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, root, component_id) for all different fingerprints of ``ids`` (doc_id, fp): their component, and the least doc_id in it."""
    fps = settle(ids.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(settle(links(fps.select("fp"), distance)))
    rooted = fps.join(found, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = settle(rooted)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "r").repartition("r")
    return settle(rooted.join(least, F.col("root") == F.col("r")).select("fp", "root", "component_id"))


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, size: int = SHINGLE) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable).

    Texts without words have fingerprint 0 and link like others. Rows with a null id get the
    least id of their component, null if it has none. Repeated rows each give a row.
    """
    ids = settle(with_fingerprints(docs, size).select("doc_id", "fp"))
    found = grouped(ids, distance).withColumnRenamed("fp", "f")
    return ids.join(found, F.col("fp") == F.col("f"), "left").select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, distance: int = DISTANCE, size: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` without copies: of each component of linked fingerprints the row with the least doc_id stays.

    Fingerprints and links are those of ``near_duplicates``. Texts without words are copies of each other. A null
    doc_id stays only if its component has no other; of rows with equal doc_id and text one stays, of rows with equal
    doc_id and different texts that of the least row key. All columns are returned as they are.
    """
    ids = settle(with_fingerprints(docs, size))
    found = grouped(ids, distance).select(F.col("fp").alias("f"), "root")
    # the least id, nulls last; the row key breaks ties
    firsts = ids.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    stays = firsts.join(found, F.col("fp") == F.col("f")).groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias("row"))
    counts = ids.groupBy("row").agg(F.count("*").alias("n"))
    return one_row_each(docs, settle(stays.join(counts, "row")), ("doc_id", "text"))
