"""Operators 2, 3 and 8 reckoned again in the plainest way, row by row."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F
from tallygrid.llm import classifier, language, mixing
from tallygrid.llm.common import remainder

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def crc(doc_id, of):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % of


# ------------------------------------------------------------------ operator 8


def code(gram):
    out = 0
    for i, c in enumerate(gram):
        out = ((out + ord(c)) * 0x9E3779B97F4A7C15 + i + 1) % 2**64
    return out


def grams(text):
    line = " " + regex.sub(r"[^\p{L}]+", " ", (text or "").lower()).strip() + " "
    found = Counter()
    for n in range(1, language.LONGEST + 1):
        for i in range(len(line) - n + 1):
            gram = line[i : i + n]
            if (n > 1 or gram != " ") and " " not in gram[1:-1]:
                found[gram] += 1
    return found


def ranked(counts, k, signed=False):
    """Ties by code; profiles order codes as signed numbers, as Spark does."""
    return sorted(counts, key=lambda g: (-counts[g], (code(g) + 2**63) % 2**64 if signed else code(g)))[:k]


def test_languages_agree_with_brute_force(spark, documents):
    odd = [(900_001, None), (900_002, ""), (900_003, "123 ..."), (900_004, "a"), (900_005, "Ü ß é " * 50)]
    extra = spark.createDataFrame([(i, t, None, None, None) for i, t in odd], documents.schema)
    rows = documents.where("doc_id < 120").unionByName(extra)
    got = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in language.predicted(rows, remainder(F.col("doc_id"), 4) == 2).collect()}
    total = defaultdict(Counter)
    for r in rows.collect():
        if r.lang is not None and crc(r.doc_id, 4) != 2:
            total[r.lang].update(grams(r.text))
    place = {lang: {g: i for i, g in enumerate(ranked(c, language.PROFILE, signed=True))} for lang, c in total.items()}
    assert len(place) > 2
    for r in rows.collect():
        own = ranked(grams(r.text), language.OF_TEXT)
        if not regex.search(r"\p{L}", r.text or ""):
            assert got[r.doc_id] == ("und", 0.0)
            continue
        apart = {lang: sum(abs(at[g] - i) if g in at else language.PROFILE for i, g in enumerate(own)) for lang, at in place.items()}
        best = min(sorted(apart), key=apart.get)
        assert got[r.doc_id] == (best, round(1 - apart[best] / (language.PROFILE * len(own)), 9))


# ------------------------------------------------------------------ operator 2


def monotone(n, ones):
    """The isotonic fit by its min-max formula."""
    total, hits = np.concatenate(([0], np.cumsum(n))), np.concatenate(([0], np.cumsum(ones)))
    mean = lambda a, b: (hits[b + 1] - hits[a]) / (total[b + 1] - total[a])
    return [max(min(mean(a, b) for b in range(i, len(n))) for a in range(i + 1)) for i in range(len(n))]


def test_quality_scores_agree_with_brute_force(spark):
    documents, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r.doc_id: r.score for r in classifier.score(documents, labels, remainder(F.col("doc_id"), 3) == 1).collect()}
    y = {r.doc_id: float(r.quality) for r in labels.collect() if r.quality is not None}
    rows = documents.select("doc_id", "text", (F.pmod(F.xxhash64("doc_id"), F.lit(classifier.CALIBRATES)) == 0).alias("calibrates")).collect()
    x = {r.doc_id: np.array(classifier.statistics(r.text or "")) for r in rows}
    learns = [r for r in rows if r.doc_id in y and crc(r.doc_id, 3) != 1]
    mean, deviation = (f(np.array([x[r.doc_id] for r in learns]), axis=0) for f in (np.mean, np.std))
    w, b = classifier.directions()

    def features(v):
        z = np.clip((v - mean) / np.maximum(deviation, 1e-3), -6, 6)
        return np.append(np.sqrt(2 / classifier.FEATURES) * np.cos(z @ w + b), 1.0)

    fitted = [r for r in learns if not r.calibrates]
    z, t = np.array([features(x[r.doc_id]) for r in fitted]), np.array([y[r.doc_id] for r in fitted])
    weights = np.linalg.solve(z.T @ z + classifier.RIDGE * np.eye(z.shape[1]), z.T @ t)
    raw = {i: float(features(v) @ weights) for i, v in x.items()}
    width = (classifier.HIGH - classifier.LOW) / classifier.BINS
    bin_of = lambda s: min(classifier.BINS - 1, max(0, int((s - classifier.LOW) / width)))
    held = defaultdict(list)
    for r in learns:
        if r.calibrates:
            held[bin_of(raw[r.doc_id])].append(y[r.doc_id])
    bins = sorted(held)
    steps = monotone([len(held[k]) for k in bins], [sum(held[k]) for k in bins])
    wrong = 0
    for i, s in raw.items():
        place = min(1.0, max(0.0, (s - classifier.LOW) / (classifier.HIGH - classifier.LOW)))
        want = (1 - classifier.TIES) * np.interp(bin_of(s), bins, steps) + classifier.TIES * place
        wrong += abs(got[i] - want) > 1e-3  # a raw score on the border of two bins may fall either way
    assert len(learns) > 100 and wrong <= 0.01 * len(raw)


# ------------------------------------------------------------------ operator 3


def water_level(sizes):
    """A level that every source's target reaches by its weight, unless three times its size is less; found by halving."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [None]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    low, high, total = 0.0, 10.0 * sum(sizes.values()) + 1, sum(sizes.values())
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(level * weight[s], 3 * sizes[s]) for s in sizes) < total else (low, level)
    return {s: min(low * weight[s], 3 * sizes[s]) for s in sizes}


@pytest.mark.parametrize("seed", range(4))
def test_targets_are_the_water_level(spark, seed):
    r = np.random.default_rng(seed)
    names = ["b", "a", None, "c", "é", "Z", "d", "𝄞", "\uffee", ""][: 10 - seed]
    sizes = {s: int(n) for s, n in zip(names, r.integers(0, [10, 1000, 5000, 20, 300, 100_000, 7, 40, 900, 1][: len(names)], len(names)))}
    units = spark.createDataFrame([(i, s, n // 2) for i, (s, n) in enumerate(sizes.items())] + [(i, s, n - n // 2) for i, (s, n) in enumerate(sizes.items())], "doc_id long, source string, size long")
    got = {r.key: r for r in mixing.plan(units).collect()}
    want = water_level(sizes)
    key = lambda s: "{}" if s is None else None
    by_size = {r.key: (r.source_size, r.target) for r in got.values()}
    assert len(by_size) == len(sizes)
    for s, t in want.items():
        found = by_size[key(s)] if s is None else next(v for k, v in by_size.items() if __import__("json").loads(k).get("source") == s and k != "{}")
        assert found == (sizes[s], pytest.approx(t, abs=1e-3))
    for r in got.values():
        assert 0 <= r.p < 1 and (r.copies + r.p) * r.source_size == pytest.approx(r.target, abs=1e-3)


def test_many_sources(spark):
    """Two thousand sources; their targets add up to all words."""
    units = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 2000).alias("source"), (F.col("id") % 97 + (F.col("id") % 2000 == 7).cast("long") * 9000).alias("size"))
    total, planned, n = mixing.plan(units).agg(F.sum("source_size"), F.sum("target"), F.count("*")).head()
    assert n == 2000 and planned == pytest.approx(total, rel=1e-9)


def test_mix_targets_and_sizes_of_a_table(spark, documents):
    got = mixing.mix(documents).collect()
    sizes = defaultdict(int)
    for r in documents.collect():
        sizes[r.source] += len(regex.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    sizes.setdefault(None, 0)
    target = water_level(sizes)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-3 and r.taken <= 3 * r.size
        taken[r.source] += r.taken
    largest = max(r.size for r in got)
    assert all(abs(taken[s] - target[s]) <= largest for s in sizes) and abs(sum(target.values()) - sum(sizes.values())) < 1e-3
