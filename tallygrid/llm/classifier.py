"""Quality classifier: random Fourier features, ridge, isotonic calibration (operator 2).

Statistics of a text (never labels, ids, language or source) are standardised and mapped to
cosines of random directions, which approximate a Gaussian kernel. Ridge scores come from the
normal equations, added up per partition and summed by Spark, so the fit covers every labelled
training row and its size is fixed by the number of features. A part of the training rows that the
fit does not see calibrates: their raw scores are binned, and adjacent bins are pooled until
the share of label 1 never falls.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tallygrid.llm import stats
from tallygrid.llm.common import map_batches, settle, whole_text

FEATURES, RIDGE, SEED = 256, 1e-2, 7
#: Width of the kernel, in standard deviations per root of the number of statistics.
WIDTH = 1.0
#: One in so many training rows calibrates.
CALIBRATES = 4
BINS = 512
LOW, HIGH = -0.5, 1.5  # range of raw scores that bins cover
#: Raw score's share of the result, which orders texts inside a calibrated step.
TIES = 0.01

_SIZE = len(stats.RATIOS) + 3


def statistics(text: str) -> list[float]:
    c, s = stats.counts(text), stats.shape(text)
    return [*stats.ratios(c, s), float(np.log1p(c["n_words"])), float(np.log1p(c["word_chars"] / s["lines"])), float(np.log1p(s["lines"]))]


def directions(size: int = _SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Random directions and phases, the same in every run."""
    random = np.random.default_rng(SEED)
    return random.standard_normal((size, FEATURES)) / (WIDTH * np.sqrt(size)), random.uniform(0, 2 * np.pi, FEATURES)


class Fourier:
    """Standardised statistics to Fourier features, with a constant."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray):
        self.mean, self.deviation = mean, np.maximum(deviation, 1e-3)
        self.w, self.b = directions(len(mean))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.deviation, -6, 6)  # one odd statistic must not drown the others
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ self.w + self.b), np.ones((len(x), 1))])


def normal_equations(train: DataFrame, fourier: Fourier) -> tuple[np.ndarray, np.ndarray]:
    """Sums of z z' and z y over all rows of (x, y): per partition in numpy, between partitions by Spark."""
    size = FEATURES + 1

    def add(batches):
        a = np.zeros((size + 1, size + 1))
        for batch in batches:
            if batch["y"]:
                z = np.hstack([fourier(np.array(batch["x"])), np.array(batch["y"], dtype=float)[:, None]])
                a += z.T @ z
        if a.any():
            i, j = np.triu_indices(size + 1)
            yield {"i": i.astype(np.int32), "j": j.astype(np.int32), "v": a[i, j]}

    total = map_batches(train.select("x", "y"), "i int, j int, v double", add).groupBy("i", "j").agg(F.sum("v").alias("v"))
    a = np.zeros((size + 1, size + 1))
    for r in total.collect():
        a[r.i, r.j] = a[r.j, r.i] = r.v
    return a[:size, :size], a[:size, size]


def isotonic(n: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Pool adjacent violators over bins: the non-decreasing shares of label 1 closest to the bins' own."""
    pools: list[list[float]] = []
    for k, (w, y) in enumerate(zip(n, ones)):
        if not w:
            continue
        pools.append([w, y, k, k])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            w2, y2, _, last = pools.pop()
            pools[-1] = [pools[-1][0] + w2, pools[-1][1] + y2, pools[-1][2], last]
    if not pools:
        return np.clip(np.linspace(LOW, HIGH, len(n)), 0, 1)
    at = np.array([x for _, _, a, b in pools for x in (a, b)], dtype=float)
    return np.interp(np.arange(len(n)), at, np.array([y / w for w, y, _, _ in pools for _ in (0, 1)]))


class Scorer:
    def __init__(self, fourier: Fourier, weights: np.ndarray, steps: np.ndarray | None = None):
        self.fourier, self.weights, self.steps = fourier, weights, steps

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.weights

    def bins(self, raw: np.ndarray) -> np.ndarray:
        return np.clip(((raw - LOW) / (HIGH - LOW) * BINS).astype(int), 0, BINS - 1)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        return (1 - TIES) * self.steps[self.bins(raw)] + TIES * np.clip((raw - LOW) / (HIGH - LOW), 0, 1)


def fit(train: DataFrame) -> Scorer:
    """A scorer from rows of (x, y, calibrates), y in 0 to 1."""
    sums = [F.avg(F.col("x")[i]) for i in range(_SIZE)] + [F.stddev_pop(F.col("x")[i]) for i in range(_SIZE)]
    moments = np.array([v if v is not None else 0.0 for v in train.agg(*sums).head()], dtype=float)
    fourier = Fourier(moments[:_SIZE], moments[_SIZE:])
    a, b = normal_equations(train.where("NOT calibrates"), fourier)
    scorer = Scorer(fourier, np.linalg.solve(a + RIDGE * np.eye(len(a)), b))

    def raw_bins(batches):
        for batch in batches:
            if batch["y"]:
                yield {"bin": scorer.bins(scorer.raw(np.array(batch["x"]))).astype(np.int32), "y": batch["y"]}

    found = map_batches(train.where("calibrates").select("x", "y"), "bin int, y double", raw_bins)
    n, ones = np.zeros(BINS), np.zeros(BINS)
    for r in found.groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("ones")).collect():
        n[r.bin], ones[r.bin] = r.n, r.ones
    scorer.steps = isotonic(n, ones)
    return scorer


def score(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality") -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (score >= 0.5).

    Labels of held-out rows are never read into the fit. A doc_id with several labels counts with
    their mean; null labels and ids do not count. Null and empty texts get a score like others.
    Without any label the raw score is 0 and the result says so for all rows.
    """

    def measure(batches):
        for batch in batches:
            yield {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "x": [statistics(t) for t in batch["text"]]}

    rows = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), whole_text().alias("text"))
    found = settle(map_batches(rows, "doc_id long, held_out boolean, x array<double>", measure))
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("labelled"))
    known = known.agg(F.avg(label).cast("double").alias("y"))
    train = found.where("NOT held_out").join(known, F.col("doc_id") == F.col("labelled"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATES)) == 0
    scorer = fit(settle(train.select("x", "y", part.alias("calibrates"))))

    def predict(batches):
        for batch in batches:
            s = scorer(np.array(batch["x"])) if batch["x"] else np.zeros(0)
            yield {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": s, "predicted": (s >= 0.5).astype(np.int32)}

    return map_batches(found, "doc_id long, held_out boolean, score double, predicted int", predict)
