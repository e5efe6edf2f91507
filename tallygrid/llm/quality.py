"""Quality rules by robust multivariate outliers (operator 7).

Base rules come first: too few words, or too many words in repeated windows. What
passes them is judged by minimum-covariance-determinant estimates: per pool (language
and source) the centre and covariance of the ``COVERED`` share of vectors that lie
closest together, found by concentration steps that start from medians and quartiles.
A text is rejected if its Mahalanobis distance is beyond the chi-square quantile.

Scale: a step is one aggregation over the small vector table. Rows are added up per
pool and distance bin before the shuffle (a few hundred rows per pool and task,
whatever the pool's size), so the inner share is exact to a bin's width and a pool
with a third of all rows costs no more than others. A language and all rows together are pools
as well: the estimates of a pair are drawn towards its language's, these towards those of all rows,
and these towards ``SPREAD``, each as if the wider pool were ``PRIOR_ROWS`` rows more. So every text has a
verdict, and the more rows a pool has, the more it rests on its own.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallygrid.llm import stats
from tallygrid.llm.common import map_batches, ready, settle, whole_text

# The base rules.
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of words in repeated 3-word windows
#: The statistics that make up a vector.
VECTOR = ("log_word_length", "symbols", "loud", "upper", "stops", "variety")
#: Share of a pool that the estimates rest on, and the chance of rejecting a regular text.
COVERED, ALPHA = 0.75, 1e-9
#: Concentration steps; distances settle after three or four.
STEPS = 4
#: Rows that the wider pool counts for in the estimates of a pool, and the spread of every statistic where nothing is known.
PRIOR_ROWS, SPREAD = 200, 0.15
#: Added to every variance: a statistic that is zero in nearly all texts must not reject the first that has it once.
FLOOR = 0.02**2
BINS_PER_DOUBLING = 16
#: Estimates are broadcast up to so many pools; beyond, they meet the vectors by an ordinary join.
BROADCAST_POOLS = 10_000

_P = len(VECTOR)
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]


def chi_square_above(x: float, p: int) -> float:
    """Upper tail of chi-square with an even number of degrees of freedom."""
    return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(p // 2))


def chi_square_at(above: float, p: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_above(mid, p) > above else (low, mid)
    return high


CUT = chi_square_at(ALPHA, _P)
#: Makes the covariance of the inner share that of the whole, for normal data.
CONSISTENT = COVERED / (1 - chi_square_above(chi_square_at(1 - COVERED, _P), _P + 2))


def measure(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Per row of ``docs``: the columns in ``keep``, the counts, base_failed, and the vector ``x``.

    Null and empty texts have no word and fail the base rules.
    """
    keep = keep or []
    picked = [RATIO_AT[k] for k in VECTOR]

    def rows(batches):
        for batch in batches:
            out = {k: batch[k] for k in kept}
            found = [stats.counts(t) for t in batch["_text"]]
            for k in COUNTS:
                out[f"_{k}"] = [c[k] for c in found]
            out["_failed"] = [failed(c) for c in found]
            ratio = (stats.ratios(c, stats.shape(t)) for c, t in zip(found, batch["_text"]))
            out["_x"] = [[r[i] for i in picked] for r in ratio]
            yield out

    source = docs.select(*[F.col(f"`{c}`") for c in keep], whole_text().alias("_text"))
    kept = source.columns[:-1]
    schema = T.StructType(
        [source.schema[c] for c in kept]
        + [T.StructField(f"_{k}", T.LongType()) for k in COUNTS]
        + [T.StructField("_failed", T.BooleanType()), T.StructField("_x", T.ArrayType(T.DoubleType()))]
    )
    return map_batches(source, schema, rows)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIO_AT = {k: i for i, k in enumerate(stats.RATIOS)}


def failed(c: dict[str, int]) -> bool:
    """The base rules."""
    return c["n_words"] < LEAST_WORDS or 100 * c["n_repeat_words"] > MOST_REPEATED * c["n_words"]


def _met(df: DataFrame, estimates: DataFrame, on: list[str]) -> DataFrame:
    """Left join on columns without nulls; the right side is broadcast only if its counted rows are few."""
    small = estimates.count() <= BROADCAST_POOLS
    return df.join(F.broadcast(estimates) if small else estimates, on, "left")


def _keys(lang: Column, source: Column) -> dict[str, Column]:
    """Texts for the pair of language and source, and for the language alone; nulls differ from every value."""
    return {
        "_pair": F.to_json(F.struct(lang.cast("string").alias("l"), source.cast("string").alias("s"))),
        "_one": F.to_json(F.struct(lang.cast("string").alias("l"))),
    }


def _distance() -> Column:
    """Squared Mahalanobis distance of ``_x`` from the pool's ``_mu`` under its ``_inv`` (upper triangle)."""
    d = [F.col("_x")[i] - F.col("_mu")[i] for i in range(_P)]
    terms = [d[i] * d[j] * F.col("_inv")[k] * (1 if i == j else 2) for k, (i, j) in enumerate(_PAIRS)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def _start(vectors: DataFrame) -> DataFrame:
    """Medians and quartile spreads per pool as first estimates."""
    quartiles = [F.percentile_approx(F.col("_x")[i], F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(f"q{i}") for i in range(_P)]
    q = vectors.groupBy("_pool").agg(*quartiles)
    spread = lambda i: F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, 2) + FLOOR
    inverse = [1 / spread(i) if i == j else F.lit(0.0) for i, j in _PAIRS]
    return q.select("_pool", F.array(*[F.col(f"q{i}")[1] for i in range(_P)]).alias("_mu"), F.array(*inverse).alias("_inv"))


def _estimate(bins: pd.DataFrame) -> pd.DataFrame:
    """Centre and inverse covariance of the innermost bins of one pool; a pool has a few hundred bins."""
    bins = bins.sort_values("_bin")
    n = bins["n"].to_numpy(dtype=float)
    inside = int(np.searchsorted(np.cumsum(n), COVERED * n.sum() - 1e-9)) + 1
    total = n[:inside].sum()
    mu = np.array([bins[f"s{i}"].to_numpy()[:inside].sum() for i in range(_P)]) / total
    cov = np.zeros((_P, _P))
    for i, j in _PAIRS:
        cov[i, j] = cov[j, i] = bins[f"p{i}_{j}"].to_numpy()[:inside].sum() / total - mu[i] * mu[j]
    cov = cov * CONSISTENT + FLOOR * np.eye(_P)
    return pd.DataFrame({"_pool": [bins["_pool"].iloc[0]], "_n": [int(n.sum())], "_mu": [mu.tolist()], "_cov": [_flat(cov)], "_inv": [_flat(np.linalg.inv(cov))]})


def _flat(matrix: np.ndarray) -> list[float]:
    """The upper triangle."""
    return [float(matrix[i, j]) for i, j in _PAIRS]


def _square(flat: list[float]) -> np.ndarray:
    out = np.zeros((_P, _P))
    for (i, j), v in zip(_PAIRS, flat):
        out[i, j] = out[j, i] = v
    return out


def estimates(vectors: DataFrame, steps: int = STEPS) -> DataFrame:
    """(_pool, _n, _mu, _cov): rows, centre and covariance per pair, per language, and of all, from the vectors that pass the base rules."""
    pools = F.array(F.col("_pair"), F.concat(F.lit("language "), F.col("_one")), F.lit("all"))
    regular = settle(vectors.where("NOT _failed").select(F.explode(pools).alias("_pool"), "_x"))
    current = settle(_start(regular))
    sums = [F.count("*").alias("n"), *[F.sum(F.col("_x")[i]).alias(f"s{i}") for i in range(_P)]]
    sums += [F.sum(F.col("_x")[i] * F.col("_x")[j]).alias(f"p{i}_{j}") for i, j in _PAIRS]
    for _ in range(steps):
        near = F.floor(F.log2(_distance() + F.lit(2.0**-8)) * BINS_PER_DOUBLING).cast("int")
        bins = _met(regular, current.select("_pool", "_mu", "_inv"), ["_pool"]).withColumn("_bin", near).groupBy("_pool", "_bin").agg(*sums)
        current = settle(bins.groupBy("_pool").applyInPandas(_estimate, "_pool string, _n long, _mu array<double>, _cov array<double>, _inv array<double>"))
    return current.select("_pool", "_n", "_mu", "_cov")


def drawn(n: int, mu: np.ndarray, cov: np.ndarray, wider_mu: np.ndarray, wider_cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centre and covariance of a pool's rows together with ``PRIOR_ROWS`` rows of the wider pool."""
    own = n / (n + PRIOR_ROWS)
    apart = mu - wider_mu
    return own * mu + (1 - own) * wider_mu, own * cov + (1 - own) * wider_cov + own * (1 - own) * np.outer(apart, apart)


def judged_pairs(vectors: DataFrame) -> DataFrame:
    """Centre and inverse covariance for every pair of language and source, drawn towards the wider pools'."""
    found = estimates(vectors)
    every = found.where(F.col("_pool") == "all").head()
    nothing = vectors.sparkSession.createDataFrame([], "_pair string, _mu array<double>, _inv array<double>")
    if every is None:
        return nothing
    own = settle(vectors.where("NOT _failed").select("_pair", "_one").distinct())
    of = lambda k: found.select(F.col("_pool").alias(f"pool{k}"), *[F.col(f"_{c}").alias(f"{c}{k}") for c in ("n", "mu", "cov")])
    met = own.join(of(0), F.col("_pair") == F.col("pool0")).join(of(1), F.concat(F.lit("language "), F.col("_one")) == F.col("pool1"))
    top = drawn(every["_n"], np.array(every["_mu"]), _square(every["_cov"]), np.array(every["_mu"]), SPREAD**2 * np.eye(_P))

    def rows(batches):
        for batch in batches:
            out = {"_pair": batch["_pair"], "_mu": [], "_inv": []}
            for n0, mu0, cov0, n1, mu1, cov1 in zip(*(batch[f"{c}{k}"] for k in (0, 1) for c in ("n", "mu", "cov"))):
                wider = drawn(n1, np.array(mu1), _square(cov1), *top)
                mu, cov = drawn(n0, np.array(mu0), _square(cov0), *wider)
                out["_mu"].append(mu.tolist())
                out["_inv"].append(_flat(np.linalg.inv(cov)))
            yield out

    columns = [f"{c}{k}" for k in (0, 1) for c in ("n", "mu", "cov")]
    return settle(map_batches(met.select("_pair", *columns), nothing.schema, rows))


def _kept() -> Column:
    return ~F.col("_failed") & (F.col("_d").isNull() | (F.col("_d") <= CUT))


def rules(docs: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance.

    Null languages and sources are pools like others. Every text that passes the base rules has a distance and so a
    verdict, however few rows there are; one that fails them may have none. Repeated rows count as
    often as they occur; an empty table gives an empty result.
    """
    named = docs.select(F.col("doc_id").cast("long"), "text", *[c.alias(k) for k, c in _keys(F.col(lang), F.col(source)).items()])
    vectors = settle(measure(named, ["doc_id", "_pair", "_one"]))
    out = _met(vectors, judged_pairs(vectors), ["_pair"]).withColumn("_d", _distance())
    return out.select(
        "doc_id", *[F.col(f"_{k}").alias(k) for k in COUNTS],
        F.col("_failed").alias("base_failed"), _kept().alias("kept"), F.col("_d").alias("distance"),
    )


def filtered(docs: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    Texts are read twice and never shuffled: once for the estimates, which only need the
    vectors, and once for the verdicts.
    """
    keys = _keys(F.col(lang), F.col(source))
    vectors = settle(measure(docs.select("text", *[c.alias(k) for k, c in keys.items()]), ["_pair", "_one"]))

    def verdict(text: str):
        c = stats.counts(text)
        r = stats.ratios(c, stats.shape(text))
        return failed(c), [r[RATIO_AT[k]] for k in VECTOR]

    # pure, but declared otherwise: the optimiser would repeat the call for every use of its result
    seen = F.udf(verdict, "_failed boolean, _x array<double>", useArrow=True).asNondeterministic()
    ready(docs.sparkSession)
    # the caller's columns travel in one struct, so no name of theirs meets one of these
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), seen(whole_text()).alias("_v"), keys["_pair"].alias("_pair"))
    out = _met(out, judged_pairs(vectors), ["_pair"])
    out = out.withColumns({"_failed": F.col("_v._failed"), "_x": F.col("_v._x")}).withColumn("_d", _distance())
    return out.where(_kept()).select(*[F.col(f"_doc.`{c}`") for c in docs.columns])
