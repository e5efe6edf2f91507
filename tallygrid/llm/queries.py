"""One query per operator, each over its whole table; the contract's columns come from the operator's own results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallygrid.llm import brown, classifier, decontaminate, html_text, language, lexing, mixing, near, quality, recompression, search, spelling, tokens
from tallygrid.llm.common import remainder, table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def brown_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score(table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 7) == 2)


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return classifier.score(table(spark, sf_dir, "documents"), labels, remainder(F.col("doc_id"), 3) == 1)


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"))


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexing.scan(table(spark, sf_dir, "documents"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rules(table(spark, sf_dir, "documents"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predicted(table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 4) == 2)


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), str(tokenizer_path()))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def substring_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its words, how many of them repeat an earlier passage, and a digest of the others."""
    found = recompression.repeats(table(spark, sf_dir, "documents"))
    size = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return found.select("doc_id", "n_words", size.alias("n_removed"), F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


QUERIES: dict[str, Query] = {
    "op1_brown_scores": brown_scores,
    "op2_quality_scores": quality_scores,
    "op3_source_mix": source_mix,
    "op4_benchmark_leaks": benchmark_leaks,
    "op5_secret_scan": secret_scan,
    "op6_simhash_near_duplicates": near_duplicates,
    "op7_quality_outliers": quality_rules,
    "op8_language_id": language_id,
    "op9_page_text": page_text,
    "op10_token_counts": token_counts,
    "op11_spelling_variants": spelling_variants,
    "op12_ranked_search": ranked_search,
    "op13_substring_repeats": substring_repeats,
}

#: Words as in the contract: runs of characters other than ASCII white space.
_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

#: Terms as in the contract, with A-Z in lower case.
_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLES: dict[str, str] = {
    "op12_ranked_search": f"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
c AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
q AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY ALL),
p AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
f AS (SELECT t, count(*) AS df FROM p GROUP BY t),
s AS (SELECT item_id, doc_id, sum(times * floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT
        * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * n_docs) // n_terms)))))::BIGINT AS score
      FROM q JOIN p USING (t) JOIN f USING (t), c GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
""",
    "op13_substring_repeats": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT doc_id, len(w) AS n, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20),
x AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k FROM s),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS nth FROM x),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS at FROM f WHERE nth > 1),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS at FROM d),
k AS (SELECT p.doc_id, string_agg(w[p.at], ' ' ORDER BY p.at) AS kept, count(*) AS n FROM p ANTI JOIN g ON p.doc_id = g.doc_id AND p.at = g.at GROUP BY p.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(k.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
""",
}
