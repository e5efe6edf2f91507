"""Plans on skewed data: a third of all rows and more on one key, nothing small enough to be broadcast."""

import pytest
from pyspark.sql import functions as F

from tallygrid.operators import aggregates as ag, joins as jo
from tallygrid.plans import metric as m, models
from tallygrid.plans.evaluate import evaluate
from tallygrid.plans.model import Model

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Facts of which 7 in 10 have key 1, and dimensions, read from files as a cluster would."""
    root = str(tmp_path_factory.mktemp("plans"))
    fact = spark.range(120_000).select(
        F.when(F.col("id") % 10 < 7, 1).otherwise(F.col("id") % 4000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.col("id").alias("n"))
    fact.withColumn("name", F.concat(F.lit(" N"), "k")).repartition(9).write.parquet(f"{root}/fact")
    dim = spark.range(8000).select((F.col("id") % 4000).alias("k"), (F.col("id") * 2).alias("key"), (F.col("id") % 4000).cast("int").alias("small"))
    dim.withColumn("name", F.concat(F.lit("n"), "k")).repartition(5).write.parquet(f"{root}/dim")
    before = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield spark.read.parquet(f"{root}/fact"), spark.read.parquet(f"{root}/dim")
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df) -> str:
    """The plan as it ran in the end."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def scored(fact, dim):
    model = Model({"F": lambda: fact, "D": lambda: dim, "G": lambda: dim.withColumnRenamed("k", "g")}, models.parse_links("F.k > D.k semi\nG.g > D.k both"), frozenset())
    return evaluate(model, {"n": m.sum_("F.n")}, where=[m.compare("G.key", ">=", 100)])


LOOKUPS = {
    "lookup_keys": lambda f, d: jo.lookup_keys(f, d.select("k", "key"), "k", "key"),
    "lookup_keys of another integer": lambda f, d: jo.lookup_keys(f, d.select("small", "key"), {"k": "small"}, "key"),
    "lookup": lambda f, d: jo.lookup(f, d.where("key < 8000"), "k", ["key"]),
    "restrict_by": lambda f, d: jo.restrict_by(f, d, "k"),
    "narrow_dim": lambda f, d: jo.narrow_dim(f, d, "k"),
    "with_dim_by_text": lambda f, d: jo.with_dim_by_text(f, d, F.col("name"), F.col("name"), ["key"]),
}


@pytest.mark.parametrize("name", list(LOOKUPS))
def test_a_hot_key_is_split(tables, name):
    fact, dim = tables
    df = LOOKUPS[name](fact, dim)
    assert "skew=true" in executed(df)
    assert df.count() == 120_000 and not [c for c in df.columns if c.startswith("_")]


def test_a_hot_key_of_a_restriction_is_split(tables):
    fact, dim = tables
    df = scored(fact, dim)
    assert "skew=true" in executed(df)
    kept = [r.k for r in dim.where("key >= 100").select("k").distinct().collect()]
    assert df.first().n == fact.where(F.col("k").isin(kept)).agg(F.sum("n")).first()[0]


def test_keys_that_only_a_cast_makes_equal(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    right = spark.createDataFrame([(" 1", 10), ("2", 20), ("x", 30)], "k string, key int")
    plain = left.join(right.where("k <> 'x'"), left.k == right.k.try_cast("int"), "left").select("v", "key")
    got = jo.lookup_keys(left, right.where("k <> 'x'"), "k", "key").select("v", "key")
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
