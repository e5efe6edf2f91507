"""Operator 1: words below the clustering floor and outside the head each get a class of their own."""

from pyspark.sql import functions as F
from tallygrid.llm import brown

DATA = "/root/testdata/sf0.001"


def test_every_training_word_has_a_class_of_its_own(spark, monkeypatch):
    monkeypatch.setattr(brown, "HEAD", 50)  # most words fall outside the head and take the join
    documents = spark.read.parquet(f"{DATA}/documents.parquet")
    counts = brown.word_counts(documents)
    head = brown.head_of(counts, 50)
    model = brown.Model(head, counts, documents)
    words = counts.where(F.col("word") != F.lit(brown.END)).count()
    inside = len(head) - model.units.own
    assert model.rest.count() + inside == words - model.units.own
    assert model.classes.size == model.units.size + inside
    # words that share an ending no longer share a class
    by_ending = {}
    for r in model.rest.collect():
        by_ending.setdefault(brown.ending(bytes(r.word)), set()).add(r.cls)
    assert any(len(c) > 1 for c in by_ending.values())
    assert abs((10**model.transition).sum(axis=1) - 1).max() < 1e-9
