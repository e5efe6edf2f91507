"""Operator 1: texts are never shuffled to bring words outside the head back to their rows."""

import re

from pyspark.sql import functions as F
from tallygrid.llm import brown

DATA = "/root/testdata/sf0.001"


def test_rows_meet_their_rest_without_moving_their_text(spark, monkeypatch, capsys):
    monkeypatch.setattr(brown, "HEAD", 50)  # most words fall outside the head and take the join
    documents = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = brown.with_rows(documents.select(F.col("doc_id").cast("long"), "text"))
    counts = brown.word_counts(rows)
    model = brown.Model(brown.head_of(counts, 50), counts, rows)
    found = brown.filled(rows, spark.sparkContext.broadcast(model), model.rest, ("doc_id",))
    capsys.readouterr()
    found.explain(mode="formatted")
    plan = capsys.readouterr().out
    exchanges = re.findall(r"\(\d+\) (?:Exchange|ShuffleQueryStage)[^\n]*\nInput \[\d+\]: \[([^\]]*)\]", plan)
    assert exchanges and not any(re.search(r"\btext#", inputs) for inputs in exchanges)
    got = {r.row: r for r in found.collect()}
    assert len(got) == rows.count()
    for r in rows.collect():
        tokens = brown.keys(r.text)
        line = brown.line_of(got[r.row].line, got[r.row].rest_at)
        assert len(line) == len(tokens) + 2 == got[r.row].n_words + 2
        assert got[r.row].n_head == sum(t in model.units.place for t in tokens)
