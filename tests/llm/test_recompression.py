"""Operator 13 against windows compared one by one."""

import random

import numpy as np
import pytest
from tallygrid.llm import recompression as rc
from tallygrid.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, kept string, name string"


def prose(seed, n, vocabulary=40):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def brute(rows, window=20):
    """Per row of (doc_id, text): numbers of the removed words."""
    docs = sorted({r for r in rows}, key=lambda r: (r[0] is None, r[0] or 0))
    seen, gone = set(), {}
    for doc_id, text in docs:
        w = (text or "").encode().split()
        out = set()
        for i in range(len(w) - window + 1):
            x = tuple(w[i : i + window])
            if x in seen:
                out |= set(range(i, i + window))
            seen.add(x)
        gone[doc_id, text] = out
    return gone


def passages():
    """Copies, near copies, shared passages at and below a window's length, repeats in one text, runs of one word."""
    texts = [" ".join(prose(i, 30 + 37 * i % 400, 5000 if i % 2 else 6)) for i in range(40)]
    shared = prose(900, 120, 5000)
    for i, (a, n) in enumerate([(0, 120), (10, 20), (10, 19), (50, 21), (3, 60), (3, 61), (0, 40), (80, 40)]):
        texts.append(" ".join(prose(1000 + i, 15 * (i % 4), 5000) + shared[a : a + n] + prose(2000 + i, 11 * (i % 3), 5000)))
    base = prose(3000, 300, 5000)
    for i in range(12):
        t = list(base)
        t[(i * 29) % 300] = f"new{i}"
        texts.append(" ".join(t))
    texts += [" ".join(base)] * 3 + [" ".join(base[:60] * 3), " ".join(["a"] * 100), " ".join(["a"] * 20), " ".join(["a"] * 19), " ".join(["a"] * 40 + ["b"] * 40)]
    texts += [" ".join(["a", "b"] * 50), " ".join(["a", "b", "b"] * 30), "\t".join(base[:25]) + "\n", None, "", " \n", "one two"]
    return texts


def check(spark, rows, window=20, parts=5):
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA).repartition(parts)
    want = brute(rows, window)
    got = rc.repeats(frame, window).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for (doc_id, text), gone in want.items():
        w, r = (text or "").split(), by_id[doc_id]
        assert r.n_words == len(w)
        assert {k for a in r.removed for k in range(a["start"], a["end"])} == gone, doc_id
        assert r.kept == " ".join(x for k, x in enumerate(w) if k not in gone)


@pytest.mark.parametrize("window, parts", [(20, 1), (20, 7), (5, 3), (33, 3)])
def test_agrees_with_all_windows(spark, window, parts):
    texts = passages()
    random.Random(5).shuffle(texts)
    check(spark, [*enumerate(texts), (None, texts[3])], window, parts)


def test_small_batches(spark):
    """What one batch cannot tell alone is told when they meet, also within a name that spans batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    old, rc.map_arrow.__globals__["BATCH_ROWS"] = rc.map_arrow.__globals__["BATCH_ROWS"], 3
    try:
        check(spark, list(enumerate(passages())), 20, 2)
    finally:
        rc.map_arrow.__globals__["BATCH_ROWS"] = old


def test_rows_that_share_an_id(spark):
    """Equal rows get equal results and are no repeats of each other; rows that differ in text are ordered somehow."""
    a, b = " ".join(prose(1, 60, 5000)), " ".join(prose(1, 40, 5000) + prose(2, 40, 5000))
    frame = spark.createDataFrame([(7, a), (7, a), (7, b), (9, a), (None, a), (None, None)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_words, sum(x["end"] - x["start"] for x in r.removed)) for r in rc.repeats(frame).collect())
    assert got in ([(-1, 0, 0), (-1, 60, 60), (7, 60, 0), (7, 60, 0), (7, 80, 40), (9, 60, 60)], [(-1, 0, 0), (-1, 60, 60), (7, 60, 40), (7, 60, 40), (7, 80, 0), (9, 60, 60)])
    assert rc.repeats(frame.limit(0)).count() == 0


def test_interior_symbols_do_not_depend_on_what_is_around():
    inner = np.random.default_rng(1).integers(1, 2**63, 40).astype(np.uint64)
    found = []
    for seed in range(6):
        r = np.random.default_rng(seed + 10)
        row = np.concatenate((r.integers(1, 2**63, 25).astype(np.uint64), inner, r.integers(1, 2**63, 25).astype(np.uint64)))
        start, name, place = rc.anchors(row, np.zeros(len(row), dtype=np.int64))
        here = (start >= 25) & (start <= 45)
        found.append((name[here].tolist(), (place[here] - 25).tolist()))
    assert all(f == found[0] for f in found)


def test_registered():
    assert any(q.startswith("op13_") for q in QUERIES)
