"""Operator 12 against scores of every document."""

import math
import random
import re
from collections import Counter

import pytest
from tallygrid.llm import search

SCHEMA = "doc_id long, text string, rank string, item string, score string"


def brute(docs, items, best=10):
    def split(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    held = [(doc_id, split(t)) for doc_id, t in docs]
    n, length = sum(bool(w) for _, w in held), sum(len(w) for _, w in held)
    df = Counter(t for _, w in held for t in set(w))
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, w in held:
            tf, m = Counter(w), 100 - 75 + (75 * len(w) * n) // length if length else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in split(text) if tf[t])
            if score:
                scores.append((-score, doc_id is None, doc_id))
        out += [(item_id, k, d, -s) for k, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:best], 1)]
    return sorted(map(str, out))


def corpus(n=300):
    r = random.Random(3)
    words = [f"w{i}" for i in range(400)] + ["Ünder", "naïve", "ÉCOLE", "x1", "日本語"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, r.choice([" ", ", ", "-", "\n"]).join(r.choices(words, weights, k=r.choice([1, 3, 20, 80, 400])))) for i in range(n)]
    docs += [(n, docs[0][1]), (n + 1, docs[0][1]), (n + 2, None), (n + 3, ""), (n + 4, ".,;"), (None, docs[5][1]), (n + 5, " ".join(r.choices(words, k=9000)))]
    docs += [(n + 6 + i, "tie tie " + "pad " * 5) for i in range(30)] + [(n + 40, "W1 w1 " * 500)]
    items = [(i, " ".join(r.choices(words, weights, k=r.choice([1, 5, 30])))) for i in range(25)]
    items += [(50, "tie"), (51, None), (52, ""), (53, "unheard of"), (54, "TIE tie pad w1"), (55, docs[7][1]), (56, "日本語 naïve"), (57, "w399")]
    return docs, items


@pytest.fixture(scope="module")
def frames(spark):
    docs, items = corpus()
    random.Random(1).shuffle(docs)
    return docs, items, spark.createDataFrame([(*d, "x", "y", "z") for d in docs], SCHEMA).repartition(6), spark.createDataFrame(items, "item_id long, text string")


def shown(df):
    return sorted(map(str, map(tuple, df.select("item_id", "rank", "doc_id", "score").collect())))


def test_agrees_with_all_scores(frames):
    docs, items, d, i = frames
    assert shown(search.search(d, i)) == brute(docs, items)
    assert shown(search.search(d, i, best=3)) == brute(docs, items, 3)


def test_blocks_of_items_and_ordinary_joins(frames, monkeypatch):
    docs, items, d, i = frames
    monkeypatch.setattr(search, "BROADCAST_PAIRS", 0)
    monkeypatch.setattr(search, "blocks_of", lambda items, f=search.blocks_of: f(items, 300))
    assert len(list(search.blocks_of(i))) > 1
    assert shown(search.search(d, i)) == brute(docs, items)


def test_bounds_hold_and_exclude(frames):
    """No score above its bound, whatever the filter's size; and the bounds do exclude."""
    docs, items, _, _ = frames
    found = [(k, search.terms(t or "")) for k, (_, t) in enumerate(docs)]
    found = [(k, w) for k, w in found if w]
    df = Counter(t for _, w in found for t in set(w))
    asked = [search.terms(t or "") for _, t in items]
    own = search.Items(asked, {t: df[t] for a in asked for t in a if t in df}, len(found), sum(len(w) for _, w in found))
    blocks, made = search.Blocks(), []
    import numpy as np
    import xxhash

    for k, w in found:
        tf = Counter(w)
        block = blocks.add((0, k, 0, len(w)), np.array([xxhash.xxh3_64_intdigest(t) for t in tf], dtype=np.uint64), np.array(list(tf.values())))
        made += [block] if block else []
    made += [blocks.close(c) for c in list(blocks.open)]
    texts, loose, pairs = dict(found), 0, 0
    for b in made:
        keys = np.frombuffer(b["keys"][0], dtype=np.int64).reshape(-1, 4)
        bounds = own.bounds(b["width"][0], keys, b["bits"][0])
        for at, key in enumerate(keys):
            w = texts[key[1]]
            for item in range(own.size):
                exact = own.score(item, Counter(w), own.norm(len(w)))
                assert exact <= bounds[item, at]
                pairs += 1
                loose += bounds[item, at] > 1.1 * exact + 1
    assert loose < 0.05 * pairs


def test_empty_tables(frames):
    _, _, d, i = frames
    assert search.search(d.limit(0), i).count() == 0
    assert search.search(d, i.limit(0)).count() == 0


def test_repeated_rows_are_documents_and_items(spark):
    d = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "a")], "doc_id long, text string")
    i = spark.createDataFrame([(9, "a b"), (9, "a b")], "item_id long, text string")
    got = [tuple(r) for r in search.search(d, i).collect()]
    assert sorted((r[0], r[1], r[2]) for r in got) == sorted([(9, 1, 1), (9, 2, 1), (9, 3, 2)] * 2)
