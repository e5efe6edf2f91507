"""Operator 11 against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from tallygrid.llm import spelling

SCHEMA = "doc_id long, text string, word string, n string, root string"


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def brute(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = {w: [x for x in n if distance_one(w, x)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted(str((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None)) for w in n)


def shown(df):
    return sorted(str(tuple(r)) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def corpus(seed=1):
    r = random.Random(seed)
    letters = "aaeeiinnrstolduéÀÿmç"
    base = ["".join(r.choices(letters, k=r.randint(4, 9))) for _ in range(60)] + ["aaaaa", "aaaaaa", "aaaaaaa", "x" * 60, "x" * 61, "y" * 2000]
    words = list(base)
    for w in base:
        for _ in range(5):
            k = r.randrange(len(w))
            words.append(r.choice([w[:k] + w[k + 1 :], w[:k] + r.choice(letters) + w[k:], w[:k] + r.choice(letters) + w[k + 1 :]]))
    rows = []
    for i in range(150):
        rows.append((i, r.choice([" ", ", ", "×", "日", "\n9"]).join(r.choices(words, [1 + 40 / (1 + j % 66) for j in range(len(words))], k=60))))
    rows += [(500 + i, "Straße strasse straßen STRASSE " * 3) for i in range(40)]
    return rows + [(900, None), (901, ""), (902, "1 2 3"), (None, "aaaaa aaaaa aaaaa"), rows[3], rows[3]]


def test_agrees_with_all_pairs(spark):
    rows = corpus()
    want = brute(rows)
    frame = spark.createDataFrame([(*x, "a", "b", "c") for x in rows], SCHEMA).repartition(5)
    assert shown(spelling.variants(frame)) == want
    assert any("None" not in w for w in want) and len(want) > 150


@pytest.mark.parametrize("shard, asked", [(7, 5), (1, 100)])
def test_hot_keys_are_cut(spark, monkeypatch, shard, asked):
    """Keys of more words than a part holds are cut; all parts are asked."""
    monkeypatch.setattr(spelling, "SHARD", shard)
    monkeypatch.setattr(spelling, "ASKED", asked)
    r = random.Random(9)
    words = {"".join(r.choices("abn", k=6)) for _ in range(250)}
    frame = spark.createDataFrame([(w, 3 + r.randrange(9)) for w in words], "word string, n long")
    got = {(x.word, x.near) for x in spelling.near_pairs(frame).collect()}
    assert got == {(a, b) for a in words for b in words if distance_one(a, b)}
    assert spelling.near_pairs(frame).count() == len(got)


def test_chains_of_forms(spark):
    """A root is many forms away."""
    words = ["abcde" + "z" * i for i in range(20)]
    frame = spark.createDataFrame([(words[i], words[i + 1]) for i in range(19)], "word string, form string")
    assert {r.root for r in spelling.roots(frame).collect()} == {words[-1]}


def test_empty(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).count() == 0
