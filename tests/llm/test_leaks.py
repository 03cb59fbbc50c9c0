import random

import numpy as np

from fundlens.llm import leaks as L

ITEM = "The visiting clerk noted every leased van near the old pier today. A retired officer doubted openly that seven vouchers cost less than one stamp. Both flooded gymnasiums stood idle since autumn while snow closed the northern annex again."


def found(spark, docs, items=((1, ITEM),)):
    d = spark.createDataFrame(docs, "doc_id bigint, text string, item_id int")
    i = spark.createDataFrame(list(items), "item_id bigint, text string")
    return {(r.doc_id, r.item_id) for r in L.leaked(L.tiles(d, i)).collect()}


def test_cases(spark):
    w = ITEM.split()
    twelve, eleven = " ".join(w[3:15]), " ".join(w[3:14])
    swap = [x if i % 7 else "zebra" for i, x in enumerate(w)]
    heavy = [x if i % 4 else "zebra" for i, x in enumerate(w)]
    sentences = ITEM.split(". ")
    docs = [
        (1, "x " + twelve.upper().replace(" ", ", ") + " y", 0), (2, "x " + eleven + " y", 0), (3, " ".join(swap), 0), (4, " ".join(heavy), 0), (5, None, 0), (6, "", 0), (7, ITEM, 0), (8, ITEM, 0),
        (9, "word " * 50_000 + ITEM, 0), (10, " ".join(swap[: len(" ".join(sentences[:2]).split())]), 0), (11, "漢字 " + twelve, 0),
    ]
    assert found(spark, docs) == {(1, 1), (3, 1), (7, 1), (8, 1), (9, 1), (11, 1)}
    assert found(spark, docs, ((1, ITEM), (2, ITEM), (3, None), (4, ""))) >= {(7, 1), (7, 2)}
    assert found(spark, []) == set() and found(spark, docs, ()) == set()


def test_item_blocks(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_WORDS", 10)
    assert found(spark, [(7, ITEM, 0)], [(i, ITEM) for i in range(5)]) == {(7, i) for i in range(5)}


def test_runs_against_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(30)) + ".") for i in range(8)]
    docs = []
    for d in range(120):
        words = [rng.choice(vocab) for _ in range(rng.randint(0, 60))]
        src = items[rng.randrange(8)][1].rstrip(".").split()
        a = rng.randint(0, 18)
        words[5:5] = src[a : a + rng.randint(8, 14)]
        docs.append((d, " ".join(words), 0))
    runs = lambda t: {tuple(t[i : i + 12]) for i in range(len(t) - 11)}
    want = {(d, i) for d, t, _ in docs for i, x in items if runs(t.split()) & runs(x.rstrip(".").split())}
    assert found(spark, docs, items) == want


def test_tiling_marks_each_word_once():
    item = L.Item(1, np.arange(1, 21), np.array([0, 20]))
    doc = np.concatenate([np.arange(11, 21), np.arange(1, 11), np.arange(1, 11)])
    longest, covered, _ = L.tile(doc, item, 4)
    assert (longest, covered) == (10, 20)
