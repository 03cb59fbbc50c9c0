import random

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fundlens.llm import formcopies as C


def canon(s):
    return "".join(c.lower()[0] for c in (s or "") if c.isalnum())


@given(st.lists(st.text(max_size=30), min_size=1, max_size=20))
@settings(max_examples=150, deadline=None)
def test_hash_agrees_with_canonical_text(texts):
    h = C.FieldHasher()(pa.array(texts))
    seen = {}
    for t, x in zip(texts, h.tolist()):
        assert seen.setdefault(canon(t), x) == x
    assert len(set(seen.values())) == len(seen)


@given(st.text(max_size=25), st.text(max_size=25))
@settings(max_examples=300, deadline=None)
def test_two_pointers(a, b):
    assert C.same_text(a, b) == (canon(a) == canon(b))
    assert C.same_text(a, "-".join(a.upper().lower())) == (canon(a) == canon("-".join(a.upper().lower())))


def find(spark, rows):
    df = spark.createDataFrame(rows, "id bigint, a string, b string, c string, y int, extra string")
    return {tuple(r) for r in C.find_copies(df, "id", ("a", "b", "c"), {"y": F.col("y")}).collect()}


def test_cases(spark):
    long = "Väry long. " * 20_000
    rows = [
        (1, "St. Anne's Hall", "Choir", None, 1, ""), (2, "st annes HALL", "", "CHOIR!", 1, "x"), (3, "choir", None, "St-Annes (Hall)", 1, ""),
        (4, "St. Anne's Hall", "Choir", None, 2, ""), (5, "St. Anne's Hall", "Choir", None, None, ""), (6, "ST ANNES HALL", "choir", "", None, ""),
        (7, "Chöir", "", "", 1, ""), (8, "Choir", "", "", 1, ""), (9, None, "", None, 1, ""), (10, "...", None, "--", 1, ""),
        (11, long, "a", "b", 1, ""), (12, "B", long.upper(), "A", 1, ""), (13, "ab", "c", "", 1, ""), (14, "a", "bc", "", 1, ""), (15, "x", "x", "y", 1, ""), (16, "x", "y", "y", 1, ""),
    ]
    assert find(spark, rows) == {(1, 2), (1, 3), (5, 6), (9, 10), (11, 12)}
    assert find(spark, []) == set()


def test_hot_group_and_random(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        t = "hot name" if i % 3 == 0 else f"{rng.choice('abcdef')} {rng.randint(0, 9)}"
        rows.append((i, "".join(rng.choice((c, c.upper())) for c in t) + rng.choice(("", ".", " -")), rng.choice(("p", "")), "", i % 2, ""))
    groups = {}
    for i, a, b, c, y, _ in rows:
        groups.setdefault((tuple(sorted(map(canon, (a, b, c)))), y), []).append(i)
    assert find(spark, rows) == {(g[0], x) for g in groups.values() for x in g[1:]}


def test_colliding_keys_are_separated(spark, monkeypatch):
    monkeypatch.setattr(C, "hash_fields", lambda df, i, f, e: df.select(F.col(i).alias("_id"), F.lit(1).alias("k1"), F.lit(1).alias("k2")))
    rows = [(1, "a", "", "", 1, ""), (2, "b", "", "", 1, ""), (3, "A", "", "", 1, ""), (4, "B", "", "", 1, ""), (5, "b", "", "", 2, ""), (6, "B.", "", "", 2, "")]
    assert find(spark, rows) == {(1, 3), (2, 4), (5, 6)}
