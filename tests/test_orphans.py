import datetime as dt

from fundlens.operators import orphans as O

T = lambda d: dt.datetime(2020, 1, d)
ENTRY = "k string, loaded_at timestamp, withdrawn_at timestamp"
REF = "id int, k string, at timestamp, extra string"


def label(spark, entries, refs):
    e, r = spark.createDataFrame(entries, ENTRY), spark.createDataFrame(refs, REF)
    return {x.id: x.status for x in O.label_orphans(r, e, ["k"], "at").collect()}


def test_statuses(spark):
    entries = [("a", T(5), T(10)), ("a", T(5), T(10)), ("b", T(5), T(10)), ("b", T(8), None), ("c", T(9), T(7)), ("c", T(9), T(7))]
    refs = [(1, "a", T(4), ""), (2, "a", T(5), ""), (3, "a", T(9), ""), (4, "a", T(10), ""), (5, "b", T(20), ""), (6, "z", T(6), ""), (7, None, T(6), ""), (8, "c", T(8), ""), (9, "c", T(9), ""), (10, "a", None, ""), (11, "z", None, "")]
    assert label(spark, entries, refs) == {1: "late", 4: "deleted", 6: "missing", 8: "late", 9: "deleted", 10: "late", 11: "missing"}


def test_gap_between_entries(spark):
    entries = [("a", T(1), T(3)), ("a", T(6), T(8)), ("a", T(3), T(4))]
    assert label(spark, entries, [(d, "a", T(d), "") for d in range(1, 10)]) == {4: "deleted", 5: "deleted", 8: "deleted", 9: "deleted"}


def test_brute_force(spark):
    import random

    rng = random.Random(3)
    entries = []
    for _ in range(300):
        a = rng.randint(1, 28)
        entries.append((rng.choice("abcdefgh"), T(a), T(b) if (b := rng.randint(1, 30)) < 29 else None))
    refs = [(i, rng.choice("aaaaaaabcdefghz"), T(rng.randint(1, 28)), "x") for i in range(500)]
    want = {}
    for i, k, t, _ in refs:
        own = [e for e in entries if e[0] == k]
        if not any(e[1] <= t and (e[2] is None or e[2] > t) for e in own):
            want[i] = "missing" if not own else "deleted" if any(e[1] <= t for e in own) else "late"
    assert label(spark, entries, refs) == want


def test_empty_and_state(spark):
    assert label(spark, [], [(1, "a", T(1), "")]) == {1: "missing"}
    assert label(spark, [("a", T(1), None)], []) == {}
    e, r = spark.createDataFrame([("a", T(1), None), ("b", T(1), T(2))], ENTRY), spark.createDataFrame([(1, "a", T(1), ""), (2, "b", T(1), ""), (3, "b", T(1), "")], REF)
    state = O.reference_state(r, e, ["k"])
    assert [(x.k, x.refs) for x in O.current_orphans(state).collect()] == [("b", 2)]
    after = O.apply_deltas(state, spark.createDataFrame([("b", -2, 0), ("a", 0, -1)], "k string, refs bigint, present bigint"), ["k"])
    assert [(x.k, x.refs, x.present) for x in after.collect()] == [("a", 1, 0)]
