import json

from fundlens.operators import drift as D


def feed(spark, files, dataset="capital"):
    rows, n = [], 0
    for series, seq, records in files:
        for i, r in enumerate(records, 1):
            n += 1
            rows.append((n, dataset, series, seq, f"f{seq}", i, r if r is None or isinstance(r, str) else json.dumps(r)))
    return spark.createDataFrame(rows, "feed_id bigint, dataset string, series string, file_seq int, file_name string, row_no int, record string")


def changes(spark, files, dataset="capital"):
    return {tuple(r) for r in D.column_changes(feed(spark, files, dataset)).collect()}


BASE = [{"title": f"HALL {i}", "boro": b, "fy1": 1000 * i} for i, b in enumerate("QKXMQ", 1)]


def test_changes(spark):
    add = [{**r, "is_reso_a": i % 2 == 0} for i, r in enumerate(BASE)]
    gone = [{k: v for k, v in r.items() if k != "fy1"} for r in add]
    ren = [{("borough" if k == "boro" else k): v for k, v in r.items()} for r in gone]
    typed = [{**r, "borough": [r["borough"]]} for r in ren]
    assert changes(spark, [("s", 1, BASE), ("s", 2, add), ("s", 3, gone), ("s", 4, ren), ("s", 6, typed)]) == {("s", 2, "is_reso_a", "added"), ("s", 3, "fy1", "removed"), ("s", 4, "borough", "renamed"), ("s", 6, "borough", "retyped")}


def test_no_change(spark):
    order = [dict(reversed(list(r.items()))) for r in BASE]
    partly = [BASE[0], *({k: v for k, v in r.items() if k != "boro"} for r in BASE[1:])]
    nulls = [{**r, "boro": None} for r in BASE]
    assert changes(spark, [("s", 1, BASE), ("s", 2, order), ("s", 3, partly), ("s", 4, nulls), ("s", 5, BASE)]) == set()
    assert changes(spark, [("s", 1, BASE), ("s", 2, nulls), ("s", 3, [{**r, "boro": 3} for r in BASE])]) == {("s", 3, "boro", "retyped")}


def test_unrelated_columns_are_not_renamed(spark):
    a = [{"unit_count": i} for i in range(1, 6)]
    b = [{"contact_unit": n} for n in ("Office of A", "Office of B", "Bureau C", "Office of D", "E")]
    assert changes(spark, [("s", 1, a), ("s", 2, b)]) == {("s", 2, "unit_count", "removed"), ("s", 2, "contact_unit", "added")}


def test_odd_input(spark):
    assert changes(spark, []) == set()
    assert changes(spark, [("s", 1, [None, "", "no json", "[1]", "{}"]), ("s", 2, [{"a": 1}])]) == {("s", 2, "a", "added")}
    assert changes(spark, [("s", 1, [{"x y": 1.5}]), ("t", 1, [{"z": 1}])]) == set()


def test_one_table(spark):
    files = [("s", 1, BASE), ("s", 2, [{"borough": r["boro"], "title": r["title"], "fy1": str(r["fy1"]), "odd": 1} for r in BASE])]
    t = {r.feed_id: r for r in D.consistent_table(feed(spark, files), "capital").collect()}
    assert len(t) == 10 and t[6].boro == "Q" and t[6].fy1 == 1000 and json.loads(t[6].other) == {"odd": "1"}


def test_flooding_prefers_like_columns():
    p = lambda kind, n, d, v: {"kind": kind, "len": n, "digits": d, "vsig": list(range(v, v + 12)), "ssig": list(range(v, v + 6))}
    old = {"keep": p("text", 9.0, 0.0, 1), "sub_id": p("text", 5.0, 0.6, 50), "act": p("text", 6.0, 0.0, 90)}
    new = {"keep": old["keep"], "subId": old["sub_id"], "change_action": old["act"]}
    assert set(D.match_schemas(old, new)) == {("sub_id", "subId"), ("act", "change_action")}
