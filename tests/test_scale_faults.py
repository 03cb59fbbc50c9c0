"""Faults that small tables hide: ids of many partitions, answers larger than any limit, casts, links beyond the bound."""

from pyspark.sql import functions as F

from fundlens.functions import exprs as X
from fundlens.operators import closure, drift, lines, orphans, pivot, query, rejects


def test_dense_ids_of_many_rows(spark, tmp_path):
    n = 1_000_000
    d = spark.range(n, numPartitions=8).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    pivot.with_dense_id(d, ["k"], "i").write.parquet(str(tmp_path / "ids"))
    back = spark.read.parquet(str(tmp_path / "ids"))
    assert back.agg(F.countDistinct("i"), F.min("i"), F.max("i")).first() == (n, 1, n)
    assert back.where("i <= 1000").orderBy("k").select("i").limit(1000).agg(F.max("i")).first()[0] == 1000


def test_whole_answer_by_ein(spark):
    a = spark.range(150_000).select(F.col("id").alias("award_id"), F.lit(2024).alias("fiscal_year"), F.lit("12-3456789").alias("ein"), F.lit(2).cast("bigint").alias("amount"))
    out = query.call("get_awards_by_ein", {"awards": a}, {"ein": "123456789"})
    assert len(out["rows"]) == 150_000 and sum(1 for _ in out["rows"]) == 150_000 and out["text"].startswith("150000 row(s), $300,000")
    assert query.call("get_awards_by_ein", {"awards": a}, {"ein": "1"})["text"] == "No matching rows."
    years = query.call("list_available_fiscal_years", {"awards": a}, {})
    assert years["rows"] == [{"dataset": "awards", "years": "2024", "first_year": 2024, "last_year": 2024}] and "error" in query.call("list_available_fiscal_years", {"awards": a}, {"x": 1})


def test_casts_label_cells(spark):
    award = "a,b,c,d,e,f,123456789,{},x,y"
    lines = [(1, award.format("99999999999999999999")), (2, award.format(" -$ 12 ")), (3, award.format("9223372036854775807")), (4, award.format(""))]
    t = rejects.typed(rejects.parse_lines(spark.createDataFrame(lines, "line_id bigint, line string"), rejects.AWARDS_FORMAT), rejects.AWARDS_FORMAT)
    assert {r.line_id: (r.amount, r.failed) for r in t.collect()} == {1: (None, '{"amount":"99999999999999999999"}'), 2: (-12, None), 3: (9223372036854775807, None), 4: (None, None)}
    capital = "I,PARKS,b,,K,12x,2,3,,s,t,,"
    c = rejects.typed(rejects.parse_lines(spark.createDataFrame([(1, capital)], "line_id bigint, line string"), rejects.CAPITAL_FORMAT), rejects.CAPITAL_FORMAT)
    assert [(r.fy1, r.fy2, r.fy4, r.failed) for r in c.collect()] == [(None, 2, None, '{"fy1":"12x"}')]


def test_links_beyond_the_bound(spark, monkeypatch):
    links = spark.createDataFrame([("boro", "borough", 5), ("borough", "bor", 2), ("bor", "district", 1), ("x", "y", 3), ("title", "district", 1)], "a string, b string, n bigint")
    few = {tuple(r) for r in closure.resolve_names(links, ["boro", "title"]).collect()}
    monkeypatch.setattr(closure, "MAX_NAME_LINKS", 2)
    assert {tuple(r) for r in closure.resolve_names(links, ["boro", "title"]).collect()} == few == {("boro", "boro"), ("title", "title"), ("borough", "boro"), ("bor", "boro"), ("district", "boro")}


def _feed(spark, *files):
    rows = [(100 * s + i, "capital", "s", s, "f", i, r) for s, f in enumerate(files, 1) for i, r in enumerate(f)]
    return spark.createDataFrame(rows, "feed_id bigint, dataset string, series string, file_seq int, file_name string, row_no int, record string")


def test_mixed_numbers_and_nested_columns(spark):
    f = _feed(spark, ['{"fy1": 1, "at": {"zip": "10001"}}', '{"fy1": 2.5, "at": {"zip": "10002"}}'], ['{"fy1": 3.5, "at": {"zipcode": "10001"}}'], ['{"fy1": 3.5, "at": {"zipcode": 10001}}'])
    got = {tuple(r) for r in drift.column_changes(f).collect()}
    assert got == {("s", 2, "at.zipcode", "renamed"), ("s", 3, "at.zipcode", "retyped")}


def test_no_value_of_a_record_is_lost(spark):
    f = _feed(spark, ['{"boro": "K", "title": "a"}'], ['{"borough": "K", "title": "a"}'], ['{"boro": "Q", "borough": "K", "title": "a"}'])
    rows = {r.file_seq: (r.boro, r.other) for r in drift.consistent_table(f, "capital").collect()}
    assert rows[1] == ("K", "{}") and rows[2] == ("K", "{}") and rows[3] == ("Q", '{"borough":"K"}')


def test_flooding_settles_what_columns_alone_do_not(monkeypatch):
    p = lambda kind, *v: {"kind": kind, "len": 4.0, "digits": 0.0, "vsig": list(v), "ssig": [1] * 6}
    same = [7] * 12
    old = {"site": p("object", *same), "site.kode": p("text", *same), "plan": p("object", *same), "plan.kode": p("text", *same)}
    new = {"site": p("object", *same), "site.code": p("text", *same), "plan": p("object", *same), "plan.code": p("text", *same)}
    want = [("plan.kode", "plan.code"), ("site.kode", "site.code")]
    assert sorted(drift.match_schemas(old, new)) == want
    crossed = {("plan.kode", "site.code"): 1.0, ("site.kode", "plan.code"): 1.0, ("plan.kode", "plan.code"): 0.9, ("site.kode", "site.code"): 0.9}
    monkeypatch.setattr(drift, "flood", lambda a, b: crossed)
    assert sorted(drift.match_schemas(old, new)) != want  # the settled score decides


def test_orphans_come_from_counts(spark, monkeypatch):
    e = spark.createDataFrame([("a", "2024-01-01 00:00:00", "2024-03-01 00:00:00"), ("b", "2024-01-01 00:00:00", None)], "k string, loaded_at string, withdrawn_at string").select("k", F.col("loaded_at").cast("timestamp"), F.col("withdrawn_at").cast("timestamp"))
    r = spark.createDataFrame([(1, "a", "2024-02-01 10:00:00"), (2, "a", "2024-03-01 00:00:00"), (3, "b", "2023-12-31 23:59:59"), (4, "b", "2024-05-01 00:00:00"), (5, "c", "2024-05-01 00:00:00"), (6, "a", None), (7, None, "2024-05-01 00:00:00")], "i int, k string, t string").select("i", "k", F.col("t").cast("timestamp"))
    got = lambda: {x.i: x.status for x in orphans.label_orphans(r, e, ["k"], "t").collect()}
    assert got() == {2: "deleted", 3: "late", 5: "missing", 6: "late"}
    counted = orphans.reference_deltas
    monkeypatch.setattr(orphans, "reference_deltas", lambda *a: counted(*a).withColumn("refs", F.lit(0)))
    assert got() == {}


def test_accents_and_agency_leads(spark):
    r = spark.createDataFrame([("ă č ł ñ é Å 한",)], "s string").select(X.deaccent("s")).first()[0]
    assert r == "a c ł n e A 한"
    a, b = X.agency_prefix_split(F.col("s"))
    rows = spark.createDataFrame([("DYCD/Hhs Arts fund",), ("Arts fund",), ("DFTA",), ("DYCD, HhS Arts",)], "s string").select(a, b).collect()
    assert [tuple(x) for x in rows] == [("", "DYCD/Hhs Arts fund"), ("", "Arts fund"), ("", "DFTA"), ("DYCD, HhS", "Arts")]


def test_nearest_anchor_grows_with_the_rows(spark):
    import random

    rng = random.Random(4)
    rows = [(i, k, rng.choice([None, *range(40)]), rng.random() < 0.2) for k in ("a", "b") for i in rng.sample(range(100), 60)] + [(200, "c", 1, False)]
    points = spark.createDataFrame(rows, "i int, k string, p int, anchor_here boolean")
    d = lines.midpoint_assign(points, F.col("anchor_here"), "p", ["k"], "i")
    assert "unboundedfollowing" not in d._jdf.queryExecution().optimizedPlan().toString().lower()  # Spark works such a frame out anew for every row
    want = {}
    for k in "abc":
        mine = sorted((r for r in rows if r[1] == k), key=lambda r: (r[2] is not None, r[2] or 0, r[0]))
        for at, (i, _, p, _) in enumerate(mine):
            before, after = [r for r in mine[: at + 1] if r[3]][-1:], [r for r in mine[at:] if r[3]][:1]
            near = before and after and None not in (p, before[0][2], after[0][2]) and p - before[0][2] <= after[0][2] - p
            want[k, i] = next(iter(before if near or not after else after), (None,))[0]
    assert {(r.k, r.i): r.anchor for r in d.collect()} == want
