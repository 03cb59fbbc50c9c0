import json
import os

import pytest
from pyspark.sql import functions as F

from fundlens.operators import canonical as C
from fundlens.operators import enrich as E
from fundlens.operators import lines as L
from fundlens.operators import quality as Q
from fundlens.operators import reconcile as R
from fundlens.sources import readers, sinks
from fundlens.streaming import net


def lines(spark, text):
    return L.explode_lines(spark.createDataFrame([(1, text), (2, None), (3, "")], "d bigint, t string"), "d", "t")


def test_terms(spark):
    t = "TERMS\n12. Bureau of Fire (057)\nUnit of Appropriation [001]\nUnit of Appropriation 002\nReport by May 5, 2024,\nfor the period beginning July 1 and ending June 30, please.\nPage 3 of 9\n44\n13. Parks (846)\nNothing."
    r = sorted(L.extract_terms(lines(spark, t)).collect(), key=lambda x: x.item_number)
    assert [(x.item_number, x.agency_name, x.agency_code, x.units_of_appropriation, x.num_units, x.report_deadlines, x.coverage_period) for x in r] == [(12, "Bureau of Fire", "057", "001; 002", 2, "May 5, 2024", "July 1 to June 30"), (13, "Parks", "846", "", 0, "", "")]
    assert r[0].condition_text.endswith("please.")


def test_initiatives_and_capital(spark):
    t = "ARTS\nAgency Initiative Funding\nDYF Choir fund $1,000\nDHS Dance 2,000\nTOTAL $3,000\nDYF outside $5"
    assert [(r.category, r.agency, r.initiative, r.amount) for r in L.extract_initiatives(lines(spark, t)).orderBy("line_no").collect()] == [("ARTS", "DYF", "Choir fund", 1000), ("ARTS", "DHS", "Dance", 2000)]
    t = "I.\nDEPARTMENT OF PARKS\nAG CN001 AG D001 K Roof of I.S. 240 1,000 0 -5 7 Smith, Jones\nTOTALS FOR DEPARTMENT OF PARKS (1 PROJECTS) 1,000\nTOTALS FOR ALL (1 PROJECTS) 1,000"
    r = L.extract_capital(lines(spark, t), ["SMITH", "JONES"]).collect()[0]
    assert (r.part, r.agency, r.sub_id, r.budget_line, r.boro, r.fy1, r.fy3, r.fy4, r.title, r.sponsor) == ("I", "DEPARTMENT OF PARKS", "AG CN001", "AG D001", "K", 1000, -5, 7, "Roof of I.S. 240", "Smith, Jones")
    assert [(x.agency, x.projects, x.is_grand, x.amount) for x in L.extract_printed_totals(lines(spark, t)).orderBy("line_no").collect()] == [("DEPARTMENT OF PARKS", 1, False, 1000), ("ALL", 1, True, 1000)]
    assert [(x.title, x.page) for x in L.contents_entries(lines(spark, "Arts ..... 5\nARTS .... 7\nno")).collect()] == [("Arts", 5)]


def test_peel(spark):
    d = spark.createDataFrame([("Brooklyn Delegation, SmíthROOF",), ("Roof only",)], "t string")
    n, r = L.peel_names(F.col("t"), ["BROOKLYN", "BROOKLYN DELEGATION", "SMITH"])
    got = [tuple(x) for x in d.select(n, r).collect()]
    assert got[1] == ("", "Roof only")


def test_reports_and_enrichment(spark):
    d = spark.createDataFrame([("25 / 25 categories exact",), ("3/4 agency subtotals reconcile",), ("NOT RECONCILABLE",), ("?",)], "text string")
    assert [r.status for r in R.rollup_reports(d).collect()] == ["PASS", "PARTIAL", "N/A", "unparsed"]
    h = json.dumps([{"MatterHistoryActionName": "Approved, by Council", "MatterHistoryActionBodyName": "City Council", "MatterHistoryPassedFlag": 1, "MatterHistoryEventId": 9, "MatterHistoryActionDate": "2024-06-30"}])
    x = spark.createDataFrame([("a", "M1", "confirmed", None), ("b", "M2", "confirmed", None), ("c", "M1", "candidate", None), ("d", "M1", "confirmed", 4)], "local_file string, legistar_matter_number string, status string, adopting_event_id bigint")
    after = E.enrich(x, spark.createDataFrame([("M1", h), ("M1", h), ("M2", "[]")], "legistar_matter_number string, history string"))
    assert {r.local_file: r.adopting_event_id for r in after.collect()} == {"a": 9, "b": None, "c": None, "d": 4}
    assert tuple(E.counters(x, after).first()) == (3, 1, 1, 1, 1)


def test_roll_up_keeps_rows_and_order(spark):
    d = spark.createDataFrame([(2020, "A", "X & Y", 5), (2020, "A", "X & Y", 5), (2021, "B", None, None)], "fiscal_year int, category string, initiative string, amount bigint")
    ix = spark.createDataFrame([("X & Y", "XY", "high"), ("X & Y", "", "high")], "raw_initiative string, initiative_canonical string, confidence string")
    cx = spark.createDataFrame([("A", None, "AA"), ("A", "X & Y", "split"), ("B", "", "")], "raw_category string, initiative string, category_canonical string")
    out = C.combined([d, d.limit(0)], ix, cx)
    assert out.columns == ["fiscal_year", "category", "category_canonical", "initiative", "initiative_canonical", "amount"]
    assert sorted((r.category_canonical, r.initiative_canonical) for r in out.collect()) == [("B", ""), ("split", "XY"), ("split", "XY")]


def test_quality(spark):
    assert Q.header_differences(["part", "x"], Q.SPECS["capital"])["extra"] == ["x"]
    assert "| t | c | HARD | 1,234 | 1,2 |" in Q.report([type("R", (), dict(table_name="t", check="c", severity="HARD", n=1234, sample="1,2"))])


def test_sources_and_sinks(spark, tmp_path):
    for y in ("fy26", "fy27"):
        os.makedirs(tmp_path / y)
        (tmp_path / y / f"{y}_schedule_c_initiatives.csv").write_text('﻿category,initiative\n"A, b"," two\nlines "\nC,\n' if y == "fy27" else "category,initiative\nD,e\nF,g,h\n")
    root = str(tmp_path)
    assert readers.detect_type("x/fy27_schedule_c_awards.csv") == "schedule_c_awards" and readers.detect_type("legistar_crosswalk.csv") is None and readers.detect_type("reso7_transparency_designations.csv") == "transparency_reso"
    t = readers.read_tree(spark, root, {"schedule_c_initiatives": ["category", "initiative"]})["schedule_c_initiatives"]
    assert t.count() == 4 and t.where("_corrupt is not null").count() == 1
    y = readers.read_years(spark, root + "/fy*/*_initiatives.csv", ["category", "initiative"])
    assert {(r.year, r.fiscal_year) for r in y.collect()} == {("FY26", 2026), ("FY27", 2027)}
    n = sinks.write_table(y, root + "/t.parquet", "fiscal_year", "category")
    assert n == 4 and readers.open_tables(spark, root, ["t"])["t"].count() == 4
    with pytest.raises(readers.TablesNotBuilt):
        readers.open_tables(spark, root, ["none"])
    e, found = readers.optional(spark, root + "/no.csv", readers.text_schema(["a"]), lambda p: None)
    assert not found and e.columns == ["a"] and e.count() == 0
    sinks.write_csv(y, root + "/c", ["initiative", "absent", "category"], single=True, crlf=True)
    assert readers.read_csv_strict(spark, root + "/c", ["initiative", "absent", "category"]).count() >= 4
    assert sinks.todo(y, y.where("year = 'FY26'"), ["year"]).select("year").distinct().count() == 1


def test_service_waits_and_remembers():
    calls, slept = [], []
    answers = iter([(429, None), (200, "ok")])
    s = readers.Service(lambda u: calls.append(u) or next(answers), sleep=slept.append)
    assert s.get("u") == "ok" and s.get("u") == "ok" and len(calls) == 2 and slept == [2.0, 1.1]
    with pytest.raises(RuntimeError):
        readers.Service(lambda u: (500, None), sleep=slept.append).get("u")


def test_streams_equal_batch(spark, sf, tmp_path):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    src = str(tmp_path / "in")
    ev.repartition(3).write.parquet(src)
    s = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = net.event_windows(s, late="100 days").writeStream.outputMode("complete").format("memory").queryName("win").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("win").select("start", "event_type", "n").collect())) == sorted(map(tuple, net.event_windows(ev, late=None).select("start", "event_type", "n").collect()))
    t = spark.read.parquet(f"{sf}/transparency.parquet").select("ein", "fiscal_year", "amount")
    t.repartition(3).write.parquet(str(tmp_path / "tin"))
    st = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "tin"))
    net.keep_net_positions(spark, st, str(tmp_path / "net"), str(tmp_path / "cp")).awaitTermination()
    last = sorted(os.listdir(tmp_path / "net"))[-1]
    key = lambda r: (r.ein or "", r.fiscal_year or 0, r.net, r.n)
    assert sorted(map(key, spark.read.parquet(str(tmp_path / "net" / last)).collect())) == sorted(map(key, net.net_positions(t).collect()))
