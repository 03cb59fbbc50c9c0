"""Registered queries over printed pages: small fixtures of lines and words, and what must come of them.

Lines that a parser finds hard are rare in clean tables, so these pages are written out
here; the SQL beside each states the expected rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from fundlens.operators import charts, layouts, reconcile, schedules
from fundlens.operators import enrich as E
from fundlens.operators import lines as L
from fundlens.operators import quality as Q


def _lines(spark, *docs: str):
    rows = [(d, i, x) for d, text in enumerate(docs, 1) for i, x in enumerate(text.strip("\n").split("\n"))]
    return spark.createDataFrame(rows, "doc int, line_no int, line string")


def _words(spark, *rows: tuple):
    """(page, top, [(x0, text), ...]): a word is 6 points wide a letter."""
    out = [("d", p, t, float(x), float(x + 6 * len(t)), float(top)) for p, top, ws in rows for x, t in ws]
    return spark.createDataFrame(out, "doc string, page int, text string, x0 double, x1 double, top double")


def _roster(spark, *names: str):
    return spark.createDataFrame([(n,) for n in names], "member string")


# ------------------------------------------------------------------ lines

RESOLUTION = """
CHART 1: Local Initiatives - Fiscal 2026
Member Organization EIN Number Agency Amount Agy # U/A
Alliance for
Brannan Coastal Care - Youth Camp 11-1111111 DYCD $5,000 260 312
Parks, Inc. **
Bay Ridge
De La Rosa Uptown Arts 22-2222222 DCLA ($3,000) 126 003
of Inwood
Page 1 of 2
Bronx Delegation Hill Club 33-3333333 DYCD $700 260 005
$9 broken 444444444 row
CHART 2: Artificial Intelligence Community Engagement - Fiscal 2026 (continued)
Organization EIN Number Agency Amount
Learning Lab 55-5555555 DOE ($1,000)
Code Hall 66-6666666 DOE $600
Chip House 77-7777777 DOE $400
CHART 3: Purpose of Funds - Fiscal 2025
Source Member Organization EIN Number Agency Amount
Local Brannan Coastal Care 11-1111111 DYCD $5,000 to support
swim lessons
and boats
Senior Friends
Aging De La Rosa of Inwood 88-8888888 DFTA $900 to feed elders
"""
TOPS = (10, 20, 30, 38, 46, 60, 70, 78, 90, 100, 104, 110, 120, 130, 140, 150, 160, 170, 180, 185, 190, 195, 200)


def transparency_charts(spark, d):
    lines = _lines(spark, RESOLUTION).withColumnRenamed("line", "text")
    tops = spark.createDataFrame(list(enumerate(map(float, TOPS))), "line_no int, top double")
    return charts.extract_transparency(lines.join(tops, "line_no"), _roster(spark, "Brannan", "De La Rosa", "Rosa"))


def transparency_spotlight(spark, d):
    rows = transparency_charts(spark, d).withColumns({"resolution": F.lit("R1"), "date": F.lit("2025-07-14")})
    return charts.spotlight(rows, "Artificial Intelligence")


def transparency_spotlight_recipients(spark, d):
    return charts.spotlight_recipients(transparency_charts(spark, d), "Artificial Intelligence")


def appendix_records(spark, d):
    text = """
Fiscal Year 2024 Adopted Expense Budget Adjustment Summary
Brannan Shore Aid - Swim
Club 11-1111111 $5,000 DYCD
To teach swimming
12
to children.
De La Rosa Uptown Arts 222222222 $1,250 DCLA/DYCD
For paint.
Hill Club 33-3333333 $700
"""
    return schedules.extract_appendix(_lines(spark, text), _roster(spark, "Brannan", "De La Rosa"))


def summary_adjacent(spark, d):
    text = """
Contents of Education
EDUCATION
Fiscal 2015 Council Initiatives
Agency Initiative Amount
DOE Summer
Reading $1,000
DYCD/DOE Results Based Accountability for Council Initiatives $500,000
Housing Help $ 100,000
Youth Build 2,100,000
Fiscal 2015 Council Initiatives
TOTAL $2,701,000
Agency Initiative Amount
Loose Ends $5
TOTAL $5
Agency Initiative Amount
Never Ended $7
"""
    cats = spark.createDataFrame([("Education",)], "name string")
    return schedules.extract_summary_adjacent(_lines(spark, text), cats)


def summary_legacy(spark, d):
    text = """
Fiscal Year 2011 Changes
SENIOR SERVICES
Agency Initiative Funding
DFTA Meals for the
Homebound
$1,499, 254
DYCD Food Pantries (Harvest Home)$60,000
TOTAL $1,559,254
Agency Initiative Funding
DOE Dropout Prevention $3
TOTAL $3
"""
    return schedules.extract_summary_legacy(_lines(spark, text))


def terms_unnumbered(spark, d):
    text = """
Terms and Conditions
Administration for Children's Services (068)
Unit of Appropriation 001
Department of Correction (072)
Units of Appropriation [002]
The agencies shall report by July 15, 2016 and
by January 15, 2017. Unit of Appropriation 003 is exempt.
Unit of Appropriation 004
14
Capital Budget
Budget Line HX-1  and more
for the period beginning July 1, 2015 and ending June 30, 2016.
"""
    return schedules.extract_terms_unnumbered(_lines(spark, text))


def contents_in_order(spark, d):
    rows = [(1, 2, i, x) for i, x in enumerate(["Table of Contents", "SCHEDULE C INTRODUCTION .... 1", "Aging ....... 5", "Education...... 9", "Appendix A .... 40"])]
    rows += [(1, 3, 0, "AGING ..... 6"), (1, 3, 1, "Arts ..... 12"), (1, 5, 0, "Beyond ..... 99"), (1, 9, 0, "Contents")]
    rows += [(2, 4, i, f"Category {x} ..... {i}") for i, x in enumerate("ABCDE")] + [(2, 6, 0, "Single ..... 1")]
    rows += [(3, 1, i, f"Few {i} ..... {i}") for i in range(3)]
    return schedules.contents_categories(spark.createDataFrame(rows, "doc int, page int, line_no int, line string"))


def contents_lines_once(spark, d):
    return L.contents_entries(_lines(spark, "Aging ..... 5\nplain\nAGING .... 7\nArts...12"))


def section_start(spark, d):
    rows = [(1, 3, "APPENDIX B"), (1, 7, "text"), (1, 8, "Appendix b: local"), (1, 9, "Appendix B"), (2, 6, "none")]
    return L.first_page_with(spark.createDataFrame(rows, "doc int, page int, line string"), "Appendix B", "page")


def printed_totals(spark, d):
    return L.extract_printed_totals(_lines(spark, "TOTALS FOR PARKS AND RECREATION (12 PROJECTS) 1,200\n3,400 0 0 TOTALS FOR LIBRARIES (1 PROJECT)\nTotals for ALL (13 projects) 4,600\nno total"))


def roster_peel(spark, d):
    rows = spark.createDataFrame([("DE LA ROSA, BRANNAN Roof repair",), ("Brannanville Roof",), ("Peña library",), ("none here",)], "text string")
    names, rest = L.peel_names(F.col("text"), ["Rosa", "De La Rosa", "Brannan", "Pena"])
    return rows.select("text", names.alias("names"), rest.alias("rest"))


def report_words(spark, d):
    texts = ["24/24 reconcilable categories exact", "23 / 24 categories exact; 30/30 agency subtotals reconcile", "30/30 agency subtotals reconcile", "This year is not reconcilable: 3/3 categories exact", "nothing", None]
    r = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    return reconcile.rollup_reports(r).select("id", "exact", "total", "status")


def junk_rows_dropped(spark, d):
    rows = [(1, "Sponsor Legal Name"), (2, "Legal Aid"), (3, None), (4, "the COUNCIL MEMBER fund"), (5, "Program Name")]
    return schedules.without_header_rows(spark.createDataFrame(rows, "id int, organization string"))


def header_columns(spark, d):
    columns = [c for c in Q.SPECS["awards"].required if c != "purpose"] + ["fiscal_year", "remark"]
    diff = Q.header_differences(columns, Q.SPECS["awards"])
    return spark.createDataFrame([(k, c) for k, cs in diff.items() for c in cs], "kind string, column_name string")


def _enriched(spark):
    h = '[{"MatterHistoryActionName":"%s","MatterHistoryActionBodyName":"City Council","MatterHistoryPassedFlag":%s,"MatterHistoryEventId":%s,"MatterHistoryActionDate":"2025-06-30"}]'
    xw = [("a", "M1", "confirmed", None), ("b", "M2", "confirmed", None), ("c", "M1", "unconfirmed", None), ("d", "M3", "confirmed", 7), ("e", "M9", "confirmed", None)]
    before = spark.createDataFrame(xw, "local_file string, legistar_matter_number string, status string, adopting_event_id bigint")
    hist = spark.createDataFrame([("M1", h % ("Approved, by Council", 1, 22592)), ("M2", h % ("Approved, by Council", 0, 5)), ("M3", h % ("Approved, by Council", 1, 9)), ("M9", "[]")], "legistar_matter_number string, history string")
    return before, E.enrich(before, hist)


def crosswalk_enriched(spark, d):
    return _enriched(spark)[1].select("local_file", "status", "adopting_event_id", "adopting_body", "adopting_datetime")


def crosswalk_counters(spark, d):
    return E.counters(*_enriched(spark))


# ------------------------------------------------------------------ words on pages

_HEAD = [(40, "SUB"), (60, "ID"), (90, "BUDGET"), (130, "LINE"), (170, "BORO"), (220, "PROJECT"), (264, "TITLE"), (400, "FY"), (450, "FY"), (500, "FY"), (550, "FY"), (620, "SPONSOR")]


def _capital_page(spark):
    return _words(
        spark,
        (1, 30, [(700, "I.")]), (1, 100, _HEAD), (1, 120, [(300, "PARKS"), (345, "DEPARTMENT")]),
        (1, 140, [(40, "P-1"), (90, "PV"), (110, "D01"), (175, "K"), (222, "Roof"), (250, "B:K1"), (410, "1,000"), (474, "0"), (505, "-20"), (575, "14"), (620, "Brannan")]), (1, 142, [(280, "repair")]),
        (1, 150, [(222, "north"), (260, "wing"), (620, "Rosa")]), (1, 170, [(40, "P-2"), (90, "PV"), (175, "Q"), (222, "Fence"), (410, "2,000")]),
        (1, 190, [(222, "TOTALS"), (262, "FOR"), (284, "PARKS"), (318, "(2"), (334, "PROJECTS)"), (412, "3,000")]), (1, 200, [(222, "stray"), (256, "note")]),
        (2, 100, _HEAD), (2, 120, [(40, "L-1"), (90, "LN"), (175, "M"), (222, "Shelves"), (410, "5,000"), (620, "Rosa")]), (3, 100, [(40, "no"), (60, "table")]), (3, 140, [(40, "X-1"), (90, "PV"), (175, "K"), (222, "Lost")]),
        (2, 190, [(222, "TOTALS"), (262, "FOR"), (284, "ALL"), (306, "(3"), (322, "PROJECTS)"), (412, "8,000")]),
    )


def capital_by_place(spark, d):
    return layouts.coordinate_projects(_capital_page(spark), 792.0).drop("doc")


def capital_totals_by_place(spark, d):
    return layouts.coordinate_totals(_capital_page(spark), 792.0).drop("doc")


def capital_bands(spark, d):
    b = layouts.header_bands(_capital_page(spark), "BORO", layouts.CAPITAL_LABELS, 110.0, 380.0)
    return b.select("page", "sub", "budget", "boro", "title", "sponsor", F.array_join(F.transform("fy", lambda x: x.cast("int").cast("string")), ",").alias("fy"))


def capital_page_parts(spark, d):
    return layouts.page_parts(_capital_page(spark)).drop("doc")


def rows_by_first_word(spark, d):
    """Heights 10, 12, 13, 15, 18: the first word of a row is the measure, so 13 belongs to 10 and 15 does not."""
    w = _words(spark, (1, 10, [(0, "a")]), (1, 12, [(9, "b")]), (1, 13, [(18, "c")]), (1, 15, [(0, "d")]), (1, 18, [(9, "e")]))
    return layouts.page_rows(w).select("y", layouts.joined(F.col("ws")).alias("line"))


def capital_changes(spark, d):
    w = _words(
        spark,
        (1, 110, [(96, "LINE"), (140, "TITLE")]), (1, 120, [(300, "CULTURAL"), (360, "AFFAIRS")]), (1, 140, [(40, "PV-DN06Y"), (96, "Theatre"), (530, "ELIMINATE")]), (1, 150, [(96, "restoration,"), (180, "S:"), (196, "M123"), (300, "9,000")]),
        (1, 160, [(391, "680,000(CN)"), (490, "5,000(CN)")]), (1, 170, [(96, "phase"), (130, "two"), (530, "SUBSTITUTE")]), (1, 180, [(530, "ELIMINATE")]), (1, 190, [(530, "(NEW"), (560, "PROJECT)")]),
        (1, 200, [(300, "PARKS")]), (1, 210, [(96, "outside")]), (2, 120, [(40, "P-D1"), (96, "Fence")]),
    )
    return layouts.appropriation_changes(w).drop("doc")


def _entity_page(spark):
    head = [(40, "ORGANIZATION"), (374, "BUDGET"), (416, "LINE"), (460, "FY"), (520, "FY"), (580, "FY"), (640, "FY")]
    return _words(
        spark,
        (1, 30, [(700, "III.")]), (1, 110, head), (1, 120, [(40, "Museum"), (82, "of")]), (1, 130, [(40, "Boats"), (470, "$300"), (530, "$10")]), (1, 140, [(374, "PV"), (392, "N1"), (476, "100")]), (1, 150, [(374, "PV"), (392, "N2"), (476, "200"), (536, "10")]),
        (1, 160, [(40, "Zoo"), (470, "$50")]), (1, 170, [(374, "PV"), (392, "N3"), (482, "40")]), (2, 110, head), (2, 120, [(40, "TOTAL"), (80, "NON-CITY"), (140, "PROJECT"), (190, "ALLOCATIONS"), (470, "$350")]),
    )


def entity_lines(spark, d):
    return layouts.entity_rows(_entity_page(spark)).drop("doc")


def entity_totals(spark, d):
    return layouts.entity_crosstab(_entity_page(spark)).drop("doc")


QUERIES = {f.__name__: f for f in (
    transparency_charts, transparency_spotlight, transparency_spotlight_recipients, appendix_records, summary_adjacent, summary_legacy, terms_unnumbered, contents_in_order, contents_lines_once, section_start,
    printed_totals, roster_peel, report_words, junk_rows_dropped, header_columns, crosswalk_enriched, crosswalk_counters, capital_by_place, capital_totals_by_place, capital_bands, capital_page_parts, rows_by_first_word,
    capital_changes, entity_lines, entity_totals,
)}


def _rows(columns: str, *rows: tuple) -> str:
    one = lambda v: "NULL" if v is None else str(v) if not isinstance(v, str) else "'" + v.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(one, r)) + ')' for r in rows)}) t({columns})"


_C1, _C2, _C3 = "Local Initiatives - Fiscal 2026", "Artificial Intelligence Community Engagement - Fiscal 2026", "Purpose of Funds - Fiscal 2025"
ORACLES = {
    "transparency_charts": _rows(
        "doc, line_no, chart, fiscal_year, action, source, council_member, organization, program, ein, amount, agency, agy_num, ua, purpose, flags",
        (1, 3, _C1, "2026", "designate", "", "Brannan", "Alliance for Coastal Care", "Youth Camp Parks, Inc.", "111111111", 5000, "DYCD", "260", "312", "", "**"),
        (1, 6, _C1, "2026", "rescind", "", "De La Rosa", "Bay Ridge Uptown Arts of Inwood", "", "222222222", -3000, "DCLA", "126", "003", "", ""),
        (1, 9, _C1, "2026", "designate", "", "De La Rosa", "Hill Club", "", "333333333", 700, "DYCD", "260", "005", "", ""),
        (1, 13, _C2, "2026", "rescind", "", "", "Learning Lab", "", "555555555", -1000, "DOE", "", "", "", ""), (1, 14, _C2, "2026", "designate", "", "", "Code Hall", "", "666666666", 600, "DOE", "", "", "", ""),
        (1, 15, _C2, "2026", "designate", "", "", "Chip House", "", "777777777", 400, "DOE", "", "", "", ""),
        (1, 18, _C3, "2025", "purpose_change", "Local", "Brannan", "Coastal Care", "", "111111111", 5000, "DYCD", "", "", "to support swim lessons and boats", ""),
        (1, 22, _C3, "2025", "purpose_change", "", "Brannan", "Senior Friends Aging De La Rosa of Inwood", "", "888888888", 900, "DFTA", "", "", "to feed elders", ""),
    ),
    "transparency_spotlight": _rows("resolution, date, rows, net, rescinded, designated, recipients", ("R1", "2025-07-14", 3, 0, -1000, 1000, 2)),
    "transparency_spotlight_recipients": _rows("organization, amount", ("Code Hall", 600), ("Chip House", 400)),
    "appendix_records": _rows(
        "doc, n, member, organization, program, ein, amount, agency, purpose",
        (1, 1, "Brannan", "Shore Aid", "Swim Club", "111111111", 5000, "DYCD", "To teach swimming to children."), (1, 2, "De La Rosa", "Uptown Arts", "", "222222222", 1250, "DCLA/DYCD", "For paint. Hill Club"),
        (1, 3, "", "For paint. Hill Club", "", "333333333", 700, "", ""),
    ),
    "summary_adjacent": _rows(
        "doc, block, line_no, category, agency, initiative, amount, printed", (1, 1, 5, "Education", "DOE", "Summer Reading", 1000, 2701000), (1, 1, 6, "Education", "DYCD/DOE", "Results Based Accountability for Council Initiatives", 500000, 2701000),
        (1, 1, 7, "Education", "", "Housing Help", 100000, 2701000), (1, 1, 8, "Education", "", "Youth Build", 2100000, 2701000), (1, 2, 12, "UNMAPPED_BLOCK_@11", "", "Loose Ends", 5, 5),
    ),
    "summary_legacy": _rows("doc, block, line_no, category, agency, initiative, amount, printed", (1, 1, 5, "SENIOR SERVICES", "DFTA", "Meals for the Homebound", 1499254, 1559254), (1, 1, 6, "SENIOR SERVICES", "DYCD", "Food Pantries (Harvest Home)", 60000, 1559254), (1, 2, 9, "SENIOR SERVICES", "DOE", "Dropout Prevention", 3, 3)),
    "terms_unnumbered": _rows(
        "doc, item_number, agency_name, agency_code, units_of_appropriation, num_units, report_deadlines, coverage_period, condition_text",
        (1, 1, "Administration for Children's Services", "068", "001; 002", 2, "January 15, 2017; July 15, 2016", "", "The agencies shall report by July 15, 2016 and by January 15, 2017. Unit of Appropriation 003 is exempt. Unit of Appropriation 004"),
        (1, 2, "Capital Budget", "", "Budget Line HX-1 and more", 1, "July 1, 2015; June 30, 2016", "July 1, 2015 to June 30", "for the period beginning July 1, 2015 and ending June 30, 2016."),
    ),
    "contents_in_order": _rows("doc, n, category", (1, 1, "Aging"), (1, 2, "Education"), (1, 3, "Arts"), *((2, i, f"Category {x}") for i, x in enumerate("ABCDE", 1)), (2, 6, "Single")),
    "contents_lines_once": _rows("doc, line_no, title, page", (1, 0, "Aging", 5), (1, 3, "Arts", 12)),
    "section_start": _rows("doc, page", (1, 8)),
    "printed_totals": _rows("doc, line_no, agency, projects, is_grand, amount", (1, 0, "PARKS AND RECREATION", 12, False, 1200), (1, 1, "LIBRARIES", 1, False, 3400), (1, 2, "ALL", 13, True, 4600)),
    "roster_peel": _rows("text, names, rest", ("DE LA ROSA, BRANNAN Roof repair", "DE LA ROSA, BRANNAN", "Roof repair"), ("Brannanville Roof", "", "Brannanville Roof"), ("Peña library", "Pena", "library"), ("none here", "", "none here")),
    "report_words": _rows("id, exact, total, status", (0, 24, 24, "PASS"), (1, 23, 24, "PARTIAL"), (2, 30, 30, "PASS"), (3, None, None, "N/A"), (4, None, None, "unparsed"), (5, None, None, "unparsed")),
    "junk_rows_dropped": _rows("id, organization", (2, "Legal Aid"), (3, None)),
    "header_columns": _rows("kind, column_name", ("missing", "purpose"), ("extra", "remark")),
    "crosswalk_enriched": _rows("local_file, status, adopting_event_id, adopting_body, adopting_datetime", ("a", "confirmed", 22592, "City Council", "2025-06-30"), ("b", "confirmed", None, None, ""), ("c", "unconfirmed", None, None, None), ("d", "confirmed", 7, None, None), ("e", "confirmed", None, None, "")),
    "crosswalk_counters": _rows("confirmed, already_done, enriched, no_adopting_event, skipped_status", (4, 1, 1, 2, 1)),
    "capital_by_place": _rows(
        "block, part, agency, budget_line, sub_id, boro, fy1, fy2, fy3, fy4, title, building_code, school_code, sponsor", (1, "I", "PARKS DEPARTMENT", "P-1", "PV D01", "K", 1000, 0, -20, 14, "Roof  repair north wing", "K1", "", "Brannan Rosa"),
        (2, "I", "PARKS DEPARTMENT", "P-2", "PV", "Q", 2000, 0, 0, 0, "Fence", "", "", ""), (3, "I", "PARKS DEPARTMENT", "L-1", "LN", "M", 5000, 0, 0, 0, "Shelves", "", "", "Rosa"),
    ),
    "capital_totals_by_place": _rows("part, agency, projects, fy1", ("I", "PARKS", 2, 3000)),
    "capital_bands": _rows("page, sub, budget, boro, title, sponsor, fy", *((p, 40.0, 90.0, 170.0, 220.0, 620.0, "400,450,500,550") for p in (1, 2))),
    "capital_page_parts": _rows("page, part", (1, "I"), (2, "I"), (3, "I")),
    "rows_by_first_word": _rows("y, line", (10.0, "a b c"), (15.0, "d e")),
    "capital_changes": _rows(
        "block, agency, budget_line, fy1, fy2, fy3, fy4, title, building_code, school_code, action",
        (1, "CULTURAL AFFAIRS", "PV-DN06Y", 680000, 5000, 0, 0, "Theatre restoration,  phase two", "", "M123", "ELIMINATE, SUBSTITUTE, NEW PROJECT"), (2, "PARKS", "P-D1", 0, 0, 0, 0, "Fence", "", "", ""),
    ),
    "entity_lines": _rows(
        "page, y, kind, entity, organization, code, fy1, fy2, fy3, fy4", (1, 120.0, "wrap", 0, "", "", 0, 0, 0, 0), (1, 130.0, "entity", 1, "Museum of Boats", "", 300, 10, 0, 0), (1, 140.0, "line", 1, "Museum of Boats", "PV N1", 100, 0, 0, 0), (1, 150.0, "line", 1, "Museum of Boats", "PV N2", 200, 10, 0, 0),
        (1, 160.0, "entity", 2, "Zoo", "", 50, 0, 0, 0), (1, 170.0, "line", 2, "Zoo", "PV N3", 40, 0, 0, 0), (2, 120.0, "grand", 2, "Zoo", "", 350, 0, 0, 0),
    ),
    "entity_totals": _rows("entity, organization, printed, parsed, lines, same", (1, "Museum of Boats", 300, 300, 2, True), (2, "Zoo", 50, 40, 1, False)),
}
