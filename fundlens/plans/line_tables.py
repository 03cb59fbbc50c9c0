"""Registered queries: tables out of lines, assignments, nested histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundlens.functions import exprs as X
from fundlens.operators import enrich as E
from fundlens.operators import lines as L
from fundlens.session import read_table as rt

BANDS = (("small", 0, 5_000), ("middle", 5_000, 50_000), ("large", 50_000, 1_000_000))
CENTRES = (("five", 5_000), ("twenty", 20_000), ("hundred", 100_000))


def _lines(spark, d):
    return L.explode_lines(rt(spark, d, "terms").select("term_id", "condition_text"), "term_id", "condition_text")


def document_lines(spark, d):
    x = L.explode_lines(rt(spark, d, "documents").select("doc_id", "text"), "doc_id", "text")
    return x.groupBy("doc").agg(F.count(F.lit(1)).alias("lines"), F.max(F.length("line")).alias("longest"))


def forward_fill_context(spark, d):
    y = F.nullif(F.regexp_extract("line", "(20[0-9]{2})", 1), F.lit(""))
    return L.forward_fill(_lines(spark, d), y, "year").select("doc", "line_no", "year")


def bounded_heading(spark, d):
    y = F.nullif(F.regexp_extract("line", "(20[0-9]{2})", 1), F.lit(""))
    return L.bounded_heading(_lines(spark, d), y, "year", 3).select("doc", "line_no", "year")


def block_segmentation(spark, d):
    """Lines from 'Council' on, up to a line that ends a sentence, in one text per block."""
    rows = L.inside_blocks(_lines(spark, d), F.col("line").contains("Council"), F.col("line").rlike(r"\.\s*$"))
    return L.assemble(rows)


def lookahead_stop(spark, d):
    return L.lookahead(_lines(spark, d), F.col("line").rlike("[0-9]"), "next_has_number").select("doc", "line_no", "next_has_number")


def asof_midpoint_assign(spark, d):
    a = rt(spark, d, "awards").where("member <> ''").select("award_id", "member", F.col("award_id").alias("place"), "amount")
    return L.midpoint_assign(a, F.coalesce(F.col("amount") > 50_000, F.lit(False)), "place", ["member"], "award_id").select("award_id", "anchor")


def range_band_assign(spark, d):
    return rt(spark, d, "awards").select("award_id", L.band_of(F.col("amount"), BANDS).alias("band"))


def nearest_band(spark, d):
    return rt(spark, d, "awards").select("award_id", L.nearest_of(F.col("amount"), CENTRES, 15_000).alias("centre"))


def roster_longest_prefix(spark, d):
    a = rt(spark, d, "awards")
    lines = a.where("organization <> ''").select("award_id", F.concat_ws(" ", "member", "organization").alias("line"))
    return L.longest_prefix(lines, "line", a.select("member"), "member").select("award_id", "match")


def frequent_member_lines(spark, d):
    return L.frequent_lines(rt(spark, d, "awards").select(F.col("member").alias("line")))


def positional_zip(spark, d):
    """The n-th capital line of an agency and year with the n-th part; surplus lines get a stand-in."""
    c = rt(spark, d, "capital").where("fiscal_year = 2024").select("project_id", "agency")
    parts = rt(spark, d, "capital").where("fiscal_year = 2023 and sponsor <> ''").select("agency", "project_id", "sponsor")
    return L.positional_zip(c, parts, "agency", "project_id", "project_id", "sponsor").select("project_id", "mapped")


def _award_lines(spark, d):
    a = rt(spark, d, "awards").where("organization <> '' and program <> '' and ein rlike '^[0-9]{9}$' and amount > 0 and agency rlike '^[A-Z]{3}$'")
    line = F.concat(F.col("organization"), F.lit(" - "), F.col("program"), F.lit(" "), F.substring("ein", 1, 2), F.lit("-"), F.substring("ein", 3, 7), F.lit(" $"), F.format_number("amount", 0), F.lit(" "), F.col("agency"))
    return a.select("award_id", line.alias("line"))


def extract_award_lines(spark, d):
    return L.extract_awards(_award_lines(spark, d)).select("award_id", "ein", "amount", "agency", F.length("organization").alias("org_chars"))


def extract_dates_distinct(spark, d):
    return rt(spark, d, "terms").select("term_id", X.dates_in(X.clean("condition_text")).alias("dates"), X.fiscal_year_in("condition_text").alias("fiscal"))


def capital_codes(spark, d):
    """Codes written into a title and taken out again."""
    t = F.concat_ws(" ", "title", F.concat(F.lit("B: "), F.nullif("building_code", F.lit(""))), F.concat(F.lit("S: "), F.nullif("school_code", F.lit(""))))
    c = rt(spark, d, "capital").where("title not rlike '[BS][:;]'").select("project_id", t.alias("t"))
    return c.select("project_id", X.last_code("t", "B").alias("building"), X.last_code("t", "S").alias("school"))


def row_clusters(spark, d):
    """Words of a title placed on a page and put back in order."""
    c = rt(spark, d, "capital").where("title <> ''").select("project_id", F.posexplode(F.split(X.clean("title"), " ")).alias("i", "word"))
    w = c.select("project_id", (F.lit(100) + F.pmod(F.col("i"), F.lit(2))).alias("top"), (F.col("i") * 10).alias("x0"), "word")
    return L.row_clusters(w, ["project_id"], "top", "x0", "word").select("project_id", "line")


def json_first_match(spark, d):
    """Histories built from resolutions: the adopting event of each."""
    t = rt(spark, d, "transparency")
    h = lambda action, event: F.struct(F.lit(action).alias("MatterHistoryActionName"), F.lit("City Council").alias("MatterHistoryActionBodyName"), F.pmod("action_id", F.lit(2)).cast("int").alias("MatterHistoryPassedFlag"), event.alias("MatterHistoryEventId"), F.col("date").alias("MatterHistoryActionDate"))
    j = F.to_json(F.array(h("Hearing Held", F.col("action_id")), h("Approved, by Council", F.col("action_id") + 1)))
    e = E.adopting_event(E.parse_history(j))
    return t.select("action_id", e["MatterHistoryEventId"].alias("event_id"))


QUERIES = {f.__name__: f for f in (document_lines, forward_fill_context, bounded_heading, block_segmentation, lookahead_stop, asof_midpoint_assign, range_band_assign, nearest_band, roster_longest_prefix, frequent_member_lines, positional_zip, extract_award_lines, extract_dates_distinct, capital_codes, row_clusters, json_first_match)}

_L = r"""WITH l AS (SELECT term_id AS doc, unnest(string_split_regex(condition_text, '\r\n|\n|\r')) AS line, generate_subscripts(string_split_regex(condition_text, '\r\n|\n|\r'), 1) - 1 AS line_no FROM terms WHERE condition_text <> '')
"""
_YEAR = "nullif(regexp_extract(line, '(20[0-9]{2})', 1), '')"
_WS = "[\\s\\p{Z}\\x0B\\x{85}]"


def _clean(x: str) -> str:
    return f"regexp_replace(regexp_replace(coalesce({x}, ''), '{_WS}+', ' ', 'g'), '^ | $', '', 'g')"



def _prefix(k: int) -> str:
    return f"CASE WHEN len(w) >= {k} THEN array_to_string(w[1:{k}], ' ') END"


_M = "January|February|March|April|May|June|July|August|September|October|November|December"
ORACLES = {
    "document_lines": r"SELECT doc, count(*) AS lines, max(length(line)) AS longest FROM (SELECT doc_id AS doc, unnest(string_split_regex(text, '\r\n|\n|\r')) AS line FROM documents WHERE text <> '') GROUP BY 1",
    "forward_fill_context": _L + f"SELECT doc, line_no, last_value({_YEAR} IGNORE NULLS) OVER (PARTITION BY doc ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS year FROM l",
    "bounded_heading": _L + f"SELECT doc, line_no, last_value({_YEAR} IGNORE NULLS) OVER (PARTITION BY doc ORDER BY line_no ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS year FROM l",
    "block_segmentation": _L + f""", b AS (SELECT *, contains(line, 'Council') AS st, regexp_matches(line, '[.]\\s*$') AS en, sum(CASE WHEN contains(line, 'Council') THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY line_no) AS block FROM l),
o AS (SELECT *, max(en::INT) OVER (PARTITION BY doc, block ORDER BY line_no) AS ov FROM b)
SELECT doc, block::BIGINT AS block, {_clean("string_agg(line, ' ' ORDER BY line_no)")} AS text FROM o WHERE block > 0 AND ov = 0 AND NOT st GROUP BY ALL""",
    "lookahead_stop": _L + "SELECT doc, line_no, coalesce(lead(regexp_matches(line, '[0-9]')) OVER (PARTITION BY doc ORDER BY line_no), false) AS next_has_number FROM l",
    "asof_midpoint_assign": """WITH a AS (SELECT award_id, member, CASE WHEN amount > 50000 THEN award_id END AS k FROM awards WHERE member <> ''),
w AS (SELECT *, last_value(k IGNORE NULLS) OVER (PARTITION BY member ORDER BY award_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p, first_value(k IGNORE NULLS) OVER (PARTITION BY member ORDER BY award_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n FROM a)
SELECT award_id, CASE WHEN n IS NULL OR (p IS NOT NULL AND award_id - p <= n - award_id) THEN p ELSE n END AS anchor FROM w""",
    "range_band_assign": "SELECT award_id, CASE WHEN amount >= 0 AND amount < 5000 THEN 'small' WHEN amount >= 5000 AND amount < 50000 THEN 'middle' WHEN amount >= 50000 AND amount < 1000000 THEN 'large' END AS band FROM awards",
    "nearest_band": "WITH c(n, x, i) AS (VALUES ('five', 5000, 0), ('twenty', 20000, 1), ('hundred', 100000, 2)), r AS (SELECT award_id, n, abs(amount - x) AS d, row_number() OVER (PARTITION BY award_id ORDER BY abs(amount - x), i) AS r FROM awards CROSS JOIN c) SELECT award_id, CASE WHEN d < 15000 THEN n END AS centre FROM r WHERE r = 1",
    "roster_longest_prefix": f"""WITH n AS (SELECT DISTINCT upper({_clean('member')}) AS n FROM awards WHERE {_clean('member')} <> ''),
l AS (SELECT award_id, string_split(upper({_clean("concat_ws(' ', member, organization)")}), ' ') AS w FROM awards WHERE organization <> '')
SELECT award_id, coalesce(a.n, b.n, c.n) AS match FROM l LEFT JOIN n a ON a.n = {_prefix(3)} LEFT JOIN n b ON b.n = {_prefix(2)} LEFT JOIN n c ON c.n = {_prefix(1)}""",
    "frequent_member_lines": "SELECT member AS line, count(*) AS n FROM awards WHERE regexp_full_match(member, '[A-Z][A-Za-z.''\\-]+(?: [A-Z][A-Za-z.''\\-]+){0,2}') GROUP BY 1 HAVING count(*) >= 5",
    "positional_zip": "WITH l AS (SELECT project_id, agency, row_number() OVER (PARTITION BY agency ORDER BY project_id) AS n FROM capital WHERE fiscal_year = 2024), r AS (SELECT agency, sponsor, row_number() OVER (PARTITION BY agency ORDER BY project_id) AS n FROM capital WHERE fiscal_year = 2023 AND sponsor <> '') SELECT project_id, coalesce(sponsor, 'UNMAPPED_BLOCK_' || l.n) AS mapped FROM l LEFT JOIN r ON r.agency = l.agency AND r.n = l.n",
    "extract_award_lines": f"""WITH h AS (SELECT *, trim(regexp_replace({_clean("organization || ' - ' || program")}, '\\s*\\*+\\s*$', '')) AS head FROM awards
WHERE organization <> '' AND program <> '' AND regexp_full_match(ein, '[0-9]{{9}}') AND amount > 0 AND regexp_full_match(agency, '[A-Z]{{3}}'))
SELECT award_id, ein, amount, agency, length(trim(split_part(head, CASE WHEN contains(head, ' – ') THEN ' – ' ELSE ' - ' END, 1))) AS org_chars FROM h""",
    "extract_dates_distinct": f"SELECT term_id, coalesce(array_to_string(list_sort(list_distinct(regexp_extract_all({_clean('condition_text')}, '\\b((?:{_M}) [0-9]{{1,2}}, [0-9]{{4}})\\b', 1))), '; '), '') AS dates, nullif(regexp_extract(condition_text, '(?i)\\bFiscal\\s*(?:Year\\s*)?(\\d{{4}})\\b', 1), '')::INT AS fiscal FROM terms",
    "capital_codes": "SELECT project_id, coalesce(building_code, '') AS building, coalesce(school_code, '') AS school FROM capital WHERE NOT regexp_matches(title, '[BS][:;]')",
    "row_clusters": f"SELECT project_id, {_clean('title')} AS line FROM capital WHERE title <> ''",
    "json_first_match": "SELECT action_id, CASE WHEN action_id % 2 = 1 THEN action_id + 1 END AS event_id FROM transparency",
}
