"""Registered queries: answers of the API, checks on strings, ordered groups, views and deep links."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundlens.functions import exprs as X
from fundlens.operators import canonical as C
from fundlens.operators import pivot as P
from fundlens.operators import quality as Q
from fundlens.operators import query as A
from fundlens.operators import rejects
from fundlens.plans import rollup, totals
from fundlens.session import read_table as rt

GATE_YEAR, GATE_TOTAL = 2024, 655_764_999


def api_years(spark, d):
    """The years tool, through the entry of the API."""
    got = A.call("list_available_fiscal_years", {n: rt(spark, d, n) for n in ("awards", "capital", "terms", "transparency")}, {})
    return spark.createDataFrame([(r["dataset"], r["years"], r["first_year"], r["last_year"]) for r in got["rows"]], "dataset string, years string, first_year int, last_year int")


def api_ein_answer(spark, d):
    """The whole answer for the EIN with most awards: its rows stay in the cluster, its text is summed there."""
    got = A.call("get_awards_by_ein", {"awards": rt(spark, d, "awards")}, {"ein": "70-2157919"})
    total = got["rows"].df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("amount", F.lit(0))).cast("bigint").alias("total"))
    return total.withColumn("first_line", F.lit(got["text"].split("\n")[0]))


def api_refusals(spark, d):
    """What the API says to requests it cannot plan, and the limits it takes."""
    tables = {n: rt(spark, d, n) for n in ("awards", "capital", "terms", "transparency")} | {"legislation_crosswalk": rt(spark, d, "documents")}
    asked = [("search_awards", {"council_district": 3}), ("search_capital_projects", {"council_district": 3}), ("get_terms_conditions", {"district": 1}), ("get_legislation_link", {}), ("get_awards_by_ein", {}), ("search_awards", {"fiscal_year": "2024"}), ("nothing", {})]
    rows = [(i, t, A.call(t, tables, a)["error"][:60]) for i, (t, a) in enumerate(asked)]
    rows += [(100 + i, "limit", str(A.cap(x))) for i, x in enumerate((None, 0, 7.9, 9999))]
    return spark.createDataFrame(rows, "n int, tool string, said string")


def first_award_of_year(spark, d):
    """The first award of a year and kind, by id."""
    a = rt(spark, d, "awards").select("award_id", "fiscal_year", "award_type", "organization")
    return P.first_match(a, {"fiscal_year": 2024, "award_type": "member_item"}, ["award_id"])


def qa_raw_amounts(spark, d):
    """Amounts that are no numbers, on the texts as delivered; their exact count comes with the rows."""
    a = rejects.parse_lines(rt(spark, d, "raw_lines").where("dataset = 'awards'").select("line_id", "line"), rejects.AWARDS_FORMAT)
    return a.where(X.malformed_amount("amount")).select(F.col("line_id").alias("row_id"), F.lit("non_numeric_amount").alias("check"), F.lit("HARD").alias("severity"))


def qa_raw_verdict(spark, d):
    """One row: is there a hard violation among the delivered amounts, and how many?"""
    found = qa_raw_amounts(spark, d)
    return found.agg(F.count(F.lit(1)).alias("hard")).withColumn("failed", F.lit(Q.has_hard(found)))


def collision_groups_ordered(spark, d):
    """Groups of spellings, those of most spellings and most money first; the union of their years."""
    s = rollup._stats(spark, d)
    g = C.collision_groups(s, X.norm_mechanical("variant"))
    years = s.select(X.norm_mechanical("variant").alias("norm"), F.explode("years").alias("y")).groupBy("norm").agg(F.array_join(F.array_sort(F.collect_set("y")).cast("array<string>"), ",").alias("years"))
    ranked = g.join(years, "norm").orderBy(F.desc("variants"), F.desc("amount"), "norm")
    return P.with_dense_id(ranked.select((-F.col("variants")).alias("_v"), (-F.col("amount")).alias("_a"), "norm", "variants", "amount", "years"), ["_v", "_a", "norm"], "place").drop("_v", "_a")


def spelling_groups(spark, d):
    """Strong forms that several mild forms share, over the settled and unsettled raw names."""
    x = rt(spark, d, "initiative_name_crosswalk").select(F.col("raw_initiative").alias("name"), F.lit(0).alias("fiscal_year"), F.lit(1).cast("bigint").alias("amount"))
    return C.aggressive_only(C.variant_stats(x, "name"), X.norm_mechanical("variant"), X.norm_aggressive("variant"))


def category_supergroups(spark, d):
    """Editorial forms that several mechanical forms share, with their dominant spelling, over the raw categories."""
    x = rt(spark, d, "category_name_crosswalk").select(F.col("raw_category").alias("name"), F.lit(0).alias("fiscal_year"), F.col("raw_id").alias("amount"))
    s = C.variant_stats(x, "name")
    return C.aggressive_only(s, X.mech_norm_category("variant"), X.edit_norm_category("variant")).join(C.dominant_spelling(s, X.edit_norm_category("variant")), "norm")


def _leaves(spark, d):
    return P.wide_leaves(totals._yearly(spark, d).where("category <> '' and initiative <> ''"), totals.KEYS, (2023, 2024))


def grand_total_gate(spark, d):
    return P.gate_total(_leaves(spark, d), GATE_YEAR, GATE_TOTAL)


def budget_view_columns(spark, d):
    latest = totals.latest_agency(spark, d).select("category", "initiative", "bucket", "description")
    return P.budget_view(_leaves(spark, d).join(latest, ["category", "initiative"]))


def deep_link_rows(spark, d):
    return P.follow_route(totals._yearly(spark, d), "#fund-detail/food-access?year=2024")


QUERIES = {f.__name__: f for f in (api_years, api_ein_answer, api_refusals, first_award_of_year, qa_raw_amounts, qa_raw_verdict, collision_groups_ordered, spelling_groups, category_supergroups, grand_total_gate, budget_view_columns, deep_link_rows)}


def _years(table: str, col: str) -> str:
    return f"SELECT '{table}' AS dataset, string_agg(y::VARCHAR, ',' ORDER BY y) AS years, min(y) AS first_year, max(y) AS last_year FROM (SELECT DISTINCT {col} AS y FROM {table} WHERE {col} IS NOT NULL)"


_SAID = (
    (0, "search_awards", "Error: search_awards does not accept `council_district`. Accepted parameters: "), (1, "search_capital_projects", "Error: search_capital_projects does not accept `council_district`. "),
    (2, "get_terms_conditions", "Error: get_terms_conditions does not accept `district`. Accepted "), (3, "get_legislation_link", "Error: get_legislation_link needs at least one of fiscal_year, document"),
    (4, "get_awards_by_ein", "Error: get_awards_by_ein needs `ein`."), (5, "search_awards", "Error: `fiscal_year` must be an integer."), (6, "nothing", "Error: Unknown tool: nothing"), (100, "limit", "50"), (101, "limit", "1"), (102, "limit", "7"), (103, "limit", "500"),
)
_RAW = r"""l AS (SELECT line_id, coalesce(line, '') AS line, regexp_replace(coalesce(line, ''), '"(?:[^"]|"")*"', 'q', 'g') AS bare FROM raw_lines WHERE dataset = 'awards'),
s AS (SELECT line_id, regexp_extract_all(',' || line, '(?s),("(?:[^"]|"")*"|[^",]*)', 1)[8] AS cell FROM l
  WHERE regexp_full_match(line, '(?s)(?:"(?:[^"]|"")*"|[^",]*)(?:,(?:"(?:[^"]|"")*"|[^",]*))*') AND len(bare) - len(replace(bare, ',', '')) = 9 AND NOT regexp_matches(bare, '[\r\n]')),
u AS (SELECT line_id, CASE WHEN cell LIKE '"%' THEN replace(substr(cell, 2, len(cell) - 2), '""', '"') ELSE cell END AS a FROM s),
m AS (SELECT line_id FROM u WHERE regexp_replace(a, '\s', '', 'g') <> '' AND NOT regexp_full_match(regexp_replace(a, '[$, ]', '', 'g'), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[dDfF]?|(?i)[+-]?(inf|infinity)|(?i)nan'))"""
_XI = "allinit AS (SELECT 0 AS fiscal_year, raw_initiative AS name, 1 AS amount FROM initiative_name_crosswalk)"
_XC = "allinit AS (SELECT 0 AS fiscal_year, raw_category AS name, raw_id AS amount FROM category_name_crosswalk)"
_LEAVES = totals._Y + """, leaves AS (SELECT category, initiative, coalesce(sum(adopted) FILTER (WHERE fiscal_year = 2023), 0)::BIGINT AS a3, coalesce(sum(adopted) FILTER (WHERE fiscal_year = 2024), 0)::BIGINT AS a4,
  coalesce(sum(itemized) FILTER (WHERE fiscal_year = 2023), 0)::BIGINT AS i3, coalesce(sum(itemized) FILTER (WHERE fiscal_year = 2024), 0)::BIGINT AS i4 FROM y WHERE category <> '' AND initiative <> '' GROUP BY category, initiative),
leaf AS (SELECT *, row_number() OVER (ORDER BY category, initiative) AS id FROM leaves)"""
ORACLES = {
    "api_years": " UNION ALL ".join([_years("awards", "fiscal_year"), _years("capital", "fiscal_year"), _years("terms", "fiscal_year"), _years("transparency", "source_fy")]),
    "api_ein_answer": "WITH a AS (SELECT count(*) AS n, coalesce(sum(amount), 0)::BIGINT AS total FROM awards WHERE regexp_replace(coalesce(ein, ''), '[^0-9]', '', 'g') = '702157919') SELECT n, total, n || ' row(s), ' || CASE WHEN total < 0 THEN '-' ELSE '' END || '$' || format('{:,}', abs(total)) AS first_line FROM a",
    "api_refusals": "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{t}', '{s[:60]}')" for i, t, s in _SAID) + ") t(n, tool, said)",
    "first_award_of_year": "SELECT award_id, fiscal_year, award_type, organization FROM awards WHERE fiscal_year = 2024 AND award_type = 'member_item' ORDER BY award_id LIMIT 1",
    "qa_raw_amounts": f"WITH {_RAW} SELECT line_id AS row_id, 'non_numeric_amount' AS \"check\", 'HARD' AS severity FROM m",
    "qa_raw_verdict": f"WITH {_RAW} SELECT count(*) AS hard, count(*) > 0 AS failed FROM m",
    "collision_groups_ordered": f"""WITH {rollup._ALL}, {rollup._stats_sql('initiative')}, s AS (SELECT *, {rollup.mechanical_sql('variant')} AS norm FROM stats),
g AS (SELECT norm, count(*) AS variants, sum(amount)::BIGINT AS amount, array_to_string(list_sort(list_distinct(flatten(list(years)))), ',') AS years FROM s GROUP BY norm HAVING count(*) > 1)
SELECT norm, variants, amount, years, row_number() OVER (ORDER BY variants DESC, amount DESC, norm) AS place FROM g""",
    "spelling_groups": f"WITH {_XI}, {rollup._stats_sql('name')} SELECT {rollup.aggressive_sql('variant')} AS norm, count(*) AS variants, count(DISTINCT {rollup.mechanical_sql('variant')}) AS forms, sum(amount)::BIGINT AS amount FROM stats GROUP BY 1 HAVING count(DISTINCT {rollup.mechanical_sql('variant')}) > 1",
    "category_supergroups": f"""WITH {_XC}, {rollup._stats_sql('name')}, g AS (SELECT {rollup.edit_category_sql('variant')} AS norm, count(*) AS variants, count(DISTINCT {rollup.mech_category_sql('variant')}) AS forms, sum(amount)::BIGINT AS amount FROM stats GROUP BY 1 HAVING count(DISTINCT {rollup.mech_category_sql('variant')}) > 1),
{rollup._dominant_sql(rollup.edit_category_sql('variant'))} SELECT * FROM g JOIN dom USING (norm) JOIN cas USING (norm)""",
    "grand_total_gate": _LEAVES + f" SELECT {GATE_YEAR} AS year, coalesce(sum(a4), 0)::BIGINT AS computed, {GATE_TOTAL}::BIGINT AS target, coalesce(sum(a4), 0) = {GATE_TOTAL} AS passed FROM leaf",
    "budget_view_columns": _LEAVES + ", la AS (" + totals.ORACLES["latest_agency"].replace("WITH " + totals._AD + ", ", "WITH ") + """) SELECT category AS "Fund", initiative AS "Department", bucket AS "Control Officer", initiative AS "Short Title", description AS "Department Description", id AS "Department ID", '' AS "Link to Website",
  a3 AS "Adopted 2023", least(a3, i3) AS "Itemized 2023", a4 AS "Adopted 2024", least(a4, i4) AS "Itemized 2024" FROM leaf JOIN la USING (category, initiative)""",
    "deep_link_rows": totals._Y + "SELECT * FROM y WHERE fiscal_year = 2024 AND replace(regexp_replace(lower(category), '[^\\w ]', '', 'g'), ' ', '-') = 'food-access'",
}
