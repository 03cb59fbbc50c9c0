"""Registered queries of the parameterised API."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundlens.functions import exprs as X
from fundlens.operators import query as Q
from fundlens.session import read_table as rt

_AWARD = ("award_id", "fiscal_year", "category", "initiative", "award_type", "member", "organization", "program", "ein", "amount", "agency")


def _awards(spark, d):
    return rt(spark, d, "awards").select(*_AWARD)


def search_awards_filter(spark, d):
    return Q.search_awards(_awards(spark, d), organization="association", fiscal_year=2024, category="s", limit=200)


def awards_by_ein_rows(spark, d):
    return Q.awards_by_ein(_awards(spark, d), ein="70-2157919")


def awards_by_ein_year_summary(spark, d):
    return Q.year_summary(Q.awards_by_ein(_awards(spark, d), ein="702157919"))


def organizations_per_ein(spark, d):
    return Q.names_on_ein(_awards(spark, d), "award_id")


def search_transparency(spark, d):
    return Q.search_transparency(rt(spark, d, "transparency"), action="rescind", fiscal_year=2023, limit=500)


def capital_search_topk(spark, d):
    return Q.search_capital(rt(spark, d, "capital"), agency="library", title="roof%replac", limit=100)


def terms_text_truncate(spark, d):
    return Q.terms_conditions(rt(spark, d, "terms"), agency="office of", limit=500)


def fiscal_year_coverage(spark, d):
    t = lambda n: rt(spark, d, n)
    return Q.available_years(awards=(t("awards"), "fiscal_year"), capital=(t("capital"), "fiscal_year"), terms=(t("terms"), "fiscal_year"), transparency=(t("transparency"), "source_fy"), initiatives=(t("initiatives"), "fiscal_year"))


def documents_like_link(spark, d):
    """Substring filter with a wildcard, a derived link, newest first."""
    x = rt(spark, d, "documents").select("fiscal_year", F.col("source").alias("document_type"), F.lit("").alias("local_file"), F.col("matter_number").alias("adopting_event_id"), "doc_id")
    return Q.legislation_links(x, document_type="transparency_reso")


def top_agencies(spark, d):
    """The four agencies with most conditions."""
    return rt(spark, d, "terms").where("agency_name <> ''").groupBy("agency_name").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "agency_name").limit(4)


def channel_split(spark, d):
    return rt(spark, d, "awards").groupBy("award_type").agg(F.sum(F.coalesce("amount", F.lit(0))).cast("bigint").alias("total"), F.count(F.lit(1)).alias("n"))


def awards_pushdown(spark, d):
    """Equality map filter on two plain columns: both reach the scan."""
    return rt(spark, d, "awards").where((F.col("fiscal_year") == 2025) & (F.col("award_type") == "member_item")).select("award_id", "amount")


def money_formats(spark, d):
    a = rt(spark, d, "awards").select("award_id", "amount", "ein")
    return a.select("award_id", X.money_display("amount").alias("shown"), X.valid_ein("ein").alias("ein_ok"), X.norm_ein("ein").alias("ein_digits"))


QUERIES = {f.__name__: f for f in (search_awards_filter, awards_by_ein_rows, awards_by_ein_year_summary, organizations_per_ein, search_transparency, capital_search_topk, terms_text_truncate, fiscal_year_coverage, documents_like_link, top_agencies, channel_split, awards_pushdown, money_formats)}

_A = ", ".join(_AWARD)
_EIN = "regexp_replace(coalesce(ein, ''), '[^0-9]', '', 'g')"


def _years(name: str, table: str, col: str) -> str:
    return f"SELECT '{name}' AS dataset, string_agg(y::VARCHAR, ',' ORDER BY y) AS years, min(y) AS first_year, max(y) AS last_year FROM (SELECT DISTINCT {col} AS y FROM {table} WHERE {col} IS NOT NULL)"


ORACLES = {
    "search_awards_filter": f"SELECT {_A} FROM awards WHERE lower(organization) LIKE '%association%' AND lower(category) LIKE '%s%' AND fiscal_year = 2024 ORDER BY fiscal_year NULLS FIRST, member NULLS FIRST, amount DESC NULLS LAST, award_id LIMIT 200",
    "awards_by_ein_rows": f"SELECT {_A} FROM awards WHERE {_EIN} = '702157919'",
    "awards_by_ein_year_summary": f"SELECT fiscal_year, count(*) AS n, sum(coalesce(amount, 0))::BIGINT AS total FROM awards WHERE {_EIN} = '702157919' GROUP BY ALL",
    "organizations_per_ein": f"SELECT ein, string_agg(organization, '; ' ORDER BY o) AS organizations FROM (SELECT {_EIN} AS ein, organization, min(award_id) AS o FROM awards WHERE organization <> '' GROUP BY ALL) WHERE ein <> '' GROUP BY ein",
    "search_transparency": "SELECT resolution, date, chart, fiscal_year, action, council_member, organization, program, ein, amount, agency, purpose, source_fy, (source_fy IN (2010, 2011, 2012, 2013))::INT AS low_text_confidence FROM transparency WHERE lower(action) = 'rescind' AND source_fy = 2023 ORDER BY source_fy, resolution NULLS FIRST, chart NULLS FIRST, date NULLS FIRST, fiscal_year NULLS FIRST, action NULLS FIRST, council_member NULLS FIRST, organization NULLS FIRST, program NULLS FIRST, ein NULLS FIRST, amount NULLS FIRST, agency NULLS FIRST, purpose NULLS FIRST LIMIT 500",
    "capital_search_topk": "SELECT fiscal_year, agency, budget_line, sub_id, boro, fy1, sponsor, title FROM capital WHERE lower(agency) LIKE '%library%' AND lower(title) LIKE '%roof%replac%' ORDER BY fiscal_year NULLS FIRST, agency NULLS FIRST, fy1 DESC NULLS LAST, budget_line NULLS FIRST, sub_id NULLS FIRST, boro NULLS FIRST, sponsor NULLS FIRST, title NULLS FIRST LIMIT 100",
    "terms_text_truncate": "SELECT fiscal_year, item_number, agency_name, agency_code, units_of_appropriation, report_deadlines, coverage_period, CASE WHEN length(condition_text) > 300 THEN substr(condition_text, 1, 300) || '…' ELSE condition_text END AS condition_text FROM terms WHERE lower(agency_name) LIKE '%office of%' ORDER BY fiscal_year NULLS FIRST, agency_name NULLS FIRST, item_number NULLS FIRST, agency_code NULLS FIRST, units_of_appropriation NULLS FIRST, report_deadlines NULLS FIRST, coverage_period NULLS FIRST, 8 NULLS FIRST LIMIT 500",
    "fiscal_year_coverage": " UNION ALL ".join([_years("awards", "awards", "fiscal_year"), _years("capital", "capital", "fiscal_year"), _years("terms", "terms", "fiscal_year"), _years("transparency", "transparency", "source_fy"), _years("initiatives", "initiatives", "fiscal_year")]),
    "documents_like_link": "SELECT fiscal_year, source AS document_type, '' AS local_file, doc_id, CASE WHEN trim(coalesce(matter_number, '')) <> '' THEN 'https://meetings.example.org/MeetingDetail.aspx?LEGID=' || trim(matter_number) || '&GID=61' END AS meeting_url FROM documents WHERE lower(source) LIKE '%transparency_reso%'",
    "top_agencies": "SELECT agency_name, count(*) AS n FROM terms WHERE agency_name <> '' GROUP BY 1 ORDER BY n DESC, agency_name LIMIT 4",
    "channel_split": "SELECT award_type, sum(coalesce(amount, 0))::BIGINT AS total, count(*) AS n FROM awards GROUP BY 1",
    "awards_pushdown": "SELECT award_id, amount FROM awards WHERE fiscal_year = 2025 AND award_type = 'member_item'",
    "money_formats": f"SELECT award_id, CASE WHEN amount IS NULL THEN '—' WHEN amount < 0 THEN '-$' || format('{{:,}}', -amount) ELSE '$' || format('{{:,}}', amount) END AS shown, regexp_full_match(replace(coalesce(ein, ''), '-', ''), '[0-9]{{9}}') AS ein_ok, {_EIN} AS ein_digits FROM awards",
}
