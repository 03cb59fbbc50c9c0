"""Registered queries: data-quality checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.operators import quality as Q
from fundlens.session import read_table as rt

_COPY = ["fiscal_year", "category", "initiative", "award_type", "member", "organization", "program", "ein", "amount", "agency", "purpose"]


def _surnames(spark, d):
    return Q.surnames(rt(spark, d, "transparency").select("council_member"))  # the cleaner of the two member columns


def _violations(spark, d):
    s = _surnames(spark, d)
    return reduce(DataFrame.unionByName, [Q.violations(rt(spark, d, n), spec, s) for n, spec in Q.SPECS.items()])


def qa_violations(spark, d):
    return _violations(spark, d)


def qa_summary(spark, d):
    return Q.summary(_violations(spark, d))


def qa_column_bleed(spark, d):
    return Q.violations(rt(spark, d, "awards"), Q.SPECS["awards"], _surnames(spark, d)).where("check = 'column_bleed'").select("row_id")


def qa_duplicates(spark, d):
    return Q.duplicate_rows(rt(spark, d, "awards"), _COPY)


def qa_duplicate_count(spark, d):
    parts = {"awards": _COPY, "capital": ["fiscal_year", "agency", "budget_line", "sub_id", "boro", "fy1", "sponsor", "title"], "documents": ["text"]}
    return reduce(DataFrame.unionByName, [Q.duplicate_count(rt(spark, d, t), c).select(F.lit(t).alias("table_name"), "*") for t, c in parts.items()])


def qa_surnames(spark, d):
    return _surnames(spark, d)


def ein_coverage(spark, d):
    a = Q.ein_coverage(rt(spark, d, "awards"), "fiscal_year").select(F.lit("awards").alias("table_name"), "*")
    t = Q.ein_coverage(rt(spark, d, "transparency"), "source_fy").select(F.lit("transparency").alias("table_name"), F.col("source_fy").alias("fiscal_year"), "valid", "rows", "share")
    return a.unionByName(t)


def text_confidence_band(spark, d):
    return Q.text_confidence(rt(spark, d, "transparency"), "organization", "source_fy")


QUERIES = {f.__name__: f for f in (qa_violations, qa_summary, qa_column_bleed, qa_duplicates, qa_duplicate_count, qa_surnames, ein_coverage, text_confidence_band)}

_NOT = ", ".join(f"'{w}'" for w in Q.NOT_SURNAMES)
_SUR = f"""sur AS (SELECT DISTINCT lower(list_extract(string_split_regex(trim(m), ' +'), -1)) AS s FROM (SELECT council_member AS m FROM transparency) WHERE coalesce(m, '') <> ''
  AND regexp_full_match(lower(list_extract(string_split_regex(trim(m), ' +'), -1)), '[a-z]{{4,}}') AND lower(list_extract(string_split_regex(trim(m), ' +'), -1)) NOT IN ({_NOT}))"""
_VALID = "regexp_full_match(replace(coalesce(ein, ''), '-', ''), '[0-9]{9}')"


def _bleed(t: str, id_: str) -> str:
    one = lambda c: f"(lower(trim(string_split_regex(trim(coalesce({c}, '')), ' +')[1], '.,')) IN (SELECT s FROM sur) AND len(string_split_regex(trim(coalesce({c}, '')), ' +')) > 1)"
    return f"SELECT '{t}' AS table_name, {id_} AS row_id, 'column_bleed' AS \"check\", 'SOFT' AS severity FROM {t} WHERE {one('organization')} OR {one('program')}"


def _v(t: str, id_: str, name: str, sev: str, cond: str) -> str:
    return f"SELECT '{t}' AS table_name, {id_} AS row_id, '{name}' AS \"check\", '{sev}' AS severity FROM {t} WHERE {cond}"


_RANGE = f"fiscal_year NOT BETWEEN {Q.FIRST_YEAR} AND {Q.LAST_YEAR}"
_BIG = " OR ".join(f"abs({c}) > {Q.BILLION}" for c in ("fy1", "fy2", "fy3", "fy4"))
_ALLV = f"WITH {_SUR}, v AS (" + " UNION ALL ".join([
    _v("awards", "award_id", "malformed_ein", "HARD", f"coalesce(ein, '') <> '' AND NOT {_VALID}"), _v("awards", "award_id", "huge_amount", "SOFT", f"abs(amount) > {Q.BILLION}"),
    _v("awards", "award_id", "zero_amount", "COUNT", "amount = 0"), _v("awards", "award_id", "negative_amount", "SOFT", "amount < 0"), _v("awards", "award_id", "year_out_of_range", "SOFT", _RANGE),
    _v("awards", "award_id", "year_empty", "COUNT", "fiscal_year IS NULL"), _bleed("awards", "award_id"),
    _v("transparency", "action_id", "malformed_ein", "HARD", f"coalesce(ein, '') <> '' AND NOT {_VALID}"), _v("transparency", "action_id", "huge_amount", "SOFT", f"abs(amount) > {Q.BILLION}"),
    _v("transparency", "action_id", "sign_against_action", "SOFT", "(action = 'designate' AND amount < 0) OR (action = 'rescind' AND amount > 0)"), _v("transparency", "action_id", "year_out_of_range", "SOFT", _RANGE),
    _v("transparency", "action_id", "year_empty", "COUNT", "fiscal_year IS NULL"), _v("transparency", "action_id", "year_after_document", "SOFT", "fiscal_year > source_fy + 1"),
    _v("transparency", "action_id", "prior_year", "COUNT", "fiscal_year < source_fy"), _bleed("transparency", "action_id"),
    _v("capital", "project_id", "huge_amount", "SOFT", _BIG), _v("capital", "project_id", "year_out_of_range", "SOFT", _RANGE), _v("capital", "project_id", "year_empty", "COUNT", "fiscal_year IS NULL"),
    _v("capital", "project_id", "digit_in_agency", "SOFT", "regexp_matches(agency, '[0-9]')"),
]) + ") "


def _dup(t: str, cols: list[str]) -> str:
    return f"SELECT '{t}' AS table_name, coalesce(sum(copies - 1), 0)::BIGINT AS surplus, count(*) AS groups FROM (SELECT count(*) AS copies FROM {t} GROUP BY {', '.join(cols)} HAVING count(*) > 1)"


ORACLES = {
    "qa_violations": _ALLV + "SELECT * FROM v",
    "qa_summary": _ALLV + "SELECT table_name, \"check\", severity, count(*) AS n, array_to_string(list_slice(list_sort(list(row_id)), 1, 3), ',') AS sample FROM v GROUP BY ALL",
    "qa_column_bleed": _ALLV + "SELECT row_id FROM v WHERE table_name = 'awards' AND \"check\" = 'column_bleed'",
    "qa_duplicates": f"SELECT {', '.join(_COPY)}, count(*) AS copies FROM awards GROUP BY ALL HAVING count(*) > 1",
    "qa_duplicate_count": " UNION ALL ".join([_dup("awards", _COPY), _dup("capital", ["fiscal_year", "agency", "budget_line", "sub_id", "boro", "fy1", "sponsor", "title"]), _dup("documents", ["text"])]),
    "qa_surnames": f"WITH {_SUR} SELECT s AS surname FROM sur",
    "ein_coverage": f"SELECT 'awards' AS table_name, fiscal_year, count(*) FILTER (WHERE {_VALID}) AS valid, count(*) AS rows, round(count(*) FILTER (WHERE {_VALID}) / count(*), 6) AS share FROM awards GROUP BY ALL UNION ALL SELECT 'transparency', source_fy, count(*) FILTER (WHERE {_VALID}), count(*), round(count(*) FILTER (WHERE {_VALID}) / count(*), 6) FROM transparency GROUP BY ALL",
    "text_confidence_band": "WITH g AS (SELECT source_fy, count(*) FILTER (WHERE regexp_matches(coalesce(organization, ''), '[A-Za-z]{18,}') AND NOT contains(coalesce(organization, ''), ' ')) AS glued, count(*) AS rows FROM transparency GROUP BY 1), s AS (SELECT *, round(glued / rows, 6) AS share FROM g) SELECT *, CASE WHEN share < 0.01 THEN 'HIGH' WHEN share < 0.05 THEN 'MODERATE' ELSE 'LOW' END AS band FROM s",
}
