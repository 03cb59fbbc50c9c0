"""Registered queries of the scalar functions, over texts as they were delivered."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundlens.functions import exprs as X
from fundlens.session import read_table as rt


def _cells(spark, d):
    """(line_id, cell): the eighth piece between commas of every delivered line: amounts, and whatever else slipped there."""
    return rt(spark, d, "raw_lines").select("line_id", F.get(F.split("line", ","), F.lit(7)).alias("cell"))


def amount_readings(spark, d):
    c = _cells(spark, d)
    return c.select(
        "line_id", X.parse_amount_lenient("cell").cast("string").alias("lenient"), X.malformed_amount("cell").alias("malformed"), X.to_amount("cell").cast("double").alias("amount"), X.money_or_zero("cell").cast("string").alias("or_zero"),
        X.money_signed("cell").cast("string").alias("signed"),
    )


def strict_amounts(spark, d):
    """Under strict casts a malformed text raises: only texts of digits, ``$`` and commas are asked."""
    c = _cells(spark, d).where(F.trim("cell").rlike(r"^[$]?[0-9][0-9,]{0,15}$"))
    return c.select("line_id", X.money_strict("cell").alias("strict"))


def line_endings(spark, d):
    """Closing amounts, repaired numbers and upper-case forms of delivered lines."""
    r = rt(spark, d, "raw_lines").select("line_id", F.coalesce(F.regexp_replace("line", r"[,\r\n]+$", ""), F.lit("")).alias("line"))
    return r.select("line_id", X.trailing_amount("line").alias("trailing"), X.split_number_repair("line").alias("mended"), F.md5(X.norm_upper("line")).alias("upper"), X.odata_literal("line").alias("literal"))


def capital_row_forms(spark, d):
    """Capital lines with blanks for commas: is it a row of a table, and which are its four amounts?"""
    r = rt(spark, d, "raw_lines").where("dataset = 'capital'").select("line_id", X.clean(F.translate("line", ',"', "  ")).alias("line"))
    four = X.amount_run("line")
    return r.select("line_id", *(F.get(four, F.lit(i)).alias(f"a{i + 1}") for i in range(4)), X.is_data_row("line").alias("row"))


def data_rows_forms(spark, d):
    """Rows of the coded form, one per capital project: codes, letter, title, amounts."""
    c = rt(spark, d, "capital")
    line = F.concat_ws(" ", F.lit("PV N1 PV"), F.col("budget_line"), F.coalesce("boro", F.lit("K")), F.col("title"), F.format_number(F.coalesce("fy1", F.lit(0)), 0), F.lit("0 0 0"))
    return c.select("project_id", X.is_data_row(line).alias("row"), X.is_caps_header(F.upper("agency")).alias("header"), X.is_caps_header("title").alias("title_header"))


def delegation_sponsors(spark, d):
    """Organizations led by a borough delegation, wrapped in one, behind a bare word, and as they stand."""
    t = rt(spark, d, "transparency").select("action_id", X.clean("organization").alias("o")).where("o <> ''")
    forms = F.array(F.concat(F.lit("Bronx Delegation "), "o"), F.concat(F.lit("Staten Island "), "o", F.lit(" Delegation")), F.concat(F.lit("Delegation "), "o"), F.col("o"))
    t = t.select("action_id", F.posexplode(forms).alias("form", "text"))
    sponsor, rest = X.peel_delegation("text")
    return t.select("action_id", "form", sponsor.alias("sponsor"), rest.alias("rest"))


def plain_letters(spark, d):
    """Texts in ten languages without their accents; scripts whose letters decompose into several are left out of the comparison."""
    t = rt(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    return t.select("doc_id", F.md5(X.deaccent(F.regexp_replace("t", r"[^\x{0000}-\x{024F}]", ""))).alias("plain"))


def agency_leads(spark, d):
    """Summary lines: agency initials, first words, and the currency form of amounts."""
    a = rt(spark, d, "awards").select("award_id", F.concat_ws(" ", F.nullif("agency", F.lit("")), "initiative").alias("line"), "amount")
    agency, rest = X.agency_prefix_split("line")
    first, more = X.first_token_split("line")
    return a.select("award_id", agency.alias("agency"), rest.alias("rest"), first.alias("first"), more.alias("more"), X.round_half_even(F.col("amount") / 1000, 0).alias("even"), X.round_half_up(F.col("amount") / 1000, 0).alias("up"))


QUERIES = {f.__name__: f for f in (amount_readings, strict_amounts, line_endings, capital_row_forms, data_rows_forms, delegation_sponsors, plain_letters, agency_leads)}

_CELL = "c AS (SELECT line_id, string_split(line, ',')[8] AS cell FROM raw_lines)"
_WS = "[\\s\\p{Z}\\x0B\\x{85}]"


def _clean(x: str) -> str:
    return f"regexp_replace(regexp_replace(coalesce({x}, ''), '{_WS}+', ' ', 'g'), '^ | $', '', 'g')"


_N = "-?\\d{1,3}(?:,\\d{3})*"
_CODE = "regexp_full_match(coalesce({0}, ''), '[A-Z0-9]{{1,6}}')"


def _run(x: str) -> str:
    return f"regexp_extract({x}, '(?:^|\\s)((?:{_N}\\s+){{3,}}{_N})(?:\\s|$)', 1)"


def _caps(x: str) -> str:
    return f"(length(coalesce({x}, '')) BETWEEN 4 AND 48 AND regexp_matches(coalesce({x}, ''), '[A-Z]') AND regexp_full_match(coalesce({x}, ''), '[A-Z0-9 &''.,\\-/()]+'))"


def _data_row(w: str, line: str) -> str:
    rest = f"array_to_string({w}[6:], ' ')"
    return f"(len({w}) >= 6 AND {' AND '.join(_CODE.format(f'{w}[{i}]') for i in (1, 2, 3, 4))} AND (regexp_matches({w}[2], '\\d') OR regexp_matches({w}[4], '\\d')) AND regexp_full_match({w}[5], '[A-Za-z]') AND {_run(rest)} <> '')"


ORACLES = {
    "amount_readings": f"""WITH {_CELL}, s AS (SELECT line_id, coalesce(cell, '') AS cell, regexp_replace(coalesce(cell, ''), '[$,\\s]', '', 'g') AS bare, trim(coalesce(cell, ''), ' ') AS t FROM c)
SELECT line_id, TRY_CAST(nullif(regexp_extract(bare, '^([+-]?[0-9]+)', 1), '') AS BIGINT)::VARCHAR AS lenient,
  bare2 <> '' AND NOT regexp_full_match(bare3, '[ \\t]*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[dDfF]?[ \\t]*|(?i)[+-]?(inf|infinity)|(?i)nan') AS malformed,
  coalesce(TRY_CAST(CASE WHEN regexp_full_match(cell, '\\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\\s*') THEN trim(cell) END AS DECIMAL(18, 2)), 0)::DOUBLE AS amount,
  coalesce(TRY_CAST(CASE WHEN regexp_full_match(regexp_replace(cell, '[,$ ]', '', 'g'), '\\s*[+-]?[0-9]+\\s*') THEN regexp_replace(cell, '[,$ ]', '', 'g') END AS BIGINT), 0)::VARCHAR AS or_zero,
  CASE WHEN t LIKE '(%' THEN -v ELSE v END::VARCHAR AS signed
FROM (SELECT *, regexp_replace(cell, '\\s', '', 'g') AS bare2, regexp_replace(cell, '[$, ]', '', 'g') AS bare3,
  TRY_CAST(CASE WHEN regexp_full_match(regexp_replace(t, '[(),$]', '', 'g'), '\\s*[+-]?[0-9]+\\s*') THEN regexp_replace(t, '[(),$]', '', 'g') END AS BIGINT) AS v FROM s)""",
    "strict_amounts": f"WITH {_CELL} SELECT line_id, regexp_replace(trim(cell, ' '), '[,$]', '', 'g')::BIGINT AS strict FROM c WHERE regexp_full_match(trim(cell, ' '), '[$]?[0-9][0-9,]{{0,15}}')",
    "line_endings": f"""WITH r AS (SELECT line_id, coalesce(regexp_replace(line, '[,\\r\\n]+$', ''), '') AS line FROM raw_lines),
a AS (SELECT *, nullif(regexp_extract(line, '[$]\\s*([\\d,]+)\\s*$', 1), '') AS dollar, nullif(regexp_extract(line, '(?:^|\\s)(\\d{{1,3}}(?:,\\d{{3}})+)\\s*$', 1), '') AS bare FROM r)
SELECT line_id, TRY_CAST(nullif(replace(coalesce(dollar, bare, ''), ',', ''), '') AS BIGINT) AS trailing, regexp_replace(regexp_replace(line, '(\\d),\\s+(\\d)', '\\1,\\2', 'g'), '(\\d),\\s+(\\d)', '\\1,\\2', 'g') AS mended,
  md5(upper({_clean('line')})) AS upper, replace(line, '''', '''''') AS literal FROM a""",
    "capital_row_forms": f"""WITH l AS (SELECT line_id, {_clean("translate(line, ',\"', '  ')")} AS line FROM raw_lines WHERE dataset = 'capital'),
r AS (SELECT line_id, line, {_run('line')} AS run, string_split(line, ' ') AS w FROM l), s AS (SELECT *, CASE WHEN run <> '' THEN string_split_regex(run, ' +')[-4:] END AS f FROM r)
SELECT line_id, {', '.join(f"replace(f[{i}], ',', '')::BIGINT AS a{i}" for i in (1, 2, 3, 4))}, coalesce({_data_row('w', 'line')}, false) AS row FROM s""",
    "data_rows_forms": f"""WITH l AS (SELECT project_id, agency, title, {_clean("concat_ws(' ', 'PV N1 PV', budget_line, coalesce(boro, 'K'), title, format('{:,}', coalesce(fy1, 0)), '0 0 0')")} AS line FROM capital), r AS (SELECT *, string_split(line, ' ') AS w FROM l)
SELECT project_id, coalesce({_data_row('w', 'line')}, false) AS row, {_caps('upper(agency)')} AS header, {_caps('title')} AS title_header FROM r""",
    "delegation_sponsors": f"""WITH o AS (SELECT action_id, {_clean('organization')} AS o FROM transparency WHERE {_clean('organization')} <> ''),
f AS (SELECT action_id, 0 AS form, 'Bronx Delegation' AS sponsor, o AS rest FROM o UNION ALL SELECT action_id, 1, 'Staten Island Delegation', o FROM o UNION ALL SELECT action_id, 2, '', o FROM o UNION ALL SELECT action_id, 3, '', o FROM o) SELECT * FROM f""",
    "plain_letters": "SELECT doc_id, md5(strip_accents(regexp_replace(coalesce(text, ''), '[^\\x{0000}-\\x{024F}]', '', 'g'))) AS plain FROM documents",
    "agency_leads": f"""WITH l AS (SELECT award_id, amount, {_clean("concat_ws(' ', nullif(agency, ''), initiative)")} AS s FROM awards),
p AS (SELECT *, regexp_full_match(s, '(?s)[A-Z][A-Za-z]{{1,5}}(?:[/,]\\s?[A-Z][A-Za-z]{{1,5}})*\\s+.*') AND string_split(s, ' ')[1] = upper(string_split(s, ' ')[1]) AS ok FROM l)
SELECT award_id, CASE WHEN ok THEN regexp_extract(s, '^([A-Z][A-Za-z]{{1,5}}(?:[/,]\\s?[A-Z][A-Za-z]{{1,5}})*)\\s+(.*)$', 1) ELSE '' END AS agency, CASE WHEN ok THEN regexp_extract(s, '^([A-Z][A-Za-z]{{1,5}}(?:[/,]\\s?[A-Z][A-Za-z]{{1,5}})*)\\s+(.*)$', 2) ELSE s END AS rest,
  string_split(s, ' ')[1] AS first, array_to_string(string_split(s, ' ')[2:], ' ') AS more, round_even(amount / 1000, 0) AS even, round(amount / 1000, 0) AS up FROM p""",
}
