"""Registered queries for rejects (p2), schema drift (p3) and orphan references (p6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundlens.operators import drift, orphans, rejects
from fundlens.session import read_table as rt


def _load(spark, d):
    return rejects.load_lines(rt(spark, d, "raw_lines"), rt(spark, d, "capital").select("agency"))


def p2_found(spark, d):
    return _load(spark, d).rejects


def p2_awards(spark, d):
    return _load(spark, d).awards


def p2_capital(spark, d):
    return _load(spark, d).capital


def p2_reasons(spark, d):
    return _load(spark, d).rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def p3_found(spark, d):
    return drift.column_changes(rt(spark, d, "feed_records"))


def p3_changes_by_column(spark, d):
    return drift.column_changes(rt(spark, d, "feed_records")).groupBy("column_name", "change").agg(F.count(F.lit(1)).alias("n"))


def p3_capital(spark, d):
    return drift.consistent_table(rt(spark, d, "feed_records"), "capital")


def p3_terms(spark, d):
    return drift.consistent_table(rt(spark, d, "feed_records"), "terms")


def _orphans(spark, d):
    return orphans.budget_orphans(rt(spark, d, "awards"), rt(spark, d, "transparency"), rt(spark, d, "initiatives"), rt(spark, d, "fy16_schedule_c_initiatives"))


def p6_found(spark, d):
    return _orphans(spark, d).select("table_name", "row_id", "status")


def p6_by_period(spark, d):
    return _orphans(spark, d).groupBy("table_name", "fiscal_year", "status").agg(F.count(F.lit(1)).alias("n"))


def p6_current_keys(spark, d):
    reg = orphans.register(rt(spark, d, "initiatives"), rt(spark, d, "fy16_schedule_c_initiatives"))
    refs = rt(spark, d, "awards").where("initiative <> '' and fiscal_year is not null").select("fiscal_year", "initiative")
    state = orphans.reference_state(refs, reg, ["fiscal_year", "initiative"])
    return orphans.current_orphans(state).select("fiscal_year", "initiative", "refs")


QUERIES = {f.__name__: f for f in (p2_found, p2_awards, p2_capital, p2_reasons, p3_found, p3_changes_by_column, p3_capital, p3_terms, p6_found, p6_by_period, p6_current_keys)}

_REGISTER = """reg AS (
  SELECT fiscal_year, initiative, loaded_at, withdrawn_at FROM initiatives WHERE fiscal_year <> 2016
  UNION ALL SELECT 2016, initiative, loaded_at, withdrawn_at FROM fy16_schedule_c_initiatives)"""
_ORPHANS = f"""WITH {_REGISTER},
asked AS (
  SELECT 'awards' AS table_name, a.award_id AS row_id, a.fiscal_year, a.recorded_at, r.loaded_at, r.withdrawn_at, r.fiscal_year IS NOT NULL AS hit
  FROM awards a LEFT JOIN reg r ON r.fiscal_year = a.fiscal_year AND r.initiative = a.initiative
  WHERE a.initiative <> '' AND a.fiscal_year IS NOT NULL
  UNION ALL
  SELECT 'transparency', t.action_id, t.fiscal_year, t.recorded_at, r.loaded_at, r.withdrawn_at, r.fiscal_year IS NOT NULL
  FROM transparency t LEFT JOIN reg r ON r.fiscal_year = t.fiscal_year
  WHERE t.fiscal_year IS NOT NULL),
found AS (
  SELECT table_name, row_id, fiscal_year,
    CASE WHEN NOT bool_or(hit) THEN 'missing'
         WHEN coalesce(bool_or(loaded_at <= recorded_at), false) THEN 'deleted' ELSE 'late' END AS status
  FROM asked GROUP BY table_name, row_id, fiscal_year
  HAVING NOT coalesce(bool_or(loaded_at <= recorded_at AND (withdrawn_at IS NULL OR withdrawn_at > recorded_at)), false))
"""

ORACLES = {
    "p6_found": _ORPHANS + "SELECT table_name, row_id, status FROM found",
    "p6_by_period": _ORPHANS + "SELECT table_name, fiscal_year, status, count(*) AS n FROM found GROUP BY ALL",
    "p6_current_keys": f"""WITH {_REGISTER},
live AS (SELECT fiscal_year, initiative, count(*) FILTER (WHERE withdrawn_at IS NULL) AS present FROM reg GROUP BY ALL)
SELECT a.fiscal_year, a.initiative, count(*) AS refs FROM awards a LEFT JOIN live USING (fiscal_year, initiative)
WHERE a.initiative <> '' AND a.fiscal_year IS NOT NULL AND coalesce(present, 0) = 0 GROUP BY ALL""",
    "p2_found": r"""WITH f AS (SELECT line_id, dataset, coalesce(line, '') AS line,
    regexp_replace(coalesce(line, ''), '"(?:[^"]|"")*"', 'q', 'g') AS bare FROM raw_lines),
p AS (SELECT *, regexp_full_match(line, '(?s)(?:"(?:[^"]|"")*"|[^",]*)(?:,(?:"(?:[^"]|"")*"|[^",]*))*') AS quoted,
    len(bare) - len(replace(bare, ',', '')) + 1 AS n,
    regexp_matches(bare, '[\r\n]') AS broken,
    regexp_extract_all(',' || line, '(?s),("(?:[^"]|"")*"|[^",]*)', 1) AS cells FROM f),
c AS (SELECT *, CASE WHEN cells[2] LIKE '"%' THEN replace(substr(cells[2], 2, len(cells[2]) - 2), '""', '"') ELSE cells[2] END AS c2,
    CASE WHEN cells[7] LIKE '"%' THEN substr(cells[7], 2, len(cells[7]) - 2) ELSE cells[7] END AS c7,
    CASE WHEN cells[8] LIKE '"%' THEN substr(cells[8], 2, len(cells[8]) - 2) ELSE cells[8] END AS c8 FROM p),
r AS (SELECT line_id, CASE WHEN NOT quoted THEN 'quoting'
    WHEN broken OR n <> CASE dataset WHEN 'awards' THEN 10 ELSE 13 END THEN 'column_count'
    WHEN dataset = 'awards' AND NOT regexp_full_match(c7, '([0-9]{9}|[0-9]{2}-[0-9]{7})?') THEN 'bad_ein'
    WHEN dataset = 'awards' AND NOT regexp_full_match(c8, '( *(-? *([$] ?)?|[$] ?- *)([0-9]+|[0-9]{1,3}(,[0-9]{3})+)([.]00)? *)?') THEN 'bad_amount'
    WHEN dataset = 'capital' AND c2 NOT IN (SELECT agency FROM capital WHERE agency <> '') THEN 'bad_agency' END AS reason FROM c)
SELECT line_id, reason FROM r WHERE reason IS NOT NULL""",
}
ORACLES["p2_reasons"] = f"SELECT reason, count(*) AS n FROM ({ORACLES['p2_found']}) GROUP BY reason"

_CUT = r"""l AS (SELECT line_id, dataset, coalesce(line, '') AS line FROM raw_lines WHERE dataset = '{0}'),
x AS (SELECT line_id, list_transform(regexp_extract_all(',' || line, '(?s),("(?:[^"]|"")*"|[^",]*)', 1), lambda c: CASE WHEN c LIKE '"%' THEN replace(substr(c, 2, len(c) - 2), '""', '"') ELSE c END) AS c FROM l),
bad AS (""" + ORACLES["p2_found"] + "),\nok AS (SELECT * FROM x WHERE line_id NOT IN (SELECT line_id FROM bad))"
_DIGITS = "regexp_replace(regexp_replace({0}, '[.]00 *$', ''), '[$, ]', '', 'g')"


def _loaded(dataset: str, fmt: rejects.RecordFormat) -> str:
    """Sound rows: texts as they stand, whole numbers cast, and as JSON what does not cast."""
    cols, failed = [], []
    for i, f in enumerate(fmt.fields, 1):
        n = _DIGITS.format(f"c[{i}]")
        cols.append(f"TRY_CAST(CASE WHEN regexp_full_match({n}, '-?[0-9]+') THEN {n} END AS BIGINT) AS {f}" if f in fmt.longs else f"c[{i}] AS {f}")
        if f in fmt.longs:
            failed.append(f"""CASE WHEN {n} <> '' AND TRY_CAST(CASE WHEN regexp_full_match({n}, '-?[0-9]+') THEN {n} END AS BIGINT) IS NULL THEN '"{f}":' || to_json(c[{i}])::VARCHAR END""")
    return f"WITH {_CUT.replace("{0}", dataset)} SELECT line_id, {', '.join(cols)}, '{{' || nullif(concat_ws(',', {', '.join(failed)}), '') || '}}' AS failed FROM ok"


ORACLES["p2_awards"] = _loaded("awards", rejects.AWARDS_FORMAT)
ORACLES["p2_capital"] = _loaded("capital", rejects.CAPITAL_FORMAT)
