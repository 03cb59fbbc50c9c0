"""All registered queries outside the llm subpackage, and their SQL."""

from __future__ import annotations

from fundlens.plans import answers, awards_api, checks, events, forms, line_tables, papers, records, rollup, round_trips, totals

MODULES = (records, awards_api, rollup, totals, checks, line_tables, events, papers, forms, answers, round_trips)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: s for m in MODULES for k, s in m.ORACLES.items()}
