"""Queries of problem 5: designations repeated in form only."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundlens.llm import formcopies
from fundlens.session import read_table as rt

TEXTS = ("organization", "program", "purpose")
_blank = lambda c: F.coalesce(F.col(c), F.lit(""))
EXACT = {
    "fiscal_year": F.col, "category": _blank, "initiative": _blank, "award_type": _blank, "member": _blank,
    "amount": F.col, "agency": _blank, "ein": lambda c: F.regexp_replace(_blank(c), "[^0-9]", ""),
}


def _copies(awards):
    return formcopies.find_copies(awards, "award_id", TEXTS, {c: f(c) for c, f in EXACT.items()})


def p5_found(spark, d):
    return _copies(rt(spark, d, "awards"))


def p5_collapsed(spark, d):
    awards = rt(spark, d, "awards")
    return formcopies.collapse(awards.select("award_id", "fiscal_year", *TEXTS), "award_id", _copies(awards))


QUERIES = {f.__name__: f for f in (p5_found, p5_collapsed)}

_CANON = "regexp_replace(lower(coalesce({0}, '')), '[^\\p{{L}}\\p{{N}}]', '', 'g')"
_GROUPS = f"""WITH k AS (SELECT *, list_sort([{", ".join(_CANON.format(c) for c in TEXTS)}]) AS texts,
  regexp_replace(coalesce(ein, ''), '[^0-9]', '', 'g') AS digits FROM awards),
g AS (SELECT *, min(award_id) OVER w AS first_id, count(*) OVER w AS copies FROM k
  WINDOW w AS (PARTITION BY fiscal_year, coalesce(category, ''), coalesce(initiative, ''), coalesce(award_type, ''), coalesce(member, ''), amount, coalesce(agency, ''), digits, texts))
"""
ORACLES = {
    "p5_found": _GROUPS + "SELECT first_id, award_id AS copy_id FROM g WHERE award_id <> first_id",
    "p5_collapsed": _GROUPS + f"SELECT award_id, fiscal_year, {', '.join(TEXTS)}, copies FROM g WHERE award_id = first_id",
}
