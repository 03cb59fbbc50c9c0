"""Queries of problem 4: texts read from scanned pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm import scanrepair
from fundlens.session import read_table as rt

#: table -> (id, text)
FIELDS = {"terms": ("term_id", "condition_text"), "transparency": ("action_id", "purpose"), "capital": ("project_id", "title")}


def _texts(spark, d) -> DataFrame:
    parts = [rt(spark, d, t).select(F.lit(t).alias("table_name"), F.col(i).cast("long").alias("row_id"), F.col(c).alias("text")).where("text <> ''") for t, (i, c) in FIELDS.items()]
    return reduce(DataFrame.unionByName, parts)


def p4_found(spark, d):
    return scanrepair.repair_texts(_texts(spark, d)).select("table_name", "row_id", F.explode("noise").alias("noise"))


def p4_repaired(spark, d):
    """Every row that needed something: its text as it was written."""
    return scanrepair.repair_texts(_texts(spark, d)).where("size(noise) > 0").select("table_name", "row_id", F.array_join("noise", ",").alias("noise"), "text")


QUERIES = {f.__name__: f for f in (p4_found, p4_repaired)}
ORACLES: dict[str, str] = {}
