"""Queries of problem 7: crosswalk rows mapped to the canonical names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm import canonmap
from fundlens.session import read_table as rt

#: kind -> (table, raw column, column of the settled canonical name)
CROSSWALKS = {
    "initiative": ("initiative_name_crosswalk", "raw_initiative", "initiative_canonical"),
    "category": ("category_name_crosswalk", "raw_category", "category_canonical"),
}


def mapped(spark, d) -> DataFrame:
    """(kind, raw_id, raw, canon_id, score) for every crosswalk row without a canonical name."""
    canon = rt(spark, d, "canonical_names")
    tables = {}
    for kind, (table, raw, settled) in CROSSWALKS.items():
        t = rt(spark, d, table)
        tables[kind] = t.select("raw_id", F.col(raw).alias("raw"), F.col(settled).alias("canonical"))
    pairs = canonmap.labelled(reduce(DataFrame.unionByName, tables.values()))
    parts = []
    for kind, t in tables.items():
        own = canon.where(F.col("kind") == kind).select("canon_id", F.col("canonical_name").alias("name"))
        todo = t.where("coalesce(canonical, '') = ''")
        found = canonmap.map_values(todo, own, pairs)
        j = todo.join(found, F.coalesce(todo["raw"], F.lit("")) == F.coalesce(found["raw"], F.lit("")), "left").select(todo["raw_id"], todo["raw"], "canon_id", "score").dropDuplicates(["raw_id"])
        parts.append(j.select(F.lit(kind).alias("kind"), "raw_id", "raw", F.coalesce("canon_id", F.lit(0)).alias("canon_id"), "score"))
    return reduce(DataFrame.unionByName, parts)


def p7_found(spark, d):
    return mapped(spark, d).select("kind", "raw_id", "canon_id")


def p7_unmatched(spark, d):
    """The distinct values for which the list has no entry, with their rows."""
    none = mapped(spark, d).where("canon_id = 0")
    return none.groupBy("kind", F.coalesce("raw", F.lit("")).alias("raw")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (p7_found, p7_unmatched)}
ORACLES: dict[str, str] = {}
