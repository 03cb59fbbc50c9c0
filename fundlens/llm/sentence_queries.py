"""Queries of problem 10: sentence units of documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundlens.llm import sentences
from fundlens.session import read_table as rt


def p10_found(spark, d):
    return sentences.units(rt(spark, d, "documents")).select("doc_id", "start_pos")


def p10_counts(spark, d):
    """Units and characters in them per document."""
    u = sentences.units(rt(spark, d, "documents"))
    return u.groupBy("doc_id").agg(F.count(F.lit(1)).alias("units"), F.sum(F.col("end_pos") - F.col("start_pos") + 1).alias("chars"))


QUERIES = {f.__name__: f for f in (p10_found, p10_counts)}
ORACLES: dict[str, str] = {}
