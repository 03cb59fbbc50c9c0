"""Queries of problem 8: texts in containers of fixed capacity."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundlens.llm import packing
from fundlens.session import read_table as rt


def p8_assignment(spark, d):
    return packing.pack(rt(spark, d, "documents"))


def p8_containers(spark, d):
    """Per container: its pieces, tokens and unused space."""
    a = packing.pack(rt(spark, d, "documents"))
    g = a.groupBy("container").agg(F.count(F.lit(1)).alias("pieces"), F.sum("n_tokens").alias("tokens"))
    return g.withColumn("unused", F.lit(packing.CAPACITY) - F.col("tokens"))


QUERIES = {f.__name__: f for f in (p8_assignment, p8_containers)}
ORACLES: dict[str, str] = {}
