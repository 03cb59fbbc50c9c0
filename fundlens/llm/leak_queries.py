"""Queries of problem 9: held-out passages in documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundlens.llm import leaks
from fundlens.session import read_table as rt


def _tiles(spark, d):
    return leaks.tiles(rt(spark, d, "documents").select("doc_id", "text"), rt(spark, d, "eval_items").select("item_id", "text"))


def p9_found(spark, d):
    return leaks.leaked(_tiles(spark, d)).select("doc_id", "item_id")


def p9_items(spark, d):
    """Per item: the documents it leaked into, and the largest share of it that one of them covers."""
    return leaks.leaked(_tiles(spark, d)).groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"), F.max("coverage").alias("coverage"))


QUERIES = {f.__name__: f for f in (p9_found, p9_items)}
ORACLES: dict[str, str] = {}
