"""Resolving linked column names to the targets of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.session import cut_lineage

#: A dataset has few distinct column names; their links are counted before they are brought to the driver.
MAX_NAME_LINKS = 50_000


def resolve_names(links: DataFrame, targets: list[str]) -> DataFrame:
    """(column_name, target) for names linked, over any number of renames, to a target.

    ``links`` is (a, b, n): name a was renamed to b n times, one row per distinct pair of
    names.  Its size follows the vocabulary of column names, not the records, and is
    checked: more links than ``MAX_NAME_LINKS`` are followed in the cluster, by the same
    rule.  A name takes the target reached by the strongest chain (largest smallest n; of
    chains as strong the target that comes first).
    """
    rows = links.limit(MAX_NAME_LINKS + 1).collect()
    if len(rows) > MAX_NAME_LINKS:
        return _resolve_in_cluster(links, targets)
    strength = {t: (float("inf"), t) for t in targets}
    both = [(r.n, x, y) for r in rows for x, y in ((r.a, r.b), (r.b, r.a)) if y not in strength]
    moved = True
    while moved:
        moved = False
        for n, x, y in both:
            if x in strength:
                s, t = min(n, strength[x][0]), strength[x][1]
                old = strength.get(y)
                if old is None or s > old[0] or (s == old[0] and t < old[1]):
                    strength[y], moved = (s, t), True
    spark = links.sparkSession
    return spark.createDataFrame([(k, t) for k, (_, t) in sorted(strength.items())], "column_name string, target string")


def _resolve_in_cluster(links: DataFrame, targets: list[str]) -> DataFrame:
    """As ``resolve_names``: strengths spread over the links until none grows, one step a round; each round is written."""
    spark = links.sparkSession
    both = cut_lineage(links.select("a", "b", "n").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "n")).where(~F.col("b").isin(targets)))
    top = (1 << 62) - 1
    best = lambda d: d.groupBy("column_name").agg(F.max(F.struct("s", F.col("r"))).alias("x")).select("column_name", "x.s", "x.r")
    rank = {t: i for i, t in enumerate(sorted(targets))}  # the target that comes first wins: its rank is the largest negative
    now = spark.createDataFrame([(t, top, -rank[t]) for t in targets], "column_name string, s bigint, r int")
    while True:
        step = both.join(now.withColumnRenamed("column_name", "a"), "a").select(F.col("b").alias("column_name"), F.least("s", "n").alias("s"), "r")
        nxt = cut_lineage(best(now.unionByName(step)))
        if nxt.exceptAll(now).isEmpty():
            break
        now = nxt
    names = spark.createDataFrame([(-i, t) for t, i in rank.items()], "r int, target string")
    return now.join(names, "r").select("column_name", "target")
