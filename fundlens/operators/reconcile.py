"""Sums against printed totals, across parts and axes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(parsed: DataFrame, printed: DataFrame, keys: Sequence[str], amount: str = "amount", zero_is_ok: bool = False, count: str | None = None) -> DataFrame:
    """(keys, printed, parsed, diff, status): each printed total against the sum of its rows.

    ``OK`` if they agree and, unless ``zero_is_ok``, the total is not 0; else ``DIFF`` with
    the signed difference.  ``count`` names a printed number of rows that must agree too.
    Printed keys without rows count as 0.
    """
    aggs = [F.sum(F.coalesce(F.col(amount), F.lit(0))).cast("bigint").alias("parsed"), F.count(F.lit(1)).alias("rows")]
    j = printed.join(parsed.groupBy(*keys).agg(*aggs), list(keys), "left").withColumns({"parsed": F.coalesce("parsed", F.lit(0)), "rows": F.coalesce("rows", F.lit(0))})
    diff = F.col("parsed") - F.col("printed")
    ok = (diff == 0) & (F.lit(zero_is_ok) | (F.col("printed") != 0))
    if count:
        ok = ok & (F.col("rows") == F.col(count))
    status = F.when(ok, "OK").otherwise(F.concat(F.lit("DIFF "), F.when(diff >= 0, "+").otherwise(""), diff.cast("string")))
    return j.select(*keys, "printed", "parsed", diff.alias("diff"), "rows", status.alias("status"))


def exact_share(reconciled: DataFrame) -> DataFrame:
    """(exact, total): how many keys are OK."""
    return reconciled.agg(F.count_if(F.col("status") == "OK").alias("exact"), F.count(F.lit(1)).alias("total"))


def cross_part(df: DataFrame, part: str, left: str, right: str, measure: str) -> DataFrame:
    """One row: the totals of two parts, and whether they agree."""
    of = lambda p: F.coalesce(F.sum(F.when(F.col(part) == p, F.col(measure))), F.lit(0)).cast("bigint")
    return df.agg(of(left).alias("left_total"), of(right).alias("right_total")).withColumn("same", F.col("left_total") == F.col("right_total"))


def signed_net(df: DataFrame, key: str, amount: str = "amount") -> DataFrame:
    """(key, plus, minus, net, n) per key and, with a null key, in all."""
    a = F.coalesce(F.col(amount), F.lit(0))
    pos, neg = F.sum(F.when(a > 0, a).otherwise(0)), F.sum(F.when(a < 0, a).otherwise(0))
    return df.rollup(key).agg(pos.cast("bigint").alias("plus"), neg.cast("bigint").alias("minus"), F.sum(a).cast("bigint").alias("net"), F.count(F.lit(1)).alias("n"), F.grouping(key).cast("int").alias("grand"))


def axis_totals(df: DataFrame, year: str, axes: Sequence[str], amount: str = "amount") -> DataFrame:
    """(axis, year, total): the same sum along every axis; totals of a year must agree over axes.

    One scan and one shuffle of the rows: grouping sets over (year, axis) for each axis; the
    far fewer groups are summed up per year and axis after that.
    """
    a = F.sum(F.coalesce(F.col(amount), F.lit(0))).cast("bigint")
    sets = [[F.col(year), F.col(x)] for x in axes]
    g = df.groupingSets(sets, F.col(year), *(F.col(x) for x in axes)).agg(a.alias("t"), F.grouping_id().alias("_g"))
    # the bit of the axis that a set groups by is 0; of ``axes`` the first has the highest bit
    bit = {x: 1 << (len(axes) - 1 - i) for i, x in enumerate(axes)}
    axis = F.coalesce(*(F.when(F.col("_g").bitwiseAND(F.lit(b)) == 0, x) for x, b in bit.items()))
    return g.groupBy(axis.alias("axis"), F.col(year).alias("year")).agg(F.sum("t").cast("bigint").alias("total"), F.count(F.lit(1)).alias("groups"))


def rollup_reports(reports: DataFrame, text: str = "text") -> DataFrame:
    """``reports`` with (exact, total, status) read from their words.

    N/A if not reconcilable, in whatever case; else by the number of exact categories, or
    where none is named by that of agency subtotals: PASS if all are, PARTIAL if some are
    not; else 'unparsed', as are null and empty texts.
    """
    s = F.coalesce(F.col(text), F.lit(""))
    of = lambda what, i: F.nullif(F.regexp_extract(s, rf"(\d+)\s*/\s*(\d+)\s+{what}", i), F.lit("")).try_cast("int")
    n, m = (F.coalesce(of(r"(?:reconcilable\s+)?categories exact", i), of("agency subtotals reconcile", i)) for i in (1, 2))
    void = s.rlike("(?i)NOT RECONCILABLE")
    status = F.when(void, "N/A").when(n.isNull() | m.isNull(), "unparsed").when(n == m, "PASS").otherwise("PARTIAL")
    return reports.withColumns({"exact": F.when(~void, n), "total": F.when(~void, m), "status": status})
