"""Wide leaves, per-year series and drill-down views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundlens.functions import exprs as X
from fundlens.session import cut_lineage


def matched_itemized(adopted: DataFrame, awards: DataFrame, keys: Sequence[str], year: str = "fiscal_year") -> DataFrame:
    """(keys, year, adopted, itemized): awards are summed per key before the join; awards of unknown keys drop out."""
    k = [*keys, year]
    ad = adopted.groupBy(*k).agg(F.sum(F.coalesce(F.col("amount"), F.lit(0))).cast("bigint").alias("adopted"))
    aw = awards.groupBy(*k).agg(F.sum(F.coalesce(F.col("amount"), F.lit(0))).cast("bigint").alias("itemized"))
    return ad.join(aw, k, "left").withColumn("itemized", F.coalesce("itemized", F.lit(0)))


def unmatched_awards(adopted: DataFrame, awards: DataFrame, keys: Sequence[str], year: str = "fiscal_year") -> DataFrame:
    """(keys, year, amount, n): awards whose key was not adopted that year."""
    k = [*keys, year]
    aw = awards.groupBy(*k).agg(F.sum(F.coalesce(F.col("amount"), F.lit(0))).cast("bigint").alias("amount"), F.count(F.lit(1)).alias("n"))
    return aw.join(adopted.select(*k).distinct(), k, "left_anti")


def match_rate(adopted: DataFrame, awards: DataFrame, keys: Sequence[str], year: str = "fiscal_year") -> DataFrame:
    """(year, matched, total, percent): before any clamping; percent is null where the total is 0."""
    k = [*keys, year]
    aw = awards.groupBy(*k).agg(F.sum(F.coalesce(F.col("amount"), F.lit(0))).cast("bigint").alias("amount"))
    j = aw.join(adopted.select(*k).distinct().withColumn("_hit", F.lit(True)), k, "left")
    g = j.groupBy(year).agg(F.coalesce(F.sum(F.when(F.col("_hit"), F.col("amount"))), F.lit(0)).cast("bigint").alias("matched"), F.sum("amount").cast("bigint").alias("total"))
    return g.withColumn("percent", F.round(F.try_divide(F.col("matched") * F.lit(100.0), F.col("total")), 6))


def latest_per_key(df: DataFrame, keys: Sequence[str], year: str, row: str, value: Column, name: str) -> DataFrame:
    """(keys, latest_year, name): the value of the last row of the last year."""
    return df.groupBy(*keys).agg(F.max(year).alias("latest_year"), F.max_by(value, F.struct(year, row)).alias(name))


def wide_leaves(yearly: DataFrame, keys: Sequence[str], years: Sequence[int], year: str = "fiscal_year") -> DataFrame:
    """One row per leaf, ``Adopted Y`` and ``Itemized Y`` per year (absent: 0), itemized clamped to adopted, with a dense ``leaf_id``.

    The years are fixed, so no extra job looks for them and absent years stay.
    """
    p = yearly.groupBy(*keys).pivot(year, list(years)).agg(F.sum("adopted").alias("a"), F.sum("itemized").alias("i"))
    cols: list[Column] = []
    for y in years:
        a = F.coalesce(F.col(f"{y}_a"), F.lit(0)).cast("bigint")
        cols += [a.alias(f"Adopted {y}"), F.least(a, F.coalesce(F.col(f"{y}_i"), F.lit(0)).cast("bigint")).alias(f"Itemized {y}")]
    return with_dense_id(p.select(*keys, *cols), keys, "leaf_id")


def with_dense_id(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """1-based position by ``keys`` without sorting everything in one task: range partitions are numbered, then shifted by what stands before them.

    The partitioned rows are written first: the bounds of the ranges are sampled, so the
    numbers and the shifts must come from one and the same partitioning.
    """
    spark = df.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    parts = cut_lineage(df.repartitionByRange(n, *keys).withColumn("_p", F.spark_partition_id()))
    counts = parts.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_p", (F.sum("_n").over(W.orderBy("_p")) - F.col("_n")).alias("_b"))  # one row per partition
    own = F.row_number().over(W.partitionBy("_p").orderBy(*keys))
    return parts.withColumn("_r", own).join(F.broadcast(before), "_p").withColumn(name, (F.col("_r") + F.col("_b")).cast("bigint")).drop("_p", "_r", "_b")


def gate_total(wide: DataFrame, year: int, target: int, prefix: str = "Adopted") -> DataFrame:
    """(year, computed, target, passed): the grand total of one year of wide leaves against a printed one; an empty table sums to 0."""
    computed = F.coalesce(F.sum(f"{prefix} {year}"), F.lit(0)).cast("bigint")
    return wide.agg(computed.alias("computed")).select(F.lit(year).alias("year"), "computed", F.lit(target).cast("bigint").alias("target"), (F.col("computed") == target).alias("passed"))


#: Columns of the budget view and the columns they stand for.
VIEW_COLUMNS = {"Fund": "category", "Department": "initiative", "Control Officer": "bucket", "Short Title": "initiative", "Department Description": "description"}


def budget_view(leaves: DataFrame, id_col: str = "leaf_id") -> DataFrame:
    """Leaves under the column names of the budget view, all other columns after them; the link is unused and empty."""
    used = {*VIEW_COLUMNS.values(), id_col}
    head = [F.col(src).alias(name) for name, src in VIEW_COLUMNS.items() if src in leaves.columns]
    return leaves.select(*head, F.col(id_col).alias("Department ID"), F.lit("").alias("Link to Website"), *(c for c in leaves.columns if c not in used))


def first_match(df: DataFrame, where: dict[str, object], order: Sequence[str]) -> DataFrame:
    """The first row, by ``order`` and then by every column, whose columns equal ``where``; no row if none does.

    A null in ``where`` equals null.  Only one row per task reaches the last step.
    """
    for k, v in where.items():
        df = df.where(F.col(k).eqNullSafe(F.lit(v)))
    return df.orderBy(*order, *(c for c in df.columns if c not in order)).limit(1)


#: Routes of the browser and the columns whose slugs they name, from the top down.
ROUTES = {"fund-detail": ("category", "initiative"), "control-officer-detail": ("bucket", "initiative")}


def parse_route(route: str) -> tuple[tuple[str, ...], dict[str, str], int | None]:
    """(columns of the view, column -> slug, year) of 'fund-detail/<slug>[/<slug>][?year=Y]'; an empty view for a route of another form."""
    path, _, query = route.lstrip("#/!").partition("?")
    parts = [p for p in path.split("/") if p]
    year = query.partition("year=")[2] if "year=" in query else ""
    columns = ROUTES.get(parts[0], ()) if parts else ()
    slugs = dict(zip(columns, parts[1:3])) if columns else {}
    return columns, slugs, int(year) if year.isdigit() else None


def follow_route(rows: DataFrame, route: str, year_col: str = "fiscal_year") -> DataFrame:
    """The rows a deep link means: equal slugs of its columns, and its year if it names one."""
    _, slugs, year = parse_route(route)
    for c, s in slugs.items():
        rows = rows.where(X.slug(c) == s)
    return rows if year is None else rows.where(F.col(year_col) == year)


def series(df: DataFrame, years: tuple[int, int], group: str | None = None, year: str = "fiscal_year", amount: str = "amount") -> DataFrame:
    """(group, year, total) with a row for every year of the range; absent years are 0."""
    spark = df.sparkSession
    dense = spark.range(years[0], years[1] + 1).select(F.col("id").cast("int").alias(year))
    keys = [group] if group else []
    t = df.groupBy(*keys, year).agg(F.sum(F.coalesce(F.col(amount), F.lit(0))).cast("bigint").alias("total"))
    if group:
        dense = df.select(group).distinct().select(group, F.explode(F.sequence(F.lit(years[0]), F.lit(years[1]))).alias(year))
    return dense.join(t, [*keys, year], "left").withColumn("total", F.coalesce("total", F.lit(0)))


def unpivot_years(wide: DataFrame, keys: Sequence[str], prefix: str, years: Sequence[int], value: str) -> DataFrame:
    """(keys, fiscal_year, value) from columns ``prefix Y``."""
    pairs = ", ".join(f"{y}, `{prefix} {y}`" for y in years)
    return wide.select(*keys, F.expr(f"stack({len(years)}, {pairs}) as (fiscal_year, {value})"))


def year_over_year(s: DataFrame, keys: Sequence[str], year: str = "fiscal_year", value: str = "total") -> DataFrame:
    """``s`` with ``before``, ``change_pct`` and ``change``; null in the first year and after a 0."""
    w = W.partitionBy(*keys).orderBy(year)
    d = s.withColumn("before", F.lag(value).over(w))
    pct = F.round(X.percent_change(value, "before"), 1)
    return d.withColumn("change_pct", pct).withColumn("change", X.percent_label(pct))


def share_of_max(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """``df`` with ``share``: the first measure against the largest of all measures of all rows."""
    top = df.agg(F.max(F.greatest(*(F.coalesce(F.col(m), F.lit(0)) for m in measures))).alias("_top"))  # one row
    return df.join(F.broadcast(top)).withColumn("share", F.round(F.try_divide(F.col(measures[0]).cast("double"), F.col("_top")), 6)).drop("_top")


def drilldown(yearly: DataFrame, view: str, year: int, where: dict[str, str] | None = None, year_col: str = "fiscal_year") -> DataFrame:
    """(view, adopted, itemized, before, change_pct, children, share) of one year; rows without any amount are hidden."""
    d = yearly
    for k, v in (where or {}).items():
        d = d.where(F.col(k) == v)
    pick = lambda m, y: F.coalesce(F.sum(F.when(F.col(year_col) == y, F.col(m))), F.lit(0)).cast("bigint")
    g = d.where(F.col(year_col).isin(year, year - 1)).groupBy(view).agg(
        pick("adopted", year).alias("adopted"), pick("itemized", year).alias("itemized"), pick("adopted", year - 1).alias("before"),
        F.count_if((F.col(year_col) == year) & (F.col("adopted") != 0)).alias("children"),
    )
    g = g.where("adopted <> 0 or itemized <> 0").withColumn("change_pct", F.round(X.percent_change("adopted", "before"), 1))
    return share_of_max(g, ["adopted", "itemized"])
