"""Designations out of the charts of a resolution, and the spotlight on one chart.

A line is (doc, line_no, top, text).  A record is anchored by its tax number and amount;
its name wraps onto lines above and below the anchor.  Charts, their column heads, page
feet and footnotes bound a run of records; within a run every wrapped line is given to an
anchor by windows, so nothing is carried from line to line in Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundlens.functions import exprs as X
from fundlens.operators.lines import leading_name

# ---- fixed values: forms of lines
CHART = r"(?i)^CHART\s*#?\s*\d+\s*:\s*(.+)$"
FOOT = r"(?i)^page\s+\d+$|^page\s+\d+\s+of\s+\d+$|^\s*\*+\s*(?:Indicates|Requires)"
COLUMNS = r"EIN Number\s+Agency"
ANCHOR = r"^(.*?)(\d{2}-\d{7})\s+([A-Z][A-Za-z/&.\- ]{0,14}?)?\s*(\(?\$[\d,]+\)?)(.*)$"
CODES = r"^\s*(\d{3})\s+(\d{3})\b"
SOURCES = r"^(Local|Aging|Youth|Anti-?Poverty)\s+"


def _ordered_text(mark: str) -> Column:
    parts = F.array_sort(F.collect_list(F.when(F.col("role") == mark, F.struct("line_no", "text"))))
    return F.array_join(F.transform(parts, lambda x: x["text"]), " ")


def classified(lines: DataFrame) -> DataFrame:
    """``lines`` with kind (chart, foot, columns, anchor, text), the chart they stand in, and run and context numbers."""
    s = F.col("text")
    kind = F.when(s.rlike(CHART), "chart").when(s.rlike(FOOT), "foot").when(s.rlike(COLUMNS), "columns").when(s.rlike(ANCHOR), "anchor").otherwise("text")
    d = lines.withColumn("kind", kind)
    so_far = W.partitionBy("doc").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    title = X.clean(F.regexp_replace(F.regexp_extract(s, CHART, 1), r"(?i)\s*\(continued\)\s*$", ""))
    d = d.withColumn("chart", F.coalesce(F.last(F.when(F.col("kind") == "chart", title), True).over(so_far), F.lit("")))
    lead = F.lower(F.ltrim(s))
    d = d.withColumn("_source", F.coalesce(F.last(F.when(F.col("kind") == "columns", lead.startswith("source")), True).over(so_far), F.lit(False)))
    d = d.withColumn("_member", F.coalesce(F.last(F.when(F.col("kind") == "columns", ~lead.startswith("organization")), True).over(so_far), F.lit(True)))
    d = d.withColumn("_purpose", F.lower("chart").contains("purpose of funds"))
    d = d.withColumn("run", F.sum(F.col("kind").isin("chart", "foot", "columns").cast("int")).over(so_far))
    return d.withColumn("ctx", F.sum(F.col("kind").isin("chart", "columns").cast("int")).over(so_far))


def _owned(d: DataFrame) -> DataFrame:
    """Every wrapped line with the anchor it belongs to, and its role there: above, below or purpose."""
    inside = W.partitionBy("doc", "run").orderBy("line_no")
    anchor = F.when(F.col("kind") == "anchor", F.struct("line_no", F.col("top").cast("double").alias("top")))
    d = d.where("kind in ('anchor', 'text')").withColumn("_a", anchor)
    d = d.withColumn("_p", F.last("_a", True).over(inside.rowsBetween(W.unboundedPreceding, 0))).withColumn("_n", F.first("_a", True).over(inside.rowsBetween(0, W.unboundedFollowing)))
    d = d.withColumn("_head", F.coalesce(F.lead("kind").over(inside) == "anchor", F.lit(False)))
    t = d.where("kind = 'text'")
    standard = ~F.col("_purpose") & ~F.col("_source")
    t = t.where(~(standard & F.col("text").contains("$")))  # what is left of an anchor that lost its form
    first, last = F.col("_p").isNull(), F.col("_n").isNull()
    upper = F.col("top") < (F.col("_p.top") + F.col("_n.top")) / 2
    role = (
        F.when(first & last, None).when(first, "above")
        .when(F.col("_purpose"), F.when(F.col("_head"), "above").otherwise("purpose"))
        .when(F.col("_source"), F.when(~last, "above"))
        .when(last | upper, "below").otherwise("above")
    )
    t = t.withColumn("role", role).where("role is not null")
    return t.select("doc", F.when(F.col("role") == "above", F.col("_n.line_no")).otherwise(F.col("_p.line_no")).alias("anchor_no"), "line_no", "text", "role")


def extract_transparency(lines: DataFrame, roster: DataFrame, name: str = "member") -> DataFrame:
    """(doc, line_no, chart, fiscal_year, action, source, council_member, organization, program, ein, amount, agency, agy_num, ua, purpose, flags).

    ``roster`` (one column) are the members that may lead an anchor line; a member holds
    for the records below it until the next chart or column head.  Lines of null text are
    ignored; a document without anchors gives no rows.
    """
    d = classified(lines.where(F.col("text").isNotNull()).withColumn("text", F.trim("text")))
    wraps = _owned(d).groupBy("doc", "anchor_no").agg(_ordered_text("above").alias("_above"), _ordered_text("below").alias("_below"), _ordered_text("purpose").alias("_more"))
    s = F.col("text")
    a = d.where("kind = 'anchor'").join(wraps.withColumnRenamed("anchor_no", "line_no"), ["doc", "line_no"], "left").fillna("", ["_above", "_below", "_more"])
    front = F.col("_purpose") | F.col("_source")
    pre = X.clean(F.regexp_extract(s, ANCHOR, 1))
    a = a.withColumn("_pre", F.when(front, X.clean(F.concat_ws(" ", "_above", pre))).otherwise(pre))
    source = F.when(front, F.regexp_extract("_pre", SOURCES, 1)).otherwise(F.lit(""))
    a = a.withColumn("source", source).withColumn("_pre", F.when(front, F.trim(F.regexp_replace("_pre", SOURCES, ""))).otherwise(F.col("_pre")))
    a = leading_name(a, "_pre", roster, name)
    own = F.when(F.col("_member"), F.col("match"))
    held = F.last(own, True).over(W.partitionBy("doc", "ctx").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0))
    a = a.withColumn("council_member", F.when(F.col("_member"), F.coalesce(held, F.lit(""))).otherwise(""))
    local = F.when(own.isNotNull(), F.trim(F.substring("_pre", F.length("match") + 1, F.length("_pre")))).otherwise(F.col("_pre"))
    blob = X.clean(F.when(front, local).otherwise(F.concat_ws(" ", "_above", local, "_below")))
    a = a.withColumn("_blob", blob)
    text, flags = X.strip_flags("_blob")
    a = a.withColumn("_text", text).withColumn("flags", flags)
    sponsor, rest = X.peel_delegation("_text")
    a = a.withColumn("_sponsor", sponsor).withColumn("_rest", rest)
    org, program = X.split_first("_rest")
    tail = F.trim(F.regexp_extract(s, ANCHOR, 5))
    coded = tail.rlike(CODES)
    purpose = F.when(coded, F.trim(F.regexp_replace(tail, CODES, ""))).otherwise(tail)
    amount = X.money_signed(F.regexp_extract(s, ANCHOR, 4))
    return a.select(
        "doc", "line_no", "chart", F.regexp_extract("chart", r"(?i)\bFiscal\s*(\d{4})\b", 1).alias("fiscal_year"),
        F.when(F.col("_purpose"), "purpose_change").when(amount < 0, "rescind").otherwise("designate").alias("action"), "source",
        F.when(F.col("council_member") == "", F.col("_sponsor")).otherwise(F.col("council_member")).alias("council_member"), org.alias("organization"), program.alias("program"),
        X.ein_without_hyphens(F.regexp_extract(s, ANCHOR, 2)).alias("ein"), amount.alias("amount"), F.trim(F.regexp_extract(s, ANCHOR, 3)).alias("agency"),
        F.when(coded, F.regexp_extract(tail, CODES, 1)).otherwise("").alias("agy_num"), F.when(coded, F.regexp_extract(tail, CODES, 2)).otherwise("").alias("ua"),
        F.when(F.col("_purpose"), X.clean(F.concat_ws(" ", purpose, "_more"))).otherwise(purpose).alias("purpose"), "flags",
    )


def spotlight(rows: DataFrame, marker: str, keys: tuple[str, ...] = ("resolution", "date")) -> DataFrame:
    """(keys, rows, net, rescinded, designated, recipients): the charts whose title holds ``marker``, split by sign, per document.

    Amounts combine before the shuffle; a null amount counts as 0.
    """
    a = F.coalesce(F.col("amount"), F.lit(0))
    s = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return rows.where(F.col("chart").contains(marker)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), s(a).alias("net"), s(F.when(a < 0, a)).alias("rescinded"), s(F.when(a > 0, a)).alias("designated"), F.count_if(a > 0).alias("recipients")
    )


def spotlight_recipients(rows: DataFrame, marker: str) -> DataFrame:
    """(organization, amount) of every positive row of the charts with ``marker``, largest first."""
    return rows.where(F.col("chart").contains(marker) & (F.col("amount") > 0)).select("organization", "amount").orderBy(F.desc("amount"), "organization")
