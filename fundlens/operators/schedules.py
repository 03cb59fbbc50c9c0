"""Variants of printed schedules: appendices, wrapped summary tables, unnumbered terms, contents, junk rows.

A line is (doc, line_no, line).  All state that a printed page carries from line to line is
a window over one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundlens.functions import exprs as X
from fundlens.operators.lines import bounded_heading, forward_fill, inside_blocks, leading_name

# ---- fixed values: forms of lines and phrases
RUNNING_HEAD = r"(?i)^fiscal year \d{4} adopted expense budget adjustment summary"
NUMBER_ALONE = r"^\d{1,3}$"
APPENDIX_ANCHOR = r"(\d{2}-?\d{7})\s+\$([\d,]+)((?:\s+[A-Z]{2,6}(?:/[A-Z]{2,6})?)?)"
HEADER_PHRASES = ("legal name", "program name", "council member", "sponsor legal")
CONTENTS_LINE = r"^(.+?)\s*\.{3,}\s*(\d+)\s*$"
CONTENTS_HEAD = r"(?i)^\s*(?:table of )?contents\s*$"
CONTENTS_NOISE = r"SCHEDULE C INTRO|TABLE OF CONTENT|APPENDIX"
AGENCY_HEAD = r"^(.+?\S)\s+\((\d{3})\)\s*$"
CAPITAL_HEAD = "Capital Budget"
UNIT_LINE = r"^Units? of Appropriation\s+\[?(\w+)\]?"
CAPITAL_UNIT = r"^(?:Budget Line|All Project Lines)\b"
TERMS_FURNITURE = r"^Page \d+ of \d+$|^\d{1,3}$|(?i)^(?:terms )?and conditions$|(?i)^terms$"


def without_header_rows(awards: DataFrame, name: str = "organization") -> DataFrame:
    """Rows whose name is a piece of a table head are dropped; null names stay."""
    return awards.where(~F.coalesce(F.lower(F.col(name)).rlike("|".join(HEADER_PHRASES)), F.lit(False)))


def _so_far(*by: str) -> W:
    return W.partitionBy(*by).orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)


def _before(*by: str) -> W:
    return W.partitionBy(*by).orderBy("line_no").rowsBetween(W.unboundedPreceding, -1)


def _text(of: Column | None = None, value: str = "line") -> Column:
    s = F.struct("line_no", value)
    return F.array_join(F.transform(F.array_sort(F.collect_list(s if of is None else F.when(of, s))), lambda x: x[value]), " ")


# ------------------------------------------------------------------ appendices


def extract_appendix(lines: DataFrame, roster: DataFrame, name: str = "member", has_agency: bool = True, has_purpose: bool = True) -> DataFrame:
    """(doc, n, member, organization, program, ein, amount, agency, purpose): the records of an appendix.

    Of the text between two anchors the purpose of the first record comes first; the first
    line that begins with a name of the roster begins the second.  Several anchors may
    stand on one line.
    """
    kept = lines.where(~F.trim("line").rlike(RUNNING_HEAD) & ~F.trim("line").rlike(NUMBER_ALONE))
    pieces = F.split(F.regexp_replace("line", f"({APPENDIX_ANCHOR})", "\u0001$1\u0001"), "\u0001")
    p = kept.select("doc", "line_no", F.posexplode(pieces).alias("k", "piece")).select("doc", F.struct("line_no", "k").alias("line_no"), F.trim("piece").alias("line")).where("line <> ''")
    p = p.withColumn("_is", F.col("line").rlike(f"^{APPENDIX_ANCHOR}$")).withColumn("n", F.sum(F.col("_is").cast("int")).over(_so_far("doc")))
    text = leading_name(p.where(~F.col("_is")), "line", roster, name)
    text = text.withColumn("_first", F.min(F.when(F.col("match").isNotNull(), F.col("line_no"))).over(W.partitionBy("doc", "n")))
    begins = F.col("line_no") == F.col("_first")
    head = F.when(begins, F.trim(F.substring("line", F.length("match") + 1, F.length("line")))).otherwise(F.col("line"))
    g = text.withColumn("head", head).groupBy("doc", "n").agg(
        F.max(F.when(begins, F.col("match"))).alias("member"), _text(F.col("_first").isNull() | (F.col("line_no") >= F.col("_first")), "head").alias("name"),
        _text(F.col("_first").isNull() | (F.col("line_no") < F.col("_first"))).alias("purpose"),
    )
    a = p.where("_is").select("doc", "n", *(F.regexp_extract("line", APPENDIX_ANCHOR, i).alias(c) for i, c in ((1, "_ein"), (2, "_amount"), (3, "_agency"))))
    j = a.join(g.select("doc", (F.col("n") + 1).alias("n"), "member", "name"), ["doc", "n"], "left").join(g.select("doc", "n", "purpose"), ["doc", "n"], "left")
    org, program = X.split_org_program(F.coalesce("name", F.lit("")))
    return j.select(
        "doc", "n", F.coalesce("member", F.lit("")).alias("member"), org.alias("organization"), program.alias("program"), X.ein_without_hyphens("_ein").alias("ein"), X.money_or_zero("_amount").alias("amount"),
        (F.trim("_agency") if has_agency else F.lit("")).alias("agency"), (X.clean(F.coalesce("purpose", F.lit(""))) if has_purpose else F.lit("")).alias("purpose"),
    )


# ------------------------------------------------------------------ summary tables with wrapped names


def _finished(d: DataFrame, is_head: Column, is_total: Column) -> DataFrame:
    """The lines inside tables that reach their total, with ``block``; and ``printed``, that total."""
    printed = X.money_or_zero(F.regexp_extract("line", r"\$([\d,]+)", 1))
    b = d.withColumn("block", F.sum(is_head.cast("int")).over(_so_far("doc")))
    ended = F.coalesce(F.max(is_total.cast("int")).over(_before("doc", "block")), F.lit(0))
    totals = b.withColumn("_e", ended).where((F.col("block") > 0) & is_total & (F.col("_e") == 0)).select("doc", "block", printed.alias("printed"))
    return inside_blocks(d, is_head, is_total).join(totals, ["doc", "block"])


def _records(rows: DataFrame, amount: Column, resets: Column, body: Column) -> DataFrame:
    """(doc, block, category, printed, line_no, body, amount): the lines up to each amount as one text; what a reset ends is dropped."""
    r = rows.withColumn("_amount", amount).withColumn("_reset", resets & amount.isNull()).withColumn("_body", body)
    ends = F.col("_amount").isNotNull() | F.col("_reset")
    r = r.withColumn("_k", F.coalesce(F.sum(ends.cast("int")).over(_before("doc", "block")), F.lit(0)))
    g = r.where("not _reset").groupBy("doc", "block", "_k").agg(F.max("category").alias("category"), F.max("printed").alias("printed"), F.max(F.when(F.col("_amount").isNotNull(), F.col("line_no"))).alias("line_no"), X.clean(_text(None, "_body")).alias("body"), F.max("_amount").alias("amount"))
    return g.where("amount is not null").drop("_k")


def extract_summary_adjacent(lines: DataFrame, categories: DataFrame, reach: int = 8) -> DataFrame:
    """(doc, block, line_no, category, agency, initiative, amount, printed): tables under the nearest of ``categories`` among the ``reach`` lines before their head.

    Names may wrap, amounts may lack their sign or stand apart from it.  A table without
    such a heading gets a numbered stand-in.
    """
    names = categories.select(F.upper(X.clean(categories.columns[0])).alias("_u"), F.col(categories.columns[0]).alias("_c")).where("_u <> ''").dropDuplicates(["_u"])
    d = lines.withColumn("line", X.trim_all("line")).where("line <> ''")
    d = d.withColumn("line_no", F.row_number().over(W.partitionBy("doc").orderBy("line_no")) - 1)
    d = d.join(names, F.upper(X.clean("line")) == F.col("_u"), "left").drop("_u")
    d = bounded_heading(d, F.col("_c"), "_near", reach)
    is_head, is_total = F.col("line").rlike(r"(?i)agency\s+initiative\s+amount"), F.col("line").rlike(r"(?i)^total\b.*?\$[\d,]+")
    d = d.withColumn("category", F.when(is_head, F.coalesce("_near", F.concat(F.lit("UNMAPPED_BLOCK_@"), F.col("line_no").cast("string")))))
    d = d.withColumn("category", F.last("category", True).over(_so_far("doc")))
    rows = _finished(d, is_head, is_total)
    line = F.col("line")
    skip = line.rlike(RUNNING_HEAD) | line.rlike(NUMBER_ALONE)
    amount = F.when(~skip, X.trailing_amount("line"))
    resets = skip | F.col("_c").isNotNull() | line.rlike(r"(?i)council initiatives") | line.rlike(r"(?i)^fiscal \d{4}")
    body = F.when(amount.isNotNull(), F.trim(F.regexp_replace(line, r"\$\s*[\d,]+\s*$|(?<!\S)\d{1,3}(?:,\d{3})+\s*$", ""))).otherwise(line)
    r = _records(rows, amount, resets, body)
    agency, name = X.agency_prefix_split("body")
    return r.select("doc", "block", "line_no", "category", agency.alias("agency"), name.alias("initiative"), "amount", "printed")


def extract_summary_legacy(lines: DataFrame) -> DataFrame:
    """(doc, block, line_no, category, agency, initiative, amount, printed): tables headed Agency, Initiative, Funding under the last heading in capitals.

    An amount may be glued to the name or stand alone on a line; numbers broken at a comma
    are mended.  The first word is the agency.
    """
    d = lines.withColumn("line", X.split_number_repair(X.trim_all("line"))).where("line <> ''")
    line = F.col("line")
    is_head, is_total = line.rlike(r"(?i)^Agency\s+Initiative\s+Funding\b"), line.rlike(r"(?i)^TOTAL\s+\$([\d,]+)\s*$")
    d = d.withColumn("_block", F.sum(is_head.cast("int")).over(_so_far("doc"))).withColumn("_total", F.coalesce(F.max(is_total.cast("int")).over(_before("doc", "_block")), F.lit(0)))
    outside = ((F.col("_block") == 0) | (F.col("_total") == 1)) & ~is_head
    d = forward_fill(d, F.when(outside & X.is_caps_header("line") & ~line.rlike(r"(?i)adopted expense budget adjustment|city council finance division|^fiscal year \d{4}|page \|"), line), "_last")
    d = d.withColumn("category", F.last(F.when(is_head, F.coalesce("_last", F.concat(F.lit("CATEGORY_"), F.col("_block").cast("string")))), True).over(_so_far("doc")))
    rows = _finished(d, is_head, is_total)
    amount = X.money_or_zero(F.nullif(F.regexp_extract("line", r"\$([\d,]+)\s*$", 1), F.lit("")))
    amount = F.when(F.col("line").rlike(r"\$[\d,]+\s*$"), amount)
    r = _records(rows, amount, F.lit(False), F.regexp_replace("line", r"\s*\$[\d,]+\s*$", "")).where("body <> ''")
    agency, name = X.first_token_split("body")
    return r.select("doc", "block", "line_no", "category", agency.alias("agency"), name.alias("initiative"), "amount", "printed")


# ------------------------------------------------------------------ terms without numbers


def unnumbered_items(lines: DataFrame) -> DataFrame:
    """``lines`` without furniture, with ``item`` (counted in document order) and ``kind`` (head, unit, text).

    A head begins an item if text stands between it and the head before it; else it names
    one more agency of the same item.  Lines before the first head have no item and drop out.
    """
    line = F.col("line")
    d = lines.withColumn("line", X.trim_all(F.translate("line", "\u00a0\u2010", " -"))).where("line <> ''")
    d = d.where(~line.rlike(TERMS_FURNITURE) & ~(line.rlike(r"(?i)^fiscal (?:year )?20\d\d") & ~F.lower(line).contains("condition")))
    head = line.rlike(AGENCY_HEAD) | (line == CAPITAL_HEAD)
    unit = line.rlike(UNIT_LINE) | line.rlike(CAPITAL_UNIT)
    d = d.withColumn("_m", F.when(head, "head").when(~unit, "text"))
    before = F.last("_m", True).over(_before("doc"))
    first = F.coalesce(F.max((F.col("_m") == "head").cast("int")).over(_before("doc")), F.lit(0)) == 0
    d = d.withColumn("_new", (F.col("_m") == "head") & (first | (before == "text")))
    d = d.withColumn("item", F.sum(F.coalesce(F.col("_new"), F.lit(False)).cast("int")).over(_so_far("doc"))).where("item > 0")
    texted = F.coalesce(F.max((F.col("_m") == "text").cast("int")).over(_before("doc", "item")), F.lit(0)) == 1
    return d.withColumn("kind", F.when(F.col("_m") == "head", "head").when((F.col("_m") == "text") | texted, "text").otherwise("unit")).drop("_m", "_new")


def extract_terms_unnumbered(lines: DataFrame) -> DataFrame:
    """(doc, item_number, agency_name, agency_code, units_of_appropriation, num_units, report_deadlines, coverage_period, condition_text)."""
    d = unnumbered_items(lines)
    of = lambda k, v: F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.struct("line_no", v.alias("v"))))), lambda x: x["v"])
    unit = F.coalesce(F.nullif(F.regexp_extract("line", UNIT_LINE, 1), F.lit("")), X.clean("line"))
    g = d.groupBy("doc", "item").agg(F.get(of("head", F.col("line")), F.lit(0)).alias("h"), of("unit", unit).alias("units"), F.regexp_replace(X.clean(F.array_join(of("text", F.col("line")), " ")), r"(\w)\s-\s(\w)", "$1$2").alias("condition_text"))
    named = F.col("h").rlike(AGENCY_HEAD)
    return g.select(
        "doc", F.col("item").cast("int").alias("item_number"), F.when(named, F.regexp_extract("h", AGENCY_HEAD, 1)).otherwise(F.col("h")).alias("agency_name"), F.regexp_extract("h", AGENCY_HEAD, 2).alias("agency_code"),
        F.array_join("units", "; ").alias("units_of_appropriation"), F.size("units").alias("num_units"), X.dates_in("condition_text").alias("report_deadlines"), X.coverage_period("condition_text").alias("coverage_period"), "condition_text",
    )


# ------------------------------------------------------------------ contents


def contents_page(lines: DataFrame, last_page: int = 8, least: int = 5) -> DataFrame:
    """(doc, page): the page headed Contents among the first ``last_page``, else the one with most dotted lines if there are ``least``."""
    front = lines.where(F.col("page") <= last_page)
    headed = F.min(F.when(F.col("line").rlike(CONTENTS_HEAD), F.col("page")))
    n = front.groupBy("doc", "page").agg(headed.alias("_h"), F.count_if(F.trim("line").rlike(CONTENTS_LINE)).alias("_n"))
    g = n.groupBy("doc").agg(F.min("_h").alias("_h"), F.max(F.struct("_n", (-F.col("page")).alias("p"))).alias("_d"))
    page = F.coalesce("_h", F.when(F.col("_d._n") >= least, -F.col("_d.p")))
    return g.select("doc", page.alias("page")).where("page is not null")


def contents_categories(lines: DataFrame, pages: int = 3) -> DataFrame:
    """(doc, n, category): the names of the table of contents in order, each once; introductions, appendices and names under four letters are left out.

    ``lines`` is (doc, page, line_no, line).
    """
    at = contents_page(lines).withColumnRenamed("page", "_toc")
    d = lines.join(at, "doc").where((F.col("page") >= F.col("_toc")) & (F.col("page") < F.col("_toc") + pages))
    s = F.trim("line")
    name = F.trim(F.regexp_extract(s, CONTENTS_LINE, 1))
    d = d.where(s.rlike(CONTENTS_LINE)).select("doc", "page", "line_no", name.alias("category")).where(~F.upper("category").rlike(CONTENTS_NOISE) & (F.length("category") >= 4))
    same = W.partitionBy("doc", F.upper(X.clean("category"))).orderBy("page", "line_no")
    d = d.withColumn("_r", F.row_number().over(same)).where("_r = 1")
    return d.select("doc", F.row_number().over(W.partitionBy("doc").orderBy("page", "line_no")).alias("n"), "category")
