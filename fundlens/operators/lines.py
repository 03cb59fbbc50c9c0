"""Tables out of ordered lines: context carried forward, blocks, records, assignments.

A line is (doc, line_no, text).  Documents are independent, so every window is bounded by
one document; a document that is itself huge can be divided at its block starts first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundlens.functions import exprs as X


def explode_lines(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, line_no, line): every line, counted from 0; null and empty texts give none."""
    return docs.where(F.col(text) != "").select(F.col(doc).alias("doc"), F.posexplode(F.split(text, r"\r\n|\n|\r")).alias("line_no", "line"))


def _order(doc: str, line: str):
    return W.partitionBy(doc).orderBy(line)


def forward_fill(lines: DataFrame, value: Column, name: str, doc: str = "doc", line: str = "line_no") -> DataFrame:
    """``lines`` with the last value seen up to each line."""
    return lines.withColumn(name, F.last(value, ignorenulls=True).over(_order(doc, line).rowsBetween(W.unboundedPreceding, 0)))


def bounded_heading(lines: DataFrame, value: Column, name: str, reach: int = 8, doc: str = "doc", line: str = "line_no") -> DataFrame:
    """``lines`` with the nearest value among the ``reach`` lines before each."""
    return lines.withColumn(name, F.last(value, ignorenulls=True).over(_order(doc, line).rowsBetween(-reach, -1)))


def block_ids(lines: DataFrame, starts: Column, name: str = "block", doc: str = "doc", line: str = "line_no") -> DataFrame:
    """``lines`` with a running number that grows at every start; 0 before the first."""
    n = F.sum(F.when(starts, 1).otherwise(0)).over(_order(doc, line).rowsBetween(W.unboundedPreceding, 0))
    return lines.withColumn(name, n.cast("bigint"))


def inside_blocks(lines: DataFrame, starts: Column, ends: Column, doc: str = "doc", line: str = "line_no") -> DataFrame:
    """Lines after a start and before its end, with their block number."""
    b = block_ids(lines, starts, doc=doc, line=line).withColumn("_end", ends).withColumn("_start", starts)
    over = W.partitionBy(doc, "block").orderBy(line).rowsBetween(W.unboundedPreceding, 0)
    ended = F.max(F.col("_end").cast("int")).over(over)
    return b.withColumn("_over", ended).where("block > 0 and _over = 0 and not _start").drop("_end", "_start", "_over")


def assemble(lines: DataFrame, record: str = "block", doc: str = "doc", line: str = "line_no", text: str = "line") -> DataFrame:
    """(doc, record, text): the lines of a record joined by blanks in their order."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct(line, text))), lambda x: x[text])
    return lines.groupBy(doc, record).agg(X.clean(F.array_join(parts, " ")).alias("text"))


def lookahead(lines: DataFrame, flag: Column, name: str, doc: str = "doc", line: str = "line_no") -> DataFrame:
    """``lines`` with what ``flag`` says of the next line; false on the last."""
    return lines.withColumn("_f", flag).withColumn(name, F.coalesce(F.lead("_f").over(_order(doc, line)), F.lit(False))).drop("_f")


def midpoint_assign(points: DataFrame, is_anchor: Column, place: str, key: Sequence[str], id_col: str) -> DataFrame:
    """``points`` with ``anchor``: the id of the nearer of the anchors before and after; the earlier of two as near."""
    a = F.when(is_anchor, F.struct(F.col(place).alias("p"), F.col(id_col).alias("i")))
    # the next one is the last one seen in reverse order: a frame that ends at the last row would be worked out anew for every row
    seen = lambda *order: F.last("_a", True).over(W.partitionBy(*key).orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    d = points.withColumn("_a", a).withColumn("_prev", seen(F.asc(place), F.asc(id_col))).withColumn("_next", seen(F.desc(place), F.desc(id_col)))
    near_prev = F.col("_next").isNull() | (F.col("_prev").isNotNull() & ((F.col(place) - F.col("_prev.p")) <= (F.col("_next.p") - F.col(place))))
    return d.withColumn("anchor", F.when(near_prev, F.col("_prev.i")).otherwise(F.col("_next.i"))).drop("_a", "_prev", "_next")


def band_of(value: Column, bands: Sequence[tuple[str, float, float]]) -> Column:
    """The band [low, high) a value lies in, null outside all; a fixed list, so no join."""
    c = F.lit(None).cast("string")
    for name, low, high in reversed(bands):
        c = F.when((value >= low) & (value < high), name).otherwise(c)
    return c


def nearest_of(value: Column, centres: Sequence[tuple[str, float]], tolerance: float) -> Column:
    """The name of the nearest centre within the tolerance, the first of two as near."""
    options = F.array(*(F.struct(F.abs(value - F.lit(x)).alias("d"), F.lit(i).alias("i"), F.lit(n).alias("n")) for i, (n, x) in enumerate(centres)))
    best = F.array_min(options)
    return F.when(best["d"] < tolerance, best["n"])


def row_clusters(words: DataFrame, page: Sequence[str], top: str, x: str, text: str, step: int = 5) -> DataFrame:
    """(page, row, line): words of one height (rounded to ``step``, half to even) in order from the left."""
    w = words.withColumn("row", F.bround(F.col(top) / step).cast("bigint"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct(x, text))), lambda e: e[text])
    return w.groupBy(*page, "row").agg(F.array_join(parts, " ").alias("line"))


def longest_prefix(lines: DataFrame, text: str, roster: DataFrame, name: str, most: int = 3) -> DataFrame:
    """``lines`` with ``match``: the longest run of up to ``most`` leading words that is a name of the roster.

    One equi-join per length, never a join of every line with every name.
    """
    names = roster.select(F.upper(X.clean(name)).alias("_n")).where("_n <> ''").distinct()
    out = lines.withColumn("_w", F.split(F.upper(X.clean(text)), " "))
    for k in range(most, 0, -1):
        key = F.when(F.size("_w") >= k, F.array_join(F.slice("_w", 1, k), " "))
        out = out.withColumn("_k", key).join(names.withColumnRenamed("_n", f"_m{k}"), F.col("_k") == F.col(f"_m{k}"), "left").drop("_k")
    return out.withColumn("match", F.coalesce(*(F.col(f"_m{k}") for k in range(most, 0, -1)))).drop("_w", *(f"_m{k}" for k in range(1, most + 1)))


def leading_name(lines: DataFrame, text: str, roster: DataFrame, name: str, most: int = 3) -> DataFrame:
    """As ``longest_prefix``, but case counts: the match stands in the text as it stands in the roster."""
    names = roster.select(X.clean(name).alias("_n")).where("_n <> ''").distinct()
    out = lines.withColumn("_w", F.split(X.clean(text), " "))
    for k in range(most, 0, -1):
        key = F.when(F.size("_w") >= k, F.array_join(F.slice("_w", 1, k), " "))
        out = out.withColumn("_k", key).join(names.withColumnRenamed("_n", f"_m{k}"), F.col("_k") == F.col(f"_m{k}"), "left").drop("_k")
    return out.withColumn("match", F.coalesce(*(F.col(f"_m{k}") for k in range(most, 0, -1)))).drop("_w", *(f"_m{k}" for k in range(1, most + 1)))


def peel_names(text: Column, names: Sequence[str]) -> tuple[Column, Column]:
    """(names, rest): names of a short roster, separated by commas, at the head of a text; the longest are tried first.

    Case and accents do not count.  Without a name the first is empty and the rest is the text.
    """
    alternatives = "|".join(r"\Q" + n.upper() + r"\E" for n in sorted(set(names), key=lambda n: (-len(n), n)))
    folded = F.upper(X.deaccent(text))
    run = F.regexp_extract(folded, rf"^((?:{alternatives})(?:\s*,\s*(?:{alternatives}))*)(?![A-Za-z])", 1)
    n = F.length(run)
    found = F.substring(X.deaccent(text), F.lit(1), n)
    return F.array_join(F.transform(F.split(found, ","), lambda x: F.trim(x)), ", "), F.btrim(F.substring(text, n + 1, F.lit(1_000_000)), F.lit(" ,"))


def positional_zip(left: DataFrame, right: DataFrame, key: str, left_order: str, right_order: str, right_value: str, overflow: str = "UNMAPPED_BLOCK_") -> DataFrame:
    """The n-th row of ``left`` with the n-th value of ``right``, per key; surplus rows get a numbered stand-in."""
    l = left.withColumn("n", F.row_number().over(W.partitionBy(key).orderBy(left_order)))
    r = right.select(key, F.col(right_value).alias("mapped"), F.row_number().over(W.partitionBy(key).orderBy(right_order)).alias("n"))
    return l.join(r, [key, "n"], "left").withColumn("mapped", F.coalesce("mapped", F.concat(F.lit(overflow), F.col("n").cast("string"))))


def frequent_lines(lines: DataFrame, line: str = "line", least: int = 5, pattern: str = r"^[A-Z][A-Za-z.'\-]+(?: [A-Z][A-Za-z.'\-]+){0,2}$") -> DataFrame:
    """(line, n): a roster of short name lines that occur often enough."""
    return lines.where(F.col(line).rlike(pattern)).groupBy(line).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


# ------------------------------------------------------------------ extraction


def extract_awards(lines: DataFrame, line: str = "line") -> DataFrame:
    """``lines`` with organization, program, ein, amount, agency of an award line 'ORG - PROGRAM 12-3456789 $1,234 DYF'; others drop out."""
    s = X.split_number_repair(X.clean(line))
    anchor = r"^(.*?)\s*(\d{2}-?\d{7})\s+(\(?\$[\d,]+\)?)\s*([A-Z]{2,6}(?:/[A-Z]{2,6})?)?\s*$"
    head = F.regexp_extract(s, anchor, 1)
    text, flags = X.strip_flags(head)
    org, program = X.split_org_program(text)
    return lines.where(s.rlike(anchor)).select(
        "*", org.alias("organization"), program.alias("program"), flags.alias("flags"), X.ein_without_hyphens(F.regexp_extract(s, anchor, 2)).alias("ein"),
        X.money_signed(F.regexp_extract(s, anchor, 3)).alias("amount"), F.regexp_extract(s, anchor, 4).alias("agency"),
    )


def extract_initiatives(lines: DataFrame, header: str = r"(?i)^Agency\s+Initiative\s+Funding\b", total: str = r"(?i)^TOTAL\s+\$[\d,]+\s*$") -> DataFrame:
    """(doc, line_no, category, agency, initiative, amount): rows between a table head and its total, under the last heading in capitals."""
    head, tot = F.col("line").rlike(header), F.col("line").rlike(total)
    d = forward_fill(lines, F.when(X.is_caps_header("line") & ~tot, F.col("line")), "category")
    rows = inside_blocks(d, head, tot)
    amount = X.trailing_amount("line")
    agency, initiative = X.first_token_split(F.regexp_replace("line", r"\s*\$?\s*[\d,]+\s*$", ""))
    return rows.where(amount.isNotNull()).select("doc", "line_no", "category", agency.alias("agency"), initiative.alias("initiative"), amount.alias("amount"))


def extract_terms(lines: DataFrame) -> DataFrame:
    """(doc, item_number, agency_name, agency_code, units_of_appropriation, num_units, report_deadlines, coverage_period, condition_text) of numbered items."""
    head = r"^(\d{1,3})\.\s+(.+?\S)\s+\((\d{3})\)\s*$"
    unit = r"^Unit of Appropriation\s+\[?(\w+)\]?"
    junk = F.col("line").rlike(r"^Page \d+ of \d+$|^\d{1,3}$|(?i)^terms and conditions$") | (F.trim("line") == "")
    d = block_ids(lines.where(~junk), F.col("line").rlike(head), "item").where("item > 0")
    h = F.max(F.when(F.col("line").rlike(head), F.col("line")))
    ordered = lambda cond, value: F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("line_no", value.alias("v"))))), lambda x: x["v"])
    is_head, is_unit = F.col("line").rlike(head), F.col("line").rlike(unit)
    g = d.groupBy("doc", "item").agg(h.alias("h"), ordered(is_unit, F.regexp_extract("line", unit, 1)).alias("units"), X.clean(F.array_join(ordered(~is_head & ~is_unit, F.col("line")), " ")).alias("condition_text"))
    return g.select(
        "doc", F.regexp_extract("h", head, 1).cast("int").alias("item_number"), F.regexp_extract("h", head, 2).alias("agency_name"), F.regexp_extract("h", head, 3).alias("agency_code"),
        F.array_join("units", "; ").alias("units_of_appropriation"), F.size("units").alias("num_units"), X.dates_in("condition_text").alias("report_deadlines"),
        X.coverage_period("condition_text").alias("coverage_period"), "condition_text",
    )


def extract_capital(lines: DataFrame, roster: Sequence[str] = ()) -> DataFrame:
    """(doc, line_no, part, agency, budget_line, sub_id, boro, fy1..fy4, title, sponsor): token rows under agency heads.

    An agency head is a line in capitals without amounts; the part is the last 'I.' to 'III.'.
    """
    d = forward_fill(lines, F.nullif(F.regexp_extract("line", r"^(I{1,3})\.$", 1), F.lit("")), "part")
    d = forward_fill(d, F.when(X.is_caps_header("line") & ~X.is_data_row("line") & ~F.col("line").rlike(r"^I{1,3}\.$"), F.col("line")), "agency")
    t = F.split(X.clean("line"), " ")
    rest = F.array_join(F.slice(t, 6, 10_000), " ")
    number = r"-?\d{1,3}(?:,\d{3})*"
    pattern = rf"^(.*?)\s*(?:(?<!\S){number}\s+){{3}}{number}(?=\s|$)(?!\s+{number}(?:\s|$))\s*(.*)$"
    f = X.amount_run(rest)
    out = d.where(X.is_data_row("line")).select(
        "doc", "line_no", "part", "agency", F.concat_ws(" ", t[0], t[1]).alias("sub_id"), F.concat_ws(" ", t[2], t[3]).alias("budget_line"), t[4].alias("boro"),
        *(f[i].alias(f"fy{i + 1}") for i in range(4)), F.regexp_extract(rest, pattern, 1).alias("title"), F.regexp_extract(rest, pattern, 2).alias("sponsor"),
    )
    return out.withColumn("sponsor", peel_names(F.col("sponsor"), roster)[0]) if roster else out


def extract_printed_totals(lines: DataFrame) -> DataFrame:
    """(doc, line_no, agency, projects, is_grand, amount): 'TOTALS FOR <agency> (N PROJECTS) ...' lines."""
    p = r"(?i)^(?:([\d,]+)\s+.*)?TOTALS FOR\s+(.+?)\s+\((\d+)\s+PROJECTS?\)\s*([\d,]*)"
    s = lines.where(F.col("line").rlike(p))
    a = F.regexp_extract("line", p, 2)
    amount = X.money_or_zero(X.first_filled(F.regexp_extract("line", p, 1), F.regexp_extract("line", p, 4)))
    return s.select("doc", "line_no", a.alias("agency"), F.regexp_extract("line", p, 3).cast("int").alias("projects"), (F.upper(a) == "ALL").alias("is_grand"), amount.alias("amount"))


def contents_entries(lines: DataFrame) -> DataFrame:
    """(doc, line_no, title, page): dotted lines of a table of contents, each title once."""
    p = r"^(.+?)\s*\.{3,}\s*(\d+)\s*$"
    t = lines.where(F.col("line").rlike(p)).select("doc", "line_no", X.clean(F.regexp_extract("line", p, 1)).alias("title"), F.regexp_extract("line", p, 2).cast("int").alias("page"))
    w = W.partitionBy("doc", F.upper("title")).orderBy("line_no")
    return t.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")


def first_page_with(lines: DataFrame, marker: str, page: str, after: int = 5) -> DataFrame:
    """(doc, page): the first page beyond ``after`` with a line that begins with the marker."""
    return lines.where((F.col(page) > after) & F.lower("line").startswith(marker.lower())).groupBy("doc").agg(F.min(page).alias("page"))
