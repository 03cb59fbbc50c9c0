"""Tables out of words placed on pages: rows by height, column bands, capital tables.

A word is (doc, page, text, x0, x1, top).  Pages are the unit that is gathered (a page has
a bounded number of words); documents are ordered by (page, height) windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundlens.functions import exprs as X

# ---- fixed values: letters of boroughs, forms of amounts and codes, places on a page in points
BORO_LETTERS = ("M", "X", "K", "Q", "R", "A")
AMOUNT = r"^-?[\d,]+$"
DOLLARS = r"^\$-?[\d,]+$"
CHANGE = r"^([\d,]+)\(CN\)$"
PLAIN = r"^[\d,]+$"
LINE_CODE = r"^[A-Z]{1,3}-D[A-Z0-9]+$"
CHANGE_WORDS = ("ELIMINATE", "SUBSTITUTE")
CAPS_WORD = r"^[A-Z0-9&'./,\-()]+$"
CHANGE_COLUMNS = (("fy1", 445.0), ("fy2", 550.0), ("fy3", 655.0), ("fy4", 760.0))
PART_MARK = r"^(I{1,3})\.$"

PAGE = ["doc", "page"]


def _money(c: Column) -> Column:
    return X.money_or_zero(F.regexp_replace(c, r"\(CN\)$", ""))


def greedy_rows(words: DataFrame, tolerance: float = 3.0) -> DataFrame:
    """``words`` with ``y``: the height of the row a word stands in.

    From the top down, a word belongs to the row whose first word is at most ``tolerance``
    above it, else it begins a row.  The distinct heights of one page are folded in order,
    which is what a window over neighbours cannot say: the first word of a row is the
    measure, not the one before.
    """
    last = lambda acc: F.get(acc, F.size(acc) - 1)["a"]
    step = lambda acc, t: F.concat(acc, F.array(F.struct(t.alias("t"), F.when(t - last(acc) <= tolerance, last(acc)).otherwise(t).alias("a"))))
    tops = words.groupBy(*PAGE).agg(F.array_sort(F.collect_set(F.col("top").cast("double"))).alias("_tops"))
    rows = tops.select(*PAGE, F.explode(F.aggregate("_tops", F.array().cast("array<struct<t:double,a:double>>"), step)).alias("_r"))
    rows = rows.select(*PAGE, F.col("_r.t").alias("_top"), F.col("_r.a").alias("y"))
    return words.withColumn("_top", F.col("top").cast("double")).join(rows, [*PAGE, "_top"]).drop("_top")


def page_rows(words: DataFrame, tolerance: float = 3.0) -> DataFrame:
    """(doc, page, y, ws): one row per row of a page, its words from the left as structs (x0, x1, text)."""
    w = F.array_sort(F.collect_list(F.struct(F.col("x0").cast("double").alias("x0"), F.col("x1").cast("double").alias("x1"), "text")))
    return greedy_rows(words, tolerance).groupBy(*PAGE, "y").agg(w.alias("ws"))


def page_parts(words: DataFrame, top: float = 45.0) -> DataFrame:
    """(doc, page, part): the part mark (I., II. or III.) at the head of a page, carried on over pages without one; empty before the first."""
    mark = F.when((F.col("top") < top) & F.col("text").rlike(PART_MARK), F.struct(F.col("top").cast("double"), F.col("x0").cast("double"), F.regexp_extract("text", PART_MARK, 1).alias("p")))
    p = words.groupBy(*PAGE).agg(F.min(mark)["p"].alias("_p"))
    return p.select(*PAGE, F.coalesce(F.last("_p", True).over(W.partitionBy("doc").orderBy("page").rowsBetween(W.unboundedPreceding, 0)), F.lit("")).alias("part"))


def header_bands(words: DataFrame, anchor: str, labels: dict[str, str], anchor_top: float, fy_from: float, near: float = 4.0) -> DataFrame:
    """(doc, page, labels, fy): the left edges of column labels in the row of the word ``anchor``, and those of up to four FY columns in order.

    Pages without the anchor above ``anchor_top``, or without all labels, have no bands.
    """
    at = F.min(F.when((F.col("text") == anchor) & (F.col("top") < anchor_top), F.struct(F.col("top").cast("double").alias("t"), "x0")))["t"]
    y = words.groupBy(*PAGE).agg(at.alias("_y")).where("_y is not null")
    head = words.join(y, PAGE).where(F.abs(F.col("top") - F.col("_y")) <= near)
    edges = [F.min(F.when(F.col("text") == t, F.col("x0").cast("double"))).alias(n) for n, t in labels.items()]
    fy = F.slice(F.array_sort(F.collect_list(F.when((F.col("text") == "FY") & (F.col("x0") > fy_from), F.col("x0").cast("double")))), 1, 4)
    out = head.groupBy(*PAGE).agg(*edges, fy.alias("fy"))
    return out.where(" and ".join(f"`{n}` is not null" for n in labels))


def in_band(words: Column, low: Column, high: Column | None = None) -> Column:
    return F.filter(words, lambda w: (w["x0"] >= low) & (F.lit(True) if high is None else w["x0"] < high))


def joined(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda w: w["text"]), " ")


def _column_amounts(words: Column, fy: Column, last: Column, pattern: str) -> list[Column]:
    """The last amount whose right edge lies under each of four columns (a column ends where the next begins), else 0."""

    def column(i: int) -> Column:
        low, high = F.get(fy, F.lit(i)), F.coalesce(F.get(fy, F.lit(i + 1)), last)
        hit = F.filter(words, lambda w: w["text"].rlike(pattern) & (w["x1"] >= low) & (w["x1"] < high))
        return _money(F.get(hit, F.size(hit) - 1)["text"])

    return [column(i) for i in range(4)]


def _under(w: Column, fy: Column, last: Column) -> Column:
    return (w["x1"] >= F.get(fy, F.lit(0))) & (w["x1"] < last)


def is_centred_caps(ws: Column, centre: Column, from_left: Column, reach: float = 55.0) -> Column:
    """Is a row of words in capitals that stands in the middle of the page, not left of ``from_left``?"""
    lo, hi = F.array_min(F.transform(ws, lambda w: w["x0"])), F.array_max(F.transform(ws, lambda w: w["x1"]))
    return (lo >= from_left) & (F.abs((lo + hi) / 2 - centre) <= reach) & F.forall(ws, lambda w: w["text"].rlike(CAPS_WORD))


CAPITAL_LABELS = {"sub": "SUB", "budget": "BUDGET", "boro": "BORO", "title": "PROJECT", "sponsor": "SPONSOR"}


def _title_codes(title: Column) -> list[Column]:
    plain = F.btrim(F.regexp_replace(title, r"\b[BS][:;]\s*\S+", ""), F.lit(" ,"))
    return [plain.alias("title"), X.last_code(title, "B").alias("building_code"), X.last_code(title, "S").alias("school_code")]


def coordinate_rows(words: DataFrame, width: float) -> DataFrame:
    """(doc, page, y, part, agency, kind, block, ws, bands): the rows of capital tables, classified and placed.

    ``kind`` is total, row, header or more (the continuation of the row before it in its
    block).  Pages without a table head have no rows.  The agency is the last centred
    header; a block ends at a header or total.
    """
    bands = header_bands(words, "BORO", CAPITAL_LABELS, 110.0, 380.0)
    body = page_rows(words.where((F.col("top") > 78) & (F.col("top") < 560)))
    r = body.join(bands, PAGE).join(page_parts(words), PAGE)
    texts = F.transform("ws", lambda w: w["text"])
    r = r.where(~(F.array_contains(texts, "BORO") & (F.array_contains(texts, "SPONSOR") | F.array_contains(texts, "TITLE"))))
    end = F.col("sponsor") - 4
    left = F.exists("ws", lambda w: w["x0"] < F.col("boro") - 6)
    codes = F.size(F.filter("ws", lambda w: w["x0"] < F.col("boro") - 6)) >= 2
    boro = F.exists(in_band(F.col("ws"), F.col("boro") - 6, F.col("title") - 6), lambda w: w["text"].isin(list(BORO_LETTERS)))
    amount = F.exists("ws", lambda w: w["text"].rlike(AMOUNT) & _under(w, F.col("fy"), end))
    head = ~amount & ~left & is_centred_caps(F.col("ws"), F.lit(width / 2), F.col("title") + 54)
    kind = F.when(joined(F.col("ws")).rlike(r"(?i)^TOTALS FOR\s+(.+?)\s+\((\d+)\s+PROJECTS?\)"), "total").when(boro & codes, "row").when(head, "header").otherwise("more")
    r = r.withColumn("kind", kind)
    order = W.partitionBy("doc").orderBy("page", "y").rowsBetween(W.unboundedPreceding, 0)
    r = r.withColumn("agency", F.coalesce(F.last(F.when(F.col("kind") == "header", joined(F.col("ws"))), True).over(order), F.lit("")))
    r = r.withColumn("block", F.sum((F.col("kind") == "row").cast("int")).over(order))
    inside = W.partitionBy("doc", "block").orderBy("page", "y").rowsBetween(W.unboundedPreceding, 0)
    return r.withColumn("_over", F.max(F.col("kind").isin("total", "header").cast("int")).over(inside))


def coordinate_projects(words: DataFrame, width: float) -> DataFrame:
    """(doc, block, part, agency, budget_line, sub_id, boro, fy1..fy4, title, building_code, school_code, sponsor) of capital tables placed by coordinates.

    Amounts are right-aligned: their right edge names the column.  Title and sponsor go on
    over the rows that follow a project.  No words give no projects.
    """
    r = coordinate_rows(words, width).where("block > 0 and _over = 0")
    ws, end = F.col("ws"), F.col("sponsor") - 4
    first = F.col("kind") == "row"
    a = _column_amounts(ws, F.col("fy"), end, AMOUNT)
    no_amount = F.filter(ws, lambda w: ~(w["text"].rlike(AMOUNT) & _under(w, F.col("fy"), end)))
    title = F.when(first, joined(in_band(no_amount, F.col("title") - 6, F.col("sponsor") - 8))).otherwise(joined(in_band(ws, F.col("title") - 6, F.get("fy", F.lit(0)) - 4)))
    boro = F.get(F.filter(in_band(ws, F.col("boro") - 6, F.col("title") - 6), lambda w: w["text"].isin(list(BORO_LETTERS))), F.lit(0))["text"]
    head = F.struct(
        "part", "agency", joined(in_band(ws, F.col("sub") - 4, F.col("budget") - 4)).alias("budget_line"), joined(in_band(ws, F.col("budget") - 4, F.col("boro") - 6)).alias("sub_id"),
        boro.alias("boro"), *(x.alias(f"fy{i + 1}") for i, x in enumerate(a)),
    )
    place = F.struct("page", "y")
    run = lambda c: X.clean(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(place.alias("at"), c.alias("v")))), lambda x: x["v"]), " "))
    g = r.select("doc", "block", "page", "y", F.when(first, head).alias("h"), title.alias("t"), joined(in_band(ws, F.col("sponsor") - 8)).alias("s"))
    g = g.groupBy("doc", "block").agg(F.max("h").alias("h"), run(F.col("t")).alias("_t"), run(F.col("s")).alias("_s"))
    return g.select("doc", "block", "h.*", *_title_codes(F.col("_t")), F.col("_s").alias("sponsor"))


def coordinate_totals(words: DataFrame, width: float) -> DataFrame:
    """(doc, part, agency, projects, fy1): printed subtotals; the grand total (ALL) is left out."""
    p = r"(?i)^TOTALS FOR\s+(.+?)\s+\((\d+)\s+PROJECTS?\)"
    r = coordinate_rows(words, width).where("kind = 'total'")
    line = joined(F.col("ws"))
    out = r.select("doc", "part", F.trim(F.regexp_extract(line, p, 1)).alias("agency"), F.regexp_extract(line, p, 2).cast("int").alias("projects"), _column_amounts(F.col("ws"), F.col("fy"), F.col("sponsor") - 4, AMOUNT)[0].alias("fy1"))
    return out.where(F.upper("agency") != "ALL")


def appropriation_changes(words: DataFrame, columns: Sequence[tuple[str, float]] = CHANGE_COLUMNS, reach: float = 25.0) -> DataFrame:
    """(doc, block, agency, budget_line, fy1..fy4, title, building_code, school_code, action) of blocks of appropriation changes.

    A code at the left edge opens a block; '(CN)' amounts go to the nearest column within
    ``reach``; the actions of a block stand once each, in their order.
    """
    ws = F.col("ws")
    r = page_rows(words.where((F.col("top") > 100) & (F.col("top") < 545)))
    texts = F.transform(ws, lambda w: w["text"])
    r = r.where(~(F.array_contains(texts, "LINE") & F.array_contains(texts, "TITLE")))
    lo = F.array_min(F.transform(ws, lambda w: w["x0"]))
    act = lambda t: t.isin(list(CHANGE_WORDS))
    header = (lo >= 280) & F.forall(texts, lambda t: t.rlike(CAPS_WORD)) & ~F.exists(texts, lambda t: t.rlike(CHANGE) | t.rlike(PLAIN) | act(t) | t.isin("(NEW", "PROJECT)"))
    code = F.get(F.filter(ws, lambda w: (w["x0"] < 90) & w["text"].rlike(LINE_CODE)), F.lit(0))["text"]
    r = r.withColumn("code", F.when(~header, code)).withColumn("head", header)
    order = W.partitionBy("doc").orderBy("page", "y").rowsBetween(W.unboundedPreceding, 0)
    r = r.withColumn("agency", F.coalesce(F.last(F.when(F.col("head"), joined(ws)), True).over(order), F.lit(""))).withColumn("block", F.sum(F.col("code").isNotNull().cast("int")).over(order))
    inside = W.partitionBy("doc", "block").orderBy("page", "y").rowsBetween(W.unboundedPreceding, 0)
    r = r.withColumn("_over", F.max(F.col("head").cast("int")).over(inside)).where("block > 0 and _over = 0")
    changes = F.filter(ws, lambda w: w["text"].rlike(CHANGE))
    paid = F.col("code").isNull() & (F.size(changes) > 0)

    def column(i: int) -> Column:
        gap = lambda w, j: F.abs(w["x1"] - columns[j][1])
        def nearest(w: Column) -> Column:
            ok = gap(w, i) < reach
            for j in range(len(columns)):
                if j != i:
                    ok = ok & ((gap(w, i) < gap(w, j)) if j < i else (gap(w, i) <= gap(w, j)))
            return ok
        hit = F.filter(changes, nearest)
        return F.when(paid & (F.size(hit) > 0), _money(F.get(hit, F.size(hit) - 1)["text"]))

    right = in_band(ws, F.lit(520.0))
    new = F.exists(right, lambda w: w["text"] == "(NEW") & F.col("code").isNull()
    acts = F.concat(F.transform(F.filter(right, lambda w: act(w["text"])), lambda w: w["text"]), F.when(new, F.array(F.lit("NEW PROJECT"))).otherwise(F.array().cast("array<string>")))
    acts = F.when(paid, F.array().cast("array<string>")).otherwise(acts)
    plain = F.filter(in_band(ws, F.lit(90.0), F.lit(520.0)), lambda w: ~w["text"].rlike(CHANGE) & ~w["text"].rlike(PLAIN) & ~(F.col("code").isNull() & w["text"].isin("(NEW", "PROJECT)")))
    title = F.when(paid, F.lit("")).otherwise(joined(plain))
    place = F.struct("page", "y")
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.struct(place.alias("at"), c.alias("v")))), lambda x: x["v"])
    g = r.select("doc", "block", "page", "y", F.when(F.col("code").isNotNull(), F.struct("agency", F.col("code").alias("budget_line"))).alias("h"), *(column(i).alias(n) for i, (n, _) in enumerate(columns)), title.alias("t"), acts.alias("a"))
    g = g.groupBy("doc", "block").agg(
        F.max("h").alias("h"), *(F.coalesce(F.max_by(n, F.when(F.col(n).isNotNull(), place)), F.lit(0)).cast("bigint").alias(n) for n, _ in columns),
        X.clean(F.array_join(ordered(F.col("t")), " ")).alias("_t"), F.array_join(F.array_distinct(F.flatten(ordered(F.col("a")))), ", ").alias("action"),
    )
    return g.select("doc", "block", "h.*", *(n for n, _ in columns), *_title_codes(F.col("_t")), "action")


ENTITY_LABELS = {"line": "BUDGET"}


def entity_rows(words: DataFrame) -> DataFrame:
    """(doc, page, y, kind, entity, organization, code, fy1..fy4): the rows of a table of outside organizations, in order.

    ``kind``: grand (the grand total), entity (a name with dollar totals), line (a budget
    line of the entity above it), wrap (part of the name of the next entity).
    """
    parts = page_parts(words).where("part = 'III'").select(*PAGE)
    bands = header_bands(words, "ORGANIZATION", ENTITY_LABELS, 130.0, 440.0).where("size(fy) = 4")
    r = page_rows(words.where((F.col("top") > 108) & (F.col("top") < 575))).join(bands, PAGE).join(parts, PAGE, "left_semi")
    ws, texts = F.col("ws"), F.transform("ws", lambda w: w["text"])
    grand = joined(ws).contains("TOTAL NON-CITY PROJECT ALLOCATIONS")
    r = r.where(grand | ~(F.array_contains(texts, "ORGANIZATION") | (F.array_contains(texts, "BUDGET") & F.array_contains(texts, "LINE"))))
    edge = F.col("line") - 6
    name, code = F.filter(ws, lambda w: w["x0"] < edge), in_band(ws, edge, F.get("fy", F.lit(0)) - 6)
    dollars = F.exists(texts, lambda t: t.rlike(DOLLARS))
    kind = F.when(grand, "grand").when(dollars & (F.size(name) > 0), "entity").when(F.size(code) > 0, "line").when((F.size(name) > 0) & ~dollars, "wrap")
    last = F.element_at("fy", 4) + 80
    a, d = _column_amounts(ws, F.col("fy"), last, AMOUNT), _column_amounts(ws, F.col("fy"), last, DOLLARS)
    r = r.select(*PAGE, "y", kind.alias("kind"), joined(name).alias("name"), joined(code).alias("code"), *(F.when(kind == "line", a[i]).otherwise(d[i]).alias(f"fy{i + 1}") for i in range(4))).where("kind is not null")
    w = W.partitionBy("doc").orderBy("page", "y")
    own = F.sum((F.col("kind") == "entity").cast("int"))
    r = r.withColumn("entity", own.over(w.rowsBetween(W.unboundedPreceding, 0))).withColumn("_next", F.coalesce(own.over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    names = r.where("kind in ('entity', 'wrap')").groupBy("doc", F.col("_next").alias("_k")).agg(
        F.max((F.col("kind") == "entity").cast("int")).alias("_whole"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "y", "name"))), lambda x: x["name"]), " ").alias("organization")
    ).where("_whole = 1").select("doc", (F.col("_k") + 1).alias("entity"), "organization")
    return r.join(names, ["doc", "entity"], "left").select(*PAGE, "y", "kind", "entity", F.coalesce("organization", F.lit("")).alias("organization"), "code", "fy1", "fy2", "fy3", "fy4")


def entity_crosstab(words: DataFrame) -> DataFrame:
    """(doc, entity, organization, printed, parsed, lines, same): the printed total of each entity against the sum of its lines."""
    r = entity_rows(words).where("kind in ('entity', 'line') and entity > 0")
    of = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("fy1"))), F.lit(0)).cast("bigint")
    g = r.groupBy("doc", "entity", "organization").agg(of("entity").alias("printed"), of("line").alias("parsed"), F.count_if(F.col("kind") == "line").alias("lines"))
    return g.withColumn("same", F.col("printed") == F.col("parsed"))
