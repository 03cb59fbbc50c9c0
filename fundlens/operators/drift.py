"""Schemas that drift between files: one consistent table, and a report of each change.

Every file of a series is reduced, by plain aggregates, to one profile row per column
(JSON type, text statistics, MinHash signatures of values and of value shapes).  A file
is compared with the one before it.  Columns of equal name correspond; where columns
vanished and others appeared at once, the two schemas are matched by similarity flooding:
a graph of tables, columns, types, name tokens and value shapes for each side, match
scores propagated over the product graph until they settle, and a consistent choice of
pairs by descending score.
"""

from __future__ import annotations

import re
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundlens.operators.closure import MAX_NAME_LINKS, resolve_names
from fundlens.session import broadcast_if_small

#: Parameters of the matcher.
VALUE_HASHES, SHAPE_HASHES = 12, 6
MAX_STEPS, EPSILON = 60, 1e-3
MIN_SCORE = 0.45  # direct similarity a renamed pair must have
MIN_RELATIVE = 0.5  # flooded score against the best partner of either column

FILE = ["dataset", "series", "file_seq"]

#: Masks of the signatures: multiples of the golden ratio in 63 bits.
_MASKS = [(i + 1) * 0x9E3779B97F4A7C15 % (1 << 63) for i in range(max(VALUE_HASHES, SHAPE_HASHES))]


def exploded(feed: DataFrame) -> DataFrame:
    """(FILE, row_no, column_name, kind, value): one row per key of every record.

    ``kind`` is the JSON type (integer, decimal, text, list, boolean, object; null for a
    null).  A record that is null or no JSON object has no keys.  ``value`` is the text of
    the value; of a list, its elements joined by commas.  The keys of an object within a
    record are columns of their own, named ``outer.inner``, beside the object itself.
    """
    cols = [*FILE, "feed_id", "row_no"]
    v = feed.select(*cols, "record").withColumn("_v", F.try_parse_json("record")).where("schema_of_variant(_v) like 'OBJECT%'")
    tvf = v.sparkSession.tvf
    e = v.lateralJoin(tvf.variant_explode(F.col("_v").outer())).select(*cols, F.col("key").alias("column_name"), F.col("value").alias("_x"))
    nested = v.where(F.col("record").rlike(r':\s*\{'))  # only such records are taken apart again
    inner = nested.lateralJoin(tvf.variant_explode(F.col("_v").outer())).select(*cols, F.col("key").alias("_outer"), F.col("value").alias("_w")).where("schema_of_variant(_w) like 'OBJECT%'")
    inner = inner.lateralJoin(tvf.variant_explode(F.col("_w").outer())).select(*cols, F.concat_ws(".", "_outer", "key").alias("column_name"), F.col("value").alias("_x"))
    e = e.unionByName(inner)
    t = F.schema_of_variant("_x")
    kind = (
        F.when(t == "VOID", None).when(t == "BOOLEAN", "boolean").when(t == "STRING", "text").when(t.startswith("ARRAY"), "list")
        .when(t.startswith("OBJECT"), "object").when(t.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "decimal").otherwise("integer")
    )
    text = F.when(kind == "list", F.regexp_replace(F.to_json("_x"), r'^\[|\]$|"', "")).when(kind.isNotNull(), F.expr("try_variant_get(_x, '$', 'string')"))
    return e.select(*cols, "column_name", kind.alias("kind"), text.alias("value"))


#: JSON types by rank: of a column with values of several in one file the widest counts.
KINDS = ("boolean", "integer", "decimal", "text", "list", "object")


def file_profiles(cells: DataFrame) -> DataFrame:
    """One row per column of a file.  All aggregates are numbers of fixed size, so they combine in hash maps before the shuffle.

    A value is hashed once; the signatures are minima of that hash under fixed masks.
    """
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace("value", "[0-9]", "9"), r"\p{L}", "a"), "(.)\\1{3,}", "$1$1$1+")
    some = F.col("value") != ""
    digits = F.length(F.regexp_replace("value", "[^0-9]", "")) / F.length("value")
    rank = F.coalesce(*(F.when(F.col("kind") == k, i) for i, k in enumerate(KINDS)))
    c = cells.select(*FILE, "column_name", rank.alias("_k"), F.when(some, F.length("value")).alias("_l"), F.when(some, digits).alias("_d"), F.when(some, F.xxhash64("value")).alias("_v"), F.when(some, F.xxhash64(shape)).alias("_s"))
    sig = lambda col, n: [F.min(F.col(col).bitwiseXOR(F.lit(_MASKS[i]))).alias(f"{col}{i}") for i in range(n)]
    g = c.groupBy(*FILE, "column_name").agg(F.max("_k").alias("_k"), F.avg("_l").alias("len"), F.avg("_d").alias("digits"), *sig("_v", VALUE_HASHES), *sig("_s", SHAPE_HASHES))
    kind = F.get(F.array(*(F.lit(k) for k in KINDS)), F.col("_k"))
    of = lambda col, n: F.array(*(f"{col}{i}" for i in range(n)))
    return g.select(*FILE, "column_name", kind.alias("kind"), "len", "digits", of("_v", VALUE_HASHES).alias("vsig"), of("_s", SHAPE_HASHES).alias("ssig"))


def _carried(p: DataFrame) -> DataFrame:
    """A column that is null throughout a file keeps the profile it last had in the series."""
    w = W.partitionBy("dataset", "series", "column_name").orderBy("file_seq").rowsBetween(W.unboundedPreceding, 0)
    prof = F.when(F.col("kind").isNotNull(), F.struct("kind", "len", "digits", "vsig", "ssig"))
    return p.select(*FILE, "column_name", F.last(prof, ignorenulls=True).over(w).alias("p"))


# ------------------------------------------------------------------ similarity flooding


def name_tokens(name: str) -> list[str]:
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", " ", name)
    return [t for t in re.split(r"[^0-9a-z]+", spaced.lower()) if t]


@lru_cache(1 << 16)
def _token_sim(a: str, b: str) -> float:
    if a == b:
        return 1.0
    short, long = sorted((a, b), key=len)
    if len(short) >= 3 and long.startswith(short):
        return 0.9
    g = lambda s: {f" {s} "[i : i + 3] for i in range(len(s))}
    return len(g(a) & g(b)) / len(g(a) | g(b))


@lru_cache(1 << 16)
def name_similarity(a: str, b: str) -> float:
    ta, tb = name_tokens(a), name_tokens(b)
    if not ta or not tb:
        return 0.0
    few, many = sorted((ta, tb), key=len)
    best = sum(max(_token_sim(x, y) for y in many) for x in few)
    return 0.5 * best / len(few) + 0.5 * 2 * best / (len(ta) + len(tb))


def value_similarity(p, q) -> float | None:
    """Of two profiles; None if one has no values."""
    if p is None or q is None or p["len"] is None or q["len"] is None or pd.isna(p["len"]) or pd.isna(q["len"]):
        return None
    same = lambda k: sum(x == y for x, y in zip(p[k], q[k])) / len(p[k])
    stats = min(p["len"], q["len"]) / max(p["len"], q["len"]) * (1 - abs(p["digits"] - q["digits"]))
    return min(1.0, max(0.0, 0.4 * stats + 0.6 * max(same("vsig"), same("ssig"))))


def direct_similarity(a: str, p, b: str, q) -> float:
    name, value = name_similarity(a, b), value_similarity(p, q)
    if value is None:
        return name * 0.7
    kinds = 1.0 if p["kind"] == q["kind"] else 0.85 if {p["kind"], q["kind"]} <= {"integer", "decimal", "text", "list"} else 0.0
    return kinds * (0.5 * name + 0.5 * value)


def _graph(columns: dict[str, object]) -> dict[str, set[tuple[str, str]]]:
    edges: dict[str, set[tuple[str, str]]] = defaultdict(set)
    for name, p in columns.items():
        c = f"column:{name}"
        outer, _, inner = name.rpartition(".")
        edges["nested" if outer else "column"].add((f"column:{outer}" if outer else "table", c))
        for t in name_tokens(inner):
            edges["token"].add((c, f"token:{t}"))
        if p is not None:
            edges["type"].add((c, f"type:{p['kind']}"))
            edges["size"].add((c, f"size:{int(np.log2(1 + p['len'])) if p['len'] == p['len'] and p['len'] is not None else 'none'}"))
            edges["digits"].add((c, f"digits:{round(2 * p['digits']) if p['digits'] == p['digits'] and p['digits'] is not None else 'none'}"))
    return edges


def flood(old: dict[str, object], new: dict[str, object]) -> dict[tuple[str, str], float]:
    """Settled match scores of all column pairs of two schemas (column name -> profile)."""
    ga, gb = _graph(old), _graph(new)
    index: dict[tuple[str, str], int] = {}
    of = lambda x, y: index.setdefault((x, y), len(index))
    src, dst, weight = [], [], []
    for label in ga:
        out_a, out_b, in_a, in_b = (defaultdict(int) for _ in range(4))
        for x, y in ga[label]:
            out_a[x] += 1
            in_a[y] += 1
        for x, y in gb[label]:
            out_b[x] += 1
            in_b[y] += 1
        for x1, y1 in ga[label]:
            for x2, y2 in gb[label]:
                i, j = of(x1, x2), of(y1, y2)
                src += [i, j]
                dst += [j, i]
                weight += [1 / (out_a[x1] * out_b[x2]), 1 / (in_a[y1] * in_b[y2])]
    for x, y in ((f"column:{a}", f"column:{b}") for a in old for b in new):
        of(x, y)
    start = np.zeros(len(index))
    for (x, y), i in index.items():
        kind, _, a = x.partition(":")
        b = y.partition(":")[2]
        if kind == "column":
            start[i] = direct_similarity(a, old[a], b, new[b])
        elif kind == "token":
            start[i] = _token_sim(a, b)
        else:
            start[i] = float(x == y)
    src, dst, weight = np.array(src, int), np.array(dst, int), np.array(weight)
    now = start
    for _ in range(MAX_STEPS):
        base = start + now
        nxt = base + np.bincount(dst, weights=weight * base[src], minlength=len(base))
        nxt /= nxt.max() or 1
        if np.linalg.norm(nxt - now) < EPSILON:
            now = nxt
            break
        now = nxt
    return {(x[7:], y[7:]): now[i] for (x, y), i in index.items() if x.startswith("column:")}


def match_schemas(old: dict[str, object], new: dict[str, object]) -> list[tuple[str, str]]:
    """Renamed pairs among the columns only in ``old`` and those only in ``new``."""
    gone, come = set(old) - set(new), set(new) - set(old)
    if not gone or not come:
        return []
    scores = {k: s for k, s in flood(old, new).items() if k[0] in gone and k[1] in come}
    best: dict[tuple[int, str], float] = defaultdict(float)
    for (a, b), s in scores.items():
        best[0, a] = max(best[0, a], s)
        best[1, b] = max(best[1, b], s)
    out, used_a, used_b = [], set(), set()
    # the settled score decides which pairs go together; that a pair is alike at all is asked of the pair itself
    for a, b in sorted(scores, key=lambda k: (-scores[k], k)):
        if a in used_a or b in used_b or scores[a, b] < MIN_RELATIVE * max(best[0, a], best[1, b]):
            continue
        if direct_similarity(a, old[a], b, new[b]) < MIN_SCORE:
            continue
        out.append((a, b))
        used_a.add(a)
        used_b.add(b)
    return out


# ------------------------------------------------------------------ report and union


def _pairs(feed: DataFrame) -> DataFrame:
    """(FILE, column_name, old, new): the columns of each file beside those of the file before it."""
    files = feed.select(*FILE).distinct()
    w = W.partitionBy("dataset", "series").orderBy("file_seq")
    files = files.withColumn("next_seq", F.lead("file_seq").over(w)).withColumn("first", F.lag("file_seq").over(w).isNull())
    p = _carried(file_profiles(exploded(feed))).join(files, FILE)
    old = p.where("next_seq is not null").select("dataset", "series", F.col("next_seq").alias("file_seq"), "column_name", F.col("p").alias("old"), F.lit(True).alias("in_old"), F.lit(None).cast(p.schema["p"].dataType).alias("new"), F.lit(False).alias("in_new"))
    new = p.where("not first").select(*FILE, "column_name", F.lit(None).cast(p.schema["p"].dataType).alias("old"), F.lit(False).alias("in_old"), F.col("p").alias("new"), F.lit(True).alias("in_new"))
    both = old.unionByName(new).groupBy(*FILE, "column_name").agg(F.max("in_old").alias("in_old"), F.max("in_new").alias("in_new"), F.first("old", True).alias("old"), F.first("new", True).alias("new"))
    return both


def _match_group(pdf: pd.DataFrame) -> pd.DataFrame:
    old = {r.column_name: r.old for r in pdf.itertuples() if r.in_old}
    new = {r.column_name: r.new for r in pdf.itertuples() if r.in_new}
    plain = lambda p: None if p is None else p if isinstance(p, dict) else p.asDict()
    pairs = match_schemas({k: plain(p) for k, p in old.items()}, {k: plain(p) for k, p in new.items()})
    key = pdf.iloc[0]
    return pd.DataFrame([(key.dataset, key.series, key.file_seq, a, b) for a, b in pairs], columns=[*FILE, "old_name", "new_name"])


def all_changes(feed: DataFrame) -> DataFrame:
    """(FILE, column_name, change, old_name): every change of a file against the file before it in its series.

    Tables, series and files may be empty; a series of one file has no change.  Null and
    repeated records add nothing.  A column that is null throughout a file counts as
    present with the type it last had.  The unit of work in Python is one pair of schemas,
    never the records of a file.
    """
    p = _pairs(feed)
    w = W.partitionBy(*FILE)
    p = p.withColumn("both", F.max(F.col("in_old") & ~F.col("in_new")).over(w) & F.max(F.col("in_new") & ~F.col("in_old")).over(w))
    renamed = p.where("both").select(*FILE, "column_name", "in_old", "in_new", "old", "new").groupBy(*FILE).applyInPandas(_match_group, "dataset string, series string, file_seq int, old_name string, new_name string")
    names = renamed.select(*FILE, F.explode(F.array(F.struct(F.col("old_name").alias("column_name"), F.lit("").alias("m"), F.lit(None).cast("string").alias("old_name")), F.struct(F.col("new_name").alias("column_name"), F.lit("renamed").alias("m"), F.col("old_name")))).alias("x")).select(*FILE, "x.*")
    q = p.drop("both").join(names, [*FILE, "column_name"], "left")
    change = (
        F.when(F.col("m") == "renamed", "renamed")
        .when(F.col("m") == "", F.lit(None))
        .when(~F.col("in_old"), "added")
        .when(~F.col("in_new"), "removed")
        .when(F.col("old.kind") != F.col("new.kind"), "retyped")
    )
    return q.withColumn("change", change).where("change is not null").select(*FILE, "column_name", "change", "old_name")


def column_changes(feed: DataFrame) -> DataFrame:
    return all_changes(feed).select("series", "file_seq", "column_name", "change")


#: The one table per dataset: target column and type.
TARGET = {
    "capital": {"part": "string", "agency": "string", "budget_line": "string", "sub_id": "string", "boro": "string", "fy1": "bigint", "fy2": "bigint", "sponsor": "string", "title": "string", "action": "string"},
    "terms": {"item_number": "string", "agency_name": "string", "units_of_appropriation": "string", "num_units": "double", "report_deadlines": "string", "coverage_period": "string", "condition_text": "string"},
}


def rename_links(feed: DataFrame, dataset: str) -> DataFrame:
    """(a, b, n): in how many files of a dataset column name a became b; one row per distinct pair of names."""
    links = all_changes(feed.where(F.col("dataset") == dataset)).where("change = 'renamed'").select(F.col("old_name").alias("a"), F.col("column_name").alias("b"))
    return links.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def consistent_table(feed: DataFrame, dataset: str) -> DataFrame:
    """All records of ``dataset`` in one table: feed_id, series, file_seq, row_no, the target columns, and ``other`` (the rest as a map).

    Renames found between files link column names; a name takes the target it is linked to
    over any number of renames.
    A value that does not cast to its target's type is null there and kept in ``other``; so
    is a second value, where two columns of one record come to one target (the column that
    bears the target's name is the first, else the name that comes first).
    """
    target = TARGET[dataset]
    own = feed.where(F.col("dataset") == dataset)
    cells = exploded(own)
    names = resolve_names(rename_links(feed, dataset), list(target))
    j = cells.join(broadcast_if_small(names, MAX_NAME_LINKS), "column_name", "left").withColumn("target", F.coalesce("target", F.when(F.col("column_name").isin(list(target)), F.col("column_name"))))
    cast = {c: F.expr(f"try_cast(value AS {t})") for c, t in target.items()}
    fits = F.coalesce(*(F.when(F.col("target") == c, cast[c].isNotNull()) for c in target), F.lit(False))
    order = F.struct((F.col("column_name") != F.col("target")).alias("o"), F.col("column_name").alias("c"))
    firsts = [F.min(F.when((F.col("target") == c) & fits, F.struct(order.alias("order"), cast[c].alias("v")))).alias(c) for c in target]
    cells = F.collect_list(F.when(F.col("value").isNotNull(), F.struct("column_name", "value", F.when(fits, F.col("target")).alias("t"))))
    wide = j.groupBy("feed_id").agg(*firsts, cells.alias("_cells"))
    taken = lambda x: F.coalesce(*(F.when(x["t"] == c, F.col(c)["order"]["c"] == x["column_name"]) for c in target), F.lit(False))
    rest = F.transform(F.array_sort(F.filter("_cells", lambda x: ~taken(x))), lambda x: F.struct(x["column_name"].alias("key"), x["value"].alias("value")))
    wide = wide.withColumn("other", F.to_json(F.map_from_entries(rest))).select("feed_id", *(F.col(c)["v"].alias(c) for c in target), "other")
    return own.select("feed_id", "series", "file_seq", "row_no").join(wide, "feed_id", "left")
