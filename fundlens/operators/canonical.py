"""Cross-year roll-up, canonical names and name-collision analytics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundlens.functions import exprs as X


def one_per_key(xw: DataFrame, keys: list[str], value: str) -> DataFrame:
    """A lookup table: the filled value of each key; the smallest if a key was settled in several ways."""
    return xw.where(F.coalesce(F.col(value), F.lit("")) != "").groupBy(*keys).agg(F.min(value).alias(value))


def with_canonical_initiative(df: DataFrame, xw: DataFrame, min_confidence: tuple[str, ...] | None = None) -> DataFrame:
    """``df`` with ``initiative_canonical``: the settled name, else the house style of the raw one."""
    if min_confidence:
        xw = xw.where(F.col("confidence").isin(list(min_confidence)))
    look = one_per_key(xw, ["raw_initiative"], "initiative_canonical")
    j = df.join(look, df["initiative"] == look["raw_initiative"], "left").drop("raw_initiative")
    return j.withColumn("initiative_canonical", F.coalesce("initiative_canonical", X.house_style("initiative")))


def with_canonical_category(df: DataFrame, xw: DataFrame) -> DataFrame:
    """``df`` with ``category_canonical``: a split rule for (category, initiative), else the rule of the category, else the raw one."""
    xw = xw.withColumn("initiative", F.coalesce("initiative", F.lit("")))
    split = one_per_key(xw.where("initiative <> ''"), ["raw_category", "initiative"], "category_canonical").select(F.col("raw_category").alias("_c"), F.col("initiative").alias("_i"), F.col("category_canonical").alias("_split"))
    rule = one_per_key(xw.where("initiative = ''"), ["raw_category"], "category_canonical").select(F.col("raw_category").alias("_r"), F.col("category_canonical").alias("_rule"))
    j = df.join(split, (df["category"] == F.col("_c")) & (df["initiative"] == F.col("_i")), "left").join(rule, df["category"] == F.col("_r"), "left")
    return j.withColumn("category_canonical", F.coalesce("_split", "_rule", "category")).drop("_c", "_i", "_r", "_split", "_rule")


def after(columns: list[str], **new: str) -> list[str]:
    """``columns`` with each new name right after its source column."""
    out = []
    for c in columns:
        out += [c, *(n for n, src in new.items() if src == c)]
    return out


def combined(parts: list[DataFrame], initiative_xw: DataFrame, category_xw: DataFrame) -> DataFrame:
    """All years in one table, duplicates kept, canonical columns right after their sources."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    out = with_canonical_category(with_canonical_initiative(every, initiative_xw), category_xw)
    return out.select(after(every.columns, category_canonical="category", initiative_canonical="initiative"))


def variant_stats(df: DataFrame, name: str, year: str = "fiscal_year", amount: str = "amount") -> DataFrame:
    """(variant, years, amount, n) per distinct spelling."""
    d = df.where(F.col(name) != "")
    return d.groupBy(F.col(name).alias("variant")).agg(F.array_sort(F.collect_set(year)).alias("years"), F.sum(F.coalesce(F.col(amount), F.lit(0))).cast("bigint").alias("amount"), F.count(F.lit(1)).alias("n"))


def collision_groups(stats: DataFrame, norm: Column) -> DataFrame:
    """(norm, variants, amount, n, overlap): spellings with one normal form, where there are several.

    ``overlap`` tells whether two of them occur in one year.
    """
    s = stats.withColumn("norm", norm)
    y = s.select("norm", F.explode("years").alias("y")).groupBy("norm", "y").agg(F.count(F.lit(1)).alias("k")).groupBy("norm").agg((F.max("k") > 1).alias("overlap"))
    g = s.groupBy("norm").agg(F.count(F.lit(1)).alias("variants"), F.sum("amount").cast("bigint").alias("amount"), F.sum("n").cast("bigint").alias("n")).where("variants > 1")
    return g.join(y, "norm", "left")


def aggressive_only(stats: DataFrame, mild: Column, strong: Column) -> DataFrame:
    """Groups of the strong form that no group of the mild form explains: they span several mild forms."""
    s = stats.withColumn("norm", strong).withColumn("mild", mild)
    return s.groupBy("norm").agg(F.count(F.lit(1)).alias("variants"), F.countDistinct("mild").alias("forms"), F.sum("amount").cast("bigint").alias("amount")).where("forms > 1")


def dominant_spelling(stats: DataFrame, norm: Column) -> DataFrame:
    """(norm, dominant, casing_only): the spelling with most dollars, mixed case before capitals; does the group differ in case only?"""
    s = stats.withColumn("norm", norm).withColumn("caps", F.col("variant") == F.upper("variant"))
    w = W.partitionBy("norm").orderBy("caps", F.desc("amount"), "variant")
    top = s.withColumn("r", F.row_number().over(w)).where("r = 1").select("norm", F.col("variant").alias("dominant"))
    case = s.groupBy("norm").agg((F.countDistinct(F.lower("variant")) == 1).alias("casing_only"))
    return top.join(case, "norm")


def mode_per_group(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """(key, value): the most frequent value of a group; of equally frequent ones the one seen first by ``order``."""
    n = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("c"), F.min(order).alias("o"))
    w = W.partitionBy(key).orderBy(F.desc("c"), "o")
    return n.withColumn("r", F.row_number().over(w)).where("r = 1").select(key, value)


def backfill_by_key(df: DataFrame, key: str, value: str, order: str, bad: Column) -> DataFrame:
    """``df`` with bad values replaced by the mode of the good ones of the same key, if there is one."""
    good = df.where(~bad & (F.col(key) != ""))
    mode = mode_per_group(good, key, value, order).withColumnRenamed(value, "_mode")
    j = df.join(mode, key, "left")
    return j.withColumn(value, F.when(bad, F.coalesce("_mode", F.col(value))).otherwise(F.col(value))).drop("_mode")


def set_overlap(df: DataFrame, group: str, member: str, min_shared: int = 1) -> DataFrame:
    """(a, b, shared, containment, jaccard): how far two groups share members.

    Distinct members of a group are counted first.  A member in very many groups gives
    many pairs of groups, never of rows.
    """
    g = df.where((F.col(group) != "") & (F.col(member) != "")).select(F.col(group).alias("g"), F.col(member).alias("m")).distinct()
    size = g.groupBy("g").agg(F.count(F.lit(1)).alias("size"))
    a, b = g.select(F.col("g").alias("a"), "m"), g.select(F.col("g").alias("b"), "m")
    shared = a.join(b, "m").where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= min_shared)
    j = shared.join(size.select(F.col("g").alias("a"), F.col("size").alias("sa")), "a").join(size.select(F.col("g").alias("b"), F.col("size").alias("sb")), "b")
    return j.select("a", "b", "shared", F.round(F.col("shared") / F.least("sa", "sb"), 6).alias("containment"), F.round(F.col("shared") / (F.col("sa") + F.col("sb") - F.col("shared")), 6).alias("jaccard"))
