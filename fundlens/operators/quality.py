"""Row-level checks: one table of violations, exact counts with small samples, coverage."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundlens.functions import exprs as X

BILLION = 1_000_000_000
FIRST_YEAR, LAST_YEAR = 2005, 2035
#: Words in the member column that are no surnames.
NOT_SURNAMES = ("brooklyn", "bronx", "queens", "manhattan", "staten", "island", "speaker", "citywide", "delegation", "various")


@dataclass(frozen=True)
class TableSpec:
    """What the checks need to know of a table."""

    name: str
    id: str
    required: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    ein: str | None = None
    amounts: tuple[str, ...] = ()
    sign: str | None = None  # positive, nonneg, transparency
    year: str | None = None
    folder_year: str | None = None
    names: tuple[str, ...] = ()
    agency: str | None = None
    extra: dict = field(default_factory=dict)


SPECS = {
    s.name: s
    for s in (
        TableSpec("awards", "award_id", ("category", "initiative", "award_type", "member", "organization", "program", "ein", "amount", "agency", "purpose"), ("fiscal_year", "recorded_at", "loaded_at", "award_id"), "ein", ("amount",), "positive", "fiscal_year", None, ("organization", "program"), None),
        TableSpec("transparency", "action_id", ("resolution", "date", "chart", "fiscal_year", "action", "source", "council_member", "organization", "program", "ein", "amount", "agency", "agy_num", "ua", "purpose", "flags"), ("source_fy", "recorded_at", "loaded_at", "action_id"), "ein", ("amount",), "transparency", "fiscal_year", "source_fy", ("organization", "program"), None),
        TableSpec("capital", "project_id", ("part", "agency", "budget_line", "sub_id", "boro", "fy1", "fy2", "fy3", "fy4", "sponsor", "title", "building_code", "school_code"), ("action", "fiscal_year", "loaded_at", "project_id"), None, ("fy1", "fy2", "fy3", "fy4"), None, "fiscal_year", None, (), "agency"),
    )
}


def header_differences(columns: Sequence[str], spec: TableSpec) -> dict[str, list[str]]:
    """Columns that are missing, and columns that are neither required nor optional; order does not matter."""
    have, need = set(columns), set(spec.required)
    return {"missing": sorted(need - have), "extra": sorted(have - need - set(spec.optional))}


def surnames(*members: DataFrame) -> DataFrame:
    """(surname): last words of four letters or more of member names, in lower case."""
    every = reduce(DataFrame.unionByName, [m.select(F.col(m.columns[0]).alias("m")) for m in members])
    last = F.lower(F.element_at(F.split(F.trim("m"), " +"), -1))
    return every.where(F.coalesce("m", F.lit("")) != "").select(last.alias("surname")).where(F.col("surname").rlike("^[a-z]{4,}$") & ~F.col("surname").isin(list(NOT_SURNAMES))).distinct()


def _checks(s: TableSpec) -> list[tuple[str, str, Column]]:
    out: list[tuple[str, str, Column]] = []
    if s.ein:
        out.append(("malformed_ein", "HARD", (F.coalesce(F.col(s.ein), F.lit("")) != "") & ~X.valid_ein(s.ein)))
    for a in s.amounts:
        out += [("non_numeric_amount", "HARD", X.malformed_amount(a)), ("huge_amount", "SOFT", F.abs(F.col(a)) > BILLION)]
        if s.sign == "positive":
            out += [("zero_amount", "COUNT", F.col(a) == 0), ("negative_amount", "SOFT", F.col(a) < 0)]
        elif s.sign == "nonneg":
            out.append(("negative_amount", "SOFT", F.col(a) < 0))
        elif s.sign == "transparency":
            out.append(("sign_against_action", "SOFT", ((F.col("action") == "designate") & (F.col(a) < 0)) | ((F.col("action") == "rescind") & (F.col(a) > 0))))
    if s.year:
        y = F.col(s.year)
        out += [("year_out_of_range", "SOFT", ~y.between(FIRST_YEAR, LAST_YEAR)), ("year_empty", "COUNT", y.isNull())]
        if s.folder_year:
            f = F.col(s.folder_year)
            out += [("year_after_document", "SOFT", y > f + 1), ("prior_year", "COUNT", y < f)]
    if s.agency:
        out.append(("digit_in_agency", "SOFT", F.col(s.agency).rlike("[0-9]")))
    return out


def violations(df: DataFrame, spec: TableSpec, members: DataFrame | None = None) -> DataFrame:
    """(table_name, row_id, check, severity): one row per row and check that fails; one scan of ``df``.

    ``members`` are surnames; a name column that begins with one has bled over from the
    member column, and is reported once a row.
    """
    hit = [F.when(c, F.struct(F.lit(n).alias("check"), F.lit(sev).alias("severity"))) for n, sev, c in _checks(spec)]
    if members is not None and spec.names:
        first = lambda c: F.lower(F.btrim(F.get(F.split(F.trim(F.coalesce(F.col(c), F.lit(""))), " +"), F.lit(0)), F.lit(".,")))
        many = lambda c: F.size(F.split(F.trim(F.coalesce(F.col(c), F.lit(""))), " +")) > 1
        for i, c in enumerate(spec.names):
            m = members.select(F.col("surname").alias(f"_s{i}"))
            df = df.join(m, first(c) == F.col(f"_s{i}"), "left")
        bled = reduce(lambda x, y: x | y, [F.col(f"_s{i}").isNotNull() & many(c) for i, c in enumerate(spec.names)])
        hit.append(F.when(bled, F.struct(F.lit("column_bleed").alias("check"), F.lit("SOFT").alias("severity"))))
    found = df.select(F.col(spec.id).alias("row_id"), F.explode(F.array_distinct(F.array_compact(F.array(*hit)))).alias("v"))
    return found.select(F.lit(spec.name).alias("table_name"), "row_id", "v.check", "v.severity")


def summary(found: DataFrame, sample: int = 3) -> DataFrame:
    """(table_name, check, severity, n, sample): exact counts and the smallest ids.

    Counts combine before the shuffle.  Of the ids each task hands on the ``sample``
    smallest of each check only (a window with a rank limit), so no check is ever gathered.
    """
    by = ["table_name", "check", "severity"]
    n = found.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    top = found.withColumn("_r", F.row_number().over(W.partitionBy(*by).orderBy("row_id"))).where(F.col("_r") <= sample)
    ids = top.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list("row_id")).cast("array<string>"), ",").alias("sample"))
    return n.join(ids, by)


def duplicate_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(columns, copies): rows that stand more than once, counted in full."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def duplicate_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the number of surplus rows and of groups."""
    return duplicate_rows(df, columns).agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("surplus"), F.count(F.lit(1)).alias("groups"))


def ein_coverage(df: DataFrame, year: str, ein: str = "ein") -> DataFrame:
    """(year, valid, rows, share) of rows with a sound EIN."""
    return df.groupBy(year).agg(F.count_if(X.valid_ein(ein)).alias("valid"), F.count(F.lit(1)).alias("rows")).withColumn("share", F.round(F.col("valid") / F.col("rows"), 6))


def text_confidence(df: DataFrame, text: str, by: str) -> DataFrame:
    """(by, glued, rows, share, band): how much of a group's text has lost its blanks."""
    g = df.groupBy(by).agg(F.count_if(X.is_glued(text)).alias("glued"), F.count(F.lit(1)).alias("rows"))
    return g.withColumn("share", F.round(F.col("glued") / F.col("rows"), 6)).withColumn("band", X.confidence_band("share"))


def has_hard(found: DataFrame) -> bool:
    return not found.where("severity = 'HARD'").isEmpty()


def report(summary_rows: list) -> str:
    """A pipe table of the (small) summary."""
    lines = ["| table | check | severity | rows | sample |", "|---|---|---|--:|---|"]
    return "\n".join([*lines, *(f"| {r.table_name} | {r.check} | {r.severity} | {r.n:,} | {r.sample} |" for r in sorted(summary_rows, key=lambda r: (r.table_name, r.severity, r.check)))])
