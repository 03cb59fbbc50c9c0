"""The parameterised query API: strict arguments, filters, sort, limit, summaries.

A request is checked against a ``Tool`` before anything is planned.  The rows of a
request are one DataFrame with a total order; the summary adds up the returned rows, as
callers of the API see them, and the totals over all matches beside that.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.functions import exprs as X

DEFAULT_LIMIT, MAX_LIMIT = 50, 500
ACTIONS = ("designate", "rescind", "purpose_change")
#: Guessed parameter names and what they may mean.
ALIASES = {"district": ("council_member", "sponsor"), "council_district": ("council_member", "sponsor"), "query": ("organization", "program", "title", "agency")}
LOW_CONFIDENCE_YEARS = (2010, 2011, 2012, 2013)


class QueryError(ValueError):
    """A request that can't be planned; the message is for the caller."""


def cap(limit: float | None, default: int = DEFAULT_LIMIT, most: int = MAX_LIMIT) -> int:
    if limit is None or (isinstance(limit, float) and math.isnan(limit)):
        return default
    return min(max(1, int(limit)), most)


@dataclass(frozen=True)
class Tool:
    name: str
    params: dict[str, type]
    required: tuple[str, ...] = ()
    enums: tuple[tuple[str, tuple[str, ...]], ...] = ()
    one_of: tuple[str, ...] = ()

    def parse(self, args: dict) -> dict:
        """Checked arguments; unknown, missing, mistyped or out-of-range ones raise ``QueryError``."""
        for name in args:
            if name not in self.params:
                hints = [p for p in ALIASES.get(name, ()) if p in self.params]
                hint = f" Did you mean {' or '.join(f'`{h}`' for h in hints)}?" if hints else ""
                raise QueryError(f"{self.name} does not accept `{name}`. Accepted parameters: {', '.join(self.params)}.{hint}")
        out = {}
        for name, kind in self.params.items():
            v = args.get(name)
            if v is None:
                if name in self.required:
                    raise QueryError(f"{self.name} needs `{name}`.")
            elif kind is int and (isinstance(v, bool) or not isinstance(v, int)):
                raise QueryError(f"`{name}` must be an integer.")
            elif kind is str and not isinstance(v, str):
                raise QueryError(f"`{name}` must be a text.")
            out[name] = v
        for name, allowed in self.enums:
            if out[name] is not None and out[name] not in allowed:
                raise QueryError(f"`{name}` must be one of {', '.join(allowed)}.")
        if self.one_of and all(out[n] in (None, "") for n in self.one_of):
            raise QueryError(f"{self.name} needs at least one of {', '.join(self.one_of)}.")
        return out


TOOLS = {
    t.name: t
    for t in (
        Tool("search_awards", {"ein": str, "organization": str, "program": str, "council_member": str, "fiscal_year": int, "category": str, "initiative": str, "limit": int}),
        Tool("get_awards_by_ein", {"ein": str, "fiscal_year": int}, ("ein",)),
        Tool("search_transparency_resolutions", {"ein": str, "council_member": str, "fiscal_year": int, "action": str, "organization": str, "limit": int}, enums=(("action", ACTIONS),)),
        Tool("get_legislation_link", {"fiscal_year": int, "document_type": str, "local_file": str}, one_of=("fiscal_year", "document_type", "local_file")),
        Tool("search_capital_projects", {"agency": str, "fiscal_year": int, "sponsor": str, "title": str, "part": str, "limit": int}),
        Tool("get_terms_conditions", {"fiscal_year": int, "agency": str, "limit": int}),
        Tool("list_available_fiscal_years", {}),
    )
}


def _ordered(df: DataFrame, *first: Column) -> DataFrame:
    """By ``first``, then by every other column, so that equal rows alone can tie."""
    return df.orderBy(*first, *(F.col(c).asc_nulls_first() for c in df.columns))


def _asc(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_first() for n in names]


def _desc(name: str) -> Column:
    return F.col(name).desc_nulls_last()


def search_awards(awards: DataFrame, **args) -> DataFrame:
    """Awards by any of EIN, organization, program, member, year, category and initiative; by year, member and falling amount."""
    a = TOOLS["search_awards"].parse(args)
    rows = awards.where(X.all_of(
        X.ein_equals("ein", a["ein"]), X.like_nocase("organization", a["organization"]), X.like_nocase("program", a["program"]), X.like_nocase("member", a["council_member"]),
        X.equals("fiscal_year", a["fiscal_year"]), X.like_nocase("category", a["category"]), X.like_nocase("initiative", a["initiative"]),
    ))
    return _ordered(rows, *_asc("fiscal_year", "member"), _desc("amount")).limit(cap(a["limit"]))


def awards_by_ein(awards: DataFrame, **args) -> DataFrame:
    """Every award of an EIN; an empty EIN finds the awards without one."""
    a = TOOLS["get_awards_by_ein"].parse(args)
    return awards.where(X.all_of(X.norm_ein("ein") == X.norm_ein(F.lit(a["ein"])), X.equals("fiscal_year", a["fiscal_year"])))


def year_summary(rows: DataFrame, year: str = "fiscal_year", amount: str = "amount") -> DataFrame:
    """(year, n, total) with null amounts as 0."""
    return rows.groupBy(year).agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.col(amount), F.lit(0))).cast("bigint").alias("total"))


def names_on_ein(awards: DataFrame, order: str) -> DataFrame:
    """(ein, organizations): distinct names in the order they first appear, joined by '; '.

    The distinct (ein, name) pairs are found by a combining aggregate first, so an EIN on
    very many rows reaches its task as its distinct names only.
    """
    e = X.norm_ein("ein").alias("ein")
    first = awards.where("organization <> ''").groupBy(e, "organization").agg(F.min(order).alias("o")).where("ein <> ''")
    names = F.transform(F.array_sort(F.collect_list(F.struct("o", "organization"))), lambda x: x["organization"])
    return first.groupBy("ein").agg(F.array_join(names, "; ").alias("organizations"))


def search_transparency(t: DataFrame, **args) -> DataFrame:
    """Resolution rows; ``fiscal_year`` filters the year of the document.  Resolution numbers sort as text."""
    a = TOOLS["search_transparency_resolutions"].parse(args)
    rows = t.where(X.all_of(
        X.ein_equals("ein", a["ein"]), X.like_nocase("council_member", a["council_member"]), X.equals("source_fy", a["fiscal_year"]),
        X.equals_nocase("action", a["action"]), X.like_nocase("organization", a["organization"]),
    ))
    low = F.col("source_fy").isin(list(LOW_CONFIDENCE_YEARS)).cast("int").alias("low_text_confidence")
    rows = rows.select("resolution", "date", "chart", "fiscal_year", "action", "council_member", "organization", "program", "ein", "amount", "agency", "purpose", "source_fy", low)
    return _ordered(rows, *_asc("source_fy", "resolution", "chart")).limit(cap(a["limit"]))


def search_capital(c: DataFrame, **args) -> DataFrame:
    """Capital projects; without ``part`` a project listed again in another part appears again."""
    a = TOOLS["search_capital_projects"].parse(args)
    rows = c.where(X.all_of(
        X.like_nocase("agency", a["agency"]), X.equals("fiscal_year", a["fiscal_year"]), X.like_nocase("sponsor", a["sponsor"]),
        X.like_nocase("title", a["title"]), X.equals_nocase("part", a["part"]),
    ))
    rows = rows.select("fiscal_year", "agency", "budget_line", "sub_id", "boro", "fy1", "sponsor", "title")
    return _ordered(rows, *_asc("fiscal_year", "agency"), _desc("fy1")).limit(cap(a["limit"]))


def terms_conditions(t: DataFrame, **args) -> DataFrame:
    a = TOOLS["get_terms_conditions"].parse(args)
    rows = t.where(X.all_of(X.equals("fiscal_year", a["fiscal_year"]), X.like_nocase("agency_name", a["agency"])))
    rows = rows.select("fiscal_year", "item_number", "agency_name", "agency_code", "units_of_appropriation", "report_deadlines", "coverage_period", X.truncate("condition_text").alias("condition_text"))
    return _ordered(rows, *_asc("fiscal_year", "agency_name", "item_number")).limit(cap(a["limit"]))


def legislation_links(x: DataFrame, **args) -> DataFrame:
    """Crosswalk rows with the link of the adopting meeting; the stored link is not given out."""
    a = TOOLS["get_legislation_link"].parse(args)
    rows = x.where(X.all_of(X.equals("fiscal_year", a["fiscal_year"]), X.like_nocase("document_type", a["document_type"]), X.like_nocase("local_file", a["local_file"])))
    rows = rows.withColumn("meeting_url", X.meeting_url("adopting_event_id")).drop("legistar_url", "adopting_event_id")
    return rows.orderBy(F.desc("fiscal_year"), "document_type", *rows.columns)


def available_years(**tables: tuple[DataFrame, str]) -> DataFrame:
    """(dataset, years, first_year, last_year) of (DataFrame, year column) by name."""
    out = None
    for name, (df, year) in tables.items():
        y = df.select(F.col(year).alias("y")).where("y is not null").distinct()
        one = y.agg(F.array_join(F.array_sort(F.collect_list("y")).cast("array<string>"), ",").alias("years"), F.min("y").alias("first_year"), F.max("y").alias("last_year")).select(F.lit(name).alias("dataset"), "*")
        out = one if out is None else out.unionByName(one)
    return out


class Rows:
    """The rows of an answer without a limit: counted in the cluster, read one partition at a time, never held at once."""

    def __init__(self, df: DataFrame) -> None:
        self.df = df

    def __len__(self) -> int:
        return self.df.count()

    def __iter__(self) -> Iterator[dict]:
        return (r.asDict() for r in self.df.toLocalIterator())


def call(tool: str, tables: dict[str, DataFrame], args: dict) -> dict:
    """The API entry: ``{"rows", "text"}``, or ``{"error"}``; never raises.

    The rows of a tool with a limit are a list of at most that many; those of the others
    are ``Rows``, whole however many they are, and their text is summed up in the cluster.
    """
    handlers: dict[str, Callable] = {
        "search_awards": lambda: search_awards(tables["awards"], **args), "get_awards_by_ein": lambda: awards_by_ein(tables["awards"], **args),
        "search_transparency_resolutions": lambda: search_transparency(tables["transparency"], **args),
        "search_capital_projects": lambda: search_capital(tables["capital"], **args), "get_terms_conditions": lambda: terms_conditions(tables["terms"], **args),
        "get_legislation_link": lambda: legislation_links(tables["legislation_crosswalk"], **args),
        "list_available_fiscal_years": lambda: years_by_dataset(tables, **args),
    }
    try:
        if tool not in handlers:
            raise QueryError(f"Unknown tool: {tool}")
        df = handlers[tool]()
        if "limit" in TOOLS[tool].params or tool == "list_available_fiscal_years":
            rows = [r.asDict() for r in df.collect()]
            return {"rows": rows, "text": render(tool, rows)}
        return {"rows": Rows(df), "text": render_all(tool, df)}
    except Exception as e:  # noqa: BLE001
        return {"error": f"Error: {e}"}


def years_by_dataset(tables: dict[str, DataFrame], **args) -> DataFrame:
    """The years each of the given tables covers; the one of the document where a table has both."""
    TOOLS["list_available_fiscal_years"].parse(args)
    year = lambda d: next((c for c in ("source_fy", "fiscal_year") if c in d.columns), None)
    return available_years(**{n: (d, year(d)) for n, d in sorted(tables.items()) if year(d)})


def render_all(tool: str, df: DataFrame) -> str:
    """As ``render``, for rows that stay in the cluster: one row per year comes back."""
    key = "fy1" if "fy1" in df.columns else "amount" if "amount" in df.columns else None
    amount = F.coalesce(F.col(key), F.lit(0)) if key else F.lit(0)
    low = F.coalesce(F.max(F.col("low_text_confidence")), F.lit(0)) if "low_text_confidence" in df.columns else F.lit(0)
    years = [tuple(r) for r in df.groupBy("fiscal_year").agg(F.count(F.lit(1)), F.sum(amount).cast("bigint"), low).collect()]
    return _report(tool, {y: (n, s) for y, n, s, _ in years}, bool(key), any(x for *_, x in years))


def render(tool: str, rows: list[dict]) -> str:
    """Text of a result: count, total of the returned rows, per-year lines, provenance."""
    if tool == "list_available_fiscal_years":
        return "\n".join([*(f"{r['dataset']}: {r['years']}" for r in rows), f"Source: {tool}"])
    key = "fy1" if rows and "fy1" in rows[0] else "amount" if rows and "amount" in rows[0] else None
    years: dict = {}
    for r in rows:
        n, s = years.get(r.get("fiscal_year"), (0, 0))
        years[r.get("fiscal_year")] = (n + 1, s + ((r[key] or 0) if key else 0))
    return _report(tool, years, bool(key), any(r.get("low_text_confidence") for r in rows))


def _report(tool: str, years: dict, money: bool, low: bool) -> str:
    if not years:
        return "No matching rows."
    lines = [f"{sum(n for n, _ in years.values())} row(s)" + (f", {_money(sum(s for _, s in years.values()))}" if money else "")]
    lines += [f"  FY{y}: {n} row(s), {_money(s)}" for y, (n, s) in sorted(years.items(), key=lambda kv: (kv[0] is None, kv[0]))]
    if low:
        lines.append("Caution: text of some rows is of low confidence; rely on EIN and amounts.")
    return "\n".join([*lines, f"Source: {tool}"])


def _money(v: int) -> str:
    return f"-${-v:,}" if v < 0 else f"${v:,}"
