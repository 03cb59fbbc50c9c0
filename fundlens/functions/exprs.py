"""Scalar functions as Column expressions: all run in the JVM, none is a Python UDF.

Java's ``\\s`` and ``\\w`` are ASCII; ``(?U)`` makes them Unicode where blanks such as
no-break spaces count.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _text(c: ColumnOrName) -> Column:
    return F.coalesce(_c(c).cast("string"), F.lit(""))


# ------------------------------------------------------------------ blanks


def trim_all(c: ColumnOrName) -> Column:
    """Without Unicode blanks at either end."""
    return F.regexp_replace(_text(c), r"(?U)^\s+|\s+$", "")


def clean(c: ColumnOrName) -> Column:
    """Runs of blanks as one, none at the ends."""
    return trim_all(F.regexp_replace(_text(c), r"(?U)\s+", " "))


def norm_upper(c: ColumnOrName) -> Column:
    return F.upper(clean(c))


def first_filled(*cs: ColumnOrName) -> Column:
    """The first value that is neither null nor empty, else the last."""
    return F.coalesce(*(F.nullif(_c(c), F.lit("")) for c in cs[:-1]), _c(cs[-1]))


# ------------------------------------------------------------------ tax numbers


def norm_ein(c: ColumnOrName) -> Column:
    """Digits only; null gives the empty text."""
    return F.regexp_replace(_text(c), "[^0-9]", "")


def ein_without_hyphens(c: ColumnOrName) -> Column:
    return F.regexp_replace(_text(c), "-", "")


def valid_ein(c: ColumnOrName) -> Column:
    return ein_without_hyphens(c).rlike("^[0-9]{9}$")


# ------------------------------------------------------------------ amounts


def parse_amount_lenient(c: ColumnOrName) -> Column:
    """The whole number a text begins with once ``$``, commas and blanks are gone; null if none: '12.7' 12, '12abc' 12, '(5)' null."""
    s = F.regexp_replace(_text(c), r"[$,\s]", "")
    return F.nullif(F.regexp_extract(s, r"^([+-]?[0-9]+)", 1), F.lit("")).try_cast("bigint")


def parse_amount_number(c: ColumnOrName) -> Column:
    """A decimal number as DOUBLE; null if blank or malformed (see ``malformed_amount``)."""
    return F.nullif(F.regexp_replace(_text(c), r"[$, ]", ""), F.lit("")).try_cast("double")


def malformed_amount(c: ColumnOrName) -> Column:
    return (F.regexp_replace(_text(c), r"\s", "") != "") & parse_amount_number(c).isNull()


def money_strict(c: ColumnOrName) -> Column:
    """BIGINT; under ANSI a malformed text raises."""
    return F.regexp_replace(F.trim(_c(c)), "[,$]", "").cast("bigint")


def money_or_zero(c: ColumnOrName) -> Column:
    return F.coalesce(F.nullif(F.regexp_replace(_text(c), "[,$ ]", ""), F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))


def money_signed(c: ColumnOrName) -> Column:
    """Parentheses mean a negative amount."""
    v = F.nullif(F.regexp_replace(F.trim(_text(c)), "[(),$]", ""), F.lit("")).try_cast("bigint")
    return F.when(F.trim(_text(c)).startswith("("), -v).otherwise(v)


def to_amount(c: ColumnOrName) -> Column:
    return F.coalesce(_c(c).try_cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))


def money_display(c: ColumnOrName) -> Column:
    """Thousands separators, the sign before ``$``, a dash for null."""
    n = F.format_number(F.abs(_c(c)), 0)
    return F.when(_c(c).isNull(), "—").when(_c(c) < 0, F.concat(F.lit("-$"), n)).otherwise(F.concat(F.lit("$"), n))


def round_half_even(c: ColumnOrName, digits: int = 0) -> Column:
    return F.bround(_c(c), digits)


def round_half_up(c: ColumnOrName, digits: int = 0) -> Column:
    return F.round(_c(c), digits)


def clamp_to(c: ColumnOrName, top: ColumnOrName) -> Column:
    """The lesser of two measures, absent ones as 0."""
    return F.least(F.coalesce(_c(c), F.lit(0)), F.coalesce(_c(top), F.lit(0)))


def percent_change(now: ColumnOrName, before: ColumnOrName) -> Column:
    """In percent of the earlier value; null if there is none or it is 0."""
    return F.when(_c(before) != 0, (_c(now) - _c(before)) * F.lit(100.0) / F.abs(_c(before)))


def percent_label(p: ColumnOrName) -> Column:
    """'+x.x%' or '-x.x%'; null stays null."""
    s = F.concat(F.format_number(F.abs(_c(p)), 1), F.lit("%"))
    return F.when(_c(p).isNull(), None).when(_c(p) < 0, F.concat(F.lit("-"), s)).otherwise(F.concat(F.lit("+"), s))


# ------------------------------------------------------------------ names


def straight_quotes(c: ColumnOrName) -> Column:
    return F.translate(_text(c), "’‘“”", "''\"\"")


def house_style(c: ColumnOrName) -> Column:
    """No leading asterisks, straight quotes, ``&`` as 'and', single blanks; case kept."""
    s = F.regexp_replace(trim_all(c), r"(?U)^\*+\s*", "")
    return clean(F.regexp_replace(straight_quotes(s), r"(?U)\s*&\s*", " and "))


def norm_mechanical(c: ColumnOrName) -> Column:
    return F.btrim(F.lower(house_style(c)), F.lit(".,;:"))


#: Words without weight in a name.
STOP_WORDS = ("the", "a", "an", "of", "for", "and", "in", "to", "at", "on", "inc")


def norm_aggressive(c: ColumnOrName) -> Column:
    """Letters and digits of the mechanical form, without stop words."""
    s = F.regexp_replace(F.regexp_replace(norm_mechanical(c), "[/-]", " "), "[^a-z0-9 ]", " ")
    keep = F.filter(F.split(s, " +"), lambda w: (w != "") & ~w.isin(list(STOP_WORDS)))
    return F.array_join(keep, " ")


def mech_norm_category(c: ColumnOrName) -> Column:
    s = F.regexp_replace(F.translate(trim_all(c), "’‘", "''"), r"(?U)\s*&\s*", " and ")
    s = F.lower(clean(F.regexp_replace(s, r"\.+$", "")))
    return F.replace(s, F.lit("organziations"), F.lit("organizations"))


def edit_norm_category(c: ColumnOrName) -> Column:
    """The mechanical form without rename notes, possessives, up to two closing type words and plural endings."""
    s = F.regexp_replace(mech_norm_category(c), r"\s*\(formerly[^)]*\)", "")
    s = F.replace(F.regexp_replace(s, r",?\s*formerly .*$", ""), F.lit("'s"), F.lit(""))
    for _ in range(2):
        s = F.trim(F.regexp_replace(s, r"\b(services|initiatives|initiative)\b\s*$", ""))
    return clean(F.regexp_replace(s, r"\b(\w{4,})s\b", "$1"))


def former_name(c: ColumnOrName) -> Column:
    """What follows 'formerly', up to a closing parenthesis; null if there is no such note."""
    return F.nullif(F.trim(F.regexp_extract(_text(c), r"(?i)formerly ([^)]+)", 1)), F.lit(""))


@lru_cache
def _decomposed() -> tuple[str, str]:
    """(letters, what is left of each): every character that decomposes into one letter and marks, by the Unicode rule."""
    pairs = []
    for code in range(0xC0, 0x10000):
        whole = unicodedata.normalize("NFD", chr(code)) if not 0xD800 <= code < 0xE000 else ""
        plain = "".join(ch for ch in whole if unicodedata.category(ch) != "Mn")
        if len(plain) == 1 and plain != chr(code):
            pairs.append((chr(code), plain))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def deaccent(c: ColumnOrName) -> Column:
    """Text without its accents: composed letters lose their marks, and so do letters followed by marks.

    Letters that decompose into several (Hangul syllables) stay whole.
    """
    return F.regexp_replace(F.translate(_text(c), *_decomposed()), r"\p{Mn}+", "")


def slug(c: ColumnOrName) -> Column:
    return F.replace(F.regexp_replace(F.lower(_text(c)), r"[^\w ]", ""), F.lit(" "), F.lit("-"))


def agency_bucket(c: ColumnOrName) -> Column:
    s = F.trim(_text(c))
    return F.when(s == "", "Unspecified agency").when(s.contains(","), "Multiple agencies").otherwise(s)


def meeting_url(c: ColumnOrName, template: str = "https://meetings.example.org/MeetingDetail.aspx?LEGID={}&GID=61") -> Column:
    """The link of an event id in a template with one ``{}``; null without an id."""
    before, after = template.split("{}")
    s = F.trim(_text(c))
    return F.when(s != "", F.concat(F.lit(before), s, F.lit(after)))


def truncate(c: ColumnOrName, n: int = 300) -> Column:
    return F.when(F.length(_c(c)) > n, F.concat(F.substring(_c(c), 1, n), F.lit("…"))).otherwise(_c(c))


def odata_literal(c: ColumnOrName) -> Column:
    return F.replace(_text(c), F.lit("'"), F.lit("''"))


def description(name: ColumnOrName, category: ColumnOrName, bucket: ColumnOrName, year: ColumnOrName, amount: ColumnOrName) -> Column:
    return F.concat(
        F.lit("“"), _c(name), F.lit("” — a "), _c(category), F.lit(" discretionary initiative administered by "), _c(bucket),
        F.lit(". FY"), _c(year).cast("string"), F.lit(" adopted: $"), F.format_number(_c(amount), 0), F.lit("."),
    )


# ------------------------------------------------------------------ pieces of lines


def split_first(c: ColumnOrName, sep: str = " - ") -> tuple[Column, Column]:
    """(before, after) the first separator; the second empty if there is none."""
    s = clean(c)
    parts = F.split(s, f"\\Q{sep}\\E", 2)
    return F.trim(parts[0]), F.coalesce(F.trim(F.get(parts, F.lit(1))), F.lit(""))


def split_org_program(c: ColumnOrName) -> tuple[Column, Column]:
    """Divided at an en dash between blanks if there is one, else at a hyphen between blanks."""
    s = clean(c)
    return tuple(F.when(s.contains(" – "), a).otherwise(b) for a, b in zip(split_first(s, " – "), split_first(s, " - ")))


def strip_flags(c: ColumnOrName) -> tuple[Column, Column]:
    """(text, closing asterisks)."""
    s = _text(c)
    return F.regexp_replace(s, r"\s*\*+\s*$", ""), F.regexp_extract(s, r"(\*+)\s*$", 1)


#: Boroughs whose delegations sponsor designations.
BOROUGHS = ("Bronx", "Brooklyn", "Manhattan", "Queens", "Staten Island")


def peel_delegation(c: ColumnOrName, places: tuple[str, ...] = BOROUGHS) -> tuple[Column, Column]:
    """(sponsor, rest): a borough delegation in front of an organization or wrapped around it; a bare 'Delegation' is dropped."""
    s = clean(c)
    boro = "(" + "|".join(p.replace(" ", r"\s+") for p in places) + ")"
    lead, wrap = rf"^{boro}\s+Delegation\s+(\S.*)$", rf"^{boro}\s+(.*\S)\s+Delegation$"
    form = F.when(s.rlike(lead), 1).when(s.rlike(wrap), 2).when(s.rlike(r"^Delegation\s+\S"), 3)
    sponsor = F.when(form == 1, F.concat(F.regexp_extract(s, lead, 1), F.lit(" Delegation"))).when(form == 2, F.concat(F.regexp_extract(s, wrap, 1), F.lit(" Delegation"))).otherwise(F.lit(""))
    rest = F.when(form == 1, F.regexp_extract(s, lead, 2)).when(form == 2, F.regexp_extract(s, wrap, 2)).when(form == 3, F.regexp_replace(s, r"^Delegation\s+", "")).otherwise(_text(c))
    return sponsor, F.trim(rest)


def last_code(c: ColumnOrName, letter: str) -> Column:
    """The last code after 'B:' or 'S:' (or a semicolon), empty if none."""
    return F.coalesce(F.element_at(F.nullif(F.regexp_extract_all(_text(c), F.lit(rf"\b{letter}[:;]\s*(\S+)"), F.lit(1)), F.array().cast("array<string>")), -1), F.lit(""))


def without_codes(c: ColumnOrName) -> Column:
    return clean(F.regexp_replace(_text(c), r"\b[BS][:;]\s*\S+", ""))


def split_number_repair(c: ColumnOrName) -> Column:
    """'1, 234' as '1,234'."""
    return F.regexp_replace(_text(c), r"(?<=\d),\s+(?=\d)", ",")


def trailing_amount(c: ColumnOrName) -> Column:
    """A closing amount: after ``$`` in any form, else grouped by commas; null if none."""
    s = _text(c)
    dollar = F.nullif(F.regexp_extract(s, r"\$\s*([\d,]+)\s*$", 1), F.lit(""))
    bare = F.nullif(F.regexp_extract(s, r"(?:^|\s)(\d{1,3}(?:,\d{3})+)\s*$", 1), F.lit(""))
    return money_signed(F.coalesce(dollar, bare))


def first_token_split(c: ColumnOrName) -> tuple[Column, Column]:
    parts = F.split(clean(c), " ", 2)
    return parts[0], F.coalesce(F.get(parts, F.lit(1)), F.lit(""))


#: Fixed value: agency initials at the head of a line, divided by slashes or commas.
AGENCY_INITIALS = r"^([A-Z][A-Za-z]{1,5}(?:[/,]\s?[A-Z][A-Za-z]{1,5})*)\s+(.*)$"


def agency_prefix_split(c: ColumnOrName) -> tuple[Column, Column]:
    """(agency, rest) of a summary line whose first word is in capitals and that begins with agency initials; agency empty otherwise.

    Initials after the first may be in mixed case ('DCAS/HhS').
    """
    s, p = clean(c), AGENCY_INITIALS
    word = F.split(s, " ")[0]
    ok = s.rlike(p) & (word == F.upper(word))
    return F.when(ok, F.regexp_extract(s, p, 1)).otherwise(F.lit("")), F.when(ok, F.regexp_extract(s, p, 2)).otherwise(s)


#: Verbs by which a leading 'Fund' begins a purpose and no name.
PURPOSE_VERBS = (
    "will would to are is was be been shall may can could used go going goes help helps support provide provides enhance ensure assist "
    "defray cover purchase pay allow expand create fund make reimburse"
).split()


#: Other words that begin a purpose, in whatever case.
PURPOSE_LEADS = ("to ", "support", "provide", "purpose")


def is_purpose(c: ColumnOrName) -> Column:
    """Prose of a purpose: a leading plural or gerund of fund, a singular before a verb, another lead of a purpose, or a leading lower-case letter."""
    s = F.ltrim(_text(c))
    verbs = "|".join(PURPOSE_VERBS)
    return s.rlike(rf"(?i)^(?:funds|funding|finds|(?:fund|find)\s+(?:{verbs})\b)\b") | s.rlike("(?i)^(?:" + "|".join(PURPOSE_LEADS) + ")") | s.rlike("^[a-z]")


def is_caps_header(c: ColumnOrName) -> Column:
    """A heading in capitals of 4 to 48 characters without amounts."""
    s = _text(c)
    return F.length(s).between(4, 48) & s.rlike("[A-Z]") & s.rlike(r"^[A-Z0-9 &'.,\-/()]+$")


def is_glued(c: ColumnOrName) -> Column:
    """Text that lost its blanks."""
    s = _text(c)
    return s.rlike("[A-Za-z]{18,}") & ~s.contains(" ")


def confidence_band(share: ColumnOrName) -> Column:
    return F.when(_c(share) < 0.01, "HIGH").when(_c(share) < 0.05, "MODERATE").otherwise("LOW")


_NUMBER = r"-?\d{1,3}(?:,\d{3})*"


def amount_run(c: ColumnOrName) -> Column:
    """The last four of the first run of at least four numbers, as ARRAY<BIGINT>; null if there is no such run."""
    run = F.regexp_extract(clean(c), rf"(?:^|\s)((?:{_NUMBER}\s+){{3,}}{_NUMBER})(?=\s|$)", 1)
    four = F.slice(F.split(run, " +"), -4, 4)
    return F.when(run != "", F.transform(four, lambda x: F.regexp_replace(x, ",", "").cast("bigint")))


def is_data_row(c: ColumnOrName) -> Column:
    """Two pairs of code tokens, one of them with a digit in second place, a single letter, then the amounts."""
    s = clean(c)
    t = F.split(s, " ")
    code = lambda i: F.get(t, F.lit(i)).rlike("^[A-Z0-9]{1,6}$")
    digit = F.get(t, F.lit(1)).rlike(r"\d") | F.get(t, F.lit(3)).rlike(r"\d")
    rest = F.array_join(F.slice(t, 6, 10_000), " ")
    ok = (F.size(t) >= 6) & code(0) & code(1) & code(2) & code(3) & digit & F.get(t, F.lit(4)).rlike("^[A-Za-z]$") & amount_run(rest).isNotNull()
    return F.coalesce(ok, F.lit(False))


# ------------------------------------------------------------------ dates

MONTH = "January|February|March|April|May|June|July|August|September|October|November|December"


def dates_in(c: ColumnOrName) -> Column:
    """Distinct dates in words, in order of their text, joined by '; '."""
    return F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(_text(c), F.lit(rf"\b((?:{MONTH}) [0-9]{{1,2}}, [0-9]{{4}})\b"), F.lit(1)))), "; ")


def coverage_period(c: ColumnOrName) -> Column:
    s, p = _text(c), r"(?i)period\s+beginning\s+(.+?)\s+and\s+ending\s+(.+?)[.,;]"
    return F.when(s.rlike(p), F.concat(F.regexp_extract(s, p, 1), F.lit(" to "), F.regexp_extract(s, p, 2))).otherwise(F.lit(""))


def year_in_path(c: ColumnOrName) -> Column:
    """20NN of a folder .../fyNN/..., null if none."""
    return (F.lit(2000) + F.nullif(F.regexp_extract(_text(c), r"/fy(\d\d)/", 1), F.lit("")).cast("int")).cast("int")


def year_label(c: ColumnOrName) -> Column:
    """'FYNN' of a folder, 'FY??' if none."""
    y = F.regexp_extract(_text(c), r"/fy(\d\d)/", 1)
    return F.concat(F.lit("FY"), F.when(y == "", "??").otherwise(y))


def iso_date_in(c: ColumnOrName) -> Column:
    return F.nullif(F.regexp_extract(_text(c), r"(\d{4}-\d{2}-\d{2})", 1), F.lit("")).try_cast("date")


def fiscal_year_in(c: ColumnOrName) -> Column:
    """The year after 'Fiscal' (and 'Year'), null if none."""
    return F.nullif(F.regexp_extract(_text(c), r"(?i)\bFiscal\s*(?:Year\s*)?(\d{4})\b", 1), F.lit("")).cast("int")


# ------------------------------------------------------------------ filters


def like_nocase(c: ColumnOrName, value: str | None) -> Column | None:
    """Substring filter without regard to case; ``%`` and ``_`` of the value are wildcards, a backslash is plain text.

    A null or blank value is no filter.
    """
    if value is None or not value.strip():
        return None
    return F.lower(_c(c)).like("%" + value.strip().lower().replace("\\", "\\\\") + "%")


def equals(c: ColumnOrName, value: int | None) -> Column | None:
    return None if value is None else _c(c) == F.lit(value)


def equals_nocase(c: ColumnOrName, value: str | None) -> Column | None:
    return None if value is None else F.lower(_c(c)) == F.lit(value.lower())


def ein_equals(c: ColumnOrName, value: str | None) -> Column | None:
    return None if not value else norm_ein(c) == norm_ein(F.lit(value))


def all_of(*filters: Column | None) -> Column:
    """The filters that are set, and true if none is."""
    out = F.lit(True)
    for f in filters:
        if f is not None:
            out = out & f
    return out
