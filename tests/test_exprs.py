import pytest
from pyspark.sql import functions as F

from fundlens.functions import exprs as X


def ev(spark, value, f):
    r = f(F.col("v"))
    d = spark.createDataFrame([(value,)], "v string")
    if isinstance(r, tuple):
        return tuple(d.select(*(c.alias(str(i)) for i, c in enumerate(r))).first())
    return d.select(r.alias("r")).first()[0]


CASES = [
    (X.norm_ein, "13-26 12524x", "132612524"), (X.norm_ein, None, ""), (X.valid_ein, "13-2612524", True), (X.valid_ein, "13 2612524", False),
    (X.parse_amount_lenient, "$1,234", 1234), (X.parse_amount_lenient, "12.7", 12), (X.parse_amount_lenient, "12abc", 12), (X.parse_amount_lenient, "(5)", None), (X.parse_amount_lenient, "-", None), (X.parse_amount_lenient, "", None), (X.parse_amount_lenient, "-7", -7),
    (X.parse_amount_number, "1,234.5", 1234.5), (X.parse_amount_number, "x", None), (X.malformed_amount, "x", True), (X.malformed_amount, " ", False), (X.malformed_amount, None, False),
    (X.money_signed, "($1,500)", -1500), (X.money_signed, "$1,500", 1500), (X.money_or_zero, "", 0), (X.money_or_zero, "1,000", 1000),
    (X.house_style, "** A  &B’s “x” ", "A and B's \"x\""), (X.house_style, None, ""), (X.norm_mechanical, "*The Fund.", "the fund"), (X.norm_aggressive, "The Arts/Culture-Fund of the City, Inc.", "arts culture fund city"),
    (X.mech_norm_category, "Community  Organziations.", "community organizations"), (X.edit_norm_category, "Children's Services (formerly Youth)", "children"), (X.edit_norm_category, "Senior Services Initiative", "senior"),
    (X.former_name, "A (formerly B C)", "B C"), (X.former_name, "A", None), (X.deaccent, "Éñü", "Enu"), (X.slug, "A & B's x", "a--bs-x"),
    (X.agency_bucket, " ", "Unspecified agency"), (X.agency_bucket, "A, B", "Multiple agencies"), (X.agency_bucket, " DYF ", "DYF"), (X.meeting_url, " ", None), (X.odata_literal, "O'B", "O''B"),
    (X.split_org_program, "Org - Prog - x", ("Org", "Prog - x")), (X.split_org_program, "A - B – C", ("A - B", "C")), (X.split_org_program, "Org", ("Org", "")),
    (X.strip_flags, "Org **", ("Org", "**")), (X.strip_flags, "Org", ("Org", "")),
    (X.peel_delegation, "Bronx Delegation Arts Club", ("Bronx Delegation", "Arts Club")), (X.peel_delegation, "Staten Island Arts Club Delegation", ("Staten Island Delegation", "Arts Club")), (X.peel_delegation, "Delegation Club", ("", "Club")), (X.peel_delegation, "Manhattan Chamber", ("", "Manhattan Chamber")),
    (lambda c: X.last_code(c, "B"), "T B: K1 x B; K2", "K2"), (lambda c: X.last_code(c, "S"), "T", ""), (X.without_codes, "T B: K1 x S; 2", "T x"), (X.split_number_repair, "1, 234", "1,234"),
    (X.trailing_amount, "x $ 1,234 ", 1234), (X.trailing_amount, "x 1,234", 1234), (X.trailing_amount, "x 2024", None), (X.first_token_split, "DYF Arts fund", ("DYF", "Arts fund")), (X.agency_prefix_split, "DYF/DHS Arts", ("DYF/DHS", "Arts")), (X.agency_prefix_split, "Arts x", ("", "Arts x")),
    (X.is_purpose, "Funds will be used", True), (X.is_purpose, "Fund for the City", False), (X.is_purpose, "Fund will be used", True), (X.is_purpose, "to pay", True),
    (X.is_caps_header, "ARTS & MUSEUMS", True), (X.is_caps_header, "ARTS $5", False), (X.is_caps_header, "Arts", False), (X.is_glued, "abcdefghijklmnopqrstuvw", True), (X.is_glued, "abc def", False),
    (X.amount_run, "I.S. 240 1,000 0 -5 7 Smith", [1000, 0, -5, 7]), (X.amount_run, "126 1 2 3 4", [1, 2, 3, 4]), (X.amount_run, "1 2 3", None), (X.is_data_row, "AG CN001 AG D001 K Title 1 2 3 4 Smith", True), (X.is_data_row, "A TITLE OF SOME K x", False),
    (X.dates_in, "by May 5, 2024 and April 6, 2023; May 5, 2024", "April 6, 2023; May 5, 2024"), (X.coverage_period, "period beginning July 1 and ending June 30.", "July 1 to June 30"), (X.year_in_path, "data/fy26/x.csv", 2026), (X.year_label, "data/x.csv", "FY??"), (X.fiscal_year_in, "Chart - Fiscal 2024", 2024),
    (X.clean, " a \n b ", "a b"),
]


@pytest.mark.parametrize("i", range(len(CASES)))
def test_case(spark, i):
    f, value, want = CASES[i]
    assert ev(spark, value, f) == want


def test_numbers(spark):
    d = spark.createDataFrame([(-1234567, 2.5, 120, 100), (None, 3.5, 5, 0)], "a bigint, b double, n bigint, p bigint")
    r = d.select(X.money_display("a"), X.round_half_even("b"), X.round_half_up("b"), X.percent_label(X.percent_change("n", "p")), X.clamp_to("n", "p")).collect()
    assert [tuple(x) for x in r] == [("-$1,234,567", 2.0, 3.0, "+20.0%", 100), ("—", 4.0, 4.0, None, 0)]


def test_filters(spark):
    d = spark.createDataFrame([("50% Off_A\\b", "12-3", 0), ("other", "", 1), (None, None, None)], "s string, ein string, n int")
    n = lambda f: d.where(X.all_of(f)).count()
    assert n(X.like_nocase("s", "  off_a\\B ")) == 1 and n(X.like_nocase("s", "o%r")) == 1 and n(X.like_nocase("s", " ")) == 3 and n(X.like_nocase("s", None)) == 3
    assert n(X.equals("n", 0)) == 1 and n(X.equals("n", None)) == 3 and n(X.ein_equals("ein", "123")) == 1 and n(X.ein_equals("ein", "")) == 3 and n(X.equals_nocase("s", "OTHER")) == 1
