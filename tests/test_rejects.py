import pytest

from fundlens.operators import rejects as R

AWARD = 'Arts,Choir Fund,member_item,Speaker,"Trust, Inc.",P.S. 1,{ein},{amount},DYF,purpose'


def reasons(spark, lines, fmt=R.AWARDS_FORMAT):
    df = spark.createDataFrame(list(enumerate(lines)), "line_id bigint, line string")
    return {r.line_id: r.reason for r in R.parse_lines(df, fmt).collect()}


@pytest.mark.parametrize("ein,ok", [("", True), ("123456789", True), ("12-3456789", True), ("12345678", False), ("12-345678", False), ("123 456789", False), ("N/A", False), ("12345678l", False), ("12–3456789", False)])
def test_ein(spark, ein, ok):
    assert reasons(spark, [AWARD.format(ein=ein, amount=5)])[0] == (None if ok else "bad_ein")


@pytest.mark.parametrize("amount,ok", [("", True), ("5", True), (" 5 ", True), ("-5", True), ("$5", True), ("$ 5", True), ('"1,234"', True), ("5.00", True), ('"$ 1,234,567.00"', True), ("5.5", False), ("(5)", False), ('"12,34"', False), ("5-", False), ("NaN", False), ("5k", False), ("9e9", False), ("--", False), ("5 000", False)])
def test_amount(spark, amount, ok):
    assert reasons(spark, [AWARD.format(ein="", amount=amount)])[0] == (None if ok else "bad_amount")


def test_structure(spark):
    good = AWARD.format(ein="", amount="")
    lines = [good, None, "", good + ",", "a,b", good.replace('"Trust, Inc."', '"Trust, Inc.'), good.replace('"Trust, Inc."', 'Trust"s'), good.replace('"Trust, Inc."', '"a ""b"" c\nd"'), good.replace("purpose", "two\nlines"), good.replace('"Trust, Inc."', ' "x"'), good]
    got = reasons(spark, lines)
    assert got == {0: None, 1: "column_count", 2: "column_count", 3: "column_count", 4: "column_count", 5: "quoting", 6: "quoting", 7: None, 8: "column_count", 9: "quoting", 10: None}


def test_first_reason_and_types(spark):
    raw = spark.createDataFrame(
        [(1, "f", "awards", AWARD.format(ein="x", amount="y")), (2, "f", "awards", AWARD.format(ein="12-3456789", amount='"$ 1,500.00"')), (3, "f", "capital", "I,BUREAU,L,S,X,5,,0,-7,Sp,T,,"), (4, "f", "capital", "I,Bureau,L,S,X,1,2,3,4,Sp,T,,"), (5, "f", "capital", "I,,L,S,X,1,2,3,4,Sp,T,,")],
        "line_id bigint, file_name string, dataset string, line string",
    )
    cap = spark.createDataFrame([("BUREAU",), ("BUREAU",), (None,), ("",)], "agency string")
    res = R.load_lines(raw, cap)
    assert {tuple(r) for r in res.rejects.collect()} == {(1, "bad_ein"), (4, "bad_agency"), (5, "bad_agency")}
    a = res.awards.collect()[0]
    assert (a.line_id, a.amount, a.organization) == (2, 1500, "Trust, Inc.")
    c = res.capital.collect()[0]
    assert (c.fy1, c.fy2, c.fy4) == (5, None, -7)


def test_empty(spark):
    assert reasons(spark, []) == {}
    raw = spark.createDataFrame([], "line_id bigint, dataset string, line string, reason string, extra int")
    assert R.load_lines(raw, spark.createDataFrame([], "agency string")).rejects.count() == 0
