import pytest

from fundlens.operators import query as Q


@pytest.fixture(scope="module")
def awards(spark):
    rows = [(i, 2020 + i % 3, "Arts", f"Init {i % 4}", "member_item", ("Smith", "Jones", None)[i % 3], f"Org {i % 5}", "P", "12-3456789" if i % 2 else "987654321", None if i == 7 else i * 10, "DYF") for i in range(1, 61)]
    return spark.createDataFrame(rows, "award_id bigint, fiscal_year int, category string, initiative string, award_type string, member string, organization string, program string, ein string, amount bigint, agency string")


def test_limits():
    assert [Q.cap(x) for x in (None, float("nan"), 0, -5, 7.9, 900)] == [50, 50, 1, 1, 7, 500]


@pytest.mark.parametrize("args,part", [({"district": 3}, "`council_member`"), ({"query": "x"}, "`organization`"), ({"fiscal_year": "2020"}, "integer"), ({"ein": 5}, "text"), ({"fiscal_year": True}, "integer")])
def test_bad_arguments(awards, args, part):
    with pytest.raises(Q.QueryError, match=part):
        Q.search_awards(awards, **args)


def test_hints_name_own_parameters_only():
    with pytest.raises(Q.QueryError) as e:
        Q.TOOLS["get_terms_conditions"].parse({"district": 1})
    assert "Did you mean" not in str(e.value)
    with pytest.raises(Q.QueryError, match="one of"):
        Q.TOOLS["get_legislation_link"].parse({})
    with pytest.raises(Q.QueryError, match="designate"):
        Q.TOOLS["search_transparency_resolutions"].parse({"action": "x"})
    with pytest.raises(Q.QueryError, match="needs"):
        Q.TOOLS["get_awards_by_ein"].parse({})


def test_search_order_and_limit(awards):
    r = Q.search_awards(awards, council_member="SMITH", limit=5).collect()
    assert len(r) == 5 and [(x.fiscal_year, -(x.amount or 0)) for x in r] == sorted((x.fiscal_year, -(x.amount or 0)) for x in r)
    assert len(Q.search_awards(awards).collect()) == 50


def test_summaries(awards):
    s = {r.fiscal_year: (r.n, r.total) for r in Q.year_summary(Q.awards_by_ein(awards, ein="123456789")).collect()}
    assert sum(n for n, _ in s.values()) == 30 and sum(t for _, t in s.values()) == sum(i * 10 for i in range(1, 61, 2)) - 70
    names = {r.ein: r.organizations for r in Q.names_on_ein(awards, "award_id").collect()}
    assert names["123456789"] == "Org 1; Org 3; Org 0; Org 2; Org 4"


def test_call_never_raises(awards):
    t = {"awards": awards}
    assert "Error" in Q.call("nope", t, {})["error"] and "district" in Q.call("search_awards", t, {"district": 1})["error"]
    assert Q.call("search_awards", t, {"organization": "zzz"})["text"] == "No matching rows."
    out = Q.call("search_awards", t, {"fiscal_year": 2021, "limit": 3})
    assert len(out["rows"]) == 3 and out["text"].startswith("3 row(s), $") and "FY2021: 3" in out["text"]
