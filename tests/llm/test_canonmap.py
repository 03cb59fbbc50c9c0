from fundlens.llm import canonmap as C

CANON = [(1, "Senior Yoga Program"), (2, "Youth Yoga Access Project (YYAP)"), (3, "Family Food Pantry Network"), (4, "Tenant Gun Violence Prevention Fund (TGVPF)"), (5, "Youth Chess Fund")]
PAIRS = [(f"{a} {t} {k}", f"{c} {t2} {k2}") for a, c in (("Renter", "Tenant"), ("Older Adult", "Senior")) for t, t2, k, k2 in (("Gun Violence Prevention", "Gun Violence Prevention", "Fund", "Fund"), ("Yoga", "Yoga", "Program", "Program"), ("Yoga", "Yoga", "", "Program"))] * 2


def found(spark, values, canon=CANON, pairs=PAIRS):
    v = spark.createDataFrame([(x, "e") for x in values], "raw string, score string")
    c = spark.createDataFrame(canon, "canon_id bigint, name string")
    return {r.raw: r.canon_id for r in C.map_values(v, c, pairs).collect()}


def test_meant_entries(spark):
    want = {
        "SENIOR YOGA PROGRAM": 1, "senior  yoga": 1, "Senor Yoga Program": 1, "Yoga for Senior Program": 1, "SeniorYoga Program": 1, "Older Adult Yoga Program": 1, "Sr. Yoga Program": 1, "Y.Y.A.P.": 2, "YYAP Access Project": 2,
        "Family Food Pantry Ntwk.": 3, "Fam. Food Pantrry Network": 3, "Renter Gun Violence Prevention Fund": 4, "Family Yoga Program": 0, "Youth Clock Repair Fund": 0, "Youth Food Pantry Network": 0, "N/A": 0, "": 0, None: 0, "TBD " * 5000: 0,
    }
    assert found(spark, [*want, *want]) == want


def test_blocks_and_empty(spark, monkeypatch):
    one = found(spark, ["Senior Yoga Program", "Chess for Youth Fund"])
    monkeypatch.setattr(C, "BLOCK_ENTRIES", 2)
    assert found(spark, ["Senior Yoga Program", "Chess for Youth Fund"]) == one == {"Senior Yoga Program": 1, "Chess for Youth Fund": 5}
    assert found(spark, ["x"], []) == {"x": 0} and found(spark, []) == {}


def test_equal_entries_are_too_close(spark):
    assert found(spark, ["Youth Chess Fund"], [(5, "Youth Chess Fund"), (6, "Youth Chess Fund")]) == {"Youth Chess Fund": 0}
