import random
import re

import pytest

from fundlens.llm import scanrepair as S

WORDS = "department of community justice shall submit to the council quarterly report detailing seats offered and filled by grade within area machine readable format equipment interpreters district museum security cameras tutoring school delivered groceries home after pre post visits reading".split()


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(WORDS) for _ in range(14)) for _ in range(300)]
    texts += ["The home-delivered groceries after-school report"] * 20
    texts += [f"the council shall\nSupporting Detail for Fiscal Year {2010 + i}     Page {i + 1}\nsubmit to the district" for i in range(8)]
    return S.learn(spark.createDataFrame([(t,) for t in texts], "text string"))


CASES = [
    ("the quar-\nterly report", "the quarterly report", {"broken_word"}), ("the equip ment within", "the equipment within", {"broken_word"}), ("the inter\xadpreters", "the interpreters", {"broken_word"}),
    ("tutor -ing and muse¬ um", "tutoring and museum", {"broken_word"}), ("c0mmunity justicc", "community justice", {"misread"}), ("SECUR1TY CAMERA5", "SECURITY CAMERAS", {"misread"}), ("tlie d1strict", "the district", {"misread"}),
    ("submit\n~ 12 ~\nto the council", "submit to the council", {"furniture"}), ("report Supporting Detail for Fiscal Year 2031 within area", "report within area", {"furniture"}), ("the dis-\n\n91\ntrict", "the district", {"broken_word", "furniture"}),
    ("home-delivered groceries", "home-delivered groceries", set()), ("pre- and post-visits", "pre- and post-visits", set()), ("the council\nshall submit", "the council shall submit", set()),
    ("museum - security cameras", "museum - security cameras", set()), ("See page 14 of the report", "See page 14 of the report", set()), ("district 38 HX-0007 grade 10-14", "district 38 HX-0007 grade 10-14", set()),
]


@pytest.mark.parametrize("read,written,kinds", CASES)
def test_repair(model, read, written, kinds):
    assert model.repair(read) == (written, kinds)


def test_held_out_words(model):
    rng = random.Random(9)
    right = n = 0
    for w in sorted(set(WORDS)):
        spots = [(i, t, s) for t, s in S.LOOK_ALIKE for i in range(len(w)) if w[i : i + len(t)] == t]
        if len(w) < 5 or not spots:
            continue
        i, t, s = rng.choice(spots)
        n += 1
        right += model.edit(w[:i] + s + w[i + len(t) :])[0] == w
    assert right / n >= 0.9


def test_table(spark, model):
    rows = [("t", 1, None), ("t", 2, ""), ("t", 3, "  \n "), ("t", 4, "tlie c0uncil " * 3000), ("u", 4, "the council"), ("u", 5, "the council")]
    df = spark.createDataFrame(rows, "table_name string, row_id bigint, text string")
    got = {(r.table_name, r.row_id): (r.text, r.noise) for r in S.repair_texts(df, model).collect()}
    assert got[("t", 1)] == got[("t", 2)] == got[("t", 3)] == ("", [])
    assert got[("t", 4)][1] == ["misread"] and got[("u", 4)] == got[("u", 5)] == ("the council", [])
    assert S.repair_texts(df.limit(0), model).count() == 0 and S.repair_texts(df.limit(0)).count() == 0


def test_cited_pages_and_copies_make_no_header(spark):
    rng = random.Random(4)
    body = lambda: " ".join(rng.choice(WORDS) for _ in range(9))
    texts = [f"{body()}\nBudget line HX-0007 is exempt from this condition. See page 14\nof the plan {body()}" for _ in range(20)]  # cited
    texts += ["Museum Security Cameras   Page 12"] * 20  # a whole text
    texts += [f"Tutoring within the Area  {i}\n{body()}" for i in range(4)] + [f"{body()}\nTutoring within the Area\n{body()}" for _ in range(200)]  # hardly ever with a number
    texts += [f"District Museum Equipment   Page 3\n{WORDS[0]}"] * 20  # copies of one text
    texts += [f"{body()}\nSupporting Detail for Fiscal Year {2010 + i}     Page {i + 1}\n{body()}" for i in range(8)]
    assert S.learn(spark.createDataFrame([(t,) for t in texts], "text string")).headers == ["Supporting Detail for Fiscal Year #"]


def test_rare_words_and_headers_are_all_known(spark, monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(WORDS[:12]) for _ in range(14)) for _ in range(200)] + [f"the kaleidoscope {w} of justice" for w in WORDS[:4]]
    names = [f"{a.title()} {b.title()} Ledger" for a in WORDS[:12] for b in WORDS[12:24]]
    texts += [f"the council shall\n{h}   Page {i}\nsubmit {w}" for i, w in enumerate(WORDS[:3], 1) for h in names]
    df = spark.createDataFrame([("t", i, t) for i, t in enumerate(texts)], "table_name string, row_id bigint, text string")
    whole = S.learn(df.select("text"))
    monkeypatch.setattr(S, "MAX_WORDS", 20)
    monkeypatch.setattr(S, "MAX_HEADERS", 10, raising=False)
    few = S.learn(df.select("text"))
    assert len(dict(few.counts)) <= 20 < len(whole.counts) and all(few.count(w) == n for w, n in whole.counts.items())
    assert "kaleidoscope" in few.counts and "kaleidoscopes" not in few.counts and few.headers == whole.headers and len(few.headers) == len(set(names))
    rows = spark.createDataFrame([("t", 1, "the kaleido scope of justice"), ("t", 2, f"the council {names[-1]} shall")], "table_name string, row_id bigint, text string")
    got = {r.row_id: (r.text, r.noise) for r in S.repair_texts(rows, few).collect()}
    assert got == {1: ("the kaleidoscope of justice", ["broken_word"]), 2: ("the council shall", ["furniture"])}


def test_copies_are_no_evidence(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(WORDS) for _ in range(14)) + " shelter" for _ in range(60)]
    hot = "the slielter of the inter preters"
    m = S.learn(spark.createDataFrame([(t,) for t in texts + [hot] * 400], "text string"))
    assert m.repair(hot) == ("the shelter of the interpreters", {"broken_word", "misread"})


def test_trained_on_all_words_and_texts(spark, monkeypatch):
    words = [a + b + c for a in ("bal", "den", "fos", "gim", "hur", "kel", "lom") for b in ("an", "es", "it", "or", "un") for c in ("dar", "fen", "gos", "lim", "nur", "pas", "rel", "tom", "vix", "zet")]
    m = S.Model({w: 500 - i for i, w in enumerate(words)} | {"wyqxuj": 3}, [])
    monkeypatch.setattr(S, "MAX_TRAINING_WORDS", 100, raising=False)
    monkeypatch.setattr(S, "TRAINING_WORDS", 100, raising=False)
    S.train(m)
    assert "qx" in m.bigrams  # the last word counts too
    monkeypatch.setattr(S, "PIECES", 50)
    texts = [(f"the {w} garden of the {v} house was built again",) for w in words[:30] for v in words[:10]]
    met = S._met(spark.createDataFrame(texts, "text string").repartition(3), [], len(texts))
    assert sum(n for *_, n in met) >= 0.8 * len(texts)  # one piece each; some forms are no candidates inside a line
    assert met == S._met(spark.createDataFrame(texts, "text string").coalesce(1), [], len(texts))


def test_nothing_is_worked_out_twice(monkeypatch):
    asked = {"features": 0, "count": 0}
    for name in asked:

        def counted(self, *x, name=name, f=getattr(S.Model, name)):
            asked[name] += 1
            return f(self, *x)

        monkeypatch.setattr(S.Model, name, counted)
    monkeypatch.setattr(S, "TRAINING_WORDS", 10)  # several parts
    made = []
    for epochs in (1, 5):
        monkeypatch.setattr(S, "EPOCHS", epochs)
        asked["features"] = 0
        m = S.Model({w: 90 - i for i, w in enumerate(WORDS)}, [])
        S.train(m)
        made.append(asked["features"])
    assert made[0] == made[1] > 0
    text = "the Zorvik c0uncil of the Tavlor dis trict, 12 Wexel and the\nequip- ment of Zorvik"
    first = m.repair(text)
    asked["count"] = 0
    assert m.repair(text) == first and first[1] and asked["count"] <= 4  # only the marked cut is looked up again


def test_page_forms_apart_find_what_one_pattern_finds():
    one = re.compile(r"(?<![\w.])(?:~ ?\d{1,4} ?~|\[\d{1,4}\]|(?<!\w )- \d{1,4} -(?!\d)|(?<=\w )- \d{1,4} -(?=\s)|[Pp]age \d{1,4}(?: of \d{1,4})?|(?<=[\n\f])\s*p\. \d{1,4}(?=\s*(?:[\n\f]|$)))(?!\w)")
    rng = random.Random(11)
    bits = ["~ 12 ~", "~5~", "[7]", "- 3 -", "- 4 - 5 -", "Page 12", "page 3 of 9", "p. 4", "\n", "\n\n", "\f", " ", "  ", "\t", "x", ".", "3", "٣", "-", "~"]
    for _ in range(5000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 9)))
        assert sorted(m.span() for held, form in S._PAGES if held in text for m in form.finditer(text)) == [m.span() for m in one.finditer(text)], text


def test_words_beside_cuts_are_not_counted():
    one = re.compile(r"[^\W\d_]*(?:\s*[\xad¬‐]\s*|-\s*[\r\n\f]\s*| -(?=\w)|- )[^\W\d_]*")
    rng = random.Random(12)
    bits = ["the", "area", "x²", "é", "-", "- ", " -", " - ", "-\n", "-\r\n", "\xad", "¬ ", "‐", " ", "  ", "\n", "'", "_", "7", ";", "- -"]
    for _ in range(5000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 12)))
        assert S._without_cuts(text) == one.sub(" ; ", text), text
