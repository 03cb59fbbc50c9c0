"""Each named step decides: results fall when it is switched off."""

import random

import numpy as np
import pytest

from fundlens.llm import leaks, scanrepair
from fundlens.llm import sentences as S


# ------------------------------------------------------------------ p10


def _corpus(spark):
    rows = [f"Zwb. Norbelu sent {i} forms. They met again with zwb. {i} cases. Rule xq. {i} holds, see xq. {i} too." for i in range(40)]
    return spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id bigint, text string")


def test_corpus_settles_unlisted_abbreviations(spark):
    learned = S.corpus_evidence(_corpus(spark))
    assert learned["xq"] == "reference" and learned["zwb"] in ("before", "reference", "number") and "cases" not in learned or learned["cases"] != "reference"
    text = "Here xq. 9 stands and Zwb. Talo came."
    assert S.starts(text, learned) == [0] and len(S.starts(text, {})) > 1


def test_document_comes_before_corpus_and_lists():
    text = "He said no. Then he left with no word. He said no. 4 is odd."
    assert [text[a : a + 4] for a in S.starts(text, {"no": "reference"})] == ["He s", "Then", "He s"]
    assert len(S.starts("He said sat. Talo came. He sat down.", {"sat": "abbreviation"})) == 3 and len(S.starts("He said sat. Talo came.", {"sat": "abbreviation"})) == 1


def test_lists_answer_only_where_both_are_silent(monkeypatch):
    text = "It is due on Feb. 3 at noon. Ask Mr. Talo."
    assert len(S.starts(text, {})) == 2
    for name in ("BEFORE", "MONTHS", "AFTER"):
        monkeypatch.setattr(S, name, frozenset())
    assert len(S.starts(text, {"feb": "number", "mr": "before"})) == 2 < len(S.starts(text, {}))


@pytest.mark.parametrize("n", (10, 700, 5000))
def test_quotations_of_any_length(n):
    inside = "We open. Fees stay. " * n
    assert [len(S.starts(f"He said {a}{inside.strip()}{b} and left. Then more.")) for a, b in ("“”", "«»", '""')] == [2, 2, 2]


# ------------------------------------------------------------------ p4

WORDS = "department of community justice shall submit to the council quarterly report detailing seats offered and filled by grade within area machine readable format equipment interpreters district museum security cameras tutoring school".split()


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(WORDS) for _ in range(14)) for _ in range(300)]
    return scanrepair.learn(spark.createDataFrame([(t,) for t in texts], "text string"))


def test_the_model_makes_every_operation(model):
    read = "the quar-\nterly rep0rt of\nPage 12\nthe equip ment"
    assert model.repair(read) == ("the quarterly report of the equipment", {"broken_word", "misread", "furniture"})
    blank = scanrepair.Model(model.counts, model.headers, {}, model.bigrams)
    assert blank.repair(read)[1] == set()


def test_place_of_a_page_number_decides(model):
    assert model.repair("the council\nPage 12\nshall submit")[1] == {"furniture"}
    assert model.repair("the council, see Page 12 of the report, shall submit")[1] == set()
    assert model.repair("the council shall, per page 12, submit")[1] == set()


# ------------------------------------------------------------------ p9


def _pairs(spark, item, *docs):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    i = spark.createDataFrame([(1, item), (2, "Another text. It is short. No one has it.")], "item_id bigint, text string")
    return {r.doc_id: (r.longest, r.sentences) for r in leaks.leaked(leaks.tiles(d, i)).collect()}


ITEM = "The old harbour was closed in spring. Nine boats were moved to the north pier. The keeper wrote a long report about it. It was never read by anyone in town."


def test_tiles_catch_reordered_and_edited_sentences(spark):
    a, b, c, d = (x.strip(". ") + "." for x in ITEM.split(". "))
    edited = f"{a.replace('closed', 'shut')} {b.replace('pier', 'dock')} {c.replace('long', 'short')}"
    got = _pairs(spark, ITEM, f"Intro words here. {c} {a} {b} Done.", f"xx yy. {edited} zz", f"{a} filler text goes here now. {b} and more filler. {c}", f"{a} Nothing else. {c}", "short phrase: The old harbour was closed")
    assert set(got) == {0, 1, 2} and all(s >= 3 for _, s in got.values())


def test_tiles_decide(spark, monkeypatch):
    doc = f"x {ITEM} y"
    assert set(_pairs(spark, ITEM, doc)) == {0}
    index = leaks.SeedIndex([(1, ITEM)])
    ids = np.array([index.vocabulary.get(w, 0) for w in leaks.words(doc)])
    item = index.items[0]
    assert leaks.tile(ids, item, index.k) == (len(item.ids), len(item.ids), 4)
    assert leaks.tile(ids, item, index.k, []) == (0, 0, 0)  # without tiles nothing is covered


def test_one_word_sentences_do_not_shorten_seeds():
    lengths = [[12, 1, 12, 14], [9, 9, 9]]
    assert leaks.seed_length(lengths) == leaks.seed_length([[12, 12, 12, 14], [9, 9, 9]]) == 4
