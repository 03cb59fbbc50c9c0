import pytest

from fundlens.llm import sentences as S

CASES = [
    ("Mr. Smith left. He paid $4.50 at 5 p.m. Dr. Who came.", ["Mr. Smith", "He paid", "Dr. Who"]),
    ("See Sec. 12.7 of the act. Cf. Res. 407-49. They met on Aug. 5, 2019 in the U.S. office.", ["See Sec", "Cf. Res", "They met"]),
    ("He lives on Main Ave. The rest left in Oct.. A draft came etc. as told.", ["He lives", "The rest", "A draft"]),
    ("“We can't wait!” one of them said. She called it “a first step”. “Go. Now.” They went.", ["“We can't", "She called", "“Go.", "They went"]),
    ("The panel wondered ... and then agreed. eServices start in May. (It was late.) All left!", ["The panel", "eServices", "(It was", "All left"]),
    ("Heading Without Stop\n\nFirst line\nwraps here. Second one.\n\nPart II. Capital", ["Heading", "First line", "Second one", "Part II"]),
    ("Keep these.\n- One thing. Really.\n- Another\nThe end came. It did.\n\n1. Alpha\n2. Beta", ["Keep", "- One", "- Another", "The end", "It did", "1. Alpha", "2. Beta"]),
    ("It was due on July\n16. The next day came.", ["It was", "The next"]),
    ("Joined text near Oak Ave.The sponsor came.It cost 2.5 million.P.S. 9 paid.", ["Joined", "The sponsor", "It cost", "P.S."]),
    ("El Sr. Paz pidió $9, p. ej. para agua. ¿Quién paga? —¿Y los fondos? —preguntó ella. Cierra a las 5 p. m. La junta vino.", ["El Sr.", "¿Quién", "—¿Y", "Cierra", "La junta"]),
    ("M. Roux ouvre av. Foch. Quelle surprise ! « Nous ouvrirons. Rien ne change », a dit Mme Roux.", ["M. Roux", "Quelle", "« Nous"]),
    ("Срок истекает в июне 2022 г. Г-н Ким вернул 5 руб. сбора и т. д. по списку. «Мы откроемся. Плата та же», — сказал он.", ["Срок", "Г-н", "«Мы"]),
    ("डॉ. तमवेल ने कहा, “हम खुलेंगे। शुल्क वही।” यह क्र. 25 है। कौन देगा?", ["डॉ.", "यह", "कौन"]),
    ("主任说：“我们开门。费用不变。”费用为19.4百万元。真的吗？！名单包括公园……谁来？", ["主任", "费用为", "真的", "名单", "谁来"]),
    ("担当者は「開きます。同じです。」と述べた。時間がない！本当ですか。", ["担当", "時間", "本当"]),
    ("담당자는 “엽니다. 같습니다.”라고 말했다. 마감은 2025. 5. 24. 오후 5시이다. 누가 냅니까?", ["담당", "마감", "누가"]),
    ("د. كورزان طلب مبلغ، انظر ص. 64. من سيدفع؟ قال: «سنفتح. لن تتغير». انتهى.", ["د.", "من", "قال", "انتهى"]),
    ("สำนักงานปิดเวลา17.30น. ห้องสมุดลดลง 5.5 เปอร์เซ็นต์ในปี2019 เวลาเหลือน้อยแล้ว", ["สำนัก", "ห้องสมุด", "เวลาเหลือ"]),
]


@pytest.mark.parametrize("text,heads", CASES)
def test_units(text, heads):
    got = S.starts(text)
    assert [text[a:].startswith(h) for a, h in zip(got, heads)] == [True] * len(heads), [text[a : a + 12] for a in got]
    assert len(got) == len(heads), [text[a : a + 12] for a in got]


def test_document_settles_abbreviations():
    text = "The Bldg. was old. They sold the Bldg. Annex today. We met near Bldg. seven."
    assert [text[a : a + 4] for a in S.starts(text)] == ["The ", "They", "We m"]


def test_table(spark):
    long = "This is one. " * 20_000
    df = spark.createDataFrame([(1, "One. Two.", "x"), (2, None, "x"), (3, "", "x"), (4, " \n\r\n ", "x"), (5, "One. Two.", "y"), (6, long, "z")], "doc_id bigint, text string, start_pos string")
    rows = S.units(df).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.start_pos, r.end_pos))
    assert set(by) == {1, 5, 6} and sorted(by[1]) == sorted(by[5]) == [(1, 4), (6, 9)] and len(by[6]) == 20_000
    assert S.units(df.limit(0)).count() == 0


def test_corpus_counts_every_document(spark, monkeypatch):
    stops = [("They saw the Zob. Marten house.",)] * 12
    bare = [("a zob in the garden",)] * 60 + [("A zob again. It left.",)] * 60
    before = lambda rows, tasks: S.corpus_evidence(spark.createDataFrame(rows, "text string").repartition(tasks)).get("zob")
    assert before(stops, 1) == "before"
    assert before(stops + bare[:60], 1) is None  # documents without a period
    apart = spark.createDataFrame(stops, "text string").coalesce(1).union(spark.createDataFrame(bare[60:], "text string").coalesce(1))
    assert "zob" not in S.corpus_evidence(apart)  # other tasks
    monkeypatch.setattr(S, "HELD_TOKENS", 3)
    assert before(stops + bare, 2) is None and before(stops + [(None,), ("",)], 2) == "before"
