"""Sentence boundaries across languages and scripts.

A document is cut into blocks by blank lines, list entries and headings; a block is cut
at terminators by rules of the script around them.  Whether a period after a short token
ends a sentence is settled in the document itself first: where the token stands before
lower case or a comma it is an abbreviation, where it stands without its period it is a
word, and a capitalised word that follows lower case elsewhere is a name and no sign of a
new sentence.  What the document leaves open falls back on counts over the whole corpus
(all tokens, none left out); short lists of common abbreviations answer only where both
are silent.  Quotations are passed over as a whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values: common abbreviations, without their period, by what may follow them; asked last
#: stand before a name, or before a number, and never end a sentence
BEFORE = frozenset(
    "mr mrs ms mx dr prof rev sgt st hon fr capt lt col gen gov sen rep pres messrs mt ft "
    "no nos nr p pp fig figs sec secs app ext ver vol ch art arts par para eq ed eds res vs v cf incl approx misc ca i.e e.g viz "
    "sr sra srta d dña da lic ing núm num pág págs pag av avda c cap ej art "
    "m mm mme mlle me av bd cf chap "
    "ул им стр см д пр пл пер рис гл им проф акад тов "
    "डॉ श्री क्र प्रो पं "
    "د ص م أ رقم ج".split()
)
#: stand before a number inside a sentence; before anything else they end it
MONTHS = frozenset("jan feb mar apr jun jul aug sep sept oct nov dec ene abr ago dic janv févr juil sam".split())
#: may end a sentence: before a capital they do
AFTER = frozenset(
    "ave blvd inc co ltd corp llc jr etc al dept assn ctr sat sun mon tue tues wed thu thur thurs fri bros esq a.m p.m am pm ph.d m.d b.a m.a "
    "cía cia ud uds vd g г гг руб коп чел млн млрд тыс долл h min".split()
)
#: function words that begin sentences in lower-case languages
STARTERS = frozenset(
    "the a an this that these those each every all both two three it he she they we you i if in on at for as but and or no not when while there one some many most "
    "la el los las un una cada le les l' chaque qui".split()
)
TERMINATORS = ".!?…؟。！？।॥｡"
WIDE = frozenset("。！？｡")
DANDA = frozenset("।॥")
CLOSERS = "\"'”’»›)）」』】]"
#: particles that carry a sentence on after a closing bracket
CARRY_ON = frozenset("とってはがをにのへもでやかな라고이는은가을를,，、；;:：")

_LOWER = "a-zß-öø-ÿа-яёāăąćčďđēęěğīłńňőōřśşšťūůűźżž"
_CANDIDATE = re.compile(
    r"“[^“”]*+”|«[^«»]*+»|「[^「」]*+」|『[^『』]*+』|(?<!\w)\"(?=\S)[^\"]*+(?<=\S)\"(?!\w)"
    r"|\d{4}\.\s+\d{1,2}\.\s+\d{1,2}\.(?=\s*(?:오전|오후))"
    rf"|[。！？｡।॥]++[{re.escape(TERMINATORS + CLOSERS)}]*+"
    rf"|(?:[!?…؟]|\.(?![\d,;:]|\s*+[{_LOWER}](?![A-Z])))[{re.escape(TERMINATORS + CLOSERS)}]*+"
)
_BLANK = re.compile(r"\n[^\S\n]*\n\s*")
_MARK = re.compile(r"[^\S\n]*(?:[-•*‣◦–▪·]\s+|(\d{1,2})[.)]\s+|\(([a-z]|\d{1,2})\)\s+)(?=\S)")
_TOKEN_EDGE = re.compile(r"[\s(“\"«¿¡—‘'’\[/]")
_SPACE = re.compile(r"\s*")
#: A letter with the marks that some scripts put on it.
_L = "(?:[^\\W\\d_]|[\u0300-\u036f\u064b-\u065f\u0900-\u0903\u093a-\u094f])"
#: A short token with its period, and what follows it: a mark, the end of a paragraph, or a word.
_EVIDENCE = re.compile(rf"(?<![\w.-])((?:{_L}{{1,3}}\.){{0,3}}{_L}{{1,6}})\.(?=([,;:])|(\s*(?:\n\s*\n|\Z))|\s+(\S)(\S*))")
#: The same without one.
_BARE = re.compile(rf"(?<![\w.-]){_L}{{1,6}}+(?![\w.-])")
_SHORT = re.compile(rf"{_L}{{1,6}}")
#: Occurrences from which on the corpus has something to say (of an ordinary word as many would show an end of a paragraph
#: or a word that begins sentences behind it), and the shares that decide.
MIN_EVIDENCE, MOST, SOME, HARDLY = 10, 0.7, 0.2, 0.03
#: Different tokens counted in memory by one task before they are handed on.
HELD_TOKENS = 500_000
_THAI = re.compile("[฀-๿]")
_THAI_GAP = re.compile(r"\s+")
QUOTES = "“«「『\""
HEADING_CHARS = 80


class Document:
    """What the document says of its own tokens; looked up only for tokens in doubt."""

    def __init__(self, text: str, learned: dict[str, str] | None) -> None:
        self.text, self.learned = text, learned
        self.memo: dict[str, str | None] = {}
        self._lower: set[str] | None = None
        self._inside: set[str] = set()

    def kind(self, t: str) -> str | None:
        """How a token with a period goes on; None if nothing is known.

        before: never an end; reference: a number follows, never an end; number: an end
        unless a number follows; after: may be an end; abbreviation: an end unless a name
        follows; word: an end.

        The document decides between word and abbreviation; the corpus says of which sort
        an abbreviation is, and decides alone where the document is silent.
        """
        if t not in self.memo:
            low = t.lower()
            corpus = (self.learned or {}).get(form(t))
            before_lower, bare = self._evidence(t)
            if bare:
                own = {"reference": "number", "number": "number", "before": "before"}.get(corpus, "word")
            elif before_lower:
                own = corpus or "abbreviation"
            else:
                own = corpus
            self.memo[t] = own or ("before" if low in BEFORE else "number" if low in MONTHS else "after" if low in AFTER else None)
        return self.memo[t]

    def _evidence(self, t: str) -> tuple[bool, bool]:
        """(stands with its period before lower case or a comma, stands without a period)."""
        text, n, at = self.text, len(self.text), self.text.find(t)
        lower = False
        while at >= 0:
            e = at + len(t)
            if not (at and text[at - 1].isalnum()) and not (e < n and text[e].isalnum()):
                if e >= n or text[e] != ".":
                    return lower, True
                after = _SPACE.match(text, e + 1).end()
                if after < n and (text[e + 1] in ",;:" or text[after].islower() and not text[after + 1 : after + 2].isupper()):
                    lower = True
            at = text.find(t, e)
        return lower, False

    def name(self, word: str) -> bool:
        """Is a capitalised word a name rather than the first word of a sentence?

        It is none if the document has it in lower case, and one if it stands capitalised
        after lower case or a comma; else it is taken for one unless it often begins sentences.
        """
        low = word.lower()
        if self._lower is None:
            self._lower = set(re.findall(rf"(?<!\w)[{_LOWER}]{{2,}}", self.text))
            self._inside = set(re.findall(r"(?<=[a-zа-яà-ÿ,] )[^\W\d_]+", self.text)) - self._lower
        if low in self._lower:
            return False
        return word in self._inside or low not in STARTERS


def _token(text: str, at: int) -> str:
    """The token that ends at ``at``; of sentences joined without a gap only the last word."""
    t = _TOKEN_EDGE.split(text[max(0, at - 24) : at])[-1]
    if "." in t:
        parts = t.split(".")
        if any(len(x) > 2 and x.isalpha() for x in parts[:-1]) and parts[-1][:1].isupper() and "@" not in t:
            return parts[-1]
    return t


def _period_ends(doc: Document, text: str, at: int, nxt: int) -> bool:
    """Does the single period at ``at`` end a sentence, if ``nxt`` is the next character that is no space?"""
    t = _token(text, at)
    ch = text[nxt]
    if not t:
        return True
    low = t.lower()
    if t[-1].isdigit():
        return True
    if low == "st" and not ch.isdigit():  # saint before a name, street after a number and a name
        word = re.match(r"\w+", text[nxt : nxt + 30])
        if word and word.group().lower() in STARTERS:
            return True
        return re.search(r"(?<![\d.])\d+\s[A-Z][a-z]+\s$", text[max(0, at - 40) : at - len(t)]) is not None and word is not None
    if low == "m" and re.search(r"(?<!\w)[ap]\.\s+$", text[max(0, at - 6) : at - 1]):
        return True
    short = "." in low or _SHORT.fullmatch(t) is not None and not ("가" <= t[-1] <= "힣")
    kind = doc.kind(t) if short else None
    if kind in ("before", "reference"):
        return False
    if kind == "number":
        return not ch.isdigit()
    if kind == "after":
        return True
    if len(t) == 1 and t.isalpha():
        return not (t.isupper() or "؀" <= t <= "ۿ" or t in "pn")
    if "." in low:
        if ch.isdigit():
            return False
        word = re.match(r"\w+", text[nxt : nxt + 30])
        return not (word and doc.name(word.group())) if low.replace(".", "").isalpha() and all(len(x) <= 2 for x in low.split(".")) else True
    if kind == "abbreviation":
        word = re.match(r"\w+", text[nxt : nxt + 40])
        return not (word and doc.name(word.group()))
    return True


def _joined(text: str, at: int, e: int, mark: str, s: str, ch: str) -> bool:
    """Without a gap after a terminator: may a sentence begin right there?"""
    if ch in CLOSERS or ch in TERMINATORS or ch in ",;:":
        return False
    if mark in DANDA:
        return True
    if not (ch.isupper() or ch.isdigit() or ch in "“«¿¡($‘—" or (ch > "\u05ff" and ch.isalpha())):
        return False
    if mark != "." or len(s) > 1:
        return ch.isupper() or ch in "“«¿¡‘—" or mark != "." and ch > "\u05ff" and s[-1] in TERMINATORS and not "가" <= ch <= "힣"
    t = _token(text, at)
    low = t.lower()
    if low in ("a.m", "p.m"):
        return not ch.isdigit()
    if "@" in t or "." in t.strip("."):
        return t[-1:].isdigit() and ch.isalpha()
    if len(t) < 2 or ch.isdigit() and (t[-1].isdigit() or low in BEFORE or low in MONTHS):
        return False
    return True


def _cut(doc: Document, text: str, start: int, end: int, out: list[int]) -> None:
    """Starts of the sentences of one block, appended to ``out``."""
    out.append(start)
    for m in _CANDIDATE.finditer(text, start, end):
        s = m.group()
        e = m.end()
        first = s[0]
        if e >= end:
            break
        quoted = first in QUOTES and len(s) > 1
        if quoted:
            inner = s[:-1].rstrip()
            if inner[-1] not in TERMINATORS:
                continue
            mark = inner[-1]
        elif first.isdigit():
            continue
        else:
            mark = s.rstrip(CLOSERS)[-1] if s[-1] not in TERMINATORS else s[-1]
        nxt = _SPACE.match(text, e, end).end()
        if nxt >= end:
            break
        ch = text[nxt]
        if mark in WIDE or (mark == "…" and ch > "⺀"):
            if quoted and (ch in CARRY_ON or ch in TERMINATORS):
                continue
            if ch in "，、；：,;:)）」』”":
                continue
            out.append(nxt)
            continue
        if nxt == e and not _joined(text, m.start(), e, mark, s, ch):
            continue
        if ch.islower():
            if not (nxt + 1 < end and text[nxt + 1].isupper()):
                continue
        elif ch in "—–-":
            after = nxt
            while after < end and text[after] in "—–- ":
                after += 1
            if after < end and text[after].islower():
                continue
        elif ch in ",;:%&/)]}،؛" or ch in TERMINATORS:
            continue
        if not quoted and mark == "." and s == "." and not _period_ends(doc, text, m.start(), nxt):
            continue
        out.append(nxt)


def _cut_thai(text: str, start: int, end: int, out: list[int]) -> None:
    """Thai has no terminators: a gap divides unless a number stands on one side of it, or a title or list word."""
    out.append(start)
    for m in _THAI_GAP.finditer(text, start, end):
        a, b = text[m.start() - 1], text[m.end()] if m.end() < end else ""
        if not b:
            break
        before = text[max(start, m.start() - 8) : m.start()]
        if b.isdigit() or (a.isdigit() and (b == "ๆ" or "฀" <= b <= "๿") and re.search(r"(?:^|\s)[\d.,]+$", before)):
            continue
        if a in ",:" or b in "ๆ)”" or before.endswith(("ดร.", "น.ส.", "นาย", "นาง")):
            continue
        out.append(m.end())


def _blocks(text: str, thai: bool) -> Iterator[tuple[int, int, bool]]:
    """(start, end, whole): paragraphs, with list entries and headings as blocks of their own; ``whole`` blocks are one unit."""
    at = 0
    spans = []
    for m in _BLANK.finditer(text):
        spans.append((at, m.start()))
        at = m.end()
    spans.append((at, len(text)))
    for a, b in spans:
        a = _SPACE.match(text, a, b).end()
        while b > a and text[b - 1].isspace():
            b -= 1
        if a >= b:
            continue
        if "\n" not in text[a:b]:
            m = _MARK.match(text, a, b)
            last = text[b - 1]
            plain = b - a <= HEADING_CHARS and last not in TERMINATORS and last not in CLOSERS and not (thai and _THAI.search(text, a, b))
            yield a, b, plain or bool(m and _is_mark(m, None, True))
            continue
        start, listed, number = a, False, None
        line = a
        closed = True
        while line < b:
            stop = text.find("\n", line, b)
            stop = b if stop < 0 else stop
            m = _MARK.match(text, line, stop)
            body = text[line:stop].strip()
            if m and _is_mark(m, number, closed or listed):
                if line > start:
                    yield start, line, listed
                start, listed = _SPACE.match(text, line, b).end(), True
                number = int(m.group(1)) if m.group(1) else number
            elif listed and body and (not body[0].islower() or body[1:2].isupper()):
                yield start, line, True
                start, listed = _SPACE.match(text, line, b).end(), False
            closed = bool(body) and (body[-1] in TERMINATORS or body[-1] in CLOSERS or body[-1] == ":")
            line = stop + 1
        yield start, b, listed


def _is_mark(m: re.Match, number: int | None, closed: bool) -> bool:
    """A bullet or letter mark after a closed line; a number only if it is the first or follows the one before."""
    if not closed:
        return False
    return m.group(1) is None or int(m.group(1)) == (number or 0) + 1


def _starts(text: str, learned: dict[str, str] | None, thai: bool) -> list[int]:
    doc = Document(text, learned)
    out: list[int] = []
    for a, b, whole in _blocks(text, thai):
        if whole:
            out.append(a)
        elif thai and _THAI.search(text, a, b) and not re.search(r"[A-Za-zÀ-ӿऀ-ॿ぀-鿿가-힣؀-ۿ]", text[a:b]):
            _cut_thai(text, a, b, out)
        else:
            _cut(doc, text, a, b, out)
    return out


def starts(text: str, learned: dict[str, str] | None = None) -> list[int]:
    """Positions (from 0) at which the units of ``text`` begin; runs of Thai inside other text are cut by the Thai rule."""
    thai = not text.isascii() and _THAI.search(text) is not None
    out = _starts(text, learned, thai)
    if not thai:
        return out
    more = set(out)
    for m in re.finditer(r"[฀-๿][฀-๿\d.,\s]*[฀-๿\d]\.?", text):
        own: list[int] = []
        _cut_thai(text, m.start(), m.end(), own)
        more.update(own[1:])
        rest = _SPACE.match(text, m.end()).end()
        if m.end() < rest < len(text) and not text[rest].islower():
            more.add(rest)
        if m.start() and text[m.start() - 1].isspace():
            more.add(m.start())
    return sorted(more)


# ------------------------------------------------------------------ corpus fallback


def form(t: str) -> str:
    """A token as it is counted: without regard to case, but for single letters (M. Roux, 5 p. m.)."""
    return t if len(t) == 1 else t.lower()


def follows(mark: str, end: str, ch: str, rest: str) -> str:
    """What follows a token with its period: l lower case or a mark, d a number, s a word that begins sentences, u another capital, o another letter, e an end."""
    if mark or ch.islower() and not rest[:1].isupper():
        return "l"
    if end:
        return "e"
    if ch.isdigit():
        return "d"
    if ch.isupper():
        return "s" if len(rest.rstrip(",.")) > 0 and (ch + rest).lower().rstrip(",.") in STARTERS else "u"
    return "o" if ch.isalpha() else "l"


def _bare_forms(bare: Counter) -> Counter:
    """(token, "b") -> n of tokens counted as they are spelled."""
    out: Counter = Counter()
    for t, n in bare.items():
        out[form(t), "b"] += n
    return out


def corpus_evidence(documents: DataFrame) -> dict[str, str]:
    """token -> before, reference, number, after or abbreviation (see ``Document.kind``), for the short tokens that behave as abbreviations over all documents.

    Every document and every token is counted, those of the lists and those of documents
    without a period too, so the way rows are divided over tasks does not matter.  A token that
    stands nearly always with its period, or before a number, is an abbreviation; what
    follows it, and how often it closes a line or stands before a word that begins
    sentences, says of which sort.  Shares decide, so the size of the corpus does not.
    Counts combine before the shuffle.  Only abbreviations come to the driver: there are
    as many as the languages of the corpus have of up to six letters, not as many as words.
    """

    def told(n: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in n], pa.string()), pa.array([k[1] for k in n], pa.string()), pa.array(list(n.values()), pa.int64())], names=["token", "kind", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        bare: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                bare.update(_BARE.findall(t))
                if "." in t:
                    for token, mark, end, ch, rest in _EVIDENCE.findall(t):
                        n[form(token), follows(mark, end, ch, rest)] += 1
            if len(bare) + len(n) > HELD_TOKENS:
                yield told(n + _bare_forms(bare))
                bare.clear()
                n.clear()
        yield told(n + _bare_forms(bare))

    c = documents.where("text <> ''").select("text").mapInArrow(run, "token string, kind string, n bigint")
    of = lambda k: F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0))
    g = c.groupBy("token").agg(*(of(k).alias(k) for k in "ldusoeb")).withColumn("n", F.expr("l + d + u + s + o + e")).where(F.col("n") >= MIN_EVIDENCE)
    share = lambda x: F.col("n") * F.lit(x)
    most = F.col("d") >= share(MOST)
    abbreviated = (F.col("n") >= MOST * (F.col("n") + F.col("b"))) | most
    ends = (F.col("s") + F.col("e") > share(HARDLY)) | (F.col("s") > 0.1 * (F.col("s") + F.col("u")))
    kind = (
        F.when(~ends & most, "reference").when(~ends & (F.col("u") + F.col("d") + F.col("o") >= share(HARDLY)), "before").when(~ends, "abbreviation").when(F.col("d") >= share(SOME), "number")
        .when(F.col("l") >= share(HARDLY), "after")
    )
    g = g.where(abbreviated)
    rows = g.select("token", kind.alias("kind")).where("kind is not null").collect()
    return {r.token: r.kind for r in rows}


def units(documents: DataFrame, learned: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, start_pos, end_pos): every sentence, heading and list entry of every document.

    Positions are characters counted from 1; ``end_pos`` is the last character that is no
    space.  Null and blank texts have no units.  Equal texts are cut alike under each id.
    ``learned`` is the evidence of ``corpus_evidence``; it is computed if not given.
    """
    docs = documents.where("text <> ''").select(F.col("doc_id").cast("long"), "text")
    known = corpus_evidence(docs) if learned is None else learned

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, begin, end = [], [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = starts(t, known)
                ids += [i] * len(s)
                begin += [x + 1 for x in s]
                end += [len(t[a:b].rstrip()) + a for a, b in zip(s, [*s[1:], len(t)])]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(begin, pa.int64()), pa.array(end, pa.int64())], names=["doc_id", "start_pos", "end_pos"])

    return docs.mapInArrow(run, "doc_id bigint, start_pos bigint, end_pos bigint")
