"""Noise in text from scanned pages: find it, name it, and repair the text.

Three steps per text, all scored by one averaged perceptron.  Furniture: numbers in print
form, and running headers learned from the lines they share with page numbers over the
whole corpus, are candidates; features of their place on the page (alone on a line, first
or last of the text, what stands before and after) decide which are taken out.  Joins and
characters: operations turn the text as read into the text as written.  At every gap that may be
a cut it scores *join* against leaving the gap; at every position of a word it scores
*keep*, *replace*, *insert* and *delete*, as sequences that lead to a known word or undo
characters that stand in no word.  Counts of the whole corpus are features; no operation
is made that the model does not score above leaving things as they are.

Word counts cover all different texts.  The most frequent words are held in memory, at most a fixed
number of them; the rest lie in an indexed file on every node, so no known word is left out.
"""

from __future__ import annotations

import math
import operator
import pickle
import random
import re
import sqlite3
import sys
import tempfile
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cache
from itertools import repeat

import ahocorasick
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words known: those that occur MIN_COUNT times. The MAX_WORDS most frequent are held in memory, the rest are looked up in a file.
MIN_COUNT, MAX_WORDS = 3, 1_000_000
#: Words that look like one this many times as frequent are no examples to train on.
SUSPECT_RATIO = 12
#: Words of which the examples are held in memory at once while training; all known words are trained on.
TRAINING_WORDS = 3_000
#: Pieces of page furniture put into all texts for training, together; more texts take one each.
PIECES = 20_000
EPOCHS = 5
#: Readings of one word that are followed side by side.
BEAM = 64
#: A running header is kept if this many different texts, and this share of all different texts that hold it, show it beside a page number.
MIN_HEADER, HEADER_SHARE = 3, 0.05

#: Characters, as written, and what scanners make of them.
LOOK_ALIKE = (
    ("o", "0"), ("O", "0"), ("D", "0"), ("l", "1"), ("i", "1"), ("I", "1"), ("e", "c"), ("a", "ä"), ("t", "†"), ("s", "5"), ("S", "5"),
    ("b", "6"), ("G", "6"), ("B", "8"), ("A", "4"), ("T", "7"), ("E", "F"), ("L", "|"), ("I", "|"), ("l", "|"), ("g", "9"), ("Z", "2"), ("z", "2"),
    ("u", "ii"), ("m", "rn"), ("h", "li"), ("rn", "m"), ("cl", "d"), ("d", "cl"), ("w", "vv"), ("W", "VV"), ("nn", "m"), ("li", "h"), ("ii", "u"),
    ("N", "I\\I"), ("M", "IVI"), ("M", "IVl"), ("fi", "ﬁ"), ("fl", "ﬂ"), ("H", "I-I"), ("c", "e"), ("F", "E"), ("q", "g"), ("O", "Q"), ("C", "G"), ("C", "("), ("c", "("),
)
#: Characters that stand in no word as written here.
ODD = frozenset("0123456789ä†ﬁﬂ\\|(")

_SEEN: dict[str, list[str]] = defaultdict(list)
for _true, _seen in LOOK_ALIKE:
    _SEEN[_seen].append(_true)
#: Characters that may be read another way, and the feature of leaving one.
_KEEP = {c: f"keep>{c}" for c in [*ODD, *_SEEN] if len(c) == 1}

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
#: A word with its case and any odd characters, as read.
_READ = re.compile(r"(?:[A-Za-zÀ-ÿ0-9†ﬁﬂ\\|]|(?<=[A-Za-z])\((?=[A-Za-z]+\b(?!\))))+")
#: The mark of a cut inside a word, with the spaces and breaks around it.
_CUT = re.compile(r"(?<=[A-Za-zÀ-ÿ0-9†ﬁﬂ])(\s*[\xad¬‐]\s*|-[ \t]*[\r\n\f]\s*|- +(?=[a-zA-Z])| +-(?=[A-Za-z])|\s*[\r\n\f]\s*-\s*)(?=[A-Za-zÀ-ÿ0-9†ﬁﬂ])")
_NUMBER = r"(?:~ ?\d{1,4} ?~|\[\d{1,4}\]|- \d{1,4} -|[Pp]age \d{1,4}(?: of \d{1,4})?|p\. \d{1,4})"
#: Numbers that may be page numbers; the text may also speak of them. Forms that never overlap, each after the characters that a text with one holds; each begins with a fixed character or set, which is searched fast.
_PAGES = (
    ("~", re.compile(r"~(?<![\w.]~) ?\d{1,4} ?~(?!\w)")),
    ("[", re.compile(r"\[(?<![\w.]\[)\d{1,4}\](?!\w)")),
    (" -", re.compile(r"-(?<![\w.]-)(?:(?<!\w -) \d{1,4} -(?!\d)|(?<=\w -) \d{1,4} -(?=\s))(?!\w)")),
    ("age ", re.compile(r"[Pp](?<![\w.].)age \d{1,4}(?: of \d{1,4})?(?!\w)")),
    ("p. ", re.compile(r"(?<=[\n\f])\s*p\. \d{1,4}(?=\s*(?:[\n\f]|$))(?!\w)")),
)
#: A number alone on the first line, or on another.
_FIRST_ALONE = re.compile(r"[ \t]*(\d{1,4})[ \t]*(?=[\n\f\r]|$)")
_ALONE = re.compile(r"[\n\f\r][ \t]*(\d{1,4})[ \t]*(?=[\n\f\r]|$)")
_DASHED = re.compile(r"- \d+ -")
#: Where a line may hold a number alone.
_LINES_ALONE = (re.compile(r"[\n\r\f]\s*(?:p\. )?\d+\s*[\n\r\f]").search, re.compile(r"\s*\d+\s*[\n\r\f]").match, re.compile(r"[\n\r\f]\s*\d+\s*$").search)
_SAYS_PAGE = re.compile(r"[Pp]age \d+(?: of \d+)?")
_MARKED = re.compile(r"\W ?\d+ ?\W|- \d+ -|p\. \d+")
_OF_THE = re.compile(r"\s*[Oo]f [Tt]he\b")
#: What stands before a page that the text speaks of, or after it.
_SPOKEN = re.compile(r"\b(?:see|per)\s*$", re.IGNORECASE)
_PART = re.compile(r"[A-Za-zÀ-ÿ0-9†ﬁﬂ\\|]")
_TAIL = re.compile(r"[A-Za-zÀ-ÿ0-9†ﬁﬂ\\|]*$")
_HEAD = re.compile(r"[A-Za-zÀ-ÿ0-9†ﬁﬂ\\|]*")
_CODE = re.compile(r"[A-Z]{1,3}-\d+\S*")
_SAFE = re.compile(r"\d[\d,]*[.;:,)]*|\d+-\d+[.,;]*|[A-Z]{1,3}-\d+[.,;]*|\d+(?:st|nd|rd|th)[.,;]*|-")
_SIMPLE = re.compile(r"\(?[A-Za-z]+(?:['’][a-z]+)?(?:-[A-Za-z]+)*-?[.,;:)]*|(?:[A-Z]\.)+")
_LETTERS = re.compile(r"[A-Za-z]+")
_LINE = re.compile(r"[\r\n\f]+")


def header_key(line: str) -> str:
    """A line without its page number, other numbers as one sign, blanks as one."""
    s = re.sub(rf"^\s*(?:{_NUMBER}|\d{{1,4}} \||\d{{1,4}}(?=\s{{2,}}))\s*|\s*(?:{_NUMBER}|\| \d{{1,4}}|(?<=\s\s)\d{{1,4}})\s*$", "", line)
    return re.sub(r"\s+", " ", re.sub(r"\d+", "#", s)).strip()


#: A page number that opens or closes a line; in running text ("see page 14 of the") it does neither.
_OPENS = re.compile(rf"\s*(?:(?!page){_NUMBER}(?=\s)(?!\s+[Oo]f [Tt]he\b)|page \d{{1,4}}(?=\s{{2,}})|\d{{1,4}} \| |\d{{1,4}}(?=\s{{2,}}))")
_CLOSES = re.compile(rf"(?:(?<=\s)(?!page){_NUMBER}|(?<=\s\s)page \d{{1,4}}|(?<=\S)\s{{2,}}\d{{1,4}}| \| \d{{1,4}})\s*$")
_CITED = re.compile(r"\b(?:see|per)\s*$", re.IGNORECASE)
_CUT_OFF = re.compile(r"[-\xad¬‐]\s*$")


def header_candidates(text: str) -> set[str]:
    """Lines of their own, among others, that a page number in print form opens or closes beside other words.

    A line that holds half of a cut word belongs to the text.
    """
    out: set[str] = set()
    lines = [x for x in _LINE.split(text) if x.strip()]
    for before, line in zip(["", *lines], lines if len(lines) > 1 else []):
        last = line.rstrip()[-1]
        end = _CLOSES.search(line) if last in "~]-" or last.isdecimal() else None  # no page number ends otherwise
        if not (end or _OPENS.match(line)) or _CUT_OFF.search(before):
            continue
        if _OPENS.match(line) or not _CITED.search(line[: end.start()]):
            key = header_key(line)
            if 2 <= len(key.split()) <= 10 and key[0].isupper() and not re.search(r"[.,;]$", key) and not _CUT_OFF.search(key) and key != line.strip():
                out.add(key)
    return out


def _longest_word(header: str) -> str:
    return max(re.split(r"[\d#\s]+", header), key=len)


def header_texts(texts: DataFrame, headers: list[str]) -> DataFrame:
    """(word, n): in how many different ones of ``texts`` each header stands, with or without a page number."""
    by_word: dict[str, list[tuple[str, re.Pattern]]] = defaultdict(list)
    for h in headers:
        by_word[_longest_word(h)].append((h, re.compile(rf"(?<!\w){re.escape(h)}(?!\w)")))
    shared = texts.sparkSession.sparkContext.broadcast(dict(by_word))

    def held(batches: Iterator[pa.RecordBatch], each: bool) -> Iterator[pa.RecordBatch]:
        find = ahocorasick.Automaton()
        for w in shared.value:
            find.add_word(w, w)
        find.make_automaton()
        for b in batches:
            hits, n = [], Counter()
            for t in b.column(0).to_pylist():
                words = {w for _, w in find.iter(t)}
                if words and each:
                    flat = re.sub(r"\s+", " ", re.sub(r"\d+", "#", t))
                    n.update(h for w in words for h, pattern in shared.value[w] if pattern.search(flat))
                elif words:
                    hits.append(t)
            if each:
                yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["word", "n"])
            else:
                yield pa.RecordBatch.from_arrays([pa.array(hits, pa.string())], names=["text"])

    some = texts.mapInArrow(lambda it: held(it, False), "text string").distinct()
    return some.mapInArrow(lambda it: held(it, True), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


#: The mark of a cut, and the letters after it; the first character is of a fixed set, which is searched fast.
_CUT_ON = re.compile(r"[\s\-\xad¬‐](?:(?<=\s)\s*[\xad¬‐]\s*|(?<=[\xad¬‐])\s*|(?<=-)\s*[\r\n\f]\s*|(?<= )-(?=\w)|(?<=-) )[^\W\d_]*")


def _without_cuts(text: str) -> str:
    """The text without the marks of cuts and the letters on both sides of them."""
    out, last = [], 0
    for m in _CUT_ON.finditer(text):
        at = m.start()
        while at > last and text[at - 1].isalnum() and not text[at - 1].isdecimal():
            at -= 1
        out.append(text[last:at])
        last = m.end()
    out.append(text[last:])
    return " ; ".join(out)


def tokens_of(text: str) -> list[str]:
    """Lower-case tokens that do not stand beside the mark of a cut."""
    text = text.replace(" - ", " ; ").lower()
    if "- " in text or " -" in text or "-\n" in text or "-\r" in text or not text.isascii():
        text = _without_cuts(text)
    return text.split()


def words_of(tokens: Mapping[str, int]) -> Counter:
    """Words of counted tokens, with their counts: each different token is taken apart once."""
    out: Counter = Counter()
    for t, n in tokens.items():
        for w in _WORD.findall(t):
            if len(w) > 1:
                out[w] += n
    return out


def _tail(text: str, start: int, end: int) -> str:
    """The word characters that end at ``end``, not before ``start``."""
    at = end
    while at > start and _PART.match(text[at - 1]):
        at -= 1
    return text[at:end]


class Counts(dict):
    """word -> n: the most frequent words as a dict, all others in a table of the file ``rest``, which Spark sends to every node."""

    def __init__(self, frequent: dict[str, int], rest: str) -> None:
        super().__init__(frequent)
        self.rest, self.table = rest, None
        self.memo: dict[str, int] = {}

    def __reduce__(self) -> tuple:
        return Counts, (dict(self), self.rest)

    def get(self, word: str, default: int = 0) -> int:
        n = super().get(word)
        if n is None:
            n = self.memo.get(word)
        if n is None:
            if self.table is None:
                self.table = sqlite3.connect(f"file:{SparkFiles.get(self.rest)}?mode=ro", uri=True, check_same_thread=False)
            if len(self.memo) > 500_000:
                self.memo.clear()
            row = self.table.execute("select n from words where word = ?", (word,)).fetchone()
            n = self.memo[word] = row[0] if row else 0
        return n or default

    def everything(self) -> Iterator[tuple[str, int]]:
        """Every word with its count, those of the file too."""
        yield from self.items()
        yield from sqlite3.connect(SparkFiles.get(self.rest)).execute("select word, n from words")

    def __contains__(self, word: object) -> bool:
        return self.get(word) > 0


def all_counts(words: DataFrame) -> dict[str, int]:
    """word -> n for every row of ``words`` (word, n), with at most MAX_WORDS of them in memory."""
    least, held = 0, 0
    if words.count() > MAX_WORDS:
        for r in words.groupBy("n").agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("n")).toLocalIterator():
            held += r.c
            if held > MAX_WORDS:
                least = r.n + 1
                break
    frequent = {r.word: r.n for r in words.where(F.col("n") >= least).toLocalIterator()}
    if not least:
        return frequent
    with tempfile.NamedTemporaryFile(prefix="fundlens-words-", suffix=".db", delete=False) as f:
        path = f.name
    table = sqlite3.connect(path)
    table.execute("create table words (word text primary key, n integer) without rowid")
    rest = words.where(F.col("n") < least).orderBy("word")
    table.executemany("insert into words values (?, ?)", ((r.word, r.n) for r in rest.toLocalIterator()))
    table.commit()
    table.close()
    words.sparkSession.sparkContext.addFile(path)
    return Counts(frequent, path.rpartition("/")[2])


@dataclass
class Model:
    counts: dict[str, int]
    headers: list[str]
    weights: dict[str, float] = field(default_factory=dict)
    bigrams: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.memo: dict[str, tuple[str, int]] = {}
        self.plain: dict[str, str] = {}
        #: token -> its last word as the end or the start of a word in two tokens; a sign that no word holds where there is none
        self.ends: dict[str, str] = {}
        self.starts: dict[str, str] = {}
        self.halves: dict[tuple[str, str], bool] = {}
        #: by what the features of a join or a place are made of: are its weights above 0
        self.taken: dict[tuple, bool] = {}
        self.automaton = ahocorasick.Automaton()
        self.by_word: dict[str, list[str]] = defaultdict(list)
        self.header_re: dict[frozenset[str], re.Pattern] = {}
        for h in self.headers:
            self.by_word[_longest_word(h)].append(h)
        for w in self.by_word:
            self.automaton.add_word(w, w)
        if self.headers:
            self.automaton.make_automaton()

    def count(self, word: str) -> int:
        return self.counts.get(word.lower().replace("’", "'"), 0)

    # ---------------------------------------------------------------- furniture

    def headers_in(self, text: str) -> list[tuple[int, int]]:
        """Spans of running headers with their page numbers; only those are tried whose longest word is there."""
        words = frozenset([w for _, w in self.automaton.iter(text)]) if self.headers else None
        if not words:
            return []
        pattern = self.header_re.get(words)
        if pattern is None:
            if len(self.header_re) > 2_000:
                self.header_re.clear()
            tried = sorted((h for w in words for h in self.by_word[w]), key=lambda h: (-len(h), h))
            parts = [r"\s+".join(re.escape(w).replace(r"\#", r"\d{1,4}").replace("#", r"\d{1,4}") for w in h.split()) for h in tried]
            n = rf"(?:{_NUMBER}|\d{{1,4}} \||\| \d{{1,4}}|\d{{1,4}}(?=\s|$))"
            pattern = self.header_re[words] = re.compile(rf"(?<!\w)(?:{n}\s+)?(?:{'|'.join(parts)})(?:\s+{n})?(?!\w)")
        return [m.span() for m in pattern.finditer(text)]

    def furniture(self, text: str) -> list[tuple[int, int]]:
        """Spans of running headers and page numbers: the candidates that the model takes for such by their form and place."""
        return [(a, b) for a, b in self.furniture_candidates(text) if self.takes(_place(text, a, b), _place_features)]

    def takes(self, seen: tuple, features: Callable[..., list[str]]) -> bool:
        """Does the model say yes to what is ``seen``, by its ``features``?  Few different things are seen, so each is scored once."""
        yes = self.taken.get(seen)
        if yes is None:
            yes = self.taken[seen] = self.score(features(*seen)) > 0
        return yes

    def place_features(self, text: str, a: int, b: int) -> list[str]:
        """Of a candidate: its form, its place on the page, and its neighbours."""
        return _place_features(*_place(text, a, b))

    def furniture_candidates(self, text: str) -> list[tuple[int, int]]:
        spans = self.headers_in(text)
        for held, form in _PAGES:
            if held in text:
                spans += [m.span() for m in form.finditer(text)]
        if "\n" in text or "\f" in text:  # a number alone on its line, between lines of running text
            first = _FIRST_ALONE.match(text)
            if first:
                spans.append(first.span(1))
            spans += [m.span(1) for m in _ALONE.finditer(text, first.end() if first else 0)]
        if len(spans) < 2:
            return spans
        spans.sort()
        out: list[tuple[int, int]] = []
        for a, b in spans:
            if out and a <= out[-1][1] + 1 and not text[out[-1][1] : a].strip():
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            elif not out or a >= out[-1][1]:
                out.append((a, b))
        return out

    # ---------------------------------------------------------------- editor

    def features(self, read: str, edits: tuple[tuple[int, str, str], ...], result: str, known: bool = True, own: int | None = None) -> list[str]:
        """Of one way to read a word: its operations with their surroundings, and what the result is."""
        n = len(read)
        f = []
        kind = lambda c: "^" if c in "^$" else "d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "o"
        for at, seen, true in edits:
            left, right = read[at - 1 : at] or "^", read[at + len(seen) : at + len(seen) + 1] or "$"
            op = "replace" if len(seen) == len(true) else "insert" if len(true) > len(seen) else "delete"
            f += [f"{op}", f"{seen}>{true}", f"{seen}>{true}|{kind(left)}{kind(right)}", f"{op}|{'odd' if set(seen) & ODD else 'letter'}"]
        touched = {i for at, seen, _ in edits for i in range(at, at + len(seen))}
        f += [_KEEP[c] for i, c in enumerate(read) if c in _KEEP and i not in touched]  # positions where another operation was possible
        if not edits:
            f.append("keep")
            f.append("keep|odd" if set(read) & ODD else "keep|letters")
        f.append(f"edits={min(len(edits), 3)}")
        a, b = (self.count(read) if own is None else own, self.count(result)) if known else (0, 0)
        b = a if not edits else b
        f.append(f"known={min(6, int(math.log2(1 + b)))}" if b else "known=0")
        if edits:
            ratio = max(-2, min(7, int(2 * math.log2((1 + b) / (1 + a))) // 2)) if known else 0
            sort = "odd" if set(read) & ODD else "letters"
            f += [f"ratio>={k}|{sort}" for k in range(-1, ratio + 1)]  # what holds of a ratio holds of a larger one
        case = "U" if result.isupper() else "T" if result[:1].isupper() and result[1:].islower() else "L" if result.islower() else "X"
        f += [f"case={case}", f"odd={len(set(result) & ODD) > 0}", f"lm={int(2 * self.fluency(result))}", f"short={n < 5}"]
        return f

    def fluency(self, word: str) -> float:
        """Mean log-probability of its letter pairs, from 0 down to -6."""
        w = f"^{word.lower()}$"
        return max(-6.0, sum(map(self.bigrams.get, map(operator.add, w, w[1:]), repeat(-6.0))) / (len(w) - 1))

    def readings(self, read: str) -> Iterator[tuple[tuple[tuple[int, str, str], ...], str]]:
        """(edits, result): the word as it is, and with look-alikes undone.

        Odd characters are undone all at once, with at most one letter besides; a word of
        letters only has at most two places changed in one pass.
        """
        yield (), read
        upper = read.isupper() or sum(c.isupper() for c in read) > sum(c.islower() for c in read)
        spots = []
        for i in range(len(read)):
            for k in (1, 2, 3):
                s = read[i : i + k]
                if len(s) == k and s in _SEEN:
                    spots += [(i, s, t) for t in _SEEN[s] if t.isupper() == upper or i == 0 and t.isupper()]
        odd = [x for x in spots if set(x[1]) & ODD]
        plain = [x for x in spots if not set(x[1]) & ODD]
        seen = {read}

        def made(edits: tuple) -> str:
            result, last = "", 0
            for at, x, y in edits:
                result += read[last:at] + y
                last = at + len(x)
            return result + read[last:]

        def apart(x: tuple, y: tuple) -> bool:
            return x[0] + len(x[1]) <= y[0]

        bases: list[tuple] = [()]
        if odd:
            places = [i for i, c in enumerate(read) if c in ODD]
            for at in places:
                grown = []
                for e in bases:
                    if any(x[0] <= at < x[0] + len(x[1]) for x in e):
                        grown.append(e)
                    else:
                        grown += [(*e, x) for x in odd if x[0] <= at < x[0] + len(x[1]) and (not e or apart(e[-1], x))]
                bases = grown or bases
                if len(bases) > BEAM:  # the likeliest by what is known of them so far
                    bases.sort(key=lambda e: -self.fluency(made(e)))
                    del bases[BEAM:]
            for e in bases:
                r = made(e)
                if e and r not in seen:
                    seen.add(r)
                    yield e, r
            if any(e and self.count(made(e)) for e in bases):
                return
        for e in bases:
            for k, x in enumerate(plain):
                one = tuple(sorted((*e, x)))
                if all(apart(u, v) for u, v in zip(one, one[1:])):
                    r = made(one)
                    if r not in seen:
                        seen.add(r)
                        yield one, r
                    if odd:
                        continue
                    for y in plain[k + 1 :]:
                        if apart(x, y):
                            r = made((x, y))
                            if r not in seen and self.count(r):
                                seen.add(r)
                                yield (x, y), r

    def candidates(self, read: str) -> Iterator[tuple[tuple[tuple[int, str, str], ...], str]]:
        """The readings that are scored: of a word of letters only those that are known words, and the word itself."""
        odd = any(c in ODD for c in read)
        return ((e, r) for e, r in self.readings(read) if odd or not e or self.count(r))

    def score(self, features: Iterable[str]) -> float:
        return sum(map(self.weights.get, features, repeat(0.0)))

    def edit(self, read: str) -> tuple[str, int]:
        """(word as written, operations other than keep)."""
        got = self.memo.get(read)
        if got is None:
            if len(self.memo) > 500_000:
                self.memo.clear()
            got = self.memo[read] = self._edit(read)
        return got

    def _edit(self, read: str) -> tuple[str, int]:
        """One pass of the editor, and more while the result is still far from a frequent word."""
        word, edits = self._once(read)
        for _ in range(3):
            if not edits:
                break
            again, more = self._once(word)
            if not more:
                break
            word, edits = again, edits + more
        return word, edits

    def _once(self, read: str) -> tuple[str, int]:
        letters = sum(c.isalpha() for c in read)
        odd = any(c in ODD for c in read)
        if letters < 2 or letters < len(read) / 2 and not re.search(r"[a-zA-Z]{2}", read) or re.fullmatch(r"\d+(?:st|nd|rd|th|s)", read):
            return read, 0
        if not odd and len(read) < 3:
            return read, 0
        ways = list(self.candidates(read))
        if len(ways) == 1:  # the word as it is
            return read, 0
        own = self.count(read)
        best, result, edits = -1e18, read, ()
        for e, r in ways:
            s = self.score(self.features(read, e, r, True, own))
            if s > best:
                best, result, edits = s, r, e
        return result, len(edits)

    # ---------------------------------------------------------------- whole texts

    def join_features(self, a: str, mark: str, b: str, counts: tuple[int, int, int, int] | None = None) -> list[str]:
        """Of joining ``a`` and ``b`` over ``mark``; ``counts``: of a, b, the whole, and what a lone half may be misread for (else looked up)."""
        return _join_features(*self.join_seen(a, mark, b, counts))

    def join_seen(self, a: str, mark: str, b: str, counts: tuple[int, int, int, int] | None = None) -> tuple:
        """What the features of a join are made of."""
        if counts is None:
            ca, cb, n, lone = self.count(a), self.count(b), self.count(a + b), 0
            if not n and not (ca and cb):
                fixed, edits = self.edit(a + b)
                n = self.count(fixed) if edits else 0
            if mark == " " and (not ca) != (not cb):  # one half alone may itself be a word misread
                half = b if ca else a
                fixed, edits = self.edit(half)
                lone = self.count(fixed) if edits else 0
        else:
            ca, cb, n, lone = counts
        kind = "blank" if mark == " " else "soft" if any(c in mark for c in "\xad¬‐") else "line" if re.search(r"[\r\n\f]", mark) else "hyphen"
        ratio = max(-3, min(5, int(2 * math.log2((1 + n) / (1 + min(ca, cb)))) // 2)) if n else None
        return kind, n > 0, ca > 0, cb > 0, len(b) <= 2, ratio, b[:1].isupper() and not a.isupper(), lone and ("less" if lone < n else "more"), len(a) + len(b) < 4

    def joins(self, a: str, mark: str, b: str) -> bool:
        """Does the model join ``a`` and ``b``, halves around a mark or a blank?"""
        if mark == " " and (a.isdigit() or b.isdigit()):
            return False
        return self.takes(self.join_seen(a, mark, b), _join_features)

    def are_halves(self, a: str, b: str) -> bool:
        """Does the model join two tokens with nothing but a blank between them?"""
        yes = self.halves.get((a, b))
        if yes is None:
            if len(self.halves) > 200_000:
                self.halves.clear()
            yes = self.halves[a, b] = self._are_halves(a, b)
        return yes

    def _are_halves(self, a: str, b: str) -> bool:
        low, after = self.last_word(a), self.last_word(b)
        if a[-1:] in ".,;:)-" if not low else after and after != "!" and low != "!" and low + b.lower().strip(".,;:)") not in self.counts:
            return False
        ma, mb = _TAIL.search(a).group(), _HEAD.match(b).group()
        return bool(ma and mb) and self.joins(ma, " ", mb)

    def clean(self, text: str) -> str | None:
        """The text with single blanks if every token of it is trusted and no two together make a known word."""
        tokens = text.split()
        try:
            starts = list(map(self.starts.__getitem__, tokens))
        except KeyError:
            for t in tokens:
                if t not in self.starts:
                    self.last_word(t)
            starts = list(map(self.starts.__getitem__, tokens))
        if "!" in starts:
            return None
        together = map(operator.add, map(self.ends.__getitem__, tokens), starts[1:])
        if not self.counts.keys().isdisjoint(together) if type(self.counts) is dict else any(map(self.counts.__contains__, together)):
            return None
        return " ".join(tokens)

    def _plain(self, t: str) -> str:
        """"!" for a token to look at; else its last word in lower case, empty if it has none."""
        if _SAFE.fullmatch(t):
            return ""
        if not _SIMPLE.fullmatch(t):
            return "!"
        if t.endswith("-"):
            return ""
        parts = _LETTERS.findall(t)
        for w in parts:
            if len(w) > 1 and (not self.count(w) or self.edit(w)[1]):
                return "!"
        return parts[-1].lower()

    def has_furniture(self, text: str) -> bool:
        """May there be any? Looks for a piece of a header, for a number in print form or alone on a line."""
        if "Page " in text or "page " in text or "~" in text or "[" in text or "- " in text and _DASHED.search(text):
            return True
        if self.headers and next(self.automaton.iter(text), None) is not None:
            return True
        return ("\n" in text or "\r" in text or "\f" in text) and any(look(text) for look in _LINES_ALONE)

    def repair(self, text: str) -> tuple[str, set[str]]:
        """(text as it was written, kinds of noise found)."""
        kinds: set[str] = set()
        if len(self.plain) > 500_000:
            for x in (self.plain, self.starts, self.ends):
                x.clear()
        spans = self.furniture(text) if self.has_furniture(text) else []
        if not spans:
            whole = self.clean(text)
            if whole is not None and "- " not in whole.replace(" - ", " "):
                return whole, kinds
        if spans:
            kinds.add("furniture")
            parts, last = [], 0
            for a, b in spans:
                parts.append(text[last:a])
                last = b
            parts.append(text[last:])
            text = parts[0].rstrip()
            for p in parts[1:]:
                gap = " " if p.strip() else ""
                text = text + gap + p.lstrip() if not text[-1:] in "\xad¬‐" else text + p.lstrip()
            text = text.strip()
        if ("-" in text or "\xad" in text or "¬" in text or "‐" in text) and _CUT.search(text):
            out, last = [], 0
            for m in _CUT.finditer(text):
                a = _tail(text, last, m.start())
                if last and len(a) == m.start() - last and out and out[-1] == "":
                    a = _tail(out[-2], 0, len(out[-2])) + a
                b = _HEAD.match(text, m.end()).group()
                if self.joins(a, m.group(), b):
                    kinds.add("broken_word")
                    out += [text[last : m.start()], ""]
                    last = m.end()
            out.append(text[last:])
            text = "".join(out)
        edge = lambda c: [""] if c.isspace() else []
        tokens = edge(text[:1]) + text.split() + edge(text[-1:]) or [""]
        pairs = list(zip(tokens, tokens[1:]))
        found = list(map(self.halves.get, pairs))
        if None in found:
            found = [self.are_halves(*x) if yes is None else yes for x, yes in zip(pairs, found)]
        i = found.index(True) if True in found else len(tokens)
        while i < len(tokens) - 1:
            if self.are_halves(tokens[i], tokens[i + 1]):
                kinds.add("broken_word")
                tokens[i : i + 2] = [tokens[i] + tokens[i + 1]]
            else:
                i += 1
        for i, t in enumerate(tokens):
            if (self.plain.get(t) or self.last_word(t)) == "!":
                fixed, edits = self.token(t)
                if edits:
                    kinds.add("misread")
                tokens[i] = fixed
        return " ".join(tokens), kinds

    def last_word(self, t: str) -> str:
        low = self.plain.get(t)
        if low is None:
            low = self.plain[t] = self._plain(t) if t else ""
            self.starts[t] = low or "\0"
            self.ends[t] = low if low and t[-1].isalpha() else "\0"
        return low

    def token(self, t: str) -> tuple[str, int]:
        """A token with its words edited; codes such as HX-0007 stay."""
        if _CODE.fullmatch(t):
            return t, 0
        n = 0

        def fix(m: re.Match) -> str:
            nonlocal n
            word, edits = self.edit(m.group())
            n += edits
            return word

        return _READ.sub(fix, t), n


def _place(text: str, a: int, b: int) -> tuple:
    """What the features of a piece of furniture at ``a`` to ``b`` are made of."""
    span = text[a:b].strip()
    form = "bare" if span.isdigit() else "page" if _SAYS_PAGE.fullmatch(span) else "mark" if _MARKED.fullmatch(span) else "header"
    before, after = text[:a].rstrip(" \t"), text[b:].lstrip(" \t")
    left = before.rstrip()[-1:]
    first, last = not left, not after or after.isspace()
    opens, closes = first or before[-1] in "\n\r\f", last or after[0] in "\n\r\f"
    spoken = bool(_SPOKEN.search(text[max(0, a - 12) : a])) or _OF_THE.match(text[b : b + 12]) is not None
    kind = "none" if not left else "cut" if left in "-\xad¬‐" else "end" if left in ".;:!?" else "word"
    return form, first, last, opens, closes, spoken, kind, "small" if span[:1].islower() else "other"


@cache
def _place_features(form: str, first: bool, last: bool, opens: bool, closes: bool, spoken: bool, kind: str, case: str) -> list[str]:
    alone = "alone" if opens and closes else "opens" if opens else "closes" if closes else "inside"
    f = ["place", f"place|{form}", f"place|{form}|{alone}", f"place|{form}|{case}|{alone}", f"place|{form}|before={kind}", f"place|spoken={spoken}|{form}", f"place|spoken={spoken}|{form}|{alone}|{case}"]
    if first or last:
        f.append(f"place|{form}|{'first' if first else 'last'}|whole={first and last}")
    return f


@cache
def _join_features(kind: str, whole: bool, known_a: bool, known_b: bool, short: bool, ratio: int | None, case: bool, lone: str | int, tiny: bool) -> list[str]:
    seen = f"{int(whole)}{int(known_a)}{int(known_b)}"
    f = ["join", f"join|{kind}", f"join|{kind}|{seen}", f"join|{kind}|{seen}|short={short}"]
    f += [f"join|{kind}|ratio>={k}" for k in range(-2, ratio + 1)] if whole else []
    if case:
        f += ["join|case", f"join|case|{kind}|{int(whole)}"]
    if lone:
        f.append(f"join|lone={lone}")
    if tiny:
        f.append("join|tiny")
    return f


# ------------------------------------------------------------------ training


def train(model: Model, furniture: Sequence[tuple[list[str], bool, int]] = (), seed: int = 7) -> None:
    """Averaged perceptron over readings of all known words, corrupted with the look-alike table, of cut words, and of page ``furniture`` (features, is it any, times seen).

    Every second example hides the word counts, so the editor also learns from letters alone.
    """
    rng = random.Random(seed)
    known = model.counts.everything() if isinstance(model.counts, Counts) else model.counts.items()
    vocabulary = [w for w, n in sorted(known, key=lambda kv: (-kv[1], kv[0])) if len(w) > 2 and w.isalpha() and w.isascii() and not _suspect(model, w)]
    words = vocabulary
    pairs: Counter = Counter()
    for w in words:
        for i in range(len(w) + 1):
            pairs[f"^{w}$"[i : i + 2]] += 1
    total = sum(pairs.values()) or 1
    model.bigrams = {p: max(-6.0, math.log(n / total) + 6.0 - 6.0) for p, n in pairs.items()}
    weights: dict[str, float] = defaultdict(float)
    sums: dict[str, float] = defaultdict(float)
    model.weights = weights
    order = rng.sample(words, len(words)) if len(words) > TRAINING_WORDS else words
    parts = [order[i : i + TRAINING_WORDS] for i in range(0, len(order), TRAINING_WORDS)] or [[]]
    seen = sum(n for *_, n in furniture)
    # the corpus says in which share each piece is met, not how many there are
    put = [("join", feats, is_any) for feats, is_any, n in furniture for _ in range(max(1, round(n * min(1.0, PIECES / seen))))]

    def asked(read: str, true: str, blind: bool, own: int | None) -> tuple:
        """(features, result) of every reading and the features of the right one; nothing of a word that has no choice, or no right one."""
        ways = list(model.candidates(read))
        if len(ways) == 1 or all(r != true for _, r in ways):
            return "edit", None, None, true
        options = [(list(map(sys.intern, model.features(read, e, r, not blind, own))), r) for e, r in ways]
        return "edit", options, next(f for f, r in options if r == true), true

    def made(k: int) -> list[tuple]:
        """The examples of the k-th part of the words."""
        part, rng = parts[k], random.Random(seed * 1_000_003 + k)
        examples: list[tuple] = []
        for w in part:
            n = model.count(w)
            shape = rng.choice((str.lower, str.title, str.upper))
            true = shape(w)
            examples.append(("edit", true, true, rng.random() < 0.5, None))
            spots = [(i, t, s) for t, s in LOOK_ALIKE for i in range(len(true) - len(t) + 1) if true[i : i + len(t)] == t and (s, t) not in (("e", "c"), ("E", "F"), ("g", "q"))]
            if spots:
                i, t, s = rng.choice(spots)
                read = true[:i] + s + true[i + len(t) :]
                examples.append(("edit", read, true, rng.random() < 0.5, rng.choice((0, 0, n // 20, n // 40))))  # a frequent misreading has a count of its own
                if not set(read) & ODD:  # a word that is not much rarer is another word
                    examples += [("edit", read, read, False, max(1, n // rng.choice((2, 4, 6)))), ("edit", read, read, False, n * rng.choice((1, 5, 40)))]
            examples += _cuts(model, rng, w, words, vocabulary)
        return [asked(*x[1:]) if x[0] == "edit" else x for x in examples]

    get, zeros = weights.get, repeat(0.0)
    step = 0
    with tempfile.TemporaryFile() as file:  # each part is made once and read again, so that one at a time is in memory
        held = made(0) + put if len(parts) == 1 else None
        at: list[int] = []
        for k in range(len(parts) if held is None else 0):
            at.append(file.tell())
            pickle.dump(made(k), file, pickle.HIGHEST_PROTOCOL)
        for k in list(range(len(parts))) * EPOCHS:
            examples = held
            if examples is None:
                file.seek(at[k])
                examples = pickle.load(file) + put[k :: len(parts)]
            rng.shuffle(examples)
            for x in examples:
                step += 1
                if x[0] == "edit":
                    _, options, gold, true = x
                    if options is None:
                        continue
                    best = max(options, key=lambda o: sum(map(get, o[0], zeros)))
                    moves = ((gold, 1.0), (best[0], -1.0)) if best[1] != true else ()
                else:
                    _, feats, cut = x
                    moves = ((feats, 1.0 if cut else -1.0),) if (sum(map(get, feats, zeros)) > 0) != cut else ()
                for feats, d in moves:
                    for f in feats:
                        weights[f] += d
                        sums[f] += d * step
    model.weights = {x: w - sums[x] / (step or 1) for x, w in weights.items()}


#: Page numbers in print form, and ways a text speaks of a page.
PRINTED = ("Page {}", "Page {} of {}", "~ {} ~", "~{}~", "[{}]", "- {} -", "p. {}", "{}")
SPOKEN = ("see page {} of the plan", "See Page {} of the plan", "per page {}", "as on page {} and after", "Page {} of the report says", "page {} to", "from page {}", "on Page {} of the list")
#: Every way to put one of them into a text: (form, place, is it a header).
_WAYS = [*((x, k, False) for x in PRINTED for k in range(4 if x in ("{}", "p. {}") else 7)), *((x, k, False) for x in SPOKEN for k in range(3))]


_A_PAGE = re.compile(r"[Pp]age \d+")


def _furniture(model: Model, text: str, most: int) -> list[tuple[list[str], bool]]:
    """(features, is it any) of furniture: numbers and headers put into a text between its words or lines, and pages that it speaks of; ``most`` of the ways to do so, by the text alone."""
    words = text.split()
    if len(words) < 6 or most > 1 and model.furniture_candidates(text):
        return []
    crc = zlib.crc32(text.encode("utf-8", "replace"))
    headers = min(3, len(model.headers))
    if most == 1:  # of many texts: picked by the hash itself, a generator for each would cost more than the rest
        draw = lambda a, b: a + (crc >> 9) * 2654435761 % 4294967291 % (b - a + 1)
        k = crc % (len(_WAYS) + 5 * headers)
        ways = [_WAYS[k] if k < len(_WAYS) else (model.headers[draw(0, len(model.headers) - 1)], k % 5, True)]
    else:
        rng = random.Random(crc)
        draw = rng.randint
        ways = [*_WAYS, *((h, k, True) for h in rng.sample(model.headers, headers) for k in range(5))]
        ways = rng.sample(ways, most) if most < len(ways) else ways
    out: list[tuple] = []

    def put(piece: str, before: str, after: str, at: int, is_furniture: bool, shown: str) -> None:
        left = " ".join(words[:at]) + before
        made = left + piece + after + " ".join(words[at:])
        start = len(left) + piece.find(shown)
        # only what is a candidate is ever asked
        asked = model.furniture_candidates(made)
        if any(x <= start < y for x, y in asked) and (most > 1 or len(asked) == 1):
            out.append((model.place_features(made, start, start + len(shown)), is_furniture))

    for form, k, header in ways:
        at = draw(2, len(words) - 2)
        if header:
            h = form.replace("#", str(draw(1, 9)))
            put(h, *((("\n", "\n", at), (" ", " ", at), ("\n", " ", at), ("", "\n", 0), ("\n", "", len(words)))[k]), True, h)
        elif form in SPOKEN:
            piece = form.format(draw(1, 400))
            put(piece, *((" ", " "), ("\n", " "), (" ", "\n"))[k], at, False, _A_PAGE.search(piece).group())
        else:
            n = form.format(*(draw(*((1, 400), (401, 900))[i]) for i in range(form.count("{}"))))
            cut = "-\n\n" if draw(0, 9) < 3 else "\n"
            put(n, *((("\n", "\n", at), (cut, "\n", at), ("", "\n", 0), ("\n", "", len(words)), (" ", " ", at), (" ", "", len(words)), ("", " ", 0))[k]), True, n)
    return out


def _cuts(model: Model, rng: random.Random, w: str, words: list[str], vocabulary: list[str]) -> list[tuple]:
    """Examples of joins: the word cut with each sort of mark, as known and as unknown; and neighbours that are no halves."""
    out: list[tuple] = []
    n = model.count(w)
    for mark in ("\xad", "-\n", "- ", " "):
        if len(w) >= 5:
            i = rng.randint(2, len(w) - 2)
            a, b = w[:i], w[i:]
            noise = lambda x: max(model.count(x), rng.choice((0, 0, n // 10, n // 30)))
            ca, cb = noise(a), noise(b)
            if n >= 4 * min(ca, cb) or mark != " ":
                out.append(("join", model.join_features(a, mark, b, (ca, cb, n, 0)), True))
            if mark == " ":
                out.append(("join", model.join_features(a, mark, b, (ca, cb, max(1, min(ca, cb) // rng.choice((1, 2, 3))), 0)), not min(ca, cb)))  # as frequent apart
                out.append(("join", model.join_features(a, mark, b, (n, 0, n // 9, n)), False))  # a half that is another word misread
            hidden = {"\xad": ((0, 0, True), (n, 0, True), (0, n, True), (n, n, False)), "-\n": ((0, 0, True), (n, 0, len(b) > 2), (0, n, False), (n, n, False)), "- ": ((0, 0, True), (n, 0, False), (0, n, False), (n, n, False)), " ": ((0, 0, False), (n, 0, False), (0, n, False), (n, n, False))}
            out += [("join", model.join_features(a, mark, b, (x, y, 0, 0)), cut) for x, y, cut in hidden[mark]]
            out.append(("join", model.join_features(a, mark, b.title(), (ca, cb, n, 0)), False))
        other = rng.choice(words)
        if not model.count(w + other):
            out.append(("join", model.join_features(w, mark, other, (n, model.count(other), 0, 0)), False))
    return out


def _suspect(model: Model, w: str) -> bool:
    """Does a word look like a far more frequent one?"""
    n = model.count(w)
    return any(model.count(r) >= SUSPECT_RATIO * n for e, r in model.readings(w) if e and len(e) == 1)


def learn(texts: DataFrame) -> Model:
    """A trained model from all of ``texts`` (text): word counts and running headers over every different text.

    Copies of one text count once; else its misreadings would bear each other out.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, words, headers, n = Counter(), Counter(), Counter(), 0
        for b in batches:
            for t in b.column(0).to_pylist():
                tokens.update(tokens_of(t))
                if "\n" in t or "\r" in t or "\f" in t:
                    headers.update(header_candidates(t))
            n += b.num_rows
            if len(tokens) > 500_000:
                words.update(words_of(tokens))
                tokens.clear()
        words.update(words_of(tokens))
        keys = [*words, *headers, ""]
        kinds = ["w"] * len(words) + ["h"] * len(headers) + ["t"]
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(keys, pa.string()), pa.array([*words.values(), *headers.values(), n], pa.int64())], names=["kind", "word", "n"])

    c = texts.where("text <> ''").distinct().mapInArrow(count, "kind string, word string, n bigint").groupBy("kind", "word").agg(F.sum("n").alias("n"))
    c = c.cache()
    counts = all_counts(c.where((F.col("kind") == "w") & (F.col("n") >= MIN_COUNT)).select("word", "n"))
    headers = [(r.n, r.word) for r in c.where((F.col("kind") == "h") & (F.col("n") >= MIN_HEADER)).toLocalIterator()]
    different = (c.where("kind = 't'").agg(F.sum("n")).first()[0]) or 0
    c.unpersist()
    if headers:
        held = {r.word: r.n for r in header_texts(texts.where("text <> ''"), [h for _, h in headers]).toLocalIterator()}
        headers = [(n, h) for n, h in headers if n >= HEADER_SHARE * held[h]]
    headers = [h for _, h in sorted(headers, key=lambda x: (-x[0], x[1]))]
    model = Model(counts, headers)
    train(model, _met(texts.where("text <> ''").distinct(), headers, different))
    return model


def _met(texts: DataFrame, headers: list[str], n: int) -> list[tuple[list[str], bool, int]]:
    """(features, is it any, times) of the furniture put into every one of the ``n`` different ``texts``: at least one piece each.

    Features are few (form, place, neighbours), so what comes to the driver does not grow with the texts.
    """
    most = max(1, -(-PIECES // max(1, n)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, c = Model({}, headers), Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                for f, x in _furniture(model, t, most):
                    c["\n".join(f), x] += 1
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in c], pa.string()), pa.array([k[1] for k in c], pa.bool_()), pa.array(list(c.values()), pa.int64())], names=["f", "is_any", "n"])

    rows = texts.mapInArrow(run, "f string, is_any boolean, n bigint").groupBy("f", "is_any").agg(F.sum("n").alias("n")).orderBy("f", "is_any").collect()
    return [(r.f.split("\n"), r.is_any, r.n) for r in rows]


_kept: list = [None, None]


def _own(data: tuple) -> Model:
    """The model of ``data``: one for all tasks of a worker, so what it has worked out is not worked out again."""
    if _kept[0] is not data:
        _kept[:] = data, Model(*data)
    return _kept[1]


def repair_texts(rows: DataFrame, model: Model | None = None) -> DataFrame:
    """(table_name, row_id, text, noise): the repaired text of every row of ``rows`` (table_name, row_id, text) and its kinds of noise.

    Null and blank texts come back empty with no noise.  Equal texts are judged alike.
    """
    m = learn(rows.select("text")) if model is None else model
    data = (m.counts, m.headers, dict(m.weights), m.bigrams)
    shared = rows.sparkSession.sparkContext.broadcast(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _own(shared.value)
        for b in batches:
            texts, kinds = [], []
            for t in b.column(2).to_pylist():
                text, k = own.repair(t) if t and t.strip() else ("", set())
                texts.append(text)
                kinds.append(sorted(k))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(kinds, pa.list_(pa.string()))], names=["table_name", "row_id", "text", "noise"])

    return rows.mapInArrow(run, "table_name string, row_id bigint, text string, noise array<string>")
