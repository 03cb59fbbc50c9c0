"""Mapping free-entered values to a canonical list.

Values are deduplicated, normalised into tokens, looked up in a character n-gram inverted
index of the list, scored by weighted cosine, and accepted above a threshold and a margin
to the runner-up.  Rewrites of tokens (synonyms, house abbreviations) and tokens without
meaning are learned from a bounded sample of settled rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Settled rows used to learn rewrites, at most (the smallest by hash, so the same at every run).
MAX_LABELLED = 20_000
#: Entries of the list held in memory at once; a longer list is matched block by block.
BLOCK_ENTRIES = 20_000
MIN_SUPPORT, MIN_SHARE = 2, 0.75  # of a learned rewrite or noise token
OPTIONAL_SHARE = 0.02  # a word of the list that this share of settled values leaves out or replaces is optional
OPTIONAL_WEIGHT = 0.25
THRESHOLD, MARGIN = 0.84, 0.03
MIN_COSINE = 0.25  # candidates below are dropped

_DOTTED = re.compile(r"\b(?:[A-Za-z]\.){2,}[A-Za-z]?\b\.?")
_CAMEL = re.compile(r"(?<=[a-z][a-z])(?=[A-Z])|(?<=[A-Z]{3})(?=[A-Z][a-z]{2})")
_INITIALS = re.compile(r"\(([A-Z]{3,})\)")


def tokens(text: str | None) -> list[str]:
    """Lower-case tokens; dotted initials are one token, camel case and joining marks divide."""
    s = _DOTTED.sub(lambda m: m.group().replace(".", "") + " ", text or "")
    s = re.sub("['’‘`´]", "", s).replace("&", " and ").replace("+", " and ")
    s = re.sub(r"[^0-9A-Za-zÀ-ÿ]+", " ", _CAMEL.sub(" ", s)).lower()
    return [re.sub(r"^(fy)\d{2,4}$", r"\1#", t) for t in s.split()]


def words(name: str) -> list[str]:
    """Tokens of an entry of the list without its printed initials."""
    return tokens(_INITIALS.sub(" ", name))


def slips(a: str, b: str, limit: int) -> int:
    """Letters changed, dropped, added or swapped with the next; ``limit + 1`` if more than ``limit``."""
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    before: list[int] = []
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        before, prev = prev, row
        if min(row) > limit:
            return limit + 1
    return prev[-1]


def near(a: str, b: str) -> bool:
    """One slip; two from nine letters on; none below four letters."""
    if a == b:
        return True
    limit = 0 if min(len(a), len(b)) < 4 else 1 if max(len(a), len(b)) < 9 else 2
    return bool(limit) and slips(a, b, limit) <= limit


def _shortened(t: str) -> set[str]:
    """``t`` without up to as many letters as ``near`` allows slips: two tokens that are near have one of these in common."""
    one = {t[:i] + t[i + 1 :] for i in range(len(t))}
    return {t, *one, *(u[:i] + u[i + 1 :] for u in (one if len(t) >= 7 else ()) for i in range(len(u)))}


def abbreviates(short: str, long: str) -> bool:
    """``short`` begins ``long``, or has its first letter and the rest in order within it."""
    if not 2 <= len(short) < len(long) or short[0] != long[0] or len(short) > len(long) * 2 / 3 + 1:
        return False
    if long.startswith(short):
        return len(short) >= 3
    at = 0
    for ch in short:
        at = long.find(ch, at) + 1
        if not at:
            return False
    return sum(c in "aeiou" for c in short[1:]) <= min(1, len(short) - 2)


@dataclass
class Lexicon:
    rewrites: dict[tuple[str, ...], str] = field(default_factory=dict)
    noise: set[str] = field(default_factory=set)
    optional: set[str] = field(default_factory=set)


def learn(pairs: list[tuple[str, str]], vocabulary: set[str]) -> Lexicon:
    """Rewrites, noise tokens and optional words from settled (raw, canonical) pairs.

    What a raw value has and its entry lacks is noise if the entry is otherwise complete;
    what an entry has and its raw value lacks is optional if nothing is left to stand for
    it; what is left on both sides is a rewrite if it goes together often enough.  Labels
    that join two values with a slash say nothing about single words and are left out.
    """
    split = []
    for raw, canon in pairs:
        if "/" in raw:
            continue
        r, c = tokens(raw), words(canon)
        if "formerly" in r[1:]:
            split.append(([x for x in r[r.index("formerly", 1) :] if x not in vocabulary], []))
            r = r[: r.index("formerly", 1)]
        joined, initials = "".join(c), "".join(x[0] for x in c)
        printed = {t for t in r if t == initials or f"({t.upper()})" in canon}
        left = [t for t in r if t not in c and t not in printed and not any(near(t, x) for x in c) and not (len(t) > 5 and t in joined)]
        missing = [x for x in c if x not in r and not any(near(t, x) or (len(t) > len(x) > 2 and x in t) for t in r)]
        if not (printed and len(missing) > 1):
            split.append((left, missing))
    out = Lexicon()
    held = Counter(x for raw, canon in pairs for x in set(words(canon)))
    seen = Counter(t for left, _ in split for t in set(left))
    idle = Counter(t for left, missing in split if not missing for t in set(left))
    out.noise = {t for t, n in idle.items() if n >= MIN_SUPPORT and n >= 0.4 * seen[t] and t not in vocabulary}

    def settle(left: list[str], missing: list[str]) -> tuple[set[str], list[str]]:
        """What stays over on both sides once the rewrites known so far are applied."""
        rest, i = [], 0
        while i < len(left):
            n = 2 if tuple(left[i : i + 2]) in out.rewrites else 1
            rest.append(out.rewrites.get(tuple(left[i : i + n]), left[i]))
            i += n
        return set(rest) - set(missing) - out.noise - out.optional, [x for x in missing if x not in rest]

    def find_optional() -> None:
        for _ in range(2):  # a word may be replaced by another optional one
            over = [settle(left, missing) for left, missing in split]
            gone = Counter(x for left, missing in over if len(missing) <= 2 and not left for x in missing)
            out.optional |= {x for x, n in gone.items() if n >= MIN_SUPPORT and n >= OPTIONAL_SHARE * held[x]}

    find_optional()
    to: dict[tuple[str, ...], Counter] = defaultdict(Counter)
    for left, missing in split:
        left = [t for t in left if t not in out.noise]
        short = {x for x in missing if any(abbreviates(t, x) for t in left)}
        for x in short or [x for x in missing if x not in out.optional] or missing[-1:]:
            for n in (1, 2):
                for i in range(len(left) - n + 1):
                    if set(left[i : i + n]) <= vocabulary:
                        continue
                    if n == 2 or x not in short or abbreviates(left[i], x):
                        to[tuple(left[i : i + n])][x] += 1
    for phrase, where in to.items():
        x, n = max(where.items(), key=lambda kv: (kv[1], kv[0]))
        if n >= MIN_SUPPORT and n >= MIN_SHARE * sum(where.values()):
            out.rewrites[phrase] = x
    for phrase in [p for p in out.rewrites if len(p) == 1]:
        if any(phrase[0] in q and out.rewrites[q] == out.rewrites[phrase] for q in out.rewrites if len(q) == 2):
            del out.rewrites[phrase]
    find_optional()
    return out


class Matcher:
    """Weighted-cosine matcher over one block of the canonical list."""

    def __init__(self, entries: list[tuple[int, str]], idf: dict[str, float], lex: Lexicon, top_idf: float) -> None:
        self.lex, self.idf, self.top_idf = lex, idf, top_idf
        self.vocabulary = {t for _, name in entries for t in words(name)}
        self.known = self.vocabulary | lex.noise
        self.near_words: dict[str, list[str]] = defaultdict(list)
        for t in sorted(self.vocabulary | lex.noise | {w for p in lex.rewrites for w in p}):
            for x in _shortened(t):
                self.near_words[x].append(t)
        self.by_first = defaultdict(list)
        for t in sorted(self.vocabulary):
            self.by_first[t[0]].append(t)
        self.ids = [i for i, _ in entries]
        self.words = [set(words(name)) for _, name in entries]
        self.index: dict[str, list[tuple[int, float]]] = defaultdict(list)
        self.entries: list[dict[str, float]] = []
        self.initials: dict[str, list[int]] = defaultdict(list)
        for k, (_, name) in enumerate(entries):
            self.entries.append(self.vector(dict.fromkeys(words(name))))
            for g, w in self.entries[-1].items():
                self.index[g].append((k, w))
            m = _INITIALS.search(name)
            own = m.group(1).lower() if m else "".join(w[0] for w in words(name)) if len(words(name)) > 2 else ""
            if own:
                self.initials[own].append(k)
        self.cache: dict[str, list[str]] = {}

    def weight(self, t: str) -> float:
        if t in self.lex.noise:
            return 0.0
        if t in self.lex.optional:
            return OPTIONAL_WEIGHT
        return 0.85 + 0.15 * self.idf.get(t, self.top_idf) / self.top_idf

    def vector(self, toks: Iterable[str]) -> dict[str, float]:
        """Unit vector over character trigrams; every token's trigrams have the token's weight as their length."""
        v: dict[str, float] = defaultdict(float)
        for t in toks:
            p = f"^{t}$"
            grams = [p[i : i + 3] for i in range(len(p) - 2)] or [p]
            for g in grams:
                v[g] += self.weight(t) / math.sqrt(len(grams))
        n = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {g: x / n for g, x in v.items() if x}

    def _split(self, t: str) -> list[str] | None:
        """Known words run together, with one slip in one of them at most."""
        for i in range(len(t) - 2, 2, -1):
            a, b = t[:i], t[i:]
            if a in self.known and b in self.known:
                return [a, b]
        for i in range(len(t) - 2, 2, -1):
            a, b = t[:i], t[i:]
            if a in self.known or b in self.known:
                rest = b if a in self.known else a
                like = [x for x in self.by_first[rest[0]] if near(rest, x)] if len(rest) > 3 else []
                mid = like[:1] or (self._split(rest) if len(rest) > 6 else None)
                if mid:
                    return [a, *mid] if a in self.known else [*mid, b]
        return None

    def token(self, t: str) -> list[str]:
        """The known words that a token stands for, or itself."""
        if t in self.known or t in self.initials:
            return [t]
        if t not in self.cache:
            self.cache[t] = self._token(t)
        return self.cache[t]

    def _token(self, t: str) -> list[str]:
        like = sorted((slips(t, x, 2), x[0] != t[0], x) for x in {w for y in _shortened(t) for w in self.near_words.get(y, ())} if near(t, x))
        if like:
            return [like[0][2]]
        short = [x for x in self.by_first[t[0]] if abbreviates(t, x)]
        starts = [x for x in short if x.startswith(t)]
        if len(starts) == 1 or len(short) == 1:
            return (starts or short)[:1] if len(starts) == 1 else short
        parts = self._split(t) if len(t) > 6 else None
        if parts:
            return parts
        far = [x for x in self.by_first[t[0]] if len(t) > 5 and x[-1] == t[-1] and slips(t, x, 2) <= 2]
        return far if len(far) == 1 else [t]

    def normalise(self, text: str) -> list[str]:
        raw = tokens(text)
        former = next((i for i, t in enumerate(raw) if i and near(t, "formerly")), None)
        raw = raw[:former]  # a name stands before its former one
        for i in range(len(raw) - 2, -1, -1):  # a word broken in two
            if raw[i] + raw[i + 1] in self.vocabulary and not (raw[i] in self.known and raw[i + 1] in self.known):
                raw[i : i + 2] = [raw[i] + raw[i + 1]]
        whole = lambda t: (t,) in self.lex.rewrites
        raw = [x for t in raw for x in ([t] if whole(t) else self.token(t))]
        out, i = [], 0
        while i < len(raw):
            n = 2 if tuple(raw[i : i + 2]) in self.lex.rewrites else 1
            out.append(self.lex.rewrites.get(tuple(raw[i : i + n]), raw[i]))
            i += n
        return [t for t in dict.fromkeys(out) if t not in self.lex.noise]

    def best(self, text: str) -> tuple[float, int, float]:
        """(score, id, runner-up's score); score 0 if nothing is similar."""
        toks = self.normalise(text)
        hits = {k for t in toks for k in self.initials.get(t, ())}
        named = [t for t in toks if t not in self.initials]
        scores: dict[int, float] = defaultdict(float)
        for g, w in self.vector(named).items():
            for k, x in self.index[g]:
                scores[k] += w * x
        scores = {k: s for k, s in scores.items() if s >= MIN_COSINE}
        for k in hits:  # initials are read as the words they stand for
            read = self.vector(dict.fromkeys([*named, *sorted(self.words[k])]))
            scores[k] = max(scores.get(k, 0), sum(w * read.get(g, 0.0) for g, w in self.entries[k].items()))
        two = sorted(scores.items(), key=lambda kv: (-kv[1], self.ids[kv[0]]))[:2]
        if not two:
            return 0.0, 0, 0.0
        return two[0][1], self.ids[two[0][0]], two[1][1] if len(two) > 1 else 0.0


def labelled(settled: DataFrame) -> list[tuple[str, str]]:
    """The bounded sample of settled (raw, canonical) rows that rewrites are learned from."""
    ok = settled.where("raw <> '' and canonical <> ''").select("raw", "canonical").distinct()
    rows = ok.orderBy(F.xxhash64("raw", "canonical"), "raw", "canonical").limit(MAX_LABELLED).collect()
    return [(r.raw, r.canonical) for r in rows]


def map_values(values: DataFrame, canon: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(raw, canon_id, score): the entry of ``canon`` (canon_id, name) meant by each distinct ``raw`` of ``values``.

    ``canon_id`` is 0 where nothing scores above the threshold or the best two are closer
    than the margin, and for null, empty and placeholder values.  Repeated values are
    matched once.  ``pairs`` are settled (raw, canonical) values, from ``labelled``.  An
    empty list maps everything to 0; an empty table gives no rows.
    """
    entries = canon.select("canon_id", "name").where("name <> ''")
    n = entries.count()
    # a number of tasks of its own: few and small values are dear to match, and would else be put into one task
    raw = values.select("raw").distinct().repartition(int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if n == 0:
        return raw.select("raw", F.lit(0).cast("long").alias("canon_id"), F.lit(0.0).alias("score"))
    blocks = math.ceil(n / BLOCK_ENTRIES)
    found = None
    counts: Counter = Counter()
    held: list[list[tuple[int, str]]] = []
    for b in range(blocks):
        part = entries if blocks == 1 else entries.where(F.pmod(F.xxhash64("canon_id"), F.lit(blocks)) == b)
        held.append([(r.canon_id, r.name) for r in part.orderBy("canon_id").collect()])
        counts.update(t for _, name in held[-1] for t in set(words(name)))
    idf = {t: math.log(1 + n / c) for t, c in counts.items()}
    lex = learn(pairs, set(counts) | {t for _, c in pairs for t in words(c)})
    for own in held:
        data = values.sparkSession.sparkContext.broadcast((own, {t: idf[t] for _, name in own for t in words(name)}, lex, math.log(1 + n)))

        def run(batches: Iterator[pd.DataFrame], data=data) -> Iterator[pd.DataFrame]:
            m = Matcher(*data.value)
            for pdf in batches:
                got = [m.best(x or "") for x in pdf["raw"]]
                yield pd.DataFrame({"raw": pdf["raw"], "score": [g[0] for g in got], "canon_id": [g[1] for g in got], "second": [g[2] for g in got]})

        one = raw.mapInPandas(run, "raw string, score double, canon_id bigint, second double")
        found = one if found is None else found.unionByName(one)
    if blocks > 1:  # best of all blocks, and the best of what is left
        top = F.max(F.struct("score", (-F.col("canon_id")).alias("i"), "second"))
        two = found.groupBy("raw").agg(top.alias("a"), F.sort_array(F.collect_list("score"), False).alias("s"))
        found = two.select("raw", F.col("a.score").alias("score"), (-F.col("a.i")).alias("canon_id"), F.greatest("a.second", F.coalesce(F.get("s", F.lit(1)), F.lit(0.0))).alias("second"))
    accepted = (F.col("score") >= THRESHOLD) & (F.col("score") - F.col("second") >= MARGIN)
    return found.select("raw", F.when(accepted, F.col("canon_id")).otherwise(F.lit(0)).alias("canon_id"), "score")
