"""Duplicates hidden by formatting differences.

The three text fields of a row are streamed, a whole Arrow batch at a time, through a
skip-and-fold table (a character maps to its folded code, or to "skip") into rolling
polynomial hashes modulo two primes; no canonical string is built.  Rows are grouped by
the sorted field hashes and their other fields; a group is reduced to its smallest id and
its size by a combining aggregate, so a group of any size costs one row per task.  Every
row of a group is then compared with the group's first row by a two-pointer comparison
that skips and folds as it goes.  Texts move for that comparison only, and of rows in
groups only: the others are held back where they are read, by a bit map of their ids.
The folded codes of one Arrow batch at a time are the most that stands in memory.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.session import cut_lineage

#: Moduli and multipliers of the two rolling hashes (any primes below 2**31 do).
PRIMES = np.array([2147483647, 2147483629], np.uint64)
BASES = np.array([1000003, 999983], np.uint64)
#: Copies compared with one first row in one task; a larger group is salted.
SALT_ROWS = 50_000
#: Bits of the map per id, and its 64-bit words at most (a bound of some 24 MB; a fuller map holds back less).
BITS_PER_ID, MAX_WORDS = 4, 1_000_000
_SKIP = 0
_UNSEEN = 0xFFFFFFFF


class Folder:
    """Skip-and-fold table over code points, filled as characters are met."""

    def __init__(self) -> None:
        self.table = np.full(0x110000, _UNSEEN, np.uint32)

    @staticmethod
    def fold(ch: str) -> int:
        """Code of a letter or digit in lower case; 0 for what does not count.

        The one letter that lowers to two characters keeps the first.
        """
        return ord(ch.lower()[0]) if ch.isalnum() else _SKIP

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        out = self.table[codes]
        if (new := out == _UNSEEN).any():
            for c in np.unique(codes[new]):
                self.table[c] = self.fold(chr(c))
            out = self.table[codes]
        return out


def _powers(n: int, base: np.uint64, prime: np.uint64) -> np.ndarray:
    p = np.ones(1, np.uint64)
    while len(p) < n:
        top = p[-1] * base % prime
        p = np.concatenate([p, p * top % prime])
    return p[:n]


class FieldHasher:
    """Rolling hashes of the letters and digits of every string of an Arrow array."""

    def __init__(self) -> None:
        self.folder = Folder()
        self.powers = [np.ones(1, np.uint64)] * 2

    def __call__(self, texts: pa.Array) -> np.ndarray:
        """int64 per string: both hashes packed; strings without letters or digits (and nulls) give 0."""
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        ends = offsets - offsets[0]
        if len(raw) and raw.max() >= 128:
            starts = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            ends = starts[ends]
            codes = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        else:
            codes = raw
        folded = self.folder(codes)
        kept = folded != _SKIP
        before = np.concatenate([[0], np.cumsum(kept)])
        first, last = before[ends[:-1]], before[ends[1:]]
        values = folded[kept].astype(np.uint64)
        place = np.arange(len(values)) - np.repeat(first, last - first)
        if len(place) and place.max() >= len(self.powers[0]):
            self.powers = [_powers(2 * int(place.max()) + 1, b, p) for b, p in zip(BASES, PRIMES)]
        out = np.zeros((2, len(texts)), np.uint64)
        some = last > first
        for k, prime in enumerate(PRIMES):
            term = (values + np.uint64(1)) * self.powers[k][place] % prime
            if some.any():
                out[k, some] = np.add.reduceat(term, first[some]) % prime
        return (out[0] << np.uint64(31) | out[1]).astype(np.int64)


def same_text(a: str, b: str, fold=Folder.fold) -> bool:
    """Two-pointer comparison: equal once what does not count is skipped and case is folded."""
    if a == b:
        return True
    i = j = 0
    n, m = len(a), len(b)
    while True:
        while i < n and not a[i].isalnum():
            i += 1
        while j < m and not b[j].isalnum():
            j += 1
        if i == n or j == m:
            return i == n and j == m
        if a[i] != b[j] and fold(a[i]) != fold(b[j]):
            return False
        i += 1
        j += 1


def same_texts(a: Sequence[str], b: Sequence[str]) -> bool:
    """Do two rows hold the same texts in whatever order?"""
    if all(same_text(x, y) for x, y in zip(a, b)):
        return True
    left = list(b)
    for x in a:
        for k, y in enumerate(left):
            if same_text(x, y):
                del left[k]
                break
        else:
            return False
    return True


def canonical(texts: Sequence[str]) -> str:
    """Only for rows whose hashes collide without being equal."""
    return "\x00".join(sorted("".join(chr(Folder.fold(c)) for c in t if c.isalnum()) for t in texts))


def hash_fields(df: DataFrame, id_col: str, fields: Sequence[str], exact: dict[str, Column]) -> DataFrame:
    """(id, k1, k2): two 64-bit keys over the unordered field hashes and the exact columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = FieldHasher()
        n = len(fields)
        for b in batches:
            own = np.sort(np.stack([h(b.column(i)) for i in range(n)]), axis=0)
            yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in own), *b.columns[n:]], names=[*(f"h{i}" for i in range(n)), *b.schema.names[n:]])

    e = F.struct(*(c.alias(k) for k, c in exact.items()))
    src = df.select(*(F.col(f).cast("string") for f in fields), F.col(id_col).cast("long").alias("_id"), F.xxhash64(F.lit(0), e).alias("_e0"), F.xxhash64(F.lit(1), e).alias("_e1"))
    hs = [f"h{i}" for i in range(len(fields))]
    hashed = src.mapInArrow(run, ", ".join(f"{h} bigint" for h in hs) + ", _id bigint, _e0 bigint, _e1 bigint")
    return hashed.select("_id", F.xxhash64("_e0", *hs).alias("k1"), F.xxhash64(F.lit(7), "_e1", *reversed(hs)).alias("k2"))


def _in_groups(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` whose _id may be one of ``ids``; some others pass, none of those is lost.

    A map of hashed ids, never larger than ``MAX_WORDS``, is joined where the rows are read.
    """
    words = min(MAX_WORDS, max(64, -(-ids.count() * BITS_PER_ID // 64)))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(words * 64))
    word, bit = lambda c: F.floor(place(c) / 64).cast("int"), lambda c: F.pmod(place(c), F.lit(64)).cast("int")
    held = ids.groupBy(word("_id").alias("_w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(pmod(xxhash64(_id), {words * 64}), 64) as int))")).alias("_bits"))
    j = rows.join(F.broadcast(held), word("_id") == F.col("_w"))  # bounded by MAX_WORDS rows
    return j.where(F.getbit("_bits", bit("_id")) == 1).drop("_w", "_bits")


def find_copies(df: DataFrame, id_col: str, fields: Sequence[str], exact: dict[str, Column]) -> DataFrame:
    """(first_id, copy_id): every row that repeats an earlier one in form only.

    ``fields`` are compared as an unordered set of texts of which letters and digits count
    and case does not; null is the empty text.  ``exact`` names expressions that must be
    equal, null equal to null.  Ids must be unique and not null.  An empty table gives no
    rows; very long texts are hashed and compared whole.
    """
    keyed = hash_fields(df, id_col, fields, exact)
    groups = keyed.groupBy("k1", "k2").agg(F.min("_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = cut_lineage(keyed.join(groups, ["k1", "k2"]).select("first_id", "_id", F.ceil(F.col("n") / SALT_ROWS).cast("int").alias("salts")))
    row = F.struct(*(F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f"f{i}") for i, f in enumerate(fields)), F.struct(*(c.alias(k) for k, c in exact.items())).alias("e"))
    rows = _in_groups(df.select(F.col(id_col).cast("long").alias("_id"), row.alias("r")), members.select("_id"))
    texts = members.join(rows, "_id")
    firsts = texts.where("_id = first_id").select("first_id", F.col("r").alias("a"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    copies = texts.where("_id <> first_id").select("first_id", F.col("_id").alias("copy_id"), F.col("r").alias("b"), F.pmod(F.xxhash64("_id"), F.col("salts")).cast("int").alias("salt"))
    pairs = copies.join(firsts, ["first_id", "salt"])
    names = [f"f{i}" for i in range(len(fields))]
    packed = pairs.select("first_id", "copy_id", (F.col("a.e") == F.col("b.e")).alias("eq"), F.to_json("b.e").alias("e"), *(F.col(f"{s}.{f}").alias(f"{s}{f}") for s in "ab" for f in names))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(names)
        for b in batches:
            cols = [c.to_pylist() for c in b.columns[4:]]
            first, copy, eq, exact = (b.column(i) for i in range(4))
            ok, other = [], []
            for i, e in enumerate(eq.to_pylist()):
                x, y = [c[i] for c in cols[:n]], [c[i] for c in cols[n:]]
                good = e and same_texts(x, y)
                ok.append(good)
                other.append(None if good else canonical(y))
            yield pa.RecordBatch.from_arrays([first, copy, pa.array(ok, pa.bool_()), pa.array(other, pa.string()), exact], names=["first_id", "copy_id", "ok", "text", "e"])

    checked = packed.mapInArrow(verify, "first_id bigint, copy_id bigint, ok boolean, text string, e string")
    good = checked.where("ok").select("first_id", "copy_id")
    # rows that share both keys with a row they do not equal: group those by their text
    odd = checked.where("not ok").select("copy_id", "text", "e")
    heads = odd.groupBy("text", "e").agg(F.min("copy_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    j = odd.alias("o").join(heads.alias("h"), (F.col("o.text") == F.col("h.text")) & F.col("o.e").eqNullSafe(F.col("h.e")))
    return good.unionByName(j.where("copy_id <> first_id").select("first_id", "copy_id"))


def collapse(df: DataFrame, id_col: str, copies: DataFrame) -> DataFrame:
    """``df`` without its copies, with ``copies``: how many rows each kept row stands for."""
    n = copies.groupBy("first_id").agg((F.count(F.lit(1)) + 1).alias("copies"))
    kept = df.join(copies.select(F.col("copy_id").alias(id_col)), id_col, "left_anti")
    return kept.join(n.withColumnRenamed("first_id", id_col), id_col, "left").withColumn("copies", F.coalesce("copies", F.lit(1).cast("long")))
