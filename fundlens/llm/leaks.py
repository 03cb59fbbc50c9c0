"""Evaluation texts leaking into training text: greedy string tiling over token seeds.

The held-out items form a seed index of rolling (Karp-Rabin) hashes over k consecutive
words.  Documents are scanned in whole batches; shared seeds name the pairs of a document
and an item that may have a passage in common.  Such a pair is tiled: the longest common
runs of words are marked, longest first and never overlapping in either text, wherever
they stand.  What the tiles cover of the item decides: one long tile is a leak, and so is
a row of sentences each covered up to a few replaced words, in whatever order the document
has them.  The number of documents is unbounded; the index holds a block of items.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_RUN = 12  # words of an item in a row that make a leak
MIN_SENTENCES = 3  # sentences of an item in a row that make a leak
MAX_REPLACED = 0.2  # of the words of each of these: the rest must lie in tiles
MAX_SEED = 6  # words of a seed, at most
#: Items are indexed in blocks of this many words; more words, more passes.
BLOCK_WORDS = 2_000_000
#: Characters scanned at once; longer documents are scanned alone, whole.
CHUNK_CHARS = 4_000_000
_WORD = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def sentences(text: str) -> list[list[str]]:
    parts = [words(s) for s in re.split(r"(?<=[.?!…。？！])\s+", text)]
    return [p for p in parts if p]


def untouched(n: int) -> int:
    """Words that the longest untouched run of a sentence of ``n`` words has at least, if a share of them is replaced."""
    r = int(n * MAX_REPLACED)
    return max(1, -(-(n - r) // (r + 1)))


def seed_length(items: list[list[int]]) -> int:
    """Words in a row that a leak of any item (its sentence lengths) has in common with it at least.

    Of ``MIN_SENTENCES`` in a row one is enough for a seed, so the longest of them counts.
    An item of fewer sentences leaks by ``MIN_RUN`` words only.
    """
    least = MAX_SEED
    for lengths in items:
        for i in range(len(lengths) - MIN_SENTENCES + 1):
            least = min(least, max(map(untouched, lengths[i : i + MIN_SENTENCES])))
    return max(1, least)


@dataclass
class Item:
    item_id: int
    ids: np.ndarray
    bounds: np.ndarray  # starts of its sentences, and its length

    def __post_init__(self) -> None:
        lengths = np.diff(self.bounds).tolist()
        #: Words that the longest untouched run of each of its sentences has at least.
        self.runs = np.array([untouched(x) for x in lengths])
        self.run_list = self.runs.tolist()
        self.words, self.bounds_list = self.ids.tolist(), self.bounds.tolist()
        self.sentence_of = np.repeat(np.arange(len(lengths)), lengths).tolist()

    def seeds_needed(self, k: int) -> int:
        """Seeds of ``k`` words that any leak of the item has at least."""
        need = np.maximum(0, self.runs - k + 1)
        rows = [int(need[i : i + MIN_SENTENCES].sum()) for i in range(len(need) - MIN_SENTENCES + 1)]
        return max(1, min([MIN_RUN - k + 1, *rows]))

    def may_leak(self, places: np.ndarray, k: int) -> bool:
        """Do seeds of ``k`` words at these places of the item suffice for a leak? Needs ``MIN_RUN`` words in a row, or in each of some sentences in a row the seeds of its untouched run."""
        seen = sorted(set(places.tolist()))
        need = MIN_RUN - k  # further seeds in a row
        if any(seen[i + need] - seen[i] == need for i in range(len(seen) - need)):
            return True
        counts = [0] * len(self.runs)
        for x in seen:
            counts[self.sentence_of[x]] += 1
        row = best = 0
        for n, r in zip(counts, self.run_list):
            row = row + 1 if n >= r - k + 1 else 0
            best = max(best, row)
        return best >= MIN_SENTENCES


class SeedIndex:
    def __init__(self, texts: list[tuple[int, str]]) -> None:
        self.vocabulary: dict[str, int] = {}
        self.items: list[Item] = []
        lengths: list[list[int]] = []
        for item_id, text in texts:
            parts = sentences(text)
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for p in parts for w in p]
            if ids:
                self.items.append(Item(item_id, np.array(ids, np.int64), np.cumsum([0, *map(len, parts)])))
                lengths.append([len(p) for p in parts])
        self.k = seed_length(lengths) if lengths else 1
        self.needed = np.array([item.seeds_needed(self.k) for item in self.items], np.int64)
        hashes, where = [], []
        for n, item in enumerate(self.items):
            h = self.roll(item.ids)
            hashes.append(h)
            where.append(np.stack([np.full(len(h), n), np.arange(len(h))], axis=1))
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.where = np.concatenate(where)[np.argsort(h, kind="stable")] if hashes else np.zeros((0, 2), np.int64)
        self.keys, self.starts, self.counts = np.unique(np.sort(h), return_index=True, return_counts=True)

    def roll(self, ids: np.ndarray) -> np.ndarray:
        """Rolling hash of every k consecutive words."""
        n = len(ids) - self.k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        u = ids.astype(np.uint64)
        h = np.zeros(n, np.uint64)
        for i in range(self.k):
            h = h * _BASE + u[i : i + n]
        return h

    def seeds(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, place in it, place): of every seed that the concatenated documents ``ids`` (0: a word no item has) share with an item."""
        k = self.k
        n = len(ids) - k + 1
        if n <= 0 or not len(self.keys):
            z = np.zeros(0, np.int64)
            return z, z, z
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        at = np.flatnonzero(known[k:] - known[:-k] == k)
        u = ids.astype(np.uint64)
        h = np.zeros(len(at), np.uint64)
        for i in range(k):
            h = h * _BASE + u[at + i]
        j = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        hit = self.keys[j] == h
        at, j = at[hit], j[hit]
        times = self.counts[j]
        first = np.repeat(self.starts[j] - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum())
        return self.where[first, 0], self.where[first, 1], np.repeat(at, times)


def _matches(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(size, place in the item, place in the document): all maximal common runs of at least ``least`` words."""
    n, m = len(item) - least + 1, len(doc) - least + 1
    if n <= 0 or m <= 0:
        return []
    # Karp-Rabin over ``least`` words of both
    roll = lambda x, k: sum((x[i : i + k].astype(np.uint64) * _BASE ** np.uint64(least - 1 - i) for i in range(least)), np.zeros(k, np.uint64))
    hi, hd = roll(item, n), roll(doc, m)
    order = np.argsort(hi, kind="stable")
    keys = hi[order]
    left, right = np.searchsorted(keys, hd, "left"), np.searchsorted(keys, hd, "right")
    times = np.where((doc[:m] > 0), right - left, 0)
    at = np.repeat(np.arange(m), times)
    first = np.repeat(left - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum())
    return _runs(order[first], at, least)


def _runs(inside: np.ndarray, at: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Seeds of ``k`` words at these places of an item and a document as maximal runs (size, place in the item, place in the document)."""
    order = np.lexsort((inside, at - inside))
    inside, at = inside[order], at[order]
    turn = np.flatnonzero((np.diff(at - inside) != 0) | (np.diff(inside) != 1)) + 1
    a, b = np.concatenate([[0], turn]), np.concatenate([turn, [len(at)]])
    return list(zip((b - a + k - 1).tolist(), inside[a].tolist(), at[a].tolist())) if len(at) else []


def tile(doc: np.ndarray, item: Item, least: int, found: list[tuple[int, int, int]] | None = None) -> tuple[int, int, int]:
    """(longest, covered, sentences): of one item in one document, by its tiles.

    Tiles are marked longest first without overlap in either text, down to ``least``
    words; beside a tile, single words on its diagonal that are still free count with it
    (what stands between replaced words).  ``longest``: words of the longest tile;
    ``covered``: words of the item in tiles; ``sentences``: most sentences of the item in a
    row of which no more than ``MAX_REPLACED`` of the words lie outside all tiles.
    """
    found = _matches(doc, item.ids, least) if found is None else found
    in_item, in_doc = bytearray(len(item.ids)), set()  # few words are marked, so plain marks beat vectors
    longest, covered, diagonals = 0, 0, []
    heap = [(-size, a, d) for size, a, d in found]
    heapq.heapify(heap)
    while heap:
        size, a, d = heapq.heappop(heap)
        size = -size
        free = [not in_item[a + i] and d + i not in in_doc for i in range(size)]
        if all(free):
            if item.words[a : a + size] != doc[d : d + size].tolist():  # equal hashes of different words
                continue
            in_item[a : a + size] = b"\x01" * size
            in_doc.update(range(d, d + size))
            longest, covered = max(longest, size), covered + size
            diagonals.append((a, size, d - a))
        else:  # what is left of a match that was partly taken stays a candidate
            x = 0
            for y in range(size + 1):
                if y == size or not free[y]:
                    if y - x >= least:
                        heapq.heappush(heap, (x - y, a + x, d + x))
                    x = y + 1
    bounds = item.bounds_list
    for a, size, off in diagonals:  # the words between replaced ones, in the sentences that the tile touches
        lo = max(bounds[item.sentence_of[a]], -off, 0)
        hi = min(bounds[item.sentence_of[a + size - 1] + 1], len(doc) - off)
        for i, w in enumerate(doc[lo + off : hi + off].tolist(), lo):
            if w == item.words[i] and not in_item[i] and i + off not in in_doc:
                in_item[i] = 1
                in_doc.add(i + off)
    best = row = hope = rest = 0
    for n, (a, b) in enumerate(zip(bounds, bounds[1:])):
        held = (b - a) - sum(in_item[a:b]) <= MAX_REPLACED * (b - a) + 1e-9
        row = row + 1 if held else 0
        rest = rest + 1 if held or item.run_list[n] < least else 0
        best, hope = max(best, row), max(hope, rest)
    if best < MIN_SENTENCES <= hope:  # sentences too short for such tiles may decide
        return tile(doc, item, max(1, min(item.run_list)))
    return longest, covered, best


def _scan(index: SeedIndex, ids: list[int], texts: list[str]) -> Iterator[tuple]:
    get = index.vocabulary.get
    gap = [0] * index.k
    flat: list[int] = []
    starts = []
    for t in texts:
        starts.append(len(flat))
        flat += [get(w, 0) for w in words(t)]
        flat += gap
    all_ids = np.array(flat, np.int64)
    begin = np.array([*starts, len(flat)])
    item, inside, place = index.seeds(all_ids)
    if not len(item):
        return
    doc = np.searchsorted(begin, place, "right") - 1
    order = np.lexsort((item, doc))
    doc, item, inside, place = doc[order], item[order], inside[order], place[order]
    turn = np.flatnonzero(np.diff(doc) | np.diff(item)) + 1
    begins, stops = np.concatenate([[0], turn]), np.concatenate([turn, [len(doc)]])
    enough = stops - begins >= index.needed[item[begins]]
    for a, b in zip(begins[enough].tolist(), stops[enough].tolist()):
        d, own = int(doc[a]), index.items[item[a]]
        if not own.may_leak(inside[a:b], index.k):
            continue
        longest, covered, row = tile(all_ids[begin[d] : begin[d + 1] - index.k], own, index.k, _runs(inside[a:b], place[a:b] - begin[d], index.k))
        if longest:
            yield ids[d], own.item_id, longest, covered / len(own.ids), row


def tiles(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, longest, coverage, sentences) for every document and item with enough shared seeds.

    ``documents`` is (doc_id, text), ``items`` (item_id, text).  Words are runs of letters
    and digits in lower case, so case, punctuation and spacing do not count.  Null and
    blank texts share nothing; copies of documents count themselves; items of equal text
    are all reported.  Documents are scanned whole.
    """
    sized = items.where("text <> ''").select("item_id", "text")
    total = sized.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-int(total) // (BLOCK_WORDS * 5)))
    schema = "doc_id bigint, item_id bigint, longest int, coverage double, sentences int"
    out = None
    for b in range(blocks):
        part = sized if blocks == 1 else sized.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        # a block has a bounded number of words
        texts = items.sparkSession.sparkContext.broadcast([(r.item_id, r.text) for r in part.orderBy("item_id").collect()])

        def run(batches: Iterator[pa.RecordBatch], texts=texts) -> Iterator[pa.RecordBatch]:
            index = SeedIndex(texts.value)
            for batch in batches:
                ids, body = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                rows: list[tuple] = []
                at = 0
                while at < len(ids):
                    end, size = at, 0
                    while end < len(ids) and (end == at or size + len(body[end]) <= CHUNK_CHARS):
                        size += len(body[end])
                        end += 1
                    rows += _scan(index, ids[at:end], body[at:end])
                    at = end
                cols = list(zip(*rows)) if rows else [[]] * 5
                types = (pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["doc_id", "item_id", "longest", "coverage", "sentences"])

        one = documents.where("text <> ''").select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
        out = one if out is None else out.unionByName(one)
    return out


def leaked(found: DataFrame) -> DataFrame:
    """The pairs of ``tiles`` that are leaks: a long enough tile, or enough sentences in a row that tiles cover."""
    return found.where((F.col("longest") >= MIN_RUN) | (F.col("sentences") >= MIN_SENTENCES))
