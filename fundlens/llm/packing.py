"""Filling fixed-capacity containers with texts.

Sizes are tokens of a public tokenizer.  A text longer than a container is cut into full
pieces and a rest; everything else stays whole.  Pieces are spread over shards by hash,
each holding a bounded number of them with much the same mix of sizes; in a shard they
are taken in descending size, each to the container of lowest cost (linear plus quadratic
in the size of its texts) that still has room.
"""

from __future__ import annotations

import ast
import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.session import cut_lineage

CAPACITY = 2048
#: Cost of a text of n tokens: LINEAR * n + QUADRATIC * n * n.
LINEAR, QUADRATIC = 1.0, 1 / 4096
#: Pieces packed in one task, about.
SHARD_PIECES = 8_000
TOKENIZER_DIR = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
TOKENIZER_FILE = "byte_bpe_multi_50k.tiktoken"


def load_tokenizer(path: str):
    """A tiktoken encoding from a rank file; its pre-split pattern stands beside it as ``PATTERN``."""
    import tiktoken

    with open(os.path.join(os.path.dirname(path), "__init__.py"), encoding="utf-8") as f:  # read, not run
        stated = [n.value for n in ast.parse(f.read()).body if isinstance(n, ast.Assign) and any(isinstance(t, ast.Name) and t.id == "PATTERN" for t in n.targets)]
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=ast.literal_eval(stated[0]), mergeable_ranks=ranks, special_tokens={})


def token_sizes(documents: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens): 0 for null and empty texts; texts are read whole."""
    file = path or os.path.join(TOKENIZER_DIR, TOKENIZER_FILE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load_tokenizer(file)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], names=["doc_id", "n_tokens"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id bigint, n_tokens bigint")


def pieces(sizes: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, part, n): full pieces and the rest; a text that fits is part 0 and whole."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / F.lit(capacity))).cast("int")
    p = sizes.select("doc_id", "n_tokens", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    return p.select("doc_id", "part", F.least(F.lit(capacity).cast("long"), F.col("n_tokens") - F.col("part") * capacity).alias("n"))


def fill(n: np.ndarray, capacity: int, linear: float = LINEAR, quadratic: float = QUADRATIC) -> np.ndarray:
    """The container of each piece.  Pieces must fit the capacity; ties keep their order."""
    out = np.zeros(len(n), np.int64)
    count = max(1, -(-int(n.sum()) // capacity))
    room = np.full(count, capacity, np.int64)
    cost = np.zeros(count)
    for i in np.argsort(-n, kind="stable"):
        size = int(n[i])
        fits = np.flatnonzero(room >= size)
        if not len(fits):  # the estimate was short by a container
            room, cost = np.append(room, capacity), np.append(cost, 0.0)
            fits = np.array([len(room) - 1])
        at = fits[np.argmin(cost[fits])]
        out[i] = at
        room[at] -= size
        cost[at] += linear * size + quadratic * size * size
    return out


def pack(documents: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """(doc_id, part, first_token, n_tokens, container, at): where every text goes.

    Every document appears, blank ones with no tokens; a text is split only if it exceeds
    the capacity.  ``container`` numbers are unique over all shards, ``at`` is the place
    of the first token in the container.  Ids must be unique.  An empty table gives none.
    """
    p = cut_lineage(pieces(token_sizes(documents, tokenizer), capacity))
    shards = max(1, -(-p.count() // shard_pieces))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "doc_id", "part"], ascending=[False, True, True], ignore_index=True)
        box = fill(pdf["n"].to_numpy(), capacity)
        pdf["at"] = pdf["n"].groupby(box).cumsum() - pdf["n"]
        pdf["container"] = box + pdf["shard"].astype("int64") * (1 << 32)
        pdf["first_token"] = pdf["part"] * capacity
        return pdf.rename(columns={"n": "n_tokens"})[["doc_id", "part", "first_token", "n_tokens", "container", "at"]]

    shard = F.pmod(F.xxhash64("doc_id", "part"), F.lit(shards)).cast("int").alias("shard")
    schema = "doc_id bigint, part int, first_token bigint, n_tokens bigint, container bigint, at bigint"
    # as many tasks as shards: small pieces are dear to pack, and would else be put into one task
    return p.select(shard, "doc_id", "part", "n").repartition(shards, "shard").groupBy("shard").applyInPandas(run, schema)
