import os

import numpy as np
import pytest

from fundlens.llm import packing as P

pytestmark = pytest.mark.skipif(not os.path.isdir(P.TOKENIZER_DIR), reason="no tokenizer files")


def test_round_trip(spark):
    texts = [None, "", "word", "many words " * 40, "long text with words " * 300, "日本語" * 50] * 20
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id bigint, text string, container string")
    enc = P.load_tokenizer(os.path.join(P.TOKENIZER_DIR, P.TOKENIZER_FILE))
    want = {i: len(enc.encode_ordinary(t or "")) for i, t in enumerate(texts)}
    rows = P.pack(df, capacity=256, shard_pieces=50).collect()
    got, used, spans = {}, {}, {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.part, r.first_token, r.n_tokens))
        used[r.container] = used.get(r.container, 0) + r.n_tokens
        spans.setdefault(r.container, []).append((r.at, r.n_tokens))
    assert set(got) == set(want)
    for i, parts in got.items():
        parts.sort()
        assert sum(p[2] for p in parts) == want[i]
        assert len(parts) == 1 or want[i] > 256
        assert [p[1] for p in parts] == [256 * p[0] for p in parts]
    assert max(used.values()) <= 256
    for s in spans.values():
        s.sort()
        assert all(a + n <= b for (a, n), (b, _) in zip(s, s[1:]))


def test_fill():
    rng = np.random.default_rng(1)
    n = rng.integers(1, 500, 3000)
    box = P.fill(n, 1000)
    load = np.bincount(box, weights=n)
    assert load.max() <= 1000 and n.sum() / (1000 * len(load)) > 0.98
    cost = np.bincount(box, weights=P.LINEAR * n + P.QUADRATIC * n * n)
    assert cost.max() / cost.mean() < 1.3
    assert (P.fill(np.array([10] * 6), 20) == P.fill(np.array([10] * 6), 20)).all()


def test_empty(spark):
    assert P.pack(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
