"""The threshold search against plain scores: exact, and stopping early where some axes matter more than others."""

from __future__ import annotations

import numpy as np
import pytest

from layerlake.llm import topk


def plain(ids, block, query_ids, queries, k):
    out = []
    for n, q in enumerate(queries):
        scores = [sum(int(x) * int(y) for x, y in zip(q, v, strict=True)) for v in block]
        scores = [max(-(2**63), min(2**63 - 1, s)) for s in scores]
        best = sorted((-s, int(i)) for s, i in zip(scores, ids, strict=True) if i != query_ids[n])[:k]
        out += [(n, i, -s) for s, i in best]
    return out


def found(*args, **named):
    return [tuple(map(int, r)) for r in zip(*topk.block_top(*args, **named), strict=True)]


@pytest.mark.parametrize("make", [
    lambda r: r.integers(-50, 50, (500, 7)), lambda r: np.zeros((200, 3), int), lambda r: r.integers(0, 2, (400, 5)),
    lambda r: r.integers(-(2**30), 2**30, (150, 4)), lambda r: r.integers(-(2**62), 2**62, (150, 4)), lambda r: r.integers(-9, 9, (1, 2)),
    lambda r: np.repeat(r.integers(-9, 9, (3, 2)), 90, 0), lambda r: np.full((130, 2), 2**63 - 1),
])
def test_blocks(make):
    """Ties, copies, zeros, scores beyond doubles and beyond longs."""
    rnd = np.random.default_rng(3)
    block = make(rnd).astype(np.int64)
    ids = rnd.permutation(len(block)).astype(np.int64)
    ids[: len(ids) // 9] = ids[0]  # repeated ids
    pick = np.arange(0, len(block), 17)
    for k in (1, 3, 10, 1000):
        assert found(ids, block, ids[pick], block[pick], k) == plain(ids, block, ids[pick], block[pick], k)


def test_search_stops_where_few_axes_hold_the_variance():
    rnd = np.random.default_rng(5)
    size = 12_000
    mixed = np.linalg.qr(rnd.normal(size=(32, 32)))[0]  # the axes that matter are not the vectors' components
    x = rnd.normal(size=(size, 32)) * 0.5 ** np.arange(32) @ mixed
    block = np.floor(x * 1024).astype(np.int64)
    ids, pick = np.arange(size), np.arange(0, size, 400)
    stops = []
    got = found(ids, block, ids[pick], block[pick], 10, stops=stops)
    scores = block[pick] @ block.T
    scores[np.arange(len(pick)), pick] = np.iinfo(np.int64).min
    want = [(n, int(i), int(s[i])) for n, s in enumerate(scores) for i in np.lexsort((ids, ~s))[:10]]
    assert got == want
    assert len(stops) == len(pick) and np.median([met for _, met in stops]) < size / 2


def test_components_beyond_a_long(spark):
    rows = [(0, [1e300, -1.0]), (1, [1.0, 2.0]), (2, [-1e300, 0.5]), (3, [5e15, 0.0]), (100, [1e17, 1e17])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=3).collect()
    most = 2**63 - 1
    v = {i: [max(-most - 1, min(most, int(np.floor(x * 1024)) if abs(x) < 1e15 else int(x * 1024))) for x in xs] for i, xs in rows}
    want = []
    for q in (0, 100):
        scores = {i: max(-most - 1, min(most, sum(a * b for a, b in zip(v[q], x, strict=True)))) for i, x in v.items() if i != q}
        want += [(q, n, i, s) for n, (i, s) in enumerate(sorted(scores.items(), key=lambda p: (-p[1], p[0]))[:3], 1)]
    assert sorted(map(tuple, got)) == want
