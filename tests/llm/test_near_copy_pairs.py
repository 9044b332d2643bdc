"""Near copies: how many pairs are compared where very many sets share bands but are not alike, and that none is lost."""

from __future__ import annotations

import random

import numpy as np

from layerlake.llm import near_copies
from layerlake.llm.common import stored


def variants(n, size, edits, seed=1):
    """Texts of ``size`` words from one another by so many words replaced by new ones; the common origin is not among them."""
    rnd = random.Random(seed)
    origin = [f"w{rnd.randrange(10**6)}" for _ in range(size)]
    out = []
    for i in range(n):
        words = list(origin)
        for at in rnd.sample(range(size), rnd.choice(edits)):
            words[at] = f"new{i}x{at}"
        out.append((i, " ".join(words)))
    return out


def roots(rows):
    """The smallest id of each group, by comparing all sets."""
    sets = [set(near_copies.shingles(t).tolist()) for _, t in rows]
    root = list(range(len(rows)))

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, x in enumerate(sets):
        for b, y in enumerate(sets[:a]):
            if 5 * len(x & y) >= 4 * len(x | y):
                root[find(a)] = find(b)
    first = {}
    for n, (i, _) in enumerate(rows):
        first.setdefault(find(n), []).append(i)
    return sorted(min(ids) for ids in first.values())


def compared(monkeypatch, spark, rows):
    """(ids kept, pairs whose texts are compared in the first pass and across components)."""
    counts = []
    real = near_copies.verified

    def counting(pairs, *more):
        pairs = stored(pairs)
        counts.append(pairs.count())
        return real(pairs, *more)

    monkeypatch.setattr(near_copies, "verified", counting)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, root string, n int").repartition(5)
    return sorted(r.doc_id for r in near_copies.one_of_each(df).collect()), counts


def test_sets_below_the_threshold_are_not_compared_with_each_other(spark, monkeypatch):
    """300 sets of pairwise similarity 0.6 to 0.75, nearly every two of them in common bands: 45,000 pairs."""
    for edits in ([8], [9, 10], [12, 13]):
        rows = variants(300, 500, edits)
        kept, counts = compared(monkeypatch, spark, rows)
        assert kept == roots(rows) and len(kept) > 290
        assert sum(counts) < 20 * len(rows), edits


def test_parities_bound_the_difference():
    rnd = random.Random(7)
    for _ in range(200):
        a, b = ({rnd.randrange(2**64) for _ in range(rnd.randrange(400))} for _ in range(2))
        b |= set(rnd.sample(sorted(a), len(a) // 2))
        x, y = (near_copies.parities(np.array(sorted(s), np.uint64)) for s in (a, b))
        turned = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
        assert turned <= len(a ^ b) and near_copies.parities(np.array([], np.uint64)).tolist() == [0] * (near_copies.PARITY // 64)


def test_no_link_is_lost_around_the_threshold(spark, monkeypatch):
    rows = variants(150, 300, [1, 2, 3, 4, 5, 6, 9], seed=2) + [(1000 + i, t) for i, t in variants(40, 60, [1, 2], seed=3)]
    rows += [(2000 + i, t + " " + " ".join(f"tail{i}y{k}" for k in range(40))) for i, t in rows[:30]]
    kept, _ = compared(monkeypatch, spark, rows)
    assert kept == roots(rows)
    assert 1 < len(kept) < len(rows)


def test_fingerprints_find_close_copies_and_only_true_links(spark):
    """SimHash alone, without the complete search, groups close copies; sets beyond the threshold stay apart."""
    from layerlake.llm import simhash

    rows, kept = [], []
    for k, edits in enumerate([1] * 6 + [40] * 6):
        words = [f"d{k}w{j}" for j in range(500)]
        rows.append((100 * k, " ".join(words)))
        for i in range(1, 4):
            own = list(words)
            for at in random.Random(10 * k + i).sample(range(500), edits):
                own[at] = f"new{k}x{i}x{at}"
            rows.append((100 * k + i, " ".join(own)))
        kept += [100 * k] if edits == 1 else [100 * k + i for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(r.doc_id for r in near_copies.one_of_each(df, bands=0).collect()) == kept == roots(rows)
    # the pairs proposed are all those of fingerprints within the distance
    texts = dict(variants(60, 400, [1, 2, 5, 9], seed=5))
    hashes = {i: near_copies.shingles(t) for i, t in texts.items()}
    prints = {i: [simhash.of_hashes(simhash.remixed(h, k)) for k in range(near_copies.PRINTS)] for i, h in hashes.items()}
    close = set()
    for k in range(near_copies.PRINTS):  # sets of one fingerprint are compared with the smallest of them
        low = {p[k]: i for i, p in sorted(prints.items(), reverse=True)}
        close |= {(low[p[k]], i) for i, p in prints.items()}
        close |= {(min(a, b), max(a, b)) for x, a in low.items() for y, b in low.items() if (x ^ y).bit_count() <= near_copies.MOST}
    close = {(a, b) for a, b in close if a < b}
    signed = [(i, len(hashes[i]), np.array(p, np.uint64).view(np.int64).tolist()) for i, p in prints.items()]
    nodes = spark.createDataFrame(signed, "node long, n long, prints array<long>")
    got = {tuple(r) for r in near_copies.close_prints(nodes, near_copies.LEAST).collect()}
    assert got == close and len(close) > 50
    assert all(len(set(p)) == near_copies.PRINTS for p in prints.values())
