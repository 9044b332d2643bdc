"""Each operator against a brute-force version, on a small fixture with nulls, empty and long texts, ties and copies."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import oracle
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from layerlake.llm import byte_bpe, licenses, near_copies, packing, pii, quality_rules, queries, repeats, revisits, simhash, token_counts, topk

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _k string, fp string"


def texts() -> list[str | None]:
    rnd = random.Random(5)
    words = ["the", "of", "und", "la", "été", "Wort,", "x1", "naïve", "日本", "it's", "don't", "end."]
    make = lambda n: " ".join(rnd.choice(words) + rnd.choice(["", "a", "b", "c", "d"]) for _ in range(n))
    passage = make(60)
    out = [None, "", " \n\t ", "one", "two words", "a  b\n\n c\td ", "<|endoftext|> plain <|endoftext|>", make(30_000)]
    out += [make(80) + "\n" + passage + " " + make(40), passage + " tail " + make(50), make(20) + "\n" + passage]
    copy = make(120)
    out += [copy, copy, copy.replace("the", "thee", 1), "same same " * 60, "line one\nline one\nline two " + make(30)]
    out += [make(rnd.randrange(1, 90)) for _ in range(20)]
    out += ["call +1 (415) 555-0101 or write to a.b@c.example.org, card 4111 1111 1111 1111, host 10.0.0.1 and 999.1.1.1",
            "mail me at jo[at]mail(dot)com\nReleased under the MIT License.", "@@a@b.c@d.e +12 1.2.3.4.5.6.7.8 0411 1111 11111111"]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 5 else None, t, "en", None, 0, "k", "fp") for i, t in enumerate(texts())]
    rows.append(rows[11])  # a repeated row
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def words_of(text: str) -> list[str]:
    return [w.decode() for w in text.encode().split()]


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_fingerprints_and_components(docs):
    def brute(text):
        w = [x.decode() for x in text.encode().lower().split()]
        if not w:
            return 0
        grams = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    rows = [(i, brute(t)) for i, t in pairs(docs)]
    root = {f: f for _, f in rows}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    fps = list(root)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    least = defaultdict(list)
    for i, f in rows:
        if i is not None:
            least[find(f)].append(i)
    want = sorted(((i, f"{f:016x}", min(least[find(f)], default=None)) for i, f in rows), key=str)
    assert as_rows(simhash.near_duplicates(docs)) == want
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({r[2] for r in want} - {None})


def test_links_are_all_found(spark):
    rnd = random.Random(2)
    centres = [rnd.getrandbits(64) for _ in range(40)]
    fps = set(centres)
    for c in centres:
        for _ in range(12):
            fps.add(c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(1, 6))))
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {tuple(r) for r in simhash.links(nodes).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) % 2**64).bit_count() <= 4}
    assert got == want


def shingle_sets(text):
    w = [x.decode() for x in (text or "").encode().lower().split()]
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def one_of_each_group(rows):
    """Ids that stay of (id, text): the smallest of each group linked by a Jaccard similarity of 0.8 or more."""
    sets, root = [shingle_sets(t) for _, t in rows], list(range(len(rows)))

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, x in enumerate(sets):
        for b, y in enumerate(sets[:a]):
            if 10 * len(x & y) >= 8 * len(x | y):
                root[find(a)] = find(b)
    first = {}
    for n, (i, _) in enumerate(rows):
        first.setdefault(find(n), []).append(i)
    return sorted((min((i for i in ids if i is not None), default=None) for ids in first.values()), key=str)


def test_near_copies_beyond_four_bits(spark):
    import corpus_pipeline

    rnd = random.Random(3)
    rows, wide = [], 0
    for n in range(40):
        words = [f"w{rnd.randrange(900)}" for _ in range(rnd.choice([60, 300, 900]))]
        rows.append((len(rows), " ".join(words)))
        for _ in range(n % 3):  # chains of near copies, some beyond 0.8 of the first
            for _ in range(len(words) // 60 + 1):
                words[rnd.randrange(len(words))] = "other"
            rows.append((len(rows), " ".join(words)))
            near = [r for r in rows[:-1] if shingle_sets(r[1]) & shingle_sets(rows[-1][1])]
            wide += all((simhash.fingerprint(rows[-1][1]) ^ simhash.fingerprint(t)).bit_count() > 4 for _, t in near)
    rows += [(None, rows[0][1]), (None, "no id " * 9), (None, "No  id " * 9), (7, rows[7][1]), (-1, ""), (-2, None), (-3, "a b"), (-4, "A  b")]
    rows += [(1000 + i, t + " tail") for i, t in rows[:5]]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, df, "")
    assert wide > 5 and kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == one_of_each_group(rows)


def test_near_copies_without_a_common_first(docs, nothing, spark):
    got = sorted((r.doc_id for r in near_copies.one_of_each(docs).collect()), key=str)
    assert got == one_of_each_group([(r.doc_id, r.text) for r in docs.collect()])
    assert near_copies.one_of_each(nothing).count() == 0
    # a chain: neighbours are alike, ends are not, so that bands hold several components on the way
    rows = [(99 - i, " ".join(f"{i + j}" for j in range(100))) for i in range(0, 60, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.doc_id for r in near_copies.one_of_each(df).collect()] == one_of_each_group(rows) == [42]


def test_personal_data(docs):
    model = pii.learned(docs)
    got = {r.doc_id: r for r in pii.found(docs, model).collect()}
    by_text = {t: got[i] for i, t in pairs(docs)}
    first = next(r for t, r in by_text.items() if t.startswith("call"))
    assert (first.n_email, first.n_ip, first.n_card, first.n_phone) == (1, 1, 1, 1)
    odd = "@@a@b.c@d.e +12 1.2.3.4.5.6.7.8 0411 1111 11111111"
    assert pii.base_spans(odd) == [("email", 2, 7), ("ip", 16, 23), ("ip", 24, 31)]
    masked = pii.masked(docs, model)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    call = next(r.text for r in masked.collect() if r.text and r.text.startswith("call"))
    assert call == "call <PHONE> or write to <EMAIL>, card <CARD>, host <IP> and 999.1.1.1"


def test_base_spans_follow_the_patterns():
    import re

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0

    patterns = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub("[ -]", "", m)) <= 19 and luhn(re.sub("[ -]", "", m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
    }
    rnd = random.Random(8)
    for _ in range(3000):
        text = "".join(rnd.choice("0123459.@+- ()ab") for _ in range(rnd.randrange(60)))
        want = [(k, *m.span()) for k, (p, ok) in patterns.items() for m in re.finditer(p, text) if ok(m[0])]
        assert pii.base_spans(text) == want, text


def test_em_finds_the_reliable_labelers():
    rnd = np.random.default_rng(1)
    rows = Counter()
    for _ in range(4000):
        y = rnd.random() < 0.4
        right = [0.95, 0.9, 0.85, 0.8, 0.55]
        rows["card", tuple(int((1 if y else -1) * (1 if rnd.random() < p else -1)) for p in right)] += 1
    rel, prior, _ = pii.expectation_maximisation([(k, v, n) for (k, v), n in rows.items()])
    assert abs(prior[pii.KINDS.index("card")] - 0.4) < 0.05
    assert rel[0, 1, 2] > rel[3, 1, 2] > rel[4, 1, 2]
    model = pii.train([(k, v, n) for (k, v), n in rows.items()])
    held = [(rnd.random() < 0.4) for _ in range(500)]
    good = 0
    for y in held:
        v = tuple(int((1 if y else -1) * (1 if rnd.random() < p else -1)) for p in (0.95, 0.9, 0.85, 0.8, 0.55))
        good += (model.probability("card", v) >= 0.5) == y
    assert good / len(held) > 0.93


def test_packing(docs):
    library = Tokenizer.from_file(public_tokenizers.path(packing.FILE))
    rows = packing.packed(docs, public_tokenizers.path(packing.FILE)).collect()
    got = sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    want = []
    for i, t in pairs(docs):
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            want.append((str(i), k, at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes())))
    assert got == sorted(want)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= -(-sum(r.length for r in rows) // 4096) + 1


def test_best_two_fit_replaces_the_smallest():
    # 60 + 30 leaves 10; 30 gives way to 21 and 19, which fill the gap
    plan = packing.recipes({60: 1, 30: 1, 21: 1, 19: 1}, 100)
    assert plan[0] == (1, {60: 1, 21: 1, 19: 1})
    rnd = np.random.default_rng(3)
    counts = Counter(rnd.integers(1, 101, 5000).tolist())
    plan = packing.recipes(counts, 100)
    used = Counter()
    for times, bin_ in plan:
        assert sum(x * k for x, k in bin_.items()) <= 100
        for x, k in bin_.items():
            used[x] += times * k
    assert used == counts


def test_token_counts_of_every_prefix(docs):
    path = public_tokenizers.path(token_counts.FILE)
    library = Tokenizer.from_file(path)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs, path).collect()}
    assert got == {(i, len(t.encode()), count(t), count(t) > 512) for i, t in pairs(docs)}
    c = token_counts.counter(path)
    rnd = random.Random(4)
    odd = ["".join(rnd.choice(" \n\t'srtevmld.,!ab1é日<|>\r") for _ in range(rnd.randrange(30))) for _ in range(150)]
    for text in [*odd, "a <|endoftext|>b", "!!<|endoftext|>!!", "x   y 're"]:
        assert c.prefix_counts(text).tolist() == [count(text[:i]) for i in range(len(text) + 1)], text
    tables = token_counts.prefix_tables(docs, path)
    fits = {r.doc_id: r.chars for r in token_counts.longest_prefix(tables, 7).collect()}
    first = {r.doc_id: r.n_tokens for r in token_counts.tokens_before(tables, 5).collect()}
    for i, t in pairs(docs):
        if len(t) < 300:
            assert fits[i] == max(k for k in range(len(t) + 1) if count(t[:k]) <= 7)
            assert first[i] == count(t[:5])


def test_byte_bpe(docs):
    import tiktoken

    path = public_tokenizers.path(byte_bpe.FILE)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks(path), special_tokens={})
    want = []
    for i, t in pairs(docs):
        ids = library.encode_ordinary(t)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert as_rows(byte_bpe.round_trip(docs, path)) == sorted(want, key=str)
    ids = byte_bpe.encoded(docs, path)
    assert Counter(r.data.decode() for r in byte_bpe.decoded(ids, path).collect()) == Counter(t for _, t in pairs(docs))


def test_repeats(docs, spark):
    def brute(rows, size):
        seen = Counter(tuple(w[i : i + size]) for _, w in rows for i in range(len(w) - size + 1))
        out = []
        for doc, w in rows:
            gone = {j for i in range(len(w) - size + 1) if seen[tuple(w[i : i + size])] > 1 for j in range(i, i + size)}
            kept = " ".join(x for j, x in enumerate(w) if j not in gone)
            out.append((doc, len(w), len(gone), kept, hashlib.sha256(kept.encode()).hexdigest()))
        return sorted(out, key=str)

    assert as_rows(repeats.without_repeats(docs)) == brute([(i, words_of(t)) for i, t in pairs(docs)], 35)
    rnd = random.Random(6)  # few words, so that many overlapping windows repeat
    small = [(i, " ".join(rnd.choice("ab") for _ in range(rnd.randrange(120)))) for i in range(40)]
    small += [(90, "a " * 200), (91, "ab ba " * 80)]
    df = spark.createDataFrame(small, "doc_id long, text string")
    for size in (9, 35):
        assert as_rows(repeats.without_repeats(df, size)) == brute([(i, words_of(t)) for i, t in small], size)
    out = repeats.stripped(docs)
    assert out.columns == docs.columns and out.count() == docs.count()


def test_quality_and_other_queries_match_their_sql(spark, small):
    con = oracle.connect(small)
    for name in ("documents", "embeddings", "pages"):
        con.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    for name, text in queries.ORACLES.items():
        df, res = queries.QUERIES[name](spark, small), con.sql(text)
        assert sorted(df.columns) == sorted(res.columns), name
        assert oracle.rows(df.columns, df.collect()) == oracle.rows(list(res.columns), res.fetchall()), name


def test_quality_of_odd_texts(docs):
    got = {(r.doc_id, r.quality.n_words, r.quality.n_repeat_words, r.quality.n_dup_lines)
           for r in quality_rules.judged(docs.where("doc_id IS NOT NULL")).collect()}
    for i, t in pairs(docs):
        w = words_of(t)
        seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        cover = {j for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
        lines = [x for x in t.split("\n") if words_of(x)]
        assert i is None or (i, len(w), len(cover), len(lines) - len(set(lines))) in got
    assert quality_rules.kept_documents(docs).columns == docs.columns


def test_top_k(spark):
    rnd = np.random.default_rng(7)
    rows = [(i, rnd.normal(size=6).tolist()) for i in range(400)]
    rows += [(400, None), (500, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (600, [float("nan")] * 6), (700, [0.0] * 6), (800, rows[3][1]), (801, rows[3][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ok = {i: np.floor(np.array(v) * 1024).astype(int) for i, v in rows if v and None not in v and not np.isnan(v).any()}
    want = []
    for q in (i for i in ok if i % 100 == 0):
        best = sorted((-int(ok[q] @ v), i) for i, v in ok.items() if i != q)[:10]
        want += [(q, k, i, -s) for k, (s, i) in enumerate(best, 1)]
    assert as_rows(topk.top_k(df, block=64)) == sorted(want, key=str)
    assert topk.top_k(df.limit(0)).count() == 0


def test_revisits(spark):
    h = lambda **k: {n.replace("_", "-"): v for n, v in k.items()}
    rows = [
        ("a1", "http://www.x.org/p/?utm_source=z#t", "response", 1, 200, h(ETag='"1"', Content_Length="9", Cache_Control="old"), None),
        ("a2", "https://x.org/p", "response", 5, 200, h(ETag='"2"', Content_Length="8"), None),
        ("a3", "https://x.org/p", "response", 7, 404, {}, None),
        ("r1", "https://x.org/p", "revisit", 4, 304, h(etag='W/"1"', Content_Length="0", cache_control="new"), None),
        ("r2", "https://x.org/p", "revisit", 8, 304, h(etag='"1"'), None),
        ("r3", "https://x.org/p", "revisit", 1, 304, None, None),
        ("r4", "https://x.org/p", "revisit", 9, 304, None, None),
        ("r5", None, "revisit", 9, 304, None, None),
        ("r6", "https://x.org/p", "revisit", None, 304, None, None),
    ]
    schema = "record_id string, url string, warc_type string, t long, status int, headers map<string,string>, digest string"
    df = spark.createDataFrame(rows, schema).selectExpr("*", "timestamp_seconds(t) AS ts")
    got = {r.record_id: (r.outcome, r.refers_to) for r in revisits.resolved(df).collect()}
    assert got == {"r1": ("resolved", "a1"), "r2": ("mismatch", "a2"), "r3": ("no_response", None), "r4": ("unvalidated", "a2"),
                   "r5": ("no_response", None), "r6": ("no_response", None)}
    one = revisits.resolved(df).where("record_id = 'r1'").first().headers
    assert one == {"etag": 'W/"1"', "content-length": "9", "cache-control": "new"}


def test_licenses(spark):
    rows = [
        (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/c/x.py", "code"), (3, "a/b/LICENSE.txt", "nothing"),
        (4, "z/y.py", None), (5, "a/d/COPYING", "This work is licensed under the GNU General Public License, version 3."),
        (6, "a/d/e.py", "x\nLicensed under the Apache License, Version 2.0.\ny"), (7, "a/d/f.py", ""), (8, None, "text"),
    ]
    df = spark.createDataFrame(rows, "file_id long, path string, text string")
    got = {r.file_id: (r.license, r.via, r.from_folder) for r in licenses.scanned(df).collect()}
    assert got == {
        1: ("MIT", "own", None), 2: ("MIT", "inherited", "a"), 3: ("MIT", "inherited", "a"), 4: (None, "none", None),
        5: ("GPL-3.0", "own", None), 6: ("Apache-2.0", "own", None), 7: ("GPL-3.0", "inherited", "a/d"), 8: (None, "none", None),
    }


def test_empty_tables(nothing, spark):
    path = public_tokenizers.path
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.one_of_each(nothing).count() == 0
    assert pii.found(nothing, pii.learned(nothing)).count() == 0
    assert packing.packed(nothing, path(packing.FILE)).count() == 0
    assert quality_rules.kept_documents(nothing).count() == 0
    assert repeats.without_repeats(nothing).count() == 0
    assert licenses.scanned(queries.tree(nothing)).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert revisits.resolved(queries.crawl(pages)).count() == 0


def test_pipeline(spark, small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    base = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stored(stage(spark, docs, small))
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
            assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in docs.collect()} <= base
        docs = out
    assert docs.count() > 0


def test_pipeline_stages_keep_and_change_what_they_should(spark, small):
    """Each stage's rows against the SQL of the rules or a plain Python version, on rows that passed the ones before."""
    import corpus_pipeline

    con = oracle.connect(small)
    con.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stored(stage(spark, docs, small))
        rows, got = [r.asDict() for r in docs.collect()], [r.asDict() for r in out.collect()]
        if name == "quality":
            ids = {i for (i,) in con.sql(f"SELECT doc_id FROM ({queries.ORACLES['op6_quality']}) WHERE kept").fetchall()}
            want = [r for r in rows if r["doc_id"] in ids]
        elif name == "near_duplicates":
            ids = set(one_of_each_group([(r["doc_id"], r["text"]) for r in rows]))
            want = [r for r in rows if r["doc_id"] in ids]
        elif name == "repeated_passages":
            words = [words_of(r["text"]) for r in rows]
            seen = Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
            want = []
            for r, w in zip(rows, words, strict=True):
                gone = {j for i in range(len(w) - 34) if seen[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
                text = " ".join(x for j, x in enumerate(w) if j not in gone) if gone else r["text"]
                want.append(r | {"text": text, "n_chars": len(text)})
        elif name == "personal_data":
            votes = Counter((s[0], tuple(v)) for r in rows for s, _, v in pii.proposals(r["text"]))
            model = pii.train(sorted((k, v, n) for (k, v), n in votes.items()))
            texts = [pii.masked_text(r["text"], pii.spans_of(r["text"], model)[1]) for r in rows]
            want = [r | {"text": t, "n_chars": len(t)} for r, t in zip(rows, texts, strict=True)]
        else:
            library = Tokenizer.from_file(public_tokenizers.path(packing.FILE))
            want = []
            for r in rows:
                ids = np.array([*library.encode(r["text"], add_special_tokens=False).ids, 1], "<u4")
                cut = [(at, ids[at : at + 4096]) for at in range(0, len(ids), 4096)]
                want += [(r["doc_id"], k, at, len(x), zlib.crc32(x.tobytes())) for k, (at, x) in enumerate(cut)]
            got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got]
        assert want and sorted(got, key=str) == sorted(want, key=str), name
        docs = out


def test_word_memory_holds_a_large_vocabulary():
    enc = packing.WordEncoder(public_tokenizers.path(packing.FILE))
    words = [f"word{''.join(chr(97 + i // 26**k % 26) for k in range(4))}," for i in range(100_000)]
    first = enc.encode(" ".join(words))
    assert len(enc.word) == len(words) and len(enc.run) > len(words)  # nothing was dropped on the way
    assert enc.encode(" ".join(words)) == first
    assert enc.encode(" ".join(words[:50])) == np.array(enc.library.encode(" ".join(words[:50]), add_special_tokens=False).ids, "<u4").tobytes()
