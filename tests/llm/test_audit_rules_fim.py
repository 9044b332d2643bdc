"""Source divergence, URL rules and fill-in-the-middle against plain versions, with odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from layerlake.llm import divergence, fill_middle, url_rules

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def distances(rows, least, top):
    """The audit by counting every term of every document."""
    docs, n, groups = defaultdict(set), Counter(), set()
    for r, (text, lang, source) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for term in TERM.findall((text or "").translate(LOWER)):
            docs[lang, term].add(r)
            n[lang, source, term] += 1
    out = []
    for lang in {g for g, _ in groups}:
        kept = [t for (g, t), d in docs.items() if g == lang and len(d) >= least]
        sources = sorted(s for g, s in groups if g == lang)

        def shares(counts):
            total = sum(counts.values()) + 5 * len(kept)  # noqa: B023
            return {t: 1 + 10**9 * (counts[t] + 5) // total for t in kept}  # noqa: B023

        p = {s: shares({t: n[lang, s, t] for t in kept}) for s in sources}
        q = shares({t: sum(n[lang, s, t] for s in sources) for t in kept})
        for s in sources:
            pair = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            term = [(t, p[s][t] - q[t]) for t in kept if n[lang, s, t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pair, len(pair)), ("term", term, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(ranked, 1)]
    return sorted(out, key=str)


def corpus():
    rnd = random.Random(3)
    words = ["The", "the", "(the)", "été", "ÉTÉ", "a-b", "a", "b,", "日本", "x1y", "it's", "end.", "\u00a0gap", "12", "--"]
    rows = []
    for _ in range(120):
        text = rnd.choice([" ", "\n", "\t"]).join(rnd.choices(words, k=rnd.randrange(0, 9)))
        rows.append((text, rnd.choice(["en", "de", None]), rnd.choice(["s0", "s1", "s2", None])))
    rows += [(None, "en", "only nulls"), ("", "fr", "s0"), ("rare", "fr", "s1"), ("w" * 50_000 + "," * 3, "en", "s0")]
    rows += [rows[0]] * 5 + [(" ".join(f"t{i}" for i in range(9_000)) + " the" * 500, "en", "s1")]
    return rows


@pytest.fixture
def texts(spark):
    return spark.createDataFrame([(*r, "k", 1) for r in corpus()], "text string, lang string, source string, chunk string, row int").repartition(3)


@pytest.mark.parametrize("least", [1, 3, 7, 25])
def test_divergence(texts, least, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 4)  # several blocks, and slices of one
    monkeypatch.setattr(divergence, "CELLS", 8)
    assert rows_of(divergence.audit(texts, least, 5)) == distances(corpus(), least, 5)


def test_terms_between_the_bounds_are_counted(spark):
    """No chunk reaches the number, all chunks of the term together may: copies in one document, or in several."""
    rows = [("foo, foo. foo!", "en", "a")] * 2 + [("bar,", "en", "a"), ("bar.", "en", "a"), ("bar!", "en", "b"), ("bar! bar.", "en", "b")]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    for least in (2, 3, 4, 5):
        assert rows_of(divergence.audit(df, least)) == distances(rows, least, 50)


def test_divergence_of_nothing(texts):
    assert divergence.audit(texts.limit(0)).count() == 0
    none = rows_of(divergence.audit(texts, 10_000))  # no term is kept: distances of 0
    assert none == distances(corpus(), 10_000, 50) and {r[4] for r in none} == {0}


def test_texts_are_counted_in_one_pass(spark, monkeypatch):
    """Also terms for which no bound decides: in too few documents as any one chunk, in enough as all of them."""
    passes, arrow_map = [], divergence.arrow_map
    monkeypatch.setattr(divergence, "arrow_map", lambda *a: passes.append(a[2]) or arrow_map(*a))
    rows = [(f"foo{mark} {mark}foo the", "en", source) for mark in ".,!?" for source in "ab"]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert rows_of(divergence.audit(df, 8)) == distances(rows, 8, 50)
    assert len(passes) == 1


def test_terms_are_cut_from_bytes():
    """Every code point, alone, between letters and beside its like."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for text in (" ".join(points), "Ab".join(points), "".join(points), "\x85\xa0 \u2028\x1c\u3000İK"):
        assert text.encode().translate(divergence.TERM_BYTES).split() == [t.encode() for t in TERM.findall(text.translate(LOWER))]


def test_shares_are_exact_beyond_64_bits(spark):
    most = (2**63 - 1) // 10**9 - 5  # the largest total that needs no decimals
    rows = [(n, total, v) for total in (0, 7, most - 1, most, most + 1, 10**16) for n in {0, 1, total // 3, total} if n <= total for v in (0, 1, 999_983)]
    df = spark.createDataFrame(rows, "n long, total long, v long")
    got = df.select("n", "total", "v", divergence.share("n", "total", 10**9, 5)).collect()
    assert [tuple(r) for r in got] == [(n, t, v, 1 + (n + 5) * 10**9 // max(t + 5 * v, 1)) for n, t, v in rows]


URLS = [
    None, "", "no scheme", "http://", "http:///x", "https://Example.ORG", "https://example.org/", "http://a.b.example.org/en/1", "x://example.org/en/12/3",
    "http://example.org/en/2?q=/en/1", "http://example.org/es", "http://example.org/es/", "http://notexample.org/es/x", "http://badexample.org.evil.com/de/a",
    "http://evil.com/de/", "http://com/fr/", "http://www.shop.com/fr/x#y", "http://www.shop.com/FR/x", "http://example.org:80/es/", "http://.org/", "http://org./",
    "http://a..org/x", "ftp://u@h.example.org/es/%C3%A9", "http://ÄB.org/é", "http://x.org?a/b", "http://x.org#a/b", "http://deep." + "a." * 200 + "org/" + "p/" * 500,
    "http://one.net/a/b/c", "http://two.one.net/a/b", "http://one.net/a", "http://one.net/\nnext", "a://b://c.org/x",
]
MORE = [*url_rules.RULES, ("ONE.net", "/a/b", "block"), ("one.net", "/a/b/c", "allow"), ("two.one.net", "/a/", "allow"), ("one.net", "", "block"),
        ("one.net", "/a/b", "allow"), ("", "/", "block"), (None, "/", "block"), ("x.org", None, "block"), ("s.net", "/", None)]


def verdict(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = host.translate(LOWER)
    fit = []
    for h, p, v in rules:
        h, p = (h or "").translate(LOWER), p or ""
        if h and v and (host == h or host.endswith("." + h)) and path.startswith(p):
            fit.append((len(h + p), len(h), h + p, v))
    return host, path, max(fit)[2] if fit else None, max(fit)[3] if fit else default


@pytest.mark.parametrize("rules", [url_rules.RULES, MORE, []])
@pytest.mark.parametrize("most_bytes", [1 << 20, -1])
def test_url_rules(spark, rules, most_bytes):
    """Also beyond the size that is broadcast."""
    rows = [(i if i % 9 else None, u, "h", "p") for i, u in enumerate(URLS + URLS[5:9])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, row string").repartition(3)
    got = url_rules.judged(pages, url_rules.rule_table(spark, rules), most_bytes=most_bytes)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert rows_of(got) == sorted(((i, *verdict(u, rules)) for i, u, *_ in rows), key=str)
    kept = url_rules.allowed(pages, url_rules.rule_table(spark, rules), most_bytes=most_bytes)
    assert kept.columns == pages.columns
    assert rows_of(kept) == sorted((r for r in rows if verdict(r[1], rules)[3] == "allow"), key=str)
    assert url_rules.judged(pages.limit(0), url_rules.rule_table(spark, rules)).count() == 0


def cut(i, text):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text or "")
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return i, n, "plain", text or ""
    return (i, n, "spm", f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (i, n, "psm", f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_the_middle(spark, small):
    rnd = random.Random(1)
    odd = [None, "", " ", "a", "<", "<S", "<P", "S><", "a<P>b", "<S>", "$1 \\1 $", "\r\n\u2028\u0085\x00", "é😀e\u0301 日本", "😀" * 7, "ab" * 40_000, "a1" * 200_000]
    odd += ["".join(rnd.choices("<PSM>ab \n😀é$\\", k=rnd.randrange(30))) for _ in range(300)]
    rows = [(i if i != 20 else None, t, "x", "y") for i, t in enumerate(odd)]
    rows.append(rows[10])
    docs = spark.createDataFrame(rows, "doc_id long, text string, h string, form string").repartition(3)
    out = fill_middle.transformed(docs)
    assert rows_of(out) == sorted((cut(i, t) for i, t, *_ in rows), key=str)
    back = out.select("doc_id", fill_middle.restored(out.output, out.form).alias("t"))
    assert rows_of(back) == sorted(((i, t or "") for i, t, *_ in rows), key=str)
    for r in fill_middle.digests(out).collect():
        if r.form == "plain":
            assert r.prefix_chars is None and r.middle_chars is None
    texts = {hashlib.sha256((t or "").encode()).hexdigest() for _, t, *_ in rows}
    assert {r.restored_sha256 for r in fill_middle.digests(out).collect()} == texts
    assert fill_middle.transformed(docs.limit(0)).count() == 0
    plan = fill_middle.transformed(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
