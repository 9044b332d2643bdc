"""What the labelers and the classifier add to the exact patterns, held against planted spans."""

from __future__ import annotations

import random
import time
from collections import Counter

from layerlake.llm import pii


def planted(n: int, seed: int):
    """Texts with spans beyond the exact patterns: personal ones, and others that look alike. (text, personal, others)."""
    rnd = random.Random(seed)
    word = lambda: rnd.choice("lorem ipsum dolor sit amet the of and with from elit sed".split())
    number = lambda *sizes: "-".join("".join(rnd.choice("23456789") for _ in range(k)) for k in sizes)

    def card():  # a wrong check digit
        while True:
            d = rnd.choice("89017") + "".join(rnd.choice("0123456789") for _ in range(15))
            if not pii.luhn(d):
                return d

    def personal():
        return rnd.choice([
            lambda: ("", f"{word()}.{word()}[at]{word()}(dot){rnd.choice(['com', 'org', 'de'])}", "", "email"),
            lambda: ("please call ", number(3, 3, 4), "", "phone"),
            lambda: ("phone: ", f"({number(3)}) {number(3, 4)}", " ", "phone"),
            lambda: ("Tel. ", number(3, 3, 4).replace("-", "."), " or later", "phone"),
            lambda: ("server address ", ":".join(["2001"] + [f"{rnd.randrange(65536):x}" for _ in range(7)]), "", "ip"),
        ])()

    def other():
        return rnd.choice([
            lambda: ("part ", number(3, 3, 4), "", "phone"), lambda: ("order ", number(3, 3, 4), " shipped", "phone"),
            lambda: ("serial no. ", "1" + number(2, 3, 4), "", "phone"), lambda: ("", card(), "", "card"), lambda: ("checksum ", card(), "", "card"),
            lambda: ("", f"{word()}[at]{word()}.{rnd.choice(['py', 'txt', 'cfg'])}", "", "email"),
        ])()

    out = []
    for _ in range(n):
        text, good, bad = "", [], []
        for _ in range(rnd.randrange(1, 5)):
            text += " ".join(word() for _ in range(rnd.randrange(12, 20))) + " "
            pick = rnd.random()
            if pick < 0.25:
                text += rnd.choice([f"mail {word()}@{word()}.example.com", "+1 (415) 555-01" + number(2), "host 93.184.216.34", "visa 4111 1111 1111 1111"])
            else:
                before, span, after, kind = personal() if pick < 0.6 else other()
                (good if pick < 0.6 else bad).append((kind, len(text) + len(before), len(text) + len(before) + len(span)))
                text += before + span + after
            text += " " + " ".join(word() for _ in range(12)) + " "
        out.append((text, good, bad))
    return out


def learned(texts):
    votes = Counter((s[0], v) for t in texts for s, _, v in pii.proposals(t))
    return pii.train(sorted((k, v, n) for (k, v), n in votes.items()))


def test_precision_and_recall_on_planted_spans():
    """Learned without labels from one set of texts, measured on another."""
    model = learned([t for t, _, _ in planted(600, 1)])
    hits = found = wanted = 0
    for text, good, bad in planted(300, 2):
        base, every = pii.spans_of(text, model)
        more = set(every) - set(base)
        assert set(base) <= set(every)
        hits, found, wanted = hits + len(more & set(good)), found + len(more), wanted + len(good)
    print(f"precision {hits / found:.3f}, recall {hits / wanted:.3f} of {wanted} planted spans")
    assert hits / found >= 0.97 and hits / wanted >= 0.9


def test_what_is_accepted(docs_like=("call +1 (415) 555-0101", "a.b@c.example.org", "host 93.184.216.34", "card 4111 1111 1111 1111")):
    """Also when the corpus shows nothing but exact matches and a few wrong card numbers."""
    texts = [f"lorem {t} ipsum" for t in docs_like] * 40 + [f"dolor 98635{k:02}015560598 amet" for k in range(30)]
    model = learned(texts)

    def more(text):
        base, every = pii.spans_of(text, model)
        return [text[a:b] for _, a, b in every if (_, a, b) not in base]

    assert more("write to jo [at] mail (dot) com please") == ["jo [at] mail (dot) com"]
    assert more("my phone is 415-555-2671 thanks") == ["415-555-2671"]
    assert more("le des +1 \n(843) 555-7672 été") == ["(843) 555-7672"]
    assert more("replacement part 415-555-2671 in stock") == [] == more("order number 415-555-2671 of May")
    assert more("ie eu 8863693015560598 le des") == [] == more("token = 5d190bd7c06284de91015a36974748794293dd8a")
    assert more("x" * 5 + "[at]build.py is a file") == []


def test_long_local_parts_are_whole():
    text = "a" * 500 + "[at]mail.com"
    assert pii.wide_spans(text) == [("email", 0, len(text))]


def test_overlaps_and_patterns_are_linear():
    start = time.perf_counter()
    text = "call 415-555-2671 or +1 (415) 555-0101, " * 20_000
    assert sum(1 for _ in pii.proposals(text)) == 40_000
    pii.wide_spans("a" * 1_000_000 + " [at] ")
    assert time.perf_counter() - start < 30
    rnd = random.Random(1)
    for _ in range(300):
        spans = [("x", a, a + rnd.randrange(1, 9)) for a in (rnd.randrange(60) for _ in range(rnd.randrange(9)))]
        others = [("y", a, a + rnd.randrange(1, 9)) for a in (rnd.randrange(60) for _ in range(rnd.randrange(9)))]
        want = sorted(s for s in spans if not any(s[1] < e and b < s[2] for _, b, e in others))
        assert sorted(pii.apart(spans, others)) == want
