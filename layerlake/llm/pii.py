"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides on spans.

Spans of four kinds are proposed: by the exact patterns (``base``) and by wider
ones (disguised addresses, IPv6, card numbers with a wrong check digit, phone
numbers without a plus). Five labelers vote 1, -1 or 0 (no opinion) on each:

* check: the exact pattern and its check hold, or a check fails; a wider pattern that has no check has no say;
* gazetteer: known top-level domains, card issuers, calling and area codes, public and private networks;
* context: words for the kind, or for other numbers, among the ``BEFORE`` characters before and the ``AFTER`` after;
* form: usual lengths and groups, for cards those of the issuer;
* edges: the span stands free, or is cut out of a longer word or number.

Counts per vote pattern, made over all documents and at most a few thousand
rows, are all that expectation-maximisation needs to estimate how reliable
each labeler is and how likely each pattern is personal. Labelers are taken to
be right more often than not until the documents say otherwise (``TRUST``), so
that votes which a corpus never shows still count. A logistic classifier is
trained on these probabilities, every vote pattern weighing in by its number
and, faintly, all others; it decides on proposals beyond the base spans. Base
spans stay in any case; a proposal that overlaps a base span of any kind is none.

Null text counts as empty. Offsets are code points, ends exclusive. Rows are
handled alone; with an empty table there is nothing to learn and no row.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate, product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, free_name, id_text

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("check", "gazetteer", "context", "form", "edges")
SURE = 0.9
BEFORE, AFTER = 40, 20
#: Imagined shares of votes -1, 0 and 1 on spans that are none and on personal ones, and how much they weigh:
#: so many votes, and for each real one so much.
TRUST = np.array([[0.6, 0.35, 0.05], [0.05, 0.35, 0.6]])
TRUST_VOTES, TRUST_SHARE = 10.0, 0.5
FAINT = 20.0  # weight of all vote patterns together, seen or not

DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?+[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
AT = re.compile(r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]++) ?[\[({] ?[aA][tT] ?[\])}] ?([A-Za-z0-9-]++(?: ?(?:\.|[\[({] ?[dD][oO][tT] ?[\])}]) ?[A-Za-z0-9-]++)++)")
AT_SIGN = re.compile(r"[\[({] ?[aA][tT] ?[\])}]")
IPV6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
PLAIN_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
DIGIT = re.compile("[0-9]").search

#: Gazetteers and context words (fixed values).
TOP_LEVEL = frozenset("com org net edu gov info io de fr es uk eu ch at it nl be pl ru cn jp br in us ca au".split())
HINTS = {
    "email": re.compile(r"(?i)\b(e-?mails?|mail|contact|kontakt|correo|courriel|write|reach)\b"),
    "ip": re.compile(r"(?i)\b(ip|address|adresse|host|server|client|login|addr)\b"),
    "card": re.compile(r"(?i)\b(card|karte|carte|tarjeta|visa|mastercard|amex|credit|payment)\b"),
    "phone": re.compile(r"(?i)\b(phone|tel|telefon|telephone|mobile|call|fax|teléfono|téléphone|handy)\b"),
}
CODE = re.compile(r"\+[0-9]{1,3}\s+$")
OTHER = re.compile(r"(?i)\b(sha\d*|hash|token|key|isbn|issn|version|order|invoice|serial|checksum|build|uuid|commit|part|item|sku|ticket)\b")
#: Card issuers by first digits, and the lengths of their numbers (fixed values).
ISSUERS = [
    ("4", (13, 16, 19)), ("5[1-5]", (16,)), ("2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)", (16,)), ("3[47]", (15,)), ("6(?:011|5|4[4-9])", (16, 19)),
    ("3(?:0[0-5]|[68])", (14,)), ("35", (16,)),
]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The exact spans, kind by kind in order; leftmost matches that do not overlap, failing ones dropped."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:  # a match holds one @ after a run of local characters, so only those are visited
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        end = DOMAIN.match(text, at + 1) if start < at else None
        if end:
            out.append(("email", start, end.end()))
            done = end.end()
        else:
            done = at + 1  # no later match can reach back over this @
        at = text.find("@", max(done, at + 1))
    if DIGIT(text):
        for m in IP.finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
                out.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(d := digits(m[0])) <= 19 and luhn(d):
                out.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(digits(m[0])) <= 15:
                    out.append(("phone", *m.span()))
    return out


def wide_spans(text: str) -> list[tuple[str, int, int]]:
    """Proposals beyond the exact patterns."""
    out = []
    if AT_SIGN.search(text):
        out += [("email", *m.span()) for m in AT.finditer(text)]
    if DIGIT(text):
        if text.count(":") >= 7:
            out += [("ip", *m.span()) for m in IPV6.finditer(text)]
        out += [("card", *m.span()) for m in CARD.finditer(text) if m.end() - m.start() >= 13 and 13 <= len(digits(m[0])) <= 19]
        out += [("phone", *m.span()) for m in PLAIN_PHONE.finditer(text)]
    return out


def votes(text: str, kind: str, start: int, end: int, exact: bool) -> tuple[int, ...]:
    """Votes of the five labelers, in order."""
    span = text[start:end]
    figures = digits(span)
    before, after = text[max(0, start - BEFORE) : start], text[end : end + AFTER]
    check = int(exact)
    if kind == "email":
        known = 1 if re.split(r"[^A-Za-z0-9]+", span.lower().rstrip("])}"))[-1] in TOP_LEVEL else -1
        form = 1 if 6 <= len(span) <= 80 else -1
    elif kind == "ip":
        if ":" in span:
            known, form = (1 if span[0] in "23" else -1), 1
        else:
            known = -1 if span.startswith(("10.", "127.", "192.168.", "0.")) else 0
            form = -1 if re.search(r"(?:^|\.)0[0-9]", span) else 1
    elif kind == "card":
        check = 1 if exact else -1  # its check digit is wrong
        lengths = next((n for begin, n in ISSUERS if re.match(begin, figures)), None)
        known = 1 if lengths else -1
        groups = [len(g) for g in re.split("[ -]", span)]
        usual = groups in ([4, 4, 4, 4], [4, 6, 5], [4, 6, 4], [len(figures)])
        form = 1 if usual and len(figures) in (lengths or (13, 14, 15, 16, 19)) else -1
    elif exact:
        known = 1 if re.match(r"\+(?:1|3[0-9]|4[0-9]|5[1-8]|6[0-6]|7|8[1-6]|9[0-8])", span) else 0
        form = 1 if 10 <= len(figures) <= 13 else -1
    else:  # area code and exchange; most numbers have possible ones
        known, form = (0 if figures[0] in "23456789" and figures[3] in "23456789" else -1), 1
    hint = 1 if HINTS[kind].search(before) or HINTS[kind].search(after) else 0
    if kind == "phone" and CODE.search(before):
        hint = 1  # a calling code, cut off by a line end
    if not hint and (OTHER.search(before) or OTHER.search(after)):
        hint = -1
    around = text[start - 1 : start] + text[end : end + 1] if start else text[end : end + 1]
    edges = -1 if any(c.isalnum() or c in "_#" for c in around) else 1
    return check, known, hint, form, edges


def apart(spans: list[tuple], others: list[tuple]) -> list[tuple]:
    """The spans (kind, start, end) that overlap none of the others, by start."""
    order = sorted((s[1], s[2]) for s in others)
    starts, reach = [a for a, _ in order], [0, *accumulate((b for _, b in order), max)]
    # those that begin before a span ends must all end before it begins
    return [s for s in sorted(spans, key=lambda s: (s[1], s[2])) if reach[bisect_left(starts, s[2])] <= s[1]]


def proposals(text: str):
    """((kind, start, end), exact, votes) of every base span and of wider ones that overlap no base span."""
    base = base_spans(text)
    for s in base:
        yield s, True, votes(text, *s, True)
    wide = wide_spans(text)
    if wide:
        for s in apart(wide, base):
            yield s, False, votes(text, *s, False)


@dataclass(frozen=True)
class Model:
    """``weights`` of the classifier; ``reliability[j, y, v + 1]`` is how often labeler j says v of class y; ``prior`` by kind."""

    weights: np.ndarray
    reliability: np.ndarray
    prior: np.ndarray

    def probability(self, kind: str, vote: tuple[int, ...]) -> float:
        return float(1 / (1 + np.exp(-features(kind, vote) @ self.weights)))


def features(kind: str, vote) -> np.ndarray:
    """Kind, and for each labeler whether it is for or against."""
    return np.array([float(kind == k) for k in KINDS] + [float(v == x) for v in vote for x in (1, -1)])


def posterior(kinds: np.ndarray, votes: np.ndarray, reliability: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """How likely spans with these votes (0, 1, 2 for -1, 0, 1) are personal."""
    score = np.log(prior[kinds] / (1 - prior[kinds]))
    for j in range(votes.shape[1]):
        score = score + np.log(reliability[j, 1, votes[:, j]] / reliability[j, 0, votes[:, j]])
    return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


def expectation_maximisation(rows: list[tuple], rounds: int = 200):
    """Reliabilities of labelers that err independently given the class, and each pattern's probability of being personal.

    ``rows``: (kind, votes, count). Starts from the labelers' balance.
    """
    kinds = np.array([KINDS.index(k) for k, _, _ in rows])
    v = np.array([x for _, x, _ in rows]) + 1
    n = np.array([c for _, _, c in rows], float)
    p = 1 / (1 + np.exp(-1.5 * ((v - 1).sum(1) + 2 * (v[:, 0] - 1))))  # checks count three times
    for _ in range(rounds):
        weight = np.stack([n * (1 - p), n * p])
        rel = np.array([[[(weight[y] * (v[:, j] == x)).sum() for x in range(3)] for y in (0, 1)] for j in range(v.shape[1])])
        rel = rel + TRUST * (TRUST_VOTES + TRUST_SHARE * weight.sum(1))[:, None]
        rel /= rel.sum(2, keepdims=True)
        prior = np.array([((n * p)[kinds == k].sum() + 1) / (n[kinds == k].sum() + 2) for k in range(len(KINDS))])
        new = posterior(kinds, v, rel, prior)
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return rel, prior, p


def train(rows: list[tuple], ridge: float = 1.0, rounds: int = 50) -> Model:
    """A logistic classifier on the probabilities that EM gives, by Newton's method with a ridge."""
    if not rows:
        size = len(KINDS) + 2 * len(LABELERS)
        flat = np.full((len(LABELERS), 2, 3), 1 / 3)
        return Model(np.full(size, -10.0), flat, np.full(len(KINDS), 0.5))
    rel, prior, p = expectation_maximisation(rows)
    space = [(k, v) for k in range(len(KINDS)) for v in product((-1, 0, 1), repeat=len(LABELERS))]
    unseen = posterior(np.array([k for k, _ in space]), np.array([v for _, v in space]) + 1, rel, prior)
    x = np.array([features(k, v) for k, v, _ in rows] + [features(KINDS[k], v) for k, v in space])
    n = np.array([c for _, _, c in rows] + [FAINT / len(space)] * len(space), float)
    p = np.concatenate((p, unseen))
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (n * q * (1 - q))) @ x + ridge * np.eye(len(w)), x.T @ (n * (p - q)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return Model(w, rel, prior)


def vote_counts(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """kind, v0..v4 and n: how many proposals of all documents got these votes."""

    def make():
        def work(ids, texts):
            seen = Counter((s[0], v) for text in texts.to_pylist() for s, _, v in proposals(text))
            if seen:
                yield [k for k, _ in seen], *(list(c) for c in zip(*(v for _, v in seen), strict=True)), list(seen.values())

        return work

    names = [f"v{i}" for i in range(len(LABELERS))]
    schema = "kind string, " + ", ".join(f"{c} int" for c in names) + ", n long"
    rows = arrow_map(id_text(docs, id_col, text_col), make, schema)
    return rows.groupBy("kind", *names).agg(F.sum("n").alias("n"))


def learned(docs: DataFrame, id_col="doc_id", text_col="text") -> Model:
    """The model from all documents; what is collected is one row per vote pattern, at most 4 x 3^5."""
    rows = [(r[0], tuple(r[1:-1]), r[-1]) for r in vote_counts(docs, id_col, text_col).collect()]
    return train(sorted(rows))


def spans_of(text: str, model: Model, sure: float = SURE) -> tuple[list[tuple], list[tuple]]:
    """(base spans, all spans): the base ones, and wider ones the classifier is sure of that overlap no other."""
    base, more = [], []
    for s, exact, v in proposals(text):
        if exact:
            base.append(s)
        elif model.probability(s[0], v) >= sure and (not more or more[-1][2] <= s[1]):  # they come by start
            more.append(s)
    order = {k: i for i, k in enumerate(KINDS)}
    return base, sorted(base + more, key=lambda s: (order[s[0]], s[1]))


def shown(spans: list[tuple]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def found(docs: DataFrame, model: Model, sure: float = SURE, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, numbers of base spans by kind, base_sha256, and spans (kind:start:end, comma-joined)."""

    def make():
        def work(ids, texts):
            rows = []
            for text in texts.to_pylist():
                base, every = spans_of(text, model, sure)
                n = Counter(k for k, _, _ in base)
                rows.append((*(n[k] for k in KINDS), hashlib.sha256(shown(base).encode()).hexdigest(), shown(every)))
            yield ids, *map(list, zip(*rows, strict=True))

        return work

    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    return arrow_map(id_text(docs, id_col, text_col), make, schema)


def masked_text(text: str, spans: list[tuple]) -> str:
    """Each stretch of spans that touch or overlap replaced by the mark of the first one's kind, as ``<EMAIL>``."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"<{kind.upper()}>"]
        done = max(done, b)
    return "".join(out) + text[done:]


def masked(docs: DataFrame, model: Model, sure: float = SURE, text_col="text", chars_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data masked in the text; null stays null. A ``chars_col``, if there, gets the new length."""

    def mask(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else masked_text(t, spans_of(t, model, sure)[1]))

    new = F.pandas_udf(mask, "string")(F.col(f"`{text_col}`"))
    temp = free_name(docs, "_text")
    rows = docs.withColumn(temp, new)
    kept = [F.col(f"`{temp}`").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    if chars_col in docs.columns:
        at = docs.columns.index(chars_col)
        kept[at] = F.char_length(f"`{temp}`").cast(docs.schema[chars_col].dataType).alias(chars_col)
    return rows.select(*kept)
