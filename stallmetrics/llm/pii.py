"""Personal data by weak supervision: labelers vote on spans, expectation-maximisation weighs them, a classifier decides.

A task reads a text once and returns its candidate spans. Four base patterns (e-mail, IP address, payment card, phone) give
spans that always stay. Wider patterns give doubtful ones: addresses with a written-out "at" and "dot", numbers that fail a
check, phone numbers without a plus sign, groups of digits with other separators, IPv6 addresses. On every candidate six labelers vote
yes, no or nothing: ``shape`` and ``check`` (regular expressions and check digits), ``gazetteer`` (lists of name endings, number ranges
and country codes), ``before`` and ``after`` (words around it) and ``edges`` (what touches it).

How reliable a labeler is, and how common personal data is among the candidates of a kind, is estimated by
expectation-maximisation over the counts of all vote patterns of all documents: at most 3 ** 6 rows a kind, so the driver holds
a table of fixed size. Each labeler starts from a first belief (``BELIEFS``), which keeps its weight against the counts in every step: that
fixes which class is which, and that personal data hardly ever fails its check. The classifier is a logistic regression on ``BITS`` yes-or-no features of a span, fitted to the probabilities that
the votes were given; again the driver sees only counts by feature pattern, at most 2 ** BITS rows a kind. A candidate
that the classifier gives ``SURE`` or more is added, unless it overlaps a base span.

Defined cases: a null or empty text has no spans; a null id is returned as null; repeated rows are rows of their own. Only
``doc_id`` and ``text`` are read. Offsets are code points, ends exclusive. Without any candidate no model is needed, and none is fitted.
Numbers of any length are compared without being converted. Spans of one kind never overlap; spans of different kinds may.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallmetrics.llm.shared import rows_of, settle

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("shape", "check", "gazetteer", "before", "after", "edges")
#: Votes.
NO, YES, NOTHING = 0, 1, 2
PATTERNS = 3 ** len(LABELERS)
#: Features of a span for the classifier.
BITS = 12
#: A doubtful candidate is added from this probability.
SURE = 0.5
#: Steps of expectation-maximisation and of the regression.
STEPS = 60
#: The first belief's weight for each candidate counted; that in check digits and number ranges, which are facts, counts most.
BELIEF = {name: 1.0 for name in LABELERS} | {"check": 50.0}
#: First belief in a labeler: rates of its votes (no, yes, nothing) on other spans, and on personal data.
BELIEFS = {name: ((0.4, 0.2, 0.4), (0.1, 0.5, 0.4)) for name in LABELERS} | {"check": ((0.6, 0.1, 0.3), (0.005, 0.695, 0.3))}
#: Code points around a span in which its words are looked for.
AROUND = 32

# Gazetteers.
ENDINGS = frozenset("com org net edu gov mil int info biz io co us uk de fr es it nl at ch eu be pt pl se no dk fi ie ca au br mx ar in cn jp".split())
COUNTRY_CODES = ("1", "7", "20", "27", "3", "4", "5", "6", "8", "9")
CARD_STARTS = ("4", "51", "52", "53", "54", "55", "2", "34", "37", "36", "6011", "65", "35", "62")
CONTEXT = {
    "email": ("mail", "contact", "write to", "kontakt", "courriel", "correo", "reach"),
    "ip": ("ip", "address", "host", "server", "adresse", "login", "client", "ping"),
    "card": ("card", "visa", "master", "amex", "karte", "carte", "tarjeta", "payment", "credit"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "handy", "anruf", "appel", "llama", "cell"),
}
AGAINST = {
    "email": ("look", "meet", "arrive"),
    "ip": ("version", "release", "section", "chapter", "build", "v."),
    "card": ("isbn", "order", "serial", "id", "token", "hash", "ticket", "tracking"),
    "phone": ("isbn", "order", "serial", "id", "token", "score", "pages", "year"),
}


@dataclass(frozen=True)
class Candidate:
    kind: int
    start: int
    end: int
    base: bool
    votes: int = 0
    bits: int = 0


# --- patterns --------------------------------------------------------------------------------------------------------

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_AT = re.compile(r"[\[({ ] ?at ?[\])} ]")
_SPOKEN_HOST = re.compile(r"[A-Za-z0-9-]+(?:(?: ?[\[({] ?dot ?[\])}] ?| dot |\.)[A-Za-z0-9-]+)+")
# A run of digits that fails once fails from each of its digits, so a match need only begin at its first: the pattern looks back
# behind its first digit, which is faster to search for than a place without a digit before it.
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*(?:\.[0-9]+){3}")
_IP6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_DIGITS = re.compile(r"(?<![0-9])[0-9]{13,19}(?![0-9])")
_CARD_WIDE = re.compile(r"[0-9](?<![0-9][0-9])[0-9]{3}([._/])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_PHONE_WIDE = re.compile(r"[(0-9][0-9]{1,4}[) .-] ?[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9]|[.-][0-9])")


def octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def luhn(digits: str) -> bool:
    back = [int(c) for c in reversed(digits)]
    return sum(back[0::2] + [sum(divmod(2 * d, 10)) for d in back[1::2]]) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _mails(text: str, at: Iterator[tuple[int, int]], host: re.Pattern) -> Iterator[tuple[int, int]]:
    """Addresses around the marks ``at``: all letters before one that none of the earlier matches took, and a host after it."""
    last = 0
    for mark, behind in at:
        start = mark
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = host.match(text, behind) if last <= start < mark else None
        if found:
            yield start, found.end()
            last = found.end()


def _marks(text: str) -> Iterator[tuple[int, int]]:
    at = text.find("@")
    while at >= 0:
        yield at, at + 1
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int, bool]]:
    """Kind, start, end and whether the check passes, of all matches of the base patterns, by kind and start."""
    found = [(0, a, b, True) for a, b in _mails(text, _marks(text), _HOST)]
    found += [(1, m.start(), m.end(), all(map(octet, m.group().split(".")))) for m in _IP.finditer(text)]
    for m in _CARD.finditer(text):
        size = m.end() - m.start()
        if size >= 12:  # shorter ones cannot have the digits
            digits = digits_of(m.group())
            found.append((2, m.start(), m.end(), 16 <= len(digits) <= 19 and luhn(digits)))
    found += [(3, m.start(), m.end(), 8 <= len(digits_of(m.group())) <= 15) for m in _PHONE.finditer(text)]
    return found


def _spoken_marks(text: str) -> Iterator[tuple[int, int]]:
    for m in _AT.finditer(text):
        yield m.start() - (text[m.start() - 1 : m.start()] == " "), m.end() + (text[m.end() : m.end() + 1] == " ")


def wide_spans(text: str) -> Iterator[tuple[int, int, int]]:
    """Kind, start and end of what only looks like personal data."""
    yield from ((0, a, b) for a, b in _mails(text, _spoken_marks(text), _SPOKEN_HOST))
    if text.count(":") >= 7:
        yield from ((1, m.start(), m.end()) for m in _IP6.finditer(text))
    yield from ((2, m.start(), m.end()) for m in _CARD_WIDE.finditer(text))
    for m in _PHONE_WIDE.finditer(text):
        if text[m.start() - 1 : m.start()] not in tuple("0123456789+.(-") and (m.group()[0] == "(") == (")" in m.group()):
            yield 3, m.start(), m.end()


def _vote(yes: bool, no: bool) -> int:
    return YES if yes and not no else NO if no and not yes else NOTHING


def judged(text: str, kind: int, start: int, end: int, base: bool) -> tuple[int, int]:
    """The labelers' votes, as a number to base three, and the features, as bits."""
    span, name = text[start:end], KINDS[kind]
    before, after = text[max(0, start - AROUND) : start].lower(), text[end : end + AROUND].lower()
    left, right = text[start - 1 : start], text[end : end + 1]
    digits = digits_of(span[:64])
    marks = {c for c in span[:64] if not c.isalnum()}
    touches = left.isalnum() or right.isalnum()
    if kind == 0:
        parts = re.split(r"\W*\bdot\b\W*|\.", span[-64:].lower())
        shape, check = "@" in span, len(parts) > 1 and 2 <= len(parts[-1]) <= 6 and parts[-1].isalpha()
        listed, size_fits, even = parts[-1] in ENDINGS, 6 <= len(span) <= 64, True
        unlisted = not check
    elif kind == 1:
        octets = span.split(".")
        shape, check = len(octets) == 4, ":" in span or all(map(octet, octets))
        first = octets[0].lstrip("0")
        listed, unlisted = check and first not in ("", "255"), first in ("", "255")
        size_fits, even = 7 <= len(span) <= 39, not any(len(o) > 1 and o[0] == "0" for o in octets)
    elif kind == 2:
        shape, check = 16 <= len(digits) <= 19, luhn(digits)
        listed, unlisted = digits.startswith(CARD_STARTS), digits.startswith(("0", "9"))
        size_fits, even = 13 <= len(digits) <= 19, len(marks) <= 1
    else:
        shape, check = span[0] == "+", 8 <= len(digits) <= 15
        listed = shape and digits.startswith(COUNTRY_CODES)
        unlisted = digits.startswith("0000") or len(set(digits)) < 3
        size_fits, even = 9 <= len(digits) <= 13, len(marks) <= 4
    speaks, denies = (any(w in before for w in words[name]) for words in (CONTEXT, AGAINST))
    unit = after[:1] in ("%", "€", "$") or after.lstrip()[:2] in ("kg", "km", "cm", "eu", "us")
    quoted = left in ("\"", "'", "=", "#", "/") or before.rstrip().endswith("=")
    votes = (
        _vote(shape, not shape), _vote(check, not check), _vote(listed, unlisted), _vote(speaks, denies),
        _vote(any(w in after for w in CONTEXT[name]), unit), _vote(not touches and not quoted, touches or quoted),
    )
    bits = (
        base, shape, check, listed, speaks, denies, touches, quoted, unit, size_fits, even, start == 0 or left == "\n",
    )
    number = 0
    for v in votes:
        number = number * 3 + v
    return number, sum(1 << i for i, b in enumerate(bits) if b)


def candidates_of(text: str) -> list[Candidate]:
    """All base spans, and what else may be personal data and overlaps none of them, by kind and start."""
    found, doubtful = [], []
    for kind, start, end, good in base_spans(text):
        if good:
            found.append((kind, start, end, True))
        elif kind == 2:  # a card number may stand beside other numbers
            groups = [(2, start + m.start(), start + m.end()) for m in _DIGITS.finditer(text[start:end])]
            doubtful += groups or [(2, start, end)] * (len(digits_of(text[start:end])) <= 24)
        elif kind == 1 or 7 <= len(digits_of(text[start:end])) <= 24:
            doubtful.append((kind, start, end))
    doubtful += wide_spans(text)
    if doubtful:
        taken = bytearray(len(text))
        for _, start, end, _ in found:
            taken[start:end] = b"\1" * (end - start)
        for kind, start, end in sorted(doubtful):
            if 1 not in taken[start:end]:
                taken[start:end] = b"\1" * (end - start)
                found.append((kind, start, end, False))
    return [Candidate(*c, *judged(text, *c)) for c in sorted(found)]


_SPANS = "array<struct<kind:int,start:int,end:int,base:boolean,votes:int,bits:int>>"


def candidate_spans(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans``, a row for each document: its candidates without its text."""
    fields = [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("votes", pa.int32()), ("bits", pa.int32())]

    def find(batches):
        for batch, texts in rows_of(batches, "text"):
            spans = [[c.__dict__ for c in candidates_of(t.decode())] for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(pa.struct(fields)))], ["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(find, f"doc_id {kind}, spans {_SPANS}")


# --- what the votes and the features are worth -----------------------------------------------------------------------


def reliabilities(votes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """By expectation-maximisation over vote patterns: probability of each pattern, (labeler, class, vote) rates, share of class 1.

    ``votes`` has a row for each pattern and a column for each labeler; ``counts`` says how often a pattern occurs.
    """
    rates = np.array([BELIEFS[name] for name in LABELERS])
    belief = rates * counts.sum() * np.array([BELIEF[name] for name in LABELERS])[:, None, None]
    share, labeler = 0.5, np.arange(votes.shape[1])
    for _ in range(STEPS):
        score = np.log(rates[labeler, :, votes]).sum(axis=1) + np.log([1 - share, share])
        likely = 1 / (1 + np.exp(score[:, 0] - score[:, 1]))
        weight = np.stack((counts * (1 - likely), counts * likely))
        share = (weight[1].sum() + 1) / (counts.sum() + 2)
        for j in labeler:
            rates[j] = belief[j] + np.stack([np.bincount(votes[:, j], w, minlength=3) for w in weight])
        rates /= rates.sum(axis=2, keepdims=True)
    return likely, rates, float(share)


def regression(bits: np.ndarray, likely: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression (the constant last) fitted by Newton steps to weighted probabilities."""
    x = np.column_stack(((bits[:, None] >> np.arange(BITS)) & 1, np.ones(len(bits)))).astype(float)
    w = np.zeros(BITS + 1)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (counts * (likely - p)) - w
        bend = (x * (counts * p * (1 - p))[:, None]).T @ x + np.eye(BITS + 1)
        step = np.linalg.solve(bend, slope)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return w


@dataclass(frozen=True)
class Model:
    """For every kind: the rates of its labelers, the share of personal data, and the accepted feature patterns."""

    rates: dict[str, np.ndarray]
    share: dict[str, float]
    accepted: bytes

    def accepts(self, span: Column) -> Column:
        at = (span["kind"] * (1 << BITS) + span["bits"] + 1).cast("int")
        return F.lit(bytearray(self.accepted)).substr(at, F.lit(1)) == F.lit(bytearray(b"\1"))


def votes_of(number: np.ndarray) -> np.ndarray:
    return np.stack([number // 3 ** (len(LABELERS) - 1 - j) % 3 for j in range(len(LABELERS))], axis=1)


def fit(spans: DataFrame) -> Model:
    """The model for the candidates of all documents of ``spans``."""
    patterns = spans.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.votes", "s.bits").agg(F.count(F.lit(1)).alias("n"))
    patterns = settle(patterns)
    accepted = bytearray(len(KINDS) << BITS)
    rates, share = {}, {}
    by_votes = patterns.groupBy("kind", "votes").agg(F.sum("n").alias("n")).collect()  # at most PATTERNS rows a kind
    sure: list[tuple[int, int, int]] = []
    for kind, name in enumerate(KINDS):
        rows = sorted((r.votes, r.n) for r in by_votes if r.kind == kind)
        if rows:
            number, counts = (np.array(x, np.int64) for x in zip(*rows, strict=True))
            likely, rates[name], share[name] = reliabilities(votes_of(number), counts)
            sure += [(kind, int(v), round(float(p) * 1_000_000)) for v, p in zip(number, likely, strict=True)]
    if sure:
        # the probabilities of the votes, summed as whole numbers so that no order of rows shows
        millionths = [0] * (len(KINDS) * PATTERNS)
        for kind, votes, p in sure:
            millionths[kind * PATTERNS + votes] = p
        weighed = patterns.withColumn("p", F.get(F.lit(millionths), F.col("kind") * PATTERNS + F.col("votes")))
        by_bits = weighed.groupBy("kind", "bits").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("p")).alias("p")).collect()  # at most 2 ** BITS a kind
        for kind in range(len(KINDS)):
            rows = sorted((r.bits, r.n, r.p) for r in by_bits if r.kind == kind)
            if rows:
                bits, counts, p = (np.array(x, np.int64) for x in zip(*rows, strict=True))
                w = regression(bits, p / counts / 1_000_000, counts.astype(float))
                every = np.arange(1 << BITS)
                good = ((every[:, None] >> np.arange(BITS)) & 1) @ w[:BITS] + w[BITS] >= np.log(SURE / (1 - SURE))
                accepted[kind << BITS : (kind + 1) << BITS] = good.astype(np.uint8).tobytes()
    return Model(rates, share, bytes(accepted))


# --- results ---------------------------------------------------------------------------------------------------------


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans``, an array of ``(kind, start, end, base)`` by kind and start, a row for each document."""
    found = settle(candidate_spans(docs))
    model = fit(found)
    names = F.array(*[F.lit(k) for k in KINDS])
    kept = F.filter("spans", lambda s: s["base"] | model.accepts(s))
    return found.select("doc_id", F.transform(kept, lambda s: F.struct(
        F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base"))).alias("spans"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def pii_report(docs: DataFrame) -> DataFrame:
    """Counts and digest of every document's base spans, and all its spans."""
    found = personal_data(docs)
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter(base, _of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))
