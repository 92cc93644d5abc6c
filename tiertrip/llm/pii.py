"""Personal data by weak supervision.

Base spans are found by four patterns with checks (see :data:`KINDS`); they are always reported.
Looser patterns propose further spans: numbers that a longer failing match swallowed, national
telephone numbers, spelled-out and non-ASCII mail addresses, IPv6 addresses. Six labelers vote yes,
no or abstain on every candidate, base spans included: the strict pattern on the span alone, the structure (checksum,
digit counts), a gazetteer (issuer prefixes, calling codes, top-level domains, reserved networks),
words before it that name the kind, words before it that name something else, and the characters
around it. Spark counts the candidates of each (kind, votes, shape); expectation-maximisation on
that table estimates the labelers' reliabilities, its posteriors are the soft labels of a logistic
span classifier on votes and shape, and a proposed span is added when the classifier gives it at
least ``threshold``. The table has at most 4 x 3^6 x 8 rows, whatever the corpus.

Texts are read once, whole; what the second step needs is written as a small table. Nothing but
counts is shuffled.

Edge cases. NULL text counts as empty: no spans, the hash of the empty string. Every pattern runs in
time linear in the text, also on long runs of digits or letters. Repeated rows get equal results.
Added spans overlap no base span and not each other. Only the named columns are read.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import weak_labels
from .common import col, stash
from .weak_labels import ABSTAIN, NO, YES

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile("[0-9]")
# A match never starts inside a run of digits, so looking behind keeps it leftmost and linear.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Looser patterns. None has two adjacent unbounded repeats over the same characters.
_MORE_EMAIL = [
    re.compile(r"(?<![\w.+-])[\w.+-]{1,64}@(?:[^\W_][\w-]{0,62}\.){1,8}[^\W\d_]{2,24}(?![\w-])"),
    re.compile(r"(?<![\w.+-])[\w.+-]{1,64} ?(?:\(at\)|\[at\]|\{at\}) ?[\w-]{1,63}"
               r"(?: ?(?:\(dot\)|\[dot\]|\{dot\}|\.) ?[\w-]{1,63}){1,4}", re.I)]
_MORE_IP = [re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])")]
_MORE_CARD = [re.compile(r"(?<![0-9.-])[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])"),
              re.compile(r"(?<![0-9.-])3[47][0-9]{2}([ -]?)[0-9]{6}\1[0-9]{5}(?![0-9])")]
_MORE_PHONE = [re.compile(r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{4}(?![0-9])"),
               re.compile(r"(?<![\w.+)-])\(?[2-9][0-9]{2}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![\w.-])")]
_MORE = dict(zip(KINDS, (_MORE_EMAIL, _MORE_IP, _MORE_CARD, _MORE_PHONE)))

_NAMED = {"email": r"e-?mail|mail|correo|courriel|contact|write|to", "ip": r"ip|address|host|server|client|from",
          "card": r"card|visa|mastercard|amex|credit|debit|payment|karte|carte|tarjeta",
          "phone": r"phone|tel|telephone|call|fax|mobile|cell|telefon|tél|teléfono|whatsapp|sms"}
_NAMED = {k: re.compile(rf"\b(?:{v})\b[^\n]{{0,24}}$", re.I) for k, v in _NAMED.items()}
_OTHER = re.compile(r"(?:\b(?:version|v|section|chapter|isbn|issn|order|invoice|ref|serial|sku|id|uuid|token|hash|key"
                    r"|password|license|commit)\b[ :=#.\"'-]{0,4}|[#$€£=])$", re.I)
_DOMAINS = frozenset("com org net edu gov mil int info biz io ai dev app uk de fr es it nl eu ch at be pt pl se no dk "
                     "fi ie us ca mx br ar cl co au nz jp kr cn in ru ua tr za".split())
_ISSUER = re.compile(r"4|5[1-5]|22(?:2[1-9]|[3-9])|2[3-6]|27(?:[01]|20)|3[47]|6011|65")
#: Calling codes of one and two digits; the rest have three.
_CALLING = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 "
                     "65 66 81 82 84 86 90 91 92 93 94 95 98".split())


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the mail pattern, found from each @ so that no run of letters is tried twice."""
    at, floor = text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            floor = m.end()
        else:
            floor = at + 1
        at = text.find("@", floor)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the strict patterns, by kind as listed, then by start; code points."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if _octets(m[0])]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


class _Taken:
    """Spans taken so far, by start, with the furthest end up to each: a touch is found by one search."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.spans = sorted(spans)
        self.starts = [a for a, _ in self.spans]
        self.reach = list(itertools.accumulate((b for _, b in self.spans), max))

    def touches(self, a: int, b: int) -> bool:
        i = bisect.bisect_left(self.starts, b)
        return i > 0 and self.reach[i - 1] > a


def _proposed(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans of the looser patterns that touch neither a base span nor each other."""
    used = _Taken([(a, b) for _, a, b in taken])
    out = []
    has_digit = bool(_DIGIT.search(text))
    for kind in KINDS:
        if kind == "email" and not ("@" in text or "at" in text and re.search(r"[(\[{]at[)\]}]", text, re.I)):
            continue
        if kind != "email" and not has_digit:
            continue
        for pattern in _MORE[kind]:  # matches of one pattern do not touch each other
            new = [m.span() for m in pattern.finditer(text) if not used.touches(*m.span())]
            if new:
                out += [(kind, a, b) for a, b in new]
                used = _Taken(used.spans + new)
    return out


def _strict_vote(kind: str, span: str) -> str:
    """The strict pattern on the span alone: yes, matched but failed its check, or not of its form."""
    digits = _digits(span)
    if kind == "email":
        return YES if list(_emails(span)) == [(0, len(span))] else ABSTAIN
    pattern, passed = {"ip": (_IP, lambda: _octets(span)),
                       "card": (_CARD, lambda: 16 <= len(digits) <= 19 and luhn(digits)),
                       "phone": (_PHONE, lambda: 8 <= len(digits) <= 15)}[kind]
    return ABSTAIN if not pattern.fullmatch(span) else YES if passed() else NO


def _votes(text: str, kind: str, a: int, b: int) -> str:
    span, before = text[a:b], text[max(0, a - 40):a]
    digits = _digits(span)
    if kind == "email":
        tld = re.split(r"[.)\]} ]", span.lower())[-1]
        structure = YES if tld.isalpha() and 2 <= len(tld) <= 24 else NO
        known = YES if tld in _DOMAINS else ABSTAIN
    elif kind == "ip":
        parts = span.split(".") if "." in span else []
        structure = NO if len(parts) == 4 and all(len(p) == 1 for p in parts) else YES
        known = NO if parts and parts[0] in ("0", "127", "255") else ABSTAIN
    elif kind == "card":
        structure = YES if luhn(digits) else NO
        known = ABSTAIN if _ISSUER.match(digits) else NO  # one number in three has an issuer's prefix by chance
    else:
        structure = YES if 10 <= len(digits) <= 15 else ABSTAIN if len(digits) >= 8 else NO
        code = any(digits[:n] in _CALLING for n in (1, 2))
        known = (YES if code else ABSTAIN) if span[0] == "+" else ABSTAIN
    named = YES if _NAMED[kind].search(before) else ABSTAIN
    other = NO if _OTHER.search(before) else ABSTAIN
    ends = (text[a - 1] if a else " ") + (text[b] if b < len(text) else " ")
    around = NO if any(c.isalnum() for c in ends) else ABSTAIN
    return _strict_vote(kind, span) + structure + known + named + other + around


def _shape(text: str, a: int, b: int) -> int:
    """A number below 8: has separators, is long, has a sign."""
    span = text[a:b]
    return (any(c in " -()" for c in span)) + 2 * (b - a > 16) + 4 * ("+" in span or "@" in span)


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, str, bool]]:
    """(kind, start, end, pattern, strict) of base and proposed spans; pattern = votes and shape."""
    spans = [(s, True) for s in base] + [(s, False) for s in _proposed(text, base)]
    return [(k, a, b, f"{_votes(text, k, a, b)}{_shape(text, a, b)}", strict) for (k, a, b), strict in spans]


_CAND = pa.list_(pa.struct([("k", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
                            ("pattern", pa.string()), ("strict", pa.bool_())]))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at = {k: i for i, k in enumerate(KINDS)}
    for batch in batches:
        counts, hashes, found = [[] for _ in KINDS], [], []
        for value in batch.column(1):
            text = value.as_py() or ""
            base = base_spans(text)
            for i, kind in enumerate(KINDS):
                counts[i].append(sum(k == kind for k, _, _ in base))
            line = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
            hashes.append(hashlib.sha256(line.encode()).hexdigest())
            found.append([(at[k], a, b, p, s) for k, a, b, p, s in candidates(text, base)])
        fields = ("k", "start", "end", "pattern", "strict")
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(hashes, pa.string()),
             pa.array([[dict(zip(fields, c)) for c in row] for row in found], _CAND)],
            names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "cands"])


class SpanClassifier:
    """Logistic regression on kind, votes and shape, fitted to the posteriors of a pattern table."""

    def __init__(self, patterns: list[tuple[int, str, int]], rounds: int = 400, decay: float = 1e-3):
        voters = 6
        table: dict[tuple, int] = {}
        for k, p, n in patterns:
            table[k, p[:voters]] = table.get((k, p[:voters]), 0) + n
        self.reliability = weak_labels.fit([(k, v, n) for (k, v), n in table.items()], voters, prior=0.5, learn_prior=False)
        self.weights = np.zeros(len(self._features(0, "------0")))
        if not patterns:
            return
        x = np.array([self._features(k, p) for k, p, _ in patterns])
        y = np.array([self.reliability.posterior(k, p[:voters]) for k, p, _ in patterns])
        w = np.array([n for _, _, n in patterns], float)
        w = w / w.sum()
        for _ in range(rounds):  # damped Newton steps
            p = 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))
            slope = x.T @ (w * (p - y)) + decay * self.weights
            curve = (x * (w * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + decay * np.eye(x.shape[1])
            step = np.linalg.solve(curve, slope)
            self.weights -= step / max(1.0, np.abs(step).max())
            if np.abs(step).max() < 1e-8:
                break

    @staticmethod
    def _features(kind: int, pattern: str) -> np.ndarray:
        votes = [float(c == v) for c in pattern[:-1] for v in (YES, NO)]
        shape = int(pattern[-1])
        return np.array([1.0, *[float(kind == i) for i in range(len(KINDS))], *votes, shape & 1, shape >> 1 & 1, shape >> 2])

    def probability(self, kind: int, pattern: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self._features(kind, pattern) @ self.weights, -30, 30))))


def find(docs: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256`` and ``found``: array of
    (k: number of the kind, start, end), base and added spans in order."""
    kind = docs.schema[id_col].dataType
    schema = (f"doc_id {kind.simpleString()}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
              "base_sha256 string, cands array<struct<k:int,start:bigint,end:bigint,pattern:string,strict:boolean>>")
    rows = stash(docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text")).mapInArrow(_find, schema),
                 "candidates")
    table = (rows.select(F.explode("cands").alias("c")).groupBy("c.k", "c.pattern").agg(F.count("*").alias("n")))
    patterns = [(r["k"], r["pattern"], r["n"]) for r in table.collect()]  # 23,328 rows at most
    model = SpanClassifier(sorted(patterns))
    good = [f"{k}{p}" for k, p, _ in patterns if model.probability(k, p) >= threshold]
    accepted = F.array(*map(F.lit, good)) if good else F.array().cast("array<string>")
    keep = F.filter("cands", lambda c: c.strict | F.array_contains(
        accepted, F.concat(c.k.cast("string"), c.pattern)))
    spans = F.array_sort(F.transform(keep, lambda c: F.struct(c.k.alias("k"), c.start.alias("start"), c.end.alias("end"))))
    return rows.select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", spans.alias("found"))


def as_text(found) -> "F.Column":
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda c: F.concat_ws(
        ":", F.element_at(names, c.k + 1), c.start.cast("string"), c.end.cast("string"))), ",")
