"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust the score.

Confirmed spans start at the score of their kind; a context word nearby raises it, a word that speaks
for something else lowers it. Proposals of the base kinds are kept whatever their score; the added
kinds (iban; secret: keys and tokens of known form or after a word such as password; national: a telephone
number without a country code) need the threshold.
"""

from __future__ import annotations

import hashlib
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "secret", "national")
THRESHOLD = 0.6
#: Characters before and after a span in which context words count.
NEARBY = 40
START = {"email": 0.95, "ip": 0.7, "card": 0.8, "phone": 0.8, "iban": 0.9, "secret": 0.5, "national": 0.35}
WORDS = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "server", "host"),
    "card": ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "secret": ("key", "api_key", "apikey", "token", "secret", "password", "passwd", "pwd", "bearer", "authorization", "credentials", "aws_secret_access_key"),
    "national": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
}
AGAINST = ("isbn", "version", "order", "invoice", "serial")
RAISE, LOWER = 0.3, 0.3

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
#: Characters of an IBAN by country (ISO 13616); for other countries every length is tried.
_IBAN_SIZES = {
    country: size
    for size, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
#: Forms of keys that services issue, and what follows a word such as password with = or a colon.
_KEYS = re.compile(r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,255}|sk_(?:live|test)_[A-Za-z0-9]{16,99}|xox[abprs]-[A-Za-z0-9-]{10,99}|eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,})(?![A-Za-z0-9])")
_ASSIGNED = re.compile(r"(?i)(?<![a-z0-9])(?:password|passwd|pwd|secret|api[_-]?key|access[_-]?key|auth[_-]?token|token)[\"']?\s{0,3}[:=]\s{0,3}[\"']?([A-Za-z0-9+/_.~!@#$%^&*=-]{8,200})")
_NATIONAL = re.compile(r"(?<![0-9+(.-])(?<!\+[0-9] )\(?[0-9]{2,4}\)?(?:[ .-][0-9]{2,4}){2,4}(?![0-9.-])")
_NOT_DIGIT = re.compile(r"[^0-9]")
_WORD = re.compile(r"\w+")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 13616: the first four characters go to the end, letters count from 10; the rest by 97 is 1."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str):
    """Leftmost matches, each from the '@' back over the local part, so that long runs cost one pass."""
    after, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            after = m.end()
        at = text.find("@", max(at + 1, after))


def _ibans(text: str):
    """Leftmost matches; of each the longest part that ends with a token, has its country's length and passes mod-97."""
    at = 0
    while m := _IBAN.search(text, at):
        start, at = m.start(), m.start() + 1
        for end in range(m.end(), start + 14, -1):
            if text[end - 1] == " " or text[end : end + 1].isascii() and text[end : end + 1].isalnum():
                continue
            plain = text[start:end].replace(" ", "")
            if 15 <= len(plain) == _IBAN_SIZES.get(plain[:2], len(plain)) and mod97(plain):
                yield start, end
                at = end
                break


def _secrets(text: str):
    """Keys of known form, and assigned values that have a digit and a letter."""
    found = [m.span() for m in _KEYS.finditer(text)]
    if "=" in text or ":" in text:
        found += [m.span(1) for m in _ASSIGNED.finditer(text) if re.search("[0-9]", m[1]) and re.search("[A-Za-z]", m[1])]
    return sorted(set(found))


def _proposed(text: str):
    if "@" in text:
        for a, b in _emails(text):
            yield "email", a, b
    if not re.search("[0-9]", text):
        return
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield "ip", *m.span()
    for m in _CARD.finditer(text):
        if 13 <= len(m[0]) and 13 <= len(digits := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
            yield "card", *m.span()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                yield "phone", *m.span()
    for a, b in _ibans(text):
        yield "iban", a, b
    for a, b in _secrets(text):
        yield "secret", a, b
    for m in _NATIONAL.finditer(text):
        if 7 <= len(_NOT_DIGIT.sub("", m[0])) <= 12:
            yield "national", *m.span()


def find(text: str | None) -> list[Span]:
    """All spans by kind (email, ip, card, phone, iban, secret, national), then start; offsets are code points."""
    out: list[Span] = []
    taken: list[tuple[int, int]] = []
    for kind, a, b in _proposed(text or ""):
        score = START[kind] + (RAISE if kind == "secret" and _KEYS.fullmatch(text, a, b) else 0)
        near = {w.lower() for w in _WORD.findall(text[max(0, a - NEARBY) : a] + " " + text[b : b + NEARBY])}
        score += RAISE * any(w in near for w in WORDS[kind]) - LOWER * any(w in near for w in AGAINST)
        if kind not in BASE_KINDS and (score < THRESHOLD or any(x < b and a < y for x, y in taken)):
            continue
        taken.append((a, b))
        out.append(Span(kind, a, b, min(1.0, max(0.0, score))))
    return out


def redact(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span, overlapping ones together, replaced by its kind in brackets."""
    if not spans:
        return text
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if s.end <= at:
            continue
        if s.start >= at:
            out += [text[at : s.start], f"[{s.kind.upper()}]"]
        at = s.end
    return "".join([*out, text[at:]])


def _listed(spans) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def detect(docs: DataFrame) -> DataFrame:
    """Adds pii (array of kind, start, end, score), redacted, and n_email, n_ip, n_card, n_phone.

    Null texts have no spans and stay null in redacted; empty texts have none. Rows are independent of
    each other; null ids and repeated rows pass. Of spans that overlap, base kinds all stay, and an added one
    gives way to any before it. Very long texts are searched whole. Columns with an output's name are replaced.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(rows):
        texts = common.field(rows, "text").to_pylist()
        found = [find(t) for t in texts]
        counts = [pa.array([sum(s.kind == k for s in own) for own in found], pa.int64()) for k in BASE_KINDS]
        return [pa.array([[s._asdict() for s in own] for own in found], kind), pa.array([redact(t, s) for t, s in zip(texts, found, strict=True)], pa.string()), *counts]

    outputs = {"pii": "array<struct<kind:string,start:int,end:int,score:double>>", "redacted": "string"} | {f"n_{k}": "bigint" for k in BASE_KINDS}
    return common.attach(docs, run, outputs)


def digests(docs: DataFrame) -> DataFrame:
    """The counts, base_sha256 and spans of detect, made in the worker."""

    def run(rows):
        found = [find(t) for t in common.field(rows, "text").to_pylist()]
        base = [[s for s in own if s.kind in BASE_KINDS] for own in found]
        counts = [pa.array([sum(s.kind == k for s in own) for own in base], pa.int64()) for k in BASE_KINDS]
        return [*counts, pa.array([hashlib.sha256(_listed(own).encode()).hexdigest() for own in base], pa.string()), pa.array(map(_listed, found), pa.string())]

    return common.attach(docs, run, {f"n_{k}": "bigint" for k in BASE_KINDS} | {"base_sha256": "string", "spans": "string"})


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(common.table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
