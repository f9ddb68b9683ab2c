"""Personal data: patterns propose spans, checksums confirm them, context words adjust a score.

Spans are code points, end exclusive. Four base kinds are reported whenever
their pattern and check hold; further kinds are reported from ``MIN_SCORE`` on.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
MIN_SCORE = 0.6
CONTEXT_CHARS = 48

_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[^A-Za-z0-9._%+-]")
# A match never ends before its digits do, so a later one starts where a run of digits starts.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """International bank account numbers leave 1 when the moved letters are read as numbers."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, at sign and dotted domain, in linear time.

    The local part cannot hold an at sign, so it is the run of its characters
    before one, cut at the end of the match before.
    """
    done = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > done and not _LOCAL_END.match(text, start - 1):
            start -= 1
        if start < m.start():
            yield start, m.end()
            done = m.end()


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _ip_ok(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def _card_ok(s: str) -> bool:
    d = _digits(s)
    return 12 <= len(d) <= 19 and luhn(d)


def _phone_ok(s: str) -> bool:
    return 9 <= len(_digits(s)) <= 15


def _iban_ok(s: str) -> bool:
    plain = s.replace(" ", "")
    return 15 <= len(plain) <= 34 and mod97(plain)


def _ssn_ok(s: str) -> bool:
    area, group, serial = s.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


@dataclass(frozen=True)
class Proposal:
    """A further kind: what proposes it, what confirms it, how sure that is without context."""

    kind: str
    pattern: re.Pattern[str]
    confirmed: Callable[[str], bool]
    score: float
    context: re.Pattern[str]


FURTHER = (
    Proposal(
        "iban",
        re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"),
        _iban_ok,
        0.8,
        re.compile(r"\b(?:iban|bank|account|konto|compte|cuenta)\b", re.I),
    ),
    Proposal(
        "ssn",
        re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
        _ssn_ok,
        0.4,
        re.compile(r"\b(?:ssn|social|security|insurance|tax)\b", re.I),
    ),
)
BASE_CONTEXT = {
    "email": re.compile(r"\b(?:mail|e-mail|email|contact|write)\b", re.I),
    "ip": re.compile(r"\b(?:ip|host|server|address|login)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|mastercard|credit|karte|carte|tarjeta)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|call|mobile|fax|telefon)\b", re.I),
}
BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6}
CONTEXT_BONUS = 0.3


def _near(text: str, start: int, end: int, words: re.Pattern[str]) -> bool:
    around = text[max(0, start - CONTEXT_CHARS) : start] + "\n" + text[end : end + CONTEXT_CHARS]
    return words.search(around) is not None


def _matches(pattern: re.Pattern[str], ok: Callable[[str], bool], text: str) -> list[tuple[int, int]]:
    return [m.span() for m in pattern.finditer(text) if ok(m.group())]


def find_spans(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score), by start and then kind; base kinds whatever their score."""
    base = {
        "email": list(_emails(text)) if "@" in text else [],
        "ip": _matches(_IP, _ip_ok, text),
        "card": _matches(_CARD, _card_ok, text),
        "phone": _matches(_PHONE, _phone_ok, text) if "+" in text else [],
    }
    out = []
    for kind, spans in base.items():
        for start, end in spans:
            bonus = CONTEXT_BONUS * _near(text, start, end, BASE_CONTEXT[kind])
            out.append((start, end, kind, min(1.0, BASE_SCORE[kind] + bonus)))
    for p in FURTHER:
        for start, end in _matches(p.pattern, p.confirmed, text):
            score = min(1.0, p.score + CONTEXT_BONUS * _near(text, start, end, p.context))
            if score >= MIN_SCORE:
                out.append((start, end, p.kind, score))
    order = {k: n for n, k in enumerate((*BASE_KINDS, *(p.kind for p in FURTHER)))}
    return sorted(out, key=lambda s: (s[0], order[s[2]]))


def redact(text: str, spans: list[tuple[int, int, str, float]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    parts, at = [], 0
    for start, end, kind, _ in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


FOUND = (
    "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, max_score double, redacted string"
)


def _listed(spans: list[tuple[int, int, str, float]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind, _ in spans)


def with_pii(docs: DataFrame) -> DataFrame:
    """The documents' columns and one struct ``_pii`` of FOUND; a null text is empty.

    Every row is judged by itself: repeated rows give repeated results, other
    columns pass through untouched (a column named ``_pii`` is replaced), an
    empty table gives no rows. Work is linear in the text, so long texts only
    take longer.
    """

    @F.pandas_udf(FOUND)
    def found(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            spans = find_spans(text)
            base = [s for s in spans if s[2] in BASE_KINDS]
            counts = [sum(s[2] == k for s in base) for k in BASE_KINDS]
            digest = hashlib.sha256(_listed(base).encode()).hexdigest()
            best = max((s[3] for s in spans), default=0.0)
            rows.append((*counts, digest, _listed(spans), best, redact(text, spans) if spans else text))
        names = [f.split()[0] for f in FOUND.split(", ")]
        return pd.DataFrame(rows, columns=names)

    return docs.withColumn("_pii", found(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def pii(docs: DataFrame) -> DataFrame:
    """doc_id and the findings, without the redacted text."""
    found = with_pii(docs.select("doc_id", "text"))
    return found.select("doc_id", "_pii.*").drop("redacted")


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced in text; rows and columns stay, whatever their names.

    A null text stays null. Repeated rows stay repeated, an empty table empty.
    """
    named = docs.withColumnRenamed("_pii", "_pii_of_input")
    found = with_pii(named)
    text = F.when(F.col("text").isNotNull(), F.col("_pii.redacted")).alias("text")
    kept = found.select(*[text if c == "text" else F.col(f"`{c}`") for c in named.columns])
    return kept.withColumnRenamed("_pii_of_input", "_pii")
