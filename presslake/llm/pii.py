"""Personal data: patterns propose spans, checksums confirm them, context words move their score.

All scans are linear in the text. Positions count code points; ends are exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import table, whole_text
from presslake.llm.registry import query

#: Kinds of the base, then those that the method adds; spans of equal start stand in this order.
BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "iban", "local_phone", "national_id"]

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A number that a match starts within would have started it, so only whole numbers are tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_LOCAL_PHONE = re.compile(r"(?<![\w+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-])")
_NATIONAL_ID = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")

_CONTEXT = {
    "email": {"mail", "email", "contact"}, "ip": {"ip", "address", "host", "server"},
    "card": {"card", "visa", "mastercard", "credit", "debit"}, "phone": {"phone", "tel", "call", "mobile", "fax"},
    "iban": {"iban", "bank", "account", "konto"}, "local_phone": {"phone", "tel", "call", "mobile", "fax"},
    "national_id": {"ssn", "social", "security"},
}
_WORD = re.compile(r"[^\W\d_]+")
#: Score of a proposal, what a passed checksum or form check adds, what a context word nearby adds, and the least
#: score of a span. Base spans are over it without context, the weak forms only with it.
PROPOSED = {kind: 0.5 for kind in BASE} | {"iban": 0.3, "local_phone": 0.2, "national_id": 0.2}
CONFIRMED, NEARBY, LEAST = 0.4, 0.35, 0.5
CONTEXT_CHARS = 40


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod_97(account: str) -> bool:
    """The check of international account numbers."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` with the run of name characters before it and a domain after it; starts left of any used text."""
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = at - (len(before) - len(before.rstrip(_LOCAL)))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        free = found.end() if found else at + 1
        at = text.find("@", free)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if 12 <= m.end() - m.start() <= 37:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """The longest part that ends with a group and passes; capital words may follow the number."""
    for m in _IBAN.finditer(text):
        ends = [m.end(), *(m.start() + i for i in range(m.end() - m.start() - 1, 14, -1) if text[m.start() + i] == " ")]
        for end in ends:
            account = text[m.start():end].replace(" ", "")
            if 15 <= len(account) <= 34 and mod_97(account):
                yield m.start(), end
                break


def _matches(pattern: re.Pattern):
    return lambda text: (m.span() for m in pattern.finditer(text))


# What proposes a kind, with its check where it has one; whether that check confirms by more than form.
_FINDERS = {
    "email": (_emails, False), "ip": (_ips, False), "card": (_cards, True), "phone": (_phones, False),
    "iban": (_ibans, True), "local_phone": (_matches(_LOCAL_PHONE), False), "national_id": (_matches(_NATIONAL_ID), False),
}


def scored_spans(text: str) -> list[tuple[str, int, int, float]]:
    """``(kind, start, end, score)`` by start, then kind. Added kinds give way to spans of the base they overlap."""
    found: list[tuple[str, int, int, float]] = []
    has_digit = any(c in text for c in "0123456789")
    for kind, (finder, confirms) in _FINDERS.items():
        if kind != "email" and not has_digit:
            continue
        taken = [(s, e) for _, s, e, _ in found] if kind not in BASE else []
        for start, end in finder(text):
            score = PROPOSED[kind] + (CONFIRMED if confirms else 0.0)
            nearby = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]
            if _CONTEXT[kind] & {w.lower() for w in _WORD.findall(nearby)}:
                score = min(1.0, score + NEARBY)
            if score >= LEAST and not any(s < end and start < e for s, e in taken):
                found.append((kind, start, end, round(score, 2)))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def find_pii(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id`` and ``spans``, an array of ``(kind, start, end, score)``.

    Null and empty texts have no spans; repeated rows are treated each alike; an empty table gives no rows. Other
    columns of the input aren't read.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [{"kind": k, "start": s, "end": e, "score": c} for k, s, e, c in scored_spans(t.as_py())] for t in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(span))], names=["doc_id", "spans"])

    kind = docs.schema[key].dataType.simpleString()
    shape = f"doc_id {kind}, spans array<struct<kind: string, start: bigint, end: bigint, score: double>>"
    return docs.select(F.col(key).alias("key"), whole_text(text).alias("text")).mapInArrow(scan, shape)


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, the base's checksum and all spans as text."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(BASE))
    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))


@query("op3_pii")
def op3_pii(spark, sf_dir):
    return digest(find_pii(table(spark, sf_dir, "documents")))
