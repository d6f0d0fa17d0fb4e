"""Spans against the plain patterns, run as they are."""

import hashlib
import re

from hypothesis import example, given, settings
from hypothesis import strategies as st

from presslake.llm.pii import BASE, digest, find_pii, luhn, mod_97, scored_spans


def plain(text):
    """The base by its definition."""
    def card(s):
        d = re.sub("[ -]", "", s)
        return 12 <= len(d) <= 19 and sum(int(x) if i % 2 == 0 else sum(divmod(2 * int(x), 10)) for i, x in enumerate(d[::-1])) % 10 == 0
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", card),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(re.sub("[^0-9]", "", s)) <= 15),
    }
    found = [(k, *m.span()) for k, (p, ok) in rules.items() for m in re.finditer(p, text) if ok(m.group())]
    return sorted(found, key=lambda x: (x[1], BASE.index(x[0])))


@settings(max_examples=500, deadline=None)
@given(st.text("ab1290.@-+ ()%é\U0001f600", max_size=80))
@example("a@b.c@d.e x@@y.z a@b..c 1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 +1 (988) 555-2485 4524132264652876 +(1) +123")
@example("4539 1488 0343 6467 and 4539-1488-0343-6467-1 +49 30 1234567. +1((((((((( a.b@c.d.e-")
def test_base_is_that_of_the_plain_patterns(text):
    assert [s[:3] for s in scored_spans(text) if s[0] in BASE] == plain(text)


def test_added_spans_need_checks_or_context():
    text = "my iban DE89 3704 0044 0532 0130 00 THE REST; DE89 3704 0044 0532 0130 01. call 555-123-4567, or 555-123-4568"
    assert [text[s:e] for k, s, e, _ in scored_spans(text) if k == "iban"] == ["DE89 3704 0044 0532 0130 00"]
    assert [k for k, *_ in scored_spans("so 555-123-4567 it is")] == []
    assert [k for k, *_ in scored_spans("phone 555-123-4567 it is")] == ["local_phone"]
    assert [k for k, *_ in scored_spans("SSN: 078-05-1120")] == ["national_id"]
    assert luhn("4539148803436467") and not luhn("4539148803436468") and mod_97("GB82WEST12345698765432")


def test_context_moves_the_score():
    (_, _, _, alone), (_, _, _, near) = scored_spans("see 10.1.2.3 ok")[0], scored_spans("server 10.1.2.3 ok")[0]
    assert near > alone


def test_long_hostile_texts_are_linear():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" + "(" * 300_000, "@a" * 150_000, "a@" + "b" * 300_000):
        scored_spans(text)


def test_rows(spark):
    texts = [(1, "x é\U0001f600 a@b.cd 1.2.3.4"), (2, None), (3, ""), (1, "x é\U0001f600 a@b.cd 1.2.3.4"), (None, "+1 (988) 555-2485")]
    docs = spark.createDataFrame([(*t, "e", 5) for t in texts], "doc_id long, text string, spans string, n_ip int")
    rows = sorted(digest(find_pii(docs)).collect(), key=repr)
    assert len(rows) == 5 and digest(find_pii(docs.limit(0))).count() == 0
    one = [r for r in rows if r.doc_id == 1]
    assert one[0] == one[1] and one[0].spans == "email:5:11,ip:12:19"
    assert one[0].base_sha256 == hashlib.sha256(b"email:5:11,ip:12:19").hexdigest() and (one[0].n_email, one[0].n_ip) == (1, 1)
    assert {r.spans for r in rows if r.doc_id in (2, 3)} == {""}
