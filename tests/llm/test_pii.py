"""Anchor expansion against the base patterns applied as they are written."""

import hashlib
import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shopgrain.llm.pii import BASE, account_holds, find_spans, luhn, pii_spans, redact, redacted

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), m.end(), kind))
    return sorted(found, key=lambda s: (s[0], BASE.index(s[2])))


def base(text):
    return [tuple(s) for s in find_spans(text) if s.kind in BASE]


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="ab.@-+ 0123456789()%é٣", max_size=60))
def test_base_kinds_equal_their_patterns(text):
    assert base(text) == plain(text)


def test_base_kinds_equal_their_patterns_in_composed_texts():
    rng = random.Random(3)
    parts = [
        "a.b@c.d", "x@y@z.w", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111",
        "4111-1111-1111-1111", "0", "79927398713", "+1 (297) 555-8151", "+12", "+1 2", "@", ".",
        " ", "-", "+", "é", "000000000000", "+49 30 123456 7890 1234",
    ]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 9)))
        assert base(text) == plain(text)


def test_added_kinds():
    text = "see ftp://bob:pw@host.org/x, Account number: DE89370400440532013000 at 12 Elm Street."
    kinds = {s.kind: text[s.start : s.end] for s in find_spans(text)}
    assert kinds["login"] == "bob:pw"
    assert kinds["account"] == "DE89370400440532013000"
    assert kinds["street"] == "12 Elm Street"
    assert not account_holds("DE88370400440532013000")
    assert not find_spans("accounting is fun in any Street")


def test_added_kinds_have_no_caps():
    """Spans beyond any fixed length, found from their anchor to their end."""
    name, password = "u" * 700, "p%20" * 500
    number = "7" * 90 + " " + "12 " * 20 + "345"
    street = "1234567 " + " ".join(["A" + "b" * 300] * 3) + " Street"
    text = f"at http://{name}:{password}@host/ the account: {number}, or {street}; then on"
    kinds = {s.kind: text[s.start : s.end] for s in find_spans(text)}
    assert kinds["login"] == f"{name}:{password}"
    assert kinds["account"] == number
    assert kinds["street"] == street


def test_accounts_end_with_their_last_group():
    found = lambda text: [text[s.start : s.end] for s in find_spans(text) if s.kind == "account"]
    assert found("IBAN GB29 NWBK 6016 1331 9268 19 WAS PAID") == ["GB29 NWBK 6016 1331 9268 19"]
    assert found("passport: X1234567 AND MORE TEXT") == ["X1234567"]
    assert found("account 12345abc") == [] and found("account 1 of 2") == []


def test_streets_need_a_number_and_up_to_three_names():
    found = lambda text: [text[s.start : s.end] for s in find_spans(text) if s.kind == "street"]
    assert found("(12 Old Mill Elm Street)") == ["12 Old Mill Elm Street"]
    assert found("12 A Very Old Elm Street") == [] and found("12 old Elm Street") == []
    assert found("No.7 Elm Street, a7 Elm Street") == ["7 Elm Street"]
    assert found("7 Elm Street 8 Oak Road") == ["7 Elm Street", "8 Oak Road"]


def test_redacted_merges_overlaps():
    text = "mail +1 (297) 555-8151 a@b.c or 4111111111111111"
    assert redacted(text, find_spans(text)) == "mail [PHONE] [EMAIL] or [CARD]"


def test_edge_rows(spark):
    """Null, empty and very long texts, repeated rows, clashing names, an empty table."""
    long = "a@b.c " * 30000 + "x" * 100000 + "@y.z"
    rows = [(1, None, 0), (2, "", 1), (3, long, 2), (3, long, 2), (None, "a@b.c", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    out = {(r.doc_id, r.n_email): r for r in pii_spans(df, "text", ["doc_id"]).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert out[1, 0].base_sha256 == out[2, 0].base_sha256 == empty
    assert out[1, 0].spans == ""
    assert (3, 30001) in out and (None, 1) in out
    assert pii_spans(df, "text", ["doc_id"]).count() == 5
    assert pii_spans(df.limit(0), "text", ["doc_id"]).count() == 0
    texts = {r.doc_id: r.redacted for r in redact(df, "text", ["doc_id", "spans"]).collect()}
    assert texts[1] is None and texts[2] == "" and texts[None] == "[EMAIL]"


@pytest.mark.parametrize(
    "text",
    ["://a" * 50_000, "account 1a" * 30_000, "ACCOUNT1" * 30_000, "Ab Street " * 30_000]
    + ["x" * 300_000 + " Street" * 30_000, "A" * 300_000 + " Street 1 " + "Bc" * 100_000],
)
def test_added_kinds_take_linear_time(text):
    start = time.process_time()
    find_spans(text)
    assert time.process_time() - start < 5


@pytest.mark.parametrize("text", ["1" * 5000, "+1" * 5000, "1.1" * 5000, "@a." * 5000])
def test_long_runs_take_linear_time(text):
    assert base(text) == plain(text)
