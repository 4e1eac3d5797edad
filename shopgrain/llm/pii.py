"""Personal data by anchor expansion.

One Aho-Corasick automaton finds the anchors of a text in a single pass: at-signs,
plus signs, digits, scheme marks and words that announce an identifier. At each
anchor a local parser for its kind expands to the boundaries and validates what it
read. Parsers never look further than the run of characters that their kind allows,
so a text is read in linear time whatever its length.

Kinds: ``email``, ``ip``, ``card`` and ``phone`` follow fixed patterns (leftmost,
non-overlapping within a kind, failing matches dropped). On top of them come
``login`` (user information in a URL), ``account`` (an identifier behind a word that
announces one) and ``street`` (a house number with a street name).
"""

from __future__ import annotations

import functools
import hashlib
import re
from typing import NamedTuple

import ahocorasick
from pyspark.sql import DataFrame

from .arrow import map_rows

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "account", "street")
ORDER = {kind: i for i, kind in enumerate(KINDS)}

#: The patterns of the base kinds, cut at their anchors.
LOCAL_PART = frozenset(
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
)
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Words that announce an identifier, as written in lower case.
CUES = (
    "account number", "account no", "account", "acct", "iban", "passport",
    "social security", "ssn", "tax id", "customer id", "member id", "license no",
)
#: Words that end a street name.
STREETS = ("Street", "Road", "Avenue", "Lane", "Boulevard", "Drive", "Square")

LOGIN = re.compile(r"[A-Za-z0-9._~%!$&'()*+,;=-]+(?::[^\s/@]*)?@(?=[A-Za-z0-9\[])")
#: Up to four letters, then groups with a digit in each; four letters may stand between.
ACCOUNT = re.compile(
    r"(?:\s{0,2}[:#=.]|\s{1,2}is)?\s{0,2}([A-Z]{0,4}[0-9][A-Z0-9]*"
    r"(?:[ -](?:[A-Z]*[0-9][A-Z0-9]*|[A-Z]{4}(?=[ -][A-Z]*[0-9])))*)(?![A-Za-z0-9])"
)
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{10,30}\Z")
NAME = re.compile(r"[A-Z][A-Za-z]+")
DIGITS = re.compile(r"[0-9]+\Z")
#: Words of a street's name before the one that ends it.
NAMES = 3


class Span(NamedTuple):
    start: int
    end: int
    kind: str


@functools.cache
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize(), cue.title()}:
            found.add_word(form, ("cue", len(form)))
    for street in STREETS:
        found.add_word(f" {street}", ("street", len(street) + 1))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def iban_holds(text: str) -> bool:
    turned = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def account_holds(text: str) -> bool:
    """At least five digits; what is written like an IBAN must have its check digits."""
    plain = text.replace(" ", "").replace("-", "")
    return len(digits_of(plain)) >= 5 and (not IBAN.match(plain) or iban_holds(plain))


def find_spans(text: str) -> list[Span]:
    """All spans of a text by start, then kind; positions in code points, end exclusive."""
    spans: list[Span] = []
    done = dict.fromkeys(KINDS, 0)  # where each kind's last match ended

    def add(kind: str, start: int, end: int, holds: bool = True) -> None:
        done[kind] = end
        if holds:
            spans.append(Span(start, end, kind))

    for last, (anchor, length) in automaton().iter(text):
        at = last + 1 - length
        if anchor == "digit":
            if at >= done["ip"] and (at == done["ip"] or not is_digit(text, at - 1)):
                if m := IP.match(text, at):
                    add("ip", at, m.end(), all(map(octet, m[0].split("."))))
            if at >= done["card"] and (m := CARD.match(text, at)):
                digits = digits_of(m[0])
                add("card", at, m.end(), 12 <= len(digits) <= 19 and luhn(digits))
        elif anchor == "at":
            start = at
            while start > done["email"] and text[start - 1] in LOCAL_PART:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                add("email", start, m.end())
        elif anchor == "plus":
            if at >= done["phone"] and (m := PHONE.match(text, at)):
                add("phone", at, m.end(), 9 <= len(digits_of(m[0])) <= 15)
        elif anchor == "scheme":
            if m := LOGIN.match(text, last + 1):
                add("login", last + 1, m.end() - 1)
        elif anchor == "cue":
            # What lies inside a word or the span before is not read again.
            if last + 1 < done["account"] or inside_word(text, at):
                continue
            if m := ACCOUNT.match(text, last + 1):
                add("account", m.start(1), m.end(1), account_holds(m[1]))
        elif not text[last + 1 : last + 2].isalpha():
            begin = house_before(text, done["street"], at)
            if begin is not None:
                add("street", begin, last + 1)
    spans.sort(key=lambda s: (s.start, ORDER[s.kind], s.end))
    return spans


def is_digit(text: str, at: int) -> bool:
    return at >= 0 and "0" <= text[at] <= "9"


def inside_word(text: str, at: int) -> bool:
    return at > 0 and text[at - 1].isalnum()


def house_before(text: str, begin: int, end: int) -> int | None:
    """Where the house number and the name that end at ``end`` start, from ``begin`` on.

    Goes back word by word, as long as words are parts of a name.
    """
    for n in range(NAMES + 1):
        space = text.rfind(" ", begin, end)
        word = text[space + 1 : end] if space >= 0 else text[begin:end]
        if n and word.isascii() and word.isdigit():
            start = end - len(word)
            return start if not inside_word(text, start) else None
        if n and (tail := DIGITS.search(word)) and not inside_word(text, end - len(tail[0])):
            return end - len(tail[0])
        if space < 0 or not NAME.fullmatch(word):
            return None
        end = space
    return None


def written(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with a mark like ``[EMAIL]`` for each span; overlapping ones get one mark."""
    out, end = [], 0
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if s.start >= end:
            out += [text[end : s.start], f"[{s.kind.upper()}]"]
        end = max(end, s.end)
    return "".join([*out, text[end:]])


def pii_spans(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` with counts, a digest and the spans of ``text``, a row per row.

    Adds ``n_email, n_ip, n_card, n_phone`` (long), ``base_sha256`` (of the base
    kinds' spans) and ``spans`` (all spans as kind:start:end, comma-joined). A null
    text counts as empty: no spans and the digest of the empty string. Repeated rows
    stay, an empty table gives no rows. Rows are mapped without a shuffle.
    """

    def make():
        def rows(texts):
            out = []
            for text in texts:
                spans = find_spans(text or "")
                kinds = [s.kind for s in spans]
                base = written([s for s in spans if s.kind in BASE])
                digest = hashlib.sha256(base.encode()).hexdigest()
                out.append((*map(kinds.count, BASE), digest, written(spans)))
            return tuple(zip(*out, strict=True)) if out else ((),) * (len(BASE) + 2)

        return rows

    counts = ", ".join(f"n_{kind} bigint" for kind in BASE)
    return map_rows(df, keep, [text], f"{counts}, base_sha256 string, spans string", make)


def redact(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` with ``redacted``: the text with marks for personal data (null: null)."""

    def make():
        def one(text):
            return text if text is None else redacted(text, find_spans(text))

        return lambda texts: (list(map(one, texts)),)

    return map_rows(df, keep, [text], "redacted string", make)
