"""Phone and e-mail columns as plain expressions: no Python worker involved."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import INVALID_PHONE, NOT_AVAILABLE

# What counts as an e-mail address and as a dialled number. Digits
# are those of any script.
EMAIL_PATTERN = r"^[^@]+@[^@]+\.[^@]+$"
NOT_DIALLED = r"[^\p{Nd}Xx]"
TEN_DIGITS = r"1?(\p{Nd}{3})(\p{Nd}{3})(\p{Nd}{4})"
TWELVE_DIGITS = r"001(\p{Nd}{3})(\p{Nd}{3})(\p{Nd}{3})"
TWELVE_OR_THIRTEEN_DIGITS = r"001(\p{Nd}{3})(\p{Nd}{3})(\p{Nd}{3,4})"
EXTENSION = r"(x\p{Nd}+)?"
WRITTEN = "+1 ($1$4) $2$5-$3$6$7"


def valid_email(email: Column, invalid_message: str) -> Column:
    """The address if it looks like one, else (null included) the message."""
    return F.when(email.rlike(EMAIL_PATTERN), email).otherwise(invalid_message)


def clean_phone(phone: Column, accept_001_13: bool = False) -> Column:
    """Write North American numbers as ``+1 (ppp) ppp-pppp[xN]``.

    Accepted are 10 digits, 11 digits after a leading 1, and 12 characters that
    start with 001 (a nine-digit rest: an old rule kept for equal results).
    ``accept_001_13=True`` also takes 001 and a full ten-digit number.
    """
    return accepted_phone(phone, written_phone(phone, accept_001_13))


def written_phone(phone: Column, accept_001_13: bool = False) -> Column:
    """A dialled number as it is to be written; anything else without a plus sign.

    Two passes over the text: one drops what cannot be dialled, one groups the
    digits.
    """
    dialled = F.lower(F.regexp_replace(phone, NOT_DIALLED, ""))
    prefixed = TWELVE_OR_THIRTEEN_DIGITS if accept_001_13 else TWELVE_DIGITS
    number = f"^(?:{TEN_DIGITS}|{prefixed}){EXTENSION}$"
    return F.regexp_replace(dialled, number, WRITTEN)


def accepted_phone(phone: Column, written: Column) -> Column:
    """The written number, ``Not Available`` as it is, or the invalid mark."""
    return (
        F.when(phone == NOT_AVAILABLE, phone)
        .when(written.startswith("+"), written)
        .otherwise(INVALID_PHONE)
    )
