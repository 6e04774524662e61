"""E-mail validation rules of the customer intake, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from opticart.params import ALLOWED_EMAIL_SUFFIXES, EMAIL_RULES


def collated(email: Column, collation: str) -> Column:
    """The address under a collation, for comparisons, joins and groups; as it is without one.

    UTF8_LCASE_RTRIM is what the reference's case-insensitive, blank-padded comparison does.
    """
    return F.collate(email, collation) if collation else email


def email_suffix(email: Column) -> Column:
    """Lower-cased text after the last dot (the whole text if there is none).

    Trailing spaces are dropped: the reference compares strings padded with
    spaces, so 'com  ' equals 'com' there.
    """
    return F.rtrim(F.lower(F.substring_index(email, ".", -1)))


def email_error_code(email: Column,
                     allowed: Sequence[str] = ALLOWED_EMAIL_SUFFIXES) -> Column:
    """First failing rule's code, or NULL when the address passes.

    Three-valued logic as in the reference: a NULL address fails no check.
    A multi-part suffix such as 'co.il' can never match, since the suffix
    is taken after the last dot.
    """
    (no_at, _), (no_dot, _), (bad_suffix, _) = EMAIL_RULES
    return (F.when(F.instr(email, "@") == 0, F.lit(no_at))
            .when(F.instr(email, ".") == 0, F.lit(no_dot))
            .when(~email_suffix(email).isin(list(allowed)), F.lit(bad_suffix)))


def email_error_message(code: Column) -> Column:
    out = F.lit(None).cast("string")
    for number, text in reversed(EMAIL_RULES):
        out = F.when(code == number, F.lit(text)).otherwise(out)
    return out
