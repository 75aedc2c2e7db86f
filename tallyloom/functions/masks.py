"""Masking expressions: (column, role) -> column.

The role is an explicit argument of the read, never a value in the data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FULL = {"admin", "compliance"}
PARTIAL = {"analyst", "engineer"}


def _tiers(role: str, full: Column, partial: Column, none: Column) -> Column:
    return full if role in FULL else partial if role in PARTIAL else none


def email_mask(c: Column, role: str) -> Column:
    """Whole address, domain only, or nothing."""
    return _tiers(role, c, F.regexp_replace(c, "^[^@]+", "****"), F.lit("****@****.***"))


def phone_mask(c: Column, role: str) -> Column:
    """All digits hidden but the last four characters of the string."""
    head = F.substring(c, F.lit(1), F.length(c) - 4)
    return _tiers(role, c, F.concat(F.regexp_replace(head, "[0-9]", "*"), F.right(c, F.lit(4))), F.lit("(***) ***-****"))


def name_mask(c: Column, role: str) -> Column:
    return _tiers(role, c, F.concat(F.left(c, F.lit(1)), F.lit("***")), F.lit("***"))


def amount_mask(c: Column, role: str) -> Column:
    """Exact for staff, rounded to hundreds for viewers, NULL for anyone else."""
    if role in FULL or role in PARTIAL:
        return c
    return F.round(c, -2) if role == "viewer" else F.lit(None).cast("double")


def short_email_mask(c: Column, role: str) -> Column:
    return c if role == "admin" else F.regexp_replace(c, ".+@", "****@")


def short_phone_mask(c: Column, role: str) -> Column:
    return c if role == "admin" else F.concat(F.lit("(***) ***-"), F.right(c, F.lit(4)))


def short_name_mask(c: Column, role: str) -> Column:
    """Initial and last token: ``J. Smith``."""
    return c if role == "admin" else F.concat(F.left(c, F.lit(1)), F.lit(". "), F.split_part(c, F.lit(" "), F.lit(-1)))


def tag_mask(c: Column, tag: str | None, role: str) -> Column:
    if role in FULL or tag is None:
        return c
    return F.lit("***REDACTED***") if tag == "DIRECT_IDENTIFIER" else F.concat(F.left(c, F.lit(1)), F.lit("***")) if tag == "QUASI_IDENTIFIER" else c
