"""Null-on-error casts from untrusted text. All are native expressions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskflow.functions.ip import canonical_ip

# The accepted text forms. \z, because Java's $ also matches before a final line break.
NUMBER_TEXT = r"^-?\d+(\.\d+)?\z"
MONEY_TEXT = r"^\s*-?\d+(\.\d{1,2})?\s*\z"
ISO_TEXT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?([+-]\d{2}:\d{2}|Z)?\z"
MONEY_TYPE = "decimal(15,2)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_float(c: Column | str) -> Column:
    """A plain decimal number as double; anything else, and a number out of range, gives null."""
    c = _col(c)
    number = c.try_cast("double")
    for endless in (float("inf"), float("-inf")):
        number = F.nullif(number, F.lit(endless))
    return F.when(c.rlike(NUMBER_TEXT), number)


def safe_id(c: Column | str) -> Column:
    """An id as bigint. Ids travel as floating text (``12.0``) and round half to even."""
    c = _col(c)
    return F.when(c.rlike(NUMBER_TEXT), round_to_long(c.try_cast("double")))


def round_to_long(c: Column | str) -> Column:
    """Floating number to bigint, rounding half to even instead of cutting off; out of range gives null."""
    return F.rint(_col(c)).try_cast("bigint")


def safe_numeric(c: Column | str, strict: bool = True) -> Column:
    """Money as decimal(15,2).

    ``strict`` accepts at most two decimals and no exponent. Otherwise every decimal text is accepted and
    rounded half up, which keeps amounts that floating arithmetic left with trailing digits.
    """
    c = _col(c)
    if strict:
        return F.when(c.rlike(MONEY_TEXT), c.try_cast(MONEY_TYPE))
    return F.round(c.try_cast("decimal(38,12)"), 2).try_cast(MONEY_TYPE)


def safe_timestamp(c: Column | str, zone: str = "Z") -> Column:
    """An ISO date-time as timestamp; text without an offset is read in ``zone``."""
    c = _col(c)
    has_zone = c.endswith("Z") | F.substring(c, -6, 1).isin("+", "-")
    zoned = F.when(has_zone, c).otherwise(F.concat(c, F.lit(zone)))
    return F.when(c.rlike(ISO_TEXT), zoned.try_cast("timestamp"))


def safe_date(c: Column | str) -> Column:
    """The calendar date of an ISO date-time as written; a bare date is rejected."""
    c = _col(c)
    return F.when(safe_timestamp(c).isNotNull(), F.substring(c, 1, 10).try_cast("date"))


def safe_inet(c: Column | str) -> Column:
    """A dotted IPv4 address in canonical text; anything else gives null."""
    return canonical_ip(c)
