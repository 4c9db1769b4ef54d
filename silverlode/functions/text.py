"""String cleaning and matching."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Canonical payment methods and the label for everything else.
PAYMENT_METHODS = ("Direct Deposit", "Check", "Wire Transfer")
UNKNOWN_METHOD = "Unknown"

# Spellings that mean "no bank account".
MISSING_SENTINELS = ("N/A", "NA", "")

# Loose and strict e-mail shapes.
LOOSE_EMAIL_LIKE = "%@%.%"
STRICT_EMAIL_REGEX = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c) -> Column:
    return F.trim(_c(c))


def lower_trimmed(c) -> Column:
    return F.lower(F.trim(_c(c)))


def proper_case(c) -> Column:
    return F.initcap(F.trim(_c(c)))


def blank_to_null(c) -> Column:
    return F.nullif(F.trim(_c(c)), F.lit(""))


def sentinel_to_null(c, sentinels=MISSING_SENTINELS) -> Column:
    t = F.trim(_c(c))
    return F.when(~t.isin(*sentinels), t)


def is_blank(c) -> Column:
    return _c(c).isNull() | (F.trim(_c(c)) == "")


def has_text(c) -> Column:
    return _c(c).isNotNull() & (F.trim(_c(c)) != "")


def loose_email(c) -> Column:
    """The permissive shape test, applied to the untrimmed value."""
    return _c(c).like(LOOSE_EMAIL_LIKE)


def strict_email(c) -> Column:
    return F.coalesce(_c(c).rlike(STRICT_EMAIL_REGEX), F.lit(False))


def payment_method(c) -> Column:
    """Canonical payment method; unknown and missing spellings become 'Unknown'."""
    key = F.upper(F.trim(_c(c)))
    known = [F.when(key == m.upper(), F.lit(m)) for m in PAYMENT_METHODS]
    return F.coalesce(*known, F.lit(UNKNOWN_METHOD))


def full_name(first, last) -> Column:
    """Null if either part is null."""
    return F.concat(_c(first), F.lit(" "), _c(last))


def contains_ci(c, needle: str) -> Column:
    return F.lower(_c(c)).contains(needle.lower())


def starts_with_ci(c, prefix: str) -> Column:
    return F.lower(_c(c)).startswith(prefix.lower())


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)
