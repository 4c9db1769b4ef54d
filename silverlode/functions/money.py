"""Exact money, percentage and cost arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c

MONEY = "decimal(10,2)"
WIDE = "decimal(20,2)"

# Cent tolerance, hours billed per month, price per worker hour.
CENT_TOLERANCE = "0.01"
HOURS_PER_MONTH = 730
USD_PER_WORKER_HOUR = "0.20"


def money(c) -> Column:
    """Castable text or number as money, else null (never an error)."""
    return _c(c).try_cast(MONEY)


def money_or_zero(c) -> Column:
    return F.coalesce(money(c), F.lit(0).cast(MONEY))


def net_pay(gross, tax, deductions) -> Column:
    return (money(gross) - money(tax) - money_or_zero(deductions)).cast(MONEY)


def net_pay_gap(net, gross, tax, deductions) -> Column:
    """Stated net pay minus the recomputed one."""
    return (money(net) - (money(gross) - money(tax) - money_or_zero(deductions))).cast(MONEY)


def beyond_tolerance(gap: Column, tolerance: str = CENT_TOLERANCE) -> Column:
    return F.abs(gap) > F.lit(tolerance).cast(MONEY)


def total(c) -> Column:
    return F.sum(_c(c)).cast(WIDE)


def percent(part: Column, whole: Column) -> Column:
    """part*100/whole, two digits half up, 0 where whole is not positive."""
    exact = part.cast(WIDE) / whole.cast(WIDE) * 100
    return F.when(whole > 0, F.round(exact, 2)).otherwise(F.lit(0)).cast("decimal(20,2)")


def mean2(total_: Column, n: Column) -> Column:
    """total/n to two digits half up; null when n is 0."""
    return F.round(total_.cast(WIDE) / F.nullif(n.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)")), 2).cast(WIDE)


def zero_to_null(c) -> Column:
    """Opt-in normalisation of a true 0 to null."""
    return F.nullif(_c(c), F.lit(0))


def monthly_cluster_cost(workers) -> Column:
    return (_c(workers) * HOURS_PER_MONTH * F.lit(USD_PER_WORKER_HOUR).cast("decimal(4,2)")).cast(WIDE)


def backoff_seconds(delay, exponential, multiplier, attempt) -> Column:
    """Delay before the next attempt; grows by ``multiplier**attempt`` when exponential."""
    grown = _c(delay) * F.pow(F.coalesce(_c(multiplier), F.lit(1.0)), _c(attempt))
    return F.when(_c(exponential), grown).otherwise(_c(delay).cast("double"))
