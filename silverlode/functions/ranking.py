"""Semantic orderings of label columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c

# Labels from most to least important.
PRIORITIES = ("HIGH", "MEDIUM", "LOW")
SEVERITIES = ("CRITICAL", "WARNING", "INFO")


def label_rank(c, labels) -> Column:
    """0 for the first label, then 1, ...; unknown labels sort last."""
    return F.coalesce(*[F.when(_c(c) == name, F.lit(i)) for i, name in enumerate(labels)], F.lit(len(labels)))


def priority_rank(c) -> Column:
    return label_rank(c, PRIORITIES)


def severity_rank(c) -> Column:
    return label_rank(c, SEVERITIES)
