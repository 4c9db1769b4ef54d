"""JSON, map and array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c


def json_prop(c, name: str) -> Column:
    return F.get_json_object(_c(c), f"$.{name}")


def merge_maps(left, right) -> Column:
    """Union of two maps; the right value wins on a shared key."""
    return F.map_zip_with(_c(left), _c(right), lambda _, old, new: F.coalesce(new, old))


def map_get(c, key: str) -> Column:
    return F.try_element_at(_c(c), F.lit(key))


def missing_items(required, found) -> Column:
    return F.array_except(_c(required), _c(found))


def shared_items(required, found) -> Column:
    return F.array_intersect(_c(required), _c(found))
