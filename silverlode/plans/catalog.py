"""All registered queries."""

from . import (  # noqa: F401
    catalog_files,
    catalog_gold,
    catalog_governance,
    catalog_quality,
    catalog_rows,
    catalog_sets,
    catalog_streams,
)
from .registry import QUERIES

__all__ = ["QUERIES"]
