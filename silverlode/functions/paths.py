"""File name and path expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c

# File kinds that count as data, and the archive name shape
# COMPANY_TYPE_date.zip.
DATA_EXTENSIONS = (".csv", ".parquet")
ARCHIVE_NAME_REGEX = r"^([^_]+)_([^_]+)_(.+)\.zip$"


def tenant_path(*parts) -> Column:
    return F.concat_ws("/", *[_c(p) for p in parts])


def base_name(c) -> Column:
    return F.element_at(F.split(_c(c), "/"), -1)


def swap_extension(c, old: str, new: str) -> Column:
    return F.regexp_replace(_c(c), "\\" + old + "$", new)


def unix_path(c) -> Column:
    return F.replace(_c(c), F.lit("\\"), F.lit("/"))


def strip_root(path, root) -> Column:
    p, prefix = _c(path), F.concat(_c(root), F.lit("/"))
    return F.when(p.startswith(prefix), F.substr(p, F.length(prefix) + 1)).otherwise(p)


def top_segment(c) -> Column:
    return F.split(_c(c), "/")[0]


def has_extension(c, *extensions: str) -> Column:
    cond = F.lit(False)
    for ext in extensions:
        cond = cond | F.lower(_c(c)).endswith(ext)
    return cond


def is_data_file(c) -> Column:
    return has_extension(c, *DATA_EXTENSIONS)


def routed_company(c) -> Column:
    return F.nullif(F.lower(F.regexp_extract(_c(c), ARCHIVE_NAME_REGEX, 1)), F.lit(""))


def routed_type(c) -> Column:
    return F.nullif(F.upper(F.regexp_extract(_c(c), ARCHIVE_NAME_REGEX, 2)), F.lit(""))
