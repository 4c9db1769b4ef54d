"""Manifest files: ``<hex digest>|<relative path>`` lines with ``#`` comments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.functions import paths

from .files import below

# Byte order mark, comment sign, root header and line shape.
BOM = "﻿"
COMMENT = "#"
ROOT_HEADER_REGEX = r"^#\s*Root:\s*(.+)$"
LINE_REGEX = r"^\s*([0-9A-Fa-f]+)\s*\|\s*(.+?)\s*$"


def read_manifest_lines(spark: SparkSession, path: str, glob: str = "*.hash") -> DataFrame:
    """(archive, line) of all manifests below ``path``.

    ``archive`` is the manifest's path below ``path`` without its extension, so it names
    the archive beside which it lies.
    """
    raw = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path)
    # The metadata column has the path as a URI.
    uri = F.regexp_replace("_metadata.file_path", "^file:/+", "file:/")
    name = below(spark, path, F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))))
    return raw.select(F.regexp_replace(name, r"\.hash$", "").alias("archive"), F.col("value").alias("line"))


def parse_entries(lines: DataFrame) -> DataFrame:
    """(archive, path, expected): comments, blank and malformed lines dropped."""
    line = F.regexp_replace("line", "^" + BOM, "")
    return (
        lines.select("archive", line.alias("line"))
        .where(~F.ltrim("line").startswith(COMMENT) & F.col("line").rlike(LINE_REGEX))
        .select(
            "archive",
            paths.unix_path(F.regexp_extract("line", LINE_REGEX, 2)).alias("path"),
            F.lower(F.regexp_extract("line", LINE_REGEX, 1)).alias("expected"),
        )
    )


def parse_roots(lines: DataFrame) -> DataFrame:
    """(archive, root) from ``# Root:`` headers, one per archive."""
    line = F.regexp_replace("line", "^" + BOM, "")
    return (
        lines.select("archive", F.trim(F.regexp_extract(line, ROOT_HEADER_REGEX, 1)).alias("root"))
        .where("root <> ''")
        .groupBy("archive")
        .agg(F.min("root").alias("root"))
    )
