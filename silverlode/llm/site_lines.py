"""Boilerplate lines of a site: lines on a large share of the host's pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, packed, unpacked

BREAK = "\n"


def line_key(line: Column) -> Column:
    """128-bit key of a line without outer spaces and tabs, as two longs."""
    trimmed = F.trim(line, F.lit(" \t\r"))
    return F.struct(F.xxhash64(trimmed), F.xxhash64(F.lit(1), trimmed))


def is_blank(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\r")) == ""


def boilerplate(pages: DataFrame, ratio: float, min_pages: int) -> DataFrame:
    """``(host, keys)``: the keys of every host's boilerplate lines.

    ``pages`` is ``(host, lines)``.  A host's keys fit one row: if its pages have ``k``
    distinct lines on average, fewer than ``k / ratio`` lines can lie on more than
    ``ratio`` of the pages.
    """
    keys = F.array_distinct(F.transform(F.filter("lines", lambda x: ~is_blank(x)), line_key))
    lines = pages.select("host", F.explode(keys).alias("key"))
    counts = lines.groupBy("host", "key").agg(F.count("*").alias("n"))
    totals = pages.groupBy(F.col("host").alias("of")).agg(F.count("*").alias("pages"))
    often = counts.where(F.col("n") >= min_pages).join(totals, F.col("host").eqNullSafe(F.col("of")))
    often = often.where(F.col("n") > ratio * F.col("pages"))
    return often.groupBy("of").agg(F.sort_array(F.collect_set("key")).alias("keys"))


def cleaned_lines(
    pages: DataFrame,
    host: Column,
    text_column: str = "text",
    ratio: float = 0.1,
    min_pages: int = 3,
) -> DataFrame:
    """``pages`` with the boilerplate lines of their host dropped from ``text_column``.

    A line is boilerplate if more than ``ratio`` of the host's pages, and at least
    ``min_pages`` of them, contain it; outer spaces and tabs do not matter.  Adds the
    longs ``_lines`` and ``_dropped``, the lines before and those dropped; the pages
    must not have columns of these two names.

    * Blank lines are never boilerplate and stay.
    * Null texts stay null with 0 lines, but their page counts for its host.
    * Null hosts make one host of their own.
    * Repeated rows are pages of their own.  A page all of whose lines go keeps an
      empty text.  An empty table gives an empty result.
    """
    rows = packed(pages, text_column, host=host, text=F.col(f"`{text_column}`").cast("string"))
    lines = F.split("text", BREAK)
    found = boilerplate(rows.select("host", lines.alias("lines")), ratio, min_pages)
    # Written, so that Spark joins by its true size: a broadcast only if it is small.
    found = materialize(found, "boilerplate")
    joined = rows.join(found, F.col("host").eqNullSafe(F.col("of")), "left")
    # A text of a host without boilerplate is passed on as it is.
    kept = F.filter(lines, lambda x: is_blank(x) | ~F.array_contains("keys", line_key(x)))
    joined = joined.withColumn("rest", F.when(F.col("keys").isNotNull(), kept))
    total = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long")
    dropped = F.when(F.col("rest").isNull(), 0).otherwise(total - F.size("rest")).cast("long")
    text = F.when(F.col("rest").isNull(), F.col("text")).otherwise(F.array_join("rest", BREAK))
    return unpacked(
        joined, [*pages.columns, "_lines", "_dropped"], **{text_column: text, "_lines": total, "_dropped": dropped}
    )


ORACLE = r"""
WITH p AS (SELECT *, row_number() OVER () AS page FROM documents),
l AS (
  SELECT page, source, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM p WHERE text IS NOT NULL),
t AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
c AS (
  SELECT source, trim(line, ' ' || chr(9) || chr(13)) AS line, count(DISTINCT page) AS n
  FROM l WHERE trim(line, ' ' || chr(9) || chr(13)) <> '' GROUP BY ALL),
b AS (
  SELECT c.source, c.line FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
  WHERE n >= 3 AND n > 0.1 * pages),
k AS (
  SELECT l.page, count(*) AS n_lines, count(b.line) AS n_dropped,
         coalesce(string_agg(l.line, chr(10) ORDER BY pos) FILTER (WHERE b.line IS NULL), '') AS text
  FROM l LEFT JOIN b ON l.source IS NOT DISTINCT FROM b.source
       AND trim(l.line, ' ' || chr(9) || chr(13)) = b.line
  GROUP BY l.page)
SELECT p.doc_id, p.source, k.text, coalesce(k.n_lines, 0)::BIGINT AS n_lines, coalesce(k.n_dropped, 0)::BIGINT AS n_dropped
FROM p LEFT JOIN k USING (page)
"""
