"""Ranks of rows within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize


def ranked(rows: DataFrame, group: list[str], order: list[str], label: str) -> DataFrame:
    """``rows`` with the long ``rank``: the place within the group by ``order``, from 0.

    Rows are dealt to tasks by ranges of ``(group, order)``; a row's rank is its place
    within its task plus the group's rows in earlier tasks.  So a group of any size is
    spread over the tasks.  Nulls come first; rows equal in all of ``order`` are taken
    as interchangeable.  ``rows`` must not have columns ``_place``, ``_part`` or ``rank``.
    """
    # Written first, so that sampling the ranges and a repeated task see the same places.
    placed = materialize(rows.withColumn("_place", F.monotonically_increasing_id()), f"{label}-placed")
    keys = [*group, *order, "_place"]
    parts = placed.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id())
    parts = materialize(parts, f"{label}-parts")
    counts = parts.groupBy("_part", *group).agg(F.count("*").alias("_n"))
    # As many rows per group as there are tasks.
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        F.col("_part").alias("_at"),
        *[F.col(g).alias(f"_of_{g}") for g in group],
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    here = Window.partitionBy("_part", *group).orderBy(*order, "_place")
    numbered = parts.withColumn("_here", F.row_number().over(here).cast("long") - 1)
    same = F.col("_part") == F.col("_at")
    for g in group:
        same &= F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    joined = numbered.join(before, same)
    return joined.select(*rows.columns, (F.col("_here") + F.col("_before")).alias("rank"))
