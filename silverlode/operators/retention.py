"""Archive records, retention rules and files due for deletion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions import dates

# Days a file is kept, by path prefix.
RETENTION_BY_PREFIX = (("landing/", 30), ("archive/", 90))


def archive_records(files: DataFrame, keys: Sequence[str], retention_days: int = 90) -> DataFrame:
    """One record per archived batch: file count, megabytes and deletion date."""
    g = files.groupBy(*keys).agg(
        F.count("*").alias("file_count"),
        (F.sum("size_bytes").cast("decimal(20,0)") / 1000000).cast("decimal(20,6)").alias("total_size_mb"),
        F.max("modified_at").alias("archive_timestamp"),
    )
    return g.withColumns(
        {
            "retention_days": F.lit(retention_days),
            "deletion_date": F.date_add(F.col("archive_timestamp").cast("date"), retention_days),
            "archive_date": F.date_format("archive_timestamp", "yyyy-MM-dd"),
        }
    )


def pending_deletion(archives: DataFrame, as_of: str, within_days: int | None = None) -> DataFrame:
    """Archives not yet deleted, soonest first; optionally only those due within a window."""
    today = dates.day(as_of)
    if within_days is None:
        picked = archives.where(F.col("deletion_date") > today)
    else:
        picked = archives.where(F.col("deletion_date").between(today, F.date_add(today, within_days)))
    return picked.withColumn("days_until_deletion", F.datediff("deletion_date", today)).orderBy("days_until_deletion")


def past_retention(files: DataFrame, as_of: str, rules=RETENTION_BY_PREFIX) -> DataFrame:
    """Files older than the retention of their path prefix."""
    keep = F.coalesce(*[F.when(F.col("path").startswith(p), F.lit(d)) for p, d in rules], F.lit(None).cast("int"))
    age = F.datediff(dates.day(as_of), F.col("modified_at").cast("date"))
    return files.select("path", age.alias("age_days"), keep.alias("retention_days")).where("age_days > retention_days")
