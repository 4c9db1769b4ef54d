"""Writers and table layout.

A table is a folder of parquet.  Writers never read and overwrite the same path
in one plan: an update goes to a new snapshot folder.  Concurrent writers to one
path are not supported.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions import curves, dates

from .files import SCHEMA_FOLDER


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Adaptive re-distribution before a write.

    Small partitions are merged up to and large ones split down to the advisory
    size, so neither tiny files nor one writer for a hot partition value result.
    """
    return df.hint("rebalance", *columns) if columns else df.hint("rebalance")


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the whole table at ``path``."""
    out = balanced(df, *partition_by) if partition_by else df
    out.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def overwrite_verified(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> tuple[int, int]:
    """Replace the table at ``path``; returns the rows sent, observed on their way, and those found there."""
    seen = Observation()
    overwrite(df.observe(seen, F.count(F.lit(1)).alias("n")), path, partition_by)
    written = df.sparkSession.read.schema(df.schema).parquet(path).count()
    # A plan that turns out empty is cut short before anything is observed.
    return (seen.get["n"] if written else df.count()), written


def overwrite_bucketed(df: DataFrame, name: str, path: str, buckets: int, keys: Sequence[str]) -> None:
    """Catalog table ``name`` over ``path`` with one sorted file per bucket of ``keys``."""
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    out = balanced(df, *partition_by) if partition_by else df
    out.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df``."""
    (
        balanced(df, *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def create_empty(spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    """An empty table whose schema readers can rely on.

    A partitioned table without rows has no file, so its schema is kept beside the
    partitions, in a folder that readers of the data skip; ``files.read_table`` uses it.
    """
    empty = spark.createDataFrame([], schema)
    if not partition_by:
        empty.write.mode("ignore").parquet(path)
        return
    empty.write.mode("ignore").partitionBy(*partition_by).parquet(path)
    declared = spark.createDataFrame([(schema.json(),)], "value string")
    declared.coalesce(1).write.mode("ignore").text(f"{path}/{SCHEMA_FOLDER}")


def create_if_absent(spark: SparkSession, name: str, ddl: str, path: str, partition_by: Sequence[str] = ()) -> None:
    """Catalog table over ``path`` unless it already exists."""
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{parts} LOCATION '{path}'")


def compact(spark: SparkSession, source: str, target: str, partition_by: Sequence[str] = ()) -> None:
    """Rewrite the table at ``source`` into well-sized files at ``target``."""
    out = balanced(spark.read.parquet(source), *partition_by)
    out.write.mode("overwrite").partitionBy(*partition_by).parquet(target)


def cluster_by(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Range-clustered layout so that min/max statistics skip files and row groups."""
    df.repartitionByRange(*columns).sortWithinPartitions(*columns).write.mode("overwrite").parquet(path)


def split_points(df: DataFrame, columns: Sequence[str], parts: int, sample_rows: int = 20_000) -> dict[str, list]:
    """Values that cut each column into about ``parts`` ranges of equally many rows.

    Taken from the ``sample_rows`` rows that are first by a hash of the columns, so that
    no more than these reach the driver; they decide about the layout alone.
    """
    rows = df.select(*columns).orderBy(F.xxhash64(*columns)).limit(sample_rows).collect()
    out = {}
    for c in columns:
        values = sorted(r[c] for r in rows if r[c] is not None)
        cuts = [values[len(values) * i // parts] for i in range(1, parts)] if values else []
        # A value that fills several ranges is one cut; nothing lies below the smallest value.
        out[c] = [v for v in dict.fromkeys(cuts) if v != values[0]]
    return out


def cluster_by_curve(df: DataFrame, path: str, columns: Sequence[str], bits: int = 6) -> None:
    """Z-ordered layout: min/max statistics of every one of ``columns`` skip files and row groups.

    Columns are cut into ``2 ** bits`` ranges of equally many rows, the ranges' numbers
    are interleaved bit by bit, and rows are range-partitioned and sorted by the result.
    A hash of the row spreads ranges that hold very many rows.
    """
    points = split_points(df, columns, 1 << bits)
    curve = curves.interleaved([curves.place(points[c], F.col(c)) for c in columns], bits)
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    keyed = df.withColumns({"_curve": curve, "_spread": F.xxhash64(*plain)})
    ordered = keyed.repartitionByRange("_curve", "_spread").sortWithinPartitions("_curve", "_spread")
    ordered.drop("_curve", "_spread").write.mode("overwrite").parquet(path)


def analyze(spark: SparkSession, name: str, columns: Sequence[str] = ()) -> None:
    """Table and column statistics for the cost-based optimizer."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    if columns:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")


def as_json(df: DataFrame, column: str = "json") -> DataFrame:
    """Each row as one JSON text."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(column))


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def insert_row(df: DataFrame, values: dict) -> DataFrame:
    """``df`` plus one literal row; columns not given are null."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    row = df.sparkSession.range(1).select(
        *[F.lit(values.get(name)).cast(kind).alias(name) for name, kind in fields.items()]
    )
    return df.unionByName(row)


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Load conversion to a declared schema; values that do not fit become null.

    ``lost_values`` counts them.
    """
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def lost_values(df: DataFrame, schema: T.StructType, lengths: dict[str, int] | None = None) -> DataFrame:
    """(column, not_converted, truncated): what ``cast_to`` and ``truncate_to`` lose, in one pass."""
    lengths = lengths or {}
    rows = []
    for f in schema.fields:
        lost = F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
        cut = F.count_if(F.length(f.name) > lengths[f.name]) if f.name in lengths else F.lit(0).cast("long")
        rows.append(F.struct(F.lit(f.name).alias("column"), lost.alias("not_converted"), cut.alias("truncated")))
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def truncate_to(df: DataFrame, lengths: dict[str, int]) -> DataFrame:
    """Cut text columns to their declared lengths (the load allows truncation)."""
    return df.withColumns({c: F.substring(c, 1, n) for c, n in lengths.items()})


def expired_snapshots(registry: DataFrame, as_of: str, retention_hours: int) -> DataFrame:
    """Snapshots older than the retention that are not the table's live one."""
    live = registry.groupBy("table_name").agg(F.max("snapshot_at").alias("snapshot_at"))
    old = registry.where(F.col("snapshot_at") < dates.hours_before(as_of, retention_hours))
    return old.join(live, ["table_name", "snapshot_at"], "left_anti")
