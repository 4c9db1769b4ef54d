"""Incremental twins of the batch operators.

Every job reads a landing folder as a file stream, keeps its progress in a
checkpoint folder on shared storage and stops once all present files are
processed.  Rerunning continues where the last run ended; a failed or repeated
micro-batch overwrites its own output, so effects are exactly once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions import paths
from silverlode.operators import tenants
from silverlode.sources import files


def landing_stream(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet", files_per_batch: int = 1000
) -> DataFrame:
    """New files below ``path``, each delivered once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(file_format).load(path)


def _finish(writer) -> None:
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def ingest(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Landing -> bronze: append every row once."""
    _finish(
        stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append")
    )


def each_batch(stream: DataFrame, action: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    _finish(stream.writeStream.foreachBatch(action).option("checkpointLocation", checkpoint))


# ---- versioned state -------------------------------------------------------------------


def version_path(root: str, batch_id: int) -> str:
    return f"{root}/version={batch_id}"


def read_version(spark: SparkSession, root: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """State written by an earlier micro-batch, empty before the first; lost state is an error."""
    state, status = files.read_or_empty(spark, version_path(root, batch_id), schema)
    if batch_id >= 0 and status == "NO_DATA":
        raise RuntimeError(f"the state of batch {batch_id} below {root} is gone")
    return state


def drop_version(spark: SparkSession, root: str, batch_id: int) -> None:
    """Remove a state that no retry can need any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(version_path(root, batch_id))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# ---- increments, windows, deduplication -------------------------------------------------


def since_mark(df: DataFrame, column: str, mark: Column) -> DataFrame:
    """Rows newer than the stored high-water mark."""
    return df.where(F.col(column) > mark)


def high_water_mark(df: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(column).alias("high_water_mark"))


def windowed_outcomes(stream: DataFrame, time_column: str, width: str, lateness: str) -> DataFrame:
    """Runs, successes and failures per tumbling window; rows later than ``lateness`` drop out."""
    timed = stream.withColumn(time_column, F.col(time_column).cast("timestamp")).withWatermark(time_column, lateness)
    return timed.groupBy(F.window(time_column, width)).agg(
        F.count("*").alias("total"),
        F.count_if(F.col("event_type") != "error").alias("succeeded"),
        F.count_if(F.col("event_type") == "error").alias("failed"),
    ).select(F.col("window.start").alias("window_start"), "total", "succeeded", "failed")


def write_windows(windows: DataFrame, target: str, checkpoint: str) -> None:
    """Write the windows each micro-batch changed; ``latest_windows`` reads the outcome."""

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(version_path(target, batch_id))

    _finish(windows.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint))


def latest_windows(spark: SparkSession, target: str, columns: Sequence[str]) -> DataFrame:
    """Newest figures of every window."""
    newest = F.max(F.struct("version", *columns)).alias("m")
    return spark.read.parquet(target).groupBy("window_start").agg(newest).select(
        "window_start", *[F.col(f"m.{c}").alias(c) for c in columns]
    )


def deduplicate(stream: DataFrame, keys: Sequence[str], time_column: str, lateness: str) -> DataFrame:
    """First delivery of each key within the lateness bound."""
    timed = stream.withColumn(time_column, F.col(time_column).cast("timestamp")).withWatermark(time_column, lateness)
    return timed.dropDuplicatesWithinWatermark(list(keys))


# ---- windows beside late rows ------------------------------------------------------------

ACCOUNT = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("delivered", T.LongType()),
        T.StructField("counted", T.LongType()),
        T.StructField("late", T.LongType()),
        T.StructField("newest", T.TimestampType()),
    ]
)


def count_windows(stream: DataFrame, time_column: str, width: str, lateness: str, target: str, checkpoint: str) -> None:
    """Count outcomes per tumbling window and keep the rows that come too late beside them.

    A window is closed once the newest time of earlier batches, less ``lateness``, has
    reached its end; rows for closed windows, and rows without a time, are late.  They are
    separated before the aggregation and stored as they are, so that per batch
    ``counted + late = delivered`` (``accounts``).  A batch stores its own partial counts,
    which ``counted_windows`` adds up; the only state is the newest time.  A retried batch
    overwrites its own output.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = read_version(spark, f"{target}/accounts", batch_id - 1, ACCOUNT)
        newest = before.agg(F.max("newest")).first()[0]
        time = F.col(time_column).cast("timestamp")
        bound = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {lateness}")
        # F.window drops rows without a time, wherever it is used; so the window's end is computed.
        size = F.unix_micros(F.lit("1970-01-01 00:00:00").cast("timestamp") + F.expr(f"INTERVAL {width}"))
        end = F.timestamp_micros((F.floor(F.unix_micros(time) / size) + 1) * size)
        late = time.isNull() | F.coalesce(end <= bound, F.lit(False))
        counts = batch.where(~late).groupBy(F.window(time, width)["start"].alias("window_start")).agg(
            F.count("*").alias("total"),
            F.count_if(F.col("event_type") != "error").alias("succeeded"),
            F.count_if(F.col("event_type") == "error").alias("failed"),
        )
        counts.write.mode("overwrite").parquet(version_path(f"{target}/counts", batch_id))
        batch.where(late).write.mode("overwrite").parquet(version_path(f"{target}/late", batch_id))
        # Reads the time column alone.
        told = batch.agg(F.count("*").alias("delivered"), F.count_if(late).alias("late"), F.max(time).alias("newest")).first()
        latest = max((t for t in (newest, told["newest"]) if t is not None), default=None)
        row = (batch_id, told["delivered"], told["delivered"] - told["late"], told["late"], latest)
        account = spark.createDataFrame([row], ACCOUNT)
        account.coalesce(1).write.mode("overwrite").parquet(version_path(f"{target}/accounts", batch_id))

    each_batch(stream, put, checkpoint)


def counted_windows(spark: SparkSession, target: str) -> DataFrame:
    """Figures of every window over all batches."""
    parts = spark.read.parquet(f"{target}/counts").groupBy("window_start")
    return parts.agg(*[F.sum(c).alias(c) for c in ("total", "succeeded", "failed")])


def late_rows(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The rows that came after their window was closed."""
    return all_versions(spark, f"{target}/late", schema)


def accounts(spark: SparkSession, target: str) -> DataFrame:
    """Per batch, what was delivered, counted and late."""
    return spark.read.schema(ACCOUNT).parquet(f"{target}/accounts")


# ---- stateful gates ----------------------------------------------------------------------

ARRIVALS = T.StructType(
    [T.StructField("pod_id", T.StringType()), T.StructField("company", T.StringType()), T.StructField("domain", T.StringType())]
)


RELEASED = T.StructType(
    [T.StructField("pod_id", T.StringType()), T.StructField("company", T.StringType()), T.StructField("version", T.IntegerType())]
)


def completeness_stream(stream: DataFrame, config: DataFrame, state: str, released: str, checkpoint: str) -> None:
    """Release each company once, in the first micro-batch that finds it complete.

    State is the distinct (company, domain) arrivals seen so far and the companies
    released, both bounded by the configuration and not by the number of files.  What
    counts as complete may change with the configuration between batches.
    """

    def gate(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = read_version(spark, state, batch_id - 1, ARRIVALS)
        now = before.unionByName(_data_arrivals(batch)).distinct()
        now.write.mode("overwrite").parquet(version_path(state, batch_id))
        now = spark.read.schema(ARRIVALS).parquet(version_path(state, batch_id))
        earlier = all_versions(spark, released, RELEASED).where(F.col("version") < batch_id)
        newly = _complete(config, now).join(earlier, ["pod_id", "company"], "left_anti")
        newly.write.mode("overwrite").parquet(version_path(released, batch_id))
        drop_version(spark, state, batch_id - 2)

    each_batch(stream, gate, checkpoint)


def _data_arrivals(batch: DataFrame) -> DataFrame:
    return batch.where(paths.is_data_file("file_name")).select("pod_id", "company", "domain").distinct()


def _complete(config: DataFrame, arrivals: DataFrame) -> DataFrame:
    listed = arrivals.withColumn("file_name", F.lit("arrived.csv"))
    # A company that asks for nothing is never released.
    gate = tenants.completeness_gate(config.where(F.size("domains") > 0), listed)
    return gate.where("status = 'COMPLETE'").select("pod_id", "company")


def all_versions(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Union of what every micro-batch wrote."""
    return files.read_or_empty(spark, root, schema)[0]
