"""Table, CSV, JSON and file-listing readers."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.session import scratch_path

from .remote import locate


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, infer: bool = False, glob: str | None = None
) -> DataFrame:
    """Header CSV.  Without a schema every column is text; ``infer`` scans twice."""
    reader = spark.read.option("header", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


# Where a partitioned table without rows keeps its schema.
SCHEMA_FOLDER = "_schema"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``; without any file, an empty one of the declared schema."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as err:
        if "UNABLE_TO_INFER_SCHEMA" not in str(err.getCondition() or err):
            raise
        declared = spark.read.text(f"{path}/{SCHEMA_FOLDER}").first()
        return spark.read.schema(T.StructType.fromJson(json.loads(declared["value"]))).parquet(path)


def read_named(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_tenant(spark: SparkSession, path: str, pod: str) -> DataFrame:
    """Only one pod's partition directories are listed and read."""
    return spark.read.parquet(path).where(F.col("pod_id") == pod)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, str]:
    """The table and 'READY', or an empty frame and 'NO_DATA' when it is not there."""
    try:
        return spark.read.schema(schema).parquet(path), "READY"
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err.getCondition() or err):
            raise
        return spark.createDataFrame([], schema), "NO_DATA"


def exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def below(spark: SparkSession, root: str, path: Column) -> Column:
    """``path`` relative to the folder ``root``; the file's name where it lies elsewhere or ``root`` is a pattern."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    prefix = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString().rstrip("/") + "/"
    name = F.element_at(F.split(path, "/"), -1)
    return F.when(path.startswith(prefix), F.substring(path, F.lit(len(prefix) + 1), F.length(path))).otherwise(name)


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, file_name, size_bytes, modified_at); file contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_at"),
    )


LISTED = "path string, file_name string, size_bytes long, is_folder boolean"
ENTRIES_PER_BATCH = 10_000


def _hidden(name: str) -> bool:
    """Names that Spark's readers leave out: temporary files, markers and their like."""
    marker = name.startswith("_") and "=" not in name and not name.startswith(("_metadata", "_common_metadata"))
    return marker or name.startswith(".") or name.endswith("._COPYING_")


def _list_folders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [field.split()[0] for field in LISTED.split(", ")]
    for batch in batches:
        for folder in batch["path"]:
            filesystem, path = locate(folder)
            found = [i for i in filesystem.get_file_info(fs.FileSelector(path)) if not _hidden(i.base_name)]
            for at in range(0, len(found), ENTRIES_PER_BATCH):
                entries = [
                    (f"{folder}/{i.base_name}", i.base_name, i.size, i.type == fs.FileType.Directory)
                    for i in found[at : at + ENTRIES_PER_BATCH]
                ]
                yield pd.DataFrame(entries, columns=names).astype({"size_bytes": "Int64"})


def list_tree(spark: SparkSession, root: str) -> DataFrame:
    """(path, file_name, size_bytes) of all files below the folder ``root``, listed in tasks.

    For trees of very many files, which ``list_files`` would gather on the driver.  Every
    level is one job over the folders of the level above, written to the shared folder.
    Hidden files are left out, as Spark's readers do.
    """
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    start = top.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(top).toString().rstrip("/")
    stored = scratch_path(spark, "listing")
    folders, level = spark.createDataFrame([(start,)], "path string"), 0
    while folders is not None:
        path = f"{stored}/level={level}"
        spread = folders.repartition(spark.sparkContext.defaultParallelism, "path")
        spread.mapInPandas(_list_folders, LISTED).write.parquet(path)
        below_it = spark.read.schema(LISTED).parquet(path).where("is_folder").select("path")
        folders, level = None if below_it.isEmpty() else below_it, level + 1
    return spark.read.schema(LISTED).parquet(stored).where("not is_folder").select("path", "file_name", "size_bytes")


# Shape of a storage-event notification.
STORAGE_EVENT = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("subject", T.StringType()),
        T.StructField("eventType", T.StringType()),
        T.StructField("eventTime", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField("api", T.StringType()),
                    T.StructField("contentType", T.StringType()),
                    T.StructField("contentLength", T.LongType()),
                    T.StructField("blobType", T.StringType()),
                    T.StructField("url", T.StringType()),
                ]
            ),
        ),
        T.StructField("dataVersion", T.StringType()),
        T.StructField("metadataVersion", T.StringType()),
    ]
)


def read_storage_events(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Arrival notifications (JSON arrays, or one object per line)."""
    events = spark.read.schema(STORAGE_EVENT).option("multiLine", multi_line).json(path)
    return events.select(
        "id", "subject", F.col("eventType").alias("event_type"), F.col("data.url").alias("url"),
        F.col("data.contentLength").alias("size_bytes"),
    )


def literal_rows(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """Small reference rows (rules, policies) with a declared schema."""
    return spark.createDataFrame(rows, schema)
