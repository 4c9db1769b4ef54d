"""Exact duplicates by a stateful stream over the arriving files.

The stream's state is keyed by the digest of the normalised text and never expires.
It lies in RocksDB on the executors' disks, backed up below the checkpoint folder
with every batch, so it survives lost executors and restarts.  Per digest it retains
the stable identifier of the row that stays, that row's content locator (file and
row number) and the number of rows.  Hits, texts whose digest was seen before, are
compared byte for byte with the text the locator points to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, materialize

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# State lies in RocksDB; its files are not pre-allocated, since there are many small stores.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def content_digest(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, lowercase hex; null counts as empty."""
    return F.sha2(text, 256)


def _rows(source: DataFrame, id_column: str, text_column: str, digest) -> DataFrame:
    """Identifier, locator, normalised text and digest of every row of a file source."""
    text = ascii_lower(F.coalesce(F.col(text_column), F.lit("")))
    return source.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
        text.alias("text"),
    ).withColumn("digest", digest(F.col("text")))


def update_state(
    spark: SparkSession, path: str, state: str, id_column="doc_id", text_column="text", digest=content_digest
) -> None:
    """Take the files of the parquet table ``path`` that the state has not seen yet into it.

    ``state`` is a shared folder; calling again with the same folder continues there.
    """
    schema = spark.read.parquet(path).schema
    # The file source lists folders and patterns; a bare file is made a pattern.
    source = spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")
    rows = _rows(source, id_column, text_column, digest)
    seen = rows.groupBy("digest").agg(F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count("*").alias("n"))
    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        writer = seen.writeStream.outputMode("update").format("noop").option("checkpointLocation", state)
        writer.trigger(availableNow=True).start().awaitTermination()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def read_state(spark: SparkSession, state: str) -> DataFrame:
    """``(digest, keep, n)`` of every text seen so far."""
    stored = spark.read.format("statestore").load(state)
    keep, n = stored.schema["value"].dataType.names
    return stored.select("key.digest", F.col("value")[keep].alias("keep"), F.col("value")[n].alias("n"))


def exact_duplicates(
    spark: SparkSession,
    path: str,
    state: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    digest=content_digest,
) -> DataFrame:
    """Groups of equal texts of the parquet table ``path``, after taking it into ``state``.

    Texts are equal when identical after lower-casing A-Z only.  Returns one row per
    row: ``doc_id``, ``keep_id`` (largest id of the group; its row stays),
    ``group_size``, ``kept`` and ``text_sha256``.

    * Null texts count as empty; empty texts equal each other.
    * Rows without an id stay only if no equal row has one; ``keep_id`` is then null.
    * Of rows that repeat id and text, the last by file and row number stays.
    * Other columns are not read; an empty table gives an empty result.
    * Digests may collide: texts that differ from the kept text of their digest form
      groups of their own, by their full bytes.  ``digest`` is replaceable to test that.
    """
    update_state(spark, path, state, id_column, text_column, digest)
    rows = _rows(spark.read.parquet(path), id_column, text_column, digest)
    groups = materialize(read_state(spark, state), "groups")

    # Full bytes of the hits against the kept row's text.
    several = groups.where("n > 1").select("digest", "keep")
    hits = rows.join(several, "digest").select("digest", "doc_id", "file", "row", "text", "keep")
    hits = materialize(hits, "hits")
    is_keeper = (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))
    keepers = hits.where(is_keeper).select("digest", F.col("text").alias("keep_text"))
    differing = hits.join(keepers, "digest").where("text != keep_text").select("digest").distinct()
    differing = materialize(differing, "collisions")

    place = rows.select("doc_id", "file", "row", "digest", F.sha2("text", 256).alias("text_sha256"))
    plain = place.join(groups.join(differing, "digest", "left_anti"), "digest")
    # Without a collision, the usual case, this part reads an empty table.
    clashing = hits.join(differing, "digest", "left_semi").select("digest", "doc_id", "file", "row", "text")
    own = clashing.groupBy("digest", "text").agg(
        F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count("*").alias("n")
    )
    apart = clashing.join(own, ["digest", "text"]).withColumn("text_sha256", F.sha2("text", 256))
    columns = ["doc_id", "file", "row", "keep", "n", "text_sha256"]
    return (
        plain.select(*columns)
        .union(apart.select(*columns))
        .select(
            "doc_id",
            F.col("keep.doc_id").alias("keep_id"),
            F.col("n").alias("group_size"),
            is_keeper.alias("kept"),
            "text_sha256",
        )
    )
