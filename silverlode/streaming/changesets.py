"""Tables kept as a bucketed base and the change sets after it.

A micro-batch stores its own rows as a change set; a compaction job merges the sets into
a new base, one file per bucket of the keys.  Readers shuffle the change sets alone and
join them to the base's buckets where these lie.  Every set carries the time of its
arrival, so a table can be read as of a moment for which its sets are still there.

    table/change=7/          rows of batch 7
    table/base=6.64/         everything up to batch 6, in 64 buckets
    table/*/_arrived.<ms>    time of arrival, of the last batch for a base
"""

from __future__ import annotations

import datetime as dt
import functools
import hashlib
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.operators import upsert
from silverlode.sources import sinks

from .jobs import each_batch

ARRIVED = "_arrived."


@dataclass(frozen=True)
class Part:
    """A base or change set: its number (of the last batch), its buckets and its arrival in ms."""

    kind: str
    number: int
    buckets: int
    arrived: int | None
    path: str


def _home(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _names(spark: SparkSession, path: str) -> list[str]:
    home, found = _home(spark, path)
    return [s.getPath().getName() for s in home.listStatus(found)] if home.exists(found) else []


def parts(spark: SparkSession, table: str) -> list[Part]:
    """All sets of ``table``."""
    out = []
    for name in _names(spark, table):
        kind, _, rest = name.partition("=")
        if kind in ("base", "change"):
            number, _, buckets = rest.partition(".")
            path = f"{table}/{name}"
            marks = [int(n[len(ARRIVED) :]) for n in _names(spark, path) if n.startswith(ARRIVED)]
            out.append(Part(kind, int(number), int(buckets or 0), max(marks, default=None), path))
    return out


def _milliseconds(moment: str) -> int:
    """``yyyy-MM-dd HH:mm:ss`` in UTC."""
    return int(dt.datetime.fromisoformat(moment).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


def _mark(spark: SparkSession, path: str, arrived: int) -> None:
    home, mark = _home(spark, f"{path}/{ARRIVED}{arrived}")
    home.create(mark, True).close()


def live(found: Sequence[Part], as_of: str | None = None) -> tuple[Part | None, list[Part]]:
    """The base and the change sets that make up the table, now or as of a moment."""
    last = None if as_of is None else _milliseconds(as_of)
    there = [p for p in found if last is None or (p.arrived is not None and p.arrived <= last)]
    base = max((p for p in there if p.kind == "base"), key=lambda p: p.number, default=None)
    since = base.number if base else -1
    changes = sorted((p for p in there if p.kind == "change" and p.number > since), key=lambda p: p.number)
    newer = max((p.number for p in found if p.kind == "base"), default=-1)
    # Sets that a newer base has replaced may be gone.
    kept = {p.number for p in found if p.kind == "change"}
    if any(n not in kept for n in range(since + 1, newer + 1)):
        raise RuntimeError(f"the state as of {as_of} was compacted")
    return base, changes


def incremental_upsert(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    keys: Sequence[str],
    newest_first: Sequence[str],
    schema: T.StructType,
    arrived: str | None = None,
) -> None:
    """Bronze -> silver: every micro-batch is stored as a change set of its newest rows per key.

    A batch writes what it brings and nothing else, whatever the size of the table.
    Readers take the newest row per key over all sets (``read_upserted``), so an older
    row that arrives late replaces nothing and the cut of batches does not matter.  A
    retried batch overwrites its own set.  ``compact_changes`` keeps the sets few.
    ``arrived`` replaces the clock, for deliveries that are played again.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        newest = upsert.latest_per_key(batch.select(*schema.fieldNames()), keys, newest_first)
        path = f"{table}/change={batch_id}"
        sinks.overwrite(newest, path)
        _mark(batch.sparkSession, path, _milliseconds(arrived) if arrived else int(time.time() * 1000))

    each_batch(stream, put, checkpoint)


def _name(path: str) -> str:
    return "silverlode_" + hashlib.sha256(path.encode()).hexdigest()[:32]


def _read_base(spark: SparkSession, base: Part, keys: Sequence[str], schema: T.StructType) -> DataFrame:
    """The base with its buckets, which only a catalog table can declare; dropping it keeps the files."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    listed = ", ".join(f"`{k}`" for k in keys)
    name, path = _name(base.path), base.path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
        f" CLUSTERED BY ({listed}) SORTED BY ({listed}) INTO {base.buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def merged(base: DataFrame, newest: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """The newer row of each key of two frames with distinct keys.

    Complete keys are joined by equality, which keeps the buckets of ``base``; the few
    rows that lack a key, or a part of it, are compared null-safely on their own.
    """
    rest = [c for c in base.columns if c not in keys and c not in newest_first]
    order = [c for c in [*newest_first, *rest] if c not in keys]
    whole = functools.reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.where(whole).select(*[F.col(k).alias(tag + k) for k in keys], F.struct(*order).alias(f"{tag}row"))

    same = functools.reduce(lambda a, b: a & b, [F.col(f"_t_{k}") == F.col(f"_s_{k}") for k in keys])
    joined = side(base, "_t_").join(side(newest, "_s_"), same, "full_outer")
    old, new = F.col("_t_row"), F.col("_s_row")
    # Structs compare field by field, nulls lowest, as in latest_per_key.
    changed: Column = old.isNull() | (new.isNotNull() & (new >= old))
    row = F.when(changed, new).otherwise(old)
    cols = {k: F.coalesce(f"_t_{k}", f"_s_{k}").alias(k) for k in keys} | {c: row[c].alias(c) for c in order}
    lacking = base.where(~whole).unionByName(newest.where(~whole))
    out = joined.select(*[cols[c] for c in base.columns])
    return out.unionByName(upsert.latest_per_key(lacking, keys, newest_first))


def read_upserted(
    spark: SparkSession,
    table: str,
    keys: Sequence[str],
    newest_first: Sequence[str],
    schema: T.StructType,
    as_of: str | None = None,
) -> DataFrame:
    """The newest row per key, now or as of a moment (``yyyy-MM-dd HH:mm:ss``, UTC).

    Straight after a compaction the base is returned as it is.  Otherwise the change sets
    are reduced to their newest rows and joined to the base's buckets; the base is
    neither shuffled nor ranked.  Moments before the oldest set that is left are an error.
    """
    base, changes = live(parts(spark, table), as_of)
    newest = upsert.latest_per_key(spark.read.schema(schema).parquet(*[p.path for p in changes]), keys, newest_first) if changes else None
    if base is None:
        return spark.createDataFrame([], schema) if newest is None else newest
    stored = _read_base(spark, base, keys, schema)
    return stored if newest is None else merged(stored, newest, keys, newest_first)


def compact_changes(
    spark: SparkSession,
    table: str,
    keys: Sequence[str],
    newest_first: Sequence[str],
    schema: T.StructType,
    buckets: int = 64,
    keep: bool = False,
) -> None:
    """Merge all sets into a new base, publish it by a rename and remove what it replaces.

    A job of its own, run when sets have become many.  A crash leaves the old sets in
    use; batches may arrive meanwhile.  ``keep`` leaves the replaced sets for reads as of
    an earlier moment.  ``buckets`` should be about the cluster's shuffle partitions.
    """
    found = parts(spark, table)
    last = max((p for p in found if p.kind == "change"), key=lambda p: p.number, default=None)
    if last is None or any(p.kind == "base" and p.number >= last.number for p in found):
        return
    public = f"{table}/base={last.number}.{buckets}"
    hidden = f"{table}/_base={last.number}.{buckets}"
    rows = read_upserted(spark, table, keys, newest_first, schema)
    name = _name(hidden)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    sinks.overwrite_bucketed(rows, name, hidden, buckets, keys)
    if last.arrived is not None:
        _mark(spark, hidden, last.arrived)
    spark.sql(f"DROP TABLE {name}")
    home, target = _home(spark, public)
    if not home.rename(_home(spark, hidden)[1], target):
        raise RuntimeError(f"cannot publish {public}")
    if keep:
        return
    for p in found:
        home.delete(_home(spark, p.path)[1], True)
        if p.kind == "base":
            spark.sql(f"DROP TABLE IF EXISTS {_name(p.path)}")
