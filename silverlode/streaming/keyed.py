"""Streaming jobs with keyed state on disk.

State lives in RocksDB below the checkpoint, one entry per key, and is read and written
for the keys of a batch alone; so a batch costs what it brings, not what came before.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from silverlode.operators import alerts
from silverlode.session import configure
from silverlode.sources import files

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A batch uploads its changes; whole snapshots follow in the background.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def stateful_session(spark: SparkSession, partitions: int) -> SparkSession:
    """A session of its own for stateful streams; ``spark`` keeps its settings.

    The number of state partitions is fixed for a checkpoint by its first run; about the
    cores of the cluster is a good choice.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            session.conf.set(key, value)
    configure(session)
    for key, value in (STATE_SETTINGS | {"spark.sql.shuffle.partitions": str(partitions)}).items():
        session.conf.set(key, value)
    return session


# ---- bronze without repeats ---------------------------------------------------------------

DAY = "delivery_day"


def ingest_distinct(stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], time_column: str) -> None:
    """Landing -> bronze: append the first delivery of every key, however late it or its repeats come.

    A key is remembered for good, whatever day its rows carry; of several rows of one key
    in one batch any one is taken.  Rows that lack a key, or a part of it, cannot repeat
    and are all appended.  Bronze is partitioned by the day of ``time_column``; nothing
    stored is read again.  ``stream`` should belong to a ``stateful_session``.
    """
    rows = stream.withColumn(DAY, F.to_date(time_column))
    whole = F.lit(True)
    for key in keys:
        whole &= F.col(key).isNotNull()
    first = rows.where(whole).dropDuplicates(list(keys)).unionByName(rows.where(~whole))
    writer = first.writeStream.format("parquet").partitionBy(DAY).outputMode("append")
    writer = writer.option("path", target).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


# ---- alerts with cooldown -------------------------------------------------------------------

MINUTE_MS = 60_000
DECIDED = T.StructType(
    [
        T.StructField("alert_rule_id", T.StringType()),
        T.StructField("cooldown_minutes", T.IntegerType()),
        T.StructField("minute", T.LongType()),
        T.StructField("firings", T.LongType()),
        T.StructField("outcome", T.StringType()),
    ]
)
SENT, HELD, LATE = "sent", "held", "late"


def _decided(key, cooldown, minute, firings, outcome) -> Row:
    return Row(alert_rule_id=key[0], cooldown_minutes=cooldown, minute=minute, firings=firings, outcome=outcome)


class Cooldown(StatefulProcessor):
    """Decide each minute of a rule once, when the watermark has passed its end.

    State per rule: the firings of the minutes that are not final yet, at most as many
    as the lateness bound has and batches bring, and the last minute sent.  A batch appends
    its minutes in one call; once some are final, the rest are stored anew, merged.
    """

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "minute long, firings long, cooldown int")
        self.last = handle.getValueState("last", "minute long")

    def _wake(self, minutes: Iterable[int]) -> None:
        self.handle.registerTimer((min(minutes) + 1) * MINUTE_MS)

    def handleInputRows(self, key, rows: Iterable[Row], timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        fresh = []
        for r in rows:
            if (r.minute + 1) * MINUTE_MS <= mark:
                yield _decided(key, r.cooldown_minutes, r.minute, r.firings, LATE)
            else:
                fresh.append((r.minute, r.firings, r.cooldown_minutes))
        if fresh:
            merged = _merged(fresh)
            self.open.appendList([(m, *held) for m, held in merged.items()])
            self._wake(merged)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # The first of several timers decides all minutes that are final, in their order.
        mark = timerValues.getCurrentWatermarkInMs()
        known = _merged(self.open.get())
        final = sorted(m for m in known if (m + 1) * MINUTE_MS <= mark)
        if not final:
            return
        sent = self.last.get()[0] if self.last.exists() else None
        for minute in final:
            firings, cooldown = known.pop(minute)
            quiet = sent is not None and minute - sent < (cooldown or 0)
            if not quiet:
                sent = minute
            yield _decided(key, cooldown, minute, firings, HELD if quiet else SENT)
        self.last.update((sent,))
        if known:
            self.open.put([(m, *held) for m, held in known.items()])
            self._wake(known)
        else:
            self.open.clear()

    def close(self) -> None:
        pass


def _merged(entries: Iterable[tuple]) -> dict[int, tuple[int, int | None]]:
    """(firings, cooldown) of every minute; the latest cooldown counts."""
    minutes: dict[int, tuple[int, int | None]] = {}
    for minute, firings, cooldown in entries:
        minutes[minute] = (minutes.get(minute, (0, None))[0] + firings, cooldown)
    return minutes


def _by_minute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Firings of one task counted per rule and minute, before they are shuffled."""
    for batch in batches:
        counted = pa.Table.from_batches([batch]).group_by(batch.schema.names).aggregate([([], "count_all")])
        yield from counted.rename_columns([*batch.schema.names, "firings"]).combine_chunks().to_batches()


def alert_stream(stream: DataFrame, rules: DataFrame, lateness: str, target: str, checkpoint: str) -> None:
    """Evaluate rules on arriving runs and send alerts, per rule and minute, unless a cooldown is on.

    A minute is final once the latest run start seen, less ``lateness``, has passed its
    end.  Until then it collects firings from deliveries in any order; then it is decided
    once, so an alert that was sent stays sent.  The cooldown is that of the rule when
    the minute fired.  Firings of final minutes are not decided; they are kept as ``late``.
    The outcome is that of one batch over all runs that came within the bound.

    ``target`` gets one folder per batch, with ``outcome`` sent, held (by a cooldown) or
    late.  ``stream`` should belong to a ``stateful_session``.
    """
    start = F.col("execution_start_time").cast("timestamp")
    runs = stream.withColumn("_start", start).withWatermark("_start", lateness).drop("execution_start_time")
    fired = alerts.evaluate_alerts(runs.withColumnRenamed("_start", "execution_start_time"), rules)
    # The watermark is the runs'; without a time column the operator gets late firings as well.
    minute = F.floor(F.unix_seconds("fired_at") / 60).cast("long").alias("minute")
    minutes = fired.select("alert_rule_id", "cooldown_minutes", minute)
    minutes = minutes.mapInArrow(_by_minute, "alert_rule_id string, cooldown_minutes int, minute long, firings long")
    decided = minutes.groupBy("alert_rule_id").transformWithState(Cooldown(), DECIDED, "Append", "EventTime")

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.partitionBy("outcome").mode("overwrite").parquet(f"{target}/version={batch_id}")

    writer = decided.writeStream.foreachBatch(put).outputMode("append").option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def decided_minutes(spark: SparkSession, target: str) -> DataFrame:
    """All minutes decided so far, and the late firings, with the batch's number as ``version``."""
    return files.read_or_empty(spark, target, T.StructType([*DECIDED.fields, T.StructField("version", T.IntegerType())]))[0]


def alerts_sent(spark: SparkSession, target: str) -> DataFrame:
    """The alerts sent so far; no later batch changes them."""
    return decided_minutes(spark, target).where(F.col("outcome") == SENT).drop("outcome", "version")


def late_firings(spark: SparkSession, target: str) -> DataFrame:
    """Firings that came after their minute was final, counted per rule and minute."""
    late = decided_minutes(spark, target).where(F.col("outcome") == LATE)
    return late.groupBy("alert_rule_id", "minute").agg(F.sum("firings").alias("firings"))
