"""Incremental jobs, each compared with its batch twin.

Deliveries are written wave by wave and the job runs after every wave, as it
would when files keep arriving.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions import dates
from silverlode.session import scratch_path
from silverlode.streaming import changesets, jobs, keyed

from .catalog_governance import FIRED_SQL, GATE_SQL, alert_rules
from .catalog_rows import SILVER_HR_SQL
from .registry import query

STAMP = "'%Y-%m-%d %H:%M:%S'"
NOTHING_LATE = "60 days"


def folders(t, label: str) -> tuple[str, str, str]:
    """Fresh landing, target and checkpoint folders."""
    root = scratch_path(t.spark, label)
    return f"{root}/landing", f"{root}/target", f"{root}/checkpoint"


def stateful(t):
    return keyed.stateful_session(t.spark, t.spark.sparkContext.defaultParallelism)


def event_waves(t):
    """The events of each third of the month."""
    events, ts = t.table("events").withColumn("ts", F.col("ts").cast("timestamp")), F.col("ts")
    cuts = [dates.moment(f"2024-01-{d} 00:00:00").cast("timestamp") for d in ("11", "21")]
    return [events.where(ts < cuts[0]), events.where((ts >= cuts[0]) & (ts < cuts[1])), events.where(ts >= cuts[1])]


def deliver(waves, landing: str, run) -> None:
    for wave in waves:
        wave.write.mode("append").parquet(landing)
        run()


@query("st_1_file_arrival_ingest", "SELECT event_id, user_id, event_type, value, props FROM events")
def st_1(t):
    landing, target, checkpoint = folders(t, "ingest")
    schema = event_waves(t)[0].schema
    deliver(event_waves(t), landing, lambda: jobs.ingest(jobs.landing_stream(t.spark, landing, schema), target, checkpoint))
    jobs.ingest(jobs.landing_stream(t.spark, landing, schema), target, checkpoint)  # nothing new arrives twice
    return t.spark.read.parquet(target).drop("ts")


@query("st_2_incremental_upsert", f"SELECT {SILVER_HR_SQL} FROM silver_hr")
def st_2(t):
    landing, target, checkpoint = folders(t, "upsert")
    rows = t.cleansed_hr
    waves = [rows.where(F.pmod(F.hash("employee_id", "created_datetime"), F.lit(2)) == i) for i in range(2)]
    schema = rows.schema

    table = (target, ["employee_id", "pod_id"], ["created_datetime", "department"])

    def run():
        stream = jobs.landing_stream(t.spark, landing, schema)
        changesets.incremental_upsert(stream, target, checkpoint, *table[1:], schema)

    deliver(waves[:1], landing, run)
    changesets.compact_changes(t.spark, *table, schema, buckets=t.spark.sparkContext.defaultParallelism)
    deliver(waves[1:], landing, run)
    return changesets.read_upserted(t.spark, *table, schema)


@query(
    "tm_9_table_as_of",
    f"SELECT {SILVER_HR_SQL} FROM silver_hr WHERE employee_id % 3 <> 2",
)
def tm_9_table_as_of(t):
    landing, target, checkpoint = folders(t, "as-of")
    rows = t.cleansed_hr
    keys, newest_first = ["employee_id", "pod_id"], ["created_datetime", "department"]
    # Staff of each third arrive at noon of one day; the second day's state is asked for after the third's.
    for i in range(3):
        rows.where(F.col("employee_id") % 3 == i).write.mode("append").parquet(landing)
        stream = jobs.landing_stream(t.spark, landing, rows.schema)
        arrived = f"2024-02-0{i + 1} 12:00:00"
        changesets.incremental_upsert(stream, target, checkpoint, keys, newest_first, rows.schema, arrived)
        if i == 1:
            buckets = t.spark.sparkContext.defaultParallelism
            changesets.compact_changes(t.spark, target, keys, newest_first, rows.schema, buckets, keep=True)
    return changesets.read_upserted(t.spark, target, keys, newest_first, rows.schema, as_of="2024-02-03 11:59:59")


@query("st_3_high_water_mark", "SELECT event_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-21')")
def st_3(t):
    events = t.table("events")
    done = events.where(F.col("ts") < dates.moment("2024-01-21 00:00:00"))
    mark = jobs.high_water_mark(done, "ts").scalar()
    return jobs.since_mark(events, "ts", mark).select("event_id")


def _windows_sql(width: str) -> str:
    return f"""SELECT strftime(time_bucket(INTERVAL {width}, ts), {STAMP}) AS window_start, count(*) AS total,
    count(*) FILTER (WHERE event_type <> 'error') AS succeeded, count(*) FILTER (WHERE event_type = 'error') AS failed FROM events GROUP BY 1"""


def windowed(t, width: str):
    landing, target, checkpoint = folders(t, "windows")
    schema = event_waves(t)[0].schema

    session = stateful(t)

    def run():
        stream = jobs.landing_stream(session, landing, schema)
        jobs.write_windows(jobs.windowed_outcomes(stream, "ts", width, NOTHING_LATE), target, checkpoint)

    deliver(event_waves(t), landing, run)
    return jobs.latest_windows(t.spark, target, ["total", "succeeded", "failed"])


@query("st_4_hourly_windows", _windows_sql("1 HOUR"))
def st_4(t):
    return windowed(t, "1 hour")


@query("st_4_five_minute_windows", _windows_sql("5 MINUTE"))
def st_4_short(t):
    return windowed(t, "5 minutes")


@query(
    "st_4_late_rows",
    """WITH w AS (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) AS start, CASE WHEN ts >= TIMESTAMP '2024-01-21' OR event_id % 7 = 0 THEN 3
        WHEN ts >= TIMESTAMP '2024-01-11' THEN 2 ELSE 1 END AS wave FROM events),
    m AS (SELECT *, (SELECT max(ts) FROM w v WHERE v.wave < w.wave) - INTERVAL 4 DAYS AS bound FROM w),
    l AS (SELECT *, coalesce(start + INTERVAL 1 HOUR <= bound, false) AS late FROM m)
    SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS delivered, count(*) FILTER (WHERE NOT late) AS total,
        count(*) FILTER (WHERE late) AS late FROM l GROUP BY 1""",
)
def st_4_late(t):
    landing, target, checkpoint = folders(t, "late-windows")
    # A seventh of all events comes with the last third; what is more than four days old by then is late.
    events, ts, held = t.table("events").withColumn("ts", F.col("ts").cast("timestamp")), F.col("ts"), F.col("event_id") % 7 == 0
    cuts = [dates.moment(f"2024-01-{d} 00:00:00").cast("timestamp") for d in ("11", "21")]
    wave = F.when((ts >= cuts[1]) | held, 3).when(ts >= cuts[0], 2).otherwise(1)

    def run():
        stream = jobs.landing_stream(t.spark, landing, events.schema)
        jobs.count_windows(stream, "ts", "1 hour", "4 days", target, checkpoint)

    deliver([events.where(wave == i) for i in (1, 2, 3)], landing, run)
    late = jobs.late_rows(t.spark, target, events.schema).groupBy(F.window("ts", "1 hour")["start"].alias("window_start"))
    both = jobs.counted_windows(t.spark, target).join(late.agg(F.count("*").alias("late")), "window_start", "full_outer")
    counted = both.select("window_start", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "late")])
    return counted.withColumn("delivered", F.col("total") + F.col("late"))


@query(
    "st_5_completeness",
    f"WITH {GATE_SQL} SELECT pod_id, company FROM gate WHERE len(missing) = 0 AND len(domains) > 0",
)
def st_5(t):
    landing, target, checkpoint = folders(t, "complete")
    listing = t.bronze_files.select("pod_id", "company", "domain", "file_name", "doc_id")
    waves = [listing.where(F.col("doc_id") % 2 == i).drop("doc_id") for i in range(2)]
    schema = waves[0].schema

    def run():
        stream = jobs.landing_stream(t.spark, landing, schema)
        jobs.completeness_stream(stream, t.company_config, f"{target}-state", target, checkpoint)

    deliver(waves, landing, run)
    released = T.StructType([T.StructField("pod_id", T.StringType()), T.StructField("company", T.StringType())])
    return jobs.all_versions(t.spark, target, released).select("pod_id", "company")


# Events without a known key; the others come again under another day.
KEYLESS = "event_id % 11 = 0"


@query(
    "st_6_repeated_deliveries",
    f"""SELECT CASE WHEN NOT {KEYLESS} THEN event_id END AS event_id, event_type FROM events
    UNION ALL SELECT NULL, event_type FROM events WHERE {KEYLESS} AND event_id % 3 = 0""",
)
def st_6(t):
    landing, target, checkpoint = folders(t, "dedup")
    # Every third event comes again, in the same wave and weeks later under another day; some first come late.
    # Rows without a key cannot be told from each other, so all of them are stored.
    first, second, third = event_waves(t)
    late, again = F.col("event_id") % 7 == 0, F.col("event_id") % 3 == 0
    keyed_again = [w.where(again & ~F.expr(KEYLESS)).withColumn("ts", F.timestamp_add("DAY", F.lit(17), F.col("ts"))) for w in (first, second)]
    waves = [
        first.where(~late).unionByName(first.where(again & ~late)),
        second.unionByName(second.where(again)).unionByName(keyed_again[0].where(~late)),
        third.unionByName(third.where(again)).unionByName(first.where(late)).unionByName(first.where(late & again)).unionByName(keyed_again[1]),
    ]
    hidden = [w.withColumn("event_id", F.when(~F.expr(KEYLESS), F.col("event_id"))) for w in waves]
    session = stateful(t)

    def run():
        stream = jobs.landing_stream(session, landing, hidden[0].schema)
        keyed.ingest_distinct(stream, target, checkpoint, ["event_id"], "ts")

    deliver(hidden, landing, run)
    return t.spark.read.parquet(target).select("event_id", "event_type")


@query(
    "st_7_alerts_with_cooldown",
    f"""WITH RECURSIVE {FIRED_SQL}, minutes AS (SELECT alert_rule_id, any_value(cooldown_minutes) AS cooldown,
      CAST(epoch(fired_at) AS BIGINT) // 60 AS minute, count(*) AS firings FROM fired GROUP BY 1, 3),
    sent AS (SELECT alert_rule_id, min(minute) AS minute, any_value(cooldown) AS cooldown FROM minutes GROUP BY 1
      UNION ALL SELECT m.alert_rule_id, min(m.minute), any_value(s.cooldown) FROM sent s JOIN minutes m ON m.alert_rule_id = s.alert_rule_id
        AND m.minute > s.minute AND m.minute >= s.minute + coalesce(s.cooldown, 0) GROUP BY m.alert_rule_id)
    SELECT m.alert_rule_id, m.cooldown AS cooldown_minutes, m.minute, m.firings FROM minutes m
    JOIN sent s ON s.alert_rule_id = m.alert_rule_id AND s.minute = m.minute""",
)
def st_7(t):
    landing, target, checkpoint = folders(t, "alerts")
    log, at = t.execution_log, F.col("execution_start_time")
    # Waves come out of order and share minutes: every third run of a third comes with the next.
    cuts = [dates.moment(f"2024-01-{d} 00:00:00") for d in ("11", "21")]
    third = F.when(at < cuts[0], 0).when(at < cuts[1], 1).otherwise(2)
    wave = (third + F.when(F.pmod(F.hash("execution_id"), F.lit(3)) == 0, 1).otherwise(0)) % 3
    waves = [log.where(wave == i) for i in (2, 0, 1)]
    # A run long after the others makes their minutes final; it is still running, so no rule fires.
    ahead = F.timestamp_add("YEAR", F.lit(1), at)
    nothing = {c: F.lit(None).cast(log.schema[c].dataType) for c in ("execution_duration_seconds", "data_quality_score", "dbu_consumed")}
    quiet = {"execution_start_time": ahead, "execution_end_time": F.lit(None).cast("timestamp_ntz"), "status": F.lit("RUNNING")}
    waves.append(log.orderBy(F.desc("execution_start_time"), "execution_id").limit(1).withColumns(nothing | quiet))
    session = stateful(t)

    def run():
        stream = jobs.landing_stream(session, landing, log.schema)
        keyed.alert_stream(stream, alert_rules(t), NOTHING_LATE, target, checkpoint)

    deliver(waves, landing, run)
    return keyed.alerts_sent(t.spark, target)
